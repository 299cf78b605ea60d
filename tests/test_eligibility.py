"""Golden cases of the whole resolution of evidence."""

from factline.operators import evidence
from factline.plans import eligibility

RAW = "evidence_id string, subject string, role string, source_system string, platform string, scope string, remote_scope string, can_restrict boolean, rule string, path string, raw_value string"


def places(spark):
    table = lambda rows, schema: spark.createDataFrame(rows, schema)
    countries = [("US", "United States"), ("JE", "Jersey"), ("MX", "Mexico"), ("IE", "Ireland"), ("GB", "United Kingdom"), ("CA", "Canada"), ("LU", "Luxembourg"), ("BE", "Belgium"), ("GE", "Georgia"), ("KR", "Korea, Republic of")]
    regions = [("US", "US-NJ", "New Jersey"), ("US", "US-NM", "New Mexico"), ("CA", "CA-ON", "Ontario"), ("GB", "GB-NIR", "Northern Ireland"), ("BE", "BE-WLX", "Luxembourg"), ("US", "US-GA", "Georgia")]
    return eligibility.Places(
        evidence.alias_table(table(countries, "code string, name string")),
        evidence.region_aliases(table(regions, "code string, region_code string, name string")),
        evidence.group_aliases(table([("EU", "EU"), ("EU", "European Union"), ("LATAM", "Latin America")], "group_code string, alias string")),
        table([("CA", "Toronto office", None), ("GB", "HQ", "lever")], "code string, alias string, platform string"),
        table([("Anywhere", "Lever"), ("Earth", None)], "alias string, platform string"),
        table([("EU", "IE"), ("EU", "LU"), ("EU", "BE"), ("LATAM", "MX")], "group_code string, code string"),
    )


def row(name, text, role="NORMALIZED_TEXT", platform=None, scope="SPECIFIC", remote="REMOTE", can=True, rule=None, path=None, system=None, subject=None):
    return name, subject or name, role, system, platform, scope, remote, can, rule, path, text


def resolved(spark, rows):
    found = eligibility.resolve(spark.createDataFrame(rows, RAW), places(spark)).evidence
    out = {}
    for r in found.collect():
        out.setdefault(r.evidence_id, set()).add((r.direction, r.code, r.group_code, r.match_source))
    return out


def test_texts_roles_and_reasons(spark):
    onsite = {"role": "JOB_LOCATION", "remote": "ONSITE", "can": None}
    rows = [
        row("jersey", "Based in New Jersey"),
        row("mexico", "Remote in Mexico"),
        row("new mexico", "New Mexico"),
        row("irelands", "Ireland or Northern Ireland"),
        row("northern", "Northern Ireland"),
        row("ontario canada", "Ontario, Canada"),
        row("ontario", "Ontario"),
        row("luxembourg", "Luxembourg"),
        row("korea", "Korea!"),
        row("code", "Office US-NJ (onsite)"),
        row("not a code", "OfficeUS-NJ"),
        row("union", "EU and Latin America"),
        row("lower", "somewhere in eu"),
        row("country", "US", path="$.jobLocation.address.addressCountry", **onsite),
        row("ends", "Toronto, Ontario", path="$.jobLocation.name", **onsite),
        row("reviewed", "toronto OFFICE", path="$.jobLocation.name", **onsite),
        row("scoped", "HQ", platform="Lever", path="$.jobLocation.name", **onsite),
        row("unscoped", "HQ", platform="other", path="$.jobLocation.name", **onsite),
        row("anywhere", "Anywhere", platform="LEVER", path="$.jobLocation.name", **onsite),
        row("elsewhere", "Anywhere", platform="other", path="$.jobLocation.name", **onsite),
        row("remote place", "Mexico", role="JOB_LOCATION", remote="REMOTE"),
        row("remote lever", "Mexico", role="JOB_LOCATION", remote="REMOTE", platform="lever"),
        row("platform", "Mexico", role="PLATFORM_JOB_LOCATION", platform="Ashby"),
        row("own system", "Mexico", role="NEXTJS", system="NEXTJS"),
        row("other system", "Mexico", role="NEXTJS", system="else"),
        row("label", "Somewhere", rule="location_shaped_remote_label"),
        row("world", "Mexico", scope="GLOBAL"),
        row("excluded", "Canada", role="LLM_EXCLUDED_COUNTRY"),
        row("excluded text", "not Canada", role="LLM_EXCLUDED_COUNTRY"),
        row("group only", "European  union", role="LLM_INCLUDED_GROUP"),
        row("no country", "Canada", role="LLM_INCLUDED_GROUP"),
        row("silent", "Canada", can=False),
        row("empty", None),
    ]
    text = lambda code: ("INCLUDED", code, None, "COUNTRY_TEXT_ALIAS")
    region = lambda code: ("INCLUDED", code, None, "COUNTRY_SUBDIVISION_TEXT_ALIAS")
    group = lambda code: ("INCLUDED", None, code, "COUNTRY_GROUP_TEXT_ALIAS")
    none = lambda direction, source: (direction, None, None, source)
    unmatched, unknown = none("INCLUDED", "UNMATCHED_RESTRICTIVE_EVIDENCE"), none("UNKNOWN", "UNKNOWN_OR_INVALID")
    want = {
        "jersey": {region("US")},
        "mexico": {text("MX")},
        "new mexico": {region("US")},
        "irelands": {text("IE"), region("GB")},
        "northern": {region("GB")},
        "ontario canada": {region("CA")},  # of two sources of a code the first in the alphabet stays
        "ontario": {unmatched},
        "luxembourg": {text("LU")},
        "korea": {text("KR")},
        "code": {region("US")},
        "not a code": {unmatched},
        "union": {group("EU"), group("LATAM")},
        "lower": {unmatched},
        "country": {("INCLUDED", "US", None, "ATOMIC_COUNTRY_ALIAS")},
        "ends": {region("CA")},
        "reviewed": {("INCLUDED", "CA", None, "REVIEWED_LOCATION_COUNTRY_ALIAS")},
        "scoped": {("INCLUDED", "GB", None, "REVIEWED_LOCATION_COUNTRY_ALIAS")},
        "unscoped": {unknown},
        "anywhere": {none("GLOBAL", "REVIEWED_GLOBAL_LOCATION_ALIAS")},
        "elsewhere": {unknown},
        "remote place": {unknown},
        "remote lever": {text("MX")},
        "platform": {text("MX")},
        "own system": {text("MX")},
        "other system": {unknown},
        "label": {none("UNKNOWN", "UNMATCHED_LOCATION_LABEL")},
        "world": {none("GLOBAL", "GLOBAL_SCOPE")},
        "excluded": {("EXCLUDED", "CA", None, "ATOMIC_COUNTRY_ALIAS")},
        "excluded text": {none("EXCLUDED", "UNMATCHED_RESTRICTIVE_EVIDENCE")},
        "group only": {("INCLUDED", None, "EU", "ATOMIC_COUNTRY_GROUP_ALIAS")},
        "no country": {unmatched},
        "silent": {unknown},
        "empty": {unmatched},
    }
    assert resolved(spark, rows) == want


def test_context_and_distrust(spark):
    """An alias that stands beside another country more often than beside its own, and names that are also regions."""
    onsite = {"role": "JOB_LOCATION", "remote": "ONSITE", "can": None}
    rows = [
        row("us", "US", path="$.jobLocation.address.addressCountry", subject="s", **onsite),
        row("jersey city", "Jersey City", path="$.jobLocation.address.addressLocality", subject="s", **onsite),
        row("alone", "Jersey", subject="t"),
        row("je", "JE", path="$.jobLocation.address.addressCountry", subject="u", **onsite),
        row("helped", "St Helier, Jersey", subject="u"),
        row("georgia place", "Atlanta, Georgia", path="$.jobLocation.name", subject="v", **onsite),
        row("georgia text", "Georgia", subject="w"),
    ]
    found = resolved(spark, rows)
    assert found["us"] == {("INCLUDED", "US", None, "ATOMIC_COUNTRY_ALIAS")}
    assert found["jersey city"] == found["alone"] == found["georgia place"] == {("INCLUDED", None, None, "AMBIGUOUS_COUNTRY_ALIAS")}
    assert found["helped"] == {("INCLUDED", "JE", None, "COUNTRY_TEXT_ALIAS")}
    assert found["georgia text"] == {("INCLUDED", "GE", None, "COUNTRY_TEXT_ALIAS")}
    rolled = {r.subject: (r.scope, r.eligible) for r in eligibility.eligibility(spark.createDataFrame(rows, RAW), places(spark)).collect()}
    assert rolled["s"] == ("SPECIFIC", ["US"]) and rolled["t"] == ("UNKNOWN", []) and rolled["u"] == ("SPECIFIC", ["JE"])


def test_no_evidence(spark):
    assert eligibility.resolve(spark.createDataFrame([], RAW), places(spark)).evidence.collect() == []
