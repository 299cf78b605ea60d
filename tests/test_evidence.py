"""Golden cases of evidence resolution and current facts."""

from collections import Counter

from pyspark.sql import functions as F

from factline.operators import evidence, facts, relational
from factline.plans import eligibility, regions

EVIDENCE = "evidence_id string, raw_value string, folded string, cased string, restricting boolean, written string"
MATCH = "evidence_id string, code string, alias string, kind string, n_matches long"


def place(i, text, restricting=True):
    cased = " ".join(text.replace(",", " ").replace("-", " ").split())
    return i, text, cased.lower(), cased, restricting, cased


def test_regions_and_the_countries_inside_their_names(spark):
    rows = spark.createDataFrame([place("a", "Remote, New Jersey"), place("b", "Jersey and New Jersey"), place("c", "Office x-US-NJ"), place("d", "New Jersey", False), place("e", None or "")], EVIDENCE)
    regions = spark.createDataFrame([("US", "new jersey", "New Jersey", "phrase"), ("US", "us nj", "US NJ", "exact_code")], "code string, alias string, cased_alias string, kind string")
    countries = spark.createDataFrame([("a", "JE", "jersey", "phrase", 1), ("b", "JE", "jersey", "phrase", 2)], MATCH).join(rows, "evidence_id")
    found = evidence.subdivision_match(rows, regions)
    assert sorted((r.evidence_id, r.kind) for r in found.collect()) == [("a", "phrase"), ("b", "phrase"), ("c", "exact_code"), ("d", "phrase")]
    accepted = evidence.accept_subdivisions(found, countries)
    assert sorted(r.evidence_id for r in accepted.collect()) == ["a", "b", "c"]
    assert [r.evidence_id for r in evidence.unexplained(countries, accepted).collect()] == ["b"]


def test_mentions_are_places_in_the_text(spark):
    """Regions of two countries over one mention don't explain another, only names as written do, and a mention in part of a name is lone."""
    cases = {
        "both": ("Jersey, New Jersey City", True),  # two names cover the second mention
        "lower": ("new jersey and New Jersey", True),  # the first isn't the region's name as written
        "inside": ("New Jersey City", False),
        "twice": ("New Jersey, New Jersey", False),
        "beside": ("New Jersey Jersey", True),
        "accents": ("Côte-Jersey New Jersey", True),
    }
    rows = evidence.prepare_texts(spark.createDataFrame([(k, v[0], None) for k, v in cases.items()], "evidence_id string, raw_value string, path string"))
    regions = spark.createDataFrame([("US", "new jersey", "New Jersey", "phrase"), ("AU", "new jersey city", "New Jersey City", "phrase")], "code string, alias string, cased_alias string, kind string")
    found = rows.crossJoin(regions).where("contains(concat(' ', cased, ' '), concat(' ', cased_alias, ' '))")
    countries = rows.selectExpr("*", "'JE' AS code", "'jersey' AS alias", "'phrase' AS kind", "1 AS n_matches")
    assert {r.evidence_id for r in evidence.unexplained(countries, found).collect()} == {k for k, v in cases.items() if v[1]}


def test_disjunctive_join(spark):
    left = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, 1, 9), (3, 9, 2), (4, None, 2), (5, 9, 9), (6, None, None)], "id int, a int, b int")
    right = spark.createDataFrame([(1, 1), (2, 2), (1, 2), (None, 1)], "x int, y int")
    branches = [([("a", "x")], None), ([("b", "y")], F.col("id") != 3)]
    met = lambda r, s: (r.a is not None and r.a == s.x) or (r.b is not None and r.b == s.y and r.id != 3)
    pairs = [(r, s) for r in left.collect() for s in right.collect() if met(r, s)]
    assert Counter(map(tuple, relational.disjunctive_join(left, right, branches).collect())) == Counter((*r, *s) for r, s in pairs)
    with_any = Counter(tuple(r) for r in left.collect() if any(met(r, s) for s in right.collect()))
    assert Counter(map(tuple, relational.disjunctive_join(left, right, branches, "left_semi").collect())) == with_any
    assert Counter(map(tuple, relational.disjunctive_join(left, right, branches, "left_anti").collect())) == Counter(map(tuple, left.collect())) - with_any
    assert "NestedLoop" not in relational.disjunctive_join(left, right, branches)._jdf.queryExecution().executedPlan().toString()


def test_a_part_of_the_subjects_gives_the_same(spark):
    """Resolving changed subjects gives what all give, also where an alias lost trust."""
    t = lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    raw, places = regions.raw_evidence(t).where("subject % 4 = 1"), regions.places(t)
    whole = eligibility.resolve(raw, places)
    rows = lambda df: Counter(str(tuple(r)) for r in df.collect())
    some = eligibility.resolve(raw.where("subject % 8 = 1"), places, whole.distrusted).evidence
    columns = ["evidence_id", "direction", "code", "group_code", "match_source"]
    assert rows(some.select(columns)) == rows(whole.evidence.where("subject % 8 = 1").select(columns))
    old = raw.where("evidence_id % 9 <> 0")
    before = eligibility.resolve(old, places)
    changed = raw.where("evidence_id % 9 = 0").select("subject")
    now, distrusted = eligibility.refresh(raw, places, changed, evidence.rollup_eligibility(before.evidence, places.members), before.distrusted)
    assert rows(now) == rows(evidence.rollup_eligibility(whole.evidence, places.members).select(now.columns)) and rows(distrusted.select("code", "alias")) == rows(whole.distrusted.select("code", "alias"))


def test_distrusted_aliases_and_conflicts(spark):
    context = spark.createDataFrame([("s1", "JOB_LOCATION", "o", "US"), ("s2", "JOB_LOCATION", "o", "US"), ("s3", "JOB_LOCATION", "o", "GE")], "subject string, role string, object string, code string")
    seen = spark.createDataFrame([(f"e{i}", f"s{i}", "JOB_LOCATION", "o", "GE", "georgia", "TEXT", True) for i in (1, 2, 3)], "evidence_id string, subject string, role string, object string, code string, alias string, mode string, location_role boolean")
    distrusted = evidence.distrusted_aliases(seen, context)
    assert [tuple(r) for r in distrusted.collect()] == [("GE", "georgia")]
    conflicts = evidence.context_conflicts(seen, distrusted.selectExpr("*", "false AS location_only"), context)
    assert sorted(r.evidence_id for r in conflicts.collect()) == ["e1", "e2"]


def test_structured_context_and_groups(spark):
    rows = spark.createDataFrame([("e", "s", "JOB_LOCATION", "o", "$.o.addressCountry", "france", "EU states")], "evidence_id string, subject string, role string, object string, path string, folded string, cased string")
    aliases = spark.createDataFrame([("FR", "france")], "code string, alias string")
    assert [tuple(r) for r in evidence.structured_context(rows, aliases, ("JOB_LOCATION",)).collect()] == [("s", "JOB_LOCATION", "o", "FR")]
    groups = spark.createDataFrame([("EU", "eu", "EU", True), ("EEA", "eu states", "x", False)], "group_code string, alias string, cased_alias string, is_code boolean")
    assert [r.group_code for r in evidence.group_text_match(rows, groups).collect()] == ["EU"]


def test_unmatched_evidence_keeps_a_reason(spark):
    rows = spark.createDataFrame([("a", "JOB_LOCATION", "INCLUDED", None), ("b", "X", "INCLUDED", "location_shaped_remote_label"), ("c", "X", "EXCLUDED", None), ("d", "JOB_LOCATION", "INCLUDED", None), ("e", "X", "INCLUDED", None), ("f", "X", "GLOBAL", None)], "evidence_id string, role string, direction string, rule string")
    matched, conflicts = rows.where("evidence_id = 'e'"), rows.where("evidence_id = 'd'")
    got = {r.evidence_id: (r.direction, r.match_source) for r in evidence.unmatched(rows, matched, conflicts).collect()}
    assert got == {"a": ("UNKNOWN", "UNKNOWN_OR_INVALID"), "b": ("UNKNOWN", "UNMATCHED_LOCATION_LABEL"), "c": ("EXCLUDED", "UNMATCHED_RESTRICTIVE_EVIDENCE"), "d": ("INCLUDED", "AMBIGUOUS_COUNTRY_ALIAS")}


def test_combining_ambiguity_and_rollup(spark):
    schema = "evidence_id string, subject string, direction string, code string, group_code string, match_source string"
    rows = spark.createDataFrame([("1", "s", "INCLUDED", "FR", None, "B"), ("1", "s", "INCLUDED", "FR", None, "A"), ("2", "s", "INCLUDED", None, "G", "A"), ("3", "s", "EXCLUDED", "DE", None, "A"), ("4", "t", "GLOBAL", None, None, "A"), ("5", "t", "EXCLUDED", "FR", None, "A"), ("6", "u", "UNKNOWN", None, None, "A"), ("7", "v", None, None, None, "A")], schema)
    combined = evidence.combine_evidence(rows)
    assert sorted((r.evidence_id, r.match_source) for r in combined.collect()) == [(str(i), "A") for i in range(1, 8)]
    members = spark.createDataFrame([("G", "DE"), ("G", "IT")], "group_code string, code string")
    rolled = evidence.rollup_eligibility(combined, members)
    got = {r.subject: (r.scope, r.eligible, r.excluded, r.included_groups, r.n_evidence) for r in rolled.collect()}
    assert got == {"s": ("SPECIFIC", ["FR", "IT"], ["DE"], ["G"], 3), "t": ("GLOBAL_EXCEPT", [], ["FR"], [], 2), "u": ("UNKNOWN", [], [], [], 1), "v": ("UNKNOWN", [], [], [], 1)}
    assert sorted(map(tuple, evidence.eligibility_bridge(rolled).collect())) == [("s", "DE", "EXCLUDED"), ("s", "FR", "ELIGIBLE"), ("s", "IT", "ELIGIBLE"), ("t", "FR", "EXCLUDED")]
    doubtful = spark.createDataFrame([("1", "FR"), ("1", "DE"), ("2", "FR")], "evidence_id string, code string")
    assert sorted(map(str, map(tuple, evidence.null_ambiguous(doubtful).collect()))) == ["('1', None)", "('2', 'FR')"]


def test_titles_facts_and_marts(spark):
    titles = "subject string, titles array<struct<source:string,value:string>>"
    pages = spark.createDataFrame([("a", [("og", "x"), ("jsonld", " y ")]), ("b", [("jsonld", "z" * 501)]), ("c", None)], titles)
    links = spark.createDataFrame([("b", [("LINK", "w")]), ("a", [("LINK", "v")])], titles)
    resolved = facts.resolve_title(pages, links, ["JSONLD", "OG"])
    assert sorted(map(str, map(tuple, resolved.collect()))) == ["('a', 'y', 'JSONLD')", "('b', 'w', 'LINK')", "('c', None, None)"]
    seen = lambda *r: spark.createDataFrame(list(r), "subject string, observed_at long")
    current = facts.current_facts({"page": seen(("a", 1)), "fact": seen(("a", 3), ("b", 2))})
    assert sorted((r.subject, r.has_page, r.has_fact, r.latest_observed_at) for r in current.collect()) == [("a", True, True, 3), ("b", False, True, 2)]
    served = spark.createDataFrame([("a", "k", "new", 2, False), ("b", "k", "old", 1, False), ("c", "k", "gone", 9, True), ("d", "m", "gone", 1, True)], "subject string, company string, name string, at long, is_deleted boolean")
    assert [(r.company, r.name, r.n_active, r.watermark) for r in facts.active_groups(served, "company", ["at", "subject"], ["name"], "at").collect()] == [("k", "new", 2, 9)]
    bridge = spark.createDataFrame([("a", "FR"), ("c", "FR")], "subject string, code string")
    assert [r.subject for r in facts.bridge_mart(bridge, served).collect()] == ["a"]


def test_alias_table_and_prepared_texts(spark):
    countries = spark.createDataFrame([("KR", "Korea, Republic of", "KOR"), ("KP", "Korea, Democratic Republic of", "PRK"), ("CI", "Côte d'Ivoire", "CIV"), (None, None, None)], "code string, name string, alpha_3 string")
    reviewed = spark.createDataFrame([("CI", "Ivory Coast", "phrase"), ("KR", " ", "phrase"), ("KR", None, "phrase")], "code string, alias string, kind string")
    found = {(r.code, r.alias, r.cased_alias, r.kind) for r in evidence.alias_table(countries, reviewed, codes=("alpha_3",)).collect()}
    assert ("KR", "korea republic of", "Korea Republic of", "phrase") in found and ("CI", "ivory coast", "Ivory Coast", "phrase") in found
    assert ("KP", "prk", "PRK", "exact_code") in found and not any(alias in ("korea", "") for _, alias, _, _ in found)
    assert len(found) == 10
    raw = spark.createDataFrame([("e1", "Québec, Canada", "$.jobLocation[0].address.addressRegion", 1), ("e2", None, None, None)], "evidence_id string, raw_value string, path string, run int")
    first, none = evidence.prepare_texts(raw).orderBy("evidence_id").collect()
    assert first.object == "$.joblocation[0]" and first.cased.endswith("bec Canada") and (none.folded, none.cased, none.object) == ("", "", "")
    latest = spark.createDataFrame([(1,), (None,)], "run int")
    assert [r.evidence_id for r in evidence.current_evidence(raw, latest, ["run"]).collect()] == ["e1"]


def test_direction_and_modes(spark):
    cases = [
        # role, path, scope, can_restrict, global_place, restricting, location_role -> direction, mode, group_mode
        ("JOB_LOCATION", "$.x.addressCountry", "SPECIFIC", None, False, True, True, "INCLUDED", "ATOMIC", "ATOMIC"),
        ("JOB_LOCATION", None, None, None, None, True, True, "INCLUDED", "TEXT", "TEXT"),
        ("JOB_LOCATION", None, None, True, False, False, True, "UNKNOWN", "NONE", "NONE"),
        ("JOB_LOCATION", None, None, True, True, True, True, "GLOBAL", "TEXT", "TEXT"),
        ("NORMALIZED_TEXT", None, "GLOBAL_EXCEPT", True, None, None, None, "GLOBAL", "TEXT", "TEXT"),
        ("NORMALIZED_TEXT", None, None, False, None, None, None, "UNKNOWN", "TEXT", "TEXT"),
        ("APPLICANT_LOCATION_REQUIREMENTS", None, "UNKNOWN", None, None, None, None, "INCLUDED", "ATOMIC", "ATOMIC"),
        ("LLM_EXCLUDED_GROUP", None, "GLOBAL_EXCEPT", False, None, None, None, "EXCLUDED", "NONE", "ATOMIC"),
        ("LLM_GLOBAL_SCOPE", None, None, None, None, None, None, "UNKNOWN", "NONE", "NONE"),
        ("other", None, "GLOBAL", True, None, None, None, "UNKNOWN", "NONE", "NONE"),
        (None, None, None, None, None, None, None, "UNKNOWN", "NONE", "NONE"),
    ]
    schema = "role string, path string, scope string, can_restrict boolean, global_place boolean, restricting boolean, location_role boolean, a string, b string, c string"
    rows = evidence.direct(spark.createDataFrame(cases, schema)).collect()
    assert [(r.direction, r.mode, r.group_mode) for r in rows] == [x[7:] for x in cases]
