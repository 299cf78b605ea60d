"""Resolving evidence to codes: regions of countries, context, conflicts, and the roll-up by subject.

Evidence rows have a unique ``evidence_id``, their ``subject``, a ``role``, the ``object`` they stand in and a
``direction`` (INCLUDED, EXCLUDED, GLOBAL or UNKNOWN). Texts are ``folded`` and ``cased`` (words as written).
Matches are evidence rows with ``code``, ``alias`` (folded), ``kind`` (phrase or exact_code) and ``n_matches``.
Null texts match nothing; null codes and groups count as none.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from factline.functions.text import fold_text, occurrences
from factline.operators.relational import disjunctive_join, drop_contained, hashed, merged, phrase_match, pick_first

ID = "evidence_id"
#: A code such as AB-12 between characters that aren't letters or digits; overlapping ones are all found.
_CODE = r"(?<![A-Za-z0-9])(?=([A-Za-z0-9]+-[A-Za-z0-9]+))"

#: Fields at the end of a path that belong to the object before them.
_FIELD = r"(\.address)?\.(addresscountry|addressregion|addresslocality|name)$"


@pandas_udf(StringType())
def _decomposed(text: pd.Series) -> pd.Series:
    return text.str.normalize("NFKD")


def _padded(text: Column) -> Column:
    return F.concat(F.lit(" "), text, F.lit(" "))


def _within(longer: Column, shorter: Column) -> Column:
    """Whether a phrase is part of a longer one, by whole words."""
    return (F.length(longer) > F.length(shorter)) & F.contains(_padded(longer), _padded(shorter))


def cased_text(col: Column) -> Column:
    """Words as written: decomposed, with runs of other than ASCII letters and digits as one space. Apply it to distinct values."""
    return F.trim(F.regexp_replace(_decomposed(col), "[^A-Za-z0-9]+", " "))


def current_evidence(raw: DataFrame, latest: DataFrame, key: list[str]) -> DataFrame:
    """Evidence of each subject's latest run: ``latest`` is unique by ``key``, the subject and its run's ids; null keys match nothing."""
    return raw.join(merged(latest.select(*key)), key, "left_semi")


def alias_table(entities: DataFrame, reviewed: DataFrame | None = None, code: str = "code", name: str = "name", codes: tuple[str, ...] = ()) -> DataFrame:
    """Aliases (code, alias, cased_alias, kind) that mean one code: names, what precedes a comma in them, codes, and reviewed ones.

    ``codes`` are further columns of ``entities`` that hold codes; ``reviewed`` has code, alias and kind. An alias that
    means several codes in its kind is left out; of several spellings that fold alike, the first stays. Null and blank aliases are none.
    """
    texts = [(F.col(name), "phrase"), (F.when(F.contains(F.col(name), F.lit(",")), F.substring_index(name, ",", 1)), "phrase"), *((F.col(c), "exact_code") for c in (code, *codes))]
    each = F.inline(F.array(*(F.struct(text.cast("string").alias("text"), F.lit(kind).alias("kind")) for text, kind in texts)))
    rows = entities.select(F.col(code).alias("code"), each)
    if reviewed is not None:
        rows = rows.unionByName(reviewed.select("code", F.col("alias").alias("text"), "kind"))
    folded = rows.where("text IS NOT NULL AND code IS NOT NULL").distinct().select("code", "kind", fold_text(F.col("text")).alias("alias"), cased_text(F.col("text")).alias("cased_alias"))
    found = folded.where("alias <> ''").groupBy("alias", "kind").agg(F.min("code").alias("code"), F.max("code").alias("__last"), F.min("cased_alias").alias("cased_alias"))
    return found.where("code = __last").select("code", "alias", "cased_alias", "kind")


def region_aliases(regions: DataFrame, code: str = "code", region: str = "region_code", name: str = "name") -> DataFrame:
    """Names and codes of regions as aliases (code, alias, cased_alias, kind) of their countries; one that means several countries is left out, of equal ones the first region's stays."""
    each = F.inline(F.array(F.struct(F.col(name).alias("text"), F.lit("phrase").alias("kind")), F.struct(F.col(region).alias("text"), F.lit("exact_code").alias("kind"))))
    rows = regions.select(F.col(code).alias("code"), F.col(region).alias("__region"), F.col(name).alias("__name"), each).where("code IS NOT NULL AND TRIM(text) <> ''")
    texts = rows.select("text").distinct().select("text", fold_text(F.col("text")).alias("alias"), cased_text(F.col("text")).alias("cased_alias"))
    found = rows.join(texts, "text").where("alias <> ''").groupBy("alias", "kind").agg(F.min("code").alias("code"), F.max("code").alias("__last"), F.min_by("cased_alias", F.struct("code", "__region", "__name")).alias("cased_alias"))
    return found.where("code = __last").select("code", "alias", "cased_alias", "kind")


def group_aliases(groups: DataFrame) -> DataFrame:
    """Aliases (group_code, alias, cased_alias, is_code) that mean one group, of rows (group_code, alias); codes are 2 to 8 capitals and digits."""
    rows = groups.where("group_code IS NOT NULL AND TRIM(alias) <> ''").select("group_code", F.col("alias").alias("text")).distinct()
    rows = rows.select("group_code", fold_text(F.col("text")).alias("alias"), cased_text(F.col("text")).alias("cased_alias"), F.col("text").rlike("^[A-Z0-9]{2,8}$").alias("is_code"))
    found = rows.where("alias <> ''").groupBy("alias").agg(F.min("group_code").alias("group_code"), F.max("group_code").alias("__last"), F.min_by("cased_alias", F.struct("group_code", "cased_alias")).alias("cased_alias"), F.max("is_code").alias("is_code"))
    return found.where("group_code = __last").select("group_code", "alias", "cased_alias", "is_code")


def prepare_texts(evidence: DataFrame, raw: str = "raw_value", path: str = "path") -> DataFrame:
    """``evidence`` with ``folded``, ``written`` and ``cased`` text (null as empty) and ``object``, the path without the field of an address or a name at its end.

    ``written`` has the words of ``folded``, before their case is folded. Only distinct texts are folded.
    """
    rows = evidence.withColumn("__text", F.coalesce(F.col(raw), F.lit("")))
    texts = rows.select("__text").distinct()
    words = F.trim(F.regexp_replace(_decomposed(F.col("__text")), r"[^\p{L}\p{N}]+", " "))
    texts = texts.select("__text", fold_text(F.col("__text")).alias("folded"), words.alias("written"), cased_text(F.col("__text")).alias("cased"))
    parent = F.regexp_replace(F.lower(F.coalesce(F.col(path), F.lit(""))), _FIELD, "")
    return rows.join(merged(texts), "__text").drop("__text").withColumn("object", parent)


#: Roles that tell of a place; of these the ones that restrict if they are their own source; and platforms whose places restrict.
LOCATION_ROLES = ("JOB_LOCATION", "PLATFORM_JOB_LOCATION", "BAMBOOHR_CAREERS_LIST", "BREEZY_META", "GREENHOUSE_REMIX", "JAZZHR_VISIBLE_HTML", "JOBVITE_PRELOADED_DATA", "NEXTJS", "PERSONIO_VISIBLE_HTML", "SMARTRECRUITERS_MICRODATA", "WORKABLE_WIDGET")
PLATFORM_ROLES = LOCATION_ROLES[2:]
PLATFORMS = ("ashby", "bamboohr", "breezy", "greenhouse", "jazzhr", "jobvite", "lever", "personio", "rippling", "smartrecruiters", "workable")
REMOTE_PLATFORMS = ("lever", "workday")


def flag_roles(evidence: DataFrame) -> DataFrame:
    """``evidence`` with location_role (it tells of a place) and restricting (that place limits who may apply); null if nothing is known counts as not.

    Needs role, source_system, platform, scope (of the subject), remote_scope and can_restrict.
    """
    platform = F.lower(F.coalesce("platform", F.lit("")))
    place = F.col("role") == "JOB_LOCATION"
    reviewed = ((F.col("role") == "PLATFORM_JOB_LOCATION") & platform.isin(*PLATFORMS)) | ((F.col("role") == F.col("source_system")) & F.col("role").isin(*PLATFORM_ROLES))
    remote = place & F.col("remote_scope").isin("REMOTE", "HYBRID") & platform.isin(*REMOTE_PLATFORMS)
    limits = (place & (F.col("remote_scope") == "ONSITE")) | (F.coalesce("can_restrict", F.lit(False)) & (F.coalesce(reviewed, F.lit(False)) | remote))
    sure = lambda c: F.coalesce(c, F.lit(False))
    return evidence.withColumns({"location_role": sure(F.col("role").isin(*LOCATION_ROLES)), "restricting": sure(~F.col("scope").isin("GLOBAL", "GLOBAL_EXCEPT") & limits)})


#: What a whole text is looked up as, and the source that a match by it has.
ATOMIC = {"COUNTRY": "ATOMIC_COUNTRY_ALIAS", "GROUP": "ATOMIC_COUNTRY_GROUP_ALIAS", "REVIEWED": "REVIEWED_LOCATION_COUNTRY_ALIAS", "GLOBAL": "REVIEWED_GLOBAL_LOCATION_ALIAS"}


def atomic_aliases(aliases: DataFrame, groups: DataFrame, reviewed: DataFrame, worldwide: DataFrame) -> DataFrame:
    """One table (target, alias, code, group_code, platform) of all that a whole text may mean.

    ``reviewed`` has code, alias and platform (null: any), ``worldwide`` alias and platform; their aliases are folded here, blank ones and places of the world without a platform are none.
    """
    null = F.lit(None).cast("string")
    folded = fold_text(F.col("alias")).alias("alias")
    platform = F.nullif(F.lower(F.trim("platform")), F.lit("")).alias("platform")
    of = lambda target: F.lit(target).alias("target")
    own = aliases.select(of("COUNTRY"), "alias", "code", null.alias("group_code"), null.alias("platform"))
    own = own.unionByName(groups.select(of("GROUP"), "alias", null.alias("code"), "group_code", null.alias("platform")))
    own = own.unionByName(reviewed.select(of("REVIEWED"), folded, "code", null.alias("group_code"), platform))
    own = own.unionByName(worldwide.select(of("GLOBAL"), folded, null.alias("code"), null.alias("group_code"), platform).where("platform IS NOT NULL"))
    return own.where("alias <> ''").distinct()


def atomic_match(evidence: DataFrame, known: DataFrame) -> DataFrame:
    """What whole texts mean (evidence_id, target, alias, code, group_code, match_source), by one join on (target, text).

    A text is looked up as a country or a group if ``mode`` or ``group_mode`` is ATOMIC, as a reviewed place if it is restricting, and as a place
    of the whole world always; aliases of a platform hold there only. Evidence of the whole world has no other match.
    """
    ask = lambda when, target: F.when(when, F.lit(target))
    asked = F.array_compact(F.array(ask(F.col("mode") == "ATOMIC", "COUNTRY"), ask(F.col("group_mode") == "ATOMIC", "GROUP"), ask(F.col("restricting"), "REVIEWED"), F.lit("GLOBAL")))
    rows = evidence.where("folded <> ''").select(ID, F.col("folded").alias("alias"), F.lower(F.coalesce("platform", F.lit(""))).alias("__platform"), F.explode(asked).alias("target"))
    met = rows.join(hashed(known), ["target", "alias"]).where(F.col("platform").isNull() | (F.col("platform") == F.col("__platform")))
    source = F.create_map(*(F.lit(x) for kv in ATOMIC.items() for x in kv))[F.col("target")]
    each = met.groupBy(ID).agg(F.collect_set(F.struct("target", "alias", "code", "group_code", source.alias("match_source"))).alias("__m"))
    world = F.exists("__m", lambda m: m["target"] == "GLOBAL")
    return each.select(ID, F.inline(F.filter("__m", lambda m: (m["target"] == "GLOBAL") | ~world)))


#: What each role says of places (direction, how codes and groups are matched), and whether a global scope and ``can_restrict`` bear on it.
ROLES = {
    "APPLICANT_LOCATION_REQUIREMENTS": ("INCLUDED", "ATOMIC", "ATOMIC", True, True),
    "LLM_EXCLUDED_COUNTRY": ("EXCLUDED", "ATOMIC", "NONE", False, False),
    "LLM_EXCLUDED_GROUP": ("EXCLUDED", "NONE", "ATOMIC", False, False),
    "LLM_GLOBAL_SCOPE": ("UNKNOWN", "NONE", "NONE", True, False),
    "LLM_INCLUDED_COUNTRY": ("INCLUDED", "ATOMIC", "NONE", False, False),
    "LLM_INCLUDED_GROUP": ("INCLUDED", "NONE", "ATOMIC", False, False),
    "NORMALIZED_TEXT": ("INCLUDED", "TEXT", "TEXT", True, True),
    "SOURCE_DEFAULT_COUNTRY_ELIGIBILITY": ("INCLUDED", "ATOMIC", "ATOMIC", True, True),
}


def direct(evidence: DataFrame, roles: dict[str, tuple] = ROLES) -> DataFrame:
    """``evidence`` with its ``direction`` and the modes ``mode`` and ``group_mode`` (ATOMIC, TEXT or NONE) in which codes and groups are looked for.

    Needs role, path, scope, can_restrict, and the flags global_place, restricting and location_role. The flags go
    before the role, in this order. Roles that aren't listed, or null, are UNKNOWN and match nothing; a null flag is
    false, a null ``can_restrict`` true. The roles are literals of the plan, not a join.
    """
    policy = F.create_map(*(x for role, (way, codes, groups, scoped, limited) in roles.items() for x in (F.lit(role), F.struct(F.lit(way).alias("way"), F.lit(codes).alias("codes"), F.lit(groups).alias("groups"), F.lit(scoped).alias("scoped"), F.lit(limited).alias("limited")))))
    own = policy[F.col("role")]
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    worldwide = own["scoped"] & F.col("scope").isin("GLOBAL", "GLOBAL_EXCEPT")
    silent = own["limited"] & ~F.coalesce(F.col("can_restrict"), F.lit(True))
    said = F.when(worldwide, "GLOBAL").when(silent, "UNKNOWN").otherwise(F.coalesce(own["way"], F.lit("UNKNOWN")))
    direction = F.when(flag("global_place"), "GLOBAL").when(flag("restricting"), "INCLUDED").when(flag("location_role"), "UNKNOWN").otherwise(said)
    stated = (F.col("role") == "JOB_LOCATION") & F.endswith(F.lower("path"), F.lit(".addresscountry"))
    placed = F.when(F.coalesce(stated, F.lit(False)), "ATOMIC").otherwise("TEXT")
    mode = lambda c: F.when(flag("restricting"), placed).otherwise(F.coalesce(own[c], F.lit("NONE")))
    return evidence.withColumns({"direction": direction, "mode": mode("codes"), "group_mode": mode("groups")})


def subdivision_match(evidence: DataFrame, subdivisions: DataFrame, raw: str = "raw_value") -> DataFrame:
    """Regions (code, alias, cased_alias, kind) named in ``cased``: a phrase as written, or a code such as AB-12 in ``raw``.

    Codes are taken out of the text first and meet the regions in an equality join.
    """
    phrases = phrase_match(evidence, "cased", subdivisions.where("kind = 'phrase'"), "cased_alias", ID)
    coded = subdivisions.where("kind = 'exact_code'").withColumn("__found", F.replace("cased_alias", F.lit(" "), F.lit("-")))
    named = evidence.withColumn("__found", F.explode(F.array_distinct(F.regexp_extract_all(_decomposed(F.col(raw)), F.lit(_CODE), F.lit(1)))))
    codes = named.join(hashed(coded), "__found").drop("__found")
    pad = lambda c: _padded(F.replace(F.col(c), F.lit(" "), F.lit("  ")))
    return phrases.unionByName(codes.withColumn("n_matches", occurrences(pad("cased"), pad("cased_alias"))))


def accept_subdivisions(found: DataFrame, countries: DataFrame) -> DataFrame:
    """Regions that are certain: by code, beside their country, holding another country's name, or ending a restricting location.

    A region inside a longer one of another country is none.
    """
    named = countries.where("kind = 'phrase'").select(ID, F.col("code").alias("__code"), F.col("alias").alias("__alias"))
    key = [ID, "code", "alias", "kind"]
    own = F.col("__code") == F.col("code")
    context = found.select(*key).distinct().join(merged(named), ID, "left").groupBy(*key).agg(
        F.coalesce(F.max(own), F.lit(False)).alias("__parent"),
        F.coalesce(F.max(~own & _within(F.col("alias"), F.col("__alias"))), F.lit(False)).alias("__holds"),
    )
    ends = (F.col("kind") == "phrase") & F.col("restricting") & (F.col("cased") != F.col("cased_alias")) & F.endswith(F.col("cased"), F.concat(F.lit(" "), F.col("cased_alias")))
    certain = (F.col("kind") == "exact_code") | F.col("__parent") | F.col("__holds") | F.coalesce(ends, F.lit(False))
    return drop_contained(found, [ID], "alias", "code").join(merged(context), key).where(certain).drop("__parent", "__holds")


def _places(words: Column, phrase: Column) -> Column:
    """Where a phrase's words begin among others, from 1."""
    n = F.size(phrase)
    at = F.filter(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.slice(words, i, n) == phrase)
    return F.when(n <= F.size(words), at).otherwise(F.array().cast("array<int>"))


def unexplained(countries: DataFrame, subdivisions: DataFrame) -> DataFrame:
    """Country matches with a mention that lies within no name of another country's region.

    Mentions and names are places among the words of ``folded``; a region's place counts if its words in ``written`` are those of ``cased_alias``.
    """
    words = lambda c: F.split(F.col(c), " ")
    n = F.size(words("alias"))
    as_written = lambda i: F.trim(F.regexp_replace(F.array_join(F.slice(words("written"), i, n), " "), "[^A-Za-z0-9]+", " ")) == F.col("cased_alias")
    spans = F.transform(F.filter(_places(words("folded"), words("alias")), as_written), lambda i: F.struct(i.alias("begin"), (i + n).alias("end")))
    regions = subdivisions.select(ID, F.col("code").alias("__code"), F.col("alias").alias("__alias"), spans.alias("__spans"))
    key = [ID, "code", "alias"]
    pairs = countries.select(*key).distinct().join(merged(regions), ID).where((F.col("__code") != F.col("code")) & _within(F.col("__alias"), F.col("alias")))
    inside = pairs.groupBy(*key).agg(F.flatten(F.collect_set("__spans")).alias("__inside"))
    rest = drop_contained(countries, [ID], "alias", "code").join(merged(inside), key, "left")
    covered = lambda i: F.exists("__inside", lambda s: (s["begin"] <= i) & (i + n <= s["end"]))
    return rest.where(F.col("__inside").isNull() | F.exists(_places(words("folded"), words("alias")), lambda i: ~covered(i))).drop("__inside")


def structured_context(evidence: DataFrame, aliases: DataFrame, roles: tuple[str, ...], suffix: str = ".addresscountry") -> DataFrame:
    """Codes (subject, role, object, code) that structured fields of an object state outright."""
    stated = evidence.where(F.col("role").isin(*roles) & F.endswith(F.lower("path"), F.lit(suffix)))
    return stated.join(hashed(aliases.select("code", F.col("alias").alias("folded"))), "folded").select("subject", "role", "object", "code").distinct()


def distrusted_aliases(observed: DataFrame, context: DataFrame) -> DataFrame:
    """Aliases (code, alias) that more subjects use beside another code than beside their own.

    This depends on all rows: new ones can change old matches. Subjects are first reduced to a row for each alias.
    """
    beside = observed.select("subject", "role", "object", "code", "alias").join(merged(context.withColumnRenamed("code", "__context")), ["subject", "role", "object"])
    own = F.col("__context") == F.col("code")
    subjects = beside.groupBy("code", "alias", "subject").agg(F.max(own).alias("own"), F.max(~own).alias("other"))
    return subjects.groupBy("code", "alias").agg(F.count_if("own").alias("own"), F.count_if("other").alias("other")).where("other > own").select("code", "alias")


def context_conflicts(candidates: DataFrame, conflicting: DataFrame, context: DataFrame) -> DataFrame:
    """Candidates (evidence_id, code, alias) with a distrusted alias and no context that supports it.

    ``conflicting`` has code, alias and location_only (for location roles only). ``mode`` TEXT takes support from
    anywhere in the subject, others from the same object.
    """
    kinds = conflicting.groupBy("code", "alias").agg(F.min("location_only").alias("location_only"))
    doubtful = candidates.join(hashed(kinds), ["code", "alias"]).where(~F.col("location_only") | F.col("location_role"))
    c = merged(context.select(F.col("subject").alias("__subject"), F.col("code").alias("__code"), F.col("object").alias("__object")).distinct())
    same = [("subject", "__subject"), ("code", "__code")]
    return disjunctive_join(doubtful, c, [(same, F.col("mode") == "TEXT"), ([*same, ("object", "__object")], None)], "left_anti").select(ID, "code", "alias").distinct()


def group_text_match(evidence: DataFrame, groups: DataFrame) -> DataFrame:
    """Groups named in a text: phrases folded, codes as written. Groups are those of :func:`group_aliases`."""
    cols = [*evidence.columns, "group_code"]
    phrases = phrase_match(evidence, "folded", groups.where("NOT is_code"), "alias", ID).select(*cols)
    return phrases.unionByName(phrase_match(evidence, "cased", groups.where("is_code"), "cased_alias", ID).select(*cols)).distinct()


def unmatched(evidence: DataFrame, matched: DataFrame, conflicts: DataFrame) -> DataFrame:
    """Restrictive evidence without a match, with ``match_source`` as the reason; what isn't ambiguous and may be a mere label becomes UNKNOWN."""
    rest = evidence.where(F.col("direction").isin("INCLUDED", "EXCLUDED")).join(merged(matched.select(ID)), ID, "left_anti")
    rest = rest.join(merged(conflicts.select(ID).distinct().withColumn("__conflict", F.lit(True))), ID, "left")
    located = F.coalesce(F.col("role") == "JOB_LOCATION", F.lit(False))
    labelled = F.coalesce(F.col("rule") == "location_shaped_remote_label", F.lit(False))
    reason = F.when(F.col("__conflict"), "AMBIGUOUS_COUNTRY_ALIAS").when(located, "UNKNOWN_OR_INVALID").when(labelled, "UNMATCHED_LOCATION_LABEL").otherwise("UNMATCHED_RESTRICTIVE_EVIDENCE")
    direction = F.when(F.col("__conflict").isNull() & (located | labelled), "UNKNOWN").otherwise(F.col("direction"))
    return rest.withColumns({"match_source": reason, "direction": direction}).drop("__conflict")


def combine_evidence(*parts: DataFrame) -> DataFrame:
    """One row for each evidence, direction, code and group; the first ``match_source`` in the alphabet stays."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return pick_first(rows, [ID, "direction", "code", "group_code"], [F.col("match_source")])


def null_ambiguous(matches: DataFrame) -> DataFrame:
    """Matches with the codes of evidence that has several taken away."""
    several = matches.groupBy(ID).agg((F.min("code") < F.max("code")).alias("__several"))
    code = F.when(~F.coalesce("__several", F.lit(False)), F.col("code"))
    return matches.join(merged(several), ID, "left").withColumn("code", code).drop("__several").distinct()


def rollup_eligibility(evidence: DataFrame, memberships: DataFrame, subject: str = "subject") -> DataFrame:
    """One row per subject: scope, sorted sets of eligible and excluded codes and of groups, and counts.

    Scope is SPECIFIC with any included code, else GLOBAL_EXCEPT or GLOBAL with global evidence, else UNKNOWN.
    Both aggregates combine before their shuffle, and sets are no larger than the number of codes.
    """
    is_in, is_out = F.col("direction") == "INCLUDED", F.col("direction") == "EXCLUDED"
    named = lambda when, col: F.array_sort(F.collect_set(F.when(when, F.col(col))))
    stats = evidence.groupBy(subject).agg(
        F.coalesce(F.max(F.col("direction") == "GLOBAL"), F.lit(False)).alias("has_global"),
        F.coalesce(F.max(F.col("direction") == "UNKNOWN"), F.lit(False)).alias("has_unknown"),
        F.count(F.lit(1)).alias("n_evidence"),
        F.count("code").alias("n_codes"),
        F.count("group_code").alias("n_groups"),
        named(is_in, "group_code").alias("included_groups"),
        named(is_out, "group_code").alias("excluded_groups"),
    )
    direct = evidence.where("code IS NOT NULL").select(subject, "direction", "code")
    members = evidence.where("group_code IS NOT NULL").select(subject, "direction", "group_code").join(hashed(memberships.select("group_code", "code")), "group_code").select(subject, "direction", "code")
    codes = direct.unionByName(members).groupBy(subject).agg(named(is_in, "code").alias("__in"), named(is_out, "code").alias("excluded"))
    none = F.array().cast("array<string>")
    out = stats.join(merged(codes), subject, "left").withColumns({"__in": F.coalesce("__in", none), "excluded": F.coalesce("excluded", none)})
    scope = F.when(F.size("__in") > 0, "SPECIFIC").when(F.col("has_global") & (F.size("excluded") > 0), "GLOBAL_EXCEPT").when(F.col("has_global"), "GLOBAL").otherwise("UNKNOWN")
    return out.withColumns({"scope": scope, "eligible": F.array_except("__in", "excluded")}).drop("__in")


def eligibility_bridge(rollup: DataFrame, subject: str = "subject") -> DataFrame:
    """A row (subject, code, relation) for each eligible and each excluded code."""
    tagged = lambda col, name: F.transform(col, lambda c: F.struct(c.alias("code"), F.lit(name).alias("relation")))
    return rollup.select(subject, F.inline(F.concat(tagged("eligible", "ELIGIBLE"), tagged("excluded", "EXCLUDED"))))
