"""The whole resolution of evidence, from raw rows to what each subject's evidence means."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factline.operators import evidence as ev
from factline.operators.relational import merged, phrase_match
from factline.sources.storage import write_shared

#: The roles whose structured fields are context.
CONTEXT_ROLES = ("APPLICANT_LOCATION_REQUIREMENTS", "JOB_LOCATION")
_FIELD = ".addresscountry"


@dataclass(frozen=True)
class Places:
    """What texts may mean: ``aliases`` (:func:`~factline.operators.evidence.alias_table`), ``regions`` (``region_aliases``), ``groups`` (``group_aliases``),
    reviewed places (code, alias, platform), places of the whole world (alias, platform), and ``members`` of groups (group_code, code)."""

    aliases: DataFrame
    regions: DataFrame
    groups: DataFrame
    reviewed: DataFrame
    worldwide: DataFrame
    members: DataFrame


@dataclass(frozen=True)
class Resolution:
    """The steps' results; ``evidence`` is all of them together, a row for each evidence and meaning."""

    prepared: DataFrame
    atomic: DataFrame
    context: DataFrame
    distrusted: DataFrame
    conflicts: DataFrame
    regions: DataFrame
    countries: DataFrame
    groups: DataFrame
    evidence: DataFrame


def prepare(raw: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Evidence with texts, flags, direction and modes, and what whole texts mean; both written, as every later step reads them."""
    rows = ev.direct(ev.flag_roles(ev.prepare_texts(raw)).withColumn("global_place", F.lit(False)))
    rows = write_shared(rows, "evidence")
    atomic = write_shared(ev.atomic_match(rows, known), "atomic")
    world = atomic.where("target = 'GLOBAL'").select(ev.ID, F.lit(True).alias("__world")).distinct()
    placed = rows.join(merged(world), ev.ID, "left").withColumn("global_place", F.coalesce("__world", F.lit(False))).drop("__world")
    return write_shared(placed.withColumn("direction", F.when(F.col("global_place"), "GLOBAL").otherwise(F.col("direction"))), "evidence"), atomic


def observed_aliases(prepared: DataFrame, aliases: DataFrame) -> DataFrame:
    """Names of countries in what stands beside structured fields."""
    beside = prepared.where(F.col("role").isin(*CONTEXT_ROLES) & ~F.coalesce(F.endswith(F.lower("path"), F.lit(_FIELD)), F.lit(False)))
    return phrase_match(beside, "folded", aliases.where("kind = 'phrase'"), "alias", ev.ID)


def resolve(raw: DataFrame, places: Places, distrusted: DataFrame | None = None) -> Resolution:
    """All steps over ``raw`` evidence: evidence_id, subject, role, source_system, platform, scope, remote_scope, can_restrict, rule, path and raw_value.

    Every step but one looks at a subject's own rows, so that a subset of subjects gives what all give for it. The exception are
    distrusted aliases, which depend on all subjects: give those of all (``distrusted``) with a subset.
    """
    phrases = places.aliases.where("kind = 'phrase'")
    prepared, atomic = prepare(raw, ev.atomic_aliases(places.aliases, places.groups, places.reviewed, places.worldwide))
    limited = prepared.where(F.col("direction").isin("INCLUDED", "EXCLUDED"))
    context = write_shared(ev.structured_context(prepared, places.aliases, CONTEXT_ROLES), "context")
    if distrusted is None:
        distrusted = ev.distrusted_aliases(observed_aliases(prepared, places.aliases), context)
    distrusted = write_shared(distrusted, "distrusted")

    texts = write_shared(phrase_match(limited.where("mode = 'TEXT'"), "folded", phrases, "alias", ev.ID), "named")
    exact = limited.where("mode = 'ATOMIC'").join(merged(atomic.where("target = 'COUNTRY'").select(ev.ID, "alias", "code", "match_source")), ev.ID)
    collisions = phrases.join(places.regions.where("kind = 'phrase'").select("alias", F.col("code").alias("__code")), "alias").where("code <> __code").select("code", "alias").distinct()
    doubtful = distrusted.withColumn("location_only", F.lit(False)).unionByName(collisions.withColumn("location_only", F.lit(True)))
    candidates = [x.select(ev.ID, "subject", "object", "mode", "location_role", "code", "alias") for x in (exact, texts)]
    conflicts = write_shared(ev.context_conflicts(candidates[0].unionByName(candidates[1]), doubtful, context), "conflicts")

    key = [ev.ID, "code", "alias"]
    texts = write_shared(texts.join(merged(conflicts), key, "left_anti"), "named")
    usable = places.regions.join(places.aliases.select("alias", "kind"), ["alias", "kind"], "left_anti")
    regions = write_shared(ev.accept_subdivisions(write_shared(ev.subdivision_match(limited.where("mode = 'TEXT'"), usable), "regions"), texts), "regions")
    countries = ev.unexplained(texts, regions)
    groups = ev.group_text_match(limited.where("group_mode = 'TEXT'"), places.groups)

    cols = prepared.columns
    null = F.lit(None).cast("string")
    sourced = lambda df, code, group, source: df.select(*cols, code.alias("code"), group.alias("group_code"), source.alias("match_source"))
    code, group, source = F.col("code"), F.col("group_code"), F.col("match_source")
    whole = limited.join(merged(atomic.where("target IN ('GROUP', 'REVIEWED')")), ev.ID)
    matched = [
        sourced(exact.join(merged(conflicts), key, "left_anti"), code, null, source),
        sourced(countries, code, null, F.lit("COUNTRY_TEXT_ALIAS")),
        sourced(regions, code, null, F.lit("COUNTRY_SUBDIVISION_TEXT_ALIAS")),
        sourced(whole, code, group, source),
        sourced(groups, null, group, F.lit("COUNTRY_GROUP_TEXT_ALIAS")),
    ]
    matched = write_shared(ev.combine_evidence(*matched), "matched")
    open_ended = F.when(F.col("global_place"), ev.ATOMIC["GLOBAL"]).when(F.col("direction") == "GLOBAL", "GLOBAL_SCOPE").otherwise("UNKNOWN_OR_INVALID")
    others = sourced(prepared.where(F.col("direction").isin("GLOBAL", "UNKNOWN")), null, null, open_ended)
    rest = ev.unmatched(limited, matched, conflicts).withColumns({"code": null, "group_code": null})
    return Resolution(prepared, atomic, context, distrusted, conflicts, regions, countries, groups, others.unionByName(matched).unionByName(rest.select(*others.columns)))


def eligibility(raw: DataFrame, places: Places, distrusted: DataFrame | None = None) -> DataFrame:
    """What the evidence of each subject comes to, in one call from raw rows."""
    return ev.rollup_eligibility(resolve(raw, places, distrusted).evidence, places.members)


def refresh(raw: DataFrame, places: Places, changed: DataFrame, previous: DataFrame, distrusted_before: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(eligibility, distrusted aliases) after the subjects in ``changed`` have; ``previous`` and ``distrusted_before`` are what the last call gave.

    Distrust is counted anew over all rows. Besides the changed subjects, those are resolved again that name an alias whose
    trust has changed; all others keep their row.
    """
    prepared, _ = prepare(raw, ev.atomic_aliases(places.aliases, places.groups, places.reviewed, places.worldwide))
    context = ev.structured_context(prepared, places.aliases, CONTEXT_ROLES)
    distrusted = write_shared(ev.distrusted_aliases(observed_aliases(prepared, places.aliases), context), "distrusted")
    before = distrusted_before.select("code", "alias")
    turned = distrusted.join(before, ["code", "alias"], "left_anti").unionByName(before.join(distrusted, ["code", "alias"], "left_anti"))
    naming = phrase_match(prepared.select(ev.ID, "subject", "folded"), "folded", turned.select("alias").distinct(), "alias", ev.ID).select("subject")
    due = write_shared(changed.select("subject").unionByName(naming).distinct(), "due")
    fresh = eligibility(raw.join(merged(due), "subject", "left_semi"), places, distrusted)
    return previous.join(merged(due), "subject", "left_anti").unionByName(fresh), distrusted
