"""Queries of evidence about regions: orders are evidence, their customers subjects, nations countries and regions of each other."""

from __future__ import annotations

from pyspark.sql import functions as F

from factline.operators import evidence, relational
from factline.plans import eligibility
from factline.plans.registry import query, split_columns

_TEXT = """CASE o_orderkey % 12 WHEN 0 THEN n_name WHEN 1 THEN concat('Remote, NEW ', shown) WHEN 2 THEN concat(shown, ' or NEW ', shown) WHEN 3 THEN concat('office x-C', (n_nationkey + 1) % 25, '-R', n_nationkey, ' only')
    WHEN 4 THEN concat('in new ', lower(shown)) WHEN 5 THEN r_name WHEN 6 THEN concat('teams in ', r_name, ', R', r_regionkey, ' and r', (r_regionkey + 1) % 5, ' or ', shown) WHEN 7 THEN concat('Hub  ', n_name) WHEN 8 THEN 'Anywhere!' WHEN 9 THEN concat('NEW ', shown, ', ', next_name) WHEN 11 THEN concat('c', n_nationkey) END"""
_COLUMNS = f"""o_orderkey AS evidence_id, o_custkey AS subject, {_TEXT} AS raw_value, CASE WHEN o_orderkey % 17 < 6 THEN '$.jobLocation.address.addressCountry' ELSE '$.jobLocation.name' END AS path,
    CASE o_orderkey % 7 WHEN 0 THEN 'JOB_LOCATION' WHEN 1 THEN 'APPLICANT_LOCATION_REQUIREMENTS' WHEN 2 THEN 'NORMALIZED_TEXT' WHEN 3 THEN 'LLM_EXCLUDED_COUNTRY' WHEN 4 THEN 'LLM_INCLUDED_GROUP' WHEN 5 THEN 'PLATFORM_JOB_LOCATION' ELSE 'JOB_LOCATION' END AS role,
    CASE o_orderkey % 5 WHEN 0 THEN 'Lever' WHEN 1 THEN 'other' WHEN 2 THEN 'lever' END AS platform, CASE o_custkey % 3 WHEN 0 THEN 'ONSITE' WHEN 1 THEN 'REMOTE' END AS remote_scope, CASE o_custkey % 13 WHEN 0 THEN 'GLOBAL' WHEN 1 THEN NULL ELSE 'SPECIFIC' END AS scope,
    CASE o_orderkey % 11 WHEN 0 THEN false WHEN 1 THEN NULL ELSE true END AS can_restrict, CASE o_orderkey % 19 WHEN 0 THEN 'location_shaped_remote_label' END AS rule"""

#: The same in SQL, step by step.
_FLOW = f"""WITH n AS (SELECT n.*, r_name, r_regionkey, m.n_name AS next_name, CASE WHEN n.n_nationkey % 4 = 2 THEN m.n_name ELSE n.n_name END AS shown, replace(lower(n.n_name), '_', ' ') AS folded_name, replace(n.n_name, '_', ' ') AS cased_name FROM nation n JOIN region ON n_regionkey = r_regionkey JOIN nation m ON m.n_nationkey = (n.n_nationkey + 1) % 25),
    raw AS (SELECT {_COLUMNS} FROM orders JOIN customer ON c_custkey = o_custkey JOIN n ON n_nationkey = c_nationkey),
    a AS (SELECT 'C' || n_nationkey AS code, folded_name AS alias, 'phrase' AS kind FROM n UNION ALL SELECT 'C' || n_nationkey, 'c' || n_nationkey, 'exact_code' FROM n),
    g AS (SELECT 'G' || r_regionkey AS group_code, replace(r_name, '_', ' ') AS text, false AS is_code FROM region UNION ALL SELECT 'GC' || r_regionkey, 'R' || r_regionkey, true FROM region UNION ALL SELECT 'GW', 'Anywhere', false),
    rg AS (SELECT 'C' || (n_nationkey + 1) % 25 AS code, 'NEW ' || cased_name AS cased, 'phrase' AS kind FROM n UNION ALL SELECT 'C' || (n_nationkey + 1) % 25, 'C' || (n_nationkey + 1) % 25 || ' R' || n_nationkey, 'exact_code' FROM n),
    t AS (SELECT *, trim(regexp_replace(lower(coalesce(raw_value, '')), '[^a-z0-9]+', ' ', 'g')) AS folded, trim(regexp_replace(coalesce(raw_value, ''), '[^A-Za-z0-9]+', ' ', 'g')) AS cased, lower(coalesce(platform, '')) AS pf, path LIKE '%addressCountry' AS stated FROM raw),
    f AS (SELECT *, role IN ('JOB_LOCATION', 'PLATFORM_JOB_LOCATION') AS location_role, coalesce(scope <> 'GLOBAL' AND (role = 'JOB_LOCATION' AND remote_scope = 'ONSITE' OR coalesce(can_restrict, false) AND (role = 'PLATFORM_JOB_LOCATION' AND pf = 'lever' OR role = 'JOB_LOCATION' AND remote_scope = 'REMOTE' AND pf = 'lever')), false) AS restricting FROM t),
    m AS (SELECT *, CASE WHEN restricting THEN CASE WHEN role = 'JOB_LOCATION' AND stated THEN 'ATOMIC' ELSE 'TEXT' END WHEN role IN ('APPLICANT_LOCATION_REQUIREMENTS', 'LLM_EXCLUDED_COUNTRY') THEN 'ATOMIC' WHEN role = 'NORMALIZED_TEXT' THEN 'TEXT' ELSE 'NONE' END AS mode,
        CASE WHEN restricting THEN CASE WHEN role = 'JOB_LOCATION' AND stated THEN 'ATOMIC' ELSE 'TEXT' END WHEN role IN ('APPLICANT_LOCATION_REQUIREMENTS', 'LLM_INCLUDED_GROUP') THEN 'ATOMIC' WHEN role = 'NORMALIZED_TEXT' THEN 'TEXT' ELSE 'NONE' END AS group_mode, folded = 'anywhere' AND pf = 'lever' AS world FROM f),
    am AS (SELECT evidence_id, 'GLOBAL' AS target, NULL AS code, NULL AS group_code FROM m WHERE world UNION ALL SELECT evidence_id, 'COUNTRY', code, NULL FROM m JOIN a ON folded = alias WHERE mode = 'ATOMIC' AND NOT world
        UNION ALL SELECT evidence_id, 'GROUP', NULL, group_code FROM m JOIN g ON folded = lower(text) WHERE group_mode = 'ATOMIC' AND NOT world
        UNION ALL SELECT evidence_id, 'REVIEWED', 'C' || n_nationkey, NULL FROM m JOIN n ON folded = 'hub ' || folded_name WHERE restricting AND (n_nationkey % 2 = 1 OR pf = 'lever')),
    p AS (SELECT *, CASE WHEN world THEN 'GLOBAL' WHEN restricting THEN 'INCLUDED' WHEN location_role THEN 'UNKNOWN' WHEN scope = 'GLOBAL' AND role IN ('APPLICANT_LOCATION_REQUIREMENTS', 'NORMALIZED_TEXT') THEN 'GLOBAL' WHEN role = 'LLM_EXCLUDED_COUNTRY' THEN 'EXCLUDED'
        WHEN role = 'LLM_INCLUDED_GROUP' THEN 'INCLUDED' WHEN coalesce(can_restrict, true) THEN 'INCLUDED' ELSE 'UNKNOWN' END AS direction FROM m),
    l AS (SELECT * FROM p WHERE direction IN ('INCLUDED', 'EXCLUDED')),
    cx AS (SELECT DISTINCT subject, role, '$.joblocation' AS object, code FROM p JOIN a ON folded = alias WHERE role IN ('JOB_LOCATION', 'APPLICANT_LOCATION_REQUIREMENTS') AND stated),
    ds AS (SELECT a.code, alias FROM p JOIN a ON kind = 'phrase' AND contains(' ' || folded || ' ', ' ' || alias || ' ') JOIN cx ON cx.subject = p.subject AND cx.role = p.role WHERE p.role IN ('JOB_LOCATION', 'APPLICANT_LOCATION_REQUIREMENTS') AND NOT stated
        GROUP BY a.code, alias HAVING count(DISTINCT CASE WHEN cx.code <> a.code THEN p.subject END) > count(DISTINCT CASE WHEN cx.code = a.code THEN p.subject END)),
    dt AS (SELECT code, alias, bool_and(lo) AS location_only FROM (SELECT code, alias, false AS lo FROM ds UNION ALL SELECT 'C' || n_nationkey, folded_name, true FROM n WHERE n_nationkey % 5 = 0) GROUP BY ALL),
    ex AS (SELECT l.*, code, alias FROM l JOIN a ON folded = alias WHERE mode = 'ATOMIC'),
    tx AS (SELECT l.*, code, alias FROM l JOIN a ON kind = 'phrase' AND contains(' ' || folded || ' ', ' ' || alias || ' ') WHERE mode = 'TEXT'),
    cf AS (SELECT DISTINCT evidence_id, c.code, c.alias FROM (SELECT * FROM ex UNION ALL SELECT * FROM tx) c JOIN dt USING (code, alias) WHERE (NOT location_only OR location_role) AND NOT EXISTS (SELECT 1 FROM cx WHERE cx.subject = c.subject AND cx.code = c.code)),
    tc AS (SELECT * FROM tx ANTI JOIN cf USING (evidence_id, code, alias)),
    rm AS (SELECT l.*, rg.code, lower(rg.cased) AS alias, rg.kind, rg.cased AS as_written FROM l JOIN rg ON rg.kind = 'phrase' AND contains(' ' || l.cased || ' ', ' ' || rg.cased || ' ') OR rg.kind = 'exact_code' AND regexp_matches(raw_value, '(^|[^A-Za-z0-9])' || replace(rg.cased, ' ', '-') || '([^A-Za-z0-9]|$)') WHERE mode = 'TEXT'),
    ra AS (SELECT * FROM rm WHERE kind = 'exact_code' OR EXISTS (SELECT 1 FROM tc WHERE tc.evidence_id = rm.evidence_id AND (tc.code = rm.code OR tc.code <> rm.code AND contains(' ' || rm.alias || ' ', ' ' || tc.alias || ' '))) OR restricting AND cased LIKE '% ' || as_written),
    lone AS (SELECT * FROM tc WHERE contains(lower(list_reduce(list_prepend(' ' || replace(cased, ' ', '  ') || ' ', coalesce((SELECT list(' ' || replace(as_written, ' ', '  ') || ' ') FROM ra WHERE ra.evidence_id = tc.evidence_id AND ra.code <> tc.code), [])), lambda x, y: replace(x, y, ' # '))), ' ' || replace(alias, ' ', '  ') || ' ')),
    gt AS (SELECT DISTINCT evidence_id, direction, group_code FROM l JOIN g ON CASE WHEN is_code THEN contains(' ' || cased || ' ', ' ' || text || ' ') ELSE contains(' ' || folded || ' ', ' ' || lower(text) || ' ') END WHERE group_mode = 'TEXT'),
    mt AS (SELECT evidence_id, code, NULL AS group_code, 'ATOMIC_COUNTRY_ALIAS' AS source FROM ex ANTI JOIN cf USING (evidence_id, code, alias) UNION ALL SELECT evidence_id, code, NULL, 'COUNTRY_TEXT_ALIAS' FROM lone UNION ALL SELECT evidence_id, code, NULL, 'COUNTRY_SUBDIVISION_TEXT_ALIAS' FROM ra
        UNION ALL SELECT evidence_id, code, group_code, CASE target WHEN 'GROUP' THEN 'ATOMIC_COUNTRY_GROUP_ALIAS' ELSE 'REVIEWED_LOCATION_COUNTRY_ALIAS' END FROM am JOIN l USING (evidence_id) WHERE target IN ('GROUP', 'REVIEWED') UNION ALL SELECT evidence_id, NULL, group_code, 'COUNTRY_GROUP_TEXT_ALIAS' FROM gt),
    ev AS (SELECT evidence_id, subject, direction, code, group_code, min(source) AS match_source FROM l JOIN mt USING (evidence_id) GROUP BY ALL
        UNION ALL SELECT evidence_id, subject, direction, NULL, NULL, CASE WHEN world THEN 'REVIEWED_GLOBAL_LOCATION_ALIAS' WHEN direction = 'GLOBAL' THEN 'GLOBAL_SCOPE' ELSE 'UNKNOWN_OR_INVALID' END FROM p WHERE direction IN ('GLOBAL', 'UNKNOWN')
        UNION ALL SELECT evidence_id, subject, CASE WHEN NOT c AND (role = 'JOB_LOCATION' OR rule IS NOT NULL) THEN 'UNKNOWN' ELSE direction END, NULL, NULL, CASE WHEN c THEN 'AMBIGUOUS_COUNTRY_ALIAS' WHEN role = 'JOB_LOCATION' THEN 'UNKNOWN_OR_INVALID' WHEN rule IS NOT NULL THEN 'UNMATCHED_LOCATION_LABEL' ELSE 'UNMATCHED_RESTRICTIVE_EVIDENCE' END
            FROM (SELECT *, evidence_id IN (SELECT evidence_id FROM cf) AS c FROM l WHERE evidence_id NOT IN (SELECT evidence_id FROM mt)))"""


def _nations(t):
    later = t("nation").select(((F.col("n_nationkey") + 24) % 25).alias("n_nationkey"), F.col("n_name").alias("next_name"))
    nations = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).join(later, "n_nationkey")
    return nations.withColumn("shown", F.when(F.col("n_nationkey") % 4 == 2, F.col("next_name")).otherwise(F.col("n_name")))  # some tell of their neighbour, whose name loses trust


def places(t) -> eligibility.Places:
    nations = _nations(t)
    countries = nations.selectExpr("CONCAT('C', n_nationkey) AS code", "n_name AS name")
    inner = nations.selectExpr("CONCAT('C', (n_nationkey + 1) % 25) AS code", "CONCAT('C', (n_nationkey + 1) % 25, '-R', n_nationkey) AS region_code", "CONCAT('NEW ', n_name) AS name")
    alike = nations.where("n_nationkey % 5 = 0").selectExpr("CONCAT('C', (n_nationkey + 2) % 25) AS code", "CONCAT('C', (n_nationkey + 2) % 25, '-S', n_nationkey) AS region_code", "n_name AS name")
    groups = t("region").selectExpr("CONCAT('G', r_regionkey) AS group_code", "r_name AS alias")
    codes = t("region").selectExpr("CONCAT('GC', r_regionkey) AS group_code", "CONCAT('R', r_regionkey) AS alias")
    world = t("region").limit(1).selectExpr("'GW' AS group_code", "'Anywhere' AS alias")
    reviewed = nations.selectExpr("CONCAT('C', n_nationkey) AS code", "CONCAT('hub ', n_name) AS alias", "IF(n_nationkey % 2 = 0, ' LEVER ', NULL) AS platform")
    members = nations.selectExpr("CONCAT('G', r_regionkey) AS group_code", "CONCAT('C', n_nationkey) AS code")
    return eligibility.Places(evidence.alias_table(countries), evidence.region_aliases(inner.unionByName(alike)), evidence.group_aliases(groups.unionByName(codes).unionByName(world)), reviewed, t("region").limit(1).selectExpr("'anywhere' AS alias", "'lever' AS platform"), members)


def raw_evidence(t):
    rows = t("orders").join(relational.merged(t("customer")), F.col("c_custkey") == F.col("o_custkey")).join(F.broadcast(_nations(t)), F.col("n_nationkey") == F.col("c_nationkey"))
    return rows.selectExpr(*split_columns(_COLUMNS)).withColumn("source_system", F.lit(None).cast("string"))


def _prepared(t):
    p = places(t)
    return p, *eligibility.prepare(raw_evidence(t), evidence.atomic_aliases(p.aliases, p.groups, p.reviewed, p.worldwide))


@query(f"{_FLOW} SELECT evidence_id, target, code, group_code FROM am")
def atomic_meanings(t):
    return _prepared(t)[2].select("evidence_id", "target", "code", "group_code")


@query(f"{_FLOW} SELECT evidence_id, code, alias, kind FROM rm")
def region_mentions(t):
    p, prepared, _ = _prepared(t)
    limited = prepared.where("direction IN ('INCLUDED', 'EXCLUDED') AND mode = 'TEXT'")
    usable = p.regions.join(p.aliases.select("alias", "kind"), ["alias", "kind"], "left_anti")
    return evidence.subdivision_match(limited, usable).select("evidence_id", "code", "alias", "kind")


@query(f"{_FLOW} SELECT subject, role, object, code FROM cx")
def stated_countries(t):
    p, prepared, _ = _prepared(t)
    return evidence.structured_context(prepared, p.aliases, eligibility.CONTEXT_ROLES)


@query(f"{_FLOW} SELECT evidence_id, group_code FROM gt")
def group_mentions(t):
    p, prepared, _ = _prepared(t)
    limited = prepared.where("direction IN ('INCLUDED', 'EXCLUDED') AND group_mode = 'TEXT'")
    return evidence.group_text_match(limited, p.groups).select("evidence_id", "group_code")


@query(f"{_FLOW} SELECT code, alias FROM ds")
def distrusted_names(t):
    return eligibility.resolve(raw_evidence(t), places(t)).distrusted


@query(f"{_FLOW} SELECT evidence_id, code, alias FROM cf")
def vetoed_matches(t):
    return eligibility.resolve(raw_evidence(t), places(t)).conflicts


@query(f"{_FLOW} SELECT evidence_id, code, kind FROM ra")
def accepted_regions(t):
    return eligibility.resolve(raw_evidence(t), places(t)).regions.select("evidence_id", "code", "kind")


@query(f"{_FLOW} SELECT evidence_id, code FROM lone")
def lone_countries(t):
    return eligibility.resolve(raw_evidence(t), places(t)).countries.select("evidence_id", "code")


@query(f"{_FLOW} SELECT evidence_id, direction, code, group_code, match_source FROM ev")
def resolved_evidence(t):
    return eligibility.resolve(raw_evidence(t), places(t)).evidence.select("evidence_id", "direction", "code", "group_code", "match_source")


@query(f"""{_FLOW}, mb AS (SELECT 'G' || r_regionkey AS group_code, 'C' || n_nationkey AS code FROM n),
    c AS (SELECT subject, direction, code FROM ev WHERE code IS NOT NULL UNION ALL SELECT subject, direction, mb.code FROM ev JOIN mb USING (group_code)),
    s AS (SELECT subject, count(*) AS n_evidence, bool_or(direction = 'GLOBAL') AS world, coalesce(list_sort(list(DISTINCT group_code) FILTER (direction = 'INCLUDED' AND group_code IS NOT NULL)), []) AS included_groups FROM ev GROUP BY subject),
    i AS (SELECT subject, list(DISTINCT code) FILTER (direction = 'INCLUDED') AS ins, list(DISTINCT code) FILTER (direction = 'EXCLUDED') AS outs FROM c GROUP BY subject),
    z AS (SELECT s.*, coalesce(ins, []) AS ins, list_sort(coalesce(outs, [])) AS excluded FROM s LEFT JOIN i USING (subject))
    SELECT subject, CASE WHEN len(ins) > 0 THEN 'SPECIFIC' WHEN world AND len(excluded) > 0 THEN 'GLOBAL_EXCEPT' WHEN world THEN 'GLOBAL' ELSE 'UNKNOWN' END AS scope, list_sort(list_filter(ins, lambda x: NOT list_contains(excluded, x))) AS eligible, excluded, included_groups, n_evidence FROM z""")
def subject_eligibility(t):
    return eligibility.eligibility(raw_evidence(t), places(t)).select("subject", "scope", "eligible", "excluded", "included_groups", "n_evidence")


@query("SELECT o_orderkey, n_nationkey FROM orders JOIN nation ON n_nationkey = o_custkey % 25 OR n_nationkey = o_orderkey % 25 AND o_orderstatus = 'F'")
def either_nation(t):
    rows = t("orders").select("o_orderkey", "o_orderstatus", (F.col("o_custkey") % 25).cast("int").alias("by_customer"), (F.col("o_orderkey") % 25).cast("int").alias("by_order"))
    branches = [([("by_customer", "n_nationkey")], None), ([("by_order", "n_nationkey")], F.col("o_orderstatus") == "F")]
    return relational.disjunctive_join(rows, t("nation"), branches).select("o_orderkey", "n_nationkey")
