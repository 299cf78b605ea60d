"""Queries of landed files, payload fields, usage reports, companies and state tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from factline.functions import text, typed
from factline.operators import facts, incremental
from factline.plans import usage
from factline.plans.registry import query, real, split_columns
from factline.sources import landing
from factline.sources.storage import shared_dir
from factline.streaming.receipts import received, stream_receipts
from factline.streaming.upserts import stream_upsert

# Landed files

_AMOUNT = "CASE WHEN o_orderkey % 50 = 3 THEN 'n/a' WHEN o_orderkey % 70 = 5 THEN '' ELSE concat('\"', o_custkey, '\"') END"


def _landed(t):
    """Orders as CSV files of a thousand keys, in order, with a blank line now and then, some amounts of which are none or no number."""
    rows = t("orders").selectExpr("o_orderkey", "CAST(FLOOR(o_orderkey / 1000) AS INT) AS file", f"IF(o_orderkey % 40 = 7, ' ', CONCAT(o_orderkey, ',', {_AMOUNT}, ',', o_orderpriority)) AS value")
    head = rows.select("file").distinct().selectExpr("CAST(-1 AS BIGINT) AS o_orderkey", "file", "'id,amount, note ' AS value")
    path = f"{shared_dir(rows.sparkSession)}/orders-{uuid.uuid4().hex}"
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # files are many and small: by their size they would come to a few tasks
    dealt = rows.unionByName(head).repartition(tasks, "file").sortWithinPartitions("file", "o_orderkey").select("file", "value")
    dealt.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("file").text(path)  # tasks move their files themselves; nobody reads before the end
    return landing.read_csv_lines(rows.sparkSession, path).withColumn("file", F.regexp_extract("_file", r"file=(\d+)/", 1).cast("int"))


_PLANTED = f"SELECT *, (o_orderkey // 1000)::INT AS file, 1 + row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) AS line, {_AMOUNT} AS amount FROM orders"


@query(f"SELECT file, line, [CASE WHEN o_orderkey % 50 = 3 THEN 'amount is no bigint' ELSE 'amount is required' END] AS errors FROM ({_PLANTED}) WHERE o_orderkey % 40 <> 7 AND (o_orderkey % 50 = 3 OR o_orderkey % 70 = 5)")
def contract_errors(t):
    contract = {"id": ("bigint", True), "amount": ("bigint", True), "note": ("string", False)}
    _, rejected = landing.validate_contract(_landed(t), contract, fail_on_reject=False, at=("file", "_line"))
    return rejected.select("file", F.col("_line").alias("line"), F.col("_errors").alias("errors"))


@query(f"SELECT file, line, o_orderkey AS id, o_custkey AS amount, o_orderpriority AS note FROM ({_PLANTED}) WHERE o_orderkey % 40 <> 7 AND o_orderkey % 50 <> 3 AND o_orderkey % 70 <> 5")
def numbered_rows(t):
    contract = {"id": ("bigint", True), "amount": ("bigint", True), "note": ("string", False)}
    valid, _ = landing.validate_contract(_landed(t), contract, fail_on_reject=False, at=("file", "_line"))
    return valid.withColumnRenamed("_line", "line")


@query("SELECT n_nationkey AS code, CASE WHEN n_nationkey % 5 = 0 THEN 'NA' WHEN n_nationkey % 5 = 1 THEN NULL ELSE n_name END AS name, lpad(n_nationkey::VARCHAR, 3, '0') AS number FROM nation")
def seeded_nations(t):
    rows = t("nation").selectExpr("n_nationkey AS code", "CASE WHEN n_nationkey % 5 = 0 THEN 'NA' WHEN n_nationkey % 5 = 1 THEN NULL ELSE n_name END AS name", "LPAD(n_nationkey, 3, '0') AS number")
    path = landing.table_path(shared_dir(rows.sparkSession), "test", "seeds", f"nations-{uuid.uuid4().hex}")
    rows.write.option("header", True).option("nullValue", "").csv(path)
    return landing.read_seed(rows.sparkSession, path, "code int, name string, number string")


# Payloads

_PAYLOAD = "CASE p_partkey % 6 WHEN 0 THEN concat('{\"n\": ', p_size, ', \"o\": {\"b\": true}}') WHEN 1 THEN '{\"n\": null}' WHEN 2 THEN '{\"m\": 1, \"o\": {\"b\": null}}' WHEN 3 THEN '{\"n\": \"many\", \"o\": {}}' WHEN 4 THEN 'broken {' END"


@query("SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'VALUE' WHEN 1 THEN 'NULL' WHEN 3 THEN 'VALUE' ELSE 'ABSENT' END AS n_state, CASE p_partkey % 6 WHEN 0 THEN p_size WHEN 1 THEN 0 WHEN 3 THEN 0 END AS n, CASE p_partkey % 6 WHEN 0 THEN 'VALUE' WHEN 2 THEN 'NULL' ELSE 'ABSENT' END AS b_state, CASE p_partkey % 6 WHEN 0 THEN true WHEN 2 THEN false END AS b FROM part")
def payload_states(t):
    rows = t("part").withColumn("payload", F.expr(_PAYLOAD))
    p = F.col("payload")
    return rows.select("p_partkey", typed.json_state(p, "$.n").alias("n_state"), typed.json_guarded(p, "$.n", "int", 0).alias("n"), typed.json_state(p, "$.o.b").alias("b_state"), typed.json_guarded(p, "$.o.b", "boolean", False).alias("b"))


_SELECTED = "CASE o_orderkey % 6 WHEN 0 THEN ' selected' WHEN 1 THEN 'SKIPPED_KNOWN_URL' WHEN 2 THEN 'skipped_duplicate_url_identity' WHEN 3 THEN 'SKIPPED_SELECTION_LIMIT' WHEN 4 THEN 'else' END"


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN upper(o_orderpriority) ELSE CASE upper(trim({_SELECTED})) WHEN 'SELECTED' THEN 'NEW_URL_SELECTED' WHEN 'SKIPPED_KNOWN_URL' THEN 'KNOWN_URL_IDENTITY' WHEN 'SKIPPED_DUPLICATE_URL_IDENTITY' THEN 'DUPLICATE_WITHIN_SOURCE_CRAWL' WHEN 'SKIPPED_SELECTION_LIMIT' THEN 'SELECTION_LIMIT_REACHED' ELSE 'UNKNOWN_SELECTION_STATUS' END END AS reason FROM orders")
def selection_reasons(t):
    return t("orders").select("o_orderkey", text.stated_reason(F.expr("IF(o_orderkey % 7 = 0, CONCAT(o_orderpriority, ' '), NULL)"), F.expr(_SELECTED)).alias("reason"))


_SHOWN = "CASE p_partkey % 5 WHEN 0 THEN concat('Straße ', p_size % 7) WHEN 1 THEN concat('STRASSE—', p_size % 7) WHEN 2 THEN concat('ﬁne Ⅳ ', p_size % 7) WHEN 3 THEN concat('Fine  iv/', p_size % 7) ELSE concat('日本 ', p_size % 7, '!') END"


@query("SELECT CASE WHEN p_partkey % 5 IN (0, 1) THEN 'strasse ' WHEN p_partkey % 5 IN (2, 3) THEN 'fine iv ' ELSE '日本 ' END || p_size % 7 AS folded, count(*) AS n FROM part GROUP BY 1")
def folded_unicode(t):
    distinct = t("part").groupBy(F.expr(_SHOWN).alias("shown")).agg(F.count(F.lit(1)).alias("n"))
    return distinct.groupBy(text.fold_text(F.col("shown")).alias("folded")).agg(F.sum("n").alias("n"))


# Usage

_JOB = """o_orderdate AS creation_time, o_orderdate AS start_time, CASE WHEN o_orderkey % 9 = 0 THEN 'RUNNING' ELSE 'DONE' END AS state, CASE o_orderkey % 4 WHEN 0 THEN 'SELECT' WHEN 1 THEN 'SCRIPT' WHEN 2 THEN 'MERGE' END AS statement_type, CASE o_orderkey % 8 WHEN 3 THEN 'LOAD' END AS job_type,
    CASE WHEN o_orderstatus = 'F' THEN 'failed' END AS error_result, o_orderkey % 3 = 0 AS cache_hit, CASE WHEN o_orderkey % 5 > 0 THEN o_custkey * 1000 END AS total_bytes_processed, o_custkey * 1024 AS total_bytes_billed, o_custkey AS total_slot_ms, concat('select 1 from ', CASE WHEN o_orderkey % 6 = 0 THEN 'Facts.t' ELSE 'artifacts' END) AS query"""
_DEST = "CASE o_orderkey % 7 WHEN 0 THEN 'stg_orders' WHEN 1 THEN 'other' END", "CASE o_orderkey % 11 WHEN 0 THEN 'prod_marts' ELSE 'marts_old' END"
_REF = "CASE WHEN l_linenumber = 3 THEN 'int_lines' ELSE 'x' END", "CASE WHEN l_linenumber = 5 THEN 'dev_marts' ELSE 'y' END"


@query(f"""WITH l AS (SELECT l_orderkey AS k, bool_or(l_linenumber IN (3, 5)) AS ours, bool_or(l_linenumber = 2 AND l_returnflag = 'R') AS labelled FROM lineitem GROUP BY 1),
    j AS (SELECT {_JOB}, {_DEST[0]} AS t, {_DEST[1]} AS d, coalesce(ours, false) AS ours, coalesce(labelled, false) AS labelled FROM orders LEFT JOIN l ON k = o_orderkey)
    SELECT creation_time::DATE AS usage_date, coalesce(statement_type, job_type, 'UNKNOWN') AS workload_type, count(*) AS job_count, count(*) FILTER (error_result IS NULL) AS succeeded_job_count, count(error_result) AS failed_job_count, count(*) FILTER (cache_hit) AS cache_hit_count,
    coalesce(sum(total_bytes_processed), 0)::BIGINT AS total_bytes_processed, sum(total_bytes_billed)::BIGINT AS total_bytes_billed, sum(total_slot_ms)::BIGINT AS total_slot_ms, count(*) * 7000 AS total_duration_ms
    FROM j WHERE creation_time >= TIMESTAMP '1995-01-01' AND creation_time < TIMESTAMP '1997-01-01' AND state = 'DONE' AND coalesce(statement_type, '') <> 'SCRIPT' AND NOT labelled
    AND (regexp_matches(query, '(?i)(^|[^a-z0-9])facts([^a-z0-9]|$)') OR coalesce(t LIKE 'stg\\_%' ESCAPE '\\', false) OR d LIKE '%\\_marts' ESCAPE '\\' OR ours) GROUP BY ALL""")
def job_report(t):
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.collect_list(F.struct(F.when(F.col("l_linenumber") == 2, "operation").otherwise("other").alias("key"), F.col("l_returnflag").alias("value"))).alias("labels"),
        F.collect_list(F.struct(F.expr(_REF[0]).alias("table_id"), F.expr(_REF[1]).alias("dataset_id"))).alias("referenced_tables"),
    )
    jobs = t("orders").join(lines, "o_orderkey", "left").selectExpr(*split_columns(_JOB), "o_orderdate + INTERVAL 7 SECONDS AS end_time", "labels", "referenced_tables", f"STRUCT({_DEST[0]} AS table_id, {_DEST[1]} AS dataset_id) AS destination_table")
    day = lambda x: F.lit(x).cast("timestamp_ntz")
    scoped = usage.scoped_jobs(jobs, day("1995-01-01"), day("1997-01-01"), ("operation", "R"), r"(?i)(^|[^a-z0-9])facts([^a-z0-9]|$)", ("stg_", "int_"), ("_marts",))
    return usage.job_report(scoped)


@query("SELECT o_custkey % 50 AS run, sum(n)::BIGINT AS results, min(lo) AS shortest, max(hi) AS longest, floor(sum(s) / sum(n))::BIGINT AS average, list(o_orderstatus || ':' || n ORDER BY o_orderstatus) AS status_counts FROM (SELECT o_custkey % 50 AS r, * FROM (SELECT o_custkey % 50 AS o_custkey, o_orderstatus, count(*) AS n, min(o_orderkey) AS lo, max(o_orderkey) AS hi, sum(o_orderkey) AS s FROM orders GROUP BY 1, 2)) GROUP BY 1")
def build_runs(t):
    found = usage.build_summary(t("orders").withColumn("run", F.col("o_custkey") % 50), "run", "o_orderkey", "o_orderstatus")
    counts = F.transform("status_counts", lambda c: F.concat_ws(":", c["status"], c["n"]))
    return found.withColumns({"average": F.floor("average"), "status_counts": counts})


# Companies and served rows

_SERVED = """o_orderkey AS job_id, CASE WHEN o_custkey % 9 = 0 THEN ' ' ELSE concat(' Acme  ', CASE WHEN o_orderkey % 2 = 0 THEN 'Corp ' ELSE 'CORP' END, o_custkey % 40) END AS company_name, CASE o_custkey % 3 WHEN 0 THEN 'A.example ' WHEN 1 THEN 'b.EXAMPLE' END AS source_domain,
    o_orderstatus = 'F' AS is_deleted, o_orderdate AS latest_observed_at, CASE WHEN o_orderkey % 4 > 0 THEN o_orderdate END AS source_publication_at, o_orderdate AS source_updated_at, o_orderdate AS written_at"""
_COMPANY = f"""WITH s AS (SELECT {_SERVED} FROM orders), c AS (SELECT *, nullif(regexp_replace(lower(trim(company_name)), '\\s+', ' ', 'g'), '') AS n, nullif(lower(trim(source_domain)), '') AS d FROM s),
    k AS (SELECT *, CASE WHEN n IS NOT NULL AND d IS NOT NULL THEN 'company_' || left(sha256('{{"identity_version":"company_source_domain_v1","source_domain":"' || d || '","company_name":"' || n || '"}}'), 32) END AS company_id FROM c)"""


@query(f"{_COMPANY} SELECT job_id, n AS normalized_company_name, d AS domain, company_id FROM k")
def company_identities(t):
    return _served(t).select("job_id", "normalized_company_name", F.col("company_identity_source_domain").alias("domain"), "company_id")


@query(f"""{_COMPANY} SELECT company_id, arg_max(company_name, struct_pack(a := latest_observed_at, b := job_id)) FILTER (NOT is_deleted) AS company_name, arg_max(d, job_id) AS source_domain, count(*) FILTER (NOT is_deleted) AS open_job_count,
    min(source_publication_at) FILTER (NOT is_deleted) AS first_source_publication_at, min(latest_observed_at) FILTER (NOT is_deleted) AS first_observed_at, max(latest_observed_at) FILTER (NOT is_deleted) AS latest_observed_at, max(written_at) AS written_at, 64 AS hash_digits FROM k WHERE company_id IS NOT NULL GROUP BY 1 HAVING count(*) FILTER (NOT is_deleted) > 0""")
def open_companies(t):
    return facts.companies(_served(t)).select("company_id", "company_name", "source_domain", "open_job_count", "first_source_publication_at", "first_observed_at", "latest_observed_at", "written_at", F.length("row_hash").alias("hash_digits"))


def _served(t):
    return facts.with_company(t("orders").selectExpr(*split_columns(_SERVED)))


@query("SELECT o_orderkey AS job_id, l_returnflag AS code, o_orderpriority AS scope, count(*) OVER (PARTITION BY 1) AS rows FROM orders JOIN (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem) ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'F'")
def served_eligibility(t):
    bridge = t("lineitem").select(F.col("l_orderkey").alias("job_id"), F.col("l_returnflag").alias("code"), F.lit("ELIGIBLE").alias("relation")).distinct()
    serving = t("orders").selectExpr("o_orderkey AS job_id", "o_orderpriority AS scope", "o_orderstatus = 'F' AS is_deleted", "o_orderdate AS source_updated_at", "o_orderdate AS written_at")
    mart = facts.eligibility_mart(bridge, serving)
    total = mart.agg(F.count_distinct("row_hash").alias("rows"))
    return mart.select("job_id", "code", "scope").crossJoin(F.broadcast(total))  # one row


# State

@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN n ELSE o END AS updated_at FROM (SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 THEN DATE '2024-01-01' + (c_custkey % 50)::INT END AS o, CASE WHEN c_custkey % 5 > 0 THEN greatest(DATE '2024-01-01' + (c_custkey % 50)::INT, DATE '2024-01-01' + (c_custkey % 70)::INT) ELSE DATE '2024-01-01' + (c_custkey % 50)::INT END AS n0, CASE WHEN o IS NOT NULL THEN n0 END AS n FROM customer) WHERE c_custkey % 3 = 0")
def suppressed_times(t):
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), (F.col("c_custkey") % n).cast("int"))
    served = t("customer").select("c_custkey", F.lit(False).alias("is_deleted"), F.when(F.col("c_custkey") % 4 > 0, day(50)).alias("source_updated_at"))
    status = t("customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, "NOT_PUBLISHABLE").otherwise("PUBLISHABLE").alias("publication_status"), F.when(F.col("c_custkey") % 5 > 0, day(70)).alias("status_updated_at"))
    return incremental.suppress(served, status, ["c_custkey"]).select("c_custkey", F.col("source_updated_at").alias("updated_at"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN o_totalprice ELSE 0.0 END AS price, CASE WHEN o_custkey % 2 = 0 THEN o_orderpriority END AS priority FROM orders")
def materialized_twice(t):
    """An incremental table that is first made of all orders, then gets the rows of some customers, with a new column, twice."""
    path = f"{shared_dir(t('orders').sparkSession)}/orders-{uuid.uuid4().hex}"
    incremental.materialize(t("orders").select("o_orderkey", F.lit(0.0).alias("price")), "incremental", path, ["o_orderkey"])
    some = t("orders").where("o_custkey % 2 = 0").select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"))
    incremental.materialize(some, "incremental", path, ["o_orderkey"])
    return incremental.materialize(some, "incremental", path, ["o_orderkey"]).select("o_orderkey", real("price", "price"), "priority")


@query("SELECT c_custkey AS id, c_name AS name, NULL::VARCHAR AS segment FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer WHERE c_custkey % 2 = 1")
def conformed_customers(t):
    """Two loads of a table, of which the later one has a new column and lacks an old one."""
    first = t("customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    later = t("customer").where("c_custkey % 2 = 1").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"))
    schema = incremental.reconcile_schema(first.schema, later.schema)
    return incremental.conform(first, schema).unionByName(incremental.conform(later, schema))


# Current facts of postings: customers are postings

_LINKED = "CASE WHEN turn % 3 = 0 THEN '' WHEN turn % 3 = 1 THEN concat(' ', left(text, 40), ' ') ELSE repeat('x', 501) END"


@query(f"""WITH c AS (SELECT conv_id, turn, text, role FROM conversations), p AS (SELECT conv_id, trim(text, ' ') AS title, 'SYSTEM' AS title_source, 0 AS k, turn, 0 AS place FROM c WHERE role = 'system' AND length(trim(text, ' ')) BETWEEN 1 AND 500),
    l AS (SELECT conv_id, trim({_LINKED}, ' ') AS title, role AS title_source, 1 AS k, turn, 0 AS place FROM c WHERE turn % 3 = 1), b AS (SELECT * FROM p UNION ALL SELECT * FROM l WHERE length(title) BETWEEN 1 AND 500)
    SELECT i.conv_id, title, title_source FROM (SELECT DISTINCT conv_id FROM c) i LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k, turn, title) AS r FROM b) b ON b.conv_id = i.conv_id AND r = 1""")
def linked_titles(t):
    rows = t("conversations").select(F.col("conv_id").alias("subject"), "turn", "role", "text")
    pages = rows.select("subject", "turn", F.array(F.struct(F.col("role").alias("source"), F.col("text").alias("value"))).alias("titles"))
    links = rows.select("subject", "turn", F.array(F.struct(F.col("role").alias("source"), F.expr(_LINKED).alias("value"))).alias("titles"))
    return facts.resolve_title(pages, links, ["SYSTEM"], order="turn").withColumnRenamed("subject", "conv_id")


@query("""WITH s AS (SELECT o_custkey AS id, max(o_orderkey) AS n, max(o_orderdate) AS at FROM orders WHERE o_orderkey % 3 = 0 GROUP BY 1), f AS (SELECT o_custkey AS id, max(o_orderkey) AS n, max(o_orderdate) AS at, min(o_orderdate) AS posted FROM orders WHERE o_orderkey % 5 = 0 GROUP BY 1),
    p AS (SELECT o_custkey AS id, max(o_orderdate) AS at FROM orders WHERE o_orderkey % 7 = 0 GROUP BY 1), r AS (SELECT o_custkey AS id, max(o_orderdate) AS at FROM orders WHERE o_orderkey % 11 = 0 GROUP BY 1)
    SELECT c_custkey AS subject, coalesce('fact' || f.n, 'selected' || s.n) AS url, CASE WHEN p.id IS NOT NULL THEN 'page.example' WHEN f.id IS NOT NULL AND f.n % 2 = 0 THEN 'fact.example' WHEN s.id IS NOT NULL THEN 'selected.example' END AS source_domain,
    CASE WHEN p.id IS NOT NULL AND c_custkey % 2 = 0 THEN 'MATCHED' ELSE 'SELECTED_JOB_URL_FALLBACK' END AS final_url_identity_status, CASE WHEN f.n % 4 > 0 THEN c_name END AS company_name, f.posted AS publication_at, CASE WHEN s.id IS NOT NULL THEN 'selected.example' END AS attribution_name,
    c_name AS title, CASE WHEN c_custkey % 3 = 0 AND r.id IS NOT NULL THEN ['X'] ELSE [] END AS eligible, s.id IS NOT NULL AS has_selection, f.id IS NOT NULL AS has_fact, p.id IS NOT NULL AS has_page, r.id IS NOT NULL AS has_recheck, greatest(s.at, f.at, p.at, r.at) AS latest_observed_at
    FROM customer LEFT JOIN s ON s.id = c_custkey LEFT JOIN f ON f.id = c_custkey LEFT JOIN p ON p.id = c_custkey LEFT JOIN r ON r.id = c_custkey WHERE s.id IS NOT NULL OR f.id IS NOT NULL""")
def current_postings(t):
    of = lambda n: t("orders").where(F.col("o_orderkey") % n == 0).groupBy(F.col("o_custkey").alias("subject")).agg(F.max("o_orderkey").alias("n"), F.max("o_orderdate").alias("at"), F.min("o_orderdate").alias("posted"))
    selection = of(3).selectExpr("subject", "CONCAT('selected', n) AS url", "'selected.example' AS source_domain", "CONCAT('list', n) AS source_url", "'text' AS link_text", "at AS observed_at")
    fact = of(5).join(t("customer").select(F.col("c_custkey").alias("subject"), "c_name"), "subject").selectExpr("subject", "CONCAT('fact', n) AS url", "CONCAT('end', n) AS final_url", "IF(n % 2 = 0, 'fact.example', NULL) AS source_domain", "IF(n % 4 > 0, CONCAT(' ', c_name, ' '), ' ') AS company_name", "'' AS location_text", "posted AS date_posted_at", "at AS retrieved_at")
    page = of(7).selectExpr("subject", "CONCAT('page', n) AS final_url", "CONCAT('id', n) AS job_identity_url", "IF(subject % 2 = 0, 'MATCHED', NULL) AS final_url_identity_status", "'page.example' AS source_domain", "at AS observed_at")
    recheck = of(11).select("subject", F.col("at").alias("observed_at"))
    codes = of(11).where("subject % 3 = 0").selectExpr("subject", "ARRAY('X') AS eligible", *(f"CAST(ARRAY() AS ARRAY<STRING>) AS {c}" for c in ("excluded", "included_groups", "excluded_groups")))
    title = t("customer").selectExpr("c_custkey AS subject", "c_name AS title", "'NAME' AS title_source")
    found = facts.posting_facts(selection, fact, title, page, recheck.limit(0), recheck, codes)
    return found.select("subject", "url", "source_domain", "final_url_identity_status", "company_name", "publication_at", "attribution_name", "title", "eligible", "has_selection", "has_fact", "has_page", "has_recheck", "latest_observed_at")


# Streams over landed rows

def _landings(rows, label: str, parts: int):
    """A folder, and a function that lands the next part of ``rows`` there."""
    root = f"{shared_dir(rows.sparkSession)}/{label}-{uuid.uuid4().hex}"

    def land(part: int) -> None:
        rows.where(F.pmod(F.xxhash64(*rows.columns), F.lit(parts)) == part).write.mode("append").parquet(f"{root}/in")

    return root, land


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS r FROM events WHERE user_id IS NOT NULL) WHERE r = 1")
def streamed_latest_events(t):
    """The newest event of each user, kept by a stream over three landings, of which the first is landed again at the end."""
    rows = t("events").select("event_id", "ts", "user_id", "event_type")
    root, land = _landings(rows, "events", 3)
    for part in (0, 1, 2, 0):
        land(part)
        source = rows.sparkSession.readStream.schema(rows.schema).parquet(f"{root}/in")
        stream_upsert(source, f"{root}/table", f"{root}/checkpoint", ["user_id"], ["ts", "event_id"], part_rows=100_000).awaitTermination()
    return incremental.load_snapshot(rows.sparkSession, f"{root}/table").select("event_id", "user_id", "event_type")


@query("SELECT l_orderkey AS publication_id, max(l_shipdate) AS received_at, arg_max(l_returnflag, struct_pack(a := l_shipdate, b := l_returnflag)) AS status FROM lineitem GROUP BY 1")
def streamed_receipts(t):
    """The latest receipt of each publication, kept by a stream over two landings in no order."""
    rows = t("lineitem").select(F.col("l_orderkey").alias("publication_id"), F.col("l_returnflag").alias("status"), F.col("l_shipdate").cast("timestamp").alias("received_at"))
    root, land = _landings(rows, "receipts", 2)
    for part in (0, 1):
        land(part)
        source = rows.sparkSession.readStream.schema(rows.schema).parquet(f"{root}/in")
        stream_receipts(source, f"{root}/table", f"{root}/checkpoint", "10000 days", "1000 days").awaitTermination()
    return received(rows.sparkSession, f"{root}/table").select("publication_id", F.col("received_at").cast("timestamp_ntz").alias("received_at"), "status")
