"""Further queries over the driver's tables: ledger sources, publication and serving, evidence steps, state and checks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from factline.functions import text, typed
from factline.operators import checks, evidence, facts, incremental, publication, relational
from factline.plans import ledger, usage
from factline.plans.registry import ORACLE_SQL, QUERIES, cents, query, real
from factline.sources import landing
from factline.sources.storage import shared_dir

__all__ = ["ORACLE_SQL", "QUERIES"]

# Text

_RAW = "CASE p_partkey % 10 WHEN 0 THEN 'Full-Time' WHEN 1 THEN 'part time, freelance' WHEN 2 THEN 'International staff' WHEN 3 THEN 'Contemporary art' WHEN 4 THEN ' contractor ' WHEN 5 THEN 'PER DIEM/seasonal' WHEN 6 THEN 'Internship & volunteer' WHEN 7 THEN 'fulltime' WHEN 8 THEN '' END"
_WORDS = f"regexp_replace(upper(trim({_RAW})), '[^A-Z0-9]+', ' ', 'g')"


@query("SELECT p_partkey, list_filter([" + ", ".join(f"CASE WHEN regexp_matches({_WORDS}, '{p}') THEN '{c}' END" for c, p in sorted(text.EMPLOYMENT.items())) + "], lambda x: x IS NOT NULL) AS types FROM part")
def multi_pattern(t):
    return t("part").select("p_partkey", text.normalize_employment(F.array(F.expr(_RAW), F.lit(None))).alias("types"))


@query(f"SELECT p_partkey, list_filter([" + ", ".join(f"CASE WHEN regexp_matches({_WORDS}, '{p}') THEN '{c}' END" for c, p in sorted(text.EMPLOYMENT.items())) + "], lambda x: x IS NOT NULL) AS employment_types, list_filter([CASE WHEN regexp_matches(lower(p_name), 'green|blue') THEN 'cold' END, CASE WHEN contains(lower(p_type), 'economy') THEN 'economy' END], lambda x: x IS NOT NULL) AS search_tags FROM part")
def part_facets(t):
    rows = t("part").withColumn("raw", F.expr(_RAW))
    return facts.facets(rows, ["raw"], ["p_name", "p_type"], {"cold": "(^| )[a-z]*(green|blue)", "economy": "economy"}, "p_partkey")


_TITLE = "s_name || CASE s_suppkey % 7 WHEN 0 THEN ' - ' WHEN 1 THEN ' – ' WHEN 2 THEN ' — ' WHEN 3 THEN ' | ' WHEN 4 THEN ': ' WHEN 5 THEN '-' ELSE ' / ' END || CASE s_suppkey % 3 WHEN 0 THEN 'ACME Inc' WHEN 1 THEN 'acme inc ' ELSE 'Acme Inc' END"


@query(f"SELECT s_suppkey FROM supplier WHERE s_suppkey % 7 < 4 AND s_suppkey % 11 <> 0")
def suffix_violations(t):
    rows = t("supplier").select("s_suppkey", F.expr(_TITLE).alias("title"), F.expr("IF(s_suppkey % 11 = 0, ' ', ' Acme Inc')").alias("company"))
    return checks.check_no_suffix(rows, "title", "company").select("s_suppkey")


@query("SELECT p_partkey, trim(p_brand) || ', ' || trim(p_type) AS joined FROM part")
def joined_values(t):
    return t("part").select("p_partkey", text.join_values(F.array(F.concat(F.lit(" "), "p_brand"), F.lit("  "), "p_type", F.lit(None), "p_brand")).alias("joined"))


@query("SELECT c_custkey, 'cus_' || left(sha256('{\"version\":2,\"c_nationkey\":' || c_nationkey || ',\"c_mktsegment\":\"' || c_mktsegment || '\"}'), 16) AS entity FROM customer")
def entity_ids(t):
    return t("customer").select("c_custkey", text.entity_id("cus_", "c_nationkey", "c_mktsegment", version=2).alias("entity"))


@query("SELECT event_id, [event_type, (props->>'$.k')] AS items, (props->>'$.k')::BIGINT AS first FROM events WHERE event_type IS NOT NULL")
def json_array_values(t):
    rows = t("events").where("event_type IS NOT NULL").withColumn("doc", F.to_json(F.struct(F.array(F.col("event_type"), F.get_json_object("props", "$.k")).alias("list"), F.array(F.struct(F.get_json_object("props", "$.k").alias("value"))).alias("x"))))
    items = F.transform(typed.json_array(F.col("doc"), "$.list"), lambda x: F.replace(x, F.lit('"'), F.lit("")))
    return typed.json_fields(rows, "doc", {"first": ("$.x[0].value", "bigint")}).select("event_id", items.alias("items"), "first")


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate::DATE::TIMESTAMP END AS at, coalesce(CASE o_orderkey % 4 WHEN 0 THEN true WHEN 1 THEN false END, true) AS flag FROM orders")
def parsed_times(t):
    shown = F.expr("CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderdate AS STRING) WHEN 1 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) ELSE 'no time' END")
    flag = F.expr("CASE o_orderkey % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'perhaps' END")
    return t("orders").select("o_orderkey", typed.ts_or_date(shown).cast("timestamp_ntz").alias("at"), typed.bool_default(flag, True).alias("flag"))


# Landing

@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def landing_round_trip(t):
    rows = t("customer").select("c_custkey", "c_name", "c_mktsegment")
    path = f"{shared_dir(rows.sparkSession)}/landing-{uuid.uuid4().hex}"
    landing.write_landing(rows, path, "run-1")
    landing.write_keys(rows, path, "run-1", "c_custkey")
    keys = landing.read_keys(rows.sparkSession, path, "run-1", "c_custkey bigint")
    return landing.read_landing(rows.sparkSession, path, "run-1", rows.schema).join(keys, "c_custkey", "left_semi")


@query("SELECT s_suppkey AS source_record_index, s_name, s_nationkey::BIGINT AS s_nationkey FROM supplier")
def envelopes(t):
    payload = F.to_json(F.struct("s_name", "s_nationkey"))
    rows = t("supplier").select(F.lit("1").alias("contract_version"), F.lit("run").alias("stage_run_id"), F.col("s_suppkey").alias("source_record_index"), payload.alias("payload"))
    path = f"{shared_dir(rows.sparkSession)}/envelopes-{uuid.uuid4().hex}"
    rows.write.json(path)
    return landing.read_envelopes(rows.sparkSession, path, "s_name string, s_nationkey bigint").select("source_record_index", "s_name", "s_nationkey")


@query("SELECT event_id FROM events WHERE event_type > 'click'")
def unread_events(t):
    e = t("events")
    return landing.read_new(e, e.where("event_type <= 'click'"), "event_type").select("event_id")


# Ledger sources: nations are accounts, orders are transactions, lineitem and suppliers the other sources

_TYPE = "CASE o_orderkey % 7 WHEN 0 THEN 'SALARY' WHEN 1 THEN 'SALARY DEDUCTION' WHEN 2 THEN 'TAX' WHEN 3 THEN 'BONUS' WHEN 4 THEN 'FOOD' WHEN 5 THEN 'RENT' END"
_PAYER = "CASE WHEN o_orderkey % 7 = 1 THEN 'payer' || (o_custkey % 3) WHEN o_orderkey % 7 = 0 THEN 'n' || (o_custkey % 5) WHEN o_orderkey % 11 <> 0 THEN 'n' || (o_custkey % 25) END"
_PAID = "CASE WHEN o_orderkey % 7 = 0 THEN 'payer' || (o_custkey % 3) WHEN o_orderkey % 13 <> 0 THEN 'n' || (o_custkey % 27) END"
_FROM = f"SELECT o_orderkey AS id, o_orderdate::DATE AS date, {_TYPE} AS type, {_PAYER} AS counterparty, {_PAID} AS payment_source, CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice::DECIMAL(20,2) END AS amount, CASE o_orderkey % 2 WHEN 0 THEN 'TAX' END AS item, o_orderstatus = 'F' AS settled, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS merchant FROM orders"
_SEED = [("SALARY", "INCOME", False), ("BONUS", "INCOME", False), ("SALARY DEDUCTION", "EXPENSE", True), ("TAX", "EXPENSE", True), ("FOOD", "EXPENSE", False), ("RENT", "EXPENSE", False)]
_CLASSED = f"SELECT f.*, cashflow_type, is_deduction FROM ({_FROM}) f LEFT JOIN (VALUES " + ", ".join(f"('{a}', '{b}', {str(c).lower()})" for a, b, c in _SEED) + ") s(type, cashflow_type, is_deduction) USING (type) WHERE settled OR id % 5 <> 0"
_ENTRIES = f"""WITH t AS ({_CLASSED}),
    pay AS (SELECT DISTINCT date_trunc('month', date)::DATE AS month, payment_source AS payer, counterparty AS acc FROM t WHERE type = 'SALARY' AND payment_source IS NOT NULL AND counterparty IS NOT NULL),
    e AS (
      SELECT id, CASE WHEN settled THEN 'TRANSACTION' ELSE 'PENDING_TRANSACTION' END AS source, date, counterparty AS account_key, 'INCREASE' AS direction, amount FROM t WHERE cashflow_type = 'INCOME'
      UNION ALL SELECT id, CASE WHEN settled THEN 'TRANSACTION' ELSE 'PENDING_TRANSACTION' END, date, acc, 'DECREASE', amount FROM t JOIN pay ON type = 'SALARY DEDUCTION' AND month = date_trunc('month', date) AND payer = counterparty
      UNION ALL SELECT id, CASE WHEN settled THEN 'TRANSACTION' ELSE 'PENDING_TRANSACTION' END, date, CASE WHEN is_deduction THEN counterparty ELSE payment_source END, 'DECREASE', amount FROM t WHERE cashflow_type = 'EXPENSE' AND type <> 'SALARY DEDUCTION'
      UNION ALL SELECT l_orderkey * 10 + l_linenumber, 'PAID_FOR_OTHERS', l_shipdate::DATE, CASE WHEN l_partkey % 9 <> 0 THEN 'n' || (l_partkey % 26) END, 'DECREASE', l_extendedprice::DECIMAL(20,2) FROM lineitem WHERE l_returnflag = 'R'
      UNION ALL SELECT c_custkey, CASE c_custkey % 4 WHEN 1 THEN 'TRANSFER' ELSE 'OUTFLOW' END, DATE '1996-01-01' + (c_custkey % 500)::INT, 'n' || (c_custkey % 25), 'DECREASE', c_acctbal::DECIMAL(20,2) FROM customer WHERE c_custkey % 4 IN (1, 3)
      UNION ALL SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'OPENING BALANCE' WHEN 1 THEN 'TRANSFER' ELSE 'INFLOW' END, DATE '1996-01-01' + (c_custkey % 500)::INT, 'n' || c_nationkey, CASE c_custkey % 4 WHEN 0 THEN 'OPENING' ELSE 'INCREASE' END, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal::DECIMAL(20,2) END FROM customer WHERE c_custkey % 4 IN (0, 1, 2)),
    m AS (SELECT * FROM e WHERE account_key IS NOT NULL AND amount IS NOT NULL)"""


def _classified(t):
    raw = t("orders").selectExpr("o_orderkey AS id", "CAST(o_orderdate AS DATE) AS date", f"CONCAT(' ', LOWER({_TYPE}), ' ') AS type", f"{_PAYER} AS counterparty", f"{_PAID} AS payment_source", "IF(o_orderkey % 17 <> 0, CAST(o_totalprice AS DECIMAL(20,2)), NULL) AS amount", "IF(o_orderkey % 2 = 0, 'TAX', NULL) AS item", "IF(o_orderkey % 3 <> 0, o_orderpriority, NULL) AS merchant", "o_orderstatus")
    settled = raw.where("o_orderstatus = 'F'").withColumn("source", F.lit("TRANSACTION"))
    pending = raw.where("o_orderstatus = 'F' OR id % 5 <> 0").withColumn("source", F.lit("PENDING_TRANSACTION"))
    both = ledger.effective_transactions(settled, pending).withColumn("posted", F.col("date"))
    seed = t("orders").sparkSession.createDataFrame(_SEED, "type string, cashflow_type string, is_deduction boolean")
    return ledger.classify(both, F.broadcast(seed)).withColumn("own_amount", F.col("amount"))


def _entries(t):
    lent = t("lineitem").where("l_returnflag = 'R'").selectExpr("l_orderkey * 10 + l_linenumber AS id", "CAST(l_shipdate AS DATE) AS date", "IF(l_partkey % 9 <> 0, CONCAT('n', l_partkey % 26), NULL) AS payment_source", "CAST(l_extendedprice AS DECIMAL(20,2)) AS amount")
    moved = t("customer").selectExpr("c_custkey AS id", "DATE_ADD(DATE'1996-01-01', CAST(c_custkey % 500 AS INT)) AS date", "CASE c_custkey % 4 WHEN 0 THEN 'OPENING BALANCE' WHEN 1 THEN 'TRANSFER' WHEN 2 THEN 'INFLOW' ELSE 'OUTFLOW' END AS type", "CONCAT('n', c_custkey % 25) AS source_account", "CAST(c_acctbal AS DECIMAL(20,2)) AS source_amount", "CONCAT('n', c_nationkey) AS destination_account", "IF(c_custkey % 10 <> 0, CAST(c_acctbal AS DECIMAL(20,2)), NULL) AS destination_amount")
    return ledger.movement_entries(_classified(t), lent, moved)


@query(f"{_ENTRIES} SELECT id, source, date, account_key, direction, amount::DOUBLE AS amount FROM m")
def movement_entries(t):
    return _entries(t).select("id", "source", "date", "account_key", "direction", real("amount", "amount"))


@query(f"""{_ENTRIES}, o AS (SELECT account_key, min(date) AS opened FROM m WHERE direction = 'OPENING' GROUP BY 1)
    SELECT id, source, m.account_key, direction, (CASE WHEN direction = 'OPENING' OR (direction = 'INCREASE') = (n_regionkey IS DISTINCT FROM 0) THEN amount ELSE -amount END)::DOUBLE AS signed
    FROM m LEFT JOIN o ON o.account_key = m.account_key LEFT JOIN nation ON m.account_key = 'n' || n_nationkey
    WHERE date BETWEEN DATE '1995-06-01' AND DATE '1998-01-01' AND (direction = 'OPENING' OR opened IS NULL OR date >= opened)""")
def balance_movements(t):
    accounts = t("nation").selectExpr("CONCAT('n', n_nationkey) AS account_key", "IF(n_regionkey = 0, 'CREDIT', 'DEBIT') AS account_type")
    day = lambda x: F.lit(x).cast("date")
    return ledger.balance_movements(_entries(t), accounts, day("1995-06-01"), day("1998-01-01")).select("id", "source", "account_key", "direction", real("signed", "signed"))


@query(f"""WITH t AS ({_CLASSED}), c AS (SELECT date_trunc('month', date)::DATE AS month, CASE WHEN type = 'SALARY DEDUCTION' THEN 'SALARY' WHEN type = 'TAX' THEN 'INTEREST' ELSE type END AS income_type,
    CASE WHEN cashflow_type = 'INCOME' OR type = 'TAX' THEN payment_source ELSE counterparty END AS income_source, type, item, coalesce(amount, 0) AS a, is_deduction AS d FROM t WHERE cashflow_type = 'INCOME' OR is_deduction)
    SELECT month, income_type, income_source, sum(CASE WHEN d THEN 0 ELSE a END)::DOUBLE AS gross_income, sum(CASE WHEN d THEN a ELSE 0 END)::DOUBLE AS income_deductions, sum(CASE WHEN type = 'SALARY DEDUCTION' AND item IS NULL THEN a ELSE 0 END)::DOUBLE AS salary_deductions,
    sum(CASE WHEN type = 'TAX' OR type = 'SALARY DEDUCTION' AND item = 'TAX' THEN a ELSE 0 END)::DOUBLE AS tax, sum(CASE WHEN d THEN -a ELSE a END)::DOUBLE AS net_income FROM c GROUP BY ALL""")
def income_by_type_source(t):
    out = ledger.income_by_type_source(_classified(t))
    return out.select("month", "income_type", "income_source", *(real(c, c) for c in ("gross_income", "income_deductions", "salary_deductions", "tax", "net_income")))


@query(f"WITH t AS ({_CLASSED}) SELECT date_trunc('month', date)::DATE AS month, CASE WHEN cashflow_type = 'INCOME' OR type = 'TAX' THEN payment_source ELSE counterparty END AS income_source, sum(CASE WHEN is_deduction THEN 0 ELSE coalesce(amount, 0) END)::DOUBLE AS gross_income, sum(CASE WHEN is_deduction THEN -1 ELSE 1 END * coalesce(amount, 0))::DOUBLE AS net_income FROM t WHERE cashflow_type = 'INCOME' OR is_deduction GROUP BY ALL")
def income_by_source(t):
    return ledger.income_by_source(ledger.income_by_type_source(_classified(t))).select("month", "income_source", real("gross_income", "gross_income"), real("net_income", "net_income"))


@query(f"WITH t AS ({_CLASSED}) SELECT date_trunc('month', date)::DATE AS month, item, merchant, payment_source, count(*) AS n, sum(amount)::DOUBLE AS net_expense FROM t WHERE cashflow_type = 'EXPENSE' AND NOT is_deduction GROUP BY ALL")
def expenses_by_item(t):
    return ledger.expenses_by_item(_classified(t)).withColumn("net_expense", F.col("net_expense").cast("double"))


@query(f"SELECT id FROM ({_CLASSED}) WHERE cashflow_type IS NULL")
def unclassified_transactions(t):
    return ledger.transactions_mart(_classified(t)).where("cashflow_type IS NULL").select("id")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'settled' ELSE 'pending' END AS origin FROM orders WHERE o_orderstatus = 'F' OR o_orderkey % 2 = 0")
def pending_not_settled(t):
    rows = t("orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    settled = rows.where("o_orderstatus = 'F'").withColumn("origin", F.lit("settled"))
    pending = rows.where("o_orderstatus = 'F' OR id % 2 = 0").withColumn("origin", F.lit("pending"))
    return ledger.effective_transactions(settled, pending).select(F.col("id").alias("o_orderkey"), "origin")


@query("SELECT account_key, date FROM (SELECT c_nationkey AS account_key, o_orderdate::DATE AS date, sum(o_totalprice::DECIMAL(20,2)) AS delta FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2) WHERE day(date) = 5")
def unreconciled_balances(t):
    of = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("account_key"))
    daily = t("orders").join(of, "o_custkey").groupBy("account_key", F.col("o_orderdate").cast("date").alias("date")).agg(F.sum(cents("o_totalprice")).alias("delta"))
    true = relational.running_sum(daily, "delta", "balance", ["date"], ["account_key"])
    wrong = true.withColumn("delta", F.when(F.dayofmonth("date") == 5, F.col("delta") + 1).otherwise(F.col("delta")))
    return checks.reconcile_running(wrong, ["account_key"], "date", "delta", "balance").select("account_key", "date")


# Publication and serving: orders are postings, their customers' later orders what is known of them

_FACTS = "SELECT o_orderkey AS id, ' ' || o_orderpriority || ' ' AS url, CASE o_orderkey % 3 WHEN 0 THEN ' id' || o_orderkey WHEN 1 THEN '  ' END AS identity_url, CASE o_orderkey % 5 WHEN 0 THEN 'CLOSED' WHEN 1 THEN 'TERMINAL' WHEN 2 THEN 'REACHABLE' END AS lifecycle, CASE o_orderkey % 2 WHEN 0 THEN 'TERMINAL' ELSE 'UNKNOWN' END AS previous, o_totalprice AS price, o_orderdate AS until FROM orders"
_REVIEWS = "SELECT l_orderkey AS id, l_linenumber AS seen, CASE WHEN l_quantity < 10 THEN 'held' WHEN l_quantity < 20 THEN 'pending' ELSE 'approved' END AS review_status FROM lineitem WHERE l_linenumber < 4"
_STATUS = f"""WITH f AS ({_FACTS}), r AS (SELECT id, arg_max(review_status, struct_pack(a := seen, b := review_status)) AS review_status FROM ({_REVIEWS}) GROUP BY 1),
    e AS (SELECT f.*, review_status, price > 50000 AS good, coalesce(lifecycle = 'CLOSED' OR lifecycle = 'TERMINAL' AND previous = 'TERMINAL', false) AS closed, until < TIMESTAMP '1994-01-01' AS expired FROM f LEFT JOIN r USING (id)),
    s AS (SELECT *, CASE WHEN NOT good THEN 'TOO_SMALL' WHEN closed AND lifecycle = 'CLOSED' THEN 'LIFECYCLE_CLOSED' WHEN closed THEN 'LIFECYCLE_TERMINAL_CONFIRMED' WHEN expired THEN 'EXPIRED_VALID_THROUGH' WHEN review_status IN ('pending', 'held') THEN 'PUBLICATION_REVIEW_HELD' ELSE 'PUBLICATION_READY' END AS reason,
    CASE WHEN NOT good THEN 'NOT_PUBLISHABLE' WHEN closed THEN 'CLOSED' WHEN expired OR review_status IN ('pending', 'held') THEN 'NOT_PUBLISHABLE' ELSE 'PUBLISHABLE' END AS publication_status FROM e)"""


def _status(t):
    rows = t("orders").selectExpr("o_orderkey AS id", "CONCAT(' ', o_orderpriority, ' ') AS url", "CASE o_orderkey % 3 WHEN 0 THEN CONCAT(' id', o_orderkey) WHEN 1 THEN '  ' END AS identity_url", "CASE o_orderkey % 5 WHEN 0 THEN 'CLOSED' WHEN 1 THEN 'TERMINAL' WHEN 2 THEN 'REACHABLE' END AS lifecycle", "IF(o_orderkey % 2 = 0, 'TERMINAL', 'UNKNOWN') AS previous", "o_totalprice AS price", "o_orderdate AS until")
    reviews = t("lineitem").where("l_linenumber < 4").selectExpr("l_orderkey AS id", "l_linenumber AS seen", "CASE WHEN l_quantity < 10 THEN 'held' WHEN l_quantity < 20 THEN 'pending' ELSE 'approved' END AS review_status")
    closed = publication.closure_reason(F.col("lifecycle"), F.col("previous"))
    reviewed = publication.apply_reviews(rows, reviews, "id", [("TOO_SMALL", F.col("price") > 50000)], closed, F.col("until") < F.lit("1994-01-01").cast("timestamp_ntz"), updated="seen")
    return reviewed.withColumn("snippet", F.repeat(F.trim("url"), F.lit(200)))  # long texts after the join, which has nothing to do with them


@query(f"{_STATUS} SELECT id, review_status, publication_status, reason FROM s")
def held_reviews(t):
    return _status(t).select("id", "review_status", "publication_status", "reason")


@query(f"{_STATUS} SELECT id, coalesce(nullif(trim(identity_url), ''), url) AS canonical_url, publication_status = 'CLOSED' AS is_deleted, left(repeat(trim(url), 200), 1000) AS public_snippet FROM s WHERE publication_status IN ('CLOSED', 'PUBLISHABLE')")
def publishable_orders(t):
    return facts.publishable(_status(t)).select("id", "canonical_url", "is_deleted", "public_snippet")


@query("""WITH o AS (SELECT o_custkey AS id, max(o_orderkey) AS last, count(*) AS n FROM orders WHERE o_orderkey % 4 <> 0 GROUP BY 1), n AS (SELECT o_custkey AS id, max(o_orderkey) AS last, count(*) AS n FROM orders WHERE o_custkey % 10 <> 0 GROUP BY 1)
    SELECT id, n.last, n.n, false AS is_deleted FROM n LEFT JOIN o USING (id) WHERE o.id IS NULL OR o.last <> n.last OR o.n <> n.n UNION ALL SELECT id, last, n, true FROM o WHERE id % 10 = 0""")
def serving_changes(t):
    state = lambda df: df.groupBy(F.col("o_custkey").alias("id")).agg(F.max("o_orderkey").alias("last"), F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("source_updated_at")).withColumn("is_deleted", F.lit(False))
    hashes = ["id"], ["id", "last", "n", "is_deleted"]
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    status = t("orders").select(F.col("o_custkey").alias("id")).distinct().select("id", F.when(F.col("id") % 10 == 0, "NOT_PUBLISHABLE").otherwise("PUBLISHABLE").alias("publication_status"), at("2000-01-01").alias("status_updated_at"))
    before = facts.serving_rows(state(t("orders").where("o_orderkey % 4 <> 0")), None, status, ["id"], *hashes, at("2000-01-01"))
    now = facts.serving_rows(state(t("orders").where("o_custkey % 10 <> 0")), before, status, ["id"], *hashes, at("2000-01-02"))
    return now.select("id", "last", "n", "is_deleted")


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END, o_custkey::VARCHAR) AS source_key FROM orders WHERE o_orderstatus <> 'F' AND (o_orderkey % 8 = 0 OR o_orderdate <= TIMESTAMP '1997-12-11')")
def recheck_candidates(t):
    rows = t("orders").selectExpr("o_orderkey", "IF(o_orderkey % 3 <> 0, o_orderpriority, '') AS company", "o_custkey AS domain", "IF(o_orderkey % 8 = 0, NULL, o_orderdate) AS published", "o_orderstatus = 'F' AS is_deleted")
    return publication.recheck_eligible(rows, "o_orderkey", ["company", "domain"], "published", F.lit("1998-01-01").cast("timestamp_ntz"))


@query(f"{_STATUS} SELECT id FROM s WHERE id % 6 = 0 AND publication_status = 'PUBLISHABLE' OR id % 6 <> 0 AND publication_status <> 'PUBLISHABLE' OR id % 9 = 0")
def status_disagreements(t):
    status = _status(t).select("id", "publication_status")
    served = status.select("id", (F.col("id") % 6 == 0).alias("is_deleted"))
    wrong = ((F.col("publication_status") == "PUBLISHABLE") & F.col("is_deleted")) | (F.col("publication_status").isin("CLOSED", "NOT_PUBLISHABLE") & ~F.col("is_deleted"))
    return checks.check_join(served, status.where("id % 9 <> 0"), ["id"], wrong).select("id")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def uncovered_customers(t):
    urgent = t("orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return checks.check_covered(t("customer"), urgent, ["c_custkey"]).select("c_custkey")


@query('SELECT "column" FROM (VALUES (\'customers_count\'), (\'customers_hash\'), (\'content_hash\'), (\'publication_id\')) v("column")')
def manifest_differences(t):
    rows = t("customer").select("c_custkey", text.row_hash("c_custkey", "c_name", "c_mktsegment").alias("h"))
    orders = t("orders").select("o_orderkey", text.row_hash("o_orderkey", "o_orderstatus").alias("h"))
    watermark = t("orders").agg(F.max("o_orderdate").cast("date").alias("watermark"))
    of = lambda c: {"customers": (c, "c_custkey", "h"), "orders": (orders, "o_orderkey", "h")}
    actual = publication.manifest(of(rows.where("c_custkey % 10 <> 0")), watermark)
    return publication.verify_manifest(actual, of(rows), watermark).select("column")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")
def unapplied_publication(t):
    control = t("orders").select(F.col("o_orderkey").alias("publication_id"), F.when(F.col("o_orderstatus") == "O", "READY").otherwise("DRAFT").alias("status"), F.col("o_orderdate").alias("created_at"))
    receipts = t("lineitem").select(F.col("l_orderkey").alias("publication_id"), F.lit("FAILED").alias("status"), F.col("l_linenumber").alias("received_at"))
    return publication.verify_receipts(control, receipts).select(F.col("publication_id").alias("o_orderkey"), F.lit("O").alias("o_orderstatus"))


@query("WITH n AS (SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS position FROM supplier) SELECT s_suppkey FROM n WHERE ((('0x' || substr(md5(s_nationkey::VARCHAR), 1, 15))::BIGINT + position) % 7)::INT = 1000000 // 43200 % 7")
def due_suppliers(t):
    empty = t("supplier").limit(0).select("s_suppkey", "s_nationkey", F.lit(0).cast("long").alias("position"), F.lit(0).alias("bucket"))
    return publication.due_bucket(publication.assign_buckets(t("supplier"), empty, "s_suppkey", "s_nationkey"), 1000000).select("s_suppkey")


# State

@query("SELECT c_custkey, arg_max(o_orderpriority, o_orderkey) AS last_priority FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1")
def any_match(t):
    right = t("orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority")
    return relational.any_left_join(t("customer").select("c_custkey"), right, ["c_custkey"], [-F.col("o_orderkey")]).select("c_custkey", F.col("o_orderpriority").alias("last_priority"))


@query("SELECT DISTINCT user_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_id % 2 = 0) OR user_id NOT IN (SELECT user_id FROM events WHERE event_id % 2 = 0) UNION SELECT DISTINCT user_id FROM events WHERE user_id % 7 = 0 AND user_id NOT IN (SELECT user_id FROM events WHERE event_id % 3 = 0)")
def changed_users_of_two(t):
    e = t("events")
    return incremental.changed_keys_multi([(e, e.where("event_id % 2 = 0"), "ts"), (e.where("user_id % 7 = 0").withColumn("ts", F.lit("2000-01-01").cast("timestamp_ntz")), e.where("event_id % 3 = 0"), "ts")], ["user_id"])


@query("SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1996-07-01' OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < -900)")
def due_orders(t):
    reviewed = t("customer").where("c_acctbal < -900").select(F.col("c_custkey").alias("o_custkey"))
    day = lambda x: F.lit(x).cast("timestamp_ntz")
    return incremental.due_for_reeval(t("orders"), "o_orderdate", day("1996-01-01"), day("1996-07-01"), reviewed, ["o_custkey"]).select("o_orderkey")


@query("SELECT doc_id, code FROM documents JOIN (SELECT lang AS w, source AS scope, 'own' AS code FROM (SELECT DISTINCT lang, source FROM documents WHERE source IN ('src1', 'src2')) UNION ALL SELECT DISTINCT lang, NULL, 'any' FROM documents WHERE lang <> 'en') a ON lang = w AND (scope IS NULL OR scope = source)")
def scoped_alias(t):
    docs = t("documents").select("doc_id", F.col("lang").alias("word"), "source")
    aliases = docs.where("source IN ('src1', 'src2')").select("word", "source", F.lit("own").alias("code")).distinct().unionByName(docs.where("word <> 'en'").select("word", F.lit(None).cast("string").alias("source"), F.lit("any").alias("code")).distinct())
    return relational.scoped_match(docs, aliases, "word", "source").select("doc_id", "code")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 3)")
def customers_of_few_priorities(t):
    wide = checks.check_distinct_at_most(t("orders"), ["o_custkey"], "o_orderpriority", 3)
    return t("customer").join(wide.select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey")


@query("SELECT lower(p_name) AS folded, count(DISTINCT p_brand) AS n_values FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def ambiguous_names(t):
    shown = F.when(F.col("p_partkey") % 2 == 0, F.initcap("p_name")).otherwise(F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit(" - "))))
    return checks.check_alias_unique(t("part").withColumn("shown", shown), "shown", "p_brand")


# Evidence: orders are evidence, their priorities roles, customers' nations what they name

_ROLE = "CASE o_orderkey % 6 WHEN 0 THEN 'APPLICANT_LOCATION_REQUIREMENTS' WHEN 1 THEN 'LLM_EXCLUDED_COUNTRY' WHEN 2 THEN 'LLM_INCLUDED_GROUP' WHEN 3 THEN 'JOB_LOCATION' WHEN 4 THEN 'LLM_GLOBAL_SCOPE' END"
_SAID = f"SELECT o_orderkey AS evidence_id, o_custkey AS subject, {_ROLE} AS role, CASE o_orderkey % 4 WHEN 0 THEN 'GLOBAL' WHEN 1 THEN 'SPECIFIC' END AS scope, CASE o_orderkey % 5 WHEN 0 THEN false WHEN 1 THEN true END AS can_restrict, o_orderkey % 10 = 3 AS restricting, o_orderkey % 50 = 7 AS global_place, o_orderkey % 6 = 3 AS location_role FROM orders"
_DIRECTED = f"""WITH e AS ({_SAID}), d AS (SELECT *, CASE WHEN global_place THEN 'GLOBAL' WHEN restricting THEN 'INCLUDED' WHEN location_role THEN 'UNKNOWN' WHEN scope = 'GLOBAL' AND role IN ('APPLICANT_LOCATION_REQUIREMENTS', 'LLM_GLOBAL_SCOPE') THEN 'GLOBAL'
    WHEN role = 'APPLICANT_LOCATION_REQUIREMENTS' AND NOT coalesce(can_restrict, true) THEN 'UNKNOWN' WHEN role IN ('APPLICANT_LOCATION_REQUIREMENTS', 'LLM_INCLUDED_GROUP') THEN 'INCLUDED' WHEN role = 'LLM_EXCLUDED_COUNTRY' THEN 'EXCLUDED' ELSE 'UNKNOWN' END AS direction,
    CASE WHEN restricting THEN CASE WHEN coalesce(role = 'JOB_LOCATION', false) THEN 'ATOMIC' ELSE 'TEXT' END WHEN role IN ('APPLICANT_LOCATION_REQUIREMENTS', 'LLM_EXCLUDED_COUNTRY') THEN 'ATOMIC' ELSE 'NONE' END AS mode FROM e)"""


def _directed(t):
    said = t("orders").selectExpr("o_orderkey AS evidence_id", "o_custkey AS subject", f"{_ROLE} AS role", "'a.AddressCountry' AS path", "CASE o_orderkey % 4 WHEN 0 THEN 'GLOBAL' WHEN 1 THEN 'SPECIFIC' END AS scope", "CASE o_orderkey % 5 WHEN 0 THEN false WHEN 1 THEN true END AS can_restrict", "o_orderkey % 10 = 3 AS restricting", "o_orderkey % 50 = 7 AS global_place", "o_orderkey % 6 = 3 AS location_role", "IF(o_orderkey % 7 = 0, 'location_shaped_remote_label', NULL) AS rule")
    return evidence.direct(said)


@query(f"{_DIRECTED} SELECT evidence_id, direction, mode FROM d")
def directed_evidence(t):
    return _directed(t).select("evidence_id", "direction", "mode")


@query(f"""{_DIRECTED}, u AS (SELECT * FROM d WHERE direction IN ('INCLUDED', 'EXCLUDED') AND evidence_id % 3 <> 0)
    SELECT evidence_id, CASE WHEN evidence_id % 11 = 0 THEN 'AMBIGUOUS_COUNTRY_ALIAS' WHEN coalesce(role = 'JOB_LOCATION', false) THEN 'UNKNOWN_OR_INVALID' WHEN evidence_id % 7 = 0 THEN 'UNMATCHED_LOCATION_LABEL' ELSE 'UNMATCHED_RESTRICTIVE_EVIDENCE' END AS match_source,
    CASE WHEN evidence_id % 11 <> 0 AND (coalesce(role = 'JOB_LOCATION', false) OR evidence_id % 7 = 0) THEN 'UNKNOWN' ELSE direction END AS direction FROM u""")
def unmatched_evidence(t):
    rows = _directed(t)
    return evidence.unmatched(rows, rows.where("evidence_id % 3 = 0"), rows.where("evidence_id % 11 = 0")).select("evidence_id", "match_source", "direction")


@query(f"{_DIRECTED} SELECT evidence_id, direction, CASE WHEN evidence_id % 2 = 0 THEN 'A' ELSE 'B' END AS match_source FROM d")
def combined_evidence(t):
    rows = _directed(t).select("evidence_id", "direction", F.lit(None).cast("string").alias("code"), F.lit(None).cast("string").alias("group_code"))
    parts = rows.withColumn("match_source", F.lit("B")), rows.where("evidence_id % 2 = 0").withColumn("match_source", F.lit("A"))
    return evidence.combine_evidence(*parts).select("evidence_id", "direction", "match_source")


@query("SELECT DISTINCT l_orderkey AS evidence_id, CASE WHEN n = 1 THEN l_returnflag END AS code FROM lineitem JOIN (SELECT l_orderkey AS k, count(DISTINCT l_returnflag) AS n FROM lineitem GROUP BY 1) ON k = l_orderkey")
def ambiguous_matches(t):
    return evidence.null_ambiguous(t("lineitem").select(F.col("l_orderkey").alias("evidence_id"), F.col("l_returnflag").alias("code"))).select("evidence_id", "code")


@query("SELECT o_orderkey AS evidence_id FROM orders JOIN (SELECT o_custkey AS c, max(o_orderkey) AS k FROM orders GROUP BY 1) ON c = o_custkey AND k = o_orderkey")
def latest_evidence(t):
    rows = t("orders").select(F.col("o_orderkey").alias("evidence_id"), F.col("o_custkey").alias("subject"), F.col("o_orderkey").alias("run"))
    latest = rows.groupBy("subject").agg(F.max("run").alias("run"))
    return evidence.current_evidence(rows, latest, ["subject", "run"]).select("evidence_id")


# Usage

@query("SELECT ts::DATE AS day, event_type AS dataset, floor(sum(user_id) * 1048576 / 86400)::BIGINT AS average_bytes FROM events GROUP BY 1, 2")
def storage_timeline(t):
    return usage.storage_timeline(t("events").withColumn("dataset", F.col("event_type")), "dataset", "user_id", "ts")


@query("SELECT sum(l_linenumber)::BIGINT AS messages, sum(round_even(l_linenumber * l_quantity::DECIMAL(10,2), 0))::BIGINT AS bytes FROM lineitem")
def message_totals(t):
    return usage.message_totals(t("lineitem").withColumn("mean", F.col("l_quantity").cast("decimal(10,2)")), "l_linenumber", "mean")


@query("SELECT o_custkey AS run, max(o_orderdate) FILTER (o_orderstatus = 'F') AS completed_at, count(*) AS objects FROM orders GROUP BY 1 HAVING completed_at < TIMESTAMP '1998-01-01'")
def expired_runs(t):
    rows = t("orders").withColumn("name", F.when(F.col("o_orderstatus") == "F", "a/_SUCCESS").otherwise("a/part")).withColumn("run", F.col("o_custkey"))
    return usage.expired_runs(rows, "run", "name", "o_orderdate", F.lit("1998-01-01").cast("timestamp_ntz"))
