"""Queries over the driver's tables, one or more for each family of operators, with the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.functions import text, typed
from factline.operators import checks, evidence, facts, incremental, publication, relational
from factline.plans import ledger, usage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    """Register a function of (table reader) under its name, with its SQL."""

    def register(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        ORACLE_SQL[f.__name__] = sql
        return f

    return register


def cents(col):
    return F.col(col).cast("decimal(20,2)") if isinstance(col, str) else col.cast("decimal(20,2)")


def real(col, name):
    return F.col(col).cast("double").alias(name)


def split_columns(columns: str) -> list[str]:
    """Column expressions between commas outside parentheses."""
    out, depth = [""], 0
    for c in columns:
        depth += {"(": 1, ")": -1}.get(c, 0)
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return [x.strip() for x in out]


# Current state

_LATEST = "SELECT event_id, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS r FROM events WHERE user_id IS NOT NULL) WHERE r = 1"
_EVENT = ["event_id", "user_id", "event_type", "value"]
_CUT = "2024-01-20 00:00:00"


@query(_LATEST)
def latest_event_per_user(t):
    return incremental.latest_per_key(t("events"), ["user_id"], ["ts", "event_id"]).select(*_EVENT)


@query(_LATEST)
def latest_event_per_user_narrow(t):
    return incremental.latest_per_key(t("events"), ["user_id"], ["ts", "event_id"], narrow="event_id").select(*_EVENT)


@query("SELECT user_id, event_type, previous_type FROM (SELECT user_id, event_type, lag(event_type) OVER w AS previous_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE r = 1")
def latest_with_previous(t):
    return incremental.with_previous(t("events"), ["user_id"], ["ts", "event_id"], "event_type", "previous_type").select("user_id", "event_type", "previous_type")


@query(f"SELECT DISTINCT user_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '{_CUT}') OR user_id NOT IN (SELECT user_id FROM events WHERE ts <= TIMESTAMP '{_CUT}')")
def changed_users(t):
    old = t("events").where(F.col("ts") <= F.lit(_CUT).cast("timestamp_ntz"))
    return incremental.changed_keys(t("events"), old, ["user_id"], "ts")


@query(_LATEST)
def incremental_upsert(t):
    events = t("events")
    old = incremental.latest_per_key(events.where(F.col("ts") <= F.lit(_CUT).cast("timestamp_ntz")), ["user_id"], ["ts", "event_id"])
    changed = incremental.changed_keys(events, old, ["user_id"], "ts")
    fresh = incremental.latest_per_key(events.join(changed, "user_id", "left_semi"), ["user_id"], ["ts", "event_id"])
    return incremental.upsert(old, fresh, ["user_id"]).select(*_EVENT)


@query(f"SELECT user_id, event_type FROM ({_LATEST}) n WHERE NOT EXISTS (SELECT 1 FROM (SELECT user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events WHERE ts <= TIMESTAMP '{_CUT}') WHERE r = 1) o WHERE o.user_id = n.user_id AND o.event_type IS NOT DISTINCT FROM n.event_type)")
def changed_rows(t):
    new = incremental.latest_per_key(t("events"), ["user_id"], ["ts", "event_id"])
    old = incremental.latest_per_key(t("events").where(F.col("ts") <= F.lit(_CUT).cast("timestamp_ntz")), ["user_id"], ["ts", "event_id"])
    return incremental.changed_rows(new, old, ["user_id"], ["event_type"]).select("user_id", "event_type")


@query("SELECT c_custkey AS id, c_mktsegment AS segment, c_acctbal < 0 AS is_deleted FROM customer")
def snapshot_soft_delete(t):
    whole = t("customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"), "c_acctbal")
    target = incremental.apply_snapshot(None, whole, F.lit("2024-01-01"))
    after = incremental.apply_snapshot(target, whole.where("NOT c_acctbal < 0"), F.lit("2024-01-02"))
    return after.select("id", "segment", F.col("_is_deleted").alias("is_deleted"))


@query("SELECT o_custkey, max(o_orderdate)::DATE AS last_order, count(*) AS n FROM orders GROUP BY 1 HAVING sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) > 0")
def suppressed_accounts(t):
    state = t("orders").groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").alias("source_updated_at"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("closed"))
    status = publication.publication_status(state.select("o_custkey", "closed", F.col("source_updated_at").alias("status_updated_at")), F.lit(None), [("CLOSED", F.col("closed") == 0)])
    gone = incremental.suppress(state.withColumn("is_deleted", F.lit(False)), status, ["o_custkey"])
    return gone.where("is_deleted").select("o_custkey", F.col("source_updated_at").alias("last_order"), "n")


# Typed parsing

@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, event_type = 'error' AS is_error FROM events")
def json_scalar_fields(t):
    parsed = typed.json_fields(t("events").select("event_id", "event_type", "props"), "props", {"k": ("$.k", "bigint")})
    return parsed.select("event_id", "k", (F.col("event_type") == "error").alias("is_error"))


@query("SELECT p_partkey, nullif(trim(upper(p_name)), '') AS name, try_cast(replace(p_brand, 'Brand#', '') AS INT) AS brand, CASE p_type WHEN 'ECONOMY' THEN 'LOW' WHEN 'SMALL' THEN 'LOW' ELSE coalesce(p_type, 'UNKNOWN') END AS kind FROM part")
def cleaned_parts(t):
    kind = text.remap(F.col("p_type"), {"ECONOMY": "LOW", "SMALL": "LOW"}, "UNKNOWN")
    return t("part").select("p_partkey", text.clean_text(F.col("p_name"), "upper").alias("name"), typed.safe_cast(F.replace("p_brand", F.lit("Brand#"), F.lit("")), "int").alias("brand"), kind.alias("kind"))


@query("SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), day(o_orderdate)) AS day, o_orderdate + INTERVAL 8 HOUR AS local_time FROM orders")
def civil_dates(t):
    d = F.col("o_orderdate")
    return t("orders").select("o_orderkey", typed.date_from_parts(F.year(d), F.month(d), F.day(d)).alias("day"), typed.to_local(d, "Asia/Manila").alias("local_time"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 0 AND l_linenumber / l_quantity BETWEEN 0 AND 1 THEN round(l_linenumber / l_quantity, 6) END AS share FROM lineitem")
def share_fractions(t):
    share = typed.share_fraction(F.concat(F.col("l_linenumber").cast("string"), F.lit("/"), F.col("l_quantity").cast("string")))
    return t("lineitem").select("l_orderkey", "l_linenumber", F.round(share.cast("double"), 6).alias("share"))


@query("SELECT p_partkey, list_sort(list_distinct(string_split(p_name, ' '))) AS words, array_to_string(list_distinct([p_type, p_brand]), ', ') IS NOT NULL AS joined FROM part")
def word_sets(t):
    return t("part").select("p_partkey", F.array_sort(F.array_distinct(F.split("p_name", " "))).alias("words"), text.join_values(F.array("p_type", "p_brand")).isNotNull().alias("joined"))


# Joins

@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def customers_without_orders(t):
    return t("customer").join(t("orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def customers_with_urgent_orders(t):
    urgent = t("orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return t("customer").join(urgent, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN c_mktsegment END AS segment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def conditional_enrichment(t):
    right = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment"))
    return relational.conditional_left_join(t("orders"), right, ["o_custkey"], F.col("o_orderstatus") == "F").select("o_orderkey", "segment")


@query("SELECT n_nationkey AS k, n_name AS name, customers, suppliers FROM nation LEFT JOIN (SELECT c_nationkey AS a, count(*) AS customers FROM customer GROUP BY 1) ON a = n_nationkey LEFT JOIN (SELECT s_nationkey AS b, count(*) AS suppliers FROM supplier GROUP BY 1) ON b = n_nationkey")
def wide_assembly(t):
    nation = t("nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    parts = [nation, t("customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("customers")), t("supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("suppliers"))]
    return relational.assemble(nation, parts, ["k"])


@query("SELECT coalesce(a, b) AS k, x, y FROM (SELECT c_nationkey AS a, count(*) AS x FROM customer GROUP BY 1) FULL JOIN (SELECT s_nationkey AS b, count(*) AS y FROM supplier GROUP BY 1) ON a = b WHERE x IS DISTINCT FROM y")
def table_difference(t):
    a = t("customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    b = t("supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return relational.diff_tables(a, b, ["k"], ["n"]).select("k", F.col("left.n").alias("x"), F.col("right.n").alias("y"))


_PAD = "(' ' || replace({}, ' ', '  ') || ' ')"


@query(f"SELECT doc_id, item_id, ((length({_PAD.format('d.text')}) - length(replace({_PAD.format('d.text')}, {_PAD.format('b.text')}, ''))) / length({_PAD.format('b.text')}))::BIGINT AS n_matches FROM documents d JOIN benchmark b ON contains({_PAD.format('d.text')}, {_PAD.format('b.text')})")
def phrase_match(t):
    phrases = t("benchmark").select("item_id", F.col("text").alias("phrase"))
    return relational.phrase_match(t("documents").select("doc_id", "text"), "text", phrases, "phrase", "doc_id").select("doc_id", "item_id", "n_matches")


@query("SELECT DISTINCT word, brand FROM (SELECT unnest(string_split(p_name, ' ')) AS word, p_type AS brand FROM part) GROUP BY ALL HAVING word IN (SELECT word FROM (SELECT unnest(string_split(p_name, ' ')) AS word, p_type AS brand FROM part) GROUP BY word HAVING count(DISTINCT brand) = 1)")
def unambiguous_aliases(t):
    aliases = t("part").select(F.explode(F.split("p_name", " ")).alias("word"), F.col("p_type").alias("brand"))
    return relational.unambiguous(aliases, ["word"], "brand")


@query("WITH m AS (SELECT DISTINCT p_type AS k, p_name AS phrase, p_name AS code FROM part UNION SELECT p_type, string_split(p_name, ' ')[1], string_split(p_name, ' ')[1] FROM part) SELECT k, phrase FROM m WHERE NOT EXISTS (SELECT 1 FROM m o WHERE o.k = m.k AND o.code <> m.code AND length(o.phrase) > length(m.phrase) AND contains(' ' || o.phrase || ' ', ' ' || m.phrase || ' '))")
def longest_match(t):
    whole = t("part").select(F.col("p_type").alias("k"), F.col("p_name").alias("phrase"))
    first = whole.select("k", F.substring_index("phrase", " ", 1).alias("phrase"))
    matches = whole.union(first).distinct().withColumn("code", F.col("phrase"))
    return relational.drop_contained(matches, ["k"], "phrase", "code").select("k", "phrase")


# Aggregates and windows

@query("SELECT l_returnflag, round(sum(CASE WHEN l_linestatus = 'O' THEN l_quantity::DECIMAL(20,2) ELSE 0 END), 2)::DOUBLE AS open_quantity, round(sum(CASE WHEN l_discount > 0.05 THEN l_extendedprice::DECIMAL(20,2) ELSE 0 END), 2)::DOUBLE AS discounted FROM lineitem GROUP BY 1")
def conditional_sums(t):
    sums = relational.conditional_sums(t("lineitem"), ["l_returnflag"], {"open_quantity": (F.col("l_linestatus") == "O", cents("l_quantity")), "discounted": (F.col("l_discount") > 0.05, cents("l_extendedprice"))})
    return sums.select("l_returnflag", real("open_quantity", "open_quantity"), real("discounted", "discounted"))


@query("SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority) FILTER (o_orderstatus = 'O')) AS priorities, count(DISTINCT o_orderstatus) AS statuses, bool_or(o_totalprice > 400000) AS any_large, bool_and(o_totalprice > 1000) AS all_real FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderstatus = 'O') > 0")
def sorted_sets(t):
    return t("orders").groupBy("o_custkey").agg(relational.sorted_set(F.col("o_orderpriority"), F.col("o_orderstatus") == "O").alias("priorities"), F.count_distinct("o_orderstatus").alias("statuses"), F.bool_or(F.col("o_totalprice") > 400000).alias("any_large"), F.bool_and(F.col("o_totalprice") > 1000).alias("all_real")).where("size(priorities) > 0")


@query("SELECT o_custkey, arg_max(o_orderpriority, struct_pack(a := o_orderdate, b := o_orderkey)) AS last_priority FROM orders GROUP BY 1")
def latest_values(t):
    return t("orders").groupBy("o_custkey").agg(relational.latest_value("o_orderpriority", "o_orderdate", "o_orderkey").alias("last_priority"))


@query("SELECT o_orderkey, sum(o_totalprice::DECIMAL(20,2)) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)::DOUBLE AS running FROM orders")
def running_totals(t):
    rows = t("orders").withColumn("price", cents("o_totalprice"))
    return relational.running_sum(rows, "price", "running", ["o_orderdate", "o_orderkey"], ["o_custkey"]).select("o_orderkey", real("running", "running"))


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS r FROM lineitem) WHERE r = 1")
def pick_by_priority(t):
    rank = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    return relational.pick_first(t("lineitem"), ["l_orderkey"], [rank, *map(F.col, ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(t):
    return t("customer").select(F.col("c_nationkey").alias("k")).union(t("supplier").select("s_nationkey")).distinct()


@query("SELECT c_nationkey AS k, list_sort(list_distinct(list_filter(a, lambda x: NOT list_contains(coalesce(b, []), x)))) AS only_customers FROM (SELECT c_nationkey, list(DISTINCT c_mktsegment) AS a, list(DISTINCT c_mktsegment) FILTER (c_acctbal < 0) AS b FROM customer GROUP BY 1)")
def array_difference(t):
    sets = t("customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.collect_set("c_mktsegment").alias("a"), F.collect_set(F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment"))).alias("b"))
    return sets.select("k", F.array_sort(F.array_except("a", "b")).alias("only_customers"))


# Text

_TAXONOMY = {"license": r"licen[cs]ed under", "secret": r"token = ", "shout": r"!!", "table": r" \| ", "noise": r"[#$%&*]{3}"}


@query("SELECT doc_id, list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{c}' END" for c, p in sorted(_TAXONOMY.items())) + "], lambda x: x IS NOT NULL) AS tags FROM documents")
def document_tags(t):
    return t("documents").select("doc_id", F.coalesce(text.tag_text(F.col("text"), _TAXONOMY), F.array().cast("array<string>")).alias("tags"))


@query("SELECT s_suppkey, s_name AS title FROM supplier")
def titles_without_suffix(t):
    title = F.concat(F.col("s_name"), F.lit(" - ACME Inc"), F.lit(" | acme inc"))
    return t("supplier").select("s_suppkey", text.strip_suffix(title, F.lit("Acme Inc")).alias("title"))


@query("SELECT lower(p_name) AS folded, count(*) AS n FROM part GROUP BY 1")
def folded_names(t):
    distinct = t("part").groupBy("p_name").agg(F.count(F.lit(1)).alias("n"))
    return distinct.groupBy(text.fold_text(F.col("p_name")).alias("folded")).agg(F.sum("n").alias("n"))


# Hashes, manifests, recheck buckets

_ROW = "sha256(to_json({c_custkey: c_custkey, c_name: c_name, c_mktsegment: c_mktsegment})::VARCHAR)"


@query(f"SELECT c_custkey, {_ROW} AS row_hash, md5(c_name) AS public_id FROM customer")
def row_hashes(t):
    return t("customer").select("c_custkey", text.row_hash("c_custkey", "c_name", "c_mktsegment").alias("row_hash"), text.public_id(F.col("c_name")).alias("public_id"))


_LEAVES = f"SELECT left(md5(c_custkey::VARCHAR), 3) AS bucket, sha256(string_agg(c_custkey || ':' || h, ',' ORDER BY c_custkey::VARCHAR, h)) AS h FROM (SELECT c_custkey, {_ROW} AS h FROM customer) GROUP BY 1"
_SNAPSHOT = f"SELECT sha256(string_agg(h, ',' ORDER BY bucket)) AS snapshot_hash FROM ({_LEAVES})"


@query(_SNAPSHOT)
def snapshot_hash(t):
    rows = t("customer").select("c_custkey", text.row_hash("c_custkey", "c_name", "c_mktsegment").alias("h"))
    return publication.snapshot_hash(rows, "c_custkey", "h")


@query(f"SELECT (SELECT max(o_orderdate)::DATE FROM orders) AS watermark, (SELECT count(*) FROM customer) AS customers_count, s.snapshot_hash AS customers_hash, sha256(s.snapshot_hash) AS content_hash, 'pub_' || left(sha256(s.snapshot_hash), 16) AS publication_id FROM ({_SNAPSHOT}) s")
def manifest(t):
    rows = t("customer").select("c_custkey", text.row_hash("c_custkey", "c_name", "c_mktsegment").alias("h"))
    watermark = t("orders").agg(F.max("o_orderdate").cast("date").alias("watermark"))
    return publication.manifest({"customers": (rows, "c_custkey", "h")}, watermark)


_START = "('0x' || substr(md5(c_nationkey::VARCHAR), 1, 15))::BIGINT"


@query(f"WITH old AS (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS position FROM customer WHERE c_acctbal >= 0), new AS (SELECT c_custkey, c_nationkey, coalesce((SELECT max(position) FROM old o WHERE o.c_nationkey = c.c_nationkey), 0) + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS position FROM customer c WHERE NOT c_acctbal >= 0) SELECT c_custkey, c_nationkey, position::BIGINT AS position, (({_START} + position) % 7)::INT AS bucket FROM (SELECT * FROM old UNION ALL SELECT * FROM new)")
def recheck_buckets(t):
    empty = t("customer").limit(0).select("c_custkey", "c_nationkey", F.lit(0).cast("long").alias("position"), F.lit(0).alias("bucket"))
    old = publication.assign_buckets(t("customer").where("c_acctbal >= 0"), empty, "c_custkey", "c_nationkey")
    return publication.assign_buckets(t("customer"), old, "c_custkey", "c_nationkey")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' WHEN o_totalprice < 100000 THEN 'TOO_SMALL' WHEN NOT o_orderdate + INTERVAL 1 DAY > TIMESTAMP '1998-01-01' THEN 'EXPIRED' END AS reason, CASE WHEN o_orderstatus = 'F' OR o_totalprice < 100000 OR NOT o_orderdate + INTERVAL 1 DAY > TIMESTAMP '1998-01-01' THEN 'NOT_PUBLISHABLE' ELSE 'PUBLISHABLE' END AS publication_status FROM orders")
def publication_status(t):
    as_of = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    rules = [("CLOSED", F.col("o_orderstatus") != "F"), ("TOO_SMALL", F.col("o_totalprice") >= 100000), ("EXPIRED", publication.not_expired(F.col("o_orderdate"), F.lit(True), as_of))]
    return publication.publication_status(t("orders"), as_of, rules).select("o_orderkey", "reason", "publication_status")


# Ledger

_ACCOUNTS = "SELECT n_nationkey AS account_key, CASE WHEN n_regionkey < 2 THEN 'CREDIT' ELSE 'DEBIT' END AS account_type, CASE WHEN n_regionkey = 4 THEN 'CLOSED' ELSE 'OPEN' END AS status FROM nation"
_MOVES = "SELECT c_nationkey AS account_key, o_orderdate::DATE AS date, CASE WHEN o_orderstatus = 'F' THEN 'OUTFLOW' ELSE 'INFLOW' END AS type, o_totalprice::DECIMAL(20,2) AS amount FROM orders JOIN customer ON o_custkey = c_custkey"
_SIGNED = f"SELECT m.account_key, date, account_type, status, CASE WHEN (type = 'INFLOW') = (account_type = 'CREDIT') THEN -amount ELSE amount END AS signed FROM ({_MOVES}) m LEFT JOIN ({_ACCOUNTS}) a USING (account_key)"
_DAILY = f"WITH s AS ({_SIGNED}), d AS (SELECT account_key, date, sum(signed) AS delta FROM s GROUP BY ALL), f AS (SELECT account_key, account_type, status, coalesce((SELECT min(date) FROM s WHERE s.account_key = a.account_key), (SELECT min(date) FROM s)) AS first FROM ({_ACCOUNTS}) a), spine AS (SELECT account_key, account_type, status, unnest(generate_series(first, DATE '2001-08-01', INTERVAL 1 DAY))::DATE AS date FROM f), b AS (SELECT account_key, account_type, status, date, coalesce(delta, 0) AS delta, sum(coalesce(delta, 0)) OVER (PARTITION BY account_key ORDER BY date ROWS UNBOUNDED PRECEDING) AS balance FROM spine LEFT JOIN d USING (account_key, date))"


def _accounts(t):
    return t("nation").select(F.col("n_nationkey").alias("account_key"), F.when(F.col("n_regionkey") < 2, "CREDIT").otherwise("DEBIT").alias("account_type"), F.when(F.col("n_regionkey") == 4, "CLOSED").otherwise("OPEN").alias("status"))


def _movements(t):
    of = t("customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("account_key"))
    kind = F.when(F.col("o_orderstatus") == "F", "OUTFLOW").otherwise("INFLOW")
    moves = t("orders").join(of, "o_custkey").select("account_key", F.col("o_orderdate").cast("date").alias("date"), kind.alias("type"), cents("o_totalprice").alias("amount"))
    return ledger.resolve_movements(moves, _accounts(t))


def _daily(t):
    return ledger.daily_balances(_accounts(t), _movements(t), F.lit("2001-08-01").cast("date"))


@query(f"{_DAILY} SELECT account_key, date, delta::DOUBLE AS delta, balance::DOUBLE AS balance, (CASE WHEN account_type = 'CREDIT' THEN -balance ELSE balance END)::DOUBLE AS net_worth FROM b")
def daily_balances(t):
    return _daily(t).select("account_key", "date", real("delta", "delta"), real("balance", "balance"), real("net_worth", "net_worth"))


@query(f"{_DAILY} SELECT account_key, status, (CASE WHEN status = 'CLOSED' THEN 0 ELSE balance END)::DOUBLE AS balance FROM b WHERE date = (SELECT max(date) FROM b)")
def current_balances(t):
    return ledger.current_balances(_daily(t)).select("account_key", "status", real("balance", "balance"))


def _transactions(t):
    price = cents("l_extendedprice")
    return t("lineitem").select(F.col("l_shipdate").cast("date").alias("date"), F.when(F.col("l_returnflag") == "N", "INCOME").otherwise("EXPENSE").alias("cashflow_type"), (F.col("l_returnflag") == "R").alias("is_deduction"), price.alias("amount"), ledger.split_amount(price, F.lit("0.5").cast("decimal(3,2)"))[0].alias("own_amount"), F.col("l_linestatus").alias("item"))


def _cashflow_sql(period):
    sums = {"gross_income": "l_returnflag = 'N'", "deductions": "l_returnflag = 'R'", "gross_expense": "l_returnflag = 'A'"}
    parts = ", ".join(f"coalesce(sum(l_extendedprice::DECIMAL(20,2)) FILTER ({c}), 0) AS {n}" for n, c in sums.items())
    return f"WITH s AS (SELECT date_trunc('{period}', l_shipdate)::DATE AS period, {parts}, coalesce(sum(round(l_extendedprice::DECIMAL(20,2) * 0.5::DECIMAL(3,2), 2)) FILTER (l_returnflag = 'A'), 0) AS net_expense FROM lineitem GROUP BY 1), n AS (SELECT *, gross_income - deductions AS net_income, gross_income - deductions - net_expense AS savings FROM s) SELECT period, gross_income::DOUBLE AS gross_income, net_income::DOUBLE AS net_income, gross_expense::DOUBLE AS gross_expense, net_expense::DOUBLE AS net_expense, savings::DOUBLE AS savings, (sum(savings) OVER (ORDER BY period ROWS UNBOUNDED PRECEDING))::DOUBLE AS running_savings FROM n"


def _cashflow(t, period):
    return ledger.cashflow(_transactions(t), period).select("period", *(real(c, c) for c in ("gross_income", "net_income", "gross_expense", "net_expense", "savings", "running_savings")))


@query(_cashflow_sql("month"))
def monthly_cashflow(t):
    return _cashflow(t, "month")


@query(_cashflow_sql("year"))
def yearly_cashflow(t):
    return _cashflow(t, "year")


@query("SELECT date_trunc('month', l_shipdate)::DATE AS period, CASE WHEN l_returnflag = 'N' THEN 'INCOME' ELSE 'EXPENSE' END AS cashflow_type, l_linestatus AS item, count(*) AS n, sum(l_extendedprice::DECIMAL(20,2))::DOUBLE AS total FROM lineitem GROUP BY ALL")
def monthly_by_type(t):
    return ledger.period_rollup(_transactions(t), "month", ["cashflow_type", "item"]).select("period", "cashflow_type", "item", "n", real("total", "total"))


@query("SELECT o_orderkey, round(o_totalprice::DECIMAL(20,2) * CASE o_orderpriority WHEN '1-URGENT' THEN 1.00 WHEN '2-HIGH' THEN 61.47 WHEN '5-LOW' THEN 0.39 END::DECIMAL(6,2), 2)::DOUBLE AS converted FROM orders")
def currency_conversion(t):
    rates = t("orders").sparkSession.createDataFrame([("1-URGENT", "1.00"), ("2-HIGH", "61.47"), ("5-LOW", "0.39")], "currency string, rate string").withColumn("rate", F.col("rate").cast("decimal(6,2)"))
    rows = t("orders").select("o_orderkey", F.col("o_orderpriority").alias("currency"), cents("o_totalprice").alias("amount"))
    return ledger.convert(rows, rates, "amount", "converted").select("o_orderkey", real("converted", "converted"))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def effective_transactions(t):
    orders = t("orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus")
    return ledger.effective_transactions(orders.where("o_orderstatus = 'F'"), orders).select(F.col("id").alias("o_orderkey"), "o_orderstatus")


# Checks

@query("SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_orders_of_lines(t):
    return checks.check_unique(t("lineitem"), ["l_orderkey"])


@query("SELECT o_orderkey FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)")
def orphan_orders(t):
    return checks.check_fk(t("orders"), "o_custkey", t("customer").where("c_acctbal >= 0"), "c_custkey").select("o_orderkey")


@query("SELECT event_id FROM events WHERE event_type NOT IN ('click', 'view') OR event_id IS NULL OR value < 0")
def unexpected_events(t):
    e = t("events")
    return checks.check_accepted(e, "event_type", ["click", "view"]).unionByName(checks.check_not_null(e, ["event_id"])).unionByName(checks.check_expr(e, F.col("value") < 0)).select("event_id").distinct()


@query("SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_values FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 4")
def distinct_priorities(t):
    return checks.check_distinct_at_most(t("orders"), ["o_custkey"], "o_orderpriority", 4)


@query("SELECT max(ts)::TIMESTAMP AS newest, date_sub('minute', max(ts), TIMESTAMP '2024-02-10 00:00:00') AS age_minutes FROM events")
def stale_events(t):
    return checks.check_freshness(t("events"), ["ts"], 1500, F.lit("2024-02-10 00:00:00").cast("timestamp_ntz")).withColumn("age_minutes", F.col("age_minutes").cast("long"))


# Usage reports

@query("SELECT ts::DATE AS day, event_type AS kind, count(*) AS jobs, count(*) FILTER (value >= 5) AS succeeded, count(*) FILTER (NOT value >= 5) AS failed, sum(value::DECIMAL(20,2))::DOUBLE AS amount FROM events GROUP BY ALL")
def job_usage(t):
    return usage.job_usage(t("events"), "ts", "event_type", F.col("value") >= 5, cents("value")).withColumn("amount", F.col("amount").cast("double"))


@query("SELECT c_mktsegment AS dataset, count(*) AS tables, sum(c_custkey)::BIGINT AS bytes FROM customer GROUP BY 1 UNION ALL SELECT NULL, count(*), sum(c_custkey)::BIGINT FROM customer")
def storage_usage(t):
    return usage.storage_usage(t("customer"), "c_mktsegment", "c_custkey")


@query("SELECT o_orderpriority AS storage_class, CASE WHEN a <= 7 THEN 'to 7' WHEN a <= 30 THEN 'to 30' WHEN a <= 90 THEN 'to 90' ELSE 'over 90' END AS age, count(*) AS objects, sum(o_orderkey)::BIGINT AS bytes, min(o_orderdate) AS oldest, max(o_orderdate) AS newest FROM (SELECT *, date_diff('day', o_orderdate::DATE, DATE '2001-08-02') AS a FROM orders) GROUP BY ALL")
def object_ages(t):
    return usage.object_ages(t("orders"), "o_orderdate", "o_orderkey", F.lit("2001-08-02").cast("date"), "o_orderpriority")


@query("SELECT event_type, count(*) AS nodes, min(value) AS shortest, max(value) AS longest, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1")
def run_summary(t):
    return usage.run_summary(t("events"), "event_type", "value", "event_type").drop("average")


FLAGSHIP = QUERIES["daily_balances"]


# Evidence and facts: nations are codes, regions are groups, customers and suppliers bear evidence

_EVIDENCE = """WITH e AS (
    SELECT c_custkey::VARCHAR AS subject, CASE WHEN c_acctbal > 0 THEN 'INCLUDED' ELSE 'EXCLUDED' END AS direction, n_name AS code, NULL AS group_code FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT s_suppkey::VARCHAR, CASE WHEN s_acctbal > 5000 THEN 'INCLUDED' WHEN s_acctbal > 0 THEN 'GLOBAL' ELSE 'UNKNOWN' END, NULL, CASE WHEN s_acctbal > 5000 THEN r_name END FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
m AS (SELECT r_name AS group_code, n_name AS code FROM nation JOIN region ON n_regionkey = r_regionkey),
c AS (SELECT subject, direction, code FROM e WHERE code IS NOT NULL UNION SELECT subject, direction, m.code FROM e JOIN m USING (group_code)),
s AS (SELECT subject, count(*) AS n_evidence, bool_or(direction = 'GLOBAL') AS has_global FROM e GROUP BY 1),
k AS (SELECT subject, list_sort(list(DISTINCT code) FILTER (direction = 'INCLUDED')) AS a, list_sort(list(DISTINCT code) FILTER (direction = 'EXCLUDED')) AS b FROM c GROUP BY 1),
r AS (SELECT subject, n_evidence, CASE WHEN len(a) > 0 THEN 'SPECIFIC' WHEN has_global AND len(b) > 0 THEN 'GLOBAL_EXCEPT' WHEN has_global THEN 'GLOBAL' ELSE 'UNKNOWN' END AS scope, list_filter(coalesce(a, []), lambda x: NOT list_contains(coalesce(b, []), x)) AS eligible, coalesce(b, []) AS excluded FROM s LEFT JOIN k USING (subject))"""


def _rollup(t):
    nations = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cust = t("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    direct = cust.selectExpr("CAST(c_custkey AS STRING) AS subject", "IF(c_acctbal > 0, 'INCLUDED', 'EXCLUDED') AS direction", "n_name AS code", "CAST(NULL AS STRING) AS group_code")
    supp = t("supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    grouped = supp.selectExpr("CAST(s_suppkey AS STRING) AS subject", "CASE WHEN s_acctbal > 5000 THEN 'INCLUDED' WHEN s_acctbal > 0 THEN 'GLOBAL' ELSE 'UNKNOWN' END AS direction", "CAST(NULL AS STRING) AS code", "CASE WHEN s_acctbal > 5000 THEN r_name END AS group_code")
    return evidence.rollup_eligibility(direct.unionByName(grouped), nations.selectExpr("r_name AS group_code", "n_name AS code"))


@query(f"{_EVIDENCE} SELECT subject, n_evidence, scope, eligible, excluded FROM r")
def rollup_sets(t):
    return _rollup(t).select("subject", "n_evidence", "scope", "eligible", "excluded")


@query(f"{_EVIDENCE} SELECT subject, unnest(eligible) AS code, 'ELIGIBLE' AS relation FROM r UNION ALL SELECT subject, unnest(excluded), 'EXCLUDED' FROM r")
def bridge_rows(t):
    return evidence.eligibility_bridge(_rollup(t))


@query("WITH o AS (SELECT DISTINCT l_orderkey AS subject, l_returnflag AS code, l_suppkey AS alias FROM lineitem), c AS (SELECT DISTINCT l_orderkey AS subject, l_returnflag AS ctx FROM lineitem WHERE l_linenumber = 1) SELECT code, alias FROM o JOIN c USING (subject) GROUP BY 1, 2 HAVING count(DISTINCT CASE WHEN code <> ctx THEN subject END) > count(DISTINCT CASE WHEN code = ctx THEN subject END)")
def distrusted_aliases(t):
    lines = t("lineitem").select(F.col("l_orderkey").alias("subject"), F.lit("line").alias("role"), F.lit("o").alias("object"), F.col("l_returnflag").alias("code"), F.col("l_suppkey").alias("alias"), "l_linenumber")
    context = lines.where("l_linenumber = 1").select("subject", "role", "object", "code").distinct()
    return evidence.distrusted_aliases(lines.drop("l_linenumber"), context)


@query("SELECT c.conv_id, t.title, t.title_source FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN (SELECT conv_id, trim(text, ' ') AS title, upper(role) AS title_source, row_number() OVER (PARTITION BY conv_id ORDER BY CASE role WHEN 'assistant' THEN 0 ELSE 1 END, turn, text) AS r FROM conversations WHERE role IN ('assistant', 'user') AND length(trim(text, ' ')) BETWEEN 1 AND 500) t ON c.conv_id = t.conv_id AND r = 1")
def title_priority(t):
    pages = t("conversations").select(F.col("conv_id").alias("subject"), "turn", F.array(F.struct(F.col("role").alias("source"), F.col("text").alias("value"))).alias("titles"))
    return facts.resolve_title(pages, pages.limit(0), ["ASSISTANT", "USER"], order="turn").withColumnRenamed("subject", "conv_id")


@query("SELECT o_custkey, arg_max(o_orderpriority, struct_pack(a := o_orderdate, b := o_orderkey)) FILTER (o_orderstatus <> 'F') AS priority, count(*) FILTER (o_orderstatus <> 'F') AS n_active, max(o_orderdate)::DATE AS watermark FROM orders GROUP BY 1 HAVING n_active > 0")
def active_customers(t):
    rows = t("orders").withColumns({"is_deleted": F.col("o_orderstatus") == "F", "priority": F.col("o_orderpriority")})
    return facts.active_groups(rows, "o_custkey", ["o_orderdate", "o_orderkey"], ["priority"], "o_orderdate").select("o_custkey", "priority", "n_active", F.col("watermark").cast("date").alias("watermark"))


@query("SELECT coalesce(a, b) AS nation, a IS NOT NULL AS has_customers, b IS NOT NULL AS has_suppliers, greatest(x, y) AS latest_observed_at FROM (SELECT c_nationkey AS a, max(c_custkey) AS x FROM customer GROUP BY 1) FULL JOIN (SELECT s_nationkey AS b, max(s_suppkey) AS y FROM supplier GROUP BY 1) ON a = b")
def current_nation_facts(t):
    part = lambda name, key, at: t(name).groupBy(F.col(key).alias("nation")).agg(F.max(at).alias("observed_at"))
    return facts.current_facts({"customers": part("customer", "c_nationkey", "c_custkey"), "suppliers": part("supplier", "s_nationkey", "s_suppkey")}, "nation").select("nation", "has_customers", "has_suppliers", "latest_observed_at")


@query("""
    WITH a AS (SELECT DISTINCT p_brand AS code, p_name AS text, 'phrase' AS kind FROM part UNION SELECT DISTINCT p_brand, p_brand, 'exact_code' FROM part),
    n AS (SELECT code, kind, trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS alias, trim(regexp_replace(text, '[^A-Za-z0-9]+', ' ', 'g')) AS cased_alias FROM a)
    SELECT min(code) AS code, alias, min(cased_alias) AS cased_alias, kind FROM n GROUP BY alias, kind HAVING count(DISTINCT code) = 1""")
def alias_rows(t):
    return evidence.alias_table(t("part").select("p_brand", "p_name"), code="p_brand", name="p_name")
