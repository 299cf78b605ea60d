"""The queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.llm import alignment, bpe, chat, exact_dedup, html_text, language, media, mixing, quality, simhash, suffix_tree, trie, warc
from factline.sources.storage import write_shared

#: The text of both turns of conversation -7.
CONTROL = "\\### Assistant: </turn> ok"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.main_texts(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), out_col="text")
    return pages.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    read = media.store_texts(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), media.media_features("media").alias("f"))
    feature = F.format_string("%dx%d:%s", "f.width", "f.height", "f.thumbnail_hash").alias("feature")
    return read.select("doc_id", "n_bytes", "f.payload_bytes", "f.payload_sha256", "f.tail_crc32", "f.media_bytes", "f.media_sha256", feature)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out()))
    return language.predict(docs.select("doc_id", language.held_out().alias("held_out"), "text"), model).drop("text")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.place(_table(spark, sf_dir, "documents"), carry=False)
    return placed.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.size("copies")).alias("taken"), F.transform("copies", lambda c: c["shard"]).alias("shards"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", bpe.digests(public_tokenizers.path("byte_bpe_50k.json")).alias("d")).select("doc_id", "d.*")


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(_table(spark, sf_dir, "documents"), ~suffix_tree.held_out())


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(*trie.with_shared_heads(trie.ordered_turns(_table(spark, sf_dir, "conversations"))))


def op12_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = spark.sql("SELECT -7L AS conv_id, turn, role FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)").withColumn("text", F.lit(CONTROL))
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(control)
    written = write_shared(chat.conversations(chat.turns(rows)), "conversations")
    return chat.read_back(written).withColumnRenamed("tree", "conv_id").drop("leaf")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_votes(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_exact_dedup, op3_simhash, op4_html_text, op5_media, op6_language, op7_mixing, op8_bpe, op9_suffix_tree, op10_warc, op11_trie, op12_chat, op13_alignment)}

#: The remainder of the polynomial for each byte, by eight steps, and the checksum of a decimal number.
_CRC_TABLE = "list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, _: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))"
_CRC = "xor(list_reduce([4294967295] || list_transform(string_split({v}::VARCHAR, ''), lambda d: ascii(d)::BIGINT), lambda v, d: xor(v // 256, crc_table[(xor(v, d) & 255) + 1])), 4294967295)"
_BASE32 = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (({v} >> {s}) & 31), 1)"

#: DuckDB SQL of the queries that SQL can express. The others are tested against brute force instead.
ORACLE_SQL = {
    "op2_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op10_warc": f"""
        WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        s AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h, max(page_id) OVER (PARTITION BY sha1(html)) AS winner FROM p),
        v AS (SELECT *, list_transform(range(0, 8), lambda i: ('0x' || substr(h, (5 * i + 1)::INT, 5))::BIGINT) AS parts FROM s)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(parts, lambda x: {" || ".join(_BASE32.format(v="x", s=s) for s in (15, 10, 5, 0))}), '') AS payload_digest,
               CASE WHEN page_id = winner OR winner IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id = winner OR winner IS NULL THEN NULL ELSE winner END AS refers_to
        FROM v""",
    "op11_trie": f"""
        WITH RECURSIVE k AS (SELECT {_CRC_TABLE} AS crc_table),
        t AS (
            SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS r,
                   sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d, length(coalesce(text, '')) AS chars
            FROM conversations WHERE conv_id IS NOT NULL),
        s AS (SELECT c, count(*) AS n FROM t GROUP BY c),
        h AS (SELECT s.c, s.n, {_CRC.format(v="s.c")} % 6 AS h, s.c - s.c % 100 AS base FROM s, k),
        b AS (SELECT h.*, least(h.h, coalesce(o.n, 0)) AS taken FROM h LEFT JOIN s AS o ON o.c = h.base),
        u AS (
            SELECT b.c, t.r, t.d, t.chars FROM b JOIN t ON t.c = b.base AND t.r <= b.taken
            UNION ALL SELECT b.c, b.taken + t.r - b.h, t.d, t.chars FROM b JOIN t ON t.c = b.c AND t.r > b.h),
        p AS (
            SELECT c, r, chars, sha256(string_agg(d, '') OVER (PARTITION BY c ORDER BY r)) AS p FROM u
            UNION ALL SELECT c, 0, 0, '' FROM s),
        n AS (SELECT p, r, min(c) AS m, count(*) AS n_convs, any_value(chars) AS chars FROM p GROUP BY p, r),
        w AS (SELECT p.c, p.r, n.m, p.r = max(p.r) OVER (PARTITION BY p.c) AS ends FROM p JOIN n USING (p, r)),
        kids AS (SELECT a.m, a.r, count(DISTINCT b.m) AS n_children FROM w AS a JOIN w AS b ON b.c = a.c AND b.r = a.r + 1 GROUP BY a.m, a.r),
        own AS (SELECT n.m, n.r, n.n_convs, (n.n_convs - 1) * n.chars AS saved, coalesce(kids.n_children, 0) AS n_children FROM n LEFT JOIN kids USING (m, r)),
        sums AS (
            SELECT a.m, a.r, sum((o.n_children = 0)::INT)::BIGINT AS n_leaves, sum(o.saved)::BIGINT AS saved_tokens
            FROM own AS o JOIN w AS a ON a.c = o.m AND a.r <= o.r GROUP BY a.m, a.r),
        e AS (SELECT m, r, string_agg(c::VARCHAR, ',' ORDER BY c) AS ends FROM w WHERE ends GROUP BY m, r),
        up AS (SELECT c, r + 1 AS r, m FROM w)
        SELECT own.m AS conv_id, own.r AS depth, up.m AS parent_conv_id, own.n_convs, own.n_children, sums.n_leaves, sums.saved_tokens, sha256(coalesce(e.ends, '')) AS ends_sha256
        FROM own JOIN sums USING (m, r) LEFT JOIN e USING (m, r) LEFT JOIN up ON up.c = own.m AND up.r = own.r""",
    "op12_chat": rf"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, turn, role, '{CONTROL}' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)),
        n AS (SELECT *, 24 + length(role) + length(text) + len(regexp_extract_all(role, '\\|<turn>|<text>|</turn>')) + len(regexp_extract_all(text, '\\|<turn>|<text>|</turn>')) AS chars FROM t),
        g AS (
            SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, md5(text)) AS said,
                   coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, md5(text)) FILTER (role = 'assistant'), '') AS loss, sum(chars)::BIGINT AS formatted_chars
            FROM n GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g""",
}
