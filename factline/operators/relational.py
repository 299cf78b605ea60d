"""Joins, aggregates and windows that recur in ledgers and evidence."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factline.functions.text import occurrences


def merged(df: DataFrame) -> DataFrame:
    """``df`` as a side that a join sorts and merges. For joins of rows with rows: by the size of a compressed file, millions of short rows seem few enough for a broadcast, which the driver has to hold."""
    return df.hint("merge")


def hashed(df: DataFrame) -> DataFrame:
    """``df`` as the side that a join by shuffle hashes, a few parts at a time. For tables of names and phrases that rows are looked up in: neither they nor the rows are broadcast."""
    return df.hint("shuffle_hash")


def conditional_left_join(left: DataFrame, right: DataFrame, key: list[str], when: Column) -> DataFrame:
    """Left join in which rows of ``left`` that fail ``when`` are kept and match nothing. ``when`` is part of the join's condition, so the left side is read once."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in key})
    condition = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{k}") for k in key]) & when
    return left.join(renamed, condition, "left").drop(*(f"__{k}" for k in key))


def any_left_join(left: DataFrame, right: DataFrame, key: list[str], order: list[Column] | None = None) -> DataFrame:
    """Left join with at most one match: the first in ``order``, without it the least of the right side's rows."""
    rest = [c for c in right.columns if c not in key]
    first = F.min_by(F.struct(*rest), F.struct(*order)) if order else F.min(F.struct(*rest))
    return left.join(right.groupBy(*key).agg(first.alias("__one")), key, "left").select(*left.columns, *(F.col("__one")[c].alias(c) for c in rest))


def assemble(keys: DataFrame, parts: list[DataFrame], key: list[str]) -> DataFrame:
    """One wide row per key from tables that are unique by it."""
    return reduce(lambda left, part: left.join(part, key, "left"), parts, keys.select(*key).distinct())


def conditional_sums(df: DataFrame, keys: list[str], measures: dict[str, tuple[Column, Column]], scale: int = 2) -> DataFrame:
    """One column for each (condition, value): the rounded sum where the condition holds, 0 if nowhere."""
    return df.groupBy(*keys).agg(*(F.round(F.coalesce(F.sum(F.when(cond, value)), F.lit(0)), scale).alias(name) for name, (cond, value) in measures.items()))


def running_sum(df: DataFrame, value: str, out: str, order: list[str], partition: list[str] | None = None) -> DataFrame:
    return df.withColumn(out, F.sum(value).over(Window.partitionBy(*(partition or [])).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def sorted_set(col: Column, when: Column | None = None) -> Column:
    """Sorted distinct values, null left out."""
    return F.array_sort(F.collect_set(col if when is None else F.when(when, col)))


def latest_value(col: str, *order: str) -> Column:
    """The value, null included, of the row that is last by ``order``."""
    return F.max_by(col, F.struct(*order))


def pick_first(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in a declared order."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__rank = 1").drop("__rank")


def unambiguous(aliases: DataFrame, text: list[str], code: str) -> DataFrame:
    """Aliases whose text means one code only."""
    return aliases.groupBy(*text).agg(F.min(code).alias(code), F.max(code).alias("__most")).where(F.col(code) == F.col("__most")).drop("__most")


def phrase_match(texts: DataFrame, text_col: str, phrases: DataFrame, phrase_col: str, key: str) -> DataFrame:
    """Rows of ``texts`` with each phrase they contain as whole words, and how often (``n_matches``).

    Both are space-separated; ``key`` is unique in ``texts``. Of a text, only (key, word) rows of words that phrases have
    are made. They meet phrases on each phrase's rarest word, so that a word that is in many texts decides
    nothing unless a phrase has no other; the pairs that are left fetch their text, and containment is checked.
    """
    pad = lambda c: F.concat(F.lit(" "), F.replace(F.col(c), F.lit(" "), F.lit("  ")), F.lit(" "))
    known = phrases.where(F.length(phrase_col) > 0)
    distinct = known.select(F.col(phrase_col).alias("__phrase")).distinct()
    parts = distinct.select("__phrase", F.explode(F.array_distinct(F.split("__phrase", " "))).alias("__word"))
    words = texts.select(F.col(key).alias("__key"), F.explode(F.array_distinct(F.split(text_col, " "))).alias("__word"))
    used = words.join(parts.select("__word").distinct(), "__word", "left_semi")
    counts = used.groupBy("__word").agg(F.count(F.lit(1)).alias("__n"))
    rarest = parts.join(merged(counts), "__word", "left").groupBy("__phrase").agg(F.min_by("__word", F.struct(F.coalesce("__n", F.lit(0)), "__word")).alias("__word"))
    pairs = words.join(hashed(rarest), "__word").select("__key", "__phrase")
    met = texts.join(merged(pairs), F.col(key) == F.col("__key")).drop("__key")
    found = met.withColumn("n_matches", occurrences(pad(text_col), pad("__phrase"))).where("n_matches > 0")
    return found.join(known.withColumn("__phrase", F.col(phrase_col)), "__phrase").select(*texts.columns, *(c for c in phrases.columns), "n_matches")


def drop_contained(matches: DataFrame, key: list[str], phrase: str, code: str) -> DataFrame:
    """Matches but those whose phrase lies within a longer matched phrase of another code.

    A phrase can only lie in phrases that have all its words, so the distinct phrases of a key meet on the word that
    fewest of them have: rows are dealt by (key, word), and a phrase with a word of its own meets none. A match with a
    null key, phrase or code stays.
    """
    pad = lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    own = matches.select(*key, phrase, code).dropna().distinct()
    words = own.withColumn("__word", F.explode(F.array_distinct(F.split(phrase, " "))))
    counts = words.groupBy(*key, "__word").agg(F.count(F.lit(1)).alias("__n"))
    rarest = words.join(merged(counts), [*key, "__word"]).groupBy(*key, phrase, code).agg(F.min(F.struct("__n", "__word")).alias("__r"))
    asked = rarest.where("__r.__n > 1").select(*key, phrase, code, F.col("__r.__word").alias("__word"))
    longer = words.select(*key, "__word", F.col(phrase).alias("__longer"), F.col(code).alias("__code"))
    inside = (F.length("__longer") > F.length(phrase)) & (F.col("__code") != F.col(code)) & F.contains(pad(F.col("__longer")), pad(F.col(phrase)))
    contained = asked.join(merged(longer), [*key, "__word"]).where(inside).select(*key, phrase, code)
    return matches.join(merged(contained), [*key, phrase, code], "left_anti").select(*matches.columns)


def scoped_match(evidence: DataFrame, aliases: DataFrame, text: str, scope: str) -> DataFrame:
    """Equality match of text where an alias' scope is null or the evidence's."""
    renamed = aliases.withColumnRenamed(scope, "__scope")
    return evidence.join(renamed, text).where(F.col("__scope").isNull() | (F.col("__scope") == F.col(scope))).drop("__scope")


def disjunctive_join(left: DataFrame, right: DataFrame, branches: list[tuple[list[tuple[str, str]], Column | None]], how: str = "inner") -> DataFrame:
    """Pairs that meet any of ``branches``, each pair once; or, for left_semi and left_anti, rows of ``left`` with or without such a pair.

    A branch has pairs of columns that must be equal, and a further condition or none; the sides' column names must differ.
    Each branch is a join by equality of its own that leaves out what earlier branches met, so there is neither a nested loop nor a
    final distinct, and repeated rows stay. A condition that is null isn't met.
    """
    met = [reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in equal], F.lit(True) if more is None else more) for equal, more in branches]
    if how == "inner":
        none = lambda k: [~F.coalesce(m, F.lit(False)) for m in met[:k]]
        return reduce(DataFrame.unionByName, [left.join(right, reduce(lambda a, b: a & b, none(k), on)) for k, on in enumerate(met)])
    rest, parts = left, []
    for on in met:
        parts.append(rest.join(right, on, "left_semi"))
        rest = rest.join(right, on, "left_anti")
    return reduce(DataFrame.unionByName, parts) if how == "left_semi" else rest


def diff_tables(left: DataFrame, right: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """Keys whose ``cols`` differ between two tables, or that one lacks; both must be unique by key."""
    a, b = left.select(*key, F.struct(*cols).alias("left")), right.select(*key, F.struct(*cols).alias("right"))
    return a.join(b, key, "full_outer").where(~F.col("left").eqNullSafe(F.col("right")))
