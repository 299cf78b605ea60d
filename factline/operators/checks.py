"""Data-quality checks. Each returns the rows that violate it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factline.functions.text import fold_text


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def check_unique(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def check_accepted(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.where(~F.col(col).isin(*values))


def check_fk(df: DataFrame, col: str, parent: DataFrame, parent_col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull()).join(parent.select(F.col(parent_col).alias(col)), col, "left_anti")


def check_no_suffix(df: DataFrame, col: str, name: str, separators=(" - ", " – ", " — ", " | ")) -> DataFrame:
    """Rows whose trimmed text ends in a separator and the trimmed name, whatever the case; blank ones have none."""
    text, suffix = F.trim(F.col(col)), F.trim(F.col(name))
    ends = [F.endswith(F.lower(text), F.lower(F.concat(F.lit(s), suffix))) for s in separators]
    return df.where((F.length(text) > 0) & (F.length(suffix) > 0) & reduce(lambda a, b: a | b, ends))


def check_join(df: DataFrame, other: DataFrame, key: list[str], violation: Column, optional: bool = False) -> DataFrame:
    """Rows of ``df`` for which ``violation`` holds beside their row of ``other`` (unique by key), or that have none there unless that is ``optional``."""
    joined = df.join(other.withColumn("__found", F.lit(True)), key, "left")
    absent = F.lit(False) if optional else F.col("__found").isNull()
    return joined.where(absent | F.coalesce(violation & F.col("__found"), F.lit(False))).drop("__found")


def check_covered(df: DataFrame, other: DataFrame, key: list[str]) -> DataFrame:
    """Rows of ``df`` without any row of ``other``."""
    return df.join(other.select(*key), key, "left_anti")


def check_expr(df: DataFrame, violation: Column) -> DataFrame:
    return df.where(violation)


def check_distinct_at_most(df: DataFrame, key: list[str], col: str, most: int = 1) -> DataFrame:
    return df.groupBy(*key).agg(F.count_distinct(col).alias("n_values")).where(F.col("n_values") > most)


def check_alias_unique(df: DataFrame, alias: str, code: str) -> DataFrame:
    """Folded aliases that mean several codes."""
    return check_distinct_at_most(df.select(alias, code).distinct().withColumn("folded", fold_text(F.col(alias))), ["folded"], code)


def reconcile_running(df: DataFrame, key: list[str], order: str, delta: str, balance: str, tolerance: float = 0.01) -> DataFrame:
    """Rows whose balance isn't the one before it plus the delta."""
    before = F.coalesce(F.lag(balance).over(Window.partitionBy(*key).orderBy(order)), F.lit(0))
    return df.withColumn("expected", before + F.col(delta)).where(F.abs(F.col("expected") - F.col(balance)) > tolerance)


def check_freshness(df: DataFrame, ts_cols: list[str], max_age_minutes: int, as_of: Column) -> DataFrame:
    """One row if the newest of the first timestamps that rows have is older than allowed, or there is none."""
    newest = df.agg(F.max(F.coalesce(*ts_cols)).alias("newest"))
    age = F.timestamp_diff("MINUTE", F.col("newest"), as_of)
    return newest.withColumn("age_minutes", age).where(F.col("newest").isNull() | (F.col("age_minutes") > max_age_minutes))
