"""Typed parsing that gives null where a value can't be read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def safe_cast(col: Column, kind: str) -> Column:
    return col.try_cast(kind)


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date of its parts, or null if there is no such day."""
    return F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(day.cast("string"), 2, "0")).try_cast("date")


def to_local(col: Column, zone: str) -> Column:
    """Civil time in ``zone`` of a UTC instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), col.cast("timestamp_ntz"))


def ts_or_date(col: Column) -> Column:
    """Timestamp of a timestamp or date text."""
    return F.coalesce(col.try_cast("timestamp"), col.try_cast("date").cast("timestamp"))


def bool_default(col: Column, default: bool) -> Column:
    return F.coalesce(col.try_cast("boolean"), F.lit(default))


def json_fields(df: DataFrame, payload: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
    """Scalar fields of a JSON column: {name: (path, type)}. Objects and arrays, and absent fields, are null. The text is parsed once."""
    parsed = df.withColumn("__parsed", F.try_parse_json(F.col(payload)))
    scalar = lambda path: F.when(F.schema_of_variant(F.variant_get("__parsed", path, "variant")).rlike("^(OBJECT|ARRAY)"), None).otherwise(F.try_variant_get("__parsed", path, "string"))
    return parsed.withColumns({name: (scalar(path) if kind == "string" else scalar(path).try_cast(kind)) for name, (path, kind) in fields.items()}).drop("__parsed")


def json_state(col: Column, path: str) -> Column:
    """ABSENT, NULL or VALUE: what a path of JSON text leads to. In null and unreadable text all is absent."""
    found = F.try_variant_get(F.try_parse_json(col), path, "variant")
    return F.when(found.isNull(), "ABSENT").when(F.is_variant_null(found), "NULL").otherwise("VALUE")


def json_guarded(col: Column, path: str, kind: str, default) -> Column:
    """A typed field of JSON text: null if it is absent, ``default`` if it is there but null or unreadable as ``kind``."""
    value = F.try_variant_get(F.try_parse_json(col), path, "string").try_cast(kind)
    return F.when(json_state(col, path) != "ABSENT", F.coalesce(value, F.lit(default).cast(kind)))


def json_array(col: Column, path: str) -> Column:
    """Elements, as JSON text, of an array within JSON text."""
    items = F.try_variant_get(F.try_parse_json(col), path, "array<variant>")
    return F.transform(items, lambda x: F.to_json(x))


def share_fraction(col: Column) -> Column:
    """Share of "a/b": null text is 1; other than two numbers, a zero denominator, or a share out of 0 to 1 is null."""
    parts = F.split(col, "/", -1)
    share = F.try_divide(F.get(parts, F.lit(0)).try_cast("decimal(20,9)"), F.get(parts, F.lit(1)).try_cast("decimal(20,9)"))
    return F.when(col.isNull(), F.lit(1).cast("decimal(38,18)")).when((F.size(parts) == 2) & share.between(0, 1), share.cast("decimal(38,18)"))
