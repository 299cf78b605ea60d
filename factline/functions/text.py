"""Text expressions: normalising, folding, phrases, tags, identities."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


def clean_text(col: Column, case: str | None = None, blank_to_null: bool = True) -> Column:
    """Trim Unicode white space, optionally change case, and turn blank text into null."""
    out = F.regexp_replace(col, r"(?U)^\s+|\s+$", "")
    out = {"upper": F.upper, "lower": F.lower, None: lambda x: x}[case](out)
    return F.nullif(out, F.lit("")) if blank_to_null else out


def remap(col: Column, values: dict, default=None) -> Column:
    """Replace listed values; others stay; null becomes ``default``."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[col] if pairs else F.lit(None), col, F.lit(default))


@pandas_udf(StringType())
def _fold(text: pd.Series) -> pd.Series:
    return text.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x.casefold()))


def fold_text(col: Column) -> Column:
    """Case-folded compatibility decomposition with runs of other than letters and digits as one space. Apply it to distinct values."""
    return F.trim(F.regexp_replace(_fold(col), r"[^\p{L}\p{N}]+", " "))


def occurrences(text: Column, phrase: Column) -> Column:
    """How often a phrase occurs, without overlap; null for an empty phrase."""
    return F.when(F.length(phrase) > 0, ((F.length(text) - F.length(F.replace(text, phrase, F.lit("")))) / F.length(phrase)).cast("long"))


def join_values(items: Column, sep: str = ", ") -> Column:
    """Distinct non-blank elements in array order, joined."""
    cleaned = F.filter(F.transform(items, lambda x: clean_text(x)), lambda x: x.isNotNull())
    return F.nullif(F.array_join(F.array_distinct(cleaned), sep), F.lit(""))


#: The reason that a status of selection stands for, where none is given, and that of any other status.
SELECTION_REASONS = {
    "SELECTED": "NEW_URL_SELECTED",
    "SKIPPED_KNOWN_URL": "KNOWN_URL_IDENTITY",
    "SKIPPED_DUPLICATE_URL_IDENTITY": "DUPLICATE_WITHIN_SOURCE_CRAWL",
    "SKIPPED_SELECTION_LIMIT": "SELECTION_LIMIT_REACHED",
}
UNKNOWN_REASON = "UNKNOWN_SELECTION_STATUS"


def stated_reason(reason: Column, status: Column, reasons: dict[str, str] = SELECTION_REASONS, unknown: str = UNKNOWN_REASON) -> Column:
    """A reason in capitals, or else the one that the status stands for; a null or unlisted status has the reason ``unknown``."""
    known = F.create_map(*(F.lit(x) for kv in reasons.items() for x in kv))
    return F.coalesce(F.upper(F.trim(reason)), known[F.upper(F.trim(status))], F.lit(unknown))


def tag_text(col: Column, taxonomy: dict[str, str]) -> Column:
    """Sorted codes of the patterns that a text matches. A small taxonomy becomes expressions, not a join."""
    tags = [F.when(col.rlike(pattern), F.lit(code)) for code, pattern in sorted(taxonomy.items())]
    return F.array_compact(F.array(*tags)) if tags else F.array().cast("array<string>")


#: Employment types, and the patterns that show them in upper-cased words with single spaces.
EMPLOYMENT = {
    "FULL_TIME": "(^| )FULL ?TIME($| )",
    "PART_TIME": "(^| )PART ?TIME($| )",
    "CONTRACTOR": "(^| )(CONTRACT|CONTRACTOR|FREELANCE)($| )",
    "TEMPORARY": "(^| )(TEMP|TEMPORARY|SEASONAL)($| )",
    "INTERN": "(^| )(INTERN|INTERNSHIP)($| )",
    "VOLUNTEER": "(^| )VOLUNTEER($| )",
    "PER_DIEM": "(^| )PER ?DIEM($| )",
}


def normalize_employment(values: Column) -> Column:
    """Sorted set of the employment types that whole words in an array of texts name; nulls name none."""
    words = lambda x: F.regexp_replace(F.upper(F.trim(x)), "[^A-Z0-9]+", " ")
    tags = F.flatten(F.transform(F.filter(values, lambda x: x.isNotNull()), lambda x: tag_text(words(x), EMPLOYMENT)))
    return F.array_sort(F.array_distinct(F.coalesce(tags, F.array().cast("array<string>"))))


def strip_suffix(title: Column, name: Column, separators=(" - ", " – ", " — ", " | "), times: int = 8) -> Column:
    """Take ``name`` and a separator off the end of a title, up to ``times`` times, case-insensitively."""

    def once(text: Column) -> Column:
        ends = [F.concat(F.lit(s), name) for s in separators]
        out = text
        for end in ends:
            out = F.when(F.lower(text).endswith(F.lower(end)), F.rtrim(F.left(text, F.length(text) - F.length(end)))).otherwise(out)
        return out

    stripped = F.aggregate(F.sequence(F.lit(1), F.lit(times)), title, lambda acc, _: once(acc))
    return F.when(name.isNull() | (F.length(name) == 0), title).otherwise(stripped)


def row_hash(*cols: Column | str) -> Column:
    """Content hash of columns: SHA-256 of their JSON with nulls. Cast decimals and timestamps to text first."""
    return F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)


def entity_id(prefix: str, *cols: Column | str, version: int = 1, digits: int = 16) -> Column:
    """Stable identity from columns: the version is part of the key."""
    return F.concat(F.lit(prefix), F.left(row_hash(F.lit(version).alias("version"), *cols), F.lit(digits)))


def public_id(col: Column) -> Column:
    return F.md5(col)
