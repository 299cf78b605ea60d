"""Current facts of subjects: titles, assembled observations, and tables of what is active."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factline.functions.text import normalize_employment, row_hash, tag_text
from factline.operators.incremental import changed_rows, suppress

MOST_CHARACTERS = 500


def bounded(title: Column, most: int = MOST_CHARACTERS) -> Column:
    """A trimmed title, or null if it is blank or longer than ``most``."""
    trimmed = F.trim(title)
    return F.when((F.length(trimmed) > 0) & (F.length(trimmed) <= most), trimmed)


def resolve_title(pages: DataFrame, links: DataFrame, priority: list[str], subject: str = "subject", order: str | None = None) -> DataFrame:
    """One (subject, title, title_source) per subject of either table.

    ``pages`` has ``titles``, arrays of (source, value), in rows by ``order`` if a subject has several: the first bounded title of the first source in
    ``priority`` wins. Else it is the first bounded one of ``links``' (source, value) arrays ``titles``, in their
    order. The best is kept by an aggregate, so that no window sorts the titles.
    """
    ranks = F.create_map(*(F.lit(x) for i, s in enumerate(priority) for x in (s, i)))
    at = F.col(order) if order else F.lit(0)
    each = pages.select(subject, at.alias("row"), F.posexplode("titles").alias("place", "t"))
    typed = each.select(subject, "row", "place", bounded(F.col("t.value")).alias("title"), F.upper(F.trim("t.source")).alias("title_source"))
    ranked = typed.withColumn("rank", ranks[F.col("title_source")]).where("rank IS NOT NULL AND title IS NOT NULL")
    linked = links.select(subject, at.alias("row"), F.posexplode("titles").alias("place", "t")).select(subject, "row", "place", bounded(F.col("t.value")).alias("title"), F.col("t.source").alias("title_source"))
    linked = linked.where("title IS NOT NULL").withColumn("rank", F.lit(len(priority)))
    best = ranked.unionByName(linked).groupBy(subject).agg(F.min_by(F.struct("title", "title_source"), F.struct("rank", "row", "place", "title")).alias("best"))
    subjects = pages.select(subject).union(links.select(subject)).distinct()
    return subjects.join(best, subject, "left").select(subject, "best.title", "best.title_source")


def current_facts(parts: dict[str, DataFrame], subject: str = "subject", observed: str = "observed_at", of: tuple[str, ...] = ()) -> DataFrame:
    """One row per subject of any part, or of the parts named in ``of``: each part's columns as ``<part>_<column>``, ``has_<part>``, and ``latest_observed_at``, the last of the parts' ``observed`` times.

    Parts are unique by subject. The subjects are the union of the parts' keys, already dealt by the subject when the
    parts join, so that every join shuffles its own part once and never the wide side. Null subjects are none.
    """
    keys = reduce(lambda a, b: a.union(b), [df.select(subject) for name, df in parts.items() if not of or name in of]).dropna().distinct()
    named = [df.select(subject, F.lit(True).alias(f"has_{name}"), *(F.col(c).alias(f"{name}_{c}") for c in df.columns if c != subject)) for name, df in parts.items()]
    wide = reduce(lambda a, b: a.join(b, subject, "left"), named, keys)
    times = [F.col(f"{name}_{observed}") for name, df in parts.items() if observed in df.columns]
    flags = {f"has_{name}": F.coalesce(f"has_{name}", F.lit(False)) for name in parts}
    return wide.withColumns(flags | {"latest_observed_at": F.greatest(*times) if len(times) > 1 else times[0]})


#: The status of an identity that no page has confirmed.
UNCONFIRMED = "SELECTED_JOB_URL_FALLBACK"


def posting_facts(selection: DataFrame, fact: DataFrame, title: DataFrame, page: DataFrame, classification: DataFrame, recheck: DataFrame, eligibility: DataFrame, subject: str = "subject") -> DataFrame:
    """What is known of each posting that was selected or has facts, from the latest row of each kind.

    All columns of the parts stay, as :func:`current_facts` names them. Beside them: ``url``, ``source_domain`` and ``final_url`` of the part that knows best,
    ``job_identity_url`` and its status, ``company_name`` and ``location_text`` without blanks, ``publication_at``, attribution, ``snippet``, ``title`` and its source, sets of codes
    and groups that are empty where there is no evidence, and ``latest_observed_at``, the last of all times. Facts are observed by any of their times.
    """
    times = [c for c in ("date_posted_at", "retrieved_at", "extracted_at", "record_updated_at") if c in fact.columns]
    seen = fact.withColumn("observed_at", F.greatest(*times) if len(times) > 1 else F.col(times[0]))
    parts = {"selection": selection, "fact": seen, "page": page, "classification": classification, "recheck": recheck, "eligibility": eligibility}
    rows = current_facts(parts, subject, of=("selection", "fact")).join(title.select(subject, "title", "title_source"), subject, "left")
    trimmed = lambda c: F.nullif(F.trim(c), F.lit(""))
    sets = {c: F.coalesce(f"eligibility_{c}", F.array().cast("array<string>")) for c in ("eligible", "excluded", "included_groups", "excluded_groups")}
    return rows.withColumns(sets | {
        "url": F.coalesce("fact_url", "selection_url"),
        "source_domain": F.coalesce("page_source_domain", "fact_source_domain", "selection_source_domain"),
        "final_url": F.coalesce("page_final_url", "fact_final_url"),
        "job_identity_url": F.col("page_job_identity_url"),
        "final_url_identity_status": F.coalesce("page_final_url_identity_status", F.lit(UNCONFIRMED)),
        "company_name": trimmed("fact_company_name"),
        "location_text": trimmed("fact_location_text"),
        "publication_at": F.col("fact_date_posted_at"),
        "attribution_name": F.col("selection_source_domain"),
        "attribution_url": F.col("selection_source_url"),
        "snippet": F.col("selection_link_text"),
    })


def active_groups(rows: DataFrame, group: str, order: list[str], latest: list[str], updated: str, deleted: str = "is_deleted") -> DataFrame:
    """One row per group with an active row: the ``latest`` columns of its last active row, their count, and a watermark that counts deleted rows too."""
    active = ~F.coalesce(F.col(deleted), F.lit(False))
    last = F.max_by(F.struct(*latest), F.when(active, F.struct(*order)))
    found = rows.where(F.col(group).isNotNull()).groupBy(group).agg(last.alias("last"), F.count_if(active).alias("n_active"), F.max(updated).alias("watermark"))
    out = found.where("n_active > 0").select(group, "last.*", "n_active", "watermark")
    return out.withColumn("row_hash", row_hash(*(F.col(c).cast("string").alias(c) for c in out.columns)))


def bridge_mart(bridge: DataFrame, served: DataFrame, subject: str = "subject", deleted: str = "is_deleted") -> DataFrame:
    """Rows of a bridge whose subject is served, with their hash."""
    active = served.where(~F.coalesce(F.col(deleted), F.lit(False))).select(subject)
    return bridge.join(active, subject, "left_semi").withColumn("row_hash", row_hash(*bridge.columns))


#: The rule that companies are told apart by, and how many digits of the key's hash name one.
IDENTITY, DIGITS = "company_source_domain_v1", 32


def with_company(rows: DataFrame, name: str = "company_name", domain: str = "source_domain") -> DataFrame:
    """``rows`` with normalized_company_name, company_identity_source_domain, and, where both are there, company_identity_basis, company_identity_key and company_id.

    Names are lower-cased with runs of white space as one space, domains lower-cased. The key is JSON of the rule, the domain and the name.
    """
    folded = F.nullif(F.regexp_replace(F.lower(F.trim(F.col(name))), r"\s+", " "), F.lit(""))
    place = F.nullif(F.lower(F.trim(F.col(domain))), F.lit(""))
    key = F.to_json(F.struct(F.lit(IDENTITY).alias("identity_version"), F.col("company_identity_source_domain").alias("source_domain"), F.col("normalized_company_name").alias("company_name")))
    both = F.col("normalized_company_name").isNotNull() & F.col("company_identity_source_domain").isNotNull()
    named = rows.withColumns({"normalized_company_name": folded, "company_identity_source_domain": place})
    keyed = named.withColumns({"company_identity_basis": F.when(both, IDENTITY), "company_identity_key": F.when(both, key)})
    return keyed.withColumn("company_id", F.concat(F.lit("company_"), F.left(F.sha2("company_identity_key", 256), F.lit(DIGITS))))


def companies(serving: DataFrame) -> DataFrame:
    """One row per company with an active job, from serving rows.

    Name, basis and domain are those of the job observed last (of equal times the greatest job_id); ``written_at`` is the last change of any of the company's rows,
    deleted ones too, so that a deletion is seen. ``row_hash`` covers all of it.
    """
    active = ~F.coalesce("is_deleted", F.lit(False))
    if_active = lambda c: F.when(active, F.col(c))
    last = F.max_by(F.struct("company_name", "company_identity_basis", F.col("company_identity_source_domain").alias("source_domain")), F.when(active, F.struct("latest_observed_at", "job_id")))
    found = serving.where("company_id IS NOT NULL").groupBy("company_id").agg(
        last.alias("last"),
        F.count_if(active).alias("open_job_count"),
        F.min(if_active("source_publication_at")).alias("first_source_publication_at"),
        F.min(if_active("latest_observed_at")).alias("first_observed_at"),
        F.max(if_active("latest_observed_at")).alias("latest_observed_at"),
        F.max(if_active("source_updated_at")).alias("source_updated_at"),
        F.max("written_at").alias("written_at"),
    )
    out = found.where("open_job_count > 0").select("company_id", "last.*", "open_job_count", "first_source_publication_at", "first_observed_at", "latest_observed_at", "source_updated_at", "written_at")
    return out.withColumn("row_hash", row_hash(*(F.col(c).cast("string").alias(c) for c in out.columns)))


def eligibility_mart(bridge: DataFrame, serving: DataFrame, subject: str = "job_id") -> DataFrame:
    """Codes of each active subject (code, relation) beside its scope and times, with the row's hash."""
    active = serving.where(~F.coalesce("is_deleted", F.lit(False))).select(subject, "scope", "source_updated_at", "written_at")
    out = bridge.join(active, subject).select(subject, "code", "relation", "scope", "source_updated_at", "written_at")
    return out.withColumn("row_hash", row_hash(*(F.col(c).cast("string").alias(c) for c in out.columns)))


def facets(subjects: DataFrame, employment: list[str], texts: list[str], taxonomy: dict[str, str], subject: str = "subject") -> DataFrame:
    """(subject, employment_types, search_tags): sorted sets, empty where nothing is found.

    ``employment`` are columns of texts or of arrays of them, ``texts`` those that tags are looked for in: lower-cased words with single spaces.
    """
    arrays = [F.col(c) if subjects.schema[c].dataType.typeName() == "array" else F.array(c) for c in employment]
    values = F.flatten(F.array(*(F.coalesce(a, F.array().cast("array<string>")) for a in arrays)))
    words = F.regexp_replace(F.lower(F.concat_ws(" ", *(F.coalesce(F.col(t), F.lit("")) for t in texts))), "[^a-z0-9]+", " ")
    return subjects.select(subject, normalize_employment(values).alias("employment_types"), F.array_sort(F.array_distinct(tag_text(words, taxonomy))).alias("search_tags"))


def publishable(rows: DataFrame, url: str = "url", identity: str = "identity_url", snippet: str = "snippet", most: int = 1000, status: str = "publication_status") -> DataFrame:
    """Rows that are published or closed: ``canonical_url`` (the url where there is no identity), ``source_url``, ``is_deleted`` for closed ones, and ``public_snippet``, its first ``most`` characters."""
    kept = rows.where(F.col(status).isin("PUBLISHABLE", "CLOSED"))
    canonical = F.coalesce(F.nullif(F.trim(F.col(identity)), F.lit("")), F.col(url))
    return kept.withColumns({"canonical_url": canonical, "source_url": F.col(url), "is_deleted": F.col(status) == "CLOSED", "public_snippet": F.left(snippet, F.lit(most))}).drop(url, identity, snippet, status)


def serving_rows(candidates: DataFrame, previous: DataFrame | None, status: DataFrame, key: list[str], held: list[str], content: list[str], run_at: Column) -> DataFrame:
    """Rows to write to a serving table: candidates that are new or whose content differs, and tombstones of what is no longer published.

    ``held`` and ``content`` are the columns of the two content hashes, ``publication_content_hash`` and ``content_hash``;
    ``row_hash`` covers the whole row. ``previous`` is the table (None before the first run), ``status`` has the key,
    publication_status and status_updated_at. Candidates have is_deleted and source_updated_at.
    """
    rows = candidates
    if previous is not None:
        gone = suppress(previous.drop("publication_content_hash", "content_hash", "row_hash", "written_at"), status, key)
        rows = rows.join(gone.select(*key), key, "left_anti").unionByName(gone, allowMissingColumns=True)
    hashed = rows.withColumns({"publication_content_hash": row_hash(*held), "content_hash": row_hash(*content)})
    changed = hashed if previous is None else changed_rows(hashed, previous, key, ["content_hash"])
    stamped = changed.withColumn("written_at", run_at)
    return stamped.withColumn("row_hash", row_hash(*(F.col(c).cast("string").alias(c) if stamped.schema[c].dataType.typeName() in ("timestamp", "timestamp_ntz", "decimal") else F.col(c) for c in stamped.columns)))
