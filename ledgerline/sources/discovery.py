"""What a source offers: documents linked from an index page, and documents listed with a carrier's entry. A source that offers
another number of documents or carriers than it is known to is an error, not a smaller corpus."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import links, role_of
from ..operators.shape import numbered_repeats


class Unexpected(ValueError):
    """The source isn't what it was."""


def expected(df: DataFrame, n: int, what: str) -> DataFrame:
    """df, if it has n rows."""
    found = df.count()
    if found != n:
        raise Unexpected(f"{n} {what} were expected, there are {found}")
    return df


def linked(pages: DataFrame, html: str, prefix: str, strip: str, count: int | None = None) -> DataFrame:
    """url, slug and place of each document that index pages link to under a prefix, each once, in order; the slug is the file's
    name without extension and without what strip matches."""
    found = pages.select(F.posexplode(links(F.col(html), prefix)).alias("place", "url")).groupBy("url").agg(F.min("place").alias("place"))
    stem = F.lower(F.regexp_replace(F.substring_index(F.substring_index("url", "?", 1), "/", -1), r"\.[A-Za-z0-9]+$", ""))
    out = found.select("url", F.regexp_replace(stem, strip, "").alias("slug"), "place")
    return out if count is None else expected(out, count, "documents")


def listed(items: DataFrame, carrier: str, html: str, roles: Mapping[str, str], base: str = "", carriers: int | None = None) -> DataFrame:
    """carrier, place, label, url and document_role of each link in a list entry's HTML field; labels name roles, others are
    "other", and a role that comes again has -2, -3 and so on."""
    if carriers is not None:
        expected(items.select(carrier).distinct(), carriers, "carriers")
    pattern = r'(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
    urls, labels = (F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(i)) for i in (1, 2))
    each = items.select(carrier, F.posexplode(F.arrays_zip(urls.alias("url"), labels.alias("label"))).alias("place", "x"))
    label = F.trim(F.regexp_replace(F.regexp_replace("x.label", r"<[^>]*>|&nbsp;", " "), r"\s+", " "))
    url = F.when(F.startswith("x.url", F.lit("/")), F.concat(F.lit(base), "x.url")).otherwise(F.col("x.url"))
    rows = each.select(carrier, "place", label.alias("label"), url.alias("url")).withColumn("document_role", role_of(F.col("label"), roles))
    return numbered_repeats(rows, [carrier], "document_role", ["place"])


def store(documents: DataFrame, path: str, run_id: str, content: str = "content", content_hash: str = "content_hash") -> DataFrame:
    """Adds contents that the store doesn't hold yet, by their hash, and returns the hashes that were added. The store itself is
    asked, not an index of it, so contents that were lost are stored again."""
    spark = documents.sparkSession
    new = documents.where(F.col(content).isNotNull()).select(content_hash, content).dropDuplicates([content_hash])
    try:
        held = spark.read.parquet(path).select(content_hash)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
            raise
        held = new.select(content_hash).limit(0)
    new.join(held, content_hash, "left_anti").withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)
    return spark.read.parquet(path).where(F.col("run_id") == run_id).select(content_hash)
