"""Scalar text functions as Column expressions; only NFKC needs Python, batch by batch."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .typing import DECIMAL

#: A control character that no text needs; it marks where matches start.
_MARK = "\x01"
_LATIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
_PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUY"


def sha256_tagged(value: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(value, 256))


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def nfkc(text: Column) -> Column:
    """Unicode compatibility composition; the function is made here so that workers need not import this package."""

    def normalize(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))

    return F.pandas_udf(normalize, StringType())(text)


def slug(text: Column) -> Column:
    """Lower-case letters and digits with single dashes between them, Latin accents dropped."""
    return F.trim(F.regexp_replace(F.lower(F.translate(text, _LATIN, _PLAIN)), "[^a-z0-9]+", "-"), F.lit("-"))


def number_in(text: Column) -> Column:
    """A decimal from text with separators, currency and percent signs; parentheses are a minus. Null if it is none."""
    bare = F.regexp_replace(text, r"[\s,$%()]", "")
    value = F.expr("1") * F.when(bare.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)$"), bare).try_cast(DECIMAL)
    return F.when(F.trim(text).rlike(r"^\(.*\)$"), -value).otherwise(value).cast(DECIMAL)


def fraction_in(text: Column) -> Column:
    """A rate from text: percent signs divide by a hundred, and so do bare numbers above one."""
    n = number_in(text)
    return F.when(text.contains("%") | (F.abs(n) > 1), n * F.lit("0.01").cast("decimal(3,2)")).otherwise(n).cast(DECIMAL)


def date_from_serial(days: Column) -> Column:
    """The date of a spreadsheet's day number."""
    return F.date_add(F.lit("1899-12-30").cast("date"), days.cast("int"))


def date_in(text: Column, formats: Sequence[str] = ("yyyy-MM-dd", "M/d/yyyy", "MMMM d, yyyy", "d MMM yyyy")) -> Column:
    """The date by the first format that fits."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats]).cast("date")


def stamp_to_timestamp(stamp: Column, floor: str | None = None) -> Column:
    """A compact UTC run stamp as a timestamp, the floor as null."""
    kept = F.nullif(stamp, F.lit(floor)) if floor else stamp
    return F.to_timestamp(kept, "yyyyMMdd'T'HHmmss'Z'")


def zero_padded(text: Column, width: int) -> Column:
    """The digits, padded with zeros; longer numbers stay whole."""
    digits = F.regexp_replace(text, r"\D", "")
    return F.when(digits == "", None).when(F.char_length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0"))


def segment(text: Column, start: int, length: int) -> Column:
    """Part of an identifier, counted from 0, in upper case."""
    return F.upper(F.substring(text, start + 1, length))


def contains_number(text: Column, *forms: Column) -> Column:
    """Whether any form of a number stands in the text as a token of its own: no digit or point beside it, so a number
    that ends a sentence doesn't count. Null and empty forms are passed over."""
    out = F.lit(False)
    for form in forms:
        out = out | F.coalesce(F.regexp(text, F.concat(F.lit(r"(?<![\d.])\Q"), F.nullif(form, F.lit("")), F.lit(r"\E(?![\d.])"))), F.lit(False))
    return out


def percent_forms(fraction: Column) -> list[Column]:
    """A fraction as a percentage in the ways a document may print it: without trailing zeros, and with as many places as the
    fraction itself is stated with (0.0400 reads 4 or 4.0000)."""
    stated = fraction.cast("string")
    percent = stated.try_cast("decimal(38,18)") * F.lit(100)
    plain = F.regexp_replace(F.regexp_replace(percent.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    places = F.when(stated.rlike("^-?[0-9]*[.][0-9]+$"), F.char_length(F.substring_index(stated, ".", -1))).otherwise(F.lit(0))
    shown = F.char_length(F.when(plain.contains("."), F.substring_index(plain, ".", -1)).otherwise(F.lit("")))
    padded = F.concat(plain, F.when(plain.contains("."), F.lit("")).otherwise(F.lit(".")), F.repeat(F.lit("0"), F.greatest(F.lit(0), places - shown)))
    return [plain, F.when(places > 0, padded).otherwise(plain)]


def stated_range(text: Column) -> tuple[Column, Column]:
    """The bounds of "X% to Y%" as fractions, in order of size."""
    pattern = r"(-?\d+(?:\.\d+)?)\s*%\s*(?:to|-|–)\s*(-?\d+(?:\.\d+)?)\s*%"
    a, b = (F.nullif(F.regexp_extract(text, pattern, i), F.lit("")).cast(DECIMAL) * F.lit("0.01").cast("decimal(3,2)") for i in (1, 2))
    return F.least(a, b), F.greatest(a, b)


def role_of(label: Column, roles: Mapping[str, str], other: str = "other") -> Column:
    """The role whose key is the label, or else the longest key within it, or other. The keys are a fixed small list."""
    norm = collapse_space(F.lower(label))
    keys = sorted(roles, key=lambda k: (-len(k), k))
    out = None
    for k in keys:
        out = F.when(norm == k, roles[k]) if out is None else out.when(norm == k, roles[k])
    for k in keys:
        out = out.when(norm.contains(k), roles[k])
    return out.otherwise(other)


def extension_of(url: Column, content_type: Column, types: Mapping[str, str]) -> Column:
    """The file extension in a url's path, else by content type, else empty."""
    found = F.lower(F.regexp_extract(url, r"^[^?#]*/[^/?#]*(\.[A-Za-z0-9]{1,5})(?:[?#]|$)", 1))
    by_type = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])[F.lower(F.trim(F.split(content_type, ";")[0]))]
    return F.coalesce(F.nullif(found, F.lit("")), by_type, F.lit(""))


def version_in_etag(etag: Column) -> Column:
    return F.nullif(F.regexp_extract(etag, r"\},\s*(\d+)", 1), F.lit("")).cast("int")


def first_anchor(text: Column, patterns: Sequence[str]) -> Column:
    """The first group of the first pattern that is found, patterns in order of preference, without regard to case and
    trimmed; null if none is."""
    return F.coalesce(*[F.nullif(F.trim(F.regexp_extract(text, f"(?i){p}", 1)), F.lit("")) for p in patterns])


def labelled_hits(text: Column, pattern: str) -> Column:
    """Every match of a labelled pattern in document order, without regard to case: place (from 0), value (the first group,
    trimmed) and evidence, the line on which the match starts."""
    blind = f"(?i)(?:{pattern})"
    parts = F.split(F.regexp_replace(F.translate(text, _MARK, " "), blind, f"{_MARK}$0"), _MARK, -1)  # each but the first opens with a match
    before = lambda i: F.substring_index(F.array_join(F.slice(parts, 1, i + 1), ""), "\n", -1)
    return F.transform(
        F.regexp_extract_all(F.translate(text, _MARK, " "), F.lit(blind), F.lit(1)),
        lambda v, i: F.struct(i.alias("place"), F.trim(v).alias("value"), F.trim(F.concat(before(i), F.substring_index(F.array_join(F.slice(parts, i + 2, F.size(parts)), ""), "\n", 1))).alias("evidence")),
    )


def first_match_line(text: Column, pattern: str) -> Column:
    """The line on which a pattern is first found, without regard to case, null if it isn't."""
    return F.get(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"(?i){pattern}")), F.lit(0))


def heads(line: Column, pattern: str, longest: int = 110, offset: int = 10) -> Column:
    """Whether a line that holds a pattern reads like a heading: it is short, the pattern stands near its start or after
    numbering, and it doesn't end like prose."""
    numbering = r"[ \t•·\-–—]*[\d.()a-zA-Z]{0,16}[:.]?[ \t•·\-–—]*"
    near = line.rlike(f"(?i)^(?:.{{0,{offset}}}|{numbering})(?:{pattern})")
    return F.coalesce((F.char_length(F.trim(line)) <= longest) & near & ~line.rlike(r"[.;,]\s*$"), F.lit(False))


def located_sections(pages: DataFrame, keys: Sequence[str], page: str, text: str, headings: Mapping[str, Sequence[str]], last_pages: int = 3, contents_from: int = 4) -> DataFrame:
    """Where configured sections stand in documents: keys, section, heading, page_start and page_end; page_start is null for
    those not found. headings: section -> patterns.

    A section starts on the first page where one of its patterns is a heading, or else where it is mentioned in prose. Pages
    on which contents_from sections or more are named are tables of contents and start none. A section ends on the page
    before the next one's start, the last one after last_pages more pages. All sections are found in one aggregate a document."""
    from pyspark.sql.window import Window

    names = sorted(headings)
    lines = {k: [first_match_line(F.col(text), p) for p in headings[k]] for k in names}
    named = {k: F.coalesce(*lines[k]).isNotNull() for k in names}
    headed = {k: reduce(lambda a, b: a | b, (heads(x, p) for x, p in zip(lines[k], headings[k], strict=True))) for k in names}
    marked = pages.select(*keys, F.col(page).alias("__page"), *[F.struct(named[k].alias("named"), headed[k].alias("headed"), F.trim(F.coalesce(*lines[k])).alias("line")).alias(f"__{i}") for i, k in enumerate(names)])
    crowd = reduce(lambda a, b: a + b, (F.col(f"__{i}.named").cast("int") for i in range(len(names))))
    at = lambda i, kind: F.min(F.when(F.col(f"__{i}.{kind}") & ~F.col("__contents"), F.struct(F.col("__page").alias("page"), F.col(f"__{i}.line").alias("line"))))
    found = marked.withColumn("__contents", crowd >= contents_from).groupBy(*keys).agg(F.max("__page").alias("__last"), *[F.coalesce(at(i, "headed"), at(i, "named")).alias(f"__{i}") for i in range(len(names))])
    rows = found.select(*keys, "__last", F.explode(F.array(*[F.struct(F.lit(k).alias("section"), F.col(f"__{i}.line").alias("heading"), F.col(f"__{i}.page").alias("page_start")) for i, k in enumerate(names)])).alias("s")).select(*keys, "__last", "s.*")
    following = F.lead("page_start").over(Window.partitionBy(*keys).orderBy(F.col("page_start").asc_nulls_last(), "section"))
    end = F.when(F.col("page_start").isNotNull(), F.greatest(F.col("page_start"), F.coalesce(following - 1, F.least(F.col("page_start") + last_pages, F.col("__last")))))
    return rows.withColumn("page_end", end).drop("__last")


def line_of(text: Column, pattern: str) -> Column:
    """The whole line on which a pattern is first found."""
    return F.nullif(F.regexp_extract(text, f"(?m)^.*(?:{pattern}).*$", 0), F.lit(""))


def close_to(a: Column, b: Column, tolerance: float) -> Column:
    """Equality of numbers within a tolerance, in doubles."""
    return F.abs(a.cast("double") - b.cast("double")) <= F.lit(tolerance)


def same_text(a: Column, b: Column) -> Column:
    return F.lower(F.trim(a)) == F.lower(F.trim(b))


def in_vocabulary(text: Column, words: Sequence[str], shape=F.initcap) -> Column:
    """The text in the vocabulary's spelling, null if it isn't in it."""
    spelled = shape(F.trim(text))
    return F.when(spelled.isin(*words), spelled)


def call_cost(fresh: Column, written: Column, read: Column, out: Column, price_in: Column, price_out: Column, write_factor: str = "1.25", read_factor: str = "0.1") -> Column:
    """The price of a call with cached tokens, prices per million, six places, halves to even."""
    d = lambda c: c.cast("decimal(20,6)")
    tokens_in = d(fresh) + d(written) * F.lit(write_factor).cast("decimal(4,2)") + d(read) * F.lit(read_factor).cast("decimal(4,2)")
    return F.bround((tokens_in * d(price_in) + d(out) * d(price_out)) / F.lit(1000000), 6)


def json_in_fence(text: Column) -> Column:
    """The JSON within a fenced block, or the whole text, parsed strictly; null if it isn't JSON."""
    inner = F.coalesce(F.nullif(F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1), F.lit("")), text)
    return F.try_parse_json(F.trim(inner))


def links(html: Column, prefix: str) -> Column:
    """Link targets under a prefix, in order of first place."""
    return F.array_distinct(F.filter(F.regexp_extract_all(html, F.lit(r'href="([^"]+)"'), F.lit(1)), lambda u: u.startswith(prefix)))


def percent_tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(-?\d+(?:\.\d+)?)\s*%"), F.lit(1))


def lines_table(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per line with its physical number from 1."""
    return df.select(*keep, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def sections(lines: DataFrame, keys: Sequence[str], heading: Column, widest: int | None = None) -> DataFrame:
    """From each heading line to the next one: keys, heading, start_line, end_line (exclusive, null for the last one)."""
    from pyspark.sql.window import Window

    found = lines.where(heading).select(*keys, F.col("line").alias("heading"), F.col("line_no").alias("start_line"))
    out = found.withColumn("end_line", F.lead("start_line").over(Window.partitionBy(*keys).orderBy("start_line")))
    return out if widest is None else out.withColumn("end_line", F.least(F.coalesce("end_line", F.col("start_line") + widest), F.col("start_line") + widest))


def is_heading(line: Column, longest: int = 110) -> Column:
    """Short, starts with a capital, and doesn't read as prose."""
    return (F.char_length(line) <= longest) & line.rlike(r"^\s{0,10}\p{Lu}") & ~line.rlike(r"[.;,]\s*$") & (F.trim(line) != "")
