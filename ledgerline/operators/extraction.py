"""From documents to rows: resolving what to read, cells and tables, precedence of readers, and the ledger that loses nothing."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import contains_number, number_in, percent_forms
from .select import first_row, last_known, newest_row
from .shape import best_by

TERMINAL = ("extracted", "partial", "skipped", "failed")
#: Spreadsheet errors as cells hold them; fixed values.
CELL_ERRORS = r"^#(?:VALUE!|REF!|N/A|NAME\?|DIV/0!|NULL!|NUM!)$"


def resolve_documents(manifest: DataFrame, keys: Sequence[str], types: Mapping[str, Sequence[str]], extensions: Mapping[str, Sequence[str]], role: str = "document_role", order: Sequence[str] = ("retrieved_at", "source_line")) -> DataFrame:
    """The latest good row of each document with its last known content type, and problem: why it can't be read, else null.

    A not-modified answer has no type of its own, so the last one seen holds. Role, type and extension must agree. Nothing
    is dropped: what can't be resolved is returned with its reason."""
    good = F.col("error").isNull() & F.col("content_hash").isNotNull()
    known = manifest.withColumn("content_type", last_known(F.col("content_type"), keys, order))
    last = newest_row(known.where(good), keys, *order)
    base = F.lower(F.trim(F.split(F.col("content_type"), ";")[0]))
    ext = F.lower(F.regexp_extract("stored_path", r"(\.[A-Za-z0-9]+)$", 1))

    def fits(value: Column, table: Mapping[str, Sequence[str]]) -> Column:
        out = F.lit(False)
        for r, allowed in table.items():
            out = out | ((F.col(role) == r) & value.isin(*allowed))
        return out

    problem = (
        F.when(F.coalesce(F.col("stored_path"), F.lit("")) == "", "no stored path")
        .when(F.col("content_type").isNull(), "no content type was ever seen")
        .when(~F.col(role).isin(*types), "unknown role")
        .when(~fits(base, types), "role and content type disagree")
        .when(~fits(ext, extensions), "role and extension disagree")
    )
    return last.withColumn("problem", problem)


def cell(raw: Column) -> tuple[Column, Column, Column]:
    """A cell's text (null for a blank or an error), its number if it is one, and whether it is a spreadsheet error."""
    text = F.nullif(F.trim(raw), F.lit(""))
    error = F.coalesce(text.rlike(CELL_ERRORS), F.lit(False))
    kept = F.when(~error, text)
    return kept, number_in(kept), error


def column_by_vote(cells: DataFrame, keys: Sequence[str], column: str, value: str, pattern: str) -> DataFrame:
    """The column of each table with most values of a pattern, then most distinct ones, then the first."""
    hits = cells.where(F.col(value).rlike(pattern)).groupBy(*keys, column).agg(F.count("*").alias("n"), F.countDistinct(value).alias("d"))
    return best_by(hits, keys, column, F.col("n"), F.col("d"))


def header_row(cells: DataFrame, keys: Sequence[str], row: str, value: str, patterns: Sequence[str]) -> DataFrame:
    """The row of each table in which most of the patterns are found; the first of several."""
    hits = sum((F.max(F.col(value).rlike(p).cast("int")) for p in patterns), F.lit(0))
    return first_row(cells.groupBy(*keys, row).agg(hits.alias("hits")).where("hits > 0"), keys, [F.desc("hits"), F.asc(row)]).drop("hits")


def first_percent_after(text: Column, anchor: Column) -> Column:
    """The first percentage after an identifier in a line, as a fraction; null if there is none."""
    tail = F.call_function("substring_index", text, anchor, F.lit(-1))
    token = F.nullif(F.regexp_extract(tail, r"(-?\d+(?:\.\d+)?)\s*%", 1), F.lit(""))
    return F.when(text.contains(anchor), (token.cast("decimal(38,18)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(38,18)"))


def within_stated(value: Column, a: Column, b: Column, tolerance: float = 0.005) -> Column:
    """Whether a value lies between two stated bounds in either order; true where a bound is unstated. Both parts are kept."""
    v, low, high = (c.cast("double") for c in (value, F.least(a, b), F.greatest(a, b)))
    return F.when(a.isNull() | b.isNull(), True).otherwise((v >= low - tolerance) & (v <= high + tolerance))


def merged(anchor: Column, model: Column, tolerance: float | None = None) -> tuple[Column, Column]:
    """The anchored value before the model's, and a note where both are stated and differ."""
    if tolerance is None:
        same = F.lower(F.trim(anchor.cast("string"))) == F.lower(F.trim(model.cast("string")))
    else:
        same = F.abs(anchor.cast("double") - model.cast("double")) <= tolerance
    note = F.when(~same, F.concat(F.lit("anchor "), anchor.cast("string"), F.lit(", model "), model.cast("string")))
    return F.coalesce(anchor, model), note


def problems_of_provenance(fields: Sequence[str], provenance: Mapping[str, Column] | None = None, entries: str = "provenance") -> Column:
    """The invariants a row breaks: values without provenance, provenance of other fields, and each method's own demands."""
    names = F.map_keys(F.coalesce(F.col(entries), F.from_json(F.lit("{}"), "map<string, struct<method string, evidence string, confidence double, model_id string, call_id string>>")))
    bare = [F.when(F.col(f).isNotNull() & ~F.array_contains(names, f), F.lit(f"{f} has no provenance")) for f in fields]
    strange = F.transform(F.filter(names, lambda n: ~n.isin(*fields)), lambda n: F.concat(n, F.lit(" is no tracked field")))

    def demands(k: Column, v: Column) -> Column:
        said = F.coalesce(v["evidence"], F.lit("")) != ""
        return (
            F.when((v["method"] == "llm") & (v["model_id"].isNull() | v["call_id"].isNull()), F.concat(k, F.lit(": no call")))
            .when((v["method"] == "llm") & ~said, F.concat(k, F.lit(": no evidence")))
            .when((v["method"] == "regex_anchor") & ~said, F.concat(k, F.lit(": no matched text")))
            .when(v["method"].isin("deterministic_cell", "table_parse") & v["confidence"].isNotNull(), F.concat(k, F.lit(": a deterministic read has no confidence")))
        )

    own = F.transform(F.map_entries(F.col(entries)), lambda e: demands(e["key"], e["value"]))
    return F.array_compact(F.concat(F.array(*bare), strange, F.coalesce(own, F.array().cast("array<string>"))))


#: The shape of a plan id: issuer, state, product and plan; a fixed value.
PLAN_ID = r"^\d{5}(?:OR|PA)\d{7}$"


def problems_of_plan_id(plan: str = "plan_id_hios", product: str = "product_id", shape: str = PLAN_ID) -> Column:
    """A plan id has its shape and lies under its product."""
    p, q = F.col(plan), F.nullif(F.col(product), F.lit(""))
    return F.array_compact(F.array(
        F.when(p.isNull() | ~p.rlike(shape), F.concat(F.coalesce(p, F.lit("null")), F.lit(" is no plan id"))),
        F.when(q.isNotNull() & ~F.coalesce(p.startswith(q), F.lit(False)), F.concat(F.coalesce(p, F.lit("null")), F.lit(" isn't under product "), q)),
    ))


def problems_of_narrative(number: str = "quantified_impact_pct", evidence: str = "evidence_quote", start: str = "source_page_start", end: str = "source_page_end", confidence: str = "confidence", stated: Sequence[str] = ("driver_category", "driver_label", "narrative")) -> Column:
    """A cited driver says what it is and quotes its evidence; a stated number stands in the quote, pages run forward from 1, and
    confidence lies between 0 and 1."""
    quote, first, last, sure = F.col(evidence), F.col(start), F.col(end), F.col(confidence)
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    return F.array_compact(F.array(
        *[F.when(blank(c), F.lit(f"{c} is empty")) for c in (*stated, evidence)],
        F.when((first < 1) | (last < 1), F.lit("pages count from 1")),
        F.when(last < first, F.lit("the page range ends before it starts")),
        F.when(F.col(number).isNotNull() & ~contains_number(quote, *percent_forms(F.col(number))), F.lit(f"{number} doesn't stand in the evidence")),
        F.when((sure < 0) | (sure > 1), F.lit("confidence lies outside 0 to 1")),
    ))


OUTCOME = "status string, error_class string, error_detail string, rows array<string>, duration_ms long"


def extracted(documents: DataFrame, keys: Sequence[str], read: Callable[[Mapping], Sequence[Mapping]], content: str = "content", skip: Mapping[str, str] | None = None, role: str = "document_role", problem: str = "problem") -> DataFrame:
    """One outcome row a document, whatever happens: keys, status, error_class, error_detail, the rows read (JSON) and the time.

    read takes a document as a mapping of its columns and returns rows of plain values. What it raises becomes a failed row of
    that document; the others go on. Documents that couldn't be resolved (problem) fail without being read, and roles in skip
    are skipped for the reason given there."""
    import json
    import time

    import pandas as pd

    passed_over, names = dict(skip or {}), documents.columns
    has_problem = problem in names

    def one(doc: dict) -> tuple:
        if has_problem and doc[problem] is not None:
            return "failed", "Unresolved", doc[problem], [], 0
        if doc.get(role) in passed_over:
            return "skipped", None, passed_over[doc[role]], [], 0
        began = time.monotonic()
        try:
            rows = [json.dumps(r, sort_keys=True, ensure_ascii=False, default=str) for r in read(doc)]
            return "extracted", None, None, rows, int((time.monotonic() - began) * 1000)
        except Exception as e:  # noqa: BLE001 - a crash is a row
            return "failed", f"{type(e).__module__}.{type(e).__qualname__}", str(e), [], int((time.monotonic() - began) * 1000)

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for record in frame.astype(object).where(frame.notna(), None).to_dict("records"):
                out = pd.DataFrame([one(record)], columns=[f.split()[0] for f in OUTCOME.split(", ")])
                for i, k in enumerate(keys):
                    out.insert(i, k, [record[k]])
                yield out

    fields = "".join(f"`{k}` {documents.schema[k].dataType.simpleString()}, " for k in keys)
    return documents.mapInPandas(work, fields + OUTCOME)


def rows_of(outcomes: DataFrame, keys: Sequence[str], schema: str) -> DataFrame:
    """The rows that documents gave, typed, beside their keys."""
    return outcomes.select(*keys, F.explode("rows").alias("__json")).select(*keys, F.from_json("__json", schema).alias("r")).select(*keys, "r.*")


def cost_by(calls: DataFrame, section: str = "target_section", failed: Column | None = None, cost: str = "cost_usd", places: int = 4) -> DataFrame:
    """Calls, failed calls, cost and mean cost by section, costs summed as decimals."""
    total = F.sum(F.col(cost).cast("decimal(38,18)"))
    bad = F.col("error").isNotNull() if failed is None else failed
    return calls.groupBy(section).agg(F.count("*").alias("calls"), F.count_if(bad).alias("failed"), total.alias("cost"), F.round(total / F.count("*"), places).alias("mean_cost"))


def split_valid(rows: DataFrame, problems: Column) -> tuple[DataFrame, DataFrame]:
    """The rows without problems, and the others with theirs."""
    judged = rows.withColumn("problems", problems)
    return judged.where(F.size("problems") == 0).drop("problems"), judged.where(F.size("problems") > 0)


def outcome_of(done: Column, error_class: Column, missed: Column, stated: Column, emitted: Column) -> Column:
    """The terminal status of a document: failed, skipped, partial or extracted."""
    return F.when(error_class.isNotNull(), "failed").when(~done, "skipped").when((missed > 0) | (stated.isNotNull() & (stated != emitted)), "partial").otherwise("extracted")


def ledger_gate(outcomes: DataFrame, expected: DataFrame, misses: DataFrame, keys: Sequence[str] = ("filing_id", "document_role")) -> dict[str, DataFrame]:
    """Assertions that a run's ledger lost nothing, as frames that must be empty."""
    k = list(keys)
    n = misses.groupBy(*k).agg(F.count("*").alias("recorded"))
    counted = outcomes.join(n, k, "left")
    value = lambda c: F.coalesce(F.col(c), F.lit(0))
    return {
        "every document has an outcome": expected.select(*k).distinct().join(outcomes.select(*k), k, "left_anti"),
        "every outcome has a document": outcomes.join(expected.select(*k), k, "left_anti"),
        "one outcome a document": outcomes.groupBy(*k).agg(F.count("*").alias("n")).where("n > 1"),
        "outcomes are terminal and say why": outcomes.where(~F.coalesce(F.col("status").isin(*TERMINAL), F.lit(False)) | ((F.col("status") != "extracted") & (F.coalesce(F.col("reason"), F.lit("")) == ""))),
        "fields add up": outcomes.where(value("fields_targeted") != value("fields_populated") + value("fields_missed")),
        "misses are recorded": counted.where(value("fields_missed") != value("recorded")),
        "a wrong count is partial": outcomes.where((F.col("status") == "extracted") & F.col("plan_count_stated").isNotNull() & (F.col("plan_count_stated") != value("plan_rows_emitted"))),
        "failures name their error": outcomes.where((F.col("status") == "failed") & (F.coalesce(F.col("error_class"), F.lit("")) == "")),
    }


def totals(outcomes: DataFrame, run: str = "run_id") -> DataFrame:
    """Per run: documents by status and the sums of what was emitted and missed."""
    sums = ("filing_rows_emitted", "plan_rows_emitted", "justification_rows_emitted", "fields_targeted", "fields_populated", "fields_missed")
    return outcomes.groupBy(run).agg(F.count("*").alias("documents"), *[F.count_if(F.col("status") == s).alias(s) for s in TERMINAL], *[F.sum(c).alias(c) for c in sums])


def section_windows(lines: DataFrame, keys: Sequence[str], heading: Column, page: str, widest: int, contents_from: int = 4) -> DataFrame:
    """Windows of pages from each heading to the next, at most widest pages; pages with contents_from or more headings are
    tables of contents and open nothing."""
    found = lines.where(heading)
    n = F.count("*").over(Window.partitionBy(*keys, page))
    real = found.withColumn("__n", n).where(F.col("__n") < contents_from).drop("__n")
    w = Window.partitionBy(*keys).orderBy(page, "line_no")
    after = F.coalesce(F.lead(page).over(w), F.col(page) + widest)
    return real.select(*keys, F.col("line").alias("heading"), F.col(page).alias("start_page"), F.least(F.greatest(after, F.col(page) + 1), F.col(page) + widest).alias("end_page"))


def write_extracts(df: DataFrame, path: str) -> None:
    """Extracted rows by state, filing and run; a run's rows are written once."""
    df.write.partitionBy("state", "filing_id", "run_id").mode("append").parquet(path)
