"""A validation run over the current extracts: prepare, evaluate, adopt, resolve, count, gate.

One frame per grain holds everything a rule may read: the rows' own columns, their filing's values as ``filing_*`` columns,
the counts of the sibling grain as ``n_plans``, and what was posted. All rules of a grain are evaluated in one pass over it.
A run appends; earlier rows are never rewritten, so validating the same extracts again only adds a run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.checks import failing
from ..operators.select import latest_complete
from .warehouse import Models

#: How many unmapped reasons an error names.
NAMED = 20
PROVENANCE = "map<string, struct<method string, source_document_role string, source_locator string>>"
#: What names a row of each grain among its filing's.
SUBJECTS = {"filing": "source_document_role", "plan": "plan_id_hios", "justification": "justification_ordinal"}


@dataclass
class Validation:
    """What a run found: rows to append, and the gate's assertions as frames that must be empty."""

    quarantine: DataFrame
    results: DataFrame
    open_before: DataFrame | None
    gate: dict[str, DataFrame]

    def breaches(self) -> dict[str, int]:
        """The assertions of the gate that don't hold, with the number of rows against each."""
        return failing(self.gate)

    def findings_code(self) -> int:
        """1 if an error is open, else 0."""
        return Q.exit_code(self.quarantine.where("reprocess_status = 'open'"))

    def exit_code(self) -> int:
        """3 if the gate is breached, 1 if an error is open, else 0."""
        return 3 if any(not df.isEmpty() for df in self.gate.values()) else self.findings_code()

    def release(self) -> None:
        self.quarantine.unpersist()
        self.results.unpersist()



def grains(m: Models) -> dict[str, DataFrame]:
    """The frames of the three grains, with filing_id, subject_key, state, provenance and source_line."""
    current = m.conformed.drop("source_row_count")
    of_filing = current.select("filing_id", *[F.col(c).alias(f"filing_{c}") for c in current.columns if c not in ("filing_id", "run_id")])
    counted = m.plans_current.groupBy("filing_id").agg(F.count("*").alias("n_plans"))
    posted = m.manifest.groupBy("filing_id").agg(F.bool_or("has_posted_avg_rate").alias("has_posted"), F.max_by("avg_rate_request_posted_fraction", F.when(F.col("has_posted_avg_rate"), F.struct("retrieved_at", "source_line"))).alias("posted"))
    rows = {"filing": m.filings_current, "plan": m.plans_current, "justification": m.justifications_current}
    out = {}
    for grain, df in rows.items():
        context = of_filing.join(counted, "filing_id", "left").join(posted, "filing_id", "left")
        named = df.withColumn("subject_key", F.col(SUBJECTS[grain]).cast("string"))
        entries = F.from_json(F.to_json("provenance"), PROVENANCE)
        out[grain] = named.withColumn("provenance", entries).join(context, "filing_id", "left")
    return out


def sources_disagree(declared: Mapping[str, Sequence[str]], manifest: DataFrame) -> DataFrame:
    """Roles that rules count on but no document has, and the other way round."""
    from ..operators.shape import coverage_both_ways

    spark = manifest.sparkSession
    roles = sorted({r for rs in declared.values() for r in rs})
    return coverage_both_ways(spark.createDataFrame([(r,) for r in roles], "document_role string"), manifest.select("document_role"), ["document_role"], "declared, never seen", "seen, not declared")


def prior_corpus_run(m: Models, before: str) -> str | None:
    return latest_complete(m.results.where(F.col("run_id") < before)).first()["run_id"]


def validate(m: Models, rules: Sequence[Q.Rule], run_id: str, reasons: Mapping[str, str] | None = None, filings: Sequence[str] | None = None) -> Validation:
    """Evaluates the rules over the current extracts. With filings the run is of filing scope: it resolves nothing and is never
    the current one. Reasons map field misses to the rules that name them; unmapped ones stop the run before it starts."""
    reasons = dict(reasons or {})
    misses = m.misses.join(m.current_runs, ["filing_id", "run_id"], "left_semi")
    if filings is not None:
        misses = misses.where(F.col("filing_id").isin(*filings))
    unknown = [r["reason"] for r in Q.unmapped_reasons(misses, reasons).limit(NAMED).collect()]
    if unknown:
        raise Q.RuleError(f"field misses carry reasons without a rule, {NAMED} of them at most: {sorted(map(str, unknown))}")
    parts, judged = [], []
    for grain, frame in grains(m).items():
        own = [r for r in rules if r.grain == grain and Q.CHECKS[r.check][0] is not None]
        if not own:
            continue
        if filings is not None:
            frame = frame.where(F.col("filing_id").isin(*filings))
        keys = ["filing_id", "subject_key", "state", "run_id", "provenance"]
        out = Q.evaluate(frame, own, keys)
        judged.append(out.drop("provenance"))
        parts.append(Q.with_provenance(Q.violations(out.withColumnRenamed("run_id", "extract_run_id"), run_id, run_id)))
    evaluated = reduce(DataFrame.unionByName, judged)
    of_rule = {name: F.create_map(*[F.lit(x) for r in rules for x in (r.id, getattr(r, name))])[F.col("rule_id")] for name in ("severity", "kind", "grain")}
    adopted = Q.adopt(misses.select("filing_id", F.col("run_id").alias("extract_run_id"), "document_role", "model_name", "field_name", "reason", "detail"), reasons, run_id, run_id).withColumns(
        of_rule
        | {
            "state": F.upper(F.substring_index("filing_id", "-", 1)),
            "subject_key": Q.adopted_subject(F.col("detail"), F.col("document_role"), F.col("field_name")),
            "source_document_role": F.col("document_role"),
            "message": F.coalesce(F.nullif("detail", F.lit("")), F.concat(F.concat_ws(".", "model_name", "field_name"), F.lit(": "), F.col("reason"))),
            "provenance_absent_reason": F.lit("a field that was missed has no value, so nothing tells where it came from"),
        }
    ).drop("reason", "detail", "document_role", "model_name") if reasons else None
    found = reduce(lambda a, b: a.unionByName(b, True), [*parts, *([adopted] if adopted is not None else [])])
    before, cleared, store = None, None, found
    prior = prior_corpus_run(m, run_id) if filings is None else None
    if prior is not None:
        before = Q.open_findings(m.quarantine.where(F.col("run_id") == prior))
        cleared = Q.resolve(before, found, run_id, run_id)
        store = found.unionByName(cleared.drop("source_file", "source_line", "loaded_at", "load_id", "message", "expected", "extract_path", "dq_schema_version"), True)
    counted = Q.results(evaluated, rules, adopted, cleared).withColumns({"run_id": F.lit(run_id), "scope": F.lit("corpus" if filings is None else "filing")})
    store, counted = store.persist(), counted.persist()  # each is read by every assertion of the gate
    return Validation(store, counted, before, Q.gate(store, counted, rules, misses.count(), before))
