"""Data quality: rules compiled to Columns, four-valued verdicts, quarantine, adoption, resolution and gates.

Each rule becomes one struct column (verdict, observed, expected). All rules of a grain are evaluated in a single pass over
a prepared frame whose group context (counts, distinct counts, single values) comes from window aggregates, then unfolded to
one row per rule and subject.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import contains_number, percent_forms
from .select import newest_row

PASS, VIOLATION, INAPPLICABLE, NOT_EVALUATED = "pass", "violation", "inapplicable", "not_evaluated"
VERDICTS = (PASS, VIOLATION, INAPPLICABLE, NOT_EVALUATED)
_NAMES = ((PASS, "passed"), (VIOLATION, "violated"), (INAPPLICABLE, "inapplicable"), (NOT_EVALUATED, "not_evaluated"))
#: What makes a finding the same one from run to run.
IDENTITY = ("rule_id", "filing_id", "subject_key", "field_name")


class RuleError(ValueError):
    """A rule that could never fire, or says too little to run."""


@dataclass(frozen=True)
class Rule:
    """check names a predicate, params are its own; on_cell_error says what an unusable source value means."""

    id: str
    check: str
    grain: str = "plan"
    severity: str = "error"
    kind: str = "intra_row"
    states: tuple[str, ...] | None = None
    on_cell_error: str | None = None
    params: Mapping = field(default_factory=dict)

    @property
    def field_name(self) -> str | None:
        p = self.params
        return p.get("field") or p.get("value_field") or p.get("target") or (p.get("consequence") or {}).get("field")


@dataclass(frozen=True)
class Context:
    """How the frame names its subject's group and order."""

    group: tuple[str, ...] = ("filing_id",)
    order: tuple[str, ...] = ("source_line",)

    def over(self) -> Window:
        return Window.partitionBy(*self.group)


def _text(c: Column | None) -> Column:
    return F.lit(None).cast("string") if c is None else c.cast("string")


def outcome(verdict: Column, observed: Column | None = None, expected: Column | None = None) -> Column:
    return F.struct(verdict.alias("verdict"), _text(observed).alias("observed"), _text(expected).alias("expected"))


def _passes(ok: Column) -> Column:
    return F.when(ok, PASS).otherwise(VIOLATION)


def _number(c: Column) -> Column:
    return c.cast("double")


def present(p: Mapping, ctx: Context) -> Column:
    """The value is there and not empty; not evaluated where an optional gate is absent."""
    v = F.col(p["field"]).cast("string")
    out = F.when(v.isNull() | (v == ""), VIOLATION).otherwise(PASS)
    if p.get("when_present"):
        out = F.when(F.col(p["when_present"]).isNull(), NOT_EVALUATED).otherwise(out)
    return outcome(out, v)


def matches_pattern(p: Mapping, ctx: Context) -> Column:
    """The pattern is found in the value; anchors are the pattern's own business."""
    v = F.col(p["field"]).cast("string")
    return outcome(F.when(v.isNull(), NOT_EVALUATED).otherwise(_passes(v.rlike(p["pattern"]))), v, F.lit(p["pattern"]))


def in_range(p: Mapping, ctx: Context) -> Column:
    """min <= value <= max within a tolerance; bounds are numbers or columns. Not evaluated while either bound is unknown."""
    v, slack = _number(F.col(p["field"])), F.lit(float(p.get("tolerance", 0)))
    low = _number(F.col(p["min_field"])) if "min_field" in p else F.lit(float(p["min"]))
    high = _number(F.col(p["max_field"])) if "max_field" in p else F.lit(float(p["max"]))
    known = v.isNotNull() & low.isNotNull() & high.isNotNull()
    return outcome(F.when(~known, NOT_EVALUATED).otherwise(_passes((v >= low - slack) & (v <= high + slack))), v)


def value_in_band(p: Mapping, ctx: Context) -> Column:
    """The value lies in the band of its key, ends included; a key without a band, and zero, are inapplicable."""
    key, v = F.col(p["key_field"]).cast("string"), _number(F.col(p["value_field"]))
    bands = {k: b for k, b in p["bands"].items() if b is not None}
    inside = reduce(lambda a, kb: F.when(key == kb[0], (v >= float(kb[1][0])) & (v <= float(kb[1][1]))).otherwise(a), bands.items(), F.lit(None).cast("boolean"))
    out = F.when(key.isNull() | ~key.isin(*p["bands"]), NOT_EVALUATED).when(~key.isin(*bands), INAPPLICABLE).when(v.isNull(), NOT_EVALUATED)
    if p.get("inapplicable_when_zero"):
        out = out.when(v == 0, INAPPLICABLE)
    return outcome(out.otherwise(_passes(inside)), v, key)


def segment_matches(p: Mapping, ctx: Context) -> Column:
    """A slice [start, end) of an identifier equals another column."""
    start, end = p["segment"]
    v, want = F.col(p["field"]).cast("string"), F.col(p.get("equals_field", "state")).cast("string")
    got = F.upper(F.substring(v, start + 1, end - start))
    return outcome(F.when(v.isNull() | want.isNull(), NOT_EVALUATED).otherwise(_passes(got == want)), got, want)


def iff(p: Mapping, ctx: Context) -> Column:
    """A condition and a consequence hold together or not at all."""

    def holds(side: Mapping) -> Column:
        c = F.col(side["field"])
        return c.cast("string").isin(*map(str, side["in"])) if "in" in side else _number(c) == float(side["equals"])

    a, b = holds(p["condition"]), holds(p["consequence"])
    return outcome(F.when(a.isNull() | b.isNull(), NOT_EVALUATED).otherwise(_passes(a == b)), F.col(p["consequence"]["field"]), a)


def evidence_contains_number(p: Mapping, ctx: Context) -> Column:
    """The stated fraction stands in the evidence as a percentage, trimmed or with its own places, as a token of its own."""
    number, text = F.col(p["field"]).cast("string"), F.col(p["evidence_field"])
    found = contains_number(text, *percent_forms(F.col(p["field"])))
    out = F.when(number.isNull(), INAPPLICABLE).when(text.isNull() | (text == ""), VIOLATION).otherwise(_passes(found))
    return outcome(out, text, number)


def arithmetic_identity(p: Mapping, ctx: Context) -> Column:
    """The product of the factors is the target within a relative tolerance. A broadcast factor that a row lacks is its
    group's only value; a row's own value stays. A target of zero is not evaluated, or inapplicable if a parameter says so."""
    shared = set(p.get("broadcast") or ())

    def factor(name: str) -> Column:
        c = _number(F.col(name))
        if name not in shared:
            return c
        low, high = F.min(c).over(ctx.over()), F.max(c).over(ctx.over())
        return F.coalesce(c, F.when(low == high, low))

    product, target = reduce(lambda a, b: a * b, map(factor, p["factors"])), _number(F.col(p["target"]))
    zero = INAPPLICABLE if p.get("inapplicable_when_target_is_zero") else NOT_EVALUATED
    out = F.when(product.isNull() | target.isNull(), NOT_EVALUATED).when(target == 0, zero)
    return outcome(out.otherwise(_passes(F.abs(product - target) <= float(p.get("rel_tolerance", 0.005)) * F.abs(target))), target, product)


def not_degenerate(p: Mapping, ctx: Context) -> Column:
    """The values of a group of min_rows or more aren't all the same; if they are, every row of it is suspect."""
    v = F.col(p["field"])
    n, low, high = F.count(v).over(ctx.over()), F.min(v).over(ctx.over()), F.max(v).over(ctx.over())
    return outcome(F.when(v.isNull(), NOT_EVALUATED).when(n < int(p["min_rows"]), INAPPLICABLE).otherwise(_passes(low != high)), v, n)


def count_equals(p: Mapping, ctx: Context) -> Column:
    """A stated count equals the counted rows of the sibling grain, a column prepared beside it."""
    stated, counted = F.col(p["field"]), F.coalesce(F.col(p["count_field"]), F.lit(0))
    return outcome(F.when(stated.isNull(), NOT_EVALUATED).otherwise(_passes(stated.cast("long") == counted)), counted, stated)


def equals_across_sources(p: Mapping, ctx: Context) -> Column:
    """A group's first row agrees with each other row on every field that both state: pairs of numbers within a tolerance,
    other texts without regard to case. Judged once a group, on its first row; not evaluated if no pair states a field."""
    order = [F.col(c).asc_nulls_last() for c in ctx.order]
    ordered = ctx.over().orderBy(*order)
    place = F.row_number().over(ordered)
    kinds = {f: t for f, t in zip(p["fields"], p.get("numeric") or [None] * len(p["fields"]), strict=True)}
    lead = F.first(F.struct(*[F.col(f).alias(f) for f in kinds])).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    compared, differ = F.lit(0), F.lit(0)
    for name, numeric in kinds.items():
        mine, theirs = lead[name], F.col(name)
        a, b = (x.cast("double") if numeric else x.cast("string").try_cast("double") for x in (mine, theirs))
        near = F.abs(a - b) <= float(p.get("tolerance", 0)) + 1e-12
        same = near if numeric else F.coalesce(near, F.lower(F.trim(mine.cast("string"))) == F.lower(F.trim(theirs.cast("string"))))
        both = (place > 1) & mine.isNotNull() & theirs.isNotNull()
        compared, differ = compared + both.cast("int"), differ + (both & ~same).cast("int")
    pairs = F.struct(compared.alias("compared"), differ.alias("differ"))
    n, bad = F.sum(pairs["compared"]).over(ctx.over()), F.sum(pairs["differ"]).over(ctx.over())
    return outcome(F.when(place > 1, INAPPLICABLE).when(n == 0, NOT_EVALUATED).otherwise(_passes(bad == 0)), n)


def equals_manifest_field(p: Mapping, ctx: Context) -> Column:
    """A value equals the one posted for it. Not evaluated where the posting wasn't recorded, inapplicable where it is null."""
    posted, v = F.col(p["posted_field"]), F.col(p["field"])
    out = F.when(~F.coalesce(F.col(p["has_posted_field"]), F.lit(False)), NOT_EVALUATED).when(posted.isNull(), INAPPLICABLE).when(v.isNull(), NOT_EVALUATED)
    return outcome(out.otherwise(_passes(F.abs(_number(v) - _number(posted)) <= float(p.get("tolerance", 0)))), v, posted)


#: name -> (predicate, required params)
CHECKS: dict[str, tuple[Callable[[Mapping, Context], Column] | None, tuple[str, ...]]] = {
    "present": (present, ("field",)),
    "matches_pattern": (matches_pattern, ("field", "pattern")),
    "range": (in_range, ("field",)),
    "value_in_band": (value_in_band, ("key_field", "value_field", "bands")),
    "id_segment_matches": (segment_matches, ("field", "segment")),
    "iff": (iff, ("condition", "consequence")),
    "evidence_contains_number": (evidence_contains_number, ("field", "evidence_field")),
    "arithmetic_identity": (arithmetic_identity, ("factors", "target")),
    "not_degenerate": (not_degenerate, ("field", "min_rows")),
    "count_equals": (count_equals, ("field", "count_field")),
    "equals_across_sources": (equals_across_sources, ("fields",)),
    "equals_manifest_field": (equals_manifest_field, ("field", "posted_field", "has_posted_field")),
    "adopted_only": (None, ()),
}


def register_check(name: str, predicate: Callable[[Mapping, Context], Column], required: Sequence[str] = ()) -> None:
    """Adds a predicate: (params, context) -> outcome column."""
    CHECKS[name] = (predicate, tuple(required))


def load_rules(entries: Sequence[Mapping], cell_error_fields: Sequence[str] = (), sources_at_grain: Mapping[str, Sequence[str]] | None = None, adopted_reasons: Mapping[str, str] | None = None) -> list[Rule]:
    """Rules from plain mappings. Refuses what could never fire or be looked up, before any job starts."""
    rules: dict[str, Rule] = {}
    for e in entries:
        where = e.get("id") or f"rule {len(rules) + 1}"
        if not e.get("id") or e["id"] in rules:
            raise RuleError(f"{where}: the id is missing or not unique")
        if e.get("check") not in CHECKS:
            raise RuleError(f"{where}: no such check: {e.get('check')!r}")
        if e.get("severity", "error") not in ("error", "warn"):
            raise RuleError(f"{where}: severity is error or warn")
        if e.get("on_cell_error") not in (None, "not_applicable", "violation"):
            raise RuleError(f"{where}: on_cell_error is not_applicable or violation")
        p = dict(e.get("params") or {})
        missing = [k for k in CHECKS[e["check"]][1] if k not in p]
        if missing:
            raise RuleError(f"{where}: {e['check']} needs {', '.join(missing)}")
        if e["check"] == "range" and not (("min" in p or "min_field" in p) and ("max" in p or "max_field" in p)):
            raise RuleError(f"{where}: a range with one bound would never be evaluated")
        if e["check"] == "matches_pattern":
            try:
                re.compile(p["pattern"])
            except re.error as x:
                raise RuleError(f"{where}: {x}") from x
        states = (e.get("scope") or {}).get("state")
        rule = Rule(e["id"], e["check"], e.get("grain", "plan"), e.get("severity", "error"), e.get("kind", "intra_row"), tuple(states) if states else None, e.get("on_cell_error"), p)
        if rule.field_name in cell_error_fields and rule.on_cell_error is None:
            raise RuleError(f"{where}: {rule.field_name} can be unusable at its source, so on_cell_error must be given")
        if rule.kind == "cross_source" and sources_at_grain is not None and len(sources_at_grain.get(rule.grain, ())) < 2:
            raise RuleError(f"{where}: compares sources, but grain {rule.grain} has fewer than two")
        rules[rule.id] = rule
    lost = set((adopted_reasons or {}).values()) - set(rules)
    if lost:
        raise RuleError(f"adopted reasons name rules that don't exist: {sorted(lost)}")
    return list(rules.values())


def verdict_column(rule: Rule, frame: DataFrame, ctx: Context) -> Column:
    """The rule's outcome; an unusable source value is judged before the predicate sees it, a foreign state is no subject."""
    predicate = CHECKS[rule.check][0]
    out = predicate(rule.params, ctx)
    flag = f"{rule.field_name}_is_cell_error"
    if flag in frame.columns:
        verdict = VIOLATION if rule.on_cell_error == "violation" else INAPPLICABLE
        out = F.when(F.coalesce(F.col(flag), F.lit(False)), outcome(F.lit(verdict), F.lit("cell_error"))).otherwise(out)
    if rule.states:
        out = F.when(F.col("state").isin(*rule.states), out)
    return out


def evaluate(frame: DataFrame, rules: Sequence[Rule], keys: Sequence[str], ctx: Context = Context()) -> DataFrame:  # noqa: B008
    """One row per rule and subject in its scope: keys, rule_id, severity, kind, grain, field_name, verdict, observed, expected."""
    live = [r for r in rules if CHECKS[r.check][0] is not None]
    judged = frame.select(*keys, *[verdict_column(r, frame, ctx).alias(f"__v{i}") for i, r in enumerate(live)])
    rows = [F.struct(*[F.lit(x).cast("string").alias(n) for n, x in (("rule_id", r.id), ("severity", r.severity), ("kind", r.kind), ("grain", r.grain), ("field_name", r.field_name))], F.col(f"__v{i}").alias("out")) for i, r in enumerate(live)]
    long = judged.select(*keys, F.explode(F.array(*rows)).alias("r")).where("r.out is not null")
    return long.select(*keys, "r.rule_id", "r.severity", "r.kind", "r.grain", "r.field_name", "r.out.*")


def results(evaluated: DataFrame, rules: Sequence[Rule], adopted: DataFrame | None = None, resolved: DataFrame | None = None) -> DataFrame:
    """One row per configured rule, those that saw no subject with zeros. evaluated: what evaluate gives."""
    return with_totals(evaluated.groupBy("rule_id").agg(F.count("*").alias("evaluated"), *[F.count_if(F.col("verdict") == v).alias(n) for v, n in _NAMES]), rules, adopted, resolved)


def tally(frame: DataFrame, rules: Sequence[Rule], ctx: Context = Context()) -> DataFrame:  # noqa: B008
    """The counts of evaluate's verdicts by rule without its rows: every rule is counted in one aggregate over one row a
    subject, and the counts are unfolded after it."""
    live = [r for r in rules if CHECKS[r.check][0] is not None]
    judged = frame.select(*[verdict_column(r, frame, ctx)["verdict"].alias(f"__v{i}") for i, r in enumerate(live)])
    sums = judged.agg(*[F.count(f"__v{i}").alias(f"__n{i}") for i in range(len(live))], *[F.count_if(F.col(f"__v{i}") == v).alias(f"__{n}{i}") for i in range(len(live)) for v, n in _NAMES])
    rows = [F.struct(F.lit(r.id).alias("rule_id"), F.col(f"__n{i}").alias("evaluated"), *[F.col(f"__{n}{i}").alias(n) for _, n in _NAMES]) for i, r in enumerate(live)]
    return sums.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def with_totals(counts: DataFrame, rules: Sequence[Rule], adopted: DataFrame | None = None, resolved: DataFrame | None = None) -> DataFrame:
    """Counts by rule with every configured rule, and what was adopted and resolved."""
    spark = counts.sparkSession
    configured = spark.createDataFrame([(r.id, r.check, r.kind, r.grain, r.severity) for r in rules], "rule_id string, check_name string, kind string, grain string, severity string")
    out = configured.join(counts, "rule_id", "left")
    for name, rows in (("adopted", adopted), ("resolved", resolved)):
        n = F.lit(0).cast("long") if rows is None else None
        out = out.withColumn(name, n) if rows is None else out.join(rows.groupBy("rule_id").agg(F.count("*").alias(name)), "rule_id", "left")
    return out.na.fill(0)


def violations(evaluated: DataFrame, run_id: str, at: str) -> DataFrame:
    return evaluated.where(F.col("verdict") == VIOLATION).drop("verdict").withColumns({"run_id": F.lit(run_id), "quarantined_at": F.lit(at), "origin": F.lit("evaluated"), "reprocess_status": F.lit("open")})


def with_provenance(rows: DataFrame, provenance: str = "provenance") -> DataFrame:
    """method, role and locator of the field behind a finding, or the reason why there are none."""
    entry = F.col(provenance)[F.col("field_name")]
    reason = F.when(F.col("field_name").isNull(), "the rule is about no single field").when(entry.isNull(), "the field has no provenance")
    return rows.select(
        *[c for c in rows.columns if c != provenance],
        entry["method"].alias("extraction_method"),
        entry["source_document_role"].alias("source_document_role"),
        entry["source_locator"].alias("source_locator"),
        F.when(entry["source_locator"].isNull(), F.coalesce(reason, F.lit("the provenance names no place"))).alias("provenance_absent_reason"),
    )


def adopted_subject(detail: Column, role: Column, field_name: Column) -> Column:
    """Whom a miss is about: the plan id that its detail opens with (five digits, two letters, fourteen signs in all, up to
    the first colon), so that it meets that plan's own findings; else the document's role and the field."""
    head = F.trim(F.substring_index(F.coalesce(detail, F.lit("")), ":", 1))
    return F.when(head.rlike(r"^\d{5}\p{L}{2}.{7}$"), head).otherwise(F.concat_ws(".", role, field_name))


def adopt(misses: DataFrame, reasons: Mapping[str, str], run_id: str, at: str) -> DataFrame:
    """Field misses found by extraction as findings of the rules their reasons map to."""
    named = misses.sparkSession.createDataFrame(list(reasons.items()), "reason string, rule_id string")
    return misses.join(F.broadcast(named), "reason").withColumns({"run_id": F.lit(run_id), "quarantined_at": F.lit(at), "origin": F.lit("adopted"), "reprocess_status": F.lit("open")})


def unmapped_reasons(misses: DataFrame, reasons: Mapping[str, str]) -> DataFrame:
    return misses.select("reason").distinct().where(~F.col("reason").isin(*reasons) if reasons else F.lit(True))


def _key(identity: Sequence[str] = IDENTITY) -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"__k_{c}") for c in identity]


def open_findings(rows: DataFrame, at: str = "quarantined_at", line: str = "source_line") -> DataFrame:
    """The last row of each finding, where that one is open."""
    return newest_row(rows, [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in IDENTITY], at, line).where(F.col("reprocess_status") == "open")


def not_found_again(prior_open: DataFrame, now: DataFrame) -> DataFrame:
    """Findings open before that no row of this run has; nulls in the identity match nulls."""
    keys = [f"__k_{c}" for c in IDENTITY]
    return prior_open.select("*", *_key()).join(now.select(*_key()).distinct(), keys, "left_anti").drop(*keys)


def resolve(prior_open: DataFrame, found_now: DataFrame, run_id: str, at: str) -> DataFrame:
    """A resolved row for each finding that was open and isn't found any more."""
    return not_found_again(prior_open, found_now).withColumns({"run_id": F.lit(run_id), "quarantined_at": F.lit(at), "reprocess_status": F.lit("resolved")})


def gate(quarantine: DataFrame, result_rows: DataFrame, rules: Sequence[Rule], n_misses: int, prior_open: DataFrame | None = None) -> dict[str, DataFrame]:
    """Seven assertions as frames that must be empty."""
    spark: SparkSession = quarantine.sparkSession
    configured = spark.createDataFrame([(r.id,) for r in rules], "rule_id string")
    per_rule = quarantine.groupBy("rule_id").agg(F.count("*").alias("n"))
    claimed = F.col("violated") + F.col("adopted") + F.coalesce(F.col("resolved"), F.lit(0))
    reported = result_rows.groupBy("rule_id").agg(F.count("*").alias("rows"))
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    adopted = quarantine.where((F.col("origin") == "adopted") & (F.col("reprocess_status") == "open")).agg(F.count("*").alias("n"))
    checks = {
        "every finding names a known rule": quarantine.join(configured, "rule_id", "left_anti"),
        "verdicts add up": result_rows.where(F.col("evaluated") != F.col("passed") + F.col("violated") + F.col("inapplicable") + F.col("not_evaluated")),
        "one result per configured rule": configured.join(reported, "rule_id", "full").join(configured.withColumn("known", F.lit(True)), "rule_id", "left").where(F.col("rows").isNull() | (F.col("rows") != 1) | F.col("known").isNull()),
        "results match the store": result_rows.join(per_rule, "rule_id", "left").where(claimed != F.coalesce("n", F.lit(0))),
        "provenance or a reason": quarantine.where(blank("source_locator") & blank("provenance_absent_reason")),
        "every miss is adopted": adopted.where(F.col("n") != n_misses),
    }
    if prior_open is not None:
        checks["nothing vanishes silently"] = not_found_again(prior_open, quarantine)
    return checks


def exit_code(open_rows: DataFrame) -> int:
    """1 if any open finding is an error."""
    return int(not open_rows.where(F.col("severity") == "error").isEmpty())
