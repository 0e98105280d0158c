"""Rule engine, fingerprints, text functions, driver and streams."""

from __future__ import annotations

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.functions import text as T
from ledgerline.operators import fingerprint, history, quality, shape
from ledgerline.operators import select as S
from ledgerline.operators.checks import failing
from ledgerline.plans import run as R


def verdicts(spark, rows, schema, check, ctx=None, extra=None, **params):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema + ", source_line int")
    if "filing_id" not in df.columns:
        df = df.withColumn("filing_id", F.lit("f"))
    rules = quality.load_rules([{"id": "R", "check": check, "params": params} | (extra or {})])
    out = quality.evaluate(df, rules, ["source_line"], ctx or quality.Context())
    return {r["source_line"]: r["verdict"] for r in out.collect()}


P, V, I, N = quality.VERDICTS


@pytest.mark.parametrize(
    ("schema", "rows", "check", "params", "want"),
    [
        ("x string", [("a",), ("",), (None,)], "present", {"field": "x"}, [P, V, V]),
        ("x string, g string", [(None, None), (None, "y")], "present", {"field": "x", "when_present": "g"}, [N, V]),
        ("x string", [("ab",), ("zab",), ("q",), (None,)], "matches_pattern", {"field": "x", "pattern": "ab"}, [P, P, V, N]),
        ("x double", [(0.5,), (2.0,), (None,), (1.05,)], "range", {"field": "x", "min": "0", "max": "1", "tolerance": "0.1"}, [P, V, N, P]),
        ("x double, lo double, hi double", [(5.0, 1.0, 6.0), (5.0, None, 6.0), (7.0, 1.0, 6.0)], "range", {"field": "x", "min_field": "lo", "max_field": "hi"}, [P, N, V]),
        ("k string, v double", [("g", 0.8), ("g", 0.9), ("c", 0.1), ("?", 0.8), (None, 0.8), ("g", None), ("g", 0.0)], "value_in_band", {"key_field": "k", "value_field": "v", "bands": {"g": ["0.76", "0.82"], "c": None}, "inapplicable_when_zero": True}, [P, V, I, N, N, N, I]),
        ("id string, state string", [("12345OR001", "OR"), ("12345pa001", "OR"), (None, "OR")], "id_segment_matches", {"field": "id", "segment": [5, 7]}, [P, V, N]),
        ("c string, v double", [("New", 0.0), ("New", 1.0), ("Old", 0.0), ("Old", 1.0), (None, 0.0), ("New", None)], "iff", {"condition": {"field": "c", "in": ["New"]}, "consequence": {"field": "v", "equals": "0"}}, [P, V, V, P, N, N]),
        ("n string, e string", [("0.04", "up 4% now"), ("0.04", "was 1.040"), ("0.0450", "at 4.5."), (None, "x"), ("0.04", ""), ("0.04", None)], "evidence_contains_number", {"field": "n", "evidence_field": "e"}, [P, V, V, I, V, V]),
        ("a double, b double, t double", [(2.0, 3.0, 6.0), (2.0, None, 6.0), (2.0, None, 7.0), (2.0, 3.0, 0.0), (None, 3.0, 6.0)], "arithmetic_identity", {"factors": ["a", "b"], "broadcast": ["b"], "target": "t", "rel_tolerance": "0.005"}, [P, P, V, N, N]),
        ("n int, c long", [(2, 2), (2, 3), (None, 1), (0, None)], "count_equals", {"field": "n", "count_field": "c"}, [P, V, N, P]),
        ("v double, p double, h boolean", [(1.0, 1.0, True), (1.0, 2.0, True), (1.0, None, True), (None, 1.0, True), (1.0, 1.0, False), (1.0, 1.0, None)], "equals_manifest_field", {"field": "v", "posted_field": "p", "has_posted_field": "h", "tolerance": "0.01"}, [P, V, I, N, N, N]),
    ],
)
def test_each_verdict(spark, schema, rows, check, params, want):
    assert verdicts(spark, rows, schema, check, **params) == dict(enumerate(want))


def test_degenerate_groups_are_all_suspect(spark):
    rows = [("a", 1.0), ("a", 1.0), ("a", 1.0), ("a", None), ("b", 1.0), ("b", 2.0), ("b", 1.0), ("c", 1.0), ("c", 1.0)]
    assert list(verdicts(spark, rows, "filing_id string, x double", "not_degenerate", field="x", min_rows=3).values()) == [V, V, V, N, P, P, P, I, I]


def test_sources_agree_once_a_group(spark):
    rows = [("a", "Acme", "1.00"), ("a", "ACME ", "1.001"), ("b", "x", "1"), ("b", "y", None), ("c", "x", None)]
    got = verdicts(spark, rows, "filing_id string, n string, v string", "equals_across_sources", fields=["n", "v"], tolerance="0.01")
    assert list(got.values()) == [P, I, V, I, N]


def test_unusable_values_are_judged_first(spark):
    rows = [(None, True), (5.0, False)]
    for policy, want in (("not_applicable", I), ("violation", V)):
        got = verdicts(spark, rows, "x double, x_is_cell_error boolean", "range", extra={"on_cell_error": policy}, field="x", min="0", max="1")
        assert got == {0: want, 1: V}


@pytest.mark.parametrize(
    ("entries", "kw"),
    [
        ([{"id": "A", "check": "nope"}], {}),
        ([{"id": "A", "check": "present"}], {}),
        ([{"id": "A", "check": "range", "params": {"field": "x", "min": "1"}}], {}),
        ([{"id": "A", "check": "matches_pattern", "params": {"field": "x", "pattern": "("}}], {}),
        ([{"id": "A", "check": "adopted_only"}, {"id": "A", "check": "adopted_only"}], {}),
        ([{"id": "A", "check": "present", "params": {"field": "x"}}], {"cell_error_fields": ["x"]}),
        ([{"id": "A", "check": "equals_across_sources", "kind": "cross_source", "params": {"fields": ["x"]}}], {"sources_at_grain": {"plan": ["one"]}}),
        ([{"id": "A", "check": "adopted_only"}], {"adopted_reasons": {"why": "B"}}),
    ],
)
def test_rules_that_cannot_fire_are_refused(entries, kw):
    with pytest.raises(quality.RuleError):
        quality.load_rules(entries, **kw)


def engine(spark):
    rules = quality.load_rules([{"id": "LOW", "check": "range", "params": {"field": "x", "min": "0", "max": "1"}}, {"id": "SILENT", "check": "range", "scope": {"state": ["ZZ"]}, "params": {"field": "x", "min": "0", "max": "1"}}, {"id": "ADOPTED", "check": "adopted_only"}])
    df = spark.createDataFrame([("f", "p1", "OR", 5.0), ("f", "p2", "OR", 0.5), ("g", "p1", "OR", None)], "filing_id string, subject_key string, state string, x double")
    judged = quality.evaluate(df, rules, ["filing_id", "subject_key"])
    found = quality.violations(judged, "V2", "V2").withColumn("source_locator", F.lit("cell")).withColumn("provenance_absent_reason", F.lit(None).cast("string"))
    misses = spark.createDataFrame([("f", "p9", "because", "x", "locator")], "filing_id string, subject_key string, reason string, field_name string, source_locator string")
    adopted = quality.adopt(misses, {"because": "ADOPTED"}, "V2", "V2").withColumns({"severity": F.lit("error"), "provenance_absent_reason": F.lit(None).cast("string")})
    prior = found.withColumn("subject_key", F.lit("p7"))
    cleared = quality.resolve(prior, found, "V2", "V2")
    store = found.unionByName(adopted, True).unionByName(cleared, True)
    return rules, judged, found, adopted, prior, cleared, store, quality.results(judged, rules, adopted, cleared)


def test_results_count_every_rule_and_the_gate_holds(spark):
    rules, judged, found, adopted, prior, cleared, store, results = engine(spark)
    rows = {r["rule_id"]: r for r in results.collect()}
    assert [rows["LOW"][c] for c in ("evaluated", "passed", "violated", "not_evaluated", "adopted", "resolved")] == [3, 1, 1, 1, 0, 1]
    assert rows["SILENT"]["evaluated"] == 0 and rows["ADOPTED"]["adopted"] == 1
    assert failing(quality.gate(store, results, rules, 1, prior)) == {}
    assert quality.exit_code(quality.open_findings(store.withColumn("source_line", F.lit(1)))) == 1
    assert cleared.select("subject_key", "reprocess_status").collect() == [("p7", "resolved")]


@pytest.mark.parametrize(
    ("breach", "name"),
    [
        (lambda s, r: (s.withColumn("rule_id", F.lit("GHOST")), r), "every finding names a known rule"),
        (lambda s, r: (s, r.withColumn("passed", F.col("passed") + 1)), "verdicts add up"),
        (lambda s, r: (s, r.where("rule_id <> 'SILENT'")), "one result per configured rule"),
        (lambda s, r: (s, r.union(r)), "one result per configured rule"),
        (lambda s, r: (s, r.withColumn("violated", F.col("violated") + 1).withColumn("evaluated", F.col("evaluated") + 1)), "results match the store"),
        (lambda s, r: (s.withColumn("source_locator", F.lit(None).cast("string")), r), "provenance or a reason"),
        (lambda s, r: (s.where("origin <> 'adopted'"), r), "every miss is adopted"),
        (lambda s, r: (s.where("reprocess_status <> 'resolved'"), r), "nothing vanishes silently"),
    ],
)
def test_the_gate_breaks_on_purpose(spark, breach, name):
    rules, _, _, _, prior, _, store, results = engine(spark)
    store, results = breach(store, results)
    assert name in failing(quality.gate(store, results, rules, 1, prior))


def test_findings_carry_provenance_or_the_reason_for_none(spark):
    rows = spark.createDataFrame([("x", {"x": ("table_parse", "letter", "p1")}), ("y", {"x": ("table_parse", "letter", "p1")}), (None, {})], "field_name string, provenance map<string, struct<method string, source_document_role string, source_locator string>>")
    got = {r["field_name"]: (r["source_locator"], r["provenance_absent_reason"]) for r in quality.with_provenance(rows).collect()}
    assert got["x"] == ("p1", None) and got["y"][1] and got[None][1]


def hashes(spark, rows, schema="id int, a string, d decimal(20,6), n int"):
    df = spark.createDataFrame(rows, schema)
    return {r["id"]: r["normalized_field_hash"] for r in fingerprint.normalized_hash(df, ["id"], [c for c in df.columns if c != "id"]).collect()}


def test_hash_ignores_form_and_order_but_not_content(spark):
    d = Decimal
    h = hashes(spark, [(1, "a  b", d("1.50"), 1), (1, "x", d(0), 2), (2, "x", d("-0.00"), 2), (2, " a b ", d("1.5"), 1), (3, "ａ b", d("1.5"), 1), (3, "x", d(0), 2), (4, "a b", d("1.5"), 1), (5, "a b", d("1.51"), 1), (5, "x", d(0), 2), (6, "a b", d("1.5"), None), (6, "x", d(0), 2)])
    assert h[1] == h[2] == h[3] and len({h[1], h[4], h[5], h[6]}) == 4


def test_hash_takes_only_what_the_source_determines(spark):
    df = spark.createDataFrame([(1, "a", "b", {"x": "table_parse", "y": "llm"}), (2, "a", "z", {"x": "table_parse", "y": "llm"}), (3, "a", "b", {"x": "llm"})], "id int, x string, y string, m map<string, string>")
    got = {r["id"]: r for r in fingerprint.normalized_hash(df, ["id"], ["x", "y"], F.col("m")).collect()}
    assert got[1]["normalized_field_hash"] == got[2]["normalized_field_hash"] is not None
    assert (got[3]["normalized_field_hash"], got[3]["normalized_field_count"]) == (None, 0)


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_text_functions(spark):
    lit = F.lit
    r = one(
        spark,
        *[T.number_in(lit(x)).cast("string") for x in ("$1,234.50", "(3)", "7%", "abc")],
        T.slug(lit("  Société Générale, N.A. ")),
        T.zero_padded(lit("n-123"), 5),
        T.zero_padded(lit("1234567"), 5),
        T.date_in(lit("March 5, 2027")),
        T.date_from_serial(lit(44927)),
        T.version_in_etag(lit('"{AB-1},12"')),
        T.extension_of(lit("http://x/a.PDF?q=1"), lit(None), {"text/html": ".html"}),
        T.extension_of(lit("http://x/a"), lit("text/html; charset=x"), {"text/html": ".html"}),
        T.role_of(lit("Cover  Letter (final)"), {"cover letter": "letter", "letter": "other_letter"}),
        T.call_cost(*[lit(x) for x in (1000, 100, 10, 50, "3", "15")]).cast("string"),
        T.json_in_fence(lit('x ```json\n{"a": 1}\n```')).cast("string"),
        T.in_vocabulary(lit("gold "), ["Gold"]),
        T.contains_number(lit("to 1.040 or 4%"), lit("4")),
        T.contains_number(lit("to 1.040"), lit("4")),
        T.line_of(lit("a\nrate: 5\nb"), "rate"),
        T.fraction_in(lit("12.5")).cast("double"),
    )
    assert [None if x is None else float(x) for x in r[:4]] == [1234.5, -3.0, 7.0, None]
    assert list(r[4:7]) == ["societe-generale-n-a", "00123", "1234567"]
    assert r[7] == dt.date(2027, 3, 5) and r[8] == dt.date(2023, 1, 1) and r[9] == 12
    assert list(r[10:13]) == [".pdf", ".html", "letter"]
    assert float(r[13]) == 0.004128 and json.loads(r[14]) == {"a": 1} and r[15] == "Gold" and r[16] is True and r[17] is False and r[18] == "rate: 5" and r[19] == 0.125


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 3)), max_size=12))
def test_first_value_equals_a_loop(spark, rows):
    df = spark.createDataFrame([(k, v, o, i) for i, (k, v, o) in enumerate(rows)], "k int, v int, o int, i int")
    got = {r["k"]: r["v"] for r in df.groupBy("k").agg(S.value_at_first("v", "o", "i").alias("v")).collect()}
    want = {k: min((o, i) for i, (kk, _, o) in enumerate(rows) if kk == k) for k in {r[0] for r in rows}}
    want = {k: rows[i][1] for k, (_, i) in want.items()}
    assert got == want


def steps(**more):
    state = {"extract": {"E1"}, "validate": set(), "ingest": set(), "stale": {"a", "b", "c"}, "n": 0}

    def add(kind):
        state["n"] += 1
        state[kind].add(f"X{state['n']}")

    def extract(filing):
        if filing == "b":
            raise RuntimeError("b is broken")
        state["stale"].discard(filing)
        add("extract")

    base = {"run_ids": lambda k: set(state[k]), "stale": lambda: set(state["stale"]), "extract": extract, "validate": lambda: add("validate") or 0, "load": lambda: {}, "build": lambda: {}, "latest": lambda k: max(state[k], default=None)}
    return R.Steps(**(base | more)), state


def test_one_filings_failure_leaves_the_others_alone(tmp_path):
    s, state = steps()
    run = R.Run(s, str(tmp_path))
    assert run.go() == R.FAILED
    assert {x.node: x.status for x in run.record} == {"ingest": "skipped", "detect": "succeeded", "extract a": "succeeded", "extract b": "failed", "extract c": "succeeded", "redetect": "succeeded", "validate": "succeeded", "load": "succeeded", "build": "succeeded"}
    assert state["stale"] == {"b"} and len((tmp_path / "dag_nodes.jsonl").read_text().splitlines()) == 9
    assert not (tmp_path / ".lock").exists()


def test_what_does_not_converge_breaches(tmp_path):
    s, state = steps()
    s.extract = lambda filing: state["extract"].add(f"Y{filing}")
    assert R.Run(s, str(tmp_path)).go() == R.BREACHED


def test_a_code_without_an_effect_is_a_failure(tmp_path):
    s, _ = steps(validate=lambda: 0)
    run = R.Run(s, str(tmp_path))
    run.go()
    assert next(x for x in run.record if x.node == "validate").status == "failed"


def test_locks_and_codes(tmp_path):
    with R.lock(str(tmp_path)):
        assert R.Run(steps()[0], str(tmp_path)).go() == R.DENIED
    assert [R.combine_exit(c) for c in ([], [0, 1], [1, 3], [3, 2, 0])] == [0, 1, 3, 2]
    t = dt.datetime(2027, 1, 1, tzinfo=dt.UTC)
    assert R.run_stamp(t, {"20270101T000000Z"}) == "20270101T000001Z"
    assert R.validation_is_current("E1", "E2") and not R.validation_is_current("E2", None) and R.validation_is_current(None, None)


@pytest.mark.parametrize("order", ["in order", "shuffled", "reversed"])
def test_streams_equal_batches(spark, tmp_path, order):
    """Whatever order the files come in: their times are set, so which are read together is too."""
    from ledgerline.streaming import sightings

    schema = "filing_id string, document_role string, retrieved_at string, content_hash string, error string"
    stamp = lambda n: f"20270101T00{n:02d}00Z"
    rows = [("f", "u", stamp(1), "A", None), ("f", "u", stamp(2), "A", None), ("f", "u", stamp(3), None, "x"), ("f", "u", stamp(4), "B", None), ("f", "u", stamp(5), "A", None), ("g", "u", stamp(1), "A", None), ("g", "u", stamp(9), "C", None)]
    places = {"in order": range(7), "shuffled": [4, 6, 0, 3, 5, 1, 2], "reversed": range(6, -1, -1)}[order]
    later = [("h", "u", "20270102T000000Z", "Z", None), ("h", "u", "20270103T000000Z", "Y", None)]  # moves the watermark past all others
    for n, r in enumerate([*(rows[i] for i in places), *later]):
        path = tmp_path / "in" / f"{n}.json"
        path.parent.mkdir(exist_ok=True)
        path.write_text(json.dumps(dict(zip(("filing_id", "document_role", "retrieved_at", "content_hash", "error"), r, strict=True))) + "\n")
        os.utime(path, (1_700_000_000 + 60 * n,) * 2)
    stream = sightings.read_ledger(spark, str(tmp_path / "in"), schema, 2)
    q = sightings.episodes(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert q.awaitTermination(180)
    got = spark.read.parquet(str(tmp_path / "out")).where("filing_id <> 'h'").collect()
    good = spark.createDataFrame(rows, schema).where("error is null")
    want = history.episodes(good, ["filing_id", "document_role"], ["retrieved_at"], "content_hash", seq="content_version_seq").select("filing_id", "document_role", "content_version_seq", "content_hash", "first_seen_at").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_history_by_batches_equals_all_at_once(spark, tmp_path):
    from ledgerline.streaming import sightings

    rows = [(k, t, "AB"[(k * t // 3) % 2]) for k in range(20) for t in range(12)]
    write = sightings.upsert_history(spark, str(tmp_path), "k", "t", "label")
    for n, part in enumerate((rows[1::3], rows[0::3], rows[2::3])):
        write(spark.createDataFrame(part, "k int, t int, label string"), n)
    want = history.type2(spark.createDataFrame(rows, "k int, t int, label string"), "k", "t", "t", "label")
    assert sorted(sightings.current_history(spark, str(tmp_path), "k").collect()) == sorted(want.collect())


def test_evidence_is_a_percentage(spark):
    cases = [("0.04", "a 4% increase", "pass"), ("0.04", "a 4.0% increase", "violation"), ("0.0400", "a 4.0000% increase", "pass"), ("0.04", "a 1.040 adjustment was made", "violation"), ("0.04", "rates rise by 4.", "violation"), ("0.045", "of 4.5%", "pass"), ("0.0450", "of 4.50%", "violation"), ("0.0450", "of 4.5000%", "pass"), ("-0.02", "fell by -2 percent", "pass"), ("0.04", "0.04", "violation"), ("1.5", "150% more", "pass"), (None, "4%", "inapplicable"), ("0.04", "", "violation"), ("0.04", None, "violation")]
    df = spark.createDataFrame([(i, n, t) for i, (n, t, _) in enumerate(cases)], "id int, n string, t string")
    rule = quality.load_rules([{"id": "R", "check": "evidence_contains_number", "params": {"field": "n", "evidence_field": "t"}}])
    for kind in ("string", "double"):
        got = {r["id"]: r["verdict"] for r in quality.evaluate(df.withColumn("n", F.col("n").cast(kind)), rule, ["id"]).collect()}
        assert [got[i] for i, c in enumerate(cases) if kind == "string" or c[0] not in ("0.0400", "0.0450")] == [v for n, _, v in cases if kind == "string" or n not in ("0.0400", "0.0450")]


def test_broadcast_fills_only_what_a_row_lacks(spark):
    rule = lambda **p: quality.load_rules([{"id": "R", "check": "arithmetic_identity", "params": {"factors": ["a", "b"], "broadcast": ["b"], "target": "t", **p}}])
    rows = [("f", 1, 2.0, 3.0, 6.0), ("f", 2, 2.0, 4.0, 8.0), ("f", 3, 2.0, None, 8.0), ("g", 1, 2.0, 5.0, 10.0), ("g", 2, 3.0, None, 15.0), ("g", 3, 3.0, None, 0.0), ("g", 4, None, None, 0.0), ("g", 5, 3.0, None, None)]
    df = spark.createDataFrame(rows, "filing_id string, n int, a double, b double, t double")
    verdicts = lambda r: [x["verdict"] for x in quality.evaluate(df, r, ["filing_id", "n"]).orderBy("filing_id", "n").collect()]
    assert verdicts(rule()) == ["pass", "pass", "not_evaluated", "pass", "pass", "not_evaluated", "not_evaluated", "not_evaluated"]
    assert verdicts(rule(inapplicable_when_target_is_zero=True))[5:7] == ["inapplicable", "not_evaluated"]


def test_sources_are_compared_with_the_first(spark):
    groups = {"a": (["1.00", "1.04", "0.96"], "pass"), "b": (["1.00", "1.06"], "violation"), "c": ([None, "1", "9"], "not_evaluated"), "d": (["1.00"], "not_evaluated"), "e": (["X y", " x Y "], "pass"), "f": (["X", "Y", "X"], "violation"), "g": (["1", None, "7"], "violation"), "h": (["1.0", "1"], "pass"), "i": (["1", "x"], "violation")}
    df = spark.createDataFrame([(g, n, v) for g, (vs, _) in groups.items() for n, v in enumerate(vs)], "filing_id string, source_line int, v string")
    rule = quality.load_rules([{"id": "R", "check": "equals_across_sources", "params": {"fields": ["v"], "tolerance": "0.05"}}])
    got = {(r["filing_id"], r["source_line"]): r["verdict"] for r in quality.evaluate(df, rule, ["filing_id", "source_line"]).collect()}
    assert {g: got[g, 0] for g in groups} == {g: v for g, (_, v) in groups.items()} and {v for k, v in got.items() if k[1]} == {"inapplicable"}


def test_counts_in_one_aggregate_equal_those_of_the_rows(spark):
    rules = quality.load_rules([{"id": "A", "check": "range", "params": {"field": "v", "min": 1, "max": 5}}, {"id": "B", "check": "present", "scope": {"state": ["X"]}, "params": {"field": "v"}}, {"id": "C", "check": "not_degenerate", "params": {"field": "v", "min_rows": 3}}, {"id": "D", "check": "adopted_only"}])
    df = spark.createDataFrame([("f", i, "XY"[i % 2], None if i % 5 == 0 else float(i % 7)) for i in range(40)], "filing_id string, source_line int, state string, v double")
    assert sorted(quality.with_totals(quality.tally(df, rules), rules).collect()) == sorted(quality.results(quality.evaluate(df, rules, ["source_line"]), rules).collect())
    assert quality.with_totals(quality.tally(df.where("false"), rules), rules).where("evaluated > 0").isEmpty()


def test_currency_of_failed_sightings(spark):
    cases = [(None, "a", True, False, "unknown"), ("a", None, False, False, "never_extracted"), ("a", "a", True, False, "current"), ("a", "b", True, False, "stale"), ("a", None, True, False, "stale"), ("a", "a", True, True, "unknown"), ("a", "b", True, True, "stale"), ("a", "a", True, None, "current")]
    df = spark.createDataFrame([c[:4] for c in cases], "known string, got string, there boolean, failed boolean")
    assert [r[0] for r in df.select(history.currency(F.col("known"), F.col("got"), F.col("there"), F.col("failed"))).collect()] == [c[4] for c in cases]


def test_who_a_miss_is_about(spark):
    cases = [("75729PA0012632: parsed 0.02 falls outside", "75729PA0012632"), (" 75729PA0012632 : x", "75729PA0012632"), ("7572PA0012632: x", "urrt.rate"), ("75729PA00126321: x", "urrt.rate"), (None, "urrt.rate"), ("no plan", "urrt.rate")]
    df = spark.createDataFrame([(d,) for d, _ in cases], "d string")
    assert [r[0] for r in df.select(quality.adopted_subject(F.col("d"), F.lit("urrt"), F.lit("rate"))).collect()] == [x for _, x in cases]


def test_anchors_are_blind_to_case_and_in_order(spark):
    text = "Intro\nTotal RATE:  5.1 % and rate: 6\nother\n  Rate: 7  "
    (r,) = spark.createDataFrame([(text,)], "t string").select(T.labelled_hits(F.col("t"), r"rate:\s*([\d.]+)").alias("hits"), T.first_anchor(F.col("t"), ["absent (x)", "total rate:(.*?)%"]).alias("first"), T.labelled_hits(F.col("t"), "absent (.)").alias("none")).collect()
    assert [tuple(h) for h in r["hits"]] == [(0, "5.1", "Total RATE:  5.1 % and rate: 6"), (1, "6", "Total RATE:  5.1 % and rate: 6"), (2, "7", "Rate: 7")] and r["first"] == "5.1" and r["none"] == []


def test_sections_prefer_headings_to_prose(spark):
    pages = {
        "d": ["Contents\nMorbidity\nTrend\nBenefits\nRisk", "We mention TREND in prose,", "4.1 Morbidity\ntext", "Trend\nmore", "benefits are discussed at length here, in prose.", "x", "y", "z", "w"],
        "e": ["nothing of it"],
        "f": ["Morbidity and more", "as the risk of it grows."],
    }
    df = spark.createDataFrame([(d, i, t) for d, ts in pages.items() for i, t in enumerate(ts)], "doc string, page int, text string")
    got = T.located_sections(df, ["doc"], "page", "text", {"morbidity": ["morbidity"], "trend": ["trend", "tendency"], "benefit": ["benefits?"], "risk": ["risk"]}).collect()
    rows = {(r["doc"], r["section"]): (r["page_start"], r["page_end"], r["heading"]) for r in got}
    assert {k: v for k, v in rows.items() if v[0] is not None} == {
        ("d", "morbidity"): (2, 2, "4.1 Morbidity"), ("d", "trend"): (3, 3, "Trend"), ("d", "benefit"): (4, 7, "benefits are discussed at length here, in prose."),
        ("f", "morbidity"): (0, 0, "Morbidity and more"), ("f", "risk"): (1, 1, "as the risk of it grows."),
    }
    assert len(rows) == 12


def test_canonical_numbers_and_lists(spark):
    df = spark.createDataFrame([(1, 1e25, [" a\tb ", None, "ﬁ"], [1.50, 2.0]), (2, 1.5e-25, [], None), (3, 12.5, None, [0.0])], "id int, x double, t array<string>, n array<double>")
    got = {r["id"]: (r["x"], r["t"], r["n"]) for r in df.select("id", *[fingerprint.canonical(df, c).alias(c) for c in ("x", "t", "n")]).collect()}
    assert got == {1: ('"10000000000000000000000000"', '["a b",null,"fi"]', '["1.5","2"]'), 2: ('"0.00000000000000000000000015"', "[]", "null"), 3: ('"12.5"', "null", '["0"]')}


def test_neighbours_of_labels(spark):
    cells = spark.createDataFrame([("r", 1, "Rate", True), ("r", 2, "5", False), ("r", 4, "Name", True), ("r", 5, "x", False), ("r", 5, "y", False), ("r", 9, "End", True), ("s", 1, "Rate", True)], "row string, c int, v string, is_label boolean")
    got = {tuple(r) for r in shape.label_neighbours(cells, ["row"], "c", "v", "is_label").collect()}
    assert got == {("r", 1, "Rate", "5"), ("r", 4, "Name", "x"), ("r", 4, "Name", "y"), ("r", 9, "End", None), ("s", 1, "Rate", None)}


def test_provenance_invariants(spark):
    from ledgerline.operators import extraction

    schema = "id int, x string, y string, provenance map<string, struct<method string, evidence string, confidence double, model_id string, call_id string>>"
    ok = ("table_parse", None, None, None, None)
    rows = [
        (1, "a", None, {"x": ok}),
        (2, "a", "b", {"x": ok}),
        (3, "a", None, {"x": ok, "z": ok}),
        (4, "a", None, {"x": ("llm", "said", None, "m", None)}),
        (5, "a", None, {"x": ("llm", None, None, "m", "c")}),
        (6, "a", None, {"x": ("regex_anchor", "", None, None, None)}),
        (7, "a", None, {"x": ("deterministic_cell", None, 0.9, None, None)}),
        (8, None, None, None),
        (9, "a", None, {"x": ("llm", "said", 0.5, "m", "c")}),
        (10, "a", None, None),
    ]
    good, bad = extraction.split_valid(spark.createDataFrame(rows, schema), extraction.problems_of_provenance(["x", "y"]))
    assert {r["id"] for r in good.collect()} == {1, 8, 9}
    assert {r["id"]: len(r["problems"]) for r in bad.collect()} == {2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 10: 1}


def test_a_ledger_without_losses_passes(spark):
    from ledgerline.operators import extraction

    rows = spark.createDataFrame([("f", "u", "extracted", None, None, 2, 2, 0, 3, 3), ("f", "l", "partial", "short", None, 2, 1, 1, None, 0)], "filing_id string, document_role string, status string, reason string, error_class string, fields_targeted int, fields_populated int, fields_missed int, plan_count_stated int, plan_rows_emitted int")
    misses = spark.createDataFrame([("f", "l")], "filing_id string, document_role string")
    assert failing(extraction.ledger_gate(rows, rows, misses)) == {}
    broken = {
        "every document has an outcome": (rows.where("document_role = 'u'"), misses),
        "one outcome a document": (rows.union(rows.where("document_role = 'u'")), misses),
        "outcomes are terminal and say why": (rows.withColumn("reason", F.lit(None).cast("string")), misses),
        "fields add up": (rows.withColumn("fields_targeted", F.lit(9)), misses),
        "misses are recorded": (rows, misses.where("false")),
        "a wrong count is partial": (rows.withColumn("plan_rows_emitted", F.lit(9)), misses),
        "failures name their error": (rows.withColumns({"status": F.lit("failed"), "reason": F.lit("x")}), misses),
    }
    for name, (o, m) in broken.items():
        assert name in failing(extraction.ledger_gate(o, rows, m))


def test_pages_of_contents_open_no_section(spark):
    from ledgerline.operators import extraction

    lines = [("d", 1, n, "Heading") for n in range(4)] + [("d", 3, 10, "Part one"), ("d", 3, 11, "prose goes on."), ("d", 9, 20, "Part two")]
    df = spark.createDataFrame(lines, "doc string, page int, line_no int, line string")
    got = extraction.section_windows(df, ["doc"], T.is_heading(F.col("line")), "page", 4).orderBy("start_page").collect()
    assert [(r["heading"], r["start_page"], r["end_page"]) for r in got] == [("Part one", 3, 7), ("Part two", 9, 13)]


@pytest.mark.parametrize(
    ("name", "most"),
    [("episodes", 1), ("scd2_history", 2), ("dq_cross_source", 1), ("dq_degenerate", 1), ("normalized_hash", 1), ("label_neighbours", 1), ("dq_results", 3), ("drift_steps", 1), ("pit_join_sorted", 5), ("located_sections", 1), ("quarantine_marks", 3)],
)
def test_shuffles_are_few(spark, name, most):
    """Shuffles by key in the plan, with nothing broadcast; two of dq_results are of a row a rule."""
    import __spark_entry__

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = __spark_entry__.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning") <= most, plan
