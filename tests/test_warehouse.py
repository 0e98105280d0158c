"""The star schema over small trees: history signals, run selection, conformance, trust and the amended tree end to end."""

from __future__ import annotations

import json

import pytest

from ledgerline.operators.checks import failing
from ledgerline.plans.warehouse import SEED, Models
from ledgerline.sources import landing

TABLES = (*landing.LEDGERS, *landing.EXTRACTS)


def models(spark, seed=None, **tables):
    return Models({t: landing.from_rows(spark, tables.get(t, []), f"{t}.jsonl") for t in TABLES}, seed)


def sighting(filing, run, content, role="urrt", **more):
    return {"manifest_schema_version": 2, "run_id": run, "retrieved_at": run, "filing_id": filing, "document_role": role, "state": "OR", "content_hash": content, "error": None, "carrier_label_raw": "Carrier"} | more


def outcome(filing, run, content, fields=None, version=1, role="urrt", **more):
    row = {"run_id": run, "filing_id": filing, "document_role": role, "content_hash": content, "status": "extracted", "ledger_version": 2, "normalized_field_hash": fields, "normalized_hash_version": version, "dry_run": False} | more
    if row["ledger_version"] == 1:
        for k in ("normalized_field_hash", "normalized_hash_version", "dry_run"):
            row.pop(k)
    return row


def signals(m, filing="f"):
    rows = m.document_versions.where(f"filing_id = '{filing}'").orderBy("content_version_seq").collect()
    return [(r["validator_moved"], r["bytes_moved"], r["fields_moved"]) for r in rows], rows


def test_absent_null_and_value_stay_apart(spark):
    base = {"run_id": "R", "filing_id": "f"}
    m = models(spark, ingest_manifest=[base, base | {"avg_rate_request_posted": "11.9%"}, base | {"avg_rate_request_posted": None}])
    rows = m.manifest.orderBy("source_line").collect()
    assert [r["has_posted_avg_rate"] for r in rows] == [False, True, True]
    assert [None if r["avg_rate_request_posted_fraction"] is None else float(r["avg_rate_request_posted_fraction"]) for r in rows] == [None, 0.119, None]


def test_ledger_versions_by_key(spark):
    m = models(spark, extraction_outcomes=[outcome("f", "E1", "H", ledger_version=1), outcome("f", "E2", "H", "N"), outcome("f", "E3", "H", None, dry_run=True)])
    rows = m.outcomes.orderBy("source_line").collect()
    assert [(r["has_normalized_hash"], r["has_dry_run_flag"], r["dry_run"]) for r in rows] == [(False, False, None), (True, True, False), (True, True, True)]


def test_decimal_error_and_nothing(spark):
    m = models(spark, plan_extracts=[{"plan_id_hios": "a", "loss_ratio": "0.115161378099627"}, {"plan_id_hios": "b", "loss_ratio": {"raw": "#VALUE!", "cell": "C3"}}, {"plan_id_hios": "c", "loss_ratio": None}])
    rows = m.plans.orderBy("plan_id_hios").collect()
    assert [(None if r["loss_ratio"] is None else str(r["loss_ratio"].normalize()), r["loss_ratio_is_cell_error"]) for r in rows] == [("0.115161378099627", False), (None, True), (None, False)]


@pytest.mark.parametrize(
    ("etags", "fields", "want"),
    [
        (("e1", "e2"), ("N1", "N2"), (True, True, True)),
        (("e1", "e2"), ("N1", "N1"), (True, True, False)),
        (("e1", "e1"), ("N1", "N2"), (False, True, True)),
    ],
)
def test_three_signals(spark, etags, fields, want):
    m = models(
        spark,
        ingest_manifest=[sighting("f", "T1", "H1", etag=etags[0]), sighting("f", "T2", "H2", etag=etags[1])],
        extraction_outcomes=[outcome("f", "E1", "H1", fields[0]), outcome("f", "E2", "H2", fields[1])],
    )
    got, rows = signals(m)
    assert got == [(None, None, None), want]
    assert [r["is_current"] for r in rows] == [False, True]


def test_same_bytes_fold_into_one_version(spark):
    m = models(spark, ingest_manifest=[sighting("f", "T1", "H", etag="e1"), sighting("f", "T2", "H", etag="e1", http_status=304), sighting("f", "T3", "H", etag="e9")])
    _, rows = signals(m)
    assert [(r["sighting_count"], r["etag"], r["first_seen_at"], r["last_seen_at"], r["is_current"]) for r in rows] == [(3, "e1", "T1", "T3", True)]


def test_unknown_fields_are_not_unmoved(spark):
    seen = [sighting(f, t, h, etag=t) for f in "abc" for t, h in (("T1", "H1"), ("T2", "H2"))]
    done = [
        outcome("a", "E1", "H1", ledger_version=1),
        outcome("a", "E2", "H2", "N2"),
        outcome("b", "E1", "H1", "N1"),
        outcome("b", "E2", "H2", "N9", 2),
        outcome("c", "E1", "H1", "N1"),
        outcome("c", "E3", "H2", "N2", dry_run=True),
    ]
    m = models(spark, ingest_manifest=seen, extraction_outcomes=done)
    assert [signals(m, f)[0][1] for f in "abc"] == [(True, True, None), (True, True, None), (True, True, True)]


def test_reverts_are_episodes_and_failures_open_nothing(spark):
    m = models(spark, ingest_manifest=[sighting("f", "T1", "H1"), sighting("f", "T2", "H2"), sighting("f", "T3", None, error="HTTP 500"), sighting("f", "T4", "H1")])
    _, rows = signals(m)
    assert [(r["content_version_seq"], r["content_hash"], r["first_run_id"], r["prior_content_hash"]) for r in rows] == [(1, "H1", "T1", None), (2, "H2", "T2", "H1"), (3, "H1", "T4", "H2")]


def test_live_runs_come_before_dry_ones(spark):
    m = models(spark, extraction_outcomes=[outcome("a", "E1", "H", "N"), outcome("a", "E2", "H", "N", dry_run=True), outcome("b", "E1", "H", ledger_version=1), outcome("c", "E4", "H", "N", dry_run=True)])
    assert {r["filing_id"]: r["run_id"] for r in m.current_runs.collect()} == {"a": "E1", "b": "E1", "c": "E4"}


def finding(run, rule="RULE", subject="P1", status="open", **more):
    return {"run_id": run, "quarantined_at": run, "rule_id": rule, "severity": "error", "grain": "plan", "filing_id": "or-1", "subject_key": subject, "field_name": "cumulative_rate_change_pct", "origin": "evaluated", "extract_run_id": "20260801T000000Z", "reprocess_status": status, "source_locator": "x"} | more


def result(run, rule="RULE", **more):
    return {"run_id": run, "rule_id": rule, "check": "range", "evaluated": 2, "passed": 1, "violated": 1, "inapplicable": 0, "not_evaluated": 0, "adopted": 0} | more


def test_only_complete_runs_are_current_and_the_last_status_wins(spark):
    rows = [finding("V1"), finding("V2", subject="P1"), finding("V2", subject="P2"), finding("V2", subject="P2", status="resolved", quarantined_at="V2b"), finding("V3", subject="P9")]
    m = models(spark, quarantine=rows, dq_results=[result("V1"), result("V2", scope="corpus"), result("V3", scope="filing")])
    assert sorted((r["subject_key"], r["reprocess_status"]) for r in m.quarantine_current.collect()) == [("P1", "open"), ("P2", "resolved")]
    assert models(spark, quarantine=rows).quarantine_current.count() == 0


def prov(role):
    return {"company_legal_name": {"method": "regex_anchor", "source_document_role": role, "source_locator": "p1"}}


def test_conformance_prefers_sources_field_by_field(spark):
    m = models(
        spark,
        extraction_outcomes=[outcome("f", "E1", "H", "N")],
        filing_extracts=[
            {"filing_id": "f", "run_id": "E1", "state": "OR", "hios_issuer_id": "111", "serff_tracking_number": None, "avg_rate_change_requested": {"raw": "#REF!", "cell": "A1"}, "provenance": prov("urrt")},
            {"filing_id": "f", "run_id": "E1", "state": "OR", "hios_issuer_id": "999", "serff_tracking_number": "S-1", "avg_rate_change_requested": "0.07", "provenance": prov("letter")},
        ],
    )
    (r,) = m.conformed.collect()
    assert (r["hios_issuer_id"], r["serff_tracking_number"], float(r["avg_rate_change_requested"]), r["avg_rate_change_requested_is_cell_error"], r["source_row_count"]) == ("111", "S-1", 0.07, False, 2)


def plan(filing, pid, rate, run="20260801T000000Z", state="OR", **more):
    return {"filing_id": filing, "run_id": run, "state": state, "plan_year": 2027, "plan_id_hios": pid, "cumulative_rate_change_pct": rate, "plan_category": "Renewing", "provenance": {}} | more


def test_statuses_in_order(spark):
    e = {"raw": "#VALUE!", "cell": "B2"}
    run = "20260801T000000Z"
    plans = [
        plan("or-1", "P1", "0.1", approved_rate_change_pct="0.08"),
        plan("or-1", "P2", e, approved_rate_change_pct=e),
        plan("or-1", "P3", None),
        plan("or-1", "P4", "0", plan_category="New", approved_rate_change_pct="0"),
        plan("or-1", "P5", "0.1", approved_rate_change_pct="0.08"),
        plan("pa-1", "P6", "0.1", state="PA", approved_rate_change_pct="0.05"),
        plan("pa-2", "P7", "0.1", state="PA", approved_rate_change_pct="0.05"),
    ]
    filings = [{"filing_id": f, "run_id": run, "state": f[:2].upper(), "hios_issuer_id": f, "provenance": prov("urrt")} | x for f, x in (("or-1", {}), ("pa-1", {"rate_change_min": "0.01", "rate_change_max": "0.2"}), ("pa-2", {}))]
    m = models(
        spark,
        plan_extracts=plans,
        filing_extracts=filings,
        extraction_outcomes=[outcome(f["filing_id"], run, "H" + f["filing_id"], "N") for f in filings],
        ingest_manifest=[sighting(f["filing_id"], "20260701T000000Z", "H" + f["filing_id"]) for f in filings],
        quarantine=[finding("V1"), finding("V1", field_name="approved_rate_change_pct")],
        dq_results=[result("V1", scope="corpus")],
    )
    got = {r["plan_id_hios"]: r for r in m.fct_plan_rate.collect()}
    assert {k: r["rate_change_status"] for k, r in got.items()} == {"P1": "quarantined", "P2": "cell_error", "P3": "missing", "P4": "structural_zero", "P5": "single_source_deterministic", "P6": "carrier_range_validated", "P7": "unvalidated_parse"}
    assert {k: r["approved_rate_change_status"] for k, r in got.items()} == {"P1": "quarantined", "P2": "cell_error", "P3": "missing", "P4": "structural_zero", "P5": "single_source_deterministic", "P6": "unvalidated_parse", "P7": "unvalidated_parse"}
    assert got["P1"]["rate_change_requested"] is None and float(got["P1"]["rate_change_requested_as_parsed"]) == 0.1 and got["P1"]["rate_change_quarantine_rule_ids"] == ["RULE"]
    assert float(got["P5"]["approved_minus_requested"]) == pytest.approx(-0.02) and got["P1"]["approved_minus_requested"] is None
    assert all(r["company_key"] for r in got.values())


def test_renamed_companies_get_windows(spark):
    run = "20260801T000000Z"
    m = models(
        spark,
        filing_extracts=[{"filing_id": "f", "run_id": run, "state": "OR", "hios_issuer_id": "111", "provenance": prov("urrt")}],
        extraction_outcomes=[outcome("f", run, "H", "N")],
        ingest_manifest=[sighting("f", "20260701T000000Z", "H", carrier_label_raw="Old"), sighting("f", "20260702T000000Z", "H", carrier_label_raw="Old"), sighting("f", "20260703T000000Z", None, error="x", carrier_label_raw="Wrong"), sighting("f", "20260901T000000Z", "H", carrier_label_raw="New")],
    )
    rows = m.dim_company.orderBy("version_seq").collect()
    assert [(r["carrier_label_raw"], r["valid_from"], r["valid_to"], r["is_current"]) for r in rows] == [("Old", "00000000T000000Z", "20260901T000000Z", False), ("New", "20260901T000000Z", None, True)]
    assert rows[0]["valid_from_at"] is None and rows[0]["valid_to_at"] == rows[1]["valid_from_at"]


@pytest.fixture
def tree(tmp_path):
    """Two filings; one workbook republished and extracted again; a later dry run; a corpus and a filing-scoped validation."""
    i1, i2, a, b, dry, v1, v2 = (f"2026080{n}T000000Z" for n in range(1, 8))

    def jsonl(path, rows):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text("\n\n".join(json.dumps(r) for r in rows) + "\n")

    def extract(filing, run, rate):
        folder = tmp_path / "extracted" / filing[:2] / filing / run
        folder.mkdir(parents=True)
        state = filing[:2].upper()
        ids = ("P1", "P2", "P3") if filing == "or-1" else ("P1", "P2")
        (folder / "plans.json").write_text(json.dumps([plan(filing, p, rate if k == 0 else "0.05", run, state) for k, p in enumerate(ids)]))
        (folder / "filing.json").write_text(json.dumps([{"filing_id": filing, "run_id": run, "state": state, "hios_issuer_id": filing, "provenance": prov("urrt")}]))

    seen = [sighting(f, i1, h, role, sharepoint_version=3, etag="e1") for f, role, h in (("or-1", "urrt", "W1"), ("or-1", "letter", "L1"), ("pa-1", "urrt", "X1"))]
    seen += [sighting("or-1", i2, "W2", sharepoint_version=4, etag="e2"), sighting("or-1", i2, "L1", "letter", http_status=304, sharepoint_version=3, etag="e1"), sighting("pa-1", i2, "X1", http_status=304, sharepoint_version=3, etag="e1")]
    jsonl("raw/ingest_manifest.jsonl", seen)
    done = [outcome("or-1", a, "W1", "N1"), outcome("pa-1", a, "X1", "N5"), outcome("or-1", b, "W2", "N2"), outcome("or-1", dry, "W2", "N3", dry_run=True)]
    jsonl("extracted/_ledger/extraction_outcomes.jsonl", done)
    for f, run, rate in (("or-1", a, "0.081"), ("pa-1", a, "0.04"), ("or-1", b, "0.085"), ("or-1", dry, "0.999")):
        extract(f, run, rate)
    jsonl("validated/quarantine.jsonl", [finding(v1, subject="P2", extract_run_id=b), finding(v1, subject="P3", extract_run_id=a), finding(v1, subject="P3", extract_run_id=a, status="resolved", quarantined_at=v1 + "b"), finding(v2, subject="P1", extract_run_id=b)])
    jsonl("validated/dq_results.jsonl", [result(v1, scope="corpus"), result(v2, scope="filing")])
    return tmp_path, (i2, a, b, v1)


def test_amended_tree_end_to_end(spark, tree, tmp_path):
    root, (i2, a, b, v1) = tree
    raw = landing.read_all(spark, str(root), "LOAD")
    lines = [r["source_line"] for r in raw["ingest_manifest"].orderBy("source_line").collect()]
    assert lines == [1, 3, 5, 7, 9, 11]  # blank lines keep their numbers
    seed = spark.createDataFrame([("OR", "or-1", "S1", "Issuer", None, None, "x", "y", None)], SEED)
    m = Models(raw, seed)
    facts = m.fct_plan_rate.collect()
    assert len(facts) == 5 == len({(r["filing_id"], r["plan_id_hios"]) for r in facts})
    assert {r["extract_run_id"] for r in facts if r["filing_id"] == "or-1"} == {b} and {r["extract_run_id"] for r in facts if r["filing_id"] == "pa-1"} == {a}
    one = next(r for r in facts if (r["filing_id"], r["plan_id_hios"]) == ("or-1", "P1"))
    assert float(one["rate_change_requested"]) == 0.085
    assert [(r["filing_id"], r["plan_id_hios"]) for r in facts if r["rate_change_status"] == "quarantined"] == [("or-1", "P2")]
    versions = {(r["filing_id"], r["document_role"], r["content_version_seq"]): r for r in m.document_versions.collect()}
    assert len(versions) == 4
    new = versions["or-1", "urrt", 2]
    assert (new["validator_moved"], new["bytes_moved"], new["fields_moved"], new["prior_sharepoint_version"], new["sharepoint_version"]) == (True, True, True, 3, 4)
    filings = {r["filing_id"]: r for r in m.dim_filing.collect()}
    assert [(filings[f]["content_version_count"], filings[f]["last_content_change_at"], filings[f]["last_substantive_change_at"]) for f in ("or-1", "pa-1")] == [(2, i2, i2), (1, None, None)]
    assert {r["run_id"] for r in m.quarantine_current.collect()} == {v1}
    assert failing(m.checks({"serff": ["or-1", "pa-1"], "federal": ["pa-1"]})) == {}
    assert {(r["filing_id"], r["document_role"]): r["currency"] for r in m.document_currency.collect()} == {("or-1", "urrt"): "current", ("or-1", "letter"): "never_extracted", ("pa-1", "urrt"): "current"}
    assert m.extractor_drift.select("pair_kind", "reading").collect() == [("live-dry", "unequal_hashes")]
    w = landing.Warehouse(spark, str(tmp_path / "warehouse"))
    first = w.publish(m.marts())
    assert first == w.publish(m.marts()) and first["fct_plan_rate"] == 5 and w.read("fct_plan_rate").count() == 5


def test_empty_root_has_every_table(spark, tmp_path):
    raw = landing.read_all(spark, str(tmp_path))
    assert set(raw) == set(TABLES) and all(df.count() == 0 for df in raw.values())
    assert Models(raw).fct_plan_rate.count() == 0


def test_bad_json_names_its_place(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw/ingest_manifest.jsonl").write_text('{"a": 1}\n{oops\n')
    with pytest.raises(Exception, match=r"ingest_manifest.jsonl:2 is no JSON"):
        landing.read_all(spark, str(tmp_path))["ingest_manifest"].collect()


def test_an_object_is_no_array(spark, tmp_path):
    folder = tmp_path / "extracted/or/f/R1"
    folder.mkdir(parents=True)
    (folder / "plans.json").write_text("{}")
    with pytest.raises(Exception, match="is no array"):
        landing.read_all(spark, str(tmp_path))["plan_extracts"].collect()


def test_changed_documents_only(spark, tmp_path):
    for n, data in (("a", b"1"), ("b", b"2")):
        (tmp_path / n).write_bytes(data)
    docs = landing.read_documents(spark, str(tmp_path))
    known = docs.select("path", "content_hash").where("path like '%a'")
    assert [r["path"][-1] for r in landing.new_documents(docs, known).collect()] == ["b"]


def test_line_numbers_survive_splits(spark, tmp_path):
    lines = ["" if i % 7 == 3 else json.dumps({"n": i + 1, "pad": "x" * (i % 50)}) for i in range(3001)]
    (tmp_path / "big.jsonl").write_text("\n".join(lines))
    (tmp_path / "small.jsonl").write_text("\n".join(lines[:10]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = landing.read_jsonl(spark, str(tmp_path), "*.jsonl").selectExpr("source_file", "source_line", "variant_get(payload, '$.n', 'int') as n")
        rows = df.collect()
        assert df.rdd.getNumPartitions() >= 1 and landing.numbered_lines(spark, f"{tmp_path}/big.jsonl").select("value").count() == 3001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == sum(bool(x) for x in lines) + sum(bool(x) for x in lines[:10])
    assert all(r["source_line"] == r["n"] for r in rows) and {r["source_file"] for r in rows} == {"big.jsonl", "small.jsonl"}


def test_a_validation_run(spark, tree):
    from ledgerline.operators import quality
    from ledgerline.plans import validate as V

    root, (_, a, b, v1) = tree
    raw = landing.read_all(spark, str(root))
    raw["field_misses"] = landing.from_rows(spark, [{"run_id": b, "filing_id": "or-1", "document_role": "urrt", "field_name": "loss_ratio", "reason": "unparseable"}])
    m = Models(raw)
    rules = quality.load_rules(
        [
            {"id": "RULE", "check": "range", "params": {"field": "cumulative_rate_change_pct", "min": "0.06", "max": "1"}},
            {"id": "STATE", "check": "id_segment_matches", "params": {"field": "filing_id", "segment": [0, 2]}},
            {"id": "COUNT", "check": "count_equals", "grain": "filing", "params": {"field": "plan_count_stated", "count_field": "n_plans"}},
            {"id": "MISS", "check": "adopted_only", "grain": "filing"},
        ]
    )
    run = "20260901T000000Z"
    v = V.validate(m, rules, run, {"unparseable": "MISS"})
    rows = {(r["rule_id"], r["filing_id"], r["subject_key"], r["reprocess_status"]) for r in v.quarantine.collect()}
    assert rows == {("RULE", "or-1", "P2", "open"), ("RULE", "or-1", "P3", "open"), ("RULE", "pa-1", "P1", "open"), ("RULE", "pa-1", "P2", "open"), ("MISS", "or-1", "urrt.loss_ratio", "open")}
    results = {r["rule_id"]: r for r in v.results.collect()}
    assert [results["RULE"][c] for c in ("evaluated", "passed", "violated")] == [5, 1, 4] and results["COUNT"]["not_evaluated"] == 2 and results["MISS"]["adopted"] == 1
    assert failing(v.gate) == {} and v.exit_code() == 1
    strict = quality.load_rules([{"id": "RULE", "check": "range", "params": {"field": "cumulative_rate_change_pct", "min": "0", "max": "1"}}, {"id": "MISS", "check": "adopted_only"}])
    calm = V.validate(m, strict, run, {"unparseable": "MISS"})
    assert [(r["subject_key"], r["reprocess_status"]) for r in calm.quarantine.where("rule_id = 'RULE'").collect()] == [("P2", "resolved")]
    assert failing(calm.gate) == {}
    one = V.validate(m, rules, run, {"unparseable": "MISS"}, ["pa-1"])
    assert {r["filing_id"] for r in one.quarantine.collect()} == {"pa-1"} and {r["scope"] for r in one.results.collect()} == {"filing"}
    with pytest.raises(quality.RuleError):
        V.validate(m, rules, run, {"other": "MISS"})
    assert {r["document_role"] for r in V.sources_disagree({"plan": ["urrt", "ghost"]}, m.manifest).collect()} == {"ghost", "letter"}
