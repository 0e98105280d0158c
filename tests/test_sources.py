"""Workbooks, PDFs, HTTP, configuration, model calls, guarded extraction and the command lines."""

from __future__ import annotations

import datetime as dt
import io
import json
import threading
import zipfile
import zlib
from decimal import Decimal
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from ledgerline import cli
from ledgerline.operators import extraction, model_calls, reports
from ledgerline.sources import config, http, landing, pdf, workbook


def xlsx(sheets, strings=True):
    """A workbook of sheets: name -> {ref: value}; numbers, texts (shared or inline), booleans and errors."""
    shared, parts = [], {}
    for n, (_, cells) in enumerate(sheets.items(), 1):
        rows = {}
        for ref, v in cells.items():
            rows.setdefault(int("".join(c for c in ref if c.isdigit())), []).append((ref, v))
        body = ""
        for r, items in sorted(rows.items()):
            body += f'<row r="{r}">'
            for ref, v in items:
                if isinstance(v, bool):
                    body += f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
                elif isinstance(v, int | float):
                    body += f'<c r="{ref}"><v>{v}</v></c>'
                elif v.startswith("#"):
                    body += f'<c r="{ref}" t="e"><v>{v}</v></c>'
                elif strings:
                    shared.append(v)
                    body += f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>'
                else:
                    body += f'<c r="{ref}" t="inlineStr"><is><r><t>{v[:2]}</t></r><r><t>{v[2:]}</t></r></is></c>'
            body += "</row>"
        parts[f"xl/worksheets/sheet{n}.xml"] = f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>'
    names = "".join(f'<sheet name="{s}" sheetId="{n}" r:id="rId{n}"/>' for n, s in enumerate(sheets, 1))
    parts["xl/workbook.xml"] = f'<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{names}</sheets></workbook>'
    parts["xl/_rels/workbook.xml.rels"] = "<Relationships>" + "".join(f'<Relationship Id="rId{n}" Target="worksheets/sheet{n}.xml"/>' for n in range(1, len(sheets) + 1)) + "</Relationships>"
    parts["xl/sharedStrings.xml"] = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">' + "".join(f"<si><t>{s}</t></si>" for s in shared) + "</sst>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


PLANS = {"B1": "Product", "C3": "Company Legal Name:", "D3": "Acme", "C4": "Effective Date", "D4": 46388, "B10": "1.4", "C10": "Plan ID", "E10": "12345OR0010001", "F10": "12345OR0010002", "H10": "  ", "B11": "1.6", "E11": "Silver", "F11": "Gold", "B12": "1.10", "E12": "#VALUE!", "F12": 0.125, "B13": "1.6", "E13": "not this", "D10": "a label", "B14": "2.1", "E14": "1,234.5"}


@pytest.mark.parametrize("strings", [True, False])
def test_workbooks_are_cells_and_columns_become_rows(spark, strings):
    files = [("a", xlsx({"Sheet 1": {"A1": "x"}, "Plans": PLANS}, strings)), ("b", b"PK no archive"), ("c", xlsx({"Other": {"A1": True}})), ("d", None), ("e", b"")]
    cells = workbook.scan(spark.createDataFrame(files, "path string, content binary"), ["path"], sheets=["Plans"])
    errors = {r["path"]: r["error"] for r in cells.where("error is not null").collect()}
    assert set(errors) == {"b", "c", "e"} and "BadZipFile" in errors["b"] and "Plans" in errors["c"]
    fields = {"1.4": "plan_id", "1.6": "metal", "1.10": "change", "2.1": "members", "9.9": "absent"}
    got = workbook.records(cells, ["path"], "Plans", fields, "1.4").orderBy("column").collect()
    assert [(r["column"], r["plan_id"], r["metal"], r["change_is_cell_error"], r["change_number"], r["members_number"], r["change_ref"]) for r in got] == [
        (5, "12345OR0010001", "Silver", True, None, Decimal("1234.5"), "Plans!E12"),
        (6, "12345OR0010002", "Gold", False, Decimal("0.125"), None, "Plans!F12"),
    ]
    assert [(r["path"], r["name"]) for r in workbook.missing_fields(cells, ["path"], "Plans", fields).collect()] == [("a", "absent")]
    (head,) = workbook.labelled_values(cells, ["path"], "Plans", {"company legal name": "company", "effective date": "effective", "none": "nothing"}).collect()
    assert (head["company"], head["effective"], head["nothing"]) == ("Acme", "46388", None)
    days = spark.createDataFrame([("46388",), ("1/2/2027",)], "v string").select(workbook.serial_or_date(F.col("v"))).collect()
    assert [r[0] for r in days] == [dt.date(2027, 1, 1), dt.date(2027, 1, 2)]


def test_workbooks_that_mean_harm_are_errors(spark):
    bomb = io.BytesIO()
    with zipfile.ZipFile(bomb, "w") as z:
        z.writestr("xl/_rels/workbook.xml.rels", '<!DOCTYPE x [<!ENTITY a "b">]><Relationships/>')
        z.writestr("xl/workbook.xml", "<workbook/>")
    (row,) = workbook.scan(spark.createDataFrame([(1, bomb.getvalue())], "id int, content binary"), ["id"]).collect()
    assert "declares entities" in row["error"]


def pdf_of(pages, packed=True, fonts=b"<< /F1 << /Type /Font /Subtype /Type1 >> >>", extra=()):
    """A PDF of pages, each the operators of its content."""
    objects = {1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Count %d /Resources << /Font %s >> /Kids [%s] >>" % (len(pages), fonts, b" ".join(b"%d 0 R" % (10 + 2 * i) for i in range(len(pages))))}
    for i, content in enumerate(pages):
        raw = zlib.compress(content) if packed else content
        objects[10 + 2 * i] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (11 + 2 * i)
        objects[11 + 2 * i] = b"<< /Length %d%s >>\nstream\n%s\nendstream" % (len(raw), b" /Filter /FlateDecode" if packed else b"", raw)
    for n, body in extra:
        objects[n] = body
    return b"%PDF-1.4\n" + b"\n".join(b"%d 0 obj\n%s\nendobj" % x for x in objects.items()) + b"\ntrailer << /Root 1 0 R >>\n%%EOF"


PAGE = rb"BT /F1 12 Tf 72 700 Td (Total rate: 4.5%) Tj 0 -14 Td [(Plan) -300 (12345OR0010001) -20 (x)] TJ T* (back\\slash \(kept\) \351) Tj 1 0 0 1 72 600 Tm (A) Tj 1 0 0 1 200 600 Tm (B) Tj ET"


@pytest.mark.parametrize("packed", [True, False])
def test_pdfs_are_pages(spark, packed):
    cmap = b"1 beginbfchar <0001> <0048> endbfchar 1 beginbfrange <0002> <0003> <0069> endbfrange"
    wide = b"<< /F1 << /Type /Font /Subtype /Type0 /ToUnicode 5 0 R >> >>"
    files = [
        ("a", pdf_of([PAGE, b"BT /F1 9 Tf (second) Tj ET", b""], packed)),
        ("b", pdf_of([b"BT /F1 9 Tf <000100020003> Tj ET"], packed, wide, [(5, b"<< /Length %d >>\nstream\n%s\nendstream" % (len(cmap), cmap))])),
        ("c", b"%PDF-1.4 nothing"),
        ("d", b"no such thing"),
        ("e", None),
        ("f", pdf_of([b"BT (x) Tj ET"], False) + b"%" + b"0" * 60_000),
        ("g", pdf_of([PAGE]).replace(b"trailer <<", b"trailer << /Encrypt 9 0 R")),
    ]
    rows = pdf.scan(spark.createDataFrame(files, "path string, content binary"), ["path"]).collect()
    text = {(r["path"], r["page"]): r["text"] for r in rows if r["error"] is None}
    assert text == {("a", 0): "Total rate: 4.5%\nPlan 12345OR0010001x\nback\\slash (kept) é\nA B", ("a", 1): "second", ("a", 2): "", ("b", 0): "Hij"}
    assert {r["path"] for r in rows if r["error"]} == {"c", "d", "f", "g"}


def test_broken_pdfs_are_rows(spark):
    good = pdf_of([PAGE, PAGE])
    files = [(n, good[:n]) for n in range(0, len(good), 23)] + [(10_000 + n, good[:n] + b"\xff<<[(" + good[n + 5 :]) for n in range(0, len(good), 29)]
    rows = pdf.scan(spark.createDataFrame(files, "n int, content binary"), ["n"]).collect()
    assert {r["n"] for r in rows if r["error"] is None or r["error"]} <= {n for n, _ in files}


def test_tables_of_pages(spark):
    text = "Plan ID   Change   Members\n12345OR0010001 Silver  4.5%  10\n12345OR0010002  Gold 5%\nsee 12345OR0010001 again"
    pages = spark.createDataFrame([("f", 0, text), ("f", 1, "12345OR0010009 alone"), ("f", 2, None)], "path string, page int, text string")
    cells = {(r["line"], r["column"]): r["value"] for r in pdf.table_lines(pages, ["path"]).where("page = 0").collect()}
    assert [cells[1, c] for c in (1, 2, 3)] == ["Plan ID", "Change", "Members"] and cells[2, 2] == "4.5%"
    ids = {r["id"]: (r["page"], r["tail"]) for r in pdf.id_lines(pages, ["path"], r"\d{5}OR\d{7}").collect()}
    assert ids == {"12345OR0010001": (0, "Silver  4.5%  10"), "12345OR0010002": (0, "Gold 5%")}


class Host(BaseHTTPRequestHandler):
    tries: dict = {}

    def do_GET(self):  # noqa: N802
        n = Host.tries[self.path] = Host.tries.get(self.path, 0) + 1
        if self.path == "/robots.txt":
            code, body = 200, b"User-agent: *\nDisallow: /private"
        elif self.path == "/later":
            code, body = (200, b"at last") if n == 3 else (503, b"")
        elif self.path == "/same":
            code, body = (304, b"") if self.headers.get("If-None-Match") == '"1"' else (200, b"bytes")
        else:
            code, body = {"/gone": (404, b""), "/denied": (403, b""), "/data": (200, b'{"a": 1}'), "/broken": (500, b"")}.get(self.path, (200, b"page"))
        self.send_response(code)
        self.send_header("ETag", '"1"')
        self.send_header("Content-Type", "text/plain")
        self.end_headers()
        if code != 304:
            self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture
def host():
    Host.tries = {}
    server = HTTPServer(("127.0.0.1", 0), Host)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_a_polite_client(host):
    waits = []
    client = http.Client(http.Policy("ledgerline-tests (a@b.example)", interval=0.5, backoff=2.0), sleep=waits.append, clock=lambda: 0.0)
    assert client.fetch(f"{host}/page").content == b"page" and waits == [0.5]
    assert client.fetch(f"{host}/later").attempts == 3 and [w for w in waits if w != 0.5] == [2.0, 4.0]
    same = client.fetch(f"{host}/same", etag='"1"')
    assert same.status == 304 and same.content is None
    assert client.json(f"{host}/data") == {"a": 1}
    for path, error in (("/private/x", http.Refused), ("/denied", http.Refused), ("/gone", http.NotFetched), ("/broken", http.NotFetched)):
        with pytest.raises(error):
            client.fetch(host + path)
    assert (Host.tries["/denied"], Host.tries["/gone"], Host.tries["/broken"], Host.tries["/robots.txt"]) == (1, 1, 3, 1) and "/private/x" not in Host.tries
    with pytest.raises(http.NotFetched):
        client.json(f"{host}/page")
    with pytest.raises(ValueError, match="browser"):
        http.Policy("Mozilla/5.0")
    with pytest.raises(ValueError, match="http"):
        client.fetch("file:///etc/passwd")


def test_sightings_are_rows(host):
    client = http.Client(http.Policy("ledgerline-tests (a@b.example)", interval=0, backoff=0), sleep=lambda s: None)
    wanted = [{"url": f"{host}/same", "filing_id": "f"}, {"url": f"{host}/same", "filing_id": "f", "etag": '"1"', "content_hash": "sha256:x"}, {"url": f"{host}/gone", "filing_id": "g"}, {"url": f"{host}/denied", "filing_id": "h"}, {"url": f"{host}/page", "filing_id": "i"}]
    rows = http.sightings(client, wanted, "20270101T000000Z")
    assert [(r["http_status"], r["unchanged"], r["content"]) for r in rows[:2]] == [(200, False, b"bytes"), (304, True, None)] and rows[1]["content_hash"] == "sha256:x"
    assert [bool(r["error"]) for r in rows] == [False, False, True, True, True] and rows[2]["http_status"] == 404 and "/page" not in Host.tries


SOURCES = {"defaults": {"plan_year": 2027, "market": "individual", "min_request_interval_seconds": 2, "max_attempts": 3, "backoff_base_seconds": 2, "timeout_seconds": 60, "user_agent_template": "ledgerline ({contact})"}, "sources": {"OR": {"adapter": "list", "api_base": "x"}, "PA": {"adapter": "index", "plan_year": 2028}}}
TARGETS = {"model": {"id": "m", "input_price_per_mtok": "5.00", "output_price_per_mtok": "25.00"}, "limits": {"max_window_tokens": 100, "max_window_pages": 4}, "anchors": {"OR": {"letter": {"company": ["name: (.*)"]}, "empty": None}}, "sections": {"OR": {"letter": {"trend": ["trend"]}}}, "plan_tables": {"PA": {"packet": {"anchors": ["plans"]}}}, "skip_roles": {"other": "not read"}}


def test_configuration_is_typed_or_refused(tmp_path):
    got = config.load_sources(SOURCES, "me@b.example")
    assert got.policy.user_agent == "ledgerline (me@b.example)" and got.policy.interval == 2.0 and [(s.state, s.plan_year, dict(s.options)) for s in got.chosen()] == [("OR", 2027, {"api_base": "x"}), ("PA", 2028, {})]
    assert [s.state for s in got.chosen(["pa"])] == ["PA"]
    with pytest.raises(config.ConfigError, match="WA"):
        got.chosen(["WA"])
    for path, value in ((("sources",), {}), (("defaults", "max_attempts"), None), (("defaults", "timeout_seconds"), "soon"), (("sources", "OR", "adapter"), ""), (("defaults", "user_agent_template"), "Mozilla")):
        broken = json.loads(json.dumps(SOURCES))
        at = broken
        for k in path[:-1]:
            at = at[k]
        at[path[-1]] = value or None
        with pytest.raises(config.ConfigError):
            config.load_sources(broken)
    t = config.load_targets(TARGETS)
    assert t.of("anchors", "OR", "letter") == {"company": ["name: (.*)"]} and t.of("anchors", "OR", "empty") == {} and t.model.price_in == Decimal("5.00") and t.of("plan_tables", "PA", "packet") == {"anchors": ["plans"], "min_plan_ids_per_page": 2}
    for kind, patterns in (("anchors", ["no group"]), ("anchors", []), ("sections", ["(open"])):
        with pytest.raises(config.ConfigError):
            config.load_targets(TARGETS | {kind: {"OR": {"letter": {"x": patterns}}}})
    with pytest.raises(config.ConfigError, match="limits"):
        config.load_targets({k: v for k, v in TARGETS.items() if k != "limits"})
    (tmp_path / "rules.json").write_text(json.dumps({"rules": [{"id": "R", "check": "range", "field": "x", "min": 0, "max": 1}], "adopted_reasons": {"lost": "R"}}))
    rules = config.load_rule_set(tmp_path / "rules.json")
    assert rules.rules[0].params == {"field": "x", "min": 0, "max": 1} and rules.reasons == {"lost": "R"}
    for bad in ({"rules": []}, {"rules": [{"id": "R", "check": "no such"}]}, {"rules": [{"id": "R", "check": "present", "field": "x"}], "adopted_reasons": {"a": "Z"}}):
        with pytest.raises(config.ConfigError):
            config.load_rule_set(bad)
    (tmp_path / "bad.yml").write_text("a: [")
    for name in ("bad.yml", "absent.yml"):
        with pytest.raises(config.ConfigError):
            config.read_mapping(tmp_path / name)


def test_each_call_is_a_row(spark):
    model = config.load_targets(TARGETS).model

    def ask(request):
        said = request["user"].split("\n\n")[1]
        if said == "boom":
            raise TimeoutError("too late")
        text, stop = {"cut": ("{", "max_tokens"), "no": ("", "refusal"), "prose": ("hello", "end_turn")}.get(said, ('Here:\n```json\n{"b": 1, "a": 2}\n```', "end_turn"))
        return {"text": text, "stop_reason": stop, "input_tokens": 1000, "output_tokens": 100, "cache_read_input_tokens": 2000}

    df = spark.createDataFrame([(i, "trend", "find", t) for i, t in enumerate(["fine", "boom", "cut", "no", "prose", "long " * 200, None])], "id int, section string, instructions string, text string")
    rows = {r["id"]: r for r in model_calls.calls(df, ["id"], model_calls.Caller(model, 100, ask, run_id="R")).collect()}
    assert (rows[0]["data"], rows[0]["cost_usd"], rows[0]["error"]) == ('{"a": 2, "b": 1}', "0.008500", None)
    assert [bool(rows[i]["error"]) for i in range(7)] == [False, True, True, True, True, True, False] and rows[5]["error"].startswith("window_exceeds_token_ceiling") and rows[5]["input_tokens"] is None
    assert all(rows[i]["data"] is None for i in range(1, 6)) and rows[2]["cost_usd"] == "0.008500" and len({r["call_id"] for r in rows.values()}) == 7
    dry = model_calls.calls(df, ["id"], model_calls.Caller(model, 10_000)).collect()
    assert {r["stop_reason"] for r in dry} == {"dry_run"} and {r["cost_usd"] for r in dry} == {"0"}
    (total,) = extraction.cost_by(spark.createDataFrame([(r["target_section"], r["cost_usd"], r["error"]) for r in rows.values()], "target_section string, cost_usd string, error string")).collect()
    assert (total["calls"], total["failed"], float(total["cost"]), float(total["mean_cost"])) == (7, 5, 0.0425, 0.0061)


def test_a_crash_is_a_row(spark):
    def read(doc):
        if doc["content"] == b"bad":
            raise KeyError("no such field")
        return [{"v": 1, "n": doc["name"]}, {"v": 2, "n": None}]

    docs = spark.createDataFrame([("a", "letter", b"ok", None), ("b", "letter", b"bad", None), ("c", "other", b"ok", None), ("d", "letter", None, "no stored path")], "name string, document_role string, content binary, problem string")
    out = extraction.extracted(docs, ["name"], read, skip={"other": "not read"})
    rows = {r["name"]: r for r in out.collect()}
    assert {n: (r["status"], r["error_class"], len(r["rows"])) for n, r in rows.items()} == {"a": ("extracted", None, 2), "b": ("failed", "builtins.KeyError", 0), "c": ("skipped", None, 0), "d": ("failed", "Unresolved", 0)}
    assert sorted(tuple(r) for r in extraction.rows_of(out, ["name"], "v int, n string").collect()) == [("a", 1, "a"), ("a", 2, None)]


def test_invariants_of_rows(spark):
    plans = spark.createDataFrame([("12345OR0010001", "12345OR001"), ("12345OR0010001", None), ("12345OR0010001", "12345OR002"), ("12345WA0010001", None), (None, None), ("x12345OR0010001", "")], "plan_id_hios string, product_id string")
    assert [len(r[0]) for r in plans.select(extraction.problems_of_plan_id()).collect()] == [0, 0, 1, 1, 1, 1]
    schema = "driver_category string, driver_label string, narrative string, quantified_impact_pct string, evidence_quote string, source_page_start int, source_page_end int, confidence double"
    good = ("trend", "Trend", "costs rise", "0.04", "a 4% increase", 1, 2, 0.9)
    change = lambda **kw: tuple(kw.get(n.split()[0], v) for n, v in zip(schema.split(", "), good, strict=True))
    rows = [good, change(quantified_impact_pct=None), change(quantified_impact_pct="0.05"), change(source_page_end=0), change(source_page_start=3), change(confidence=1.5), change(narrative=" "), change(evidence_quote=None), change(source_page_start=None, source_page_end=None, confidence=None)]
    got = [len(r[0]) for r in spark.createDataFrame(rows, schema).select(extraction.problems_of_narrative()).collect()]
    assert got == [0, 0, 1, 2, 1, 1, 1, 2, 0]


def test_reports_are_ordered(spark):
    rows = [("B", "error", 5, 3, 1, 0, 1, 1, 0), ("A", "warn", 5, 3, 2, 0, 0, 0, 0), ("C", "error", 9, 0, 9, 0, 0, 0, 4)]
    df = spark.createDataFrame(rows, "rule_id string, severity string, evaluated int, passed int, violated int, inapplicable int, not_evaluated int, adopted int, resolved int")
    found = reports.by_findings(df).collect()
    assert [r["rule_id"] for r in found] == ["C", "A", "B"] and len(reports.lines(found)) == 5 and "Exchange" not in reports.lines(found)[0]
    assert [r["rule_id"] for r in reports.ordered(df, "-evaluated", "rule_id").collect()] == ["C", "A", "B"]


def tree(root, **tables):
    for t, rows in tables.items():
        if t in landing.LEDGERS:
            path = root / landing.LEDGERS[t]
            path.parent.mkdir(parents=True, exist_ok=True)
            path.write_text("".join(json.dumps(r) + "\n" for r in rows))
        else:
            for r in rows:
                path = root / "extracted" / r["state"] / r["filing_id"] / r["run_id"] / landing.EXTRACTS[t]
                path.parent.mkdir(parents=True, exist_ok=True)
                old = json.loads(path.read_text()) if path.exists() else []
                path.write_text(json.dumps([*old, r]))


def test_commands_load_and_validate(spark, tmp_path, monkeypatch, capsys):
    base = {"filing_id": "or-1", "state": "OR", "run_id": "20270101T000000Z", "plan_year": 2027}
    root = tmp_path / "data"
    tree(
        root,
        ingest_manifest=[base | {"manifest_schema_version": 2, "retrieved_at": "20270101T000000Z", "document_role": "urrt", "content_hash": "h", "error": None, "carrier_label_raw": "Acme"}],
        extraction_outcomes=[base | {"document_role": "urrt", "content_hash": "h", "status": "partial", "ledger_version": 2, "dry_run": False, "normalized_field_hash": None}],
        filing_extracts=[base | {"provenance": {"hios_issuer_id": {"method": "deterministic_cell", "source_document_role": "urrt", "source_locator": "A1"}}, "hios_issuer_id": "12345", "rate_change_min": "0.01", "rate_change_max": "0.09", "company_legal_name": "Acme"}],
        plan_extracts=[base | {"plan_id_hios": "12345OR001000" + n, "cumulative_rate_change_pct": v, "provenance": {}} for n, v in (("1", "0.05"), ("2", "0.5"), ("3", None))],
        field_misses=[base | {"document_role": "urrt", "model_name": "PlanRate", "field_name": "cumulative_rate_change_pct", "reason": "outside", "detail": "12345OR0010003: parsed 0.2 falls outside"}],
    )
    rules = {"rules": [{"id": "RANGE", "check": "range", "field": "cumulative_rate_change_pct", "min": 0, "max": 0.1, "on_cell_error": "violation"}, {"id": "ADOPTED", "check": "adopted_only"}], "adopted_reasons": {"outside": "ADOPTED"}}
    assert cli.validate(spark, rules, str(root)) == 1
    shown = capsys.readouterr().out
    assert shown.index("ADOPTED") < shown.index("RANGE") and "scope corpus" in shown
    assert cli.validate(spark, rules, str(root), reprocess="extracted") == 1  # a new run beside the first
    m = cli.Models(landing.read_all(spark, str(root)))
    assert m.results.select("run_id").distinct().count() == 2 and m.quarantine.count() == 4
    # a plan finding that was adopted marks its plan: missing becomes quarantined
    status = {r["plan_id_hios"][-1]: r["rate_change_status"] for r in m.fct_plan_rate.collect()}
    assert status == {"1": "carrier_range_validated", "2": "quarantined", "3": "quarantined"}
    assert {(r["grain"], r["subject_key"], r["source_document_role"]) for r in m.quarantine.where("rule_id = 'ADOPTED'").collect()} == {("plan", "12345OR0010003", "urrt")}
    assert cli.validate(spark, rules, str(root), filing="pa-9") == 1
    assert cli.validate(spark, {"rules": []}, str(root)) == 1 and cli.validate(spark, rules, str(tmp_path / "absent")) == 1
    assert cli.validate(spark, rules | {"adopted_reasons": {}}, str(root)) == 3
    asked = []
    assert cli.validate(spark, rules, str(root), "raw", extract=lambda f: asked.append(f) or 3) == 3 and asked == [None]
    assert cli.validate(spark, rules | {"sources": {"plan": ["ghost"]}}, str(root)) == 1
    monkeypatch.setattr(cli, "session", lambda: spark)
    for _ in range(2):
        assert cli.main(["load", "--data-root", str(root), "--warehouse", f"file://{tmp_path}/wh", "--keep", "0"]) == 0
    store = landing.Warehouse(spark, f"file://{tmp_path}/wh")
    assert store.read("fct_plan_rate").count() == 3 and len([p for p in (tmp_path / "wh").iterdir() if p.is_dir()]) == 1
    (root / landing.LEDGERS["ingest_manifest"]).write_text("not json\n")
    assert cli.main(["load", "--data-root", str(root), "--warehouse", f"file://{tmp_path}/wh"]) == 1 and store.read("fct_plan_rate").count() == 3
    assert cli.main(["load", "--data-root", str(tmp_path / "none"), "--warehouse", f"file://{tmp_path}/wh"]) == 1


def test_discovery_is_whole_or_refused(spark, tmp_path):
    from ledgerline.sources import discovery

    page = '<a href="/docs/Acme-Rate-Summary.pdf">x</a><a href="/other/y">y</a><a href="/docs/beta.pdf?v=2">z</a><a href="/docs/Acme-Rate-Summary.pdf">x</a>'
    pages = spark.createDataFrame([(page,), (None,)], "html string")
    assert [(r["slug"], r["place"]) for r in discovery.linked(pages, "html", "/docs/", "-rate-summary$", 2).orderBy("place").collect()] == [("acme", 0), ("beta", 1)]
    with pytest.raises(discovery.Unexpected, match="3 documents"):
        discovery.linked(pages, "html", "/docs/", "-rate-summary$", 3)
    items = spark.createDataFrame([("Acme", '<p><A class="x" href="/a.pdf"><b>Rate&nbsp;Request</b></A> <a href="http://x/b.pdf">rate request</a><a href="/c">Letter</a></p>'), ("Beta", None)], "carrier string, links string")
    got = discovery.listed(items, "carrier", "links", {"rate request": "rate_request"}, "http://base", 2).orderBy("place").collect()
    assert [(r["document_role"], r["url"]) for r in got] == [("rate_request", "http://base/a.pdf"), ("rate_request-2", "http://x/b.pdf"), ("other", "http://base/c")]
    with pytest.raises(discovery.Unexpected):
        discovery.listed(items, "carrier", "links", {}, "", 4)
    path = str(tmp_path / "store")
    docs = lambda *rows: spark.createDataFrame([(h, h.encode() if h else None) for h in rows], "content_hash string, content binary")
    assert sorted(r[0] for r in discovery.store(docs("a", "b", "a", None), path, "R1").collect()) == ["a", "b"]
    assert [r[0] for r in discovery.store(docs("a", "c"), path, "R2").collect()] == ["c"] and discovery.store(docs("a"), path, "R3").count() == 0
    import shutil

    shutil.rmtree(tmp_path / "store" / "run_id=R1")  # lost bytes are stored again
    assert [r[0] for r in discovery.store(docs("a", "c"), path, "R4").collect()] == ["a"]


def test_models_are_views(spark):
    from ledgerline.plans.warehouse import Models

    m = Models({t: landing.from_rows(spark, [], f"{t}.jsonl") for t in (*landing.LEDGERS, *landing.EXTRACTS)})
    names = m.register("v_")
    assert {"manifest", "document_versions", "conformed"} <= set(names) and not set(names) & set(m.MARTS)
    assert spark.sql("select count(*) from v_document_versions").first()[0] == 0
