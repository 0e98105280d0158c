"""More of the catalogue: the joins and windows of the warehouse, documents and their anchors, findings and their gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import typing as Y
from ..operators import conform, extraction, history, quality, reports, select
from ..sources import discovery
from . import validate as V
from .catalogue import _BY_ORDER, _LINE_KEYS, QUERIES, SQL, query

__all__ = ["QUERIES", "SQL"]

# --- joins and windows -------------------------------------------------------------------------------------------


@query("""WITH v AS (SELECT DISTINCT user_id, event_type FROM events),
x AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value < 10, ts DESC, event_id DESC) AS rn FROM events WHERE value > 5)
SELECT v.user_id, v.event_type, x.event_id AS extraction, x.value < 10 AS dry_run FROM v LEFT JOIN x ON v.user_id = x.user_id AND v.event_type = x.event_type AND x.rn = 1""")
def version_extractions(t):
    """Each content version with its latest extraction, live ones first."""
    order = [(F.col("value") < 10).asc(), F.col("ts").desc(), F.col("event_id").desc()]
    latest = select.first_row(t.events.where("value > 5"), ["user_id", "event_type"], order)
    versions = t.events.select("user_id", "event_type").distinct()
    return versions.join(latest.select("user_id", "event_type", F.col("event_id").alias("extraction"), (F.col("value") < 10).alias("dry_run")), ["user_id", "event_type"], "left")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1")
def latest_posted(t):
    return select.newest_row(t.orders.where("o_orderstatus <> 'P'"), ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query("""SELECT n_nationkey, n_name, r_name, coalesce(f.flag, false) AS has_debt, coalesce(v.n, 0) AS n_suppliers, v.best FROM nation JOIN region ON n_regionkey = r_regionkey
LEFT JOIN (SELECT c_nationkey, bool_or(c_acctbal < -950) AS flag FROM customer GROUP BY 1) f ON f.c_nationkey = n_nationkey LEFT JOIN (SELECT s_nationkey, count(*) AS n, max(s_name) AS best FROM supplier WHERE s_nationkey <> 3 GROUP BY 1) v ON v.s_nationkey = n_nationkey""")
def dimension_with_flags(t):
    """An inner join and two left ones, each of the latter with an aggregate of its own."""
    flags = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.bool_or(F.col("c_acctbal") < -950).alias("flag"))
    versions = t.supplier.where("s_nationkey <> 3").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"), F.max("s_name").alias("best"))
    out = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).join(flags, "n_nationkey", "left").join(versions, "n_nationkey", "left")
    return out.select("n_nationkey", "n_name", "r_name", F.coalesce("flag", F.lit(False)).alias("has_debt"), F.coalesce("n", F.lit(0)).alias("n_suppliers"), "best")


@query("""SELECT p_partkey, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS flags, coalesce(bool_or(l_returnflag = 'R'), false) AS is_disputed FROM part LEFT JOIN (SELECT * FROM lineitem WHERE l_discount >= 0.09 AND l_quantity > 40) ON l_partkey = p_partkey GROUP BY 1""")
def disputed_fields(t):
    found = t.lineitem.where("l_discount >= 0.09 and l_quantity > 40").select(F.col("l_partkey").alias("p_partkey"), F.col("l_returnflag").alias("rule_id"))
    p = t.part.join(conform.marks(found, ["p_partkey"], "flags"), "p_partkey", "left")
    return p.select("p_partkey", F.array_join("flags", ",").alias("flags"), F.coalesce(F.array_contains("flags", "R"), F.lit(False)).alias("is_disputed"))


@query("""SELECT o_orderkey, calls FROM orders JOIN (SELECT l_orderkey, count(*) AS calls, count(*) FILTER (WHERE l_returnflag = 'N') AS dry FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
WHERE dry = calls AND o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def dry_current_runs(t):
    """Runs all of whose calls were dry although their filing has a live one."""
    calls = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("calls"), F.count_if(F.col("l_returnflag") == "N").alias("dry")).where("dry = calls")
    live = t.orders.where("o_orderstatus = 'F'").select("o_custkey").distinct()
    return t.orders.join(calls, "o_orderkey").join(live, "o_custkey", "left_semi").select("o_orderkey", "calls")


@query("""SELECT l_orderkey, count(*) AS evaluated FROM lineitem GROUP BY 1 HAVING count(*) <> count(*) FILTER (WHERE l_returnflag = 'A') + count(*) FILTER (WHERE l_returnflag = 'R') + count(*) FILTER (WHERE l_returnflag = 'N' AND l_linestatus = 'O')""")
def accounting_identity(t):
    of = lambda *c: F.count_if(F.expr(" and ".join(c)))
    sums = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("evaluated"), of("l_returnflag = 'A'").alias("a"), of("l_returnflag = 'R'").alias("r"), of("l_returnflag = 'N'", "l_linestatus = 'O'").alias("n"))
    return sums.where("evaluated <> a + r + n").select("l_orderkey", "evaluated")


@query("""SELECT c_custkey, min(o_orderdate) AS observed_at, s.s_suppkey AS matched FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT s_nationkey, s_suppkey % 7 AS k, min(s_suppkey) AS s_suppkey FROM supplier GROUP BY 1, 2) s
ON s.s_nationkey = c_nationkey AND s.k = c_custkey % 7 GROUP BY 1, 3""")
def crosswalk(t):
    seed = t.supplier.groupBy(F.col("s_nationkey").alias("c_nationkey"), (F.col("s_suppkey") % 7).alias("k")).agg(F.min("s_suppkey").alias("matched"))
    seen = t.orders.withColumnRenamed("o_custkey", "c_custkey").join(t.customer, "c_custkey").withColumn("k", F.col("c_custkey") % 7)
    return seen.groupBy("c_custkey", "c_nationkey", "k").agg(F.min("o_orderdate").alias("observed_at")).join(seed, ["c_nationkey", "k"], "left").select("c_custkey", "observed_at", "matched")


@query("""WITH l AS (SELECT *, lag(props) OVER w AS was, lag(event_id) OVER w AS prior, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id))
SELECT user_id, event_type, event_id, prior IS NOT NULL AND props IS DISTINCT FROM was AS relabeled FROM l WHERE rn = 1""")
def relabeled(t):
    """Documents whose label differs from that of the sighting before, whatever came of that one."""
    keys = ["user_id", "event_type"]
    w = history.ordered(keys, ["ts", "event_id"])
    before = F.lag(F.struct("props")).over(w)
    seen = t.events.withColumn("relabeled", F.coalesce(before.isNotNull() & history.moved(F.col("props"), before["props"]), F.lit(False)))
    return select.newest_row(seen, keys, "ts", "event_id").select(*keys, "event_id", "relabeled")


# --- payloads, identifiers, documents ----------------------------------------------------------------------------


@query("SELECT event_id, 'c' || event_id::VARCHAR AS call_id, event_type AS check_name, 'a,' || event_type AS parts, NULL::VARCHAR AS sub_trk_num, event_id * 2 AS doubled FROM events")
def nested_paths(t):
    """A nested path, a renamed key, a list, a column that the source lacks, and all columns with a derived one."""
    made = F.to_json(F.struct(F.struct(F.struct(F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("call_id")).alias("f")).alias("provenance"), F.col("event_type").alias("check"), F.array(F.lit("a"), F.col("event_type")).alias("parts")))
    p = F.col("payload")
    e = t.events.select("event_id", F.parse_json(made).alias("payload"))
    rows = e.select("event_id", Y.text_at(p, "provenance.f.call_id").alias("call_id"), Y.text_at(p, "check").alias("check_name"), F.array_join(Y.text_at(p, "parts", "array<string>"), ",").alias("parts"), F.lit(None).cast("string").alias("sub_trk_num"))
    return rows.select("*", (F.col("event_id") * 2).alias("doubled"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey::INT END AS version, ((o_orderkey % 300) * CASE WHEN o_orderkey % 2 = 0 THEN 0.0001 WHEN o_orderkey % 300 > 100 THEN 0.0001 ELSE 0.01 END)::DOUBLE AS rate, CASE o_orderkey % 4 WHEN 0 THEN 'Silver' WHEN 1 THEN 'Gold' END AS metal, CASE WHEN o_orderkey % 3 = 1 THEN o_orderkey % 50 END AS answer FROM orders")
def source_readings(t):
    """Versions in tags, rates as percentages or fractions, words of a vocabulary, JSON in fences."""
    n = F.col("o_orderkey")
    tag = F.when(n % 3 > 0, F.concat(F.lit('"{6F2B-A},'), n.cast("string"), F.lit('"'))).otherwise(F.lit('"plain"'))
    cents = (n % 300 / 100).cast("decimal(6,2)").cast("string")
    rate = F.when(n % 2 == 0, F.concat(cents, F.lit(" %"))).otherwise(cents)
    metal = F.element_at(F.array(F.lit(" silver"), F.lit("GOLD "), F.lit("tin"), F.lit("")), (n % 4 + 1).cast("int"))
    said = F.when(n % 3 == 1, F.concat(F.lit('Here:\n```json\n{"a": '), (n % 50).cast("string"), F.lit("}\n```"))).when(n % 3 == 2, F.lit("no json")).otherwise(F.lit('{"b": 1}'))
    answer = F.variant_get(T.json_in_fence(said), "$.a", "long")
    return t.orders.select("o_orderkey", T.version_in_etag(tag).alias("version"), F.round(T.fraction_in(rate).cast("double"), 9).alias("rate"), T.in_vocabulary(metal, ["Silver", "Gold", "Bronze"]).alias("metal"), answer.alias("answer"))


@query("""WITH s AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN lpad(s_suppkey::VARCHAR, 5, '0') || 'WA0010001' WHEN 1 THEN NULL ELSE lpad(s_suppkey::VARCHAR, 5, '0') || 'OR0010001' END AS plan, CASE WHEN s_suppkey % 3 > 0 THEN lpad(s_suppkey::VARCHAR, 5, '0') || CASE WHEN s_suppkey % 3 = 1 THEN 'OR001' ELSE 'PA' END ELSE '' END AS product FROM supplier)
SELECT s_suppkey, (plan IS NULL OR NOT regexp_full_match(plan, '\\d{5}(OR|PA)\\d{7}'))::INT + (product <> '' AND NOT coalesce(starts_with(plan, product), false))::INT AS problems FROM s""".replace("\\\\", "\\"))
def plan_id_shape(t):
    n = F.col("s_suppkey")
    issuer = F.lpad(n.cast("string"), 5, "0")
    plan = F.when(n % 4 == 0, F.concat(issuer, F.lit("WA0010001"))).when(n % 4 > 1, F.concat(issuer, F.lit("OR0010001")))
    product = F.when(n % 3 > 0, F.concat(issuer, F.when(n % 3 == 1, "OR001").otherwise("PA"))).otherwise("")
    rows = t.supplier.select("s_suppkey", plan.alias("plan_id_hios"), product.alias("product_id"))
    return rows.select("s_suppkey", F.size(extraction.problems_of_plan_id()).alias("problems"))


@query("""WITH h AS (SELECT page_id, regexp_extract_all(html, '(?i)HREF="(/[^"]*)"', 1) AS v FROM pages) SELECT page_id, unnest(v) AS value, (generate_subscripts(v, 1) - 1)::INT AS place FROM h""")
def labelled_values(t):
    """Every match of a labelled pattern, in document order and without regard to case."""
    return t.pages.select("page_id", F.explode(T.labelled_hits(F.col("html"), 'HREF="(/[^"]*)"')).alias("h")).select("page_id", "h.value", "h.place")


_PAGES = "p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS page FROM documents)"
_TOPICS = {"one": ["the [a-z]+"], "three": ["license", "lizenz"], "two": ["die", "que"]}


@query(f"""WITH {_PAGES}, m AS (SELECT *, regexp_matches(line, '(?i)the [a-z]+') AS n1, regexp_matches(line, '(?i)license|lizenz') AS n3, regexp_matches(line, '(?i)die|que') AS n2 FROM p),
k AS (SELECT *, length(trim(line)) <= 110 AND NOT regexp_matches(line, '[.;,]\\s*$') AS short, n1::INT + n2::INT + n3::INT >= 3 AS contents FROM m),
f AS (SELECT doc_id, max(page) AS last,
  coalesce(min(page) FILTER (WHERE NOT contents AND short AND regexp_matches(line, '(?i)^(.{{0,10}}|[ \\t•·–—-]*[\\d.()a-zA-Z]{{0,16}}[:.]?[ \\t•·–—-]*)(the [a-z]+)')), min(page) FILTER (WHERE NOT contents AND n1)) AS one,
  coalesce(min(page) FILTER (WHERE NOT contents AND short AND regexp_matches(line, '(?i)^(.{{0,10}}|[ \\t•·–—-]*[\\d.()a-zA-Z]{{0,16}}[:.]?[ \\t•·–—-]*)(license|lizenz)')), min(page) FILTER (WHERE NOT contents AND n3)) AS three,
  coalesce(min(page) FILTER (WHERE NOT contents AND short AND regexp_matches(line, '(?i)^(.{{0,10}}|[ \\t•·–—-]*[\\d.()a-zA-Z]{{0,16}}[:.]?[ \\t•·–—-]*)(die|que)')), min(page) FILTER (WHERE NOT contents AND n2)) AS two FROM k GROUP BY 1),
u AS (SELECT doc_id, last, unnest(['one', 'three', 'two']) AS section, unnest([one, three, two]) AS page_start FROM f)
SELECT doc_id, section, page_start::INT AS page_start, CASE WHEN page_start IS NOT NULL THEN greatest(page_start, coalesce(lead(page_start) OVER (PARTITION BY doc_id ORDER BY page_start NULLS LAST, section) - 1, least(page_start + 3, last))) END::INT AS page_end FROM u""")
def located_sections(t):
    """Lines as pages: sections start at a heading, or else where they are mentioned, and end before the next one."""
    pages = t.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("page", "line"))
    return T.located_sections(pages, ["doc_id"], "page", "line", _TOPICS, contents_from=3).drop("heading")


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT doc_id, count(*) AS headings FROM l
WHERE length(line) <= 110 AND regexp_matches(line, '^\s{0,10}\p{Lu}') AND NOT regexp_matches(line, '[.;,]\s*$') AND trim(line) <> '' GROUP BY 1""")
def heading_lines(t):
    return T.lines_table(t.documents, "text", "doc_id").where(T.is_heading(F.col("line"))).groupBy("doc_id").agg(F.count("*").alias("headings"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1)::INT AS n FROM documents)
SELECT doc_id, line AS heading, n AS start_line, least(coalesce(lead(n) OVER (PARTITION BY doc_id ORDER BY n), n + 4), n + 4) AS end_line FROM l WHERE length(line) <= 80 AND regexp_matches(line, '^[A-Z]')""")
def clamped_windows(t):
    lines = T.lines_table(t.documents, "text", "doc_id")
    return T.sections(lines, ["doc_id"], (F.char_length("line") <= 80) & F.col("line").rlike("^[A-Z]"), 4)


@query(r"""WITH l AS (SELECT regexp_extract_all(html, 'href="(/[^"]+)"', 1) AS v FROM pages), u AS (SELECT unnest(v) AS url, generate_subscripts(v, 1) - 1 AS n FROM l)
SELECT url, min(regexp_replace(lower(regexp_replace(regexp_replace(regexp_replace(url, '\?.*$', ''), '^.*/', ''), '\.[A-Za-z0-9]+$', '')), 's$', '')) AS slug FROM u GROUP BY 1""")
def discovered_documents(t):
    return discovery.linked(t.pages, "html", "/", "s$").drop("place")


@query(r"""WITH h AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS u, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS l FROM pages),
r AS (SELECT page_id, unnest(u) AS u, trim(unnest(l)) AS label, (generate_subscripts(u, 1) - 1)::INT AS place FROM h),
k AS (SELECT page_id, place, label, 'https://x' || u AS url, CASE WHEN lower(label) = 'the' THEN 'article' WHEN lower(label) LIKE '%the%' THEN 'article' ELSE 'other' END AS role FROM r)
SELECT page_id, place, label, url, CASE WHEN row_number() OVER (PARTITION BY page_id, role ORDER BY place) > 1 THEN role || '-' || row_number() OVER (PARTITION BY page_id, role ORDER BY place) ELSE role END AS document_role FROM k""")
def listed_documents(t):
    return discovery.listed(t.pages, "page_id", "html", {"the": "article"}, "https://x")


# --- findings ----------------------------------------------------------------------------------------------------


@query("""SELECT event_id, 'R_' || r AS rule_id, CASE WHEN event_id % 6 = 0 THEN CASE r WHEN 'A' THEN 'violation' ELSE 'inapplicable' END WHEN value BETWEEN 5 AND 50 THEN 'pass' ELSE 'violation' END AS verdict FROM events, (SELECT unnest(['A', 'B']) AS r)""")
def cell_error_gate(t):
    """An unusable source value is judged before the rule sees it, as the rule says."""
    e = t.events.withColumns({"v": F.col("value"), "v_is_cell_error": F.col("event_id") % 6 == 0})
    rules = quality.load_rules([{"id": f"R_{n}", "check": "range", "on_cell_error": on, "params": {"field": "v", "min": 5, "max": 50}} for n, on in (("A", "violation"), ("B", "not_applicable"))], ["v"])
    return quality.evaluate(e, rules, ["event_id"]).select("event_id", "rule_id", "verdict")


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'cell' WHEN 1 THEN 'anchor' END AS extraction_method, CASE event_id % 4 WHEN 0 THEN 'A1' END AS source_locator,
CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'the provenance names no place' WHEN 2 THEN 'the field has no provenance' ELSE 'the rule is about no single field' END AS provenance_absent_reason FROM events""")
def finding_provenance(t):
    n = F.col("event_id") % 4
    entry = lambda method, place: F.struct(F.lit(method).alias("method"), F.lit("urrt").alias("source_document_role"), F.lit(place).cast("string").alias("source_locator"))
    held = F.when(n == 0, F.create_map(F.lit("x"), entry("cell", "A1"))).when(n == 1, F.create_map(F.lit("x"), entry("anchor", None))).otherwise(F.create_map(F.lit("y"), entry("cell", "B2")))
    rows = t.events.select("event_id", F.when(n < 3, F.lit("x")).alias("field_name"), held.alias("provenance"))
    return quality.with_provenance(rows).select("event_id", "extraction_method", "source_locator", "provenance_absent_reason")


@query("""SELECT 'every finding names a known rule' AS problem, count(*) AS n FROM lineitem WHERE l_tax = 0.08 UNION ALL SELECT 'one result per configured rule', 1 UNION ALL SELECT 'every miss is adopted', 1
UNION ALL SELECT 'provenance or a reason', count(*) FROM lineitem WHERE l_discount > 0.08 UNION ALL SELECT 'nothing vanishes silently', 1""")
def findings_gate(t):
    """The gate over a run in which each of five assertions is broken."""
    rules = quality.load_rules([{"id": "R", "check": "range", "params": {"field": "l_discount", "min": 0, "max": 0.08}}, {"id": "S", "check": "adopted_only"}])
    named = lambda rows, rule, place: rows.select(F.lit(rule).alias("rule_id"), F.col("l_orderkey").cast("string").alias("filing_id"), F.concat_ws("/", *_LINE_KEYS).alias("subject_key"), F.lit("l_discount").alias("field_name"), F.lit("evaluated").alias("origin"), F.lit("open").alias("reprocess_status"), F.lit("error").alias("severity"), F.lit(place).cast("string").alias("source_locator"), F.lit(None).cast("string").alias("provenance_absent_reason"))
    found = named(t.lineitem.where("l_discount > 0.08"), "R", None).unionByName(named(t.lineitem.where("l_tax = 0.08"), "UNKNOWN", "A1"))
    counted = quality.with_totals(quality.tally(t.lineitem, rules, _BY_ORDER), rules, resolved=found.limit(0)).where("rule_id = 'R'")
    gone = found.limit(1).withColumn("filing_id", F.lit("none"))
    gate = quality.gate(found, counted, rules, 1, gone)
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("problem"), "n") for name, df in gate.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("n > 0")


@query("SELECT 'click' AS document_role, 'seen, not declared' AS problem UNION ALL SELECT 'ghost', 'declared, never seen'")
def sources_and_manifest(t):
    seen = t.events.where(F.col("event_type").isin("click", "view", "purchase")).select(F.col("event_type").alias("document_role"))
    return V.sources_disagree({"plan": ["view", "ghost"], "filing": ["purchase"]}, seen)


@query("""WITH v AS (SELECT l_returnflag || l_linestatus AS rule_id, count(*) AS evaluated, count(*) FILTER (WHERE l_discount > 0.05) AS violated, count(*) FILTER (WHERE l_tax = 0) AS adopted FROM lineitem GROUP BY 1)
SELECT row_number() OVER (ORDER BY violated + adopted DESC, rule_id)::INT AS position, * FROM v""")
def findings_report(t):
    """A row a rule, most findings first."""
    counts = t.lineitem.groupBy(F.concat("l_returnflag", "l_linestatus").alias("rule_id")).agg(F.count("*").alias("evaluated"), F.count_if(F.col("l_discount") > 0.05).alias("violated"), F.count_if(F.col("l_tax") == 0).alias("adopted"))
    return reports.numbered(counts, (F.col("violated") + F.col("adopted")).desc(), F.asc("rule_id"))


@query("""WITH v AS (SELECT event_type, user_id % 10 AS grp, count(*) AS n FROM events GROUP BY 1, 2) SELECT row_number() OVER (ORDER BY grp, n DESC, event_type)::INT AS position, * FROM v""")
def ordered_report(t):
    """The final order of a report by several keys."""
    counts = t.events.groupBy("event_type", (F.col("user_id") % 10).alias("grp")).agg(F.count("*").alias("n"))
    return reports.numbered(counts, F.asc("grp"), F.desc("n"), F.asc("event_type"))
