"""Every query of the warehouse operators on the driver's tables, with the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..functions import typing as Y
from ..operators import checks, conform, extraction, fingerprint, history, quality, select, shape

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self._spark, self._dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable:
    """Registers a function of the tables under its name."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        QUERIES[f.__name__].__doc__ = f.__doc__
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the priority label that was valid for their customer when they shipped, and a trust status."""
    return trusted_facts(Tables(spark, sf_dir))


# --- history -----------------------------------------------------------------------------------------------------

_EPISODES = """p AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR prev <> event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS episode_seq FROM p),
e AS (SELECT user_id, episode_seq, min(event_type) AS event_type, min(ts) AS first_seen_at, max(ts) AS last_seen_at, count(*) AS sighting_count,
        arg_min(value, (ts, event_id)) AS value, arg_min(props, (ts, event_id)) AS props FROM s GROUP BY user_id, episode_seq)"""


def _episodes(t: Tables) -> DataFrame:
    return history.episodes(t.events, ["user_id"], ["ts", "event_id"], "event_type", ["value", "props"])


@query(f"WITH {_EPISODES} SELECT user_id, episode_seq, event_type, first_seen_at, last_seen_at, sighting_count FROM e")
def episodes(t):
    return _episodes(t).drop("value", "props")


@query(f"WITH {_EPISODES} SELECT user_id, episode_seq, value, props FROM e")
def version_first_sight(t):
    return _episodes(t).select("user_id", "episode_seq", "value", "props")


@query(f"""WITH {_EPISODES}, l AS (SELECT *, lag(event_type) OVER w AS pt, lag(value) OVER w AS pv, max(episode_seq) OVER (PARTITION BY user_id) AS top FROM e WINDOW w AS (PARTITION BY user_id ORDER BY episode_seq))
SELECT user_id, episode_seq, episode_seq = top AS is_current, CASE WHEN episode_seq > 1 THEN event_type IS DISTINCT FROM pt END AS type_moved,
       CASE WHEN episode_seq > 1 THEN value <> pv END AS value_moved FROM l""")
def change_signals(t):
    e = history.with_previous(_episodes(t), ["user_id"], "episode_seq", ["event_type", "value"])
    later = F.col("episode_seq") > 1
    return e.select(
        "user_id",
        "episode_seq",
        (F.col("episode_seq") == F.max("episode_seq").over(Window.partitionBy("user_id"))).alias("is_current"),
        F.when(later, history.moved(F.col("event_type"), F.col("prior_event_type"))).alias("type_moved"),
        F.when(later, history.moved_if_known(F.col("value"), F.col("prior_value"))).alias("value_moved"),
    )


@query(f"""WITH {_EPISODES}, l AS (SELECT *, lag(event_type) OVER w AS pt, lag(value) OVER w AS pv FROM e WINDOW w AS (PARTITION BY user_id ORDER BY episode_seq)),
m AS (SELECT user_id, event_type <> pt AS validator, CASE WHEN value < 5 OR pv < 5 THEN NULL ELSE value > pv END AS fields FROM l WHERE episode_seq > 1)
SELECT CASE WHEN validator AND fields THEN 'validator_moved/fields_moved' WHEN validator AND fields = false THEN 'validator_moved/fields_same' WHEN validator AND fields IS NULL THEN 'validator_moved/fields_unknown'
            WHEN NOT validator AND fields THEN 'validator_same/fields_moved' WHEN NOT validator AND fields = false THEN 'validator_same/fields_same' ELSE 'validator_same/fields_unknown' END AS reading, count(*) AS n FROM m GROUP BY 1""")
def transition_readings(t):
    e = history.with_previous(_episodes(t), ["user_id"], "episode_seq", ["event_type", "value"]).where("episode_seq > 1")
    known = F.when(~((F.col("value") < 5) | (F.col("prior_value") < 5)), F.col("value") > F.col("prior_value"))
    reading = history.transition_reading(F.col("event_type") != F.col("prior_event_type"), known)
    return e.select(reading.alias("reading")).groupBy("reading").agg(F.count("*").alias("n"))


_SCD2 = """o1 AS (SELECT o_custkey, o_orderdate, min(o_orderpriority) AS label FROM orders GROUP BY 1, 2),
o2 AS (SELECT *, lag(label) OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS prior FROM o1),
o3 AS (SELECT * FROM o2 WHERE prior IS NULL OR prior <> label),
scd AS (SELECT o_custkey, label, row_number() OVER w AS version_seq, o_orderdate AS valid_from, lead(o_orderdate) OVER w AS valid_to FROM o3 WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate))"""


def _labels(t: Tables) -> DataFrame:
    daily = t.orders.groupBy("o_custkey", "o_orderdate").agg(F.min("o_orderpriority").alias("label"))
    return history.type2(daily, "o_custkey", "o_orderdate", "o_orderdate", "label")


@query(f"WITH {_SCD2} SELECT o_custkey, label, version_seq, valid_from, valid_to, valid_to IS NULL AS is_current FROM scd")
def scd2_history(t):
    return _labels(t).withColumn("version_seq", F.col("version_seq").cast("long")).drop("first_observed_at")


_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity"


@query(f"""WITH {_SCD2} SELECT {_LINE}, o.o_custkey, s.label, s.version_seq FROM lineitem JOIN orders o ON l_orderkey = o_orderkey
LEFT JOIN scd s ON s.o_custkey = o.o_custkey AND l_shipdate >= s.valid_from AND (s.valid_to IS NULL OR l_shipdate < s.valid_to)""")
def pit_join(t):
    return _dated(t, False)


def _dated(t: Tables, sort: bool) -> DataFrame:
    facts = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(*_LINE.split(", "), "o_custkey")
    versions = _labels(t).withColumn("version_seq", F.col("version_seq").cast("long"))
    return history.point_in_time(facts, versions, "o_custkey", "l_shipdate", ["label", "version_seq"], sort=sort)


_STATUS = """CASE WHEN l_discount >= 0.09 THEN 'quarantined' WHEN l_quantity = 13 THEN 'cell_error' WHEN l_tax IS NULL THEN 'missing' WHEN l_returnflag = 'R' AND l_tax = 0 THEN 'structural_zero'
WHEN l_linestatus = 'F' THEN 'carrier_range_validated' WHEN l_returnflag = 'A' THEN 'single_source_deterministic' ELSE 'unvalidated_parse' END"""


def _status():
    return conform.trust_status(
        F.col("l_discount") >= 0.09,
        F.col("l_quantity") == 13,
        F.col("l_tax"),
        (F.col("l_returnflag") == "R") & (F.col("l_tax") == 0),
        (F.col("l_linestatus") == "F", "carrier_range_validated"),
        (F.col("l_returnflag") == "A", "single_source_deterministic"),
    )


@query(f"""WITH s AS (SELECT *, {_STATUS} AS status FROM lineitem)
SELECT status, count(*) AS n, count(CASE WHEN status NOT IN ('quarantined', 'cell_error', 'missing') THEN l_tax END) AS n_vetted,
       round(sum(CASE WHEN status NOT IN ('quarantined', 'cell_error', 'missing') THEN CAST(l_tax - l_discount AS DECIMAL(18, 4)) END), 2)::DOUBLE AS vetted_gap FROM s GROUP BY status""")
def trust_status(t):
    s = t.lineitem.withColumn("status", _status())
    gap = Y.difference_if_vetted(F.col("l_tax"), F.col("l_discount"), F.col("status"), untrusted=conform.UNTRUSTED).cast("decimal(18,4)")
    return s.groupBy("status").agg(F.count("*").alias("n"), F.count(conform.vetted(F.col("l_tax"), F.col("status"))).alias("n_vetted"), F.round(F.sum(gap), 2).cast("double").alias("vetted_gap"))


@query(f"""WITH {_SCD2}, f AS (SELECT lineitem.*, o.o_custkey, s.label FROM lineitem JOIN orders o ON l_orderkey = o_orderkey
LEFT JOIN scd s ON s.o_custkey = o.o_custkey AND l_shipdate >= s.valid_from AND (s.valid_to IS NULL OR l_shipdate < s.valid_to))
SELECT md5(concat_ws('-', l_orderkey::VARCHAR, l_linenumber::VARCHAR)) AS fact_key, o_custkey, label, {_STATUS} AS status,
       CASE WHEN {_STATUS} NOT IN ('quarantined', 'cell_error', 'missing') THEN l_tax END AS vetted_tax FROM f""")
def trusted_facts(t):
    facts = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    f = history.point_in_time(facts, _labels(t), "o_custkey", "l_shipdate", ["label"]).withColumn("status", _status())
    return f.select(Y.surrogate_key("l_orderkey", "l_linenumber").alias("fact_key"), "o_custkey", "label", "status", conform.vetted(F.col("l_tax"), F.col("status")).alias("vetted_tax"))


# --- selection ---------------------------------------------------------------------------------------------------


@query("SELECT user_id, coalesce(max(event_id) FILTER (WHERE event_type <> 'error'), max(event_id)) AS event_id FROM events GROUP BY user_id")
def latest_live(t):
    return select.latest_live(t.events, ["user_id"], "event_id", F.col("event_type") == "error")


@query("""WITH c AS (SELECT user_id, coalesce(max(event_id) FILTER (WHERE event_type <> 'error'), max(event_id)) AS event_id FROM events GROUP BY user_id)
SELECT e.* FROM events e SEMI JOIN c USING (user_id, event_id)""")
def current_rows(t):
    return select.rows_of_current_run(t.events, latest_live(t), ["user_id", "event_id"])


@query("SELECT max(event_id) AS event_id FROM events WHERE NOT (value > 20) OR event_type = 'purchase'")
def latest_complete(t):
    runs = t.events.select("event_id", (F.col("value") > 20).alias("has_scope"), F.when(F.col("event_type") == "purchase", "corpus").otherwise("filing").alias("scope"))
    return select.latest_complete(runs, "event_id")


@query("SELECT user_id, event_type, event_id, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, coalesce(event_type, '') ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM events) WHERE rn = 1")
def last_status(t):
    return select.last_status(t.events, ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id", "ts", "value")


@query("""SELECT user_id, event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_value,
last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS known_value FROM events""")
def last_known(t):
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    return t.events.select("user_id", "event_id", select.last_known(bought, ["user_id"], ["ts", "event_id"], before=True).alias("prior_value"), select.last_known(bought, ["user_id"], ["ts", "event_id"]).alias("known_value"))


@query("""SELECT o_custkey, coalesce(max(o_totalprice) FILTER (WHERE o_orderstatus = 'F'), max(o_totalprice)) AS o_totalprice, coalesce(max(o_orderpriority) FILTER (WHERE o_orderstatus <> 'F'), max(o_orderpriority)) AS o_orderpriority,
min(o_orderdate) AS o_orderdate, count(*) AS source_row_count FROM orders GROUP BY o_custkey""")
def conformed_precedence(t):
    return conform.conform(t.orders, ["o_custkey"], "o_orderstatus", {"o_totalprice": ("F", True), "o_orderpriority": ("F", False)}, {"o_orderdate": F.min})


# --- change detection --------------------------------------------------------------------------------------------

_CHECKS = """k AS (SELECT *, event_type AS hash FROM events),
c AS (SELECT *, last_value(CASE WHEN event_type <> 'error' THEN hash END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior FROM k)"""


def _checks(t: Tables) -> DataFrame:
    e = t.events.withColumn("hash", F.col("event_type"))
    return history.sightings_with_prior(e, ["user_id"], ["ts", "event_id"], F.col("event_type") != "error", ["hash"]).withColumn(
        "change_class",
        history.change_class(F.when(F.col("event_type") == "error", F.lit("x")), F.col("prior_ok_hash"), F.col("value") < 5, F.col("hash") == F.col("prior_ok_hash")),
    )


_CLASS = "CASE WHEN event_type = 'error' THEN 'failed' WHEN prior IS NULL THEN 'first_sight' WHEN value < 5 THEN 'unchanged_by_validator' WHEN hash = prior THEN 'unchanged_by_bytes' ELSE 'changed' END"


@query(f"WITH {_CHECKS} SELECT user_id, event_id, {_CLASS} AS change_class FROM c")
def classify_change(t):
    return _checks(t).select("user_id", "event_id", "change_class")


@query(f"WITH {_CHECKS}, n AS (SELECT {_CLASS} AS change_class, count(*) AS n FROM c GROUP BY 1) SELECT a.change_class, coalesce(n.n, 0) AS n FROM (SELECT unnest(['failed', 'first_sight', 'unchanged_by_validator', 'unchanged_by_bytes', 'changed']) AS change_class) a LEFT JOIN n USING (change_class)")
def change_histogram(t):
    return history.histogram(_checks(t).select("change_class"), "change_class", history.CHANGE_CLASSES)


@query("""SELECT user_id % 10 AS grp, event_type, count(*) AS n, count(*) FILTER (WHERE value > 10) AS n_high, count(props) AS n_props FROM events GROUP BY 1, 2""")
def recheck_matrix(t):
    return t.events.groupBy((F.col("user_id") % 10).alias("grp"), "event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 10).alias("n_high"), F.count("props").alias("n_props"))


_CURRENCY = """known AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS h, o_orderkey % 4 = 0 AS failed FROM orders),
got AS (SELECT l_orderkey, max(CASE WHEN l_orderkey % 7 > 0 THEN l_linestatus END) AS g FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1),
cur AS (SELECT o_orderkey, o_custkey, CASE WHEN h IS NULL THEN 'unknown' WHEN l_orderkey IS NULL THEN 'never_extracted' WHEN g IS NULL OR g <> h THEN 'stale' WHEN failed THEN 'unknown' ELSE 'current' END AS currency
        FROM known LEFT JOIN got ON o_orderkey = l_orderkey)"""


def _currency(t: Tables) -> DataFrame:
    known = t.orders.select("o_orderkey", "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("h"))
    got = t.lineitem.where("l_returnflag <> 'N'").groupBy("l_orderkey").agg(F.max(F.when(F.col("l_orderkey") % 7 > 0, F.col("l_linestatus"))).alias("g"))
    joined = known.join(got, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select("o_orderkey", "o_custkey", history.currency(F.col("h"), F.col("g"), F.col("l_orderkey").isNotNull(), F.col("o_orderkey") % 4 == 0).alias("currency"))


@query(f"WITH {_CURRENCY} SELECT * FROM cur")
def currency(t):
    return _currency(t)


@query(f"WITH {_CURRENCY} SELECT DISTINCT o_custkey FROM cur WHERE currency = 'stale'")
def stale_lift(t):
    """Stale documents lifted to the grain above."""
    return _currency(t).where("currency = 'stale'").select("o_custkey").distinct()


@query("""WITH r AS (SELECT md5(text) AS h, doc_id AS run, lang, source, doc_id % 3 = 0 AS dry FROM documents)
SELECT a.h, a.run AS run_a, b.run AS run_b, CASE WHEN a.dry OR b.dry THEN 'live-dry' ELSE 'live-live' END AS pair_kind,
       CASE WHEN a.lang IS DISTINCT FROM b.lang THEN 'hash_versions_differ' WHEN a.source = b.source THEN 'equal_hashes' ELSE 'unequal_hashes' END AS reading
FROM r a JOIN r b ON a.h = b.h AND a.run < b.run WHERE NOT (a.dry AND b.dry)""")
def drift_pairs(t):
    runs = t.documents.select(F.md5("text").alias("h"), F.col("doc_id").alias("run"), "lang", "source", (F.col("doc_id") % 3 == 0).alias("dry"))
    pairs = history.drift_pairs(runs, ["h"], "run", "dry", ["lang", "source"])
    reading = history.drift_reading(F.col("source_a"), F.col("source_b"), F.col("lang_a"), F.col("lang_b"))
    return pairs.select("h", "run_a", "run_b", "pair_kind", reading.alias("reading"))


@query("""WITH r AS (SELECT md5(text) AS h, doc_id AS run, lang, source, doc_id % 3 = 0 AS dry FROM documents), s AS (SELECT h, run AS run_b, lag(run) OVER w AS run_a, lang, lag(lang) OVER w AS la, source, lag(source) OVER w AS sa, dry, lag(dry) OVER w AS da FROM r WINDOW w AS (PARTITION BY h ORDER BY run))
SELECT h, run_a, run_b, CASE WHEN da OR dry THEN 'live-dry' ELSE 'live-live' END AS pair_kind, CASE WHEN la IS DISTINCT FROM lang THEN 'hash_versions_differ' WHEN sa = source THEN 'equal_hashes' ELSE 'unequal_hashes' END AS reading
FROM s WHERE run_a IS NOT NULL AND NOT (da AND dry)""")
def drift_steps(t):
    runs = t.documents.select(F.md5("text").alias("h"), F.col("doc_id").alias("run"), "lang", "source", (F.col("doc_id") % 3 == 0).alias("dry"))
    steps = history.drift_steps(runs, ["h"], "run", "dry", ["lang", "source"])
    reading = history.drift_reading(F.col("source_a"), F.col("source_b"), F.col("lang_a"), F.col("lang_b"))
    return steps.select("h", "run_a", "run_b", "pair_kind", reading.alias("reading"))


@query(f"""WITH {_SCD2} SELECT {_LINE}, o.o_custkey, s.label, s.version_seq FROM lineitem JOIN orders o ON l_orderkey = o_orderkey
LEFT JOIN scd s ON s.o_custkey = o.o_custkey AND l_shipdate >= s.valid_from AND (s.valid_to IS NULL OR l_shipdate < s.valid_to)""")
def pit_join_sorted(t):
    """The same rows as pit_join by one sort of facts and versions."""
    return _dated(t, True)


@query("""SELECT d.doc_id, 'sha256:' || sha256('[{"text":"' || replace(replace(replace(replace(trim(regexp_replace(text, '\\s+', ' ', 'g')), '\\', '\\\\'), '"', '\\"'), chr(8), '\\b'), chr(12), '\\f') || '"}]') AS normalized_field_hash FROM documents d""")
def normalized_hash(t):
    d = t.documents.select("doc_id", "text")
    return fingerprint.normalized_hash(d, ["doc_id"], ["text"]).select("doc_id", "normalized_field_hash")


# --- joins, aggregates, shapes -----------------------------------------------------------------------------------

_FINDINGS = """f AS (SELECT l_orderkey, 'R_DISCOUNT' AS rule_id FROM lineitem WHERE l_discount >= 0.09 UNION ALL SELECT l_orderkey, 'R_QUANTITY' FROM lineitem WHERE l_quantity > 48
UNION ALL SELECT l_orderkey, 'R_TAX' FROM lineitem WHERE l_tax = 0.08)"""


def _findings(t: Tables) -> DataFrame:
    rules = F.array(F.when(F.col("l_discount") >= 0.09, "R_DISCOUNT"), F.when(F.col("l_quantity") > 48, "R_QUANTITY"), F.when(F.col("l_tax") == 0.08, "R_TAX"))
    return t.lineitem.select("l_orderkey", F.explode(F.array_compact(rules)).alias("rule_id"))


@query(f"""WITH {_FINDINGS}, m AS (SELECT l_orderkey, string_agg(DISTINCT rule_id, ',' ORDER BY rule_id) AS rules, bool_or(rule_id = 'R_TAX') AS has_tax FROM f GROUP BY 1)
SELECT o_orderkey, o_custkey, rules, coalesce(has_tax, false) AS has_tax FROM orders LEFT JOIN m ON o_orderkey = l_orderkey""")
def quarantine_marks(t):
    m = conform.marks(_findings(t), ["l_orderkey"], "ids", has_tax=F.bool_or(F.col("rule_id") == "R_TAX"))
    out = t.orders.join(m, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return out.select("o_orderkey", "o_custkey", F.array_join("ids", ",").alias("rules"), F.coalesce("has_tax", F.lit(False)).alias("has_tax"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, n_filled FROM (SELECT *, (CASE WHEN l_discount > 0 THEN 1 ELSE 0 END + CASE WHEN l_tax > 0 THEN 1 ELSE 0 END + 1)::INT AS n_filled, row_number() OVER (PARTITION BY l_orderkey ORDER BY (CASE WHEN l_discount > 0 THEN 1 ELSE 0 END + CASE WHEN l_tax > 0 THEN 1 ELSE 0 END) DESC, l_linenumber, l_partkey, l_suppkey, l_shipdate) AS rn FROM lineitem) WHERE rn = 1")
def richest_row(t):
    rows = t.lineitem.withColumns({"d": F.when(F.col("l_discount") > 0, F.col("l_discount")), "x": F.when(F.col("l_tax") > 0, F.col("l_tax"))})
    best = shape.richest_row(rows, ["l_orderkey"], ["d", "x", "l_quantity"], ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"])
    return best.select("l_orderkey", "l_linenumber", "l_partkey", "n_filled")


@query("SELECT l_partkey, l_suppkey FROM (SELECT l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_partkey ORDER BY count(*) DESC, count(DISTINCT l_orderkey) DESC, l_suppkey) AS rn FROM lineitem GROUP BY 1, 2) WHERE rn = 1")
def argmax_page(t):
    counts = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("d"))
    return shape.best_by(counts, ["l_partkey"], "l_suppkey", F.col("n"), F.col("d"))


@query("""SELECT c_mktsegment AS section, count(*) AS calls, count_if(o_orderstatus = 'P')::BIGINT AS failed, sum(CAST(o_totalprice AS DECIMAL(18, 2)))::DOUBLE AS revenue, round(sum(CAST(o_totalprice AS DECIMAL(18, 2))) / count(*), 4)::DOUBLE AS mean_cost
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def cost_by_section(t):
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    out = extraction.cost_by(joined.withColumnRenamed("c_mktsegment", "section"), "section", F.col("o_orderstatus") == "P", "o_totalprice")
    return out.select("section", "calls", "failed", F.col("cost").cast("double").alias("revenue"), F.col("mean_cost").cast("double"))


@query("SELECT l_orderkey, round(CAST((l_quantity * 3.0 + l_linenumber * 15.0) / 1000000.0 AS DOUBLE), 6) AS cost, l_linenumber, l_partkey, l_suppkey FROM lineitem")
def call_cost(t):
    zero = F.lit(0)
    cost = T.call_cost(F.col("l_quantity"), zero, zero, F.col("l_linenumber"), F.lit("3"), F.lit("15"))
    return t.lineitem.select("l_orderkey", cost.cast("double").alias("cost"), "l_linenumber", "l_partkey", "l_suppkey")


@query("""SELECT coalesce(a.l_partkey, b.ps) AS part, a.sold, b.returned FROM (SELECT l_partkey, count(*) AS sold FROM lineitem WHERE l_returnflag = 'N' AND l_quantity > 25 GROUP BY 1) a
FULL JOIN (SELECT l_partkey AS ps, count(*) AS returned FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 45 GROUP BY 1) b ON a.l_partkey = b.ps""")
def full_merge(t):
    part = t.lineitem.withColumnRenamed("l_partkey", "part")
    sold = part.where("l_returnflag = 'N' and l_quantity > 25").groupBy("part").agg(F.count("*").alias("sold"))
    returned = part.where("l_returnflag = 'R' and l_quantity > 45").groupBy("part").agg(F.count("*").alias("returned"))
    return shape.full_merge(sold, returned, "part")


@query("""SELECT c_custkey AS custkey, 'without orders' AS problem FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT DISTINCT o_custkey, 'unknown customer' FROM orders WHERE o_orderstatus = 'P' AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20)
EXCEPT ALL SELECT c_custkey, 'without orders' FROM customer WHERE c_nationkey >= 20 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def coverage_both_ways(t):
    expected = t.customer.where("c_nationkey < 20").select(F.col("c_custkey").alias("custkey"))
    seen = t.orders.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("custkey"))
    return shape.coverage_both_ways(expected, seen, ["custkey"], "without orders", "unknown customer")


_REGIONS = range(5)


@query(f"""SELECT field, {', '.join(f'max(CASE WHEN r_regionkey = {k} THEN v END) AS "{k}"' for k in _REGIONS)}
FROM (SELECT r_regionkey, unnest(['r_name', 'n_nations', 'first_nation', 'last_nation']) AS field, unnest([r_name, n_nations::VARCHAR, first_nation, last_nation]) AS v
FROM (SELECT r_regionkey, r_name, count(n_nationkey) AS n_nations, min(n_name) AS first_nation, max(n_name) AS last_nation FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY 1, 2)) GROUP BY field""")
def transpose(t):
    """Every region a column, every statistic of its nations a row."""
    nations = t.region.join(t.nation, F.col("n_regionkey") == F.col("r_regionkey"), "left").groupBy("r_regionkey", "r_name")
    rows = nations.agg(F.count("n_nationkey").alias("n_nations"), F.min("n_name").alias("first_nation"), F.max("n_name").alias("last_nation"))
    return shape.transpose(rows, "r_regionkey", ["r_name", "n_nations", "first_nation", "last_nation"], list(_REGIONS))


@query("SELECT l_orderkey, count(*) AS n, CASE WHEN count(DISTINCT l_returnflag) = 1 THEN min(l_returnflag) END AS only_flag, CASE WHEN count(DISTINCT l_suppkey) = 1 THEN min(l_suppkey) END AS only_supplier FROM lineitem GROUP BY 1")
def single_value_broadcast(t):
    return t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"), shape.single_value("l_returnflag").alias("only_flag"), shape.single_value("l_suppkey").alias("only_supplier"))


@query("SELECT conv_id, turn, CASE WHEN row_number() OVER w > 1 THEN role || '-' || row_number() OVER w ELSE role END AS role FROM conversations WINDOW w AS (PARTITION BY conv_id, role ORDER BY turn)")
def repeated_roles(t):
    return shape.numbered_repeats(t.conversations.select("conv_id", "turn", "role"), ["conv_id"], "role", ["turn"])


@query("SELECT a.l_orderkey, a.l_linenumber, a.l_suppkey AS label, b.l_suppkey AS neighbour FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_discount > 0.05) a LEFT JOIN (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey FROM lineitem) b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1")
def label_neighbours(t):
    dealt = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_discount").repartition("l_orderkey")  # one shuffle serves all groupings
    cells = dealt.groupBy("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("value")).agg(F.max(F.col("l_discount") > 0.05).alias("is_label"))
    return shape.label_neighbours(cells, ["l_orderkey"], "l_linenumber", "value", "is_label")


# --- typing ------------------------------------------------------------------------------------------------------

_PAYLOAD = "CASE WHEN event_id % 4 = 0 THEN '{\"a\": 1}' WHEN event_id % 4 = 1 THEN '{\"x\": \"' || (event_id % 97)::VARCHAR || '.50\"}' WHEN event_id % 4 = 2 THEN '{\"x\": null}' ELSE '{\"x\": {\"raw\": \"#VALUE!\"}}' END"


def _payloads(t: Tables) -> DataFrame:
    """Rows of every kind: without the key, with a value, with a null, with an error object."""
    k = F.col("event_id") % 4
    made = F.when(k == 0, F.lit('{"a": 1}')).when(k == 1, F.concat(F.lit('{"x": "'), (F.col("event_id") % 97).cast("string"), F.lit('.50"}'))).when(k == 2, F.lit('{"x": null}')).otherwise(F.lit('{"x": {"raw": "#VALUE!"}}'))
    return t.events.select("event_id", "props", F.parse_json(made).alias("payload"))


@query("SELECT event_id, (props->>'$.k')::BIGINT AS k, props->>'$.absent' AS absent FROM events")
def json_typing(t):
    e = t.events.select("event_id", F.parse_json("props").alias("p"))
    return e.select("event_id", Y.text_at(F.col("p"), "k", "bigint").alias("k"), Y.text_at(F.col("p"), "absent").alias("absent"))


@query(f"SELECT event_id, json_exists({_PAYLOAD}::JSON, '$.x') AS has_x, CASE WHEN event_id % 4 = 1 THEN (event_id % 97)::VARCHAR || '.50' END AS x FROM events")
def key_exists(t):
    e = _payloads(t)
    x = F.when(F.col("event_id") % 4 == 1, Y.text_at(F.col("payload"), "x"))
    return e.select("event_id", Y.has_key(F.col("payload"), "x").alias("has_x"), x.alias("x"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 1 THEN (event_id % 97) + 0.5 END::DOUBLE AS x, event_id % 4 = 3 AS x_is_cell_error FROM events")
def maybe_decimal(t):
    e = _payloads(t)
    value, flag = Y.maybe_decimal(F.col("payload"), "x")
    return e.select("event_id", value, flag).withColumn("x", F.col("x").cast("double"))


@query("SELECT event_id, ((event_id % 300) / 10.0 * 0.01)::DOUBLE AS fraction FROM events")
def percent_fraction(t):
    shown = F.concat((F.col("event_id") % 300 / 10).cast("decimal(6,1)").cast("string"), F.lit("%"))
    return t.events.select("event_id", F.round(Y.percent_fraction(shown).cast("double"), 9).alias("fraction"))


@query("SELECT o_orderkey, md5(concat_ws('-', o_orderkey::VARCHAR, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '_dbt_utils_surrogate_key_null_'))) AS order_key FROM orders")
def surrogate_key(t):
    return t.orders.select("o_orderkey", Y.surrogate_key("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))).alias("order_key"))


@query("SELECT l_orderkey, min(CASE WHEN l_returnflag <> 'N' THEN l_returnflag || l_linestatus END) AS least FROM lineitem GROUP BY 1")
def map_least(t):
    entry = F.struct(F.concat_ws("/", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus").alias("k"), F.struct(F.when(F.col("l_returnflag") != "N", F.concat("l_returnflag", "l_linestatus")).alias("role")).alias("v"))
    maps = t.lineitem.groupBy("l_orderkey").agg(F.map_from_entries(F.array_distinct(F.collect_list(entry))).alias("m"))
    return maps.select("l_orderkey", Y.least_in_map(F.col("m"), "role").alias("least"))


# --- text --------------------------------------------------------------------------------------------------------


@query(r"SELECT page_id, nullif(trim(regexp_extract(html, '(?i)<TITLE>([^<]+)</title>', 1)), '') AS title, nullif(regexp_extract(html, 'track\((\d+)\)', 1), '')::INT AS tracker FROM pages")
def anchor_extract(t):
    return t.pages.select("page_id", T.first_anchor(F.col("html"), ["<absent>(.)", "<TITLE>([^<]+)</title>", "<h1>([^<]+)</h1>"]).alias("title"), T.first_anchor(F.col("html"), [r"track\((\d+)\)"]).cast("int").alias("tracker"))


@query(r"""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM pages) SELECT DISTINCT page_id, link FROM l WHERE starts_with(link, '/')""")
def link_discovery(t):
    return t.pages.select("page_id", F.explode(T.links(F.col("html"), "/")).alias("link"))


_ROLES = {"economy": "low", "promo brushed": "sale", "promo": "offer", "standard anodized": "plain", "brushed steel": "metal", "steel": "metal"}


@query("""SELECT p_partkey, CASE WHEN n = 'economy' THEN 'low' WHEN n LIKE '%standard anodized%' THEN 'plain' WHEN n LIKE '%brushed steel%' OR n LIKE '%promo brushed%' THEN CASE WHEN n LIKE '%brushed steel%' THEN 'metal' ELSE 'sale' END
WHEN n LIKE '%economy%' THEN 'low' WHEN n LIKE '%promo%' THEN 'offer' WHEN n LIKE '%steel%' THEN 'metal' ELSE 'other' END AS role FROM (SELECT p_partkey, trim(regexp_replace(lower(p_type), '\\s+', ' ', 'g')) AS n FROM part)""")
def role_lookup(t):
    return t.part.select("p_partkey", T.role_of(F.col("p_type"), _ROLES).alias("role"))


@query(r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n FROM documents),
h AS (SELECT doc_id, line, n FROM l WHERE length(line) <= 60 AND regexp_matches(line, '^[A-Z]') AND length(line) > 1)
SELECT doc_id, line AS heading, n::INT AS start_line, lead(n) OVER (PARTITION BY doc_id ORDER BY n)::INT AS end_line FROM h""")
def section_windows(t):
    lines = T.lines_table(t.documents, "text", "doc_id")
    heading = (F.char_length("line") <= 60) & F.col("line").rlike("^[A-Z]") & (F.char_length("line") > 1)
    return T.sections(lines, ["doc_id"], heading)


@query(r"SELECT doc_id, count(*) AS n_lines, count_if(length(line) <= 60 AND regexp_matches(line, '^[A-Z]'))::BIGINT AS n_headings, count_if(length(line) <= 60 AND regexp_matches(line, '^[A-Z]')) >= 4 AS is_contents FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1")
def contents_pages(t):
    """Documents with four or more headings read like a table of contents."""
    heading = (F.char_length("line") <= 60) & F.col("line").rlike("^[A-Z]")
    return T.lines_table(t.documents, "text", "doc_id").groupBy("doc_id").agg(F.count("*").alias("n_lines"), F.count_if(heading).alias("n_headings"), (F.count_if(heading) >= 4).alias("is_contents"))


@query(r"SELECT doc_id, regexp_matches(text, '(^|[^0-9.])' || (doc_id % 10)::VARCHAR || '($|[^0-9.])') AS found, regexp_matches('a rise of ' || (doc_id % 5)::VARCHAR || CASE doc_id % 3 WHEN 0 THEN '.' WHEN 1 THEN '%.' ELSE '.0' END, '(^|[^0-9.])' || (doc_id % 7)::VARCHAR || '($|[^0-9.])') AS at_the_end FROM documents")
def number_in_text(t):
    """Numbers as tokens of their own: neither "4." at the end of a sentence nor "4.0" says 4, "4%." does."""
    n, k = F.col("doc_id"), F.col("doc_id") % 3
    end = F.concat(F.lit("a rise of "), (n % 5).cast("string"), F.when(k == 0, ".").when(k == 1, "%.").otherwise(".0"))
    return t.documents.select("doc_id", T.contains_number(F.col("text"), (n % 10).cast("string")).alias("found"), T.contains_number(end, (n % 7).cast("string")).alias("at_the_end"))


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN '(' || abs(c_acctbal)::DECIMAL(12, 2)::VARCHAR || ')' ELSE '$' || c_acctbal::DECIMAL(12, 2)::VARCHAR END AS shown, round(c_acctbal, 2) AS read_back FROM customer")
def number_from_text(t):
    d = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    shown = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("("), F.regexp_replace(d, "-", ""), F.lit(")"))).otherwise(F.concat(F.lit("$"), d))
    return t.customer.select("c_custkey", shown.alias("shown"), T.number_in(shown).cast("double").alias("read_back"))


@query("SELECT s_suppkey, trim(regexp_replace(lower(s_name), '[^a-z0-9]+', '-', 'g'), '-') AS slug, CASE WHEN length(s_suppkey::VARCHAR) >= 5 THEN s_suppkey::VARCHAR ELSE lpad(s_suppkey::VARCHAR, 5, '0') END AS padded, upper(substr(s_name, 3, 4)) AS segment FROM supplier")
def identifiers(t):
    return t.supplier.select("s_suppkey", T.slug(F.col("s_name")).alias("slug"), T.zero_padded(F.col("s_suppkey").cast("string"), 5).alias("padded"), T.segment(F.col("s_name"), 2, 4).alias("segment"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d1, CAST(o_orderdate AS DATE) AS d2, CAST(o_orderdate AS DATE) AS d3, date_trunc('second', o_orderdate) AS at FROM orders")
def date_parsing(t):
    day = F.col("o_orderdate").cast("date")
    serial = F.datediff(day, F.lit("1899-12-30").cast("date"))
    stamp = F.date_format("o_orderdate", "yyyyMMdd'T'HHmmss'Z'")
    return t.orders.select("o_orderkey", T.date_in(F.date_format(day, "M/d/yyyy")).alias("d1"), T.date_from_serial(serial).alias("d2"), T.date_in(day.cast("string")).alias("d3"), T.stamp_to_timestamp(stamp, history.FLOOR).cast("timestamp_ntz").alias("at"))


@query("SELECT o_orderkey, (least(o_orderkey % 17, o_orderkey % 23) * 0.01)::DOUBLE AS low, (greatest(o_orderkey % 17, o_orderkey % 23) * 0.01)::DOUBLE AS high FROM orders")
def stated_ranges(t):
    shown = F.concat(F.lit("from "), (F.col("o_orderkey") % 17).cast("string"), F.lit("% to "), (F.col("o_orderkey") % 23).cast("string"), F.lit("%"))
    low, high = T.stated_range(shown)
    return t.orders.select("o_orderkey", low.cast("double").alias("low"), high.cast("double").alias("high"))


@query(r"SELECT page_id, regexp_extract(url, '^(https?)://', 1) AS scheme, lower(regexp_extract(url, '^[^?#]*/[^/?#]*(\.[A-Za-z0-9]{1,5})([?#]|$)', 1)) AS ext FROM pages")
def url_extension(t):
    return t.pages.select("page_id", F.regexp_extract("url", "^(https?)://", 1).alias("scheme"), T.extension_of(F.col("url"), F.lit(None).cast("string"), {"text/html": ".html"}).alias("ext"))


@query(r"SELECT doc_id, len(regexp_extract_all(text, '(\d+)%', 1)) AS n, coalesce(list_extract(regexp_extract_all(text, '(-?\d+(?:\.\d+)?)\s*%', 1), 1), '') AS first FROM documents")
def percent_slices(t):
    tokens = T.percent_tokens(F.col("text"))
    return t.documents.select("doc_id", F.size(F.regexp_extract_all("text", F.lit(r"(\d+)%"), F.lit(1))).cast("long").alias("n"), F.coalesce(F.get(tokens, F.lit(0)), F.lit("")).alias("first"))


# --- data quality ------------------------------------------------------------------------------------------------

_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]


def _judged(df: DataFrame, keys: list[str], check: str, ctx: quality.Context | None = None, **params) -> DataFrame:
    rules = quality.load_rules([{"id": "R", "check": check, "params": params}])
    return quality.evaluate(df, rules, keys, ctx or quality.Context()).select(*keys, "verdict")


def _verdicts(keys: str, case: str, source: str) -> str:
    return f"SELECT {keys}, {case} AS verdict FROM {source}"


_LK = ", ".join(_LINE_KEYS)


@query(_verdicts(_LK, "CASE WHEN l_discount BETWEEN 0.01 AND 0.08 THEN 'pass' ELSE 'violation' END", "lineitem"))
def dq_range(t):
    return _judged(t.lineitem, _LINE_KEYS, "range", field="l_discount", min="0.01", max="0.08")


@query(_verdicts("p_partkey", "CASE WHEN p_brand NOT IN ('Brand#1', 'Brand#11', 'Brand#2', 'Brand#22', 'Brand#3') THEN 'not_evaluated' WHEN p_brand = 'Brand#3' THEN 'inapplicable' WHEN p_size BETWEEN 5 AND 40 THEN 'pass' ELSE 'violation' END", "part"))
def dq_band(t):
    band = ("5", "40")
    return _judged(t.part, ["p_partkey"], "value_in_band", key_field="p_brand", value_field="p_size", bands={"Brand#1": band, "Brand#11": band, "Brand#2": band, "Brand#22": band, "Brand#3": None})


@query(_verdicts(_LK, "CASE WHEN (l_returnflag IN ('A', 'R')) = (l_tax = 0) THEN 'pass' ELSE 'violation' END", "lineitem"))
def dq_iff(t):
    return _judged(t.lineitem, _LINE_KEYS, "iff", condition={"field": "l_returnflag", "in": ["A", "R"]}, consequence={"field": "l_tax", "equals": "0"})


@query(_verdicts("c_custkey", "CASE WHEN regexp_matches(c_name, '[02468]$') THEN 'pass' ELSE 'violation' END", "customer"))
def dq_pattern(t):
    return _judged(t.customer, ["c_custkey"], "matches_pattern", field="c_name", pattern="[02468]$")


@query(_verdicts("o_orderkey", "CASE WHEN upper(substr(o_orderpriority, 3, 1)) = o_orderstatus THEN 'pass' ELSE 'violation' END", "orders"))
def dq_segment(t):
    return _judged(t.orders, ["o_orderkey"], "id_segment_matches", field="o_orderpriority", segment=[2, 3], equals_field="o_orderstatus")


@query(_verdicts("event_id", "CASE WHEN event_type = 'error' THEN 'not_evaluated' WHEN value > 50 THEN 'violation' ELSE 'pass' END", "events"))
def dq_present(t):
    e = t.events.select("event_id", F.when(F.col("event_type") != "error", F.lit(1)).alias("gate"), F.when(~(F.col("value") > 50), F.col("value")).alias("v"))
    return _judged(e, ["event_id"], "present", field="v", when_present="gate")


_BY_ORDER = quality.Context(("l_orderkey",), tuple(_LINE_KEYS[1:]))


@query(_verdicts(_LK, "CASE WHEN count(*) OVER w < 3 THEN 'inapplicable' WHEN min(l_discount) OVER w <> max(l_discount) OVER w THEN 'pass' ELSE 'violation' END", "lineitem WINDOW w AS (PARTITION BY l_orderkey)"))
def dq_degenerate(t):
    return _judged(t.lineitem, _LINE_KEYS, "not_degenerate", _BY_ORDER, field="l_discount", min_rows=3)


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'not_evaluated' WHEN coalesce(n, 0) = o_orderkey % 5 THEN 'pass' ELSE 'violation' END AS verdict FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey")
def dq_count(t):
    counted = t.lineitem.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    stated = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey") % 5)
    return _judged(t.orders.join(counted, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("stated", stated), ["o_orderkey"], "count_equals", field="stated", count_field="n")


_IDENTITY = """WITH f AS (SELECT *, CASE WHEN l_linenumber % 3 = 1 THEN l_suppkey END AS own, CASE WHEN l_linenumber = 4 THEN 0 ELSE l_extendedprice END AS target FROM lineitem),
b AS (SELECT *, coalesce(own, CASE WHEN min(own) OVER w = max(own) OVER w THEN min(own) OVER w END) AS s FROM f WINDOW w AS (PARTITION BY l_orderkey))
SELECT {0}, CASE WHEN s IS NULL THEN 'not_evaluated' WHEN target = 0 THEN '{1}' WHEN abs(l_quantity * s - target) <= 0.5 * abs(target) THEN 'pass' ELSE 'violation' END AS verdict FROM b"""


def _identity(t: Tables, **params) -> DataFrame:
    """Only some lines state their factor: the others take the order's, if it is one value; targets of zero are there too."""
    rows = t.lineitem.withColumns({"own": F.when(F.col("l_linenumber") % 3 == 1, F.col("l_suppkey")), "target": F.when(F.col("l_linenumber") == 4, F.lit(0.0)).otherwise(F.col("l_extendedprice"))})
    return _judged(rows, _LINE_KEYS, "arithmetic_identity", _BY_ORDER, factors=["l_quantity", "own"], broadcast=["own"], target="target", rel_tolerance="0.5", **params)


@query(_IDENTITY.format(_LK, "not_evaluated"))
def dq_identity(t):
    return _identity(t)


@query(_IDENTITY.format(_LK, "inapplicable"))
def dq_identity_zero(t):
    return _identity(t, inapplicable_when_target_is_zero=True)


@query("""WITH r AS (SELECT *, CASE WHEN l_orderkey % 3 > 0 OR l_linenumber % 2 = 0 THEN l_tax END AS rate, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate) AS rn FROM lineitem),
p AS (SELECT a.l_orderkey, sum(CASE WHEN a.rate IS NOT NULL AND b.rate IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN a.flag IS NOT NULL AND b.flag IS NOT NULL THEN 1 ELSE 0 END) AS compared,
  bool_or(abs(a.rate - b.rate) > 0.045000000001) AS far, bool_or(lower(trim(a.flag)) <> lower(trim(b.flag))) AS other
  FROM (SELECT *, CASE WHEN l_orderkey % 5 = 0 THEN l_linestatus END AS flag FROM r WHERE rn = 1) a JOIN (SELECT *, CASE WHEN l_orderkey % 5 = 0 THEN ' ' || lower(l_linestatus) END AS flag FROM r WHERE rn > 1) b USING (l_orderkey) GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, CASE WHEN rn > 1 THEN 'inapplicable' WHEN coalesce(compared, 0) = 0 THEN 'not_evaluated' WHEN coalesce(far, false) OR coalesce(other, false) THEN 'violation' ELSE 'pass' END AS verdict FROM r LEFT JOIN p USING (l_orderkey)""")
def dq_cross_source(t):
    """The first line of an order against each other one: two lines may differ by more than the tolerance if the first lies
    between them, and a rate that the first line lacks compares with nothing."""
    first = F.col("l_linenumber") % 2 == 0
    rows = t.lineitem.withColumns({"rate": F.when((F.col("l_orderkey") % 3 > 0) | first, F.col("l_tax")), "flag": F.when(F.col("l_orderkey") % 5 == 0, F.when(first, F.concat(F.lit(" "), F.lower("l_linestatus"))).otherwise(F.col("l_linestatus")))})
    return _judged(rows, _LINE_KEYS, "equals_across_sources", _BY_ORDER, fields=["rate", "flag"], numeric=[True, False], tolerance="0.045")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'not_evaluated' WHEN p IS NULL THEN 'inapplicable' WHEN abs(o_totalprice - p) <= 50000 THEN 'pass' ELSE 'violation' END AS verdict
FROM orders LEFT JOIN (SELECT l_orderkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS p FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""")
def dq_posted(t):
    sums = t.lineitem.groupBy("l_orderkey").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("p"))
    o = t.orders.join(sums, F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("has_p", F.col("o_orderkey") % 11 != 0)
    return _judged(o, ["o_orderkey"], "equals_manifest_field", field="o_totalprice", posted_field="p", has_posted_field="has_p", tolerance="50000")


@query(r"""WITH q AS (SELECT doc_id, doc_id % 10 AS n, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'a 4% increase' WHEN 2 THEN 'a 1.040 adjustment' WHEN 3 THEN 'rates rise by 4.' WHEN 4 THEN '4.0000 percent, or 3.5000 of it, 2.50 or 2.00' WHEN 5 THEN text ELSE 'between 3.5% and 4%' END AS quote,
  doc_id % 2 = 0 AS halves FROM documents)
SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'inapplicable' WHEN quote = '' THEN 'violation' WHEN halves AND regexp_matches(quote, '(^|[^0-9.])' || n::VARCHAR || '[.]5(000)?($|[^0-9.])') THEN 'pass'
  WHEN NOT halves AND regexp_matches(quote, '(^|[^0-9.])(' || n::VARCHAR || '|' || n::VARCHAR || '[.]0000)($|[^0-9.])') THEN 'pass' ELSE 'violation' END AS verdict FROM q""")
def dq_evidence(t):
    """Fractions such as 0.0400 and 0.0450 against quotes that print the percentage in several ways."""
    k, n = F.col("doc_id") % 7, F.col("doc_id")
    quote = F.when(k == 0, "").when(k == 1, "a 4% increase").when(k == 2, "a 1.040 adjustment").when(k == 3, "rates rise by 4.").when(k == 4, "4.0000 percent, or 3.5000 of it, 2.50 or 2.00").when(k == 5, F.col("text")).otherwise("between 3.5% and 4%")
    stated = F.concat(F.lit("0.0"), (n % 10).cast("string"), F.when(n % 2 == 0, "50").otherwise("00"))
    d = t.documents.withColumns({"impact": F.when(n % 4 != 0, stated), "quote": quote})
    return _judged(d, ["doc_id"], "evidence_contains_number", field="impact", evidence_field="quote")


_RULES = [
    {"id": "R_RANGE", "check": "range", "params": {"field": "l_discount", "min": "0.01", "max": "0.08"}},
    {"id": "R_FLAG", "check": "matches_pattern", "severity": "warn", "params": {"field": "l_returnflag", "pattern": "[AN]"}},
    {"id": "R_DEGENERATE", "check": "not_degenerate", "kind": "intra_filing", "params": {"field": "l_discount", "min_rows": 3}},
    {"id": "R_STATE", "check": "present", "scope": {"state": ["Z"]}, "params": {"field": "l_tax"}},
    {"id": "R_ADOPTED", "check": "adopted_only"},
]


@query("""WITH v AS (SELECT 'R_RANGE' AS rule_id, CASE WHEN l_discount BETWEEN 0.01 AND 0.08 THEN 'pass' ELSE 'violation' END AS verdict FROM lineitem
UNION ALL SELECT 'R_FLAG', CASE WHEN l_returnflag IN ('A', 'N') THEN 'pass' ELSE 'violation' END FROM lineitem
UNION ALL SELECT 'R_DEGENERATE', CASE WHEN count(*) OVER w < 3 THEN 'inapplicable' WHEN min(l_discount) OVER w <> max(l_discount) OVER w THEN 'pass' ELSE 'violation' END FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)),
r AS (SELECT unnest(['R_RANGE', 'R_FLAG', 'R_DEGENERATE', 'R_STATE', 'R_ADOPTED']) AS rule_id)
SELECT rule_id, count(verdict) AS evaluated, count(*) FILTER (WHERE verdict = 'pass') AS passed, count(*) FILTER (WHERE verdict = 'violation') AS violated, count(*) FILTER (WHERE verdict = 'inapplicable') AS inapplicable,
       count(*) FILTER (WHERE verdict = 'not_evaluated') AS not_evaluated, 0::BIGINT AS adopted FROM r LEFT JOIN v USING (rule_id) GROUP BY rule_id""")
def dq_results(t):
    rules = quality.load_rules(_RULES)
    frame = t.lineitem.withColumn("state", F.col("l_linestatus"))
    out = quality.with_totals(quality.tally(frame, rules, _BY_ORDER), rules)
    return out.select("rule_id", *[F.col(c).cast("long") for c in ("evaluated", "passed", "violated", "inapplicable", "not_evaluated", "adopted")])


_FOUND = "SELECT 'R' AS rule_id, user_id AS filing_id, event_type AS subject_key, NULL AS field_name FROM events WHERE value > {0} GROUP BY ALL"


def _found(t: Tables, least: float) -> DataFrame:
    return t.events.where(F.col("value") > least).select(F.lit("R").alias("rule_id"), F.col("user_id").alias("filing_id"), F.col("event_type").alias("subject_key"), F.lit(None).cast("string").alias("field_name")).distinct()


@query(f"WITH a AS ({_FOUND.format(20)}), b AS ({_FOUND.format(60)}) SELECT rule_id, filing_id, subject_key, 'resolved' AS reprocess_status FROM a WHERE (filing_id, subject_key) NOT IN (SELECT (filing_id, subject_key) FROM b)")
def dq_resolve(t):
    return quality.resolve(_found(t, 20), _found(t, 60), "20270101T000000Z", "20270101T000000Z").select("rule_id", "filing_id", "subject_key", "reprocess_status")


@query("""SELECT rule_id, filing_id, subject_key FROM (SELECT 'R' AS rule_id, user_id AS filing_id, props AS subject_key, event_type, row_number() OVER (PARTITION BY user_id, coalesce(props, '') ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'""")
def dq_open_findings(t):
    rows = t.events.select(F.lit("R").alias("rule_id"), F.col("user_id").alias("filing_id"), F.col("props").alias("subject_key"), F.lit(None).cast("string").alias("field_name"), F.col("ts").alias("quarantined_at"), F.col("event_id").alias("source_line"), F.when(F.col("event_type") == "error", "resolved").otherwise("open").alias("reprocess_status"))
    return quality.open_findings(rows).select("rule_id", "filing_id", "subject_key")


@query("SELECT event_id, CASE WHEN event_type = 'click' THEN 'R_CLICK' ELSE 'R_VIEW' END AS rule_id, 'adopted' AS origin FROM events WHERE event_type IN ('click', 'view')")
def dq_adopt(t):
    misses = t.events.select("event_id", F.col("event_type").alias("reason"))
    return quality.adopt(misses, {"click": "R_CLICK", "view": "R_VIEW"}, "20270101T000000Z", "20270101T000000Z").select("event_id", "rule_id", "origin")


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN lpad(user_id::VARCHAR, 5, '0') || 'OR' || lpad((event_id % 10000000)::VARCHAR, 7, '0') ELSE 'page.' || event_type END AS subject_key FROM events""")
def dq_adopted_subjects(t):
    """Misses whose detail opens with a plan id, with something like one, or with none."""
    n = F.col("event_id")
    plan = F.concat(F.lpad(F.col("user_id").cast("string"), 5, "0"), F.lit("OR"), F.lpad((n % 10000000).cast("string"), 7, "0"))
    detail = F.when(n % 3 == 0, F.concat(F.lit(" "), plan, F.lit(": parsed 0.02 falls outside"))).when(n % 3 == 1, F.concat(F.substring(plan, 2, 13), F.lit(": no")))
    return t.events.select("event_id", quality.adopted_subject(detail, F.lit("page"), F.col("event_type")).alias("subject_key"))


@query("SELECT DISTINCT event_type AS reason FROM events WHERE event_type NOT IN ('click', 'view')")
def dq_unmapped_reasons(t):
    return quality.unmapped_reasons(t.events.select(F.col("event_type").alias("reason")), {"click": "R_CLICK", "view": "R_VIEW"})


# --- assertions --------------------------------------------------------------------------------------------------


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 45)")
def fk_orphans(t):
    return checks.orphans(t.lineitem, "l_partkey", t.part.where("p_size < 45"), "p_partkey").select(*_LINE_KEYS)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def dup_keys(t):
    return checks.repeated_keys(t.lineitem, "l_orderkey", "l_linenumber")


@query("SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1")
def unexpected_values(t):
    return checks.unexpected_values(t.events, "event_type", ["click", "view"])


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000")
def outside_range(t):
    return checks.outside_range(t.customer, "c_acctbal", 0.0, 9000.0).select("c_custkey", "c_acctbal")


@query("""SELECT c_custkey AS id, 'negative balance' AS problem FROM customer WHERE c_acctbal < 0 UNION ALL SELECT o_orderkey, 'pending order' FROM orders WHERE o_orderstatus = 'P' UNION ALL SELECT s_suppkey, 'no nation' FROM supplier WHERE s_nationkey IS NULL""")
def failure_union(t):
    return checks.union_failures({
        "negative balance": t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("id")),
        "pending order": t.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("id")),
        "no nation": checks.not_null(t.supplier, "s_nationkey").select(F.col("s_suppkey").alias("id")),
    })


@query(f"""WITH {_SCD2}, broken AS (SELECT o_custkey, valid_from, CASE WHEN o_custkey % 5 = 0 AND valid_to IS NULL THEN TIMESTAMP '2030-01-01' WHEN o_custkey % 3 = 0 AND version_seq = 2 THEN NULL ELSE valid_to END AS valid_to FROM scd WHERE o_custkey % 4 > 0 OR version_seq <> 2),
n AS (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS nxt FROM broken)
SELECT o_custkey, 'gap or overlap' AS problem FROM n WHERE nxt IS NOT NULL AND (valid_to IS NULL OR valid_to <> nxt) UNION ALL SELECT o_custkey, 'current versions' FROM broken GROUP BY 1 HAVING count(*) FILTER (WHERE valid_to IS NULL) <> 1""")
def scd2_sane(t):
    """Windows some of which were broken: without their second version, with a second current one, or with none."""
    late = F.to_timestamp(F.lit("2030-01-01"))
    v = _labels(t).where((F.col("o_custkey") % 4 > 0) | (F.col("version_seq") != 2))
    end = F.when((F.col("o_custkey") % 5 == 0) & F.col("valid_to").isNull(), late).when((F.col("o_custkey") % 3 == 0) & (F.col("version_seq") == 2), F.lit(None)).otherwise(F.col("valid_to"))
    broken = v.withColumn("valid_to", end.cast(v.schema["valid_to"].dataType)).withColumn("is_current", F.col("valid_to").isNull())
    return checks.windows_sane(broken, "o_custkey")


@query(f"WITH s AS (SELECT *, {_STATUS} AS status FROM lineitem) SELECT l_orderkey, status FROM s WHERE (status IN ('quarantined', 'cell_error', 'missing')) <> (l_tax < 0.01)")
def vetted_matches_status(t):
    rows = t.lineitem.withColumn("status", _status()).withColumn("measure", F.when(~(F.col("l_tax") < 0.01), F.col("l_tax")))
    return checks.vetted_matches_status(rows, "measure", "status", conform.UNTRUSTED).select("l_orderkey", "status")


@query("SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000)")
def never_reported(t):
    return checks.never_reported(t.orders, t.orders.where("o_orderstatus = 'F' and o_totalprice > 250000"), ["o_custkey"])


@query("SELECT o_orderkey, top FROM orders, (SELECT max(o_orderkey) - 100 AS top FROM orders WHERE o_orderstatus = 'F') WHERE top IS NOT NULL AND o_orderkey > top")
def beyond_ceiling(t):
    """Rows past a one-row maximum: a nested loop over a single broadcast row."""
    top = t.orders.where("o_orderstatus = 'F'").agg((F.max("o_orderkey") - 100).alias("top"))
    return t.orders.join(F.broadcast(top), F.col("o_orderkey") > F.col("top")).select("o_orderkey", "top")


# --- extraction --------------------------------------------------------------------------------------------------


def _manifest(t: Tables) -> DataFrame:
    """Events as sightings of documents, a user's events of one kind being one document."""
    return t.events.select(
        "user_id",
        F.when(F.col("event_type").isin("click", "view"), "page").when(F.col("event_type") == "purchase", "sheet").otherwise("odd").alias("document_role"),
        F.col("ts").alias("retrieved_at"),
        F.col("event_id").alias("source_line"),
        F.when(F.col("event_id") % 10 == 0, F.lit("x")).alias("error"),
        F.lit("h").alias("content_hash"),
        F.when(F.col("event_id") % 3 == 0, F.when(F.col("event_id") % 2 == 0, "text/html; charset=utf-8").otherwise("text/csv")).alias("content_type"),
        F.when(F.col("event_id") % 7 != 0, F.when(F.col("event_id") % 5 == 0, "a/b.csv").otherwise("a/b.html")).alias("stored_path"),
    )


@query("""WITH m AS (SELECT user_id, CASE WHEN event_type IN ('click', 'view') THEN 'page' WHEN event_type = 'purchase' THEN 'sheet' ELSE 'odd' END AS document_role, ts, event_id,
CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_id % 2 = 0 THEN 'text/html' ELSE 'text/csv' END END AS ct, CASE WHEN event_id % 7 <> 0 THEN CASE WHEN event_id % 5 = 0 THEN '.csv' ELSE '.html' END END AS ext FROM events),
k AS (SELECT *, last_value(ct IGNORE NULLS) OVER (PARTITION BY user_id, document_role ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS known FROM m),
l AS (SELECT *, row_number() OVER (PARTITION BY user_id, document_role ORDER BY ts DESC, event_id DESC) AS rn FROM k WHERE event_id % 10 <> 0)
SELECT user_id, document_role, event_id AS source_line, CASE WHEN ext IS NULL THEN 'no stored path' WHEN known IS NULL THEN 'no content type was ever seen' WHEN document_role = 'odd' THEN 'unknown role'
WHEN known <> CASE document_role WHEN 'page' THEN 'text/html' ELSE 'text/csv' END THEN 'role and content type disagree' WHEN ext <> CASE document_role WHEN 'page' THEN '.html' ELSE '.csv' END THEN 'role and extension disagree' END AS problem FROM l WHERE rn = 1""")
def resolve_documents(t):
    out = extraction.resolve_documents(_manifest(t), ["user_id", "document_role"], {"page": ["text/html"], "sheet": ["text/csv"]}, {"page": [".html"], "sheet": [".csv"]})
    return out.select("user_id", "document_role", "source_line", "problem")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN NULL WHEN o_orderkey % 5 = 2 THEN 'text' ELSE (o_orderkey % 100)::VARCHAR || '.25' END AS text,
CASE WHEN o_orderkey % 5 >= 3 THEN (o_orderkey % 100) + 0.25 END::DOUBLE AS number, o_orderkey % 5 = 1 AS is_error FROM orders""")
def cell_coercion(t):
    k = F.col("o_orderkey") % 5
    raw = F.when(k == 0, F.lit("  ")).when(k == 1, F.lit("#DIV/0!")).when(k == 2, F.lit(" text ")).otherwise(F.concat((F.col("o_orderkey") % 100).cast("string"), F.lit(".25 ")))
    text, number, error = extraction.cell(raw)
    return t.orders.select("o_orderkey", text.alias("text"), number.cast("double").alias("number"), error.alias("is_error"))


@query("""SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY count(*) DESC, count(DISTINCT l_suppkey) DESC, l_linenumber) AS rn FROM lineitem
WHERE regexp_matches(l_suppkey::VARCHAR, '^[1-5]') GROUP BY 1, 2) WHERE rn = 1""")
def column_by_vote(t):
    cells = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("string").alias("v"))
    return extraction.column_by_vote(cells, ["l_orderkey"], "l_linenumber", "v", "^[1-5]")


@query("""SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) + max(CASE WHEN l_returnflag IN ('A', 'N') THEN 1 ELSE 0 END) AS hits,
row_number() OVER (PARTITION BY l_orderkey ORDER BY max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) + max(CASE WHEN l_returnflag IN ('A', 'N') THEN 1 ELSE 0 END) DESC, l_linenumber) AS rn FROM lineitem GROUP BY 1, 2) WHERE rn = 1 AND hits > 0""")
def header_row(t):
    return extraction.header_row(t.lineitem, ["l_orderkey"], "l_linenumber", "l_returnflag", ["R", "[AN]"])


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_tax BETWEEN 0.015 AND 0.065 AS kept, ((l_linenumber % 9) * 0.01)::DOUBLE AS rate FROM lineitem")
def stated_range_split(t):
    line = F.concat(F.lit("7% P"), F.col("l_partkey").cast("string"), F.lit(": "), (F.col("l_linenumber") % 9).cast("string"), F.lit("% and 50%"))
    rate = extraction.first_percent_after(line, F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit(":")))
    kept = extraction.within_stated(F.col("l_tax"), F.lit(0.06), F.lit(0.02))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", kept.alias("kept"), rate.cast("double").alias("rate"))


@query("""SELECT o_orderkey, coalesce(a, m) AS value, a IS NOT NULL AND m IS NOT NULL AND abs(a - m) > 100000 AS disagrees FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS a, CASE WHEN o_orderkey % 4 > 0 THEN 250000.0::DOUBLE END AS m FROM orders)""")
def precedence_merge(t):
    anchor = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice"))
    model = F.when(F.col("o_orderkey") % 4 > 0, F.lit(250000.0))
    value, note = extraction.merged(anchor, model, 100000.0)
    return t.orders.select("o_orderkey", value.alias("value"), note.isNotNull().alias("disagrees"))


_LEDGER = """e AS (SELECT user_id AS filing_id, event_type AS document_role, event_id, CASE WHEN value < 3 THEN 'failed' WHEN value < 10 THEN 'partial' ELSE 'extracted' END AS status FROM events WHERE event_id % 17 <> 0),
d AS (SELECT user_id AS filing_id, event_type AS document_role FROM events GROUP BY ALL)"""


@query(f"""WITH {_LEDGER} SELECT 'every document has an outcome' AS problem, count(*) AS n FROM d WHERE (filing_id, document_role) NOT IN (SELECT (filing_id, document_role) FROM e) HAVING count(*) > 0
UNION ALL SELECT 'one outcome a document', count(*) FROM (SELECT 1 FROM e GROUP BY filing_id, document_role HAVING count(*) > 1) HAVING count(*) > 0
UNION ALL SELECT 'outcomes are terminal and say why', count(*) FROM e WHERE status = 'partial' HAVING count(*) > 0
UNION ALL SELECT 'misses are recorded', count(*) FROM e WHERE status = 'partial' HAVING count(*) > 0
UNION ALL SELECT 'a wrong count is partial', count(*) FROM e WHERE status = 'extracted' AND event_id % 4 <> 0 HAVING count(*) > 0""")
def ledger_gate(t):
    status = F.when(F.col("value") < 3, "failed").when(F.col("value") < 10, "partial").otherwise("extracted")
    e = t.events.where("event_id % 17 <> 0").select(
        F.col("user_id").alias("filing_id"), F.col("event_type").alias("document_role"), status.alias("status"), F.when(status == "failed", "why").alias("reason"), F.when(status == "failed", "E").alias("error_class"),
        F.lit(2).alias("fields_targeted"), F.when(status == "partial", 1).otherwise(2).alias("fields_populated"), F.when(status == "partial", 1).otherwise(0).alias("fields_missed"), F.lit(0).alias("plan_count_stated"), (F.col("event_id") % 4).alias("plan_rows_emitted"),
    )
    documents = t.events.select(F.col("user_id").alias("filing_id"), F.col("event_type").alias("document_role"))
    gate = extraction.ledger_gate(e, documents, documents.where("false"))
    found = checks.union_failures({name: df.agg(F.count("*").alias("n")) for name, df in gate.items()})
    return found.where("n > 0")


@query("""SELECT user_id % 20 AS run_id, count(*) AS documents, count(*) FILTER (WHERE value >= 10) AS extracted, count(*) FILTER (WHERE value >= 3 AND value < 10) AS partial, 0::BIGINT AS skipped, count(*) FILTER (WHERE value < 3) AS failed,
sum(event_id % 4)::BIGINT AS plan_rows_emitted FROM events GROUP BY 1""")
def outcome_totals(t):
    status = F.when(F.col("value") < 3, "failed").when(F.col("value") < 10, "partial").otherwise("extracted")
    zero = ("filing_rows_emitted", "justification_rows_emitted", "fields_targeted", "fields_populated", "fields_missed")
    e = t.events.select((F.col("user_id") % 20).alias("run_id"), status.alias("status"), (F.col("event_id") % 4).alias("plan_rows_emitted"), *[F.lit(0).alias(c) for c in zero])
    return extraction.totals(e).drop(*zero)
