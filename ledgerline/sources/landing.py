"""Landing raw files as semi-structured rows with their file and line, and publishing tables as one version."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RAW_SCHEMA = "payload variant, source_file string, source_line int, loaded_at timestamp, load_id string"
#: table -> file of each ledger and extract; fixed values of the tree that is landed.
LEDGERS = {
    "ingest_manifest": "raw/ingest_manifest.jsonl",
    "extraction_outcomes": "extracted/_ledger/extraction_outcomes.jsonl",
    "field_misses": "extracted/_ledger/field_misses.jsonl",
    "llm_calls": "extracted/_ledger/llm_calls.jsonl",
    "quarantine": "validated/quarantine.jsonl",
    "dq_results": "validated/dq_results.jsonl",
}
#: What the name of a ledger's folder of appended lines ends in.
MORE = ".d"
EXTRACTS = {"filing_extracts": "filing.json", "plan_extracts": "plans.json", "justification_extracts": "justifications.json"}


def empty_raw(spark: SparkSession) -> DataFrame:
    return spark.sql("select parse_json('null') payload, '' source_file, 0 source_line, current_timestamp() loaded_at, '' load_id where false").select("payload", "source_file", "source_line", "loaded_at", "load_id")


def _relative(root: str, path: Column) -> Column:
    """A file's path from the root on; both may or may not name a scheme."""
    bare = "^[a-zA-Z][a-zA-Z0-9+.-]*:/+"
    return F.replace(F.regexp_replace(path, bare, "/"), F.lit(re.sub(bare, "/", root.rstrip("/")) + "/"), F.lit(""))


def _stamped(df: DataFrame, load_id: str) -> DataFrame:
    return df.select("payload", "source_file", F.col("source_line").cast("int"), F.current_timestamp().alias("loaded_at"), F.lit(load_id).alias("load_id"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, line): the lines of text files with their physical numbers from 1, however large the files are.

    A split of a file is read in order by one task, so row ids within it are consecutive; the lines of the splits before it
    are counted and summed. The counts are one row a split, so files are read in parallel and nothing is read whole."""
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"))
    splits = rows.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = splits.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    return rows.join(shifts, ["file", "block"]).select("value", "file", (F.col("id") + F.col("shift")).alias("line"))


def read_jsonl(spark: SparkSession, root: str, path: str, load_id: str = "") -> DataFrame:
    """A row per non-blank line under its physical number; a line that is no JSON fails the job."""
    lines = numbered_lines(spark, path if "://" in path or path.startswith("/") else f"{root}/{path}")
    source = _relative(root, F.col("file"))
    where = F.concat(source, F.lit(":"), F.col("line").cast("string"), F.lit(" is no JSON"))
    payload = F.coalesce(F.try_parse_json("value"), F.raise_error(where).cast("variant"))
    return _stamped(lines.where(F.trim("value") != "").select(payload.alias("payload"), source.alias("source_file"), F.col("line").alias("source_line")), load_id)


def read_json_arrays(spark: SparkSession, root: str, pattern: str, load_id: str = "") -> DataFrame:
    """A row per array element, numbered from 1; a file that is no JSON array fails the job."""
    files = spark.read.text(f"{root}/{pattern}", wholetext=True).select("value", _relative(root, F.col("_metadata.file_path")).alias("source_file"))
    parsed = files.withColumn("doc", F.coalesce(F.try_parse_json("value"), F.raise_error(F.concat(F.col("source_file"), F.lit(" is no JSON"))).cast("variant")))
    checked = parsed.withColumn("doc", F.when(F.schema_of_variant("doc").startswith("ARRAY"), F.col("doc")).otherwise(F.raise_error(F.concat(F.col("source_file"), F.lit(" is no array"))).cast("variant")))
    checked.createOrReplaceTempView(view := f"arrays_{uuid.uuid4().hex}")
    rows = spark.sql(f"select source_file, e.pos + 1 as source_line, e.value as payload from {view}, lateral variant_explode(doc) e")
    return _stamped(rows, load_id)


def discover(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """The files there are of each table, as the root's own file system lists them, local or not; folders whose names start
    with an underscore hold no extracts. A root that can't be read fails: it isn't an empty tree."""
    jvm, base = spark.sparkContext._jvm, root.rstrip("/")
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path(base)):
        raise FileNotFoundError(f"nothing to land: {root} doesn't exist")
    start = len(fs.makeQualified(path(base)).toUri().getPath().rstrip("/")) + 1

    def named(pattern: str) -> list[str]:
        return sorted(s.getPath().toUri().getPath()[start:] for s in fs.globStatus(path(f"{base}/{pattern}")) or ())

    found = {t: named(p) + named(f"{p}{MORE}") for t, p in LEDGERS.items()}
    for t, name in EXTRACTS.items():
        found[t] = [p for p in named(f"extracted/*/*/*/{name}") if not any(x.startswith("_") for x in p.split("/"))]
    return found


def read_all(spark: SparkSession, root: str, load_id: str = "") -> dict[str, DataFrame]:
    """Every table of the tree, empty where there are no files."""
    there, out = discover(spark, root), {}
    for t, path in LEDGERS.items():
        out[t] = read_jsonl(spark, root, f"{path}{{,{MORE}}}", load_id) if there[t] else empty_raw(spark)
    for t, name in EXTRACTS.items():
        out[t] = read_json_arrays(spark, root, f"extracted/[!_]*/[!_]*/[!_]*/{name}", load_id) if there[t] else empty_raw(spark)
    return out


def from_rows(spark: SparkSession, rows: Sequence[Mapping], source_file: str = "rows") -> DataFrame:
    """Rows of plain values as a raw table, for tests and small inputs. Keys that a row lacks stay absent."""
    texts = [(json.dumps(r, ensure_ascii=False), source_file, i + 1) for i, r in enumerate(rows)]
    if not texts:
        return empty_raw(spark)
    df = spark.createDataFrame(texts, "text string, source_file string, source_line int")
    return _stamped(df.select(F.parse_json("text").alias("payload"), "source_file", "source_line"), "")


class Warehouse:
    """Tables published together: each version is a folder, and a pointer file, replaced in one step, names the current one.

    All tables of a version are written before the pointer moves, so readers see the old tables or the new ones, never some
    of each, and a failed load leaves the old ones in place."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def publish(self, tables: Mapping[str, DataFrame], then: Callable[[Mapping[str, DataFrame]], Mapping[str, DataFrame]] | None = None, threads: int = 8) -> dict[str, int]:
        """Writes the tables and, of the same version, those that then makes of the written ones; several at a time, as tables
        don't wait for each other. The pointer moves last."""
        version, counts = uuid.uuid4().hex, {}

        def write(name: str, df: DataFrame) -> tuple[str, DataFrame, int]:
            path = f"{self.path}/{version}/{name}"
            df.write.mode("errorifexists").parquet(path)
            stored = self.spark.read.schema(df.schema).parquet(path)
            return name, stored, stored.count()

        with ThreadPoolExecutor(threads) as pool:
            done = list(pool.map(lambda x: write(*x), tables.items()))
            if then is not None:
                done += pool.map(lambda x: write(*x), then({name: df for name, df, _ in done}).items())
        counts = {name: n for name, _, n in done}
        jvm = self.spark.sparkContext._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fresh, current = jvm.org.apache.hadoop.fs.Path(f"{self.path}/next.json"), jvm.org.apache.hadoop.fs.Path(f"{self.path}/current.json")
        out = fs.create(fresh, True)
        out.write(bytearray(json.dumps({"version": version, "rows": counts}).encode()))
        out.close()
        options = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        renames = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        renames[0] = options
        context.rename(fresh, current, renames)
        return counts

    def retire(self, keep: int = 1) -> list[str]:
        """Deletes all versions but the current one and the keep newest others, which readers may still have open; returns their names."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path
        fs = path(self.path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        current = self.current()["version"]
        versions = sorted(((s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(path(self.path)) if s.isDirectory() and s.getPath().getName() != current), reverse=True)
        gone = [name for _, name in versions[keep:]]
        for name in gone:
            fs.delete(path(f"{self.path}/{name}"), True)
        return gone

    def current(self) -> dict:
        return json.loads("".join(r[0] for r in self.spark.read.text(f"{self.path}/current.json").collect()))

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{self.current()['version']}/{table}")


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Files with their bytes, size and tagged hash."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.withColumn("content_hash", F.concat(F.lit("sha256:"), F.sha2("content", 256)))


def new_documents(documents: DataFrame, known: DataFrame, key: str = "path") -> DataFrame:
    """Documents whose last known hash isn't theirs: nothing that didn't change is stored again."""
    return documents.join(known.select(key, "content_hash"), [key, "content_hash"], "left_anti")


def append_rows(df: DataFrame, ledger: str) -> None:
    """Adds rows to a ledger of JSON lines: to the folder beside its file, so nothing that is there is rewritten."""
    df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("append").text(ledger + MORE)


def append(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Adds rows to a ledger of Parquet files; rows are never rewritten."""
    writer = df.write.mode("append")
    (writer.partitionBy(*by) if by else writer).parquet(path)
