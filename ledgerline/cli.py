"""Command lines: ``python -m ledgerline.cli load`` and ``python -m ledgerline.cli validate``. Exit codes are those of plans/run.py.

load lands the whole tree and builds the marts before anything is published, so a file that can't be read leaves the last version
in place. validate evaluates rules over the current extracts and appends what it found; it rewrites nothing, so running it again
over the same extracts (--reprocess extracted) only adds a run. --reprocess raw extracts again first, by a command that is given,
and stops if that command's own gate failed. There is no mode that fetches sources anew: that is ingestion.
"""

from __future__ import annotations

import argparse
import shlex
import subprocess
import sys
from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import reports
from .operators.quality import RuleError
from .plans import validate as V
from .plans.run import BREACHED, CLEAN, FAILED, run_stamp
from .plans.warehouse import SEED, Models
from .sources import landing
from .sources.config import ConfigError, load_rule_set


def session() -> SparkSession:
    return SparkSession.builder.appName("ledgerline").getOrCreate()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="python -m ledgerline.cli", description=__doc__.splitlines()[0])
    commands = top.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="land the tree and publish the marts as one version")
    load.add_argument("--data-root", default="data")
    load.add_argument("--warehouse", default="data/warehouse")
    load.add_argument("--seed", help="a CSV file of the federal seed")
    load.add_argument("--keep", type=int, default=1, help="versions kept besides the new one")
    check = commands.add_parser("validate", help="evaluate the rules over the current extracts")
    check.add_argument("--rules", required=True)
    check.add_argument("--data-root", default="data")
    check.add_argument("--reprocess", choices=("extracted", "raw"))
    check.add_argument("--extract-command", help="what --reprocess raw runs first; {filing} is replaced")
    check.add_argument("--filing", help="this filing alone: of filing scope, without the gate and without resolutions")
    check.add_argument("--no-gate", action="store_true", help="report without the gate")
    return top


def _rows(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))


def load(spark: SparkSession, data_root: str, warehouse: str, seed: str | None = None, keep: int = 1, say: Callable[[str], None] = print) -> int:
    """Lands the tree, publishes the raw tables and the marts together, and retires old versions."""
    load_id = run_stamp()
    try:
        raw = landing.read_all(spark, data_root, load_id)
        federal = landing.read_seed(spark, seed, SEED) if seed else None
        store = landing.Warehouse(spark, warehouse)
        counts = store.publish({f"raw_{t}": df for t, df in raw.items()}, lambda stored: Models({t: stored[f"raw_{t}"] for t in raw}, federal).marts())
        store.retire(keep)
    except (OSError, PySparkException) as e:
        print(f"load failed, the last version stays: {str(e).splitlines()[0]}", file=sys.stderr)
        return FAILED
    say(f"load {load_id}")
    for name, n in counts.items():
        say(f"  {name:<32} {n:>12,}")
    say(f"  {'all':<32} {sum(counts.values()):>12,}")
    return CLEAN


def _again(command: str | None, filing: str | None) -> int:
    if not command:
        print("--reprocess raw needs --extract-command", file=sys.stderr)
        return FAILED
    return subprocess.run([x.replace("{filing}", filing or "") for x in shlex.split(command)], check=False).returncode


def validate(spark: SparkSession, rules: object, data_root: str, reprocess: str | None = None, filing: str | None = None, gate: bool = True, extract: Callable[[str | None], int] | None = None, say: Callable[[str], None] = print) -> int:
    """One validation run, appended to the tree's ledgers."""
    try:
        config = load_rule_set(rules)
    except ConfigError as e:
        print(f"rules: {e}", file=sys.stderr)
        return FAILED
    if reprocess == "raw":
        code = extract(filing) if extract else FAILED
        if code not in (CLEAN, FAILED):  # findings are no reason to stop, a breached gate is
            print(f"extraction ended with {code}: its output is not validated", file=sys.stderr)
            return code
    try:
        m = Models(landing.read_all(spark, data_root))
    except OSError as e:
        print(e, file=sys.stderr)
        return FAILED
    if m.manifest.isEmpty():
        print(f"no manifest under {data_root}: ingest first", file=sys.stderr)
        return FAILED
    if config.sources:
        strange = [f"{r['document_role']} ({r['problem']})" for r in V.sources_disagree(config.sources, m.manifest).orderBy("document_role").limit(V.NAMED).collect()]
        if strange:
            print(f"rules: sources and manifest disagree on {', '.join(strange)}", file=sys.stderr)
            return FAILED
    current = m.current_runs if filing is None else m.current_runs.where(F.col("filing_id") == filing)
    if current.isEmpty():
        print(f"nothing extracted under {data_root}", file=sys.stderr)
        return FAILED
    taken = m.results.where(F.col("run_id") >= run_stamp()).select("run_id").distinct()  # stamps from now on, if any
    run_id = run_stamp(taken={r["run_id"] for r in taken.collect()})
    try:
        found = V.validate(m, config.rules, run_id, config.reasons, None if filing is None else [filing])
    except RuleError as e:
        print(e, file=sys.stderr)
        return BREACHED
    try:
        landing.append_rows(found.quarantine, f"{data_root}/{landing.LEDGERS['quarantine']}")
        landing.append_rows(found.results.withColumnRenamed("check_name", "check"), f"{data_root}/{landing.LEDGERS['dq_results']}")
        say(f"run {run_id}, scope {'corpus' if filing is None else 'filing'}, {len(config.rules)} rules" + (f", reprocessing {reprocess}" if reprocess else ""))
        for line in reports.lines(reports.by_findings(found.results).collect()):  # a row a rule
            say(line)
        if filing is not None or not gate:
            return found.findings_code()
        broken = found.breaches()
        for name, n in broken.items():
            print(f"gate: {name}: {n}", file=sys.stderr)
        return BREACHED if broken else found.findings_code()
    finally:
        found.release()


def main(argv: Sequence[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = session()
    if args.command == "load":
        return load(spark, args.data_root, args.warehouse, args.seed, args.keep)
    return validate(spark, args.rules, args.data_root, args.reprocess, args.filing, not args.no_gate, lambda filing: _again(args.extract_command, filing))


if __name__ == "__main__":
    raise SystemExit(main())
