"""The driver of a run: detect, extract what is stale, validate, load, check; with a lock, a run record and exit codes."""

from __future__ import annotations

import json
import os
import time
import traceback
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

#: Exit codes: denied or broken configuration, a gate breached or nothing converged, a step failed, all well.
DENIED, BREACHED, FAILED, CLEAN = 2, 3, 1, 0
NODES = ("ingest", "detect", "extract", "redetect", "validate", "load", "build")


def combine_exit(codes: Iterable[int]) -> int:
    """The gravest of several codes: 2, then 3, then 1, then 0."""
    order = (DENIED, BREACHED, FAILED, CLEAN)
    return min(codes, key=order.index, default=CLEAN)


def run_stamp(now: datetime | None = None, taken: Iterable[str] = ()) -> str:
    """A compact UTC stamp that isn't taken, moved on by seconds if need be. Stamps sort as they follow in time."""
    at, used = now or datetime.now(UTC), set(taken)
    while (stamp := at.strftime("%Y%m%dT%H%M%SZ")) in used:
        at += timedelta(seconds=1)
    return stamp


def detect_exit(changed: int, failed: int, denied: bool = False) -> int:
    return BREACHED if denied else FAILED if failed else CLEAN


def is_bootstrap(n_outcomes: int) -> bool:
    """Nothing was ever extracted, so everything is extracted in one go."""
    return n_outcomes == 0


def coverage_gap(expected: set[str], seen: set[str]) -> set[str]:
    return expected - seen


def converged(stale: set[str], failed: set[str]) -> bool:
    """After extraction nothing is stale but what failed."""
    return stale <= failed


def validation_is_current(latest_extract: str | None, latest_validation: str | None) -> bool:
    """Whether the last complete validation is younger than the last extraction. Stamps compare as text."""
    return latest_extract is None or (latest_validation is not None and latest_validation > latest_extract)


@contextmanager
def lock(folder: str):
    """One run at a time: the lock file is created or the run is denied."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, ".lock")
    try:
        handle = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
    except FileExistsError as e:
        raise PermissionError(f"another run holds {path}") from e
    try:
        os.write(handle, str(os.getpid()).encode())
        os.close(handle)
        yield
    finally:
        os.unlink(path)


@dataclass
class Step:
    """What a node did: its status, code, and the effect that proves it, such as new run ids."""

    node: str
    status: str = "succeeded"
    code: int = CLEAN
    effect: list[str] = field(default_factory=list)
    seconds: float = 0.0
    detail: str = ""


@dataclass
class Steps:
    """The functions of a deployment. Each may raise; a fan-out's failures stay with their filing.

    run_ids(kind) lists the runs there are, so that success is read from the effect and not from a code alone."""

    run_ids: Callable[[str], set[str]]
    stale: Callable[[], set[str]]
    extract: Callable[[str | None], None]
    validate: Callable[[], int]
    load: Callable[[], dict[str, int]]
    build: Callable[[], dict[str, int]]
    ingest: Callable[[], None] | None = None
    n_outcomes: Callable[[], int] = lambda: 1
    latest: Callable[[str], str | None] = lambda kind: None


class Run:
    """One pass through the nodes, recorded as one JSON line per node and one for the run."""

    def __init__(self, steps: Steps, folder: str) -> None:
        self.steps, self.folder = steps, folder
        self.record: list[Step] = []

    def _write(self, name: str, row: dict) -> None:
        with open(os.path.join(self.folder, name), "a", encoding="utf-8") as f:
            f.write(json.dumps(row, sort_keys=True) + "\n")

    def _node(self, name: str, work: Callable[[], object], kind: str | None = None, code: int = FAILED) -> tuple[Step, object]:
        step, began, out = Step(name), time.monotonic(), None
        before = self.steps.run_ids(kind) if kind else set()
        try:
            out = work()
            if kind:
                step.effect = sorted(self.steps.run_ids(kind) - before)
                if not step.effect:
                    step.status, step.code, step.detail = "failed", code, "it ended without a new run"
        except Exception as e:
            step.status, step.code, step.detail = "failed", code, "".join(traceback.format_exception_only(e)).strip()
        step.seconds = round(time.monotonic() - began, 3)
        self.record.append(step)
        return step, out

    def _skip(self, name: str, why: str) -> None:
        self.record.append(Step(name, "skipped", detail=why))

    def go(self) -> int:
        try:
            with lock(self.folder):
                run_id = run_stamp()
                self._write("dag_runs.jsonl", {"dag_run_id": run_id, "status": "running"})
                self._walk()
                code = combine_exit(s.code for s in self.record)
                for seq, s in enumerate(self.record):
                    self._write("dag_nodes.jsonl", {"dag_run_id": run_id, "seq": seq, **s.__dict__})
                self._write("dag_runs.jsonl", {"dag_run_id": run_id, "status": "succeeded" if code == CLEAN else "failed", "exit_code": code})
                return code
        except PermissionError:
            return DENIED

    def _walk(self) -> None:
        s = self.steps
        if s.ingest is None:
            self._skip("ingest", "offline")
        elif self._node("ingest", s.ingest, "ingest")[0].code:
            return
        step, stale = self._node("detect", s.stale)
        if step.code:
            return
        failed: set[str] = set()
        if is_bootstrap(s.n_outcomes()):
            self._node("extract", lambda: s.extract(None), "extract")
        elif not stale:
            self._skip("extract", "nothing is stale")
        else:
            for filing in sorted(stale):  # one filing's failure leaves the others alone
                if self._node(f"extract {filing}", lambda f=filing: s.extract(f), "extract")[0].code:
                    failed.add(filing)
        if any(x.node.startswith("extract") and x.status != "skipped" for x in self.record):
            step, left = self._node("redetect", s.stale)
            if not step.code and not converged(left, failed):
                step.status, step.code, step.detail = "failed", BREACHED, f"still stale: {sorted(left - failed)}"
                return
        if validation_is_current(s.latest("extract"), s.latest("validate")):
            self._skip("validate", "the last validation is younger than the last extraction")
        else:
            step, code = self._node("validate", s.validate, "validate")
            if not step.code and code == BREACHED:  # findings about the data don't fail a run, a breached gate does
                step.status, step.code = "failed", BREACHED
            if step.code:
                return
        if self._node("load", s.load)[0].code:
            return
        step, broken = self._node("build", s.build, code=BREACHED)
        if not step.code and broken:
            step.status, step.code, step.detail = "failed", BREACHED, json.dumps(broken, sort_keys=True)
