"""Calls of a language model over sections of documents, as a boundary: tokens are counted before, texts are never cut, and each
call leaves one row with its cost, whatever came of it. The model itself is a function that is given; without one a call is a dry run.

Calls run where the rows are, one after another in each task; a failed call is a row, not an exception.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from decimal import ROUND_HALF_EVEN, Decimal

import pandas as pd
from pyspark.sql import DataFrame

from ..sources.config import ModelPrices

#: request (system, user, model, max_tokens, effort) -> answer (text, stop_reason, request_id and the four counts of tokens)
Ask = Callable[[Mapping], Mapping]
COUNTS = ("input_tokens", "output_tokens", "cache_creation_input_tokens", "cache_read_input_tokens")
ROW = (
    "call_id string, run_id string, target_section string, model string, effort string, estimated_input_tokens long, input_tokens long, output_tokens long,"
    " cache_creation_input_tokens long, cache_read_input_tokens long, cost_usd string, stop_reason string, request_id string, latency_ms long, error string, data string"
)


def by_length(text: str, per_token: int = 4) -> int:
    """Tokens by the characters of a text, where nothing counts better."""
    return -(-len(text) // per_token)


def cost(model: ModelPrices, counts: Mapping[str, int]) -> Decimal:
    """The price of a call: fresh, written, read and produced tokens, prices per million, six places."""
    n = {k: Decimal(counts.get(k) or 0) for k in COUNTS}
    fresh = n["input_tokens"] + n["cache_creation_input_tokens"] * model.write_factor + n["cache_read_input_tokens"] * model.read_factor
    return ((fresh * model.price_in + n["output_tokens"] * model.price_out) / 1_000_000).quantize(Decimal("0.000001"), ROUND_HALF_EVEN)


def _json_of(text: str) -> str:
    """The JSON of an answer, in a fence or bare, written anew; raises ValueError."""
    inner = text.split("```")[1].removeprefix("json") if text.count("```") >= 2 else text
    return json.dumps(json.loads(inner.strip()), sort_keys=True, ensure_ascii=False)


@dataclass(frozen=True)
class Caller:
    model: ModelPrices
    ceiling: int
    ask: Ask | None = None
    count: Callable[[str], int] = by_length
    system: str = ""
    run_id: str = ""

    def call(self, section: str, instructions: str, excerpt: str) -> dict:
        """One call's row. data is the answer's JSON, null unless the call succeeded."""
        user = f"{instructions}\n\n{excerpt}"
        try:
            n = int(self.count(self.system + user))
        except Exception:  # noqa: BLE001 - a count that fails must not stop a run
            n = by_length(self.system + user)
        row: dict = dict.fromkeys(f.split()[0] for f in ROW.split(", "))
        row |= {"call_id": uuid.uuid4().hex[:16], "run_id": self.run_id, "target_section": section, "model": self.model.id, "effort": self.model.effort, "estimated_input_tokens": n}
        if n > self.ceiling:
            return row | {"error": f"window_exceeds_token_ceiling: {n} > {self.ceiling}"}
        if self.ask is None:
            return row | {"stop_reason": "dry_run", "cost_usd": "0"}
        began = time.monotonic()
        try:
            answer = self.ask({"system": self.system, "user": user, "model": self.model.id, "max_tokens": self.model.max_tokens, "effort": self.model.effort})
        except Exception as e:  # noqa: BLE001 - a failed call is a row
            return row | {"latency_ms": int((time.monotonic() - began) * 1000), "error": f"{type(e).__name__}: {e}"}
        counts = {k: int(answer.get(k) or 0) for k in COUNTS}
        row |= counts | {"latency_ms": int((time.monotonic() - began) * 1000), "stop_reason": answer.get("stop_reason"), "request_id": answer.get("request_id"), "cost_usd": str(cost(self.model, counts))}
        if row["stop_reason"] in ("max_tokens", "refusal"):  # half an answer may parse, so it isn't tried
            return row | {"error": f"stop_reason={row['stop_reason']}"}
        try:
            return row | {"data": _json_of(answer.get("text") or "")}
        except (ValueError, IndexError) as e:
            return row | {"error": f"unparseable_response: {e}"}


def calls(windows: DataFrame, keys: Sequence[str], caller: Caller, section: str = "section", instructions: str = "instructions", excerpt: str = "text") -> DataFrame:
    """keys and one row a window. Write the result before using it: reading it again would call again."""
    names = [f.split()[0] for f in ROW.split(", ")]
    numbers = [f.split()[0] for f in ROW.split(", ") if f.endswith(" long")]

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [caller.call(*(x or "" for x in r)) for r in frame[[section, instructions, excerpt]].itertuples(index=False, name=None)]
            out = pd.DataFrame(rows, columns=names).astype(dict.fromkeys(numbers, "Int64"))
            for i, k in enumerate(keys):
                out.insert(i, k, frame[k].to_numpy())
            yield out

    fields = "".join(f"`{k}` {windows.schema[k].dataType.simpleString()}, " for k in keys)
    return windows.select(*dict.fromkeys([*keys, section, instructions, excerpt])).mapInPandas(work, fields + ROW)
