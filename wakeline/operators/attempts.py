"""The life of a source over its attempts: validated ones are skipped, failures use up retries, what was left is archived.

A source is at rest with so many failures, with or without partial files of an attempt that ended badly, or it is
validated or blocked for good. Its attempts are folded in order, a source with very many by ranges (see ranges.fold).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.operators import ranges, rules

_SYMBOLS = {"complete": 0, "interrupted": 1, "blocked": 2}
_FAILURE = 3


def machine(limit: int) -> list[list[int]]:
    """Next state by symbol and state. States: failures so far (0 to limit), the same with partial files, validated, blocked."""
    n = limit + 1
    validated, blocked = 2 * n, 2 * n + 1
    steps = []
    for symbol in range(4):
        row = []
        for state in range(2 * n + 2):
            failures = state % n
            if state >= validated:
                row.append(state)
            elif failures >= limit or symbol == _SYMBOLS["blocked"]:
                row.append(blocked)
            elif symbol == _SYMBOLS["complete"]:
                row.append(validated)
            else:
                row.append(n + failures + (symbol == _FAILURE))
        steps.append(row)
    return steps


def _symbol(state: Column) -> Column:
    out = F.lit(_FAILURE)
    for name, k in _SYMBOLS.items():
        out = F.when(state == name, k).otherwise(out)
    return out


def replayed(attempts: DataFrame, key: str, order: list[str], limit: int = 3) -> DataFrame:
    """attempts (key, order, code: the worker's exit code) with action, archived, ledger, failures and phase.

    action: skip (validated before), blocked (no retry left, or stopped before; nothing is started again) or run. archived:
    partial files of the attempt before are moved away first. ledger: the state written for a run, else null. failures: so
    far, this one included; null once validated or blocked. phase, after the attempt: open, validated or blocked.
    """
    if limit < 1:
        raise ValueError("at least one failure must be allowed")
    n, state = limit + 1, F.col("_state")
    done = rules.exit_state(F.col("code"))
    steps = machine(limit)
    rows = ranges.fold(attempts.withColumn("_symbol", _symbol(done)), [key], order, "_symbol", steps, name="_state")
    runs = (state < 2 * n) & (state % n < limit)
    action = F.when(state == 2 * n, "skip").when(runs, "run").otherwise("blocked")
    after = F.get(F.get(F.array(*(F.array(*map(F.lit, row)) for row in steps)), F.col("_symbol")), state)
    phase = F.when(F.col("_after") == 2 * n, "validated").when(F.col("_after") > 2 * n, "blocked").otherwise("open")
    rows = rows.withColumns({"action": action, "archived": runs & (state >= n), "ledger": F.when(runs, done), "_after": after})
    return rows.withColumns({"failures": F.when(F.col("_after") < 2 * n, F.col("_after") % n), "phase": phase}).drop("_symbol", "_state", "_after")
