"""The retry plan of `operators.retries`, kept up to date while responses arrive."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.operators.retries import RETRIES, STATES

PLAN = "state STRING, attempts BIGINT, first_at TIMESTAMP, last_at TIMESTAMP, next_due TIMESTAMP"


class Retries:
    """Per request: the last response that was no 429, the 429s after it, and a timer for the next try.

    The state is a text: `end` (time, tie, action) and `open`, a list of (time, tie, wait), with times in
    microseconds. Responses may arrive in any order: one that is older than what is known changes the
    plan as it would have in its time. When the timer fires, the plan is given once more, as `due`.
    """

    def __init__(self, by: list[str], at: str, tie: str, max_attempts: int):
        self.by, self.at, self.tie, self.max_attempts = by, at, tie, max_attempts

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = json.loads(state.get[0]) if state.exists else {"end": None, "open": []}
        end, attempts = known["end"], known["open"]
        if state.hasTimedOut:
            yield self._frame(key, {**self._plan(end, attempts), "state": "due"})
            return
        for frame in frames:
            for at, tie, action, wait in frame[[self.at, self.tie, "action", "wait_s"]].itertuples(index=False):
                if pd.isna(at):
                    continue
                at = pd.Timestamp(at).value // 1000
                if action in RETRIES:
                    attempts.append([at, tie, int(wait)])
                elif end is None or [at, tie] > end[:2]:
                    end = [at, tie, action]
        if end is None and not attempts:
            return
        attempts = sorted(a for a in attempts if end is None or a[:2] > end[:2])
        state.update((json.dumps({"end": end, "open": attempts}),))
        plan = self._plan(end, attempts)
        if plan["next_due"] is not None:
            wait = plan["next_due"] // 1000 - state.getCurrentProcessingTimeMs()
            state.setTimeoutDuration(max(wait, 1))
        yield self._frame(key, plan)

    def _plan(self, end: list | None, attempts: list) -> dict:
        if not attempts:
            return {"state": STATES.get(end[2]), "attempts": 0, "first_at": None, "last_at": end[0], "next_due": None}
        waiting, last = len(attempts) < self.max_attempts, attempts[-1]
        return {
            "state": "waiting" if waiting else "given_up",
            "attempts": len(attempts),
            "first_at": attempts[0][0],
            "last_at": last[0],
            "next_due": last[0] + last[2] * 1_000_000 if waiting else None,
        }

    def _frame(self, key: tuple, plan: dict) -> pd.DataFrame:
        frame = pd.DataFrame([{**dict(zip(self.by, key)), **plan}])
        for column in ("first_at", "last_at", "next_due"):
            frame[column] = pd.to_datetime(frame[column], unit="us")
        return frame


def retry_stream(actions: DataFrame, by: list[str], at: str, tie: str, max_attempts: int) -> DataFrame:
    """(by, state, attempts, first_at, last_at, next_due): a row for each request whose plan changes or falls due.

    `actions` is a stream `with_action`; `tie` is a number or a text. The session's time zone must be
    UTC. The last row of a request that is not `due` is its row of `retry_plan`. Requests with a NULL
    among their columns belong together like others.
    """
    types = dict(actions.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in by) + f", {PLAN}"
    retries = Retries(by, at, tie, max_attempts)

    def plan(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        yield from retries(key, frames, state)

    rows = actions.select(*by, at, tie, "action", "wait_s").groupBy(*by)
    return rows.applyInPandasWithState(plan, schema, "known STRING", "update", GroupStateTimeout.ProcessingTimeTimeout)
