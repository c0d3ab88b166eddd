"""Leases of tasks as keyed state: what a queue keeps about its messages, folded from a stream of events.

Events: task, kind, worker, at, seconds. publish makes a task ready; take leases a ready one for some seconds; renew moves the deadline of the
worker's own lease; done ends it; cancel gives it back at once. A lease whose deadline passes, by a later event of its task or by
the watermark, is given up, and the task is ready again. The state is under the query's checkpoint, so a restart changes nothing.

Results: task, state, worker, deadline, delivery (how often it was taken), at. state is ready, leased, renewed, done, again (given back or
run out) or refused (of an event that its worker had no right to: taken by another, lease lost, unknown). Events of a batch
count in the order of at; ends before takes of the same moment. Repeats of publish change nothing until the task is done.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

EVENT = "task string, kind string, worker string, at timestamp, seconds double"
RESULT = "task string, state string, worker string, deadline timestamp, delivery int, at timestamp"
STATE = "worker string, deadline double, delivery int"  # no worker: ready
RANK = {"publish": 0, "renew": 1, "done": 2, "cancel": 3, "take": 4}


class Lease:
    """One task's state: None before it is published and after it is done."""

    def __init__(self, worker: str | None, deadline: float, delivery: int, known: bool):
        self.worker, self.deadline, self.delivery, self.known = worker, deadline, delivery, known

    def expire(self, now: float) -> bool:
        """Gives the lease up if its deadline is not after now."""
        if self.known and self.worker is not None and self.deadline <= now:
            self.worker = None
            return True
        return False

    def apply(self, kind: str, worker: str | None, at: float, seconds: float) -> str | None:
        """What an event makes of it; None for nothing."""
        own = self.known and self.worker is not None and self.worker == worker
        if kind == "publish":
            if self.known:
                return None
            self.worker, self.deadline, self.delivery, self.known = None, 0.0, 0, True
            return "ready"
        if kind == "take" and self.known and self.worker is None and worker is not None:
            self.worker, self.deadline, self.delivery = worker, at + seconds, self.delivery + 1
            return "leased"
        if kind == "renew" and own:
            self.deadline = max(self.deadline, at + seconds)
            return "renewed"
        if kind == "done" and own:
            self.known = False
            return "done"
        if kind == "cancel" and own:
            self.worker = None
            return "again"
        return "refused"


def _fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    task = key[0]
    lease = Lease(*state.get, True) if state.exists else Lease(None, 0.0, 0, False)
    out = []
    moment = lambda t: pd.Timestamp(t, unit="s") if t else pd.NaT

    def say(what: str, worker: str | None, at: float) -> None:
        out.append((task, what, worker, moment(lease.deadline if what in ("leased", "renewed") else 0.0), lease.delivery, moment(at)))

    def run_out(now: float) -> None:
        worker, deadline = lease.worker, lease.deadline
        if lease.expire(now):
            say("again", worker, deadline)

    if state.hasTimedOut:
        run_out(state.getCurrentWatermarkMs() / 1000)
    rows = [r for b in batches for r in zip(b["at"].map(lambda t: t.timestamp()), b["kind"], b["worker"], b["seconds"].fillna(0.0), strict=True)]
    for at, kind, worker, seconds in sorted(rows, key=lambda r: (r[0], RANK.get(r[1], 9), str(r[2]))):
        run_out(at)
        if (what := lease.apply(kind, worker, at, seconds)) is not None:
            say(what, worker, at)
    if lease.known:
        state.update((lease.worker, lease.deadline, lease.delivery))
        if lease.worker is not None:
            state.setTimeoutTimestamp(max(int(lease.deadline * 1000), state.getCurrentWatermarkMs() + 1))
    elif state.exists:
        state.remove()
    if out:
        yield pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")]).astype({"delivery": "int32"})


def leases(events: DataFrame, late: str = "0 seconds") -> DataFrame:
    """The results of a stream of events, in append mode; events later than late behind the newest are left out."""
    keyed = events.where(F.col("task").isNotNull() & F.col("at").isNotNull()).withWatermark("at", late).groupBy("task")
    return keyed.applyInPandasWithState(_fold, RESULT, STATE, "append", GroupStateTimeout.EventTimeTimeout)


def held(results: DataFrame) -> DataFrame:
    """The leases that stand: each task's last word, where that is leased or renewed."""
    order = F.struct("at", F.when(F.col("state").isin("leased", "renewed"), 1).otherwise(0))
    last = results.where("state <> 'refused'").groupBy("task").agg(F.max_by(F.struct("state", "worker", "deadline", "delivery"), order).alias("last"))
    return last.select("task", "last.*").where(F.col("state").isin("leased", "renewed"))


def renewals(standing: DataFrame, now: datetime | Column, margin: float, seconds: float) -> DataFrame:
    """renew events for the leases that have less than margin seconds left, as a worker's heartbeat sends them."""
    at = F.lit(now) if isinstance(now, datetime) else now
    left = F.col("deadline").cast("double") - at.cast("double")
    return standing.where((left > 0) & (left < margin)).select("task", F.lit("renew").alias("kind"), "worker", at.alias("at"), F.lit(float(seconds)).alias("seconds"))
