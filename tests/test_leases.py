"""Leases as a stream: taking, renewal by margin, giving back, running out, over restarts of the query."""

from datetime import datetime, timedelta

import pytest

from chronocell.streaming import leases

START = datetime(2024, 1, 1)
at = lambda s: START + timedelta(seconds=s)


@pytest.fixture
def queue(spark, tmp_path):
    """run(events): writes them, starts the query anew and gives what it said; all(): everything so far."""
    said = []

    def run(*events):
        rows = [(t, k, w, at(s), float(n)) for t, k, w, s, n in events]
        spark.createDataFrame(rows, leases.EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(leases.EVENT).parquet(str(tmp_path / "in"))
        out = leases.leases(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state"))
        out.outputMode("append").trigger(availableNow=True).start().awaitTermination()
        rows = [(r.task, r.state, r.worker, r.deadline and int((r.deadline - START).total_seconds()), r.delivery, int((r["at"] - START).total_seconds())) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
        new = rows.copy()
        for r in said:
            new.remove(r)
        said.extend(new)
        return sorted(new)

    run.all = lambda: spark.read.parquet(str(tmp_path / "out"))
    return run


def test_leases_over_restarts(queue):
    assert queue(("t1", "publish", None, 0, 0), ("t2", "publish", None, 0, 0), ("t1", "publish", None, 1, 0)) == [("t1", "ready", None, None, 0, 0), ("t2", "ready", None, None, 0, 0)]
    assert queue(("t1", "take", "a", 10, 60), ("t1", "take", "b", 11, 60), ("t3", "take", "a", 12, 60)) == [("t1", "leased", "a", 70, 1, 10), ("t1", "refused", "b", None, 1, 11), ("t3", "refused", "a", None, 0, 12)]
    assert [tuple(r) for r in leases.held(queue.all()).collect()] == [("t1", "leased", "a", at(70), 1)]
    due = leases.renewals(leases.held(queue.all()), at(45), 30, 60)
    assert [tuple(r) for r in due.collect()] == [("t1", "renew", "a", at(45), 60.0)] and leases.renewals(leases.held(queue.all()), at(30), 30, 60).count() == 0
    # the renewed lease outlives its first deadline; another task's event moves the clock past the second
    assert queue(("t1", "renew", "a", 45, 60), ("t1", "renew", "b", 46, 60), ("t2", "take", "b", 90, 1000)) == [("t1", "refused", "b", None, 1, 46), ("t1", "renewed", "a", 105, 1, 45), ("t2", "leased", "b", 1090, 1, 90)]
    assert queue(("t2", "cancel", "b", 200, 0)) == [("t1", "again", "a", None, 1, 105), ("t2", "again", "b", None, 1, 200)]
    assert queue(("t1", "done", "a", 210, 0), ("t1", "take", "c", 220, 50), ("t2", "take", "c", 220, 50)) == [("t1", "leased", "c", 270, 2, 220), ("t1", "refused", "a", None, 1, 210), ("t2", "leased", "c", 270, 2, 220)]
    assert queue(("t1", "done", "c", 230, 0), ("t1", "publish", None, 240, 0), ("t2", "done", "c", 280, 0), ("t2", "take", "d", 280, 5)) == [("t1", "done", "c", None, 2, 230), ("t1", "ready", None, None, 0, 240), ("t2", "again", "c", None, 2, 270), ("t2", "leased", "d", 285, 3, 280), ("t2", "refused", "c", None, 2, 280)]


def test_one_lease_at_a_time():
    """Random events: a task is never held by two, and what was taken ends or comes again."""
    import random

    r = random.Random(5)
    lease, holder, now = leases.Lease(None, 0.0, 0, False), None, 0.0
    for _ in range(3000):
        now += r.random()
        kind, worker = r.choice(list(leases.RANK)), r.choice("abc")
        if lease.expire(now):
            assert holder is not None
            holder = None
        said = lease.apply(kind, worker, now, r.random() * 3)
        if said == "leased":
            assert holder is None
            holder = worker
        elif said in ("renewed", "done", "again"):
            assert holder == worker
            holder = worker if said == "renewed" else None
        assert (lease.known and lease.worker) == holder or holder is None
