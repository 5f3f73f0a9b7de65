"""Dedup by a calendar of deadlines, and letters of a stream."""

import random

import pytest

from sluice.session import work_dir
from sluice.sources import tables
from sluice.streaming.calendar import DeadlineCalendar
from sluice.streaming.latest import PACKED


def packed(spark, rows):
    """Events from (id, seconds, content)."""
    full = [(i, "t", "s", str(at), None, None, text, at * 1_000_000, 0) for i, at, text in rows]
    return spark.createDataFrame(full, PACKED)


def out(df):
    return sorted((r.event_id, r.event_us // 1_000_000, r.payload_text, r.route, r.existing_us and r.existing_us // 1_000_000) for r in df.collect())


def calendar(spark, buffer=10, age=100, emit=True):
    return DeadlineCalendar(spark, work_dir(spark, "calendar"), buffer, age, emit)


def test_newer_events_move_the_deadline_and_older_ones_leave(spark):
    c = calendar(spark)
    assert out(c.step(packed(spark, [("a", 5, "x"), ("a", 3, "y"), ("b", 1, "z")]), 0, 0)) == [("a", 3, "y", "dropped", 5)]
    assert c.pending == 2
    # Newer by less and by more than the state age; an equal one is dropped.
    got = out(c.step(packed(spark, [("a", 6, "n"), ("b", 200, "n"), ("a", 5, "x")]), 1, 5_000))
    assert got == [("a", 5, "x", "dropped", 6), ("a", 5, "x", "superseded", 6), ("b", 1, "z", "expired", 200)]
    assert out(c.flush(2, 10_000)) == [] and c.pending == 2
    assert out(c.flush(3, 15_000)) == [("a", 6, "n", "main", None), ("b", 200, "n", "main", None)]
    # The state is gone, so a later event of the id starts anew, also an older one.
    assert out(c.step(packed(spark, [("a", 1, "o")]), 4, 16_000)) == [] and c.pending == 1


def test_an_equal_time_keeps_the_pending_event(spark):
    c = calendar(spark, emit=False)
    c.step(packed(spark, [("a", 5, "first")]), 0, 0)
    assert out(c.step(packed(spark, [("a", 5, "second"), ("a", 5, "third")]), 1, 1)) == [("a", 5, "second", "dropped", 5), ("a", 5, "third", "dropped", 5)]
    assert out(c.step(packed(spark, [("a", 9, "new")]), 2, 2)) == []
    assert [r[2:4] for r in out(c.flush(3, 60_000))] == [("new", "main")]


@pytest.mark.parametrize("seed", [1, 2])
def test_replayed_and_broken_off_batches_change_nothing(spark, monkeypatch, seed):
    rng = random.Random(seed)
    batches = [[(rng.choice("abcdef"), rng.randrange(300), str(rng.random())) for _ in range(15)] for _ in range(5)]
    plain, odd, got, want = calendar(spark), calendar(spark), [], []
    move = tables.Folders.move
    for n, rows in enumerate(batches):
        want.append(out(plain.step(packed(spark, rows), n, n * 7_000)))
        if rng.random() < 0.6:
            # Lost before the step appears.
            monkeypatch.setattr(tables.Folders, "move", lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                odd.step(packed(spark, rows), n, 10**9)
            monkeypatch.setattr(tables.Folders, "move", move)
        first = out(odd.step(packed(spark, rows), n, n * 7_000))
        # A new process replays the last batch at another time.
        again = DeadlineCalendar(spark, odd.path, 10, 100, True)
        assert out(again.step(packed(spark, rows), n, 10**9)) == first
        got.append(first)
        odd = again
    assert got == want
    kept = [n for n in tables.Folders(spark, odd.path).names(odd.path) if n.startswith("batch_id=")]
    assert kept == ["batch_id=3", "batch_id=4"]
    # Every event leaves once, or waits.
    assert sum(map(len, got)) + odd.pending == 75


def test_plan_has_no_python(spark):
    c = calendar(spark)
    plan = c._routed(packed(spark, [("a", 1, "x")]).selectExpr("*", "CAST(NULL AS bigint) AS deadline_ms"), 0)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and text.count("hashpartitioning") == 1
