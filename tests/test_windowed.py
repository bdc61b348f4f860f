"""Windows, events that are sent twice, late events, and sessions that span micro-batches."""

import json

import pytest
from pyspark.sql import functions as F

from lonja.sources import Lake, text_events
from lonja.streaming import LiveSinks, WindowJobs, current_windows, sessions, start


def line(event_id, at, kind="order_placed", session="s1", **fields):
    return json.dumps({"event_id": event_id, "event_type": kind, "ts": f"2024-05-01T{at}Z", "session_id": session, **fields})


@pytest.fixture
def run(spark, tmp_path):
    """Works off files of lines one after the other, each in a micro-batch of its own, and gives the windows."""
    jobs, feed = WindowJobs(Lake(str(tmp_path / "lake")), window="1 hour", late="2 hours"), tmp_path / "feed"
    feed.mkdir()
    files = iter(range(1000))

    def work(*batches):
        for lines in batches:
            (feed / f"{next(files):03d}.txt").write_text("\n".join(lines))
            jobs.start_once(text_events(spark, str(feed), 1), None).awaitTermination()
            jobs.start_windows(spark, None).awaitTermination()
        rows = current_windows(spark.read.parquet(jobs.windows)).collect()
        return {(r.desde.hour, r.event_type): (r.eventos, r.unidades) for r in rows}

    work.jobs = jobs
    return work


def test_an_event_that_is_sent_twice_counts_once(run):
    first = [line("a", "10:00:00", cantidad=2), line("b", "10:30:00", cantidad=1), line("c", "11:00:00", kind=" ORDER_placed ")]
    again = [line("a", "10:00:02", cantidad=2), line("d", "10:59:59"), line("d", "10:59:59")]
    assert run(first, again) == {(10, "order_placed"): (3, 3), (11, "order_placed"): (1, None)}


def test_late_events_count_until_their_window_is_closed(run):
    found = run(
        [line("a", "10:00:00")],
        [line("b", "12:30:00")],
        [line("c", "10:50:00")],  # two hours behind the newest are allowed
        [line("d", "15:00:00")],
        [line("e", "15:10:00")],
        [line("f", "10:55:00"), line("g", "13:30:00")],  # one window is closed, one is open
    )
    assert found == {(10, "order_placed"): (2, None), (12, "order_placed"): (1, None), (13, "order_placed"): (1, None), (15, "order_placed"): (2, None)}


def test_events_without_id_or_time_are_left_out(run):
    broken = ["{bad", line("  ", "10:00:00"), line("x", "99:99:99"), json.dumps({"event_type": "order_placed", "ts": "2024-05-01T10:00:00Z"})]
    assert run([*broken, line("a", "10:00:00")]) == {(10, "order_placed"): (1, None)}


def test_sessions_that_span_micro_batches_are_united(spark, tmp_path):
    feed, lake = tmp_path / "feed", Lake(str(tmp_path / "lake"))
    feed.mkdir()
    for batch in range(4):  # half of each batch's sessions are those of the one before
        lines = [line(f"{batch}-{i}", "10:00:00", session=f"s{batch * 500 + i}") for i in range(1000)]
        (feed / f"{batch}.txt").write_text("\n".join(lines))
    start(text_events(spark, str(feed), 1), LiveSinks(lake), every=None).awaitTermination()
    written = spark.read.parquet(lake.gold("gold_actividad_stream"))
    assert written.agg(F.sum("sesiones")).first()[0] == 4000 and written.select("lote").distinct().count() == 4
    assert sessions(written, "event_type").first().sesiones == pytest.approx(2500, rel=0.03)
    assert written.where("lote = 0").first().sesiones == 1000
