import json
from datetime import datetime

import pytest

from lonja import schemas
from lonja.sources import Lake, text_events
from lonja.sources.feeds import KAFKA_DEFAULTS, read_event_files
from lonja.streaming import LiveSinks, activity, parse_events, start, stock_alerts

NAMES = schemas.field_names(schemas.EVENT)


def line(event_id, kind="stock_low", ts="2024-05-01T10:00:00.123456+00:00", **fields):
    return json.dumps({"event_id": event_id, "event_type": kind, "ts": ts, "session_id": "s1", **fields})


def test_parse_drops_broken_records_and_keeps_the_origin(rows):
    records = rows(
        "value BINARY, topic STRING, partition INT, offset BIGINT",
        (line("a", stock_actual=3).encode(), "t", 0, 10),
        (b"{bad", "t", 0, 11),
        (json.dumps({"event_type": "stock_low"}).encode(), "t", 1, 12),
        (None, "t", 1, 13),
    )
    events = parse_events(records)
    assert events.columns == [*NAMES, "kafka_topic", "kafka_partition", "kafka_offset"]
    only = events.collect()
    assert len(only) == 1 and only[0].ts == datetime(2024, 5, 1, 10, 0, 0, 123456) and only[0].kafka_offset == 10


def test_values_are_parsed_once(rows, plan):
    text = plan(parse_events(rows("value STRING", line("a")).repartition(2)))
    assert text.count("from_json") == 1


@pytest.mark.parametrize(
    "stock, severity", [(-1, "agotado"), (0, "agotado"), (1, "critico"), (2, "critico"), (3, "bajo"), (9, "bajo"), (None, "bajo")]
)
def test_severity(rows, stock, severity):
    alerts = stock_alerts(parse_events(rows("value STRING", line("a", stock_actual=stock), line("b", "order_placed"))))
    assert [(row.severidad, row.umbral) for row in alerts.collect()] == [(severity, 5)]


def test_activity(rows):
    events = parse_events(rows("value STRING", line("a"), line("b"), line("c", "order_placed")))
    assert {(row.event_type, row.eventos, row.sesiones) for row in activity(events).collect()} == {
        ("stock_low", 2, 1), ("order_placed", 1, 1),
    }


@pytest.fixture
def feed(tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    (folder / "1.txt").write_text("\n".join([line("a", stock_actual=0), "{bad", line("b", "order_placed", cantidad=2)]))
    (folder / "2.txt").write_text("\n".join([line("c", stock_actual=9), line("b", "order_placed", cantidad=2)]))
    return folder


def gold(spark, lake, name):
    return spark.read.parquet(lake.gold(name))


def test_stream_writes_all_sinks_and_goes_on_from_its_checkpoint(spark, feed, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    sinks = LiveSinks(lake)
    start(text_events(spark, str(feed), files_per_trigger=1), sinks, every=None).awaitTermination()
    assert gold(spark, lake, "gold_alertas").count() == 2
    assert {(row.lote, row.event_type, row.eventos) for row in gold(spark, lake, "gold_actividad_stream").collect()} == {
        (0, "stock_low", 1), (0, "order_placed", 1), (1, "stock_low", 1), (1, "order_placed", 1),
    }
    (feed / "3.txt").write_text(line("d"))
    start(text_events(spark, str(feed)), sinks, every=None).awaitTermination()
    assert gold(spark, lake, "gold_alertas").count() == 3
    copy = read_event_files(spark, [lake.bronze("eventos_web", "stream")])
    assert sorted(row.event_id for row in copy.collect()) == ["a", "b", "b", "c", "d"]
    assert {row.ts for row in copy.select("ts").distinct().collect()} == {"2024-05-01T10:00:00.123456Z"}


def test_a_replayed_batch_changes_nothing(spark, rows, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    sinks = LiveSinks(lake)
    batch = parse_events(rows("value STRING", line("a", stock_actual=1), line("b", "order_placed")))
    for batch_id in (0, 1, 1, 0):
        sinks.write(batch, batch_id)
    assert gold(spark, lake, "gold_alertas").count() == 2
    assert gold(spark, lake, "gold_actividad_stream").count() == 4
    assert read_event_files(spark, [lake.bronze("eventos_web", "stream")]).count() == 4
    LiveSinks(lake, stream="second").write(batch, 0)
    assert gold(spark, lake, "gold_alertas").count() == 3


def test_an_empty_batch_writes_nothing(spark, rows, tmp_path):
    lake = Lake(str(tmp_path / "lake"))
    LiveSinks(lake).write(parse_events(rows("value STRING", "{bad")), 0)
    assert not (tmp_path / "lake").exists()


def test_topic_defaults():
    assert KAFKA_DEFAULTS["startingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in KAFKA_DEFAULTS
