from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import cells
from scoreloom.operators.lookup import one_name_per_item
from scoreloom.schemas import CELLS, HOT_ITEMS, RAW_EVENT_CELLS
from scoreloom.session import work_path
from scoreloom.sinks import writers
from scoreloom.sources import events as sources
from scoreloom.streaming import hot_items as hot
from scoreloom.streaming import monitor, raw_events
from tests.conftest import rows

ALL_NOW = {"availableNow": True}


def event(user, item, rating, time):
    text = "null" if time is None else f'"{time}"'
    return f'{{"userId":{user},"movieId":{item},"rating":{rating},"timestamp":1,"createTime":{text}}}'


FIRST = [
    event(1, 1, 4.0, "2025-12-08 12:00:00"),   # on a window boundary
    event(2, 2, 5.0, "2025-12-08 12:09:59"),   # another item of the same name
    event(3, 7, 3.0, "2025-12-08 12:01:00"),   # unknown item
    event(4, "null", 2.0, "2025-12-08 12:02:00"),
    event(5, 1, 1.0, "2025-12-08 12:10:00"),
    event(6, 1, 1.0, None),
    event(7, 1, 1.0, "8.12.2025"),
    "not json",
    event(8, 3, '"high"', "2025-12-08 12:11:00"),  # wrong type: rating unknown
]
LATE = [event(9, 1, 5.0, "2025-12-08 11:00:00"), event(9, 1, 5.0, "2025-12-08 12:15:00")]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, "Twin"), (2, "Twin"), (3, "Solo")], "item_id int, title string"
    )


def messages(spark, lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def test_parse_events(spark):
    got = rows(hot.parse_events(messages(spark, FIRST)))
    assert got[0][:5] == (1, 1, 4.0, 1, "2025-12-08 12:00:00")
    assert str(got[0][5]) == "2025-12-08 12:00:00"
    assert got[6][4:] == ("8.12.2025", None)
    assert got[7] == (None,) * 6
    assert got[8][:3] == (8, 3, None)


EXPECTED = [
    ("2025-12-08 12:10:00", "2025-12-08 12:20:00", "Solo", 1, None),
    ("2025-12-08 12:10:00", "2025-12-08 12:20:00", "Twin", 1, 1.0),
    ("2025-12-08 12:00:00", "2025-12-08 12:10:00", "Twin", 2, 4.5),
    ("2025-12-08 12:00:00", "2025-12-08 12:10:00", "未知", 2, 2.5),
]


def test_window_counts(spark, items):
    events = hot.parse_events(messages(spark, FIRST))
    names = one_name_per_item(items)
    for options in ({}, {"count_before_lookup": True}, {"salts": 3}):
        counts = hot.window_counts(events, names, **options)
        assert rows(hot.newest_top(counts)) == EXPECTED
    other = hot.window_counts(events, names, default="?")
    assert {r["name"] for r in other.collect()} == {"Twin", "Solo", "?"}


def test_the_limit_is_over_all_windows(spark, items):
    events = hot.parse_events(messages(spark, FIRST))
    top = hot.hot_items(events, one_name_per_item(items), n=3)
    assert [tuple(r[:5]) for r in top.collect()] == EXPECTED[:3]
    assert top.first()["update_time"][4] == "-"
    assert [f.name for f in HOT_ITEMS.fields] == top.columns
    assert top.schema.simpleString() == HOT_ITEMS.simpleString()


def test_sliding_windows_count_an_event_twice(spark, items):
    events = hot.parse_events(messages(spark, FIRST[:1]))
    trend = hot.rating_trend(events, one_name_per_item(items))
    assert sorted(r["start_time"] for r in trend.collect()) == [
        "2025-12-08 11:55:00", "2025-12-08 12:00:00"
    ]


def run_once(spark, items, folder, snapshot, checkpoint, **options):
    stream = hot.parse_events(sources.text_directory(spark, folder))
    hot.run_hot_items(
        stream, one_name_per_item(items), writers.parquet_snapshot(snapshot), checkpoint, ALL_NOW, **options
    ).awaitTermination()
    return writers.read_snapshot(spark, snapshot, HOT_ITEMS)


@pytest.mark.parametrize("salts", [1, 3])
def test_stream_equals_batch_and_resumes_from_its_checkpoint(spark, items, salts):
    folder, snapshot, checkpoint = (work_path(spark, x) for x in ("in", "out", "state"))
    names = one_name_per_item(items)
    writers.write_lines(messages(spark, FIRST), folder)
    got = rows(run_once(spark, items, folder, snapshot, checkpoint, salts=salts).drop("update_time"))
    assert sorted(got, key=repr) == sorted(EXPECTED, key=repr)

    writers.write_lines(messages(spark, LATE), folder)
    stored = run_once(spark, items, folder, snapshot, checkpoint, salts=salts)
    batch = hot.hot_items(hot.parse_events(messages(spark, FIRST + LATE)), names)
    got, want = (sorted(rows(d.drop("update_time")), key=repr) for d in (stored, batch))
    assert got == want
    # The late event still opened its old window.
    assert ("2025-12-08 11:00:00", "2025-12-08 11:10:00", "Twin", 1, 5.0) in got


def test_streams_cannot_count_before_the_lookup(spark, items):
    folder = work_path(spark, "in")
    writers.write_lines(messages(spark, FIRST), folder)
    stream = hot.parse_events(sources.text_directory(spark, folder))
    with pytest.raises(ValueError):
        hot.window_counts(stream, one_name_per_item(items), count_before_lookup=True)


def test_watermark_writes_each_closed_window_once(spark, items):
    folder, path, checkpoint = (work_path(spark, x) for x in ("in", "windows", "state"))
    times = ["12:00:00", "12:10:00", "12:31:00"]

    def run(lines):
        writers.write_lines(messages(spark, lines), folder)
        stream = hot.parse_events(sources.text_directory(spark, folder))
        hot.run_window_counts(
            stream, one_name_per_item(items), path, checkpoint, trigger=ALL_NOW
        ).awaitTermination()
        read = spark.read.schema("start_time string, count bigint").parquet(path)
        return sorted(rows(read.select("start_time", "count")))

    first = run([event(1, 1, 4.0, f"2025-12-08 {t}") for t in times])
    assert first == [("2025-12-08 12:00:00", 1), ("2025-12-08 12:10:00", 1)]
    # An event of a closed window is late and dropped; the open window goes on.
    late = [event(1, 1, 4.0, "2025-12-08 12:05:00"), event(1, 1, 4.0, "2025-12-08 13:00:00")]
    assert run(late) == [*first, ("2025-12-08 12:30:00", 1)]


def test_read_back(spark):
    stored = spark.createDataFrame(
        [("2025-01-01 00:00:00", "e", "a", "x", "bad", "u"), (None, "e", "b", "9", "1.5", "u"),
         ("2025-01-01 00:00:00", "e", "c", "3", None, "u"),
         ("2025-01-01 00:10:00", "e", "d", "1", "2.0", "u")],
        "start_time string, end_time string, name string, count string, avg_rating string, "
        "update_time string",
    )
    got = rows(hot.read_hot_items(stored).select("name", "count", "avg_rating"))
    assert got == [("d", 1, 2.0), ("c", 3, 0.0), ("a", 0, 0.0), ("b", 9, 1.5)]
    assert len(rows(hot.read_hot_items(stored, 2))) == 2


def test_monitor_counts_only_batches_with_rows(spark):
    folder, path, checkpoint = (work_path(spark, x) for x in ("in", "counts", "state"))
    for part in (["1,1,4.0,5", "1,2,3.0,6"], ["2,1,1.5,7"]):
        writers.write_lines(messages(spark, part).coalesce(1), folder)
    stream = sources.rating_directory(spark, folder, max_files_per_trigger=1)
    monitor.run_monitor(stream, path, checkpoint, ALL_NOW).awaitTermination()
    assert sorted(n for _, n in rows(monitor.read_counts(spark, path))) == [1, 2]
    # Nothing new arrives: nothing is added.
    monitor.run_monitor(stream, path, checkpoint, ALL_NOW).awaitTermination()
    assert monitor.read_counts(spark, path).count() == 2


def test_raw_events_keep_the_last_event_of_an_item(spark):
    folder, path, checkpoint = (work_path(spark, x) for x in ("in", "raw", "state"))
    writers.write_lines(messages(spark, FIRST + LATE), folder)
    stream = hot.parse_events(sources.text_directory(spark, folder))
    raw_events.run_raw_events(
        stream, path, checkpoint, ALL_NOW, written_at=F.timestamp_seconds(F.lit(7))
    ).awaitTermination()
    stored = spark.read.schema(CELLS).parquet(path)
    assert {tuple(r) for r in cells.wide(stored, RAW_EVENT_CELLS).where("row_key = '1'").collect()} == {
        ("1", "9", "1", "5.0", "7000")
    }
    assert not stored.where("row_key is null").count()
    now = raw_events.event_cells(hot.parse_events(messages(spark, FIRST[:1])))
    written = now.where("qualifier = 'timestamp'").select(
        (F.unix_millis(F.current_timestamp()) - F.col("value").cast("bigint")).alias("age")
    )
    assert 0 <= written.first()["age"] < 60_000


def test_kafka_options():
    bounded = sources.kafka_options("host:9092", "ratings", "earliest", 500)
    assert bounded["startingOffsets"] == "earliest" and bounded["maxOffsetsPerTrigger"] == "500"
    assert sources.kafka_options("host:9092", "ratings") == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "ratings",
        "startingOffsets": "latest",
    }


def test_kafka_messages_are_parsed_from_bytes(spark):
    raw = messages(spark, FIRST[:1]).withColumn("value", F.encode("value", "utf-8"))
    assert rows(hot.parse_events(raw))[0][:3] == (1, 1, 4.0)
