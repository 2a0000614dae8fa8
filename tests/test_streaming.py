"""Streams against the same operators over all rows at once, with a restart and with late rows."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import transitions
from tideline.operators.layout import Axis
from tideline.streaming import run_ids, windows

SCHEMA = "ts timestamp, event_type string, regime string, id long"
AXIS = Axis(entity="event_type", time="ts").bounded()


def events(n=240, seed=6):
    rng = random.Random(seed)
    at = datetime.datetime(2024, 1, 1)
    out = []
    for i in range(n):
        at += datetime.timedelta(minutes=rng.randrange(1, 90))
        out.append((at, rng.choice("abc"), rng.choice(["Bull", "Calm"]), i))
    return out


class Feed:
    """A folder of files read one per micro-batch, in the order they were added."""

    def __init__(self, spark, folder):
        self.spark, self.folder = spark, str(folder)

    def add(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")

    def read(self):
        return self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/in")

    def drain(self, df):
        windows.bring_in(df, f"{self.folder}/out", f"{self.folder}/checkpoint")

    def out(self):
        return self.spark.read.parquet(f"{self.folder}/out")


@pytest.fixture
def feed(spark, tmp_path):
    before = {k: spark.conf.get(k, None) for k in run_ids.STATE_STORE}
    for k, v in run_ids.STATE_STORE.items():
        spark.conf.set(k, v)
    yield Feed(spark, tmp_path)
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_run_ids_equal_the_batch_result_across_a_restart(spark, feed):
    rows = events()
    for part in (rows[:50], rows[50:130]):
        random.Random(1).shuffle(part)
        feed.add(part)
        feed.drain(run_ids.stream_run_ids(feed.read(), "event_type", "ts"))
    feed.add(rows[130:])
    feed.drain(run_ids.stream_run_ids(feed.read(), "event_type", "ts"))
    columns = ["id", "regime_prev", "is_transition", "transition", "regime_group_id"]
    whole = transitions.with_run_ids(spark.createDataFrame(rows, SCHEMA), AXIS)
    assert sorted(map(tuple, feed.out().select(columns).collect())) == sorted(map(tuple, whole.select(columns).collect()))
    assert feed.out().where("late").count() == 0


def test_late_rows_are_told_apart(spark, feed):
    rows = [r for r in events() if r[1] == "a"]
    feed.add(rows[5:10])
    feed.drain(run_ids.stream_run_ids(feed.read(), "event_type", "ts"))
    feed.add(rows[:5] + rows[10:12] + [(None, "a", "Bull", -1)])
    feed.drain(run_ids.stream_run_ids(feed.read(), "event_type", "ts"))
    out = feed.out()
    late = out.where("late").collect()
    assert sorted(r.id for r in late) == [r[3] for r in rows[:5]] and all(r.regime_group_id is None for r in late)
    assert out.where("NOT late").count() == 7


@pytest.mark.parametrize("slide", [None, "3 hours"])
def test_breadth_windows_equal_batch_for_rows_in_time(spark, feed, slide):
    rows = events()
    last = (rows[-1][0] + datetime.timedelta(days=30), "a", "Bull", -5)  # closes all windows before it
    too_late = (rows[0][0], "z", "Bull", -6)
    for part in (rows[:100], rows[100:], [last], [too_late]):
        feed.add(part)
        feed.drain(windows.breadth_per_window(feed.read(), "6 hours", slide, "2 hours", "event_type", "ts"))
    whole = windows.breadth_per_window(spark.createDataFrame(rows, SCHEMA), "6 hours", slide, "2 hours", "event_type", "ts")
    assert sorted(map(tuple, feed.out().collect())) == sorted(map(tuple, whole.collect()))


def test_sessions_equal_batch(spark, feed):
    rows = events()
    for part in (rows[:100], rows[100:], [(rows[-1][0] + datetime.timedelta(days=30), "a", "Bull", -5)]):
        feed.add(part)
        feed.drain(windows.sessions(feed.read(), "1 hour", "2 hours", "event_type", "ts"))
    whole = windows.sessions(spark.createDataFrame(rows, SCHEMA), "1 hour", entity="event_type", time="ts")
    assert sorted(map(tuple, feed.out().collect())) == sorted(map(tuple, whole.collect()))
    assert whole.agg(F.sum("rows")).first()[0] == len(rows)
