import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from snapweave.operators.intervals import backfill_first, collapse_changes, recollapse
from snapweave.operators.skew import split_hot


def day(text):
    return dt.date.fromisoformat(text)


D1, D2, D3, D4 = "2019-02-10", "2019-05-10", "2020-11-10", "2021-01-10"
SCHEMA = "tin string, day string, a string, b string, note string"


def snapshots(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("day", F.col("day").cast("date"))


def collapsed(df, rows, **options):
    out = collapse_changes(df, "tin", "day", ["a", "b"], **options)
    return rows(out, "tin", "a", "b", F.col("start_date").cast("string"), F.col("end_date").cast("string"))


def test_change_kinds(spark, rows):
    df = snapshots(spark, [
        ("same", D1, "x", None, None), ("same", D2, "x", None, None), ("same", D3, "x", None, None),
        ("once", D1, "x", "1", None), ("once", D2, "x", "2", None), ("once", D3, "x", "2", None),
        ("back", D1, "x", "1", None), ("back", D2, "y", "1", None), ("back", D3, "x", "1", None),
        ("both", D1, "x", "1", None), ("both", D2, "y", "2", None),
        ("swap", D1, "x", None, None), ("swap", D2, None, "x", None),
        ("lone", D2, None, None, None),
        ("gap", D1, "x", None, None), ("gap", D4, "x", None, None),
    ])
    assert collapsed(df, rows) == sorted([
        ("same", "x", None, D1, D3),
        ("once", "x", "1", D1, D2), ("once", "x", "2", D2, D3),
        ("back", "x", "1", D1, D2), ("back", "y", "1", D2, D3), ("back", "x", "1", D3, D3),
        ("both", "x", "1", D1, D2), ("both", "y", "2", D2, D2),
        ("swap", "x", None, D1, D2), ("swap", None, "x", D2, D2),
        ("lone", None, None, D2, D2),
        ("gap", "x", None, D1, D4),
    ], key=repr)


def test_null_key_is_an_entity(spark, rows):
    df = snapshots(spark, [(None, D1, "x", None, None), (None, D2, "y", None, None)])
    assert len(collapsed(df, rows)) == 2
    assert len(collapsed(df, rows, hot_rows=1)) == 2


def test_backfill_is_not_a_change(spark, rows):
    df = snapshots(spark, [
        ("t", D1, "x", None, None), ("t", D2, "x", None, "n1"), ("t", D3, "y", None, None),
    ])
    out = collapse_changes(df, "tin", "day", ["a", "b"], backfill=["note"])
    assert rows(out, "a", "note") == [("x", "n1"), ("y", None)]


def random_snapshots(spark, seed, copies=True):
    rng = random.Random(seed)
    data = []
    for key in [None, "a", "b", "c"]:
        for _ in range(rng.choice([1, 5, 60, 120])):
            row = (
                key,
                str(dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(50))),
                rng.choice([None, "x", "y"]),
                rng.choice([None, "1"]),
                rng.choice([None, None, None, "n1", "n2"]),
            )
            data += [row] * (rng.choice([1, 1, 4]) if copies else 1)
    rng.shuffle(data)
    return snapshots(spark, data)


@pytest.mark.parametrize("seed", range(4))
def test_hot_keys_give_the_same(spark, rows, seed):
    df = random_snapshots(spark, seed)
    plain = collapse_changes(df, "tin", "day", ["a", "b"], backfill=["note"], hot_rows=None)
    for limit in (1, 7, 40):
        split = collapse_changes(df, "tin", "day", ["a", "b"], backfill=["note"], hot_rows=limit)
        assert rows(split) == rows(plain)


@pytest.mark.parametrize("seed", range(3))
def test_hot_recollapse_gives_the_same(spark, rows, seed):
    df = random_snapshots(spark, seed, copies=False).dropDuplicates(["tin", "day"])
    intervals = collapse_changes(df, "tin", "day", ["a", "b"], hot_rows=None)
    plain = recollapse(intervals, "tin", "start_date", "end_date", ["a"], hot_rows=None)
    assert rows(recollapse(intervals, "tin", "start_date", "end_date", ["a"], hot_rows=5)) == rows(plain)


@pytest.mark.parametrize("seed", range(3))
def test_hot_backfill_gives_the_same(spark, rows, seed):
    df = random_snapshots(spark, seed)
    plain = backfill_first(df, "note", "tin", "day", hot_rows=None)
    assert rows(backfill_first(df, "note", "tin", "day", hot_rows=6)) == rows(plain)
    assert plain.count() == df.count()


def test_hot_keys_are_found_exactly(spark):
    df = spark.range(100).select(F.when(F.col("id") < 40, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    cold, hot, n = split_hot(df, ["k"], 10)
    assert (cold.count(), hot.count(), n) == (60, 40, 40)
    assert hot.select("__k").distinct().count() == 1


def test_more_hot_keys_than_can_be_listed(spark, rows, monkeypatch):
    monkeypatch.setattr("snapweave.operators.skew._MAX_LISTED_KEYS", 1)
    df = random_snapshots(spark, 2)
    plain = collapse_changes(df, "tin", "day", ["a", "b"], backfill=["note"], hot_rows=None)
    assert rows(collapse_changes(df, "tin", "day", ["a", "b"], backfill=["note"], hot_rows=3)) == rows(plain)


def test_hot_keys_are_found_from_a_share_of_rows(spark, monkeypatch):
    monkeypatch.setattr("snapweave.operators.skew._COUNTED_ROWS", 2_000)
    df = spark.range(100_000).select(
        F.when(F.col("id") < 40_000, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    cold, hot, n = split_hot(df, ["k"], 20_000)
    assert (cold.count(), hot.count()) == (60_000, 40_000)
    assert 30_000 < n < 50_000


def test_hot_key_is_spread_over_tasks(spark):
    from snapweave.operators.skew import segment

    df = spark.range(1000).withColumn("k", F.lit("one"))
    _, hot, n = split_hot(df, ["k"], 100)
    sizes = [r["count"] for r in segment(hot, ["id"], n, 100).groupBy("__seg").count().collect()]
    assert sum(sizes) == 1000 and len(sizes) >= 8 and max(sizes) < 300


def test_recollapse_keeps_last_end(spark, rows):
    df = spark.createDataFrame(
        [("t", 1, 3, "x"), ("t", 3, 5, "x"), ("t", 5, 9, "y"), ("u", 2, 2, None)],
        "tin string, s int, e int, a string",
    )
    assert rows(recollapse(df, "tin", "s", "e", ["a"])) == [
        ("t", 1, 5, "x"), ("t", 5, 9, "y"), ("u", 2, 2, None),
    ]
