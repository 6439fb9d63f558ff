"""Merging new snapshots into a state against working everything out again."""

import random

import pytest
from pyspark.sql import functions as F

from snapweave.operators import filters
from snapweave.operators.corrections import latest_per
from snapweave.operators.filters import possible_keys
from snapweave.operators.incremental import merge_latest, merge_snapshots
from snapweave.operators.intervals import collapse_changes
from snapweave.plans.state import Versions

SCHEMA = "id string, at int, a string, b int, number string, note int"


def snapshots(rng, times, keys=12):
    rows = []
    for at in times:
        for k in [*range(keys), None]:
            for _ in range(rng.choice([0, 1, 1, 1, 2])):
                rows.append((None if k is None else f"k{k}", at, rng.choice(["x", "x", "y", None]), rng.choice([1, 1, 1, 2]),
                             rng.choice([None, None, None, f"n{rng.randrange(3)}"]), rng.randrange(4)))
    return rows


def whole(df):
    return collapse_changes(df, "id", "at", ["a", "b"], backfill=["number"])


@pytest.mark.parametrize("hot_rows", [2_000_000, 4])
@pytest.mark.parametrize("rounds", [
    [range(0, 5), range(5, 9), range(9, 12)],
    [[0, 2, 4, 6], [1, 3, 8, 9], [5, 10]],
    [[3], [], [3], [0]],
])
def test_rounds_equal_the_whole(spark, rows, rounds, hot_rows):
    """In order, late, on the same day again, with new and absent entities and a null one."""
    rng = random.Random(str(rounds))
    state, seen = None, []
    for n, times in enumerate(rounds):
        new = snapshots(rng, times, keys=8 + 2 * n)
        if n == 1 and new:
            new.append(("k1", None, "x", 1, None, 0))
        seen += new

        def history():
            return spark.createDataFrame(seen, SCHEMA)

        state = merge_snapshots(
            state, spark.createDataFrame(new, SCHEMA), "id", "at", ["a", "b"],
            history=history, backfill=["number"], hot_rows=hot_rows,
        ).checkpoint()
        expected = whole(spark.createDataFrame(seen, SCHEMA))
        assert rows(state, *expected.columns) == rows(expected)


def test_later_snapshots_need_no_history(spark, rows):
    rng = random.Random(2)
    first, second = snapshots(rng, range(4)), [r for r in snapshots(rng, range(4, 7)) if r[0] in ("k1", "k2", "new")]
    second.append(("new", 5, "x", 1, "n", 0))

    def nothing():
        raise AssertionError("the history was read")

    options = {"history": nothing, "backfill": ["number"]}
    state = merge_snapshots(None, spark.createDataFrame(first, SCHEMA), "id", "at", ["a", "b"], **options).checkpoint()
    state = merge_snapshots(state, spark.createDataFrame(second, SCHEMA), "id", "at", ["a", "b"], **options)
    expected = whole(spark.createDataFrame(first + second, SCHEMA))
    assert rows(state, *expected.columns) == rows(expected)


def test_only_late_entities_read_their_history(spark, rows):
    rng = random.Random(3)
    first = [r for r in snapshots(rng, range(0, 6, 2)) if r[0]]
    second = [("k1", 1, "z", 9, None, 0), ("k2", 8, "z", 9, None, 0)]
    seen = []

    def history():
        df = spark.createDataFrame(first + second, SCHEMA)
        seen.append(df)
        return df

    state = merge_snapshots(None, spark.createDataFrame(first, SCHEMA), "id", "at", ["a", "b"], history=history).checkpoint()
    assert not seen
    merged = merge_snapshots(state, spark.createDataFrame(second, SCHEMA), "id", "at", ["a", "b"], history=history)
    expected = collapse_changes(spark.createDataFrame(first + second, SCHEMA), "id", "at", ["a", "b"])
    assert len(seen) == 1 and rows(merged, *expected.columns) == rows(expected)


def test_latest(spark, rows):
    rng = random.Random(4)
    schema = "id string, year int, doc int, v int"
    made = [(rng.choice(["a", "b", None]), rng.randrange(3), rng.choice([1, 2, 3, None]), rng.randrange(9)) for _ in range(90)]
    state = None
    for at in range(0, 90, 30):
        state = merge_latest(state, spark.createDataFrame(made[at : at + 30], schema), ["id", "year"], "doc")
    assert rows(state) == rows(latest_per(spark.createDataFrame(made, schema), ["id", "year"], "doc"))


def test_versions(spark, tmp_path, rows):
    """Readers see whole versions: a commit that fails half way leaves the one before it in force."""
    versions = Versions(spark, str(tmp_path / "state"))
    assert versions.version == 0 and versions.read("a") is None
    one, two = spark.range(3), spark.range(5)
    assert versions.commit({"a": one, "b": two}) == 1
    broken = spark.range(4).select(F.raise_error(F.lit("torn")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="torn"):
        versions.commit({"a": two, "b": broken})
    assert versions.version == 1
    assert rows(versions.read("a")) == rows(one) and rows(versions.read("b")) == rows(two)
    assert versions.commit({"a": versions.read("b"), "b": versions.read("a")}) == 2
    assert versions.commit({"a": two}) == 3
    assert rows(versions.read("a")) == rows(two) and versions.read("b") is None
    assert len([p for p in (tmp_path / "state").iterdir() if p.name.startswith("v1-")]) == 0


def test_possible_keys(spark, rows):
    keys = [f"{i:010}" for i in range(0, 60_000, 3)]
    df = spark.createDataFrame([(f"{i:010}" if i % 50 else None, i) for i in range(30_000)], "k string, v int")
    listed = spark.createDataFrame([(k,) for k in keys] + [(None,)], "t string")
    got = {r.v for r in possible_keys(df, "k", listed, "t").collect()}
    among = {i for i in range(30_000) if i % 50 and i % 3 == 0}
    assert among <= got and len(got - among) < 0.2 * (30_000 - len(among))
    assert possible_keys(df, "k", listed.limit(0), "t").count() == 0


def test_too_many_keys_for_bitmaps(spark, monkeypatch):
    monkeypatch.setattr(filters, "MAX_BITS", 1)
    df = spark.range(5)
    assert possible_keys(df, "id", spark.range(2), "id").count() == 5
