"""Mixing sources to target weights by pivotal dependent rounding.

Each document of a source should appear target / size-of-source times.  The whole part is given
to all of them; the fraction is rounded so that the source's words keep their sum.  Two documents
with fractional copies meet, and as many words as possible move from one to the other, in a
direction drawn so that nobody's expectation changes; one of the two then has a whole number of
copies, the other carries the rest into the next meeting.

A group of a few hundred documents meets in one row, and what each group carries on meets again
in the next level's groups: a reduction tree with a fixed fan-in, whatever a source's share of
the rows.  Every draw is a hash of the rows that meet, equal rows being numbered, so reruns agree
however the rows are laid out.  All of it is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snapweave.llm.common import WORD
from snapweave.operators.skew import SMALL_ROWS
from snapweave.session import store, store_counted

WEIGHTS = (5, 2, 1)
TOTAL = 1.5
"""Words in the mix, as a share of all words."""

MOST = 2.0
"""Copies of a document at most."""

FAN_IN = 256
"""Documents that meet in one group, on average."""

SEED = 7


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    total: float = TOTAL,
    most: float = MOST,
) -> DataFrame:
    """``(source, source_size, target)`` from ``sizes (source, source_size)``, one row a source.

    Sources by code point, null last, get the weights in turn.  Their shares of the total stop at
    ``most`` times their size; the excess goes to the others by weight until none is above.  The
    ranks come from a distributed sort and the counts of its partitions.
    """
    ordered = store(
        sizes.orderBy(F.col("source").isNull(), "source").withColumn("__at", F.monotonically_increasing_id()),
        "sources",
    )
    # the id is the partition's number above 33 bits of the place in it
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    before, seen = [], 0
    for row in ordered.groupBy(part.alias("part")).count().orderBy("part").collect():
        before += [F.lit(row["part"]), F.lit(seen)]
        seen += row["count"]
    rank = place + F.element_at(F.create_map(*before), part) if before else place
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (rank % len(weights)).cast("int"))
    ranked = ordered.select("source", "source_size", weight.cast("bigint").alias("w"))

    words, weighed = ranked.agg(F.sum("source_size"), F.sum("w")).first()
    want = total * (words or 0)
    rate = want / weighed if weighed else 0.0
    while True:
        above = F.col("w") * F.lit(rate) > F.col("source_size") * F.lit(most)
        stopped, free = ranked.agg(
            F.sum(F.when(above, F.col("source_size"))), F.sum(F.when(~above, F.col("w")))
        ).first()
        if not stopped or not free:
            break
        higher = (want - most * stopped) / free
        if higher <= rate:
            break
        rate = higher
    target = F.least(F.col("source_size") * F.lit(most), F.col("w") * F.lit(rate))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def _uniform(*keys: Column) -> Column:
    """A number in [0, 1) that depends on nothing but the keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit(SEED)), 11) / F.lit(float(1 << 53))


def _meet(units: Column) -> Column:
    """Let the units of a group meet in turn: ``(id, key, size, mass, done)``, the rest and who is settled.

    ``mass`` is the words a unit is to get, between 0 and its size.
    """

    def step(a: Column, x: Column) -> Column:
        gain = F.least(a["size"] - a.mass, x.mass)
        loss = F.least(a.mass, x["size"] - x.mass)
        up = _uniform(a.key, x.key) * (gain + loss) < loss
        moved = F.when(up, gain).otherwise(-loss)
        settled = F.when(up, a["size"] - a.mass <= x.mass).otherwise(a.mass <= x["size"] - x.mass)
        who = F.struct(
            F.when(settled, a.id).otherwise(x.id).alias("id"),
            F.when(settled == up, F.lit(1)).otherwise(F.lit(0)).alias("up"),
        )
        first = F.struct(
            x.id.alias("id"), x.key.alias("key"), x["size"].alias("size"), x.mass.alias("mass"), a.done.alias("done")
        )
        met = F.struct(
            F.when(settled, x.id).otherwise(a.id).alias("id"),
            F.when(settled, x.key).otherwise(a.key).alias("key"),
            F.when(settled, x["size"]).otherwise(a["size"]).alias("size"),
            F.when(settled, x.mass - moved).otherwise(a.mass + moved).alias("mass"),
            F.concat(a.done, F.array(who)).alias("done"),
        )
        return F.when(a.id.isNull(), first).otherwise(met)

    start = F.struct(
        F.lit(None).cast("bigint").alias("id"),
        F.lit(None).cast("bigint").alias("key"),
        F.lit(None).cast("bigint").alias("size"),
        F.lit(None).cast("double").alias("mass"),
        F.array().cast("array<struct<id:bigint,up:int>>").alias("done"),
    )
    return F.aggregate(F.sort_array(units), start, step)


def pivotal_rounding(units: DataFrame) -> DataFrame:
    """``(id, up)``: whether each unit's mass is rounded up to its size or down to 0.

    ``units (source, id, key, size, mass)`` have unique ids and 0 < mass < size; all draws are by
    ``key``.  In each source, the sizes that are rounded up sum to the sum of masses, to within one
    unit; a unit is rounded up with probability mass / size.
    """
    left, settled, level = units, None, 0
    groups = max(1, math.ceil(units.count() / FAN_IN))
    while True:
        group = F.pmod(F.xxhash64("key", F.lit(level), F.lit(SEED)), F.lit(groups))
        unit = F.struct(F.xxhash64("key", F.lit(SEED)).alias("order"), "size", "id", "key", "mass")
        met = store(
            left.groupBy("source", group.alias("__group"))
            .agg(F.collect_list(unit).alias("units"))
            .select("source", _meet(F.col("units")).alias("met"))
            .select("source", "met.*"),
            "met",
        )
        done = met.select(F.explode("done").alias("d")).select("d.id", "d.up")
        settled = done if settled is None else settled.union(done)
        left = met.select("source", "id", "key", "size", "mass")
        if groups == 1:
            last = (_uniform(F.col("key"), F.lit(-1)) * F.col("size") < F.col("mass")).cast("int")
            return settled.union(left.select("id", last.alias("up")))
        groups, level = math.ceil(groups / FAN_IN), level + 1


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows (__row, __same, __part)`` with ``__key``: ``__same`` and a running number among equal rows.

    Equal rows may be anywhere and as many as they like: they are numbered within each partition,
    and the partitions' counts carried on.
    """
    again = rows.groupBy("__same").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("__same")
    copies, n = store_counted(rows.select("__row", "__same", "__part").join(again, "__same", "left_semi"), "copies")
    number = F.lit(0).cast("bigint")
    if n:
        earlier = Window.partitionBy("__same").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        ahead = copies.groupBy("__same", "__part").agg(F.count(F.lit(1)).alias("n"))
        ahead = ahead.select("__same", "__part", F.coalesce(F.sum("n").over(earlier), number).alias("ahead"))
        within = F.row_number().over(Window.partitionBy("__same", "__part").orderBy("__row"))
        numbers = copies.withColumn("within", within).join(ahead, ["__same", "__part"])
        numbers = numbers.select("__row", (F.col("ahead") + F.col("within")).alias("__number"))
        rows = rows.join(F.broadcast(numbers) if n <= SMALL_ROWS else numbers.hint("merge"), "__row", "left")
        number = F.coalesce("__number", number)
    return rows.withColumn("__key", F.xxhash64("__same", number)).drop("__number", "__same", "__part")


def mix(
    docs: DataFrame,
    source: str = "source",
    size: str = "size",
    weights: tuple[int, ...] = WEIGHTS,
    total: float = TOTAL,
    most: float = MOST,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` (of the row's source) and ``copies`` (0 to ``most``).

    One row out for each row in; repeated rows are rounded one by one.  What a row gets depends on
    the rows of the table alone, not on their order or partitions.  Sources are told apart as
    they are, null and the empty string being two of them.  A size of 0 or null weighs nothing:
    such rows are copied with the same probability, each by itself.  All columns of ``docs`` are
    kept, those named like a new one are replaced.  An empty table gives no rows.  ``docs`` is
    stored once; its other columns are shuffled once, by row.
    """
    docs = docs.drop("source_size", "target", "copies")
    marks = {"__row": F.monotonically_increasing_id(), "__same": F.xxhash64(*docs.columns), "__part": F.spark_partition_id()}
    rows = store(docs.withColumns(marks), "rows")
    weight = F.coalesce(F.col(size), F.lit(0)).cast("bigint")
    small = _keyed(rows.select("__row", "__same", "__part", F.col(source).alias("source"), weight.alias("size")))
    small = store(small.withColumnsRenamed({"__row": "id", "__key": "key"}), "sizes")
    wanted = store(
        targets(small.groupBy("source").agg(F.sum("size").alias("source_size")), weights, total, most), "targets"
    )
    wanted = wanted.withColumnRenamed("source", "__source")
    if wanted.count() <= SMALL_ROWS:
        wanted = F.broadcast(wanted)
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(share)

    units = small.join(wanted, F.col("source").eqNullSafe(F.col("__source")))
    units = units.withColumn("mass", F.col("size") * (share - whole))
    rounded = pivotal_rounding(
        store(units.filter("mass > 0 and mass < size").select("source", "id", "key", "size", "mass"), "units")
    )
    # rows that weigh nothing meet nobody
    alone = (_uniform(F.col("key"), F.lit(-2)) < share - whole).cast("int")
    rounded = rounded.union(units.filter("size = 0").select("id", alone.alias("up")))

    extra = F.col("__up")
    # ids compress to almost nothing on disk, by which Spark would take this table for small
    decided = rounded.select(F.col("id").alias("__row"), F.col("up").alias("__up")).hint("merge")
    return (
        rows.join(decided, "__row", "left")
        .join(wanted, F.col(source).eqNullSafe(F.col("__source")))
        .withColumn("copies", (whole + F.coalesce(extra, F.lit(0))).cast("int"))
        .drop("__row", "__same", "__part", "__source", "__up")
    )
