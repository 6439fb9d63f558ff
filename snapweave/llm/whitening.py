"""Whitening of embeddings: blockwise QR, a bidiagonal qd solver, projection on the leading components.

Every task centres its vectors and reduces them, block by block, to one triangle; triangles are
reduced again in a tree with a fixed fan-in, so nothing larger than ``FAN_IN`` triangles meets in
one task.  The last triangle has the covariance's singular values and directions, which
``bidiagonal`` finds to double precision without ever forming the covariance.  Sums and deviations
are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.llm.bidiagonal import right_vectors
from snapweave.llm.common import ship
from snapweave.session import store

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8

LENGTHS = 64
"""Different vector lengths that may be whitened at once, each by itself."""

LARGEST = float(1 << 42)
"""Entries from here on have no exact integer and count as non-finite."""

FAN_IN = 16
_BLOCK = 1 << 18
"""Numbers in a block that is reduced at once."""

_EXACT = 1 << 62


@dataclass
class Model:
    """Of the vectors of one length: their number and sums, the components' variances and shares of
    all variance, and their directions, a column each, divided by the standard deviation."""

    n: int
    sums: list[int]
    variances: np.ndarray
    explained: np.ndarray
    project: np.ndarray


def usable(vector: Column) -> Column:
    """Whether a vector takes part: it is not null and all its entries are finite."""
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(LARGEST), F.lit(False)))
    return vector.isNotNull() & fine


def _by_length(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, places, x)`` of a batch: which vectors are that long, and their whole numbers."""
    lengths = column.value_lengths().to_numpy()
    entries = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    whole = np.floor(entries * SCALE).astype(np.int64) + OFFSET
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        yield length, places, whole[starts[places][:, None] + np.arange(length)]


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: 64-bit numbers where they are enough, else Python's."""
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0) < _EXACT:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _squares(deviations: np.ndarray) -> list[int | None]:
    """Exact sums of squares; None where 64 bits are not enough."""
    rough = (deviations.astype(float) ** 2).sum(axis=1)
    if deviations.dtype != object and rough.max(initial=0.0) < _EXACT:
        return (deviations * deviations).sum(axis=1).tolist()
    whole = (sum(int(v) ** 2 for v in row) for row in deviations)
    return [v if v < 1 << 63 else None for v in whole]


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _entries(df: DataFrame, vector: str) -> DataFrame:
    return df.filter(usable(F.col(vector))).select(F.col(vector).cast("array<double>").alias("v"))


def _sums(df: DataFrame) -> DataFrame:
    """``(length, place, n, total)``, the exact sum of every dimension."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, list[int]]] = {}
        for batch in batches:
            for length, places, x in _by_length(batch.column(0)):
                safe = len(x) * int(np.abs(x).max(initial=0)) < _EXACT
                total = (x if safe else x.astype(object)).sum(axis=0).tolist()
                n, before = held.get(length, (0, [0] * length))
                held[length] = n + len(places), [int(a) + b for a, b in zip(total, before, strict=True)]
        for length, (n, total) in held.items():
            # a vector without entries has a row of its own, so that it is counted
            yield pa.RecordBatch.from_pydict(
                {
                    "length": pa.array([length] * (length + 1), pa.int32()),
                    "place": pa.array(range(-1, length), pa.int32()),
                    "total": pa.array([str(v) for v in [n, *total]]),
                }
            )

    found = df.mapInArrow(added, "length int, place int, total string")
    return found.groupBy("length", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def _reduced(df: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> DataFrame:
    """``(length, r)``: the triangle of all centred vectors of each length."""
    shared = df.sparkSession.sparkContext.broadcast(sums)

    def triangles(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, _, x in _by_length(batch.column(0)):
                n, total = shared.value[length]
                step = max(length, _BLOCK // max(1, length))
                for at in range(0, len(x) if length else 0, step):
                    centred = _deviations(x[at : at + step], n, total).astype(float) / n
                    held[length] = _triangle(np.vstack([held[length], centred]) if length in held else centred)
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict(
            {
                "length": pa.array(list(held), pa.int32()),
                "part": pa.array([part] * len(held), pa.int64()),
                "r": pa.array([r.tobytes() for r in held.values()], pa.binary()),
            }
        )

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        length = int(rows["length"].iloc[0])
        r = np.zeros((0, length))
        for part in rows.sort_values("part")["r"]:
            r = _triangle(np.vstack([r, np.frombuffer(part).reshape(-1, length)]))
        return pd.DataFrame({"length": [length], "part": [rows["part"].iloc[0] // FAN_IN], "r": [r.tobytes()]})

    schema = "length int, part long, r binary"
    left = store(df.mapInArrow(triangles, schema), "triangles")
    parts = (left.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        left = left.groupBy("length", F.floor(F.col("part") / FAN_IN).alias("group")).applyInPandas(merged, schema)
        if parts <= FAN_IN:
            return left.select("length", "r")
        parts = -(-parts // FAN_IN)


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> dict[int, Model]:
    """What whitening needs to know of all usable vectors, by their length.

    On the driver come the sums of each dimension and the leading directions of each length, of
    which there may be ``LENGTHS``; more raise a ValueError.  A component whose variance cannot be
    told from rounding has variance 0.
    """
    spark = df.sparkSession
    ship(spark)
    entries = _entries(df, vector)
    totals = store(_sums(entries), "sums")
    if totals.select("length").distinct().limit(LENGTHS + 1).count() > LENGTHS:
        raise ValueError(f"vectors of more than {LENGTHS} different lengths")
    sums: dict[int, tuple[int, list[int]]] = {}
    for row in totals.orderBy("length", "place").collect():
        if row["place"] < 0:
            sums[row["length"]] = int(row["total"]), []
        else:
            sums[row["length"]][1].append(int(row["total"]))

    def solved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for length, raw in zip(batch["length"], batch["r"], strict=True):
                r = np.zeros((length, length))
                rows = np.frombuffer(raw).reshape(-1, length)
                r[: len(rows)] = rows
                squares, vectors = right_vectors(r, min(components, length))
                squares[squares <= (length * np.finfo(float).eps) ** 2 * squares.max(initial=0.0)] = 0.0
                yield pd.DataFrame(
                    {"length": [length], "squares": [squares], "vectors": [vectors.ravel()], "all": [(r * r).sum()]}
                )

    answers = _reduced(entries, sums).mapInPandas(
        solved, "length int, squares array<double>, vectors array<double>, all double"
    )
    models = {length: Model(n, total, np.zeros(0), np.zeros(0), np.zeros((length, 0))) for length, (n, total) in sums.items()}
    for row in answers.collect():
        model = models[row["length"]]
        squares = np.array(row["squares"])
        model.variances = squares / model.n
        model.explained = squares / row["all"] if row["all"] > 0 else np.full(len(squares), np.nan)
        with np.errstate(divide="ignore"):
            scale = np.where(squares > 0, 1 / np.sqrt(model.variances), np.nan)
        model.project = np.array(row["vectors"]).reshape(len(squares), row["length"]).T * scale
    return models


def whiten(
    df: DataFrame, models: dict[int, Model] | None = None, vector: str = "embedding", key: str = "vec_id"
) -> DataFrame:
    """``(key, length, n, deviation, whitened)`` for every row with a usable vector; repeated rows stay.

    An entry c becomes x = floor(1024 * c) + 100000.  ``deviation`` is the sum over dimensions of
    (n * x - S)^2, exact, null if it exceeds 64 bits.  ``whitened`` has a number for each leading
    component: x - S / n on the unit eigenvector of the covariance, over the root of its variance;
    null for a component without variance.  Vectors that are null, or hold null, non-finite or
    huge (``LARGEST``) entries, are left out; vectors of other lengths are whitened apart; those
    without entries have no components.  A null key stays.  Other columns are not read.  An empty
    table gives no rows.
    """
    models = fit(df, vector) if models is None else models
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(models)
    kept = df.filter(usable(F.col(vector))).select(
        F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v")
    )

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, places, x in _by_length(batch.column(1)):
                model = shared.value[length]
                deviations = _deviations(x, model.n, model.sums)
                found = deviations.astype(float) / model.n @ model.project
                flat = pa.array(found.ravel(), pa.float64(), from_pandas=True)
                offsets = np.arange(len(places) + 1, dtype=np.int32) * found.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(places)),
                        pa.array([length] * len(places), pa.int32()),
                        pa.array([model.n] * len(places), pa.int64()),
                        pa.array(_squares(deviations), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), flat),
                    ],
                    names=[key, "length", "n", "deviation", "whitened"],
                )

    schema = T.StructType(
        [
            T.StructField(key, kept.schema["key"].dataType),
            T.StructField("length", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )
    return kept.mapInArrow(projected, schema)


def identity_error(whitened: DataFrame) -> float | None:
    """The largest entry, in absolute value, of the covariance of ``whitened`` rows minus the identity.

    Each vector length by itself, over its components with a variance; None where there is none.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = batch.column(0).to_numpy()
            for length in np.unique(lengths).tolist():
                rows = batch.column(1).filter(pa.array(lengths == length))
                w = rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
                w = np.hstack([np.ones((len(w), 1)), w])
                held[length] = held.get(length, 0.0) + w.T @ w
        for length, sums in held.items():
            flat = sums.ravel()
            yield pa.RecordBatch.from_pydict(
                {
                    "length": pa.array([length] * len(flat), pa.int32()),
                    "place": pa.array(range(len(flat)), pa.int32()),
                    "total": pa.array(flat, pa.float64()),
                }
            )

    sums = (
        whitened.select("length", "whitened")
        .mapInArrow(moments, "length int, place int, total double")
        .groupBy("length", "place")
        .agg(F.sum("total").alias("total"))
        .toPandas()
    )
    errors = []
    for _, rows in sums.groupby("length"):
        m = rows.sort_values("place")["total"].to_numpy()
        m = m.reshape(int(round(len(m) ** 0.5)), -1) / m[0]
        off = m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) - np.eye(len(m) - 1)
        errors += np.abs(off[~np.isnan(off)]).ravel().tolist()
    return max(errors, default=None)


def components(df: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``whiten`` with a row for each vector and component, and how well it was done.

    Columns: key, component (from 1), n, deviation, whitened, explained (the component's share of
    all variance, null without any), identity_error (one value for the whole table).  The whitened
    rows are stored, a few numbers each.
    """
    models = fit(df, vector)
    rows = store(whiten(df, models, vector, key), "whitened")
    error = identity_error(rows)
    shares = [
        (length, i + 1, None if np.isnan(share) else float(share))
        for length, model in models.items()
        for i, share in enumerate(model.explained)
    ]
    spread = rows.select(key, "length", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    spread = spread.withColumn("component", F.col("at") + 1)
    explained = df.sparkSession.createDataFrame(shares, "length int, component int, explained double")
    return spread.join(F.broadcast(explained), ["length", "component"]).select(
        key, "component", "n", "deviation", "whitened", "explained", F.lit(error).cast("double").alias("identity_error")
    )
