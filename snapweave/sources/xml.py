"""Flat rows from XML text, as told by a map of element paths to columns."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import partial
from io import BytesIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.sources import documents

_CORRUPT = "_corrupt_record"
_OPTIONS = {
    "mode": "PERMISSIVE",
    "attributePrefix": "_",
    "valueTag": "_VALUE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "ignoreSurroundingSpaces": "false",
    "nullValue": "\u0000",
}


def _field(step: str) -> str:
    return f"_{step[1:]}" if step.startswith("@") else step


def record_schema(elements: Mapping[str, str]) -> T.StructType:
    """Nested type holding just the mapped paths; every element may be repeated."""
    tree: dict = {}
    for path in elements:
        node = tree
        for step in path.split("/"):
            node = node.setdefault(_field(step), {})

    def build(node: dict) -> T.StructType:
        return T.StructType(
            [
                T.StructField(
                    name, T.ArrayType(build(below)) if below else T.StringType()
                )
                for name, below in node.items()
            ]
        )

    return build(tree)


def _value(record: Column, path: str) -> Column:
    """Text at a path: null without a match, several matches joined with a comma."""
    steps = [_field(s) for s in path.split("/")]
    value, repeated = record.getField(steps[0]), False
    for step in steps[1:]:
        if repeated:
            value = F.flatten(F.filter(value, lambda inner: inner.isNotNull()))
        value, repeated = value.getField(step), True
    if not repeated:
        return value
    return F.when(F.array_max(value).isNotNull(), F.array_join(value, ","))


def split_texts(texts: DataFrame, record: str, xml: str = "xml") -> DataFrame:
    """Replace each text by documents that hold its records; null for a text that is not well-formed.

    Texts without records go.
    """

    @F.arrow_udf("good boolean, parts array<string>")
    def split(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in column:
            good, parts = [], []
            for data in batch.cast(pa.binary()).to_pylist():
                try:
                    opened = partial(BytesIO, data or b"")
                    parts.append(list(documents.documents(opened, record, encoding="utf-8", hold=True)))
                    good.append(True)
                except documents.DAMAGED:
                    parts.append(None)
                    good.append(False)
            arrays = [pa.array(good, pa.bool_()), pa.array(parts, pa.list_(pa.string()))]
            yield pa.StructArray.from_arrays(arrays, ["good", "parts"])

    none = F.array(F.lit(None).cast("string"))
    kept = [c for c in texts.columns if c != xml]
    parted = texts.withColumn("__split", split(F.col(xml)))
    parts = F.when(F.col("__split.good"), F.col("__split.parts")).otherwise(none)
    return parted.select(*kept, F.explode(parts).alias(xml))


def parse_records(
    texts: DataFrame,
    record: str,
    elements: Mapping[str, str],
    file_attributes: Mapping[str, str] | None = None,
    xml: str = "xml",
) -> DataFrame:
    """One row per ``record`` below the root, and one, marked ``__rejected``, per text that is damaged.

    Texts are documents as ``split_texts`` gives them.  Rows keep the other columns of ``texts``.
    ``__record`` holds the parsed element until ``flatten_records`` picks the mapped columns, so
    that a filter in between sees no wide rows.
    """
    attributes = dict(file_attributes or {})
    root = T.StructType(
        [
            *[T.StructField(_field(a), T.StringType()) for a in attributes],
            T.StructField(record, T.ArrayType(record_schema(elements))),
            T.StructField(_CORRUPT, T.StringType()),
        ]
    )
    kept = [c for c in texts.columns if c != xml]
    parsed = texts.select(*kept, F.from_xml(xml, root, _OPTIONS).alias("__doc"))
    # an outer explode, and what is filtered later comes out of it: a filter on the document itself
    # would be moved down and parse it again
    whole = F.col("__doc").isNotNull() & F.col(f"__doc.{_CORRUPT}").isNull()
    good = F.transform(f"__doc.{record}", lambda one: F.struct(F.lit(False).alias("bad"), one.alias("record")))
    bad = F.array(F.struct(F.lit(True).alias("bad"), F.lit(None).cast(record_schema(elements)).alias("record")))
    found = parsed.select(
        *kept,
        *[F.col(f"__doc.{_field(a)}").alias(c) for a, c in attributes.items()],
        F.when(whole, good).otherwise(bad).alias("__records"),
    ).select(*kept, *attributes.values(), F.explode_outer("__records").alias("__one"))
    told = F.coalesce("__one.bad", F.lit(False)).alias("__rejected")
    return found.select(*kept, *attributes.values(), told, F.col("__one.record").alias("__record")).filter(
        "__record IS NOT NULL OR __rejected"
    )


def record_value(elements: Mapping[str, str], column: str) -> Column:
    """The value of one mapped column in rows of ``parse_records``."""
    path = next(p for p, c in elements.items() if c == column)
    return _value(F.col("__record"), path)


def flatten_records(rows: DataFrame, elements: Mapping[str, str]) -> DataFrame:
    """Replace the parsed element by the mapped columns."""
    kept = [c for c in rows.columns if c != "__record"]
    return rows.select(
        *[_value(F.col("__record"), path).alias(c) for path, c in elements.items()], *kept
    )


def typed(df: DataFrame, schema: T.StructType, date_format: str, rescue: str | None = None) -> DataFrame:
    """Cast text columns to the schema; text that does not fit becomes null.

    With ``rescue`` a column of that name keeps such text: a map from column to text, null for rows
    in which everything fits.
    """

    def cast(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.try_to_date(c, date_format).alias(field.name)
        if isinstance(field.dataType, T.StringType):
            return c
        return c.try_cast(field.dataType).alias(field.name)

    others = [c for c in df.columns if c not in schema.names and c != rescue]
    values = [cast(f) for f in schema.fields]
    if rescue:
        values.append(misfits(schema, {f.name: cast(f) for f in schema.fields}).alias(rescue))
    return df.select(*values, *others)


def misfits(schema: T.StructType, values: Mapping[str, Column]) -> Column:
    """A map from column to text of the columns that hold text but have no value; null without any."""
    told = [
        F.when(F.col(f.name).isNotNull() & values[f.name].isNull(), F.struct(F.lit(f.name).alias("k"), F.col(f.name).alias("v")))
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    if not told:
        return F.lit(None).cast("map<string,string>")
    kept = F.map_from_entries(F.array_compact(F.array(*told)))
    return F.when(F.size(kept) > 0, kept)


def quarantine(df: DataFrame, rescued: str, *keys: str) -> DataFrame:
    """A row for each text that did not fit: the ``keys`` of its row, ``column`` and ``value``."""
    return df.filter(F.col(rescued).isNotNull()).select(*keys, F.explode(rescued).alias("column", "value"))
