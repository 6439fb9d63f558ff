"""Writing tables: partitioned Parquet between stages, CSV for export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def _sorted(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str]) -> DataFrame:
    """Range-partition by the sort columns, so that files follow each other in order."""
    by = [*partition_by, *[c for c in sort_by if c not in partition_by]]
    return df.repartitionByRange(*by).sortWithinPartitions(*by) if sort_by else df


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    clear: bool = True,
) -> None:
    """Write Parquet; ``clear`` replaces what is there, otherwise rows are added."""
    writer = _sorted(df, partition_by, sort_by).write.mode("overwrite" if clear else "append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    clear: bool = True,
    **options,
) -> None:
    """Export as a folder of CSV parts with headers and nulls as ``NA``."""
    writer = (
        _sorted(df, partition_by, sort_by)
        .write.options(**{"header": True, "nullValue": "NA", "escape": '"', **options})
        .mode("overwrite" if clear else "append")
    )
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)
