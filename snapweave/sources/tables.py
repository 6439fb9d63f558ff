"""CSV tables between stages, and the lookup tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave.sources.xml import typed

DATA_FILES = "data-*.csv"


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


LINE = "line"
"""The rescued text of a row that has too few or too many cells."""


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, rescue: str | None = None, **options
) -> DataFrame:
    """Read a CSV file, or the ``data-*.csv`` files of a folder, with a declared schema.

    A path ending in ``.csv`` is read whole, be it a file or a folder of parts.  ``NA`` and
    nothing at all are null.  A missing path, or a folder without such files, gives no rows.

    A cell that does not fit its type is null.  With ``rescue`` a column of that name keeps its text
    (``xml.typed``), and the whole line of a row with too few or too many cells; ``xml.quarantine``
    makes a table of them.  Dates are then read as ISO dates unless ``dateFormat`` says otherwise.
    """
    if rescue:
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        date_format = options.pop("dateFormat", "yyyy-MM-dd")
        options = {**options, "columnNameOfCorruptRecord": "__line"}
        found = read_csv(spark, path, texts.add("__line", T.StringType()), **options)
        made = typed(found, schema, date_format, rescue)
        line = F.when(F.col("__line").isNotNull(), F.create_map(F.lit(LINE), F.col("__line")))
        nothing = F.create_map().cast("map<string,string>")
        both = F.map_concat(F.coalesce(rescue, nothing), F.coalesce(line, nothing))
        return made.withColumn(rescue, F.when(F.size(both) > 0, both)).drop("__line")
    reader = spark.read.schema(schema).options(
        **{"header": True, "escape": '"', "nullValue": "NA", **options}
    )
    if not path.rstrip("/").endswith(".csv"):
        reader = reader.option("pathGlobFilter", DATA_FILES)
    try:
        return reader.csv(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, schema)


def read_lookup(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Read lookup tables as text columns and put them below each other by column name."""
    listed = [paths] if isinstance(paths, str) else list(paths)
    tables = [
        spark.read.options(header=True, escape='"', inferSchema=False).csv(p) for p in listed
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
