"""Archives of nested XML to flat typed tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave import schemas
from snapweave.operators.filters import expand_codes
from snapweave.operators.skew import broadcast_if_small, same
from snapweave.plans.state import Versions
from snapweave.session import materialize, remove, remove_partition, store
from snapweave.sources import xml
from snapweave.sources.archives import directory, fingerprints, list_archives, member_texts
from snapweave.streaming.ingest import ingest_batches


def _records(
    documents: DataFrame,
    elements: Mapping[str, str],
    record: str,
    file_attributes: Mapping[str, str] | None,
    code_column: str | None,
    codes: Sequence[str] | None,
    classifier: DataFrame | None,
    xml_column: str,
) -> DataFrame:
    """Flat rows of text columns, and the damaged documents, marked ``__rejected``.

    Codes are compared before the wide row is built.
    """
    rows = xml.parse_records(documents, record, elements, file_attributes, xml_column)
    if code_column and [c for c in codes or () if c.strip()]:
        allowed = expand_codes(classifier, codes).distinct().withColumn("__allowed", F.lit(True))
        allowed = broadcast_if_small(materialize(allowed))
        coded = rows.withColumn("__code", xml.record_value(elements, code_column))
        kept = coded.join(allowed, same(coded, allowed, [("__code", "code")]), "left")
        rows = kept.filter("__allowed OR __rejected").drop("__code", "code", "__allowed")
    return xml.flatten_records(rows, elements)


def read_texts(
    texts: DataFrame,
    elements: Mapping[str, str],
    *,
    record: str = schemas.RECORD_TAG,
    file_attributes: Mapping[str, str] | None = None,
    code_column: str | None = None,
    codes: Sequence[str] | None = None,
    classifier: DataFrame | None = None,
    xml_column: str = "xml",
) -> tuple[DataFrame, DataFrame]:
    """Flat rows of text columns from XML texts, and the texts that are not well-formed."""
    documents = xml.split_texts(texts, record, xml_column)
    found = _records(
        documents, elements, record, file_attributes, code_column, codes, classifier, xml_column
    )
    kept = [c for c in texts.columns if c != xml_column]
    return found.filter("NOT __rejected").drop("__rejected"), found.filter("__rejected").select(*kept)


def _slice(listed: DataFrame, members: slice | int) -> DataFrame:
    """Members at the positions Python would take from each archive's list."""
    n = F.count(F.when(F.col("position") >= 0, 1)).over(Window.partitionBy("path"))
    at = F.col("position")
    if isinstance(members, int):
        taken = at == (members if members >= 0 else n + members)
    else:
        step = 1 if members.step is None else members.step
        if step == 0:
            raise ValueError("slice step cannot be zero")
        low, high = (F.lit(0), n) if step > 0 else (F.lit(-1), n - 1)

        def bound(value: int | None, default: Column) -> Column:
            if value is None:
                return default
            counted = F.lit(value) if value >= 0 else n + value
            return F.least(F.greatest(counted, low), high)

        start = bound(members.start, F.lit(0) if step > 0 else n - 1)
        stop = bound(members.stop, n if step > 0 else F.lit(-1))
        inside = (at >= start) & (at < stop) if step > 0 else (at <= start) & (at > stop)
        taken = inside & (F.abs(at - start) % abs(step) == 0)
    return listed.withColumn("__taken", taken | (at < 0)).filter("__taken").drop("__taken")


def _extracted(
    archives: DataFrame,
    dataset: str,
    codes: Sequence[str] | None = None,
    classifier: DataFrame | None = None,
    elements: Mapping[str, str] | None = None,
    provenance: bool = True,
    members: slice | int | None = None,
    rescue: str | None = None,
    **sizes,
) -> DataFrame:
    """Typed rows with path, member and ``archive``, and one row, marked ``__rejected``, per reject."""
    schemas.check_dataset(dataset)
    listed = directory(archives)
    if members is not None:
        listed = _slice(listed, members)
    registry = dataset == "sme"
    rows = _records(
        member_texts(listed, schemas.RECORD_TAG, **sizes),
        elements or schemas.ELEMENTS[dataset],
        schemas.RECORD_TAG,
        schemas.FILE_ATTRIBUTES if registry and provenance else None,
        "activity_code_main" if registry else None,
        codes,
        classifier,
        "xml",
    )
    named = rows.withColumn("archive", F.substring_index("path", "/", -1)).drop("part")
    if elements is None and (provenance or not registry):
        named = xml.typed(named, schemas.EXTRACTED[dataset], schemas.INPUT_DATE_FORMAT, rescue)
    return named


def extract_archives(
    archives: DataFrame,
    dataset: str,
    *,
    codes: Sequence[str] | None = None,
    classifier: DataFrame | None = None,
    elements: Mapping[str, str] | None = None,
    provenance: bool = True,
    members: slice | int | None = None,
    rescue: str | None = None,
    **sizes,
) -> tuple[DataFrame, DataFrame]:
    """Typed rows of the listed archives with their ``archive``, and what was rejected.

    Codes apply to the registry only, as do the file's id and record count.  ``elements``
    narrows the map to other columns (then as text), ``members`` takes a member or a slice of each
    archive's members, as Python does.  Rejects are damaged members (path, member), and archives
    that cannot be opened (without member).  Both come from one reading, which is stored.
    """
    found = _extracted(archives, dataset, codes, classifier, elements, provenance, members, rescue, **sizes)
    found = store(found, "extracted")
    rows = found.filter("NOT __rejected").drop("path", "member", "__rejected")
    return rows, found.filter("__rejected").select("path", "member").distinct()


def extract(
    spark: SparkSession,
    folder: str,
    dataset: str,
    *,
    codes: Sequence[str] | None = None,
    classifier: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Typed rows of all archives in a folder; malformed members are left out."""
    found = _extracted(list_archives(spark, folder), dataset, codes, classifier, **options)
    return found.filter("NOT __rejected").drop("path", "member", "__rejected")


def extract_new(
    spark: SparkSession,
    folder: str,
    target: str,
    ledger: str,
    dataset: str,
    *,
    codes: Sequence[str] | None = None,
    classifier: DataFrame | None = None,
    clear: bool = False,
    files_per_batch: int | None = None,
    rejects: str | None = None,
    by_content: bool = False,
) -> int | None:
    """Extract the archives not processed before into ``target``; returns how many there were.

    Archives are told apart by name, whatever their age.  With ``by_content`` one that lists other
    members, sizes or checksums than when it was taken is taken again, and replaces what it gave
    (rows and rejects); every call then reads the lists of all archives.  One Parquet partition per archive; a
    repeated batch replaces the partitions it wrote.  ``files_per_batch`` archives are finished
    before the ledger moves on (by default all that are there).  Damaged members and archives are
    kept in the table ``rejects`` (path, member), by default beside the target.  ``clear`` starts
    over: target, rejects and ledger are emptied first.  A folder without archives gives None.
    """
    schemas.check_dataset(dataset)
    refused = rejects or f"{target.rstrip('/')}_rejects"
    if list_archives(spark, folder).isEmpty():
        return None
    contents = Versions(spark, f"{ledger.rstrip('/')}_contents")
    if clear:
        for path in (target, refused, ledger, contents.path):
            remove(spark, path)

    def write(rows: DataFrame, path: str) -> None:
        placed = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        placed.partitionBy("archive").parquet(path)

    def process(archives: DataFrame) -> None:
        found = store(_extracted(archives, dataset, codes, classifier), "extracted")
        write(found.filter("NOT __rejected").drop("path", "member", "__rejected"), target)
        write(found.filter("__rejected").select("path", "member", "archive"), refused)

    marks, replaced = None, []
    if by_content:
        marks = store(fingerprints(list_archives(spark, folder)), "fingerprints")
        known = contents.read("archives")
        if known is not None:
            same_name = marks.join(known.withColumnRenamed("fingerprint", "before"), "archive")
            # as many as were repaired since, each with all its rows to be read again
            replaced = same_name.filter("fingerprint <> before").select("path", "archive").collect()
    if replaced:
        for row in replaced:
            for path in (target, refused):
                remove_partition(spark, path, "archive", row["archive"])
        process(spark.createDataFrame([(row["path"],) for row in replaced], "path string"))
    taken = ingest_batches(spark, folder, ledger, process, pattern="*.zip", files_per_batch=files_per_batch)
    if marks is not None:
        # what came while this ran is new to the next call
        contents.commit({"archives": marks.select("archive", "fingerprint")})
    return len(replaced) + (taken or 0)


def read_rejects(spark: SparkSession, target: str, rejects: str | None = None) -> DataFrame:
    """Members (path, member) that ``extract_new`` refused so far; archives have no member."""
    schema = "path string, member string, archive string"
    return _read(spark, rejects or f"{target.rstrip('/')}_rejects", schema).select("path", "member")


def _read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_extracted(spark: SparkSession, target: str, dataset: str, archive: bool = False) -> DataFrame:
    """What ``extract_new`` has gathered so far, with the name of its ``archive`` if asked for."""
    schema = T.StructType([*schemas.EXTRACTED[schemas.check_dataset(dataset)].fields])
    if archive:
        schema = schema.add("archive", T.StringType())
    return _read(spark, target, schema).select(*schema.names)
