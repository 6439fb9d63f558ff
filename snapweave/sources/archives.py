"""ZIP archives of XML files.

A first pass lists the members of every archive, a second one opens the archives again for
single members.  The members of one large archive are thus read by many tasks, and no archive
passes through a DataFrame column.  Archives are opened by URI, so any file system that pyarrow
knows will do.
"""

from __future__ import annotations

import hashlib
import io
import re
import sys
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import ExitStack
from functools import partial
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snapweave.session import materialize
from snapweave.sources import documents

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PARTITION_BYTES = 64 << 20

_MANIFEST = "path string, member string, position int, bytes long"
_TEXTS = "path string, member string, part int, xml string"
_TEXT_SCHEMA = pa.schema([("path", pa.string()), ("member", pa.string()), ("part", pa.int32()), ("xml", pa.string())])
_PLACE = {
    "name": "orig_filename", "at": "header_offset", "packed": "compress_size", "size": "file_size", "crc": "CRC",
    "method": "compress_type", "flags": "flag_bits", "until": "_end_offset",
}
_PLACE_TYPES = ", ".join(f"{k}: {'string' if k == 'name' else 'long'}" for k in _PLACE)
_LISTED = pa.schema([
    ("path", pa.string()), ("member", pa.string()), ("position", pa.int32()), ("bytes", pa.int64()),
    ("place", pa.struct([(k, pa.string() if k == "name" else pa.int64()) for k in _PLACE])),
])
_BATCH_CHARACTERS = 8 << 20
_BATCH_ROWS = 2_000
_HELD_BYTES = 16 << 20
_BUFFER_BYTES = 256 << 10
_MEMBER_WEIGHT = 2 << 10  # opening a member takes as long as reading about so many bytes
_ENCRYPTED = 1


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The ``*.zip`` files of a folder, by path; none if the folder is missing."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string")
    return files.select("path")


class StorageError(Exception):
    """A file system that fails to deliver bytes: no fault of the archive, so the task fails and is tried again."""


class _Seekable(io.RawIOBase):
    """A pyarrow file whose seeks fail as Python's do, as the ZIP reader expects of short files."""

    def __init__(self, file):
        self._file = file

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        try:
            data = self._file.read(len(buffer))
        except OSError as error:
            raise StorageError(str(error)) from error
        buffer[: len(data)] = data
        return len(data)

    def tell(self) -> int:
        return self._file.tell()

    def seek(self, offset: int, whence: int = 0) -> int:
        try:
            return self._file.seek(offset, whence)
        except ValueError as error:
            raise OSError(str(error)) from error

    def close(self) -> None:
        self._file.close()
        super().close()


class _Unlisted(zipfile.ZipFile):
    """An archive whose list was read before, by ``directory``: members are opened by what it says of them."""

    def _RealGetContents(self) -> None:
        pass


def _open(path: str, reader: type[zipfile.ZipFile] = zipfile.ZipFile) -> zipfile.ZipFile:
    """Open an archive by the path Spark gives, in which nothing is escaped."""
    remote = re.match(r"(?!file:)([a-z][a-z0-9+.-]*://[^/]+)/(.*)", path, re.S)
    if remote:
        system, root = fs.FileSystem.from_uri(f"{remote.group(1)}/")
        inner = f"{root.rstrip('/')}/{remote.group(2)}"
    else:
        system, inner = fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    # neighbours are read from one buffer
    return reader(io.BufferedReader(_Seekable(system.open_input_file(inner)), _BUFFER_BYTES))


def manifest(archives: DataFrame, contains: str = "xml") -> DataFrame:
    """Members of the archives whose name contains ``xml``: path, member, position, bytes.

    ``position`` counts them within their archive, to take single ones or a stretch.  A file that
    is no archive is one row without member, at position -1.
    """
    return directory(archives, contains).drop("place")


def directory(archives: DataFrame, contains: str = "xml") -> DataFrame:
    """The ``manifest`` with the ``place`` of each member, by which ``member_texts`` opens it without the list.

    Of members of one name each has the place of the last, the one that Python opens by that name.
    """

    def rows(path: str) -> Iterator[tuple]:
        try:
            with _open(path) as archive:
                named = (i for i in archive.infolist() if contains in i.filename)
                for n, i in enumerate(named):
                    at = archive.getinfo(i.filename)
                    yield path, i.filename, n, i.file_size, {k: getattr(at, v) for k, v in _PLACE.items()}
        except zipfile.BadZipFile:
            yield path, None, -1, 0, None

    def members(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                listed = rows(path)
                while some := list(islice(listed, _BATCH_ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), _LISTED.types, strict=True)], schema=_LISTED)

    return archives.select("path").mapInArrow(members, f"{_MANIFEST}, place struct<{_PLACE_TYPES}>")


def fingerprints(archives: DataFrame) -> DataFrame:
    """``(path, archive, fingerprint)``: a digest of the names, sizes and checksums that an archive lists.

    Only the list at an archive's end is read.  A file that is no archive has the fingerprint
    ``none``.  Order counts, the times of the members do not.
    """

    def digests(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            marks = []
            for path in batch["path"]:
                try:
                    with _open(path) as archive:
                        listed = [f"{i.filename}/{i.file_size}/{i.CRC}/{i.flag_bits & _ENCRYPTED}" for i in archive.infolist()]
                    marks.append(hashlib.sha256("\n".join(listed).encode("utf-8", "surrogatepass")).hexdigest())
                except zipfile.BadZipFile:
                    marks.append("none")
            yield pd.DataFrame({"path": batch["path"], "fingerprint": marks})

    found = archives.select("path").mapInPandas(digests, "path string, fingerprint string")
    return found.select("path", F.substring_index("path", "/", -1).alias("archive"), "fingerprint")


def member_texts(
    members: DataFrame,
    record: str,
    *,
    partition_bytes: int = PARTITION_BYTES,
    document_bytes: int = documents.DOCUMENT_BYTES,
) -> DataFrame:
    """Records of the listed members, as documents: path, member, part, xml.

    The list of members is stored and dealt to tasks by size, neighbours together, so that a large
    archive is read by many tasks while a task still writes to few archives' partitions.  A damaged
    member (by any way of compression), one that is encrypted, and an archive that cannot be opened,
    is one row without xml.
    """
    members = materialize(members)
    if "place" not in members.columns:
        members = members.withColumn("place", F.lit(None))
    weight = F.col("bytes") + _MEMBER_WEIGHT
    sums = members.groupBy("path").agg(F.sum("bytes").alias("bytes"), F.sum(weight).alias("__all"))
    sums = materialize(sums)
    total, heavy = sums.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("__all"), F.lit(0))).first()
    tasks = int(max(members.sparkSession.sparkContext.defaultParallelism, -(-total // partition_bytes)))
    share = max(1, -(-heavy // tasks))
    # every task gets the same weight: a stretch of the archives, one after the other by path
    earlier = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    begins = sums.select("path", F.coalesce(F.sum("__all").over(earlier), F.lit(0)).alias("__begin"))
    before = Window.partitionBy("path").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    at = F.col("__begin") + F.col("__until") - weight
    dealt = members.withColumn("__until", F.sum(weight).over(before)).join(begins, "path")
    dealt = dealt.withColumn("__task", F.least(F.floor(at / share), F.lit(tasks - 1)).cast("int"))
    dealt = dealt.select("path", "member", "bytes", "place", "__task").repartitionById(tasks, "__task").drop("__task")

    def info(archive: zipfile.ZipFile, member: str, place: dict | None) -> zipfile.ZipInfo:
        if place is None:
            return archive.getinfo(member)
        found = zipfile.ZipInfo(place["name"])
        for key, name in _PLACE.items():
            if key != "name":
                setattr(found, name, place[key])
        return found

    def listed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, str, int, str]]:
        # an archive is opened once a task, not once a batch of its members
        with ExitStack() as held:
            last, archive = None, None
            for batch in batches:
                for path, member, size, place in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if member is None:
                        yield path, None, 0, None
                        continue
                    if path != last:
                        held.close()
                        archive = held.enter_context(_open(path, _Unlisted) if place else _open(path))
                        last = path
                    found = info(archive, member, place)
                    if found.flag_bits & _ENCRYPTED:
                        yield path, member, 0, None
                        continue
                    try:
                        opened, hold = partial(archive.open, found), size <= _HELD_BYTES
                        cut = documents.documents(opened, record, document_bytes, hold=hold)
                        for part, text in enumerate(cut):
                            yield path, member, part, text
                    except documents.DAMAGED:
                        yield path, member, 0, None

    def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> pa.RecordBatch:
            columns = zip(zip(*held, strict=True), _TEXT_SCHEMA.types, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in columns], schema=_TEXT_SCHEMA)

        held, size = [], 0
        for row in listed(batches):
            held.append(row)
            size += len(row[3] or "")
            if size >= _BATCH_CHARACTERS or len(held) >= _BATCH_ROWS:
                yield made()
                held, size = [], 0
        if held:
            yield made()

    return dealt.mapInArrow(texts, _TEXTS)
