"""Small helpers that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
"""A word: a run of anything but the six ASCII white-space characters."""


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once a session, so that their Python can import it.

    Imported modules stay with a worker from task to task, and with them what they remember.
    """
    context = spark.sparkContext
    package = Path(__file__).resolve().parents[1]
    if context.applicationId in _shipped or not package.is_dir():
        return
    _shipped.add(context.applicationId)
    packed = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(packed, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(packed))


def lean() -> None:
    """Give back what earlier tasks left in this Python worker: vocabularies, freed memory.

    Called by work that goes through whole texts and needs no vocabulary.
    """
    tokens = sys.modules.get("snapweave.llm.tokens")
    if tokens is not None:
        tokens.forget()
    trim()


def trim() -> None:
    """Give memory that nothing uses any more back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such function
        ctypes.CDLL(None).malloc_trim(0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda.

    A column used in a lambda's body would otherwise be computed again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """All words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def share_kept(rows: int, bound: int) -> int:
    """How many of a million hash values to keep so that about ``bound`` of ``rows`` rows stay."""
    return 1_000_000 if rows <= bound else bound * 1_000_000 // rows


def in_share(key: Column, kept: int | Column) -> Column:
    """Whether a row is in the share: a fixed choice by key, the same in every run."""
    return F.pmod(F.xxhash64(key.cast("string"), F.lit("share")), F.lit(1_000_000)) < kept
