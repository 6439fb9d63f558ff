import gzip
import random

import pytest

from snapweave.llm import merkle, workload


def record(n, body):
    return b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"


def archive(seed, n, files=3):
    """``{(file, offset): record}`` of files of odd sizes."""
    rng, out = random.Random(seed), {}
    for f in range(files):
        at = 0
        for i in range(n * (f + 1)):
            r = record(i, rng.randbytes(rng.choice([0, 3, 500, 9000])))
            out[f"f{f}.warc", at] = r
            at += len(r)
    return out


def table(spark, records):
    rows = [(f, o, r, 1) for (f, o), r in records.items()]
    return spark.createDataFrame(rows, "file string, offset long, record binary, digest int")


def brute(ours, theirs):
    out = []
    for key in ours.keys() | theirs.keys():
        a, b = ours.get(key), theirs.get(key)
        if a != b:
            out.append((*key, len(b if a is None else a), "missing" if b is None else "extra" if a is None else "changed"))
    return sorted(out, key=repr)


@pytest.mark.parametrize("span, fan_out", [(1 << 16, 16), (2000, 2)])
def test_finds_every_difference(spark, rows, span, fan_out):
    ours = archive(1, 40)
    theirs = dict(ours)
    keys = sorted(ours)
    for key in keys[5::37]:
        theirs[key] = theirs[key][:-1] + b"x"
    for key in keys[11::53]:
        del theirs[key]
    theirs["f0.warc", 10**6] = record(0, b"tail")
    theirs["new.warc", 0] = record(0, b"")
    a = merkle.build(table(spark, ours), span, fan_out)
    b = merkle.build(table(spark, theirs), span, fan_out)
    assert rows(merkle.audit(a, b, span, fan_out)) == brute(ours, theirs)
    assert merkle.audit(a, merkle.build(table(spark, ours).orderBy("digest"), span, fan_out), span, fan_out).count() == 0


def test_repeated_and_null_records(spark, rows):
    ours = [("f", 0, b"a"), ("f", 0, b"b"), ("f", 10, None), (None, 3, b"x"), ("f", None, b"y")]
    theirs = [("f", 0, b"a"), ("f", 0, b"c"), ("f", 10, b"")]
    a, b = (merkle.build(spark.createDataFrame(r, "file string, offset long, record binary")) for r in (ours, theirs))
    assert rows(merkle.audit(a, b)) == [("f", 0, 1, "changed")]


def test_reads_archive_files(spark, tmp_path):
    records = archive(2, 10, files=2)
    for f in range(2):
        data = b"".join(records[k] for k in sorted(records) if k[0] == f"f{f}.warc")
        (tmp_path / f"f{f}.warc").write_bytes(gzip.compress(data) if f else data)
    got = merkle.read_archive(spark, str(tmp_path))
    assert {(r.file, r.offset): bytes(r.record) for r in got.collect()} == records


def test_damaged_archive():
    whole = record(0, b"abc")
    assert merkle.split_records(whole + b"junk") == [(0, whole), (len(whole), b"junk")]
    assert merkle.split_records(b"") == []
    assert merkle.split_records(whole[:-6]) == [(0, whole[:-6])]


def test_odd_pages(spark, tmp_path, rows):
    pages = [(7, "u", "é" * 3), (7, "u", "é" * 3), (8, None, None), (None, "v", "w"), (11, "", ""), (5000, "a", "b" * 70000)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = rows(workload.op2_merkle_audit(spark, str(tmp_path)))
    assert sorted(g[3] for g in got) == ["changed", "changed", "missing"]


def test_empty_table(spark, empty_folder):
    assert workload.op2_merkle_audit(spark, empty_folder).count() == 0
