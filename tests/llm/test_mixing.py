import math
import re
from collections import Counter, defaultdict

import pytest
import xxhash

import cases
from snapweave.llm import mixing, workload

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    want = {n: 1.5 * sum(sizes.values()) * weight[n] / sum(weight.values()) for n in names}
    while any(want[n] > 2 * sizes[n] + 1e-9 for n in names):
        full = {n for n in names if want[n] >= 2 * sizes[n] - 1e-9}
        excess = sum(want[n] - 2 * sizes[n] for n in full)
        rest = sum(weight[n] for n in names if n not in full)
        want = {n: 2.0 * sizes[n] if n in full else want[n] + excess * weight[n] / rest for n in names}
    return want


def checked(rows, docs):
    sizes = defaultdict(int)
    for _, text, _, source, *_ in docs:
        sizes[source] += len(WORD.findall(text or ""))
    want, taken, largest = plain_targets(sizes), defaultdict(int), defaultdict(int)
    assert len(rows) == len(docs)
    by_size = defaultdict(set)
    for source, size in sizes.items():
        by_size[size].add(source)
    for r in rows:
        source = min((s for s in by_size[r.source_size] if math.isclose(want[s], r.target, abs_tol=1e-6)), key=str)
        assert r.taken in (0, r.size, 2 * r.size)
        assert r.size == 0 or r.taken / r.size in (math.floor(r.target / r.source_size), math.ceil(r.target / r.source_size))
        taken[source] += r.taken
        largest[source] = max(largest[source], r.size)
    for source in sizes:
        assert abs(taken[source] - want[source]) <= largest[source]


def test_query(spark, folder, rows):
    got = workload.op10_mixing(spark, folder)
    checked(got.collect(), cases.documents())
    assert rows(got) == rows(workload.op10_mixing(spark, folder))


@pytest.mark.parametrize("fan_in", [4, 256])
def test_levels(spark, monkeypatch, tmp_path, fan_in):
    """A source with most rows, rounded in one level or in many, keeps its sum to within one document."""
    monkeypatch.setattr(mixing, "FAN_IN", fan_in)
    docs = [(i, "w " * (1 + i * 37 % 90), None, ["hot", "b", None, "é", "z"][min(4, i % 7)], None, None, None) for i in range(600)]
    spark.createDataFrame(docs, cases.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    checked(workload.op10_mixing(spark, str(tmp_path)).collect(), docs)


def test_expectation(spark):
    """Units are rounded up as often as their mass says."""
    units = [("s", i, i, 1 + i % 9, (1 + i % 9) * 0.3) for i in range(4000)]
    got = mixing.pivotal_rounding(spark.createDataFrame(units, "source string, id long, key long, size long, mass double"))
    ups = {r.id: r.up for r in got.collect()}
    assert len(ups) == 4000
    for size in range(1, 10):
        of = [ups[i] for _, i, _, s, _ in units if s == size]
        assert abs(sum(of) / len(of) - 0.3) < 0.08
    assert abs(sum(s * ups[i] for _, i, _, s, _ in units) - 0.3 * sum(u[3] for u in units)) <= 9


def digest(*values):
    """What ``xxhash64`` gives: each value's XXH64 with the one before as seed, nulls passed over."""
    found = 42
    for v in values:
        if v is not None:
            raw = v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True)
            found = xxhash.xxh64_intdigest(raw, found)
    return found - (1 << 64) if found >> 63 else found


def literal(found, *values):
    """Numbers that are literals are hashed as 32 bits."""
    for v in values:
        found = xxhash.xxh64_intdigest(v.to_bytes(4, "little", signed=True), found & ((1 << 64) - 1))
    return found - (1 << 64) if found >> 63 else found


def uniform(*keys):
    return ((literal(digest(*keys), mixing.SEED) & ((1 << 64) - 1)) >> 11) / (1 << 53)


def plain_rounding(units):
    """Which of ``(key, size, mass)`` of one source are rounded up; the groups are those of all sources."""
    taken, left, level = set(), units, 0
    groups = max(1, math.ceil(sum(map(len, units.values())) / mixing.FAN_IN))
    while True:
        rest = {}
        for source, of in left.items():
            by = defaultdict(list)
            for unit in of:
                by[literal(digest(unit[0]), level, mixing.SEED) % groups].append(unit)
            for members in by.values():
                members.sort(key=lambda u: (literal(digest(u[0]), mixing.SEED), u[1]))
                a = members[0]
                for x in members[1:]:
                    gain, loss = min(a[1] - a[2], x[2]), min(a[2], x[1] - x[2])
                    if uniform(a[0], x[0]) * (gain + loss) < loss:
                        moved, settled = gain, a[1] - a[2] <= x[2]
                        taken |= {a[0]} if settled else set()
                    else:
                        moved, settled = -loss, a[2] <= x[1] - x[2]
                        taken |= set() if settled else {x[0]}
                    a = (x[0], x[1], x[2] - moved) if settled else (a[0], a[1], a[2] + moved)
                rest.setdefault(source, []).append(a)
        left = rest
        if groups == 1:
            return taken | {u[0] for of in left.values() for u in of if literal(digest(u[0]), -1, mixing.SEED) % (1 << 64) / (1 << 64) * u[1] < u[2]}
        groups, level = math.ceil(groups / mixing.FAN_IN), level + 1


@pytest.mark.parametrize("fan_in", [5, 256])
def test_same_as_plain_rounding_on_any_layout(spark, monkeypatch, fan_in):
    """Repeated, null and weightless rows among them, in 1, 4 and 7 partitions and any order."""
    monkeypatch.setattr(mixing, "FAN_IN", fan_in)
    docs = [(i, ["hot", "b", None, "é", "z"][min(4, i % 7)], i * 37 % 90) for i in range(400)]
    docs += [docs[3]] * 60 + [(None, None, 12)] * 50 + [(None, "hot", 0)] * 20 + [docs[8], docs[8]]
    sizes = defaultdict(int)
    for _, source, size in docs:
        sizes[source] += size
    want = plain_targets(sizes)
    units, copies, number = defaultdict(list), defaultdict(list), Counter()
    for doc in docs:
        key = digest(digest(*doc), number[doc] + (number[doc] > 0 or docs.count(doc) > 1))
        number[doc] += 1
        share = want[doc[1]] / sizes[doc[1]]
        copies[doc].append((key, math.floor(share), share - math.floor(share)))
        mass = doc[2] * (share - math.floor(share))
        if 0 < mass < doc[2]:
            units[doc[1]].append((key, doc[2], mass))
    up = plain_rounding(units)
    expected = Counter()
    for doc, found in copies.items():
        for key, whole, rest in found:
            extra = key in up if doc[2] else (literal(digest(key), -2, mixing.SEED) % (1 << 64) >> 11) / (1 << 53) < rest
            expected[*doc, whole + extra] += 1
    for parts in (1, 4, 7):
        table = spark.createDataFrame(docs, "doc_id long, source string, n long").repartition(parts)
        got = mixing.mix(table, size="n").select("doc_id", "source", "n", "copies").collect()
        assert Counter(map(tuple, got)) == expected


def test_all_columns_stay(spark, docs):
    got = mixing.mix(docs.withColumn("n", mixing.count_words(docs.text)), size="n")
    assert got.columns == [*docs.columns, "n", "source_size", "target", "copies"]
    assert got.count() == docs.count()


def test_empty_table(spark, empty_folder):
    assert workload.op10_mixing(spark, empty_folder).count() == 0
