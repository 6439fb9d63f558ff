import random

import numpy as np
import pytest
import xxhash

import cases
from snapweave.llm import components, simhash, workload


def plain_fingerprint(text):
    """The definition, word for word."""
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def union(pairs, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close_pairs(values, bits):
    values = sorted(values)
    return [(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if (a ^ b).bit_count() <= bits]


def test_query_against_brute_force(spark, folder, rows):
    docs = [(r[0], plain_fingerprint(r[1])) for r in cases.documents()]
    root = union(close_pairs({f for _, f in docs}, 2), {f for _, f in docs})
    least = {}
    for doc_id, value in docs:
        if doc_id is not None:
            least[root[value]] = min(doc_id, least.get(root[value], doc_id))
    expected = sorted(((d, f"{v:016x}", least.get(root[v])) for d, v in docs), key=repr)
    assert rows(workload.op9_simhash(spark, folder)) == expected
    assert len({e[2] for e in expected}) < len({e[0] for e in expected}) - 2


@pytest.mark.parametrize("hot, segments, bits", [(64, 2, 2), (1, 2, 2), (3, 4, 2), (64, 3, 4), (2, 2, 4)])
def test_links_connect_as_all_pairs_do(spark, monkeypatch, hot, segments, bits):
    """Chains, balls and shared segments, with and without hot segment values."""
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    rng = random.Random(hot + segments)
    values = {rng.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for centre in list(values)[:8]:
        for _ in range(12):
            centre ^= 1 << rng.randrange(64) | 1 << rng.randrange(64)
            values.add(centre)
    centre = rng.getrandbits(64)
    values |= {centre ^ (1 << rng.randrange(32)) ^ (1 << rng.randrange(32)) for _ in range(40)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    table = spark.createDataFrame([(v,) for v in signed], "value long")
    found = [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in simhash.links(table, bits, segments).collect()]
    assert all((a ^ b).bit_count() <= bits for a, b in found)
    assert union(found, values) == union(close_pairs(values, bits), values)


def test_components(spark, rows):
    rng = random.Random(5)
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 40)] + [(1020, -7)]
    loose = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)] + [(5000, 5000)]
    pairs = chain + star + loose + chain[:3]
    rng.shuffle(pairs)
    got = components.components(spark.createDataFrame([*pairs, (None, 3)], "a long, b long"))
    assert rows(got) == sorted(union(pairs, {n for p in pairs for n in p}).items(), key=repr)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprint_by_hand():
    assert simhash.fingerprint("A b") == np.uint64(xxhash.xxh64_intdigest(b"a b", seed=42)).astype(np.int64)
    assert simhash.fingerprint("") == simhash.fingerprint(None) == simhash.fingerprint(" \n") == 0


def test_empty_table(spark, empty_folder):
    assert workload.op9_simhash(spark, empty_folder).count() == 0
