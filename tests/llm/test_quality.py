import math
import re
from collections import Counter

import xxhash

import cases
from snapweave.llm import quality, workload

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def signed(n):
    return n - (1 << 64) if n >> 63 else n


def word_hash(word, seed=42):
    return signed(xxhash.xxh64_intdigest(word.encode(), seed=seed))


def pair_hash(a, b):
    first = xxhash.xxh64_intdigest(a.to_bytes(8, "little", signed=True), seed=42)
    return signed(xxhash.xxh64_intdigest(b.to_bytes(8, "little", signed=True), seed=first))


def grams(text):
    hashes = [word_hash(w) for w in WORD.findall(text or "")]
    return [h % quality.BUCKETS for h in hashes + [pair_hash(a, b) for a, b in zip(hashes, hashes[1:])]]


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def expected(rows, trusted):
    raw, target = [1] * quality.BUCKETS, [1] * quality.BUCKETS
    for doc_id, text, *_ in rows:
        for g in grams(text):
            raw[g] += 1
            target[g] += doc_id in trusted
    a, b = sum(raw), sum(target)
    shift = math.log2(a) - math.log2(b)
    ratios = [round((math.log2(t) - math.log2(r) + shift) * quality.SCALE) for t, r in zip(target, raw)]
    out = []
    for doc_id, text, *_ in rows:
        found = grams(text)
        total, n = sum(ratios[g] for g in found), len(found) + quality.SHRINK
        facts = base(text)
        out.append((doc_id, *facts, len(found), not facts[-1] and total >= round(quality.MIN_SCORE * quality.SCALE) * n))
    return sorted(out, key=repr)


def test_against_brute_force(spark, folder, rows):
    got = workload.op3_quality_rules(spark, folder).drop("llr")
    trusted = {i for i in range(30) if i % 3 != 0 and i % 7 != 0}
    assert rows(got) == expected(cases.documents(), trusted)


def test_low_scores_are_dropped(spark, rows):
    """A text of words the trusted ones never use is dropped, trusted texts stay."""
    clean = [(i, cases.prose(i, 200)) for i in range(30)]
    junk = [(100 + i, " ".join(f"@{i}{k}" for k in range(200))) for i in range(10)]
    docs = spark.createDataFrame(clean + junk, "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(25)], "doc_id long")
    got = quality.quality(docs, quality.log_ratios(docs, trusted)).collect()
    kept = {r.doc_id for r in got if r.kept}
    assert kept >= set(range(25)) and not kept & set(range(100, 110))


def test_no_trusted_documents(spark, docs):
    none = spark.createDataFrame([], "doc_id long")
    ratios = quality.log_ratios(docs, none)
    assert not any(ratios)
    assert all(r.kept != r.base_failed for r in quality.quality(docs, ratios).collect())


def test_empty_table(spark, empty_folder):
    assert workload.op3_quality_rules(spark, empty_folder).count() == 0
