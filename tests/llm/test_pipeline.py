import base64
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import cases
import corpus_pipeline
from snapweave.llm import language, secrets
from test_mixing import plain_targets
from test_packing import checked
from test_secrets import LITERAL, brute
from test_overlap import shingles
from test_simhash import union


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """The rows that went into each stage and came out, read again from Parquet each time."""
    path = tmp_path_factory.mktemp("pipeline")
    rows = cases.documents() + [(2000 + i, cases.prose(3000 + i, 40 + i), "en", "ab"[i % 2], 3, "k", "copies") for i in range(30)]
    rows += [(1990, cases.prose(3000, 40), "en", "a", 3, None, None)]
    table = spark.createDataFrame(rows, cases.COLUMNS).withColumnsRenamed({"words": "copies", "size": "predicted"})
    table.write.parquet(f"{path}/documents.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    seen = [docs.collect()]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(path))
        if n < 4:
            assert out.dtypes == docs.dtypes
        out.write.parquet(f"{path}/{n}")
        docs = spark.read.parquet(f"{path}/{n}")
        seen.append(docs.collect())
    return str(path), seen


def counted(rows):
    return Counter(tuple(r) for r in rows)


def test_language(staged):
    before, after = staged[1][0], staged[1][1]
    kept = [r for r in before if any(c.isalpha() for c in r.text or "")]
    assert counted(after) == counted(kept)


def test_near_dedup(staged):
    """Of the texts that share four fifths of their runs of five words, the first stays."""
    before, after = staged[1][1], staged[1][2]
    kinds = sorted({frozenset(shingles(r.text)) for r in before}, key=sorted)
    close = [(x, y) for n, x in enumerate(kinds) for y in kinds[:n] if 5 * len(x & y) >= 4 * len(x | y)]
    numbers = {k: n for n, k in enumerate(kinds)}
    root = union([(numbers[x], numbers[y]) for x, y in close], range(len(kinds)))
    groups = defaultdict(list)
    for r in before:
        groups[root[numbers[frozenset(shingles(r.text))]]].append(r)
    best = [min(g, key=lambda r: (r.doc_id is None, r.doc_id or 0)) for g in groups.values()]
    assert counted(after) == counted(best)
    assert len(after) < len(before) - 3


def test_secrets(staged):
    before, after = staged[1][2], staged[1][3]
    added = [(r.kind, re.compile(r.pattern, re.A), r.group, r.least) for r in secrets.RULES[3:]]
    want = Counter()
    for r in before:
        out, at = "", 0
        for start, _, end, kind in brute(r.text, LITERAL + added):
            if start >= at:
                out += r.text[at:start] + f"[{kind}]"
            at = max(at, end)
        text = out + r.text[at:]
        want[tuple({**r.asDict(), "text": text, "n_chars": r.n_chars if len(text) == len(r.text) else len(text)}.values())] += 1
    assert counted(after) == want
    assert counted(after) != counted(before)


def test_mixing(staged):
    before, after = staged[1][3], staged[1][4]
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in before:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        sizes[r.source] += n
        largest[r.source] = max(largest[r.source], n)
    for r in after:
        taken[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert set(counted(after)) <= set(counted(before))
    for source, want in plain_targets(sizes).items():
        assert abs(taken[source] - want) <= largest[source]


def test_packing(staged):
    before, after = staged[1][4], staged[1][5]
    checked(after, [tuple(r) for r in before])


def test_run(spark, staged):
    path, seen = staged
    got = corpus_pipeline.run(spark, path).collect()
    assert sum(r.length for r in got) > 0
    assert {r.doc_id for r in got} <= {r.doc_id for r in seen[0]}
    assert [n for n, _ in corpus_pipeline.STAGES].index("packing") == 4


def test_empty_table(spark, empty_folder):
    assert corpus_pipeline.run(spark, empty_folder).count() == 0


def test_without_labels(spark, docs):
    """Without labels nothing can be told: that is an error, not an empty corpus."""
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert language.train(none).languages == []
    with pytest.raises(ValueError):
        corpus_pipeline.identify_language(spark, none, "")


def test_junk_goes_and_clean_documents_stay(spark):
    """Encoded bytes with letters in them go; documents of all lengths, short ones and ones with numbers, stay."""
    rng = random.Random(4)
    clean = [(i, cases.prose(i, 3 + i % 400), "en", "a", None, None, None) for i in range(600)]
    clean += [(700 + i, f"call +1 {rng.randrange(10**9)} token = {rng.randrange(10**20)} {cases.prose(i, 5)}", "en", "a", None, None, None) for i in range(20)]
    junk = [(900 + i, base64.b64encode(rng.randbytes(900)).decode(), None, "a", None, None, None) for i in range(20)]
    got = corpus_pipeline.identify_language(spark, spark.createDataFrame(clean + junk, cases.COLUMNS), "")
    assert sorted(r.doc_id for r in got.collect()) == [r[0] for r in clean]
