import random
from collections import Counter, defaultdict

import pytest

import cases
import corpus_pipeline
from snapweave.llm import overlap
from test_simhash import union


def shingles(text):
    found = (text or "").lower().split()
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def alike(a, b):
    a, b = shingles(a), shingles(b)
    return 5 * len(a & b) >= 4 * len(a | b)


def edited(text, rng, edits):
    found = text.split()
    for _ in range(edits):
        found[rng.randrange(len(found))] = f"edit{rng.randrange(10**6)}"
    return " ".join(found)


def texts():
    """Edited copies on both sides of the limit, one large group of them, short and odd texts."""
    rng = random.Random(11)
    made = [t for _, t, *_ in cases.documents()]
    for i in range(60):
        text = cases.prose(500 + i, rng.randint(60, 400))
        made += [text, edited(text, rng, len(text.split()) // rng.choice([30, 45, 60, 90])), f"{text} more"]
    made += [edited(cases.prose(9, 300), rng, 3) for _ in range(150)]
    return made


def test_components_against_all_pairs(spark, rows):
    made = texts()
    table = spark.createDataFrame(list(enumerate(made)), "k long, text string")
    pairs = [(i, j) for j in range(len(made)) for i in range(j) if alike(made[i], made[j])]
    assert len(pairs) > 5000
    assert rows(overlap.near_duplicates(table, "k")) == sorted(union(pairs, range(len(made))).items(), key=repr)


def crowd(variants, near, seed, words=400, edits=11):
    """Variants of one text that lie just below the limit, and copies of some that lie above it."""
    rng = random.Random(seed)
    base = cases.prose(seed, words)
    made = [base] + [edited(base, rng, edits) for _ in range(variants)]
    return made + [edited(rng.choice(made), rng, 5) for _ in range(near)]


def brute(made):
    """Roots by all pairs, intersections counted through an index of shingles."""
    sets, where = [shingles(t) for t in made], defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            where[x].append(n)
    pairs = []
    for n, s in enumerate(sets):
        common = Counter(m for x in s for m in where[x] if m < n)
        pairs += [(m, n) for m, c in common.items() if 5 * c >= 4 * (len(s) + len(sets[m]) - c)]
    empty = [n for n, s in enumerate(sets) if not s]
    return pairs + [(empty[0], n) for n in empty[1:]]


@pytest.mark.parametrize("nodes, edits", [(100, 11), (2048, 12)])
def test_crowd_below_the_limit_loses_no_link(spark, rows, monkeypatch, nodes, edits):
    """Hundreds of texts at 0.70 to 0.79 of each other share buckets with the few that link."""
    monkeypatch.setattr(overlap, "CROWD_NODES", nodes)
    made = crowd(700, 60, 31, edits=edits) + crowd(300, 40, 32, words=60, edits=1) + texts()[:60]
    table = spark.createDataFrame(list(enumerate(made)), "k long, text string")
    want = union(brute(made), range(len(made)))
    assert 300 < len(set(want.values())) < len(made)
    assert rows(overlap.near_duplicates(table, "k")) == sorted(want.items(), key=repr)


def test_proposed_buckets(spark, rows):
    """What a caller proposes is compared too, and links only if it is similar."""
    made = [cases.prose(1, 200), cases.prose(1, 200) + " more", cases.prose(2, 200), cases.prose(2, 200) + " more", ""]
    table = spark.createDataFrame(list(enumerate(made)), "k long, text string")
    for groups in ([(0, 5), (1, 5), (2, 5), (3, 5), (4, 5)], [(0, 5), (2, 5)], []):
        proposed = spark.createDataFrame(groups, "k long, bucket long")
        assert rows(overlap.near_duplicates(table, "k", proposed=proposed)) == [(0, 0), (1, 0), (2, 2), (3, 2), (4, 4)]


def test_stage_drops_edited_copies(spark, tmp_path):
    rng = random.Random(12)
    made = [cases.prose(700 + i, 300) for i in range(20)]
    made += [edited(t, rng, 4) for t in made]
    docs = spark.createDataFrame([(i, t, "en", "a", None, None, None) for i, t in enumerate(made)], cases.COLUMNS)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted(r.doc_id for r in got.collect()) == list(range(20))


def test_no_rows(spark):
    assert overlap.near_duplicates(spark.createDataFrame([], "k long, text string"), "k").count() == 0
