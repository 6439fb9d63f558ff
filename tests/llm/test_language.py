import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

import cases
from snapweave.llm import language, workload

SOUNDS = {"xx": "ka lo mi tu ra né".split(), "yy": "sch ung keit ber ö".split(), "zz": "tion ment que ais ç".split()}


def text_of(lang, seed, n=60):
    rng = random.Random(f"{lang}{seed}")
    return " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 4))) for _ in range(n))


def counted(texts):
    rows = Counter()
    for lang, text in texts:
        data = text.encode()
        for length in range(language.ORDER + 1):
            for i in range(length, len(data)):
                rows[lang, length, int.from_bytes(data[i - length : i + 1], "big")] += 1
    kept = [(*k, n) for k, n in rows.items() if k[1] < 2 or n >= language.SEEN]
    return pd.DataFrame(kept, columns=["lang", "length", "code", "seen"])


def plain_bits(ngrams, lang, data):
    """Prediction by partial matching from the counts, a byte at a time."""
    followed, best = defaultdict(dict), Counter()
    for row in ngrams.itertuples():
        if row.lang == lang:
            best[row.length, row.code >> 8] += row.seen
            followed[row.length, row.code >> 8][row.code & 255] = row.seen

    def probability(length, context, byte):
        if length < 0:
            return 1 / 256
        shorter = probability(length - 1, context & (1 << 8 * max(0, length - 1)) - 1, byte)
        seen = followed.get((length, context), {})
        whole = sum(seen.values()) + len(seen)
        return shorter if not seen else seen[byte] / whole if byte in seen else shorter * len(seen) / whole

    total = 0
    for i, byte in enumerate(data):
        length = 0
        while length < min(language.ORDER, i):
            wider = int.from_bytes(data[i - length - 1 : i], "big")
            n = best.get((length + 1, wider), 0)
            if not n or length + 1 >= 2 and n < language.CONTEXT_SEEN:
                break
            length += 1
        context = int.from_bytes(data[i - length : i], "big")
        total += round(-math.log2(probability(length, context, byte)) * 65536)
    return total


def compiled(ngrams):
    return language.Model(sorted(SOUNDS), [language.compile_tree(ngrams[ngrams["lang"] == lang]) for lang in sorted(SOUNDS)])


def test_tables_give_exact_code_lengths(monkeypatch):
    monkeypatch.setattr(language, "_SLICE", 40)
    ngrams = counted([(lang, text_of(lang, s)) for lang in SOUNDS for s in range(4)])
    model = compiled(ngrams)
    texts = [text_of(lang, 50, n) for lang in SOUNDS for n in (1, 7, 60)] + ["", "x", "Ωkalo\x00mi", "ka" * 100]
    got = model.code_lengths([t.encode() for t in texts])
    want = [[plain_bits(ngrams, lang, t.encode()) for lang in sorted(SOUNDS)] for t in texts]
    assert np.array_equal(got, np.array(want))


@pytest.fixture(scope="module")
def spoken(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("spoken"))
    docs = [(i, text_of(lang, i, 5 + i % 60), lang) for i in range(400) for lang in [sorted(SOUNDS)[i % 3]]]
    docs += [(1000, None, "xx"), (1001, "", "yy"), (1002, "12 !!", "xx"), (1003, text_of("xx", 3), None), (None, text_of("yy", 3), "yy")]
    rows = [(i, t, lang, "s", None, "w", "z") for i, t, lang in docs]
    spark.createDataFrame(rows, cases.COLUMNS).write.parquet(f"{path}/documents.parquet")
    return path, rows


def test_query(spark, spoken, rows):
    path, docs = spoken
    got = workload.op6_language_id(spark, path)
    by_id = {r.doc_id: r for r in got.collect()}
    assert got.count() == len(docs)
    for doc_id, text, lang, *_ in docs:
        r = by_id[doc_id]
        assert r.held_out == (zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
        if not any(c.isalpha() for c in text or ""):
            assert (r.lang_pred, r.score) == ("und", 0)
        elif lang:
            assert r.lang_pred == lang
    assert rows(got) == rows(workload.op6_language_id(spark, path))


def test_training_matches_brute_force(spark, spoken):
    path, docs = spoken
    model = language.train(spark.read.parquet(f"{path}/documents.parquet"))
    learned = [(d[2], d[1]) for d in docs if d[1] is not None and d[2] and zlib.crc32(("" if d[0] is None else str(d[0])).encode()) % 3 != 1]
    want = compiled(counted(learned))
    assert model.languages == want.languages
    text = [text_of("zz", 999).encode()]
    assert np.array_equal(model.code_lengths(text), want.code_lengths(text))


def test_more_documents_than_a_sample_would_hold(spark, monkeypatch):
    """What only one document of thousands says counts in the trees, and in what is usual."""
    monkeypatch.setattr(language, "_HELD", 3000)
    monkeypatch.setattr(language, "_COUNTED", 700)
    docs = [(i, text_of("xx", i % 50, 8), "xx", None, None, None, None) for i in range(5000)]
    free = [i for i in range(10_000, 10_400) if zlib.crc32(str(i).encode()) % 3 != 1]
    kept = [i for i in range(10_000, 10_400) if zlib.crc32(str(i).encode()) % 3 == 1]
    docs.append((free[0], "ЖЖЖ" + text_of("xx", 7, 300) + "щ" * 40, "xx", None, None, None, None))
    table = spark.createDataFrame(docs, cases.COLUMNS).repartition(3)
    learned = [(d[2], d[1]) for d in docs if zlib.crc32(str(d[0]).encode()) % 3 != 1]
    want = language.compile_tree(counted(learned))
    model = language.train(table)
    probe = [docs[-1][1].encode(), text_of("xx", 99).encode()]
    assert np.array_equal(model.code_lengths(probe), language.Model(["xx"], [want]).code_lengths(probe))
    odd = [(i, "щЖ9%" * 100, "xx", None, None, None, None) for i in kept[: language.TOLD_BY]]
    usual = language.usual_bits(spark.createDataFrame(docs + odd, cases.COLUMNS), model)
    assert usual[int(math.log2(600))] > 2 * usual[int(math.log2(len(docs[0][1])))]


def test_odd_documents(spark, folder):
    assert workload.op6_language_id(spark, folder).count() == len(cases.documents())


def test_empty_table(spark, empty_folder):
    assert workload.op6_language_id(spark, empty_folder).count() == 0


def many(n, each):
    """Documents of ``n`` languages of a few syllables each, the last language with two documents only."""
    rng = random.Random(6)
    letters = [chr(c) for c in [*range(97, 123), *range(0x430, 0x450), *range(0x3B1, 0x3C9)]]
    sounds = [["".join(rng.choices(letters, k=rng.randint(2, 3))) for _ in range(5)] for _ in range(n)]
    rows = []
    for i in range(n):
        for k in range(2 * each if i == n - 1 else each):
            words = ["".join(rng.choices(sounds[i], k=rng.randint(1, 3))) for _ in range(40)]
            rows.append((i * each + k, " ".join(words), f"l{i:03}", None, None, None, None))
    return rows


def test_hundreds_of_languages(spark):
    """None is left out for being one of many, or for having few documents."""
    docs = many(300, 4)
    table = spark.createDataFrame(docs, cases.COLUMNS).repartition(8)
    model = language.train(table)
    learned = {d[2] for d in docs if zlib.crc32(str(d[0]).encode()) % 3 != 1}
    assert model.languages == sorted(learned) and len(learned) > 290
    assert sum(t.size() for t in model.trees) < 300 << 20
    got = language.identify(table.filter("lang >= 'l200'"), model).select("lang", "predicted.lang_pred").collect()
    known = [r for r in got if r.lang in learned]
    assert sum(r.lang == r.lang_pred for r in known) >= 0.97 * len(known)


def test_trees_beyond_the_memory_set_for_them(spark, docs, monkeypatch):
    monkeypatch.setattr(language, "MODEL_BYTES", 1000)
    with pytest.raises(ValueError):
        language.train(docs)


def test_a_share_is_never_nothing(spark, docs):
    """A bound far below a millionth of the rows still keeps a millionth, not none."""
    assert set(language.train(docs, trained=0).languages) <= {"en", "fr"}
