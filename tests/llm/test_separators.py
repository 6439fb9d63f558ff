import random
from collections import Counter

import numpy as np
import pytest

import cases
from snapweave.llm import separators, workload
from test_packing import ODD, reference_ids


def brute(file, ids):
    out, start = [], 0
    for n, at in enumerate([*np.flatnonzero(ids == separators.END).tolist(), None]):
        if at is None:
            if start < len(ids):
                out.append((file, n, start, len(ids) - start, False))
        else:
            out.append((file, n, start, at + 1 - start, True))
            start = at + 1
    return out


@pytest.mark.parametrize("run", [1024, 3])
def test_documents_across_blocks(spark, rows, run):
    """Blocks without, with one, with only separators; empty and null ones; files that end open."""
    rng = random.Random(run)
    blocks, expected = [], []
    for file in range(6):
        ids = np.array([separators.END if rng.random() < (0.3, 0.02, 0.0)[file % 3] else rng.randrange(40_000) for _ in range(900)], separators.ID)
        at, number = 0, 0
        while at < len(ids):
            step = rng.choice([0, 1, 7, 90])
            blocks.append((file, number, None if not step and number % 2 else bytearray(ids[at : at + step].tobytes()), "x"))
            at, number = at + step, number + 1
        expected += brute(file, ids)
    rng.shuffle(blocks)
    table = spark.createDataFrame(blocks, "file long, block long, tokens binary, start string")
    assert rows(separators.count_tokens(table, run=run)) == sorted(expected, key=repr)


def test_query(spark, folder):
    got = workload.op7_token_counts(spark, folder).collect()
    want = Counter(len(reference_ids(text)) + 1 for _, text, *_ in cases.documents())
    assert Counter(r.n_tokens for r in got) == want
    assert all(r.ended for r in got)


def test_texts_that_spell_the_tokenizers_own_tokens(spark):
    """The vocabulary's end-of-text token in a text does not end a document."""
    texts = [*ODD, "<|endoftext|>", "a <|endoftext|> b <|startoftext|><|endoftext|>", "plain", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    got = separators.count_tokens(separators.write_flat(docs, block=5)).orderBy("doc_no").collect()
    assert [r.n_tokens for r in got] == [len(reference_ids(t)) + 1 for t in texts]


def test_a_vocabulary_that_reaches_the_separator(spark, docs, monkeypatch):
    monkeypatch.setattr(separators, "END", 49_407)
    with pytest.raises(ValueError):
        separators.write_flat(docs)


def test_written_in_order(spark, docs):
    one = docs.coalesce(1)
    blocks = separators.write_flat(one, block=100)
    got = separators.count_tokens(blocks).orderBy("doc_no").collect()
    assert [r.n_tokens for r in got] == [len(reference_ids(r.text)) + 1 for r in one.collect()]
    assert max(len(r.tokens) for r in blocks.collect()) == 200


def test_empty_table(spark, empty_folder):
    assert workload.op7_token_counts(spark, empty_folder).count() == 0
