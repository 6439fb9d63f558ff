import random
import struct
import zlib
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import cases
from snapweave.llm import packing, tokens, workload

ODD = ["Σίσυφος ΣΑΣ. don't İstanbul. été ́x a b\x1cc <|endoftext|>x We'll!!! x.y,z 12345 ÄÖ. ß, straße?!",
       " line\u0085 tab\x0b日本語 テスト。 naïve— “q” 😀😀. İ. ǅ, ﬁ. _a_ __ A1b2."]


def reference_ids(text):
    whole = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return whole.encode(text or "", add_special_tokens=False).ids


def test_words_give_the_ids_of_the_text():
    texts = ODD + [t for _, t, *_ in cases.documents()]
    encoder = tokens.WordEncoder(cached=50)  # forgets again and again
    for text in texts + texts:
        got = encoder.encode(text)
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == reference_ids(text)


def test_words_spelled_otherwise_are_encoded_once():
    encoder = tokens.WordEncoder()
    texts = ["House. HOUSE house,, House!? house", "h\u0331 H\u0331. h\u0331 H", "<|ENDOFTEXT|> <|endoftext|>. a.", "x*** X$ don't. 'S."]
    for text in texts:
        got = encoder.encode(text.encode())
        assert list(struct.unpack(f"<{len(got) // 4}I", got)) == reference_ids(text)
    learned = tokens.WordEncoder()
    learned.encode(texts[0])
    assert set(learned._known) == {b"house", b".", b",,", b"!?"}


def test_words_met_lately_are_not_forgotten():
    encoder = tokens.WordEncoder(cached=20)
    for n in range(100):
        encoder.encode(f"often {cases.prose(n, 1)} x{n}")
        assert b"often" in {**encoder._known, **encoder._before} and len(encoder._known) + len(encoder._before) <= 20


def plain_first_fit(lengths, capacity):
    rooms, placed = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        bin_ = next((b for b, r in enumerate(rooms) if r >= lengths[i]), len(rooms))
        if bin_ == len(rooms):
            rooms.append(capacity)
        placed[i] = (bin_, capacity - rooms[bin_])
        rooms[bin_] -= lengths[i]
    return placed


def test_tournament_tree_is_first_fit_decreasing():
    rng = random.Random(3)
    for n in (0, 1, 2, 7, 300):
        lengths = [rng.choice([1, 3, 64, rng.randint(1, 100), 100]) for _ in range(n)]
        assert packing.first_fit_decreasing(lengths, 100) == plain_first_fit(lengths, 100)


def checked(rows, docs):
    """Every id in exactly one piece, every sequence gapless and within the limit."""
    want = defaultdict(int)
    for doc_id, text, *_ in docs:
        ids = [*reference_ids(text), 1]
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            want[doc_id, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)), len(ids)] += 1
    got, sequences = defaultdict(int), defaultdict(list)
    for r in rows:
        got[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences), sum(r.length for r in rows)


def test_query(spark, folder, rows):
    got = workload.op8_packing(spark, folder)
    sequences, total = checked(got.collect(), cases.documents())
    assert sequences <= total // 2048 + 2
    assert rows(got) == rows(workload.op8_packing(spark, folder))


def test_many_groups_and_large_ids(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(packing, "GROUP", 20)
    docs = [((1 << 60) + i, cases.prose(i, 30 + i * 53 % 900), None, None, None, None, None) for i in range(150)]
    spark.createDataFrame(docs, cases.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    checked(workload.op8_packing(spark, str(tmp_path)).collect(), docs)


def test_empty_table(spark, empty_folder):
    assert workload.op8_packing(spark, empty_folder).count() == 0
