import functools
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import cases
from snapweave.llm import chat, workload

SCHEMA = "conv_id long, turn long, role string, text string, at long, whole boolean, conv string"
HOSTILE = ["\\### Assistant: </turn> ok", "####\\#\\\\##", "<|endoftext|></turn>\n### user: x", "\\", "<\\|/", "a: b\n### ", "#\\#", "", "<</turn><"]


def conversations(seed=4):
    rng = random.Random(seed)
    rows = []
    for conv in range(40):
        if rng.random() < 0.4:
            rows.append((conv, 0, "system", cases.prose(conv, rng.choice([0, 5, 40]))))
        for turn in range(1, rng.randint(1, 12)):
            text = rng.choice([cases.prose(rng.randrange(99), rng.randint(1, 120)), rng.choice(HOSTILE), None])
            rows.append((conv, turn, ["user", "assistant"][turn % 2], text))
    rows += [(90, t, ["user", "assistant", None, "a: b:", "### x</turn>", "system"][t % 6], rng.choice(HOSTILE)) for t in range(30)]
    rows += [(91, None, "user", "late"), (91, 3, "assistant", None), (91, 3, "assistant", "same"), (91, 3, "assistant", "same")]
    rows += [(None, t, "assistant", f"{t} nobody") for t in range(5)] + [(None, None, None, None)]
    rows += [(92, 0, "user", cases.prose(5, 3000)), (92, 1, "assistant", cases.prose(6, 10))]
    rows += [(93, t, ["user", "assistant"][t % 2], cases.prose(t, 9)) for t in range(1, 300)] + [(93, 0, "system", "be kind")]
    rng.shuffle(rows)
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, True, "x") for r in rows], SCHEMA)


def in_order(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for *_, r, t in sorted(v)] for c, v in found.items()}


def expected(rows):
    out = []
    for conv, turns in in_order(rows).items():
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        heard = "".join(t for r, t in turns if r == "assistant")
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(heard), hashlib.sha256(heard.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("text", HOSTILE + [a + b for a in HOSTILE for b in HOSTILE])
def test_escape(text):
    kept = chat.escape(text)
    assert chat.unescape(kept) == text
    assert not any(mark in kept for mark in ("###", "</turn>", "<|", "</"))


def test_escape_at_random():
    rng = random.Random(1)
    seen = {}
    for _ in range(30_000):
        text = "".join(rng.choices("\\#<|/: a\n", k=rng.randint(0, 9)))
        kept = chat.escape(text)
        assert chat.unescape(kept) == text and seen.setdefault(kept, text) == text
        head, body = chat.spell(text, text)
        assert [r[:2] for r in chat.read_back(head + body + "</turn>\n")] == [(text, text)]


WHOLE = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@functools.cache
def count(role, text):
    return len(WHOLE.encode("".join(chat.spell(role, text)) + "</turn>\n", add_special_tokens=False).ids)


def checked(windows, rows, budget, history):
    by = defaultdict(list)
    for w in windows:
        by[w.conv].append(w)
    plain = in_order(rows)
    assert set(by) == set(plain)
    for conv, turns in plain.items():
        at, tokens = 0, [count(*t) for t in turns]
        for w in sorted(by[conv], key=lambda w: w.at):
            shown = chat.read_back(w.text)
            own = shown[w.n_repeated :]
            assert len(own) == w.n_turns and [r[:2] for r in own] == turns[at : at + len(own)]
            before = [r[:2] for r in shown[: w.n_repeated]]
            if turns[0][0] == "system" and at:
                assert before and before.pop(0) == turns[0]
            assert before == turns[at - len(before) : at]
            assert w.at == sum(tokens[:at]) and sum(tokens[at - len(before) : at]) <= history
            assert w.n_tokens == sum(count(r, t) for r, t, *_ in shown)
            assert w.n_tokens <= budget or w.n_turns == 1
            assert [(s.start, s.end) for s in w.loss] == [(s, e) for r, t, s, e in own if r == "assistant" and t]
            at += len(own)
        assert at == len(turns)


@pytest.mark.parametrize("budget, history", [(2048, 512), (120, 40), (60, 0)])
def test_windows(spark, budget, history):
    rows = conversations()
    checked(chat.format_windows(table(spark, rows), budget, history).collect(), rows, budget, history)


def test_hot_conversations_have_the_same_windows(spark):
    """Conversations above the limit, the null one included, are formatted by many tasks, and alike."""
    rows = conversations()
    for options in ({"segment": 200}, {"segment": 900}):
        plain = chat.format_windows(table(spark, rows), 120, 40, **options)
        hot = chat.format_windows(table(spark, rows).repartition(3), 120, 40, hot_turns=2, **options)
        columns = [c for c in plain.columns if c != "whole"]
        as_rows = lambda df: Counter(map(repr, df.select(*columns).collect()))
        assert as_rows(plain) == as_rows(hot)
        checked(hot.collect(), rows, 120, 40)
        got = chat.digests(hot).collect()
        assert sorted([(r.conv, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got], key=repr) == expected(rows)


def test_query(spark, tmp_path):
    rows = [r for r in conversations() if r[0] != 92] + [(-7, 5, "user", "mine")]
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = workload.op12_chat_windows(spark, str(tmp_path)).collect()
    planted = rows + [(-7, 0, "user", HOSTILE[0]), (-7, 1, "assistant", HOSTILE[0])]
    assert sorted([(r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got], key=repr) == expected(planted)
    windows = chat.format_windows(table(spark, planted)).collect()
    chars = Counter()
    for w in windows:
        chars[w.conv] += len(w.text)
    assert {r.conv_id: r.formatted_chars for r in got} == chars


def test_empty_table(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    got = workload.op12_chat_windows(spark, str(tmp_path)).collect()
    assert [(r.conv_id, r.n_turns, r.loss_chars) for r in got] == [(-7, 2, len(HOSTILE[0]))]
    assert chat.format_windows(table(spark, [])).count() == 0
