import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from snapweave.llm import repair, workload

SCHEMA = "conv_id long, turn long, role string, text string, part long, whole boolean, seen string"
ROLES = ["user", "assistant", "user", "assistant", "user", "assistant", "system", "tool", "Assistant", "", None]
TEXTS = ["All is well.", "Is it?", "cut off", "Yes!", "No \n", "  \t\n ", "", None, "same.", "same.", "x. y", "é…", "tail.\x0b\x0c ", "nb. "]
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_best(rows):
    """``(cost, audit)`` by dynamic programming over (row, last role), rows as ``(role, fault)``."""
    states = ["", "s", "u", "a"]
    after = {s: (0, "") if s in ("", "a") else (float("inf"), "") for s in states}
    for n in range(len(rows), -1, -1):
        if n == len(rows):
            here = dict(after)
        else:
            role, fault = rows[n]
            more = 3 * (fault == "truncated")
            here = {}
            for s in states:
                options = [(after[s][0] + 4, "D" + after[s][1])]
                if fault not in ("blank", "duplicate"):
                    for to in states:
                        if NEXT.get((s, role[:1])) == to:
                            options.append((after[to][0] + more, "K" + after[to][1]))
                        if to in "ua" and to and NEXT.get((s, to)) == to:
                            options.append((after[to][0] + 3 + more, "R" + after[to][1]))
                here[s] = min(options)
        for _ in range(4):
            for s in states:
                for to in "ua":
                    if (s, to) in NEXT:
                        here[s] = min(here[s], (here[to][0] + 3, "I" + here[to][1]))
        after = here
    return after[""]


def plain_repair(turns):
    """The contract's columns for one conversation's ``(turn, role, text)`` in order."""
    if not turns:
        return (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    rows, seen, counts = [], set(), Counter()
    for _, role, text in turns:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not words else "duplicate" if (role, text) in seen else "" if words[-1] in ".!?" else "truncated"
        seen.add((role, text))
        counts[fault] += 1
        rows.append((role, fault))
    cost, audit = plain_best(rows)
    out, last, at = [], "", 0
    for edit in audit:
        if edit == "I":
            last = "a" if last == "u" else "u"
            out.append({"u": "user", "a": "assistant"}[last] + ":")
            continue
        role, text = turns[at][1:]
        at += 1
        if edit != "D":
            last = role[0] if edit == "K" else "a" if last == "u" else "u"
            out.append((role if edit == "K" else {"u": "user", "a": "assistant"}[last]) + ":" + text)
    numbers = [t for t, *_ in turns if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    return (gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def in_order(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        found[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(t if known else None, r, x) for known, t, r, x in sorted(v)] for c, v in found.items()}


def conversations(seed, convs=60, most=14):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(1, most)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(ROLES[: rng.choice([2, 7, 11])]), rng.choice(TEXTS)))
    rows += [(None, t, ["user", "assistant"][t % 2], f"nobody {t}.") for t in range(5)] + [(None, None, None, None)]
    rows += [rows[0], rows[0], rows[1]]
    rng.shuffle(rows)
    return rows


def long_conversation(seed, turns=400, conv=77):
    rng = random.Random(seed)
    made = []
    for t in range(turns):
        role = ["user", "assistant"][t % 2] if rng.random() < 0.8 else rng.choice(ROLES)
        made.append((conv, t if rng.random() < 0.95 else None, role, rng.choice([f"turn {t}.", f"turn {t}", *TEXTS])))
    return made


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, True, "x") for r in rows], SCHEMA)


def test_auction_against_dynamic_programming():
    """Random rows of all kinds, in stretches of many lengths: cost and edits are the best."""
    rng = random.Random(2)
    roles, faults = ["s", "u", "a", "o", ""], ["", "truncated", "blank", "duplicate"]
    number = {"": 0, "truncated": 1, "blank": 2, "duplicate": 2}
    for trial in range(1500):
        rows = [(rng.choice(roles[: rng.choice([3, 5])]), rng.choice(faults[: rng.choice([1, 2, 4])])) for _ in range(rng.choice([0, 1, 2, 5, 9, 16, 17, 33, 70]))]
        cost, letters, _ = repair.edits("".join(repair.code(r, number[f]) for r, f in rows))
        assert (cost, letters) == plain_best(rows), trial


def checked(got, rows, name="conv"):
    want = {c: plain_repair(t) for c, t in in_order(rows).items()}
    found = {r[name]: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in got}
    assert len(got) == len(found)
    assert found == want


def test_conversations(spark):
    rows = conversations(1) + long_conversation(3)
    checked(repair.summaries(repair.repair(table(spark, rows))).collect(), rows)


@pytest.mark.parametrize("block", [5, 64])
def test_hot_conversations_in_blocks(spark, block):
    """Long conversations, the null one included, worked on in blocks give the same."""
    rows = conversations(7) + long_conversation(5) + [(80, None, "user", "same.")] * 40 + [(81, 4, "assistant", " ")] * 30
    checked(repair.summaries(repair.repair(table(spark, rows).repartition(3), hot_turns=3, block=block)).collect(), rows)


def test_turns_that_remain(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hello."), (1, 2, "tool", "Fine."), (1, 3, "user", "")]
    (got,) = repair.repair(table(spark, rows)).collect()
    assert (got.cost, got.audit) == plain_best([("user", ""), ("user", ""), ("tool", ""), ("user", "blank")])
    assert [tuple(t) for t in got.turns][0] == ("K", 0, "user", "Hi.")
    assert all(a.role != b.role for a, b in zip(got.turns, got.turns[1:])) and got.turns[-1].role == "assistant"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        place = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(place.encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return out


def test_query(spark, tmp_path):
    gone = next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows = conversations(9, 300) + [(gone, 1, "user", "lost.")]
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = workload.op13_conversation_repair(spark, str(tmp_path)).collect()
    left = damage(rows)
    want = {c: plain_repair(t) for c, t in in_order(left).items()} | {gone: plain_repair([])}
    missing = {r[0] for r in rows} - set(want)
    want |= {c: plain_repair([]) for c in missing}
    found = {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")) for r in got}
    assert found == want and len(got) == len(want)


def test_empty_table(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/conversations.parquet")
    assert workload.op13_conversation_repair(spark, str(tmp_path)).count() == 0
    assert repair.repair(table(spark, [])).count() == 0
