"""Secret scan: a trigram index narrows each rule down to candidate texts, which are then verified.

From every rule's expression a Boolean trigram query is derived (each alternative is a set of
trigrams that any match must contain).  The index holds postings of those trigrams only: one row
for each trigram and text that has it, written once.  Intersecting the postings gives candidate
texts by rule; only they are searched with the rule's expression.  A rule without mandatory
trigrams, such as a run of hexadecimal digits, is run over every text.

All of it is DataFrame functions.
"""

from __future__ import annotations

from re import _parser as regex_tree
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapweave.llm.common import let
from snapweave.session import store

SMALL_CANDIDATES = 100_000
"""Candidate rows (a hash and a few rule numbers, under 100 bytes) up to which they are broadcast."""

_MOST_ALTERNATIVES = 64
_SMALL_CLASS = 5


class Rule(NamedTuple):
    """``pattern`` is read alike by Java and Python.  A match counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


ASSIGN = Rule(
    "assign",
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    2,
    8,
)
#: For the next two, the least length is part of the pattern: what they match is a whole run from
#: its first possible start, so shorter matches are dropped either way.
ACCESS = Rule("access", r"AKIA[A-Z0-9]{12,}")
HEX = Rule("hex", r"[0-9a-f]{32,}")
BASE = (ASSIGN, ACCESS, HEX)
#: A whole key: to its END line, or else over header fields and runs of base64 (a last one may be short, a checksum follow).
#: Line ends may be escaped, lines quoted or indented.  Possessive loops, as Java recurses in others.
_GAP = r"""(?:[\x20\x09-\x0D"'+>|*#,;]|\\++[nrt])++"""
_FIELDS = r"(?:(?:[\x09-\x0D]|\\++[nr])++[A-Za-z][A-Za-z0-9-]*+:\x20[^\n\\]*+)*+"
PRIVATE_KEY = Rule(
    "private_key",
    r"-----BEGIN [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
    r"(?:(?:[^-]++|-(?!----))*+-----END [A-Z ]*PRIVATE KEY(?: BLOCK)?-----"
    rf"|{_FIELDS}(?:{_GAP}[A-Za-z0-9+/=]{{16,}}+)++(?:{_GAP}[A-Za-z0-9+/]++=*+)?+(?:{_GAP}=[A-Za-z0-9+/]{{4}})?+)?+",
)
RULES = (
    *BASE,
    PRIVATE_KEY,
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_api", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("payment", r"sk_live_[0-9A-Za-z]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives of lower-case trigrams of which one must be in any text that matches.

    None: the expression has no mandatory trigrams.  A literal extends the run of characters that
    must follow each other; a branch or a small class multiplies the runs; anything else ends them.
    """

    def grams(run: str) -> frozenset[str]:
        low = run.lower()
        return frozenset(low[i : i + 3] for i in range(len(low) - 2))

    def ended(runs: set) -> set:
        return {(have | grams(run), "") for have, run in runs}

    def extend(runs: set, tails: list[str]) -> set:
        grown = {(have, run + t) for have, run in runs for t in tails}
        return grown if len(grown) <= _MOST_ALTERNATIVES else ended(runs)

    def walk(nodes, runs: set) -> set:
        for op, value in nodes:
            name = str(op)
            if name == "LITERAL":
                runs = extend(runs, [chr(value)])
            elif name == "SUBPATTERN":
                runs = walk(value[3], runs)
            elif name == "BRANCH":
                grown = set().union(*(walk(branch, runs) for branch in value[1]))
                runs = grown if len(grown) <= _MOST_ALTERNATIVES else ended(runs)
            elif name == "IN" and len(value) <= _SMALL_CLASS and all(str(o) == "LITERAL" for o, _ in value):
                runs = extend(runs, [chr(c) for _, c in value])
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                least, most, body = value
                if (least, most) == (0, 1):
                    grown = runs | walk(body, runs)
                    runs = grown if len(grown) <= _MOST_ALTERNATIVES else ended(runs)
                else:
                    for _ in range(min(least, 3)):
                        runs = walk(body, runs)
                    runs = ended(runs) if least != most or least > 3 else runs
            else:
                runs = ended(runs)
        return runs

    found = {have for have, _ in ended(walk(regex_tree.parse(pattern), {(frozenset(), "")}))}
    if not all(found):
        return None
    return sorted((f for f in found if not any(other < f for other in found)), key=sorted)


def build_index(docs: DataFrame, trigrams: list[str], text: str = "text") -> DataFrame:
    """Postings ``(trigram, key)``, stored.  ``key`` is a hash of the whole text.

    Texts are folded to lower case.  Copies of a text share their postings; two texts with the
    same hash would only become each other's candidates, which verification sorts out.
    """
    vocabulary = F.array(*[F.lit(t) for t in trigrams])
    present = let(F.lower("__text"), lambda low: F.filter(vocabulary, lambda t: F.contains(low, t)))
    return store(
        docs.select(F.col(text).alias("__text"))
        .select(F.xxhash64("__text").alias("key"), F.explode(present).alias("trigram"))
        .sortWithinPartitions("trigram"),
        "postings",
    )


def candidates(postings: DataFrame, queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """Keys with the numbers of the rules whose query they satisfy, ``(key, rules)``; the rest is left out."""
    have = postings.groupBy("key").agg(F.collect_set("trigram").alias("have"))

    def satisfied(alternatives: list[frozenset[str]]) -> Column:
        met = F.lit(False)
        for alternative in alternatives:
            wanted = F.array(*[F.lit(t) for t in sorted(alternative)])
            met = met | (F.size(F.array_except(wanted, F.col("have"))) == 0)
        return met

    rules = F.filter(
        F.array(*[F.when(satisfied(q), F.lit(n)) for n, q in queries.items()]), lambda n: n.isNotNull()
    )
    return have.select("key", rules.alias("rules")).filter(F.size("rules") > 0)


def _matches(text: Column, rule: Rule, number: int) -> Column:
    """Spans of the rule's leftmost non-overlapping matches, in code points.

    The pieces between the matches and the matches themselves, laid end to end, give the offsets.
    """
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    gaps = F.transform(F.split(text, rule.pattern, -1), lambda p: F.length(p))
    spans = "array<struct<start:int,rule:int,end:int>>"

    def walk(a: Column) -> Column:
        def step(at: Column, i: Column) -> Column:
            start = at.pos + F.get(a.gaps, i)
            end = start + F.length(F.get(a.whole, i))
            span = F.struct(start.alias("start"), F.lit(number).alias("rule"), end.alias("end"))
            good = F.length(F.get(a.counted, i)) >= rule.least
            return F.struct(
                end.alias("pos"),
                F.when(good, F.concat(at.out, F.array(span))).otherwise(at.out).alias("out"),
            )

        start = F.struct(F.lit(0).alias("pos"), F.array().cast(spans).alias("out"))
        walked = F.aggregate(F.sequence(F.lit(0), F.size(a.whole) - 1), start, step)
        return F.when(F.size(a.whole) > 0, walked.getField("out")).otherwise(F.array().cast(spans))

    parts = F.struct(whole.alias("whole"), counted.alias("counted"), gaps.alias("gaps"))
    return F.when(text.rlike(rule.pattern), let(parts, walk)).otherwise(F.array().cast(spans))


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", name: str = "secret_spans"
) -> DataFrame:
    """``docs`` with a column ``name``: an array of (start, rule, end), sorted; ``rule`` indexes ``rules``.

    Offsets are code points of the whole text, ``end`` is exclusive, a span is the whole match.
    Matches of one rule do not overlap, those of different rules may.  Null and empty texts have
    no spans.  Rows are judged one by one, so repeated rows get the same spans.  All columns of
    ``docs`` are kept, one called ``name`` is replaced.  ``docs`` is read twice, once
    for the index and once to verify.
    """
    docs = docs.drop(name)
    queries = {n: q for n, rule in enumerate(rules) if (q := trigram_query(rule.pattern)) is not None}
    vocabulary = sorted({t for q in queries.values() for alternative in q for t in alternative})
    whole = F.coalesce(F.col(text), F.lit(""))
    if queries:
        found = store(candidates(build_index(docs, vocabulary, text), queries), "candidates")
        found = found.select(F.col("key").alias("__key"), F.col("rules").alias("__rules"))
        if found.count() <= SMALL_CANDIDATES:
            found = F.broadcast(found)
        searched = docs.withColumn("__key", F.xxhash64(text)).join(found, "__key", "left")
    else:
        searched = docs.withColumns({"__key": F.lit(0), "__rules": F.lit(None).cast("array<int>")})
    none = F.array().cast("array<struct<start:int,rule:int,end:int>>")
    spans = [
        F.when(F.array_contains("__rules", n), _matches(whole, rule, n)).otherwise(none)
        if n in queries
        else _matches(whole, rule, n)
        for n, rule in enumerate(rules)
    ]
    return searched.withColumn(name, F.sort_array(F.concat(none, *spans))).drop("__key", "__rules")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``[kind]``; overlapping spans become one, named by the first.

    Texts without secrets, null ones included, stay as they are.
    """
    kinds = F.array(*[F.lit(r.kind) for r in rules])

    def masked(row: Column) -> Column:
        def step(at: Column, s: Column) -> Column:
            inside = s.start < at.pos
            gap = F.substring(row.text, at.pos + 1, s.start - at.pos)
            out = F.concat(at.out, gap, F.lit("["), F.get(kinds, s.rule), F.lit("]"))
            return F.struct(
                F.when(inside, at.out).otherwise(out).alias("out"), F.greatest(at.pos, s.end).alias("pos")
            )

        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("pos"))
        walked = F.aggregate(row.spans, start, step)
        return let(walked, lambda w: F.concat(w.out, F.substring(row.text, w.pos + 1, F.length(row.text))))

    row = F.struct(F.col(text).alias("text"), F.col("__spans").alias("spans"))
    return (
        find_secrets(docs, rules, text, "__spans")
        .withColumn(text, F.when(F.size("__spans") > 0, let(row, masked)).otherwise(F.col(text)))
        .drop("__spans")
    )


def joined(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """``kind:start:end`` of the spans in their order, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s.rule), s.start, s.end)), ","
    )
