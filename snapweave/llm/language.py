"""Language identification by prediction by partial matching.

For every language, a tree of byte contexts up to ``ORDER`` long holds how often each byte
followed.  A byte is coded in the longest context known; if it never followed there, an escape is
paid and the next shorter context tried, down to all 256 bytes alike.  The statistics are frozen
after training, so a byte's code length depends on the bytes before it alone and whole texts can
be coded by table lookups: each position walks down the language's tree, one array operation a
level.  The language with the shortest code wins.

Each language has a tree of its own, made in a task of its own from its counts: languages do not
take contexts from each other, and there is no limit to their number but the memory that all
trees may take together (``MODEL_BYTES``), beyond which training fails and says so.

Code lengths are whole numbers of 1/65536 bit: sums are exact, results do not depend on batches.
"""

from __future__ import annotations

import pickle
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapweave.llm.common import in_share, lean, ship
from snapweave.session import store, store_counted

ORDER = 4
SEEN = 3
"""A byte after a context of two or more bytes counts if it was seen so often."""

CONTEXT_SEEN = 6
"""A context longer than one byte is kept if the language has seen it so often."""

CONTEXTS = 4_000
"""Contexts kept of a language at most, the most frequent ones."""

MODEL_BYTES = 1 << 30
"""All trees together: a language takes about a megabyte, and every Python worker holds them."""

JUDGED, ABOVE = 256, 1.25
"""A text of so many bytes is junk at so many times the bits a byte that labelled ones take at most."""

TOLD_BY = 20
"""Labelled documents of about a length that are needed to tell what is usual for it."""

MOST_LANGUAGES = 20_000
"""Names that training takes at most; so many would have 50 kilobytes each, too little for a tree."""

UNKNOWN = "und"
_UNIT = 65536
_SLICE = 1 << 17
_COUNTED = 1 << 21
_HELD = 1 << 20
_ROWS = 500


@dataclass
class Tree:
    """``classes`` numbers the bytes that the language has from 1, and ``width`` is one more than
    their number.  A context is known by its place times ``width``: ``steps[d]`` leads from a context
    of d bytes and the byte before it to the longer context, ``costs`` has the code length of each
    byte in each of the longest ones."""

    classes: np.ndarray
    steps: list[np.ndarray]
    costs: np.ndarray

    def size(self) -> int:
        return self.costs.nbytes + sum(s.nbytes for s in self.steps)


@dataclass
class Model:
    languages: list[str]
    trees: list[Tree]

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length of every text in every language, in 1/65536 bit."""
        total = np.zeros((len(texts), len(self.languages)), np.int64)
        group: list[int] = []
        waiting = 0
        for n, text in enumerate(texts):
            if group and waiting + len(text) > _SLICE:
                self._add(total, group, [texts[g] for g in group])
                group, waiting = [], 0
            group.append(n)
            waiting += len(text)
        if group:
            self._add(total, group, [texts[g] for g in group])
        return total

    def _add(self, total: np.ndarray, rows: list[int], texts: list[bytes]) -> None:
        # a gap of no byte's class before each text: no context reaches into the text before
        gap = bytes(ORDER)
        data = np.frombuffer(gap + gap.join(texts), np.uint8)
        lengths = np.array([len(t) for t in texts])
        starts = ORDER + np.concatenate(([0], np.cumsum(lengths + ORDER)[:-1]))
        inside = np.ones(len(data), bool)
        for start in starts:
            inside[start - ORDER : start] = False
        row_of = np.repeat(np.array(rows), lengths)
        places = np.flatnonzero(inside)
        for at in range(0, len(places), _SLICE):
            here, whose = places[at : at + _SLICE], row_of[at : at + _SLICE]
            first = np.flatnonzero(np.concatenate(([True], whose[1:] != whose[:-1])))
            low, high = here[0] - ORDER, here[-1] + 1
            window, real, rest = data[low:high], inside[low:high], here - low
            for n, tree in enumerate(self.trees):
                known = np.where(real, tree.classes[window], 0)
                node = tree.steps[0][known[rest - 1]]
                for depth in range(1, ORDER):
                    node = tree.steps[depth][node + known[rest - depth - 1]]
                costs = tree.costs[node + known[rest]]
                total[whose[first], n] += np.add.reduceat(costs, first, dtype=np.int64)


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _merged(codes: list[np.ndarray], seen: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal codes as one."""
    found, which = np.unique(np.concatenate(codes), return_inverse=True)
    # sums stay far below the 2^53 that a double holds
    return found, np.bincount(which, np.concatenate(seen), len(found)).astype(np.int64)


class _Counts:
    """How often runs of ``ORDER`` + 1 bytes occur in a language's texts, and the texts' first bytes.

    Shorter runs need no counting of their own: each but the one that begins a text is the end of
    a longer run.
    """

    def __init__(self) -> None:
        self.codes: list[np.ndarray] = []
        self.seen: list[np.ndarray] = []
        self.first: Counter[bytes] = Counter()

    def size(self) -> int:
        return sum(map(len, self.codes)) + len(self.first)

    def add(self, texts: list[bytes]) -> None:
        self.first.update(t[:ORDER] for t in texts)
        waiting: list[bytes] = []
        for text in texts:
            for at in range(0, len(text), _COUNTED):
                waiting.append(text[max(0, at - ORDER) : at + _COUNTED])
                if sum(map(len, waiting)) >= _COUNTED:
                    self._count(waiting)
                    waiting = []
        self._count(waiting)

    def _count(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b"".join(texts), np.uint8)
        if len(data) <= ORDER:
            return
        code = np.zeros(len(data) - ORDER, np.int64)
        for k in range(ORDER + 1):
            code = code * 256 + data[k : len(data) - ORDER + k]
        inside = np.ones(len(data), bool)
        for start in np.cumsum([0, *map(len, texts)])[:-1]:
            inside[start : start + ORDER] = False  # ends of runs that begin in the text before
        found, seen = np.unique(code[inside[ORDER:]], return_counts=True)
        self.codes.append(found)
        self.seen.append(seen)

    def merge(self) -> None:
        if len(self.codes) > 1:
            found, seen = _merged(self.codes, self.seen)
            self.codes, self.seen = [found], [seen]

    def frames(self, lang: str) -> Iterator[pd.DataFrame]:
        none = np.zeros(0, np.int64)
        codes, seen = _merged([none, *self.codes], [none, *self.seen])
        for length in range(ORDER, -1, -1):
            if len(codes):
                yield pd.DataFrame({"lang": lang, "length": length, "code": codes, "seen": seen})
            begun = {t: n for t, n in self.first.items() if len(t) >= length > 0}
            first = np.array([int.from_bytes(t[:length], "big") for t in begun], np.int64)
            shorter = codes & ((1 << 8 * length) - 1)
            codes, seen = _merged([shorter, first], [seen, np.array(list(begun.values()), np.int64)])


def _ngrams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of contexts with the byte that follows, by language and context length.

    A task adds up what its batches hold, as long as it is not too much.
    """
    lean()
    counts: dict[str, _Counts] = defaultdict(_Counts)
    for batch in batches:
        for lang, rows in batch.groupby("lang"):
            for at in range(0, len(rows), _ROWS):
                texts = rows["text"].iloc[at : at + _ROWS]
                counts[lang].add([t.encode("utf-8", "surrogatepass") for t in texts])
                if sum(c.size() for c in counts.values()) > 2 * _HELD:
                    for held in counts.values():
                        held.merge()
                    if sum(c.size() for c in counts.values()) > _HELD:
                        for name, held in counts.items():
                            yield from held.frames(name)
                        counts.clear()
    for name, held in counts.items():
        yield from held.frames(name)


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", trained: int | None = None
) -> Model:
    """The frozen statistics of every language, from all of its labelled documents.

    Documents that are held out, or have a null language or text, are not used.  Texts are counted
    where they are read.  A language's tree is made in one task, from the counts of its byte
    runs; only trees come to the driver, at most ``MODEL_BYTES`` of them.  ``trained`` settles
    for about so many documents of each language, by hash of the id.
    """
    named = docs.select(F.col(lang).alias("lang"), F.col(doc_id).alias("id"), F.col(text).alias("text"))
    named = named.filter(~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    ship(docs.sparkSession)
    kept = named.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    share = F.lit(1_000_000)
    if trained is not None:
        share = F.greatest(F.lit(1), F.floor(F.lit(trained * 1_000_000) / F.col("rows")))  # a millionth at least
    kept, languages = store_counted(kept.select(F.col("lang").alias("of"), share.alias("kept")), "languages")
    if languages > MOST_LANGUAGES:
        raise ValueError(f"{languages} languages, more than {MOST_LANGUAGES}")
    # a name and a number for each language, so that texts stay where they are
    chosen = named.join(F.broadcast(kept), F.col("lang") == F.col("of")).filter(in_share(F.col("id"), F.col("kept")))
    ngrams = (
        chosen.select("lang", "text")
        .mapInPandas(_ngrams, "lang string, length int, code long, seen long")
        .groupBy("lang", "length", "code")
        .agg(F.sum("seen").alias("seen"))
        .filter((F.col("length") < 2) | (F.col("seen") >= SEEN))
    )

    def compiled(rows: pd.DataFrame) -> pd.DataFrame:
        tree = compile_tree(rows)
        return pd.DataFrame({"lang": rows["lang"].iloc[:1], "size": [tree.size()], "tree": [pickle.dumps(tree)]})

    trees = store(ngrams.groupBy("lang").applyInPandas(compiled, "lang string, size long, tree binary"), "trees")
    languages, size = trees.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    if size > MODEL_BYTES:
        raise ValueError(f"the trees of {languages} languages take {size} bytes, more than {MODEL_BYTES}")
    found = sorted((row["lang"], bytes(row["tree"])) for row in trees.select("lang", "tree").collect())
    return Model([lang for lang, _ in found], [pickle.loads(tree) for _, tree in found])


def usual_bits(
    docs: DataFrame, model: Model, text: str = "text", lang: str = "lang", doc_id: str = "doc_id"
) -> dict[int, float]:
    """The most bits a byte that labelled documents take, by the length's power of two.

    From all labelled documents that are held out from training, so that none was learned from.
    """
    named = docs.filter(held_out(F.col(doc_id)) & F.col(lang).isin(model.languages)) if model.languages else docs.limit(0)
    found = identify(named.select(F.col(text).alias("text")), model)
    power = F.floor(F.log2(F.octet_length("text"))).cast("int").alias("power")
    bits = found.filter(F.col("predicted.lang_pred") != UNKNOWN).groupBy(power).agg(
        F.max("predicted.bits").alias("bits"), F.count(F.lit(1)).alias("seen")
    )
    return {row["power"]: row["bits"] for row in bits.collect() if row["seen"] >= TOLD_BY}


def is_junk(text: Column, bits: Column, usual: dict[int, float]) -> Column:
    """Whether a text takes clearly more bits a byte than labelled documents of about its length.

    Texts of less than ``JUDGED`` bytes say too little, and so does a length that few labelled documents have.
    """
    bound = F.lit(float("inf"))
    for power, most in sorted(usual.items()):
        bound = F.when(F.floor(F.log2(F.octet_length(text))) == power, F.lit(most * ABOVE)).otherwise(bound)
    return F.coalesce((F.octet_length(text) >= JUDGED) & (bits > bound), F.lit(False))


def compile_tree(ngrams: pd.DataFrame) -> Tree:
    """A language's tree from its n-gram counts ``(length, code, seen)``.

    ``code`` holds the bytes of the context and then the one that followed, 8 bits each.
    """
    code = ngrams["code"].to_numpy().astype(np.int64)
    byte, context = code & 255, code >> 8
    length, seen = ngrams["length"].to_numpy(), ngrams["seen"].to_numpy()
    classes = np.zeros(256, np.int32)
    used = np.unique(byte[length == 0])
    classes[used] = np.arange(1, len(used) + 1) if len(used) < 256 else np.minimum(np.arange(1, 257), 255)
    width = int(classes.max()) + 1

    # contexts worth keeping; a context's ending was seen at least as often, so none is orphaned
    often = pd.DataFrame({"length": length, "context": context, "seen": seen}).groupby(["length", "context"])["seen"].sum()
    often = often[(often.index.get_level_values(0) < 2) | (often >= CONTEXT_SEEN)].reset_index()
    often = often.sort_values(["seen", "length", "context"], ascending=[False, True, True]).head(CONTEXTS)
    number = {(0, 0): 0}
    for depth, ctx in sorted(zip(often["length"].tolist(), often["context"].tolist(), strict=True)):
        ending = (depth - 1, ctx & ((1 << 8 * (depth - 1)) - 1)) if depth else None
        if depth == 0 or ending in number:
            number.setdefault((depth, ctx), len(number))

    cost = np.full((len(number), width), 1 / 256)
    order = np.lexsort((context, length))
    edges = np.flatnonzero(np.diff(length[order], prepend=-1) | np.diff(context[order], prepend=-1))
    by_node = {
        number.get((int(length[rows[0]]), int(context[rows[0]]))): rows for rows in np.split(order, edges[1:]) if len(rows)
    }
    for (depth, ctx), node in number.items():
        if depth:
            cost[node] = cost[number[depth - 1, ctx & ((1 << 8 * (depth - 1)) - 1)]]
        rows = by_node.get(node)
        if rows is not None:
            whole = seen[rows].sum() + len(rows)
            cost[node] *= len(rows) / whole
            cost[node, classes[byte[rows]]] = seen[rows] / whole

    # levels: a context that has no longer one stays itself to the last level
    level, steps = {0: 0}, []  # node -> place on the level
    nodes = [0]
    for depth in range(ORDER):
        longer: dict[tuple[int, int], int] = {}
        for (d, ctx), node in number.items():
            if d == depth + 1:
                ending = number[depth, ctx & ((1 << 8 * depth) - 1)]
                longer[ending, int(classes[ctx >> 8 * depth])] = node
        following = list(nodes) + sorted(longer.values())
        place = {node: n for n, node in enumerate(following)}
        step = np.repeat(np.array([place[n] for n in nodes], np.int32), width)
        for (ending, symbol), node in longer.items():
            step[level[ending] * width + symbol] = place[node]
        steps.append(step * np.int32(width))
        nodes, level = following, place
    bits = np.rint(-np.log2(cost[nodes]) * _UNIT).astype(np.int32)
    return Tree(classes, steps, np.ascontiguousarray(bits.ravel()))


def identify(docs: DataFrame, model: Model, text: str = "text", name: str = "predicted") -> DataFrame:
    """``docs`` with a column ``name``: a struct of lang_pred, score and bits (of the best code, a byte).

    One row out for each row in, from the whole text alone.  A text that is null or has no letter
    is ``und`` with score 0, and so is every text if no language was learned.  The score is the
    probability of the language given the code lengths, all languages being equally likely before.
    Ties go to the first language by name.  All columns are kept, one called ``name`` is
    replaced.  An empty table gives no rows.
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, bits double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        lean()
        frozen = shared.value
        for batch in texts:
            parts = [batch.iloc[at : at + _ROWS] for at in range(0, len(batch), _ROWS)]
            encoded = ([b"" if t is None else t.encode("utf-8", "surrogatepass") for t in part] for part in parts)
            sizes, found = [], []
            for data in encoded:
                sizes += [len(d) for d in data]
                found.append(frozen.code_lengths(data))
            lengths = np.concatenate(found) if found else np.zeros((0, len(frozen.languages)), np.int64)
            best = lengths.argmin(axis=1)
            behind = (lengths - lengths.min(axis=1, keepdims=True)) / _UNIT
            yield pd.DataFrame(
                {
                    "lang_pred": [frozen.languages[b] for b in best],
                    "score": 1 / np.exp2(-behind).sum(axis=1),
                    "bits": lengths.min(axis=1) / _UNIT / np.maximum(1, sizes),
                }
            )

    none = F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(0.0).alias("bits"))
    if not model.languages:
        return docs.withColumn(name, none)
    lettered = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.withColumn(name, F.when(lettered, predict(F.col(text))).otherwise(none))
