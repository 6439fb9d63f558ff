"""Nearest name in a list of candidates."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snapweave.functions.similarity import enough_letters, levenshtein_score, profiles, shared_pairs, weighted_score
from snapweave.operators.lookups import attach
from snapweave.operators.skew import SMALL_ROWS
from snapweave.session import store, store_counted

_CHUNK = 64
_SALTS = 32


def strip_words(column, words: Sequence[str]):
    """Remove whole words from lower-case text and trim what is left."""
    if not words:
        return F.trim(column)
    listed = "|".join(sorted(words, key=len, reverse=True))
    pattern = rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{listed})(?![\p{{L}}\p{{N}}])"
    return F.trim(F.regexp_replace(F.regexp_replace(column, pattern, " "), r"\s+", " "))


class Candidates(NamedTuple):
    """Candidates as ``fuzzy_match`` uses them, stored: all of them, and by full and short name.

    ``grams`` has how many candidates have a pair of letters, for the weighted score.
    """

    listed: DataFrame
    by_full: DataFrame
    by_short: DataFrame
    total: int
    grams: DataFrame | None


def prepare_candidates(
    candidates: DataFrame,
    full: str = "name",
    short: str = "short_name",
    order: str = "code",
    scorer: str = "weighted",
) -> Candidates:
    """Store a list of candidates for any number of ``fuzzy_match`` calls.

    ``order`` may be numbers or text: numbers come first, by value, then text, then nulls.
    """
    number = F.col(order).try_cast("double")
    rank = F.struct(
        F.col(order).isNull().alias("none"), number.isNull().alias("text"), number.alias("number"),
        F.col(order).cast("string").alias("spelled"),
    )
    shaped = candidates.distinct().select(
        rank.alias("__order"),
        F.lower(full).alias("__full"),
        F.lower(short).alias("__short"),
        F.struct(*candidates.columns).alias("candidate"),
    )
    if scorer == "weighted":
        shaped = shaped.withColumns(
            {"__id": F.monotonically_increasing_id(), "__p": profiles(F.coalesce("__short", F.lit("")))}
        )
    listed, total = store_counted(shaped, "candidates")
    grams = None
    if scorer == "weighted":
        seen = listed.select(F.explode("__p.grams").alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("seen"))
        grams = store(seen, "candidate_grams")

    def by(key: str) -> DataFrame:
        last = F.max_by("candidate", "__order").alias(f"__by{key[1:]}")
        return store(listed.filter(F.col(key).isNotNull()).groupBy(key).agg(last), "candidates_by_name")

    return Candidates(listed, by("__full"), by("__short"), total, grams)


def fuzzy_match(
    df: DataFrame,
    name: str,
    candidates: DataFrame | Candidates,
    *,
    full: str = "name",
    short: str = "short_name",
    order: str = "code",
    words: Sequence[str] = (),
    threshold: float = 80,
    scorer: str = "weighted",
) -> DataFrame:
    """For each distinct name the candidate it means: ``name``, ``how``, ``score``, ``candidate``.

    Tried in turn: the same full name, the same short name (both in any case; the last in ``order``
    of those that share it), then the short name with the best score above ``threshold`` once type
    ``words`` are removed; the first in ``order`` wins among equals.  ``how`` is full, short, fuzzy,
    or null if nothing was near enough.  ``scorer`` is "weighted" or "levenshtein".

    With "levenshtein", names meet candidates in chunks, those of lengths that can still score above
    the threshold: a name row holds one chunk at a time, so neither side is collected and no table
    of pairs arises.  With "weighted", an index of words and pairs of letters gives the pairs that
    can score above the threshold (``weighted_pairs``), and only these are scored.  The distinct
    names are stored, so ``df`` is read once; ``prepare_candidates`` does the candidates' part
    beforehand.
    """
    if scorer not in ("weighted", "levenshtein"):
        raise ValueError(f"unknown scorer {scorer!r}")
    made = candidates if isinstance(candidates, Candidates) else prepare_candidates(
        candidates, full, short, order, scorer
    )
    names = store(df.select(F.col(name).alias("name")).dropna().distinct(), "names")
    keyed = names.withColumns({"__full": F.lower("name"), "__short": F.lower("name")})
    small = made.total <= SMALL_ROWS
    exact = attach(keyed, made.by_full, "__full", checked=False, small=small)
    exact = attach(exact, made.by_short, "__short", checked=False, small=small)

    open_names = (
        exact.filter("__by_full IS NULL AND __by_short IS NULL")
        .select("name", strip_words(F.lower("name"), words).alias("__text"))
        .filter(F.length("__text") > 0)
    )
    best = (_best_weighted if scorer == "weighted" else _best_by_edits)(open_names, made, threshold, small)
    result = exact.join(best, exact["name"] == best["__name"], "left")
    how = (
        F.when(F.col("__by_full").isNotNull(), "full")
        .when(F.col("__by_short").isNotNull(), "short")
        .when(F.col("__near").isNotNull(), "fuzzy")
    )
    return result.select(
        "name",
        how.alias("how"),
        F.when(how.isin("full", "short"), 100.0).otherwise(F.col("__score")).alias("score"),
        F.coalesce("__by_full", "__by_short", "__near").alias("candidate"),
    )


def _best_weighted(names: DataFrame, made: Candidates, threshold: float, small: bool) -> DataFrame:
    """``(__name, __score, __near)`` of the names that some candidate is near enough to."""
    listed = made.listed.select("__id", "__order", "__short")
    spelled = names.select("name", "__text")
    scored = (
        weighted_pairs(names, made, threshold, small)
        .join(spelled, "name")
        .join(F.broadcast(listed) if small else listed, "__id")
        .withColumn("__score", weighted_score("__text", "__short"))
        .filter(F.col("__score") > threshold)
    )
    first = F.min(F.struct((-F.col("__score")).alias("far"), "__order", "__id")).alias("b")
    best = scored.groupBy("name").agg(first)
    near = made.listed.select("__id", "candidate")
    return best.withColumn("__id", F.col("b.__id")).join(F.broadcast(near) if small else near, "__id").select(
        F.col("name").alias("__name"), (-F.col("b.far")).alias("__score"), F.col("candidate").alias("__near")
    )


def weighted_pairs(names: DataFrame, made: Candidates, threshold: float, small: bool = False) -> DataFrame:
    """Pairs ``(name, __id)`` of names ``(name, __text)`` and candidates, all that can score above ``threshold``.

    Two texts whose weighted score is above it have a word in common, or as many pairs of letters
    as ``shared_pairs`` says of one of them.  Of a text that has g pairs and shares r of them, any
    g - r + 1 hold a shared one: so the rarest so many of a name meet the index of all candidates'
    pairs, and the rarest of a candidate meet all of the names'.  Texts too short for a bound meet
    everything, spread over ``_SALTS`` keys.  Of those that meet without a common word, the ones stay
    that have letters enough in common.
    """
    p = F.col("__p")
    told = names.select("name", profiles("__text").alias("__p"))
    grams = made.grams
    by_rarity = F.sort_array(F.collect_list(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "gram")))

    def ranked(texts: DataFrame, key: str) -> DataFrame:
        """Each text's pairs, those that few candidates have first."""
        spread = texts.select(key, F.explode("__p.grams").alias("gram"))
        sorted_grams = spread.join(grams, "gram", "left").groupBy(key).agg(by_rarity.alias("__g"))
        sorted_grams = sorted_grams.select(key, F.col("__g.gram").alias("__rare"))
        return texts.join(sorted_grams, key, "left").withColumn("__rare", F.coalesce("__rare", F.array().cast("array<string>")))

    def salted(mark: str, key: str) -> Column:
        return F.array(F.concat(F.lit(mark), F.pmod(F.xxhash64(key), F.lit(_SALTS)).cast("string")))

    every = {m: F.array(*[F.lit(f"{m}{i}") for i in range(_SALTS)]) for m in "*!"}
    none = F.array().cast("array<string>")

    def prefix(mark: str, least: Column) -> Column:
        count = F.greatest(F.lit(0), F.size("__rare") - least + 1).cast("int")
        return F.transform(F.slice("__rare", F.lit(1), count), lambda g: F.concat(F.lit(mark), g))

    def marked(mark: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.concat(F.lit(mark), v))

    def unbounded(least: Column) -> Column:
        return (least <= 0) & ((F.get(p["lengths"], 0) > 0) | F.lit(threshold < 0))

    own, part = shared_pairs(p, threshold), shared_pairs(p, threshold, partial_only=True)
    listed = made.listed.filter(F.col("__short").isNotNull())
    listed = store(ranked(listed.select("__id", "__p"), "__id").withColumn("least", part), "indexed_candidates")
    loose = not listed.filter(unbounded(F.col("least"))).isEmpty()
    name_keys = F.concat(
        marked("t", p["tokens"]),
        prefix("p", F.col("least")),
        marked("g", p["grams"]),
        F.when(unbounded(F.col("least")), every["*"]).otherwise(none),
        salted("!", "name") if loose else none,
    )
    candidate_keys = F.concat(
        marked("t", p["tokens"]),
        marked("p", p["grams"]),
        prefix("g", F.col("least")),
        salted("*", "__id"),
        F.when(unbounded(F.col("least")), every["!"]).otherwise(none),
    )
    left = ranked(told, "name").withColumn("least", own)
    left = left.select("name", "least", p.alias("own"), F.explode(name_keys).alias("key"))
    right = listed.select("__id", F.col("least").alias("part"), p.alias("other"), F.explode(candidate_keys).alias("key"))
    shared = F.size(F.array_intersect("own.grams", "other.grams"))
    near = (shared >= F.col("least")) | (shared >= F.col("part"))
    possible = F.arrays_overlap("own.tokens", "other.tokens") | (
        near & enough_letters(F.col("own"), F.col("other"), threshold)
    )
    met = left.join(F.broadcast(right) if small else right, "key").filter(possible)
    return met.select("name", "__id").distinct()


def _best_by_edits(names: DataFrame, made: Candidates, threshold: float, small: bool) -> DataFrame:
    met = _meet(
        names, made.listed.filter("__short IS NOT NULL"), threshold if threshold > 0 else None, made.total, small
    )
    ranked = F.transform(
        "__list",
        lambda c: F.struct(
            (-levenshtein_score(F.col("__text"), c["__short"])).alias("far"),
            c["__order"].alias("o"),
            c["candidate"].alias("candidate"),
        ),
    )
    return (
        met.select("name", F.array_min(ranked).alias("b"))
        .groupBy("name")
        .agg(F.min("b").alias("b"))
        .filter(F.col("b.far") < -threshold)
        .select(F.col("name").alias("__name"), (-F.col("b.far")).alias("__score"),
                F.col("b.candidate").alias("__near"))
    )


def _meet(
    names: DataFrame, listed: DataFrame, threshold: float | None, total: int, small: bool
) -> DataFrame:
    """Each name with every chunk of candidates (``__list``) it has to be compared with.

    Chunks belong to a band: a length of candidates when there is a ``threshold`` on the share of
    equal characters, which bounds the lengths a name can reach; otherwise there is one band.
    Candidates that were counted as small are broadcast, and names stay where they are.  Otherwise
    names are salted, so that a band is met by as many tasks as shuffles have.
    """
    if threshold is None:
        band, reach = F.lit(0), F.array(F.lit(0))
    else:
        band, own = F.length("__short"), F.length("__text")
        reach = F.sequence(
            F.floor(own * (threshold / 100)).cast("int"), F.ceil(own * (100 / threshold)).cast("int")
        )
    # a chunk holds about _CHUNK candidates where all are of one length, fewer where they are spread
    chunk = F.pmod(F.xxhash64("candidate"), F.lit(max(1, -(-total // _CHUNK))))
    chunks = (
        listed.groupBy(band.alias("__band"), chunk.alias("__chunk"))
        .agg(F.collect_list(F.struct("__order", "__short", "candidate")).alias("__list"))
        .select("__band", "__list")
    )
    reaching = names.withColumn("__band", F.explode(reach))
    if small:
        return reaching.join(F.broadcast(chunks), "__band")
    spread = int(names.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = reaching.withColumn("__salt", F.pmod(F.xxhash64("name"), F.lit(spread)).cast("int"))
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    return salted.join(chunks.withColumn("__salt", every_salt), ["__band", "__salt"])
