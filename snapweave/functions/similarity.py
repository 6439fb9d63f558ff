"""Similarity of two names on a scale of 0 to 100."""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterable

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def levenshtein_score(left: Column, right: Column) -> Column:
    """Share of characters that need no edit, 0..100; 0 for two empty texts."""
    longest = F.greatest(F.length(left), F.length(right))
    return F.when(longest > 0, (1 - F.levenshtein(left, right) / longest) * 100).otherwise(0.0)


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, one big-integer step per character."""
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    mask = (1 << len(a)) - 1
    row = mask
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & mask
    return len(a) - row.bit_count()


def _ratio(a: str, b: str) -> float:
    return 100.0 * 2 * _lcs(a, b) / (len(a) + len(b)) if a and b else 0.0


def _partial(a: str, b: str) -> float:
    """Best ratio of the shorter text with any stretch of equal length of the longer."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0
    starts = range(len(long) - len(short) + 1)
    return max(_ratio(short, long[i : i + len(short)]) for i in starts)


def _token_set(a: str, b: str, compare) -> float:
    """Compare what both texts share with what each has beyond that."""
    left, right = set(a.split()), set(b.split())
    shared = " ".join(sorted(left & right))
    first = f"{shared} {' '.join(sorted(left - right))}".strip()
    second = f"{shared} {' '.join(sorted(right - left))}".strip()
    return max(compare(shared, first), compare(shared, second), compare(first, second))


def weighted_ratio(a: str, b: str) -> int:
    """The customary weighted mix of plain, partial and token-based ratios, 0..100.

    Partial comparison, at a discount, is used only for texts of clearly different length.
    """
    a, b = (re.sub(r"\W", " ", t.lower()).strip() for t in (a, b))
    if not a or not b:
        return 0
    proportion = max(len(a), len(b)) / min(len(a), len(b))
    by_token = [" ".join(sorted(t.split())) for t in (a, b)]
    scores = [_ratio(a, b)]
    if proportion < 1.5:
        scores += [0.95 * round(_ratio(*by_token)), 0.95 * round(_token_set(a, b, _ratio))]
    else:
        scale = 0.6 if proportion > 8 else 0.9
        scores += [
            scale * round(_partial(a, b)),
            0.95 * scale * round(_partial(*by_token)),
            0.95 * scale * round(_token_set(a, b, _partial)),
        ]
    return round(max(scores))


@F.pandas_udf(T.DoubleType())
def weighted_score(left: pd.Series, right: pd.Series) -> pd.Series:
    """``weighted_ratio`` of two columns."""
    return pd.Series([float(weighted_ratio(a, b)) for a, b in zip(left, right)], dtype="float64")


PROFILE = T.StructType(
    [
        T.StructField("tokens", T.ArrayType(T.StringType())),
        T.StructField("grams", T.ArrayType(T.StringType())),
        T.StructField("lengths", T.ArrayType(T.IntegerType())),
        T.StructField("pairs", T.ArrayType(T.IntegerType())),
        T.StructField("letters", T.ArrayType(T.StringType())),
        T.StructField("spaces", T.ArrayType(T.IntegerType())),
    ]
)


def profile_of(text: str) -> tuple[list[str], list[str], list[int], list[int], list[str], list[int]]:
    """What bounds a text's weighted scores: its different words, its pairs of neighbouring letters
    within words (repetitions numbered), lengths and numbers of pairs of the three spellings that
    are compared (as it is, with words in order, with each word once), its letters (repetitions
    numbered), and the spaces of the three spellings."""
    clean = re.sub(r"\W", " ", text.lower()).strip()
    tokens = clean.split()
    once = sorted(set(tokens))
    grams = _numbered(token[i : i + 2] for token in tokens for i in range(len(token) - 1))
    spellings = [clean, " ".join(tokens), " ".join(once)]
    pairs = [len(grams), len(grams), sum(len(t) - 1 for t in once)]
    letters = _numbered(letter for token in tokens for letter in token)
    return once, grams, [len(s) for s in spellings], pairs, letters, [s.count(" ") for s in spellings]


def _numbered(parts: Iterable[str]) -> list[str]:
    """Parts of one length; each beyond the first of its kind with its number."""
    seen: dict[str, int] = {}
    found = []
    for part in parts:
        seen[part] = seen.get(part, 0) + 1
        found.append(f"{part}{seen[part] if seen[part] > 1 else ''}")
    return found


@F.pandas_udf(PROFILE)
def profiles(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([profile_of(t) for t in texts], columns=PROFILE.names)


def shared_pairs(profile: Column, threshold: float, partial_only: bool = False) -> Column:
    """How many pairs of letters a text shares at least with any other that scores above ``threshold``.

    Holds for others that have no word in common with it.  Of a longest common subsequence, each
    letter of the text outside it spoils two of the text's pairs at most, each one of the other's
    inside it one; the score says how many letters are outside.  ``partial_only`` bounds the partial
    scores, of a text that is the shorter one, alone.  0 or less means that nothing can be said.
    """
    need = math.floor(threshold) + 0.5
    rests = []
    for i in range(3):
        length, pairs = F.get(profile["lengths"], i), F.get(profile["pairs"], i)
        whole = (need if i == 0 else need / 0.95 - 0.5) / 100
        part = (need / 0.9 if i == 0 else need / 0.9 / 0.95) / 100 - 0.005
        if part <= 1:
            rests.append(pairs - 3 * (1 - part) * length)
        if whole <= 1 and not partial_only:
            # the other's length may lie between these shares of the text's own
            slope = 1.5 * whole - 1
            other = whole / (2 - whole) if slope >= 0 else (2 - whole) / whole if whole > 0 else math.inf
            rests.append(pairs - (2 - 1.5 * whole) * length + slope * other * length if other < math.inf else F.lit(-1.0))
    if not rests:
        return F.lit(1 << 30)
    least = rests[0] if len(rests) == 1 else F.least(*rests)
    return F.ceil(least - 1e-6)


def enough_letters(left: Column, right: Column, threshold: float) -> Column:
    """Whether two profiles have letters enough in common for a score above ``threshold``.

    Holds for texts that have no word in common.  A common subsequence has no more of a letter, and
    no more spaces, than either text; the scores are shares of the lengths.
    """
    need = math.floor(threshold) + 0.5
    shared = F.size(F.array_intersect(left["letters"], right["letters"]))
    reached = F.lit(False)
    for i in range(3):
        whole = need if i == 0 else need / 0.95 - 0.5
        part = (need / 0.9 if i == 0 else need / 0.9 / 0.95) - 0.5
        common = shared + F.least(F.get(left["spaces"], i), F.get(right["spaces"], i))
        a, b = F.get(left["lengths"], i), F.get(right["lengths"], i)
        reached = reached | (200 * common >= (whole - 1e-6) * (a + b)) | (100 * common >= (part - 1e-6) * F.least(a, b))
    return reached
