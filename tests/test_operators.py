import itertools
import random

import pytest
from pyspark.sql import functions as F

from snapweave.functions import similarity, text
from snapweave.operators import filters, fuzzy, lookups, panel
from snapweave.operators.corrections import latest_per
from snapweave.operators.metrics import observe, order
from snapweave.operators.waterfall import Rung, prepare, waterfall_match


# ---- text ------------------------------------------------------------------------------------


def test_padding_cuts_long_ids(spark, rows):
    df = spark.createDataFrame([("7",), ("123456",), (None,)], "t string")
    assert rows(df.select(text.pad_id("t", 4))) == [("0007",), ("1234",), (None,)]


def test_names_and_types(spark, rows):
    df = spark.createDataFrame(
        [("Ёлкино", "село"), ("Ёлкино", None), (None, "село"), ("", "село")], "n string, t string"
    )
    assert set(rows(df.select(text.join_name_type("n", "t")))) == {
        ("Ёлкино село",), ("Ёлкино",), ("село",), (None,)
    }
    assert ("село Ёлкино",) in rows(df.select(text.join_name_type("n", "t", ["село"])))
    assert ("ЕЛКИНО",) in rows(df.select(text.text_key("n")))


def test_area_labels(spark, rows):
    df = spark.createDataFrame([("А", "г"), ("А", "р-н"), ("А", "у"), ("А", "пос"), ("А", None)], "a string, t string")
    got = [r[0] for r in df.select(text.area_label(F.col("a"), F.col("t"))).collect()]
    assert got == ["Город А", "А район", "А улус", "А", None]


def test_default_settlement(spark):
    df = spark.createDataFrame([("Москва", None), ("Москва", "x"), ("Тула", None), (None, None)], "r string, s string")
    got = [r[0] for r in df.select(text.default_settlement("r", "s", ["Москва"])).collect()]
    assert got == ["Москва", "x", None, None]


# ---- similarity --------------------------------------------------------------------------------


def test_weighted_ratio_known_values():
    assert similarity.weighted_ratio("Саха  Якутия", "саха /якутия/") == 100
    assert similarity.weighted_ratio("кемеровская", "кемеровская область - кузбасс") == 90
    assert similarity.weighted_ratio("эл марий", "марий эл") == 95
    assert similarity.weighted_ratio("абв", "кузбасс") < 50
    assert similarity.weighted_ratio("", "x") == 0


def test_longest_common_subsequence():
    def slow(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            best[i + 1][j + 1] = (
                best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
            )
        return best[-1][-1]

    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choices("abc", k=rng.randrange(1, 9))) for _ in "ab")
        assert similarity._lcs(a, b) == slow(a, b)


REGIONS = [
    (1, "Республика Алтай", "Алтай"),
    (2, "Алтайский край", "Алтайский"),
    (3, "Кемеровская область - Кузбасс", "Кемеровская область - Кузбасс"),
    (4, "Москва", "Москва"),
    (5, "Новгородская область", "Новгородская"),
]


@pytest.mark.parametrize("scorer", ["weighted", "levenshtein"])
def test_fuzzy_match(spark, scorer):
    candidates = spark.createDataFrame(REGIONS, "code int, name string, short_name string")
    names = ["алтайский край", "АЛТАЙ", "Кемеровская область", "город Москва", "Новгородскя обл", "Париж", None, "АЛТАЙ"]
    df = spark.createDataFrame([(n,) for n in names], "region string")
    got = {
        r["name"]: (r["how"], r["code"])
        for r in fuzzy.fuzzy_match(
            df, "region", candidates, words=["область", "город", "обл"], scorer=scorer
        ).select("name", "how", "candidate.code").collect()
    }
    partial = ("fuzzy", 3) if scorer == "weighted" else (None, None)
    assert got == {
        "алтайский край": ("full", 2),
        "АЛТАЙ": ("short", 1),
        "Кемеровская область": partial,
        "город Москва": ("fuzzy", 4),
        "Новгородскя обл": ("fuzzy", 5),
        "Париж": (None, None),
    }


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        before, row = row, [i + 1]
        for j, y in enumerate(b):
            row.append(min(before[j + 1] + 1, row[j] + 1, before[j] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("scorer, threshold", [("levenshtein", 50), ("levenshtein", 80), ("levenshtein", 0), ("weighted", 70)])
def test_fuzzy_match_meets_every_candidate(spark, scorer, threshold):
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("abc", k=rng.randrange(3, 13))) for _ in range(200)})
    names = sorted({"".join(rng.choices("abcx", k=rng.randrange(1, 15))) for _ in range(60)} - set(words))
    candidates = spark.createDataFrame(list(enumerate(words)) * 3, "code int, name string").withColumn(
        "short_name", F.col("name")
    )
    found = fuzzy.fuzzy_match(
        spark.createDataFrame([(n,) for n in names], "n string"), "n", candidates,
        scorer=scorer, threshold=threshold,
    )
    got = {r["name"]: (r["code"], r["score"]) for r in found.select("name", "candidate.code", "score").collect()}

    def score(a, b):
        if scorer == "weighted":
            return similarity.weighted_ratio(a, b)
        return 100 * (1 - edits(a, b) / max(len(a), len(b)))

    assert set(got) == set(names)
    for n in names:
        best, place = max((score(n, w), -i) for i, w in enumerate(words))
        assert got[n] == ((-place, pytest.approx(best)) if best > threshold else (None, None))


def names_like(rng, n, letters="абвгдежзиклмнопрст"):
    made = set()
    while len(made) < n:
        made.add(" ".join("".join(rng.choices(letters, k=rng.randint(1, 11))) for _ in range(rng.choice([1, 1, 2, 3]))))
    return sorted(made)


def misspelt(rng, text):
    found = list(text)
    for _ in range(rng.choice([0, 1, 1, 2, 3])):
        i = rng.randrange(len(found) + 1)
        found[i : i + rng.randint(0, 1)] = rng.choice(["", "ъ", " ", "  ", "-", found[i - 1] if found else ""])
    rng.random() < 0.3 and found.extend(list(" край край"))
    return "".join(found)


@pytest.mark.parametrize("threshold", [60, 80, 90.5])
def test_weighted_pairs_lose_nothing(spark, threshold):
    """Every pair above the threshold is among those that are scored, short and odd texts included."""
    rng = random.Random(5)
    words = names_like(rng, 300) + ["а", "б", "аб", "а б в г", "", " - ", "край"]
    names = sorted({misspelt(rng, rng.choice(words)) for _ in range(250)} | {"а", "я", "аба", "край", "", "в г а"})
    made = fuzzy.prepare_candidates(
        spark.createDataFrame([(i, w) for i, w in enumerate(words)], "code int, short_name string"), "short_name"
    )
    table = spark.createDataFrame([(n, n) for n in names], "name string, __text string")
    pairs = fuzzy.weighted_pairs(table, made, threshold).join(made.listed, "__id")
    got = {(r["name"], r["code"]) for r in pairs.select("name", "candidate.code").collect()}
    want = {(n, i) for n in names for i, w in enumerate(words) if similarity.weighted_ratio(n, w) > threshold}
    assert len(want) > 100 and want <= got


def test_weighted_pairs_are_few(spark):
    """Names of ordinary length meet less than a tenth of a long list."""
    rng = random.Random(8)
    words = [w for w in names_like(rng, 3000) if len(w) > 5][:1500]
    names = [misspelt(rng, rng.choice(words)) for _ in range(400)]
    made = fuzzy.prepare_candidates(
        spark.createDataFrame([(i, w) for i, w in enumerate(words)], "code int, short_name string"), "short_name"
    )
    table = spark.createDataFrame([(n, n) for n in set(names)], "name string, __text string")
    assert fuzzy.weighted_pairs(table, made, 80).count() < len(set(names)) * len(words) / 10


def test_unknown_scorer(spark):
    with pytest.raises(ValueError):
        fuzzy.fuzzy_match(spark.range(1), "id", spark.range(1), scorer="soundex")


# ---- corrections and filters -----------------------------------------------------------------------


def test_latest_per(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 5, "x"), ("a", 1, 7, "y"), ("a", 1, None, "z"), ("a", 2, None, "w"), ("b", 1, 3, "p"), ("b", 1, 3, "q")],
        "k string, period int, doc int, v string",
    )
    assert rows(latest_per(df, ["k", "period"], "doc")) == [
        ("a", 1, 7, "y"), ("a", 2, None, "w"), ("b", 1, 3, "q"),
    ]


def test_latest_per_cuts_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 2).alias("k"), "id")
    plan = latest_per(df, "k", "id")._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_exclude_patterns(spark, rows):
    df = spark.createDataFrame([("Крым",), ("РЕСПУБЛИКА КРЫМ",), ("Тула",), (None,)], "r string")
    assert rows(filters.exclude_patterns(df, "r", ["крым"])) == [("Тула",)]
    assert rows(filters.exclude_patterns(df, "r", ["крым"], keep_null=True)) == [("Тула",), (None,)]
    assert len(rows(filters.exclude_patterns(df, "r", []))) == 3


def test_filter_entities_does_not_multiply(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "tin string, v int")
    entities = spark.createDataFrame([("a",), ("a",), (None,)], "tin string")
    assert rows(filters.filter_entities(df, entities, "tin")) == [("a", 1)]


CLASSIFIER = [("C", "10"), ("C", "10.1"), ("C", "33"), ("G", "47"), ("G", "47.1"), ("G", "47.11"), ("H", "49.4")]


@pytest.mark.parametrize(
    "codes, meant",
    [
        (["C"], {"10", "10.1", "33"}),
        (["47.1"], {"47.1", "47.11"}),
        (["47", " 49.4 "], {"47", "47.1", "47.11", "49.4"}),
        (["99"], {"99"}),
        (["AB", "", " "], {"AB"}),
    ],
)
def test_codes(spark, codes, meant):
    classifier = spark.createDataFrame(CLASSIFIER, "group string, code string")
    assert {r[0] for r in filters.expand_codes(classifier, codes).collect()} == meant
    df = spark.createDataFrame([(c,) for _, c in CLASSIFIER] + [("99",), (None,)], "activity string")
    kept = {r[0] for r in filters.filter_by_codes(df, "activity", codes, classifier).collect()}
    assert kept == meant & ({c for _, c in CLASSIFIER} | {"99"})


def test_no_codes_no_filter(spark):
    df = spark.range(3)
    classifier = spark.createDataFrame(CLASSIFIER, "group string, code string")
    assert filters.filter_by_codes(df, "id", None, classifier) is df
    assert filters.filter_by_codes(df, "id", [" "], classifier) is df


def test_new_files(spark, rows):
    found = spark.createDataFrame([("http://h/a.zip",), ("http://h/b.zip",)], "link string")
    held = spark.createDataFrame([("/data/a.zip",), ("c.zip",)], "path string")
    assert rows(filters.new_files(found, held)) == [("http://h/b.zip",)]


# ---- lookups ----------------------------------------------------------------------------------------


def test_abbreviations_first_meaning_wins(spark, rows):
    abbr = spark.createDataFrame(
        [("7", "п", "Поселение"), ("30", "п", "Поселок"), ("4", "г", "Город"), ("5", "г.", "Гора"), ("9", "край", "Край")],
        "type_id string, name string, name_full string",
    )
    got = dict(rows(lookups.abbreviation_dictionary(abbr)))
    assert got["П"] == "ПОСЕЛЕНИЕ" and got["П."] == "ПОСЕЛЕНИЕ"
    assert got["Г."] == "ГОРА" and got["Г"] == "ГОРОД" and got["ПОСЕЛОК"] == "ПОСЕЛОК"
    assert got["КРАЙ"] == "КРАЙ" and got["КРАЙ."] == "КРАЙ" and "Г.." not in got
    df = spark.createDataFrame([(1, "Г."), (2, "п"), (3, "?"), (4, None)], "id int, t string")
    dictionary = lookups.abbreviation_dictionary(abbr)
    assert rows(lookups.expand_abbr(df, "t", dictionary)) == [(1, "ГОРА"), (2, "ПОСЕЛЕНИЕ"), (3, None), (4, None)]


def test_unique_lookup(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    assert rows(lookups.unique_lookup(df, "k")) == [("b", 3), (None, 4)]
    assert rows(lookups.unique_lookup(df, "k", drop_null=True)) == [("b", 3)]


def test_many_to_one_guard(spark):
    repeated = spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(ValueError):
        lookups.attach(spark.createDataFrame([("a",)], "k string"), repeated, "k")


def test_attach_null_keys(spark, rows):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    right = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert rows(lookups.attach(df, right, "k")) == [("a", 1), (None, None)]
    assert rows(lookups.attach(df, right, "k", null_safe=True)) == [("a", 1), (None, 2)]


def test_code_lookup(spark, rows):
    df = spark.createDataFrame([("007",), ("8",), ("x",)], "place string")
    codes = spark.createDataFrame([("07", "seven")], "code string, name string")
    assert rows(lookups.code_lookup(df, "place", codes), "place", "name") == [
        ("007", "seven"), ("8", None), ("x", None)
    ]
    with pytest.raises(KeyError):
        lookups.code_lookup(df, "place", codes, missing="error")


def test_is_unique(spark):
    df = spark.createDataFrame([(1, 1), (2, 1)], "a int, b int")
    assert lookups.is_unique(df, "a") and not lookups.is_unique(df, "b")


# ---- waterfall -----------------------------------------------------------------------------------------

RUNGS = [
    Rung("s", ("a", "b", "c"), ("x", "y", "z")),
    Rung("s", ("a", "c"), ("x", "z")),
    Rung("c", ("a", "b"), ("x", "y")),
    Rung("c", ("b",), ("y",)),
]


def sequential(addresses, tables):
    """The same by trying one recipe after another on plain lists."""
    out = {}
    for address in addresses:
        out[address] = (None, None)
        for rung in RUNGS:
            key = tuple(address["abc".index(c)] for c in rung.left)
            names = ("id", "x", "y", "z")
            keyed = [(tuple(r[names.index(c)] for c in rung.right), r[0]) for r in tables[rung.source]]
            if len(rung.right) == 2:
                keyed = [(k, i) for k, i in keyed if None not in k]
            hits = [i for k, i in keyed if k == key]
            if len(hits) == 1:
                out[address] = (hits[0], rung.source)
                break
    return out


@pytest.mark.parametrize("seed, small", [(1, True), (2, False), (3, None)])
def test_waterfall_equals_one_after_another(spark, seed, small):
    rng = random.Random(seed)

    def value(n):
        return rng.choice([None, *"pqrstu"[:n]])

    addresses = sorted({(value(3), value(4), value(3)) for _ in range(150)}, key=repr)
    tables = {
        s: [(f"{s}{i}", value(3), value(4), value(3)) for i in range(25)] for s in ("s", "c")
    }
    got = waterfall_match(
        spark.createDataFrame(addresses, "a string, b string, c string"),
        {s: spark.createDataFrame(t, "id string, x string, y string, z string") for s, t in tables.items()},
        RUNGS,
        payload=["z"],
        small=small,
    ).collect()
    assert {(r.a, r.b, r.c): (r.geo_id, r.source) for r in got} == sequential(addresses, tables)
    assert len(got) == len(addresses)
    lookup = {r[0]: r[3] for t in tables.values() for r in t}
    assert all(r.geo_id is None or r.z == lookup[r.geo_id] for r in got)


@pytest.mark.parametrize("small", [True, False])
def test_waterfall_keys_of_other_types(spark, small):
    from decimal import Decimal

    kinds = {"int": 10, "long": 10, "double": 10.0, "decimal(9,2)": Decimal("10.00"), "string": "10"}
    for left, value in kinds.items():
        for right, other in kinds.items():
            got = waterfall_match(
                spark.createDataFrame([(value,), (None,)], f"a {left}"),
                {"s": spark.createDataFrame([("hit", other)], f"id string, x {right}")},
                [Rung("s", ("a",), ("x",))],
                small=small,
            )
            assert sorted(r.geo_id or "" for r in got.collect()) == ["", "hit"]


def test_small_waterfall_neither_sorts_nor_moves_addresses(spark):
    entries = prepare({"s": spark.createDataFrame([("i", "x")], "id string, x string")}, [Rung("s", ("a",), ("x",))], small=True)
    got = waterfall_match(spark.createDataFrame([("x",)], "a string"), entries, [Rung("s", ("a",), ("x",))])
    assert [(r.a, r.geo_id, r.rung) for r in got.collect()] == [("x", "i", 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "Exchange hash" not in plan


def test_waterfall_without_any_match(spark):
    got = waterfall_match(
        spark.createDataFrame([("q", "q", "q")], "a string, b string, c string"),
        {s: spark.createDataFrame([], "id string, x string, y string, z string") for s in ("s", "c")},
        RUNGS,
    ).collect()
    assert [(r.geo_id, r.rung) for r in got] == [(None, None)]


# ---- panel -----------------------------------------------------------------------------------------------


def spans(spark):
    rows = [("a", "2018-12-31", "2019-01-01"), ("b", "2019-03-01", "2019-04-01"), ("c", "2020-01-01", None), ("d", "2020-05-01", "2019-05-01")]
    return spark.createDataFrame(rows, "tin string, start_date string, end_date string").selectExpr(
        "tin", "CAST(start_date AS DATE) AS start_date", "CAST(end_date AS DATE) AS end_date"
    )


def test_years(spark, rows):
    got = rows(panel.explode_years(spans(spark), "start_date", "end_date"), "tin", "year")
    assert got == [("a", 2018), ("a", 2019), ("b", 2019), ("d", 2019), ("d", 2020)]


def test_panel_with_facts(spark, rows):
    revenue = spark.createDataFrame([("a", 2019, 5), ("a", 2019, 6), ("b", 2018, 1), (None, 2019, 9)], "tin string, year short, revenue int")
    staff = spark.createDataFrame([("a", 2019, 3), ("b", 2019, 4)], "tin string, year short, staff int")
    got = panel.panelize(spans(spark), [revenue, staff])
    assert got.columns == ["tin", "year", "start_date", "end_date", "revenue", "staff"]
    assert rows(got, "tin", "year", "revenue", "staff") == [
        ("a", 2018, None, None), ("a", 2019, 5, 3), ("a", 2019, 6, 3), ("b", 2019, None, 4),
        ("d", 2019, None, None), ("d", 2020, None, None),
    ]
    gathered = panel.panelize(spans(spark), [revenue, staff], few_per_key=True)
    assert gathered.columns == got.columns and rows(gathered) == rows(got)
    single = panel.panelize(spans(spark), [revenue, staff], one_per_year=True)
    assert ("a", 2019, 6, 3) in rows(single, "tin", "year", "revenue", "staff") and single.count() == 5
    assert panel.panelize(spans(spark)).columns == ["tin", "start_date", "end_date", "year"]


# ---- metrics -----------------------------------------------------------------------------------------------


def test_observe_and_order(spark):
    backwards = spark.range(7).select((7 - F.col("id")).alias("id"))
    df, seen = observe(order(backwards, "id"), "r")
    assert [r.id for r in df.collect()] == list(range(1, 8))
    assert seen.get["rows"] == 7
