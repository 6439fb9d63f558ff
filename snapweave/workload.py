"""Every operator on the test tables, each next to the SQL that gives the same result.

A query takes (spark, folder) and returns a DataFrame over the whole tables of that folder.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapweave import schemas
from snapweave.functions import text
from snapweave.operators import filters, fuzzy, intervals, lookups, panel
from snapweave.operators.corrections import latest_per
from snapweave.operators.metrics import observe
from snapweave.operators.waterfall import Rung, waterfall_match
from snapweave.plans import aggregate, extract, geocode, registry
from snapweave.session import scratch_path, store
from snapweave.sources import archives, links, sinks, tables, xml
from snapweave.streaming.ingest import ingest_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, without the ``q_`` that keeps it off an operator's."""

    def register(function: Query) -> Query:
        name = function.__name__.removeprefix("q_")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _shaped(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def _select(columns: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source}"


# ---- change intervals ------------------------------------------------------------------------

_CHANGES = """
SELECT {key}, {state}, {order} AS {start},
       coalesce(lead({order}) OVER w, last_seen) AS {end}
FROM (SELECT *, row_number() OVER w = 1 OR {changed} AS changed,
             max({order}) OVER (PARTITION BY {key}) AS last_seen
      FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY {order}))
WHERE changed
WINDOW w AS (PARTITION BY {key} ORDER BY {order})
"""


def _changes_sql(source: str, state: list[str], key="user_id", order="ts", start="start_ts", end="end_ts"):
    changed = " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER w" for c in state)
    return _CHANGES.format(
        source=source, state=", ".join(state), key=key, order=order, start=start, end=end, changed=changed
    )


@query(_changes_sql("events", ["event_type"]))
def collapse_changes(spark, folder):
    events = table(spark, folder, "events").select("user_id", "ts", "event_type")
    return intervals.collapse_changes(
        events, "user_id", "ts", ["event_type"], start_as="start_ts", end_as="end_ts"
    )


@query(
    _changes_sql(
        """(SELECT user_id, ts, nullif(event_type, 'error') AS activity,
                   CASE WHEN event_type = 'error' THEN event_type END AS fault FROM events)""",
        ["activity", "fault"],
    )
)
def collapse_changes_nulls(spark, folder):
    events = table(spark, folder, "events").select(
        "user_id",
        "ts",
        F.nullif("event_type", F.lit("error")).alias("activity"),
        F.when(F.col("event_type") == "error", F.col("event_type")).alias("fault"),
    )
    return intervals.collapse_changes(
        events, "user_id", "ts", ["activity", "fault"], start_as="start_ts", end_as="end_ts"
    )


@query(
    f"""
    WITH fine AS ({_changes_sql(
        "(SELECT user_id, ts, event_type, CAST(floor(value / 10) AS INTEGER) AS band FROM events)",
        ["event_type", "band"])}),
    flagged AS (
      SELECT *, row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w AS changed,
             last_value(end_ts) OVER (PARTITION BY user_id ORDER BY start_ts
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_end
      FROM fine WINDOW w AS (PARTITION BY user_id ORDER BY start_ts))
    SELECT user_id, event_type, start_ts,
           coalesce(lead(start_ts) OVER (PARTITION BY user_id ORDER BY start_ts), last_end) AS end_ts
    FROM flagged WHERE changed
    """
)
def recollapse_intervals(spark, folder):
    events = table(spark, folder, "events").select(
        "user_id", "ts", "event_type", F.floor(F.col("value") / 10).cast("int").alias("band")
    )
    fine = intervals.collapse_changes(
        events, "user_id", "ts", ["event_type", "band"], start_as="start_ts", end_as="end_ts"
    )
    return intervals.recollapse(
        fine.drop("band"), "user_id", "start_ts", "end_ts", ["event_type"]
    )


@query(
    """
    SELECT event_id, user_id,
           first_value(reading IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS reading
    FROM (SELECT *, CASE WHEN event_type <> 'error' THEN value END AS reading FROM events)
    """
)
def backfill_first(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("reading")
    )
    return intervals.backfill_first(events, "reading", "user_id", "ts").drop("ts")


@query(
    _changes_sql(
        "(SELECT event_type, ts, CAST(floor(value / 10) AS INTEGER) AS band FROM events)",
        ["band"], "event_type",
    )
)
def collapse_hot_keys(spark, folder):
    """Five keys hold all rows, each too many for one task."""
    events = table(spark, folder, "events").select(
        "event_type", "ts", F.floor(F.col("value") / 10).cast("int").alias("band")
    )
    return intervals.collapse_changes(
        events, "event_type", "ts", ["band"], start_as="start_ts", end_as="end_ts", hot_rows=1000
    )


@query(
    """
    SELECT event_id, event_type,
           first_value(reading IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts
             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS reading
    FROM (SELECT *, CASE WHEN value > 20 THEN user_id END AS reading FROM events)
    """
)
def backfill_hot_keys(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id", "event_type", "ts", F.when(F.col("value") > 20, F.col("user_id")).alias("reading")
    )
    return intervals.backfill_first(events, "reading", "event_type", "ts", hot_rows=1000).drop("ts")


# ---- corrections, membership, exclusion, identifiers, codes ------------------------------------


@query(
    """
    SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_totalprice
    FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                               ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
    """
)
def latest_correction(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("year"), "o_orderdate", "o_orderkey", "o_totalprice"
    )
    return latest_per(orders, ["o_custkey", "year"], "o_orderdate", "o_orderkey").drop("o_orderdate")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem
    WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')
    """
)
def filter_entities(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    closed = table(spark, folder, "orders").filter("o_orderstatus = 'F'")
    return filters.filter_entities(
        lines, closed.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey"
    )


@query(
    """
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE NOT (c_mktsegment ILIKE '%build%' OR c_mktsegment ILIKE '%MACH%')
    """
)
def exclude_patterns(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return filters.exclude_patterns(customers, "c_mktsegment", ["build", "MACH"])


@query(
    """
    SELECT * FROM (SELECT c_custkey, nullif(c_mktsegment, 'HOUSEHOLD') AS segment FROM customer)
    WHERE segment IS NULL OR segment NOT ILIKE '%furn%'
    """
)
def exclude_patterns_keep_null(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("segment")
    )
    return filters.exclude_patterns(customers, "segment", ["furn"], keep_null=True)


@query(
    """
    SELECT upper(c_name) AS name, lpad(ind, 12, '0') AS ind_tin, lpad(org, 4, '0') AS org_tin,
           coalesce(lpad(ind, 12, '0'), lpad(org, 4, '0')) AS tin, c_nationkey AS place
    FROM (SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(c_custkey AS VARCHAR) END AS ind,
                 CAST(c_custkey + 9900 AS VARCHAR) AS org FROM customer)
    """
)
def normalize_ids(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_custkey").cast("string")).alias("ind_tin"),
        (F.col("c_custkey") + 9900).cast("string").alias("org_tin"),
        "c_nationkey",
    )
    padded = text.upper_columns(customers, ["name"]).withColumns(
        {"ind_tin": text.pad_id("ind_tin", 12), "org_tin": text.pad_id("org_tin", 4)}
    )
    return padded.withColumn("tin", F.coalesce("ind_tin", "org_tin")).withColumnRenamed(
        "c_nationkey", "place"
    )


_CODES = ["E", "SMALL.Brand#1", " LARGE.Brand#7 ", "PROMO.Brand#99", " "]
_CLASSIFIED = """(SELECT p_partkey, p_type || '.' || p_brand AS code, left(p_type, 1) AS grp FROM part)"""
_MEANT = """(grp = 'E' OR starts_with(code, 'SMALL.Brand#1') OR starts_with(code, 'LARGE.Brand#7')
             OR code = 'PROMO.Brand#99')"""


def _classified(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey",
        F.concat_ws(".", "p_type", "p_brand").alias("code"),
        F.left("p_type", F.lit(1)).alias("grp"),
    )


@query(f"SELECT p_partkey, code FROM {_CLASSIFIED} WHERE {_MEANT}")
def code_filter(spark, folder):
    parts = _classified(spark, folder)
    classifier = parts.select("grp", "code").distinct()
    return filters.filter_by_codes(
        parts.select("p_partkey", "code"), "code", _CODES, classifier, group="grp"
    )


@query(f"SELECT DISTINCT code FROM {_CLASSIFIED} WHERE {_MEANT} UNION SELECT 'PROMO.Brand#99'")
def code_expansion(spark, folder):
    classifier = _classified(spark, folder).select("grp", "code").distinct()
    return filters.expand_codes(classifier, _CODES, group="grp")


# ---- dictionaries and lookups --------------------------------------------------------------------


def _abbreviations(spark, folder):
    """Nations by the number of their region: each abbreviation has five meanings."""
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("type_id"),
        F.when(F.col("n_regionkey") == 4, F.lit("n4."))
        .otherwise(F.concat(F.lit("n"), F.col("n_regionkey")))
        .alias("name"),
        F.initcap("n_name").alias("name_full"),
    )


_DICTIONARY = """
    abbr AS (SELECT n_nationkey AS type_id,
                    CASE WHEN n_regionkey = 4 THEN 'n4.' ELSE 'n' || n_regionkey END AS name,
                    n_name AS name_full FROM nation),
    dictionary AS (
      SELECT upper(name) AS name, upper(name_full) AS name_full
      FROM (SELECT 0 AS form, type_id, name, name_full FROM abbr
            UNION ALL SELECT 1, type_id, name_full, name_full FROM abbr
            UNION ALL SELECT 2, type_id, name || '.', name_full FROM abbr WHERE name NOT LIKE '%.')
      QUALIFY row_number() OVER (PARTITION BY upper(name) ORDER BY form, type_id) = 1)
"""


@query(
    """
    WITH abbr AS (SELECT p_partkey, CASE WHEN p_size < 25 THEN p_brand || '.' ELSE p_brand END AS name,
                         p_name AS name_full FROM part),
    forms AS (SELECT 0 AS form, p_partkey, name, name_full FROM abbr
              UNION ALL SELECT 1, p_partkey, name_full, name_full FROM abbr
              UNION ALL SELECT 2, p_partkey, name || '.', name_full FROM abbr WHERE name NOT LIKE '%.')
    SELECT upper(name) AS name, upper(name_full) AS name_full FROM forms
    QUALIFY row_number() OVER (PARTITION BY upper(name) ORDER BY form, p_partkey) = 1
    """
)
def abbreviation_dictionary(spark, folder):
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("type_id"),
        F.when(F.col("p_size") < 25, F.concat("p_brand", F.lit("."))).otherwise(F.col("p_brand")).alias("name"),
        F.col("p_name").alias("name_full"),
    )
    return lookups.abbreviation_dictionary(parts)


def _short_nation():
    number = F.col("c_nationkey") % 6
    return (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("N"), number, F.lit(".")))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("Nation_"), F.col("c_nationkey")))
        .when(F.col("c_mktsegment") != "FURNITURE", F.concat(F.lit("n"), number))
    )


_SHORT_NATION = """CASE WHEN c_mktsegment = 'BUILDING' THEN 'N' || (c_nationkey % 6) || '.'
    WHEN c_mktsegment = 'MACHINERY' THEN 'Nation_' || c_nationkey
    WHEN c_mktsegment <> 'FURNITURE' THEN 'n' || (c_nationkey % 6) END"""


@query(
    f"""
    WITH {_DICTIONARY}
    SELECT c_custkey, name_full AS place FROM customer
    LEFT JOIN dictionary ON name = upper(coalesce({_SHORT_NATION}, ''))
    """
)
def expand_abbr(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", _short_nation().alias("place"))
    dictionary = lookups.abbreviation_dictionary(_abbreviations(spark, folder))
    return lookups.expand_abbr(customers, "place", dictionary)


@query(
    """
    SELECT p_name, brand, p_size, min(p_partkey) AS p_partkey
    FROM (SELECT *, nullif(p_brand, 'Brand#1') AS brand FROM part)
    WHERE brand IS NOT NULL GROUP BY ALL HAVING count(*) = 1
    """
)
def unique_lookup(spark, folder):
    parts = table(spark, folder, "part").select(
        "p_name", F.nullif("p_brand", F.lit("Brand#1")).alias("brand"), "p_size", "p_partkey"
    )
    return lookups.unique_lookup(parts, ["p_name", "brand", "p_size"], drop_null=True)


@query(
    """
    SELECT c_custkey, lpad(CAST(c_nationkey + 5 AS VARCHAR), 3, '0') AS place, n_name
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey + 5
    """
)
def code_lookup(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.lpad((F.col("c_nationkey") + 5).cast("string"), 3, "0").alias("place")
    )
    nations = table(spark, folder, "nation").select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code"), "n_name"
    )
    return lookups.code_lookup(customers, "place", nations).drop("code")


_ADDRESSED = """
    addresses AS (SELECT c_custkey AS id, c_nationkey AS nation,
                         CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 100) AS INTEGER) END AS fine,
                         CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal / 1000) AS INTEGER) END AS coarse
                  FROM customer),
    shops AS (SELECT s_suppkey AS id, s_nationkey AS nation,
                     CASE WHEN s_acctbal >= 0 THEN CAST(floor(s_acctbal / 100) AS INTEGER) END AS fine,
                     CASE WHEN s_acctbal >= 0 THEN CAST(floor(s_acctbal / 1000) AS INTEGER) END AS coarse
              FROM supplier),
    r1 AS (SELECT nation, fine, coarse, min(id) AS id FROM shops GROUP BY ALL HAVING count(*) = 1),
    r2 AS (SELECT nation, coarse, min(id) AS id FROM shops WHERE nation IS NOT NULL AND coarse IS NOT NULL
           GROUP BY ALL HAVING count(*) = 1),
    r3 AS (SELECT fine, min(id) AS id FROM shops GROUP BY ALL HAVING count(*) = 1)
"""


@query(
    f"""
    WITH {_ADDRESSED}
    SELECT a.id, a.nation, a.fine, a.coarse,
           CAST(coalesce(r1.id, r2.id, r3.id) AS VARCHAR) AS geo_id,
           CASE WHEN coalesce(r1.id, r2.id, r3.id) IS NOT NULL THEN 's' END AS source,
           CASE WHEN r1.id IS NOT NULL THEN 1 WHEN r2.id IS NOT NULL THEN 2
                WHEN r3.id IS NOT NULL THEN 3 END AS rung
    FROM addresses a
    LEFT JOIN r1 ON r1.nation IS NOT DISTINCT FROM a.nation AND r1.fine IS NOT DISTINCT FROM a.fine
                AND r1.coarse IS NOT DISTINCT FROM a.coarse
    LEFT JOIN r2 ON r2.nation = a.nation AND r2.coarse = a.coarse
    LEFT JOIN r3 ON r3.fine IS NOT DISTINCT FROM a.fine
    """
)
def q_waterfall_match(spark, folder):
    def place(prefix, id):
        balance = F.col(f"{prefix}_acctbal")
        return [
            F.col(id).alias("id"),
            F.col(f"{prefix}_nationkey").alias("nation"),
            F.when(balance >= 0, F.floor(balance / 100).cast("int")).alias("fine"),
            F.when(balance >= 0, F.floor(balance / 1000).cast("int")).alias("coarse"),
        ]

    customers = table(spark, folder, "customer").select(*place("c", "c_custkey"))
    shops = table(spark, folder, "supplier").select(*place("s", "s_suppkey"))
    whole = ("nation", "fine", "coarse")
    rungs = [
        Rung("s", whole, whole),
        Rung("s", ("nation", "coarse"), ("nation", "coarse")),
        Rung("s", ("fine",), ("fine",)),
    ]
    return waterfall_match(customers, {"s": shops}, rungs)


def _misspelt():
    nation = F.col("c_nationkey").cast("string")
    return (
        F.when(F.col("c_mktsegment") == "BUILDING", F.concat(F.lit("Nation_"), nation))
        .when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("n"), nation))
        .when(F.col("c_mktsegment") == "FURNITURE", F.concat(F.lit("NATIN_"), nation))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("state nation_X"), nation))
        .otherwise(F.concat(F.col("c_mktsegment"), nation))
    )


def _nations(spark, folder):
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("code"),
        F.col("n_name").alias("name"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("short_name"),
    )


@query(
    """
    WITH names AS (
      SELECT DISTINCT CASE c_mktsegment WHEN 'BUILDING' THEN 'Nation_' || c_nationkey
               WHEN 'MACHINERY' THEN 'n' || c_nationkey
               WHEN 'FURNITURE' THEN 'NATIN_' || c_nationkey
               WHEN 'HOUSEHOLD' THEN 'state nation_X' || c_nationkey
               ELSE c_mktsegment || c_nationkey END AS name FROM customer),
    cleaned AS (SELECT name, trim(replace(lower(name), 'state', '')) AS cleaned FROM names),
    scored AS (
      SELECT name, n_nationkey AS code, cleaned,
             lower(name) = lower(n_name) AS full_hit,
             (1 - CAST(levenshtein(cleaned, lower(n_name)) AS DOUBLE)
                / greatest(length(cleaned), length(n_name))) * 100 AS score
      FROM cleaned, nation),
    best AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY full_hit DESC, score DESC, code) AS r
             FROM scored)
    SELECT name, CASE WHEN full_hit THEN 'full' WHEN score > 80 THEN 'fuzzy' END AS how,
           CASE WHEN full_hit THEN 100.0 WHEN score > 80 THEN round(score, 6) END AS score,
           CASE WHEN full_hit OR score > 80 THEN code END AS code
    FROM best WHERE r = 1
    """
)
def fuzzy_match(spark, folder):
    customers = table(spark, folder, "customer").select(_misspelt().alias("name"))
    found = fuzzy.fuzzy_match(
        customers, "name", _nations(spark, folder).select("code", "name"), short="name",
        words=["state"], scorer="levenshtein",
    )
    return found.select("name", "how", F.round("score", 6).alias("score"), "candidate.code")


def _meant_sql(names: str, candidates: str, words: str, threshold: int = 80) -> str:
    """Common tables up to ``meant (name, how, score, code)``: the weighted match of distinct ``names (name)``.

    ``candidates (code, full, short)`` are in lower case.  Every pair is scored: the longest common
    subsequence takes one step of big-integer arithmetic for each letter, as a recursive table.
    """
    clean = r"trim(regexp_replace({}, '[^\pL\pN_]', ' ', 'g'))"
    split = "[t FOR t IN string_split({0}, ' ') IF t <> '']"
    join = "coalesce(array_to_string(list_sort({}), ' '), '')"
    rest = "[t FOR t IN list_distinct({0}) IF NOT list_contains({1}, t)]"
    both = "[t FOR t IN list_distinct(ta) IF list_contains(tb, t)]"
    return f"""
    asked AS ({names}), cand AS ({candidates}),
    hits AS (SELECT name, (SELECT max(code) FROM cand WHERE "full" = lower(name)) AS f,
                    (SELECT max(code) FROM cand WHERE short = lower(name)) AS s FROM asked),
    pairs AS (SELECT name, code, {clean.format("regexp_replace(lower(name), " + repr(words) + ", ' ', 'g')")} AS a,
                     {clean.format('short')} AS b
              FROM hits, cand WHERE f IS NULL AND s IS NULL),
    cut AS (SELECT *, {split.format('a')} AS ta, {split.format('b')} AS tb,
                   CAST(greatest(length(a), length(b)) AS DOUBLE) / least(length(a), length(b)) AS proportion
            FROM pairs WHERE a <> '' AND b <> ''),
    sets AS (SELECT *, {join.format('ta')} AS sa, {join.format('tb')} AS sb, {join.format(both)} AS shared,
                    {join.format(rest.format('ta', 'tb'))} AS ra, {join.format(rest.format('tb', 'ta'))} AS rb FROM cut),
    spelled AS (SELECT *, trim(shared || ' ' || ra) AS first, trim(shared || ' ' || rb) AS second FROM sets),
    compared AS (
      SELECT name, code, proportion, unnest([
        {{'kind': 0, 'x': a, 'y': b}}, {{'kind': CASE WHEN proportion < 1.5 THEN 1 ELSE 2 END, 'x': sa, 'y': sb}},
        {{'kind': CASE WHEN proportion < 1.5 THEN 3 ELSE 4 END, 'x': shared, 'y': first}},
        {{'kind': CASE WHEN proportion < 1.5 THEN 3 ELSE 4 END, 'x': shared, 'y': second}},
        {{'kind': CASE WHEN proportion < 1.5 THEN 3 ELSE 4 END, 'x': first, 'y': second}},
        {{'kind': CASE WHEN proportion < 1.5 THEN 0 ELSE 5 END, 'x': a, 'y': b}}], recursive := false) AS c
      FROM spelled),
    ordered AS (
      SELECT name, code, proportion, c.kind AS kind, CASE WHEN length(c.x) <= length(c.y) THEN c.x ELSE c.y END AS x,
             CASE WHEN length(c.x) <= length(c.y) THEN c.y ELSE c.x END AS y FROM compared WHERE c.x <> '' AND c.y <> ''),
    stretches AS (
      SELECT name, code, proportion, kind, x, y FROM ordered WHERE kind IN (0, 1, 3)
      UNION ALL
      SELECT name, code, proportion, kind, x, substring(y, i, length(x))
      FROM (SELECT *, unnest(range(1, length(y) - length(x) + 2)) AS i FROM ordered WHERE kind IN (2, 4, 5))),
    walk AS (
      SELECT DISTINCT x, y, CAST(0 AS BIGINT) AS i, (CAST(1 AS BIGINT) << length(x)) - 1 AS r FROM stretches
      UNION ALL
      SELECT x, y, i + 1, ((r + hit) | (r - hit)) & ((CAST(1 AS BIGINT) << length(x)) - 1)
      FROM (SELECT *, r & CAST(list_sum([CASE WHEN substring(x, CAST(k AS BIGINT) + 1, 1) = substring(y, i + 1, 1)
                                              THEN CAST(1 AS BIGINT) << k ELSE 0 END FOR k IN range(0, length(x))]) AS BIGINT) AS hit
            FROM walk WHERE i < length(y))),
    lcs AS (SELECT x, y, length(x) - bit_count(r) AS n FROM walk WHERE i = length(y)),
    ratios AS (SELECT name, code, proportion, kind,
                      max(CAST(100.0 AS DOUBLE) * 2 * n / (length(x) + length(y))) AS ratio
               FROM stretches JOIN lcs USING (x, y) GROUP BY ALL),
    weights AS (SELECT *, CAST(CASE WHEN proportion > 8 THEN 0.6 ELSE 0.9 END AS DOUBLE) AS scale FROM ratios),
    scored AS (
      SELECT name, code, round_even(max(CASE kind WHEN 0 THEN ratio
               WHEN 1 THEN CAST(0.95 AS DOUBLE) * round_even(ratio, 0) WHEN 3 THEN CAST(0.95 AS DOUBLE) * round_even(ratio, 0)
               WHEN 5 THEN scale * round_even(ratio, 0)
               ELSE CAST(0.95 AS DOUBLE) * scale * round_even(ratio, 0) END), 0) AS score
      FROM weights GROUP BY name, code),
    best AS (SELECT name, max(score) AS score, arg_min(code, (-score, code)) AS code
             FROM scored WHERE score > {threshold} GROUP BY name),
    meant AS (
      SELECT h.name, CASE WHEN f IS NOT NULL THEN 'full' WHEN s IS NOT NULL THEN 'short' WHEN b.code IS NOT NULL THEN 'fuzzy' END AS how,
             CASE WHEN coalesce(f, s) IS NOT NULL THEN 100.0 ELSE b.score END AS score, coalesce(f, s, b.code) AS code
      FROM hits h LEFT JOIN best b ON b.name = h.name)
    """


_MISSPELT = """
    SELECT DISTINCT CASE c_mktsegment WHEN 'BUILDING' THEN 'Nation_' || c_nationkey
             WHEN 'MACHINERY' THEN 'n' || c_nationkey
             WHEN 'FURNITURE' THEN 'NATIN_' || c_nationkey
             WHEN 'HOUSEHOLD' THEN 'state nation_X' || c_nationkey
             ELSE c_mktsegment || c_nationkey END AS name FROM customer
"""


@query(
    f"""
    WITH RECURSIVE {_meant_sql(
        _MISSPELT, "SELECT n_nationkey AS code, lower(n_name) AS full, 'n' || n_nationkey AS short FROM nation", r'\bstate\b'
    )}
    SELECT name, how, CAST(score AS DOUBLE) AS score, code FROM meant
    """
)
def fuzzy_match_weighted(spark, folder):
    customers = table(spark, folder, "customer").select(_misspelt().alias("name"))
    found = fuzzy.fuzzy_match(customers, "name", _nations(spark, folder), words=["state"])
    return found.select("name", "how", "score", "candidate.code")


# ---- shaping -------------------------------------------------------------------------------------


@query(
    """
    WITH places AS (
      SELECT 'c' AS type, c_custkey AS geo_id, c_name AS settlement, c_acctbal AS lat, c_nationkey AS area,
             c_mktsegment AS kind FROM customer
      UNION ALL SELECT 's', s_suppkey, s_name, s_acctbal, s_nationkey, NULL FROM supplier),
    wanted AS (
      SELECT o_orderkey, o_custkey AS geo_id,
             CASE WHEN o_orderstatus = 'F' THEN 's' ELSE 'c' END AS type FROM orders)
    SELECT w.o_orderkey, w.geo_id, w.type, p.settlement, p.lat, p.area, p.kind
    FROM wanted w LEFT JOIN places p ON p.geo_id = w.geo_id AND p.type = w.type
    """
)
def tagged_union(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.lit("c").alias("type"), F.col("c_custkey").alias("geo_id"), F.col("c_name").alias("settlement"),
        F.col("c_acctbal").alias("lat"), F.col("c_nationkey").alias("area"),
        F.col("c_mktsegment").alias("kind"),
    )
    suppliers = table(spark, folder, "supplier").select(
        F.lit("s").alias("type"), F.col("s_suppkey").alias("geo_id"), F.col("s_name").alias("settlement"),
        F.col("s_acctbal").alias("lat"), F.col("s_nationkey").alias("area"),
    )
    places = customers.unionByName(suppliers, allowMissingColumns=True)
    wanted = table(spark, folder, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("geo_id"),
        F.when(F.col("o_orderstatus") == "F", "s").otherwise("c").alias("type"),
    )
    return lookups.attach(wanted, places, ["geo_id", "type"])


_KINDS = """CASE p_type WHEN 'ECONOMY' THEN 'г' WHEN 'LARGE' THEN 'р-н' WHEN 'SMALL' THEN 'у'
            WHEN 'PROMO' THEN 'посёлок' END"""


@query(
    f"""
    SELECT p_partkey,
           CASE WHEN n IS NULL THEN NULL WHEN t IS NULL THEN n ELSE trim(n || ' ' || t) END AS label,
           CASE WHEN n IS NULL THEN NULL WHEN t IS NULL THEN n
                WHEN t = 'г' THEN t || ' ' || n ELSE n || ' ' || t END AS prepended,
           CASE WHEN n IS NULL OR t IS NULL THEN NULL WHEN t = 'г' THEN 'Город ' || n
                WHEN t = 'р-н' THEN n || ' район' WHEN t = 'у' THEN n || ' улус' ELSE n END AS area,
           replace(upper(t), 'Ё', 'Е') AS key
    FROM (SELECT p_partkey, CASE WHEN p_size <> 7 THEN p_name END AS n, {_KINDS} AS t FROM part)
    """
)
def label_join(spark, folder):
    kind = F.create_map(*[F.lit(x) for x in ("ECONOMY", "г", "LARGE", "р-н", "SMALL", "у", "PROMO", "посёлок")])
    parts = table(spark, folder, "part").select(
        "p_partkey",
        F.when(F.col("p_size") != 7, F.col("p_name")).alias("n"),
        F.try_element_at(kind, F.col("p_type")).alias("t"),
    )
    return parts.select(
        "p_partkey",
        text.join_name_type("n", "t").alias("label"),
        text.join_name_type("n", "t", ["г"]).alias("prepended"),
        text.area_label(F.col("n"), F.col("t")).alias("area"),
        text.text_key("t").alias("key"),
    )


@query(
    """
    SELECT c_custkey, coalesce(n_name, 'NATION_0') AS region,
           CASE WHEN segment IS NULL AND coalesce(n_name, 'NATION_0') IN ('NATION_0', 'NATION_7')
                THEN coalesce(n_name, 'NATION_0') ELSE segment END AS settlement
    FROM (SELECT *, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer)
    LEFT JOIN nation ON n_nationkey = c_nationkey + 3
    """
)
def default_fill(spark, folder):
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("k"), "n_name")
    customers = table(spark, folder, "customer").select(
        "c_custkey", (F.col("c_nationkey") + 3).alias("k"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("settlement")
    )
    named = lookups.attach(customers, nations, "k").withColumn(
        "region", F.coalesce("n_name", F.lit("NATION_0"))
    )
    return named.withColumn(
        "settlement", text.default_settlement("region", "settlement", ["NATION_0", "NATION_7"])
    ).select("c_custkey", "region", "settlement")


# ---- panel -----------------------------------------------------------------------------------------


def _order_spans(spark, folder):
    return table(spark, folder, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").cast("date").alias("start_date"),
        F.max("o_orderdate").cast("date").alias("end_date"),
    )


@query(
    """
    SELECT *, CAST(unnest(range(year(start_date), year(end_date) + 1)) AS INTEGER) AS year
    FROM (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS start_date,
                 CAST(max(o_orderdate) AS DATE) AS end_date FROM orders GROUP BY 1)
    """
)
def explode_years(spark, folder):
    return panel.explode_years(_order_spans(spark, folder), "start_date", "end_date")


_STATUS_PANEL = """
    WITH snapshots AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, min(o_orderstatus) AS status,
                              min(o_orderpriority) AS priority FROM orders GROUP BY 1, 2),
    intervals AS ({changes}),
    years AS (SELECT *, CAST(unnest(range(year(start_date), year(end_date) + 1)) AS INTEGER) AS year
              FROM intervals),
    spent AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
                     CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS revenue
              FROM orders GROUP BY 1, 2 HAVING count(*) > 1),
    shipped AS (SELECT o_custkey, CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS shipments
                FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1, 2)
    SELECT y.o_custkey, y.year, status, priority, start_date, end_date, revenue, shipments
    FROM years y
    LEFT JOIN spent s ON s.o_custkey = y.o_custkey AND s.year = y.year
    LEFT JOIN shipped h ON h.o_custkey = y.o_custkey AND h.year = y.year
""".format(
    changes=_changes_sql(
        "snapshots", ["status", "priority"], "o_custkey", "day", "start_date", "end_date"
    )
)


@query(_STATUS_PANEL)
def panelize(spark, folder):
    """States of customers over time, spread over years, with yearly facts beside them."""
    orders = table(spark, folder, "orders")
    snapshots = orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day")).agg(
        F.min("o_orderstatus").alias("status"), F.min("o_orderpriority").alias("priority")
    )
    states = intervals.collapse_changes(snapshots, "o_custkey", "day", ["status", "priority"])
    spent = (
        orders.groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"),
            F.count(F.lit(1)).alias("n"),
        )
        .filter("n > 1")
        .drop("n")
    )
    shipped = (
        table(spark, folder, "lineitem")
        .select(F.col("l_orderkey").alias("o_orderkey"), F.year("l_shipdate").alias("year"))
        .join(orders.select("o_orderkey", "o_custkey"), "o_orderkey")
        .groupBy("o_custkey", "year")
        .agg(F.count(F.lit(1)).alias("shipments"))
    )
    return panel.panelize(states, [spent, shipped], key="o_custkey")


# ---- sources and sinks ---------------------------------------------------------------------------

_ORDER_MAP = {
    "@Номер": "number",
    "Клиент/@Код": "customer",
    "Клиент/Заказ/@Статус": "status",
    "Клиент/Заказ/@Сумма": "total",
    "@Дата": "day",
}
_ORDER_FILE = {"@ИдФайл": "file_id", "@КолДок": "doc_cnt"}


def _spread(df: DataFrame) -> DataFrame:
    """A small file is read by one task; work on its rows is worth more."""
    tasks = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks)


def _order_xml(spark, folder, broken: bool = False):
    """Each order as a small XML file with two records; orders under way are cut off if ``broken``."""
    number = F.col("o_orderkey").cast("string")
    record = F.concat(
        F.lit('<Документ Номер="'), number, F.lit('" Дата="'), F.date_format("o_orderdate", "dd.MM.yyyy"),
        F.lit('"><Клиент Код="'), F.col("o_custkey").cast("string"),
        F.lit('"><Заказ Статус="'), F.col("o_orderstatus"), F.lit('"/><Заказ Статус="'),
        F.col("o_orderpriority"), F.lit('" Сумма="'), F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        F.lit('"/></Клиент></Документ>'),
    )
    second = F.concat(F.lit('<Документ Номер="'), number, F.lit('-2"/>'))
    tail = F.when(F.lit(broken) & (F.col("o_orderstatus") == "P"), "</Фай").otherwise("</Файл>")
    return _spread(table(spark, folder, "orders")).select(
        F.col("o_orderkey").alias("source"),
        F.concat(F.lit('<Файл ИдФайл="F'), number, F.lit('" КолДок="2">'), record, second, tail).alias("xml"),
    )


_XML_ROWS = """
    SELECT CAST(o_orderkey AS VARCHAR) AS number, CAST(o_custkey AS VARCHAR) AS customer,
           o_orderstatus || ',' || o_orderpriority AS status,
           CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS total,
           strftime(o_orderdate, '%d.%m.%Y') AS day, 'F' || o_orderkey AS file_id, '2' AS doc_cnt
    FROM orders {where}
    UNION ALL
    SELECT o_orderkey || '-2', NULL, NULL, NULL, NULL, 'F' || o_orderkey, '2' FROM orders {where}
"""


@query(_XML_ROWS.format(where="WHERE o_orderstatus <> 'P'"))
def xml_flatten(spark, folder):
    rows, _ = extract.read_texts(
        _order_xml(spark, folder, broken=True), _ORDER_MAP, file_attributes=_ORDER_FILE
    )
    return rows.drop("source")


@query("SELECT o_orderkey AS source FROM orders WHERE o_orderstatus = 'P'")
def xml_rejects(spark, folder):
    return extract.read_texts(_order_xml(spark, folder, broken=True), _ORDER_MAP)[1]


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS number, strftime(o_orderdate, '%d.%m.%Y') AS day FROM orders
    UNION ALL SELECT o_orderkey || '-2', NULL FROM orders
    """
)
def snapshot_sample(spark, folder):
    """A narrower element map than the full extract, without provenance."""
    narrow = {path: c for path, c in _ORDER_MAP.items() if c in ("number", "day")}
    return extract.read_texts(_order_xml(spark, folder), narrow)[0].drop("source")


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS number, o_orderstatus || ',' || o_orderpriority AS status
    FROM orders
    WHERE starts_with(o_orderstatus || ',' || o_orderpriority, 'F,1')
       OR starts_with(o_orderstatus || ',' || o_orderpriority, 'O,')
    """
)
def code_filtered_extract(spark, folder):
    orders = table(spark, folder, "orders")
    classifier = orders.select(
        F.lit("A").alias("group"), F.concat_ws(",", "o_orderstatus", "o_orderpriority").alias("code")
    ).distinct()
    rows, _ = extract.read_texts(
        _order_xml(spark, folder), {p: c for p, c in _ORDER_MAP.items() if c in ("number", "status")},
        code_column="status", codes=["F,1", "O,"], classifier=classifier,
    )
    return rows.drop("source")


_ARCHIVE_ROWS = 200_000
"""An archive's list is held by the task that writes it, so their number grows with the rows."""


def _archive_count(rows: DataFrame) -> int:
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // _ARCHIVE_ROWS))


def _zip_rows(rows: DataFrame, target: str, prefix: str = "data") -> None:
    """Write the texts as members of ZIP files, one archive per task, plus one member of no interest."""

    class Sink(io.RawIOBase):
        """A pyarrow stream that Python can buffer."""

        def __init__(self, stream):
            self._stream = stream

        def writable(self) -> bool:
            return True

        def write(self, data) -> int:
            self._stream.write(data)
            return len(data)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(target)
        name = f"{path}/{prefix}-{TaskContext.get().partitionId()}.zip"
        count = 0
        with (
            system.open_output_stream(name) as stream, io.BufferedWriter(Sink(stream), 1 << 20) as out,
            zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive,
        ):
            for batch in batches:
                for source, xml_bytes in zip(*(batch.column(c).to_pylist() for c in ("source", "xml")), strict=True):
                    archive.writestr(f"part-{source}.xml", xml_bytes)
                    count += 1
            archive.writestr("readme.txt", "not data")
        yield pa.RecordBatch.from_pydict({"n": pa.array([count], pa.int64())})

    system, path = fs.FileSystem.from_uri(target)
    system.create_dir(path, recursive=True)
    rows.withColumn("xml", F.col("xml").cast("binary")).mapInArrow(write, "n long").agg(F.sum("n")).first()


def _uri(path: str) -> str:
    return path if "://" in path else f"file://{path.removeprefix('file:')}"


@query(_XML_ROWS.format(where=""))
def archive_scan(spark, folder):
    target = _uri(scratch_path(spark, "archives"))
    texts = _order_xml(spark, folder)
    _zip_rows(texts.repartition(max(16, texts.count() // 10_000), "source"), target)
    members = archives.manifest(archives.list_archives(spark, target))
    rows, _ = extract.read_texts(
        archives.member_texts(members, schemas.RECORD_TAG), _ORDER_MAP, file_attributes=_ORDER_FILE
    )
    return rows.drop("path", "member", "part")


@query("SELECT c_custkey, c_name, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS segment FROM customer")
def csv_roundtrip(spark, folder):
    customers = table(spark, folder, "customer").select(
        "c_custkey", "c_name", "c_acctbal", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    target = scratch_path(spark, "customers") + ".csv"
    sinks.write_csv(customers, target, sort_by=["c_custkey"])
    return tables.read_csv(spark, target, customers.schema)


_ODD_CELLS = {
    "id": "CAST(c_custkey AS STRING)",
    "balance": "CASE WHEN c_custkey % 5 = 0 THEN 'about ' || CAST(c_custkey AS STRING) ELSE CAST(c_custkey AS STRING) || '.25' END",
    "nation": "CASE WHEN c_custkey % 7 = 0 THEN '9999999999' WHEN c_custkey % 7 <> 1 THEN CAST(c_nationkey AS STRING) END",
    "day": "CASE WHEN c_custkey % 6 = 0 THEN '2020-02-30' ELSE '2020-02-28' END",
}


@query(
    f"""
    WITH cells AS ({_select(_ODD_CELLS, 'customer')})
    SELECT 'csv' AS source, id, 'balance' AS "column", balance AS value FROM cells WHERE starts_with(balance, 'about')
    UNION ALL SELECT 'csv', id, 'nation', nation FROM cells WHERE nation = '9999999999'
    UNION ALL SELECT 'csv', id, 'day', day FROM cells WHERE day = '2020-02-30'
    UNION ALL SELECT 'csv', 'sum', 'line', 'sum,' || count(*) FROM cells
    UNION ALL SELECT 'xml', CAST(o_custkey AS VARCHAR), 'revenue', o_orderstatus FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'xml', CAST(o_custkey AS VARCHAR), 'doc_date', strftime(o_orderdate, '%Y') FROM orders WHERE o_orderstatus = 'O'
    """
)
def cast_rejects(spark, folder):
    """Cells and attributes that do not fit their type, and lines of another length, are kept as text."""
    schema = T.StructType.fromDDL("id string, balance double, nation int, day date")
    target = scratch_path(spark, "cells") + ".csv"
    cells = _shaped(table(spark, folder, "customer"), _ODD_CELLS)
    total = cells.agg(F.concat(F.lit("sum,"), F.count(F.lit(1)).cast("string")).alias("value"))
    lines = cells.select(F.concat_ws(",", *[F.coalesce(c, F.lit("NA")) for c in cells.columns]).alias("value"))
    lines.union(total).write.text(target)
    read = tables.read_csv(spark, target, schema, rescue="rescued", header=False)
    from_csv = xml.quarantine(read, "rescued", "id").select(F.lit("csv").alias("source"), "*")
    odd = _fact_rows(spark, folder).withColumns(
        {
            "revenue": F.when(F.col("o_orderstatus") == "F", F.col("o_orderstatus")).otherwise(F.lit("1.5")),
            "doc_date": F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy")).otherwise(
                F.date_format("o_orderdate", "dd.MM.yyyy")
            ),
            "data_date": F.date_format("data_date", "dd.MM.yyyy"),
        }
    )
    uri = _archived(odd, "revexp", "o_custkey", scratch_path(spark, "odd"), dates=False)
    rows, _ = extract.extract_archives(archives.list_archives(spark, uri), "revexp", rescue="rescued")
    from_xml = xml.quarantine(rows, "rescued", "org_tin").withColumnRenamed("org_tin", "id")
    return from_csv.union(from_xml.select(F.lit("xml").alias("source"), "*"))


@query(
    """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    UNION ALL
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) FROM orders WHERE o_orderstatus = 'F'
    """
)
def sorted_export(spark, folder):
    """A sorted table by year that is replaced once and then added to."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), "o_orderstatus"
    )
    target = scratch_path(spark, "orders")
    places = {"partition_by": ["year"], "sort_by": ["o_orderkey"]}
    closed = orders.filter("o_orderstatus = 'F'").drop("o_orderstatus")
    sinks.write_parquet(closed, target, **places)
    sinks.write_parquet(orders.drop("o_orderstatus"), target, **places)
    sinks.write_parquet(closed, target, clear=False, **places)
    return spark.read.parquet(target)


@query("SELECT event_id, user_id, event_type, value FROM events")
def incremental_ingest(spark, folder):
    """Events arrive in two rounds of files; each run of the ingest takes only what is new."""
    events = table(spark, folder, "events").select("event_id", "user_id", "event_type", "value")
    inbox, target, ledger = (scratch_path(spark, n) for n in ("inbox", "gathered", "ledger"))
    early = F.col("event_type").isin("click", "view")
    for part in (events.filter(early), events.filter(~early)):
        sinks.write_parquet(part, inbox, clear=False)
        ingest_files(spark, inbox, target, ledger, format="parquet", schema=events.schema)
    ingest_files(spark, inbox, target, ledger, format="parquet", schema=events.schema)
    return spark.read.parquet(target)


@query(
    """
    SELECT page_id, url, replace(unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1)), '&amp;', '&') AS link
    FROM pages
    """
)
def q_links(spark, folder):
    return links.extract_links(table(spark, folder, "pages"))


@query(
    """
    SELECT page_id, url AS link FROM pages p
    WHERE regexp_extract(url, '[^/]*$') NOT IN
          (SELECT regexp_extract(url, '[^/]*$') FROM pages WHERE contains(url, '/en/'))
    """
)
def new_files(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", F.col("url").alias("link"))
    held = pages.filter(F.contains("link", F.lit("/en/"))).select(F.col("link").alias("path"))
    return filters.new_files(pages, held)


@query(
    """
    SELECT page_id, unnest([url, url || '.zip', url || '.old']) AS link FROM pages
    WHERE contains(url, '/en/') OR contains(url, '/de/')
    """
)
def dataset_links(spark, folder):
    """Each page's address set into a description table; half of the pages have other titles."""
    expected = schemas.DATASET_PAGE_ROWS
    fits = F.contains("url", F.lit("/en/")) | F.contains("url", F.lit("/de/"))
    title = F.when(fits, expected[16]).otherwise("...")
    escaped = F.replace("url", F.lit("&"), F.lit("&amp;"))
    page = F.concat(
        F.lit("<html><table class='border_table'><tr><th>x</th></tr><tr><td>8</td><td> "),
        F.lit(expected[8]),
        F.lit('</td><td><a href=" '), escaped, F.lit('">one</a></td></tr><tr><td>9</td><td>t</td></tr>'),
        F.lit("<tr><td><b>16</b></td><td>"), title, F.lit("</td><td><a class=z href='"), escaped,
        F.lit(".zip'>two</a> <a href=\""), escaped, F.lit('.old">three</a></td></tr></table>'),
        F.col("html"),
    )
    pages = table(spark, folder, "pages").select("page_id", page.alias("html"))
    return links.dataset_links(pages, expected)


# ---- yearly facts, metrics -------------------------------------------------------------------------


@query(
    """
    WITH latest AS (
      SELECT * FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey, date_trunc('quarter', o_orderdate)
                                 ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
    SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS tin,
           CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey, o_totalprice
    FROM latest
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """
)
def yearly_facts(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("tin"),
        F.when(F.col("c_mktsegment") == "BUILDING", 1).otherwise(2).alias("kind"),
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("org_tin"),
        F.date_trunc("quarter", "o_orderdate").cast("date").alias("data_date"),
        F.col("o_orderdate").alias("doc_date"),
        "o_orderkey",
        "o_totalprice",
    )
    return aggregate.yearly_facts(orders, ["o_orderkey", "o_totalprice"], customers)


@query(
    f"""
    SELECT 'read' AS stage, count(*) AS rows FROM events
    UNION ALL SELECT 'changes', count(*) FROM ({_changes_sql("events", ["event_type"])})
    """
)
def row_metrics(spark, folder):
    """Rows read and rows kept, both counted while the intervals are written."""
    events, read = observe(table(spark, folder, "events").select("user_id", "ts", "event_type"), "read")
    changes, kept = observe(
        intervals.collapse_changes(events, "user_id", "ts", ["event_type"], hot_rows=None), "changes"
    )
    sinks.write_parquet(changes, scratch_path(spark, "changes"))
    counts = [(name, seen.get["rows"]) for name, seen in (("read", read), ("changes", kept))]
    return spark.createDataFrame(counts, "stage string, rows long")


# ---- registry: aggregate, geocode, panel -------------------------------------------------------------
#
# Orders stand for the snapshots of their customers.  These expressions mean the same to Spark and
# to the SQL beside it.

_PERSON = "c_mktsegment NOT IN ('BUILDING', 'MACHINERY')"
_SME = {
    "kind": f"CAST(CASE WHEN {_PERSON} THEN 2 ELSE 1 END AS TINYINT)",
    "category": "CAST(CASE WHEN o_orderpriority < '3' THEN 1 ELSE 2 END AS TINYINT)",
    "reestr_date": "CAST(NULL AS DATE)",
    "data_date": "CAST(o_orderdate AS DATE)",
    "ind_tin": f"CASE WHEN {_PERSON} THEN CAST(c_custkey AS STRING) END",
    "ind_number": "CAST(NULL AS STRING)",
    "first_name": f"CASE WHEN {_PERSON} THEN lower(c_name) END",
    "last_name": f"CASE WHEN {_PERSON} THEN c_name END",
    "patronymic": "CAST(NULL AS STRING)",
    "org_name": f"CASE WHEN NOT ({_PERSON}) THEN c_name END",
    "org_short_name": "CAST(NULL AS STRING)",
    "org_tin": f"CASE WHEN NOT ({_PERSON}) THEN CAST(c_custkey AS STRING) END",
    "org_number": "CASE WHEN o_orderpriority > '4' THEN 'N' || CAST(c_custkey AS STRING) END",
    "region_code": "CAST(c_nationkey AS TINYINT)",
    "region_name": "CASE WHEN c_acctbal > -500 THEN CASE WHEN o_orderstatus = 'F' THEN n_name ELSE lower(n_name) END END",
    "region_type": "CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'r' || CAST(n_regionkey AS STRING) || '.' END",
    "district_name": """CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'd' || CAST(c_custkey % 4 AS STRING)
                        WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') AND c_custkey % 3 = 0
                        THEN 'd' || CAST(c_nationkey % 4 AS STRING) END""",
    "district_type": "CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN 'R1' WHEN c_mktsegment = 'BUILDING' THEN 'ZZ' END",
    "city_name": """CASE WHEN c_mktsegment = 'FURNITURE' AND c_custkey % 5 = 1 THEN 'D' || CAST(c_nationkey % 4 AS STRING)
                    WHEN c_mktsegment IN ('FURNITURE', 'HOUSEHOLD') THEN 'C' || CAST(c_nationkey AS STRING) END""",
    "city_type": "CASE WHEN c_mktsegment = 'HOUSEHOLD' AND c_custkey % 2 = 0 THEN 'R2' END",
    "settlement_name": "CASE WHEN c_mktsegment <> 'FURNITURE' THEN 'v' || CAST(c_custkey % 5 AS STRING) END",
    "settlement_type": "CASE WHEN o_orderpriority < '5' THEN 'R' || CAST(c_custkey % 3 AS STRING) END",
    "activity_code_main": "o_orderstatus",
    "file_id": "CAST(NULL AS STRING)",
    "doc_cnt": "CAST(NULL AS INT)",
}
_REGION_ROWS = {
    "code": "lpad(CAST(n_nationkey AS STRING), 2, '0')",
    "name": "n_name || ' ' || r_name",
    "short_name": "n_name",
    "iso_code": "'ISO-' || CAST(n_nationkey AS STRING)",
}
_CITY_ROWS = {
    "region": "n_name",
    "area": "'D' || CAST(n_nationkey % 4 AS STRING)",
    "area_type": "CASE WHEN n_nationkey % 3 = 0 THEN 'г' WHEN n_nationkey % 3 = 1 THEN 'р-н' END",
    "city": "CASE WHEN n_nationkey % 2 = 0 THEN 'c' || CAST(n_nationkey AS STRING) END",
    "settlement": "CAST(NULL AS STRING)",
    "oktmo": "'8' || CAST(n_nationkey AS STRING)",
    "geo_lat": "CAST(n_nationkey AS STRING) || '.5'",
    "geo_lon": "CAST(n_nationkey AS STRING) || '.25'",
}
_SETTLEMENT_ROWS = {
    "id": "CAST(s_suppkey AS STRING)",
    "region": "n_name || ' ' || r_name",
    "municipality": """CASE WHEN s_suppkey % 3 = 0 THEN 'D' || CAST(s_suppkey % 4 AS STRING)
                        WHEN s_suppkey % 3 = 1 THEN 'D' || CAST(s_suppkey % 4 AS STRING) || ' America'
                        ELSE 'C' || CAST(s_nationkey AS STRING) END""",
    "settlement": "'V' || CAST(s_suppkey % 5 AS STRING)",
    "type": "'r' || CAST(s_suppkey % 3 AS STRING)",
    "oktmo": "'9' || CAST(s_suppkey AS STRING)",
    "latitude_dd": "CAST(s_suppkey AS STRING) || '.5'",
    "longitude_dd": "CAST(s_suppkey AS STRING) || '.75'",
}
_REVEXP = {
    "org_tin": "CAST(o_custkey AS STRING)",
    "revenue": "CAST(o_totalprice AS DECIMAL(18, 2))",
    "expenditure": "CAST(o_orderkey AS DECIMAL(18, 2))",
    "data_date": "make_date(CAST(year(o_orderdate) AS INT), 12, 31)",
    "doc_date": "CAST(o_orderdate AS DATE)",
}
_EMPL = {
    "org_tin": "CAST(o_custkey AS STRING)",
    "employees_count": "CAST(o_orderkey % 250 AS INT)",
    "data_date": "make_date(CAST(year(o_orderdate) AS INT), 6, 30)",
    "doc_date": "CAST(o_orderdate AS DATE)",
}


def _nation_region(spark, folder):
    region = table(spark, folder, "region")
    return table(spark, folder, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))


def _snapshots(spark, folder) -> DataFrame:
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    placed = customers.join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return _shaped(orders.join(placed, F.col("o_custkey") == F.col("c_custkey")), _SME)


def _geo_lookups(spark, folder) -> geocode.GeoLookups:
    nations = _nation_region(spark, folder)
    suppliers = table(spark, folder, "supplier").join(
        nations, F.col("s_nationkey") == F.col("n_nationkey")
    )
    region = table(spark, folder, "region")
    return geocode.GeoLookups(
        abbreviations=region.selectExpr(
            "r_regionkey AS type_id", "'R' || CAST(r_regionkey AS STRING) AS name",
            "initcap(r_name) AS name_full",
        ),
        regions=_shaped(nations, _REGION_ROWS),
        cities=_shaped(nations, _CITY_ROWS),
        settlements=_shaped(suppliers, _SETTLEMENT_ROWS),
    )


@query(
    f"""
    WITH nr AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey),
    regions AS ({_select(_REGION_ROWS, 'nr')}),
    named AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN lower(n_name)
                       WHEN 'MACHINERY' THEN lower(n_name || ' ' || r_name)
                       WHEN 'FURNITURE' THEN CAST(c_nationkey + 4 AS VARCHAR)
                       WHEN 'HOUSEHOLD' THEN lpad(CAST(c_nationkey AS VARCHAR), 3, '0') END AS spelled
              FROM customer JOIN nr ON n_nationkey = c_nationkey)
    SELECT c_custkey, k.name AS region, k.code AS region_code, k.iso_code AS region_iso_code
    FROM named LEFT JOIN regions k ON lower(spelled) IN (lower(k.name), lower(k.short_name))
      OR TRY_CAST(spelled AS INTEGER) = CAST(k.code AS INTEGER)
    """
)
def normalize_regions(spark, folder):
    """Region names as they come, by full name, short name or number."""
    nations = _nation_region(spark, folder)
    spelled = (
        F.when(F.col("c_mktsegment") == "BUILDING", F.lower("n_name"))
        .when(F.col("c_mktsegment") == "MACHINERY", F.lower(F.concat_ws(" ", "n_name", "r_name")))
        .when(F.col("c_mktsegment") == "FURNITURE", (F.col("c_nationkey") + 4).cast("string"))
        .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lpad(F.col("c_nationkey").cast("string"), 3, "0"))
    )
    customers = (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", spelled.alias("region"))
    )
    return geocode.normalize_regions(customers, "region", _shaped(nations, _REGION_ROWS))


_UPPER = [*schemas.NAME_COLUMNS, *schemas.ADDRESS_COLUMNS]
_AGGREGATED = [c for c in schemas.SME_AGGREGATED.names if c not in ("start_date", "end_date")]


def _nulls_first(columns: Iterable[str]) -> str:
    return ", ".join(f"{c} NULLS FIRST" for c in columns)


def _changed(columns: Iterable[str], window: str) -> str:
    return " OR ".join(f"{c} IS DISTINCT FROM lag({c}) OVER {window}" for c in columns)


_BASE_SQL = f"""
    sme AS ({_select(_SME, '''orders JOIN customer ON o_custkey = c_custkey
                              JOIN nation ON c_nationkey = n_nationkey''')}),
    entities AS (
      SELECT kind, category,
             coalesce(lpad(ind_tin, 12, '0'), lpad(org_tin, 10, '0')) AS tin,
             coalesce(ind_number, org_number) AS reg_number,
             {', '.join(f'upper({c}) AS {c}' for c in _UPPER)},
             region_code, activity_code_main, data_date
      FROM sme WHERE NOT (region_name ILIKE '%nation_24%')),
    flagged AS (
      SELECT *, row_number() OVER w = 1 OR {_changed(schemas.TRACKED_COLUMNS, 'w')} AS changed,
             first_value(reg_number IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS filled,
             max(data_date) OVER (PARTITION BY tin) AS last_seen
      FROM entities
      WINDOW w AS (PARTITION BY tin ORDER BY data_date, {_nulls_first(c for c in _AGGREGATED if c != 'tin')})),
    aggregated AS (
      SELECT {', '.join('filled AS reg_number' if c == 'reg_number' else c for c in _AGGREGATED)},
             data_date AS start_date,
             coalesce(lead(data_date) OVER (PARTITION BY tin ORDER BY data_date,
                        {_nulls_first(c for c in _AGGREGATED if c != 'tin')}), last_seen) AS end_date
      FROM flagged WHERE changed)
"""


def _key(column: str) -> str:
    return f"replace(upper({column}), 'Ё', 'Е')"


def _geo_sql(misspelt: bool = False) -> str:
    """Common tables up to ``located``: the aggregated rows with their place columns."""
    parts = ("region", "district", "city", "settlement")
    expand = "(SELECT full_name FROM dictionary d WHERE d.name = upper(coalesce({0}, '')))"
    known = "(SELECT {1} FROM regions k WHERE lower({0}) IN (lower(k.name), lower(k.short_name)))"
    rungs = geocode.RUNGS
    unique = []
    for i, r in enumerate(rungs):
        keys = ", ".join(r.right)
        present = " AND ".join(f"{c} IS NOT NULL" for c in r.right) if len(r.right) == 2 else "TRUE"
        unique.append(
            f"u{i} AS (SELECT {keys}, min(id) AS id FROM {r.source}_keys WHERE {present} "
            f"GROUP BY {keys} HAVING count(*) = 1)"
        )
    joins = " ".join(
        f"LEFT JOIN u{i} ON "
        + " AND ".join(f"u{i}.{b} IS NOT DISTINCT FROM a.{a}" for a, b in zip(r.left, r.right))
        for i, r in enumerate(rungs)
    )
    first = " ".join(f"WHEN u{i}.id IS NOT NULL THEN '{r.source}' || u{i}.id" for i, r in enumerate(rungs))
    numbers = " ".join(f"WHEN u{i}.id IS NOT NULL THEN {i + 1}" for i in range(len(rungs)))
    types = ", ".join(f"{expand.format(f'a.{p}_type')} AS {p}_full" for p in parts)
    names = ", ".join(
        f"""CASE WHEN {p}_name IS NOT NULL THEN trim({p}_name || coalesce(' ' || {p}_full, '')) END AS {p}_joined"""
        for p in parts
    )
    keyed = ", ".join(
        [f"{_key(f'{p}_joined')} AS {p}" for p in parts if p != "region"]
        + [f"{_key(f'{p}_name')} AS {p}_name, {_key(f'{p}_full')} AS {p}_type" for p in parts]
    )
    own, meant = known.format("region_joined", "k.name"), ""
    if misspelt:
        own = "(SELECT k.name FROM meant m JOIN regions k ON k.code = m.code WHERE m.name = j.region_joined)"
        meant = _meant_sql(
            "SELECT DISTINCT region_joined AS name FROM joined WHERE region_joined IS NOT NULL",
            "SELECT code, lower(name) AS full, lower(short_name) AS short FROM regions",
            "область",
        ) + ","
    return f"""
    nr AS (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey),
    dictionary AS (SELECT 'R' || r_regionkey AS name, r_name AS full_name FROM region
                   UNION ALL SELECT r_name, r_name FROM region
                   UNION ALL SELECT 'R' || r_regionkey || '.', r_name FROM region),
    regions AS ({_select(_REGION_ROWS, 'nr')}),
    cities AS ({_select({'id': 'CAST(n_nationkey AS STRING)', **_CITY_ROWS}, 'nr')}),
    settlements AS ({_select(_SETTLEMENT_ROWS, 'supplier JOIN nr ON s_nationkey = n_nationkey')}),
    s_keys AS (SELECT id, upper({known.format('s.region', 'k.name')}) AS region, {_key('municipality')} AS municipality,
                      {_key('settlement')} AS settlement, {expand.format('s.type')} AS type FROM settlements s),
    c_keys AS (SELECT id, upper({known.format('c.region', 'k.name')}) AS region, {_key('area')} AS area,
                      {_key('city')} AS city, {_key('settlement')} AS settlement FROM cities c
               UNION ALL
               SELECT id, upper({known.format('c.region', 'k.name')}), NULL, {_key('area')}, {_key('settlement')}
               FROM cities c WHERE area_type = 'г' AND city IS NULL),
    places AS (SELECT 's' || id AS place, region, municipality AS area, settlement, type AS settlement_type,
                      oktmo, CAST(latitude_dd AS DOUBLE) AS lat, CAST(longitude_dd AS DOUBLE) AS lon FROM settlements
               UNION ALL
               SELECT 'c' || id, region, CASE WHEN area_type = 'р-н' THEN area || ' район' END,
                      coalesce(settlement, city, area), 'г', oktmo, CAST(geo_lat AS DOUBLE), CAST(geo_lon AS DOUBLE)
               FROM cities),
    {', '.join(unique)},
    rows_ AS (SELECT row_number() OVER () AS n, * FROM aggregated),
    expanded AS (SELECT n, region_name, district_name, city_name, settlement_name, {types} FROM rows_ a),
    joined AS (SELECT *, {names} FROM expanded), {meant}
    keyed AS (SELECT n, {own} AS own_region, upper({own}) AS region, {keyed} FROM joined j),
    found AS (SELECT n, own_region, CASE {first} END AS place, CASE {numbers} END AS rung FROM keyed a {joins}),
    located AS (
      SELECT r.* EXCLUDE (region_code, {', '.join(schemas.ADDRESS_COLUMNS)}), k.iso_code AS region_iso_code,
             k.code AS region_code, k.name AS region, p.area, p.settlement, p.settlement_type, p.oktmo, p.lat, p.lon
      FROM rows_ r JOIN found f ON f.n = r.n LEFT JOIN places p ON p.place = f.place
      LEFT JOIN regions k ON lower(coalesce(p.region, f.own_region)) IN (lower(k.name), lower(k.short_name)))
    """


_GEO_STATE = [*schemas.SIGNATURE_COLUMNS, *schemas.GEO_COLUMNS]
_GEO_ORDER = _nulls_first(
    c for c in schemas.SME_GEOCODED.names if c not in ("tin", "start_date")
)
_GEOCODED_SQL = f"""
    geo_flagged AS (
      SELECT *, row_number() OVER w = 1 OR {_changed(_GEO_STATE, 'w')} AS changed,
             last_value(end_date) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_end
      FROM located WINDOW w AS (PARTITION BY tin ORDER BY start_date, {_GEO_ORDER})),
    geocoded AS (
      SELECT {', '.join(c for c in schemas.SME_GEOCODED.names if c != 'end_date')},
             coalesce(lead(start_date) OVER (PARTITION BY tin ORDER BY start_date, {_GEO_ORDER}), last_end) AS end_date
      FROM geo_flagged WHERE changed)
"""
_EXCLUDED = ["nation_24"]


@query(f"WITH {_BASE_SQL} SELECT * FROM aggregated")
def aggregate_registry(spark, folder):
    return aggregate.aggregate_sme(_snapshots(spark, folder), excluded=_EXCLUDED)


def _aggregated(spark, folder):
    return store(aggregate_registry(spark, folder), "aggregated")


@query(f"WITH {_BASE_SQL}, {_geo_sql()}, {_GEOCODED_SQL} SELECT * FROM geocoded")
def geocode_chain(spark, folder):
    return geocode.geocode(_aggregated(spark, folder), _geo_lookups(spark, folder))


@query(
    f"""
    WITH {_BASE_SQL}, {_geo_sql()}
    SELECT rung, count(*) AS addresses
    FROM (SELECT DISTINCT {', '.join(schemas.ADDRESS_COLUMNS)}, rung FROM rows_ r JOIN found f ON f.n = r.n)
    GROUP BY rung
    """
)
def rung_counts(spark, folder):
    """How many distinct addresses each recipe finds; null for those that none does."""
    made = geocode.prepare_lookups(_geo_lookups(spark, folder))
    places = geocode.geocode_addresses(_aggregated(spark, folder), made)
    return places.groupBy("rung").agg(F.count(F.lit(1)).alias("addresses"))



@query(
    f"""
    WITH aggregated AS ({_select({
        'c_custkey': 'c_custkey', 'c_acctbal': 'c_acctbal', 'region_code': "'x'",
        **{c: _SME[c].replace('o_orderpriority', "'1'").replace('o_orderstatus', "'F'")
           for c in schemas.ADDRESS_COLUMNS}},
        'customer JOIN nation ON c_nationkey = n_nationkey')}),
    {_geo_sql()}
    SELECT * EXCLUDE (n) FROM located
    """
)
def geocode_standalone(spark, folder):
    """Any table with address columns: other columns stay, missing type columns are allowed."""
    placed = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    columns = {
        c: _SME[c].replace("o_orderpriority", "'1'").replace("o_orderstatus", "'F'")
        for c in schemas.ADDRESS_COLUMNS
        if c != "city_type"
    }
    addressed = _shaped(placed, {"c_custkey": "c_custkey", "c_acctbal": "c_acctbal", **columns})
    return geocode.geocode(addressed, _geo_lookups(spark, folder))


_GARBLED = """CASE c_custkey % 6 WHEN 0 THEN n_name WHEN 1 THEN left(n_name, 3) || 'x' || substring(n_name, 4)
              WHEN 2 THEN substring(n_name, 2) WHEN 3 THEN replace(n_name, '_', '  ')
              WHEN 4 THEN 'of ' || lower(n_name) || 'z' ELSE left(n_name, 2) END"""
_GARBLED_COLUMNS = {
    **{c: _SME[c].replace("o_orderpriority", "'1'").replace("o_orderstatus", "'F'") for c in schemas.ADDRESS_COLUMNS},
    "region_name": _GARBLED,
}


@query(
    f"""
    WITH RECURSIVE aggregated AS ({_select({
        'c_custkey': 'c_custkey', 'region_code': "'x'", **_GARBLED_COLUMNS}, 'customer JOIN nation ON c_nationkey = n_nationkey')}),
    {_geo_sql(misspelt=True)}
    SELECT * EXCLUDE (n) FROM located
    """
)
def geocode_misspelt(spark, folder):
    """Addresses whose regions are misspelt, cut short or run on: the weighted score finds what they mean."""
    placed = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    addressed = _shaped(placed, {"c_custkey": "c_custkey", **_GARBLED_COLUMNS})
    return geocode.geocode(addressed, _geo_lookups(spark, folder))


def _facts_sql(name: str, columns: dict[str, str], measures: list[str]) -> str:
    greatest = ", ".join(f"{m} DESC NULLS LAST" for m in measures)
    return f"""
    {name} AS (
      SELECT lpad(org_tin, 10, '0') AS tin, CAST(year(data_date) AS INTEGER) AS year, {', '.join(measures)}
      FROM ({_select(columns, 'orders')})
      WHERE lpad(org_tin, 10, '0') IN (SELECT tin FROM aggregated WHERE kind = 1)
      QUALIFY row_number() OVER (PARTITION BY org_tin, data_date
                                 ORDER BY doc_date DESC NULLS LAST, {greatest}) = 1)
    """


_PANEL_SQL = f"""
    WITH {_BASE_SQL.replace("WHERE NOT (region_name ILIKE '%nation_24%')", "WHERE region_name IS NOT NULL")},
    {_geo_sql()}, {_GEOCODED_SQL},
    {_facts_sql("revexp", _REVEXP, ["revenue", "expenditure"])},
    {_facts_sql("empl", _EMPL, ["employees_count"])},
    years AS (SELECT *, CAST(unnest(range(year(start_date), year(end_date) + 1)) AS INTEGER) AS year FROM geocoded)
    SELECT y.*, CAST(revenue AS DOUBLE) AS revenue, CAST(expenditure AS DOUBLE) AS expenditure, employees_count
    FROM years y
    LEFT JOIN revexp r ON r.tin = y.tin AND r.year = y.year
    LEFT JOIN empl e ON e.tin = y.tin AND e.year = y.year
"""


@query(_PANEL_SQL)
def registry_panel(spark, folder):
    """Snapshots, facts and lookups to the geocoded panel."""
    orders = table(spark, folder, "orders")
    built = registry.registry_panel(
        _snapshots(spark, folder),
        _geo_lookups(spark, folder),
        _shaped(orders, _REVEXP),
        _shaped(orders, _EMPL),
    )
    return built.withColumns({c: F.col(c).cast("double") for c in ("revenue", "expenditure")})


# ---- composites: archives in, stored tables out ------------------------------------------------------


def _element(name: str, paths: dict[str, str], dates: set[str]) -> Column:
    """An XML element from a map of paths below it to columns; nulls have no attribute."""
    own = {p[1:]: c for p, c in paths.items() if p.startswith("@")}
    below: dict[str, dict[str, str]] = {}
    for path, column in paths.items():
        if not path.startswith("@"):
            step, _, rest = path.partition("/")
            below.setdefault(step, {})[rest] = column

    def attribute(key: str, column: str) -> Column:
        value = F.date_format(column, "dd.MM.yyyy") if column in dates else F.col(column).cast("string")
        return F.coalesce(F.concat(F.lit(f' {key}="'), value, F.lit('"')), F.lit(""))

    parts = [attribute(k, c) for k, c in own.items()]
    children = [_element(step, inner, dates) for step, inner in below.items()]
    return F.concat(F.lit(f"<{name}"), *parts, F.lit(">"), *children, F.lit(f"</{name}>"))


def _archived(
    rows: DataFrame, dataset: str, by: str, target: str, broken: Column | None = None, prefix: str = "data",
    dates: bool = True, count: int | None = None,
) -> str:
    """Write rows as ``count`` archives of the dataset's XML, the rows of one ``by`` value as one member."""
    as_dates = {f.name for f in schemas.EXTRACTED[dataset].fields if dates and f.dataType.typeName() == "date"}
    record = _element(schemas.RECORD_TAG, schemas.ELEMENTS[dataset], as_dates)
    end = F.when(broken, "</Фай").otherwise("</Файл>") if broken is not None else F.lit("</Файл>")
    # rows are dealt to archives before they become texts, and not a second time
    dealt = rows.withColumn("__source", F.col(by)).repartition(count or _archive_count(rows), "__source")
    texts = dealt.groupBy(F.col("__source").alias("source"), end.alias("end")).agg(
        F.array_join(F.collect_list(record), "").alias("records")
    )
    uri = _uri(target)
    _zip_rows(texts.select("source", F.concat(F.lit("<Файл>"), "records", "end").alias("xml")), uri, prefix)
    return uri


def _fact_rows(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").selectExpr("*", *[f"{e} AS `{c}`" for c, e in _REVEXP.items()])


_FACT_ROWS = f"""
    SELECT org_tin, CAST(revenue AS DOUBLE) AS revenue, CAST(expenditure AS DOUBLE) AS expenditure,
           data_date, doc_date FROM ({_select({**_REVEXP, 'o_custkey': 'o_custkey'}, 'orders')})
"""


def _plain_money(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in ("revenue", "expenditure")})


@query(_FACT_ROWS)
def extract_incremental(spark, folder):
    """Archives arrive in two rounds, the second with older files; a run takes only what is new."""
    facts = _fact_rows(spark, folder)
    inbox, target, ledger = (scratch_path(spark, n) for n in ("inbox", "extracted", "ledger"))
    early, count = F.col("o_custkey") % 3 == 0, _archive_count(facts)
    for number, part in enumerate((facts.filter(early), facts.filter(~early))):
        fresh = _archived(part, "revexp", "o_custkey", scratch_path(spark, "round"), count=count)
        system, source = fs.FileSystem.from_uri(fresh)
        _, there = fs.FileSystem.from_uri(_uri(inbox))
        system.create_dir(there, recursive=True)
        for found in system.get_file_info(fs.FileSelector(source)):
            place = f"{there}/round{number}-{found.base_name}"
            system.copy_file(found.path, place)
            if number:
                _make_older(spark, place)
        extract.extract_new(spark, inbox, target, ledger, "revexp")
    if extract.extract_new(spark, inbox, target, ledger, "revexp") != 0:
        raise AssertionError("an archive was taken twice")
    return _plain_money(extract.read_extracted(spark, target, "revexp"))


def _make_older(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).setTimes(where, 1_000_000_000_000, -1)


@query(_FACT_ROWS)
def extract_replaced(spark, folder):
    """Archives with members cut off come again under their names, whole: they replace what they gave."""
    facts = _fact_rows(spark, folder)
    inbox, target, ledger = (scratch_path(spark, n) for n in ("inbox", "extracted", "ledger"))
    record = _element(schemas.RECORD_TAG, schemas.ELEMENTS["revexp"], {"data_date", "doc_date"})
    # by customer, so that an archive of the same name has the same members
    dealt = facts.repartition(max(16, _archive_count(facts)), "o_custkey")
    texts = dealt.groupBy(F.col("o_custkey").alias("source")).agg(F.array_join(F.collect_list(record), "").alias("records"))
    for broken in (F.col("source") % 7 == 2, F.lit(False)):
        ends = F.when(broken, "</Фай").otherwise("</Файл>")
        xml_texts = texts.select("source", F.concat(F.lit("<Файл>"), "records", ends).alias("xml"))
        _zip_rows(xml_texts, _uri(inbox))
        taken = extract.extract_new(spark, inbox, target, ledger, "revexp", by_content=True)
    if not taken or not extract.read_rejects(spark, target).isEmpty():
        raise AssertionError("a repaired archive was not taken")
    if extract.extract_new(spark, inbox, target, ledger, "revexp", by_content=True) != 0:
        raise AssertionError("an archive was taken twice")
    return _plain_money(extract.read_extracted(spark, target, "revexp"))


@query("SELECT DISTINCT 'part-' || o_custkey || '.xml' AS member FROM orders WHERE o_custkey % 7 = 2")
def extract_rejects(spark, folder):
    """Members that are cut off are kept as rejects, and give no rows."""
    facts = _fact_rows(spark, folder)
    inbox, target, ledger = (scratch_path(spark, n) for n in ("inbox", "extracted", "ledger"))
    _archived(facts, "revexp", "o_custkey", inbox, F.col("o_custkey") % 7 == 2)
    extract.extract_new(spark, inbox, target, ledger, "revexp")
    return extract.read_rejects(spark, target).select("member")


def _damaged_zip(target: str, rows: Iterable[tuple[int, bytes]], number: int) -> None:
    """An archive whose members are packed in three ways; of each way some are altered or encrypted."""
    ways = (zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2, zipfile.ZIP_LZMA)
    raw, altered = io.BytesIO(), []
    with zipfile.ZipFile(raw, "w") as archive:
        for key, xml in rows:
            info = zipfile.ZipInfo(f"part-{key}.xml")
            info.compress_type = ways[key % 3]
            archive.writestr(info, xml)
            if key % 5 == 1:
                altered.append((info.header_offset + 30 + len(info.filename), info.compress_size))
            if key % 5 == 2:
                archive.getinfo(info.filename).flag_bits |= 1
    data = bytearray(raw.getvalue())
    for at, size in altered:
        for i in range(at + size // 3, at + size // 3 + 12):
            data[i] ^= 0x5A
    system, path = fs.FileSystem.from_uri(target)
    with system.open_output_stream(f"{path}/data-{number}.zip") as out:
        out.write(bytes(data))


@query(
    """
    SELECT o_custkey, CASE o_custkey % 5 WHEN 1 THEN 'rejected' WHEN 2 THEN 'rejected' ELSE 'read' END AS what,
           count(*) FILTER (WHERE o_custkey % 5 NOT IN (1, 2)) AS records
    FROM orders GROUP BY o_custkey
    """
)
def extract_damaged_kinds(spark, folder):
    """Deflated, bzip2 and LZMA members, altered or encrypted, are rejects; all others are read."""
    record = _element(schemas.RECORD_TAG, schemas.ELEMENTS["revexp"], {"data_date", "doc_date"})
    facts = _fact_rows(spark, folder)
    dealt = facts.repartition(_archive_count(facts), "o_custkey")
    texts = dealt.groupBy("o_custkey").agg(F.array_join(F.collect_list(record), "").alias("records"))
    uri = _uri(scratch_path(spark, "inbox"))
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)

    def write(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for n, batch in enumerate(batches):
            members = [(k, f"<Файл>{r}</Файл>".encode()) for k, r in batch.itertuples(index=False)]
            _damaged_zip(uri, members, 1000 * TaskContext.get().partitionId() + n)
        yield pd.DataFrame({"n": [1]})

    texts.select("o_custkey", "records").mapInPandas(write, "n long").agg(F.sum("n")).first()
    rows, rejects = extract.extract_archives(archives.list_archives(spark, uri), "revexp")
    key = F.regexp_extract("member", r"part-(\d+)", 1).cast("long")
    read = rows.groupBy(F.col("org_tin").cast("long").alias("o_custkey"), F.lit("read").alias("what")).agg(F.count(F.lit(1)).alias("records"))
    return read.union(rejects.select(key, F.lit("rejected"), F.lit(0)))


_TAKEN = {"[-2:]": slice(-2, None), "[:-1]": slice(None, -1), "[::3]": slice(None, None, 3), "[-1]": -1}


@query(
    """
    WITH m AS (SELECT o_custkey, row_number() OVER (ORDER BY 'part-' || o_custkey || '.xml') - 1 AS spot, count(*) OVER () AS n
               FROM (SELECT DISTINCT o_custkey FROM orders))
    SELECT '[-2:]' AS taken, o_custkey FROM m WHERE spot >= n - 2
    UNION ALL SELECT '[:-1]', o_custkey FROM m WHERE spot < n - 1
    UNION ALL SELECT '[::3]', o_custkey FROM m WHERE spot % 3 = 0
    UNION ALL SELECT '[-1]', o_custkey FROM m WHERE spot = n - 1
    """
)
def member_slices(spark, folder):
    """Members of one archive by Python's slices."""
    facts = _fact_rows(spark, folder)
    uri = _uri(scratch_path(spark, "sliced"))
    record = _element(schemas.RECORD_TAG, schemas.ELEMENTS["revexp"], {"data_date", "doc_date"})
    texts = facts.groupBy(F.col("o_custkey").alias("source")).agg(F.max(record).alias("record"))
    texts = texts.select("source", F.concat(F.lit("<Файл>"), "record", F.lit("</Файл>")).alias("xml"))
    named = F.concat(F.lit("part-"), F.col("source"), F.lit(".xml"))
    # an archive is one file, written by one task: a record of each customer
    _zip_rows(texts.repartitionByRange(1, named).sortWithinPartitions(named), uri)
    paths = archives.list_archives(spark, uri)
    got = None
    for name, members in _TAKEN.items():
        rows, _ = extract.extract_archives(paths, "revexp", members=members)
        part = rows.select(F.lit(name).alias("taken"), F.col("org_tin").cast("long").alias("o_custkey"))
        got = part if got is None else got.unionAll(part)
    return got


@query(_PANEL_SQL)
def process_registry(spark, folder):
    """Archives of all three datasets to the panel, with every stage written."""
    facts = table(spark, folder, "orders")
    keyed = _snapshots(spark, folder).withColumn("__by", F.coalesce("ind_tin", "org_tin"))
    parts = {
        "sme": (keyed, "__by"),
        "revexp": (_shaped(facts, _REVEXP), "org_tin"),
        "empl": (_shaped(facts, _EMPL), "org_tin"),
    }
    folders = {
        name: _archived(rows, name, by, scratch_path(spark, name), count=_archive_count(facts))
        for name, (rows, by) in parts.items()
    }
    work = scratch_path(spark, "work")
    registry.process(spark, folders, _geo_lookups(spark, folder), work)
    built = spark.read.parquet(f"{work}/panel")
    return built.withColumns({c: F.col(c).cast("double") for c in ("revenue", "expenditure")})


@query(_PANEL_SQL)
def process_incremental(spark, folder):
    """Archives come in two rounds, the second with later years and with some days that come late."""
    facts = table(spark, folder, "orders")
    keyed = _snapshots(spark, folder).withColumn("__by", F.coalesce("ind_tin", "org_tin"))
    parts = {
        "sme": (keyed, "__by"),
        "revexp": (_shaped(facts, _REVEXP), "org_tin"),
        "empl": (_shaped(facts, _EMPL), "org_tin"),
    }
    folders = {name: scratch_path(spark, name) for name in parts}
    work, lookups = scratch_path(spark, "work"), geocode.prepare_lookups(_geo_lookups(spark, folder))
    count = _archive_count(facts)
    first = (F.year("data_date") < 1995) & (F.pmod(F.xxhash64("data_date"), F.lit(40)) != 0)
    for number, chosen in enumerate((first, ~first)):
        for name, (rows, by) in parts.items():
            _archived(rows.filter(chosen), name, by, folders[name], prefix=f"round{number}", count=count)
        built = registry.process_incremental(spark, {n: _uri(f) for n, f in folders.items()}, lookups, work)
    return built.withColumns({c: F.col(c).cast("double") for c in ("revenue", "expenditure")})


@query(
    """
    SELECT page_id, url || '.old' AS link FROM pages
    UNION ALL SELECT page_id, url || '.zip' FROM pages WHERE NOT contains(url, '/en/')
    """
)
def new_links(spark, folder):
    """Links of description tables whose files are not held yet; names are made unique by page."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    expected = schemas.DATASET_PAGE_ROWS
    unique = F.concat(F.col("url"), F.lit("/f"), F.col("page_id").cast("string"))
    escaped = F.replace(unique, F.lit("&"), F.lit("&amp;"))
    page = F.concat(
        F.lit(f"<table class='x border_table'><tr><td>8<td>{expected[8]}<td><a href='"), escaped,
        F.lit(f".zip'>a</a><tr><td>16<td>{expected[16]}<td><a data-href='no' href='"), escaped,
        F.lit(".old'>b</a><!-- <a href='no'> --></table>"),
    )
    shown = pages.select("page_id", page.alias("html"))
    name = F.concat(F.lit("/held/f"), F.col("page_id").cast("string"), F.lit(".zip"))
    held = pages.filter(F.contains("url", F.lit("/en/"))).select(name.alias("path"))
    found = registry.new_links(shown, held)
    plain = F.regexp_replace("link", r"/f\d+\.", ".")
    return found.select("page_id", plain.alias("link"))


@query(
    """
    SELECT 'parts' AS source, c_custkey, c_name FROM customer
    UNION ALL SELECT 'folder', c_custkey, c_name FROM customer WHERE c_custkey % 2 = 0
    """
)
def csv_paths(spark, folder):
    """A path ending in .csv is read whole, of a folder the data-*.csv files, a missing path is empty."""
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    whole, held = scratch_path(spark, "whole") + ".csv", scratch_path(spark, "held")
    sinks.write_csv(customers, whole)
    for name, part in (("data-1.csv", "c_custkey % 4 = 0"), ("data-2.csv", "c_custkey % 4 = 2"), ("other.csv", "c_custkey % 2 = 1")):
        sinks.write_csv(customers.filter(part), f"{held}/{name}")
    schema = customers.schema
    # a folder of files: the parts of each export under the names that the reader looks for
    system, root = fs.FileSystem.from_uri(_uri(held))
    for name in ("data-1.csv", "data-2.csv", "other.csv"):
        for n, part in enumerate(system.get_file_info(fs.FileSelector(f"{root}/{name}"))):
            if part.extension == "csv":
                system.move(part.path, f"{root}/{name.removesuffix('.csv')}-{n}.csv")
        system.delete_dir(f"{root}/{name}")
    read = {"parts": whole, "folder": held, "missing": scratch_path(spark, "missing")}
    tagged = [
        tables.read_csv(spark, path, schema).select(F.lit(name).alias("source"), "*") for name, path in read.items()
    ]
    return reduce(DataFrame.unionAll, tagged)


@query(
    """
    SELECT s_suppkey::VARCHAR AS id, s_name AS name, NULL::VARCHAR AS extra FROM supplier WHERE s_suppkey % 2 = 0
    UNION ALL SELECT s_suppkey::VARCHAR, s_name, 'x' || s_nationkey FROM supplier WHERE s_suppkey % 2 = 1
    """
)
def lookup_files(spark, folder):
    """A base and an additional lookup file below each other, by column name, as text."""
    suppliers = table(spark, folder, "supplier")
    base, more = scratch_path(spark, "base") + ".csv", scratch_path(spark, "more") + ".csv"
    named = suppliers.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.concat(F.lit("x"), F.col("s_nationkey").cast("string")).alias("extra"))
    sinks.write_csv(named.filter("id % 2 = 0").drop("extra"), base)
    sinks.write_csv(named.filter("id % 2 = 1").select("extra", "name", "id"), more)
    return tables.read_lookup(spark, [base, more]).select("id", "name", "extra")


@query(
    """
    SELECT 'unique key' AS check_, count(*) = count(DISTINCT c_custkey) AS holds FROM customer
    UNION ALL SELECT 'unique segment', count(*) = count(DISTINCT c_mktsegment) FROM customer
    UNION ALL SELECT 'one nation a key', count(*) = count(DISTINCT n_nationkey) FROM nation
    UNION ALL SELECT 'one nation a region', count(*) = count(DISTINCT n_regionkey) FROM nation
    UNION ALL SELECT 'address table', true UNION ALL SELECT 'no address table', false
    """
)
def key_checks(spark, folder):
    """The guards, as rows: unique ids, lookups with one row a key, tables with address columns."""
    customers, nations = table(spark, folder, "customer"), table(spark, folder, "nation")

    def passes(guard: Callable[[], object]) -> bool:
        try:
            guard()
        except ValueError:
            return False
        return True

    found = [
        ("unique key", lookups.is_unique(customers, "c_custkey")),
        ("unique segment", lookups.is_unique(customers, "c_mktsegment")),
        ("one nation a key", passes(lambda: lookups.assert_many_to_one(nations, "n_nationkey"))),
        ("one nation a region", passes(lambda: lookups.assert_many_to_one(nations, "n_regionkey"))),
        ("address table", passes(lambda: geocode.check_structure(_snapshots(spark, folder).columns))),
        ("no address table", passes(lambda: geocode.check_structure(customers.columns))),
    ]
    return spark.createDataFrame(found, "check_ string, holds boolean")


@query(
    """
    SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) - 1 AS place FROM orders
    """
)
def sorted_places(spark, folder):
    """Rows in order: the place of each row in the files of a sorted export, file after file."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    target = scratch_path(spark, "sorted")
    sinks.write_parquet(orders, target, sort_by=["o_custkey", "o_orderdate", "o_orderkey"])
    written = spark.read.parquet(target).withColumns(
        {"file": F.col("_metadata.file_name"), "at": F.col("_metadata.row_index")}
    )
    # part files are numbered in the order of their rows
    sizes = written.groupBy("file").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return written.join(F.broadcast(starts), "file").select("o_orderkey", (F.col("start") + F.col("at")).alias("place"))
