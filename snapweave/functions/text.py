"""Column expressions for names, identifiers and address parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upper_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Uppercase the given columns."""
    return df.withColumns({c: F.upper(c) for c in columns})


def pad_id(column: str, width: int) -> Column:
    """Identifier text with leading zeros; a longer one is cut to ``width``."""
    return F.lpad(F.col(column), width, "0")


def join_name_type(name: str, kind: str, prepend_types: Sequence[str] = ()) -> Column:
    """``"name type"``; just the name without a type; null without a name.

    ``prepend_types`` lists types that go before the name.
    """
    before = F.when(F.col(kind).isin(*prepend_types), F.col(kind)) if prepend_types else F.lit(None)
    after = F.when(before.isNull(), F.col(kind))
    parts = F.concat_ws(" ", before, F.col(name), after)
    return F.when(F.col(name).isNotNull(), F.when(F.col(kind).isNull(), F.col(name)).otherwise(F.trim(parts)))


# ---- fixed values: what is set before and after an area's name, by its abbreviated type ----------

AREA_LABELS = {
    "г": ("Город ", ""),
    "р-н": ("", " район"),
    "у": ("", " улус"),
}

# ---- end of fixed values -------------------------------------------------------------------------


def area_label(area: Column, kind: Column) -> Column:
    """Readable name of an area from its name and abbreviated type; null if either is missing."""
    def around(side: int) -> Column:
        pairs = [F.lit(cell) for key, label in AREA_LABELS.items() for cell in (key, label[side])]
        return F.coalesce(F.try_element_at(F.create_map(*pairs), kind), F.lit(""))

    return F.when(kind.isNotNull(), F.concat(around(0), area, around(1)))


def text_key(column: str | Column) -> Column:
    """Spelling used to compare address parts: upper case, Ё written as Е."""
    return F.translate(F.upper(column), "Ё", "Е")


def default_settlement(region: str, settlement: str, regions: Sequence[str]) -> Column:
    """Regions that are themselves cities stand in for a missing settlement."""
    r, s = F.col(region), F.col(settlement)
    return F.when(s.isNull() & r.isin(*regions), r).otherwise(s)
