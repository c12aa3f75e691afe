"""Coercions of loosely typed records: each takes and returns a Column.

Integers are truncated toward zero and accept "7.0" (``loose_int``) or only whole-number text (``strict_int``). NaN,
blanks and unparsable text become null. ``first_truthy`` skips null, "", 0 and false, as records' alternatives are chosen.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def has(df: DataFrame, name: str) -> bool:
    return name in df.columns


def column(df: DataFrame, name: str, kind: str = "string") -> Column:
    """The named column, or a null of the kind where it is absent."""
    return F.col(f"`{name}`") if has(df, name) else F.lit(None).cast(kind)


def strip(c: Column) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(F.regexp_replace(c.cast("string"), r"^\s+", ""), r"\s+$", "")


def clean_str(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def clean_upper(c: Column) -> Column:
    return F.upper(clean_str(c))


def collapsed(c: Column) -> Column:
    """White space runs made one space; dashes alone count as missing."""
    text = F.regexp_replace(strip(c), r"\s+", " ")
    return F.when(~text.isin("", "-", "--"), text)


def loose_float(c: Column) -> Column:
    value = F.try_cast(strip(c), "double") if hasattr(F, "try_cast") else strip(c).try_cast("double")
    return F.when(~F.isnan(value), value)


def loose_int(c: Column) -> Column:
    return loose_float(c).try_cast("int")


def strict_int(c: Column) -> Column:
    text = strip(c)
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))


def truthy(df: DataFrame, name: str) -> Column:
    """The column's value, or null where it counts as false."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        return F.when(c != "", c)
    if isinstance(kind, T.BooleanType):
        return F.when(c, c)
    if isinstance(kind, T.NumericType):
        return F.when((c != 0), c)
    return c


def first_truthy(df: DataFrame, *names: str) -> Column:
    """The first of the named columns that is present and counts as true, as text."""
    found = [truthy(df, n).cast("string") for n in names if has(df, n)]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def find_column(names: Iterable[str], *include: str, exclude: tuple[str, ...] = ()) -> str | None:
    """The first name that holds all fragments and none of the excluded ones."""
    for name in names:
        low = name.lower()
        if not any(x in low for x in exclude) and all(x in low for x in include):
            return name
    return None


def fold(c: Column) -> Column:
    """Lower-cased letters and digits alone."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def half_even(c: Column, places: int) -> Column:
    return F.bround(c, places)
