"""Cleaning stage: null spellings, numeric coercion, imputation, key filter.

Order matters and is part of the contract: coerce -> fill delay causes with 0
-> fill six measures with the exact global median (taken *before* any row is
dropped) -> fill flags with 0 -> drop rows without origin, destination or
carrier.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.functions import fixed
from aloft.functions.columns import (NUMBER_PATTERN, finite_sql, is_numeric_type, null_if_token_sql, number_text_sql, sql_ident,
                                     to_double_sql)
from aloft.operators.selection import medians
from aloft.session import compile_in_parts


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, columns: Iterable[str], stage: str) -> None:
    """Fail before any job runs when a column the stage cannot do without is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"{stage}: missing required column(s) {missing}")


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    cols = set(df.columns)
    return [c for c in columns if c in cols]


def standardize_columns(df: DataFrame) -> DataFrame:
    """Header normalisation: strip surrounding whitespace and upper-case."""
    return df.toDF(*[c.strip().upper() for c in df.columns])


def replace_null_tokens(df: DataFrame, tokens: Sequence[str] = fixed.NULL_TOKENS, but: Iterable[str] = ()) -> DataFrame:
    """Every string field (``but`` those named) spelled like a missing value becomes NULL."""
    strings = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)} - set(but)
    return df.selectExpr(*[f"{null_if_token_sql(c, tokens)} AS {sql_ident(c)}" if c in strings
                           else sql_ident(c) for c in df.columns])


def coerce_numeric(df: DataFrame, columns: Sequence[str] = fixed.NUMERIC_COLUMNS,
                   integer_columns: Sequence[str] = fixed.CALENDAR_COLUMNS) -> DataFrame:
    """Lenient coercion: numeric columns to double, calendar columns to int.

    Text that is not a plain number (``12d``, ``nan``, ``inf``, ``1_000``) and
    non-finite values become NULL.  Columns not present are skipped.
    """
    compile_in_parts(df.sparkSession)
    types = {f.name: f.dataType for f in df.schema.fields}
    dbl, ints = set(present(df, columns)), set(present(df, integer_columns))

    def number(c: str) -> str:
        if isinstance(types[c], T.StringType):
            return number_text_sql(c)
        return f"CAST({sql_ident(c)} AS DOUBLE)" if is_numeric_type(types[c]) else to_double_sql(c)

    parsed = df.selectExpr(*[f"{number(c)} AS {sql_ident(c)}" if c in dbl | ints else sql_ident(c) for c in df.columns])
    finite = {c: f"CAST(rint({finite_sql(c)}) AS INT)" if c in ints else finite_sql(c) for c in dbl | ints}
    return parsed.selectExpr(*[f"{finite[c]} AS {sql_ident(c)}" if c in finite else sql_ident(c) for c in df.columns])


def fill_causes_zero(df: DataFrame, columns: Sequence[str] = fixed.CAUSE_COLUMNS) -> DataFrame:
    return df.fillna(0.0, subset=present(df, columns)) if present(df, columns) else df


def column_medians(df: DataFrame, columns: Sequence[str] = fixed.MEDIAN_COLUMNS) -> DataFrame:
    """One-row frame with the exact (interpolated) median of each column, by radix selection."""
    cols = present(df, columns)
    found = medians(df, cols)
    return df.sparkSession.range(1).select(*[F.lit(found[c]).cast("double").alias(c) for c in cols])


def median_fill(df: DataFrame, columns: Sequence[str] = fixed.MEDIAN_COLUMNS) -> DataFrame:
    """Replace NULLs by the exact global median of the column.

    The medians are found when this is called, and filled as literals.  Counting evaluates ``df`` once
    a pass more, so give a staged frame where that is expensive.
    """
    found = medians(df, present(df, columns))
    values = {c: v for c, v in found.items() if v is not None}
    return df.fillna(values) if values else df


def fill_flags(df: DataFrame, columns: Sequence[str] = fixed.FLAG_COLUMNS) -> DataFrame:
    """Flags: NULL -> 0, then truncated to int (through double, never from text)."""
    cols = set(present(df, columns))
    return df.selectExpr(*[f"CAST(coalesce(CAST({sql_ident(c)} AS DOUBLE), 0.0D) AS INT) AS {sql_ident(c)}"
                           if c in cols else sql_ident(c) for c in df.columns])


def drop_missing_keys(df: DataFrame, keys: Sequence[str] = fixed.KEY_COLUMNS) -> DataFrame:
    require_columns(df, keys, "drop_missing_keys")
    return df.dropna(subset=list(keys))


def coerce_raw(raw: DataFrame, tokens: Sequence[str] | None = fixed.NULL_TOKENS) -> DataFrame:
    """Null spellings + numeric coercion: the part of cleaning that needs the raw text.

    Spellings that are no numbers need not be looked up in numeric columns: coercion makes them NULL.
    """
    require_columns(raw, fixed.KEY_COLUMNS, "clean_flights")
    if tokens is None:
        return coerce_numeric(raw)
    coerced = () if any(re.match(NUMBER_PATTERN, t) for t in tokens) else (*fixed.NUMERIC_COLUMNS, *fixed.CALENDAR_COLUMNS)
    return coerce_numeric(replace_null_tokens(raw, tokens, coerced))


def finish_cleaning(coerced: DataFrame) -> DataFrame:
    """Imputation and key filter on an already coerced frame (medians before the drop)."""
    df = fill_causes_zero(coerced)
    df = median_fill(df)
    df = fill_flags(df)
    return drop_missing_keys(df)


def clean_flights(raw: DataFrame, tokens: Sequence[str] | None = fixed.NULL_TOKENS) -> DataFrame:
    """The whole cleaning stage on a raw (string) flight frame."""
    return finish_cleaning(coerce_raw(raw, tokens))
