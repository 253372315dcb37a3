"""Column expressions used across the pipeline.

All of these are plain ``pyspark.sql.functions`` compositions: they stay
inside whole-stage code generation and never call back into Python.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aloft.functions import fixed

# A field counts as a number only when it is a plain decimal literal with an
# optional exponent.  Spark's own string->double cast also accepts ``12d``,
# ``12f``, ``nan`` and ``inf``; the CSV semantics we reproduce reject those.
NUMBER_PATTERN = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$"

_NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                  T.DoubleType, T.DecimalType)


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_token(c: str | Column, tokens: Iterable[str] = fixed.NULL_TOKENS) -> Column:
    """Missing-value spelling -> NULL (exact, case-sensitive match)."""
    c = col_of(c)
    return F.when(c.isin(list(tokens)), F.lit(None).cast("string")).otherwise(c)


# Whitespace that ``\s`` matches in NUMBER_PATTERN, and the only characters a
# plain number may contain once that whitespace is trimmed.
_SPACE = " \t\n\x0b\f\r"
_NUMBER_CHARS = "0123456789+-.eE"
# Bytes of the shortest hex number that a cast to double accepts, ``0x1p3``.
_SHORTEST_HEX = 5


# --- expressions as SQL text -----------------------------------------------------------------
# Wide projections are built with ``selectExpr`` from these strings: one call to
# the JVM per stage instead of one per literal and function (28+ columns).

def sql_ident(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


_SPACE_SQL = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"


def null_if_token_sql(c: str, tokens: Iterable[str] = fixed.NULL_TOKENS) -> str:
    col = sql_ident(c)
    return f"CASE WHEN {col} IN ({', '.join(sql_str(t) for t in tokens)}) THEN NULL ELSE {col} END"


def to_double_sql(c: str, numeric_input: bool = False) -> str:
    """Lenient numeric coercion: anything that is not a plain number becomes NULL.

    Equivalent to ``rlike(NUMBER_PATTERN) ? cast : NULL`` but without a regex per value.  Text that
    begins and ends like a plain number and has no ``x`` is one exactly if the string->double cast accepts
    it: there is nothing to trim, no suffix, and no hex.  For other text (spaces around it, for one) it
    suffices to check that no character is left but those of a number (``translate`` deletes them).
    Text of these characters can be infinite only by overflow (``1e999``).

    The text and the parsed value are bound by lambdas, so that neither is computed twice and twenty such
    columns do not make a generated method too large to be compiled.
    """
    col = sql_ident(c)
    if numeric_input:
        x = f"CAST({col} AS DOUBLE)"
        return f"CASE WHEN isnan({x}) OR abs({x}) = double('inf') THEN CAST(NULL AS DOUBLE) ELSE {x} END"
    plain = "s >= '+' AND s < ':' AND substr(s, -1, 1) BETWEEN '.' AND '9' AND NOT contains(s, 'x') AND NOT contains(s, 'X')"
    trimmed = f"btrim(s, {_SPACE_SQL})"
    parsed = (f"transform(array(CAST({col} AS STRING)), s -> CASE WHEN {plain} THEN try_cast(s AS DOUBLE) "
              f"WHEN translate({trimmed}, '{_NUMBER_CHARS}', '') = '' THEN try_cast({trimmed} AS DOUBLE) END)")
    return f"transform({parsed}, x -> CASE WHEN abs(x) <> double('inf') THEN x END)[0]"


def number_text_sql(c: str) -> str:
    """The part of ``to_double_sql`` before the check for overflow, for frames of many text columns: the value of a plain
    number (infinite if it is too large), else NULL.

    ``c`` is a column, named wherever it is needed: a lambda is never compiled, which costs several times the parsing.
    """
    s = sql_ident(c)
    # BETWEEN would put the last characters of all columns into a projection of their own
    ends = ", ".join(f"'{d}'" for d in "0123456789.")
    plain = (f"{s} >= '+' AND {s} < ':' AND substr({s}, -1, 1) IN ({ends}) "
             f"AND (octet_length({s}) < {_SHORTEST_HEX} OR NOT contains({s}, 'x') AND NOT contains({s}, 'X'))")
    trimmed = f"btrim({s}, {_SPACE_SQL})"
    return (f"try_cast(CASE WHEN {plain} THEN {s} WHEN translate({trimmed}, '{_NUMBER_CHARS}', '') = '' THEN {trimmed} END "
            "AS DOUBLE)")


def finite_sql(c: str) -> str:
    """A double column without what is not finite: NULL instead."""
    x = sql_ident(c)
    return f"CASE WHEN abs({x}) < double('inf') THEN {x} END"


def to_double(c: str, dtype: T.DataType | None = None) -> Column:
    """``to_double_sql`` of a column by name."""
    return F.expr(to_double_sql(c, is_numeric_type(dtype)))


def is_numeric_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, _NUMERIC_TYPES)


def to_int_half_even(c: str, dtype: T.DataType | None = None,
                     target: str = "smallint") -> Column:
    """Coerce, round half-to-even to a whole number, keep NULL for unparseable values."""
    return F.rint(to_double(c, dtype)).cast(target)


def np_round(c: Column, places: int) -> Column:
    """Round like NumPy: scale, round half-to-even on the double, scale back."""
    scale = float(10 ** places)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def strip_all(c: str | Column) -> Column:
    """Strip leading/trailing whitespace of any kind (``trim`` only removes blanks)."""
    return F.regexp_replace(col_of(c), r"^\s+|\s+$", "")


def hour_of(hhmm: str | Column) -> Column:
    """HHMM clock value -> hour clipped to [0, 23]; NULL stays NULL."""
    c = col_of(hhmm)
    hour = F.greatest(F.least(F.floor(c / 100), F.lit(23)), F.lit(0))
    return F.when(c.isNotNull(), hour).cast("int")


def time_block(hour: str | Column) -> Column:
    c = col_of(hour)
    expr = None
    for upper, label in fixed.TIME_BLOCKS:
        expr = F.when(c < upper, label) if expr is None else expr.when(c < upper, label)
    return F.when(c.isNotNull(), expr.otherwise(fixed.TIME_BLOCK_LAST))


def iso_day_of_week(d: str | Column) -> Column:
    """ISO weekday, 1 = Monday .. 7 = Sunday (``dayofweek`` would give 1 = Sunday)."""
    return (F.weekday(col_of(d)) + 1).cast("int")


# Formats tried, in order, by the lenient date parser.
DATE_FORMATS = ("yyyy-MM-dd", "M/d/yyyy h:mm:ss a", "M/d/yyyy", "yyyy/MM/dd", "yyyy-MM-dd HH:mm:ss")


def parse_date(c: str | Column, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """Lenient date parse: the first format that fits wins, otherwise NULL.

    A format is tried only on text that has its separators: a failing try costs an exception.  Text of the first
    format's shape fits no other, and the cast reads it alike without a formatter.
    """
    c, formats = col_of(c).cast("string"), list(formats)

    def tried(f: str) -> Column:
        marks = [F.contains(c, F.lit(m)) for m in sorted({x for x in f if not x.isalnum()})]
        return F.when(reduce(lambda a, b: a & b, marks, F.lit(True)), F.call_function("try_to_date", c, F.lit(f)))

    found = F.coalesce(*[tried(f) for f in formats])
    if formats[0] != DATE_FORMATS[0]:
        return found
    iso = ((F.length(c) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
           & F.substring(c, 10, 1).between("0", "9"))
    return F.when(iso, c.try_cast("date")).otherwise(found)


def month_abbrev(month: str | Column) -> Column:
    """1..12 -> English three-letter month name; anything else -> NULL."""
    m = col_of(month)
    ok = m.between(1, 12)
    return F.when(ok, F.date_format(F.make_date(F.lit(2000), m.cast("int"), F.lit(1)), "MMM"))


def label_lookup(c: str | Column, pairs: Iterable[tuple[object, str]]) -> Column:
    """Small literal map lookup (kept in the expression, no join)."""
    flat = []
    for k, v in pairs:
        flat += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*flat), col_of(c))


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den as double; NULL instead of a division-by-zero error."""
    return F.try_divide(num.cast("double"), den.cast("double"))
