"""Text cleaning and typed casts with explicit, engine-independent rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegrid.functions._util import to_col

# The default missing-value tokens of pandas.read_csv (public
# pandas 2.x behaviour).  A text export landed through pandas turns exactly
# these cell values into nulls.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# The characters Python's str.strip() removes, derived from str.isspace().
PY_WHITESPACE = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
# The same set as a regex class that Java regex and RE2 both accept (used by
# the SQL oracle); a test checks that both describe the same characters.
PY_WHITESPACE_CLASS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def trim_to_null(c) -> Column:
    """SQL ``nullif(trim(c), '')``: strips U+0020 only, blank becomes null."""
    return F.nullif(F.trim(to_col(c)), F.lit(""))


def clean_text(c) -> Column:
    """Strip every Unicode whitespace character at both ends; blank -> null.
    ``trim(BOTH <set> FROM c)`` looks only at the two ends, so its cost does
    not grow with the length of the text."""
    return F.nullif(F.trim(to_col(c), F.lit(PY_WHITESPACE)), F.lit(""))


def null_tokens(df: DataFrame, columns: Iterable[str] | None = None,
                tokens: Iterable[str] = PANDAS_NULL_TOKENS) -> DataFrame:
    """Replace missing-value tokens by null in the given (default: all string)
    columns, in one projection."""
    string_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    targets = set(columns) if columns is not None else string_cols
    toks = list(tokens)
    return df.select(*[
        F.when(~F.col(f"`{n}`").isin(toks), F.col(f"`{n}`")).alias(n) if n in targets else F.col(f"`{n}`")
        for n in df.columns
    ])


def cast_int(c, to: str = "int", strict: bool = True) -> Column:
    """Text to integer/bigint.  '1.0' is not an integer: strict raises,
    lenient (``strict=False``) yields null."""
    src = to_col(c)
    tried = src.try_cast(to)
    if not strict:
        return tried
    return F.when(src.isNull() | tried.isNotNull(), tried).otherwise(
        F.raise_error(F.concat(F.lit(f"cannot cast to {to}: "), src)).cast(to))


def cast_round(c, to: str = "int", strict: bool = True) -> Column:
    """Text -> numeric -> integer, rounding half away from zero (2.5 -> 3,
    -2.5 -> -3) instead of Spark's truncating decimal->int cast."""
    src = to_col(c)
    dec = src.try_cast("decimal(38,10)")
    rounded = F.round(dec, 0).try_cast(to)
    if not strict:
        return rounded
    return F.when(src.isNull() | rounded.isNotNull(), rounded).otherwise(
        F.raise_error(F.concat(F.lit(f"cannot cast to rounded {to}: "), src)).cast(to))
