"""Column expressions (all JVM-side built-ins, codegen-friendly).

Spark 4 runs with ANSI on: ``cast`` and ``to_timestamp`` raise on bad text, so
every tolerant parse here uses the ``try_`` forms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import params as P

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tolerant_timestamp(c: ColumnOrName, formats: Sequence[str] = (P.ISO_DATE,)) -> Column:
    """C4: first format that parses wins; text that parses with none -> NULL.
    Result is ``timestamp_ntz``, the wall clock of the text in a UTC session:
    the parse goes through the session zone, so every public run sets UTC
    (``session.tune``)."""
    parsed = [F.try_to_timestamp(_col(c), F.lit(f)) for f in formats]
    out = parsed[0] if len(parsed) == 1 else F.coalesce(*parsed)
    return out.cast("timestamp_ntz")


def tolerant_double(c: ColumnOrName) -> Column:
    """Text -> double, unparsable -> NULL (surrounding blanks allowed)."""
    return _col(c).try_cast("double")


def tolerant_int(c: ColumnOrName) -> Column:
    """C5 then C15: integral number from text or number, NULL if not parsable
    or out of int range."""
    return _col(c).try_cast("double").try_cast("int")


# Outer whitespace in the Unicode sense (Python's str.strip), not only spaces.
_OUTER_WS = r"(?U)^\s+|\s+$"


def strip_lower(c: ColumnOrName) -> Column:
    """C10 on one column: strip all outer whitespace, then lower-case."""
    return F.lower(F.regexp_replace(_col(c), _OUTER_WS, ""))


def fill_default(c: ColumnOrName, value) -> Column:
    """C11."""
    return F.coalesce(_col(c), F.lit(value))


def clip_lower(c: ColumnOrName, lower=0) -> Column:
    """Values below ``lower`` become ``lower``; NULL stays NULL."""
    col = _col(c)
    return F.when(col < F.lit(lower), F.lit(lower)).otherwise(col)


def stockout_flag(stock: ColumnOrName = "stock_qty", sales_7d: ColumnOrName = "sales_7d",
                  stock_threshold: int = P.STOCK_THRESHOLD,
                  demand_threshold: int = P.DEMAND_THRESHOLD) -> Column:
    """1 iff stock < threshold and recent demand > threshold (both strict)."""
    return ((_col(stock) < stock_threshold) & (_col(sales_7d) > demand_threshold)).cast("int")


def split_hash(*key_cols: ColumnOrName, seed: int = P.SEED) -> Column:
    """Stable 32-bit hash of a key as 8 lowercase hex chars (md5 prefix).
    The same text is computed by any SQL engine with md5, so the split can be
    checked independently."""
    key = F.concat_ws("|", *[_col(k).cast("string") for k in key_cols])
    return F.substring(F.md5(F.concat(key, F.lit(f"-{seed}"))), 1, 8)


def round_half_up_ratio(numerator: ColumnOrName, denominator: ColumnOrName,
                        digits: int = 2) -> Column:
    """Exact decimal ROUND(n / d, digits) half away from zero for integral
    n >= 0, d > 0, done in integer arithmetic (no binary-float tie errors)."""
    scale = 10 ** digits
    n, d = _col(numerator).cast("long"), _col(denominator).cast("long")
    # floor((2*scale*n + d) / (2*d)) on longs
    quotient = F.when(d != 0, F.call_function("div", F.lit(2 * scale).cast("long") * n + d, F.lit(2).cast("long") * d))
    return quotient.cast("double") / F.lit(float(scale))
