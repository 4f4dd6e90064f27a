"""Column-level helpers: exact rounding, surrogate keys, suppression, labels.

Every function returns a ``Column`` built from built-in Spark expressions, so it
stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The null placeholder and separator of the public
# ``generate_surrogate_key`` convention, so keys equal those of the reference.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SURROGATE_SEPARATOR = "-"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column, digits: int, scale: float = 1) -> Column:
    """``round(num / den * scale, digits)`` as DOUBLE, null when ``den`` is 0 or null.

    The quotient is taken in double, fixed to a 10-digit decimal, then rounded half
    away from zero. The same text in the DuckDB oracle gives identical values.
    """
    n = col(num).cast("double")
    d = col(den).cast("double")
    q = F.when(d != 0, n / d)
    if scale != 1:
        q = q * F.lit(float(scale))
    return F.round(q.cast("decimal(28,10)"), digits).cast("double")


def ratio_or(num, den, digits: int, default, scale: float = 1) -> Column:
    """``ratio`` with an explicit value for a zero/null denominator."""
    return F.coalesce(ratio(num, den, digits, scale), F.lit(default).cast("double"))


def exact_sum(c: str | Column, scale: int = 4) -> Column:
    """Order-independent sum of a DOUBLE holding at most ``scale`` decimals."""
    return F.sum(col(c).cast(f"decimal(38,{scale})"))


def mean(c: str | Column, digits: int, scale: int = 4) -> Column:
    """Rounded mean computed as exact decimal sum / count (never a double average)."""
    return ratio(exact_sum(c, scale), F.count(col(c)), digits)


def round_to(c: str | Column, digits: int) -> Column:
    """Round a DOUBLE half away from zero, through a decimal."""
    return F.round(col(c).cast("decimal(28,10)"), digits).cast("double")


def flag(cond: Column) -> Column:
    """CASE WHEN cond THEN true ELSE false: a NULL condition is false."""
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the '-'-joined string forms, NULLs replaced by a fixed token."""
    parts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def suppress_small_cells(c: str | Column, threshold: int = 11) -> Column:
    """Cell-form suppression: a value below ``threshold`` becomes NULL; NULL stays NULL."""
    return F.when(col(c) < F.lit(threshold), F.lit(None)).otherwise(col(c))


def trim_upper(c: str | Column) -> Column:
    """``trim(upper(x))``: spaces only, as SQL ``trim``."""
    return F.trim(F.upper(col(c)))


def strip_upper(c: str | Column) -> Column:
    """Python-style ``strip().upper()``: every kind of leading/trailing whitespace."""
    return F.upper(F.regexp_replace(col(c), r"^\s+|\s+$", ""))


def is_blank(c: str | Column) -> Column:
    """NULL or only spaces."""
    return col(c).isNull() | (F.trim(col(c)) == F.lit(""))


def nonblank(c: str | Column) -> Column:
    return col(c).isNotNull() & (F.trim(col(c).cast("string")) != F.lit(""))


def label_tiers(value: str | Column, cuts: Sequence[tuple[str, float]], otherwise: str,
                inclusive: bool = True) -> Column:
    """Searched CASE: first ``(label, cut)`` with value >= cut (or > cut) wins."""
    v = col(value)
    expr = None
    for label, cut in cuts:
        cond = (v >= F.lit(cut)) if inclusive else (v > F.lit(cut))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise)) if expr is not None else F.lit(otherwise)



def cost_tier(monthly_cost: str | Column, high: float = 830.0, moderate: float = 100.0) -> Column:
    """BI calculated field: > high "High Cost", > moderate "Moderate", else "Low Cost"."""
    v = col(monthly_cost)
    return (F.when(v > F.lit(high), F.lit("High Cost"))
            .when(v > F.lit(moderate), F.lit("Moderate"))
            .otherwise(F.lit("Low Cost")))


def legend_bin(value: str | Column, low, high, bins: int) -> Column:
    """Equal-width bin number for a map legend (``width_bucket``): 0 below ``low``,
    ``bins + 1`` at or above ``high``; ``low`` / ``high`` may be numbers or columns."""
    lo = low.cast("double") if isinstance(low, Column) else F.lit(float(low))
    hi = high.cast("double") if isinstance(high, Column) else F.lit(float(high))
    return F.width_bucket(col(value).cast("double"), lo, hi, F.lit(bins))


def mask_text(c: str | Column) -> Column:
    """Column masking: upper -> X, lower -> x, digit -> n."""
    return F.mask(col(c))


def hash_identifier(c: str | Column, salt: str) -> Column:
    """Salted SHA-256 of an identifier."""
    return F.sha2(F.concat(F.lit(salt), col(c).cast("string")), 256)
