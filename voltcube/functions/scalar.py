"""Scalar column expressions. All are built-in Spark expressions (codegen)."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltcube import params as P


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(year, bands) -> Column:
    """Map a year to a label: ``bands = ((upper_inclusive, label), ...), else_label``.

    Open at both ends: anything below the first bound takes the first label.
    """
    edges, last = bands
    y = _col(year)
    expr = None
    for upper, label in edges:
        expr = F.when(y <= upper, F.lit(label)) if expr is None else expr.when(y <= upper, F.lit(label))
    return expr.otherwise(F.lit(last)) if expr is not None else F.lit(last)


def half_decade(year, bands=P.HALF_DECADE_BANDS) -> Column:
    return band(year, bands)


def pandemic_period(year, bands=P.PANDEMIC_BANDS) -> Column:
    return band(year, bands)


def gdp_class(gdp, high=P.GDP_HIGH, medium=P.GDP_MEDIUM, labels=P.GDP_LABELS) -> Column:
    """GDP class; inclusive lower bounds; NULL GDP falls to the last label."""
    g = _col(gdp)
    return (F.when(g >= F.lit(high), F.lit(labels[0]))
             .when(g >= F.lit(medium), F.lit(labels[1]))
             .otherwise(F.lit(labels[2])))


# All characters that count as white space in a Unicode text.
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c) -> Column:
    """White space of any kind removed from both ends."""
    return F.trim(_col(c), F.lit(WHITE_SPACE))


def clean_name(name, phrases=P.CLEAN_NAME_PHRASES) -> Column:
    """Lower-case, remove each phrase in order (literal replace), strip the ends."""
    low = F.lower(_col(name))
    removed = reduce(lambda acc, ph: F.replace(acc, F.lit(ph), F.lit("")), phrases, low)
    return strip(removed)


def nan_to_null(c) -> Column:
    """NaN and +-Infinity become NULL (they would poison sums and comparisons)."""
    x = _col(c)
    bad = F.isnan(x) | (x == F.lit(float("inf"))) | (x == F.lit(float("-inf")))
    return F.when(bad, F.lit(None).cast(T.DoubleType())).otherwise(x)


def ieee_divide(a, b) -> Column:
    """Float division with IEEE results for a zero divisor (x/0 = +-inf, 0/0 = NaN).

    Spark's ANSI division raises on zero; this reproduces what a float table
    library yields so that ``nan_to_null`` can be applied as the loader did.
    """
    x, y = _col(a).cast("double"), _col(b).cast("double")
    return (F.when(y.isNull() | x.isNull(), F.lit(None).cast("double"))
             .when(y != 0, x / y)
             .when((x == 0) | F.isnan(x), F.lit(float("nan")))
             .otherwise(F.signum(x) * F.lit(float("inf"))))


def zero_if_invalid(c) -> Column:
    """NULL, NaN and +-Inf become 0.0 (the chargers-per-EV rule)."""
    return F.coalesce(nan_to_null(c), F.lit(0.0))


def to_int_rounded(c, dtype: str = "int") -> Column:
    """Integer cast that rounds half away from zero (a plain cast truncates)."""
    return F.round(_col(c)).cast(dtype)


def to_decimal(c, precision: int, scale: int) -> Column:
    """Exact decimal; double inputs round HALF_UP to the scale."""
    return _col(c).cast(T.DecimalType(precision, scale))


def to_units(c, precision: int, scale: int) -> Column:
    """``to_decimal`` as a long that counts units of 10**-``scale`` (``precision`` at most 18).

    A double that is the closest one to a number of that scale below 15 digits, as money and quantities are, is
    counted by arithmetic on doubles; any other takes the way over the decimal. Sums of longs cost a small part of
    sums of decimals."""
    x, k = _col(c), 10 ** scale
    near = F.floor(x * float(k) + F.lit(0.5))
    exact = (F.abs(x) < F.lit(10.0 ** (min(precision, 15) - scale - 1))) & (near / F.lit(float(k)) == x)
    by_decimal = to_decimal(x, precision, scale).cast(T.DecimalType(38, scale)) * F.lit(k)
    return F.when(exact, near).otherwise(by_decimal.cast("bigint"))


def from_units(c, precision: int, scale: int) -> Column:
    """The decimal that counts as so many units of 10**-``scale``."""
    unit = F.lit(Decimal(1).scaleb(-scale))
    return (_col(c).cast(T.DecimalType(19, 0)) * unit).cast(T.DecimalType(precision, scale))


def scaled_units(units, percent) -> Column:
    """``units`` times ``percent`` / 100, rounded half away from zero, as a long of at most 18 digits; ``percent`` has at most 5."""
    u, pc = _col(units), _col(percent)
    n = u * pc
    wide = u.cast(T.DecimalType(18, 0)) * pc.cast(T.DecimalType(5, 0)) * F.lit(Decimal("0.01"))
    short = F.call_function("div", n + F.when(n < 0, F.lit(-50)).otherwise(F.lit(50)), F.lit(100))
    return F.when(F.abs(u) < F.lit(10 ** 13), short).otherwise(wide.cast(T.DecimalType(18, 0)).cast("bigint"))


def not_in_keep_null(c, values) -> Column:
    """``NOT IN`` that keeps NULL rows (a NULL is not in any list)."""
    return ~F.coalesce(_col(c).isin(list(values)), F.lit(False))


def ne_keep_null(c, value) -> Column:
    """``!=`` that keeps NULL rows."""
    return ~_col(c).eqNullSafe(F.lit(value))


def exact_mean(col: str, scale: int, out_scale: int = 10, count: str | None = None,
               prescaled: bool = False) -> Column:
    """Mean of a DECIMAL(p, ``scale``) column, rounded half away from zero to
    ``out_scale`` decimals, computed exactly (integer sum, integral division)
    and returned as a double. A float average depends on summation order and
    can land on either side of a rounding tie; this one cannot.

    ``count``/``prescaled`` combine partial results: ``col`` then names an
    integer sum of values scaled by 10**scale and ``count`` a row count."""
    s = f"sum({col})" if prescaled else f"sum(cast({col} * {10 ** scale} as decimal(38,0)))"
    n = f"sum({count})" if count else f"count({col})"
    k = 2 * 10 ** (out_scale - scale)
    q = f"((abs({s}) * {k} + {n}) div (2 * {n}))"
    return F.expr(f"case when {n} = 0 then null else "
                  f"cast(case when {s} < 0 then -{q} else {q} end as double) / {10 ** out_scale} end")


def exact_mean_sql(col: str, scale: int, out_scale: int = 10) -> str:
    """The same mean in DuckDB SQL (``//`` is integral division there)."""
    s = f"sum(cast({col} * {10 ** scale} as hugeint))"
    n = f"count({col})"
    k = 2 * 10 ** (out_scale - scale)
    q = f"((abs({s}) * {k} + {n}) // (2 * {n}))"
    return (f"case when {n} = 0 then null else "
            f"cast(case when {s} < 0 then -{q} else {q} end as double) / {10 ** out_scale} end")
