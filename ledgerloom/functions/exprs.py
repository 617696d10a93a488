"""Column expressions shared by the models.

Everything here returns a ``Column`` built from ``pyspark.sql.functions``;
no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(8,4)"
FX = "decimal(18,6)"
PCT = "decimal(18,6)"

__all__ = [
    "MONEY", "RATE", "FX", "PCT", "col", "round_money", "typed_null",
    "pct_ratio", "flag01", "count_when", "yyyymmdd",
    "yyyy_mm", "mon_yy", "prior_month_28th", "calendar_year_diff", "greatest_strict",
    "first_match", "lookup", "is_truthy", "not_in_nullsafe", "pad_num",
]


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_money(c, digits: int = 2) -> Column:
    """ROUND half away from zero, kept as decimal(18,2) (never bround)."""
    return F.round(col(c), digits).cast(MONEY)


def typed_null(dtype: str) -> Column:
    """Typed NULL literal (NULL::VARCHAR, NULL::NUMBER → money)."""
    return F.lit(None).cast(dtype)


def pct_ratio(num, den, digits: int = 2) -> Column:
    """ROUND(num::FLOAT / NULLIF(den,0) * 100, digits) computed in double,
    then rounded through a decimal(18,6) cast so both engines tie-break alike."""
    ratio = col(num).cast("double") / F.nullif(col(den).cast("double"), F.lit(0.0)) * F.lit(100.0)
    return F.round(ratio.cast(PCT), digits).cast("decimal(18,%d)" % digits)


def flag01(cond: Column) -> Column:
    """CASE WHEN cond THEN 1 ELSE 0 END (NULL cond → 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def count_when(cond: Column) -> Column:
    """SUM(CASE WHEN cond THEN 1 ELSE 0 END) as a bigint aggregate."""
    return F.sum(flag01(cond)).cast("bigint")


def yyyymmdd(d) -> Column:
    return F.date_format(col(d), "yyyyMMdd")


def yyyy_mm(d) -> Column:
    return F.date_format(col(d), "yyyy-MM")


def mon_yy(d) -> Column:
    """'Mon YY' label, e.g. 'Oct 24'."""
    return F.date_format(col(d), "MMM yy")


def prior_month_28th(d) -> Column:
    """28th of the month before ``d`` (year rolls over in January)."""
    return F.date_add(F.trunc(F.add_months(col(d), -1), "month"), 27)


def calendar_year_diff(start, end) -> Column:
    """DATEDIFF(year, a, b): calendar-year boundaries crossed (31 Dec → 1 Jan = 1)."""
    return (F.year(col(end)) - F.year(col(start))).cast("int")


def greatest_strict(*cols) -> Column:
    """GREATEST that is NULL when any argument is NULL (warehouse semantics;
    Spark's greatest skips NULLs)."""
    cs = [col(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def first_match(pairs, default=None) -> Column:
    """Searched CASE: first (condition, value) that holds wins."""
    expr = None
    for cond, val in pairs:
        v = val if isinstance(val, Column) else F.lit(val)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    d = default if isinstance(default, Column) else F.lit(default)
    return expr.otherwise(d)


def lookup(key, mapping: dict, default=None) -> Column:
    """Literal lookup by code with a default (a CASE over a small fixed map)."""
    k = col(key)
    return first_match([(k == F.lit(a), b) for a, b in mapping.items()], default)


def is_truthy(c) -> Column:
    """Non-NULL and non-empty string."""
    return col(c).isNotNull() & (col(c) != F.lit(""))


def not_in_nullsafe(c, values) -> Column:
    """NOT IN that keeps NULLs out explicitly (SQL NOT IN is unknown on NULL)."""
    return col(c).isNotNull() & ~col(c).isin(list(values))


def pad_num(c, width: int) -> Column:
    """Zero-padded decimal text of an integer column (never truncates)."""
    s = col(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))
