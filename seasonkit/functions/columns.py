"""Column-expression helpers. All of them build built-in Spark expressions,
so they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def eq_flag(a, b) -> Column:
    """1 when ``a == b``, else 0 -- including when either side is null."""
    return F.when(col_(a) == col_(b), F.lit(1)).otherwise(F.lit(0))


def value_flag(c, value) -> Column:
    """1 when the column equals a literal, else 0 (null gives 0)."""
    return F.when(col_(c) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def nan_to_null(c) -> Column:
    """Turn a floating NaN into null so that ``avg``/``sum`` skip it as pandas does."""
    x = col_(c).cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def required(c, keys=()) -> Column:
    """A floating column that must be present: null and NaN fail, naming the column and the row's keys."""
    x = col_(c).cast("double")
    where = [F.concat(F.lit(f" {k}="), F.coalesce(F.col(k).cast("string"), F.lit("null"))) for k in keys]
    fail = F.raise_error(F.concat(F.lit(f"missing value in {c if isinstance(c, str) else 'a column'}:"), *where))
    return F.when(x.isNull() | F.isnan(x), fail.cast("double")).otherwise(x)


def mean_(c) -> Column:
    """pandas ``mean``: skips missing values, null when every value is missing."""
    return F.avg(col_(c))


def sum0(c) -> Column:
    """pandas ``sum``: skips missing values, 0 when every value is missing."""
    return F.coalesce(F.sum(col_(c)), F.lit(0.0))


# Output grid of compared floating columns: multiples of 2**-20 (about 1e-6).
# Binary, not decimal: values computed from decimal inputs (averages of
# cents, say) often sit exactly on a decimal rounding tie, where two engines
# summing in different orders land on different sides; they practically never
# sit on a binary tie.
QUANTUM = 1048576.0


def round6(c) -> Column:
    """Round to the nearest multiple of 2**-20 (about 6 decimals) as
    ``round(x * 2^20) / 2^20 + 0.0`` -- the same arithmetic as the oracle SQL;
    ``+ 0.0`` turns a negative zero into zero."""
    return F.round(col_(c) * F.lit(QUANTUM)) / F.lit(QUANTUM) + F.lit(0.0)
