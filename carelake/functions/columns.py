"""Column expressions used across the jobs. All are built-in Spark expressions,
so they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_cast(c: ColumnOrName, to: str = "int") -> Column:
    """Cast that yields NULL for text that is not a number (``'in'`` -> NULL).

    ANSI mode is on by default, where a plain cast raises; ``try_cast`` keeps the
    non-raising semantics of the original jobs without turning ANSI off.
    """
    return _col(c).try_cast(to)


def flag(c: ColumnOrName, value) -> Column:
    """1 where the column equals ``value``, else 0 (NULL input gives 0)."""
    return F.when(_col(c) == F.lit(value), F.lit(1)).otherwise(F.lit(0))


def month_of(c: ColumnOrName) -> Column:
    """Calendar month as text ``yyyy-MM``."""
    return F.date_format(_col(c), "yyyy-MM")


def exact_sum(c: ColumnOrName, scale: int = 2) -> Column:
    """Sum of a money-like double, added as a fixed-point decimal.

    A double sum depends on the order of addition, which depends on the
    partitioning; a decimal sum does not, so results are identical however the
    data is split. The partial sums still combine map-side. A value with more than ``scale``
    decimals raises: nothing is rounded away without a word.
    """
    x = _col(c)
    exact = x.cast(f"decimal(18,{scale})")
    lost = F.raise_error(F.concat(F.lit(f"exact_sum: more than {scale} decimals in "), x.cast("string")))
    fits = F.abs(exact.cast("double") - x.cast("double")) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(x.cast("double")))
    return F.sum(F.when(x.isNull() | fits, exact).otherwise(lost.cast(f"decimal(18,{scale})"))).cast("double")


def rounded(c: ColumnOrName, digits: int = 6) -> Column:
    return F.round(_col(c), digits)


def pearson(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Pearson r as an aggregate over the rows where both values are present
    (pairwise complete); NULL (not an error) when a side is constant."""
    a, b = _col(a), _col(b)
    both = a.isNotNull() & b.isNotNull()
    a2, b2 = F.when(both, a), F.when(both, b)
    return F.try_divide(F.covar_samp(a2, b2), F.stddev_samp(a2) * F.stddev_samp(b2))


def request_url(base: str, name: ColumnOrName) -> Column:
    """Lookup URL for a drug name: base + url-encoded name."""
    return F.concat(F.lit(base), F.url_encode(_col(name)))
