"""Numeric column helpers: guarded ratios, fallbacks, resource formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str | float | int) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def safe_ratio(num, den, default=0.0) -> Column:
    """``num / den`` as double, ``default`` when den <= 0 or NULL."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return F.when(d > 0, n / d).otherwise(F.lit(default).cast("double"))


def first_nonzero(*cols, scales=None) -> Column:
    """Python ``a or b or ...`` over numbers: zero and NULL count as missing (P20).

    ``scales`` multiplies each candidate (e.g. a value given in KiB times 1024).
    Falls back to 0.
    """
    scales = scales or [1] * len(cols)
    picks = [F.nullif(_c(c).cast("double"), F.lit(0.0)) * F.lit(float(s)) for c, s in zip(cols, scales)]
    return F.coalesce(*picks, F.lit(0.0))


def cpu_percent(cpu_delta, system_delta, n_cpus) -> Column:
    """CPU %% = cpu_delta / system_delta * n_cpus * 100; 0 when system_delta <= 0."""
    sd = _c(system_delta).cast("double")
    return F.when(sd > 0, _c(cpu_delta).cast("double") / sd * _c(n_cpus).cast("double") * F.lit(100.0)).otherwise(
        F.lit(0.0)
    )


def memory_percent(usage, limit) -> Column:
    """usage / limit * 100, 0 when limit <= 0."""
    lim = _c(limit).cast("double")
    return F.when(lim > 0, _c(usage).cast("double") / lim * F.lit(100.0)).otherwise(F.lit(0.0))


def bytes_to_mb(b) -> Column:
    """bytes / 1024 / 1024."""
    return _c(b).cast("double") / F.lit(1024.0) / F.lit(1024.0)


def relative_difference(a, b) -> Column:
    """(a - b) / a * 100: how much smaller b is than a, in percent (A22); NULL if a is 0."""
    av = _c(a).cast("double")
    return F.when(av != 0, (av - _c(b).cast("double")) / av * F.lit(100.0))
