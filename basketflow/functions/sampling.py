"""Hash sampling: the same rows are kept whatever the partitioning, seed by seed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Hasher = Callable[..., Column]

_SPAN = 1 << 40


def fast_hash(*cols: Column, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), *cols), F.lit(_SPAN))


def portable_hash(*cols: Column, seed: int) -> Column:
    """First 40 bits of an MD5 over the joined values: any SQL engine can compute the same."""
    text = F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 10), 16, 10).cast("long")


def keep_fraction(fraction: Column | float, *cols: Column, seed: int, hasher: Hasher = fast_hash) -> Column:
    """Bernoulli predicate that keeps about ``fraction`` of the distinct values of ``cols``."""
    share = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return hasher(*cols, seed=seed) < share * F.lit(float(_SPAN))
