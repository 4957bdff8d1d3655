"""Sampled splitters: balanced key ranges from a size-weighted sample (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: most ranges; their boundaries (8 bytes each) reach the driver and every task
MAX_RANGES = 8192
SAMPLES_PER_RANGE = 64


def splitters(rows: DataFrame, key: str, size: str, n_ranges: int, total: float) -> list[int]:
    """Boundaries (existing keys, sorted, distinct) of about ``n_ranges`` ranges of equal ``size``.

    A row enters the sample with a probability proportional to its size, decided
    by a hash of key and size, so reruns agree. The sample has about ``SAMPLES_PER_RANGE`` rows a range whatever the
    table's size; only the boundaries are collected. Null keys are not sampled.
    """
    n_ranges = min(n_ranges, MAX_RANGES)
    if n_ranges < 2 or not total:
        return []
    chance = F.col(size) * (n_ranges * SAMPLES_PER_RANGE / total)
    dice = F.shiftrightunsigned(F.xxhash64(F.lit(3), key, size), 11) / float(1 << 53)
    sample = rows.where(F.col(key).isNotNull() & (dice < chance))
    at = [i / n_ranges for i in range(1, n_ranges)]
    found = sample.agg(F.percentile_approx(key, at, 100_000)).first()[0]
    return sorted(set(found or []))


def range_of(key: Column, bounds: list[int]) -> Column:
    """Number of boundaries at or below ``key``; a null key is in the last range. Two short scans, not one long one."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    heads, groups = bounds[::step], [bounds[i:i + step] for i in range(0, len(bounds), step)]
    group = F.size(F.filter(F.lit(heads), lambda b: b <= key))
    inner = F.size(F.filter(F.element_at(F.lit(groups), F.greatest(group, F.lit(1))), lambda b: b <= key))
    found = F.when(group == 0, 0).otherwise((group - 1) * step + inner)
    return F.when(key.isNull(), len(bounds)).otherwise(found)
