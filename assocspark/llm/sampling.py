"""Bounded training samples and the hold-out rule that the trained operators share."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WHOLE = 1 << 62


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the id's digits divisible by 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def sample_ids(rows: DataFrame, label: str, per_label: int) -> tuple[DataFrame, dict]:
    """About ``per_label`` ids (doc_id, label) of every label value, chosen by hash, never over twice that; and how many rows each label has.

    Only counts per label reach the driver; no group of a label is gathered or sorted.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    rate = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, int(_WHOLE * min(1.0, 1.2 * per_label / n))))) if counts else F.create_map(F.lit(0), F.lit(0))
    value = F.col(label) if counts else F.lit(0)
    return rows.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 2) <= rate[value]), counts


def trimmed(sample: list, per_label: int) -> list:
    """At most ``per_label`` rows of each label (second field), in a fixed order of their ids."""
    seen: dict = {}
    kept = []
    for row in sorted(sample, key=lambda r: (hash((r[0], 7)), r[0])):
        seen[row[1]] = seen.get(row[1], 0) + 1
        if seen[row[1]] <= per_label:
            kept.append(row)
    return kept
