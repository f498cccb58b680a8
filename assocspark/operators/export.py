"""Union, ordering and summary projection of combined results."""
from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the summary table, and the tail of every issue report.
SUMMARY_COLUMNS = ("SNPID", "CHR", "BP", "EA", "OA", "EAF", "N_eff", "BETA", "SE", "Z", "PVAL", "INFO")
ISSUE_TAIL = ("trait", "QC_action", "QC_reason")


def union_results(tables: Sequence[DataFrame]) -> DataFrame:
    """Union of rows and of columns; absent columns are NULL; ``source_order`` numbers the inputs."""
    if not tables:
        raise ValueError("no results to combine")
    marked = [t.withColumn("source_order", F.lit(i)) for i, t in enumerate(tables)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)


def merge_issues(tables: Sequence[DataFrame]) -> DataFrame:
    """Issue reports with different record columns in one table, report columns last."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return merged.select(*[c for c in merged.columns if c not in ISSUE_TAIL],
                         *[c for c in ISSUE_TAIL if c in merged.columns])


def export_summary(df: DataFrame, *, n_eff: float | None = None, info: float | None = None) -> DataFrame:
    """The 12 summary columns; constants replace (or supply) N_eff and INFO here only."""
    if n_eff is not None and not (math.isfinite(n_eff) and n_eff > 0):
        raise ValueError("n_eff must be finite and > 0")
    if info is not None and not (math.isfinite(info) and 0 <= info <= 1):
        raise ValueError("info must be finite and in [0,1]")
    constants = {"N_eff": n_eff, "INFO": info}
    missing = [c for c in SUMMARY_COLUMNS if c not in df.columns and constants.get(c) is None]
    if missing:
        raise ValueError(f"missing columns {missing}")
    return df.select(*[F.col(c) if constants.get(c) is None else F.lit(float(constants[c])).alias(c)
                       for c in SUMMARY_COLUMNS])
