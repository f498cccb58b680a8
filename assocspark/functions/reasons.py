"""Audit text: every failed check adds its message, in the order the checks are listed."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON_SEPARATOR = "; "


def failed_reasons(checks: Sequence[tuple[Column, str]], separator: str = REASON_SEPARATOR) -> Column:
    """Messages of the checks that do not hold; a NULL check counts as failed. '' if all hold."""
    return F.concat_ws(
        separator, *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(message)) for ok, message in checks])


def list_reasons(marks: Sequence[tuple[Column, str]], separator: str = REASON_SEPARATOR) -> Column:
    """Messages of the conditions that do hold; a NULL condition does not."""
    return F.concat_ws(separator, *[F.when(applies, F.lit(message)) for applies, message in marks])


def evaluate_once(df: DataFrame) -> DataFrame:
    """Fix computed columns as plain attributes for everything downstream.

    A filter on a long computed column is otherwise pushed below it, which copies the expression into each
    filter, join and inferred constraint that uses it; with a few dozen checks planning then takes longer
    than the job. A one-element ``inline`` is a narrow generator that no predicate crosses.
    """
    return df.select(F.inline(F.array(F.struct(*df.columns))))
