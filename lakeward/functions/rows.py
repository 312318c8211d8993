"""Report rows from one aggregate row, without re-reading the aggregate's input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(wide: DataFrame, rows: list[list[Column]]) -> DataFrame:
    """One output row per element of ``rows`` (each a list of aliased columns over ``wide``; the
    same names and types in every row).

    A union of one ``select`` per row over the same aggregate would let the optimizer prune every
    branch differently, so the input would be scanned and joined once per branch; here the
    aggregate is computed once and its row is expanded by ``inline``.
    """
    return wide.select(F.inline(F.array(*[F.struct(*cols) for cols in rows])))
