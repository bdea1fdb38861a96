"""Help for the optimiser where its default choice would repeat work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are costly to compute.

    Spark moves a filter below the projection it refers to by copying the expressions into
    the filter, so a costly column (a parsed record, say) would run once for the filter and
    again for the result. Rows that pass through inline() are a border for such moves.
    """
    packed = F.struct(*[column.alias(name) for name, column in columns.items()])
    return rows.select("*", F.inline_outer(F.array(packed)))
