"""Keep expensive columns from being computed more than once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def settled(df: DataFrame, *names: str) -> DataFrame:
    """Make the named columns final.

    The optimizer moves a filter below the projections that compute its columns
    by repeating their expressions in it; for parsed JSON checked field by field
    that multiplies the work of every row. Columns that come out of a generator
    are not repeated, while filters on all other columns still move down.
    """
    rest = [name for name in df.columns if name not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names))))
