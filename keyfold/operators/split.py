"""Side outputs (SPL-1): one input, several typed outputs.

Each output is a projection + filter of the same frame.  In batch form the
caller writes each; in a stream one ``foreachBatch`` writes all of them from
the same micro-batch (see ``keyfold.streaming``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def split_parity(df: DataFrame, value: str) -> dict[str, DataFrame]:
    """Main output all ints, ``even`` as text, ``odd`` as int."""
    rest = [c for c in df.columns if c != value]
    base = df.select(*rest, F.col(value).cast("int").alias("v"))
    return {
        "all": base,
        "even": base.filter(F.col("v") % 2 == 0).select(*rest, F.col("v").cast("string").alias("v")),
        "odd": base.filter(F.col("v") % 2 != 0),
    }
