"""Test helper: turn a table into a replayable file stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_replay(df: DataFrame, path: str, order_col: str, n_files: int,
                 fmt: str = "text") -> None:
    """Write ``df`` as ``n_files`` files in ``order_col`` order, one Spark job
    per file so file times follow the order (a file stream reads oldest
    first). Small test inputs only: each file is written by one task."""
    bounds = df.agg(F.min(order_col), F.max(order_col)).first()
    lo, hi = bounds[0], bounds[1]
    step = (hi - lo) // n_files + 1
    for i in range(n_files):
        part = df.where((F.col(order_col) >= lo + i * step) &
                        (F.col(order_col) < lo + (i + 1) * step))
        part = part.coalesce(1).sortWithinPartitions(order_col)
        if fmt == "text":
            part.select("value").write.mode("append").text(path)
        else:
            part.write.mode("append").format(fmt).save(path)
