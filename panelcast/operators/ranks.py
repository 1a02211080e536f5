"""Row numbers over a whole table without a window in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.session import cut_lineage

ROW_BITS = 33      # monotonically_increasing_id: partition above, row in it below


def global_rank(df: DataFrame, order: list[str], out: str = "rank") -> tuple[DataFrame, int]:
    """``df`` with the number (from 1) of each row in the order of ``order``, nulls first,
    and the number of rows.

    Rows are dealt by ranges of the order and sorted inside their partition; a partition's
    rows are numbered in place, and the sizes of the partitions before it, one number for
    each, are added. Rows that tie in ``order`` may take any of their numbers."""
    cols = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order]
    at = "_at"
    while at in df.columns:
        at = "_" + at
    placed = cut_lineage(df.repartitionByRange(*cols).sortWithinPartitions(*cols).withColumn(at, F.monotonically_increasing_id()))
    part = F.shiftright(at, ROW_BITS)
    sizes = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, total = [], 0
    for p, n in sizes:
        before.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(before, "_part long, _before long")
    ranked = placed.join(F.broadcast(offsets), part == F.col("_part"))     # one row for each partition
    number = F.col("_before") + F.col(at).bitwiseAND((1 << ROW_BITS) - 1) + 1
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], number.cast("int" if total < 1 << 31 else "long").alias(out)), total
