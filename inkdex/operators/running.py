"""Running totals over rows of which one key may hold most."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkdex.session import settle


def totals_before(rows: DataFrame, key: str, order: list[str], sizes: list[str]) -> DataFrame:
    """``rows`` with a column ``<size>_before`` per size: its sum over the rows of the same key that come earlier.

    Two steps: the rows are sorted by range, which may cut a key anywhere, and are summed up within each
    piece of a key; the sums of the pieces, as many as partitions that a key goes over, are summed up by key.
    ``order`` must tell the rows of a key apart. Rows without a key are left out.
    """
    place = F.monotonically_increasing_id()
    by = [key, *order]
    in_order = rows.where(F.col(key).isNotNull()).repartitionByRange(*by).sortWithinPartitions(*by)
    in_order = settle(in_order.select("*", place.alias("_at"), F.shiftright(place, 33).alias("_piece")), "in_order")
    inside = Window.partitionBy(key, "_piece").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    summed = in_order.groupBy(key, "_piece").agg(*(F.sum(s).alias(f"_{s}") for s in sizes))
    earlier = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    bases = summed.select(key, "_piece", *(F.coalesce(F.sum(f"_{s}").over(earlier), F.lit(0)).alias(f"_{s}") for s in sizes))
    own = in_order.select("*", *(F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"{s}_before") for s in sizes))
    joined = own.join(bases, [key, "_piece"])
    before = [(F.col(f"{s}_before") + F.col(f"_{s}")).cast("bigint").alias(f"{s}_before") for s in sizes]
    return joined.select(*rows.columns, *before)
