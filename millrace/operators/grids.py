"""Dense grids, totals, lookbacks and aligned series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense(axes: Sequence[DataFrame], facts: Sequence[DataFrame], on: Sequence[str], zero: Sequence[str]) -> DataFrame:
    """Every combination of the axes (each of a few values), facts joined to it, and zero where a measure is missing."""
    grid = axes[0]
    for a in axes[1:]:
        grid = grid.crossJoin(F.broadcast(a))
    for f in facts:
        grid = grid.join(f, list(on), "left")
    return grid.fillna(0, list(zero))


def with_total(df: DataFrame, keys: Sequence[str], area: str, total: int, measures: dict[str, Column]) -> DataFrame:
    """Measures by area and keys, and over all rows with an area under the key `total`. The total is summed up from the areas' rows."""
    detail = df.where(F.col(area).isNotNull()).groupBy(area, *keys).agg(*[m.alias(n) for n, m in measures.items()])
    everything = detail.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in measures]).withColumn(area, F.lit(total))
    return detail.unionByName(everything)


def within_before(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, seen: str, days: int) -> DataFrame:
    """Pairs of the same keys with right.seen in [left.at - days, left.at).

    Time is cut into slots of `days` days; a left row meets the right rows of its own slot and of the one
    before, so a key with a long history isn't joined as a whole."""
    slot = lambda c: F.floor(F.unix_seconds(F.col(c).cast("timestamp")) / (86_400 * days))
    probes = left.withColumn("__slot", F.explode(F.array(slot(at), slot(at) - 1)))
    build = right.withColumn("__slot", slot(seen))
    inside = (F.col(seen) < F.col(at)) & (F.col(seen) >= F.col(at) - F.expr(f"INTERVAL {days} DAYS"))
    return probes.join(build, [*keys, "__slot"]).where(inside).drop("__slot")


def lagged(df: DataFrame, area: str, order: str, y: str, lag: int) -> DataFrame:
    """Adds later_y: y as it stands `lag` rows further on in the area's series; the tail that has none goes."""
    w = Window.partitionBy(area).orderBy(order)
    return df.withColumn(f"later_{y}", F.lead(y, lag).over(w)).where(F.col(f"later_{y}").isNotNull())
