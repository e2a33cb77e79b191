"""Null filling along (zone, time) order."""

from pyspark.sql import DataFrame, Window, functions as F



def fill_gaps(df: DataFrame, columns: list[str], direction: str = "back", scope: str = "frame",
              zone: str = "zone_id", order: str = "hour_bucket") -> DataFrame:
    """Fill nulls from the next ("back") or last ("forward") value, then 0.

    ``scope="frame"`` treats the whole frame, sorted by zone and time, as one sequence, so
    a value may come from a neighbouring zone; ``scope="zone"`` stays inside the zone.

    No window spans the frame: zones are filled one by one, and what crosses a zone border
    comes from one summary row per zone. Both frames grow downwards from the partition
    start (linear), hence the reversed order for "back".
    """
    if direction not in ("back", "forward") or scope not in ("frame", "zone"):
        raise ValueError(f"unknown fill: direction={direction!r}, scope={scope!r}")
    back = direction == "back"

    def along(name):
        return F.col(name).desc() if back else F.col(name).asc()

    inside = (Window.partitionBy(zone).orderBy(along(order))
                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = {c: F.last(c, ignorenulls=True).over(inside) for c in columns}
    if scope == "zone":
        return df.withColumns({c: F.coalesce(e, F.lit(0)) for c, e in filled.items()})

    nearest = F.min_by if back else F.max_by
    edges = df.groupBy(zone).agg(*(
        nearest(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns))
    # One row per zone, at most as many as there are zone ids.
    across = (Window.orderBy(along(zone))
                    .rowsBetween(Window.unboundedPreceding, -1))
    borders = edges.select(
        F.col(zone), *(F.last(c, ignorenulls=True).over(across).alias(f"_{c}") for c in columns))
    return (df.withColumns(filled)
              .join(borders, zone, "left")
              .withColumns({c: F.coalesce(c, f"_{c}", F.lit(0)) for c in columns})
              .drop(*(f"_{c}" for c in columns)))
