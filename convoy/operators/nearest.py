"""Nearest waypoint by grid cells, equal to the scan of the whole list.

:func:`cell_index` puts the waypoints of each route into the cells of a grid over
their extent, about ``n ** (1/3)`` cells a side, and keeps each cell's box. A search
first bounds the distance by one waypoint of each cell, then opens only the cells
whose box is not farther than the least bound. With ``n`` waypoints it looks at
about ``n ** (2/3)`` of them, along a line or scattered. Distances and
box distances are rounded alike by monotone operations, so the cell of the nearest
waypoint is always open and the result equals the scan to the last bit.

The index is a table of routes, built once and joined like the lists themselves;
the search is an expression, without a further shuffle, and also runs on streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convoy.functions import columns as C


def cell_index(waypoints: DataFrame) -> DataFrame:
    """``route_id, cells`` from ``route_id, waypoints``: an array of boxes with their points.

    Waypoints with NULL or non-finite coordinates take no part; a route without any
    keeps an empty array. Lists of a repeated route id are united.
    """
    finite = lambda c: F.abs(c) < float("inf")  # noqa: E731  NaN counts as the largest value
    points = waypoints.select("route_id", F.explode("waypoints").alias("p")).where(finite(F.col("p.lat")) & finite(F.col("p.lon")))
    extent = points.groupBy("route_id").agg(
        F.min("p.lat").alias("lat0"), F.min("p.lon").alias("lon0"), F.ceil(F.cbrt(F.count(F.lit(1)))).alias("side"),
        F.greatest(F.max("p.lat") - F.min("p.lat"), F.max("p.lon") - F.min("p.lon")).alias("span"))
    at = lambda c, least: F.least(F.floor(F.try_divide(F.col(c) - F.col(least), "span") * F.col("side")), F.col("side") - 1)
    cells = (points.join(extent, "route_id")
             .groupBy("route_id", at("p.lat", "lat0").alias("y"), at("p.lon", "lon0").alias("x"))
             .agg(F.struct(F.min("p.lat").alias("lat0"), F.max("p.lat").alias("lat1"), F.min("p.lon").alias("lon0"),
                           F.max("p.lon").alias("lon1"), F.collect_list("p").alias("points")).alias("cell")))
    lists = cells.groupBy("route_id").agg(F.collect_list("cell").alias("cells"))
    routes = waypoints.select("route_id").distinct().join(lists, "route_id", "left")
    return routes.select("route_id", F.coalesce("cells", F.array().cast(lists.schema["cells"].dataType)).alias("cells"))


def nearest_in_cells_km(cells: Column, lat: Column, lon: Column) -> Column:
    """Least planar distance to a waypoint of ``cells``; +inf without any."""
    def box_km(c: Column) -> Column:
        inside = lambda v, lo, hi: F.least(F.greatest(v, lo), hi)
        return C.planar_km(inside(lat, c["lat0"], c["lat1"]), inside(lon, c["lon0"], c["lon1"]), lat, lon)

    km = lambda p: C.planar_km(p["lat"], p["lon"], lat, lon)
    # the bound is computed once, as the start value of the search through the boxes
    bound = F.array_min(F.transform(cells, lambda c: km(c["points"][0])))
    least = F.aggregate(cells, bound, lambda best, c: F.when(
        box_km(c) <= best, F.least(best, F.array_min(F.transform(c["points"], km)))).otherwise(best))
    return F.coalesce(least, F.lit(float("inf")))
