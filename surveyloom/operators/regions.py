"""Region lookup for points, region means, hulls and transects."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveyloom.functions.geo import bucket, inside, ring_edges
from surveyloom.functions.missing import mean_strict
from surveyloom.operators.combine import null_safe_join
from surveyloom.session import join_lookup

PLACE = ("Latitude", "Longitude")
# Relative error that the two products of an orientation test can have.
ROUNDING = 2.0**-50


def region_cells(regions: DataFrame, cell_degrees: float) -> DataFrame:
    """Cells that a region touches: ``Region``, ``_cx``, ``_cy``, ``_odd`` and ``_edges``.

    A point's ray to the east crosses the rings an odd number of times if it is inside. In a cell that
    no edge touches this is the same for all points, so it holds the answer (``_odd``) and no edges; cells
    outside are left out. A boundary cell holds the edges that the rays of only some of its points may
    cross, and the parity of those that all of them cross, which lie to its east and span its height.
    """
    rings = F.col("rings") if "rings" in regions.columns else F.array("ring")
    edges = F.filter(F.flatten(F.transform(rings, ring_edges)), lambda e: (e["x0"] != e["x1"]) | (e["y0"] != e["y1"]))
    shapes = regions.select("Region", edges.alias("_all"))
    ends = lambda axis: F.concat(F.transform("_all", lambda e: e[f"{axis}0"]), F.transform("_all", lambda e: e[f"{axis}1"]))
    span = lambda axis: F.explode(F.sequence(bucket(F.array_min(ends(axis)), cell_degrees), bucket(F.array_max(ends(axis)), cell_degrees)))
    rows = shapes.select("Region", "_all", span("y").alias("_cy"))
    # Only edges whose height meets a row of cells can be crossed from there.
    slack = cell_degrees * 1e-9  # the bounds of a cell may be rounded
    low, high = F.col("_cy") * cell_degrees - slack, (F.col("_cy") + 1) * cell_degrees + slack
    rows = rows.select("Region", "_cy", low.alias("_y0"), high.alias("_y1"), span("x").alias("_cx"), F.filter(
        "_all", lambda e: (F.least(e["y0"], e["y1"]) <= high) & (F.greatest(e["y0"], e["y1"]) >= low)
    ).alias("_row"))
    x0, x1 = F.col("_cx") * cell_degrees - slack, (F.col("_cx") + 1) * cell_degrees + slack
    west = lambda e: F.least(e["x0"], e["x1"])
    spans = lambda e: (west(e) > x1) & (F.least(e["y0"], e["y1"]) < F.col("_y0")) & (F.greatest(e["y0"], e["y1"]) > F.col("_y1"))
    near = rows.select(
        "Region", "_cx", "_cy", F.filter("_row", lambda e: F.greatest(e["x0"], e["x1"]) >= x0).alias("_near"),
        ((F.col("_cx") + 0.5) * cell_degrees).alias("_x"), ((F.col("_cy") + 0.5) * cell_degrees).alias("_y"), "_y0", "_y1",
    )
    boundary = F.exists("_near", lambda e: west(e) <= x1)
    held = near.select(
        "Region", "_cx", "_cy",
        F.when(boundary, F.size(F.filter("_near", spans)) % 2 == 1).otherwise(inside(F.col("_near"), F.col("_x"), F.col("_y"))).alias("_odd"),
        F.when(boundary, F.filter("_near", lambda e: ~spans(e))).alias("_edges"),
    )
    return held.filter("_odd OR _edges IS NOT NULL")


def region_of_places(
    places: DataFrame, regions: DataFrame, default: str | None = None, cell_degrees: float = 0.25
) -> DataFrame:
    """Region of every distinct place; ``default`` outside all polygons.

    A region is one ``ring`` of corners, or several ``rings``: parts, and holes inside them. Regions are
    unrolled over the cells they touch and meet the places on the cell; the ray test over the edges
    of a boundary cell decides. A place in several regions gets the first by name.
    """
    distinct = places.select(*PLACE).dropna().distinct()
    celled = distinct.withColumns({
        "_cx": bucket(F.col("Longitude"), cell_degrees), "_cy": bucket(F.col("Latitude"), cell_degrees)
    })
    candidates = join_lookup(celled, region_cells(regions, cell_degrees), ["_cx", "_cy"], "left")
    crossed = F.coalesce(inside(F.col("_edges"), F.col("Longitude"), F.col("Latitude")), F.lit(False))
    hit = F.when(crossed != F.col("_odd"), F.col("Region"))
    found = candidates.groupBy(*PLACE).agg(F.min(hit).alias("Region"))
    return found if default is None else found.withColumn("Region", F.coalesce("Region", F.lit(default)))


def assign_regions(
    data: DataFrame, regions: DataFrame, default: str | None = None, cell_degrees: float = 0.25,
    places: DataFrame | None = None,
) -> DataFrame:
    """Add ``Region``; rows without coordinates get none, not the default.

    ``places`` is a shorter table with all the places of ``data``, such as its samples.
    """
    found = region_of_places(data if places is None else places, regions, default, cell_degrees)
    return join_lookup(data, found, PLACE, "left")


def region_means(located: DataFrame) -> DataFrame:
    """Mean CPUE per region, year and taxon (missing with any catch missing), placed at the middle of the region's coordinate range.

    The middles come from a combinable aggregate, not a window, so a dominant region stays spread.
    """
    middle = lambda c: ((F.min(c) + F.max(c)) / 2).alias(c)
    centres = located.groupBy("Region").agg(middle("Latitude"), middle("Longitude"))
    means = located.groupBy("Region", "Year", "Taxlifestage").agg(mean_strict("CPUE").alias("CPUE"))
    return null_safe_join(means, centres, ["Region"], "left")


def bounds(df: DataFrame) -> DataFrame:
    """Latitude and longitude limits of all points."""
    return df.agg(
        F.min("Latitude").alias("Lat_min"), F.max("Latitude").alias("Lat_max"),
        F.min("Longitude").alias("Long_min"), F.max("Longitude").alias("Long_max"),
    )


def turns_left(a: tuple[float, float], b: tuple[float, float], c: tuple[float, float]) -> bool:
    """Whether the path a, b, c turns to the left, exactly: rational arithmetic decides what rounding may blur."""
    left, right = (b[0] - a[0]) * (c[1] - a[1]), (b[1] - a[1]) * (c[0] - a[0])
    if abs(left - right) > ROUNDING * (abs(left) + abs(right)):
        return left > right
    (ax, ay), (bx, by), (cx, cy) = (tuple(map(Fraction, p)) for p in (a, b, c))
    return (bx - ax) * (cy - ay) > (by - ay) * (cx - ax)


def hull_reducer(group: str):
    """Batch function replacing each group's points by their convex-hull corners."""

    def chain(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
        half: list[tuple[float, float]] = []
        for p in points:
            while len(half) > 1 and not turns_left(half[-2], half[-1], p):
                half.pop()
            half.append(p)
        return half

    def hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
        points = sorted(set(points))
        if len(points) < 3:
            return points
        return list(dict.fromkeys(chain(points)[:-1] + chain(points[::-1])[:-1]))

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[str | None, list[tuple[float, float]]] = {}
        for batch in batches:
            for name, part in batch.groupby(group, sort=False, dropna=False):
                name = None if pd.isna(name) else name
                points = list(zip(part["Longitude"], part["Latitude"]))
                kept[name] = hull(kept.get(name, []) + points)
        corners = [(name, *p) for name, points in kept.items() for p in points]
        if corners:
            names, longitudes, latitudes = zip(*corners)
            yield pd.DataFrame({
                group: pd.Series(names, dtype=object), "Longitude": longitudes, "Latitude": latitudes
            })

    return reduce


def hull_by_group(points: DataFrame, group: str, fan_in: int = 64) -> DataFrame:
    """Corners of the convex hull of each group's points, points on an edge left out.

    Points shrink to the two extremes per meridian, then to the hull of each partition batch by
    batch, then per group in ``fan_in`` parts, then per group; no step holds a whole group.
    """
    extremes = points.select(group, *PLACE).dropna(subset=list(PLACE)).groupBy(group, "Longitude").agg(
        F.min("Latitude").alias("_lo"), F.max("Latitude").alias("_hi")
    ).select(group, "Longitude", F.explode(F.array_distinct(F.array("_lo", "_hi"))).alias("Latitude"))
    schema = extremes.schema
    part = F.pmod(F.xxhash64("Longitude", "Latitude"), F.lit(fan_in))
    reducer = hull_reducer(group)
    local = extremes.mapInPandas(reducer, schema)
    fewer = local.repartition(F.col(group), part).mapInPandas(reducer, schema)
    return fewer.repartition(F.col(group)).mapInPandas(reducer, schema)


def transects(stations: DataFrame, group: str) -> DataFrame:
    """Distinct station points of a transect in one ordered list; station lists are short by nature."""
    distinct = stations.select(group, *PLACE).dropna().distinct()
    return distinct.groupBy(group).agg(
        F.sort_array(F.collect_list(F.struct("Longitude", "Latitude"))).alias("points")
    )
