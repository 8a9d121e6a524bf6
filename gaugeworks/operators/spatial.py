"""Catalog, projection, raster, boundary filter and interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gaugeworks.functions.projection import SVY21, TransverseMercator, project
from gaugeworks.functions.values import non_finite, ratio
from gaugeworks.operators.ranking import distributed_rank, top_rows
from gaugeworks.spec import SeriesSpec

# Bits of a coordinate in the Morton code; points of one cell are told apart by their coordinates.
AXIS_BITS = 31
STEPS = 3
# Bounds and distances are rounded sums and roots: they are compared with this much room.
ROUNDING = 1e-12
# The coordinates stay text until the geometry type tells how deep they are nested.
GEOMETRY = "struct<type: string, coordinates: string>"


def entity_catalog(df: DataFrame, s: SeriesSpec, years: tuple[int, int] = (2017, 2024)) -> DataFrame:
    """First and last time of each id and its latest valid coordinate pair, in natural id order."""
    valid = F.col(s.latitude).between(-90, 90) & F.col(s.longitude).between(-180, 180)
    place = F.struct(F.col(s.time).alias("time"), F.col(s.latitude).alias("latitude"),
                     F.col(s.longitude).alias("longitude"))
    rows = (df.where(F.year(s.time).between(*years) & (F.col(s.entity) != "")).groupBy(s.entity)
            .agg(F.min(s.time).alias("first_time"), F.max(s.time).alias("last_time"),
                 F.max(F.when(valid, place)).alias("_place")))
    number = F.regexp_extract(s.entity, r"^S(\d+)$", 1)
    return (rows.select(s.entity, "first_time", "last_time", F.col("_place.latitude").alias("latitude"),
                        F.col("_place.longitude").alias("longitude"))
            .orderBy(F.when(number != "", 0).otherwise(1), number.try_cast("bigint"), s.entity))


def project_tm(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude",
               params: TransverseMercator = SVY21) -> DataFrame:
    """Add ``x`` and ``y`` in metres."""
    x, y = project(F.col(latitude), F.col(longitude), params)
    return df.withColumn("x", x).withColumn("y", y)


def bounds_of(points: DataFrame, pad: float = 0.0) -> DataFrame:
    return points.agg((F.min("x") - pad).alias("minx"), (F.max("x") + pad).alias("maxx"),
                      (F.min("y") - pad).alias("miny"), (F.max("y") + pad).alias("maxy"))


def raster(bounds: DataFrame, nx: int, pad: float = 3_000.0, least_rows: int = 90) -> DataFrame:
    """Evenly spaced cells over the padded bounds, edges included.

    Columns of cells are spread over the tasks before the rows are generated.
    """
    b = bounds.select((F.col("minx") - pad).alias("minx"), (F.col("maxx") + pad).alias("maxx"),
                      (F.col("miny") - pad).alias("miny"), (F.col("maxy") + pad).alias("maxy"))
    width, height = F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny")
    ny = F.greatest(F.lit(least_rows).cast("long"), F.floor(F.lit(nx) * height / width))
    columns = b.withColumn("ny", ny).withColumn("ix", F.explode(F.sequence(F.lit(0), F.lit(nx - 1)))).repartition("ix")
    cells = columns.withColumn("iy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ny") - 1)))
    return cells.select("ix", "iy", (F.col("minx") + width * F.col("ix") / (nx - 1)).alias("x"),
                        (F.col("miny") + height * F.col("iy") / (F.col("ny") - 1)).alias("y"))


def _collected_features(spark: SparkSession, path: str) -> DataFrame:
    """(feature, geometry) of a feature collection, numbered in the order of the file; features without coordinates do not count.

    The text is cut at the word that starts every feature, so one document is read by as many tasks as it has blocks. A
    geometry is the one object with coordinates; it holds no further object, and never the word.
    """
    start = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")).alias("_block")
    pieces = spark.read.option("lineSep", '"Feature"').text(path).select(start, F.monotonically_increasing_id().alias("_piece"), "value")
    objects = F.regexp_extract_all("value", F.lit(r'\{[^{}]*"coordinates"[^{}]*\}'), F.lit(0))
    found = pieces.select("_block", "_piece", F.posexplode(objects).alias("_place", "_text")).select(
        "_block", "_piece", "_place", F.from_json("_text", GEOMETRY).alias("geometry"))
    placed = found.withColumn("_own", F.row_number().over(Window.partitionBy("_block").orderBy("_piece", "_place")) - 1)
    # Offsets of the blocks: as many rows as the file has blocks.
    before = F.coalesce(F.sum("n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = found.groupBy("_block").agg(F.count("*").alias("n")).select("_block", before.alias("_base"))
    return placed.join(blocks, "_block").select((F.col("_base") + F.col("_own")).alias("feature"), "geometry")


def boundary_edges(spark: SparkSession, path: str, one_document: bool = True) -> DataFrame:
    """Edges of every ring of a GeoJSON boundary.

    ``one_document`` reads a feature collection; otherwise the file has one feature per line. Both are split over
    tasks. Polygons and multi-polygons are accepted.
    """
    if one_document:
        features = _collected_features(spark, path)
    else:
        features = (spark.read.schema(f"id long, geometry {GEOMETRY}").json(path)
                    .select(F.col("id").alias("feature"), "geometry"))
    text = F.col("geometry.coordinates")
    ring = "array<array<array<double>>>"
    polygons = (F.when(F.col("geometry.type") == "MultiPolygon", F.from_json(text, f"array<{ring}>"))
                .when(F.col("geometry.type") == "Polygon", F.array(F.from_json(text, ring))))
    rings = (features.select("feature", F.posexplode(polygons).alias("polygon", "rings"))
             .select("feature", "polygon", F.posexplode("rings").alias("ring", "pts")))
    steps = F.sequence(F.lit(1), F.size("pts") - 1)
    edges = rings.where(F.size("pts") > 1).select("feature", "polygon", "ring", "pts", F.explode(steps).alias("edge"))
    a, b = F.get("pts", F.col("edge") - 1), F.get("pts", F.col("edge"))
    return edges.select("feature", "polygon", "ring", "edge", a[0].alias("x1"), a[1].alias("y1"),
                        b[0].alias("x2"), b[1].alias("y2"))


def inside(points: DataFrame, edges: DataFrame, band: float, point_id: str = "point_id") -> DataFrame:
    """Points that any polygon covers, outlines included; ``edges`` as of ``boundary_edges``.

    Points and edges meet on equal horizontal bands of height ``band``, so a point sees the
    edges at its own height only. Crossing parity is counted per polygon over all its rings: holes
    are left out, and polygons may overlap.
    """
    polygon = ["feature", "polygon"]
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    banded = edges.select(*polygon, "x1", "y1", "x2", "y2",
                          F.explode(F.sequence(F.floor(low / band), F.floor(high / band))).alias("_band"))
    placed = points.select(point_id, "x", "y").withColumn("_band", F.floor(F.col("y") / band))
    x, y, x1, y1, x2, y2 = (F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2"))
    straddles = (y1 > y) != (y2 > y)
    crosses = straddles & (x < (x2 - x1) * (y - y1) / F.nullif(y2 - y1, F.lit(0.0)) + x1)
    on_edge = (((x - x1) * (y2 - y1) == (y - y1) * (x2 - x1))
               & x.between(F.least("x1", "x2"), F.greatest("x1", "x2"))
               & y.between(F.least("y1", "y2"), F.greatest("y1", "y2")))
    hit = placed.join(banded, "_band").groupBy(point_id, *polygon).agg(
        F.count_if(F.coalesce(crosses, F.lit(False))).alias("_n"), F.max(on_edge).alias("_edge"))
    covered = hit.where((F.col("_n") % 2 == 1) | F.col("_edge")).select(point_id)
    return points.join(covered, point_id, "left_semi")


def _spread(v: Column) -> Column:
    """The bits of a whole number with a zero between each two: its binary digits, read in base four."""
    return F.conv(F.bin(v), 4, 10).cast("long")


def _placed(points: DataFrame) -> DataFrame:
    """Points with their place ``rank`` along the Morton curve over the square around all of them."""
    bounds = points.agg(F.struct(F.min("px").alias("x0"), F.min("py").alias("y0"),
                                 F.greatest(F.max("px") - F.min("px"), F.max("py") - F.min("py")).alias("side"))).scalar()
    cells = 1 << AXIS_BITS

    def cell(c: str, low: str) -> Column:
        part = F.coalesce(F.try_divide(F.col(c) - F.col(f"_b.{low}"), F.col("_b.side")), F.lit(0.0))
        return F.least(F.floor(part * cells), F.lit(cells - 1))

    coded = points.withColumn("_b", bounds).withColumn("_code", _spread(cell("px", "x0")).bitwiseOR(F.shiftleft(_spread(cell("py", "y0")), 1)))
    return distributed_rank(coded.drop("_b"), "_code", [F.col("px"), F.col("py")], 2 * AXIS_BITS, "_rank").drop("_code")


def point_index(points: DataFrame, k: int, point_id: str = "point_id") -> DataFrame:
    """``points`` in runs along the Morton curve, for searches of up to ``k`` neighbours.

    The node of a place is its place divided by a power of the fan-out, which is the ``STEPS``-th root of the number of
    points. Crowded spots get many small runs and empty space none, so the tree's depth depends on neither.
    Several searches may share an index; persist or write it then.
    """
    # Copies on one spot: no more than k of them can ever be neighbours.
    placed = points.where("x is not null and y is not null and not isnan(x) and not isnan(y)").withColumnsRenamed({"x": "px", "y": "py"})
    number = placed.agg(F.count("*").cast("double").alias("n")).scalar()
    fan = F.greatest(F.lit(2).cast("long"), F.ceil(F.pow(number, F.lit(1.0 / STEPS))))
    kept = _placed(top_rows(placed, k, [F.col(point_id)], ["px", "py"])).withColumn("_fan", fan)
    return kept.withColumn("_up", F.call_function("div", F.col("_rank"), F.col("_fan"))).drop("_rank")


def _boxes(rows: DataFrame) -> DataFrame:
    """Bounding boxes and sizes of the runs ``_up`` of ``rows``, with the run ``_up`` they belong to themselves."""
    boxes = rows.groupBy(F.col("_up").alias("_node")).agg(
        F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("y0").alias("y0"), F.max("y1").alias("y1"), F.sum("n").alias("n"), F.max("_fan").alias("_fan"))
    return boxes.withColumn("_up", F.call_function("div", F.col("_node"), F.col("_fan")))


def _near(box: Column) -> Column:
    """No point of the box is nearer to (x, y): the greater of the gaps along both axes."""
    return F.greatest(box["x0"] - F.col("x"), F.col("x") - box["x1"], box["y0"] - F.col("y"), F.col("y") - box["y1"], F.lit(0.0))


def _far(box: Column) -> Column:
    """No point of the box is farther from (x, y): the distance of its farthest corner."""
    return F.hypot(F.greatest(F.col("x") - box["x0"], box["x1"] - F.col("x")), F.greatest(F.col("y") - box["y0"], box["y1"] - F.col("y")))


def _arrays(rows: DataFrame, k: int, *by: str) -> DataFrame:
    """The boxes of ``rows``, as an array per run they belong to, and how many of them hold ``k`` points for sure.

    All boxes of a step are of one size but for the last one, so the sizes of the smallest and the largest settle it.
    """
    enough = F.greatest(F.lit(1), F.ceil((k - F.min("n")) / F.max("n")) + 1)
    boxes = F.collect_list(F.struct("_node", "x0", "x1", "y0", "y1"))
    return rows.groupBy(*by).agg(F.struct(boxes.alias("all"), F.when(F.sum("n") >= k, enough).cast("int").alias("enough")).alias("_boxes"))


def _closest() -> tuple[Column, Column]:
    """A distance within which the boxes at hand hold ``k`` points, null if they hold fewer, and the node of the closest."""
    boxes, enough = F.col("_boxes.all"), F.col("_boxes.enough")
    least = F.array_min(F.transform(boxes, lambda b: F.struct(_far(b).alias("far"), b["_node"].alias("_node"))))
    several = F.get(F.sort_array(F.transform(boxes, _far)), enough - 1)
    return F.when(enough == 1, least["far"]).otherwise(several), least["_node"]


def _reached(distance: Column) -> Column:
    return F.col("_reach").isNull() | (distance * (1 - ROUNDING) <= F.col("_reach") * (1 + ROUNDING))


def neighbour_pairs(targets: DataFrame, index: DataFrame, k: int, target_id: str = "target_id", point_id: str = "point_id") -> DataFrame:
    """Pairs of targets and points of ``index``, with ``distance``, that hold the ``k`` nearest points of every target.

    A target first goes down the tree by the closest box of each step, which tells how far its ``k`` nearest points can
    lie, and then meets the boxes within that reach. A node's boxes or points are one array that a target is held against
    within its row, so a row is a target and a box in reach, and a last box gives its ``k`` nearest points only.
    Targets without finite coordinates are as far from one point as from another: they meet the first ``k`` ids.
    """
    own = [c for c in index.columns if c not in ("_up", "_fan")]
    spots = index.select("_up", "_fan", F.col("px").alias("x0"), F.col("px").alias("x1"), F.col("py").alias("y0"), F.col("py").alias("y1"), F.lit(1).cast("long").alias("n"))
    nodes = [_boxes(spots)]
    for _ in range(STEPS - 2):
        nodes.append(_boxes(nodes[-1]))
    first = _arrays(nodes.pop(), k).scalar()
    below = [_arrays(rows, k, "_up") for rows in reversed(nodes)]
    last = index.groupBy("_up").agg(F.collect_list(F.struct(*own)).alias("_points"))
    # Infinite points are told apart, as they may be at no distance from infinite targets.
    ends = {f"_{c}": F.when(non_finite(c), F.col(c)) for c in ("px", "py")}
    any_points = top_rows(index.withColumns(ends), k, [F.col(point_id)], list(ends)).agg(F.collect_list(F.struct(*own))).scalar()
    lost = F.coalesce(non_finite("x") | non_finite("y"), F.lit(True))
    key = [target_id, "x", "y"]

    # Down by the closest boxes. A scalar cannot stand inside a lambda, so it becomes a column first.
    reach, node = _closest()
    found = (targets.select(*key).repartition(target_id).select(*key, first.alias("_boxes"))
             .select(*key, F.when(~lost, reach).alias("_reach"), F.when(~lost, node).alias("_up")))
    for boxes in below:
        found = found.join(boxes, "_up", "left").select(*key, F.least("_reach", reach).alias("_reach"), node.alias("_up"))
    own_distances = F.transform("_points", lambda p: F.hypot(F.col("x") - p["px"], F.col("y") - p["py"]))
    found = found.join(last, "_up", "left").select(*key, F.least("_reach", F.get(F.sort_array(own_distances), k - 1)).alias("_reach"))

    # Down again by all boxes within reach.
    inside = F.transform(F.filter("_boxes.all", lambda b: _reached(_near(b))), lambda b: b["_node"])
    met = F.explode_outer(F.when(~lost, inside)).alias("_up")
    found = found.select(*key, "_reach", first.alias("_boxes")).select(*key, "_reach", met)
    for boxes in below:
        found = found.join(boxes, "_up", "left").select(*key, "_reach", met)
    found = found.join(last, "_up", "left").select(*key, "_reach", F.when(lost, any_points).otherwise(F.col("_points")).alias("_points"))

    def distance(p: Column) -> Column:
        dx, dy = F.col("x") - p["px"], F.col("y") - p["py"]
        return F.sqrt(dx * dx + dy * dy)

    measured = F.transform("_points", lambda p, i: F.struct(distance(p).alias("distance"), p[point_id].alias("id"), i.alias("i")))
    best = F.slice(F.sort_array(F.filter(measured, lambda p: _reached(p["distance"]))), 1, k)
    pairs = F.transform(best, lambda p: F.struct(F.get("_points", p["i"]).alias("_point"), p["distance"].alias("distance")))
    return found.select(*key, F.inline(pairs)).select(*key, *[F.col("_point")[c].alias(c) for c in own], "distance")


def nearest(targets: DataFrame, points: DataFrame, k: int, target_id: str = "target_id",
            point_id: str = "point_id", index: DataFrame | None = None) -> DataFrame:
    """The ``k`` nearest points of every target, exactly; equal distances go by ``point_id``.

    Points without coordinates are nobody's neighbours; without points there are no rows. Nothing runs before the
    result is used. ``index`` is the points' :func:`point_index` for ``k`` or more, where one is at hand.
    """
    if index is None:
        index = point_index(points, k, point_id)
    pairs = neighbour_pairs(targets, index, k, target_id, point_id)
    return top_rows(pairs, k, [F.col("distance"), F.col(point_id)], [target_id])


def distance_mask(cells: DataFrame, points: DataFrame, distance: float, target_id: str = "target_id",
                  point_id: str = "point_id", index: DataFrame | None = None) -> DataFrame:
    """Cells with a point within ``distance``; zero keeps all."""
    if not distance:
        return cells
    close = nearest(cells, points, 1, target_id, point_id, index).where(F.col("distance") <= distance)
    return cells.join(close.select(target_id), target_id, "left_semi")


def idw(targets: DataFrame, points: DataFrame, value: str, k: int = 8, power: float = 2.0,
        target_id: str = "target_id", point_id: str = "point_id", index: DataFrame | None = None) -> DataFrame:
    """Inverse-distance mean of the ``k`` nearest points; a coincident point gives its own value."""
    if power <= 0 or k < 1:
        raise ValueError("power > 0 and k >= 1 are required")
    near = nearest(targets, points.select(point_id, "x", "y", value), k, target_id, point_id, index)
    weight = F.pow(F.greatest(F.col("distance"), F.lit(1e-8)), F.lit(-float(power)))
    first = F.min(F.struct("distance", point_id, value))
    out = near.groupBy(target_id, "x", "y").agg(
        ratio(F.sum(weight * F.col(value)), F.sum(weight)).alias("_mean"), first.alias("_first"),
        F.count("*").alias("neighbours"))
    estimate = F.when(F.col("_first.distance") < 1e-8, F.col(f"_first.{value}")).otherwise(F.col("_mean"))
    return out.select(target_id, "x", "y", "neighbours", estimate.alias("estimate"))


def reconcile_points(points: DataFrame, expected: DataFrame, entity: str,
                     columns: Sequence[str] = ("rainy_pct", "mean_mm_per_interval", "latitude", "longitude"),
                     period: str = "analysis_years", tol: float = 1e-8) -> DataFrame:
    """Entities whose stored point differs from a fresh summary: absent, repeated, other period or value."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(entity).agg(
            F.count("*").alias(f"{name}_rows"), F.min(period).alias(f"{name}_period"),
            F.max(period).alias(f"{name}_last"), *[F.min(c).alias(f"{name}_{c}") for c in columns])

    both = side(points, "stored").join(side(expected, "fresh"), entity, "full")
    values = F.lit(True)
    for c in columns:
        values = values & F.coalesce(F.abs(F.col(f"stored_{c}") - F.col(f"fresh_{c}")) <= tol, F.lit(False))
    issue = (F.when(F.col("stored_rows").isNull(), "missing_point").when(F.col("fresh_rows").isNull(), "unknown_point")
             .when(F.col("stored_rows") > 1, "repeated_point")
             .when((F.col("stored_period") != F.col("fresh_period")) | (F.col("stored_last") != F.col("fresh_last")),
                   "other_period")
             .when(~values, "value_differs"))
    return both.select(entity, issue.alias("issue")).where(F.col("issue").isNotNull())
