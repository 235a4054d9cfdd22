"""Contours of label grids by marching squares, and the shoreline pipeline over all scenes at once."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import geometry as geo
from strandline.functions.staging import dealt, staged, tasks_for
from strandline.operators import chains, distance, masks
from strandline.operators import reference as reference_lines
from strandline.operators.components import patches
from strandline.operators.masks import is_water
from strandline.operators.spatial_join import away_from_mask

# The directed segments of each case ul + 2 ur + 4 ll + 8 lr between the middles of a cell's
# sides (Top, Bottom, Left, Right), low values connected at a saddle.
SEGMENTS = {
    1: ["TL"],
    2: ["RT"],
    3: ["RL"],
    4: ["LB"],
    5: ["TB"],
    6: ["RT", "LB"],
    7: ["RB"],
    8: ["BR"],
    9: ["TL", "BR"],
    10: ["BT"],
    11: ["BL"],
    12: ["LR"],
    13: ["TR"],
    14: ["LT"],
}


def cells(grid: DataFrame, value: str = "value", tasks: int | None = None) -> DataFrame:
    """scene_id, row, col, case of each 2 x 2 cell with values at all four corners (column value, null for none).

    A corner is high above 0.5. Windows run along one pixel row and one pixel column of a scene, in ``tasks`` tasks where
    that is given.
    """
    deal = lambda df, *by: df.repartition(tasks, *by) if tasks else df
    v = F.col(value)
    g = deal(grid.select("scene_id", "row", "col", (v > 0.5).cast("int").alias("ul")), "scene_id", "row")
    right = Window.partitionBy("scene_id", "row").orderBy("col")
    nxt = F.lead(F.struct("col", "ul")).over(right)
    g = g.withColumn("_n", nxt).withColumn("ur", F.when(F.col("_n.col") == F.col("col") + 1, F.col("_n.ul"))).drop("_n")
    g = deal(g, "scene_id", "col")
    down = Window.partitionBy("scene_id", "col").orderBy("row")
    g = g.withColumn("_d", F.lead(F.struct("row", "ul", "ur")).over(down)).where(F.col("_d.row") == F.col("row") + 1)
    case = F.col("ul") + 2 * F.col("ur") + 4 * F.col("_d.ul") + 8 * F.col("_d.ur")
    return g.select("scene_id", "row", "col", case.alias("case")).where("case is not null")


def segments(grid: DataFrame, value: str = "value", tasks: int | None = None) -> DataFrame:
    """scene_id and directed segments (r0, c0) -> (r1, c1) in doubled pixel coordinates, which are whole."""
    r, k = F.col("row") * 2, F.col("col") * 2
    ends = {"T": (r, k + 1), "B": (r + 2, k + 1), "L": (r + 1, k), "R": (r + 1, k + 2)}

    def piece(s: str) -> Column:
        (r0, c0), (r1, c1) = ends[s[0]], ends[s[1]]
        return F.struct(r0.cast("long").alias("r0"), c0.cast("long").alias("c0"), r1.cast("long").alias("r1"), c1.cast("long").alias("c1"))

    out = None
    for case, parts in SEGMENTS.items():
        arr = F.array(*[piece(s) for s in parts])
        out = F.when(F.col("case") == case, arr) if out is None else out.when(F.col("case") == case, arr)
    return cells(grid, value, tasks).where(F.col("case").between(1, 14)).select("scene_id", F.explode(out).alias("s")).select("scene_id", "s.*")


def chained(segs: DataFrame, tile: int = 256, chunk: int = chains.CHUNK) -> DataFrame:
    """scene_id, contour_id, part, seq, row, col: the segments as ordered lines; a ring ends where it begins.

    contour_id tells the line's least vertex; part is 0, as two lines never share a vertex. Segments are ranked along
    their lines by chains.ordered(), and no task holds a line.
    """
    s = chains.ordered(segs, tile, chunk)
    last = F.when(F.col("seq") == F.col("length") - 1, F.struct((F.col("seq") + 1).alias("seq"), F.col("r1").alias("r"), F.col("c1").alias("c")))
    first = F.struct(F.col("seq").alias("seq"), F.col("r0").alias("r"), F.col("c0").alias("c"))
    s = s.select("scene_id", (F.col("low.r") * (1 << 32) + F.col("low.c")).alias("contour_id"), F.explode(F.filter(F.array(first, last), lambda v: v.isNotNull())).alias("v"))
    return s.select("scene_id", "contour_id", F.lit(0).alias("part"), F.col("v.seq").cast("int").alias("seq"), (F.col("v.r") / 2).alias("row"), (F.col("v.c") / 2).alias("col"))


def clean(vertices: DataFrame, by: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Drops contours with a vertex that is all NaN (or null), then vertices with any NaN; keeps those of two and more."""
    bad = lambda c: F.col(c).isNull() | F.isnan(c)
    own = Window.partitionBy(*by)
    v = vertices.withColumn("_all", F.max((bad(x) & bad(y)).cast("int")).over(own)).where((F.col("_all") == 0) & ~bad(x) & ~bad(y))
    return v.withColumn("_n", F.count(F.lit(1)).over(own)).where("_n > 1").drop("_all", "_n")


def long_enough(vertices: DataFrame, least: float, by: list[str], seq: str = "seq") -> DataFrame:
    """Contours of at least two vertices and a length of at least ``least``."""
    w = Window.partitionBy(*by).orderBy(seq)
    step = geo.distance(F.lag("x").over(w), F.lag("y").over(w), "x", "y")
    keep = vertices.withColumn("_d", step).groupBy(*by).agg(F.sum("_d").alias("_l"), F.count(F.lit(1)).alias("_n")).where((F.col("_n") >= 2) & (F.col("_l") >= least))
    return vertices.join(keep.select(*by).hint("merge"), by, "left_semi")


def shorelines(
    labels: DataFrame,
    mask: DataFrame,
    georef: list[float] | DataFrame,
    dates: DataFrame | None = None,
    buffer: DataFrame | None = None,
    water: tuple[int, ...] = (0, 1),
    least_patch: int = 100,
    least_length: float = 0,
    nodata_dist: float = 60,
    cloud_dist: float = 60,
    epsg: int | None = None,
    reference: DataFrame | None = None,
    reference_dist: float = 100,
) -> DataFrame:
    """scene_id, [date,] contour_id, part, seq, x, y: shorelines of all scenes at once.

    labels (scene_id, row, col, label) and mask (scene_id, row, col, shadow, cloud, nodata). Small patches of
    land become water, pixels under cloud, without data or outside ``buffer`` (scene_id, row, col) are blanked, contours traced and brought to world coordinates; contours that are too short go,
    vertices near missing data or clouds go, what is then too short goes. A line whose middle went keeps
    its two sides as one line. Scenes without a mask drop out, as do scenes where nothing is left.

    ``reference`` is the reference line itself (line_id, seq, lon, lat): pixels farther from it than ``reference_dist``
    are blanked, measured in each scene's own zone and grid.

    ``georef`` is one georeference for all scenes, or a table (scene_id, georef, epsg) with each scene's own and
    its UTM projection. Lengths and distances are measured there; ``epsg`` then names the UTM projection that
    all lines come out in.
    """
    if not isinstance(georef, DataFrame) and (epsg is not None or reference is not None):
        raise ValueError("an output projection and a reference line need each scene's own: give georef as a table")
    key = ["scene_id", "row", "col"]
    tasks = tasks_for(labels)
    flag = dealt(labels, tasks, *key).join(dealt(mask.select(*key, "shadow", "cloud", "nodata"), tasks, *key), key).select(*key, (~is_water("label", list(water))).alias("land"), (F.col("cloud") | F.col("shadow")).alias("cloud"), "nodata")
    flag = staged(flag)
    if least_patch > 1:
        land = patches(flag.where("land").select(*key), least_patch, tasks=tasks).select(*key, F.lit(True).alias("_big"))
        flag = dealt(flag, tasks, *key).join(dealt(land, tasks, *key), key, "left").withColumn("land", F.coalesce("_big", F.lit(False))).drop("_big")
    value = F.when(~(F.col("cloud") | F.col("nodata")), F.col("land").cast("double"))
    grid = flag.select(*key, value.alias("value"))
    if reference is not None:
        near = reference_lines.line_buffer(reference, georef, reference_lines.tiles_of(flag), reference_dist)
        grid = dealt(grid, tasks, *key).join(dealt(near.withColumn("_in", F.lit(True)), tasks, *key), key, "left").withColumn("value", F.when(F.col("_in"), F.col("value"))).drop("_in")
    if buffer is not None:
        by = [c for c in key if c in buffer.columns]
        grid = dealt(grid, tasks, *by).join(dealt(buffer.select(*by).distinct().withColumn("_in", F.lit(True)), tasks, *by), by, "left").withColumn("value", F.when(F.col("_in"), F.col("value"))).drop("_in")
    line = ["scene_id", "contour_id", "part"]
    v = clean(masks.in_world(chained(segments(grid, tasks=tasks)), georef, [*line, "seq", "row", "col"]), line)
    v = long_enough(v, least_length, line)
    v = _away(v, flag, georef, {"nodata": nodata_dist, "cloud": cloud_dist})
    v = long_enough(v, least_length, line)
    if epsg is not None:
        v = v.join(georef.select("scene_id", F.col("epsg").alias("_own")), "scene_id").withColumn("_to", F.lit(epsg))
        v = geo.with_utm(geo.with_lonlat(v, "x", "y", "_own", "_lon", "_lat"), "_lon", "_lat", "_to", "_x", "_y")
        other = F.col("_own") != epsg
        v = v.withColumns({k: F.when(other, F.col(f"_{k}")).otherwise(F.col(k)) for k in ("x", "y")}).drop("_own", "_to", "_lon", "_lat", "_x", "_y")
    return v if dates is None else v.join(dates.select("scene_id", "date"), "scene_id")


def _away(vertices: DataFrame, flags: DataFrame, georef: list[float] | DataFrame, least: dict[str, float]) -> DataFrame:
    """Vertices that keep the distance ``least`` (in the world) from the pixels of each flag; row and col go.

    Grids whose rows and columns are at right angles to the axes are measured in pixels, by a distance transform;
    others by world coordinates, in cells.
    """
    mask = flags.where(" or ".join(least)).select("scene_id", "row", "col", *least)
    if isinstance(georef, DataFrame):
        grid = georef.select("scene_id", F.abs(F.col("georef")[5]).alias("tall"), F.abs(F.col("georef")[1]).alias("wide"), ((F.col("georef")[2] != 0) | (F.col("georef")[4] != 0)).alias("_askew"))
        sizes = grid.agg(F.min(F.least("tall", "wide")).alias("least"), F.bool_or("_askew").alias("askew")).first()
        pixel, askew = sizes.least, sizes.askew
        v = vertices.join(grid.drop("_askew"), "scene_id")
    else:
        pixel, askew = min(abs(georef[1]), abs(georef[5])), georef[2] != 0 or georef[4] != 0
        v = vertices.withColumns({"tall": F.lit(abs(float(georef[5]))), "wide": F.lit(abs(float(georef[1])))})
    if pixel is None:
        return vertices.drop("row", "col")
    if askew:
        for which, dist in least.items():
            vertices = away_from_mask(vertices, masks.in_world(mask.where(which), georef, ["scene_id"]), dist, ["scene_id"])
        return vertices.drop("row", "col")
    v = v.withColumns({f"least_{k}": F.lit(float(d)) for k, d in least.items()})
    v = distance.away_from_pixels(v, mask, math.ceil(max(least.values()) / pixel))
    return v.select(*[c for c in vertices.columns if c not in ("row", "col")])


def split_gaps(vertices: DataFrame, by: list[str]) -> DataFrame:
    """Adds piece: a new one begins wherever a vertex in between was dropped."""
    w = Window.partitionBy(*by).orderBy("seq")
    jump = F.coalesce(F.col("seq") - F.lag("seq").over(w) > 1, F.lit(False)).cast("int")
    return vertices.withColumn("_j", jump).withColumn("piece", F.sum("_j").over(w)).drop("_j")
