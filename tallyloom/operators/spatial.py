"""Grids, regions and boxes over tables of points."""

from __future__ import annotations


import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.geometry import bin_of, clamp, contains, half_even, overlaps, translated


def rarity(cells: DataFrame, by: str | None = None) -> DataFrame:
    """(class_id, rarity) by slide: sqrt(all / of the class), divided by the greatest of them and 1, as float."""
    keys = [by] if by else []
    n = cells.groupBy(*keys, "class_id").agg(F.count(F.lit(1)).alias("n"))
    total = W.partitionBy(*keys)
    raw = F.sqrt(F.sum("n").over(total) / F.greatest("n", F.lit(1)))
    n = n.withColumn("raw", raw).withColumn("rarity", (F.col("raw") / F.greatest(F.lit(1.0), F.max("raw").over(total))).cast("float"))
    return n.select(*keys, "class_id", "rarity")


def density_grid(cells: DataFrame, size: float, by: str = "slide_id", diversity: float = 0.20, rare: float = 0.35) -> DataFrame:
    """Per bin: cells, exact medians, classes, sum of rarity, and score n * (1 + diversity * classes) + rare * rarity."""
    weighted = cells.join(rarity(cells, by), [by, "class_id"])
    grid = weighted.groupBy(by, bin_of(F.col("x"), size).alias("gx"), bin_of(F.col("y"), size).alias("gy")).agg(
        F.count(F.lit(1)).alias("n"), F.median("x").alias("medx"), F.median("y").alias("medy"), F.countDistinct("class_id").alias("n_classes"), F.sum(F.col("rarity").cast("double")).alias("rare_sum")
    )
    return grid.withColumn("score", F.col("n") * (1 + diversity * F.col("n_classes")) + rare * F.col("rare_sum"))


def zoom_box(cells: DataFrame, width: int, height: int, zoom: int, by: str = "slide_id") -> DataFrame:
    """Per slide a box of zoom pixels around the medians of the fullest bin (ties: smallest gx, then gy), inside the slide."""
    bins = cells.groupBy(by, bin_of(F.col("x"), zoom).alias("gx"), bin_of(F.col("y"), zoom).alias("gy")).agg(F.count(F.lit(1)).alias("n"), F.median("x").alias("mx"), F.median("y").alias("my"))
    best = bins.groupBy(by).agg(F.min_by(F.struct("mx", "my"), F.struct((-F.col("n")).alias("n"), "gx", "gy")).alias("m"))
    for axis, edge in (("x", width), ("y", height)):
        low = clamp(half_even(F.col(f"m.m{axis}")) - zoom // 2, F.lit(0), F.lit(edge - zoom)).cast("bigint")
        high = F.least(F.lit(edge), low + zoom).cast("bigint")
        best = best.withColumn(f"{axis}0", F.when(high - low < zoom, F.greatest(F.lit(0), high - zoom)).otherwise(low).cast("bigint")).withColumn(f"{axis}1", high)
    return best.select(by, "x0", "y0", "x1", "y1")


def greedy_boxes(ranked: DataFrame, size: int, most: int, distance: float, width: int, height: int, by: str = "slide_id", relaxed: bool = False) -> DataFrame:
    """(by, rank, x0, y0, x1, y1): boxes of size around the centres cx, cy of ranked (by, place, cx, cy), taken in the order of place.

    A centre nearer than distance to one that was taken is passed over; taking stops at most boxes. relaxed: what is short after all places
    is filled up from the first place on, whatever the distance, with boxes that are not there yet. Slides have few bins, so a
    slide's ranked bins are one group.
    """

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        boxes, centres, slide = [], [], pdf[by].iloc[0]

        def box(cx: float, cy: float) -> tuple[int, int, int, int]:
            x0, y0 = max(0, min(width - size, round(cx - size / 2))), max(0, min(height - size, round(cy - size / 2)))
            return x0, y0, min(width, x0 + size), min(height, y0 + size)

        for cx, cy in zip(pdf.cx, pdf.cy):
            if len(boxes) < most and all((cx - a) ** 2 + (cy - b) ** 2 >= distance**2 for a, b in centres):
                centres.append((cx, cy))
                boxes.append(box(cx, cy))
        for cx, cy in zip(pdf.cx, pdf.cy) if relaxed else ():
            if len(boxes) < most and box(cx, cy) not in boxes:
                boxes.append(box(cx, cy))
        return pd.DataFrame([(slide, i, *b) for i, b in enumerate(boxes, 1)], columns=[by, "rank", "x0", "y0", "x1", "y1"])

    kind = ranked.schema[by].dataType.simpleString()
    return ranked.select(by, "place", "cx", "cy").groupBy(by).applyInPandas(choose, f"{by} {kind}, rank int, x0 bigint, y0 bigint, x1 bigint, y1 bigint")


def qc_patches(cells: DataFrame, size: int, most: int, factor: float, width: int, height: int, by: str = "slide_id") -> DataFrame:
    """The fullest bins of each slide as patches, centres at least size * factor apart; ties by gx, then gy."""
    bins = cells.groupBy(by, bin_of(F.col("x"), size).alias("gx"), bin_of(F.col("y"), size).alias("gy")).agg(F.count(F.lit(1)).alias("n"), F.median("x").alias("cx"), F.median("y").alias("cy"))
    ranked = bins.withColumn("place", F.row_number().over(W.partitionBy(by).orderBy(F.desc("n"), "gx", "gy")))
    return greedy_boxes(ranked, size, most, size * factor, width, height, by)


def rois(cells: DataFrame, size: int, most: int, width: int, height: int, by: str = "slide_id", factor: float = 0.85) -> DataFrame:
    """Regions of the highest score, at least size * factor apart, then filled up without that distance."""
    grid = density_grid(cells, size, by)
    ranked = grid.withColumn("place", F.row_number().over(W.partitionBy(by).orderBy(F.desc(F.round("score", 9)), "gx", "gy"))).select(by, "place", F.col("medx").alias("cx"), F.col("medy").alias("cy"))
    return greedy_boxes(ranked, size, most, size * factor, width, height, by, relaxed=True)


def _bins(boxes: DataFrame, size: float, reach: float = 0.0) -> DataFrame:
    """boxes with a row for each bin that they touch, so that points find them by an equal bin."""
    spans = {axis: F.sequence(bin_of(F.col(f"{axis}0") - reach, size), bin_of(F.col(f"{axis}1") + reach, size)) for axis in "xy"}
    return boxes.withColumn("_bx", F.explode(spans["x"])).withColumn("_by", F.explode(spans["y"]))


def contained(cells: DataFrame, boxes: DataFrame, size: float, by: str | None = "slide_id") -> DataFrame:
    """cells joined with every box (x0, y0, x1, y1, other columns) that contains their point, by bins of about the boxes' size."""
    keys = [by] if by else []
    b = _bins(boxes, size).withColumnsRenamed({c: f"_{c}" for c in ("x0", "y0", "x1", "y1")})
    points = cells.withColumn("_bx", bin_of(F.col("x"), size)).withColumn("_by", bin_of(F.col("y"), size))
    hit = points.join(b, [*keys, "_bx", "_by"]).where(contains(F.col("x"), F.col("y"), F.col("_x0"), F.col("_y0"), F.col("_x1"), F.col("_y1")))
    return hit.drop("_bx", "_by")


def overlapping(cells: DataFrame, boxes: DataFrame, size: float, reach: float, by: str = "slide_id") -> DataFrame:
    """cells (x, y, bbox_x0 to bbox_y1, none of which reaches further than reach from the point) joined with every box that they share area with."""
    b = _bins(boxes, size, reach).withColumnsRenamed({c: f"_{c}" for c in ("x0", "y0", "x1", "y1")})
    points = cells.withColumn("_bx", bin_of(F.col("x"), size)).withColumn("_by", bin_of(F.col("y"), size))
    test = overlaps(*[F.col(f"bbox_{c}") for c in ("x0", "y0", "x1", "y1")], *[F.col(f"_{c}") for c in ("x0", "y0", "x1", "y1")])
    return points.join(b, [by, "_bx", "_by"]).where(test).drop("_bx", "_by")


def patch_remap(cells: DataFrame, patches: DataFrame, size: float) -> DataFrame:
    """cells with patch_id and x, y moved from the mosaic to the source; of several patches the lowest id counts, without one it is -1 and x, y null.

    patches: patch_id, mosaic_x0, mosaic_y0, source_x0, source_y0, width, height. rings, if cells have them, move along; boxes stay.
    """
    boxes = patches.select(
        "patch_id", (F.col("source_x0") - F.col("mosaic_x0")).alias("dx"), (F.col("source_y0") - F.col("mosaic_y0")).alias("dy"),
        F.col("mosaic_x0").alias("x0"), F.col("mosaic_y0").alias("y0"), (F.col("mosaic_x0") + F.col("width")).alias("x1"), (F.col("mosaic_y0") + F.col("height")).alias("y1"),
    )
    # a row for each bin with its patches by id: cells are joined once, and never grouped
    held = F.struct("patch_id", "dx", "dy", "x0", "y0", "x1", "y1")
    binned = _bins(boxes, size).groupBy("_bx", "_by").agg(F.sort_array(F.collect_list(held)).alias("_patches"))
    out = cells.withColumn("_bx", bin_of(F.col("x"), size)).withColumn("_by", bin_of(F.col("y"), size)).join(binned, ["_bx", "_by"], "left")
    hit = F.filter("_patches", lambda b: contains(F.col("x"), F.col("y"), b.x0, b.y0, b.x1, b.y1))
    out = out.withColumn("_p", F.get(hit, 0)).drop("_bx", "_by", "_patches").withColumn("patch_id", F.coalesce("_p.patch_id", F.lit(-1)))
    out = out.withColumn("x", F.col("x") + F.col("_p.dx")).withColumn("y", F.col("y") + F.col("_p.dy"))
    if "rings" in cells.columns:
        out = out.withColumn("rings", F.when(F.col("_p").isNotNull(), translated(F.col("rings"), F.col("_p.dx"), F.col("_p.dy"))).otherwise(F.col("rings")))
    return out.drop("_p")


def grid_thinned(cells: DataFrame, size: float, digest: str, by: str = "slide_id", key: str = "cell_id") -> DataFrame:
    """One cell for each class and bin: the one with the smallest digest, then key."""
    first = F.row_number().over(W.partitionBy(by, "class_id", bin_of(F.col("x"), size), bin_of(F.col("y"), size)).orderBy(digest, key))
    return cells.withColumn("_n", first).where("_n = 1").drop("_n")


def roi_report(cells: DataFrame, size: int, most: int, width: int, height: int, by: str = "slide_id") -> tuple[DataFrame, DataFrame]:
    """Regions, and their cells by class."""
    boxes = rois(cells, size, most, width, height, by)
    inside = contained(cells, boxes, size, by)
    return boxes, inside.groupBy(by, "rank", "class_id").agg(F.count(F.lit(1)).alias("n"))


def dense_tiles(tiles: DataFrame, key: str) -> DataFrame:
    """Every (row, column) of each key's grid in order, filled or not: tiles (key, row, column), with row and column from 0 to the greatest there are."""
    extents = tiles.groupBy(key).agg(F.max("row").alias("_r"), F.max("column").alias("_c"))
    grid = extents.select(key, F.explode(F.sequence(F.lit(0), "_r")).alias("row"), "_c").select(key, "row", F.explode(F.sequence(F.lit(0), "_c")).alias("column"))
    have = tiles.select(key, "row", "column").distinct().withColumn("filled", F.lit(True))
    return grid.join(have, [key, "row", "column"], "left").withColumn("filled", F.coalesce("filled", F.lit(False)))




def thinned(cells: DataFrame, most: int, distance: float, x0: float, y0: float, seed: int = 0, least: int = 25, by: str = "slide_id") -> DataFrame:
    """At most about ``most`` cells of a region: all if they are no more; else a stratified draw of three times as many, one for each class and bin of
    ``distance`` pixels, and a second stratified draw if that is still too many. Rare classes lose least. Runs jobs for counts."""
    from . import sampling

    if cells.count() <= most:
        return cells
    drawn = sampling.stratified_sample(cells, "cell_id", "class_id", 3 * most, seed, least)
    if distance > 0 and drawn.count() > most:
        moved = drawn.withColumn("_dx", F.floor((F.col("x") - x0) / distance)).withColumn("_dy", F.floor((F.col("y") - y0) / distance))
        first = F.row_number().over(W.partitionBy(by, "class_id", "_dx", "_dy").orderBy(F.md5(F.concat_ws("|", "cell_id", F.lit(str(seed)))), "cell_id"))
        drawn = moved.withColumn("_n", first).where("_n = 1").drop("_n", "_dx", "_dy")
    return sampling.stratified_sample(drawn, "cell_id", "class_id", most, seed + 13, least)


def patch_selection(candidates: DataFrame, percent: float, seed: int, grid: int | None = None, most: int = 0, by: str = "slide_id") -> DataFrame:
    """Patches drawn of candidates (by, x0, y0): percent of them (grid * grid with a grid), at most ``most`` (0: any number), placed in a mosaic row by row.

    patch_id counts the draws from 1; mosaic_row and mosaic_column follow from it and the mosaic's columns, ceil(sqrt(n)) without a grid.
    """
    from ..functions.hashing import rank_hash
    from .ranking import hash_ranked
    from .sampling import kept_of, mosaic_place

    ranked = hash_ranked(candidates, rank_hash(F.col(by), F.col("x0"), F.col("y0"), seed=seed), "x0", "y0", by=(by,), name="patch_id")
    sizes = candidates.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    n = F.least(F.col("_n"), F.lit(grid * grid)) if grid else kept_of(F.col("_n"), percent)
    n = F.least(n, F.lit(most)) if most and not grid else n
    sizes = sizes.select(by, n.alias("_k"), (F.lit(grid) if grid else F.ceil(F.sqrt(n))).cast("bigint").alias("_columns"))
    kept = ranked.join(sizes, by).where("patch_id <= _k")
    return kept.withColumns(mosaic_place(F.col("patch_id"), F.col("_columns"))).drop("_k", "_columns")


def slide_size(header: tuple[str, str], summary: tuple[str, str], cells: DataFrame, slides: DataFrame, by: str = "slide_id") -> DataFrame:
    """(by, width, height) from a slide's header columns, else its summary's, else its cells' greatest coordinates and 1000 more, rounded up."""
    reach = cells.groupBy(by).agg(F.ceil(F.max("x") + 1000).alias("_x"), F.ceil(F.max("y") + 1000).alias("_y"))
    return slides.join(reach, by, "left").select(by, F.coalesce(header[0], summary[0], "_x").cast("bigint").alias("width"), F.coalesce(header[1], summary[1], "_y").cast("bigint").alias("height"))
