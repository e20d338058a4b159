import random

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import spatial

CELLS = "slide_id string, cell_id string, class_id int, x double, y double"


@pytest.fixture(scope="module")
def points():
    r = random.Random(3)
    return [(f"s{i % 2}", f"c{i}", r.randrange(4), r.uniform(0, 1000), r.uniform(0, 600)) for i in range(400)]


def test_contained_is_half_open_and_like_brute_force(spark, points):
    boxes = [("s0", i, float(i * 97 % 900), float(i * 61 % 500), float(i * 97 % 900 + 120), float(i * 61 % 500 + 80)) for i in range(9)]
    edge = [("s0", "edge", 0, boxes[0][2], boxes[0][3]), ("s0", "out", 0, boxes[0][4], boxes[0][5])]
    got = spatial.contained(spark.createDataFrame(points + edge, CELLS), spark.createDataFrame(boxes, "slide_id string, roi int, x0 double, y0 double, x1 double, y1 double"), 100)
    want = {(c[1], b[1]) for c in points + edge for b in boxes if c[0] == b[0] and b[2] <= c[3] < b[4] and b[3] <= c[4] < b[5]}
    assert {(r.cell_id, r.roi) for r in got.collect()} == want and ("edge", 0) in want


def test_first_patch_wins_and_others_are_unmatched(spark):
    cells = spark.createDataFrame([("a", 5.0, 5.0), ("b", 15.0, 5.0), ("c", 99.0, 5.0)], "cell_id string, x double, y double")
    patches = spark.createDataFrame([(2, 0, 0, 100, 0, 20, 10), (1, 0, 0, 200, 7, 10, 10)], "patch_id int, mosaic_x0 int, mosaic_y0 int, source_x0 int, source_y0 int, width int, height int")
    got = {r.cell_id: (r.patch_id, r.x, r.y) for r in spatial.patch_remap(cells, patches, 10).collect()}
    assert got == {"a": (1, 205.0, 12.0), "b": (2, 115.0, 5.0), "c": (-1, None, None)}


def test_zoom_box_stays_inside(spark):
    cells = spark.createDataFrame([("s", str(i), 0, 990.0, 590.0) for i in range(5)] + [("s", "far", 0, 10.0, 10.0)], CELLS)
    assert tuple(spatial.zoom_box(cells, 1000, 600, 100).first()) == ("s", 900, 500, 1000, 600)
    assert tuple(spatial.zoom_box(cells, 80, 60, 100).first()) == ("s", 0, 0, 80, 60)


def greedy(bins, size, most, far, w, h, relaxed):
    boxes, centres = [], []
    clip = lambda c, edge: max(0, min(edge - size, round(c - size / 2)))
    made = [(clip(x, w), clip(y, h)) for x, y in bins]
    for (x, y), b in zip(bins, made):
        if len(boxes) < most and all((x - a) ** 2 + (y - c) ** 2 >= far * far for a, c in centres):
            boxes.append(b)
            centres.append((x, y))
    for b in made if relaxed else []:
        if len(boxes) < most and b not in boxes:
            boxes.append(b)
    return boxes


@pytest.mark.parametrize("relaxed", [False, True])
def test_greedy_boxes(spark, relaxed):
    r = random.Random(5)
    bins = [(r.uniform(0, 500), r.uniform(0, 400)) for _ in range(40)]
    ranked = spark.createDataFrame([("s", i, x, y) for i, (x, y) in enumerate(bins)], "slide_id string, place int, cx double, cy double")
    got = spatial.greedy_boxes(ranked, 60, 12, 150, 500, 400, relaxed=relaxed).orderBy("rank").collect()
    assert [(g.x0, g.y0) for g in got] == greedy(bins, 60, 12, 150, 500, 400, relaxed)


def test_thinning_keeps_one_a_bin(spark, points):
    cells = spark.createDataFrame(points, CELLS).withColumn("d", F.md5("cell_id"))
    got = spatial.grid_thinned(cells, 100, "d").collect()
    keys = [(r.slide_id, r.class_id, r.x // 100, r.y // 100) for r in got]
    assert len(keys) == len(set(keys)) == len({(s, c, x // 100, y // 100) for s, _, c, x, y in points})


def test_empty_cells(spark):
    none = spark.createDataFrame([], CELLS)
    assert spatial.density_grid(none, 10).count() == spatial.zoom_box(none, 10, 10, 5).count() == spatial.qc_patches(none, 10, 3, 1, 10, 10).count() == 0


def test_dense_tiles(spark):
    t = spark.createDataFrame([("k", 0, 0), ("k", 1, 2)], "key string, row int, column int")
    got = spatial.dense_tiles(t, "key").collect()
    assert len(got) == 6 and sum(r.filled for r in got) == 2
