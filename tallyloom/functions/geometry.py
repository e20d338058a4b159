"""Boxes, polygons and colours as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(x: Column, low: Column | float, high: Column | float) -> Column:
    """max(low, min(high, x)): low wins where it is above high."""
    return F.greatest(F.lit(low) if not isinstance(low, Column) else low, F.least(F.lit(high) if not isinstance(high, Column) else high, x))


def half_even(x: Column) -> Column:
    return F.bround(x, 0).cast("bigint")


def bin_of(x: Column, size: float) -> Column:
    return F.floor(x / F.lit(float(size))).cast("bigint")


def overlaps(x0: Column, y0: Column, x1: Column, y1: Column, rx0: Column, ry0: Column, rx1: Column, ry1: Column) -> Column:
    """Whether two boxes share area, edges left out; boxes with unknown bounds are kept."""
    return F.coalesce(~((x1 <= rx0) | (x0 >= rx1) | (y1 <= ry0) | (y0 >= ry1)), F.lit(True))


def contains(x: Column, y: Column, rx0: Column, ry0: Column, rx1: Column, ry1: Column) -> Column:
    """Whether a point lies in [rx0, rx1) x [ry0, ry1)."""
    return (x >= rx0) & (x < rx1) & (y >= ry0) & (y < ry1)


def box_features(x0: Column, y0: Column, x1: Column, y1: Column) -> dict[str, Column]:
    w, h = F.greatest(x1 - x0, F.lit(0.0)), F.greatest(y1 - y0, F.lit(0.0))
    area = w * h
    return {"w": w, "h": h, "area": area, "aspect": F.try_divide(w, F.when(h > 0, h)), "log_area": F.log1p(area)}


def ring_area(ring: Column) -> Column:
    """Half the absolute shoelace sum of a ring of structs x, y; 0 for fewer than three points."""
    n = F.size(ring)
    sums = F.aggregate(
        F.sequence(F.lit(0), n - 1), F.lit(0.0),
        lambda acc, i: acc + F.get(ring, i).x * F.get(ring, (i + 1) % n).y - F.get(ring, (i + 1) % n).x * F.get(ring, i).y,
    )
    return F.when(n >= 3, F.abs(sums) / 2).otherwise(0.0)


def ring_perimeter(ring: Column) -> Column:
    n = F.size(ring)
    total = F.aggregate(
        F.sequence(F.lit(0), n - 1), F.lit(0.0),
        lambda acc, i: acc + F.hypot(F.get(ring, (i + 1) % n).x - F.get(ring, i).x, F.get(ring, (i + 1) % n).y - F.get(ring, i).y),
    )
    return F.when(n >= 3, total).otherwise(0.0)


def polygon_features(rings: Column, mpp: float = 1.0) -> dict[str, Column]:
    """Area and perimeter over all rings in units, vertices, and compactness from pixels (null without a perimeter)."""
    area = F.aggregate(F.transform(rings, ring_area), F.lit(0.0), lambda a, b: a + b)
    perimeter = F.aggregate(F.transform(rings, ring_perimeter), F.lit(0.0), lambda a, b: a + b)
    vertices = F.aggregate(F.transform(rings, lambda r: F.when(F.size(r) >= 3, F.size(r)).otherwise(0)), F.lit(0), lambda a, b: a + b)
    return {"area": area * mpp * mpp, "perimeter": perimeter * mpp, "vertices": vertices, "compactness": F.try_divide(F.lit(4 * 3.141592653589793) * area, F.when(perimeter > 0, perimeter * perimeter))}


def translated(rings: Column, dx: Column, dy: Column) -> Column:
    return F.transform(rings, lambda r: F.transform(r, lambda p: F.struct((p.x + dx).alias("x"), (p.y + dy).alias("y"))))


def rgb_of_hex(color: Column) -> Column:
    """Three integers of a colour #RRGGBB; null if it is none."""
    ok = color.rlike("^#?[0-9A-Fa-f]{6}$")
    digits = F.regexp_replace(color, "^#", "")
    return F.when(ok, F.array(*[F.conv(F.substring(digits, i, 2), 16, 10).cast("int") for i in (1, 3, 5)]))


def stain_proxies(r: Column, g: Column, b: Column) -> dict[str, Column]:
    """Shades by which stains are told apart, from channels of 0 to 1."""
    gray = 0.299 * r + 0.587 * g + 0.114 * b
    most = F.greatest(r, g, b)
    return {"gray": gray, "saturation": (most - F.least(r, g, b)) / F.greatest(most, F.lit(1e-6)), "purple": (r + b) / 2 - g, "eosin": r - b, "darkness": 1 - gray}


def nearest_multiple(x: Column, divisor: int) -> Column:
    """The nearest multiple of divisor that is at least divisor; of two as near, the lower."""
    low = F.floor(x / divisor).cast("bigint") * divisor
    return F.greatest(F.lit(divisor).cast("bigint"), F.when(x - low <= low + divisor - x, low).otherwise(low + divisor))


def first_of(*columns: Column) -> Column:
    return reduce(lambda a, b: F.coalesce(a, b), columns)


def bounds(rings: Column) -> dict[str, Column]:
    """The box of a polygon's rings; null without points."""
    xs, ys = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p.x))), F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p.y)))
    return {"x0": F.array_min(xs), "y0": F.array_min(ys), "x1": F.array_max(xs), "y1": F.array_max(ys)}


def exteriors(polygons: Column) -> Column:
    """The exterior rings of an array of polygons (arrays of rings, the exterior first) with coordinates as floats; empty and null ones are left out."""
    first = F.transform(F.filter(polygons, lambda p: F.coalesce(F.size(p) > 0, F.lit(False))), lambda p: F.get(p, F.lit(0)))
    return F.transform(first, lambda r: F.transform(r, lambda p: F.struct(p.x.cast("float").alias("x"), p.y.cast("float").alias("y"))))


def coordinates_json(rings: Column) -> Column:
    """Rings as JSON [[[x, y], ...], ...]."""
    return F.to_json(F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p.x.cast("double"), p.y.cast("double")))))


def clipped(ring: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A convex or concave ring cut to a box, edge by edge; empty where nothing is left. The ring need not repeat its first point."""
    point = "struct<x:double,y:double>"

    def side(points: Column, axis: str, edge: Column, keep_above: bool) -> Column:
        n = F.size(points)
        inside = lambda p: (p[axis] >= edge) if keep_above else (p[axis] <= edge)

        def step(i: Column) -> Column:
            a, b = F.get(points, (i + n - 1) % n), F.get(points, i)
            share = (edge - a[axis]) / (b[axis] - a[axis])
            cut = F.struct((edge if axis == "x" else a.x + share * (b.x - a.x)).alias("x"), (edge if axis == "y" else a.y + share * (b.y - a.y)).alias("y")).cast(point)
            return F.array_compact(F.array(F.when(inside(a) != inside(b), cut), F.when(inside(b), F.struct(b.x.alias("x"), b.y.alias("y")).cast(point))))

        return F.when(n > 0, F.flatten(F.transform(F.sequence(F.lit(0), n - 1), step))).otherwise(F.array().cast(f"array<{point}>"))

    out = F.transform(ring, lambda p: F.struct(p.x.cast("double").alias("x"), p.y.cast("double").alias("y")))
    # each edge works on the result of the one before, bound to a name so that it is not computed anew for every use
    def bound(points: Column, axis: str, edge: Column, above: bool) -> Column:
        return F.get(F.transform(F.array(points), lambda p: side(p, axis, edge.cast("double"), above)), F.lit(0))

    for axis, edge, above in (("x", x0, True), ("x", x1, False), ("y", y0, True), ("y", y1, False)):
        out = bound(out, axis, edge, above)
    return out


def normalised(x: Column, edge: Column) -> Column:
    """A coordinate as a share of an edge of at least 1."""
    return x / F.greatest(edge, F.lit(1))


def level_mpp(source: Column, base: Column, level: Column) -> Column:
    """Micrometres a pixel of a level by its scale."""
    return source * base / level


def pixels_per_centimetre(mpp: Column) -> Column:
    return F.lit(10000.0) / mpp


def rational(number: Column, denominator: Column) -> Column:
    return F.try_divide(number.cast("double"), denominator.cast("double"))


def chosen_mpp(override: Column, embedded: Column) -> Column:
    """The override where it is valid, else the embedded one where that is, else null: never a target's."""
    from .text import valid_mpp

    return F.when(override.isNotNull(), F.when(valid_mpp(override), override)).otherwise(F.when(valid_mpp(embedded), embedded))
