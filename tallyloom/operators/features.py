"""Feature columns: standard scores, one-hot classes, compositions and principal components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from .ranking import quantiles


def zscores(long: DataFrame, feature: str = "j", value: str = "v", flat: float = 1e-8) -> DataFrame:
    """long with z: value less the feature's mean by its population deviation (1 where that is at most flat); null, NaN and infinite values are 0."""
    x = F.col(value).cast("double")
    clean = long.withColumn("_x", F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x))
    moments = clean.groupBy(feature).agg(F.avg("_x").alias("_m"), F.stddev_pop("_x").alias("_s"))
    scaled = (F.col("_x") - F.col("_m")) / F.when(F.col("_s") <= flat, 1.0).otherwise(F.col("_s"))
    return clean.join(moments, feature).withColumn("z", scaled).drop("_x", "_m", "_s")


def one_hot(df: DataFrame, column: str, values: list, prefix: str = "class_") -> DataFrame:
    """df with a 0/1 column for each of the values."""
    return df.withColumns({f"{prefix}{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in values})


def clr(long: DataFrame, by: str = "sample_id", value: str = "fraction", pseudocount: float = 1e-6) -> DataFrame:
    """long, one row for each class of each sample, with clr: log(value + pseudocount) less the sample's mean of it; 0 for samples of zeros."""
    if pseudocount <= 0:
        raise ValueError("pseudocount must be positive")
    logged = long.withColumn("_l", F.log(F.col(value) + F.lit(pseudocount)))
    means = logged.groupBy(by).agg(F.avg("_l").alias("_m"), F.max(F.abs(value)).alias("_top"))
    return logged.join(means, by).withColumn("clr", F.when(F.col("_top") == 0, 0.0).otherwise(F.col("_l") - F.col("_m"))).drop("_l", "_m", "_top")


def log_counts(long: DataFrame, by: str = "sample_id", value: str = "n") -> DataFrame:
    """long with v = log1p of the count, and zero = 1 where the whole sample has none."""
    totals = long.groupBy(by).agg(F.sum(value).alias("_t"))
    return long.join(totals, by).withColumn("v", F.log1p(F.col(value).cast("double"))).withColumn("zero", (F.col("_t") == 0).cast("int")).drop("_t")


def standardised(df: DataFrame, key: str, names: list[str], flat: float = 1e-8) -> DataFrame:
    """(key, vector array<double>): standard scores of the columns in that order, by the rules of zscores(); one pass for all moments, which are one row."""
    x = {n: F.col(f"`{n}`").cast("double") for n in names}
    clean = df.select(key, *[F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), F.lit(0.0)).otherwise(c).alias(f"_x{i}") for i, c in enumerate(x.values())])
    moments = clean.agg(*[F.avg(f"_x{i}").alias(f"_m{i}") for i in range(len(names))], *[F.stddev_pop(f"_x{i}").alias(f"_s{i}") for i in range(len(names))])
    z = [(F.col(f"_x{i}") - F.col(f"_m{i}")) / F.when(F.col(f"_s{i}") <= flat, 1.0).otherwise(F.col(f"_s{i}")) for i in range(len(names))]
    return clean.crossJoin(F.broadcast(moments)).select(key, F.array(*z).alias("vector"))


def cell_features(cells: DataFrame, width: int, height: int, mpp: float, rgb: tuple[str, str, str] | None = None, rings: str | None = None) -> tuple[DataFrame, list[str]]:
    """cells with the columns that an embedding takes, and their names in order: place, box, colour, polygon, and a 0/1 column for each class name that occurs.

    cells has class_name, x, y, bbox_x0 to bbox_y1; rgb names columns of 0 to 255, rings one of arrays of points x, y. Lengths are in units of mpp, log_area is of pixels. A cell without a
    polygon gets the median of those that have one, 0 if none has; a cell without a class is of none. Runs a job for the class names, of which there are few.
    """
    box = geo.box_features(*[F.col(f"bbox_{c}").cast("double") for c in ("x0", "y0", "x1", "y1")])
    made = {
        "x_norm": F.col("x").cast("double") / max(width, 1), "y_norm": F.col("y").cast("double") / max(height, 1), "bbox_w_um": box["w"] * mpp, "bbox_h_um": box["h"] * mpp,
        "bbox_area_um2": box["area"] * mpp * mpp, "log_area": box["log_area"], "aspect": box["aspect"],
    }
    if rgb:
        r, g, b = (F.col(c).cast("double") for c in rgb)
        made |= {"he_r": r, "he_g": g, "he_b": b} | {f"he_{n}": c for n, c in geo.stain_proxies(r / 255.0, g / 255.0, b / 255.0).items()}
    shape = {}
    if rings:
        shape = {f"poly_{n}{u}": F.when(F.size(rings) > 0, p) for (n, p), u in zip(geo.polygon_features(F.col(rings), mpp).items(), ("_um2", "_um", "", ""))}
    out = cells.withColumns(made | shape)
    if shape:
        out = median_filled(out, list(shape)).fillna(0.0, list(shape))
    classes = sorted(r[0] for r in cells.where(F.col("class_name").isNotNull()).select("class_name").distinct().collect())
    return one_hot(out, "class_name", classes), [*made, *shape, *[f"class_{c}" for c in classes]]


def median_filled(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with nulls of the columns replaced by the column's median; a column without any value stays null. Runs two jobs for all columns together."""
    if not columns:
        return df
    long = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("_i"), F.col(c).cast("double").alias("_x")) for i, c in enumerate(columns)])))
    medians = {r[0]: r[1] for r in quantiles(long, "_x", [0.5], ("_i",), name="_m").select("_i", F.col("_m")[0]).collect()}  # one number a column
    return df.withColumns({c: F.coalesce(c, F.lit(medians[i])) for i, c in enumerate(columns) if i in medians})


def principal_components(df: DataFrame, key: str, vector: str, k: int = 2) -> DataFrame:
    """(key, components array<double>) of the centred vectors (array column). Signs are arbitrary. Runs jobs."""
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    data = df.select(key, array_to_vector(F.col(vector).cast("array<double>")).alias("_v"))
    centred = StandardScaler(inputCol="_v", outputCol="_c", withMean=True, withStd=False).fit(data).transform(data)
    model = PCA(k=k, inputCol="_c", outputCol="_p").fit(centred)
    return model.transform(centred).select(key, vector_to_array("_p").alias("components"))


def marker_sizes(df: DataFrame, base: float, area: str = "area") -> DataFrame:
    """df with size: base by the root of area over its median, between 0.35 and 3.2 times base."""
    root = F.sqrt(F.greatest(F.col(area), F.lit(0.0)))
    median = quantiles(df.select(root.alias("_r")), "_r", [0.5]).select(F.col("quantiles")[0].alias("_m"))
    size = F.lit(base) * F.try_divide(root, F.when(F.col("_m") > 0, F.col("_m")))
    return df.crossJoin(F.broadcast(median)).withColumn("size", F.greatest(F.lit(0.35 * base), F.least(F.lit(3.2 * base), F.coalesce(size, F.lit(base))))).drop("_m")


def centres(df: DataFrame, by: str, columns: list[str]) -> DataFrame:
    """(by, n, for each column its median, c10 and c90): centre and spread of each class by exact quantiles."""
    out = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    for c in columns:
        q = quantiles(df, c, [0.1, 0.5, 0.9], (by,), parts=1).select(by, F.col("quantiles")[1].alias(c), F.col("quantiles")[0].alias(f"{c}10"), F.col("quantiles")[2].alias(f"{c}90"))
        out = out.join(q, by, "left")
    return out


def clip_range(df: DataFrame, value: str, low: float = 0.02, high: float = 0.98) -> DataFrame:
    """(low, high): exact quantiles between which a feature is shown."""
    q = quantiles(df, value, [low, high])
    return q.select(F.col("quantiles")[0].alias("low"), F.col("quantiles")[1].alias("high"))
