"""Result files of slides and cases: which are there, which are valid, and what a case holds. Tables of paths in, tables out; no folder is walked here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as tx
from .ranking import ordered

#: Where a case's files are looked for, best place first.
ASSETS = {
    "overview_pdf": ["overlays/celltypes_overview_and_zoom.pdf", "overlays/celltype_overview.pdf", "overlays/celltypes_overview.pdf", "overlays/cell_type_overview.pdf"],
    "overview_png": ["overlays/celltypes_overview_and_zoom.png", "overlays/overview_with_zoom_box.png", "overlays/zoom_overlay_celltypes.png"],
    "roi_pdf": ["post_visualization/spatial_rois_report.pdf"],
    "embedding_pdf": ["post_visualization/cell_embedding_umap_report.pdf"],
    "counts_csv": ["cell_types/class_counts.csv"],
    "summary_json": ["summary/summary.json", "post_visualization/post_visualization_summary.json"],
    "run_metadata_json": ["summary/run_metadata.json"],
}
COORDINATES_CSV = ["cell_types/cell_type_coordinates.csv", "cell_types/cell_type_coordinates.csv.gz", "cell_type_coordinates.csv", "cell_type_coordinates.csv.gz"]
COORDINATES_NPY = ["cell_types/cell_type_coordinates.npy", "cell_type_coordinates.npy"]
SUMMARIES = ["summary/summary.json", "summary.json"]
#: Folders that are no cases, suffixes of pictures, and stems of pictures that are no spotlights' own.
NOT_CASES = ["pptx_reports", "per_case", "working", "summary", "cell_types", "overlays", "post_visualization", "qc_patches", "spatial_rois", "_render_cache_all_samples"]
PNG, NPY = b"\x89PNG\r\n\x1a\n", b"\x93NUMPY"


def first_of(path: Column, candidates: list[str]) -> Column:
    """For aggregation over a folder's files: the first of the candidates that is there, or null."""
    rank = F.array_position(F.array(*[F.lit(c) for c in candidates]), path)
    return F.min_by(F.when(rank > 0, path), F.when(rank > 0, rank))


def first_or_any(path: Column, candidates: list[str]) -> Column:
    """first_of(), or else the first file of the same name anywhere below, candidates' names in order."""
    names = list(dict.fromkeys(c.rsplit("/", 1)[-1] for c in candidates))
    name = F.array_position(F.array(*[F.lit(n) for n in names]), F.element_at(F.split(path, "/"), -1))
    rank = F.array_position(F.array(*[F.lit(c) for c in candidates]), path)
    place = F.when(rank > 0, F.struct(F.lit(0).alias("a"), rank.alias("b"), path.alias("c"))).when(name > 0, F.struct(F.lit(1).alias("a"), name.alias("b"), path.alias("c")))
    return F.min(place).c


def slide_folders(files: DataFrame, include: list[str] = (), exclude: list[str] = ()) -> DataFrame:
    """(slide, coordinates_csv, coordinates_npy, summary_json) of files (slide, path below it): slides with a coordinate table in its folder, by name patterns."""
    found = files.groupBy("slide").agg(
        F.max(F.col("path").isin(COORDINATES_CSV[:2])).alias("_is"), first_or_any(F.col("path"), COORDINATES_CSV).alias("coordinates_csv"),
        first_or_any(F.col("path"), COORDINATES_NPY).alias("coordinates_npy"), first_of(F.col("path"), SUMMARIES).alias("summary_json"),
    )
    return found.where("_is").where(tx.matches(F.col("slide"), list(include), list(exclude))).drop("_is")


def source_slide(summary: Column, there: Column) -> Column:
    """Of the paths that a summary's JSON text names, in order, the first that is among an array of files that are there."""
    s = F.from_json(summary, "processing_slide_path string, slide_path string, outputs struct<pyramidal_processing_slide:string>, pyramidal_conversion struct<processing_l0_path:string,source_l0_path:string>")
    named = F.array(s.processing_slide_path, s.slide_path, s.outputs.pyramidal_processing_slide, s.pyramidal_conversion.processing_l0_path, s.pyramidal_conversion.source_l0_path)
    return F.get(F.filter(named, lambda p: F.array_contains(there, p)), F.lit(0))


def cases(files: DataFrame, include: list[str] = (), exclude: list[str] = (), most: int = 0) -> DataFrame:
    """(case, ASSETS...) of files (case, path below it) in natural order: folders by name patterns that hold an overview, a report or counts; the first ``most``, 0 for all.

    case is a folder's path; hidden ones, those whose names begin with an underscore or name something else, and folders inside a case are left out.
    """
    name = F.element_at(F.split("case", "/"), -1)
    found = files.groupBy("case").agg(*[first_of(F.col("path"), c).alias(a) for a, c in ASSETS.items()])
    found = found.where(F.coalesce("overview_pdf", "overview_png", "roi_pdf", "embedding_pdf", "counts_csv").isNotNull())
    found = found.where(~name.rlike("^[._]") & ~name.isin(NOT_CASES)).where(tx.matches(name, list(include), list(exclude)))
    # every folder above a case, by its path: no case is compared with all others
    parts = F.split("case", "/")
    above = found.select("case", F.explode(F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))).otherwise(F.array())).alias("folder"))
    inner = above.join(found.select(F.col("case").alias("folder")), "folder").select("case").distinct()
    found = found.join(inner, "case", "left_anti")
    order = [tx.natural_key(name), F.col("case")]
    return found.orderBy(*order).limit(most) if most else found.orderBy(*order)


def availability(cases: DataFrame, counts: DataFrame) -> DataFrame:
    """(case, total, has_...): cells of each case, null without counts (case, n), and which of its files are there."""
    totals = counts.groupBy("case").agg(F.sum("n").alias("total"))
    return cases.join(totals, "case", "left").select("case", "total", *[F.col(a).isNotNull().alias(f"has_{a}") for a in ASSETS])


def pages_shown(pages: Column, most: int) -> Column:
    """Pages that are shown of so many: all for most 0, none where there are none."""
    pages = F.greatest(F.coalesce(pages, F.lit(0)), F.lit(0))
    return pages if most <= 0 else F.least(pages, F.lit(most))


def page_numbers(pages: Column, most: int) -> Column:
    """Indices of the pages that are shown."""
    n = pages_shown(pages, most)
    return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n.cast("bigint") - 1)).otherwise(F.array().cast("array<bigint>"))


def estimate(cases: DataFrame, most_roi: int = 0, most_embedding: int = 0, sections: bool = True, embedding: bool = True, per_slide: int = 2) -> DataFrame:
    """cases (asset columns, roi_pages, embedding_pages, spotlights) with the slides that each part takes and their total."""
    there = lambda *a: F.when(F.coalesce(*a).isNotNull(), 1).otherwise(0)
    parts = {
        "section": F.lit(int(sections)), "counts": there("counts_csv"), "overview": there("overview_pdf", "overview_png"), "roi": pages_shown(F.col("roi_pages"), most_roi),
        "embedding": pages_shown(F.col("embedding_pages"), most_embedding) if embedding else F.lit(0), "spotlight": F.ceil(F.col("spotlights") / max(1, per_slide)),
    }
    out = cases.select("case", *[c.cast("bigint").alias(f"n_{p}") for p, c in parts.items()])
    return out.withColumn("total", sum((F.col(f"n_{p}") for p in parts), F.lit(0)))


def spotlights(files: DataFrame, terms: list[str], suffixes: list[str], excluded_stems: list[str], broad: bool = False, most: int = 0) -> DataFrame:
    """(case, path, place) of files (case, path below it): pictures whose path holds one of the terms, in any spelling with hyphens, underscores or spaces; with broad also
    all of the regions' folder. In natural order, the first ``most`` of each case, 0 for all."""
    from pyspark.sql import Window as W

    name = F.element_at(F.split("path", "/"), -1)
    stem, suffix = F.lower(F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")), F.lower(F.regexp_extract(name, r"(?<=.)(\.[^.]*)$", 1))
    wanted = tx.search_terms(F.array(*[F.lit(t) for t in terms]))
    hit = F.exists(wanted, lambda t: F.contains(tx.search_text(F.col("path"), ""), t))
    if broad:
        folders = F.split(F.lower("path"), "/")
        hit = hit | (F.array_contains(folders, "post_visualization") & F.array_contains(folders, "spatial_rois"))
    found = files.where(suffix.isin(suffixes) & ~stem.isin(excluded_stems) & hit).select("case", "path").distinct()
    found = found.withColumn("place", F.row_number().over(W.partitionBy("case").orderBy(tx.natural_key(F.col("path")), "path")))
    return found.where(F.col("place") <= most) if most else found


def folders_with(files: DataFrame, extensions: list[str], path: str = "path") -> DataFrame:
    """(folder, has): whether a folder holds a file of one of the extensions itself."""
    folder = F.regexp_replace(F.when(F.contains(path, F.lit("/")), F.col(path)).otherwise(F.lit("")), "/[^/]*$", "")
    suffix = F.lower(F.regexp_extract(path, r"(?<=[^/])(\.[^./]*)$", 1))
    wanted = F.transform(F.array(*[F.lit(e) for e in extensions]), tx.extension)
    return files.groupBy(folder.alias("folder")).agg(F.max(F.array_contains(wanted, suffix)).alias("has"))


def only_manifest(names: DataFrame, candidates: list[str]) -> DataFrame:
    """(found, code): the one of the candidates that is among names (name); null and ambiguous where several are, null and none where no one is."""
    there = names.where(F.col("name").isin(candidates)).agg(F.array_sort(F.collect_set("name")).alias("n"))
    return there.select(F.when(F.size("n") == 1, F.get("n", F.lit(0))).alias("found"), F.when(F.size("n") > 1, "ambiguous").when(F.size("n") == 0, "none").alias("code"))


def file_checks(files: DataFrame, name: str = "path", content: str = "content", size: str = "length") -> DataFrame:
    """files with valid: not empty, and by suffix a header that is not blank (csv), JSON, or the first bytes of its kind (png, npy); content holds text files whole, of others the first bytes do."""
    text = F.decode(content, "UTF-8")
    low = F.lower(name)
    by_kind = F.when(low.endswith(".csv"), tx.csv_header(text)).when(low.endswith(".json"), tx.json_text(text)).when(low.endswith(".png"), tx.magic(F.col(content), PNG)).when(low.endswith(".npy"), tx.magic(F.col(content), NPY)).otherwise(True)
    return files.withColumn("valid", F.coalesce((F.col(size) > 0) & by_kind, F.lit(False)))


def nonempty_folders(files: DataFrame, folder: str = "folder", size: str = "length") -> DataFrame:
    return files.groupBy(folder).agg((F.max(size) > 0).alias("nonempty"))


def patch_reports(files: DataFrame, expected: DataFrame, artifacts: list[str]) -> DataFrame:
    """(slide, complete, lacking): whether each patch 1 to n of expected (slide, n) has every artifact of files (slide, patch, artifact, valid); lacking counts what it hasn't."""
    want = expected.select("slide", F.explode(F.when(F.col("n") > 0, F.sequence(F.lit(1), F.col("n").cast("int"))).otherwise(F.array(F.lit(None).cast("int")))).alias("patch"))
    # dealt out before they are grouped: no task that reads files holds all their keys
    found = files.where(F.col("valid") & F.col("artifact").isin(artifacts)).select("slide", "patch", "artifact").repartition("slide", "patch")
    each = found.groupBy("slide", "patch").agg(*[F.max(F.col("artifact") == a).cast("int").alias(f"_h{i}") for i, a in enumerate(artifacts)])
    have = each.select("slide", "patch", sum((F.col(f"_h{i}") for i in range(len(artifacts))), F.lit(0)).cast("bigint").alias("n"))
    both = want.join(have, ["slide", "patch"], "left")
    lacking = F.sum(F.lit(len(artifacts)) - F.coalesce("n", F.lit(0)))
    return both.groupBy("slide").agg(((F.count("patch") > 0) & (lacking == 0)).alias("complete"), F.when(F.count("patch") > 0, lacking).alias("lacking"))


def run_tally(rows: DataFrame, status: str = "status") -> DataFrame:
    """One row: rows, those that failed and those that did not; a missing status is no failure."""
    failed = F.coalesce(F.col(status), F.lit("ok")) == "failed"
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~failed).alias("ok"), F.count_if(failed).alias("failed"))


def first_rows(df: DataFrame, order: list[Column], most: int) -> DataFrame:
    """The first rows in an order, 0 for all, with their place from 1."""
    if most:
        return ordered(df.orderBy(*order).limit(most), order, "place", parts=1)
    return ordered(df, order, "place")


def first_name(df: DataFrame, key: str, order: list[Column], *columns: str) -> DataFrame:
    """One row a key: the columns of its first row in an order. Aggregated before it is shuffled."""
    return df.groupBy(key).agg(F.min_by(F.struct(*columns), F.struct(*order)).alias("_f")).select(key, *[F.col(f"_f.{c}").alias(c) for c in columns])


def signature(parameters: dict[str, Column]) -> Column:
    """An identity ``k=v;...`` in the order given; null as an empty value."""
    return F.concat_ws(";", *[F.concat(F.lit(f"{k}="), F.coalesce(v.cast("string"), F.lit(""))) for k, v in parameters.items()])


def companion_fingerprint(used: Column, exists: Column, digest: Column) -> Column:
    """JSON of a companion file: null where it isn't used, unavailable where it is missing, else its digest."""
    return F.when(~used, F.lit(None)).when(~exists, F.to_json(F.struct(F.lit(False).alias("available")))).otherwise(F.to_json(F.struct(F.lit(True).alias("available"), digest.alias("sha256"))))


def tree_lines(files: DataFrame, root: str, depth: int = 4, lines: int = 500, shown: int = 25) -> DataFrame:
    """(root, place, line): an indented listing of each root's files (root, relative_path), as a walk from the top meets them.

    A folder lists its folders, then its files, each by bytes of their names; then its folders are walked in that order. Names with a leading dot are left out, with all that lies
    below them. Folders more than ``depth`` deep are not walked, of a folder's files ``shown`` are listed and the others counted. The listing ends with a line that says so where more
    than ``lines`` would be needed; the root's own line is place 0. Folders are known from their files alone. Null paths are left out, repeated ones listed once; a null root is a root
    of its own, shown as an empty name. Rows are cut by rank before they meet, so a root or folder may hold any number of files.
    """
    parts = F.split("relative_path", "/")
    rows = files.where(F.col("relative_path").isNotNull()).select(F.col(root).alias("_root"), parts.alias("_p"))
    size = F.size("_p")
    visible = lambda a: ~F.exists(a, lambda c: c.startswith("."))
    upper = F.transform(F.sequence(F.lit(1), F.least(size - 1, F.lit(depth))), lambda n: F.slice("_p", 1, n))
    folders = rows.where((size > 1) & F.lit(depth > 0)).select("_root", F.explode(upper).alias("_f")).where(visible(F.col("_f"))).distinct()
    folders = folders.select("_root", F.slice("_f", 1, F.size("_f") - 1).alias("_in"), F.lit(0).alias("_kind"), F.element_at("_f", -1).alias("_name"))
    listed = rows.where((size <= depth + 1) & visible(F.col("_p"))).select("_root", F.slice("_p", 1, size - 1).alias("_in"), F.element_at("_p", -1).alias("_name")).distinct()
    ranked = listed.withColumn("_n", F.row_number().over(W.partitionBy("_root", "_in").orderBy("_name"))).where(F.col("_n") <= shown)
    more = listed.groupBy("_root", "_in").agg(F.count(F.lit(1)).alias("_all")).where(F.col("_all") > shown)
    more = more.select("_root", "_in", F.lit(2).alias("_kind"), F.concat(F.lit("... "), (F.col("_all") - shown).cast("string"), F.lit(" more file(s)")).alias("_name"))
    entries = folders.unionByName(ranked.select("_root", "_in", F.lit(1).alias("_kind"), "_name")).unionByName(more)
    place = F.row_number().over(W.partitionBy("_root").orderBy("_in", "_kind", "_name"))
    entries = entries.withColumn("place", place).where(F.col("place") <= lines + 1)
    cut = (F.col("place") >= lines) & (F.col("_kind") != 2)
    first = F.min(F.when(cut, F.col("place"))).over(W.partitionBy("_root"))  # at most lines + 1 rows a root
    entries = entries.withColumn("_cut", first).where(F.col("_cut").isNull() | (F.col("place") <= F.col("_cut")))
    mark = F.when(F.col("_kind") == 2, "└── ").otherwise("├── ")
    line = F.concat(F.repeat(F.lit("  "), F.size("_in")), mark, "_name", F.when(F.col("_kind") == 0, "/").otherwise(""))
    line = F.when(F.col("place") == F.col("_cut"), "  ... [truncated]").otherwise(line)
    head = files.select(F.col(root).alias("_root")).distinct().select("_root", F.lit(0).alias("place"), F.coalesce(F.col("_root").cast("string"), F.lit("")).alias("line"))
    return head.unionByName(entries.select("_root", "place", line.alias("line"))).withColumnRenamed("_root", root)
