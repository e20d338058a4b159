"""Names, ids, booleans and patterns as Column expressions."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What counts as true and false in each dialect of text booleans; any other text is null.
BOOLEANS = {
    "cohort": (["true", "1", "yes", "y"], ["false", "0", "no", "n"]),
    "clinical": (["true", "1", "yes", "y", "si", "sí"], ["false", "0", "no", "n"]),
    "strict": (["true"], ["false"]),
    "truthy": (["1", "true", "yes"], None),
}

#: The cell classes by id, and their colours.
CLASS_NAMES = [
    "Background", "Cancer cell", "Lymphocytes", "Fibroblasts", "Plasmocytes", "Eosinophils", "Neutrophils", "Macrophages",
    "Muscle Cell", "Endothelial Cell", "Red blood cell", "Epithelial", "Apoptotic Body", "Mitotic Figures", "Minor Stromal Cell",
]
CLASS_COLORS = [
    "#000000", "#005AB5", "#228B22", "#F97306", "#7B2CBF", "#FFD23F", "#00A6D6", "#D7263D",
    "#8B5E34", "#B5BD00", "#6E1E0E", "#3A0CA3", "#595959", "#F72585", "#00C49A",
]
#: Other spellings of class names, compared without anything but a-z and 0-9 (compact) or with single spaces between words (spaced).
COMPACT_ALIASES = {
    "cancercells": 1, "lymphocyte": 2, "fibroblast": 3, "plasmocyte": 4, "eosinophil": 5, "neutrophil": 6, "macrophage": 7,
    "musclecells": 8, "endothelialcells": 9, "redbloodcells": 10, "erythrocyte": 10, "erythrocytes": 10, "epithelialcell": 11,
    "epithelialcells": 11, "apoptoticbodies": 12, "mitoticfigure": 13, "minorstromalcells": 14,
}
SPACED_ALIASES = {
    "cancer cells": 1, "lymphocyte": 2, "fibroblast": 3, "plasmocyte": 4, "plasma cell": 4, "plasma cells": 4, "eosinophil": 5,
    "neutrophil": 6, "macrophage": 7, "muscle cells": 8, "smooth muscle cell": 8, "smooth muscle cells": 8, "endothelial cells": 9,
    "red blood cells": 10, "rbc": 10, "epithelial cell": 11, "epithelial cells": 11, "apoptotic bodies": 12, "mitotic figure": 13,
    "mitosis": 13, "mitoses": 13, "minor stromal cells": 14,
}
#: Sex labels in English and Spanish.
SEXES = {"f": "female", "female": "female", "femenino": "female", "mujer": "female", "m": "male", "male": "male", "masculino": "male", "hombre": "male"}

#: Letters up to Latin Extended Additional with the letter that is left when their marks go.
_marked = {chr(c): unicodedata.normalize("NFKD", chr(c))[0] for c in range(0xC0, 0x1F00) if unicodedata.combining(unicodedata.normalize("NFKD", chr(c))[-1])}
MARKED, PLAIN = "".join(_marked), "".join(_marked.values())


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def slug(x: Column, strip: str = "._-", collapse: bool = False, empty: str | None = None, longest: int | None = None) -> Column:
    """Anything but A-Z, a-z, 0-9, dot, underscore and hyphen becomes one underscore; ends are stripped of the characters in strip."""
    out = F.regexp_replace(x, "[^A-Za-z0-9._-]+", "_")
    if collapse:
        out = F.regexp_replace(out, "_+", "_")
    ends = re.escape(strip)
    out = F.regexp_replace(out, f"^[{ends}]+|[{ends}]+$", "")
    if empty is not None:
        out = F.when(out == "", F.lit(empty)).otherwise(out)
    return F.substring(out, 1, longest) if longest else out


def sample_id(relative_path: Column) -> Column:
    """Sample id of a slide file: folders and stem joined by underscores, without the level suffix, as a slug."""
    stem = F.regexp_replace(F.regexp_replace(relative_path, r"(?i)_L0_rgb\.tiff?$", ""), r"\.[^./]*$", "")
    return slug(F.translate(stem, "/", "_"))


def compact_name(x: Column) -> Column:
    return F.regexp_replace(F.lower(x), "[^a-z0-9]", "")


def spaced_name(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " "))


def class_id(x: Column) -> Column:
    """Class id of a name by its compact form; -1 for unknown and null."""
    known = {re.sub("[^a-z0-9]", "", n.lower()): i for i, n in enumerate(CLASS_NAMES)} | COMPACT_ALIASES
    return F.coalesce(_map(known)[compact_name(x)], F.lit(-1))


def class_name(x: Column) -> Column:
    """Canonical name by the spaced form; other names trimmed."""
    known = {re.sub("[^a-z0-9]+", " ", n.lower()): n for n in CLASS_NAMES[1:]} | {k: CLASS_NAMES[i] for k, i in SPACED_ALIASES.items()}
    return F.coalesce(_map(known)[spaced_name(x)], F.trim(x))


def name_of_class(x: Column) -> Column:
    """Name of a class id; ``Class n`` for others."""
    return F.coalesce(_map(dict(enumerate(CLASS_NAMES)))[x.cast("int")], F.concat(F.lit("Class "), x.cast("string")))


def color_of_class(x: Column, fallback: str = "#CCCCCC") -> Column:
    return F.coalesce(_map(dict(enumerate(CLASS_COLORS)))[x.cast("int")], F.lit(fallback))


def squeezed(x: Column) -> Column:
    """Trimmed, with one space for each run of white space."""
    return F.trim(F.regexp_replace(x, r"\s+", " "))


def label(x: Column) -> Column:
    return F.lower(squeezed(x))


def slide_key(x: Column) -> Column:
    """The key on which tables are linked: upper case, without image suffix and staining suffix, separators as one hyphen."""
    # fixed values: the suffixes of images and of their staining
    out = F.regexp_replace(F.upper(F.trim(x)), r"\.(TIF|TIFF|SVS)$", "")
    out = F.regexp_replace(out, r"(?:[ _-]+L0[ _-]*RGB)?[ _-]+HE[ _-]*1$", "")
    return F.regexp_replace(F.regexp_replace(out, r"[-_\s]+", "-"), "^-+|-+$", "")


def feature_slug(x: Column) -> Column:
    """A column name: marks of letters dropped, anything else an underscore, upper case; FEATURE where nothing is left."""
    out = F.upper(F.regexp_replace(F.regexp_replace(F.translate(x, MARKED, PLAIN), "[^A-Za-z0-9]+", "_"), "^_+|_+$", ""))
    return F.when(out == "", F.lit("FEATURE")).otherwise(out)


def parse_bool(x: Column, dialect: str = "cohort") -> Column:
    """True or false by the dialect, null for other text; the truthy dialect has no null."""
    yes, no = BOOLEANS[dialect]
    text = F.lower(F.trim(x))
    if no is None:
        return F.coalesce(text.isin(yes), F.lit(False))
    return F.when(text.isin(yes), True).when(text.isin(no), False)


def parse_int(x: Column) -> Column:
    """Integral number of a text, null for blank text, fractions and what is no finite number."""
    number = F.trim(x).try_cast("double")
    return F.when((F.floor(number) == number) & (F.abs(number) < 2.0**63), number.try_cast("bigint"))


def sex(x: Column) -> Column:
    cleaned = label(x)
    cleaned = F.when(~cleaned.isin("", "nan", "none"), cleaned)
    return F.coalesce(_map(SEXES)[cleaned], cleaned)


def glob(pattern: str) -> str:
    """A regular expression for a shell pattern with *, ?, [seq] and [!seq]."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        end = pattern.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif end > 0:
            body = pattern[i + 1 : end].replace("\\", "\\\\")
            out += f"[{'^' + body[1:] if body[0] == '!' else body}]"
            i = end
        else:
            out += re.sub(r"([^\w\s])", r"\\\1", c)
        i += 1
    return f"(?s)^{out}$"


def matches(x: Column, include: list[str], exclude: list[str] = ()) -> Column:
    """Whether a text matches any pattern of include (all if there is none) and none of exclude."""
    yes = F.lit(not include)
    for p in include:
        yes = yes | x.rlike(glob(p))
    for p in exclude:
        yes = yes & ~x.rlike(glob(p))
    return yes


def natural_key(x: Column) -> Column:
    """Sort key by which runs of digits count as numbers and come before text; letters compare in lower case."""
    parts = F.regexp_extract_all(x, F.lit(r"(\d+|\D+)"), 1)
    return F.transform(parts, lambda p: F.struct((~p.rlike(r"^\d")).alias("text"), p.try_cast("decimal(38,0)").alias("number"), F.when(p.rlike(r"^\D"), F.lower(p)).alias("word")))


def in_natural_order(df: DataFrame, column: str) -> DataFrame:
    """df by natural_key() of a column. The key is a column while rows are sorted: as an expression it is made anew at every comparison."""
    return df.withColumn("_natural", natural_key(F.col(column))).orderBy("_natural", column).drop("_natural")


def tile_position(x: Column) -> Column:
    """row and column of a tile name ``row_column``; null if it is no such name."""
    ok = x.rlike(r"^\d+_\d+$")
    part = F.split(x, "_")
    return F.when(ok, F.struct(part[0].try_cast("int").alias("row"), part[1].try_cast("int").alias("column")))


def md5_of(x: Column) -> Column:
    """A 32-digit hex digest, with or without ``md5:`` before it, in lower case; null otherwise."""
    found = F.regexp_extract(F.lower(F.trim(x)), r"^(?:md5:)?([0-9a-f]{32})$", 1)
    return F.when(found != "", found)


def relative(path: Column, root: str, missing: str = "") -> Column:
    """A path below root without it; other paths as they are, null as the text for missing."""
    prefix = root.rstrip("/") + "/"
    return F.coalesce(F.when(path.startswith(prefix), F.substring(path, len(prefix) + 1, 1 << 30)).otherwise(path), F.lit(missing))


def within(path: Column, root: str) -> Column:
    return (path == root.rstrip("/")) | path.startswith(root.rstrip("/") + "/")


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def https_origin(url: Column) -> Column:
    """Whether a URL is https, names a host, and has neither credentials nor query nor fragment."""
    return F.coalesce(url.rlike(r"^https://[^/?#@:]+(:\d+)?(/[^?#]*)?$"), F.lit(False))


def mentions(x: Column, markers: list[str], shortest: int = 1) -> Column:
    """The markers, in lower case and not shorter than shortest, that a text contains."""
    known = [m.lower() for m in markers if len(m) >= shortest]
    return F.filter(F.array(*[F.lit(m) for m in known]).cast("array<string>"), lambda m: F.contains(F.lower(x), m))


@F.pandas_udf(T.StringType())
def compatible(x: pd.Series) -> pd.Series:
    """A text in Unicode normal form NFKC: full-width letters, ligatures and the like as their plain forms. Spark has no function for it."""
    return x.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize("NFKC", v))


@F.pandas_udf(T.StringType())
def without_marks(x: pd.Series) -> pd.Series:
    """A text in normal form NFKD without combining marks."""
    return x.map(lambda v: v if v is None or v.isascii() else "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)))


def category(x: Column, name: str) -> Column:
    """A category cleaned: compatible form, single spaces, lower case; blank, nan and none are null; sex labels are mapped where the column is named for them."""
    plain = re.sub("[^A-Za-z0-9]+", "_", name).strip("_").upper()
    cleaned = label(compatible(x))
    cleaned = F.when(~cleaned.isin("", "nan", "none"), cleaned)
    return F.coalesce(_map(SEXES)[cleaned], cleaned) if plain in SEX_COLUMNS else cleaned


#: Names of columns that hold sex labels.
SEX_COLUMNS = ("SEXO", "SEX", "GENDER")


def positive_int(x: Column) -> Column:
    """Integral number above 0 of a text, else null."""
    n = parse_int(x)
    return F.when(n > 0, n)


def items(x: Column) -> Column:
    """The entries of a comma-separated text, trimmed, without blank ones; null has none."""
    return F.filter(F.transform(F.split(F.coalesce(x, F.lit("")), ","), lambda p: F.trim(p)), lambda p: p != "")


def square_grid(x: Column) -> Column:
    """n of a text n x n, n above 0; null for blank and other text."""
    text = F.lower(F.trim(x))
    rows, columns = (F.regexp_extract(text, r"^(\d+)\s*x\s*(\d+)$", i).try_cast("int") for i in (1, 2))
    return F.when((rows == columns) & (rows > 0), rows)


def container_id(path: Column, alias: str, generic: str = "1.mds") -> Column:
    """Sample id of a container file: its stem if that is an alias, its folder if the file has the generic name and the folder is one, else the stem as a slug."""
    name = F.element_at(F.split(path, "/"), -1)
    stem, folder = F.regexp_replace(name, r"(?<=.)\.[^.]*$", ""), F.coalesce(F.get(F.split(path, "/"), F.size(F.split(path, "/")) - 2), F.lit(""))
    return F.when(stem.rlike(alias), stem).when((F.lower(name) == generic) & folder.rlike(alias), folder).otherwise(slug(stem))


def record_number(x: Column, doi: str) -> Column:
    """The digits of a record id, of a DOI that ends in ``<doi>.<digits>``, or of a record's URL; null for other text."""
    text = F.regexp_replace(F.trim(x), "/+$", "")
    found = F.regexp_extract(text, rf"(?:{re.escape(doi)}[.]|/records?/)([0-9]+)(?:$|[/?#])", 1)
    return F.when(text.rlike("^[0-9]+$"), text).when(found != "", found)


def extension(x: Column) -> Column:
    """A file extension in lower case with its dot."""
    return F.lower(F.when(x.startswith("."), x).otherwise(F.concat(F.lit("."), x)))


def search_terms(terms: Column) -> Column:
    """Terms in lower case, each also with underscores for hyphens and for spaces, without blank and repeated ones."""
    low = F.filter(F.transform(terms, lambda t: F.lower(F.trim(t))), lambda t: t != "")
    return F.array_distinct(F.flatten(F.transform(low, lambda t: F.array(t, F.replace(t, F.lit("-"), F.lit("_")), F.replace(t, F.lit(" "), F.lit("_"))))))


def search_text(path: Column, root: str) -> Column:
    """A path below root in lower case, and again with underscores for hyphens and spaces, one a line."""
    low = F.replace(F.lower(relative(path, root)), F.lit("\\"), F.lit("/"))
    return F.concat(low, F.lit("\n"), F.translate(low, "- ", "__"))


def short_label(path: Column, root: str, folders: list[str], longest: int = 46) -> Column:
    """A path below root as a label: without suffix and the folders' names, spaces for underscores; of a longer one the end after an ellipsis."""
    out = F.regexp_replace(relative(path, root), r"(?<=[^/])\.[^./]*$", "")
    for f in folders:
        out = F.replace(out, F.lit(f), F.lit(""))
    out = squeezed(F.replace(out, F.lit("_"), F.lit(" ")))
    return F.when(F.length(out) > longest, F.concat(F.lit("…"), F.right(out, F.lit(longest - 1)))).otherwise(out)


def replaced(x: Column, names: dict[str, str]) -> Column:
    """A text with every name replaced by another, one name after the other."""
    for old, new in names.items():
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def one_digit(x: Column) -> Column:
    """A number of 1 to 100 as text with one digit after the point, rounded by its exact binary value, ties to even; format_string would round 2.05, which is a little less, up."""
    scaled = (x * float(1 << 52)).cast("bigint")  # exact: a power of two
    tenths = F.shiftright(scaled * 10, 52)
    twice, tie = scaled * 20, (tenths * 2 + 1) * F.lit(1 << 52)
    tenths = F.when((twice > tie) | ((twice == tie) & (tenths % 2 == 1)), tenths + 1).otherwise(tenths)
    return F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def scale_label(length: Column) -> Column:
    """A length in micrometres as text: whole micrometres, or from 1000 on millimetres, with one digit unless they are whole."""
    mm = length / 1000.0
    whole = F.abs(mm - F.bround(mm, 0)) < 1e-6
    return F.when(length < 1000, F.format_string("%d um", F.bround(length, 0).cast("bigint"))).when(whole, F.format_string("%d mm", F.bround(mm, 0).cast("bigint"))).otherwise(F.concat(F.when(mm < 100, one_digit(mm)).otherwise(F.format_string("%.1f", mm)), F.lit(" mm")))


def safe_name(x: Column) -> Column:
    """A trimmed file name of letters, digits, dot, underscore and hyphen that starts with a letter or digit; null otherwise."""
    return F.when(F.trim(x).rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$"), F.trim(x))


def marker_variants(path: Column, shortest: int = 4) -> Column:
    """What could betray a source path in bytes: the path, its folder, the folder's name and the part of it before an underscore, as UTF-8 and UTF-16LE; sorted."""
    parts = F.split(path, "/")
    folder = F.coalesce(F.get(parts, F.size(parts) - 2), F.lit(""))
    parent = F.when(F.size(parts) > 1, F.array_join(F.slice(parts, F.lit(1), F.greatest(F.lit(0), F.size(parts) - 1)), "/")).otherwise(F.lit(""))
    texts = F.filter(F.array(folder, F.get(F.split(folder, "_"), F.lit(0)), path, parent), lambda t: F.length(t) >= shortest)
    return F.array_sort(F.array_distinct(F.flatten(F.transform(texts, lambda t: F.array(F.encode(t, "UTF-8"), F.encode(t, "UTF-16LE"))))))


def source_markers(*columns: Column, shortest: int = 6) -> Column:
    """The texts of the columns in lower case, without repeated ones and those that are shorter when trimmed; sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.array_compact(F.array(*columns)), F.lower), lambda t: F.length(F.trim(t)) >= shortest)))


def unescaped(x: Column) -> Column:
    """The five XML character references and the numeric ones for them decoded."""
    for old, new in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#34;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&")):
        x = F.replace(x, F.lit(old), F.lit(new))
    return x


def same_text(a: Column, b: Column) -> Column:
    """Whether two texts are equal once character references are decoded; null equals null only."""
    return unescaped(a).eqNullSafe(unescaped(b))


def valid_mpp(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (x > 0) & (x < float("inf")), F.lit(False))


def dimensions(x: Column) -> Column:
    """array<array<bigint>> of a JSON text [[width, height], ...] of whole numbers above 0; null for anything else, 1.0 and "1" included."""
    pair = r"\[\s*[1-9][0-9]*\s*,\s*[1-9][0-9]*\s*\]"
    return F.when(x.rlike(rf"^\s*\[\s*{pair}(\s*,\s*{pair})*\s*\]\s*$"), F.from_json(x, "array<array<bigint>>"))


def sampled(values: Column) -> Column:
    """The first, middle and last of an array in order, each once."""
    n = F.size(values)
    return F.when(n > 0, F.transform(F.array_distinct(F.array(F.lit(0), F.floor(n / 2).cast("int"), n - 1)), lambda i: F.get(values, i)))


def instant(x: Column) -> Column:
    """Timestamp of an ISO 8601 text with a zone; null without a zone or for other text."""
    return F.when(F.trim(x).rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})$"), F.try_to_timestamp(F.trim(x)))


def compression(name: Column, level: Column) -> Column:
    """struct(codec, level) of a compression by name: none, deflate with a level of 0 to 9 (null where it is another), or the name itself."""
    text = F.lower(F.trim(name))
    codec = F.when(text.isin("none", "no", "uncompressed"), F.lit(None)).when(text.isin("deflate", "zlib"), "deflate").otherwise(text)
    out = F.struct(codec.alias("codec"), F.when(codec == "deflate", level).cast("int").alias("level"))
    return F.when(~F.coalesce((codec == "deflate") & ~level.between(0, 9), F.lit(False)), out)


def natural_level(x: Column) -> list[Column]:
    """Order of level names: numbers first, the greatest first, then other text."""
    number = F.trim(x).try_cast("double")
    return [number.isNull(), F.coalesce(-number, F.lit(0.0)), F.when(number.isNull(), F.lower(x))]


def csv_header(x: Column) -> Column:
    """Whether the first line of a delimited text has a field that is not blank."""
    return F.coalesce(F.regexp_replace(F.get(F.split(x, r"\r\n|\r|\n"), F.lit(0)), r'[\s",]', "") != "", F.lit(False))


def json_text(x: Column) -> Column:
    """Whether a text is JSON."""
    return F.coalesce(x != "", F.lit(False)) & F.try_parse_json(x).isNotNull()


def magic(content: Column, head: bytes) -> Column:
    """Whether bytes begin with those of head."""
    return F.coalesce(F.substring(content, 1, len(head)) == F.lit(head), F.lit(False))


def padded(name: Column, size: Column) -> Column:
    """Bytes of a size: a name, cut or filled up with zeros."""
    return F.rpad(F.encode(name, "UTF-8"), size.cast("int"), F.lit(b"\0"))


def matching_structs(have: Column, wanted: Column, fields: list[str]) -> Column:
    """Whether two arrays of structs are as long and agree, place by place, in the fields that are wanted (null: not asked for)."""
    same = F.zip_with(have, wanted, lambda h, w: reduce(lambda a, b: a & b, [w[f].isNull() | F.coalesce(h[f] == w[f], F.lit(False)) for f in fields]))
    return F.coalesce((F.size(have) == F.size(wanted)) & F.forall(same, lambda s: s), F.lit(False))
