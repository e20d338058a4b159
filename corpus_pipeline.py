"""From raw documents to packed training sequences: each stage reads what the one before it kept.

Every stage takes documents with the columns COLUMNS, in any order and beside any others, which are dropped, and returns COLUMNS (the last one pieces). An
empty table gives an empty table. Ids may be null or repeat; each stage says what comes of that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm._shared import discard, stored
from tallyloom.llm.exact_dedup import exact_duplicates, normalised
from tallyloom.llm.near_dedup import near_duplicates
from tallyloom.llm.packing import pack
from tallyloom.llm.quality import score, train
from tallyloom.llm.substrings import repeated_passages

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents that score less are rejected.
QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels that are not held out, does not reject.

    Every row is scored by its text alone, so repeated rows stay or go together; a null text counts as empty, and empty ones have one score. Rows without an
    id are scored like others. A score of just QUALITY stays. Without labels of both classes nothing is rejected.
    """
    docs = docs.select(*COLUMNS)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, carry=COLUMNS).where(F.col("score") >= QUALITY).select(*COLUMNS)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal without white space: the longest, then the one with the smallest doc_id, null last.

    Null and empty texts equal each other, so one of them stays. Of repeated rows, alike in id and text, one stays.
    """
    found = stored(exact_duplicates(docs).drop("group_size", "bucket"), "exact")
    keep = found.where("kept").select(F.col("doc_id").alias("keep_id"), "text_sha256", F.col("points").alias("most"))
    docs = docs.select(*COLUMNS).withColumn("digest", F.sha2(normalised(F.col("text")), 256))
    same = (F.col("digest") == F.col("text_sha256")) & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.coalesce(F.length("text"), F.lit(0)) == F.col("most"))
    kept = docs.join(keep.hint("shuffle_hash"), same, "left_semi")
    # a kept row may have come more than once, alike in id and text
    again = found.where("not kept and doc_id <=> keep_id").join(keep, ["text_sha256"]).where("points = most")
    return (kept.dropDuplicates(["digest", "doc_id"]) if again.take(1) else kept).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: five-word shingles, similarity 0.8 or more; the one with the smallest doc_id.

    Rows that share an id are one document and stay or go together. Rows without an id, and texts without words, null ones included, are nobody's duplicates and stay.
    """
    keep = near_duplicates(docs, size=5, percent=80).where("kept").select(F.col("doc_id").alias("keep_id")).distinct()
    return docs.select(*COLUMNS).join(keep.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("keep_id")), "left_semi")


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words or more that repeat, wherever they stand; a document of which nothing is left goes.

    Every copy of a passage goes, the first one too; repeated rows are each other's copies. A null, empty or short text stays as it is. n_chars is counted anew where a text was cut.
    """
    cut = repeated_passages(docs.select(*COLUMNS), window=35, carry=["doc_id", "lang", "source", "n_chars"], layout=True)
    whole = F.col("n_removed") == 0
    cut = cut.where("n_removed = 0 or n_removed < n_words")
    return cut.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.when(whole, F.col("n_chars")).otherwise(F.length("kept_text")).cast("bigint").alias("n_chars"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 1024 tokens, with their ids. A null or empty text is one piece of the end id; repeated rows are packed each for itself; ids stay null."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, size=1024)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("substring_dedup", substring_dedup), ("packing", packing)]
#: A learned classifier and a packing plan are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages on the table documents, each but the last written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            discard(before)
        before = docs
    packed = STAGES[-1][1](spark, docs, sf_dir)
    discard(before)  # its pieces are stored
    return packed
