import re

import __spark_entry__ as entry
import corpus_pipeline
import pytest
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A small corpus: clean documents, junk, copies, near copies and a shared passage."""
    import random

    r = random.Random(8)
    word = lambda: "".join(r.choice(["an", "er", "th", "in", "on", "re"]) for _ in range(r.randrange(1, 4)))
    clean = lambda n=120: " ".join(word() for _ in range(n)).capitalize() + "."
    junk = lambda: " ".join(word() + "###" for _ in range(100))
    rows, labels = [], []
    for i in range(150):
        rows.append((i, clean() if i % 3 else junk()))
        labels.append((i, int(i % 3 > 0)))
    base, passage = clean(200), " ".join(f"pass{i}" for i in range(60))
    rows += [(200, base), (201, base + " "), (202, base.replace(" ", "\n", 3)), (203, base + " more words"), (300, clean() + " " + passage), (301, passage + " " + clean()), (400, None), (401, "")]
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(*x, 0) for x in labels], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, folder, tmp_path):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs
        if name != "packing":
            assert docs.columns == COLUMNS
    ids = {n: {r.doc_id for r in d.collect()} for n, d in kept.items()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "substring_dedup", "packing"]
    assert len([i for i in range(150) if i % 3 and i in ids["quality"]]) >= 97 and len([i for i in range(0, 150, 3) if i in ids["quality"]]) <= 2
    assert {200, 201, 202, 203} & ids["exact_dedup"] == {201, 203} & ids["exact_dedup"] or {200, 201, 202} & ids["exact_dedup"] == {201}
    assert len({200, 201, 202, 203} & ids["near_dedup"]) == 1
    cut = {r.doc_id: r for r in kept["substring_dedup"].collect()}
    assert "pass" not in cut[300].text and "pass" not in cut[301].text and cut[300].n_chars == len(cut[300].text)
    same = {r.doc_id: r.text for r in kept["near_dedup"].collect()}
    assert all(cut[i].text == same[i] for i in cut if i < 150)
    assert kept["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n")).first()[0] <= 1024
    assert corpus_pipeline.run(spark, folder).count() == kept["packing"].count()


def test_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n) or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 11)) and "pipeline" in names


DOCS = "doc_id long, text string, lang string, source string, n_chars long, row int, score int, kept int"
TEXT = " ".join(f"w{i}" for i in range(60))
ODD = [(1, TEXT, "en", "s", 1, 1, 1, 1), (1, TEXT, "en", "s", 1, 1, 1, 1), (2, None, None, None, None, 2, 2, 2), (3, "", "en", "s", 0, 3, 3, 3), (None, "short text", "en", "s", 10, 4, 4, 4), (None, "short  text", "en", "s", 11, 5, 5, 5), (4, "other words here", "en", "s", 16, 6, 6, 6)]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, folder, name):
    stage, df = dict(corpus_pipeline.STAGES)[name], spark.createDataFrame(ODD, DOCS)
    assert stage(spark, df.limit(0), folder).count() == 0
    got = stage(spark, df, folder)
    ids = sorted(str(r.doc_id) for r in got.collect())
    if name == "packing":
        assert ids == ["1", "1", "2", "3", "4", "None", "None"] and {r.length for r in got.where("doc_id in (2, 3)").collect()} == {1}
        return
    assert got.columns == COLUMNS
    want = {
        "exact_dedup": ["1", "2", "4", "None"],  # of the empty texts the smaller id, of the repeated row one, of the two without ids the longer
        "near_dedup": ["1", "1", "2", "3", "4", "None", "None"],  # rows that share an id are one document
        "substring_dedup": ["2", "3", "4", "None", "None"],  # repeated rows are each other's copies, so nothing is left of them
    }
    if name == "quality":  # repeated rows stay or go together, empty texts too
        assert ids.count("1") in (0, 2) and ("2" in ids) == ("3" in ids)
    else:
        assert ids == want[name]


def test_without_labels_nothing_is_rejected(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.quality(spark, spark.createDataFrame(ODD, DOCS), str(tmp_path)).count() == len(ODD)
