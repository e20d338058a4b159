"""Markers over byte ranges, and NumPy arrays as a data source."""

import hashlib
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.sources import arrays, scans


def plain(data, markers):
    return sorted((i, m) for m in markers for i in range(len(data)) if data.startswith(m, i))


@pytest.mark.parametrize("size,chunk", [(7, 3), (64, 10), (1 << 20, 1 << 20)])
def test_markers_on_every_boundary(spark, tmp_path, size, chunk):
    r, markers = random.Random(1), [b"abab", b"ab", b"\x00\xffz", b"bababa"]
    data = {f"f{i}.bin": bytes(r.choice(b"ab\x00\xffz") for _ in range(n)) for i, n in enumerate((0, 1, 6, 7, 8, 500))}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    got = {}
    for x in scans.marker_hits(spark, str(tmp_path), [*markers, b"ab", b""], size=size, chunk=chunk).collect():
        got.setdefault(x.path.rsplit("/", 1)[1], []).append((x.offset, bytes(x.marker)))
    assert {n: sorted(g) for n, g in got.items()} == {n: p for n, d in data.items() if (p := plain(d, markers))}
    for x in scans.digest_and_scan(spark, str(tmp_path), markers, chunk=chunk).collect():
        d = data[x.path.rsplit("/", 1)[1]]
        assert (x.size, x.sha256, x.md5, x.changed) == (len(d), hashlib.sha256(d).hexdigest(), hashlib.md5(d).hexdigest(), False)
        assert sorted((h.offset, bytes(h.marker)) for h in x.hits) == plain(d, markers) and x.clean == (not x.hits)


def test_no_markers(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"xyz")
    assert scans.marker_hits(spark, str(tmp_path), []).count() == 0
    assert scans.digest_and_scan(spark, str(tmp_path), [b""]).first().clean
    assert scans.variants(["abcd", "abc", "abcd"]) == [b"a\0b\0c\0d\0", b"abcd"]


@pytest.mark.parametrize("dtype", ["f8", "f4", "<i4", ">i2", "u1"])
def test_array_in_ranges(spark, tmp_path, dtype):
    x = (np.arange(1000) * 7 % 251).astype(dtype)
    np.save(tmp_path / "a.npy", x)
    df = arrays.arrays(spark, str(tmp_path / "a.npy"), size=512)
    assert df.rdd.getNumPartitions() > 1 and [r.value for r in df.orderBy("i").collect()] == x.tolist()
    some = df.where("i >= 300 and i < 310 and value > 5")
    assert [r.i for r in some.orderBy("i").collect()] == [i for i in range(300, 310) if x[i] > 5] and some.rdd.getNumPartitions() == 1


def test_tables_and_refused_payloads(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.arange(12.0).reshape(6, 2))
    np.save(tmp_path / "b.npy", np.arange(4.0).reshape(2, 2) * 10)
    got = [(r.i, r["values"]) for r in arrays.arrays(spark, str(tmp_path), 40).orderBy("i").collect()]
    assert got == [(i, [2.0 * i, 2.0 * i + 1]) for i in range(6)] + [(6, [0.0, 10.0]), (7, [20.0, 30.0])]
    np.save(tmp_path / "c.npy", np.array([{"a": 1}], dtype=object), allow_pickle=True)
    with pytest.raises(Exception, match="c.npy: a pickled object payload is refused"):
        arrays.arrays(spark, str(tmp_path)).count()


def test_written_arrays(spark, tmp_path):
    arrays.register(spark)
    path = str(tmp_path / "out")
    points = spark.range(100, numPartitions=5).select(F.array(F.col("id") * 1.0, F.col("id") * 2.0).alias("values"))
    points.write.format("npy").option("palette", json.dumps({"tumor": "#ff0000"})).mode("append").save(path)
    assert sorted(r["values"] for r in arrays.arrays(spark, path).collect()) == [[i * 1.0, i * 2.0] for i in range(100)] and arrays.palette(path) == {"tumor": "#ff0000"}
    # a task that fails leaves nothing, and what was there stays
    bad = points.select(F.when(F.col("values")[0] == 77, F.array(F.lit(1.0))).otherwise(F.col("values")).alias("values"))
    names = sorted(p.name for p in (tmp_path / "out").rglob("*.npy"))
    assert len(names) == 5
    with pytest.raises(Exception, match="different lengths"):
        bad.write.format("npy").mode("overwrite").save(path)
    assert sorted(p.name for p in (tmp_path / "out").rglob("*.npy")) == names and arrays.arrays(spark, path).count() == 100
    points.limit(3).write.format("npy").mode("append").save(path)
    assert arrays.arrays(spark, path).count() == 103
    points.limit(4).write.format("npy").mode("overwrite").save(path)
    assert arrays.arrays(spark, path).count() == 4
    flat = spark.createDataFrame([(1.5,), (None,)], "value double")
    flat.write.format("npy").mode("append").save(str(tmp_path / "flat"))
    got = sorted(str(r.value) for r in arrays.arrays(spark, str(tmp_path / "flat")).collect())
    assert got == ["1.5", "nan"]
