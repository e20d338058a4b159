"""Each registered query of the corpus operators, over a small folder of tables, against plain versions of the same."""

import hashlib
import random

import duckdb
import numpy as np
import public_tokenizers
import pytest
from brute import WORD, article, byte_ids, crc, near, repeats, roots
from tokenizers import Tokenizer

from tallyloom.llm.queries import ORACLE_SQL, QUERIES

BYTES, WORDS = (Tokenizer.from_file(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def documents():
    r = random.Random(11)
    words = ["alpha", "Beta,", "gamma's", "delta", "übung", "12", "epsilon.", "zeta"]
    text = lambda n: " ".join(r.choice(words) + str(r.randrange(40)) for _ in range(n))
    passage, base = text(50), text(120)
    out = [(i, text(r.choice([1, 5, 40, 200])), int(i % 3 > 0)) for i in range(40)]
    out += [(100, base, 1), (101, base.replace(" ", "\n", 3), 1), (102, base + " more", 1), (103, text(20) + " " + passage, 1), (104, passage + " " + text(9), 1), (105, None, 0), (106, "", 0), (107, "  ", 0), (108, "word " * 3000, 0)]
    return [(d, t if q else None if t is None else t.replace(" ", "### "), q) for d, t, q in out]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path, r = str(tmp_path_factory.mktemp("tables")), np.random.default_rng(3)
    rows = documents()
    spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t, _ in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(d, q, 0) for d, _, q in rows], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(vectors(r), "vec_id long, embedding array<double>, label int").write.parquet(f"{path}/embeddings.parquet")
    spark.createDataFrame(PAGES, "page_id long, url string, html string").write.parquet(f"{path}/pages.parquet")
    return path


def vectors(r):
    out = []
    for i in range(90):
        x = np.eye(8)[i % 4] + (0.03 if i % 3 else 0.2) * r.standard_normal(8)
        out.append((i, [float(c) for c in x], None if i % 30 == 7 else i % 2))
    return out + [(200, out[0][1], 0), (201, [0.0] * 8, 0), (202, None, 0)]


PAGES = [(i, f"http://x.example/{i}", p) for i, p in enumerate([
    "<div><p>One, two, and three words here.</p><p>Another one, as long as that.</p></div><nav><a>menu</a></nav>", "<article><p>Alone.</p></article>", "", None, "<nav>x</nav>",
    "<div><section><p>" + "text, " * 60 + "</p></section><section><p>" + "more, " * 50 + "</p></section></div>",
])]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_op1(spark, folder):
    start, want = 0, []
    for d, t, _ in sorted(documents()):
        ids = byte_ids(BYTES, t)
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    assert rows(QUERIES["op1_token_files"](spark, folder), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=str)


def test_op2(spark, folder):
    ids, places = {d: byte_ids(BYTES, t) for d, t, _ in documents()}, {}
    got = QUERIES["op2_best_fit_packing"](spark, folder).collect()
    seen = {}
    for r in got:
        assert r.ids_crc32 == crc(ids[r.doc_id][r.start : r.start + r.length])
        seen.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for d, pieces in seen.items():
        at = 0
        for i, (piece, start, length) in enumerate(sorted(pieces)):
            assert (piece, start) == (i, at) and (i == 0 or length == 1024) and (len(pieces) > 1 or length == len(ids[d]))
            at += length
        assert at == len(ids[d])
    assert set(seen) == set(ids)
    for p in places.values():
        at = 0
        for offset, length in sorted(p):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(places) <= -(-sum(map(len, ids.values())) // 1024) + 1


def test_op3(spark, folder):
    assert rows(QUERIES["op3_substring_dedup"](spark, folder), "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(repeats([(d, t) for d, t, _ in documents()]), key=str)


def test_op4(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    want = con.execute(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({ORACLE_SQL['op4_exact_dedup']})").fetchall()
    assert rows(QUERIES["op4_exact_dedup"](spark, folder), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=str)


def test_op5(spark, folder):
    assert rows(QUERIES["op5_minhash_near_dedup"](spark, folder), "doc_id", "n_shingles", "component_id", "kept") == sorted(near([(d, t) for d, t, _ in documents()]), key=str)


def test_op6(spark, folder):
    table = vectors(np.random.default_rng(3))
    good = [t for t in table if t[1] is not None and any(t[1]) and t[2] is not None]
    linked = [(i, j) for i, (_, x, k) in enumerate(good) for j, (_, y, m) in enumerate(good) if j < i and k == m and np.dot(x, y) >= 0.98 * np.linalg.norm(x) * np.linalg.norm(y)]
    root = roots(range(len(good)), linked)
    want = [(t[0], sum(i in e for e in linked), good[root[i]][0], root[i] == i) for i, t in enumerate(good)]
    want += [(t[0], 0, t[0], True) for t in table if t not in good]
    assert rows(QUERIES["op6_embedding_near_dedup"](spark, folder), "vec_id", "n_links", "component_id", "kept") == sorted(want, key=str)


def test_op7(spark, folder):
    want = [(i, url, text := article(p or ""), len(text)) for i, url, p in PAGES]
    assert rows(QUERIES["op7_html_extraction"](spark, folder), "page_id", "url", "text", "n_chars") == sorted(want, key=str)
    assert [w[2] for w in want][1:5] == ["Alone.", "", "", ""] and want[0][2].count("\n") == 1


def test_op8(spark, folder):
    import zlib

    got = {r.doc_id: r for r in QUERIES["op8_quality_classifier"](spark, folder).collect()}
    quality = {d: q for d, _, q in documents()}
    assert set(got) == set(quality) and all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for d, r in got.items())
    assert sum((r.score >= 0.5) == quality[d] for d, r in got.items()) >= 0.9 * len(got)


def test_op9(spark, folder):
    WORDS.no_truncation()
    WORDS.no_padding()
    sha, want = lambda s: hashlib.sha256(s.encode()).hexdigest(), []
    for d, t, _ in documents():
        ids = WORDS.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), sha(" ".join(map(str, ids))), sha(WORDS.decode(ids, skip_special_tokens=False))))
    assert rows(QUERIES["op9_bpe_encode_decode"](spark, folder), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=str)


def test_op10(spark, folder):
    got = {r[0]: r for r in QUERIES["op10_token_counts"](spark, folder).collect()}
    assert {d: r.n_words for d, r in got.items()} == {d: len(WORD.findall(t or "")) for d, t, _ in documents()} and all(r[-1] >= r.n_words for r in got.values())
