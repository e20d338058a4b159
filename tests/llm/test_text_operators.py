import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from brute import WORD, article, attention_score, byte_ids, crc
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import bpe, packing, quality, token_counts, token_files
from tallyloom.llm.html_extract import extract, main_text

BYTES, WORDS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES)


def texts(n=40, seed=4):
    r = random.Random(seed)
    return [(i * 3 % 97, " ".join(r.choice(["alpha", "Beta,", "gamma's", "12", "…", "ñandú", "\n"]) for _ in range(r.choice([0, 1, 5, 60, 1500])))) for i in range(n)] + [(200, None), (201, ""), (None, "no id")]


def test_token_files_round_trip(spark, library, tmp_path):
    docs = texts()
    path = f"{tmp_path}/f"
    token_files.write(spark.createDataFrame([(d, t, 1) for d, t in docs], DOCS + ", frames int").repartition(4), path, BYTES, 2, partitions=3)
    order = sorted(docs, key=lambda x: -1 if x[0] is None else x[0])
    start, want = 0, []
    for d, t in order:
        ids = byte_ids(library, t)
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    got = token_files.read(spark, path)
    assert sorted((tuple(r) for r in got.select("doc_id", "start", "n_tokens", F.crc32("ids")).collect()), key=str) == sorted(want, key=str)
    one = token_files.read(spark, path, [200, 3]).collect()
    assert {(r.doc_id, r.start, r.n_tokens) for r in one} == {w[:3] for w in want if w[0] in (200, 3)}
    assert token_files.index(spark, path).agg(F.sum("n_tokens")).first()[0] == start


def test_token_files_with_a_dictionary(spark, library, tmp_path):
    r = random.Random(1)
    docs = [(i, " ".join(r.choice(["lorem", "ipsum", "dolor", "sit", "amet", str(i)]) for _ in range(300))) for i in range(300)]
    df = spark.createDataFrame(docs, DOCS)
    assert token_files.train_dictionary(df, BYTES, 2)
    token_files.write(df, f"{tmp_path}/d", BYTES, 2)
    got = {r.doc_id: r.c for r in token_files.read(spark, f"{tmp_path}/d").select("doc_id", F.crc32("ids").alias("c")).collect()}
    assert got == {d: crc(byte_ids(library, t)) for d, t in docs}
    size = token_files.index(spark, f"{tmp_path}/d").agg(F.sum("length"), F.sum("n_tokens")).first()
    assert size[0] < size[1] * 1.2
    token_files.write(df, f"{tmp_path}/e", BYTES, 3)
    spark.read.parquet(f"{tmp_path}/e/dictionary").write.mode("overwrite").parquet(f"{tmp_path}/x")
    spark.read.parquet(f"{tmp_path}/x").withColumn("dictionary", F.lit(b"other")).write.parquet(f"{tmp_path}/y/dictionary")
    with pytest.raises(ValueError, match="hash"):
        token_files.read(spark, f"{tmp_path}/y")


def test_token_files_of_nothing(spark, tmp_path):
    token_files.write(spark.createDataFrame([], DOCS), f"{tmp_path}/n", BYTES, 2)
    assert token_files.read(spark, f"{tmp_path}/n").count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 6), max_size=8), st.integers(0, 60))
def test_fullest_is_the_fullest(counts, room):
    use = dict(packing.fullest(counts, room))
    assert all(n <= counts[k] for k, n in use.items())
    sums = {0}
    for k, n in counts.items():
        sums = {s + i * k for s in sums for i in range(n + 1) if s + i * k <= room}
    assert sum(k * n for k, n in use.items()) == max(sums)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 200), max_size=12))
def test_plan_uses_every_piece_once(histogram):
    made = packing.plan(dict(histogram), 64)
    used, bins = {}, 0
    for n, use in made:
        assert n > 0 and sum(k * c for k, c in use) <= 64
        bins += n
        for k, c in use:
            used[k] = used.get(k, 0) + n * c
    assert used == histogram
    # not many more bins than first fit decreasing makes
    rooms = []
    for k in sorted(histogram, reverse=True):
        for _ in range(histogram[k]):
            at = next((i for i, x in enumerate(rooms) if x >= k), None)
            if at is None:
                rooms.append(64 - k)
            else:
                rooms[at] -= k
    assert bins <= 1.25 * len(rooms) + 1


def test_pack(spark, library):
    docs = texts(60) + [(5, "repeated row"), (5, "repeated row")]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], DOCS + ", length int").repartition(5)
    got = packing.pack(df, BYTES, 2, 64).collect()
    sequences, pieces = {}, {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.piece, bytes(r.ids)))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    for d, t in docs:
        if d not in (5,):
            ids = byte_ids(library, t)
            mine = [p for p in sorted(pieces[d])]
            if sum(x == d for x, _ in docs) == 1:
                assert b"".join(p[3] for p in mine) == np.array(ids, "<u4").tobytes() and [p[2] for p in mine] == list(range(len(mine)))
                assert all(p[1] == 64 for p in mine[1:])
    total = sum(r.length for r in got)
    assert total == sum(len(byte_ids(library, t)) for _, t in docs) and len(sequences) <= total / 64 * 1.03 + 2
    assert packing.pack(spark.createDataFrame([], DOCS), BYTES).count() == 0


def test_bpe_operator(spark):
    got = {r.doc_id: r for r in bpe.encode_and_decode(spark.createDataFrame([(1, "Hello, World"), (2, None), (3, "  "), (None, "x")], DOCS), WORDS).collect()}
    assert got[2].ids == got[3].ids == [] and got[2].decoded == "" and len(got) == 4
    assert got[1].decoded.replace(" ", "").replace("</w>", " ").strip() == "hello , world"


def test_counts_like_greedy_matching(spark):
    initial, continuing = token_counts.piece_vocabulary(PIECES)
    i, c, longest = set(initial), set(continuing), max(map(len, initial + continuing))

    def greedy(word):
        word, at, n, known = "▁" + word, 0, 0, i
        while at < len(word):
            size = next((k for k in range(min(longest, len(word) - at), 0, -1) if word[at : at + k] in known), 0)
            if not size:
                return 1
            at, n, known = at + size, n + 1, c
        return n

    docs = texts() + [(300, "internationalization 漢字 \U0001f600 zzzzqqqq\vx"), (301, "a" * 3000)]
    got = token_counts.token_counts(spark.createDataFrame([(d, t, 0) for d, t in docs], DOCS + ", n_words int"), PIECES)
    want = [(d, len(w := WORD.findall(t or "")), sum(map(greedy, w))) for d, t in docs]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(spark.createDataFrame([], DOCS), PIECES).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=4), max_size=8), st.sets(st.text("ab", min_size=1, max_size=4), max_size=8), st.text("abc", min_size=1, max_size=12))
def test_automaton(initial, continuing, word):
    at, n, known = 0, 0, initial
    while at < len(word):
        size = next((k for k in range(len(word) - at, 0, -1) if word[at : at + k] in known), 0)
        if not size:
            n = 1
            break
        at, n, known = at + size, n + 1, continuing
    assert token_counts.Automaton(initial, continuing).count(word) == n


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var x = "<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home, sweet, home</a></li></ul></nav><div class="cookie-notice">We use cookies, many, many cookies.</div>
<div id="content"><div class="post"><h2>Heading &amp; more</h2><p>First paragraph, with <b>bold</b>   text&nbsp;and a comma, long enough to matter to anyone.
<p>Second one, unclosed, which also says quite a lot of things.<br>New line. <a href="x">link</a></p><ul><li>item one</li><li>item two</li></ul><script>bad()</script></div>
<div class="comments"><p>A reader comment, with commas, commas, commas, and length to spare for everyone here.</p></div><aside>Related, things, here</aside></div>
<form>Search <input name=q></form><footer>&copy; 2020, all rights, reserved</footer></body></html>"""


def test_article_of_a_page():
    assert main_text(PAGE).split("\n") == ["Heading & more", "First paragraph, with bold text and a comma, long enough to matter to anyone.", "Second one, unclosed, which also says quite a lot of things. New line. link", "item one", "item two"]


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (None, ""), ("", ""), ("plain words", "plain words"), ("<p>a", "a"), ("<nav>x</nav>", ""), ("<article><p>One</p><p>Two &lt;b&gt;</article><footer>f", "One\nTwo <b>"),
        ("<article><section><p>A, long enough</p></section><section><p>B, also there</p></section></article><div class=ad>ad, ad, ad</div>", "A, long enough\nB, also there"),
        ("<body><p title='a > b'>x</p><!-- <p>no</p> --><style>p{}</style></body>", "x"), ("<p>a<p hidden>b</p><p style='display:none'>c</p>", "a"), ("<" * 50 + "a" + "<p " * 50, None),
        ("<title>t</title><p>a &#228; &euro; &unknown;</p>", "a ä € &unknown;"), ("<article><p>x<br><p>y</p></article>", "x\ny"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ],
)
def test_odd_pages(page, want):
    got = main_text(page)
    assert want is None or got == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<b>", "</a>", "<a href='x'>", "text, here ", "<li>", "<!--", "-->", "<br/>", "</body>", "<script>", "</script>", "&amp;", "<td", ">", "\"", "="]), max_size=25))
def test_any_page_gives_text(parts):
    assert isinstance(main_text("".join(parts)), str)


def test_extract_keeps_columns(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "old", 5), (1, "u", PAGE, "old", 5), (2, None, None, None, None)], "page_id long, url string, html string, text string, row int")
    got = extract(df).orderBy("page_id").collect()
    assert [(r.page_id, r.url, r.row) for r in got] == [(1, "u", 5), (1, "u", 5), (2, None, None)] and got[2].text == "" and got[2].n_chars == 0 and got[0].n_chars == len(got[0].text)
    assert extract(df.limit(0)).count() == 0


def labelled(n=240, seed=6):
    r = random.Random(seed)
    good = lambda: " ".join(r.choice(["the", "house", "stands", "on", "green", "hills.", "And", "rivers,", "run"]) for _ in range(r.randrange(30, 300)))
    bad = lambda: r.choice([" ".join(["SPAM!!"] * 80), " ".join(w + "***" for w in good().split()), "buy " * 90])
    rows = [(i, good() if i % 3 else bad(), int(i % 3 > 0)) for i in range(n)]
    return rows


def test_classifier_on_held_out_rows(spark):
    rows = labelled()
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], DOCS)
    labels = spark.createDataFrame([(d, q) for d, _, q in rows] + [(None, 1), (1, None)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = {r.doc_id: r for r in quality.score(docs, model).withColumn("held", quality.held_out()).collect()}
    assert all(r.held == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = [(got[d].score >= 0.3, bool(q)) for d, _, q in rows if got[d].held]
    assert len(held) > 20 and sum(a == b for a, b in held) / len(held) >= 0.95
    odd = spark.createDataFrame([(1, None, 3), (1, "", 3), (None, "x", 3)], DOCS + ", score int")
    scores = [r.score for r in quality.score(odd, model, carry=["doc_id"]).collect()]
    assert len(scores) == 3 and all(0 <= s <= 1 for s in scores)
    assert quality.score(docs.limit(0), model).count() == 0


def test_no_labels_keep_everything(spark):
    docs = spark.createDataFrame([(1, "x")], DOCS)
    assert quality.train(docs, spark.createDataFrame([], "doc_id long, quality int")) is None
    assert quality.score(docs, None).first().score == 1


def test_scores_like_passage_by_passage():
    rows = labelled(30)
    texts = pa.array([t for _, t, _ in rows] + ["", None, "one"])
    x, bounds = quality.passages(texts)
    y = np.array([q for *_, q in rows] + [0, 0, 1], dtype=np.float32)
    m = quality.fit(x, bounds, y)
    got = quality._scores(m, texts)
    want = [attention_score(m, x[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    assert np.allclose(got, want, atol=1e-5) and ((got >= 0.5) == (y > 0.5)).mean() > 0.9
    assert np.allclose(np.add.reduceat(m.forward(m.normal(x), bounds)["a"], bounds[:-1]), 1, atol=1e-5)


def test_gradient_like_finite_differences():
    r = np.random.default_rng(1)
    bounds, y, weight = np.array([0, 2, 3, 6]), np.array([1.0, 0.0, 1.0]), np.array([0.2, 0.5, 0.3])
    x = r.standard_normal((6, quality.FEATURES))
    m = quality.started(np.zeros(quality.FEATURES), np.ones(quality.FEATURES), np.float64)

    def loss():
        s = m.forward(x, bounds)["score"]
        return -(weight * (y * np.log(s) + (1 - y) * np.log(1 - s))).sum()

    grad = m.gradient(x, bounds, y, weight)
    assert set(grad) == set(quality.Model.LEARNED)
    for name, g in grad.items():
        p = getattr(m, name)
        for at in [tuple(r.integers(0, n) for n in p.shape) for _ in range(12)]:
            was, step = p[at], 1e-6
            p[at] = was + step
            above = loss()
            p[at] = was - step
            below = loss()
            p[at] = was
            assert abs((above - below) / (2 * step) - g[at]) < 1e-7 + 1e-4 * abs(g[at]), name


def test_training_rows_are_bounded_and_long_texts_make_room(spark, monkeypatch):
    """Repeated ids give one row each, and documents over the length bound do not count towards the number chosen."""
    monkeypatch.setattr(quality, "TRAINING_DOCUMENTS", 20)
    monkeypatch.setattr(quality, "TRAINING_CHARACTERS", 2000)
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, bounds, y: seen.append((len(bounds) - 1, y.sum())))
    rows = labelled(200)
    docs = [(d, t if d % 5 else t + " long" * 500) for d, t, _ in rows] * 3
    quality.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame([(d, q) for d, _, q in rows], "doc_id long, quality int"))
    assert seen == [(40, 20)]


def test_very_long_text_is_scored_whole(spark):
    rows = labelled()
    model = quality.train(spark.createDataFrame([(d, t) for d, t, _ in rows], DOCS), spark.createDataFrame([(d, q) for d, _, q in rows], "doc_id long, quality int"))
    good, bad = next(t for _, t, q in rows if q), "SPAM!! " * 300_000
    got = [r.score for r in quality.score(spark.createDataFrame([(1, good), (2, bad), (3, good + " " + bad)], DOCS), model).orderBy("doc_id").collect()]
    assert got[0] > 0.5 > got[1] and got[2] < got[0]


def test_nested_pages_take_time_in_proportion():
    began = time.perf_counter()
    assert main_text("<div><span>" * 8000 + "words, and more, of them") == "words, and more, of them"
    for page in ("<p>" * 20000, "<a>" * 20000 + "x", "<li>" * 20000, "<td><a>x" * 10000, "<b " * 20000, "<table>" * 10000 + "<p>" * 10000, "<div>" * 20000 + "</div>" * 20000, "<!--" * 20000):
        main_text(page)
    assert time.perf_counter() - began < 5


def test_pages_like_scoring_by_definition():
    r = random.Random(5)

    def piece(depth):
        words = " ".join(r.choice(["some", "words,", "here", "and", "there"]) for _ in range(r.choice([1, 4, 30, 90])))
        kind = r.choice(["p", "p", "li", "a", "text", "div", "div", "section", "article", "nav", "ul"]) if depth else r.choice(["p", "text", "a"])
        if kind == "text":
            return words
        if kind == "a":
            return f"<a>{words}</a>"
        if kind in ("p", "li"):
            inner = words + (f" <a>{words[:9]}</a> tail" if r.random() < 0.3 else "")
            return f"<ul><li>{inner}</li></ul>" if kind == "li" else f"<p>{inner}</p>"
        return f"<{kind}>" + "".join(piece(depth - 1) for _ in range(r.randrange(1, 5))) + f"</{kind}>"

    for _ in range(300):
        page = "".join(piece(4) for _ in range(3))
        assert main_text(page) == article(page), page


def test_token_files_of_repeated_and_long_documents(spark, library, tmp_path, monkeypatch):
    """Rows that share an id, or have none, are spread over files; a document over a slice and a block keeps its place."""
    monkeypatch.setattr(token_files, "TRAINING_DOCUMENTS", 30)
    long = "lorem ipsum, dolor sit amet " * 80_000
    docs = [(None, f"no id {i}") for i in range(60)] + [(7, f"seven {i % 3}") for i in range(60)] + [(i, f"text {i} of them") for i in range(40)] + [(500, long), (501, None), (501, None)]
    df = spark.createDataFrame([(d, t, 1) for d, t in docs], DOCS + ", tie int").repartition(6)
    token_files.write(df, f"{tmp_path}/r", BYTES, 2, partitions=4)
    got = token_files.read(spark, f"{tmp_path}/r").select("doc_id", "start", "n_tokens", F.crc32("ids").alias("crc")).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.crc) for r in got) == sorted((str(d), len(i), crc(i)) for d, i in ((d, byte_ids(library, t)) for d, t in docs))
    ordered, at = sorted(got, key=lambda r: r.start), 0
    for r in ordered:
        assert r.start == at
        at += r.n_tokens
    keys = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert keys == sorted(keys)
    assert token_files.index(spark, f"{tmp_path}/r").where("doc_id is null").select("part").distinct().count() > 1


def test_pack_a_very_long_document(spark, library):
    text = "alpha beta, gamma " * 90_000
    got = sorted((r.piece, r.start, r.length, bytes(r.ids)) for r in packing.pack(spark.createDataFrame([(1, text), (2, "x")], DOCS), BYTES).where("doc_id = 1").collect())
    assert b"".join(p[3] for p in got) == np.array(byte_ids(library, text), "<u4").tobytes()
    assert all(n == 1024 for _, _, n, _ in got[1:]) and [p[0] for p in got] == list(range(len(got)))


def test_bpe_and_counts_of_odd_tables(spark):
    docs = [(1, "Hello, World"), (1, "Hello, World"), (None, "x " * 300_000), (2, "")]
    df = spark.createDataFrame([(d, t, 1, 2, 3) for d, t in docs], DOCS + ", ids int, n_tokens int, decoded int").repartition(2)
    got = bpe.encode_and_decode(df, WORDS).collect()
    assert sorted((str(r.doc_id), len(r.ids)) for r in got) == [("1", 3), ("1", 3), ("2", 0), ("None", 300_000)]
    assert bpe.encode_and_decode(df.limit(0), WORDS).count() == 0
    counted = sorted((str(r[0]), r[1]) for r in token_counts.token_counts(df, PIECES).collect())
    assert [x for x, _ in counted] == ["1", "1", "2", "None"] and counted[0] == counted[1] and counted[3][1] == 300_000


def test_pages_whose_names_mislead():
    """A word of a longer name does not cost a page its text; names that say nothing else still do."""
    text = "Hello, this, is, the text of the page."
    for page in (f'<div class="post community-garden"><p>{text}</p></div>', f'<nav><a>x</a></nav><div id="legal-history"><p>{text}</p></div>', f'<main><div class="promo-tours"><section><p>{text}</p></section></div></main>'):
        assert main_text(page) == text
    for page in (f'<div class="cookie-notice"><p>{text}</p></div>', f'<div class="comments"><p>{text}</p></div>', f'<div class="wide sidebar"><p>{text}</p></div>', f"<footer>{text}</footer>"):
        assert main_text(page) == ""
    assert main_text(f'<div class="social-share"><p>no</p></div><div class="body"><p>{text}</p></div>') == text


def test_scores_choose_inside_an_article():
    """A list of links beside the text of an article is not taken for it; a title in a header of its own is part of it."""
    text = "It was, as they say, a long way home, " * 8
    assert main_text(f"<article><header><h1>Title</h1></header><section><p>{text}</p></section></article>") == f"Title\n{text.strip()}"
    far = "".join(f"<section><ul><li><a>link {i}, and more, of it</a></li></ul></section>" for i in range(40))
    assert main_text(f"<article><div>{far}</div><div><div><p>{text}</p><p>{text}</p></div></div></article>") == f"{text.strip()}\n{text.strip()}"
