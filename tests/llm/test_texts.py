"""Tokenizer, main text, archives and classifiers."""

import hashlib
import random
import tempfile
import time
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import compression_quality, html_text, piece_tokens, toxicity, warc
from tallyline.llm.queries import piece_model

ALPHABET = [
    "a", "b", "the", " ", "  ", "\n", " \n", "▁", "é", "ß", "漢", "😀", "\x00", "\t", "aaaa", "ing", "<s>", "</s>", "un",
    "http://", "....", "    ", "\r\n",
]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


def test_tokens_equal_the_library(spark, sf, library):
    random.seed(1)
    texts = ["", " ", "\n", "  a", "a ", "▁x", "x▁▁", "\n\na\n b", "ab" * 3000, " " * 70]
    texts += ["".join(random.choices(ALPHABET, k=random.randint(1, 60))) for _ in range(800)]
    texts += ["".join(random.choices("abcde", k=300)) for _ in range(20)]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, None, "x"), (3, "repeated id", "x")]
    made = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = piece_tokens.encode(made, piece_model(), with_ids=True).collect()
    want = [library.encode(t or "", add_eos=True) for _, t, _ in rows]
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found), key=lambda x: str(x)) == sorted(
        ((i, len(w), brute.sha(" ".join(map(str, w))), brute.sha(library.decode(w))) for (i, _, _), w in zip(rows, want)),
        key=lambda x: str(x),
    )
    assert sorted(map(tuple, (r.ids for r in found))) == sorted(map(tuple, want))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.ids_sha256 for r in piece_tokens.encode(docs, piece_model()).collect()}
    assert got == {r.doc_id: brute.sha(" ".join(map(str, library.encode(r.text, add_eos=True)))) for r in docs.collect()}
    assert piece_tokens.encode(docs.limit(0), piece_model()).isEmpty()


def test_words_of_all_lengths(library, monkeypatch):
    random.seed(3)
    vocabulary = piece_tokens.read_vocabulary(piece_model())
    monkeypatch.setattr(piece_tokens, "CACHED_WORDS", 300)
    monkeypatch.setattr(piece_tokens, "CHUNK", 2000)
    texts = ["", "", " ", "x" * 63, "x" * 64, "x" * 65, "漢" * 300, " " * 3000, "<s> \x00\U0010ffff\ufffd"]
    texts += ["".join(random.choices("etaoinshr", k=k)) for k in range(1, 140)] * 2
    texts += ["".join(random.choices(vocabulary.pieces, k=random.randint(1, 40))) for _ in range(300)]
    texts += [" ".join(random.choices(vocabulary.pieces, k=random.randint(1, 40))) for _ in range(300)]
    encoder = piece_tokens.Encoder(vocabulary)
    for text, (ids, shown, decoded) in zip(texts, encoder.texts(texts), strict=True):
        want = library.encode(text, add_eos=True)
        assert (ids.tolist(), bytes(shown), bytes(decoded)) == (want, " ".join(map(str, want)).encode(), library.decode(want).encode())
    assert len(encoder.known) < 3000 and all(len(k) <= 4 * piece_tokens.LONG for k in encoder.known)


def test_tokens_take_about_the_time_of_the_library(library):
    """Words are made up anew, so that few of them repeat."""
    random.seed(4)
    parts = ["the", "ti", "on", "ing", "a", "er", "sch", "eau", "re", "qu", "lo", "m", "st", "é", "is", "und"]
    texts = [
        " ".join("".join(random.choices(parts, k=random.randint(1, 6))) + random.choice(["", "", ",", "."]) for _ in range(400))
        for _ in range(1500)
    ]
    encoder = piece_tokens.Encoder(piece_tokens.read_vocabulary(piece_model()))
    began = time.process_time()
    counts = [len(ids) for ids, _, _ in encoder.texts(texts)]
    own = time.process_time() - began
    began = time.process_time()
    want = [library.encode(text, add_eos=True) for text in texts]
    assert [library.decode(ids) for ids in want] == texts
    assert counts == list(map(len, want)) and own < 1.6 * (time.process_time() - began)


def test_decode_of_any_ids(library):
    vocabulary = piece_tokens.read_vocabulary(piece_model())
    random.seed(2)
    for _ in range(500):
        ids = [random.choice([random.randrange(3, 400), random.randrange(3, 32000), 1, 2]) for _ in range(12)]
        assert piece_tokens.decode_ids(ids, vocabulary) == library.decode(ids)


PAGE = """<html><head><title>T</title></head><body class="home"><header><a href=/>Site</a></header><nav>Menu one</nav>
<div id="wrap"><div class="sidebar">Side text that is long enough to matter here</div>
<div class="cookie-notice">We use cookies, accept them all now please</div>
<div class="post"><h1>Title here</h1><p>First   paragraph with <b>bold</b> and a <a href=x>link</a>, text &amp; more &lt;tags&gt;.
</p><p>Second paragraph, also long enough to be counted as text.</p><ul><li>one item<li>two items</ul>
<form>name <input> <button>Go</button></form></div>
<div id="comments"><p>Nice post! I really liked it a lot, thanks to the author for that.</p></div></div>
<footer>Copyright</footer><script>var x="<p>no</p>";</script></body></html>"""


@pytest.mark.parametrize("page, text", [
    (PAGE, "Title here First paragraph with bold and a link, text & more <tags>. Second paragraph, also long enough "
           "to be counted as text. one item two items"),
    (None, ""), ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a b"), ("<a <b>q", "q"), ("a < b & c", "a < b & c"),
    ("<body>" + "<div>" * 5000 + "x", "x"), ("<article><p>one</article><footer>f</footer><p>after", "one"),
    ("<article><header><h1>Hd</h1><i>by</i></header><p>x&#233;&nbsp;y</p></article>", "Hd xé\xa0y"),
    ("<script>a</script><style>b</style>", ""), ("<p>" + "long " * 50000 + "</p>", ("long " * 50000).strip()),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


LINES = [f"Paragraph {k} of the story, which is long enough to be counted as text of its own." for k in range(10)]
STORY = "".join(f"<p>{line}</p>" for line in LINES)


def test_a_teaser_is_not_the_article():
    page = f"<body><div class=post><h1>Head</h1>{STORY}<div><article>teaser of another story</article></div></div></body>"
    assert html_text.main_text(page) == " ".join(["Head", *LINES, "teaser of another story"])
    page = f"<body><div id=wrap><p>Lead in.</p><article><h1>Head</h1>{STORY}</article><p>Lead out.</p></div></body>"
    assert html_text.main_text(page) == " ".join(["Head", *LINES])


SIDE = "<div class=sidebar><p>Side text that is long enough to matter here.</p></div>"


@pytest.mark.parametrize("wrapper", [
    '<div id="content" class="has-sidebar">', '<div class="no-sidebar">', '<div class="content right-sidebar">',
    '<section class="social-science">', '<form action="/x">', '<div class="widget">', '<div id="nav-wrap">',
    '<div class="post comments-open">', '<span class="sidebar-layout">',
])
def test_wrappers_named_like_furniture_stay(wrapper):
    tag = wrapper[1:].split()[0]
    page = f"<body>{wrapper}<div><h1>Head</h1>{STORY}</div>{SIDE}</{tag}><div class=comments><p>Nice post.</p></div></body>"
    assert html_text.main_text(page) == " ".join(["Head", *LINES])


def test_furniture_still_goes():
    talk = "<p>A reader's comment that is quite long, longer than most paragraphs of the story are, and more.</p>" * 12
    side = "<div class='right-sidebar'><p>Side text in a box that stands at the right.</p></div>"
    page = f"<body><div class=post><h1>Head</h1>{STORY}{side}</div><div id=comments>{talk}</div><form>{SIDE}</form></body>"
    assert html_text.main_text(page) == " ".join(["Head", *LINES])


@pytest.mark.parametrize("before, after", [
    ("<p>One <span class=ad>buy<p>", "One"), ("<ul><li>One <b class=promo>buy <i>it</i><li>two</ul>", "One two"),
    ("<p>One <span class=share><script>'</span>'</script>x</span> end</p>", "One end"),
    ("<span class=ad>buy", ""), ("<span class=ad><div>buy</div></span>", ""), ("<p>One <span class=ad>buy <span>it</span> x</p>", "One"),
])
def test_unclosed_inline_furniture_ends_with_its_block(before, after):
    page = f"<body><div>{before}{STORY}</div></body>"
    assert html_text.main_text(page) == " ".join([*after.split(), *LINES])


def test_extract(spark, sf):
    import html
    import re

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    odd = spark.createDataFrame([(None, None, None), (-1, "u", ""), (-1, "u", "")], pages.schema)
    found = html_text.extract(pages.unionByName(odd).withColumn("text", F.lit("clash"))).collect()
    assert len(found) == pages.count() + 3 and all(r.n_chars == len(r.text) for r in found)
    got = {r.page_id: r.text for r in found}
    for page in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page.html, re.S)[1]
        bare = html.unescape(re.sub(r"<[^>]*>?", "", re.sub(r"</?(?:p|h1|br)>", " ", inner)))
        assert got[page.page_id] == re.sub(r"[ \t\n\r\f]+", " ", bare).strip()
    assert html_text.extract(pages.limit(0)).isEmpty()


def test_archive_round_trip(spark, sf, monkeypatch):
    big = "x" * 1500 + "é"
    extra = [(10**6 + i, f"http://a/{i}", big) for i in range(5)]
    extra += [(10**7, None, None), (10**7 + 1, "u\r\n%0A: x", ""), (None, "n", big), (10**6 + 4, "dup", big)]
    extra += [(10**7 + 2, "s", "short"), (10**7 + 3, "s", "short")]
    pages = spark.read.parquet(f"{sf}/pages.parquet").unionByName(
        spark.createDataFrame(extra, "page_id long, url string, html string")
    ).withColumn("payload", F.lit(1))
    folder = tempfile.mkdtemp(prefix="run-")
    index = warc.write(pages, folder)
    found = warc.read(index, folder).collect()
    assert len(found) == pages.count() == index.count()
    of = {(r.page_id, r.url): r for r in found}
    for page in pages.collect():
        r, raw = of[page.page_id, page.url], (page.html or "").encode()
        assert (r.payload_bytes, r.payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
        revisit = page.html == big and page.page_id is not None and page.page_id < 10**6 + 4
        assert (r.record_type, r.refers_to) == (("revisit", 10**6 + 4) if revisit else ("response", None))
        assert r.payload == (None if revisit else raw)
    assert warc.read(warc.write(pages.limit(0), tempfile.mkdtemp(prefix="run-")), folder).isEmpty()


def test_archive_query_equals_its_sql(spark, sf):
    import duckdb

    from tallyline.llm.oracles import oracle_sql
    from tallyline.llm.queries import queries

    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet'")
    twin = con.sql(oracle_sql()["op8_warc"])
    found = queries()["op8_warc"](spark, sf)
    assert list(found.columns) == list(twin.columns)
    assert sorted(map(tuple, found.collect())) == sorted(twin.fetchall())


def test_bundles_are_plain_zstandard(tmp_path, monkeypatch):
    import zstandard

    monkeypatch.setattr(warc, "FRAME_BYTES", 2000)
    bundles = warc.Bundles(str(tmp_path))
    raws = [warc.record(i, "u", b"p" * 700, 700, hashlib.sha1(b"p" * 700).hexdigest(), None) for i in range(10)]
    rows = [row for i, raw in enumerate(raws) for row in bundles.add(i, raw)] + bundles.frame()
    bundles.close()
    raw = (tmp_path / rows[0][1]).read_bytes()
    assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read() == b"".join(raws)
    assert len({row[2] for row in rows}) > 2 and {row[0] for row in rows} == set(range(10))


def auc(scores, labels):
    order = np.argsort(np.argsort(scores)) + 1
    ones = labels.sum()
    return (order[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


def held_out(spark, operator, label, folder="/root/testdata/sf0.1"):
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    found = operator.rate(docs, operator.train(docs, labels)).toPandas()
    assert (found.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in found.doc_id]).all()
    assert found.score.between(0, 1).all()
    both = found.merge(labels.toPandas(), on="doc_id")
    both = both[both.held_out]
    return both, auc(both.score.to_numpy(), both[label].to_numpy())


def test_toxicity_held_out(spark):
    both, area = held_out(spark, toxicity, "toxic")
    assert area > 0.97
    assert both[both.toxic == 0].predicted.mean() < 0.01 and both[both.toxic == 1].predicted.mean() > 0.75


def test_quality_held_out(spark):
    both, area = held_out(spark, compression_quality, "quality")
    assert area > 0.97
    assert both[both.quality == 1].predicted.mean() > 0.98 and both[both.quality == 0].predicted.mean() < 0.4


@pytest.mark.parametrize("operator", [toxicity, compression_quality])
def test_classifiers_on_odd_rows(spark, operator):
    rows = [(1, None), (2, ""), (None, "text"), (3, "x " * 50000), (3, "x " * 50000)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, label int")
    kinds = "doc_id long, quality int, toxic int"
    for known in ([], [(1, None, None)], [(3, 1, 0), (3, 0, 1)], [(i, 1, 1) for i in (1, 2, 3)]):
        model = operator.train(docs, spark.createDataFrame(known, kinds))
        found = operator.rate(docs, model).collect()
        assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert operator.rate(docs.limit(0), model).isEmpty()


def test_labels_of_the_held_out_fold_are_never_learnt(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    other = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.train(docs, labels), toxicity.train(docs, other)
    assert a.bias == b.bias and (a.weights == b.weights).all()
