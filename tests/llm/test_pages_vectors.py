"""Archives, main texts and nearest neighbours against plain Python."""

from __future__ import annotations

import base64
import hashlib
import html as entities
import random
import re

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from jobtide.llm import onebit, warc, wrappers

SF_DIR = "/root/testdata/sf0.001"


# Archives --------------------------------------------------------------------------------------


def page_rows():
    rng = random.Random(1)
    rows = [(i, f"https://h{i % 3}.example/{i}", "<p>" + " ".join(rng.choices(["é", "word", "x", "\r\n\r\n", "☃"], k=rng.randint(0, 400)))) for i in range(60)]
    rows += [(100 + i, "https://copy.example/", "<p>copied</p>") for i in range(25)]
    rows += [(200, None, None), (201, "bad url \n\x7f: é", ""), (202, "", ""), (None, "u", "<p>copied</p>"), (None, "u", "only here"), (203, "long", "y" * 3_000_000)]
    return [*rows, (5, "again", rows[5][2]), (5, "again", rows[5][2]), (6, "again", rows[5][2])]


def archived(rows):
    last = {}
    for i, _, text in rows:
        key = text or ""
        if i is not None:
            last[key] = max(last.get(key, i), i)
    out = []
    for i, _, text in rows:
        data, response = (text or "").encode(), last.get(text or "")
        kind = "response" if response is None or i == response else "revisit"
        sha = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), sha, kind, None if kind == "response" else response))
    return sorted(map(repr, out))


@pytest.fixture(scope="module")
def pages(spark):
    frame = spark.createDataFrame(page_rows(), "page_id long, url string, html string")
    return frame.withColumns({"sha": F.lit("mine"), "response": F.lit(-1), "payload": F.lit("x")})


def test_archives_come_back(spark, pages, tmp_path):
    path = str(tmp_path / "warc")
    warc.write(pages, path)
    back = warc.read(spark, path)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(repr(tuple(r)) for r in back.select(columns).collect()) == archived(page_rows())
    whole = {(r["page_id"], bytes(r["payload"])) for r in back.where("record_type = 'response'").collect()}
    assert whole <= {(i, (t or "").encode()) for i, _, t in page_rows()}


def test_small_payloads_are_all_responses(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "tiny"), (2, "u", "tiny"), (3, "u", "a longer one"), (4, "u", "a longer one")], "page_id long, url string, html string")
    warc.write(pages, str(tmp_path / "warc"), min_bytes=8)
    rows = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.read(spark, str(tmp_path / "warc")).collect()}
    assert rows == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


@pytest.mark.parametrize("bytes_each", [1, 2_000, 1 << 26])
def test_archives_are_bounded_and_each_has_its_dictionary(spark, tmp_path, bytes_each):
    given = spark.read.parquet(f"{SF_DIR}/pages.parquet").coalesce(1)
    warc.write(given, str(tmp_path / "warc"), archive_bytes=bytes_each)
    files = [f.read_bytes() for f in (tmp_path / "warc").rglob("*.txt")]
    skipped = len(warc.EMPTY_SKIPPABLE.encode())
    counts = [len(list(warc.frames(data))) for data in files]
    assert sum(counts) == given.count()
    assert {int.from_bytes(data[:4], "little") for data in files} == {warc.DICTIONARY_MAGIC}
    for data, n in zip(files, counts):
        head = 8 + int.from_bytes(data[4:8], "little")
        assert n == 1 or len(data) - skipped * (n + 1) < bytes_each + 20_000 + head
    assert (max(counts) == 1) == (bytes_each <= 2_000)  # the dictionary alone fills the small ones
    back = warc.read(spark, str(tmp_path / "warc")).select("page_id", "payload_bytes")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, given.selectExpr("page_id", "octet_length(coalesce(html, ''))").collect()))


def test_an_empty_table_gives_no_record(pages):
    assert warc.round_trip(pages.limit(0)).count() == 0


def archive(dictionary=b"", compress=False, count=3):
    trained = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    encoder = zstandard.ZstdCompressor(dict_data=trained)
    records = [warc.record(i, f"u{i}", bytes([65 + i]) * 200_000 * i, None, False) for i in range(count)]
    kept = zstandard.ZstdCompressor().compress(dictionary) if compress else dictionary
    head = warc.skippable(warc.DICTIONARY_MAGIC, kept) if dictionary else b""
    return records, head + b"".join(encoder.compress(r) + warc.EMPTY_SKIPPABLE.encode() for r in records)


@pytest.mark.parametrize("compress", [False, True])
def test_the_dictionary_leads_the_archive(compress):
    rng = random.Random(2)
    samples = [" ".join(rng.choices(["alpha", "beta", "<p>", "</p>", "gamma"], k=80)).encode() for _ in range(200)]
    dictionary = zstandard.train_dictionary(2048, samples).as_bytes()
    records, data = archive(dictionary, compress)
    assert list(warc.frames(data)) == records
    assert list(warc.frames(archive()[1])) == archive()[0]
    assert list(warc.frames(b"")) == []


def test_checksummed_and_streamed_frames_are_found():
    text = random.Random(3).randbytes(300_000)
    streamed = zstandard.ZstdCompressor(write_checksum=True, write_content_size=True).compress(text)
    assert warc.frame_end(memoryview(streamed + b"rest"), 0) == len(streamed)


@pytest.mark.parametrize("spoil", [lambda d: d[:-20], lambda d: d[:30], lambda d: b"junk" + d, lambda d: d + b"\x00"])
def test_broken_archives_raise(spoil):
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(warc.frames(spoil(archive()[1])))


@pytest.mark.parametrize(
    "spoil",
    [
        lambda r: r.replace(b"WARC/1.1", b"WARC/0.9"),
        lambda r: r[:-1],
        lambda r: r.replace(b"payload text", b"payload TEXT"),
        lambda r: r.replace(b"WARC-Date", b"X-Date"),
        lambda r: re.sub(rb"(msgtype=response\r\nContent-Length: )\d+", rb"\g<1>7", r),
        lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: metadata"),
    ],
)
def test_broken_records_raise(spoil):
    good = warc.record(1, "u", b"payload text", None, False)
    assert warc.parse(good)["payload"] == b"payload text"
    with pytest.raises(ValueError):
        warc.parse(spoil(good))


# Main text -------------------------------------------------------------------------------------


def test_main_text_of_whole_pages(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in wrappers.main_text(pages).collect()}
    for page_id, _, html in pages.select("page_id", "url", "html").collect():
        article = html.split("<article>")[1].split("</article>")[0]
        blocks = re.split("</?(?:p|h1)>", re.sub("</?b>", "", article))
        plain = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", block)).split()) for block in blocks]
        text = "\n\n".join(block for block in plain if block)
        assert got[page_id] == (text, len(text))


SURROUNDED = """<!doctype html><html><head><title>t</title><style>p{}</style></head><body class="home">
<header>site</header><nav><a>menu</a></nav><div id="cookie-notice">cookies</div><div class="sidebar"><p>side</p></div>
<%s><header><h1>Title &amp; more</h1></header><p>First <b>bold</b>&nbsp;text
 goes on<br>here.</p><script>var x = "<p>no</p>";</script><aside>no</aside><ul><li>one<li>two</ul><div class="share">no</div>
<form><input><p>no</p></form><p hidden>no</p><blockquote>said &lt;so&gt;</blockquote><!-- <p>no</p> --></%s>
<section class="comments"><article class="comment"><p>reader</p></article></section><footer>&copy; foot</footer></body></html>"""
MAIN = "Title & more\n\nFirst bold text goes on here.\n\none\n\ntwo\n\nsaid <so>"


@pytest.mark.parametrize("element", ["article", "main", 'div class="post content"', "section role=main"])
def test_everything_around_the_article_goes(element):
    page = SURROUNDED % (element, element.split()[0])
    assert wrappers.extract(page, None) == MAIN
    assert wrappers.extract(page, wrappers.compact(wrappers.infer([page, page.replace("First", "Other")]))) == MAIN


def test_pages_align_to_optional_and_repeated_groups():
    a = "<body><nav>x</nav><article><h1>A</h1><p>1</p><p>2</p></article></body>"
    b = "<body><article><h1>B</h1><p>1</p><div><i>z</i></div></article><footer>f</footer></body>"
    [body] = wrappers.compact(wrappers.infer([a, b]))[3]
    assert [(c[0], c[1], c[2]) for c in body[3]] == [("nav", "?", 2), ("article", "", 1), ("footer", "?", 2)]
    assert [(c[0], c[1]) for c in body[3][1][3]] == [("h1", ""), ("p", "+"), ("div", "?")]


def test_a_page_unlike_its_host_is_read_by_the_rules():
    wrapper = wrappers.compact(wrappers.infer(["<body><article><p>a</p></article></body>"] * 3))
    assert wrappers.extract("<body><nav>n</nav><div><p>plain</p></div></body>", wrapper) == "plain"
    assert wrappers.extract("<body><article><p>a<section><table><tr><td>c<td>d</table></section></article>", wrapper) == "a\n\nc\n\nd"


def test_what_all_pages_of_a_template_say_goes():
    """No name tells the template's blocks from the text: only the wrapper does."""
    page = "<title>%s</title><body><article><h1>%s</h1><div>Read more from us</div><p>One %s.</p><p>Two %s.</p><div><ul><li>About<li>Terms</ul></div></article></body>"
    pages = [page % ((name,) * 4) for name in ("a", "b", "c", "d")]
    wrapper = wrappers.compact(wrappers.infer(pages))
    assert [wrappers.extract(p, wrapper) for p in pages[:2]] == ["a\n\nOne a.\n\nTwo a.", "b\n\nOne b.\n\nTwo b."]
    assert wrappers.extract(pages[0].replace("Read more", "Unlike others"), wrapper) == "a\n\nUnlike others from us\n\nOne a.\n\nTwo a."
    copies = [pages[0].replace("One", name) for name in ("One", "1", "I")]  # of one title
    assert wrappers.extract(copies[0], wrappers.compact(wrappers.infer(copies))) == wrappers.extract(copies[0], None)
    same = ["<title>%d</title><body><article><p>nothing else</p></article></body>" % n for n in range(4)]
    assert wrappers.extract(same[0], wrappers.compact(wrappers.infer(same))) == "nothing else"


def test_ids_in_an_article_are_anchors():
    page = '<body><div id="related">no</div><article><h2 id="related-work">Related work</h2><section id="search"><p>text</p></section></article></body>'
    assert wrappers.extract(page, None) == "Related work\n\ntext"


def test_blocks_of_all_pages_of_a_host_go(spark):
    rows = [(n, "http://h/x", f"<title>{n}</title><body><div>Site</div><div><p>plain {n}</p></div></body>") for n in range(40)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for parts in (1, 5):
        assert {r["page_id"]: r["text"] for r in wrappers.main_text(frame.repartition(parts)).collect()} == {n: f"plain {n}" for n in range(40)}


def test_each_template_of_a_host_has_its_wrapper(spark):
    """Many pages without an article do not decide for the one page with it, nor the other way round."""
    plain = [(n, "http://h/x", f"<title>{n}</title><body><div><p>plain {n}</p></div></body>") for n in range(60)]
    other = (100, "http://h/x", "<title>o</title><body><div>aside</div><article><header><h1>Head</h1></header><p>text</p></article></body>")
    deep = (101, "http://h/x", "<title>d</title><body><p>no</p>" + "<div>" * 70 + "<article><p>deep</p></article></body>")
    frame = spark.createDataFrame([*plain, other, deep], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in wrappers.main_text(frame.repartition(5)).collect()}
    assert got == {**{n: f"plain {n}" for n in range(60)}, 100: "Head\n\ntext", 101: "deep"}


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("<", "<"), ("a<b", "a"), ("plain &amp text &#x41;&eacute;", "plain & text Aé"), ("<p>a<p>b", "a\n\nb"),
        ("<body>x<header>h</header><p>z", "x\n\nz"), ("<b>" * 5000 + "deep", "deep"), ("<div>" * 3000 + "deep", "deep"),
        ("<article><p>cut off &am", "cut off &am"), ('<article><p title="a>b">q</p><p class=\'x', "q"), ("<article>" + "w " * 100_000, "w " * 99_999 + "w"),
        ("<script>never closed", ""), ("<body><SCRIPT>x</SCRIPT><P>Up</P>", "Up"), ("\x00<p>�", "\x00\n\n�"),
    ],
)
def test_odd_pages(spark, html, text):
    assert wrappers.extract(html or "", None) == text
    if html:
        assert wrappers.extract(html, wrappers.compact(wrappers.infer([html]))) == text


def test_main_text_keeps_rows(spark):
    rows = [(1, "http://a/x", "<article>one"), (1, "http://a/x", "<article>one"), (None, None, None), (2, "no url", "<p>two"), (3, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "wrapper": F.lit(2), "host": F.lit(3)})
    got = wrappers.main_text(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = [(1, "http://a/x", "one", 3)] * 2 + [(None, None, "", 0), (2, "no url", "two", 3), (3, "", "", 0)]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert wrappers.main_text(pages.limit(0)).count() == 0


# Nearest neighbours ----------------------------------------------------------------------------


def neighbours(vectors, queries, k):
    """By comparing with every vector, component after component."""
    out = {}
    for q in queries:
        scores = []
        for i, v in vectors.items():
            if i != q and len(v) == len(vectors[q]):
                total = 0.0
                for a, b in zip(vectors[q], v):
                    total += a * b
                scores.append((-total, i))
        out[q] = [(i, -s) for s, i in sorted(scores)[:k]]
    return out


def found(frame):
    out = {}
    for r in frame.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((4000, 64)), rng.standard_normal(64)
    packed, factor, off = onebit.codes(x)
    signs = np.unpackbits(packed, axis=1).astype(float) * 2 - 1
    error = ((signs @ (q @ onebit.rotation(64))) * factor - x @ q) / (np.linalg.norm(q) * off)
    assert abs(error.mean()) < 0.1 and error.std() < 1.1 and (np.abs(error) > onebit.DEVIATIONS).mean() < 0.002


@pytest.mark.parametrize("dim", [1, 3, 64, 300])
def test_neighbours(spark, monkeypatch, dim):
    monkeypatch.setattr(onebit, "LEAST_BLOCK", 100)
    rng = np.random.default_rng(dim)
    vectors = {int(i): v.tolist() for i, v in enumerate(rng.standard_normal((700, dim)).astype(np.float32))}
    for i in range(50, 90):
        vectors[i] = vectors[40]
    frame = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<float>").withColumns({"dim": F.lit(9), "block": F.lit("x")})
    indexed = onebit.index(frame)
    got = found(onebit.search(indexed, indexed.where("vec_id % 20 = 0"), 20))
    want = neighbours(vectors, range(0, 700, 20), 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.99 * 20 * len(want)
    for q in want:
        if [i for i, _ in got[q]] == [i for i, _ in want[q]]:
            assert got[q] == want[q]


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (20, [2.0, 1.0]), (21, [2.0, 1.0]), (40, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]), (22, [-1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    indexed = onebit.index(frame)
    got = found(onebit.search(indexed, indexed.where("vec_id % 20 = 0")))
    assert got == {0: [(20, 2.0), (21, 2.0), (22, -1.0)], 20: [(21, 5.0), (0, 2.0), (22, -2.0)]}
    nothing = onebit.index(frame.limit(0))
    assert onebit.search(nothing, nothing).count() == 0


@pytest.mark.parametrize("scale", [1e-38, 1e-25, 1.0, 1e20, 1e37, None])
def test_neighbours_of_any_finite_vectors(scale):
    """Also of very short, very long, and (None) both kinds of vectors in one block."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x = (x * (10.0 ** rng.uniform(-37, 37, 300)[:, None] if scale is None else scale)).astype(np.float32).astype(np.float64)
    ids = np.arange(300)
    query, of, _ = onebit.scan(ids, *onebit.codes(x), x, ids[::5], x[::5], 20)
    hits = 0
    for n, i in enumerate(ids[::5]):
        scores = onebit.exact(list(x.T), list(x.T), np.full(300, i), ids)
        scores[i] = -np.inf
        hits += len(set(of[query == n].tolist()) & set(np.lexsort((ids, -scores))[:20].tolist()))
    assert hits >= 0.995 * 60 * 20
