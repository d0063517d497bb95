"""Vector search, archives and page texts against brute force and round trips."""

import io
import struct

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from lakeloom.llm import pagetext, vptree, warc

VECTORS = "vec_id bigint, embedding array<float>, shard string, file string, score double"


def brute(rows, asks, k):
    out = set()
    good = [
        (i, np.array(v, np.float64), n)
        for n, (i, v) in enumerate(rows)
        if v and None not in v and np.isfinite(v).all() and np.any(v)
    ]
    for i, v, n in good:
        if i is None or not asks(i):
            continue
        near = []
        for j, w, m in good:
            if m != n and len(v) == len(w):
                near.append((-vptree.cosines(v[None], w[None])[0], j is None, j, m))
        near.sort()
        out |= {(i, r + 1, x[2], -x[0]) for r, x in enumerate(near[:k])}
    return out


def test_exact_search_with_ties_and_odd_vectors(spark, path):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # a very common vector
    rows += [(2000, None), (2010, []), (2020, [0.0] * 6), (2030, [float("nan")] * 6), (2040, [None] * 6)]
    rows += [(2050, [float("inf")] + [1.0] * 5), (2060, [1.0, 2.0]), (2070, [2.0, 1.0]), (None, rows[3][1])]
    df = spark.createDataFrame([(i, v, "x", "y", 0.5) for i, v in rows], VECTORS)
    df.coalesce(3).write.parquet(path("v"))
    df = spark.read.parquet(path("v"))
    asks = F.col("vec_id") % 10 == 0
    for sizes in ({}, {"shard_rows": 90, "block_rows": 17}):
        found = vptree.nearest(df, asks, 5, **sizes).collect()
        got = {(r.query_id, r.rank, r.vec_id, r.score) for r in found}
        rows32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
        assert got == brute(rows32, lambda i: i % 10 == 0, 5)
    assert vptree.nearest(df.where("vec_id < 0"), asks, 5).count() == 0


def test_a_relaxed_bound_prunes_and_still_finds_most():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 24)) * 3
    x = centres[rng.integers(20, size=4000)] + rng.normal(size=(4000, 24))
    units = vptree._units(x)
    tree, own = vptree.Tree(units, leaf=64), np.arange(0, 4000, 50)
    exact = np.argsort(-(units[own] @ units.T) + 9 * (own[:, None] == np.arange(4000)), axis=1)[:, :5]
    for factor, least in ((1.0, 1.0), (1.3, 0.9)):
        query, row = tree.search(units[own], own, 5, factor)
        hits = set(zip(query.tolist(), row.tolist(), strict=True))
        recall = np.mean([(q, r) in hits for q in range(len(own)) for r in exact[q].tolist()])
        assert recall >= least


PAGES = "page_id bigint, url string, html string, payload string, first string"


def test_archive_round_trip(spark, path):
    long, copy = "<p>é🙂 " * 200_000, "<p>" + "same text " * 30
    rows = [(3, "http://a/ b\r\nX: 1", copy), (1, None, copy), (1, None, copy), (None, "u", copy)]
    rows += [(5, "u", None), (6, "u", ""), (7, "u", "small"), (8, "u", "small"), (9, "u", long)]
    rows += [(100 + i, "u", f"<p>{i} " + "page " * 50) for i in range(40)]
    spark.createDataFrame([(*r, "p", "f") for r in rows], PAGES).coalesce(3).write.parquet(path("p"))
    pages = spark.read.parquet(path("p"))
    manifest = warc.write(pages, archive_bytes=2000)
    assert manifest.count() > 3
    found = warc.read(manifest, payload=True).collect()
    assert len(found) == len(rows) and not any(r.error for r in found)
    kinds = sorted((r.page_id or "-", r.record_type, r.refers_to or "-") for r in found if r.payload_bytes == len(copy))
    assert kinds == [("-", "revisit", "1"), ("1", "response", "-"), ("1", "revisit", "1"), ("3", "revisit", "1")]
    stored = {int(r.page_id): bytes(r.payload).decode() for r in found if r.record_type == "response" and r.page_id}
    assert all(stored[i] == (h or "") for i, _, h in rows if i not in (1, 3, None))
    assert warc.read(warc.write(pages.where("page_id < 0"))).count() == 0


def test_wrong_records_are_told():
    row = {"page_id": 1, "url": "u", "payload": b"abc", "first": None, "file": 0, "at": 0}
    row["digest"] = "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    good = warc._record(row)
    assert warc.parse(good)["payload"] == b"abc"
    for bad in (
        good.replace(b"WARC/1.1", b"WARX/1.1"),
        good.replace(b"abc\r\n", b"abd\r\n"),
        good.replace(b"WARC-Date", b"WARC-Dote"),
        good[:-1],
        good.replace(b"Content-Length: 3", b"Content-Length: 4"),
    ):
        with pytest.raises(ValueError):
            warc.parse(bad)


def test_dictionary_frame_and_broken_archives():
    words = zstandard.train_dictionary(2000, [f"page {i} of the same kind {i * i}".encode() * 9 for i in range(200)])
    packer = zstandard.ZstdCompressor(dict_data=words)
    records = [b"a" * 10, b"", b"b" * 500_000]
    archive = warc._leading(words.as_bytes()) + b"".join(map(packer.compress, records))
    assert struct.unpack("<I", archive[:4])[0] == warc.SKIPPABLE
    assert list(warc.frames(io.BytesIO(archive))) == records
    with pytest.raises(Exception, match="not whole|early"):
        list(warc.frames(io.BytesIO(archive[:-5])))
    assert list(warc.frames(io.BytesIO(b""))) == []


def test_blocks_of_broken_markup():
    page = """<!DOCTYPE html><html><head><title>no</title><script>var t="</p>";</script></head>
    <body class=x><!-- <p>no</p> --><p>one &amp;amp; <b>two</b><br>three<p>four &#233;&nbsp; five
    <ul><li>a<li><a href='>'>b</a></ul><div data-x="a>b">six</div><textarea>no</textarea> 1 < 2 <p"""
    found = [b.text for b in pagetext.blocks(page)]
    assert found == ["one &amp; two three", "four é five", "a", "b", "six", "1 < 2 <p"]
    assert pagetext.blocks("") == [] and pagetext.blocks("<p>" * 5000 + "x")[0].text == "x"
    assert [b.linked for b in pagetext.blocks(page)][2:4] == [0, 1]


@pytest.fixture(scope="module")
def model(spark):
    return pagetext.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    pages = [rng.normal(size=(n, pagetext.INPUT)).astype(np.float32) for n in (4, 2)]
    truth = np.array([1, 0, 1, -1, 0, 1.0])
    h = pagetext.HIDDEN
    shapes = [(2, pagetext.INPUT, 4 * h), (2, h, 4 * h), (2, 4 * h), (2 * h + 1,)]
    parts = [rng.normal(0, 0.1, s) for s in shapes]
    grads, _ = pagetext._gradient(pagetext.Model(*parts), pages, truth)
    for part, grad in zip(parts, grads, strict=True):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old, loss = part[at], []
        for step in (1e-3, -1e-3):
            part[at] = old + step
            loss.append(pagetext._gradient(pagetext.Model(*parts), pages, truth)[1])
        part[at] = old
        assert abs((loss[0] - loss[1]) / 2e-3 - grad[at]) < 0.05 * abs(grad[at]) + 1e-4


def test_given_pages_and_unseen_layouts(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = pagetext.extract(pages, model).select("row.html", "text", "n_chars").collect()
    wrong = 0
    for r in rows:
        inside = r.html[r.html.index("<article>") : r.html.index("</article>")]
        wrong += r.text != "\n".join(b.text for b in pagetext.blocks(inside))
        assert r.n_chars == len(r.text)
    assert wrong <= len(rows) * 0.01
    texts = [line for r in rows[:50] for line in r.text.split("\n")]
    made, labels = pagetext.built(texts, 200, seed=99)
    chance = np.concatenate(pagetext.chances(model, [pagetext.vectors(p) for p in made]))
    truth = np.concatenate(labels)
    assert ((chance > 0.5) == truth)[truth >= 0].mean() > 0.98


def test_odd_pages(spark, model, path):
    rows = [(1, None), (2, ""), (3, "no markup at all"), (4, "<<<>>><p"), (5, "<p>x " * 30_000), (5, "")]
    spark.createDataFrame([(i, "u", h, "own") for i, h in rows], "page_id int, url string, html string, text string").write.parquet(path("o"))
    odd = spark.read.parquet(path("o"))
    found = pagetext.extract(odd, model).collect()
    assert sorted(r["row"].page_id for r in found) == [1, 2, 3, 4, 5, 5]
    assert {r["row"].text for r in found} == {"own"}
    assert [r.text for r in found if r["row"].page_id == 1] == [""]
    assert pagetext.extract(odd.where("page_id < 0"), model).count() == 0


def test_hidden_elements_end_with_their_parent():
    def texts(page):
        return [b.text for b in pagetext.blocks(page)]

    for name in ("button", "select", "object", "canvas", "svg", "template"):
        assert texts(f"<header><{name}>no<p>no</header><p>one</p><p>two") == ["one", "two"]
        assert texts(f"<header><{name}>no</header><p>one</p><{name}>no</{name}><p>two") == ["one", "two"]
        assert texts(f"<p>one <{name}><div>no</div><g>no</g></{name}> two</p>three") == ["one two", "three"]
    assert texts("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then") == ["if x=2 then"]
    assert texts("<p>one<script>no <p>no") == ["one"]


def test_nothing_is_lost_to_broken_heads_and_comments():
    def texts(page):
        return [b.text for b in pagetext.blocks(page)]

    assert texts("<html><head><title>T</title><article><p>Hello world</p></article>") == ["Hello world"]
    assert texts("<head><meta charset=x><style>no</style><p>one</head><body><p>two") == ["one", "two"]
    assert texts("<p>one</p><noscript><img><p>two") == ["one", "two"]
    assert texts("<p>one<noscript><p>no</noscript> two<noscript> three") == ["one two three"]
    assert texts("<header><noscript>no<p>no</header><p>one<noscript>no</noscript>") == ["one"]
    assert texts("<p>a</p><!--> <p>b</p><!---><p>c</p><!-- no --!><p>d") == ["a", "b", "c", "d"]
    assert texts("<noscript>" * 20_000 + "x") == ["x"]
