"""Exact nearest rows, fill-in-middle and lexical search against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from lakeloom.llm import fim, lexical, voronoi
from lakeloom.shared import materialize
from pyspark.sql import functions as F

VECTORS = "vec_id bigint, embedding array<double>, file string, at string, cell string, v string"


def vectors(spark, rows):
    full = [(i, v, "own", "own", "own", "own") for i, v in rows]
    return materialize(spark.createDataFrame(full, VECTORS), "vectors")


def python_products(rows, k, divisor=5):
    good = [
        (n, i, [math.floor(256 * x) for x in v])
        for n, (i, v) in enumerate(rows)
        if v is not None and all(x is not None and math.isfinite(256 * x) for x in v)
    ]
    found = []
    for n, i, q in good:
        if i is None or i % divisor:
            continue
        near = [
            (max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(q, v, strict=True)))), j)
            for m, j, v in good
            if m != n and len(v) == len(q)
        ]
        near.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        found += [(i, r + 1, j, s) for r, (s, j) in enumerate(near[:k])]
    return Counter(found)


def found_products(spark, rows, k, **options):
    made = voronoi.largest_products(vectors(spark, rows), F.col("vec_id") % 5 == 0, k, **options)
    return Counter(tuple(r) for r in made.select("query_id", "rank", "vec_id", "score").collect())


def clustered(seed, n=900):
    """Clusters far apart, with norms of many sizes, ties and repeated rows."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 6)) * rng.uniform(0.5, 40, size=(12, 1))
    points = centres[rng.integers(12, size=n)] + rng.normal(size=(n, 6)) * 0.05
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    return rows + [(i + n, rows[3][1]) for i in range(60)] + rows[10:20]


@pytest.mark.parametrize("seed", [1, 2])
def test_products_are_those_of_all_pairs(spark, seed):
    rows = clustered(seed)
    # Many small blocks and pieces, so that the bounds decide what is copied.
    found = found_products(spark, rows, 5, pivots=40, block_rows=7, piece_rows=50)
    assert found == python_products(rows, 5)


def test_rows_out_of_reach_are_not_copied(spark):
    rows = [(i, [1000.0 * (i % 2), i * 1e-4, 1.0]) for i in range(0, 1000)]
    kept = materialize(
        vectors(spark, rows).select("vec_id", F.col("embedding").alias("v"), (F.col("vec_id") % 5 == 0).alias("asks"), F.lit(3).alias("width")),
        "rows",
    )
    pivots = np.array([[0.0, 0.0, 256.0], [256000.0, 0.0, 256.0]])
    placed = kept.select("*", voronoi.nearest_pivot(F.col("v"), pivots, 256.0).alias("c")).select("*", "c.*")
    _, routes, _ = voronoi._routes(materialize(placed, "placed"), pivots, 5, 10, 1000)
    # Queries with a large first component never need the vectors without one.
    reached = {(r.cell, r.block) for r in routes.collect()}
    assert {c for c, b in reached if b >= 11} == {1}


def test_products_of_odd_vectors(spark):
    rows = [(0, None), (5, []), (10, []), (15, [None, 1.0]), (20, [float("nan"), 1.0]), (25, [float("inf"), 0.0])]
    rows += [(30, [0.0, 0.0]), (35, [0.5, -0.001]), (35, [0.5, -0.001]), (None, [3.0, 3.0]), (41, [1.0, 2.0])]
    rows += [(45, [1e9, -1e9]), (46, [1e300, 1.0]), (47, [1e307, 1.0]), (50, [1.0, 2.0, 3.0])]
    assert found_products(spark, rows, 3) == python_products(rows, 3)
    assert found_products(spark, [(1, [1.0])], 3) == Counter()
    assert not vectors(spark, rows).where("false").isEmpty() or found_products(spark, [], 3) == Counter()


def test_exact_products_of_large_numbers():
    a = np.array([[3e15, 7.0], [2.0**40, -5.0], [1.0, 2.0], [1e200, 0.0]])
    got = voronoi.products(a, a)
    for i, x in enumerate(a):
        for j, y in enumerate(a):
            exact = sum(int(p) * int(q) for p, q in zip(x, y, strict=True))
            assert got[i, j] == max(-(2**63), min(2**63 - 1, exact))


def python_fim(i, text, rate=100, spm_rate=50):
    units = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    d = hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text or ""
    if h[3] % 100 < spm_rate:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_texts():
    rng = random.Random(11)
    texts = [None, "", "\n", "\n\n\n", "a", "a\n", "\na", "<P>\nx", "x<M", "<", "é\n日本\n🙂", "\u0000\n\u000bĊ\nਊ"]
    texts += ["".join(rng.choices("ab\n\n<PSM>é日🙂", k=rng.randint(1, 60))) for _ in range(400)]
    return [*texts, "word\n" * 100_000, "x" * 300_000, "🙂" * 99_999 + "\n"]


@pytest.mark.parametrize("options", [{}, {"rate": 40, "spm_rate": 10}])
def test_fill_in_middle_is_the_plain_one(spark, documents, options):
    texts = fim_texts()
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(None, "no\nid\n", "x", "y")]
    made = fim.transform(documents(rows), **options)
    back = fim.restored(F.col("output"), F.col("form")).alias("back")
    got = made.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", "output", back).collect()
    assert len(got) == len(rows)
    by_id = {i: t for i, t, _, _ in rows}
    for r in got:
        assert tuple(r)[1:6] == python_fim(r.doc_id, by_id[r.doc_id], **options)
        assert r.back == (by_id[r.doc_id] or "")


def test_marks_rank_and_select():
    rng = np.random.default_rng(3)
    for _ in range(50):
        data = rng.choice(np.array([10, 9, 11, 138, 0, 65], np.uint8), rng.integers(1, 90)).tobytes()
        marks = fim.Marks(fim.line_ends(fim.as_words(data)))
        at = [i for i, b in enumerate(data) if b == 10]
        assert marks.select(np.arange(len(at))).tolist() == at
        assert marks.rank(np.arange(len(data) + 1)).tolist() == [data[:i].count(10) for i in range(len(data) + 1)]
        starts = fim.Marks(fim.character_starts(fim.as_words(data)))
        assert starts.rank(np.array([len(data)]))[0] == sum(b & 0xC0 != 0x80 for b in data)


PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def python_terms(text):
    return PATTERN.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def python_search(docs, items, k):
    counts = [(i, Counter(python_terms(t))) for i, t in docs]
    sizes = [c.total() for _, c in counts]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    found = []
    for item, text in items:
        scored = []
        for (i, c), size in zip(counts, sizes, strict=True):
            m = 50 + (50 * size * n) // max(1, total)
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(python_terms(text))
                if t in c
            )
            if score:
                scored.append((-score, i is None, i or 0, i))
        found += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k])]
    return Counter(found)


def search_rows():
    rng = random.Random(5)
    words = [f"w{x}" for x in range(60)] + ["the"] * 30 + ["ünï", "日本", "A1b"]
    docs = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40)))) for i in range(400)]
    docs += [(900, None), (901, ""), (902, "-- !"), (None, "the w1 w2"), (903, "the w1 w2"), (903, "THE w1,w2"), (904, "w3 " * 200_000)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(50)]
    items += [(60, None), (61, "?!"), (62, "absent words only"), (None, "the w1"), (1, items[0][1]), (63, items[0][1])]
    return docs, items


@pytest.mark.parametrize("block", [1024, 9])
def test_search_is_the_plain_one(spark, documents, block):
    docs, items = search_rows()
    frame = documents([(i, t, "en", "a") for i, t in docs])
    asked = spark.createDataFrame([(i, t, "own") for i, t in items], "item_id bigint, text string, terms string")
    found = lexical.search(frame, asked, 7, block_items=block)
    got = Counter(tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect())
    assert got == python_search(docs, items, 7)


def test_search_of_empty_tables(spark, nothing, odd):
    items = spark.createDataFrame([(1, "cat")], "item_id bigint, text string")
    assert lexical.search(nothing, items).count() == 0
    assert lexical.search(odd, items.where("item_id > 1")).count() == 0
    assert lexical.search(odd, items).count() == 4
    assert fim.transform(nothing).count() == 0


def test_shared_sets_add_up():
    rng = random.Random(2)
    items = [rng.sample(range(30), rng.randint(0, 12)) for _ in range(40)] + [list(range(15))] * 3
    for mined in (4, 256):
        shared = lexical.Shared(items, 30, mined)
        assert shared.made
        holds = {t: Counter([t]) for t in range(30)}
        for k, (a, b) in enumerate(shared.made):
            holds[30 + k] = holds[a] + holds[b]
        for have, left in zip(items, shared.left, strict=True):
            assert sum((holds[p] for p in left), Counter()) == Counter(have)
        adds = len(shared.made) + sum(max(0, len(x) - 1) for x in shared.left)
        assert adds < sum(max(0, len(x) - 1) for x in items)


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = "Abc défg, 12 x" * 50
    whole = lexical.term_counts(text.encode())
    monkeypatch.setattr(lexical, "_CHUNK", 7)
    assert lexical.term_counts(text.encode()) == whole == Counter(t.encode() for t in python_terms(text))
