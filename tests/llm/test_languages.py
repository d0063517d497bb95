"""Character n-grams and learning steps against plain Python, line cuts and vectors of extreme size."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import langid, lines, vptree, warc

TEXTS = ["", " ", "a", "Ab", "don't stop", "жизнь и судьба", "日本語のテキスト", "x" * 9, "é 1 ü", "🙂 ok", "of it of it"]


def plain_grams(text):
    words = "".join(c if c.isalpha() or ord(c) > 127 else " " for c in text.lower())
    kept = [c for i, c in enumerate(words) if c != " " or i == 0 or words[i - 1] != " "]
    padded = f" {''.join(kept).strip(' ')} " if any(c != " " for c in kept) else "  "
    return Counter(padded[i : i + n] for n in langid.GRAMS for i in range(len(padded) - n + 1))


def number(gram):
    """The feature of one n-gram, by itself."""
    return int(langid._hashes(np.array([ord(c) for c in gram], np.uint32))[len(gram) - 1, -1])


def test_features_are_those_of_characters():
    for text, (at, logs) in zip(TEXTS, langid.features([t.lower() for t in TEXTS]), strict=True):
        expected = defaultdict(int)
        for gram, n in plain_grams(text).items():
            expected[number(gram)] += n
        assert dict(zip(at.tolist(), np.round(np.expm1(logs)).astype(int).tolist(), strict=True)) == expected


def test_long_texts_are_counted_in_runs(monkeypatch):
    text = " ".join(TEXTS * 20).lower()
    whole = langid.features([text])[0]
    monkeypatch.setattr(langid, "RUN", 37)
    parts = langid.features([text])[0]
    assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])


def test_learning_steps_are_the_plain_ones():
    found = langid.features(["ab ba", "ж ж", "ab", "жж ж", "ba ab a"])
    labels, idf = ["x", "y", "x", "y", "x"], np.linspace(1, 2, langid.WIDTH)
    alpha, beta, l1, l2 = 0.5, 1.0, 0.02, 1e-3
    model = langid.fit(found, labels, idf, epochs=2, alpha=alpha, beta=beta, l1=l1, l2=l2)
    z, n = defaultdict(float), defaultdict(float)

    def weight(i, c):
        if abs(z[i, c]) <= l1:
            return 0.0
        return -(z[i, c] - math.copysign(l1, z[i, c])) / ((beta + math.sqrt(n[i, c])) / alpha + l2)

    order = np.random.default_rng(7).permutation(5)
    for _ in range(2):
        for row in order[1:]:
            at, logs = found[row]
            raw = {int(i): float(v) * idf[i] for i, v in zip(at, logs, strict=True)}
            size = math.sqrt(sum(v * v for v in raw.values()))
            x = {i: v / size for i, v in raw.items()} | {langid.WIDTH: 1.0}
            w = {(i, c): weight(i, c) for i in x for c in (0, 1)}
            scores = [math.exp(sum(w[i, c] * v for i, v in x.items())) for c in (0, 1)]
            for c in (0, 1):
                slope = scores[c] / sum(scores) - (labels[row] == "xy"[c])
                for i, v in x.items():
                    g = slope * v
                    sigma = (math.sqrt(n[i, c] + g * g) - math.sqrt(n[i, c])) / alpha
                    z[i, c] += g - sigma * w[i, c]
                    n[i, c] += g * g
    used = {i for row in found for i in row[0].tolist()} | {langid.WIDTH}
    for i in used:
        assert np.allclose(model.weights[i], [weight(i, 0), weight(i, 1)], atol=1e-12)
    assert langid.fit([], [], idf).langs == []


def test_cosines_of_extreme_vectors():
    rows = np.array([[1e200, 1e200], [1e-200, 0], [5e-324, 5e-324], [1.7e308, 0], [3.0, 4.0]])
    a, b = np.repeat(rows, 5, axis=0), np.tile(rows, (5, 1))
    exact = [math.cos(math.atan2(*x[::-1]) - math.atan2(*y[::-1])) for x, y in zip(a, b, strict=True)]
    assert np.allclose(vptree.cosines(a, b), exact, atol=1e-12)


def test_cut_of_a_document_of_many_lines(spark, documents, monkeypatch):
    many = [f"line {i} of the many" if i % 3 else "a line that comes again" for i in range(30_000)]
    df = documents([(1, "\n".join(many), "en", "a")])
    gone = spark.createDataFrame([(i,) for i in range(3, 30_000, 3)], "i int").agg(F.collect_list("i").alias("gone"))
    row = lines.located(df).join(gone).select("file", "at", "gone")
    monkeypatch.setattr(lines, "repeated", lambda *_a, **_k: row)
    found = lines.dedup(df).collect()[0]
    assert found.removed == 9_999
    assert found.clean == "\n".join(x for i, x in enumerate(many) if i == 0 or i % 3)


@pytest.mark.parametrize("copies", [1, 40])
def test_dictionary_is_that_of_different_payloads(spark, copies):
    rows = [(f"<p>page {i} of one kind, number {i * i}</p>" * 30,) for i in range(60)]
    words = warc.dictionary(spark.createDataFrame(rows * copies, "html string"))
    assert words and words == warc.dictionary(spark.createDataFrame(rows[::-1], "html string"))
