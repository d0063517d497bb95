"""Operators on documents against plain Python and held-out rows."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from compare import connect, differences
from pyspark.sql import functions as F

from lakeloom.llm import graph, lines, mixing, near, quality, queries, sentencepieces
from lakeloom.llm.common import table

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) == []


def components(edges, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {i: find(i) for i in ids}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(400, 460)]
    found = graph.components(spark.createDataFrame(edges, "a int, b int"))
    expected = components(edges, {x for e in edges for x in e if e[0] != e[1]})
    assert {r.id: r.root for r in found.collect()} == expected


def jaccard_classes(docs):
    sets = {}
    for i, t in docs:
        w = (t or "").lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    shared = Counter(p for ids in where.values() for p in combinations(sorted(ids), 2))
    links = [p for p, n in shared.items() if n >= 0.8 * (len(sets[p[0]]) + len(sets[p[1]]) - n)]
    return components(links, sets)


def test_near_classes_are_those_of_all_pairs(spark, documents):
    rng = random.Random(1)
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    base = rows[0][1].split() * 2
    for k in range(60):  # a large group of different near copies
        words = list(base)
        words[rng.randrange(len(words))] = f"edit{k}"
        rows.append((10_000 + k, " ".join(words)))
    found = near.classes(documents([(i, t, "en", "a") for i, t in rows]))
    assert {r.doc_id: r.class_id for r in found.collect()} == jaccard_classes(rows)


def test_sketches_estimate_probability_jaccard():
    rng = np.random.default_rng(2)
    a = {int(x): 1.0 + (x % 3) for x in rng.integers(1, 2**60, 300)}
    b = {k: v * (2 if k % 5 == 0 else 1) for k, v in list(a.items())[40:]}
    item = np.array([*a, *b], np.uint64)
    doc = np.array([0] * len(a) + [1] * len(b))
    weight = np.array([*a.values(), *b.values()])
    got = []
    for salt in range(20):
        made = near.sketches(2, doc, item ^ np.uint64(salt * 7919), weight)
        got.append((made[0] == made[1]).mean())
    every = set(a) | set(b)
    exact = sum(
        1 / sum(max(a.get(y, 0) / a[x], b.get(y, 0) / b[x]) for y in every) for x in a if x in b
    )
    assert abs(np.mean(got) - exact) < 0.03


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def python_simhash(words):
    """Six blocks of ten bits by the definition: weights of different words, drawn for each block."""
    bits = 0
    for j in range(6):
        total, held = 0, Counter()
        for w in set(words):
            h = xxhash.xxh64_intdigest(w.encode(), seed=42)
            seed = xxhash.xxh64_intdigest(j.to_bytes(4, "little"), seed=42)
            x = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed=seed)
            length = 1 if len(w) <= 4 else min(len(w), 31)
            weight = min((length << 16) // (1 + (x >> 48)), 65536) ** 2
            total += weight
            held.update({i: weight for i in range(10) if x >> i & 1})
        bits |= sum(1 << 10 * j + i for i in range(10) if 2 * held[i] > total)
    return bits


def linked_lines(keys):
    """All pairs of lines whose edit similarity is at least 0.8, by another engine."""
    import duckdb
    import pandas as pd

    lines_ = pd.DataFrame({"i": range(len(keys)), "t": keys})  # noqa: F841
    found = duckdb.sql(
        """WITH pairs AS (
             SELECT a.i, b.i AS j, a.t, b.t AS u, floor(greatest(length(a.t), length(b.t)) * 0.2 + 1e-9) AS most
             FROM lines_ a JOIN lines_ b ON a.i < b.i
             WHERE abs(length(a.t) - length(b.t)) <= greatest(length(a.t), length(b.t)) * 0.2 + 1e-9)
           SELECT i, j FROM pairs WHERE levenshtein(t, u) <= most"""
    ).fetchall()
    return [(keys[i], keys[j]) for i, j in found]


def test_lines_are_those_of_all_pairs(spark, documents):
    rng = random.Random(4)
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").limit(60).collect()]
    long = [f"w{rng.randrange(500)}" for _ in range(300)]
    short = "the second line that many documents have in common".split()
    for k in range(12):
        edited = [w if rng.random() > 0.01 else "edit" for w in long]
        other = [w if rng.random() > 0.1 else w[::-1] for w in short]
        rows.append((1000 + k, "Top\n" + " ".join(edited) + "\n\n  SHARED   line of all\t\n" + " ".join(other)))
    found = lines.dedup(documents([(i, t, "en", "a") for i, t in rows]))
    cleaned = {r.doc_id: r.clean for r in found.select("row.doc_id", "clean").collect()}
    places = [(i, n, " ".join(x.lower().split())) for i, t in rows for n, x in enumerate(t.split("\n"))]
    places = sorted(p for p in places if p[2])
    keys = sorted({p[2] for p in places})
    links = linked_lines(keys)
    assert links
    group, seen, gone = components(links, keys), set(), set()
    for i, n, key in places:
        if group[key] in seen:
            gone.add((i, n))
        seen.add(group[key])
    expected = {
        i: "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in gone) for i, t in rows
    }
    assert cleaned == expected


def test_simhashes_are_those_of_the_definition(spark):
    rng = random.Random(9)
    words = [f"w{k % 90}" for k in range(5000)]
    rows = [(1, words), (2, words[:100]), (3, ["a"]), (4, ["x" * 5000, "ü", "𝒳"])]
    rows += [(5 + k, ["w" * rng.randint(1, 40) + str(rng.random()) for _ in range(k)]) for k in range(1, 60)]
    df = spark.createDataFrame(rows, "id int, words array<string>")
    got = {r.id: r.simhash for r in lines.with_simhash(df).collect()}
    assert got == {i: python_simhash(w) for i, w in rows}
    assert got[1] == got[2]


def test_encoding_is_the_librarys(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    model = sentencepieces.Pieces(MODEL)
    rng = random.Random(5)
    texts = [r.text or "" for r in table(spark, SF, "documents").collect()]
    words = " ".join(texts).split()[:3000]
    alphabet = "aeth  inrso▁.,\n\té日🙂x0'\"<s>\0ﬁ»“"
    texts += ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += [rng.choice(["", " ", "\n"]).join(rng.choices(words, k=5)) for _ in range(2000)]
    texts.append("".join(words) * 3)
    for text in texts:
        ids = library.encode(text, add_bos=True, add_eos=True)
        mine = model.encode(text)
        assert np.frombuffer(mine, "<u4").tolist() == ids
        assert model.decode(mine) == library.decode(ids)


def test_mix_meets_targets(spark):
    rows = mixing.taken(table(spark, "/root/testdata/sf0.01", "documents")).toPandas()
    by = rows.groupby("source_size").agg(target=("target", "first"), taken=("taken", "sum"))
    assert ((by.taken - by.target).abs() <= 0.03 * by.target).all()
    assert abs(by.target.sum() - 1.5 * rows["size"].sum()) < 1e-6 * rows["size"].sum()
    assert (rows.taken <= 2 * rows["size"]).all()


def test_split_counts_are_exact_and_hypergeometric(spark):
    counts = spark.createDataFrame([(0, 40), (1, 7), (2, 0), (3, 53)], "ord int, draws int")
    firsts = []
    for seed in range(40):
        found = mixing.split_counts(counts, 5, seed).collect()
        assert {r.ord: sum(x.n for x in found if x.ord == r.ord) for r in found} == {0: 40, 1: 7, 2: 0, 3: 53}
        assert {sum(x.n for x in found if x.shard == s) for s in range(5)} == {20}
        firsts += [x.n for x in found if x.ord == 0]
    # Mean 8; variance of the hypergeometric law 100, 40, 20 is 3.88.
    assert abs(np.mean(firsts) - 8) < 1e-9 and 2.8 < np.var(firsts) < 5.1


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    rows = queries.QUERIES["op10_quality"](spark, sf).collect()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.97


def test_messages_are_those_of_all_labellings():
    rng = np.random.default_rng(0)
    emit, change = rng.normal(size=5), rng.normal(size=(2, 2))
    counts = np.array([2, 3])
    ahead, back = quality._messages(emit, counts, change)
    good = 1 / (1 + np.exp(-(ahead + back)))
    for first, n in ((0, 2), (2, 3)):
        total, each = 0.0, np.zeros(n)
        for bits in np.ndindex(*[2] * n):
            s = sum(emit[first + t] * b for t, b in enumerate(bits))
            s += sum(change[a, b] for a, b in zip(bits, bits[1:], strict=False))
            total += np.exp(s)
            each += np.exp(s) * np.array(bits)
        assert np.allclose(good[first : first + n], each / total)


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in table(spark, sf, "documents").collect()}
    rows = queries.QUERIES["op7_language_id"](spark, sf).collect()
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98


def edited_lines(rng, vocabulary):
    """(kind, line, edited line) of lines of 1 to 120 words."""
    made = []
    for least, most in ((1, 3), (4, 7), (8, 15), (16, 30), (31, 60), (61, 120)):
        for kind in ("letter", "dropped", "replaced", "tenth", "fifth"):
            for _ in range(25):
                words = rng.choices(vocabulary, k=rng.randint(least, most))
                edited = list(words)
                k = rng.randrange(len(words))
                if kind == "letter":
                    j = rng.randrange(len(words[k]))
                    edited[k] = words[k][:j] + "#" + words[k][j + 1 :]
                elif kind == "dropped":
                    del edited[k]
                else:
                    n = {"replaced": 1, "tenth": len(words) // 10, "fifth": len(words) // 5}[kind]
                    for k in rng.sample(range(len(words)), max(1, n)):
                        edited[k] = rng.choice(vocabulary)
                made.append(((least, kind), " ".join(words), " ".join(edited)))
    return made


def test_similar_lines_are_found_at_every_length(spark, documents):
    rng = random.Random(6)
    texts = [r.text or "" for r in table(spark, SF, "documents").collect()]
    vocabulary = sorted({w for w in " ".join(texts).lower().split()})
    pairs = []
    for kind, a, b in edited_lines(rng, vocabulary):
        most = int(max(len(a), len(b)) * 0.2 + 1e-9)
        if a != b and a and b and abs(len(a) - len(b)) <= most and levenshtein(a, b) <= most:
            pairs.append((kind, a, b))
    rows = [(2 * i + k, p[1 + k], "en", "a") for i, p in enumerate(pairs) for k in (0, 1)]
    found = lines.dedup(documents(rows)).where("removed > 0").select("row.doc_id").collect()
    gone = {r.doc_id for r in found}
    total, hits = Counter(), Counter()
    for i, (kind, _, _) in enumerate(pairs):
        total[kind] += 1
        hits[kind] += 2 * i + 1 in gone
    print({kind: f"{hits[kind]}/{n}" for kind, n in total.items()})
    for (least, kind), n in total.items():
        bound = 0.6 if kind == "fifth" else 0.9
        assert hits[least, kind] >= bound * n, (least, kind, hits[least, kind], n)


def test_near_copies_with_repeated_passages(spark, documents):
    rng = random.Random(8)
    rows = []
    for k in range(40):
        words = [f"w{k}x{i}" for i in range(84)]
        passage = [f"p{k}x{i}" for i in range(12)] * rng.choice([20, 100, 300, 1000])
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words + passage))]
    expected = jaccard_classes(rows)
    assert sum(i != c for i, c in expected.items()) == 40
    found = near.classes(documents([(i, t, "en", "a") for i, t in rows]))
    assert {r.doc_id: r.class_id for r in found.collect()} == expected


def test_the_encoder_remembers_a_word_once():
    model = sentencepieces.Pieces(MODEL)
    texts = ["some words, (some) words. some-words 'words' Some", "words,words ,words words\nwords,\n,words\n\nwords", "ünï, ünï ¿ünï? 12,5 a,b a"]
    for t in texts:
        expected = model.library.encode(t, add_bos=True, add_eos=True)
        assert np.frombuffer(model.encode(t), "<u4").tolist() == expected
    bare = {w[1:] for w in model.encoded if w[0] == sentencepieces.SPACE}
    assert not bare & set(model.spaced) and "words" in model.spaced


def test_a_word_is_heavier_in_a_block_of_its_own(spark):
    rng = random.Random(12)
    rows = [(k, [f"w{rng.randrange(400)}" for _ in range(1 + k % 40)]) for k in range(80)]
    df = spark.createDataFrame(rows, "id int, words array<string>")
    got = {r.id: r.simhash for r in lines.with_simhash(df, lines.OWN, f"size(words) <= {lines.SHORT}").collect()}
    expected = {}
    for k, words in rows:
        bits = 0
        for j in range(6):
            total, held = 0, Counter()
            for w in sorted(set(words)):
                h = xxhash.xxh64_intdigest(w.encode(), seed=42)
                home = (h - (h >> 63 << 64) >> 20) % 6
                if home != j and len(words) > lines.SHORT:
                    continue
                seed = xxhash.xxh64_intdigest(j.to_bytes(4, "little"), seed=42)
                x = xxhash.xxh64_intdigest(h.to_bytes(8, "little"), seed=seed)
                length = 1 if len(w) <= 4 else min(len(w), 31)
                q = min((length << 16) // (1 + (x >> 48)), 65536) * (lines.OWN if home == j else 1)
                total += q * q
                held.update({i: q * q for i in range(10) if x >> i & 1})
            bits |= sum(1 << 10 * j + i for i in range(10) if 2 * held[i] > total)
        expected[k] = bits
    assert got == expected


def test_one_common_word_makes_no_candidates(spark):
    rng = random.Random(13)
    rows = [(k, ["acknowledgements", *(f"w{rng.randrange(10**9)}" for _ in range(19))]) for k in range(2000)]
    df = spark.createDataFrame(rows, "id int, words array<string>")
    made = lines.with_simhash(df, lines.OWN, "false").select("id", F.explode(lines.block_keys()).alias("bucket"))
    pairs = made.groupBy("bucket").count().agg(F.sum(F.expr("count * (count - 1) div 2"))).first()[0]
    assert pairs < 2000


def test_a_pair_is_verified_once(spark, tmp_path):
    path = str(tmp_path / "members")
    rows = [(b, i, b) for b in range(50) for i in (2 * b, 2 * b + 1)] + [(1000, i, 0) for i in range(20)]
    spark.createDataFrame(rows, "bucket bigint, id bigint, info bigint").write.parquet(path)
    seen = Counter()

    def verify(pairs):
        seen.update((r.a, r.b) for r in pairs.collect())
        return pairs.where("a % 4 = 0 and b = a + 1")

    known = graph.linked(spark.read.parquet(path), verify, lambda a, b: F.lit(True))
    assert set(seen.values()) == {1} and len(seen) == 40 + 20 * 19 // 2
    assert {r.id for r in known.collect()} == {i for i in range(100) if i % 4 < 2}


def test_line_tables_go_when_the_lines_are_known(spark, documents):
    import os

    folder = spark.conf.get("spark.checkpoint.dir") + "/lakeloom"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    found = lines.dedup(documents([(i, f"the same line of words\nline {i} of its own", "en", "a") for i in range(9)]))
    left = set(os.listdir(folder)) - before
    assert [name.rsplit("-", 1)[0] for name in left] == ["lines-gone"]
    assert sum(r.removed for r in found.collect()) >= 8


def test_edits_by_words_are_never_fewer_than_the_distance(spark):
    rng = random.Random(14)
    vocabulary = [f"{c}{k}" for k in range(60) for c in ("word", "ü", "|")] + ["|", "the"] * 40
    pairs = [(a, b) for _, a, b in edited_lines(rng, vocabulary)]
    pairs += [(a, b) for (a, _), (_, b) in zip(pairs, pairs[1:], strict=False)]
    pairs += [("a", "a"), ("a", "b c d e f g h"), ("a b c d e f g h", "i"), ("x" * 900, "y" * 900)]
    df = spark.createDataFrame([(a, b, int(max(len(a), len(b)) * 0.2 + 1e-9)) for a, b in pairs], "a string, b string, most int")
    rows = df.select("a", "b", "most", lines.word_edits("a", "b", "most").alias("edits")).collect()
    true = [(r, levenshtein(r.a, r.b)) for r in rows]
    assert all(r.edits >= min(d, r.most + 1) for r, d in true)
    # Most lines that are alike are told so without their distance.
    alike = [r.edits <= r.most for r, d in true if d <= r.most]
    assert np.mean(alike) > 0.9


def test_texts_are_normalised_line_by_line(spark):
    rng = random.Random(15)
    texts = ["".join(rng.choices("aÉΣ \t\n\n\x0b\f\r", k=rng.randint(0, 30))) for _ in range(500)] + ["ΑΣ\nΣΑ  Σ", "a b\nc"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", lines.normal(F.col("text")).alias("made")).collect():
        assert r.made.split("\n") == [" ".join(x.lower().split()) for x in r.text.split("\n")]


def test_common_words_make_no_candidates(spark, documents):
    rng = random.Random(16)
    common = ["the", "acknowledgements", "of", "nevertheless", "and", "consequently", "from", "to", "which"]
    rows = [(k, [f"w{rng.randrange(10**9)}" for _ in range(9)] + common) for k in range(2000)]
    docs = documents([(k, " ".join(words), "en", "a") for k, words in rows])
    at = lines.located(docs).select("row.text", "file", "at")
    found = lines.common_words(at)
    assert sum(bin(b % 2**64).count("1") for b in found) == len(common)
    df = spark.createDataFrame(rows, "id int, words array<string>")
    made = lines.with_simhash(df, lines.OWN, "false", found).select("id", F.explode(lines.block_keys()).alias("bucket"))
    pairs = made.groupBy("bucket").count().agg(F.sum(F.expr("count * (count - 1) div 2"))).first()[0]
    assert pairs < 2000


def test_buckets_of_two_are_read_in_the_first_round_only(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "members")
    rows = [(b, i, 0) for b in range(50) for i in (2 * b, 2 * b + 1)] + [(1000, i, 0) for i in range(20)]
    spark.createDataFrame(rows, "bucket bigint, id bigint, info bigint").write.parquet(path)
    torn = []

    def written(df, label, whole=graph.materialize):
        found = whole(df, label)
        if label == "torn":
            torn.append(found.count())
        return found

    monkeypatch.setattr(graph, "materialize", written)
    graph.linked(spark.read.parquet(path), lambda pairs: pairs.where("a % 4 = 0 and b = a + 1"), lambda a, b: F.lit(True))
    assert torn and max(torn) <= 20


def test_a_documents_lines_are_split_once(spark, documents):
    whole = "\n".join(f"line {i} of many lines in one text" if i % 7 else "the line again" for i in range(400))
    found = lines.dedup(documents([(0, whole, "en", "a")]))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "get(split(" not in plan
    assert found.first().removed >= 400 // 7
