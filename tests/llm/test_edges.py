"""Odd rows, empty tables and clashing names, for every operator on documents."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from lakeloom.llm import exact, langid, lines, mixing, near, quality, sentencepieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
NO_LABELS = "doc_id bigint, quality int, toxic int"


def run(name, spark, docs):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (None, 1, 0), (7, None, 0)], NO_LABELS)
    if docs.isEmpty():
        labels = labels.limit(0)
    return {
        "mixing": lambda: mixing.taken(docs),
        "mix": lambda: mixing.mix(docs, shards=3).select("row.*").distinct(),
        "sentencepieces": lambda: sentencepieces.digest_documents(docs, MODEL),
        "token_rows": lambda: sentencepieces.token_rows(docs, MODEL),
        "exact": lambda: exact.dedup(docs),
        "near": lambda: near.classes(docs),
        "langid": lambda: langid.identify(docs, langid.train(docs)),
        "lines": lambda: lines.dedup(docs),
        "quality": lambda: quality.classify(docs, quality.train(docs, labels, epochs=5)),
    }[name]()


NAMES = ["mixing", "sentencepieces", "token_rows", "exact", "near", "langid", "lines", "quality"]


@pytest.mark.parametrize("name", NAMES)
def test_every_row_has_a_result(spark, odd, name):
    assert run(name, spark, odd).count() == odd.count()


@pytest.mark.parametrize("name", [*NAMES, "mix"])
def test_empty_table(spark, nothing, name):
    assert run(name, spark, nothing).count() == 0


def test_columns_come_through(spark, odd):
    for name in ("sentencepieces", "langid", "lines", "quality"):
        row = run(name, spark, odd).select("row.*")
        assert row.columns == odd.columns
        assert row.where("digest <> 'own digest' or `row` <> 'own row'").isEmpty()
    kept = near.keep_one(odd)
    assert kept.columns == odd.columns
    assert lines.without_repeats(odd).columns == odd.columns


def test_undetermined_languages(spark, odd):
    found = run("langid", spark, odd).select("row.doc_id", "lang_pred", "score").collect()
    und = {r.doc_id for r in found if r.lang_pred == "und"}
    assert und == {2, 3, 4, 8}
    assert all(0 <= r.score <= 1 for r in found)


def test_exact_groups(spark, odd):
    rows = exact.dedup(odd).collect()
    groups = {(r.doc_id, r.keep_id, r.group_size) for r in rows}
    # Upper case equals; null is smaller than every id; null text equals the empty one.
    assert {(1, 6, 4), (None, 6, 4), (6, 6, 4), (2, 3, 2), (3, 3, 2), (5, 5, 1)} <= groups
    assert sum(r.kept for r in rows) == len({r.digest for r in rows})


def test_near_groups(spark, odd):
    rows = near.classes(odd).collect()
    assert {r.doc_id: r.class_id for r in rows if r.class_size > 1} == {1: 1, None: 1, 6: 1}
    assert sum(r.kept for r in rows) == 7


def test_one_row_of_repeated_ones_keeps_its_lines(spark, odd):
    rows = lines.dedup(odd).select("row.doc_id", "clean", "removed").collect()
    assert sorted(r.removed for r in rows if r.doc_id == 1) == [0, 1]
    assert [r.clean for r in rows if r.doc_id == 2] == [None]
    assert [r.clean for r in rows if r.doc_id == 4] == [" \n\t\n"]


def test_mix_of_odd_rows(spark, odd):
    rows = mixing.taken(odd).collect()
    assert all(r.taken <= 2 * r.size for r in rows)
    assert {r.target for r in rows if r.doc_id == 2} == {0.0}
    drawn = mixing.mix(odd, shards=3)
    assert drawn.select("row.*").columns == odd.columns
    words = drawn.agg(F.sum(mixing.words(F.col("row.text")))).first()[0]
    assert words == sum(r.taken for r in rows)


@pytest.mark.parametrize("kind", ["made", "union"])
def test_frames_that_are_no_scans(spark, kind):
    first = "one two three four five six seven eight nine ten"
    rows = [(1, f"{first}\nown line of the first"), (2, f"{first}\nown line of the first"), (3, "something else")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    if kind == "union":
        docs = docs.where("doc_id = 1").union(docs.where("doc_id > 1"))
    assert sorted(r.doc_id for r in near.keep_one(docs).collect()) == [1, 3]
    texts = {r.doc_id: r.text for r in lines.without_repeats(docs).collect()}
    assert texts == {1: rows[0][1], 2: "", 3: "something else"}
