"""Language identification: sparse multinomial logistic regression on character n-grams.

A text's features are its hashed 1- to 4-grams of characters (code points in lower case; ASCII
other than letters ends words), log counts times inverse document frequency, at unit length.  The weights are
learned by the follow-the-regularised-leader method with elastic-net penalties, which leaves
most of them zero; a temperature fitted on rows kept from the learning calibrates the
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import arrow_udf, id_text, pieces, ship, small
from lakeloom.shared import materialize

#: Rows of each language that the fit may use: the bound of the training sample.
TRAIN_ROWS_PER_LANG = 1000
#: Languages a model may have; each is a column of weights.
UNKNOWN = "und"
BITS = 15
WIDTH = 1 << BITS
GRAMS = (1, 2, 3, 4)
#: Bytes of texts that are looked at together, and characters of a longer one.
SLICE, RUN = 2_000_000, 1 << 20
#: Parts in which each language's first rows are found before its parts are compared.
PARTS = 64

_MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def _fold_table() -> np.ndarray:
    """ASCII to letters in lower case; what is no letter ends a word (a space)."""
    table = np.full(128, 32, np.uint32)
    table[97:123] = np.arange(97, 123)
    table[65:91] = np.arange(97, 123)
    return table


_FOLD = _fold_table()


def _hashes(data: np.ndarray) -> np.ndarray:
    """Row n - 1 holds, for each place, the feature number of the n characters that end there."""
    hashed = np.empty((len(GRAMS), len(data)), np.uint32)
    grown = np.zeros(len(data), np.uint32)
    for n in GRAMS:
        grown *= np.uint32(0x01000193)
        grown[n - 1 :] += data[: max(0, len(data) - n + 1)] * _MIX[0]
        mixed = grown + np.uint32(n)
        mixed ^= mixed >> np.uint32(15)
        np.multiply(mixed, _MIX[n - 1], out=hashed[n - 1])
    hashed >>= np.uint32(32 - BITS)
    return hashed


def _counted(hashed: np.ndarray, low: int, high: int, since: int = 0) -> np.ndarray:
    """How often each feature lies in places ``low`` to ``high``, ending from ``since`` on."""
    inside = [hashed[n - 1, max(low + n - 1, since) : high] for n in GRAMS]
    return np.bincount(np.concatenate(inside), minlength=WIDTH)


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text the feature numbers, ascending, and their log counts.

    The texts are lower-cased before; runs of other characters count as one space, and text
    ends are word ends.
    """
    if not texts:
        return []
    data = np.frombuffer(f" {' '.join(texts)} ".encode("utf-32-le", "replace"), np.uint32)
    folded = np.where(data < 128, _FOLD[np.minimum(data, 127)], data)
    # Text t starts with the space before it and ends with the one after it.
    ends = np.cumsum([len(t) + 1 for t in texts])
    keep = np.ones(len(folded), bool)
    keep[1:] = (folded[1:] != 32) | (folded[:-1] != 32)
    keep[ends] = True
    keep[0] = True
    before = np.concatenate([[0], np.cumsum(keep)])
    data = folded[keep]
    bounds = before[np.concatenate([[0], ends])]
    if len(texts) == 1 and len(data) > RUN:
        every = [np.zeros(WIDTH, np.int64)]
        for start in range(0, len(data), RUN):
            first = max(0, start - len(GRAMS) + 1)
            run = data[first : start + RUN]
            every[0] += _counted(_hashes(run), 0, len(run), start - first)
    else:
        hashed = _hashes(data)
        spans = zip(bounds[:-1].tolist(), (bounds[1:] + 1).tolist(), strict=True)
        every = (_counted(hashed, low, high) for low, high in spans)
    found = []
    for counts in every:
        at = np.flatnonzero(counts)
        found.append((at, np.log1p(counts[at])))
    return found


def lowered(texts: list[bytes]) -> list[str]:
    return [t.decode("utf-8", "replace").lower() for t in texts]


class Model(NamedTuple):
    langs: list[str]
    idf: np.ndarray  # WIDTH
    weights: np.ndarray  # WIDTH + 1 (bias) x languages
    temperature: float


def _vector(model_idf: np.ndarray, at: np.ndarray, logs: np.ndarray) -> np.ndarray:
    x = logs * model_idf[at]
    norm = np.sqrt(x @ x)
    return x / norm if norm > 0 else x


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def logits(model: Model, found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out = np.empty((len(found), len(model.langs)))
    for i, (at, logs) in enumerate(found):
        out[i] = _vector(model.idf, at, logs) @ model.weights[at] + model.weights[WIDTH]
    return out


def fit(
    found: list[tuple[np.ndarray, np.ndarray]],
    labels: list[str],
    idf: np.ndarray,
    *,
    epochs: int = 3,
    alpha: float = 0.5,
    beta: float = 1.0,
    l1: float = 0.02,
    l2: float = 1e-3,
) -> Model:
    """Weights by follow-the-regularised-leader steps, one row at a time in a fixed order; a
    fifth of the rows is left out of them and sets the temperature."""
    langs = sorted(set(labels))
    if not langs:
        return Model([], idf, np.zeros((WIDTH + 1, 0)), 1.0)
    z = np.zeros((WIDTH + 1, len(langs)))
    n = np.zeros_like(z)
    truth = np.array([langs.index(x) for x in labels])
    order = np.random.default_rng(7).permutation(len(found))
    held, used = order[: len(order) // 5], order[len(order) // 5 :]

    def current(at: np.ndarray) -> np.ndarray:
        zs, ns = z[at], n[at]
        w = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2)
        w[np.abs(zs) <= l1] = 0
        return w

    for _ in range(epochs):
        for i in used:
            at = np.append(found[i][0], WIDTH)
            x = np.append(_vector(idf, *found[i]), 1.0)
            w = current(at)
            p = _softmax(x @ w)
            p[truth[i]] -= 1
            g = np.outer(x, p)
            g2 = g * g
            sigma = (np.sqrt(n[at] + g2) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g2
    model = Model(langs, idf, current(np.arange(WIDTH + 1)), 1.0)
    if len(held):
        # Smoothed targets keep the temperature finite where every held row is right.
        seen = logits(model, [found[i] for i in held])
        target = np.full(seen.shape, 1 / (len(held) + len(langs)))
        target[np.arange(len(held)), truth[held]] += len(held) / (len(held) + len(langs))
        grid = np.geomspace(0.01, 20, 300)
        loss = [-(target * np.log(_softmax(seen / t) + 1e-300)).sum() for t in grid]
        model = model._replace(temperature=float(grid[int(np.argmin(loss))]))
    return model


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from."""
    return F.crc32(id_text(doc_id)) % 4 == 2


def document_frequency(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Rows of ``docs``, and how many of them hold each feature: over every row.

    Each task adds up its own rows; WIDTH sums are all that reaches the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(WIDTH, np.int64), 0
        for batch in batches:
            for _, part in pieces(batch.column(0), SLICE):
                rows += len(part)
                for at, _logs in features(lowered(part)):
                    total[at] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(at, WIDTH)), pa.array(np.append(total[at], rows))], ["at", "n"]
        )

    ship(docs.sparkSession)
    found = docs.select("text").mapInArrow(count, "at bigint, n bigint")
    sums = found.groupBy("at").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(WIDTH + 1, np.int64)
    for row in sums:
        total[row.at] = row.n
    return int(total[WIDTH]), total[:WIDTH]


def train(docs: DataFrame, rows_per_lang: int = TRAIN_ROWS_PER_LANG) -> Model:
    """Learn from text and language of the rows outside the held-out fold.

    Document frequencies are those of all these rows.  The weights are fitted on at most
    ``rows_per_lang`` rows of each language, those first by the hash of their id.
    """
    usable = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    total, frequency = document_frequency(usable)
    idf = np.log((1 + total) / (1 + frequency)) + 1
    # The rows are chosen by narrow columns: by each task, then by parts, then of all parts.
    order = F.xxhash64("doc_id"), F.col("doc_id")
    rows = usable.select("doc_id", "lang", F.pmod(F.spark_partition_id(), F.lit(PARTS)).alias("part"))
    for by in (["lang", "part"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        rows = rows.withColumn("rank", rank).where(F.col("rank") <= rows_per_lang).drop("rank")
    chosen = materialize(rows.select("doc_id", "lang").distinct(), "chosen")

    @arrow_udf(T.StructType().add("at", T.BinaryType()).add("logs", T.BinaryType()))
    def numbers(texts: pa.Array) -> pa.Array:
        found = [x for _, part in pieces(texts, SLICE) for x in features(lowered(part))]
        at = pa.array([x[0].astype(np.int32).tobytes() for x in found], pa.binary())
        logs = pa.array([x[1].astype(np.float32).tobytes() for x in found], pa.binary())
        return pa.StructArray.from_arrays([at, logs], ["at", "logs"])

    rows = (
        usable.join(small(chosen), ["doc_id", "lang"])
        .groupBy("doc_id", "lang")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "lang", numbers("text").alias("f"))
        .select("doc_id", "lang", "f.*")
        .orderBy("lang", "doc_id")
        .collect()
    )
    found = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r.logs, np.float32)) for r in rows]
    return fit(found, [r.lang for r in rows], idf)


def predict(text: Column, model: Model) -> Column:
    """A struct of ``lang_pred`` and ``score`` from whole texts.

    Null texts, and texts without a letter, are ``und`` with score 1; without a learned
    language every text is ``und`` with score 0.
    """

    @arrow_udf(T.StructType().add("lang_pred", T.StringType()).add("score", T.DoubleType()))
    def run(texts: pa.Array) -> pa.Array:
        names, probabilities = [], []
        for _, part in pieces(texts, SLICE):
            plain = [t.decode("utf-8", "replace") for t in part]
            letters = [any(map(str.isalpha, t)) for t in plain]
            if not model.langs:
                names += [UNKNOWN] * len(part)
                probabilities += [float(not x) for x in letters]
                continue
            found = features([t.lower() for t in plain])
            p = _softmax(logits(model, found) / model.temperature)
            best = p.argmax(1)
            for i, has in enumerate(letters):
                names.append(model.langs[best[i]] if has else UNKNOWN)
                probabilities.append(min(1.0, float(p[i, best[i]])) if has else 1.0)
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(probabilities, pa.float64())],
            ["lang_pred", "score"],
        )

    return run(text)


def identify(docs: DataFrame, model: Model, *, text: str = "text") -> DataFrame:
    """``row`` (the columns of ``docs``), ``lang_pred`` and ``score``, one row per document.

    Repeated rows get equal answers; an empty table gives an empty result.
    """
    named = docs.select(F.struct("*").alias("row")).withColumn(
        "found", predict(F.col(f"row.{text}"), model)
    )
    return named.select("row", "found.lang_pred", "found.score")
