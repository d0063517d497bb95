"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is a position with two states, bad and good.  A line's features are
its own and those of the lines before and after it.  Forward and backward messages give each
line's probability of being good; the document's score is their mean, weighted by length.
Lines carry no labels of their own: in training each takes its document's.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import arrow_udf, id_text, pieces, powers, prefix_hash

#: Labelled documents the fit may use: the bound of the training sample.
TRAIN_DOCUMENTS = 3000
#: Bytes of text whose features are made at a time: they take a hundred times as much.
SLICE = 250_000
THRESHOLD = 0.3
EPOCHS = 250

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _bytes_in(ranges: list[tuple[int, int]]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


#: Byte classes whose share of a line is a feature.
CLASSES = [
    _SPACE,
    _bytes_in([(97, 122), (128, 255)]),  # small letters and all beyond ASCII
    _bytes_in([(65, 90)]),
    _bytes_in([(48, 57)]),
    _bytes_in([(44, 44), (46, 46), (58, 59)]),
    _bytes_in([(33, 33), (63, 63)]),
    _bytes_in([(35, 38), (42, 43), (60, 62), (64, 64), (91, 96), (123, 126)]),
]
OWN = len(CLASSES) + 7
WIDTH = 3 * OWN


class Lines(NamedTuple):
    features: np.ndarray  # lines x WIDTH
    lengths: np.ndarray  # bytes, at least 1
    counts: np.ndarray  # lines of each document, at least 1


def line_features(texts: list[bytes]) -> Lines:
    """Features of every line of every text; an empty text has one empty line."""
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    doc_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    counts = np.diff(np.searchsorted(ends, doc_ends, "right"), prepend=0)
    doc = np.repeat(np.arange(len(texts)), counts)
    size = np.maximum(ends - starts, 1)

    def per_line(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return total[ends] - total[starts]

    space = _SPACE[data]
    begin = ~space
    begin[1:] &= space[:-1]
    words = per_line(begin)
    columns = [per_line(c[data]) / size for c in CLASSES]

    # Word hashes by prefix sums of a polynomial; equal neighbours are repetition.
    hashed = prefix_hash(data)
    first = np.flatnonzero(begin)
    stop = np.flatnonzero(space & np.concatenate([[False], ~space[:-1]]))
    word = (hashed[stop] - hashed[first]) * powers(len(data), True)[first]
    same = np.zeros(len(data), bool)
    if len(first) > 1:
        same[first[1:]] = word[1:] == word[:-1]
        two = first[2:][word[2:] == word[:-2]]
    else:
        two = first[:0]
    line = (hashed[ends] - hashed[starts]) * powers(len(data), True)[starts]
    alike = np.zeros(len(data), bool)
    alike[two] = True
    order = np.lexsort((line, doc))
    twin = np.zeros(len(line), bool)
    pair = (line[order][1:] == line[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    twin[order[1:][pair]] = True
    twin[order[:-1][pair]] = True
    some = np.maximum(words, 1)
    own = np.column_stack(
        [
            *columns,
            np.log1p(ends - starts) / 5,
            np.log1p(words) / 4,
            (ends - starts) / some / 10,
            per_line(same) / some,
            per_line(alike) / some,
            twin,
            words == 0,
        ]
    ).astype(np.float32)
    own = np.minimum(own, 4)
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1] * (doc[1:] == doc[:-1])[:, None]
    after[:-1] = own[1:] * (doc[1:] == doc[:-1])[:, None]
    return Lines(np.hstack([own, before, after]), size, counts)


class Model(NamedTuple):
    weights: np.ndarray  # WIDTH
    bias: float
    change: np.ndarray  # 2 x 2, of one line's state to the next's
    mean: np.ndarray
    scale: np.ndarray


def _log_add(a, b):
    return np.logaddexp(a, b)


def _messages(emit: np.ndarray, counts: np.ndarray, change: np.ndarray):
    """Log odds that a line is good: from the lines up to it and from those after it.

    All documents advance together, a line at a time, longest first.
    """
    order = np.argsort(-counts, kind="stable")
    start = (np.cumsum(counts) - counts)[order]
    many = counts[order]
    ahead, back = np.empty_like(emit), np.zeros_like(emit)
    longest = int(many[0]) if len(many) else 0
    live_at = np.searchsorted(-many, -np.arange(longest), "left")  # documents longer than t
    (a00, a01), (a10, a11) = change
    ahead[start] = emit[start]
    for t in range(1, longest):
        at = start[: live_at[t]] + t
        o = ahead[at - 1]
        ahead[at] = emit[at] + _log_add(o + a11, a01) - _log_add(o + a10, a00)
    for t in range(longest - 2, -1, -1):
        at = start[: live_at[t + 1]] + t
        o = emit[at + 1] + back[at + 1]
        back[at] = _log_add(a11 + o, a10) - _log_add(a01 + o, a00)
    return ahead, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def scores(model: Model, lines: Lines) -> np.ndarray:
    """Length-weighted mean of the lines' probabilities of being good, per document."""
    x = (lines.features - model.mean) * model.scale
    ahead, back = _messages(x @ model.weights + model.bias, lines.counts, model.change)
    good = _sigmoid(ahead + back) * lines.lengths
    first = np.cumsum(lines.counts) - lines.counts
    total = np.add.reduceat(good, first) / np.add.reduceat(lines.lengths.astype(float), first)
    return np.clip(total, 0.0, 1.0)


def fit(lines: Lines, labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Maximum likelihood with a quadratic penalty, by Adam steps over all lines.

    Without labelled documents of both kinds every document scores the share of good ones.
    """
    share = (labels.sum() + 1.0) / (len(labels) + 2.0)
    width = WIDTH
    if len(set(labels.tolist())) < 2:
        zero = np.zeros(width)
        bias = float(np.log(share / (1 - share)))
        return Model(zero, bias, np.zeros((2, 2)), zero, np.ones(width))
    mean = lines.features.mean(0).astype(float)
    scale = 1 / np.maximum(lines.features.std(0), 1e-3)
    x = (lines.features - mean) * scale
    truth = np.repeat(labels.astype(float), lines.counts)
    first = np.cumsum(lines.counts) - lines.counts
    inner = np.ones(len(truth), bool)
    inner[first] = False
    inner = np.flatnonzero(inner)  # lines that have one before them
    # Long documents count as several, not as thousands.
    weigh = np.repeat(1 / np.sqrt(lines.counts), lines.counts)
    weigh /= weigh.sum()
    params = np.zeros(width + 5)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, epochs + 1):
        w, bias, change = params[:width], params[width], params[width + 1 :].reshape(2, 2)
        emit = x @ w + bias
        ahead, back = _messages(emit, lines.counts, change)
        error = (_sigmoid(ahead + back) - truth) * weigh
        grad = np.empty_like(params)
        grad[:width] = error @ x + 1e-4 * w
        grad[width] = error.sum()
        o, n = ahead[inner - 1], emit[inner] + back[inner]
        joint = np.stack([0 * o + change[0, 0], n + change[0, 1], o + change[1, 0], o + n + change[1, 1]])
        joint = np.exp(joint - joint.max(0))
        joint /= joint.sum(0)
        y0, y1 = truth[inner - 1].astype(int), truth[inner].astype(int)
        seen = np.zeros_like(joint)
        seen[2 * y0 + y1, np.arange(len(inner))] = 1
        grad[width + 1 :] = ((joint - seen) * weigh[inner]).sum(1) + 1e-3 * change.ravel()
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad**2
        params -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    change = params[width + 1 :].reshape(2, 2).copy()
    return Model(params[:width].copy(), float(params[width]), change, mean, scale)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.crc32(id_text(doc_id)) % 5 == 0


def _features(text: Column) -> Column:
    @arrow_udf("struct<features: binary, lengths: binary>")
    def run(texts: pa.Array) -> pa.Array:
        found = [line_features([t]) for _, part in pieces(texts, SLICE) for t in part]
        features = pa.array([x.features.tobytes() for x in found], pa.binary())
        lengths = pa.array([x.lengths.tobytes() for x in found], pa.binary())
        return pa.StructArray.from_arrays([features, lengths], ["features", "lengths"])

    return run(text)


def train(
    docs: DataFrame, labels: DataFrame, sample: int = TRAIN_DOCUMENTS, epochs: int = EPOCHS
) -> Model:
    """Fit on the ``sample`` labelled documents first by the hash of their id.

    Only labels of documents outside the held-out fold count; null labels do not.  The sample
    is chosen among the labels, so it is bounded before any text is read.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .where(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    rows = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
        .select("doc_id", "label", _features(F.col("text")).alias("line"))
        .select("doc_id", "label", "line.*")
        .orderBy("doc_id")
        .collect()
    )
    if not rows:
        return fit(Lines(np.zeros((0, WIDTH)), np.zeros(0), np.zeros(0, int)), np.zeros(0))
    parts = [np.frombuffer(r.features, np.float32).reshape(-1, WIDTH) for r in rows]
    lengths = [np.frombuffer(r.lengths, np.int64) for r in rows]
    lines = Lines(np.vstack(parts), np.concatenate(lengths), np.array([len(p) for p in parts]))
    return fit(lines, np.array([r.label for r in rows]), epochs)


def score(text: Column, model: Model) -> Column:
    """The score of whole texts in [0, 1]; null is the empty text, which is one empty line."""

    @arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        found = [scores(model, line_features(part)) for _, part in pieces(texts, SLICE)]
        return pa.array(np.concatenate(found) if found else [], pa.float64())

    return run(text)


def classify(
    docs: DataFrame, model: Model, *, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """``row`` (the columns of ``docs``), ``score`` and ``predicted``, one row per document.

    Null and empty texts get a score like any other; repeated rows get equal scores; an empty
    table gives an empty result.
    """
    return (
        docs.select(F.struct("*").alias("row"))
        .withColumn("score", score(F.col(f"row.{text}"), model))
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
    )


def keep_good(docs: DataFrame, model: Model, **options) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    return classify(docs, model, **options).where("predicted = 1").select("row.*")
