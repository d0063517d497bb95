"""Fill-in-middle transformation of documents cut between lines, by words of eight bytes.

A text's UTF-8 is viewed as 64-bit words.  Arithmetic on whole words marks the bytes that end a
line, a population count gives the marks of each word, and their running sum is searched for
the word of the k-th mark; the mark is then selected inside the word.  Character counts come
from marks on the bytes that begin a code point.  Nothing looks at single bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import arrow_udf, id_text, pieces

#: What stands before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Seed of the cuts, and in a hundred texts: those transformed, and of these those in the
#: order suffix, prefix, middle.
SEED, RATE, SPM_RATE = 7, 100, 50

_ONES = 0x0101010101010101
_HIGH = np.uint64(0x80 * _ONES)
_LOW = np.uint64(0x7F * _ONES)
_NEWLINES = np.uint64(0x0A * _ONES)


def as_words(data: bytes) -> np.ndarray:
    """The bytes as little-endian 64-bit words, with at least one byte of padding."""
    return np.frombuffer(data + bytes(8 - len(data) % 8), "<u8")


def line_ends(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that is a line feed; no carry leaves a byte."""
    x = words ^ _NEWLINES
    return ~(((x & _LOW) + _LOW) | x | _LOW)


def character_starts(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte that begins a code point, which is all but 10xxxxxx."""
    return (~words | (words << np.uint64(1))) & _HIGH


class Marks:
    """Ranks and places of marked bytes; at most the high bit of a byte is set."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.before = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.bitwise_count(words), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """The marks before each byte."""
        word, bits = at >> 3, ((at & 7) << 3).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bits) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """The byte of each k-th mark, counted from 0."""
        word = np.searchsorted(self.before, k, "right") - 1
        left, more = self.words[word], k - self.before[word]
        for turn in range(7):
            left = np.where(more > turn, left & (left - np.uint64(1)), left)
        lowest = left & (~left + np.uint64(1))
        return (word << 3) + (np.bitwise_count(lowest - np.uint64(1)) >> 3)


RESULT = (
    T.StructType()
    .add("n", T.LongType())
    .add("form", T.StringType())
    .add("prefix_chars", T.LongType())
    .add("middle_chars", T.LongType())
    .add("output", T.StringType())
)


def _made(texts: list[bytes], h: np.ndarray, rate: int, spm_rate: int):
    """Columns of RESULT for texts with four numbers each."""
    data = b"".join(texts)
    stop = np.cumsum([len(t) for t in texts], dtype=np.int64)
    start = np.concatenate([[0], stop[:-1]])
    words = as_words(data)
    ends, chars = Marks(line_ends(words)), Marks(character_starts(words))
    first, last = ends.rank(start), ends.rank(stop)
    # A line without an end counts too; the byte before an empty text is another text's.
    whole = ends.rank(np.maximum(stop - 1, start))
    n = last - first + ((stop > start) & (whole == last))
    cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)

    def place(units: np.ndarray) -> np.ndarray:
        at = np.where(units > last - first, stop, start)
        inside = (units > 0) & (units <= last - first)
        at[inside] = ends.select(first[inside] + units[inside] - 1) + 1
        return at

    one, two = place(cuts[:, 0]), place(cuts[:, 1])
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    forms, outputs = [], []
    for i, text in enumerate(texts):
        if not text or h[i, 2] % 100 >= rate or any(m in text for m in marks):
            forms.append("plain")
            outputs.append(text)
            continue
        a, b = one[i] - start[i], two[i] - start[i]
        prefix, middle, suffix = marks[0] + text[:a], marks[2] + text[a:b], marks[1] + text[b:]
        spm = h[i, 3] % 100 < spm_rate
        forms.append("spm" if spm else "psm")
        outputs.append(suffix + prefix + middle if spm else prefix + suffix + middle)
    plain = np.array([f == "plain" for f in forms], bool)
    at = chars.rank(np.stack([start, one, two]))
    return n, forms, (at[1] - at[0], plain), (at[2] - at[1], plain), outputs


def made(text: Column, h: list[Column], rate: int = RATE, spm_rate: int = SPM_RATE) -> Column:
    """RESULT of each text; ``h`` are four whole numbers that choose cuts, rate and order."""

    @arrow_udf(RESULT)
    def run(texts: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        numbers = np.stack([x.to_numpy(zero_copy_only=False) for x in (h1, h2, h3, h4)], 1)
        parts = []
        for at, part in pieces(texts):
            n, forms, prefix, middle, outputs = _made(part, numbers[at : at + len(part)], rate, spm_rate)
            columns = [
                pa.array(n, pa.int64()),
                pa.array(forms, pa.string()),
                pa.array(prefix[0], pa.int64(), mask=prefix[1]),
                pa.array(middle[0], pa.int64(), mask=middle[1]),
                pa.array(outputs, pa.binary()).cast(pa.string()),
            ]
            parts.append(pa.StructArray.from_arrays(columns, RESULT.names))
        return pa.concat_arrays(parts) if parts else pa.array([], pa.struct(
            [(f, k) for f, k in zip(RESULT.names, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)]
        ))

    return run(text, *h)


def transform(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    rate: int = RATE,
    spm_rate: int = SPM_RATE,
) -> DataFrame:
    """``row`` (the columns of ``docs``), ``n`` lines, ``form``, ``prefix_chars``,
    ``middle_chars`` and ``output``, one row per document.

    The cuts come from a digest of the seed and the id alone, so reruns agree and rows with one
    id and one text are equal.  A null text counts as empty and a null id as the empty text.
    Empty texts and those that hold a sentinel stay as they are (``plain``, null counts).  A
    prefix, middle or suffix may be empty.  An empty table gives an empty result.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_text(F.col(doc_id))), 256)
    whole = docs.select(F.struct("*").alias("row"), digest.alias("digest"), F.col(text).alias("text"))
    h = [F.conv(F.substring("digest", 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]
    found = whole.select("row", made(F.col("text"), h, rate, spm_rate).alias("made"))
    return found.select("row", "made.*")


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of.  No sentinel lies across the border of two parts,
    so the first of each kind is the one that was put there."""
    middle = F.substring_index(output, MIDDLE, -1)
    rest = F.substring_index(output, MIDDLE, 1)

    def parts(border: str) -> tuple[Column, Column]:
        first = F.substring_index(rest, border, 1)
        return F.substr(first, F.lit(len(PREFIX) + 1)), F.substring_index(rest, border, -1)

    prefix, suffix = parts(SUFFIX)
    back, front = parts(PREFIX)
    return (
        F.when(form == "psm", F.concat(prefix, middle, suffix))
        .when(form == "spm", F.concat(front, middle, back))
        .otherwise(output)
    )
