"""SentencePiece encoding of the merge (BPE) type by backtracking, and decoding.

A row of vocabulary pieces is the encoding of its text exactly if every two neighbours are:
if merging their joined text anew gives the same two pieces.  So the encoder takes the longest
piece at each position (one Aho-Corasick pass finds them), checks it against its left
neighbour, falls back to the next shorter prefix, and steps back where none fits; a bitfield
of failed positions keeps it linear.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.common import arrow_udf, pieces

SPACE = "▁"
#: Encoded words and checked neighbours that a task remembers, and the longest such words: so
#: the bytes are bounded.  Only speed depends on it.
MEMORY, LONGEST = 220_000, 64


class _Memory(dict):
    """A bounded dict that makes what it lacks; the last full generation is kept too."""

    def __init__(self, make, limit: int = MEMORY) -> None:
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if isinstance(key, str) and len(key) > LONGEST:
            return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Pieces:
    """A model file of the merge type, read with the library; encoding is done here."""

    def __init__(self, model_file: str) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        lib = self.library
        self.text: list[str] = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        self.bytes = {}
        self.rank: dict[str, tuple[float, int]] = {}
        for i, piece in enumerate(self.text):
            if lib.is_byte(i):
                self.bytes[int(piece[3:-1], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.rank[piece] = (-lib.get_score(i), i)
        self.unknown = lib.unk_id()
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        # Pieces that merging never makes are no candidates.
        made = {p: self.rank[p][1] for p in self.rank if self.merge(p) == [p]}
        self.id = made
        self.automaton = ahocorasick.Automaton()
        self.shorter = [-1] * len(self.text)
        for piece, i in made.items():
            self.automaton.add_word(piece, (len(piece) - 1, i))
            cut = next((n for n in range(len(piece) - 1, 0, -1) if piece[:n] in made), 0)
            if cut:
                self.shorter[i] = made[piece[:cut]]
        self.automaton.make_automaton()
        self.length = [len(p) for p in self.text]
        self.characters = {p for p in made if len(p) == 1}
        self.fits = _Memory(self._fits)
        self.encoded = _Memory(self._encode_word)
        self.words = re.compile(self._word_pattern(made))
        self.spaced = _Memory(self._encode_spaced)
        self.words_apart = not any(SPACE in p.lstrip(SPACE) for p in made)
        self.lines_apart = not any("\n" in p for p in made)
        self.first = array("I", [self.begin]).tobytes()
        self.last = array("I", [self.end]).tobytes()

    @staticmethod
    def _word_pattern(made: dict[str, int]) -> str:
        """Cuts that no piece spans, so that what lies between is encoded apart and can be
        remembered: before a space, between a Latin letter and a mark, around a line end without
        a piece."""

        def spans(left: str, right: str) -> bool:
            return any(re.search(left + right, p) for p in made)

        marks, letter = r"!-/:-@\[-`{-~", "[A-Za-zÀ-ÖØ-öø-ɏ]"
        if spans(f"[^{SPACE}]", SPACE):
            return "(?s:.+)"
        alone = "" if "\n" in made else r"\n"
        word = f"{SPACE}*[^{SPACE}{alone}]+"
        if not spans(letter, f"[{marks}]"):
            body = f"[^{SPACE}{alone}{marks}]"
            word = f"{SPACE}*[{marks}]*{body}*{letter}(?!{body})|{word}"
        return f"{alone or '(?!)'}|{word}|{SPACE}+"

    def merge(self, text: str) -> list[str]:
        """Merge neighbours, best score and then leftmost first, until none is a piece."""
        parts = list(text)
        while True:
            best, where = None, -1
            for k in range(len(parts) - 1):
                found = self.rank.get(parts[k] + parts[k + 1])
                if found is not None and (best is None or found[0] < best):
                    best, where = found[0], k
            if best is None:
                return parts
            parts[where : where + 2] = [parts[where] + parts[where + 1]]

    def _fits(self, pair: int) -> bool:
        left, right = self.text[pair >> 32], self.text[pair & 0xFFFFFFFF]
        return self.merge(left + right) == [left, right]

    def _known(self, text: str) -> list[int]:
        """Ids of a text whose characters all are pieces."""
        n = len(text)
        longest = [0] * (n + 1)
        for stop, (before, i) in self.automaton.iter(text):
            longest[stop - before] = i  # of one start, longer matches come later
        shorter, lengths, fits = self.shorter, self.length, self.fits
        failed = bytearray((n >> 3) + 1)
        out: list[int] = []
        at, last, token = 0, -1, longest[0]
        while at < n:
            while token >= 0:
                stop = at + lengths[token]
                if not failed[stop >> 3] >> (stop & 7) & 1 and (
                    last < 0 or fits[last << 32 | token]
                ):
                    break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, last = stop, token
                token = longest[at]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                token = out.pop()
                last = out[-1] if out else -1
                at -= lengths[token]
        return out

    def _encode_word(self, word: str) -> bytes:
        if self.characters.issuperset(word):
            return array("I", self._known(word)).tobytes()
        ids: list[int] = []
        known = ""
        for char in word:
            if char in self.characters:
                known += char
                continue
            ids += self._known(known)
            known = ""
            ids += [self.bytes[b] for b in char.encode()] if self.bytes else [self.unknown]
        return array("I", ids + self._known(known)).tobytes()

    def _encode_spaced(self, word: str) -> bytes:
        """A word is remembered once: without its space, and without the marks that follow it."""
        if word[0] == "\n":
            return b"".join(map(self.encoded.__getitem__, self.words.findall(word)))
        first, *rest = self.words.findall(SPACE + word)
        if not rest:
            return self._encode_word(first)
        return self.spaced[first[1:]] + b"".join(map(self.encoded.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        """Ids with begin and end, as little-endian unsigned 32-bit integers."""
        spaced = text.replace("\n", " \n") if self.lines_apart else text
        if not text:
            body = b""
        elif not self.words_apart or "  " in spaced or SPACE in text or spaced[0] == " " or spaced[-1] == " ":
            words = self.words.findall(SPACE + text.replace(" ", SPACE))
            body = b"".join(map(self.encoded.__getitem__, words))
        else:
            body = b"".join(map(self.spaced.__getitem__, spaced.split(" ")))
        return self.first + body + self.last

    def decode(self, ids: bytes) -> str:
        return self.library.decode(np.frombuffer(ids, "<u4").tolist())


_loaded: dict[str, Pieces] = {}


def load(model_file: str) -> Pieces:
    """The model, read once by each Python worker."""
    if model_file not in _loaded:
        _loaded[model_file] = Pieces(model_file)
    return _loaded[model_file]


#: ``ids`` are the encoded ids, four bytes each, lowest byte first.
KIND = T.StructType().add("ids", T.BinaryType()).add("decoded", T.StringType())
DIGESTS = (
    T.StructType()
    .add("n_tokens", T.LongType())
    .add("ids_sha256", T.StringType())
    .add("decoded_sha256", T.StringType())
)


def encode(text: Column, model_file: str) -> Column:
    """Ids and decoded text of whole texts.  Null is the empty text: begin and end only."""

    @arrow_udf(KIND)
    def run(texts: pa.Array) -> pa.Array:
        model, ids, back = load(model_file), [], []
        for _, part in pieces(texts):
            for t in part:
                ids.append(model.encode(t.decode("utf-8", "replace")))
                back.append(model.decode(ids[-1]))
        return pa.StructArray.from_arrays(
            [pa.array(ids, pa.binary()), pa.array(back, pa.string())], ["ids", "decoded"]
        )

    return run(text)


def digests(text: Column, model_file: str) -> Column:
    """Token count and digests of ``encode``'s ids and decoded text, made where these are."""

    @arrow_udf(DIGESTS)
    def run(texts: pa.Array) -> pa.Array:
        model, rows = load(model_file), ([], [], [])
        for _, part in pieces(texts):
            for t in part:
                ids = model.encode(t.decode("utf-8", "replace"))
                rows[0].append(len(ids) // 4)
                rows[1].append(hashlib.sha256(ids).hexdigest())
                rows[2].append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(rows[0], pa.int64()), pa.array(rows[1]), pa.array(rows[2])],
            DIGESTS.fieldNames(),
        )

    return run(text)


def encode_documents(docs: DataFrame, model_file: str, *, text: str = "text") -> DataFrame:
    """``row`` (the columns of ``docs``), ``ids`` and ``decoded``, one row per document.

    Repeated rows are encoded alike; an empty table gives an empty result.
    """
    made = docs.select(F.struct("*").alias("row")).withColumn(
        "made", encode(F.col(f"row.{text}"), model_file)
    )
    return made.select("row", "made.ids", "made.decoded")


def digest_documents(docs: DataFrame, model_file: str, *, text: str = "text") -> DataFrame:
    """As ``encode_documents``, with ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``."""
    made = docs.select(F.struct("*").alias("row")).withColumn(
        "made", digests(F.col(f"row.{text}"), model_file)
    )
    return made.select("row", "made.*")


ROWS = (
    T.StructType()
    .add("n_tokens", T.LongType())
    .add("ids", T.ArrayType(T.IntegerType()))
    .add("ids_sha256", T.StringType())
    .add("decoded_sha256", T.StringType())
)


def token_rows(docs: DataFrame, model_file: str, *, text: str = "text") -> DataFrame:
    """``row`` (the columns of ``docs``) with the ids as an array of numbers, their count, and
    the digests of ``digest_documents``: what a training job reads."""

    @arrow_udf(ROWS)
    def run(texts: pa.Array) -> pa.Array:
        model, flat, sizes, digests, back = load(model_file), bytearray(), [], [], []
        for _, part in pieces(texts):
            for t in part:
                ids = model.encode(t.decode("utf-8", "replace"))
                flat += ids  # the ids of a batch are held once
                sizes.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
        ends = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(flat, "<i4")))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), lists, pa.array(digests, pa.string()), pa.array(back, pa.string())],
            ROWS.fieldNames(),
        )

    made = docs.select(F.struct("*").alias("row")).withColumn("made", run(F.col(f"row.{text}")))
    return made.select("row", "made.*")
