"""SentencePiece encoding and decoding with weighted finite-state transducers.

The model is compiled into a chain of transducers over the (min, +) semiring:

* the *normaliser* puts one blank in front and maps blanks to ``▁``;
* the *lexicon* has, for every piece, a path that reads its characters and writes its id at
  the cost of minus its score; characters outside the lexicon take the *byte fallback*, which
  writes their UTF-8 bytes as byte pieces;
* the *adjacency* acceptor lets two pieces follow each other only if merging their text by
  rank would not cross their border.  For merge-ranked (BPE) models exactly one path of the
  lexicon then survives, the tokenizer's own; for unigram models it accepts everything and
  the cheapest path wins.

Each input is composed with the chain and the path of least cost is taken.  Pieces never
contain a blank after another character, so the input's automaton falls apart at blanks; the
parts are solved once per task and word.

Defined results: NULL texts give NULL ids; empty texts give no ids.  ``decode`` of ``encode``
is the text itself, except that ``▁`` comes back as a blank and that the unknown piece of a
model without byte pieces is lost.  Whole texts are encoded whatever their length.  Rows are
encoded one by one; columns of the input are kept, the result's names win.
"""

from __future__ import annotations

import functools
import math
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensoria.llm.language import with_struct
from sensoria.llm.words import small_batches, tidied

BLANK = "▁"
_PARTS = re.compile(f"{BLANK}*[^{BLANK}\n]+|{BLANK}+|\n")


@dataclass
class Transducer:
    """Lexicon, byte fallback and adjacency of one model."""

    ids: dict[str, int]
    costs: dict[str, float]
    byte_ids: list[int]
    unknown: int
    merges: bool
    pieces: list[str] = field(repr=False)
    limit: int = 400_000
    _adjacent: dict = field(default_factory=dict, repr=False)
    _history: dict = field(default_factory=dict, repr=False)
    _solved: dict = field(default_factory=dict, repr=False)
    _earlier: dict = field(default_factory=dict, repr=False)
    _lexicon: tuple = field(init=False, repr=False)
    _apart: re.Pattern = field(init=False, repr=False)

    def __post_init__(self) -> None:
        inside = {(a, b) for piece in self.costs for a, b in zip(piece, piece[1:], strict=False)}
        behind_letters = {b for a, b in inside if a.isalpha()}
        # no piece holds a letter with one of these marks behind it, so every path has a border there
        marks = re.escape("".join(mark for mark in string.punctuation if mark not in behind_letters))
        self._apart = re.compile(f"(?<=[^\\W\\d_])(?=[{marks}])" if marks else r"(?!)")
        # the lexicon as a trie: a state is its arcs by character, and the piece that ends there
        self._lexicon = ({}, None)
        for piece in self.costs:
            arcs = self._lexicon[0]
            for char in piece[:-1]:
                arcs = arcs.setdefault(char, ({}, None))[0]
            below = arcs.get(piece[-1], ({}, None))[0]
            arcs[piece[-1]] = (below, piece)

    def adjacent(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` by rank leaves a border between the two."""
        if len(self._adjacent) > self.limit:
            self._adjacent.clear()
        found = self._adjacent[left, right] = not self.merges or self._border(left, right)
        return found

    def _merging(self, piece: str) -> list[tuple[float, str, str]]:
        """States while a piece's characters merge by rank: next cost, first and last part."""
        found = self._history.get(piece)
        if found is not None:
            return found
        parts, costs, states = list(piece), self.costs, []
        while True:
            options = [(costs.get(a + b, math.inf), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            cost, at = min(options, default=(math.inf, -1))
            states.append((cost, parts[0], parts[-1]))
            if cost == math.inf:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if len(self._history) > self.limit:
            self._history.clear()
        self._history[piece] = states = states if len(parts) == 1 else []
        return states

    def _border(self, left: str, right: str) -> bool:
        """Both sides merge on their own until a merge across the border comes first, if ever."""
        one, other = self._merging(left), self._merging(right)
        if not one or not other:
            return False
        i = j = 0
        while True:
            ahead, _, last = one[i]
            after, first, _ = other[j]
            across = self.costs.get(last + first, math.inf)
            if across < ahead and across <= after:  # of equal merges the leftmost goes first
                return False
            if ahead == after == math.inf:
                return True
            if ahead <= after:
                i += 1
            else:
                j += 1

    def shortest(self, part: str) -> tuple[int, ...]:
        """Ids on the cheapest path that reads ``part``.

        States are (position, last piece); for merge-ranked models one piece at most can end
        at each position, otherwise the cheapest is kept.
        """
        size, merges, adjacent, costs = len(part), self.merges, self._adjacent, self.costs
        so_far: list[float | None] = [None] * (size + 1)
        last: list[str | None] = [None] * (size + 1)
        begin = [0] * (size + 1)
        so_far[0] = 0.0
        for start in range(size):
            spent = so_far[start]
            if spent is None:
                continue
            before = last[start]
            arcs, end = self._lexicon[0], start
            while end < size:
                state = arcs.get(part[end])
                if state is None:
                    break
                end += 1
                arcs, piece = state
                if piece is None:
                    continue
                held, cost = so_far[end], spent + costs[piece]
                if held is not None and (merges or held <= cost):
                    continue
                if before is not None:
                    fits = adjacent.get((before, piece))
                    if not (self.adjacent(before, piece) if fits is None else fits):
                        continue
                so_far[end], last[end], begin[end] = cost, piece, start
            if so_far[start + 1] is None and part[start] not in costs:
                so_far[start + 1], begin[start + 1] = spent, start
        out: list[int] = []
        at = size
        while at > 0:
            if so_far[at] is None:
                raise ValueError("the lexicon has no path for this text")
            if last[at] is None:
                out.extend(reversed(self._fallback(part[begin[at] : at])))
            else:
                out.append(self.ids[last[at]])
            at = begin[at]
        return tuple(reversed(out))

    def _fallback(self, text: str) -> list[int]:
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in text.encode()]

    def encode(self, text: str) -> list[int]:
        """Ids of a text."""
        if not text:
            return []
        if 2 * len(self._solved) > self.limit:
            # parts that come again are taken over, the others go with the next change
            self._solved, self._earlier = {}, self._solved
        solved, earlier, out = self._solved, self._earlier, []
        for part in _PARTS.findall(BLANK + text.replace(" ", BLANK)):
            found = solved.get(part)
            if found is None:
                found = earlier.get(part) or self._pieces(part)
                if len(part) <= 64:
                    solved[part] = found
            out.extend(found)
        return out

    def _pieces(self, part: str) -> tuple[int, ...]:
        """Ids of a part, cut before marks that no piece joins with a letter."""
        cut = self._apart.split(part)
        if len(cut) == 1:
            return self.shortest(part)
        out: list[int] = []
        for one in cut:
            found = self._solved.get(one) or self._earlier.get(one)
            if found is None:
                found = self.shortest(one)
                if len(one) <= 64:
                    self._solved[one] = found
            out.extend(found)
        return tuple(out)

    def decode(self, ids: list[int]) -> str:
        """Text of ids: bytes are put together, the blank in front is taken off."""
        out = bytearray()
        first = self.byte_ids[0] if self.byte_ids else -1
        for number in ids:
            if 0 <= number - first < 256 and self.byte_ids:
                out.append(number - first)
            else:
                out += self.pieces[number].encode()
        text = out.decode(errors="replace").replace(BLANK, " ")
        return text[1:] if text.startswith(" ") else text


@functools.lru_cache(maxsize=1)
def compiled(model_file: str | None = None) -> Transducer:
    """Transducer of a model file, kept by the Python worker from task to task.

    The default is the public 32k piece model.
    """
    import sentencepiece

    if model_file is None:
        import public_tokenizers

        model_file = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.vocab_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    usual = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    byte_ids = [i for i in range(size) if model.is_byte(i)]
    costs = {pieces[i]: -model.get_score(i) for i in usual}
    # merge ranks are whole numbers; unigram scores are log probabilities
    merges = all(cost == int(cost) for cost in costs.values())
    return Transducer(
        {pieces[i]: i for i in usual}, costs, byte_ids if len(byte_ids) == 256 else [],
        model.unk_id(), merges, pieces,
    )


def encoded(docs: DataFrame, model_file: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) of every whole text."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("array<int>")
    @tidied
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = compiled(model_file)
        for batch in batches:
            yield pa.array([None if t is None else model.encode(t) for t in batch.to_pylist()], pa.list_(pa.int32()))

    return docs.withColumn("ids", run(F.col(text)))


def decoded(docs: DataFrame, model_file: str | None = None, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the text of an id column."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("string")
    @tidied
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = compiled(model_file)
        for batch in batches:
            yield pa.array([None if x is None else model.decode(x) for x in batch.to_pylist()], pa.string())

    return docs.withColumn("decoded", run(F.col(ids)))


def round_trips(docs: DataFrame, model_file: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with ``n_ids``, ``ids_crc32`` (little-endian 32-bit) and ``restored``.

    ``restored`` tells whether decoding the ids gives the text back; NULL for NULL texts.
    """
    small_batches(docs.sparkSession)

    @F.arrow_udf("n_ids long, ids_crc32 long, restored boolean")
    @tidied
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import zlib

        model = compiled(model_file)
        for batch in batches:
            rows = []
            for t in batch.to_pylist():
                ids = [] if t is None else model.encode(t)
                crc = None if t is None else zlib.crc32(np.array(ids, "<u4").tobytes())
                rows.append((len(ids), crc, None if t is None else model.decode(ids) == t))
            kinds = (pa.int64(), pa.int64(), pa.bool_())
            columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.StructArray.from_arrays(columns, ["n_ids", "ids_crc32", "restored"])

    return with_struct(docs, run(F.col(text)), ["n_ids", "ids_crc32", "restored"])


def op7_sentencepiece(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return round_trips(docs).select("doc_id", "n_ids", "ids_crc32", "restored")
