"""Mixture-controlled packing of token streams into fixed-length sequences.

Every source is a queue of its documents' tokens.  Output positions are filled window by
window by deficit round-robin: in each window a queue is served its quantum, the window's
size times the source's target share, plus the fraction of a token it was owed before.  The
deficit after x positions is ``x * share - served(x)``; serving ``floor`` of the cumulative
shares keeps every queue within one token of its target at every window edge.  Because that
rule is closed, a task finds the windows of its own documents from the number of tokens that
precede them in their queue, and deficits carry over windows and partitions without any
sequential pass.  When a queue runs dry the others share on in proportion (a new phase).

Every source is a queue of its own, however many there are.  The driver's schedule names only
sources with a target share.  All others are served in one last phase, each in proportion to
its tokens; their places in it are a table, joined by queue, that is summed group by group.

Windows are cut into sequences without gaps.  What is left at the very end is cut into
sequences of falling powers of two, so that nothing is padded.  Documents are cut at window
quanta and sequence edges only.

A document's tokens are its ids followed by the end id.  Words between ASCII blanks are
tokenised once per task and word; the tokenizer's splitting never crosses a blank, so the
ids are those of the whole text.

Defined results: NULL and empty texts are one end id.  NULL and empty sources share a queue.
Target shares default to the corpus's own; sources without a target follow after all others.
Repeated rows are packed each; NULL ``doc_id`` passes through; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import string
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensoria.llm.words import WordTable, give_back, small_batches, tidied, words_of
from sensoria.session import cut_lineage

#: Letters beside a-z that are tried out for the tokenizer's model.
_LETTERS = [chr(c) for c in (*range(0xDF, 0x250), *range(0x3AC, 0x3CF), *range(0x430, 0x460))]


@dataclass
class Settings:
    """``shares`` maps sources to target weights.

    Sources without one are summed in ``max_queues`` groups, whose totals the driver holds.
    """

    tokenizer: str | None = None
    end_id: int = 2
    sequence: int = 4096
    window_sequences: int = 16
    shares: dict[str, float] | None = None
    max_queues: int = 4096


class WordTokens:
    """Token ids of words, computed once per word and task while the word keeps coming.

    Tokenizers that lower-case and part letters from marks (the public one does; both are tried
    out) get words in lower case with the marks behind them as words of their own, so that fewer
    words differ.  New words of letters are encoded many at a time, parted by blanks: each is one
    run of letters, so it ends with the only id that carries the tokenizer's end-of-word mark.
    Words of letters and signs that were tried out one by one are parted here and go to the
    tokenizer's model itself, where that gives the same (tried out too).  Where the counts do not
    agree (another kind of tokenizer), words are encoded one by one.

    Texts with a token such as ``<|endoftext|>`` in them, in whatever case, are encoded whole.
    """

    def __init__(self, path: str | None, limit: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        self.tokenizer = Tokenizer.from_file(path)
        names = (self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size()))
        self.ends = np.array([name.endswith("</w>") for name in names])
        self.table = WordTable(limit=limit)
        self.ids = np.zeros(0, np.uint32)
        self.start, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        added = [re.escape(t.content.encode().lower()) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(added)) if added else None
        shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.shown = {ord(c): "".join(x for x, _ in shown(c)) for c in map(chr, range(128))}
        for c in range(0x80, 0xC0):
            # the last sign stands for the last byte, the first for the first one
            self.shown[c] = "".join(x for x, _ in shown(bytes([0xC3, c]).decode()))[-1]
        for c in range(0xC2, 0xE0):
            self.shown[c] = "".join(x for x, _ in shown(bytes([c, 0x80]).decode()))[0]
        del self.shown[10]
        trials = [" Abc, dE?! ", "É a. B;", string.ascii_letters, "x:! y'S, I'm."]
        self.parts = [self._encode([t])[0] == self._encode([self._parted(t)])[0] for t in trials]
        plain = [*string.ascii_lowercase, string.ascii_lowercase, "anthe", "thonreha"]
        self.plain = self._agree(plain, [[t] for t in plain])
        tried = [c for c in _LETTERS if c.isalpha() and c.lower() == c]
        tried = [c for c in tried if self._agree([c, f"a{c}a"], [[c], [f"a{c}a"]])]
        letters = "a-z" + "".join(tried)
        self.pieces = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[0-9]|[^0-9{letters}]+")
        signs = [chr(c) for c in range(33, 127) if not chr(c).isupper()]
        mixed = ["x's", "'sa'll", "$'s", "1a2b", "don't", "'ss", "a_b-c", "".join(signs), "''re", *signs]
        self.mixed = self.plain and self._agree(mixed, [self.pieces.findall(t) for t in mixed])
        self.known = re.compile(rf"[!-@\[-~{letters}]+")

    def _agree(self, words: list[str], pieces: list[list[str]]) -> bool:
        """Whether the model's ids of the pieces are the tokenizer's of the words."""
        return all(x == self._modelled(p)[0].tolist() for x, p in zip(self._encode(words), pieces, strict=True))

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _modelled(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, one after the other, and their number for each piece."""
        run = "\n".join(pieces)
        if not (run.isascii() and run.isprintable()):
            pieces = run.encode().decode("latin-1").translate(self.shown).split("\n")
        found = list(map(self.tokenizer.model.tokenize, pieces))
        size = np.fromiter(map(len, found), np.int64, len(found))
        return np.array([token.id for tokens in found for token in tokens], np.uint32), size

    @staticmethod
    def _parted(text: str) -> str:
        return b" ".join(words_of([text.encode()], parted=True)[0].to_pylist()).decode()

    def _shrink(self) -> None:
        """Keep the ids of the words that stay."""
        kept = self.table.shrink()
        size = self.size[kept]
        begin = np.cumsum(size) - size
        self.ids = self.ids[np.repeat(self.start[kept] - begin, size) + np.arange(int(size.sum()))]
        self.start, self.size = begin, size

    def _sized(self, words: list[str], joined: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of words, one after the other, and their number for each word, in chunks."""
        parts, sizes = [], []
        for start in range(0, len(words), 500):
            some = words[start : start + 500]
            if joined:
                ids = np.array(self._encode([" ".join(some)])[0], np.uint32)
                size = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            if not joined or len(size) != len(some) or size.sum() != len(ids):
                found = self._encode(some)
                size = np.array([len(x) for x in found], np.int64)
                ids = np.array([i for x in found for i in x], np.uint32)
            parts.append(ids)
            sizes.append(size)
        return parts, sizes

    def _known(self, words: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The same for words whose letters and signs were all tried out."""
        parts, sizes = [], []
        for start in range(0, len(words), 500):
            pieces = list(map(self.pieces.findall, words[start : start + 500]))
            ids, size = self._modelled(list(chain.from_iterable(pieces)))
            first = np.cumsum([0, *map(len, pieces[:-1])])
            parts.append(ids)
            sizes.append(np.add.reduceat(size, first))
        return parts, sizes

    def _learn(self, words: list[bytes]) -> None:
        fresh = b"\n".join(words).decode().split("\n")
        kind = np.fromiter(map(self._kind, fresh), np.int8, len(fresh))
        start, size, end = np.zeros(len(fresh), np.int64), np.zeros(len(fresh), np.int64), len(self.ids)
        held = [self.ids]
        ways = (self._known, partial(self._sized, joined=True), partial(self._sized, joined=True), partial(self._sized, joined=False))
        for number, way in enumerate(ways):
            rows = np.flatnonzero(kind == number)
            parts, sizes = way([fresh[i] for i in rows.tolist()])
            if parts:
                size[rows] = np.concatenate(sizes)
                start[rows] = end + np.cumsum(size[rows]) - size[rows]
                end += int(size[rows].sum())
                held += parts
        self.ids = np.concatenate(held)
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])

    def _kind(self, word: str) -> int:
        """0: known letters and signs, 1: other ASCII letters, 2: other letters, 3: others."""
        letters = word.isalpha()
        if self.mixed and self.known.fullmatch(word) or self.plain and letters and word.isascii() and word.islower():
            return 0
        return 3 if not letters else 1 if word.isascii() else 2 if word.lower().isalpha() else 3

    def _apart(self, texts: pa.Array) -> np.ndarray:
        """Rows of the texts with tokens that blanks and marks must not part, in whatever case."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        data = texts.buffers()[2]
        if self.added is None or data is None or not self.added.search(data.to_pybytes().lower()):
            return np.zeros(0, np.int64)
        return np.array([i for i, t in enumerate(texts) if self.added.search(t.as_py().lower())], np.int64)

    def encode(self, texts: pa.Array | list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and their number for each text."""
        if len(self.table.words) > self.table.limit:
            self._shrink()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_binary())
        whole = self._apart(texts)
        if len(whole):
            gaps = np.zeros(len(texts), bool)
            gaps[whole] = True
            exact = self._encode([texts[i].cast(pa.string()).as_py() for i in whole.tolist()])
            texts = pc.if_else(pa.array(gaps), pa.scalar(None, texts.type), texts)
        cut = all(self.parts)
        words, lengths = self.table.batch(texts, partial(words_of, lowered=cut, parted=cut))
        added = self.table.fresh()
        if added:
            self._learn(added)
        size = self.size[words]
        edges = np.concatenate([[0], np.cumsum(size)])
        shift = np.repeat(self.start[words] - edges[:-1], size)
        shift += np.arange(len(shift))
        flat, number = self.ids[shift], np.diff(edges[np.concatenate([[0], np.cumsum(lengths)])])
        if len(whole):
            at = np.repeat((np.cumsum(number) - number)[whole], [len(x) for x in exact])
            flat = np.insert(flat, at, np.fromiter(chain.from_iterable(exact), np.uint32))
            number[whole] = [len(x) for x in exact]
        return flat, number


def tokenised(docs: DataFrame, s: Settings, text: str, key: str, source: str) -> DataFrame:
    """``doc_id, queue, part, before, tokens, ids``: ids as little-endian 32-bit, end id included.

    ``before`` counts the queue's tokens earlier in the same partition.
    """
    small_batches(docs.sparkSession)
    queue = F.coalesce(F.col(source).cast("string"), F.lit(""))

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordTokens(s.tokenizer)
        give_back()
        part = TaskContext.get().partitionId()
        sums: dict[str, int] = defaultdict(int)
        end = np.array([s.end_id], np.uint32).tobytes()
        for batch in batches:
            flat, number = words.encode(batch.column(2))
            data, edges = flat.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(number)]) * 4
            before, ids = [], []
            for i, name in enumerate(batch.column(1).to_pylist()):
                ids.append(data[edges[i] : edges[i + 1]] + end)
                before.append(sums[name])
                sums[name] += int(number[i]) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([part] * len(ids), pa.int32()),
                    pa.array(before, pa.int64()), pa.array(number + 1), pa.array(ids, pa.binary()),
                ],
                ["doc_id", "queue", "part", "before", "tokens", "ids"],
            )
            # a batch leaves more unused than the words kept for the next one take
            del flat, data, ids
            give_back()

    rows = docs.select(F.col(key).alias("doc_id"), queue.alias("queue"), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(run, f"doc_id {kind}, queue string, part int, before long, tokens long, ids binary")


@dataclass
class Phase:
    """A stretch of positions in which the same queues are served."""

    start: int
    length: int
    base: dict[str, int]  # tokens of each queue served before
    below: dict[str, int]  # tokens of the queues in front, within the phase
    served: dict[str, int]  # tokens of the queue, within the phase


@dataclass
class Schedule:
    settings: Settings
    total: int
    phases: list[Phase] = field(default_factory=list)
    last: Phase | None = None  # of the queues without a target that ``place`` is told about

    def place(
        self, queue: str, first: int, last: int, rest: tuple[int, int] | None = None
    ) -> Iterator[tuple[int, int, int]]:
        """Runs (token of the queue, position, length) covering tokens first to last of a queue.

        ``rest`` is (tokens of such queues in front, own tokens) of a queue without a target.
        """
        window = self.settings.sequence * self.settings.window_sequences
        for p in [self.last] if rest else self.phases:
            below, share = rest or (p.below.get(queue, 0), p.served.get(queue, 0))
            base = p.base.get(queue, 0)
            at, stop = max(first, base), min(last, base + share)
            if at >= stop:
                continue

            def before(x: int, part: int, length: int = p.length) -> int:
                return x * part // length

            def own(x: int, share=share, below=below, before=before) -> int:
                return before(x, below + share) - before(x, below)

            number = (p.start + (at - base) * p.length // share) // window
            while number * window > p.start and own(number * window - p.start) > at - base:
                number -= 1
            while at < stop:
                low = max(p.start, number * window) - p.start
                high = min(p.start + p.length, (number + 1) * window) - p.start
                ends = base + own(high)
                if at < ends:
                    length = min(stop, ends) - at
                    position = p.start + low + before(high, below) - before(low, below) + at - base - own(low)
                    yield at, position, length
                    at += length
                number += 1

    def sequence_of(self, position: int) -> tuple[int, int, int]:
        """Sequence number, offset in it, and positions left in it."""
        size = self.settings.sequence
        full = self.total // size
        if position < full * size:
            return position // size, position % size, size - position % size
        number, start, left = full, full * size, self.total - full * size
        while True:
            part = 1 << (left.bit_length() - 1)
            if position < start + part:
                return number, position - start, start + part - position
            number, start, left = number + 1, start + part, left - part


def schedule(totals: dict[str, int], s: Settings, rest: int = 0) -> Schedule:
    """Phases from the tokens in each queue and the target shares; ``rest`` tokens come last."""
    plan = Schedule(s, sum(totals.values()) + rest)
    left = {q: n for q, n in sorted(totals.items()) if n > 0}
    weight = {q: float((s.shares or {}).get(q, 0.0)) for q in left} if s.shares else {q: float(n) for q, n in left.items()}
    done: dict[str, int] = dict.fromkeys(left, 0)
    start = 0
    while left:
        active = [q for q in left if weight[q] > 0] or list(left)
        if not any(weight[q] > 0 for q in active):
            weight |= {q: float(left[q]) for q in active}
        rounds = min(left[q] / weight[q] for q in active)
        served = {q: left[q] if left[q] / weight[q] <= rounds * (1 + 1e-12) else int(rounds * weight[q]) for q in active}
        served = {q: n for q, n in served.items() if n > 0}
        below, run = {}, 0
        for q in served:
            below[q] = run
            run += served[q]
        plan.phases.append(Phase(start, run, {q: done[q] for q in served}, below, served))
        start += run
        for q, n in served.items():
            done[q] += n
            left[q] -= n
        left = {q: n for q, n in left.items() if n > 0}
    plan.last = Phase(start, rest, {}, {}, {})
    return plan


def pack(
    docs: DataFrame, settings: Settings | None = None,
    text: str = "text", key: str = "doc_id", source: str = "source",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset, queue``."""
    s = settings or Settings()
    rows = cut_lineage(tokenised(docs, s, text, key, source))
    parts = rows.groupBy("queue", "part").agg(F.sum("tokens").alias("tokens"))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cut_lineage(
        parts.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    )
    named = [q for q, weight in (s.shares or {}).items() if weight > 0]
    totals = cut_lineage(
        offsets.groupBy("queue").agg(F.sum("tokens").alias("total")).withColumn("named", F.col("queue").isin(named))
        .withColumn("group", F.pmod(F.xxhash64("queue"), F.lit(s.max_queues)))
    )
    targets = {row["queue"]: row["total"] for row in totals.where("named").collect()}
    sums = totals.where("NOT named").groupBy("group").agg(F.sum("total").alias("total")).orderBy("group").collect()
    ahead, rest = [], 0
    for row in sums:
        ahead.append((row["group"], rest))
        rest += row["total"]
    plan = schedule(targets, s, rest)
    ahead = docs.sparkSession.createDataFrame(ahead, "group long, ahead long")
    within = Window.partitionBy("group").orderBy("queue").rowsBetween(Window.unboundedPreceding, -1)
    untargeted = totals.where("NOT named").withColumn("within", F.coalesce(F.sum("total").over(within), F.lit(0)))
    below = untargeted.join(F.broadcast(ahead), "group").select(
        "queue", (F.col("ahead") + F.col("within")).alias("below"), "total"
    )
    shared = docs.sparkSession.sparkContext.broadcast(plan)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            queues, places, ids, ahead, own = (batch.column(i).to_pylist() for i in (1, 2, 3, 4, 5))
            out: list[tuple] = []
            for i, (queue, first, data) in enumerate(zip(queues, places, ids, strict=True)):
                count = len(data) // 4
                rest = None if own[i] is None else (ahead[i], own[i])
                for token, position, length in plan.place(queue, first, first + count, rest):
                    begin = token - first
                    while length:
                        number, offset, room = plan.sequence_of(position)
                        size = min(room, length)
                        out.append((i, begin, size, data[4 * begin : 4 * (begin + size)], count, number, offset))
                        begin, position, length = begin + size, position + size, length - size
            row = pa.array([x[0] for x in out], pa.int64())
            longs = [pa.array([x[k] for x in out], pa.int64()) for k in (1, 2, 4, 5, 6)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(row), *longs[:2], pa.array([x[3] for x in out], pa.binary()),
                    *longs[2:], batch.column(1).take(row),
                ],
                ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "queue"],
            )

    starts = offsets.select("queue", "part", "base").join(below, "queue", "left")
    placed = rows.join(starts, ["queue", "part"]).select(
        "doc_id", "queue", (F.col("base") + F.col("before")).alias("first"), "ids", "below", "total"
    )
    kind = dict(rows.dtypes)["doc_id"]
    return placed.mapInArrow(
        run,
        f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
        "offset long, queue string",
    )


def op6_packing(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return pack(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset", "queue",
    )
