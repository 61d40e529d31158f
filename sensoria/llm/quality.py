"""Quality scores from weak labels: label model by expectation-maximisation, hashed linear scorer.

1. Overlapping heuristics (*labellers*) look at every whole text and vote good, bad or nothing.
2. A label model with one accuracy per labeller is fitted to the table of vote
   patterns by expectation-maximisation.  There are at most 3^labellers patterns, counted over
   all texts, so the fit is exact whatever the size of the corpus.
3. The posterior of its votes is a text's soft label.  A logistic scorer over hashed words and
   surface signals is trained on the posteriors of a bounded sample of texts, weighted by how
   sure they are, and scores all texts.  It also judges texts on which all labellers abstain.

Defined results: NULL, empty and blank texts are bad without a vote: score 0, not kept.
Rows are judged one by one; repeated rows get equal scores.  If no text gets a vote, posteriors
are the prior.  Columns of the input are kept; the result's names win.  An empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensoria.llm.language import with_struct
from sensoria.llm.words import WordTable, hash_words, raw, small_batches, sum_by_text, tidied, words_of

SIGNALS = ("words", "word_length", "symbols", "upper", "digits", "variety", "repeats", "short_lines", "ends")
LABELLERS = (
    "length", "word_length", "symbols", "upper", "variety", "repeats", "line_shape", "sentence_ends",
    "prose",
)
GOOD, BAD, NONE = 2, 1, 0
RESULT = ["quality", "posterior", "kept"]


@dataclass
class Settings:
    """``sample`` bounds the texts the linear scorer is trained on."""

    sample: int = 4000
    bits: int = 16
    rounds: int = 60
    epochs: int = 12
    rate: float = 0.3
    decay: float = 1e-4
    prior_good: float = 0.5
    accuracy: float = 0.9
    trust: float = 0.25
    threshold: float = 0.5
    seed: int = 5


@dataclass
class LabelModel:
    """Accuracy of each labeller's votes, and the prior of the good class.

    The prior is a setting: estimated along, it would talk down every labeller that is alone
    in finding its kind of bad text.
    """

    accuracy: np.ndarray
    good: float

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance of the good class for rows of votes; abstaining says nothing."""
        trust = np.log(self.accuracy / (1 - self.accuracy))
        sign = (patterns == GOOD).astype(np.float64) - (patterns == BAD)
        level = sign @ trust + np.log(self.good / (1 - self.good))
        return 1 / (1 + np.exp(-np.clip(level, -50, 50)))


@dataclass
class Model:
    settings: Settings
    labels: LabelModel
    words: np.ndarray = field(repr=False)
    signals: np.ndarray = field(repr=False)
    bias: float


def _word_signals(words: list[bytes]) -> np.ndarray:
    """Per word: length, symbols, capitals, digits, hash; lengths in bytes."""
    flat = np.frombuffer(b"".join(words), np.uint8)
    size = np.fromiter(map(len, words), np.int64, len(words))
    out = np.zeros((len(words), 5), np.float64)
    out[:, 0] = size
    if len(flat):
        upper = (flat >= 65) & (flat <= 90)
        digit = (flat >= 48) & (flat <= 57)
        letter = upper | (flat >= 97) & (flat <= 122) | (flat >= 128)
        plain = (flat == 46) | (flat == 44) | (flat == 39) | (flat == 45)
        starts = np.cumsum(size) - size
        for column, mark in ((1, ~letter & ~digit & ~plain), (2, upper), (3, digit)):
            out[:, column] = np.add.reduceat(mark, starts, dtype=np.int64)
    out[:, 4] = (hash_words([w.lower() for w in words]) >> np.uint64(32)).astype(np.float64)
    return out


def surface(texts: list[bytes | None], table: WordTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signals of each text; word hashes of all texts, one after the other; words per text."""
    flat, lengths = table.batch(texts, partial(words_of, lowered=False))
    rows = table.rows[flat] if len(flat) else np.zeros((0, 5))
    sums = sum_by_text(rows[:, :4], lengths)
    count = np.maximum(lengths, 1)
    size = np.maximum(sums[:, 0], 1)
    out = np.zeros((len(texts), len(SIGNALS)))
    out[:, 0] = np.log1p(lengths)
    out[:, 1] = sums[:, 0] / count
    out[:, 2], out[:, 3], out[:, 4] = sums[:, 1] / size, sums[:, 2] / size, sums[:, 3] / size
    hashes = rows[:, 4].astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    # distinct words per root of the length, and neighbours that are equal
    distinct = np.bincount(np.unique(owner << 32 | hashes) >> 32, minlength=len(texts)) if len(owner) else np.zeros(len(texts))
    out[:, 5] = distinct / np.sqrt(count)
    same = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    out[:, 6] = np.bincount(owner[1:][same], minlength=len(texts)) / count
    for i, text in enumerate(texts):
        lines = [line for line in (text or b"").split(b"\n") if line.strip()]
        out[i, 7] = sum(len(line) < 20 for line in lines) / max(1, len(lines))
        out[i, 8] = sum(line.rstrip()[-1:] in b".!?\"'" for line in lines) / max(1, len(lines))
    return out, hashes, lengths


def votes(signals: np.ndarray) -> np.ndarray:
    """Votes of all labellers, texts x labellers."""
    n, mean, symbols, upper, _, variety, repeats, short, ends = signals.T
    count, never = np.expm1(n), np.zeros(len(n), bool)

    def vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
        return np.where(bad, BAD, np.where(good, GOOD, NONE)).astype(np.int8)

    return np.stack(
        [
            vote(never, count < 8),
            vote(never, (mean < 2) | (mean > 14)),
            vote(never, symbols > 0.08),
            vote(never, upper > 0.3),
            vote(never, (count >= 20) & (variety < 2)),
            vote(never, (count >= 8) & (repeats > 0.2)),
            vote(never, (short > 0.7) & (count >= 20)),
            vote(never, (ends < 0.3) & (count >= 8)),
            vote((symbols < 0.02) & (upper < 0.1) & (repeats < 0.1) & (short < 0.3) & (count >= 20), never),
        ],
        axis=1,
    )


def fit_labels(patterns: np.ndarray, counts: np.ndarray, s: Settings) -> LabelModel:
    """Expectation-maximisation over vote patterns and their numbers of texts.

    Starts from labellers that are right in ``accuracy`` of their votes; that start also counts
    as ``trust`` of their votes in every estimate, which keeps the two classes' meaning.
    """
    model = LabelModel(np.full(patterns.shape[1], s.accuracy), s.prior_good)
    if not len(patterns):
        return model
    says_good, says_bad = patterns == GOOD, patterns == BAD
    voted = ((says_good | says_bad) * counts[:, None]).sum(axis=0)
    firm = 1 + s.trust * voted
    for _ in range(s.rounds):
        good = model.posterior(patterns)
        right = ((says_good * good[:, None] + says_bad * (1 - good[:, None])) * counts[:, None]).sum(axis=0)
        model = LabelModel(
            np.clip((right + firm * s.accuracy) / (voted + firm), 0.55, 0.99),
            s.prior_good,
        )
    return model


def _pattern_number(found: np.ndarray) -> np.ndarray:
    return found.astype(np.int64) @ 3 ** np.arange(found.shape[1])


def _patterns(numbers: np.ndarray, labellers: int) -> np.ndarray:
    return (numbers[:, None] // 3 ** np.arange(labellers)) % 3


def vote_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``pattern, n``: texts with each combination of votes, pre-aggregated in every task."""
    small_batches(docs.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = WordTable(_word_signals, limit=150_000), np.zeros(3 ** len(LABELLERS), np.int64)
        for batch in batches:
            texts = raw(batch.column(0))
            signals, _, lengths = surface(texts, table)
            total += np.bincount(_pattern_number(votes(signals))[lengths > 0], minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["pattern", "n"])

    parts = docs.select(F.col(text).alias("text")).mapInArrow(run, "pattern long, n long")
    return parts.groupBy("pattern").agg(F.sum("n").alias("n"))


def _scaled(signals: np.ndarray) -> np.ndarray:
    return signals / np.array([8.0, 10.0, 0.2, 0.5, 0.2, 10.0, 0.3, 1.0, 1.0])


def fit_scorer(texts: list[bytes], labels: LabelModel, s: Settings) -> Model:
    """Logistic regression on posteriors by mini-batch gradient steps; runs on the driver."""
    table = WordTable(_word_signals, limit=10**9)
    signals, hashes, lengths = surface(texts, table)
    target = labels.posterior(votes(signals).astype(np.int64))
    sure = np.abs(2 * target - 1)
    x, place = _scaled(signals), hashes & ((1 << s.bits) - 1)
    words, linear, bias = np.zeros(1 << s.bits), np.zeros(x.shape[1]), 0.0
    starts = np.cumsum(lengths) - lengths
    rng = np.random.default_rng(s.seed)
    for epoch in range(s.epochs if len(texts) else 0):
        rate = s.rate / (1 + epoch)
        for pick in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // 64)):
            at = np.concatenate([place[starts[i] : starts[i] + lengths[i]] for i in pick])
            owner = np.repeat(np.arange(len(pick)), lengths[pick])
            share = 1 / np.sqrt(np.maximum(lengths[pick], 1))
            level = np.bincount(owner, words[at], len(pick)) * share + x[pick] @ linear + bias
            slope = (1 / (1 + np.exp(-np.clip(level, -30, 30))) - target[pick]) * sure[pick] / len(pick)
            np.subtract.at(words, at, rate * (slope * share)[owner])
            linear -= rate * 8 * (x[pick].T @ slope + s.decay * linear)
            bias -= rate * 8 * float(slope.sum())
    return Model(s, labels, words.astype(np.float32), linear, bias)


def train(docs: DataFrame, settings: Settings | None = None, text: str = "text", key: str = "doc_id") -> Model:
    """Label model over all texts, scorer over a sample of at most ``sample`` texts by key hash."""
    s = settings or Settings()
    found = vote_counts(docs, text).orderBy("pattern").toPandas()
    patterns = _patterns(found["pattern"].to_numpy(np.int64), len(LABELLERS))
    labels = fit_labels(patterns, found["n"].to_numpy(np.float64), s)
    rows = docs.select(
        F.col(text).alias("text"), F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string")), 1).alias("place")
    ).where("text IS NOT NULL")
    share = min(1.0, 1.2 * s.sample / max(1, float(found["n"].sum())))
    picked = rows.where(F.col("place") <= F.lit(int(share * 2**62) * 2 - 1)).orderBy("place", "text")
    texts = [row["text"].encode() for row, _ in zip(picked.toLocalIterator(), range(s.sample), strict=False)]
    return fit_scorer([t for t in texts if t.strip()], labels, s)


def judge(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``quality`` (scorer, 0 to 1), ``posterior`` (label model) and ``kept``."""
    spark = small_batches(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("quality double, posterior double, kept boolean")
    @tidied
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        s, table = model.settings, WordTable(_word_signals, limit=150_000)
        for batch in batches:
            signals, hashes, lengths = surface(raw(batch), table)
            weight = model.words[hashes & ((1 << s.bits) - 1)]
            owner = np.repeat(np.arange(len(lengths)), lengths)
            level = np.bincount(owner, weight, len(lengths)) / np.sqrt(np.maximum(lengths, 1))
            level = level + _scaled(signals) @ model.signals + model.bias
            some = lengths > 0
            quality = np.where(some, 1 / (1 + np.exp(-np.clip(level, -30, 30))), 0.0)
            posterior = np.where(some, model.labels.posterior(votes(signals).astype(np.int64)), 0.0)
            columns = [pa.array(quality), pa.array(posterior), pa.array(quality >= s.threshold)]
            yield pa.StructArray.from_arrays(columns, RESULT)

    return with_struct(docs, run(F.col(text)), RESULT)


def op1_quality(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return judge(docs, train(docs)).select("doc_id", *RESULT)
