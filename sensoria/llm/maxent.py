"""Language-model scores from a hashed maximum-entropy model with class-factored softmax.

``P(word | context) = P(class | context) * P(word | class)``.  The class has a softmax over
hashed features of the context: the word before, the two classes before (n-grams), the word
two before and the classes two and three before (skips).  Within a class a word has its
add-one share of the training counts.  Frequent words are classes of their own; the others
go by their last two bytes, the most frequent endings each a class, the rest one class.

1. Word counts over all training texts, pre-aggregated in every task, summed by word.
2. Each round, every task takes gradient steps on its own training texts from the shared
   weights; the moves of each weight row are averaged over tasks by the tokens behind them.
3. Scoring is one pass in sparse numpy batches.  Frequent words' counts are broadcast (at most
   ``Settings.head``); each text's rarer words meet the count table in a join, at most one row
   for each text and word.

A word unseen in training has probability 1 / (N + V + 1), as in the base score, and the seen
words share the rest, so the distribution over seen words and one unknown sums to one.

Defined results: NULL and empty texts consist of the end token.  Rows with NULL ``doc_id``
are scored, not learned from.  Rows are scored one by one; repeated rows get equal scores.
Without training texts every probability is 1 / (N + V + 1).  Words are told apart by 64-bit
hashes.  Other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensoria.llm.language import remainder
from sensoria.llm.words import WordTable, hash_words, mix, small_batches, tidied
from sensoria.session import cut_lineage

FORM_BITS = 12
_AT_ONCE = 512
_SEED = np.uint64(0x9E3779B97F4A7C15)
END = np.int64(-1)  # stands for the end token's hash
START = np.int64(-2)


@dataclass
class Settings:
    own_classes: int = 32
    form_classes: int = 62
    row_bits: int = 13
    head: int = 200_000
    rounds: int = 1
    rate: float = 0.4
    batch: int = 8192


@dataclass
class Vocabulary:
    """What counting gives: totals, frequent words, classes."""

    tokens: int  # N
    words: int  # V
    ends: int
    head: np.ndarray = field(repr=False)  # sorted hashes
    counts: np.ndarray = field(repr=False)  # their counts
    own: np.ndarray = field(repr=False)  # sorted hashes with a class of their own
    of_form: np.ndarray = field(repr=False)  # class by form
    mass: np.ndarray = field(repr=False)  # N_k + V_k by class

    @property
    def unseen(self) -> float:
        return 1.0 / (self.tokens + self.words + 1)


@dataclass
class Model:
    settings: Settings
    vocabulary: Vocabulary
    bias: np.ndarray = field(repr=False)
    rows: np.ndarray = field(repr=False)


def _forms(words: list[bytes]) -> np.ndarray:
    """Twelve-bit hash of each word's last two bytes."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat, end = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64), np.cumsum(size)
    value = np.where(size > 1, flat[end - 2], np.uint64(0)) << np.uint64(8) | flat[end - 1]
    return (mix(value + _SEED) >> np.uint64(64 - FORM_BITS)).astype(np.int64)


def _plain(words: list[bytes]) -> np.ndarray:
    return np.stack([hash_words(words).view(np.int64), _forms(words)], axis=1)


def _find(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted value and whether it is there."""
    if not len(sorted_values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return at, sorted_values[at] == wanted


def _features(vocabulary: Vocabulary):
    """Columns: hash, class, count (-1 beyond the head), identity in contexts."""

    def features(words: list[bytes]) -> np.ndarray:
        plain = _plain(words)
        at, frequent = _find(vocabulary.head, plain[:, 0])
        own, single = _find(vocabulary.own, plain[:, 0])
        kind = np.where(single, own, vocabulary.of_form[plain[:, 1]])
        count = np.where(frequent, vocabulary.counts[at] if len(vocabulary.counts) else 0, -1)
        return np.stack([plain[:, 0], kind, count, np.where(frequent, plain[:, 0], plain[:, 1])], axis=1)

    return features


def count_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``hash, form, count`` of every word, pre-aggregated in each task."""
    small_batches(docs.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, total = WordTable(_plain), np.zeros(0, np.int64)

        def held() -> pa.RecordBatch:
            rows = table.rows[: table.filled]
            return pa.RecordBatch.from_arrays(
                [pa.array(rows[:, 0]), pa.array(rows[:, 1]), pa.array(total)], ["hash", "form", "count"]
            )

        for batch in batches:
            if len(table.words) > table.limit:
                yield held()
                table.reset()
                total = np.zeros(0, np.int64)
            flat, _ = table.batch(batch.column(0))
            fresh = np.bincount(flat, minlength=len(table.words))
            fresh[: len(total)] += total
            total = fresh
        if table.filled:
            yield held()

    parts = docs.select(F.col(text).alias("text")).mapInArrow(run, "hash long, form long, count long")
    return parts.groupBy("hash", "form").agg(F.sum("count").alias("count"))


def vocabulary_of(counts: DataFrame, ends: int, s: Settings) -> Vocabulary:
    """Bounded extracts of the count table: totals, head, classes."""
    top = 100_000
    levels = {
        row["level"]: row["n"]
        for row in counts.groupBy(F.least("count", F.lit(top)).alias("level")).agg(F.count("*").alias("n")).collect()
    }
    # the smallest count at which the head still fits its bound
    floor, held = top + 1, 0
    for level in sorted(levels, reverse=True):
        if held + levels[level] > s.head:
            break
        floor, held = level, held + levels[level]
    found = counts.where(F.col("count") >= floor).select("hash", "form", "count").toPandas()
    forms = counts.groupBy("form").agg(F.sum("count").alias("n"), F.count("*").alias("v")).toPandas()
    found = found.sort_values("hash")
    order = np.lexsort((found["hash"], -found["count"]))[: s.own_classes]
    own = found.iloc[order].sort_values("hash")
    mass_n, mass_v = np.zeros(1 << FORM_BITS), np.zeros(1 << FORM_BITS)
    mass_n[forms["form"]], mass_v[forms["form"]] = forms["n"], forms["v"]
    np.subtract.at(mass_n, own["form"].to_numpy(), own["count"].to_numpy())
    np.subtract.at(mass_v, own["form"].to_numpy(), 1)
    big = np.lexsort((np.arange(len(mass_n)), -mass_n))[: s.form_classes]
    big = big[mass_n[big] > 0]
    rest = len(own) + len(big)
    of_form = np.full(1 << FORM_BITS, rest, np.int64)
    of_form[big] = len(own) + np.arange(len(big))
    mass = np.zeros(rest + 2)
    mass[: len(own)] = own["count"].to_numpy() + 1
    np.add.at(mass, of_form, mass_n + mass_v)
    mass[rest + 1] = ends + 1 if ends else 0
    return Vocabulary(
        int(forms["n"].sum()) + ends, int(forms["v"].sum()) + (1 if ends else 0), ends,
        found["hash"].to_numpy(np.int64), found["count"].to_numpy(np.int64), own["hash"].to_numpy(np.int64), of_form, mass,
    )


@dataclass
class Tokens:
    """All tokens of a batch of texts, the end tokens included."""

    text: np.ndarray
    hash: np.ndarray
    kind: np.ndarray
    count: np.ndarray
    rows: np.ndarray  # weight rows, tokens x features


def tokens_of(texts: pa.Array | list[bytes | None], table: WordTable, vocabulary: Vocabulary, s: Settings) -> Tokens:
    flat, lengths = table.batch(texts)
    size = lengths + 1
    text = np.repeat(np.arange(len(texts)), size)
    ends = np.cumsum(size) - 1
    columns = np.empty((len(text), 4), np.int64)
    inner = np.ones(len(text), bool)
    inner[ends] = False
    if len(flat):
        columns[inner] = table.rows[flat]
    last = len(vocabulary.mass) - 1
    columns[ends] = [END, last, vocabulary.ends, END]
    position = np.arange(len(text)) - np.repeat(ends + 1 - size, size)

    def back(values: np.ndarray, steps: int, none: int) -> np.ndarray:
        out = np.full(len(values), none, np.int64)
        out[steps:] = values[:-steps] if steps < len(values) else out[steps:]
        out[position < steps] = none
        return out

    kind = columns[:, 1]
    k1, k2, k3 = (back(kind, n, last + 1) for n in (1, 2, 3))
    parts = [back(columns[:, 3], 1, START), k1 * 1009 + k2, back(columns[:, 3], 2, START), k2 * 1009 + k3]
    rows = np.stack(
        [
            (mix(p.view(np.uint64) + np.uint64((i + 1) * 0x51ED2701)) >> np.uint64(64 - s.row_bits)).astype(np.int32)
            for i, p in enumerate(parts)
        ],
        axis=1,
    )
    return Tokens(text, columns[:, 0], kind, columns[:, 2], rows)


def _levels(model_rows: np.ndarray, bias: np.ndarray, rows: np.ndarray, level: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """Class weights of each token's context, into ``level``; their sums."""
    np.take(model_rows, rows[:, 0], axis=0, out=level, mode="clip")
    for i in range(1, rows.shape[1]):
        level += np.take(model_rows, rows[:, i], axis=0, out=spare[: len(rows)], mode="clip")
    level += bias
    level -= level.max(axis=1, keepdims=True)
    np.exp(level, out=level)
    return level.sum(axis=1, keepdims=True)


def _chances(model_rows: np.ndarray, bias: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Class probabilities of each token's context; some tokens at a time, which fit a core's cache."""
    out = np.empty((len(rows), model_rows.shape[1]), model_rows.dtype)
    spare = np.empty_like(out[:_AT_ONCE])
    for start in range(0, len(rows), _AT_ONCE):
        level = out[start : start + _AT_ONCE]
        level /= _levels(model_rows, bias, rows[start : start + _AT_ONCE], level, spare)
    return out


def _chances_of(model_rows: np.ndarray, bias: np.ndarray, rows: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Probability of each token's own class."""
    out = np.empty(len(rows), model_rows.dtype)
    held, spare = (np.empty((min(len(rows), _AT_ONCE), model_rows.shape[1]), model_rows.dtype) for _ in range(2))
    for start in range(0, len(rows), _AT_ONCE):
        cut = slice(start, start + _AT_ONCE)
        level = held[: len(rows[cut])]
        total = _levels(model_rows, bias, rows[cut], level, spare)
        out[cut] = level.reshape(-1).take(np.arange(len(level)) * level.shape[1] + kind[cut]) / total[:, 0]
    return out


def _sums_by_row(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, the sum of their values, and how many each has.

    Short runs of equal rows are added place by place, all runs at once; long runs, which come
    first, one by one.
    """
    # sixteen bits are sorted by radix
    order = np.argsort(rows.astype(np.uint16) if len(rows) and rows.max() < 1 << 16 else rows, kind="stable")
    ordered = rows[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    size = np.diff(np.append(first, len(ordered)))
    falling = np.argsort(-size, kind="stable")
    first, size = first[falling], size[falling]
    total = values.take(order[first], axis=0)
    long = int((size > 12).sum())
    for place in range(1, 12):
        stop = int((size > place).sum())
        if stop > long:
            total[long:stop] += values.take(order[first[long:stop] + place], axis=0)
    for run in range(long):
        total[run] = values.take(order[first[run] : first[run] + size[run]], axis=0).sum(axis=0)
    return ordered[first], total, size


def _descend(weights: np.ndarray, squares: np.ndarray, bias: np.ndarray, t: Tokens, s: Settings, seen: np.ndarray) -> None:
    """Gradient steps over a batch's tokens; weights, squares and seen tokens change in place."""
    for start in range(0, len(t.kind), s.batch):
        cut = slice(start, start + s.batch)
        rows, kind = t.rows[cut], t.kind[cut]
        slope = _chances(weights, bias, rows)
        slope[np.arange(len(kind)), kind] -= 1
        for i in range(rows.shape[1]):
            which, gradient, size = _sums_by_row(slope, rows[:, i])
            squares[which] += np.einsum("ij,ij->i", gradient, gradient)
            gradient *= (s.rate / np.sqrt(squares[which] + 1)).astype(np.float32)[:, None]
            weights[which] -= gradient
            seen[which] += size


def train(docs: DataFrame, vocabulary: Vocabulary, s: Settings, text: str = "text") -> Model:
    """Rounds of local gradient steps on all training texts and averaging by row."""
    spark = small_batches(docs.sparkSession)
    classes = len(vocabulary.mass)
    bias = np.log(np.maximum(vocabulary.mass, 1e-3) / max(vocabulary.mass.sum(), 1)).astype(np.float32)
    rows = np.zeros((1 << s.row_bits, classes), np.float32)
    if not vocabulary.tokens:
        return Model(s, vocabulary, bias, rows)
    for _ in range(s.rounds):
        shared = spark.sparkContext.broadcast((vocabulary, bias, rows))

        def local(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            vocabulary, bias, rows = shared.value
            weights, squares, seen = rows.copy(), np.zeros(len(rows)), np.zeros(len(rows), np.int64)
            table = WordTable(_features(vocabulary), limit=200_000)
            for batch in batches:
                t = tokens_of(batch.column(0), table, vocabulary, s)
                _descend(weights, squares, bias, t, s, seen)
            used = np.flatnonzero(seen)
            if len(used):
                move = ((weights[used] - rows[used]) * seen[used, None]).astype(np.float32)
                yield _vectors(used, seen[used], move)

        def added(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            rows = shared.value[2]
            total, seen = np.zeros(rows.shape), np.zeros(len(rows), np.int64)
            for batch in batches:
                if batch.num_rows:
                    at = batch.column(0).to_numpy()
                    data = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float32)
                    np.add.at(total, at, data.reshape(len(at), -1))
                    np.add.at(seen, at, batch.column(1).to_numpy())
            used = np.flatnonzero(seen)
            if len(used):
                yield _vectors(used, seen[used], total[used].astype(np.float32))

        schema = "row long, seen long, move binary"
        moved = docs.select(F.col(text).alias("text")).mapInArrow(local, schema)
        summed = moved.repartition("row").mapInArrow(added, schema).collect()
        rows = rows.copy()
        for row in summed:
            rows[row["row"]] += np.frombuffer(row["move"], np.float32) / row["seen"]
    return Model(s, vocabulary, bias, rows)


def _vectors(rows: np.ndarray, seen: np.ndarray, move: np.ndarray) -> pa.RecordBatch:
    data = [vector.tobytes() for vector in move]
    return pa.RecordBatch.from_arrays(
        [pa.array(rows.astype(np.int64)), pa.array(seen), pa.array(data, pa.binary())], ["row", "seen", "move"]
    )


def gains(model: Model, t: Tokens) -> np.ndarray:
    """log10 of model over base probability of each token, if its word was seen in training."""
    v = model.vocabulary
    out = np.zeros(len(t.kind))
    offset = np.log10(max(1 - v.unseen, 1e-300)) - np.log10(v.unseen) - np.log10(np.maximum(v.mass, 1))
    own = _chances_of(model.rows, model.bias, t.rows, t.kind)
    np.log10(np.maximum(own, 1e-30), out=out)
    out += offset[t.kind]
    return out


_SCORED = (
    "row long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, gain double, "
    "tail array<struct<hash:bigint,times:int,gain:float>>"
)


def scored_parts(docs: DataFrame, model: Model, text: str, key: str) -> DataFrame:
    """Per text: sums over frequent words, and the rarer words left to be looked up."""
    spark = small_batches(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        v, table = model.vocabulary, WordTable(_features(model.vocabulary), limit=200_000)
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            n = batch.num_rows
            t = tokens_of(batch.column(2), table, v, model.settings)
            gain = gains(model, t) if v.tokens else np.zeros(len(t.kind))
            base = np.log10((np.maximum(t.count, 0) + 1) * v.unseen)
            sure, known = t.count >= 0, t.count > 0
            rest = np.flatnonzero(~sure)
            order = rest[np.lexsort((t.hash[rest], t.text[rest]))]
            new = np.ones(len(order), bool)
            new[1:] = (t.text[order][1:] != t.text[order][:-1]) | (t.hash[order][1:] != t.hash[order][:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(order)))
            sums = np.add.reduceat(gain[order], first) if len(first) else np.zeros(0)
            offsets = np.concatenate([[0], np.cumsum(np.bincount(t.text[order][first], minlength=n))])
            tail = pa.ListArray.from_arrays(
                pa.array(offsets.astype(np.int32)),
                pa.StructArray.from_arrays(
                    [pa.array(t.hash[order][first]), pa.array(times.astype(np.int32)), pa.array(sums.astype(np.float32))],
                    ["hash", "times", "gain"],
                ),
            )
            sum_of = lambda values, where, t=t, n=n: np.bincount(t.text[where], values[where], n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(n)), batch.column(0), batch.column(1),
                    pa.array(np.bincount(t.text, minlength=n).astype(np.int64)),
                    pa.array(np.bincount(t.text[known], minlength=n).astype(np.int64)),
                    pa.array(sum_of(base, sure).astype(np.float64)), pa.array(sum_of(gain, known).astype(np.float64)), tail,
                ],
                ["row", "doc_id", "held_out", "n_tokens", "known", "base", "gain", "tail"],
            )
            row += n

    rows = docs.select(F.col(key).alias("doc_id"), "held_out", F.col(text).alias("text"))
    return rows.mapInArrow(run, _SCORED.format(kind=dict(rows.dtypes)["doc_id"]))


def score(docs: DataFrame, settings: Settings | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Scores of all texts; learns from the rows whose ``held_out`` is false.

    Returns ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.
    """
    s = settings or Settings()
    learned = docs.where(F.col(key).isNotNull() & ~F.col("held_out"))
    counts = cut_lineage(count_words(learned, text))
    vocabulary = vocabulary_of(counts, learned.count(), s)
    model = train(learned, vocabulary, s, text)
    scored = cut_lineage(scored_parts(docs, model, text, key))
    tail = scored.select("row", F.explode("tail").alias("t")).select("row", "t.hash", "t.times", "t.gain")
    n = F.coalesce(F.col("count"), F.lit(0))
    looked = (
        tail.join(counts.select("hash", "count"), "hash", "left").groupBy("row").agg(
            F.sum(F.col("times") * F.log10((n + 1) * F.lit(vocabulary.unseen))).alias("tail_base"),
            F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("tail_known"),
            F.sum(F.when(n > 0, F.col("gain").cast("double")).otherwise(0.0)).alias("tail_gain"),
        )
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return scored.drop("tail").join(looked, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + zero("tail_known")).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("tail_base")).alias("base_score"),
        (F.col("base") + zero("tail_base") + F.col("gain") + zero("tail_gain")).alias("score"),
    )


def op8_maxent(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return score(docs.withColumn("held_out", F.coalesce(remainder(7) == 2, F.lit(False))))
