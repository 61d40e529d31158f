"""Toxicity scores from a bidirectional gated recurrent network with attention pooling.

Each word enters with a word part (hashed embedding, log odds of the word) and a character
part (mean embedding and log odds of its byte n-grams, edges marked).  Forward and backward
gated recurrent units run over windows of words, attention pools each window, and a logistic
unit scores it.  A text is scored in all its overlapping windows; its score is that of the
worst window, calibrated on the training sample.  Training is plain numpy on a bounded sample
of labelled texts; scoring runs in Arrow batches over the whole table.

Defined results: NULL, empty and blank texts are one window without words and get the
network's score for that.  Without any labelled row, or with one label only, every text gets
the share of label 1 (0 without rows).  NULL labels are no labels; several labels of one key
count as several rows.  Rows are scored one by one, so repeated rows get equal scores.
Columns of the input are kept; the result's names win.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensoria.llm.language import kept_by, remainder, with_struct
from sensoria.llm.words import WordTable, byte_grams, give_back, hash_words, raw, small_batches, tidied

ORDERS = (3, 5)
_CHUNK = 20_000
_EDGES = b".,;:!?|\"'()[]{}<>#$%&*-_+=~`/\\"
FIXED = 3  # log odds: word, mean n-gram, largest n-gram


@dataclass
class Settings:
    """``positives`` and ``negatives`` bound the training sample; the rest is the network."""

    positives: int = 900
    negatives: int = 2100
    window: int = 32
    stride: int = 16
    hidden: int = 8
    word_size: int = 4
    char_size: int = 4
    word_bits: int = 18
    gram_bits: int = 16
    table_bits: int = 12
    smoothing: float = 5.0
    epochs: tuple[int, int] = (3, 2)
    batch: int = 64
    rate: float = 0.005
    threshold: float = 0.3
    seed: int = 11


@dataclass
class Evidence:
    """Log odds of label 1 by hashed word and hashed n-gram."""

    word: np.ndarray = field(repr=False)
    gram: np.ndarray = field(repr=False)


@dataclass
class Model:
    settings: Settings
    share: float
    evidence: Evidence | None = None
    weights: dict[str, np.ndarray] = field(default_factory=dict, repr=False)
    scale: tuple[float, float] = (1.0, 0.0)


def _parts(words: list[bytes], s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket of each word, punctuation at its edges aside; (word, bucket) of all its
    n-grams in word order."""
    bucket = (hash_words([word.strip(_EDGES) or word for word in words]) >> np.uint64(64 - s.word_bits)).astype(np.int32)
    owners, grams = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for first in range(0, len(words), _CHUNK):
        found = [byte_grams(words[first : first + _CHUNK], order, s.gram_bits) for order in ORDERS]
        owner = np.concatenate([f[0] for f in found])
        order = np.argsort(owner, kind="stable")
        owners.append((owner[order] + first).astype(np.int32))
        grams.append(np.concatenate([f[1] for f in found])[order].astype(np.int32))
    return bucket, np.concatenate(owners), np.concatenate(grams)


def _chunks(parts):
    """The same for some words at a time, to bound what is unfolded at once."""
    bucket, owner, gram = parts
    for first in range(0, len(bucket), _CHUNK):
        a, b = np.searchsorted(owner, [first, first + _CHUNK])
        yield bucket[first : first + _CHUNK], owner[a:b] - first, gram[a:b]


def _spread(owner: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """N-grams per word, and the words that have any."""
    number = np.bincount(owner, minlength=count)
    return number, number > 0


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places start, start + 1, ... of runs laid one after the other."""
    return np.arange(sizes.sum()) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def _log_odds(yes: np.ndarray, no: np.ndarray, share: float, s: Settings) -> np.ndarray:
    a = s.smoothing
    return np.log((yes + a * share) / (no + a * (1 - share)) * (1 - share) / share).astype(np.float32)


def _fixed(parts, evidence: Evidence) -> np.ndarray:
    bucket, owner, gram = parts
    out = np.zeros((len(bucket), FIXED), np.float32)
    out[:, 0] = evidence.word[bucket]
    number, some = _spread(owner, len(bucket))
    if len(owner):
        value = evidence.gram[gram]
        starts = (np.cumsum(number) - number)[some]
        out[some, 1] = np.add.reduceat(value, starts) / number[some]
        out[some, 2] = np.maximum.reduceat(value, starts)
    return out / 3


def _embedded(parts, w: dict[str, np.ndarray], s: Settings) -> np.ndarray:
    bucket, owner, gram = parts
    mask = (1 << s.table_bits) - 1
    chars = np.zeros((len(bucket), s.char_size), np.float32)
    number, some = _spread(owner, len(bucket))
    if len(owner):
        starts = (np.cumsum(number) - number)[some]
        chars[some] = np.add.reduceat(w["chars"][gram & mask], starts, axis=0) / number[some, None]
    return np.concatenate([w["words"][bucket & mask], chars], axis=1)


def _windows(lengths: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows: the text's row, first word (in the flat list) and number of words."""
    count = 1 + np.maximum(0, -(-(lengths - s.window) // s.stride))
    text = np.repeat(np.arange(len(lengths)), count)
    step = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    first = (np.cumsum(lengths) - lengths)[text] + step * s.stride
    size = np.minimum(lengths[text] - step * s.stride, s.window)
    return text, first, size


def _places(flat: np.ndarray, first: np.ndarray, size: np.ndarray, s: Settings, pad: int):
    """Word numbers (windows x steps) and which steps exist."""
    step = np.arange(s.window)
    there = step[None] < size[:, None]
    if not len(flat):
        return np.full(there.shape, pad, np.int64), there
    at = np.minimum(first[:, None] + step[None], len(flat) - 1)
    return np.where(there, flat[at], pad).astype(np.int32), there


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _roll(project: np.ndarray, place: np.ndarray, there: np.ndarray, u: np.ndarray, backward: bool, keep=None):
    """States (steps x windows x hidden) of one direction; ``keep`` collects what training needs."""
    h_size = u.shape[0]
    h = np.zeros((len(place), h_size), np.float32)
    out = np.zeros((place.shape[1], len(place), h_size), np.float32)
    for t in reversed(range(place.shape[1])) if backward else range(place.shape[1]):
        g, a = project[place[:, t]], h @ u
        zr = _sigmoid(g[:, : 2 * h_size] + a[:, : 2 * h_size])
        z, r = zr[:, :h_size], zr[:, h_size:]
        n = np.tanh(g[:, 2 * h_size :] + r * a[:, 2 * h_size :])
        before = h
        h = (n + z * (before - n)) * there[:, t : t + 1]
        out[t] = h
        if keep is not None:
            keep.append((t, before, z, r, n, a[:, 2 * h_size :]))
    return out


def _pool(states: np.ndarray, there: np.ndarray, w: dict[str, np.ndarray]):
    """Attention weights, pooled states and the logit of each window."""
    hidden = np.tanh(states @ w["look"])
    level = np.where(there.T, hidden @ w["aim"], -1e9)
    power = np.exp(level - level.max(axis=0)) * there.T
    share = power / np.maximum(power.sum(axis=0), 1e-9)
    pooled = np.einsum("tb,tbh->bh", share, states)
    return hidden, share, pooled, pooled @ w["out"] + w["bias"][0]


def _logits(project: np.ndarray, place: np.ndarray, there: np.ndarray, w: dict[str, np.ndarray]) -> np.ndarray:
    half = project.shape[1] // 2
    ahead = _roll(project[:, :half], place, there, w["u0"], False)
    back = _roll(project[:, half:], place, there, w["u1"], True)
    return _pool(np.concatenate([ahead, back], axis=2), there, w)[3]


def _gradient(x: np.ndarray, place: np.ndarray, there: np.ndarray, truth: np.ndarray, weight: np.ndarray, w):
    """Gradients of the weighted log loss by back-propagation through time; also for x."""
    project = x @ w["in"] + w["shift"]
    half = project.shape[1] // 2
    kept: list[list] = [[], []]
    sides = [
        _roll(project[:, side * half : (side + 1) * half], place, there, w[f"u{side}"], bool(side), kept[side])
        for side in (0, 1)
    ]
    states = np.concatenate(sides, axis=2)
    hidden, share, pooled, logit = _pool(states, there, w)
    d_logit = ((_sigmoid(logit) - truth) * weight / len(truth)).astype(np.float32)
    grad = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()])}
    d_pooled = d_logit[:, None] * w["out"][None]
    d_states = share[:, :, None] * d_pooled[None]
    d_share = np.einsum("tbh,bh->tb", states, d_pooled)
    d_level = share * (d_share - (share * d_share).sum(axis=0))
    grad["aim"] = np.einsum("tb,tbk->k", d_level, hidden)
    d_hidden = d_level[:, :, None] * w["aim"] * (1 - hidden**2)
    grad["look"] = np.einsum("tbh,tbk->hk", states, d_hidden)
    d_states = d_states + d_hidden @ w["look"].T
    d_project = np.zeros_like(project)
    for side in (0, 1):
        u = w[f"u{side}"]
        h_size, d_u = u.shape[0], np.zeros_like(u)
        d_next = np.zeros((len(place), h_size), np.float32)
        for t, before, z, r, n, a_n in reversed(kept[side]):
            d_h = (d_states[t][:, side * h_size : (side + 1) * h_size] + d_next) * there[:, t : t + 1]
            d_n = d_h * (1 - z) * (1 - n**2)
            d_z = d_h * (before - n) * z * (1 - z)
            d_r = d_n * a_n * r * (1 - r)
            d_a = np.concatenate([d_z, d_r, d_n * r], axis=1)
            d_g = np.concatenate([d_z, d_r, d_n], axis=1)
            np.add.at(d_project[:, side * half : (side + 1) * half], place[:, t], d_g)
            d_u += before.T @ d_a
            d_next = d_h * z + d_a @ u.T
        grad[f"u{side}"] = d_u
    grad["in"], grad["shift"] = x.T @ d_project, d_project.sum(axis=0)
    return grad, d_project @ w["in"].T


def _start(s: Settings) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(s.seed)
    size = FIXED + s.word_size + s.char_size
    normal = lambda *shape, by=0.3: (rng.standard_normal(shape) * by).astype(np.float32)
    return {
        "words": normal(1 << s.table_bits, s.word_size, by=0.05),
        "chars": normal(1 << s.table_bits, s.char_size, by=0.05),
        "in": normal(size, 6 * s.hidden), "shift": np.zeros(6 * s.hidden, np.float32),
        "u0": normal(s.hidden, 3 * s.hidden), "u1": normal(s.hidden, 3 * s.hidden),
        "look": normal(2 * s.hidden, s.hidden), "aim": normal(s.hidden),
        "out": normal(2 * s.hidden), "bias": np.zeros(1, np.float32),
    }


class _Adam:
    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.w, self.rate, self.t = weights, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, grad: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grad.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            fit = self.m[k] / (1 - 0.9**self.t) / (np.sqrt(self.v[k] / (1 - 0.999**self.t)) + 1e-8)
            self.w[k] -= (self.rate * fit).astype(np.float32)


def fit(rows: list[tuple[int, bytes | None]], s: Settings) -> Model:
    """Train on (label, text) rows; runs on the driver over the bounded sample.

    A word's log odds leave the row's own text out, so that words seen in a single text do
    not give its label away.  First the most suspicious window by log odds stands for each
    text, then the one that the network itself scores highest.
    """
    truth = np.array([label for label, _ in rows], np.float32)
    share = float(truth.mean()) if len(truth) else 0.0
    if share in (0.0, 1.0):
        return Model(s, share)
    table = WordTable(limit=10**9)
    flat, lengths = table.batch(text for _, text in rows)
    words = table.words.to_pylist()
    parts = _parts(words, s) if words else (np.zeros(0, np.int64),) * 3
    bucket, owner, gram = parts
    number, _ = _spread(owner, len(words))
    starts = np.cumsum(number) - number
    counts = {k: np.zeros((2, 1 << bits), np.int32) for k, bits in (("word", s.word_bits), ("gram", s.gram_bits))}
    ends = np.cumsum(lengths)
    for i, label in enumerate(truth.astype(int)):  # texts that hold a word or n-gram, by label
        used = np.unique(flat[ends[i] - lengths[i] : ends[i]])
        counts["word"][label, np.unique(bucket[used])] += 1
        counts["gram"][label, np.unique(gram[_ranges(starts[used], number[used])])] += 1

    def evidence(less_yes: int, less_no: int) -> Evidence:
        return Evidence(*[
            _log_odds(np.maximum(counts[k][1] - less_yes, 0), np.maximum(counts[k][0] - less_no, 0), share, s)
            for k in ("word", "gram")
        ])

    model = Model(s, share, evidence(0, 0), _start(s))
    fixed = np.concatenate([
        *[_fixed(some, known) for known in (evidence(1, 0), evidence(0, 1)) for some in _chunks(parts)],
        np.zeros((1, FIXED), np.float32),
    ])
    pad = 2 * len(words)
    inputs = _Inputs(parts, starts, number, fixed)
    version = np.repeat(np.where(truth > 0, 0, len(words)), lengths) + flat
    text, first, size = _windows(lengths, s)
    place, there = _places(version, first, size, s, pad)
    rng, adam = np.random.default_rng(s.seed), _Adam(model.weights, s.rate)
    level = np.where(there, fixed.sum(axis=1)[place], -9).max(axis=1)
    mask = (1 << s.table_bits) - 1
    balance = np.where(truth > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    for phase, epochs in enumerate(s.epochs):
        if phase:
            level = inputs.logits(place, there, model.weights, s)
        order = np.lexsort((-level, text))
        worst = order[np.concatenate([[True], text[order][1:] != text[order][:-1]])]
        for _ in range(epochs):
            random = (np.cumsum(np.bincount(text)) - 1 - rng.integers(0, np.bincount(text)))[truth == 0]
            chosen = rng.permutation(np.concatenate([worst, random]))
            for begin in range(0, len(chosen), s.batch):
                pick = chosen[begin : begin + s.batch]
                rows_used, local = np.unique(place[pick], return_inverse=True)
                x, real, used = inputs.of(rows_used, model.weights, s)
                grad, d_x = _gradient(
                    x, local.reshape(place[pick].shape), there[pick], truth[text[pick]], balance[text[pick]], model.weights
                )
                d_x = d_x[real, FIXED:]
                for name in ("words", "chars"):
                    grad[name] = np.zeros_like(model.weights[name])
                np.add.at(grad["words"], used[0] & mask, d_x[:, : s.word_size])
                size = np.maximum(np.bincount(used[1], minlength=len(d_x)), 1)
                np.add.at(grad["chars"], used[2] & mask, (d_x[:, s.word_size :] / size[:, None])[used[1]])
                adam.step(grad)
    logit = inputs.logits(place, there, model.weights, s)
    best = np.full(len(rows), -np.inf)
    np.maximum.at(best, text, logit)
    model.scale = _calibrate(best, truth)
    return model


@dataclass
class _Inputs:
    """Feature rows of the sample: words as toxic texts see them, as others do, and the pad."""

    parts: tuple
    starts: np.ndarray
    number: np.ndarray
    fixed: np.ndarray

    def of(self, rows: np.ndarray, w: dict[str, np.ndarray], s: Settings):
        """Feature matrix of some rows, which of them are words, and those words' parts."""
        bucket, _, gram = self.parts
        real = rows < len(self.fixed) - 1
        word = rows[real] % max(1, len(bucket))
        size = self.number[word]
        parts = (bucket[word], np.repeat(np.arange(len(word)), size), gram[_ranges(self.starts[word], size)])
        x = np.zeros((len(rows), FIXED + s.word_size + s.char_size), np.float32)
        x[:, :FIXED] = self.fixed[rows]
        x[real, FIXED:] = _embedded(parts, w, s)
        return x, real, parts

    def logits(self, place: np.ndarray, there: np.ndarray, w: dict[str, np.ndarray], s: Settings) -> np.ndarray:
        """Logits of all windows, a thousand at a time."""
        out = []
        for i in range(0, len(place), 1024):
            rows, local = np.unique(place[i : i + 1024], return_inverse=True)
            project = self.of(rows, w, s)[0] @ w["in"] + w["shift"]
            out.append(_logits(project, local.reshape(-1, place.shape[1]), there[i : i + 1024], w))
        return np.concatenate(out)


def _calibrate(level: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the texts' worst windows, by Newton steps."""
    x = np.stack([level, np.ones_like(level)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (p - truth) + 1e-2 * (beta - [1.0, 0.0])
        curve = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta - np.clip(step, -1, 1)
    return float(max(beta[0], 1e-3)), float(beta[1])


def train(
    docs: DataFrame, labels: DataFrame, settings: Settings | None = None,
    text: str = "text", label: str = "toxic", key: str = "doc_id",
) -> Model:
    """Fit on the labelled rows with the smallest key hashes, bounded for each label."""
    s = settings or Settings()
    known = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label"))
    picked = None
    for value, bound in ((1, s.positives), (0, s.negatives)):
        part = known.where(F.col("_label") == value).orderBy(F.xxhash64("_key"), "_key").limit(bound)
        picked = part if picked is None else picked.unionAll(part)
    texts = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    rows = texts.join(F.broadcast(picked), "_key").orderBy("_key", "_label", "_text").select("_label", "_text")
    model = fit([(row["_label"], row["_text"].encode() if row["_text"] else None) for row in rows.toLocalIterator()], s)
    give_back()
    return model


def _projector(model: Model):
    """Feature function of words: their projections into both directions' gates."""
    s, w = model.settings, model.weights

    def features(words: list[bytes]) -> np.ndarray:
        parts = _parts(words, s)
        x = np.concatenate([_fixed(parts, model.evidence), _embedded(parts, w, s)], axis=1)
        return x @ w["in"] + w["shift"]

    return features


def text_scores(texts: list[bytes | None], table: WordTable, model: Model) -> np.ndarray:
    """Score of each text: its worst window, calibrated."""
    s, w = model.settings, model.weights
    flat, lengths = table.batch(texts)
    text, first, size = _windows(lengths, s)
    project = table.rows[: table.filled] if table.rows is not None else np.zeros((0, 6 * s.hidden), np.float32)
    pad = len(project)
    project = np.concatenate([project, w["shift"][None]]) if pad == 0 else project
    best = np.full(len(texts), -np.inf)
    for i in range(0, len(text), 4096):
        cut = slice(i, i + 4096)
        # absent steps never reach a result: states are zeroed and attention skips them
        place, there = _places(flat, first[cut], size[cut], s, 0)
        np.maximum.at(best, text[cut], _logits(project, place, there, w))
    slope, offset = model.scale
    return 1 / (1 + np.exp(-np.clip(slope * best + offset, -30, 30)))


def verdict(spark: SparkSession, model: Model):
    """Function of a text column: struct of ``score`` (0 to 1) and ``predicted``."""
    shared = small_batches(spark).sparkContext.broadcast(model)

    @F.arrow_udf("score double, predicted int")
    @tidied
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        table = WordTable(_projector(model), limit=150_000) if model.evidence else None
        for batch in batches:
            found = text_scores(batch, table, model) if table is not None else np.full(len(batch), model.share)
            high = (found >= model.settings.threshold).astype(np.int32)
            yield pa.StructArray.from_arrays([pa.array(found), pa.array(high)], ["score", "predicted"])

    return judge


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""
    judge = verdict(docs.sparkSession, model)
    return with_struct(docs, judge(F.col(text)), ["score", "predicted"])


def keep_harmless(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Documents that are not predicted toxic; columns as they were."""
    judge = verdict(docs.sparkSession, model)
    return kept_by(docs, judge(F.col(text)), lambda found: found["predicted"] == 0)


def op10_toxicity(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = train(docs, labels.where(remainder(4) != 2))
    held_out = docs.select("doc_id", "text", (remainder(4) == 2).alias("held_out"))
    return score(held_out, model).select("doc_id", "held_out", "score", "predicted")
