"""Language identification by error-correcting output codes.

Every language gets a binary codeword.  One binary classifier per code bit, naive Bayes over
hashed byte n-grams of words, predicts that bit.  A text goes to the language whose codeword
has the least loss against the predicted bits, each bit weighted by how reliable it was in
training.

A text is flagged ambiguous if its two best languages are nearly tied, or if it differs from what
the calibration texts (every fourth row of the sample, which no classifier sees) say a text of its
language looks like.  Two means over its words are looked at: how far its bits lie nearer to the
best codeword than to the second (half of it is another language), and the log frequency of its
byte trigrams in the sample (a language or script that was not learned, noise).  Either has to lie
below the middle between a typical text and none at all by more than the noise of that many words,
so short texts are not flagged for being short.  The score falls with both.

Defined results: NULL texts and texts without any letter give ``und`` with score 0 and are
not ambiguous.  Rows are scored one by one, so repeated rows get equal results.  Without any
training row (empty table, only NULL languages) every text gives ``und``.  Whole texts are
scored whatever their length.  Columns of the input are kept; the result's names win.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensoria.llm.words import WordTable, byte_grams, give_back, raw, small_batches, sum_by_text, tidied
from sensoria.session import literal_table

UNKNOWN = "und"
RESULT = "lang_pred string, score double, ambiguous boolean"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Settings:
    """The sample has ``per_language`` rows of each language, fewer beyond ``sample_rows`` in all.

    Every language is learned; more than ``max_languages`` are an error, none is left out.
    """

    per_language: int = 400
    sample_rows: int = 25_600
    max_languages: int = 1024
    orders: tuple[int, ...] = (1, 2, 3, 4)
    bits: int = 16
    code_bits: int = 15
    sharpness: float = 8.0
    ambiguous_margin: float = 0.02
    trigram_bits: int = 20
    noise: float = 2.0
    calibrate_every: int = 4
    seed: int = 7


@dataclass
class Model:
    settings: Settings
    languages: list[str]
    codes: np.ndarray = field(repr=False)  # languages x bits, -1 or 1
    weights: np.ndarray = field(repr=False)  # buckets x bits, log odds
    reliability: np.ndarray = field(repr=False)  # bits
    typical: np.ndarray = field(repr=False)  # trigram buckets, log frequency
    lead: np.ndarray = field(repr=False)  # languages x (middle, spread of one word)
    fit: np.ndarray = field(repr=False)  # the same of the mean log frequency


def codewords(count: int, bits: int, seed: int) -> np.ndarray:
    """Codewords far apart: all splits for few languages, else the best of random codes."""
    if count <= 1:
        return np.ones((count, 1), np.int8)
    if count <= 5:
        splits = [[1 if m >> i & 1 else -1 for i in range(count)] for m in range(1, 2 ** (count - 1))]
        return np.array(splits, np.int8).T
    rng = np.random.default_rng(seed)
    width = max(bits, 3 * int(np.ceil(np.log2(count))))
    best, apart = None, -1
    for _ in range(300):
        code = rng.choice(np.array([-1, 1], np.int8), (count, width))
        if (np.abs(code.sum(axis=0)) == count).any():
            continue
        distance = (width - code.astype(int) @ code.T.astype(int)) // 2
        nearest = int((distance + width * np.eye(count, dtype=int)).min())
        if nearest > apart:
            best, apart = code, nearest
    if best is None:
        raise ValueError("no codewords found")
    return best


def _bits(means: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Predicted value of every bit for every text, squashed to (-1, 1)."""
    return np.tanh(means * np.sqrt(np.maximum(lengths, 1))[:, None] / 4.0)


def _means(flat: np.ndarray, lengths: np.ndarray, table: WordTable, width: int) -> np.ndarray:
    """Mean of the word features of every text."""
    if not len(flat):
        return np.zeros((len(lengths), width))
    return sum_by_text(table.rows[flat], lengths) / np.maximum(lengths, 1)[:, None]


def _word_features(weights: np.ndarray, typical: np.ndarray, settings: Settings):
    """Log odds of every bit, and last the mean log frequency of the byte trigrams."""

    def features(words: list[bytes]) -> np.ndarray:
        out = np.zeros((len(words), weights.shape[1] + 1), np.float64)
        for order in settings.orders:
            word, bucket = byte_grams(words, order, settings.bits)
            for bit in range(weights.shape[1]):
                out[:, bit] += np.bincount(word, weights[bucket, bit], len(words))
        out /= len(settings.orders)
        word, bucket = byte_grams(words, 3, settings.trigram_bits)
        held = np.bincount(word, minlength=len(words))
        out[:, -1] = np.bincount(word, typical[bucket], len(words)) / np.maximum(held, 1)
        return out.astype(np.float32)

    return features


@dataclass
class _Decoded:
    best: np.ndarray
    chance: np.ndarray  # share of the decoding weight
    margin: np.ndarray  # to the second best
    lead: np.ndarray  # how much nearer the best codeword is than the second, mean over words
    fit: np.ndarray  # mean log frequency of the trigrams


def _decode(means: np.ndarray, lengths: np.ndarray, model: Model) -> _Decoded:
    share = model.reliability / model.reliability.sum()
    odds = means[:, :-1]
    bits = _bits(odds, lengths)
    loss = (np.log1p(np.exp(-2 * bits[:, None, :] * model.codes[None])) * share).sum(axis=2)
    power = np.exp(-model.settings.sharpness * (loss - loss.min(axis=1, keepdims=True)))
    chance = power / power.sum(axis=1, keepdims=True)
    best, rows = chance.argmax(axis=1), np.arange(len(chance))
    others, near = chance.copy(), (odds * share) @ model.codes.T.astype(float)
    others[rows, best] = 0.0
    lead = near[rows, best] - np.where(np.arange(near.shape[1]) == best[:, None], -np.inf, near).max(axis=1)
    if chance.shape[1] == 1:
        lead = np.zeros(len(rows))
    return _Decoded(best, chance[rows, best], chance[rows, best] - others.max(axis=1), lead, means[:, -1])


def _usual(values: np.ndarray, lengths: np.ndarray) -> tuple[float, float]:
    """Middle of a mean over words, and the spread of one word."""
    if not len(values):
        return 0.0, np.inf
    middle = float(np.median(values))
    return middle, float(1.4826 * np.median(np.abs(values - middle) * np.sqrt(lengths)))


def _below(found: np.ndarray, usual: np.ndarray, none: float, lengths: np.ndarray, noise: float) -> np.ndarray:
    """Nearer to ``none`` than to the usual value, by more than the noise of that many words."""
    middle, spread = usual[:, 0], usual[:, 1]
    return found < (middle + none) / 2 - noise * spread / np.sqrt(np.maximum(lengths, 1))


def fit(rows: list[tuple[str, bytes]], settings: Settings) -> Model:
    """Model from (language, text) rows; runs on the driver over the bounded sample."""
    languages = sorted({lang for lang, _ in rows})
    place = {lang: i for i, lang in enumerate(languages)}
    seen, held, number = [], [], dict.fromkeys(languages, 0)
    for lang, text in rows:
        number[lang] += 1
        (held if number[lang] % settings.calibrate_every == 0 else seen).append((lang, text))
    size = 1 << settings.bits
    counts = np.zeros((len(languages), size), np.float32)
    trigrams = np.zeros(1 << settings.trigram_bits)
    for lang, text in seen:
        words = text.lower().split()
        for order in settings.orders:
            counts[place[lang]] += np.bincount(byte_grams(words, order, settings.bits)[1], minlength=size)
        trigrams += np.bincount(byte_grams(words, 3, settings.trigram_bits)[1], minlength=len(trigrams))
    codes = codewords(len(languages), settings.code_bits, settings.seed)
    frequency = (counts + 0.5) / (counts.sum(axis=1, keepdims=True) + 0.5 * size)
    typical = np.log((trigrams + 0.5) / (trigrams.sum() + 0.5)).astype(np.float32)
    weights = np.zeros((size, codes.shape[1]), np.float32)
    for bit in range(codes.shape[1] if len(languages) > 1 else 0):
        yes = frequency[codes[:, bit] > 0].mean(axis=0)
        no = frequency[codes[:, bit] < 0].mean(axis=0)
        weights[:, bit] = np.log(yes / no)
    none = np.tile([0.0, np.inf], (len(languages), 1))
    model = Model(settings, languages, codes, weights, np.ones(codes.shape[1]), typical, none, none.copy())
    if not languages:
        return model
    table = WordTable(_word_features(weights, typical, settings))
    if len(languages) > 1:
        flat, lengths = table.batch(text for _, text in seen)
        found = _bits(_means(flat, lengths, table, codes.shape[1] + 1)[:, :-1], lengths)
        truth = codes[[place[lang] for lang, _ in seen]]
        wrong = ((found * truth <= 0).sum(axis=0) + 1) / (len(seen) + 2)
        model.reliability = np.clip(np.log((1 - wrong) / wrong), 0.05, None)
    if held:
        flat, lengths = table.batch(text for _, text in held)
        decoded = _decode(_means(flat, lengths, table, codes.shape[1] + 1), lengths, model)
        own = np.array([place[lang] for lang, _ in held])
        for i in range(len(languages)):
            mine = (own == i) & (decoded.best == i) & (lengths > 0)
            if mine.sum() >= 5:
                model.lead[i] = _usual(decoded.lead[mine], lengths[mine])
                model.fit[i] = _usual(decoded.fit[mine], lengths[mine])
    return model


def train(
    labelled: DataFrame, settings: Settings | None = None,
    text: str = "text", lang: str = "lang", key: str = "doc_id",
) -> Model:
    """Fit on a sample of at most ``per_language`` rows for each language.

    The rows with the smallest key hashes are taken, whatever the table's layout.
    """
    settings = settings or Settings()
    rows = labelled.select(
        F.col(text).alias("text"), F.col(lang).alias("lang"),
        F.shiftrightunsigned(F.xxhash64(F.col(key).cast("string")), 1).alias("place"),
    ).where("text IS NOT NULL AND lang IS NOT NULL")
    found = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(settings.max_languages + 1).collect()
    if len(found) > settings.max_languages:
        raise ValueError(f"more than {settings.max_languages} languages")
    each = min(settings.per_language, settings.sample_rows // max(1, len(found)))
    shares = [min(1.0, 1.2 * each / row["n"]) for row in found]
    limits = literal_table(
        labelled.sparkSession,
        [(row["lang"], int(share * 2**62) * 2 - 1) for row, share in zip(found, shares, strict=True)],
        "lang string, most long",
    )
    wanted = rows.join(limits, "lang").where("place <= most").drop("most")
    picked: dict[str, list] = {}
    for row in wanted.orderBy("place", "text").toLocalIterator():
        group = picked.setdefault(row["lang"], [])
        if len(group) < each:
            group.append((row["lang"], row["text"].encode()))
    model = fit([item for group in picked.values() for item in group], settings)
    give_back()
    return model


def verdict(spark: SparkSession, model: Model):
    """Function of a text column: struct of ``lang_pred``, ``score`` and ``ambiguous``."""
    shared = small_batches(spark).sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    @tidied
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        table = WordTable(_word_features(model.weights, model.typical, model.settings))
        floor = float(model.typical.min())
        for batch in batches:
            texts = raw(batch)
            known = np.array(
                [bool(t) and bool(model.languages) and _LETTER.search(t.decode()) is not None for t in texts], bool
            )
            flat, lengths = table.batch(texts)
            names, score, tied = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts)), np.zeros(len(texts), bool)
            if known.any():
                found = _decode(_means(flat, lengths, table, model.codes.shape[1] + 1), lengths, model)
                lead, fits, noise = model.lead[found.best], model.fit[found.best], model.settings.noise
                names[known] = np.array(model.languages, object)[found.best[known]]
                tied[known] = (
                    (found.margin < model.settings.ambiguous_margin)
                    | _below(found.lead, lead, 0.0, lengths, noise) | _below(found.fit, fits, floor, lengths, noise)
                )[known]
                pure = np.divide(found.lead, lead[:, 0], out=np.ones(len(texts)), where=lead[:, 0] > 0)
                like = np.divide(found.fit - floor, fits[:, 0] - floor, out=np.ones(len(texts)), where=fits[:, 0] > floor)
                score[known] = (found.chance * np.clip(pure, 0, 1) * np.clip(like, 0, 1))[known]
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(score), pa.array(tied)],
                ["lang_pred", "score", "ambiguous"],
            )

    return judge


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``ambiguous`` for every whole text."""
    judge = verdict(docs.sparkSession, model)
    return with_struct(docs, judge(F.col(text)), ["lang_pred", "score", "ambiguous"])


def with_struct(docs: DataFrame, result: Column, names: list[str]) -> DataFrame:
    """``docs`` plus the fields of a struct; fields replace input columns of their name."""
    held = "_result"
    while held in docs.columns:
        held += "_"
    kept = [F.col(f"`{name}`") for name in docs.columns if name not in names]
    return docs.select(*kept, result.alias(held)).select(
        *kept, *[F.col(f"{held}.{name}").alias(name) for name in names]
    )


def kept_by(docs: DataFrame, judged: Column, keep: Callable[[Column], Column]) -> DataFrame:
    """Rows whose verdict passes; columns stay as they are, whatever their names."""
    rows = docs.select(F.struct("*").alias("row"), judged.alias("verdict"))
    return rows.where(keep(F.col("verdict"))).select("row.*")


def remainder(modulus: int, key: str = "doc_id") -> Column:
    """crc32 of the key's text, modulo a number."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % modulus


def keep_identified(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Documents of a known language: neither ``und`` nor ambiguous; columns as they were."""
    judge = verdict(docs.sparkSession, model)
    return kept_by(
        docs, judge(F.col(text)), lambda found: (found["lang_pred"] != UNKNOWN) & ~found["ambiguous"]
    )


def op4_language(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = train(docs.where(remainder(3) != 1))
    held_out = docs.select("doc_id", "text", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"))
    return identify(held_out, model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")
