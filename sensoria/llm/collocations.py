"""Phrases whose words belong together, counted with an FM-index for each shard.

A scan turns texts into shards: word ids of one language with a break between pieces, about
``shard_words`` words each, written to the shared folder.  A shard's index holds the
Burrows-Wheeler transform of its ids and of their reverse, ordered by as many ids as the depth
needs.  A phrase is a pair of intervals, one in either order.  Extending it to the right reads the
symbols of its interval in the reversed order, to the left those in the forward order; the rows of
each symbol give the new interval there, and the symbols before it the shift in the other one.
Extending right, left, right, left enumerates all phrases of growing length with their counts.

Counts are summed over shards.  A phrase is at most as frequent as its parts, so rounds prune each
other: words below ``min_count`` become breaks, and phrases grow from frequent pairs only.  Which
words and pairs are frequent reaches the tasks as a bitmap of at most ``2^max_bits`` bits whatever
their number; pairs are counted by as many buckets of their hashes, so that rare ones cost a bucket
number in the shuffle and no text.  A false hit costs a row, no result.  Sums, scores and the choice are Spark
aggregations and joins on the phrase; products are 38-digit decimals.

Defined results: NULL texts are empty, a NULL language is ``und``; a word or a phrase never crosses
a piece or a text; a cut's score is ``floor(1000 * a * n / (l * r))``; the lowest cut counts, ties to
the shortest first part; ranks break ties by count, then by the phrase's bytes.  Repeated rows count
each time.  An empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensoria.llm.words import Numbers, hash_words, mix, raw, small_batches, tidied
from sensoria.session import cut_lineage

BREAK = b"."
SHARD_BYTES = 4 * 1024 * 1024


@dataclass
class Settings:
    depth: int = 5
    min_count: int = 100
    top: int = 2000
    covered_percent: int = 100
    shard_words: int = 1 << 18
    max_bits: int = 26


def _byte_table() -> bytes:
    """A-Z to a-z, everything that ends a piece to a full stop, tab to blank."""
    ends = b".,;:!?\n\x0b\x0c\r"
    upper = range(0x41, 0x5B)
    return bytes(BREAK[0] if b in ends else 0x20 if b == 0x09 else b + 32 if b in upper else b for b in range(256))


TABLE = _byte_table()


def tokens(text: bytes | None) -> list[bytes]:
    """Words and breaks of one text, with a break behind it."""
    return text.translate(TABLE).replace(BREAK, b" . ").split() + [BREAK] if text else []


class _Shard:
    """Ids of one language as they come in; id 0 is the break, which also opens the shard."""

    def __init__(self):
        self.index = Numbers()
        self.index[BREAK]
        self.parts, self.size = [np.zeros(1, np.int32)], 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.array(list(map(self.index.__getitem__, words)), np.int32))
        self.size += len(words)

    def row(self, lang: str) -> pa.RecordBatch:
        ids = _joined_breaks(np.concatenate(self.parts))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang], pa.string()), pa.array([b" ".join(list(self.index)[1:])], pa.binary()),
                pa.array([ids.tobytes()], pa.binary()),
            ],
            ["lang", "words", "ids"],
        )


def _joined_breaks(ids: np.ndarray) -> np.ndarray:
    """The same ids with one break instead of several in a row."""
    again = (ids[1:] == 0) & (ids[:-1] == 0)
    return np.concatenate([ids[:1], ids[1:][~again]])


def shards(docs: DataFrame, s: Settings, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, words, ids``: words joined by blanks, in order of their ids from 1; ids as bytes."""
    small_batches(docs.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, _Shard] = {}
        total = 0
        for batch in batches:
            texts, langs = batch.columns
            for words, name in zip(raw(texts), langs.to_pylist(), strict=True):
                shard = held.setdefault(name, _Shard())
                before = shard.size
                shard.add(tokens(words))
                total += shard.size - before
                while held and (shard.size >= s.shard_words or total >= 2 * s.shard_words):
                    full = name if shard.size >= s.shard_words else max(held, key=lambda x: held[x].size)
                    total -= held[full].size
                    yield held.pop(full).row(full)
                    shard = held.get(name) or _Shard()
        for name, shard in held.items():
            yield shard.row(name)

    name = F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang")
    return docs.select(F.col(text), name).mapInArrow(run, "lang string, words binary, ids binary")


def _shard_of(lang: str, words: bytes, ids: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Words by id (the break first), their hashes within the language, and the ids."""
    listed = [BREAK, *(words.split(b" ") if words else [])]
    seed = int(hash_words([lang.encode()])[0])
    return listed, hash_words(listed, seed), np.frombuffer(ids, np.int32)


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(mix(left) + right)


class Order:
    """Rows of a cyclic sequence in order of their next ids, with the id before each row.

    ``follow`` is the row of the position before (the LF mapping).
    """

    def __init__(self, ids: np.ndarray, size: int, depth: int):
        rank, known, span = ids.astype(np.int64), size, 1
        rows = np.argsort(rank, kind="stable") if span >= depth else None
        while span < depth:
            key = rank * known + np.roll(rank, -span)
            rows = np.argsort(key)
            ordered = key[rows]
            fresh = np.ones(len(ids), np.int64)
            fresh[0] = 0
            fresh[1:] = ordered[1:] != ordered[:-1]
            rank = np.empty(len(ids), np.int64)
            rank[rows] = np.cumsum(fresh)
            known, span = int(rank[rows[-1]]) + 1, 2 * span
        del rank
        place = np.empty(len(ids), np.int32)
        place[rows] = np.arange(len(ids), dtype=np.int32)
        self.symbols = ids[rows - 1]
        self.follow = place[rows - 1]

    def extend(self, low: np.ndarray, size: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
        """Every symbol before every interval: interval, symbol, new beginning, count, shift.

        The shift is the number of the interval's rows with a lesser symbol before them.
        """
        total = int(size.sum())
        begin = np.cumsum(size) - size
        owner = np.repeat(np.arange(len(low)), size)
        rows = np.arange(total) + np.repeat(low - begin, size)
        key = owner * width + self.symbols[rows]
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if total else np.zeros(0, np.int64)
        count = np.diff(np.append(starts, total))
        owner, symbol = np.divmod(key[starts], width)
        fresh = np.minimum.reduceat(self.follow[rows[order]], starts) if total else starts
        real = symbol > 0
        return owner[real], symbol[real], fresh[real], count[real], (starts - begin[owner])[real]


class Index:
    """Both orders of a shard.  Phrases are rows of ids with an interval in either order."""

    def __init__(self, ids: np.ndarray, size: int, depth: int):
        self.size = size
        self.forward = Order(ids, size, depth - 1)
        self.backward = Order(ids[::-1], size, depth - 1)
        counts = np.bincount(ids, minlength=size)
        there = np.flatnonzero(counts[1:]) + 1
        begin = (np.cumsum(counts) - counts)[there]
        self.words = (there[:, None], begin, begin, counts[there])

    def right(self, phrases: tuple) -> tuple:
        ids, low, back, size = phrases
        owner, symbol, fresh, count, shift = self.backward.extend(back, size, self.size)
        return np.column_stack([ids[owner], symbol]), low[owner] + shift, fresh, count

    def left(self, phrases: tuple) -> tuple:
        ids, low, back, size = phrases
        owner, symbol, fresh, count, shift = self.forward.extend(low, size, self.size)
        return np.column_stack([symbol, ids[owner]]), fresh, back[owner] + shift, count


class Bitmap:
    """Set of hashes; may hold others too."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        spot = hashes & np.uint64(64 * len(self.cells) - 1)
        return (self.cells[(spot >> np.uint64(6)).astype(np.int64)] >> (spot & np.uint64(63))) & np.uint64(1) == 1


def bitmap(rows: DataFrame, max_bits: int) -> Bitmap:
    """Bitmap of the column ``hash``: 16 bits for each row, at most ``2^max_bits`` in all."""
    bits = min(max_bits, max(12, int(16 * rows.count()).bit_length()))
    spot = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(F.lit(63)).cast("int"))
    found = rows.groupBy(F.shiftright(spot, 6).alias("cell")).agg(F.bit_or(bit).alias("bits")).toArrow()
    cells = np.zeros(1 << (bits - 6), np.uint64)
    cells[found.column("cell").to_numpy()] = found.column("bits").to_numpy().astype(np.int64).view(np.uint64)
    return Bitmap(cells)


def enumerate_phrases(
    ids: np.ndarray, size: int, depth: int, pairs: np.ndarray | None = None, allowed: Bitmap | None = None,
    at_once: int = 1 << 17,
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Phrases of 2 to ``depth`` words, as rows of ids of one length, with their counts.

    ``pairs`` holds a hash for each id; with ``allowed``, phrases grow by pairs in it only.
    Each begins with the words of some ``at_once`` rows, so memory follows the index alone.
    """
    index = Index(ids, size, depth)
    group = np.cumsum(index.words[3]) // at_once
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1), len(group)]
    for start, end in zip(edges, edges[1:], strict=False):
        phrases = tuple(part[start:end] for part in index.words)
        for length in range(2, depth + 1):
            phrases = index.left(phrases) if length % 2 else index.right(phrases)
            if allowed is not None:
                one, other = (0, 1) if length % 2 else (-2, -1)
                words = phrases[0]
                kept = allowed.holds(pair_hash(pairs[words[:, one]], pairs[words[:, other]]))
                phrases = tuple(part[kept] for part in phrases)
            yield phrases[0], phrases[3]


KINDS = "lang string, phrase string, n_words int, n long, hash long"


def _rows(lang: str, words: pa.Array, phrases: np.ndarray, counts: np.ndarray, hashes: np.ndarray):
    """Batches of :data:`KINDS` for phrases given as rows of ids."""
    for start in range(0, len(counts), 50_000):
        part = slice(start, start + 50_000)
        columns = [words.take(pa.array(column)) for column in phrases[part].T]
        text = pc.binary_join_element_wise(*columns, " ") if len(columns) > 1 else columns[0]
        size = len(text)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang], pa.string()).take(pa.array(np.zeros(size, np.int64))), text,
                pa.array(np.full(size, phrases.shape[1], np.int32)), pa.array(counts[part].astype(np.int64)),
                pa.array(hashes[part].view(np.int64)),
            ],
            ["lang", "phrase", "n_words", "n", "hash"],
        )


def _each(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for lang, words, ids in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            yield (lang, *_shard_of(lang, words, ids))


def word_counts(cut: DataFrame) -> DataFrame:
    """Counts of single words, summed over shards."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, listed, hashes, ids in _each(batches):
            there = np.arange(1, len(listed))
            counts = np.bincount(ids, minlength=len(listed))[1:]
            yield from _rows(lang, pa.array(listed, pa.binary()).cast(pa.string()), there[:, None], counts, hashes[1:])

    return _summed(cut.mapInArrow(run, KINDS))


def _cut_at_rare(listed: list[bytes], hashes: np.ndarray, ids: np.ndarray, words: Bitmap):
    """Words that may be frequent, their hashes, and the ids with breaks for all others."""
    frequent = words.holds(hashes)
    frequent[0] = False
    old = np.flatnonzero(frequent)
    fresh = np.zeros(len(listed), np.int32)
    fresh[old] = np.arange(1, len(old) + 1)
    return [BREAK, *(listed[i] for i in old)], np.concatenate([hashes[:1], hashes[old]]), _joined_breaks(fresh[ids])


def frequent_pairs(cut: DataFrame, words: Bitmap, s: Settings) -> Bitmap:
    """Pairs of words that may be frequent, from counts by ``2^max_bits`` buckets of their hashes.

    A bucket counts at least what any pair in it does; only bucket numbers and counts are shuffled.
    """
    mask = np.uint64((1 << s.max_bits) - 1)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, listed, hashes, ids in _each(batches):
            held, marks, kept = _cut_at_rare(listed, hashes, ids, words)
            for found, counts in enumerate_phrases(kept, len(held), 2):
                bucket = (pair_hash(marks[found[:, 0]], marks[found[:, 1]]) & mask).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array(counts.astype(np.int32))], ["bucket", "n"])

    sums = cut.mapInArrow(run, "bucket int, n int").groupBy("bucket").agg(F.sum("n").alias("n"))
    full = cut_lineage(sums.where(F.col("n") >= s.min_count).select(F.col("bucket").cast("long").alias("hash")))
    return bitmap(full, s.max_bits)


def phrase_counts(cut: DataFrame, longest: int, words: Bitmap, pairs: Bitmap) -> DataFrame:
    """Counts of phrases of 2 to ``longest`` words, all of whose pairs may be frequent."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, listed, hashes, ids in _each(batches):
            held, marks, kept = _cut_at_rare(listed, hashes, ids, words)
            text = pa.array(held, pa.binary()).cast(pa.string())
            for found, counts in enumerate_phrases(kept, len(held), longest, marks, pairs):
                yield from _rows(lang, text, found, counts, marks[found[:, 0]])

    return _summed(cut.mapInArrow(run, KINDS))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "phrase", "n_words").agg(F.sum("n").alias("a"), F.max("hash").alias("hash"))


def counted_phrases(docs: DataFrame, s: Settings, text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """Frequent words and phrases ``lang, phrase, n_words, a``, and ``lang, n``."""
    cut = cut_lineage(shards(docs, s, text, lang))
    # a shard is one value of about a megabyte; few at once keep Arrow's buffers small
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SHARD_BYTES))
    words = cut_lineage(word_counts(cut))
    sizes = words.groupBy("lang").agg(F.sum("a").alias("n"))
    frequent = words.where(F.col("a") >= s.min_count)
    known = bitmap(frequent, s.max_bits)
    longer = phrase_counts(cut, s.depth, known, frequent_pairs(cut, known, s))
    found = frequent.unionByName(cut_lineage(longer.where(F.col("a") >= s.min_count)))
    return found.drop("hash"), sizes


def score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """``floor(1000 * a * n / (left * right))`` without rounding."""
    wide = "decimal(19,0)"
    return F.call_function("div", (1000 * a).cast(wide) * n.cast(wide), left.cast(wide) * right.cast(wide))


def collocations(
    docs: DataFrame, settings: Settings | None = None, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score, left_extensions, right_extensions``.

    The extensions are the words that prolong the phrase to another frequent one.
    """
    s = settings or Settings()
    found, sizes = counted_phrases(docs, s, text, lang)
    candidates = found.where("n_words > 1")
    words = F.split("phrase", " ", -1)
    part = lambda start, size: F.array_join(F.slice(words, start, size), " ")

    count = F.col("n_words")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), count - 1))).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, count).alias("rest")
    )
    first = found.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    rest = found.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    cut_score = score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    scored = (
        cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(sizes, "lang")
        .select("lang", "phrase", F.struct(cut_score.alias("score"), "k", "l", "r", "a", "n").alias("cut"))
        .groupBy("lang", "phrase").agg(F.min("cut").alias("cut"))
    )

    within = F.flatten(F.transform(
        F.sequence(F.lit(2), count - 1),
        lambda size: F.transform(
            F.sequence(F.lit(1), count - size + 1),
            lambda start: F.struct(
                F.array_join(F.slice(words, start, size), " ").alias("phrase"),
                ((start == 1) & (size == count - 1)).alias("to_right"), ((start == 2) & (size == count - 1)).alias("to_left"),
            ),
        ),
    ))
    longer = (
        candidates.where("n_words > 2").select("lang", "a", F.explode(within).alias("in"))
        .groupBy("lang", F.col("in.phrase").alias("phrase"))
        .agg(
            F.max("a").alias("longer"), F.count_if("in.to_left").alias("left_extensions"),
            F.count_if("in.to_right").alias("right_extensions"),
        )
    )
    covered = F.lit(100) * F.col("longer") >= F.lit(s.covered_percent) * F.col("cut.a")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    none = F.lit(0).cast("long")
    return (
        scored.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
        .select(
            "lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score",
            F.coalesce("left_extensions", none).alias("left_extensions"),
            F.coalesce("right_extensions", none).alias("right_extensions"),
        )
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= s.top)
        .select(
            "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score",
            "left_extensions", "right_extensions",
        )
    )


def op11_collocations(spark, folder: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{folder}/documents.parquet").select("text", "lang"))


ORACLE = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS words
    FROM documents
), lengths AS (SELECT unnest(range(1, 6)) AS n_words),
said AS (
    SELECT lang, n_words, words, unnest(range(1, len(words) - n_words + 2)) AS start
    FROM pieces JOIN lengths ON n_words <= len(words)
), counted AS (
    SELECT lang, n_words, array_to_string(words[start:start + n_words - 1], ' ') AS phrase, count(*) AS a
    FROM said GROUP BY ALL
), sizes AS (SELECT lang, sum(a) AS n FROM counted WHERE n_words = 1 GROUP BY lang),
candidates AS (
    SELECT *, string_split(phrase, ' ') AS words FROM counted WHERE n_words > 1 AND a >= 100
), cuts AS (SELECT *, unnest(range(1, n_words)) AS k FROM candidates),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, l.a AS l, r.a AS r, s.n,
        (1000::HUGEINT * c.a * s.n) // (l.a::HUGEINT * r.a) AS score
    FROM cuts c JOIN sizes s ON s.lang = c.lang
    JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:c.k], ' ')
    JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[c.k + 1:], ' ')
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), shorter AS (SELECT *, unnest(range(2, n_words)) AS size FROM candidates),
inside AS (SELECT *, unnest(range(1, n_words - size + 2)) AS start FROM shorter),
longer AS (
    SELECT lang, array_to_string(words[start:start + size - 1], ' ') AS phrase, max(a) AS longer,
        count(*) FILTER (size = n_words - 1 AND start = 2) AS left_extensions,
        count(*) FILTER (size = n_words - 1 AND start = 1) AS right_extensions
    FROM inside GROUP BY ALL
), ranked AS (
    SELECT p.lang, row_number() OVER (PARTITION BY p.lang ORDER BY score DESC, a DESC, p.phrase) AS rank,
        p.phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score,
        coalesce(left_extensions, 0) AS left_extensions, coalesce(right_extensions, 0) AS right_extensions
    FROM lowest p LEFT JOIN longer x ON x.lang = p.lang AND x.phrase = p.phrase
    WHERE coalesce(100 * longer < 100 * a, true)
)
SELECT * FROM ranked WHERE rank <= 2000
"""
