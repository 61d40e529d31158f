"""How far the sources of a language differ in their words: sparse term counts, exact integers.

A table of 256 bytes lowers A-Z and blanks every other ASCII byte that is no letter; with it
``bytes.translate`` and ``bytes.split`` tokenize a text in two calls.  A ``Counter`` for each
document gives its term counts, and its keys the document counts; a task sums them by group
before anything is shuffled, so a source or a word that holds a third of the corpus is one row of
each task.  A language keeps the terms in at least ``min_docs`` of its documents.

Every group (language and source) gives each kept term the smoothed share
``p = 1 + floor(scale * (count + 2) / (N + 2 * V))``; two shares differ by
``floor((p - q)^2 / (p + q))``.  Sources are compared in blocks: a block pair reads the terms that
occur in either block, in slots by the term's hash, and fills absent ones with the share of a zero
count; terms that occur in neither add the same number each and are counted, not read.  A task
holds the sums of one block pair.

Defined results: NULL texts, languages and sources are empty strings; a group without terms is a
group all the same; languages without kept terms have distance 0 everywhere and no term rows; ties
go by the item's UTF-8 bytes; repeated rows count as documents of their own.  An empty table gives
no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sensoria.llm.words import raw, small_batches, tidied
from sensoria.session import cut_lineage

SCALE = 10**9


@dataclass
class Settings:
    min_docs: int = 10
    top: int = 10
    block: int = 64
    held_terms: int = 300_000
    chunk_rows: int = 32_768


def _byte_table() -> bytes:
    upper, lower = range(0x41, 0x5B), range(0x61, 0x7B)
    return bytes(b + 32 if b in upper else b if b in lower or b >= 0x80 else 0x20 for b in range(256))


TABLE = _byte_table()


def terms_of(text: bytes | None) -> Counter:
    """Term counts of one text."""
    return Counter(text.translate(TABLE).split()) if text else Counter()


def _sums(held: dict) -> Iterator[pa.RecordBatch]:
    """Rows of a task's sums; every group also has one row with an empty term."""
    for (lang, source), (counts, docs) in held.items():
        terms = [b"", *counts]
        for start in range(0, len(terms), 50_000):
            part = terms[start : start + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array([counts[term] for term in part], pa.int64()),
                    pa.array([docs[term] for term in part], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )


def term_counts(
    docs: DataFrame, settings: Settings | None = None, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """``lang, source, term, n, docs``; the empty term marks that a group occurs."""
    limit = (settings or Settings()).held_terms
    small_batches(docs.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = defaultdict(lambda: (Counter(), Counter()))
        for batch in batches:
            texts, langs, sources = batch.columns
            for words, *group in zip(raw(texts), langs.to_pylist(), sources.to_pylist(), strict=True):
                counts, seen = held[tuple(group)]
                found = terms_of(words)
                counts.update(found)
                seen.update(found.keys())
            if sum(len(counts) for counts, _ in held.values()) > limit:
                yield from _sums(held)
                held.clear()
        yield from _sums(held)

    name = lambda column: F.coalesce(F.col(column).cast("string"), F.lit(""))
    rows = docs.select(F.col(text), name(lang).alias("lang"), name(source).alias("source"))
    sums = rows.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return (
        sums.repartition("lang", "term").groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    )


def _whole(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column, terms: Column) -> Column:
    """Smoothed share of a count in ``total`` over ``terms`` terms; 0 where there are no terms."""
    above = (count + 2).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = F.nullif((total + 2 * terms).cast("decimal(19,0)"), F.lit(0).cast("decimal(19,0)"))
    return F.coalesce(1 + _whole(above, below), F.lit(0)).cast("long")


def difference(p: Column, q: Column) -> Column:
    return _whole((p - q) * (p - q), p + q)


def kept_terms(counts: DataFrame, min_docs: int) -> DataFrame:
    """``lang, source, term, n, total, first`` of the kept terms, and the rows that mark groups.

    ``total`` is the language's count; ``first`` is true in one row of each term.
    """
    term = Window.partitionBy("lang", "term")
    return (
        counts.withColumns({
            "total": F.sum("n").over(term), "in_docs": F.sum("docs").over(term),
            "first": F.row_number().over(term.orderBy("source")) == 1,
        })
        .where((F.col("term") == "") | (F.col("in_docs") >= min_docs)).drop("docs", "in_docs")
    )


def group_facts(kept: DataFrame, block: int) -> DataFrame:
    """``lang, source, size, terms, lang_size, place, blocks``: one row for each group."""
    real = F.col("term") != ""
    sizes = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("size"), F.count_if(real & F.col("first")).alias("firsts")
    )
    lang = Window.partitionBy("lang")
    return sizes.select(
        "lang", "source", "size", F.sum("firsts").over(lang).alias("terms"), F.sum("size").over(lang).alias("lang_size"),
        (F.row_number().over(lang.orderBy("source")) - 1).alias("place"),
        F.ceil(F.count("*").over(lang) / block).cast("int").alias("blocks"),
    )


def outstanding(cells: DataFrame, top: int) -> DataFrame:
    """The terms of each group that it uses most above its language."""
    q = share(F.col("total"), F.col("lang_size"), F.col("terms"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        cells.select("lang", "source", F.col("term").alias("item"), "p", q.alias("q")).where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), "item", difference(F.col("p"), F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    )


class _BlockPair:
    """Sums of differences between the sources of two blocks, over one slot of the terms."""

    def __init__(self, key: tuple, block: int):
        self.key, self.block = key, block
        self.one, self.other = key[1] * block, key[2] * block
        self.zero = np.zeros(2 * block, np.int64)
        self.present = np.zeros(2 * block, bool)
        self.sums = np.zeros((block, block), np.int64)
        self.terms = 0

    def local(self, place: np.ndarray) -> np.ndarray:
        """Column of a source: the first block's, then the second's."""
        low = place - self.one
        return np.where((low >= 0) & (low < self.block), low, place - self.other + self.block)

    def mark(self, place: np.ndarray, share: np.ndarray) -> None:
        at = self.local(place)
        self.zero[at], self.present[at] = share, True

    def columns(self) -> tuple[np.ndarray, np.ndarray]:
        there = np.flatnonzero(self.present)
        left = there[there < self.block]
        return left, (left if self.one == self.other else there[there >= self.block])

    def add(self, number: np.ndarray, place: np.ndarray, share: np.ndarray) -> None:
        """Rows of whole terms, numbered from 0 in order."""
        count = int(number[-1]) + 1
        left, right = self.columns()
        table = np.tile(self.zero, (count, 1))
        table[number, self.local(place)] = share
        self.terms += count
        facing = table[:, right]
        for a in left:
            self.sums[a, right % self.block] += _differ(table[:, a : a + 1], facing).sum(axis=0)

    def rows(self) -> list[tuple]:
        left, right = self.columns()
        out = []
        for a in left:
            for b in right:
                if self.one != self.other or a < b:
                    out.append((
                        self.key[0], int(self.one + a), int(self.other + b % self.block),
                        int(self.sums[a, b % self.block]), self.terms, int(_differ(self.zero[a], self.zero[b])),
                    ))
        return out


def _differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // np.maximum(p + q, 1)


def _starts(columns: list[pa.Array], count: int) -> np.ndarray:
    """True where any column differs from the row before."""
    out = np.ones(count, bool)
    out[1:] = False
    for column in columns:
        out[1:] |= pc.not_equal(column.slice(1), column.slice(0, count - 1)).to_numpy(zero_copy_only=False)
    return out


def _pair_sums(batches: Iterator[pa.RecordBatch], s: Settings) -> Iterator[pa.RecordBatch]:
    """Sums of each block pair and slot from rows in order of pair, slot and term."""
    keys = ["lang", "one", "other", "slot"]
    state: _BlockPair | None = None
    wait: list[pa.RecordBatch] = []

    def told(pair: _BlockPair) -> Iterator[pa.RecordBatch]:
        rows = pair.rows()
        if rows:
            kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "a", "b", "found", "terms_read", "base"])

    def work(last: bool) -> Iterator[pa.RecordBatch]:
        """All whole terms that wait; the last one waits on, as it may go on."""
        nonlocal state, wait
        table = pa.Table.from_batches(wait).combine_chunks()
        flat = {name: table.column(name).combine_chunks() for name in table.column_names}
        count = table.num_rows
        groups = _starts([flat[name] for name in keys], count)
        terms = groups | _starts([flat["term"]], count)
        end = count if last else int(np.flatnonzero(terms)[-1])
        place, share = flat["place"].to_numpy(), flat["p"].to_numpy()
        blank = pc.equal(flat["term"], "").to_numpy(zero_copy_only=False)
        edges = [*np.flatnonzero(groups[:end]), end]
        for low, high in zip(edges, edges[1:], strict=False):
            key = tuple(flat[name][int(low)].as_py() for name in keys)
            if state is None or state.key != key:
                if state is not None:
                    yield from told(state)
                state = _BlockPair(key, s.block)
            part = np.arange(low, high)
            zeros, real = part[blank[low:high]], part[~blank[low:high]]
            if len(zeros):
                state.mark(place[zeros], share[zeros])
            if len(real):
                number = np.cumsum(terms[real])
                state.add(number - number[0], place[real], share[real])
        wait = [] if end == count else pa.Table.from_batches(wait).slice(end).combine_chunks().to_batches()

    for batch in batches:
        if batch.num_rows:
            wait.append(batch)
            if sum(x.num_rows for x in wait) >= s.chunk_rows:
                yield from work(False)
    if wait:
        yield from work(True)
    if state is not None:
        yield from told(state)


def distances(cells: DataFrame, facts: DataFrame, s: Settings) -> DataFrame:
    """Distance of each source to every other source of its language."""
    spark = cells.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    pairs = F.col("blocks") * (F.col("blocks") + 1) / 2
    slots = F.ceil(F.lit(tasks) / pairs).cast("int")
    zero = share(F.lit(0).cast("long"), F.col("size"), F.col("terms"))
    marks = facts.select(
        "lang", "place", "blocks", F.explode(F.sequence(F.lit(0), slots - 1)).alias("slot"), F.lit("").alias("term"),
        zero.alias("p"),
    )
    rows = cells.select(
        "lang", "place", "blocks", F.pmod(F.xxhash64("term"), slots).cast("int").alias("slot"), "term", "p"
    ).unionByName(marks)
    own = F.floor(F.col("place") / s.block).cast("int")
    rows = rows.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang", F.least(own, F.col("met")).alias("one"), F.greatest(own, F.col("met")).alias("other"),
        "slot", "term", "place", "p",
    )
    order = ["lang", "one", "other", "slot"]
    sums = (
        rows.repartition(*order).sortWithinPartitions(*order, "term")
        .mapInArrow(
            lambda batches: _pair_sums(batches, s),
            "lang string, a int, b int, found long, terms_read long, base long",
        )
        .groupBy("lang", "a", "b")
        .agg(F.sum("found").alias("found"), F.sum("terms_read").alias("terms_read"), F.max("base").alias("base"))
    )
    both = sums.withColumn("side", F.explode(F.array(F.array("a", "b"), F.array("b", "a")))).select(
        "lang", F.col("side")[0].alias("place"), F.col("side")[1].alias("met"), "found", "terms_read", "base"
    )
    named = facts.select("lang", "place", "source", "terms")
    met = facts.select("lang", F.col("place").alias("met"), F.col("source").alias("item"))
    value = F.col("found") + (F.col("terms") - F.col("terms_read")) * F.col("base")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (
        both.join(named, ["lang", "place"]).join(met, ["lang", "met"])
        .select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
        .withColumn("rank", F.row_number().over(best))
    )


def audit(
    docs: DataFrame, settings: Settings | None = None, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """``lang, source, part, item, value, rank``: distances between sources, and outstanding terms."""
    s = settings or Settings()
    kept = cut_lineage(kept_terms(term_counts(docs, s, text, lang, source), s.min_docs))
    facts = cut_lineage(group_facts(kept, s.block))
    cells = kept.where("term <> ''").join(facts, ["lang", "source"]).withColumn(
        "p", share(F.col("n"), F.col("size"), F.col("terms"))
    )
    return distances(cells, facts, s).unionByName(outstanding(cells, s.top))


def op12_divergence(spark, folder: str) -> DataFrame:
    return audit(spark.read.parquet(f"{folder}/documents.parquet").select("text", "lang", "source"))


ORACLE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), said AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM said GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, count(*) AS terms, sum(total) AS lang_size FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM said JOIN kept USING (lang, term) GROUP BY lang, source, term),
sources AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (
    SELECT s.lang, s.source, coalesce(sum(n), 0) AS size
    FROM sources s LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source GROUP BY ALL
), cells AS (
    SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
        1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (s.size + 2 * l.terms) AS p,
        1 + (1000000000::HUGEINT * (k.total + 2)) // (l.lang_size + 2 * l.terms) AS q
    FROM sizes s JOIN langs l ON l.lang = s.lang JOIN kept k ON k.lang = s.lang
    LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term
), summed AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
    FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM cells WHERE n > 0 AND p > q
), ranked AS (
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
        CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM found
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 10
"""
