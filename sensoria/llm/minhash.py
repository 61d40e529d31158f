"""Near-duplicate documents by SuperMinHash, banding, full verification and union of links.

A document's set holds its distinct word shingles (lower-cased words); with fewer words than
a shingle takes, the whole sequence is the one element.  Documents are linked when their
sets' Jaccard similarity reaches the threshold; groups are the connected components.

1. Every set gets a SuperMinHash signature: step j of an element's own random permutation
   offers the value j + r to one signature place.  A set stops after the first step at which
   every place holds less than j + 1, because later steps cannot win any more.
2. A word sequence, named by its 128-bit hash, is one node from here on: exact copies never meet
   in pairs, and texts under one ``doc_id`` stay apart.
3. Nodes that agree in a whole band share a bucket; buckets are joined as stars, and the
   components of these stars are *families*, within which all candidate pairs lie.
4. All pairs inside a family are decided on full sets, in blocks of bounded size: a block pair
   counts common shingles by matrix products and returns a spanning forest of its links, so
   no list of pairs is ever formed.
5. The components of those links are the groups.

Shingles are compared as 64-bit hashes.  A pair at the threshold is missed by the bands with
probability (1 - t^rows)^bands: 3e-6 at 0.8 with the defaults; above it, less.  A family of g
different texts costs g^2/2 comparisons of sets inside tasks and g/block copies of its sets
in the shuffle; that is the price of losing no link.

Defined results: NULL, empty and blank texts have an empty set and are linked with nothing,
not even with each other.  ``doc_id`` is of any type with an order; rows that repeat one are
grouped by their own texts, and equal rows get equal results.  Rows with NULL ``doc_id`` get
component NULL and are kept.  Ties go to the smallest ``doc_id``.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensoria.llm.graph import components
from sensoria.llm.words import WordTable, hash_words, mix, raw, small_batches, split, tidied
from sensoria.session import cut_lineage

_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Settings:
    shingle: int = 5
    percent: int = 80
    bands: int = 24
    rows: int = 4
    block: int = 128


def shingle_sets(
    texts: list[bytes | None], table: WordTable, shingle: int
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after the other, and their number."""
    ids, lengths = table.batch(texts)
    if not len(ids):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    words = table.rows[ids]
    starts = np.cumsum(lengths) - lengths
    rolled = mix(words + _STEP)
    for step in range(1, shingle):
        rolled[:-step] = mix(rolled[:-step] * np.uint64(3) + words[step:])
    sets = []
    for start, length in zip(starts.tolist(), lengths.tolist(), strict=True):
        if length >= shingle:
            sets.append(np.unique(rolled[start : start + length - shingle + 1]))
        elif length:
            value = np.full(1, length, np.uint64)
            for word in words[start : start + length]:
                value = mix(value * _STEP + word)
            sets.append(value)
        else:
            sets.append(np.zeros(0, np.uint64))
    return np.concatenate(sets), np.array([len(s) for s in sets], np.int64)


def super_minhash(elements: np.ndarray, sizes: np.ndarray, places: int) -> np.ndarray:
    """SuperMinHash signatures (sets x places) of sets laid one after the other."""
    signature = np.full((len(sizes), places), np.inf)
    flat = signature.reshape(-1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order: np.ndarray | None = None
    seeds = np.arange(1, places + 1, dtype=np.uint64) * _STEP
    for j in range(places):
        if not len(elements):
            break
        value = mix(elements + seeds[j])
        rank = j + (value >> np.uint64(32)).astype(np.float64) / 2.0**32
        low = value & np.uint64(0xFFFFFFFF)
        pick = j + ((low * np.uint64(places - j)) >> np.uint64(32)).astype(np.int64)
        if order is None:
            place = pick
        else:
            row = np.arange(len(elements))
            place = order[row, pick].astype(np.int64)
            order[row, pick] = order[row, j]
        np.minimum.at(flat, owner * places + place, rank)
        going = (signature.max(axis=1) >= j + 1)[owner]
        if order is None and going.any():
            order = np.tile(np.arange(places, dtype=np.uint16), (int(going.sum()), 1))
            order[np.arange(len(order)), pick[going]] = 0
            elements, owner = elements[going], owner[going]
        elif not going.all():
            elements, owner, order = elements[going], owner[going], order[going] if order is not None else None
    return signature


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature, the band's number included."""
    cells = signature.view(np.uint64).reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(bands, dtype=np.uint64) * _STEP, cells.shape[:2])
    for row in range(rows):
        key = mix(key + cells[:, :, row])
    return key.view(np.int64)


def signatures(docs: DataFrame, s: Settings, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, copy, n_shingles, content, bands``; content names the exact word sequence.

    ``copy`` is the whole text's hash, which tells rows of one ``doc_id`` apart.
    """
    small_batches(docs.sparkSession)

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(hash_words)
        for batch in batches:
            texts = raw(batch.column(2))
            elements, sizes = shingle_sets(texts, table, s.shingle)
            keys = band_keys(super_minhash(elements, sizes, s.bands * s.rows), s.bands, s.rows)
            content = [
                hashlib.blake2b(b" ".join(split(t)), digest_size=16).digest() if n else None
                for t, n in zip(texts, sizes.tolist(), strict=True)
            ]
            some = sizes > 0
            offsets = np.concatenate([[0], np.cumsum(some * s.bands)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array(sizes), pa.array(content, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[some].reshape(-1))),
                ],
                ["doc_id", "copy", "n_shingles", "content", "bands"],
            )

    rows = docs.select(*_identity(text, key), F.col(text).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(
        run, f"doc_id {kind}, copy long, n_shingles long, content binary, bands array<bigint>"
    )


def _identity(text: str, key: str) -> list[Column]:
    return [F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("copy")]


def _sets(docs: DataFrame, s: Settings) -> DataFrame:
    """Input ``node, family, parts, text``; the text replaced by its full set, once a node and task."""

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = WordTable(hash_words), set()
        for batch in batches:
            fresh = []
            for place, node in enumerate(batch.column(0).to_pylist()):
                if node not in seen:
                    seen.add(node)
                    fresh.append(place)
            batch = batch.take(pa.array(fresh, pa.int64()))
            elements, sizes = shingle_sets(raw(batch.column(3)), table, s.shingle)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            found = pa.ListArray.from_arrays(offsets, pa.array(elements.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), found], ["node", "family", "parts", "set"]
            )

    return docs.mapInArrow(run, "node binary, family binary, parts int, set array<bigint>")


def block_links(nodes: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], percent: int):
    """Spanning forest of the links of one block pair: (node, root) pairs.

    With two blocks only pairs across them count; each block alone is a group of its own.
    """
    sizes = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, column = np.unique(np.concatenate(sets), return_inverse=True)
    shared = np.bincount(column, minlength=len(values)) > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = 2048
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        there = np.zeros((len(sets), width), np.float32)
        there[owner[a:b], column[a:b] - start] = 1
        common += there @ there.T
    linked = 100 * common >= percent * (sizes[:, None] + sizes[None] - common)
    if sides.any() and not sides.all():
        linked &= sides[:, None] != sides[None]
    np.fill_diagonal(linked, True)
    label = np.arange(len(sets))
    while True:
        lower = np.where(linked, label[None], len(sets)).min(axis=1)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    moved = label != np.arange(len(sets))
    return nodes[moved], nodes[label[moved]]


def _family_links(blocks: DataFrame, s: Settings) -> DataFrame:
    """Links of each block pair; rows come sorted by family and pair."""

    def groups(batches: Iterator[pa.RecordBatch]):
        held: list = []
        current = None
        for batch in batches:
            at = [batch.column(i).to_pylist() for i in range(5)]
            lists, offsets = batch.column(5), batch.column(5).offsets.to_numpy()
            values = lists.values.to_numpy().view(np.uint64)
            for i in range(batch.num_rows):
                pair = (at[0][i], at[1][i], at[2][i])
                if pair != current and held:
                    yield held
                    held = []
                current = pair
                if held and held[-1][0] == at[4][i]:
                    continue  # the same text from another task
                held.append((at[4][i], at[3][i], values[offsets[i] : offsets[i + 1]].copy()))
        if held:
            yield held

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in groups(batches):
            if len(held) < 2:
                continue
            nodes, sides, sets = zip(*held, strict=True)
            a, b = block_links(np.array(nodes, object), np.array(sides, bool), list(sets), s.percent)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return blocks.mapInArrow(run, "a binary, b binary")


def near_duplicates(
    docs: DataFrame, settings: Settings | None = None, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``."""
    s = settings or Settings()
    return _grouped(docs, s, text, key).drop("copy")


def _grouped(docs: DataFrame, s: Settings, text: str, key: str) -> DataFrame:
    """The same with the text's hash as ``copy``."""
    signed = cut_lineage(signatures(docs, s, text, key))
    # of equal word sequences one row stands for all: the first by doc_id
    nodes = cut_lineage(
        signed.where("content IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("content").alias("node"))
        .agg(F.min(F.struct("doc_id", "copy")).alias("first"), F.any_value("bands").alias("bands"))
        .select("node", "first.doc_id", "first.copy", "bands")
    )
    buckets = nodes.select("node", F.explode("bands").alias("band"))
    hubs = buckets.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("last")).where("hub < last")
    stars = buckets.join(hubs.select("band", "hub"), "band").where("node <> hub")
    families = components(stars.select(F.col("node").alias("a"), F.col("hub").alias("b")))
    sizes = families.groupBy("component").agg(F.count("*").alias("members"))
    members = cut_lineage(
        families.join(sizes, "component").select(
            "node", F.col("component").alias("family"),
            F.ceil(F.col("members") / s.block).cast("int").alias("parts"),
        )
    )
    texts = docs.select(*_identity(text, key), F.col(text).alias("text"))
    places = members.join(nodes.select("node", "doc_id", "copy"), "node")
    full = cut_lineage(_sets(texts.join(places, ["doc_id", "copy"]).select("node", "family", "parts", "text"), s))
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    blocks = (
        full.withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "family", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
            (F.col("part") > F.col("other")).cast("int").alias("second"), "node", "set",
        )
    )
    ordered = blocks.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "second", "node")
    groups = cut_lineage(components(_family_links(ordered, s)))
    least = (
        groups.join(nodes.select("node", "doc_id"), "node")
        .groupBy("component").agg(F.min("doc_id").alias("component_id"))
    )
    labels = cut_lineage(
        nodes.select("node", "doc_id").join(groups.join(least, "component"), "node", "left").select(
            F.col("node").alias("content"), F.coalesce("component_id", "doc_id").alias("component_id")
        )
    )
    found = signed.select("doc_id", "copy", "n_shingles", "content").join(labels, "content", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return found.select("doc_id", "n_shingles", own.alias("component_id"), "copy").withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def keep_first(
    docs: DataFrame, settings: Settings | None = None, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``docs`` with one document of each group; rows without ``doc_id`` stay.

    Rows are told apart by ``doc_id`` and text; of rows equal in both, one stays.
    """
    judged = (
        _grouped(docs, settings or Settings(), text, key).where("doc_id IS NOT NULL")
        .groupBy("doc_id", "copy").agg(F.bool_or("kept").alias("kept"), F.count("*").alias("times"))
        .where("NOT kept OR times > 1")
    )
    judged = cut_lineage(judged)
    # the row travels as one column, so that no name of its can clash
    rows = docs.select(*_identity(text, key), F.struct("*").alias("row"))
    untouched = rows.join(judged.select("doc_id", "copy"), ["doc_id", "copy"], "left_anti")
    repeated = rows.join(judged.where("kept").select("doc_id", "copy"), ["doc_id", "copy"], "left_semi")
    return untouched.unionByName(repeated.dropDuplicates(["doc_id", "copy"])).select("row.*")


def op5_minhash(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return near_duplicates(docs, Settings(shingle=4))
