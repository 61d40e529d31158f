"""Exact top-k search on binary codes by incremental multi-index hashing.

A vector's code has one bit for each component: set unless the component is negative.  Codes
are dealt into blocks of bounded size, and every block of queries meets every block of codes
in one task.  There, codes are cut into about as many segments as their bits hold logarithms
of the block's size, each with an index of its values.  For one query the segment radius r
grows from 0; for each segment in turn the values at distance exactly r from the query's are
looked up and what is new is verified on whole codes.  With ``segments`` segments, after
segment j of radius r every code within ``segments * r + j`` bits has been verified: one
further away in all segments has at least one bit more.  The query is finished as soon as its
k-th verified distance is covered.

Equal codes are one code with the rows of its k + 1 smallest ids, equal ids counted, limited
before the shuffle, so a vector or an id that fills a third of the table is one entry.  Rows
of the query's own id are left out inside the search and count for nothing there, so k rows
of other ids are covered however often an id repeats.  The nearest of all blocks are merged
by query.

Defined results: neighbours are ordered by distance, then id, and never include rows of the
query's own id; fewer than k other rows give fewer neighbours.  NULL and empty vectors and
NULL ids take no part.  NULL components, and those that shorter vectors lack, count as
negative, NaN as not negative.  Repeated ids are one row each.  A query id that repeats with
different codes gets one list for each of its codes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensoria.session import cut_lineage


@dataclass
class Settings:
    """``block_codes`` and ``block_queries`` bound what meets in one task."""

    k: int = 10
    query_modulus: int = 50
    block_codes: int = 8192
    block_queries: int = 1024


def binary_codes(vectors: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """``id, code`` (array of 64-bit words) and the number of bits."""
    rows = vectors.where(F.col(key).isNotNull() & (F.size(vector) > 0))
    bits = rows.agg(F.max(F.size(vector))).first()[0] or 0
    one = F.lit(1).cast("long")
    words = []
    for start in range(0, bits, 64):
        word = F.lit(0).cast("long")
        for i in range(start, min(start + 64, bits)):
            word = word.bitwiseOR(F.when(F.get(vector, F.lit(i)) >= 0, F.shiftleft(one, i - start)).otherwise(F.lit(0)))
        words.append(word)
    return rows.select(F.col(key).cast("long").alias("id"), F.array(*words).alias("code")), bits


def segments(bits: int, codes: int) -> list[tuple[int, int]]:
    """First bit and width of each segment; a segment lies within one word."""
    wide = min(16, max(4, round(log2(max(codes, 2)))))
    out = []
    for start in range(0, bits, 64):
        size = min(64, bits - start)
        parts = max(1, round(size / wide))
        edges = [start + size * i // parts for i in range(parts + 1)]
        out += [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return out


def _smallest(rows: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """The first n rows of each group; Spark limits groups before the shuffle."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("_place", place).where(F.col("_place") <= n)


@functools.lru_cache(maxsize=512)
def _masks(width: int, radius: int) -> np.ndarray:
    """All values of so many bits with so many ones."""
    values = np.arange(1 << width, dtype=np.uint64)
    return values[np.bitwise_count(values) == radius]


class MultiIndex:
    """Indexes of one block of codes (codes x words) by segment.

    ``owner, ids, times`` list the codes' rows: place of the code, id, rows with that id.
    """

    def __init__(self, codes: np.ndarray, owner: np.ndarray, ids: np.ndarray, times: np.ndarray, bits: int):
        order = np.lexsort((ids, owner))
        self.codes, self.bits = codes, bits
        self.ids, self.times = ids[order], times[order]
        self.start = np.searchsorted(owner[order], np.arange(len(codes) + 1))
        self.members = np.bincount(owner, times, len(codes))
        by_id = np.argsort(ids, kind="stable")
        self.by_id = ids[by_id], owner[by_id], times[by_id]
        self.parts = segments(bits, len(codes))
        self.tables = []
        for first, width in self.parts:
            value = self._segment(codes, first, width).astype(np.int64)
            edges = np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << width))])
            self.tables.append((np.argsort(value, kind="stable"), edges))

    @staticmethod
    def _segment(codes: np.ndarray, first: int, width: int) -> np.ndarray:
        return (codes[..., first // 64] >> np.uint64(first % 64)) & np.uint64((1 << width) - 1)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest rows of other ids than ``own``, ties by id."""
        members, seen = self.members, np.zeros(len(self.codes), bool)
        sorted_ids, owner, times = self.by_id
        mine = slice(np.searchsorted(sorted_ids, own, "left"), np.searchsorted(sorted_ids, own, "right"))
        if mine.start < mine.stop:
            members = members.copy()
            members[owner[mine]] -= times[mine]
            seen[members <= 0] = True
        near = np.zeros(self.bits + 1)  # verified rows by distance
        places, distances = [], []
        wanted = min(k, int(members.sum()))
        last = self.bits
        for radius in range(max(width for _, width in self.parts) + 1):
            for j, (first, width) in enumerate(self.parts):
                if radius <= width:
                    order, edges = self.tables[j]
                    value = (self._segment(query, first, width) ^ _masks(width, radius)).astype(np.int64)
                    size = edges[value + 1] - edges[value]
                    value, size = value[size > 0], size[size > 0]
                    at = np.arange(size.sum()) + np.repeat(edges[value] - (np.cumsum(size) - size), size)
                    found = order[at]
                    found = found[~seen[found]]
                    seen[found] = True
                    distance = np.bitwise_count(self.codes[found] ^ query).sum(axis=1)
                    near += np.bincount(distance, members[found], self.bits + 1)
                    places.append(found)
                    distances.append(distance)
                    last = int(np.searchsorted(np.cumsum(near), wanted))
                if last <= len(self.parts) * radius + j:
                    break
            else:
                continue
            break
        place, distance = np.concatenate(places), np.concatenate(distances)
        kept = distance <= last
        place, distance = place[kept], distance[kept]
        first = self.start[place]
        at = np.minimum(first + 1, len(self.ids) - 1)
        smallest = np.where(self.ids[first] == own, self.ids[at], self.ids[first])  # of other ids
        best = np.lexsort((smallest, distance))[:k]
        place, distance = place[best], distance[best]
        size = self.start[place + 1] - self.start[place]
        at = np.arange(size.sum()) + np.repeat(self.start[place] - (np.cumsum(size) - size), size)
        distance = np.repeat(distance, size)
        other = self.ids[at] != own
        at, distance = at[other], distance[other]
        size = np.minimum(self.times[at], k)
        ids, distance = np.repeat(self.ids[at], size), np.repeat(distance, size)
        best = np.lexsort((ids, distance))[:k]
        return ids[best], distance[best].astype(np.int32)


def top_k(
    vectors: DataFrame, queries: DataFrame, settings: Settings | None = None,
    key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, neighbour_id, distance`` for every row of ``queries``."""
    s = settings or Settings()
    coded, bits = binary_codes(vectors, key, vector)
    if not bits:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, neighbour_id long, distance int")
    # one id more than wanted, as one of a code's ids may be the query's own
    counted = coded.groupBy("code", "id").agg(F.count("*").alias("times"))
    codes = cut_lineage(
        _smallest(counted, "code", ["id"], s.k + 1)
        .groupBy("code").agg(F.collect_list("id").alias("ids"), F.collect_list("times").alias("times"))
    )
    asked = queries.where(F.col(key).isNotNull() & (F.size(vector) > 0)).select(F.col(key).cast("long").alias("id"))
    asked = coded.join(asked.distinct(), "id", "left_semi").select("id", "code").distinct()
    asked = cut_lineage(asked.withColumn("query", F.monotonically_increasing_id()))
    code_blocks = max(1, -(-codes.count() // s.block_codes))
    query_blocks = max(1, -(-asked.count() // s.block_queries))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    own = lambda name, count: F.pmod(F.xxhash64(name), F.lit(count)).cast("int")
    dealt = codes.select(
        own("code", code_blocks).alias("block"), every(query_blocks).alias("asking"), F.lit(0).alias("role"),
        F.lit(0).cast("long").alias("query"), "code", "ids", "times",
    ).unionAll(asked.select(
        every(code_blocks).alias("block"), own("query", query_blocks).alias("asking"), F.lit(1).alias("role"),
        "query", "code", F.array("id").alias("ids"), F.array(F.lit(0).cast("long")).alias("times"),
    ))
    ordered = dealt.repartition("block", "asking").sortWithinPartitions("block", "asking", "role")
    found = ordered.mapInArrow(
        lambda batches: _searched(batches, s.k, bits), "query long, query_id long, neighbour_id long, distance int"
    )
    return _smallest(found, "query", ["distance", "neighbour_id"], s.k).select(
        "query_id", F.col("_place").alias("rank"), "neighbour_id", "distance"
    )


def _searched(batches: Iterator[pa.RecordBatch], k: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Nearest rows of each block pair: its codes come first, then its queries."""
    pair, held, index = None, [], None
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        roles, queries = (batch.column(i).to_numpy() for i in (2, 3))
        codes = np.array(batch.column(4).to_pylist(), np.int64).view(np.uint64)
        ids, times = (batch.column(i).to_pylist() for i in (5, 6))
        out: list[tuple] = []
        for i, key in enumerate(keys):
            if key != pair:
                pair, held, index = key, [], None
            if roles[i] == 0:
                held.append((codes[i], ids[i], times[i]))
                continue
            if not held and index is None:
                continue
            if index is None:
                index = MultiIndex(
                    np.array([code for code, _, _ in held]),
                    np.repeat(np.arange(len(held)), [len(some) for _, some, _ in held]),
                    np.array([x for _, some, _ in held for x in some], np.int64),
                    np.array([x for _, _, some in held for x in some], np.int64), bits,
                )
                held = []
            near, distance = index.search(codes[i], ids[i][0], k)
            full = np.full(len(near), queries[i]), np.full(len(near), ids[i][0])
            out.append((*full, near, distance))
        if out:
            columns = [pa.array(np.concatenate(column)) for column in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["query", "query_id", "neighbour_id", "distance"])


def op3_hamming(spark, folder: str) -> DataFrame:
    s = Settings()
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    return top_k(vectors, vectors.where(F.col("vec_id") % s.query_modulus == 0), s)


ORACLE = """
WITH bits AS (
  SELECT vec_id, generate_subscripts(embedding, 1) AS place, unnest(embedding) >= 0 AS bit FROM embeddings
), d AS (
  SELECT q.vec_id AS query_id, o.vec_id AS neighbour_id,
         CAST(sum(CASE WHEN q.bit <> o.bit THEN 1 ELSE 0 END) AS INTEGER) AS distance
  FROM bits q JOIN bits o ON q.place = o.place AND q.vec_id <> o.vec_id
  WHERE q.vec_id % 50 = 0
  GROUP BY 1, 2
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS INTEGER) AS rank,
       neighbour_id, distance
FROM d QUALIFY rank <= 10
"""
