"""Boosted regression trees for all domains (gases, folds) at once.

Features are binned once by quantiles of each domain.  A tree level is one job over all rows:
every task adds up the residuals of its rows by (domain, node, feature, bin), the sums of one node
meet in one reducer, which chooses the split there, and only chosen splits reach the driver.  So
the number of jobs is rounds times levels however many domains there are, a domain holding a third
of all rows weighs on no task, and nothing on the driver or in a group grows with the rows.

Residuals are rounded to a power of two of the domain, so that all sums are exact and the trees do
not depend on how rows are dealt out; rows are sampled by a hash of their key for the same reason.
(Bin edges are approximate quantiles where a feature has more than some ten thousand values.)

The rows live in an RDD of numpy blocks: 1,500 jobs are planned far faster than as data frames,
and no column of them is read outside numpy.  Blocks that an executor loses are computed again
from the staged table and the trees grown so far.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensoria.session import cut_lineage, literal_table

#: Rounds after which the rows keep their residuals anew, instead of following the trees again.
KEPT_EVERY = 10
#: Fewer rows than these are not worth a task of their own.
ROWS_PER_TASK = 1 << 18
EXACT_BITS = 51
NO_SPLIT = -1

Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


@dataclass(frozen=True)
class Settings:
    rounds: int = 300
    depth: int = 5
    step: float = 0.05
    sample: float = 0.8
    bins: int = 32
    seed: int = 42


@dataclass(frozen=True)
class Tree:
    """One tree for each domain; node ``i`` has the children ``2i`` and ``2i + 1``, the root is 1."""

    feature: np.ndarray
    last_left: np.ndarray
    value: np.ndarray

    @staticmethod
    def empty(domains: int, depth: int) -> Tree:
        inner = np.full((domains, 1 << depth), NO_SPLIT, np.int8)
        return Tree(inner, np.zeros(inner.shape, np.int16), np.zeros((domains, 2 << depth)))

    def nodes(self, domain: np.ndarray, bins: np.ndarray, levels: int) -> np.ndarray:
        """Node of each row after so many levels; a row stays where its node has no split."""
        node = np.ones(len(domain), np.int64)
        rows = np.arange(len(domain))
        for _ in range(levels):
            inside = np.minimum(node, self.feature.shape[1] - 1)
            feature = self.feature[domain, inside]
            split = (feature != NO_SPLIT) & (node == inside)
            right = bins[rows, np.maximum(feature, 0)] > self.last_left[domain, inside]
            node = np.where(split, 2 * node + right, node)
        return node

    def predict(self, domain: np.ndarray, bins: np.ndarray) -> np.ndarray:
        depth = self.feature.shape[1].bit_length() - 1
        return self.value[domain, self.nodes(domain, bins, depth)]


def binned(values: np.ndarray, domain: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin of each value: 0 if missing, else 1 + the number of its domain's edges below it."""
    result = np.zeros(values.shape, np.uint8)
    for number in np.unique(domain):
        mine = np.flatnonzero(domain == number)
        for feature in range(values.shape[1]):
            own = values[mine, feature]
            found = 1 + np.searchsorted(edges[number, feature], own, side="left")
            result[mine, feature] = np.where(np.isnan(own), 0, found)
    return result


def sampled(key: np.ndarray, round_number: int, settings: Settings) -> np.ndarray:
    """Which rows take part in a round, by a hash of key and round."""
    with np.errstate(over="ignore"):
        mixed = key.astype(np.uint64) + np.uint64(settings.seed * 1_000_003 + round_number + 1) * np.uint64(
            0x9E3779B97F4A7C15
        )
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            mixed = (mixed ^ (mixed >> np.uint64(shift))) * np.uint64(factor)
    return (mixed >> np.uint64(11)).astype(np.float64) / 2.0**53 < settings.sample


def histograms(blocks: Iterable[Block], trees: Sequence[Tree], level: int, chosen, bins: int) -> Iterator:
    """((domain, node), sums) of one task: residual sum and rows by feature and bin of the nodes of a level."""
    sums: dict = {}
    *grown, growing = trees
    for domain, found, residual, key in blocks:
        for tree in grown:
            residual = residual - tree.predict(domain, found)
        take = chosen(key)
        domain, found, residual = domain[take], found[take], residual[take]
        node = growing.nodes(domain, found, level)
        deep = node >> level == 1
        domain, found, residual, node = domain[deep], found[deep], residual[deep], node[deep]
        if not len(node):
            continue
        width = 1 << (level + 1)
        named, slot = np.unique(domain.astype(np.int64) * width + node, return_inverse=True)
        features = found.shape[1]
        table = np.zeros((len(named), 2, features, bins))
        for feature in range(features):
            cell = slot * bins + found[:, feature]
            table[:, 0, feature] = np.bincount(cell, residual, len(named) * bins).reshape(-1, bins)
            table[:, 1, feature] = np.bincount(cell, minlength=len(named) * bins).reshape(-1, bins)
        for name, part in zip(named.tolist(), table, strict=True):
            place = divmod(name, width)
            sums[place] = sums[place] + part if place in sums else part
    return iter(sums.items())


def best_split(table: np.ndarray) -> tuple[int, int, float, float, float]:
    """(feature, last bin to the left, mean, left mean, right mean) of a node's sums.

    The split that lowers the squared error most; of equal ones the first feature's lowest bin.
    """
    total, rows = table[0, 0].sum(), table[1, 0].sum()
    mean = total / rows
    left, left_rows = table[0].cumsum(axis=1)[:, :-1], table[1].cumsum(axis=1)[:, :-1]
    right, right_rows = total - left, rows - left_rows
    both = (left_rows > 0) & (right_rows > 0)
    gain = np.where(
        both,
        left**2 / np.maximum(left_rows, 1) + right**2 / np.maximum(right_rows, 1) - total**2 / rows,
        0.0,
    )
    feature, last = np.unravel_index(gain.argmax(), gain.shape)
    if not gain[feature, last] > 0:
        return NO_SPLIT, 0, mean, mean, mean
    at = feature, last
    return int(feature), int(last), mean, left[at] / left_rows[at], right[at] / right_rows[at]


def grow(blocks: RDD, trees: list[Tree], round_number: int, unit: np.ndarray, settings: Settings) -> Tree:
    """The next tree, after those whose residuals the blocks do not hold yet."""
    tree = Tree.empty(len(unit), settings.depth)

    def chosen(key):
        return sampled(key, round_number, settings)

    bins = settings.bins + 1
    for level in range(settings.depth):
        known = [*trees, tree]

        def sums(part, known=known, level=level):
            return histograms(part, known, level, chosen, bins)

        summed = blocks.mapPartitions(sums)
        if (parts := blocks.getNumPartitions()) > 1:  # the sums of a single task are whole
            summed = summed.reduceByKey(np.add, min(parts, len(unit) << level))
        splits = summed.mapValues(best_split).collect()
        for (domain, node), (feature, last, mean, left, right) in splits:
            tree.feature[domain, node], tree.last_left[domain, node] = feature, last
            values = {node: mean} | ({2 * node: left, 2 * node + 1: right} if feature != NO_SPLIT else {})
            for place, value in values.items():
                # whole units again, as the residuals are
                tree.value[domain, place] = np.rint(settings.step * value / unit[domain]) * unit[domain]
        if all(split[0] == NO_SPLIT for _, split in splits):
            break
    return tree


def _stepped(blocks: RDD, trees: list[Tree]) -> RDD:
    def step(block: Block) -> Block:
        domain, bins, residual, key = block
        for tree in trees:
            residual = residual - tree.predict(domain, bins)
        return domain, bins, residual, key

    return blocks.map(step)


@dataclass(frozen=True)
class Ensemble:
    """The trees of all domains; as large as rounds times domains."""

    domain: tuple[str, ...]
    features: tuple[str, ...]
    numbers: list[tuple]
    edges: np.ndarray
    start: np.ndarray
    trees: list[Tree]

    def predict(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The keys and ``yhat``, one row per row; NULL in a domain without training rows."""
        numbered = _numbered(rows, self.domain, self.numbers)
        values = [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(self.features)]
        wanted = numbered.select(*keys, "_domain", *values)
        edges, start, trees, width = self.edges, self.start, self.trees, len(self.features)

        def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                domain = batch.column("_domain").to_numpy(zero_copy_only=False).astype(np.float64)
                known = ~np.isnan(domain)
                number = domain[known].astype(np.int64)
                found = binned(_matrix(batch, width)[known], number, edges)
                yhat = start[number] if len(start) else np.zeros(0)
                for tree in trees:
                    yhat = yhat + tree.predict(number, found)
                column = np.zeros(batch.num_rows)
                column[known] = yhat
                kept = [batch.column(name) for name in keys]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(column, mask=~known)], names=[*keys, "yhat"]
                )

        kinds = dict(wanted.dtypes)
        schema = ", ".join([*[f"`{name}` {kinds[name]}" for name in keys], "yhat double"])
        return wanted.mapInArrow(scored, schema)


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    columns = [batch.column(f"_x{i}").to_numpy(zero_copy_only=False) for i in range(width)]
    return np.column_stack(columns).astype(np.float64)


def _numbered(rows: DataFrame, domain: Sequence[str], numbers: list[tuple]) -> DataFrame:
    """With the number of each row's domain, NULL where it has none; NULL names equal each other."""
    kinds = dict(rows.dtypes)
    schema = ", ".join([*[f"_d{i} {kinds[name]}" for i, name in enumerate(domain)], "_domain int"])
    given = literal_table(rows.sparkSession, [(*names, i) for i, names in enumerate(numbers)], schema)
    same = F.lit(True)
    for i, name in enumerate(domain):
        same = same & F.col(name).eqNullSafe(F.col(f"_d{i}"))
    return rows.join(given, same, "left").drop(*[f"_d{i}" for i in range(len(domain))])


def _blocks(staged: DataFrame, edges: np.ndarray, start: np.ndarray, unit: np.ndarray, width: int) -> RDD:
    """The staged rows as numpy blocks, their residuals in whole units."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            domain = batch.column("_domain").to_numpy().astype(np.int32)
            bins = binned(_matrix(batch, width), domain, edges)
            residual = batch.column("_y").to_numpy() - start[domain]
            residual = np.rint(residual / unit[domain]) * unit[domain]
            key = batch.column("_key").to_numpy()
            parts = [domain.tobytes(), bins.tobytes(), residual.tobytes(), key.tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.binary()) for part in parts], names=list("dbrk"))

    def unpacked(row) -> Block:
        return (
            np.frombuffer(row.d, np.int32),
            np.frombuffer(row.b, np.uint8).reshape(-1, width),
            np.frombuffer(row.r, np.float64),
            np.frombuffer(row.k, np.int64),
        )

    return staged.mapInArrow(packed, "d binary, b binary, r binary, k binary").rdd.map(unpacked)


def fit(
    rows: DataFrame, domain: Sequence[str], features: Sequence[str], label: str, key: Sequence[str],
    settings: Settings = Settings(),
) -> Ensemble:
    """Trees for every domain of ``rows``; rows without a label do not count.

    ``key`` names a row when rows are sampled: rows with one key are taken or left together.
    """
    if not 2 <= settings.bins <= 254:
        raise ValueError("2 to 254 bins")
    known = rows.filter(F.col(label).isNotNull() & ~F.isnan(label))
    width = len(features)
    shares = [i / settings.bins for i in range(1, settings.bins)]
    values = [F.nanvl(F.col(f).cast("double"), F.lit(None)) for f in features]
    profile = known.groupBy(*domain).agg(
        F.avg(label).alias("_mean"), F.count(F.lit(1)).alias("_n"),
        F.min(label).alias("_low"), F.max(label).alias("_high"),
        *[F.percentile_approx(value, shares).alias(f"_e{i}") for i, value in enumerate(values)],
    )
    found = sorted(profile.collect(), key=lambda row: str([row[name] for name in domain]))
    numbers = [tuple(row[name] for name in domain) for row in found]
    edges = np.full((len(found), width, settings.bins - 1), np.inf)
    for number, row in enumerate(found):
        for i in range(width):
            own = np.unique(np.array(row[f"_e{i}"] or [], float))
            edges[number, i, : len(own)] = own
    start = np.array([row["_mean"] for row in found], float)
    spread = np.array([max(row["_high"] - row["_low"], 1e-200) * 4.0 * row["_n"] for row in found], float)
    # a power of two, so that a domain's residuals sum up exactly in a double
    unit = 2.0 ** (np.ceil(np.log2(spread)) - EXACT_BITS)
    start = np.rint(start / unit) * unit
    model = Ensemble(tuple(domain), tuple(features), numbers, edges, start, [])
    if not found:
        return model

    staged = cut_lineage(
        _numbered(known, domain, numbers).select(
            "_domain", F.col(label).cast("double").alias("_y"), F.xxhash64(*key).alias("_key"),
            *[value.alias(f"_x{i}") for i, value in enumerate(values)],
        )
    )
    tasks = -(-sum(row["_n"] for row in found) // ROWS_PER_TASK)
    blocks = _blocks(staged, edges, start, unit, width).coalesce(tasks).persist(StorageLevel.MEMORY_AND_DISK)
    pending: list[Tree] = []
    for round_number in range(settings.rounds):
        tree = grow(blocks, pending, round_number, unit, settings)
        model.trees.append(tree)
        pending.append(tree)
        if len(pending) == KEPT_EVERY:
            stepped = _stepped(blocks, pending).persist(StorageLevel.MEMORY_AND_DISK)
            stepped.count()
            blocks.unpersist()
            blocks, pending = stepped, []
    blocks.unpersist()
    return model
