"""Document fingerprints: Merkle trees over paragraphs and sections.

A text is cut into paragraphs (lines with their line feeds); paragraphs longer than
``Settings.longest`` bytes are cut further at content-defined blanks, so that an edit moves no
far cut.  A leaf is the hash of a paragraph's bytes.  Leaves form sections, ended by a leaf
whose hash is divisible by ``Settings.section``, so that sections, too, survive edits
elsewhere.  A section's hash covers its leaves, the root covers the sections.

The fingerprint is text: ``root|section:leaf.size,leaf.size;section:leaf.size``.  Roots test
equality; sections and leaves that differ locate an edit.  The likeness of two fingerprints
is the share of bytes in leaves that both hold (Dice coefficient of the leaf multisets).

Defined results: NULL texts count as empty; an empty text has a root without sections, and two
empty texts are fully alike.  Equal texts have equal fingerprints.  Whole texts are read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensoria.llm.words import raw, small_batches, tidied


@dataclass
class Settings:
    longest: int = 64
    section: int = 8
    leaf_bytes: int = 4
    root_bytes: int = 16


def _digest(data: bytes, size: int) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


def leaves(text: bytes, s: Settings) -> list[bytes]:
    """Parts whose concatenation is the text."""
    out = []
    for paragraph in _lines(text):
        if len(paragraph) <= s.longest:
            out.append(paragraph)
            continue
        start = 0
        words = paragraph.split(b" ")
        at, held = 0, 0
        for word in words[:-1]:
            at += len(word) + 1
            held += len(word) + 1
            # a cut after a blank whose word asks for it, once a third of the length is reached
            if held * 3 >= s.longest and (not (len(word) + word[-1] if word else 0) % 4 or held >= 4 * s.longest):
                out.append(paragraph[start:at])
                start, held = at, 0
        out.append(paragraph[start:])
    return [part for part in out if part]


def _lines(text: bytes) -> list[bytes]:
    parts = text.split(b"\n")
    return [part + b"\n" for part in parts[:-1]] + parts[-1:]


def tree(text: bytes, s: Settings) -> tuple[bytes, list[tuple[bytes, list[tuple[bytes, int]]]]]:
    """Root hash and sections (hash, leaves as hash and size)."""
    sections: list[tuple[bytes, list[tuple[bytes, int]]]] = []
    held: list[tuple[bytes, int]] = []
    for part in leaves(text, s):
        leaf = _digest(part, s.root_bytes)
        held.append((leaf, len(part)))
        if leaf[-1] % s.section == 0:
            sections.append((_digest(b"s" + b"".join(x for x, _ in held), s.root_bytes), held))
            held = []
    if held:
        sections.append((_digest(b"s" + b"".join(x for x, _ in held), s.root_bytes), held))
    root = _digest(b"r" + b"".join(x for x, _ in sections), s.root_bytes)
    return root, sections


def fingerprint(text: bytes | None, s: Settings) -> str:
    root, sections = tree(text or b"", s)
    short = s.leaf_bytes
    return root.hex() + "|" + ";".join(
        name[:short].hex() + ":" + ",".join(f"{leaf[:short].hex()}.{size:x}" for leaf, size in held)
        for name, held in sections
    )


def parsed(mark: str) -> Counter:
    """Leaves of a fingerprint: bytes held under each leaf hash and size."""
    body = mark.partition("|")[2]
    found: Counter = Counter()
    for section in body.split(";") if body else []:
        for leaf in section.partition(":")[2].split(","):
            found[leaf] += int(leaf.partition(".")[2], 16)
    return found


def likeness(one: str, other: str) -> float:
    """Share of bytes in common leaves, 0 to 1; 1 for equal roots."""
    if one.partition("|")[0] == other.partition("|")[0]:
        return 1.0
    a, b = parsed(one), parsed(other)
    total = sum(a.values()) + sum(b.values())
    return 2 * sum((a & b).values()) / total if total else 1.0


def edits(one: str, other: str) -> tuple[list[int], list[int]]:
    """Numbers of the leaves of either fingerprint that the other one lacks."""
    out = []
    for mine, theirs in ((one, other), (other, one)):
        left, missing = parsed(theirs), []
        order = [x for sec in mine.partition("|")[2].split(";") if sec for x in sec.partition(":")[2].split(",")]
        for number, leaf in enumerate(order):
            size = int(leaf.partition(".")[2], 16)
            if left[leaf] >= max(size, 1):
                left[leaf] -= size
            else:
                missing.append(number)
        out.append(missing)
    return out[0], out[1]


def fingerprints(docs: DataFrame, settings: Settings | None = None, text: str = "text") -> DataFrame:
    """``docs`` with a ``fingerprint`` of every whole text."""
    s = settings or Settings()
    small_batches(docs.sparkSession)

    @F.arrow_udf("string")
    @tidied
    def mark(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([fingerprint(t, s) for t in raw(batch)], pa.string())

    return docs.withColumn("fingerprint", mark(F.col(text)))


def with_next(docs: DataFrame, partitions: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, text, slot, extra`` dealt into ranges of keys, each range in one partition, in order.

    Ordering is by key, then text; every range also holds a copy of the first row of the next
    range (``extra`` = 1) at its end, the last range that of the first range.  So each row's
    successor is the row after it, and texts are shuffled once.
    """
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    slots = 3 * partitions
    wanted = [i / slots for i in range(1, slots)]
    found = rows.agg(F.percentile_approx("doc_id", wanted, 10 * slots).alias("e")).first()["e"]
    rows = rows.withColumn("slot", _slot(F.col("doc_id"), sorted(set(found or []))))
    firsts = rows.groupBy("slot").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("null"))
    firsts = {row["slot"]: None if row["null"] else row["first"] for row in firsts.collect()}
    order = sorted(firsts)
    last = order[-1] if order else 0
    first = F.lit([firsts.get(i) for i in range(last + 1)]).cast(f"array<{dict(rows.dtypes)['doc_id']}>")
    before = {slot: order[i - 1] for i, slot in enumerate(order)}
    back = F.get(F.lit([before.get(i, 0) for i in range(last + 1)]), F.col("slot"))
    # several rows may share the first key: all are copied, and sorting finds the first of them
    opens = F.col("doc_id").eqNullSafe(F.get(first, F.col("slot")))
    places = F.array_compact(F.array(
        F.struct(F.col("slot").alias("slot"), F.lit(0).alias("extra")),
        F.when(opens, F.struct(back.alias("slot"), F.lit(1).alias("extra"))),
    ))
    return (
        rows.withColumn("place", F.explode(places)).select("doc_id", "text", "place.slot", "place.extra")
        .repartition(partitions, "slot").sortWithinPartitions("slot", "extra", "doc_id", "text")
    )


def _slot(value: Column, edges: list) -> Column:
    """Number of edges below a value, found in two steps of about the square root each; 0 for NULL."""
    if not edges:
        return F.lit(0)
    width = max(1, int(len(edges) ** 0.5))
    groups = [edges[i : i + width] for i in range(0, len(edges), width)]
    below = lambda held: F.size(F.filter(held, lambda edge: edge < value))
    group = below(F.lit([held[-1] for held in groups[:-1]])) if len(groups) > 1 else F.lit(0)
    slot = group * width + below(F.get(F.lit(groups), group))
    return F.when(value.isNull(), 0).otherwise(slot)


def edited_fingerprints(docs: DataFrame, settings: Settings | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each text against itself with its last quarter replaced by the next text's beginning."""
    s = settings or Settings()
    spark = small_batches(docs.sparkSession)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = dict(docs.dtypes)[key]

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # row waiting for its successor: doc_id, text, slot, fingerprint

        def finish(row, after, mark):
            doc_id, own, _, one = row
            quarter = len(own) // 4
            changed = own[: len(own) - quarter] + after[:quarter]
            data = changed.encode()
            two = fingerprint(data, s)
            return (
                doc_id, len(own), hashlib.sha256(data).hexdigest(), one, two,
                likeness(one, two), likeness(one, mark),
            )

        for batch in batches:
            out = []
            for doc_id, own, slot, extra in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if extra and held is None:
                    continue
                mark = fingerprint(own.encode(), s)
                if held is not None and held[2] == slot:
                    out.append(finish(held, own, mark))
                held = None if extra else (doc_id, own, slot, mark)
            columns = list(zip(*out, strict=True)) if out else [()] * 7
            kinds = [batch.schema.field(0).type, pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return with_next(docs, partitions, text, key).mapInArrow(
        run,
        f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def op9_fingerprints(spark, folder: str) -> DataFrame:
    return edited_fingerprints(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"))
