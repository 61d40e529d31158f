"""Near-duplicate lines by a segment-partition edit join, in DataFrame operations only.

Two lines are linked when their edit distance is at most ``threshold``.  Cutting a line into
threshold + 1 segments leaves at least one segment intact under that many edits, at a place
shifted by no more edits than the segments before and after it allow.  So every line enters
an index under (its length, segment number, segment), and every line probes, for each length
from its own down to ``threshold`` less, the few substrings that could be such a segment.
Candidates that also agree in letter counts (an edit changes at most two counts by one) are
verified with a banded bit-parallel edit distance.  Classes are components of the links.

Keys of many lines (found on a share of the lines; which keys they are changes no result) leave
that index.  Their lines are cut into more pieces, and meet if they agree outside ``threshold``
of these: any lines within the threshold do, and few others.  A line has such keys only for the
differences in length for which it has a common one, 54 at most (at threshold 2).

Equal lines are one line from the start, combined map-side, so a line repeated a million
times is one row in the index.  The texts of candidate lines are fetched by a second scan
behind a bitmap of fixed size (``filter_bits``), not by shuffling all lines.

Lines are the parts between line feeds, trimmed of blanks; lines of fewer than ``shortest``
characters are left alone.  Lines too short for the segments (fewer than 11 characters at
threshold 2) are one line only if they are equal.  Lines are identified by two 64-bit hashes.
``WHOLE`` takes in every line that is not empty; the query and the pipeline use it.

Defined results: NULL and empty texts have no lines; rows with NULL ``doc_id`` are left alone;
a document's first line wins over later copies, ties in ``doc_id, line`` order.  Rows of
one ``doc_id`` are told apart by their texts' hash; equal ones share their lines.  Very long lines take part whole.  Columns of
other names are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensoria.llm.graph import components
from sensoria.session import cut_lineage


@dataclass
class Settings:
    threshold: int = 2
    shortest: int = 16
    letters: str = "etnaihso"
    filter_bits: int = 22
    pieces: int = 5
    counted: int = 4  # one line in so many is counted to find keys of many lines
    common: int = 4  # counted lines that make a key one of these

    @property
    def joined(self) -> int:
        """Shortest line with segments longer than the threshold, ``threshold`` edits aside."""
        return (self.threshold + 1) ** 2 + self.threshold


WHOLE = Settings(shortest=1)


def _segment(length: Column, number: int, parts: int) -> tuple[Column, Column]:
    """First character (from 1) and length of a segment."""
    start = F.floor(length * number / parts)
    return start + 1, F.floor(length * (number + 1) / parts) - start


def _key(line: Column, length: Column, number: int, start: Column, size: Column) -> Column:
    return F.xxhash64(F.lit(number), length, F.substring(line, start.cast("int"), size.cast("int")))


def index_keys(line: Column, length: Column, threshold: int) -> Column:
    """Keys of a line's own segments."""
    parts = threshold + 1
    return F.array(*[_key(line, length, i, *_segment(length, i, parts)) for i in range(parts)])


def probe_keys(line: Column, length: Column, threshold: int, shorter: int) -> Column:
    """Keys of the substrings that may be a segment of a line ``shorter`` characters less.

    Segment i may be shifted by at most i edits before it and threshold - i after it.  Segments
    longer than the threshold make every such substring lie within the line.  The line's own
    segments, which are keys for lines of its length, are left to :func:`index_keys`.
    """
    parts, target = threshold + 1, length - shorter
    keys = []
    for i in range(parts):
        start, size = _segment(target, i, parts)
        for shift in range(max(-i, shorter - (threshold - i)), min(i, shorter + threshold - i) + 1):
            if shorter or shift:
                keys.append(_key(line, target, i, start + shift, size))
    return F.array(*keys).cast("array<bigint>")


def _shifts(holes: int, edits: int, shorter: int, before: int = 0) -> list[tuple[int, ...]]:
    """Shifts behind each hole that ``edits`` edits inside the holes can make, ``shorter`` at the end."""
    if not holes:
        return [()] if before == shorter else []
    return [
        (shift, *rest)
        for shift in range(before - edits, before + edits + 1)
        for rest in _shifts(holes - 1, edits - abs(shift - before), shorter, shift)
    ]


def _layouts(s: Settings, shorter: int) -> list[Column]:
    """Choices of ``threshold`` pieces as holes, and of shifts behind them.

    Holes side by side are one hole: it does not matter what is shifted inside.  Of two lines of one
    length the one shifted to the right probes.  Of holes side by side the first is compared where it
    begins, the last where it ends; ``any`` marks holes that need not differ: all pieces before them are
    holes, or others of their kind lie on both sides.
    """
    found = []
    for holes in combinations(range(s.pieces), s.threshold):
        last = s.threshold - 1
        more = [k < last and holes[k + 1] == holes[k] + 1 for k in range(s.threshold)]
        known = set()
        for free in _shifts(s.threshold, s.threshold, shorter):
            shifts = []
            for k, shift in enumerate(free):
                shifts.append((shifts[-1] if shifts else 0) if more[k] else shift)
            if tuple(shifts) in known or (not shorter and next((x for x in shifts if x), 0) < 0):
                continue
            known.add(tuple(shifts))
            begin, end, free_of = [], [], []
            for k, shift in enumerate(shifts):
                inner, before = k > 0 and more[k - 1], shifts[k - 1] if k else 0
                begin.append(shift if inner else before)
                end.append(before if more[k] and not inner else shift)
                free_of.append(holes[k] == k or (inner and more[k]))
            arrays = {"holes": holes, "shifts": shifts, "begin": begin, "end": end, "any": free_of}
            found.append(F.struct(
                F.lit(shorter).alias("less"), F.lit(not shorter and not any(shifts)).alias("own"),
                *[F.array(*map(F.lit, values)).alias(name) for name, values in arrays.items()],
            ))
    return found


def piece_rows(lines: DataFrame, s: Settings) -> DataFrame:
    """``lines`` with a ``key`` of what each has outside ``threshold`` pieces of a line ``less``
    characters less, for all choices of the pieces, the holes.

    Bit ``less`` of ``roles`` asks for these rows.  ``own`` keys are those of the line's own pieces.
    Edits inside the holes shift what follows.  ``hole<k>`` is a hash of what hole k has.
    """
    layouts = F.array(*[layout for less in range(s.threshold + 1) for layout in _layouts(s, less)])
    asked = F.filter(
        layouts,
        lambda at: (F.call_function("shiftright", F.col("roles"), at["less"]).bitwiseAND(F.lit(1)) == 1)
        & (F.length("content") - at["less"] >= s.joined),
    )
    at = F.col("_at")
    target = F.length("content") - at["less"]
    edge = lambda piece: F.floor(target * piece / s.pieces)

    def part(begin: Column, end: Column) -> Column:
        return F.substring(F.col("content"), (begin + 1).cast("int"), (end - begin).cast("int"))

    kept, cut, start, shift = [], [], F.lit(0), F.lit(0)
    for k in range(s.threshold):
        hole = at["holes"][k]
        kept.append(part(start, edge(hole) + shift))
        shift = at["shifts"][k]
        start = edge(hole + 1) + shift
        held = part(edge(hole) + at["begin"][k], edge(hole + 1) + at["end"][k])
        cut += [F.xxhash64(held).alias(f"hole{k}"), at["any"][k].alias(f"any{k}")]
    kept.append(part(start, F.length("content")))
    return lines.withColumn("_at", F.explode(asked)).select(
        "*", at["less"].alias("less"), at["own"].alias("own"), F.xxhash64(at["holes"], target, *kept).alias("key"), *cut
    ).drop("_at", "content", "roles")


def letter_counts(line: Column, letters: str) -> Column:
    """Counts of up to eight letters, modulo 256, packed into one number."""
    packed = F.lit(0).cast("long")
    for place, letter in enumerate(letters[:8]):
        count = (F.octet_length(line) - F.octet_length(F.replace(line, F.lit(letter), F.lit("")))) / len(letter.encode())
        packed = packed.bitwiseOR(F.shiftleft(F.pmod(count.cast("long"), F.lit(256)), 8 * place))
    return packed


def count_distance(a: Column, b: Column) -> Column:
    """Sum of the differences of packed letter counts; never more than the true sum."""
    total = F.lit(0).cast("long")
    for place in range(8):
        one = F.abs(
            F.shiftright(a, 8 * place).bitwiseAND(F.lit(255)) - F.shiftright(b, 8 * place).bitwiseAND(F.lit(255))
        )
        total = total + F.least(one, F.lit(256) - one)
    return total


def banded_distance(a: Column, b: Column, threshold: int) -> Column:
    """Edit distance of lines whose lengths differ by at most ``threshold``, if it is at most that.

    Bit t of a word stands for the cell ``2 * threshold`` diagonals wide around the main one:
    row ``column - threshold + t``.  Vertical differences are kept as two words and move one
    bit down with every column.  The sum follows the lowest diagonal; at the end the vertical
    differences below the last row are taken off.  Larger distances give a number above the
    threshold.  Common beginnings and ends are cut off first.
    """
    width = 2 * threshold + 1
    full = (1 << width) - 1
    word = lambda value: F.lit(value).cast("long")

    def column(state: Column, match: Column) -> Column:
        p, n = state["p"], state["n"]
        carried = ((match.bitwiseAND(p) + p).bitwiseXOR(p)).bitwiseOR(match).bitwiseOR(n)

        def following(d: Column) -> Column:
            up = n.bitwiseOR(F.bitwise_not(d.bitwiseOR(p)))
            below = F.shiftright(d, 1)
            return F.struct(
                d.bitwiseAND(p).bitwiseOR(F.bitwise_not(below.bitwiseOR(up))).bitwiseAND(word(full)).alias("p"),
                below.bitwiseAND(up).bitwiseAND(word(full)).alias("n"),
                (state["d"] + 1 - F.shiftright(d, width - 1)).alias("d"),
            )

        return _bound(carried.bitwiseAND(word(full)), following)

    def solved(pair: Column) -> Column:
        left, right = pair["left"], pair["right"]

        def matches(char: Column, at: Column) -> Column:
            bits = [
                F.when(F.get(left, at - threshold + t).eqNullSafe(char), word(1 << t)).otherwise(word(0))
                for t in range(width)
            ]
            out = bits[0]
            for bit in bits[1:]:
                out = out.bitwiseOR(bit)
            return out

        start = F.struct(
            word(full - ((1 << threshold) - 1)).alias("p"), word(0).alias("n"), word(threshold).alias("d")
        )
        shift = (F.size(left) - F.size(right) + threshold).cast("int")
        below = word((1 << (2 * threshold)) - 1).bitwiseAND(
            F.bitwise_not(F.call_function("shiftleft", word(1), shift) - 1)
        )
        return F.aggregate(
            F.transform(right, matches), start, column,
            lambda end: end["d"]
            - F.bit_count(end["p"].bitwiseAND(below)) + F.bit_count(end["n"].bitwiseAND(below)),
        )

    def cut(rest: Column) -> Column:
        one, other = rest["one"], rest["other"]
        chars = F.struct(F.split(one, "").alias("left"), F.split(other, "").alias("right"))
        return (
            F.when(one == "", F.length(other).cast("long"))
            .when(other == "", F.length(one).cast("long"))
            .otherwise(_bound(chars, solved))
        )

    return _bound(_differing(a, b), cut)


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _differing(a: Column, b: Column) -> Column:
    """Both lines without most of what they begin and end with in common (struct one, other).

    Equal beginnings of a half, a quarter, ... of the shorter line are cut off in turn, then
    equal ends; that changes no edit distance.
    """
    steps = F.array(*[F.lit(i) for i in range(1, 9)])

    def halving(at_end: bool):
        def step(state: Column, i: Column) -> Column:
            size = F.call_function("shiftright", state["size"], i)

            def taken(text: Column) -> Column:
                return F.right(text, size) if at_end else F.left(text, size)

            def kept(text: Column) -> Column:
                return F.left(text, F.length(text) - size) if at_end else F.substring(text, size + 1, F.length(text))

            same = taken(state["one"]) == taken(state["other"])
            return F.when(same, _pair(kept(state["one"]), kept(state["other"]), state["size"])).otherwise(state)

        return step

    ahead = F.aggregate(steps, _pair(a, b, F.least(F.length(a), F.length(b))), halving(False))
    fresh = _bound(ahead, lambda s: _pair(s["one"], s["other"], F.least(F.length(s["one"]), F.length(s["other"]))))
    return F.aggregate(steps, fresh, halving(True))


def _pair(one: Column, other: Column, size: Column) -> Column:
    return F.struct(one.alias("one"), other.alias("other"), size.alias("size"))


def line_rows(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, copy, line, content, size, h1, h2``: every line with its number, trimmed.

    ``copy`` is the whole text's hash.

    The size is taken before the lines become rows, so that it is counted once for each line.
    """
    trimmed = F.transform(F.split(F.col(text), "\n"), lambda part: F.trim(part, F.lit(" \t\r")))
    sized = F.transform(trimmed, lambda part: F.struct(part.alias("content"), F.length(part).alias("size")))
    rows = docs.where(F.col(key).isNotNull()).select(
        F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("copy"), F.posexplode(sized).alias("line", "_part")
    )
    content = F.col("_part.content")
    return rows.select(
        "doc_id", "copy", "line", content.alias("content"), F.col("_part.size").alias("size"),
        F.xxhash64(content).alias("h1"), F.xxhash64(F.lit(1), content).alias("h2"),
    )


def _behind_bitmap(rows: DataFrame, ids: DataFrame, bits: int) -> DataFrame:
    """Rows whose ``h1`` may be among ``ids``: a bitmap of 2^bits bits, one row for 64 bits.

    The bitmap has at most 2^(bits - 6) rows whatever the number of ids, so it is broadcast.
    """
    spot = lambda name: F.col(name).bitwiseAND(F.lit((1 << bits) - 1))
    cell = lambda name: F.shiftright(spot(name), 6)
    bit = lambda name: F.call_function("shiftleft", F.lit(1).cast("long"), spot(name).bitwiseAND(F.lit(63)).cast("int"))
    bitmap = ids.groupBy(cell("id").alias("_cell")).agg(F.bit_or(bit("id")).alias("_bits"))
    return (
        rows.withColumn("_cell", cell("h1")).join(F.broadcast(bitmap), "_cell")
        .where(F.col("_bits").bitwiseAND(bit("h1")) != 0).drop("_cell", "_bits")
    )


def _crowded_pairs(texts: DataFrame, s: Settings, near: Column) -> DataFrame:
    """``a, b``: lines of common keys that agree outside ``threshold`` pieces.

    Lines that differ in fewer pieces agree for many choices of holes; they meet where the holes
    that do not differ are the first pieces there are.
    """
    rows = cut_lineage(piece_rows(texts.where("crowded").select("h1", "counts", "roles", "content"), s))
    anywhere = [f"any{k}" for k in range(s.threshold)]
    index = rows.where("own").select(
        "key", F.col("h1").alias("a"), F.col("counts").alias("ca"), *[f"hole{k}" for k in range(s.threshold)]
    )
    probes = rows.select(
        "key", F.col("h1").alias("b"), F.col("counts").alias("cb"), "less", "own", *anywhere,
        *[F.col(f"hole{k}").alias(f"other{k}") for k in range(s.threshold)],
    )
    wanted = near & ((F.col("a") < F.col("b")) | ((F.col("a") != F.col("b")) & ~F.col("own")))
    for k in range(s.threshold):
        wanted = wanted & ((F.col(f"hole{k}") != F.col(f"other{k}")) | F.col(f"any{k}"))
    turned = (F.col("less") == 0) & (F.col("a") > F.col("b"))
    return index.join(probes, "key").where(wanted).select(
        F.when(turned, F.col("b")).otherwise(F.col("a")).alias("a"),
        F.when(turned, F.col("a")).otherwise(F.col("b")).alias("b"),
    ).distinct()


def line_classes(
    docs: DataFrame, settings: Settings | None = None, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``doc_id, line, class_doc_id, class_line, n_links, kept`` for every line that takes part.

    The class is named by its first line; ``n_links`` counts other texts within the threshold.
    """
    return _classes(docs, settings or Settings(), text, key).drop("copy")


def _classes(docs: DataFrame, s: Settings, text: str, key: str) -> DataFrame:
    """The same with the text's hash as ``copy``."""
    where = ["doc_id", "line", "copy"]
    rows = line_rows(docs, text, key).where(F.col("size") >= s.shortest)
    length = F.col("size")
    keys = [index_keys(F.col("content"), length, s.threshold)]
    keys += [probe_keys(F.col("content"), length, s.threshold, less) for less in range(s.threshold + 1)]
    names = ["own", *[f"probe{less}" for less in range(s.threshold + 1)]]
    facts = F.struct(
        *where, *[F.when(length >= s.joined, key).alias(name) for key, name in zip(keys, names, strict=True)],
    )
    distinct = cut_lineage(
        rows.select("h1", "h2", facts.alias("first")).groupBy("h1", "h2").agg(F.min("first").alias("first"))
        .select("h1", "h2", "first.*")
    )
    index = distinct.select(F.explode("own").alias("key"), F.col("h1").alias("a"))
    probes = None
    for less in range(s.threshold + 1):
        held = F.col(f"probe{less}") if less else F.concat("own", "probe0")
        part = distinct.select(F.explode(held).alias("key"), F.col("h1").alias("b"), F.lit(less).alias("less"))
        probes = part if probes is None else probes.unionAll(part)
    common = cut_lineage(
        index.where(F.pmod("a", F.lit(s.counted)) == 0).groupBy("key").agg(F.count("*").alias("n"))
        .where(F.col("n") >= s.common).select("key")
    )
    other = (F.col("a") < F.col("b")) | ((F.col("a") != F.col("b")) & (F.col("less") > 0))
    pairs = cut_lineage(
        index.join(common, "key", "left_anti").join(probes, "key").where(other).select("a", "b").distinct()
    )
    # bit ``less``: the line may be one of a pair of that difference in length that common keys would have found
    crowd = probes.join(common, "key", "left_semi").select(
        F.col("b").alias("id"), F.call_function("shiftleft", F.lit(1), F.col("less")).alias("roles")
    )
    ids = (
        pairs.select(F.explode(F.array("a", "b")).alias("id"), F.lit(0).alias("roles"))
        .unionAll(crowd).groupBy("id").agg(F.bit_or("roles").alias("roles"))
    )
    ids = cut_lineage(ids)
    texts = cut_lineage(
        _behind_bitmap(rows, ids, s.filter_bits).join(ids.withColumnRenamed("id", "h1"), "h1")
        .groupBy("h1", "h2").agg(F.min(F.struct(*where, "content")).alias("t"), F.bit_or("roles").alias("roles"))
        .select("h1", F.struct(*[f"t.{name}" for name in where]).alias("node"), "t.content", "roles", (F.col("roles") != 0).alias("crowded"))
        .withColumn("counts", letter_counts(F.col("content"), s.letters))
    )
    near = count_distance(F.col("ca"), F.col("cb")) <= 2 * s.threshold
    pairs = pairs.unionAll(_crowded_pairs(texts, s, near)).distinct()
    one = texts.select(F.col("h1").alias("a"), F.col("node").alias("node_a"), F.col("content").alias("text_a"), F.col("counts").alias("ca"))
    two = texts.select(F.col("h1").alias("b"), F.col("node").alias("node_b"), F.col("content").alias("text_b"), F.col("counts").alias("cb"))
    links = cut_lineage(
        pairs.join(one, "a").join(two, "b").where(near)
        .where(F.abs(F.length("text_a") - F.length("text_b")) <= s.threshold)
        .where(banded_distance(F.col("text_a"), F.col("text_b"), s.threshold) <= s.threshold)
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))
    )
    degree = (
        links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links"))
    )
    classes = components(links).join(degree, "node").select(*[f"node.{name}" for name in where], "component", "n_links")
    named = distinct.select("h1", "h2", *where).join(classes, where, "left").select(
        "h1", "h2", F.coalesce("component", F.struct(*where)).alias("class"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )
    return rows.select(*where, "h1", "h2").join(named, ["h1", "h2"]).select(
        "doc_id", "line", F.col("class.doc_id").alias("class_doc_id"), F.col("class.line").alias("class_line"),
        "n_links", (F.struct(*where) == F.col("class")).alias("kept"), "copy",
    )


def drop_repeated_lines(
    docs: DataFrame, settings: Settings | None = None, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``docs`` without lines that repeat an earlier one; documents left blank by that go.

    Documents that lose nothing, NULL texts among them, stay as they are.  ``n_chars``, where
    present, is counted anew.
    """
    dropped = (
        _classes(docs, settings or WHOLE, text, key).where("NOT kept").groupBy(F.col("doc_id").alias("_id"), "copy")
        .agg(F.collect_set("line").alias("_dropped"))
    )
    # the row travels as one column, so that no name of its can clash
    rows = docs.select(F.col(key).alias("_id"), F.xxhash64(F.col(text)).alias("copy"), F.struct("*").alias("row"))
    joined = rows.join(dropped, ["_id", "copy"], "left")
    whole, untouched = F.col("row")[text], F.col("_dropped").isNull()
    left = F.filter(F.split(whole, "\n"), lambda _, at: ~F.array_contains(F.col("_dropped"), at))
    joined = joined.withColumn("left", F.when(untouched, whole).otherwise(F.array_join(left, "\n")))
    kept = joined.where(untouched | (F.trim(F.col("left"), F.lit(" \t\r\n")) != ""))
    out = {text: F.col("left")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(untouched, F.col("row")["n_chars"]).otherwise(F.length("left").cast("long"))
    return kept.select(*[out.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def op2_line_dedup(spark, folder: str) -> DataFrame:
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    return line_classes(docs, WHOLE)
