import re
from collections import Counter

import numpy as np
import pytest
from cases import awkward, clashing, empty, rows_of

from sensoria.llm import collocations as co

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, s):
    """rows: text, lang."""
    counts = {}
    for text, lang in rows:
        held = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            for size in range(1, s.depth + 1):
                held.update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, held in counts.items():
        n = sum(c for phrase, c in held.items() if len(phrase) == 1)
        candidates = {p: c for p, c in held.items() if len(p) > 1 and c >= s.min_count}
        longer, left, right = Counter(), Counter(), Counter()
        for p, c in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    longer[p[i : i + size]] = max(longer[p[i : i + size]], c)
            left[p[1:]] += 1
            right[p[:-1]] += 1
        rows = []
        for p, a in candidates.items():
            if p in longer and 100 * longer[p] >= s.covered_percent * a:
                continue
            cuts = [(1000 * a * n // (held[p[:k]] * held[p[k:]]), k) for k in range(1, len(p))]
            best, k = min(cuts)
            rows.append((-best, -a, " ".join(p).encode(), held[p[:k]], held[p[k:]], left[p], right[p]))
        for rank, (best, a, phrase, l, r, x, y) in enumerate(sorted(rows)[: s.top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -best, x, y))
    return sorted(out, key=repr)


def texts(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


@pytest.mark.parametrize("shard_words", [1, 300, 1 << 20])
def test_awkward_rows(spark, shard_words):
    s = co.Settings(min_count=2, shard_words=shard_words, top=50)
    docs = awkward(spark).where("doc_id IS NULL OR doc_id <> 7") if shard_words == 1 else awkward(spark)
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert rows_of(co.collocations(clashing(docs), s)) == brute(rows, s)


def test_random_texts_at_every_depth(spark):
    rng = np.random.default_rng(5)
    words = ["a", "B", "ab", "ä", "Ä", "\x00", "x\x1fy", "ß", "c"]
    marks = [" ", " ", " ", "  ", "\t", ". ", "\n", "\x0b", ", ", "?!"]
    rows = []
    for i in range(120):
        size = rng.integers(0, 60)
        picks = zip(rng.choice(len(words), size), rng.choice(len(marks), size), strict=True)
        rows.append(("".join(words[w] + marks[m] for w, m in picks), [None, "x", "und", "y"][i % 4]))
    docs = texts(spark, rows)
    for depth, percent in ((2, 100), (3, 100), (5, 100), (5, 80)):
        s = co.Settings(depth=depth, min_count=5, top=10_000, covered_percent=percent, shard_words=90)
        assert rows_of(co.collocations(docs, s)) == brute(rows, s)


def test_full_bitmaps_change_nothing(spark):
    rows = [(f"a b c d e f {i % 3} g h, a b c", "x") for i in range(40)]
    s = co.Settings(min_count=10)
    wanted = brute(rows, s)
    assert rows_of(co.collocations(texts(spark, rows), s)) == wanted
    co_full = co.Settings(min_count=10, max_bits=6)
    assert rows_of(co.collocations(texts(spark, rows), co_full)) == wanted


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = [(r.text, r.lang) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    found = rows_of(co.op11_collocations(spark, folder))
    assert found == brute(rows, co.Settings()) and len(found) > 10


def test_index_counts_left_and_right():
    rng = np.random.default_rng(3)
    ids = np.concatenate([[0], rng.integers(0, 6, 400), [0]]).astype(np.int32)
    index = co.Index(ids, 6, 5)
    plain = [Counter(tuple(ids[i : i + k]) for i in range(len(ids) - k + 1)) for k in range(6)]
    for steps in ("rlrl", "rrrr", "llll", "lrrl"):
        phrases = index.words
        for k, step in enumerate(steps, 2):
            phrases = index.right(phrases) if step == "r" else index.left(phrases)
            found = {tuple(int(x) for x in p): int(c) for p, c in zip(phrases[0], phrases[3], strict=True)}
            assert found == {p: c for p, c in plain[k].items() if 0 not in p}


def test_chunks_of_words_change_nothing():
    rng = np.random.default_rng(4)
    ids = np.concatenate([[0], rng.integers(0, 9, 600), [0]]).astype(np.int32)
    found = []
    for at_once in (1, 50, 1 << 17):
        held = Counter()
        for phrases, counts in co.enumerate_phrases(ids, 9, 4, at_once=at_once):
            for p, c in zip(phrases, counts, strict=True):
                held[tuple(int(x) for x in p)] += int(c)
        found.append(held)
    assert found[0] == found[1] == found[2] and found[0]


def test_score_beyond_64_bits_and_empty(spark):
    from pyspark.sql import functions as F

    a, n, left, right = 3 * 10**12, 7 * 10**13, 5 * 10**12, 4 * 10**12
    row = spark.range(1).select(co.score(*[F.lit(x) for x in (a, n, left, right)]).alias("s")).first()
    assert row.s == 1000 * a * n // (left * right)
    assert co.collocations(empty(spark)).count() == 0
    assert co.collocations(texts(spark, [(None, None), ("", "x")])).count() == 0
