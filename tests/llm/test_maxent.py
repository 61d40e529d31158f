import math
import zlib
from collections import Counter

import numpy as np
from cases import ROWS, awkward, clashing, empty
from pyspark.sql import functions as F

from sensoria.llm import maxent
from sensoria.llm.words import mix

FOLDER = "/root/testdata/sf0.01"


def test_base_counts_and_held_out_gain(spark):
    found = maxent.op8_maxent(spark, FOLDER).toPandas().set_index("doc_id")
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    tokens = {r.doc_id: [*(r.text or "").encode().lower().split(), None] for r in rows}
    counts = Counter()
    for doc, words in tokens.items():
        if zlib.crc32(str(doc).encode()) % 7 != 2:
            counts.update(words)
    total, kinds = sum(counts.values()), len(counts)
    for doc, words in tokens.items():
        row = found.loc[doc]
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in words)
        assert math.isclose(row.base_score, base, rel_tol=1e-9)
        assert row.n_tokens == len(words) and row.n_known == sum(counts[w] > 0 for w in words)
        assert row.train_tokens == total
    held = found[found.held_out]
    assert (held.score > held.base_score).mean() > 0.9
    assert held.score.sum() / held.n_tokens.sum() > held.base_score.sum() / held.n_tokens.sum() + 0.1


def test_probabilities_sum_to_one(spark):
    docs = spark.createDataFrame([(i, f"a b{i % 3} c d{i % 5} a", False) for i in range(40)], "doc_id long, text string, held_out boolean")
    s = maxent.Settings(own_classes=2, form_classes=3, row_bits=6)
    counts = maxent.count_words(docs).cache()
    vocabulary = maxent.vocabulary_of(counts, 40, s)
    model = maxent.train(docs, vocabulary, s)
    words = [b"a", b"c", *[b"b%d" % i for i in range(3)], *[b"d%d" % i for i in range(5)]]
    table = maxent.WordTable(maxent._features(vocabulary))

    def chance(text, count):
        t = maxent.tokens_of([text], table, vocabulary, s)
        gain = maxent.gains(model, t)
        at = len(text.split()) - 1 if text.split() else 0
        return 10 ** (gain[at] + math.log10((count + 1) * vocabulary.unseen))

    number = {r["hash"]: r["count"] for r in counts.collect()}
    for before in (b"", b"a ", b"a b1 ", b"zz c "):
        total = vocabulary.unseen
        for word in words:
            total += chance(before + word, number[int(maxent.hash_words([word]).view(np.int64)[0])])
        t = maxent.tokens_of([before.strip()], table, vocabulary, s)
        total += 10 ** (maxent.gains(model, t)[-1] + math.log10(41 * vocabulary.unseen))
        assert math.isclose(total, 1, rel_tol=1e-5)


def test_small_head_gives_the_same(spark):
    docs = awkward(spark).withColumn("held_out", F.lit(False))
    many = maxent.score(docs).collect()
    few = maxent.score(docs, maxent.Settings(head=2)).collect()
    base = lambda rows: sorted((r.doc_id or 0, round(r.base_score, 6), r.n_known) for r in rows)
    assert base(many) == base(few)


def test_steps_equal_the_plain_formulas():
    """Parts of a batch and sorted runs change no bit of what the plain formulas give."""
    rng = np.random.default_rng(5)
    weights = rng.normal(size=(300, 96)).astype(np.float32)
    bias, rows = rng.normal(size=96).astype(np.float32), (300 * rng.random((2000, 4)) ** 4).astype(np.int32)
    level = weights[rows[:, 0]] + weights[rows[:, 1]] + weights[rows[:, 2]] + weights[rows[:, 3]] + bias
    level = np.exp(level - level.max(axis=1, keepdims=True))
    assert np.array_equal(maxent._chances(weights, bias, rows), level / level.sum(axis=1, keepdims=True))
    which, total, size = maxent._sums_by_row(level, rows[:, 0])
    assert (np.diff(size) <= 0).all() and size[0] > 12 > size[-1]
    assert sorted(which.tolist()) == np.unique(rows[:, 0]).tolist()
    for row, one, n in zip(which, total, size, strict=True):
        mine = level[rows[:, 0] == row]
        expected = mine[0].copy()
        for more in mine[1:]:
            expected += more
        assert n == len(mine) and np.array_equal(one, expected)
    words = [b"a", b"bc", b"xyz", "é".encode()]
    plain = np.array([(w[-2] if len(w) > 1 else 0) << 8 | w[-1] for w in words], np.uint64)
    forms = (mix(plain + maxent._SEED) >> np.uint64(64 - maxent.FORM_BITS)).astype(np.int64)
    assert np.array_equal(maxent._forms(words), forms) and len(maxent._forms([])) == 0


def test_awkward_rows(spark):
    docs = clashing(awkward(spark)).withColumn("held_out", F.col("doc_id") == 9).fillna(False, ["held_out"])
    found = maxent.score(docs).collect()
    assert len(found) == len(ROWS)
    by_id = {r.doc_id: r for r in found}
    assert by_id[3].n_tokens == by_id[4].n_tokens == by_id[5].n_tokens == 1
    assert by_id[9].n_known == 1
    assert all(np.isfinite(r.score) and r.score <= 0 for r in found)
    none = maxent.score(empty(spark).withColumn("held_out", F.lit(False)))
    assert none.count() == 0
    unlearned = maxent.score(awkward(spark).withColumn("held_out", F.lit(True))).collect()
    assert {r.score for r in unlearned} == {0.0} and {r.train_tokens for r in unlearned} == {0}


def test_own_class_alone_is_the_same_chance():
    """Scoring's chances are training's, bit for bit, without the other classes' columns."""
    rng = np.random.default_rng(3)
    weights, bias = rng.standard_normal((50, 9)).astype(np.float32), rng.standard_normal(9).astype(np.float32)
    for count in (0, 1, 512, 1300):
        rows, kind = rng.integers(0, 50, (count, 4)).astype(np.int32), rng.integers(0, 9, count)
        chances = maxent._chances(weights, bias, rows)
        assert np.array_equal(maxent._chances_of(weights, bias, rows, kind), chances[np.arange(count), kind])
