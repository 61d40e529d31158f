import random

import numpy as np
from cases import awkward, clashing, empty

from sensoria.llm import minhash


def sets_of(rows, n):
    out = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        out[doc] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else (
            {tuple(words)} if words else set()
        )
    return out


def brute(rows, n):
    sets = sets_of(rows, n)
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {doc: (len(sets[doc]), find(doc)) for doc in docs}


def corpus():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows, number = [], 0
    for size in (1, 2, 3, 4, 30, 60, 200):
        base = [word() for _ in range(size)]
        for copy in range(40 if size == 60 else 8):
            text = list(base)
            for _ in range(rng.randint(0, max(1, size // 25)) if copy else 0):
                text[rng.randrange(size)] = word()
            rows.append((number, " ".join(text) if copy % 3 else " ".join(text).upper()))
            number += 1
    rng.shuffle(rows)
    return rows


def test_components_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for block in (128, 7):  # small blocks make families span several block pairs
        found = minhash.near_duplicates(docs, minhash.Settings(shingle=4, block=block)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, 4)
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_signature_is_an_unbiased_estimate():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 3000).astype(np.uint64)
    b = np.concatenate([a[:2000], rng.integers(0, 2**63, 1000).astype(np.uint64)])
    for n in (12, 300, 3000):
        x, y = a[:n], np.concatenate([a[: 2 * n // 3], b[-(n - 2 * n // 3) :]])
        both = minhash.super_minhash(np.concatenate([x, y]), np.array([n, n]), 512)
        truth = (2 * n // 3) / (2 * n - 2 * n // 3)
        assert np.isfinite(both).all()
        assert abs((both[0] == both[1]).mean() - truth) < 0.07
        # every place holds a different step's value of a permutation: whole parts are few
        assert both.max() <= 512


def test_awkward_rows(spark):
    docs = clashing(awkward(spark))
    found = [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()]
    assert len(found) == 11
    by_id = {r[0]: r for r in found}
    assert by_id[2][2] == 1 and not by_id[2][3]
    for doc in (3, 4, 5):
        assert by_id[doc][1:] == (0, doc, True)
    assert by_id[None][2] is None or by_id[None][2] in by_id
    assert by_id[9][1] == 1
    kept = minhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 3, 4, 5, 6, 7, 8, 9]
    assert minhash.near_duplicates(empty(spark)).count() == 0


def test_repeated_ids_keep_their_own_texts(spark):
    a, b = "the cat sat on the mat and slept all day long", "ten ships sailed north before the storm came in"
    c = "nobody had ever seen such a bright green light"
    rows = [(1, a), (1, b), (2, a), (3, b), (2, c), (4, c + " x"), (5, a.upper()), (5, a.upper()), (6, None), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    s = minhash.Settings(shingle=2, percent=80)
    found = {(r.doc_id, r.text): (r.component_id, r.kept) for r in _with_text(docs, s)}
    assert found[2, a] == (1, False) and found[3, b] == (1, False) and found[5, a.upper()] == (1, False)
    assert found[2, c] == (2, True) and found[4, c + " x"] == (2, False)
    kept = minhash.keep_first(docs, s).collect()
    assert sorted(kept, key=repr) == sorted([(1, a), (1, b), (2, c), (6, None)], key=repr)
    # equal rows: one stays
    twice = minhash.keep_first(spark.createDataFrame([(1, a), (1, a), (None, a), (None, a)], "doc_id long, text string"))
    assert sorted(r.doc_id or 0 for r in twice.collect()) == [0, 0, 1]


def _with_text(docs, s):
    from pyspark.sql import functions as F

    found = minhash._grouped(docs, s, "text", "doc_id").distinct()
    return docs.distinct().withColumn("copy", F.xxhash64("text")).join(found, ["doc_id", "copy"]).collect()


def test_text_ids(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([("b", text), ("a", text + " x"), ("c", "else")], "doc_id string, text string")
    found = minhash.near_duplicates(docs, minhash.Settings(shingle=1)).collect()
    assert {r.doc_id: r.component_id for r in found} == {"a": "a", "b": "a", "c": "c"}


def test_components_of_paths_and_stars(spark):
    from sensoria.llm.graph import components

    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(5, 5), (None, 3)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(61)} == {0} and {found[i] for i in range(100, 140)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_stars_take_no_round(spark):
    """The driver keeps the plans, stages and threads of all rounds, so none may be idle."""
    from sensoria.llm.graph import components

    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    edges = spark.createDataFrame([(0, i) for i in range(1, 9)] + [(9, 10)], "a long, b long")
    context.setJobGroup("stars", "components of two stars")
    try:
        found = components(edges).collect()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    stages = {stage for job in tracker.getJobIdsForGroup("stars") for stage in tracker.getJobInfo(job).stageIds}
    assert {(r.node, r.component) for r in found} == {(i, 9 * (i > 8)) for i in range(11)}
    assert len(stages) <= 16
