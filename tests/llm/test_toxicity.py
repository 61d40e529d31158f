import duckdb
import numpy as np
import pytest
from cases import awkward, clashing, empty

from sensoria.llm import toxicity

FOLDER = "/root/testdata/sf0.1"


def test_held_out_recall_and_precision(spark):
    found = toxicity.op10_toxicity(spark, FOLDER).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, toxic FROM '{FOLDER}/labels.parquet'").df()
    held = labels.merge(found, on="doc_id")
    held = held[held.held_out]
    hit = (held.predicted == 1) & (held.toxic == 1)
    assert hit.sum() / (held.toxic == 1).sum() > 0.75
    assert hit.sum() / (held.predicted == 1).sum() > 0.85
    assert found.score.between(0, 1).all()
    assert ((found.score >= 0.3).astype(int) == found.predicted).all()


def test_gradients_match_differences():
    s = toxicity.Settings(hidden=3, word_size=2, char_size=2, table_bits=4)
    w = {k: v.astype(np.float64) for k, v in toxicity._start(s).items()}
    rng = np.random.default_rng(0)
    x = rng.standard_normal((5, toxicity.FIXED + 4))
    place = rng.integers(0, 5, (4, 6))
    there = np.arange(6)[None] < np.array([6, 4, 1, 5])[:, None]
    truth, weight = np.array([1.0, 0, 1, 0]), np.ones(4)

    def loss():
        project = x @ w["in"] + w["shift"]
        logit = toxicity._logits(project.astype(np.float64), place, there, w)
        return float((np.log1p(np.exp(-logit)) + (1 - truth) * logit).mean())

    grad, _ = toxicity._gradient(x, place, there, truth, weight, w)
    for name in ("in", "u0", "u1", "look", "aim", "out", "bias"):
        flat = w[name].reshape(-1)
        for at in rng.integers(0, flat.size, 3):
            before = flat[at]
            flat[at] = before + 1e-3
            up = loss()
            flat[at] = before - 1e-3
            down = loss()
            flat[at] = before
            assert np.reshape(grad[name], -1)[at] == pytest.approx((up - down) / 2e-3, abs=2e-3)


def test_windows_cover_every_word():
    s = toxicity.Settings(window=8, stride=4)
    lengths = np.array([0, 1, 8, 9, 30])
    text, first, size = toxicity._windows(lengths, s)
    starts = np.cumsum(lengths) - lengths
    for i, length in enumerate(lengths):
        seen = {p for t, f, n in zip(text, first, size, strict=True) if t == i for p in range(f, f + n)}
        assert seen == set(range(starts[i], starts[i] + length))


def test_awkward_rows(spark):
    rows = [(1, b"you fool idiot"), (0, b"good day to you"), (1, b"idiot again"), (0, None), (0, b"fine words here")] * 5
    model = toxicity.fit(rows, toxicity.Settings())
    found = toxicity.score(clashing(awkward(spark)), model)
    scores = [(r.doc_id, r.score) for r in found.collect()]
    assert len(scores) == 11 and all(0 <= x <= 1 for _, x in scores)
    assert len({x for doc, x in scores if doc in (3, 4, 5)}) == 1
    assert toxicity.score(empty(spark), model).count() == 0


def test_the_sample_has_900_and_2100_rows(spark, monkeypatch):
    labels = spark.range(8000).selectExpr("id AS doc_id", "CAST(id % 3 = 0 AS int) AS toxic")
    docs = spark.range(8000).selectExpr("id AS doc_id", "concat('words ', id) AS text")
    taken = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, s: taken.extend(label for label, _ in rows))
    toxicity.train(docs, labels)
    assert (sum(taken), len(taken) - sum(taken)) == (900, 2100)


def test_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(awkward(spark), labels)
    assert {r.score for r in toxicity.score(awkward(spark), model).collect()} == {0.0}
    one = toxicity.train(awkward(spark), spark.createDataFrame([(1, 1), (2, None)], "doc_id long, toxic int"))
    assert {r.predicted for r in toxicity.score(awkward(spark), one).collect()} == {1}
