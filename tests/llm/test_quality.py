import duckdb
import numpy as np
from cases import awkward, clashing, empty

from sensoria.llm import quality

FOLDER = "/root/testdata/sf0.01"


def test_agrees_with_the_labels_it_never_saw(spark):
    found = quality.op1_quality(spark, FOLDER).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, quality AS label FROM '{FOLDER}/labels.parquet'").df().merge(found, on="doc_id")
    good, bad = labels[labels.label == 1], labels[labels.label == 0]
    assert good.kept.mean() > 0.98 and bad.kept.mean() < 0.2
    assert found.quality.between(0, 1).all() and found.posterior.between(0, 1).all()


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(40_000) < 0.5
    accuracy = np.array([0.95, 0.8, 0.7, 0.9])
    right = rng.random((len(truth), 4)) < accuracy
    voted = rng.random((len(truth), 4)) < 0.7
    votes = np.where(voted, np.where(right == truth[:, None], quality.GOOD, quality.BAD), quality.NONE)
    number, counts = np.unique(quality._pattern_number(votes), return_counts=True)
    patterns = quality._patterns(number, 4)
    model = quality.fit_labels(patterns, counts.astype(float), quality.Settings(trust=0.001))
    assert np.abs(model.accuracy - accuracy).max() < 0.03
    # swapping good and bad everywhere mirrors the posterior
    mirrored = np.select([votes == quality.GOOD, votes == quality.BAD], [quality.BAD, quality.GOOD], quality.NONE)
    assert np.allclose(model.posterior(votes[:50]), 1 - model.posterior(mirrored[:50]))


def test_awkward_rows(spark):
    model = quality.train(awkward(spark))
    found = [(r.doc_id, r.quality, r.kept) for r in quality.judge(clashing(awkward(spark)), model).collect()]
    assert len(found) == 11
    assert {doc for doc, score, kept in found if score == 0 and not kept} >= {3, 4, 5}
    assert [f for f in found if f[0] == 2][0] == [f for f in found if f[0] == 2][1]
    nothing = quality.train(empty(spark))
    assert quality.judge(empty(spark), nothing).count() == 0
    assert quality.judge(awkward(spark), nothing).count() == 11
