"""Boosted trees of all domains in the same jobs, against a plain recursion over the rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sensoria.plans.forecast import boosting as bo

FEATURES = ("a", "b", "c")
SCHEMA = "gas string, id int, a double, b double, c int, dato double"
SETTINGS = bo.Settings(rounds=11, depth=3, step=0.3, sample=0.7, bins=8)


def rows():
    rng = np.random.default_rng(3)
    result = []
    for i in range(900):
        gas = "hot" if i % 3 else ("rare" if i % 2 else None)
        a, b, c = rng.normal(), rng.normal(), int(rng.integers(0, 4))
        dato = 3 * a * (c > 1) + abs(b) + 0.1 * rng.normal() + 5 * (gas == "hot")
        result.append((gas, i, None if i % 17 == 0 else float(a), float("nan") if i % 19 == 0 else float(b), c, float(dato)))
    return result


@pytest.fixture(autouse=True)
def small_tasks(monkeypatch):
    monkeypatch.setattr(bo, "ROWS_PER_TASK", 200)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).cache()


def fitted(table, settings=SETTINGS):
    return bo.fit(table, ("gas",), FEATURES, "dato", ("gas", "id"), settings)


def predicted(model, table):
    found = model.predict(table, ["gas", "id"]).collect()
    return {(r.gas, r.id): r.yhat for r in found}


def recursive(bins, residual, take, depth, step):
    """Prediction of one tree for every row, grown by recursion over lists of rows."""
    result = np.zeros(len(residual))

    def grow(inside, left_depth):
        own = inside & take
        if not own.any():
            return
        result[inside] = step * residual[own].mean()
        if not left_depth:
            return
        base, best = residual[own].sum() ** 2 / own.sum(), None
        for feature in range(bins.shape[1]):
            for last in range(SETTINGS.bins):
                left, right = own & (bins[:, feature] <= last), own & (bins[:, feature] > last)
                if left.any() and right.any():
                    gain = sum(residual[s].sum() ** 2 / s.sum() for s in (left, right)) - base
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = gain, feature, last
        if best:
            below = bins[:, best[1]] <= best[2]
            grow(inside & below, left_depth - 1)
            grow(inside & ~below, left_depth - 1)

    grow(np.ones(len(residual), bool), depth)
    return result


def test_equals_a_plain_recursion(table):
    model = fitted(table.repartition(5, "id"))
    found = predicted(model, table)
    known = table.select("*", F.xxhash64("gas", "id").alias("key")).toPandas()
    for number, (gas,) in enumerate(model.numbers):
        own = known[known.gas.isna()] if gas is None else known[known.gas == gas]
        values = own[list(FEATURES)].to_numpy(float)
        bins = bo.binned(values, np.full(len(own), number), model.edges)
        residual = own.dato.to_numpy() - own.dato.mean()
        yhat = np.full(len(own), own.dato.mean())
        for round_number in range(SETTINGS.rounds):
            take = bo.sampled(own.key.to_numpy(), round_number, SETTINGS)
            step = recursive(bins, residual, take, SETTINGS.depth, SETTINGS.step)
            residual, yhat = residual - step, yhat + step
        got = [found[(gas, i)] for i in own.id]
        assert np.allclose(got, yhat, atol=1e-6)


def test_trees_do_not_depend_on_the_layout(table):
    # the sums are exact, so one task and many find the very same trees
    few = bo.Settings(rounds=4, depth=3, sample=0.7, bins=8)
    one, many = fitted(table.coalesce(1), few), fitted(table.repartition(7, "id"), few)
    assert predicted(one, table) == predicted(many, table)


def test_errors_fall_and_every_row_has_a_prediction(table):
    found = predicted(fitted(table, bo.Settings(rounds=15, depth=4, step=0.4, bins=32)), table)
    actual = {(r[0], r[1]): r[5] for r in rows()}
    assert found.keys() == actual.keys()
    error = np.mean([(found[k] - v) ** 2 for k, v in actual.items()])
    assert error < 0.15 * np.var(list(actual.values()))


def test_training_mean_is_kept_without_sampling(table):
    found = predicted(fitted(table, bo.Settings(rounds=5, depth=3, step=0.5, sample=1.0)), table)
    mine = [v for (gas, _), v in found.items() if gas == "rare"]
    actual = [r[5] for r in rows() if r[0] == "rare"]
    assert np.mean(mine) == pytest.approx(np.mean(actual), abs=1e-6)


def test_unknown_domains_and_empty_tables(spark, table):
    model = fitted(table.filter("gas = 'hot'"), bo.Settings(rounds=2, depth=2))
    found = predicted(model, table)
    assert all((v is None) == (gas != "hot") for (gas, _), v in found.items())
    nothing = fitted(table.filter("id < 0"))
    assert set(predicted(nothing, table).values()) == {None}
    assert model.predict(table.filter("id < 0"), ["gas", "id"]).count() == 0


def test_missing_labels_do_not_count_and_constants_stay(spark):
    data = [("x", i, float(i), None, 1, 4.0) for i in range(20)]
    data += [("x", 100, 1.0, None, 1, None), ("x", 101, 1.0, None, 1, float("nan"))]
    table = spark.createDataFrame(data, SCHEMA)
    found = predicted(fitted(table, bo.Settings(rounds=3, depth=2)), table)
    assert len(found) == 22 and set(found.values()) == {4.0}


def test_every_domain_shares_the_jobs(spark, table):
    tracker = spark.sparkContext.statusTracker()

    def jobs(rows, group):
        spark.sparkContext.setJobGroup(group, group)
        fitted(rows, bo.Settings(rounds=4, depth=2))
        return len(tracker.getJobIdsForGroup(group))

    try:
        assert jobs(table, "three-domains") <= jobs(table.filter("gas = 'hot'"), "one-domain") + 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_bins_are_checked(table):
    with pytest.raises(ValueError, match="bins"):
        fitted(table, bo.Settings(bins=255))
