import random

import pytest

from kinweave.operators import diagnostics, metrics

PAIRS, TRUTH = "s1_id string, target_code long, label int, score double", "s1_id string, n_true long"


def f(tp, predicted, true):
    return 1.0 if predicted == true == 0 else 1.25 * tp / (predicted + 0.25 * true)


def test_hand_computed(spark):
    truth = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("d", 0), ("e", 0)], TRUTH)
    pairs = spark.createDataFrame([("a", 1, 1, 0.9), ("a", 2, 0, 0.9), ("b", 1, 1, 0.9), ("c", 1, 1, 0.9), ("c", 2, 1, 0.8), ("c", 3, 0, 0.8), ("d", 1, 0, 0.7), ("e", 1, 0, 0.1)], PAIRS)
    got = {r.s1_id: r.f05 for r in metrics.per_entity(pairs, truth, 0.5).collect()}
    want = {"a": 5 / 9, "b": 5 / 6, "c": 5 / 7, "d": 0, "e": 1}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    s = metrics.summary(metrics.per_entity(pairs, truth, 0.5)).first()
    assert len(s) == 17 and (s.tp, s.fp, s.fn, s.singleton_count, s.correct_singletons, s.false_singleton_merges) == (4, 3, 1, 2, 1, 1)


def test_sweep_is_direct_scoring(spark):
    rng = random.Random(42)
    truth, pairs = [], []
    for i in range(50):
        own = [(f"{i}", t, int(rng.random() < 0.3), rng.choice([0.2, 0.5, 0.8])) for t in range(rng.randint(0, 10))]
        pairs += own
        truth.append((f"{i}", sum(p[2] for p in own) + rng.randint(0, 1)))
    p, t = spark.createDataFrame(pairs, PAIRS), spark.createDataFrame(truth, TRUTH)
    want = {}
    for level in (float("inf"), 0.2, 0.5, 0.8):
        want[level] = sum(f(sum(x[2] for x in pairs if x[0] == s and x[3] >= level), sum(x[0] == s and x[3] >= level for x in pairs), n) for s, n in truth) / 50
    got = {r.threshold: r.macro_f0_5 for r in metrics.sweep(p, t).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    grid = {r.threshold: r.macro_f0_5 for r in metrics.sweep(p, t, [0.0, 0.3, 0.6, 1.0]).collect()}
    assert all(abs(grid[a] - want[b]) < 1e-9 for a, b in ((0.0, 0.2), (0.3, 0.5), (0.6, 0.8), (1.0, float("inf"))))
    assert metrics.select(metrics.sweep(p, t)).first().macro_f0_5 == max(got.values())


def test_predicting_nothing_can_win(spark):
    p, t = spark.createDataFrame([("a", 1, 0, 1.0)], PAIRS), spark.createDataFrame([("a", 0), ("b", 0)], TRUTH)
    assert metrics.decide(p, t)["threshold"] == metrics.ABOVE_ONE


def test_rejections(spark):
    t = spark.createDataFrame([("a", 1)], TRUTH)
    for rows, what in (([("a", 1, 1, 0.1), ("a", 1, 1, 0.2)], "pair"), ([("b", 1, 1, 0.1)], "unknown"), ([("a", 1, 1, float("nan"))], "finite"), ([("a", 1, 1, 0.1), ("a", 2, 1, 0.2)], "positives")):
        with pytest.raises(ValueError, match=what):
            metrics.check(spark.createDataFrame(rows, PAIRS), t)


def test_bootstrap_and_margin(spark):
    e = spark.createDataFrame([(f"{i}", i % 2 * 1.0) for i in range(200)], "s1_id string, f05 double")
    r = diagnostics.bootstrap(e, 100).first()
    assert 0.35 < r.low < 0.5 < r.high < 0.65
    m = diagnostics.margin(spark.createDataFrame([("a", 1, 1, 0.9), ("a", 2, 0, 0.4), ("b", 3, 0, 0.5)], PAIRS))
    assert {(x.s1_id, x.target_code): round(x.margin, 6) for x in m.collect()} == {("a", 1): 0.5, ("a", 2): -0.5, ("b", 3): 0.5}
