"""Training plan: staged stopping, trees as a table, selection, comparison, sessions."""

import dataclasses
import datetime as dt
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from panelcast.operators import compare as CP
from panelcast.operators import model as MD
from panelcast.operators.features import FeatureParams, feature_table
from panelcast.operators.splits import temporal_split
from panelcast.plans import training as T

COLS = ["demand_lag_1", "demand_lag_12", "demand_ma3", "month_sin", "month_cos", "trend"]


@pytest.fixture(scope="module")
def frame(spark):
    """Two seasonal series with features, a column of pure noise, splits and weights."""
    rng = random.Random(7)
    rows = [(s, dt.date(2010 + t // 12, t % 12 + 1, 1),
             100 + 5 * i + 0.3 * t + 20 * math.sin(2 * math.pi * (t % 12) / 12) + rng.gauss(0, 1))
            for i, s in enumerate("ab") for t in range(96)]
    panel = spark.createDataFrame(rows, "series string, date date, demand double")
    p = FeatureParams(target="demand", keys=["series"], macro_cols=[], target_lags=[1, 12], windows=[3])
    feat = temporal_split(feature_table(panel, p), "2016-01-01", "2017-01-01")
    # random where the trees are fitted; one value on val, so that its shuffles cost exactly nothing
    noise = F.when(F.col("split") == "val", F.lit(0.5)).otherwise(F.pmod(F.xxhash64("series", "date"), F.lit(1000)) / 1000.0).alias("noise")
    return T.cut_lineage(feat.select("*", noise, F.when(F.col("split") == "train", F.lit(1.0)).alias("w_train"),
                                     F.when(F.col("split") != "test", F.lit(1.0)).alias("w_trainval")))


def spec(cols=COLS, weight="w_train"):
    return MD.TrainSpec(feature_cols=list(cols), weight=weight)


SMALL = MD.TreeParams(max_iter=12, max_depth=3, step_size=0.3, subsampling_rate=0.8, feature_subset="0.7")


def test_stopping_round_waits_for_its_patience():
    assert MD.stopping_round([5, 4, 3, 4, 4, 4, 2, 1], patience=3) == (3, True)      # a later gain is not seen
    assert MD.stopping_round([5, 4, 3, 4, 4, 2, 2, 3], patience=3) == (6, False)
    assert MD.stopping_round([5, 5, 5, 5], patience=3) == (1, True)
    assert MD.stopping_round([1.0], patience=20) == (1, False)
    assert MD.stopping_round([float("nan")] * 3, patience=2) == (1, True)


def test_staged_errors_equal_each_prefix_by_itself(frame):
    train, val = frame.filter("split = 'train'"), frame.filter("split = 'val'").withColumn("w_train", F.lit(1.0))
    m = MD.fit_boosted_trees(train, spec(), SMALL)
    staged = MD.staged_errors(m, MD.fit_rows(val, spec(), "w_train"))
    nodes = MD.tree_nodes(m)
    for k in (1, 2, 7, 12):
        first = nodes.filter(F.col("tree") < k)
        got = MD.score_by_expression(val, first, COLS, "p").agg(F.avg((F.col("demand") - F.col("p")) ** 2)).first()[0]
        assert math.isclose(got, staged[k - 1], rel_tol=1e-9)
    assert len(staged) == MD.trees_used(m) == 12


def test_search_uses_the_trees_a_plain_evaluation_would(frame):
    space = MD.SearchSpace(max_iter=(8, 24), step_size=(0.3, 0.9))
    table, best = MD.hyperparameter_search(frame, spec(), space, 3, parallel=2, patience=3)
    train, val = frame.filter("split = 'train'"), frame.filter("split = 'val'")
    rows = table.orderBy("trial").collect()
    for r in rows:
        p = MD.TreeParams(**json.loads(r["params"]))
        nodes = T.cut_lineage(MD.tree_nodes(MD.fit_boosted_trees(train, spec(), p)))
        errors = [MD.score_by_expression(val, nodes.filter(F.col("tree") < k), COLS, "p").agg(
            F.avg((F.col("demand") - F.col("p")) ** 2)).first()[0] for k in range(1, p.max_iter + 1)]
        best_at = 0
        for i, e in enumerate(errors):          # plain: three rounds without a better one end it
            if e < errors[best_at]:
                best_at = i
            if i - best_at >= 3:
                break
        assert r["trees_used"] == best_at + 1 and math.isclose(r["val_mse"], errors[best_at], rel_tol=1e-9)
    assert best.max_iter == min(rows, key=lambda r: (r["val_mse"], r["trial"]))["trees_used"]


def test_search_fits_few_rounds_first_and_trials_together(frame, monkeypatch):
    """Of 600 rounds a trial that stops at round 50 costs 80 (a quarter were 150), one that
    never stops all of them at last; eight small trials start at once on four cores."""
    import threading
    together, fitted, lock = threading.Barrier(8), {}, threading.Lock()
    space = MD.SearchSpace(max_iter=(600, 600), max_depth=(2, 3))

    def fit(rows, spec, p, seed):
        with lock:
            done = fitted.setdefault(p.step_size, [])
            done.append(p.max_iter)
        if len(done) == 1:
            together.wait(timeout=60)
        return p

    def errors(p, rows):
        best = 30 if p.max_depth == 2 else 600
        return [abs(best - i) + p.step_size for i in range(1, p.max_iter + 1)]

    monkeypatch.setattr(MD, "fit_boosted_trees", fit)
    monkeypatch.setattr(MD, "staged_errors", errors)
    table, best = MD.hyperparameter_search(frame, spec(), space, 8)
    rows = table.orderBy("trial").collect()
    assert [r["trial"] for r in rows] == list(range(8)) and len({json.loads(r["params"])["max_depth"] for r in rows}) == 2
    for r in rows:
        p = MD.TreeParams(**json.loads(r["params"]))
        assert (r["trees_used"], fitted[p.step_size]) == ((30, [80]) if p.max_depth == 2 else (600, [80, 160, 320, 600]))
        assert r["val_mse"] == p.step_size
    assert best.max_iter in (30, 600) and MD.fit_lengths(50, 20) == [50] and MD.fit_lengths(3, 0) == [1, 2, 3]


def test_search_names_are_mapped_or_refused():
    p = MD.TreeParams.from_search_names(dict(n_estimators=70, learning_rate=0.02, subsample=0.6, colsample_bytree=0.5,
                                             min_child_weight=4, gamma=0.1, max_depth=5))
    assert (p.max_iter, p.step_size, p.subsampling_rate, p.feature_subset, p.min_instances, p.min_info_gain, p.max_depth) == (
        70, 0.02, 0.6, "0.5", 4, 0.1, 5)
    with pytest.raises(ValueError, match="reg_alpha: .*no counterpart; reg_lambda: .*no counterpart"):
        MD.TreeParams.from_search_names(dict(reg_lambda=1.0, reg_alpha=0.1))
    with pytest.raises(ValueError, match="depth: unknown parameter"):
        MD.TreeParams.from_search_names(dict(depth=3))


def test_predictions_again_from_the_node_table(frame):
    m = MD.fit_boosted_trees(frame.filter("split != 'test'"), spec(weight="w_trainval"), SMALL)
    nodes = MD.tree_nodes(m)
    both = m.transform(frame).select("series", "date", "y_pred").join(
        MD.score_by_expression(frame, nodes, COLS, "e").select("series", "date", "e"), ["series", "date"]).join(
        MD.score_by_join(frame, nodes, COLS, ["series", "date"], "j"), ["series", "date"])
    rows = both.collect()
    assert len(rows) == frame.count() and all(math.isclose(r["y_pred"], r["e"], rel_tol=1e-12) and math.isclose(r["y_pred"], r["j"], rel_tol=1e-12) for r in rows)
    shape = nodes.agg(F.countDistinct("tree").alias("t"), F.count("feature").alias("s"), F.count(F.lit(1)).alias("n")).first()
    assert shape["t"] == 12 and shape["n"] == 2 * shape["s"] + 12        # binary trees: one more leaf than splits


def test_fit_does_not_depend_on_how_rows_came(frame):
    train = frame.filter("split = 'train'")
    a, b = (MD.fit_boosted_trees(d, spec(), SMALL) for d in (train.repartition(7), train.orderBy(F.rand(3)).coalesce(1)))
    assert a.stages[-1].toDebugString.split("\n", 1)[1] == b.stages[-1].toDebugString.split("\n", 1)[1]


def test_training_with_selection_drops_pure_noise_and_refits(frame):
    rp = T.RunParams.quick(base_trees=MD.TreeParams(max_iter=30, step_size=0.3), repeats=8, n_folds=2)
    res = T.train_on(frame, [*COLS, "noise"], rp, with_cv=False, with_search=False, select=True, protected=["trend", "absent"])
    gone = {r["feature"] for r in res.importance.filter("importance_mean <= 0").collect()}
    assert "noise" not in res.feature_cols and "noise" in gone
    assert "trend" in res.feature_cols and "absent" not in res.feature_cols
    assert set(res.feature_cols) == ({*COLS, "noise"} - gone) | {"trend"}
    assert list(res.model.stages[0].getInputCols()) == res.feature_cols and res.predictions.count() == frame.count()


def test_shuffles_without_effect_cost_exactly_nothing(frame):
    """Columns of one value on val: no shuffle changes a prediction, however the rows are added up."""
    flat = [f"flat_{i}" for i in range(12)]
    df = frame.withColumns({c: F.when(F.col("split") == "val", F.lit(0.5)).otherwise(F.rand(i)) for i, c in enumerate(flat)})
    df = T.cut_lineage(df)
    s = spec([*COLS, *flat])
    m = MD.fit_boosted_trees(df.filter("split = 'train'"), s, SMALL)
    imp, kept = MD.permutation_importance(m, df.filter("split = 'val'").repartition(5), s, repeats=12)
    got = {r["feature"]: (r["importance_mean"], r["importance_std"]) for r in imp.collect()}
    assert {got[c] for c in flat} == {(0.0, 0.0)} and not set(flat) & set(kept)
    assert got["demand_lag_1"][0] != 0 and len(got) == len(COLS) + len(flat)


def test_cross_validation_alone_fits_no_final_model(frame):
    rp = T.RunParams.quick(base_trees=SMALL, n_folds=2)
    short = frame.filter("series = 'a' or date < '2011-06-01'")
    res = T.train_on(short, COLS, rp, with_search=False, with_final=False)
    assert res.model is None and res.cv.count() == 2
    assert [r["series"] for r in res.rejected.collect()] == ["b"]


def test_models_are_compared_on_the_rows_they_share(spark):
    on = "series string, date string, split string, y_real double, y_pred double"
    a = spark.createDataFrame([("s", "1", "val", 10.0, 11.0), ("s", "2", "val", 10.0, 10.0), ("s", "3", "test", 5.0, 5.0)], on)
    b = spark.createDataFrame([("s", "1", "val", 10.0, 10.5), ("s", "2", "val", 10.0, None), ("s", "4", "val", 7.0, 7.0), ("s", "3", "test", 5.0, 6.0)], on)
    c = spark.createDataFrame([("s", "3", "test", 5.0, 5.5), ("s", "1", "val", 10.0, None)], on)
    aligned = CP.align_predictions({"a": a, "b": b, "c": c}, ["series", "date", "split"])
    cover = {(r["model"], r["split"]): (r["n_support"], r["n_predicted"], r["n_missing"], r["n_common"]) for r in CP.coverage(aligned).collect()}
    assert cover == {("a", "val"): (3, 2, 1, 1), ("b", "val"): (3, 2, 1, 1), ("c", "val"): (3, 0, 3, 1),
                     ("a", "test"): (1, 1, 0, 1), ("b", "test"): (1, 1, 0, 1), ("c", "test"): (1, 1, 0, 1)}
    got = {(r["model"], r["split"]): r for r in CP.compare_models(aligned).collect()}
    assert (got["a", "val"]["mae"], got["b", "val"]["mae"], got["c", "val"]["mae"]) == (1.0, 0.5, None)
    assert got["b", "val"]["best_mape"] and not got["a", "val"]["best_mape"] and got["a", "test"]["best_mape"]
    best = {r["split"]: r["best_mape_model"] for r in CP.winners(CP.compare_models(aligned)).collect()}
    assert best == {"val": "b", "test": "a"}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory, sf_small):
    base = str(tmp_path_factory.mktemp("sessions"))
    rp = T.RunParams.quick(n_folds=2, horizon=4, until="2001-06-01", base_trees=MD.TreeParams(max_iter=8, step_size=0.3))
    res = T.train(spark, sf_small, rp, with_search=False)
    fc = T.cut_lineage(T.forecast(res))
    return base, T.save_session(spark, res, base, fc), res, fc


def test_a_reloaded_session_is_the_one_saved(spark, sf_small, stored):
    base, sid, res, fc = stored
    back = T.load_session(spark, base, sid, sf_small)
    assert back.params == res.params and back.best == res.best and back.feature_cols == res.feature_cols
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(back.metrics.select("split", *T.METRICS)) == rows(res.metrics.select("split", *T.METRICS))
    assert rows(back.cv) == rows(res.cv) and rows(back.predictions) == rows(res.predictions)
    kept = T.load_validation(spark, base, sid)
    assert kept.columns == ["series", "date", "split", *res.feature_cols, "y_real", "y_pred"]
    assert rows(kept.select(*res.predictions.columns)) == rows(res.predictions)
    assert rows(T.load_forecast(spark, base, sid)) == rows(fc) == rows(T.forecast(back))


def test_a_half_written_session_is_invisible(spark, stored):
    base, sid, res, _ = stored
    before = [r["session_id"] for r in T.list_sessions(spark, base).collect()]
    with pytest.raises(AttributeError):          # fails when model and rows are written, the manifest not yet
        T.save_session(spark, dataclasses.replace(res, metrics=None), base)
    assert [r["session_id"] for r in T.list_sessions(spark, base).collect()] == before
    assert T.list_sessions(spark, base + "/none").count() == 0
    with pytest.raises(ValueError, match="no session x"):
        T.load_session(spark, base, "x", "unused")


def test_a_forecast_can_be_added_later_and_the_newest_counts(spark, stored):
    base, sid, res, fc = stored
    other = T.save_session(spark, res, base)
    assert T.load_forecast(spark, base, other) is None
    T.add_forecast(spark, base, other, fc.limit(3))
    T.add_forecast(spark, base, other, fc.limit(2))
    assert T.load_forecast(spark, base, other).count() == 2 and T.load_forecast(spark, base, sid).count() == fc.count()
    assert [r["session_id"] for r in T.list_sessions(spark, base).collect()][0] == other


def test_run_parameters_survive_their_json():
    rp = T.RunParams.quick(until="2001-01-01", space=MD.SearchSpace(max_iter=(3, 9)))
    assert T.RunParams.from_json(rp.to_json()) == rp
