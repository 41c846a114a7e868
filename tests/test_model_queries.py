"""Model queries hand their operators the whole job; the operators themselves are stood in for."""
import pytest

from plumbline.operators import benchmark, crossfit, ranking, reference, trees
from plumbline.plans import model_queries as plans


class Called(Exception):
    pass


@pytest.fixture
def call_of(spark, small, monkeypatch):
    """Arguments of the first call that a query makes of an operator."""
    for kept in ("_RANKED", "_RESIDUALS", "_CATALOGS", "_REFERENCES"):
        monkeypatch.setattr(plans, kept, {})

    def run(query, module, name):
        def stop(*args, **how):
            raise Called(args, how)

        monkeypatch.setattr(module, name, stop)
        with pytest.raises(Called) as got:
            query(spark, small)
        return got.value.args

    return run


@pytest.fixture
def quick_ranking(spark, monkeypatch):
    """A ranking in the order of its columns."""
    monkeypatch.setattr(ranking, "rank_targets", lambda df, x, targets, id, **k: {
        y: spark.createDataFrame([(c,) for c in x], "feature string") for y in targets})


@pytest.mark.parametrize("query", [plans.regression_feature_ranking, plans.classification_feature_ranking])
def test_rankings_are_over_all_features_with_default_sizes(spark, small, call_of, query):
    (_, x, targets, *_), how = call_of(query, ranking, "rank_targets")
    assert set(x) == {*plans.M, *plans.engineered(spark, small)[1]} and targets == {"ref": False, "invalid": True}
    assert not {"trees", "boosts", "repeats"} & set(how)


@pytest.mark.parametrize("query, name", [(plans.ridge_feature_sets, "ridge_matrix"), (plans.regression_baselines, "tree_matrix"),
                                         (plans.classification_baselines, "tree_matrix"), (plans.regression_baselines, "elastic_matrix"),
                                         (plans.classification_baselines, "logistic_matrix")])
def test_matrices_have_all_sets_and_folds(call_of, quick_ranking, monkeypatch, query, name):
    if name != "tree_matrix":
        monkeypatch.setattr(benchmark, "tree_matrix", lambda *a, **k: None)
    (df, sets, *more), how = call_of(query, benchmark, name)
    assert len(sets) == 9 and all(sets.values()) and len(sets["top_compact_reg"]) == len(sets["top_compact_cls"]) == 15
    assert df.select("fold").distinct().count() == 5 and not {"rounds", "depth"} & set(how)


@pytest.mark.parametrize("query, module, name", [
    (plans.formula_comparison, benchmark, "compare_formulas"), (plans.target_model, reference, "oof_candidates"),
    (plans.target_predictions, reference, "fit_reference"), (plans.extrapolation_stress, reference, "fit_reference"),
    (plans.cross_fitted_residuals, crossfit, "fit_residual_forests")])
def test_models_have_default_sizes_and_five_folds(call_of, query, module, name):
    (df, *more), how = call_of(query, module, name)
    assert not {"boosts", "depth", "trees"} & set(how) and not any(isinstance(a, int) for a in more)
    assert df.select("fold").distinct().count() == 5


def test_permutation_uses_a_forest_of_default_size(call_of):
    (_, jobs), how = call_of(plans.permutation_importance, trees, "grow_forests")
    assert len(jobs) == 1 and not how


def test_matrices_run_to_the_end_on_small_sizes(spark, small):
    df, names = plans.engineered(spark, small, 3)
    sets = {"a": ["voltage", "current_a", "s1"], "b": ["sensor_mad", "s2", "n_sensors_missing"]}
    rows = df.select("test_id", "ref", "invalid", "fold", *sets["a"], *sets["b"]).cache()
    board = benchmark.model_comparison(
        benchmark.tree_matrix(rows, sets, "ref", "test_id", "fold", rounds=3, depth=2), benchmark.elastic_matrix(rows, sets, "ref", "fold"),
        benchmark.constant_matrix(rows, sets, "ref", "fold"), benchmark.tree_matrix(rows, sets, "invalid", "test_id", "fold", True, 3, 2, 0.9),
        benchmark.logistic_matrix(rows, sets, "invalid", "fold"), benchmark.constant_matrix(rows, sets, "invalid", "fold", True)).collect()
    assert len(board) == 12 and all(r.folds == 3 for r in board)
    mae = {(r.model, r.feature_set): r.mae_mean for r in board if r.task == "regression"}
    assert mae["elastic_net", "a"] < mae["boosted_trees", "a"] < mae["median", "a"] == mae["median", "b"]
    f1 = {(r.model, r.feature_set): r.f1_mean for r in board if r.task == "classification"}
    assert f1["most_frequent", "a"] == 0 < f1["boosted_trees", "b"] and f1["logistic", "b"] > 0


def test_ranking_runs_to_the_end_on_small_sizes(spark, small):
    df, _ = plans.engineered(spark, small, 3)
    out = ranking.rank_targets(df, ["voltage", "current_a", "s1", "sensor_mad"], {"ref": False, "invalid": True}, "test_id", trees=3, depth=3,
                               boosts=2, boost_depth=2, repeats=2)
    ref, bad = (t.collect() for t in out.values())
    assert ref[0].feature == "current_a" and bad[0].feature == "sensor_mad"
    assert all(r.rf_importance is not None and r.perm_importance is not None for r in [*ref, *bad])
