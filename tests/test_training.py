import os

from clickpath.operators import registry as REG
from clickpath.plans import training as TR
from clickpath.sources.testdata import adapted_events
from clickpath.schema import FEATURE_COLS

from conftest import SF_MED, SF_SMALL


def test_training_cycle_promotes_first_and_keeps_equal_champion(spark, scratch):
    events = adapted_events(spark, SF_MED)
    reg = os.path.join(scratch, "registry")
    kw = dict(model_base=os.path.join(scratch, "models"), registry_path=reg, gap="12 hours",
              trained_on="sf0.01", distinct="exact")
    first = TR.run_training_cycle(spark, events, version="v1", **kw)
    assert first["promoted"] and first["champion_auc"] is None
    assert first["invalid_feature_rows"] == 0
    m = first["metrics"]
    assert 0.0 <= m["auc"] <= 1.0 and 0.05 <= m["decision_threshold"] <= 0.95
    # same data, same model: improvement 0 ≤ margin → the champion stays
    second = TR.run_training_cycle(spark, events, version="v2", **kw)
    assert not second["promoted"]
    assert abs(second["champion_auc"] - first["metrics"]["auc"]) < 1e-9
    log = REG.read_registry(spark, reg)
    assert log.count() == 2 and REG.active_champion(log).first().version == "v1"


def test_threshold_installation_per_model_type(spark):
    from pyspark.ml.classification import LogisticRegressionModel
    for mt in TR.MODEL_TYPES:
        clf = TR.build_classifier(mt)
        assert clf.getOrDefault("weightCol") == "class_weight"
    assert TR.build_classifier("nonsense").__class__.__name__ == "LogisticRegression"
    assert hasattr(LogisticRegressionModel, "setThreshold")


def test_installed_threshold_drives_predictions(spark):
    from pyspark.sql import functions as F
    from clickpath.operators.metrics import class_weights
    from clickpath.operators.sessions import session_features
    from clickpath.sources.testdata import adapted_events
    from conftest import SF_SMALL

    sessions = class_weights(session_features(adapted_events(spark, SF_SMALL), "12 hours"))
    for model_type in ("logistic_regression", "random_forest"):
        model = TR.build_pipeline(model_type).fit(sessions)
        for t in (0.3, 0.7):
            TR.install_threshold(model, t)
            scored = TR.purchase_probability(model.transform(sessions))
            # predicted positive exactly when P(purchase) clears the installed threshold
            wrong = scored.filter((F.col("prediction") == 1) != (F.col("purchase_probability") > t)).count()
            assert wrong == 0, (model_type, t)



def test_invalid_feature_rows_counts_null_and_nan(spark):
    from clickpath.schema import FEATURE_COLS
    cols = ", ".join(f"{c} double" for c in FEATURE_COLS)
    rows = [tuple([1.0] * len(FEATURE_COLS)), tuple([None] + [1.0] * (len(FEATURE_COLS) - 1)),
            tuple([1.0] * (len(FEATURE_COLS) - 1) + [float("nan")])]
    assert TR.invalid_feature_rows(spark.createDataFrame(rows, cols)) == 2


def test_the_fit_gradient_vanishes_at_the_optimum_only(spark):
    from clickpath.plans import queries as Q
    from clickpath.sources.stage import stage

    s = stage(Q.sessions(spark, SF_SMALL, Q.LONG_GAP), "training-sessions")
    model, _, (train, _, _) = TR.fit_and_tune(s, "logistic_regression")
    slopes = {r.feature: r.gradient for r in TR.fit_gradient(model, train).collect()}
    assert set(slopes) == {*FEATURE_COLS, "intercept"}
    assert any(v is not None for v in slopes.values()) and all(v is None or abs(v) < Q.MAX_SLOPE for v in slopes.values())
    early = TR.build_pipeline("logistic_regression")
    early.getStages()[-1].setMaxIter(0)
    slopes = [r.gradient for r in TR.fit_gradient(early.fit(train), train).collect()]
    assert max(abs(v) for v in slopes if v is not None) > Q.MAX_SLOPE


def test_an_installed_threshold_moves_predictions_and_faults_are_counted(spark):
    from clickpath.plans import queries as Q
    from clickpath.sources.stage import stage

    s = stage(Q.sessions(spark, SF_SMALL, Q.LONG_GAP), "training-sessions")
    model, _, (_, _, test) = TR.fit_and_tune(s, "logistic_regression")
    positive = []
    for threshold in (0.0, 1.0):
        r = TR.threshold_faults(TR.install_threshold(model, threshold), threshold, test).first()
        assert r.n_faults == 0 and r.n_scored == test.count()
        positive.append(r.n_positive)
    assert positive == [test.count(), 0]
    assert TR.threshold_faults(model, 0.0, test).first().n_faults == test.count()  # installed at 1.0, judged at 0.0
