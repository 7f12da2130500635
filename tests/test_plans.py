"""Plan guards over the queries whose plans join or aggregate in stages (final plans, built at sf0.001)."""

import __spark_entry__ as entry
from tests.conftest import SF001

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")
# The queries whose plans hold joins, windows or multi-stage aggregates.
JOINING = ["split_summary", "calibration", "drop_missing", "curves_by_model", "compare_lr_rf", "scaling_series",
           "roc_curve_points", "evaluate_split", "label_shares", "oversample", "report_split_table", "evaluate_null_groups",
           "calibration_null_groups", "number_within_key", "sample_repeated_keys", "cap_exact", "exact_sample_tied", "nested_samples",
           "forest_walk", "fit_lr_gradient", "stage_ledger"]


def test_no_cross_joins_and_pruned_scans(spark):
    qs = entry.queries()
    bad = []
    for name in JOINING:
        plan = qs[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        bad += [f"{name}: {op}" for op in FORBIDDEN if op in plan]
        # Every table scan reads a pruned schema, never all 11 lineitem columns.
        assert "l_shipdate" not in plan, name
    assert not bad, bad


def test_one_prediction_per_model_and_row(spark):
    from skewscope.catalog.fixtures import embedding_splits
    from skewscope.operators import models

    s = embedding_splits(spark, SF001)
    fitted, _ = models.fit_timed(models.logistic_regression(max_iter=2), s["train"])
    scored = models.score_all({"a": fitted, "b": fitted}, s["valid"])
    assert scored.count() == 2 * s["valid"].count()
    plan = scored.where("p1 > 0.5").groupBy("model").count()._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan
