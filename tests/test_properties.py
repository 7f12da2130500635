"""Property tests: the distributed threshold table against brute force on small inputs."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from skewscope.operators import curves, metrics

CASES = st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=0, max_size=40)


def brute(rows):
    """Tie-collapsed metrics by direct counting at every distinct score."""
    y = np.array([r[0] for r in rows], dtype=int)
    s = np.array([r[1] / 6 for r in rows], dtype=float)
    P, N = int(y.sum()), len(y) - int(y.sum())
    ap = roc = 0.0
    best = (None, 0.5)
    for t in sorted(set(s.tolist()), reverse=True):
        sel = s >= t
        tp, fp = int(y[sel].sum()), int(sel.sum() - y[sel].sum())
        at = s == t
        pos, n = int(y[at].sum()), int(at.sum())
        if P:
            ap += tp / (tp + fp) * pos / P
        if P and N:
            roc += (n - pos) / N * (2 * tp - pos) / (2 * P)
        pf, nf = max(P, 1), max(N, 1)
        fn, tn = pf - tp, nf - fp
        d = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
        m = round(0.0 if d == 0 else (tp * tn - fp * fn) / math.sqrt(d), 9)
        if m > -1 and (best[0] is None or m > best[0]):
            best = (m, t)
    tp5 = int(y[s >= 0.5].sum())
    return ap, roc, best[1], tp5


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=CASES, rpr=st.sampled_from([2, 3, 1000]))
def test_threshold_table_matches_brute_force(spark, rows, rpr):
    df = spark.createDataFrame([(a, b / 6) for a, b in rows], "y int, p1 double")
    rec = metrics.evaluate_scores(df, "y", "p1", policy="mcc", rows_per_range=rpr, reuse=False).first()
    ap, roc, t, tp5 = brute(rows)
    assert rec["PR_AUC"] == pytest.approx(ap, abs=1e-9)
    assert rec["ROC_AUC"] == pytest.approx(roc, abs=1e-9)
    assert rec["opt_threshold"] == pytest.approx(t)
    assert rec["TP"] == tp5
    assert rec["TP"] + rec["FP"] + rec["TN"] + rec["FN"] == len(rows)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=CASES)
def test_curve_points_are_monotone(spark, rows):
    df = spark.createDataFrame([(a, b / 6) for a, b in rows], "y int, p1 double")
    pts = curves.curve_points(curves.threshold_table(df, "y", "p1", reuse=False)).orderBy("threshold").collect()
    tprs = [p["tpr"] for p in pts][::-1]
    fprs = [p["fpr"] for p in pts][::-1]
    assert tprs == sorted(tprs) and fprs == sorted(fprs)
    assert all(0 <= p["precision"] <= 1 and 0 <= p["recall"] <= 1 for p in pts)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-5, 5), min_size=1, max_size=60),
       p=st.sampled_from([0.0, 0.05, 0.5, 0.8, 0.95, 1.0]))
def test_exact_quantile_matches_numpy(spark, values, p):
    from skewscope.operators import labels
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    xs = np.sort(np.array(values, dtype=float))
    disc = xs[max(math.ceil(len(xs) * p), 1) - 1]
    assert labels.threshold_value(df, "x", p, "disc") == disc
    assert labels.threshold_value(df, "x", p, "cont") == pytest.approx(float(np.quantile(xs, p)), abs=1e-9)
