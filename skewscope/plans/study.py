"""End-to-end study: label, split, remedy grid, selection, test, calibration.

Each stage is a DataFrame operator; the only driver-side values are a handful
of numbers (the quantile, class counts, fit times). Splits are materialised
once because every fit and scoring reads them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skewscope.operators import (balance, calibration, curves, evaluate, experiments, features, labels, metrics,
                                 models, report, resample, select, splits)
from skewscope.plans.materialize import drop_tables, materialize, written
from skewscope.plans.registry import FitRegistry
from skewscope.sinks import publish, writers
from skewscope.sources import batches, ledger


@dataclass
class PreparedData:
    frame: DataFrame         # key, group, label, features, split
    threshold: float | None
    train: DataFrame
    valid: DataFrame
    test: DataFrame
    train_all: DataFrame     # before any cap


def prepare(df: DataFrame, score_col: str, group_col: str, key_col: str, features_col: str = "features",
            p: float = 0.8, quantile: str = "disc", hash_method: str = "xxhash64",
            cap: int | None = None, seed: int = 42) -> PreparedData:
    """Label by the score quantile, split by group hash, optionally cap train (to exactly ``cap`` rows)."""
    q = labels.threshold_value(df, score_col, p, quantile)
    lab = labels.label_by_quantile(df, score_col, "label", threshold=q)
    lab = batches.drop_missing(lab, [features_col, score_col, "label"])
    framed = splits.assign_split(lab.select(key_col, group_col, "label", features_col), group_col,
                                 method=hash_method).drop("bucket")
    # One write, partitioned by split: each split read below prunes to its folder.
    framed = materialize(framed, partition_by=["split"])
    parts = splits.split_frames(framed)
    train = parts["train"]
    if cap:
        train = materialize(splits.cap_rows(train, cap, seed, "hash", key_col, exact=True))
    return PreparedData(framed, q, train, parts["valid"], parts["test"], parts["train"])


def weighted_lr_test_record(data: PreparedData, features_col: str = "features", policy: str = "mcc") -> DataFrame:
    """Flagship: class-weighted LR, MCC threshold on valid, test record at it."""
    train = resample.class_weights(data.train, "label", "weight")
    est = models.logistic_regression(features_col, "label", "weight")
    fitted, _ = models.fit_timed(est, train)
    name = experiments.model_key("lr", "weighted")
    valid = models.score_all({name: fitted}, data.valid)
    rec = metrics.evaluate_scores(valid, "label", "p1", group_cols=["model"], policy=policy)
    best = select.select_best(rec)
    test = models.score_all({name: fitted}, data.test)
    return select.test_at_best_threshold(best, test, "label", "p1")


@dataclass
class StudyResult:
    overall: DataFrame
    split_summary: DataFrame
    grid: experiments.GridResult
    best: DataFrame
    test_record: DataFrame
    calibration: DataFrame


def run_study(data: PreparedData, features_col: str = "features", key_col: str | None = None,
              families: Sequence[str] = ("lr", "rf"), bins: int = 10, policy: str = "mcc",
              rf_params: dict | None = None, parallelism: int = 4, lr_params: dict | None = None,
              registry=None) -> StudyResult:
    overall = balance.overall_balance(data.frame, "label")
    # Split statistics describe the frames the models use (train after any cap).
    used = (data.train.select("label", F.lit("train").alias("split"))
            .unionByName(data.valid.select("label", F.lit("valid").alias("split")))
            .unionByName(data.test.select("label", F.lit("test").alias("split"))))
    before = balance.split_summary(data.frame, "split", "label").select("split", F.col("rows").alias("rows_before_cap"))
    # Three rows each.
    summary = balance.split_summary(used, "split", "label").join(F.broadcast(before), "split")
    grid = experiments.strategy_grid(data.train, data.valid, "label", features_col, key_col=key_col,
                                     families=families, policy=policy, rf_params=rf_params, materialized=True,
                                     parallelism=parallelism, lr_params=lr_params, registry=registry)
    best = materialize(select.select_best(grid.metrics))
    found = best.first()
    if found is None:
        raise ValueError("no model could be evaluated: the validation split has no scored rows")
    best_name = found["best_model"]
    test = models.score_all({best_name: grid.fitted[best_name]}, data.test)
    test_rec = materialize(select.test_at_best_threshold(best, test, "label", "p1"))
    valid_best = grid.scored.where(F.col("model") == best_name)
    calib = calibration.calibration_table(valid_best, "label", "p1", bins)
    return StudyResult(overall, summary, grid, best, test_rec, calib)


def load_batches(spark, path: str, id_col: str, score_col: str, fmt: str = "csv", schema=None,
                 infer_schema: bool = False, min_columns: int = features.MIN_COLUMNS,
                 width: int = features.FP_WIDTH, stage: bool | None = None,
                 ledger_dir: str | None = None) -> tuple[DataFrame, str]:
    """Scan, drop rows missing id or score, cast the score, build ``features``.

    Text input is staged once to Parquet (``stage``, default on for CSV): gzip
    batches cannot be split and are otherwise parsed again by every later pass
    (two quantile passes and the split write), while the staged table lets the
    quantile passes read the score column alone. Raw feature columns are staged,
    not the assembled vectors: 0/1 columns compress far better. With ``ledger_dir`` the staged
    files of earlier runs are kept there and only new or changed files are read.
    """
    if ledger_dir:
        ledger.stage_new(spark, path, ledger_dir, fmt, schema, infer_schema)
        raw = ledger.staged(spark, ledger_dir).drop(ledger.FILE)
        stage = False if stage is None else stage
    else:
        raw = batches.scan_batches(spark, path, fmt=fmt, schema=schema, infer_schema=infer_schema)
    raw = batches.cast_score(batches.drop_missing(raw, [id_col, score_col]), score_col)
    if stage if stage is not None else fmt == "csv":
        raw = materialize(raw)
    return features.detect_layout(raw, min_columns=min_columns, width=width)


def write_outputs(out_dir: str, data: PreparedData, res: StudyResult, feature_mode: str,
                  scaling: DataFrame | None = None) -> None:
    """The study's artefacts as Spark-written folders under ``out_dir``."""
    out = out_dir.rstrip("/")
    valid = res.grid.metrics
    writers.write_json_text(writers.keyed_json(valid.select(*evaluate.VALID_FIELDS, "model_order"), "model",
                                               "model_order"), f"{out}/metrics_valid.json")
    writers.write_metrics_csv(valid, f"{out}/metrics_valid.csv")
    test = res.test_record.select(*evaluate.TEST_FIELDS)
    writers.write_json_text(writers.test_record_json(test), f"{out}/metrics_test.json")
    writers.write_metrics_csv(test, f"{out}/metrics_test.csv", test=True)
    overall = res.overall.withColumn("feature_mode", F.lit(feature_mode))
    writers.write_json_text(overall.select(F.to_json(F.struct(*overall.columns)).alias("json")),
                            f"{out}/class_balance_overall.json")
    summary = res.split_summary
    writers.write_json_text(writers.keyed_json(summary, "split", "split_order"), f"{out}/class_balance_by_split.json")
    writers.write_split_stats(summary, f"{out}/split_stats.txt")
    writers.write_calibration_csv(res.calibration, f"{out}/calibration_valid.csv")
    _write_curves_and_reports(out, res, valid, test)
    if scaling is not None and not scaling.isEmpty():
        series = select.scaling_series(scaling)
        writers.write_csv(series, f"{out}/scaling_series.csv", single_file=True)
        writers.write_csv(report.report_scaling_table(scaling), f"{out}/report_scaling.csv", single_file=True)
        writers.write_scaling_csv(scaling, f"{out}/scaling_results.csv")
        writers.write_json(scaling, f"{out}/scaling_results.json", single_file=True)


def _write_curves_and_reports(out: str, res: StudyResult, valid: DataFrame, test: DataFrame) -> None:
    """Curve points of every model on validation, the method comparisons and the report tables.

    Curve tables have a row per distinct score and stay in as many files as Spark makes; the others
    have a few rows per model.
    """
    best_name = res.best.first()["best_model"]
    points = materialize(curves.curve_points(curves.threshold_table(res.grid.scored, "label", "p1", ["model"]), ["model"]))
    writers.write_csv(points, f"{out}/curves_valid.csv")
    writers.write_csv(points.where(F.col("model") == best_name), f"{out}/curves_best_valid.csv")
    for name, table in (("compare_lr_strategies", select.compare_lr_strategies(valid)),
                        ("compare_lr_rf", select.compare_lr_rf(valid)),
                        ("report_metrics", report.report_metrics(valid)),
                        ("report_splits", report.report_split_table(res.split_summary)),
                        ("report_confusion", report.report_confusion_2x2(test))):
        writers.write_csv(table, f"{out}/{name}.csv", single_file=True)


def run_from_batches(spark, path: str, out_dir: str, id_col: str = "SMILES", score_col: str = "SA_score",
                     group_col: str | None = None, p: float = 0.8, quantile: str = "approx",
                     cap: int | None = 500_000, bins: int = 10,
                     scaling_sizes: Sequence[int] = (100_000, 500_000, 1_000_000), fmt: str = "csv",
                     schema=None, infer_schema: bool = False, min_columns: int = features.MIN_COLUMNS,
                     width: int = features.FP_WIDTH, parallelism: int = 1, rf_params: dict | None = None,
                     lr_params: dict | None = None, keep_tables: bool = False, ledger_dir: str | None = None,
                     models_dir: str | None = None, publish_set: bool = False) -> StudyResult:
    """Batches in, every artefact out: the whole imbalance study as Spark jobs.

    Groups come from ``group_col`` (empty or null values fall back to the
    record id); without it every record is its own group. ``cap`` bounds the rows
    that fit the grid; the scaling study samples the whole training split.
    The tables written on the way are dropped at the end unless ``keep_tables``
    is set; without it the frames of the result can no longer be read.

    For studies that run again and again, folders on shared storage: ``ledger_dir`` stages only files that are new or changed since
    the last run, ``models_dir`` keeps finished fits, so a run that is started again fits only what is missing, and
    ``publish_set`` makes the artefacts under ``out_dir`` visible all at once (``sinks.publish``).
    """
    mark = written()
    registry = FitRegistry(spark, models_dir) if models_dir else None
    df, mode = load_batches(spark, path, id_col, score_col, fmt, schema, infer_schema, min_columns, width, ledger_dir=ledger_dir)
    if group_col:
        df = splits.group_key(df, group_col, id_col, out="_group")
    else:
        df = df.withColumn("_group", F.col(id_col).cast("string"))
    data = prepare(df, score_col, "_group", id_col, p=p, quantile=quantile, cap=cap)
    res = run_study(data, key_col=id_col, bins=bins, rf_params=rf_params, parallelism=parallelism,
                    lr_params=lr_params, registry=registry)
    scaling = experiments.scaling_study(data.train_all, data.valid, list(scaling_sizes), "label", "features",
                                        key_col=id_col, rf_params=rf_params, lr_params=lr_params, materialized=True,
                                        registry=registry)
    if publish_set:
        publish.publish(spark, out_dir, lambda folder: write_outputs(folder, data, res, mode, scaling))
    else:
        write_outputs(out_dir, data, res, mode, scaling)
    if not keep_tables:
        drop_tables(spark, mark)
    return res
