"""Runs that come again: batches that arrive, restarted fits and published outputs (rows 1, 2, 6, 14, 36, 58-60).

The queries write the given tables as batch files or outputs under the shared checkpoint folder and read them back.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from skewscope.catalog._registry import register, rounded
from skewscope.catalog.exact import GRID, RECORD, TREES, _record, banded_splits
from skewscope.catalog.fixtures import scored_lineitem
from skewscope.catalog.metrics import CALIB_SQL
from skewscope.catalog.sampling import _SCALING
from skewscope.catalog.selection import METRICS_SQL, _valid_metrics
from skewscope.operators import calibration as calib
from skewscope.operators import evaluate, experiments, features, models, quantile_sketch, select
from skewscope.plans.materialize import materialize, scratch_path, session_with
from skewscope.plans.registry import FitRegistry
from skewscope.sinks import publish, writers
from skewscope.sources import batches, ledger
from skewscope.sources.tables import table

PROBABILITIES = (0.05, 0.2, 0.5, 0.8, 0.95)
RANK_ERROR = 0.01
FILES, FIRST_FILES = 8, 5
_BATCH = "CAST(l_suppkey % 8 AS INTEGER)"
_CSV = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag")


@register("quantile_of_arriving_batches", f"""
SELECT CAST(f.added AS INTEGER) AS added, f.run, p.p, f.n AS n_rows, TRUE AS within_error
FROM (SELECT 1 AS run, {FIRST_FILES} AS added, count(*) FILTER ({_BATCH} < {FIRST_FILES}) AS n FROM lineitem
      UNION ALL SELECT 2, {FILES - FIRST_FILES}, count(*) FROM lineitem) f, (SELECT unnest({[float(p) for p in PROBABILITIES]}::DOUBLE[]) AS p) p""")
def quantile_of_arriving_batches(spark, sf):
    """Five batches, then eight of which three are new: quantiles from the stored sketches against ranks in all rows so far."""
    li = table(spark, sf, "lineitem").select(F.expr(_BATCH).alias("batch"), "l_extendedprice")
    store, out = f"{scratch_path(spark)}/sketches", None
    for run, rows in ((1, li.where(F.col("batch") < FIRST_FILES)), (2, li)):
        added = quantile_sketch.add_batches(rows, store, "l_extendedprice", "batch")
        got = quantile_sketch.quantiles(quantile_sketch.stored(spark, store), PROBABILITIES).collect()
        ranks = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col("l_extendedprice") <= r["value"], 1)).alias(f"r{k}")
                                                         for k, r in enumerate(got)])
        each = F.explode(F.array(*[F.struct(F.lit(r["p"]).alias("p"), F.col(f"r{k}").alias("rank")) for k, r in enumerate(got)]))
        one = ranks.select("n", each.alias("q")).select(
            F.lit(added).alias("added"), F.lit(run).alias("run"), "q.p", F.col("n").alias("n_rows"),
            (F.abs(F.col("q.rank") - F.col("q.p") * F.col("n")) <= RANK_ERROR * F.col("n")).alias("within_error"))
        out = one if out is None else out.unionByName(one)
    return out


#: Rows of one CSV.gz file, which one task writes and one task reads.
CSV_ROWS = 1_000_000


def _write_csv_batches(spark, sf, rows_per_file: int | None = None) -> str:
    """lineitem as CSV.gz batches; the folder of batch k is ``batch=k``. One file per batch, or files of about ``rows_per_file`` rows.

    Every file has a task of its own, which writes rows as they come: with a writer per folder they need not be sorted by it.
    """
    path = scratch_path(spark)
    own = session_with(spark, spark_sql_maxConcurrentOutputFileWriters=str(FILES))
    li = table(own, sf, "lineitem").select(*_CSV, F.expr(_BATCH).alias("batch"))
    parts = math.ceil(li.count() / (FILES * rows_per_file)) or 1 if rows_per_file else 1
    part = F.pmod(F.xxhash64(*_CSV), F.lit(parts)).cast("int")
    task = F.pmod(F.coalesce("batch", F.lit(0)), F.lit(FILES)) * parts + part
    li.repartitionById(FILES * parts, task).write.partitionBy("batch").option("header", True).csv(path, compression="gzip")
    return path


@register("stage_ledger", f"""
WITH b AS (SELECT {_BATCH} AS batch, l_orderkey, l_partkey, l_extendedprice FROM lineitem),
r AS (SELECT * FROM (VALUES (1, {FIRST_FILES}, {FIRST_FILES}), (2, {FILES}, {FILES - FIRST_FILES}), (3, {FILES}, 0), (4, {FILES}, 0)) r(run, upto, new_files))
SELECT CAST(run AS INTEGER) AS run, CAST(new_files AS INTEGER) AS new_files, count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS keys,
       round(sum(l_extendedprice), 2) AS price, 0::BIGINT AS mismatched
FROM r JOIN b ON b.batch < r.upto GROUP BY run, new_files""")
def stage_ledger(spark, sf):
    """CSV.gz files staged in four runs: five, three more, none, and none after a stage that broke off."""
    path, root = _write_csv_batches(spark, sf), scratch_path(spark)
    some, every = f"{path}/batch=[0-{FIRST_FILES - 1}]/*.csv.gz", f"{path}/batch=*/*.csv.gz"
    out = None
    for run, glob in ((1, some), (2, every), (3, every), (4, every)):
        if run == 4:  # a folder that no ledger row names: its rows must not be seen
            ledger.staged(spark, root).write.parquet(f"{root}/batches/broken")
        new = ledger.stage_new(spark, glob, root, schema="l_orderkey long, l_linenumber int, l_partkey long, l_extendedprice double, l_returnflag string")
        bad = ledger.mismatches(spark, root).count()
        one = ledger.staged(spark, root).agg(F.count(F.lit(1)).alias("n_rows"), F.sum("l_orderkey").alias("keys"),
                                             F.round(F.sum("l_extendedprice"), 2).alias("price"))
        one = one.select(F.lit(run).alias("run"), F.lit(new).alias("new_files"), "n_rows", "keys", "price",
                         F.lit(bad).cast("long").alias("mismatched"))
        out = one if out is None else out.unionByName(one)
    return out


@register("scan_csv_batches", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_returnflag FROM lineitem""")
def scan_csv_batches(spark, sf):
    """lineitem written as CSV.gz batches and scanned by a glob with a declared schema."""
    path = _write_csv_batches(spark, sf, CSV_ROWS)
    schema = "l_orderkey long, l_linenumber int, l_partkey long, l_extendedprice double, l_returnflag string"
    return batches.scan_batches(spark, f"{path}/batch=*/*.csv.gz", schema=schema)


@register("infer_schema", """
SELECT position, name, type, (SELECT count(*) FROM lineitem) AS present
FROM (VALUES (0, 'l_orderkey', 'int'), (1, 'l_linenumber', 'int'), (2, 'l_partkey', 'int'), (3, 'l_extendedprice', 'double'),
             (4, 'l_returnflag', 'string'), (5, 'batch', 'int')) t(position, name, type)""")
def infer_schema(spark, sf):
    """Types found in CSV text by an inference pass, and how many values each column then has."""
    path = _write_csv_batches(spark, sf, CSV_ROWS)
    found = batches.scan_batches(spark, path, infer_schema=True)
    each = F.array(*[F.struct(F.lit(k).alias("position"), F.lit(c).alias("name"), F.lit(t).alias("type"), F.col(f"n{k}").alias("present"))
                     for k, (c, t) in enumerate(found.dtypes)])
    return found.agg(*[F.count(c).alias(f"n{k}") for k, c in enumerate(found.columns)]).select(F.inline(each))


@register("feature_order", """
SELECT CAST(row_number() OVER (ORDER BY l_quantity) - 1 AS INTEGER) AS position, 'fp_' || CAST(l_quantity AS INTEGER) AS name,
       count(*) * 1e0 AS value
FROM lineitem GROUP BY l_quantity""")
def feature_order(spark, sf):
    """One column fp_<quantity> per quantity (their table has them in text order): assembled by number."""
    names = F.concat(F.lit("fp_"), F.col("l_quantity").cast("int").cast("string"))
    wide = table(spark, sf, "lineitem").select(names.alias("name")).groupBy().pivot("name").count()
    cols = features.fp_columns(wide.columns)
    wide = features.assemble(wide.select(*[F.col(c).cast("double") for c in wide.columns]), cols)
    named = F.arrays_zip(vector_to_array("features").alias("value"), F.array(*map(F.lit, cols)).alias("name"))
    return wide.select(F.posexplode(named).alias("position", "x")).select("position", "x.name", "x.value")


@register("grid_restart", GRID + RECORD.replace("\nFROM k", ", k.model LIKE 'logistic%' AS reused\nFROM k"))
def grid_restart(spark, sf):
    """The grid after a run that had finished its four logistic regressions: those are loaded, the forests fitted."""
    s = banded_splits(spark, sf)
    root = scratch_path(spark)
    # Both runs read the same saved splits, as two runs of a study do.
    train = models.training_table(s["train"].select("key", "label", "features"))
    valid = materialize(s["valid"].select("label", "features"))
    experiments.strategy_grid(train, valid, "label", "features", key_col="key", families=("lr",),
                              materialized=True, registry=FitRegistry(spark, root))
    again = FitRegistry(spark, root)
    grid = experiments.strategy_grid(train, valid, "label", "features", key_col="key", rf_params=TREES,
                                     materialized=True, registry=again)
    return _record(grid.metrics).withColumn("reused", F.col("model").isin(again.reused))


def _published(spark, write) -> str:
    """Publish twice: the second set is the one that readers see."""
    out = scratch_path(spark)
    publish.publish(spark, out, lambda folder: spark.range(3).write.csv(f"{folder}/old.csv"))
    publish.publish(spark, out, write)
    return out


_SINK_FIELDS = ("PR_AUC", "ROC_AUC", "precision", "recall", "f1", "balanced_accuracy", "MCC")


def _sink_metrics(spark, sf):
    rec = _valid_metrics(spark, sf).withColumn("fit_time_s", F.lit(0.0))
    return evaluate.order_validation_record(rec)


_SINK_SQL = METRICS_SQL + "\nSELECT model, " + ", ".join(_SINK_FIELDS) + ", opt_threshold, TRUE AS intact FROM mt"


@register("sink_metrics_csv", _SINK_SQL)
def sink_metrics_csv(spark, sf):
    """metrics_valid.csv of a published set, read back with its own header."""
    rec = _sink_metrics(spark, sf)
    out = _published(spark, lambda folder: writers.write_metrics_csv(rec, f"{folder}/metrics_valid.csv"))
    intact = publish.verify(spark, out).agg(F.min("intact").alias("i")).first()["i"]
    read = spark.read.option("header", True).csv(publish.artefact(spark, out, "metrics_valid.csv"))
    assert read.columns == evaluate.VALID_FIELDS
    return read.select("model", *[F.col(c).cast("double").alias(c) for c in (*_SINK_FIELDS, "opt_threshold")], F.lit(intact).alias("intact"))


@register("sink_metrics_json", _SINK_SQL)
def sink_metrics_json(spark, sf):
    """metrics_valid.json of a published set: one object keyed by model."""
    rec = _sink_metrics(spark, sf)
    out = _published(spark, lambda folder: writers.write_json_text(
        writers.keyed_json(rec.select(*evaluate.VALID_FIELDS, "model_order"), "model", "model_order"), f"{folder}/metrics_valid.json"))
    intact = publish.verify(spark, out).agg(F.min("intact").alias("i")).first()["i"]
    one = "struct<" + ",".join(f"{c}:double" for c in (*_SINK_FIELDS, "opt_threshold")) + ">"
    text = spark.read.text(publish.artefact(spark, out, "metrics_valid.json"), wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string,{one}>")).alias("model", "r")).select(
        "model", *[f"r.{c}" for c in (*_SINK_FIELDS, "opt_threshold")], F.lit(intact).alias("intact"))


@register("sink_calibration_csv", CALIB_SQL + "\nSELECT bin, mean_pred, empirical_pos_rate, count FROM cal")
def sink_calibration_csv(spark, sf):
    calibrated = calib.calibration_table(scored_lineitem(spark, sf), "y", "p1", 10)
    out = _published(spark, lambda folder: writers.write_calibration_csv(calibrated, f"{folder}/calibration_valid.csv"))
    read = spark.read.option("header", True).csv(publish.artefact(spark, out, "calibration_valid.csv"))
    return rounded(read.select("bin", F.col("mean_pred").cast("double"), F.col("empirical_pos_rate").cast("double"), F.col("count").cast("long")))


@register("sink_scaling_csv", _SCALING.replace("SELECT model, size, size AS train_rows, round(PR_AUC, 4) AS pr_auc FROM a",
                                               "SELECT model, size AS train_rows, round(PR_AUC, 4) AS pr_auc FROM a"))
def sink_scaling_csv(spark, sf):
    from skewscope.catalog.sampling import scaling_records

    runs = scaling_records(spark, sf).withColumn("train_time_s", F.lit(0.0)).select(*writers.SCALING_FIELDS)
    out = _published(spark, lambda folder: writers.write_scaling_csv(runs, f"{folder}/scaling_results.csv"))
    read = spark.read.option("header", True).csv(publish.artefact(spark, out, "scaling_results.csv"))
    return read.select("model", F.col("train_rows").cast("long"), F.col("pr_auc").cast("double"))


@register("sink_test_json", METRICS_SQL + "\nSELECT model AS best_model, PR_AUC, opt_threshold FROM mt ORDER BY PR_AUC DESC, model_order LIMIT 1")
def sink_test_json(spark, sf):
    """metrics_test.json of the chosen model, read back."""
    best = select.select_best(_valid_metrics(spark, sf))
    record = best.select(F.col("best_model").alias("model"), "PR_AUC", "opt_threshold")
    out = _published(spark, lambda folder: writers.write_json_text(writers.test_record_json(record), f"{folder}/metrics_test.json"))
    text = spark.read.text(publish.artefact(spark, out, "metrics_test.json"))
    got = F.from_json("value", "best_model string, metrics struct<PR_AUC:double,opt_threshold:double>").alias("r")
    return text.select(got).select("r.best_model", "r.metrics.PR_AUC", "r.metrics.opt_threshold")
