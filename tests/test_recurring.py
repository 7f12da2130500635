"""Batches that arrive, restarted fits and published sets, with runs that break off."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from skewscope.operators import experiments, models, quantile_sketch
from skewscope.plans import files
from skewscope.plans.registry import FitRegistry, fingerprint
from skewscope.sinks import publish
from skewscope.sources import ledger

SCHEMA = "k long, v double"


def test_sketches_of_earlier_batches_are_not_made_again(spark, tmp_path):
    rng = np.random.default_rng(2)
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    values = []

    def arrive(names):
        for name in names:
            some = rng.lognormal(size=int(rng.integers(500, 9000))) + len(values) / 5000  # later batches lie higher
            values.extend(some.tolist())
            spark.createDataFrame([(float(x),) for x in some] + [(None,), (float("nan"),)], "v double").write.parquet(f"{source}/batch={name}")

    arrive(["a", "b", "c"])
    assert quantile_sketch.add_batches(spark.read.parquet(source), store, "v", "batch") == 3
    assert quantile_sketch.add_batches(spark.read.parquet(source), store, "v", "batch") == 0
    files.delete(spark, f"{source}/batch=a")  # not needed any more
    arrive(["d"])
    assert quantile_sketch.add_batches(spark.read.parquet(source), store, "v", "batch") == 1
    stored = quantile_sketch.stored(spark, store)
    assert stored.count() == 4 and stored.agg(F.sum("n")).first()[0] == len(values)
    order = np.sort(values)
    for r in quantile_sketch.quantiles(stored, [0.01, 0.25, 0.5, 0.8, 0.99]).collect():
        assert abs(np.searchsorted(order, r["value"], "right") - r["p"] * len(order)) <= 0.01 * len(order)
    assert quantile_sketch.quantile(stored.limit(0)) is None


def _file(spark, path, ids):
    spark.createDataFrame([(int(k), k / 2) for k in ids], SCHEMA).coalesce(1).write.mode("overwrite").option("header", True).csv(
        path, compression="gzip")


def test_ledger_stages_new_changed_and_broken(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "staged")
    glob = f"{source}/*/*.csv.gz"
    for name, ids in (("a", range(10)), ("b b", range(10, 30)), ("c", [])):
        _file(spark, str(source / name), ids)
    stage = lambda: ledger.stage_new(spark, glob, root, schema=SCHEMA)
    ids = lambda: sorted(r["k"] for r in ledger.staged(spark, root).collect())
    first = stage()
    assert first >= 2 and ids() == list(range(30)) and stage() == 0
    _file(spark, str(source / "d"), range(30, 33))
    # A stage that broke off: rows without a ledger row.
    spark.createDataFrame([(999, 1.0, "x")], "k long, v double, _file string").write.parquet(f"{root}/batches/broken")
    assert ids() == list(range(30)) and stage() == 1 and ids() == list(range(33))
    assert ledger.sweep(spark, root) == 1 and ids() == list(range(33))
    # A file with new content replaces its rows.
    path = next((source / "a").glob("*.csv.gz"))
    _file(spark, str(tmp_path / "other"), range(100, 107))
    path.write_bytes(next((tmp_path / "other").glob("*.csv.gz")).read_bytes())
    (source / "a" / f".{path.name}.crc").unlink()
    assert stage() == 1 and ids() == [*range(10, 33), *range(100, 107)]
    assert ledger.mismatches(spark, root).count() == 0
    # Rows that are not those that were staged are found.
    batch = ledger.current(spark, root).where("n_rows = 3").first()["batch"]
    rows = spark.read.parquet(f"{root}/batches/{batch}").collect()
    spark.createDataFrame(rows, "k long, v double, _file string").withColumn("v", F.col("v") + 1).write.mode("overwrite").parquet(f"{root}/batches/{batch}")
    assert ledger.mismatches(spark, root).count() == 1


def test_nothing_staged(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ledger.staged(spark, str(tmp_path / "none"))


@pytest.fixture(scope="module")
def train(spark):
    x = F.array(*[F.sin(F.col("id") * k).cast("double") for k in (1, 2, 3)])
    return spark.range(300).select(F.col("id").cast("string").alias("key"), (F.sin(F.col("id") * 1.0) > 0.5).cast("int").alias("label"),
                                   array_to_vector(x).alias("features")).cache()


def test_restarted_grid_fits_what_is_missing(spark, train, tmp_path, monkeypatch):
    root = str(tmp_path / "models")
    kw = dict(key_col="key", rf_params={"num_trees": 2, "max_depth": 3}, lr_params={"max_iter": 20})
    whole = experiments.strategy_grid(train, train, **kw).metrics.drop("fit_time_s").collect()
    broken = FitRegistry(spark, root)
    real, done = FitRegistry.fit, []

    def fail_at_fourth(self, est, df, name="model"):
        if len(done) == 3:
            raise RuntimeError("lost")
        done.append(name)
        return real(self, est, df, name)

    monkeypatch.setattr(FitRegistry, "fit", fail_at_fourth)
    with pytest.raises(RuntimeError):
        experiments.strategy_grid(train, train, registry=broken, **kw)
    monkeypatch.setattr(FitRegistry, "fit", real)
    again = FitRegistry(spark, root)
    grid = experiments.strategy_grid(train, train, registry=again, **kw)
    assert again.reused == done and len(again.fitted) == 5
    assert grid.metrics.drop("fit_time_s").collect() == whole
    once_more = FitRegistry(spark, root)
    experiments.strategy_grid(train, train, registry=once_more, parallelism=3, **kw)
    assert not once_more.fitted and len(once_more.reused) == 8


def test_other_rows_or_parameters_are_other_fits(spark, train, tmp_path):
    reg = FitRegistry(spark, str(tmp_path / "models"))
    est = models.logistic_regression(max_iter=3)
    assert reg.key(est, train) == reg.key(est.copy(), train.repartition(5))
    keys = {reg.key(est, train), reg.key(models.logistic_regression(max_iter=4), train), reg.key(est, train.where("key <> '7'")),
            reg.key(est, train.unionByName(train)), reg.key(models.random_forest(), train)}
    assert len(keys) == 5
    assert fingerprint(train, ["label", "features"]) != fingerprint(train.withColumn("label", 1 - F.col("label")), ["label", "features"])
    # A model without its entry (the run broke off between the two) is fitted again.
    reg.fit(est, train)
    files.delete(spark, f"{reg.root}/entries")
    later = FitRegistry(spark, reg.root)
    later.fit(est, train)
    assert later.fitted == ["model"]


def test_readers_see_whole_sets_only(spark, tmp_path):
    out = str(tmp_path / "out")
    assert publish.current(spark, out) is None

    def write(numbers, fail=False):
        def run(folder):
            spark.range(numbers).write.csv(f"{folder}/a.csv")
            # While the second artefact is being written, readers still have the last set.
            before = publish.current(spark, out)
            assert before is None or before["artefacts"]["a.csv"]["lines"] != numbers
            if fail:
                raise RuntimeError("lost")
            spark.range(numbers + 1).selectExpr("id AS b").write.json(f"{folder}/b.json")
        return run

    publish.publish(spark, out, write(5))
    with pytest.raises(RuntimeError):
        publish.publish(spark, out, write(50, fail=True))
    assert {r["artefact"]: (r["lines"], r["intact"]) for r in publish.verify(spark, out).collect()} == {"a.csv": (5, True), "b.json": (6, True)}
    publish.publish(spark, out, write(7))
    assert publish.current(spark, out)["number"] == 2 and spark.read.csv(publish.artefact(spark, out, "a.csv")).count() == 7
    assert publish.sweep(spark, out, keep=1) == 2 and publish.verify(spark, out).where("intact").count() == 2
    spark.range(3).write.mode("append").csv(publish.artefact(spark, out, "a.csv"))
    assert [r["artefact"] for r in publish.verify(spark, out).where("NOT intact").collect()] == ["a.csv"]
    with pytest.raises(FileNotFoundError):
        publish.artefact(spark, out, "c.csv")
