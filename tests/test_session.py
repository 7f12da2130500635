from skewscope.plans.materialize import table_path
from skewscope.session import ensure_checkpoint_dir


def test_checkpoint_dir_is_kept_once_set(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first
    # Materialised tables live under that shared folder, never elsewhere.
    assert table_path(spark.range(1)).startswith(first.rstrip("/") + "/skewscope-tables/")
