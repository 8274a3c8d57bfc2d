"""Session helpers: shared scratch folders live under spark.checkpoint.dir."""

from stationflow.session import (
    BROADCAST_MAX_ROWS_DEFAULT, broadcast_max_rows, ensure_checkpoint_dir, shared_path,
)


def test_shared_paths_are_unique_and_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    a, b = shared_path(spark, "x"), shared_path(spark, "x")
    assert a != b and a.startswith(base.rstrip("/") + "/stationflow/x/")
    assert shared_path(spark, "fixed", unique=False).endswith("/stationflow/fixed")


def test_session_defaults(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert broadcast_max_rows(spark) == BROADCAST_MAX_ROWS_DEFAULT


def test_only_local_masters_may_use_a_private_folder():
    from stationflow.session import local_master
    assert local_master("local") and local_master("local[8]")
    assert not any(map(local_master, ("yarn", "spark://h:7077", "local-cluster[3,2,3000]", "k8s://x")))
