import pytest

from tallyhouse.session import (
    SESSION_CONF,
    drop_path,
    scratch_path,
    shared_dir,
    sizing_conf,
    write_through,
)


def test_session_settings(spark):
    for key, value in SESSION_CONF.items():
        assert spark.conf.get(key) == value


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_round_trip(spark):
    stored, path = write_through(spark.range(10), "numbers")
    assert sorted(r.id for r in stored.collect()) == list(range(10))
    assert "Range" not in stored._jdf.queryExecution().optimizedPlan().toString()
    drop_path(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_sizing():
    assert sizing_conf(0)["spark.sql.shuffle.partitions"] == "200"
    assert sizing_conf(100 * 2**40)["spark.sql.shuffle.partitions"] == str(100 * 2**40 // 2**28)
