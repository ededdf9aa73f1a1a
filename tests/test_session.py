import pytest
from helpers import rows
from pyspark.sql import functions as F

from galley.functions.literals import constant_rows, empty_rows
from galley.operators.joins import byte_setting, estimated_bytes, sized
from galley.session import DEFAULTS, materialize, register_catalog, scratch_path, scratch_scope, shared_dir, warehouse_uri
from galley.sources import files


class _Session:
    """Stands in for a session without the setting."""

    def __init__(self, master, setting=None):
        self.master, self.setting, self.folder = master, setting, None
        self.conf = self.sparkContext = self

    def get(self, _key, default):
        return self.setting or default

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/id"


def test_the_cluster_names_the_shared_folder():
    assert shared_dir(_Session("yarn", "hdfs://nn/shared/")) == "hdfs://nn/shared"


def test_only_a_local_session_gets_a_folder_of_its_own():
    local = _Session("local[2]")
    assert shared_dir(local) == shared_dir(local) == local.folder
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_Session("local-cluster[2,1,1024]"))


def test_session_settings(spark):
    assert all(spark.conf.get(k) == v for k, v in DEFAULTS.items())


def test_warehouse_paths():
    assert warehouse_uri("/tmp/w/") == "file:///tmp/w"
    assert warehouse_uri("s3://b/w/") == "s3://b/w" and warehouse_uri("file:/x") == "file:/x"


def test_catalog_settings(spark):
    register_catalog(spark, "lake", {"impl": "some.Catalog", "type": "hadoop", "warehouse": "/tmp/w"})
    assert spark.conf.get("spark.sql.catalog.lake") == "some.Catalog"
    assert spark.conf.get("spark.sql.catalog.lake.warehouse") == "file:///tmp/w"
    for suffix in ("", ".type", ".warehouse"):
        spark.conf.unset(f"spark.sql.catalog.lake{suffix}")


def test_staged_copy(spark):
    df = spark.range(10).select(F.col("id"), (F.col("id") % 2).alias("kind"))
    path = scratch_path(spark, "t")
    staged = materialize(df, path=path, partition_by=("kind",))
    assert staged.columns == df.columns and rows(staged) == rows(df)
    assert path in staged.inputFiles()[0]
    files.delete(spark, path)


def test_literal_frames(spark):
    df = constant_rows(spark, [("a", 1), (None, 2)], "t string, n long")
    assert rows(df) == sorted([("a", 1), (None, 2)], key=repr) and estimated_bytes(df) < 10_000
    assert empty_rows(spark, df.schema).count() == 0
    assert constant_rows(spark, [], "t string").columns == ["t"]


@pytest.mark.parametrize("setting, size", [("-1", -1), ("10m", 10 << 20), ("64KB", 64 << 10), ("12b", 12), ("300", 300)])
def test_size_settings(spark, setting, size):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)
    try:
        assert byte_setting(spark, "spark.sql.autoBroadcastJoinThreshold", "0") == size
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_threshold_of_minus_one_forbids_broadcasts(spark):
    small = spark.range(10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sized(small) is small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staged_copies_end_with_their_scope(spark):
    with scratch_scope(spark):
        path = scratch_path(spark, "t")
        materialize(spark.range(3), path=path)
        with scratch_scope(spark):
            inner = scratch_path(spark, "t")
            materialize(spark.range(3), path=inner)
        assert files.exists(spark, path) and not files.exists(spark, inner)
    assert not files.exists(spark, path)
