"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every run relies on. Partition counts are left to AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Date folders are zero-padded text: month=02 must not come back as 2.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime defaults to an existing session."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app_name: str = "galley", catalogs: dict[str, dict[str, str]] | None = None) -> SparkSession:
    """Build (or reuse) a session; ``catalogs`` maps a catalog name to its settings.

    Each entry becomes ``spark.sql.catalog.<name>`` (key ``impl``) and
    ``spark.sql.catalog.<name>.<key>``, which is how a row-level table format is plugged in.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for name, settings in (catalogs or {}).items():
        register_catalog(spark, name, settings)
    return configure(spark)


def register_catalog(spark: SparkSession, name: str, settings: dict[str, str], namespace: str | None = None) -> None:
    """Point catalog ``name`` at its implementation and create ``namespace`` if asked."""
    for key, value in settings.items():
        conf = f"spark.sql.catalog.{name}" + ("" if key == "impl" else f".{key}")
        spark.conf.set(conf, warehouse_uri(value) if key == "warehouse" else value)
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS `{name}`.`{namespace}`")


def warehouse_uri(path: str) -> str:
    """A plain absolute path becomes a ``file:`` URI; anything with a scheme is kept."""
    path = path.rstrip("/")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    master = spark.sparkContext.master
    if not folder:
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="galley-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def scratch_root(spark: SparkSession) -> str:
    """This application's own corner of the shared folder; a job deletes it when it ends."""
    return f"{shared_dir(spark)}/galley/{spark.sparkContext.applicationId}"


_scope: ContextVar[str] = ContextVar("scratch_scope", default="")


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Staged copies made inside are deleted at the end; nothing lazy may be read from them later."""
    from galley.sources import files

    name = f"scope-{uuid.uuid4().hex}/"
    token = _scope.set(_scope.get() + name)
    try:
        yield
    finally:
        files.delete(spark, f"{scratch_root(spark)}/{_scope.get()}".rstrip("/"))
        _scope.reset(token)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{scratch_root(spark)}/{_scope.get()}{label}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, label: str = "stage", path: str | None = None, partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a form that survives lost executors, and unlike a checkpoint
    the copy is columnar: later readers prune columns and Spark knows its size.
    """
    path = path or scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)
