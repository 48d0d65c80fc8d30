"""Where intermediate tables go: the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# folders of local-mode sessions without the setting, and what each application has been given, by application
_LOCAL: dict[str, str] = {}
_GIVEN: dict[str, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, read from `spark.checkpoint.dir`.

    Only a local-mode session may go without the setting; it then gets a folder of its own.
    """
    sc = spark.sparkContext
    root = spark.conf.get(_SETTING, None) or sc.getConf().get(_SETTING)
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
    if sc.applicationId not in _LOCAL:
        _LOCAL[sc.applicationId] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL[sc.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _GIVEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back, which cuts its lineage. `by` is a column to make folders of.

    The shuffle files behind it are of no more use then, and go as soon as it is written.
    """
    spark = df.sparkSession
    path, before = fresh_path(spark, label), spark.conf.get(_RELEASE, None)
    spark.conf.set(_RELEASE, "true")
    try:
        (df.write.partitionBy(by) if by else df.write).parquet(path)
    finally:
        spark.conf.unset(_RELEASE) if before is None else spark.conf.set(_RELEASE, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def _delete(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*stored: DataFrame) -> None:
    """Delete tables that `materialize` has returned and that nothing reads any more."""
    for df in stored:
        spark = df.sparkSession
        _GIVEN[spark.sparkContext.applicationId].remove(df._tidemark_path)
        _delete(spark, df._tidemark_path)


def clean_up(spark: SparkSession) -> int:
    """Delete what this application wrote below the shared folder; returns the number of paths that were there.

    Frames that read such a table cannot be computed afterwards, so call it when their results are stored.
    """
    given, gone = _GIVEN.pop(spark.sparkContext.applicationId, []), 0
    for path in given:
        gone += bool(_delete(spark, path))
    return gone
