"""Intermediate tables in the shared folder, and the package on Python workers."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_local: list[str] = []


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when it isn't installed on them.

    On a cluster the package travels as ``--py-files`` or is installed; here the folder it was
    imported from is added to the workers' path.
    """
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if _root not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (have, _root) if x)


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Where that is unset, a temporary folder in local mode and a folder beside the warehouse
    otherwise, so that no machine-local folder is ever used on a cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        return "file://" + _local_dir()
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tamarack"


def _local_dir() -> str:
    if not _local:
        made = tempfile.TemporaryDirectory(prefix="tamarack-")
        atexit.register(made.cleanup)
        _local.append(made.name)
    return _local[0]


def temporary(spark: SparkSession, path: str) -> str:
    """``path``, which goes with the driver."""
    p, fs = _located(spark, path)
    fs.deleteOnExit(p)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _located(spark, path)
    return fs.exists(p)


def materialize(df: DataFrame, partition_by: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder, a folder for each value of ``partition_by``, and read it back;
    ``options`` are Parquet's.

    This cuts the lineage and survives lost executors; as Parquet it also tells Catalyst its size.  Tables that
    ``df`` alone reads (:func:`uses`) are deleted once it is written.
    """
    spark = df.sparkSession
    read = getattr(df, "_tamarack_uses", ())
    df = df.withColumns({c: F.col(f"`{c}`").cast("string") for c, kind in df.dtypes if kind == "void"})
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path, partitionBy=partition_by)
    out = spark.read.schema(df.schema).parquet(path)
    out._tamarack_path = path  # type: ignore[attr-defined]
    p, fs = _located(spark, path)
    fs.deleteOnExit(p)  # what is not discarded goes with the driver
    discard(*read)
    return out


def uses(df: DataFrame, *tables: DataFrame) -> DataFrame:
    """``df``, which reads ``tables`` of :func:`materialize` when it runs."""
    df._tamarack_uses = (*getattr(df, "_tamarack_uses", ()), *tables)  # type: ignore[attr-defined]
    return df


def _located(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialize` wrote, once nothing reads them any more."""
    for df in tables:
        path = getattr(df, "_tamarack_path", None)
        if path:
            p, fs = _located(df.sparkSession, path)
            fs.delete(p, True)
            fs.cancelDeleteOnExit(p)
