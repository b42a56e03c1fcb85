"""Session settings the operators rely on, and the folder and code all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_own_folder: dict[str, str] = {}


def build_session(name: str = "pricepanel", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC dates.

    Number of shuffle partitions, memory and checkpoint folder belong to the cluster and are
    left to its configuration unless passed in.
    """
    b = SparkSession.builder.appName(name)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that tasks can import it
    from whatever folder the job was started in."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    top = os.path.basename(root)
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{top}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join(top, os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where that is unset, a folder of our own in local mode; on a cluster the warehouse, which
    must be shared too: one on a local disk is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        files = spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
        return shared_only(folder, files.getUri().getScheme())
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="run-")
    return _own_folder[app]


def shared_only(folder: str, scheme: str) -> str:
    """``folder``, unless its file system is the local disk of one machine."""
    if scheme == "file":
        raise ValueError(f"{folder} is a local folder: set spark.checkpoint.dir to one that all executors share")
    return folder


def scratch(spark: SparkSession, name: str = "pricepanel") -> str:
    """A new folder name below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str = "saved") -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage in a way that
    survives the loss of executors, and later reads prune columns."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
