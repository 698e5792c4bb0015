"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are tuned for.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.showConsoleProgress": "false",
    # Do not take a Python stack trace for each column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# On a cluster, shuffles start with many partitions, sized for tens of terabytes, and AQE
# puts small ones together to the advised size instead of to the number of cores.
CLUSTER = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def build_session(
    app: str = "studiolens", master: str | None = None, cluster: bool = False, **conf: str
) -> SparkSession:
    """A session with :data:`DEFAULTS`, and :data:`CLUSTER` if asked; ``conf`` keys use
    ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **(CLUSTER if cluster else {})}
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_base: str | None = None


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    All executors must see the folder, so a cluster has to name a shared one. Only a
    local master may fall back to a temporary folder of the machine.
    """
    global _local_base
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="studiolens-")
        base = _local_base
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder this library has written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(folder, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is not there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(folder))


def write_text(spark: SparkSession, path: str, text: str = "") -> None:
    """Create a small file; one that is there already is an error."""
    file = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(file, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    source = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(file)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    finally:
        source.close()
