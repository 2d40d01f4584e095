"""Session settings and the shared scratch folder."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def local_session(cpus: int | str = 8, **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("breathline")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: stored times are zone-less UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or that the context was given.

    Only on one machine, and without either, a temporary one that goes with the process.
    """
    global _local_root
    sc = spark.sparkContext
    root = (
        spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    )
    if not root:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="breathline-")
            atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
        root = _local_root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def streaming_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session beside ``spark`` for stateful streams, by default with a state partition per core.

    A stream keeps its number of shuffle partitions for the life of its checkpoint, and
    AQE does not coalesce them.
    """
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism))
    return utc(session)


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def frozen(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` to reliable storage, so that later steps see one fixed version."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)
