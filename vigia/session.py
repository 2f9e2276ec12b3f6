"""Session construction and the shared scratch location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "vigia", conf: dict[str, str] | None = None) -> SparkSession:
    """A session configured the way every job in this package expects.

    * UTC session time zone (dates compare the same everywhere),
    * AQE on (runtime coalescing, skew-join splitting, broadcast demotion),
    * ANSI left at Spark's default (on): malformed casts raise, so parsing
      code uses ``try_*`` functions explicitly,
    * no UI server.

    ``VIGIA_EVENT_LOG_DIR`` turns on Spark's event log into that folder (stage
    and task times without any server).
    """
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VIGIA_DRIVER_MEMORY", "16g"))
    )
    extra = dict(conf or {})
    if os.environ.get("VIGIA_EVENT_LOG_DIR"):
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["VIGIA_EVENT_LOG_DIR"]})
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    compiled_methods(spark)
    return spark


# Bytecode of a generated method up to which HotSpot compiles it.
METHOD_LIMIT = "8000"


def compiled_methods(spark: SparkSession) -> None:
    """Let wide projections (the 50 columns of a notification) be generated as
    several small methods: HotSpot never compiles one over ``METHOD_LIMIT`` bytes
    of bytecode and would interpret it row by row.  A setting of the session's
    own stays."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, METHOD_LIMIT)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A folder every executor can reach, below ``spark.checkpoint.dir``.

    On a cluster ``spark.checkpoint.dir`` must be set to shared storage, and we
    only read it; without it this raises.  Only in local mode (one process
    reads and writes everything) is a fresh local folder picked and registered.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="vigia-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return "/".join([base.rstrip("/"), *parts]) if parts else base


def fresh_dir(spark: SparkSession, *parts: str) -> str:
    """A new, unique folder below the shared location (never reused)."""
    return shared_dir(spark, *parts, uuid.uuid4().hex)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system Spark reaches."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it does not exist."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a temporary name and rename it: readers see it
    whole or not at all.  Raises if ``path`` exists."""
    jvm = spark.sparkContext._jvm
    whole, part = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    fs = whole.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    if fs.exists(whole) or not fs.rename(part, whole):
        fs.delete(part, False)
        raise FileExistsError(path)
