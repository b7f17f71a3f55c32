"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


@cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="gaugewell-")


def local_session(cpus: str | int = "*", partitions: int = 8, app: str = "gaugewell") -> SparkSession:
    """Local session for tests and bench.  A cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        # No stack capture for every column built: it halves the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", _local_base())
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder named by ``spark.checkpoint.dir``.

    Written tables must be visible to every executor, so the folder comes from
    the session.  Only where none is set (a bare local session) is one made.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def byte_size(text: str) -> int:
    """Bytes of a size setting such as ``134217728b``, ``128m`` or ``1gb``."""
    number = text.strip().lower().removesuffix("b")
    scale = {"k": 10, "m": 20, "g": 30, "t": 40}.get(number[-1:])
    return int(number) if scale is None else int(number[:-1]) << scale
