"""A session for local work; on a cluster the session is the cluster's own."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """A new folder that driver and executors share: under ``spark.checkpoint.dir``, or a temporary one on one machine."""
    own = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not own:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        own = tempfile.mkdtemp(prefix="pitlake-")
        atexit.register(shutil.rmtree, own, True)
        spark.sparkContext.setCheckpointDir(own)
    return f"{own}/pitlake-{uuid.uuid4().hex}"


def local_session(cpus: int | None = None, memory: str = "8g") -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    return (
        SparkSession.builder.master(f"local[{cpus}]").appName("pitlake")
        .config("spark.sql.shuffle.partitions", str(cpus)).config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
