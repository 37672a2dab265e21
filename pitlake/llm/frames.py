"""Small DataFrame helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where that setting is absent (tests, a laptop) is a temporary folder
    made and set, and it is removed when the process ends.
    """
    own = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if own:
        return own
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="pitlake-")
    atexit.register(shutil.rmtree, made, True)
    spark.sparkContext.setCheckpointDir(made)
    return made


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    Cuts the lineage: a lost executor never makes earlier stages run again, and
    the exchanges of later joins are their own, so skewed ones can be split.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pitlake-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)  # texts take about half the room that the default gives
    return spark.read.schema(df.schema).parquet(path)


def importable(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it (if they share that folder)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", without_id: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """(doc_id long, text, carried columns) of the rows that have an id (nothing could address the others' results), or of all."""
    importable(docs.sparkSession)
    ids = F.col(id_col).cast("long")
    return docs.where(F.lit(without_id) | ids.isNotNull()).select(ids.alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry)


def with_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a column that numbers its rows, and that column's name.

    Rows may share an id or have none; what decides about rows needs a key of its
    own.  The table is written, so that every later reading sees the same numbers.
    """
    name, taken = "row_", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return stage_table(docs.withColumn(name, F.monotonically_increasing_id()), "rows"), name
