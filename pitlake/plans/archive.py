"""Archiving of old partitions: discovery, digests, manifest, what needs an upload, the copy and its verification.

Files are read in tasks, a chunk at a time, with a running digest: memory does not
grow with a file.  Python tasks open them through Arrow's file systems (local, HDFS,
S3 and the like, by the scheme of the path).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow.fs import FileSystem, FileType, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.gaps import missing

#: Bytes that a task holds of a file at once.
CHUNK = 4 << 20


def _opened(path: str) -> tuple[FileSystem, str]:
    """The file system of a path as Spark writes it (``file:/a`` or ``file:///a``, ``s3a://``, ``hdfs://``), and the path in it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return LocalFileSystem(), "/" + rest.lstrip("/")
    return FileSystem.from_uri(f"s3:{rest}" if scheme in ("s3a", "s3n") else path)


def digest(path: str, chunk: int = CHUNK) -> tuple[int, str]:
    """(size, sha256) of a file, read a chunk at a time."""
    fs, inside = _opened(path)
    size, running = 0, hashlib.sha256()
    with fs.open_input_stream(inside) as f:
        while block := f.read(chunk):
            size += len(block)
            running.update(block)
    return size, running.hexdigest()


def footer_rows(path: str) -> int | None:
    """Rows of a Parquet file by its footer; None if it has no readable one."""
    fs, inside = _opened(path)
    try:
        with fs.open_input_file(inside) as f:
            return pq.ParquetFile(f).metadata.num_rows
    except pa.ArrowInvalid:
        return None


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` as Spark writes the paths in it, without a slash at the end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, key, season in zip(*(c.to_pylist() for c in batch.columns)):
            size, sha = digest(path)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((path, pa.string()), (key, pa.string()), (season, pa.int32()), (size, pa.int64()), (sha, pa.string()), (footer_rows(path), pa.int64()))], ["path", "key", "season", "size", "sha256", "rows"])


def discover(spark: SparkSession, root: str, before_season: int, prefix: str = "archive", live: Iterable[str] | None = None) -> DataFrame:
    """Parquet files named with a season before ``before_season``: path, key, season, size, sha256, rows.

    The season is that of the file (``_2023.parquet``) or of its folder
    (``season_year=2023``).  Keys are paths below the whole root; ``live`` names
    those below the root that count, where others may lie beside them.  Sizes,
    digests and rows (by the footer) are those of one pass over each file.
    """
    top = qualified(spark, root)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root).select("path")
    season = F.coalesce(
        F.regexp_extract("path", r"_(\d{4})\.parquet$", 1).try_cast("int"), F.regexp_extract("path", r"season(?:_year)?=(\d{4})/", 1).try_cast("int")
    )
    inside = F.substr("path", F.lit(len(top) + 2))
    found = files.select("path", inside.alias("key"), season.alias("season")).where(F.col("season") < before_season)
    if live is not None:
        found = found.join(spark.createDataFrame([(x,) for x in live], "key string"), "key", "left_semi").select("path", "key", "season")
    dealt = found.withColumn("key", F.concat(F.lit(f"{prefix}/"), "key")).repartition("path")  # files in parallel, whatever lists them
    return dealt.mapInArrow(_digested, "path string, key string, season int, size long, sha256 string, rows long")


def row_counts(spark: SparkSession, files: DataFrame, root: str) -> DataFrame:
    """path and rows of the files, from one scan that reads no column."""
    seen = spark.read.option("recursiveFileLookup", "true").parquet(root).select(F.col("_metadata.file_path").alias("path"))
    counts = seen.groupBy("path").agg(F.count("*").alias("rows"))
    return files.select("path").join(counts, "path", "left").na.fill(0, ["rows"])


def manifest(files: DataFrame) -> DataFrame:
    """One row: object_count, row_count, byte_count.  The objects themselves are rows of ``files`` (``manifest_objects``)."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return files.agg(F.count("*").alias("object_count"), total("rows").alias("row_count"), total("size").alias("byte_count"))


def manifest_objects(files: DataFrame) -> DataFrame:
    """A row for each object, in order of the keys: key, season, size, sha256, rows."""
    return files.select("key", "season", "size", "sha256", "rows").orderBy("key")


def existing(spark: SparkSession, target: str, prefix: str = "archive") -> DataFrame:
    """key, size, sha256 of what lies below the target already; none if there is no such folder."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target.rstrip('/')}/{prefix}")
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "key string, size long, sha256 string")
    return discover(spark, f"{target.rstrip('/')}/{prefix}", 10_000, prefix).select("key", "size", "sha256")


def classify_uploads(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Local objects (key, size, sha256) with action: upload (not there), changed (differs), skip (equal)."""
    there = remote.select("key", F.col("size").alias("__size"), F.col("sha256").alias("__sha"))
    same = (F.col("size") == F.col("__size")) & (F.col("sha256") == F.col("__sha"))
    action = F.when(F.col("__size").isNull(), "upload").when(F.coalesce(same, F.lit(False)), "skip").otherwise("changed")
    return local.join(there, "key", "left").withColumn("action", action).drop("__size", "__sha")


def mutated(at_manifest: DataFrame, now: DataFrame) -> DataFrame:
    """Objects that are no longer as the manifest has them."""
    return missing(at_manifest, now, ["key", "size", "sha256"])


def copy_verified(path: str, target: str, size: int, sha256: str, overwrite: bool = False, chunk: int = CHUNK) -> str:
    """Copy one file and read it back: copied, present, conflict, mutated or corrupt.

    ``present``: the target is equal already, so a restart copies nothing twice.
    ``conflict``: it is there and differs, and is left as it is unless ``overwrite``.
    ``mutated``: the source is no longer what the manifest says; nothing is left at the target.
    ``corrupt``: what was read back is not what was written; it is removed.
    """
    source_fs, source = _opened(path)
    target_fs, there = _opened(target)
    if target_fs.get_file_info(there).type == FileType.File:
        if target_fs.get_file_info(there).size == size and digest(target, chunk) == (size, sha256):
            return "present"
        if not overwrite:
            return "conflict"
    target_fs.create_dir(there.rsplit("/", 1)[0], recursive=True)
    part, running, n = f"{there}.part", hashlib.sha256(), 0
    with source_fs.open_input_stream(source) as f, target_fs.open_output_stream(part) as out:
        while block := f.read(chunk):
            running.update(block)
            n += len(block)
            out.write(block)
    verdict = "copied" if (n, running.hexdigest()) == (size, sha256) else "mutated"
    if verdict == "copied" and digest(f"{target}.part", chunk) != (size, sha256):
        verdict = "corrupt"
    if verdict == "copied":
        target_fs.move(part, there)
    else:
        target_fs.delete_file(part)
    return verdict


def upload(files: DataFrame, target: str, overwrite: bool = False) -> DataFrame:
    """Copy the objects of a manifest below ``target`` in tasks: key, size, sha256, result (as ``copy_verified``), target.

    Nothing happens before the result is written or counted; doing it again is
    harmless, so a lost executor's files are simply tried once more.
    """
    top = qualified(files.sparkSession, target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, key, size, sha in zip(*(c.to_pylist() for c in batch.columns)):
                to = f"{top}/{key}"
                yield pa.RecordBatch.from_pylist([{"key": key, "size": size, "sha256": sha, "result": copy_verified(path, to, size, sha, overwrite), "target": to}])

    return files.select("path", "key", "size", "sha256").repartition("key").mapInArrow(run, "key string, size long, sha256 string, result string, target string")
