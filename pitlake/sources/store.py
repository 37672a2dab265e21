"""Keyed tables on plain Parquet: upsert, replace-children, insert-only, rewrite.

A table is a folder with one subfolder per partition value.  Its files never change:
a write adds files and then publishes a version, a list of the files that hold, by
renaming it to the next number under ``_versions``.  That rename is the only moment
at which anything changes for readers.  Whatever is killed before it leaves files
that no version lists; a reader keeps the version that it began with, as the files
of the last ``KEEP`` versions stay.  A write reads and rewrites only those files that
hold rows it replaces.

One writer at a time holds the lock, a file with its owner and time.  A lock whose
process is gone, or that is older than ``lock_seconds``, is taken away by the next
writer; should its owner live after all, it finds its version's number taken and fails.
The schema that a table was written with lies under ``_schemas``; a catalogue that asks for more
columns or wider types is taken up with the next write (or ``migrate``), any other is refused.
Files are handled through Hadoop's file system, so any store that Spark reads will do.
"""

from __future__ import annotations

import contextlib
import json
import os
import socket
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.ordered import keep_last
from .catalog import TABLES, TableSpec, conform
from .evolution import changes

_ORDINAL = "__ordinal"
#: Versions whose files are kept; small files of a partition that a write takes along once there are so many.
KEEP, SMALL_FILES, SMALL_BYTES = 2, 32, 8 << 20
#: Distinct leading keys of a batch up to which they are pushed to the scan one by one, and not as a range.
PUSHED_KEYS = 500


@dataclass(frozen=True)
class Version:
    """A number, and the live files: path within the table -> (rows, bytes)."""

    number: int
    files: dict[str, tuple[int, int]]


class Store:
    """``ordinal`` below names a column that orders the rows of a batch; without it any row of a repeated key may win."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, TableSpec] = TABLES, lock_seconds: int = 6 * 3600):
        self.spark, self.root, self.tables, self.lock_seconds = spark, root.rstrip("/"), tables, lock_seconds
        self._agreed: dict[str, list[str]] = {}  # what each table's schema still has to take up
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- files and versions -----------------------------------------------------------

    def _dir(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.name}"

    def _list(self, where: str) -> list:
        path = self._path(where)
        return list(self._fs.listStatus(path)) if self._fs.exists(path) else []

    def _write_text(self, where: str, text: str) -> None:
        out = self._fs.create(self._path(where), False)
        try:
            out.write(text.encode())
        finally:
            out.close()

    def _read_text(self, where: str) -> str:
        stream = self._fs.open(self._path(where))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _on_disk(self, spec: TableSpec) -> dict[str, object]:
        """Path within the table -> status of every Parquet file, live or not."""
        found = {}
        for folder in self._list(self._dir(spec)):
            name = folder.getPath().getName()
            if folder.isDirectory() and name.startswith(f"{spec.partition}="):
                for f in self._list(f"{self._dir(spec)}/{name}"):
                    if f.getPath().getName().endswith(".parquet"):
                        found[f"{name}/{f.getPath().getName()}"] = f
        return found

    def _numbers(self, spec: TableSpec) -> list[int]:
        names = (s.getPath().getName() for s in self._list(f"{self._dir(spec)}/_versions"))
        return sorted(int(n) for n in names if n.isdigit())

    def _listed(self, spec: TableSpec, number: int) -> dict[str, tuple[int, int]]:
        lines = map(json.loads, self._read_text(f"{self._dir(spec)}/_versions/{number:012d}").splitlines())
        return {x["file"]: (x["rows"], x["bytes"]) for x in lines}

    def version(self, table: str) -> Version:
        """The current version; a folder of plain files without one is version 0, with all of them."""
        spec = self.tables[table]
        for _ in range(5):
            numbers = self._numbers(spec)
            if not numbers:
                return Version(0, {f: (-1, s.getLen()) for f, s in self._on_disk(spec).items()})
            with contextlib.suppress(Exception):  # it may have been superseded and removed since it was listed
                return Version(numbers[-1], self._listed(spec, numbers[-1]))
        return Version(numbers[-1], self._listed(spec, numbers[-1]))

    # -- schemas ------------------------------------------------------------------------

    def _schemas(self, spec: TableSpec) -> list[int]:
        return sorted(int(n) for n in (s.getPath().getName() for s in self._list(f"{self._dir(spec)}/_schemas")) if n.isdigit())

    def stored_schema(self, table: str) -> tuple[int, StructType | None]:
        """The number and the schema that the table has; 0 and that of its files where none was noted, or None without files."""
        spec = self.tables[table]
        numbers = self._schemas(spec)
        if numbers:
            return numbers[-1], StructType.fromJson(json.loads(self._read_text(f"{self._dir(spec)}/_schemas/{numbers[-1]:012d}")))
        paths = [f"{self._dir(spec)}/{f}" for f in self.version(table).files]
        return 0, self.spark.read.option("basePath", self._dir(spec)).option("mergeSchema", True).parquet(*paths).schema if paths else None

    def _differences(self, spec: TableSpec) -> list[str]:
        """What the catalogue has that the table has not; refuses what cannot be.  Looked up once."""
        if spec.name not in self._agreed:
            number, stored = self.stored_schema(spec.name)
            fixed = {*spec.key, spec.partition}
            found = ["first schema"] if number == 0 else []
            self._agreed[spec.name] = found if stored is None else found + changes(spec.name, stored, spec.schema, fixed, number > 0)
        return self._agreed[spec.name]

    def _take_up(self, spec: TableSpec) -> list[str]:
        """Note the catalogue's schema as the table's next one, under the lock."""
        self._agreed.pop(spec.name, None)  # another writer may have changed it meanwhile
        taken = self._differences(spec)
        if taken:
            self._rename_in(spec, "_schemas", self.stored_schema(spec.name)[0] + 1, spec.schema.json())
            self._agreed[spec.name] = []
        return taken

    def migrate(self) -> dict[str, list[str]]:
        """Take up the catalogue in every table that is there: table -> changes.  No file is rewritten; old rows have NULL in new columns."""
        out = {}
        for name, spec in self.tables.items():
            if self._fs.exists(self._path(self._dir(spec))) and self._differences(spec):
                with self._lock(spec):
                    out[name] = self._take_up(spec)
        return out

    # -- reading ----------------------------------------------------------------------

    @staticmethod
    def _value(file: str) -> str:
        return file.split("/", 1)[0].split("=", 1)[1]

    def partitions(self, table: str) -> list[str]:
        """The partition values that have files, sorted (no scan)."""
        return sorted({self._value(f) for f in self.version(table).files})

    def _scan(self, spec: TableSpec, files: Iterable[str]) -> DataFrame:
        paths = [f"{self._dir(spec)}/{f}" for f in sorted(files)]
        if not paths:
            return self.spark.createDataFrame([], spec.schema)
        return self.spark.read.schema(spec.schema).option("basePath", self._dir(spec)).parquet(*paths)

    def read(self, table: str, partitions: Iterable | None = None) -> DataFrame:
        """All rows, or those of some partitions, of the current version; unknown ones are empty, and so is a table never written."""
        spec, files = self.tables[table], self.version(table).files
        if files:
            self._differences(spec)
        if partitions is None:
            return self._scan(spec, files).select(*spec.schema.names)
        wanted = {int(p) for p in partitions}
        df = self._scan(spec, (f for f in files if int(self._value(f)) in wanted))
        return df.where(F.col(spec.partition).isin(sorted(wanted))).select(*spec.schema.names)

    def keys(self, table: str, column: str, partitions: Iterable | None = None) -> DataFrame:
        return self.read(table, partitions).select(column).where(F.col(column).isNotNull()).distinct()

    def game_ids(self, table: str, season: int) -> DataFrame:
        spec = self.tables[table]
        if spec.game is None:
            raise ValueError(f"{table} has no game column")
        return self.keys(table, spec.game, [season])

    def summary(self) -> DataFrame:
        """table, n_rows, n_partitions, first and last partition, for every table."""
        found = None
        for name, spec in self.tables.items():
            p = F.col(spec.partition)
            one = self.read(name).agg(
                F.lit(name).alias("table"), F.count("*").alias("n_rows"), F.countDistinct(p).alias("n_partitions"),
                F.min(p).alias("first_partition"), F.max(p).alias("last_partition"),
            )
            found = one if found is None else found.unionByName(one)
        return found

    # -- the lock, and what a crash leaves ----------------------------------------------

    def _dead(self, spec: TableSpec) -> bool:
        """Whether the owner of the lock is gone, as far as can be told, or holds it for too long."""
        where = f"{self.root}/_lock_{spec.name}"
        try:
            age = time.time() - self._fs.getFileStatus(self._path(where)).getModificationTime() / 1000
            text = self._read_text(where)
        except Exception:  # noqa: BLE001  (it has just been released)
            return False
        if age > self.lock_seconds:
            return True
        try:
            owner = json.loads(text)
        except ValueError:  # not written yet
            return False
        if owner["host"] != socket.gethostname():
            return False
        try:
            os.kill(owner["pid"], 0)
        except ProcessLookupError:
            return True
        except PermissionError:
            pass
        return False

    def _break(self, spec: TableSpec) -> None:
        """Take the lock away; of several who try, one can rename it."""
        aside = self._path(f"{self.root}/_dead_{spec.name}_{uuid.uuid4().hex}")
        if self._fs.rename(self._path(f"{self.root}/_lock_{spec.name}"), aside):
            self._fs.delete(aside, False)

    @contextlib.contextmanager
    def _lock(self, spec: TableSpec):
        where = f"{self.root}/_lock_{spec.name}"
        lock = self._path(where)
        self._fs.mkdirs(self._path(self.root))
        for attempt in range(2):
            try:
                # create without overwriting: one of several writers succeeds
                self._write_text(where, json.dumps({"owner": uuid.uuid4().hex, "host": socket.gethostname(), "pid": os.getpid(), "time": time.time()}))
                break
            except Exception as error:  # noqa: BLE001  (Java's, of several kinds)
                if not self._fs.exists(lock) and attempt == 0:
                    continue
                if attempt or not self._dead(spec):
                    raise RuntimeError(f"{spec.name} is being written: {where}") from error
                self._break(spec)
        try:
            yield
        finally:
            self._fs.delete(lock, False)

    def _clean(self, spec: TableSpec, older_than: float) -> int:
        """Remove versions before the last ``KEEP``, and files that none of those lists, if they are older than so many seconds."""
        numbers = self._numbers(spec)
        if not numbers:
            return 0
        before = set().union(*(self._listed(spec, n) for n in numbers[:-KEEP]))  # known to be superseded, whatever their age
        listed = set().union(*(self._listed(spec, n) for n in numbers[-KEEP:]))
        gone, now = 0, time.time()
        for file, status in self._on_disk(spec).items():
            if file not in listed and (file in before or now - status.getModificationTime() / 1000 > older_than):
                gone += bool(self._fs.delete(status.getPath(), False))
        for n in numbers[:-KEEP]:
            self._fs.delete(self._path(f"{self._dir(spec)}/_versions/{n:012d}"), False)
        for s in self._list(f"{self._dir(spec)}/_versions"):
            if s.getPath().getName().startswith("new_") and now - s.getModificationTime() / 1000 > older_than:
                self._fs.delete(s.getPath(), False)
        return gone

    def recover(self, older_than: float | None = None) -> dict[str, dict[str, int]]:
        """What crashed writers have left is removed: table -> dead locks and files.

        Only for dead owners' locks, and files in no version that are older than
        ``older_than`` seconds (``lock_seconds`` if left out: nobody can be about to publish them).
        """
        out = {}
        for name, spec in self.tables.items():
            locks = int(self._fs.exists(self._path(f"{self.root}/_lock_{name}")) and self._dead(spec))
            if locks:
                self._break(spec)
            files = 0
            if self._fs.exists(self._path(self._dir(spec))) and not self._fs.exists(self._path(f"{self.root}/_lock_{name}")):
                with self._lock(spec):
                    files = self._clean(spec, self.lock_seconds if older_than is None else older_than)
            if locks or files:
                out[name] = {"locks": locks, "files": files}
        return out

    # -- writing ----------------------------------------------------------------------

    def _incoming(self, spec: TableSpec, df: DataFrame, ordinal: str | None) -> DataFrame:
        lacking = [c for c in (*spec.key, spec.partition) if c not in df.columns]
        if lacking:
            raise ValueError(f"{spec.name}: the batch lacks {', '.join(lacking)}")
        rows = conform(df, spec.schema).withColumn(_ORDINAL, F.lit(0)) if ordinal is None else conform_with(df, spec, ordinal)
        rows = keep_last(rows, spec.key, _ORDINAL).drop(_ORDINAL)
        # a NULL key or partition would become a row that nothing can address
        for c in dict.fromkeys((*spec.key, spec.partition)):
            rows = rows.withColumn(c, F.coalesce(c, F.raise_error(F.lit(f"{spec.name}: {c} is NULL")).cast(spec.schema[c].dataType)))
        return rows

    def _add_files(self, spec: TableSpec, rows: DataFrame) -> dict[str, tuple[int, int]]:
        """Write rows to new files, which no version lists yet."""
        seen, before = Observation(), set(self._on_disk(spec))
        # by ranges of the table's order, so that a large partition is several tasks and several files, each with narrow bounds
        dealt = rows.repartitionByRange(spec.partition, *spec.order).observe(seen, F.count(F.lit(1)).alias("n"))  # ranges are found by a pass of their own
        dealt.sortWithinPartitions(spec.partition, *spec.order).write.mode("append").partitionBy(spec.partition).parquet(self._dir(spec))
        new = {f: s.getLen() for f, s in self._on_disk(spec).items() if f not in before}
        counts = {}
        if new:
            counts = {_within(r["file"]): r["count"] for r in self._scan(spec, new).select(_file().alias("file")).groupBy("file").count().collect()}  # a row a file
        if sum(counts.values()) != seen.get["n"]:
            raise OSError(f"{spec.name}: {sum(counts.values())} rows written of {seen.get['n']}")
        return {f: (counts.get(f, 0), size) for f, size in new.items()}

    def _rename_in(self, spec: TableSpec, kind: str, number: int, text: str) -> None:
        """Make a text the next of its kind: one rename, which fails if the number is taken."""
        folder = f"{self._dir(spec)}/{kind}"
        self._fs.mkdirs(self._path(folder))
        new = f"{folder}/new_{uuid.uuid4().hex}"
        self._write_text(new, text)
        target = self._path(f"{folder}/{number:012d}")
        if self._fs.exists(target) or not self._fs.rename(self._path(new), target):
            raise OSError(f"{spec.name}: another writer has published version {number}")

    def _announce(self, spec: TableSpec, number: int, files: dict[str, tuple[int, int]]) -> None:
        """Make a version current."""
        self._rename_in(spec, "_versions", number, "\n".join(json.dumps({"file": f, "rows": r, "bytes": b}) for f, (r, b) in sorted(files.items())))

    def _publish(self, spec: TableSpec, base: Version, rows: DataFrame, replaced: set[str]) -> None:
        """The next version: the files of ``base`` without the ``replaced`` ones, and new files with ``rows``."""
        self._take_up(spec)  # before files of the new schema
        added = self._add_files(spec, rows)
        self._announce(spec, base.number + 1, {f: x for f, x in base.files.items() if f not in replaced} | added)
        self._clean(spec, self.lock_seconds)

    def _holding(self, spec: TableSpec, files: set[str], rows: DataFrame, key: tuple[str, ...]) -> set[str]:
        """Which of the files hold a row of a key of ``rows``: a scan of the key columns, with the leading key's values or bounds pushed down."""
        if not files:
            return set()
        lead = F.col(key[0])
        few = [r[0] for r in rows.select(lead).distinct().limit(PUSHED_KEYS + 1).collect()]
        if not few:
            return set()
        if len(few) <= PUSHED_KEYS:
            near = lead.isin(few)
        else:
            low, high = rows.agg(F.min(lead), F.max(lead)).first()
            near = lead.between(F.lit(low), F.lit(high))
        there = self._scan(spec, files).where(near).select(*key, _file().alias("__file"))
        return {_within(r[0]) for r in there.join(rows.select(*key).distinct(), list(key), "left_semi").select("__file").distinct().collect()}  # at most the files

    def _with_small(self, base: Version, files: set[str], replaced: set[str]) -> set[str]:
        """``replaced``, and the small files of the partitions where they have become many."""
        by: dict[str, set[str]] = {}
        for f in files - replaced:
            if base.files[f][1] < SMALL_BYTES:
                by.setdefault(self._value(f), set()).add(f)
        return replaced.union(*(some for some in by.values() if len(some) >= SMALL_FILES))

    def _touched(self, rows: DataFrame, spec: TableSpec) -> set[int]:
        return {r[0] for r in rows.select(spec.partition).distinct().collect()}  # seasons: a few dozen at most

    def _files_of(self, base: Version, partitions: Iterable[int]) -> set[str]:
        wanted = set(partitions)
        return {f for f in base.files if int(self._value(f)) in wanted}

    def upsert(self, table: str, df: DataFrame | None, ordinal: str | None = None) -> int:
        """Insert rows, replacing those of equal key; of a key repeated in the batch the last by ``ordinal`` stays.

        Returns the number of incoming rows after that.  Only files of the batch's
        partitions that hold one of its keys are rewritten.
        """
        if df is None:
            return 0
        spec = self.tables[table]
        rows = self._incoming(spec, df, ordinal).persist()
        try:
            n = rows.count()
            if n:
                with self._lock(spec):
                    base = self.version(table)
                    files = self._files_of(base, self._touched(rows, spec))
                    replaced = self._with_small(base, files, self._holding(spec, files, rows, spec.key))
                    rest = self._scan(spec, replaced).join(rows.select(*spec.key), list(spec.key), "left_anti")
                    self._publish(spec, base, rest.select(*spec.schema.names).unionByName(rows.select(*spec.schema.names)), replaced)
            return n
        finally:
            rows.unpersist()

    def replace_children(self, table: str, df: DataFrame, parents: DataFrame, season: int, ordinal: str | None = None) -> int:
        """Drop all rows of the ``parents`` (their game column) in a season, insert the batch's rows of them.

        An empty batch deletes; a partition that ends up empty is gone.
        """
        spec = self.tables[table]
        if spec.game is None or spec.partition != "season_year":
            raise ValueError(f"{table} has no games by season")
        chosen = parents.select(F.col(spec.game).cast("string").alias(spec.game)).distinct()
        rows = self._incoming(spec, df, ordinal).where(F.col(spec.partition) == season).join(chosen, spec.game, "left_semi").select(*spec.schema.names).persist()
        try:
            n = rows.count()
            with self._lock(spec):
                base = self.version(table)
                files = self._files_of(base, [season])
                replaced = self._with_small(base, files, self._holding(spec, files, chosen, (spec.game,)))
                if n or replaced:
                    rest = self._scan(spec, replaced).join(chosen, spec.game, "left_anti").select(*spec.schema.names)
                    self._publish(spec, base, rest.unionByName(rows), replaced)
            return n
        finally:
            rows.unpersist()

    def insert_only(self, table: str, df: DataFrame, ordinal: str | None = None) -> int:
        """Insert the rows whose key is new in their partition; existing rows stay as they are, and so do their files."""
        spec = self.tables[table]
        rows = self._incoming(spec, df, ordinal)
        with self._lock(spec):
            base = self.version(table)
            files = self._files_of(base, self._touched(rows, spec))
            there = self._scan(spec, files).select(*spec.key)
            fresh = rows.join(there, list(spec.key), "left_anti").select(*spec.schema.names).persist()
            try:
                n = fresh.count()
                if n:
                    small = self._with_small(base, files, set())
                    self._publish(spec, base, self._scan(spec, small).select(*spec.schema.names).unionByName(fresh), small)
                return n
            finally:
                fresh.unpersist()

    def rewrite(self, table: str, df: DataFrame, partition: int) -> None:
        """Replace a whole partition."""
        spec = self.tables[table]
        with self._lock(spec):
            base = self.version(table)
            rows = conform(df, spec.schema).where(F.col(spec.partition) == partition)
            self._publish(spec, base, rows, self._files_of(base, [partition]))

    def drop(self, table: str) -> bool:
        """Delete a table with all its versions, while no other writes to it; whether it was there."""
        spec = self.tables[table]
        where = self._path(self._dir(spec))
        if not self._fs.exists(where):
            return False
        with self._lock(spec):
            return bool(self._fs.delete(where, True))


def _file() -> Column:
    """The file of a row, whole as Spark has it; nothing is computed a row."""
    return F.col("_metadata.file_path")


def _within(path: str) -> str:
    """A file's path within the table."""
    return "/".join(path.rsplit("/", 2)[-2:])


def conform_with(df: DataFrame, spec: TableSpec, ordinal: str | Column) -> DataFrame:
    """``conform`` that keeps the batch's order in a column of its own."""
    kept = df.withColumn(_ORDINAL, F.col(ordinal) if isinstance(ordinal, str) else ordinal)
    columns = set(df.columns)
    return kept.select(
        *((F.col(f.name) if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.schema), _ORDINAL
    )
