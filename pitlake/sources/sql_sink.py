"""Upserts into SQL databases: a data source that writes batches of INSERT ... ON CONFLICT over any DB-API connection.

Rows are dealt by key and sorted by it within a task, so that tasks never wait for each
other's rows, equal keys meet, and as many connections are open as the caller allows.  A batch is one
statement and one transaction; it is tried again when the database says that it
collided with another.  The statement is idempotent, and so are a task's
second attempt and a second run of the job.
"""

from __future__ import annotations

import base64
import itertools
import math
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType

from .catalog import TableSpec

# Rows and bound values of a statement, tries of a batch, and the SQLSTATE of a serialisation failure.
MAX_ROWS = 500
MAX_VALUES = 20_000
TRIES = 5
SERIALIZATION_FAILURE = "40001"


def collided(error: Exception) -> bool:
    """Whether the database asks for the transaction once more, by its SQLSTATE."""
    return SERIALIZATION_FAILURE in (getattr(error, "sqlstate", None), getattr(error, "pgcode", None))


def quoted(name: str) -> str:
    return ".".join('"' + part.replace('"', '""') + '"' for part in name.split("."))


@dataclass(frozen=True)
class SqlTarget:
    """A table of a database: how tasks connect (a function that can be pickled), its key, and what its driver expects.

    ``policy`` is ``update`` (incoming rows win) or ``nothing`` (stored rows win).
    ``mark`` is the driver's placeholder, ``adapt`` turns a value into one that it takes.
    """

    connect: Callable[[], Any]
    table: str
    keys: tuple[str, ...]
    policy: str = "update"
    mark: str = "%s"
    retryable: Callable[[Exception], bool] = collided
    adapt: Callable[[Any], Any] | None = None
    tries: int = TRIES
    backoff: float = 0.1

    def __post_init__(self) -> None:
        if self.policy not in ("update", "nothing"):
            raise ValueError("policy is update or nothing")
        if not self.keys or self.tries < 1:
            raise ValueError("a target has a key and a try or more")

    def columns(self) -> list[str]:
        """The columns that the table has; the database's own error if there is no such table."""
        db = self.connect()
        try:
            cursor = db.cursor()
            cursor.execute(f"SELECT * FROM {quoted(self.table)} WHERE 1 = 0")
            return [d[0] for d in cursor.description]
        finally:
            db.close()

    def on_conflict(self, columns: Sequence[str]) -> str:
        rest = [c for c in columns if c not in self.keys]
        act = "NOTHING" if self.policy == "nothing" or not rest else "UPDATE SET " + ", ".join(f"{quoted(c)} = EXCLUDED.{quoted(c)}" for c in rest)
        return f"ON CONFLICT ({', '.join(map(quoted, self.keys))}) DO {act}"

    def insert(self, columns: Sequence[str], rows: int) -> str:
        one = f"({', '.join([self.mark] * len(columns))})"
        return f"INSERT INTO {quoted(self.table)} ({', '.join(map(quoted, columns))}) VALUES {', '.join([one] * rows)} {self.on_conflict(columns)}"

    def run(self, db: Any, statement: str, values: Sequence[Any] = ()) -> int:
        """One transaction, tried again while it collides; the number of times that it did."""
        for attempt in range(self.tries):
            try:
                db.cursor().execute(statement, tuple(values))
                db.commit()
                return attempt
            except Exception as error:
                db.rollback()
                if attempt + 1 == self.tries or not self.retryable(error):
                    raise
                time.sleep(self.backoff * 2**attempt)
        raise AssertionError("unreachable")

    def once(self, statement: str) -> None:
        db = self.connect()
        try:
            self.run(db, statement)
        finally:
            db.close()


@dataclass(frozen=True)
class Written(WriterCommitMessage):
    rows: int
    batches: int
    collisions: int


def _plain(value: Any) -> Any:
    return None if isinstance(value, float) and math.isnan(value) else value


class SqlWriter(DataSourceWriter):
    """Batches of a task's rows into the target, or into a stage that the commit merges as one transaction."""

    def __init__(self, target: SqlTarget, columns: Sequence[str], stage: str | None):
        self.target, self.columns, self.stage = target, list(columns), stage
        self.size = max(1, min(MAX_ROWS, MAX_VALUES // len(self.columns)))

    def _values(self, rows: Iterator[Row]) -> Iterator[list[Any]]:
        adapt, keys = self.target.adapt or (lambda v: v), [self.columns.index(k) for k in self.target.keys]
        before = None
        for row in rows:
            values = [_plain(v) for v in row]
            key = [values[k] for k in keys]
            if None in key:
                raise ValueError(f"{self.target.table}: NULL in the key {key}")
            if key == before:
                raise ValueError(f"{self.target.table}: key {key} comes more than once")
            before = key
            yield [adapt(v) for v in values]

    def write(self, iterator: Iterator[Row]) -> Written:
        target = self.target if self.stage is None else replace(self.target, table=self.stage)
        rows = batches = collisions = 0
        values, db = self._values(iterator), None
        try:
            while batch := list(itertools.islice(values, self.size)):
                db = db or target.connect()
                collisions += target.run(db, target.insert(self.columns, len(batch)), [v for row in batch for v in row])
                rows, batches = rows + len(batch), batches + 1
        finally:
            if db is not None:
                db.close()
        return Written(rows, batches, collisions)

    def commit(self, messages: list[Written | None]) -> None:
        if self.stage is None:
            return
        names = ", ".join(map(quoted, self.columns))
        self.target.once(f"INSERT INTO {quoted(self.target.table)} ({names}) SELECT {names} FROM {quoted(self.stage)} WHERE 1 = 1 {self.target.on_conflict(self.columns)}")
        self.target.once(f"DROP TABLE {quoted(self.stage)}")

    def abort(self, messages: list[Written | None]) -> None:
        if self.stage is not None:
            self.target.once(f"DROP TABLE IF EXISTS {quoted(self.stage)}")


class SqlSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "pitlake_sql"

    def writer(self, schema: StructType, overwrite: bool) -> SqlWriter:
        return SqlWriter(cloudpickle.loads(base64.b64decode(self.options["target"])), schema.names, self.options.get("stage"))


def upsert_sql(df: DataFrame, target: SqlTarget, connections: int = 8, whole: bool = False) -> list[str]:
    """Upsert ``df`` by the target's key; the columns that were written.

    Columns that the table lacks are left out, and a table or key column that is
    not there stops before anything is written.  NULL in a key, or a key that comes
    more than once, fails the job; without ``whole`` batches that went before stay, and a run
    with mended rows goes over them.  With ``whole`` tasks fill a stage beside the table,
    and the rows appear together in one transaction or not at all; a driver that
    dies on the way leaves the stage, named TABLE__stage_ID, and no row.  An empty ``df`` writes nothing.
    """
    if connections < 1:
        raise ValueError("connections is less than 1")
    there = set(target.columns())
    columns = [c for c in df.columns if c in there]
    missing = [k for k in target.keys if k not in columns]
    if missing:
        raise ValueError(f"{target.table}: no column {', '.join(missing)} to upsert by")
    df.sparkSession.dataSource.register(SqlSink)
    dealt = df.select(*(f"`{c}`" for c in columns)).repartition(connections, *target.keys).sortWithinPartitions(*target.keys)
    sink = dealt.write.format("pitlake_sql").mode("append").option("target", base64.b64encode(cloudpickle.dumps(target)).decode())
    if whole:
        stage = f"{target.table}__stage_{uuid.uuid4().hex[:12]}"
        target.once(f"CREATE TABLE {quoted(stage)} AS SELECT {', '.join(map(quoted, columns))} FROM {quoted(target.table)} WHERE 1 = 0")
        target.once(f"CREATE UNIQUE INDEX {quoted(stage.rpartition('.')[2] + '_key')} ON {quoted(stage)} ({', '.join(map(quoted, target.keys))})")
        sink = sink.option("stage", stage)
    sink.save()
    return columns


# What Spark's types are called in SQL.
SQL_TYPES = {
    "string": "TEXT", "boolean": "BOOLEAN", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT",
    "double": "DOUBLE PRECISION", "float": "REAL", "date": "DATE", "timestamp": "TIMESTAMPTZ", "timestamp_ntz": "TIMESTAMP",
}


def sql_type(kind: str) -> str:
    name = SQL_TYPES.get(kind, kind.upper() if kind.startswith("decimal(") else None)
    if name is None:
        raise ValueError(f"no SQL type for {kind}")
    return name


def create_statement(spec: TableSpec, table: str | None = None) -> str:
    """CREATE TABLE of a table of the catalogue, with its key; nothing happens where it is there."""
    columns = [f"{quoted(f.name)} {sql_type(f.dataType.simpleString())}{'' if f.nullable and f.name not in spec.key else ' NOT NULL'}" for f in spec.schema]
    return f"CREATE TABLE IF NOT EXISTS {quoted(table or spec.name)} ({', '.join(columns)}, PRIMARY KEY ({', '.join(map(quoted, spec.key))}))"


def create_tables(specs: dict[str, TableSpec], connect: Callable[[], Any], prefix: str = "", **how: Any) -> dict[str, list[str]]:
    """Create what is not there and add nullable columns that a table lacks; the columns added by table.

    A column that is new and may not be NULL has no value in the rows that are there: ValueError, before any column is added.
    """
    missing: dict[str, list] = {}
    for name, spec in specs.items():
        SqlTarget(connect, prefix + name, spec.key, **how).once(create_statement(spec, prefix + name))
        there = set(SqlTarget(connect, prefix + name, spec.key, **how).columns())
        missing[name] = [f for f in spec.schema if f.name not in there]
    bad = [f"{n}.{f.name}" for n, fields in missing.items() for f in fields if not f.nullable]
    if bad:
        raise ValueError(f"new columns that may not be NULL: {', '.join(bad)}")
    for name, fields in missing.items():
        for f in fields:
            SqlTarget(connect, prefix + name, specs[name].key, **how).once(f"ALTER TABLE {quoted(prefix + name)} ADD COLUMN {quoted(f.name)} {sql_type(f.dataType.simpleString())}")
    return {n: [f.name for f in fields] for n, fields in missing.items() if fields}


def drop_tables(specs: dict[str, TableSpec], connect: Callable[[], Any], prefix: str = "", **how: Any) -> None:
    """Drop the tables of a catalogue, and nothing else."""
    for name, spec in specs.items():
        SqlTarget(connect, prefix + name, spec.key, **how).once(f"DROP TABLE IF EXISTS {quoted(prefix + name)}")
