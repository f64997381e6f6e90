"""Where tables live: versioned Parquet folders, SQLite files, JDBC; and written intermediates."""

from __future__ import annotations

import contextlib
import json
import re
import shutil
import sqlite3
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar
from typing import Protocol
from urllib.parse import parse_qsl, unquote, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions.text import quote
from starmill.plans import ddl
from starmill.plans.config import Pipeline, Table

# -- intermediates


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the warehouse; a local one only where all run on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        local = spark.sparkContext.master.startswith("local")
        found = f"{tempfile.gettempdir()}/checkpoints/starmill" if local else spark.conf.get("spark.sql.warehouse.dir") + "/starmill-scratch"
    return f"file://{found}" if found.startswith("/") else found


_open: ContextVar[list[str] | None] = ContextVar("open", default=None)


def written(df: DataFrame) -> DataFrame:
    """``df``, written to the shared folder and read back: a cut of the lineage that outlives executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/written-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if (held := _open.get()) is not None:
        held.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """What is ``written`` inside is deleted at the end."""
    token = _open.set([])
    try:
        yield
    finally:
        paths = _open.get() or []
        _open.reset(token)
        for path in paths:
            fs, p = file_system(spark, path)
            fs.delete(p, True)


def file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


# -- stores


class TableStore(Protocol):
    def read(self, table: Table) -> DataFrame | None: ...
    def append(self, table: Table, df: DataFrame, batch: str | None = None) -> None: ...
    def replace(self, table: Table, df: DataFrame) -> None: ...
    def read_history(self, table: Table) -> DataFrame | None: ...
    def append_history(self, table: Table, df: DataFrame) -> None: ...
    def merge(self, table: Table, live: DataFrame, closed: DataFrame, batch: str | None = None) -> None: ...
    def has_batch(self, table: Table, batch: str) -> bool: ...


class ParquetStore:
    """A folder per table: parts, and numbered pointers that name the parts that count, their schema and the batches in them.

    A load writes its parts beside the others and then one pointer, by a rename that
    can't replace another; the highest pointer counts. So readers of an old version
    aren't disturbed, a load that fails at any step leaves the version before it, and
    current rows, history rows and the batch's name change together. Of two writers at
    once, one fails.
    """

    KEEP = 3
    """Pointers that stay for readers under way."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _folder(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _pointers(self, name: str) -> list[int]:
        fs, p = file_system(self.spark, self._folder(name))
        if not fs.exists(p):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        return sorted(int(n[8:-5]) for n in names if n.startswith("CURRENT-") and n.endswith(".json"))

    def _state(self, name: str) -> tuple[int, dict]:
        at = self._pointers(name)
        if not at:
            return 0, {"current": {"schema": None, "parts": []}, "history": {"schema": None, "parts": []}, "batches": []}
        fs, p = file_system(self.spark, f"{self._folder(name)}/CURRENT-{at[-1]:012d}.json")
        stream = fs.open(p)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return at[-1], json.loads(text)

    def _point(self, name: str, number: int, state: dict) -> None:
        folder = self._folder(name)
        fs, temp = file_system(self.spark, f"{folder}/_pointer-{uuid.uuid4().hex}")
        out = fs.create(temp, True)
        out.write(bytearray(json.dumps(state), "utf-8"))
        out.close()
        _, final = file_system(self.spark, f"{folder}/CURRENT-{number:012d}.json")
        if fs.exists(final) or not fs.rename(temp, final):
            fs.delete(temp, False)
            raise RuntimeError(f"another writer changed {name}")
        for old in self._pointers(name)[: -self.KEEP]:
            fs.delete(file_system(self.spark, f"{folder}/CURRENT-{old:012d}.json")[1], False)

    def _part(self, name: str, df: DataFrame, into: dict, keep: bool) -> None:
        part = f"v{time.time_ns()}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self._folder(name)}/{part}")
        had = T.StructType.fromJson(into["schema"]) if keep and into["schema"] else T.StructType([])
        fields = [*had.fields, *[f for f in df.schema if f.name not in had.fieldNames()]]
        into["schema"] = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields]).jsonValue()
        into["parts"] = [*(into["parts"] if keep else []), part]

    def _commit(self, name: str, changes: list[tuple[str, DataFrame, bool]], batch: str | None = None) -> None:
        """(which rows, what, whether what was there stays) of every change, under one pointer."""
        number, state = self._state(name)
        if batch is not None and batch in state["batches"]:
            return
        for which, df, keep in changes:
            self._part(name, df, state[which], keep)
        if batch is not None:
            state["batches"] = [*state["batches"], batch]
        self._point(name, number + 1, state)

    def _read(self, name: str, which: str) -> DataFrame | None:
        own = self._state(name)[1][which]
        if not own["parts"]:
            return None
        return self.spark.read.schema(T.StructType.fromJson(own["schema"])).parquet(*[f"{self._folder(name)}/{p}" for p in own["parts"]])

    def read(self, table: Table) -> DataFrame | None:
        return self._read(table.name, "current")

    def append(self, table: Table, df: DataFrame, batch: str | None = None) -> None:
        self._commit(table.name, [("current", df, True)], batch)

    def replace(self, table: Table, df: DataFrame) -> None:
        self._commit(table.name, [("current", df, False)])

    def read_history(self, table: Table) -> DataFrame | None:
        return self._read(table.name, "history")

    def append_history(self, table: Table, df: DataFrame) -> None:
        self._commit(table.name, [("history", df, True)])

    def merge(self, table: Table, live: DataFrame, closed: DataFrame, batch: str | None = None) -> None:
        self._commit(table.name, [("history", closed, True), ("current", live, False)], batch)

    def has_batch(self, table: Table, batch: str) -> bool:
        return batch in self._state(table.name)[1]["batches"]


def jdbc_url(dsn: str) -> tuple[str, dict[str, str]]:
    """A DSN as a JDBC URL and its properties; a JDBC URL passes as it is. Bulk inserts are asked for."""
    if dsn.startswith("jdbc:"):
        return dsn, {}
    u = urlsplit(dsn)
    own = {k: unquote(v) for k, v in (("user", u.username), ("password", u.password)) if v}
    host = (u.hostname or "localhost") + (f":{u.port}" if u.port else "")
    query = dict(parse_qsl(u.query))
    if u.scheme == "sqlserver":
        name = query.pop("database", u.path.strip("/"))
        rest = "".join(f";{k}={v}" for k, v in query.items())
        return f"jdbc:sqlserver://{host}" + (f";databaseName={name}" if name else "") + rest, own | {"useBulkCopyForBatchInsert": "true"}
    if u.scheme in ("postgres", "postgresql"):
        rest = "&".join(f"{k}={v}" for k, v in query.items())
        return f"jdbc:postgresql://{host}{u.path}" + (f"?{rest}" if rest else ""), own | {"reWriteBatchedInserts": "true"}
    raise ValueError(f"no JDBC URL for {u.scheme or dsn}")


class JdbcStore:
    """Tables of a database with a JDBC driver on the class path; they are created from their document. Executors write in batches.

    A merge is two writes, closed versions first: a database's own transaction can't
    span Spark's writers. A batch's name is in a table of its own, so that a whole
    batch that runs again is left out. A database that lives inside a process is the
    driver's alone: its rows pass through the driver, by files or ``AT_ONCE`` at a time.
    """

    BATCHES = "loaded_batches"
    AT_ONCE = 50_000

    def __init__(self, spark: SparkSession, dsn: str, dialect: str = "postgres", batch: int = 2000, **properties: str):
        url, own = jdbc_url(dsn)
        self.spark, self.url, self.dialect, self.properties = spark, url, dialect, {"batchsize": str(batch), **own, **properties}
        self.embedded = bool(re.match(r"jdbc:derby:(?!//)", url))

    @contextlib.contextmanager
    def _connection(self):
        jvm = self.spark._jvm
        own = jvm.java.util.Properties()
        for k, v in self.properties.items():
            own.setProperty(k, v)
        if driver := self.properties.get("driver"):
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
        c = jvm.java.sql.DriverManager.getConnection(self.url, own)
        try:
            yield c
        finally:
            c.close()

    def exists(self, name: str) -> bool:
        with self._connection() as c:
            s = c.createStatement()
            try:
                s.executeQuery(f"SELECT 1 FROM {quote(name, self.dialect)} WHERE 1 = 0").close()
                return True
            except Exception as e:
                if "SQLException" in str(e) or "SQLSyntax" in str(e) or "does not exist" in str(e):
                    return False
                raise
            finally:
                s.close()

    def execute(self, sql: str) -> None:
        with self._connection() as c:
            s = c.createStatement()
            try:
                s.execute(sql)
            finally:
                s.close()

    def ensure(self, table: Table, history: bool = False) -> None:
        """Create the table, if it isn't there and may be created."""
        if table.auto_create and not self.exists(table.name + ("_history" if history else "")):
            self.execute(ddl.create(table, self.dialect, history))

    def _read(self, name: str) -> DataFrame | None:
        if not self.exists(name):
            return None
        df = self.spark.read.jdbc(self.url, quote(name, self.dialect), properties=self.properties)
        return self._through_driver(name, df) if self.embedded else df

    def _write(self, name: str, df: DataFrame) -> None:
        if self.embedded:
            self._insert(name, df)
        else:
            df.write.jdbc(self.url, quote(name, self.dialect), "append", self.properties)

    def _through_driver(self, name: str, df: DataFrame) -> DataFrame:
        """The rows of a table, of the schema of ``df``, written to the shared folder by way of the driver."""
        jvm = self.spark._jvm
        dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url)
        names = ", ".join(quote(c, self.dialect) for c in df.columns)
        schema = df._jdf.schema()

        def put(rows) -> DataFrame:
            return DataFrame(self.spark._jsparkSession.createDataFrame(rows, schema), self.spark)

        path = f"{shared_dir(self.spark)}/written-{uuid.uuid4().hex}"
        if (held := _open.get()) is not None:
            held.append(path)
        put(jvm.java.util.ArrayList()).write.parquet(path)
        with self._connection() as c:
            s = c.createStatement()
            found = s.executeQuery(f"SELECT {names} FROM {quote(name, self.dialect)}")
            parts = jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils.resultSetToRows(found, schema, dialect).grouped(self.AT_ONCE)
            while parts.hasNext():
                put(jvm.scala.jdk.javaapi.CollectionConverters.asJava(parts.next())).write.mode("append").parquet(path)
            s.close()
        return self.spark.read.schema(df.schema).parquet(path)

    def _insert(self, name: str, df: DataFrame) -> None:
        """Executors write the rows as CSV to the shared folder; the driver fetches a file at a time, and Derby imports it."""

        def cell(n: str, kind: str) -> F.Column:
            c = F.hex(n) if kind == "binary" else F.col(n).cast("string")
            # a text has quotes; a null is nothing at all
            return F.coalesce(F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) if kind == "string" else c, F.lit(""))

        path = f"{shared_dir(self.spark)}/import-{uuid.uuid4().hex}"
        df.select(F.concat_ws(",", *[cell(n, k) for n, k in df.dtypes]).alias("value")).write.text(path)
        fs, p = file_system(self.spark, path)
        local = tempfile.mkdtemp()
        try:
            with self._connection() as c:
                call = c.prepareCall("CALL SYSCS_UTIL.SYSCS_IMPORT_DATA(NULL, ?, ?, NULL, ?, ',', '\"', 'UTF-8', 0)")
                for f in fs.listStatus(p):
                    if f.getLen() and f.getPath().getName().startswith("part-"):
                        _, to = file_system(self.spark, f"file://{local}/rows")
                        fs.copyToLocalFile(False, f.getPath(), to, True)
                        for k, v in enumerate((name, ",".join(df.columns), f"{local}/rows"), 1):
                            call.setString(k, v)
                        call.execute()
                call.close()
        finally:
            fs.delete(p, True)
            shutil.rmtree(local, ignore_errors=True)

    def read(self, table: Table) -> DataFrame | None:
        return self._read(table.name)

    def append(self, table: Table, df: DataFrame, batch: str | None = None) -> None:
        self.ensure(table)
        if batch is None or not self.has_batch(table, batch):
            self._write(table.name, df)
            self._told(table, batch)

    def replace(self, table: Table, df: DataFrame) -> None:
        kept = written(df)  # it may read the table that it replaces
        self.ensure(table)
        self.execute(f"DELETE FROM {quote(table.name, self.dialect)}")
        self._write(table.name, kept)

    def read_history(self, table: Table) -> DataFrame | None:
        return self._read(f"{table.name}_history")

    def append_history(self, table: Table, df: DataFrame) -> None:
        self.ensure(table, True)
        self._write(f"{table.name}_history", df)

    def merge(self, table: Table, live: DataFrame, closed: DataFrame, batch: str | None = None) -> None:
        if batch is not None and self.has_batch(table, batch):
            return
        kept = written(live)
        self.append_history(table, closed)
        self.replace(table, kept)
        self._told(table, batch)

    def has_batch(self, table: Table, batch: str) -> bool:
        had = self._read(self.BATCHES)
        return had is not None and had.toDF("t", "b").where((F.col("t") == table.name) & (F.col("b") == batch)).limit(1).count() > 0

    def _told(self, table: Table, batch: str | None) -> None:
        if batch is not None:
            if not self.exists(self.BATCHES):
                q = lambda n: quote(n, self.dialect)
                self.execute(f"CREATE TABLE {q(self.BATCHES)} ({q('table_name')} VARCHAR(300), {q('batch')} VARCHAR(300))")
            self._write(self.BATCHES, self.spark.createDataFrame([(table.name, batch)], "table_name string, batch string"))


class SqliteStore:
    """A SQLite file on the driver's disk, for small results: rows stream through the driver, a transaction for each load of a table."""

    READ_MOST = 2_000_000
    """Rows that may be read back through the driver; more is refused."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _insert(self, db: sqlite3.Connection, name: str, create: str, df: DataFrame, clear: bool) -> None:
        at = quote(name, "sqlite")
        cols = [F.col(n).cast("string" if t in ("date", "timestamp") else t).alias(n) for n, t in df.dtypes]
        marks = ", ".join("?" * len(df.columns))
        names = ", ".join(quote(c, "sqlite") for c in df.columns)
        db.execute(create)
        if clear:
            db.execute(f"DELETE FROM {at}")
        db.executemany(f"INSERT OR IGNORE INTO {at} ({names}) VALUES ({marks})", (tuple(r) for r in df.select(*cols).toLocalIterator()))

    def _load(self, table: Table, changes: list[tuple[bool, DataFrame, bool]], batch: str | None) -> None:
        """(whether the history, rows, whether what is there goes) in one transaction, with the batch's name."""
        if batch is not None and self.has_batch(table, batch):
            return
        with contextlib.closing(sqlite3.connect(self.path)) as db, db:
            for history, df, clear in changes:
                self._insert(db, self._name(table, history), ddl.create(table, "sqlite", history=history), df, clear)
            if batch is not None:
                db.execute("CREATE TABLE IF NOT EXISTS loaded_batches (table_name TEXT, batch TEXT, PRIMARY KEY (table_name, batch))")
                db.execute("INSERT INTO loaded_batches VALUES (?, ?)", (table.name, batch))

    @staticmethod
    def _name(table: Table, history: bool = False) -> str:
        return table.name.rpartition(".")[2] + ("_history" if history else "")

    def _has(self, db: sqlite3.Connection, name: str) -> bool:
        return bool(db.execute("SELECT 1 FROM sqlite_master WHERE type = 'table' AND name = ?", (name,)).fetchone())

    def _read(self, table: Table, history: bool = False) -> DataFrame | None:
        name = self._name(table, history)
        with contextlib.closing(sqlite3.connect(self.path)) as db:
            if not self._has(db, name):
                return None
            if db.execute(f"SELECT count(*) FROM {quote(name, 'sqlite')}").fetchone()[0] > self.READ_MOST:
                raise ValueError(f"{name} has over {self.READ_MOST} rows: too many for a SQLite store")
            schema = ddl.schema(table)
            rows = db.execute(f"SELECT {', '.join(quote(f.name, 'sqlite') for f in schema)} FROM {quote(name, 'sqlite')}").fetchall()
        text = self.spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], ", ".join(f"`{f.name}` string" for f in schema))
        return text.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])

    def read(self, table: Table) -> DataFrame | None:
        return self._read(table)

    def append(self, table: Table, df: DataFrame, batch: str | None = None) -> None:
        self._load(table, [(False, df, False)], batch)

    def replace(self, table: Table, df: DataFrame) -> None:
        self._load(table, [(False, written(df), True)], None)

    def read_history(self, table: Table) -> DataFrame | None:
        return self._read(table, True)

    def append_history(self, table: Table, df: DataFrame) -> None:
        self._load(table, [(True, df, False)], None)

    def merge(self, table: Table, live: DataFrame, closed: DataFrame, batch: str | None = None) -> None:
        self._load(table, [(True, written(closed), False), (False, written(live), True)], batch)

    def has_batch(self, table: Table, batch: str) -> bool:
        with contextlib.closing(sqlite3.connect(self.path)) as db:
            return self._has(db, "loaded_batches") and bool(db.execute("SELECT 1 FROM loaded_batches WHERE table_name = ? AND batch = ?", (table.name, batch)).fetchone())


STORES: dict[str, Callable[[SparkSession, str], TableStore]] = {
    "parquet": ParquetStore,
    "sqlite": lambda spark, dsn: SqliteStore(spark, dsn.removeprefix("file:").split("?")[0]),
    "postgres": lambda spark, dsn: JdbcStore(spark, dsn, "postgres"),
    "mssql": lambda spark, dsn: JdbcStore(spark, dsn, "mssql"),
    "derby": lambda spark, dsn: JdbcStore(spark, dsn, "derby", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver"),
}


def register(kind: str, make: Callable[[SparkSession, str], TableStore]) -> None:
    STORES[kind] = make


def open_store(spark: SparkSession, kind: str, dsn: str) -> TableStore:
    if kind not in STORES:
        raise ValueError(f"unsupported storage.kind: {kind}; known: {', '.join(sorted(STORES))}")
    return STORES[kind](spark, dsn)


# -- between stores


def copy_table(source: TableStore, target: TableStore, table: Table, columns: list[str] | None = None) -> int:
    """Append a table's rows (of some columns) to another store's; the number of rows."""
    rows = source.read(table)
    if rows is None:
        return 0
    rows = written(rows.select(*(columns or rows.columns)))
    target.append(table, rows)
    return rows.count()


def ensure_from_pipeline(store: TableStore, p: Pipeline, name: str) -> Table:
    """The table that a document's contract (else its coerce types) tells, made empty where it isn't there."""
    table = ddl.from_pipeline(p, name)
    if store.read(table) is None:
        store.append(table, store.spark.createDataFrame([], ddl.schema(table)))
    return table


def copy_lines(df: DataFrame) -> DataFrame:
    """Rows as the lines of PostgreSQL's COPY text format (column ``value``): tabs between cells, \\N for nulls, escaped signs. ``write.text`` makes files that COPY loads."""
    cell = lambda n: F.coalesce(F.replace(F.replace(F.replace(F.replace(F.col(n).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("\t"), F.lit("\\t")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("\\N"))
    return df.select(F.concat_ws("\t", *[cell(n) for n in df.columns]).alias("value"))
