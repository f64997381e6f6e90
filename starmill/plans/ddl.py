"""Types and CREATE TABLE texts for Spark and four databases."""

from __future__ import annotations

from pyspark.sql import types as T

from starmill.functions.coerce import normalize_kind
from starmill.functions.text import quote
from starmill.plans.config import Pipeline, Table

SPARK = {"int": T.LongType(), "bool": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampType(), "float": T.DoubleType(), "text": T.StringType()}
TYPES = {
    "postgres": {"int": "BIGINT", "bool": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMPTZ", "float": "DOUBLE PRECISION", "text": "TEXT", "serial": "BIGSERIAL"},
    "mssql": {"int": "BIGINT", "bool": "BIT", "date": "DATE", "timestamp": "DATETIME2", "float": "DECIMAL(38,10)", "text": "NVARCHAR(MAX)", "serial": "BIGINT IDENTITY(1,1)"},
    "sqlite": {"int": "INTEGER", "bool": "INTEGER", "date": "TEXT", "timestamp": "TEXT", "float": "REAL", "text": "TEXT", "serial": "INTEGER"},
    "derby": {"int": "BIGINT", "bool": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "float": "DOUBLE", "text": "VARCHAR(32672)", "serial": "BIGINT"},
    "spark": {"int": "BIGINT", "bool": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "float": "DOUBLE", "text": "STRING", "serial": "BIGINT"},
}
META = {"valid_from": ("timestamp", False), "valid_to": ("timestamp", True), "changed_at": ("timestamp", False)}


def map_type(kind: str, dialect: str) -> str:
    return TYPES[dialect].get(normalize_kind(kind), TYPES[dialect]["text"])


def schema(table: Table) -> T.StructType:
    """A table's columns as Spark's: key, columns, and the history's, each once."""
    fields = [T.StructField(table.primary_key, T.LongType(), False)] if table.primary_key else []
    fields += [T.StructField(n, SPARK.get(normalize_kind(c.get("type", "")), T.StringType()), bool(c.get("nullable"))) for n, c in table.columns.items()]
    if table.history:
        fields += [T.StructField(n, T.TimestampType(), null) for n, (_, null) in META.items() if n not in table.columns]
    return T.StructType(fields)


def create(table: Table, dialect: str = "spark", history: bool = False) -> str:
    """CREATE TABLE of a table, or of its history: the same columns without key and constraints."""
    name = table.name + ("_history" if history else "")
    if dialect in ("sqlite", "spark", "derby"):
        name = name.rpartition(".")[2]
    # what isn't said to be null may not be null, but in two dialects
    loose = dialect in ("mssql", "sqlite")
    lines = []
    if table.primary_key:
        serial = TYPES[dialect]["serial"] if not history else TYPES[dialect]["int"]
        key = "" if history or dialect == "spark" else (" NOT NULL PRIMARY KEY" if dialect == "derby" else " PRIMARY KEY") + (" AUTOINCREMENT" if dialect == "sqlite" else "")
        lines.append(f"{quote(table.primary_key, dialect)} {serial}{key}")
    for n, c in table.columns.items():
        need = "" if c.get("nullable", loose) or dialect in ("spark", "derby") else " NOT NULL"
        ref = c.get("references")
        points = ""
        if ref and not history and dialect not in ("spark", "derby"):
            where, _, column = ref.partition("(")
            points = f" REFERENCES {quote(where.rpartition('.')[2] if dialect == 'sqlite' else where, dialect)}" + (f"({quote(column.rstrip(')'), dialect)})" if column else "")
        lines.append(f"{quote(n, dialect)} {map_type(c.get('type', 'text'), dialect)}{need}{points}")
    if table.history:
        lines += [f"{quote(n, dialect)} {map_type(k, dialect)}{'' if null or dialect == 'spark' else ' NOT NULL'}" for n, (k, null) in META.items() if n not in table.columns]
    if not history and dialect not in ("spark", "derby") and not table.history:
        lines += [f"UNIQUE ({', '.join(quote(c, dialect) for c in u)})" for u in table.unique]
    body = ",\n  ".join(lines)
    if dialect == "derby":
        return f"CREATE TABLE {quote(name, dialect)} (\n  {body}\n)"
    if dialect == "mssql":
        return f"IF OBJECT_ID(N'{name}', N'U') IS NULL\nCREATE TABLE {quote(name, dialect)} (\n  {body}\n)"
    return f"CREATE TABLE IF NOT EXISTS {quote(name, dialect)} (\n  {body}\n)" + (" USING parquet" if dialect == "spark" else "")


def from_pipeline(p: Pipeline, name: str) -> Table:
    """A single table: the contract's fields, else those of the coerce types, all else text."""
    if p.contract:
        columns = {f["name"]: {"type": f.get("type", "text"), "nullable": not f.get("required", False)} for f in p.contract}
    else:
        columns = {n: {"type": p.types.get(n, "text"), "nullable": True} for n in p.input_columns()}
    return Table(name, "fact", columns)
