"""Pipeline documents: JSON -> dataclasses; checks at run time, and a linter with paths."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field

from starmill.functions.coerce import DEFAULT_LAYOUT, KINDS


@dataclass(frozen=True)
class Source:
    """Where a target column comes from: a field of the row, or the id of a key in a dimension."""

    target: str
    field: str | None = None
    table: str | None = None
    key: str | None = None


@dataclass
class Table:
    name: str
    kind: str
    columns: dict[str, dict] = field(default_factory=dict)
    primary_key: str | None = None
    primary_type: str = "bigserial"
    unique: list[list[str]] = field(default_factory=list)
    sources: list[Source] = field(default_factory=list)
    conflict: list[str] = field(default_factory=list)
    business_key: list[str] = field(default_factory=list)
    history: bool = False
    cache_key: str | None = None
    cache_value: str | None = None
    auto_create: bool = True

    def nullable(self, column: str) -> bool:
        return bool(self.columns.get(column, {}).get("nullable", False))


@dataclass
class Pipeline:
    job: str
    source: dict
    parser: str
    parser_options: dict
    transform: list[dict]
    storage: str
    dsn: str
    tables: list[Table]
    runtime: dict

    @property
    def types(self) -> dict[str, str]:
        """All coerce types; of one column's, the last."""
        out: dict[str, str] = {}
        for t in self.transform:
            if t.get("kind") == "coerce":
                out |= t.get("options", {}).get("types") or {}
        return out

    @property
    def layout(self) -> str:
        return next((x for t in self.transform if t.get("kind") == "coerce" and (x := t.get("options", {}).get("layout"))), DEFAULT_LAYOUT)

    def first(self, kind: str) -> dict | None:
        return next((t.get("options") or {} for t in self.transform if t.get("kind") == kind), None)

    @property
    def contract(self) -> list[dict]:
        return ((self.first("validate") or {}).get("contract") or {}).get("fields") or []

    @property
    def strict(self) -> bool:
        return (self.first("validate") or {}).get("policy", "lenient") == "strict"

    def input_columns(self) -> list[str]:
        """The columns that a run needs from the source: of storage, types, the contract and the hash; not the hash's own."""
        made = (self.first("hash") or {}).get("target_field")
        need = {s.field for t in self.tables for s in t.sources if s.field} | {s.key for t in self.tables for s in t.sources if s.key}
        need |= set(self.types) | {f["name"] for f in self.contract} | set((self.first("hash") or {}).get("fields") or [])
        return sorted(need - {made, None, ""})


def _table(t: dict) -> Table:
    load = t.get("load") or {}
    cache = load.get("cache") or {}
    sources = []
    for s in load.get("from_rows") or []:
        look = s.get("lookup")
        # the field of the match whose name comes first; the dimension's side is its cache key
        match = sorted((look.get("match") or {}).items()) if look else []
        sources.append(Source(s["target_column"], s.get("source_field"), look["table"] if look else None, match[0][1] if match else None))
    pk = t.get("primary_key") or {}
    history = load.get("history") or {}
    return Table(
        name=t["name"],
        kind=load.get("kind", ""),
        columns={c["name"]: c for c in t.get("columns") or []},
        primary_key=pk.get("name"),
        primary_type=pk.get("type", "bigserial"),
        unique=[c["columns"] for c in t.get("constraints") or [] if c.get("kind") == "unique"],
        sources=sources,
        conflict=(load.get("dedupe") or {}).get("conflict_columns") or [],
        business_key=history.get("business_key") or [],
        history=bool(history.get("enabled")),
        cache_key=cache.get("key_column"),
        cache_value=cache.get("value_column"),
        auto_create=t.get("auto_create_table", True),
    )


def load(document: str | dict) -> Pipeline:
    d = json.loads(document) if isinstance(document, str) else document
    storage = d.get("storage") or {}
    db = storage.get("db") or {}
    return Pipeline(d.get("job", ""), d.get("source") or {}, (d.get("parser") or {}).get("kind", ""), (d.get("parser") or {}).get("options") or {}, d.get("transform") or [], storage.get("kind", ""), os.path.expandvars(db.get("dsn", "")), [_table(t) for t in db.get("tables") or []], d.get("runtime") or {})


def check(p: Pipeline) -> None:
    """Raise on what a run can't do without."""
    if not p.source.get("file", {}).get("path"):
        raise ValueError("source.file.path must not be empty")
    if p.parser not in ("csv", "json", "xml"):
        raise ValueError(f"unsupported parser.kind: {p.parser}")
    if not p.storage:
        raise ValueError("storage.kind must be set")
    if not p.tables:
        raise ValueError("storage.db.tables must not be empty")
    names = {t.name for t in p.tables}
    for t in p.tables:
        if t.kind not in ("dimension", "fact"):
            raise ValueError(f"{t.name}: load.kind must be dimension or fact")
        if t.kind == "dimension" and not (t.cache_key and t.cache_value and t.sources):
            raise ValueError(f"{t.name}: a dimension needs a cache key, a cache value and a source field")
        if t.history and not t.business_key:
            raise ValueError(f"{t.name}: history needs a business key")
        for s in t.sources:
            if s.table and (s.table not in names or not s.key):
                raise ValueError(f"{t.name}.{s.target}: lookup needs a known table and a match")


@dataclass(frozen=True)
class Issue:
    severity: str
    path: str
    message: str


TRANSFORMS = ("coerce", "hash", "validate", "normalize", "dedup", "require")


def lint(d: dict) -> list[Issue]:
    """Everything questionable in a document, with the path to it."""
    out: list[Issue] = []
    error = lambda path, message: out.append(Issue("error", path, message))
    warn = lambda path, message: out.append(Issue("warning", path, message))
    if not d.get("job"):
        warn("job", "is empty")
    if (d.get("source") or {}).get("kind", "file") != "file":
        error("source.kind", "only file is known")
    if not ((d.get("source") or {}).get("file") or {}).get("path"):
        error("source.file.path", "is empty")
    if (d.get("parser") or {}).get("kind") not in ("csv", "json", "xml"):
        error("parser.kind", "must be csv, json or xml")
    seen = []
    for i, t in enumerate(d.get("transform") or []):
        path, kind, options = f"transform[{i}]", t.get("kind"), t.get("options") or {}
        if kind not in TRANSFORMS:
            error(f"{path}.kind", f"unknown transform {kind!r}")
        if kind in ("hash", "validate") and kind in seen:
            warn(path, f"only the first {kind} counts")
        if kind == "coerce":
            for name, type_ in (options.get("types") or {}).items():
                if type_ not in (*KINDS, "text", "string"):
                    warn(f"{path}.options.types.{name}", f"{type_!r} passes as text")
        if kind == "hash":
            if not options.get("fields"):
                error(f"{path}.options.fields", "is empty")
            if not options.get("target_field"):
                error(f"{path}.options.target_field", "is empty")
        if kind == "validate":
            if options.get("policy", "lenient") not in ("lenient", "strict"):
                error(f"{path}.options.policy", "must be lenient or strict")
            if not ((options.get("contract") or {}).get("fields")):
                warn(f"{path}.options.contract", "has no fields")
        seen.append(kind)
    storage = d.get("storage") or {}
    if not storage.get("kind"):
        error("storage.kind", "is empty")
    tables = (storage.get("db") or {}).get("tables") or []
    names = [t.get("name") for t in tables]
    if not tables:
        error("storage.db.tables", "is empty")
    for i, t in enumerate(tables):
        path = f"storage.db.tables[{i}]"
        if names.count(t.get("name")) > 1:
            error(f"{path}.name", "repeats")
        own = {c.get("name") for c in t.get("columns") or []}
        for j, c in enumerate(t.get("constraints") or []):
            if c.get("kind") != "unique":
                error(f"{path}.constraints[{j}].kind", f"unknown constraint {c.get('kind')!r}")
            elif set(c.get("columns") or []) - own:
                error(f"{path}.constraints[{j}].columns", "names unknown columns")
        load_ = t.get("load") or {}
        if load_.get("kind") not in ("dimension", "fact"):
            error(f"{path}.load.kind", "must be dimension or fact")
        for j, s in enumerate(load_.get("from_rows") or []):
            look = s.get("lookup")
            if look and look.get("table") not in names:
                error(f"{path}.load.from_rows[{j}].lookup.table", "is unknown")
            if look and not look.get("match"):
                error(f"{path}.load.from_rows[{j}].lookup.match", "is empty")
            if s.get("target_column") not in own and s.get("target_column") != (t.get("primary_key") or {}).get("name"):
                warn(f"{path}.load.from_rows[{j}].target_column", "is no column of the table")
    for name in ("batch_size", "channel_buffer", "loader_workers", "transform_workers"):
        if int((d.get("runtime") or {}).get(name) or 0) < 0:
            error(f"runtime.{name}", "is negative")
    return out
