"""Tool-call linking and canonical chat lines, in DataFrame expressions only.

A message (conv_id, turn, role, text) may hold calls: an assistant's text that is
a JSON object with ``tool_calls``, a list of {"id", "name", "arguments"}; a text of
role "tool" that is a JSON object with ``tool_call_id`` and ``content`` is a result.
Calls and results are joined by (conv_id, identifier); a call may need earlier
results by naming them in its arguments as "$ref:<id>". Each message, call and
result becomes one line of canonical JSON (keys sorted, no spaces), placed so that
a result follows its call and a call follows the results it needs, and that turns
keep their order otherwise.

Status of a call: ``ok``; ``unknown_tool`` (no schema); ``missing:<argument>``;
``type:<argument>``; ``extra:<argument>``; ``duplicate_id`` (an earlier call of the
conversation has the identifier); ``cycle`` (it waits, at whatever distance, for
itself); ``dangling`` (it names an identifier that no call has). The first that
holds is told. Status of a result: ``ok``, ``orphan`` (no such call) or ``repeated``
(not the first result of its call). A call without a result has linked = false.

Defined results: null or empty texts are messages with the text ""; texts that
aren't such JSON are plain messages; a null role is "unknown"; a null conv_id is a
conversation of its own; null turns come last, by a digest of their texts; messages of
one turn are ordered by role and text; repeated rows all stay; very long texts are read and written whole; an
empty table gives no rows; extra columns are ignored. No step collects a conversation:
places are counted by blocks of it, rows without a turn by blocks of their texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import drop_scratch, spill, table

CALLS = "struct<tool_calls:array<struct<id:string,name:string,arguments:map<string,string>>>>"
TYPED = "struct<tool_calls:array<struct<arguments:map<string,variant>>>>"
RESULT = "struct<tool_call_id:string,content:string>"
SCHEMA_TYPE = "tool string, argument string, kind string, required boolean"

#: the tools that the query's conversations may call
TOOLS = [
    ("search", "query", "string", True),
    ("search", "limit", "integer", False),
    ("fetch", "url", "string", True),
    ("calculate", "expression", "string", True),
    ("weather", "place", "string", True),
    ("weather", "days", "integer", False),
]
_KINDS = {"integer": r"^-?\d+$", "number": r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$", "boolean": "^(true|false)$", "object": r"(?s)^\s*\{", "array": r"(?s)^\s*\["}
LAST = (1 << 62) - 1


def _parts(messages: DataFrame) -> DataFrame:
    """Messages, calls and results, one row each, with their place in the turn."""
    m = messages.select("conv_id", F.coalesce(F.col("turn").cast("long"), F.lit(LAST)).alias("turn"), F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    m = m.withColumn("calls", F.when((F.col("role") == "assistant") & F.col("text").startswith("{"), F.from_json("text", CALLS)["tool_calls"]))
    m = m.withColumn("typed", F.when(F.col("role") == "assistant", F.when(F.col("text").startswith("{"), F.from_json("text", TYPED)["tool_calls"])))
    m = m.withColumn("result", F.when((F.col("role") == "tool") & F.col("text").startswith("{"), F.from_json("text", RESULT)))
    is_call = F.coalesce(F.size("calls") > 0, F.lit(False))
    m = m.withColumn("kind", F.when(is_call, "call").when(F.col("result.tool_call_id").isNotNull(), "result").otherwise("message"))
    none = F.array(F.lit(None).cast("struct<id:string,name:string,arguments:map<string,string>>"))
    m = m.select("conv_id", "turn", "role", "text", "kind", "result", "typed", F.posexplode(F.when(is_call, F.col("calls")).otherwise(none)).alias("nth", "call"))
    # the JSON type of each argument, and nested values with sorted keys; null where an object repeats a key
    shape = F.transform_values(F.get("typed", F.col("nth"))["arguments"], lambda k, v: F.struct(_type(F.schema_of_variant(v)).alias("type"), F.to_json(v).alias("json")))
    return m.select("conv_id", "turn", "role", "text", "kind", "result", "nth", "call", F.when(F.col("kind") == "call", shape).alias("shape"))


def _type(told: F.Column) -> F.Column:
    c = F.when(told == "STRING", "string").when(told == "BOOLEAN", "boolean").when(told == "VOID", "null")
    return c.when(told.startswith("OBJECT"), "object").when(told.startswith("ARRAY"), "array").otherwise("number")


def _type_of(name: F.Column) -> F.Column:
    """The JSON type of an argument; null if it isn't known."""
    return F.element_at("shape", name)["type"]


def _statuses(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """A status for every call: its arguments against the schema of its tool."""
    tools = schemas.groupBy(F.col("tool").alias("_tool")).agg(F.array_sort(F.collect_list(F.struct("argument", "kind", "required"))).alias("wanted"))
    # one row a tool: as large as the schemas, which the caller states
    d = calls.join(tools, F.col("name") == F.col("_tool"), "left")
    value = lambda a: F.element_at(F.col("arguments"), a["argument"])
    missing = F.get(F.filter("wanted", lambda a: a["required"] & value(a).isNull()), F.lit(0))["argument"]

    def wrong(a):
        told = _type_of(a["argument"])
        test = (a["kind"] == "string") & (told != "string")
        for kind, pattern in _KINDS.items():
            json = "number" if kind == "integer" else kind
            test = F.when(a["kind"] == kind, (told != json) | ~value(a).rlike(pattern)).otherwise(test)
        return value(a).isNotNull() & F.coalesce(test, F.lit(False))

    bad = F.get(F.filter("wanted", wrong), F.lit(0))["argument"]
    names = F.transform("wanted", lambda a: a["argument"])
    extra = F.get(F.array_sort(F.array_except(F.map_keys("arguments"), names)), F.lit(0))
    status = F.when(F.col("wanted").isNull(), "unknown_tool").when(missing.isNotNull(), F.concat(F.lit("missing:"), missing)).when(bad.isNotNull(), F.concat(F.lit("type:"), bad)).when(extra.isNotNull(), F.concat(F.lit("extra:"), extra))
    return d.withColumn("status", status).drop("_tool", "wanted")


def _depths(calls: DataFrame, results: DataFrame) -> DataFrame:
    """(conv, id, at, level, wait): the turn at which each first call of its identifier can stand, and the longest chain before it; wait is "cycle" or "dangling" if its needs can't be met.

    By doubling: round k has the calls that stand exactly 2**k needs before each call,
    so that a chain of n calls takes about log2(n) rounds, each written. A call that has
    any when 2**k is over the number of its conversation's calls waits for a cycle.
    """
    told = results.where("copy = 1").select("conv", "id", F.col("turn").alias("told"))
    first = calls.where("copy = 1").select("conv", "id", "turn", "needs").join(told, ["conv", "id"], "left")
    wants = first.where("size(needs) > 0")
    if not wants.limit(1).count():
        return first.select("conv", "id", F.col("turn").alias("at"), F.lit(0).alias("level"), F.lit(None).cast("string").alias("wait"))
    known = first.select(F.col("conv").alias("kc"), F.col("id").alias("kid"))
    need = wants.select("conv", F.col("id").alias("x"), F.explode("needs").alias("y"))
    need = spill(need.join(known, (F.col("conv") == F.col("kc")) & (F.col("y") == F.col("kid")), "left"), "needs")
    dangling = need.where("kid IS NULL").select("conv", "x").distinct()
    # a dangling call waits for nothing
    far = spill(need.where("kid IS NOT NULL").select("conv", "x", "y").join(dangling, ["conv", "x"], "left_anti"), "needs")
    most = first.groupBy("conv").count().agg(F.max("count")).first()[0]
    own = first.join(dangling.select("conv", F.col("x").alias("id"), F.lit(True).alias("d")), ["conv", "id"], "left")
    state = spill(own.select("conv", "id", "turn", F.greatest("told", "turn").alias("ready"), F.lit(None).cast("long").alias("up"), F.lit(0).cast("long").alias("level"), "d"), "depths")
    drop_scratch(need)
    hops = 1
    while hops <= most and far.limit(1).count():
        before = state.select(F.col("conv").alias("sc"), F.col("id").alias("sid"), F.greatest("ready", "up").alias("nat"), F.col("level").alias("nlevel"))
        met = far.join(before, (F.col("conv") == F.col("sc")) & (F.col("y") == F.col("sid")))
        met = met.groupBy("conv", F.col("x").alias("id")).agg(F.max("nat").alias("m"), (F.max("nlevel") + hops).alias("l"))
        new = spill(state.join(met, ["conv", "id"], "left").select("conv", "id", "turn", "ready", F.greatest("up", "m").alias("up"), F.greatest("level", "l").alias("level"), "d"), "depths")
        step = far.select(F.col("conv").alias("nc"), F.col("x").alias("via"), F.col("y").alias("z"))
        later = spill(far.join(step, (F.col("conv") == F.col("nc")) & (F.col("y") == F.col("via"))).select("conv", "x", F.col("z").alias("y")).distinct(), "needs")
        drop_scratch(state, far)
        state, far, hops = new, later, hops * 2
    stuck = far.select("conv", F.col("x").alias("id"), F.lit(True).alias("s")).distinct()
    out = state.join(stuck, ["conv", "id"], "left")
    wait = F.when(F.col("s"), "cycle").when(F.col("d"), "dangling")
    return out.select("conv", "id", F.when(F.col("s"), F.col("turn")).otherwise(F.greatest("turn", "up")).alias("at"), F.when(F.col("s"), 0).otherwise(F.col("level")).cast("int").alias("level"), wait.alias("wait"))


def _json(pairs: dict) -> F.Column:
    """A JSON object with sorted keys; a null value leaves its key out."""
    return F.to_json(F.struct(*[F.lit(v).alias(k) if isinstance(v, str) else v.alias(k) for k, v in sorted(pairs.items())]))


def format_chats(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """conv_id, place (from 0), turn, kind, call_id, status, linked and line of every message, call and result."""
    parts = _parts(messages).withColumn("conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    plain = parts.where("kind = 'message'").select("conv", "conv_id", "turn", F.lit(0).alias("level"), F.lit(0).alias("step"), "nth", "role", "text", "kind", F.lit(None).cast("string").alias("call_id"), F.lit("ok").alias("status"), F.lit(None).cast("boolean").alias("linked"), _json({"role": F.col("role"), "content": F.col("text"), "type": "message"}).alias("line"))
    tools = parts.where("kind <> 'message'")
    if not tools.limit(1).count():
        lines = plain
    else:
        lines = plain.unionByName(_linked(spill(tools, "tools"), schemas))
    return _placed(lines)


def _linked(tools: DataFrame, schemas: DataFrame) -> DataFrame:
    calls = tools.where("kind = 'call'").select("conv", "conv_id", "turn", "nth", "role", "text", F.coalesce("call.id", F.lit("")).alias("id"), F.coalesce("call.name", F.lit("")).alias("name"), F.coalesce("call.arguments", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).alias("arguments"), "shape")
    calls = calls.withColumn("copy", F.row_number().over(Window.partitionBy("conv", "id").orderBy("turn", "role", "text", "nth")))
    calls = calls.withColumn("needs", F.array_distinct(F.flatten(F.transform(F.map_values("arguments"), lambda v: F.regexp_extract_all(v, F.lit(r"\$ref:([A-Za-z0-9_.-]+)"), F.lit(1))))))
    calls = spill(_statuses(calls, schemas), "calls")
    results = tools.where("kind = 'result'").select("conv", "conv_id", "turn", "nth", "role", "text", F.col("result.tool_call_id").alias("id"), F.coalesce("result.content", F.lit("")).alias("content"))
    results = results.withColumn("copy", F.row_number().over(Window.partitionBy("conv", "id").orderBy("turn", "role", "text", "nth")))
    depths = spill(_depths(calls, results), "placed-calls")
    answered = results.select("conv", "id").distinct().withColumn("linked", F.lit(True))
    keys = F.sort_array(F.map_keys("arguments"))
    # arguments keep their JSON types: strings in quotes, nested values with sorted keys, anything else as it came
    body = F.concat(F.lit("{"), F.array_join(F.transform(keys, lambda k: F.concat(_quoted(k), F.lit(":"), _value(k))), ","), F.lit("}"))
    c = calls.join(depths, ["conv", "id"], "left").join(answered, ["conv", "id"], "left")
    status = F.when(F.col("copy") > 1, "duplicate_id").otherwise(F.coalesce("wait", "status", F.lit("ok")))
    line = F.concat(F.lit('{"arguments":'), body, F.lit(',"id":'), _quoted(F.col("id")), F.lit(',"name":'), _quoted(F.col("name")), F.lit(',"type":"call"}'))
    c = c.select("conv", "conv_id", F.col("at").alias("turn"), F.col("level"), F.lit(1).alias("step"), "nth", "role", "text", F.lit("call").alias("kind"), F.col("id").alias("call_id"), status.alias("status"), F.coalesce("linked", F.lit(False)).alias("linked"), line.alias("line"))
    r = results.join(depths.select("conv", "id", "at", "level"), ["conv", "id"], "left")
    state = F.when(F.col("at").isNull(), "orphan").when(F.col("copy") > 1, "repeated").otherwise("ok")
    told = _json({"content": F.col("content"), "tool_call_id": F.col("id"), "type": "result"})
    r = r.select("conv", "conv_id", F.greatest("turn", F.coalesce("at", "turn")).alias("turn"), F.coalesce("level", F.lit(0)).alias("level"), F.lit(2).alias("step"), "nth", "role", "text", F.lit("result").alias("kind"), F.col("id").alias("call_id"), state.alias("status"), (state != "orphan").alias("linked"), told.alias("line"))
    return c.unionByName(r)


def _quoted(c) -> F.Column:
    return F.regexp_extract(F.to_json(F.struct(c.alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


def _value(name: F.Column) -> F.Column:
    v, told = F.element_at("arguments", name), _type_of(name)
    # of an unknown type: by its text, as far as that is JSON
    bare = v.rlike(r"^(-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?|true|false|null)$") | v.rlike(r"(?s)^\s*[\[{].*[\]}]\s*$")
    return F.when(v.isNull(), "null").when(told == "string", _quoted(v)).when(told.isin("object", "array"), F.element_at("shape", name)["json"]).when(told.isNotNull() | bare, v).otherwise(_quoted(v))


def _placed(lines: DataFrame) -> DataFrame:
    """Add place: blocks of 256 turns are counted, and of rows without a turn 256 by their level, step and text, so that no task needs a whole conversation."""
    cut = lines.withColumn("_block", F.floor(F.col("turn") / 256)).withColumn("_late", F.when(F.col("turn") == LAST, F.conv(F.substring(F.md5("text"), 1, 2), 16, 10).cast("int")).otherwise(-1))
    key = ["turn", "level", "step", "nth", "role", "text"]
    # rows without a turn stand in the order of their text's digest
    before = Window.partitionBy("conv").orderBy("_block", "_late").rowsBetween(Window.unboundedPreceding, -1)
    first = cut.groupBy("conv", "_block", "_late").count().withColumn("_first", F.coalesce(F.sum("count").over(before), F.lit(0)))
    inside = Window.partitionBy("conv", "_block", "_late").orderBy(*key)
    out = cut.withColumn("_in", F.row_number().over(inside) - 1).join(first.drop("count"), ["conv", "_block", "_late"])
    return out.select("conv_id", (F.col("_first") + F.col("_in")).cast("long").alias("place"), F.nullif("turn", F.lit(LAST)).alias("turn"), "kind", "call_id", "status", "linked", "line")


def tool_schemas(spark) -> DataFrame:
    return spark.createDataFrame(TOOLS, SCHEMA_TYPE)


def with_tools(messages: DataFrame) -> DataFrame:
    """``messages`` and, after every message of an assistant, a call that asks for the digest of its whole text and, but for every tenth turn, its result; every fourth call needs the one two turns before."""
    m = messages.select("conv_id", "turn", "role", "text")
    said = m.where("role = 'assistant' AND turn IS NOT NULL")
    ref = F.when(F.col("turn") % 4 == 3, F.concat(F.lit("$ref:c"), (F.col("turn") - 2).cast("string"), F.lit(" "))).otherwise("")
    ident = F.concat(F.lit("c"), F.col("turn").cast("string"))
    arguments = F.struct(F.concat(ref, F.sha1(F.coalesce("text", F.lit("")))).alias("query"), F.length(F.coalesce("text", F.lit(""))).alias("limit"))
    body = F.to_json(F.struct(F.array(F.struct(ident.alias("id"), F.lit("search").alias("name"), arguments.alias("arguments"))).alias("tool_calls")))
    calls = said.select("conv_id", "turn", "role", body.alias("text"))
    answer = F.to_json(F.struct(ident.alias("tool_call_id"), F.sha1(F.coalesce("text", F.lit(""))).alias("content")))
    results = said.where("turn % 10 <> 9").select("conv_id", "turn", F.lit("tool").alias("role"), answer.alias("text"))
    return m.unionByName(calls).unionByName(results)


def op8(spark, sf_dir: str) -> DataFrame:
    """All conversations, with calls and results derived from them, as the table itself has none."""
    return format_chats(with_tools(table(spark, sf_dir, "conversations")), tool_schemas(spark))
