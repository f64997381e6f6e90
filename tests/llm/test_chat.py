import hashlib
import json

from starmill.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, line string, status int"


def run(spark, rows):
    d = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    return chat.format_chats(d, chat.tool_schemas(spark)).orderBy("conv_id", "place").collect()


def call(*calls):
    return json.dumps({"tool_calls": [{"id": i, "name": n, "arguments": a} for i, n, a in calls]})


def result(i, text="r"):
    return json.dumps({"tool_call_id": i, "content": text})


def test_links_order_and_statuses(spark):
    rows = [
        (1, 0, "user", "hi"),
        (1, 1, "assistant", call(("b", "fetch", {"url": "$ref:a"}), ("a", "search", {"query": 'x "q"', "limit": 3}))),
        (1, 2, "tool", result("a")),
        (1, 0, "tool", result("b")),
        (1, 5, "tool", result("zz")),
        (1, 6, "tool", result("a", "again")),
        (2, 0, "assistant", call(("q", "search", {"query": "$ref:q"}), ("n", "nope", {}), ("m", "search", {"limit": 1}), ("t", "search", {"query": "y", "limit": "many"}), ("e", "search", {"query": "y", "more": 1}), ("d", "fetch", {"url": "$ref:none"}), ("d", "fetch", {"url": "u"}))),
    ]
    got = run(spark, rows)
    one = [(r["kind"], r["call_id"], r["status"]) for r in got if r["conv_id"] == 1]
    assert one == [("message", None, "ok"), ("call", "a", "ok"), ("result", "a", "ok"), ("call", "b", "ok"), ("result", "b", "ok"), ("result", "zz", "orphan"), ("result", "a", "repeated")]
    two = sorted((r["call_id"], r["status"]) for r in got if r["conv_id"] == 2)
    assert two == [("d", "dangling"), ("d", "duplicate_id"), ("e", "extra:more"), ("m", "missing:query"), ("n", "unknown_tool"), ("q", "cycle"), ("t", "type:limit")]
    assert [r["place"] for r in got if r["conv_id"] == 1] == list(range(7))
    for r in got:
        body = json.loads(r["line"])
        assert r["line"] == json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_plain_tables(spark):
    rows = [(None, None, None, None), (3, 1, "user", "é\n"), (3, 1, "user", "é\n"), (3, 0, "assistant", "{not json"), (4, 9, "tool", "free text")]
    got = run(spark, rows)
    assert [(r["conv_id"], r["place"]) for r in got] == [(None, 0), (3, 0), (3, 1), (3, 2), (4, 0)]
    assert {r["kind"] for r in got} == {"message"}
    assert run(spark, []) == []


def test_long_conversation_is_gapless(spark):
    rows = [(7, t, "user" if t % 2 else "assistant", str(t)) for t in range(2000)]
    got = run(spark, rows)
    assert [r["place"] for r in got] == list(range(2000)) == [r["turn"] for r in got]


def test_long_chain_is_no_cycle(spark):
    n = 200
    rows = [(1, 0, "assistant", call(*[(f"c{k}", "search", {"query": f"$ref:c{k - 1}" if k else "x"}) for k in reversed(range(n))]))]
    rows += [(1, 1 + k, "tool", result(f"c{k}")) for k in range(n)]
    rows += [(2, 0, "assistant", call(("a", "search", {"query": "$ref:b"}), ("b", "search", {"query": "$ref:a"})))]
    got = run(spark, rows)
    assert {r["status"] for r in got if r["conv_id"] == 2} == {"cycle"}
    one = [(r["kind"], r["call_id"]) for r in got if r["conv_id"] == 1]
    assert {r["status"] for r in got if r["conv_id"] == 1} == {"ok"}
    assert one == [(kind, f"c{k}") for k in range(n) for kind in ("call", "result")]


def test_arguments_keep_their_types(spark):
    good = {"place": "02134", "days": 5}
    odd = {"place": "true", "days": "5"}
    rows = [(1, 0, "assistant", call(("g", "weather", good), ("o", "weather", odd), ("n", "weather", {"place": 5}), ("x", "nope", {"a": "5", "b": {"z": "1", "a": [1, "2"]}, "c": "[x]", "d": None, "e": True, "f": "null"})))]
    got = {r["call_id"]: r for r in run(spark, rows)}
    args = {i: json.loads(r["line"])["arguments"] for i, r in got.items()}
    assert args["g"] == good and args["o"] == odd and args["n"] == {"place": 5}
    assert args["x"] == {"a": "5", "b": {"z": "1", "a": [1, "2"]}, "c": "[x]", "d": None, "e": True, "f": "null"}
    assert {i: r["status"] for i, r in got.items()} == {"g": "ok", "o": "type:days", "n": "type:place", "x": "unknown_tool"}
    for r in got.values():
        assert r["line"] == json.dumps(json.loads(r["line"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def plain_version(rows, schemas=chat.TOOLS):
    """Statuses, links and order of calls and results, by hand: (conv, kind, id) -> (status, linked)."""
    import re

    wanted = {}
    for tool, argument, kind, required in schemas:
        wanted.setdefault(tool, []).append((argument, kind, required))
    parts = []
    for conv, turn, role, text in rows:
        try:
            body = json.loads(text) if text and text.startswith("{") else None
        except ValueError:
            body = None
        if role == "assistant" and isinstance(body, dict) and body.get("tool_calls"):
            parts += [(conv, turn, role, text, i, "call", c) for i, c in enumerate(body["tool_calls"])]
        elif role == "tool" and isinstance(body, dict) and "tool_call_id" in body:
            parts.append((conv, turn, role, text, 0, "result", body))
    parts.sort(key=lambda p: (p[0], p[1], p[2], p[3], p[4]))
    first, answers, out = {}, {}, []
    for p in parts:
        if p[5] == "call":
            first.setdefault((p[0], p[6]["id"]), p)
        else:
            answers.setdefault((p[0], p[6]["tool_call_id"]), p)

    def needs(p):
        return list(dict.fromkeys(x for v in p[6]["arguments"].values() if isinstance(v, str) for x in re.findall(r"\$ref:([A-Za-z0-9_.-]+)", v)))

    def wait(key, path=()):
        if key in path:
            return "cycle"
        own = [(key[0], n) for n in needs(first[key])]
        if any(n not in first for n in own):
            return "dangling" if not path else None
        return "cycle" if any(wait(n, (*path, key)) == "cycle" for n in own) else None

    kinds = {"string": str, "integer": int}
    for p in parts:
        conv, body = p[0], p[6]
        if p[5] == "result":
            key = (conv, body["tool_call_id"])
            out.append((conv, "result", key[1], "orphan" if key not in first else "ok" if answers[key] is p else "repeated"))
            continue
        key, args = (conv, body["id"]), body["arguments"]
        spec = wanted.get(body["name"])
        status = "ok"
        if first[key] is not p:
            status = "duplicate_id"
        elif wait(key):
            status = wait(key)
        elif spec is None:
            status = "unknown_tool"
        else:
            spec = sorted(spec)
            missing = [a for a, _, r in spec if r and a not in args]
            bad = [a for a, k, _ in spec if a in args and (not isinstance(args[a], kinds[k]) or isinstance(args[a], bool))]
            extra = sorted(set(args) - {a for a, _, _ in spec})
            status = f"missing:{missing[0]}" if missing else f"type:{bad[0]}" if bad else f"extra:{extra[0]}" if extra else "ok"
        out.append((conv, "call", key[1], status))
    return sorted(out)


def test_equals_a_plain_version(spark):
    import random

    rng = random.Random(4)
    rows = []
    for conv in range(25):
        for turn in range(12):
            if rng.random() < 0.6:
                calls = []
                for _ in range(rng.randint(1, 3)):
                    ref = f"$ref:k{rng.randint(0, 9)}" if rng.random() < 0.4 else "x"
                    args = rng.choice([{"query": ref}, {"query": ref, "limit": rng.choice([3, "3", True])}, {}, {"query": 5}, {"url": ref, "z": 1}, {"place": ref, "days": 2}])
                    calls.append((f"k{rng.randint(0, 7)}", rng.choice(["search", "fetch", "weather", "none"]), args))
                rows.append((conv, turn, "assistant", call(*calls)))
            rows.append((conv, turn, "tool", result(f"k{rng.randint(0, 9)}", str(turn))))
    got = run(spark, rows)
    assert sorted((r["conv_id"], r["kind"], r["call_id"], r["status"]) for r in got) == plain_version(rows)
    for conv in range(25):
        own = [r for r in got if r["conv_id"] == conv]
        assert [r["place"] for r in own] == list(range(len(own)))
        at = {}
        for r in own:
            if r["kind"] == "call" and r["status"] not in ("duplicate_id", "cycle"):
                at[r["call_id"]] = r["place"]
            if r["kind"] == "result" and r["status"] == "ok" and r["call_id"] in at:
                assert r["place"] > at[r["call_id"]]


def test_query_links_derived_calls(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"text {c} {t}") for c in range(3) for t in range(12)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = chat.op8(spark, str(tmp_path)).orderBy("conv_id", "place").collect()
    assert len(got) == 3 * (12 + 6 + 5) and {r["status"] for r in got} == {"ok"}
    assert sorted({r["call_id"] for r in got if r["linked"] is False}) == ["c9"]
    lines = [json.loads(r["line"]) for r in got if r["kind"] == "call" and r["conv_id"] == 1]
    sha = lambda t: hashlib.sha1(f"text 1 {t}".encode()).hexdigest()
    assert [x["arguments"]["query"] for x in lines] == [("" if t % 4 == 1 else f"$ref:c{t - 2} ") + sha(t) for t in range(1, 12, 2)]


def test_very_long_texts(spark):
    text = "word " * 400_000
    got = run(spark, [(1, 0, "user", text), (1, 1, "assistant", call(("a", "search", {"query": text})))])
    assert json.loads(got[0]["line"])["content"] == text and json.loads(got[1]["line"])["arguments"]["query"] == text
