"""Chat formatting: tool calls linked to results, ordered by their references, validated and written as canonical JSON."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from recoflow.llm.common import cut

TYPES = {"string": str, "boolean": bool, "array": list, "object": dict, "null": type(None)}
# The schemas of the tools that the registered query derives its calls for.
SCHEMAS = {
    "lookup": {"type": "object", "required": ["query", "words"], "additionalProperties": False, "properties": {
        "query": {"type": "string", "minLength": 1}, "words": {"type": "integer", "minimum": 1}, "after": {"type": "object", "required": ["$ref"]}}},
    "summarise": {"type": "object", "required": ["text"], "additionalProperties": False, "properties": {
        "text": {"type": "string"}, "words": {"type": "integer", "minimum": 0, "maximum": 200}, "after": {"type": "object", "required": ["$ref"]}}},
}


def canonical(value) -> str:
    """One text per value: keys sorted by code point, no white space, whole floats as integers, no NaN."""
    def plain(x):
        if isinstance(x, float) and x.is_integer() and abs(x) < 2 ** 53:
            return int(x)
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items()}
        return [plain(v) for v in x] if isinstance(x, list) else x
    return json.dumps(plain(value), ensure_ascii=False, sort_keys=True, separators=(",", ":"), allow_nan=False)


def problems(value, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with a value under a schema: type, enum, required, properties, items and bounds."""
    kind = schema.get("type")
    fits = (kind is None or kind == "integer" and isinstance(value, (int, float)) and not isinstance(value, bool) and float(value).is_integer()
            or kind == "number" and isinstance(value, (int, float)) and not isinstance(value, bool)
            or kind in TYPES and isinstance(value, TYPES[kind]))
    if not fits:
        return [f"{at}: not of type {kind}"]
    out = [] if "enum" not in schema or value in schema["enum"] else [f"{at}: not one of the values allowed"]
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{at}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k in sorted(value):
            if k in known:
                out += problems(value[k], known[k], f"{at}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{at}.{k}: unknown")
    if isinstance(value, list):
        out += [p for i, v in enumerate(value) for p in problems(v, schema.get("items", {}), f"{at}[{i}]")]
    if isinstance(value, str) and len(value) < schema.get("minLength", 0):
        out.append(f"{at}: too short")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            out.append(f"{at}: out of bounds")
    return out


def references(value) -> list[str]:
    """Call ids named by ``{"$ref": id}`` anywhere in a value."""
    if isinstance(value, dict):
        own = [value["$ref"]] if isinstance(value.get("$ref"), str) else []
        return own + [r for v in value.values() for r in references(v)]
    return [r for v in value for r in references(v)] if isinstance(value, list) else []


def checked_rows(batches: Iterator[pa.RecordBatch], schemas: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        args, errors, refs = [], [], []
        for name, text in zip(batch.column("name").to_pylist(), batch.column("arguments").to_pylist()):
            try:
                value = json.loads(text or "{}")
                args.append(canonical(value))
                refs.append(sorted(set(references(value))))
                errors.append("; ".join(problems(value, schemas[name]) if name in schemas else ["unknown tool"]))
            except ValueError:
                args.append(None)
                refs.append([])
                errors.append("$: not JSON")
        keep = [batch.column(c) for c in ("conv_id", "turn", "call_id", "name")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(args, pa.string()), pa.array(errors, pa.string()), pa.array(refs, pa.list_(pa.string()))],
                                         names=["conv_id", "turn", "call_id", "name", "arguments", "errors", "refs"])


def written_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        d = batch.to_pydict()
        lines = [canonical({"arguments": json.loads(a) if a is not None else None, "id": i, "level": v, "name": n, "result": r})
                 for a, i, v, n, r in zip(d["arguments"], d["call_id"], d["level"], d["name"], d["result"])]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lines, pa.string())], names=[*batch.schema.names, "json"])


def link(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """One row per distinct call: ``conv_id``, ``turn``, ``call_id``, ``name``, ``arguments``, ``errors``, ``level``, ``n_results``, ``result``, ``json``.

    ``calls`` (``conv_id``, ``turn``, ``call_id``, ``name``, ``arguments``) and ``results`` (``conv_id``, ``call_id``,
    ``turn``, ``content``) are hash-joined by conversation and id; of several results the first by turn, then text,
    is linked and all are counted. ``level`` is the topological order: 0 without references, else one more than the
    highest level referred to; ids that are not calls of the conversation are listed in ``errors``. Levels come from
    one join per level over the calls still open, so a conversation is never gathered in one task. Calls in a cycle,
    and calls that depend on one, get level null and an error. Sort by (conversation, level, turn, id) to render.

    A repeated call (same conversation and id) counts once, the first by turn, name and arguments. Calls without
    conversation or id are dropped, as nothing can name them; null arguments are ``{}``; a call without result has
    result null; results without a call are not returned. Arguments that are not JSON are null with an error.
    """
    key = ["conv_id", "call_id"]
    first = (calls.where("conv_id is not null and call_id is not null").groupBy(*key)
             .agg(F.min(F.struct("turn", "name", "arguments")).alias("c")).select("conv_id", "c.turn", "call_id", "c.name", "c.arguments"))
    checked = cut(first.mapInArrow(lambda it: checked_rows(it, schemas),
                                   "conv_id long, turn long, call_id string, name string, arguments string, errors string, refs array<string>"))
    edges = checked.select(*key, F.explode("refs").alias("ref"))
    known = edges.join(checked.select("conv_id", F.col("call_id").alias("ref"), F.lit(True).alias("found")), ["conv_id", "ref"], "left")
    stray = known.where("found is null").groupBy(*key).agg(F.array_join(F.array_sort(F.collect_list("ref")), ",").alias("stray"))
    open_edges = cut(known.where("found").select(*key, "ref"))
    done = cut(checked.select(*key).join(open_edges.select(*key).distinct(), key, "left_anti").withColumn("level", F.lit(0)))
    levels, level = done, 0
    while True:
        level += 1
        # A call is next if no reference of its own is open any more.
        left = open_edges.join(levels.select("conv_id", F.col("call_id").alias("ref"), F.col("level").alias("at")), ["conv_id", "ref"], "left")
        ready = (left.groupBy(*key).agg(F.max(F.col("at").isNull()).alias("waits"), F.max("at").alias("at"))
                 .where(~F.col("waits") & (F.col("at") == level - 1)).select(*key, F.lit(level).alias("level")))
        ready = cut(ready)
        if ready.isEmpty():
            break
        levels = levels.unionByName(ready)
    answers = results.where("conv_id is not null and call_id is not null").groupBy(*key).agg(
        F.min(F.struct("turn", "content")).alias("r"), F.count("*").alias("n_results")).select(*key, F.col("r.content").alias("result"), "n_results")
    rows = (checked.drop("refs").join(levels, key, "left").join(stray, key, "left").join(answers, key, "left")
            .withColumn("errors", F.concat_ws("; ", F.when(F.col("errors") != "", F.col("errors")),
                                              F.concat(F.lit("unknown reference "), F.col("stray")),
                                              F.when(F.col("level").isNull(), F.lit("reference cycle"))))
            .select("conv_id", "turn", "call_id", "name", "arguments", "errors", "level",
                    F.coalesce("n_results", F.lit(0)).alias("n_results"), "result"))
    return rows.mapInArrow(written_rows, T.StructType([*rows.schema.fields, T.StructField("json", T.StringType())]))


def derived_calls(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results told from plain chat turns, whole texts, for tables without tool messages.

    Every user turn is a call: ``lookup`` on even, ``summarise`` on odd halves of the turn number, which refers to the
    call two turns earlier within each run of eight turns. Every assistant turn is the result of the call before it.
    """
    turn = F.col("turn").cast("long")
    name = F.when(F.pmod(F.floor(turn / 2), F.lit(2)) == 0, F.lit("lookup")).otherwise(F.lit("summarise"))
    text = F.coalesce("text", F.lit(""))
    call = lambda t: F.concat(F.lit("call_"), t.cast("string"))
    after = F.when(F.pmod(turn, F.lit(8)) >= 2, F.struct(call(turn - 2).alias("$ref")))
    words = F.when(F.trim(text) == "", F.lit(0)).otherwise(F.size(F.split(F.trim(text), "[ \\t\\n]+")))
    arguments = F.when(name == "lookup", F.to_json(F.struct(words.alias("words"), text.alias("query"), after.alias("after")))).otherwise(
        F.to_json(F.struct(text.alias("text"), words.alias("words"), after.alias("after"))))
    calls = conversations.where("role = 'user'").select("conv_id", turn.alias("turn"), call(turn).alias("call_id"), name.alias("name"), arguments.alias("arguments"))
    results = conversations.where("role = 'assistant'").select("conv_id", call(turn - 1).alias("call_id"), turn.alias("turn"), F.col("text").alias("content"))
    return calls, results
