"""Tool-call linking for chat formatting.

Calls and results of a conversation are hash-joined by identifier, calls are
put in topological order of the calls they refer to, their arguments are
checked against a schema, and both are written as canonical JSON (sorted
keys, no spaces, whole numbers without a fraction, one writer for all).

A call's level is one more than the highest of those it refers to, and the
topological order of a conversation is that of (level, turn, call_id).
Levels are found over all conversations at once; no conversation is gathered
in one task.  Calls with one reference are followed by pointer doubling, so a
chain costs the logarithm of its length in rounds.  Calls with several
references then settle in rounds, as many as such calls follow one another.

Defined cases: a repeated identifier within a conversation keeps its first
row by turn, name, arguments and references, null first, and counts them in
``n_rows``; a call without conversation or identifier stays a row of its own
with the status ``unidentified`` and no level; a result without a call is
dropped, a call without a result has none (``unanswered``); several results
keep the first by turn and content; references to unknown calls count in
``n_missing``, null references in neither; calls in or behind a cycle have no
level and the status ``cyclic``; arguments that are null, no JSON, nested too
deeply, no Unicode text (a lone surrogate), or NaN are no JSON; of a key that
an object repeats the last value counts; a schema with an unknown type name
raises; very long texts are read whole, one at a time; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import cut

_TYPES = {"string": str, "integer": int, "number": (int, float), "boolean": bool, "object": dict, "array": list, "null": type(None)}


def _plain(value: object) -> object:
    """The value with whole numbers as integers."""
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_plain(v) for v in value]
    return int(value) if isinstance(value, float) and value.is_integer() and abs(value) < 2**53 else value


def canonical(value: object) -> str:
    """Canonical JSON text; raises ValueError for what has none."""
    text = json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    text.encode()
    return text


def check_schema(schema: dict) -> None:
    """Raises ValueError for a type name that is none."""
    kinds = schema.get("type", [])
    if unknown := set([kinds] if isinstance(kinds, str) else kinds) - set(_TYPES):
        raise ValueError(f"a schema has the unknown type {sorted(unknown)[0]!r}")
    for inner in [*schema.get("properties", {}).values(), *([schema["items"]] if "items" in schema else [])]:
        check_schema(inner)


def _is(value: object, kind: str) -> bool:
    return isinstance(value, _TYPES[kind]) and not (isinstance(value, bool) and kind in ("integer", "number"))


def violations(value: object, schema: dict, path: str = "$") -> list[str]:
    """Where a value breaks type (a name or a list of names), required, properties, additionalProperties, enum or items of a JSON schema."""
    out: list[str] = []
    kinds = schema.get("type", [])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_is(value, k) for k in kinds):
        return [f"{path}: not {' or '.join(kinds)}"]
    if "enum" in schema and value not in schema["enum"]:
        out.append(f"{path}: not in enum")
    if isinstance(value, dict):
        known = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in value]
        for k, v in value.items():
            if k in known:
                out += violations(v, known[k], f"{path}.{k}")
            elif schema.get("additionalProperties", True) is False:
                out.append(f"{path}.{k}: unknown")
    if isinstance(value, list) and "items" in schema:
        for i, v in enumerate(value):
            out += violations(v, schema["items"], f"{path}[{i}]")
    return sorted(out)


def check_arguments(calls: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Adds canonical (null if invalid JSON), valid and errors to calls with (name, arguments)."""
    schema = StructType(list(calls.schema.fields)).add("canonical", "string").add("valid", "boolean").add("errors", "string")
    for one in schemas.values():
        check_schema(one)

    def run(batches):
        for batch in batches:
            texts, oks, errors = [], [], []
            for name, raw in zip(batch.column("name").to_pylist(), batch.column("arguments").to_pylist(), strict=True):
                try:
                    value = json.loads(raw)
                    text = canonical(value)
                    found = violations(value, schemas[name] if name in schemas else {"type": "object"})
                    found += [] if name in schemas else ["$: no such tool"]
                    # Keys of unknown properties may hold any text.
                    "".join(found).encode()
                except (TypeError, ValueError, RecursionError):
                    text, found = None, ["$: no JSON"]
                texts.append(text)
                oks.append(not found)
                errors.append("; ".join(found))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string()), pa.array(oks, pa.bool_()), pa.array(errors, pa.string())], schema.names)

    return calls.mapInArrow(run, schema)


def written(rows: DataFrame) -> DataFrame:
    """``json`` in place of canonical, call_id, name and result: the call and its result as canonical JSON."""
    others = [c for c in rows.columns if c not in ("canonical", "result")]
    schema = StructType([rows.schema[c] for c in others]).add("json", "string")

    def run(batches):
        for batch in batches:
            out = []
            for arguments, call, name, result in zip(*(batch.column(c).to_pylist() for c in ("canonical", "call_id", "name", "result")), strict=True):
                out.append(f'{{"arguments":{arguments or "null"},{canonical({"call_id": call, "name": name, "result": result})[1:]}')
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(out, pa.string())], schema.names)

    return rows.mapInArrow(run, schema)


def levels(edges: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) from (conv_id, call_id, refers); ``refers`` null for a call without references.

    Calls that never settle, in or behind a cycle, have a null level.
    """
    key = ["conv_id", "call_id"]
    edges = cut(edges.distinct())
    degrees = cut(edges.groupBy(*key).agg(F.count("refers").alias("n"), F.max("refers").alias("one")))
    # Every call points at the first call before it that has no reference or several, itself at the least.
    single = F.col("n") == 1
    pointers = cut(degrees.select(*key, F.when(single, F.col("one")).otherwise(F.col("call_id")).alias("at"), F.when(single, 1).otherwise(0).cast("long").alias("far"), (~single).alias("ended")))
    longest = degrees.where(single).groupBy("conv_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    for _ in range(int(longest).bit_length() + 1):
        if pointers.where("not ended").isEmpty():
            break
        ahead = pointers.select("conv_id", F.col("call_id").alias("at"), F.col("at").alias("next"), F.col("far").alias("more"), F.col("ended").alias("done"))
        moved = pointers.where("not ended").join(ahead, ["conv_id", "at"]).select(*key, F.col("next").alias("at"), (F.col("far") + F.col("more")).alias("far"), F.col("done").alias("ended"))
        pointers = cut(pointers.where("ended").unionByName(moved))
    ends = pointers.where("ended").select("conv_id", F.col("call_id").alias("refers"), "at", "far")
    several = edges.where("refers is not null").join(degrees.where("n > 1").select(*key), key)
    # A reference into a cycle has no end, and so never settles.
    waiting = cut(several.join(ends, ["conv_id", "refers"], "left").select(*key, "at", "far"))
    settled = cut(degrees.where("n = 0").select(*key, F.lit(0).cast("long").alias("level")))
    known = settled
    while not waiting.isEmpty():
        at = known.select("conv_id", F.col("call_id").alias("at"), "level")
        tried = waiting.join(at, ["conv_id", "at"], "left").groupBy(*key).agg(F.max(F.col("level") + F.col("far")).alias("most"), F.count("level").alias("with"), F.count("*").alias("of"))
        fresh = cut(tried.where(F.col("with") == F.col("of")).select(*key, (F.col("most") + 1).alias("level")))
        if fresh.isEmpty():
            break
        known = cut(known.unionByName(fresh))
        waiting = cut(waiting.join(fresh, key, "left_anti"))
    at = known.select("conv_id", F.col("call_id").alias("at"), "level")
    placed = pointers.where("ended").join(at, ["conv_id", "at"]).select(*key, (F.col("level") + F.col("far")).cast("int").alias("level"))
    return degrees.select(*key).join(placed, key, "left")


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per call.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), refers (array of call ids).
    ``results``: conv_id, turn, call_id, content.
    """
    key, first = ["conv_id", "call_id"], F.struct("turn", "name", "arguments", "refers")
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    rows = calls.where(named).groupBy(*key).agg(F.min(first).alias("first"), F.count("*").alias("n_rows")).select(*key, "first.*", "n_rows")
    unnamed = calls.where(~named).select(*key, "turn", "name", "arguments", "refers", F.lit(1).cast("long").alias("n_rows"))
    checked = cut(check_arguments(rows.unionByName(unnamed), schemas))
    kept = checked.where(named)
    answers = results.where(named).groupBy(*key).agg(F.min(F.struct("turn", "content")).alias("a")).select(*key, F.col("a.turn").alias("result_turn"), F.col("a.content").alias("result"))
    known = kept.select(*key)
    wanted = kept.select(*key, F.explode(F.array_distinct("refers")).alias("refers")).where("refers is not null")
    real = wanted.join(known.withColumnRenamed("call_id", "refers"), ["conv_id", "refers"], "left_semi")
    missing = wanted.join(known.withColumnRenamed("call_id", "refers"), ["conv_id", "refers"], "left_anti").groupBy(*key).agg(F.count("*").alias("n_missing"))
    edges = known.join(real, key, "left").select(*key, "refers")
    # Null keys meet nothing here, and so have neither result nor level.
    out = checked.join(answers, key, "left").join(missing, key, "left").join(levels(edges), key, "left")
    status = F.when(~named, "unidentified").when(F.col("level").isNull(), "cyclic").when(~F.col("valid"), "invalid").when(F.col("result_turn").isNull(), "unanswered").otherwise("linked")
    out = out.withColumn("status", status).withColumn("n_missing", F.coalesce("n_missing", F.lit(0)))
    return written(out.select(*key, "turn", "name", "status", "level", "n_rows", "n_missing", "errors", "result_turn", "canonical", "result"))
