"""Tool-call linking: chat messages, their tool calls and the calls' results as ordered, checked JSON.

1. Calls and results of a conversation are hash-joined by identifier.  A result without a call is an
   ``orphan``, a call without a result is ``unanswered``; where an identifier occurs more than once, the first
   call and the first result (by turn) make the link and the others are ``repeated``.
2. Order is topological: a result comes after its call, and a call after its message and after the results that
   it needs.  Turns that respect this stay in order; others move behind what they depend on.  A node's
   position is (largest turn among what it depends on, steps from there), found by relaxation, one join per step
   that turns are out of order (a circle is known once its steps outnumber the conversation's moved nodes).  Where needs go in a circle, the node at which this shows is marked
   ``cyclic``, keeps its own turn and needs nothing; the others follow from it.
3. Arguments are parsed strictly and checked against the tool's schema.
4. Each message, call and result is one line of canonical JSON: sorted keys, no spaces, no escapes
   that are not needed, whole floats as integers.

A conversation of any length is spread by turn.  Null texts count as empty, null conversation ids form
one conversation, null turns come first.  Repeated rows are messages of their own.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediamart.llm.common import store

CALL = "struct<id:string,name:string,arguments:string,needs:array<string>>"
_TYPES = {
    "string": str, "integer": int, "number": (int, float), "boolean": bool, "array": list, "object": dict,
}


_SURROGATE = re.compile(r"\\u[dD][89a-fA-F]|[\ud800-\udfff]")
#: Schema keywords that are known; a schema with another one, which values could not be held against, is refused.
_KEYWORDS = {
    "type", "enum", "properties", "required", "additionalProperties", "items", "minimum", "maximum", "minLength", "maxLength",
    "title", "description", "default", "examples", "$comment",
}


def _same(a, b) -> bool:
    """Equal as JSON: true is not 1, while 1 and 1.0 are one number."""
    if isinstance(a, bool) or isinstance(b, bool):
        return a is b
    if isinstance(a, dict) and isinstance(b, dict):
        return a.keys() == b.keys() and all(_same(a[k], b[k]) for k in a)
    if isinstance(a, list) and isinstance(b, list):
        return len(a) == len(b) and all(map(_same, a, b))
    return a == b


def _refuse(word: str) -> None:
    raise ValueError(f"{word} is not JSON")


def _pairs(pairs: list[tuple]) -> dict:
    out = dict(pairs)
    if len(out) != len(pairs):
        raise ValueError("a key occurs twice")
    return out


def parsed(text: str):
    """Strict JSON: no NaN or infinities, no repeated keys, nothing after the value."""
    value = json.loads(text, parse_constant=_refuse, object_pairs_hook=_pairs)
    if _SURROGATE.search(text):  # half a character, escaped or not, may be left alone
        canonical(value).encode()
    return value


def _plain(value):
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError("out of range")
        return int(value) if value.is_integer() and abs(value) < 2**53 else value
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    return [_plain(v) for v in value] if isinstance(value, list) else value


def canonical(value) -> str:
    return json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def check_schema(schema: dict) -> dict:
    """``schema``, or an error where it uses a keyword that ``fault`` does not know."""
    if unknown := sorted(schema.keys() - _KEYWORDS):
        raise ValueError(f"schema keyword {unknown[0]} is not known")
    for inner in [*schema.get("properties", {}).values(), *([schema["items"]] if "items" in schema else [])]:
        check_schema(inner)
    return schema


def fault(value, schema: dict, at: str = "$") -> str | None:
    """The first thing in ``value`` that its schema does not allow; null if it is valid.

    Known: type, enum, properties, required, additionalProperties, items, minimum, maximum, minLength, maxLength.
    """
    kind = schema.get("type")
    if kind == "null":
        return None if value is None else f"{at}: not null"
    if kind and (not isinstance(value, _TYPES[kind]) or (isinstance(value, bool) and kind != "boolean")):
        if not (kind == "integer" and isinstance(value, float) and value.is_integer()):
            return f"{at}: not of type {kind}"
    if "enum" in schema and not any(_same(value, e) for e in schema["enum"]):
        return f"{at}: not one of the values"
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        if value < schema.get("minimum", value) or value > schema.get("maximum", value):
            return f"{at}: out of range"
    if isinstance(value, str) and not schema.get("minLength", 0) <= len(value) <= schema.get("maxLength", len(value)):
        return f"{at}: length"
    if isinstance(value, list) and "items" in schema:
        return next((f for k, v in enumerate(value) if (f := fault(v, schema["items"], f"{at}[{k}]"))), None)
    if isinstance(value, dict):
        known = schema.get("properties", {})
        if (missing := next((k for k in schema.get("required", ()) if k not in value), None)) is not None:
            return f"{at}.{missing}: missing"
        if schema.get("additionalProperties") is False and (other := next((k for k in sorted(value) if k not in known), None)) is not None:
            return f"{at}.{other}: unknown"
        return next((f for k in sorted(value) if k in known and (f := fault(value[k], known[k], f"{at}.{k}"))), None)
    return None


def nodes(messages: DataFrame) -> DataFrame:
    """(node, conv_id, turn, place, kind, call_id, link, role, text, name, arguments, needs): messages,
    calls and results, with the state of each link."""
    numbered = messages.select(
        "conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"), "calls", "result_of",
        F.monotonically_increasing_id().alias("row"),
    )
    numbered = store(numbered, "chat-messages")
    kind = F.when(F.col("result_of").isNotNull(), "result").otherwise("message")
    none = F.lit(None).cast("string")
    own = numbered.select(
        "conv_id", "turn", F.lit(0).alias("place"), "row", kind.alias("kind"), F.col("result_of").alias("call_id"),
        "role", "text", none.alias("name"), none.alias("arguments"), F.lit(None).cast("array<string>").alias("needs"),
    )
    calls = numbered.select("conv_id", "turn", "row", "role", F.posexplode("calls").alias("at", "call")).select(
        "conv_id", "turn", (F.col("at") + 1).alias("place"), "row", F.lit("call").alias("kind"), F.col("call.id").alias("call_id"),
        "role", F.lit("").alias("text"), "call.name", "call.arguments", "call.needs",
    )
    every = own.unionByName(calls)
    # the first call and the first result of each identifier make the link
    linked = (
        every.filter("call_id IS NOT NULL")
        .groupBy("conv_id", "call_id")
        .agg(
            F.min(F.when(F.col("kind") == "call", F.struct("turn", "row", "place"))).alias("call"),
            F.min(F.when(F.col("kind") == "result", F.struct("turn", "row", "place"))).alias("result"),
        )
    )
    first = F.when(F.col("kind") == "call", F.col("call")).otherwise(F.col("result"))
    link = (
        F.when(F.col("kind") == "message", F.lit(None))
        .when(F.col("c.call_id").isNull(), F.when(F.col("kind") == "call", "unanswered").otherwise("orphan"))
        .when(~first.eqNullSafe(F.struct("turn", "row", "place")), "repeated")
        .when(F.col("call").isNull(), "orphan")
        .when(F.col("result").isNull(), "unanswered")
        .otherwise("linked")
    )
    states = linked.select(
        F.col("conv_id").alias("c_conv"), F.struct("call_id").alias("c"), F.col("call_id").alias("c_id"), "call", "result"
    )
    meets = every["conv_id"].eqNullSafe(F.col("c_conv")) & (every["call_id"] == F.col("c_id"))
    joined = every.join(states, meets, "left")
    return joined.select(*every.columns, link.alias("link"), F.concat_ws("-", "row", "place").alias("node"))


def edges(made: DataFrame) -> DataFrame:
    """(node, needs): what each node has to come after."""
    of_message = made.filter("kind = 'call'").select("node", F.concat(F.col("row").cast("string"), F.lit("-0")).alias("needs"))
    first = made.filter("link IN ('linked', 'unanswered') AND kind = 'call' AND call_id IS NOT NULL").select(
        F.col("conv_id").alias("conv"), F.col("call_id").alias("id"), F.col("node").alias("needs")
    )
    answers = made.filter("link = 'linked' AND kind = 'result'").select(
        F.col("conv_id").alias("conv"), F.col("call_id").alias("id"), F.col("node").alias("needs")
    )
    results = made.filter("link = 'linked' AND kind = 'result'").select("conv_id", "call_id", "node")
    asked = made.filter("kind = 'call'").select("conv_id", "node", F.explode("needs").alias("call_id"))

    def on(left: DataFrame, right: DataFrame) -> DataFrame:
        return left.join(right, left["conv_id"].eqNullSafe(right["conv"]) & (left["call_id"] == right["id"])).select(
            "node", "needs"
        )

    return of_message.unionByName(on(results, first)).unionByName(on(asked, answers))


def ordered(made: DataFrame) -> DataFrame:
    """``made`` with ``base`` (turn it is placed at), ``depth`` (steps behind it) and ``cyclic``."""
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-(2**62)))
    at = made.select("node", turn.alias("turn"), F.col("place").cast("long").alias("place"))
    needs = store(edges(made), "chat-edges")
    moved = store(at.select("node", F.col("turn").alias("base"), F.lit(0).cast("long").alias("depth")).limit(0), "chat-moved")
    old = at.select(F.col("node").alias("needs"), F.col("turn").alias("n_turn"), F.col("place").alias("n_place"))
    own = store(needs.join(at, "node").join(old, "needs"), "chat-own")
    conversation = made.select("node", "conv_id")
    cyclic = None
    while True:
        now = moved.select(F.col("node").alias("needs"), F.col("base").alias("n_base"), F.col("depth").alias("n_depth"))
        state = (
            own.join(now, "needs", "left")
            .join(moved, "node", "left")
            .withColumn("n_base", F.coalesce("n_base", "n_turn"))
            .withColumn("n_depth", F.coalesce("n_depth", F.lit(0)))
            .withColumn("base", F.coalesce("base", "turn"))
            .withColumn("depth", F.coalesce("depth", F.lit(0)))
        )
        # held: behind what it needs already, by turn, by depth, or a call by its place in its message
        beside = (F.col("n_turn") == F.col("turn")) & (F.col("n_place") == 0) & (F.col("place") > 0)
        held = F.struct("base", "depth") > F.struct("n_base", "n_depth")
        held |= (F.struct("base", "depth") == F.struct("n_base", "n_depth")) & beside
        late = state.filter(~held).groupBy("node").agg(F.max(F.struct("n_base", F.col("n_depth") + 1)).alias("to"))
        fresh = store(late.select("node", F.col("to.n_base").alias("base"), F.col("to.col2").alias("depth")), "chat-late")
        deepest = fresh.agg(F.max("depth")).first()[0]
        if deepest is None:
            break
        moved = store(moved.join(fresh.select("node"), "node", "left_anti").unionByName(fresh), "chat-moved")
        if deepest > 2:
            # steps from node to node of one conversation, more than it has moved nodes: a circle
            nodes_moved = moved.join(conversation, "node").groupBy("conv_id").agg(F.count("*").alias("n"))
            of_fresh = fresh.join(conversation, "node").alias("f")
            round_ = store(
                of_fresh.join(nodes_moved.alias("m"), F.col("f.conv_id").eqNullSafe(F.col("m.conv_id")))
                .filter("f.depth > m.n")
                .select("f.node"),
                "chat-circle",
            )
            if round_.limit(1).count():
                cyclic = round_ if cyclic is None else cyclic.unionByName(round_)
                own = store(own.join(round_, "node", "left_anti"), "chat-own")
                moved = store(moved.join(round_, "node", "left_anti"), "chat-moved")
    out = made.join(moved, "node", "left").withColumn("base", F.coalesce("base", turn)).withColumn("depth", F.coalesce("depth", F.lit(0)))
    if cyclic is None:
        return out.withColumn("cyclic", F.lit(False))
    return out.join(cyclic.distinct().withColumn("cyclic", F.lit(True)), "node", "left").withColumn("cyclic", F.coalesce("cyclic", F.lit(False)))


def serialised(placed: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Each node with ``valid``, ``fault`` (calls only) and its canonical ``json``."""

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            valid, faults, lines = [], [], []
            for kind, call_id, role, text, name, arguments in zip(
                df["kind"], df["call_id"], df["role"], df["text"], df["name"], df["arguments"]
            ):
                wrong, value = None, arguments
                if kind == "call":
                    try:
                        value = parsed(arguments or "")
                        if name not in schemas:
                            wrong = "unknown tool"
                        else:
                            wrong = fault(value, schemas[name])
                        value = _plain(value)
                    except (ValueError, RecursionError):
                        wrong, value = "not JSON", arguments
                    line = {"arguments": value, "id": call_id, "name": name, "type": "call"}
                elif kind == "result":
                    line = {"content": text, "id": call_id, "type": "result"}
                else:
                    line = {"content": text, "role": role, "type": "message"}
                valid.append(None if kind != "call" else wrong is None)
                faults.append(wrong)
                lines.append(canonical(line))
            yield df.drop(columns=["text", "name", "arguments", "role"]).assign(valid=valid, fault=faults, json=lines)

    keys = ["conv_id", "base", "depth", "turn", "row", "place", "kind", "call_id", "link", "cyclic"]
    kinds = {c: t for c, t in placed.dtypes}
    schema = ", ".join(f"{c} {kinds[c]}" for c in keys) + ", valid boolean, fault string, json string"
    return placed.select(*keys, "text", "name", "arguments", "role").mapInPandas(write, schema)


def link(messages: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """One row per message, call and result: conv_id, turn, kind, call_id, link, cyclic, valid, fault, json and its
    place in the conversation: ``base``, ``depth``, ``row`` and ``place``, in this order.

    ``messages`` has conv_id, turn, role, text, calls (array of id, name, arguments, needs) and result_of.  A schema with
    a keyword that is not known is an error.
    """
    for schema in schemas.values():
        check_schema(schema)
    made = store(nodes(messages), "chat-nodes")
    return serialised(ordered(made), schemas)


def transcripts(linked: DataFrame, lane: int = 256) -> DataFrame:
    """``linked`` with ``position``, from 0 in each conversation; numbered within ``lane`` turns first, so
    that a long conversation is not one task's work."""
    lanes = linked.withColumn("_lane", F.floor(F.col("base") / lane))
    order = ["base", "depth", "row", "place"]
    within = Window.partitionBy("conv_id", "_lane").orderBy(*order)
    counts = lanes.groupBy("conv_id", "_lane").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_lane").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(F.col("conv_id").alias("_conv"), F.col("_lane").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    numbered = lanes.withColumn("_local", F.row_number().over(within) - 1)
    return numbered.join(shifts, numbered["conv_id"].eqNullSafe(shifts["_conv"]) & (numbered["_lane"] == shifts["_of"])).withColumn(
        "position", F.col("_local") + F.col("_shift")
    ).drop("_conv", "_of", "_shift", "_local", "_lane")
