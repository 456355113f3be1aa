"""Chat formatting: tool calls and their results linked, ordered, checked and
written as canonical JSON.

* Arguments are checked against the tool's JSON schema, and every message is
  written as canonical JSON (RFC 8785): keys sorted by UTF-16 units, no blanks,
  shortest numbers. Calls take one Arrow pass for both; results are written by
  the JVM. What is written is stored once; only identifiers, turns and digests
  take part in what follows, and messages are joined back at the end.
* Calls and results are hash-joined by conversation and call identifier.
* Calls are ordered topologically by the calls they need (Kahn). The needs of
  a conversation with at most ``GRAPH`` of them are ordered by one task. In
  larger ones chains of single needs are contracted first, by pointer doubling,
  and each round then settles every other call whose needs are settled, so the
  rounds follow the depth of the branching and not the length of a chain.
* Messages get their places from ranks over range partitions: a conversation,
  a call with very many results and turns that are all null are split too.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import cut, slices
from tablewright.operators.prefix import global_rank

#: Needs of a conversation that one task may order.
GRAPH = 4096


# --- canonical JSON ---------------------------------------------------------------

def _number(x) -> str:
    if isinstance(x, int) and abs(x) < 1 << 53:
        return str(x)
    x = float(x)
    if not math.isfinite(x):
        raise ValueError("not a JSON number")
    if x == 0:
        return "0"
    if 1e-6 <= abs(x) < 1e21:
        s = format(Decimal(repr(x)), "f")
        return s.rstrip("0").rstrip(".") if "." in s else s
    base, power = format(Decimal(repr(x)), "e").lower().split("e")
    base = base.rstrip("0").rstrip(".") if "." in base else base
    return f"{base}e{int(power):+d}"


def canonical(v) -> str:
    """A JSON value as canonical text."""
    if v is None or isinstance(v, bool):
        return {None: "null", True: "true", False: "false"}[v]
    if isinstance(v, (int, float)):
        return _number(v)
    if isinstance(v, str):
        return json.dumps(v, ensure_ascii=False)
    if isinstance(v, list):
        return "[" + ",".join(map(canonical, v)) + "]"
    keys = sorted(v, key=lambda k: k.encode("utf-16-be", "surrogatepass"))
    return "{" + ",".join(f"{canonical(k)}:{canonical(v[k])}" for k in keys) + "}"


# --- schemas ----------------------------------------------------------------------

_TYPES = {
    "object": lambda v: isinstance(v, dict), "array": lambda v: isinstance(v, list),
    "string": lambda v: isinstance(v, str), "boolean": lambda v: isinstance(v, bool),
    "null": lambda v: v is None,
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "integer": lambda v: not isinstance(v, bool) and (isinstance(v, int) or isinstance(v, float) and v.is_integer()),
}


def violations(v, schema: dict, path: str = "$") -> Iterator[str]:
    """What is wrong with a value under a JSON schema (type, enum, required,
    properties, additionalProperties, items, and the bounds of numbers, texts
    and lists)."""
    kinds = schema.get("type")
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if kinds and not any(_TYPES[k](v) for k in kinds):
        yield f"{path}: not {' or '.join(kinds)}"
        return
    if "enum" in schema and v not in schema["enum"]:
        yield f"{path}: not one of its values"
    if _TYPES["number"](v):
        if v < schema.get("minimum", -math.inf) or v > schema.get("maximum", math.inf):
            yield f"{path}: out of range"
    if isinstance(v, (str, list)):
        low, high = ("minLength", "maxLength") if isinstance(v, str) else ("minItems", "maxItems")
        if not schema.get(low, 0) <= len(v) <= schema.get(high, math.inf):
            yield f"{path}: length"
    if isinstance(v, list) and "items" in schema:
        for i, x in enumerate(v):
            yield from violations(x, schema["items"], f"{path}[{i}]")
    if isinstance(v, dict):
        known = schema.get("properties", {})
        for k in schema.get("required", ()):
            if k not in v:
                yield f"{path}.{k}: missing"
        for k in sorted(v):
            if k in known:
                yield from violations(v[k], known[k], f"{path}.{k}")
            elif schema.get("additionalProperties", True) is False:
                yield f"{path}.{k}: unknown"


def check_arguments(tool: str | None, arguments: str | None, schemas: dict) -> tuple[str, str, str]:
    """(status, first violation, canonical arguments) of a call. Arguments
    that are no JSON are kept as a JSON string."""
    try:
        value = json.loads(arguments or "", parse_constant=lambda c: (_ for _ in ()).throw(ValueError(c)))
        text = canonical(value)
    except (ValueError, RecursionError) as e:
        return "invalid_json", type(e).__name__, canonical(arguments or "")
    if tool not in schemas:
        return "unknown_tool", "", text
    wrong = next(violations(value, schemas[tool]), "")
    return ("invalid_arguments" if wrong else "ok"), wrong, text


# --- messages ------------------------------------------------------------------------

def json_text(c: Column) -> Column:
    """A text as a canonical JSON string, by the JVM."""
    short = {"\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}
    plain = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    for x in ("\n", "\r", "\t"):
        plain = F.replace(plain, F.lit(x), F.lit(short[x]))
    rare = plain
    for i in range(32):
        if chr(i) not in "\n\r\t":
            rare = F.replace(rare, F.lit(chr(i)), F.lit(short.get(chr(i), f"\\u{i:04x}")))
    escaped = F.when(c.rlike(r"[\x00-\x08\x0B\x0C\x0E-\x1F]"), rare).when(c.rlike(r'[\n\r\t"\\]'), plain).otherwise(c)
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def _written(calls: DataFrame, schemas: dict) -> DataFrame:
    """(_conv, _id, _seq, _tool, _digest, _needs, _status, _error, message) of
    calls with the columns (..., _needs, _ident, _raw)."""
    keep = ["_conv", "_id", "_seq", "_tool", "_digest", "_needs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            out = []
            for tool, ident, raw in zip(*(b.column(n).to_pylist() for n in ("_tool", "_ident", "_raw"))):
                status, error, arguments = check_arguments(tool, raw, schemas)
                out.append((status, error, f'{{"function":{{"arguments":{arguments},"name":{canonical(tool)}}},'
                                           f'"id":{canonical(ident)},"role":"assistant","type":"function"}}'))
            new = [pa.array([o[i] for o in out], pa.string()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*map(b.column, keep), *new], names=[*keep, "_status", "_error", "message"])

    return calls.mapInArrow(run, "_conv string, _id string, _seq long, _tool string, _digest string, _needs array<string>, "
                                 "_status string, _error string, message string")


# --- ordering ------------------------------------------------------------------------

def kahn(edges: list[tuple[str, str]]) -> dict[str, int | None]:
    """The level of every call in ``edges`` (call, need): 0 without needs, else
    one more than the highest needed; None on a cycle or behind one."""
    needs, used = {}, {}
    for a, b in set(edges):
        needs[a] = needs.get(a, 0) + 1
        needs.setdefault(b, 0)
        used.setdefault(b, []).append(a)
    level: dict[str, int | None] = dict.fromkeys(needs)
    front = [x for x, n in needs.items() if not n]
    for at in range(len(needs)):
        level.update(dict.fromkeys(front, at))
        after = []
        for b in front:
            for a in used.get(b, ()):
                needs[a] -= 1
                if not needs[a]:
                    after.append(a)
        front = after
    return level


def _small_levels(edges: DataFrame) -> DataFrame:
    """(_conv, _id, _level) of the calls in ``edges``, a conversation by one
    task; null: not ordered."""
    lists = edges.groupBy("_conv").agg(F.collect_list("_id").alias("a"), F.collect_list("_need").alias("b"))

    def order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(conv, x, n) for conv, a, b in zip(*(c.to_pylist() for c in batch.columns)) for x, n in kahn(list(zip(a, b))).items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int32()))],
                                             names=["_conv", "_id", "_level"])

    return lists.mapInArrow(order, "_conv string, _id string, _level int")


def _chains(edges: DataFrame) -> DataFrame:
    """(_conv, _id, _need, _far) for calls with one need: the call that the
    chain of single needs from it ends at, and how many steps away. Those on
    a cycle of single needs, or behind one, have none. Each round doubles the
    steps; a chain of n calls takes log2(n) rounds."""
    single = edges.groupBy("_conv", "_id").agg(F.count(F.lit(1)).alias("_n"), F.min("_need").alias("_need"))
    open_ = cut(single.where("_n = 1").select("_conv", "_id", "_need", F.lit(1).cast("long").alias("_far")))
    total, steps, done = open_.count(), 1, None
    while total and steps <= 2 * total:
        on = open_.select("_conv", F.col("_id").alias("_need"), F.col("_need").alias("_next"), F.col("_far").alias("_more"))
        if done is not None:
            on = on.unionByName(done.select("_conv", F.col("_id").alias("_need"), F.col("_need").alias("_next"), F.col("_far").alias("_more")))
        moved = cut(open_.join(on, ["_conv", "_need"], "left"))
        ended = moved.where("_next is null").select("_conv", "_id", "_need", "_far")
        done = ended if done is None else cut(done.unionByName(ended))
        open_ = cut(moved.where("_next is not null").select("_conv", "_id", F.col("_next").alias("_need"), (F.col("_far") + F.col("_more")).alias("_far")))
        if open_.isEmpty():
            break
        steps *= 2
    return done if done is not None else open_.limit(0)


def _large_levels(edges: DataFrame) -> DataFrame:
    """As ``_small_levels``, by joins. Chains of single needs are contracted;
    a round settles the calls with none or several needs whose needs' ends are
    settled."""
    edges = cut(edges)
    chain = cut(_chains(edges))
    nodes = cut(edges.select("_conv", "_id").unionByName(edges.select("_conv", F.col("_need").alias("_id"))).distinct())
    several = edges.join(edges.groupBy("_conv", "_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"), ["_conv", "_id"], "left_semi")
    single = edges.groupBy("_conv", "_id").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select("_conv", "_id")
    lost = single.join(chain, ["_conv", "_id"], "left_anti")             # on a cycle or behind one
    end = chain.select("_conv", F.col("_id").alias("_need"), F.col("_need").alias("_end"), F.col("_far").alias("_more"))
    left = several.join(end, ["_conv", "_need"], "left").select(
        "_conv", "_id", F.coalesce("_end", "_need").alias("_need"), (F.coalesce("_more", F.lit(0)) + 1).alias("_far"))
    left = cut(left)
    front = cut(nodes.join(edges.select("_conv", "_id").distinct(), ["_conv", "_id"], "left_anti").withColumn("_level", F.lit(0).cast("long")))
    done = front
    known = cut(left.select("_conv", "_id", "_far", "_need", F.lit(None).cast("long").alias("_level")))
    while not known.isEmpty() and not front.isEmpty():
        new = front.select("_conv", F.col("_id").alias("_need"), F.col("_level").alias("_new"))
        known = cut(known.join(new, ["_conv", "_need"], "left").select(
            "_conv", "_id", "_far", "_need", F.coalesce("_level", F.col("_new") + F.col("_far")).alias("_level")))
        full = known.groupBy("_conv", "_id").agg(F.max("_level").alias("_level"), F.count("_level").alias("_have"), F.count(F.lit(1)).alias("_all"))
        front = cut(full.where("_have = _all").select("_conv", "_id", "_level"))
        known = cut(known.join(front.select("_conv", "_id"), ["_conv", "_id"], "left_anti"))
        done = done.unionByName(front)
    ends = done.select("_conv", F.col("_id").alias("_need"), "_level")
    along = chain.join(ends, ["_conv", "_need"]).select("_conv", "_id", (F.col("_level") + F.col("_far")).alias("_level"))
    level = done.unionByName(along.join(lost, ["_conv", "_id"], "left_anti"))
    return nodes.join(level, ["_conv", "_id"], "left").select("_conv", "_id", F.col("_level").cast("int").alias("_level"))


def layers(edges: DataFrame, graph: int = GRAPH) -> DataFrame:
    """(_conv, _id, _level) of the calls that ``edges`` (_conv, _id, _need)
    lead from and to: 0 without needs, else one more than the highest level
    needed; null on a cycle or behind one."""
    edges = cut(edges.distinct())
    large = cut(edges.groupBy("_conv").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > graph).select("_conv"))
    if large.isEmpty():
        return _small_levels(edges)
    return _small_levels(edges.join(large, "_conv", "left_anti")).unionByName(_large_levels(edges.join(large, "_conv", "left_semi")))


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict, conv: str = "conv_id",
                    call_id: str = "call_id", seq: str = "seq", graph: int = GRAPH) -> DataFrame:
    """One row per call and per result: ``conv``, ``position`` (topological,
    from 0), ``kind`` ('call', 'result'), ``call_id``, ``level`` (null: not
    ordered), ``status``, ``error``, ``copies`` and ``message`` (canonical JSON).

    ``calls`` has ``conv``, ``call_id``, ``seq`` (the turn), ``tool``,
    ``arguments`` (JSON text) and ``needs`` (identifiers of calls whose results
    it uses); ``results`` has ``conv``, ``call_id``, ``seq`` and ``content``.

    Equal calls of one identifier in one conversation are one row, ``copies``
    of them, as are equal results. Of different calls of one identifier the
    first by turn, tool and digest stands; the others are rows with '
    conflicting' before their status, without a level, after the calls in
    order. A call is 'ok', 'invalid_json', 'unknown_tool' or
    'invalid_arguments'; ', unanswered' follows where no result names it. Needs
    that name no call of the conversation are left out of the order. Calls on
    a cycle or behind one have no level and come last, as do results that name
    no call ('orphan'). A result follows its call. Null conversations are one
    conversation; null identifiers name nothing: such a call is unanswered,
    such a result an orphan. Null turns count as 0. Empty tables give no rows;
    other columns are ignored, whatever their names."""
    # what is null gets a name that begins with a null character; a call without
    # an identifier is told from others by what it says
    c_ = F.col
    in_conv = F.coalesce(c_(conv).cast("string"), F.lit("\0")).alias("_conv")
    ident = c_(call_id).cast("string")
    turn = F.coalesce(c_(seq).cast("long"), F.lit(0))
    says = F.md5(F.to_json(F.struct(turn, "tool", "arguments", "needs")))
    named = F.when(ident.isNotNull(), json_text(ident)).otherwise(F.lit("null"))
    c = _written(calls.select(
        in_conv, F.coalesce(ident, F.concat(F.lit("\0"), says)).alias("_id"), turn.alias("_seq"), c_("tool").alias("_tool"), says.alias("_digest"),
        F.coalesce(c_("needs").cast("array<string>"), F.array().cast("array<string>")).alias("_needs"),
        ident.alias("_ident"), c_("arguments").alias("_raw")), schemas).withColumn("_kind", F.lit(0))
    content = F.coalesce(c_("content"), F.lit(""))
    none = F.lit(None).cast("string")
    r = results.select(
        in_conv, F.coalesce(ident, F.lit("\0")).alias("_id"), turn.alias("_seq"), none.alias("_tool"), F.md5(content).alias("_digest"),
        F.array().cast("array<string>").alias("_needs"), F.lit("ok").alias("_status"), F.lit("").alias("_error"),
        F.concat(F.lit('{"content":'), json_text(content), F.lit(',"role":"tool","tool_call_id":'), named, F.lit("}")).alias("message"),
        F.lit(1).alias("_kind"))
    said = cut(c.unionByName(r)).withColumn("_row", F.monotonically_increasing_id())     # of stored rows: the same at every read
    rows = said.groupBy("_conv", "_id", "_kind", "_seq", "_tool", "_digest").agg(F.count(F.lit(1)).alias("_copies"), F.min("_row").alias("_row"))
    call, name = c_("_kind") == 0, ~c_("_id").startswith("\0")
    known = rows.groupBy("_conv", "_id").agg(
        F.min(F.when(call, F.struct("_seq", "_tool", "_digest", "_row"))).alias("_head"), F.max("_kind").alias("_answered"))
    heads = known.where("_head is not null")

    first = cut(heads.select("_conv", "_id", c_("_head._row").alias("_row")))
    needs = said.where("size(_needs) > 0").select("_row", "_needs").join(first, "_row").select("_conv", "_id", F.explode("_needs").alias("_need"))
    edges = needs.join(first.select("_conv", c_("_id").alias("_need")), ["_conv", "_need"], "left_semi")
    level = layers(edges, graph).withColumn("_in", F.lit(True))
    of = known.join(level, ["_conv", "_id"], "left").select(
        "_conv", "_id", "_head", "_answered", F.when(c_("_in"), c_("_level")).when(c_("_head").isNotNull(), 0).alias("_level"))

    rows = rows.join(of, ["_conv", "_id"])
    stands = c_("_row") == c_("_head._row")
    linked = F.when(call, stands).otherwise(name & c_("_head").isNotNull())
    late = F.coalesce(F.when(linked, c_("_level")), F.lit(1 << 30)).alias("_late")
    at = F.when(linked, c_("_head._seq")).otherwise(c_("_seq")).alias("_call_seq")
    tail = F.when(call, F.when(~stands, "conflicting").when((c_("_answered") == 0) | ~name, "unanswered")).when(~linked, "orphan")
    rows = rows.select("_conv", "_id", "_kind", "_seq", "_digest", "_copies", "_row", late, at, tail.alias("_tail"),
                       F.when(linked, c_("_level")).alias("_level"))
    placed = global_rank(rows, ["_late", "_call_seq", "_id", "_kind", "_seq", "_digest", "_row"], by=["_conv"], name="_rank")
    out = placed.select("_row", "_rank", "_copies", "_tail", "_level").join(said, "_row")
    null = lambda x: F.when(~c_(x).startswith("\0"), c_(x))
    status = (F.when(c_("_tail") == "orphan", c_("_tail")).when(c_("_tail") == "conflicting", F.concat(F.lit("conflicting, "), "_status"))
              .when(c_("_tail") == "unanswered", F.concat("_status", F.lit(", unanswered"))).otherwise(c_("_status")))
    return out.select(
        null("_conv").cast(calls.schema[conv].dataType).alias(conv), (c_("_rank") - 1).alias("position"),
        F.when(call, "call").otherwise("result").alias("kind"), null("_id").alias(call_id), c_("_level").alias("level"),
        status.alias("status"), c_("_error").alias("error"), c_("_copies").alias("copies"), "message")
