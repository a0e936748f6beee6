"""Chat formatting: tool calls linked to results, ordered, validated, canonical.

Method: calls and results meet in a hash join by call id; calls are ordered
topologically by their dependencies; arguments are checked against the
schema of their tool; each linked call is serialised as canonical JSON (keys
sorted, no blanks, text unescaped).

Ordering works on the whole table: calls with one parent double their pointers
until these reach a call with none or several, so a chain takes as many rounds
as the logarithm of its length; then a round gives a level to every call with
several parents whose parents all have one.  No conversation is gathered in a
task, so one that holds a third of all rows is only more rows of the same joins.

Defined results: a null id links with nothing; of several results of a call
that with the smallest (turn, content) counts; a dependency on an id that does
not exist is reported and otherwise ignored; calls on or after a cycle have a
null level; arguments that are null or no JSON object are invalid, and so are
those that no canonical JSON can hold (NaN, infinite numbers, lone surrogates,
nesting or numbers beyond the parser's limits); a tool without a schema is
reported as unknown; empty tables give empty results; rows that repeat a call
id are joined row by row; other columns are ignored.
"""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, stored, table, words

#: Tools of the query: name -> JSON-schema subset (type, required, properties, enum, minimum).
SCHEMAS = {
    "search": {"type": "object", "required": ["query", "limit"],
               "properties": {"query": {"type": "string"}, "limit": {"type": "integer", "minimum": 1}}},
    "summarize": {"type": "object", "required": ["text", "style"],
                  "properties": {"text": {"type": "string"}, "style": {"type": "string", "enum": ["short", "long"]}}},
    "count": {"type": "object", "required": ["items"], "properties": {"items": {"type": "array", "items": {"type": "string"}}}},
}
_TYPES = {"object": dict, "array": list, "string": str, "integer": int, "number": (int, float), "boolean": bool}


def problems(value, schema: dict, at: str = "$") -> list[str]:
    """What is wrong with a parsed value under a schema, in document order."""
    kind = schema.get("type")
    if kind and (not isinstance(value, _TYPES[kind]) or (isinstance(value, bool) and kind in ("integer", "number"))):
        return [f"{at}: not {kind}"]
    found = []
    if "enum" in schema and value not in schema["enum"]:
        found.append(f"{at}: not one of the allowed values")
    if "minimum" in schema and value < schema["minimum"]:
        found.append(f"{at}: below {schema['minimum']}")
    if isinstance(value, dict):
        found += [f"{at}.{k}: missing" for k in schema.get("required", ()) if k not in value]
        for k in sorted(value):
            if k in schema.get("properties", {}):
                found += problems(value[k], schema["properties"][k], f"{at}.{k}")
    if isinstance(value, list) and "items" in schema:
        for i, x in enumerate(value):
            found += problems(x, schema["items"], f"{at}[{i}]")
    return found


def canonical(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def _refuse(constant: str):
    raise ValueError(constant)


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls (conv_id, turn, call_id, name, arguments, parents) with their result and ``linked``."""
    one = results.where("call_id is not null").groupBy("call_id").agg(F.min(F.struct("turn", "content")).alias("r"))
    one = one.select(F.col("call_id").alias("of"), F.col("r.content").alias("result"))
    joined = calls.select("conv_id", "turn", "call_id", "name", "arguments", "parents").join(one, F.col("call_id") == F.col("of"), "left")
    return joined.withColumn("linked", F.col("of").isNotNull()).drop("of")


def order(calls: DataFrame) -> DataFrame:
    """call_id, level (0 without parents, else one above the highest parent), missing parents."""
    given = calls.where("call_id is not null")
    nodes = given.select("call_id").distinct()
    edges = given.select("call_id", F.explode("parents").alias("parent")).distinct()
    known = edges.join(nodes.select(F.col("call_id").alias("there")), F.col("parent") == F.col("there"), "left")
    known = stored(calls.sparkSession, known, "edges")
    missing = known.where("there is null").groupBy("call_id").agg(F.count(F.lit(1)).alias("missing"))
    inner = known.where("there is not null").select("call_id", "parent")
    counts = cut(inner.groupBy("call_id").agg(F.count(F.lit(1)).alias("n"), F.min("parent").alias("parent")))
    kinds = counts.select(F.col("call_id").alias("of"), F.col("n").alias("many"))
    chains = _chains(counts, kinds)
    levels = chains.where("many = 0").select("call_id", F.col("steps").alias("level"))
    meets = inner.join(kinds.where("many > 1").select("of"), F.col("call_id") == F.col("of"), "left_semi")
    if not meets.isEmpty():
        met = _meets(meets, kinds, chains)
        base = met.select(F.col("call_id").alias("of"), F.col("level").alias("base"))
        above = chains.where("many > 1").join(base, F.col("to") == F.col("of"))
        levels = levels.unionByName(met).unionByName(above.select("call_id", (F.col("base") + F.col("steps")).alias("level")))
    out = nodes.join(levels, "call_id", "left").join(kinds, F.col("call_id") == F.col("of"), "left").join(missing, "call_id", "left")
    level = F.when(F.col("of").isNull(), F.lit(0)).otherwise(F.col("level")).cast("long")
    return out.select("call_id", level.alias("level"), F.coalesce("missing", F.lit(0)).cast("long").alias("missing"))


def _chains(counts: DataFrame, kinds: DataFrame) -> DataFrame:
    """Per call with one parent: its nearest ancestor ``to`` with none or several (``many``), and the steps there.

    Each round doubles the steps of all open pointers.  Those still open once
    the steps exceed the number of rows are on or after a cycle.
    """
    one = counts.where("n = 1").join(kinds, F.col("parent") == F.col("of"), "left")
    now = cut(one.select("call_id", F.col("parent").alias("to"), F.lit(1).cast("long").alias("steps"), F.coalesce("many", F.lit(0)).alias("many")))
    rows, reach = now.count(), 1
    while reach <= rows and not now.where("many = 1").isEmpty():
        further = now.select(F.col("call_id").alias("of"), F.col("to").alias("next"), F.col("steps").alias("more"), F.col("many").alias("then"))
        jumped = now.where("many = 1").join(further, F.col("to") == F.col("of"))
        jumped = jumped.select("call_id", F.col("next").alias("to"), (F.col("steps") + F.col("more")).alias("steps"), F.col("then").alias("many"))
        now, reach = cut(now.where("many <> 1").unionByName(jumped)), 2 * reach
    return now.where("many <> 1")


def _meets(edges: DataFrame, kinds: DataFrame, chains: DataFrame) -> DataFrame:
    """call_id and level of calls with several parents; a round places those whose parents all have a level."""
    tops = chains.select(F.col("call_id").alias("chain"), "to", "steps", F.col("many").alias("top"))
    rows = edges.join(kinds, F.col("parent") == F.col("of"), "left").join(tops, F.col("parent") == F.col("chain"), "left")
    rows = cut(rows.select(
        "call_id", F.when(F.col("many").isNull(), F.lit(0).cast("long")).when(F.col("top") == 0, F.col("steps")).alias("value"),
        F.when(F.col("many") > 1, F.col("parent")).when(F.col("top") > 1, F.col("to")).alias("wait"),
        F.coalesce("steps", F.lit(0)).cast("long").alias("steps")))
    placed = None
    while True:
        all_known = rows.groupBy("call_id").agg(F.max("value").alias("value"), F.count_if(F.col("value").isNull()).alias("left"))
        ready = cut(all_known.where("left = 0").select("call_id", (F.col("value") + 1).alias("level")))
        placed = ready if placed is None else placed.unionByName(ready)
        if ready.isEmpty():
            return placed
        base = ready.select(F.col("call_id").alias("of"), F.col("level").alias("base"))
        rest = rows.join(ready.select("call_id"), "call_id", "left_anti").join(base, F.col("wait") == F.col("of"), "left")
        rows = cut(rest.select("call_id", F.coalesce("value", F.col("base") + F.col("steps")).alias("value"), "wait", "steps"))


def render(linked: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """Add valid, errors and message (canonical JSON) to linked, ordered calls."""
    names = ["conv_id", "turn", "call_id", "name", "level", "missing", "linked", "arguments", "result"]
    out = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("call_id", pa.string()), ("name", pa.string()), ("level", pa.int64()),
                     ("missing", pa.int64()), ("linked", pa.bool_()), ("valid", pa.bool_()), ("errors", pa.string()), ("message", pa.string())])

    def message(row: dict, value) -> str:
        text = canonical({"arguments": value, "call_id": row["call_id"], "level": row["level"], "name": row["name"], "result": row["result"]})
        text.encode()
        return text

    def checked(row: dict) -> tuple[bool, str, str]:
        try:
            value = json.loads(row["arguments"] or "", parse_constant=_refuse)
            wrong = problems(value, schemas[row["name"]]) if row["name"] in schemas else ["unknown tool"]
            return not wrong, "; ".join(wrong), message(row, value)
        except (ValueError, RecursionError):
            return False, "$: not JSON", message(row, None)

    def run(batches):
        for batch in batches:
            made = [checked(row) for row in batch.to_pylist()]
            columns = [batch[c] for c in names[:7]] + [pa.array([m[i] for m in made], t) for i, t in enumerate((pa.bool_(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    return linked.select(*names).mapInArrow(
        run, "conv_id long, turn long, call_id string, name string, level long, missing long, linked boolean, valid boolean, errors string, message string")


def format_calls(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    levels = order(calls).select(F.col("call_id").alias("of"), "level", F.col("missing").alias("missing"))
    joined = link(calls, results).join(levels, F.col("call_id") == F.col("of"), "left").drop("of")
    return render(joined.withColumn("missing", F.coalesce("missing", F.lit(0)).cast("long")), schemas)


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that the turns of conversations stand for.

    A user turn is a call whose tool follows from its number of words and whose
    arguments hold its whole text: as it stands (search, summarize) or as all
    its words (count); it depends on the user turn two before, where there is
    one.  An assistant turn is the result of the call one turn before.  A
    system turn is neither call nor result: it gives no row, and a user turn
    two after it has a parent that is reported as missing.  So a derived call
    has one parent at most; several are for ``order`` with other tables.
    """
    key = lambda back: F.md5(F.concat_ws("|", F.col("conv_id"), F.col("turn") - back))
    t = turns.where("conv_id is not null and turn is not null").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    n = F.size(words(F.col("text")))
    tool = F.element_at(F.array(*[F.lit(x) for x in sorted(SCHEMAS)]), (n % len(SCHEMAS) + 1).cast("int"))
    args = (F.when(tool == "search", F.to_json(F.struct(F.col("text").alias("query"), (n % 50).alias("limit"))))
            .when(tool == "summarize", F.to_json(F.struct(F.when(n > 40, "long").when(n > 20, "short").otherwise("none").alias("style"), F.col("text").alias("text"))))
            .otherwise(F.to_json(F.struct(words(F.col("text")).alias("items")))))
    parent = F.when(F.col("turn") >= 2, F.array(key(2))).otherwise(F.array().cast("array<string>"))
    calls = t.where("role = 'user'").select("conv_id", "turn", key(0).alias("call_id"), tool.alias("name"), args.alias("arguments"), parent.alias("parents"))
    results = t.where("role = 'assistant'").select(key(1).alias("call_id"), "turn", F.col("text").alias("content"))
    return calls, results


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = from_conversations(table(spark, sf_dir, "conversations"))
    return format_calls(calls, results).select("conv_id", "turn", "call_id", "name", "level", "missing", "linked", "valid", "errors",
                                               F.sha2("message", 256).alias("message_sha256"), "message")
