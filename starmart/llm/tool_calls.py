"""Chat formatting: linking tool calls to their results (DataFrame functions only).

Calls and results meet by identifier in a hash join. Calls may name the calls whose
results they use; a call's depth is the longest path to it. Chains of calls that
use one result each are shortened by pointer doubling, so a chain of n calls takes
log2(n) joins; what is left are the calls that use several, which settle by joins
and grouped maxima in as many rounds as such calls follow on each other, each round
on the calls still open. Within a conversation calls
are numbered by depth, then turn and identifier, which is a topological order; the
numbers come from ranges of the whole order, not from one task per conversation.
Arguments are parsed, checked against the tool's schema and written, with the call
and its result, as canonical JSON: keys sorted, no white space.

Defined results: a call without a result has a null result and the status ``no
result``; results without a call are left out; of calls (or results) that share a
conversation and identifier the least one stays; calls and results with a null
conversation or identifier take no part; arguments that are not a JSON object, an
unknown tool, a missing, unexpected or wrongly typed argument, naming an unknown
call (the known ones still count for the depth) and using results in a circle each
give a status of their own, and the row stays; a call named twice counts once, a
null among the names not at all; other columns are not read; an empty table gives no
rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import Stages, with_rank

#: Tool schemas: argument to (type, required). Types: string, integer, number, boolean, array, object.
SCHEMAS = {"reply": {"prompt": ("string", True), "turn": ("integer", True)}}

# How a parsed argument's type is told.
_TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "(BIGINT|DOUBLE|DECIMAL.*)",
    "boolean": "BOOLEAN",
    "array": "ARRAY<.*",
    "object": "OBJECT<.*",
}


def _argument_status(name: Column, parsed: Column, keys: Column, schemas: dict) -> Column:
    """The first thing wrong with a call's arguments, or null."""
    status = F.when(parsed.isNull() | ~F.schema_of_variant(parsed).startswith("OBJECT<"), F.lit("arguments are no object"))
    for tool, arguments in sorted(schemas.items()):
        mine = name == tool
        extra = F.array_except(keys, F.array(*[F.lit(a) for a in arguments]).cast("array<string>"))
        for argument, (kind, required) in sorted(arguments.items()):
            there = F.array_contains(keys, argument)
            found = F.schema_of_variant(F.try_variant_get(parsed, f"$['{argument}']", "variant"))
            if required:
                status = status.when(mine & ~there, F.lit(f"missing {argument}"))
            status = status.when(mine & there & ~found.rlike(f"^{_TYPES[kind]}$"), F.lit(f"{argument} is no {kind}"))
        status = status.when(mine & (F.size(extra) > 0), F.concat(F.lit("unexpected "), F.array_join(F.array_sort(extra), ", ")))
    return status.when(~F.coalesce(name.isin(*schemas), F.lit(False)), F.lit("unknown tool"))


def _depths(stages: Stages, calls: DataFrame) -> DataFrame:
    """conv_id, call_id, depth, and what is wrong with the calls before (or null)."""
    ids = calls.select("conv_id", "call_id")
    edges = calls.select("conv_id", "call_id", F.explode(F.array_distinct(F.array_compact("after"))).alias("before"))
    known = ids.withColumnRenamed("call_id", "before").withColumn("known", F.lit(True))
    edges = stages.write(edges.join(known, ["conv_id", "before"], "left"), "edges")
    each = edges.groupBy("conv_id", "call_id").agg(
        F.count("known").alias("uses"), F.min(F.when(F.col("known"), F.col("before"))).alias("up"), F.max(F.col("known").isNull()).alias("lost")
    )
    # Each call goes up to its anchor: the next call that uses several results, or none.
    one = F.coalesce(F.col("uses") == 1, F.lit(False))
    chain = ids.join(each, ["conv_id", "call_id"], "left").select(
        "conv_id",
        "call_id",
        F.when(one, F.col("up")).alias("up"),
        F.when(~one, F.col("call_id")).alias("anchor"),
        F.when(one, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("depth"),
        F.coalesce(F.col("uses") > 1, F.lit(False)).alias("several"),
        F.when(F.col("lost"), F.lit("unknown call before")).alias("wrong"),
    )
    chain = stages.write(chain, "chain")
    rows = chain.count()
    for _ in range(math.ceil(math.log2(rows + 1)) + 1):
        if not chain.where("up IS NOT NULL").limit(1).count():
            break
        above = chain.select(
            "conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("anchor").alias("found"), F.col("depth").alias("more")
        )
        longer = chain.join(above, ["conv_id", "up"], "left").select(
            "conv_id",
            "call_id",
            F.col("next").alias("up"),
            F.coalesce("anchor", "found").alias("anchor"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
            "several",
            "wrong",
        )
        done, chain = chain, stages.write(longer, "chain")
        stages.drop(done)
    if chain.where("several").limit(1).count():
        base = _settled(stages, chain, edges)
        chain = chain.join(base, ["conv_id", "anchor"], "left").withColumn("depth", F.col("depth") + F.col("base"))
    # Whoever still has a call above, or an anchor that never settles, has no first call: a circle.
    circle = F.col("up").isNotNull() | F.col("depth").isNull()
    return chain.select(
        "conv_id",
        "call_id",
        F.when(~circle, F.col("depth")).alias("depth"),
        F.when(circle, F.lit("calls in a circle")).otherwise(F.col("wrong")).alias("wrong"),
    )


def _settled(stages: Stages, chain: DataFrame, edges: DataFrame) -> DataFrame:
    """conv_id, anchor and its depth (``base``), for the anchors that are in no circle."""
    ends = chain.where("up IS NULL").select("conv_id", F.col("call_id").alias("before"), "anchor", (F.col("depth") + 1).alias("steps"))
    several = chain.where("several").select("conv_id", "call_id")
    waits = edges.where("known").join(several, ["conv_id", "call_id"]).join(ends, ["conv_id", "before"], "left")
    # A null anchor is a circle of calls that use one result each; who waits for it never settles.
    waits = stages.write(waits.select("conv_id", "call_id", "anchor", "steps", F.lit(None).cast("long").alias("depth")), "waits")
    ready = chain.where("NOT several AND anchor = call_id").select("conv_id", "anchor", F.lit(0).cast("long").alias("base"))
    settled = [stages.write(ready, "settled")]
    while settled[-1].limit(1).count():
        reached = waits.join(settled[-1], ["conv_id", "anchor"], "left")
        reached = reached.withColumn("depth", F.coalesce("depth", F.col("base") + F.col("steps"))).drop("base")
        reached = stages.write(reached, "reached")
        stages.drop(waits)
        ready = reached.groupBy("conv_id", "call_id").agg(F.max("depth").alias("base"), F.max(F.col("depth").isNull()).alias("open"))
        settled.append(stages.write(ready.where("NOT open").select("conv_id", F.col("call_id").alias("anchor"), "base"), "settled"))
        done = settled[-1].select("conv_id", F.col("anchor").alias("call_id"))
        waits = stages.write(reached.join(done, ["conv_id", "call_id"], "left_anti"), "waits")
        stages.drop(reached)
    files = [f for table in settled for f in table.inputFiles()]
    return stages.spark.read.schema(settled[0].schema).parquet(*files)


def link_calls(calls: DataFrame, results: DataFrame, schemas: dict = SCHEMAS) -> DataFrame:
    """Calls (conv_id, call_id, after, turn, name, arguments; ``after`` a string or an
    array of them) with their results (conv_id, call_id, turn, content): conv_id,
    call_id, position, depth, status and the canonical JSON ``line`` of each call."""
    if dict(calls.dtypes)["after"] == "string":
        calls = calls.withColumn("after", F.array_compact(F.array("after")))
    stages = Stages(calls.sparkSession, "calls")
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    one = calls.where(named).groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "name", "arguments", "after")).alias("c"))
    one = stages.write(one.select("conv_id", "call_id", "c.*"), "calls")
    answers = results.where(named).groupBy("conv_id", "call_id").agg(F.min(F.struct("turn", "content")).alias("r"))
    answers = answers.select("conv_id", "call_id", F.col("r.content").alias("result"), F.lit(True).alias("answered"))

    linked = one.drop("after").join(answers, ["conv_id", "call_id"], "left").join(_depths(stages, one), ["conv_id", "call_id"])
    ranked = with_rank(stages, linked, [F.col(c).asc_nulls_last() for c in ("conv_id", "depth", "turn", "call_id")], "rank")
    first = ranked.groupBy("conv_id").agg(F.min("rank").alias("first"))
    parsed = F.try_parse_json("arguments")
    keys = F.map_keys(F.from_json("arguments", "map<string,string>"))
    status = F.coalesce(
        _argument_status(F.col("name"), parsed, F.coalesce(keys, F.array().cast("array<string>")), schemas),
        F.col("wrong"),
        F.when(F.col("answered").isNull(), F.lit("no result")),
        F.lit("ok"),
    )
    placed = ranked.join(first, "conv_id").select(
        "conv_id", "call_id", (F.col("rank") - F.col("first")).alias("position"), "depth", status.alias("status"), "name", parsed.alias("parsed"), "result"
    )
    line = F.to_json(
        F.struct(F.col("parsed").alias("arguments"), F.col("call_id").alias("id"), "name", "result", "status"), {"ignoreNullFields": "false"}
    )
    return placed.select("conv_id", "call_id", "position", "depth", "status", line.alias("line"))


def calls_in_messages(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results written as JSON in messages (conv_id, turn, role, text): an
    assistant's ``{"tool_calls": [{"id", "name", "arguments", "after"}]}``, ``after``
    one identifier or an array of them, and a tool's ``{"tool_call_id", "content"}``.
    Other messages hold none."""
    call = "tool_calls array<struct<id:string,name:string,arguments:string,after:string>>"
    parsed = messages.where(F.col("role") == "assistant").select("conv_id", "turn", "text", F.from_json("text", call).alias("m"))
    # The same calls as variants tell an array in ``after`` from a string that looks like one.
    listed = F.try_variant_get(F.try_parse_json("text"), "$.tool_calls", "array<variant>").alias("listed")
    parsed = parsed.where("m.tool_calls IS NOT NULL").select("conv_id", "turn", listed, F.posexplode("m.tool_calls").alias("at", "c"))
    several = F.try_variant_get(F.get("listed", F.col("at")), "$.after", "array<string>")
    calls = parsed.select(
        "conv_id",
        F.col("c.id").alias("call_id"),
        F.coalesce(several, F.array_compact(F.array("c.after"))).alias("after"),
        "turn",
        F.col("c.name").alias("name"),
        F.col("c.arguments").alias("arguments"),
    )
    told = messages.where(F.col("role") == "tool").select("conv_id", "turn", F.from_json("text", "tool_call_id string, content string").alias("r"))
    results = told.select("conv_id", F.col("r.tool_call_id").alias("call_id"), "turn", F.col("r.content").alias("content"))
    return calls, results


def calls_in_turns(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain conversations read as calls of a ``reply`` tool: each user's turn is a
    call that goes on from the user's turn before it, each assistant's turn right
    after a user's is that call's result. Neighbours are found by joins on the
    message's number in the whole order, so a long conversation is no single task."""
    stages = Stages(messages.sparkSession, "turns")
    some = messages.where(F.col("conv_id").isNotNull() & F.col("turn").isNotNull() & F.col("role").isin("user", "assistant"))
    some = stages.write(some.groupBy("conv_id", "turn", "role").agg(F.min("text").alias("text")), "messages")
    name = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    order = [F.col(c) for c in ("conv_id", "turn", "role")]
    ranked = with_rank(stages, some, order, "place")
    earlier = ranked.where("role = 'user'").select("conv_id", (F.col("place") + 1).alias("place"), name.alias("call_id"))
    results = ranked.where("role = 'assistant'").join(earlier, ["conv_id", "place"]).select("conv_id", "call_id", "turn", F.col("text").alias("content"))

    asked = with_rank(stages, some.where(F.col("role") == "user"), order, "place")
    before = asked.select("conv_id", (F.col("place") + 1).alias("place"), name.alias("after"))
    arguments = F.to_json(F.struct(F.col("text").alias("prompt"), "turn"))
    calls = asked.join(before, ["conv_id", "place"], "left").select(
        "conv_id", name.alias("call_id"), F.array_compact(F.array("after")).alias("after"), "turn", F.lit("reply").alias("name"), arguments.alias("arguments")
    )
    return calls, results


def format_conversations(messages: DataFrame) -> DataFrame:
    """Every call in ``messages``, whether written as JSON or as a plain turn."""
    written, told = calls_in_messages(messages)
    plain, answers = calls_in_turns(messages)
    return link_calls(plain.unionByName(written), answers.unionByName(told))


#: The same rows for DuckDB, for conversations without calls written as JSON or repeated turns.
CALLS_SQL = """
WITH m AS (
  SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM conversations WHERE role IN ('user', 'assistant') AND conv_id IS NOT NULL AND turn IS NOT NULL
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), u AS (
  SELECT conv_id, turn, text, CASE WHEN next_role = 'assistant' THEN next_text END AS result,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS position,
         coalesce(next_role = 'assistant', false) AS answered
  FROM m WHERE role = 'user'
), s AS (
  SELECT *, conv_id || ':' || turn AS call_id, CASE WHEN text IS NULL THEN 'missing prompt' WHEN answered THEN 'ok' ELSE 'no result' END AS status
  FROM u
)
SELECT conv_id, call_id, position, position AS depth, status,
       json_object('arguments', json_object('prompt', text, 'turn', turn), 'id', call_id, 'name', 'reply',
                   'result', result, 'status', status)::VARCHAR AS line
FROM s
"""
