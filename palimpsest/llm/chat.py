"""Linking of tool calls and their results in chats, native DataFrame operations only.

Input: messages (conv_id, turn, role, text).  The text of an assistant's
message may be JSON ``{"content": ..., "tool_calls": [{"id", "name",
"arguments", "after": [ids]}]}``, that of a tool's message
``{"tool_call_id", "content"}``; ``arguments`` is any JSON value, ``after``
names calls of the chat whose results the call needs.  Every other text is
plain content.

* Calls and results meet by a join on (conv_id, id).
* Calls are ordered topologically over ``after``: level 0 needs nothing, a
  call's level is one above the highest it needs.  Chains of needs are
  shortened for all chats at once, by half a round; calls on a cycle or behind
  one have none.
* Arguments are checked against a table of schemas (tool, parameter, type,
  required).  Types: string, integer, number, boolean, array, object.
* A linked call becomes one canonical JSON line: keys in order, no blanks, each
  string escaped one way only.

Defined results: status is ``linked``, ``unanswered`` (no result), ``repeated``
(several results or several calls with one id; the first by turn counts and
carries it), ``orphan`` (a result without a call) or ``cyclic``.  A needed call
that does not exist is listed in errors and not waited for.  Null ids link with
nothing.  Text that is not JSON, null or empty holds no calls.  An empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.session import materialized

CALL = "array<struct<id: string, name: string, arguments: variant, after: array<string>>>"
TYPES = {"string": "STRING", "integer": "BIGINT", "number": "BIGINT|DOUBLE|DECIMAL.*", "boolean": "BOOLEAN",
         "array": "ARRAY.*", "object": "OBJECT.*"}


def parsed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role and the text as a variant; anything that is not JSON is null."""
    return messages.select("conv_id", "turn", "role", F.try_parse_json(F.col("text").cast("string")).alias("v"))


def calls_of(messages: DataFrame) -> DataFrame:
    """One row per call: conv_id, turn, place in its message, call_id, name, arguments, after."""
    calls = F.try_variant_get("v", "$.tool_calls", "array<variant>")
    one = parsed(messages).where(F.col("role") == "assistant").select("conv_id", "turn", F.posexplode(calls).alias("place", "c"))
    return one.select("conv_id", "turn", "place", F.try_variant_get("c", "$.id", "string").alias("call_id"),
                      F.try_variant_get("c", "$.name", "string").alias("name"),
                      F.try_variant_get("c", "$.arguments", "variant").alias("arguments"),
                      F.coalesce(F.try_variant_get("c", "$.after", "array<string>"), F.array().cast("array<string>")).alias("after"))


def results_of(messages: DataFrame) -> DataFrame:
    rows = parsed(messages).where(F.col("role") == "tool")
    return rows.select("conv_id", F.col("turn").alias("result_turn"), F.try_variant_get("v", "$.tool_call_id", "string").alias("call_id"),
                       F.try_variant_get("v", "$.content", "variant").alias("result"))


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level) for (conv_id, call_id, after); level is null on and behind cycles.

    A call's level is the maximum of a constant and, for each need, a distance
    plus that need's level.  In every round, for all chats at once, a need that
    is settled joins the constant, and a need that waits for one other call
    only is replaced by that call, at the summed distance.  So distances double
    along a chain: a chat of n turns takes about log2(n) rounds, and no call
    ever has more needs than it named.  A distance no chat is long enough for
    is a cycle; calls that wait for each other along several ways make a round
    without a change, which ends the search.
    """
    known = calls.select("conv_id", "call_id")
    longest = known.groupBy("conv_id").count().agg(F.max("count")).head()[0] or 0
    edges = calls.select("conv_id", "call_id", F.explode(F.array_distinct("after")).alias("need"))
    edges = edges.join(known.withColumnRenamed("call_id", "need"), ["conv_id", "need"], "left_semi")
    waiting = materialized(edges.groupBy("conv_id", "call_id").agg(
        F.collect_list(F.struct("need", F.lit(1).alias("far"))).alias("needs")).withColumn("least", F.lit(0)).withColumn("moved", F.lit(True)))
    # A settled call has no needs; its level is `least`, or none if it is cyclic
    done = [materialized(known.join(waiting, ["conv_id", "call_id"], "left_anti").withColumn("least", F.lit(0)))]
    state = waiting
    while state.where("moved").limit(1).count():
        only = F.array_distinct("needs.need")
        others = waiting.select("conv_id", F.col("call_id").alias("need"), F.col("least").alias("least_of"), F.lit(False).alias("settled"),
                                F.when(F.size(only) == 1, only[0]).alias("onward"), F.array_max("needs.far").alias("onward_far"))
        for settled in done:
            others = others.unionByName(settled.select("conv_id", F.col("call_id").alias("need"), F.col("least").alias("least_of"),
                                                       F.lit(True).alias("settled")), allowMissingColumns=True)
        steps = (waiting.select("conv_id", "call_id", "least", F.explode("needs").alias("n"))
                 .select("conv_id", "call_id", "least", "n.need", "n.far").join(others, ["conv_id", "need"]))
        jumps = ~F.col("settled") & F.col("onward").isNotNull()
        far = F.col("far") + F.when(jumps, F.col("onward_far")).otherwise(0)
        cyclic = (F.col("settled") & F.col("least_of").isNull()) | (far >= longest)
        steps = steps.select(
            "conv_id", "call_id", "least", "settled", jumps.alias("jumps"), cyclic.alias("cyclic"), (F.col("far") + F.col("least_of")).alias("through"),
            F.when(~F.col("settled"), F.struct(F.when(jumps, F.col("onward")).otherwise(F.col("need")).alias("need"), far.alias("far"))).alias("n"))
        is_through = F.col("settled") | F.col("jumps")
        state = materialized(steps.groupBy("conv_id", "call_id").agg(
            F.collect_list("n").alias("needs"), F.max(F.greatest("least", F.when(is_through, F.col("through")))).alias("least"),
            F.bool_or(is_through).alias("moved"), F.bool_or("cyclic").alias("cyclic")))
        ends = F.col("cyclic") | (F.size("needs") == 0)
        done.append(state.where(ends).select("conv_id", "call_id", F.when(~F.col("cyclic"), F.col("least")).alias("least")))
        waiting = state.where(~ends).drop("cyclic")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return known.join(out.withColumnRenamed("least", "level"), ["conv_id", "call_id"], "left")


def argument_errors(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, call_id, errors): ``missing:p``, ``type:p``, ``unknown:p``, ``tool``, ``arguments``.

    ``schemas`` (tool, parameter, type, required) is one row per parameter of
    the tools on offer; it becomes one small map column, pre-aggregated.
    """
    wanted = schemas.groupBy(F.col("tool").alias("name")).agg(
        F.sort_array(F.collect_list(F.struct("parameter", "type", "required"))).alias("spec"))
    rows = calls.join(wanted, "name", "left")
    given = F.try_variant_get("arguments", "$", "map<string,variant>")
    rows = rows.withColumn("given", given)
    pattern = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])
    value = lambda p: F.element_at(F.col("given"), p["parameter"])
    is_null = lambda p: value(p).isNull() | F.is_variant_null(value(p))
    per_parameter = F.transform("spec", lambda p: F.when(
        is_null(p), F.when(p["required"], F.concat(F.lit("missing:"), p["parameter"])))
        .when(~F.rlike(F.schema_of_variant(value(p)), F.concat(F.lit("^("), F.coalesce(pattern[p["type"]], F.lit(".*")), F.lit(")$"))),
              F.concat(F.lit("type:"), p["parameter"])))
    unknown = F.transform(F.array_sort(F.array_except(F.map_keys("given"), F.transform("spec", lambda p: p["parameter"]))),
                          lambda k: F.concat(F.lit("unknown:"), k))
    errors = (F.when(F.col("spec").isNull(), F.array(F.lit("tool")))
              .when(F.col("given").isNull(), F.array(F.lit("arguments")))
              .otherwise(F.concat(F.filter(per_parameter, lambda e: e.isNotNull()), unknown)))
    return rows.withColumn("errors", errors).drop("spec", "given")


def canonical(value: Column) -> Column:
    """JSON text of a variant: its object keys are kept in order, without blanks."""
    return F.to_json(value)


def link(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call and per orphaned result.

    conv_id, call_id, turn, place, level, name, status, errors, result_turn, line (canonical JSON).
    """
    calls = calls_of(messages)
    # Repeated ids: the first call stands for the id.  A struct's minimum is pre-aggregated.
    body = F.struct("turn", "place", "name", F.to_json("arguments").alias("arguments"), "after")
    named = calls.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(body).alias("c"), F.count(F.lit(1)).alias("n_calls")).select("conv_id", "call_id", "c.*", "n_calls")
    nameless = calls.where("conv_id is null or call_id is null").select(
        "conv_id", "call_id", "turn", "place", "name", F.to_json("arguments").alias("arguments"), "after", F.lit(1).cast("bigint").alias("n_calls"))
    named = materialized(named)
    results = results_of(messages)
    answers = results.where("conv_id is not null and call_id is not null").groupBy("conv_id", "call_id").agg(
        F.min(F.struct("result_turn", F.to_json("result").alias("result"))).alias("r"), F.count(F.lit(1)).alias("n_results"))
    answers = answers.select("conv_id", "call_id", "r.*", "n_results")
    lost = results.where("conv_id is null or call_id is null").select(
        "conv_id", "call_id", "result_turn", F.to_json("result").alias("result"), F.lit(1).cast("bigint").alias("n_results"))

    missing = (named.select("conv_id", "call_id", F.explode("after").alias("needs"))
               .join(named.select("conv_id", F.col("call_id").alias("needs")), ["conv_id", "needs"], "left_anti")
               .groupBy("conv_id", "call_id").agg(F.array_sort(F.collect_set(F.concat(F.lit("after:"), "needs"))).alias("lacks")))
    linked = (named.join(levels(named.select("conv_id", "call_id", "after")), ["conv_id", "call_id"], "left")
              .join(missing, ["conv_id", "call_id"], "left").join(answers, ["conv_id", "call_id"], "full"))
    extra = nameless.withColumn("level", F.lit(0))
    rows = linked.unionByName(extra, allowMissingColumns=True).unionByName(lost, allowMissingColumns=True)
    is_call = F.col("n_calls").isNotNull()
    status = (F.when(~is_call, "orphan").when(F.col("level").isNull(), "cyclic")
              .when((F.col("n_calls") > 1) | (F.coalesce(F.col("n_results"), F.lit(0)) > 1), "repeated")
              .when(F.col("n_results").isNull(), "unanswered").otherwise("linked"))
    rows = rows.withColumn("status", status).withColumn("arguments", F.try_parse_json("arguments"))
    rows = argument_errors(rows, schemas)
    none = F.array().cast("array<string>")
    errors = F.when(is_call, F.concat("errors", F.coalesce("lacks", none))).otherwise(none)
    part = lambda key, json: F.concat(F.lit(f'"{key}":'), F.coalesce(json, F.lit("null")))
    text = lambda c: F.to_json(F.to_variant_object(F.array(F.col(c).cast("string"))))
    inner = lambda c: F.when(F.col(c).isNotNull(), F.regexp_extract(text(c), r"(?s)^\[(.*)\]$", 1))
    line = F.concat(F.lit("{"), F.concat_ws(
        ",", part("arguments", canonical(F.col("arguments"))), part("id", inner("call_id")), part("name", inner("name")),
        part("result", F.col("result"))), F.lit("}"))
    return rows.select("conv_id", "call_id", "turn", "place", "level", "name", "status", errors.alias("errors"), "result_turn", line.alias("line"))
