"""Tool-call linking for chat data. DataFrame functions only.

Calls and results are rows. A result is hash-joined to its call by identifier. Calls
are put in an order in which each follows the calls it depends on; their arguments
are checked against parameter schemas; each call with its result is serialised as
canonical JSON (keys sorted at every depth, no blanks), one row per call.

Order. Where dependencies point backwards in the conversation its own order will do.
A call gets a level: the largest number of dependencies on a path to it that point
forwards. (level, turn, call id) is a topological order. Rounds of joins raise levels
until none changes; a level above the number of forward dependencies of the
conversation can only come from a cycle: such calls, in or behind one, are cyclic. Conversations
without forward dependencies need no round, whatever their length.

Tables: calls (conv_id, turn, call_id, name, arguments: JSON text, depends_on:
array<string>), results (conv_id, call_id, content), schemas (name, param, type,
required, minimum, maximum). An identifier holds within its conversation: a call is
known by (conv_id, call_id).

One row per call and result, so that a call's results are never gathered in one place;
a call without result has one row. Calls that are repeated whole are one call with
``copies``. Of different calls with one identifier the first by (turn, name, arguments) is
the call; the others link to nothing and have the problem "id". Results without a
known call are rows with the problem "call".

Defined cases: a null conv_id or call_id links to nothing and nothing depends on it;
null arguments are the empty object, text that is no JSON object gives the problem
"arguments"; calls of a name without schema give "name"; a parameter that the schema
names twice is checked twice; dependencies on unknown calls are dropped; repeated
dependencies count once; equal results of a call are rows of their own; very long
arguments and results are kept whole; empty tables give empty results; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import staged
from barforge.session import shared_dir

KEY = ["conv_id", "call_id"]
CALL = ["conv_id", "turn", "call_id", "name", "arguments", "depends_on"]
KEYED = "conv_id is not null and call_id is not null"
BROADCAST_SCHEMAS = 100_000  # rows


def distinct_calls(calls: DataFrame) -> DataFrame:
    """Calls without whole repeats: adds copies and ``known``, true for the one call that an identifier stands for."""
    once = calls.groupBy(*CALL).agg(F.count("*").alias("copies"))
    first = F.row_number().over(Window.partitionBy(*KEY).orderBy("turn", "name", "arguments", "depends_on")) == 1
    return (once.where(KEYED).withColumn("known", first)
            .unionByName(once.where(f"not ({KEYED})").withColumn("known", F.lit(False))))


def link_results(calls: DataFrame, results: DataFrame) -> DataFrame:
    """Calls (with ``known``) and their results: a row per pair, with ``result``, ``linked`` and ``n_results``.

    Rows of results without a call have null in the call's columns but for its identifier.
    """
    content = results.select(*KEY, F.col("content").alias("result"))
    counts = content.where(KEYED).groupBy(*KEY).agg(F.count("*").alias("n_results"))
    known = calls.where("known").join(counts, KEY, "left")
    linked = known.where("n_results is not null").join(content.where(KEYED), KEY)
    alone = known.where("n_results is null").unionByName(calls.where("not known"), allowMissingColumns=True)
    lost = content.join(calls.where("known").select(*KEY), KEY, "left_anti")
    return (linked.withColumn("linked", F.lit(True))
            .unionByName(alone.withColumn("linked", F.lit(False)), allowMissingColumns=True)
            .unionByName(lost.withColumn("linked", F.lit(False)), allowMissingColumns=True)
            .withColumn("n_results", F.coalesce("n_results", F.lit(0).cast("bigint"))))


def ordered(calls: DataFrame) -> DataFrame:
    """(conv_id, turn, call_id, depends_on, known) -> adds level and cyclic, 0 and false for calls that are not known."""
    shared_dir(calls.sparkSession)
    nodes = calls.where("known")
    edges = (nodes.select("conv_id", F.col("turn").alias("to_turn"), F.col("call_id").alias("to"),
                          F.explode(F.array_distinct("depends_on")).alias("from"))
             .join(nodes.select("conv_id", F.col("call_id").alias("from"), F.col("turn").alias("from_turn")), ["conv_id", "from"]))
    before = F.struct("from_turn", "from") < F.struct("to_turn", "to")
    edges = staged(edges.select("conv_id", "from", "to", F.when(before, 0).otherwise(1).alias("step")), "call-edges")
    forward = edges.where("step = 1").groupBy("conv_id").agg(F.count("*").alias("most"))
    if forward.isEmpty():
        return calls.withColumn("level", F.lit(0).cast("bigint")).withColumn("cyclic", F.lit(False))
    # only conversations with forward dependencies take part in the rounds
    edges = edges.join(forward, "conv_id").checkpoint()
    levels = edges.where("step = 1").select("conv_id", F.col("to").alias("call_id"), F.lit(1).cast("bigint").alias("level")).distinct()
    levels = levels.checkpoint()
    while True:
        reached = (edges.join(levels.withColumnsRenamed({"call_id": "from"}), ["conv_id", "from"])
                   .select("conv_id", F.col("to").alias("call_id"),
                           F.least(F.col("level") + F.col("step"), F.col("most") + 1).alias("level")))
        raised = levels.union(reached).groupBy("conv_id", "call_id").agg(F.max("level").alias("level")).checkpoint()
        same = levels.agg(F.count("*"), F.sum("level")).first() == raised.agg(F.count("*"), F.sum("level")).first()
        levels = raised
        if same:
            break
    levels = levels.join(forward, "conv_id").select("conv_id", "call_id", "level", (F.col("level") > F.col("most")).alias("cyclic"))
    out = calls.join(levels, KEY, "left")
    return (out.withColumn("level", F.when(F.col("known"), F.coalesce("level", F.lit(0))).otherwise(0).cast("bigint"))
            .withColumn("cyclic", F.col("known") & F.coalesce("cyclic", F.lit(False))))


def argument_object(arguments: Column) -> Column:
    """Arguments as a variant object, null if the text is no JSON object."""
    parsed = F.try_parse_json(F.coalesce(arguments, F.lit("{}")))
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed)


def schema_lists(schemas: DataFrame) -> DataFrame:
    """(name, params): one row per name, its parameters as a list; a name has as many as its author wrote."""
    param = F.struct("param", "type", F.coalesce("required", F.lit(False)).alias("required"), "minimum", "maximum")
    lists = schemas.groupBy("name").agg(F.collect_list(param).alias("params"))
    return F.broadcast(lists) if schemas.limit(BROADCAST_SCHEMAS + 1).count() <= BROADCAST_SCHEMAS else lists


def validated(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """Adds ``problems``: sorted names of the parameters that break the schema of the call's name.

    Each call is checked in its own row against the list of its schema's parameters.
    Unknown parameters are problems too.
    """
    rows = calls.withColumn("_object", argument_object(F.col("arguments"))).join(schema_lists(schemas), "name", "left")
    rows = rows.withColumn("_given", F.try_variant_get("_object", "$", "map<string, variant>"))

    def broken(p: Column) -> Column:
        value = F.try_element_at("_given", p["param"])
        kind, number = F.schema_of_variant(value), F.try_variant_get(value, "$", "double")
        # JSON numbers are BIGINT, DECIMAL(...) or DOUBLE
        fits = (F.when(p["type"] == "string", kind == "STRING").when(p["type"] == "boolean", kind == "BOOLEAN")
                .when(p["type"] == "integer", kind == "BIGINT").when(p["type"] == "number", kind.rlike("^(BIGINT|DECIMAL|DOUBLE)"))
                .when(p["type"] == "array", kind.startswith("ARRAY")).when(p["type"] == "object", kind.startswith("OBJECT"))
                .otherwise(F.lit(False)))
        fine = fits & (p["minimum"].isNull() | (number >= p["minimum"])) & (p["maximum"].isNull() | (number <= p["maximum"]))
        return F.when(value.isNull(), p["required"]).otherwise(~F.coalesce(fine, F.lit(False)))

    none = F.array().cast("array<string>")
    wrong = F.transform(F.filter("params", broken), lambda p: p["param"])
    extra = F.array_except(F.map_keys("_given"), F.transform("params", lambda p: p["param"]))
    found = (F.when(F.col("_object").isNull(), F.when(F.col("params").isNull(), F.array(F.lit("arguments"), F.lit("name")))
                    .otherwise(F.array(F.lit("arguments"))))
             .when(F.col("params").isNull(), F.array(F.lit("name")))
             .otherwise(F.array_sort(F.array_distinct(F.concat(wrong, extra)))))
    return rows.withColumn("problems", F.coalesce(found, none)).drop("params", "_object", "_given")


def canonical_json(calls: DataFrame) -> Column:
    """The call as canonical JSON; variants print their keys in order and without blanks. Lost results have null arguments."""
    return F.to_json(F.struct(
        F.when(F.col("copies").isNotNull(), argument_object(F.col("arguments"))).alias("arguments"),
        F.col("call_id").alias("id"), F.col("name"), F.col("result")), {"ignoreNullFields": "false"})


def linked_calls(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """Per call and result: (conv_id, turn, level, cyclic, call_id, copies, linked, n_results, problems, json)."""
    once = staged(distinct_calls(calls.select(*CALL)), "calls")
    checked = validated(ordered(once), schemas)
    twice = F.expr(f"not known and {KEYED}")
    checked = checked.withColumn("problems", F.when(twice, F.array_sort(F.array_union("problems", F.array(F.lit("id"))))).otherwise(F.col("problems")))
    out = link_results(checked, results)
    return out.select("conv_id", "turn", "level", "cyclic", "call_id", "copies", "linked", "n_results",
                      F.coalesce("problems", F.array(F.lit("call"))).alias("problems"), canonical_json(out).alias("json"))
