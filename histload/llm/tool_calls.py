"""Chat formatting: tool calls linked with their results, put in order, validated, and written as canonical JSON.

All of it is DataFrame and SQL functions. Calls and results meet by hash join on conversation and identifier. A call may
name calls it depends on. Its place in the order is (turn, step): its turn, and step 0, unless it depends on a call
that is not before it; then it moves just after that one. Conversations that are written in order, which most are, need no more
than a join to see it. In the others calls without open dependencies are settled round by round; where a dependency has a
single one itself, it is passed over, so that the rounds of a chain grow with the logarithm of its length, and beyond that with
how often ways part. A round that settles nothing leaves the calls on cycles and those that wait for them. No conversation is
gathered in one task. Messages that are broken give rows of their own, with an error.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histload.llm.tables import stored

#: Of each tool, its parameters: the JSON type, whether it must be there and, if need be, rules: "enum", a list of values;
#: "minimum" and "maximum" of a number; "items", the type of an array's; "properties" of an object, like a tool's parameters.
Schemas = dict[str, dict[str, tuple]]

_KEY = ["conv_id", "call_id"]
#: How schema_of_variant names the JSON types.
_TYPES = {
    "string": "STRING",
    "integer": "BIGINT",
    "number": "BIGINT|DOUBLE|DECIMAL.*",
    "boolean": "BOOLEAN",
    "object": "OBJECT.*",
    "array": "ARRAY.*",
    "null": "VOID",
}


def calls_in(messages: DataFrame) -> DataFrame:
    """The calls that assistant messages hold: (conv_id, turn, call_id, name, arguments, depends_on, error). Such a message is a
    JSON object with "tool_calls", an array of objects with "id", "name", "arguments" and, if need be, "depends_on". Tool calls
    that are no array give one row without an identifier, with the error."""
    calls = F.try_variant_get(_object(), "$.tool_calls", "array<variant>")
    given = F.variant_get(_object(), "$.tool_calls", "variant")
    broken = F.when(given.isNotNull() & calls.isNull(), F.array(F.lit(None).cast("variant")))
    each = messages.where("role = 'assistant'").select("conv_id", "turn", F.explode(F.coalesce(calls, broken)).alias("call"))
    take = lambda name, kind: F.try_variant_get("call", f"$.{name}", kind)
    return each.select(
        "conv_id",
        "turn",
        take("id", "string").alias("call_id"),
        take("name", "string").alias("name"),
        F.to_json(F.variant_get("call", "$.arguments", "variant")).alias("arguments"),
        take("depends_on", "array<string>").alias("depends_on"),
        F.when(F.col("call").isNull(), F.lit("tool_calls are no array")).alias("error"),
    )


def results_in(messages: DataFrame) -> DataFrame:
    """The results that tool messages hold: (conv_id, turn, call_id, content, error). Such a message is a JSON object with
    "tool_call_id" and "content"; of another the content is its text, and it has no identifier but an error."""
    whole = messages.where("role = 'tool'").select("conv_id", "turn", "text", _object().alias("o"))
    call_id = F.try_variant_get("o", "$.tool_call_id", "string")
    broken = F.when(F.col("o").isNull(), "the message is no JSON object").when(call_id.isNull(), "tool_call_id is missing")
    content = F.when(broken.isNull(), F.to_json(F.variant_get("o", "$.content", "variant"))).otherwise(F.col("text"))
    return whole.select("conv_id", "turn", call_id.alias("call_id"), content.alias("content"), broken.alias("error"))


def _object() -> Column:
    return F.try_parse_json(F.when(F.ltrim("text").startswith("{"), F.col("text")))


def _wrong(value: Column, name: str, kind: str, required: bool = False, rules: dict | None = None) -> list[Column]:
    """What is wrong with a value, each null if it isn't."""
    rules, there = rules or {}, value.isNotNull()
    of_kind = lambda v, k: F.schema_of_variant(v).rlike(f"^({_TYPES[k]})$")
    found = [F.when(value.isNull(), F.lit(f"{name} is missing"))] if required else []
    found.append(F.when(there & ~of_kind(value, kind), F.lit(f"{name} is no {kind}")))
    fits = there & of_kind(value, kind)
    if "enum" in rules:
        known = F.to_json(value).isin(*[json.dumps(v, ensure_ascii=False, separators=(",", ":")) for v in rules["enum"]])
        found.append(F.when(fits & ~known, F.lit(f"{name} is none of {', '.join(map(str, rules['enum']))}")))
    number = F.try_variant_get(value, "$", "double")
    if "minimum" in rules:
        found.append(F.when(fits & (number < rules["minimum"]), F.lit(f"{name} is below {rules['minimum']}")))
    if "maximum" in rules:
        found.append(F.when(fits & (number > rules["maximum"]), F.lit(f"{name} is above {rules['maximum']}")))
    if "items" in rules:
        items = F.try_variant_get(value, "$", "array<variant>")
        odd = F.exists(items, lambda v: ~F.coalesce(of_kind(v, rules["items"]), F.lit(False)))
        found.append(F.when(fits & odd, F.lit(f"{name} holds what is no {rules['items']}")))
    if "properties" in rules:
        found += [F.when(fits, e) for e in _wrong_parts(value, rules["properties"], f"{name}.")]
    return found


def _wrong_parts(whole: Column, parameters: dict[str, tuple], within: str = "") -> list[Column]:
    found = []
    for name, rule in sorted(parameters.items()):
        found += _wrong(F.variant_get(whole, f"$['{name}']", "variant"), within + name, *rule)
    keys = F.map_keys(F.try_variant_get(whole, "$", "map<string, variant>"))
    more = F.array_sort(F.array_except(keys, F.array(*map(F.lit, sorted(parameters)))))
    return [*found, F.when(F.size(more) > 0, F.concat(F.lit("unknown: "), F.array_join(F.transform(more, lambda k: F.concat(F.lit(within), k)), ", ")))]


def _errors(schemas: Schemas) -> Column:
    """What is wrong with the arguments, as an array of texts."""
    found = [F.when(F.col("parsed").isNull(), F.lit("arguments are no JSON object"))]
    for tool, parameters in sorted(schemas.items()):
        mine = (F.col("name") == tool) & F.col("parsed").isNotNull()
        found += [F.when(mine, e) for e in _wrong_parts(F.col("parsed"), parameters)]
    found.append(F.when(~F.coalesce(F.col("name").isin(*schemas), F.lit(False)), F.lit("unknown tool")))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def _moved(place: Column, by: Column) -> Column:
    return F.struct(place["at"].alias("at"), (place["step"] + by).alias("step"))


def _settled(calls: DataFrame, edges: DataFrame) -> DataFrame:
    """Places of calls that wait for others: (conv_id, call_id, place), without those on cycles and those that wait for them.
    Takes ``calls`` (conv_id, call_id, place) and ``edges`` (conv_id, call_id, on) between them.

    A call's place is the greatest of its bound and, for each edge, the place of what it waits for, some steps later. An edge to
    a call that has a single edge left becomes one to what that one waits for; of edges that then are equal, the longest stays.
    """
    nodes, done = calls.select(*_KEY, F.col("place").alias("bound")), None
    edges = stored(edges.select(*_KEY, "on", F.lit(1).cast("long").alias("by")), "edges")
    nodes = stored(nodes, "waiting")
    while True:
        free = stored(nodes.join(edges, _KEY, "left_anti").select(*_KEY, F.col("bound").alias("place")), "settled")
        if free.isEmpty():
            break
        done = free if done is None else done.union(free)
        # what is settled now bounds those that wait for it
        known = free.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("place").alias("known"))
        met = edges.join(known, (F.col("conv_id") == F.col("c")) & (F.col("on") == F.col("i")), "left")
        met = stored(met.select(*_KEY, "on", "by", "known"), "met")
        raised = met.where("known is not null").groupBy(*_KEY).agg(F.max(_moved(F.col("known"), F.col("by"))).alias("by_known"))
        nodes = nodes.join(free.select(*_KEY), _KEY, "left_anti").join(raised, _KEY, "left")
        nodes = stored(nodes.select(*_KEY, F.greatest("bound", "by_known").alias("bound")), "waiting")
        edges = met.where("known is null").drop("known")
        # edges to calls with a single edge pass them
        single = edges.groupBy(*_KEY).agg(F.count("*").alias("n"), F.first("on").alias("next"), F.first("by").alias("next_by")).where("n = 1")
        single = single.join(nodes, _KEY).select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), "next", "next_by", F.col("bound").alias("passed"))
        passing = stored(edges.join(single, (F.col("conv_id") == F.col("c")) & (F.col("on") == F.col("i")), "left").drop("c", "i"), "passing")
        raised = passing.where("passed is not null").groupBy(*_KEY).agg(F.max(_moved(F.col("passed"), F.col("by"))).alias("by_passed"))
        nodes = stored(nodes.join(raised, _KEY, "left").select(*_KEY, F.greatest("bound", "by_passed").alias("bound")), "waiting")
        on, by = F.coalesce("next", "on").alias("on"), (F.col("by") + F.coalesce("next_by", F.lit(0))).alias("by")
        edges = stored(passing.select(*_KEY, on, by).groupBy(*_KEY, "on").agg(F.max("by").alias("by")), "edges")
    return done if done is not None else free


def ordered(calls: DataFrame) -> DataFrame:
    """Places of calls in a topological order: (conv_id, call_id, at, step, n_unresolved, cyclic), to be sorted by at,
    step and call_id. Takes distinct conv_id and call_id, turn and depends_on; a call's place is after those of the
    calls it depends on. Identifiers that name no call are counted as unresolved. Calls on a cycle, and those that
    wait for one, are marked and keep their turn."""
    place = F.struct(F.coalesce("turn", F.lit(0)).cast("long").alias("at"), F.lit(0).cast("long").alias("step"))
    state = stored(calls.select(*_KEY, place.alias("place")), "places")
    wanted = calls.select(*_KEY, place.alias("place"), F.explode(F.array_distinct("depends_on")).alias("on")).where("`on` is not null")
    named = state.select(F.col("conv_id").alias("c"), F.col("call_id").alias("i"), F.col("place").alias("earlier"))
    matched = stored(wanted.join(named, (F.col("conv_id") == F.col("c")) & (F.col("on") == F.col("i")), "left"), "dependencies")
    unresolved = matched.where("i is null").groupBy(*_KEY).agg(F.count("*").alias("n_unresolved"))
    edges = matched.where("i is not null")
    late = stored(edges.where("earlier >= place").select("conv_id").distinct(), "late")
    if late.isEmpty():
        placed = state.withColumn("cyclic", F.lit(False))
    else:
        some = state.join(late, "conv_id", "left_semi")
        found = _settled(some, edges.join(late, "conv_id", "left_semi"))
        found = stored(found.select(*_KEY, F.col("place").alias("found")), "found")
        some = some.join(found, _KEY, "left").select(*_KEY, F.coalesce("found", "place").alias("place"), F.col("found").isNull().alias("cyclic"))
        placed = state.join(late, "conv_id", "left_anti").withColumn("cyclic", F.lit(False)).union(some)
    return placed.join(unresolved, _KEY, "left").select(
        *_KEY, "place.at", "place.step", F.coalesce("n_unresolved", F.lit(0).cast("long")).alias("n_unresolved"), "cyclic"
    )


def linked(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """Calls with their results: (conv_id, call_id, turn, name, status, result_turn, at, step, n_unresolved, cyclic, errors,
    n_calls, n_results, json).

    ``calls`` has conv_id, turn, call_id, name, arguments (JSON) and depends_on (array); ``results`` conv_id, turn,
    call_id and content; both may have an error, which is told in a row that cannot be linked; other columns are ignored. One row for each identifier of a conversation. Status: answered,
    unanswered, or orphan (a result without a call, which has no place, no errors and null call columns). Of calls, or
    results, that repeat an identifier, the smallest by turn and then by the other columns counts; all are counted in
    n_calls and n_results. Rows without conv_id or call_id cannot be linked: each is a row of its own with status
    unlinked. Null or malformed arguments are an error, and written as null.

    ``json`` is canonical: keys in order, no white space, absent parts left out.
    """
    named = " and ".join(f"{c} is not null" for c in _KEY)
    columns = ["turn", "name", "arguments", "depends_on"]
    first = calls.where(named).groupBy(*_KEY).agg(F.min(F.struct(*columns)).alias("m"), F.count("*").alias("n_calls"))
    first = stored(first.select(*_KEY, *(f"m.{c}" for c in columns), "n_calls"), "calls")
    answers = results.where(named).groupBy(*_KEY).agg(F.min(F.struct("turn", "content")).alias("m"), F.count("*").alias("n_results"))
    answers = answers.select(*_KEY, F.col("m.turn").alias("result_turn"), F.col("m.content").alias("content"), "n_results")
    both = first.join(answers, _KEY, "full").join(ordered(first), _KEY, "left")
    status = F.when(F.col("n_calls").isNull(), "orphan").when(F.col("n_results").isNull(), "unanswered").otherwise("answered")
    error = lambda df: (F.col("error") if "error" in df.columns else F.lit(None)).cast("string").alias("error")
    one = F.lit(1).cast("long")
    loose = calls.where(f"not ({named})").select(*_KEY, *columns, error(calls), one.alias("n_calls"))
    loose = loose.unionByName(
        results.where(f"not ({named})").select(*_KEY, F.col("turn").alias("result_turn"), "content", error(results), one.alias("n_results")),
        allowMissingColumns=True,
    )
    rows = both.withColumn("status", status).unionByName(loose.withColumn("status", F.lit("unlinked")), allowMissingColumns=True)
    rows = rows.withColumn("parsed", F.expr("case when try_variant_get(try_parse_json(arguments), '$', 'map<string, variant>') is not null then try_parse_json(arguments) end"))
    nothing = F.lit(0).cast("long")
    whole = F.struct(
        F.col("parsed").alias("arguments"), F.col("call_id").alias("id"), "name", F.col("content").alias("result"), "result_turn", "turn"
    )
    return rows.select(
        *_KEY,
        "turn",
        "name",
        "status",
        "result_turn",
        "at",
        "step",
        F.coalesce("n_unresolved", nothing).alias("n_unresolved"),
        F.coalesce("cyclic", F.lit(False)).alias("cyclic"),
        F.coalesce("error", F.array_join(F.when(F.col("n_calls").isNull(), F.array().cast("array<string>")).otherwise(_errors(schemas)), "; ")).alias("errors"),
        F.coalesce("n_calls", nothing).alias("n_calls"),
        F.coalesce("n_results", nothing).alias("n_results"),
        F.to_json(whole).alias("json"),
    )


def exchanges(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations, to which those that messages hold are added: a user's turn calls the tool
    "answer", a system's "configure"; an assistant's turn is the result of the turn before. A user's turn depends on the
    user's turn before. A message of no role, or of another one than user, system, assistant and tool, is a result without an identifier,
    with an error."""
    identifier = lambda turn: F.concat_ws(":", "conv_id", turn)
    arguments = F.when(F.col("role") == "user", F.to_json(F.struct(F.col("text").alias("prompt"), "turn"))).otherwise(
        F.to_json(F.struct(F.col("text").alias("instructions")))
    )
    asked = messages.where("role in ('user', 'system')").select(
        "conv_id",
        "turn",
        F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), identifier(F.col("turn"))).alias("call_id"),
        F.when(F.col("role") == "user", "answer").otherwise("configure").alias("name"),
        arguments.alias("arguments"),
        F.when((F.col("role") == "user") & (F.col("turn") >= 2), F.array(identifier(F.col("turn") - 2))).otherwise(F.array().cast("array<string>")).alias("depends_on"),
    )
    given = messages.where("role = 'assistant'").select(
        "conv_id", "turn", F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), identifier(F.col("turn") - 1)).alias("call_id"), F.col("text").alias("content")
    )
    odd = messages.where("role is null or role not in ('user', 'system', 'assistant', 'tool')")
    odd = odd.select("conv_id", "turn", F.lit(None).cast("string").alias("call_id"), F.col("text").alias("content"), F.concat(F.lit("no such role: "), F.coalesce("role", F.lit("null"))).alias("error"))
    calls = asked.unionByName(calls_in(messages), allowMissingColumns=True)
    return calls, given.unionByName(results_in(messages), allowMissingColumns=True).unionByName(odd)
