"""Chat formatting: tool calls linked with their results, ordered, validated and serialised."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.session import materialise

_KINDS = {
    "string": lambda v: isinstance(v, str),
    "integer": lambda v: isinstance(v, int) and not isinstance(v, bool),
    "number": lambda v: isinstance(v, (int, float)) and not isinstance(v, bool),
    "boolean": lambda v: isinstance(v, bool),
    "object": lambda v: isinstance(v, dict),
    "array": lambda v: isinstance(v, list),
    "null": lambda v: v is None,
}
FORMATTED = T.StructType([T.StructField("errors", T.StringType()), T.StructField("json", T.StringType())])


def canonical(value) -> str:
    """JSON with sorted keys, no spaces and plain characters; lone surrogates become '?'."""
    text = json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
    return text.encode("utf-8", "replace").decode("utf-8")


def argument_errors(arguments, schema: Mapping | None) -> list[str]:
    """What a tool's schema says against its arguments, in the order of the argument names."""
    if schema is None:
        return ["unknown tool"]
    if not isinstance(arguments, dict):
        return ["arguments are no object"]
    known = schema.get("properties", {})
    errors = []
    for name in sorted({*known, *arguments, *schema.get("required", ())}):
        if name not in arguments:
            if name in schema.get("required", ()):
                errors.append(f"{name} is missing")
            continue
        if name not in known:
            if not schema.get("additionalProperties", True):
                errors.append(f"{name} is not known")
            continue
        rule, value = known[name], arguments[name]
        if "type" in rule and not _KINDS[rule["type"]](value):
            errors.append(f"{name} is no {rule['type']}")
        elif "enum" in rule and value not in rule["enum"]:
            errors.append(f"{name} is not allowed")
        elif "minimum" in rule and value < rule["minimum"]:
            errors.append(f"{name} is below {rule['minimum']}")
        elif "maximum" in rule and value > rule["maximum"]:
            errors.append(f"{name} is above {rule['maximum']}")
        elif "maxLength" in rule and len(value) > rule["maxLength"]:
            errors.append(f"{name} is longer than {rule['maxLength']}")
    return errors


def _pairs(pairs):
    named = dict(pairs)
    if len(named) < len(pairs):
        raise ValueError("a key is given twice")
    return named


def _no_constant(name):
    raise ValueError(f"{name} is no JSON")


def format_call(call: dict, schemas: Mapping) -> tuple[str, str]:
    """Errors, joined by '; ', and the canonical message; arguments that are no JSON stay text."""
    arguments = call["arguments"]
    try:
        arguments = json.loads(arguments, object_pairs_hook=_pairs, parse_constant=_no_constant)
        message = canonical(call | {"arguments": arguments})
        errors = argument_errors(arguments, schemas.get(call["tool"]))
    except (TypeError, ValueError, RecursionError):
        message, errors = canonical(call), ["arguments are no JSON"]
    return "; ".join(errors), message


def _formatted(schemas: Mapping, *columns: Column) -> Column:
    def work(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for parts in batches:
            rows = zip(*(p.to_pylist() for p in parts))
            names = ("after", "arguments", "id", "result", "tool")
            out = [format_call(dict(zip(names, row)), schemas) for row in rows]
            arrays = [pa.array([x[k] for x in out], pa.string()) for k in range(2)]
            yield pa.StructArray.from_arrays(arrays, FORMATTED.names)

    return F.arrow_udf(work, FORMATTED)(*columns)


def _hashed(side: DataFrame) -> DataFrame:
    """The side of a join that is hashed, partition by partition."""
    return side.hint("shuffle_hash")


def levels(nodes: DataFrame) -> DataFrame:
    """``conversation, call_id, level``: how many calls come before each along ``after``.

    Pointers are doubled: each round a call takes over what the call it points to points to, so a
    chain of n calls takes log2(n) joins. A round that settles no call more leaves only calls that
    lead into a circle; their level is null. What is not among the calls counts as no call.
    """
    keys = ["conversation", "call_id"]
    there = nodes.select("conversation", F.col("call_id").alias("after"))
    state = nodes.join(_hashed(there.withColumn("_there", F.lit(True))), ["conversation", "after"], "left").select(
        *keys,
        F.when(F.col("_there"), F.col("after")).alias("to"),
        F.when(F.col("_there"), 1).otherwise(0).cast("long").alias("level"),
    )
    open_before = None
    while True:
        state = materialise(state, "levels")
        still_open = state.where("to is not null").count()
        if not still_open or still_open == open_before:
            return state.select(*keys, F.when(F.col("to").isNull(), F.col("level")).alias("level"))
        open_before = still_open
        beyond = state.select("conversation", F.col("call_id").alias("to"), F.col("to").alias("next"), F.col("level").alias("more"))
        state = state.join(_hashed(beyond), ["conversation", "to"], "left").select(
            *keys, F.col("next").alias("to"), (F.col("level") + F.coalesce("more", F.lit(0))).alias("level")
        )


def link_calls(calls: DataFrame, results: DataFrame, schemas: Mapping, every_result: bool = False) -> DataFrame:
    """One row per call, and per result without a call, with its message as canonical JSON.

    ``calls``: conversation, call_id, after (the call it builds on, or null), seq, tool, arguments
    (JSON text). ``results``: conversation, call_id, seq, result. Added: ``level`` (the calls before it;
    order by conversation, level, seq, call_id for a topological order), ``status`` (linked,
    no_result, no_call, no_id, cycle), ``errors`` (from ``schemas``, a JSON-schema subset by tool; empty if
    valid) and ``json``.

    Calls and results meet by hash joins on the identifiers. Of several results of a call the first by seq
    counts, then by text; of calls that share an identifier the first by seq says what it comes after, and
    each is kept as a row. The further results are left out, or with ``every_result`` kept as well: each
    in one more row of the first call of its identifier, by seq, after, tool and arguments, with that
    result in its message, or in one more row without a call. A null conversation or identifier links
    with nothing. A conversation is never gathered: it is the ordered concatenation of its rows, however long. Other columns are not used;
    empty tables give empty tables.
    """
    keys = ["conversation", "call_id"]
    calls = calls.select(*keys, "after", "seq", "tool", "arguments")
    named = F.col("conversation").isNotNull() & F.col("call_id").isNotNull()
    answers = results.select(*keys, F.struct("seq", "result").alias("answer")).where(named)
    if every_result:
        # Equal results count one by one; a fixed copy, so that all passes see the same ones.
        answers = materialise(answers.groupBy(*keys, "answer").agg(F.count(F.lit(1)).alias("times")), "results")
    given = answers
    answers = answers.groupBy(*keys).agg(F.min("answer").alias("answer"))
    nodes = calls.where(named).groupBy(*keys).agg(F.min(F.struct("seq", "after")).alias("first"))
    nodes = materialise(nodes.select(*keys, F.col("first.after").alias("after")), "calls")
    ordered = levels(nodes).withColumn("found", F.lit(True))
    # Hash joins on the identifiers; the hashed side has one row for each.
    linked = nodes.select(*keys).join(_hashed(ordered), keys).join(_hashed(answers), keys, "left")
    rows = calls.join(_hashed(linked), keys, "left").withColumn(
        "status",
        F.when(~named, "no_id")
        .when(F.col("level").isNull(), "cycle")
        .when(F.col("answer").isNull(), "no_result")
        .otherwise("linked"),
    )
    alone = answers.join(_hashed(nodes.select(*keys)), keys, "left_anti")
    if every_result:
        # The first result of an identifier has its rows already, so it stands here once less.
        further = given.join(_hashed(answers.withColumnRenamed("answer", "least")), keys)
        more = (F.col("times") - F.col("answer").eqNullSafe(F.col("least")).cast("long")).cast("int")
        further = further.select(*keys, "answer", F.explode(F.array_repeat(F.lit(0), more)).alias("_")).drop("_")
        unit = F.struct("seq", "after", "tool", "arguments")
        leading = calls.where(named).groupBy(*keys).agg(F.min(unit).alias("call"))
        leading = leading.select(*keys, "call.*").join(_hashed(ordered), keys)
        status = F.when(F.col("level").isNull(), "cycle").otherwise("linked")
        rows = rows.unionByName(further.join(_hashed(leading), keys).withColumn("status", status))
        alone = alone.unionByName(further.join(_hashed(nodes.select(*keys)), keys, "left_anti"))
    lonely = alone.select(
        *keys, F.lit(None).cast("string").alias("after"), F.col("answer.seq").alias("seq"),
        F.lit(None).cast("string").alias("tool"), F.lit(None).cast("string").alias("arguments"),
        F.lit(None).cast("long").alias("level"), "answer", F.lit("no_call").alias("status"),
    )
    unnamed = results.where(~named).select(
        *keys, F.lit(None).cast("string").alias("after"), "seq", F.lit(None).cast("string").alias("tool"),
        F.lit(None).cast("string").alias("arguments"), F.lit(None).cast("long").alias("level"),
        F.struct("seq", "result").alias("answer"), F.lit("no_id").alias("status"),
    )
    both = rows.drop("found").unionByName(lonely).unionByName(unnamed)
    made = _formatted(schemas, F.col("after"), F.col("arguments"), F.col("call_id"), F.col("answer.result"), F.col("tool"))
    both = both.withColumn("made", made)
    a_call = F.col("status") != "no_call"
    return both.select(
        *keys, "seq", "level", "status",
        F.when(a_call & F.col("tool").isNotNull(), F.col("made.errors")).otherwise("").alias("errors"),
        F.col("made.json").alias("json"),
    )


def messages(turns: DataFrame) -> DataFrame:
    """Turns that are no calls and no results, as rows like those of ``link_calls`` with the status ``message``.

    ``turns``: conversation, call_id, seq, result (the text, as the message's result). Nulls stay null,
    repeated rows are kept, other columns are not used.
    """
    none = F.lit(None).cast("string")
    made = _formatted({}, none, none, F.col("call_id"), F.col("result"), none)
    return turns.select(
        "conversation", "call_id", "seq", F.lit(None).cast("long").alias("level"), F.lit("message").alias("status"),
        F.lit("").alias("errors"), made["json"].alias("json"),
    )
