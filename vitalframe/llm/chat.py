"""Chat formatting: link tool calls with their results, order them, validate arguments, serialise canonical JSON.

DataFrame functions only. Calls and results meet in a hash join by identifier. A call may name another call whose
result it uses; its place in the topological order is the length of that chain, found by pointer jumping
in logarithmically many rounds. Canonical JSON has sorted keys and no blanks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalframe.sources.scratch import materialise

#: Kinds of a JSON value by the type that a schema names.
KINDS = {
    "string": ("STRING",),
    "integer": ("BIGINT",),
    "number": ("BIGINT", "DECIMAL", "DOUBLE"),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
}

#: name -> field -> (type, required, least): `least` bounds a number, or the length of a string.
Schemas = dict[str, dict[str, tuple[str, bool, int | None]]]


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and no blanks; null if it isn't JSON."""
    return F.to_json(F.try_parse_json(json))


def argument_errors(name: Column, json: Column, schemas: Schemas) -> Column:
    """Sorted complaints about a call's arguments; empty if they fit the schema of the tool."""
    parsed = F.try_parse_json(json)
    per_tool = F.when(parsed.isNull(), F.array(F.lit("arguments: not JSON")))
    per_tool = per_tool.when(~F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), F.array(F.lit("arguments: not an object")))
    for tool, fields in schemas.items():
        checks = []
        for field, (kind, required, least) in fields.items():
            value = F.variant_get(parsed, f"$.{field}", "variant")
            found = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
            missing = value.isNull() | (found == "VOID")
            wrong = ~found.isin(*KINDS[kind])
            check = F.when(missing, F.lit(f"{field}: missing") if required else F.lit(None)).when(wrong, F.lit(f"{field}: not {kind}"))
            if least is not None:
                size = F.length(F.try_variant_get(parsed, f"$.{field}", "string")) if kind == "string" else F.try_variant_get(parsed, f"$.{field}", "double")
                check = check.when(size < least, F.lit(f"{field}: below {least}"))
            checks.append(check)
        unknown = F.array_except(F.json_object_keys(json), F.array(*map(F.lit, fields)))
        complaints = F.concat(F.array_compact(F.array(*checks)), F.transform(unknown, lambda k: F.concat(k, F.lit(": unknown"))))
        per_tool = per_tool.when(name == tool, F.array_sort(complaints))
    return per_tool.otherwise(F.array(F.lit("name: unknown")))


def chain_positions(calls: DataFrame) -> DataFrame:
    """(call_id, position) of calls with (call_id, parent): 0 where no call is used, else one more than the one used.

    Each round doubles how far every call has looked along its chain. Calls of a cycle, or behind one, get null.
    """
    links = calls.select("call_id", "parent")
    known = calls.select(F.col("call_id").alias("parent"), F.lit(True).alias("_known"))
    links = links.join(known, "parent", "left").select(
        "call_id", F.when(F.col("_known"), F.col("parent")).alias("to"), F.when(F.col("_known"), 1).otherwise(0).cast("long").alias("steps")
    )
    links = materialise(links, "chains")
    open_, rounds = links.where("to IS NOT NULL").count(), 0
    total = open_
    while open_ and (1 << rounds) <= total:
        ahead = links.select(F.col("call_id").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"))
        links = links.join(ahead, "to", "left").select(
            "call_id", F.col("_to").alias("to"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps")
        )
        links = materialise(links, "chains")
        open_, rounds = links.where("to IS NOT NULL").count(), rounds + 1
    return links.select("call_id", F.when(F.col("to").isNull(), F.col("steps")).alias("position"))


def link_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """Link, order, validate and serialise tool calls.

    ``calls``: (call_id, parent, name, arguments), the arguments as JSON text; ``results``: (call_id, content). Returns one
    row per identifier: (call_id, position, status, errors, json). ``status`` is `ok`, `invalid` (arguments
    don't fit), `cycle`, `unanswered` or `orphan` (a result without a call), the first that applies from the end;
    ``json`` is canonical: {"arguments", "id", "name", "result"}, arguments that aren't JSON as a string.

    Rows with a null identifier are left out. Of several calls or results with one identifier the first in
    the order of their columns counts. A parent that is no call is ignored. Empty tables give an empty one or orphans;
    other columns are ignored.
    """
    one = F.min(F.struct("name", "arguments", "parent"))
    kept = calls.where("call_id IS NOT NULL").groupBy("call_id").agg(one.alias("c")).select("call_id", "c.*", F.lit(True).alias("called"))
    kept = materialise(kept, "calls")
    answers = results.where("call_id IS NOT NULL").groupBy("call_id").agg(F.min("content").alias("result"), F.lit(True).alias("answered"))
    both = kept.join(answers, "call_id", "full").join(chain_positions(kept), "call_id", "left")
    errors = F.when(F.col("called"), argument_errors(F.col("name"), F.col("arguments"), schemas)).otherwise(F.array())
    both = both.withColumn("errors", errors)
    status = (
        F.when(F.col("called").isNull(), "orphan")
        .when(F.col("answered").isNull(), "unanswered")
        .when(F.col("position").isNull(), "cycle")
        .when(F.size("errors") > 0, "invalid")
        .otherwise("ok")
    )
    quoted = lambda c: F.coalesce(F.to_json(F.to_variant_object(F.array(c))), F.lit("[null]"))
    text = lambda c: F.regexp_replace(quoted(c), r"(?s)^\[(.*)\]$", "$1")
    json = F.concat(
        F.lit('{"arguments":'), F.coalesce(canonical(F.col("arguments")), text(F.col("arguments"))),
        F.lit(',"id":'), text(F.col("call_id")),
        F.lit(',"name":'), text(F.col("name")),
        F.lit(',"result":'), text(F.col("result")),
        F.lit("}"),
    )
    return both.select("call_id", "position", status.alias("status"), F.array_join("errors", "; ").alias("errors"), json.alias("json"))
