"""Chat formatting: linking of tool calls and their results.

Calls and results are hash-joined by (chat, identifier), ordered topologically by the call whose
result a call needs, checked against the schema of their tool, and serialised as canonical JSON
(keys in order inside the arguments too, no blanks). DataFrame functions only.

The order comes from pointer doubling: each round doubles the distance to the ancestor a call
knows, so chains of any length need a logarithmic number of rounds; every round is written once.

Defined cases: a call without result has ``result`` null and status ``open``; of several results
with one identifier the first by turn (then text) counts; a repeated call identifier counts once,
first by turn, tool and arguments; results without call and rows with null chat or identifier are left out; a
needed call that is unknown counts as none; calls on a cycle have a null depth and status
``cycle``; arguments that are null, no JSON object, repeat a key or do not fit, and calls of
unknown tools, give ``invalid``; arguments that are no JSON are passed on as they are; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

#: Beyond so many doublings a chain would have more calls than a table can hold.
MAX_ROUNDS = 48


@dataclass(frozen=True)
class Field:
    """One argument of a tool: its type, whether it must be there, and bounds on its value."""

    type: str
    required: bool = True
    max_length: int | None = None
    least: float | None = None


#: What a variant calls the values that each type of argument takes.
_TAKES = {
    "string": "STRING",
    "bigint": "BIGINT",
    "double": r"BIGINT|DOUBLE|FLOAT|DECIMAL\(.*\)",
    "boolean": "BOOLEAN",
    "array": "ARRAY<.*>",
    "object": "OBJECT<.*>",
}


def canonical(arguments: Column) -> Column:
    """The same JSON with the keys of every object in order and without blanks. Text that is no
    JSON, or repeats a key, stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(arguments)), arguments)


def validated(arguments: Column, schema: dict[str, str | Field]) -> Column:
    """Are the JSON arguments an object that has all required fields of the schema and no others,
    each of its type and inside its bounds? A type by itself stands for a required field."""
    fields = {name: f if isinstance(f, Field) else Field(f) for name, f in sorted(schema.items())}
    value, names = F.try_parse_json(arguments), F.json_object_keys(arguments)
    text = lambda found: F.array(*[F.lit(n) for n in found]).cast("array<string>")
    required = [name for name, f in fields.items() if f.required]
    fits = (
        value.isNotNull() & (F.size(F.array_except(names, text(fields))) == 0) & (F.size(F.array_except(text(required), names)) == 0)
    )
    for name, f in fields.items():
        path = f"$['{name}']"
        good = F.schema_of_variant(F.try_variant_get(value, path, "variant")).rlike(f"^({_TAKES[f.type]})$")
        if f.max_length is not None:
            good = good & (F.length(F.try_variant_get(value, path, "string")) <= f.max_length)
        if f.least is not None:
            good = good & (F.try_variant_get(value, path, "double") >= f.least)
        fits = fits & F.when(F.array_contains(names, name), F.coalesce(good, F.lit(False))).otherwise(True)
    return F.coalesce(fits, F.lit(False))


def _first(df: DataFrame, *columns: str) -> DataFrame:
    """The least row of each identifier, by an aggregate that is combined before the shuffle."""
    least = df.groupBy("conv_id", "call_id").agg(F.min(F.struct(*columns)).alias("_least"))
    return least.select("conv_id", "call_id", "_least.*")


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth): number of calls that must come before; null on a cycle."""
    known = calls.select("conv_id", F.col("call_id").alias("needs"), F.lit(True).alias("_known"))
    state = stored(
        calls.select("conv_id", "call_id", "needs").join(known, ["conv_id", "needs"], "left").select(
            "conv_id", "call_id", F.when(F.col("_known"), F.col("needs")).alias("above"),
            F.when(F.col("_known"), 1).otherwise(0).cast("long").alias("depth"),
        ),
        "depths",
    )
    total = state.count()
    rounds = 0
    while rounds < MAX_ROUNDS and (1 << rounds) <= 2 * total and not state.where("above is not null").isEmpty():
        up = state.select("conv_id", F.col("call_id").alias("above"), F.col("above").alias("_next"), F.col("depth").alias("_more"))
        state = stored(
            state.join(up, ["conv_id", "above"], "left").select(
                "conv_id", "call_id", F.col("_next").alias("above"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth")
            ),
            "depths",
        )
        rounds += 1
    return state.select("conv_id", "call_id", F.when(F.col("above").isNull(), F.col("depth")).alias("depth"))


def linked(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, str | Field]]) -> DataFrame:
    """Calls (conv_id, call_id, turn, tool, arguments, needs) with their results (conv_id,
    call_id, turn, text): conv_id, call_id, turn, depth, valid, status,
    json. Ordered by (depth, turn, call_id), every call comes after those it needs."""
    calls = _first(calls.where("conv_id is not null and call_id is not null"), "turn", "tool", "arguments", "needs")
    given = _first(results.where("conv_id is not null and call_id is not null"), "turn", "text").select(
        "conv_id", "call_id", F.col("turn").alias("_result_turn"), F.col("text").alias("_result"), F.lit(True).alias("_answered")
    )
    calls = stored(calls.join(given.hint("shuffle_hash"), ["conv_id", "call_id"], "left"), "calls")
    fits = F.lit(False)
    for tool, schema in schemas.items():
        fits = F.when(F.col("tool") == tool, validated(F.col("arguments"), schema)).otherwise(fits)
    status = (
        F.when(F.col("depth").isNull(), "cycle").when(~F.col("valid"), "invalid").when(F.col("_answered").isNull(), "open").otherwise("linked")
    )
    message = F.to_json(
        F.struct(canonical(F.col("arguments")).alias("arguments"), F.col("call_id"), F.col("_result").alias("result"), F.col("tool")), {"ignoreNullFields": "false"}
    )
    return (
        calls.join(depths(calls), ["conv_id", "call_id"])
        .withColumn("valid", fits)
        .select("conv_id", "call_id", "turn", "depth", "valid", status.alias("status"), message.alias("json"))
    )


def calls_of(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results that plain turns stand for. A system turn asks the tool ``configure``, a
    user turn the tool ``respond``; the assistant turn after it is its result. A user turn needs
    the call two turns before, the one of turn 1 that of turn 0. Turns of other roles, or without
    role or turn, ask nothing; a null text becomes an argument that is missing."""
    name = lambda turn: F.concat(F.lit("call-"), turn.cast("string"))
    is_user = F.col("role") == "user"
    prompt = F.to_json(F.struct(F.col("text").alias("prompt"), F.length("text").cast("long").alias("chars")))
    rules = F.to_json(F.struct(F.col("text").alias("rules")))
    asked = turns.where("role in ('user', 'system')").select(
        "conv_id", name(F.col("turn")).alias("call_id"), "turn",
        F.when(is_user, "respond").otherwise("configure").alias("tool"),
        F.when(is_user, prompt).otherwise(rules).alias("arguments"),
        F.when(is_user, name(F.when(F.col("turn") == 1, F.lit(0)).otherwise(F.col("turn") - 2))).alias("needs"),
    )
    given = turns.where("role = 'assistant'").select("conv_id", name(F.col("turn") - 1).alias("call_id"), "turn", "text")
    return asked, given


#: Tools that the turns call, with the fields of their arguments.
TOOLS = {
    "configure": {"rules": Field("string", max_length=300)},
    "respond": {"prompt": Field("string", max_length=256), "chars": Field("bigint", least=1)},
}
