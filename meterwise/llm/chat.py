"""Chat formatting: tool calls linked to results, ordered, validated and serialised.

DataFrame functions only. Calls and results are hash-joined by identifier; where an
identifier repeats in a conversation, its n-th call goes with its n-th result, so the join
has one row per call however hot the identifier. Numbers within a conversation come from
a global order cut into ranges, so that no task holds a whole conversation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.llm.common import written


@dataclass(frozen=True)
class Field:
    """A parameter of a tool: its JSON type (`string`, `integer`, `number` or `boolean`)
    and bounds, on the length of strings."""

    kind: str
    required: bool = True
    low: float | None = None
    high: float | None = None


Schemas = dict[str, dict[str, Field]]

KINDS = {
    "string": "^STRING$", "integer": "^BIGINT$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
}


def numbered(rows: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """`rows` with their place, from 0, among the rows of equal `keys` as `name`."""
    ranged = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = written(
        ranged.withColumn("_part", F.spark_partition_id()).withColumn("_nth", place), "numbered"
    )
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per partition.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"))
    indexed = ranged.join(F.broadcast(bases), "_part").withColumn("_index", F.col("_base") + F.col("_nth"))
    firsts = indexed.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min("_index").alias("_first"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    met = indexed.join(firsts, same).withColumn(name, F.col("_index") - F.col("_first"))
    return met.select(*rows.columns, name)


def link(calls: DataFrame, results: DataFrame) -> DataFrame:
    """All calls and results by (conv_id, call_id), with `status`: `linked`, `unanswered`
    (no result) or `orphan` (a result without a call)."""
    ids = ("conv_id", "call_id")
    left = numbered(calls, ids, ("turn",), "_nth_call")
    right = numbered(results.select(*ids, "turn", "content"), ids, ("turn",), "_nth_call").select(
        F.col("conv_id").alias("_conv"), F.col("call_id").alias("_call"), F.col("_nth_call").alias("_nth_result"),
        F.col("turn").alias("result_turn"), "content", F.lit(True).alias("_result"),
    )
    met = left.withColumn("_made", F.lit(True)).hint("shuffle_hash").join(
        right,
        F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("call_id").eqNullSafe(F.col("_call"))
        & (F.col("_nth_call") == F.col("_nth_result")),
        "full_outer",
    )
    status = (
        F.when(F.col("_made").isNull(), "orphan").when(F.col("_result").isNull(), "unanswered").otherwise("linked")
    )
    return met.select(
        F.coalesce("conv_id", "_conv").alias("conv_id"), F.coalesce("call_id", "_call").alias("call_id"),
        *[c for c in calls.columns if c not in ids], "result_turn", "content", status.alias("status"),
    )


def rounds(calls: DataFrame) -> DataFrame:
    """`calls` with `_round`: calls of one round need calls of earlier rounds only. Where
    all calls of a conversation need earlier turns the order of turns will do, and the
    round is 0; calls that wait for each other have none."""
    own = calls.select("conv_id", "call_id", "turn", "depends_on")
    made = own.groupBy("conv_id", "call_id").agg(F.min("turn").alias("need_turn"))
    needs = own.select("conv_id", "call_id", "turn", F.explode("depends_on").alias("need")).join(
        made.select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("need"), "need_turn"),
        ["need"],
    ).where(F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    tangled = written(needs.where("need_turn >= turn").select("conv_id").distinct(), "tangled")
    if tangled.isEmpty():
        return calls.withColumn("_round", F.lit(0))
    inside = lambda df: df.join(
        tangled.withColumnRenamed("conv_id", "_t"), F.col("conv_id").eqNullSafe(F.col("_t")), "left_semi"
    )
    waiting = written(inside(made).select("conv_id", "call_id"), "waiting")
    needs = written(inside(needs).select("conv_id", "call_id", "need").distinct(), "needs")
    done, k = [], 0
    match = lambda a, b: a["conv_id"].eqNullSafe(b["conv_id"]) & (a["need"] == b["call_id"])
    while True:
        open_needs = needs.alias("n").join(
            waiting.alias("w"), F.expr("n.conv_id <=> w.conv_id AND n.need = w.call_id"), "left_semi"
        )
        blocked = open_needs.select("conv_id", "call_id").distinct()
        free = written(
            waiting.alias("w").join(
                blocked.alias("b"), F.expr("w.conv_id <=> b.conv_id AND w.call_id <=> b.call_id"), "left_anti"
            ), "free",
        )
        if free.isEmpty():
            break
        done.append(free.withColumn("_round", F.lit(k)))
        waiting = written(
            waiting.alias("w").join(
                free.alias("f"), F.expr("w.conv_id <=> f.conv_id AND w.call_id <=> f.call_id"), "left_anti"
            ), "waiting",
        )
        k += 1
    found = waiting.withColumn("_round", F.lit(None).cast("int"))
    for part in done:
        found = found.unionByName(part)
    found = found.select(
        F.col("conv_id").alias("_conv"), F.col("call_id").alias("_call"), "_round", F.lit(True).alias("_tangled")
    )
    joined = calls.join(
        found, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("call_id").eqNullSafe(F.col("_call")), "left"
    )
    number = F.when(F.col("_tangled"), F.col("_round")).otherwise(F.lit(0))
    return joined.select(*calls.columns, number.alias("_round"))


def problems(arguments: str, name: str, schemas: Schemas) -> Column:
    """The sorted ways in which a call breaks its tool's schema."""
    parsed = F.try_parse_json(F.col(arguments))
    whole = F.schema_of_variant(parsed)
    checks = [
        F.when(parsed.isNull(), "arguments: not JSON").when(
            ~whole.startswith("OBJECT"), "arguments: no object"
        ),
        F.when(F.col(name).isNull() | ~F.col(name).isin(*schemas), "name: unknown tool"),
    ]
    known = F.array().cast("array<string>")
    for tool, fields in schemas.items():
        mine = (F.col(name) == tool) & whole.startswith("OBJECT")
        known = F.when(F.col(name) == tool, F.array(*map(F.lit, fields))).otherwise(known)
        for field, rule in fields.items():
            value = F.try_variant_get(parsed, f"$.{field}", "variant")
            kind = F.coalesce(F.schema_of_variant(value), F.lit("VOID"))
            size = F.try_variant_get(parsed, f"$.{field}", "string")
            size = F.length(size) if rule.kind == "string" else size.cast("double")
            checks.append(F.when(mine & (kind == "VOID"), f"{field}: missing") if rule.required else F.lit(None).cast("string"))
            right = kind.rlike(KINDS[rule.kind])
            checks.append(F.when(mine & (kind != "VOID") & ~right, f"{field}: no {rule.kind}"))
            if rule.low is not None:
                checks.append(F.when(mine & right & (size < rule.low), f"{field}: below {rule.low:g}"))
            if rule.high is not None:
                checks.append(F.when(mine & right & (size > rule.high), f"{field}: above {rule.high:g}"))
    keys = F.when(whole.startswith("OBJECT"), F.json_object_keys(F.col(arguments)))
    extra = F.transform(F.array_except(keys, known), lambda k: F.concat(k, F.lit(": not in the schema")))
    extra = F.when(F.col(name).isin(*schemas), extra)
    return F.array_sort(F.array_compact(F.concat(F.array(*checks), F.coalesce(extra, F.array().cast("array<string>")))))


def canonical(text: str) -> Column:
    """A JSON text with sorted keys and no white space; null if it is not JSON."""
    return F.to_json(F.try_parse_json(F.col(text)))


def format_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """One row per call of `calls` (conv_id, turn, call_id, name, arguments as JSON text,
    depends_on as identifiers) and per result of `results` (conv_id, turn, call_id,
    content) without a call: (conv_id, call_id, turn, name, position, status, result_turn,
    errors, valid, json).

    `position` numbers the calls of a conversation so that each comes after those it
    depends on; calls that wait for each other get null and the error `depends_on: cycle`,
    and a dependency on no call of the conversation is ignored. `json` is canonical: sorted
    keys, no white space.

    Null identifiers are equal to each other. Null arguments are not JSON, null contents
    null. Repeated identifiers link by turn, ties in any order. Other columns are
    ignored. Empty tables give an empty one.
    """
    needed = calls.select(
        "conv_id", "call_id", "turn", "name", "arguments",
        F.coalesce("depends_on", F.array().cast("array<string>")).alias("depends_on"),
    )
    placed = numbered(rounds(needed), ("conv_id",), ("_round", "turn", "call_id"), "_place")
    tangled = F.col("_round").isNull()
    # Rounds without a number sort first.
    stuck = placed.where(tangled).groupBy(F.col("conv_id").alias("_conv")).agg(F.count(F.lit(1)).alias("_stuck"))
    placed = placed.join(stuck, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    placed = placed.withColumn(
        "position", F.when(~tangled, F.col("_place") - F.coalesce("_stuck", F.lit(0)))
    )
    cycle = F.when(tangled, F.array(F.lit("depends_on: cycle"))).otherwise(F.array().cast("array<string>"))
    checked = placed.withColumn("errors", F.array_sort(F.concat(problems("arguments", "name", schemas), cycle)))
    linked = link(checked.drop("_round", "_place", "_conv", "_stuck", "depends_on"), results)
    quoted = lambda c: F.coalesce(F.to_json(F.to_variant_object(F.struct(F.col(c).alias("v")))), F.lit("{}"))
    inner = lambda c: F.coalesce(F.regexp_extract(quoted(c), r'(?s)^\{"v":(.*)\}$', 1), F.lit("null"))
    text = F.concat(
        F.lit('{"arguments":'), F.coalesce(canonical("arguments"), F.lit("null")),
        F.lit(',"id":'), inner("call_id"), F.lit(',"name":'), inner("name"),
        F.lit(',"result":'), inner("content"), F.lit("}"),
    )
    return linked.select(
        "conv_id", "call_id", "turn", "name", "position", "status", "result_turn", "errors",
        ((F.col("status") == "linked") & (F.size("errors") == 0)).alias("valid"), text.alias("json"),
    )
