"""Reconciliation report: how many rows, which flags, what was decided and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.functions.exprs import percent
from meterwise.operators.rules import HARD, SOFT, TRIP_RULES, Limits, Rule, any_flag


def tally(flagged: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """One row: rows in, rows with a hard flag, rows with soft flags only, and one count
    per flag. Everything else in the report derives from it without touching rows."""
    return flagged.agg(*tally_columns(rules))


def tally_columns(rules: Sequence[Rule] = TRIP_RULES) -> list[Column]:
    """The aggregates of the tally over flagged rows, which a write can observe."""
    hard = any_flag(rules, HARD)
    return [
        F.count(F.lit(1)).alias("rows_in_raw"),
        F.count_if(hard).alias("rows_hard_flagged"),
        F.count_if(any_flag(rules, SOFT) & ~hard).alias("rows_soft_only_flagged"),
        *[F.count_if(F.col(r.column)).alias(f"n_{r.name}") for r in rules],
    ]


def tally_written(trips: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """The same row from a written table that kept only `validation_flags`: the job
    counts what it published instead of evaluating the rules a second time."""
    names = F.split(F.col("validation_flags"), r"\|")
    marks = {r.column: F.array_contains(names, r.name) for r in rules}
    return tally(trips.select(*[m.alias(c) for c, m in marks.items()]), rules)


def flag_mask(rules: Sequence[Rule] = TRIP_RULES) -> Column:
    """The flags of a row as one integer: bit i is the i-th rule of the registry."""
    bits = [F.col(r.column).cast("int") * (1 << i) for i, r in enumerate(rules)]
    return sum(bits[1:], bits[0]).cast("int")


def mask_counts(flagged: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """(mask, n): rows by the combination of their flags, at most 2 to the number of rules
    whatever the size of the table. Every count of the report and every overlap of flags
    derives from it."""
    return flagged.groupBy(flag_mask(rules).alias("mask")).agg(F.count(F.lit(1)).alias("n"))


def _rows_with(bits: int, without: int = 0, every: bool = False) -> Column:
    """Rows of a mask table with one of the bits, or all, and none of the others."""
    held = F.col("mask").bitwiseAND(bits)
    fits = (held == bits if every else held != 0) & (F.col("mask").bitwiseAND(without) == 0)
    return F.coalesce(F.sum(F.when(fits, F.col("n"))), F.lit(0))


def tally_masks(masks: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """The one-row tally from a table of masks."""
    bits = {s: sum(1 << i for i, r in enumerate(rules) if r.severity == s) for s in (HARD, SOFT)}
    return masks.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in_raw"),
        _rows_with(bits[HARD]).alias("rows_hard_flagged"),
        _rows_with(bits[SOFT], bits[HARD]).alias("rows_soft_only_flagged"),
        *[_rows_with(1 << i).alias(f"n_{r.name}") for i, r in enumerate(rules)],
    )


def flag_overlaps(masks: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """(flag, other, n, only): rows with both flags, for every pair of rules in registry
    order, and rows with these two alone."""
    pairs = [(i, j) for i in range(len(rules)) for j in range(i + 1, len(rules))]
    both = lambda i, j: 1 << i | 1 << j
    totals = masks.agg(*[
        c for i, j in pairs for c in (
            _rows_with(both(i, j), every=True).alias(f"n_{i}_{j}"),
            _rows_with(both(i, j), ((1 << len(rules)) - 1) & ~both(i, j), every=True).alias(f"only_{i}_{j}"),
        )
    ])
    rows = [
        F.struct(F.lit(rules[i].name).alias("flag"), F.lit(rules[j].name).alias("other"),
                 F.col(f"n_{i}_{j}").alias("n"), F.col(f"only_{i}_{j}").alias("only"))
        for i, j in pairs
    ]
    return totals.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def _counts() -> list[Column]:
    raw, hard = F.col("rows_in_raw"), F.col("rows_hard_flagged")
    soft = F.col("rows_soft_only_flagged")
    return [
        raw,
        hard,
        percent(hard, raw).alias("rows_hard_flagged_pct"),
        soft,
        percent(soft, raw).alias("rows_soft_only_flagged_pct"),
        (raw - hard).alias("rows_valid_out"),
        percent(raw - hard, raw).alias("rows_valid_pct"),
    ]


def report_counts(totals: DataFrame) -> DataFrame:
    """Counts that reconcile (hard + valid = raw) and their shares of all rows."""
    return totals.select(*_counts())


def _flag_rows(rules: Sequence[Rule]) -> Column:
    return F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(i).alias("position"),
                    F.lit(r.name).alias("flag"),
                    F.lit(r.severity).alias("severity"),
                    F.col(f"n_{r.name}").alias("n"),
                )
                for i, r in enumerate(rules, 1)
            ]
        )
    )


def flag_counts(totals: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """(flag, n) in registry order; a row with several flags counts in each."""
    return totals.select(_flag_rows(rules).alias("f")).select("f.flag", "f.n")


def flag_summary(totals: DataFrame, rules: Sequence[Rule] = TRIP_RULES) -> DataFrame:
    """Flags that fired: severity, count and share of all rows."""
    rows = totals.select("rows_in_raw", _flag_rows(rules).alias("f")).where("f.n > 0")
    share = percent(F.col("f.n"), F.col("rows_in_raw")).alias("pct_of_raw")
    return rows.select("f.flag", "f.severity", "f.n", share)


def annotation_texts(limits: Limits = Limits()) -> list[tuple[str, str | None, str]]:
    """(category, flag whose count is shown, text) of every decision behind the rules.
    `%s` in a text stands for the flag's live count."""
    unknown = " and ".join(str(z) for z in limits.unknown_zones)
    return [
        ("KNOWN", "out_of_month",
         "Monthly files hold some trips picked up in a neighbouring month, because the "
         "publisher cuts batches late. %s rows are marked out_of_month; they leave the "
         "metrics but stay in these counts."),
        ("KNOWN", None,
         "passenger_count may be null: vendors need not fill it. A null is counted in the "
         "profile and breaks no rule."),
        ("KNOWN", "location_unknown",
         f"Zone ids {unknown} are documented placeholders without a lookup entry. They "
         "are marked location_unknown (%s rows), apart from location_invalid, which "
         "means an id nobody documents."),
        ("ASSUMPTION", None,
         f"A trip takes at most {limits.max_minutes:g} minutes. No published limit exists; "
         "longer ones are most likely meters left running."),
        ("ASSUMPTION", None,
         f"A trip covers at most {limits.max_miles:g} miles. No published limit exists; "
         "the metered service area fits well inside it."),
        ("ASSUMPTION", None,
         f"A fare is at most {limits.max_fare:g} dollars: the metered rate over the longest "
         "allowed distance plus tolls stays below. No published limit exists."),
        ("ASSUMPTION", None,
         f"A plausible fare per mile lies in {limits.min_fare_per_mile:g} to "
         f"{limits.max_fare_per_mile:g} dollars. Set from the rate card, not from a "
         "model of the data; recalibrate with more months."),
        ("UNKNOWN", None,
         "Negative fares may be refunds, disputes or corruption; the data dictionary does "
         "not say. All are marked fare_invalid and excluded."),
        ("UNKNOWN", None,
         "Published files may be corrected later. The manifest keeps load time and "
         "SHA-256 of each file, so a silent change shows."),
        ("LIMITATION", None,
         "Trips carry zone ids, no coordinates. Nothing below a zone can be observed."),
        ("LIMITATION", None,
         "tip_amount holds card tips only. Fare consistency therefore uses fare_amount, "
         "not total_amount."),
    ]


def _entries(totals: DataFrame, limits: Limits) -> list[tuple[str, Column]]:
    entries = []
    for category, flag, text in annotation_texts(limits):
        entry = F.lit(text)
        if flag is not None:
            known = f"n_{flag}" in totals.columns
            count = F.col(f"n_{flag}").cast("string") if known else F.lit("?")
            entry = F.format_string(text, count)
        entries.append((category, entry))
    return entries


def rule_annotations(totals: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(position, category, entry) with live counts; `?` for a flag not in the tally."""
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(category).alias("category"),
                 entry.alias("entry"))
        for i, (category, entry) in enumerate(_entries(totals, limits), 1)
    ]
    return totals.select(F.explode(F.array(*rows)).alias("a")).select("a.*")


def _one_json_object(rows: DataFrame, position: str, key: str, json: Column) -> DataFrame:
    """One row `json`: the rows as members of one object, in order of `position`. For
    column- and rule-sized inputs only."""
    # to_json of a one-element array quotes and escapes the key: ["k"] -> "k"
    member = F.concat(
        F.regexp_extract(F.to_json(F.array(F.col(key))), r"^\[(.*)\]$", 1), F.lit(":"), json
    )
    ordered = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), member.alias("m"))))
    return rows.agg(
        F.concat(
            F.lit("{"), F.array_join(F.transform(ordered, lambda m: m["m"]), ","), F.lit("}")
        ).alias("json")
    )


def report_json(
    totals: DataFrame,
    column_profile: DataFrame,
    month: str,
    elapsed_seconds: float | None = None,
    rules: Sequence[Rule] = TRIP_RULES,
    limits: Limits = Limits(),
) -> DataFrame:
    """The whole report as one JSON document in one row (column `value`).
    `column_profile` is the tall profile of `profile.column_profile`."""
    number = {k: F.col(k) for k in ("min", "max", "mean", "median", "std")}
    shared = [F.col("dtype"), F.col("null_count"), F.col("null_pct")]
    described = F.when(
        F.col("min_text").isNotNull(),
        F.to_json(F.struct(*shared, F.col("min_text").alias("min"), F.col("max_text").alias("max"),
                           F.col("value_counts"))),
    ).otherwise(F.to_json(F.struct(*shared, *number.values(), F.col("value_counts"))))
    profile = _one_json_object(column_profile, "position", "column_name", described)
    flags = F.struct(*[F.col(f"n_{r.name}").alias(r.name) for r in rules])
    notes = F.array(
        *[F.struct(F.lit(c).alias("category"), e.alias("entry"))
          for c, e in _entries(totals, limits)]
    )
    head = F.to_json(
        F.struct(
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("run_at"),
            F.lit(month).alias("month"),
            F.lit(elapsed_seconds).cast("double").alias("elapsed_seconds"),
        )
    )
    none = F.lit(None).cast("string")
    # Everything that comes from the tally is read in one select, so its rows are
    # counted once.
    counted = totals.select(
        F.concat(
            F.regexp_replace(head, r"\}$", ""),
            F.lit(',"counts":'), F.to_json(F.struct(*_counts())),
            F.lit(',"flag_counts":'), F.to_json(flags),
        ).alias("front"),
        none.alias("profile"),
        F.to_json(notes).alias("notes"),
    )
    profiled = profile.select(none.alias("front"), F.col("json").alias("profile"), none.alias("notes"))
    return counted.unionByName(profiled).agg(
        F.concat(
            F.max("front"),
            F.lit(',"profile":'), F.max("profile"),
            F.lit(',"known_unknown_assumption_limitation":'), F.max("notes"),
            F.lit("}"),
        ).alias("value")
    )
