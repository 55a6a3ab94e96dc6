"""Exact medians of groups of any size, from mergeable sketches and counts.

Spark's `median` keeps every distinct value of a group in one buffer. Here a family of
groupings, such as zone and hour, borough and hour, and borough, shares its passes:

1. one aggregate by the finest keys makes KLL sketches of all columns; merged, they speak
   for the coarser groupings without another read. A sketch of SKETCH values or fewer
   holds them all, so small groups are done,
2. for the others the sketch names two values close to the middle rank. One aggregate by
   the finest keys counts what lies below, at and between them, for all groupings at once,
   and gathers what lies between, at most about `gather` values per group. The counts say
   where the middle rank is.

Only where more than `gather` values would lie between, a pass makes sketches of these
instead, and another follows: each leaves a few hundredths of the values. So two reads of
the input are enough up to some hundred thousand values a group, three up to tens of
millions. The counts decide, so the result is exact whatever the sketches say; infinities
are ordinary values. Give a table, not a plan that is expensive to repeat.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.operators.joins import same_keys_join
from meterwise.sources.scratch import written

# Values between two brackets of one group that a buffer may hold.
GATHER = 20_000
# Values that a sketch holds before it thins them out: by groups, and of a whole table.
SKETCH, SKETCH_WHOLE = 1024, 4096
# A grid of shares has a cell per so many values, and a bracket MARGIN cells on either side
# of the rank, which is more than a sketch errs by.
CELL, MARGIN = 4, 2
# Added to one half it asks for the next rank of a sketch that holds all its values.
NEXT = 1e-5


@dataclass(frozen=True)
class Median:
    """The median of a column per group of some keys, shown under a name."""

    name: str
    column: str
    keys: tuple[str, ...] = ()


def sketch_columns(columns: Sequence[str]) -> list[Column]:
    """Aggregates `<column>__count` and `<column>__kll` that a table of states may keep."""
    return [
        c for name in columns for c in (
            F.count(_value(name)).alias(f"{name}__count"),
            F.kll_sketch_agg_double(_value(name), F.lit(SKETCH)).alias(f"{name}__kll"),
        )
    ]


def exact_medians(
    df: DataFrame, wanted: Sequence[Median], gather: int | None = None, states: DataFrame | None = None
) -> DataFrame:
    """Interpolated medians in tall form: `name`, all keys that occur, `median`. A key a
    median is not grouped by is null in its rows. Nulls and NaN are skipped, a null key is
    a group, a group without values is absent. `gather` bounds the values of a group that
    one buffer holds; results do not depend on it. `states`, rows with the finest keys and
    the aggregates of `sketch_columns`, any number per group, stand for the first read: `df`
    is then read only where a group has more values than its sketch."""
    keys = list(dict.fromkeys(k for m in wanted for k in m.keys))
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for finest in _finest({m.keys for m in wanted}):
        members = [m for m in wanted if _family(m.keys, [finest]) == finest]
        family = _Family(df, finest, members, GATHER if gather is None else gather, states)
        for by in family.groupings:
            rows = F.explode(F.array(*[
                F.struct(F.lit(m.name).alias("name"), F.col(f"_median{family.columns.index(m.column)}").alias("median"))
                for m in members if m.keys == by
            ])).alias("row")
            shown = [(F.col(f"_k{family.keys.index(k)}") if k in by else F.lit(None)).cast(types[k]).alias(k) for k in keys]
            found = family.medians(by).select(*shown, rows).where(F.col("row.median").isNotNull())
            parts.append(found.select("row.name", *keys, "row.median"))
    return reduce(DataFrame.unionByName, parts)


def _finest(groupings: set[tuple[str, ...]]) -> list[tuple[str, ...]]:
    """The groupings that none of the others refines."""
    return sorted(g for g in groupings if not any(set(g) < set(o) for o in groupings))


def _family(keys: tuple[str, ...], finest: list[tuple[str, ...]]) -> tuple[str, ...] | None:
    return next((f for f in finest if set(keys) <= set(f)), None)


def _value(column: str) -> Column:
    """Adding zero turns -0.0 into 0.0, one value with it."""
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None).cast("double")) + F.lit(0.0)


def _number(value: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if value is None else f"CAST('{value!r}' AS DOUBLE)"


def _aggregated(table: DataFrame, by: Sequence[str], expressions: Sequence[str]) -> DataFrame:
    return table.groupBy(*by).agg(*map(F.expr, expressions))


class _Family:
    """Groupings by subsets of the finest keys, and the state of their medians.

    A state is a table per grouping: its keys `_k*`, and for column i the count `_n`, the
    bracket's ends `_from` and `_to`, values of the group themselves, an estimate of the
    values between them `_in`, and the two middle values `_low`, `_up` once they are known.
    Expressions are written as SQL: a call to the JVM each, whatever their size.
    """

    def __init__(
        self, df: DataFrame, finest: tuple[str, ...], members: Sequence[Median], gather: int,
        states: DataFrame | None,
    ):
        self.columns = list(dict.fromkeys(m.column for m in members))
        self.groupings = list(dict.fromkeys(m.keys for m in members))
        self.keys, self.gather = list(finest), gather
        self.size = SKETCH if finest or states is not None else SKETCH_WHOLE
        self.grid = max(1, self.size // CELL)
        self.wanted = {by: [self.columns.index(m.column) for m in members if m.keys == by] for by in self.groupings}
        self.rows = df.select(
            *[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(self.keys)],
            *[_value(c).alias(f"_x{i}") for i, c in enumerate(self.columns)],
        )
        ids = range(len(self.columns))
        if states is None:
            source, made = self.rows, [(f"count(_x{i})", self.sketch(f"_x{i}")) for i in ids]
        else:
            source = states.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(self.keys)})
            parts = [(f"`{c}__count`", f"`{c}__kll`") for c in self.columns]
            made = [(f"sum({n})", self.joined(n, q)) for n, q in parts]
        sketched = _aggregated(
            source, self.names(finest), [x for i, (n, q) in enumerate(made) for x in (f"{n} AS _n{i}", f"{q} AS _q{i}")]
        )
        self.sketches = written(sketched, "sketches")
        self.states = {by: written(self.first(by), "medians") for by in self.groupings}
        while open_ := self.open():
            self.narrow(open_)

    def names(self, by: Sequence[str]) -> list[str]:
        return [f"_k{self.keys.index(k)}" for k in by]

    def sketch(self, value: str) -> str:
        return f"kll_sketch_agg_double({value}, {self.size})"

    def joined(self, n: str, sketch: str) -> str:
        """One sketch of those that hold values."""
        return f"kll_merge_agg_double(CASE WHEN {n} > 0 THEN {sketch} END, {self.size})"

    def shares(self, sketch: str, n: str) -> str:
        """The values at every share of the grid, and the two middle values."""
        at = [k / self.grid for k in range(self.grid + 1)] + [0.5, 0.5 + NEXT]
        grid = ", ".join(f"{x!r}D" for x in at)
        return f"CASE WHEN {n} > 0 THEN kll_sketch_get_quantile_double({sketch}, array({grid})) END"

    def first(self, by: tuple[str, ...]) -> DataFrame:
        """The state of a grouping from the sketches alone."""
        ids, names = self.wanted[by], self.names(by)
        rolled = _aggregated(self.sketches, names, [
            x for i in ids for x in (f"coalesce(sum(_n{i}), 0L) AS _n{i}", f"{self.joined(f'_n{i}', f'_q{i}')} AS _q{i}")
        ])
        shared = rolled.selectExpr(
            *names, *[f"_n{i}" for i in ids], *[f"{self.shares(f'_q{i}', f'_n{i}')} AS _g{i}" for i in ids]
        )
        out = list(names)
        for i in ids:
            whole = f"_n{i} <= {self.size}"
            low, high = self.around(i, "0", f"_n{i}", f"_g{i}")
            out += [
                f"_n{i}", f"CASE WHEN NOT {whole} THEN {low} END AS _from{i}",
                f"CASE WHEN NOT {whole} THEN {high} END AS _to{i}",
                f"CAST(CASE WHEN {whole} THEN 0 ELSE {self.between(f'_n{i}')} END AS BIGINT) AS _in{i}",
                f"CASE WHEN {whole} THEN get(_g{i}, {self.grid + 1}) END AS _low{i}",
                f"CASE WHEN {whole} THEN get(_g{i}, {self.grid + 2}) END AS _up{i}",
            ]
        return shared.selectExpr(*out)

    def rank(self, i: int, upper: bool) -> str:
        """One of the two middle ranks, from 1."""
        return f"(_n{i} div 2 + 1)" if upper else f"((_n{i} + 1) div 2)"

    def around(self, i: int, before: str, inside: str, grid: str) -> list[str]:
        """The values of the grid on either side of the middle ranks, among `inside` values
        after `before` others."""
        share = lambda upper: f"(({self.rank(i, upper)} - {before}) / greatest({inside}, 1L) * {self.grid})"
        at = [f"floor({share(False)}) - {MARGIN}", f"ceil({share(True)}) + {MARGIN}"]
        return [f"get({grid}, CAST(greatest(0, least({self.grid}, {x})) AS INT))" for x in at]

    def between(self, inside: str) -> str:
        """Values between two ends that `around` finds, at most, but for a sketch that errs."""
        return f"ceil({inside} * {min(1.0, 3 * MARGIN / self.grid)!r}D)"

    def open(self) -> dict[tuple[str, ...], dict[int, bool]]:
        """Of every grouping, the columns whose medians are not all known yet, and whether
        what lies between their brackets may be gathered."""
        found = {}
        for by, state in self.states.items():
            ids = self.wanted[by]
            left = [f"max(CASE WHEN _low{i} IS NULL AND _n{i} > 0 THEN _in{i} END)" for i in ids]
            sizes = _aggregated(state, (), left).first()
            columns = {i: size <= self.gather for i, size in zip(ids, sizes) if size is not None}
            if columns:
                found[by] = columns
        return found

    def narrow(self, open_: dict[tuple[str, ...], dict[int, bool]]) -> None:
        """One read of the input for all that is open."""
        names = self.names(self.keys)
        brackets, aggregates = self.sketches.select(*names), []
        for g, (by, columns) in enumerate(open_.items()):
            ends = [(f"_{e}{i}", f"_{e}{g}_{i}", i) for i in columns for e in ("from", "to")]
            mine = self.states[by].selectExpr(
                *self.names(by), *[f"CASE WHEN _low{i} IS NULL THEN {c} END AS {name}" for c, name, i in ends]
            )
            if by:
                brackets = same_keys_join(brackets, mine, self.names(by))
                at = {name: name for _, name, _ in ends}
            else:
                at = {name: _number(v) for name, v in mine.first().asDict().items()}
            for i, gathered in columns.items():
                x, low, high = f"_x{i}", at[f"_from{g}_{i}"], at[f"_to{g}_{i}"]
                inner = f"CASE WHEN {x} > {low} AND {x} < {high} THEN {x} END"
                held = f"collect_list({inner})" if gathered else self.sketch(inner)
                aggregates += [
                    f"count_if({x} < {low}) AS _below{g}_{i}", f"count_if({x} = {low}) AS _at{g}_{i}",
                    f"count_if({x} = {high} AND {high} > {low}) AS _end{g}_{i}",
                    f"count({inner}) AS _inner{g}_{i}", f"{held} AS _held{g}_{i}",
                ]
        # Written, a row per group is known to be small; as joins of joins it would seem larger
        # than the rows, which Spark would broadcast instead.
        joined = same_keys_join(self.rows, written(brackets, "brackets"), names) if names else self.rows
        counted = written(_aggregated(joined, names, aggregates), "counted")
        for g, (by, columns) in enumerate(open_.items()):
            self.states[by] = written(self.closer(counted, g, by, columns), "medians")

    def closer(self, counted: DataFrame, g: int, by: tuple[str, ...], columns: dict[int, bool]) -> DataFrame:
        """The state of a grouping after the counts."""
        names, state = self.names(by), self.states[by]
        rolled = []
        for i, gathered in columns.items():
            held = f"_held{g}_{i}"
            rolled += [f"sum(_{c}{g}_{i}) AS _{c}{i}" for c in ("below", "at", "end", "inner")]
            whole = f"sort_array(flatten(collect_list({held})))" if gathered else self.joined(f"_inner{g}_{i}", held)
            rolled.append(f"{whole} AS _held{i}")
        counts = _aggregated(counted, names, rolled).selectExpr(*names, *[
            x for i, gathered in columns.items() for x in (
                *[f"_{c}{i}" for c in ("below", "at", "end", "inner")],
                f"{f'_held{i}' if gathered else self.shares(f'_held{i}', f'_inner{i}')} AS _held{i}",
            )
        ])
        if by:
            both = same_keys_join(state, counts, names)
        else:
            whole = [c for c in state.columns if c.startswith(("_n", "_in"))]
            row = state.first().asDict()
            both = counts.selectExpr("*", *[
                f"{f'{row[c]}L' if c in whole else _number(row[c])} AS {c}" for c in state.columns
            ])
        out = list(names)
        for i in self.wanted[by]:
            fields = [f"_{c}{i}" for c in ("n", "from", "to", "in", "low", "up")]
            out += self.settled(i, columns[i]) if i in columns else fields
        return both.selectExpr(*out)

    def settled(self, i: int, gathered: bool) -> list[str]:
        low, high, held, inside = f"_from{i}", f"_to{i}", f"_held{i}", f"_in{i}"
        to_low = f"(_below{i} + _at{i})"
        to_inner = f"({to_low} + _inner{i})"
        to_high = f"({to_inner} + _end{i})"
        first, second = self.rank(i, False), self.rank(i, True)
        known = f"(_low{i} IS NOT NULL OR _n{i} = 0)"
        under, over = f"{first} <= _below{i}", f"{second} > {to_high}"

        def middle(k: str) -> str:
            """The value of a rank that lies from `low` to `high`, if it is known."""
            inner = f"get({held}, CAST({k} - {to_low} - 1 AS INT))" if gathered else _number(None)
            return f"CASE WHEN {k} <= {to_low} THEN {low} WHEN {k} <= {to_inner} THEN {inner} ELSE {high} END"

        found = [middle(first), middle(second)]
        done = f"NOT {under} AND NOT {over} AND {found[0]} IS NOT NULL AND {found[1]} IS NOT NULL"
        ends = [low, high]
        if not gathered:
            # A rank at an end keeps it; the others move to the grid around them.
            near = self.around(i, to_low, f"_inner{i}", held)
            ends = [f"CASE WHEN {first} <= {to_low} THEN {low} ELSE {near[0]} END",
                    f"CASE WHEN {second} > {to_inner} THEN {high} ELSE {near[1]} END"]
            inside = self.between(f"_inner{i}")
        moved = {
            "from": f"CASE WHEN {under} THEN double('-Infinity') WHEN {over} THEN {high} ELSE {ends[0]} END",
            "to": f"CASE WHEN {under} THEN {low} WHEN {over} THEN double('Infinity') ELSE {ends[1]} END",
            "in": f"CAST(CASE WHEN {under} THEN _below{i} WHEN {over} THEN _n{i} - {to_high} ELSE {inside} END AS BIGINT)",
            "low": f"CASE WHEN {done} THEN {found[0]} END", "up": f"CASE WHEN {done} THEN {found[1]} END",
        }
        kept = [f"CASE WHEN {known} THEN _{c}{i} ELSE {new} END AS _{c}{i}" for c, new in moved.items()]
        return [f"_n{i}", *kept]

    def medians(self, by: tuple[str, ...]) -> DataFrame:
        middle = lambda i: f"CASE WHEN _low{i} = _up{i} THEN _low{i} ELSE (_low{i} + _up{i}) / 2 END AS _median{i}"
        return self.states[by].selectExpr(*self.names(by), *map(middle, self.wanted[by]))
