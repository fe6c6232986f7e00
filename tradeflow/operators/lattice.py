"""Roll-ups over a lattice of levels: every level is aggregated from its
smallest finished parent, the finest from the facts.

A dimension is a chain of columns from fine to coarse (``day``, ``month``,
``year``), of which a level shows one or none. Measures are kept as states
that merge: sums in whole units, counts, least and greatest values. A level's
states are written to the shared folder with their number of rows, so the next
level reads the smallest table that still tells its groups apart. If the
finest level is not asked for, the facts themselves, written once with the
columns that are needed, stand for it: it may have as many groups as facts, and
to group them would shuffle all of them to no end.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import fixed_units, units_value
from .chains import written


@dataclass(frozen=True)
class Dimension:
    """``steps`` maps column names, fine to coarse, to their expression over the column before (the first: over the facts)."""
    name: str
    steps: dict[str, Column]

    def depth(self, column: str | None) -> int:
        return len(self.steps) if column is None else list(self.steps).index(column)


def calendar(name: str, date: Column, steps: Sequence[str] = ("day", "month", "year")) -> Dimension:
    """A date as its day and the first day of its month and year."""
    made = {f"{name}_{s}": F.to_date(date) if s == "day" else F.trunc(F.col(f"{name}_{steps[i - 1]}") if i else F.to_date(date), s)
            for i, s in enumerate(steps)}
    return Dimension(name, made)


def plain(column: str) -> Dimension:
    return Dimension(column, {column: F.col(column)})


def _finer(dims: Sequence[Dimension], a: Sequence[str], b: Sequence[str]) -> bool:
    """Whether groups of level ``b`` are unions of groups of level ``a``."""
    return all(d.depth(_of(d, a)) <= d.depth(_of(d, b)) for d in dims)


def _of(dim: Dimension, level: Sequence[str]) -> str | None:
    shown = [c for c in level if c in dim.steps]
    if len(shown) > 1:
        raise ValueError(f"a level shows one column of {dim.name}, not {shown}")
    return shown[0] if shown else None


class Lattice:
    """``facts`` rolled up to ``levels``; ``sums`` maps a measure to its scale (decimals kept exactly)."""

    def __init__(self, facts: DataFrame, dims: Sequence[Dimension], levels: Sequence[Sequence[str]], sums: dict[str, int]):
        self.dims, self.sums = list(dims), dict(sums)
        self.levels = [tuple(x) for x in levels]
        names = [c for d in self.dims for c in d.steps]
        for level in self.levels:
            if set(level) - set(names):
                raise ValueError(f"unknown columns in level {level}")
        self.names = names
        # The finest level that is finer than all that are asked for.
        base = tuple(c for d in self.dims if (c := min((_of(d, lv) for lv in self.levels), key=d.depth)) is not None)
        self.made: dict[tuple, tuple[DataFrame, int]] = {}
        rows = facts
        for d in self.dims:
            for c, e in d.steps.items():
                rows = rows.withColumn(c, e)
                if c in base:
                    break
        self.base, self.raw = base, base not in self.levels
        self._keep(base, rows.select(*dict.fromkeys([*base, *self.sums])) if self.raw else rows.groupBy(*base).agg(*self._states()))
        for level in sorted(set(self.levels), key=lambda lv: sum(d.depth(_of(d, lv)) for d in self.dims)):
            if level != base:
                self._keep(level, self._from_parent(level))

    def _states(self) -> list[Column]:
        """States of groups of facts."""
        states = [F.count(F.lit(1)).alias("n_facts")] + [F.sum(fixed_units(m, s)).alias(f"{m}_units") for m, s in self.sums.items()]
        return states + [F.min(m).alias(f"{m}_min") for m in self.sums] + [F.max(m).alias(f"{m}_max") for m in self.sums]

    def _keep(self, level: tuple, states: DataFrame) -> None:
        kept = written(states, "lattice")
        self.made[level] = (kept, kept.count())  # from the files' footers

    def parent_of(self, level: tuple) -> tuple:
        """The smallest finished level that ``level`` can be made of."""
        return min((lv for lv in self.made if lv != level and _finer(self.dims, lv, level)), key=lambda lv: (self.made[lv][1], lv))

    def _from_parent(self, level: tuple) -> DataFrame:
        parent = self.parent_of(level)
        rows = self.made[parent][0]
        for d in self.dims:
            have, want = _of(d, parent), _of(d, level)
            if want is not None and want != have:
                steps = list(d.steps)
                for c in steps[steps.index(have) + 1:steps.index(want) + 1]:
                    rows = rows.withColumn(c, d.steps[c])
        merge = [F.sum("n_facts").alias("n_facts")] + [F.sum(f"{m}_units").alias(f"{m}_units") for m in self.sums]
        merge += [F.min(f"{m}_min").alias(f"{m}_min") for m in self.sums] + [F.max(f"{m}_max").alias(f"{m}_max") for m in self.sums]
        states = rows.groupBy(*level).agg(*(self._states() if self.raw and parent == self.base else merge))
        return states if level else states.where("n_facts > 0")  # no facts: no total, as GROUP BY has it

    def level(self, level: Sequence[str]) -> DataFrame:
        """One level: its columns (null where rolled up), measures, and its name."""
        states, _ = self.made[tuple(level)]
        shown = [F.col(c) if c in level else F.lit(None).alias(c) for c in self.names]
        values = [units_value(f"{m}_units", s).alias(m) for m, s in self.sums.items()]
        rest = [F.col(f"{m}_{x}") for m in self.sums for x in ("min", "max")]
        return states.select(F.lit(",".join(level) or "total").alias("level"), *shown, "n_facts", *values, *rest)

    def all_levels(self) -> DataFrame:
        out = None
        for level in self.levels:
            one = self.level(level)
            out = one if out is None else out.unionByName(one)
        return out
