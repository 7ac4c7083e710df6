"""Stored rollups of an additive table, and the choice of which to store.

A request of the metric layer needs some columns: what it groups and filters by,
and what its metrics look at.  Any rollup on a superset of those columns answers
it, since every measure is a sum.  The supersets form a lattice; ``choose`` takes
from it, greedily, the rollup that saves the requests most rows for the rows it
costs (Harinarayan, Rajaraman and Ullman, 1996), as long as the rollups together
stay below a share of the table.  Sizes are estimated for all candidates in one
pass.  ``table`` answers a request from the smallest stored rollup that covers
it, else from the table itself: the caller's query is the same on either.

Rollups are built from each other, the largest first, so the table is read once
for those that nothing else covers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveywave.plans.store import TableStore

Columns = frozenset[str]


class Rollups:
    """``measures``: name → the row's share of it, which is summed."""

    def __init__(self, base: DataFrame, measures: dict[str, Callable[[], Column]]):
        self.base, self.measures = base, measures
        self.stored: dict[Columns, tuple[int, DataFrame]] = {}

    # -- choice ---------------------------------------------------------------
    def candidates(self, requests: Iterable[Sequence[str]]) -> list[Columns]:
        """The requests' column sets and the unions of any two."""
        own = sorted({frozenset(r) for r in requests}, key=sorted)
        unions = {a | b for a, b in combinations(own, 2)}
        return own + sorted(unions - set(own), key=sorted)

    def sizes(self, candidates: Sequence[Columns]) -> tuple[int, list[int]]:
        """Rows of the table and (estimated) groups of each candidate, in one pass."""
        groups = [F.approx_count_distinct(F.struct(*sorted(c)), 0.02) if c else F.lit(1) for c in candidates]
        row = self.base.agg(F.count(F.lit(1)), *groups).first()
        return row[0], [max(1, min(n, row[0])) for n in row[1:]]

    def choose(self, requests: Sequence[Sequence[str]], share: float = 0.2) -> list[Columns]:
        """The rollups to store for requests that are equally frequent."""
        candidates = self.candidates(requests)
        rows, sizes = self.sizes(candidates)
        wanted = [frozenset(r) for r in requests]
        cost = [rows] * len(wanted)
        chosen: list[Columns] = []
        room = share * rows
        while True:
            best, gain = None, 0.0
            for k, c in enumerate(candidates):
                if c in chosen or sizes[k] > room:
                    continue
                saved = sum(max(0, cost[i] - sizes[k]) for i, w in enumerate(wanted) if w <= c)
                if saved / sizes[k] > gain:
                    best, gain = k, saved / sizes[k]
            if best is None:
                return chosen
            chosen.append(candidates[best])
            room -= sizes[best]
            cost = [min(cost[i], sizes[best]) if w <= candidates[best] else cost[i] for i, w in enumerate(wanted)]

    # -- storing --------------------------------------------------------------
    def _rows(self) -> DataFrame:
        return self.base.withColumns({name: share() for name, share in self.measures.items()})

    def store(self, root: str, chosen: Sequence[Columns]) -> None:
        """Build and publish the rollups, each from the smallest that covers it."""
        for columns in sorted(chosen, key=lambda c: (-len(c), sorted(c))):
            sums = [F.sum(m).alias(m) for m in self.measures]
            rollup = self.table(columns).groupBy(*sorted(columns)).agg(*sums)
            store = TableStore(self.base.sparkSession, f"{root.rstrip('/')}/by_{'_'.join(sorted(columns)) or 'all'}")
            # few rows: the files a scan opens cost more than what they hold
            store.replace(rollup.coalesce(1) if len(columns) < 8 else rollup, sort=sorted(columns))
            made = store.read()
            self.stored[columns] = (made.count(), made)

    def table(self, columns: Iterable[str]) -> DataFrame:
        """The smallest stored rollup with these columns, else the table with its
        measures.  Either has the columns and every measure."""
        need = frozenset(columns)
        fit = [(n, sorted(c), df) for c, (n, df) in self.stored.items() if need <= c]
        return min(fit, key=lambda x: x[:2])[2] if fit else self._rows()
