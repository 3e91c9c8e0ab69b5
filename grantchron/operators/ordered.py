"""Neighbour and running values along each key's rows, also when one key is huge.

Ordinary keys use a plain window: one shuffle by key. A key with more rows than a task
should sort is cut into ranges of its order by a range shuffle; the window then runs per
range, and the few values that cross a range edge are linked through one small row per
(key, range).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from grantchron.session import estimated_bytes, hot_key_rows, materialize, small_input_bytes

_RANGE = "__range"
# Where more ranges than this would be needed, each may hold more rows.
MAX_RANGES = 20_000
# As a limit: the caller knows that no key is hot, and none is looked for.
NO_HOT_KEYS = float("inf")


def same(left: DataFrame, right: DataFrame, names) -> Column:
    """Equality that also matches NULL to NULL, as a window partition does."""
    return reduce(lambda a, b: a & b, [left[n].eqNullSafe(right[n]) for n in names])


@dataclass(frozen=True)
class HotKeys:
    keys: DataFrame
    n_keys: int
    n_rows: int
    limit: int

    @property
    def n_ranges(self) -> int:
        return max(2, -(-2 * self.n_rows // self.limit))


def find_hot_keys(df: DataFrame, key, limit: float | None = None) -> HotKeys | None:
    """Keys with more rows than `limit`, which rises with the data: at most MAX_RANGES / 2."""
    spark = df.sparkSession
    if limit == NO_HOT_KEYS:
        return None
    if limit is None:
        if estimated_bytes(df) < small_input_bytes(spark):
            return None
        limit = hot_key_rows(spark)
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))

    def above(least: int):
        return counts.filter(F.col("__n") > least).agg(F.count(F.lit(1)), F.sum("__n")).first()

    n_keys, n_rows = above(limit)
    if n_keys and 2 * n_rows > MAX_RANGES * limit:
        limit = -(-2 * n_rows // MAX_RANGES)
        n_keys, n_rows = above(limit)
    if not n_keys:
        return None
    hot = counts.filter(F.col("__n") > limit).drop("__n")
    return HotKeys(materialize(hot, "hot-keys"), n_keys, n_rows, limit)


class OrderedRuns:
    """The rows of df, grouped by `key` and put in `order` (ascending, without ties)."""

    def __init__(self, df: DataFrame, key, order, hot_limit: int | None = None):
        self.key, self.order = tuple(key), tuple(order)
        hot = find_hot_keys(df, self.key, hot_limit)
        if hot is None:
            self._plain, self._ranged = df, None
            return
        # At most MAX_RANGES / 2 keys, so broadcasting them is bounded.
        keys = F.broadcast(hot.keys)
        on = same(df, hot.keys, self.key)
        self._plain = df.join(keys, on, "left_anti")
        # Written out, so that every later use sees the same range numbers.
        self._ranged = materialize(
            df.join(keys, on, "left_semi")
            .repartitionByRange(hot.n_ranges, *self.key, *self.order)
            .withColumn(_RANGE, F.spark_partition_id()),
            "hot-ranges",
        )

    def add(
        self,
        prev: dict[str, Column] | None = None,
        next: dict[str, Column] | None = None,
        last: dict[str, Column] | None = None,
        coming: dict[str, Column] | None = None,
        largest: dict[str, Column] | None = None,
        before: dict[str, Column] | None = None,
    ) -> "OrderedRuns":
        """Add columns, each named after the value it carries from other rows of the key.

        prev, next    the value in the row before or after; asked for as a struct, NULL
                      means that there is no such row
        last, coming  the nearest value that is not NULL, from this row back or after it
        largest       the largest value of all rows before; NULL if there is none
        before        the nearest value that is not NULL of the rows before
        """
        asked = (prev or {}, next or {}, last or {}, coming or {}, largest or {}, before or {})
        out = object.__new__(OrderedRuns)
        out.key, out.order = self.key, self.order
        out._plain = self._windowed(self._plain, self.key, *asked)
        out._ranged = None if self._ranged is None else self._linked(*asked)
        return out

    @property
    def split(self) -> bool:
        """Whether a key was too large for one task."""
        return self._ranged is not None

    def rows(self) -> DataFrame:
        if self._ranged is None:
            return self._plain
        return self._plain.unionByName(self._ranged.drop(_RANGE))

    def _windowed(self, df, partition, prev, next, last, coming, largest, before) -> DataFrame:
        w = Window.partitionBy(*partition).orderBy(*self.order)
        above = w.rowsBetween(Window.unboundedPreceding, -1)
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        back = Window.partitionBy(*partition).orderBy(*[F.col(c).desc() for c in self.order])
        ahead = back.rowsBetween(Window.unboundedPreceding, -1)
        return df.select(
            "*",
            *[F.lag(c).over(w).alias(a) for a, c in prev.items()],
            *[F.lead(c).over(w).alias(a) for a, c in next.items()],
            *[F.last(c, ignorenulls=True).over(so_far).alias(a) for a, c in last.items()],
            *[F.last(c, ignorenulls=True).over(ahead).alias(a) for a, c in coming.items()],
            *[F.max(c).over(above).alias(a) for a, c in largest.items()],
            *[F.last(c, ignorenulls=True).over(above).alias(a) for a, c in before.items()],
        )

    def _linked(self, prev, next, last, coming, largest, before) -> DataFrame:
        def some(c: Column) -> Column:
            return F.when(c.isNotNull(), position)

        position = F.struct(*self.order)
        boxes = {
            **{a: F.max_by(_box(c), position) for a, c in prev.items()},
            **{a: F.min_by(_box(c), position) for a, c in next.items()},
            **{a: F.max_by(_box(c), some(c)) for a, c in (last | before).items()},
            **{a: F.min_by(_box(c), some(c)) for a, c in coming.items()},
        }
        edges = self._ranged.groupBy(*self.key, _RANGE).agg(
            *[box.alias(f"__e_{a}") for a, box in boxes.items()],
            *[F.max(c).alias(f"__e_{a}") for a, c in largest.items()],
        )
        w = Window.partitionBy(*self.key).orderBy(_RANGE)
        above = w.rowsBetween(Window.unboundedPreceding, -1)
        after = w.rowsBetween(1, Window.unboundedFollowing)
        # One row per (key, range): at most the number of ranges plus the number of hot keys.
        edges = edges.select(
            *[F.col(k).alias(f"__k_{k}") for k in (*self.key, _RANGE)],
            *[F.lag(f"__e_{a}").over(w).alias(f"__x_{a}") for a in prev],
            *[F.lead(f"__e_{a}").over(w).alias(f"__x_{a}") for a in next],
            *[F.last(f"__e_{a}", ignorenulls=True).over(above).alias(f"__x_{a}") for a in last | before],
            *[F.first(f"__e_{a}", ignorenulls=True).over(after).alias(f"__x_{a}") for a in coming],
            *[F.max(f"__e_{a}").over(above).alias(f"__x_{a}") for a in largest],
        )
        inner = self._windowed(
            self._ranged,
            (*self.key, _RANGE),
            {a: _box(c) for a, c in prev.items()},
            {a: _box(c) for a, c in next.items()},
            {a: F.when(c.isNotNull(), _box(c)) for a, c in last.items()},
            {a: F.when(c.isNotNull(), _box(c)) for a, c in coming.items()},
            largest,
            {a: F.when(c.isNotNull(), _box(c)) for a, c in before.items()},
        )
        on = reduce(
            lambda a, b: a & b,
            [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in (*self.key, _RANGE)],
        )
        return inner.join(F.broadcast(edges), on, "left").select(
            *[F.col(c) for c in self._ranged.columns],
            *[F.coalesce(F.col(a), F.col(f"__x_{a}"))["v"].alias(a) for a in boxes],
            *[F.greatest(F.col(a), F.col(f"__x_{a}")).alias(a) for a in largest],
        )


def _box(c: Column) -> Column:
    """A value that is there, even if NULL, as opposed to a row that is not."""
    return F.struct(c.alias("v"))
