"""Dimensions (E3) and the difference between a changed record and changed access."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from grantchron.model import ACCESS, GRANTS, ChangeSpec
from grantchron.operators.ordered import NO_HOT_KEYS, OrderedRuns, find_hot_keys, same
from grantchron.session import estimated_bytes, hot_key_rows, materialize, small_input_bytes


# A key is busy with more events than this part of those of a hot one.
BUSY_SHARE = 10


def latest_dimension(events: DataFrame, key, attributes, order) -> DataFrame:
    """The last known attributes of each business key (pre-aggregated before the shuffle)."""
    key = [key] if isinstance(key, str) else list(key)
    return (
        events.dropna(subset=key)
        .groupBy(*key)
        .agg(F.max_by(F.struct(*attributes), F.struct(*order)).alias("v"))
        .select(*key, "v.*")
    )


def hashed_key(dim: DataFrame, key, name: str) -> DataFrame:
    """A surrogate key any job can compute on its own; distinct but for 64-bit collisions."""
    key = [key] if isinstance(key, str) else list(key)
    return dim.withColumn(name, F.xxhash64(*key))


def dense_key(dim: DataFrame, key, name: str, start: int = 1) -> DataFrame:
    """A surrogate key start, start+1, ... in business key order, numbered in parallel.

    A range shuffle orders the table; each task numbers its own rows, and the row counts
    of the tasks before it (one small row per task) shift them into place.
    """
    key = [key] if isinstance(key, str) else list(key)
    spark = dim.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        dim.repartitionByRange(tasks, *key)
        .sortWithinPartitions(*key)
        .withColumn("__id", F.monotonically_increasing_id()),
        "dense-key",
    )
    # The upper bits of the id name the task, the lower 33 count within it.
    task, offset = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    sizes = placed.groupBy(task.alias("__task")).agg(F.count(F.lit(1)).alias("__n")).collect()
    shifts, total = [], start
    for row in sorted(sizes, key=lambda r: r["__task"]):
        shifts.append((row["__task"], total))
        total += row["__n"]
    shift = spark.createDataFrame(shifts, "__task bigint, __shift bigint")
    return (
        placed.withColumn("__task", task)
        .join(F.broadcast(shift), "__task")
        .select(*dim.columns, (F.col("__shift") + offset).alias(name))
    )


def with_new_keys(known: DataFrame, found: DataFrame, key, name: str) -> DataFrame:
    """Give business keys not in `known` the next dense keys; known ones keep theirs."""
    key = [key] if isinstance(key, str) else list(key)
    highest = known.agg(F.max(name)).first()[0] or 0
    fresh = dense_key(found.join(known, key, "left_anti"), key, name, highest + 1)
    kept = found.join(known.select(*key, name), key)
    return kept.select(*fresh.columns).unionByName(fresh)


def changed_only(
    events: DataFrame, key, order, tracked, hot_limit: int | None = None
) -> DataFrame:
    """Rows whose tracked columns differ from the key's previous row, and its first row."""
    state = F.struct(*tracked)
    rows = OrderedRuns(events, key, order, hot_limit).add(prev={"__prev": state}).rows()
    return rows.filter(~F.col("__prev").eqNullSafe(state)).select(*events.columns)


def without_quiet_hours(
    events: DataFrame, attributes, spec: ChangeSpec = GRANTS, hot_limit: int | None = None
) -> tuple[DataFrame, float | None]:
    """The events without some that tell the attributes of a busy key as the event before them does.

    In an hour of capture in which all events of the key tell the same, only the first can differ
    from its predecessor; of such hours it alone stays, found before the shuffle. Hours that tell
    different things, and keys with few events for a hot one, stay whole. So each event that changes the
    attributes stays, and what an event that stays follows still tells what its predecessor told.

    Also the hot_limit of what is left: NO_HOT_KEYS where it is known to have none.
    """
    if hot_limit is None and estimated_bytes(events) < small_input_bytes(events.sparkSession):
        return events, NO_HOT_KEYS
    limit = hot_limit or hot_key_rows(events.sparkSession)
    hot = find_hot_keys(events, spec.key, max(1, limit // BUSY_SHARE))
    if hot is None:
        return events, NO_HOT_KEYS
    on = same(events, hot.keys, spec.key)
    plain = events.join(F.broadcast(hot.keys), on, "left_anti")
    busy = events.join(F.broadcast(hot.keys), on, "left_semi").withColumn(
        "__hour", F.expr(f"`{spec.capture_ns}` div {3600 * 10**9}")
    )
    hour = [*spec.key, "__hour"]
    others = [c for c in events.columns if c not in (*spec.key, *attributes, *spec.order)]
    # One row for each thing told in an hour of a key: written, as all that follows starts from it.
    told = materialize(
        busy.groupBy(*hour, *attributes).agg(
            F.min(F.struct(*spec.order, *others)).alias("__first"), F.count(F.lit(1)).alias("__n")
        ),
        "told-by-hour",
    )
    hours = told.groupBy(*hour).agg(F.count(F.lit(1)).alias("__told"), F.sum("__n").alias("__n"))
    loud = F.col("__told") > 1
    left = hours.groupBy(*spec.key).agg(F.sum(F.when(loud, F.col("__n")).otherwise(1)).alias("__n"))
    still_hot = hot.limit > limit or not left.filter(F.col("__n") > limit).isEmpty()
    mixed = hours.filter(loud).select(*hour)
    kept = [
        plain,
        told.join(mixed, same(told, mixed, hour), "left_anti").select(*spec.key, *attributes, "__first.*"),
        busy.join(mixed, same(busy, mixed, hour), "left_semi").drop("__hour"),
    ]
    return reduce(DataFrame.unionByName, kept), hot_limit if still_hot else NO_HOT_KEYS


def attribute_history(
    events: DataFrame, key, order, attributes, changed_at: str, hot_limit: int | None = None
) -> DataFrame:
    """A dimension's attribute versions, one per change of their values."""
    key = [key] if isinstance(key, str) else list(key)
    changes = changed_only(events, key, order, attributes, hot_limit)
    rows = OrderedRuns(changes, key, order, hot_limit).add(next={"__next": F.struct(changed_at)}).rows()
    return rows.select(
        *key,
        *attributes,
        F.col(changed_at).alias("effective_start"),
        F.col(f"__next.{changed_at}").alias("effective_end"),
        F.col("__next").isNull().alias("is_current"),
    )


def classify_changes(
    staged: DataFrame,
    access=ACCESS,
    spec: ChangeSpec = GRANTS,
    hot_limit: int | None = None,
) -> DataFrame:
    """Per staged event, whether its record and whether its access differs from before.

    The record is every attribute but the time of the update, and whether the row exists;
    access is the given columns, and whether the row exists.
    """
    gone = (F.col("op") == "d").alias("gone")
    record = F.struct(gone, *[c for c in spec.attributes if c != spec.updated_at])
    granted = F.struct(gone, *access)
    rows = OrderedRuns(staged, spec.key, spec.order, hot_limit).add(
        prev={"__prev": F.struct(record.alias("record"), granted.alias("access"))}
    )
    return rows.rows().select(
        *staged.columns,
        (~F.col("__prev.record").eqNullSafe(record)).alias("record_changed"),
        (~F.col("__prev.access").eqNullSafe(granted)).alias("access_changed"),
    )
