"""Current state (SCD1) and access periods (SCD2) from related events: T1, T2, T3, E1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from grantchron.model import ACCESS, GRANTS, ChangeSpec
from grantchron.operators.batch import RELATED, relate_events, stage


def opened_periods(
    events: DataFrame,
    spec: ChangeSpec = GRANTS,
    prerevoked: str = "open",
    with_pending: bool = False,
    endings: bool = False,
) -> DataFrame:
    """Every event that does not close access starts a period; the next one ends it.

    prerevoked="open" treats a first row that is already revoked like any other;
    "closed" gives it the period up to its revocation or, if that comes first, to the next
    event, if that is not empty. Such a period of a key's last event is `pending`: an event
    of a later batch may still end it earlier.

    endings adds the column `ending`, see _ending.
    """
    started = events.filter(~F.col("closes_access"))
    end, current, pending = F.col("next_ts"), F.col("is_last"), F.lit(False)
    ending = F.when(~F.col("is_last"), _ending(F.col("next_op"), F.col("next_closes")))
    deleted = F.when(F.col("is_last"), F.col(spec.soft_delete)).otherwise(F.col("next_op") == "d")
    if prerevoked == "closed":
        revoked = F.col(spec.revoked_at)
        born_closed = revoked.isNotNull()
        started = started.filter(~born_closed | (revoked > F.col("business_ts")))
        outlived = F.col("is_last") | (F.col("next_ts") > revoked)
        end = F.when(born_closed, F.least(revoked, F.col("next_ts"))).otherwise(end)
        current = current & ~born_closed
        deleted = F.when(born_closed & outlived, F.col(spec.soft_delete)).otherwise(deleted)
        pending = F.col("is_last") & born_closed
        ending = F.when(born_closed & outlived, F.lit("revoked")).otherwise(ending)
    elif prerevoked != "open":
        raise ValueError(f"prerevoked must be 'open' or 'closed', not {prerevoked!r}")
    return started.select(
        *spec.key,
        *spec.versioned,
        F.col("business_ts").alias("effective_start"),
        end.alias("effective_end"),
        current.alias("is_current"),
        deleted.alias("is_deleted"),
        *([pending.alias("pending")] if with_pending else []),
        *([ending.alias("ending")] if endings else []),
    )


def _ending(op: Column, closes: Column) -> Column:
    """A6 by the event that ends a period: a hard delete, a revocation, or the next version."""
    return F.when(op == "d", F.lit("hard_delete")).when(closes, F.lit("revoked")).otherwise(F.lit("replaced"))


def close_open_periods(
    open_rows: DataFrame, events: DataFrame, spec: ChangeSpec = GRANTS, few_keys: bool = False
) -> DataFrame:
    """A key's first event in the batch closes its open row; rows of other keys stay.

    A row that has an end, as it was pending, ends earlier if the event comes before it.

    few_keys: the caller has counted the batch's keys, and they fit a broadcast.
    """
    firsts = events.filter("is_first").select(
        *spec.key,
        F.col("business_ts").alias("__end"),
        (F.col("op") == "d").alias("__deleted"),
        F.lit(True).alias("__hit"),
        _ending(F.col("op"), F.col("closes_access")).alias("__ending"),
    )
    if few_keys:
        firsts = F.broadcast(firsts)
    hit, known_end = F.col("__hit").isNotNull(), F.col("effective_end")
    cut = hit & (known_end.isNull() | (F.col("__end") <= known_end))
    return open_rows.join(firsts, list(spec.key), "left").select(
        *spec.key,
        *spec.versioned,
        "effective_start",
        F.when(cut, F.col("__end")).otherwise(known_end).alias("effective_end"),
        (F.col("is_current") & ~hit).alias("is_current"),
        F.when(cut, F.col("__deleted")).otherwise(F.col("is_deleted")).alias("is_deleted"),
        *([(F.col("pending") & ~hit).alias("pending")] if "pending" in open_rows.columns else []),
        *(
            [F.when(cut, F.col("__ending")).otherwise(F.col("ending")).alias("ending")]
            if "ending" in open_rows.columns
            else []
        ),
    )


def scd2_merge(
    open_rows: DataFrame | None,
    events: DataFrame,
    spec: ChangeSpec = GRANTS,
    prerevoked: str = "open",
    few_keys: bool = False,
) -> DataFrame:
    """T2 + T3: what becomes of the open rows, plus the periods the batch starts.

    Open rows with a column `pending` (and then rows that are) give a result with it, and those
    with a column `ending` one that says how each period ended.
    """
    columns = open_rows.columns if open_rows is not None else []
    opened = opened_periods(events, spec, prerevoked, "pending" in columns, "ending" in columns)
    if open_rows is None:
        return opened
    return close_open_periods(open_rows, events, spec, few_keys).unionByName(opened)


def access_changes(
    events: DataFrame,
    open_rows: DataFrame | None,
    spec: ChangeSpec = GRANTS,
    access=ACCESS,
    few_keys: bool = False,
    hot_limit: int | None = None,
) -> DataFrame:
    """The events that change access, related among themselves, for scd2_merge.

    events are related with `access` as the tracked columns. Within the batch, an event that is as
    the one before it starts nothing. A key's first event has its predecessor in another batch: the
    open row was begun by a change, so it has that event's access, and where no row is open the
    predecessor closed access or there is none. So any split of a log gives the same rows.
    """
    known = {spec.soft_delete: "is_deleted"} | {c: c for c in spec.versioned}
    missing = [c for c in access if c not in known]
    if missing:
        raise ValueError(f"{missing}: not in the history, so the next batch cannot see a change")
    own = [c for c in events.columns if c not in RELATED]
    firsts = events.filter("is_first").select(own)
    if open_rows is not None:
        keys = list(spec.key)
        begun = open_rows.filter("is_current").select(
            *keys, F.struct(*[F.col(known[c]).alias(c) for c in access]).alias("__access")
        )
        if few_keys:
            begun = begun.join(F.broadcast(firsts.select(*keys)), keys, "left_semi")
        same = ~F.col("closes_access") & F.col("__access").eqNullSafe(F.struct(*access))
        firsts = firsts.join(begun, keys, "left").filter(~same).select(own)
    changes = firsts.unionByName(events.filter("NOT is_first AND changed").select(own))
    return relate_events(changes, spec, "all", hot_limit, with_origin=False)


def _inserted(lasts: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Rows for keys that are not stored, unless their last event is a delete."""
    return lasts.filter((F.col("op") != "d") & F.col("origin").isNotNull()).select(
        *spec.key,
        *[F.col(f"origin.{c}" if c in spec.inserted_only else c).alias(c) for c in spec.attributes],
    )


def scd1_merge(
    target: DataFrame | None,
    events: DataFrame,
    spec: ChangeSpec = GRANTS,
    few_keys: bool = False,
) -> DataFrame:
    """Delete, update in place or insert, by what the key's last event says.

    Insert-only attributes come from the stored row unless the batch deleted it, and
    otherwise from the event that began the present row.

    few_keys: the caller has counted the batch's keys, and they fit a broadcast. Stored
    rows are then updated where they are read, and only the batch is shuffled to find
    its new keys; otherwise both sides are, once.
    """
    lasts = events.filter("is_last")
    if target is None:
        return _inserted(lasts, spec)
    stored = target.select(*spec.fact_columns, F.lit(True).alias("__stored"))
    found = lasts.select(
        *spec.key, "op", "origin", "had_delete",
        *[F.col(c).alias(f"__{c}") for c in spec.updated],
        F.lit(True).alias("__hit"),
    )
    if few_keys:
        joined = stored.join(F.broadcast(found), list(spec.key), "left")
    else:
        joined = stored.join(found, list(spec.key), "full_outer")
    untouched = F.col("__hit").isNull()
    kept = F.col("__stored").isNotNull() & ~F.coalesce(F.col("had_delete"), F.lit(False))
    alive = untouched | (
        ~F.coalesce(F.col("op") == "d", F.lit(False)) & (kept | F.col("origin").isNotNull())
    )
    merged = joined.filter(alive).select(
        *spec.key,
        *[
            F.when(untouched, F.col(c)).otherwise(F.col(f"__{c}")).alias(c)
            if c in spec.updated
            else F.when(kept, F.col(c)).otherwise(F.col(f"origin.{c}")).alias(c)
            for c in spec.attributes
        ],
    )
    if not few_keys:
        return merged
    keys = list(spec.key)
    known = target.select(*keys).join(F.broadcast(lasts.select(*keys)), keys, "left_semi")
    return merged.unionByName(_inserted(lasts.join(known, keys, "left_anti"), spec))


def access_history(
    bronze: DataFrame,
    spec: ChangeSpec = GRANTS,
    mode: str = "all",
    prerevoked: str = "open",
    hot_limit: int | None = None,
) -> DataFrame:
    """The whole history of a log in one pass."""
    events = relate_events(stage(bronze, spec), spec, mode, hot_limit, with_origin=False)
    return opened_periods(events, spec, prerevoked)


def current_state(
    bronze: DataFrame, spec: ChangeSpec = GRANTS, mode: str = "all", hot_limit: int | None = None
) -> DataFrame:
    """The current-state table of a log in one pass."""
    return scd1_merge(None, relate_events(stage(bronze, spec), spec, mode, hot_limit), spec)
