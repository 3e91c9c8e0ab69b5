"""Loading dimensions with a merge (E3): versions of attributes, keys that stay, one commit."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from grantchron.model import Dimension
from grantchron.operators.batch import relate_events
from grantchron.operators.dims import dense_key, without_quiet_hours
from grantchron.operators.scd import access_changes, scd2_merge
from grantchron.operators.temporal import as_of_probes
from grantchron.plans.store import Commit, GoldStore

Write = Callable[[DataFrame, str], None]


def load(
    store: GoldStore, before: Commit, dim: Dimension, events: DataFrame, batch: str, touched, hot_limit=None
) -> tuple[Write, DataFrame, dict] | None:
    """What to write of a batch's events, and the dimension's state then; None if nothing changes.

    An event that names a key tells its attributes; a version starts where they differ from those
    in the key's event before, be it in this batch or, by the open version, in an earlier one. A
    key keeps its surrogate key; new ones get the next numbers. Only buckets of `touched` (those
    of the batch's keys) are read, and only buckets with a change are written.
    """
    never = F.lit(False).alias("is_deleted")
    spec, state = dim.spec(store.spec), before.dims.get(dim.name, {"closed": [], "open": {}, "keys": 0})
    told = events.filter(F.col(dim.key).isNotNull()).select(
        *dim.schema.names,
        *spec.order,
        "business_ts",
        F.lit("u").alias("op"),
        F.lit(False).alias("closes_access"),
        never,
    )
    told, hot_limit = without_quiet_hours(told, dim.attributes, spec, hot_limit)
    related = relate_events(told, spec, "all", hot_limit, with_origin=False, tracked=dim.attributes)
    # Written, as access_changes starts from them several times.
    related = store.stage(related.filter("is_first OR changed"), batch, f"{dim.name}-told")
    changes = access_changes(
        related, store.open_versions(dim, before, touched), spec, dim.attributes, hot_limit=hot_limit
    )
    changes = store.stage(changes, batch, dim.name)
    changed = changes.agg(F.collect_set(store.bucket(dim.key))).first()[0]  # at most store.buckets values
    if not changed:
        return None
    open_rows = store.open_versions(dim, before, changed)
    keys = open_rows.select(dim.key, dim.surrogate)
    fresh = changes.filter("is_first").select(dim.key).join(keys, dim.key, "left_anti")
    numbered = dense_key(fresh, dim.key, dim.surrogate, state["keys"] + 1)
    highest = numbered.agg(F.max(dim.surrogate)).first()[0]
    versions = scd2_merge(open_rows.select("*", never), changes, spec).join(keys.unionByName(numbered), dim.key)
    after = {
        "closed": [*state["closed"], batch],
        "open": {**state["open"], **dict.fromkeys(changed, batch)},
        "keys": highest or state["keys"],
    }
    return (lambda rows, b: store.write_dimension(dim, rows, b)), versions.select(*dim.stored.names), after


def described(facts: DataFrame, versions: DataFrame, dim: Dimension, time: str = "effective_start") -> DataFrame:
    """Facts with the surrogate key and the attributes that their key had at `time`.

    Facts without the key, or from before its first version, are left out. A key that holds most
    facts is split as in as_of_probes.
    """
    return as_of_probes(versions, facts, [dim.key], time)
