"""Point-in-time and audit questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from grantchron.functions.times import at, covers, epoch_micros
from grantchron.model import GRANTS, ChangeSpec
from grantchron.operators.ordered import OrderedRuns, find_hot_keys
from grantchron.session import materialize

# Of periods that start together, the open one is the last.
PERIOD_ORDER = ("effective_start", "is_current", "effective_end")


def _only(df: DataFrame, **values) -> DataFrame:
    for name, value in values.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df


def _ending(history: DataFrame, condition, still_open: bool = False) -> DataFrame:
    """Periods of some end days, if the history is stored by them."""
    if "end_day" not in history.columns:
        return history
    day = F.col("end_day")
    return history.filter(condition(day) | day.isNull() if still_open else condition(day))


def as_of(history: DataFrame, t, **values) -> DataFrame:
    """A1-A4: periods that cover t, for the given user, resource or both.

    Where the history is stored by end day, days before t are not read.
    """
    history = _ending(history, lambda day: day >= at(t).cast("date"), still_open=True)
    return _only(history, **values).filter(covers(t))


def existed_at(history: DataFrame, t, **values) -> DataFrame:
    """A3 as one row."""
    return as_of(history, t, **values).agg((F.count(F.lit(1)) > 0).alias("existed"))


def ended_at(history: DataFrame, t) -> DataFrame:
    """A5: periods that ended exactly at t; of a history stored by end day one day is read."""
    history = _ending(history, lambda day: day == at(t).cast("date"))
    return history.filter(F.col("effective_end") == at(t))


def ended_between(history: DataFrame, since, until) -> DataFrame:
    """A5 for a range [since, until), whose days alone are read."""
    days = at(since).cast("date"), at(until).cast("date")
    history = _ending(history, lambda day: day.between(*days))
    end = F.col("effective_end")
    return history.filter((end >= at(since)) & (end < at(until)))


def with_ending(
    history: DataFrame, spec: ChangeSpec = GRANTS, hot_limit: int | None = None
) -> DataFrame:
    """How each period ended: open, hard delete, replaced by a next version, or revoked."""
    versions = OrderedRuns(history, spec.key, PERIOD_ORDER, hot_limit).add(
        next={"__next": F.struct("effective_start")}
    )
    ending = (
        F.when(F.col("is_current"), F.lit("open"))
        .when(F.col("is_deleted"), F.lit("hard_delete"))
        .when(F.col("__next.effective_start") == F.col("effective_end"), F.lit("replaced"))
        .otherwise(F.lit("revoked"))
    )
    return versions.rows().select(*history.columns, ending.alias("ending"))


def removal_history(history: DataFrame, spec: ChangeSpec = GRANTS, **values) -> DataFrame:
    """A6 for one (user, resource), in order. Whole keys are read first: see with_ending."""
    keys = _only(history, **values).select(*spec.key).distinct()
    return _only(
        with_ending(history.join(keys, list(spec.key), "left_semi"), spec), **values
    ).orderBy("effective_start")


def active_access(fact: DataFrame, spec: ChangeSpec = GRANTS) -> DataFrame:
    """M3: neither revoked nor soft-deleted."""
    return fact.filter(F.col(spec.revoked_at).isNull() & (F.col(spec.soft_delete) == F.lit(False)))


def in_key_order(fact: DataFrame, spec: ChangeSpec = GRANTS) -> DataFrame:
    """A7, and A8 on active_access(fact)."""
    return fact.orderBy(*spec.key)


def event_trail(bronze: DataFrame, spec: ChangeSpec = GRANTS, **key) -> DataFrame:
    """A10: one key's bronze events as captured."""
    return _only(bronze, **key).orderBy(*spec.order)


def version_trail(history: DataFrame, **key) -> DataFrame:
    """One key's periods by start."""
    return _only(history, **key).orderBy(*PERIOD_ORDER)


def as_of_probes(
    history: DataFrame,
    probes: DataFrame,
    on,
    time: str,
    tie=(),
    hot_limit: int | None = None,
) -> DataFrame:
    """For every probe row, the periods of its `on` columns that cover its `time`.

    Periods are not paired with the probes of their key. Both are put in one order of
    time, where the last period started before a probe is the only one that can cover it,
    except for periods reaching past the start of a later one. Those are joined on their
    own, by the pieces of time they consist of. `tie` orders periods of one key that
    start together, such as the grants of one user. The ordered pass runs at once.
    """
    on, tie = tuple(on), tuple(tie)
    columns = [c for c in history.columns if c not in probes.columns]
    # A NULL key or time matches nothing.
    asked = probes.dropna(subset=[*on, time]).select(
        *on, F.col(time).alias("__t"), F.struct(*probes.columns).alias("__probe")
    )
    periods = history.dropna(subset=[*on, "effective_start"]).select(
        *on,
        F.col("effective_start").alias("__t"),
        F.struct(*tie, "effective_end").alias("__tie"),
        F.struct(*dict.fromkeys((*columns, "effective_end"))).alias("__period"),
    )
    both = periods.withColumn("__is_probe", F.lit(False)).unionByName(
        asked.withColumn("__is_probe", F.lit(True)), allowMissingColumns=True
    )
    probe = F.col("__is_probe")
    # The period before: of a probe the one that may cover it, of a period the one that may reach
    # past its start. One pass in one order finds both.
    ordered = (
        OrderedRuns(both, on, ("__t", "__is_probe", "__tie"), hot_limit)
        .add(before={"__found": F.col("__period")})
        .rows()
    )
    # A probe gets its answer; a period that reaches on goes from the start of the later one.
    covered = F.col("__found").isNotNull() & _after(F.col("__found.effective_end"), F.col("__t"))
    # Written once, as both its parts are used; usually no period reaches that far.
    kept = materialize(
        ordered.filter(covered).select(
            *on, "__is_probe", "__probe", F.col("__found").alias("__period"), F.col("__t").alias("__from")
        ),
        "probed",
    )
    found = kept.filter(probe).select("__probe", "__period")
    reaching = kept.filter(~probe).select(*on, "__from", "__period")
    if not reaching.isEmpty():
        found = found.unionByName(_stab(reaching, asked, on, hot_limit))
    return found.select(
        *[F.col("__probe")[c].alias(c) for c in probes.columns],
        *[F.col("__period")[c].alias(c) for c in columns],
    )


def _after(end: Column, t: Column) -> Column:
    return end.isNull() | (end > t)


# Seconds since the start of year 1, of which 2**39 reach past year 9999. A piece of
# time, 2**level seconds long, is named by its number in a binary tree of them.
_LEVELS = 39
_YEAR_ONE = -62_135_596_800


def _second(t: Column) -> Column:
    """Times outside the range count as its first or last second."""
    second = F.floor(epoch_micros(t) / 1_000_000).cast("long") - F.lit(_YEAR_ONE)
    return F.greatest(F.least(second, F.lit(2**_LEVELS - 1)), F.lit(0))


def _piece(number: Column, level: int) -> Column:
    return number + F.lit(2 ** (_LEVELS - level))


def _pieces_of(lo: Column, hi: Column) -> Column:
    """The fewest pieces that make up the seconds lo <= s < hi: at most two per level."""
    pieces = []
    for level in range(_LEVELS + 1):
        a, b = F.shiftright(lo + F.lit(2**level - 1), level), F.shiftright(hi, level)
        pieces.append(F.when((a < b) & (a.bitwiseAND(1) == 1), _piece(a, level)))
        pieces.append(F.when((a < b) & (b.bitwiseAND(1) == 1), _piece(b - 1, level)))
    return F.explode(F.array_compact(F.array(*pieces)))


def _pieces_with(second: Column, levels: list[int]) -> Column:
    """The one piece of each of these levels that a second lies in."""
    return F.explode(F.array(*[_piece(F.shiftright(second, level), level) for level in levels]))


def _level(piece: Column) -> Column:
    """A level's pieces are numbered from a power of two on, below the next."""
    return F.lit(_LEVELS) - (F.length(F.bin(piece)) - 1)


def _stab(reaching: DataFrame, asked: DataFrame, on, hot_limit: int | None = None) -> DataFrame:
    """Probes with __from <= __t < end, without comparing all pairs of a key.

    A period is cut into pieces; a probe names all pieces it lies in. Each pair meets in
    one piece only, and those that meet are answers but for fractions of a second at the
    ends. A piece with very many periods of a key is dealt over tasks (_dealt).
    """
    end = F.col("__period.effective_end")
    seconds = {
        "__lo": _second(F.col("__from")),
        "__hi": F.coalesce(_second(end), F.lit(2**_LEVELS - 1)) + F.lit(1),
    }
    cut = reaching.withColumns(seconds).select(
        *on, _pieces_of(F.col("__lo"), F.col("__hi")).alias("__piece"), "__from", "__period"
    )
    # At most _LEVELS + 1 of them occur, and a probe is asked about no others.
    levels = sorted(r[0] for r in cut.select(_level(F.col("__piece"))).distinct().collect())
    named = (
        asked.join(reaching.select(*on).distinct(), list(on), "left_semi")
        .withColumn("__second", _second(F.col("__t")))
        .select(*on, _pieces_with(F.col("__second"), levels).alias("__piece"), "__t", "__probe")
    )
    meeting = [*on, "__piece"]
    named, cut, meeting = _dealt(named, cut, meeting, hot_limit)
    return (
        named.join(cut, meeting)
        .filter((F.col("__t") >= F.col("__from")) & _after(end, F.col("__t")))
        .select("__probe", "__period")
    )


def _dealt(
    probes: DataFrame, periods: DataFrame, keys: list[str], hot_limit: int | None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides, and what to join them by: periods of a crowded key go by salt, and its probes to each."""
    hot = find_hot_keys(periods, keys, hot_limit)
    if hot is None:
        return probes, periods, keys
    crowded = periods.join(F.broadcast(hot.keys), keys, "left_semi")
    fans = crowded.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / hot.limit).alias("__fan"))
    fans = F.broadcast(materialize(fans, "crowded"))  # as many rows as hot.keys, which are bounded
    fan = F.coalesce("__fan", F.lit(1))
    salt = F.pmod(F.xxhash64("__period", "__from"), fan)
    every = F.explode(F.sequence(F.lit(0).cast("long"), fan - 1))
    return (
        probes.join(fans, keys, "left").withColumn("__salt", every).drop("__fan"),
        periods.join(fans, keys, "left").withColumn("__salt", salt).drop("__fan"),
        [*keys, "__salt"],
    )
