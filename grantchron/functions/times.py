"""Column expressions for capture time, business time and periods."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F

from grantchron.model import GRANTS, ChangeSpec


def ntz(t: str | datetime | date) -> Column:
    """A zone-free timestamp literal."""
    if isinstance(t, datetime):
        t = t.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(t, date):
        t = t.strftime("%Y-%m-%d 00:00:00")
    return F.expr(f"timestamp_ntz'{t}'")


def at(t: str | datetime | date | Column) -> Column:
    return t if isinstance(t, Column) else ntz(t)


def since_epoch(amount: str, unit: str = "MICROSECOND") -> Column:
    """An SQL integer as a zone-free timestamp, whatever the session's zone; NULL stays NULL."""
    return F.expr(f"timestampadd({unit}, {amount}, timestamp_ntz'1970-01-01')")


def capture_time(ns_column: str) -> Column:
    """Epoch nanoseconds to a timestamp, in integers, so that micros survive."""
    return since_epoch(f"`{ns_column}` div 1000")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp or date, whatever the session's zone."""
    ts = ts.cast("timestamp_ntz")
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    minutes = (days * 24 + F.hour(ts)) * 60 + F.minute(ts)
    seconds = F.extract(F.lit("SECOND"), ts)  # with six decimals
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("long")


def capture_ns(ts: Column) -> Column:
    """The reverse of capture_time."""
    return epoch_micros(ts) * F.lit(1000)


def business_time(spec: ChangeSpec = GRANTS) -> Column:
    """A delete has only its capture time; anything else says when it was updated."""
    return F.when(F.col(spec.op) == "d", capture_time(spec.capture_ns)).otherwise(
        F.col(spec.updated_at)
    )


def closes_access(spec: ChangeSpec = GRANTS) -> Column:
    """C4: a hard delete, or an update that carries a revocation."""
    op = F.col(spec.op)
    return (op == "d") | ((op == "u") & F.col(spec.revoked_at).isNotNull())


def covers(t, start: str = "effective_start", end: str = "effective_end") -> Column:
    """Starts count, ends do not; no end means still open."""
    t = at(t)
    return (F.col(start) <= t) & (F.col(end).isNull() | (F.col(end) > t))
