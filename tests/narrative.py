"""The nine-event story that the golden answers are about."""

from datetime import datetime

from pyspark.sql import functions as F

from grantchron.model import BRONZE_SCHEMA

USERS = {
    101: "alice.chen", 102: "bob.singh", 103: "carla.diaz", 104: "dev.contractor", 105: "emma.wong",
}
ROLES = {1: ("Admin", "Privileged"), 2: ("Analyst", "Standard"), 3: ("Auditor", "Read-Only")}
RESOURCES = {
    501: ("prod-db-01", "Database"), 502: ("reporting-svc", "Service"), 503: ("billing-api", "Service"),
    504: ("audit-logs", "Storage"), 505: ("staging-db", "Database"), 506: ("ml-pipeline", "Service"),
}
DELETED_AT = datetime(2026, 8, 30, 11, 29, 17, 352000)


def at(month, day, hour=0, minute=0):
    return datetime(2026, month, day, hour, minute)


# op, grant, user, role, resource, granted, revoked, updated
EVENTS = [
    ("r", 1, 101, 1, 501, at(1, 5, 9), None, at(1, 5, 9)),
    ("r", 2, 102, 2, 502, at(1, 6, 10, 15), None, at(1, 6, 10, 15)),
    ("r", 3, 103, 1, 503, at(1, 7, 11, 30), None, at(1, 7, 11, 30)),
    ("u", 3, 103, 1, 503, at(1, 7, 11, 30), at(2, 1, 8), at(2, 1, 8)),
    ("c", 4, 101, 3, 504, at(2, 10, 13), None, at(2, 10, 13)),
    ("c", 5, 104, 2, 505, at(2, 15, 8, 45), None, at(2, 15, 8, 45)),
    ("d", 5, None, None, None, None, None, None),
    ("u", 1, 101, 1, 501, at(1, 5, 9), at(3, 15, 10), at(3, 15, 10)),
    ("c", 6, 105, 2, 506, at(3, 15, 11), None, at(3, 15, 11)),
]

# Events merged together; then the batch, closed, opened, current and history row counts.
STEPS = [
    (range(1, 4), 3, 0, 3, 3, 3),
    (range(4, 5), 1, 1, 0, 3, 3),
    (range(5, 6), 1, 0, 1, 4, 4),
    (range(6, 7), 1, 0, 1, 5, 5),
    (range(7, 8), 1, 1, 0, 4, 5),
    (range(8, 10), 2, 1, 1, 5, 6),
]

# grant, start, end, is_current, is_deleted
HISTORY = [
    (1, at(1, 5, 9), at(3, 15, 10), False, False),
    (2, at(1, 6, 10, 15), None, True, False),
    (3, at(1, 7, 11, 30), at(2, 1, 8), False, False),
    (4, at(2, 10, 13), None, True, False),
    (5, at(2, 15, 8, 45), DELETED_AT, False, True),
    (6, at(3, 15, 11), None, True, False),
]


def capture_ns(i):
    """Rising with i; the delete (event 7) is captured at DELETED_AT."""
    base = int((DELETED_AT - datetime(1970, 1, 1)).total_seconds() * 1000) * 1_000_000
    return base + (i - 7) * 1_000_000_000


def bronze_row(i):
    op, grant, user, role, resource, granted, revoked, updated = EVENTS[i - 1]
    role_name, category = ROLES.get(role, (None, None))
    name, kind = RESOURCES.get(resource, (None, None))
    return (
        grant, user, USERS.get(user), USERS[user] + "@client.com" if user else None,
        role, role_name, category, resource, name, kind,
        granted, revoked, updated, None if op == "d" else False,
        op, capture_ns(i), "iam_denormalized", "iam_source", "true" if op == "d" else "false", i,
    )


def bronze(spark, events=range(1, 10)):
    return spark.createDataFrame([bronze_row(i) for i in events], BRONZE_SCHEMA)


def source_after(spark, n):
    """The source table after the first n events."""
    rows = {}
    for i in range(1, n + 1):
        row = bronze_row(i)
        if row[14] == "d":
            del rows[row[0]]
        else:
            rows[row[0]] = row[:14]
    from grantchron.model import SOURCE_SCHEMA, as_nullable

    return spark.createDataFrame(list(rows.values()), as_nullable(SOURCE_SCHEMA))


def history_rows(history):
    cols = ["grant_id", "effective_start", "effective_end", "is_current", "is_deleted"]
    return [tuple(r) for r in history.select(*cols).orderBy("grant_id", "effective_start").collect()]


def grants(df):
    return [r[0] for r in df.select("grant_id").orderBy(F.col("grant_id")).collect()]
