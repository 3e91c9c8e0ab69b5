"""Table schemas and the description of a change log that every operator takes."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

_L, _S, _B, _N = T.LongType(), T.StringType(), T.BooleanType(), T.TimestampNTZType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


def as_nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


# The OLTP table whose changes are captured. Only here are columns required.
SOURCE_SCHEMA = T.StructType(
    [
        T.StructField("grant_id", _L, False),
        T.StructField("user_id", _L, False),
        T.StructField("user_name", _S, False),
        T.StructField("user_email", _S, False),
        T.StructField("role_id", _L, False),
        T.StructField("role_name", _S, False),
        T.StructField("role_category", _S, True),
        T.StructField("resource_id", _L, False),
        T.StructField("resource_name", _S, False),
        T.StructField("resource_type", _S, True),
        T.StructField("granted_at", _N, False),
        T.StructField("revoked_at", _N, True),
        T.StructField("updated_at", _N, False),
        T.StructField("is_deleted", _B, False),
    ]
)

# What capture adds to every row. event_id breaks ties between equal capture times.
CAPTURE_FIELDS = _struct(__op=_S, __source_ts_ns=_L, __table=_S, __db=_S, __deleted=_S, event_id=_L)

# A delete carries its key only, so every bronze column is nullable.
BRONZE_SCHEMA = T.StructType(as_nullable(SOURCE_SCHEMA).fields + CAPTURE_FIELDS.fields)

DIM_USER_SCHEMA = _struct(user_id=_L, user_name=_S, user_email=_S)
DIM_ROLE_SCHEMA = _struct(role_id=_L, role_name=_S, role_category=_S)
DIM_RESOURCE_SCHEMA = _struct(resource_id=_L, resource_name=_S, resource_type=_S)

FACT_SCHEMA = _struct(
    grant_id=_L, user_id=_L, role_id=_L, resource_id=_L,
    granted_at=_N, revoked_at=_N, updated_at=_N, is_deleted=_B,
)
HISTORY_SCHEMA = _struct(
    grant_id=_L, user_id=_L, role_id=_L, resource_id=_L, granted_at=_N, revoked_at=_N,
    effective_start=_N, effective_end=_N, is_current=_B, is_deleted=_B,
)
WATERMARK_SCHEMA = _struct(target_table=_S, last_processed_ts=_L)

BRONZE_TABLE = "bronze_dev_iam_public_iam_denormalized"
FACT_TABLE = "fact_access_grant"
HISTORY_TABLE = "fact_access_grant_history"
ACTIVE_VIEW = "current_active_access"
WATERMARK_TABLE = "gold_merge_watermark"

KNOWN_OPS = ("r", "c", "u", "d")
# The attributes that make out access; a change of others changes the record only.
ACCESS = ("user_id", "role_id", "resource_id", "revoked_at", "is_deleted")


@dataclass(frozen=True)
class ChangeSpec:
    """Which columns of a change log play which part."""

    key: tuple[str, ...] = ("grant_id",)
    attributes: tuple[str, ...] = (
        "user_id", "role_id", "resource_id", "granted_at", "revoked_at", "updated_at", "is_deleted",
    )
    # Overwritten in the current-state row by later events; the other attributes keep
    # the value they were inserted with.
    updated: tuple[str, ...] = ("role_id", "resource_id", "revoked_at", "updated_at", "is_deleted")
    # Carried into a history period, before its start, end and flags.
    versioned: tuple[str, ...] = ("user_id", "role_id", "resource_id", "granted_at", "revoked_at")
    updated_at: str = "updated_at"
    revoked_at: str = "revoked_at"
    soft_delete: str = "is_deleted"
    op: str = "__op"
    capture_ns: str = "__source_ts_ns"
    sequence: str = "event_id"
    cursor: tuple[str, ...] = field(default=("__source_ts_ns",))

    @property
    def order(self) -> tuple[str, str]:
        return (self.capture_ns, self.sequence)

    @property
    def inserted_only(self) -> tuple[str, ...]:
        return tuple(c for c in self.attributes if c not in self.updated)

    @property
    def fact_columns(self) -> tuple[str, ...]:
        return self.key + self.attributes

    @property
    def history_columns(self) -> tuple[str, ...]:
        return self.key + self.versioned + (
            "effective_start", "effective_end", "is_current", "is_deleted",
        )


GRANTS = ChangeSpec()


@dataclass(frozen=True)
class Dimension:
    """A table of the versions of what a column of the log names: the key first, then attributes."""

    name: str
    schema: T.StructType
    surrogate: str

    @property
    def key(self) -> str:
        return self.schema.names[0]

    @property
    def attributes(self) -> tuple[str, ...]:
        return tuple(self.schema.names[1:])

    @property
    def stored(self) -> T.StructType:
        """The key of the key, which stays, and a period for each version."""
        return T.StructType(
            [
                T.StructField(self.surrogate, _L),
                *self.schema.fields,
                *_struct(effective_start=_N, effective_end=_N, is_current=_B).fields,
            ]
        )

    def spec(self, log: ChangeSpec = GRANTS) -> ChangeSpec:
        """The log's events as those of this dimension."""
        own = self.attributes
        return replace(log, key=(self.key,), attributes=own, updated=own, versioned=own)


GRANT_DIMENSIONS = (
    Dimension("dim_user", DIM_USER_SCHEMA, "user_sk"),
    Dimension("dim_role", DIM_ROLE_SCHEMA, "role_sk"),
    Dimension("dim_resource", DIM_RESOURCE_SCHEMA, "resource_sk"),
)
