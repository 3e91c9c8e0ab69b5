"""Versioned gold tables on plain Parquet.

A merge writes new files and then publishes them, with the cursor, in one small commit
record. Readers follow the newest record, so they see a whole merge or none of it.

  history/batch=B/is_current=false/slot=<day of effective_end>     added to only
  history/batch=B/is_current=true/slot=<bucket of the key>         replaced per bucket
  current/batch=B/slot=<bucket of the key>                         replaced per bucket
  dims/<name>/...                                                  versions, as history
  quarantine/batch=B
  taken/batch=B/capture_day=D                                      who was merged
  _commits/<version>.json

A merge rewrites the buckets its keys fall in, not the closed history.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from grantchron.functions.times import capture_time
from grantchron.model import (
    FACT_SCHEMA,
    GRANTS,
    HISTORY_SCHEMA,
    HISTORY_TABLE,
    WATERMARK_SCHEMA,
    ChangeSpec,
    Dimension,
)
from grantchron.operators.batch import identity_columns


MANY_BATCHES = 100  # from which a table's folders are not named to the reader one by one
ATOMIC_RENAME = ("file", "hdfs", "abfs", "abfss")


class CommitConflict(RuntimeError):
    """Another writer published this version first."""


@dataclass(frozen=True)
class Commit:
    version: int = 0
    cursor: list[int] | None = None
    # Newest micro-batch taken from each source: a stream by its id, or runs by the cursor.
    streams: dict[str, int] = field(default_factory=dict)
    closed: list[str] = field(default_factory=list)  # batches with closed periods
    open: dict[str, str] = field(default_factory=dict)  # bucket -> batch holding it
    current: dict[str, str] = field(default_factory=dict)  # bucket -> batch holding it
    quarantine: list[str] = field(default_factory=list)
    taken: list[str] = field(default_factory=list)  # batches whose events are known by identity
    changes: str = "record"  # what starts a period: a change of the record, or of access only
    # Of each dimension the batches with closed versions, bucket -> batch with open ones, and keys given.
    dims: dict[str, dict] = field(default_factory=dict)
    # Fingerprints (`audit`): of buckets of current and open, of batches of closed.
    prints: dict[str, dict[str, list]] = field(default_factory=dict)
    events: int = 0  # taken so far, fit or not


class GoldStore:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        spec: ChangeSpec = GRANTS,
        buckets: int = 8,
        fact_schema: T.StructType = FACT_SCHEMA,
        history_schema: T.StructType = HISTORY_SCHEMA,
        dimensions: tuple[Dimension, ...] = (),
    ):
        """buckets: fixed for the life of the store; about live rows / 1-2 million.

        dimensions are loaded by the same merges; bronze must have their columns.
        """
        self.spark, self.path, self.spec, self.buckets = spark, path.rstrip("/"), spec, buckets
        self.fact_schema, self.history_schema = fact_schema, history_schema
        self.dimensions = tuple(dimensions)

    def with_session(self, spark: SparkSession) -> "GoldStore":
        schemas = self.fact_schema, self.history_schema, self.dimensions
        return GoldStore(spark, self.path, self.spec, self.buckets, *schemas)

    # -- commit records ------------------------------------------------------------

    def _hadoop(self):
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_commits")
        return jvm, folder, folder.getFileSystem(conf), conf

    def commits(self, newest: int) -> list[Commit]:
        """The newest versions, the very newest first."""
        jvm, folder, fs, _ = self._hadoop()
        names = [n for n in _names(fs, folder) if n.endswith(".json") and n[0] not in "._"]
        found = []
        for name in sorted(names, reverse=True)[:newest]:
            stream = fs.open(jvm.org.apache.hadoop.fs.Path(folder, name))
            try:
                text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            found.append(Commit(**json.loads(text)))
        return found

    def latest(self) -> Commit:
        return next(iter(self.commits(1)), Commit())

    def publish(self, commit: Commit) -> None:
        """Make a version visible by one rename, which fails if the version exists.

        Only file systems on which a rename is one step, and not onto an existing file, will
        do; object stores that copy instead would let two writers publish one version.
        """
        jvm, folder, fs, conf = self._hadoop()
        scheme = fs.resolvePath(folder.getParent()).toUri().getScheme() if fs.exists(
            folder.getParent()
        ) else fs.getScheme()
        if scheme not in ATOMIC_RENAME:
            raise ValueError(f"{scheme}: has no exclusive rename; keep the store on {ATOMIC_RENAME}")
        fs.mkdirs(folder)
        draft = jvm.org.apache.hadoop.fs.Path(folder, f"_{uuid.uuid4().hex}")
        out = fs.create(draft)
        try:
            out.write(bytearray(json.dumps(asdict(commit)), "utf-8"))
        finally:
            out.close()
        final = jvm.org.apache.hadoop.fs.Path(folder, f"{commit.version:012d}.json")
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), conf)
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        try:
            context.rename(draft, final, options)
        except Exception as e:
            fs.delete(draft, False)
            if fs.exists(final):
                raise CommitConflict(f"version {commit.version} exists") from e
            raise

    # -- reading -------------------------------------------------------------------

    def _read(self, table: str, schema: T.StructType, batches, partitions) -> DataFrame:
        schema = T.StructType(
            [f for f in schema.fields if f.name not in dict(partitions)]
            + [T.StructField(n, t) for n, t in (("batch", T.StringType()), *partitions)]
        )
        root = f"{self.path}/{table}"
        if not batches:
            return empty(self.spark, schema)
        if len(batches) > MANY_BATCHES:  # tasks list the folders, and the predicate picks them
            return self.spark.read.schema(schema).parquet(root).filter(F.col("batch").isin(list(batches)))
        paths = [f"{root}/batch={b}" for b in batches]
        return self.spark.read.schema(schema).option("basePath", root).parquet(*paths)

    @staticmethod
    def _live(slots: dict[str, str]) -> Column:
        """Partition predicate: each bucket from the one batch that holds it, as one flat list."""
        held = [f"{batch}/{slot}" for slot, batch in slots.items()]
        return F.concat_ws("/", "batch", "slot").isin(held) if held else F.lit(False)

    def current(self, commit: Commit | None = None, buckets=None) -> DataFrame:
        """The current-state table, or some buckets of it."""
        commit = commit or self.latest()
        slots = _pick(commit.current, buckets)
        rows = self._read("current", self.fact_schema, sorted(set(slots.values())), _SLOT)
        return rows.filter(self._live(slots)).select(*self.fact_schema.names)

    def open_periods(
        self, commit: Commit | None = None, buckets=None, with_pending: bool = False
    ) -> DataFrame:
        commit = commit or self.latest()
        slots = _pick(commit.open, buckets)
        rows = self._read("history", self._periods, sorted(set(slots.values())), _PERIOD)
        # Stored with the open ones are pending periods, whose end an event may still change.
        is_open = F.col("effective_end").isNull()
        return rows.filter(F.col("is_current") & self._live(slots)).select(
            *[is_open.alias(n) if n == "is_current" else n for n in self.history_schema.names],
            *([(~is_open).alias("pending"), "ending"] if with_pending else []),
        )

    @property
    def _periods(self) -> T.StructType:
        """As stored: with how a period ended."""
        return T.StructType([*self.history_schema.fields, T.StructField("ending", T.StringType())])

    def closed_periods(self, commit: Commit | None = None, batches=None, endings: bool = False) -> DataFrame:
        commit = commit or self.latest()
        rows = self._read("history", self._periods, commit.closed if batches is None else batches, _PERIOD)
        return rows.filter(~F.col("is_current")).select(
            *[F.lit(False).alias(n) if n == "is_current" else n for n in self.history_schema.names],
            # The filter on folders may meet the buckets' names, which are no dates.
            F.col("slot").try_cast("date").alias("end_day"),
            *(["ending"] if endings else []),
        )

    def history(self, commit: Commit | None = None, endings: bool = False) -> DataFrame:
        """All periods, with the end_day (null if open) that questions about a time prune by.

        endings adds how each ended, as the merge that closed it saw (A6): by a hard delete, by a
        revocation, or replaced by the next version; without an event to end it, it is open or,
        with an end that it arrived with, revoked.
        """
        commit = commit or self.latest()
        now = self.open_periods(commit, with_pending=True).drop("pending")
        now = now.withColumn("end_day", F.col("effective_end").cast("date"))
        found = self.closed_periods(commit, endings=True).unionByName(now)
        if not endings:
            return found.drop("ending")
        return found.withColumn("ending", F.when(F.col("is_current"), F.lit("open")).otherwise(F.col("ending")))

    def open_versions(self, dim: Dimension, commit: Commit, buckets=None) -> DataFrame:
        slots = _pick(commit.dims.get(dim.name, {}).get("open", {}), buckets)
        rows = self._read(f"dims/{dim.name}", dim.stored, sorted(set(slots.values())), _PERIOD)
        return rows.filter(F.col("is_current") & self._live(slots)).select(*dim.stored.names)

    def dimension(self, dim: Dimension, commit: Commit | None = None) -> DataFrame:
        """All versions, each with its surrogate key."""
        commit = commit or self.latest()
        closed = commit.dims.get(dim.name, {}).get("closed", [])
        rows = self._read(f"dims/{dim.name}", dim.stored, closed, _PERIOD)
        ended = rows.filter(~F.col("is_current")).select(*dim.stored.names)
        return ended.unionByName(self.open_versions(dim, commit))

    def quarantine(self, commit: Commit | None = None) -> DataFrame | None:
        commit = commit or self.latest()
        paths = [f"{self.path}/quarantine/batch={b}" for b in commit.quarantine]
        return self.spark.read.parquet(*paths) if paths else None

    def taken(self, commit: Commit) -> DataFrame:
        """The identities of merged events, in a folder for each capture day."""
        fields = [f for f in self._identity.fields if f.name != "capture_day"]
        return self._read("taken", T.StructType(fields), commit.taken, _DAY)

    @property
    def _identity(self) -> T.StructType:
        kinds = {f.name: f.dataType for f in self.fact_schema.fields}
        key = [T.StructField(k, kinds[k]) for k in self.spec.key]
        rest = [T.StructField(c, T.LongType()) for c in (*self.spec.order, "digest")]
        return T.StructType([*key, *rest])

    def write_taken(self, events: DataFrame, batch: str) -> None:
        """events: with the column digest that `identity` gives them."""
        day = capture_time(self.spec.capture_ns).cast("date")
        rows = events.withColumn("capture_day", day).select(*identity_columns(self.spec))
        rows.hint("rebalance", F.col("capture_day")).write.partitionBy("capture_day").parquet(
            f"{self.path}/taken/batch={batch}"
        )

    def bytes_staged(self, batch: str) -> int:
        jvm, _, fs, _ = self._hadoop()
        folder = jvm.org.apache.hadoop.fs.Path(self.staged(batch))
        return fs.getContentSummary(folder).getLength()

    def watermark(self) -> DataFrame:
        """M4: the cursor as a table."""
        cursor = self.latest().cursor
        if not cursor:
            return empty(self.spark, WATERMARK_SCHEMA)
        return self.spark.createDataFrame([(HISTORY_TABLE, cursor[0])], WATERMARK_SCHEMA)

    # -- writing -------------------------------------------------------------------

    def bucket(self, *key: str) -> Column:
        return F.pmod(F.xxhash64(*(key or self.spec.key)), F.lit(self.buckets)).cast("string")

    def write_history(self, rows: DataFrame, batch: str) -> None:
        if "pending" in rows.columns:
            rows = rows.withColumn("is_current", F.col("is_current") | F.col("pending")).drop("pending")
        self._write_periods(rows, f"history/batch={batch}", self.bucket())

    def write_dimension(self, dim: Dimension, rows: DataFrame, batch: str) -> None:
        self._write_periods(rows, f"dims/{dim.name}/batch={batch}", self.bucket(dim.key))

    def _write_periods(self, rows: DataFrame, folder: str, bucket: Column) -> None:
        """Rows are gathered by folder, and sorted so that row groups can be skipped by start."""
        day = F.date_format(F.col("effective_end"), "yyyy-MM-dd")
        placed = rows.withColumn("slot", F.when(F.col("is_current"), bucket).otherwise(day))
        placed.hint("rebalance", F.col("is_current"), F.col("slot")).sortWithinPartitions(
            "is_current", "slot", "effective_start", "effective_end"
        ).write.partitionBy("is_current", "slot").parquet(f"{self.path}/{folder}")

    def write_current(self, rows: DataFrame, batch: str) -> None:
        placed = rows.withColumn("slot", self.bucket())
        placed.hint("rebalance", F.col("slot")).sortWithinPartitions(
            "slot", *self.spec.key
        ).write.partitionBy("slot").parquet(f"{self.path}/current/batch={batch}")

    def write_quarantine(self, rows: DataFrame, batch: str) -> None:
        rows.write.parquet(f"{self.path}/quarantine/batch={batch}")

    def compact(self) -> Commit:
        """Gather the closed periods and identities of many merges into one batch.

        Answers do not change.
        """
        commit = self.latest()
        if len(commit.closed) < 2:
            return commit
        batch = new_batch(commit.version + 1)
        self.write_history(self.closed_periods(commit, endings=True).drop("end_day"), batch)
        self.write_taken(self.taken(commit), batch)
        closed = {batch: added_up(commit.prints["closed"].values())} if "closed" in commit.prints else {}
        prints = {**commit.prints, "closed": closed} if closed else {}
        compacted = replace(commit, version=commit.version + 1, closed=[batch], taken=[batch], prints=prints)
        self.publish(compacted)
        return compacted

    def vacuum(self, keep_versions: int = 2) -> int:
        """Delete files that the newest versions do not use; returns how many folders.

        Files of a merge that has not published yet stay.
        """
        jvm, _, fs, _ = self._hadoop()
        kept = self.commits(keep_versions)
        newest = max((c.version for c in kept), default=0)
        periods = {"history": ({b for c in kept for b in c.closed}, {b for c in kept for b in c.open.values()})}
        for name in {n for c in kept for n in c.dims}:
            states = [c.dims[name] for c in kept if name in c.dims]
            closed, opened = ({b for s in states for b in s["closed"]}, {b for s in states for b in s["open"].values()})
            periods[f"dims/{name}"] = closed, opened
        current = {b for c in kept for b in c.current.values()}
        taken = {b for c in kept for b in c.taken}
        unused = [f"_staging/{n}" for n in self._batches("_staging", newest)]
        unused += [f"current/{n}" for n in self._batches("current", newest) if n[6:] not in current]
        unused += [f"taken/{n}" for n in self._batches("taken", newest) if n[6:] not in taken]
        for table, (closed, opened) in periods.items():
            for name in self._batches(table, newest):
                if name[6:] not in closed | opened:
                    unused.append(f"{table}/{name}")
                elif name[6:] not in opened:
                    unused.append(f"{table}/{name}/is_current=true")
        paths = [jvm.org.apache.hadoop.fs.Path(f"{self.path}/{u}") for u in unused]
        return sum(fs.exists(p) and fs.delete(p, True) for p in paths)

    def _batches(self, table: str, newest: int) -> list[str]:
        jvm, _, fs, _ = self._hadoop()
        names = _names(fs, jvm.org.apache.hadoop.fs.Path(f"{self.path}/{table}"))
        return [n for n in names if n.startswith("batch=") and int(n[6:18]) <= newest]

    def drop_staged(self, batch: str) -> None:
        jvm, folder, fs, _ = self._hadoop()
        for part in ("", *(f"{dim.name}{of}" for dim in self.dimensions for of in ("", "-told"))):
            fs.delete(jvm.org.apache.hadoop.fs.Path(self.staged(batch, part)), True)

    def stage(self, rows: DataFrame, batch: str, part: str = "") -> DataFrame:
        """The rows as written for later steps of this merge, which drop_staged removes."""
        path = self.staged(batch, part)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def staged(self, batch: str, part: str = "") -> str:
        return f"{self.path}/_staging/batch={batch}{part and '-'}{part}"

    def reset(self) -> None:
        """M6: drop everything the store holds."""
        _, folder, fs, _ = self._hadoop()
        fs.delete(folder.getParent(), True)


_SLOT = (("slot", T.StringType()),)
_DAY = (("capture_day", T.DateType()),)
_PERIOD = (("is_current", T.BooleanType()), ("slot", T.StringType()))


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, in a form the optimizer removes joins with."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*columns).filter(F.lit(False))


def added_up(prints) -> list:
    """Fingerprints [rows, sum, sum] of parts as that of all of them; sums are kept as text."""
    prints = list(prints)
    return [sum(p[0] for p in prints), *(str(sum(int(p[i]) for p in prints)) for i in (1, 2))]


def _names(fs, folder) -> list[str]:
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def _pick(slots: dict[str, str], buckets) -> dict[str, str]:
    return slots if buckets is None else {b: slots[b] for b in buckets if b in slots}


def new_batch(version: int) -> str:
    return f"{version:012d}-{uuid.uuid4().hex[:8]}"
