"""Keyed, versioned tables ("feature groups") on plain Parquet.

A table spec is ``{name, version, primary_key, event_time}``; its data lives under
``<root>/<name>_v<version>`` in immutable folders that a manifest names
(``manifest.py``). Rows are dealt to a period (the month of the event time, where that
is part of the key or the option ``stable_event_time`` says that a key never changes
it; else one period holds all) and to a bucket of the key's hash, of about
``rows_per_bucket`` rows.

*Upsert*: for every primary key the last batch wins (also with an older event time, a
correction); within a batch the latest event time does. The option ``conflict:
event_time`` keeps the latest event time over all batches instead, and ``order`` names
columns that decide between rows of one batch and event time.

A batch is appended to the buckets it meets as deltas, without reading them; readers
merge base and deltas of a bucket by key. A bucket is rewritten (compacted) when its deltas
reach ``DELTA_SHARE`` of its base or ``MAX_DELTAS`` in number, or when it is split
because its period has outgrown its buckets. Compaction is paid from a credit of ``COMPACT`` rows per
row upserted, so an upsert reads and writes at most ``1 + COMPACT`` times its batch and
one bucket on average, whatever the size of the table; ``compact`` does the rest at once.

*Failures*: nothing is overwritten and the manifest comes last, so a death at any point
leaves the rows of the last complete upsert; running the batch again repeats it. Old
folders, those of dead upserts among them, stay for readers until ``vacuum`` (the option
``retain`` calls it after every upsert and keeps so many versions). One writer
a table at a time: a second one fails at its commit.

The merge is an aggregate, not a window: ``max_by(row, (batch, event_time))``
per key with map-side partial aggregation, so a hot key (many updates of one
key in a batch) is collapsed before the shuffle instead of sorted in one task.
"""

from __future__ import annotations

import datetime
import json
import os
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ROWS_PER_PARTITION, list_names, partitions_for, read_small, remove_path, \
    shuffles_removed, write_parts
from .manifest import Folder, Manifest, Slot, address, commit, manifest_path, numbers, power, \
    resolve, split_source

BATCH = "_batch"
KIND, PERIOD, BUCKET = "_kind", "_period", "_bucket"     # names of folders
BASE, DELTA = "base", "delta"
ROWS_PER_BUCKET = 1_000_000
DELTA_SHARE, MAX_DELTAS, COMPACT = 0.25, 64, 8
# A write of more shuffle partitions' rows than these: is looked through for repeated keys, is
# done in groups of periods.
LOOK, GROUP = 5, 160


@dataclass(frozen=True)
class TableSpec:
    name: str
    version: int
    primary_key: tuple[str, ...]
    event_time: str
    options: Mapping[str, object] = field(default_factory=dict)

    @property
    def by_period(self) -> bool:
        return bool(self.options.get("stable_event_time", self.event_time in self.primary_key))

    @property
    def rank(self) -> tuple[str, ...]:
        """What decides between rows of one key, most important first."""
        first = ((self.event_time, BATCH) if self.options.get("conflict") == "event_time"
                 else (BATCH, self.event_time))
        return (*first, *self.options.get("order", ()))

    @property
    def rows_per_bucket(self) -> int:
        return int(self.options.get("rows_per_bucket", ROWS_PER_BUCKET))

    def location(self, root: str) -> str:
        return os.path.join(root, f"{self.name}_v{self.version}")


def load_catalog(spec: Mapping[str, Mapping], version: int) -> dict[str, TableSpec]:
    """Catalog from a parsed YAML mapping: the name defaults to the reference
    key, the version is injected."""
    out = {}
    for ref, body in spec.items():
        body = dict(body)
        out[ref] = TableSpec(name=body.pop("name", ref), version=version,
                             primary_key=tuple(body.pop("primary_key")),
                             event_time=body.pop("event_time"), options=body)
    return out


def load_catalog_yaml(path: str, version: int) -> dict[str, TableSpec]:
    import yaml  # optional dependency, only for YAML catalogs
    with open(path) as fh:
        return load_catalog(yaml.safe_load(fh), version)


def latest_by_key(rows: DataFrame, primary_key: Sequence[str], event_time: str,
                  order_extra: Sequence[str] = (BATCH,)) -> DataFrame:
    """One row per key: the one with the greatest (event_time, *order_extra)."""
    return greatest_by_key(rows, primary_key, (
        event_time, *[o for o in order_extra if o in rows.columns]))


def greatest_by_key(rows: DataFrame, primary_key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the greatest ``order`` columns."""
    payload = [c for c in rows.columns if c not in primary_key]
    agg = rows.groupBy(*primary_key).agg(
        F.max_by(F.struct(*[F.col(c) for c in payload]),
                 F.struct(*[F.col(c) for c in order])).alias("__row"))
    return agg.select(*primary_key, *[F.col(f"__row.{c}").alias(c) for c in payload]) \
              .select(*rows.columns)


def merge_upsert(current: DataFrame | None, batch: DataFrame, spec: TableSpec,
                 batch_id: int) -> DataFrame:
    """The table after upserting ``batch`` into ``current`` (pure plan)."""
    new = batch.withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    if current is None:
        merged = new
    else:
        cur = current if BATCH in current.columns else current.withColumn(BATCH, F.lit(-1).cast("bigint"))
        merged = cur.unionByName(new, allowMissingColumns=True)
    return greatest_by_key(merged, spec.primary_key, spec.rank)


class FeatureStore:
    """Tables under one shared root (e.g. the cluster's checkpoint folder)."""

    def __init__(self, spark: SparkSession, root: str, catalog: Mapping[str, TableSpec]):
        self.spark, self.root, self.catalog = spark, root, dict(catalog)

    # -- layout ---------------------------------------------------------------
    def manifest(self, ref: str) -> Manifest | None:
        """The table's current state; None for a table that was never begun."""
        return resolve(self.spark, self.catalog[ref].location(self.root))

    @staticmethod
    def _period(spec: TableSpec) -> Column:
        return F.coalesce(F.date_format(spec.event_time, "yyyy-MM"), F.lit("none")) \
            if spec.by_period else F.lit("all")

    def _placed(self, df: DataFrame, spec: TableSpec, buckets: Mapping[str, int]) -> DataFrame:
        """The rows with the slot each belongs to. ``buckets`` has one entry a period."""
        if not spec.by_period:
            n = buckets.get("all", 1)
            return df.withColumn(PERIOD, F.lit("all")).withColumn(BUCKET, address(
                F.xxhash64(*[F.col(k) for k in spec.primary_key]), F.lit(n), F.lit(power(n))))
        known = self.spark.createDataFrame([(p, n, power(n)) for p, n in buckets.items()],
                                           f"{PERIOD} string, _n int, _power long")
        cols = [F.col(f"`{c}`") for c in df.columns]
        # one row a period, from the driver's own list
        return df.withColumn(PERIOD, self._period(spec)).join(F.broadcast(known), PERIOD).select(
            *cols, PERIOD, address(F.xxhash64(*[F.col(k) for k in spec.primary_key]),
                                   F.col("_n"), F.col("_power")).alias(BUCKET))

    def _rows(self, spec: TableSpec, m: Manifest, slots: Sequence[Slot]) -> DataFrame | None:
        """All stored rows of the slots, several for a key that has deltas."""
        paths = [os.path.join(spec.location(self.root), f.path) for s in slots for f in s.folders]
        schema = T.StructType.fromJson(json.loads(m.schema)) if m.schema else None
        return self.spark.read.schema(schema).parquet(*paths) if paths else None

    def _current(self, spec: TableSpec, m: Manifest, slots: Sequence[Slot]) -> DataFrame:
        """One row a key: bases without deltas as they are, the others merged."""
        plain = self._rows(spec, m, [s for s in slots if not s.deltas])
        mixed = self._rows(spec, m, [s for s in slots if s.deltas])
        if mixed is not None:
            mixed = greatest_by_key(mixed, spec.primary_key, spec.rank)
        if plain is None or mixed is None:
            one = plain if mixed is None else mixed
            return one if one is not None else self.spark.createDataFrame(
                [], T.StructType.fromJson(json.loads(m.schema)))
        return plain.unionByName(mixed)

    # -- API ------------------------------------------------------------------
    def read(self, ref: str, where: Callable[[DataFrame], Column] | str | None = None,
             since: datetime.date | None = None) -> DataFrame:
        """Current rows; ``where`` (Column builder or SQL) is pushed down into bases without
        deltas, elsewhere it follows the merge. ``since``: of a table kept by period, only the
        months from this day's on, and rows without an event time, are read."""
        spec, m = self.catalog[ref], self.manifest(ref)
        if m is None or m.last is None:
            raise FileNotFoundError(f"table {spec.name} v{spec.version} does not exist")
        first = "" if since is None or not spec.by_period else f"{since:%Y-%m}"
        df = self._current(spec, m, [s for (p, _), s in m.slots.items() if p >= first]).drop(BATCH)
        if where is None:
            return df
        return df.where(where if isinstance(where, str) else where(df))

    def read_or_empty(self, ref: str, schema, where=None) -> DataFrame:
        """A missing table reads as an empty frame; other errors (lost state among
        them) surface."""
        try:
            return self.read(ref, where)
        except FileNotFoundError:
            return self.spark.createDataFrame([], schema)

    def lookup(self, ref: str, keys: DataFrame) -> DataFrame:
        """Current rows of the given keys, reading only the buckets that the keys fall in.

        ``keys`` holds the primary key and, for a table kept by period, the event time;
        repeated keys count once, unknown and null ones find nothing. The list of buckets
        met, at most one entry a bucket, is all the driver sees. ``keys`` is read twice, so
        it should be a landed frame or a micro-batch."""
        spec, m = self.catalog[ref], self.manifest(ref)
        if m is None or m.last is None:
            raise FileNotFoundError(f"table {spec.name} v{spec.version} does not exist")
        named = list(dict.fromkeys([*spec.primary_key, *([spec.event_time] if spec.by_period else [])]))
        stored = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(m.schema))}
        # the stored types: a key's hash, and so its bucket, depends on its type
        keys = keys.select(*[F.col(k).cast(stored[k]).alias(k) for k in named])
        met = {(r[0], r[1]) for r in self._placed(keys, spec, m.buckets).select(
            PERIOD, BUCKET).distinct().collect()}
        rows = self._current(spec, m, [s for k, s in m.slots.items() if k in met])
        return rows.drop(BATCH).join(keys.select(*spec.primary_key), list(spec.primary_key),
                                     "left_semi")

    def changes(self, ref: str, after: int) -> DataFrame:
        """Current rows of the keys that batches later than ``after`` wrote; folders that
        hold no such batch are not read. Keeps the batch in ``_batch``."""
        spec, m = self.catalog[ref], self.manifest(ref)
        if m is None or m.last is None:
            raise FileNotFoundError(f"table {spec.name} v{spec.version} does not exist")
        late = [Slot(None, [f for f in s.folders if f.batch > after]) for s in m.slots.values()]
        rows = self._rows(spec, m, late)
        if rows is None:
            return self.spark.createDataFrame([], T.StructType.fromJson(json.loads(m.schema)))
        return greatest_by_key(rows.where(F.col(BATCH) > after), spec.primary_key, spec.rank)

    def upsert(self, ref: str, batch: DataFrame | Iterable[DataFrame],
               batch_id: int | None = None, *, landed: bool = False) -> int | None:
        """Insert / overwrite by primary key; empty input is a no-op.
        Returns the batch id used (None when nothing was written). A batch of several frames is
        landed one frame after the other. ``landed``: the rows are a projection of stored ones,
        cheap to read again and the same each time, so no copy is made of them."""
        spec = self.catalog[ref]
        at = spec.location(self.root)
        m = self.manifest(ref)
        if m is None:
            m = Manifest()
            commit(self.spark, at, m)
        # the batch is read several times below: land it once in the shared folder
        work = os.path.join(at, f"_work-{uuid.uuid4().hex}")
        rows = batch if landed else self._land(batch, work)
        counts = {r[0]: r[1] for r in rows.groupBy(self._period(spec)).count().collect()}
        bid = (0 if m.last is None else m.last + 1) if batch_id is None else batch_id
        if counts:
            new = rows.withColumn(BATCH, F.lit(bid).cast("bigint"))
            plan = self._plan(spec, m, counts)
            plan.moved = self._moved(m, plan, counts)
            with self._partitions(spec, plan):
                commit(self.spark, at, self._write(spec, m, new, plan, bid))
        remove_path(self.spark, work)
        if counts and "retain" in spec.options:
            self.vacuum(ref, int(spec.options["retain"]))
        return bid if counts else None

    def compact(self, ref: str) -> None:
        """Rewrites every bucket that has deltas, so that reading needs no merge."""
        spec, m = self.catalog[ref], self.manifest(ref)
        if m is not None and any(s.deltas for s in m.slots.values()):
            plan = _Plan(dict(m.buckets), {k for k, s in m.slots.items() if s.deltas}, m.credit)
            plan.moved = self._moved(m, plan, {})
            with self._partitions(spec, plan):
                commit(self.spark, spec.location(self.root),
                       self._write(spec, m, None, plan, m.last))

    def vacuum(self, ref: str, keep: int = 1) -> None:
        """Deletes what the last ``keep`` manifests do not name: older versions and the
        rests of dead upserts. No writer may be at work."""
        spec = self.catalog[ref]
        at, spark = spec.location(self.root), self.spark
        seqs = sorted(numbers(spark, at))
        held = set()
        for seq in seqs[-keep:]:
            held |= {f.path for f in Manifest.load(read_small(spark, manifest_path(at, seq))).folders}
        for seq in seqs[:-keep]:
            remove_path(spark, manifest_path(at, seq))
        for version in list_names(spark, os.path.join(at, "data")):
            top = os.path.join("data", version)
            if not any(p.startswith(top + "/") for p in held):
                remove_path(spark, os.path.join(at, top))
                continue
            for kind in list_names(spark, os.path.join(at, top)):
                for period in list_names(spark, os.path.join(at, top, kind)):
                    for bucket in list_names(spark, os.path.join(at, top, kind, period)):
                        path = os.path.join(top, kind, period, bucket)
                        if bucket.startswith(BUCKET) and path not in held:
                            remove_path(spark, os.path.join(at, path))
        for name in list_names(spark, at):
            if name.startswith("_work-"):
                remove_path(spark, os.path.join(at, name))

    # -- steps of an upsert ------------------------------------------------------
    def _land(self, batch: DataFrame | Iterable[DataFrame], work: str) -> DataFrame:
        """The batch written aside, compressed; read by the store's own session (a micro-batch
        has another)."""
        landed = write_parts([batch] if isinstance(batch, DataFrame) else batch, work)
        return self.spark.read.schema(landed.schema).parquet(work)

    def _plan(self, spec: TableSpec, m: Manifest, counts: Mapping[str, int]) -> _Plan:
        """Buckets after the batch, and the slots to rewrite: those that are split, and as
        many that are due as the credit allows."""
        n = sum(counts.values())
        stored, buckets = m.rows_by_period(), dict(m.buckets)
        rewrite: set[tuple[str, int]] = set()
        for period, more in counts.items():
            before = buckets.get(period, 0)
            rows = stored.get(period, 0) + more
            after = max(before, -(-rows // spec.rows_per_bucket),
                        1 if before else int(spec.options.get("buckets", 1)))
            buckets[period] = after
            for b in range(before, after):
                while b >= before > 0:
                    b = split_source(b)
                if before:
                    rewrite.add((period, b))
        slots = {k: s for k, s in m.slots.items()}
        most = max((s.rows for s in slots.values()), default=0)
        credit = min(m.credit, most) + COMPACT * n - sum(
            slots[k].rows for k in rewrite if k in slots)
        due = [(s.delta_rows / max(1, s.base.rows if s.base else 0), len(s.deltas), k)
               for k, s in slots.items() if k not in rewrite and s.deltas]
        for share, number, k in sorted(due, reverse=True):
            if number >= MAX_DELTAS or (share >= DELTA_SHARE and slots[k].rows <= credit):
                rewrite.add(k)
                credit -= slots[k].rows
        return _Plan(buckets, rewrite, max(0, credit))

    @staticmethod
    def _moved(m: Manifest, plan: _Plan, counts: Mapping[str, int]) -> dict[str, int]:
        """Rows that a write moves, by period."""
        out = dict(counts)
        for p, b in plan.rewrite:
            if (p, b) in m.slots:
                out[p] = out.get(p, 0) + m.slots[p, b].rows
        return out

    def _partitions(self, spec: TableSpec, plan: _Plan):
        """Shuffle partitions by the rows moved; a table of wide rows has small buckets, and
        fewer rows suit a partition."""
        return partitions_for(self.spark, sum(plan.moved.values()),
                              min(ROWS_PER_PARTITION, spec.rows_per_bucket))

    def _repeats(self, spec: TableSpec, rows: DataFrame) -> tuple[bool, bool]:
        """(some key has several rows, some key's rows lie in several periods). Hashes are
        counted, not keys; two keys of one hash only make a merge that has nothing to do."""
        r = rows.groupBy(F.xxhash64(*[F.col(k) for k in spec.primary_key]).alias("_h")).agg(
            F.count(F.lit(1)).alias("n"), F.min(F.xxhash64(self._period(spec))).alias("a"),
            F.max(F.xxhash64(self._period(spec))).alias("b")).where("n > 1").agg(
            F.count(F.lit(1)), F.count_if(F.col("a") != F.col("b"))).first()
        return r[0] > 0, r[1] > 0

    def _write(self, spec: TableSpec, m: Manifest, new: DataFrame | None, plan: _Plan,
               bid: int) -> Manifest:
        """Writes one folder of deltas and rewritten slots; the manifest that names it.

        A large write goes through the periods in groups, each with its own shuffles, which go
        with it; so its disk is the table's and that of a group. That needs keys that stay in their
        period, and without repeated keys no merge, hence a look at the keys' hashes first."""
        spark, at = self.spark, spec.location(self.root)
        keeps = {k: s for k, s in m.slots.items() if k not in plan.rewrite}
        old = self._rows(spec, m, [m.slots[k] for k in sorted(plan.rewrite) if k in m.slots])
        merged, deltas = old, None
        if new is not None:
            # slots that stay take deltas, all others are written as bases
            stays = spark.createDataFrame(
                [k for k in keeps], f"{PERIOD} string, {BUCKET} int").withColumn("_stays", F.lit(True))
            # one row a slot, from the driver's own manifest
            sent = self._placed(new, spec, plan.buckets).join(
                F.broadcast(stays), [PERIOD, BUCKET], "left") if keeps else new
            deltas = sent.where("_stays").select(*new.columns) if keeps else None
            begun = sent.where("_stays is null").select(*new.columns) if keeps else new
            merged = begun if old is None else old.unionByName(begun, allowMissingColumns=True)
        schema = merged.schema
        if m.schema:      # columns that only older rows have stay
            known = T.StructType.fromJson(json.loads(m.schema))
            schema = T.StructType(schema.fields + [f for f in known if f.name not in schema.names])
        seq = m.seq + 1
        version = os.path.join("data", f"{seq:012}-{uuid.uuid4().hex[:8]}")
        path = os.path.join(at, version)
        moved = plan.moved
        total, most = sum(moved.values()), min(ROWS_PER_PARTITION, spec.rows_per_bucket)
        repeated = spread = True
        if total > LOOK * most:
            with shuffles_removed(spark):
                repeated, spread = self._repeats(spec, merged)
        groups = [None] if spread or not spec.by_period else grouped(moved, GROUP * most)
        for periods in groups:
            def of_group(df: DataFrame, periods=periods) -> DataFrame:
                return df if periods is None or len(groups) == 1 else df.where(
                    self._period(spec).isin(periods))
            out = of_group(merged)
            if repeated:
                out = greatest_by_key(out, spec.primary_key, spec.rank)
            out = out.withColumn(KIND, F.lit(BASE))
            if deltas is not None:
                out = out.unionByName(of_group(deltas).withColumn(KIND, F.lit(DELTA)),
                                      allowMissingColumns=True)
            with shuffles_removed(spark):
                tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                            len(plan.rewrite) + sum(plan.buckets.values()) - sum(m.buckets.values()))
                self._placed(out, spec, plan.buckets).repartition(
                    tasks, KIND, PERIOD, BUCKET).write.mode("append").option(
                    "maxRecordsPerFile", 4 * ROWS_PER_BUCKET).option(
                    "compression", "zstd").option(
                    # small buckets: no whole texts as smallest and greatest in the footers, and
                    # no dictionary for a column that mostly holds one number
                    "parquet.statistics.truncate.length", 16).option(
                    f"parquet.enable.dictionary#{BATCH}", "false").partitionBy(
                    KIND, PERIOD, BUCKET).parquet(path)
        # counted from the files' footers
        done = spark.read.schema(f"{KIND} string, {PERIOD} string, {BUCKET} int").parquet(
            path).groupBy(KIND, PERIOD, BUCKET).count().collect()
        slots = {k: replace(s, deltas=list(s.deltas)) for k, s in keeps.items()}
        for kind, period, bucket, rows in done:
            folder = Folder(os.path.join(version, f"{KIND}={kind}", f"{PERIOD}={period}",
                                         f"{BUCKET}={bucket}"), rows, bid)
            slot = slots.setdefault((period, bucket), Slot())
            if kind == BASE:
                slot.base = folder
            else:
                slot.deltas.append(folder)
        last = bid if m.last is None else max(m.last, bid)
        return Manifest(seq, last, schema.json(), plan.buckets, slots, plan.credit)


def grouped(rows: Mapping[str, int], most: int) -> list[list[str]]:
    """Periods in order, in groups of about ``most`` rows."""
    groups, size = [], most
    for period, n in sorted(rows.items()):
        if size + n > most:
            groups.append([])
            size = 0
        groups[-1].append(period)
        size += n
    return groups


@dataclass
class _Plan:
    buckets: dict[str, int]             # of every period, after the upsert
    rewrite: set[tuple[str, int]]       # slots whose rows are read and written again
    credit: int
    moved: dict[str, int] = field(default_factory=dict)     # rows that the write moves, by period
