"""Topics of landed segment files that are consumed by records.

A topic is a folder of immutable segments. Publishing deals records to partitions by
the hash of their key and writes each partition's new records as files; a numbered
register entry, written last, gives every file its partition and first offset. A record's
offset is its file's first offset plus its row in the file, so offsets are dense per partition
and never change.

A consumer belongs to a group. ``poll(limit)`` returns ``(finished, records)``: at most
``limit`` records after the group's committed offsets, shared fairly between
partitions, and whether the topic was exhausted before the limit was reached (a full
buffer is not finished). The ranges of a poll are written down before its records are
handed out, and ``commit`` writes that they are done. So after a death between the two, the
next consumer of the group polls exactly the same records under the same batch number:
at-least-once delivery, once in effect for sinks that overwrite by batch number.

Records stay distributed: the driver holds ranges and file names (one a segment), tasks
read just the files that a poll touches, and a partition with a hot key spans as many files
as its records need. Order within a partition is that of the files.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import list_names, read_small, write_small

PARTITION, OFFSET = "partition", "offset"
SEGMENT_ROWS = 100_000
DIGITS = 12


@dataclass(frozen=True)
class Segment:
    path: str          # below the topic's folder
    partition: int
    first: int         # offset of its first record
    rows: int


def _numbered(spark: SparkSession, folder: str, end: str) -> list[int]:
    return [int(n[:DIGITS]) for n in list_names(spark, folder) if n.endswith(end)]


def _entry(folder: str, seq: int, end: str) -> str:
    return os.path.join(folder, f"{seq:0{DIGITS}}{end}")


class SegmentTopic:
    """A topic in the shared folder ``path``."""

    def __init__(self, spark: SparkSession, path: str, partitions: int = 4):
        self.spark, self.path, self.partitions = spark, path, partitions

    @property
    def _register(self) -> str:
        return os.path.join(self.path, "register")

    def _entries(self) -> list[dict]:
        return [json.loads(read_small(self.spark, _entry(self._register, n, ".json")))
                for n in sorted(_numbered(self.spark, self._register, ".json"))]

    def segments(self) -> list[Segment]:
        return [Segment(*s) for e in self._entries() for s in e["segments"]]

    def schema(self) -> T.StructType | None:
        entries = self._entries()
        return T.StructType.fromJson(entries[0]["schema"]) if entries else None

    def ends(self) -> dict[int, int]:
        """Offset after the last record, by partition."""
        out: dict[int, int] = {}
        for s in self.segments():
            out[s.partition] = max(out.get(s.partition, 0), s.first + s.rows)
        return out

    def publish(self, records: DataFrame, key: str = "key", segment_rows: int = SEGMENT_ROWS) -> int:
        """Appends the records; all or, after a death, none of them are seen. One writer at a
        time. Returns their number."""
        spark = self.spark
        entries = self._entries()
        seq, ends = len(entries), self.ends()
        top = os.path.join("segments", f"{seq:0{DIGITS}}-{uuid.uuid4().hex[:8]}")
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        # the partition by key; a partition's records by content over several tasks
        at = F.pmod(F.xxhash64(F.col(key)), F.lit(self.partitions)).cast("int")
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in records.columns], F.lit(1)),
                        F.lit(max(1, n // self.partitions)))
        records.withColumn(PARTITION, at).repartition(n, F.col(PARTITION), spread).write.option(
            "maxRecordsPerFile", segment_rows).partitionBy(PARTITION).parquet(
            os.path.join(self.path, top))
        done = spark.read.schema(f"{PARTITION} int").parquet(os.path.join(self.path, top))
        files = done.groupBy(PARTITION, F.col("_metadata.file_name").alias("file")).count().orderBy(
            PARTITION, "file").collect()
        segments = []
        for part, file, rows in files:
            first = ends.get(part, 0)
            segments.append([os.path.join(top, f"{PARTITION}={part}", file), part, first, rows])
            ends[part] = first + rows
        if segments:
            write_small(spark, _entry(self._register, seq, ".json"), json.dumps(
                {"schema": json.loads(records.schema.json()), "segments": segments}))
        return sum(s[3] for s in segments)

    def read(self, ranges: dict[int, tuple[int, int]]) -> DataFrame:
        """The records with offsets in [low, high) by partition, with partition and offset."""
        spark, schema = self.spark, self.schema()
        hit = [s for s in self.segments() if s.partition in ranges
               and s.first < ranges[s.partition][1] and s.first + s.rows > ranges[s.partition][0]]
        if not hit:
            empty = T.StructType([*(schema.fields if schema else []),
                                  T.StructField(PARTITION, T.IntegerType()),
                                  T.StructField(OFFSET, T.LongType())])
            return spark.createDataFrame([], empty)
        # one row a segment of this poll, from the driver's own list
        known = spark.createDataFrame(
            [(os.path.basename(s.path), s.partition, s.first, *ranges[s.partition]) for s in hit],
            f"_file string, {PARTITION} int, _first long, _low long, _high long")
        rows = spark.read.schema(schema).parquet(*[os.path.join(self.path, s.path) for s in hit])
        # file names hold a number and the job's UUID: unique within a partition's folder
        rows = rows.select("*", F.col("_metadata.file_name").alias("_file"),
                           F.col("_metadata.row_index").alias("_row"), F.regexp_extract(
                               "_metadata.file_path", f"{PARTITION}=([0-9]+)/", 1).cast("int")
                           .alias(PARTITION))
        return rows.join(F.broadcast(known), ["_file", PARTITION]).withColumn(
            OFFSET, F.col("_first") + F.col("_row")).where(
            (F.col(OFFSET) >= F.col("_low")) & (F.col(OFFSET) < F.col("_high"))).select(
            *schema.names, PARTITION, OFFSET)


@dataclass
class Poll:
    finished: bool
    records: DataFrame
    batch: int
    size: int
    ranges: dict[int, tuple[int, int]]

    def __iter__(self):
        return iter((self.finished, self.records))


class Consumer:
    """A group's place in a topic; one consumer of a group at a time."""

    def __init__(self, topic: SegmentTopic, group: str):
        self.topic, self.spark = topic, topic.spark
        self.folder = os.path.join(topic.path, "groups", group)

    def _load(self, seq: int, end: str) -> dict[int, tuple[int, int]]:
        return {int(p): tuple(r) for p, r in json.loads(
            read_small(self.spark, _entry(self.folder, seq, end))).items()}

    def _done(self) -> int:
        """Number of committed polls."""
        return max(_numbered(self.spark, self.folder, ".done"), default=-1) + 1

    def committed(self) -> dict[int, int]:
        """Next offset of each partition."""
        n = self._done()
        return {int(p): o for p, o in json.loads(read_small(
            self.spark, _entry(self.folder, n - 1, ".done"))).items()} if n else {}

    def poll(self, limit: int) -> Poll:
        """At most ``limit`` records after the committed offsets; the ranges of a poll that was
        handed out and not committed come again, whatever ``limit`` is now."""
        batch, start, ends = self._done(), self.committed(), self.topic.ends()
        ahead = {p: end - start.get(p, 0) for p, end in sorted(ends.items()) if end > start.get(p, 0)}
        if batch in _numbered(self.spark, self.folder, ".plan"):
            ranges = self._load(batch, ".plan")
        else:
            take, left = {}, limit
            # the smallest first: what they leave of an even share goes to the others
            for i, p in enumerate(sorted(ahead, key=lambda p: (ahead[p], p))):
                take[p] = min(ahead[p], -(-left // (len(ahead) - i)))
                left -= take[p]
            ranges = {p: (start.get(p, 0), start.get(p, 0) + n) for p, n in sorted(take.items()) if n}
            if ranges:
                write_small(self.spark, _entry(self.folder, batch, ".plan"), json.dumps(ranges))
        size = sum(high - low for low, high in ranges.values())
        finished = sum(ahead.values()) == size and size < limit
        return Poll(finished, self.topic.read(ranges), batch, size, ranges)

    def commit(self, poll: Poll) -> None:
        """The poll's records are done; its offsets are the group's place from now on."""
        if poll.batch != self._done():
            raise ValueError(f"poll {poll.batch} is not the group's open one")
        at = self.committed() | {p: high for p, (_, high) in poll.ranges.items()}
        write_small(self.spark, _entry(self.folder, poll.batch, ".done"), json.dumps(at))

    def drain(self, sink: Callable[[DataFrame, int], None], limit: int) -> int:
        """Polls through ``sink(records, batch)`` until the topic is exhausted; each poll is
        committed after its sink has ended. Returns the number of polls with records."""
        n, finished = 0, False
        while not finished:
            poll = self.poll(limit)
            if poll.size:
                sink(poll.records, poll.batch)
                self.commit(poll)
                n += 1
            finished = poll.finished or not poll.size
        return n
