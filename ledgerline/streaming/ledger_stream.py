"""Incremental silver with every row accounted for: matched, pending or late.

The three feeds are one stream of tagged rows. Each micro-batch joins its rows
with those still pending, writes what matched to silver, keeps what may still
match as pending and sends the rest to a side table of late rows: rows whose
step is older than ``lateness`` steps before the newest step seen, and rows
without key or step. So a partner that never comes, or comes too late, is a row
of the side table and not a number in a metric: matched + pending + late are
all rows delivered, each once.

The sink can be repeated. A batch writes to folders of its own and becomes part
of the tables with one manifest file that names all live folders; a batch that
died is written anew, and one that is in the manifest already adds nothing when it is
replayed. Every ``compact_every`` batches the small folders of silver and late
become one, clustered by step, so the files of a step stay bounded.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.folders import Folders
from ledgerline.operators.silver import build_silver
from ledgerline.schemas import FEED_SCHEMAS, FEEDS, KEY, SILVER_COLUMNS, STEP, with_step
from ledgerline.sinks.writers import write_batch
from ledgerline.streaming.silver_stream import feed_stream

SILVER, LATE, PENDING = "silver", "late", "pending"
MANIFEST = "manifest"
#: Manifests kept besides the current one, for readers that started on them.
KEPT = 2
FEED = "feed"

#: A row of any feed: key, step, feed and the feed's own columns as one struct.
TAGGED = T.StructType([
    T.StructField(KEY, T.StringType()), T.StructField(STEP, T.IntegerType()),
    T.StructField(FEED, T.StringType()),
    *[T.StructField(f"_{f}", T.StructType([c for c in FEED_SCHEMAS[f].fields if c.name not in (KEY, STEP)]))
      for f in FEEDS]])


def tagged(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """The feeds as one frame of tagged rows (static or streaming)."""
    out = None
    for name in FEEDS:
        own = [f.name for f in FEED_SCHEMAS[name].fields if f.name not in (KEY, STEP)]
        part = feeds[name].select(
            KEY, STEP, F.lit(name).alias(FEED),
            *[(F.struct(*own) if f == name else F.lit(None)).cast(TAGGED[f"_{f}"].dataType).alias(f"_{f}")
              for f in FEEDS])
        out = part if out is None else out.unionByName(part)
    return out


def feed_rows(rows: DataFrame, feed: str) -> DataFrame:
    """The rows of one feed, untagged."""
    own = rows.where(F.col(FEED) == feed).select(KEY, STEP, f"_{feed}.*")
    return own.select(*with_step(FEED_SCHEMAS[feed]).fieldNames())


def matched_keys(rows: DataFrame) -> DataFrame:
    """(key, step) that all three feeds have; one shuffle of the keys, combined before it."""
    bits = F.create_map(*[x for i, f in enumerate(FEEDS) for x in (F.lit(f), F.lit(1 << i))])
    mask = rows.where(F.col(KEY).isNotNull() & F.col(STEP).isNotNull()).groupBy(KEY, STEP).agg(
        F.bit_or(bits[F.col(FEED)]).alias("_mask"))
    return mask.where(F.col("_mask") == (1 << len(FEEDS)) - 1).select(KEY, STEP)


class LedgerSink:
    """The tables below ``root`` and the batches that make them up."""

    def __init__(self, spark: SparkSession, root: str, lateness: int, compact_every: int = 10,
                 cluster_partitions: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.lateness, self.compact_every = lateness, compact_every
        self.cluster_partitions = cluster_partitions
        self.folders = Folders(spark)

    # -- manifest

    def manifest(self) -> dict:
        """The newest manifest: last batch, newest step, live folders and counts."""
        names = [n for n in self.folders.names(f"{self.root}/{MANIFEST}") if n.endswith(".json")
                 and n[0] != "."]
        if not names:
            return {"version": -1, "batch": -1, "newest": None, SILVER: [], LATE: [], PENDING: [],
                    "rows": {SILVER: 0, LATE: 0, PENDING: 0, "in": 0}}
        return json.loads(self.folders.read(f"{self.root}/{MANIFEST}/{names[-1]}"))

    def _publish(self, manifest: dict) -> None:
        """The commit: one new file. Folders that no kept manifest names are dropped after it."""
        where = f"{self.root}/{MANIFEST}"
        name = f"{manifest['version']:012d}.json"
        self.folders.write_whole(f"{where}/{name}", json.dumps(manifest))
        names = [n for n in self.folders.names(where) if n.endswith(".json") and n[0] != "."]
        for n in names[:-1 - KEPT]:
            self.folders.delete(f"{where}/{n}")
        kept = [json.loads(self.folders.read(f"{where}/{n}")) for n in names[-1 - KEPT:]]
        for table in (SILVER, LATE, PENDING):
            live = {f for m in kept for f in m[table]}
            for n in self.folders.names(f"{self.root}/{table}"):
                if n not in live:
                    self.folders.delete(f"{self.root}/{table}/{n}")

    def read(self, table: str, manifest: dict | None = None) -> DataFrame:
        """``silver`` with its columns, or the tagged rows of ``late`` or ``pending``."""
        live = (manifest or self.manifest())[table]
        paths = [f"{self.root}/{table}/{n}" for n in live]
        out = None
        for path in paths:  # a few folders: compaction bounds them
            part = self.spark.read.parquet(path)
            out = part if out is None else out.unionByName(part)
        if out is None:
            return self.spark.createDataFrame([], TAGGED if table != SILVER else self._silver_schema())
        return out.select(*(SILVER_COLUMNS if table == SILVER else TAGGED.fieldNames()))

    def _silver_schema(self) -> T.StructType:
        empty = {f: self.spark.createDataFrame([], with_step(FEED_SCHEMAS[f])) for f in FEEDS}
        return build_silver(*[empty[f] for f in FEEDS]).select(*SILVER_COLUMNS).schema

    # -- batches

    def process(self, batch: DataFrame, batch_id: int) -> dict:
        """One micro-batch; a batch that is in the manifest already changes nothing."""
        before = self.manifest()
        if batch_id <= before["batch"]:
            return before
        name = f"batch={batch_id:012d}"
        # what came, stored once: replays and the passes below read the same rows
        came = f"{self.root}/{PENDING}/{name}-in"
        batch.select(*TAGGED.fieldNames()).write.mode("overwrite").parquet(came)
        batch = self.spark.read.schema(TAGGED).parquet(came)
        n_in, newest = batch.agg(F.count(F.lit(1)), F.max(STEP)).first()
        newest = max((s for s in (newest, before["newest"]) if s is not None), default=None)
        rows = self.read(PENDING, before).unionByName(batch)
        named = F.col(KEY).isNotNull() & F.col(STEP).isNotNull()
        whole = matched_keys(rows).withColumn("_matched", F.lit(True))
        # a key may hold a third of the rows: the join's large partitions can be split;
        # rows without key or step match nothing and need no join
        told = rows.where(named).join(whole, [KEY, STEP], "left").unionByName(
            rows.where(~named).withColumn("_matched", F.lit(None).cast("boolean")))
        alive = named & (F.col(STEP) >= F.lit(newest) - self.lateness)
        state = F.when(F.col("_matched"), SILVER).when(alive, PENDING).otherwise(LATE)
        sorted_out = f"{self.root}/{PENDING}/{name}-told"
        told.select(*TAGGED.fieldNames(), state.alias("_state")).write.mode("overwrite") \
            .partitionBy("_state").parquet(sorted_out)
        told = self.spark.read.schema(T.StructType(
            [*TAGGED.fields, T.StructField("_state", T.StringType())])).parquet(sorted_out)
        counts = {r["_state"]: r["count"] for r in told.groupBy("_state").count().collect()}

        after = {k: list(v) if isinstance(v, list) else v for k, v in before.items()}
        if counts.get(SILVER):
            parts = told.where(F.col("_state") == SILVER)
            silver = build_silver(*[feed_rows(parts, f) for f in FEEDS])
            write_batch(silver, f"{self.root}/{SILVER}/{name}", mode="overwrite",
                        partitions=self.cluster_partitions)
            after[SILVER].append(name)
        if counts.get(LATE):
            told.where(F.col("_state") == LATE).drop("_state").write.mode("overwrite").parquet(
                f"{self.root}/{LATE}/{name}")
            after[LATE].append(name)
        after[PENDING] = []
        if counts.get(PENDING):
            told.where(F.col("_state") == PENDING).drop("_state").write.mode("overwrite").parquet(
                f"{self.root}/{PENDING}/{name}")
            after[PENDING].append(name)
        after |= {"version": before["version"] + 1, "batch": batch_id, "newest": newest}
        after["rows"] = {SILVER: before["rows"][SILVER] + counts.get(SILVER, 0),
                         LATE: before["rows"][LATE] + counts.get(LATE, 0),
                         PENDING: counts.get(PENDING, 0), "in": before["rows"]["in"] + n_in}
        for table in (SILVER, LATE):
            if len(after[table]) >= self.compact_every:
                after[table] = [self._compacted(table, after, name)]
        self._publish(after)
        return after

    def _compacted(self, table: str, manifest: dict, name: str) -> str:
        """All live folders of a table as one; the old ones stay until the manifest is out."""
        name = f"{name}-whole"
        rows = self.read(table, manifest)
        write_batch(rows, f"{self.root}/{table}/{name}", mode="overwrite",
                    partition_by=(STEP,) if table == SILVER else (), partitions=self.cluster_partitions)
        return name

    def accounted(self) -> DataFrame:
        """Every delivered row: (key, step, feed, state), state being matched, pending or late.

        Matched rows are told from silver by key and step: it has a row for each
        combination of equal keys, so copies of a key in a feed count once here.
        """
        keys = self.read(SILVER).select(KEY, STEP).distinct()
        matched = keys.select(KEY, STEP, F.explode(F.array(*[F.lit(f) for f in FEEDS])).alias(FEED),
                              F.lit("matched").alias("state"))
        rest = [self.read(t).select(KEY, STEP, FEED, F.lit(t).alias("state")) for t in (PENDING, LATE)]
        return matched.unionByName(rest[0]).unionByName(rest[1])


def run_ledger_stream(spark: SparkSession, bronze_root: str, sink: LedgerSink, checkpoint: str,
                      fmt: str = "parquet", max_files_per_trigger: int | None = None) -> dict:
    """Take in the files that arrived since the last run; returns the newest manifest.

    The stream itself keeps no state and needs no watermark: what waits is the
    pending table. Bounded micro-batches lose nothing, but a step counts as old
    from the newest step seen on, so files should come in order of their steps
    within ``lateness``.
    """
    feeds = {f: feed_stream(spark, bronze_root, f, fmt, max_files_per_trigger) for f in FEEDS}
    query = (tagged(feeds).writeStream.foreachBatch(lambda df, i: sink.process(df, i) and None)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception():
        raise RuntimeError(str(query.exception()))
    return sink.manifest()
