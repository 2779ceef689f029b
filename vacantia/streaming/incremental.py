"""Incremental forms of the daily batch."""

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vacantia.operators.merge import first_per_key, overlay


def first_seen(stream: DataFrame, *, key: str, ts: str, delay: str) -> DataFrame:
    """First arrival of every key; state is dropped once the watermark has passed.

    Every row travels to its key's state, so this is for keys that repeat a little.
    Where one key may make up much of the feed, use `first_seen_batches`.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


# State on disk, of which a batch reads and writes what it has keys of.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def first_arrivals(stream: DataFrame, *, key: str, order: list[Column]) -> DataFrame:
    """For each batch the rows of the keys that no batch before had, one per key.

    Of a key's rows in its first batch it is the first in ``order``. A streaming aggregate
    keeps it, told by the time of the batch, which a replay repeats: so a batch is cut to one
    row per key and task before the shuffle, however hot the key, and the stored keys are
    looked up, never scanned. Run it in update mode, see `start_first_arrivals`.
    """
    rank = F.struct("__batch", *[o.alias(f"__o{i}") for i, o in enumerate(order)])
    first = stream.withColumn("__batch", F.current_timestamp()).groupBy(F.col(key).alias("__key")).agg(
        F.min_by(F.struct(*stream.columns), rank).alias("__row"), F.min("__batch").alias("__seen")
    )
    return first.filter(F.col("__seen") == F.current_timestamp()).select("__row.*")


def start_first_arrivals(
    stream: DataFrame, root: str, checkpoint: str, *, key: str, order: list[Column]
) -> StreamingQuery:
    """Append the first row of every key to the table at ``root``; state lies in the checkpoint."""
    for name, value in STATE_SETTINGS.items():
        stream.sparkSession.conf.set(name, value)

    def apply(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/run={_run_of(batch)}/epoch={epoch}")

    return upsert_batches(first_arrivals(stream, key=key, order=order), apply, checkpoint, mode="update")


def first_seen_batches(
    spark: SparkSession, root: str, *, key: str, order: list[Column]
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function appending the rows whose key was never stored.

    A batch is cut to one row per key before it is shuffled, then checked against the
    stored keys. Keys are stored by bucket of their hash, so a batch reads only the buckets
    it has keys of. A replayed epoch overwrites its own folder: epochs are told apart by
    the run of the query, so a query with a new checkpoint overwrites nothing.
    """
    def apply(batch: DataFrame, epoch: int) -> None:
        run = _run_of(batch)
        fresh = first_per_key(batch, [key], order).withColumn("bucket", _bucket(key))
        try:
            stored = spark.read.parquet(root)
        except AnalysisException as exc:
            if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            stored = None
        if stored is not None:
            # At most KEY_BUCKETS numbers; as literals they prune the stored folders.
            needed = [r[0] for r in fresh.select("bucket").distinct().collect()]
            own = (F.col("run") == run) & (F.col("epoch") == epoch)
            seen = stored.filter(F.col("bucket").isin(needed) & ~own).select(key)
            fresh = fresh.join(seen, key, "left_anti")
        fresh.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{root}/run={run}/epoch={epoch}"
        )

    return apply


KEY_BUCKETS = 64


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("int")


def _run_of(batch: DataFrame) -> str:
    """Id of the streaming query, which its checkpoint keeps over restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def compact(spark: SparkSession, root: str, target: str) -> None:
    """Rewrites a log of many epochs as one run of few files, for a new root."""
    stored = spark.read.parquet(root)
    columns = [c for c in ("run", "epoch", "bucket") if c in stored.columns]
    rows = stored.repartition(*(["bucket"] if "bucket" in columns else columns))
    rows.withColumn("run", F.lit(f"compact-{uuid.uuid4().hex}")).write.mode("overwrite").partitionBy(*columns).parquet(target)


def windowed_counts(
    stream: DataFrame, *, keys: list[str], ts: str, size: str, delay: str
) -> DataFrame:
    """Tumbling counts per key; rows later than ``delay`` are cut off."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, size), *keys)
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("window_start"), *keys, "n")
    )


def drain(
    stream: DataFrame, path: str, checkpoint: str, *, mode: str = "append"
) -> None:
    """Process everything available into a parquet table and stop."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def upsert_batches(
    stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, *, mode: str = "append"
) -> StreamingQuery:
    """Run ``apply(batch, epoch)`` per micro-batch, resuming where it stopped."""
    return (
        stream.writeStream.foreachBatch(apply).outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def log_updates(root: str, *, key: str, sequence: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function storing each batch's last row per key.

    What is written grows with the batch, never with the table; a replayed epoch
    overwrites its own folder with the same rows, one of another run never.
    """
    def apply(batch: DataFrame, epoch: int) -> None:
        last = first_per_key(batch, [key], [F.col(sequence).desc()])
        last.write.mode("overwrite").parquet(f"{root}/run={_run_of(batch)}/epoch={epoch}")

    return apply


def with_updates(
    base: DataFrame, root: str, columns: list[str], *, key: str, sequence: str
) -> DataFrame:
    """``base`` with the newest logged values; write it out to compact the log."""
    logged = base.sparkSession.read.parquet(root)
    newest = first_per_key(logged, [key], [F.col(sequence).desc(), F.col("epoch").desc(), F.col("run")])
    return overlay(base, newest.select(key, *columns), columns, key=key)


MANIFEST = (
    "sequence long, live array<struct<path: string, level: int>>, applied map<string, long>"
)


class UpdateLog:
    """Updates by key, merged by levels.

    Each micro-batch adds a run, its last row per key in key order, to level 0. As soon as a
    level holds ``ratio`` runs they become one run of the next level, the newest row per key
    in ranges of keys. So a log of n batches is at most ``ratio - 1`` runs on each of log(n)
    levels, every row is rewritten log(n) times at most, and a reader of one key finds it in
    at most one file of each run. Nothing has to be called to compact.

    A manifest, written last, names the live runs and the last epoch of each query. A batch
    that died before leaves files nobody reads; a replayed one is known and changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, *, key: str, sequence: str, ratio: int = 4, range_rows: int = 1 << 22):
        self.spark, self.root, self.key, self.sequence = spark, root, key, sequence
        self.ratio, self.range_rows = ratio, range_rows

    def state(self) -> tuple[int, list, dict]:
        """Sequence, live runs and applied epochs of the newest manifest; only that one is read."""
        folder = f"{self.root}/manifest"
        try:
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option(
                "pathGlobFilter", "*.parquet").load(folder)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, [], {}
        at = F.regexp_extract("path", r"/manifest/(\d+)-\w+/", 1).cast("long")
        newest = files.select(F.max_by("path", at)).first()[0]
        if newest is None:
            return 0, [], {}
        row = self.spark.read.schema(MANIFEST).parquet(newest).first()
        return row["sequence"], [(r["path"], r["level"]) for r in row["live"]], row["applied"]

    def _newest(self, paths: list[str]) -> DataFrame:
        order = [F.col(self.sequence).desc(), F.col("epoch").desc(), F.col("run")]
        return first_per_key(self.spark.read.parquet(*paths), [self.key], order)

    def _merge(self, paths: list[str]) -> str:
        rows = self.spark.read.parquet(*paths).count()  # from the footers
        target = f"{self.root}/runs/merged-{uuid.uuid4().hex}"
        ranges = max(1, -(-rows // self.range_rows))
        self._newest(paths).repartitionByRange(ranges, self.key).sortWithinPartitions(self.key).write.parquet(target)
        return target

    def apply(self, batch: DataFrame, epoch: int) -> None:
        """The ``foreachBatch`` function."""
        query = _run_of(batch)
        sequence, live, applied = self.state()
        if epoch <= applied.get(query, -1):
            return
        path = f"{self.root}/runs/{query}-{epoch}"
        last = first_per_key(batch, [self.key], [F.col(self.sequence).desc()])
        last.withColumns({"run": F.lit(query), "epoch": F.lit(epoch).cast("long")}).sortWithinPartitions(self.key).write.mode(
            "overwrite").parquet(path)
        live, level = [*live, (path, 0)], 0
        while len(full := [p for p, n in live if n == level]) >= self.ratio:
            live = [(p, n) for p, n in live if n != level] + [(self._merge(full), level + 1)]
            level += 1
        row = self.spark.createDataFrame([(sequence + 1, live, {**applied, query: epoch})], MANIFEST)
        row.coalesce(1).write.parquet(f"{self.root}/manifest/{sequence + 1:012}-{uuid.uuid4().hex}")

    def newest(self) -> DataFrame | None:
        """The newest row of every key; None while nothing was logged."""
        live = self.state()[1]
        return self._newest([p for p, _ in live]) if live else None

    def over(self, base: DataFrame, columns: list[str]) -> DataFrame:
        """``base`` with the newest logged values."""
        rows = self.newest()
        return base if rows is None else overlay(base, rows.select(self.key, *columns), columns, key=self.key)
