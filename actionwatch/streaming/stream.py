"""Incremental ingest, de-duplication, funnels, accretion and rate limits as streams.

Watermarks stand on the time of ingestion, never on an article's own date: an article may be a month old when it
arrives. Each function takes a streaming DataFrame; ``run`` drives one to the end of what has landed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..operators.lifecycle import accrete, upsert
from ..operators.shared import written
from ..sources import keyed, seen, versions
from ..sources.tables import exists, read_snapshot, snapshot_number, write_snapshot


STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def landed(spark: SparkSession, path: str, schema: StructType, *, files_per_batch: int | None = None) -> DataFrame:
    """New files of a landing folder (STR-01)."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def first_seen(items: DataFrame, *, url: str = "url", time: str = "ingested_at", keep: str = "60 days") -> DataFrame:
    """One row for each URL within the hot range; older URLs are checked against the index in the batch (STR-02, STR-03).

    Rows with a blank URL all stay.
    """
    timed = items.withWatermark(time, keep)
    return timed.where(~seen.blank(url)).dropDuplicatesWithinWatermark([url]).unionByName(timed.where(seen.blank(url)))


def daily_funnel(items: DataFrame, *, source: str, time: str = "ingested_at", late: str = "8 days") -> DataFrame:
    """Rows of each source by day of ingestion (STR-05)."""
    return items.withWatermark(time, late).groupBy(F.window(time, "1 day").alias("w"), source).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("w.start").alias("day"), source, "n")


def batch_name(batch: DataFrame, epoch: int) -> tuple[str, int]:
    """A name by a batch's number and contents, which its replay shares, and its number of rows."""
    # A sum of row hashes does not depend on the order of rows.
    shape = batch.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*batch.columns).cast("decimal(38,0)")).alias("h")).first()
    return f"{epoch}-{shape.n}-{shape.h or 0}", shape.n


def append_unseen(path: str, known: DataFrame | None = None, *, parts: int = seen.PARTS) -> Callable[[DataFrame, int], None]:
    """A batch writer that appends the rows whose URL the table does not hold; a repeated batch adds nothing.

    Which URLs are held is asked of an index beside the table, so old rows are not scanned; the index knows the URLs of
    ``known`` from the first batch on. A batch is named by its number and contents and has a folder of that name, so
    rows with a blank URL, which are always new, are not added again by its replay either; a crash between its rows
    and its index entry is made good by the replay.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        index = f"{path}/_seen"
        if known is not None and not versions.load(spark, index)[0]:
            seen.append(known, index, parts=parts, batch="known")
        batch = written(batch, "batch")
        name, n = batch_name(batch, epoch)
        if not n or seen.holds(spark, index, name):
            return
        folder = f"{path}/batch={name}"
        if not exists(spark, f"{folder}/_SUCCESS"):
            seen.unseen(batch, index).write.mode("overwrite").parquet(folder)
        seen.append(spark.read.schema(batch.schema).parquet(folder), index, parts=parts, batch=name)

    return write


def accrete_batches(path: str, gather: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A batch writer that lets the stored events take over the sources of each batch (STR-04).

    ``gather`` makes (event_id, source_urls, source_outlets) of a batch's rows. A batch without anything new writes
    no version (STR-07).
    """

    def write(batch: DataFrame, epoch: int) -> None:
        number, events = snapshot_number(batch.sparkSession, path), read_snapshot(batch.sparkSession, path)
        grown = accrete(events, gather(batch))
        if not grown.where("new_urls > 0").isEmpty():
            write_snapshot(grown.drop("new_urls"), path, after=number)

    return write


def upsert_batches(path: str, *, key: str, order: str, preserve: list[str] = ()) -> Callable[[DataFrame, int], None]:
    """A batch writer for keyed tables; an unchanged batch writes no version (STR-07)."""

    def write(batch: DataFrame, epoch: int) -> None:
        number = snapshot_number(batch.sparkSession, path)
        changed = upsert(read_snapshot(batch.sparkSession, path), batch, key=key, order=order, preserve=preserve)
        if not changed.where("change <> 'unchanged'").isEmpty():
            write_snapshot(changed.drop("change"), path, after=number)

    return write


def keyed_upserts(path: str, *, order: str, preserve: list[str] = (), key: str | None = None) -> Callable[[DataFrame, int], None]:
    """As ``upsert_batches`` into a table in buckets (``sources.keyed``): only buckets with a change are written (SRC-11, STR-07)."""
    return lambda batch, epoch: keyed.upsert_into(batch, path, order=order, preserve=preserve, key=key) and None


def keyed_accretion(path: str, gather: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """As ``accrete_batches`` into a table in buckets."""
    return lambda batch, epoch: keyed.accrete_into(gather(batch), path) and None


def funnel_batches(path: str, *, source: str) -> Callable[[DataFrame, int], None]:
    """A writer for ``daily_funnel`` in update mode: the windows that a batch changed replace their stored counts (STR-05).

    Counts of a window only grow, so the largest stands. Spark drops a window's state once the watermark has passed it.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch.withColumn("id", F.to_json(F.struct("day", source)))
        keyed.upsert_into(rows, path, order="n", key="id")

    return write


class _Attempts(StatefulProcessor):
    """The times of a key's attempts in the last window, and a timer that ends them."""

    def __init__(self, seconds: int, most: int):
        self.seconds, self.most = seconds, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getListState("times", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        span = self.seconds * 1_000_000
        new = pd.concat(rows).sort_values(["at", "id"], kind="stable")
        times = pd.Series(sorted([r[0] for r in self.times.get()] + new["at"].tolist()))
        upto = times.searchsorted(new["at"].to_numpy(), side="right")
        counts = upto - times.searchsorted(new["at"].to_numpy() - span, side="right")
        self.times.put([(int(t),) for t in times[times > times.iloc[-1] - span]])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        end = int(times.iloc[-1]) // 1000 + self.seconds * 1000
        self.handle.registerTimer(max(end, timerValues.getCurrentWatermarkInMs() + 1))
        yield pd.DataFrame({"id": new["id"], "attempts": counts, "limited": counts > self.most})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        self.times.clear()
        return iter([])

    def close(self) -> None:
        pass


def rate_limits(attempts: DataFrame, *, key: str, id_column: str, ts: str, seconds: int, most: int, late: str = "1 hour") -> DataFrame:
    """(id, attempts, limited) for each attempt: attempts of the key in the last ``seconds``, kept as state (STR-06).

    Of a key only the times of the last ``seconds`` are kept, as a list of its own; a timer removes them once the
    watermark has passed the window. The session needs the RocksDB state store, which ``run`` sets.
    """
    timed = attempts.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    rows = timed.select(ts, F.col(key).alias("key"), F.col(id_column).alias("id"), F.unix_micros(ts).alias("at"))
    return rows.groupBy("key").transformWithStateInPandas(_Attempts(seconds, most), "id long, attempts long, limited boolean", "Append", "EventTime")


def run(df: DataFrame, checkpoint: str, *, path: str | None = None, each: Callable[[DataFrame, int], None] | None = None, mode: str = "append") -> None:
    """Process everything that has landed, then stop. A restart with the same checkpoint takes only what is new.

    State is kept in RocksDB, on disk beside the executor, and copied to the checkpoint; a stream that was begun with
    another store goes on with it.
    """
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer = writer.foreachBatch(each) if each else writer.format("parquet").option("path", path)
    writer.start().awaitTermination()
