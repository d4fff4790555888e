"""Clusters of reports that grow with every batch (STR-04).

The state is a folder of parts behind a manifest: which rows have come, the sketch and word-run set of each different
text, the texts of each band bucket, and the component of each text. A batch adds its new texts; of the stored ones it
reads only the parts of the buckets that it hits, compares new texts with these and with one another, and joins
components. A text whose group has nothing new asks nothing. After any number of batches the clusters are those of
``clustering.cluster`` over all rows.

A component gets an event id when it is first seen, a digest of its URLs then. The id stays, whatever joins later;
where a late report joins two events, the one seen first stands and names the other as superseded.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import event_id
from ..operators.clustering import Bands, components, plain_text, text_key
from ..operators.shared import written
from ..sources import versions
from .stream import batch_name

#: Parts of each table of the state.
PARTS = 64
SETS, BANDS, LABELS, MERGES = "key binary, sig binary, set binary", "bucket long, band int, key binary", "key binary, component binary", "old binary, new binary"
EVENTS = "component binary, event_id string, epoch long"


def _part(c: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(parts)).cast("int").alias("part")


def _numbers(df: DataFrame) -> set[int]:
    """Parts that rows fall into: at most as many as there are."""
    return {r[0] for r in df.select("part").distinct().collect()}


def grow(path: str, *, group: str, row: str, text: str, url: str | None = None, how: Bands = Bands(), parts: int = PARTS) -> Callable[[DataFrame, int], None]:
    """A batch writer that adds rows to the clusters under ``path``.

    Rows whose (group, row) is stored already change nothing; of several rows of one id in a batch all are kept, and rows
    without an id are always new. A repeated batch (of the same number and rows) adds nothing; the last thousand are
    remembered. Rows without a group, an id or a word are clusters of their own and ask nothing. ``url`` names the column
    of which event ids are made, the row's id where there is none.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        after, m = versions.load(spark, path)
        m = m or {"parts": parts, "members": {}, "sets": {}, "bands": {}, "labels": {}, "merges": {}, "events": {}, "epoch": 0, "batches": []}
        n = m["parts"]
        named = batch.select(group, row, plain_text(F.col(text)).alias("words"), (F.col(url) if url else F.col(row).cast("string")).alias("url"))
        has_key = F.col(group).isNotNull() & F.col(row).isNotNull() & (F.col("words") != "")
        named = named.withColumn("key", F.when(has_key, text_key(F.col(group), F.col("words"))))
        named = written(named.withColumn("part", _part(F.col(row), n)), "batch")
        name, _ = batch_name(named, epoch)
        if name in m["batches"]:
            return
        kinds = StructType([named.schema[group], named.schema[row]])
        known = versions.get(spark, path, m["members"], kinds, _numbers(named)).distinct()
        same = (F.col(f"n.{group}").eqNullSafe(F.col(f"k.{group}"))) & (F.col(f"n.{row}") == F.col(f"k.{row}"))
        rows = written(named.drop("words").alias("n").join(known.alias("k"), same, "left_anti"), "new-rows")
        if rows.isEmpty():
            return
        keyed = rows.where("key is not null")
        keys = keyed.groupBy("key").agg(F.first(group).alias(group), F.first(row).alias(row))
        keys = written(keys.withColumn("part", _part(F.col("key"), n)), "keys")
        stored = versions.get(spark, path, m["labels"], LABELS, _numbers(keys))
        fresh = written(keys.join(stored.select("key"), "key", "left_anti"), "fresh")
        # Words go once: to one row for each text. Sets and bands go once to the state, and are read from there.
        texts = named.where("key is not null").groupBy("key").agg(F.first(F.xxhash64(group)).alias("seed"), F.first("words").alias("words")).join(fresh.select("key"), "key", "left_semi")
        made = how.sketched_sets(texts)
        set_folders = versions.put(made.withColumn("part", _part(F.col("key"), n)), path, "part")
        sets = versions.get(spark, path, set_folders, made.schema)
        band_folders = versions.put(how.banded(sets.select("key", "sig")).drop("bits").withColumn("part", _part(F.col("bucket"), n)), path, "part")

        # Stored texts of the buckets that the batch hits, from the parts of these only.
        hit = versions.get(spark, path, band_folders, "bucket long, band int").distinct()
        old = written(versions.get(spark, path, m["bands"], BANDS, {int(k) for k in band_folders}).join(hit, ["bucket", "band"], "left_semi"), "hit")
        old_keys = written(old.select("key").distinct().withColumn("part", _part(F.col("key"), n)), "old-keys")
        use = _numbers(old_keys)
        every = sets.unionByName(versions.get(spark, path, m["sets"], SETS, use))
        met = how.banded(sets.select("key", "sig")).withColumn("fresh", F.lit(True))
        if use:
            old_bits = how.bits(versions.get(spark, path, m["sets"], SETS, use).select("key", "sig"))
            met = met.unionByName(old.join(old_bits, "key").withColumn("fresh", F.lit(False)))
        links = how.links(met, every.select("key", "sig"), lambda needed: every.select("key", "set").join(needed, "key", "left_semi"))

        # Links between new texts and stored components.
        merges = versions.get(spark, path, m["merges"], MERGES)
        labels = versions.get(spark, path, m["labels"], LABELS, use).join(old_keys.select("key"), "key", "left_semi")
        labels = _resolved(labels, merges)
        end = lambda c: F.coalesce(F.col(f"{c}_label"), F.col(c)).alias(c)
        ends = links
        for c in ("u", "v"):
            ends = ends.join(labels.select(F.col("key").alias(c), F.col("component").alias(f"{c}_label")), c, "left").select(*(end(c) if x == c else F.col(x) for x in ("u", "v")))
        joined = written(components(ends.where("u <> v")), "joined")
        stood = written(labels.select("component").distinct(), "stood")
        moved = stood.withColumnRenamed("component", "old").join(joined.select(F.col("node").alias("old"), F.col("component").alias("new")), "old").where("old <> new")
        moved = written(moved, "moved")
        given = fresh.select("key", "part").join(joined.select(F.col("node").alias("key"), "component"), "key", "left").select("key", F.coalesce("component", "key").alias("component"), "part")
        given = written(given, "given")

        if not moved.isEmpty():
            older = merges.join(moved.select(F.col("old").alias("new"), F.col("new").alias("next")), "new", "left").select("old", F.coalesce("next", "new").alias("new"))
            m = m | {"merges": versions.put(older.unionByName(moved).withColumn("part", F.lit(0)), path, "part")}
        # Events of components that hold no stored text.
        touched = moved.select(F.col("new").alias("component")).unionByName(stood).distinct()
        born = given.join(touched, "component", "left_anti")
        urls = keyed.join(born.select("key", "component"), "key").groupBy("component").agg(event_id(F.collect_set("url")).alias("event_id"))
        events = versions.put(urls.withColumn("epoch", F.lit(m["epoch"]).cast("long")).withColumn("part", _part(F.col("component"), n)), path, "part")
        members = rows.select(group, row, "key", "part")
        m = m | {
            "rows": json.loads(kinds.json()), "group": group, "row": row, "epoch": m["epoch"] + 1, "batches": [*m["batches"], name][-1000:],
            "members": versions.joined(m["members"], versions.put(members, path, "part")),
            "sets": versions.joined(m["sets"], set_folders), "bands": versions.joined(m["bands"], band_folders),
            "labels": versions.joined(m["labels"], versions.put(given, path, "part")), "events": versions.joined(m["events"], events),
        }
        versions.commit(spark, path, after, m)

    return write


def _resolved(labels: DataFrame, merges: DataFrame) -> DataFrame:
    """(key, component) after all merges; a merged component points straight to the one that stands."""
    return labels.join(merges, F.col("component") == F.col("old"), "left").select("key", F.coalesce("new", "component").alias("component"))


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """(group, row, cluster, event_id) of all rows: the least row of the cluster, and the id of its event.

    Rows without a group, an id or a word are clusters of their own without an event.
    """
    _, m = versions.load(spark, path)
    if not m:
        raise FileNotFoundError(f"{path} has no version")
    group, row = m["group"], m["row"]
    kinds = StructType.fromJson(m["rows"]).add("key", "binary")
    members = versions.get(spark, path, m["members"], kinds)
    labels = _resolved(versions.get(spark, path, m["labels"], LABELS), versions.get(spark, path, m["merges"], MERGES))
    worded = members.where("key is not null").join(labels, "key")
    named = worded.groupBy("component").agg(F.min(row).alias("cluster")).join(read_events(spark, path).select("component", "event_id"), "component")
    out = worded.join(named, "component").select(group, row, "cluster", "event_id")
    return out.unionByName(members.where("key is null").select(group, row, F.col(row).alias("cluster"), F.lit(None).cast("string").alias("event_id")))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """(component, event_id, superseded): the event that each component was first seen as, and later ones it took over."""
    _, m = versions.load(spark, path)
    events = versions.get(spark, path, m["events"], EVENTS)
    merges = versions.get(spark, path, m["merges"], MERGES)
    now = events.join(merges, F.col("component") == F.col("old"), "left").select(F.coalesce("new", "component").alias("component"), "event_id", "epoch")
    ordered = F.array_sort(F.collect_set(F.struct("epoch", "event_id")))
    return now.groupBy("component").agg(ordered.alias("e")).select("component", F.get("e", F.lit(0))["event_id"].alias("event_id"), F.transform(F.slice("e", F.lit(2), F.size("e")), lambda x: x["event_id"]).alias("superseded"))
