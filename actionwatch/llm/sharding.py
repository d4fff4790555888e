"""Sharding by fixed virtual slots.

Records hash into a fixed number of slots. Bytes are added up by slot, and a small versioned table maps slots to
shards. Rebalancing edits that table: slots leave overfull shards and go to the emptiest; all other slots, and so
their records, stay where they are. Records never need another hash function, only another version of the map.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ranking import placed_in_group
from .common import materialize, scratch

SLOTS = 8192
#: What a record takes besides its text.
OVERHEAD = 16


def slot_of(doc_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """The slot of a record: a hash of its id (of its text, where the id is null)."""
    return F.when(doc_id.isNotNull(), F.pmod(F.xxhash64(doc_id), F.lit(slots))).otherwise(F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(slots))).cast("int")


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot) of each document; a null text has no bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), slot_of(F.col("doc_id"), F.col("text"), slots).alias("vslot"))


def slot_bytes(recs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(vslot, bytes, rows) for all slots, empty ones too: as many rows as slots, whatever the input."""
    every = recs.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    found = recs.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return every.join(found, "vslot", "left").fillna(0, ["bytes", "rows"])


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 0: equal runs of slots (vslot, shard)."""
    return spark.range(slots).select(F.col("id").cast("int").alias("vslot"), F.expr(f"int(id * {shards} div {slots})").alias("shard"))


def rebalance(slot_map: DataFrame, by_slot: DataFrame, shards: int) -> DataFrame:
    """Edit a map so that the shards hold nearly equal bytes, moving only what exceeds the mean.

    Each shard keeps its largest slot and, largest first, every other one that still fits into the mean; the rest go,
    largest first, to the shard with the fewest bytes at that moment. ``shards`` may be larger than in the given map. The tables have one
    row for each slot, a fixed number. Returns (vslot, shard).
    """
    sized = slot_map.join(by_slot.select("vslot", "bytes"), "vslot")
    mean = (by_slot.agg(F.sum("bytes")).first()[0] or 0) / shards
    # At most as many entries as there are slots, a fixed number.
    own = sized.groupBy("shard").agg(F.reverse(F.array_sort(F.collect_list(F.struct("bytes", "vslot")))).alias("slots"))
    kept = F.expr(f"""aggregate(slots, named_struct('load', 0L, 'kept', cast(array() as array<int>)),
        (a, s) -> if(a.load = 0 or a.load + s.bytes <= {mean}D, named_struct('load', a.load + s.bytes, 'kept', array_append(a.kept, s.vslot)), a), a -> a.kept)""")
    marked = own.withColumn("kept", kept).select("shard", F.expr("transform(slots, s -> named_struct('bytes', s.bytes, 'vslot', s.vslot, 'kept', if(array_contains(kept, s.vslot), shard, null)))").alias("slots"))
    # One row: all slots, largest first, and a fold that keeps the load of each shard.
    one = marked.agg(F.reverse(F.array_sort(F.flatten(F.collect_list("slots")))).alias("slots"))
    start = F.expr(f"""aggregate(filter(slots, s -> s.kept is not null), array_repeat(0L, {shards}),
        (l, s) -> transform(l, (x, i) -> if(i = s.kept, x + s.bytes, x)))""")
    moved = F.expr(f"""aggregate(filter(slots, s -> s.kept is null),
        named_struct('loads', loads, 'moves', cast(array() as array<struct<vslot:int,shard:int>>)),
        (a, s) -> named_struct(
            'loads', transform(a.loads, (x, i) -> if(i = int(array_position(a.loads, array_min(a.loads))) - 1, x + s.bytes, x)),
            'moves', array_append(a.moves, named_struct('vslot', s.vslot, 'shard', int(array_position(a.loads, array_min(a.loads))) - 1))),
        a -> a.moves)""")
    stay = F.expr("transform(filter(slots, s -> s.kept is not null), s -> named_struct('vslot', s.vslot, 'shard', s.kept))")
    return one.withColumn("loads", start).select(F.inline(F.concat(stay, moved)))


def save_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Store one version; earlier versions stay readable."""
    slot_map.select("vslot", "shard").coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("vslot int, shard int").parquet(f"{path}/version={version}")


def place(recs: DataFrame, slot_map: DataFrame, by_slot: DataFrame) -> DataFrame:
    """Each record with its shard and its place in it, gapless from 0.

    A record's place is the number of records in earlier slots of its shard plus its rank in its own slot, so no
    task ever holds a whole shard.
    """
    shard = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slot_map.join(by_slot.select("vslot", "rows"), "vslot").select("vslot", "shard", F.coalesce(F.sum("rows").over(shard), F.lit(0)).alias("before"))
    # A slot of very many rows (an id that repeats) is ranked by ranges of (slot, id), whatever its size.
    order = [F.asc(c) for c in ("doc_id", "text_crc32", "size", *(["row"] if "row" in recs.columns else []))]
    ranked = placed_in_group(recs, group=["vslot"], order=order)
    return ranked.join(F.broadcast(offsets), "vslot").select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("rank") - 1).alias("slot"), "vslot")


def shard_documents(docs: DataFrame, *, shards: int, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """Put all documents into ``shards`` shards of near equal bytes (law ``bytes``).

    Stores version 0 (equal runs of slots) and version 1 (edited for the bytes found) of the map under ``path``.
    Returns doc_id, size, text_crc32, shard, slot, vslot. Records with the same id share a virtual slot, records without
    one that of their text; equal texts of different ids may lie in different shards, as the law is by bytes. Repeated
    rows all come out; an empty table gives no rows. Columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    path = path or scratch(spark, "slot-map")
    # A short row for each document, written once with a number: texts are read once, and repeated rows are told apart.
    recs = materialize(records(docs, slots).withColumn("row", F.monotonically_increasing_id()), "records")
    by_slot = slot_bytes(recs, slots)
    sizes = f"{path}/sizes"
    by_slot.coalesce(1).write.parquet(sizes)
    by_slot = spark.read.schema("vslot int, bytes long, rows long").parquet(sizes)
    save_map(first_map(spark, shards, slots), path, 0)
    save_map(rebalance(load_map(spark, path, 0), by_slot, shards), path, 1)
    return place(recs, load_map(spark, path, 1), by_slot)
