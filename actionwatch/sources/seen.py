"""URLs seen so far, as an index that a batch asks without reading it all (JOI-01, STR-02).

URLs lie in parts by a hash. Each appended batch is a generation: its URLs by part, and for each part a blocked Bloom
filter, a 64-bit word a row. A batch of URLs is joined with the filter words first; only the parts of generations that
have a possible hit are read, and an exact join decides. Filters only pick what is read. Generations are merged when
later ones have grown to their size, so there are about as many as the logarithm of the number of URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shared import written
from . import versions

#: Parts of a new index, and bits of a filter for each URL.
PARTS, BITS = 256, 32
FILTER = "word long, bits long"


def _places(url: Column, parts: int) -> tuple[Column, Column, Column]:
    """Part, word hash and bits of a URL: five bits of one word."""
    part = F.pmod(F.xxhash64(url), F.lit(parts)).cast("int")
    other = F.xxhash64(F.lit("bits"), url)
    bits = F.lit(0).cast("long")
    for k in range(5):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftrightunsigned(other, 12 * k), F.lit(64)).cast("int")))
    return part, F.xxhash64(F.lit("word"), url), bits


def blank(url: str) -> Column:
    return F.coalesce(F.trim(F.col(url)), F.lit("")) == ""


def _words(m: dict, g: dict) -> int:
    """Words of a part's filter in a generation: a power of two."""
    need, words = g["urls"] * BITS / 64 / m["parts"], 1
    while words < need:
        words *= 2
    return words


def hits(urls: DataFrame, path: str, manifest: dict, *, url: str = "url") -> DataFrame:
    """(url, generation, part) of possible hits."""
    spark, parts = urls.sparkSession, manifest["parts"]
    part, word, bits = _places(F.col(url), parts)
    asked = urls.select(F.col(url).alias("url"), part.alias("part"), word.alias("hash"), bits.alias("want"))
    out = None
    for k, g in enumerate(manifest["generations"]):  # a handful
        filters = None
        for name, folders in g["filters"].items():
            piece = versions.get(spark, path, {name: folders}, FILTER + ", part int")
            filters = piece if filters is None else filters.unionByName(piece)
        if filters is None:
            continue
        mine = asked.withColumn("word", F.pmod("hash", F.lit(_words(manifest, g))))
        found = mine.join(filters, ["part", "word"]).where(F.col("want").bitwiseAND(F.col("bits")) == F.col("want"))
        found = found.select("url", F.lit(k).alias("generation"), "part")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "url string, generation int, part int")


def unseen(items: DataFrame, path: str, *, url: str = "url") -> DataFrame:
    """The rows whose URL the index does not hold; rows with a blank one all pass. Reads only parts with possible hits."""
    spark = items.sparkSession
    _, m = versions.load(spark, path)
    if not m:
        return items
    possible = written(hits(items.where(~blank(url)).select(url).distinct(), path, m, url=url), "possible-hits")
    known = None
    # At most (generations x parts) pairs.
    where: dict[int, set[int]] = {}
    for k, part in possible.select("generation", "part").distinct().collect():
        where.setdefault(k, set()).add(part)
    for k, use in where.items():
        rows = versions.get(spark, path, m["generations"][k]["parts"], "url string", use)
        known = rows if known is None else known.unionByName(rows)
    if known is None:
        return items
    known = known.join(possible.select("url").distinct(), "url", "left_semi").select(F.col("url").alias(url)).distinct()
    return items.join(known, url, "left_anti").select(items.columns)


def _generation(urls: DataFrame, path: str, parts: int) -> dict:
    """Write distinct URLs as a generation."""
    part, word, bits = _places(F.col("url"), parts)
    rows = written(urls.select("url").distinct(), "new-urls")
    n = rows.count()
    g = {"urls": n, "parts": versions.put(rows.select("url", part.alias("part")), path, "part")}
    words = F.pmod(word, F.lit(_words({"parts": parts}, g)))
    filters = rows.select(part.alias("part"), words.alias("word"), bits.alias("bits")).groupBy("part", "word").agg(F.bit_or("bits").alias("bits"))
    # The filters of a generation are read as a whole: one folder.
    return g | {"filters": versions.put(filters.withColumn("all", F.lit(0)), path, "all")}


def append(items: DataFrame, path: str, *, url: str = "url", parts: int = PARTS, batch: str | None = None) -> int:
    """Add the URLs of new rows to the index; blank ones are not kept. Returns the version.

    ``batch`` names the batch: the last thousand names are remembered (``holds``).
    """
    spark = items.sparkSession
    after, m = versions.load(spark, path)
    m = m or {"parts": parts, "generations": [], "batches": []}
    urls = items.where(~blank(url)).select(F.col(url).alias("url"))
    new = _generation(urls, path, m["parts"])
    kept, take = list(m["generations"]), []
    total = new["urls"]
    while kept and kept[-1]["urls"] <= 2 * total:
        take.append(kept.pop())
        total += take[-1]["urls"]
    if take:
        whole = None
        for g in [new, *take]:
            rows = versions.get(spark, path, g["parts"], "url string")
            whole = rows if whole is None else whole.unionByName(rows)
        new = _generation(whole, path, m["parts"])
    generations = [*kept, new] if new["urls"] else kept
    return versions.commit(spark, path, after, m | {"generations": generations, "batches": [*m["batches"], *([batch] if batch else [])][-1000:]})


def holds(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether a batch of this name has been added."""
    return batch in versions.load(spark, path)[1].get("batches", [])
