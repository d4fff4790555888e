"""Top-k, keep-one, pages and orders. Every order ends with an id, so ties are settled."""

from __future__ import annotations

import bisect
import itertools
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import shared_folder, written


def top_per_group(df: DataFrame, *, group: list[str], order: list[Column], cap: int, rank: str = "rank") -> DataFrame:
    """The first ``cap`` rows of each group. Spark keeps ``cap`` rows of a group a partition before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= cap)


def _dealt(df: DataFrame, order: list[Column], name: str, part: str) -> DataFrame:
    """Rows in ranges of an order, written: with their range and their place in it, from 0."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # Within a partition the low 33 bits count up from 0.
    return written(ranged.withColumn(part, F.spark_partition_id()).withColumn(f"{part}_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), name)


def _free(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    return name + "_" * max(map(len, df.columns))


def placed_in_group(df: DataFrame, *, group: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """Every row with its place in its group, from 1.

    Rows are dealt into ranges of (group, order), so a large group lies in many of them. A row's place is its place in
    its range, less that of the group's first row there, plus the group's rows in earlier ranges.
    """
    part, g, shift = (_free(df, x) for x in ("range", "group", "shift"))
    numbered = _dealt(df, [*map(F.col, group), *order], "placed", part)
    first, n = (_free(df, x) for x in ("first", "n"))
    pieces = numbered.groupBy(*group, part).agg(F.min(f"{part}_at").alias(first), F.count(F.lit(1)).alias(n))
    before = Window.partitionBy(*group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(F.col(part).alias(f"{part}_of"), F.struct(*group).alias(g), (F.coalesce(F.sum(n).over(before), F.lit(0)) - F.col(first) + 1).alias(shift))
    # A row for each group and range that holds it.
    same = (F.col(part) == F.col(f"{part}_of")) & F.struct(*group).eqNullSafe(F.col(g))
    return numbered.join(starts, same).select(*df.columns, (F.col(f"{part}_at") + F.col(shift)).cast("int").alias(rank))


def ranked(df: DataFrame, *, order: list[Column], rank: str = "rank") -> DataFrame:
    """Every row with its place in the order of the whole table, from 1.

    No task sees the whole table: rows are dealt into ranges of the order and numbered there, and the numbers of rows in
    earlier ranges (one row a range) are added. The numbered ranges are written, so both readings see the same.
    """
    part = _free(df, "range")
    numbered = _dealt(df, order, "ranked", part)
    sizes = numbered.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    return numbered.join(F.broadcast(starts), part).select(*df.columns, (F.col("n") + F.col(f"{part}_at") + 1).alias(rank))


def top_per_category(df: DataFrame, *, choices: list[str], cap: int = 4, within: list[str] | None = None) -> DataFrame:
    """The best of each primary category (of each value of ``within``): relevance 3, then 2; most sources; newest (WIN-01)."""
    from ..functions.lists import primary

    rows = df.withColumn("primary", primary(F.col("competency"), choices)).where(F.col("primary").isNotNull() & (F.col("relevance") >= 2))
    return top_per_group(rows, group=[*(within or []), "primary"], order=[F.desc("relevance"), F.desc("article_count"), F.desc("date"), F.asc("event_id")], cap=cap)


def brief_lines(items: DataFrame) -> DataFrame:
    """(category, side, rank, line) of the brief's input (REP-03). ``items``: category, side, rank, item; a few a category.

    A category must cover its first state item of relevance 3 that names its state, if it has one.
    """
    from ..functions.text import brief_line, title_state

    can = (F.col("side") == "state") & (F.col("item.relevance") == 3) & title_state(F.col("item.title")).isNotNull()
    first = F.min(F.when(can, F.col("rank"))).over(Window.partitionBy("category"))
    must = F.coalesce((F.col("side") == "state") & (F.col("rank") == F.col("must")), F.lit(False))
    return items.withColumn("must", first).select("category", "side", "rank", brief_line(F.col("item"), F.col("side"), must).alias("line"))


def competitive(rating: Column) -> Column:
    return (F.trim(rating) == "Toss-up") | F.trim(rating).startswith("Lean")


def top_governors(devs: DataFrame, roster: DataFrame, *, cap: int = 4) -> DataFrame:
    """The best developments in competitive races, with the number left over (WIN-02)."""
    rows = devs.join(roster.select("state", "candidate", "race_rating", "status"), ["state", "candidate"], "left")
    rows = rows.where(~F.coalesce("status", F.lit("")).isin("defeated", "withdrawn") & F.coalesce(competitive(F.col("race_rating")), F.lit(False)) & (F.col("relevance") >= 2))
    total = rows.agg(F.count(F.lit(1)).alias("total"))  # one row
    best = rows.orderBy(F.desc("relevance"), F.desc("article_count"), F.desc("date"), "event_id").limit(cap)
    return best.join(F.broadcast(total)).withColumn("overflow", F.greatest(F.col("total") - cap, F.lit(0))).drop("total")


def choose_owner(matches: DataFrame, *, cluster: str = "cluster_id") -> DataFrame:
    """One owner for each cluster: earliest date (blank last), most shared, first URL (WIN-03)."""
    best = F.struct(F.col("event_date").isNull(), F.col("event_date"), -F.col("shared"), F.col("pos"), F.col("event_id"))
    return matches.groupBy(cluster).agg(F.min_by(F.struct("event_id", "shared"), best).alias("o"), F.count(F.lit(1)).alias("candidates")).select(cluster, "o.*", "candidates")


def keep_best(df: DataFrame, *, key: str, order: list[Column]) -> DataFrame:
    """One row for each key (WIN-04, WIN-05)."""
    return top_per_group(df, group=[key], order=order, cap=1).drop("rank")


def keep_first_url(df: DataFrame, *, url: str = "url", seq: str = "seq") -> DataFrame:
    """The first row of each URL, rows without a place last; rows with a blank URL all stay (WIN-06)."""
    blank = F.coalesce(F.trim(url), F.lit("")) == ""
    rest = [c for c in df.columns if c != url]
    first = df.where(~blank).groupBy(url).agg(F.min_by(F.struct(*rest), F.struct(F.col(seq).isNull(), F.col(seq))).alias("r")).select(url, "r.*")
    return first.select(df.columns).unionByName(df.where(blank))


def page(df: DataFrame, *, order: list[Column], number: int, size: int = 10) -> DataFrame:
    """One page with its clamped number and the number of pages (WIN-13).

    The total is a count of its own; only rows up to the page's end are sorted out. For deep or many pages of one table,
    ``Pages`` sorts once and reads the page's range only.
    """
    total = df.count()
    pages = max(1, -(-total // size))
    at = min(max(number, 1), pages)
    return df.orderBy(*order).offset((at - 1) * size).limit(size).withColumn("page", F.lit(at)).withColumn("pages", F.lit(pages))


class Pages:
    """A table sorted once, of which any page is read from its own range (WIN-13).

    Ranges of the order are folders; how many rows each holds is the index, a number a range.
    """

    def __init__(self, df: DataFrame, *, order: list[Column], ranges: int | None = None):
        self.order, self.columns = order, df.columns
        self.part = _free(df, "range")
        deal = [ranges, *order] if ranges else order
        ranged = df.repartitionByRange(*deal).sortWithinPartitions(*order).withColumn(self.part, F.spark_partition_id())
        self.path, self.schema, self.spark = f"{shared_folder(df.sparkSession)}/pages-{uuid.uuid4().hex}", df.schema, df.sparkSession
        ranged.write.partitionBy(self.part).parquet(self.path)
        sizes = dict(self.spark.read.schema(ranged.schema).parquet(self.path).groupBy(self.part).count().collect())
        self.ranges = sorted(sizes)
        self.ends = list(itertools.accumulate(sizes[r] for r in self.ranges))

    def page(self, number: int, size: int = 10) -> DataFrame:
        """As ``page``; reads the one or two ranges that the page's rows lie in."""
        total = self.ends[-1] if self.ends else 0
        pages = max(1, -(-total // size))
        at = min(max(number, 1), pages)
        low, high = (at - 1) * size, min(at * size, total)
        first, last = bisect.bisect_right(self.ends, low), bisect.bisect_left(self.ends, high)
        start = self.ends[first - 1] if first else 0
        folders = [f"{self.path}/{self.part}={r}" for r in self.ranges[first : last + 1]]
        rows = self.spark.read.schema(self.schema).parquet(*folders) if folders else self.spark.createDataFrame([], self.schema)
        return rows.orderBy(*self.order).offset(low - start).limit(high - low).select(*self.columns, F.lit(at).alias("page"), F.lit(pages).alias("pages"))


def page_links(current: int, total: int) -> list[int | None]:
    """Page numbers to show: ends, neighbours of the current page; None is a gap."""
    shown = sorted({1, total, *(p for p in range(current - 1, current + 2) if 1 <= p <= total)})
    out: list[int | None] = []
    for p in shown:
        if out and p - out[-1] > 1:
            out.append(None)
        out.append(p)
    return out


def place_in(column: str, order: list[str]) -> Column:
    """Place of a value in a fixed order; unknown ones last."""
    at = F.array_position(F.array(*map(F.lit, order)), F.col(column))
    return F.when(at > 0, at).otherwise(len(order) + 1)


def numeric_then_text(column: str) -> list[Column]:
    """Numbers by value, then texts (WIN-16)."""
    number = F.try_to_number(F.when(F.col(column).rlike(r"^\d{1,9}$"), F.col(column)), F.lit("999999999"))
    return [number.asc_nulls_last(), F.col(column).asc_nulls_last()]


def sliding_count(df: DataFrame, *, key: str, ts: str, seconds: int = 60, most: int = 5) -> DataFrame:
    """Attempts of a key in the last ``seconds`` (this one too, the far end open), and whether they are too many (WIN-19).

    Time is cut into pieces of the window's length. A row is in its own piece and, as a bare time, in the next one, so a
    task sorts two pieces of a key and never all of its rows.
    """
    span = seconds * 1_000_000
    piece, at, own = _free(df, "piece"), _free(df, "at"), _free(df, "own")
    rows = df.withColumn(at, F.unix_micros(F.col(ts).cast("timestamp")))
    mine = F.floor(F.col(at) / F.lit(span))
    rest = [c for c in df.columns if c != key]
    in_piece = lambda p, o: F.struct(p.alias("p"), F.lit(o).alias("o"))
    # Rows without a time have one place: they are attempts of one moment.
    pieces = F.array_compact(F.array(in_piece(mine, True), F.when(mine.isNotNull(), in_piece(mine + 1, False))))
    both = rows.select(key, at, F.struct(*rest).alias(own), F.explode(pieces).alias(piece))
    both = both.select(key, at, F.when(F.col(piece)["o"], F.col(own)).alias(own), F.col(piece)["p"].alias(piece))
    w = Window.partitionBy(key, piece).orderBy(at).rangeBetween(-span + 1, 0)
    counted = both.withColumn("attempts", F.count(F.lit(1)).over(w)).where(F.col(own).isNotNull())
    return counted.select(*(F.col(key) if c == key else F.col(own)[c].alias(c) for c in df.columns), "attempts", (F.col("attempts") > most).alias("limited"))
