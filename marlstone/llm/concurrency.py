"""Open sales by nation over time: a segmented scan by a tree's up-sweep and down-sweep.

Starts and ends become changes, summed by (nation, minute) before anything is ordered.  The
changes are dealt by range in the order of (nation, minute) and cut into blocks of at most
``BLOCK_ROWS`` rows.  A block's summary says what a run of rows does to a scan: its first and
last nation, whether a nation begins inside (``reset``), and for its leading and trailing nation
the sums and the largest prefix sums.  ``_joined`` of two neighbours' summaries is associative, so

* the up-sweep joins at most ``FAN`` neighbours into one summary, level by level, and
* the down-sweep hands each block the summary of all rows before it and of all rows after it.

A row's values are then its own block's prefix sums and what these two say of its nation: open
sales and cents from the left, the next moment and the nation's largest sum from the right.  No
task sees more than one block or one node's children, and the driver one number (how many blocks a
partition has); a nation with a third of all rows is just many blocks.

Defined results: moments are UTC seconds rounded down to minutes; a null or non-finite total is
0 cents; of repeated rows of a client the least nation counts; repeated rows of a sale each
count; a sale without id has no lines, and is open for ever; ties (several changes of one nation in
one minute) are one row, or none where they cancel out; empty tables give no row; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Tidy, cut, let

#: Rows of a block, children of a node of the tree.
BLOCK_ROWS = 4096
FAN = 32

#: How long a sale stays open after its first line is shipped, the nation of clients that
#: have none, and the nation that stands for all.
OPEN_SECONDS = 7 * 86_400
NO_NATION = -1
ALL_NATIONS = -2

_INDEX_BITS = 33  # of the row's place in its partition, in monotonically_increasing_id()


def minute_of(df: DataFrame, column: str) -> Column:
    """UTC seconds since 1970 of a timestamp with or without zone, rounded down to 60."""
    moment = df[column]
    if df.schema[column].dataType.typeName() == "timestamp":
        seconds = F.unix_seconds(moment)
        return seconds - F.pmod(seconds, F.lit(60))
    days = F.unix_date(moment.cast("date")).cast("long")
    return days * 86_400 + F.hour(moment) * 3600 + F.minute(moment) * 60


def open_intervals(sales: DataFrame, lines: DataFrame, clients: DataFrame) -> DataFrame:
    """(nation_id, start, end, cents) of each sale that is open at some time; end null: for ever.

    The first shipping and the nation are reduced to a row for each key and written first, so
    that both joins are plain sort-merge joins, whose hot keys (a client with a third of all
    sales) adaptive execution splits.
    """
    shipped = lines.select("sale_id", minute_of(lines, "shipped_at").alias("first")).where("sale_id is not null and first is not null")
    shipped = cut(shipped.groupBy("sale_id").agg((F.min("first") + OPEN_SECONDS).alias("end")), "first-shipped")
    nations = clients.select("client_id", "nation_id").where("client_id is not null and nation_id is not null")
    nations = cut(nations.groupBy("client_id").agg(F.min("nation_id").cast("int").alias("nation_id")), "nations")
    total = sales["total"].cast("double")
    finite = (F.abs(total) < float("inf")) & ~F.isnan(total)
    sold = sales.select(
        "sale_id",
        "client_id",
        minute_of(sales, "sold_at").alias("start"),
        F.when(finite, F.floor(100 * total + 0.5)).otherwise(F.lit(0)).cast("long").alias("cents"),
    ).where("start is not null")
    timed = sold.join(shipped.hint("merge"), "sale_id", "left").where("end is null or end > start")
    return timed.join(nations.hint("merge"), "client_id", "left").select(F.coalesce("nation_id", F.lit(NO_NATION)).alias("nation_id"), "start", "end", "cents")


def changes(intervals: DataFrame) -> DataFrame:
    """(nation_id, at, n, cents): what starts and ends change in a nation at a moment, for
    each nation and for ``ALL_NATIONS``; moments at which nothing changes are left out."""

    def change(nation: Column, start: bool) -> Column:
        sign = 1 if start else -1
        return F.struct(nation.alias("nation_id"), F.col("start" if start else "end").alias("at"), F.lit(sign).cast("long").alias("n"), (sign * F.col("cents")).alias("cents"))

    nations = (F.col("nation_id"), F.lit(ALL_NATIONS))
    each = intervals.select(F.inline(F.array(*(change(nation, start) for nation in nations for start in (True, False))))).where("at is not null")
    return each.groupBy("nation_id", "at").agg(F.sum("n").alias("n"), F.sum("cents").alias("cents")).where("n <> 0 or cents <> 0")


def _sum_of(side: Column, prefix: str, other: Column | None = None, before: str = "") -> tuple[Column, Column, Column, Column]:
    """(n, cents, largest n, largest cents) of one end of a summary, or of an end followed by the other side's."""
    parts = tuple(side[f"{prefix}_{name}"] for name in ("n", "cents", "max_n", "max_cents"))
    if other is None:
        return parts
    n, cents, max_n, max_cents = (other[f"{before}_{name}"] for name in ("n", "cents", "max_n", "max_cents"))
    return n + parts[0], cents + parts[1], F.greatest(max_n, n + parts[2]), F.greatest(max_cents, cents + parts[3])


def _joined(left: Column, right: Column) -> Column:
    """The summary of two neighbouring runs of rows; null is the summary of none."""
    same = left["last_nation"] == right["first_nation"]
    on = same & ~left["reset"]  # the leading nation goes on into the right run
    back = same & ~right["reset"]  # the trailing nation came from the left run
    head = zip(_sum_of(right, "head", left, "head"), _sum_of(left, "head"))
    tail = zip(_sum_of(right, "tail", left, "tail"), _sum_of(right, "tail"))
    names = ("n", "cents", "max_n", "max_cents")
    both = F.struct(
        left["first_nation"].alias("first_nation"),
        left["first_at"].alias("first_at"),
        right["last_nation"].alias("last_nation"),
        (left["reset"] | right["reset"] | ~same).alias("reset"),
        *(F.when(on, a).otherwise(b).alias(f"head_{name}") for name, (a, b) in zip(names, head)),
        *(F.when(back, a).otherwise(b).alias(f"tail_{name}") for name, (a, b) in zip(names, tail)),
    )
    return F.when(left.isNull(), right).when(right.isNull(), left).otherwise(both)


def _placed(moves: DataFrame, block_rows: int) -> DataFrame:
    """``moves`` in blocks of at most ``block_rows`` neighbouring rows of the order (nation, at)."""
    parts = int(moves.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = moves.repartitionByRange(parts, "nation_id", "at").sortWithinPartitions("nation_id", "at")
    place = F.monotonically_increasing_id()
    index = place.bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    placed = dealt.select("*", F.shiftright(place, _INDEX_BITS).alias("part"), F.floor(index / block_rows).alias("chunk"))
    return cut(placed, "blocks")


def _prefixes(placed: DataFrame) -> DataFrame:
    """Rows with what is known inside their block: prefix sums by nation, largest ones, next moment."""
    own = Window.partitionBy("block", "nation_id")
    run = own.orderBy("at")
    sums = placed.repartition("block").select(
        "block", "nation_id", "at", F.sum("n").over(run).alias("n"), F.sum("cents").over(run).alias("cents"), F.lead("at").over(run).alias("next_at"),
    )
    return sums.select("*", F.max("n").over(run).alias("high"), F.max("cents").over(own).alias("max_cents"), F.last("cents").over(own.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("end_cents"))


def _block_summaries(prefixes: DataFrame) -> DataFrame:
    """(block, summary) from a row for each block and nation."""
    by_nation = prefixes.groupBy("block", "nation_id").agg(
        F.min("at").alias("at"), F.max_by("n", "at").alias("n"), F.max_by("cents", "at").alias("cents"), F.max("n").alias("max_n"), F.max("cents").alias("max_cents"),
    )
    ends = by_nation.groupBy("block").agg(*(least(F.struct(*by_nation.columns[1:])).alias(name) for least, name in ((F.min, "head"), (F.max, "tail"))))
    names = ("n", "cents", "max_n", "max_cents")
    return ends.select(
        "block",
        F.struct(
            F.col("head.nation_id").alias("first_nation"),
            F.col("head.at").alias("first_at"),
            F.col("tail.nation_id").alias("last_nation"),
            (F.col("head.nation_id") != F.col("tail.nation_id")).alias("reset"),
            *(F.col(f"{end}.{name}").alias(f"{end}_{name}") for end in ("head", "tail") for name in names),
        ).alias("summary"),
    )


def _up(level: DataFrame, fan: int) -> DataFrame:
    """(block, kids, summary): the nodes over ``level`` (block, summary), each with its children in order."""
    nodes = level.groupBy(F.floor(F.col("block") / fan).alias("block")).agg(F.array_sort(F.collect_list(F.struct(F.col("block").alias("id"), "summary"))).alias("kids"))
    runs = F.transform("kids", lambda kid: kid["summary"])
    return nodes.select("block", "kids", F.aggregate(F.slice(runs, 2, fan), F.element_at(runs, 1), _joined).alias("summary"))


def _down(nodes: DataFrame, carried: DataFrame) -> DataFrame:
    """(block, left, right) of the children of ``nodes``, given those of the nodes."""
    fold = lambda start, runs: F.aggregate(runs, start, _joined)
    at = nodes.join(carried.hint("merge"), "block").select("left", "right", "kids", F.transform("kids", lambda kid: kid["summary"]).alias("runs"), F.posexplode("kids").alias("place", "kid"))
    before, after = F.slice("runs", 1, F.col("place")), F.slice("runs", F.col("place") + 2, F.size("runs"))
    right = F.when(F.size(after) == 0, F.col("right")).otherwise(
        let(F.aggregate(F.slice(after, 2, F.size("runs")), F.element_at(after, 1), _joined), lambda run: _joined(run, F.col("right")))
    )
    return at.select(F.col("kid.id").alias("block"), fold(F.col("left"), before).alias("left"), right.alias("right"))


def sweep(moves: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """A row for each row of ``moves`` (nation_id, at, n, cents; distinct by nation and moment):
    nation_id, from_s, to_s, n_open, open_cents, high_open, is_peak."""
    placed = _placed(moves, block_rows)
    parts, chunks = placed.agg(F.max("part"), F.max("chunk")).first()
    chunks = (chunks or 0) + 1
    prefixes = _prefixes(placed.withColumn("block", F.col("part") * chunks + F.col("chunk")))
    level = cut(_block_summaries(prefixes), "summaries")
    carried, top, nodes = None, ((parts or 0) + 1) * chunks, []
    summary = level.schema["summary"].dataType
    while top > 1:
        top = -(-top // fan)
        nodes.append(cut(_up(level, fan), "nodes"))
        level = nodes[-1].select("block", "summary")
    none = F.lit(None).cast(summary)
    carried = level.select("block", none.alias("left"), none.alias("right"))
    for node in reversed(nodes):
        carried = cut(_down(node, carried), "carried")
    rows = prefixes.join(carried.hint("merge"), "block")
    nation = F.col("nation_id")
    comes = F.coalesce(F.col("left.last_nation") == nation, F.lit(False))
    goes = F.coalesce(F.col("right.first_nation") == nation, F.lit(False)) & F.col("next_at").isNull()
    before = lambda name: F.when(comes, F.col(f"left.tail_{name}"))
    n, cents = (F.coalesce(before(name), F.lit(0)) for name in ("n", "cents"))
    largest = F.greatest(
        before("max_cents"),
        cents + F.col("max_cents"),
        F.when(F.coalesce(F.col("right.first_nation") == nation, F.lit(False)), cents + F.col("end_cents") + F.col("right.head_max_cents")),
    )
    return rows.select(
        "nation_id",
        F.col("at").alias("from_s"),
        F.coalesce("next_at", F.when(goes, F.col("right.first_at"))).alias("to_s"),
        (n + F.col("n")).alias("n_open"),
        (cents + F.col("cents")).alias("open_cents"),
        F.greatest(before("max_n"), n + F.col("high")).alias("high_open"),
        (cents + F.col("cents") == largest).alias("is_peak"),
    )


def peak_concurrency(sales: DataFrame, lines: DataFrame, clients: DataFrame, block_rows: int = BLOCK_ROWS, fan: int = FAN) -> DataFrame:
    """The contract's rows: how many sales each nation has open from each moment on."""
    with Tidy() as tidy:
        moves = changes(open_intervals(sales, lines, clients))
        out = cut(sweep(moves, block_rows, fan), "concurrency")
        tidy.keep(out)
    return out
