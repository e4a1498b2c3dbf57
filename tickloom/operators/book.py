"""Limit order book in batch, from window scans and aggregates alone.

An add raises the size at ``(contract, side, price)``; a cancel lowers it, never below zero. With
signed deltas d and running sum S the floored size is ``S_t - min(0, min over s<=t of S_s)``, so a
level needs a running sum and a running minimum. Both compose over pieces: a piece is summed up by
its total and its lowest running sum. Levels are therefore cut into pieces of time, scanned in
parallel, and carried forward through the short list of pieces, so that one busy level is spread
over many tasks.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.clock import BAR_NS, SECOND_NS, bucket_floor, bucket_index

LEVEL = ["contract_id", "side_sign", "price"]
ORDER = ["event_time", "sequence"]
PIECE_NS = 60 * SECOND_NS

# Bars and the spans of levels meet in a tree of buckets with this fan-out.
_FAN_BITS = 3
_FAN = 1 << _FAN_BITS
_DEPTHS = 9


def book_delta() -> Column:
    """Signed size an event adds to its level; null for an event that leaves the book alone."""
    action = F.upper("action")
    sided = (F.col("side_sign") != 0) & F.col("price").isNotNull()
    return F.when(sided & (action == "A"), F.col("size")).when(
        sided & (action == "C"), -F.col("size")
    )


def is_trade() -> Column:
    return F.coalesce(F.upper("action") == "T", F.lit(False))


def book_events(df: DataFrame) -> DataFrame:
    """The adds and cancels of a known side, as signed deltas of a level's size."""
    return (
        df.where(F.col("contract_id").isNotNull() & F.col("event_time").isNotNull())
        .select(*LEVEL, *ORDER, book_delta().alias("delta"))
        .where(F.col("delta").isNotNull())
    )


def _scan_pieces(df: DataFrame, piece_ns: int) -> DataFrame:
    """Running sum and running minimum inside each ``(level, piece)``, and its last row marked."""
    w = Window.partitionBy(*LEVEL, "piece").orderBy(*ORDER)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Never null, so that joining on it adds no filter to one side only and both sides of the
    # later join read the same shuffle.
    piece = F.coalesce(bucket_floor("event_time", piece_ns), F.lit(0))
    return (
        book_events(df)
        .withColumn("piece", piece)
        .withColumn("run", F.sum("delta").over(upto))
        .withColumn("next_time", F.lead("event_time").over(w))
        .withColumn("low", F.min("run").over(upto))
    )


def _carry(scanned: DataFrame) -> DataFrame:
    """What each piece inherits: the sum before it and the lowest running sum before it.

    A piece's last row already holds its total and its lowest running sum, so summing up takes a
    filter and no further shuffle of the events.
    """
    earlier = (
        Window.partitionBy(*LEVEL)
        .orderBy("piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        scanned.where(F.col("next_time").isNull())
        .select(*LEVEL, "piece", F.col("run").alias("total"), F.col("low").alias("piece_low"))
        .withColumn("base", F.coalesce(F.sum("total").over(earlier), F.lit(0)))
        .withColumn("lowest", F.min(F.col("base") + F.col("piece_low")).over(earlier))
    )


def _floored(total: Column, *lows: Column) -> Column:
    return total - F.least(F.lit(0).cast("long"), *lows)


def _with_size(scanned: DataFrame, carry: DataFrame) -> DataFrame:
    joined = scanned.join(carry.select(*LEVEL, "piece", "base", "lowest"), [*LEVEL, "piece"])
    size = _floored(
        F.col("base") + F.col("run"), F.col("base") + F.col("low"), F.col("lowest")
    )
    return joined.withColumn("level_size", size)


def book_levels(df: DataFrame, *, piece_ns: int = PIECE_NS) -> DataFrame:
    """Size of the touched level after every add and cancel of normalised events."""
    scanned = _scan_pieces(df, piece_ns)
    return _with_size(scanned, _carry(scanned)).select(*LEVEL, *ORDER, "level_size")


def book_snapshot(df: DataFrame, *, at_ns: int | None = None, piece_ns: int = PIECE_NS) -> DataFrame:
    """The live levels at ``at_ns`` inclusive (or at the end), from the piece summaries alone."""
    if at_ns is not None:
        df = df.where(F.col("event_time") <= at_ns)
    pieces = _carry(_scan_pieces(df, piece_ns))
    size = _floored(F.sum("total"), F.min(F.col("base") + F.col("piece_low")))
    return pieces.groupBy(*LEVEL).agg(size.alias("level_size")).where("level_size > 0")


def level_closes(
    df: DataFrame, width_ns: int = BAR_NS, *, piece_ns: int | None = None
) -> DataFrame:
    """Size of each touched level at the end of each bucket that touched it."""
    piece_ns = piece_ns or -(-PIECE_NS // width_ns) * width_ns
    if piece_ns % width_ns:
        raise ValueError("piece_ns must be a multiple of width_ns")
    scanned = _scan_pieces(df, piece_ns)
    bucket = bucket_floor("event_time", width_ns)
    moves_on = F.col("next_time").isNull() | (bucket_floor("next_time", width_ns) != bucket)
    last = scanned.where(moves_on).withColumn("bucket_ns", bucket)
    return _with_size(last, _carry(scanned)).select(*LEVEL, "bucket_ns", "level_size")


def _cell(depth: str) -> Column:
    """Buckets in a node of this depth."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col(depth) * _FAN_BITS)


def _node(index: Column, depth: str) -> Column:
    """Number of the node of this depth that holds a bucket."""
    return F.call_function("shiftright", index, F.col(depth) * _FAN_BITS)


def _deepest(length: Column) -> Column:
    """Depth of the largest nodes that a span of this many buckets can hold."""
    bits = F.length(F.bin(length)) - 1
    return F.least(F.lit(_DEPTHS - 1), F.floor(bits / _FAN_BITS).cast("int"))


def _cover(spans: DataFrame) -> DataFrame:
    """Cut each span ``[a, b)`` of bucket numbers into whole nodes of the bucket tree.

    A node of depth k holds ``_FAN ** k`` buckets. A span needs a number of nodes that grows with
    the logarithm of its length, whereas pairing it with its buckets would grow with the length.
    """
    fan = F.lit(_FAN).cast("long")
    deepest = _deepest(F.col("b") - F.col("a"))
    at_depth = (
        spans.withColumn("depth", F.explode(F.sequence(F.lit(0), deepest)))
        .withColumn("lo", _node(F.col("a") + _cell("depth") - 1, "depth"))
        .withColumn("hi", _node(F.col("b"), "depth"))
        .where("lo < hi")
        .withColumn("lo_up", F.col("lo") + F.pmod(-F.col("lo"), fan))
        .withColumn("hi_down", F.col("hi") - F.pmod(F.col("hi"), fan))
    )
    none = F.array().cast("array<bigint>")
    steps = lambda x, y: F.when(x < y, F.sequence(x, y - 1)).otherwise(none)
    last_depth = F.col("depth") == _DEPTHS - 1
    nodes = F.when(
        last_depth | (F.col("lo_up") >= F.col("hi_down")), steps(F.col("lo"), F.col("hi"))
    ).otherwise(
        F.concat(steps(F.col("lo"), F.col("lo_up")), steps(F.col("hi_down"), F.col("hi")))
    )
    return at_depth.withColumn("node", F.explode(nodes))


def book_top(
    df: DataFrame, width_ns: int = BAR_NS, *, piece_ns: int | None = None
) -> DataFrame:
    """Best bid and ask of the reconstructed book at the end of every bucket with an event."""
    by_level = Window.partitionBy(*LEVEL).orderBy("bucket_ns")
    # One row: the end of the data closes the spans of levels that are never touched again, and
    # its whole length bounds the depth at which a bar has to look.
    index = bucket_index("event_time", width_ns)
    horizon = df.agg(F.max(index) + 1).scalar()
    deepest = df.agg(F.coalesce(_deepest(F.max(index) - F.min(index) + 1), F.lit(0))).scalar()
    spans = (
        level_closes(df, width_ns, piece_ns=piece_ns)
        .withColumn("a", bucket_index("bucket_ns", width_ns))
        .withColumn("b", F.coalesce(F.lead("a").over(by_level), horizon))
        .where("level_size > 0 AND a < b")
        .select(*LEVEL, "a", "b")
    )
    best = (
        _cover(spans)
        .groupBy("contract_id", "depth", "node")
        .agg(
            F.max(F.when(F.col("side_sign") == 1, F.col("price"))).alias("bid"),
            F.min(F.when(F.col("side_sign") == -1, F.col("price"))).alias("ask"),
        )
    )
    buckets = df.select(
        "contract_id", bucket_floor("event_time", width_ns).alias("bucket_ns")
    ).distinct()
    depths = buckets.withColumn("deepest", deepest)
    paths = depths.withColumn(
        "depth", F.explode(F.sequence(F.lit(0), F.col("deepest")))
    ).withColumn("node", _node(bucket_index("bucket_ns", width_ns), "depth"))
    top = (
        paths.join(best, ["contract_id", "depth", "node"], "left")
        .groupBy("bucket_ns", "contract_id")
        .agg(F.max("bid").alias("best_bid"), F.min("ask").alias("best_ask"))
    )
    bid, ask = F.col("best_bid"), F.col("best_ask")
    return top.select(
        "contract_id",
        "bucket_ns",
        "best_bid",
        "best_ask",
        (ask - bid).alias("spread"),
        ((ask + bid) / 2.0).alias("mid"),
    )


def level_deltas(df: DataFrame, width_ns: int = BAR_NS) -> DataFrame:
    """Added and cancelled size per level and bucket."""
    action = F.upper("action")
    return (
        df.where(action.isin("A", "C") & (F.col("side_sign") != 0))
        .groupBy(
            bucket_floor("event_time", width_ns).alias("bucket_ns"),
            *LEVEL,
            action.alias("action"),
        )
        .agg(F.sum("size").alias("size_sum"))
        .select("contract_id", "bucket_ns", "side_sign", "price", "action", "size_sum")
    )


def trade_stats(df: DataFrame, width_ns: int = BAR_NS) -> DataFrame:
    """Last trade and volume so far of a contract, at the end of every bucket with a trade.

    Trades collapse to buckets before the running sum, so a contract's window grows with time and
    not with its volume.
    """
    last = F.max(F.struct(*ORDER, "price", "size"))
    per_bucket = (
        df.where(is_trade())
        .groupBy(bucket_floor("event_time", width_ns).alias("bucket_ns"), "contract_id")
        .agg(last.alias("last"), F.sum("size").alias("volume"))
    )
    so_far = (
        Window.partitionBy("contract_id")
        .orderBy("bucket_ns")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return per_bucket.select(
        "contract_id",
        "bucket_ns",
        F.col("last.price").alias("last_trade_price"),
        F.col("last.size").alias("last_trade_size"),
        F.sum("volume").over(so_far).alias("total_volume"),
    )
