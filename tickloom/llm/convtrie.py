"""Prefix trie of conversations: adaptive radix trees over big-endian turn ids.

Every distinct turn gets an eight-byte id; a conversation is the row of its ids. Conversations are
sorted by that row over all tasks, so that a task holds a range of the trie, and builds an adaptive
radix tree of its range. A node below which only this range lies is complete there. A node that
neighbouring ranges share is summed up over them: each range counts a child where it is seen first
and a leaf where it is seen last, which the common prefixes of neighbouring borders tell, so sums
are exact, and a common first turn or thousands of copies of a conversation spread over tasks.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.sources.stage import materialize

# Fixed value: bytes of a turn id; nodes are emitted at multiples of it.
WIDTH = 8

# Turn ids of a range, about; a range's tree is built in memory.
RANGE_TURNS = 1 << 17


class Node:
    """A tree node: its compressed path, the ids that end at it, and children by their next byte.

    The path is ``key[start:end]`` of some key below. Children are laid out by their number: up to
    4 or 16 as parallel rows of bytes and nodes, up to 48 by an index of 256 bytes into a row of
    nodes, and beyond that as a row of 256.
    """

    __slots__ = ("key", "start", "end", "ends", "size", "bytes", "nodes", "n", "least", "leaves", "saved", "tops")

    def __init__(self, key: bytes, start: int, end: int) -> None:
        self.key, self.start, self.end = key, start, end
        self.ends: list[int] = []
        self.size, self.bytes, self.nodes = 4, bytearray(), []

    def find(self, byte: int) -> "Node | None":
        if self.size <= 16:
            at = self.bytes.find(byte)
            return self.nodes[at] if at >= 0 else None
        if self.size == 48:
            at = self.bytes[byte]
            return self.nodes[at - 1] if at else None
        return self.nodes[byte]

    def _grow(self) -> None:
        if self.size == 4:
            self.size = 16
        elif self.size == 16:
            index = bytearray(256)
            for at, byte in enumerate(self.bytes):
                index[byte] = at + 1
            self.size, self.bytes = 48, index
        else:
            row: list[Node | None] = [None] * 256
            for byte in range(256):
                if self.bytes[byte]:
                    row[byte] = self.nodes[self.bytes[byte] - 1]
            self.size, self.bytes, self.nodes = 256, bytearray(), row

    def put(self, byte: int, child: "Node") -> None:
        """Add a child, or put another in the place of one."""
        if self.size <= 16:
            at = self.bytes.find(byte)
            if at >= 0:
                self.nodes[at] = child
                return
            if len(self.nodes) < self.size:
                self.bytes.append(byte)
                self.nodes.append(child)
                return
        elif self.size == 48:
            if self.bytes[byte]:
                self.nodes[self.bytes[byte] - 1] = child
                return
            if len(self.nodes) < 48:
                self.nodes.append(child)
                self.bytes[byte] = len(self.nodes)
                return
        else:
            self.nodes[byte] = child
            return
        self._grow()
        self.put(byte, child)

    def children(self) -> list["Node"]:
        """In the order of their bytes."""
        if self.size <= 16:
            return [n for _, n in sorted(zip(self.bytes, self.nodes), key=lambda x: x[0])]
        if self.size == 48:
            return [self.nodes[at - 1] for at in self.bytes if at]
        return [n for n in self.nodes if n is not None]


def _common(a: bytes, b: bytes, start: int, end: int) -> int:
    """Where ``a`` and ``b`` part between two places, at the latest at ``end``."""
    while start < end:  # whole pieces first: paths can be long
        step = min(64, end - start)
        if a[start : start + step] == b[start : start + step]:
            start += step
            continue
        while a[start] == b[start]:
            start += 1
        return start
    return end


def insert(root: Node, key: bytes, value: int) -> None:
    """Add a key; the root has an empty path."""
    node = root
    while node.end < len(key):
        child = node.find(key[node.end])
        if child is None:
            leaf = Node(key, node.end, len(key))
            leaf.ends.append(value)
            node.put(key[node.end], leaf)
            return
        at = _common(child.key, key, child.start, min(child.end, len(key)))
        if at < child.end:  # the path parts, or the key ends, inside it
            upper = Node(child.key, child.start, at)
            child.start = at
            upper.put(child.key[at], child)
            node.put(key[node.end], upper)
            child = upper
        node = child
    node.ends.append(value)


_NODE = pa.schema(
    [
        ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
        ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
        # Of nodes that ranges share, and of nodes below one: names of prefixes, and listed ends.
        ("name", pa.binary()), ("parent_name", pa.binary()), ("ends", pa.binary()), ("range", pa.int64()),
    ]
)
_NODE_DDL = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string, name binary, parent_name binary, ends binary, range long"
)
_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _names(key: bytes, depths: int) -> list[bytes]:
    """A name for each prefix of up to so many turns."""
    running, out = hashlib.sha256(), []
    for d in range(depths + 1):
        out.append(running.digest())
        running.update(key[d * WIDTH : (d + 1) * WIDTH])
    return out


class Range:
    """The trie of one range of sorted conversations, and what its neighbours share of it.

    ``before`` and ``after`` are the turns that the range's first and last conversation have in
    common with the conversation next to them in another range, -1 at either end of all ranges.
    ``goes_on`` is true if the last one is the beginning of the next, so that it may be no leaf.
    """

    def __init__(self, at: int, before: int, after: int, goes_on: bool) -> None:
        self.at, self.before, self.after, self.goes_on = at, before, after, goes_on
        self.root = Node(b"", 0, 0)
        self.chars: dict[bytes, int] = {}

    def add(self, conv_id: int, ids: np.ndarray, chars: np.ndarray) -> None:
        key = ids.astype(">u8").tobytes()
        for d, n in enumerate(chars.tolist()):
            self.chars[key[d * WIDTH : (d + 1) * WIDTH]] = n
        insert(self.root, key, conv_id)

    def _sum_up(self) -> list[tuple[Node, bool, bool]]:
        """Members, least member, leaves and savings of each tree node, from the leaves up; the tree
        nodes from the root down, each with whether it leads to the first and to the last key."""
        order, todo = [], [(self.root, True, True)]
        while todo:
            node, first, last = todo.pop()
            order.append((node, first, last))
            below = node.children()
            for i, child in enumerate(below):
                # A key that ends here comes before all that go on.
                todo.append((child, first and i == 0 and not node.ends, last and i == len(below) - 1))
        for node, first, last in reversed(order):
            below = node.children()
            node.n = len(node.ends) + sum(c.n for c in below)
            node.least = min([*node.ends, *(c.least for c in below)])
            node.leaves = sum(c.leaves for c in below)
            if not below and not (last and self.goes_on):
                node.leaves = 1
            node.saved = sum(c.saved for c in below)
            # Turn nodes right below this place, counted where they are seen first.
            node.tops = sum(c.tops for c in below)
            depths = range(node.end // WIDTH, node.start // WIDTH, -1)
            for d in depths:
                node.saved += (node.n - self._is_new(d, first)) * self._length(node.key, d)
            if len(depths):
                node.tops = int(self._is_new(depths[-1], first))
        return order

    def _is_new(self, depth: int, first: bool) -> bool:
        return not (first and depth <= self.before)

    def _length(self, key: bytes, depth: int) -> int:
        return self.chars[key[(depth - 1) * WIDTH : depth * WIDTH]]

    def nodes(self) -> Iterator[tuple]:
        """Rows of the node table: complete nodes, and this range's part of shared ones."""
        order = self._sum_up()
        # A key that ends above others is their first; the last one has none below.
        low_key = next((n.key[: n.end] for n, first, _ in order if first and n.ends), b"")
        high_key = next((n.key[: n.end] for n, _, last in reversed(order) if last), b"")
        edges = [_names(low_key, self.before), _names(high_key, self.after)]
        above: dict[int, tuple[int, bytes | None]] = {}
        for node, first, last in order:
            parent = above.pop(id(node), (None, None))
            low, high = node.start // WIDTH + 1, node.end // WIDTH
            if node is self.root:
                low = 0
            below = node.children()
            saved = node.saved
            rows = []
            for d in range(low, high + 1):
                name = None
                if first and d <= self.before:
                    name = edges[0][d]
                elif last and d <= self.after:
                    name = edges[1][d]
                at_end = d * WIDTH == node.end
                children = sum(c.tops for c in below) if d == high else int(self._is_new(d + 1, first))
                ends = sorted(node.ends) if at_end else []
                text = ",".join(map(str, ends)).encode()
                rows.append((
                    node.least, d, parent[0], node.n, children, node.leaves, saved,
                    None if name else hashlib.sha256(text).hexdigest(),
                    name, parent[1], text if name and ends else None, self.at,
                ))
                parent = (None, name) if name else (node.least, None)
                if d:
                    saved -= (node.n - self._is_new(d, first)) * self._length(node.key, d)
            yield from rows
            for child in below:
                above[id(child)] = parent


def _build(table: pa.Table) -> pa.Table:
    head = table.slice(0, 1).to_pylist()[0]
    own = Range(head["range"], head["before"], head["after"], head["goes_on"])
    order = table.select(["conv_id", "ids", "chars"])
    for batch in order.to_batches(max_chunksize=1024):
        starts = batch["ids"].offsets.to_numpy()
        ids, chars = batch["ids"].values.to_numpy(), batch["chars"].values.to_numpy()
        for i, conv_id in enumerate(batch["conv_id"].to_pylist()):
            here = slice(starts[i], starts[i + 1])
            own.add(conv_id, ids[here], chars[here])
    columns = list(zip(*own.nodes()))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _NODE)], schema=_NODE)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation's turn ids and their lengths, after rebuilding.

    A conversation takes the first h turns of the first conversation of its hundred, and its own
    turns after its first h; h is the remainder by six of the checksum of its number.

    Rows without ``conv_id`` are dropped. Turns go by ``turn``, null first; equal ones by the SHA-256
    of their role and text, and equal rows are turns of their own. Ids are dealt in the order of
    that hash, so they decide ties alike.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.unhex(F.sha2(F.concat_ws(":", F.char_length(role).cast("string"), role, text), 256)).alias("turn_key"),
        F.char_length(text).cast("long").alias("n"),
    )
    turns = materialize(turns, "conversation-turns")
    # A common turn is one row a task before the shuffle; ids rise with the key.
    keys = turns.groupBy("turn_key").agg(F.count(F.lit(1)).alias("uses")).drop("uses")
    named = keys.orderBy("turn_key").withColumn("id", F.monotonically_increasing_id())
    named = materialize(named, "conversation-turn-ids")
    # The length is a property of the key, so it may come along from either side.
    listed = (
        turns.join(named, "turn_key")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "id", "n"))).alias("own"))
    )
    listed = materialize(listed, "conversation-ids")
    base = listed.where(F.col("conv_id") % 100 == 0).select(
        F.col("conv_id").alias("base_id"), F.slice("own", 1, 5).alias("base")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % 6).cast("int")
    none = F.expr("slice(own, 1, 0)")
    whole = F.concat(
        F.slice(F.coalesce("base", none), F.lit(1), h),
        F.slice("own", h + 1, F.size("own")),
    )
    return (
        listed.withColumn("base_id", F.col("conv_id") - F.col("conv_id") % 100)
        .join(base, "base_id", "left")
        .withColumn("whole", whole)
        .select("conv_id", F.col("whole.id").alias("ids"), F.col("whole.n").alias("chars"))
    )


def _borders(rows: DataFrame) -> DataFrame:
    """A row for each range: what its borders have in common with the ranges next to it."""
    ends = rows.groupBy("range").agg(F.min("ids").alias("low"), F.max("ids").alias("high"))
    along = Window.partitionBy(F.lit(0)).orderBy("range")

    def common(a, b):
        same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
        parted = F.array_position(same, F.lit(False))
        return F.when(parted == 0, F.size(same)).otherwise(parted - 1).cast("long")

    ends = ends.withColumns({"left": F.lag("high").over(along), "right": F.lead("low").over(along)})
    after = F.coalesce(common(F.col("high"), F.col("right")), F.lit(-1).cast("long"))
    return ends.select(
        "range",
        F.coalesce(common(F.col("left"), F.col("low")), F.lit(-1).cast("long")).alias("before"),
        after.alias("after"),
        (after == F.size("high")).alias("goes_on"),
    )


def _digest_ends(shared: DataFrame) -> DataFrame:
    """SHA-256 of a shared node's ends over all its ranges, read in order, a range's list at a time.

    The digest of one list is one sequence of bytes, so a node's lists go through one task; they
    are streamed and hold nothing but the ends' numbers.
    """
    lists = shared.where(F.col("ends").isNotNull()).select("name", "range", "ends")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, running = None, None
        layout = pa.schema([("name", pa.binary()), ("ends_sha256", pa.string())])
        for batch in batches:
            done = []
            for at, part in zip(batch["name"].to_pylist(), batch["ends"].to_pylist()):
                if at != name:
                    if name is not None:
                        done.append((name, running.hexdigest()))
                    name, running = at, hashlib.sha256(part)
                else:
                    running.update(b"," + part)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], f.type) for i, f in enumerate(layout)], schema=layout)
        if name is not None:
            yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([running.hexdigest()])], schema=layout)

    dealt = lists.repartition("name").sortWithinPartitions("name", "range")
    return dealt.mapInArrow(run, "name binary, ends_sha256 string")


def trie(sequences: DataFrame, *, range_turns: int = RANGE_TURNS) -> DataFrame:
    """The trie's nodes, from ``conv_id``, ``ids`` and ``chars`` of each conversation.

    A conversation is one row of twelve to sixteen bytes a turn and must fit into a task; ranges
    hold about ``range_turns`` turns. Without conversations there is no node, not even the root.
    """
    spark = sequences.sparkSession
    staged = materialize(sequences, "conversation-sequences")
    turns = staged.agg(F.coalesce(F.sum(F.size("ids") + 1), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // range_turns))
    # The number splits copies of one conversation, and keeps their numbers in order over ranges.
    rows = staged.repartitionByRange(parts, "ids", "conv_id").withColumn("range", F.spark_partition_id().cast("long"))
    rows = materialize(rows, "conversation-ranges")
    # One row of three numbers a range, which bounds the broadcast.
    placed = rows.join(F.broadcast(_borders(rows)), "range")
    nodes = materialize(placed.groupBy("range").applyInArrow(_build, _NODE_DDL), "conversation-nodes")
    complete = nodes.where(F.col("name").isNull())
    parts_of = nodes.where(F.col("name").isNotNull())
    shared = (
        parts_of.groupBy("name")
        .agg(
            F.first("depth").alias("depth"), F.first("parent_name").alias("parent_name"), F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        )
        .join(_digest_ends(parts_of), "name", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())))
    )
    shared = materialize(shared, "conversation-shared")
    parents = shared.select(F.col("name").alias("parent_name"), F.col("conv_id").alias("above"))
    hanging = complete.where(F.col("parent_name").isNotNull()).drop("name").unionByName(shared, allowMissingColumns=True)
    hanging = hanging.join(parents, "parent_name", "left").withColumn("parent_conv_id", F.col("above"))
    whole = complete.where(F.col("parent_name").isNull()).select(*_COLUMNS)
    return whole.unionByName(hanging.select(*_COLUMNS))


def conversation_trie(
    conversations: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    range_turns: int = RANGE_TURNS,
) -> DataFrame:
    """Nodes of the trie of rebuilt conversations; other columns are not looked at.

    A null role or text is empty, a null turn comes first, rows without a conversation are dropped,
    equal turns and repeated rows are turns of their own (see ``rebuilt``), texts may have any
    length, and an empty table has no node.
    """
    names = zip((conv_col, turn_col, role_col, text_col), ("conv_id", "turn", "role", "text"))
    return trie(rebuilt(conversations.select(*[F.col(a).alias(b) for a, b in names])), range_turns=range_turns)
