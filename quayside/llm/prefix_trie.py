"""Which conversations begin alike: a prefix trie over turns, from adaptive radix trees.

A turn's id is 128 bits of the SHA-256 of its role and text, big-endian, so a
conversation is a key of 16 bytes a turn and texts are never shuffled. Equal
keys become one with their number. Keys are range-partitioned, which splits a
hot prefix over as many tasks as its keys need, and each part builds an
adaptive radix tree: nodes hold 4, 16, 48 or 256 children and grow as these
come, and a path without a branch is one node. Walking it, only depths that are
whole turns emit a node of the trie.

All figures of a node are sums over its members or its subtree. A part also
sees the last key before it and the first key behind it, so it knows which of
its nodes stand in other parts as well, counts each node's own figures in the
first part that has it, and hands on sums for such shared nodes alone; they are
added up by the node's id. Everything else is final in its part.

Ids of conversations that end at one node are hashed as a sorted stream, so a
conversation copied any number of times needs no memory. A single conversation
is one row of 20 bytes a turn.

Defined results: null role or text counts as empty; a null turn comes first,
and turns of one number stand in the order of their ids; repeated rows are
turns each; rows without a conversation id take no part; an empty table has no
node, not even a root; other columns are not looked at.
"""

from __future__ import annotations

import math
from bisect import bisect_left

from pyspark.sql import DataFrame, Window, functions as F

from quayside.llm.common import read, saved, text_of
from quayside.session import sent_with_jobs

sent_with_jobs(__name__)

ID = 16  # bytes of a turn's id
HEADS, FAMILY = 6, 100  # a conversation takes up to HEADS - 1 turns of the first one of its hundred
PART_BYTES = 32 << 20  # of keys that one tree holds
ROWS = 1 << 15  # nodes a task hands on at once


class Few:
    """Up to 4 or 16 children, in order of their bytes."""
    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.nodes = room, bytearray(), []

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node):
        """The layout that holds the new child as well: this one, or a larger one."""
        if len(self.nodes) == self.room:
            larger = Few(16) if self.room == 4 else Some()
            for b, n in self.items():
                larger.put(b, n)
            return larger.put(byte, node)
        at = bisect_left(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.nodes.insert(at, node)
        return self

    def items(self):
        return zip(self.bytes, self.nodes)


class Some:
    """Up to 48 children: a place for each byte, and the children as they came."""
    __slots__ = ("places", "nodes")

    def __init__(self):
        self.places, self.nodes = bytearray(256), []

    def get(self, byte: int):
        at = self.places[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node):
        if len(self.nodes) == 48:
            larger = Many()
            for b, n in self.items():
                larger.put(b, n)
            return larger.put(byte, node)
        self.nodes.append(node)
        self.places[byte] = len(self.nodes)
        return self

    def items(self):
        return ((b, self.nodes[at - 1]) for b, at in enumerate(self.places) if at)


class Many:
    """Up to 256 children, each at its byte."""
    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node):
        self.nodes[byte] = node
        return self

    def items(self):
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


class Node:
    __slots__ = ("path", "value", "kids")

    def __init__(self, path: bytes, value=None, kids=None):
        self.path, self.value, self.kids = path, value, kids


def shared_length(a: bytes, b: bytes) -> int:
    """Bytes that both begin with."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class RadixTree:
    """Keys of any length, one of which may begin another, with a value each."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, value) -> None:
        node, at = self.root, 0
        while True:
            n = shared_length(node.path, key[at:at + len(node.path)])
            if n < len(node.path):  # the key leaves the path: it becomes two nodes
                below = Node(node.path[n + 1:], node.value, node.kids)
                node.kids = Few().put(node.path[n], below)
                node.path, node.value = node.path[:n], None
            at += n
            if at == len(key):
                node.value = value
                return
            kid = node.kids.get(key[at]) if node.kids else None
            if kid is None:
                node.kids = (node.kids or Few()).put(key[at], Node(key[at + 1:], value))
                return
            node, at = kid, at + 1


class Neighbour:
    """The last key before a part, or the first one behind it, and the ids of the nodes on its path."""

    def __init__(self, key: bytes | None):
        self.key, self.ids, self.state = key, [], None

    def id(self, depth: int) -> bytes:
        import hashlib

        if self.state is None:
            self.state = hashlib.sha256()
            self.ids.append(self.state.digest()[:ID])
        while len(self.ids) <= depth:
            at = len(self.ids) * ID
            self.state.update(self.key[at - ID:at])
            self.ids.append(self.state.copy().digest()[:ID])
        return self.ids[depth]

    def matched(self, before: int, upto: int, byte: int | None, path: bytes) -> int:
        """Bytes of a node's path that are this key's too; `before` of the `upto` bytes above it are."""
        if self.key is None or before < upto:
            return before
        if byte is not None:
            if len(self.key) <= upto or self.key[upto] != byte:
                return before
            upto += 1
        return upto + shared_length(path, self.key[upto:upto + len(path)])


class Row:
    """A node of the trie as one part sees it."""
    __slots__ = ("id", "parent_id", "conv", "depth", "parent", "n", "children", "leaves", "chars", "once", "ends")

    def values(self):
        return (self.id, self.parent_id, self.conv, self.depth, self.parent, self.n, self.children, self.leaves,
                self.chars - self.once, self.ends)


NODE = ("id binary, parent_id binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string")


class _Sums:
    """What a subtree hands up."""
    __slots__ = ("n", "conv", "sample", "leaves", "chars", "once", "tops", "open")

    def __init__(self):
        self.n, self.conv, self.sample, self.leaves, self.chars, self.once, self.tops, self.open = 0, None, None, 0, 0, 0, 0, []

    def add(self, other: "_Sums") -> None:
        self.n += other.n
        self.conv = other.conv if self.conv is None else min(self.conv, other.conv)
        self.sample = other.sample
        self.leaves += other.leaves
        self.chars += other.chars
        self.once += other.once
        self.tops += other.tops
        self.open = self.open + other.open if len(self.open) < len(other.open) else _extended(self.open, other.open)


def _extended(a: list, b: list) -> list:
    a.extend(b)
    return a


def walk(tree: RadixTree, before: Neighbour, behind: Neighbour):
    """Rows of the trie's nodes, each once its parent is known. Values: (members, smallest id, code points a turn, digest of ids)."""
    if tree.root.value is None and tree.root.kids is None:
        return
    none = lambda of: 0 if of.key is not None else -1
    # node, bytes above it (-1: the root, whose own depth is whole as well), byte that leads to it, shared with the neighbours
    start = (tree.root, -1, before.matched(none(before), 0, None, tree.root.path), behind.matched(none(behind), 0, None, tree.root.path))
    stack, results = [(start, False)], []
    while stack:
        (node, above, with_before, with_behind), done = stack.pop()
        end = max(above, 0) + len(node.path) + (above >= 0)
        kids = list(node.kids.items()) if node.kids else []
        if not done:
            stack.append(((node, above, with_before, with_behind), True))
            for byte, kid in kids:
                stack.append(((kid, end, before.matched(with_before, end, byte, kid.path),
                               behind.matched(with_behind, end, byte, kid.path)), False))
            continue
        sums = _Sums()
        for _ in kids:
            sums.add(results.pop())
        ends = None
        if node.value is not None:
            n, conv, sample, ends = node.value
            sums.n += n
            sums.conv = conv if sums.conv is None else min(sums.conv, conv)
            sums.sample = sample
            if not kids and not (with_behind == end and len(behind.key) > end):
                sums.leaves = 1
        for depth in range(end // ID, (above // ID if above >= 0 else -1), -1):
            size = sums.sample[depth - 1] if depth else 0
            elsewhere, later = depth * ID <= with_before, depth * ID <= with_behind
            sums.chars += sums.n * size
            sums.once += 0 if elsewhere else size
            row = Row()
            row.id = before.id(depth) if elsewhere else behind.id(depth) if later else None
            row.parent_id = row.parent = None
            row.conv, row.depth, row.n, row.children, row.leaves = sums.conv, depth, sums.n, sums.tops, sums.leaves
            row.chars, row.once, row.ends, ends = sums.chars, sums.once, ends, None
            for below in sums.open:
                if row.id is None:
                    below.parent = row.conv
                else:
                    below.parent_id = row.id
                yield below
            sums.tops, sums.open = 0 if elsewhere else 1, [row]
        results.append(sums)
    yield from results[0].open


def rebuilt(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, key and chars (code points a turn) of each conversation behind the head of its hundred's first one."""
    role_, text_ = text_of(role), text_of(text)
    id = F.substring(F.sha2(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_).cast("binary"), 256), 1, 2 * ID)
    c = F.col(conv).cast("long")
    turns = conversations.filter(c.isNotNull()).select(
        c.alias("conv_id"), (c - c % FAMILY).alias("family"),
        F.struct(F.col(turn).isNotNull().alias("numbered"), F.col(turn).alias("turn"), id.alias("id"), F.char_length(text_).alias("chars")).alias("t"))
    # one shuffle by family serves the grouping and the heads
    own = turns.repartition("family").groupBy("family", "conv_id").agg(F.transform(
        F.sort_array(F.collect_list("t")), lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("own"))
    first = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("own", 1, HEADS - 1))).over(Window.partitionBy("family"))
    heads = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    whole = own.withColumn("head", F.coalesce(first, F.slice("own", 1, 0))).withColumn("h", heads).select(
        "conv_id", F.concat(F.slice("head", F.lit(1), F.col("h")), F.slice("own", F.col("h") + 1, F.size("own"))).alias("turns"))
    return whole.select("conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("key"),
                        F.transform("turns", lambda t: t["chars"]).alias("chars"))


def distinct_keys(whole: DataFrame) -> DataFrame:
    """key, chars, members, conv_id (the smallest) and the digest of all ids, per distinct key."""
    def run(batches):
        import hashlib

        import pyarrow as pa

        key = found = None
        rows = []

        def handed():
            batch = pa.RecordBatch.from_pydict({
                "key": pa.array([r[0] for r in rows], pa.binary()), "chars": pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                "members": pa.array([r[2] for r in rows], pa.int64()), "conv_id": pa.array([r[3] for r in rows], pa.int64()),
                "ends": pa.array([r[4].hexdigest() for r in rows], pa.string())})
            rows.clear()
            return batch

        for batch in batches:
            for k, conv, chars in zip(*(c.to_pylist() for c in batch.columns)):
                if k == key:
                    found[4].update(b",%d" % conv)
                    found[2] += 1
                    continue
                if found:
                    rows.append(found)
                    if len(rows) >= ROWS:
                        yield handed()
                key, found = k, [k, chars, 1, conv, hashlib.sha256(b"%d" % conv)]
        if found:
            rows.append(found)
        yield handed()

    ordered = whole.select("key", "conv_id", "chars").repartition("key").sortWithinPartitions("key", "conv_id")
    return ordered.mapInArrow(run, "key binary, chars array<int>, members long, conv_id long, ends string")


def parts_of(keys: DataFrame, part_bytes: int) -> DataFrame:
    """Parts of the ordered keys, each led by the last key before it (kind 0) and followed by the first behind it (kind 2)."""
    spark = keys.sparkSession
    size = keys.agg(F.sum(F.octet_length("key") + 64)).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(size / part_bytes))
    runs = saved(keys.repartitionByRange(parts, "key").select(F.spark_partition_id().alias("part"), F.lit(1).alias("kind"), "*"), "trie-runs")
    order = Window.orderBy("part")  # a row per part
    ends = runs.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    led = ends.withColumn("before", F.lag("high").over(order)).withColumn("behind", F.lead("low").over(order))
    beside = led.select("part", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("before").alias("key")),
        F.struct(F.lit(2).alias("kind"), F.col("behind").alias("key")))).alias("at")).select("part", "at.*").filter("key is not null")
    return runs.unionByName(beside, allowMissingColumns=True).repartition(parts, "part").sortWithinPartitions("part", "kind", "key")


def nodes_of(parts: DataFrame) -> DataFrame:
    """The nodes as each part sees them: those with an id stand in other parts as well."""
    def run(batches):
        import pyarrow as pa

        kinds = (pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string())
        names = [c.split(" ")[0] for c in NODE.split(", ")]

        def emitted(tree, before, behind):
            rows = []
            for row in walk(tree, Neighbour(before), Neighbour(behind)):
                rows.append(row.values())
                if len(rows) >= ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        now, tree, before, behind = None, RadixTree(), None, None
        for batch in batches:
            for part, kind, key, chars, members, conv, ends in zip(*(c.to_pylist() for c in batch.columns)):
                if part != now:
                    yield from emitted(tree, before, behind)
                    now, tree, before, behind = part, RadixTree(), None, None
                if kind == 0:
                    before = key
                elif kind == 2:
                    behind = key
                else:
                    tree.insert(key, (members, conv, chars, ends))
        yield from emitted(tree, before, behind)

    return parts.select("part", "kind", "key", "chars", "members", "conv_id", "ends").mapInArrow(run, NODE)


def prefix_trie(whole: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The trie's nodes over conversations given as conv_id, key and chars."""
    seen = saved(nodes_of(parts_of(saved(distinct_keys(whole), "trie-keys"), part_bytes)), "trie-nodes")
    summed = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    shared = saved(seen.filter("id is not null").groupBy("id").agg(
        F.max("parent_id").alias("parent_id"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in summed], F.max("ends_sha256").alias("ends_sha256")), "trie-shared")
    parents = shared.select(F.col("id").alias("parent_id"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", *summed, "ends_sha256"]
    own = seen.filter("id is null")
    found = own.filter("parent_id is null").select(columns).unionByName(
        own.filter("parent_id is not null").drop("parent_conv_id").join(parents, "parent_id").select(columns)).unionByName(
        shared.filter("parent_id is not null").join(parents, "parent_id").select(columns)).unionByName(
        shared.filter("parent_id is null").withColumn("parent_conv_id", F.lit(None).cast("long")).select(columns))
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))


def op11_prefix_trie(spark, sf_dir):
    return prefix_trie(rebuilt(read(spark, sf_dir, "conversations")))


QUERIES = {"op11_prefix_trie": op11_prefix_trie}

# a figure of a subtree is summed over all nodes whose smallest member passes through its top
ORACLE = {"op11_prefix_trie": """
WITH turns AS (
    SELECT conv_id, coalesce(text, '') AS text,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
               sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
    FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id),
convs AS (
    SELECT s.conv_id, s.conv_id - s.conv_id % 100 AS family, coalesce(b.n, 0) AS family_turns,
        xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(s.conv_id::varchar, ''), lambda ch: ord(ch)::bigint)),
            lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
                lambda c, i: xor(c >> 1, 3988292384::bigint * (c & 1)))), 4294967295::bigint) % 6 AS h
    FROM sizes s LEFT JOIN sizes b ON b.conv_id = s.conv_id - s.conv_id % 100),
whole AS (
    SELECT c.conv_id, t.place AS depth, t.id, length(t.text) AS chars
    FROM convs c JOIN turns t ON t.conv_id = c.family AND t.place <= c.h
    UNION ALL
    SELECT c.conv_id, least(c.h, c.family_turns) + t.place - c.h, t.id, length(t.text)
    FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.place > c.h),
prefixes AS (
    SELECT conv_id, depth, chars, md5(string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS prefix FROM whole
    UNION ALL SELECT conv_id, 0, 0, md5('') FROM convs),
lengths AS (SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY conv_id),
nodes AS (
    SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars FROM prefixes GROUP BY depth, prefix),
linked AS (
    SELECT n.*, p.prefix AS parent FROM nodes n LEFT JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
children AS (SELECT depth - 1 AS depth, parent AS prefix, count(*) AS n FROM linked WHERE depth > 0 GROUP BY ALL),
subtrees AS (
    SELECT p.depth, p.prefix, sum(CASE WHEN c.n IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((x.n_convs - 1) * x.chars) AS saved_tokens
    FROM nodes x LEFT JOIN children c ON c.depth = x.depth AND c.prefix = x.prefix
    JOIN prefixes p ON p.conv_id = x.conv_id AND p.depth <= x.depth GROUP BY p.depth, p.prefix),
ends AS (
    SELECT p.depth, p.prefix, sha256(string_agg(p.conv_id::varchar, ',' ORDER BY p.conv_id)) AS ends_sha256
    FROM prefixes p JOIN lengths l ON l.conv_id = p.conv_id AND l.depth = p.depth GROUP BY p.depth, p.prefix)
SELECT n.conv_id, n.depth::bigint AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
    s.n_leaves::bigint AS n_leaves, s.saved_tokens::bigint AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM linked n LEFT JOIN nodes u ON u.depth = n.depth - 1 AND u.prefix = n.parent
LEFT JOIN children c ON c.depth = n.depth AND c.prefix = n.prefix
JOIN subtrees s ON s.depth = n.depth AND s.prefix = n.prefix
LEFT JOIN ends e ON e.depth = n.depth AND e.prefix = n.prefix
"""}
