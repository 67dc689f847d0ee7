"""Prefix trie of conversations, built from adaptive radix trees over turn ids (operator 12).

A turn's id is the 16-byte MD5 of its role and text, a conversation's key its ids in order. Keys are
fixed-width, big-endian byte strings, so they sort and share prefixes as the conversations do.

1. *Keys.* Spark gathers each conversation's ids (not its texts) and range-partitions (key, conv_id):
   equal beginnings lie side by side, and a group of equal conversations may span partitions.
2. *Trees.* A task reads its range in chunks of at most ``CHUNK_ROWS`` conversations (``CHUNK_BYTES`` of
   keys) and builds an adaptive radix tree of each: nodes of 4, 16, 48 and 256 children that grow as
   needed, with paths compressed. Only byte depths at the end of a turn emit trie nodes.
3. *Open nodes.* Nodes on the way to a chunk's first or last key may go on in the next chunk; all others
   are complete and are emitted with their totals. Open ones (twice the depth per chunk) are emitted in
   part, with what hangs on them, and are merged by Spark under the MD5 of their prefix. The totals of
   their subtrees follow by pointer doubling, in as many rounds as the depth has bits.
4. *Ends.* The ids of the conversations that end at an open node come in blocks; their digest is one
   SHA-256 over all of them in order, so it is streamed block by block.

Defined results: turns are ordered by turn (null first), then role, then id; null role and text read
as empty; rows with a null conv_id belong to no conversation and are left out; a repeated row is one
more turn; without conversations there are no nodes; extra columns are ignored. One conversation is one
key: its ids (16 bytes a turn) are held by one task.
"""

from __future__ import annotations

import hashlib
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playmart.sources.tables import read_table

from .common import stored

WIDTH = 16
CHUNK_ROWS, CHUNK_BYTES = 50_000, 16 << 20
#: Bounds of the query's rebuilding: conversations in groups of GROUP share up to HEAD turns.
GROUP, HEAD = 5, 8
PARTS = ("path binary, parent_path binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, size long, ends array<long>, ends_sha256 string")
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


# ---- adaptive radix tree -----------------------------------------------------------------------

class Node:
    """``path`` after the byte that leads here; children in a layout of 0, 4, 16, 48 or 256 places; ``ends``: rows whose key ends here.

    Up to 16 places: ``index`` holds the children's bytes in order. 48: ``index`` has a place number for
    each of 256 bytes (``NONE``: no child). 256: children stand at their byte.
    """

    __slots__ = ("path", "room", "index", "kids", "ends")
    NONE = 255

    def __init__(self, path: bytes):
        self.path, self.room, self.index, self.kids, self.ends = path, 0, b"", None, None

    def child(self, byte: int) -> Node | None:
        if self.room <= 16:
            k = self.index.find(byte)
            return self.kids[k] if k >= 0 else None
        if self.room == 48:
            k = self.index[byte]
            return self.kids[k] if k != self.NONE else None
        return self.kids[byte]

    def grow(self) -> None:
        if self.room == 0:
            self.room, self.index, self.kids = 4, bytearray(), []
        elif self.room == 4:
            self.room = 16
        elif self.room == 16:
            places = bytearray([self.NONE]) * 256
            for k, byte in enumerate(self.index):
                places[byte] = k
            self.room, self.index = 48, places
        else:
            self.room, self.kids, self.index = 256, [self.child(b) for b in range(256)], b""

    def add(self, byte: int, node: Node) -> None:
        if self.room < 256 and len(self.kids or ()) == self.room:
            self.grow()
        if self.room <= 16:
            k = sum(b < byte for b in self.index)
            self.index.insert(k, byte)
            self.kids.insert(k, node)
        elif self.room == 48:
            self.index[byte] = len(self.kids)
            self.kids.append(node)
        else:
            self.kids[byte] = node

    def replace(self, byte: int, node: Node) -> None:
        if self.room <= 16:
            self.kids[self.index.find(byte)] = node
        elif self.room == 48:
            self.kids[self.index[byte]] = node
        else:
            self.kids[byte] = node

    def children(self) -> list:
        return [c for c in self.kids if c is not None] if self.room else []


def shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    n = min(len(a), len(b))
    low = 0
    while low < n:  # halve the range that holds the first difference
        mid = (low + n + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            n = mid - 1
    return low


def insert(root: Node | None, key: bytes, row: int) -> Node:
    """The tree with ``row`` filed under ``key``."""
    if root is None:
        root = Node(key)
        root.ends = [row]
        return root
    node, at, above, byte = root, 0, None, 0
    while True:
        path = node.path
        if key[at:at + len(path)] != path:
            k = shared(path, key[at:at + len(path)])
            top = Node(path[:k])
            node.path = path[k + 1:]
            top.add(path[k], node)
            if above is None:
                root = top
            else:
                above.replace(byte, top)
            node = top
        at += len(node.path)
        if at == len(key):
            if node.ends is None:
                node.ends = []
            node.ends.append(row)
            return root
        below = node.child(key[at])
        if below is None:
            leaf = Node(key[at + 1:])
            leaf.ends = [row]
            node.add(key[at], leaf)
            return root
        above, byte, node, at = node, key[at], below, at + 1


def on_the_way(root: Node, key: bytes) -> set[int]:
    """Identities of the nodes passed on the way to ``key``, which is in the tree."""
    node, at, seen = root, 0, set()
    while True:
        seen.add(id(node))
        at += len(node.path)
        if at == len(key):
            return seen
        node, at = node.child(key[at]), at + 1


# ---- nodes of a chunk --------------------------------------------------------------------------

def _digest(ids) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def prefix_digests(key: bytes) -> list[bytes]:
    """MD5 of the first d turns, for every d."""
    h = hashlib.md5()
    out = [h.digest()]
    for k in range(0, len(key), WIDTH):
        h.update(key[k:k + WIDTH])
        out.append(h.digest())
    return out


def chunk_nodes(keys: list[bytes], ids: list[int], sizes: list) -> list[dict]:
    """Trie nodes of conversations sorted by (key, id); ``sizes``: bytes of each turn's text."""
    root = None
    for row, key in enumerate(keys):
        root = insert(root, key, row)
    first, last = on_the_way(root, keys[0]), on_the_way(root, keys[-1])
    names_first, names_last = prefix_digests(keys[0]), prefix_digests(keys[-1])
    out: list[dict] = []
    done: dict[int, tuple] = {}
    stack = [(root, -1, False)]
    while stack:
        node, above, seen = stack.pop()
        end = above + 1 + len(node.path) if above >= 0 else len(node.path)
        if not seen:
            stack.append((node, above, True))
            stack += [(c, end, False) for c in node.children()]
            continue
        convs, least, some, leaves, saved, tops = 0, None, None, 0, 0, []
        for c in node.children():
            n, low, row, ll, ss, tt = done.pop(id(c))
            convs, leaves, saved, some = convs + n, leaves + ll, saved + ss, row
            least = low if least is None else min(least, low)
            tops += tt
        if node.ends:
            convs += len(node.ends)
            low = min(ids[r] for r in node.ends)
            least, some = low if least is None else min(least, low), node.ends[0]
        opened = names_first if id(node) in first else names_last if id(node) in last else None
        ends = [ids[r] for r in node.ends or ()]
        lowest = max(0, -(-(above + 1) // WIDTH))
        for d in range(end // WIDTH, lowest - 1, -1):
            size = sizes[some][d - 1] if d else 0
            here = {"conv_id": least, "depth": d, "n_convs": convs}
            complete = [t for t in tops if "path" not in t]
            if opened is None:
                for t in complete:
                    t["parent_conv_id"] = least
                leaves = leaves if tops else 1
                saved += (convs - 1) * size
                here |= {"n_children": len(tops), "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": _digest(ends)}
            else:  # what hangs on it is counted here and nowhere further up
                for t in complete:
                    t["parent_path"] = opened[d]
                here |= {"path": opened[d], "parent_path": opened[d - 1] if d else None, "size": size, "ends": ends,
                         "n_children": len(complete), "n_leaves": leaves, "saved_tokens": saved}
                leaves = saved = 0
            out.append(here)
            tops, ends = [here], []
        done[id(node)] = (convs, least, some, leaves, saved, tops)
    return out


def _nodes(chunk_rows: int, batches):
    import pyarrow as pa
    kinds = {"binary": pa.binary(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()), "string": pa.string()}
    columns = [(c, kinds[t]) for c, t in (x.split(" ") for x in PARTS.split(", "))]
    names = [c for c, _ in columns]

    def emit(keys, ids, sizes):
        rows = chunk_nodes(keys, ids, sizes)
        for k in range(0, len(rows), 1 << 16):
            part = rows[k:k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in part], t) for c, t in columns], names)

    keys, ids, sizes, total = [], [], [], 0
    for b in batches:
        for key, c, s in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist(), b.column("sizes").to_pylist()):
            keys.append(key)
            ids.append(c)
            sizes.append(s)
            total += len(key)
            if len(keys) >= chunk_rows or total >= CHUNK_BYTES:
                yield from emit(keys, ids, sizes)
                keys, ids, sizes, total = [], [], [], 0
    if keys:
        yield from emit(keys, ids, sizes)


def _streamed(batches):
    """(path, digest of all ids) from blocks sorted by (path, first id)."""
    import pyarrow as pa
    path, h = None, None
    for b in batches:
        done = []
        for p, ids in zip(b.column("path").to_pylist(), b.column("ends").to_pylist()):
            if p != path:
                if path is not None:
                    done.append((path, h.hexdigest()))
                path, h = p, hashlib.sha256()
            else:
                h.update(b",")
            h.update(",".join(map(str, ids)).encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done])],
                                             ["path", "ends_sha256"])
    if path is not None:
        yield pa.RecordBatch.from_arrays([pa.array([path], pa.binary()), pa.array([h.hexdigest()])], ["path", "ends_sha256"])


# ---- Spark -------------------------------------------------------------------------------------

def turn_lists(turns: DataFrame, group: Column | None = None) -> DataFrame:
    """conv_id and ``turns``, its array of (id, size) in order; with ``group``, dealt by it as column ``base``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    ident = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    c = F.col("conv_id").cast("long")
    rows = turns.where(c.isNotNull()).select(c.alias("conv_id"), F.struct("turn", role.alias("role"), ident.alias("id"),
                                                                          F.octet_length(text).alias("size")).alias("t"))
    keys = ["conv_id"]
    if group is not None:
        rows = rows.withColumn("base", group).repartition("base")
        keys = ["base", "conv_id"]  # the exchange by base serves the aggregation and any window over base
    found = rows.groupBy(*keys).agg(F.sort_array(F.collect_list("t")).alias("t"))
    return found.select(*keys, F.transform("t", lambda x: F.struct(x["id"].alias("id"), x["size"].alias("size"))).alias("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, turns: the first h turns of conversation c - c % GROUP, then c's own after its first h (h = crc32(c) % 9)."""
    from pyspark.sql import Window
    c = F.col("conv_id").cast("long")
    lists = turn_lists(turns, c - c % GROUP)
    head = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("turns", 1, HEAD))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string")) % (HEAD + 1)).cast("int")
    lists = lists.withColumn("head", head).withColumn("h", h)
    first = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), F.col("h")))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return lists.select("conv_id", F.concat(first, own).alias("turns"))


def prefix_trie(lists: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per trie node (columns ``NODE``) of conversations with their turns (conv_id, turns)."""
    rows = stored(lists.select("conv_id", F.unhex(F.array_join("turns.id", "")).alias("key"), F.col("turns.size").alias("sizes")),
                  "trie-keys")
    parts = stored(rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(partial(_nodes, chunk_rows), PARTS),
                   "trie-parts")
    opened = parts.where("path is not null")
    digests = (opened.where("size(ends) > 0").select("path", "ends").withColumn("at", F.get("ends", F.lit(0)))
               .repartition("path").sortWithinPartitions("path", "at").select("path", "ends")
               .mapInArrow(_streamed, "path binary, ends_sha256 string"))
    merged = stored(
        opened.groupBy("path").agg(
            F.min("parent_path").alias("parent_path"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"),
            F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"), F.min("size").alias("size"))
        .join(digests, "path", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_digest(())))), "trie-open")
    below = merged.groupBy(F.col("parent_path").alias("path")).agg(F.count("*").alias("more"))
    merged = merged.join(below, "path", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    sums = stored(merged.select(
        "path", F.col("parent_path").alias("up"), "depth",
        (F.col("n_leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens")), "trie-sums")
    deepest, step = sums.agg(F.max("depth")).first()[0] or 0, 1
    while step <= deepest:  # ``up`` leads ``step`` turns up; the sums cover the nodes less than ``step`` below
        gain = sums.where("up is not null").groupBy(F.col("up").alias("path")).agg(
            F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
        leap = sums.select(F.col("path").alias("up"), F.col("up").alias("_up"))
        sums = stored(sums.join(gain, "path", "left").join(leap, "up", "left").select(
            "path", F.col("_up").alias("up"), "depth", (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("_saved", F.lit(0))).alias("saved_tokens")), "trie-sums")
        step *= 2
    skeleton = merged.drop("n_leaves", "saved_tokens", "parent_conv_id").join(sums.select("path", "n_leaves", "saved_tokens"), "path")
    known = parts.where("path is null")
    every = known.select(*NODE, "parent_path").unionByName(
        skeleton.select(*(F.lit(None).cast("long").alias(c) if c == "parent_conv_id" else F.col(c) for c in NODE), "parent_path"))
    parents = merged.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("_parent"))
    return (every.join(parents, "parent_path", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent"))
            .select(*NODE))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie(rebuilt(turns))


#: CRC-32 bit by bit (polynomial 0xEDB88320); a node is an array of turn ids.
ORACLE = """
WITH ids AS (SELECT DISTINCT CAST(conv_id AS BIGINT) AS c FROM conversations WHERE conv_id IS NOT NULL),
crc AS (SELECT c, xor(4294967295, list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda d: CAST(ord(d) AS BIGINT))),
    lambda acc, b: list_reduce(list_concat([xor(acc, b)], [CAST(0 AS BIGINT) FOR k IN range(8)]),
        lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))) % 9 AS h FROM ids),
own AS (SELECT CAST(conv_id AS BIGINT) AS c, list({'id': md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')),
        'n': strlen(coalesce(text, ''))} ORDER BY turn NULLS FIRST, coalesce(role, ''),
        md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS t
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
made AS (SELECT o.c, list_concat(coalesce(b.t, [])[1:CAST(h AS INT)], o.t[CAST(h AS INT) + 1:]) AS t
    FROM own o JOIN crc USING (c) LEFT JOIN own b ON b.c = o.c - o.c % 5),
prefixes AS (SELECT c, len(t) AS n, d, array_to_string([x.id FOR x IN t[1:d]], '') AS path,
        CASE WHEN d > 0 THEN array_to_string([x.id FOR x IN t[1:d - 1]], '') END AS up, CASE WHEN d > 0 THEN t[d].n ELSE 0 END AS size
    FROM made, LATERAL (SELECT unnest(range(CAST(len(t) + 1 AS BIGINT))) AS d)),
nodes AS (SELECT path, any_value(up) AS up, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
    FROM prefixes GROUP BY path),
kids AS (SELECT up AS path, count(*) AS n FROM nodes WHERE up IS NOT NULL GROUP BY up),
below AS (SELECT v.path, sum(u.saved) AS saved, count(*) FILTER (WHERE k.n IS NULL) AS leaves
    FROM nodes u LEFT JOIN kids k ON k.path = u.path, LATERAL (SELECT unnest(range(u.depth + 1)) AS d) x
    JOIN nodes v ON v.path = u.path[1:32 * x.d] GROUP BY v.path)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, CAST(coalesce(k.n, 0) AS BIGINT) AS n_children,
    CAST(b.leaves AS BIGINT) AS n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens, v.ends_sha256
FROM nodes v LEFT JOIN nodes p ON p.path = v.up LEFT JOIN kids k ON k.path = v.path JOIN below b ON b.path = v.path
"""
