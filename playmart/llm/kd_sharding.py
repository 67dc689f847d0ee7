"""K-d tree sharding by weighted medians (operator 3), DataFrame operations only.

The weight of a document is its byte size. A node of the tree is split along its widest metadata
dimension (range of the node over range of the corpus) at a weighted quantile, so that both sides
get the bytes their leaves are due, until every leaf has its target: the shards.

The medians are distributed: a coordinate (20 bits of the dimension, then 28 bits of the text hash
as tie-break) is found digit by digit. Each round sums weights per (node, 12-bit digit) with
map-side aggregation and picks the digit that crosses the goal, so no task ever sorts a node's rows
and the driver receives one row per node.

Dimensions come from the text alone (bytes, bytes per character, lines), so equal texts have equal
coordinates and always share a shard. A group of equal texts heavier than 1/16 of a shard would
upset a median; there are at most 16 of them per shard, they are laid on the emptiest shards first
and the leaves' targets are what is left. Shard sizes differ by no more than such a group.

Defined results: null text has size 1 and groups with the empty text; null or repeated doc_ids are
rows like any other; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import documents, shuffle_partitions, stored

SHARDS = 8
DIGIT, DIGITS, TIE = 12, 4, 28
HEAVY = 16


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, text hashes and the raw metadata dimensions of each document."""
    t = F.coalesce("text", F.lit(""))
    size = F.octet_length(t).cast("long")
    return docs.select(
        "doc_id", (size + 1).alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"),
        F.xxhash64(t).alias("k1"), F.xxhash64(F.lit("kd"), t).alias("k2"),
        F.log2(size + 1.0).alias("d0"), (size / F.greatest(F.length(t), F.lit(1))).alias("d1"),
        F.log2(F.length(t) - F.length(F.replace(t, F.lit("\n"))) + 1.0).alias("d2"))


def heavy_groups(rows: DataFrame, total: int, shards: int) -> list:
    """Groups of equal texts above 1/HEAVY of a shard: at most shards * HEAVY rows."""
    return (rows.groupBy("k1", "k2").agg(F.sum("size").alias("w"))
            .where(F.col("w") * (shards * HEAVY) > total).orderBy(F.desc("w"), "k1", "k2").collect())


def leaf_targets(total: int, heavy: list, shards: int) -> tuple[list[int], list[float]]:
    """Shard of each heavy group, and the bytes that are left for each shard (a common water level)."""
    load = [0] * shards
    placed = []
    for g in heavy:
        s = min(range(shards), key=lambda i: (load[i], i))
        placed.append(s)
        load[s] += g["w"]
    rest = total - sum(load)
    order = sorted(load)
    level = 0.0
    for n in range(1, shards + 1):
        level = (rest + sum(order[:n])) / n
        if n == shards or level <= order[n]:
            break
    return placed, [max(0.0, level - x) for x in load]


def _bins(rows: DataFrame) -> tuple[list[Column], int]:
    """Dimensions scaled to 20 bits over the corpus, and the total weight."""
    dims = ("d0", "d1", "d2")
    r = rows.agg(F.sum("size").alias("w"), *(f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max)))).first()
    top = float((1 << (DIGIT * DIGITS - TIE)) - 1)
    cols = []
    for d in dims:
        lo, hi = r[f"lo_{d}"], r[f"hi_{d}"]
        cols.append(F.floor((F.col(d) - F.lit(lo)) * F.lit(top / (hi - lo))).cast("long")
                    if hi is not None and hi > lo else F.lit(0).cast("long"))
    return cols, r["w"] or 0


def by_node(values: dict) -> Column:
    """The value of the row's node (one entry a node)."""
    if not values:
        return F.lit(None)
    return F.element_at(F.create_map(*(F.lit(x) for kv in values.items() for x in kv)), F.col("node"))


def split_level(rows: DataFrame, nodes: dict[int, tuple[int, int]], targets: list[float]) -> DataFrame:
    """One level of the tree: ``node`` -> 2*node or 2*node+1 for the nodes of two or more leaves."""
    wide = {r["node"]: r for r in rows.groupBy("node").agg(
        F.sum("size").alias("w"), *((F.max(f"b{i}") - F.min(f"b{i}")).alias(f"w{i}") for i in range(3))).collect()}
    state = {}
    for n, (lo, hi) in nodes.items():
        if hi - lo > 1 and n in wide:
            mid = (lo + hi + 1) // 2
            due, left = sum(targets[lo:hi]), sum(targets[lo:mid])
            dim = max(range(3), key=lambda i: (wide[n][f"w{i}"], -i))
            state[n] = {"dim": dim, "goal": wide[n]["w"] * (left / due if due else 0.5), "prefix": 0, "below": 0.0}
    coord = F.col("b0")
    dim = by_node({n: s["dim"] for n, s in state.items()})
    for i in (1, 2):
        coord = F.when(dim == i, F.col(f"b{i}")).otherwise(coord)
    coord = F.shiftleft(coord, TIE) + F.shiftrightunsigned("k1", 64 - TIE)
    if state:
        keyed = rows.where(F.col("node").isin(list(state))).select("node", "size", coord.alias("coord"))
        for digit in range(DIGITS):
            shift = DIGIT * (DIGITS - digit - 1)
            prefix = by_node({n: s["prefix"] for n, s in state.items()})
            sums = (keyed.where(F.shiftright("coord", shift + DIGIT) == prefix)
                    .groupBy("node", F.shiftright("coord", shift).alias("at")).agg(F.sum("size").alias("w")))
            w = Window.partitionBy("node").orderBy("at")  # at most 2**DIGIT rows a node
            need = by_node({n: float(s["goal"] - s["below"]) for n, s in state.items()})
            found = (sums.withColumn("upto", F.sum("w").over(w)).withColumn("last", F.lead("at").over(w).isNull())
                     .where((F.col("upto") >= need) | F.col("last"))
                     .groupBy("node").agg(F.min(F.struct("at", "upto", "w")).alias("x")).collect())
            for r in found:
                s = state[r["node"]]
                s["prefix"], s["below"], s["w"] = r["x"]["at"], s["below"] + r["x"]["upto"] - r["x"]["w"], r["x"]["w"]
        for s in state.values():  # the nearer side of the crossing coordinate
            s["cut"] = s["prefix"] if s["below"] + s["w"] - s["goal"] <= s["goal"] - s["below"] else s["prefix"] - 1
    cut = by_node({n: state[n]["cut"] if n in state else 1 << 62 for n in nodes})
    return rows.withColumn("node", 2 * F.col("node") + (coord > cut).cast("int"))


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, k1, k2 and the shard (0 to shards - 1) of each document."""
    spark = docs.sparkSession
    rows = stored(measured(docs), "kd-rows")
    bins, total = _bins(rows)
    heavy = heavy_groups(rows, total, shards) if total else []
    placed, targets = leaf_targets(total, heavy, shards)
    rows = rows.select("doc_id", "size", "text_crc32", "k1", "k2", *(c.alias(f"b{i}") for i, c in enumerate(bins)))
    if heavy:  # at most shards * HEAVY rows
        values = ", ".join(f"({g['k1']}L, {g['k2']}L, {s})" for g, s in zip(heavy, placed)).replace(f"{-(1 << 63)}L", "-9223372036854775807L - 1L")
        fixed = spark.sql(f"SELECT * FROM VALUES {values} AS t(k1, k2, fixed)")
        rows = rows.join(F.broadcast(fixed), ["k1", "k2"], "left")
    else:
        rows = rows.withColumn("fixed", F.lit(None).cast("int"))
    tree = rows.where("fixed is null").withColumn("node", F.lit(0))
    nodes = {0: (0, shards)}
    while any(hi - lo > 1 for lo, hi in nodes.values()):
        tree = split_level(tree, nodes, targets)
        nodes = {c: r for n, (lo, hi) in nodes.items()
                 for c, r in ((2 * n, (lo, (lo + hi + 1) // 2)), (2 * n + 1, ((lo + hi + 1) // 2, hi))) if r[0] < r[1]}
    tree = tree.withColumn("shard", by_node({n: lo for n, (lo, _) in nodes.items()}))
    out = ["doc_id", "size", "text_crc32", "k1", "k2", "shard"]
    return tree.select(out).unionByName(rows.where("fixed is not null").withColumn("shard", F.col("fixed")).select(out))


def numbered(rows: DataFrame) -> DataFrame:
    """Add ``slot``, gapless from 0 in each shard: row numbers in hash buckets plus bucket offsets."""
    buckets = max(64, 2 * shuffle_partitions(rows.sparkSession))
    rows = stored(rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "k1"), F.lit(buckets)).cast("int")), "kd-shards")
    counts = rows.groupBy("shard", "bucket").count()
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = F.broadcast(counts.select("shard", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset")))
    w = Window.partitionBy("shard", "bucket").orderBy("doc_id", "k1", "k2")
    return (rows.withColumn("n", F.row_number().over(w)).join(offsets, ["shard", "bucket"])
            .withColumn("slot", F.col("offset") + F.col("n") - 1).drop("n", "offset", "bucket"))


def op3_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(shard(documents(spark, sf_dir))).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
