"""Settling which windows of fixed length repeat, level by level (shared by operators 5 and 9).

A *claim* is a run of ``n`` neighbouring windows of one document, starting at ``s``, with two names:
``g`` is a function of what every window of the run contains (equal windows always carry the same
g), ``u`` names the whole stretch the run covers. So at every level

* claims whose g is unique are done: none of their windows occurs elsewhere;
* claims that share (g, u) with another are done: all their windows do;
* the others are open and are cut into shorter claims at the next level, together with one
  representative of each stretch they could match.

The last level's claims are single windows. All decisions are aggregations and equi-joins on (g) or
(g, u): groups are pre-aggregated in the map tasks, no group is ever gathered, and a hot name costs
one partial row per task plus a join that adaptive execution can split.

Rules: ``any`` marks windows that occur anywhere else; ``earlier`` marks windows that also occur in
a document with a smaller key. A document row is identified by ``did`` (doc_id, null reads as the
smallest long) and ``th`` (a 64-bit hash of its text): rows that repeat a doc_id are told apart by
their text, and rows equal in both get the same marks. ``document_key`` makes sure of it: it looks for
two texts that share a key and salts the hash until there are none (and needs no hash where no doc_id repeats).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import stored

NULL_ID = -(1 << 63)
CLAIM = "did long, th long, g long, u long, s int, n int, o int, want boolean"
KEY = ["did", "th"]


#: Bits of the text hash in a key (fewer only in tests).
KEY_BITS = 64


def key_columns(salt: int = 0) -> dict:
    """did and th of a document row (columns doc_id, text)."""
    text = F.coalesce("text", F.lit(""))
    return {"did": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)),
            "th": F.shiftrightunsigned(F.xxhash64(text, F.lit(salt)), 64 - KEY_BITS)}


def document_key(docs: DataFrame) -> dict:
    """``key_columns`` under which no two different texts of ``docs`` share a key; where no doc_id repeats, ``th`` is 0
    in every row, as ``did`` alone tells them apart.

    Texts are told apart by their size and a second 64-bit hash with a seed of its own, so only
    texts that agree in all three could pass for one.
    """
    did = key_columns()["did"]
    if docs.groupBy(did.alias("did")).count().where("count > 1").isEmpty():
        return {"did": did, "th": F.lit(0).cast("long")}
    text = F.coalesce("text", F.lit(""))
    salt = 0
    while True:
        key = key_columns(salt)
        rows = docs.select(*(c.alias(k) for k, c in key.items()),
                           F.struct(F.octet_length(text), F.xxhash64(F.lit("another seed"), text)).alias("v"))
        clash = rows.groupBy(*KEY).agg(F.min("v").alias("a"), F.max("v").alias("b")).where("a != b")
        if clash.isEmpty():
            return key
        salt += 1


def keyed(docs: DataFrame, key: dict | None = None) -> DataFrame:
    """did, th and the text (null reads as empty); ``key``: what ``document_key`` gave for these rows."""
    k = key or document_key(docs)
    return docs.select(k["did"].alias("did"), k["th"].alias("th"), F.coalesce("text", F.lit("")).alias("text"))


def settle(claims: DataFrame, rule: str, name: str, last: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(marks did, th, s, n; open claims of the next level or None at the last)."""
    groups = claims.groupBy("g").agg(F.count("*").alias("gc"), F.min("did").alias("gmin"), F.max("did").alias("gmax"))
    # a table of its own: its shuffle is gone before the join's, and both join sides can be split if skewed
    shared = stored(groups.where("gc > 1" if rule == "any" else "gmin < gmax").select("g", "gmin"), f"{name}-shared")
    kept = stored(claims.join(shared, "g"), f"{name}-kept")
    rep = F.xxhash64("did", "th", "s")
    var = kept.groupBy("g", "u").agg(F.count("*").alias("vc"), F.min("did").alias("vmin"), F.min("gmin").alias("gmin"),
                                     F.min(rep).alias("rep"), F.max("want").alias("wanted"))
    alone = (F.col("vc") == 1) if rule == "any" else (F.col("vmin") > F.col("gmin"))
    whole = (F.col("vc") > 1) if rule == "any" else (F.col("did") > F.col("vmin"))
    if last:
        marks = kept.where("want").join(var.drop("gmin"), ["g", "u"]).where(whole)
        return stored(marks.select(*KEY, "s", "n"), f"{name}-marks"), None
    var = stored(var.withColumn("alone", alone & F.col("wanted")).drop("wanted", "gmin"), f"{name}-variants")
    undecided = (var.groupBy("g").agg(F.max("alone").alias("undecided"), F.count("*").alias("variants"))
                 .where("undecided and variants > 1").select("g", "undecided"))
    if rule == "any":
        stays = (F.col("vc") == 1) | (rep == F.col("rep"))
        want = F.col("want") & (F.col("vc") == 1)
    else:
        stays = F.col("did") == F.col("vmin")
        want = F.col("want") & (F.col("vmin") > F.col("gmin"))
    done = stored(kept.join(var.join(undecided, "g", "left"), ["g", "u"])
                  .select(*KEY, "g", "s", "n", "o", (F.col("want") & whole).alias("mark"), want.alias("want"),
                          (F.coalesce("undecided", F.lit(False)) & stays).alias("open"))
                  .where("mark or open"), f"{name}-done")
    return done.where("mark").select(*KEY, "s", "n"), done.where("open").select(*KEY, "g", "s", "n", "o", "want")


def expand(docs: DataFrame, open_claims: DataFrame, cut: Callable, name: str) -> DataFrame:
    """Claims of the next level: ``cut(batch)`` sees texts with their open claims as list<struct>."""
    lists = open_claims.groupBy(*KEY).agg(F.collect_list(F.struct("s", "n", "o", "g", "want")).alias("claims"))

    def run(batches):
        for b in batches:
            yield from cut(b)
    return stored(docs.join(lists, KEY).mapInArrow(run, CLAIM), name)


def marked(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """Every document with its marks as an array (null: none)."""
    lists = marks.groupBy(*KEY).agg(F.collect_list(F.struct("s", "n")).alias("marks"))
    return docs.join(lists, KEY, "left")


# ---- inside tasks ------------------------------------------------------------------------------

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i below n (base odd), kept per worker."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = -(-n // (1 << 16)) << 16  # no more than the longest slice needs
        inv = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inv):
            x = np.full(size, b, dtype=np.uint64)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        _powers[base] = have = tuple(out)
    return have


class Chain:
    """Names of stretches of a sequence of 64-bit symbols: a polynomial modulo 2**64, scrambled."""

    def __init__(self, symbols: np.ndarray, base: int):
        p, self.inv = powers(base, len(symbols) + 1)
        self.sums = np.zeros(len(symbols) + 1, dtype=np.uint64)
        np.cumsum(symbols * p[:len(symbols)], out=self.sums[1:])

    def name(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        from .common import mix64
        return mix64((self.sums[stop] - self.sums[start]) * self.inv[start] + (stop - start).astype(np.uint64))


def byte_symbols(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def spread(s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and position of every element of the runs [s, s + n)."""
    row = np.repeat(np.arange(len(s)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(s, n)


def claim_lists(batch):
    """(did, th) arrays of the texts and, per open claim, text number, s, n, o, g, want."""
    col = batch.column("claims")
    flat = col.flatten()
    off = col.offsets.to_numpy()
    get = lambda k: flat.field(k).to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(col)), np.diff(off))
    return (batch.column("did").to_numpy(), batch.column("th").to_numpy(), doc, get("s").astype(np.int64),
            get("n").astype(np.int64), get("o").astype(np.int64), get("g"), get("want"))


def claim_batch(did, th, g, u, s, n, o, want):
    import pyarrow as pa
    return pa.RecordBatch.from_arrays(
        [pa.array(did), pa.array(th), pa.array(g.view(np.int64)), pa.array(u.view(np.int64)), pa.array(s.astype(np.int32)),
         pa.array(n.astype(np.int32)), pa.array(o.astype(np.int32)), pa.array(np.asarray(want, dtype=bool))],
        ["did", "th", "g", "u", "s", "n", "o", "want"])


def covered(marks: list | None, size: int, width: int) -> np.ndarray:
    """Positions of a sequence covered by the windows of its marks (list of {s, n})."""
    edge = np.zeros(size + 1, dtype=np.int64)
    for m in marks or ():
        edge[m["s"]] += 1
        edge[min(size, m["s"] + m["n"] - 1 + width)] -= 1
    return np.cumsum(edge[:-1]) > 0
