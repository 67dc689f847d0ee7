"""N-gram Jaccard join with a prefix tree (operator 8).

A document's set holds the names of its distinct 4-word shingles (ASCII lower case). Two sets link
when 100 * |intersection| >= 85 * |union|; documents with equal sets are one node.

1. *Global order.* The tasks report shingles that are frequent in a slice of rows; the ``FREQUENT``
   most frequent ones (a fixed number, shipped to all tasks) come last, the others before them in
   order of their names. Any total order gives right results; this one keeps phrases that a third
   of the corpus shares out of the prefixes.
2. *Prefixes.* Linked sets of size m share a shingle within their first m - ceil(0.85 m) + 1.
   Postings (shingle, set) are grouped by shingle; shingles of one set only drop out.
3. *Candidates.* Postings of a shingle are compared in blocks of ``BLOCK`` (a hot shingle is spread
   over pairs of blocks): sizes and a parity bitmap of the sets bound the overlap from above. A
   block reports which of its sets hang together, at most one edge a set, never all its pairs.
   The components of these edges are buckets; linked sets share a bucket.
4. *Prefix tree.* The whole sets of a bucket meet (large buckets again in pairs of blocks), are put
   in one order, most shared shingle first, and stored in a trie. Each set walks the trie with the
   overlap so far, which all sets below a node share, and leaves a subtree when what remains of
   the set and below the node cannot reach the overlap needed. Exact overlaps decide; a set that is
   already in the component is passed over, so the links found form a spanning forest.
5. *Components* of the links give the result, by star steps in Spark.

Defined results: a text with fewer than 4 words has its whole sequence as the only shingle; without
words or text the set is empty, linked with nothing, and component_id is the doc_id itself; null
doc_ids never become a component_id unless nothing else is in the component; rows that repeat a
doc_id are nodes of their own; equal sizes and equal overlaps need no tie-break.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import M1, bound_batches, documents, mix64, slices, stored, string_buffers
from .components import components
from .recompression import word_names
from .repeats import KEY, NULL_ID, Chain, document_key, keyed

NGRAM, SHARE = 4, 85
STAGE_NGRAM, STAGE_SHARE = 5, 80
MEMO_BYTES = 32 << 20
FREQUENT = 1 << 16
BLOCK = 256
BUCKET_SHINGLES = 400_000
BITS_LEAST, BITS_MOST = 256, 8192
FILTER_BITS = 1 << 23
SLICE_BYTES = 1 << 20
WORD_BASE = 0xA0761D6478BD642F
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def least_overlap(m, n, share: int = SHARE):
    """Smallest intersection of linked sets of sizes m and n."""
    return -(-share * (m + n) // (100 + share))


def prefix_length(m: int, share: int = SHARE) -> int:
    return m - -(-share * m // 100) + 1


def shingle_sets(texts, ngram: int = NGRAM) -> list[np.ndarray]:
    """Sorted distinct shingle names of each text of an Arrow array."""
    data, off = string_buffers(texts)
    name, first = word_names(_LOWER[data], off)
    chain = Chain(mix64(name + M1), WORD_BASE)
    out = []
    grams = chain.name(np.arange(max(0, len(name) - ngram + 1)), np.arange(ngram, max(ngram, len(name) + 1)))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= ngram:
            out.append(np.unique(grams[a:b - ngram + 1]))
        else:
            out.append(chain.name(np.array([a]), np.array([b])) if b > a else np.zeros(0, np.uint64))
    return out


def set_id(s: np.ndarray) -> int:
    """Name of a whole set (its size takes part)."""
    return int(mix64(mix64(s).sum(dtype=np.uint64, keepdims=True) + np.array([len(s)], dtype=np.uint64) * M1)[0].view(np.int64))


def parity_bits(s: np.ndarray) -> bytes:
    """Bitmap whose bit k is the parity of the members that hash to k; longer for larger sets."""
    n = min(BITS_MOST, max(BITS_LEAST, 1 << (len(s) - 1).bit_length()))
    odd = np.bincount((s & np.uint64(n - 1)).astype(np.int64), minlength=n).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").tobytes()


SETS = "did long, th long, sid long, m int, bits binary, gram long, n long"


def _sets(ngram: int, batches):
    """One row per text (did, th, sid, m, bits), and (gram, n) rows of shingles frequent in a slice."""
    import pyarrow as pa
    for b in batches:
        for sl in slices(b, SLICE_BYTES):
            sets = shingle_sets(sl.column("text"), ngram)
            rows, none = len(sets), [None]
            grams, n = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]), return_counts=True)
            often = n >= max(3, rows // 100)
            k = int(often.sum())
            has = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([sl.column("did"), pa.nulls(k, pa.int64())]), pa.concat_arrays([sl.column("th"), pa.nulls(k, pa.int64())]),
                 pa.array([set_id(s) if h else None for s, h in zip(sets, has)] + none * k, pa.int64()),
                 pa.array([len(s) for s in sets] + none * k, pa.int32()),
                 pa.array([parity_bits(s) if h else None for s, h in zip(sets, has)] + none * k, pa.binary()),
                 pa.array(none * rows + grams[often].view(np.int64).tolist(), pa.int64()),
                 pa.array(none * rows + n[often].tolist(), pa.int64())],
                ["did", "th", "sid", "m", "bits", "gram", "n"])


def _postings(frequent: np.ndarray, ngram: int, share: int, batches):
    """(gram, sid, m) of every set's prefix in the global order; ``frequent``: rarest first."""
    import pyarrow as pa
    sorted_at = np.argsort(frequent)
    names = frequent[sorted_at]
    for b in batches:
        for sl in slices(b, SLICE_BYTES):
            gram, sid, size = [], [], []
            for s in shingle_sets(sl.column("text"), ngram):
                if not len(s):
                    continue
                if len(names):
                    at = np.searchsorted(names, s).clip(max=len(names) - 1)
                    often = names[at] == s
                    if often.any():
                        late = s[often][np.argsort(sorted_at[at[often]], kind="stable")]
                        s_ordered = np.concatenate([s[~often], late])
                    else:
                        s_ordered = s
                else:
                    s_ordered = s
                p = s_ordered[:prefix_length(len(s), share)]
                gram.append(p)
                sid.append(np.full(len(p), set_id(s), dtype=np.int64))
                size.append(np.full(len(p), len(s), dtype=np.int32))
            if gram:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(gram).view(np.int64)), pa.array(np.concatenate(sid)),
                                                  pa.array(np.concatenate(size))], ["gram", "sid", "m"])


def spread_blocks(rows: DataFrame, node: str, parts: str) -> DataFrame:
    """Copy each row to the pairs (i, j), i <= j, of blocks that hold it; ``own``: its block."""
    own = F.pmod(F.xxhash64(node, F.lit("block")), F.col(parts)).cast("int")
    return (rows.withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(parts).cast("int") - 1)))
            .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other"))


def _groups(batches, key: list[str]):
    """Arrow tables of one whole group each, from batches sorted by ``key``."""
    import pyarrow as pa
    held: list = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy() for k in key]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        edges = [0, *change.tolist(), b.num_rows]
        for x, y in zip(edges[:-1], edges[1:]):
            here = tuple(c[x] for c in cols)
            if held and here != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(x, y - x))
            last = here
    if held:
        yield pa.Table.from_batches(held)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least index of each node's component for edges a - b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        left = root[a] != root[b]
        a, b = a[left], b[left]
    return root


def _bits_bound(bits: list[bytes], size: np.ndarray, a: np.ndarray, b: np.ndarray, share: int = SHARE) -> np.ndarray:
    """Which pairs can link by their parity bitmaps: |A ^ B| is at least the number of differing bits."""
    width = np.array([len(x) for x in bits])
    ok = np.zeros(len(a), dtype=bool)
    folded: dict[int, np.ndarray] = {}
    for w in np.unique(np.minimum(width[a], width[b])):
        table = np.zeros((len(bits), w), dtype=np.uint8)
        for k, x in enumerate(bits):
            v = np.frombuffer(x, dtype=np.uint8)
            while len(v) > w:
                v = v[:len(v) // 2] ^ v[len(v) // 2:]
            if len(v) == w:
                table[k] = v
        folded[int(w)] = table.view(np.uint64)
    pair_width = np.minimum(width[a], width[b])
    for w, table in folded.items():
        at = np.flatnonzero(pair_width == w)
        for c in range(0, len(at), 1 << 16):
            k = at[c:c + (1 << 16)]
            differ = np.bitwise_count(table[a[k]] ^ table[b[k]]).sum(1, dtype=np.int64)
            total = size[a[k]] + size[b[k]]
            ok[k] = (total - differ) // 2 >= least_overlap(size[a[k]], size[b[k]], share)
    return ok


def _candidates(share: int, batches):
    """Edges (a, b) that hold together the candidate pairs of each (gram, i, j) group."""
    import pyarrow as pa
    done: set = set()
    room = MEMO_BYTES
    for t in _groups(batches, ["gram", "i", "j"]):
        n = t.num_rows
        if n < 2:
            continue
        sid, m, own = t["sid"].to_numpy(), t["m"].to_numpy().astype(np.int64), t["own"].to_numpy()
        members = sid.tobytes()
        if members in done:  # the same sets met at another shingle of this task
            continue
        if room > 0:
            done.add(members)
            room -= len(members) + 100
        order = np.argsort(m, kind="stable")
        sm = m[order]
        upto = np.searchsorted(sm, sm * 100 // share, side="right")  # sizes that can link with a smaller one
        count = upto - np.arange(n) - 1
        left = np.repeat(np.arange(n), count)
        right = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count) + left + 1
        a, b = order[left], order[right]
        if t["i"][0].as_py() != t["j"][0].as_py():
            cross = own[a] != own[b]
            a, b = a[cross], b[cross]
        if len(a):
            ok = _bits_bound(t["bits"].to_pylist(), m, a, b, share)
            root = _roots(n, a[ok], b[ok])
            hung = np.flatnonzero(root != np.arange(n))
            if len(hung):
                yield pa.RecordBatch.from_arrays([pa.array(sid[hung]), pa.array(sid[root[hung]])], ["a", "b"])


class Trie:
    """Sets as sequences in one order; a node's path is shared by all sets below it."""

    __slots__ = ("tail", "children", "sets", "least", "most")

    def __init__(self, tail: np.ndarray):
        self.tail = tail          # shingles between the parent and this node
        self.children: dict[int, Trie] = {}
        self.sets: list[int] = []  # sets that end here
        self.least, self.most = 1 << 60, 0  # sizes of the sets below


def trie_links(sets: list[np.ndarray], own: np.ndarray | None = None, share: int = SHARE) -> list[tuple[int, int]]:
    """Links (query, found) that span the components of the sets; with ``own``, between the two blocks only."""
    n = len(sets)
    size = [len(s) for s in sets]
    names, at, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = df > 1
    rank = np.empty(len(names), dtype=np.int64)
    rank[np.lexsort((names, -df))] = np.arange(len(names))
    cuts = np.cumsum([0, *size])
    seqs = []
    for k in range(n):
        ids = at[cuts[k]:cuts[k + 1]]
        seqs.append(np.sort(rank[ids[shared[ids]]]))
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    root = Trie(np.zeros(0, np.int64))
    links: list[tuple[int, int]] = []
    member = np.zeros(len(names) + 1, dtype=bool)

    def insert(k):
        node, seq = root, seqs[k]
        while True:
            node.least, node.most = min(node.least, size[k]), max(node.most, size[k])
            if not len(seq):
                node.sets.append(k)
                return
            child = node.children.get(int(seq[0]))
            if child is None:
                child = node.children[int(seq[0])] = Trie(seq)
                child.least = child.most = size[k]
                child.sets.append(k)
                return
            common = min(len(child.tail), len(seq))
            differ = np.flatnonzero(child.tail[:common] != seq[:common])
            if len(differ):
                common = int(differ[0])
            if common < len(child.tail):  # split the edge
                mid = Trie(child.tail[:common])
                mid.least, mid.most = child.least, child.most
                child.tail = child.tail[common:]
                mid.children[int(child.tail[0])] = child
                node.children[int(seq[0])] = child = mid
            node, seq = child, seq[common:]

    def query(k):
        m, seq = size[k], seqs[k]
        member[seq] = True
        stack = [(c, 0) for c in root.children.values()]
        while stack:
            node, overlap = stack.pop()
            if node.most * 100 < share * m or node.least * share > 100 * m:
                continue
            need = -(-share * (m + max(node.least, -(-share * m // 100))) // (100 + share))
            here = overlap + int(member[node.tail].sum())
            left = len(seq) - int(np.searchsorted(seq, node.tail[-1], side="right"))
            if here + left < need:  # what remains of the set cannot make up for it
                continue
            for s in node.sets:
                if find(s) != find(k) and 100 * here >= share * (m + size[s] - here):
                    links.append((k, s))
                    parent[find(s)] = find(k)
            for c in node.children.values():
                stack.append((c, here))
        member[seq] = False

    first = range(n) if own is None else np.flatnonzero(own == own.min()).tolist()
    if own is None:
        for k in sorted(first, key=lambda k: (size[k], k)):
            query(k)
            insert(k)
    else:
        for k in first:
            insert(k)
        for k in np.flatnonzero(own != own.min()).tolist():
            query(k)
    return links


def _links(share: int, batches):
    """Spanning links (a, b) of the sets of each (bucket, i, j) group."""
    import pyarrow as pa
    for t in _groups(batches, ["bucket", "i", "j"]):
        sid, own = t["sid"].to_numpy(), t["own"].to_numpy()
        if len(sid) < 2:
            continue
        cross = t["i"][0].as_py() != t["j"][0].as_py()
        if cross and own.min() == own.max():
            continue
        sets = [np.frombuffer(x, dtype=np.uint64) for x in t["grams"].to_pylist()]
        found = trie_links(sets, own if cross else None, share)
        if found:
            a, b = np.array(found).T
            yield pa.RecordBatch.from_arrays([pa.array(sid[a]), pa.array(sid[b])], ["a", "b"])


def key_bitmap(active: DataFrame) -> np.ndarray:
    """Bitmap over FILTER_BITS hash values of the keys of ``active``: a fixed size, whatever their number."""
    h = _key_hash()
    rows = (active.select(F.shiftright(h, 15).alias("part"), h.bitwiseAND(F.lit(32767)).alias("at"))
            .groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits")).collect())  # FILTER_BITS / 32768 rows of 4 KB
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in rows:
        out[r["part"] * 4096:(r["part"] + 1) * 4096] = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
    return out


def _key_hash():
    return F.xxhash64("did", "th").bitwiseAND(F.lit(FILTER_BITS - 1))


def _whole_sets(bitmap: np.ndarray, ngram: int, batches):
    """(did, th, grams) of the texts whose key may be wanted; the join that follows is exact."""
    import pyarrow as pa
    for b in batches:
        h = b.column("h").to_numpy()
        b = b.filter(pa.array((bitmap[h >> 3] >> (h & 7).astype(np.uint8)) & 1 == 1))
        for sl in slices(b, SLICE_BYTES):
            yield pa.RecordBatch.from_arrays(
                [sl.column("did"), sl.column("th"),
                 pa.array([s.tobytes() for s in shingle_sets(sl.column("text"), ngram)], pa.binary())], ["did", "th", "grams"])


def linked_sets(rows: DataFrame, sets: DataFrame, frequent: np.ndarray, ngram: int = NGRAM, share: int = SHARE) -> DataFrame:
    """(node, root) of the sets that link with another one."""
    postings = stored(rows.mapInArrow(partial(_postings, frequent, ngram, share), "gram long, sid long, m int"), "jaccard-postings")
    shared = (postings.groupBy("gram").agg(F.min("sid").alias("lo"), F.max("sid").alias("hi"))
              .where("lo < hi").select("gram"))
    nodes = sets.groupBy("sid").agg(F.first("m").alias("m"), F.first("bits").alias("bits"),
                                    F.min(F.struct("did", "th")).alias("rep"))
    met = stored(postings.join(shared, "gram").select("gram", "sid").distinct(), "jaccard-met")
    parts = met.groupBy("gram").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
    # most shingles have few sets: only the hot ones are spread, so that the others need no join
    hot = parts.where("parts > 1")
    sized = met.join(hot, "gram", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    blocks = spread_blocks(sized, "sid", "parts").join(nodes.select("sid", "m", "bits"), "sid")
    edges = (blocks.select("gram", "i", "j", "own", "sid", "m", "bits").repartition("gram", "i", "j")
             .sortWithinPartitions("gram", "i", "j", "sid").mapInArrow(partial(_candidates, share), "a long, b long"))
    buckets = stored(components(edges, "jaccard-candidates"), "jaccard-buckets")
    active = buckets.select(F.col("node").alias("sid"), F.col("root").alias("bucket")).join(nodes, "sid")
    load = active.groupBy("bucket").agg(F.ceil(F.sum("m") / BUCKET_SHINGLES).alias("parts"))
    active = stored(active.join(load, "bucket").select("bucket", "parts", "sid", "rep.did", "rep.th"), "jaccard-active")
    # only texts of candidate sets are hashed and shuffled: a fixed-size bitmap filters the scan
    some = rows.withColumn("h", _key_hash()).mapInArrow(partial(_whole_sets, key_bitmap(active), ngram), "did long, th long, grams binary")
    whole = some.join(active, KEY).select("bucket", "parts", "sid", "grams").dropDuplicates(["sid"])
    links = (spread_blocks(whole, "sid", "parts").select("bucket", "i", "j", "own", "sid", "grams")
             .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "sid")
             .mapInArrow(partial(_links, share), "a long, b long"))
    return components(links, "jaccard-links")


def classes(docs: DataFrame, ngram: int = NGRAM, share: int = SHARE, key: dict | None = None) -> DataFrame:
    """did, th, m, and node: one row per document, equal nodes for documents that hang together (null: empty set)."""
    bound_batches(docs.sparkSession)
    rows = keyed(docs, key)
    found = stored(rows.mapInArrow(partial(_sets, ngram), SETS), "jaccard-sets")
    sets = found.where("gram is null").select(*KEY, "sid", "m", "bits")
    top = (found.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n"))
           .orderBy(F.desc("n"), "gram").limit(FREQUENT).collect())  # a fixed number of rows
    frequent = np.array([r["gram"] for r in reversed(top)], dtype=np.int64).view(np.uint64)
    roots = linked_sets(rows, sets.where("m > 0"), frequent, ngram, share)
    return (sets.drop("bits").join(roots.withColumnRenamed("node", "sid"), "sid", "left")
            .select(*KEY, "m", F.coalesce("root", "sid").alias("node")))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable by links."""
    rows = stored(classes(docs), "jaccard-classes")
    least = rows.where("node is not null and did != %d" % NULL_ID).groupBy("node").agg(F.min("did").alias("least"))
    doc_id = F.when(F.col("did") != NULL_ID, F.col("did"))
    return rows.join(least, "node", "left").select(
        doc_id.alias("doc_id"), F.col("m").cast("long").alias("n_shingles"), F.coalesce("least", doc_id).alias("component_id"))


def op8_trie_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir).select("doc_id", "text"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest doc_id (then text hash); columns of ``docs``.

    The stage links texts at ``STAGE_NGRAM`` words and ``STAGE_SHARE`` percent, the query at 4 and 85.
    Documents without words are linked with nothing and stay.
    """
    key = document_key(docs)
    rows = stored(classes(docs.select("doc_id", "text"), STAGE_NGRAM, STAGE_SHARE, key), "jaccard-classes")
    grouped = rows.where("node is not null")
    keep = (grouped.groupBy("node", *KEY).agg(F.count("*").alias("times"))
            .groupBy("node").agg(F.min(F.struct(*KEY, "times")).alias("k")).select("k.did", "k.th", "k.times"))
    empty = rows.where("node is null").select(*KEY).distinct().withColumn("times", F.lit(1).cast("long"))
    keep = keep.unionByName(empty).select(F.col("did").alias("_did"), F.col("th").alias("_th"), F.col("times").alias("_times"))
    tagged = docs.withColumns({f"_{k}": c for k, c in key.items()}).join(keep, ["_did", "_th"])
    own = [F.col(f"`{c}`") for c in docs.columns]
    once = tagged.where("_times = 1").select(own)
    again = tagged.where("_times > 1").dropDuplicates(["_did", "_th"]).select(own)  # the same row several times
    return once.unionByName(again)
