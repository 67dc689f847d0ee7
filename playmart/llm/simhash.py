"""SimHash near-duplicates found by Golay-code fuzzy hashing (operator 13).

Fingerprint: a text's words (A-Z lower-cased) give 3-word shingles, repeats included; a bit of the
fingerprint is 1 if it is set in over half of the shingles' XXH64 values. Two fingerprints link when
at most ``ERRORS`` = 3 of their 64 bits differ.

Golay keys. Each 23-bit word lies within distance 3 of exactly one codeword of the binary Golay code.
A word's keys are the 12-bit indices of all codewords within distance 4: the nearest one and, where
that is at distance 3, five more. Words that differ in at most 2 bits share a key: a word halfway is
at most 1 bit from both, and its codeword at most 4.

Pigeonhole. The fingerprint has four pieces of 16 bits, and 3 errors leave one of them exact. The
other 48 bits are cut into a 23-bit segment and 25 bits: either the segment has at most 2 errors and
shares a Golay key, or it has all three and the 25 bits are exact. So a fingerprint files itself
under (piece, 16 exact bits, Golay index) and (piece, 16 exact bits, 25 exact bits), about 25 keys.

Join. Distinct fingerprints meet under their keys; keys with more than ``BLOCK`` of them are met in
pairs of blocks. Every pair that meets is verified by counting differing bits, and a block reports
the links that hold its members together (at most one a member), never all pairs. Star steps join
the links to components.

Defined results: a text with one or two words has its whole sequence as the only shingle; null text
and a text without words have fingerprint zero, linked like any other; rows with equal fingerprints
are one node; a null doc_id is a component_id only where the component has no other; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import documents, slices, stored
from .components import components
from .jaccard_join import _roots, spread_blocks

NGRAM, SEED, ERRORS = 3, 42, 3
BLOCK = 4096
SLICE_BYTES = 4 << 20
#: Generator polynomial of the (23, 12) Golay code, its length and message bits.
GENERATOR, LENGTH, MESSAGE = 0b110001110101, 23, 12
CHECK = LENGTH - MESSAGE
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


# ---- fingerprints ------------------------------------------------------------------------------

def simhash(text: bytes | None, ngram: int = NGRAM, seed: int = SEED, step: int = 1 << 16) -> int:
    """64-bit fingerprint of a UTF-8 text (0 without words)."""
    from xxhash import xxh64_intdigest
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    total = max(1, len(words) - ngram + 1)
    ones = np.zeros(64, dtype=np.int64)
    for a in range(0, total, step):
        part = words[a:a + step + ngram - 1]
        grams = map(b" ".join, zip(*(part[k:] for k in range(ngram)))) if len(words) >= ngram else [b" ".join(words)]
        h = np.fromiter((xxh64_intdigest(g, seed) for g in grams), dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << int(k) for k in np.flatnonzero(2 * ones > total))


def _fingerprints(batches):
    import pyarrow as pa
    import pyarrow.compute as pc
    for b in batches:
        for sl in slices(b, SLICE_BYTES):
            texts = pc.cast(sl.column("text"), pa.binary()).to_pylist()
            fp = np.array([simhash(t) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([sl.column("doc_id"), pa.array(fp)], ["doc_id", "fp"])


# ---- Golay code --------------------------------------------------------------------------------

def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(remainder of each bit, pattern of weight 3 at most per syndrome, five patterns of weight 4 or none)."""
    bit = []
    for i in range(LENGTH):
        x = 1 << i
        for k in range(LENGTH - 1, CHECK - 1, -1):
            if x >> k & 1:
                x ^= GENERATOR << (k - CHECK)
        bit.append(x)
    near = np.zeros(1 << CHECK, dtype=np.int64)
    far: dict[int, list[int]] = {}
    for weight in range(1, 5):
        for at in itertools.combinations(range(LENGTH), weight):
            pattern = syndrome = 0
            for i in at:
                pattern |= 1 << i
                syndrome ^= bit[i]
            if weight < 4:
                near[syndrome] = pattern
            else:
                far.setdefault(syndrome, []).append(pattern)
    more = np.full((1 << CHECK, 5), -1, dtype=np.int64)
    for syndrome, patterns in far.items():
        if near[syndrome].item().bit_count() == 3:
            more[syndrome] = patterns
    return np.array(bit, dtype=np.int64), near, more


_tables: list = []


def golay_keys(words: np.ndarray) -> np.ndarray:
    """(n, 6) indices of the codewords within distance 4 of each 23-bit word (-1: fewer than six)."""
    if not _tables:
        _tables.extend(golay_tables())
    bit, near, more = _tables
    syndrome = np.zeros(len(words), dtype=np.int64)
    for i in range(LENGTH):
        syndrome ^= np.where(words >> i & 1, bit[i], 0)
    out = np.empty((len(words), 6), dtype=np.int64)
    out[:, 0] = (words ^ near[syndrome]) >> CHECK
    far = more[syndrome]
    out[:, 1:] = np.where(far >= 0, (words[:, None] ^ far) >> CHECK, -1)
    return out


def filing_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) under which fingerprints are filed; fingerprints that link share one."""
    rows, keys = [], []
    n = np.arange(len(fp))
    for piece in range(4):
        exact = (fp >> np.uint64(16 * piece) & np.uint64(0xFFFF)).astype(np.int64)
        low = fp & np.uint64((1 << 16 * piece) - 1)
        rest = (low | (fp >> np.uint64(16 * piece) >> np.uint64(16) << np.uint64(16 * piece))).astype(np.int64)  # 48 bits
        head = (piece << 16 | exact) << 26
        index = golay_keys(rest & ((1 << LENGTH) - 1))
        r, k = np.nonzero(index >= 0)
        rows += [r, n]
        keys += [head[r] | index[r, k], head | 1 << 25 | rest >> LENGTH]
    return np.concatenate(rows), np.concatenate(keys)


# ---- join --------------------------------------------------------------------------------------

def _filed(batches):
    import pyarrow as pa
    for b in batches:
        for k in range(0, b.num_rows, 1 << 14):
            fp = b.column("fp").slice(k, 1 << 14).to_numpy(zero_copy_only=False)
            row, key = filing_keys(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], ["key", "fp"])


def group_links(group: np.ndarray, fp: np.ndarray, own: np.ndarray | None, errors: int = ERRORS):
    """Edges (a, b) that span the links inside each run of equal ``group``; with ``own``, also only between blocks."""
    n = len(fp)
    end = np.searchsorted(group, group, side="right")
    at = np.arange(n)
    root = at.copy()
    found_a, found_b, held = [], [], 0
    live, d = np.flatnonzero(end - at > 1), 1
    while len(live):
        a, b = live, live + d
        ok = np.bitwise_count(fp[a] ^ fp[b]) <= errors
        if own is not None:
            ok &= (own[a] != own[b]) | (own[a] < 0)
        found_a.append(a[ok])
        found_b.append(b[ok])
        held += int(ok.sum())
        d += 1
        live = live[end[live] - live > d]
        if held > 1 << 20 or not len(live):
            a, b = np.concatenate([at, *found_a]), np.concatenate([root, *found_b])
            root = _roots(n, a, b)
            found_a, found_b, held = [], [], 0
    hung = np.flatnonzero(root != at)
    return fp[hung], fp[root[hung]]


def _links(batches):
    """Spanning links of each (key, i, j) group; rows are sorted by it. Only the last group is held back."""
    import pyarrow as pa

    def rows(b):
        return [b.column(c).to_numpy(zero_copy_only=False) for c in ("key", "i", "j", "own", "fp")]

    def spanned(cols):
        key, i, j, own, fp = cols
        change = np.concatenate([[False], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
        own = np.where(i == j, -1, own)  # a block with itself: all pairs count
        a, b = group_links(np.cumsum(change), fp.view(np.uint64), own)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    held = None
    for b in batches:
        if not b.num_rows:
            continue
        cols = rows(b)
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        key, i, j = cols[:3]
        other = np.flatnonzero((key != key[-1]) | (i != i[-1]) | (j != j[-1]))
        cut = int(other[-1]) + 1 if len(other) else 0
        held = [x[cut:] for x in cols]
        if cut:
            yield spanned([x[:cut] for x in cols])
    if held is not None:
        yield spanned(held)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (64 bits as a signed long) of every row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_fingerprints, "doc_id long, fp long")


def linked_fingerprints(nodes: DataFrame, name: str = "simhash") -> DataFrame:
    """(node, root) of the fingerprints (column fp, distinct) that link with another one."""
    filed = stored(nodes.select("fp").mapInArrow(_filed, "key long, fp long"), f"{name}-filed")
    shared = stored(filed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
                    .select("key", F.ceil(F.col("n") / BLOCK).alias("parts")), f"{name}-shared")
    met = spread_blocks(filed.join(shared, "key"), "fp", "parts").select("key", "i", "j", "own", "fp")
    links = (met.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "fp")
             .mapInArrow(_links, "a long, b long"))
    return components(links, name)


def simhash_components(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id for every row of ``docs`` (doc_id, text)."""
    rows = stored(fingerprints(docs), "simhash-rows")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = stored(linked_fingerprints(nodes), "simhash-roots")
    joined = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lead = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stored(joined.select("fp", "root").join(lead, "root").select("fp", "component_id"), "simhash-named")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def op13_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
