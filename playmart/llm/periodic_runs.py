"""Runs of repeated word patterns by enumeration of maximal pairs (operator 11).

A run is a stretch of words with smallest period q, at least ``max(LEAST, TIMES * q)`` words long, that
no neighbouring word extends keeping the period. A run of length L gives the maximal pair (start,
start + q) with common length L - q, and such a pair of distance q and common length m with
q <= m / (TIMES - 1) and q + m >= LEAST is a whole run as it stands: nothing needs extending.

Per slice of texts, inside a task:

1. *Filter.* Only texts in which ``SEED`` consecutive words occur twice can hold a run.
2. *Order.* Their suffixes are sorted by prefix doubling over exact word numbers, all texts of the
   slice at once (a text's number leads its words, so suffixes of two texts never share a prefix).
   The ranks of each round give the common lengths of neighbours.
3. *LCP-interval tree, bottom-up.* Each interval keeps its positions in order with their left words
   (its classes). When a child joins its parent, each position of the smaller side looks for partners
   of another class among those of the larger side no further away than half the common length.
   Occurrences that near each other form one chain of equal steps, all of one class but the first
   and all of one child but the last, so a search reads the two ends of its window only.
4. A period's multiples give pairs with the same stretch; the least distance of a stretch is its period.

Defined results: null text and texts without words have no runs and collapse to the empty string;
rows that repeat a doc_id are judged row by row; null doc_ids are allowed (the query's rebuilding
leaves their texts as they are); extra columns are ignored; an empty table gives an empty result. A
text is handled by one task, in memory that grows with its own size only.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import documents, mix64, pair_name, slices

LEAST, TIMES = 24, 3
SEED = 16  # LEAST * (TIMES - 1) / TIMES: the shortest common length of a run's pair
SLICE_BYTES = 2 << 20
RUNS = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, kept binary"


# ---- sorted suffixes ---------------------------------------------------------------------------

def repeats_in(word: np.ndarray, doc: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Numbers of the texts in which ``seed`` consecutive words may occur twice (none that does is missed)."""
    name = mix64(word.astype(np.uint64) + np.uint64(1))
    h = 1
    while h < seed:
        name = pair_name(name[:-h], name[h:])
        h *= 2
    inside = doc[:len(name)] == doc[seed - 1:]
    name = pair_name(name[inside], doc[:len(inside)][inside].astype(np.uint64))
    owner = doc[:len(inside)][inside]
    order = np.argsort(name)
    same = name[order][1:] == name[order][:-1]
    return np.unique(owner[order][1:][same])


def suffixes(word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in suffix order, common length with the one before), suffixes ending with their text.

    Words are compared by number, texts before words.
    """
    n = len(word)
    _, rank = np.unique(doc * (int(word.max()) + 1) + word, return_inverse=True)
    order = np.argsort(rank, kind="stable")
    head = np.concatenate([[True], rank[order][1:] != rank[order][:-1]])
    at = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.maximum.accumulate(np.where(head, at, 0))
    levels, h = [rank.astype(np.int32) if n < 1 << 31 else rank.copy()], 1
    while True:
        single = head & np.concatenate([head[1:], [True]])
        slot = np.flatnonzero(~single)
        if not len(slot):
            break
        open_ = order[slot]
        ahead = open_ + h
        ok = ahead < n
        ok[ok] = doc[ahead[ok]] == doc[open_[ok]]
        key = rank[open_] * (n + 1)
        key[ok] += rank[ahead[ok]] + 1
        by = np.argsort(key, kind="stable")
        key, open_ = key[by], open_[by]
        order[slot] = open_
        new = np.concatenate([[True], key[1:] != key[:-1]])
        head[slot] = new
        rank[open_] = slot[np.maximum.accumulate(np.where(new, np.arange(len(slot)), 0))]
        h *= 2
        levels.append(rank.astype(levels[0].dtype))
    common = np.zeros(n, dtype=np.int64)
    a, b = order[:-1].copy(), order[1:].copy()
    live = np.arange(n - 1)
    for k in range(len(levels) - 1, -1, -1):  # equal ranks of round k: 2**k words in common
        inside = (a[live] < n) & (b[live] < n)
        at = live[inside]
        same = at[levels[k][a[at]] == levels[k][b[at]]]
        common[same + 1] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    return order, common


# ---- interval tree -----------------------------------------------------------------------------

def joined(large: list, small: list, left: list, common: int, least: int, times: int, out: list) -> list:
    """Merge two children's ordered positions; maximal pairs of allowed distance go to ``out`` as (start, length, period)."""
    if len(large) < len(small):
        large, small = small, large
    reach = common // (times - 1)
    for p in small:
        x = left[p]
        k = bisect_left(large, p - reach)
        if k < len(large) and large[k] < p and left[large[k]] != x and common + p - large[k] >= least:
            out.append((large[k], common + p - large[k], p - large[k]))
        k = bisect_right(large, p)
        if k < len(large) and large[k] <= p + reach and left[large[k]] != x and common + large[k] - p >= least:
            out.append((p, common + large[k] - p, large[k] - p))
    if len(small) * 8 < len(large):
        for p in small:
            insort(large, p)
        return large
    large += small
    large.sort()
    return large


def maximal_pairs(order: np.ndarray, common: np.ndarray, left: list, seed: int, least: int, times: int) -> list:
    """(start, length, distance) of the maximal pairs that are runs, over the intervals of ``seed`` and more in common."""
    deep = common >= seed
    part = deep | np.concatenate([deep[1:], [False]])
    out: list = []
    stack: list = []
    whole = 1 << 62

    def close(depth):
        child = None
        while stack and stack[-1][0] > depth:
            at, mine = stack.pop()
            child = mine if child is None else joined(mine, child, left, at, least, times, out)
        return child

    for p, depth in zip(order[part].tolist(), np.where(deep, common, 0)[part].tolist()):
        child = close(depth)
        if child is not None and depth:
            if stack and stack[-1][0] == depth:
                stack[-1] = (depth, joined(stack[-1][1], child, left, depth, least, times, out))
            else:
                stack.append((depth, child))
        stack.append((whole, [p]))
    close(0)
    return out


def word_runs(word: np.ndarray, first: np.ndarray, least: int = LEAST, times: int = TIMES) -> dict[int, list]:
    """Text number -> its runs [(start, length, period)] in order, for texts word[first[i]:first[i+1]]."""
    seed = -(-least * (times - 1) // times)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if len(word) < least:
        return {}
    some = repeats_in(word, doc, 1 << (seed.bit_length() - 1))
    if not len(some):
        return {}
    pick = np.isin(doc, some)
    word, doc = word[pick], doc[pick]
    start = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    left = np.concatenate([[0], word[:-1]])
    left[start] = -1 - start  # a text's first word has a class of its own
    order, common = suffixes(word, doc)
    period: dict = {}
    for s, n, q in maximal_pairs(order, common, left.tolist(), seed, least, times):
        period[s, n] = min(q, period.get((s, n), q))
    offset = dict(zip(doc[start].tolist(), start.tolist()))
    found: dict[int, list] = {}
    for (s, n), q in period.items():
        d = int(doc[s])
        found.setdefault(d, []).append((s - offset[d], n, q))
    return {d: sorted(r, key=lambda x: (x[0], x[2])) for d, r in found.items()}


def collapsed(words: list, runs: list) -> list:
    """The words that stay: of every run its first period, unless another run drops it."""
    gone = np.zeros(len(words) + 1, dtype=np.int64)
    for s, n, q in runs:
        gone[s + q] += 1
        gone[s + n] -= 1
    return [w for w, g in zip(words, np.cumsum(gone).tolist()) if not g]


# ---- Spark -------------------------------------------------------------------------------------

def planted(doc_id: int | None, words: list) -> list:
    """The words as the query rebuilds them: in one text of ten a pattern repeats to the end."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    tail = words[a:a + p]
    return words[:a] + (tail * -(-(n - a) // p))[:n - a]


def _runs(rebuild, batches):
    import pandas as pd
    import pyarrow as pa
    for b in batches:
        for sl in slices(b, SLICE_BYTES):
            ids = sl.column("doc_id").to_pylist()
            texts = [(t or b"").split() for t in sl.column("text").cast(pa.binary()).to_pylist()]
            if rebuild is not None:
                texts = [rebuild(d, w) for d, w in zip(ids, texts)]
            first = np.cumsum([0, *map(len, texts)])
            number, _ = pd.factorize(np.array([w for t in texts for w in t], dtype=object))
            runs = word_runs(number.astype(np.int64), first)
            keys = ("start", "length", "period")
            yield pa.RecordBatch.from_arrays(
                [sl.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([[dict(zip(keys, r)) for r in runs.get(i, ())] for i in range(len(texts))],
                          pa.list_(pa.struct([(k, pa.int64()) for k in keys]))),
                 pa.array([b" ".join(collapsed(t, runs[i]) if i in runs else t) for i, t in enumerate(texts)], pa.binary())],
                ["doc_id", "n_words", "runs", "kept"])


def periodic_runs(docs: DataFrame, rebuild=None) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and ``kept``, the collapsed text's UTF-8 bytes.

    ``rebuild(doc_id, words)`` may give other words to judge. No shuffle.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(partial(_runs, rebuild), RUNS)


def greatest_run(runs: Column) -> Column:
    """The run with the greatest length / period (exactly compared; ties: smallest start, then period), or null."""
    def order(a, b):
        x, y = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(x > y, -1).when(x < y, 1).when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))
    return F.get(F.array_sort(runs, order), F.lit(0))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(documents(spark, sf_dir), planted)
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    found = found.withColumn("best", greatest_run(F.col("runs")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2("kept", 256).alias("collapsed_sha256"))
