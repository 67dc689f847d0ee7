"""Substring dedup by recompression (operator 9): repeated windows of ``WIDTH`` words are removed.

Recompression. A text is a sequence of word names. In each of ``ROUNDS`` rounds every symbol falls
into a left or a right class by a bit of its name, every pair (left, right) becomes one symbol, and
a run of equal symbols that are left over becomes one symbol; a new symbol's name is a function of
its parts only, so naming is global without a dictionary: equal stretches get equal interior
symbols in every document. For every symbol the words are tracked on which its formation depends.
A window's *interior symbols* are those that depend on nothing outside it, and the window is filed
under one of them (the least-hashed among those of three words and more, if there is one), so equal
windows are always filed under the same symbol.

Spark then groups the windows by symbol (``repeats.settle``): symbols that no other document has
clear their windows at once, shared ones reveal candidate stretches, equal stretches are settled as
a whole, and what is left is verified window by window.

Defined results: null or empty text has no words (digest of the empty string); texts shorter than a
window keep everything; a window whose other occurrences are in documents with equal or larger
doc_id stays; null doc_ids count as the smallest. Extra columns are ignored.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import M1, documents, mix64, pair_name, slices, stored, string_buffers
from .repeats import CLAIM, NULL_ID, Chain, byte_symbols, claim_batch, claim_lists, covered, expand, keyed, marked, settle, spread

WIDTH = 13
ROUNDS = 4
SPAN = 3
SLICE_BYTES = 1 << 20
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_BYTES = byte_symbols(9)
BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def word_names(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words of the texts data[off[i]:off[i+1]] and the first word number of each text."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    inside = ~_SPACE[data]
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    cuts = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(data))]
    begin[cuts] = inside[cuts]
    end[cuts - 1] = inside[cuts - 1]
    start, stop = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Chain(_BYTES[data], BASE).name(start, stop), np.searchsorted(start, off)


def recompress(name: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS):
    """Yield (name, span, first and last word it depends on) of the words and of each round's new symbols.

    A symbol at the edge of a text depends on a word number outside the text.
    """
    at = np.arange(len(name))
    s, e, lo, hi = at, at, at, at
    yield name, np.ones(len(name), np.int64), lo, hi
    for r in range(1, rounds + 1):
        if len(name) < 2:
            return
        right = (mix64(name + np.uint64(r * 0x5851F42D4C957F2D % (1 << 64))) >> np.uint64(63)).astype(bool)
        same = doc[1:] == doc[:-1]
        head = np.concatenate([~right[:-1] & right[1:] & same, [False]])
        tail = np.concatenate([[False], head[:-1]])
        left_over = ~head & ~tail
        before = np.concatenate([[False], same])
        after = np.concatenate([same, [False]])
        # a symbol left over depends on both neighbours, a pair on its two parts only
        wide_lo = np.minimum(lo, np.minimum(np.where(before, np.roll(lo, 1), s - 1), np.where(after, np.roll(lo, -1), s)))
        wide_hi = np.maximum(hi, np.maximum(np.where(before, np.roll(hi, 1), e), np.where(after, np.roll(hi, -1), e + 1)))
        # an equal neighbour joins a run only if it is left over too: its fate counts as well
        h = np.flatnonzero(head)
        fate_lo, fate_hi = np.where(left_over, wide_lo, lo), np.where(left_over, wide_hi, hi)
        fate_lo[h] = fate_lo[h + 1] = np.minimum(lo[h], lo[h + 1])
        fate_hi[h] = fate_hi[h + 1] = np.maximum(hi[h], hi[h + 1])
        lo2, hi2 = np.where(left_over, wide_lo, lo), np.where(left_over, wide_hi, hi)
        for shift, beside in ((1, before), (-1, after)):
            equal = left_over & beside & (name == np.roll(name, shift))
            lo2 = np.where(equal, np.minimum(lo2, np.roll(fate_lo, shift)), lo2)
            hi2 = np.where(equal, np.maximum(hi2, np.roll(fate_hi, shift)), hi2)
        joins = np.concatenate([left_over[:-1] & left_over[1:] & same & (name[:-1] == name[1:]), [False]])
        inner = np.concatenate([[False], joins[:-1]])  # not the first of its run
        keep = np.flatnonzero(~tail & ~inner)
        last = np.concatenate([keep[1:], [len(name)]]) - 1  # last old symbol in each new one
        count = last - keep + 1
        run = joins[keep]
        new = pair_name(name[keep], np.where(run, count.astype(np.uint64), name[last]))
        made = run | head[keep]
        name = np.where(made, new, name[keep])
        s, e, doc = s[keep], e[last], doc[keep]
        lo, hi = np.minimum.reduceat(lo2, keep), np.maximum.reduceat(hi2, keep)
        yield name[made], (e - s + 1)[made], lo[made], hi[made]


def file_windows(name: np.ndarray, doc: np.ndarray, width: int = WIDTH, rounds: int = ROUNDS) -> np.ndarray:
    """For every word position the symbol under which the window starting there is filed."""
    n = len(name)
    value = [np.zeros(n, dtype=np.uint64) for _ in range(width)]  # by number of words depended on
    for sym, span, lo, hi in recompress(name, doc, rounds):
        need = hi - lo
        ok = (lo >= 0) & (hi < n) & (need < width)
        rank = (np.minimum(span, SPAN).astype(np.uint64) << np.uint64(62)) | (mix64(sym * M1 + np.uint64(1)) >> np.uint64(2))
        for d in np.unique(need[ok]):
            at = ok & (need == d)
            np.maximum.at(value[d], lo[at], rank[at])
    best = value[0]
    for d in range(1, width):  # best[p]: over symbols depending on words p .. p + d only
        best = np.maximum(np.maximum(best[:-1], best[1:]), value[d][:n - d])
    return best


def _claims(width: int, batches):
    for b in batches:
        for sl in slices(b, SLICE_BYTES):
            data, off = string_buffers(sl.column("text"))
            name, first = word_names(data, off)
            n = len(name)
            if n < width:
                continue
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
            ok = np.flatnonzero(doc[:n - width + 1] == doc[width - 1:])
            if not len(ok):
                continue
            filed = file_windows(name, doc, width)[ok]
            change = np.flatnonzero(np.concatenate([[True], (filed[1:] != filed[:-1]) | (ok[1:] != ok[:-1] + 1)
                                                    | (doc[ok[1:]] != doc[ok[:-1]])]))
            count = np.diff(np.concatenate([change, [len(ok)]]))
            start = ok[change]
            u = Chain(mix64(name + M1), WORD_BASE).name(start, start + count - 1 + width)
            d = doc[start]
            yield claim_batch(sl.column("did").to_numpy()[d], sl.column("th").to_numpy()[d], filed[change], u,
                              start - first[d], count, np.zeros(len(d), np.int64), np.ones(len(d), bool))


def _windows(width: int, batch):
    for sl in slices(batch, SLICE_BYTES):
        data, off = string_buffers(sl.column("text"))
        name, first = word_names(data, off)
        did, th, doc, s, n, _, g, want = claim_lists(sl)
        row, p = spread(s + first[doc], n)
        w = Chain(mix64(name + M1), WORD_BASE).name(p, p + width)
        d = doc[row]
        yield claim_batch(did[d], th[d], w, g[row].view(np.uint64), p - first[d], np.ones(len(p), np.int64),
                          np.zeros(len(p), np.int64), want[row])


def repeated_words(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """did, th, text and ``marks``: the runs of windows that also start in an earlier document."""
    rows = keyed(docs)
    claims = stored(rows.mapInArrow(partial(_claims, width), CLAIM), "recompression-claims")
    marks, open_claims = settle(claims, "earlier", "recompression")
    windows = expand(rows, open_claims, partial(_windows, width), "recompression-windows")
    more, _ = settle(windows, "earlier", "recompression-last", last=True)
    return marked(rows, marks.unionByName(more))


def _kept(width: int, batches):
    import pyarrow as pa
    for b in batches:
        out = []
        for text, marks in zip(b.column("text").to_pylist(), b.column("marks").to_pylist()):
            words = text.encode("utf-8", "surrogatepass").split()
            gone = covered(marks, len(words), width)
            kept = [w for w, x in zip(words, gone.tolist()) if not x] if marks else words
            out.append((len(words), int(gone.sum()), b" ".join(kept)))
        yield pa.RecordBatch.from_arrays(
            [b.column("did"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
             pa.array([x[2] for x in out], pa.binary())], ["did", "n_words", "n_removed", "kept"])


def dedup_words(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed and ``kept``: the UTF-8 bytes of the words that stay, joined by one space."""
    out = repeated_words(docs, width).mapInArrow(partial(_kept, width), "did long, n_words long, n_removed long, kept binary")
    return out.select(F.when(F.col("did") != NULL_ID, F.col("did")).alias("doc_id"), "n_words", "n_removed", "kept")


def op9_recompression_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_words(documents(spark, sf_dir)).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
