"""Removal of repeated byte strings (operator 5), without the suffix array that was dealt.

A byte goes if some ``WIDTH``-byte string that covers it also starts anywhere else. Ranking all
suffixes costs one sorted (position, rank) pair per byte and round, 40 times the input in one round
measured on sf0.1 (README, "Where the method met the limits"). So no suffix is ranked; the strings at
sampled positions that every long string is bound to hold are grouped by their content hashes:

1. In the tasks, the names of the strings of 1, 2, 4, ... ``SEED`` bytes at every position follow from
   each other, name(2h) = pair(name(h) here, name(h) at offset h). A ``WIDTH``-byte string is filed
   under its *anchor*, the position in it whose ``SEED``-byte name is least (leftmost if tied), so
   equal strings are filed under equal names. Neighbouring strings with one anchor are one claim:
   about one claim in 65 bytes.
2. Spark groups the claims by the name of their anchor (32 bytes). Unique ones are done and leave.
3. The rest are grouped by the pair (anchor, name of the whole stretch, 200 to 368 bytes): equal pairs
   are past the threshold, their stretch goes as a whole.
4. What is left is grouped on growing strings around the anchor: blocks of ``BLOCK`` offsets share a core
   of 169 bytes; blocks with a unique core leave, equal whole blocks are settled.
5. Last, the remaining single strings of 200 bytes.

Names have 64 bits, and every decision compares two independent ones; each round is a map-side aggregated grouping and an equi-join (``repeats.settle``), and
its survivors are written to the shared folder.

Defined results: null text reads as empty; texts shorter than ``WIDTH`` keep everything; rows equal in
doc_id and text are copies of each other like any others; null doc_ids are allowed. A document's
kept bytes may cut a UTF-8 character: ``remove_repeats`` returns bytes, the pipeline stage drops
what is left of such characters.
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import M3, documents, mix64, pair_name, slices, stored, string_buffers
from .repeats import (CLAIM, KEY, NULL_ID, Chain, byte_symbols, claim_batch, claim_lists, covered, document_key, expand, keyed,
                      marked, settle, spread)

WIDTH, SEED, BLOCK = 200, 32, 32
SLICE_BYTES = 1 << 20
_FIRST, _A, _B = byte_symbols(51), byte_symbols(52), byte_symbols(53)
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93


def doubled_names(data: np.ndarray, length: int) -> np.ndarray:
    """Names of the ``length``-byte strings at every position, by prefix doubling (length a power of two)."""
    name, h = _FIRST[data], 1
    while h < length:
        name = pair_name(name[:-h], name[h:])
        h *= 2
    return name


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    out, h = x, 1
    while 2 * h <= width:
        out = np.minimum(out[:-h], out[h:])
        h *= 2
    return np.minimum(out[:len(x) - width + 1], out[width - h:width - h + len(x) - width + 1])


def anchors(data: np.ndarray, off: np.ndarray, width: int, seed: int):
    """Claims of the texts data[off[i]:off[i+1]]: (text, anchor, first string, number of strings, anchor's name)."""
    empty = np.zeros(0, np.int64)
    n = len(data)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(off))
    starts = np.flatnonzero(doc[:n - width + 1] == doc[width - 1:]) if n >= width else empty
    if not len(starts):
        return empty, empty, empty, empty, empty.astype(np.uint64)
    name = doubled_names(data, seed)
    bits = np.uint64(max(20, n.bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = sliding_min((name & ~low) | np.arange(len(name), dtype=np.uint64), width - seed + 1)[starts]
    at = (least & low).astype(np.int64)
    change = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
                                            | (doc[starts[1:]] != doc[starts[:-1]])]))
    count = np.diff(np.concatenate([change, [len(starts)]]))
    return doc[starts[change]], at[change], starts[change], count, name[at[change]]


def _claims(width: int, seed: int, batches):
    for b in batches:
        for sl in slices(b, SLICE_BYTES):
            data, off = string_buffers(sl.column("text"))
            doc, at, s, n, g = anchors(data, off, width, seed)
            if len(doc):
                u = Chain(_A[data], BASE_A).name(s, s + n - 1 + width)
                yield claim_batch(sl.column("did").to_numpy()[doc], sl.column("th").to_numpy()[doc], g, u,
                                  s - off[doc], n, at - s, np.ones(len(doc), bool))


def _blocks(width: int, block: int, batch):
    """Cut each open claim at multiples of ``block`` of the distance from string start to anchor."""
    for sl in slices(batch, SLICE_BYTES):
        data, off = string_buffers(sl.column("text"))
        did, th, doc, s, n, o, g, want = claim_lists(sl)
        first, last = (o - n + 1) // block, o // block  # distances o - n + 1 .. o
        row, j = spread(first, last - first + 1)
        at = (s + o + off[doc])[row]
        near, far = np.maximum((o - n + 1)[row], j * block), np.minimum(o[row], j * block + block - 1)
        core = Chain(_A[data], BASE_A).name(at - j * block, at - (j * block + block - 1) + width)
        gj = mix64(core + g[row].view(np.uint64) * M3 + j.astype(np.uint64))
        u = Chain(_B[data], BASE_B).name(at - far, at - near + width)
        u = mix64(u + (near * 4096 + far).astype(np.uint64) * M3)
        d = doc[row]
        yield claim_batch(did[d], th[d], gj, u, at - far - off[d], far - near + 1, far, want[row])


def _strings(width: int, batch):
    for sl in slices(batch, SLICE_BYTES):
        data, off = string_buffers(sl.column("text"))
        did, th, doc, s, n, _, _, want = claim_lists(sl)
        row, p = spread(s + off[doc], n)
        d = doc[row]
        yield claim_batch(did[d], th[d], Chain(_A[data], BASE_A).name(p, p + width), Chain(_B[data], BASE_B).name(p, p + width),
                          p - off[d], np.ones(len(p), np.int64), np.zeros(len(p), np.int64), want[row])


def repeated_bytes(docs: DataFrame, width: int = WIDTH, seed: int = SEED, block: int = BLOCK, key: dict | None = None) -> DataFrame:
    """did, th, text and ``marks``: runs of starts of strings that occur elsewhere. ``docs``: doc_id, text."""
    assert width > seed + block
    rows = keyed(docs, key)
    claims = stored(rows.mapInArrow(partial(_claims, width, seed), CLAIM), "suffix-claims")
    whole, open1 = settle(claims, "any", "suffix-anchors")
    blocks = expand(rows, open1, partial(_blocks, width, block), "suffix-blocks")
    partly, open2 = settle(blocks, "any", "suffix-cores")
    strings = expand(rows, open2, partial(_strings, width), "suffix-strings")
    single, _ = settle(strings, "any", "suffix-last", last=True)
    return marked(rows, whole.unionByName(partly).unionByName(single))


def kept_bytes(text: str, marks: list | None, width: int) -> tuple[bytes, int, int, int]:
    """Remaining bytes, size, bytes removed and number of maximal removed runs."""
    raw = text.encode("utf-8", "surrogatepass")
    if not marks:
        return raw, len(raw), 0, 0
    gone = covered(marks, len(raw), width)
    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes(), len(raw), int(gone.sum()), spans


def _kept(width: int, batches):
    import pyarrow as pa
    for b in batches:
        out = [kept_bytes(t, m, width) for t, m in zip(b.column("text").to_pylist(), b.column("marks").to_pylist())]
        cols = list(zip(*out)) or [[], [], [], []]
        yield pa.RecordBatch.from_arrays([b.column("did"), b.column("th"), pa.array(cols[0], pa.binary()),
                                          *(pa.array(c, pa.int64()) for c in cols[1:])],
                                         [*KEY, "kept", "n_bytes", "n_removed", "n_spans"])


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """did, th, kept (bytes), n_bytes, n_removed, n_spans for every document."""
    return repeated_bytes(docs, width).mapInArrow(
        partial(_kept, width), "did long, th long, kept binary, n_bytes long, n_removed long, n_spans long")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select(F.when(F.col("did") != NULL_ID, F.col("did")).alias("doc_id"), "n_bytes", "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))


def _kept_text(width: int, batches):
    import pyarrow as pa
    for b in batches:
        out = [kept_bytes(t, m, width)[0].decode("utf-8", "ignore")
               for t, m in zip(b.column("text").to_pylist(), b.column("marks").to_pylist())]
        yield pa.RecordBatch.from_arrays([b.column("did"), b.column("th"), pa.array(out, pa.string())], ["_did", "_th", "_kept"])


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of ``docs`` with repeats removed from ``text`` (and n_chars following it).

    A text that holds no repeat is unchanged; a null text stays null; a text that is removed whole
    becomes empty and its row stays. Bytes of a character that a removal cut in two go with it.
    """
    own = docs.columns
    key = document_key(docs)
    tagged = docs.withColumns({f"_{k}": c for k, c in key.items()})
    changed = (repeated_bytes(docs.select("doc_id", "text"), key=key).where("marks is not null").dropDuplicates(KEY)
               .mapInArrow(partial(_kept_text, WIDTH), "_did long, _th long, _kept string"))
    hit = F.col("_kept").isNotNull()
    out = (tagged.join(changed, ["_did", "_th"], "left")
           .withColumn("text", F.when(hit, F.col("_kept")).otherwise(F.col("text"))))
    if "n_chars" in own:
        out = out.withColumn("n_chars", F.when(hit, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*(F.col(f"`{c}`") for c in own))
