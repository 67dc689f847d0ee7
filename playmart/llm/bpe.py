"""Byte-level BPE encoding and decoding with overlapping chunks (operator 7).

Method. A text longer than ``CHUNK`` characters is cut into chunks that overlap by ``OVERLAP``
characters; chunks are rows of their own, so one huge text is pre-tokenised by many tasks. In each
overlap both neighbours list their pre-token boundaries; the text is stitched at the first boundary
that both have (they have resynchronised). The pieces between the seams are then encoded on their
own and the ids concatenated in order. Where two chunks share no boundary (one pre-token longer
than the overlap) they stay together as one piece, so the result is exact for every text.

Only boundaries between a non-space and a white-space character count as seams: no match of the
pattern holds a non-space followed by white space, so such a place is a boundary of the whole text
too. The same fact lets a piece be encoded word by word with a bounded memo of words.

Defined results: null text reads as empty (0 ids, digests of the empty string); repeated rows stay
repeated; extra columns of the input are passed through by ``encode``.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import bound_batches, documents, stored

CHUNK = 1 << 14
OVERLAP = 1 << 10
RANKS = "byte_bpe_50k.tiktoken"
MEMO = 150_000  # words kept per worker
SLICE = 1 << 14  # ids of a text that are Python numbers at once

#: Unicode White_Space, what \s of the pattern matches.
SPACE = ("\t-\r \x85\xa0" + chr(0x1680) + chr(0x2000) + "-" + chr(0x200A)
         + chr(0x2028) + chr(0x2029) + chr(0x202F) + chr(0x205F) + chr(0x3000))
_PIECE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_SEAM = re.compile(f"(?<=[^{SPACE}])(?=[{SPACE}])")

_codecs: dict = {}


class Codec:
    """Encoder and decoder of one rank file, built once per Python worker."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=ranks, special_tokens={})
        self.decimal = {i: str(i) for i in ranks.values()}
        self.memo: dict[str, bytes] = {}  # word -> its ids, four bytes each

    @staticmethod
    def of(path: str) -> Codec:
        if path not in _codecs:
            _codecs[path] = Codec(path)
        return _codecs[path]

    def word(self, w: str) -> bytes:
        if len(self.memo) >= MEMO:
            self.memo.clear()
        ids = np.array(self.encoding.encode_ordinary(w), np.int32).tobytes()
        if len(w) < 64:
            self.memo[w] = ids
        return ids

    def packed(self, text: str) -> np.ndarray:
        """The ids of a text, four bytes each."""
        get, word = self.memo.get, self.word
        return np.frombuffer(b"".join([get(w) or word(w) for w in _PIECE.findall(text)]), np.int32)

    def encode(self, text: str) -> list[int]:
        return self.packed(text).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)

    def digest(self, ids: np.ndarray) -> tuple[int, str, str]:
        """The number of ids and the digests of their line and of the decoded bytes, taken slice by slice."""
        line, raw = hashlib.sha256(), hashlib.sha256()
        for i in range(0, len(ids), SLICE):
            part = ids[i:i + SLICE].tolist()
            line.update((" " * (i > 0) + " ".join(map(self.decimal.__getitem__, part))).encode())
            raw.update(self.decode(part))
        return len(ids), line.hexdigest(), raw.hexdigest()


def ranks_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path(RANKS)


def boundaries(text: str, last: bool) -> list[int]:
    """Starts of the pre-tokens of one chunk that are safe seams and do not depend on what follows it."""
    import public_tokenizers
    import regex

    if "pattern" not in _codecs:
        _codecs["pattern"] = regex.compile(public_tokenizers.PATTERN)
    margin = len(text) if last else len(text) - 3
    starts = [m.start() for m in _codecs["pattern"].finditer(text) if m.end() <= margin]
    seams = {m.start() for m in _SEAM.finditer(text)}
    return [p for p in starts if p in seams]


def _split(chunk: int, overlap: int):
    def run(batches):
        import pyarrow as pa
        for b in batches:
            for row, text in zip(b.column("row").to_pylist(), b.column("text").to_pylist()):
                n = -(-len(text) // chunk)
                yield pa.RecordBatch.from_pydict(
                    {"row": pa.array([row] * n, pa.int64()), "c": pa.array(range(n), pa.int32()),
                     "last": pa.array([i == n - 1 for i in range(n)], pa.bool_()),
                     "text": pa.array([text[i * chunk:(i + 1) * chunk + overlap] for i in range(n)],
                                      pa.string())})
    return run


def _pretokenise(chunk: int, overlap: int):
    def run(batches):
        import pyarrow as pa
        ints = pa.list_(pa.int32())
        for b in batches:
            head, tail = [], []
            for last, text in zip(b.column("last").to_pylist(), b.column("text").to_pylist()):
                at = boundaries(text, last)
                head.append([p for p in at if p < overlap])
                tail.append([p - chunk for p in at if p >= chunk])
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("c"), b.column("text"), pa.array(head, ints), pa.array(tail, ints)],
                ["row", "c", "text", "head", "tail"])
    return run


def pieces(texts: DataFrame, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(row, text) -> (row, piece, text): texts cut at resynchronised pre-token boundaries."""
    assert overlap < chunk
    chunks = (texts.mapInArrow(_split(chunk, overlap), "row long, c int, last boolean, text string")
              .repartition("row", "c")
              .mapInArrow(_pretokenise(chunk, overlap),
                          "row long, c int, text string, head array<int>, tail array<int>"))
    w = Window.partitionBy("row").orderBy("c")
    seam = F.array_min(F.array_intersect("head", F.lag("tail").over(w)))
    cut = (chunks.withColumn("seam", F.when(F.col("c") == 0, F.lit(0)).otherwise(seam))
           .withColumn("next", F.lead("seam").over(w))
           .withColumn("end", F.lead("c").over(w).isNull())
           .withColumn("piece", F.sum(F.col("seam").isNotNull().cast("int")).over(w)))
    start = F.coalesce("seam", F.lit(0))
    stop = F.when(F.col("end"), F.lit(chunk + overlap)).otherwise(F.coalesce("next", F.lit(0)) + chunk)
    return (cut.withColumn("text", F.substring("text", start + 1, stop - start))
            .groupBy("row", "piece")
            .agg(F.array_sort(F.collect_list(F.struct("c", "text"))).alias("parts"))
            .select("row", "piece", F.array_join("parts.text", "").alias("text")))


def _encode(path: str | None, keep: list[str]):
    def run(batches):
        import pyarrow as pa
        codec = Codec.of(ranks_path(path))
        for b in batches:
            ids = [codec.packed(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(ids, pa.list_(pa.int32()))],
                                             [*keep, "ids"])
    return run


def encode(df: DataFrame, text: str = "text", ids: str = "ids", path: str | None = None,
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Add the array column ``ids`` with the token ids of the whole ``text``."""
    bound_batches(df.sparkSession)
    rows = stored(df.withColumn("_row", F.monotonically_increasing_id()), "bpe-rows")  # numbers that no retry changes
    texts = rows.select(F.col("_row").alias("row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    enc = long_ids(texts, path, chunk, overlap).unionByName(
        texts.where(F.length("text") <= chunk)
        .mapInArrow(_encode(path, ["row"]), "row long, ids array<int>"))
    return rows.join(enc.select(F.col("row").alias("_row"), F.col("ids").alias(ids)), "_row").drop("_row")


def long_ids(texts: DataFrame, path: str | None, chunk: int, overlap: int) -> DataFrame:
    """(row, ids) of the texts above ``chunk`` characters, by overlapping chunks."""
    enc = (pieces(texts.where(F.length("text") > chunk), chunk, overlap)
           .mapInArrow(_encode(path, ["row", "piece"]), "row long, piece long, ids array<int>"))
    return (enc.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("piece", "ids"))).alias("p"))
            .select("row", F.flatten("p.ids").alias("ids")))


def decode(df: DataFrame, ids: str = "ids", raw: str = "raw", path: str | None = None) -> DataFrame:
    """Add the binary column ``raw``: the concatenated bytes of the tokens in ``ids`` (null: empty)."""
    def run(it):
        codec = Codec.of(ranks_path(path))
        for s in it:
            yield s.map(lambda x: codec.decode([int(i) for i in x]) if x is not None else b"")
    from collections.abc import Iterator

    import pandas as pd
    run.__annotations__ = {"it": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn(raw, F.pandas_udf(run, "binary")(F.col(ids)))


DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digest_rows(doc_ids, ids, codec):
    """``ids`` gives the id array of one text after another; none is kept."""
    import pyarrow as pa
    out = [codec.digest(x) for x in ids]
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string()),
         pa.array([o[2] for o in out], pa.string())],
        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _digest_texts(path: str | None):
    def run(batches):
        codec = Codec.of(ranks_path(path))
        for b in batches:
            for i in range(0, b.num_rows, 256):
                s = b.slice(i, 256)
                yield _digest_rows(s.column("doc_id"), map(codec.packed, s.column("text").to_pylist()), codec)
    return run


def _digest_ids(path: str | None):
    def run(batches):
        codec = Codec.of(ranks_path(path))
        for b in batches:
            ids = b.column("ids")
            yield _digest_rows(b.column("doc_id"), (x.values.to_numpy(zero_copy_only=False) for x in ids), codec)
    return run


def encode_digest(df: DataFrame, path: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Encode every whole text, decode the ids again and return one digest row per input row."""
    bound_batches(df.sparkSession)
    texts = df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = texts.where(F.length("text") <= chunk).mapInArrow(_digest_texts(path), DIGEST)
    long = stored(texts.where(F.length("text") > chunk).withColumn("row", F.monotonically_increasing_id()), "bpe-long")
    ids = long_ids(long.select("row", "text"), path, chunk, overlap)
    digests = (ids.join(long.select("row", "doc_id"), "row").select("doc_id", "ids")
               .mapInArrow(_digest_ids(path), DIGEST))
    return short.unionByName(digests)


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digest(documents(spark, sf_dir))
