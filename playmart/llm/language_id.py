"""Language identification with hyperdimensional profiles (operator 6).

Every letter has a random +1/-1 vector of ``DIM`` elements, seeded by its code point. A letter
trigram is bound as rho(rho(a)) * rho(b) * c, where rho rotates a vector, a text's profile is the
bundle (sum) of its trigrams, and a language's prototype is the bundle of its training texts. A text
gets the language whose prototype has the largest cosine with its profile. Runs of non-letters
count as one blank, which also stands before and after the text.

Prototypes are summed over all training rows: each task bundles its rows per language and emits one
vector per language it met, and these are added up, so what is shuffled and gathered is languages x
``DIM`` numbers whatever the size of the corpus. Only text and lang of training rows are read.
Text profiles are sums over blocks of trigrams, as a product where most texts of a slice have most of
them and from the sorted (trigram, text) pairs elsewhere; whole texts are used.

Defined results: null text, or text without a letter, gets ``und`` with score 0, as does every
text when nothing was learned; equal cosines go to the first language in code point order; scores
are cosines, negative ones 0. Repeated rows get equal answers.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import documents, slices

DIM = 1024
UNKNOWN = "und"
SLICE_BYTES, SLICE_ROWS = 1 << 19, 2048
PIECE, BLOCK, VECTORS = 1 << 18, 1 << 19, 4096
_letters: list[np.ndarray] = []
_vectors: dict[int, np.ndarray] = {}


def letter_table() -> np.ndarray:
    if not _letters:
        t = np.zeros(0x110000, dtype=bool)
        t[:0x33480] = [chr(i).isalpha() for i in range(0x33480)]
        _letters.append(t)
    return _letters[0]


def letter_vector(code: int) -> np.ndarray:
    """The random +1/-1 vector of a code point (0: blank), the same in every process."""
    if code not in _vectors:
        _vectors[code] = np.random.default_rng([20241, code]).integers(0, 2, DIM, dtype=np.int8) * 2 - 1
    return _vectors[code]


def letters_of(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, runs of other characters as one 0, 0 at both ends."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.where(letter_table()[raw], raw, 0)
    codes = np.concatenate([[0], codes, [0]]).astype(np.int64)
    return codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]


def counts(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Trigram counts (texts, trigrams) as float32 and the trigrams' code points (trigrams, 3)."""
    seqs = [letters_of(t) for t in texts]
    codes = np.concatenate(seqs) if seqs else np.zeros(0, np.int64)
    size = np.array([len(s) for s in seqs], dtype=np.int64)
    if not len(codes):
        return np.zeros((len(texts), 0), np.float32), np.zeros((0, 3), np.int64)
    alphabet, ids = np.unique(codes, return_inverse=True) if codes.max() > 0xFFFF else _compact(codes)
    a = len(alphabet)
    doc = np.repeat(np.arange(len(texts)), size)
    tri = (ids[:-2] * a + ids[1:-1]) * a + ids[2:]
    ok = (doc[:-2] == doc[2:])
    tri, doc = tri[ok], doc[:-2][ok]
    used, col = _distinct(tri, a ** 3)
    m = np.bincount(doc * len(used) + col, minlength=len(texts) * len(used)).reshape(len(texts), len(used))
    return m.astype(np.float32), _letters_in(used, alphabet)


def _distinct(tri: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams that occur and, for each element, its number among them; all are below ``size``."""
    if size > 1 << 22:
        return np.unique(tri, return_inverse=True)
    used = np.flatnonzero(np.bincount(tri, minlength=size))
    at = np.zeros(size, dtype=np.int64)
    at[used] = np.arange(len(used))
    return used, at[tri]


def _letters_in(tri: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """Code points (trigrams, 3)."""
    a = len(alphabet)
    return np.stack([alphabet[tri // (a * a)], alphabet[tri // a % a], alphabet[tri % a]], 1)


def _compact(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    alphabet = np.flatnonzero(np.bincount(codes))
    at = np.zeros(0x10000, dtype=np.int64)
    at[alphabet] = np.arange(len(alphabet))
    return alphabet, at[codes]


def trigram_vectors(tri: np.ndarray) -> np.ndarray:
    """Bound trigram vectors (trigrams, DIM), float32."""
    alphabet, at = np.unique(tri, return_inverse=True)
    at = at.reshape(tri.shape)
    v = np.stack([letter_vector(int(c)) for c in alphabet]) if len(alphabet) else np.zeros((0, DIM), np.int8)
    r1, r2 = np.roll(v, 1, axis=1), np.roll(v, 2, axis=1)
    return (r2[at[:, 0]] * r1[at[:, 1]] * v[at[:, 2]]).astype(np.float32)


def profiles(texts: list[str | None], owner: np.ndarray | None = None, n: int | None = None) -> np.ndarray:
    """Bundles (n, DIM) of the trigram vectors of each owner's texts (by default every text its own), float64.

    Sequences are cut into pieces of ``PIECE`` letters that overlap by two, and read in blocks of ``BLOCK`` letters;
    vectors exist for ``VECTORS`` trigrams at a time, so memory does not grow with a text or a script.
    """
    owner = np.arange(len(texts)) if owner is None else owner
    out = np.zeros((len(texts) if n is None else n, DIM))

    def add(seqs, who):
        whom, who = np.unique(who, return_inverse=True)
        codes = np.concatenate(seqs)
        doc = np.repeat(np.arange(len(seqs)), [len(s) for s in seqs])
        same = doc[:-2] == doc[2:]
        alphabet, ids = _compact(codes) if codes.max() <= 0xFFFF else np.unique(codes, return_inverse=True)
        a = len(alphabet)
        tri = ((ids[:-2] * a + ids[1:-1]) * a + ids[2:])[same]
        used, col = _distinct(tri, a ** 3)
        row = who[doc[:-2][same]]
        if len(whom) * len(used) <= 16 * len(tri):  # most owners have most of the trigrams
            m = np.bincount(row * len(used) + col, minlength=len(whom) * len(used)).reshape(len(whom), len(used)).astype(np.float32)
            for k in range(0, len(used), VECTORS):
                out[whom] += m[:, k:k + VECTORS] @ trigram_vectors(_letters_in(used[k:k + VECTORS], alphabet))
            return
        pair, times = np.unique(col * len(whom) + row, return_counts=True)
        col, row = pair // len(whom), pair % len(whom)
        for k in range(0, len(used), VECTORS):
            vec = trigram_vectors(_letters_in(used[k:k + VECTORS], alphabet))
            lo, hi = np.searchsorted(col, [k, k + VECTORS])
            for x in range(lo, hi, VECTORS):
                by = np.argsort(row[x:min(hi, x + VECTORS)], kind="stable") + x
                start = np.flatnonzero(np.concatenate([[True], row[by][1:] != row[by][:-1]]))
                out[whom[row[by][start]]] += np.add.reduceat(vec[col[by] - k] * times[by].astype(np.float32)[:, None], start, axis=0)

    seqs, who, held = [], [], 0
    for t, o in zip(texts, owner.tolist()):
        s = letters_of(t)
        for k in range(0, max(1, len(s) - 2), PIECE):
            piece = s[k:k + PIECE + 2]
            if len(piece) < 3:
                continue
            seqs.append(piece)
            who.append(o)
            held += len(piece)
            if held >= BLOCK:
                add(seqs, np.array(who))
                seqs, who, held = [], [], 0
    if seqs:
        add(seqs, np.array(who))
    return out


def pieces(batch):
    for s in slices(batch, SLICE_BYTES):
        for k in range(0, s.num_rows, SLICE_ROWS):
            yield s.slice(k, SLICE_ROWS)


def _bundle(batches):
    """Sum of the trigram vectors per language over the rows of one task."""
    import pyarrow as pa
    total: dict[str, np.ndarray] = {}
    for b in batches:
        for s in pieces(b):
            langs, owner = np.unique(np.array(s.column("lang").to_pylist(), dtype=object), return_inverse=True)
            for lang, row in zip(langs, profiles(s.column("text").to_pylist(), owner, len(langs))):
                total[lang] = total.get(lang, 0) + row
    yield pa.RecordBatch.from_pydict({
        "lang": pa.array([k for k in total for _ in range(DIM)], pa.string()),
        "i": pa.array([i for _ in total for i in range(DIM)], pa.int32()),
        "x": pa.array(np.concatenate([*total.values(), np.zeros(0)]), pa.float64())})


def learn(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in code point order and their prototypes (languages, DIM) from rows (text, lang)."""
    sums = (rows.where("text is not null and lang is not null").select("text", "lang")
            .mapInArrow(_bundle, "lang string, i int, x double")
            .groupBy("lang", "i").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))  # DIM rows a language
            .select("lang", "v.x").collect())
    table = {r["lang"]: np.array(r["x"]) for r in sums if np.any(r["x"])}
    langs = sorted(table)
    protos = np.stack([table[k] / np.linalg.norm(table[k]) for k in langs]) if langs else np.zeros((0, DIM))
    return langs, protos.astype(np.float32)


def predict(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with lang_pred and score; only ``text`` enters the prediction."""
    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    langs, protos = model
    schema = StructType([docs.schema[k] for k in keep]
                        + [StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    def run(batches):
        import pyarrow as pa
        names = np.array([*langs, UNKNOWN], dtype=object)
        for b in batches:
            for s in pieces(b):
                texts = s.column("text").to_pylist()
                pred = np.full(len(texts), len(langs))
                score = np.zeros(len(texts))
                if len(langs):
                    profile = profiles(texts)
                    norm = np.linalg.norm(profile, axis=1)
                    cos = (profile @ protos.T) / np.maximum(norm, 1e-12)[:, None]
                    best = cos.argmax(1)
                    has = profile.any(1)
                    pred[has] = best[has]
                    score[has] = np.clip(cos[np.arange(len(texts)), best], 0, 1)[has]
                yield pa.RecordBatch.from_arrays([*(s.column(k) for k in keep), pa.array(names[pred], pa.string()),
                                                  pa.array(score.astype(np.float64))], [*keep, "lang_pred", "score"])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def op6_hd_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    model = learn(docs.where(~held_out))
    return (predict(docs.select("doc_id", "text"), model, ["doc_id"])
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))
