"""Line sequence labelling with a linear-chain conditional random field (operator 4).

Every line with a word is a position of the sequence; a linear-chain CRF scores the labels
``content`` and ``boilerplate`` from line features and label transitions; Viterbi decoding marks
the lines, and the share of words on content lines decides whether a document is retained.

The CRF is trained here on a bounded sample of labelled documents: the ``MAX_TRAIN`` labelled rows
with the smallest hash of doc_id, every line taking the label of its document (quality 1: content);
in that order, documents with which the sample would pass ``MAX_LINES`` lines are left out of training.
Training runs on those rows' line features on the driver; decoding runs in the tasks on all
documents, each on its whole text.

Defined results: null or empty text has no words, so the base rule rejects it; ties between label
paths go to ``content``; repeated rows are judged alike; without usable labels (none, or one class
only) the fixed ``PRIOR`` weights are used. ``filter_quality`` returns its input's columns whatever
their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from playmart.sources.tables import read_table

from .common import bound_batches, documents

MAX_TRAIN = 1500
MAX_LINES = 100_000
CONTENT_SHARE = 0.5
MIN_WORDS = 50
SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"

FEATURES = ("bias", "symbols>0", "symbols>=30%", "upper>=50%", "upper>=90%", "distinct<50%", "distinct<20%",
            "bars>=20%", "shouts>=30%", "digits>=30%", "repeated line", "words<4", "words>=12",
            "letters<50%")
#: Emission weights (content minus boilerplate) and transitions before any training.
PRIOR = (np.array([1.5, -1.0, -2.0, -1.0, -1.5, -1.0, -1.5, -2.0, -2.0, -0.5, -0.7, -0.3, 0.6, -1.5]),
         np.array([[0.5, -0.5], [-0.5, 0.5]]))


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a whole text."""
    words = text.encode("utf-8", "surrogatepass").split()
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        if line in seen:
            dup += 1
        elif line.encode("utf-8", "surrogatepass").strip():
            seen.add(line)
    repeat = 0
    if len(words) > 3:
        windows = list(zip(words, words[1:], words[2:]))
        found = Counter(windows)
        if len(found) < len(windows):
            end = 0
            for i, win in enumerate(windows):
                if found[win] > 1:
                    repeat += i + 3 - max(end, i)
                    end = i + 3
    return len(words), word_chars, n_symbols, dup, repeat


_classes: list[np.ndarray] = []


def char_classes() -> np.ndarray:
    """Bit flags by code point: letter 1, upper case 2, cased 4, digit 8, symbol 16, bar 32, shout 64, space 128."""
    if not _classes:
        t = np.zeros(0x110000, dtype=np.uint8)
        for cp in range(0x30000):
            c = chr(cp)
            t[cp] = c.isalpha() | (c.isupper() << 1) | ((c.isupper() or c.islower()) << 2)
        for chars, bit in (("0123456789", 8), (SYMBOLS, 16), ("|", 32), ("!", 64), (SPACES, 128)):
            for c in chars:
                t[ord(c)] |= bit
        _classes.append(t)
    return _classes[0]


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """0/1 features (lines, len(FEATURES)) and word counts of the lines that have words."""
    lines = text.split("\n")
    words = [line.encode("utf-8", "surrogatepass").split() for line in lines]
    n = np.array([len(w) for w in words], dtype=np.int64)
    has = n > 0
    if not has.any():
        return np.zeros((0, len(FEATURES))), np.zeros(0, dtype=np.int64)
    seen: set[str] = set()
    again = [line in seen or seen.add(line) is not None for line in lines]
    distinct = np.array([len(set(w)) for w in words])
    cls = char_classes()[np.frombuffer((text + "\n").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    size = np.array([len(line) + 1 for line in lines])
    starts = np.cumsum(size) - size

    def count(bit):
        return np.add.reduceat((cls & bit != 0).astype(np.int32), starts)
    letters, upper, cased, digits = count(1), count(2), count(4), count(8)
    symbols, bars, shouts, chars = count(16), count(32), count(64), size - count(128)
    rows = np.stack([has, symbols > 0, symbols >= 0.3 * n, (cased > 0) & (upper >= 0.5 * cased),
                     (cased > 0) & (upper >= 0.9 * cased), (n > 3) & (distinct < 0.5 * n),
                     (n > 3) & (distinct < 0.2 * n), bars >= 0.2 * n, shouts >= 0.3 * n, digits >= 0.3 * chars,
                     np.array(again), n < 4, n >= 12, letters < 0.5 * chars], 1)
    return rows[has].astype(np.float64), n[has]


def viterbi(scores: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Best label path (0 content, 1 boilerplate) for emission ``scores`` (lines, 2)."""
    n = len(scores)
    if not n:
        return np.zeros(0, dtype=np.int8)
    (t00, t01), (t10, t11) = trans.tolist()
    a, b = scores[0].tolist()
    back = []
    for x, y in scores[1:].tolist():
        p, q, r, s = a + t00, b + t10, a + t01, b + t11
        back.append((p < q, r < s))
        a, b = max(p, q) + x, max(r, s) + y
    path = [int(a < b)]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return np.array(path[::-1], dtype=np.int8)


def train(sequences: list[tuple[np.ndarray, int]], steps: int = 150, rate: float = 0.3,
          decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of a two-label linear chain by gradient ascent (forward-backward).

    ``sequences`` are (features, label of all lines). Returns (weights for content minus
    boilerplate, transition scores); ``PRIOR`` without both labels.
    """
    sequences = [(f, y) for f, y in sequences if len(f)]
    if len({y for _, y in sequences}) < 2:
        return PRIOR
    order = sorted(sequences, key=lambda s: -len(s[0]))
    lengths = np.array([len(f) for f, _ in order])
    feats = np.concatenate([f for f, _ in order])
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    labels = np.repeat([y for _, y in order], lengths)
    weight = np.repeat(1.0 / lengths, lengths)  # every document counts alike
    share = {y: 0.5 / sum(1 for _, z in order if z == y) for y in (0, 1)}
    weight *= np.repeat([share[y] for _, y in order], lengths)
    per_doc = np.array([share[y] / n for (_, y), n in zip(order, lengths)])
    alive = [int((lengths > t).sum()) for t in range(lengths[0])]
    w, trans = np.zeros(feats.shape[1]), np.zeros((2, 2))
    mw, vw, mt, vt = np.zeros_like(w), np.zeros_like(w), np.zeros_like(trans), np.zeros_like(trans)
    target_t = np.zeros((2, 2))
    for (_, y), n, p in zip(order, lengths, per_doc):
        target_t[y, y] += (n - 1) * p
    for step in range(1, steps + 1):
        e = np.stack([feats @ w / 2, -(feats @ w) / 2], 1)
        fwd, bwd = np.zeros_like(e), np.zeros_like(e)
        fwd[first] = e[first]
        for t in range(1, len(alive)):
            at = first[:alive[t]] + t
            fwd[at] = e[at] + np.logaddexp(fwd[at - 1, :1] + trans[0], fwd[at - 1, 1:] + trans[1])
        expect_t = np.zeros((2, 2))
        z = np.logaddexp(*fwd[first + lengths - 1].T)
        for t in range(len(alive) - 1, 0, -1):
            at = first[:alive[t]] + t
            right = e[at] + bwd[at]
            bwd[at - 1] = np.logaddexp(trans[:, 0] + right[:, :1], trans[:, 1] + right[:, 1:])
            joint = fwd[at - 1][:, :, None] + trans + right[:, None, :] - z[:alive[t], None, None]
            expect_t += (np.exp(joint) * per_doc[:alive[t], None, None]).sum(0)
        marginal = np.exp(fwd[:, 0] + bwd[:, 0] - np.repeat(z, lengths))
        gw = feats.T @ (weight * ((labels == 0) - marginal)) - decay * w
        gt = target_t - expect_t - decay * trans
        for g, x, m, v in ((gw, w, mw, vw), (gt, trans, mt, vt)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return w, trans


def within(sizes: list[tuple[int, int]], most: int) -> list[int]:
    """The ids of [(id, lines)], in order, whose lines fit into ``most`` together with those taken before."""
    out, total = [], 0
    for i, n in sizes:
        if total + n <= most:
            out.append(i)
            total += n
    return out


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, max_lines: int = MAX_LINES):
    """Train on the ``max_train`` labelled documents with the smallest hash of doc_id, of these on ``max_lines``
    lines at most (stated bounds)."""
    chosen = (labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
              .orderBy(F.crc32(F.col("doc_id").cast("string")), "doc_id").limit(max_train))
    texts = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    lines = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D][^\n]*"))  # those with a word
    sizes = (texts.groupBy("doc_id").agg(F.sum(lines).alias("n"))
             .select("doc_id", "n", F.crc32(F.col("doc_id").cast("string")).alias("at")).collect())
    ids = within([(r.doc_id, r.n) for r in sorted(sizes, key=lambda r: (r.at, r.doc_id))], max_lines)
    if len(ids) < len(sizes):
        texts = texts.where(F.col("doc_id").isin(ids))
    rows = (texts
            .mapInArrow(_featurise, "quality int, lines int, features binary").collect())
    width = len(FEATURES)
    seqs = [(np.frombuffer(bytes(r.features), dtype=np.uint8).reshape(r.lines, width).astype(np.float64),
             1 - r.quality) for r in rows]
    return train(sorted(seqs, key=lambda s: (s[1], len(s[0]), s[0].tobytes())))


def _featurise(batches: Iterator) -> Iterator:
    import pyarrow as pa
    for b in batches:
        f = [line_features(t)[0].astype(np.uint8) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("quality").cast(pa.int32()), pa.array([len(x) for x in f], pa.int32()),
             pa.array([x.tobytes() for x in f], pa.binary())], ["quality", "lines", "features"])


JUDGED = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "content_share double, base_failed boolean, kept boolean")


def judge_text(text: str | None, model) -> tuple:
    text = text or ""
    n, chars, symbols, dup, repeat = base_counts(text)
    failed = n < MIN_WORDS or 100 * repeat > 50 * n
    feats, words = line_features(text)
    score = feats @ model[0] / 2
    path = viterbi(np.stack([score, -score], 1), model[1])
    total = int(words.sum())
    share = float(words[path == 0].sum() / total) if total else 0.0
    return n, chars, symbols, dup, repeat, share, failed, not failed and share >= CONTENT_SHARE


def judge(docs: DataFrame, model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` and the judgement of its ``text`` (last of the columns sent)."""
    from pyspark.sql.types import StructType
    schema = StructType([docs.schema[k] for k in keep] + StructType.fromDDL(JUDGED).fields)
    names = [f.name for f in StructType.fromDDL(JUDGED).fields]

    def run(batches):
        import pyarrow as pa
        types = [pa.int64()] * 5 + [pa.float64(), pa.bool_(), pa.bool_()]
        for b in batches:
            out = list(zip(*(judge_text(t, model) for t in b.column("text").to_pylist()))) or [()] * 8
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), *map(pa.array, out, types)], [*keep, *names])
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(run, schema)


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the base rule and the labeller keep, with the columns of ``docs``."""
    bound_batches(spark)
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa
        for b in batches:
            ok = [judge_text(t, model)[-1] for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(ok, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def op4_line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return judge(docs, model, ["doc_id"])
