"""Operator 11 against the definition of a run."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from playmart.llm import periodic_runs


def smallest_period(w):
    fail = [0] * (len(w) + 1)
    k = 0
    for i in range(1, len(w)):
        while k and w[i] != w[k]:
            k = fail[k]
        k += w[i] == w[k]
        fail[i + 1] = k
    return len(w) - fail[len(w)]


def runs_by_definition(w, least=24, times=3):
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, times * q) and smallest_period(w[i:j + q]) == q:
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def digests(doc_id, text):
    w = (text or "").encode().split()
    n = len(w)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
    runs = runs_by_definition(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in gone)))


def sequences(seed):
    rnd = random.Random(seed)
    out = [[], [0], [0] * 23, [0] * 24, [0] * 200, [0, 1] * 40, [0, 0, 1] * 30 + [2] + [0, 0, 1] * 30]
    for _ in range(40):
        w = []
        while len(w) < rnd.choice([10, 60, 200]):
            unit = [rnd.randrange(rnd.choice([1, 2, 3, 50])) for _ in range(rnd.choice([1, 2, 3, 5, 9, 20]))]
            w += (unit * 12)[:rnd.choice([1, 8, 24, 25, 70, 100])]
        out.append(w)
    a, b = [0], [0, 1]
    while len(b) < 250:
        a, b = b, b + a
    return [*out, b, [0] * 30 + b + [0] * 30]


@pytest.mark.parametrize("seed", range(5))
def test_runs_match_the_definition(seed):
    seqs = sequences(seed)
    first = np.cumsum([0, *map(len, seqs)])
    word = np.concatenate([np.array(s, dtype=np.int64) for s in seqs])
    got = periodic_runs.word_runs(word, first)
    want = {i: r for i, s in enumerate(seqs) if (r := runs_by_definition(s))}
    assert len(want) > 10
    assert got == want


def test_other_limits_match_the_definition():
    for least, times in ((10, 2), (12, 4), (32, 3)):
        seqs = sequences(9)
        first = np.cumsum([0, *map(len, seqs)])
        word = np.concatenate([np.array(s, dtype=np.int64) for s in seqs])
        got = periodic_runs.word_runs(word, first, least, times)
        assert got == {i: r for i, s in enumerate(seqs) if (r := runs_by_definition(s, least, times))}


def test_suffix_order_and_common_lengths():
    rnd = random.Random(3)
    for _ in range(30):
        seqs = [[rnd.randrange(2) for _ in range(rnd.randrange(1, 40))] for _ in range(4)]
        word = np.array([x for s in seqs for x in s])
        doc = np.repeat(np.arange(4), [len(s) for s in seqs])
        ends = np.cumsum([len(s) for s in seqs])
        text = lambda p: (int(doc[p]), *word[p:ends[doc[p]]].tolist())  # noqa: E731, B023
        order, common = periodic_runs.suffixes(word, doc)
        want = sorted(range(len(word)), key=text)
        assert order.tolist() == want
        for k in range(1, len(want)):
            a, b = text(want[k - 1]), text(want[k])
            same = 0
            while a[0] == b[0] and same + 1 < min(len(a), len(b)) and a[same + 1] == b[same + 1]:
                same += 1
            assert common[k] == same


def texts():
    rnd = random.Random(11)
    line = " ".join(f"w{i}" for i in range(9))
    out = [None, "", " \t\n", "one", "a " * 24, "a " * 23, "A a " * 30, "ü 漢 " * 50 + "x", (line + "\n") * 5, "x" * 4000,
           "y " + (line + " ") * 2 + "w0 w1 w2 w3 w4 w5", " ".join(str(rnd.randrange(3)) for _ in range(900))]
    for k in range(60):
        out.append(" ".join(f"v{rnd.randrange(200)}" for _ in range(rnd.choice([5, 40, 300]))) + " end" * rnd.choice([0, 30]))
    return out


def test_query_rows_match_the_definition(spark, tmp_root):
    rows = [(i, t, "x", i) for i, t in enumerate(texts() * 2)] + [(None, "a " * 50, "y", 0), (None, None, None, None), (3, "b " * 99, "z", 1)]
    path = f"{tmp_root}/llm-runs-sf"
    spark.createDataFrame(rows, "doc_id long, text string, runs string, kept int").repartition(4) \
        .write.mode("overwrite").parquet(f"{path}/documents.parquet")
    out = periodic_runs.op11_periodic_runs(spark, path)
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == sorted((digests(d, t) for d, t, _, _ in rows), key=str)
    assert sum(g[1] > 0 for g in got) > 20


def test_empty_table_and_one_long_text(spark, no_docs):
    assert periodic_runs.periodic_runs(no_docs).count() == 0
    unit = " ".join(f"u{i}" for i in range(700))
    long = "lead " + " ".join([unit] * 300) + " tail " + "same " * 200_000
    got = periodic_runs.periodic_runs(spark.createDataFrame([(1, long)], "doc_id long, text string")).collect()[0]
    assert [tuple(r) for r in got.runs] == [(1, 210_000, 700), (210_002, 200_000, 1)]
    assert bytes(got.kept).decode() == f"lead {unit} tail same"
