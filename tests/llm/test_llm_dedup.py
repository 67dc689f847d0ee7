"""Operators 5, 8 and 9 against brute force."""

from __future__ import annotations

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from playmart.llm import jaccard_join, recompression, suffix_dedup
from playmart.llm.common import mix64

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def cover(n, starts, width):
    gone = [False] * n
    for s in starts:
        gone[s:s + width] = [True] * len(gone[s:s + width])
    return gone


def test_suffix_dedup_matches_brute_force(rows, docs):
    raw = [(r[0], (r[1] or "").encode()) for r in rows]
    seen = collections.Counter(b[i:i + 200] for _, b in raw for i in range(len(b) - 199))
    want = []
    for d, b in raw:
        gone = cover(len(b), [i for i in range(len(b) - 199) if seen[b[i:i + 200]] > 1], 200)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        want.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    out = suffix_dedup.remove_repeats(docs.select("doc_id", "text"))
    got = [(r.did, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in out.collect()]
    assert sum(w[2] for w in want) > 1000
    assert sorted(got) == sorted(want)


def test_recompression_matches_brute_force(rows, docs):
    words = [(r[0], (r[1] or "").encode().split()) for r in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - 12):
            k = tuple(w[i:i + 13])
            first[k] = min(first.get(k, d), d)
    want = []
    for d, w in words:
        gone = cover(len(w), [i for i in range(len(w) - 12) if first[tuple(w[i:i + 13])] < d], 13)
        want.append((d, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    got = [(r.doc_id, r.n_words, r.n_removed, sha(bytes(r.kept))) for r in recompression.dedup_words(docs).collect()]
    assert sum(w[2] for w in want) > 100
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("seed", range(4))
def test_equal_windows_are_filed_alike(seed):
    """Interior symbols depend on nothing outside a window, also in runs and at text edges."""
    rng = np.random.default_rng(seed)
    for _ in range(100):
        k, width = int(rng.integers(2, 5)), int(rng.integers(3, 14))
        names = mix64(rng.integers(1, 1 << 62, k).astype(np.uint64))
        seqs = [rng.integers(0, k, n) for n in rng.integers(0, 60, 4)]
        seqs.append(np.concatenate([seqs[0][3:30], seqs[1][2:40]]))
        flat, doc = np.concatenate(seqs), np.repeat(np.arange(5), [len(s) for s in seqs])
        if len(flat) < width:
            continue
        filed = recompression.file_windows(names[flat], doc, width)
        seen = {}
        for p in range(len(flat) - width + 1):
            if doc[p] == doc[p + width - 1]:
                assert seen.setdefault(tuple(flat[p:p + width]), filed[p]) == filed[p]


def jaccard_brute_force(pairs, ngram=4, share=85):
    """[(doc_id, text)] -> sorted [(doc_id, size, component)]; every row is a node."""
    sets = []
    for _, t in pairs:
        w = (t or "").encode().translate(LOWER).split()
        sets.append(frozenset(tuple(w[i:i + ngram]) for i in range(max(1, len(w) - ngram + 1))) if w else frozenset())
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= share * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(pairs))


def near_copies(n=40):
    rng = np.random.default_rng(3)
    base = [f"b{i}" for i in range(120)]
    out = []
    for i in range(n):
        w = list(base)
        for k in rng.integers(0, len(w), i % 7):
            w[k] = f"e{i}x{k}"
        out.append((1000 + i, " ".join(w)))
    return out


def test_jaccard_join_matches_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    monkeypatch.setattr(jaccard_join, "BUCKET_SHINGLES", 600)  # hot groups are met in pairs of blocks
    pairs = [(r[0], r[1]) for r in rows] + near_copies()
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(df).collect())
    want = jaccard_brute_force(pairs)
    assert len({w[2] for w in want}) < len(want) - 20
    assert got == want


def test_trie_finds_exactly_the_links():
    rng = np.random.default_rng(5)
    for _ in range(60):
        base = rng.choice(200, 60, replace=False)
        sets = []
        for _ in range(12):
            s = set(base.tolist())
            for x in rng.integers(0, 300, rng.integers(0, 8)):
                s ^= {int(x)}
            sets.append(np.unique(np.array(sorted(s), dtype=np.uint64)))
        link = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 85 * len(np.union1d(a, b))
        found = jaccard_join.trie_links(sets)
        assert all(link(sets[a], sets[b]) for a, b in found)
        pairs = [(a, b) for a in range(12) for b in range(a) if link(sets[a], sets[b])]
        roots = lambda e: jaccard_join._roots(12, np.array([x for x, _ in e], int), np.array([y for _, y in e], int)).tolist()
        assert roots(found) == roots(pairs)
        own = np.array([0] * 6 + [1] * 6)
        cross = [p for p in pairs if own[p[0]] != own[p[1]]]
        assert roots(jaccard_join.trie_links(sets, own)) == roots(cross)


def test_parity_bitmaps_never_hide_a_link():
    rng = np.random.default_rng(9)
    sets, size = [], []
    for _ in range(60):
        base = mix64(np.arange(rng.integers(1, 900), dtype=np.uint64))
        sets.append(np.unique(np.concatenate([base[rng.random(len(base)) > 0.04], mix64(rng.integers(1 << 40, 1 << 50, 9).astype(np.uint64))])))
        size.append(len(sets[-1]))
    a, b = map(np.array, zip(*[(i, j) for i in range(60) for j in range(i)]))
    ok = jaccard_join._bits_bound([jaccard_join.parity_bits(s) for s in sets], np.array(size), a, b)
    for i, j, o in zip(a, b, ok):
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j])):
            assert o


def test_stages_keep_columns_and_clean_documents(spark, unique_docs):
    out = jaccard_join.dedup_stage(spark, unique_docs, "")
    assert out.columns == unique_docs.columns
    kept = {r.doc_id for r in out.collect()}
    want = {c for _, n, c in jaccard_brute_force([(r.doc_id, r.text) for r in unique_docs.collect()], 5, 80)}
    assert kept == want
    cut = suffix_dedup.dedup_stage(spark, unique_docs, "")
    assert cut.columns == unique_docs.columns and cut.schema["n_chars"].dataType == unique_docs.schema["n_chars"].dataType
    before, after = ({r.doc_id: r for r in d.collect()} for d in (unique_docs, cut))
    assert before.keys() == after.keys()
    removed = {r.did: r.n_removed for r in suffix_dedup.remove_repeats(unique_docs.select("doc_id", "text")).collect()}
    for k, r in after.items():
        if not removed[k]:
            assert r == before[k]
        else:
            assert len(r.text) < len(before[k].text) and r.n_chars == len(r.text)


def test_empty_tables_and_null_ids(spark, no_docs):
    assert jaccard_join.jaccard_components(no_docs).count() == 0
    assert recompression.dedup_words(no_docs).count() == 0
    assert suffix_dedup.remove_repeats(no_docs).count() == 0
    t = " ".join(f"n{i}" for i in range(50))
    df = spark.createDataFrame([(None, t), (None, t), (3, t), (None, None)], "doc_id long, text string")
    assert sorted(jaccard_join.jaccard_components(df).collect(), key=str) == sorted(
        [(None, 47, 3), (None, 47, 3), (3, 47, 3), (None, 0, None)], key=str)
    assert sorted((r.doc_id or -1, r.n_removed) for r in recompression.dedup_words(df).collect()) == [(-1, 0), (-1, 0), (-1, 0), (3, 50)]
    assert F is not None


def test_texts_that_share_a_short_key_are_told_apart(spark, monkeypatch):
    """Null and repeated doc_ids with distinct texts: the key's hash is salted until no two texts share it."""
    from playmart.llm import repeats
    monkeypatch.setattr(repeats, "KEY_BITS", 4)
    word = lambda k, n: " ".join(f"{k}x{i}" for i in range(n))
    texts = [word("a", 90), word("b", 90), word("c", 90), word("a", 90) + " " + word("d", 40), None]
    df = spark.createDataFrame([(d, t, "th", 1) for d in (None, 5) for t in texts], "doc_id long, text string, th string, did int")
    key = repeats.document_key(df)
    assert df.select(key["did"].alias("d"), key["th"].alias("t")).distinct().count() == 10
    once = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string")
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i:i + 200] for b in raw for i in range(len(b) - 199))
    want = [sum(cover(len(b), [i for i in range(len(b) - 199) if seen[b[i:i + 200]] > 1], 200)) for b in raw]
    assert sorted(r.n_removed for r in suffix_dedup.remove_repeats(once).collect()) == sorted(want) and sum(want) > 0
    kept = jaccard_join.dedup_stage(spark, df, "")
    assert kept.columns == df.columns
    assert sorted((r.text or "") for r in kept.collect()) == sorted([*(t for t in texts if t), "", ""])
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in recompression.dedup_words(df).collect())
    n = lambda t: len((t or "").split())
    assert got == sorted([(-1, n(t), 0) for t in texts] + [(5, n(t), n(t)) for t in texts])


def test_keys_are_unique_among_many_texts_without_ids(spark):
    from playmart.llm import repeats
    df = spark.range(300_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    key = repeats.document_key(df)
    assert df.select(key["did"].alias("d"), key["th"].alias("t")).distinct().count() == 300_000
