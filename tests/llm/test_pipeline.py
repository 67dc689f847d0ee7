"""The pipeline and the style tree against plain-Python versions that share no code with them."""

from __future__ import annotations

import collections
import hashlib
import math
import re
from html.parser import HTMLParser

import numpy as np
import tiktoken

import __spark_entry__ as entry
from playmart.llm import bpe, html_extraction

SPACE = " \t\n\x0b\x0c\r"


def words(text):
    return [w for w in re.split(f"[{SPACE}]+", text) if w]


# ---- 1: quality rules -----------------------------------------------------------------------------

def features(text):
    """[(0/1 features, words)] of the lines with words."""
    out, before = [], set()
    for line in text.split("\n"):
        w, again = words(line), line in before
        before.add(line)
        n = len(w)
        if not n:
            continue
        count = lambda f: sum(map(f, line))  # noqa: E731, B023
        symbols, digits, letters = count(lambda c: c in "#*$%&|<>"), count(lambda c: c in "0123456789"), count(str.isalpha)
        upper, cased = count(str.isupper), count(lambda c: c.isupper() or c.islower())
        chars, kinds = sum(map(len, w)), len(set(w))
        out.append(([1, symbols > 0, symbols >= 0.3 * n, cased > 0 and upper >= 0.5 * cased, cased > 0 and upper >= 0.9 * cased,
                     n > 3 and kinds < 0.5 * n, n > 3 and kinds < 0.2 * n, line.count("|") >= 0.2 * n, line.count("!") >= 0.3 * n,
                     digits >= 0.3 * chars, again, n < 4, n >= 12, letters < 0.5 * chars], n))
    return out


def forward(e, trans):
    f = [e[0]]
    for x in e[1:]:
        f.append([x[j] + np.logaddexp(f[-1][0] + trans[0][j], f[-1][1] + trans[1][j]) for j in (0, 1)])
    return f


def train(docs):
    """[(features, label)] -> weights and transitions: ascent on the mean likelihood of both classes, document by document."""
    docs = [(np.array([f for f, _ in x], float), y) for x, y in docs if x]
    share = {y: 0.5 / sum(1 for _, z in docs if z == y) for y in (0, 1)}
    w, trans, m, v = np.zeros(14), np.zeros((2, 2)), np.zeros(18), np.zeros(18)
    for step in range(1, 151):
        gw, gt = -1e-3 * w, -1e-3 * trans
        for x, y in docs:
            e = [(s / 2, -s / 2) for s in (x @ w).tolist()]
            t = trans.tolist()
            fwd = forward(e, t)
            bwd = forward(e[::-1], trans.T.tolist())[::-1]  # holds e of its own line too
            z = np.logaddexp(*fwd[-1])
            p = share[y] / len(x)
            gw = gw + p * sum(((y == 0) - math.exp(f[0] + b[0] - q[0] - z)) * row for row, f, b, q in zip(x, fwd, bwd, e))
            for f, b in zip(fwd, bwd[1:]):
                gt = gt - p * np.array([[math.exp(f[i] + t[i][j] + b[j] - z) for j in (0, 1)] for i in (0, 1)])
            gt[y, y] += p * (len(x) - 1)
        g = np.concatenate([gw, gt.ravel()])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x = np.concatenate([w, trans.ravel()]) + 0.3 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        w, trans = x[:14], x[14:].reshape(2, 2)
    return w, trans


def good(text, model):
    w = words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = collections.Counter(grams)
    repeated = {k for i, g in enumerate(grams) if times[g] > 1 for k in range(i, i + 3)}
    if len(w) < 50 or 100 * len(repeated) > 50 * len(w):
        return False
    best = None
    for f, _ in features(text):
        s = float(np.dot(f, model[0])) / 2
        e = (s, -s)
        best = [(e[j], [j]) for j in (0, 1)] if best is None else [
            max(((best[i][0] + model[1][i][j] + e[j], [*best[i][1], j]) for i in (0, 1)), key=lambda c: c[0]) for j in (0, 1)]
    path = max(best, key=lambda c: c[0])[1]
    sizes = [n for _, n in features(text)]
    return sum(n for n, y in zip(sizes, path) if y == 0) >= 0.5 * sum(sizes)


# ---- 8, 5, 2: the other stages -----------------------------------------------------------------------

def one_of_each_group(docs):
    sets = {}
    for d, t, _ in docs:
        w = [x.encode().lower() for x in words(t)]  # bytes.lower: ASCII letters only
        sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    group = {d: d for d in sets}
    for a in sets:
        for b in sets:
            if a < b and group[a] != group[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                old, new = group[b], group[a]
                group = {d: new if g == old else g for d, g in group.items()}
    least = {g: min(d for d in group if group[d] == g) for g in group.values()}
    return [r for r in docs if r[0] in least.values()]


def without_repeats(docs):
    raw = [t.encode() for _, t, _ in docs]
    seen = collections.Counter(b[i:i + 200] for b in raw for i in range(len(b) - 199))
    out = []
    for (d, t, s), b in zip(docs, raw):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i:i + 200] = True
        out.append((d, bytes(x for x, g in zip(b, gone) if not g).decode("utf-8", "ignore"), s))
    return out


def mixed(docs):
    size = {d: len(words(t)) for d, t, _ in docs}
    total = collections.Counter()
    for d, _, s in docs:
        total[s] += size[d]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(total))}
    target, left = {}, set(total)
    while True:
        level = (1.5 * sum(total.values()) - sum(target.values())) / max(1, sum(weight[s] for s in left))
        over = {s for s in left if level * weight[s] > 2 * total[s]}
        if not over:
            break
        target |= {s: 2.0 * total[s] for s in over}
        left -= over
    target |= {s: level * weight[s] for s in left}
    u = {d: [int(hashlib.sha256(f"mix:{d}".encode()).hexdigest()[8 * k:8 * k + 8], 16) / 2 ** 32 for k in range(8)] for d in size}
    out = []
    for s in total:
        rate = target[s] / total[s] if total[s] else 0.0
        own = [r for r in docs if r[2] == s]
        taken = lambda k: [math.floor(rate) + (u[r[0]][k] < rate % 1) for r in own]  # noqa: E731, B023
        k = min(range(8), key=lambda k: (abs(sum(c * size[r[0]] for c, r in zip(taken(k), own)) - target[s]), k))  # noqa: B023
        out += [r for c, r in zip(taken(k), own) for _ in range(c)]
    return out


def test_pipeline_matches_plain_python(spark, sf_dir):
    rows = [(r.doc_id, r.text or "", r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    model = train([(features(t), 1 - label[d]) for d, t, _ in rows if d in label])
    kept = [r for r in rows if good(r[1], model)]
    final = mixed(without_repeats(one_of_each_group(kept)))
    assert len(rows) > len(kept) > len(one_of_each_group(kept)) > 40
    encoding: tiktoken.Encoding = bpe.Codec.of(bpe.ranks_path()).encoding
    want = []
    for d, t, _ in final:
        ids = encoding.encode_ordinary(t)
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in entry.queries()["pipeline"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(want)


# ---- 10 -------------------------------------------------------------------------------------------

class Blocks(HTMLParser):
    """[(element path, text)] of a page whose only unclosed elements are p, b and br."""

    def __init__(self, page):
        super().__init__()
        self.path, self.text, self.blocks = [], "", []
        self.feed(page)
        self.cut()

    def cut(self):
        if t := " ".join(self.text.split()):
            if not {"script", "style", "title"} & set(self.path):
                self.blocks.append(("/".join(self.path), t))
        self.text = ""

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text += " "
        elif tag not in ("meta", "b", "a"):
            self.cut()
            if tag == "p" and self.path and self.path[-1] == "p":
                self.path.pop()
            self.path.append(".".join([tag, *(v for _, v in attrs if _ in ("class", "id"))]))

    def handle_endtag(self, tag):
        names = [p.split(".")[0] for p in self.path]
        if tag in names:
            self.cut()
            del self.path[len(names) - 1 - names[::-1].index(tag):]

    def handle_data(self, data):
        self.text += data


def plain_texts(pages):
    """{page_id: text} by the definitions: entropy over pages of each text, page by page."""
    hosts = collections.defaultdict(dict)
    for i, url, page in pages:
        hosts[url.split("//")[1].split("/")[0].split("#")[0].split("?")[0].split(":")[0].lower()][i] = Blocks(page).blocks
    out = {}
    for own in hosts.values():
        noise = lambda p: bool({"nav", "footer", "div.ad"} & set(p.split("/")))
        paths = {p for b in own.values() for p, _ in b if not noise(p)}
        value = {}
        for p in paths:
            having = [{t for q, t in b if q == p} for b in own.values()]
            m = sum(map(bool, having))  # here every page with the element has text in it
            times = collections.Counter(t for h in having for t in h)
            spread = [-sum(1 / n * math.log(1 / n, m) for _ in range(n)) if m > 1 else 0 for n in times.values()]
            c = 1 - sum(spread) / len(spread) if m >= 4 else 1
            value[p] = (c, (m * c + 1) / (m + 1) if "article" in p.split("/") else c)
        low = {p for p, (_, v) in value.items() if v < 0.2 and max(
            c for q, (c, _) in value.items() if "article" not in p.split("/") or "article" in q.split("/")) >= 0.2}
        for i, b in own.items():
            out[i] = "\n".join(t for p, t in b if not noise(p) and p not in low)
    return out


def test_style_tree_matches_plain_python(spark, sf_dir):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    got = [(r.page_id, r.url, r.text, r.n_chars) for r in entry.queries()["op10_site_style_tree"](spark, sf_dir).collect()]
    want = plain_texts(pages)
    assert sorted(got) == sorted((i, u, want[i], len(want[i])) for i, u, _ in pages)


def test_style_tree_of_planted_pages_matches_plain_python(spark):
    body = lambda i: (f"<nav><ul><li>Menu {i}</li></ul></nav><div class='ad'>Buy</div><div class='top'>Call us</div>"  # noqa: E731
                      f"<article><h1>{'Same' if i % 3 else i}</h1><div class='box'><p>Follow us</p></div><p>Story {i % 9}</p></article>"
                      f"<div class='more'><p>{i % 2}</p></div><footer>Foot</footer>")
    pages = [(i, f"http://{'abc'[i % 3]}.example/{i}", f"<html><body>{body(i)}</body></html>") for i in range(40)]
    pages += [(100 + i, "http://copies.example/x", f"<html><body>{body(1)}</body></html>") for i in range(6)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_extraction.extract(df, ["page_id"]).collect()}
    assert got == plain_texts(pages)
    assert not any("Call us" in got[i] or "Follow us" in got[i] for i in range(40)) and "Story 1" in got[100]


def test_stages_bound_the_bytes_of_a_batch(spark, sf):
    """A file of many rows is not handed to a Python task as one batch of all its texts."""
    from pyspark.sql import functions as F
    from playmart.llm import jaccard_join, quality
    from playmart.llm.common import BATCH_BYTES, BATCH_KEY

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    long_texts = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("abcd "), 1000).alias("text"))
    for stage in (quality.filter_quality, jaccard_join.dedup_stage):
        spark.conf.unset(BATCH_KEY)
        stage(spark, docs, sf)
        got = long_texts.mapInArrow(sizes, "n long, bytes long").collect()
        assert sum(r.n for r in got) == 4000 and max(r.bytes for r in got) < 2 * BATCH_BYTES


def test_style_tree_bounds_the_bytes_of_a_batch(spark, tmp_path):
    """A file of many pages is not handed to a Python task as one batch of all its html."""
    from pyspark.sql import functions as F
    from playmart.llm.common import BATCH_BYTES, BATCH_KEY

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    pages = spark.range(0, 4000, 1, 1).select(
        F.col("id").alias("page_id"), F.lit("http://h.example/").alias("url"), F.repeat(F.lit("<p>a"), 1000).alias("html"))
    pages.limit(1).write.parquet(f"{tmp_path}/pages.parquet")
    spark.conf.unset(BATCH_KEY)
    assert [r.n_chars for r in entry.queries()["op10_site_style_tree"](spark, str(tmp_path)).collect()] == [1999]
    got = pages.select("url", "html").mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in got) == 4000 and max(r.bytes for r in got) < 2 * BATCH_BYTES


def test_site_model_is_stored_in_few_files(spark, monkeypatch):
    """Many hosts dealt over many shuffle partitions do not make a file each; no host and no page is lost."""
    stored, folders = html_extraction.stored, []

    def seen(df, name):
        folders.append(stored(df, name))
        return folders[-1]

    monkeypatch.setattr(html_extraction, "stored", seen)
    pages = [(i, f"http://h{i % 40}.example/{i}", f"<div class=box><p>Call us now</p></div><article><p>Story {i}</p></article>")
             for i in range(240)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = {r.page_id: r.text for r in html_extraction.extract(df, ["page_id"]).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: f"Story {i}" for i in range(240)}
    assert folders[0].count() == 40 and len(folders[0].inputFiles()) <= 4
