"""Main text of web pages by a site style tree (operator 10).

The DOMs of all pages of a host are merged into one tree, with every element: a node is an element
path (tags with their class and id names), its styles are the child sequences seen there, its content
are the texts seen there. Over the m pages that have the node, the entropy (base m) of its styles is
its presentation importance, and one minus the mean entropy of how its texts spread over pages is its
content importance: what every page repeats in the same form carries no information. Importances are
combined bottom up (the deeper the subtree, the more the children count); a branch goes if it and all
that is in it are below ``LOW``, and so do an element's own texts if their content importance is, so what
holds a text decides on it and what is important keeps the branches around it. The statistics are aggregated by
Spark per (host, path, value), so a host with a third of all pages is pre-aggregated in the map tasks.

Tags, roles, classes and ids that name a function are a prior on the importance. Inside article, main
and the like, importance 1 counts as ``MAIN_PAGES`` more pages. What menus, footers, adverts, forms and so on
hold is weighed by how much of a page they are: an element named so counts ``NOISE_WEIGHT`` and, for the
rest, the cube of the share of the page's text that it holds outside links, text of main elements elsewhere
weighing ``MAIN_WEIGHT`` times. Its importance is the measured one times the mean of that weight over its pages, so a
"sidebar" that is the page stays, and a menu that links elsewhere on every page goes, which no entropy
tells from an article (README, "Where the method met the limits"). Where all texts of a main element, or
outside of these of the page, are below ``LOW``, the pages are copies of each other: the parts are not judged,
so an article that a host prints on several pages stays. Text outside main elements is main text too where no
name and no importance speaks against it.

A name is a whole class, id, role or itemprop ("has-sidebar" is no sidebar) of a block element: inline
elements of any name, formulas and drawings with text belong to the block around them.

Defined results: null html reads as empty and gives an empty text; null or odd urls share the host
""; hosts with fewer than ``MIN_PAGES`` pages for a node give it importance 1; repeated pages count
as pages. Unclosed and stray tags are tolerated; as browsers do, a page that ends inside a tag, a comment
or a script loses what that tag or comment holds. Pages are read in one pass, in time linear in their length.
"""

from __future__ import annotations

import hashlib
import html as _html
import math
import re
from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from playmart.sources.tables import read_table

from .common import bound_batches, shuffle_partitions, stored

#: Shuffle partitions to a file of the site model, whose rows are few and short.
MODEL_PARTITIONS = 16

LOW = 0.2
DEPTH_WEIGHT = 0.9
MIN_PAGES = 4
NOISE_WEIGHT = 0.1
MAIN_PAGES = 1
MAIN_WEIGHT = 20
MAX_DEPTH = 256
#: Stand at the end of a path: the texts that an element holds itself; an element kept against its name.
OWN, KEPT = "#", "+"

#: Fixed values of HTML: elements without content, elements whose content is never shown as text, inline elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes template select datalist canvas audio video".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark object q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr img math mi mo mn ms mtext mspace mrow msup msub msubsup "
                   "mfrac msqrt mroot mover munder munderover mstyle mpadded mphantom menclose mmultiscripts mtable mtr mtd "
                   "semantics svg g text tspan path rect circle ellipse line polyline polygon defs use symbol".split())
#: An opening tag closes the nearest open element of these names, up to the boundary names.
CLOSES = {"p": ({"p"}, {"table", "td", "th", "article", "section", "div", "li", "blockquote"}),
          "li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
CLOSE_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main "
                    "menu nav ol pre section table ul".split())
#: Tags and names that state a function; a name is a whole class, id, role or itemprop without digits, - and _.
NOISE_TAGS = frozenset("nav footer aside form button menu dialog fieldset".split())
NOISE_NAMES = frozenset("nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside ad ads advert adverts advertisement "
                        "advertising sponsor sponsored promo promotion cookie cookies consent popup modal newsletter subscribe "
                        "subscription social share sharing related recommended comment comments disqus respond reply replies login "
                        "signup search widget toolbar pagination pager copyright disclaimer gdpr skip complementary contentinfo "
                        "form dialog alertdialog sitenav mainnav sitefooter pagefooter cookiebanner cookienotice cookieconsent "
                        "socialshare sharebuttons relatedposts commentlist searchform".split())
NOISE_OUTSIDE = frozenset("header siteheader pageheader masthead banner notice notices alert topbar hero".split())
MAIN_TAGS = frozenset(("article", "main"))
MAIN_NAMES = frozenset("article articlebody main".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
#: One attribute or the end of the tag; no part of it can be matched in two ways.
_ATTRIBUTE = re.compile(r"""[\s/]*+(?:(>)|([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)(?:"|\Z)|'([^']*+)(?:'|\Z)|([^\s>]*+)))?+)""")
_NAMING = frozenset(("class", "id", "role", "itemprop"))
_FILL = re.compile(r"[\d_-]+")


class Node:
    __slots__ = ("tag", "label", "named", "role", "path", "children", "size", "linked", "main", "weight")

    def __init__(self, tag, label, named):
        self.tag, self.label, self.named, self.role, self.path = tag, label, named, "", ""
        self.children: list = []  # Node, or (text, characters in links) for a text block
        self.size = self.linked = self.main = 0  # characters below: all, in links, in main elements outside links
        self.weight = 1.0  # of an element named as noise


def _named(tag: str, names: set[str]) -> str:
    """What tag and names state: 'noise', 'outside' (noise unless within a main element), 'main' or ''."""
    if tag in ("html", "body"):
        return ""
    if tag in NOISE_TAGS or names & NOISE_NAMES:
        return "noise"
    main = tag in MAIN_TAGS or names & MAIN_NAMES
    if tag == "header" or names & NOISE_OUTSIDE:
        return "outside main" if main else "outside"
    return "main" if main else ""


def _settle(root: Node) -> None:
    """Roles, paths and weights: 'noise' for elements named so (what they hold has roles of its own), 'main', or ''."""
    order = list(elements(root))
    for node in (*reversed(order), root):
        for c in node.children:
            if isinstance(c, Node):
                node.size += c.size
                node.linked += c.linked
                node.main += c.main
            else:
                node.size += len(c[0])
                node.linked += c[1]
        if node.named.endswith("main"):
            node.main = node.size - node.linked
    for node in (root, *order):
        paths: dict[str, str] = {}
        for c in node.children:
            if not isinstance(c, Node):
                continue
            main = node.role == "main" or c.named.endswith("main")
            if c.named == "noise" or c.named.startswith("outside") and node.role != "main":
                c.role = "noise"
                own = c.size - c.linked
                whole = root.size + (MAIN_WEIGHT - 1) * (root.main - c.main)
                c.weight = NOISE_WEIGHT + (1 - NOISE_WEIGHT) * (own / whole if own else 0.0) ** 3
            elif main:
                c.role = "main"
            c.path = paths.get(c.label) or paths.setdefault(c.label, f"{node.path}/{c.label}")


def tokens(page: str) -> Iterator[tuple[str, str, list]]:
    """(kind, value, names): ('text', text, []), ('open', tag, names of class, id, role and itemprop), ('close', tag, []).

    One pass: every search either ends behind what it has read or ends the page.
    """
    at, end = 0, len(page)
    unclosed: set[str] = set()  # raw elements that nothing further down closes
    while at < end:
        i = page.find("<", at)
        if i < 0:
            yield "text", page[at:], []
            return
        if i > at:
            yield "text", page[at:i], []
        m = _TAG.match(page, i)
        if not m:
            stop = ">"
            if page.startswith("<!--", i):
                at, stop = i + 4, "-->"
                if page.startswith((">", "->"), at):
                    at, stop = i + 2, ">"
            elif page.startswith("<![CDATA[", i):
                at, stop = i + 9, "]]>"
            elif page.startswith(("<!", "<?", "</"), i):
                at = i + 2
            else:
                yield "text", "<", []
                at = i + 1
                continue
            at = page.find(stop, at)
            if at < 0:
                return
            at += len(stop)
            continue
        at, names = m.end(), []
        while (a := _ATTRIBUTE.match(page, at)) and not a[1]:
            at = a.end()
            if a[2].lower() in _NAMING:
                names.append(a[3] or a[4] or a[5] or "")
        if not a:  # the page ends inside the tag
            return
        at = a.end()
        tag = m[2].lower()
        if m[1]:
            yield "close", tag, []
            continue
        yield "open", tag, names
        if tag == "xmp" or tag in RAW and tag not in unclosed:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(page, at)
            if tag == "xmp":
                yield "text", _html.escape(page[at:close.start() if close else end]), []
                at = close.end() if close else end
                yield "close", tag, []
            elif close:
                at = close.end()
            elif tag in ("script", "style", "title", "textarea"):
                return
            else:
                unclosed.add(tag)


def parse(page: str) -> Node:
    """A tolerant DOM: elements with paths, roles and weights; inline markup is folded into text blocks."""
    root = Node("", "", "")
    stack = [root]
    open_tags: dict[str, int] = defaultdict(int)  # so that a tag that is not open costs no search
    text: list[str] = []
    linked = [0, 0]
    anchor = 0

    def flush():
        if text:
            block = " ".join(_html.unescape("".join(text)).split())
            text.clear()
            if block:
                stack[-1].children.append((block, len(block) * linked[0] // max(linked[1], 1)))
        linked[0] = linked[1] = 0

    def pop_to(names, bounds=()):
        if not any(open_tags[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                flush()
                for n in stack[i:]:
                    open_tags[n.tag] -= 1
                del stack[i:]
                return
            if stack[i].tag in bounds:
                return

    for kind, value, names in tokens(page):
        if kind == "text":
            text.append(value)
            n = len(value.strip())
            linked[1] += n
            if anchor:
                linked[0] += n
        elif kind == "close":
            if value == "a":
                anchor = max(0, anchor - 1)
            elif value not in INLINE:
                pop_to({value})
        elif value in INLINE:
            anchor += value == "a"
        elif value in RAW:
            flush()
        elif value == "br":
            text.append(" ")
        else:
            if value in CLOSE_P:
                pop_to({"p"}, CLOSES["p"][1])
            if value in CLOSES:
                pop_to(*CLOSES[value])
            flush()
            if value in VOID:
                continue
            anchor = 0
            words = {_FILL.sub("", x) for v in names for x in v.lower().split()}
            label = value + "".join("." + re.sub(r"[\d/]+", "", v.lower()) for v in names)
            node = Node(value, label, _named(value, words))
            stack[min(len(stack), MAX_DEPTH) - 1].children.append(node)  # as browsers do: deeper ones become neighbours
            stack.append(node)
            open_tags[value] += 1
    flush()
    _settle(root)
    return root


def elements(root: Node) -> Iterator[Node]:
    """All elements, parents first."""
    todo = [root]
    while todo:
        node = todo.pop()
        if node is not root:
            yield node
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))


def texts_of(node: Node) -> list[str]:
    return [c[0] for c in node.children if not isinstance(c, Node)]


def style_of(node: Node) -> str:
    return "|".join(c.label if isinstance(c, Node) else "#" for c in node.children)


def main_text(root: Node, low: frozenset = frozenset()) -> str:
    """Blocks of all branches that are not low. An element named as noise on too few pages to be judged by
    its host (neither low nor kept) has importance 1 times its own weight."""
    blocks: list[str] = []
    todo: list = [(root, root)]
    while todo:
        c, parent = todo.pop()
        if not isinstance(c, Node):
            if f"{parent.path}/{OWN}" not in low:
                blocks.append(c[0])
        elif c.path not in low and (c.role != "noise" or c.weight >= LOW or f"{c.path}/{KEPT}" in low):
            todo.extend((x, c) for x in reversed(c.children))
    return "\n".join(blocks)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1), F.lit("")))


def digest(value: str) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _nodes(batches):
    """(host, path, role, kind, value, full, weight) once per page: kind 0 a style, kind 1 a text of an element, both as
    digests; full if there is text in the element or below."""
    import pyarrow as pa
    types = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.bool_(), pa.float64())
    for b in batches:
        out = []
        for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            seen: dict = {}
            for n in elements(parse(page or "")):
                for key, full in (((0, digest(style_of(n))), n.size > 0), *(((1, digest(t)), True) for t in texts_of(n))):
                    f, w = seen.get((n.path, n.role, *key), (False, 0.0))
                    seen[n.path, n.role, *key] = f or full, max(w, n.weight)
            out.extend((host, *k, *v) for k, v in seen.items())
        cols = list(zip(*out)) or [[]] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                         ["host", "path", "role", "kind", "value", "full", "weight"])


def style_tree(pages: DataFrame) -> DataFrame:
    """One row per (host, path): role, pages, presentation importance, content importance (null: no text
    of its own), full (text in it or below), weight (mean over pages; 1 for what is not named as noise)."""
    counted = (pages.mapInArrow(_nodes, "host string, path string, role string, kind int, value long, full boolean, weight double")
               .groupBy("host", "path", "role", "kind", "value")
               .agg(F.count("*").alias("n"), F.max("full").alias("full"), F.sum("weight").alias("weight")))
    node = (counted.groupBy("host", "path", "role")
            .agg(F.max("full").alias("full"), F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("m"),
                 F.sum(F.when(F.col("kind") == 0, F.col("weight"))).alias("weight"),
                 F.sum(F.when(F.col("kind") == 0, F.col("n") * F.log("n"))).alias("s"),
                 F.sum(F.when(F.col("kind") == 1, F.log("n"))).alias("t"),
                 F.sum(F.when(F.col("kind") == 1, 1)).alias("texts")))
    # styles: -sum p log p = log m - sum n log n / m; a text on n pages spreads with entropy log n
    few = F.col("m") < MIN_PAGES
    return node.select(
        "host", "path", "role", "m", "full",
        F.when(few, 1.0).otherwise(1 - F.col("s") / (F.col("m") * F.log("m"))).alias("presentation"),
        F.when(few & F.col("texts").isNotNull(), 1.0).otherwise(1 - F.col("t") / (F.col("texts") * F.log("m"))).alias("content"),
        F.round(F.col("weight") / F.col("m"), 9).alias("weight"))


def frequent(tree: DataFrame) -> DataFrame:
    """The nodes on ``MIN_PAGES`` pages and more, with ``rare``, the weight of the other nodes right under each,
    and ``clear``, whether one of these is no noise.

    A node on fewer pages has importance 1, and so has all below it, so its weight is all that its
    parent needs; paths that only a few pages have (a slug in an id) are never gathered by host.
    """
    own = F.col("m") >= MIN_PAGES
    weight = F.col("weight") * F.col("m")
    return (tree.groupBy("host", F.when(own, F.col("path")).otherwise(F.regexp_replace("path", "/[^/]*$", "")).alias("_at"))
            .agg(F.max(F.when(own, F.struct("path", "role", "m", "presentation", "content", "weight"))).alias("node"),
                 F.sum(F.when(~own & F.col("full"), weight).otherwise(0.0)).alias("rare"),
                 F.max(~own & F.col("full") & (F.col("weight") >= LOW)).alias("clear"))
            .where("node is not null or _at = ''").select("host", "node", "rare", "clear"))


def low_branches(nodes: list[tuple], rare: dict[str, tuple[float, bool]] | None = None) -> list[str]:
    """Paths of a host's tree below LOW together with all that is in them; ``path/OWN`` stands for an element's own texts,
    ``path/KEPT`` for an element kept against its name.

    ``nodes``: (path, role, pages, presentation importance, content importance or None, weight). ``rare``: by path the
    weight of nodes right under it that are not in ``nodes`` and have importance 1, and whether one of them stays.
    """
    rare = rare or {}
    own = {p: (role, m, pres, cont) for p, role, m, pres, cont, *_ in nodes}
    named = {n[0]: n[5] if len(n) > 5 else NOISE_WEIGHT for n in nodes if n[1] == "noise"}
    children = defaultdict(list)
    for p in own:
        children[p.rpartition("/")[0]].append(p)
    deep = sorted(own, key=lambda x: -x.count("/"))
    weight: dict[str, float] = {}  # none for what holds no text
    score: dict[str, float] = {}
    for p in deep:
        role, m, pres, cont = own[p]
        weight[p] = m * named.get(p, 1.0) * (cont is not None or p in rare or any(weight[c] for c in children[p]))
        below = [(weight[c], score[c]) for c in children[p] if weight[c]] + ([(m, cont)] if cont is not None else [])
        if p in rare:
            below.append((rare[p][0], 1.0))
        if not below:
            score[p] = pres
            continue
        g = DEPTH_WEIGHT if children[p] or p in rare else 1.0
        score[p] = (1 - g) * pres + g * sum(w * s for w, s in below) / sum(w for w, _ in below)
    noise = {p for p, w in named.items() if score[p] * w < LOW}

    def importance(role: str, m: int, measured: float) -> float:
        return (m * measured + MAIN_PAGES) / (m + MAIN_PAGES) if role == "main" else measured

    # parts are judged where some text of their whole (the outermost main element, or the page) differs between pages
    best: dict[str, float] = {}
    for p in (*deep, ""):
        found = [best[c] for c in children[p] if c not in noise]
        best[p] = max([0.0, *found, float(p in rare and rare[p][1]), own[p][3] or 0.0 if p in own else 0.0])
    judged: dict[str, bool] = {}
    for p in reversed(deep):
        parent = p.rpartition("/")[0]
        first = own[p][0] == "main" and (parent not in own or own[parent][0] != "main")
        judged[p] = best[p] >= LOW if first else judged.get(parent, best[""] >= LOW)
    own_low: dict[str, bool] = {}
    all_low: dict[str, bool] = {}
    for p in deep:
        role, m, _, cont = own[p]
        own_low[p] = judged[p] and cont is not None and importance(role, m, cont) < LOW
        all_low[p] = p in noise or (judged[p] and importance(role, m, score[p]) < LOW and (cont is None or own_low[p])
                                    and p not in rare and all(all_low[c] for c in children[p]))
    out: set[str] = set()
    for p in reversed(deep):  # parents first: nothing is listed below a branch that goes
        if p.rpartition("/")[0] in out:
            out.add(p)
        elif all_low[p]:
            out.add(p)
        elif own_low[p]:
            out.add(f"{p}/{OWN}")
        if p in named and p not in out:
            out.add(f"{p}/{KEPT}")
    return sorted(x for x in out if x.rpartition("/")[0] not in out)


def _low(batches):
    import pyarrow as pa
    for b in batches:
        low = [low_branches([tuple(n["node"][k] for k in ("path", "role", "m", "presentation", "content", "weight")) for n in nodes if n["node"]],
                            {n["node"]["path"] if n["node"] else "": (n["rare"], n["clear"]) for n in nodes if n["rare"]})
               for nodes in b.column("nodes").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(low, pa.list_(pa.string()))], ["host", "low"])


def site_model(pages: DataFrame) -> DataFrame:
    """(host, low): the branches to remove, for hosts that have any."""
    return (frequent(style_tree(pages)).groupBy("host").agg(F.collect_list(F.struct("node", "rare", "clear")).alias("nodes"))
            .mapInArrow(_low, "host string, low array<string>").where(F.size("low") > 0))


def extract(pages: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the main text of ``html`` (columns url and html are read)."""
    from pyspark.sql.types import StringType, StructField, StructType
    hosted = pages.select(*(F.col(f"`{k}`") for k in keep), F.col("html").alias("_html"), host_of(F.col("url")).alias("_host"))
    bound_batches(pages.sparkSession)
    files = max(2, shuffle_partitions(pages.sparkSession) // MODEL_PARTITIONS)
    model = stored(site_model(pages.select(host_of(F.col("url")).alias("host"), "html")).repartition(files), "site-model")
    rows = hosted.join(model.select(F.col("host").alias("_host"), F.col("low").alias("_low")), "_host", "left") \
        .select(*(F.col(f"`{k}`") for k in keep), "_html", "_low")
    schema = StructType([*rows.schema.fields[:len(keep)], StructField("text", StringType())])

    def run(batches):
        import pyarrow as pa
        for b in batches:
            n = b.num_columns
            out = [main_text(parse(h or ""), frozenset(low or ()))
                   for h, low in zip(b.column(n - 2).to_pylist(), b.column(n - 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(n - 2)), pa.array(out, pa.string())],
                                             [*keep, "text"])
    return rows.mapInArrow(run, schema)


def op10_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    return (extract(pages, ["page_id", "url"])
            .select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars")))
