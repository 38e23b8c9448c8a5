"""Main text of web pages by a tree-structured graphical model over the DOM.

Each block element and each run of text is a binary node, content or not. Unary scores come from
features of the node (tag, words of its class and id, text length, link share, punctuation, what it
lies in); an edge score ties a node to its parent. Sum-product messages go up the tree and down
again and give each run's marginal. Scores are fitted by the exact likelihood of labelled pages:
gradients are expected less observed counts from the same messages.

Labelled pages are the built-in layouts below, in which ``data-main`` marks content, and a bounded
sample of the pages at hand whose own landmarks (article or main) say what is content: of those with
fewer than ``SAMPLE_CHARS`` characters the ``SAMPLE_PAGES`` with the smallest hashes, each once, whatever
the order of files and tasks. The fit is a classifier's fit and needs no more. Every page is then read whole in
the task that holds it; nothing is shuffled.

Defined results: null or empty html gives an empty text; so does a page without content. Broken
markup is read as browsers do where it matters here: implied end tags, raw text of scripts and
styles, end tags without an element in scope, a tag cut off by the end of the page is dropped. Very
long pages and deep nesting take time in proportion to their length. Other columns pass through.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.llm.common import text_of

SAMPLE_PAGES = 32
SAMPLE_CHARS = 1_000_000
KEEP = 0.5

# Element names of the HTML standard.
RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "xmp", "noscript", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
    "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt",
    "u", "var", "nobr", "img", "wbr", "br",
}
MATH = {
    "math", "mi", "mo", "mn", "ms", "mtext", "mspace", "mrow", "mfrac", "msqrt", "mroot", "mstyle", "merror", "mpadded", "mphantom",
    "mfenced", "menclose", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts", "mprescripts", "none", "mtable",
    "mtr", "mtd", "maction", "semantics", "annotation", "annotation-xml",
}
INLINE |= MATH
DROPPED = {"svg", "button", "select", "object", "audio", "video", "canvas", "datalist", "head", "option"}
IN_HEAD = {"base", "basefont", "bgsound", "link", "meta", "title", "noscript", "noframes", "style", "script", "template", "head"}
CLOSES_P = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "section",
    "table", "ul", "dialog", "summary", "center",
}
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}),
}

# What an end tag does not look beyond for its element ("has an element in scope").
SCOPE = {"caption", "table", "td", "th", "object", "select", "marquee", "applet"}
SCOPES = {name: {"table", "object", "select"} for name in ("table", "caption", "thead", "tbody", "tfoot", "tr", "td", "th")}
SCOPES |= {"li": SCOPE | {"ul", "ol"}, "p": SCOPE | {"button"}}

TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</[^>a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """Block elements and text runs in page order; parents come before children."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#root"])
    attrs: list[dict[str, str]] = field(default_factory=lambda: [{}])
    text: list[str | None] = field(default_factory=lambda: [None])
    linked: list[int] = field(default_factory=lambda: [0])
    strong: list[int] = field(default_factory=lambda: [0])


def _attributes(text: str) -> dict[str, str]:
    return {
        m[1].lower(): entities.unescape(m[2].strip("\"'")) if m[2] else "" for m in ATTRIBUTE.finditer(text)
    } if text.strip(" /\n") else {}


def parse(source: str) -> Page:
    page = Page()
    # Open elements: name, and the index of the block node that holds what is inside.
    stack: list[tuple[str, int]] = [("#root", 0)]
    places: dict[str, list[int]] = {}  # of the open elements of a name, so that none is searched for
    skip = 0  # place in the stack of the outermost dropped element; nothing in it makes a node
    parts: list[str] = []
    linked = strong = 0
    links = 0

    def flush() -> None:
        nonlocal linked, strong
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                page.parent.append(stack[-1][1])
                page.tag.append("#text")
                page.attrs.append({})
                page.text.append(text)
                page.linked.append(min(linked, len(text)))
                page.strong.append(min(strong, len(text)))
        linked = strong = 0

    def close(to: int) -> None:
        nonlocal links, skip
        seen = stack[to:skip] if skip else stack[to:]
        if any(name not in INLINE for name, _ in seen):
            flush()
        links -= sum(name == "a" for name, _ in seen)
        for name, _ in stack[to:]:
            places[name].pop()
        del stack[to:]
        if to <= skip:
            skip = 0

    def push(name: str, node: int) -> None:
        places.setdefault(name, []).append(len(stack))
        stack.append((name, node))

    def last(names: set[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    def innermost(names: set[str], stop: set[str]) -> int | None:
        found = last(names)
        return found if found and found >= last(stop) else None

    at, end = 0, len(source)
    while at < end:
        m = TAG.search(source, at)
        text = source[at : m.start() if m else end]
        if stack[-1][0] == "head" and text.strip():
            close(len(stack) - 1)
        if text and not skip:
            parts.append(text)
            if links:
                linked += len(text)
            elif stack[-1][0] in ("b", "strong"):
                strong += len(text)
        if not m:
            break
        at = m.end()
        name = m[2] or m[5]
        if not name or not m[0].endswith(">"):
            continue
        name = name.lower()
        if m[1] or m[4]:
            if name == "br":
                if not skip:
                    parts.append(" ")
                continue
            found = innermost({name}, SCOPES.get(name, SCOPE))
            if found is not None:
                close(found)
            continue
        if stack[-1][0] == "head" and name not in IN_HEAD:
            close(len(stack) - 1)
        if skip and (found := innermost({"select"}, {"object"})) is not None:
            if name in ("select", "input", "textarea", "keygen"):
                close(found)
                if name == "select":
                    continue
        if name in RAW:
            over = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
            at = over.end() if over else end
            continue
        if name == "body" and skip:
            close(skip)
        if name in ("option", "optgroup"):
            if stack[-1][0] == "option":
                close(len(stack) - 1)
            if name == "optgroup" and stack[-1][0] == "optgroup":
                close(len(stack) - 1)
        if name in DROPPED or skip:
            if not m[0].endswith("/>") and name not in VOID:
                skip = skip or len(stack)
                push(name, stack[-1][1])
            continue
        if name in MATH and m[0].endswith("/>"):
            continue
        if name == "br" or name in VOID:
            if name == "hr":
                flush()
            parts.append(" ")
            continue
        if name in CLOSES_P and (found := innermost({"p"}, {"td", "th", "table", "li", "div"})) is not None:
            close(found)
        if name in SIBLINGS and (found := innermost(*SIBLINGS[name])) is not None:
            outer = found
            while stack[outer - 1][0] in SIBLINGS[name][0]:
                outer -= 1
            close(outer)
        if name in INLINE:
            links += name == "a"
            push(name, stack[-1][1])
            continue
        flush()
        page.parent.append(stack[-1][1])
        page.tag.append(name)
        page.attrs.append(_attributes(m[3] if m[2] else m[6]))
        page.text.append(None)
        page.linked.append(0)
        page.strong.append(0)
        push(name, len(page.tag) - 1)
    flush()
    return page


# Words of class, id and role attributes by what they usually name.
ROLES = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar tabs pager pagination toc skip sitemap",
    "edge": "header masthead banner top footer bottom foot copyright colophon legal",
    "side": "sidebar side aside rail related recommended recommendations more trending popular widget widgets latest links",
    "advert": "ad ads advert advertisement sponsor sponsored promo promoted promotion adsense banner adbox affiliate",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription paywall disclaimer warning",
    "reader": "comment comments reply replies respond discussion disqus reviews feedback responses thread forum",
    "share": "share sharing social follow tweet facebook tags tag meta byline author date print rating",
    "form": "form search login signin signup register input contact",
    "main": "article content main post entry story body text page blog news prose single",
}
ROLE_OF = {word: kind for kind, words in ROLES.items() for word in words.split()}
TAGS = (
    "nav header footer aside article main section div p h1 h2 h3 h4 ul ol li dl dd dt table tr td th form fieldset figure "
    "figcaption blockquote pre address body html details dialog menu #text #root"
).split()
INSIDE = ("nav", "header", "footer", "aside", "article", "main", "form", "table", "ul", "dialog", "menu")
KINDS = tuple(ROLES)
NAMES = (
    ["bias", "element"] + [f"tag:{t}" for t in TAGS] + ["tag:other"] + [f"role:{k}" for k in KINDS]
    + [f"in:{t}" for t in INSIDE] + [f"in role:{k}" for k in KINDS]
    + ["hidden", "empty", "under 20", "under 80", "under 250", "longer", "links under 0.1", "links under 0.5", "links",
       "stops", "no stop", "first heading", "heading above", "parent p", "parent li", "parent div", "parent h"]
)
AT = {name: i for i, name in enumerate(NAMES)}
# Edges by whether the child is an element or a text run.
EDGES = 2


def features(page: Page) -> np.ndarray:
    """One row per node. Text figures of an element are those of all text below it."""
    n = len(page.tag)
    rows = np.zeros((n, len(NAMES)), dtype=np.float32)
    chars = [len(t) if t else 0 for t in page.text]
    linked = list(page.linked)
    stops = [sum(map(t.count, ".!?;,")) if t else 0 for t in page.text]
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        chars[p] += chars[i]
        linked[p] += linked[i]
        stops[p] += stops[i]
    held: list[frozenset] = [frozenset()] * n
    heading = False
    for i in range(n):
        tag, p = page.tag[i], page.parent[i]
        marks = {AT["bias"]}
        above = held[p] if i else frozenset()
        if tag != "#text":
            marks.add(AT["element"])
            a = page.attrs[i]
            words = " ".join(a.get(k, "") for k in ("class", "id", "role", "aria-label"))
            kinds = {ROLE_OF[w] for w in map(str.lower, WORDS.findall(words)) if w in ROLE_OF} if words.strip() else ()
            marks.update(AT[f"role:{k}"] for k in kinds)
            if "hidden" in a or a.get("aria-hidden") == "true" or "none" in a.get("style", "").replace(" ", "").partition("display:")[2][:4]:
                marks.add(AT["hidden"])
            held[i] = above | {AT[f"in role:{k}"] for k in kinds} | ({AT[f"in:{tag}"]} if tag in INSIDE else set())
            held[i] = held[i] | ({AT["hidden"]} if AT["hidden"] in marks else set())
        else:
            held[i] = above
            parent = page.tag[p]
            key = "parent h" if parent[:1] == "h" and parent[1:].isdigit() else f"parent {parent}"
            if key in AT:
                marks.add(AT[key])
        marks.add(AT.get(f"tag:{tag}", AT["tag:other"]))
        marks.update(above)
        if tag == "h1":
            marks.add(AT["first heading" if not heading else "heading above"])
            heading = True
        elif heading:
            marks.add(AT["heading above"])
        c = chars[i]
        marks.add(AT["empty" if not c else "under 20" if c < 20 else "under 80" if c < 80 else "under 250" if c < 250 else "longer"])
        share = linked[i] / c if c else 0
        marks.add(AT["links under 0.1" if share < 0.1 else "links under 0.5" if share < 0.5 else "links"])
        marks.add(AT["stops" if stops[i] else "no stop"])
        rows[i, list(marks)] = 1
    return rows


@dataclass
class Model:
    unary: np.ndarray
    edge: np.ndarray  # EDGES x (parent's value) x (child's value)


def _levels(parent: np.ndarray) -> list[np.ndarray]:
    depth = np.zeros(len(parent), dtype=np.int32)
    for i, p in enumerate(parent.tolist()):
        if p >= 0:
            depth[i] = depth[p] + 1
    order = np.argsort(depth, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)


def _soft(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(model: Model, rows: np.ndarray, parent: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Sum-product over a forest: P(content) per node, P(parent, child) per edge, log partition."""
    n = len(parent)
    score = np.zeros((n, 2))
    score[:, 1] = rows @ model.unary
    levels = _levels(parent)
    up = np.zeros((n, 2))  # message of a node to its parent
    below = score.copy()  # own score and all messages from children
    for level in levels[:0:-1]:
        up[level] = _soft(below[level][:, None, :] + model.edge[kind[level]], 2)
        np.add.at(below, parent[level], up[level])
    roots = levels[0]
    total = float(_soft(below[roots], 1).sum())
    belief = below.copy()
    joint = np.zeros((n, 2, 2))
    for level in levels[1:]:
        p = parent[level]
        outer = belief[p] - up[level]  # what the parent knows without this child
        both = outer[:, :, None] + model.edge[kind[level]] + below[level][:, None, :]
        joint[level] = np.exp(both - _soft(_soft(both, 2), 1)[:, None, None])
        belief[level] = below[level] + _soft(outer[:, :, None] + model.edge[kind[level]], 1)
    p1 = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -500, 500)))
    return p1, joint, total


def _forest(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts = np.cumsum([0] + [len(p.tag) for p in pages])
    parent = np.concatenate([[q + s if q >= 0 else -1 for q in p.parent] for p, s in zip(pages, starts)]).astype(np.int64)
    kind = np.concatenate([[t == "#text" for t in p.tag] for p in pages]).astype(np.int64)
    return np.concatenate([features(p) for p in pages]), parent, kind


def labels_of(page: Page) -> np.ndarray | None:
    """1 for content: text under data-main (or, without any, under article or main and under nothing
    that is not content by its name), and elements with nothing else below. None without a mark."""
    marked = any("data-main" in a for a in page.attrs)
    if not marked and not {"article", "main"} & set(page.tag):
        return None
    n = len(page.tag)
    inside = [False] * n
    for i in range(1, n):
        p = page.parent[i]
        if marked:
            here = page.attrs[i]
            inside[i] = ("data-main" in here or inside[p]) and "data-out" not in here
        else:
            inside[i] = (page.tag[i] in ("article", "main") or inside[p]) and page.tag[i] not in (
                "nav", "aside", "footer", "form", "menu", "dialog",
            )
    chars, good = [0] * n, [0] * n
    for i in range(n - 1, -1, -1):
        if page.text[i]:
            chars[i] += len(page.text[i])
            good[i] += len(page.text[i]) * inside[i]
        if i:
            chars[page.parent[i]] += chars[i]
            good[page.parent[i]] += good[i]
    return np.array([inside[i] if not chars[i] else good[i] == chars[i] for i in range(n)], dtype=float)


def fit(pages: list[Page], labels: list[np.ndarray], rounds: int = 250, rate: float = 0.15, ridge: float = 0.002) -> Model:
    """Maximum penalised likelihood by Adam over the whole of the labelled pages."""
    rows, parent, kind = _forest(pages)
    y = np.concatenate(labels)
    child = np.flatnonzero(parent >= 0)
    seen = np.zeros((len(parent), 2, 2))
    seen[child, y[parent[child]].astype(int), y[child].astype(int)] = 1
    theta = np.zeros(rows.shape[1] + EDGES * 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        model = Model(theta[: rows.shape[1]], theta[rows.shape[1] :].reshape(EDGES, 2, 2))
        p1, joint, _ = marginals(model, rows, parent, kind)
        grad = np.concatenate([
            rows.T @ (p1 - y),
            np.stack([(joint[child][kind[child] == k] - seen[child][kind[child] == k]).sum(axis=0) for k in range(EDGES)]).ravel(),
        ]) / len(pages) + ridge * theta
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        theta = theta - rate * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return Model(theta[: rows.shape[1]].copy(), theta[rows.shape[1] :].reshape(EDGES, 2, 2).copy())


def extract(model: Model, sources: list[str], keep: float = KEEP) -> list[str]:
    pages = [parse(s) for s in sources]
    rows, parent, kind = _forest(pages)
    p1, _, _ = marginals(model, rows, parent, kind)
    out, at = [], 0
    for page in pages:
        n = len(page.tag)
        out.append("\n".join(t for t, p in zip(page.text, p1[at : at + n]) if t and p >= keep))
        at += n
    return out


def train(pages: DataFrame | None, html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> Model:
    """Fit on the built-in layouts and on at most ``sample_pages`` pages that carry landmarks."""
    from slotwise.llm.layouts import labelled_layouts

    sources = labelled_layouts()
    if pages is not None:
        short = pages.where(F.length(html_col) < SAMPLE_CHARS).select(F.col(html_col).alias("h"))
        marked = short.where(F.lower("h").rlike("<(article|main)[ >]")).withColumn("k", F.xxhash64("h"))
        # Hashes first, so that tasks send the driver no pages that are not taken.
        taken = [r.k for r in marked.select("k").distinct().orderBy("k").limit(sample_pages).collect()]
        chosen = marked.where(F.col("k").isin(taken)).groupBy("k").agg(F.min("h").alias("h"))
        sources += [r.h for r in chosen.orderBy("k").collect()]
    parsed = [parse(s) for s in sources]
    labelled = [(p, y) for p in parsed if (y := labels_of(p)) is not None]
    return fit([p for p, _ in labelled], [y for _, y in labelled])


def main_text(pages: DataFrame, html_col: str = "html", model: Model | None = None, target: str = "text") -> DataFrame:
    """Adds ``text``, the main text of each page."""
    model = model or train(pages, html_col)
    kept = pages.drop(target)
    schema = T.StructType([*kept.schema.fields, T.StructField(target, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                sources = part.column(part.schema.get_field_index(html_col)).to_pylist()
                made = pa.array(extract(model, [s or "" for s in sources]), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, target])

    return kept.mapInArrow(run, schema)


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    return main_text(pages.select("page_id", "url", text_of("html").alias("html"))).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )
