"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page becomes a tree of block elements; inline markup belongs to the block around it. Every
block node gets features of its subtree (text, links, tags, punctuation), of its attribute tokens,
its depth and its siblings. Boosted trees give the log-odds that a node is main text, and the
set of kept nodes is the best one that is closed upwards: no kept node stands under a dropped one.
Scripts, styles, forms and the like are never text.

The trees are fitted on a bounded sample: the ``sample`` pages with the lowest hash of their
id. Their markup says where the article is; variants of the sample pages, with the telling tags
renamed and with menus, notices, adverts, sidebars and comments put in, teach the other features.
Prediction is one scan with whole pages; nothing is shuffled.

Defined results: a missing or empty page has an empty text and ``n_chars`` 0; markup that is not
closed or never opened is repaired as browsers do in the simple cases; repeated rows are
extracted each; extra columns are not looked at; an empty table gives an empty table.
"""

from __future__ import annotations

import random
import re
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from acctcube.llm.boosting import BoostedTrees

SAMPLE = 200
VARIANTS = 3
MAX_TRAINING_CHARS = 200_000  # a longer page is left out of the sample, never of the result

#: Elements that begin a block, that have no end tag, and whose content is no text.
BLOCKS = frozenset(
    "html body article main section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th "
    "blockquote pre figure figcaption nav header footer aside form fieldset address hr details summary center "
    "menu dialog search caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset(
    "script style noscript template svg math iframe object canvas head title form button select option textarea "
    "input label audio video map datalist dialog".split()
)
RAW = frozenset("script style textarea title noscript template iframe svg".split())
#: Parts of class, id and role names that tell what a block is for.
GOOD = frozenset("article content main body post story entry text hentry prose articlebody".split())
BAD = frozenset(
    "nav navbar navigation menu header masthead banner footer foot sidebar side aside rail widget related recommend "
    "recommended more share sharing social ad ads advert advertisement adbox sponsor sponsored promo promoted cookie "
    "cookies consent notice notification alert popup modal overlay subscribe newsletter signup login comment comments "
    "reply replies respond disqus discussion breadcrumb breadcrumbs pagination pager tags tag copyright legal skip "
    "toolbar tools meta byline search form gdpr privacy outbrain taboola hidden".split()
)
COMMENT = frozenset("comment comments reply replies respond disqus discussion".split())

_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_NAMES = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
_LABEL = re.compile(r'data-main-label="([01])"')


class Node:
    __slots__ = ("tag", "parent", "names", "depth", "children", "texts", "chars", "links", "tags", "punct", "index", "label", "never", "words")

    def __init__(self, tag, parent, names=(), never=False, label=None):
        self.tag, self.parent, self.names, self.never, self.label = tag, parent, names, never, label
        self.depth = parent.depth + 1 if parent else 0
        self.children, self.texts = [], []
        self.chars = self.links = self.tags = self.punct = self.words = 0
        self.index = -1


def parse(html: str, labels: bool = False) -> tuple[list[Node], list[tuple[Node, str]]]:
    """Block nodes, parents first, and the text pieces (block, text) in page order."""
    root = Node("#", None)
    nodes, pieces = [root], []
    stack: list[tuple[str, Node]] = [("#", root)]  # open elements with their block
    run: list[str] = []
    links = at = never = 0

    def flush() -> None:
        if run:
            text = " ".join("".join(run).split())
            run.clear()
            if text:
                pieces.append((stack[-1][1], text))

    def close(depth: int) -> None:
        """Pop the stack down to ``depth`` elements."""
        nonlocal links, never
        while len(stack) > depth:
            tag, block = stack[-1]
            if tag in BLOCKS:
                flush()
            links -= tag == "a"
            never -= tag in NEVER or tag == "!"
            stack.pop()

    def say(text: str) -> None:
        if text and not never:
            text = unescape(text)
            run.append(text)
            n, block = len(text), stack[-1][1]
            block.chars += n
            block.links += n if links else 0
            block.punct += text.count(".") + text.count(",") + text.count("!") + text.count("?")
            block.words += text.count(" ") + 1

    # no tag ends after the last ">": the rest is text, up to a comment that nothing closes
    last = html.rfind(">") + 1
    while True:
        m = _TAG.search(html, at, last)
        if m is None:
            say(html[at:].partition("<!--")[0])
            break
        say(html[at : m.start()])
        if m[0].startswith("<!--") and not (len(m[0]) >= len("<!---->") and m[0].endswith("-->")):
            break
        at = m.end()
        end, tag, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:
            continue
        tag = tag.lower()
        if end:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag or stack[k][0] == "!" and tag in BLOCKS:
                    if stack[k][0] == tag or k + 1 < len(stack):
                        close(k)
                    break
                if stack[k][0] in ("td", "th", "table") and tag not in BLOCKS:
                    break
            continue
        block = tag in BLOCKS
        if block:
            # a paragraph ends where a block begins, an item where its sibling begins
            open_p = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] in BLOCKS), 0)
            if open_p and stack[open_p][0] == "p":
                close(open_p)
            if tag in _CLOSES:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k][0] in _CLOSES[tag]:
                        close(k)
                        break
                    if stack[k][0] in _STOPS.get(tag, ()):
                        break
            flush()
        elif tag == "br":
            run.append(" ")
        stack[-1][1].tags += 1
        if tag in VOID or attrs.endswith("/") and not block:
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            at = stop.end() if stop else len(html)
            continue
        hidden = bool(attrs) and _HIDDEN.search(re.sub(r"(?:class|id)\s*=\s*(?:\"[^\"]*\"|'[^']*')", "", attrs)) is not None
        if block:
            names = tuple(p.lower() for x in _NAMES.findall(attrs) for p in _PARTS.findall("".join(x))) if attrs else ()
            label = _LABEL.search(attrs) if labels and attrs else None
            node = Node(tag, stack[-1][1], names, hidden or tag in NEVER, int(label[1]) if label else None)
            node.parent.children.append(node)
            node.index = len(nodes)
            nodes.append(node)
            stack.append((tag, node))
        else:
            stack.append((tag, stack[-1][1]))
        links += tag == "a"
        never += tag in NEVER
        if hidden:
            stack.append(("!", stack[-1][1]))
            never += 1
    close(1)
    flush()
    return nodes, pieces


WIDTH = 24


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node; subtree sums go from the leaves up, the path from the root down."""
    n = len(nodes)
    sums = np.array([[x.chars, x.links, x.tags + 1, x.punct, x.words, 1, x.tag == "p", x.tag == "li"] for x in nodes], float)
    for i in range(n - 1, 0, -1):
        sums[nodes[i].parent.index if nodes[i].parent.index >= 0 else 0] += sums[i]
    whole = max(1.0, sums[0, 0])
    out, good, bad = np.zeros((n, WIDTH)), np.zeros(n), np.zeros(n)
    for i, x in enumerate(nodes):
        p = x.parent
        up = 0 if p is None or p.index < 0 else p.index
        own_good, own_bad = sum(t in GOOD for t in x.names), sum(t in BAD for t in x.names)
        semantic = 1 if x.tag in ("article", "main") else -1 if x.tag in ("nav", "aside", "footer", "header", "menu", "search") else 0
        good[i] = good[up] + (own_good > 0) + (semantic > 0)
        bad[i] = bad[up] + (own_bad > 0) + (semantic < 0)
        chars, links, tags, punct, words, blocks, paragraphs, items = sums[i]
        brothers = p.children if p else [x]
        place = x.index
        out[i] = (
            x.depth, len(x.children), chars, chars / whole, links / max(1.0, chars), tags / max(1.0, chars) * 100,
            punct / max(1.0, words), words / max(1.0, blocks), paragraphs, items / max(1.0, blocks), semantic, own_good,
            own_bad, good[i], bad[i], len(brothers), place / n, x.chars, x.links / max(1.0, x.chars),
            sums[up, 0] / whole, sums[up, 1] / max(1.0, sums[up, 0]), x.tag in ("p", "pre", "blockquote"),
            x.tag[0] == "h" and x.tag[1:].isdigit(), sum(t in COMMENT for t in x.names),
        )
    return out


def decode(nodes: list[Node], logits: np.ndarray) -> list[bool]:
    """Best set of kept nodes that is closed upwards; the root is always kept."""
    weight = [min(4.0, 0.25 + np.log1p(x.chars) / 2) if x.chars else 0.25 for x in nodes]
    gain = [0.0] * len(nodes)
    for i in range(len(nodes) - 1, -1, -1):
        x = nodes[i]
        gain[i] += -1e18 if x.never else weight[i] * logits[i]
        if i and gain[i] > 0:
            gain[x.parent.index if x.parent.index >= 0 else 0] += gain[i]
    kept = [True] * len(nodes)
    for i in range(1, len(nodes)):
        up = nodes[i].parent.index
        kept[i] = kept[up if up >= 0 else 0] and gain[i] > 0
    return kept


def main_text(pieces, kept) -> str:
    return "\n\n".join(text for node, text in pieces if kept[max(node.index, 0)])


def _rename(html: str, old: str, new: str, attrs: str) -> str:
    html = re.sub(rf"<{old}\b[^>]*>", lambda m: f"<{new}{attrs}>", html, flags=re.I)
    return re.sub(rf"</{old}\s*>", f"</{new}>", html, flags=re.I)


def _marked(html: str) -> str | None:
    """The page with its article and its other parts labelled; nothing where it has no article."""
    if not re.search(r"<(article|main)\b", html, re.I):
        return None
    html = re.sub(r"<(article|main)\b", r'<\1 data-main-label="1"', html, flags=re.I)
    html = re.sub(r"<(nav|header|footer|aside|form)\b", r'<\1 data-main-label="0"', html, flags=re.I)

    def labelled(m: re.Match) -> str:
        names = {p.lower() for x in _NAMES.findall(m[2]) for p in _PARTS.findall("".join(x))}
        return f'<{m[1]} data-main-label="0"{m[2]}>' if names & BAD and not names & GOOD else m[0]

    return re.sub(r"<(div|section|ul|p)(\s[^>]*)>", labelled, html, flags=re.I)


def variant(html: str, texts: list[str], rng: random.Random) -> str:
    """Another page around the same article: other tags and names, more parts that are no article."""
    bad, good = sorted(BAD), sorted(GOOD)

    def words(k: int) -> str:
        return " ".join(rng.choice(texts).split()[: rng.randint(2, k)])

    def name(pool: list[str]) -> str:
        a = rng.choice(pool)
        return rng.choice([f' class="{a}"', f' id="{a}"', f' class="{a}-{rng.choice(["box", "wrap", "item", "list"])} x{rng.randint(1, 9)}"'])

    def part() -> str:
        kind = rng.choice(["menu", "notice", "comments", "aside", "header", "footer", "related", "form"])
        zero = ' data-main-label="0"'
        if kind == "menu":
            return f'<ul{zero}{name(["menu", "nav", "breadcrumb", "tags"])}>' + "".join(f'<li><a href="/">{words(4)}</a></li>' for _ in range(rng.randint(2, 8))) + "</ul>"
        if kind == "comments":
            tag = rng.choice(["div", "section", "ol"])
            item = "li" if tag == "ol" else "div"
            return f'<{tag}{zero}{name(["comments", "comment", "replies", "discussion"])}>' + "".join(f'<{item} class="comment"><p>{words(60)}</p></{item}>' for _ in range(rng.randint(1, 5))) + f"</{tag}>"
        if kind in ("aside", "header", "footer"):
            return f"<{kind}{zero}><p>{words(30)}</p><p>{words(12)}</p></{kind}>"
        if kind == "related":
            return f'<div{zero}{name(["related", "recommended", "more", "promo", "sponsored"])}>' + "".join(f'<p><a href="/">{words(10)}</a></p>' for _ in range(rng.randint(2, 5))) + "</div>"
        return f"<div{zero}{name(bad)}><p>{words(40)}</p></div>"

    if rng.random() < 0.75:
        new, attrs = rng.choice([("div", name(good)), ("section", name(good)), ("div", ""), ("main", ""), ("div", name(good))])
        html = _rename(html, "article", new, f' data-main-label="1"{attrs}')
    for old in ("nav", "footer", "aside", "header"):
        if rng.random() < 0.5:
            html = _rename(html, old, "div", f' data-main-label="0"{name([old] if old != "aside" else ["sidebar"])}')
    for _ in range(rng.randint(1, 4)):
        begin = re.search(r'<[^>]*data-main-label="1"[^>]*>', html)
        body = re.search(r"</body>", html, re.I)
        spots = [m.start() for m in re.finditer(r'<(?:div|nav|article|section|main|footer)[^>]*data-main-label', html)][:4]
        ends = [body.start()] if body else []
        inside = [begin.end()] if begin and rng.random() < 0.3 else []
        spot = rng.choice([*spots, *ends, *inside] or [len(html)])
        html = html[:spot] + part() + html[spot:]
    return html


def train(pages: list[str], variants: int = VARIANTS, seed: int = 7) -> BoostedTrees | None:
    """Trees fitted on the labelled nodes of the pages and of their variants."""
    rng = random.Random(seed)
    marked = [m for m in map(_marked, pages) if m]
    texts = [t for m in marked for t in (" ".join(x for _, x in parse(m)[1]),) if t.split()]
    if not texts:
        return None
    rows, wanted = [], []
    for page in marked:
        for k in range(variants + 1):
            nodes, _ = parse(variant(page, texts, rng) if k else page, labels=True)
            x = features(nodes)
            label: list[int | None] = []
            for node in nodes:
                up = label[max(node.parent.index, 0)] if node.parent else None
                # what stands inside a part that is no article stays outside
                label.append(0 if up == 0 else node.label if node.label is not None else up)
            known = [i for i, y in enumerate(label) if y is not None]
            rows.append(x[known])
            wanted.extend(label[i] for i in known)
    y = np.array(wanted, float)
    if y.min() == y.max():
        return None
    return BoostedTrees().fit(np.concatenate(rows), y)


def rule_logits(x: np.ndarray) -> np.ndarray:
    """Where no page tells what an article is: everything outside parts named as something else."""
    return np.where(x[:, 14] > 0, -1.0, 1.0)


def extract_pages(htmls: list[str | None], model: BoostedTrees | None) -> list[str]:
    parsed = [parse(h) if h else None for h in htmls]
    rows = [features(p[0]) for p in parsed if p]
    if not rows:
        return [""] * len(htmls)
    x = np.concatenate(rows)
    logits = model.logit(x) if model else rule_logits(x)
    out, at = [], 0
    for p in parsed:
        if p is None:
            out.append("")
            continue
        nodes, pieces = p
        out.append(main_text(pieces, decode(nodes, logits[at : at + len(nodes)])))
        at += len(nodes)
    return out


def fit(pages: DataFrame, sample: int = SAMPLE) -> BoostedTrees | None:
    return train(_sampled(pages, sample))


def _sampled(pages: DataFrame, sample: int) -> list[str]:
    """The pages with the smallest hashes. Hashes alone are ranked; the pages are read for the chosen ones."""
    key = F.xxhash64(F.col("page_id").cast("string"), F.lit("sample"))
    fitting = pages.where(F.length("html").between(1, MAX_TRAINING_CHARS)).select(key.alias("key"), F.xxhash64("html").alias("of"), "html")
    chosen = [tuple(r) for r in fitting.select("key", "of").orderBy("key", "of").limit(sample).collect()]
    if not chosen:
        return []
    k, h = chosen[-1]
    upto = (F.col("key") < k) | ((F.col("key") == k) & (F.col("of") <= h))
    # at most one row to a chosen pair of hashes, however often a page repeats
    html = {(r.key, r.of): r.html for r in fitting.where(upto).groupBy("key", "of").agg(F.min("html").alias("html")).collect()}
    return [html[pair] for pair in chosen]


def extract(pages: DataFrame, model: BoostedTrees | None) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            # a few hundred parsed pages are held at a time
            for at in range(0, b.num_rows, 200):
                piece = b.slice(at, 200)
                texts = extract_pages(piece.column(2).to_pylist(), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select(F.col("page_id").cast("long"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
