"""Main text of web pages: the maximum-scoring run of a page's words and tags.

A page is a sequence of words and tags. Words score positive, tags negative; words inside elements
that hold boilerplate score negative, up to a bound for a run of them. One linear scan finds the contiguous run of the best sum; the
text of its words outside boilerplate elements is the page's main text.

A name alone makes no boilerplate: names of ``html`` and ``body``, names that say what a page has or lacks (``no-sidebar``, ``has-header``), and
those of an element that holds most of the page's words, most of them not in links (a wrapper, which may be a ``form``; remarks of readers excepted), count for nothing, and
names of lists of links (related, share, widget and the like) only where links or few words stand in them.

The weights come from labelled pages: pages whose authors marked the main content with an ``article``
or ``main`` element. Each feature (a tag, an element's name, a token of its class, id or role) gets the
log odds of being in the marked content, over given prior counts for well-known names. ``fit`` reads
at most ``fit_pages`` pages, the smallest by a hash of the id.

Blocks: block elements and ``br`` end a block; inline elements don't part words. White space in
a block becomes one blank, blocks are trimmed, empty ones left out, and joined by a line end.

Only script, style, textarea and title run to their end tag or the page's end. Other elements whose content is no
text (svg, iframe, object, select, noscript, template, head) end with their end tag or with what they stand in; math is text.

Defined cases: null and empty html give an empty text; a page of plain text is one block of content; unclosed, unmatched
and cut-off tags are tolerated; a "<" that begins no tag is text; repeated rows are read one by one;
ties between runs go to the first, longest; with no labelled page the priors alone hold; extra columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postwave.llm.common import ready, slices

#: Element names of HTML.
RAW = "script style textarea title"
#: Elements whose content is no text of the page; one without an end tag, or closed by "/>", holds nothing.
DROPPED = frozenset("noscript template svg iframe object select head annotation annotation-xml".split())
#: Elements that may stand in a head; others, and text, end it. Elements that end an svg or select left open.
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
BREAKS = frozenset("article aside blockquote body dd div dl dt footer h1 h2 h3 h4 h5 h6 header li main nav ol p pre section table ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp "
                   "small span strike strong sub sup time tt u var wbr math maction merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow "
                   "ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics path g circle rect line polyline polygon ellipse use defs symbol".split())
CONTENT = frozenset(("article", "main"))
BOILER = frozenset("nav footer aside form button dialog menu".split())
#: Words in class, id and role that name boilerplate.
BOILER_NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies "
                         "consent gdpr notice notices notification sidebar menu nav navbar navigation breadcrumb breadcrumbs footer "
                         "header masthead topbar toolbar comment comments reply replies disqus respond share sharing social related recommended "
                         "newsletter subscribe signup login popup modal overlay pagination pager widget search contentinfo "
                         "complementary form alert skip".split())
#: Names after which even an article inside is no main content.
REMARKS = frozenset(("comment", "comments", "reply", "replies", "disqus", "respond"))
#: Parts of a class name that say whether a page has something, not what the element is.
STATES = frozenset(("no", "not", "non", "without", "has", "have", "with", "hide", "is"))
#: Names of boxes of links and buttons; elements with this many words or more, few of them in links, are none.
LINK_NAMES = frozenset("related recommended widget search header skip social share sharing menu pagination pager".split())
PROSE_WORDS, PROSE_LINKS = 8, 0.3
#: Share of a page's words from which an element is a wrapper of the page.
WRAPPER = 0.6
PRIOR = 50.0
#: A run of boilerplate words costs no more than this, so that an advert doesn't cut a short page in two; what parts
#: regions are tags. Inside marked content tags and boilerplate cost only a small part.
RUN_COST, IN_CONTENT = 3.0, 0.02

TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<(?P<raw>" + "|".join(RAW.split()) + r")(?=[\s/>])(?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>.*?(?:</(?P=raw)\s*>|(?=<body[\s>])|\Z)"
    r"|<[!?][^>]*>?"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*))>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
DROPPED_END = re.compile("</(" + "|".join(sorted(DROPPED, key=len, reverse=True)) + r")(?=[\s/>])", re.I)
ATTR = re.compile(r"(?:^|[\s\"'])(class|id|role|aria-label|style|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))|(?:^|[\s\"'])(hidden|aria-hidden\s*=\s*[\"']?true)", re.I)
NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")
SPACE = re.compile(r"\s+")


def features(name: str, attrs: str) -> tuple[str, ...]:
    """An element's features: its name and the tokens of its class, id and role."""
    got = [f"t:{name}"]
    if "=" in attrs or "hidden" in attrs:
        for key, a, b, c, hidden in ATTR.findall(attrs):
            value = (a or b or c).lower()
            if hidden or (key.lower() == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
                got.append("hidden")
            elif key.lower() == "itemprop":
                got += ["t:article"] * (value == "articlebody")
            elif key.lower() != "style" and name not in ("html", "body"):
                for one in value.split():
                    parts = re.findall(r"[a-z]+", one)
                    got += [f"n:{x}" for x in parts if STATES.isdisjoint(parts) or x not in BOILER_NAMES]
                if key.lower() == "role" and value == "main":
                    got.append("t:main")
    return tuple(dict.fromkeys(got))


class Node:
    """An open element: its parent, features, whether it stands in marked content or in remarks, and the words below it."""

    __slots__ = ("parent", "own", "inside", "remark", "link", "fresh", "words", "linked", "score")

    def __init__(self, parent: Node | None, own: tuple[str, ...] = (), inside: bool = False, remark: bool = False, link: bool = False):
        self.parent, self.own, self.inside, self.remark, self.link = parent, own, inside, remark, link
        self.fresh: tuple[str, ...] = ()        # features that no element around it has
        self.words, self.linked, self.score = 0, 0, 0.0


def prior(feature: str) -> tuple[float, float]:
    """Pseudo-counts of words inside and outside main content."""
    if feature == "hidden" or feature[2:] in (BOILER if feature[0] == "t" else BOILER_NAMES):
        return 1.0, PRIOR
    if feature[:2] == "t:" and feature[2:] in CONTENT:
        return PRIOR, 1.0
    return 1.0, 1.0


def scan(page: str) -> tuple[list[tuple], bool, list[Node]]:
    """Tokens of a page: ("w", text, element) or ("t", name, ends a block, element before it); whether the page marks its main
    content; and its elements in order, the page itself first. Each token takes constant time but for elements that it closes."""
    out: list[tuple] = []
    stack: list[tuple[str, Node]] = []          # names of open elements, and what they stand in
    node = Node(None)
    nodes = [node]
    marked = False
    off = None                        # place in the stack of the element whose content is dropped
    ends = {m.group(1).lower(): m.start() for m in DROPPED_END.finditer(page)}
    names: dict[str, int] = {}                  # how many elements of a name, and with a feature, are open
    shown: dict[str, int] = {}

    def close(k: int) -> None:
        """Takes the elements from place k on off the stack."""
        nonlocal node
        for name, above in reversed(stack[k:]):
            names[name] -= 1
            for f in node.own:
                shown[f] -= 1
            node = above
        del stack[k:]

    for m in TOKEN.finditer(page):
        if m.group("text") is not None:
            text = m.group("text")
            if off is not None:
                if stack[-1][0] != "head" or text.isspace():
                    continue
                close(off)
                off = None
            if out and out[-1][0] == "w" and out[-1][2] is node:
                out[-1][1].append(text)
            else:
                out.append(("w", [text], node))
            continue
        name = m.group("name") or m.group("name2")
        if not name:
            continue
        name = name.lower()
        if m.group("end") or m.group("end2"):
            k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name) if names.get(name) else None
            if off is not None and k is not None and k < off:           # the end of what the dropped element stands in
                close(off)
                off = None
            if off is None and name not in DROPPED:
                out.append(("t", name, name not in INLINE, node))
            if k is not None:
                close(k)
                if off is not None and k <= off:
                    off = None
            continue
        if off is not None:
            outer = stack[off][0]
            if (name == "body" or off == len(stack) - 1 and name not in HEAD if outer == "head"
                    else outer in ("svg", "select") and name in BREAKS and not names.get("foreignobject")):
                close(off)
                off = None
        if off is None and name not in DROPPED:
            out.append(("t", name, name not in INLINE, node))
        attrs = m.group("attrs") or m.group("attrs2") or ""
        if name in DROPPED or name == "math":
            if attrs.endswith("/") or name not in ("head", "math") and ends.get(name, -1) < m.end():
                continue
            if off is None and name in DROPPED:
                off = len(stack)
        if name not in VOID:
            own = features(name, attrs)
            remark = any(f[2:] in REMARKS for f in own if f[:2] == "n:")
            begins = not remark and ("t:article" in own or "t:main" in own) and not node.remark
            marked = marked or begins
            stack.append((name, node))
            names[name] = names.get(name, 0) + 1
            node = Node(node, own, node.inside or begins, node.remark or remark, node.link or name in ("a", "button"))
            node.fresh = tuple(f for f in own if not shown.get(f))
            for f in own:
                shown[f] = shown.get(f, 0) + 1
            nodes.append(node)
    out = [("w", "".join(t[1]), t[2]) if t[0] == "w" else t for t in out]
    for t in out:
        if t[0] == "w" and (n := len(t[1].split())):
            t[2].words += n
            t[2].linked += n if t[2].link else 0
    for x in reversed(nodes[1:]):
        x.parent.words += x.words
        x.parent.linked += x.linked
    return out, marked, nodes


def observe(page: str) -> dict[str, list[float]]:
    """Words inside and outside the marked content under each feature, and tags ("T:name") likewise."""
    tokens, marked, nodes = scan(page)
    counts: dict[str, list[float]] = {}
    if not marked:
        return counts
    at = {id(x): k for k, x in enumerate(nodes)}
    words = [[0, 0] for _ in nodes]
    inside = False
    for kind, value, more, *_ in tokens:
        if kind == "w":
            n = len(value.split())
            inside = more.inside and not more.remark
            words[at[id(more)]][not inside] += n
        else:
            counts.setdefault(f"T:{value}", [0.0, 0.0])[not inside] += 1
    for k in range(len(nodes) - 1, 0, -1):
        above = words[at[id(nodes[k].parent)]]
        for i in (0, 1):
            above[i] += words[k][i]
            if words[k][i]:
                for f in nodes[k].fresh:
                    counts.setdefault(f, [0.0, 0.0])[i] += words[k][i]
    return counts


def weights(counts: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Log odds of each named feature (clipped to -4..1) and the cost of each tag (-1..-0.05).

    Plain element names say too little for words, so only well-known ones and names have word weights."""
    out = {}
    for f, (a, b) in counts.items():
        if f[:2] == "T:":
            out[f] = -(0.05 + 0.95 * (b + 0.05) / (a + b + 1.0))
        elif f[:2] == "n:" or prior(f) != (1.0, 1.0):
            pa_, pb = prior(f)
            out[f] = max(-4.0, min(1.0, math.log((a + pa_) / (b + pb))))
    for name in BOILER | BOILER_NAMES | {"hidden"}:
        for f in ((f"t:{name}",) if name in BOILER else ()) + ((f"n:{name}",) if name in BOILER_NAMES else ()) + (("hidden",) if name == "hidden" else ()):
            out.setdefault(f, -math.log(PRIOR))
    return out


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", fit_pages: int = 1000) -> dict[str, float]:
    """Weights from at most ``fit_pages`` of the pages, those of the smallest hash of the id.

    Returned to the driver: one row per feature that ``min_pages`` (2 in 1000) of these pages show."""
    ready(pages.sparkSession)
    ident = F.col(f"`{id_col}`")
    most = pages.select(F.xxhash64(ident).alias("h")).orderBy("h").limit(fit_pages).agg(F.max("h")).first()[0]
    rows = pages.where(F.xxhash64(ident) <= F.lit(most)).select(F.col(f"`{html_col}`").cast("string").alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__html"):
            total: dict[str, list[float]] = {}
            for page in batch.column(0).to_pylist():
                for f, (a, b) in observe(page or "").items():
                    t = total.setdefault(f, [0.0, 0.0, 0])
                    t[0] += a
                    t[1] += b
                    t[2] += 1
            names = list(total)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string())] + [pa.array([float(total[f][k]) for f in names], pa.float64()) for k in range(3)],
                                             ["feature", "a", "b", "pages"])

    least = max(2, fit_pages // 500)
    counted = rows.mapInArrow(run, "feature string, a double, b double, pages double").groupBy("feature").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("pages").alias("pages")).where(F.col("pages") >= least)
    return weights({r.feature: (r.a, r.b) for r in counted.collect()})


def _own_score(x: Node, w: dict[str, float], all_words: int) -> float:
    """The score of an element's words by its own features alone."""
    wrapper = x.words >= WRAPPER * all_words and 2 * x.linked < x.words
    prose = x.words >= PROSE_WORDS and x.linked < PROSE_LINKS * x.words

    def counts(f: str) -> bool:
        if f not in w:
            return False
        if w[f] >= 0 or f[2:] in REMARKS or f == "hidden" or f[:2] == "t:" and f != "t:form":
            return True
        return not wrapper and not (prose and f[:2] == "n:" and f[2:] in LINK_NAMES)

    own = min((w[f] for f in x.own if counts(f)), default=1.0)
    return min(own, -2.0) if "t:header" in x.own and not x.inside and not wrapper else own


def score(nodes: list[Node], w: dict[str, float], marked: bool) -> None:
    """The word score of each element, parents first."""
    nodes[0].score = -4.0 if marked else 1.0
    for x in nodes[1:]:
        own, above = _own_score(x, w, nodes[0].words), x.parent.score
        if x.inside and not x.parent.inside:
            x.score = own
        elif own < 0:
            x.score = min(above, own)
        else:
            x.score = above if x.inside or not marked else min(above, -4.0)
        if x.remark:
            x.score = min(x.score, -2.0)


def best_run(gains: list[tuple[float, float]]) -> tuple[int, int]:
    """Begin and end of the run of the greatest sum (first, then longest): one scan.

    Each token has its gain and what it adds to the cost of its run of boilerplate words (0 for others, below 0: a word of content, which ends such a run);
    a run of them costs ``RUN_COST`` at most, counted from where it begins."""
    best = total = run = 0.0
    start, chosen = 0, (0, 0)
    for k, (gain, cost) in enumerate(gains):
        if total <= 0:
            total, start = 0.0, k
        if cost > 0:
            cost = min(cost, RUN_COST - run)
            total, run = total - cost, run + cost
        else:
            total += gain
            run = 0.0 if cost < 0 else run
        if total > best:
            best, chosen = total, (start, k + 1)
    return chosen


def main_text(page: str, w: dict[str, float]) -> str:
    """The text of the best run of the page."""
    tokens, marked, nodes = scan(page)
    score(nodes, w, marked)
    gains = []
    for kind, value, more, *node in tokens:
        if kind == "w":
            n = len(value.split())
            gains.append((0.0, 0.0) if not n else (float(n), -1.0) if more.score >= 0 else (0.0, -n * more.score * (IN_CONTENT if more.inside else 1.0)))
        else:
            gains.append((w.get(f"T:{value}", -0.3) * (IN_CONTENT if node[0].inside else 1.0), 0.0))
    begin, end = best_run(gains)
    blocks, now = [], []
    for kind, value, more, *_ in tokens[begin:end]:
        if kind == "w":
            if more.score >= 0:
                now.append(value)
        elif more and now:
            blocks.append("".join(now))
            now = []
    blocks.append("".join(now))
    texts = (SPACE.sub(" ", html_lib.unescape(b)).strip() for b in blocks)
    return "\n".join(t for t in texts if t)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            w: dict[str, float] | None = None, **fitting) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    ready(pages.sparkSession)
    w = fit(pages, id_col, html_col, **fitting) if w is None else w
    src = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"), F.col(f"`{html_col}`").cast("string").alias("__html"))
    schema = f"page_id {src.schema['page_id'].dataType.simpleString()}, url {src.schema['url'].dataType.simpleString()}, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__html"):
            texts = [main_text(p, w) if p else "" for p in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             ["page_id", "url", "text", "n_chars"])

    return src.mapInArrow(run, schema)
