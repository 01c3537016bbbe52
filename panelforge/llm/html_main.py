"""HTML extraction by a tree-structured graphical model over the DOM.

Nodes are the block elements of a page and its runs of text; each is content,
boilerplate, or (elements only) a frame around both.  An element says by its tag and by the words of its class, id and role
how likely it takes each state under a parent of each state (a parent-child potential of its own, backing off from
tag, words and share of link text to tag and words, words, tag, and all elements); so a marked box inside an article is judged against the article
and can't turn the article itself.  Evidence comes from the text: a unary potential (product of trained feature likelihoods) scores a run
by its block, length, share of link text and ending; the runs of one list or table count as one observation.
One upward and one downward pass of sum-product
messages give every node's exact content marginal, and the text runs above one
half are the main text, in page order.

Both potentials are smoothed counts over labelled pages.  ``labelled_pages`` makes
such pages from site layouts (deterministic, without any outside data); other
labelled pages can be given to ``train``: elements carry ``data-y`` (1 or 0), which
holds for all below until the next.

Per page: the whole html is read; character references are decoded, white space
inside a block becomes one space, blocks are joined by two newlines; scripts,
styles, head and comments never count as text.  Null or empty html, or a page
without content, gives an empty text; broken or cut markup is read as far as it
goes (a page cut inside a tag loses that tag alone); repeated rows get repeated results; a marginal of exactly
one half is no content; other columns are ignored.
"""

from __future__ import annotations

import html as html_lib
import math
import random
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import small_batches, table, trimmed

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose inside is never shown as text of the page.
HIDDEN = frozenset("head iframe noembed noframes noscript object script select style svg template textarea title canvas audio video annotation annotation-xml".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr picture q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover none semantics".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
#: Tags that follow from the parent's and so are no evidence of their own.
IMPLIED = frozenset("li tr td th tbody thead tfoot dt dd".split())
#: A start tag ends an open element of the same family, up to the list or table around it.
FAMILY = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "tbody": ("tbody thead tfoot tr td th", ("table",)), "option": ("option", ("select",))}
FAMILY = {k: (frozenset(a.split()), frozenset(b)) for k, (a, b) in FAMILY.items()}

#: An attribute as HTML has it: a quote opens a value only right after "=", and one that never closes is a letter like others.
_ATTRIBUTE = r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
_TAG = re.compile(rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE})*+)>", re.A)
_ATTR = re.compile(_ATTRIBUTE, re.A)
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.A)
#: Attributes that are read.
ATTRIBUTES = frozenset("class id role aria-label hidden data-y".split())
#: From the second "-" of "<!--" on: "<!-->" and "<!--->" are empty comments.
_COMMENT_END = re.compile(r"(?<=<!)--(?:-?>)|(?<!<!)--!?>")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Words of class, id and role by what they mark.
MARKS = {
    "ad": "ad ads adv advert adverts advertisement advertising adsbygoogle banner sponsor sponsored promo promoted promotion",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pager pagination topbar toolbar tabs skip",
    "head": "header masthead branding logo",
    "foot": "footer foot copyright legal colophon",
    "side": "sidebar side aside widget widgets complementary rail",
    "more": "related recommended popular trending more",
    "note": "cookie cookies consent notice notices alert gdpr popup modal overlay paywall",
    "call": "warning message tip info hint caution important callout dialog",
    "form": "form search newsletter subscribe signup login register contact",
    "talk": "comment comments reply replies respond discussion disqus thread responses",
    "share": "share sharing social tags tag follow",
    "by": "meta byline author date",
    "main": "article content main post entry story text body page blog hentry single prose",
}
_MARK = {w: k for k, words in MARKS.items() for w in words.split()}


class Page:
    """Nodes in page order (a parent before its children) with their feature names; text runs have their text.

    ``group``: of a run in a list or table, the node of that list or table; else its own.
    """

    __slots__ = ("parent", "features", "text", "label", "group")

    def __init__(self):
        self.parent, self.features, self.text, self.label, self.group = [-1], [()], [None], [None], [0]


_EMPTY: dict = {}


def _attributes(raw: str) -> dict:
    if not raw or raw.isspace():
        return _EMPTY
    out = {}
    for name, value in _ATTR.findall(raw):
        if (name := name.lower()) in ATTRIBUTES and name not in out:
            out[name] = value[1:-1] if value[:1] in ("'", '"') and value[-1] == value[0] and len(value) > 1 else value
    return out


def _element_features(tag: str, attrs: dict) -> tuple:
    """From general to special: the tag, each mark, the marks together, and the tag with them or without any (later also with ``links``)."""
    marks = sorted({_MARK.get(w.lower(), "") for k in ("class", "id", "role", "aria-label") if k in attrs for w in _NAME.findall(attrs[k])} - {""})
    if "hidden" in attrs:
        marks.append("hidden")
    return ("tag=" + tag, *("mark=" + m for m in marks), *(("marks=" + "+".join(marks), f"tag={tag} marks=" + "+".join(marks)) if marks else (f"bare={tag}",)))


def _text_features(text: str, linked: int) -> tuple:
    """Length, share of link text and ending, together."""
    words, share = text.count(" ") + 1, linked / len(text)
    n = "1" if words < 3 else "3" if words < 8 else "8" if words < 20 else "20" if words < 50 else "50"
    return (f"words={n} links={'0' if share == 0 else 'some' if share < 0.5 else 'all'} end={'stop' if text[-1] in _STOPS else 'none'}",)


_STOPS = ".!?:;\"'”»…"


def parse(source: str, labelled: bool = True) -> Page:
    """``labelled``: reads ``data-y`` (1 or 0; other values say nothing), which only training pages have."""
    page = Page()
    parent, features, texts, labels, groups = page.parent, page.features, page.text, page.label, page.group
    stack = [("root", 0, None)]  # open elements: tag, node, label
    run: list[str] = []
    sizes: list[tuple[int, int, int]] = []
    linked = depth_a = hidden = 0

    def flush():
        nonlocal run, linked
        if run:
            text = " ".join("".join(run).split())
            if text:
                k = len(stack) - 1
                while stack[k][0] in INLINE:
                    k -= 1
                block = stack[k]
                while k > 0 and (stack[k][0] in IMPLIED or stack[k][0] in INLINE):
                    k -= 1
                groups.append(stack[k][1] if block[0] in IMPLIED else len(parent))
                sizes.append((len(parent), len(text), min(linked, len(text))))
                parent.append(block[1])
                features.append(_text_features(text, min(linked, len(text))))
                texts.append(text)
                labels.append(block[2])
            run, linked = [], 0

    def pop(k):
        nonlocal depth_a, hidden
        for tag, _, _ in stack[k:]:
            depth_a -= tag == "a"
            hidden -= tag in HIDDEN
        del stack[k:]

    pos, end, tag_at = 0, len(source), _TAG.match
    while pos < end:
        at = source.find("<", pos)
        piece = source[pos : end if at < 0 else at]
        if piece and not hidden:
            piece = html_lib.unescape(piece) if "&" in piece else piece  # a reference ends with its piece of text
            run.append(piece)
            if depth_a:
                linked += len(piece)
        if at < 0:
            break
        m = tag_at(source, at)
        named = m is None and source[at + 1 : at + 2].isascii() and source[at + 1 : at + 2].isalpha()
        if named:
            tag_at = _PLAIN_TAG.match  # quotes pair up past every end: from here on the next ">" ends a tag
            m = tag_at(source, at)
        if m is None:
            if source.startswith("<!--", at):
                m = _COMMENT_END.search(source, at + 2)
                pos = m.end() if m else end
            elif source[at + 1 : at + 2] in ("!", "?", "/"):
                stop = source.find(">", at)
                pos = end if stop < 0 else stop + 1
            elif named:
                break  # cut inside a tag: no ">" follows
            else:
                if not hidden:
                    run.append("<")
                pos = at + 1
            continue
        pos = m.end()
        tag = m[2].lower()
        if m[1]:
            k = len(stack) - 1
            while k > 0 and stack[k][0] != tag:
                k -= 1
            if k > 0:
                if tag not in INLINE:
                    flush()
                    pop(k)
                elif all(x[0] in INLINE for x in stack[k:]):
                    pop(k)
            elif tag == "br":
                run.append(" ")
            continue
        if tag == "br":
            run.append(" ")
            continue
        if tag in INLINE:
            if tag not in VOID and not m[3].endswith("/"):
                stack.append((tag, stack[-1][1], stack[-1][2]))
                depth_a += tag == "a"
            continue
        flush()
        if tag in CLOSES_P:
            k = len(stack) - 1
            while k > 0 and stack[k][0] in INLINE:
                k -= 1
            if stack[k][0] == "p":
                pop(k)
        if tag in FAMILY:
            same, stop_at = FAMILY[tag]
            k, found = len(stack) - 1, 0
            while k > 0 and stack[k][0] not in stop_at:
                if stack[k][0] in same:
                    found = k
                k -= 1
            if found:
                pop(found)
        if tag in VOID:
            continue
        if tag in RAW:
            stop = re.compile("</" + re.escape(tag) + r"(?=[\s/>])", re.I).search(source, pos)
            close = source.find(">", stop.end()) if stop else -1
            pos = end if close < 0 else close + 1
            continue
        if tag == "body":  # the head may not have been closed
            pop(1 if len(stack) > 1 and stack[1][0] != "html" else min(2, len(stack)))
        attrs = _attributes(m[3])
        up = stack[-1]
        label = int(attrs["data-y"]) if labelled and attrs.get("data-y") in ("0", "1") else up[2]
        if tag in HIDDEN:
            stack.append((tag, up[1], label))
            hidden += 1
            continue
        if not hidden:
            parent.append(up[1])
            features.append(_element_features(tag, attrs))
            groups.append(len(parent) - 1)
            texts.append(None)
            labels.append(label)
        stack.append((tag, len(parent) - 1 if not hidden else up[1], label))
    flush()
    _add_links(page, sizes)
    return page


def _add_links(page: Page, sizes: list[tuple[int, int, int]]) -> None:
    """Adds to the special features of elements how much of the text inside is links; ``sizes``: node, characters, linked ones."""
    n, linked = [0] * len(page.parent), [0] * len(page.parent)
    for i, a, b in sizes:
        n[i] += a
        linked[i] += b
    for i in range(len(n) - 1, 0, -1):
        n[page.parent[i]] += n[i]
        linked[page.parent[i]] += linked[i]
        if page.text[i] is None:
            share = "empty" if not n[i] else "none" if not linked[i] else "some" if 2 * linked[i] < n[i] else "most"
            page.features[i] += (f"{page.features[i][-1]} links={share}",)


FRAME, CONTENT, BOILERPLATE = 0, 1, 2
_LEAST = 1e-200
#: Elements of a more general kind that count beside those of a special one, and runs of all states beside those of one.
BACKOFF, PRIOR_RUNS = 4.0, 20.0


class Model:
    """Smoothed counts: edges[feature][parent state][state] of elements, texts[feature][state] and text_edge of runs."""

    def __init__(self, edges: dict[str, list[list[float]]], texts: dict[str, list[float]], base: list[list[float]], text_edge: list[list[float]], root: list[float]):
        self.counts, self.texts, self.base, self.text_edge, self.root = edges, texts, base, text_edge, root
        self._edges: dict[tuple, tuple] = {}

    def _backed(self, p, feature: str):
        """Counts of a feature under each parent state, backed by the more general ``p`` and, outside boilerplate, for marks by those under all parents."""
        n = self.counts.get(feature)
        if n is None:
            return p
        whole = [sum(row[b] for row in n) for b in range(3)]
        out = []
        for state, (row, prior) in enumerate(zip(n, p, strict=True)):
            behind = prior
            if "mark" in feature and state != BOILERPLATE:
                behind = [(q + (c + q) / (sum(whole) + 1)) / 2 for c, q in zip(whole, prior, strict=True)]
            out.append([(c + BACKOFF * q) / (sum(row) + BACKOFF) for c, q in zip(row, behind, strict=True)])
        return out

    def edge(self, features: tuple | None) -> tuple:
        """P(state | parent state) of an element by its features; of a run of text for None."""
        if features is None:
            return self.text_edge
        found = self._edges.get(features)
        if found is None:
            p = self.base
            if features:
                p = self._backed(p, features[0])
                single = [self._backed(p, f) for f in features[1:] if f.startswith("mark=")]
                if single:
                    p = [[sum(m[a][b] for m in single) / len(single) for b in range(3)] for a in range(3)]
                for f in features[-3:] if single else features[1:]:
                    p = self._backed(p, f)
            found = tuple(map(tuple, p))
            if len(self._edges) < 100_000:
                self._edges[features] = found
        return found

    def unary(self, page: Page, i: int, share: float = 1.0) -> tuple[float, float, float]:
        """Likelihood of a run's features in each state, to the power ``share``; text is content or boilerplate, never a frame."""
        b = c = 1.0
        for f in page.features[i]:
            x = self.texts.get(f)
            if x:
                b, c = b * x[1], c * x[2]
        return (0.0, b, c) if share == 1.0 else (0.0, b**share, c**share)

    @staticmethod
    def shares(page: Page) -> list[float]:
        """Weight of each run: one over the runs of its list or table."""
        n: dict[int, int] = {}
        for t, g in zip(page.text, page.group, strict=True):
            if t is not None:
                n[g] = n.get(g, 0) + 1
        return [1.0 if t is None else 1 / n[g] for t, g in zip(page.text, page.group, strict=True)]

    def marginals(self, page: Page) -> list[float]:
        """Content probability of every node by sum-product up and down the tree."""
        parent, n = page.parent, len(page.parent)
        below = [(1.0, 1.0, 1.0) if t is None else self.unary(page, i, w) for i, (t, w) in enumerate(zip(page.text, self.shares(page), strict=True))]
        edges = [self.edge(f if t is None else None) for f, t in zip(page.features, page.text, strict=True)]
        messages: list = [None] * n
        for i in range(n - 1, 0, -1):
            a, b, c = below[i]
            (t00, t01, t02), (t10, t11, t12), (t20, t21, t22) = edges[i]
            m0, m1, m2 = t00 * a + t01 * b + t02 * c, t10 * a + t11 * b + t12 * c, t20 * a + t21 * b + t22 * c
            messages[i] = (m0, m1, m2)
            k = parent[i]
            a, b, c = below[k]
            a, b, c = a * m0, b * m1, c * m2
            most = max(a, b, c) or 1.0
            below[k] = (max(a / most, _LEAST), max(b / most, _LEAST), max(c / most, _LEAST))
        belief, out = [None] * n, [0.0] * n
        for i in range(n):  # parents come first
            a, b, c = below[i]
            if i:
                (p0, p1, p2), (m0, m1, m2) = belief[parent[i]], messages[i]
                (t00, t01, t02), (t10, t11, t12), (t20, t21, t22) = edges[i]
                p0, p1, p2 = p0 / m0, p1 / m1, p2 / m2
                a, b, c = a * (t00 * p0 + t10 * p1 + t20 * p2), b * (t01 * p0 + t11 * p1 + t21 * p2), c * (t02 * p0 + t12 * p1 + t22 * p2)
            else:
                a, b, c = a * self.root[0], b * self.root[1], c * self.root[2]
            most = a + b + c
            belief[i] = (max(a / most, _LEAST), max(b / most, _LEAST), max(c / most, _LEAST))
            out[i] = b / most
        return out

    def blocks(self, source: str | None) -> list[str]:
        if not source:
            return []
        page = parse(source, labelled=False)
        return [t for t, p in zip(page.text, self.marginals(page), strict=True) if t is not None and p > 0.5]


def train(pages: list[str]) -> Model:
    """Counts states over pages whose elements carry ``data-y``; unlabelled elements are frames."""
    edges: dict[str, list[list[float]]] = {}
    texts: dict[str, list[float]] = {}
    base, text_edge, total = [[1.0] * 3 for _ in range(3)], [[0.1] * 3 for _ in range(3)], [0.0] * 3
    for source in pages:
        page = parse(source)
        states = [FRAME if y is None else CONTENT if y else BOILERPLATE for y in page.label]
        for i in range(1, len(states)):
            up, own = states[page.parent[i]], states[i]
            if page.text[i] is None:
                base[up][own] += 1
                for f in page.features[i]:
                    edges.setdefault(f, [[0.0] * 3 for _ in range(3)])[up][own] += 1
            else:
                text_edge[up][own] += 1
                total[own] += 1
                for f in page.features[i]:
                    texts.setdefault(f, [0.0] * 3)[own] += 1
    runs = sum(total) or 1.0
    likelihood = {f: [(x + PRIOR_RUNS * sum(c) / runs) / (t + PRIOR_RUNS) for x, t in zip(c, total, strict=True)] for f, c in texts.items()}
    share = lambda m: [[x / sum(row) for x in row] for row in m]
    return Model(edges, likelihood, share(base), share(text_edge), [0.98, 0.01, 0.01])


def labelled_pages(n: int = 1200, seed: int = 11) -> list[str]:
    """Pages of varied layout whose parts are labelled by ``data-y``."""
    rng = random.Random(seed)
    syllables = "ka lo mi ren ta vos ul pe dor in sha ne".split()

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))

    def words(a, z):
        return " ".join(word() for _ in range(rng.randint(a, z)))

    def sentences(a, z):
        return " ".join(words(4, 18).capitalize() + rng.choice("....!?") for _ in range(rng.randint(a, z)))

    def links(a, z):
        return [f'<a href="/{word()}">{words(1, 3)}</a>' for _ in range(rng.randint(a, z))]

    def cls(*names):
        return rng.choice(['class="{}"', 'id="{}"', 'class="x {}"']).format(rng.choice(names))

    def box(y, kinds, inner):
        tag, _, names = rng.choice(kinds).partition(" ")
        attr = " " + cls(*names.split()) if names else ""
        return f'<{tag}{attr} data-y="{y}">{inner}</{tag}>'

    def menu():
        items = links(3, 9)
        return box(0, ["nav", "nav menu navbar", "div menu navigation topbar", "ul nav menu", "div"], "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if rng.random() < 0.7 else " ".join(items))

    def head():
        return box(0, ["header", "div header masthead", "header header"], f"<h1>{words(1, 3)}</h1>" * rng.randint(0, 1) + f"<p>{words(2, 6)}</p>" * rng.randint(0, 1) + (f"<div>{words(1, 4)}</div>" if rng.random() < 0.5 else "") + "".join(links(0, 2)))

    def foot():
        return box(0, ["footer", "footer footer", "div footer copyright legal"], rng.choice(["&copy; ", "", "© 2020 ", "All rights reserved "]) + rng.choice([words(2, 6), sentences(1, 2), f"<p>{sentences(1, 2)}</p>", " ".join(links(2, 5))]))

    def advert():
        return box(0, ["div ad ads advert sponsored banner promo", "aside ad sponsored promo", "section ads promoted"], rng.choice([sentences(1, 3), f"<p>{sentences(1, 2)}</p>", words(2, 8), "".join(links(1, 2))]))

    def side():
        return box(0, ["aside", "aside sidebar widget related", "div sidebar widget related recommended"], f"<h3>{words(1, 3)}</h3>" + rng.choice(["<ul>" + "".join(f"<li>{x}</li>" for x in links(2, 7)) + "</ul>", f"<p>{sentences(1, 3)}</p>", sentences(1, 2)]))

    def notice():
        return box(0, ["div cookie notice consent alert gdpr popup", "section notice cookie", "dialog", "div alert modal overlay"], rng.choice([f"<p>{sentences(1, 3)}</p>", sentences(1, 2)]) + f"<button>{words(1, 2)}</button>" * rng.randint(0, 2))

    def form():
        return box(0, ["form", "form search newsletter login", "div form newsletter subscribe search"], rng.choice([f"<label>{words(1, 3)}</label><input><button>{words(1, 2)}</button>", f"<p>{words(3, 9)}</p><input><button>{words(1, 1)}</button>", f"<fieldset><legend>{words(1, 3)}</legend><select><option>{word()}</select></fieldset>"]))

    def talk():
        one = lambda: rng.choice(["<div class='comment'>{}</div>", "<li>{}</li>", "<article class='comment'>{}</article>", "<div>{}</div>"]).format(f"<p>{sentences(1, 4)}</p>" if rng.random() < 0.8 else f"<b>{word()}</b> {sentences(1, 2)}")
        return box(0, ["section comments discussion", "div comments replies respond", "ol comments", "ul comments", "aside comments"], f"<h2>{words(1, 2)}</h2>" * rng.randint(0, 1) + "".join(one() for _ in range(rng.randint(1, 5))))

    def share():
        return box(0, ["div share social tags", "ul tags social follow"], " ".join(links(1, 4)))

    def more():
        return box(0, ["div related recommended popular", "section related more trending"], f"<h3>{words(1, 3)}</h3>" + "<ul>" + "".join(f"<li>{x}</li>" for x in links(2, 7)) + "</ul>")

    def aside_note():
        return box(0, ["footer", "nav", "div share", "footer meta"], " ".join(links(2, 6)) if rng.random() < 0.7 else words(2, 8))

    def marked():
        """Parts of an article whose names other sites use for something else."""
        name = rng.choice(["warning", "message", "tip", "info-box", "callout", "caution", "important", "related-work", "more-details", "meta", "byline", "author-note", "date", "main-part", "side-effects", "section-header", "text", "story-body", "x1", "sec"])
        tag = rng.choice(["div", "section", "div", "aside"] if name in ("warning", "tip", "callout", "info-box", "important") else ["div", "section"])
        inner = words(2, 8) if name in ("meta", "byline", "author-note", "date") else "".join(f"<p>{sentences(1, 4)}</p>" for _ in range(rng.randint(1, 4))) if rng.random() < 0.8 else sentences(1, 3)
        return f'<{tag} {rng.choice(["class", "class", "id"])}="{name}">{inner}</{tag}>'

    def piece():
        kind = rng.random()
        if kind < 0.05:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in links(2, 8)) + "</ul>"
        if kind < 0.08:
            return f"<p>{links(1, 1)[0]}</p>"
        if kind < 0.14:
            return marked()
        if kind < 0.18:
            return rng.choice(["<section>{}</section>", "<div>{}</div>"]).format(f"<h2>{words(1, 6)}</h2><p>{sentences(1, 4)}</p>")
        if kind < 0.24:
            return f"<div>{rng.choice([words(1, 3), words(1, 9), sentences(1, 3)])}</div>"
        if kind < 0.68:
            text = sentences(1, 6)
            if rng.random() < 0.3:
                text = text.replace(" ", f' <a href="/x">{words(1, 2)}</a> ', 1)
            return rng.choice(["<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<div><p>{}</p></div>", "<p>{}</p>"]).format(text if rng.random() < 0.85 else words(1, 12))
        if kind < 0.78:
            return f"<h{(k := rng.randint(2, 4))}>{words(2, 8)}</h{k}>"
        if kind < 0.86:
            return rng.choice(["ul", "ol"]).join(["<", ">"]) + "".join(f"<li>{rng.choice([words(2, 9), sentences(1, 1)])}</li>" for _ in range(rng.randint(2, 5))) + "</ul>"
        if kind < 0.90:
            return f"<blockquote><p>{sentences(1, 2)}</p></blockquote>"
        if kind < 0.94:
            return f"<table><tr><th>{word()}<th>{word()}<tr><td>{words(1, 3)}<td>{words(1, 3)}</table>"
        if kind < 0.97:
            return f"<pre>{words(3, 12)}</pre>"
        return f"<figure><img><figcaption>{words(3, 10)}</figcaption></figure>"

    def article():
        parts = ([rng.choice(["<h1>{}</h1>", "<header><h1>{}</h1></header>", "<h1>{}</h1>"]).format(words(2, 9))] if rng.random() < 0.9 else []) + [piece() for _ in range(rng.randint(1, 12))]
        if rng.random() < 0.1:  # blocks without paragraphs
            parts = [f"<div>{rng.choice([words(1, 3), words(1, 9), sentences(1, 3)])}</div>" for _ in range(rng.randint(1, 6))]
        elif rng.random() < 0.03:  # one kind of part alone
            parts = [rng.choice([marked, lambda: "<ul>" + "".join(f"<li>{x}</li>" for x in links(2, 8)) + "</ul>", lambda: f"<p>{links(1, 1)[0]}</p>"])() for _ in range(rng.randint(1, 3))]
        for extra in (advert, share, side, notice, form, more, talk, aside_note):
            if rng.random() < 0.1:
                parts.insert(rng.randint(1, len(parts)), extra())
        return box(1, ["article", "article post entry", "main", "main content", "div content post entry article story", "section content article", "div"], "".join(parts))

    out = []
    for _ in range(n):
        parts = [f(*a) for p, f, *a in ((0.8, menu), (0.4, head), (0.4, notice), (0.5, advert), (0.2, form)) if rng.random() < p]
        rng.shuffle(parts)
        after = [f() for p, f in ((0.4, side), (0.4, talk), (0.3, form), (0.3, advert), (0.2, share), (0.2, more), (0.85, foot)) if rng.random() < p]
        main = article()
        if rng.random() < 0.15:
            main = f"<{(t := rng.choice(['main', 'div', 'section']))}>{main}</{t}>"
        body = "".join(parts) + main + "".join(after)
        for _ in range(rng.choice((0, 0, 0, 1, 1, 2, 3))):
            body = f"<div{' ' + cls('wrapper', 'page', 'container', 'site', 'wrap', 'outer', 'layout', 'row') if rng.random() < 0.8 else ''}>{body}</div>"
        out.append(f"<!DOCTYPE html><html><head><title>{words(2, 6)}</title></head><body>{body}" + "</body></html>" * rng.randint(0, 1))
    return out


def extract(pages: DataFrame, keep: list, html_col: str = "html", model: Model | None = None) -> DataFrame:
    """``row`` (struct of the ``keep`` columns) and ``blocks``, the main text's blocks in page order."""
    small_batches(pages.sparkSession)
    model = model or train(labelled_pages())
    rows = pages.select(F.struct(*keep).alias("row"), F.col(html_col).alias("html"))

    @trimmed
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([model.blocks(x) for x in b.column(1).to_pylist()], pa.list_(pa.string()))], names=["row", "blocks"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, blocks array<string>")


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract(table(spark, sf_dir, "pages"), [F.col("page_id"), F.col("url")])
    text = F.array_join("blocks", "\n\n")
    return out.select("row.page_id", "row.url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


QUERIES = {"op4_html_extraction": op4_html_extraction}
ORACLE: dict = {}
