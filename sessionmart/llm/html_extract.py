"""HTML extraction: main text of pages, by a linear-chain conditional random field over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags. Each has features of its
ancestors (tags, words of class, id and role) and of its text (length, share of link text, sentence ends, ...). A
two-label conditional random field (main text or not) is trained in numpy, by exact gradients
from forward-backward sums, on ``labelled_pages``: pages of many layouts built
here from random words, in which every block's label is known. Pages are decoded by Viterbi.

A text is the main blocks in page order: character references decoded, white space inside a block turned into one
space, blocks joined by one space. Null, empty or text-free html gives the empty text. Other columns
(``page_id``, ``url``, nulls among them) pass through; repeated rows each give a row.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 2000
SEED = 7

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title")
HIDDEN = frozenset("noscript template iframe svg".split())
BLOCK = frozenset("""address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html img input label legend li main menu nav ol option p pre
section select summary table tbody td tfoot th thead tr ul video""".split())
CLOSES_P = BLOCK - {"br", "button", "img", "input", "label", "option", "select", "body", "html", "td", "th", "tr", "li", "dd", "dt"}
SAME = {"li": ("li",), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "dt": ("dt", "dd"), "dd": ("dt", "dd")}
PART = frozenset("header footer nav aside form article main".split())
SCOPE = frozenset("table td th ul ol dl div section article aside nav form body".split())

_TOKEN = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*+"|'[^']*+'|[^"'>])*+|[^>]*)(?:>|\Z)""", re.S)
_ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_RAW_END = {t: re.compile(f"</{t}\\b[^>]*(?:>|\\Z)", re.I) for t in RAW}


class Element:
    """An open element: features of it and its ancestors, whether in a link, the nearest part of the page,
    words of the nearest class, id or role, and the hidden element it is or lies in."""

    __slots__ = ("tag", "feats", "link", "part", "near", "hidden")

    def __init__(self, tag: str, feats: frozenset, link: bool, part: str, near: frozenset, hidden: str = "") -> None:
        self.tag, self.feats, self.link, self.part, self.near, self.hidden = tag, feats, link, part, near, hidden


def blocks(page: str) -> list[tuple[str, frozenset, str, float]]:
    """Leaf blocks of a page in order: text, features of the ancestors, tag, share of link text."""
    stack = [Element("", frozenset(), False, "", frozenset())]
    out: list[tuple[str, frozenset, str, float]] = []
    pieces: list[str] = []
    linked, where, at = 0, stack[-1], 0

    def close_block() -> None:
        nonlocal pieces, linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                out.append((text, where.feats | where.near | {"part=" + where.part, f"{where.part}/{where.tag}"}, where.tag, min(1.0, linked / len(text))))
        pieces, linked = [], 0

    def add(raw: str) -> None:
        nonlocal linked, where
        if raw and not stack[-1].hidden:
            if not pieces or not where.feats:
                where = next((e for e in reversed(stack) if not e.tag or e.tag in BLOCK), stack[0])
            pieces.append(raw)
            if stack[-1].link:
                linked += len(raw)
    while at < len(page):
        m = _TOKEN.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCK and not (stack[-1].hidden and any(e.tag == tag and e.hidden for e in stack)):
                close_block()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPE and tag not in SCOPE:
                    break
            continue
        if tag in _RAW_END and not (m[3] or "").endswith("/"):
            end = _RAW_END[tag].search(page, at)
            at = end.end() if end else len(page)
            continue
        if stack[-1].hidden == "svg" and tag in BLOCK and not any(e.tag == "foreignobject" for e in stack):
            while stack[-1].hidden == "svg":  # a block ends an open drawing
                stack.pop()
        if tag in BLOCK and not stack[-1].hidden:
            close_block()
        if tag in VOID or tag == "head":  # what a head may hold has no text; all else is of the body
            continue
        ends = ("p",) if tag in CLOSES_P else SAME.get(tag, ())
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in ends:
                del stack[i:]
                if len(ends) == 1:
                    break
            elif stack[i].tag in SCOPE or stack[i].tag in HIDDEN:
                break
        parent = stack[-1]
        own, near = set(), parent.near
        if tag in BLOCK:
            own.add("in=" + tag)
        if m[3]:
            for a in _ATTR.finditer(m[3]):
                own.update("is=" + w.lower() for w in _WORD.findall(a[2] or a[3] or a[4] or "") if len(w) > 1)
            named = frozenset("near" + w[2:] for w in own if w.startswith("is="))
            near = named or near
        feats = parent.feats if own <= parent.feats else parent.feats | own
        stack.append(Element(tag, feats, parent.link or tag == "a", tag if tag in PART else parent.part, near,
                             parent.hidden or (tag if tag in HIDDEN and not (m[3] or "").endswith("/") else "")))
    close_block()
    return out


def features(found: list[tuple[str, frozenset, str, float]]) -> list[list[str]]:
    """Names of the features of each block of a page."""
    out = []
    n = len(found)
    for i, (text, up, tag, link) in enumerate(found):
        size = text.count(" ") + 1
        f = ["bias", "tag=" + tag, *up, f"words={min(6, size.bit_length())}", f"link={int(link * 3.99)}"]
        if text[-1] in ".!?\"”":
            f.append("sentence")
        if any(c in text for c in "©®") or "(c)" in text:
            f.append("mark")
        prose = size >= 8 and link < 0.3
        if prose:
            f.append("prose")
        if not any(x.startswith("near=") for x in up):
            f.append(f"unnamed={prose}")
            if any(c in text for c in "©®"):
                f.append("unnamed mark")
        if i:
            f.append("before=" + found[i - 1][2])
            if found[i - 1][1] == up:
                f.append("same-before")
        if i + 1 < n and found[i + 1][1] == up:
            f.append("same-behind")
        out.append(f)
    return out


class Crf:
    """Two labels; weights of features (for label 1), of the start and of transitions."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, start: np.ndarray, trans: np.ndarray) -> None:
        self.names, self.weights, self.start, self.trans = names, weights, start, trans
        self.weight = dict(zip(names, weights.tolist()))

    def decode(self, feats: list[list[str]]) -> list[int]:
        """Labels of the best path (Viterbi); ties go to label 0."""
        get = self.weight.get
        (t00, t01), (t10, t11) = self.trans.tolist()
        back, (a, b) = [], self.start.tolist()
        for i, f in enumerate(feats):
            e = sum(get(x, 0.0) for x in f)
            if i == 0:
                b += e
                continue
            a0, b0 = a + t00, b + t10
            a1, b1 = a + t01, b + t11
            back.append((b0 > a0, b1 > a1))
            a, b = max(a0, b0), max(a1, b1) + e
        if not feats:
            return []
        path = [int(b > a)]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], steps: int = 140, rate: float = 0.2, l2: float = 1e-4,
          least: int = 4) -> Crf:
    """Maximum likelihood of labelled sequences by full-batch gradients (Adam); rare features are left out."""
    count: dict[str, int] = {}
    for feats, _ in pages:
        for f in {x for block in feats for x in block}:
            count[f] = count.get(f, 0) + 1
    names = {f: i for i, f in enumerate(sorted(f for f, c in count.items() if c >= least))}
    n, t = len(pages), max(len(y) for _, y in pages)
    width = max(sum(x in names for x in b) for feats, _ in pages for b in feats)
    idx = np.full((n, t, width), len(names), np.int32)
    y, real = np.zeros((n, t), np.int64), np.zeros((n, t), bool)
    for k, (feats, labels) in enumerate(pages):
        real[k, :len(labels)], y[k, :len(labels)] = True, labels
        for i, b in enumerate(feats):
            codes = [names[x] for x in b if x in names]
            idx[k, i, :len(codes)] = codes
    w = np.zeros(len(names) + 7)  # features, nothing, start (2), transitions (4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    f1 = len(names) + 1
    rows = np.arange(n)
    flat = idx[real]
    gold = np.zeros_like(w)
    gold[:f1] = np.bincount(flat.ravel(), weights=np.repeat(y[real], width), minlength=f1)
    gold[f1:f1 + 2] = np.bincount(y[:, 0], minlength=2)
    pair = real[:, 1:]
    gold[f1 + 2:] = np.bincount((y[:, :-1] * 2 + y[:, 1:])[pair], minlength=4)
    for step in range(1, steps + 1):
        emit = np.zeros((n, t, 2))
        emit[..., 1] = w[idx].sum(axis=2)
        start, trans = w[f1:f1 + 2], w[f1 + 2:].reshape(2, 2)
        alpha = np.zeros((n, t, 2))
        beta = np.zeros((n, t, 2))
        alpha[:, 0] = start + emit[:, 0]
        for i in range(1, t):
            a = np.logaddexp(alpha[:, i - 1, :1] + trans[0], alpha[:, i - 1, 1:] + trans[1]) + emit[:, i]
            alpha[:, i] = np.where(real[:, i, None], a, alpha[:, i - 1])
        z = np.logaddexp(alpha[rows, -1, 0], alpha[rows, -1, 1])
        for i in range(t - 2, -1, -1):
            nxt = emit[:, i + 1] + beta[:, i + 1]
            b = np.logaddexp(nxt[:, :1] + trans[:, 0], nxt[:, 1:] + trans[:, 1])
            beta[:, i] = np.where(real[:, i + 1, None], b, 0.0)
        prob = np.exp(alpha + beta - z[:, None, None])
        want = np.zeros_like(w)
        want[:f1] = np.bincount(flat.ravel(), weights=np.repeat(prob[..., 1][real], width), minlength=f1)
        want[f1:f1 + 2] = prob[:, 0].sum(axis=0)
        both = (alpha[:, :-1, :, None] + trans + (emit + beta)[:, 1:, None, :] - z[:, None, None, None])
        want[f1 + 2:] = np.exp(both[pair]).sum(axis=0).ravel()
        g = (gold - want) / n - l2 * w
        g[len(names)] = 0
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w += rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return Crf(names, w[:len(names)].copy(), w[f1:f1 + 2].copy(), w[f1 + 2:].reshape(2, 2).copy())


# Words that pages use for the parts of their layout, in class and id attributes.
PARTS = {
    "menu": ["nav", "navbar", "menu", "main-menu", "navigation", "top-nav", "site-nav", "topbar", "breadcrumb", "breadcrumbs", "tabs", "toc"],
    "header": ["header", "site-header", "masthead", "page-header", "top", "branding", "logo", "banner", "hero"],
    "footer": ["footer", "site-footer", "page-footer", "bottom", "copyright", "colophon", "legal", "foot"],
    "sidebar": ["sidebar", "side-bar", "side", "widget", "widgets", "rail", "right-column", "related", "related-posts", "recommended",
                "trending", "popular", "most-read", "archive", "tags", "more-stories", "see-also", "teaser"],
    "notice": ["notice", "cookie", "cookie-banner", "cookie-notice", "consent", "gdpr", "alert", "disclaimer", "warning", "popup", "modal",
               "overlay", "paywall", "message", "announcement", "privacy-notice", "toast", "info-bar"],
    "ad": ["ad", "ads", "advert", "advertisement", "adbox", "ad-slot", "sponsored", "sponsor", "promo", "promotion", "banner-ad", "partner", "dfp",
           "adsbygoogle", "commercial", "offer"],
    "form": ["form", "newsletter", "subscribe", "signup", "sign-up", "login", "search", "search-form", "contact-form", "subscription", "register"],
    "comments": ["comments", "comment", "comment-list", "reader-comments", "discussion", "responses", "replies", "reply", "respond", "disqus",
                 "comment-body", "user-comments", "feedback", "reviews", "comment-text"],
    "share": ["share", "social", "social-links", "sharing", "share-buttons", "follow", "byline-share"],
}
MAIN_NAMES = ["content", "post", "post-content", "entry", "entry-content", "article", "article-body", "article-content", "story", "story-body",
              "main", "main-content", "text", "body-text", "page-content", "blog-post", "single", "wrapper", "container", "column", "page", "inner"]
ROLES = {"menu": "navigation", "header": "banner", "footer": "contentinfo", "sidebar": "complementary", "form": "search"}
TAGS = {"menu": ["nav", "div", "ul", "nav"], "header": ["header", "div"], "footer": ["footer", "div", "footer"],
        "sidebar": ["aside", "div", "section", "aside"], "notice": ["div", "section", "aside", "p"], "ad": ["div", "aside", "section", "ins", "p"],
        "form": ["form", "div", "section"], "comments": ["section", "div", "ol", "ul", "aside"], "share": ["div", "ul", "p"]}


class PageMaker:
    """Random pages whose blocks are known to be main text or not."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)
        parts = ["lo", "ra", "ti", "men", "sol", "ve", "qua", "ner", "is", "dor", "ba", "ket", "ul", "pri", "éan", "ös", "th", "ing", "en"]
        self.vocabulary = ["".join(self.r.choices(parts, k=self.r.randint(1, 4))) for _ in range(800)]

    def words(self, lo: int, hi: int, stop: bool = True) -> str:
        w = self.r.choices(self.vocabulary, k=self.r.randint(lo, hi))
        for i in range(6, len(w) - 2, self.r.randint(6, 14)):
            w[i] += self.r.choice([".", ",", ".", "!", "?"])
        if self.r.random() < 0.1:  # listings and decorated words
            w = [x + self.r.choice(["***", " |", "%", "$", "#"]) for x in w]
        text = " ".join(w).capitalize() + ("." if stop else "")
        return text.replace("ing ", "ing &amp; ", 1) if self.r.random() < 0.05 else text

    def named(self, part: str, inner: str, bare: float = 0.0) -> str:
        tag = self.r.choice(TAGS[part])
        name = self.r.choice(PARTS[part])
        if part in ("menu", "footer") and self.r.random() < 0.12:
            return f"<div>{inner}</div>"
        if part in ROLES and self.r.random() < 0.12:
            return f'<div role="{ROLES[part]}">{inner}</div>'
        attr = self.r.choice([f' class="{name}"', f' id="{name}"', f' class="{name} x{self.r.randint(1, 9)}"', f" class='box {name}'", f' id={name}'])
        if tag in ("nav", "header", "footer", "aside", "form") and self.r.random() < 0.6 or self.r.random() < bare:
            attr = ""
        if not attr and tag in ("div", "p", "section", "ul", "ol"):
            attr = f' class="{name}"'
        return f"<{tag}{attr}>{inner}</{tag}>"

    def links(self, lo: int, hi: int) -> str:
        items = [f'<a href="/{i}">{self.words(1, 4, False)}</a>' for i in range(self.r.randint(lo, hi))]
        kind = self.r.random()
        if kind < 0.6:
            return "<ul>" + "".join(f"<li>{x}" + ("</li>" if self.r.random() < 0.9 else "") for x in items) + "</ul>"
        return " | ".join(items) if kind < 0.8 else "".join(f"<div>{x}</div>" for x in items)

    def prose(self, lo: int = 1, hi: int = 3) -> str:
        kind = self.r.random()
        if kind < 0.3:
            return self.words(3, 30)
        return "".join(f"<p>{self.words(3, 40)}</p>" for _ in range(self.r.randint(lo, hi)))

    def extra(self, part: str) -> str:
        r = self.r
        if part == "menu":
            return self.named(part, self.links(2, 9))
        if part == "header":
            title = f"<{(h := r.choice(['h1', 'h2', 'div', 'p', 'span']))}>{self.words(1, 6, False)}</{h}>"
            return self.named(part, title + (f"<p>{self.words(3, 12, r.random() < 0.5)}</p>" if r.random() < 0.5 else "") + (self.links(2, 6) if r.random() < 0.4 else ""))
        if part == "footer":
            body = r.choice(["&copy; ", "© ", "Copyright ", "&copy; 2024 &middot; ", "", ""]) + self.words(2, 14, r.random() < 0.6)
            return self.named(part, (f"<p>{body}</p>" if r.random() < 0.5 else body) + (self.links(1, 5) if r.random() < 0.4 else ""))
        if part == "sidebar":
            head = f"<h3>{self.words(1, 4, False)}</h3>" if r.random() < 0.6 else ""
            return self.named(part, head + (self.links(2, 8) if r.random() < 0.5 else self.prose()))
        if part == "form":
            field = f'<label for="e">{self.words(1, 4, False)}</label><input type="text" name="e">'
            pick = "<select>" + "".join(f"<option>{self.words(1, 2, False)}" for _ in range(3)) + "</select>" if r.random() < 0.3 else ""
            lead = f"<p>{self.words(3, 20)}</p>" if r.random() < 0.6 else ""
            body = f"{lead}{field}{pick}<button>{self.words(1, 2, False)}</button>"
            return self.named(part, body if r.random() < 0.6 else f'<form action="/s">{body}</form>')
        if part == "comments":
            one = lambda: self.named("comments", (f"<b>{self.words(1, 2, False)}</b> " if r.random() < 0.5 else "") + self.prose(1, 2))
            head = f"<h2>{self.words(1, 3, False)}</h2>" if r.random() < 0.6 else ""
            if r.random() < 0.15:
                one = lambda: f'<article class="{r.choice(PARTS["comments"])}"><p>{self.words(3, 40)}</p></article>'
            body = "".join(one() if r.random() < 0.7 else f"<li><p>{self.words(3, 40)}</p></li>" if r.random() < 0.5 else f"<div><p>{self.words(3, 40)}</p></div>"
                           for _ in range(r.randint(1, 5)))
            return self.named(part, head + body)
        if part == "share":
            return self.named(part, self.links(2, 5))
        return self.named(part, self.prose(1, 2) if r.random() < 0.7 else self.words(2, 20, r.random() < 0.7))

    def main(self) -> str:
        """Blocks of main text, marked by data-main comments around the body's own extras."""
        r, out = self.r, []
        for _ in range(r.randint(1, 9)):
            kind = r.random()
            if kind < 0.5:
                out.append(f"<p>{self.words(1, 90, r.random() < 0.7)}" + ("</p>" if r.random() < 0.9 else ""))
            elif kind < 0.62:
                out.append(f"<p><b>{self.words(2, 14, r.random() < 0.7)}" + r.choice(["</b>", ""]) + "<br>")
            elif kind < 0.72:
                out.append(f"<h{(k := r.randint(2, 4))}>{self.words(1, 8, False)}</h{k}>")
            elif kind < 0.78:
                out.append("<ul>" + "".join(f"<li>{self.words(2, 18, r.random() < 0.6)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif kind < 0.83:
                out.append(f"<blockquote>{self.words(4, 40)}</blockquote>")
            elif kind < 0.88:
                out.append(f'<p>{self.words(3, 30)} <a href="http://x.example">{self.words(1, 3, False)}</a> {self.words(2, 20)}</p>')
            elif kind < 0.91:
                out.append(f"<figure><img src='x'><figcaption>{self.words(2, 12)}</figcaption></figure>")
            elif kind < 0.94:
                out.append("<table>" + "".join(f"<tr><td>{self.words(1, 4, False)}<td>{self.words(1, 4, False)}" for _ in range(2)) + "</table>")
            else:
                out.append(f"<div>{self.words(3, 60, r.random() < 0.7)}</div>")
        return out

    def page(self) -> tuple[str, str]:
        """A page, and the same page with the text of every main block replaced by a mark."""
        r = self.r
        body = self.main()
        title = f"<h1>{self.words(2, 12, False)}</h1>" if r.random() < 0.75 else ""
        parts = [(x, True) for x in ([title] if title else []) + body]
        for part, p in (("ad", 0.3), ("ad", 0.1), ("sidebar", 0.15), ("form", 0.2), ("share", 0.15), ("notice", 0.2), ("menu", 0.05)):
            if r.random() < p:
                parts.insert(r.randint(0, len(parts)), (self.extra(part), False))
        for part, p in (("comments", 0.2), ("sidebar", 0.1), ("footer", 0.06)):
            if r.random() < p:
                parts.append((self.extra(part), False))
        tag, name = r.choice(["article", "article", "article", "main", "div", "div", "section", "td"]), r.choice(MAIN_NAMES)
        attr = f' class="{name}"' if r.random() < 0.5 else f' id="{name}"' if r.random() < 0.4 else ' role="main"' if r.random() < 0.1 else ""
        bare = r.random() < 0.2  # no element of its own around the text
        around = parts if bare else [(f"<table><tr>{'<td>' + self.links(2, 5) + '</td>' if r.random() < 0.5 else ''}<td>" if tag == "td" else f"<{tag}{attr}>", False), *parts,
                  ("</td></tr></table>" if tag == "td" else f"</{tag}>", False)]
        if r.random() < 0.4:
            outer = r.choice(["main", "div", "section"])
            around = [(f'<{outer} class="{r.choice(MAIN_NAMES)}">', False), *around, *([(self.extra("sidebar"), False)] if r.random() < 0.4 else []), (f"</{outer}>", False)]
        before = [self.extra(p) for p, q in (("notice", 0.25), ("header", 0.5), ("menu", 0.75), ("ad", 0.4), ("form", 0.15), ("sidebar", 0.2)) if r.random() < q]
        after = [self.extra(p) for p, q in (("share", 0.15), ("comments", 0.35), ("sidebar", 0.3), ("ad", 0.25), ("form", 0.2), ("footer", 0.8), ("notice", 0.15)) if r.random() < q]
        if r.random() < 0.5:
            r.shuffle(before)
        before, after = [] if r.random() < 0.35 else before, [] if r.random() < 0.35 else after
        whole = [("<!DOCTYPE html><html><head><title>" + self.words(1, 6) + "</title><style>p{}</style><script>var a='</p>';</script></head><body>", False),
                 *((x, False) for x in before), *around, *((x, False) for x in after), ("</body></html>" if r.random() < 0.8 else "", False)]
        return ("".join(x for x, _ in whole),
                "".join(re.sub(r">([^<]*[^<\s][^<]*)", lambda m: ">☃", x) if is_main else x for x, is_main in whole))


def labelled_pages(n: int = TRAIN_PAGES, seed: int = SEED) -> list[tuple[str, list[int]]]:
    """Pages with a label for each leaf block (1: main text)."""
    maker, out = PageMaker(seed), []
    while len(out) < n:
        page, marked = maker.page()
        labels = [int("☃" in b[0]) for b in blocks(marked)]
        if labels and len(labels) == len(blocks(page)):
            out.append((page, labels))
    return out


@functools.cache
def train_default(n: int = TRAIN_PAGES, seed: int = SEED) -> Crf:
    """The model of the built pages, trained once a process."""
    return train([(features(blocks(p)), y) for p, y in labelled_pages(n, seed)])


def main_text(model: Crf, page: str | None) -> tuple[str, list[str]]:
    """Main text of a page and its blocks."""
    found = blocks(page or "")
    keep = [b[0] for b, y in zip(found, model.decode(features(found))) if y]
    return " ".join(keep), keep


def _extract_rows(model, columns: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        crf = model.value
        for pdf in batches:
            out = pdf[columns].copy()
            got = [main_text(crf, h) for h in pdf["html"]]
            out["text"] = pd.Series([t for t, _ in got], index=out.index, dtype=object)
            out["blocks"] = pd.Series([b for _, b in got], index=out.index, dtype=object)
            yield out
    return run


def extract(pages: DataFrame, model: Crf | None = None) -> DataFrame:
    """The rows of ``pages`` (html, ...) with ``text`` and ``blocks`` (its main blocks) in place of ``html``.

    Input columns named ``text`` or ``blocks`` are replaced.

    The model (some hundred weights) is trained on the driver, once a process, unless given, and sent to the tasks.
    """
    spark = pages.sparkSession
    columns = [c for c in pages.columns if c not in ("html", "text", "blocks")]
    shape = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(columns).schema.fields)
    sent = spark.sparkContext.broadcast(model or train_default())
    return (pages.select(*columns, F.col("html").cast("string").alias("html"))
            .mapInPandas(_extract_rows(sent, columns), shape + ", text string, blocks array<string>"))
