"""Main text of web pages by a linear-chain conditional random field.

A page is cut into leaf blocks, the runs of text between block-level tags; each block is described by its ancestors'
tags, classes and ids and by its text.  The field labels the sequence main or other; it is trained by gradient
ascent on the likelihood of labelled pages and decoded by Viterbi.  Labelled pages are a parameter; the default ones
are made from page templates (``labelled_pages``), as the pages table carries no labels.
"""

from __future__ import annotations

import html
import random
import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from finlens.llm.kit import arrow_map

_NAME = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_EVENT = re.compile("[>\"']")
# Elements whose content is no markup up to their end tag.
RAW = frozenset("script style template textarea title noscript svg iframe".split())
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
# HTML's inline elements, which do not end a block, and elements without content.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr br img input label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Start tags that close an open element of these names before they open.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "body": ("head",)}
SCOPES = frozenset("ul ol dl table article aside section div nav header footer main form body html select".split())


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """Positions of ``>`` and quotes, and for each where a tag that reaches it outside quotes ends (-1: nowhere).  One pass
    from the right; a quote that is never closed is an ordinary character."""
    at = [m.start() for m in _EVENT.finditer(page)]
    ends = [-1] * len(at)
    plain, within = -1, {'"': None, "'": None}  # where a tag ends from here: outside quotes, and inside each kind
    for k in range(len(at) - 1, -1, -1):
        sign = page[at[k]]
        if sign == ">":
            plain = at[k]
        else:
            inside = within[sign]
            within[sign] = plain  # this quote closes an earlier one
            plain = plain if inside is None else inside
        ends[k] = plain
    return at, ends


def _tokens(page: str):
    """(kind, value, attributes) of a page: text, raw (name and content), start and end tags.  Time is linear in the page, cut
    off or ill-formed as it may be; what looks like a tag but ends nowhere is text."""
    at, ends = _tag_ends(page)
    done = pos = 0
    while True:
        i = page.find("<", pos)
        if i < 0:
            break
        name = _NAME.match(page, i)
        if name:
            k = bisect_left(at, name.end())
            stop = ends[k] if k < len(at) else -1
        elif page.startswith("<!--", i):
            stop = page.find("-->", i + 4)
            stop = len(page) if stop < 0 else stop + 2
        elif page.startswith(("<!", "<?"), i):
            stop = page.find(">", i)
        else:
            stop = -1
        if stop < 0:
            if not at or i > at[-1]:
                break  # nothing ends behind here
            pos = i + 1
            continue
        if i > done:
            yield "text", page[done:i], ""
        done = pos = min(stop + 1, len(page))
        if name:
            tag = name[2].lower()
            if name[1]:
                yield "end", tag, ""
            elif tag in RAW:
                close = _RAW_END[tag].search(page, done)
                yield "raw", tag, page[done : close.start() if close else len(page)]
                done = pos = close.end() if close else len(page)
            else:
                yield "start", tag, page[name.end() : stop]
    if done < len(page):
        yield "text", page[done:], ""


def _without_tags(text: str) -> str:
    cut = text.rfind(">") + 1
    return re.sub(r"<[^>]*>", " ", text[:cut]) + text[cut:]


def blocks(page: str, known=None) -> list[tuple]:
    """(text, (features of the ancestors, parent's tag), share of link text) of the leaf blocks with text, in page order.

    An open element shares its parent's feature set unless it adds to it; ``known`` names the features that count, so a set
    stays small however deep the page nests."""
    out, chunks, linked, links = [], [], 0, 0
    stack: list[tuple[str, frozenset]] = []
    open_: dict[str, int] = {}            # open elements by name,
    scopes: list[dict[str, int]] = [{}]   # and by name since the last scope element

    def flush():
        nonlocal chunks, linked
        if chunks:
            text = " ".join("".join(chunks).split())
            if text:
                out.append((text, (stack[-1][1], stack[-1][0]) if stack else (frozenset(), ""), linked / max(1, sum(map(len, chunks)))))
            chunks, linked = [], 0

    def push(name: str, features):
        base = stack[-1][1] if stack else frozenset()
        new = {f for f in features if known is None or f in known} - base
        stack.append((name, base | new if new else base))
        open_[name] = open_.get(name, 0) + 1
        if name in SCOPES:
            scopes.append({})
        scopes[-1][name] = scopes[-1].get(name, 0) + 1

    def close(name: str, within: bool = False):
        if not (scopes[-1] if within else open_).get(name):
            return
        while True:
            top = stack.pop()[0]
            open_[top] -= 1
            scopes[-1][top] -= 1
            if top in SCOPES:
                scopes.pop()
            if top == name:
                return

    def add(raw: str):
        nonlocal linked
        text = html.unescape(raw)
        chunks.append(text)
        linked += len(text) if links else 0

    for kind, name, rest in _tokens(page):
        if kind == "text":
            add(name)
        elif kind == "raw":
            if name in ("title", "noscript", "textarea"):
                flush()
                push(name, ["in:" + name])
                add(_without_tags(rest))
                flush()
                close(name)
        elif name in INLINE:
            if name == "a":
                links = max(0, links + (-1 if kind == "end" else 1))
            elif name == "br":
                chunks.append(" ")
        else:
            flush()
            if kind == "end":
                close(name)
                continue
            if not any(x[0] == "button" for x in stack[-3:]):
                close("p", within=True)
            for other in CLOSES.get(name, ()):
                close(other, within=other not in ("head",))
            if name in VOID:
                continue
            features = ["in:" + name]
            for a in _ATTR.finditer(rest):
                features += ["at:" + t for t in _SPLIT.split((a[2] or a[3] or a[4] or "").lower()) if t and not t.isdigit()]
            push(name, features)
            links = 0
    flush()
    return out


def _described(items) -> list[list[str]]:
    """Features of each block of a page besides its ancestors'."""
    out, n = [], len(items)
    for i, (text, (_, parent), density) in enumerate(items):
        words, size = text.count(" ") + 1, len(text)
        f = ["tag:" + parent, "bias", f"words:{min(words, 1 << 8).bit_length()}", f"links:{int(density * 4)}",
             "stop" if text[-1] in ".!?…\"'»”" else "open", f"commas:{min(text.count(','), 4)}"]
        if size < 60 and not text[-1] in ".!?":
            f.append("short")
        if "©" in text or "(c)" in text[:12].lower():
            f.append("copyright")
        if i == 0:
            f.append("first")
        if i == n - 1:
            f.append("last")
        out.append(f)
    # what stands around a block: prose before and after it, a heading above, its place
    prose = [density < 0.5 and text[-1] in ".!?…\"'»”" and text.count(" ") >= 5 for text, _, density in items]
    headed = False
    for i, f in enumerate(out):
        f += [f"before:{i > 0 and prose[i - 1]}", f"after:{i < n - 1 and prose[i + 1]}", f"place:{4 * i // n}"]
        if prose[i]:
            f.append("prose")
            if (i and prose[i - 1]) or (i < n - 1 and prose[i + 1]):
                f.append("prose run")
        if headed:
            f.append("headed")
        headed = headed or items[i][1][1] in ("h1", "h2")
    return out


@dataclass(frozen=True)
class Field:
    """weights: feature to its score for main over other; move: scores of (from, to) labels, 1 is main."""

    weights: dict
    move: tuple

    def label(self, items) -> list[bool]:
        """Most likely labels of a page's blocks, by Viterbi."""
        w, ((a, b), (c, d)) = self.weights, self.move
        back, other, main = [], 0.0, 0.0
        inside: dict[frozenset, float] = {}  # blocks under the same elements share their set
        for k, (f, item) in enumerate(zip(_described(items), items, strict=True)):
            around = item[1][0]
            if around not in inside:
                inside[around] = sum(w.get(x, 0.0) for x in sorted(around))
            gain = inside[around] + sum(w.get(x, 0.0) for x in f)
            if k:
                from_main = (c + main > a + other, d + main > b + other)
                other, main = max(a + other, c + main), max(b + other, d + main)
                back.append(from_main)
            main += gain
        labels = [main > other] if items else []
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def train(pages: list[list[tuple]], rounds: int = 8, rate: float = 0.2, penalty: float = 1e-4, seed: int = 5) -> Field:
    """pages: for each, its blocks as blocks() gives them, and a label.  Stochastic gradient ascent (Adagrad) on the
    conditional log-likelihood, whose expectations come from the forward-backward recursions."""
    number: dict[str, int] = {}
    rows = []
    for p in pages:
        if p:
            f = [np.array([number.setdefault(x, len(number)) for x in [*sorted(b[1][0]), *fs]]) for fs, b in zip(_described([b[:3] for b in p]), p, strict=True)]
            rows.append((f, np.array([b[3] for b in p], int)))
    w, move = np.zeros(len(number)), np.zeros((2, 2))
    gw, gm = np.full(len(number), 1e-6), np.full((2, 2), 1e-6)
    rng = random.Random(seed)
    for _ in range(rounds):
        rng.shuffle(rows)
        for f, y in rows:
            n = len(f)
            gain = np.zeros((n, 2))
            gain[:, 1] = [w[x].sum() for x in f]
            front, behind = np.zeros((n, 2)), np.zeros((n, 2))
            front[0] = gain[0]
            for i in range(1, n):
                front[i] = gain[i] + np.logaddexp(front[i - 1, 0] + move[0], front[i - 1, 1] + move[1])
            for i in range(n - 2, -1, -1):
                right = gain[i + 1] + behind[i + 1]
                behind[i] = np.logaddexp(move[:, 0] + right[0], move[:, 1] + right[1])
            z = np.logaddexp(*front[-1])
            off = y - np.exp(front[:, 1] + behind[:, 1] - z)
            moved = np.zeros((2, 2))
            for i in range(1, n):
                pair = np.exp(front[i - 1][:, None] + move + (gain[i] + behind[i])[None, :] - z)
                moved -= pair
                moved[y[i - 1], y[i]] += 1
            at = np.concatenate(f)
            g = np.bincount(at, np.repeat(off, [len(x) for x in f]), len(w))
            some = np.unique(at)
            g = g[some] - penalty * w[some]
            gw[some] += g**2
            w[some] += rate * g / np.sqrt(gw[some])
            gm += moved**2
            move += rate * moved / np.sqrt(gm)
    return Field({x: float(w[i]) for x, i in number.items()}, tuple(map(tuple, move.tolist())))


# -- labelled pages ------------------------------------------------------------------------------------------
# Each kind: how its box may be written, and what stands in it.
_MAIN = ("article", "article class=post", "main", "div class=content", "div class='post-content'", "div id=article-body",
         "section class=entry-content", "div class='story body'", "div id=main role=main", "div class=text")
_OTHER = {
    "nav": ("nav", "ul class=menu", "div class=navbar", "div class=breadcrumbs", "nav class=pagination", "div id=navigation", "div role=navigation"),
    "header": ("header", "div class=header", "div id=masthead", "header class='site-header'", "div class=banner", "div role=banner"),
    "footer": ("footer", "div class=footer", "div id=footer", "footer class='site-footer'", "div class=copyright", "div role=contentinfo"),
    "side": ("aside", "div class=sidebar", "div id=sidebar", "aside class=related", "div class=widget", "div class='related-posts'", "section class=recommended", "div role=complementary"),
    "notice": ("div class=notice", "div class='cookie-banner'", "div id=cookie-consent", "div class=alert role=alert", "div class=newsletter", "div class='subscribe'", "div class=consent", "div class=gdpr", "p class=notice", "section class=notice", "div role=dialog class=popup", "div class=message"),
    "ad": ("div class=ad", "div class=ads", "div class=advert", "div class='sponsored'", "div id=ad-top", "aside class=promo", "div class='advertisement'", "section class=ad", "p class=ad", "div class=promotion"),
    "form": ("form", "form class=search", "form id=login", "form class=contact", "div class=search-form"),
    "comments": ("section class=comments", "div id=comments", "ol class='comment-list'", "div class=comment", "section id=discussion", "div class='reader-comments'", "div class=replies", "ul class=comments", "div class=responses"),
}


def _box(spec: str, body: str) -> str:
    return f"<{spec}>{body}</{spec.split()[0]}>"


# Kinds that their links and short texts tell from an article even in a box without a name.
_NAMELESS = ("nav", "footer", "form")


def labelled_pages(n: int = 700, seed: int = 3, plain: float = 0.3) -> list[list[tuple]]:
    """Blocks with labels of pages made from the templates above, in words of random letters; the same for a seed.  A share ``plain``
    has its article in a box without a telling name, or in none."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghiklmnoprstuvwz") for _ in range(r.randint(2, 9)))
    mark = "\x02"  # stands at the start of each main block until it is read off as the label

    def text(lo, hi, stop=None):
        t = " ".join(word() for _ in range(r.randint(lo, hi))).capitalize()
        return t + (r.choice([".", ".", ".", "?", "!"]) if (r.random() < 0.85 if stop is None else stop) else "")

    def prose(few=False):
        return " ".join(text(3, 16) + ("," if r.random() < 0.1 else "") for _ in range(1 if few else r.randint(1, 7)))

    def items(lo, hi, tag="li"):
        return "".join(f"<{tag}><a href=/{word()}>{text(1, 4, False)}</a></{tag}>" for _ in range(r.randint(lo, hi)))

    def other(kind):
        if kind == "nav":
            body = items(2, 8) if r.random() < 0.7 else " ".join(f"<a href=/x>{word()}</a>" for _ in range(r.randint(2, 6)))
            body = f"<ul>{body}</ul>" if body.startswith("<li") else body
        elif kind == "header":
            body = r.choice(["", f"<h1>{text(1, 4, False)}</h1>", f"<p>{prose(True)}</p>", f"<div class=logo>{word()}</div>"]) + (f"<ul>{items(2, 5)}</ul>" if r.random() < 0.5 else "")
        elif kind == "footer":
            body = r.choice(["&copy; ", "", f"<p>&copy; 20{r.randint(10, 29)} "]) + f"{word()}.example.com &middot; " + prose(r.random() < 0.5)
        elif kind == "side":
            body = f"<h3>{text(1, 4, False)}</h3>" + (f"<ul>{items(2, 6)}</ul>" if r.random() < 0.6 else f"<p>{prose()}</p>")
        elif kind in ("notice", "ad"):
            body = r.choice([prose(), f"<p>{prose()}</p>", f"<strong>{text(1, 3)}</strong> {prose(True)}", f"<p>{prose(True)}</p><button>{word()}</button>"])
        elif kind == "form":
            body = f"<label>{word()}</label><input name=q>" + r.choice(["", f"<p>{prose(True)}</p>", f"<select><option>{word()}<option>{word()}</select>"]) + f"<button>{word()}</button>"
        else:
            one = lambda: r.choice([f"<li><p>{prose()}</p></li>", f"<div class=comment><b>{word()}</b><p>{prose()}</p></div>", f"<p>{prose()}</p>", f"<div class=reply>{prose()}</div>"])
            body = (f"<h2>{text(1, 3, False)}</h2>" if r.random() < 0.6 else "") + "".join(one() for _ in range(r.randint(1, 5)))
        if kind in _NAMELESS and r.random() < 0.2:
            return _box(r.choice(["div", f"div class={word()}", f"div id={word()}"]), body)
        return _box(r.choice(_OTHER[kind]), body)

    def article():
        parts = [f"<h1>{mark}{text(3, 12, r.random() < 0.4)}</h1>"] if r.random() < 0.9 else []
        for _ in range(r.randint(1, 8)):
            x = r.random()
            body = mark + (text(1, 3) if r.random() < 0.25 else " ".join(prose() for _ in range(r.choice([1, 1, 3]))))
            parts.append(f"<p>{body}</p>" if x < 0.55 else f"<p>{body}" if x < 0.62 else f"<p><b>{body}<br>" if x < 0.7 else f"<h2>{mark}{text(2, 8, False)}</h2><p>{body}</p>" if x < 0.8
                         else f"<ul>{''.join(f'<li>{mark}{text(2, 12)}</li>' for _ in range(r.randint(2, 5)))}</ul>" if x < 0.87
                         else f"<blockquote>{body}</blockquote>" if x < 0.92 else f"<p>{mark}{text(1, 5)} <a href=/y>{text(1, 4, False)}</a> {prose(True)}</p>" if x < 0.97 else f"<pre>{body}</pre>")
            if r.random() < 0.12:
                parts.append(other(r.choice(["ad", "side", "notice", "form", "nav", "comments"])))
        if r.random() < 0.1:
            parts.insert(0, f"<header><h1>{mark}{text(2, 9, False)}</h1></header>")
        if r.random() < plain:
            box = r.choice(["div", "div", f"div class={word()}", f"div id={word()}", "section", "td", "", "", "", ""])
            body = "".join(parts)
            return body if not box else f"<table><tr>{_box(box, body)}</tr></table>" if box == "td" else _box(box, body)
        return _box(r.choice(_MAIN), "".join(parts))

    out = []
    for _ in range(n):
        before = [other(k) for k in ("nav", "header", "notice", "ad", "form") if r.random() < 0.5]
        after = [other(k) for k in ("side", "ad", "notice", "form", "comments", "nav", "footer") if r.random() < 0.5]
        if r.random() < 0.2:
            before, after = [], []  # a page that is its article
        r.shuffle(before)
        body = "".join(before) + article() + "".join(after)
        if r.random() < 0.3:
            body = f"<div class={r.choice(['wrapper', 'container', 'page', 'site'])}>{body}</div>"
        page = f"<html><head><title>{text(2, 8, False)}</title><script>var x='<p>';</script></head><body>{body}</body></html>"
        if r.random() < 0.15:
            page = body  # end and start tags of html, head and body may be left out
        out.append([(t.replace(mark, "") or " ", f, d, mark in t) for t, f, d in blocks(page)])
    return out


@lru_cache(2)
def default_field() -> Field:
    return train(labelled_pages())


def main_text(page: str | None, field: Field) -> str:
    items = blocks(page or "", field.weights)
    return "\n".join(b[0] for b, main in zip(items, field.label(items), strict=True) if main)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text) for every row of pages (page_id, url, html).

    text: the main blocks in page order, one to a line; character references decoded, white space inside a block made
    one space.  Empty if the page is null, has no text, or no main block.  Extra columns are not read."""
    table = pages.sparkSession.sparkContext.broadcast(field or default_field())
    kinds = dict(pages.dtypes)

    def run(batches):
        f = table.value
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                texts = [main_text(p, f) for p in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])
    return arrow_map(pages.select("page_id", "url", "html"), run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
