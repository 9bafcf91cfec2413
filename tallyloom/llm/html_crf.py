"""HTML extraction: a linear-chain conditional random field over the leaf blocks of a page, decoded by Viterbi.

A page is read tag by tag. Text between two block-level tags is a leaf block; character references are decoded, white space
becomes one space, empty blocks go. What stands in a script, style, title, textarea, iframe or noscript is raw up to the end
tag, whatever it looks like. Scripts, styles, heads, and what is no text (options, buttons' values, frames) never become
blocks. Each block has features of its ancestors (tags, words of class, id and role), of its own tag and of its text
(length, share of links, sentence marks, set phrases). The field gives each block a label, main or not, where neighbouring labels
depend on each other; the best labelling of the page is found by Viterbi. The main text is the main blocks, one a line.

The weights are learned on the driver by gradient descent on the conditional likelihood of labelled pages (forward-backward
sums). `labelled_pages` makes them from grammars of pages, a fixed number whatever the corpus; other labelled pages can be given: in them
`data-main="1"` marks the elements whose blocks are main text.

A null html is empty; an empty page, or one without main blocks, has the empty text. Broken markup is read as far as a browser
would. Repeated rows are read each; other columns are not read; nothing is cut.
"""

from __future__ import annotations

import functools
import html as markup
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<more>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|[^<]+|<", re.S
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden|data-main)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
# Kinds of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template title head svg math iframe object canvas select option textarea audio video".split())
RAW = {x: re.compile(rf"</{x}(?=[\s/>])", re.I) for x in "script style title textarea iframe noscript".split()}
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section table ul".split()
)
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("table td th ul ol dl article section div main body html".split())
ANCESTORS = (
    "nav header footer aside article main form section ul ol table figure blockquote button label fieldset dialog menu details a".split()
)
# What words of class, id and role tell.
MEANS = {
    "advert": "ad ads advert advertisement advertising adsense banner sponsor sponsored promo promotion".split(),
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs toolbar pagination pager skip tabs topbar".split(),
    "footer": "footer copyright legal colophon bottom imprint".split(),
    "header": "header masthead logo branding top sitename".split(),
    "side": "sidebar aside widget widgets related recommended recommend recommendations more trending popular tags teaser teasers".split(),
    "comment": "comment comments commentlist reply replies respond disqus discussion reader readers feedback reactions".split(),
    "notice": "cookie cookies consent gdpr notice notification alert modal popup overlay newsletter subscribe signup paywall warning".split(),
    "share": "share sharing social follow facebook twitter".split(),
    "form": "form login search input register contact".split(),
    "content": "article content post entry main story body text page maincontent articlebody prose copy".split(),
}
_MEANING = {word: k for k, words in enumerate(MEANS.values()) for word in words}
_ROLES = {"navigation": "menu", "banner": "header", "contentinfo": "footer", "complementary": "side", "search": "form", "main": "content"}
_PHRASES = re.compile(
    r"cookie|all rights reserved|subscribe|newsletter|sign (?:in|up)|log ?in|read more|share (?:this|on)|privacy|terms of|advertis|"
    r"leave a (?:comment|reply)|©|\(c\)",
    re.I,
)

_OWN = ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "th", "div", "span", "pre", "dt", "dd", "blockquote", "figcaption", "article", "section", "body", "a", "button", "label")
_LENGTHS = (2, 5, 10, 20, 50)
_NAMES = (
    [f"in {t}" for t in ANCESTORS] + [f"means {m}" for m in MEANS] + ["hidden"] + [f"own {t}" for t in _OWN] + ["own other"]
    + [f"words {n}" for n in range(len(_LENGTHS) + 1)] + [f"links {n}" for n in range(4)]
    + ["ends", "commas", "phrase", "digits", "shouts", "short link list", "long text outside", "all"]
)
_AT = {name: k for k, name in enumerate(_NAMES)}
_HIDDEN, _MAIN = 1 << 40, 1 << 41
_ANCESTOR_BIT = {t: 1 << k for k, t in enumerate(ANCESTORS)}
_MEANS_BIT = [1 << (len(ANCESTORS) + k) for k in range(len(MEANS))]
_BITS = len(ANCESTORS) + len(MEANS)


@functools.lru_cache(maxsize=4096)
def _own_bits(tag: str, more: str) -> int:
    bits = _ANCESTOR_BIT.get(tag, 0)
    for name, value in _ATTRIBUTE.findall(more) if more else ():
        name, value = name.lower(), value.strip("\"'")
        if name == "data-main":
            bits |= _MAIN
        elif name in ("hidden", "aria-hidden", "style"):
            if name == "hidden" or name == "aria-hidden" and value == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                bits |= _HIDDEN
        else:
            words = [_ROLES.get(w.lower(), w.lower()) for w in _WORD.findall(value)]
            for word in words:
                if word in _MEANING:
                    bits |= _MEANS_BIT[_MEANING[word]]
    return bits


# text, bits of the ancestors, innermost block tag, characters in links
Block = tuple[str, int, str, int]


def _tokens(page: str) -> Iterator[re.Match[str]]:
    """Tags, comments and texts of a page; the content of raw elements is left out, unless they never end."""
    at, endless = 0, set()
    while at is not None:
        start, at = at, None
        for found in _TAG.finditer(page, start):
            yield found
            name = found["name"] and not found["close"] and found["name"].lower()
            if name in RAW and name not in endless and not found["more"].endswith("/"):
                end = RAW[name].search(page, found.end())
                if end:
                    at = end.start()
                    break
                endless.add(name)


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in its order."""
    out: list[Block] = []
    # Tag, bits of it and its ancestors, innermost block tag.
    stack: list[tuple[str, int, str]] = [("body", 0, "body")]
    # Open elements by name, so that a search for one that is not open takes no time, however deep the page.
    opened: Counter[str] = Counter()
    silent = ""
    pieces: list[str] = []
    links = bits = 0
    own = "body"

    def flush() -> None:
        nonlocal links
        if pieces:
            text = " ".join(markup.unescape("".join(pieces)).split())
            if text:
                out.append((text, bits, own, links))
            pieces.clear()
        links = 0

    def pop_to(names: tuple[str, ...], bounds: frozenset[str]) -> None:
        if not any(opened[x] for x in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in names:
                opened.subtract(x for x, _, _ in stack[k:])
                del stack[k:]
                return
            if stack[k][0] in bounds:
                return

    for found in _tokens(page):
        name = found["name"]
        if name is None:
            piece = found[0]
            if silent or piece.startswith(("<!", "<?")):
                continue
            if not pieces:
                if piece.isspace():
                    continue
                bits = stack[-1][1]
                own = stack[-1][2]
            bits |= stack[-1][1] & ~_ANCESTOR_BIT["a"]
            pieces.append(piece)
            if stack[-1][1] & _ANCESTOR_BIT["a"]:
                links += len(piece)
            continue
        tag = name.lower()
        if silent:
            if found["close"] and tag == silent:
                silent = ""
            elif silent == "head" and not found["close"] and tag == "body":
                silent = ""
            continue
        if found["close"]:
            if tag not in INLINE:
                flush()
            pop_to((tag,), frozenset(("td", "th")) if tag in INLINE or tag == "p" else frozenset())
            continue
        if tag in SILENT:
            if not found["more"].endswith("/"):
                silent = tag
            continue
        if tag == "br" or tag == "hr" or tag == "wbr":
            if tag == "hr":
                flush()
            elif tag == "br":
                pieces.append(" ") if pieces else None
            continue
        if tag not in INLINE:
            flush()
            if tag in CLOSES_P:
                pop_to(("p",), SCOPE)
            if tag in SAME:
                pop_to(SAME[tag], frozenset(("ul", "ol", "dl", "table")))
        if tag not in VOID and not (tag in INLINE and found["more"].endswith("/")):
            stack.append((tag, stack[-1][1] | _own_bits(tag, found["more"]), stack[-1][2] if tag in INLINE else tag))
            opened[tag] += 1
    flush()
    return out


def features(block: Block) -> list[int]:
    """The numbers of the block's features."""
    text, bits, own, links = block
    out = [k for k in range(_BITS) if bits >> k & 1]
    if bits & _HIDDEN:
        out.append(_AT["hidden"])
    out.append(_AT.get(f"own {own}", _AT["own other"]))
    words = text.count(" ") + 1
    size = sum(words > n for n in _LENGTHS)
    out.append(_AT[f"words {size}"])
    share = links / len(text)
    out.append(_AT[f"links {(share > 0) + (share > 0.3) + (share > 0.7)}"])
    if text[-1] in ".!?…:\"”»)":
        out.append(_AT["ends"])
    if text.count(",") * 30 > words:
        out.append(_AT["commas"])
    if _PHRASES.search(text):
        out.append(_AT["phrase"])
    if words < 20 and sum(c.isdigit() for c in text) * 4 > len(text):
        out.append(_AT["digits"])
    if words < 12 and text.isupper():
        out.append(_AT["shouts"])
    if words < 6 and share > 0.7 and own == "li":
        out.append(_AT["short link list"])
    if words > 20 and not bits:
        out.append(_AT["long text outside"])
    out.append(_AT["all"])
    return out


# -- the field -------------------------------------------------------------------------------------

# Weights: one row per feature and label; one number per pair of neighbouring labels.
Field = tuple[np.ndarray, np.ndarray]


def _scores(rows: list[list[int]], weights: np.ndarray) -> np.ndarray:
    flat = np.fromiter((f for row in rows for f in row), np.int64)
    starts = np.cumsum([0, *(len(r) for r in rows[:-1])])
    return np.add.reduceat(weights[flat], starts, axis=0)


def viterbi(scores: np.ndarray, steps: np.ndarray) -> list[int]:
    """The best labelling of one page."""
    (a, b), (c, d) = steps.tolist()
    rows = scores.tolist()
    x, y = rows[0]
    back = []
    for p, q in rows[1:]:
        from_x = (x + a >= y + c, x + b > y + d)
        back.append(from_x)
        x, y = (x + a if from_x[0] else y + c) + p, (x + b if from_x[1] else y + d) + q
    label = int(y > x)
    out = [label]
    for from_x in reversed(back):
        label = 0 if from_x[label] else 1
        out.append(label)
    return out[::-1]


def learn(pages: list[tuple[list[list[int]], list[int]]], rounds: int = 240, rate: float = 0.6, keep: float = 0.002) -> Field:
    """Maximise the likelihood of the pages' labels; pages of different length go through the sums side by side."""
    pages = [p for p in pages if p[0]]
    longest = max(len(rows) for rows, _ in pages)
    n = len(pages)
    count = len(_NAMES)
    size = np.array([len(rows) for rows, _ in pages])
    x = np.zeros((n, longest, count))
    y = np.zeros((n, longest), np.int64)
    for k, (rows, labels) in enumerate(pages):
        for t, row in enumerate(rows):
            x[k, t, row] = 1.0
        y[k, : len(labels)] = labels
    here = np.arange(longest)[None, :] < size[:, None]
    pair = here[:, 1:]
    wanted = np.zeros((count, 2))
    for label in (0, 1):
        wanted[:, label] = x[here & (y == label)].sum(axis=0)
    wanted_steps = np.zeros((2, 2))
    np.add.at(wanted_steps, (y[:, :-1][pair], y[:, 1:][pair]), 1.0)
    weights, steps = np.zeros((count, 2)), np.zeros((2, 2))
    seen, seen_steps = np.full((count, 2), 1e-8), np.full((2, 2), 1e-8)

    def add(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))

    for _ in range(rounds):
        s = x @ weights
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = s[:, 0]
        for t in range(1, longest):
            new = add(ahead[:, t - 1, :, None] + steps, 1) + s[:, t]
            ahead[:, t] = np.where(here[:, t, None], new, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = add(steps + (s[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(here[:, t + 1, None], new, 0.0)
        whole = add(ahead[:, -1], 1)
        chance = np.exp(ahead + behind - whole[:, None, None]) * here[:, :, None]
        both = np.exp(
            ahead[:, :-1, :, None] + steps + (s[:, 1:] + behind[:, 1:])[:, :, None, :] - whole[:, None, None, None]
        )
        slope = wanted - np.einsum("ntf,nty->fy", x, chance) - keep * n * weights / 10
        slope_steps = wanted_steps - (both * pair[:, :, None, None]).sum(axis=(0, 1)) - keep * n * steps / 10
        seen += slope**2
        seen_steps += slope_steps**2
        weights = weights + rate * slope / np.sqrt(seen)
        steps = steps + rate * slope_steps / np.sqrt(seen_steps)
    return weights, steps


# -- labelled pages --------------------------------------------------------------------------------

_SYLLABLES = "ba co di fu le mi no pra ru sta ti ver lo gan en sel ora tu pi kal dem os är é ön".split()


def labelled_pages(count: int = 400, seed: int = 7) -> list[str]:
    """Pages of many layouts with invented words; `data-main` marks the main text."""
    r = random.Random(seed)
    pick, chance = r.choice, r.random
    word = lambda: "".join(pick(_SYLLABLES) for _ in range(r.randint(1, 4)))
    words = lambda a, b: " ".join(word() for _ in range(r.randint(a, b)))

    def sentences(a: int, b: int) -> str:
        out = []
        for _ in range(r.randint(a, b)):
            inside = words(3, 16).split()
            if len(inside) > 6 and chance() < 0.6:
                inside[len(inside) // 2] += ","
            out.append(" ".join(inside).capitalize() + pick("....!?"))
        return " ".join(out)

    def link(text: str) -> str:
        return f'<a href="/{word()}">{text}</a>'

    def links(a: int, b: int, kind: str = "") -> str:
        items = "".join(f"<li>{link(words(1, 3))}</li>" for _ in range(r.randint(a, b)))
        return pick((f"<ul{kind}>{items}</ul>", f"<div{kind}>" + " | ".join(link(words(1, 2)) for _ in range(r.randint(a, b))) + "</div>"))

    def named(*names: str) -> str:
        return f' {pick(("class", "id"))}="{pick(names)}{pick(("", "", "-" + word(), " " + word()))}"'

    def advert() -> str:
        return f"<div{named('ad', 'ads', 'banner', 'advert', 'sponsored', 'promo')}>{pick((sentences(1, 3), words(2, 8), link(words(2, 6))))}</div>"

    def notice() -> str:
        box = pick(("div", "section", "aside", "dialog"))
        said = pick(("We use cookies. ", "Subscribe to our newsletter. ", "", "")) + sentences(1, 2)
        return f"<{box}{named('cookie', 'notice', 'consent', 'newsletter', 'popup', 'alert')}><p>{said}</p>{pick(('', '<button>' + words(1, 2) + '</button>'))}</{box}>"

    def form() -> str:
        return f"<form{pick(('', named('search', 'login', 'contact')))}><label>{words(1, 3)}</label><input type=\"text\"><button>{words(1, 2)}</button>{pick(('', '<p>' + sentences(1, 2) + '</p>'))}</form>"

    def comments() -> str:
        one = lambda: pick((f"<p>{sentences(1, 4)}</p>", f"<div{named('comment', 'reply')}><b>{words(1, 2)}</b><p>{sentences(1, 3)}</p></div>", f"<li><span>{words(1, 2)}</span> {sentences(1, 3)}</li>"))
        box = pick(("div", "section", "ol", "aside"))
        return f"<{box}{named('comments', 'commentlist', 'disqus', 'discussion', 'reader-comments')}>{pick(('', '<h3>' + words(1, 3) + '</h3>'))}{''.join(one() for _ in range(r.randint(1, 5)))}</{box}>"

    def side() -> str:
        box = pick((("aside", ""), ("div", named("sidebar", "widget", "related", "recommended")), ("aside", named("sidebar", "related"))))
        return f"<{box[0]}{box[1]}><h3>{words(1, 4)}</h3>{pick((links(2, 6), '<p>' + sentences(1, 3) + '</p>', '<p>' + link(words(3, 8)) + '</p>'))}</{box[0]}>"

    def article() -> str:
        m = ' data-main="1"'
        head = lambda *names: (lambda tag: f"<{tag}{m}>{words(1, 8).capitalize()}</{tag}>")(pick(names))
        out = [head("h1", "h1", "h2")] if chance() < 0.85 else []
        for _ in range(r.randint(1, 9)):
            kind = chance()
            if kind < 0.48:
                out.append(f"<p{m}>{sentences(1, 7)}{pick(('</p>', '</p>', '</p>', ''))}")
            elif kind < 0.54:
                out.append(f"<p{m}><b>{sentences(1, 5)}<br>")
            elif kind < 0.59:
                out.append(f"<p{m}>{words(1, 6)}{pick(('', '.'))}</p>")
            elif kind < 0.64:
                out.append(head("h2", "h3"))
            elif kind < 0.69:
                out.append("<ul>" + "".join(f"<li{m}>{pick((words(1, 9), sentences(1, 2)))}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.73:
                out.append(f"<blockquote{m}><p>{sentences(1, 3)}</p></blockquote>")
            elif kind < 0.77:
                out.append("<table>" + "".join(f"<tr><td{m}>{words(1, 3)}</td><td{m}>{r.randint(1, 9999)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>")
            elif kind < 0.79:
                out.append(f"<p{m}>{sentences(1, 2)} {link(words(1, 4))} {sentences(1, 2)}</p>")
            elif kind < 0.81:
                out.append(f"<p{m}>{'&amp;&amp; ### '.join(words(1, 4) for _ in range(4))}</p>")
            else:
                out.append(pick((advert, advert, side, form, notice))())
        return "".join(out)

    def page() -> str:
        top = []
        if chance() < 0.8:
            box = pick((("nav", ""), ("header", ""), ("div", named("menu", "navbar", "header", "navigation")), ("nav", named("menu"))))
            top.append(f"<{box[0]}{box[1]}>{pick(('', '<p>' + words(1, 4) + '</p>', '<h2>' + words(1, 3) + '</h2>'))}{links(2, 8)}</{box[0]}>")
        if chance() < 0.25:
            top.append(links(2, 4, named("breadcrumb")))
        extra = [f() for f in (advert, notice, form) if chance() < 0.35]
        box = pick((("article", ""), ("article", ""), ("article", ""), ("main", ""), ("main", ""), ("div", named("content", "post", "article-body", "entry", "story", "main")),
                    ("section", named("content", "article")), ("div", ""), ("div", f' class="{word()}"')))
        middle = f"<{box[0]}{box[1]}>{article()}</{box[0]}>"
        if chance() < 0.2:
            middle = f"<main>{middle}{pick(('', comments()))}</main>"
        after = [f() for f in (comments, side, form, advert, notice) if chance() < 0.35]
        if chance() < 0.85:
            foot = pick((("footer", ""), ("div", named("footer", "copyright", "legal")), ("footer", named("footer"))))
            after.append(f"<{foot[0]}{foot[1]}>{pick(('&copy; ' + words(1, 4), sentences(1, 3), '&copy; ' + word() + ' &middot; ' + sentences(1, 3), links(2, 5)))}</{foot[0]}>")
        if chance() < 0.3:
            extra.append(side())
        return "<html><head><title>x</title></head><body>" + "".join([*top, *extra, middle, *after]) + "</body></html>"

    return [page() for _ in range(count)]


def fit(pages: list[str] | None = None) -> Field:
    return _fit(tuple(pages) if pages is not None else None)


@functools.lru_cache(maxsize=2)
def _fit(pages: tuple[str, ...] | None) -> Field:
    read = [blocks(p) for p in (labelled_pages() if pages is None else pages)]
    return learn([([features(b) for b in page], [int(bool(b[1] & _MAIN)) for b in page]) for page in read])


def main_text(page: str, field: Field) -> str:
    found = blocks(page)
    if not found:
        return ""
    labels = viterbi(_scores([features(b) for b in found], field[0]), field[1])
    return "\n".join(b[0] for b, label in zip(found, labels, strict=True) if label)


def extract(pages: DataFrame, field: Field) -> DataFrame:
    """page_id, url, text, n_chars for every page."""
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
        F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"),
    )

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p, field) for p in batch["html"].to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )

    return common.map_arrow(rows, step, "page_id long, url string, text string, n_chars long")
