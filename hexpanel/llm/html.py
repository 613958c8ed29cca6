"""Main text of HTML pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: runs of text between block-level boundaries, each with its open elements. A block's
features are its ancestors' tags and class words and simple measures of its whole text; the field is trained by maximum
likelihood on labelled pages and decoded by Viterbi. Labelled pages are made by a seeded generator of page layouts, so
training needs no corpus.

Reading takes time and memory in proportion to the page whatever its markup: a tag is scanned once, elements know their
place among the open ones of their name, and a block holds its innermost element, which knows the one around it and what
features it adds to it. Pages of any length are read whole.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by how they are read.
BLOCKS = set("address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("head iframe noscript object script style svg template textarea title".split())
RAW = set("script style textarea title iframe noscript".split())
IN_HEAD = set("base link meta noscript script style template title".split())
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
TABLE = {"caption", "table", "tbody", "td", "tfoot", "th", "thead", "tr"}
WALLS = {"caption", "table", "td", "th", "object", "template"}  # end tags of what is outside don't reach in
ENDS_P = BLOCKS - {"body", "button", "caption", "html", "legend", "option", "select", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: An element -> open ones that its start ends, up to the nearest open one of the second set.
ENDS = {
    "li": ({"li"}, {"ol", "ul", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "caption"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "caption"}, {"table"}),
}

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
STOP = re.compile(r"[>\"']")
ATTRIBUTE = re.compile(r"(?<![^\s\"'<>/=])([^\s\"'<>/=]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))")
LONG_NUMBER = re.compile(r"&#(?:0*[0-9]{8,}|[xX]0*[0-9a-fA-F]{7,});?")
WORD = re.compile(r"[a-z]+")
TEXT_WORD = re.compile(r"[^\W\d_]+")
#: Words of notices and controls, by which text that no markup tells apart is recognised.
CUES = set("advertisement anzeige comment comments cookie cookies copyright datenschutz impressum kommentar kommentare login newsletter privacy publicidad publicité replies reply reserved share sponsored subscribe tweet".split())

PAGES, LEAST_PAGES, STEPS, PENALTY, SEED = 700, 3, 150, 1e-4, 23


@dataclass(slots=True)
class Element:
    """An open element. adds: the features that no element around it has."""

    tag: str
    parent: Element | None
    adds: tuple[str, ...]
    block: str  # the nearest block-level tag, itself included
    score: float | None = None


@dataclass
class Block:
    text: str
    element: Element
    linked: float  # share of the characters that are inside links

    def inherited(self) -> list[str]:
        out, e = [], self.element
        while e is not None:
            out += e.adds
            e = e.parent
        return out


ROOT = Element("", None, (), "", 0.0)


def decoded(text: str) -> str:
    """text with its character references decoded; numbers beyond all code points become U+FFFD."""
    return unescape(LONG_NUMBER.sub("�", text)) if "&" in text else text


def tag_end(page: str, at: int) -> tuple[int, int]:
    """Where the > of a tag is that goes on at `at`, not counting those in quoted values, and where reading goes on. A
    value that is never closed ends at the next >; a tag that never ends takes the rest of the page."""
    n, begun = len(page), at
    while True:
        m = STOP.search(page, at)
        if m is None:
            return n, n
        k = m.start()
        if page[k] == ">":
            return k, k + 1
        before = k - 1
        while before >= begun and page[before].isspace():
            before -= 1
        at = k + 1
        if page[before] == "=" and before >= begun:
            close = page.find(page[k], at)
            if close < 0:
                k = page.find(">", at)
                return (n, n) if k < 0 else (k, k + 1)
            at = close + 1
        begun = at


class Reader:
    """Reads one page. at: tag -> places in the stack of the open elements of that name; walls, solid: places of those
    that end tags don't reach past, and of block-level ones."""

    def __init__(self, page: str):
        self.page, self.out, self.parts = page, [], []
        self.stack: list[Element] = []
        self.at: dict[str, list[int]] = {}
        self.walls: list[int] = []
        self.solid: list[int] = []
        self.known: set[str] = set()
        self.linked = self.hidden = self.links = 0
        self.read()

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                top = self.stack[-1] if self.stack else ROOT
                self.out.append(Block(text, top, min(1.0, self.linked / len(text))))
            self.parts = []
        self.linked = 0

    def say(self, text: str) -> None:
        if self.stack and self.stack[-1].tag == "head" and not text.isspace():
            self.close(len(self.stack) - 1)  # a head without an end
        if not self.hidden:
            text = decoded(text)
            self.parts.append(text)
            if self.links:
                self.linked += len(text.strip())

    def last(self, tag: str) -> int:
        places = self.at.get(tag)
        return places[-1] if places else -1

    def close(self, to: int) -> None:
        """Ends all elements from a place in the stack on."""
        if self.solid and self.solid[-1] >= to:
            self.flush()
        while len(self.stack) > to:
            e, i = self.stack.pop(), len(self.stack)
            self.known.difference_update(e.adds)
            if places := self.at.get(e.tag):
                if places[-1] == i:  # else it has ended already, and only holds its place
                    places.pop()
                    self.hidden -= e.tag in HIDDEN
                    self.links -= e.tag == "a"
            if self.walls and self.walls[-1] == i:
                self.walls.pop()
            if self.solid and self.solid[-1] == i:
                self.solid.pop()

    def end(self, tag: str) -> None:
        i = self.last(tag)
        if i < 0 or tag not in TABLE and self.walls and self.walls[-1] > i:
            return
        if tag in BLOCKS or not self.solid or self.solid[-1] < i:
            self.close(i)
        else:  # an inline element that ends around blocks that go on
            self.at[tag].pop()
            self.links -= tag == "a"
            self.hidden -= tag in HIDDEN

    def begin(self, tag: str, attributes: str) -> None:
        if tag not in IN_HEAD and tag not in ("head", "html") and (i := self.last("head")) >= 0:
            self.close(i)
        if tag in BLOCKS:
            wall = self.walls[-1] if self.walls else -1
            if tag in ENDS_P and (i := self.last("p")) > wall:
                self.close(i)
            if tag in HEADINGS and self.stack and self.stack[-1].tag in HEADINGS:
                self.close(len(self.stack) - 1)
            if tag in ENDS:
                ended, within = ENDS[tag]
                i = min((k for k in map(self.last, sorted(ended)) if k > max(map(self.last, sorted(within)))), default=-1)
                if i >= 0 and (tag in TABLE or i > wall):
                    self.close(i)
            self.flush()
        if tag == "a" and (i := self.last("a")) >= 0:
            self.end("a")
        if tag in VOID or attributes.endswith("/") and (tag in ("svg", "math") or self.last("svg") >= 0):
            return
        adds = [f"in:{tag}"]
        if "=" in attributes:
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                if name.lower() in ("class", "id", "role"):
                    adds += [f"class:{w}" for w in WORD.findall((a or b or c).lower())]
        new = tuple(dict.fromkeys(f for f in adds if f not in self.known))
        self.known.update(new)
        parent, i = self.stack[-1] if self.stack else ROOT, len(self.stack)
        self.stack.append(Element(tag, parent, new, tag if tag in BLOCKS else parent.block))
        self.at.setdefault(tag, []).append(i)
        self.hidden += tag in HIDDEN
        self.links += tag == "a"
        if tag in WALLS:
            self.walls.append(i)
        if tag in BLOCKS:
            self.solid.append(i)

    def read(self) -> None:
        page, n, at = self.page, len(self.page), 0
        while at < n:
            k = page.find("<", at)
            if k < 0:
                self.say(page[at:])
                break
            if k > at:
                self.say(page[at:k])
            sign = page[k + 1 : k + 2]
            closing = sign == "/"
            name = NAME.match(page, k + 1 + closing)
            if name is None:
                if page.startswith("<!--", k):
                    empty = 5 if page.startswith("<!-->", k) else 6 if page.startswith("<!--->", k) else 0
                    stop = k + empty - 3 if empty else page.find("-->", k + 4)
                    at = n if stop < 0 else stop + 3
                elif sign in ("!", "?") or closing and k + 2 < n:
                    stop = page.find(">", k + 2)
                    at = n if stop < 0 else stop + 1
                else:
                    self.say("<")
                    at = k + 1
                continue
            tag = name[0].lower()
            stop, at = tag_end(page, name.end())
            if stop == n:
                break
            if closing:
                if tag == "br":
                    self.say(" ")
                elif tag in ("body", "html") or tag == "p" and self.last("p") < 0:
                    self.flush()  # what follows the end of the body is still in it
                else:
                    self.end(tag)
            elif tag == "br":
                self.say(" ")
            else:
                self.begin(tag, page[name.end() : stop])
                if tag in RAW and self.stack and self.stack[-1].tag == tag:
                    end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                    at = end.start() if end else n
        self.flush()


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order. Character references are decoded and white space in a block becomes one space; empty
    blocks are none. Unclosed elements end as HTML's optional end tags let them, at the latest with what holds them; what
    a tag or comment without an end takes in is not text."""
    return Reader(page).out


def measures(b: Block) -> list[str]:
    """Features of a block's own text."""
    n, words = len(b.text), b.text.count(" ") + 1
    out = [f"tag:{b.element.block}"]
    out.append("words:" + ("1" if words == 1 else "2" if words < 4 else "4" if words < 10 else "10" if words < 30 else "30"))
    out.append("linked:" + ("no" if not b.linked else "half" if b.linked < 0.5 else "most" if b.linked < 0.9 else "all"))
    if b.text[-1] in ".!?…\"”":
        out.append("sentence")
    if "©" in b.text:
        out.append("copyright")
    if sum(map(b.text.count, "0123456789")) * 4 > n:
        out.append("digits")
    if any(c in b.text for c in "|»›•·") and words < 30:
        out.append("separators")
    if words < 40 and not CUES.isdisjoint(TEXT_WORD.findall(b.text.lower())):
        out.append("cue")
    return out


def features(b: Block) -> list[str]:
    return b.inherited() + measures(b)


def labelled(seed: int = SEED, pages: int = PAGES) -> list[tuple[str, set[str]]]:
    """Pages of varied layouts and the texts of their main blocks: articles in article, main, body, table cells or divs
    with telling classes or none; menus, adverts, share boxes, notices and forms around and within them; headers and
    footers of pages and of articles, of which an article's heading alone is main text; reader comments."""
    r = random.Random(seed)
    syllables = ["th", "er", "on", "an", "re", "in", "ed", "nd", "ha", "en", "es", "of", "or", "ti", "to", "st", "le", "ción", "keit", "lich", "ment", "eau", "que", "é", "ü"]
    cues = sorted(CUES)

    def word() -> str:
        x = r.random()
        return str(r.randint(1, 2030)) if x < 0.04 else r.choice(cues) if x < 0.05 else "".join(r.choices(syllables, k=r.randint(1, 4)))

    sentence = lambda: " ".join(word() for _ in range(r.randint(2, 18))).capitalize() + r.choice([".", ".", ".", ".", "?", "!"])
    prose = lambda n: " ".join(sentence() for _ in range(r.randint(1, n)))
    few = lambda n=4: " ".join(word() for _ in range(r.randint(1, n)))
    date = lambda: r.choice(["{}-{:02}-{:02}", "{2}.{1}.{0}", "{1}/{2}/{0}"]).format(r.randint(1999, 2026), r.randint(1, 12), r.randint(1, 28))
    cue = lambda: r.choice(cues).capitalize()
    named = lambda names: r.choice(["", f' class="{r.choice(names)}"', f' class="{r.choice(names)}"', f' id="{r.choice(names)}"'])
    out = []
    for _ in range(pages):
        main: set[str] = set()
        bare = r.random() < 0.35  # a page whose classes tell nothing

        def keep(text: str, main: set[str] = main) -> str:
            main.add(" ".join(unescape(text).split()))
            return text

        def kind(names: str, bare: bool = bare) -> str:
            return r.choice(["", "", f' class="{"".join(r.choices("bcdfgjkqvwxz", k=4))}"']) if bare else r.choice([' class="{}"', ' class="{}"', ' id="{}"']).format(r.choice(names.split("|")))

        def menu() -> str:
            style = r.choice(["<ul>{}</ul>", "{}", "<div>{}</div>"])
            item = r.choice(["<li><a href='/x'>{}</a></li>", "<li><a href='/x'>{}</a>", "<a href='/x'>{}</a> ", "<a href='/x'>{}</a> | "]) if style != "{}" else r.choice(["<a href='/x'>{}</a> ", "<a href='/x'>{}</a> | "])
            return style.format("".join(item.format(few(3)) for _ in range(r.randint(2, 9))))

        def share() -> str:
            return f"<div{kind('share|social|share buttons|sharing')}>{r.choice([f'{cue()}: ', ''])}{''.join(f'<a href=/s>{few(1)}</a> ' for _ in range(r.randint(2, 5)))}</div>"

        def notice() -> str:
            return f"<div{kind('cookie notice|cookie banner|notice|consent|alert')}>{r.choice(['<p>{}</p>', '{}']).format(f'{cue()} {prose(1)}')}{r.choice(['<button>' + few(2) + '</button>', '<a href=/c>' + few(2) + '</a>'])}</div>"

        def aside() -> str:
            names = "ad|ads advert|advertisement|sidebar|related|newsletter subscribe|promo banner|widget|breadcrumbs|popup modal|sponsored|author bio|tags meta|ad slot"
            body = r.choice([prose(3), f"<p>{prose(2)}</p>", menu(), f"<h3>{few()}</h3>{menu()}", f"<p>{few()} <a href='/y'>{few()}</a></p>"])
            if r.random() < 0.4:
                return f"<aside{named(names.split('|'))}>{body}</aside>"
            tag = r.choice(["div", "div", "section"])
            return f'<{tag} class="{r.choice(names.split("|"))}">{body}</{tag}>'

        def form() -> str:
            return r.choice([f"<form><label>{few()}</label><input name=q><button>{few(2)}</button></form>", f'<form class="search"><p>{prose(2)}</p><select><option>{few()}</option><option>{few()}</option></select></form>', f"<form action=/s><div><p>{few()}</p><textarea>{few()}</textarea></div></form>"])

        def comments() -> str:
            tag, names = r.choice(["section", "div", "div"]), r.choice(["comments", "comment list", "comments area", "discussion comments", "replies responses"])
            one = lambda: r.choice(['<div class="comment"><b>{}</b><p>{}</p></div>', '<li class="comment"><p>{1}</p><span>{0}</span></li>', "<article class='comment'><p>{1}</p></article>", "<p>{1}</p>", "<div>{0}</div><div>{1}</div>"]).format(few(2), prose(4))
            return f'<{tag} {r.choice(["class", "class", "id"])}="{names}"><h2>{r.choice([few(), cue()])}</h2>{"".join(one() for _ in range(r.randint(1, 5)))}</{tag}>'

        def within() -> str:
            return r.choice([aside, share, share, notice, form, comments])()

        def story(titled: bool) -> str:
            shape = r.choice(["plain", "broken", "broken", "rich", "divs"])
            title = f"<h1>{keep(few(10))}</h1>" if titled else ""
            byline = lambda: r.choice(["<p>{}</p>", "<span>{}</span>", "<div>{}</div>"]).format(r.choice([date(), f"{few(2)}, {date()}", f"<a href=/a>{few(2)}</a>"]))
            parts = [r.choice([title, title, f"<header>{title}</header>", f"<header>{title}{byline()}</header>", f"<header>{byline()}</header>{title}"])]
            for _ in range(r.randint(1, 9)):
                x = r.random()
                if shape == "broken" and x < 0.4:
                    parts.append(f"<p><b>{keep(r.choice([prose(2), few(6)]))}<br>")
                elif shape == "divs" and x < 0.6:
                    parts.append(f"<div>{keep(r.choice([prose(6), prose(3), few(4)]))}</div>")
                elif shape == "rich" and x < 0.12:
                    parts.append("<ul>" + "".join(f"<li>{keep(r.choice([prose(2), few()]))}</li>" for _ in range(3)) + "</ul>")
                elif shape == "rich" and x < 0.2:
                    parts.append(f"<h2>{keep(few(6))}</h2>")
                elif shape == "rich" and x < 0.26:
                    parts.append(f"<blockquote>{r.choice(['{}', '<p>{}</p>']).format(keep(prose(2)))}</blockquote>")
                elif shape == "rich" and x < 0.32:
                    parts.append(f"<table><tr><td>{keep(few())}</td><td>{keep(few())}</td></tr></table>")
                elif shape == "rich" and x < 0.37:
                    parts.append(f"<figure><img src=x><figcaption>{keep(few(8))}</figcaption></figure>")
                elif shape == "rich" and x < 0.42:
                    parts.append(f"<pre>{keep(few(8))}</pre>")
                elif shape == "rich" and x < 0.46:
                    parts.append(f"<dl><dt>{keep(few())}</dt><dd>{keep(prose(1))}</dd></dl>")
                elif x < 0.62 and r.random() < 0.35:
                    parts.append(within())
                elif r.random() < 0.15:
                    a, b, c = prose(2), few(), prose(1)
                    keep(f"{a} {b} {c}")
                    parts.append(f"<p>{a} <a href='/z'>{b}</a> {c}</p>")
                elif r.random() < 0.05:
                    parts.append(f"<p><a href='/z'>{keep(few(8))}</a></p>")
                else:
                    parts.append(r.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}"]).format(keep(r.choice([prose(8), prose(8), few(3)] + [f"{few(2)} {r.choice(cues)}."] * (r.random() < 0.2)))))
            if r.random() < 0.25:
                parts.append(comments())
            if r.random() < 0.2:
                parts.append(f"<footer>{r.choice([few(), f'<p>{prose(1)}</p>', menu(), f'{cue()} {few(2)}'])}</footer>")
            return "".join(parts)

        told = ["<article>{}</article>"] * 6 + ["<main><article>{}</article></main>", "<main>{}</main>", "<main>{}</main>", "<main><div>{}</div></main>", "<div><article>{}</article></div>", '<div class="content">{}</div>', '<div id="main-content"><div class="post-body entry">{}</div></div>', '<div class="article text">{}</div>', '<section class="content">{}</section>']
        plain = ["<div>{}</div>", "<div><div>{}</div></div>", "{}", "<section>{}</section>", "<table><tr><td>{}</td></tr></table>", "<center>{}</center>", "<main>{}</main>"]
        holder = r.choice(plain if bare else told)
        if bare and r.random() < 0.3:
            holder = holder.replace("<div>", f'<div class="{"".join(r.choices("bcdfgjkqvwxz", k=5))}">', 1)
        top = [f"<nav>{menu()}</nav>", f"<header><p>{few(6)}</p>{menu()}</header>", f"<div{kind('menu nav|navbar|topnav|menu')}>{menu()}</div>", aside(), f"<div class='header'>{few(5)}</div>", form(), notice(), f"<header><div{kind('logo|brand')}><a href='/'>{few(2)}</a></div><nav>{menu()}</nav></header>"]
        bottom = [aside(), comments(), f"<footer>&copy; {few(2)} &middot; {sentence()}</footer>", f"<footer><p>{prose(2)}</p>{menu()}</footer>", f"<div{kind('footer|bottom')}>{menu()} &copy; {sentence()}</div>", f"<div>{r.choice(['&copy; ', '© ', ''])}{date()[:4]} {few(3)} {cue()}</div>", notice(), share()]
        body = "".join(r.sample(top, r.randint(0, 4))) + "<!-- x -->" + holder.format(story(r.random() < 0.8)) + "".join(r.sample(bottom, r.randint(0, 4)))
        out.append((f"<!DOCTYPE html><html><head><title>{few(8)}</title><style>p{{}}</style></head><body>{body}" + r.choice(["</body></html>", ""]), main))
    return out


@dataclass
class Field:
    """index: feature -> row of weights (one column a label, outside and main); step: label to label; first: of a page's
    first block."""

    index: dict[str, int]
    weights: np.ndarray
    step: np.ndarray
    first: np.ndarray

    def __post_init__(self) -> None:
        self.margin = {f: float(self.weights[i, 1] - self.weights[i, 0]) for f, i in self.index.items()}

    def inherited(self, e: Element) -> float:
        """Sum of the margins of an element's features and of those around it, kept with each element on the way."""
        way = []
        while e.score is None:
            way.append(e)
            e = e.parent
        total = e.score
        for e in reversed(way):
            total += sum(self.margin.get(f, 0.0) for f in e.adds)
            e.score = total
        return total

    def decode(self, page: list[Block]) -> list[bool]:
        """Viterbi over the two labels."""
        if not page:
            return []
        (aa, ab), (ba, bb) = self.step.tolist()
        scores = [self.inherited(b.element) + sum(self.margin.get(f, 0.0) for f in measures(b)) for b in page]
        out_, in_ = float(self.first[0]), float(self.first[1]) + scores[0]
        back = []
        for s in scores[1:]:
            back.append((in_ + ba > out_ + aa, in_ + bb > out_ + ab))
            out_, in_ = max(out_ + aa, in_ + ba), max(out_ + ab, in_ + bb) + s
        label = in_ > out_
        path = [label]
        for from_out, from_in in reversed(back):
            label = from_in if label else from_out
            path.append(label)
        return path[::-1]


def train(pages: list[tuple[str, set[str]]], steps: int = STEPS) -> Field:
    """Maximum likelihood with a quadratic penalty, by Adam over forward-backward on all pages at once."""
    read = [blocks(h) for h, _ in pages]
    keep = sorted(((b, m) for b, (_, m) in zip(read, pages, strict=True) if b), key=lambda x: -len(x[0]))
    told = [[features(x) for x in b] for b, _ in keep]
    pages_with = Counter(f for page in told for f in {f for x in page for f in x})
    index = {f: i for i, f in enumerate(sorted(f for f, k in pages_with.items() if k >= LEAST_PAGES))}
    rows = [[[index[f] for f in x if f in index] for x in page] for page in told]
    longest, n = max(map(len, rows)), len(rows)
    at = np.array([(i, t) for i, r in enumerate(rows) for t in range(len(r))]).T
    flat = np.zeros((at.shape[1], len(index)), np.float32)
    for i, r in enumerate(f for row in rows for f in row):
        flat[i, r] = 1
    on, gold = np.zeros((n, longest), bool), np.zeros((n, longest, 2))
    on[at[0], at[1]] = True
    gold[at[0], at[1]] = np.eye(2)[[int(block.text in main) for b, main in keep for block in b]]
    going = on.sum(0)
    seen = (gold[:, :-1, :, None] * gold[:, 1:, None, :]).sum((0, 1))
    w = [np.zeros((len(index), 2)), np.zeros((2, 2)), np.zeros(2)]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for k in range(1, steps + 1):
        e = np.zeros((n, longest, 2))
        e[at[0], at[1]] = flat @ w[0].astype(np.float32)
        e -= e.max(2, keepdims=True)
        here, step = np.exp(e), np.exp(w[1])
        up, down, scale = np.zeros((n, longest, 2)), np.ones((n, longest, 2)), np.ones((n, longest, 1))
        up[:, 0] = here[:, 0] * np.exp(w[2])
        for t in range(longest):  # scaled forward sums; pages are sorted by length, so those that go on come first
            m_ = going[t]
            if t:
                up[:m_, t] = (up[:m_, t - 1] @ step) * here[:m_, t]
            scale[:m_, t] = up[:m_, t].sum(1, keepdims=True)
            up[:m_, t] /= scale[:m_, t]
        for t in range(longest - 2, -1, -1):
            m_ = going[t + 1]
            down[:m_, t] = (here[:m_, t + 1] * down[:m_, t + 1]) @ step.T / scale[:m_, t + 1]
        node = up * down * on[:, :, None]
        pair = up[:, :-1, :, None] * step * (here[:, 1:] * down[:, 1:] / scale[:, 1:])[:, :, None, :] * on[:, 1:, None, None]
        g = [flat.T @ (gold - node)[at[0], at[1]].astype(np.float32) / n - PENALTY * w[0], (seen - pair.sum((0, 1))) / n - PENALTY * w[1], (gold[:, 0] - node[:, 0]).sum(0) / n]
        for a, b, c, d in zip(w, m, v, g, strict=True):
            b += 0.1 * (d - b)
            c += 0.01 * (d * d - c)
            a += 0.1 * (b / (1 - 0.9**k)) / (np.sqrt(c / (1 - 0.99**k)) + 1e-8)
    return Field(index, *w)


@lru_cache(1)
def model() -> Field:
    return train(labelled())


def main_text(page: str, field: Field) -> str:
    read = blocks(page)
    return "\n\n".join(b.text for b, keep in zip(read, field.decode(read), strict=True) if keep)


def extract(df: DataFrame, body: str = "html", into: str = "main_text") -> DataFrame:
    """Adds a string column `into`: the blocks of the main text in page order, joined by two line ends; empty where there
    is none. Null and empty pages give an empty text; broken markup is read as far as it goes, in time in proportion to
    the page. Repeated rows get the same text; an empty table gives no rows; a column called like `into` is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model())

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([main_text(p, shared.value) if p else "" for p in batch.to_pylist()], pa.string())

    return df.withColumn(into, run(df[body].cast("string")))
