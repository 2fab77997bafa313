"""Main-text extraction from HTML by a linear-chain CRF over DOM leaf blocks.

``leaf_blocks`` walks the tags of a page once, keeps the open elements with counts of what is
open, so that a tag costs the same at any depth, and cuts the text into
leaf blocks wherever a block-level element begins or ends. ``features`` describes a block by its
ancestors (tags, words of class, id and role) and its text (length, links, punctuation, wording, its
neighbours' lengths, place).
``train`` fits weights and transitions by maximum likelihood (forward-backward, Adam) on
labelled pages; ``Model.decode`` labels a page's blocks by Viterbi, and the main blocks, in page
order, are the text.

Labelled pages are (a) at most ``TRAIN_PAGES`` of the given pages, the first by a hash of
page_id and html, equal ones once, labelled by their own mark-up: a block inside <article> or <main> and inside nothing
that names boilerplate is main text; (b) ``MADE_PAGES`` pages put together from the blocks of
(a) in other layouts (no <article>, articles with forms, notices, comments inside, parts that no
mark-up names), labelled by construction. Each page is learnt twice, the second time without any
feature of its mark-up, so that the wording and the shape of the text decide where mark-up says
nothing. This bounded fit is the only thing that reads a sample; every page is extracted
whole. Work per page is a Python generator over an Arrow batch; pages never meet each other.

Cases: null or empty html, or a page without text, gives an empty text; unclosed and stray tags
are repaired like a browser would (an open p ends at the next block); a script, style, title or
textarea without an end runs to the end of the page; other skipped elements (svg, button, select, ...)
end where they are closed, or at the next block that cannot stand in them; very long pages are one
pass; null ids and repeated rows are extracted each; an empty table gives no rows; other
columns are ignored. White space is what ``str.split`` splits at.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 300
MADE_PAGES = 600

# Element names by how they shape text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style title textarea iframe".split())
SKIPPED = frozenset("noscript template svg select button option".split())
ENDS_SKIPPED = frozenset("article aside blockquote footer form h1 h2 h3 h4 h5 h6 header main nav ol p section table ul".split())
LISTS = frozenset("ul ol dl table".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
TAGS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
# Words in class, id or role that name what is not main text, and what is.
BOILER = frozenset("ad ads advert advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie cookies copyright discussion disqus feedback footer form header menu menus modal nav navbar navigation newsletter notice notices popup promo related reply replies respond responses search share sharing sidebar signup social sponsor sponsored subscribe thread toolbar widget".split())
BOILER_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
GOOD = frozenset("article body content entry main post story text".split())
NAMES = BOILER | GOOD | {"hidden"}
# Words that a text about the page, not of it, is full of.
WORDING = frozenset("account accept advertisement advertising agree archive bookmark browser click comment commented comments contact cookie cookies copyright email follow home imprint links login logout menu newsletter next password policy popular posted previous privacy related replied replies reply reserved rights rss search share signup sitemap sponsored subscribe tags terms trending tweet username website".split())
TALK = frozenset("comments discussion replies responses".split())

_ATTRIBUTE = r"""[^\s>/=]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[\s/=]++|{_ATTRIBUTE})*+)>?|<[!?/][^>]*>?", re.S)
_NAMED = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|aria-hidden\s*=\s*.?true", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Block:
    """Text of one leaf block, with what stands around it."""

    text: str
    tag: str
    ancestors: frozenset[str]
    names: frozenset[str]
    linked: int  # characters inside links


@functools.lru_cache(10_000)
def _names(attributes: str) -> frozenset[str]:
    found = frozenset(w for m in _NAMED.finditer(attributes) for w in _WORD.findall((m[2] or m[3] or m[4] or "").lower()))
    return (found | {"hidden"} if _HIDDEN.search(attributes) else found) & NAMES


class _Open:
    """The open elements: their tags, how many of each tag and name, the last place of each tag."""

    def __init__(self) -> None:
        self.stack: list[tuple[str, frozenset[str], int]] = []  # with the blocks open below it
        self.places: dict[str, list[int]] = {}
        self.names: Counter[str] = Counter()
        self.blocks = self.skipped = 0

    def last(self, tag: str) -> int:
        """Place of the innermost ``tag``, -1 if none is open."""
        found = self.places.get(tag)
        return found[-1] if found else -1

    def push(self, tag: str, names: frozenset[str]) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append((tag, names, self.blocks))
        self.names.update(names)
        self.blocks += tag not in INLINE
        self.skipped += tag in SKIPPED

    def close(self, place: int) -> None:
        """Closes the element at ``place`` and all within."""
        while len(self.stack) > place:
            tag, names, self.blocks = self.stack.pop()
            self.places[tag].pop()
            if not self.places[tag]:
                del self.places[tag]
            for n in names:
                self.names[n] -= 1
                if not self.names[n]:
                    del self.names[n]
            self.skipped -= tag in SKIPPED

    def blocks_within(self, place: int) -> int:
        tag, _, below = self.stack[place]
        return self.blocks - below - (tag not in INLINE)


def leaf_blocks(page: str) -> list[Block]:
    blocks: list[Block] = []
    open_ = _Open()
    pieces: list[str] = []
    linked = at = 0

    def cut() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                ups = frozenset(t if t in TAGS else "other" for t in open_.places if t not in INLINE)
                tag = next((t for t, _, _ in reversed(open_.stack) if t not in INLINE), "") if open_.stack and open_.stack[-1][0] in INLINE else open_.stack[-1][0] if open_.stack else ""
                blocks.append(Block(text, tag if tag in TAGS else "other", ups, frozenset(open_.names), linked))
            pieces.clear()
            linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text and not open_.skipped:
            text = html.unescape(text) if "&" in text else text
            pieces.append(text)
            if "a" in open_.places:
                linked += len(text.strip())

    endless: set[str] = set()
    while True:
        m = _TAG.search(page, at)
        if m is None:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            place = open_.last(tag)
            if tag not in INLINE:
                cut()
            if place >= 0 and not (tag in INLINE and open_.blocks_within(place)):  # an inline end tag does not close blocks
                open_.close(place)
            continue
        if tag == "br":
            if not open_.skipped:
                pieces.append(" ")
            continue
        if tag in RAW:
            end = None if tag in endless else re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            if end is not None:
                at = end.end()
            elif tag == "iframe":
                endless.add(tag)
            else:
                break
            continue
        if tag not in INLINE:
            cut()
            if tag in ENDS_SKIPPED and open_.skipped:
                for skipped in ("svg", "select", "button"):
                    if open_.last(skipped) >= 0:
                        open_.close(open_.last(skipped))
            for ends in SIBLINGS.get(tag, ()):
                place = open_.last(ends)
                if place > max(open_.last(x) for x in LISTS):
                    open_.close(place)
            if open_.last("p") > max(open_.last(x) for x in ("td", "th", "caption", "template")):
                open_.close(open_.last("p"))
        if tag not in VOID and not (m[3] or "").endswith("/"):
            open_.push(tag, _names(m[3] or ""))
    cut()
    return blocks


def _bucket(n: int) -> int:
    return min(n, 400).bit_length()


def features(blocks: list[Block], marks: bool = True) -> list[list[str]]:
    """Features of a page's blocks; without ``marks`` those of the text alone."""
    out = []
    sizes = [b.text.count(" ") + 1 for b in blocks]
    most, talk = max(sizes, default=1), False
    for i, b in enumerate(blocks):
        words = frozenset(_WORD.findall(b.text[:2000].lower()))
        wording = len(words & WORDING)
        short = sizes[i] <= 4
        talk = talk or bool(short and words & TALK)
        own = ["bias", f"words={_bucket(sizes[i])}", f"links={10 * b.linked // max(len(b.text), 1)}", f"stops={min(sum(b.text.count(c) for c in '.!?'), 4)}"]
        own += [f"share={4 * sizes[i] // most}", f"before={_bucket(sizes[i - 1]) if i else '-'}", f"after={_bucket(sizes[i + 1]) if i + 1 < len(blocks) else '-'}"]
        own += [f"wording={min(3, 12 * wording // sizes[i]) if wording else '-'}", f"end={b.text[-1] if b.text[-1] in '.!?:' else 'x'}", f"place={4 * i // len(blocks)}"]
        if talk:
            own.append("talk")
        if "©" in b.text or "·" in b.text:
            own.append("sign")
        if marks:
            own.append(f"tag={b.tag}")
            own += [f"up={t}" for t in b.ancestors]
            own += [f"name={n}" for n in b.names]
        out.append(own)
    return out


def marked_main(block: Block) -> bool:
    """Label by the page's own mark-up."""
    inside = "article" in block.ancestors or "main" in block.ancestors
    return inside and not (BOILER_TAGS & block.ancestors) and not (block.names & BOILER) and "hidden" not in block.names


def made_pages(pages: list[str], n: int, seed: int = 7) -> list[tuple[str, list[bool]]]:
    """Labelled pages in other layouts, filled with the blocks of ``pages``."""
    rng = random.Random(seed)
    main, other = [], []
    for page in pages:
        for b in leaf_blocks(page):
            (main if marked_main(b) else other).append(b.text)
    if not main:
        return []
    other = other or ["menu"]
    esc = html.escape
    short = lambda: esc(" ".join(rng.choice(other).split()[: rng.randint(1, 6)]))
    out = []
    for _ in range(n):
        say = lambda: esc(rng.choice(main))
        # what stands outside or inside the article and is not main text
        noise = {
            "nav": lambda: "<nav><ul>" + "".join(f"<li><a href='/'>{short()}</a></li>" for _ in range(rng.randint(2, 8))) + "</ul></nav>",
            "menu": lambda: f"<div class='{rng.choice(['menu', 'navbar', 'breadcrumbs'])}'>" + "".join(f"<a href='/'>{short()}</a> " for _ in range(4)) + "</div>",
            "header": lambda: f"<header><h2>{short()}</h2><p>{say()}</p></header>",
            "footer": lambda: f"<footer>&copy; {short()} &middot; {say()}</footer>",
            "foot": lambda: f"<div id='footer'><p>{say()}</p></div>",
            "aside": lambda: f"<aside><h3>{short()}</h3><p>{say()}</p></aside>",
            "side": lambda: f"<div class='sidebar'><h4>{short()}</h4><p>{say()}</p><ul><li><a href='/'>{short()}</a></li></ul></div>",
            "ad": lambda: f"<div class='{rng.choice(['ad', 'advert', 'promo', 'sponsored', 'banner'])}'>{say()}</div>",
            "notice": lambda: f"<div class='{rng.choice(['cookie-notice', 'notice', 'consent', 'alert', 'popup'])}'><p>{say()}</p></div>",
            "form": lambda: f"<form><label>{short()}</label><input name='q'><p>{say()}</p></form>",
            "news": lambda: f"<div class='{rng.choice(['newsletter', 'subscribe', 'share', 'related'])}'><p>{say()}</p></div>",
            "bare foot": lambda: f"<p>Copyright {rng.randint(1999, 2030)} {short()}. All rights reserved.</p>",
            "bare links": lambda: "<p>" + " ".join(f"<a href='/'>{short()}</a>" for _ in range(rng.randint(3, 9))) + "</p>",
            "bare form": lambda: f"<div>{rng.choice(['Subscribe to our newsletter', 'Log in or sign up', 'Search this website', 'We use cookies. Accept', 'Follow us and share'])}</div>",
            "bare talk": lambda: f"<div><h3>{rng.choice(['Comments', 'Discussion', '3 Comments', 'Replies'])}</h3>" + "".join(f"<p>{say()}</p>" for _ in range(rng.randint(1, 4))) + "</div>",
            "comments": lambda: f"<{(t := rng.choice(['section', 'div', 'ol']))} {rng.choice(['class', 'id'])}='{rng.choice(['comments', 'comment-list', 'replies', 'comment'])}'>" + "".join(f"<{(u := rng.choice(['p', 'li', 'div', 'article']))}>{say()}</{u}>" for _ in range(rng.randint(1, 4))) + f"</{t}>",
        }
        body: list[tuple[str, list[bool]]] = []

        def add(kinds: list[str], most: int) -> None:
            for k in rng.sample(kinds, rng.randint(0, min(most, len(kinds)))):
                piece = noise[k]()  # noqa: B023
                body.append((piece, [False] * len(leaf_blocks(piece))))  # noqa: B023

        add(["nav", "menu", "header", "notice", "ad", "bare links", "bare form"], 4)
        shell = rng.choice(["<article>", "<main>", "<main><article>", "<div class='content'>", "<div id='main'>", "<div class='post-body'>", "<div class='entry'>", "<section class='story'>", "<td>", "<div>"])
        body.append((shell, []))
        if rng.random() < 0.8:
            body.append((f"<h1>{short()}</h1>", [True]))
        for _ in range(rng.randint(1, 9)):
            tag = rng.choice(["p", "p", "p", "p", "h2", "li", "blockquote", "pre", "div"])
            body.append((f"<{tag}>{short() if tag == 'h2' else say()}</{tag}>", [True]))
            if rng.random() < 0.12:
                add(["ad", "news", "form", "aside", "notice"], 1)
        if rng.random() < 0.3:
            add(["comments", "form", "news", "bare talk"], 2)
        body.append(("".join(f"</{t}>" for t in reversed(re.findall(r"<([a-z]+)", shell))), []))
        add(["comments", "aside", "side", "news", "form", "ad", "bare form", "bare links"], 4)
        add(["bare talk"], 1) if rng.random() < 0.3 else None
        add(["footer", "foot", "bare foot"], 2)
        page = "<html><body>" + "".join(p for p, _ in body) + "</body></html>"
        labels = [x for _, ls in body for x in ls]
        if len(leaf_blocks(page)) == len(labels):
            out.append((page, labels))
    return out


@dataclass(frozen=True)
class Model:
    weights: dict[str, tuple[float, float]]
    transitions: tuple[tuple[float, float], tuple[float, float]]

    def decode(self, blocks: list[Block]) -> list[bool]:
        """Most likely labels (True: main text)."""
        if not blocks:
            return []
        (t00, t01), (t10, t11) = self.transitions
        get, none = self.weights.get, (0.0, 0.0)
        back: list[tuple[bool, bool]] = []
        a = b = 0.0
        for k, fs in enumerate(features(blocks)):
            x = y = 0.0
            for f in fs:
                w = get(f, none)
                x += w[0]
                y += w[1]
            if k:
                stay, go = a + t00 >= b + t10, a + t01 >= b + t11
                back.append((not stay, not go))
                a, b = max(a + t00, b + t10) + x, max(a + t01, b + t11) + y
            else:
                a, b = x, y
        label = b > a
        out = [label]
        for from_other, from_main in reversed(back):
            label = from_main if label else from_other
            out.append(label)
        return out[::-1]


def train(labelled: list[tuple[list[Block], list[bool]]], steps: int = 150, rate: float = 0.15, l2: float = 1e-3) -> Model:
    """Maximum likelihood by Adam; forward-backward runs over all pages at once, each with and
    without the features of its mark-up."""
    labelled = [(b, y, marks) for b, y in labelled if b for marks in (True, False)]
    if not labelled:  # nothing to learn from: longer texts outside of links
        return Model({"links=0": (0.0, 1.0), "links=10": (1.0, 0.0)}, ((0.0, 0.0), (0.0, 0.0)))
    names: dict[str, int] = {}
    page_at, place_at, feature_at = [], [], []
    longest = max(len(b) for b, _, _ in labelled)
    gold = np.zeros((len(labelled), longest), np.int64)
    sizes = np.array([len(b) for b, _, _ in labelled])
    for p, (blocks, labels, marks) in enumerate(labelled):
        gold[p, : len(labels)] = labels
        for t, fs in enumerate(features(blocks, marks)):
            for f in fs:
                page_at.append(p)
                place_at.append(t)
                feature_at.append(names.setdefault(f, len(names)))
    cell = np.array(page_at) * longest + np.array(place_at)
    feature = np.array(feature_at)
    here = np.arange(longest)[None, :] < sizes[:, None]
    both = here[:, 1:]
    one = np.eye(2)[gold] * here[..., None]
    seen = np.zeros((2, 2))
    np.add.at(seen, (gold[:, :-1][both], gold[:, 1:][both]), 1)
    w, move = np.zeros((len(names), 2)), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(move), np.zeros_like(move)]
    n = len(labelled)
    for step in range(1, steps + 1):
        scores = np.stack([np.bincount(cell, w[feature, k], minlength=n * longest) for k in (0, 1)], 1).reshape(n, longest, 2)
        fore = np.zeros((n, longest, 2))
        aft = np.zeros((n, longest, 2))
        fore[:, 0] = scores[:, 0]
        for t in range(1, longest):
            step_in = fore[:, t - 1, :, None] + move
            fore[:, t] = np.where(here[:, t, None], np.logaddexp(step_in[:, 0], step_in[:, 1]) + scores[:, t], fore[:, t - 1])
        for t in range(longest - 2, -1, -1):
            step_out = move + (scores[:, t + 1] + aft[:, t + 1])[:, None, :]
            aft[:, t] = np.where(here[:, t + 1, None], np.logaddexp(step_out[..., 0], step_out[..., 1]), 0.0)
        total = np.logaddexp(fore[:, -1, 0], fore[:, -1, 1])
        marginal = np.exp(fore + aft - total[:, None, None]) * here[..., None]
        pair = np.exp(fore[:, :-1, :, None] + move + (scores + aft)[:, 1:, None, :] - total[:, None, None, None]) * both[..., None, None]
        off = (one - marginal).reshape(-1, 2)[cell]
        grads = [np.stack([np.bincount(feature, off[:, k], minlength=len(names)) for k in (0, 1)], 1) / n - l2 * w, (seen - pair.sum((0, 1))) / n - l2 * move]
        for i, (x, g) in enumerate(zip((w, move), grads)):
            m, v = moments[2 * i], moments[2 * i + 1]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model({f: (float(w[i, 0]), float(w[i, 1])) for f, i in names.items()}, tuple(tuple(float(x) for x in r) for r in move))


def fit(pages: DataFrame, train_pages: int = TRAIN_PAGES, made: int = MADE_PAGES) -> Model:
    """Trains on a bounded sample of ``pages`` (page_id, html); see the module's text."""
    rows = pages.where("html is not null").select("html", F.struct(F.xxhash64("page_id").alias("a"), F.xxhash64("html").alias("b")).alias("key"))
    # the keys first, so that no task sends pages that are not among the smallest of all
    keys = rows.select("key").distinct().orderBy("key").limit(train_pages).collect()
    last = F.struct(*(F.lit(x).cast("long").alias(n) for x, n in zip(keys[-1][0], "ab"))) if keys else None
    sample = [r.html for r in sorted(rows.where(F.col("key") <= last).dropDuplicates(["key"]).collect(), key=lambda r: tuple(r.key))] if keys else []
    labelled = []
    for page in sample:
        blocks = leaf_blocks(page)
        labels = [marked_main(b) for b in blocks]
        if any(labels):
            labelled.append((blocks, labels))
    labelled += [(leaf_blocks(page), labels) for page, labels in made_pages(sample, made)]
    return train(labelled)


def main_text(page: str | None, model: Model) -> str:
    blocks = leaf_blocks(page or "")
    return "\n".join(b.text for b, keep in zip(blocks, model.decode(blocks)) if keep)


def _extract(batches, model: Model):
    for batch in batches:
        texts = [main_text(x.as_py(), model) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(functools.partial(_extract, model=model), "page_id long, url string, text string, n_chars long")
