"""Main text of web pages: gradient-boosted trees over DOM nodes, decoded along the tree.

Every element becomes one row of features (its tag and attribute words, those around it,
the density of text and links below it, its depth, its siblings).  Spark ML fits boosted
trees on pages laid out here in many ways from the words of a bounded sample of the given
pages, where it is known which text is the article.  Scoring and decoding run in one pass
over all pages without a shuffle: a dropped element drops all below it, and the choice of
kept and dropped elements with the highest joint probability is found bottom-up, so no
descendant of a dropped ancestor is kept.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from html import escape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages whose words make the training layouts (a bounded sample), and layouts made of each.
TRAINING_PAGES, LAYOUTS = 300, 3

# Elements by their role in the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SKIPPED = frozenset("script style noscript template svg iframe object canvas audio video head title "
                    "select textarea datalist annotation annotation-xml".split())
HEAD_CONTENT = frozenset("base basefont bgsound link meta title script style noscript template noframes head".split())
#: Formulas are text of the element that they stand in; cells and rows of a matrix are set apart.
MATH = frozenset("math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms "
                 "mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 "
                     "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
#: Elements whose start ends a skipped element that is never closed.
BLOCKS = CLOSES_P | frozenset("body li dt dd tr td th tbody thead tfoot".split())
CLOSED_BY_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"),
                  "th": ("tr", "table"), "option": ("select",)}

# Words of tags, classes, ids and roles that speak for or against main text.
AGAINST = frozenset("""ad ads advert adverts advertisement advertising alert aside author banner bio breadcrumb breadcrumbs btn button
caption cart comment comments commentlist complementary consent contentinfo cookie cookies copyright credit dialog discuss
disqus dropdown feedback footer foot form gdpr head header hidden legal login masthead menu meta modal nav navbar navigation
newsletter notice notification outbrain overlay pager pagination pagetop paging paywall popup privacy promo promoted
promotion rating recommend recommended register related reply replies respond response responses review reviews rss rail
screen search share sharing shop sidebar sidenav signup skip social sponsor sponsored subscribe subscription tabs tag tags
taboola teaser toc tool toolbar tools top topbar trending tweet user utility warning widget""".split())
FOR = frozenset("""article articlebody blog body chapter content contents copy description document entry essay hentry main
maincontent news page paragraph post posting postbody prose richtext section story storybody text""".split())
BOILER_TAGS = frozenset("nav header footer aside form button dialog menu fieldset legend".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
KINDS = ("p", "div", "section", "article", "main", "ul", "ol", "li", "table", "tr", "td", "th", "a", "span", "b", "strong", "em",
         "blockquote", "pre", "figure", "body", "html")
KIND = {t: i + 1 for i, t in enumerate(KINDS)}
MARK = "\ue000"  # stands before article text in training pages only


class Page(HTMLParser):
    """The elements of a page in order: tag, attribute words, parent and pieces of text.

    Skipped elements go up to their end tag.  Those that have none (their parent ends
    before, or the page) end at the next block or their parent's end tag; the page is then
    read again.  A head ends where something begins that cannot be in a head.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.unclosed: set[int] = set()  # skipped elements without an end tag, by their number on the page
        known = -1
        while known < len(self.unclosed):
            known = len(self.unclosed)
            self._read(html)

    def _read(self, html: str) -> None:
        self.reset()
        self.tag, self.parent, self.words, self.hidden = ["#page"], [0], [frozenset()], [False]
        self.pieces: list[tuple[int, str | None]] = []  # (element, text), or None where a block begins or ends
        self.stack = [0]
        self.depths: dict[str, list[int]] = {}  # where the open elements of a tag are in the stack
        self.skipped: list[tuple[str, int]] = []  # the skipped element and what is open in it: tag, number or -1
        self.n_skipped = 0
        self.feed(html)
        self.close()
        self._give_up(0)

    def _open(self, tag: str, attrs: list) -> None:
        words, hidden = set(), False
        for name, value in attrs:
            value = value or ""
            if name in ("class", "id", "role", "itemprop", "aria-label"):
                words.update(w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower()) if w)
            hidden |= name == "hidden" or name == "aria-hidden" and value == "true" \
                or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value) is not None
        self.tag.append(tag)
        self.parent.append(self.stack[-1])
        self.words.append(frozenset(words))
        self.hidden.append(hidden)
        self.depths.setdefault(tag, []).append(len(self.stack))
        self.stack.append(len(self.tag) - 1)

    def _give_up(self, depth: int) -> None:
        """End what is open in the skipped element from ``depth`` on, without end tags."""
        self.unclosed.update(n for tag, n in self.skipped[depth:] if n >= 0 and tag != "head")
        del self.skipped[depth:]

    def _skip(self, tag: str) -> bool:
        """Whether a start tag is, or is in, a skipped element."""
        if self.skipped:
            if self.skipped[-1][0] == "head" and tag not in HEAD_CONTENT:
                self.skipped.pop()
            elif tag in BLOCKS and all(n < 0 or t == "head" or n in self.unclosed for t, n in self.skipped):
                self.skipped.clear()
        if not self.skipped and tag not in SKIPPED:
            return False
        if tag not in VOID:
            self.skipped.append((tag, self.n_skipped if tag in SKIPPED else -1))
            self.n_skipped += tag in SKIPPED
        return True

    def _pop_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            e = self.stack.pop()
            self.depths[self.tag[e]].pop()
            if self.tag[e] not in INLINE:
                self.pieces.append((e, None))

    def _find(self, tag: str, until: tuple[str, ...]) -> int:
        """Depth of the innermost open ``tag`` that no tag of ``until`` encloses; 0 for none."""
        depth = (self.depths.get(tag) or (0,))[-1]
        return 0 if any(at[-1] > depth for u in until if u != tag and (at := self.depths.get(u))) else depth

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self._skip(tag):
            return
        if tag in MATH:
            if tag in ("mtd", "mtr"):
                self.pieces.append((self.stack[-1], " "))
            return
        if tag in CLOSES_P and (depth := self._find("p", ("table", "td", "th", "button", "body"))):
            self._pop_to(depth)
        if tag in CLOSED_BY_SAME:
            for same in (("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,)):
                if depth := self._find(same, CLOSED_BY_SAME[tag]):
                    self._pop_to(depth)
        if tag in VOID:
            self.pieces.append((self.stack[-1], " " if tag in INLINE else None))
            return
        if tag not in INLINE:
            self.pieces.append((self.stack[-1], None))
        self._open(tag, attrs)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        elif tag not in SKIPPED:
            self.handle_starttag(tag, attrs)  # outside foreign content the slash means nothing

    def handle_endtag(self, tag: str) -> None:
        if self.skipped:
            depth = max((k for k, (t, _) in enumerate(self.skipped) if t == tag), default=-1)
            if depth >= 0:
                self._give_up(depth + 1)
                self.skipped.pop()
                return
            # A stray </p> is common, and no sign that the element has no end tag of its own.
            known = all(n < 0 or t == "head" or n in self.unclosed for t, n in self.skipped)
            if not (known or tag != "p") or not self._find(tag, ()):
                return
            self._give_up(0)
        until = tuple(t for t in ("table", "td", "th", "li", "div", "p", "article", "section")) if tag in INLINE else ()
        if depth := self._find(tag, until):
            self._pop_to(depth)

    def handle_data(self, data: str) -> None:
        if len(self.skipped) == 1 and self.skipped[0][0] == "head" and data.strip():
            self.skipped.clear()
        if not self.skipped:
            self.pieces.append((self.stack[-1], data))


FEATURES = ("kind", "boiler_tag", "heading", "inline", "against", "for", "hidden", "above_boiler_tag", "above_article",
            "above_against", "above_for", "steps_to_against", "steps_to_for", "depth", "chars", "share", "words_a_block", "links",
            "link_share", "stops", "blocks", "forms", "siblings", "same_siblings", "place", "share_of_parent", "headings_below",
            "against_below", "for_below", "paragraphs")


def features(page: Page) -> np.ndarray:
    """One row of ``FEATURES`` per element."""
    n, parent, tag = len(page.tag), page.parent, page.tag
    zero = lambda: [0] * n
    in_link = [False] * n
    boiler, heading, inline, against, good, article = zero(), zero(), zero(), zero(), zero(), zero()
    above = [(0, 0, 0, 0)] * n
    near_bad, near_good, depth, kids, same = [9] * n, [9] * n, zero(), zero(), {}
    for v in range(1, n):
        u, t, words = parent[v], tag[v], page.words[v]
        in_link[v] = in_link[u] or t == "a"
        boiler[v], heading[v], inline[v] = t in BOILER_TAGS, t in HEADINGS, t in INLINE
        article[v] = t in ("article", "main")
        if words:
            against[v], good[v] = not words.isdisjoint(AGAINST), not words.isdisjoint(FOR)
        depth[v] = depth[u] + 1
        w = above[u]
        above[v] = (w[0] or boiler[u], w[1] or article[u], w[2] or against[u], w[3] or good[u])
        near_bad[v] = 0 if against[v] or boiler[v] else min(near_bad[u] + 1, 9)
        near_good[v] = 0 if good[v] or article[v] else min(near_good[u] + 1, 9)
        kids[u] += 1
        same[u, t] = same.get((u, t), 0) + 1
    chars, link, words_in, stops, blocks = zero(), zero(), zero(), zero(), zero()
    seen = set()
    for v, text in page.pieces:
        if text is None:
            seen.discard(v)
            continue
        text = text.replace(MARK, "").strip()
        if text:
            chars[v] += len(text)
            link[v] += len(text) * in_link[v]
            words_in[v] += text.count(" ") + 1
            stops[v] += sum(map(text.count, ".,;:!?"))
            if v not in seen:
                blocks[v] += 1
                seen.add(v)
    links = [t == "a" for t in tag]
    forms = [t in ("form", "button", "label", "input") for t in tag]
    paragraphs = [t == "p" for t in tag]
    bad = [x or y for x, y in zip(against, boiler, strict=True)]
    below = np.array([chars, link, words_in, stops, blocks, links, forms, heading, bad, good, paragraphs], float).T
    rows = below.tolist()
    for v in range(n - 1, 0, -1):
        rows[parent[v]] = [x + y for x, y in zip(rows[parent[v]], rows[v], strict=True)]
    chars, link, words_in, stops, blocks, links, forms, heads, bad, good_below, paragraphs = np.array(rows).T
    up, safe = np.array(parent), np.maximum(chars, 1)
    near = np.array(above, float)
    return np.stack([
        [KIND.get(t, 0) for t in tag], boiler, heading, inline, against, good, page.hidden, near[:, 0], near[:, 1], near[:, 2],
        near[:, 3], near_bad, near_good, depth, np.log1p(chars), chars / max(chars[0], 1), words_in / np.maximum(blocks, 1),
        np.log1p(links), link / safe, 100 * stops / safe, np.log1p(blocks), forms, np.array(kids)[up],
        [same.get((u, t), 1) for u, t in zip(parent, tag, strict=True)], np.arange(n) / n, chars / np.maximum(chars[up], 1),
        heads, np.log1p(bad), np.log1p(good_below), np.log1p(paragraphs)], axis=1).astype(float)


def decode(page: Page, probability: np.ndarray) -> np.ndarray:
    """Elements to keep: the likeliest choice in which all below a dropped element is dropped."""
    q = np.clip(probability, 1e-6, 1 - 1e-6)
    drop, keep = np.log(1 - q), np.log(q)
    for v in range(len(q) - 1, 0, -1):
        u = page.parent[v]
        keep[u] += max(drop[v], keep[v])
        drop[u] += drop[v]
    kept = keep >= drop
    kept[0] = True
    for v in range(1, len(q)):
        kept[v] &= kept[page.parent[v]]
    return kept


def main_text(page: Page, kept: np.ndarray) -> str:
    """The kept elements' blocks in page order, one a line; white space inside a block is one space."""
    blocks, current = [], []
    for v, text in [*page.pieces, (0, None)]:
        if text is None:
            if block := " ".join("".join(current).split()):
                blocks.append(block)
            current = []
        elif kept[v]:
            current.append(text)
    return "\n".join(blocks)


# Training pages -------------------------------------------------------------------------


def _layout(words: list[str], rng: random.Random) -> str:
    """A page with marked article text, in one of many layouts, out of the given words."""
    pick = rng.choice

    def text(least: int, most: int, marked: bool = False) -> str:
        n = rng.randint(least, most)
        at = rng.randrange(max(1, len(words) - n))
        return (MARK if marked else "") + escape(" ".join(words[at:at + n]) or "word") + pick(("", ".", ".", "!"))

    def name(*options: str) -> str:
        w = pick(options)
        return pick((f' class="{w}"', f' id="{w}"', f' class="{pick(("box", "block", "wrap", "inner", "col", "row"))} {w}"'))

    def links(n: int) -> str:
        li = "".join(f'<li><a href="/{i}">{text(1, 3)}</a></li>' for i in range(n))
        return pick((f"<ul>{li}</ul>", "".join(f'<a href="/{i}">{text(1, 3)}</a> | ' for i in range(n))))

    def bold(s: str) -> str:
        k = rng.random()
        return f"<b>{s}<br>" if k < 0.15 else f"<strong>{s}</strong>" if k < 0.2 else s

    def block() -> str:
        k = rng.random()
        if k < 0.72:
            return f"<p>{bold(text(1, 90, True))}" + pick(("</p>", "</p>", ""))
        if k < 0.78:
            return f"<h{(h := pick((2, 3)))}>{text(2, 8, True)}</h{h}>"
        if k < 0.84:
            return pick(("<ul>{}</ul>", "<ol>{}</ol>")).format("".join(f"<li>{text(2, 25, True)}</li>" for _ in range(rng.randint(2, 6))))
        if k < 0.87:
            return f"<blockquote><p>{text(8, 40, True)}</p></blockquote>"
        if k < 0.9:
            rows = "".join(f"<tr><td>{text(1, 4, True)}</td><td>{text(1, 4, True)}</td></tr>" for _ in range(rng.randint(2, 4)))
            return f"<table>{rows}</table>"
        if k < 0.93:
            return f"<pre>{text(4, 30, True)}</pre>"
        if k < 0.96:
            return f'<p>{text(5, 30, True)} <a href="/x">{text(1, 4, True)}</a> {text(5, 30, True)}</p>'
        return f"<div>{text(10, 60, True)}</div>"

    def boiler() -> str:
        k = rng.randrange(14)
        short, long = text(2, 14), text(10, 60)
        return (
            lambda: f"<nav{pick(('', name('menu', 'navbar', 'breadcrumb')))}>{links(rng.randint(3, 9))}</nav>",
            lambda: f"<div{name('menu', 'navigation', 'breadcrumbs', 'topbar', 'nav-main', 'pagination')}>{links(rng.randint(2, 9))}</div>",
            lambda: f"<div{name('ad', 'ads', 'advert', 'sponsored', 'promo-box', 'ad-slot', 'advertisement')}>{pick((short, f'<p>{long}</p>'))}</div>",
            lambda: f"<aside{pick(('', name('sidebar', 'related', 'widget')))}>"
                    f"{pick((links(4), f'<p>{long}</p>', f'<h3>{short}</h3><p>{long}</p>'))}</aside>",
            lambda: f"<div{name('sidebar', 'right-sidebar', 'widget-area', 'related-posts', 'recommended')}>"
                    f"<h3>{short}</h3>{pick((links(5), f'<p>{long}</p><p>{text(5, 30)}</p>'))}</div>",
            lambda: f"<div{name('cookie-notice', 'cookie-banner', 'notice', 'alert', 'consent', 'notification', 'warning')}>"
                    f"{pick((long, f'<p>{long}</p>'))}<button>{text(1, 2)}</button></div>",
            lambda: f"<form{pick(('', name('search', 'newsletter', 'login', 'signup')))}><label>{short}</label><input><button>{text(1, 2)}</button></form>",
            lambda: f"<div{name('newsletter', 'subscribe', 'signup-form')}><p>{long}</p><form><input><button>{text(1, 2)}</button></form></div>",
            lambda: f"<div{name('share', 'social', 'share-buttons', 'tags', 'post-meta', 'toolbar')}>{pick((links(4), short))}</div>",
            lambda: f'<div role="{pick(("alert", "dialog", "complementary", "search", "navigation"))}">{pick((short, f"<p>{long}</p>"))}</div>',
            lambda: f'<div{pick((" hidden", " style=\"display:none\""))}><p>{long}</p></div>',
            lambda: f"<p{name('copyright', 'notice', 'disclaimer-notice', 'advert')}>{short}</p>",
            lambda: f"<section{name('related', 'comments', 'promo', 'trending')}><h2>{short}</h2><p>{long}</p><p>{text(5, 40)}</p></section>",
            lambda: f"<header>{pick((short, links(4), f'<h2>{short}</h2>'))}</header>",
        )[k]()

    def comments() -> str:
        one = lambda: pick((
            f"<div{name('comment', 'comment-body', 'reply')}><p>{text(4, 60)}</p></div>",
            f"<li{name('comment', 'reply')}><b>{text(1, 2)}</b><p>{text(4, 60)}</p></li>",
            f"<article{name('comment')}><p>{text(4, 60)}</p></article>"))
        many = "".join(one() for _ in range(rng.randint(1, 8)))
        return pick((f"<section{name('comments', 'discussion-comments', 'responses')}><h2>{text(1, 3)}</h2>{many}</section>",
                     f"<div{name('comments', 'comment-list', 'disqus', 'comments-area')}>{many}</div>",
                     f"<ol{name('commentlist', 'comments')}>{many}</ol>"))

    title = text(2, 14, True)
    heading = pick((f"<h1>{title}</h1>", f"<h1>{title}</h1>", f"<header><h1>{title}</h1></header>", ""))
    blocks = [block() for _ in range(rng.choice((1, 2, 3, 5, 8, 14, 25)))]
    if rng.random() < 0.3:  # boilerplate inside the article
        blocks.insert(rng.randrange(len(blocks) + 1), boiler())
    if rng.random() < 0.2 and len(blocks) > 1:
        cut = rng.randrange(1, len(blocks))
        blocks = [f"<section>{''.join(blocks[:cut])}</section>", f"<section>{''.join(blocks[cut:])}</section>"]
    inside = heading + "".join(blocks) + (comments() if rng.random() < 0.1 else "")
    k = rng.random()
    if k < 0.45:
        body = f"<article{pick(('', '', name('post', 'entry', 'hentry', 'story')))}>{inside}</article>"
    elif k < 0.6:
        body = f"<main>{inside}</main>"
    elif k < 0.9:
        body = f"<div{name('content', 'article-body', 'post-content', 'entry-content', 'story', 'main', 'main-content', 'text', 'post')}>{inside}</div>"
    elif k < 0.95:
        body = f"<table><tr><td>{inside}</td></tr></table>"
    else:
        body = f"<div>{inside}</div>"
    if rng.random() < 0.25:
        body = pick((f"<main>{body}</main>", f'<div role="main">{body}</div>', f"<div{name('container', 'page', 'wrapper')}>{body}</div>"))
    top = pick(("", f"<header>{pick((text(1, 6), links(4)))}{pick(('', f'<nav>{links(5)}</nav>', f'<h1>{text(1, 4)}</h1>'))}</header>",
                f"<nav>{links(rng.randint(3, 8))}</nav>", f"<div{name('header', 'masthead')}>{text(1, 9)}</div>"))
    before = "".join(boiler() for _ in range(rng.randint(0, 3)))
    after = "".join(boiler() for _ in range(rng.randint(0, 3))) + (comments() if rng.random() < 0.35 else "")
    foot = pick((f"<footer>{text(2, 20)}</footer>", f"<footer>&copy; {text(1, 4)} &middot; {text(3, 20)}</footer>",
                 f"<footer>{links(4)}<p>{text(4, 20)}</p></footer>", f"<div{name('footer', 'site-footer', 'copyright')}>{text(3, 25)}</div>", ""))
    if rng.random() < 0.15:
        before, after = f'<div class="sidebar">{before}</div>', after
    return f"<!DOCTYPE html><html><head><title>x</title></head><body>{top}{before}{body}{after}{foot}</body></html>"


def _labelled(words: list[str], rng: random.Random) -> tuple[np.ndarray, np.ndarray]:
    page = Page(_layout(words, rng))
    label = np.zeros(len(page.tag))
    for v, text in page.pieces:
        if text and MARK in text:
            label[v] = 1
    for v in range(len(label) - 1, 0, -1):
        label[page.parent[v]] = max(label[page.parent[v]], label[v])
    return features(page), label


def training_rows(pages: DataFrame, page: str = "page_id", html: str = "html", n_pages: int = TRAINING_PAGES,
                  layouts: int = LAYOUTS) -> DataFrame:
    """(x, label): the elements of laid-out pages; at most ``n_pages`` given pages lend their words."""
    few = pages.select(F.col(page).alias("page"), F.col(html).alias("html"), F.xxhash64(F.lit(3), page).alias("h")) \
        .orderBy("h", "page").limit(n_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for seed, t in zip(b.column("h").to_pylist(), b.column("html").to_pylist(), strict=True):
                words = " ".join(x for _, x in Page(t or "").pieces if x).split()[:3000] or ["word"]
                rng = random.Random(seed)
                for _ in range(layouts):
                    x, y = _labelled(words, rng)
                    with_text = x[:, FEATURES.index("chars")] > 0
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x[with_text].tolist(), pa.list_(pa.float64())), pa.array(y[with_text])], ["x", "label"])

    return few.repartition(6).mapInArrow(run, "x array<double>, label double")


class Trees:
    """Boosted trees as arrays: split feature, threshold, children and leaf value of every node."""

    def __init__(self, text: str, weights: list[float]):
        self.weights, self.trees = weights, []
        for part in re.split(r"\n\s*Tree \d+ \(weight [^)]*\):\n", "\n" + text)[1:]:
            lines = [x.strip() for x in part.splitlines() if x.strip()]
            feature, bound, left, right, value = [], [], [], [], []
            at = 0

            def read() -> int:
                nonlocal at
                me = len(feature)
                for x in (feature, bound, left, right, value):
                    x.append(0)
                if m := re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at]):
                    feature[me], bound[me] = int(m[1]), float(m[2])
                    at += 1
                    left[me] = read()
                    at += 1  # Else
                    right[me] = read()
                else:
                    value[me] = float(lines[at].removeprefix("Predict: "))
                    left[me] = right[me] = me
                    bound[me] = np.inf
                    at += 1
                return me

            read()
            self.trees.append(tuple(np.array(x) for x in (feature, bound, left, right, value)))

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        rows = np.arange(len(x))
        for weight, (feature, bound, left, right, value) in zip(self.weights, self.trees, strict=True):
            node = np.zeros(len(x), np.int64)
            while True:
                to = np.where(x[rows, feature[node]] <= bound[node], left[node], right[node])
                if np.array_equal(to, node):
                    break
                node = to
            margin += weight * value[node]
        return 1 / (1 + np.exp(-2 * margin))


def fit(rows: DataFrame, iterations: int = 20, depth: int = 5) -> Trees:
    """Spark ML's boosted trees on the labelled elements."""
    data = rows.select(array_to_vector("x").alias("features"), "label").persist()
    model = GBTClassifier(maxIter=iterations, maxDepth=depth, stepSize=0.3, seed=5, maxBins=48).fit(data)
    data.unpersist()
    return Trees(model.toDebugString, list(model.treeWeights))


def extract(pages: DataFrame, trees: Trees, page: str = "page_id", html: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """(page, *keep, text, n_chars), one row per page.

    A null or empty html has an empty text; so has a page where every element is dropped.
    Repeated rows are treated alike.
    """
    kinds = {c: pages.schema[s].dataType for c, s in [("page", page), *[(k, k) for k in keep]]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for at in range(0, b.num_rows, 128):  # so many pages are scored together
                doms = [Page(t.as_py() or "") for t in b.column("html")[at:at + 128]]
                rows = [features(dom) for dom in doms]
                p = np.split(trees.probability(np.concatenate(rows)), np.cumsum([len(x) for x in rows])[:-1])
                texts += [main_text(dom, decode(dom, x)) for dom, x in zip(doms, p, strict=True)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kinds], pa.array(texts, pa.string())], [*kinds, "text"])

    rows = pages.select(F.col(page).alias("page"), *keep, F.col(html).alias("html"))
    out = rows.mapInArrow(run, ", ".join(f"`{c}` {k.simpleString()}" for c, k in kinds.items()) + ", text string")
    return out.withColumn("n_chars", F.char_length("text").cast("long"))
