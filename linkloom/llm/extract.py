"""Main text of web pages, by a linear-chain conditional random field over the leaf blocks of the page.

A page is cut into leaf blocks, runs of text between block tags. Each block is described by its ancestor tags,
what their classes and ids speak of, and its text; the field labels the blocks of a page in sequence, main text
or not, and Viterbi finds the best labelling. It is trained on labelled pages that :func:`labelled_pages` lays
out in many templates with text of random words, so it cannot learn the words, only the layout.

Character references are decoded, white space within a block becomes one space, and blocks of the main text are
joined by an empty line. Scripts, styles, comments and markup are no blocks. Null and empty pages have an empty
text; pages of any length and unclosed tags are handled; rows that repeat are each extracted.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from linkloom.llm.common import map_arrow

#: A comment, a declaration, or a tag. A quote opens a value only after an equals sign; else the tag ends at the next >.
TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*>|"
                   r"<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>", re.S)
COMMENT = re.compile(r"<!--()()().*", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg", "object"}
RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}
#: Start tags that may stand in head; any other one, or text, closes it.
IN_HEAD = set("base basefont bgsound head html link meta noframes noscript script style template title".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q s samp small span "
             "strike strong sub sup time tt u var wbr".split())
#: Open elements that a start tag closes.
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Elements inside which those are looked for.
SCOPES = {"li": {"ul", "ol", "menu"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
ENDS_P = set("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre "
             "section table ul".split())
#: What words in classes, ids and roles, or tags, speak of.
TOPICS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs topbar pagination pager tabs toc skip",
    "head": "header head masthead banner logo site-title branding hero-nav",
    "foot": "footer foot copyright colophon contentinfo legal imprint",
    "side": "aside sidebar side rail related widget complementary recommended recirc more trending popular tags",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner-ad",
    "notice": "notice cookie cookies consent gdpr alert popup modal newsletter warning message disclaimer paywall",
    "form": "form search login signup subscribe subscription button input label select fieldset option",
    "comment": "comment comments commentlist reply replies respond discussion disqus feedback",
    "share": "share sharing social follow byline meta author-box",
    "main": "article main content post entry story body text article-body post-content entry-content prose",
}
TOPIC_OF = {word: topic for topic, words in TOPICS.items() for word in words.split()}
LABELS = 2
SIGNS = ("\ue000", "\ue001")
ROUNDS, RATE = 12, 0.2


def topics(tag: str, attributes: str) -> tuple[str, ...]:
    """What an element's tag, classes, id and role speak of."""
    found = [TOPIC_OF[tag]] if tag in TOPIC_OF and tag not in ("head", "body") else []
    if attributes:
        for _, *values in ATTRIBUTE.findall(attributes):
            for name in "".join(values).lower().split():
                words = [name, *re.split(r"[-_]+", name)]
                found += [TOPIC_OF[w] for w in words if w in TOPIC_OF]
    return tuple(dict.fromkeys(found))


@lru_cache(maxsize=4096)
def topics_of(tag: str, attributes: str) -> tuple[str, ...]:
    return topics(tag, attributes)


def blocks(html: str) -> list[tuple[str, list[tuple[str, tuple]], int]]:
    """``text, ancestors (tag, topics), signs inside links`` of each leaf block, in page order."""
    out: list = []
    stack: list[tuple[str, tuple]] = []
    shown: list[tuple[str, tuple]] = []  # the stack without inline elements that speak of nothing
    opened: Counter = Counter()  # elements of the stack by tag
    parts: list[str] = []
    linked, links, at = 0, 0, 0
    last = html.rfind(">")

    def leave() -> None:
        nonlocal linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append((text, list(shown), linked))
        parts.clear()
        linked = 0

    def enter(element: tuple[str, tuple]) -> None:
        nonlocal links
        stack.append(element)
        opened[element[0]] += 1
        links += element[0] == "a"
        if shows(element):
            shown.append(element)

    def shows(element: tuple[str, tuple]) -> bool:
        return element[0] not in INLINE or bool(element[1])

    def close(begin: int, end: int | None = None) -> None:
        """Take the elements from ``begin`` to ``end``, or to the top, off the stack."""
        nonlocal links
        gone, above = stack[begin:end], sum(map(shows, stack[end:])) if end is not None else 0
        n = sum(map(shows, gone))
        del shown[len(shown) - above - n:len(shown) - above]
        opened.subtract([e[0] for e in gone])
        links -= sum(e[0] == "a" for e in gone)
        del stack[begin:end]

    while at < len(html):
        # without a > to come, only a comment can begin
        match = TOKEN.search(html, at) if at <= last else COMMENT.search(html, at)
        text = html[at:match.start() if match else len(html)]
        if text:
            if stack and stack[-1][0] == "head" and not text.isspace():
                close(len(stack) - 1)
            parts.append(text)
            if links:
                linked += len(text)
        if not match:
            break
        at = match.end()
        if not match[2]:
            continue
        tag = match[2].lower()
        if not match[1] and stack and (tag == "body" or stack[-1][0] == "head" and tag not in IN_HEAD):
            k = next((k for k, e in enumerate(stack) if e[0] == "head"), None)
            if k is not None:
                leave()
                close(k)
        if tag in INLINE and tag != "br":
            if match[1]:
                for k in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                    if stack[k][0] == tag:
                        close(k, k + 1)
                        break
                    if stack[k][0] not in INLINE:
                        break
            elif tag not in VOID:
                enter((tag, topics_of(tag, match[3])))
            continue
        if tag == "br":
            parts.append(" ")
            continue
        leave()
        if match[1]:
            for k in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[k][0] == tag:
                    close(k)
                    break
            continue
        if tag in RAW:
            end = RAW_END[tag].search(html, at)
            at = end.start() if end else len(html)
            enter((tag, ()))
            continue
        closes = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
        scope = SCOPES.get(tag, set())
        for k in range(len(stack) - 1, -1, -1) if any(opened[c] for c in closes) else ():
            if stack[k][0] in closes:
                close(k)
                break
            if stack[k][0] in scope or stack[k][0] not in INLINE and not scope:
                break
        if tag not in VOID:
            enter((tag, topics_of(tag, match[3])))
    leave()
    return [b for b in out if not any(tag in ("head", "title") or tag in RAW for tag, _ in b[1])]


def bucket(n: float, *bounds: float) -> int:
    return sum(n >= b for b in bounds)


@lru_cache(maxsize=8192)
def ancestor_features(ancestors: tuple) -> tuple[str, ...]:
    tags = [tag for tag, _ in ancestors]
    speak = [t for _, found in ancestors for t in found]
    features = [f"tag={tag}" for tag in set(tags)] + [f"has={t}" for t in set(speak)]
    features += [f"leaf={tags[-1] if tags else '-'}", f"inner={speak[-1] if speak else '-'}",
                 f"outer={speak[0] if speak else '-'}"]
    worst = [t for t in speak if t != "main"]
    features.append(f"worst={worst[-1] if worst else '-'}/{'main' in speak}")
    features.append(f"pair={speak[-1] if speak else '-'}/{tags[-1] if tags else '-'}")
    return tuple(features)


def features(block: tuple, at: int, n: int) -> list[str]:
    text, ancestors, linked = block
    share = linked / max(1, len(text))
    found = [*ancestor_features(tuple(ancestors)), f"size={bucket(len(text), 20, 60, 140, 400)}",
             f"links={bucket(share, 0.01, 0.34, 0.8)}", f"stop={text[-1] in '.!?:;'}", f"sign={'©' in text}",
             f"size/links={bucket(len(text), 20, 60, 140, 400)}/{bucket(share, 0.01, 0.34, 0.8)}", "bias"]
    return found + ["first"] * (at == 0) + ["last"] * (at == n - 1)


class Field:
    """Weights of a linear-chain conditional random field with two labels."""

    def __init__(self):
        self.index: dict[str, int] = {}
        self.weights = np.zeros((0, LABELS))
        self.steps = np.zeros((LABELS + 1, LABELS))  # from a label, or from the start, to a label

    def rows(self, page: list[tuple], grow: bool = False) -> list[list[int]]:
        out = []
        for at, block in enumerate(page):
            found = features(block, at, len(page))
            if grow:
                out.append([self.index.setdefault(f, len(self.index)) for f in found])
            else:
                out.append([self.index[f] for f in found if f in self.index])
        return out

    def emissions(self, rows: list[list[int]]) -> np.ndarray:
        if not rows:
            return np.zeros((0, LABELS))
        flat = np.fromiter((i for r in rows for i in r), np.int64)
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        return np.add.reduceat(self.weights[flat], np.cumsum(sizes) - sizes)

    def expected(self, emit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of labels by block, and expected steps, by forward and backward sums."""
        n = len(emit)
        inner = self.steps[:LABELS]
        ahead, behind = np.zeros((n, LABELS)), np.zeros((n, LABELS))
        ahead[0] = emit[0] + self.steps[LABELS]
        for t in range(1, n):
            ahead[t] = emit[t] + np.logaddexp.reduce(ahead[t - 1][:, None] + inner, 0)
        for t in range(n - 2, -1, -1):
            behind[t] = np.logaddexp.reduce(inner + (emit[t + 1] + behind[t + 1])[None, :], 1)
        total = np.logaddexp.reduce(ahead[-1])
        label = np.exp(ahead + behind - total)
        steps = np.zeros_like(self.steps)
        steps[LABELS] = label[0]
        for t in range(1, n):
            steps[:LABELS] += np.exp(ahead[t - 1][:, None] + inner + (emit[t] + behind[t])[None, :] - total)
        return label, steps

    def fit(self, pages: list[tuple[list[tuple], list[int]]], seed: int = 3) -> "Field":
        data = [(self.rows(page, grow=True), labels) for page, labels in pages if page]
        self.weights = np.zeros((len(self.index), LABELS))
        squares, step_squares = np.full(self.weights.shape, 1e-2), np.full(self.steps.shape, 1e-2)
        order = random.Random(seed)
        for _ in range(ROUNDS):
            order.shuffle(data)
            for rows, labels in data:
                label, steps = self.expected(self.emissions(rows))
                g, gs = np.zeros_like(self.weights), -steps
                for t, (own, y) in enumerate(zip(rows, labels)):
                    g[own] -= label[t]
                    g[own, y] += 1
                    gs[labels[t - 1] if t else LABELS, y] += 1
                g -= 1e-3 * self.weights
                squares += g * g
                step_squares += gs * gs
                self.weights += RATE * g / np.sqrt(squares)
                self.steps += RATE * gs / np.sqrt(step_squares)
        return self

    def viterbi(self, page: list[tuple]) -> list[int]:
        """The best labelling of a page's blocks."""
        emit = self.emissions(self.rows(page)).tolist()
        if not emit:
            return []
        (a, b), (c, d) = self.steps[:LABELS].tolist()
        start = self.steps[LABELS].tolist()
        no, yes = emit[0][0] + start[0], emit[0][1] + start[1]
        back = []
        for e0, e1 in emit[1:]:
            from_no, from_yes = no + a >= yes + c, no + b >= yes + d
            back.append((not from_no, not from_yes))
            no, yes = e0 + (no + a if from_no else yes + c), e1 + (no + b if from_yes else yes + d)
        out = [int(yes > no)]
        for step in reversed(back):
            out.append(int(step[out[-1]]))
        return out[::-1]

    def text(self, html: str | None) -> str:
        page = blocks(html or "")
        return "\n\n".join([b[0] for b, label in zip(page, self.viterbi(page)) if label])


def labelled_pages(n: int = 240, seed: int = 11) -> list[tuple[list[tuple], list[int]]]:
    """Pages in many layouts with the label of each block, 1 for main text."""
    r = random.Random(seed)
    syllables = [a + b for a in "bdfgklmnprstvz" for b in "aeiou"]

    def word() -> str:
        return "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))

    def words(low: int, high: int) -> str:
        return " ".join(word() for _ in range(r.randint(low, high)))

    def sentence() -> str:
        return words(3, 22).capitalize() + r.choice(["."] * 7 + ["", "!", "?"])

    def prose() -> str:
        parts = [sentence() for _ in range(r.choice([1, 1, 2, 3, 6]))]
        if r.random() < 0.2:
            parts.insert(r.randint(0, len(parts)), f'<a href="/{word()}">{words(1, 3)}</a>')
        return " ".join(parts)

    pages = []
    for _ in range(n):
        made: list[tuple[str, int | None]] = []  # markup, and the label of the text in it

        def put(markup: str, text: str = "", label: int | None = None, end: str = "") -> None:
            made.append((markup, None))
            if text:
                made.append((text, label))
            made.append((end, None))

        def wrap(tag: str, names: list[str]) -> str:
            name = r.choice(names)
            return f"<{tag}{name and r.choice([' class=', ' id=']) + chr(34) + name + chr(34)}>"

        def link_list(label: int) -> None:
            put("<ul>")
            for _ in range(r.randint(2, 8)):
                put("<li>", f'<a href="/{word()}">{words(1, 3)}</a>', label, "</li>")
            put("</ul>")

        def junk(kinds: list[tuple[str, list[str]]], fill) -> None:
            tag, names = r.choice(kinds)
            put(wrap(tag, names))
            fill()
            put(f"</{tag}>")

        def short() -> None:
            put(r.choice(["", "<p>", "<div>"]), r.choice([prose(), words(1, 6)]), 0)

        def advert() -> None:
            junk([("div", ["ad", "ads", "advert", "sponsored", "promo box", "ad-slot", "advertisement"]),
                  ("aside", ["ad", "promo"]), ("section", ["sponsored", "ads"])], short)

        def notice() -> None:
            junk([("div", ["cookie-banner", "notice", "alert", "gdpr", "newsletter", "consent", "popup"]),
                  ("section", ["cookie", "notice"])], short)

        def form() -> None:
            put('<form action="/q">')
            for tag in r.sample(["label", "button", "p", "legend", "option"], r.randint(1, 3)):
                put(f"<{tag}>", words(1, 6), 0, f"</{tag}>")
            put("</form>")

        def aside() -> None:
            def fill() -> None:
                put("<h3>", words(1, 3), 0, "</h3>")
                r.choice([lambda: link_list(0), short])()
            junk([("aside", ["", "sidebar", "related"]), ("div", ["sidebar", "widget", "related", "rail", "recommended"])], fill)

        def comments() -> None:
            def fill() -> None:
                put("<h3>", words(1, 3), 0, "</h3>")
                for _ in range(r.randint(1, 5)):
                    put(r.choice(['<div class="comment">', "<p>", '<li class="comment">', "<div>", "<article>"]), prose(), 0)
            junk([("section", ["comments", "discussion"]), ("div", ["comments", "comment-list", "replies", "respond"]),
                  ("ol", ["commentlist", "comments"])], fill)

        put("<!DOCTYPE html><html><head><title>x</title></head><body>")
        if r.random() < 0.6:
            def head() -> None:
                put(r.choice(["<h1>", "<p>", "<div>"]), words(1, 5), 0)
                if r.random() < 0.5:
                    link_list(0)
            junk([("header", ["", "masthead", "site-header"]), ("div", ["header", "masthead", "logo", "banner"])], head)
        if r.random() < 0.8:
            junk([("nav", ["", "menu", "navbar"]), ("div", ["nav", "menu", "navigation", "breadcrumbs"]), ("ul", ["menu", "nav"])],
                 lambda: link_list(0))
        for piece in r.sample([advert, notice, form, aside], r.randint(0, 3)):
            piece()
        outer = r.choice(["", "", "<main>", '<div class="content">', '<div id="page">', '<div class="wrapper">'])
        put(outer)
        tag, names = r.choice([("article", ["", "", "", "post", "entry"]), ("main", ["", "content"]),
                               ("div", ["article-body", "post-content", "entry-content", "story", "article", "post"]),
                               ("section", ["article", "story", "content"])])
        put(wrap(tag, names))
        nested = r.random() < 0.15
        put("<header>" if nested else "")
        if r.random() < 0.85:
            put("<h1>", words(1, 9), 1, "</h1>")
        put("</header>" if nested else "")
        for _ in range(r.choice([0, 1, 2, 4, 8, 16])):
            kind = r.random()
            if kind < 0.7:
                put(r.choice(["<p>", "<p>", "<p>", "<p><b>", "<div>"]), r.choice([prose(), prose(), words(1, 3)]), 1,
                    r.choice(["</p>", "</p>", "<br>"]))
            elif kind < 0.8:
                put(r.choice(["<h2>", "<h3>"]), words(1, 6), 1, "</h2>")
            elif kind < 0.88:
                put("<ul>")
                for _ in range(r.randint(1, 5)):
                    put("<li>", r.choice([sentence(), words(1, 5)]), 1, "</li>")
                put("</ul>")
            elif kind < 0.94:
                put(r.choice(["<blockquote>", "<pre>", "<table><tr><td>", "<figcaption>"]), sentence(), 1,
                    "</blockquote></table></figcaption>")
            else:
                r.choice([advert, notice, form, aside])()
        if r.random() < 0.15:
            comments()
        put(f"</{tag}>")
        if r.random() < 0.4:
            comments()
        put("</main>" if outer == "<main>" else "</div>" if outer else "")
        for piece in r.sample([advert, notice, form, aside], r.randint(0, 2)):
            piece()
        if r.random() < 0.9:
            junk([("footer", ["", "site-footer"]), ("div", ["footer", "copyright", "legal"])],
                 lambda: put(r.choice(["", "<p>"]), r.choice([f"&copy; {words(1, 3)} &middot; {prose()}", words(1, 8), prose()]), 0))
        put("</body></html>")
        pages.append(labelled(made))
    return pages


def labelled(made: list[tuple[str, int | None]]) -> tuple[list[tuple], list[int]]:
    """Blocks of a page made of markup and labelled texts. A text carries its label through the parser as a sign."""
    html = "".join(text if label is None else SIGNS[label] + text for text, label in made)
    page, labels = [], []
    for text, ancestors, linked in blocks(html):
        label = int(SIGNS[1] in text)
        text = text.replace(SIGNS[0], "").replace(SIGNS[1], "").strip()
        if text:
            page.append((text, ancestors, linked))
            labels.append(label)
    return page, labels


def trained(pages: int = 240) -> Field:
    return Field().fit(labelled_pages(pages))


def main_text(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    field = field or trained()

    def make(batch: pa.RecordBatch) -> dict:
        texts = [field.text(html) for html in batch.column(2).to_pylist()]
        return {"page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": list(map(len, texts))}

    kind = pages.schema["page_id"].dataType.simpleString()
    return map_arrow(pages.select("page_id", "url", "html"), make,
                     f"page_id {kind}, url string, text string, n_chars long", 256)
