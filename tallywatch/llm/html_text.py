"""Main text of web pages from flat blocks and a decision tree.

A page is cut at its block tags into flat blocks. Each has its word count and link
density, those of its neighbours, and what encloses it; a decision tree trained on
the small table of ``html_labels`` says which blocks are the article.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywatch.llm.common import with_fields
from tallywatch.llm.html_labels import labelled_pages

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>"'=]*)((?:[^>"']|"[^"]*"|'[^']*')*)>"""
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Letters of scripts without spaces between words: Thai, Lao, Burmese, Khmer, kana, Han.
UNSPACED = re.compile(r"[\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u9fff\U00020000-\U0003ffff]")
UNSPACED_WORD = 2  # such letters that count as a word

# Names of HTML elements by what they are.
SKIPPED = frozenset("script style noscript template svg math head title iframe object canvas textarea select option datalist audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr label output".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# What an element, or a word of its class, id or role, says of its content.
ROLES = {
    "article": "article entry post story articlebody blogpost",
    "main": "main content body text prose",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs sitemap",
    "header": "header masthead topbar logo branding banner",
    "footer": "footer colophon copyright legal bottom contentinfo",
    "side": "aside sidebar widget rail related recommended popular trending share sharing social follow tags complementary promo",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored adsense promotion commercial",
    "notice": "notice cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup paywall disclaimer dialog",
    "form": "form search login register button fieldset",
    "comment": "comment comments reply replies respond disqus discussion responses commentlist",
    "hidden": "hidden invisible",
}
ROLE_OF = {word: role for role, words in ROLES.items() for word in words.split()}
NAMES = [*ROLES, "mixed"]  # mixed: of the article by one word, of something else by a weak one
GOOD = {"article", "main"}
# First words of a class that tells a state, and words that tell little of
# what an element is when its name also has one of the article's.
STATES = frozenset("has is no not with without js can".split())
WEAK = frozenset("form search button share sharing social follow tags".split())
FEATURES = ["words", "density", "words_before", "density_before", "words_after", "density_after", *NAMES, "aside", "apart", "heading", "item", "paragraph"]


def n_words(text: str) -> int:
    """Words by white space; in scripts without it, by the number of letters."""
    if text.isascii():
        return len(text.split())
    return len(text.split()) + len(UNSPACED.findall(text)) // UNSPACED_WORD


@dataclass
class Block:
    parts: list[str] = field(default_factory=list)
    linked: list[str] = field(default_factory=list)
    roles: frozenset[str] = frozenset()
    tag: str = ""
    label: bool | None = None
    text: str = ""
    words: int = 0
    density: float = 0.0

    def close(self) -> bool:
        self.text = " ".join(html.unescape("".join(self.parts)).split())
        if not self.text:
            return False
        self.words = n_words(self.text)
        links = n_words(html.unescape(" ".join(self.linked))) if self.linked else 0
        self.density = min(1.0, links / self.words)
        return True


def named_roles(names: list[str]) -> set[str]:
    """What an element's classes, id and role say of it.

    A name such as ``has-comments`` tells a state and says nothing. A name with a word of
    the article and a weak word of something else (``content-form-wide``) is mixed, and
    leaves it to the text; beside a name that is plainly the article's it counts for that.
    """
    own, plain, mixed = set(), False, False
    for name in names:
        words = [t.lower() for t in TOKEN.findall(name)]
        if words and words[0] in STATES:
            continue
        roles = {ROLE_OF[w] for w in words if w in ROLE_OF}
        if roles and roles <= GOOD:
            plain = True
        elif roles & GOOD and all(w in WEAK for w in words if ROLE_OF.get(w, "main") not in GOOD):
            mixed, roles = True, set()
        own |= roles
    if mixed and not plain:
        own.add("mixed")
    return own


def element_roles(tag: str, attributes: str, above: frozenset[str]) -> frozenset[str]:
    """What encloses the content of an element, given what encloses the element."""
    own = set()
    if tag in ("body", "html"):  # what they say of the page holds for all of it
        return above
    if tag in ROLE_OF:
        own.add(ROLE_OF[tag])
    if attributes:
        names = []
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'")
            if name in ("class", "id", "role", "itemprop", "data-role", "aria-label"):
                names += value.split()
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                own.add("hidden")
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                own.add("hidden")
        own |= named_roles(names)
    if not own:
        return above
    if "header" in own and (own | above) & GOOD and tag not in ("article", "main"):
        own.discard("header")  # an article's own head
    if tag in ("article", "main"):
        own -= {"header", "side", "nav", "footer", "form", "notice"}
        if "comment" not in above:  # layouts name their parts in what encloses all of it
            above = above & {"article", "main", "hidden", "comment"}
    return frozenset(above | own)


def blocks(page: str | None) -> list[Block]:
    """The page's blocks of text, in order; what is no text and no markup is left out."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = [("", frozenset())]
    labels: list[bool] = []
    block, in_link, at, n = Block(), False, 0, len(page)

    def end() -> None:
        nonlocal block
        if block.parts and block.close():
            out.append(block)
        block = Block(roles=stack[-1][1], tag=stack[-1][0], label=labels[-1] if labels else None)

    while at < n:
        m = MARKUP.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text:
            block.parts.append(text)
            if in_link:
                block.linked.append(text)
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing = bool(m[1] or m[4])
        if tag in ("x-kept", "x-dropped"):
            end()
            labels = labels[:-1] if closing else [*labels, tag == "x-kept"]
            block.label = labels[-1] if labels else None
            continue
        if tag in SKIPPED:
            end()
            if not closing and not (m[3] or m[6] or "").endswith("/"):
                gone = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                if tag in ("head", "title", "select", "option", "object") and not gone:
                    continue  # left open: its elements speak for themselves
                at = gone.end() if gone else n
            continue
        if tag == "a":
            in_link = not closing
            continue
        if tag == "br":
            block.parts.append(" ")
            continue
        if tag in INLINE:
            continue
        end()
        if closing:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            in_link = False if tag in ("nav", "ul", "footer", "div") else in_link
        elif tag not in VOID:
            if tag in ("p", *HEADINGS) or (tag == "li" and stack[-1][0] == "p"):
                while stack[-1][0] == "p":
                    stack.pop()
            if tag in ("li", "tr", "td", "th", "dt", "dd") and stack[-1][0] == tag:
                stack.pop()
            stack.append((tag, element_roles(tag, m[3] or m[6] or "", stack[-1][1])))
        block = Block(roles=stack[-1][1], tag=stack[-1][0], label=labels[-1] if labels else None)
    end()
    return out


def features(page: list[Block]) -> np.ndarray:
    """A row for each block, see ``FEATURES``.

    ``aside``: something that encloses it is no article; ``apart``: the page names its
    article, and the block is not in it.
    """
    out = np.zeros((len(page), len(FEATURES)))
    unlike = [b.roles - GOOD - {"mixed"} for b in page]
    whole = any(b.roles & GOOD and not bad for b, bad in zip(page, unlike))  # it names its article
    for i, b in enumerate(page):
        out[i, :2] = b.words, b.density
        out[i, 6 : 6 + len(NAMES)] = [role in b.roles for role in NAMES]
        bad, good = bool(unlike[i]), bool(b.roles & GOOD)
        kinds = b.tag in HEADINGS, b.tag == "li", b.tag == "p"
        out[i, 6 + len(NAMES) :] = bad, whole and not good, *kinds
    if len(page):
        out[1:, 2:4] = out[:-1, :2]
        out[:-1, 4:6] = out[1:, :2]
    return out


@dataclass
class Tree:
    """A node: rows whose ``feature`` is at most ``cut`` go left; a leaf has a share."""

    share: float
    feature: int = -1
    cut: float = 0.0
    left: "Tree | None" = None
    right: "Tree | None" = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.share)
        low, out = x[:, self.feature] <= self.cut, np.zeros(len(x))
        out[low], out[~low] = self.left.predict(x[low]), self.right.predict(x[~low])
        return out


def grow(x: np.ndarray, y: np.ndarray, depth: int, least: int = 4) -> Tree:
    """Splits by the largest fall of the Gini impurity; the first feature wins ties."""
    tree, n = Tree(float(y.mean()) if len(y) else 0.0), len(y)
    if depth == 0 or n < 2 * least or y.min() == y.max():
        return tree
    best = (1e-9, -1, 0.0)
    whole = 2 * tree.share * (1 - tree.share)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, t = x[order, f], np.cumsum(y[order])
        k = np.arange(1, n)
        ok = (v[1:] > v[:-1]) & (k >= least) & (n - k >= least)
        if not ok.any():
            continue
        a, b = t[:-1] / k, (t[-1] - t[:-1]) / (n - k)
        gain = whole - (k * 2 * a * (1 - a) + (n - k) * 2 * b * (1 - b)) / n
        gain[~ok] = -1
        i = int(gain.argmax())
        if gain[i] > best[0] + 1e-12:
            best = (float(gain[i]), f, float((v[i] + v[i + 1]) / 2))
    if best[1] < 0:
        return tree
    tree.feature, tree.cut = best[1], best[2]
    low = x[:, tree.feature] <= tree.cut
    tree.left = grow(x[low], y[low], depth - 1, least)
    tree.right = grow(x[~low], y[~low], depth - 1, least)
    return tree


@cache
def trained(depth: int = 14) -> Tree:
    """The tree of the labelled table."""
    x, y = [], []
    for page in labelled_pages():
        found = blocks(page)
        x.append(features(found))
        y.extend(bool(b.label) for b in found)
    return grow(np.concatenate(x), np.array(y, float), depth)


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (html) with ``text``, the main text, and ``n_chars``, its code points.

    The blocks that the tree keeps, in page order, joined by one space; white space
    within a block is one space, character references are decoded. Null and empty
    pages, and pages without such a block, have an empty text. Pages cut off anywhere
    are read as far as they go, very long ones whole; repeated rows are treated alike and
    an empty table gives none. Columns named ``text`` or ``n_chars`` are replaced;
    html itself is left out.
    """
    tree = trained()
    keep = [c for c in pages.columns if c.lower() not in ("text", "n_chars", "html")]

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(h.as_py()) for h in batch.column("html")]
            shares = iter(())
            if any(found):
                shares = iter(tree.predict(np.concatenate([features(f) for f in found if f])))
            texts = [" ".join([b.text for b in f if next(shares) >= 0.5]) for f in found]
            columns = [batch.column(c) for c in keep]
            columns += [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "text", "n_chars"])

    schema = with_fields(
        pages.select(*keep).schema, ("text", T.StringType()), ("n_chars", T.LongType())
    )
    return pages.select(*keep, F.col("html")).mapInArrow(extracted, schema)
