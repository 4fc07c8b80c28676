"""The labelled table the block classifier is trained on.

Pieces of pages, labelled by hand: kept or not. ``{s}``, ``{m}`` and ``{l}`` stand
for a short, a middling and a long run of words, ``{a}`` for a few links. Pages are
put together from the pieces in a fixed order of their own.
"""

from __future__ import annotations

import random

DROPPED = (
    "<nav><ul>{a}</ul></nav>",
    "<nav><p>{m}</p></nav>",
    "<nav>{s}</nav>",
    '<div class="menu"><ul>{a}</ul></div>',
    '<ul id="main-nav">{a}</ul>',
    '<div class="breadcrumbs"><span>{s}</span></div>',
    "<ul>{a}</ul>",
    "<p><a href=x>{s}</a> | <a href=y>{s}</a></p>",
    "<header><h1>{s}</h1><p>{s}</p></header>",
    "<header><p>{m}</p></header>",
    '<div id="header"><h2>{s}</h2><p>{s}</p></div>',
    '<div class="masthead"><p>{s}</p></div>',
    "<footer><p>{s}</p></footer>",
    "<footer>{s}</footer>",
    "<footer><p>{m}</p><p>{l}</p></footer>",
    '<div class="footer"><p>{m}</p><ul>{a}</ul></div>',
    '<div class="copyright">{s}</div>',
    "<aside><h3>{s}</h3><p>{m}</p></aside>",
    "<aside><p>{l}</p></aside>",
    "<aside>{s}</aside>",
    '<div class="sidebar"><h3>{s}</h3><p>{l}</p><ul>{a}</ul></div>',
    '<div class="widget"><p>{m}</p></div>',
    '<div class="related"><h3>{s}</h3><ul>{a}</ul><p>{m}</p></div>',
    '<div class="share"><p>{s}</p></div>',
    '<div class="ad">{s}</div>',
    '<div class="ad"><p>{m}</p></div>',
    '<div class="advertisement"><p>{l}</p></div>',
    '<div id="sponsored"><p>{m}</p><p>{s}</p></div>',
    '<div class="cookie-notice"><p>{m}</p><p>{s}</p></div>',
    '<div class="notice">{l}</div>',
    '<div class="popup"><p>{s}</p></div>',
    '<div class="newsletter"><h3>{s}</h3><p>{m}</p></div>',
    "<form><p>{s}</p><label>{s}</label><button>{s}</button></form>",
    "<form><p>{m}</p></form>",
    '<div class="search"><p>{s}</p></div>',
    '<section id="comments"><h2>{s}</h2><p>{m}</p><p>{l}</p><p>{s}</p></section>',
    '<div class="comments"><article class="comment"><p>{m}</p><p>{l}</p></article></div>',
    '<div class="comment"><p>{l}</p><p>{m}</p></div>',
    '<div hidden><p>{m}</p></div>',
    "<div>{s}</div>",
    "<p>{s}</p>",
    "<div><span>{s}</span></div>",
    '<div role="navigation"><p>{s}</p></div>',
    '<p class="legal">{m}</p>',
    '<div class="post-share"><p>{s}</p></div>',
    '<div class="content-search"><p>{s}</p><p>{s}</p></div>',
    '<div class="entry-tags"><ul>{a}</ul></div>',
)
KEPT = (
    "<article><h1>{s}</h1><p>{l}</p><p>{s}</p><p>{m}</p><p>{s}</p></article>",
    "<article><p>{s}</p></article>",
    "<article><h1>{s}</h1><p>{s}</p></article>",
    "<article><header><h1>{s}</h1><p>{s}</p></header><p>{l}</p><p>{s}</p></article>",
    "<article><h2>{s}</h2><ul><li>{s}</li><li>{m}</li></ul><p>{m}</p></article>",
    "<article><p>{m} <a href=x>{s}</a> {s}</p><p><a href=x>{s}</a> {m}</p></article>",
    "<article><blockquote>{m}</blockquote><pre>{s}</pre><p>{l}</p></article>",
    "<article><table><tr><td>{s}</td><td>{s}</td></tr></table><p>{m}</p></article>",
    "<main><h1>{s}</h1><p>{l}</p><p>{m}</p><p>{s}</p></main>",
    "<main><p>{s}</p><p>{s}</p></main>",
    '<div class="content"><h1>{s}</h1><p>{l}</p><p>{s}</p></div>',
    '<div id="content"><p>{m}</p><p>{s}</p><p>{s}</p></div>',
    '<div class="post"><h2>{s}</h2><p>{m}</p><p>{l}</p><p>{s}</p></div>',
    '<div class="entry-content"><p>{l}</p><p>{s}</p><ul><li>{m}</li></ul></div>',
    '<div class="story"><p>{m}</p><p>{s}</p></div>',
    "<div><p>{l}</p><p>{l}</p><p>{m}</p></div>",
    "<div><h1>{s}</h1><p>{l}</p><p>{l}</p></div>",
    "<article><p>{l}</p><p><a href=x>{s}</a></p><ul>{a}</ul><p>{m}</p></article>",
    "<main><p>{m}</p><p><a href=x>{s}</a></p><p>{s}</p></main>",
    "<article><p>{m}</p><figure><figcaption>{s}</figcaption></figure><h3>{s}</h3><p>{s}</p></article>",
    "<article><p>{l}</p><x-dropped><div class=ad>{m}</div></x-dropped><p>{s}</p>"
    "<x-dropped><aside><p>{l}</p></aside></x-dropped><p>{m}</p></article>",
    "<article><p>{m}</p><x-dropped><form><p>{s}</p></form></x-dropped><p>{l}</p>"
    "<x-dropped><div class=share>{s}</div><footer>{s}</footer></x-dropped></article>",
    "<main><h1>{s}</h1><p>{l}</p><x-dropped><div class=notice>{m}</div></x-dropped><p>{s}</p>"
    "<x-dropped><section class=comments><h2>{s}</h2><p>{m}</p></section></x-dropped></main>",
    "<table><tr><td><p>{l}</p><p>{m}</p><p>{l}</p></td></tr></table>",
    '<div class="content-form"><p>{l}</p><p>{l}</p><p>{m}</p></div>',
    '<div class="main-search wide"><h1>{s}</h1><p>{l}</p><p>{l}</p></div>',
)
LENGTHS = {"s": (1, 9), "m": (10, 35), "l": (36, 160)}
PAGES = 240


def labelled_pages(pages: int = PAGES) -> list[str]:
    """Pages in which every piece is wrapped as ``<x-kept>`` or ``<x-dropped>``."""
    rng = random.Random(7)

    def words(kind: str) -> str:
        return " ".join("w" * rng.randint(1, 9) for _ in range(rng.randint(*LENGTHS[kind])))

    def filled(piece: str) -> str:
        out = []
        for part in piece.split("{"):
            kind, close, rest = part.partition("}")
            if not close:
                out.append(part)
            elif kind == "a":
                links = (f"<li><a href=x>{words('s')}</a></li>" for _ in range(rng.randint(2, 7)))
                out.append("".join(links) + rest)
            else:
                out.append(words(kind) + rest)
        return "".join(out)

    out = []
    for i in range(pages):
        before = rng.sample(DROPPED, rng.randint(0, 3))
        after = rng.sample(DROPPED, rng.randint(0, 3))
        main = f"<x-kept>{filled(KEPT[i % len(KEPT)])}</x-kept>"
        dropped = [f"<x-dropped>{filled(p)}</x-dropped>" for p in [*before, *after]]
        at = len(before)
        out.append("".join([*dropped[:at], main, *dropped[at:]]))
    return out
