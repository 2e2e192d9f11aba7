"""Labelled pages to learn content extraction from, made from page layouts by rule.

A layout is HTML in which ``y="1"`` marks an element whose text is content (with all
in it, until ``y="0"``). ``{part}`` stands for a class word of that part, drawn from
``WORDS``; ``[kind]`` for text: ``[s]`` a few words, ``[m]`` a sentence, ``[p]``
paragraphs, ``[l]`` a list of links, ``[c]`` a character reference line.
"""

from __future__ import annotations

import random
import re

#: class words by the part of a page that they tell of
WORDS = {
    "nav": "nav navbar navigation menu main-menu breadcrumb breadcrumbs topnav toc pager pagination tabs sitemap",
    "head": "header site-header masthead top-bar topbar branding page-header logo hero-bar",
    "foot": "footer site-footer colophon copyright legal bottom footer-widgets credits imprint",
    "side": "sidebar aside widget widget-area related recommended popular trending right-column secondary more-stories",
    "note": "cookie cookie-notice notice alert consent popup modal newsletter subscribe signup overlay gdpr warning",
    "ad": "ad ads advert advertisement banner sponsor sponsored promo promotion ad-slot adsense partner",
    "talk": "comments comment comment-list replies respond discussion disqus reader-comments feedback reviews thread",
    "share": "share social sharing share-buttons follow tags meta byline-tools",
    "form": "form search search-form login contact-form signup-form register",
    "main": "content article post entry story main-content post-content entry-content article-body text body-text "
            "main post-body page-content story-body prose",
    "wrap": "wrapper container page site layout row grid inner outer wrap col box app root",
}

LAYOUTS = [
    # semantic elements
    """<header>[s]<nav><ul>[l]</ul></nav></header><main y="1"><article><h1>[s]</h1>[p]</article></main>
       <aside>[l]</aside><footer>[c][m]</footer>""",
    """<nav><ul>[l]</ul></nav><div class="{ad}">[m]</div><article y="1"><h1>[s]</h1>[p]</article><footer>[c][s]</footer>""",
    """<nav><ul>[l]</ul></nav><div class="{note}">[m][m]</div><article y="1"><h1>[s]</h1>[p]<p>[s]</p>
       <blockquote>[m]</blockquote>[p]</article><section class="{talk}"><h2>[s]</h2><div class="{talk}">[p]</div>
       <div class="{talk}">[m]</div></section><footer>[l][c]</footer>""",
    """<header class="{head}"><a href="/">[s]</a><form class="{form}"><label>[s]</label></form></header><main y="1"><h1>[s]</h1>
       [p]<div class="{ad}" y="0">[m]</div>[p]<ul><li>[m]</li><li>[m]</li></ul></main><footer class="{foot}">[m]</footer>""",
    # class words only
    """<div class="{wrap}"><div class="{head}">[s]</div><div class="{nav}">[l]</div><div class="{wrap}">
       <div class="{main}" y="1"><h2>[s]</h2>[p]</div><div class="{side}"><h3>[s]</h3>[l]</div></div>
       <div class="{foot}">[m][c]</div></div>""",
    """<div id="{wrap}"><div id="{head}"><h1>[s]</h1><p>[m]</p></div><div id="{nav}"><ul>[l]</ul></div>
       <div id="{main}" y="1"><h1>[s]</h1>[p]<div class="{share}" y="0">[l]</div></div><div id="{talk}">[p]</div>
       <div id="{side}"><p>[m]</p>[l]</div><div id="{foot}"><p>[m]</p></div></div>""",
    """<div class="{note}"><p>[m]</p><p>[m]</p></div><div class="{wrap}"><div class="{main}" y="1"><h1>[s]</h1><p>[s]</p>
       <p>[m]</p></div></div><div class="{foot}">[l]</div>""",
    """<div class="{wrap}"><div class="{nav}">[l]</div><div class="{main}" y="1">[m]<br>[m]<br>[m]<br><br>[m]</div>
       <div class="{ad}">[s]</div></div>""",
    # no telling words
    """<div><ul>[l]</ul></div><div y="1"><h1>[s]</h1>[p]</div><div><ul>[l]</ul></div><div>[c][s]</div>""",
    """<table><tr><td>[l]</td><td y="1"><h1>[s]</h1>[p]</td><td>[l]</td></tr></table>""",
    """<div><h1>[s]</h1><p>[m]</p></div><div><ul>[l]</ul></div><div><div y="1"><h2>[s]</h2>[p]</div><div><ul>[l]</ul></div></div>""",
    # content with parts of other kinds in it
    """<header>[s]</header><article class="{main}" y="1"><header><h1>[s]</h1></header><p>[m]</p><figure><figcaption>[m]</figcaption></figure>
       [p]<aside class="{side}" y="0"><h4>[s]</h4>[l]</aside>[p]<div class="{note}" y="0"><p>[m]</p><form><label>[s]</label></form></div>
       <h2>[s]</h2>[p]<table><tr><th>[s]</th><th>[s]</th></tr><tr><td>[s]</td><td>[m]</td></tr></table>
       <nav class="{nav}" y="0">[l]</nav><div class="{talk}" y="0"><h3>[s]</h3><article><p>[m]</p></article><article>[p]</article></div>
       <footer y="0">[s][l]</footer></article>""",
    """<div class="{head}">[l]</div><div class="{main}" y="1"><p>[m]<b>[s]</b>[m]<a href="x">[s]</a>[m]</p><pre>[m]</pre><ol><li>[s]</li>
       <li>[s]</li><li>[m]</li></ol><dl><dt>[s]</dt><dd>[m]</dd></dl><p><a href="y">[s]</a></p>[p]</div>
       <ol class="{talk}"><li class="{talk}"><p>[m]</p></li><li>[p]</li></ol><form class="{form}"><p>[m]</p></form>""",
    """<form id="aspnetForm"><div class="{head}">[s]</div><div class="{main}" y="1"><h1>[s]</h1>[p]</div>
       <div class="{foot}">[m]</div></form>""",
    """<header class="{head}"><h1>[s]</h1><p>[m]</p></header><section class="{main}" y="1"><h2>[s]</h2><p>[m]</p><p>[s]</p>
       <section><h3>[s]</h3>[p]</section></section><section class="{talk}"><h2>[s]</h2>[p]</section><aside class="{ad}"><p>[m]</p></aside>
       <aside><p>[m]</p><p>[m]</p></aside><footer><p>[m]</p><p>[m][c]</p></footer>""",
    """<article y="1"><h1>[s]</h1><p>[s]</p></article><footer>[c][m]</footer>""",
    """<header><h1>[s]</h1><p>[m]</p></header><nav>[l]</nav><div class="{side}"><p>[m]</p></div><article y="1"><h1>[s]</h1><p>[m]</p>
       <p>[s]</p><table><tr><td>[s]</td><td>[s]</td></tr></table><ul><li>[s]</li><li>[m]</li></ul></article><section class="{talk}">
       <h2>[s]</h2><p>[m]</p></section><div class="{note}">[m]</div><form><p>[m]</p></form><footer>[s]</footer>""",
    """<main y="1">[p]</main>""",
    """<body><div id="{main}" y="1"><h2>[s]</h2><p>[m]</p><p>[s]</p></div><div id="{foot}">[m]</div></body>""",
    """<header>[m]</header><article y="1"><header><h1>[s]</h1></header><p>[m]</p><p>[s]</p><footer y="0">[m]</footer></article><footer>[m]</footer>""",
    """<article y="1"><h1>[s]</h1><p>[m]</p><section class="{talk}" y="0"><p>[m]</p></section></article><div class="{ad}">[m]</div>
       <div id="{talk}"><div class="{talk}"><p>[m][m]</p></div></div>""",
    """<div class="{note}">[m]</div><article y="1"><h1>[s]</h1><p>[m]</p><div class="{ad}" y="0">[m]</div><p>[s]</p><aside y="0">[m]</aside>
       </article><div class="{side}">[m]</div>""",
    """<nav>[l]</nav><article y="1"><p>[s]</p></article><div class="{ad}">[m][m][m]</div><div class="{note}">[m]</div>""",
    # nothing but text, and nothing to read
    """[m][m][m][m]""",
    """<nav><ul>[l]</ul></nav><footer>[c]</footer>""",
]
#: layouts whose bare text (outside any element) is content
BARE = {"[m][m][m][m]"}

_SYLLABLES = "ka lo mi ten ra sul ve dor ni pe ha gri bo ust em".split()
_SLOT = re.compile(r"\{(\w+)\}|\[(\w)\]")


def _words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(n)]


def _sentence(rng: random.Random) -> str:
    words = _words(rng, rng.choice((2, 4, 8, 12, 20, 30)))
    if len(words) > 6:
        words[len(words) // 2] += ","
    return " ".join(words).capitalize() + rng.choice((". ", ". ", ".*** ", "! ", " ", ".%%% "))


def _fill(rng: random.Random, layout: str) -> str:
    def slot(m: re.Match) -> str:
        part, kind = m.groups()
        if part:
            return rng.choice(WORDS[part].split())
        if kind == "s":
            return " ".join(_words(rng, rng.randint(1, 5))).capitalize()
        if kind == "m":
            return _sentence(rng)
        if kind == "c":
            return "&copy; " + " ".join(_words(rng, 2)) + " &middot; "
        if kind == "l":
            return "".join(f'<li><a href="/{w}">{w}</a></li>' for w in _words(rng, rng.randint(2, 9)))
        paragraphs = ["".join(_sentence(rng) for _ in range(int(2 ** rng.uniform(0, 4.5))))
                      for _ in range(int(2 ** rng.choice((rng.uniform(0, 3), rng.uniform(0, 6)))))]
        opened = rng.choice(("<p>", "<p>", "<p>", "<p><b>", "<p><span>"))
        closed = "</p>" if opened == "<p>" else rng.choice(("<br>", "</p>"))
        return "".join(f"{opened}{p}{closed}" for p in paragraphs)
    return _SLOT.sub(slot, layout)


def pages(copies: int = 24, seed: int = 11) -> list[tuple[str, bool]]:
    """(marked page, whether text outside any element is content), ``copies`` of each layout."""
    rng = random.Random(seed)
    out = []
    for layout in LAYOUTS:
        for k in range(copies):
            body = _fill(rng, layout)
            if k % 4 != 3 and layout not in BARE:
                body = f"<!DOCTYPE html><html><head><title>{_sentence(rng)}</title></head><body>{body}</body></html>"
            out.append((body, layout in BARE))
    return out
