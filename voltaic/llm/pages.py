"""Labelled training pages for the main-text extractor.

Real sentences are set into page layouts by a fixed grammar of markup, so each
block's label is known: part of the article, or menu, header, footer, sidebar,
notice, advert, form or reader comment. The grammar varies containers, class
names, nesting, unclosed paragraphs and the order of parts.
"""

from __future__ import annotations

import html
import random

#: Names that pages give to parts which are not the article.
NOISE = {
    "nav": ["nav", "menu", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topbar", "toolbar", "pagination", "pager", "toc", "skip-link", "tabs"],
    "header": ["header", "site-header", "masthead", "branding", "page-header", "logo", "top"],
    "footer": ["footer", "site-footer", "copyright", "legal", "colophon", "bottom", "imprint", "credits"],
    "aside": ["sidebar", "side", "widget", "related", "recommended", "trending", "popular", "more-stories", "read-next", "tags", "author-box", "bio", "rail"],
    "notice": ["cookie", "cookie-banner", "consent", "gdpr", "notice", "alert", "banner", "popup", "modal", "overlay", "newsletter", "subscribe", "paywall", "signup", "message"],
    "ad": ["ad", "ads", "advert", "advertisement", "ad-slot", "sponsored", "sponsor", "promo", "promotion", "ad-container", "adsbox", "teaser-ad", "partner"],
    "form": ["form", "search", "search-form", "login", "contact-form", "subscribe-form"],
    "comments": ["comments", "comment", "comment-list", "reader-comments", "discussion", "respond", "replies", "disqus", "responses", "comment-body"],
    "share": ["share", "social", "sharing", "share-buttons", "follow", "social-links"],
}
#: Names that pages give to the article and parts of it.
MAIN = ["article", "content", "post", "entry", "entry-content", "post-content", "article-body", "story", "story-body", "main", "main-content", "text", "post-body", "body-text", "page-content"]
#: Short phrases that such parts carry.
PHRASES = {
    "notice": ["We use cookies to improve your experience.", "This site uses cookies. Accept all", "Subscribe to our newsletter", "Sign up to read more", "Diese Seite verwendet Cookies", "Ce site utilise des cookies", "Este sitio usa cookies"],
    "ad": ["Advertisement", "Sponsored content", "Buy now and save", "Anzeige", "Publicité", "Publicidad"],
    "form": ["Search", "Your email", "Name", "Password", "Send", "Submit"],
    "footer": ["All rights reserved.", "Privacy policy", "Terms of use", "Contact", "© 2024", "Imprint"],
    "comments": ["Leave a reply", "3 comments", "Reply", "Posted by guest", "Report"],
    "share": ["Share", "Tweet", "Follow us", "Email this"],
}
HEADINGS = ["h1", "h2", "h3"]


class Page:
    """Builds one page; ``labels`` has 1 for article blocks, 0 for others."""

    def __init__(self, rng: random.Random, sentences: list[str]):
        self.rng, self.sentences = rng, sentences
        self.out: list[str] = []
        self.blocks: list[tuple[str, int]] = []

    def words(self, low: int, high: int) -> str:
        text = self.rng.choice(self.sentences)
        while len(text.split()) < low:
            text += " " + self.rng.choice(self.sentences)
        return " ".join(text.split()[: self.rng.randint(low, high)])

    def put(self, markup: str) -> None:
        self.out.append(markup)

    def block(self, tag: str, text: str, label: int, link: bool = False, closed: bool = True, attrs: str = "") -> None:
        body = html.escape(text, quote=False)
        if link:
            body = f'<a href="/{len(self.out)}">{body}</a>'
        elif self.rng.random() < 0.15:
            body = self.rng.choice(["<b>{}</b>", "<span>{}</span>", "<em>{}<br></em>", "<b>{}<br>"]).format(body)
        self.put(f"<{tag}{attrs}>{body}" + (f"</{tag}>" if closed else ""))
        self.blocks.append((" ".join(text.split()), label))

    def name(self, names: list[str]) -> str:
        kind = self.rng.choice(["class", "class", "id"])
        extra = self.rng.choice(["", "", " clearfix", " col-8", " module", " box"]) if kind == "class" else ""
        return f' {kind}="{self.rng.choice(names)}{extra}"'

    def noise(self, kind: str) -> None:
        rng = self.rng
        tags = {"nav": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"], "form": ["form", "form", "div"], "comments": ["section", "div", "ol"]}
        tag = rng.choice(tags.get(kind, ["div", "div", "section", "aside"]))
        native = tag in ("nav", "header", "footer", "aside", "form")
        self.put(f"<{tag}" + ("" if native and rng.random() < 0.5 else self.name(NOISE[kind])) + ">")
        if kind in ("nav", "share") or (kind == "aside" and rng.random() < 0.5):
            if kind == "aside":
                self.block(rng.choice(HEADINGS), self.words(1, 4), 0)
            listed = rng.random() < 0.7 and tag != "ul"
            if listed:
                self.put("<ul>")
            for _ in range(rng.randint(2, 7)):
                text = rng.choice(PHRASES["share"]) if kind == "share" else self.words(1, 4)
                self.block("li" if listed or tag == "ul" else "div", text, 0, link=True)
            if listed:
                self.put("</ul>")
        elif kind == "form":
            for _ in range(rng.randint(1, 4)):
                self.block(rng.choice(["button", "p", "div"]), rng.choice(PHRASES["form"]), 0)
            self.put('<input type="text" value="x"><select><option>one<option>two</select><textarea>write</textarea>')
        elif kind == "comments":
            if rng.random() < 0.7:
                self.block(rng.choice(HEADINGS), rng.choice(PHRASES["comments"]), 0)
            for _ in range(rng.randint(1, 4)):
                inner = rng.choice(["div", "li", "article"])
                self.put(f"<{inner}{self.name(['comment', 'comment-body', 'reply'])}>")
                if rng.random() < 0.6:
                    self.block("div", self.words(1, 3), 0, attrs=rng.choice(["", ' class="author"', ' class="meta"']))
                self.block("p", self.words(3, 40), 0)
                self.put(f"</{inner}>")
        else:
            for _ in range(rng.randint(1, 3)):
                text = rng.choice(PHRASES[kind]) if kind in PHRASES and rng.random() < 0.6 else self.words(2, 25)
                if kind == "footer" and rng.random() < 0.4:
                    text = "© " + text
                self.block(rng.choice(["p", "div"]), text, 0, link=rng.random() < 0.15)
        self.put(f"</{tag}>")

    def article(self) -> None:
        rng = self.rng
        unclosed = rng.random() < 0.3
        for n in range(rng.randint(1, 12)):
            pick = rng.random()
            if pick < 0.08 and n:
                self.block(rng.choice(["h2", "h3", "h4"]), self.words(1, 8), 1)
            elif pick < 0.14:
                kind = rng.choice(["ul", "ol"])
                self.put(f"<{kind}>")
                for _ in range(rng.randint(2, 4)):
                    self.block("li", self.words(1, 15), 1)
                self.put(f"</{kind}>")
            elif pick < 0.18:
                self.put("<blockquote>")
                self.block("p", self.words(4, 30), 1)
                self.put("</blockquote>")
            elif pick < 0.21:
                self.put("<table><tr>")
                for _ in range(3):
                    self.block("td", self.words(1, 3), 1)
                self.put("</tr></table>")
            elif pick < 0.23:
                self.block("pre", self.words(2, 10), 1)
            elif pick < 0.31:
                self.noise(rng.choice(["ad", "share", "aside", "notice", "form"]))
            else:
                self.block("p", self.words(1, 4) if rng.random() < 0.2 else self.words(5, 90), 1, closed=not unclosed, attrs=rng.choice(["", "", "", ' class="lead"', ' class="text"']))

    def build(self) -> tuple[str, list[tuple[str, int]]]:
        rng = self.rng
        self.put("<!DOCTYPE html><html><head><title>t</title><script>var a='<p>';</script><style>p{}</style></head><body>")
        for kind in ("notice", "header", "nav", "ad"):
            if rng.random() < 0.6:
                self.noise(kind)
        pick = rng.random()
        # A body without any container, a wrapper with no meaning, or named parts.
        opening = "" if pick < 0.08 else f"<article{self.name(MAIN) if rng.random() < 0.4 else ''}>" if pick < 0.5 else f"<main{self.name(MAIN) if rng.random() < 0.3 else ''}>" if pick < 0.62 else f"<{rng.choice(['div', 'section'])}{self.name(MAIN)}>"
        close = "</" + opening[1:].split(">")[0].split(" ")[0] + ">" if opening else ""
        wrapper = rng.random() < 0.3
        if wrapper:
            self.put(f"<div{self.name(['wrapper', 'container', 'page', 'row', 'layout'])}>")
        self.put(opening)
        titled = rng.random() < 0.85
        if titled and rng.random() < 0.25 and opening:
            self.put("<header>")
            self.block("h1", self.words(1, 10), 1)
            self.put("</header>")
        elif titled:
            self.block(rng.choice(["h1", "h1", "h2"]), self.words(1, 10), 1)
        self.article()
        if opening and rng.random() < 0.2:
            self.noise(rng.choice(["comments", "share", "aside", "form"]))
        self.put(close)
        for kind in ("aside", "comments", "ad", "form", "share"):
            if rng.random() < 0.35:
                self.noise(kind)
        if wrapper:
            self.put("</div>")
        for kind in ("notice", "footer"):
            if rng.random() < 0.7:
                self.noise(kind)
        self.put("</body></html>")
        return "".join(self.out), self.blocks


def labelled_pages(sentences: list[str], n: int, seed: int = 11) -> list[tuple[str, list[tuple[str, int]]]]:
    """``n`` pages as (html, [(block text, label)])."""
    rng = random.Random(seed)
    sentences = [s for s in sentences if s.split()] or ["text"]
    return [Page(rng, sentences).build() for _ in range(n)]
