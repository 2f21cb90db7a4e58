"""Labelled pages to train the extraction of main text on, made by rules from a seed.

Each page puts an article, in one of the ways in which sites mark theirs, among menus, headers, footers,
sidebars, notices, adverts, forms, share bars and reader comments, marked in as many ways or not at all. The
label is the article's text: its blocks, joined by two line breaks. Words are invented, so that nothing can be
learnt from them.
"""

from __future__ import annotations

import html
import random
import re

SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi xo an el im or us".split()


class Writer:
    def __init__(self, seed: int) -> None:
        self.random = random.Random(seed)
        self.kept: list[str] = []
        #: Some sites write without sentences, or at great length.
        self.stops = self.pick(True, True, True, False)
        self.longest = self.pick(14, 14, 40, 150, 1)
        self.parts = self.pick(4, 12, 12, 12, 40, 150)
        self.sentence_words = self.pick(18, 18, 18, 3)

    def chance(self, share: float) -> bool:
        return self.random.random() < share

    def pick(self, *choices):
        return self.random.choice(choices)

    def word(self) -> str:
        return "".join(self.random.choice(SYLLABLES) for _ in range(self.random.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.random.randint(low, high)))

    def sentence(self) -> str:
        if not self.stops:
            return self.words(1, self.sentence_words)
        return self.words(1, self.sentence_words).capitalize() + self.pick(".", ".", ".", "!", "?", "", ",")

    def prose(self, most: int) -> str:
        return " ".join(self.sentence() for _ in range(self.random.randint(1, most)))

    def named(self, tag: str, names: str, inner: str, share: float = 0.85) -> str:
        """An element that says by class, id or role what it is, mostly."""
        if tag == "p":  # which holds no blocks
            inner = re.sub(r"</?(?:p|div|ul|li|button)\b[^>]*>", " ", inner)
        if not self.chance(share):
            return f"<{tag}>{inner}</{tag}>"
        value = self.random.choice(names.split()) + self.pick("", "", "-box", " wide", "_1", "-area")
        return f'<{tag} {self.pick("class", "class", "id")}="{value}">{inner}</{tag}>'

    def link(self, low: int = 1, high: int = 4) -> str:
        return f'<a href="/{self.word()}">{self.words(low, high)}</a>'

    def links(self, low: int, high: int) -> str:
        each = [self.link() for _ in range(self.random.randint(low, high))]
        way = self.random.randrange(4)
        if way < 2:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in each) + "</ul>"
        return self.pick(" | ", " ", " &middot; ").join(each) if way == 2 else "".join(f"<div>{x}</div>" for x in each)

    # Blocks of the article; each is also kept as label.

    def own(self, tag: str, text: str, inside: str | None = None) -> str:
        self.kept.append(text)
        return f"<{tag}>{html.escape(text) if inside is None else inside}" + ("" if tag == "p" and self.chance(0.1) else f"</{tag}>")

    def paragraph(self) -> str:
        text = self.prose(min(self.longest, self.pick(1, 1, 3, 8, self.longest)))
        if self.chance(0.2):
            before, linked, after = self.prose(2), self.words(1, 4), self.words(1, 6)
            return self.own("p", f"{before} {linked} {after}", f'{before} <a href="#">{linked}</a> {after}')
        if self.chance(0.2):
            bold = self.words(1, 3)
            return self.own("p", f"{bold} {text}", f"<b>{bold}</b> {text}")
        return self.own("p", text)

    def part(self) -> str:
        way = self.random.random()
        if way < 0.72:
            return self.paragraph()
        if way < 0.82:
            return self.own(self.pick("h2", "h2", "h3"), self.words(1, 7).capitalize())
        if way < 0.89:
            items = "".join(self.own("li", self.pick(self.words(1, 6), self.prose(2))) for _ in range(self.random.randint(1, 5)))
            return f"<{(tag := self.pick('ul', 'ol'))}>{items}</{tag}>"
        if way < 0.93:
            return "<blockquote>" + self.own("p", self.prose(3)) + "</blockquote>"
        if way < 0.96:
            rows = "".join(f"<tr>{self.own('td', self.words(1, 3))}{self.own('td', self.words(1, 3))}</tr>" for _ in range(3))
            return f"<table>{rows}</table>"
        if way < 0.98:
            return "<figure><img src='x.png'>" + self.own("figcaption", self.prose(1)) + "</figure>"
        return self.own("pre", self.words(3, 12))

    def intruder(self) -> str:
        return self.pick(self.advert, self.share, self.notice, self.related)()

    def article(self) -> str:
        parts = []
        if self.chance(0.85):
            title = self.own("h1", self.words(2, 9).capitalize())
            parts.append(f"<header>{title}</header>" if self.chance(0.15) else title)
        for _ in range(self.random.randint(1, self.parts)):
            parts.append(self.part())
            if self.chance(0.5 / self.parts):
                parts.append(self.intruder())
        return "".join(parts)

    def in_container(self) -> str:
        inner = self.article()
        way = self.random.randrange(9)
        if way < 3:
            inner = f"<article>{inner}</article>"
        elif way < 5:
            inner = self.named(self.pick("div", "section"), "content article post-body entry-content story main-text prose post", inner, 0.9)
        elif way == 5:
            inner = f"<main>{inner}</main>"
        elif way == 6:
            inner = f"<div>{inner}</div>"
        elif way == 7:
            inner = f"<div><div>{inner}</div></div>"
        if self.chance(0.3):
            inner = self.pick("<main>%s</main>", '<div id="page">%s</div>', '<div class="wrapper">%s</div>', '<div role="main">%s</div>') % inner
        return inner

    # What is not the article.

    def menu(self) -> str:
        return self.pick(
            lambda: f"<nav>{self.links(3, 9)}</nav>",
            lambda: self.named("div", "menu navbar nav-main breadcrumb navigation topnav", self.links(2, 8), 0.8),
            lambda: self.named("ul", "menu nav", "".join(f"<li>{self.link()}</li>" for _ in range(5)), 0.6),
        )()

    def top(self) -> str:
        inner = self.pick(self.words(1, 4), f"<div>{self.link()}</div>", f"<h1>{self.link()}</h1>", f"<p>{self.words(2, 8)}</p>")
        if self.chance(0.5):
            inner += self.menu()
        return self.pick(f"<header>{inner}</header>", self.named("div", "header masthead topbar site-header", inner, 0.95))

    def foot(self) -> str:
        inner = self.pick("&copy; ", "Copyright ", "") + self.words(1, 6) + self.pick("", ". " + self.prose(2), " &middot; " + self.prose(1))
        inner = self.pick(inner, f"<p>{inner}</p>", f"{self.links(2, 6)}<p>{inner}</p>")
        return self.pick(f"<footer>{inner}</footer>", f"<footer>{inner}", self.named("div", "footer copyright site-footer legal", inner, 0.95))

    def side(self) -> str:
        inner = f"<h3>{self.words(1, 3)}</h3>" + self.pick(self.links(3, 8), f"<p>{self.prose(3)}</p>", f"<p>{self.prose(1)}</p>{self.links(2, 4)}")
        return self.pick(f"<aside>{inner}</aside>", self.named("div", "sidebar right-rail widget side-bar", inner, 0.95))

    def related(self) -> str:
        return self.named("div", "related recommended popular teasers", f"<h3>{self.words(1, 3)}</h3>{self.links(2, 5)}", 0.8)

    def advert(self) -> str:
        inner = self.pick(self.prose(1), f"<p>{self.prose(3)}</p>", self.link(2, 6), f"<a href='/x'>{self.prose(1)}</a>")
        return self.named(self.pick("div", "div", "aside", "section", "p", "span"), "ad ads advert advertisement sponsored ad-slot promo banner", inner, 1)

    def notice(self) -> str:
        inner = self.pick(self.prose(2), f"<p>{self.prose(3)}</p>", f"<p>{self.prose(1)} {self.link()}</p><button>{self.word()}</button>")
        if self.chance(0.2):
            return f'<div role="{self.pick("alert", "dialog")}">{inner}</div>'
        return self.named(self.pick("div", "div", "section", "p"), "cookie-notice notice alert consent popup modal privacy newsletter paywall", inner, 1)

    def share(self) -> str:
        return self.named(self.pick("div", "ul"), "share social social-links follow", self.pick(self.links(2, 4), self.words(1, 3)), 1)

    def form(self) -> str:
        label = f"<label>{self.words(1, 4)}</label><input name=x>"
        inner = self.pick(label, f"<p>{self.prose(1)}</p>{label}<button>{self.word()}</button>", f"{self.words(1, 5)} <input><select><option>{self.word()}</select>")
        return f"<form>{inner}</form>"

    def comment(self) -> str:
        said = f"<p>{self.prose(self.pick(1, 3, 6))}</p>"
        who = self.pick("", f"<b>{self.word()}</b>", f"<div>{self.words(1, 2)}</div>", f"<h4>{self.word()}</h4>")
        return self.pick(f"<li>{who}{said}</li>", f'<div class="comment">{who}{said}</div>', f"<div>{who}{said}</div>", f'<article class="comment">{who}{said}</article>')

    def comments(self) -> str:
        inner = self.pick("", f"<h2>{self.words(1, 3)}</h2>", f"<h3>{self.words(1, 2)}</h3>")
        inner += "".join(self.comment() for _ in range(self.random.randint(1, 6))) + self.pick("", self.form())
        return self.named(self.pick("div", "section", "ol", "ul"), "comments comment-list discussion responses replies reviews", inner, 1)

    def page(self) -> tuple[str, str]:
        before = [f() for f in (self.notice, self.top, self.menu, self.advert, self.form, self.side) if self.chance(0.4)]
        if self.chance(0.6):
            self.random.shuffle(before)
        body = self.in_container()
        after = [f() for f in (self.share, self.related, self.comments, self.advert, self.side, self.form, self.notice) if self.chance(0.35)]
        self.random.shuffle(after)
        if self.chance(0.85):
            after.append(self.foot())
        if self.chance(0.1):  # layout by a table
            body = f"<table><tr><td>{self.links(3, 6)}</td><td>{body}</td></tr></table>"
        head = f"<head><title>{self.words(2, 6)}</title><script>var a='<p>';</script></head>"
        page = f"<!DOCTYPE html><html>{head}<body>{''.join(before)}{body}{''.join(after)}</body></html>"
        return page, "\n\n".join(" ".join(x.split()) for x in self.kept)


def labelled_pages(count: int, seed: int = 0) -> list[tuple[str, str]]:
    """``(html, main text)`` of ``count`` pages."""
    return [Writer(seed * 1_000_003 + k).page() for k in range(count)]
