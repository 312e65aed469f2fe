"""Pages made by a rule, with known articles: what the block labeller is trained and tested on."""

from __future__ import annotations

import html
import random

VOWELS = ("a e i o u", "a e i o u y é è ê", "a e i o u ä ö ü", "a e i o u á í ó", "а е и о у")
CONSONANTS = ("b c d f g h k l m n p r s t v w th sh ch", "b c d f g l m n p r s t v ç", "b d f g h k l m n r s t w sch ß", "b c d f g l m n ñ p r s t", "б в г д ж к л м н п р с т")

NAVIGATION = ("nav", 'div class="menu"', 'ul class="nav"', 'div id="navigation"', 'div class="navbar topbar"', 'div class="breadcrumbs"', 'ul id="menu"', 'div role="navigation"')
TOP = ("header", 'div id="header"', 'div class="site-header"', 'div class="masthead banner"', 'header class="site"')
BOTTOM = ("footer", 'div id="footer"', 'div class="site-footer"', 'div class="copyright legal"', 'footer class="bottom"')
SIDE = ("aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="widget related"', 'section class="related-posts"', 'div class="recommended"', 'aside class="newsletter"', 'div class="tags share social"')
NOTICE = ('div class="cookie-notice"', 'div id="consent"', 'div class="notice alert"', 'div class="popup subscribe"', 'div class="cookie banner"')
ADVERT = ('div class="ad"', 'div class="ads banner"', 'div class="sponsored promo"', 'div id="advert"', 'div class="advertisement"', 'section class="ad"')
COMMENTS = ('div class="comments"', 'section id="comments"', 'div id="disqus" class="comment-list"', 'ol class="commentlist"', 'section class="reader-comments"', 'div class="responses replies"')
ARTICLE = ("article", "article", "article", "main", 'div class="content"', 'div class="post entry"', 'div id="main"', 'article class="post"', 'div class="article-body"', 'section class="story"', 'main id="content"')
SUFFIXES = ("", ".", ".", ".", ",", "!!", "&amp;&amp;&amp;", "***", "%%%", "###")


class Maker:
    def __init__(self, seed: int) -> None:
        self.random = random.Random(seed)
        self.article: set[str] = set()
        self.pick()

    def pick(self) -> None:
        self.lang = self.random.randrange(len(VOWELS))

    def word(self) -> str:
        r = self.random
        v, c = VOWELS[self.lang].split(), CONSONANTS[self.lang].split()
        return "".join(r.choice(c) + r.choice(v) for _ in range(r.choice((1, 1, 2, 2, 3)))) + r.choice(("", "", r.choice(c)))

    def words(self, n: int, *, points: bool = True) -> str:
        r = self.random
        out = [self.word() + (r.choice((".", ",")) if points and r.random() < 0.15 else "") for _ in range(max(1, n))]
        text = " ".join(out)
        text = text[0].upper() + text[1:]
        if points and r.random() < 0.7:
            text = text.rstrip(".,") + "."
        return text

    def noisy(self, text: str) -> str:
        mark = self.random.choice(SUFFIXES[5:])
        return " ".join(w + mark for w in text.split())

    def length(self) -> int:
        return int(self.random.choice((1, 2, 4, 8, 20, 40, 60, 100)) * self.random.uniform(0.6, 1.4)) or 1

    def inside(self, tag: str, body: str) -> str:
        return f"<{tag}>{body}</{tag.split()[0]}>"

    def links(self, n: int) -> str:
        r = self.random
        if r.random() < 0.7:
            return "<ul>" + "".join(f'<li><a href="/{i}">{self.words(r.choice((1, 1, 2, 4)), points=r.random() < 0.3)}</a></li>' for i in range(n)) + "</ul>"
        return " | ".join(f'<a href="/{i}">{self.words(r.choice((1, 2)), points=False)}</a>' for i in range(n))

    def plain(self) -> str:
        """A boilerplate part's text, in another language as often as not."""
        own, r = self.lang, self.random
        if r.random() < 0.6:
            self.pick()
        body = self.words(self.length() if r.random() < 0.5 else r.randint(1, 15))
        self.lang = own
        return r.choice((body, f"<p>{body}</p>", f"<span>{body}</span>", f"<h3>{self.words(2)}</h3><p>{body}</p>", f"&copy; {body}", f"{body} &middot; {self.words(6)}"))

    def boiler(self, kind: str) -> str:
        r = self.random
        own = self.lang
        if r.random() < 0.4:
            self.pick()
        if kind == "nav":
            out = self.inside(r.choice(NAVIGATION), self.links(r.randint(1, 10)))
        elif kind == "top":
            out = self.inside(r.choice(TOP), r.choice((self.plain(), f"<h1>{self.words(3)}</h1>", self.links(3), f"<div>{self.words(4)}</div>" + self.links(4))))
        elif kind == "bottom":
            out = self.inside(r.choice(BOTTOM), r.choice((self.plain(), self.plain(), self.links(5) + self.plain())))
        elif kind == "side":
            out = self.inside(r.choice(SIDE), r.choice((self.links(4), self.plain(), f"<h3>{self.words(2)}</h3>" + self.links(5), "".join(self.plain() for _ in range(3)))))
        elif kind == "notice":
            out = self.inside(r.choice(NOTICE), self.plain() + r.choice(("", f"<button>{self.words(1)}</button>")))
        elif kind == "ad":
            out = f"<!-- ad {r.randint(0, 99)} -->" + self.inside(r.choice(ADVERT), self.plain())
        elif kind == "form":
            out = self.inside(r.choice(("form", 'form class="search"', 'form id="signup"')), f"<label>{self.words(2)}</label><input type=text><select><option>{self.words(1)}<option>{self.words(1)}</select><button>{self.words(1)}</button><p>{self.words(8)}</p>")
        else:
            each = lambda: self.inside(r.choice(('div class="comment"', "li", "article", "p", 'div class="reply"')), r.choice((f"<b>{self.words(1)}</b> ", f'<div class="author">{self.words(1)}</div>', "")) + r.choice((f"<p>{self.words(self.length())}</p>", self.words(self.length()))))
            out = self.inside(r.choice(COMMENTS), r.choice(("", f"<h2>{self.words(2)}</h2>")) + "".join(each() for _ in range(r.randint(1, 6))))
        self.lang = own
        return out

    def content(self, text: str) -> str:
        """Remember a block of the article; it is returned as HTML."""
        self.article.add(" ".join(html.unescape(text).split()))
        return text

    def body(self) -> str:
        r, out = self.random, []
        noisy = r.random() < 0.15
        say = lambda n: self.content(self.noisy(self.words(n)) if noisy else self.words(n))
        if r.random() < 0.85:
            out.append(self.inside(r.choice(("h1", "h1", "h2", 'h1 class="title"')), say(r.choice((1, 4, 9, 14)))))
        for i in range(r.choice((0, 1, 1, 2, 4, 8, 16))):
            kind = r.random()
            if kind < 0.55:
                out.append(f"<p>{say(self.length())}</p>")
            elif kind < 0.65:
                out.append(f"<p><b>{say(self.length())}<br><p>")  # unclosed
            elif kind < 0.7:
                out.append("<ul>" + "".join(f"<li>{say(r.choice((3, 10)))}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.75:
                out.append(self.inside("blockquote", f"<p>{say(self.length())}</p>"))
            elif kind < 0.8:
                out.append(self.inside(r.choice(("h2", "h3")), say(3)))
            elif kind < 0.84:
                out.append("<table>" + "".join(f"<tr><td>{say(2)}</td><td>{say(3)}</td></tr>" for _ in range(2)) + "</table>")
            elif kind < 0.88:
                out.append(f"<pre>{say(self.length())}</pre>")
            elif kind < 0.92:
                out.append(f"<figure><img src=x><figcaption>{say(6)}</figcaption></figure>")
            else:
                out.append(f"<div>{say(self.length())}</div>")
            if r.random() < 0.06:
                out.append(self.boiler(r.choice(("ad", "form", "notice", "side"))))
        return "".join(out) or f"<p>{say(self.length())}</p>"

    def page(self) -> str:
        r = self.random
        title = self.words(6)
        before = [self.boiler(k) for k in ("top", "nav", "notice", "ad", "side", "form") if r.random() < 0.45]
        r.shuffle(before)
        main = self.inside(r.choice(ARTICLE), self.body())
        if r.random() < 0.25:
            main = self.inside(r.choice(("main", 'div class="container"', 'div id="page"')), main + (self.boiler("comments") if r.random() < 0.5 else ""))
        after = [self.boiler(k) for k in ("comments", "side", "ad", "form", "nav") if r.random() < 0.35] + ([self.boiler("bottom")] if r.random() < 0.8 else [])
        if r.random() < 0.5:
            before.insert(0, self.boiler("nav"))
        head = f'<head><meta charset="utf-8"><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";track({r.randint(0, 99)});</script></head>'
        return f"<!DOCTYPE html><html>{head}<body>{''.join(before)}{main}{''.join(after)}</body></html>"


def made_page(seed: int) -> tuple[str, set[str]]:
    """A page, and the texts of its article's blocks."""
    maker = Maker(seed)
    page = maker.page()
    return page, maker.article
