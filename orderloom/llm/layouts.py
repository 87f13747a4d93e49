"""Made-up pages with known main text, to fit the extraction model on.

Every page is drawn at random: how the article is wrapped, which parts surround it, whether they are told by tags, by
class names or only by what is in them, and how carefully the markup is closed. Text of the article starts with MARK.
"""

from __future__ import annotations

import random

MARK = "\ue001"
SYLLABLES = "ba ke li mo nu ra se ti vo da er an in on es al or um ent ich sch eau ci ó ß".split()


class Layout:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def word(self) -> str:
        return "".join(self.rng.choices(SYLLABLES, k=self.rng.choice([1, 1, 2, 2, 3, 4])))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high)))

    def prose(self, sentences: int, low: int = 1, high: int = 18) -> str:
        out = []
        for _ in range(sentences):
            text = self.words(low, high).capitalize()
            out.append(text.replace(" ", ", ", 1) + self.rng.choice([".", ".", ".", "!", "?"]))
        return " ".join(out)

    def any_text(self) -> str:
        """Running text as an article or a notice may have it; some of it odd."""
        r = self.rng.random()
        text = self.prose(self.rng.choice([1, 1, 2, 4, 8]))
        if r < 0.06:
            text = text.upper().replace(" ", "!! ")
        elif r < 0.12:
            text = text.replace(" ", self.rng.choice([" | ", "*** ", " &amp; ", "&nbsp;", "### "]))
        elif r < 0.2:
            text = self.word().capitalize() + "."
        return text

    def named(self, tag: str, inner: str, names: list[str], chance: float = 0.8, attribute: str = "") -> str:
        if self.rng.random() < chance:
            name = self.rng.choice(names)
            if self.rng.random() < 0.4:
                name = self.rng.choice([f"{self.word()}-{name}", f"{name}-{self.word()}", f"{self.word()} {name}",
                                        f"{name}__inner", f"js-{name}", name.capitalize()])
            attribute += f' {self.rng.choice(["class", "class", "class", "id"])}="{name}"'
        return f"<{tag}{attribute}>{inner}</{tag}>"

    def parts(self, n: int) -> int:
        """``n``, or on a few pages hundreds: long articles, archives and threads."""
        return self.rng.randint(50, 400) if self.rng.random() < 0.015 else n

    def links(self, n: int) -> str:
        n = self.parts(n)
        items = [f'<a href="/{self.word()}">{self.rng.choice([self.word(), self.words(1, 3), self.word() + self.rng.choice('.,:')])}</a>' for _ in range(n)]
        if self.rng.random() < 0.7:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return self.rng.choice([" | ", " ", " &middot; "]).join(items)

    # parts that are not the article

    def menu(self) -> str:
        inner = self.links(self.rng.choice([1, 1, 2, 3, 4, 5, 6, 7, 9]))
        return self.rng.choice([self.named("nav", inner, ["nav", "menu", "navbar"], 0.4),
                                self.named("div", inner, ["menu", "nav", "navigation", "breadcrumbs"], 0.9),
                                inner if inner.startswith("<ul") else f"<div>{inner}</div>"])

    def header(self) -> str:
        inner = self.rng.choice([f"<h1>{self.words(1, 3)}</h1>", f'<a href="/">{self.words(1, 2)}</a>',
                                 f"<p>{self.words(1, 8)}</p>", f"<div>{self.words(1, 4)}</div>"])
        inner += self.menu() if self.rng.random() < 0.5 else ""
        return self.named(self.rng.choice(["header", "header", "div"]), inner, ["header", "masthead", "site-header"], 0.9
                          if inner.startswith("<h1") else 0.7)

    def footer(self) -> str:
        inner = self.rng.choice(["&copy; ", "© ", "", "Copyright "]) + self.rng.choice(
            [self.word() + ".example.com", self.words(1, 3)]) + self.rng.choice([" &middot; ", " ", "<br>", " | "])
        inner += self.any_text() + (self.links(3) if self.rng.random() < 0.4 else "")
        if self.rng.random() < 0.3:
            inner = f"<p>{inner}</p>"
        if self.rng.random() < 0.75:
            return self.named("footer", inner, ["footer", "site-footer"], 0.3)
        return self.named("div", inner, ["footer", "copyright", "legal"], 1.0)

    def sidebar(self) -> str:
        title = f"<h3>{self.words(1, 4)}</h3>"
        parts = [title, self.rng.choice([self.links(self.rng.randint(2, 7)), f"<p>{self.any_text()}</p>",
                                         f"<div>{self.any_text()}</div>", self.any_text()])]
        inner = "".join(parts if self.rng.random() < 0.7 else parts[1:])
        return self.rng.choice([self.named("aside", inner, ["sidebar", "related", "widget"], 0.5),
                                self.named("div", inner, ["sidebar", "related", "widget", "recommended", "side-rail"],
                                           1.0)])

    def advert(self) -> str:
        inner = self.rng.choice([self.any_text(), f"<p>{self.any_text()}</p>", f'<a href="/x">{self.words(2, 8)}</a>'])
        return self.named(self.rng.choice(["div", "div", "aside", "section"]), inner,
                          ["ad", "ads", "advert", "advertisement", "sponsored", "ad-slot", "banner-ad", "promo"], 1.0)

    def notice(self) -> str:
        inner = self.rng.choice([self.any_text(), f"<p>{self.any_text()}</p>"])
        inner += f"<button>{self.words(1, 2)}</button>" if self.rng.random() < 0.5 else ""
        if self.rng.random() < 0.2:
            return f'<div role="{self.rng.choice(["alert", "dialog"])}">{inner}</div>'
        return self.named(self.rng.choice(["div", "div", "section", "aside"]), inner,
                          ["cookie-notice", "cookie", "consent", "notice", "alert", "popup", "gdpr", "banner"], 1.0)

    def form(self) -> str:
        inner = "".join(f"<label>{self.words(1, 3)}</label><input name=x>" for _ in range(self.rng.randint(1, 3)))
        inner = (f"<p>{self.any_text()}</p>" if self.rng.random() < 0.4 else "") + inner
        inner += self.rng.choice([f"<button>{self.word()}</button>", "<input type=submit>",
                                  "<select><option>" + self.word() + "<option>" + self.word() + "</select>",
                                  f"<textarea>{self.words(0, 4)}</textarea>"])
        form = self.named("form", inner, ["search", "newsletter", "signup", "login"], 0.4)
        return form if self.rng.random() < 0.6 else self.named(
            "div", f"<h3>{self.words(1, 3)}</h3>" + form, ["newsletter", "subscribe", "login"], 0.8)

    def comments(self) -> str:
        one = lambda: self.rng.choice([
            self.named("div", f"<b>{self.word()}</b><p>{self.any_text()}</p>", ["comment", "reply", "comment-body"], 0.9),
            self.named("li", f"<p>{self.any_text()}</p>", ["comment", "reply"], 0.7),
            self.named("article", f"<p>{self.any_text()}</p>", ["comment"], 1.0),
            f"<p>{self.any_text()}</p>"])
        inner = "".join(one() for _ in range(self.parts(self.rng.randint(1, 5))))
        inner = (f"<h3>{self.words(1, 2)}</h3>" if self.rng.random() < 0.6 else "") + inner
        return self.named(self.rng.choice(["section", "div", "ol", "div"]), inner,
                          ["comments", "comment-list", "replies", "discussion", "disqus_thread", "reviews"], 1.0)

    def share(self) -> str:
        return self.named("div", self.links(self.rng.randint(2, 5)), ["share", "social", "share-buttons", "tags"], 0.9)

    def noise(self) -> str:
        return self.rng.choice(['<script>var t="</p>";f(1);</script>', "<style>p{margin:0}</style>", "<!-- x <p> -->",
                                "<noscript>" + self.words(1, 5) + "</noscript>", '<img src="a.png" alt="x">', "<hr>"])

    # the article

    def marked(self, text: str) -> str:
        return MARK + text

    def paragraph(self) -> str:
        text = self.marked(self.any_text())
        if self.rng.random() < 0.2:
            cut = text.split(" ")
            at = self.rng.randrange(len(cut))
            tag = self.rng.choice(["b", "em", "a href='/x'", "span", "code", "strong"])
            cut[at] = f"<{tag}>{cut[at]}</{tag.split()[0]}>"
            text = " ".join(cut)
        return text

    def body(self) -> str:
        out, careless = [], self.rng.random() < 0.25
        plain = self.rng.random() < 0.1
        for _ in range(self.parts(self.rng.choice([1, 2, 3, 5, 8, 14]))):
            r = self.rng.random()
            if plain:
                out.append(f"<div>{self.paragraph()}</div>")
            elif r < 0.8:
                out.append(f"<p>{self.paragraph()}" + ("" if careless and self.rng.random() < 0.5 else "</p>"))
            elif r < 0.85:
                out.append(f"<h3>{self.marked(self.words(1, 6))}</h3>")
            elif r < 0.9:
                out.append("<ul>" + "".join(f"<li>{self.paragraph()}</li>" for _ in range(self.rng.randint(1, 5)))
                           + "</ul>")
            elif r < 0.93:
                out.append(f"<blockquote>{self.paragraph()}</blockquote>")
            elif r < 0.96:
                out.append("<table><tr>" + "".join(f"<td>{self.marked(self.words(1, 3))}</td>" for _ in range(3))
                           + "</tr></table>")
            else:
                out.append(f"<p><b>{self.paragraph()}<br>")
            if self.rng.random() < 0.04:
                out.append(self.rng.choice([self.advert, self.noise, self.form, self.share, self.notice])())
        return "".join(out)

    def article(self) -> str:
        inner = self.body() if self.rng.random() > 0.03 else ""
        if self.rng.random() < 0.8:
            title = f"<h1>{self.marked(self.rng.choice([self.words(1, 9), self.any_text()]))}</h1>"
            inner = (f"<header>{title}</header>" if self.rng.random() < 0.15 else title) + inner
        for part in (self.share, self.comments, self.sidebar):
            if self.rng.random() < 0.06:
                inner += part()
        names = ["content", "post", "entry-content", "article-body", "story", "main", "post-content", "text"]
        r = self.rng.random()
        if r < 0.5:
            return self.named("article", inner, names, 0.3)
        if r < 0.6:
            return self.named("main", inner, names, 0.3)
        if r < 0.9:
            return self.named("div", inner, names, 0.85)
        return inner

    def page(self) -> str:
        before = [p for p, c in ((self.header, 0.4), (self.menu, 0.7), (self.notice, 0.3), (self.advert, 0.45),
                                 (self.form, 0.15), (self.sidebar, 0.2), (self.noise, 0.4)) if self.rng.random() < c]
        after = [p for p, c in ((self.share, 0.2), (self.sidebar, 0.35), (self.comments, 0.35), (self.advert, 0.3),
                                (self.form, 0.2), (self.notice, 0.2), (self.menu, 0.15), (self.noise, 0.3))
                 if self.rng.random() < c]
        self.rng.shuffle(before)
        self.rng.shuffle(after)
        middle = self.article()
        inner = "".join(p() for p in before) + middle + "".join(p() for p in after)
        for _ in range(self.rng.choice([0, 0, 1, 2])):
            inner = self.named("div", inner, ["wrapper", "container", "page", "site", "row", "layout"], 0.8)
        inner += self.footer() if self.rng.random() < 0.8 else ""
        head = f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title>{self.noise()}</head><body>"
        return self.rng.choice([head, head, "<html><body>", ""]) + inner + self.rng.choice(["</body></html>", ""])
