"""Labelled pages to learn extraction from, made from a seed: layouts and names of parts as pages on the web have them.

Every element that begins the article or a part beside it carries a label (1 or 0) in an attribute of a name that is
used nowhere else; only label_of reads it, and blocks of text inherit the nearest one above. Words are made up, so that only structure can be learned from them.
"""

from __future__ import annotations

import random
import re

#: The attribute with the label of a part, in made-up pages only.
LABEL = "sparkweft-training-label"
_LABEL = re.compile(rf"\s{LABEL}=([01])")
_SYLLABLES = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve ung ch sch eau ment que ión ß ä é".split()
#: Names that pages give to parts: fixed lists, by kind.
ARTICLE = "article content post entry article-text news-article copy description page-text column-main center-column story main body text article-body post-content entry-content story-body main-content articleText markdown-body page-content news-text blog-post".split()
SIDE = {
    "nav": ["nav", "menu", "links", "top", "left-nav", "sidenav", "header-links", "navbar", "main-menu", "breadcrumb", "breadcrumbs", "site-nav", "topnav", "navigation", "pagination", "toc"],
    "header": ["header", "site-header", "masthead", "top-bar", "branding", "page-header"],
    "footer": ["footer", "site-footer", "copyright", "bottom", "colophon", "legal"],
    "sidebar": ["sidebar", "side", "aside", "widget", "left-column", "right-column", "rail", "more-stories", "recent-posts", "related", "related-posts", "recommended", "most-read", "popular", "trending", "teaser", "secondary"],
    "notice": ["cookie-banner", "cookie", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay", "newsletter", "paywall", "subscribe-box", "announcement", "warning", "disclaimer"],
    "advert": ["ad", "ads", "ad-container", "google-ads", "advertising", "native-ad", "commercial", "advert", "advertisement", "ad-slot", "sponsored", "promo", "banner", "adsbygoogle", "sponsor", "dfp"],
    "form": ["search-form", "login", "signup", "newsletter-form", "contact-form", "subscribe", "search"],
    "comments": ["comments", "comment-list", "comment", "responses", "replies", "discussion", "disqus", "reader-comments", "comments-area"],
    "share": ["share", "social", "share-bar", "sharing", "tags", "byline-links", "meta", "post-meta"],
}


class Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.junk = self.r.choice([""] * 6 + ["!!", "***", "%%%"])
        self.upper = self.r.random() < 0.05
        self.style = self.r.choice(["semantic", "semantic", "mixed", "classes", "classes", "table"])

    def words(self, a: int, b: int) -> str:
        out = " ".join("".join(self.r.choices(_SYLLABLES, k=self.r.randint(1, 4))) + (self.junk if self.r.random() < 0.7 else "") + self.r.choice(["", "", "", "", "", ","]) for _ in range(self.r.randint(a, b)))
        return (out.upper() if self.upper else out.capitalize()) + self.r.choice([".", ".", ".", "", "?", "!"])

    def prose(self) -> str:
        """A paragraph; some are a word or two, many are long, some have links and other inline markup."""
        r, draw = self.r, self.r.random()
        text = self.words(1, 4) if draw < 0.2 else self.words(5, 30) if draw < 0.5 else " ".join(self.words(5, 25) for _ in range(r.randint(2, 7)))
        if r.random() < 0.2:
            text += f' <a href="/{r.randint(1, 99)}">{self.words(1, 4)}</a> ' + self.words(3, 12)
        if r.random() < 0.1:
            text = f"<b>{text}" + r.choice(["</b>", "", "<br>"])
        return text + r.choice([""] * 6 + ["&amp;", "&nbsp;x", " &copy;"])

    def links(self, n: int) -> str:
        return "".join(f'<li><a href="/{k}">{self.words(1, 3).rstrip(".,?!")}</a></li>' for k in range(n))

    def named(self, kind: str) -> str:
        name = self.r.choice(SIDE[kind] if kind in SIDE else ARTICLE)
        return self.r.choice([f' class="{name}"', f" class={name}", f' id="{name}"', f' class="x{self.r.randint(1, 9)} {name}"', f' role="{name}"' if self.r.random() < 0.2 else f' class="{name} box"'])

    def side(self, kind: str, inside: bool = False) -> str:
        """A part beside the article."""
        r = self.r
        tag = {"nav": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form"}.get(kind, "div")
        if tag == "div" and r.random() < 0.4:
            tag = "section"
        plain = self.style in ("semantic", "mixed") and r.random() < (0.4 if kind in ("nav", "footer", "header", "sidebar", "form") else 0.0)
        tag = tag if plain or self.style == "semantic" or (self.style == "mixed" and r.random() < 0.4) else r.choice(["div", "section", "div", "ul" if kind in ("nav", "share") else "div"])
        if self.style == "table" and r.random() < 0.6 and not inside:
            tag = "td"
        inner = {
            "nav": lambda: self.links(r.randint(2, 9)) if tag == "ul" else r.choice([f"<ul>{self.links(r.randint(2, 9))}</ul>", f"<ul>{self.links(r.randint(2, 9))}</ul>", r.choice([" | ", "<br>", " "]).join(f'<a href="/{k}">{self.words(1, 2)}</a>' for k in range(r.randint(2, 6)))]),
            "header": lambda: r.choice([f'<a href="/">{self.words(1, 3)}</a>', f"<p>{self.words(1, 6)}</p>", f"<h1>{self.words(1, 3)}</h1>", f'<div class="logo">{self.words(1, 2)}</div><ul>{self.links(3)}</ul>']),
            "footer": lambda: r.choice([f"&copy; {self.words(1, 4)} &middot; {self.words(3, 12)}", f"<p>&copy; 20{r.randint(10, 30)} {self.words(2, 9)}</p>", f"<ul>{self.links(4)}</ul><p>{self.words(3, 20)}</p>", f"<p>{self.words(4, 12)}</p>"]),
            "sidebar": lambda: r.choice([f"<h3>{self.words(1, 3)}</h3><ul>{self.links(r.randint(2, 6))}</ul>", f"<h2>{self.words(1, 3)}</h2><p>{self.words(4, 25)}</p>", f"<p>{self.words(5, 40)}</p>"]),
            "notice": lambda: r.choice([f"<p>{self.words(5, 30)}</p>", f"{self.words(4, 20)} <a href=#>{self.words(1, 2)}</a>", f"<h4>{self.words(1, 4)}</h4><p>{self.words(5, 30)}</p>"]),
            "advert": lambda: r.choice([self.words(2, 20), f"<p>{self.words(3, 25)}</p>", f'<a href="/x">{self.words(2, 9)}</a>', f"<h4>{self.words(2, 5)}</h4><p>{self.words(4, 25)}</p>"]),
            "form": lambda: r.choice([f"<label>{self.words(1, 3)}</label><input><button>Go</button>", f"<p>{self.words(2, 14)}</p><input type=text>", f"<fieldset><legend>{self.words(1, 3)}</legend><label>{self.words(1, 2)}</label><select><option>a</option></select></fieldset>"]),
            "comments": lambda: f"<h3>{self.words(1, 3)}</h3>" * r.randint(0, 1) + "".join(r.choice([f"<li><p>{self.prose()}</p></li>", f'<div class="{r.choice(["comment", "reply", "comment-body"])}"><p>{self.prose()}</p></div>', f'<div class="comment"><span class="author">{self.words(1, 2)}</span><p>{self.prose()}</p></div>', f"<p>{self.prose()}</p>"]) for _ in range(r.choice([1, 2, 3, 5, 8, 20]))),
            "share": lambda: r.choice([self.links(3) if tag == "ul" else f"<ul>{self.links(3)}</ul>", f'<a href="#">{self.words(1, 2)}</a> <a href="#">{self.words(1, 2)}</a>']),
        }[kind]()
        return f'<{tag}{"" if plain else self.named(kind)} {LABEL}=0>{inner}</{tag}>'

    def article(self) -> str:
        r = self.r
        parts = [f"<h1>{self.words(2, 12)}</h1>"] if r.random() < 0.8 else []
        if parts and r.random() < 0.25:
            byline = r.choice(["", "", f'<div class="{r.choice(["meta", "byline", "date", "entry-meta", "post-info"])}" {LABEL}=0>{self.words(2, 6)}</div>'])
            parts = [f"<header{r.choice(['', ' class=entry-header', ' class=post-header'])} {LABEL}=1>{parts[0].replace('<h1>', r.choice(['<h1>', '<h1 class=title>', '<h1 class=entry-title>']))}{byline}</header>"]
        for _ in range(r.randint(1, 12)):
            draw = r.random()
            if draw < 0.78:
                parts.append(f"<p>{self.prose()}" + ("</p>" if r.random() < 0.9 else ""))
            elif draw < 0.84:
                parts.append(f"<h2>{self.words(1, 7)}</h2>")
            elif draw < 0.88:
                parts.append("<ul>" + "".join(f"<li>{self.words(1, 25)}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
            elif draw < 0.91:
                parts.append(f"<blockquote><p>{self.prose()}</p></blockquote>")
            elif draw < 0.93:
                parts.append(f"<pre>{self.words(3, 30)}</pre>")
            elif draw < 0.95:
                parts.append("<table>" + "".join(f"<tr><td>{self.words(1, 4)}</td><td>{self.words(1, 6)}</td></tr>" for _ in range(3)) + "</table>")
            elif draw < 0.97:
                parts.append(f"<figure><figcaption>{self.words(3, 15)}</figcaption></figure>")
            else:
                parts.append(f"<div>{self.prose()}</div>")
            if r.random() < 0.07:
                parts.append(self.side(r.choice(["advert", "advert", "share", "sidebar", "notice", "form", "nav"]), True))
        if r.random() < 0.3:
            parts.append(self.side(r.choice(["comments", "comments", "comments", "share", "sidebar", "footer"]), True))
        tag = r.choice({"semantic": ["article", "article", "main", "section"], "mixed": ["article", "main", "div", "section"], "classes": ["div", "div", "section"], "table": ["td", "td", "div"]}[self.style])
        bare = tag in ("article", "main") and r.random() < 0.6 or r.random() < 0.05
        if r.random() < 0.15:  # no element around the article
            return "".join(x if LABEL in x[: x.index(">")] else re.sub(r"^<(\w+)", rf"<\1 {LABEL}=1", x) for x in parts)
        inner = "".join(parts)
        if r.random() < 0.3:
            inner = f'<div{self.named("article") if r.random() < 0.7 else ""}>{inner}</div>'
        return f'<{tag}{"" if bare else self.named("article")} {LABEL}=1>{inner}</{tag}>'

    def laid_out(self, parts: list[str]) -> str:
        """parts in order, cells in rows of tables."""
        out, row = [], []
        for x in [*parts, ""]:
            if x.startswith("<td"):
                row.append(x)
                continue
            if row:
                cuts = [k for k in range(1, len(row)) if self.r.random() < 0.5]
                rows = (row[a:b] for a, b in zip([0, *cuts], [*cuts, len(row)], strict=True))
                out.append("<table>" + "".join(f"<tr>{''.join(cells)}</tr>" for cells in rows) + "</table>")
                row = []
            out.append(x)
        return "".join(out)

    def page(self) -> str:
        r = self.r
        if r.random() < 0.04:
            return self.laid_out([self.article()])
        before = [self.side(k) for k in ("nav", "header", "notice", "advert", "form", "sidebar") if r.random() < 0.4]
        after = [self.side(k) for k in ("comments", "sidebar", "advert", "form", "nav", "share", "notice", "footer") if r.random() < (0.7 if k == "footer" else 0.35)]
        r.shuffle(before)
        inner = self.article()
        if r.random() < 0.4 and self.style != "table":
            own = [self.side(k) for k in ("advert", "sidebar", "comments", "share", "nav") if r.random() < 0.3]
            wrap = r.choice(['<div class="wrapper">', "<div>", "<main>", '<div id="page" class="container">', "<form action=/ method=post>", '<div class="row"><div class="col">'])
            inner = wrap + "".join([inner, *own] if r.random() < 0.7 else [*own, inner]) + "".join(f"</{t}>" for t in {"<div class=\"row\"><div class=\"col\">": ["div", "div"]}.get(wrap, [wrap[1:].split()[0].rstrip(">")]))
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title><style>p{{}}</style></head><body>{self.laid_out([*before, inner, *after])}</body></html>"


def label_of(attributes: str) -> int | None:
    m = _LABEL.search(attributes)
    return int(m[1]) if m else None


def labelled_pages(n: int, seed: int) -> list[str]:
    return [Maker(seed * 1_000_003 + k).page() for k in range(n)]
