"""Labelled pages to learn content extraction from, made by a seeded generator.

Each element that bears a label says so in ``data-label``: ``1`` for the article, ``0``
for what stands around or inside it without belonging to it; what holds the article is
``1`` too. Elements without one take their parent's. Layouts vary: semantic tags or plain
``div`` with telling, neutral or no class names, long and short articles, links and notes
inside them.
"""

from __future__ import annotations

import numpy as np

_CONTENT_TAGS = ("article", "main", "section", "div", "div", "td")
_CONTENT_NAMES = ("content", "post", "entry", "article-body", "story", "post-content", "main-text", "", "")
_AROUND = (
    ("nav", "", "menu"), ("nav", "main-menu", "menu"), ("div", "menu", "menu"), ("ul", "nav-links", "menu"),
    ("div", "navbar", "menu"), ("div", "breadcrumb", "menu"), ("header", "", "head"), ("header", "site-header", "head"),
    ("div", "header", "head"), ("div", "masthead", "head"), ("footer", "", "foot"), ("div", "footer", "foot"),
    ("div", "copyright", "foot"), ("aside", "", "side"), ("aside", "sidebar", "side"), ("div", "sidebar", "side"),
    ("div", "widget", "side"), ("div", "related", "side"), ("div", "cookie-notice", "note"), ("div", "notice", "note"),
    ("div", "cookie-banner", "note"), ("div", "consent", "note"), ("div", "newsletter", "form"), ("form", "", "form"),
    ("form", "search", "form"), ("div", "subscribe", "form"), ("div", "login", "form"), ("div", "ad", "ad"),
    ("div", "advert", "ad"), ("div", "banner", "ad"), ("div", "sponsored", "ad"), ("div", "promo", "ad"),
    ("aside", "ads", "ad"), ("div", "share", "menu"), ("div", "social", "menu"), ("div", "comments", "talk"),
    ("section", "comments", "talk"), ("ol", "comment-list", "talk"), ("div", "comment", "talk"),
    ("section", "reader-comments", "talk"), ("div", "alert", "note"), ("div", "popup", "note"),
    ("div", "disclaimer", "note"), ("section", "related", "side"), ("div", "toolbar", "menu"),
)


class _Writer:
    def __init__(self, seed: int) -> None:
        self.rng = np.random.default_rng(seed)

    def pick(self, options):
        return options[int(self.rng.integers(len(options)))]

    def chance(self, share: float) -> bool:
        return bool(self.rng.random() < share)

    def words(self, least: int, most: int) -> str:
        n = int(self.rng.integers(least, most + 1))
        lengths = self.rng.integers(1, 10, n)
        letters = self.rng.integers(97, 123, int(lengths.sum())).astype(np.uint8).tobytes().decode()
        out, at = [], 0
        for length in lengths:
            out.append(letters[at : at + length])
            at += length
        return " ".join(out).capitalize()

    def sentences(self, least: int, most: int) -> str:
        return " ".join(self.words(3, 18) + "." for _ in range(int(self.rng.integers(least, most + 1))))

    def links(self, tag: str = "li") -> str:
        n = int(self.rng.integers(2, 9))
        return "".join(f'<{tag}><a href="/x">{self.words(1, 3)}</a></{tag}>' for _ in range(n))

    def around(self, kind: tuple[str, str, str]) -> str:
        tag, name, what = kind
        attrs = 'data-label="0"' + (f' {self.pick(("class", "id"))}="{name}"' if name else "")
        if what == "menu":
            inner = self.links() if tag in ("ul", "ol") else self.pick((f"<ul>{self.links()}</ul>", self.links("span")))
        elif what == "head":
            inner = self.pick((f"<h1>{self.words(1, 3)}</h1>", f"<div>{self.words(1, 4)}</div>", f"<p>{self.words(2, 6)}</p>"))
            inner += self.pick(("", f"<ul>{self.links()}</ul>"))
        elif what == "foot":
            inner = self.pick((f"&copy; {self.words(2, 9)}.", f"<p>&copy; {self.sentences(1, 2)}</p><ul>{self.links()}</ul>"))
        elif what == "side":
            inner = f"<h3>{self.words(1, 3)}</h3>" + self.pick((f"<ul>{self.links()}</ul>", f"<p>{self.sentences(1, 3)}</p>"))
        elif what == "form":
            inner = f'<label>{self.words(1, 4)}</label><input name="q"><button>{self.words(1, 2)}</button>'
            inner += self.pick(("", f"<p>{self.sentences(1, 2)}</p>"))
        elif what == "talk":
            row = "li" if tag == "ol" else "div"
            n = int(self.rng.integers(1, 6))
            inner = "".join(
                f'<{row} class="comment"><b>{self.words(1, 2)}</b><p>{self.sentences(1, 5)}</p></{row}>' for _ in range(n)
            )
            inner = self.pick(("", f"<h3>{self.words(1, 3)}</h3>" if row == "div" else "")) + inner
        else:
            text = self.sentences(1, 3)
            inner = self.pick((text, f"<p>{text}</p>", f'<a href="/x">{text}</a>', f"<p>{text}</p><button>{self.words(1, 1)}</button>"))
        return f"<{tag} {attrs}>{inner}</{tag}>"

    def body(self) -> str:
        out = [self.pick((f"<h1>{self.words(2, 9)}</h1>", f"<h2>{self.words(2, 9)}</h2>", ""))]
        if self.chance(0.2):  # nothing but short or very long paragraphs, few or many
            least, most = self.pick(((1, 1), (1, 3), (2, 6), (60, 300)))
            rows = int(self.rng.integers(1, 40 if most < 60 else 6))
            return "".join([*out, *(f"<p>{self.words(least, most)}.</p>" for _ in range(rows))])
        for _ in range(int(self.rng.integers(1, 12))):
            roll = self.rng.random()
            if roll < 0.6:
                text = self.sentences(1, 6)
                if self.chance(0.25):
                    text += f' <a href="/y">{self.words(1, 4)}</a> {self.words(1, 6)}.'
                out.append(self.pick((f"<p>{text}</p>", f"<p>{text}</p>", f"<p><b>{text}<br>", f"<div>{text}</div>")))
            elif roll < 0.68:
                out.append(f"<p>{self.words(1, 3)}.</p>")
            elif roll < 0.76:
                out.append(f"<h2>{self.words(1, 6)}</h2>")
            elif roll < 0.83:
                rows = "".join(f"<li>{self.words(2, 12)}</li>" for _ in range(int(self.rng.integers(2, 6))))
                out.append(f"<ul>{rows}</ul>")
            elif roll < 0.87:
                out.append(f"<blockquote>{self.sentences(1, 3)}</blockquote>")
            elif roll < 0.9:
                cells = f"<tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr>" * 2
                out.append(f"<table>{cells}</table>")
            elif roll < 0.92:
                out.append(f"<pre>{self.words(2, 9)}</pre>")
            else:
                out.append(self.around(self.pick(_AROUND)))
        return "".join(out)

    def page(self) -> str:
        before = "".join(self.around(self.pick(_AROUND)) for _ in range(int(self.rng.integers(0, 4))))
        after = "".join(self.around(self.pick(_AROUND)) for _ in range(int(self.rng.integers(0, 5))))
        tag, name = self.pick(_CONTENT_TAGS), self.pick(_CONTENT_NAMES)
        named = f' {self.pick(("class", "id"))}="{name}"' if name else ""
        article = f'<{tag}{named} data-label="1">{self.body()}</{tag}>'
        if tag == "td":
            article = f"<table><tr>{article}</tr></table>"
        inner = before + article + after
        if self.chance(0.4):
            inner = f'<div class="{self.pick(("wrapper", "container", "page", "row", ""))}">{inner}</div>'
        return f'<html><head><title>{self.words(2, 6)}</title></head><body data-label="1">{inner}</body></html>'


def labelled_pages(count: int = 800, seed: int = 7) -> list[str]:
    """Pages whose elements carry their labels."""
    writer = _Writer(seed)
    return [writer.page() for _ in range(count)]
