"""Main text of web pages by a recurrent block labeller.

A page becomes its sequence of leaf blocks (:mod:`sparkfolio.llm.html_blocks`). A block's vector holds the mean of its tag
path's embeddings, the mean of its hashed words' embeddings, its length and its share of link text. A bidirectional LSTM
in numpy reads the sequence in both directions, so each block is labelled from the whole page; blocks labelled 1
are the main text.

The model is trained on the driver on a bounded sample: at most ``FIT_PAGES`` pages of the table, each of at most
``FIT_CHARS`` characters, those with the smallest hash of (page_id, url). Blocks of the sample that their
elements name plainly (inside ``article`` or ``main``; inside ``nav``, ``footer``, ``form`` ...) are labelled by them.
Their texts are also laid out anew in pages of many other plans, with labels known from the plan, so that the model does not hang on one
site's markup. All pages, whole, are labelled by the model in Spark tasks.
"""

from __future__ import annotations

import html
import random
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkfolio.llm.html_blocks import PATH_BUCKETS, Block, bucket, leaves
from sparkfolio.llm.spark_env import prepare, trim

#: The bound of the labelled sample, and how many pages are laid out anew from its texts.
FIT_PAGES = 300
FIT_CHARS = 1 << 16
LAID_OUT = 1000
WORD_BUCKETS = 4096
WIDTH = 16
HIDDEN = 24
NUMBERS = 3
EPOCHS = 10
RATE = 0.01
#: Share of blocks whose words are left out while training, so that no single word decides.
WORDS_OUT = 0.5
#: Padded steps computed at once, and characters of HTML parsed at once.
STEPS = 1 << 15
PIECE_CHARS = 4 << 20

#: Elements that name their blocks.
MAIN = ("article", "main")
ASIDE = ("nav", "footer", "aside", "form", "header", "button", "select", "option", "label", "dialog")
#: Class names that plans give to parts of a page.
NAMES = {
    "content": ("content", "post", "entry-content", "article-body", "story", "text", "main", "post-body", "page-content", "articleText"),
    "menu": ("menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "top-links", "tabs", "toc", "pagination"),
    "header": ("header", "masthead", "site-header", "topbar", "branding", "logo"),
    "footer": ("footer", "site-footer", "copyright", "bottom", "legal", "colophon"),
    "side": ("sidebar", "side", "widget", "related", "recommended", "popular", "trending", "more-stories", "tags", "share", "social", "author-box"),
    "notice": ("notice", "cookie-notice", "cookies", "consent", "gdpr", "alert", "banner", "popup", "modal", "disclaimer", "paywall", "newsletter"),
    "ad": ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-container", "adsbox", "sponsor", "banner-ad"),
    "comments": ("comments", "comment-list", "comment", "discussion", "responses", "replies", "respond", "disqus_thread", "user-comments", "reviews"),
    "form": ("form", "search", "search-form", "login", "subscribe", "newsletter-signup", "contact-form", "comment-form"),
}
#: Phrases of page furniture.
PHRASES = {
    "menu": ("Home", "About us", "Contact", "News", "Sports", "Login", "Sign up", "Archive", "Next page", "Startseite", "Kontakt", "Accueil", "Inicio", "Contacto"),
    "header": ("My weblog", "Daily news", "Your trusted source", "Welcome", "Search", "Menu"),
    "footer": ("All rights reserved.", "Privacy policy", "Terms of use", "Impressum", "Mentions légales", "Aviso legal", "Powered by", "© 2024"),
    "side": ("Related articles", "Most read", "Popular posts", "You may also like", "Share this", "Follow us", "Tags", "About the author", "Read more"),
    "notice": ("We use cookies to improve your experience.", "Accept all cookies", "This site uses cookies.", "Wir verwenden Cookies.", "Nous utilisons des cookies.",
               "Usamos cookies.", "Please enable JavaScript.", "Subscribe to our newsletter", "You have 2 free articles left."),
    "ad": ("Advertisement", "Sponsored", "Buy now", "Limited offer!", "Click here", "Anzeige", "Publicité", "Publicidad"),
    "comments": ("Comments", "3 Comments", "Leave a reply", "Reply", "Kommentare", "Commentaires", "Comentarios", "says:", "Great post, thanks!", "I disagree with this.", "Report"),
    "form": ("Your email", "Name", "Submit", "Search", "Password", "Send", "Subscribe", "Log in", "E-Mail", "Post comment"),
}


@dataclass
class Pages:
    """Blocks of some pages as arrays; page ``i`` owns blocks ``first[i]:first[i + 1]``."""

    first: np.ndarray
    path: tuple[np.ndarray, np.ndarray]        # buckets of all blocks in a row, first bucket of each block
    words: tuple[np.ndarray, np.ndarray]
    numbers: np.ndarray


def _flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([0, *map(len, lists)], np.int64)
    return np.fromiter((x for one in lists for x in one), np.int64, int(sizes.sum())), np.cumsum(sizes)


def word_buckets(text: str) -> list[int]:
    return [crc32(w) % WORD_BUCKETS for w in text.lower().encode().split()]


def encode(pages: list[list[Block]]) -> Pages:
    blocks = [b for page in pages for b in page]
    words = [word_buckets(b.text) for b in blocks]
    numbers = np.array([(np.log1p(len(w)) / 4, b.links, float(b.text[-1] in ".!?…。")) for w, b in zip(words, blocks)], np.float32).reshape(-1, NUMBERS)
    return Pages(np.cumsum([0, *map(len, pages)]), _flat([sorted(b.path) for b in blocks]), _flat(words), numbers)


def _means(table: np.ndarray, ragged: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Mean of the rows of ``table`` that each block names; a bounded number of them is looked up at once."""
    at, first = ragged
    out = np.zeros((len(first) - 1, table.shape[1]), np.float32)
    block = 0
    while block < len(out):
        to = max(block + 1, int(np.searchsorted(first, first[block] + (1 << 18), side="right")) - 1)
        for lo in range(first[block], first[to], 1 << 18):       # one block may be longer than that
            hi = min(lo + (1 << 18), first[to])
            owner = np.searchsorted(first, np.arange(lo, hi), side="right") - 1
            runs = np.flatnonzero(np.diff(owner, prepend=-1))
            out[owner[runs]] += np.add.reduceat(table[at[lo:hi]], runs, axis=0)
        block = to
    return out / np.maximum(np.diff(first), 1)[:, None].astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _turned(x: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Each sequence (time, page, ...) from its end to its start, padding left at the end."""
    t = np.arange(len(x))[:, None]
    at = np.where(t < sizes, sizes - 1 - t, t)
    return np.take_along_axis(x, at[:, :, None], 0)


class Labeller:
    """Bidirectional LSTM over blocks with a logistic output. ``p`` holds its parameters by name."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        size = 2 * WIDTH + NUMBERS

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.normal(size=shape) * scale).astype(np.float32)

        self.p = {"path": normal(PATH_BUCKETS, WIDTH, scale=0.5), "word": normal(WORD_BUCKETS, WIDTH, scale=0.3),
                  "out": normal(2 * HIDDEN, scale=0.2), "bias": np.zeros(1, np.float32)}
        for side in ("f", "b"):
            self.p[f"w{side}"] = normal(size, 4 * HIDDEN, scale=size**-0.5)
            self.p[f"u{side}"] = normal(HIDDEN, 4 * HIDDEN, scale=HIDDEN**-0.5)
            start = np.zeros(4 * HIDDEN, np.float32)
            start[HIDDEN:2 * HIDDEN] = 1                          # remember at first
            self.p[f"c{side}"] = start

    def inputs(self, pages: Pages) -> np.ndarray:
        return np.hstack([_means(self.p["path"], pages.path), _means(self.p["word"], pages.words), pages.numbers])

    def _read(self, x: np.ndarray, sizes: np.ndarray, side: str, keep: bool = False):
        """Hidden states (time, page, HIDDEN); pages are sorted by falling length, so step t reads the first few."""
        t_all, n, _ = x.shape
        w, u, c = self.p[f"w{side}"], self.p[f"u{side}"], self.p[f"c{side}"]
        out = np.zeros((t_all, n, HIDDEN), np.float32)
        h, s = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        saved = []
        for lo in range(0, t_all, 1024):
            drive = x[lo:lo + 1024] @ w + c
            for t in range(lo, min(lo + 1024, t_all)):
                k = int(np.searchsorted(-sizes, -t, side="left"))
                z = drive[t - lo, :k] + h[:k] @ u
                gates = _sigmoid(z[:, :3 * HIDDEN])
                new = np.tanh(z[:, 3 * HIDDEN:])
                i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
                before = s[:k].copy() if keep else None
                s[:k] = f * s[:k] + i * new
                squashed = np.tanh(s[:k])
                if keep:
                    saved.append((k, h[:k].copy(), before, i, f, o, new, squashed))
                h[:k] = o * squashed
                out[t, :k] = h[:k]
        return out, saved

    def _back(self, x: np.ndarray, saved: list, grad: np.ndarray, side: str, g: dict) -> np.ndarray:
        """Back through time: adds the gradients of one direction to ``g``, returns that of the inputs."""
        w, u = self.p[f"w{side}"], self.p[f"u{side}"]
        n = x.shape[1]
        dx = np.zeros_like(x)
        dh, ds = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        for t in range(len(saved) - 1, -1, -1):
            k, h, before, i, f, o, new, squashed = saved[t]
            d = dh[:k] + grad[t, :k]
            state = ds[:k] + d * o * (1 - squashed**2)
            dz = np.hstack([state * new * i * (1 - i), state * before * f * (1 - f), d * squashed * o * (1 - o), state * i * (1 - new**2)])
            g[f"w{side}"] += x[t, :k].T @ dz
            g[f"u{side}"] += h.T @ dz
            g[f"c{side}"] += dz.sum(0)
            dx[t, :k] = dz @ w.T
            dh[:k], ds[:k] = dz @ u.T, state * f
        return dx

    @staticmethod
    def _grid(first: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(block of each (time, page), whether it is one, sizes) of the chosen pages."""
        sizes = first[chosen + 1] - first[chosen]
        t = np.arange(int(sizes.max(initial=0)))[:, None]
        inside = t < sizes
        return np.where(inside, first[chosen] + t, 0), inside, sizes

    def scores(self, pages: Pages) -> np.ndarray:
        """Probability of each block to be main text."""
        sizes = np.diff(pages.first)
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        out, x, at = np.zeros(int(pages.first[-1]), np.float32), self.inputs(pages), 0
        while at < len(order):
            chosen = order[at:at + max(1, STEPS // int(sizes[order[at]]))]
            at += len(chosen)
            block, inside, length = self._grid(pages.first, chosen)
            steps = x[block]
            ahead, _ = self._read(steps, length, "f")
            back, _ = self._read(_turned(steps, length), length, "b")
            z = np.concatenate([ahead, _turned(back, length)], 2) @ self.p["out"] + self.p["bias"]
            out[block[inside]] = _sigmoid(z)[inside]
        return out

    def gradients(self, pages: Pages, chosen: np.ndarray, y: np.ndarray, weight: np.ndarray, seen: np.ndarray | None = None) -> tuple[float, dict]:
        """(mean log loss, gradient by parameter) over the chosen pages, longest first. ``seen``: blocks whose words are read."""
        p = self.p
        block, inside, sizes = self._grid(pages.first, chosen)
        mine = block[inside]
        x_all = self.inputs(pages)
        if seen is not None:
            x_all[:, WIDTH:2 * WIDTH] *= seen[:, None]
        x = x_all[block]
        ahead, kept_f = self._read(x, sizes, "f", keep=True)
        turned = _turned(x, sizes)
        back, kept_b = self._read(turned, sizes, "b", keep=True)
        both = np.concatenate([ahead, _turned(back, sizes)], 2)
        q = _sigmoid(both @ p["out"] + p["bias"])
        wt = weight[block] * inside
        total = max(float(wt.sum()), 1.0)
        loss = -float((wt * np.where(y[block] > 0, np.log(q + 1e-7), np.log(1 - q + 1e-7))).sum()) / total
        dz = ((q - y[block]) * wt / total).astype(np.float32)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        g["out"] += np.tensordot(dz, both, ([0, 1], [0, 1]))
        g["bias"] += dz.sum()
        grad = dz[:, :, None] * p["out"]
        dx = self._back(x, kept_f, grad[:, :, :HIDDEN], "f", g)
        dx += _turned(self._back(turned, kept_b, _turned(grad[:, :, HIDDEN:], sizes), "b", g), sizes)
        per_block = np.zeros_like(x_all)
        per_block[mine] = dx[inside]
        for name, (at, first), lo in (("path", pages.path, 0), ("word", pages.words, WIDTH)):
            n = np.diff(first)
            part = per_block[:, lo:lo + WIDTH] / np.maximum(n, 1)[:, None]
            if name == "word" and seen is not None:
                part *= seen[:, None]
            order = np.argsort(at, kind="stable")
            runs = np.flatnonzero(np.diff(at[order], prepend=-1))
            if len(runs):
                g[name][at[order][runs]] = np.add.reduceat(np.repeat(part, n, axis=0)[order], runs, axis=0)
        return loss, g

    def fit(self, pages: list[list[Block]], epochs: int = EPOCHS, rate: float = RATE, seed: int = 11) -> list[float]:
        """Adam on small groups of pages of like length; blocks labelled "" are context only. Returns the loss of each epoch."""
        rng = np.random.default_rng(seed)
        pages = sorted((p for p in pages if p), key=len, reverse=True)
        groups = []
        for at in range(0, len(pages), 16):
            mine = pages[at:at + 16]
            labels = [b.label for page in mine for b in page]
            groups.append((encode(mine), np.array([v == "1" for v in labels], np.float32), np.array([v != "" for v in labels], np.float32)))
        first, second, step, losses = {k: 0.0 for k in self.p}, {k: 0.0 for k in self.p}, 0, []
        for epoch in range(epochs):
            epoch_loss = []
            for at in rng.permutation(len(groups)):
                coded, y, weight = groups[at]
                seen = (rng.random(len(y)) >= WORDS_OUT).astype(np.float32)
                loss, g = self.gradients(coded, np.arange(len(coded.first) - 1), y, weight, seen)
                norm = np.sqrt(sum(float((v**2).sum()) for v in g.values()))
                step += 1
                for k, v in g.items():
                    v = v * min(1.0, 5 / (norm + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.999 * second[k] + 0.001 * v * v
                    self.p[k] = (self.p[k] - rate * (0.5 ** (epoch / 2)) * (first[k] / (1 - 0.9**step))
                                 / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
                epoch_loss.append(loss)
            losses.append(float(np.mean(epoch_loss)) if epoch_loss else 0.0)
        return losses


def named(blocks: list[Block]) -> list[Block]:
    """Labels from plain element names: furniture wins over ``article`` and ``main``; "" where neither is on the path."""
    good = {bucket(f"tag:{t}") for t in MAIN}
    bad = {bucket(f"tag:{t}") for t in ASIDE} | {bucket(f"name:{n}") for n in ("ad", "ads", "advert", "sidebar", "comments", "comment", "cookie", "banner", "promo")}
    return [Block(b.text, b.path, b.tags, b.links, "0" if b.path & bad else "1" if b.path & good else "") for b in blocks]


class Plans:
    """Pages laid out anew: texts of the sample in the markup of many plans, each block's label in ``data-y``."""

    def __init__(self, prose: list[str], furniture: list[str], seed: int = 23):
        self.r = random.Random(seed)
        self.prose = prose or ["A paragraph of plain text, with some words.", "Another sentence follows here, and ends."]
        self.furniture = furniture or ["Home", "Contact"]

    def some(self, p: float) -> bool:
        return self.r.random() < p

    def words(self) -> str:
        text = self.r.choice(self.furniture if self.some(0.12) else self.prose)
        if self.some(0.3):
            parts = text.split()
            text = " ".join(parts[:self.r.choice((1, 2, 5, 12, 30))])
        return html.escape(text, quote=False)

    def phrase(self, kind: str) -> str:
        return html.escape(self.r.choice(self.furniture) if self.some(0.3) else self.r.choice(PHRASES[kind]), quote=False)

    def names(self, kind: str) -> str:
        if self.bare:
            return ""
        attribute = self.r.choice(("class", "class", "class", "id"))
        return f' {attribute}="{self.r.choice(NAMES[kind])}{self.r.choice(("", "", f" c{self.r.randint(1, 9)}", "-wrap"))}"'

    def links(self, kind: str) -> str:
        items = [f'<a href="/{i}">{self.phrase(kind)}</a>' for i in range(self.r.randint(1, 8))]
        if self.some(0.5):
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return self.r.choice((" | ", " ", "<br>")).join(items) if self.some(0.5) else "".join(f"<div>{i}</div>" for i in items)

    def box(self, kind: str, tags: tuple[str, ...], inner: str) -> str:
        tag = "div" if self.bare and self.some(0.5) else self.r.choice(tags)
        return f'<{tag}{self.names(kind)} data-y="0">{inner}</{tag}>'

    def part(self, kind: str) -> str:
        r = self.r
        if kind == "menu":
            return self.box(kind, ("nav", "div", "ul", "nav"), self.links(kind))
        if kind == "header":
            return self.box(kind, ("header", "div", "header"), f"<{(t := r.choice(('h1', 'div', 'p', 'a')))}>{self.phrase(kind)}</{t}>" + (self.links("menu") if self.some(0.3) else ""))
        if kind == "footer":
            inner = r.choice((f"&copy; {self.phrase('footer')} &middot; {self.words()}", f"<p>{self.phrase('footer')}</p><p>{self.words()}</p>", self.links("footer"), self.phrase("footer")))
            return self.box(kind, ("footer", "div", "footer"), inner)
        if kind == "side":
            inner = f"<{(t := r.choice(('h2', 'h3', 'h4', 'div', 'strong')))}>{self.phrase(kind)}</{t}>" + r.choice((self.links("side"), f"<p>{self.words()}</p>", self.links("side")))
            return self.box(kind, ("aside", "div", "section"), inner)
        if kind == "notice":
            return self.box(kind, ("div", "div", "section", "dialog"), f"<p>{self.phrase(kind)}</p>" + (f"<button>{self.phrase('form')}</button>" if self.some(0.5) else ""))
        if kind == "ad":
            names = self.names(kind) or f' class="{r.choice(NAMES[kind])}"'
            return f'<div{names} data-y="0">{self.words() if self.some(0.7) else self.phrase(kind)}</div>'
        if kind == "form":
            return self.box(kind, ("form", "form", "div"), f"<label>{self.phrase(kind)}</label><input name=q>" + f"<button>{self.phrase(kind)}</button>")
        items = []
        for _ in range(r.randint(1, 6)):
            who = f"<{(t := r.choice(('b', 'cite', 'span', 'div', 'h4')))}>{html.escape(r.choice(self.furniture))}</{t}>"
            tag = r.choice(("div", "li", "article", "p"))
            said = self.words() if self.some(0.8) else self.phrase("comments")
            said = f"<p>{said}</p>" if tag != "p" and self.some(0.6) else said
            name = "" if self.some(0.5) else self.names("comments")
            items.append(f"<{tag}{name}>{who} {said}" + (f"<a href=#>{r.choice(('Reply', 'Report', 'Like'))}</a>" if self.some(0.5) else "") + f"</{tag}>")
        names = self.names(kind) or f' class="{r.choice(NAMES[kind])}"'
        tag = r.choice(("section", "div", "ol", "ul", "div"))
        return f'<{tag}{names} data-y="0"><h3>{self.phrase("comments")}</h3>{"".join(items)}{self.part("form") if self.some(0.4) else ""}</{tag}>'

    def paragraph(self) -> str:
        text, r = self.words(), self.r
        if self.some(0.15):
            parts = text.split(" ")
            i = r.randrange(len(parts))
            parts[i] = r.choice(('<a href="/x">{}</a>', "<b>{}</b>", "<em>{}</em>")).format(parts[i])
            text = " ".join(parts)
        kind = r.choices(("p", "open", "div", "li", "quote", "td", "pre", "h2", "b"), (60, 6, 6, 6, 4, 4, 2, 7, 5))[0]
        return {"p": f"<p>{text}</p>", "open": f"<p>{text}", "div": f"<div>{text}</div>", "li": f"<ul><li>{text}</li><li>{self.words()}</li></ul>",
                "quote": f"<blockquote><p>{text}</p></blockquote>", "td": f"<table><tr><td>{text}</td><td>{self.words()}</td></tr></table>", "pre": f"<pre>{text}</pre>",
                "h2": f"<{(t := r.choice(('h2', 'h3', 'h4')))}>{' '.join(self.words().split(' ')[:8])}</{t}><p>{text}</p>", "b": f"<p><b>{text}<br><p>{self.words()}</p>"}[kind]

    def page(self) -> str:
        r = self.r
        self.bare = self.some(0.15)
        body = [self.paragraph() for _ in range(r.choice((0, 1, 2, 3, 5, 8, 12)))]
        for kind in ("ad", "side", "form", "notice"):
            if body and self.some(0.2):
                body.insert(r.randrange(len(body) + 1), self.part(kind))
        title = f"<h1>{' '.join(self.words().split(' ')[:12])}</h1>" if self.some(0.8) or not body else ""
        tag = r.choice(("article", "article", "article", "main", "div", "div", "section", "td"))
        names = "" if self.some(0.6 if tag in MAIN else 0.2) else self.names("content")
        closed = "" if self.some(0.05) else f"</{tag}>"
        text = f'<{tag}{names} data-y="1">{title}{"".join(body)}' + closed
        if tag == "td":
            text = f"<table><tr>{text}</tr></table>"
        before = [self.part(k) for k, p in (("notice", 0.25), ("header", 0.4), ("menu", 0.75), ("ad", 0.5), ("side", 0.15), ("form", 0.15)) if self.some(p)]
        after = [self.part(k) for k, p in (("comments", 0.4), ("side", 0.35), ("ad", 0.15), ("menu", 0.15), ("form", 0.2), ("footer", 0.8), ("notice", 0.1)) if self.some(p)]
        if self.some(0.3):
            r.shuffle(before)
        if self.some(0.2):
            text = f"<div{self.names('content')}>{text}{after.pop(0) if after else ''}</div>"
        script = "<!-- x --><script>var a = '<p>';</script>" if self.some(0.5) else ""
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{''.join(before)}{script}{text}{''.join(after)}</body></html>"


def sample(pages: DataFrame, most: int = FIT_PAGES, chars: int = FIT_CHARS) -> list[str]:
    """HTML of at most ``most`` pages of at most ``chars`` characters, those of the smallest hash."""
    rank = F.xxhash64(F.col("page_id").cast("string"), F.col("url").cast("string"))
    share = max(1, pages.count() // (4 * most))
    fit = pages.filter(F.pmod(rank, F.lit(share)) == 0).filter(F.length("html") <= chars)
    return [r.html for r in fit.orderBy(rank, F.sha2("html", 256)).limit(most).select("html").collect()]


def train(pages: DataFrame, most: int = FIT_PAGES, laid_out: int = LAID_OUT) -> Labeller:
    """The labeller fitted on a bounded sample of ``pages``."""
    own = [named(leaves(h)) for h in sample(pages, most)]
    blocks = [b for page in own for b in page]
    texts = {y: [t for t, _ in Counter(b.text for b in blocks if b.label == y).most_common()] for y in "01"}
    plans = Plans(sorted(texts["1"]), sorted(texts["0"]))
    model = Labeller()
    model.fit(own + own + [leaves(plans.page()) for _ in range(laid_out)])
    return model


def _label(model: Labeller, shape: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls, texts = (batch.column(i) for i in range(3))
            at = 0
            while at < len(texts):
                start, chars, parsed = at, 0, []
                while at < len(texts) and chars < PIECE_CHARS:
                    page = texts[at].as_py()
                    parsed.append(leaves(page))
                    chars, at = chars + len(page or ""), at + 1
                coded = encode(parsed)
                scores = model.scores(coded)
                keys = [ids.slice(start, at - start), urls.slice(start, at - start)]
                pages = [list(zip(blocks, scores[lo:hi].tolist())) for blocks, lo, hi in zip(parsed, coded.first, coded.first[1:])]
                if shape == "text":
                    rest = [pa.array(["\n".join(b.text for b, s in page if s >= 0.5) for page in pages], pa.string()),
                            pa.array([len(page) for page in pages], pa.int64())]
                    names = ["text", "n_blocks"]
                else:
                    rest = [pa.array([[{"text": b.text, "tag": b.tags, "score": s, "main": s >= 0.5} for b, s in page] for page in pages],
                                     pa.list_(pa.struct([("text", pa.string()), ("tag", pa.string()), ("score", pa.float64()), ("main", pa.bool_())])))]
                    names = ["blocks"]
                yield pa.RecordBatch.from_arrays([*keys, *rest], names=["page_id", "url", *names])
        trim()
    return run


def _apply(pages: DataFrame, model: Labeller | None, shape: str, schema: str) -> DataFrame:
    prepare(pages.sparkSession)
    cut = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    ids = f"page_id {cut.schema['page_id'].dataType.simpleString()}, url {cut.schema['url'].dataType.simpleString()}, "
    return cut.mapInArrow(_label(model or train(cut), shape), ids + schema)


def main_text(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text, n_chars, n_blocks: one row for each row of ``pages`` (page_id, url, html; others are not read).

    Without ``model`` one is trained on a sample of ``pages``. Kept blocks are joined by a line break in page order, white space
    inside a block is one space, character references are decoded. Null, empty and text-free pages, and pages without
    a block labelled main, have the text "". Repeated rows and null ids come back as they are; an empty table gives no row.
    """
    return _apply(pages, model, "text", "text string, n_blocks bigint") \
        .select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"), "n_blocks")


def labelled_blocks(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url and all blocks of each page with tag, score and label (rows as in :func:`main_text`)."""
    return _apply(pages, model, "blocks", "blocks array<struct<text:string,tag:string,score:double,main:boolean>>")
