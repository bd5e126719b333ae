"""Training of the block labeller: ``python -m playtide.llm.train_blocks`` writes ``block_weights.npz``.

The pages are made up from the conventions of web pages (which elements, classes and ids sites use for articles,
menus, notices, adverts, comments and so on), so that every block's label is known. Their words are frequent ones of
several languages or invented ones. Part of the pages name no class or id at all, so that tags, sizes and order count too.
"""

from __future__ import annotations

import re
import sys

import numpy as np

from playtide.llm.html_blocks import HIDDEN, INPUTS, WEIGHTS, Labeller, _sigmoid, blocks, features, run_lstm, turned

PAGES, EPOCHS, BATCH, RATE = 6000, 16, 32, 0.01

_MAIN = (
    ("<article>", "</article>"), ('<article class="post">', "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"),
    ('<div id="main-content">', "</div>"), ('<div class="post-body entry-content">', "</div>"), ('<section class="story">', "</section>"),
    ('<div class="article-body">', "</div>"), ("<main><article>", "</article></main>"), ('<div class="text">', "</div>"), ("<div>", "</div>"),
    ('<div id="content"><div class="entry">', "</div></div>"),
)
_SIDES = {
    "menu": (("<nav>", "</nav>"), ('<div class="menu">', "</div>"), ('<ul id="navigation">', "</ul>"), ('<div class="breadcrumb">', "</div>"),
             ('<nav class="navbar main-nav">', "</nav>")),
    "header": (("<header>", "</header>"), ('<div id="header">', "</div>"), ('<div class="site-header masthead">', "</div>"), ('<div class="topbar">', "</div>")),
    "footer": (("<footer>", "</footer>"), ('<div id="footer">', "</div>"), ('<div class="site-footer copyright">', "</div>")),
    "side": (("<aside>", "</aside>"), ('<div class="sidebar">', "</div>"), ('<div class="related">', "</div>"), ('<div class="widget recommended">', "</div>"),
             ('<aside class="more-stories">', "</aside>"), ('<div class="share social">', "</div>")),
    "notice": (('<div class="cookie-notice">', "</div>"), ('<div id="consent-banner">', "</div>"), ('<div class="newsletter subscribe">', "</div>"),
               ('<div class="notice">', "</div>"), ('<div class="alert popup modal">', "</div>"), ('<div role="dialog">', "</div>")),
    "ad": (('<div class="ad">', "</div>"), ('<div class="ads">', "</div>"), ('<div class="advert">', "</div>"), ('<div class="advertisement">', "</div>"),
           ('<div class="sponsored promo">', "</div>"), ('<aside class="ad">', "</aside>"), ('<div id="banner-ad">', "</div>")),
    "form": (("<form>", "</form>"), ('<form class="login">', "</form>"), ('<div class="search"><form>', "</form></div>")),
    "comments": (('<section class="comments">', "</section>"), ('<div id="comments">', "</div>"), ('<div class="comment-list">', "</div>"),
                 ('<ol class="commentlist">', "</ol>"), ('<div id="disqus" class="discussion replies">', "</div>")),
}
#: Frequent words, and words of menus, notices, forms and comments.
_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which one you were all "
          "their there been many who more when about time some people year day house water river work school city music paper light",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
          "einer um am sind noch wie einem über so zum haben nur oder aber vor zur bis mehr durch Jahr Stadt Haus Wasser Arbeit",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ils mais comme ou si leur deux "
          "cette elle aussi entre fait tout être même ans ville maison eau travail musique lumière pays jour",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más pero sus le ya o este sí porque esta entre cuando muy "
          "sin sobre también me hasta hay donde ciudad casa agua trabajo año música luz río país día",
}
_LABELS = ("Home News Sport Weather About Contact Search Login Register Subscribe Share Tweet Follow Menu Next Previous Archive Shop Blog Help Privacy "
           "Terms Cookies Accept Settings Sitemap Imprint Newsletter Related Popular Comments Reply Email Name Password Startseite Kontakt Impressum "
           "Accueil Actualités Inicio Noticias").split()
_SYLLABLES = "the er on an re he in ed nd ha at en es of nt ea ti to io le is ou ar as de rt ve que sch ung ció mente eau".split()


_ATTRIBUTES = re.compile(r""" (?:class|id|role)=(?:"[^"]*"|'[^']*')""")


class _Writer:
    def __init__(self, rng: np.random.Generator):
        self.rng = rng
        self.vocabulary = None if rng.random() < 0.4 else self.pick([*_WORDS.values()]).split()
        self.named = rng.random() < 0.8  # do elements of this page have classes and ids?

    def pick(self, items):
        return items[int(self.rng.integers(len(items)))]

    def words(self, n: int) -> str:
        out = []
        for k in range(n):
            if self.vocabulary is None:
                word = "".join(self.pick(_SYLLABLES) for _ in range(int(self.rng.integers(1, 5))))
            else:
                word = self.pick(self.vocabulary)
            if self.rng.random() < 0.1:  # a letter or a mark alone
                word = self.pick(["a", "x", "b", "&amp;", "1", "-"])
            mark = self.pick(["", "", "", "", "", "", ",", ".", "!", "***", "&amp;"])
            out.append((word.capitalize() if k == 0 or self.rng.random() < 0.1 else word) + mark)
        text = " ".join(out)
        return text.upper() if self.rng.random() < 0.05 else text + self.pick([".", ".", "", "!"])

    def label(self, n: int) -> str:
        """A few words of a menu or form."""
        return " ".join(self.pick(_LABELS) for _ in range(min(n, 3))) if self.vocabulary is not None and self.rng.random() < 0.7 else self.words(n)

    def bare(self, page: str) -> str:
        """The page without its classes, ids and roles, if it is one of those."""
        return page if self.named else _ATTRIBUTES.sub("", page)

    def sizes(self) -> int:
        return int(self.pick([1, 2, 4, 8, 15, 30, 30, 60, 60, 120]))

    def paragraphs(self, n: int) -> str:
        out = []
        for _ in range(n):
            text = self.words(self.sizes())
            kind = self.rng.random()
            if kind < 0.6:
                out.append(f"<p>{text}</p>")
            elif kind < 0.7:
                out.append(f"<p><b>{text}<br>")
            elif kind < 0.78:
                out.append(f"<h2>{self.words(4)}</h2>")
            elif kind < 0.84:
                out.append(f"<p>{text} <a href='/x'>{self.words(2)}</a> {self.words(5)}</p>")
            elif kind < 0.9:
                out.append("<ul>" + "".join(f"<li>{self.words(self.sizes())}</li>" for _ in range(3)) + "</ul>")
            elif kind < 0.95:
                out.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.96:
                out.append(f"<div>{text}</div>")
            else:
                out.append(self.special())
        return "".join(out)

    def special(self) -> str:
        """A table, code, a figure with its caption, or a list of definitions, as articles hold them."""
        kind, few = int(self.rng.integers(4)), int(self.rng.integers(2, 5))
        if kind == 0:
            rows = [[self.words(int(self.rng.integers(1, 5))) for _ in range(3)] for _ in range(few)]
            head = "<tr>" + "".join(f"<th>{self.words(1)}</th>" for _ in range(3)) + "</tr>"
            return f"<table>{head}" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"
        if kind == 1:
            return "<pre><code>" + "\n".join(f"{self.words(1)} = {self.words(1)}({k})" for k in range(few)) + "</code></pre>"
        if kind == 2:
            return f"<figure><img src='x.png'><figcaption>{self.words(int(self.rng.integers(3, 15)))}</figcaption></figure>"
        return "<dl>" + "".join(f"<dt>{self.words(2)}</dt><dd>{self.words(self.sizes())}</dd>" for _ in range(few)) + "</dl>"

    def side(self, kind: str) -> str:
        first, last = self.pick(_SIDES[kind])
        if kind in ("menu", "header") or kind == "side" and self.rng.random() < 0.4:
            body = "".join(f"<li><a href='/{k}'>{self.label(int(self.rng.integers(1, 4)))}</a></li>" for k in range(int(self.rng.integers(1, 8))))
            body = f"<ul>{body}</ul>" if self.rng.random() < 0.8 else body
            body = f"<h1>{self.words(2)}</h1>{body}" if kind == "header" and self.rng.random() < 0.5 else body
        elif kind == "form":
            body = f"<label>{self.label(2)}</label><input name=q>{self.label(3)}<p>{self.words(6)}</p>"
        elif kind == "footer":
            body = self.pick(["&copy; 2020 ", "&copy; ", ""]) + f"{self.words(self.pick([3, 8, 20]))}" + self.pick(["", f"<p>{self.words(6)}</p>"])
        elif kind == "comments":
            body = "".join(f"<div class='{self.pick(['comment', 'reply', 'comment-body', ''])}'><b>{self.words(1)}</b><p>{self.words(self.sizes())}</p></div>"
                           for _ in range(int(self.rng.integers(1, 5))))
            body = f"<h3>Comments</h3>{body}" if self.rng.random() < 0.5 else body
        else:
            body = self.words(self.pick([3, 6, 10, 25, 40]))
            body = f"<p>{body}</p>" if self.rng.random() < 0.6 else body
        return f"{first}{body}{last}"

    def page(self) -> tuple[str, str]:
        """A page with its main part between two markers."""
        first, last = self.pick(_MAIN)
        if self.rng.random() < 0.15:  # a bare page
            first, last = self.pick([("", ""), ("<article>", "</article>"), (first, last)])
            body = self.words(self.sizes()) if self.rng.random() < 0.5 else self.paragraphs(int(self.rng.integers(1, 4)))
            ahead, behind = self.pick([("", ""), ("", ""), (self.side("menu"), ""), (self.side("form"), ""), (self.side("ad"), self.side("footer"))])
            return self.bare(f"{ahead}\x01{first}{body}{last}\x02{behind}"), first
        before = [self.side(k) for k in ("header", "menu", "notice", "ad", "side", "form") if self.rng.random() < (0.85 if k == "menu" else 0.4)]
        after = [self.side(k) for k in ("ad", "side", "comments", "form", "notice", "footer") if self.rng.random() < (0.85 if k == "footer" else 0.35)]
        count = int(self.pick([1, 1, 2, 4, 8, 12]))
        short = " ".join(self.pick(["A", "B", "x", "&amp;", "1", "on", "it"]) for _ in range(int(self.rng.integers(1, 4))))
        heading = short if self.rng.random() < 0.2 else self.words(int(self.rng.integers(1, 9)))
        title = f"<h1>{heading}</h1>" if self.rng.random() < 0.8 else ""
        inner = [self.side(k) for k in ("ad", "side", "comments", "form") if self.rng.random() < 0.12]
        half = int(self.rng.integers(count + 1))
        main = title + self.paragraphs(half) + "\x02" + "".join(inner) + "\x01" + self.paragraphs(count - half)
        return self.bare(f"<html><body>{''.join(before)}{first}\x01{main}{last}\x02{''.join(after)}</body></html>"), first


def labelled(rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of one made-up page; the markers become words that are looked for and taken out."""
    page, _ = _Writer(rng).page()
    found = blocks(page.replace("\x01", "<hr><div>qqon</div>").replace("\x02", "<hr><div>qqoff</div>"))
    inside, kept, labels = False, [], []
    for b in found:
        if b.text in ("qqon", "qqoff"):
            inside = b.text == "qqon"
        else:
            kept.append(b)
            labels.append(inside)
    return features(kept), np.array(labels, np.float32)


def _backward(x, lengths, w, u, kept, grad):
    """Gradients of one direction from those of its states."""
    pages, longest, _ = x.shape
    dw_gates = np.zeros((pages, longest, 4 * HIDDEN), np.float32)
    du = np.zeros_like(u)
    dh, dc = np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)
    for t in range(longest - 1, -1, -1):
        h, c, i, f, o, a, new = kept[t]
        live = (t < lengths)[:, None]
        dh_t = np.where(live, dh + grad[:, t], 0)
        tanh = np.tanh(new)
        dnew = np.where(live, dc + dh_t * o * (1 - tanh * tanh), 0)
        g = np.concatenate([dnew * a * i * (1 - i), dnew * c * f * (1 - f), dh_t * tanh * o * (1 - o), dnew * i * (1 - a * a)], axis=1)
        dw_gates[:, t] = g
        du += h.T @ g
        dh = np.where(live, g @ u.T, dh)
        dc = np.where(live, dnew * f, dc)
    flat = dw_gates.reshape(-1, 4 * HIDDEN)
    return x.reshape(-1, x.shape[2]).T @ flat, du, flat.sum(axis=0)


def train(pages: int = PAGES, epochs: int = EPOCHS, seed: int = 12) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    data = [d for d in (labelled(rng) for _ in range(pages)) if len(d[1])]
    draw = lambda *shape: (rng.standard_normal(shape) * (0.5 / np.sqrt(shape[0]))).astype(np.float32)
    p = {}
    for side in "fb":
        p[f"w{side}"], p[f"u{side}"] = draw(INPUTS, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN)
        p[f"b{side}"] = np.r_[np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)].astype(np.float32)
        p[f"o{side}"] = draw(HIDDEN)
    p["o"] = np.zeros(1, np.float32)
    first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for epoch in range(epochs):
        order = rng.permutation(len(data))
        order = order[np.argsort([len(data[i][1]) // 8 for i in order], kind="stable")]
        batches = [order[k : k + BATCH] for k in range(0, len(order), BATCH)]
        total = 0.0
        for b in rng.permutation(len(batches)):
            chosen = [data[i] for i in batches[b]]
            lengths = np.array([len(y) for _, y in chosen])
            x = np.zeros((len(chosen), lengths.max(), INPUTS), np.float32)
            y = np.zeros((len(chosen), lengths.max()), np.float32)
            for row, (fx, fy) in enumerate(chosen):
                x[row, : len(fy)], y[row, : len(fy)] = fx, fy
            mask = np.arange(lengths.max())[None, :] < lengths[:, None]
            back = turned(x, lengths)
            kf, kb = [], []
            hf = run_lstm(x, lengths, p["wf"], p["uf"], p["bf"], kf)
            raw = run_lstm(back, lengths, p["wb"], p["ub"], p["bb"], kb)
            hb = turned(raw, lengths)
            z = hf @ p["of"] + hb @ p["ob"] + p["o"]
            dz = np.where(mask, _sigmoid(z) - y, 0).astype(np.float32) / mask.sum()
            total += float(np.where(mask, np.logaddexp(0, z) - y * z, 0).sum() / mask.sum())
            g = {"of": np.einsum("pt,pth->h", dz, hf), "ob": np.einsum("pt,pth->h", dz, hb), "o": dz.sum(keepdims=True).reshape(1)}
            g["wf"], g["uf"], g["bf"] = _backward(x, lengths, p["wf"], p["uf"], kf, dz[:, :, None] * p["of"])
            g["wb"], g["ub"], g["bb"] = _backward(back, lengths, p["wb"], p["ub"], kb, turned(dz[:, :, None] * p["ob"], lengths))
            step += 1
            for k in p:
                grad = g[k] + 1e-4 * p[k]
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                rate = RATE * (1 - epoch / epochs)
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        print(f"epoch {epoch}: loss {total / len(batches):.4f}", file=sys.stderr)
    return p


def accuracy(weights: dict[str, np.ndarray], pages: int = 300, seed: int = 99) -> float:
    """Share of blocks labelled rightly on made-up pages that were not trained on."""
    rng = np.random.default_rng(seed)
    data = [labelled(rng) for _ in range(pages)]
    scores = Labeller(weights).scores([x for x, _ in data])
    return float(np.mean(np.concatenate([(s >= 0.5) == (y > 0.5) for s, (_, y) in zip(scores, data, strict=True)])))


def main() -> None:
    weights = {k: v.astype(np.float16) for k, v in train().items()}
    np.savez_compressed(WEIGHTS, **weights)
    print(f"held-out accuracy {accuracy(weights):.4f}")


if __name__ == "__main__":
    main()
