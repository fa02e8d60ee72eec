"""Operator 6, HTML extraction: a bidirectional LSTM labels every text block of a page.

A page becomes its sequence of leaf blocks, each with hashed vectors of its tag path and its words. The
network (numpy) reads the whole sequence in both directions, so a block is judged in the context of the
document. It is trained here on generated pages of many layouts and, by their own semantic tags, on a
bounded sample of the given pages.
"""

from __future__ import annotations

import html as html_lib
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 200       # given pages that join the training, by hash of the id (a bound of the fit only)
MADE_PAGES = 3000        # generated training pages
TAGS, WORDS, NUMBERS = 256, 32, 6
INPUT = TAGS + WORDS + NUMBERS
HIDDEN = 32
EPOCHS, BATCH, RATE = 8, 32, 0.01
BATCH_BLOCKS = 20000     # padded blocks of one batch; longer pages make smaller batches

# tags that never carry text, tags that hold raw text, tags inside a line of text (fixed by HTML)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template svg iframe".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr br img "
                   "math merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup "
                   "msup mtable mtd mtext mtr munder munderover semantics".split())
# an opening tag of the right side ends an open tag of the left side
ENDED_BY = {"p": frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
            "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"]),
            "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "head": frozenset(["body"])}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_OPEN_VALUE = re.compile(r"=\s*[^\s\"'>]+\Z")  # a slash at its end belongs to the value
_SPACE = re.compile(r"\s+")


class Block:
    """A run of text between block tags: its path (tag and names per level), text and linked characters."""

    __slots__ = ("path", "parts", "linked")

    def __init__(self, path: tuple):
        self.path, self.parts, self.linked = path, [], 0

    @property
    def text(self) -> str:
        return _SPACE.sub(" ", html_lib.unescape("".join(self.parts))).strip()


def _names(attrs: str) -> tuple[str, ...]:
    found = " ".join(next(filter(None, m), "") for m in _NAMES.findall(attrs)) if "=" in attrs else ""
    return tuple(t for t in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", found).lower()) if t)


def blocks(page: str) -> list[tuple[tuple, str, float]]:
    """(path, text, share of linked characters) of a page's non-empty leaf blocks in page order.

    Scripts, styles, other raw elements, comments and declarations are no text. Inline tags stay inside a
    block; every other tag, opening or closing, ends it.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple]] = []
    cur: Block | None = None
    at, end = 0, len(page)
    while at < end:
        m = _MARKUP.search(page, at)
        stop = m.start() if m else end
        if stop > at:
            if cur is None:
                cur = Block(tuple(x for x in stack if x[0] not in INLINE))
                out.append(cur)
            cur.parts.append(page[at:stop])
            if any(x[0] == "a" for x in stack):
                cur.linked += stop - at
        if not m:
            break
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if tag not in INLINE:
                cur = None
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if tag in INLINE and stack[k][0] not in INLINE:
                    break  # an inline end does not reach beyond its block
            continue
        if tag == "br" and cur is not None:
            cur.parts.append(" ")
        if tag not in INLINE:
            cur = None
            for k in range(len(stack) - 1, -1, -1):
                name = stack[k][0]
                if tag in ENDED_BY.get(name, ()):
                    del stack[k:]
                    break
                if name not in INLINE and name not in ENDED_BY:
                    break
        if tag in RAW and m.group(3).endswith("/") and not _OPEN_VALUE.search(m.group(3)):
            continue
        if tag in RAW:
            close = re.compile(rf"</{re.escape(tag)}\s*>?", re.I).search(page, at)
            at = close.end() if close else end
        elif tag not in VOID and not m.group(3).rstrip().endswith("/"):
            stack.append((tag, _names(m.group(3))))
    done = [(b.path, b.text, b.linked / max(1, sum(map(len, b.parts)))) for b in out]
    return [b for b in done if b[1]]


def _slot(kind: str, name: str, size: int) -> int:
    return zlib.crc32(f"{kind}:{name}".encode()) % size


def features(seq: list[tuple[tuple, str, float]]) -> np.ndarray:
    """(blocks, INPUT): hashed tags and names of the path, hashed words, a few numbers."""
    x = np.zeros((len(seq), INPUT), dtype=np.float32)
    memo: dict = {}
    for i, (path, text, linked) in enumerate(seq):
        if path not in memo:
            v = np.zeros(TAGS, dtype=np.float32)
            for depth, (tag, names) in enumerate(reversed(path)):
                v[_slot("t", tag, TAGS)] += 1.0 if depth < 2 else 0.7
                for n in names:
                    v[_slot("n", n, TAGS)] += 1.0
            memo[path] = np.minimum(v, 2.0)
        x[i, :TAGS] = memo[path]
        words = text.split()
        for w in words:
            x[i, TAGS + _slot("w", w.lower(), WORDS)] += 1 / len(words)
        x[i, -NUMBERS:] = (min(1.5, np.log1p(len(words)) / 4), linked, text[-1] in ".!?", i / len(seq), 1 - (i + 1) / len(seq), len(words) < 4)
    return x


class BiLstm:
    """One bidirectional LSTM layer and a logistic output per block, forward and backward pass in numpy."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        self.p: dict[str, np.ndarray] = {"out": r.normal(0, 0.2, 2 * HIDDEN + 1).astype(np.float32)}
        for d in "fb":
            self.p["w" + d] = r.normal(0, 0.15, (INPUT + HIDDEN + 1, 4 * HIDDEN)).astype(np.float32)
            self.p["w" + d][-1, HIDDEN:2 * HIDDEN] = 1.0  # forget gates start open

    @staticmethod
    def _sigmoid(z: np.ndarray) -> np.ndarray:
        return 0.5 * (np.tanh(0.5 * z) + 1)

    def _run(self, x: np.ndarray, live: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """Hidden states (pages, blocks, HIDDEN) of one direction; padding leaves the state as it is."""
        n, t, _ = x.shape
        w = self.p["w" + d]
        h, c = np.zeros((n, HIDDEN), np.float32), np.zeros((n, HIDDEN), np.float32)
        pre = x @ w[:INPUT] + w[-1]
        hs = np.zeros((n, t, HIDDEN), np.float32)
        for k in range(t) if d == "f" else range(t - 1, -1, -1):
            z = pre[:, k] + h @ w[INPUT:-1]
            g = self._sigmoid(z)
            i, f, o, u = g[:, :HIDDEN], g[:, HIDDEN:2 * HIDDEN], g[:, 2 * HIDDEN:3 * HIDDEN], np.tanh(z[:, 3 * HIDDEN:])
            m = live[:, k, None]
            c2 = f * c + i * u
            tc = np.tanh(c2)
            if keep is not None:
                keep.append((k, h, c, i, f, o, u, tc, m))
            c = np.where(m, c2, c)
            h = np.where(m, o * tc, h)
            hs[:, k] = h
        return hs

    def scores(self, x: np.ndarray, live: np.ndarray) -> np.ndarray:
        hs = np.concatenate([self._run(x, live, "f"), self._run(x, live, "b")], axis=2)
        return hs @ self.p["out"][:-1] + self.p["out"][-1]

    def gradients(self, x: np.ndarray, live: np.ndarray, y: np.ndarray, known: np.ndarray) -> dict[str, np.ndarray]:
        tapes: dict[str, list] = {"f": [], "b": []}
        hs = np.concatenate([self._run(x, live, d, tapes[d]) for d in "fb"], axis=2)
        err = (self._sigmoid(hs @ self.p["out"][:-1] + self.p["out"][-1]) - y) * known / max(1.0, known.sum())
        g = {"out": np.append(np.einsum("ntk,nt->k", hs, err), err.sum()).astype(np.float32)}
        for j, d in enumerate("fb"):
            w = self.p["w" + d]
            gw = np.zeros_like(w)
            dout = err[:, :, None] * self.p["out"][j * HIDDEN:(j + 1) * HIDDEN]
            dh, dc = np.zeros((len(x), HIDDEN), np.float32), np.zeros((len(x), HIDDEN), np.float32)
            for k, h, c, i, f, o, u, tc, m in reversed(tapes[d]):
                dh = dh + dout[:, k]
                dcc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate([dcc * u * i * (1 - i), dcc * c * f * (1 - f), dh * tc * o * (1 - o), dcc * i * (1 - u * u)], axis=1) * m
                gw[:INPUT] += x[:, k].T @ dz
                gw[INPUT:-1] += h.T @ dz
                gw[-1] += dz.sum(axis=0)
                dh = np.where(m, dz @ w[INPUT:-1].T, dh)
                dc = np.where(m, dcc * f, dc)
            g["w" + d] = gw
        return g

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> "BiLstm":
        """Adam over pages of (features, labels); a label of -1 is unknown and has no loss."""
        m1 = {k: np.zeros_like(v) for k, v in self.p.items()}
        m2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, r = 0, random.Random(5)
        for _ in range(epochs):
            order = sorted(range(len(pages)), key=lambda i: (len(pages[i][1]), r.random()))
            batches: list[list[int]] = []
            for i in order:
                if batches and len(batches[-1]) < BATCH and (len(batches[-1]) + 1) * len(pages[i][1]) <= BATCH_BLOCKS:
                    batches[-1].append(i)
                else:
                    batches.append([i])
            r.shuffle(batches)
            for batch in batches:
                x, live = pad([pages[i][0] for i in batch])
                y = np.full(live.shape, -1.0, np.float32)
                for j, i in enumerate(batch):
                    y[j, :len(pages[i][1])] = pages[i][1]
                step += 1
                for k, g in self.gradients(x, live, np.maximum(y, 0), (y >= 0).astype(np.float32)).items():
                    g = np.clip(g, -1, 1)
                    m1[k] = 0.9 * m1[k] + 0.1 * g
                    m2[k] = 0.999 * m2[k] + 0.001 * g * g
                    self.p[k] -= (RATE * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        return self


def pad(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(s) for s in seqs])
    x = np.zeros((len(seqs), int(n.max(initial=0)), INPUT), np.float32)
    for i, s in enumerate(seqs):
        x[i, :len(s)] = s
    return x, np.arange(x.shape[1])[None, :] < n[:, None]


# Names that layouts give to their parts; the generator draws from them.
_BODY = "article main content post entry story text body page prose article-body post-content entry-content story-body main-content".split()
_PARTS = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav pagination toc tabs".split(),
    "header": "header masthead topbar site-header banner logo brand".split(),
    "footer": "footer site-footer copyright bottom legal colophon credits".split(),
    "aside": "sidebar aside related widget rail recommended popular trending more tags".split(),
    "notice": "cookie consent notice alert gdpr popup modal overlay cookie-banner privacy message paywall".split(),
    "ad": "ad ads advert advertisement sponsored promo sponsor banner-ad ad-slot adsense".split(),
    "form": "form search newsletter subscribe login signup search-form contact comment-form".split(),
    "comments": "comments comment reply replies discussion comment-list responses reader-comments respond".split(),
    "share": "share social social-share sharing follow buttons".split(),
}
_TAG_OF = {"nav": ["nav", "div", "ul"], "header": ["header", "div"], "footer": ["footer", "div"], "aside": ["aside", "div", "section"],
           "notice": ["div", "section", "aside", "p"], "ad": ["div", "aside", "ins", "section"], "form": ["form", "form", "div"],
           "comments": ["section", "div", "ol", "ul"], "share": ["div", "ul"]}


def made_page(r: random.Random) -> tuple[str, set[str]]:
    """A page of a random layout and the texts of its article blocks (every block's text is unique)."""
    serial = iter(range(10 ** 6))
    truth: set[str] = set()

    def words(n: int, good: bool = False) -> str:
        w = ["".join(r.choice("aeioubcdfghlmnprst") for _ in range(r.randint(2, 9))) for _ in range(n)]
        text = f"{' '.join(w).capitalize()} x{next(serial)}" + r.choice([".", ".", "!", "", "?"])
        if good:
            truth.add(text)
        return text

    def attr(name: str) -> str:
        if r.random() < 0.12:
            return ""
        extra = r.choice(["", "", " clearfix", " col", " wrap"])
        return f' {r.choice(["class", "class", "id", "role"])}="{name}{extra}"'

    def part(kind: str) -> str:
        tag = r.choice(_TAG_OF[kind])
        named = attr(r.choice(_PARTS[kind])) if tag in ("div", "section", "p", "ins", "ul", "ol") or r.random() < 0.4 else ""
        if tag in ("div", "section", "p", "ins", "ul", "ol") and not named:
            named = f' class="{r.choice(_PARTS[kind])}"'
        if kind in ("nav", "share"):
            items = "".join(f'<li><a href="/{i}">{words(r.randint(1, 3))}</a></li>' for i in range(r.randint(2, 7)))
            inner = items if tag in ("ul", "ol") else f"<ul>{items}</ul>"
        elif kind == "form":
            inner = f"<label>{words(2)}</label><input name=q><p>{words(r.randint(2, 12))}</p><button>{words(1)}</button>"
        elif kind == "comments":
            item = "li" if tag in ("ul", "ol") else "div"
            inner = f"<h3>{words(2)}</h3>" + "".join(f'<{item}{attr("comment")}><p>{words(r.randint(3, 50))}</p></{item}>' for _ in range(r.randint(1, 5)))
        elif kind == "aside":
            inner = f"<h4>{words(2)}</h4>" + "".join(f'<p><a href="#">{words(r.randint(2, 9))}</a></p>' if r.random() < 0.6 else f"<p>{words(r.randint(4, 30))}</p>" for _ in range(r.randint(1, 4)))
        elif kind == "header":
            inner = r.choice([f"<h1>{words(2)}</h1>", f'<a href="/">{words(2)}</a>']) + f"<p>{words(r.randint(2, 8))}</p>"
        else:
            inner = r.choice([f"<p>{words(r.randint(2, 40))}</p>", words(r.randint(2, 25))])
        return f"<{tag}{named}>{inner}</{tag}>"

    def article() -> str:
        rows = [f"<{t}>{words(r.randint(2, 10), True)}</{t}>" for t in [r.choice(["h1", "h2"])] if r.random() < 0.85]
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 12, 20])):
            kind, n = r.random(), r.choice([1, 2, 4, 8, 20, 60, 120])
            if kind < 0.75:
                rows.append(r.choice(["<p>{}</p>", "<p>{}</p>", "<p><b>{}<br>", "<div>{}</div>"]).format(words(n, True)))
            elif kind < 0.85:
                rows.append(f'<{(t := r.choice(["h2", "h3", "blockquote", "pre", "figcaption"]))}>{words(min(n, 30), True)}</{t}>')
            elif kind < 0.95:
                rows.append("<ul>" + "".join(f"<li>{words(r.randint(1, 20), True)}</li>" for _ in range(r.randint(1, 4))) + "</ul>")
            else:
                rows.append(f"<table><tr><td>{words(3, True)}</td><td>{words(2, True)}</td></tr></table>")
            if r.random() < 0.06:
                rows.append(part(r.choice(["ad", "share", "aside", "form", "notice"])))
        body = "".join(rows)
        tag = r.choice(["article", "article", "main", "div", "section"])
        named = attr(r.choice(_BODY)) if tag in ("article", "main") else f' class="{r.choice(_BODY)}"'
        body = f"<{tag}{named}>{body}</{tag}>"
        return f"<main>{body}</main>" if r.random() < 0.25 and tag != "main" else body

    before = [k for k in ("notice", "header", "nav", "ad", "form", "share") if r.random() < 0.45]
    after = [k for k in ("share", "aside", "comments", "form", "ad", "nav", "footer", "notice") if r.random() < 0.45]
    r.shuffle(before)
    r.shuffle(after)
    page = "".join(map(part, before)) + article() + "".join(map(part, after))
    if r.random() < 0.3:
        page = f'<div class="{r.choice(["wrapper", "container", "page", "site", "row"])}">{page}</div>'
    return f"<!DOCTYPE html><html><head><title>{words(5)}</title></head><body>{page}</body></html>", truth


_GOOD, _BAD = frozenset(["article", "main"]), frozenset("nav header footer aside form title dialog".split())
_BAD_NAMES = frozenset(n for k in _PARTS for n in _PARTS[k] if "-" not in n) - frozenset("more message tags text body popular bottom banner top".split())


def own_labels(seq: list[tuple[tuple, str, float]]) -> np.ndarray:
    """Labels that a page's semantic tags and part names give: 1 in article or main, 0 in named parts, -1 unknown."""
    out = np.full(len(seq), -1.0, np.float32)
    for i, (path, _, _) in enumerate(seq):
        tags, names = {t for t, _ in path}, {n for _, ns in path for n in ns}
        out[i] = 0 if tags & _BAD or names & _BAD_NAMES else 1 if tags & _GOOD else -1
    return out


def train(pages: DataFrame | None = None, id_col: str = "page_id", html_col: str = "html", made: int = MADE_PAGES) -> BiLstm:
    """The labeller, from generated pages and at most SAMPLE_PAGES of the given ones."""
    data = []
    r = random.Random(3)
    for _ in range(made):
        page, truth = made_page(r)
        seq = blocks(page)
        data.append((features(seq), np.array([t in truth for _, t, _ in seq], np.float32)))
    if pages is not None:
        pick = pages.where(F.col(html_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))

        def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                seqs = [blocks(h) for h in b["html"]]
                yield pd.DataFrame({"x": [zlib.compress(features(s).tobytes(), 1) for s in seqs], "y": [own_labels(s).tobytes() for s in seqs]})

        keys = pick.select(F.xxhash64("id").alias("o"), "id").orderBy("o", "id").limit(SAMPLE_PAGES).select("id").distinct()
        got = pick.join(F.broadcast(keys), "id").mapInPandas(parse, "x binary, y binary").orderBy("y", "x").limit(SAMPLE_PAGES).collect()
        for row in got:
            y = np.frombuffer(row["y"], np.float32)
            if len(y):
                data.append((np.frombuffer(zlib.decompress(row["x"]), np.float32).reshape(-1, INPUT), y))
    return BiLstm().fit(data)


def label(model: BiLstm, seqs: list[list[tuple[tuple, str, float]]]) -> list[np.ndarray]:
    """True for the content blocks of every page; pages of like length run together."""
    out: list = [np.zeros(0, bool)] * len(seqs)
    order = sorted((i for i in range(len(seqs)) if seqs[i]), key=lambda i: len(seqs[i]))
    at = 0
    while at < len(order):
        part = [order[at]]
        while at + len(part) < len(order) and len(part) < 64 and (len(part) + 1) * len(seqs[order[at + len(part)]]) <= 20000:
            part.append(order[at + len(part)])
        x, live = pad([features(seqs[i]) for i in part])
        s = model.scores(x, live)
        for j, i in enumerate(part):
            out[i] = s[j, :len(seqs[i])] > 0
        at += len(part)
    return out


def extract(df: DataFrame, model: BiLstm, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text (content blocks joined by one space), n_chars, n_blocks, n_content per page.

    Null, empty and blank html give an empty text; markup without an end is read as far as it goes; null
    ids and repeated rows are extracted row by row; an empty table gives an empty result; extra columns
    play no part.
    """
    kind = dict(df.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 256):
                part = b.iloc[at:at + 256]
                seqs = [blocks(h or "") for h in part["html"]]
                good = label(model, seqs)
                text = [" ".join(t for (_, t, _), g in zip(s, y) if g) for s, y in zip(seqs, good)]
                yield pd.DataFrame({"k": part["k"], "url": part["url"], "text": text, "n_chars": list(map(len, text)),
                                    "n_blocks": list(map(len, seqs)), "n_content": [int(y.sum()) for y in good]})

    rows = df.select(F.col(id_col).cast("string").alias("k"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    rows = rows.mapInPandas(run, "k string, url string, text string, n_chars long, n_blocks long, n_content long")
    return rows.select(F.col("k").cast(kind).alias(id_col), F.col("url").alias(url_col), "text", "n_chars", "n_blocks", "n_content")
