"""Main text of web pages by a recurrent block labeller.

A page is its sequence of text blocks, each described by its tag path, hashed words and plain counts.
A bidirectional LSTM in numpy reads the whole sequence and labels each block as article or not.

It is trained on pages of the table itself: blocks inside an article or main element, outside of
menus and the like, are article text. So that it does not depend on that element, each training page
is also laid out anew in many ways: other wrappers, menus, headers, sidebars, notices, adverts,
forms, comments and footers, with words of other pages.
"""

from __future__ import annotations

import io
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.common import annotate, heavy_hash, table, utf8
from basketflow.llm.html_blocks import SIZE, Block, Element, along_paths, blocks, describe
from basketflow.session import materialize

HIDDEN = 24
# Bounds of the training sample: pages that teach, first by a hash of id and page, and blocks of a
# sequence, of which the sample holds as many as pages. Longer pages teach by parts of them.
TRAIN_PAGES = 300
TRAIN_BLOCKS = 120
# Text that a page lends to the layouts, and of it one block.
LENT_CHARS = 50_000
LENT_BLOCK_CHARS = 2_000
# Words of a block that is taken for a sentence of an article where no element says so.
SENTENCE_WORDS = 8
# First draw of pages for each that is wanted, and how much wider each further draw is.
DRAW, WIDER = 2, 16
LAYOUTS = 4
PASSES = 6
BATCH = 24
SEED = 6

# Elements and words that mark article text and everything else in training pages.
ARTICLE = {"article", "main"}
OTHER = {
    "nav", "aside", "footer", "form", "header", "menu", "ad", "ads", "advert", "sidebar", "comment", "comments",
    "notice", "cookie", "banner", "share", "related", "promo", "dialog", "button",
}
WRAPPERS = [
    "article", "main", 'div class="content"', 'div id="content"', 'div class="post"', 'div class="post-content"',
    'div class="entry-content"', 'div class="article-body"', 'div class="story"', 'section class="text"',
    'div id="main"', 'div class="page-content"', 'div itemprop="articleBody"', 'article class="post"', "section", "div",
]
OUTER = ["", "", "div", 'div id="page"', 'div class="wrapper"', 'div class="container"', "main", 'div class="site"']
MENU = [
    "nav", 'div class="menu"', 'div id="nav"', 'div class="navbar"', 'ul class="menu"', 'div class="breadcrumbs"',
    'nav class="main-nav"', 'div class="navigation"', 'div role="navigation"', 'div class="toc"',
]
HEADER = ["header", 'div id="header"', 'div class="site-header"', 'div class="masthead"', 'header class="top"', 'div class="topbar"']
FOOTER = ["footer", 'div id="footer"', 'div class="footer"', 'div class="site-footer"', 'div class="copyright"', 'div class="bottom"']
SIDEBAR = ["aside", 'div class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'div class="related"', 'aside class="side"']
NOTICE = [
    'div class="notice"', 'div class="cookie-notice"', 'div id="cookie-banner"', 'div class="consent"', 'div class="alert"',
    'div class="banner"', 'div class="popup"', 'div class="newsletter"', 'div class="message"', 'div role="alert"',
]
ADVERT = [
    'div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="advertisement"', 'div class="sponsored"',
    'div class="promo"', 'div id="ad-1"', 'aside class="ad"', 'div class="sponsor"', 'section class="promotion"',
]
FORM = ["form", 'form class="search"', 'form id="login"', 'div class="subscribe"', 'form class="contact"', 'div class="search-form"']
COMMENTS = [
    'section class="comments"', 'div id="comments"', 'div class="comment-list"', 'ol class="commentlist"',
    'div class="discussion"', 'section id="comments"', 'div class="replies"', 'div class="reader-comments"',
]
SHARE = ['div class="share"', 'ul class="social"', 'div class="social-links"', 'div class="tags"', 'div class="byline"', 'div class="meta"']

# A private sign in front of article text of pages that are laid out anew.
_MARK = ""


def weak_labels(page: list[Block]) -> np.ndarray:
    """1 for blocks in an article or main element with nothing else's element or word on the path inside."""
    return np.array([state == 1 for state in along_paths(page, 0, _in_article)], np.float32)


def _in_article(state: int, element: Element) -> int:
    """0 outside of an article, 1 in it, 2 in something else inside it."""
    words = element.described.split(" ")
    if state == 0 and words[0] not in ARTICLE:
        return 0
    return 2 if state == 2 or OTHER.intersection(words) else 1


class _Layout:
    """Lays a text out as a page in a random way."""

    def __init__(self, rng: np.random.Generator, texts: list[str]):
        self.rng, self.texts = rng, texts

    def pick(self, options):
        return options[self.rng.integers(len(options))]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def words(self, low: int, high: int) -> str:
        words = self.pick(self.texts).split(" ")
        n = int(self.rng.integers(low, high + 1))
        at = int(self.rng.integers(max(1, len(words) - n + 1)))
        return escape(" ".join(words[at : at + n]))

    def wrap(self, element: str, inner: str) -> str:
        return f"<{element}>{inner}</{element.split(' ')[0]}>" if element else inner

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(self.rng.integers(low, high + 1))]
        if self.chance(0.8):
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.pick([" | ", " ", "<br>"]).join(items)

    def sentences(self, low: int, high: int) -> str:
        tag = self.pick(["p", "p", "", "div", "span"])
        return "".join(self.wrap(tag, self.words(3, 25)) for _ in range(self.rng.integers(low, high + 1)))

    def menu(self) -> str:
        return self.wrap(self.pick(MENU), self.links(2, 9))

    def header(self) -> str:
        return self.wrap(self.pick(HEADER), self.wrap(self.pick(["h1", "div", "a", "p", ""]), self.words(1, 12)))

    def footer(self) -> str:
        return self.wrap(self.pick(FOOTER), self.pick(["&copy; ", "", "2024 &middot; "]) + self.words(2, 20))

    def sidebar(self) -> str:
        inner = self.links(2, 6) if self.chance(0.6) else self.sentences(1, 4)
        return self.wrap(self.pick(SIDEBAR), (f"<h3>{self.words(1, 4)}</h3>" if self.chance(0.5) else "") + inner)

    def notice(self) -> str:
        return self.wrap(self.pick(NOTICE), self.sentences(1, 2) + ("<button>Ok</button>" if self.chance(0.4) else ""))

    def advert(self) -> str:
        return self.wrap(self.pick(ADVERT), self.sentences(1, 2))

    def form(self) -> str:
        fields = "".join(f"<label>{self.words(1, 3)}</label><input>" for _ in range(self.rng.integers(1, 4)))
        return self.wrap(self.pick(FORM), fields + f"<button>{self.words(1, 2)}</button>")

    def comments(self) -> str:
        one = self.pick(['div class="comment"', "li", 'article class="comment"', "div", "p"])
        rows = [self.wrap(one, self.sentences(1, 2)) for _ in range(self.rng.integers(1, 6))]
        return self.wrap(self.pick(COMMENTS), (f"<h3>{self.words(1, 3)}</h3>" if self.chance(0.5) else "") + "".join(rows))

    def share(self) -> str:
        return self.wrap(self.pick(SHARE), self.links(1, 4) if self.chance(0.6) else self.words(2, 8))

    def paragraph(self, text: str) -> str:
        text = escape(text)
        if self.chance(0.2):
            text = f"<{self.pick(['b', 'i', 'em', 'strong'])}>{text}"
        elif self.chance(0.1):
            words = text.split(" ")
            text = " ".join([*words[:2], f'<a href="#">{" ".join(words[2:5])}</a>', *words[5:]])
        return text

    def page(self, title: str, paragraphs: list[str]) -> str:
        body, lists = [], self.chance(0.2)
        if title and self.chance(0.9):
            body.append(self.wrap(self.pick(["h1", "h1", "h1", "h2"]), _MARK + escape(title)))
            if self.chance(0.15):
                body.append(self.share())
        tag = self.pick(["p", "p", "p", "p", "div", ""])
        for i, text in enumerate(paragraphs):
            piece = _MARK + self.paragraph(text)
            if lists and self.chance(0.3):
                body.append(self.wrap(self.pick(["ul", "ol"]), f"<li>{piece}</li>"))
            elif self.chance(0.08):
                body.append(self.wrap(self.pick(["blockquote", "h2", "h3", "pre", "td"]), piece))
            elif tag == "p" and self.chance(0.15):
                body.append(f"<p>{piece}")
            else:
                body.append(self.wrap(tag or "p", piece))
            if i + 1 < len(paragraphs) and self.chance(0.06):
                body.append(self.pick([self.advert, self.notice, self.share, self.sidebar])())
        inside = "".join(body)
        if self.chance(0.2):
            inside += self.comments()
        parts = [self.wrap(self.pick(WRAPPERS), inside)]
        for make, p in ((self.advert, 0.5), (self.notice, 0.4), (self.sidebar, 0.35), (self.form, 0.3), (self.menu, 0.8), (self.header, 0.5)):
            if self.chance(p):
                parts.insert(0, make())
        for make, p in ((self.share, 0.3), (self.comments, 0.45), (self.sidebar, 0.35), (self.advert, 0.3), (self.form, 0.25), (self.notice, 0.2)):
            if self.chance(p):
                parts.append(make())
        if self.chance(0.85):
            parts.append(self.footer())
        return f"<html><body>{self.wrap(self.pick(OUTER), ''.join(parts))}</body></html>"


@dataclass
class Lesson:
    """What a page teaches: described parts with their labels, its article's title and texts, its other texts."""

    parts: list[tuple[np.ndarray, np.ndarray]]
    title: str
    article: list[str]
    others: list[str]

    def size(self) -> int:
        return sum(len(labels) for _, labels in self.parts) or len(self.article)


def _parts(labels: np.ndarray) -> list[tuple[int, int]]:
    """A page of up to 120 blocks whole; of a longer one 60 at the start, the end and either end of the article."""
    total, half = len(labels), TRAIN_BLOCKS // 2
    if total <= TRAIN_BLOCKS:
        return [(0, total)]
    article = np.flatnonzero(labels)
    starts = sorted({min(max(0, at - half // 2), total - half) for at in (0, int(article[0]), int(article[-1]), total)})
    out: list[tuple[int, int]] = []
    for start in starts:
        if out and start <= out[-1][1] and start + half - out[-1][0] <= TRAIN_BLOCKS:
            out[-1] = (out[-1][0], start + half)
        else:
            out.append((max(start, out[-1][1] if out else 0), start + half))
    return out


def _lent(texts: list[str], room: int) -> list[str]:
    out = []
    for text in texts:
        if room <= 0:
            break
        out.append(text[: min(room, LENT_BLOCK_CHARS)])
        room -= len(out[-1])
    return out


def lesson(html: str) -> Lesson | None:
    """What a page of any length teaches, in bounded size; none without article text by its own elements."""
    page = blocks(html)
    labels = weak_labels(page)
    if not labels.any():
        return None
    described, parts = describe(page), _parts(labels)
    chosen = [i for start, stop in parts for i in range(start, stop)]
    article = [page[i] for i in chosen if labels[i]]
    head = article[0].element.name in ("h1", "h2")
    title, rest = (article[0].text[:LENT_BLOCK_CHARS], article[1:]) if head else ("", article)
    texts = _lent([b.text for b in rest[:TRAIN_BLOCKS]], LENT_CHARS)
    others = _lent([page[i].text for i in chosen if not labels[i]], LENT_CHARS)
    return Lesson([(described[a:b].copy(), labels[a:b].copy()) for a, b in parts], title, texts, others)


def plain_lesson(html: str) -> Lesson | None:
    """What a page without article elements lends to the layouts: its sentences, or any text, as an article's.

    Its own blocks have no labels and teach nothing as they stand.
    """
    page = blocks(html)
    if not page:
        return None
    told = [len(b.text.split()) >= SENTENCE_WORDS and 3 * b.linked < len(b.text) and b.text[-1] in ".!?…»”\"'" for b in page]
    if not any(told):
        told = [True] * len(page)
    article = [b.text for b, t in zip(page, told, strict=True) if t][:TRAIN_BLOCKS]
    others = [b.text for b, t in zip(page, told, strict=True) if not t][:TRAIN_BLOCKS]
    return Lesson([], "", _lent(article, LENT_CHARS), _lent(others, LENT_CHARS))


def training_set(pages: list[str], layouts: int = LAYOUTS, seed: int = SEED) -> list[tuple[np.ndarray, np.ndarray]]:
    """Described blocks and labels of the pages that teach."""
    return examples([found for p in pages if (found := lesson(p))], layouts, seed)


def examples(lessons: list[Lesson], layouts: int = LAYOUTS, seed: int = SEED) -> list[tuple[np.ndarray, np.ndarray]]:
    """Described blocks and labels: the parts of each page as they are, twice, and its article ``layouts`` times laid out anew."""
    rng, out = np.random.default_rng(seed), []
    texts = [t for one in lessons for t in (one.title, *one.article, *one.others) if t] or ["text"]
    lay = _Layout(rng, texts)
    for one in lessons:
        out += one.parts * 2
        for _ in range(layouts):
            anew = blocks(lay.page(one.title, one.article))
            made = np.array([b.text.startswith(_MARK) for b in anew], np.float32)
            for b in anew:
                b.text = b.text.replace(_MARK, "") or "-"
            out.append((describe(anew), made))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def start_weights(hidden: int = HIDDEN, seed: int = SEED) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    out = {}
    for way in "fb":
        out[f"{way}x"] = rng.standard_normal((SIZE, 4 * hidden)).astype(np.float32) / np.sqrt(SIZE)
        out[f"{way}h"] = rng.standard_normal((hidden, 4 * hidden)).astype(np.float32) / np.sqrt(hidden)
        out[f"{way}b"] = np.repeat(np.array([0, 1, 0, 0], np.float32), hidden)
    out["o"] = rng.standard_normal(2 * hidden + SIZE).astype(np.float32) / np.sqrt(2 * hidden + SIZE)
    out["c"] = np.zeros(1, np.float32)
    return out


class _Pass:
    """One direction over pages of different lengths, longest first: at each step only those go on."""

    def __init__(self, w: dict, way: str, x: np.ndarray, first: np.ndarray, lengths: np.ndarray):
        self.w, self.way, self.x = w, way, x
        steps = int(lengths.max(initial=0))
        # Rows of the blocks read at each step.
        last = first + lengths - 1
        self.rows = [
            first[lengths > t] + t if way == "f" else last[lengths > t] - t for t in range(steps)
        ]
        self.gates, self.cells = [], []

    def forward(self, keep: bool) -> np.ndarray:
        hidden = self.w[f"{self.way}h"].shape[0]
        inputs = self.x @ self.w[f"{self.way}x"] + self.w[f"{self.way}b"]
        out = np.zeros((len(self.x), hidden), np.float32)
        h = c = np.zeros((len(self.rows[0]) if self.rows else 0, hidden), np.float32)
        for rows in self.rows:
            z = inputs[rows] + h[: len(rows)] @ self.w[f"{self.way}h"]
            g = _sigmoid(z)
            g[:, 3 * hidden :] = np.tanh(z[:, 3 * hidden :])
            before = c[: len(rows)]
            c = g[:, hidden : 2 * hidden] * before + g[:, :hidden] * g[:, 3 * hidden :]
            h = g[:, 2 * hidden : 3 * hidden] * np.tanh(c)
            out[rows] = h
            if keep:
                self.gates.append(g)
                self.cells.append((before, c))
        self.out = out
        return out

    def backward(self, grad: np.ndarray) -> dict[str, np.ndarray]:
        hidden = grad.shape[1]
        dz_all = np.zeros((len(self.x), 4 * hidden), np.float32)
        dwh = np.zeros_like(self.w[f"{self.way}h"])
        dh = dc = np.zeros((0, hidden), np.float32)
        for t in range(len(self.rows) - 1, -1, -1):
            rows, g, (before, c) = self.rows[t], self.gates[t], self.cells[t]
            i, f, o, u = (g[:, k * hidden : (k + 1) * hidden] for k in range(4))
            d = grad[rows].copy()
            d[: len(dh)] += dh
            tanh = np.tanh(c)
            dcell = d * o * (1 - tanh**2)
            dcell[: len(dc)] += dc
            dz = np.concatenate(
                [dcell * u * i * (1 - i), dcell * before * f * (1 - f), d * tanh * o * (1 - o), dcell * i * (1 - u**2)], axis=1
            )
            dz_all[rows] = dz
            if t:
                dwh += self.out[self.rows[t - 1][: len(rows)]].T @ dz
            dh, dc = dz @ self.w[f"{self.way}h"].T, dcell * f
        return {f"{self.way}x": self.x.T @ dz_all, f"{self.way}h": dwh, f"{self.way}b": dz_all.sum(axis=0)}


def _joined(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of all pages, longest page first; the pages' order, first rows and lengths."""
    lengths = np.array([len(p) for p in pages], np.int64)
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    return np.concatenate([pages[i] for i in order]), order, np.cumsum(lengths) - lengths, lengths


def predict(w: dict[str, np.ndarray], pages: list[np.ndarray]) -> list[np.ndarray]:
    """The chance of each block of each page to be article text."""
    if not pages:
        return []
    x, order, first, lengths = _joined(pages)
    out = np.concatenate([_Pass(w, way, x, first, lengths).forward(False) for way in "fb"] + [x], axis=1)
    p = _sigmoid(out @ w["o"] + w["c"])
    found: list[np.ndarray] = [p[:0]] * len(pages)
    for i, a, n in zip(order, first, lengths, strict=True):
        found[i] = p[a : a + n]
    return found


def train(examples: list[tuple[np.ndarray, np.ndarray]], passes: int = PASSES, seed: int = SEED) -> dict[str, np.ndarray]:
    """Weights learned by Adam over batches of pages in a random order."""
    w = start_weights(seed=seed)
    rng, step = np.random.default_rng(seed), 0
    mean, square = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    total = max(1, passes * -(-len(examples) // BATCH))
    for _ in range(passes):
        order = rng.permutation(len(examples))
        for at in range(0, len(order), BATCH):
            chosen = [examples[i] for i in order[at : at + BATCH]]
            x, sort, first, lengths = _joined([e[0] for e in chosen])
            y = np.concatenate([chosen[i][1] for i in sort])
            ways = [_Pass(w, way, x, first, lengths) for way in "fb"]
            out = np.concatenate([way.forward(True) for way in ways] + [x], axis=1)
            d = ((_sigmoid(out @ w["o"] + w["c"]) - y) / len(y)).astype(np.float32)
            grad = {"o": out.T @ d, "c": d.sum(keepdims=True)}
            hidden = d[:, None] * w["o"][: 2 * HIDDEN]
            grad |= ways[0].backward(hidden[:, :HIDDEN]) | ways[1].backward(hidden[:, HIDDEN:])
            step += 1
            rate = 0.01 * (1 - 0.9 * step / total)
            for k in w:
                mean[k] = 0.9 * mean[k] + 0.1 * grad[k]
                square[k] = 0.999 * square[k] + 0.001 * grad[k] ** 2
                w[k] = w[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return {k: v.astype(np.float32) for k, v in w.items()}


def extract(pages: list[str], w: dict[str, np.ndarray]) -> list[str]:
    """Article text of each page: its article blocks in order, two line breaks between them."""
    cut = [blocks(p) for p in pages]
    chances = predict(w, [describe(b) for b in cut])
    return ["\n\n".join(b.text for b, p in zip(page, chance, strict=True) if p >= 0.5) for page, chance in zip(cut, chances, strict=True)]


def _lessons(teach: Callable[[str], Lesson | None]) -> Callable:
    """What each page that teaches anything teaches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for mark, body in zip(batch.column("mark").to_pylist(), batch.column("body"), strict=True):
                found = teach(body.as_py().decode("utf-8", "replace"))
                if found:
                    stored = pa.array([pickle.dumps(found)], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([mark], pa.int64()), stored], ["mark", "lesson"])

    return run


def _train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lessons, size, room = [], 0, TRAIN_PAGES * TRAIN_BLOCKS
    for batch in batches:
        for stored in batch.column("lesson").to_pylist():
            if size < room:
                lessons.append(pickle.loads(stored))
                size += lessons[-1].size()
    if lessons:
        # Few pages are gone over more often, with other layouts each time.
        times = max(1, min(TRAIN_PAGES // len(lessons), room // size))
        stored = io.BytesIO()
        np.savez(stored, **train(examples(lessons * times)))
        yield pa.RecordBatch.from_arrays([pa.array([stored.getvalue()], pa.binary())], ["weights"])


def _sample(marked: DataFrame, rows: int, teach: Callable[[str], Lesson | None]) -> DataFrame:
    """What the first ``rows`` pages that teach, by their mark, teach.

    Pages are drawn by their mark, too, and more of them, in the end all, until enough of them teach.
    """
    share = DRAW * rows / max(1, marked.count())
    while True:
        drawn = marked.filter(F.col("mark") < share * float(1 << 62)) if share < 1 else marked
        taught = drawn.mapInArrow(_lessons(teach), "mark long, lesson binary")
        found = materialize(taught.orderBy("mark").limit(rows), "lessons")
        if share >= 1 or found.count() >= rows:
            return found
        share *= WIDER


def fit(pages: DataFrame, page_id: str = "page_id", html: str = "html", rows: int = TRAIN_PAGES) -> dict[str, np.ndarray]:
    """Weights learned in one task from the first ``rows`` pages by a hash whose article is told by their elements.

    All pages, of any length, are in the draw; long ones teach by parts of bounded size. If no page
    of the table has text in an article or main element, it learns from new layouts of the table's
    own sentences alone. If no page has any text, the weights are those of the start, with which
    there is nothing to label.
    """
    marked = pages.select(utf8(html).alias("body"), heavy_hash(F.col(page_id).cast("string"), F.col(html)).alias("mark"))
    marked = marked.filter(F.octet_length("body") > 0)
    for teach in (lesson, plain_lesson):
        sample = _sample(marked, rows, teach).repartition(1).sortWithinPartitions("mark")
        learned = sample.mapInArrow(_train_task, "weights binary").first()
        if learned is not None:
            break
    else:
        return start_weights()
    with np.load(io.BytesIO(bytes(learned["weights"]))) as stored:
        return {k: stored[k] for k in stored.files}


def main_text(
    pages: DataFrame, weights: dict[str, np.ndarray], html: str = "html", keep: list[str] | None = None
) -> DataFrame:
    """``doc`` (the columns of a row, or those in ``keep``) and ``text``, the main text of the whole page.

    A missing or empty page, and one without article text, has an empty text.
    """
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def make():
        return lambda texts: [extract([t.decode("utf-8", "replace") for t in texts], shared.value)]

    return annotate(pages, html, "text string", make, keep)


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = main_text(pages, fit(pages), keep=["page_id", "url"])
    return found.select("doc.page_id", "doc.url", "text", F.char_length("text").cast("long").alias("n_chars"))
