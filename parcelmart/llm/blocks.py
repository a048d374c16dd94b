"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks: stretches of text not broken by a block-level tag. A block is seen as
hashed counts of its tag path (tags, class and id words) and of its words, with its length, share of link text and
place. A bidirectional LSTM in numpy reads the sequence both ways and labels every block, so that a block is judged by
the whole page. Blocks labelled as article text are joined in page order.

Labels for fitting come from pages that mark their article (``article`` or ``main``). Since sites mark it in many ways,
every sampled page is also shown with its containers renamed, with parts of other kinds (side bars, notices, forms,
reader comments) put around and into the article, and filled with words of other pages. Fitting is one task over
``sample_pages`` pages with such tags; labelling is a Pandas UDF over all pages, whole texts.

Defined results: null and empty pages, and pages whose every block is rejected, give an empty text; text outside any
tag is a block of its own; unclosed tags end with the page; if no page marks its article, path rules alone decide
(``article`` or ``main``); repeated rows get equal results. Only ``page_id``, ``url``, ``html`` are read.
"""

from __future__ import annotations

import html as entities
import pickle
import random
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES, VARIANTS, EPOCHS, SEED = 200, 5, 7, 11
PATH_BUCKETS, WORD_BUCKETS, NUMBERS = 512, 128, 4
INPUTS = PATH_BUCKETS + WORD_BUCKETS + NUMBERS
EMBED, HIDDEN = 24, 16

# HTML's elements that break no text, that hold none, that are never shown, and that end their like.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TEXT = frozenset("script style noscript template title textarea select svg iframe object head".split())
ENDS = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
#: A block-level start tag ends an open paragraph.
SCOPES = frozenset("ul ol table div section article main body td th blockquote dl form nav aside".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""", re.S)
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PART = re.compile(r"[A-Za-z]+")


class Block(NamedTuple):
    path: tuple[str, ...]  # tag, or tag.word.word with the words of class, id and role, from the root
    text: str
    linked: float  # share of characters inside links


def _element(tag: str, attributes: str) -> str:
    words = [w.lower() for m in NAMES.finditer(attributes) for w in PART.findall(m[1] or m[2] or m[3] or "")]
    return ".".join([tag, *words])


def leaf_blocks(page: str | None) -> list[Block]:
    """The blocks of a page that hold text, in order."""
    blocks, stack, parts, linked, links, at = [], [], [], 0, 0, 0
    page = page or ""

    def close() -> None:
        nonlocal parts, linked
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            blocks.append(Block(tuple(stack), text, min(1.0, linked / len(text))))
        parts, linked = [], 0

    def add(raw: str) -> None:
        nonlocal linked
        parts.append(raw)
        linked += len(raw) if links else 0

    while tag := TAG.search(page, at):
        if tag.start() > at:
            add(page[at : tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name, ends = tag[2].lower(), bool(tag[1])
        if name in HIDDEN_TEXT:
            if not ends and name != "head":
                close()
                end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if name in INLINE:
            if name == "a":
                links = max(0, links + (-1 if ends else 1))
            continue
        if name == "br":
            parts.append(" ")
            continue
        close()
        if name in VOID:
            continue
        names = [x.partition(".")[0] for x in stack]
        if ends:
            if name in names:
                del stack[len(names) - 1 - names[::-1].index(name) :]
            continue
        closes = ENDS.get(name, {"p"})
        for depth in range(len(names) - 1, -1, -1):
            if names[depth] in closes:
                del stack[depth:]
            elif names[depth] in SCOPES:
                break
        stack.append(_element(name, tag[3]))
    add(page[at:])
    close()
    return blocks


def marked_label(path: tuple[str, ...]) -> bool:
    """What the page's own marks say: inside ``article`` or ``main`` and in no part of another kind there."""
    names = [x.partition(".")[0] for x in path]
    inside = max((names.index(x) for x in ("article", "main") if x in names), default=None)
    return inside is not None and not {"nav", "aside", "footer", "form"} & set(names)


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = found = zlib.crc32(word.encode("utf-8", "replace")) % WORD_BUCKETS
        return found


_WORDS = _Buckets()


@lru_cache(maxsize=20_000)
def _path_buckets(path: tuple[str, ...]) -> list[int]:
    keys = []
    for depth, element in enumerate(path):
        tag, *words = element.split(".")
        keys += ["t" + tag, *("c" + w for w in words)]
        if depth == len(path) - 1:
            keys.append("l" + tag)
    return [zlib.crc32(k.encode()) % PATH_BUCKETS for k in keys]


def features(blocks: list[Block]) -> np.ndarray:
    """One row per block: path counts, word shares, length, link share, place from both ends."""
    out = np.zeros((len(blocks), INPUTS), np.float32)
    for i, block in enumerate(blocks):
        out[i, _path_buckets(block.path)] = 1
        words = block.text.lower().split()
        counts = np.bincount([_WORDS[w] for w in words], minlength=WORD_BUCKETS)
        out[i, PATH_BUCKETS : PATH_BUCKETS + WORD_BUCKETS] = counts / len(words)
        out[i, -NUMBERS:] = np.log1p(len(words)) / 5, block.linked, 1 / (1 + i), 1 / (len(blocks) - i)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def new_weights() -> dict[str, np.ndarray]:
    rng = np.random.default_rng(SEED)
    draw = lambda *s: (rng.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
    weights = {"embed": (draw(INPUTS, EMBED) * 5).astype(np.float32), "out": draw(2 * HIDDEN, 1), "bias": np.zeros(1, np.float32)}
    for side in ("f", "b"):
        weights |= {f"x{side}": draw(EMBED, 4 * HIDDEN), f"h{side}": draw(HIDDEN, 4 * HIDDEN), f"c{side}": np.zeros(4 * HIDDEN, np.float32)}
        weights[f"c{side}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
    return weights


def _read(x: np.ndarray, weights: dict, side: str) -> tuple[np.ndarray, list]:
    """Hidden states of one direction over (step, page, feature), and what the way back needs."""
    wh, h, c, states, kept = weights["h" + side], *(np.zeros((x.shape[1], HIDDEN), np.float32) for _ in range(2)), [], []
    gates = x @ weights["x" + side] + weights["c" + side]
    for t in range(len(x)):
        z = gates[t] + h @ wh
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in (0, 1, 2))
        g = np.tanh(z[:, 3 * HIDDEN :])
        before, held = c, h
        c = f * c + i * g
        h = o * np.tanh(c)
        states.append(h)
        kept.append((held, before, c, i, f, o, g))
    return np.stack(states), kept


def _back(dstates: np.ndarray, x: np.ndarray, kept: list, weights: dict, side: str, grads: dict) -> np.ndarray:
    """Gradients of one direction by back-propagation through time; returns those of ``x``."""
    dh, dc, dgates = np.zeros_like(dstates[0]), np.zeros_like(dstates[0]), []
    for t in range(len(x) - 1, -1, -1):
        held, before, c, i, f, o, g = kept[t]
        dh = dh + dstates[t]
        tc = np.tanh(c)
        dc = dc + dh * o * (1 - tc**2)
        z = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g**2)], 1)
        grads["h" + side] += held.T @ z
        dgates.append(z)
        dh, dc = z @ weights["h" + side].T, dc * f
    dgates = np.stack(dgates[::-1])
    grads["x" + side] += np.einsum("tbe,tbg->eg", x, dgates, optimize=True)
    grads["c" + side] += dgates.sum(axis=(0, 1))
    return dgates @ weights["x" + side].T


def _laid_out(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pages side by side (step, page): row numbers forwards and backwards (the last row is padding), and the mask."""
    lengths = np.array([len(p) for p in pages])
    steps = np.arange(lengths.max(initial=0))[:, None]
    first, mask = np.cumsum(lengths) - lengths, steps < lengths
    pad = lengths.sum()
    return np.where(mask, first + steps, pad), np.where(mask, first + lengths - 1 - steps, pad), mask


def scores(pages: list[np.ndarray], weights: dict, truth: list[np.ndarray] | None = None, grads: dict | None = None) -> np.ndarray:
    """Probability of article text for the blocks of all pages, end to end; with ``truth`` adds to ``grads``."""
    flat = np.concatenate([*pages, np.zeros((1, INPUTS), np.float32)])
    embedded = flat @ weights["embed"]
    shown = np.tanh(embedded)
    ahead, behind, mask = _laid_out(pages)
    states = np.zeros((len(flat), 2 * HIDDEN), np.float32)
    kept = {}
    for side, rows, part in (("f", ahead, slice(0, HIDDEN)), ("b", behind, slice(HIDDEN, None))):
        found, kept[side] = _read(shown[rows], weights, side)
        states[rows[mask], part] = found[mask]
    p = _sigmoid(states[:-1] @ weights["out"] + weights["bias"])[:, 0]
    if truth is not None:
        off = ((p - np.concatenate(truth)) / len(p)).astype(np.float32)[:, None]
        grads["out"] += states[:-1].T @ off
        grads["bias"] += off.sum(axis=0)
        dstates, dshown = np.concatenate([off @ weights["out"].T, np.zeros((1, 2 * HIDDEN), np.float32)]), np.zeros_like(shown)
        for side, rows, part in (("f", ahead, slice(0, HIDDEN)), ("b", behind, slice(HIDDEN, None))):
            d = _back(dstates[rows][:, :, part], shown[rows], kept[side], weights, side, grads)
            dshown[rows[mask]] += d[mask]
        grads["embed"] += flat.T @ (dshown * (1 - shown**2))
    return p


# How sites name the article and the parts around it, as path elements.
ARTICLE_NAMES = ["article", "main", "div.content", "div.main", "div.post", "div.entry.content", "section.article.body", "div.story",
                 "div.text", "div.post.body", "div.article", "div.main.content", "section.content", "div.page.content"]
PART_NAMES = {
    "menu": ["nav", "div.menu", "ul.nav", "div.nav", "div.navbar", "nav.breadcrumb", "div.breadcrumbs", "nav.menu", "div.toc"],
    "header": ["header", "div.header", "header.site.header", "div.top", "div.masthead", "div.logo", "header.banner"],
    "footer": ["footer", "div.footer", "footer.site.footer", "div.copyright", "div.legal", "div.imprint"],
    "side": ["aside", "div.sidebar", "aside.sidebar", "div.related", "section.related", "div.widget", "div.recommended", "div.more"],
    "advert": ["div.ad", "div.ads", "div.advert", "div.sponsored", "div.banner", "div.promo", "aside.ad", "div.adsbox", "section.sponsor"],
    "notice": ["div.cookie", "div.notice", "div.cookie.banner", "div.consent", "div.alert", "div.popup", "div.newsletter", "div.modal"],
    "form": ["form", "div.form", "form.search", "div.search", "form.subscribe", "div.login", "form.login"],
    "comment": ["div.comments", "section.comments", "div.comment", "ul.comments", "ol.commentlist", "div.discussion", "div.replies",
                "aside.comments", "section.responses"],
    "share": ["div.share", "ul.social", "div.tags", "div.author", "div.meta", "div.byline"],
}
INSIDE = [["p"], ["p"], ["p"], ["h2"], ["h3"], ["ul", "li"], ["ol", "li"], ["blockquote", "p"], ["pre"], ["table", "tr", "td"], ["div"], [], ["section", "p"], ["figure", "figcaption"]]
PART_INSIDE = [["p"], ["ul", "li"], ["div"], [], ["h3"], ["div", "p"], ["li"], ["h4"], ["div.item", "p"]]


def variant(article: list[Block], spare: list[str], rng: random.Random) -> tuple[list[Block], np.ndarray]:
    """A page with this article under other names, and with parts of all kinds filled with ``spare`` texts."""
    root = rng.choice([(), ("html", "body"), ("html", "body"), ("html", "body", "div"), ("html", "body", "div.wrapper"), ("html", "body", "div.container")])
    own = (*root, *rng.choice([(), (), ("div",), ("main",), ("div.page",)]), rng.choice(ARTICLE_NAMES))
    own = root if rng.random() < 0.08 else own  # text right under the body

    def part(kind: str, under: tuple[str, ...]) -> list[tuple[Block, int]]:
        name, inner = rng.choice(PART_NAMES[kind]), rng.choice(PART_INSIDE + [["h1"], ["h1"]] * (kind == "header"))
        linked = 1.0 if kind == "menu" or (kind in ("side", "share", "footer", "header") and rng.random() < 0.5) else 0.0
        texts = rng.choices(spare, k=rng.randint(1, 6))
        if kind in ("menu", "share", "header", "form") or rng.random() < 0.3:
            texts = [" ".join(t.split()[: rng.randint(1, 4)]) for t in texts]
        return [(Block((*under, name, *inner), t, linked), 0) for t in texts]

    shown: list[tuple[Block, int]] = []
    for kind in ("header", "notice", "menu", "advert", "side", "form"):
        if rng.random() < 0.45:
            shown += part(kind, root)
    for i, block in enumerate(article):
        inner = ["h1"] if i == 0 and rng.random() < 0.7 else rng.choice(INSIDE)
        shown.append((Block((*own, *inner), block.text, block.linked), 1))
        if rng.random() < 0.06:
            shown += part(rng.choice(["advert", "side", "share", "form", "notice"]), own)[:2]
    for kind, chance in (("share", 0.2), ("comment", 0.5), ("side", 0.3), ("advert", 0.3), ("form", 0.3), ("menu", 0.2), ("notice", 0.2), ("footer", 0.6)):
        if rng.random() < chance:
            shown += part(kind, own if kind in ("share", "comment") and rng.random() < 0.4 else root)
    return [b for b, _ in shown], np.array([y for _, y in shown], np.float32)


def fit(pages: list[str]) -> dict[str, np.ndarray] | None:
    """Weights learnt from pages that mark their article; None if none does."""
    rng, examples = random.Random(SEED), []
    parsed = [leaf_blocks(p) for p in pages]
    spare = sorted({b.text for blocks in parsed for b in blocks})
    for blocks in parsed:
        labels = np.array([marked_label(b.path) for b in blocks], np.float32)
        if labels.sum():
            examples.append((features(blocks), labels))
            article = [b for b, y in zip(blocks, labels, strict=True) if y]
            for _ in range(VARIANTS):
                shown, truth = variant(article, spare, rng)
                examples.append((features(shown), truth))
    if not examples:
        return None
    weights = new_weights()
    (first, second), turn = ({k: np.zeros_like(w) for k, w in weights.items()} for _ in range(2)), 0
    rounds = max(EPOCHS, -(-1500 // len(examples)))
    for _ in range(rounds):
        rng.shuffle(examples)
        for at in range(0, len(examples), 32):
            batch, grads = examples[at : at + 32], {k: np.zeros_like(w) for k, w in weights.items()}
            scores([x for x, _ in batch], weights, [y for _, y in batch], grads)
            turn += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                step = first[k] / (1 - 0.9**turn) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-7)
                weights[k] = (weights[k] - 0.01 * step).astype(np.float32)
    return weights


def main_texts(pages: list[str | None], weights: dict | None, group: int = 200) -> list[str]:
    """The article text of each page."""
    out = [""] * len(pages)
    for at in range(0, len(pages), group):
        parsed = {i: b for i, b in ((i, leaf_blocks(pages[i])) for i in range(at, min(at + group, len(pages)))) if b}
        order = sorted(parsed, key=lambda i: len(parsed[i]))
        while order:  # pages of like length together, and no more than 20,000 places with padding
            take = max(1, min(len(order), 20_000 // len(parsed[order[-1]])))
            order, batch = order[:-take], order[-take:]
            if weights is None:
                marks = [np.array([marked_label(b.path) for b in parsed[i]]) for i in batch]
            else:
                p = scores([features(parsed[i]) for i in batch], weights)
                marks = np.split(p >= 0.5, np.cumsum([len(parsed[i]) for i in batch])[:-1])
            for i, mark in zip(batch, marks, strict=True):
                out[i] = " ".join(b.text for b, y in zip(parsed[i], mark, strict=True) if y)
    return out


def drawn_pages(pages: DataFrame, sample_pages: int) -> tuple[DataFrame, bool]:
    """At most ``sample_pages`` different pages with an ``article`` or ``main`` tag, and whether there are more of them.

    Pages are ordered by a hash of id and html and the first are taken, so the number drawn does not follow the size of
    the table, and neither an id (or null) with many rows nor a page with many copies fills the draw.
    """
    draw = F.xxhash64("page_id", "html").alias("draw")
    tagged = pages.where(F.col("html").rlike(r"(?iU)<(article|main)[\s/>.]")).select("page_id", "html", draw)
    first = [r.draw for r in tagged.select("draw").distinct().orderBy("draw").limit(sample_pages + 1).collect()]
    last = max(first[:sample_pages], default=None)
    chosen = tagged.where(F.col("draw") <= F.lit(last).cast("long")).dropDuplicates(["draw"])
    return chosen.select("page_id", "html"), len(first) > sample_pages


def fit_model(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> bytes:
    """Fit in one task on ``sample_pages`` pages with an ``article`` or ``main`` tag, or on all if there are fewer."""
    sample, more = drawn_pages(pages, sample_pages)

    def learn(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat([*frames, pd.DataFrame({"page_id": [], "html": []})]).sort_values(["page_id", "html"])
        yield pd.DataFrame({"model": [pickle.dumps(fit(rows["html"].tolist()))]})

    found = sample.repartition(1).mapInPandas(learn, "model binary").collect()
    model = bytes(found[0]["model"]) if found else pickle.dumps(None)
    if more and pickle.loads(model) is None:
        raise ValueError(f"none of {sample_pages} drawn pages marks its article, but more pages have such tags")
    return model


def extract(pages: DataFrame, model: bytes | None = None) -> DataFrame:
    """Per row ``page_id, url, text, n_chars``."""
    shared = pages.sparkSession.sparkContext.broadcast(model or fit_model(pages))

    @F.pandas_udf("string")
    def article(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights = pickle.loads(shared.value)
        for texts in batches:
            yield pd.Series(main_texts(texts.tolist(), weights), dtype=object)

    return pages.select("page_id", "url", article("html").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
