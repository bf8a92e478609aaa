"""Main text of web pages by a recurrent block labeller.

A page is a sequence of leaf blocks: runs of text between block-level tags, each with
the path of tags and class names above it. A bidirectional LSTM reads a vector per
block (path, hashed words, a few numbers) and labels each block as main text or not,
seeing the blocks before and after it.

There are no labelled pages, so the network learns from a rule over telling tags and
class names, on a bounded sample of pages. Part of the training pages have their tags
renamed or their path hidden, so that it also learns from words, lengths and
neighbours, and can label pages on which the rule has nothing to go by.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.llm.batches import Fields, slices, texts_of

# --- blocks --------------------------------------------------------------------------

# HTML's void, raw-text and inline elements. Formulas and drawings are part of
# the text around them; what stands in for an embedded thing is a block of its own inside.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr "
    "math annotation menclose merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot "
    "mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics "
    "svg circle defs ellipse g line path polygon polyline rect symbol text tspan use".split()
)
EMBEDDED = frozenset("canvas iframe noscript object".split())
# An open element that ends where one of these begins.
ENDS_AT = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}

# Repetitions are possessive, so a page takes time in proportion to its length: a quote
# that is never closed is looked for once. A tag that the page's end cuts is no text.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*+>?"
    r"|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?=>|\Z)|[^>]*+)(?:>|\Z)"
    r"|[^<]++|<",
    re.S,
)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none|aria-hidden\s*=\s*.?true", re.I)
_PARTS = re.compile(r"[a-z]+")

INNER = 24  # innermost elements of a path that are kept whole


@dataclass(frozen=True)
class Block:
    text: str
    path: tuple[str, ...]  # tags and their .names, outermost first
    linked: int  # characters inside links


# Tags and name parts that tell main text from the rest.
NOT_MAIN = frozenset(
    "nav header footer aside form button select option label textarea input title head "
    ".nav .navbar .menu .header .footer .sidebar .aside .ad .ads .advert .advertisement .banner "
    ".sponsor .sponsored .promo .cookie .cookies .consent .notice .alert .popup .modal .overlay "
    ".comment .comments .reply .replies .respond .disqus .share .social .related .recommended "
    ".breadcrumb .breadcrumbs .pagination .pager .login .signup .newsletter .subscribe .search "
    ".widget .toolbar .copyright .legal .form .hidden .navigation .complementary .contentinfo "
    ".tags .meta .byline".split()
)
MAIN = frozenset(
    "article main .article .main .content .post .entry .story .text .body".split()
)
HEADS = frozenset(["header", ".header"])
TELLING = NOT_MAIN | MAIN


def _element(tag: str, attrs: str) -> tuple[str, ...]:
    names = []
    if attrs:
        for found in _NAMED.finditer(attrs):
            value = found[1] or found[2] or found[3] or ""
            names += ["." + part for part in _PARTS.findall(value.lower())]
        if _HIDDEN.search(attrs):
            names.append(".hidden")
    return (tag, *names)


class _Open:
    """The open elements at a place of a page."""

    def __init__(self) -> None:
        self.elements: list[tuple[str, ...]] = []
        # Up to each element: its path, and the telling parts outside its innermost ones.
        self.paths: list[tuple[str, ...]] = [()]
        self.outer: list[tuple[str, ...]] = [()]
        self.solid: list[int] = []  # places of the elements that are not inline
        self.counts: dict[str, int] = {}

    def push(self, element: tuple[str, ...]) -> None:
        elements = self.elements
        elements.append(element)
        outer = self.outer[-1]
        if len(elements) <= INNER:
            path = self.paths[-1] + element
        else:
            # What leaves the innermost elements is kept as far as it is telling.
            left = elements[len(elements) - INNER - 1]
            outer += tuple(p for p in dict.fromkeys(left) if p in TELLING and p not in outer)
            path = outer + tuple(part for own in elements[-INNER:] for part in own)
        self.paths.append(path)
        self.outer.append(outer)
        tag = element[0]
        if tag not in INLINE:
            self.solid.append(len(elements) - 1)
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def pop_to(self, place: int) -> None:
        for element in self.elements[place:]:
            self.counts[element[0]] -= 1
        del self.elements[place:], self.paths[place + 1 :], self.outer[place + 1 :]
        while self.solid and self.solid[-1] >= place:
            self.solid.pop()

    def end(self, tag: str) -> None:
        """Closes the innermost element of the tag, if one is open, and all inside it."""
        if self.counts.get(tag):
            place = len(self.elements) - 1
            while self.elements[place][0] != tag:
                place -= 1
            self.pop_to(place)

    def begin_block(self, tag: str) -> None:
        """A paragraph ends where a block begins; list items and cells at the next."""
        if self.solid:
            name = self.elements[self.solid[-1]][0]
            if name == "p" or tag in ENDS_AT.get(name, ()):
                self.pop_to(self.solid[-1])


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in order; scripts, styles and comments have none.

    A block's path has its innermost elements whole and, of those further out, every tag
    and name that tells main text from the rest.
    """
    found: list[Block] = []
    open_ = _Open()
    pieces: list[str] = []
    linked = at = 0

    def close() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(unescape("".join(pieces)).split())
            if text:
                found.append(Block(text, open_.paths[-1], linked))
            pieces.clear()
        linked = 0

    while at < len(page):
        match = _TOKEN.match(page, at)
        at = match.end()
        tag = match["tag"]
        if tag is None:
            text = match[0]
            if text[0] != "<" or text == "<":
                pieces.append(text)
                linked += len(text) if open_.counts.get("a") else 0
            continue
        tag = tag.lower()
        inline = tag in INLINE
        if tag == "br":
            pieces.append(" ")
            continue
        if not inline:
            close()
        if match["end"]:
            open_.end(tag)
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag in VOID:
            continue
        if not inline and tag not in EMBEDDED:
            open_.begin_block(tag)
        open_.push(_element(tag, match["attrs"]))
    close()
    return found


# --- the rule that labels training pages ----------------------------------------------

def by_rule(page: list[Block]) -> list[bool]:
    """Main text by tags and names; a heading part inside an article belongs to it."""
    labels = []
    inside = any(MAIN.intersection(block.path) for block in page)
    for block in page:
        first = next((i for i, part in enumerate(block.path) if part in MAIN), None)
        rest = NOT_MAIN.intersection(
            block.path if first is None else (
                *(p for p in block.path[:first]),
                *(p for p in block.path[first:] if p not in HEADS),
            )
        )
        if rest:
            labels.append(False)
        elif inside:
            labels.append(first is not None)
        else:
            words = block.text.count(" ") + 1
            labels.append(block.linked * 2 < len(block.text) and words >= 3)
    return labels


# Other ways to mark up the same parts, for training.
SAME_AS = {
    "article": (("main",), ("div", ".content"), ("div", ".post"), ("section", ".story"), ("div", ".entry")),
    "nav": (("div", ".header"), ("div", ".menu"), ("ul", ".nav"), ("div", ".navbar"), ("header",), ("div", ".breadcrumbs")),
    "footer": (("div", ".footer"), ("div", ".copyright"), ("div", ".contentinfo"), ("div", ".legal")),
    ".ad": ((".header",), (".advert",), (".banner",), (".promo",), (".cookie", ".notice"), (".sidebar",), (".comments",),
            (".newsletter", ".form"), (".related",)),
}


# Tags that main text also comes in.
MAIN_TAGS = ("p", "li", "blockquote", "td", "h2", "h3", "dd", "pre", "figcaption", "div")
_TELLING = sorted(NOT_MAIN)


def _disguised(page: list[Block], random: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """The page marked up otherwise, with labels.

    Sometimes paths are cut short, so that words and neighbours must do. Else telling
    parts are renamed, main text changes its tags, and blocks from around the main text
    turn up inside it under any telling name.
    """
    labels = by_rule(page)
    kind = random.integers(4)
    if kind == 0:
        return page, labels
    if kind == 1:
        return [Block(b.text, b.path[-1:], b.linked) for b in page], labels
    chosen = {name: ways[random.integers(len(ways))] for name, ways in SAME_AS.items()}
    around = [b for b, main in zip(page, labels) if not main]
    out = []
    for block, main in zip(page, labels):
        path = tuple(x for part in block.path for x in chosen.get(part, (part,)))
        if main and random.random() < 0.3:
            path = (*path[:-1], MAIN_TAGS[random.integers(len(MAIN_TAGS))])
        out.append(Block(block.text, path, block.linked))
        if around and random.random() < (0.15 if main else 0.05):
            other = around[random.integers(len(around))]
            telling = _TELLING[random.integers(len(_TELLING))]
            inner = ("div", telling) if telling[0] == "." else (telling,)
            inner += (("p",), ("ul", "li"), ())[random.integers(3)]
            out.append(Block(other.text, (*path[:-1], *inner), other.linked))
    return out, by_rule(out)


# --- vectors --------------------------------------------------------------------------

PATH_SIZE, WORD_SIZE, NUMBERS = 128, 64, 8
SIZE = 2 * PATH_SIZE + WORD_SIZE + NUMBERS


class Vectors:
    """Turns blocks into vectors; keeps paths and word slots it has seen."""

    def __init__(self) -> None:
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.slots: dict[str, int] = {}

    def _path(self, path: tuple[str, ...]) -> np.ndarray:
        if path not in self.paths:
            if len(self.paths) > 50_000:
                self.paths.clear()
            vector = np.zeros(2 * PATH_SIZE, np.float32)
            for part in path:
                vector[crc32(part.encode("utf-8", "replace")) % PATH_SIZE] = 1
            for part in path[-3:]:
                vector[PATH_SIZE + crc32(part.encode("utf-8", "replace")) % PATH_SIZE] = 1
            self.paths[path] = vector
        return self.paths[path]

    def _words(self, words: list[str]) -> np.ndarray:
        slots = self.slots
        if len(slots) > 500_000:
            slots.clear()
        for word in set(words).difference(slots):
            slots[word] = crc32(word.encode("utf-8", "replace")) % WORD_SIZE
        counts = np.bincount([slots[w] for w in words], minlength=WORD_SIZE).astype(np.float32)
        return counts / np.sqrt((counts * counts).sum())

    def __call__(self, page: list[Block]) -> np.ndarray:
        out = np.zeros((len(page), SIZE), np.float32)
        longest = max((len(b.text) for b in page), default=1)
        for at, block in enumerate(page):
            text = block.text
            words = text.lower().split()
            out[at, : 2 * PATH_SIZE] = self._path(block.path)
            out[at, 2 * PATH_SIZE : 2 * PATH_SIZE + WORD_SIZE] = self._words(words)
            out[at, -NUMBERS:] = (
                np.log1p(len(text)) / 8,
                np.log1p(len(words)) / 6,
                min(1.0, block.linked / len(text)),
                at / len(page),
                len(text) / longest,
                text[-1] in ".!?:;\"'",
                sum(map(text.count, ".,;:")) / len(words),
                sum(map(text.count, "|©·»")) > 0,
            )
        return out


# --- the network ----------------------------------------------------------------------

HIDDEN = 24


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """One LSTM in each direction and a logistic output on both states."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(random: np.random.Generator) -> Network:
        w = {}
        for way in ("f", "b"):
            w["x" + way] = random.normal(0, 0.1, (SIZE, 4 * HIDDEN)).astype(np.float32)
            w["h" + way] = random.normal(0, 0.1, (HIDDEN, 4 * HIDDEN)).astype(np.float32)
            w["c" + way] = np.zeros(4 * HIDDEN, np.float32)
            w["c" + way][HIDDEN : 2 * HIDDEN] = 1  # remember at first
        w["o"] = random.normal(0, 0.1, 2 * HIDDEN).astype(np.float32)
        w["oc"] = np.zeros(1, np.float32)
        return Network(w)

    def _one_way(self, way: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """States over time of a (pages, blocks, SIZE) batch; masked steps change nothing."""
        w, (pages, steps, _) = self.weights, x.shape
        gates_x = x @ w["x" + way] + w["c" + way]
        h = np.zeros((pages, HIDDEN), np.float32)
        c = np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((pages, steps, HIDDEN), np.float32)
        kept = []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            gates = gates_x[:, t] + h @ w["h" + way]
            i, f, o = (_sigmoid(gates[:, n * HIDDEN : (n + 1) * HIDDEN]) for n in range(3))
            g = np.tanh(gates[:, 3 * HIDDEN :])
            new_c = f * c + i * g
            tanh_c = np.tanh(new_c)
            m = mask[:, t : t + 1]
            if keep:
                kept.append((t, h, c, i, f, o, g, tanh_c, m))
            h = m * (o * tanh_c) + (1 - m) * h
            c = m * new_c + (1 - m) * c
            out[:, t] = h
        return out, kept

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        forward, _ = self._one_way("f", x, mask, False)
        back, _ = self._one_way("b", x, mask, False)
        w = self.weights
        return forward @ w["o"][:HIDDEN] + back @ w["o"][HIDDEN:] + w["oc"]

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss over the blocks of a batch, through time."""
        w = self.weights
        states = {way: self._one_way(way, x, mask, True) for way in ("f", "b")}
        both = np.concatenate([states["f"][0], states["b"][0]], axis=2)
        error = (_sigmoid(both @ w["o"] + w["oc"]) - y) * mask / mask.sum()
        found = {"o": np.einsum("pt,pth->h", error, both), "oc": np.array([error.sum()])}
        for part, way in enumerate(("f", "b")):
            d_out = error[:, :, None] * w["o"][part * HIDDEN : (part + 1) * HIDDEN]
            d_gates = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            d_h = np.zeros((len(x), HIDDEN), np.float32)
            d_c = np.zeros_like(d_h)
            d_hidden = np.zeros_like(w["h" + way])
            for t, h, c, i, f, o, g, tanh_c, m in reversed(states[way][1]):
                d_h = d_h + d_out[:, t]
                into = m * d_h
                d_cell = m * d_c + into * o * (1 - tanh_c**2)
                d = np.concatenate(
                    [
                        d_cell * g * i * (1 - i),
                        d_cell * c * f * (1 - f),
                        into * tanh_c * o * (1 - o),
                        d_cell * i * (1 - g**2),
                    ],
                    axis=1,
                )
                d_gates[:, t] = d
                d_hidden += h.T @ d
                d_h = (1 - m) * d_h + d @ w["h" + way].T
                d_c = (1 - m) * d_c + d_cell * f
            flat = d_gates.reshape(-1, 4 * HIDDEN)
            found["x" + way] = x.reshape(-1, SIZE).T @ flat
            found["h" + way] = d_hidden
            found["c" + way] = flat.sum(axis=0)
        return found


def _batch(vectors: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, vectors))
    x = np.zeros((len(vectors), steps, SIZE), np.float32)
    mask = np.zeros((len(vectors), steps), np.float32)
    for at, v in enumerate(vectors):
        x[at, : len(v)], mask[at, : len(v)] = v, 1
    return x, mask


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample, and the training.

    At most ``sample_pages`` pages of at most ``sample_chars`` characters, and of each
    page the first ``sample_blocks`` blocks, are learned from.
    """

    sample_pages: int = 384
    sample_chars: int = 100_000
    sample_blocks: int = 200
    epochs: int = 24
    pages_per_step: int = 32
    rate: float = 0.01
    seed: int = 5
    # Pages labelled together hold at most this many blocks with padding.
    batch_blocks: int = 1 << 14


def train(pages: list[str], settings: Settings = Settings()) -> Network:
    """A network that has learned from these pages, by Adam; the same for the same pages."""
    random = np.random.default_rng(settings.seed)
    network = Network.fresh(random)
    parsed = [found for found in (blocks(page)[: settings.sample_blocks] for page in pages) if found]
    if not parsed:
        # Nothing to learn from: everything is main text.
        network.weights["oc"][:] = 5
        return network
    vectors = Vectors()
    first = {k: np.zeros_like(v) for k, v in network.weights.items()}
    second = {k: np.zeros_like(v) for k, v in network.weights.items()}
    step = 0
    for epoch in range(settings.epochs):
        order = random.permutation(len(parsed))
        # Pages of similar length go together, in random order.
        order = order[np.argsort([len(parsed[i]) // 8 for i in order], kind="stable")]
        groups = [order[i : i + settings.pages_per_step] for i in range(0, len(order), settings.pages_per_step)]
        for at in random.permutation(len(groups)):
            group = groups[at]
            made = [_disguised(parsed[i], random) for i in group]
            x, mask = _batch([vectors(page) for page, _ in made])
            y = np.zeros(mask.shape, np.float32)
            for row, (_, labels) in enumerate(made):
                y[row, : len(labels)] = labels
            step += 1
            rate = settings.rate * min(1.0, 2 * (1 - epoch / settings.epochs))
            for k, g in network.gradients(x, mask, y).items():
                g = np.clip(g, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                network.weights[k] -= (rate * move).astype(np.float32)
    return network


def fit(pages: DataFrame, fields: Fields = Fields("page_id", "html"), settings: Settings = Settings()) -> Network:
    """A network learned from a sample: the page with the least key hash of each bucket.

    The aggregate holds one long per bucket; only the sampled pages, whose number and
    length are bounded, reach the driver.
    """
    rows = pages.select(F.col(fields.key).alias("key"), F.col(fields.text).alias("text")).filter(
        F.col("key").isNotNull() & (F.length("text") <= settings.sample_chars)
    ).withColumn("hash", F.xxhash64("key"))
    bucket = F.pmod("hash", F.lit(settings.sample_pages))
    least = rows.groupBy(bucket.alias("bucket")).agg(F.min("hash").alias("hash")).select("hash")
    # At most sample_pages rows of one number: small enough to broadcast.
    sampled = rows.join(F.broadcast(least), "hash").groupBy("hash").agg(F.min("text").alias("text"))
    return train([r["text"] for r in sampled.orderBy("hash").collect()], settings)


def label(pages: list[list[Block]], network: Network, vectors: Vectors, settings: Settings) -> list[np.ndarray]:
    """For each page, whether each block is main text; pages of like length go together."""
    out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
    order = sorted((i for i, page in enumerate(pages) if page), key=lambda i: len(pages[i]))
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end + 1 - at) * len(pages[order[end]]) <= settings.batch_blocks:
            end += 1
        group = order[at:end]
        x, mask = _batch([vectors(pages[i]) for i in group])
        logits = network.logits(x, mask)
        for row, i in enumerate(group):
            out[i] = logits[row, : len(pages[i])] > 0
        at = end
    return out


def extract(
    pages: DataFrame,
    network: Network,
    fields: Fields = Fields("page_id", "html"),
    settings: Settings = Settings(),
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """(key, main_text, n_blocks, n_main, *carried) of every page, from its whole html.

    ``carried`` names further columns to keep; none may be called as the four.

    Main blocks are joined by a line feed. Null and empty pages have an empty text.
    Repeated rows stay; other columns are ignored. No shuffle.
    """
    if clash := {"key", "text", "main_text", "n_blocks", "n_main"}.intersection(carried):
        raise ValueError(f"carried columns must have other names than {sorted(clash)}")
    source = pages.select(
        F.col(fields.key).alias("key"), F.col(fields.text).alias("text"), *carried
    )
    kind = source.schema["key"].dataType.simpleString()
    kept = [source.schema[name] for name in carried]
    fixed = T.StructType.fromDDL(f"key {kind}, main_text string, n_blocks bigint, n_main bigint")
    schema = T.StructType([*fixed.fields, *kept])

    def run(batches):
        vectors = Vectors()
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                parsed = [blocks(page) for page in texts_of(part)]
                labels = label(parsed, network, vectors, settings)
                texts = [
                    "\n".join(b.text for b, main in zip(page, own) if main)
                    for page, own in zip(parsed, labels)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("key"),
                        pa.array(texts, pa.string()),
                        pa.array([len(p) for p in parsed], pa.int64()),
                        pa.array([int(own.sum()) for own in labels], pa.int64()),
                        *part.columns[2:],
                    ],
                    ["key", "main_text", "n_blocks", "n_main", *carried],
                )

    return source.mapInArrow(run, schema)
