"""HTML extraction by a recurrent block labeller.

A page becomes a sequence of leaf blocks. A bidirectional LSTM in numpy reads, for each,
a vector of its tag path (tags and class words, hashed), a vector of its hashed words and
a few sizes, and says with the whole page in view whether the block belongs to the
article. It is trained here, on pages made by a rule of the usual layouts.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

# Fixed values of the HTML standard: elements without an end tag, elements inside a line of
# text, and elements that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol table dl select article section div main nav aside body".split())

# Elements that decide where an open paragraph, item, row or cell ends.
BOUNDS = frozenset({*SCOPES, "p", *SAME_ENDS})
RAW = frozenset("script style template noscript".split())

TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
ATTRIBUTES = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in RAW}
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
NAME = re.compile(r"[a-z]+")
#: Tags whose quotes don't close, after which a page's tags end at the next ``>`` without regard to quotes.
ODD_TAGS = 8

PATH_BUCKETS, WORD_BUCKETS, WIDTH, SIZES, HIDDEN = 1024, 256, 12, 6, 16


class Node:
    """An element of a page: its parent, and the hashed tokens that it adds to the paths below it."""

    __slots__ = ("parent", "own")

    def __init__(self, parent: Node | None, own: tuple[int, ...]) -> None:
        self.parent, self.own = parent, own


class Block:
    __slots__ = ("node", "text", "linked")

    def __init__(self, node: Node | None, text: str, linked: int) -> None:
        self.node, self.text, self.linked = node, text, linked


@lru_cache(50_000)
def path_bucket(token: str) -> int:
    return crc32(token.encode("utf-8", "surrogatepass")) % PATH_BUCKETS


def tags(page: str) -> Iterator[tuple[int, int, str | None, bool, str]]:
    """``(start, stop, name, closing, attributes)`` of each tag; the name is None for what is no text and no tag.

    That is comments, declarations and scripts with all that is in them. A ``<`` that begins none of these,
    or has no ``>`` after it, is text. Every character is read a bounded number of times.
    """
    at, odd = page.find("<"), 0
    while at >= 0:
        stop = -1
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            stop = end + 3 if end >= 0 else len(page)
            yield at, stop, None, False, ""
        elif m := TAG.match(page, at + 1):
            inner = ATTRIBUTES.match(page, m.end()) if odd < ODD_TAGS else None
            if inner:
                stop = inner.end()
                if not m[1] and m[2].lower() in RAW:
                    end = RAW_END[m[2].lower()].search(page, stop)
                    stop = end.end() if end else len(page)
                    yield at, stop, None, False, ""
                else:
                    yield at, stop, m[2].lower(), bool(m[1]), page[m.end() : inner.end() - 1]
            else:
                odd += 1
                stop = page.find(">", m.end()) + 1
                if not stop:  # and none for any later tag
                    return
                yield at, stop, m[2].lower(), bool(m[1]), page[m.end() : stop - 1]
        elif page.startswith(("<!", "<?"), at):
            stop = page.find(">", at) + 1
            if not stop:
                return
            yield at, stop, None, False, ""
        at = page.find("<", stop if stop > 0 else at + 1)


def blocks(page: str) -> list[Block]:
    """Leaf blocks in page order: white space is one space, references are decoded, empty ones left out.

    Scripts, styles, templates and comments aren't text. A stray ``<`` is. The work is linear in the page.
    """
    out: list[Block] = []
    stack: list[tuple[str, Node]] = []  # the open elements
    bounds: list[int] = []  # where in the stack those are that can end, or keep open, a paragraph or item
    opened: Counter = Counter()
    parts: list[str] = []
    node: Node | None = None
    begun = False
    linked, at = 0, 0

    def flush() -> None:
        nonlocal begun, node, linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append(Block(node, text, min(linked, len(text))))
            parts.clear()
        begun, node, linked = False, None, 0

    def add(text: str) -> None:
        nonlocal begun, node, linked
        if "&" in text:
            text = html.unescape(text)
        parts.append(text)
        if not begun and not text.isspace():
            begun, node = True, stack[-1][1] if stack else None
        if opened["a"]:
            linked += len(text)

    def close(i: int) -> None:
        for name, _ in stack[i:]:
            opened[name] -= 1
        del stack[i:]
        while bounds and bounds[-1] >= i:
            bounds.pop()

    for start, stop, tag, closing, attributes in tags(page):
        if start > at:
            add(page[at:start])
        at = stop
        if tag is None:
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag not in INLINE:
            flush()
        if closing:
            if opened[tag]:
                close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag))
            continue
        if tag in VOID:
            continue
        ends = {"p"} if tag in ENDS_P else SAME_ENDS.get(tag, ())
        if ends:
            for i in reversed(bounds):
                if stack[i][0] in ends:
                    close(i)
                    break
                if stack[i][0] in SCOPES:
                    break
        if attributes.endswith("/") and tag not in ENDS_P:
            continue
        names = [] if tag in INLINE and tag != "a" else [tag]
        if tag not in INLINE and len(attributes) > 4:
            for n in NAMES.finditer(attributes):
                names += ["." + w for w in NAME.findall((n[1] or n[2] or n[3] or "").lower())]
        if tag in BOUNDS:
            bounds.append(len(stack))
        stack.append((tag, Node(stack[-1][1] if stack else None, tuple(map(path_bucket, names)))))
        opened[tag] += 1
    if at < len(page):
        add(page[at:])
    flush()
    return out


def chain(node: Node | None) -> list[Node]:
    """The element and those around it, from the leaf up."""
    out = []
    while node:
        out.append(node)
        node = node.parent
    return out


def path_bag(node: Node | None) -> np.ndarray:
    """Buckets of all tokens of a path, and the first one, which is in all of them."""
    return np.array([0, *(b for n in chain(node) for b in n.own)], np.int64)


def path_vectors(page: list[Block], table: np.ndarray) -> np.ndarray:
    """The sum of the embeddings of each block's path. An element's is added to its parent's, once."""
    known: dict[Node | None, np.ndarray] = {None: table[0]}
    out = np.empty((len(page), table.shape[1]))
    for k, block in enumerate(page):
        node, todo = block.node, []
        while node not in known:
            todo.append(node)
            node = node.parent
        for n in reversed(todo):
            total = known[n.parent]
            known[n] = total + table[list(n.own)].sum(axis=0) if n.own else total
        out[k] = known[block.node]
    return out


class Buckets(dict):
    def __missing__(self, word: str) -> int:
        found = crc32(word.encode("utf-8", "surrogatepass")) % WORD_BUCKETS
        if len(self) < 200_000:
            self[word] = found
        return found


_BUCKETS = Buckets()


def word_bag(text: str) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(_BUCKETS.__getitem__, words), np.int64, len(words))


def sizes(block: Block, i: int, n: int) -> list[float]:
    text = block.text
    words = text.count(" ") + 1
    points = text.count(".") + text.count(",")
    return [np.log1p(words) / 4, block.linked / len(text), min(1.0, 4 * points / words), i / max(1, n - 1), float(text[-1] in ".!?:"), min(1.0, len(text) / words / 12)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Labeller:
    """The network: two embeddings, an LSTM in each direction, and a logit for each block."""

    def __init__(self, seed: int = 1) -> None:
        r = np.random.default_rng(seed)
        d = 2 * WIDTH + SIZES
        self.weights = {"path": r.normal(0, 0.3, (PATH_BUCKETS, WIDTH)), "word": r.normal(0, 0.1, (WORD_BUCKETS, WIDTH)), "out": r.normal(0, 0.3, (2 * HIDDEN + d,)), "bias": np.zeros(1)}
        for side in "fb":
            self.weights[side + "w"] = r.normal(0, 1 / np.sqrt(d + HIDDEN), (d + HIDDEN, 4 * HIDDEN))
            self.weights[side + "c"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])

    def inputs(self, page: list[Block]) -> np.ndarray:
        w, n = self.weights, len(page)
        paths = path_vectors(page, w["path"])
        words = np.stack([w["word"][word_bag(b.text)].mean(axis=0) for b in page])
        return np.concatenate([paths, words, np.array([sizes(b, i, n) for i, b in enumerate(page)])], axis=1)

    def forward(self, x: np.ndarray, mask: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """Hidden states over time-major ``x`` (T, B, d); masked steps carry the state on."""
        w, c0 = self.weights[side + "w"], self.weights[side + "c"]
        steps, batch, d = x.shape
        h, c = np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN))
        into = x @ w[:d] + c0
        out = np.empty((steps, batch, HIDDEN))
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            z = into[t] + h @ w[d:]
            i, f, o, g = sigmoid(z[:, :HIDDEN]), sigmoid(z[:, HIDDEN : 2 * HIDDEN]), sigmoid(z[:, 2 * HIDDEN : 3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + i * g
            th = np.tanh(new)
            m = mask[t][:, None]
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, th, m))
            c, h = np.where(m, new, c), np.where(m, o * th, h)
            out[t] = h
        return out

    def logits(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self.forward(x, mask, "f"), self.forward(x, mask, "b"), x], axis=2)
        return both @ self.weights["out"] + self.weights["bias"]

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Which blocks of each page are the article's. Pages of like length are read together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((i for i in range(len(pages)) if pages[i]), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            group = order[at : at + max(1, min(256, 40_000 // len(pages[order[min(at + 255, len(order) - 1)]])))]
            at += len(group)
            x, mask = padded([self.inputs(pages[i]) for i in group])
            found = self.logits(x, mask) > 0
            for k, i in enumerate(group):
                out[i] = found[: len(pages[i]), k]
        return out

    def train(self, pages: list[tuple[list[Block], np.ndarray]], *, epochs: int = 12, batch: int = 24, rate: float = 0.01) -> None:
        """Adam on the mean cross entropy, back through time."""
        r = np.random.default_rng(3)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second, step = {k: np.zeros_like(v) for k, v in self.weights.items()}, 0
        for epoch in range(epochs):
            order = r.permutation(len(pages))
            for at in range(0, len(order), batch):
                grads = self._gradients([pages[i] for i in order[at : at + batch]])
                step += 1
                for k, g in grads.items():
                    g = g + 1e-5 * self.weights[k]
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                    self.weights[k] = self.weights[k] - rate * (1 - 0.7 * epoch / epochs) * move

    def _gradients(self, some: list) -> dict[str, np.ndarray]:
        w = self.weights
        x, mask = padded([self.inputs(p) for p, _ in some])
        truth, _ = padded([y[:, None].astype(float) for _, y in some])
        kept: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self.forward(x, mask, "f", kept["f"]), self.forward(x, mask, "b", kept["b"]), x], axis=2)
        error = np.where(mask, sigmoid(both @ w["out"] + w["bias"]) - truth[:, :, 0], 0) / mask.sum()
        grads = {"out": np.einsum("tb,tbk->k", error, both), "bias": np.array([error.sum()])}
        back = error[:, :, None] * w["out"]
        dx = back[:, :, 2 * HIDDEN :].copy()
        d = x.shape[2]
        for side, part in (("f", back[:, :, :HIDDEN]), ("b", back[:, :, HIDDEN : 2 * HIDDEN])):
            dw, db = np.zeros_like(w[side + "w"]), np.zeros_like(w[side + "c"])
            dh, dc = np.zeros(part.shape[1:]), np.zeros(part.shape[1:])
            for t, h, c, i, f, o, g, th, m in reversed(kept[side]):
                dh = dh + part[t]
                live = np.where(m, dh, 0)
                dn = np.where(m, dc + live * o * (1 - th * th), 0)
                z = np.concatenate([dn * g * i * (1 - i), dn * c * f * (1 - f), live * th * o * (1 - o), dn * i * (1 - g * g)], axis=1)
                dw[:d] += x[t].T @ z
                dw[d:] += h.T @ z
                db += z.sum(axis=0)
                dx[t] += z @ w[side + "w"][:d].T
                dh, dc = np.where(m, z @ w[side + "w"][d:].T, dh), np.where(m, dn * f, dc)
            grads[side + "w"], grads[side + "c"] = dw, db
        grads["path"], grads["word"] = np.zeros_like(w["path"]), np.zeros_like(w["word"])
        for k, (page, _) in enumerate(some):
            for t, block in enumerate(page):
                np.add.at(grads["path"], path_bag(block.node), dx[t, k, :WIDTH])
                bag = word_bag(block.text)
                np.add.at(grads["word"], bag, dx[t, k, WIDTH : 2 * WIDTH] / len(bag))
        return grads


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Time-major array (T, B, d), and which steps are real."""
    steps = max(len(r) for r in rows)
    x, mask = np.zeros((steps, len(rows), rows[0].shape[1])), np.zeros((steps, len(rows)), bool)
    for k, r in enumerate(rows):
        x[: len(r), k], mask[: len(r), k] = r, True
    return x, mask


@lru_cache(1)
def trained(pages: int = 360) -> Labeller:
    """The labeller, trained on made pages; the same at every call."""
    from .layouts import made_page

    some = []
    for seed in range(pages):
        page, article = made_page(seed)
        found = blocks(page)
        some.append((found, np.array([b.text in article for b in found])))
    labeller = Labeller()
    labeller.train([x for x in some if len(x[0])])
    return labeller


def main_text(pages: list[str | None], labeller: Labeller) -> list[str]:
    found = [blocks(p) if p else [] for p in pages]
    return [" ".join(b.text for b, y in zip(f, label) if y) for f, label in zip(found, labeller.label(found))]


def extract(pages: DataFrame, labeller: Labeller) -> DataFrame:
    """``(page_id, url, text, n_chars)``: the article's blocks, joined by spaces in page order.

    Null, empty and blockless pages have an empty text. Rows with null or repeated ids stay, each by
    itself; other columns are ignored; an empty table gives no rows. A page is read whole.
    """
    shared = pages.sparkSession.sparkContext.broadcast(labeller)  # some ten thousand weights, whatever the input

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(main_text(batch.column(2).to_pylist(), shared.value), pa.string())], ["page_id", "url", "text"])

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    found = map_texts(slim, run, "page_id long, url string, text string", column=2)
    return found.withColumn("n_chars", F.length("text").cast("long"))
