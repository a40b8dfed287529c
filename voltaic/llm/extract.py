"""Main-text extraction by a linear-chain conditional random field.

A page becomes the sequence of its leaf blocks: runs of text between
block-level tags. Each block has features of its ancestors' tags and names and
of its text; the field adds weights for neighbouring labels, and Viterbi
decoding marks the blocks of the article. The field is trained on labelled
pages by gradient ascent of the exact log likelihood (forward-backward).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import per_text
from voltaic.llm.pages import labelled_pages

#: Elements that start a block, that have no end tag, and whose
#: content is not text of the page.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN_TAGS = frozenset("script style noscript template svg iframe object textarea select title head audio video canvas".split())
RAW_TAGS = frozenset("script style textarea title noscript iframe".split())
#: Start tags that may stand in a head; any other ends it.
HEAD_TAGS = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
#: An opening tag ends these open elements, as browsers do.
IMPLIED_END = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: An implied end looks no further up than one of these.
SCOPES = frozenset("ul ol dl table article section div body main aside nav form blockquote td th header footer".split())
CLOSES_P = BLOCK_TAGS - {"button", "option", "optgroup", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "html", "body", "head", "title", "legend", "summary"}

#: Labelled pages that train the field, and the sample of real pages whose
#: block texts they are made of.
TRAINING_PAGES = 500
SAMPLE_PAGES = 400
SAMPLE_BLOCKS = 8
SENTENCE_CHARS = 600
EPOCHS = 250
SEED = 5

# An attribute as browsers read it: a value is quoted only if a quote follows
# the equals sign; else it ends at white space or the end of the tag.
_ATTRIBUTE = r"[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?)?"
_TAG = re.compile(rf"<(?:!--.*?(?:--!?>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|{_ATTRIBUTE})*+)(?:>|\Z)|[!?/][^>]*(?:>|\Z))", re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_TOKENS = re.compile(r"[^\W_]+")


class Node:
    """An open element, with what it and all elements around it are called.

    An element that adds no name shares its parent's, so deep nesting costs no
    more than the names in it.
    """

    __slots__ = ("tag", "called", "parent", "block", "near", "names")

    def __init__(self, tag: str, names: str, parent: Node | None):
        self.tag, self.called, self.parent = tag, names, parent
        self.block = tag if tag in BLOCK_TAGS or parent is None else parent.block
        self.near = {f"near:{t}" for t in (tag, parent.tag if parent else "html") if t not in ("html", "body")}
        own = {f"in:{tag}"} if tag not in ("html", "body") else set()
        own.update(f"name:{n}" for n in names.split())
        own.update(f"part:{t}" for t in _TOKENS.findall(names))
        around = parent.names if parent else frozenset()
        self.names = around if own <= around else around | own


@dataclass
class Block:
    text: str
    tag: str
    node: Node | None
    link_chars: int

    @property
    def ancestors(self) -> list[tuple[str, str]]:
        """Tag and names of the elements around the block, outermost first."""
        out, node = [], self.node
        while node is not None:
            out.append((node.tag, node.called))
            node = node.parent
        return out[::-1]


def leaf_blocks(page: str | None) -> list[Block]:
    """Blocks of text in page order, references decoded, white space folded.

    Broken markup is read as browsers do in the common cases: unclosed
    paragraphs, list items, cells and heads, stray end tags, unclosed comments,
    quotes in unquoted values.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[Node] = []
    pieces: list[tuple[str, bool]] = []
    opened: Counter = Counter()
    hidden = links = at = 0

    def flush() -> None:
        if pieces:
            text = " ".join("".join(p for p, _ in pieces).split())
            if text:
                node = stack[-1] if stack else None
                out.append(Block(text, node.block if node and node.block in BLOCK_TAGS else "", node, sum(len(p.strip()) for p, linked in pieces if linked)))
            pieces.clear()

    def pop(n: int) -> None:
        nonlocal hidden, links
        for node in stack[n:]:
            hidden -= node.tag in HIDDEN_TAGS
            links -= node.tag == "a"
            opened[node.tag] -= 1
        del stack[n:]

    def end_implied(tags: set[str], scopes: frozenset[str]) -> None:
        if not any(opened[t] for t in tags):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].tag in tags:
                pop(i)
                return
            if stack[i].tag in scopes:
                return

    while at < len(page):
        m = _TAG.search(page, at)
        end = m.start() if m else len(page)
        if stack and stack[-1].tag == "head" and page[at:end].strip():
            pop(len(stack) - 1)
        if end > at and not hidden:
            pieces.append((html.unescape(page[at:end]), links > 0))
        if m is None:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if tag == "br" and not hidden:
            pieces.append((" ", False))
        if m[1]:
            if tag not in VOID_TAGS:
                for i in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                    if stack[i].tag == tag:
                        if tag in BLOCK_TAGS:
                            flush()
                        pop(i)
                        break
                    # An inline end tag does not close blocks around it.
                    if tag not in BLOCK_TAGS and stack[i].tag in BLOCK_TAGS:
                        break
                else:
                    # Stray end tags are ignored, but a stray </p> is an empty paragraph.
                    if tag == "p":
                        flush()
            continue
        if stack and stack[-1].tag == "head" and tag not in HEAD_TAGS:
            pop(len(stack) - 1)
        if tag in BLOCK_TAGS:
            flush()
        if tag in CLOSES_P:
            end_implied({"p"}, SCOPES)
        if tag in IMPLIED_END:
            end_implied(IMPLIED_END[tag], SCOPES - {"td", "th"} if tag in ("td", "th", "tr") else SCOPES)
        if tag in VOID_TAGS or m[3].endswith("/") and tag not in BLOCK_TAGS and tag not in RAW_TAGS:
            continue
        names = " ".join(a or b or c for a, b, c in _NAMES.findall(m[3])) if m[3] else ""
        if tag in RAW_TAGS:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?|</{tag}\Z", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        if tag in ("head", "body"):
            end_implied({"head"}, frozenset())
        stack.append(Node(tag, names.lower(), stack[-1] if stack else None))
        opened[tag] += 1
        hidden += tag in HIDDEN_TAGS
        links += tag == "a"
    flush()
    return out


def _bucket(n: float, edges: tuple) -> int:
    return sum(n >= e for e in edges)


def features(blocks: list[Block]) -> list[list[str]]:
    """Feature names of each block: ancestors, own tag, text, neighbours' tags."""
    out, known = [], {}
    for i, b in enumerate(blocks):
        key = id(b.node)
        if key not in known:
            known[key] = sorted(b.node.names | b.node.near) if b.node else []
        words = b.text.count(" ") + 1
        linked = b.link_chars / len(b.text)
        out.append([
            *known[key], "bias", f"tag:{b.tag}", f"words:{_bucket(words, (2, 4, 8, 15, 30, 60))}", f"links:{_bucket(linked, (0.01, 0.3, 0.7))}",
            f"end:{b.text[-1] if b.text[-1] in '.!?:;,' else 'x'}", *(["sign:c"] if "©" in b.text else []),
            *(["first"] if i == 0 else []), *(["last"] if i == len(blocks) - 1 else []),
        ])
    return out


@dataclass
class Field:
    """Weights of features per label (0 other, 1 article) and of label pairs."""

    weights: dict[str, np.ndarray]
    pairs: np.ndarray

    def scores(self, rows: list[list[str]]) -> np.ndarray:
        get, zero = self.weights.get, np.zeros(2)
        return np.array([sum((get(f, zero) for f in row), zero) for row in rows])

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The likeliest labels (Viterbi)."""
        if not rows:
            return []
        s = self.scores(rows).tolist()
        (p00, p01), (p10, p11) = self.pairs.tolist()
        a, b = s[0]
        back = []
        for x, y in s[1:]:
            from0, from1 = (a + p00, b + p10), (a + p01, b + p11)
            i, j = int(from0[1] > from0[0]), int(from1[1] > from1[0])
            back.append((i, j))
            a, b = from0[i] + x, from1[j] + y
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def log_likelihood(score: np.ndarray, mask: np.ndarray, labels: np.ndarray, pairs: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Total log likelihood of padded sequences, and gradients.

    ``score`` is (pages, blocks, 2), ``mask`` and ``labels`` (pages, blocks).
    Returns the gradient by ``score`` and by ``pairs``.
    """
    n, size, _ = score.shape
    logsum = lambda x: np.logaddexp(x[:, 0], x[:, 1])
    forward, backward = np.zeros_like(score), np.zeros_like(score)
    forward[:, 0] = score[:, 0]
    for t in range(1, size):
        step = logsum(forward[:, t - 1][:, :, None] + pairs) + score[:, t]
        forward[:, t] = np.where(mask[:, t][:, None], step, forward[:, t - 1])
    for t in range(size - 2, -1, -1):
        step = np.logaddexp(*[(pairs[None, :, j] + (score[:, t + 1, j] + backward[:, t + 1, j])[:, None]) for j in (0, 1)])
        backward[:, t] = np.where(mask[:, t + 1][:, None], step, backward[:, t + 1])
    total = logsum(forward[:, -1])
    p = np.exp(forward + backward - total[:, None, None]) * mask[:, :, None]
    hot = np.eye(2)[labels] * mask[:, :, None]
    both = mask[:, 1:]
    q = np.exp(forward[:, :-1, :, None] + pairs + (score + backward)[:, 1:, None, :] - total[:, None, None, None]) * both[:, :, None, None]
    true = (hot[:, :-1, :, None] * hot[:, 1:, None, :] * both[:, :, None, None]).sum((0, 1))
    value = (score * hot).sum() + (pairs * true).sum() - total.sum()
    return value, hot - p, true - q.sum((0, 1))


def train(pages: list[tuple[str, list[tuple[str, int]]]], epochs: int = EPOCHS, ridge: float = 1e-5) -> Field:
    """Fit a field to labelled pages (Adam on the penalized log likelihood)."""
    rows, labels = [], []
    for page, own in pages:
        blocks = leaf_blocks(page)
        if [b.text for b in blocks] != [t for t, _ in own]:
            raise ValueError("labels and blocks of a training page differ")
        if blocks:
            rows.append(features(blocks))
            labels.append([x for _, x in own])
    names = sorted({f for r in rows for b in r for f in b})
    number = {f: i for i, f in enumerate(names)}
    size = max(map(len, rows))
    n = len(rows)
    mask, y = np.zeros((n, size), bool), np.zeros((n, size), int)
    cells, cols = [], []
    for i, (r, own) in enumerate(zip(rows, labels)):
        mask[i, : len(r)], y[i, : len(r)] = True, own
        for t, b in enumerate(r):
            cells += [i * size + t] * len(b)
            cols += [number[f] for f in b]
    cells, cols = np.array(cells), np.array(cols)
    total = mask.sum()
    w, pairs = np.zeros((len(names), 2)), np.zeros((2, 2))
    state = [[p, np.zeros_like(p), np.zeros_like(p)] for p in (w, pairs)]
    for t in range(1, epochs + 1):
        score = np.stack([np.bincount(cells, weights=w[cols, k], minlength=n * size) for k in (0, 1)], -1).reshape(n, size, 2)
        _, g_score, g_pairs = log_likelihood(score, mask, y, pairs)
        flat = g_score.reshape(-1, 2)[cells]
        g_w = np.stack([np.bincount(cols, weights=flat[:, k], minlength=len(names)) for k in (0, 1)], -1)
        for s, g in zip(state, (g_w / total - ridge * w, g_pairs / total - ridge * pairs)):
            s[1] += 0.1 * (g - s[1])
            s[2] += 0.01 * (g * g - s[2])
            s[0] += 0.1 * (s[1] / (1 - 0.9**t)) / (np.sqrt(s[2] / (1 - 0.99**t)) + 1e-8)
    return Field({f: w[i] for f, i in number.items()}, pairs)


def main_text(page: str | None, model: Field) -> str:
    """The article's blocks in page order, joined by blank lines."""
    blocks = leaf_blocks(page)
    return "\n\n".join(b.text for b, keep in zip(blocks, model.decode(features(blocks))) if keep)


def training_sentences(pages: DataFrame, page: str = "html") -> list[str]:
    """A bounded, repeatable sample of block texts that training pages are made of.

    About ``SAMPLE_PAGES`` pages, picked by a hash, give ``SAMPLE_BLOCKS``
    blocks each, cut to ``SENTENCE_CHARS``; a hard bound of twice that follows.
    """
    share = min(1.0, SAMPLE_PAGES / max(1, pages.count()))
    rows = pages.select(F.col(f"`{page}`").cast("string").alias("page"))
    rows = rows.withColumn("h", F.pmod(F.xxhash64("page"), F.lit(1 << 30)) / float(1 << 30)).where(F.col("h") <= share)

    def cutout(texts):
        out = []
        for t in texts:
            own = [b.text[:SENTENCE_CHARS] for b in leaf_blocks(t)]
            every = max(1, len(own) // SAMPLE_BLOCKS)
            out.append(own[::every][:SAMPLE_BLOCKS])
        return [pa.array(out, pa.list_(pa.string()))]

    own = per_text(rows, "page", ["h"], "own array<string>", cutout).orderBy("h", "own").limit(2 * SAMPLE_PAGES)
    return sorted({x for r in own.collect() for x in r.own})


def extract(pages: DataFrame, model: Field, keep: list[str], page: str = "html") -> DataFrame:
    """``keep`` columns and the main ``text`` of every page.

    A NULL or empty page, and one without article blocks, has empty text. One
    row per input row, repeated rows included; an empty table gives an empty
    result. ``keep`` may not hold ``text``.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(texts):
        return [pa.array([main_text(t, shared.value) for t in texts], pa.string())]

    return per_text(pages, page, keep, "text string", run)


def learn_and_extract(pages: DataFrame) -> DataFrame:
    """Train on labelled pages made of sampled block texts, then extract every page.

    Returns ``page_id``, ``url``, ``text`` and ``n_chars`` (code points).
    """
    model = train(labelled_pages(training_sentences(pages), TRAINING_PAGES))
    return extract(pages, model, ["page_id", "url"]).withColumn("n_chars", F.length("text").cast("long"))
