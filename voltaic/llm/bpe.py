"""Byte-level BPE encoding and decoding over whole texts.

Each pre-token (a match of the split pattern) is encoded on its own. A
segment tree over its byte positions holds, per position that starts a live
token, the rank of the pair formed with the next live token; every inner node
holds the leftmost minimum of its span. A merge takes the root, joins two
neighbours and updates at most three leaves, each in logarithmic time.

Pre-tokens up to ``BATCH_BYTES`` long share numpy trees, one row per word, so
that one vector step performs one merge in thousands of words; longer ones get
a scalar tree with the same updates.
"""

from __future__ import annotations

import base64
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltaic.llm.common import per_text

#: Fixed value: the split pattern that belongs to the 50k byte vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

BATCH_BYTES = 64
#: Words, and characters and bytes of ids, that a task remembers in each of two
#: generations of its cache. Words over ``BATCH_BYTES`` long are not remembered.
CACHE_WORDS = 200_000
CACHE_SIZE = 16 << 20
#: Characters above which a text is matched and hashed in blocks of words.
BLOCK_CHARS = 1 << 20
NONE = np.int64(1 << 62)


class Vocabulary:
    """Ranks of a byte-level BPE file as flat arrays.

    ``pairs`` holds every (left id, right id) whose joined bytes are a token,
    sorted, beside the joined token's id; in such files id and rank are one.
    """

    def __init__(self, path: str, pattern: str = PATTERN):
        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        ranks = {base64.b64decode(a): int(b) for a, b in rows}
        self.pattern = pattern
        self.size = max(ranks.values()) + 1
        self.ranks = ranks
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the vocabulary lacks {len(missing)} single bytes")
        self.bytes_id = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        keys, ids = [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                left, right = ranks.get(token[:i]), ranks.get(token[i:])
                if left is not None and right is not None:
                    keys.append(left * self.size + right)
                    ids.append(rank)
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.pair_keys = np.array(keys, np.int64)[order]
        self.pair_ids = np.array(ids, np.int64)[order]
        by_id = [b""] * self.size
        for token, rank in ranks.items():
            by_id[rank] = token
        self.by_id = by_id
        self._coders: Coder | None = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_coders"} | {"_coders": None}

    def coder(self) -> Coder:
        if self._coders is None:
            self._coders = Coder(self)
        return self._coders


class Coder:
    """Encodes and decodes with one vocabulary; keeps a bounded word cache."""

    def __init__(self, vocabulary: Vocabulary):
        import regex

        self.v = vocabulary
        self.find = regex.compile(vocabulary.pattern)
        self.pairs = dict(zip(vocabulary.pair_keys.tolist(), vocabulary.pair_ids.tolist()))
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    # ---- pairs -----------------------------------------------------------
    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the joined token, or -1."""
        key = left * self.v.size + right
        at = np.minimum(np.searchsorted(self.v.pair_keys, key), len(self.v.pair_keys) - 1)
        return np.where(self.v.pair_keys[at] == key, self.v.pair_ids[at], -1)

    # ---- one merge in each of many words --------------------------------
    def _encode_batch(self, words: list[bytes], width: int) -> list[bytes]:
        n, bits = len(words), width.bit_length() - 1
        size = np.fromiter(map(len, words), np.int64, n)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        ids = self.v.bytes_id[raw]
        at = np.arange(width, dtype=np.int64)
        following = np.broadcast_to(at + 1, (n, width)).copy()
        before = np.broadcast_to(at - 1, (n, width)).copy()
        tree = np.full((n, 2 * width), NONE, np.int64)
        rank = self._rank(ids[:, :-1], ids[:, 1:])
        good = (rank >= 0) & (at[1:] < size[:, None])
        tree[:, width:-1][good] = ((rank << bits) | at[:-1])[good]
        for level in range(bits - 1, -1, -1):
            low = 1 << level
            tree[:, low : 2 * low] = np.minimum(tree[:, 2 * low : 4 * low : 2], tree[:, 2 * low + 1 : 4 * low : 2])
        live = at < size[:, None]
        rows = np.flatnonzero(tree[:, 1] != NONE)
        while len(rows):
            root = tree[rows, 1]
            here, token = root & (width - 1), root >> bits
            gone = following[rows, here]
            after = following[rows, gone]
            ids[rows, here] = token
            live[rows, gone] = False
            following[rows, here] = after
            inside = after < size[rows]
            before[rows[inside], after[inside]] = here[inside]
            last = np.minimum(after, width - 1)
            joined = np.where(inside, self._rank(token, ids[rows, last]), -1)
            tree[rows, width + here] = np.where(joined >= 0, (joined << bits) | here, NONE)
            tree[rows, width + gone] = NONE
            prev = before[rows, here]
            some = prev >= 0
            left = np.maximum(prev, 0)
            joined = np.where(some, self._rank(ids[rows, left], token), -1)
            r = rows[some]
            tree[r, width + left[some]] = np.where(joined[some] >= 0, (joined[some] << bits) | left[some], NONE)
            node = np.stack([width + here, width + gone, np.where(some, width + left, width + here)])
            for _ in range(bits):
                node >>= 1
                child = 2 * node
                tree[rows, node] = np.minimum(tree[rows, child], tree[rows, child + 1])
            rows = rows[tree[rows, 1] != NONE]
        flat = ids[live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(1) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]

    # ---- one long word ---------------------------------------------------
    def _encode_long(self, word: bytes) -> bytes:
        n = len(word)
        width = 1 << (n - 1).bit_length()
        none, size, pairs = int(NONE), self.v.size, self.pairs
        ids = self.v.bytes_id[np.frombuffer(word, np.uint8)]
        rank = self._rank(ids[:-1], ids[1:])
        leaves = np.full(width, NONE, np.int64)
        leaves[: n - 1] = np.where(rank >= 0, rank * width + np.arange(n - 1), NONE)
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append(np.minimum(levels[-1][::2], levels[-1][1::2]))
        # Flat arrays: about 45 bytes a byte of the word.
        tree = array("q", np.concatenate([[NONE], *reversed(levels)]).tobytes())
        del levels, leaves, rank
        ids = array("i", ids.astype(np.int32).tobytes())
        following, before = array("i", range(1, n + 1)), array("i", range(-1, n - 1))

        def put(at: int, left: int, right: int) -> None:
            joined = pairs.get(left * size + right)
            update(at, none if joined is None else joined * width + at)

        def update(at: int, value: int) -> None:
            node = width + at
            tree[node] = value
            while node > 1:
                node >>= 1
                a, b = tree[2 * node], tree[2 * node + 1]
                best = a if a < b else b
                if tree[node] == best:
                    return
                tree[node] = best

        while (root := tree[1]) != none:
            token, here = divmod(root, width)
            gone = following[here]
            after = following[gone]
            ids[here], ids[gone] = token, -1
            following[here] = after
            update(gone, none)
            if after < n:
                before[after] = here
                put(here, token, ids[after])
            else:
                update(here, none)
            if (prev := before[here]) >= 0:
                put(prev, ids[prev], token)
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    # ---- words and texts -------------------------------------------------
    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        out, groups = {}, {}
        for w in words:
            raw = w.encode()
            whole = self.v.ranks.get(raw)
            if whole is not None:
                out[w] = whole.to_bytes(4, "little")
            elif len(raw) > BATCH_BYTES:
                out[w] = self._encode_long(raw)
            else:
                groups.setdefault(1 << (len(raw) - 1).bit_length(), []).append((w, raw))
        for width, own in groups.items():
            step = max(1, (1 << 17) // width)
            for i in range(0, len(own), step):
                part = own[i : i + step]
                out.update(zip((w for w, _ in part), self._encode_batch([raw for _, raw in part], width)))
        return out

    def _known(self, words: list[str]) -> dict[str, bytes]:
        """Remember the ids of short words; the ids of all long ones."""
        new, old = self.new, self.old
        miss = {w for w in words if w not in new}
        if not miss:
            return {}
        for w in [w for w in miss if w in old]:
            self._remember(w, old[w])
            miss.discard(w)
        long = {}
        for w, ids in self.encode_words(list(miss)).items():
            if len(w) > BATCH_BYTES:
                long[w] = ids
            else:
                self._remember(w, ids)
        return long

    def _remember(self, word: str, ids: bytes) -> None:
        self.new[word] = ids
        self.held += len(word) + len(ids)

    def _turn(self) -> None:
        if len(self.new) > CACHE_WORDS or self.held > CACHE_SIZE:
            self.old, self.new, self.held = self.new, {}, 0

    def _join(self, words: list[str], long: dict[str, bytes]) -> bytes:
        if not long:
            return b"".join(map(self.new.__getitem__, words))
        return b"".join([long[w] if w in long else self.new[w] for w in words])

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text; NULL encodes as the empty text."""
        self._turn()
        split = [self.find.findall(t) if t and len(t) <= BLOCK_CHARS else [] for t in texts]
        long = self._known([w for words in split for w in words])
        # Blocks of a long text may turn the cache, so they come last.
        out = [self._join(words, long) for words in split]
        for i, t in enumerate(texts):
            if t and len(t) > BLOCK_CHARS:
                out[i] = self._encode_blocks(t)
        return out

    def _encode_blocks(self, text: str) -> bytes:
        parts, matches = [], (m.group() for m in self.find.finditer(text))
        while words := list(islice(matches, 1 << 16)):
            parts.append(self._join(words, self._known(words)))
            self._turn()
        return b"".join(parts)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.v.by_id.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_decode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns ``key``, ``token_ids`` (binary: little-endian unsigned 32-bit ids)
    and ``decoded`` (binary: the bytes that the ids stand for). One row per
    input row, repeated rows included; a NULL or empty text has no ids; an
    empty table gives an empty result; other columns are ignored. The
    vocabulary is a bounded file (about 1 MB) and is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(texts):
        coder = shared.value.coder()
        ids = coder.encode(texts)
        return [pa.array(ids, pa.binary()), pa.array([coder.decode(x) for x in ids], pa.binary())]

    return per_text(docs, text, [key], "token_ids binary, decoded binary", run)


def digests(encoded: DataFrame) -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of encoded rows."""
    return encoded.select(
        "doc_id",
        F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
