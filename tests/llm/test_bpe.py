import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from voltaic.llm import bpe
from voltaic.llm.queries import byte_vocabulary


@pytest.fixture(scope="module")
def vocabulary():
    return byte_vocabulary()


@pytest.fixture(scope="module")
def reference(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


TEXTS = [
    None, "", " ", "a", "Hello world's  end\n\n x", "élève ñandú ß 中文字符 🙂🙂", "a" * 5000, "ab" * 777 + " " * 300,
    "the " * 300, "\x00\x01 <|endoftext|>", "x" * 63 + " " + "y" * 64 + " " + "z" * 65, "Thntti12345 ó́", "=" * 200 + "-" * 129,
]


def test_equals_tiktoken(vocabulary, reference):
    ids = vocabulary.coder().encode(TEXTS)
    for t, x in zip(TEXTS, ids):
        assert np.frombuffer(x, "<u4").tolist() == reference.encode_ordinary(t or "")
        assert vocabulary.coder().decode(x) == (t or "").encode()


def test_scalar_and_batched_trees_agree(vocabulary):
    rng = np.random.default_rng(1)
    coder = vocabulary.coder()
    for n in (2, 3, 5, 8, 13, 31, 64):
        words = [bytes(rng.choice(list(b"abetinorsh"), n).astype(np.uint8)) for _ in range(50)]
        width = 1 << (n - 1).bit_length()
        assert coder._encode_batch(words, width) == [coder._encode_long(w) for w in words]


def test_long_text_in_blocks(vocabulary, reference, monkeypatch):
    text = "Das ist eine Übung, isn't it?\n" * 40
    want = np.array(reference.encode_ordinary(text), "<u4").tobytes()
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 10)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    assert vocabulary.coder().encode([text]) == [want]


def test_cache_is_bounded_and_keeps_no_long_word(vocabulary, reference, monkeypatch):
    rng = np.random.default_rng(2)
    blobs = ["".join(rng.choice(list("abcdefgh"), 20_000)) for _ in range(6)]
    coder = vocabulary.coder()
    got = coder.encode([b + " it's 12 " + b[:65] for b in blobs])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [reference.encode_ordinary(b + " it's 12 " + b[:65]) for b in blobs]
    assert max(map(len, coder.new)) <= bpe.BATCH_BYTES
    assert coder.held == sum(len(w) + len(x) for w, x in coder.new.items())
    monkeypatch.setattr(bpe, "CACHE_SIZE", 50)
    for i in range(20):
        words = " ".join(f"qz{i}x{j}" for j in range(9))
        assert np.frombuffer(coder.encode([words])[0], "<u4").tolist() == reference.encode_ordinary(words)
        assert coder.held <= 50 + sum(len(w) + len(x) for w, x in coder.new.items()) and len(coder.new) < 60 and len(coder.old) < 60


def test_frame(spark, vocabulary, reference):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "ab", "y"), (1, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, token_ids string")
    got = bpe.digests(bpe.encode_decode(df, vocabulary)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t, _ in rows[: len(TEXTS)]:
        ids = reference.encode_ordinary(t or "")
        assert by[i].n_tokens == len(ids)
        assert by[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert by[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert bpe.encode_decode(df.limit(0), vocabulary).count() == 0
