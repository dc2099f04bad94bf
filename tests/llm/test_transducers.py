"""Token counts against the library, on odd texts and in every way of cutting them."""

import random

import numpy as np
import pytest

from firmlens.llm import tokens, transducers

pytest.importorskip("public_tokenizers")
PATH = tokens.public_path("word_bpe_49k.json")
LETTERS = [*"aAbBeE  \n\t'srevmld09.,!é漢\x1cßİΣ😀́", "'re", "<|endoftext|>", "'ll", "'ve", "the", "ing", "<|startoftext|>", "''"]


@pytest.fixture(scope="module")
def count():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    return lambda text: len(library.encode(text or "", add_special_tokens=False).ids)


@pytest.fixture(scope="module")
def machine():
    return transducers.TokenTransducer(PATH)


@pytest.mark.parametrize("chunk, long_piece, states", [(512, 512, 10**6), (3, 4, 10**6), (16, 2, 50)])
def test_odd_texts(machine, count, monkeypatch, chunk, long_piece, states):
    monkeypatch.setattr(transducers, "CHUNK", chunk)
    monkeypatch.setattr(transducers, "LONG_PIECE", long_piece)
    monkeypatch.setattr(transducers, "MAX_STATES", states)
    rng = random.Random(chunk)
    for _ in range(5):
        texts = ["".join(rng.choices(LETTERS, k=rng.randint(0, 50))) for _ in range(200)]
        assert machine.count_texts(texts) == [count(t) for t in texts]


def test_long_texts_are_cut_anywhere(machine, count, monkeypatch):
    monkeypatch.setattr(transducers, "RUN_CHARS", 20)
    rng = random.Random(9)
    texts = ["".join(rng.choices(LETTERS, k=400)) for _ in range(20)] + ["a" * 500, "word's " * 90, "", None]
    assert machine.count_texts(texts) == [count(t) for t in texts]


def test_scan_equals_steps():
    rng = np.random.default_rng(1)
    maps = rng.integers(0, 9, (37, 9))
    state, want = np.arange(9), []
    for m in maps:
        state = m[state]
        want.append(state)
    assert (transducers.scan_maps(maps) == np.array(want)).all()


def test_table(spark, count):
    texts = ["The cat's", "", None, "x" * 3000, "hello " * 3000, "hello " * 3000]
    docs = spark.createDataFrame([(k if k < 5 else None, t, 7) for k, t in enumerate(texts)], "doc_id long, text string, n_tokens long")
    rows = transducers.count_tokens(docs, PATH, 2048).collect()
    assert [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows] == [
        (k if k < 5 else None, len(t or ""), count(t), count(t) > 2048) for k, t in enumerate(texts)
    ]
    assert transducers.count_tokens(docs.limit(0), PATH, 2048).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        transducers.TokenTransducer(tokens.public_path("byte_bpe_50k.json"))
