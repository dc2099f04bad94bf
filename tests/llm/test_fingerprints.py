"""Chunks, fingerprints and the order of documents against brute force."""

import hashlib
import random

import numpy as np

from firmlens.llm import fingerprints as fp


def _gear(data):
    h, out = 0, []
    for b in data:
        h = ((h << 1) + int(fp.GEAR[b])) & 0xFFFFFFFF
        out.append(h)
    return out


def _chunks(data):
    """One byte at a time, as a rolling hash would."""
    h, at, cuts = _gear(data), 0, []
    while at < len(data):
        cut = min(at + fp.MOST, len(data))
        for p in range(at, cut):
            size = p - at + 1
            if size >= fp.LEAST and h[p] & int(fp.HARD if size < fp.NORMAL else fp.EASY) == 0:
                cut = p + 1
                break
        cuts.append(data[at:cut])
        at = cut
    return cuts


def _text(rng, n):
    return "".join(rng.choices("abcdefghij éß漢 ", k=n))


def test_gear_equals_rolling_hash():
    data = np.random.default_rng(1).integers(0, 256, 500).astype(np.uint8)
    assert fp.gear(data).tolist() == _gear(data.tolist())


def test_chunks_equal_those_byte_by_byte():
    rng = random.Random(1)
    texts = [_text(rng, n).encode() for n in (0, 1, 31, 32, 33, 64, 100, 5000, 700)] + [b"", b"x" * 3000]
    for text, got in zip(texts, fp.chunk_texts(texts)):
        want = {fp.xxhash.xxh3_64_intdigest(c) >> 8: len(c) for c in _chunks(text)}
        assert got == want and fp.parsed(fp.written(got)) == got


def test_chunks_resist_shifts():
    rng = random.Random(2)
    text = _text(rng, 20000)
    a, b = fp.chunk_texts([text.encode(), (text[:900] + "new words" + text[900:]).encode()])
    assert fp.likeness(a, b) > 0.95 and fp.likeness(a, a) == 1.0
    assert fp.likeness(a, fp.chunk_texts([_text(rng, 20000).encode()])[0]) < 0.02
    assert fp.likeness({}, {}) == 1.0 and fp.likeness(a, {}) == 0.0 and fp.likeness({}, a) == 0.0


def _want(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        a, b, c = fp.chunk_texts([t.encode(), e.encode(), n.encode()])
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fp.written(a), fp.written(b), fp.likeness(a, b), fp.likeness(a, c)))
    return out


def _got(spark, rows, parts=3):
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, n_chars int, _text string").repartition(parts)
    return [tuple(r) for r in fp.fingerprints(docs).collect()]


def test_next_document_across_partitions(spark, monkeypatch):
    monkeypatch.setattr(fp, "RUN_BYTES", 2000)
    rng = random.Random(3)
    ids = rng.sample(range(-500, 5000), 300)
    rows = [(i, rng.choice([None, "", "short", _text(rng, rng.randint(1, 1500))])) for i in ids] + [(None, "no id")]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(_got(spark, rows), key=key) == sorted(_want(rows), key=key)


def test_few_and_equal_documents(spark):
    assert _got(spark, []) == []
    assert _got(spark, [(7, "alone in the world")]) == _want([(7, "alone in the world")])
    same = _got(spark, [(k, "the same text " * 30) for k in range(40)] + [(5, "the same text " * 30)] * 20)
    assert len(same) == 60 and len({r[3] for r in same}) == 1 and all(r[6] == 1.0 for r in same)
