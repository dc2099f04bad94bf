"""Token pieces, packing and id files against the library, brute force and round trips."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from firmlens.llm import packing, planes, tokens
from firmlens.session import scratch_path

pytest.importorskip("public_tokenizers")
PATH = tokens.public_path("byte_bpe_50k.json")
ODD = ["", None, "a", "hello  world's 'tis\n\n", "<|endoftext|>x<|endoftext|>", "é漢字\x1c\x85  ", "word " * 3000, "x" * 5000]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def _ids(library, text, end):
    return np.array(library.encode(text or "", add_special_tokens=False).ids + [end], "<u4")


def _docs(spark, texts, ids=None):
    rows = [(k if ids is None else ids[k], t, "extra", -1) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, _part string, length int")


def test_pieces_split_anywhere_equal_the_library(library, monkeypatch):
    rng = random.Random(3)
    letters = [*"aAb  \n\t'srevmld09.,!é漢\x1c\x85​", "'re", "<|endoftext|>", "'ll"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 60))) for _ in range(400)]
    for window in (1 << 20, 5):
        monkeypatch.setattr(tokens, "WINDOW", window)
        got = [np.frombuffer(b, "<u4").tolist() for b in tokens.PieceEncoder(PATH).encode(texts)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_texts_encoded_together_are_split_as_one_by_one():
    rng = random.Random(7)
    letters = [*"aAb  \n\t''srevmldt09.,!é漢\x1c\x85\u3000😀", "'re", "'ll", "  "]
    pattern = tokens.regex.compile(tokens.BYTE_LEVEL_PATTERN)
    for _ in range(300):
        texts = ["".join(rng.choices(letters, k=rng.choice([0, 1, 2, 3, 9]))) for _ in range(5)] + ["x"]
        begins = np.cumsum([0, *map(len, texts[:-1])])
        points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        assert tokens.piece_starts(points, begins).tolist() == [b + m.start() for b, t in zip(begins, texts) for m in pattern.finditer(t)]


def test_each_distinct_piece_of_a_window_is_looked_up_once(monkeypatch):
    enc, looked = tokens.PieceEncoder(PATH), []
    of = enc.memo.of
    monkeypatch.setattr(enc.memo, "of", lambda keys: looked.extend(keys) or of(keys))
    texts = ["one two one"] * 50 + ["", "two 2 one"]
    assert enc.encode(texts) == enc._ask(texts)
    assert sorted(looked) == sorted(["one", " two", " one", "two", " 2"])


def test_packing_of_odd_documents(spark, library):
    pieces = tokens.token_pieces(_docs(spark, ODD), PATH, 64, 2)
    packed = packing.pack(pieces, 64).collect()
    by_doc, by_sequence = {}, {}
    for r in packed:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for k, text in enumerate(ODD):
        rows = sorted(by_doc[k], key=lambda r: r.piece)
        want = _ids(library, text, 2)
        assert [r.piece for r in rows] == list(range(len(rows)))
        assert (np.frombuffer(b"".join(bytes(r.ids) for r in rows), "<u4") == want).all()
        assert [r.start for r in rows] == [sum(x.length for x in rows[:i]) for i in range(len(rows))]
        assert all(r.length == 64 for r in rows[1:])
    for seats in by_sequence.values():
        ends = [0] + [o + n for o, n in sorted(seats)]
        assert [o for o, _ in sorted(seats)] == ends[:-1] and ends[-1] <= 64
    assert packing.pack(tokens.token_pieces(_docs(spark, []), PATH, 64, 2), 64).count() == 0


def _fewest(lengths, capacity):
    """Brute force: the least number of bins."""
    best = len(lengths)

    def place(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for i in sorted({r: i for i, r in enumerate(rooms) if r >= lengths[k]}.values()):
            place(k + 1, rooms[:i] + [rooms[i] - lengths[k]] + rooms[i + 1:])
        place(k + 1, [*rooms, capacity - lengths[k]])

    place(0, [])
    return best


def test_dominance_keeps_the_optimum():
    rng = random.Random(5)
    for _ in range(150):
        capacity = rng.choice([10, 12, 20])
        lengths = sorted((rng.randint(1, capacity) for _ in range(rng.randint(1, 9))), reverse=True)
        fixed, rest = packing.reduce_by_dominance(Counter(lengths), capacity)
        left = [s for s, n in rest.items() for _ in range(n)]
        used = Counter(s for p, n in fixed for s in p * n) + Counter(left)
        assert used == Counter(lengths) and all(sum(p) <= capacity for p, _ in fixed)
        assert sum(n for _, n in fixed) + _fewest(sorted(left, reverse=True), capacity) == _fewest(lengths, capacity)


def _best_fit_one_by_one(lengths, capacity):
    rooms = []
    for s in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= s]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= s
        else:
            rooms.append(capacity - s)
    return sorted(rooms)


def test_best_fit_by_counts_equals_best_fit_by_items():
    rng = random.Random(6)
    for _ in range(300):
        capacity = rng.choice([7, 16, 40])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
        plan = packing.best_fit(Counter(lengths), capacity)
        assert sorted(capacity - sum(p) for p, n in plan for _ in range(n)) == _best_fit_one_by_one(lengths, capacity)


def test_lengths_out_of_range_fail(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 9)], "doc_id long, length long"), 8)


def test_hot_length_gets_seats_of_its_own(spark):
    items = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 5L, id % 8 + 1) AS length").repartition(7)
    rows = packing.pack(items, 8).collect()
    taken = Counter((r.sequence_id, r.offset + k) for r in rows for k in range(r.length))
    assert len(rows) == 3000 and max(taken.values()) == 1 and all(p < 8 for _, p in taken)


@pytest.mark.parametrize("n", [1, 7, 8, 16384, 40001])
@pytest.mark.parametrize("top", [1, 2, 50257, 2**32])
def test_planes_round_trip(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype("<u4")
    counts, sizes, data = planes.encode_chunk(ids)
    assert (planes.decode_chunk(n, counts, sizes, data) == ids).all()


@pytest.mark.parametrize("chunk", [1, 50, 65536])
def test_id_files(spark, library, monkeypatch, chunk):
    monkeypatch.setattr(planes, "CHUNK", chunk)
    keys = [5, 3, 900, None, 3, -2, 11, 12]
    docs = _docs(spark, ODD, keys).repartition(3)
    got = planes.read_ids(spark, planes.write_ids(docs, scratch_path(spark, "ids"), PATH, 0)).orderBy("start").collect()
    want = {(k, zlib.crc32(_ids(library, t, 0).tobytes())) for k, t in zip(keys, ODD)}
    assert {(r.doc_id, zlib.crc32(bytes(r.ids))) for r in got} == want and len(got) == len(ODD)
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(len(got))]
    assert all(len(r.ids) == 4 * r.n_tokens for r in got)


def test_no_documents_no_ids(spark):
    assert planes.read_ids(spark, planes.write_ids(_docs(spark, []), scratch_path(spark, "ids"), PATH, 0)).count() == 0


def test_a_small_memory_gives_the_same_pieces(spark):
    rows = [[sorted(map(tuple, tokens.token_pieces(_docs(spark, ODD), PATH, 64, 2, memo=n).collect()))] for n in (1, tokens.MEMO)]
    assert rows[0] == rows[1] and tokens.PieceEncoder(PATH, 7).memo.entries == 7


def test_the_plane_splitter_splits_like_the_pattern():
    import regex

    pattern = regex.compile(tokens.BYTE_LEVEL_PATTERN)
    plane = [chr(c) for c in range(tokens.PLANE) if not 0xD800 <= c < 0xE000]
    for c in plane:
        text = f"a{c}{c}b {c}1'{c}s {c}\n {c}"
        assert tokens.plane_splitter().findall(text) == pattern.findall(text)
    rng, common = random.Random(8), [*"  \n\t'''srevmtld09.,!aB_²½\x1c\x85\xa0"]
    for _ in range(3000):
        text = "".join(rng.choice(common if rng.random() < 0.7 else plane) for _ in range(rng.randint(0, 40)))
        assert tokens.plane_splitter().findall(text) == pattern.findall(text)


def test_pieces_that_are_remembered_run_no_python(library, monkeypatch):
    enc, looked = tokens.PieceEncoder(PATH), []
    monkeypatch.setattr(enc.memo, "ask", lambda key, ask=enc.memo.ask: looked.append(key) or ask(key))
    texts = ["the cat, the dog and the cat 😀 again", "the cat and the dog"] * 3
    got = [np.frombuffer(b, "<u4").tolist() for b in enc.encode(texts)]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(looked) == len(set(looked)) and set(looked) == set(enc.memo.young)
    enc.memo.entries = 0  # what is used moves on to the younger generation without a question
    assert enc.encode(texts[:1])[0] == np.array(got[0], "<u4").tobytes()
    assert len(looked) == len(set(looked)) and enc.memo.old
