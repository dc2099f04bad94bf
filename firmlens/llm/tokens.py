"""Token ids of whole texts by the tokenizers library, once per distinct piece of text."""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pattern by which a byte-level pre-tokenizer splits text before merging.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PLANE = 1 << 16  # code points that ``plane_splitter`` knows
BEYOND_PLANE = re.compile("[^\0-\uffff]")
WINDOW = 1 << 20  # code points that are split at a time
MEMO = 400_000  # pieces in one generation of a Python worker's memory
LONGEST_KEY = 64  # code points of a piece that is remembered
BATCH_CHARS = 1 << 22  # code points of the texts that are encoded together


def public_path(name: str) -> str:
    """Where the public tokenizers lie on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: itself where it is printable, else one from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}


@lru_cache(maxsize=1)
def plane_splitter() -> re.Pattern:
    """``BYTE_LEVEL_PATTERN`` for texts of the first 65,536 code points, with its classes written out as the regex library knows them.

    Python's own library matches such classes by bit maps, in about half the time. Alternatives that begin with different code
    points are in another order, the frequent ones first.
    """
    every = "".join(chr(c) for c in range(PLANE) if not 0xD800 <= c < 0xE000)

    def members(kind: str) -> str:
        runs = (m[0] for m in regex.finditer(kind + "+", every))
        return "".join(f"{re.escape(r[0])}-{re.escape(r[-1])}" for r in runs)

    letter, number, space = members(r"\p{L}"), members(r"\p{N}"), members(r"\s")
    known = f"{space}{letter}{number}"
    return re.compile(
        f" ?(?:[{letter}]+|[{number}]+|[^'{known}][^{known}]*)|'(?:[stmd]|re|ve|ll)| ?'[^{known}]*|[{space}]+(?![^{space}])|[{space}]+"
    )


LETTER, NUMBER, SPACE, OTHER = range(4)


@lru_cache(maxsize=1)
def kinds() -> np.ndarray:
    """For every code point the class by which ``BYTE_LEVEL_PATTERN`` tells it from others."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "\ufffd" for c in range(len(out)))
    for kind, name in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(name, every):
            out[m.start() : m.end()] = kind
    return out


def piece_starts(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where the pieces of ``BYTE_LEVEL_PATTERN`` begin in texts that lie behind one another; ``begins`` are their own places.

    A piece is a run of one class, but: the last of several spaces stands apart, a blank goes to what follows it, and an apostrophe
    that starts a piece takes the letters of a contraction, which leave the run that they begin.
    """
    kind = kinds()[points]
    change = np.ones(len(points) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    border = np.zeros(len(points) + 1, bool)
    border[begins] = border[-1] = True
    start = change | border
    # Spaces with something behind them in their text: ``\s+(?!\S)`` leaves the last one.
    last = np.flatnonzero((kind == SPACE) & change[1:] & ~border[1:])
    start[last] = True
    start[last[points[last] == ord(" ")] + 1] = False
    quote = np.flatnonzero(points == ord("'"))
    quote = quote[start[quote] & ~border[quote + 1]]
    one, two = points[quote + 1], np.where(border[quote + 2], 0, np.append(points, 0)[quote + 2])
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    start[quote[short | long] + 1] = False
    start[quote[short] + 2] = True
    start[quote[long] + 3] = True
    return np.flatnonzero(start[:-1])


class PieceEncoder:
    """Whole texts to little-endian unsigned 32-bit ids, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them.

    A byte-level tokenizer without normalizer treats the pieces of its split pattern on their own, so the library's model
    is asked once for each distinct piece and its answer is remembered. Strings of special tokens are cut out first, as
    the library does. Tokenizers of other kinds get whole texts.
    """

    def __init__(self, path: str, memo: int = MEMO):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        split = form.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        added = form.get("added_tokens") or []
        odd = any(a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"] for a in added)
        self.by_piece = plain and not odd and form.get("normalizer") is None and form.get("post_processor") is None
        self.special = {a["content"]: int(a["id"]).to_bytes(4, "little") for a in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if added else None
        self.pieces = regex.compile(BYTE_LEVEL_PATTERN)
        self.letters = byte_letters()
        self.model = self.library.model
        self.ids = {i: i.to_bytes(4, "little") for i in self.library.get_vocab().values()}
        self.memo = Memory(memo, self._piece)

    def _piece(self, piece: str) -> bytes:
        ids = self.ids
        if piece.isascii() and piece.isprintable():
            letters = piece.replace(" ", self.letters[0x20])
        else:
            letters = piece.encode("utf-8", "replace").decode("latin-1").translate(self.letters)
        return b"".join([ids[t.id] for t in self.model.tokenize(letters)])

    def _ask(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), 512):
            got = self.library.encode_batch(texts[i : i + 512], add_special_tokens=False)
            out += [b"".join(t.to_bytes(4, "little") for t in e.ids) for e in got]
        return out

    def _windows(self, text: str) -> Iterator[list[str]]:
        """The pieces of a text, a window at a time; the last two of a window may go on behind it and are split again."""
        pieces = self.pieces if BEYOND_PLANE.search(text) else plane_splitter()
        at, size = 0, WINDOW
        while at < len(text):
            found = pieces.findall(text[at : at + size])
            if at + size < len(text):
                done = found[:-2]
                if not done:
                    size *= 2
                    continue
                found = done
            yield found
            at, size = at + sum(map(len, found)), WINDOW

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.by_piece:
            return self._ask(texts)
        out, run, chars = [], [], 0
        for text in texts:
            if run and chars + len(text) > WINDOW:
                out += self._together(run)
                run, chars = [], 0
            run.append(text)
            chars += len(text)
        return out + self._together(run)

    def _together(self, texts: list[str]) -> list[bytes]:
        """The ids of texts of a window's size together: split at once, and each distinct piece is looked up once."""
        joined = "".join(texts)
        if not joined or len(joined) > WINDOW or any(s in joined for s in self.special):
            return [b"".join(self._parts(t)) for t in texts]
        octets = joined.encode("utf-8", "replace")
        points = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
        ends = np.cumsum([len(t) for t in texts])
        starts = piece_starts(points, np.append(0, ends[:-1]))
        at = np.append(starts, len(points)).astype(np.int32)
        if len(octets) > len(points):
            width = 1 + (points >= 0x80).view(np.uint8) + (points >= 0x800) + (points >= 0x10000)
            at = np.append(0, np.cumsum(width, dtype=np.int32))[at].astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(at), pa.py_buffer(octets)).dictionary_encode()
        found = list(self.memo.of(pieces.dictionary.to_numpy(zero_copy_only=False).tolist()))
        length = np.fromiter(map(len, found), np.int64, len(found)) // 4
        place, which = np.cumsum(length) - length, pieces.indices.to_numpy()
        each = length[which]
        before = np.append(0, np.cumsum(each))
        source = np.repeat(place[which] - before[:-1], each) + np.arange(before[-1])
        ids = np.frombuffer(b"".join(found), "<u4")[source].tobytes()
        cuts = [0, *(4 * before[np.searchsorted(starts, ends)]).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _parts(self, text: str) -> Iterator[bytes]:
        marked = any(s in text for s in self.special)
        for k, part in enumerate(self.cut.split(text) if marked else [text]):
            if k % 2:
                yield self.special[part]
            elif part:
                yield from (b"".join(self.memo.of(pieces)) for pieces in self._windows(part))


class Generation(dict):
    """Answers by key; a key that is not here is looked for with ``find``."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find

    def __missing__(self, key: str) -> bytes:
        value = self.find(key)
        if len(key) <= LONGEST_KEY:
            self[key] = value
        return value


class Memory:
    """Remembered answers in two generations: the older one goes when the younger is full, what is used moves on."""

    def __init__(self, entries: int, ask: Callable[[str], bytes]):
        self.entries, self.ask, self.young, self.old = entries, ask, Generation(self._find), {}

    def _find(self, key: str) -> bytes:
        return self.old.get(key) or self.ask(key)

    def of(self, keys: list[str]) -> Iterator[bytes]:
        """The answers one by one; only for keys that the younger generation lacks is any Python run."""
        if len(self.young) > self.entries:
            self.young, self.old = Generation(self._find), self.young
        return map(self.young.__getitem__, keys)


@lru_cache(maxsize=2)
def encoder(path: str, memo: int = MEMO) -> PieceEncoder:
    """One per Python worker, tokenizer and size of memory."""
    return PieceEncoder(path, memo)


def give_back() -> None:
    """A worker that served other stages gives back what they left."""
    gc.collect()
    pa.default_memory_pool().release_unused()


def text_runs(texts: Iterable[str | None] | pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of bounded size together, each with the place of its first; NULL becomes empty.

    A column of an Arrow batch becomes Python strings run by run, not all at once.
    """
    start, run, chars = 0, [], 0
    for k, text in enumerate(texts):
        run.append((text.as_py() if isinstance(text, pa.Scalar) else text) or "")
        chars += len(run[-1])
        if chars >= BATCH_CHARS:
            yield start, run
            start, run, chars = k + 1, [], 0
    if run:
        yield start, run


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int | None, id_col: str = "doc_id", text_col: str = "text", memo: int = MEMO) -> DataFrame:
    """Every document as pieces of at most ``capacity`` ids: id, ``piece``, ``start``, ``length``, ``ids`` (binary, little-endian 32 bit).

    ``end_id`` follows each document's ids. Longer documents are cut so that all but their first piece are full. A NULL
    text is empty; a document without any id has no piece. ``memo`` bounds what a Python worker remembers (pieces in one of two
    generations, about 200 bytes each); it changes time and memory, not results.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids binary"
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        enc = encoder(path, memo)
        for batch in batches:
            keys = batch.column(0)
            for first, run in text_runs(batch.column(1)):
                at, piece, start, ids = [], [], [], []
                for k, got in enumerate(enc.encode(run)):
                    got += end
                    n = len(got) // 4
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n else []
                    for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        at.append(first + k)
                        piece.append(p)
                        start.append(a)
                        ids.append(got[4 * a : 4 * b])
                yield pa.RecordBatch.from_arrays(
                    [keys.take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=[id_col, "piece", "start", "length", "ids"],
                )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, schema)
