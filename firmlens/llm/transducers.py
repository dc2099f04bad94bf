"""Token counts by finite-state transducers: one finds the pieces of a text, one counts the tokens of a piece."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firmlens.llm.tokens import byte_letters

CHUNK = 512  # code points whose state map is computed in one go
RUN_CHARS = 1 << 20  # code points that a worker holds as arrays at a time
MAX_STATES = 120_000  # compiled states of the token transducer before it starts anew
LONG_PIECE = 512  # bytes after which a piece is followed alone

#: Fixed value: the pattern by which this kind of tokenizer finds its pieces.
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Classes of code points, and states after a code point, of the piece transducer.
SPACE, LETTER, NUMBER, SIGN, TICK_CHAR, SHORT, CHAR_R, CHAR_V, CHAR_L, CHAR_E = range(10)
GAP, WORD, DIGIT, SIGNS, TICK, TICK_R, TICK_V, TICK_L, DONE = range(9)
BEGINS, BEGAN = 1, 2  # a piece begins at this code point; one began at the last
LETTERS = {LETTER, SHORT, CHAR_R, CHAR_V, CHAR_L, CHAR_E}


def _piece_step(state: int, kind: int) -> tuple[int, int]:
    """The piece transducer: next state and marks. What follows ``'r``, ``'v``, ``'l`` decides about the last mark."""
    if state == TICK:
        undecided = {SHORT: DONE, CHAR_R: TICK_R, CHAR_V: TICK_V, CHAR_L: TICK_L, SIGN: SIGNS, TICK_CHAR: SIGNS}
        if kind in undecided:
            return undecided[kind], 0
    elif state in (TICK_R, TICK_V, TICK_L):
        if kind == (CHAR_L if state == TICK_L else CHAR_E):
            return DONE, 0
        after, marks = _piece_step(WORD, kind)
        return after, marks | BEGAN
    if kind == SPACE:
        return GAP, 0
    if kind in LETTERS:
        return WORD, 0 if state == WORD else BEGINS
    if kind == NUMBER:
        return DIGIT, BEGINS
    if state == SIGNS:
        return SIGNS, 0
    return (TICK if kind == TICK_CHAR else SIGNS), BEGINS


_STEPS = [[_piece_step(s, k) for k in range(10)] for s in range(9)]
PIECE_NEXT = np.array([[a for a, _ in row] for row in _STEPS], np.uint8)
PIECE_MARKS = np.array([[m for _, m in row] for row in _STEPS], np.uint8)


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, SIGN, np.uint8)
    every = "".join(chr(c) if not 0xD800 <= c < 0xE000 else "!" for c in range(0x110000))
    for pattern, kind in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", SPACE)):
        for m in regex.finditer(pattern, every):
            out[m.start() : m.end()] = kind
    for letters, kind in (("'", TICK_CHAR), ("stmd", SHORT), ("r", CHAR_R), ("v", CHAR_V), ("l", CHAR_L), ("e", CHAR_E)):
        out[[ord(c) for c in letters]] = kind
    return out


def compose(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """State maps one after the other, row by row: the associative operation of the scan."""
    return np.take_along_axis(then, first, axis=1)


def scan_maps(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix scan of state maps in log2(n) rounds."""
    maps, step = maps.astype(np.int64), 1
    while step < len(maps):
        maps[step:] = compose(maps[:-step].copy(), maps[step:])
        step *= 2
    return maps


def piece_marks(kinds: np.ndarray) -> np.ndarray:
    """Where pieces begin. Chunks are mapped from every state side by side, maps composed by a scan, marks then read off.

    The last code point must be a space.
    """
    rows = -(-len(kinds) // CHUNK)
    grid = np.full((rows, CHUNK), SPACE, np.uint8)
    grid.ravel()[: len(kinds)] = kinds
    columns = np.ascontiguousarray(grid.T)
    flat, marks = PIECE_NEXT.ravel(), np.empty((CHUNK, rows), np.uint8)
    states = np.repeat(np.arange(9, dtype=np.uint8)[:, None], rows, axis=1)
    for column in columns:
        states = flat[states * np.uint8(10) + column]
    entry = np.zeros(rows, np.uint8)
    entry[1:] = scan_maps(states.T)[:-1, GAP]
    for c, column in enumerate(columns):
        at = entry * np.uint8(10) + column
        marks[c] = PIECE_MARKS.ravel()[at]
        entry = flat[at]
    found = np.ascontiguousarray(marks.T).ravel()[: len(kinds)]
    begins = (found & BEGINS).astype(bool)
    begins[:-1] |= (found[1:] & BEGAN).astype(bool)
    return begins


class TokenTransducer:
    """Counts the tokens of a piece, symbol by symbol; states are compiled when they are first met.

    The symbols are 256 bytes and the same bytes as the end of a piece. A byte-pair encoding is the one segmentation of a
    piece whose neighbours are all stable, that is, merging the two alone gives them back. So the last token of every
    prefix follows from the last tokens of shorter prefixes, as far back as a token may reach. A state keeps
    exactly these: for every start from which some token can still be completed, its place in the trie of tokens, the
    last token before it, and its token count against that of the whole prefix. States are finite in number; a
    transition is annotated with the change of the token count, and their sum over a piece is its number of tokens.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        model = form["model"]
        split = (form["pre_tokenizer"].get("pretokenizers") or [{}])[0]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != "</w>" or split.get("pattern", {}).get("Regex") != PIECE_PATTERN:
            raise ValueError("only byte-pair tokenizers with word ends and this split pattern are compiled")
        kinds = [n["type"] for n in form["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"unknown normalizers {kinds}")
        letter = {c: b for b, c in byte_letters().items()}

        def symbols(token: str) -> tuple[int, ...]:
            ends = token.endswith("</w>")
            out = [letter[c] for c in (token[:-4] if ends else token)]
            return (*out[:-1], out[-1] + 256) if ends else tuple(out)

        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.name = {symbols(t): k for t, k in model["vocab"].items()}
        self.spelled = {k: s for s, k in self.name.items()}
        vocab = model["vocab"]
        self.merge = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for spelled, token in self.name.items():
            node = 0
            for s in spelled:
                if s not in self.children[node]:
                    self.children[node][s] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                node = self.children[node][s]
            self.token_at[node] = token
        self.special = [a["content"] for a in form["added_tokens"]]
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.start_anew()

    def start_anew(self) -> None:
        """Forgets compiled states, so that a worker's memory is bounded; nothing else depends on them."""
        first = ((0, -1, 0),)
        self.states, self.number = [first], {first: 0}
        self.stable: dict[tuple[int, int], bool] = {}
        self.column = np.full(512, -1, np.int64)
        self.columns = 0
        self.table = np.full((1024, 64), -1, np.int32)

    def is_stable(self, left: int, right: int) -> bool:
        """Whether merging the symbols of both tokens together gives just these two."""
        known = self.stable.get((left, right))
        if known is None:
            tokens = [self.name[(s,)] for s in self.spelled[left] + self.spelled[right]]
            while len(tokens) > 2:
                best = min((self.merge[p] + (i,) for i, p in enumerate(zip(tokens, tokens[1:])) if p in self.merge), key=lambda m: (m[0], m[2]), default=None)
                if best is None:
                    break
                tokens[best[2] : best[2] + 2] = [best[1]]
            known = self.stable[left, right] = tokens == [left, right] and (left, right) not in self.merge
        return known

    def compile(self, state: int, symbol: int) -> int:
        """The transition of ``state`` on ``symbol``: number of the next state and the annotation, as the table holds them."""
        moved = []
        last = change = None
        for node, before, against in self.states[state]:
            child = self.children[node].get(symbol)
            if child is None:
                continue
            token = self.token_at[child]
            if last is None and token >= 0 and (before < 0 or self.is_stable(before, token)):
                last, change = token, against + 1
            if self.children[child]:
                moved.append((child, before, against))
        after = tuple((c, b, a - change) for c, b, a in moved) + ((0, last, 0),) if symbol < 256 else self.states[0]
        number = self.number.setdefault(after, len(self.states))
        if number == len(self.states):
            self.states.append(after)
        return number * 64 + change + 32

    def _fill(self, state: np.ndarray, symbol: np.ndarray) -> None:
        for pair in np.unique(state * 512 + symbol).tolist():
            s, x = divmod(pair, 512)
            if self.column[x] < 0:
                self.column[x] = self.columns
                self.columns += 1
            value = self.compile(s, x)
            high, wide = self.table.shape
            if len(self.states) > high or self.columns > wide:
                grown = np.full((high * (2 if len(self.states) > high else 1), wide * (2 if self.columns > wide else 1)), -1, np.int32)
                grown[:high, :wide] = self.table
                self.table = grown
            self.table[s, self.column[x]] = value

    def _follow(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        column = self.column[symbol]
        if (column < 0).any():
            self._fill(state[column < 0], symbol[column < 0])
            column = self.column[symbol]
        value = self.table[state, column]
        if (missing := value < 0).any():
            self._fill(state[missing], symbol[missing])
            value = self.table[state, column]
        return value

    def count(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each piece, all pieces side by side."""
        if len(self.states) > MAX_STATES:
            self.start_anew()
        order = np.argsort(-lengths, kind="stable")
        start, left = starts[order], -np.sort(-lengths)
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for k in range(min(LONG_PIECE, int(left[0]) if len(left) else 0)):
            m = int(np.searchsorted(-left, -k, side="left"))  # pieces longer than k
            value = self._follow(state[:m], symbols[start[:m] + k])
            state[:m] = value >> 6
            total[:m] += (value & 63) - 32
        for i in range(int(np.searchsorted(-left, -LONG_PIECE, side="left"))):
            at, known = int(state[i]), {}
            for x in symbols[start[i] + LONG_PIECE : start[i] + left[i]].tolist():
                value = known.get((at, x))
                if value is None:
                    value = known[at, x] = self.compile(at, x)
                at = value >> 6
                total[i] += (value & 63) - 32
        out = np.empty_like(total)
        out[order] = total
        return out

    def parts(self, text: str) -> tuple[list[str], int]:
        """The normalised text between special strings, and how many of those there are."""
        found = self.cut.split(text) if self.cut else [text]
        # Lower-casing goes code point by code point: no form for the end of a word.
        return [unicodedata.normalize("NFC", p).replace("Σ", "σ").lower() for p in found[::2] if p], len(found) // 2

    def count_run(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text of a run; spaces between texts end every piece."""
        whole = " ".join(texts) + " "
        points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        kinds = classes()[points]
        begins = np.flatnonzero(piece_marks(kinds))
        stops = np.flatnonzero(kinds == SPACE)
        ends = np.minimum(np.append(begins[1:], len(points)), stops[np.searchsorted(stops, begins)]) if len(begins) else begins
        place = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF), out=place[1:])
        symbols = np.frombuffer(whole.encode("utf-8"), np.uint8).astype(np.int64)
        symbols[place[ends] - 1] += 256
        counts = self.count(symbols, place[begins], place[ends] - place[begins])
        first = np.cumsum([0] + [len(t) + 1 for t in texts])
        sums = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(sums[np.searchsorted(begins, first)])

    def count_texts(self, texts: list[str | None]) -> list[int]:
        """Tokens of whole texts, in runs of bounded size; a long text is cut before a white space."""
        totals, run, owners, size = [0] * len(texts), [], [], 0

        def flush() -> None:
            for owner, n in zip(owners, self.count_run(run).tolist() if run else []):
                totals[owner] += n
            run.clear()
            owners.clear()

        space = regex.compile(r"\s")
        for k, text in enumerate(texts):
            parts, specials = self.parts(text or "")
            totals[k] += specials
            for part in parts:
                at = 0
                while at < len(part):
                    stop = space.search(part, at + RUN_CHARS) if len(part) - at > RUN_CHARS else None
                    end = stop.start() if stop else len(part)
                    run.append(part[at:end])
                    owners.append(k)
                    size, at = size + end - at, end
                    if size >= RUN_CHARS:
                        flush()
                        size = 0
        flush()
        return totals


@lru_cache(maxsize=1)
def transducer(path: str) -> TokenTransducer:
    """One per Python worker."""
    return TokenTransducer(path)


def count_tokens(docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_bytes`` (UTF-8), ``n_tokens`` of the whole text, ``over_limit`` (more than ``limit``).

    Counts equal those of the tokenizers library for the file at ``path`` without added special tokens; strings of special
    tokens inside a text count as one token. No shuffle: each task reads its texts in bounded runs. NULL texts are empty
    and have no tokens; repeated rows stay repeated; an empty table gives no rows; other columns are ignored.
    """
    schema = f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = machine.count_texts(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len((t or "").encode("utf-8")) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([c > limit for c in n], pa.bool_())],
                names=[id_col, "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(count, schema)
