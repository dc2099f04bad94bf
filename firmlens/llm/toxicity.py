"""Toxicity by compression distance: zstandard dictionaries of ordinary and toxic text, compared window by window."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from firmlens.llm.tokens import give_back, text_runs
from firmlens.session import stored

WINDOW, STEP = 128, 96  # bytes of a window, and from one to the next
LEVEL = 3
ORDINARY_BYTES, TOXIC_BYTES = 64 << 10, 16 << 10  # most bytes of the two dictionaries
FIT_TOXIC, FIT_ORDINARY = 1500, 3000  # most labelled documents that a model is fitted on
PIECE, PIECES = 64, 320  # code points of a piece, and most pieces of such a document that the ordinary dictionary is trained on
FIT_PARTS = 24  # partitions of the labelled documents
EVIDENCE = 3.0  # signed root of the log-likelihood ratio from which a word tells toxic documents from ordinary ones
TOXIC_WORDS = 8192  # most words with evidence, the strongest ones
COPY_WORDS = 10  # documents with fewer rare words are not taken for copies
THRESHOLDS = (2, 3, 4, 5, 6, 8)  # bytes saved from which a window counts
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = ".,;:!?"


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray


def windows(text: str) -> list[bytes]:
    """The whole text, lower-cased, in overlapping windows of its UTF-8 bytes; one (perhaps empty) at least."""
    data = text.lower().encode("utf-8", "replace")
    return [data[a : a + WINDOW] for a in range(0, max(1, len(data) - WINDOW + STEP), STEP)]


def words(text: str) -> Iterator[str]:
    return (w for m in _WORD.finditer(text.lower()) if len(w := m[0].strip(_EDGES)) > 2)


class Gains:
    """Bytes that the toxic dictionary saves in each window, beside the ordinary one."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        def press(content: bytes):
            form = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False)
            if not content:
                return zstandard.ZstdCompressor(compression_params=form).compress
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            return zstandard.ZstdCompressor(compression_params=form, dict_data=known).compress

        self.contents = ordinary, toxic
        self.without, self.beside = press(ordinary), press(ordinary + toxic if toxic else ordinary)

    def features(self, text: str) -> np.ndarray:
        """Largest and mean gain, shares and numbers of windows above the thresholds, number of windows."""
        found = windows(text)
        gain = np.fromiter((len(self.without(w)) - len(self.beside(w)) for w in found), np.int64, len(found))
        above = [int((gain >= t).sum()) for t in THRESHOLDS]
        n = len(found)
        return np.array([gain.max(), gain.mean(), *(a / n for a in above), *(np.log1p(a) for a in above[1::2]), np.log(n)], np.float64)


def _ordinary_dictionary(texts: list[str]) -> bytes:
    samples = [t[i : i + 64] for t in (x.lower().encode("utf-8", "replace") for x in texts) for i in range(0, len(t), 64)]
    try:
        return zstandard.train_dictionary(ORDINARY_BYTES, samples, k=48, d=8).as_bytes()
    except zstandard.ZstdError:  # too little text for the trainer: the text itself is the dictionary
        return b"".join(samples)[-ORDINARY_BYTES:]


def evidence(toxic: np.ndarray, ordinary: np.ndarray, n_toxic: int, n_ordinary: int) -> np.ndarray:
    """Signed root of the log-likelihood ratio of words that so many toxic and ordinary documents have, smoothed by half a document."""
    a, b = np.asarray(toxic, np.float64) + 0.5, np.asarray(ordinary, np.float64) + 0.5
    share = (n_toxic + 1) / (n_toxic + n_ordinary + 2)
    lift = a * np.log(a / ((a + b) * share)) + b * np.log(b / ((a + b) * (1 - share)))
    return np.sign(a / (n_toxic + 1) - b / (n_ordinary + 1)) * np.sqrt(2 * np.maximum(lift, 0))


def learns(place: int) -> bool:
    """Three of five documents give the dictionaries, the other two the calibration."""
    return place % 5 < 3


class Texts(list):
    """Labelled documents of a kind."""

    def n_learned(self) -> int:
        return sum(learns(k) for k in range(len(self)))

    def counts(self, ordinary: Texts) -> dict[str, tuple[int, int]]:
        """Words with evidence, and how many learned documents of this kind and of the other have them."""
        mine, other = (Counter(w for k, t in enumerate(texts) if learns(k) for w in set(words(t))) for texts in (self, ordinary))
        return {w: (mine[w], other[w]) for w in _telling(mine, other, self.n_learned(), ordinary.n_learned())}

    def found(self, known: set[str]) -> list[set[str]]:
        """Which of these words each learned document has."""
        return [known.intersection(words(t)) for k, t in enumerate(self) if learns(k)]

    def features(self, gains: Gains) -> list[np.ndarray]:
        """Feature rows of the documents held back."""
        return [gains.features(t) for k, t in enumerate(self) if not learns(k)]


class Excerpts(Texts):
    """Documents whose whole texts stay in Spark: ``whole`` has their names and texts, the items are excerpts.

    Words and features are taken of the whole texts by tasks; only words with evidence and feature rows reach the driver.
    """

    def __init__(self, rows: list, whole: DataFrame):
        super().__init__(r["excerpt"] for r in rows)
        self.place, self.whole = {r["name"]: k for k, r in enumerate(rows)}, whole

    def _rows(self, make: Callable[[int, str], list[tuple]], schema: str, kinds: list[pa.DataType]) -> DataFrame:
        place, names = self.place, [part.split()[0] for part in schema.split(", ")]

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if name in place and (rows := make(place[name], text)):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        return self.whole.select("name", "text").mapInArrow(run, schema)

    def _words(self) -> DataFrame:
        return self._rows(lambda k, t: [(w,) for w in set(words(t))] if learns(k) else [], "word string", [pa.string()])

    def counts(self, ordinary: Excerpts) -> dict[str, tuple[int, int]]:
        sizes = self.n_learned(), ordinary.n_learned()
        both = self._words().withColumn("mine", F.lit(1)).unionByName(ordinary._words().withColumn("mine", F.lit(0)))
        counts = both.groupBy("word").agg(F.count_if(F.col("mine") == 1).alias("n1"), F.count_if(F.col("mine") == 0).alias("n0")).where("n1 > 0")

        def weigh(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = evidence(batch.column(1).to_numpy(), batch.column(2).to_numpy(), *sizes)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=["word", "n1", "n0", "evidence"]).filter(pa.array(found >= EVIDENCE))

        best = counts.mapInArrow(weigh, "word string, n1 long, n0 long, evidence double").orderBy(F.col("evidence").desc(), F.col("word").desc()).limit(TOXIC_WORDS)
        return {r["word"]: (r["n1"], r["n0"]) for r in best.collect()}

    def found(self, known: set[str]) -> list[set[str]]:
        out = {k: set() for k in range(len(self)) if learns(k)}
        rows = self._rows(lambda k, t: [(k, w) for w in known.intersection(words(t))] if learns(k) else [], "k int, word string", [pa.int32(), pa.string()])
        for r in rows.collect() if known else []:
            out[r["k"]].add(r["word"])
        return list(out.values())

    def features(self, gains: Gains) -> list[np.ndarray]:
        contents, made = gains.contents, []

        def make(k: int, text: str) -> list[tuple]:
            if learns(k):
                return []
            if not made:
                made.append(Gains(*contents))
            return [(k, made[0].features(text).tolist())]

        rows = self._rows(make, "k int, x array<double>", [pa.int32(), pa.list_(pa.float64())]).collect()
        return [np.array(r["x"]) for r in sorted(rows, key=lambda r: r["k"])]


def excerpt(name: str, text: str) -> str:
    """The text, or those of its pieces that have the smallest hashes, in their order."""
    n = -(-len(text) // PIECE)
    if n <= PIECES:
        return text
    chosen = sorted(range(n), key=lambda i: zlib.crc32(f"{i}:{name}".encode("utf-8", "replace")))[:PIECES]
    return "".join(text[i * PIECE : (i + 1) * PIECE] for i in sorted(chosen))


def _toxic_dictionary(toxic: Texts, ordinary: Texts) -> bytes:
    """Trained on the telling words of each toxic document, each repeated by its evidence.

    A word that ordinary documents have too only loses evidence. A document most of whose telling words an earlier one has
    is a copy and lends its words no further weight. The words follow the trained part, the strongest last, where matches
    are cheap: the trainer needs more text than a few words make.
    """
    counts = toxic.counts(ordinary)
    common = Counter({w: n for w, (_, n) in counts.items()})
    alone, met = [], set()
    for rare in toxic.found(set(counts)):
        if len(rare) < COPY_WORDS or 2 * len(rare & met) <= len(rare):
            alone.append(rare)
            met |= rare
    strong = _telling(Counter(w for rare in alone for w in rare), common, len(alone), ordinary.n_learned())
    if not strong:
        return b""
    ranked = sorted(strong, key=lambda w: (strong[w], w))
    listed = (" " + " ".join(ranked) + " ").encode("utf-8", "replace")[-TOXIC_BYTES:]
    samples = [" ".join([""] + [w for w in sorted(rare) if w in strong for _ in range(round(strong[w] / EVIDENCE))] + [""]).encode("utf-8", "replace") for rare in alone]
    try:
        trained = zstandard.train_dictionary(TOXIC_BYTES, [x for x in samples if len(x) > 8], k=48, d=8).as_bytes()
    except zstandard.ZstdError:
        trained = b""
    return (trained + listed)[-TOXIC_BYTES:]


def _telling(toxic: Counter, ordinary: Counter, n_toxic: int, n_ordinary: int) -> dict[str, float]:
    """Words with evidence from ``EVIDENCE`` on, at most ``TOXIC_WORDS``."""
    names = sorted(toxic)
    found = evidence([toxic[w] for w in names], [ordinary[w] for w in names], n_toxic, n_ordinary)
    ranked = sorted(((e, w) for w, e in zip(names, found.tolist()) if e >= EVIDENCE), reverse=True)
    return {w: e for e, w in ranked[:TOXIC_WORDS]}


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights of a ridge logistic regression, intercept first, by Newton steps."""
    design = np.column_stack([np.ones(len(x)), x])
    penalty = ridge * weight.sum() * np.diag([1e-3] + [1.0] * x.shape[1])
    w = np.zeros(design.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (weight * (p - y)) + penalty @ w
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + penalty
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit_texts(toxic: list[str], ordinary: list[str], toxic_rate: float) -> Model:
    """Dictionaries from three of five texts, calibration on the other two, weighted to the rate of toxic labels.

    Without texts of both kinds on either side the score is the rate.
    """
    toxic, ordinary = (t if isinstance(t, Texts) else Texts(t) for t in (toxic, ordinary))
    base, bad = _ordinary_dictionary([t for k, t in enumerate(ordinary) if learns(k)]), _toxic_dictionary(toxic, ordinary)
    size = 3 + len(THRESHOLDS) + len(THRESHOLDS[1::2])
    if any(t.n_learned() == len(t) for t in (toxic, ordinary)):
        rate = min(max(toxic_rate, 1e-6), 1 - 1e-6)
        return Model(base, bad, np.zeros(size), np.ones(size), np.array([np.log(rate / (1 - rate))] + [0.0] * size))
    gains = Gains(base, bad)
    ones, zeros = toxic.features(gains), ordinary.features(gains)
    x = np.array(ones + zeros)
    y = np.array([1.0] * len(ones) + [0.0] * len(zeros))
    weight = np.where(y == 1, toxic_rate / len(ones), (1 - toxic_rate) / len(zeros)) * len(y)
    center, scale = x.mean(0), x.std(0) + 1e-9
    return Model(base, bad, center, scale, _logistic((x - center) / scale, y, weight))


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learned."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == 2


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> Model:
    """A model from at most ``FIT_TOXIC`` + ``FIT_ORDINARY`` labelled documents, those with the smallest hashes of their id.

    Only ids outside the held-out part are considered. An id with several labels is toxic if one of them says so; of
    several texts of an id the smallest is used. Words and calibration are taken of whole texts, by tasks; the driver sees
    excerpts of a bounded size, for the ordinary dictionary. The bounds do not depend on the data.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("_toxic"))
    counts = {r["_toxic"]: r["count"] for r in known.groupBy("_toxic").count().collect()}
    key = F.xxhash64(F.lit("fit"), F.col("_id"))
    picked = [known.where(F.col("_toxic") == y).orderBy(key, "_id").limit(n) for y, n in ((1, FIT_TOXIC), (0, FIT_ORDINARY))]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # at most FIT_TOXIC + FIT_ORDINARY ids
    texts = docs.select(F.col(id_col).alias("_id"), F.col("text").alias("_text")).where("_text IS NOT NULL")
    once = texts.join(sample, "_id").groupBy("_id", "_toxic").agg(F.min("_text").alias("text"))
    whole = stored(once.select(F.col("_id").cast("string").alias("name"), F.col("_toxic").alias("toxic"), "text").repartition(FIT_PARTS, "name"), "labelled")
    cut = F.udf(lambda name, text: excerpt(name, text), StringType())
    rows = sorted(whole.select("name", "toxic", cut("name", "text").alias("excerpt")).collect(), key=lambda r: r["name"])
    total = sum(counts.values())
    by = {y: Excerpts([r for r in rows if r["toxic"] == y], whole) for y in (0, 1)}
    return fit_texts(by[1], by[0], counts.get(1, 0) / total if total else 0.5)


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per document: id, ``score`` (0 to 1), ``predicted`` (1 from ``threshold`` on), then the columns ``keep``.

    Every window of the whole text is compressed with the ordinary dictionary alone and with the toxic one beside
    it; the calibrated function of the differences is the score. No shuffle. NULL texts count as empty; repeated rows stay
    repeated and get equal scores; an empty table gives no rows. Texts go to Python once, and back only if they are kept.
    """
    names = {c: "_text" if c == text_col else f"_keep{i}" for i, c in enumerate(keep or [])}
    others = [F.col(c).alias(n) for c, n in names.items() if c != text_col]
    kept = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *others)
    back = [k for k, c in enumerate(kept.columns) if c != "_text" or text_col in names]
    schema = kept.select(*[kept.columns[k] for k in back]).schema.add("_score", "double").add("_predicted", "integer")

    def mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        gains = Gains(model.ordinary, model.toxic)
        for batch in batches:
            columns = [batch.column(k) for k in back]
            for first, run in text_runs(batch.column(1)):
                x = np.array([gains.features(t) for t in run])
                # Summed row by row: a matrix product may round a row by its place in the batch.
                lift = ((x - model.center) / model.scale * model.weights[1:]).sum(axis=1)
                value = 1 / (1 + np.exp(-np.clip(model.weights[0] + lift, -30, 30)))
                slices = [c.slice(first, len(run)) for c in columns]
                yield pa.RecordBatch.from_arrays([*slices, pa.array(value, pa.float64()), pa.array((value >= threshold).astype(np.int32))], names=schema.names)

    out = kept.mapInArrow(mark, schema)
    return out.select(F.col("_id").alias(id_col), F.col("_score").alias("score"), F.col("_predicted").alias("predicted"), *[F.col(n).alias(c) for c, n in names.items()])
