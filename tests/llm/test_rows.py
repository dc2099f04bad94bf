"""URL filter, shards and source mix against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from firmlens.llm import mixing, shards, toxicity, urls
from firmlens.llm.queries import RULES

URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET/en/x?q=1#f", "https://net", "https://x.net/", "http://example.com/de/", "http://a.example.com/de/y",
    "http://badexample.com/de/", "http://ads.example.com/p?utm_source=a&b=2&a=1", "https://www.ads.example.com/p/?a=1&b=2&ref=z#top", "http://example.org/fr/a", "http://org/fr/",
    "http://good.example.com/p", "x://y://z/w", "http://ÄB.com/p\nq", "http://good.example.com/p",
]
LISTED = ["http://ads.example.com/p/?b=2&a=1", None, "nothing", "http://ads.example.com/p?a=1&b=2", "http://only.listed/x"]


def _host_path(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = m.groups() if m else ("", "")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def _judged(url, listed):
    host, path = _host_path(url)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: len(r.host + r.path))
        return host, path, best.host + best.path, best.verdict
    return host, path, None, "block" if url and "ads.example.com/p" in url and url in listed else "allow"


@pytest.mark.parametrize("broadcast", [urls.BROADCAST_BYTES, 0])
def test_urls(spark, monkeypatch, broadcast):
    flag = urls.flag_listed
    monkeypatch.setattr(urls, "flag_listed", lambda *a: flag(*a, broadcast_bytes=broadcast))
    pages = spark.createDataFrame([(k, u, "x", 1) for k, u in enumerate(URLS)] + [(3, URLS[3], "x", 1)], "page_id long, url string, host string, _block int")
    listed = spark.createDataFrame([(u,) for u in LISTED], "url string")
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(pages, RULES, listed).collect())
    hits = {URLS[10], URLS[11]}
    want = sorted((k, *_judged(u, hits)) for k, u in [*enumerate(URLS), (3, URLS[3])])
    assert [tuple(map(str, r)) for r in got] == [tuple(map(str, r)) for r in want]
    assert urls.judge_urls(pages.limit(0), RULES, listed).count() == 0
    assert urls.judge_urls(pages, RULES, listed.limit(0)).where("verdict = 'block' AND rule IS NULL").count() == 0


def test_filter_loses_no_listed_key_and_is_exact(spark):
    rows = spark.range(20000).selectExpr("CAST(id % 7000 AS string) AS k", "id")
    listed = spark.range(0, 7000, 3).selectExpr("CAST(id AS string)")
    got = urls.flag_listed(rows, "k", listed, bits_per_key=4)  # few bits: many false positives for the join to remove
    assert got.where("is_listed != (CAST(k AS int) % 3 = 0)").count() == 0 and got.count() == 20000


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, "x") for i, t, s in rows], "doc_id long, text string, source string, size int, _row string").repartition(4)


def _corpus(seed, n):
    rng = random.Random(seed)
    text = lambda: rng.choice([None, "", " \t", "é漢 x", " ".join(["w"] * rng.randint(1, 300))])
    return [(i, text(), rng.choice([None, "a", "b", "Z", "ä"]) if i % 3 else "hot") for i in range(n)]


@pytest.mark.parametrize("n, count", [(400, 8), (3, 8), (0, 8)])
def test_shards(spark, n, count):
    rows = _corpus(1, n)
    rows += rows[:2]
    got = shards.byte_shards(_docs(spark, rows), count).collect()
    size = lambda t: len((t or "").encode()) + 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, size(t), zlib.crc32((t or "").encode())) for i, t, _ in rows)
    by = defaultdict(list)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < count
        by[r.shard].append(r)
    total, largest = sum(r.size for r in got), max((r.size for r in got), default=0)
    ids = []
    for s in sorted(by):
        by[s].sort(key=lambda r: r.slot)
        assert [r.slot for r in by[s]] == list(range(len(by[s])))
        assert abs(sum(r.size for r in by[s]) - total / count) <= largest
        ids += [r.doc_id for r in by[s]]
    assert ids == sorted(ids)


def _mixed(rows, weights=(1, 2, 3), most=3):
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size = Counter()
    for _, t, s in rows:
        size[s] += count(t)
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    left, target = set(order), {}
    while left:
        rest = sum(size.values()) - sum(target.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = [s for s in left if share[s] > most * size[s]]
        target |= {s: most * size[s] for s in over} if over else share
        left = left - set(over) if over else set()
    return size, target, count


@pytest.mark.parametrize("n", [300, 1, 0])
def test_mix(spark, n):
    rows = _corpus(2, n)
    size, target, count = _mixed(rows)
    docs = _docs(spark, rows)
    got = mixing.mix(docs).collect()
    taken = Counter()
    texts = {i: (t, s) for i, t, s in rows}
    assert len(got) == len(rows)
    for r in got:
        t, s = texts[r.doc_id]
        assert (r.size, r.source, r.source_size) == (count(t), s, size[s]) and 0 <= r.taken <= 3 * r.size
        assert r.target == pytest.approx(target[s])
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)
    again = mixing.mix(docs.repartition(2)).collect()
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in again}


def test_mix_takes_documents_in_hash_order(spark):
    rows = [(i, "w " * 10, "b" if i % 2 else "a") for i in range(40)]
    got = sorted((r for r in mixing.mix(_docs(spark, rows)).collect() if r.source == "a"), key=lambda r: hashlib.md5(f"mix:{r.doc_id}".encode()).hexdigest())
    assert [r.taken for r in got] == [10] * 13 + [3] + [0] * 6  # a third of 400 words


def test_toxicity_of_odd_texts(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    clean = [" ".join(word() for _ in range(60)) for _ in range(80)]
    toxic = [t + " snarkwort vilethorn " + word() for t in clean[:40]]
    model = toxicity.fit_texts(toxic, clean[40:], 0.5)
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (3, "x", 0.5), (None, toxic[0] * 50, 0.5), (5, toxic[0], 0.5), (5, toxic[0], 0.5)], "doc_id long, text string, score double")
    rows = toxicity.score(docs, model, keep=["score"]).toPandas().iloc[:, :3]
    assert rows.iloc[:, 1].between(0, 1).all() and rows.iloc[0, 1] == rows.iloc[1, 1] and rows.iloc[4, 1] == rows.iloc[5, 1] > rows.iloc[2, 1]
    assert toxicity.score(docs.limit(0), model).count() == 0
    for a, b in (([], []), ([], clean), (toxic, [])):
        assert 0 <= toxicity.score(docs, toxicity.fit_texts(a, b, 0.2)).first()["score"] <= 1
    labels = spark.createDataFrame([(5, 1), (5, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    assert 0 <= toxicity.score(docs, toxicity.fit(docs, labels)).first()["score"] <= 1


def test_labels_of_the_held_out_part_are_never_learned(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('text of ', id) AS text")
    held = [r[0] for r in docs.where(toxicity.held_out(docs.doc_id)).select("doc_id").collect()]
    assert sorted(held) == [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2]
    seen = []
    fit_texts, toxicity.fit_texts = toxicity.fit_texts, lambda a, b, rate: seen.append((set(a), set(b), rate))
    try:
        toxicity.fit(docs, spark.range(400).selectExpr("id AS doc_id", "CAST(id % 5 = 0 AS int) AS toxic"))
    finally:
        toxicity.fit_texts = fit_texts
    assert len(seen[0][0] | seen[0][1]) == 400 - len(held) and not {f"text of {k}" for k in held} & (seen[0][0] | seen[0][1])


def test_toxic_words_that_ordinary_documents_quote_are_learned(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklm", k=6))
    bad = ["snarkwort", "vilethorn", "mucklehead"]
    text = lambda more: " ".join(rng.sample(w := [word() for _ in range(60)] + more, len(w)))
    toxic, ordinary = [text(bad) for _ in range(60)], [text(bad if k % 30 == 0 else []) for k in range(300)]
    model = toxicity.fit_texts(toxic, ordinary, 1 / 6)
    assert all(w.encode() in model.toxic for w in bad)
    docs = spark.createDataFrame([(k, text(bad if k < 20 else [])) for k in range(60)], "doc_id long, text string")
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, model).collect()}
    assert sum(found[k] for k in range(20)) >= 18 and sum(found[k] for k in range(20, 60)) <= 2


def test_a_toxic_word_in_a_small_share_of_toxic_documents_is_learned():
    toxic = [f"plain words here {'snarkwort' if k % 150 == 0 else 'again'}" for k in range(900)]
    assert b"snarkwort" in toxicity.fit_texts(toxic, ["plain words here again"] * 3000, 0.2).toxic  # 6 of 540


def test_toxic_words_far_inside_long_documents_are_learned(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklm", k=6))
    long = lambda end: " ".join(word() for _ in range(3400)) + end
    rows = [(k, long(" snarkwort vilethorn" * 5 if k % 4 == 0 else "")) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    model = toxicity.fit(docs, spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(120)], "doc_id long, toxic int"))
    assert b"snarkwort" in model.toxic and b"vilethorn" in model.toxic
    held = [k for k, _ in rows if zlib.crc32(str(k).encode()) % 4 != 2]
    kinds = [sorted((k for k in held if (k % 4 == 0) == kind), key=str) for kind in (True, False)]
    back = [dict(rows)[k] for ids in kinds for n, k in enumerate(ids) if n % 5 >= 3]
    gains = toxicity.Gains(model.ordinary, model.toxic)
    assert model.center == pytest.approx(np.mean([gains.features(t) for t in back], axis=0))  # of whole texts
    found = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert np.mean([found[k] for k in range(0, 120, 4)]) > 0.5 > 0.2 > np.mean([found[k] for k in range(120) if k % 4])


def test_excerpts_lie_anywhere_in_a_text():
    text = "".join(f"{k:8d}" for k in range(20_000))
    cut = toxicity.excerpt("7", text)
    places = [int(cut[i : i + 8]) for i in range(0, len(cut), 8)]
    assert len(cut) == toxicity.PIECE * toxicity.PIECES and places == sorted(set(places)) and places[-1] > 15_000
    assert toxicity.excerpt("7", text[:20_000]) == text[:20_000]


def test_words_are_counted_in_spark_as_in_memory(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choices(["aaa", "bbb", "ccc", "ddd"] if k % 3 else ["aaa", "eee", "fff"], k=30))) for k in range(200)]
    seen = []
    monkeypatch.setattr(toxicity, "fit_texts", lambda a, b, rate: seen.append((a, b)))
    toxicity.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(200)], "doc_id long, toxic int"))
    (a, b), = seen
    plain = toxicity.Texts(a), toxicity.Texts(b)
    known = plain[0].counts(plain[1])
    assert a.counts(b) == known and {"eee", "fff"} == set(known) and a.found(set(known)) == plain[0].found(set(known))
