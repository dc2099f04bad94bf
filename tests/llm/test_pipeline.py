"""The pipeline on a small corpus with planted cases, stage by stage against brute force."""

import random
import re
from collections import Counter, defaultdict

import pytest

from firmlens.llm import tokens, toxicity
from tests.llm.test_jaccard import _closed, _set

pytest.importorskip("public_tokenizers")
import corpus_pipeline as cp  # noqa: E402

BAD = ["grumblefoot", "snarkwort", "mucklehead", "dregsnipe", "vilethorn"]


def _words(rng, n):
    return [rng.choice("bdfgklmnprst") + rng.choice("aeiou") + rng.choice("bdfgklmnprst") + rng.choice("aeiou") for _ in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, path = random.Random(11), str(tmp_path_factory.mktemp("corpus"))
    rows, labels = [], []
    for k in range(400):
        words, toxic = _words(rng, rng.randint(20, 150)), int(k % 4 == 0)
        if toxic:
            for _ in range(6):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((k, " ".join(words), "en", ["a", "b", None][k % 3], 0, "extra"))
        labels.append((k, 1, toxic))
    clean = [r for r in rows if r[0] % 4]
    for k, r in enumerate(clean[:40]):
        words = r[1].split()
        rows.append((1000 + k, " ".join(words if k % 2 else [*words[:-1], "changed"]), "en", "b", 0, "extra"))
    rows += [(2000, None, None, "c", None, None), (2001, "", "en", "c", 0, None), (None, "no id here at all", "en", "c", 17, None)] + [(2002, "twice the same words here", "en", "c", 0, None)] * 2
    rows.append((2003, " ".join(_words(rng, 5000)), "en", "a", 0, None))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _part string").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_toxic_documents_go_and_clean_ones_stay(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = cp.drop_toxic(spark, docs, folder)
    assert kept.columns == cp.COLUMNS
    ids = {r.doc_id for r in kept.collect()}
    assert len(ids & set(range(0, 400, 4))) <= 5 and len(set(range(400)) - set(range(0, 400, 4)) - ids) <= 6
    assert {2000, 2001, None} <= ids
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    gains = toxicity.Gains(model.ordinary, model.toxic)
    for r in toxicity.score(docs, model, keep=["text"]).collect():
        x = (gains.features(r.text or "") - model.center) / model.scale
        assert r.score == pytest.approx(1 / (1 + 2.718281828459045 ** -(model.weights[0] + x @ model.weights[1:])), abs=1e-9)


def test_one_of_each_group(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    got = cp.one_per_group(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder).collect()
    sets = {r.doc_id: _set(r.text, 5) for r in rows if r.doc_id is not None}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = _closed(ids, links)
    assert len(links) >= 40
    assert sorted((r.doc_id for r in got), key=lambda i: -1 if i is None else i) == [None, *sorted(set(root.values()))]


def test_mix_takes_exact_budgets(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = cp.mix_sources(spark, docs, folder).collect()
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size, taken, texts = Counter(), Counter(), defaultdict(set)
    for r in docs.collect():
        size[r.source] += count(r.text)
        texts[r.doc_id].add(r.text)
    for r in got:
        taken[r.source] += count(r.text)
        assert any(t == r.text or (t or "").startswith(r.text or "") for t in texts[r.doc_id])
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight, left, capped = {s: k % 3 + 1 for k, s in enumerate(order)}, set(order), {}
    total = sum(size.values())
    while True:  # share by weight, stop sources at three times their size, share the rest again
        rest, open_weight = total - sum(capped.values()), sum(weight[s] for s in left)
        over = [s for s in left if rest * weight[s] / open_weight > 3 * size[s]]
        if not over:
            break
        capped |= {s: 3 * size[s] for s in over}
        left -= set(over)
    for s in order:
        target = capped.get(s, rest * weight[s] / open_weight if s in left else 0)
        assert abs(taken[s] - target) <= 0.5


def test_run(spark, folder):
    rows = cp.run(spark, folder).collect()
    seats = Counter((r.sequence_id, r.offset + k) for r in rows for k in range(r.length))
    assert rows and max(seats.values()) == 1 and max(p for _, p in seats) < 1024
    ends = defaultdict(int)
    for r in rows:
        ends[r.sequence_id] += r.length
    assert all(n == len({p for s, p in seats if s == q}) for q, n in list(ends.items())[:20])
    assert len(ends) <= 1.1 * sum(ends.values()) / 1024 + 1
    assert not {r.doc_id for r in rows} & set(range(1000, 1040))


def test_empty_corpus(spark, folder, tmp_path):
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    empty.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_first_words(spark):
    rows = spark.createDataFrame([("  a b\tc ", 2), ("a b", 5), ("", 1), ("x", 0)], "t string, n long").select(cp.first_words("t", "n")).collect()
    assert [r[0] for r in rows] == ["  a b", "a b", "", ""]


def test_tokenizer_is_where_it_should_be():
    assert tokens.public_path(cp.TOKENIZER).endswith(cp.TOKENIZER)


def test_different_texts_of_one_id_stay(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(30))
    rows = [(1, text(0)), (5, text(0)), (5, text(1)), (5, text(2)), (7, text(2)), (7, text(3)), (None, text(4)), (3, text(4)), (None, text(4)), (None, None), (None, None), (None, "  "), (None, "  ")]
    docs = spark.createDataFrame([(k, t, "en", "a", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = Counter((r.doc_id, r.text) for r in cp.one_per_group(spark, docs, "").collect())
    assert got == Counter([(1, text(0)), (5, text(1)), (5, text(2)), (7, text(3)), (3, text(4)), (None, None), (None, None), (None, "  "), (None, "  ")])


def test_texts_go_to_python_once_and_in_small_batches(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = spark.conf.get(cp.BATCH_SETTING)
    try:
        kept = cp.drop_toxic(spark, docs, folder)
        assert int(spark.conf.get(cp.BATCH_SETTING)) == cp.BATCH_ROWS
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        sent = [line for line in plan.splitlines() if "Project" in line and "AS _text" in line]
        assert len(sent) == 1 and sent[0].count(" text#") == 1
        spark.conf.set(cp.BATCH_SETTING, "7")
        cp.pack_sequences(spark, docs, folder)
        assert spark.conf.get(cp.BATCH_SETTING) == "7"  # smaller ones stay
    finally:
        spark.conf.set(cp.BATCH_SETTING, before)
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    scored = toxicity.score(docs, model, keep=["lang", "text", "source"])
    assert scored.columns == ["doc_id", "score", "predicted", "lang", "text", "source"]
    key = lambda r: repr((r.doc_id, r.lang, r.text, r.source))
    assert sorted(map(key, scored.collect())) == sorted(map(key, docs.collect()))
