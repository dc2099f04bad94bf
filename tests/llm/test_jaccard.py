"""The Jaccard join and its components against brute force."""

import random

import pytest

from firmlens.llm import jaccard
from firmlens.llm.components import components


def _set(text, n):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < n else frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def _closed(nodes, links):
    label = {x: x for x in nodes}
    for a, b in links:
        while label[a] != a:
            a = label[a]
        while label[b] != b:
            b = label[b]
        label[max(a, b)] = min(a, b)
    root = {}
    for x in nodes:
        r = x
        while label[r] != r:
            r = label[r]
        root[x] = r
    return root


def _brute(rows, n, percent):
    sets = {i: _set(t, n) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    root = _closed(ids, links)
    return sorted((i, len(sets[i]), root[i]) for i in ids)


def _run(spark, rows, n, percent):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n long, hashes string").repartition(3)
    return sorted(tuple(r) for r in jaccard.similar_groups(docs, n, percent).collect())


def _corpus(seed, groups, passage=True):
    """Groups of near copies at all distances, common passages, short texts, and chains that only hang together step by step."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    common = " ".join(rng.choices(vocabulary, k=40))
    texts = [None, "", "   \n", "One", "one", "one two", "One Two three", "one two three"]
    for _ in range(groups):
        words = rng.choices(vocabulary, k=rng.choice([4, 9, 20, 60, 200]))
        for _ in range(rng.choice([1, 1, 2, 5])):
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                words = list(words)
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words) + (" " + common if passage and rng.random() < 0.3 else ""))
    ids = rng.sample(range(-1000, 10000), len(texts))
    return list(zip(ids, texts))


@pytest.mark.parametrize("n, percent, seed", [(3, 90, 1), (5, 80, 2), (1, 70, 3), (2, 95, 4)])
def test_against_brute_force(spark, n, percent, seed):
    rows = _corpus(seed, 60)
    assert _run(spark, rows, n, percent) == _brute(rows, n, percent)


def test_search_finds_what_the_first_links_miss(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LOOK_BACK", 0)
    monkeypatch.setattr(jaccard, "HUBS", 0)
    monkeypatch.setattr(jaccard, "LIST_SETS", 7)
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(jaccard, "SKIP", 3)
    rows = _corpus(5, 50)
    assert _run(spark, rows, 3, 80) == _brute(rows, 3, 80)


def test_large_groups_of_copies_and_near_copies(spark):
    rng = random.Random(7)
    base = [f"b{k}" for k in range(80)]
    rows = [(k, " ".join(base)) for k in range(300)]
    for k in range(300, 500):
        words = list(base)
        words[rng.randrange(80)] = f"x{k}"
        rows.append((k, " ".join(words)))
    assert _run(spark, rows, 3, 90) == _brute(rows, 3, 90)


def test_repeated_ids_and_nothing(spark):
    assert _run(spark, [], 3, 90) == []
    text = " ".join(f"w{k}" for k in range(50))
    rows = [(4, text), (4, text), (4, "another text of its own"), (9, text + " more"), (2, None)]
    assert _run(spark, rows, 3, 90) == [(2, 0, 2), (4, 3, 4), (4, 48, 4), (4, 48, 4), (9, 49, 4)]
    docs = spark.createDataFrame([(None, text), (8, text), (None, "alone here now")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similar_groups(docs, 3, 90).collect()), key=str)
    assert got == sorted([(8, 48, 8), (None, 48, 8), (None, 1, None)], key=str)


def test_columns_with_clashing_names(spark):
    rows = [(k, f"one two three four five {'six' if k < 3 else 'seven eight ' * k}", 1, "x", 2, 3) for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _id int, _key string, sid int, hash int")
    assert {r.doc_id: r.component_id for r in jaccard.similar_groups(docs, 3, 90).collect()} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 3}


def test_components_of_paths_and_stars(spark):
    rng = random.Random(8)
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 140)] + [(k, 200) for k in range(201, 230)] + [(300, 300)]
    links += [tuple(rng.sample(range(400, 500), 2)) for _ in range(60)]
    rng.shuffle(links)
    nodes = sorted({x for link in links for x in link})
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == _closed(nodes, links)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
