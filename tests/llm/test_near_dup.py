"""Near duplicates against brute force, and the parts they are made of."""

import random

import numpy as np

from ledgerstrata.llm import components, near_dup
from ledgerstrata.llm.components import connected_components
from ledgerstrata.llm.near_dup import linked, near_duplicates
from ledgerstrata.llm.superminhash import signatures
from ledgerstrata.llm.text import blank_words


def brute_components(rows, n, percent):
    sets = {}
    for doc_id, text in rows:
        w = blank_words(text)
        runs = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}
        sets[doc_id] = runs if w else set()
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def test_equals_brute_force(spark, vocabulary):
    rng = random.Random(11)
    rows, number = [], 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 12)):
            words = [rng.choice(vocabulary) if rng.random() < 0.02 else w for w in base]
            rows.append((number, rng.choice([" ", "\n", "  "]).join(words)))
            number += 1
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for shingle in (4, 5):
        got = {
            r.doc_id: (r.n_shingles, r.component_id)
            for r in near_duplicates(docs, shingle=shingle).collect()
        }
        assert got == brute_components(rows, shingle, 80)


def test_a_large_group_is_compared_in_blocks(spark, vocabulary):
    """Chains of small changes: neighbours are linked, the ends are not."""
    rng = random.Random(12)
    words = [rng.choice(vocabulary) for _ in range(100)]
    rows = []
    for i in range(600):
        words = words.copy()
        words[(i * 7) % 100] = rng.choice(vocabulary)
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, 4).collect()}
    assert got == brute_components(rows, 4, 80)


def test_odd_documents(odd_docs):
    got = near_duplicates(odd_docs, shingle=4).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == odd_docs.count()
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(7, False)]
    for i in (1, 2, 3):
        assert (by_id[i].n_shingles, by_id[i].component_id, by_id[i].kept) == (0, i, True)
    assert by_id[5].n_shingles == 1 and by_id[7].kept
    assert near_duplicates(odd_docs.limit(0)).count() == 0


def test_signatures_estimate_similarity_and_ignore_order():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 2**63, 3000, dtype=np.int64).astype(np.uint64)
    a, b = pool[:2000], pool[500:2500]
    both = np.concatenate([a, b])
    sig = signatures(both, np.array([0, 2000, 4000]), 256)
    assert abs((sig[0] == sig[1]).mean() - 1500 / 2500) < 0.12
    shuffled = signatures(rng.permutation(a), np.array([0, 2000]), 256)
    assert (shuffled[0] == sig[0]).all()
    few = signatures(pool[:3], np.array([0, 1, 3]), 64)
    assert np.isfinite(few).all()
    # Every slot holds the least of its elements' values: adding elements never raises one.
    more = signatures(a, np.array([0, 2000]), 64)
    assert (more[0] <= signatures(a[:50], np.array([0, 50]), 64)[0]).all()


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 300)]
    edges += [(500, 500), (None, 3), (7, 2), (41, 40)]
    got = dict(
        connected_components(spark.createDataFrame(edges, "u long, v long").repartition(6)).collect()
    )
    assert got == {i: 0 for i in range(42)} | {100 + i: 100 for i in range(300)}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_small_graphs_are_stored_in_few_files(spark, vocabulary, monkeypatch):
    """Each file costs processes that share an executor's memory; rows decide, not shuffle partitions."""
    rng = random.Random(14)
    rows = []
    for i in range(40):
        words = [rng.choice(vocabulary) for _ in range(100)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:-1] + ["other"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    parts = []

    def counted(df, cut=components.cut_lineage):
        stored = cut(df)
        parts.append(stored.rdd.getNumPartitions())
        return stored

    monkeypatch.setattr(components, "cut_lineage", counted)
    monkeypatch.setattr(near_dup, "cut_lineage", counted)
    conf = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}

    def found():
        for k, v in conf.items():
            spark.conf.set(k, v)
        try:
            return {(r.doc_id, r.component_id) for r in near_duplicates(docs).collect()}
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)

    wanted = {(i, i - i % 2) for i in range(80)}
    assert found() == wanted and set(parts) == {1}
    parts.clear()
    monkeypatch.setattr(components, "_NODES_STORED", 20)
    assert found() == wanted and set(parts) == {4}


def test_repeated_rows_of_one_id_and_empty_blocks(spark, vocabulary):
    rng = random.Random(13)
    words = [rng.choice(vocabulary) for _ in range(60)]
    near = words[:-1] + ["other"]
    rows = [(1, " ".join(words))] * 500 + [(2, " ".join(near)), (3, " ".join(reversed(words)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs, 4).collect()
    assert len(got) == 502
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (3, 3)}
    ids, sets = [1, 2], [np.arange(5, dtype=np.uint64)] * 2
    assert linked(ids, sets, ([0, 1], []), 80) == []
    assert linked(ids, sets, ([0], [1]), 80) == [(1, 2)]


def test_families_that_share_much_of_their_texts(spark, vocabulary):
    """One large candidate cluster that holds many components."""
    rng = random.Random(15)
    common = [rng.choice(vocabulary) for _ in range(90)]
    rows = []
    for family in range(15):
        own = common + [rng.choice(vocabulary) for _ in range(30)]
        for _ in range(30):
            words = [rng.choice(vocabulary) if rng.random() < 0.03 else w for w in own]
            rows.append((len(rows), " ".join(words)))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, 4).collect()}
    assert got == brute_components(rows, 4, 80) and len({c for _, c in got.values()}) > 15
