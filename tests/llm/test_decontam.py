"""Benchmark passages against a search over all alignments."""

import random
import time
import tracemalloc

from ledgerstrata.llm import decontam
from ledgerstrata.llm.decontam import SeedIndex, benchmark_overlaps
from ledgerstrata.llm.text import plain_words


def brute(text, items):
    """Every alignment, word by word."""
    words, found = plain_words(text), []
    for item_id, item in items:
        own = plain_words(item)
        width = min(13, len(own))
        if len(own) < 5:
            continue
        for shift in range(-len(own), len(words)):
            low, high = max(0, -shift), min(len(own), len(words) - shift)
            same = [own[q] == words[q + shift] for q in range(low, high)]
            good = [k for k in range(len(same) - width + 1) if 100 * sum(same[k : k + width]) >= 80 * width]
            if good:
                start, end = good[0], good[-1] + width
                found.append((item_id, low + shift + start, end - start, sum(same[start:end]), low + start))
    return sorted(found)


def alignments(index, text):
    return sorted(tuple(map(int, row)) for block in index.overlaps(text) for row in zip(*block))


def mixed_texts(rng, vocabulary, rounds):
    for _ in range(rounds):
        words = vocabulary[: rng.choice((1, 2, 4, 40))]
        items = [
            (j, " ".join(rng.choice(words) for _ in range(rng.choice((3, 5, 6, 9, 10, 12, 13, 14, 40)))))
            for j in range(5)
        ]
        text = []
        for _, item in items:
            text += [rng.choice(words) if rng.random() < 0.15 else w for w in item.split()]
            text += [rng.choice(vocabulary) for _ in range(rng.randint(0, 4))]
        yield items, " ".join(text)


def test_no_alignment_is_missed_or_invented(vocabulary):
    for items, text in mixed_texts(random.Random(21), vocabulary, 160):
        assert alignments(SeedIndex(items), text) == brute(text, items)


def test_small_slices_change_nothing(vocabulary, monkeypatch):
    monkeypatch.setattr(decontam, "SLICE", 3)
    monkeypatch.setattr(decontam, "CELLS", 50)
    for items, text in mixed_texts(random.Random(24), vocabulary, 60):
        assert alignments(SeedIndex(items), text) == brute(text, items)


def test_a_megabyte_of_one_word_stays_small():
    index = SeedIndex([(1, "word " * 300), (2, "word other " * 150)])
    text = "word " * 200_000
    tracemalloc.start()
    began, rows = time.monotonic(), 0
    for block in index.overlaps(text):
        rows += len(block[0])
    peak = tracemalloc.get_traced_memory()[1]
    # Each shift that leaves 13 words or more on the text.
    assert rows == 200_000 + 300 - 1 - 2 * 12
    assert peak < 300e6 and time.monotonic() - began < 30


def test_spans_in_words(vocabulary):
    rng = random.Random(22)
    item = [rng.choice(vocabulary) for _ in range(30)]
    changed = item.copy()
    changed[10] = "other"
    text = " ".join(["before"] * 7 + changed + ["after"] * 5)
    assert alignments(SeedIndex([(3, " ".join(item))]), text) == [(3, 7, 30, 29, 0)]
    assert alignments(SeedIndex([(3, " ".join(item))]), text.upper() + "!") == [(3, 7, 30, 29, 0)]


def test_blocks_and_odd_rows(spark, odd_docs, vocabulary):
    rng = random.Random(23)
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(20))) for i in range(20)]
    benchmark = spark.createDataFrame(
        items + [(None, items[0][1]), (98, None), (99, ""), (99, "")], "item_id long, text string"
    )
    rows = [(i, f"x y {items[i % 20][1]} z") for i in range(40)] + [(50, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(i, i % 20, 2, 20, 20, 0) for i in range(40)}
    for block in (64_000_000, 20_000):
        got = benchmark_overlaps(docs, benchmark, block_bytes=block).collect()
        assert {tuple(r) for r in got} == want and len(got) == 40
    assert benchmark_overlaps(odd_docs, benchmark).count() == 0
    assert benchmark_overlaps(docs, benchmark.limit(0)).count() == 0
    assert benchmark_overlaps(docs.limit(0), benchmark).count() == 0
