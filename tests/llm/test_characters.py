"""Character tables against the tokenizer library, over all code points."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerstrata.llm.bpe import Bpe, Encoder
from ledgerstrata.llm.characters import classes, lower, normal, split
from ledgerstrata.llm.token_counts import PrefixCounter

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
POINTS = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
BATCH = 40_000


def load(path):
    with open(path, encoding="utf-8") as file:
        return Bpe(file.read())


def batches(make, between):
    for i in range(0, len(POINTS), BATCH):
        yield between.join(make(chr(c)) for c in POINTS[i : i + BATCH])


def test_sizes_of_the_classes():
    found = classes()
    assert [int((found == k).sum()) for k in (1, 2, 3)] == [141_028, 1_911, 25]


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("form", ["a{}b", "1{0}{0}!", "'r{}e", " {} {0}"])
def test_every_code_point_splits_as_in_the_library(path, form):
    library, ours = Tokenizer.from_file(path), load(path)
    make = lambda c: form.replace("{0}", c).replace("{}", c)
    for text in batches(make, "\n"):
        spans = [s for _, s in library.pre_tokenizer.pre_tokenize_str(text)]
        pieces, at, got = split(ours.pattern, text), 0, []
        for piece in pieces:
            at = text.index(piece, at)
            got.append((at, at + len(piece)))
            at += len(piece)
        assert got == spans


@pytest.mark.parametrize("form", ["{}", "ạ{}", "a{}̣", "á{}̧", "a{}̴ͅ", "\U00011935{}", "ᄀ{}"])
def test_every_code_point_normalizes_as_in_the_library(form):
    nfc = Tokenizer.from_file(WORD).normalizer[0]
    for text in batches(lambda c: form.replace("{}", c), "\x01"):
        assert normal(text) == nfc.normalize_str(text)


@pytest.mark.parametrize("form", ["{}", "A{}", "{}Σ", "Α{}Σ "])
def test_every_code_point_is_lowered_as_in_the_library(form):
    lowercase = Tokenizer.from_file(WORD).normalizer[2]
    for text in batches(lambda c: form.replace("{}", c), "\x01"):
        assert lower(text) == lowercase.normalize_str(text)


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_random_texts_of_all_planes(path):
    library, ours, rng = Tokenizer.from_file(path), load(path), random.Random(8)
    blocks = [(0x20, 0x7F), (0x80, 0x24F), (0x300, 0x36F), (0x900, 0x10FF), (0x1C80, 0x1CFF), (0xA7C0, 0xA7FF),
              (0x10D00, 0x11FFF), (0x13400, 0x14400), (0x16100, 0x16FFF), (0x18C00, 0x19200), (0x1E000, 0x1E7FF),
              (0x2EB00, 0x33500), (0, 0xD7FF), (0xE000, 0x10FFFF)]
    pieces = [" ", "  ", "'s", "'re", "\n", "the", "Σ", "1"]
    texts = []
    for _ in range(20_000):
        block = rng.choice(blocks)
        text = "".join(
            rng.choice(pieces) if rng.random() < 0.4 else chr(rng.randint(*block)) for _ in range(rng.randint(1, 12))
        )
        texts.append(text.encode("utf-8", "ignore").decode())
    encoder = Encoder(ours)
    counter = None if ours.lower else PrefixCounter(ours)
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert ours.encode(text) == want.ids
        assert encoder(text).tolist() == want.ids
        assert counter is None or counter.count(text) == len(want.ids)


def test_long_blank_runs_take_linear_time():
    counter = PrefixCounter(load(BYTE))
    library = Tokenizer.from_file(BYTE)
    for text in (" " * 3000, "a" + " \n" * 2000 + "b", "\n" * 3001, "x " + " " * 500 + "y"):
        assert counter.count(text) == len(library.encode(text).ids)
    assert counter.count(" " * 1_000_000) == 1_000_000
