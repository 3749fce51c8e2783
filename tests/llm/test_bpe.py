"""BPE and prefix counts against the tokenizer library."""

import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerstrata.llm.bpe import Bpe, Digester, Encoder, decode_ids, encode_documents, encoded_digests
from ledgerstrata.llm.token_counts import PrefixCounter, prefix_token_counts, token_counts

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = [
    "a", "E", "é", "É", "ß", "Σ", "İ", "́", "1", "٣", "½", " ", "  ", "\n", "\t", " ",
    "\u0085", "\x1c", "'s", "'re", "'RE", "'r", "'", "!", "...", "文", "ह", "😀", "the", " the",
    "tion", "K", "\x00", "_", "　", "ing", "zz", "<|endoftext|>", "<|startoftext|>",
]


def texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def load(path):
    with open(path, encoding="utf-8") as file:
        return Bpe(file.read())


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_encodes_and_decodes_as_the_library(path):
    library, ours = Tokenizer.from_file(path), load(path)
    for text in [*texts(1, 2000), "", "abcthe" * 500]:
        want = library.encode(text, add_special_tokens=False).ids
        assert ours.encode(text) == want
        assert ours.decode(want) == library.decode(want, skip_special_tokens=False)


def test_byte_level_decoding_gives_the_text_back():
    ours = load(BYTE)
    for text in texts(2, 500):
        assert ours.decode(ours.encode(text)) == text


def test_long_words_merge_as_short_ones():
    ours, rng = load(WORD), random.Random(3)
    for _ in range(50):
        word = "".join(rng.choice("aehinrst") for _ in range(100))
        ids = ours.symbols(word)
        assert ours._merge_long(ids.copy()) == ours.merge(ids.copy())


def test_chunks_change_nothing():
    ours = load(WORD)
    digest, encode = Digester(ours), Encoder(ours)
    for text in texts(4, 1000):
        ids = ours.encode(text)
        assert encode(text).tolist() == ids
        assert digest(text) == (" ".join(map(str, ids)), ours.decode(ids))


def test_every_prefix_counts_as_the_library():
    library, counter = Tokenizer.from_file(BYTE), PrefixCounter(load(BYTE))
    for text in texts(5, 400):
        want = [len(library.encode(text[:k]).ids) for k in range(1, len(text) + 1)]
        assert counter.prefix_counts(text) == want
        assert counter.count(text) == (want[-1] if want else 0)
        if "<|endoftext|>" not in text:
            fits = [k for k, n in enumerate(want, 1) if n <= 4]
            assert counter.fitting(text, 4) == max(fits, default=0)


def test_counts_of_odd_documents(odd_docs):
    library = Tokenizer.from_file(BYTE)
    counted = token_counts(odd_docs, BYTE, limit=5).collect()
    source = odd_docs.collect()
    assert len(counted) == len(source)
    for got, row in zip(counted, source):
        text = row.text or ""
        assert got.n_tokens == len(library.encode(text).ids)
        assert got.n_bytes == len(text.encode())
        assert got.over_limit == (got.n_tokens > 5)
        assert len(library.encode(text[: got.chars_in_limit]).ids) <= 5
    assert token_counts(odd_docs.limit(0), BYTE).count() == 0
    prefixes = prefix_token_counts(odd_docs.where("doc_id = 8"), BYTE).first().counts
    assert len(prefixes) == len(source[-1].text)


def test_digests_and_ids_of_odd_documents(odd_docs):
    library = Tokenizer.from_file(WORD)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    digests = encoded_digests(odd_docs, WORD).collect()
    encoded = encode_documents(odd_docs, WORD)
    for got, ids, row in zip(digests, encoded.collect(), odd_docs.collect()):
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert ids.ids == want and ids.n_tokens == got.n_tokens == len(want)
        assert got.ids_sha256 == sha(" ".join(map(str, want)))
        assert got.decoded_sha256 == sha(library.decode(want, skip_special_tokens=False))
    decoded = {r.doc_id: r.text for r in decode_ids(encoded, WORD).where("doc_id = 7").collect()}
    assert decoded == {7: "alpha</w> beta</w> gamma</w> delta</w> epsilon</w>"} or "alpha" in decoded[7]
    assert encode_documents(odd_docs.limit(0), WORD).count() == 0
