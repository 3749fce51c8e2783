"""Licence scans against SQL and plain Python."""

import random
import re

import pytest

from ledgerstrata.llm.licenses import (
    BASE_PHRASES,
    PHRASES,
    TERMS,
    Scanner,
    evaluate,
    leading_expression,
    scan_licenses,
    term_of,
    to_postfix,
)
from ledgerstrata.llm.text import plain_words

WORDS = r"""
SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
"""


def base_of(words):
    places, labels = [], set()
    for phrase, label in BASE_PHRASES.items():
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_columns_equal_words_from_sql(spark, duck, sf_dir):
    got = scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    found = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got}
    assert found == {doc_id: base_of(words) for doc_id, words in duck.execute(WORDS).fetchall()}
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score < 1


@pytest.mark.parametrize(
    "text", ["cc by cc by-cc BY", "MIT License mit license", "GNU general public license apache license",
             "the mit licenses", "mit\nlicense", "ccby", "cc by", "émit license mit licensé"],
)
def test_places_of_base_phrases(text):
    words = [w.decode() for w in plain_words(text)]
    got = Scanner()(text)
    assert got[:5] == base_of(words)


@pytest.mark.parametrize(
    "text, identifiers, term",
    [
        ("MIT", ("mit",), 0),
        ("GPL-2.0-only OR MIT", ("gpl-2.0-only", "mit"), 0),
        ("GPL-2.0-only AND MIT", ("gpl-2.0-only", "mit"), 1),
        ("MIT OR GPL-3.0 AND CC-BY-NC-4.0", ("mit", "gpl-3.0", "cc-by-nc-4.0"), 0),
        ("(MIT OR GPL-3.0) AND CC-BY-NC-4.0", ("mit", "gpl-3.0", "cc-by-nc-4.0"), 2),
        ("GPL-2.0 WITH Classpath-exception-2.0", ("gpl-2.0",), 0),
        ("GPL-2.0 WITH Classpath-exception-2.0 AND LGPL-2.1", ("gpl-2.0", "lgpl-2.1"), 1),
        ("((MIT)", ("mit",), None),
        ("MIT OR", ("mit",), None),
        ("", (), None),
    ],
)
def test_expressions(text, identifiers, term):
    got = evaluate(text)
    assert (got.identifiers, got.term) == (identifiers, term)


def test_postfix_order():
    assert to_postfix("a or b and c with d".split()) == ["a", "b", "c", "d", "with", "and", "or"]
    assert to_postfix(["a", "b"]) is None and to_postfix(["and"]) is None and to_postfix([")"]) is None


@pytest.mark.parametrize(
    "text, want",
    [
        (" MIT see the file for details", "MIT"),
        ("MIT OR", "MIT"),
        ("((MIT)", ""),
        ("(MIT OR GPL-2.0) */ and more", "(MIT OR GPL-2.0)"),
        ("MIT. And then", "MIT"),
        ("GPL-2.0+ WITH x AND (MIT", "GPL-2.0+ WITH x"),
        ("MIT) OR x", "MIT"),
        ("OR MIT", ""),
        ("; MIT", ""),
        ("", ""),
    ],
)
def test_longest_well_formed_expression(text, want):
    assert leading_expression(text) == want


def test_leading_expression_is_the_longest_prefix_that_parses():
    rng = random.Random(31)
    for _ in range(3000):
        tokens = [rng.choice(["mit", "gpl-2.0", "or", "and", "with", "(", ")"]) for _ in range(rng.randint(0, 8))]
        good = [n for n in range(len(tokens) + 1) if to_postfix(tokens[:n]) is not None]
        # A prefix that cannot be continued ends the search; the parser refuses all that follow as well.
        assert leading_expression(" ".join(tokens)) == " ".join(tokens[: max(good, default=0)])


def plain_scan(text, extra):
    """Labels, score and terms without an automaton: words one by one, tags by a regular expression."""
    words = [w.decode() for w in plain_words(text)]
    table = [*BASE_PHRASES.items(), *PHRASES.items(), *extra.items()]
    found = []
    for phrase, label in table:
        own = phrase.split()
        found += [(i, i + len(own), label) for i in range(len(words)) if words[i : i + len(own)] == own]
    labels, strict = {x[2] for x in found}, [term_of(x[2]) for x in found]
    notices, covered = 0, 0
    for start, end, _ in sorted(found):
        notices += start >= covered
        covered = max(covered, end)
    for rest in re.findall(r"(?i)(?<![A-Za-z0-9\x80-\U0010ffff])spdx-license-identifier:(?=([^\r\n]*))", text):
        got = evaluate(leading_expression(rest))
        if got.term is not None:
            labels.update(got.identifiers)
            strict.append(got.term)
            notices += 2
    return ",".join(sorted(labels)), 1 - 0.5 ** min(notices, 60), TERMS[max(strict)] if strict else None


def test_labels_score_and_terms_equal_a_plain_scan():
    rng = random.Random(32)
    extra = {"apache license mit": "both", "own words": "own"}
    pieces = ["GNU General Public License", "version 3", "apache license", "mit license", "license", "CC BY", "-SA",
              "own words", "x", "spdx license identifier", "\n", "all rights reserved", "cc0",
              "SPDX-License-Identifier: MIT", "spdx-license-identifier:", "SPDX-License-Identifier: GPL-2.0 OR (a",
              "// SPDX-License-Identifier:\tLicenseRef-Own AND MIT read", "\r", "é", "xSPDX-License-Identifier: BSD"]
    scanner = Scanner(extra)
    for _ in range(3000):
        text = rng.choice([" ", " - "]).join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
        assert scanner(text)[5:] == plain_scan(text, extra), text


def test_terms_and_tags_without_expression():
    assert Scanner()("SPDX-License-Identifier: LicenseRef-Own")[5:] == ("licenseref-own", 0.75, "unknown")
    assert Scanner()("SPDX-License-Identifier: LicenseRef-Own OR MIT")[7] == "permissive"
    assert Scanner()("SPDX-License-Identifier: ?? x")[5:] == ("", 0.0, None)
    assert Scanner()("gnu general public license version 2")[6] == 0.5
    assert TERMS[term_of("mitre")] == "unknown" and TERMS[term_of("mit-0")] == "permissive"


def test_tags_and_odd_documents(spark, odd_docs):
    text = "// SPDX-License-Identifier: Apache-2.0 OR (GPL-2.0 WITH x)\nReleased under the MIT License."
    got = Scanner()(text)
    assert got[5] == "apache-2.0,gpl-2.0,mit" and got[7] == "permissive"
    rows = scan_licenses(odd_docs, phrases={"alpha beta": "greek"}).collect()
    assert len(rows) == odd_docs.count()
    assert {r.labels for r in rows if r.doc_id in (7, None)} == {"greek"}
    assert all(r.n_base == 0 and r.first_word is None for r in rows)
    assert scan_licenses(odd_docs.limit(0)).count() == 0
