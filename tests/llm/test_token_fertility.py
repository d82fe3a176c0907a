"""Base counts against plain Python, measures against the tokenisers themselves."""

from __future__ import annotations

import base64
import math
import re
from collections import Counter

import pytest
import sentencepiece
import tiktoken
from tables import ODD, documents

from lustra.llm.queries import VOCABULARIES
from lustra.llm.token_fertility import BANDS, RANK_PATTERN, band_of, good_texts, token_quality

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    again = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            again |= set(range(i, i + 5))
    n, repeated = len(words), len(again)
    failed = n < 10 or 100 * repeated > 20 * n
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated, failed


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
MORE = [
    (30, "a b c d e f a b c d e g\nx\n\nx\n x\nx"),
    (31, "# * $ % & | < > plain\n#"),
    (32, "loop " * 500),
    (33, "no feed at the end\r\nno feed at the end"),
]


@pytest.fixture(scope="module")
def given(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, token_quality(docs, VOCABULARIES).collect()


def test_base_counts(spark, given):
    rows = [*ODD, *MORE]
    out = sorted((r.doc_id is None, r.doc_id or 0, tuple(r[c] for c in COUNTS)) for r in token_quality(documents(spark, rows), VOCABULARIES).collect())
    assert out == sorted((d is None, d or 0, base(t)) for d, t in rows)
    texts = {r.doc_id: r.text for r in given[0].collect()}
    assert all(tuple(r[c] for c in COUNTS) == base(texts[r.doc_id]) for r in given[1])


def test_measures_are_the_tokenisers(given):
    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARIES[0].path)
    texts = {r.doc_id: r.text for r in given[0].collect()}
    for row in given[1][:25]:
        words = WORD.findall(texts[row.doc_id])
        ids = [i for w in words for i in model.encode(w)]
        counts = Counter(ids)
        bits = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values())
        assert row.piece_bpe_32k_chars_per_token == pytest.approx(sum(map(len, words)) / len(ids))
        assert row.piece_bpe_32k_fallback_share == pytest.approx(sum(map(model.is_byte, ids)) / len(ids))
        assert row.piece_bpe_32k_token_entropy == pytest.approx(bits / math.log2(len(ids)) if len(ids) > 1 else 1)


def test_second_vocabulary_is_its_tokeniser(given):
    """Split by the published pattern, so that a word's piece holds the space before it."""
    path = VOCABULARIES[1].path
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    pieces = {i: b for b, i in ranks.items()}
    model = tiktoken.Encoding("whole", pat_str=RANK_PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert VOCABULARIES[1].encoder()[0](["the"]) == [[ranks[b" the"]]]
    texts = {r.doc_id: r.text for r in given[0].collect()}
    for row in given[1][:25]:
        words = WORD.findall(texts[row.doc_id])
        ids = model.encode_ordinary(" " + " ".join(words))
        counts = Counter(ids)
        bits = -sum(c / len(ids) * math.log2(c / len(ids)) for c in counts.values())
        alone = sum(len(pieces[i]) == 1 and pieces[i][0] > 0x7F for i in ids)
        assert row.byte_bpe_multi_50k_chars_per_token == pytest.approx(sum(map(len, words)) / len(ids))
        assert row.byte_bpe_multi_50k_fallback_share == pytest.approx(alone / len(ids))
        assert row.byte_bpe_multi_50k_token_entropy == pytest.approx(bits / math.log2(len(ids)) if len(ids) > 1 else 1)


def test_labelled_documents(spark, given):
    """Of the rows that the base rules leave, clean documents stay and most others go."""
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = [r for r in given[1] if not r.base_failed]
    good = [r for r in left if labels.get(r.doc_id) == 1]
    bad = [r for r in left if labels.get(r.doc_id) == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(r.kept for r in bad) <= 0.15 * len(bad)


def test_same_rows_are_kept(spark):
    rows = [*ODD, *MORE, (40, "The quick brown fox jumps over the lazy dog and runs away from the angry farmer.")]
    docs = documents(spark, rows)
    kept = good_texts(docs, VOCABULARIES)
    assert kept.columns == docs.columns
    wanted = [r.doc_id for r in token_quality(docs, VOCABULARIES).collect() if r.kept]
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, wanted))
    assert 40 in wanted and 32 not in wanted
    assert good_texts(docs.drop("lang"), VOCABULARIES).columns == docs.drop("lang").columns


def test_scripts_and_bands(spark):
    rows = [(1, "γλώσσα και λέξεις εδώ"), (2, "слова на другом языке"), (3, "plain words"), (4, "漢字 仮名"), (5, None)]
    out = {r.doc_id: r.script for r in token_quality(documents(spark, rows), VOCABULARIES).collect()}
    assert out == {1: "Greek", 2: "Cyrillic", 3: "Latin", 4: "CJK", 5: "Latin"}
    assert band_of(BANDS, "piece_bpe_32k", "en", "Latin") is BANDS["piece_bpe_32k"]["en"]
    assert band_of(BANDS, "other", "xx", "Greek") is BANDS["*"]["Greek"]
    assert band_of(BANDS, "other", None, "Runic") is BANDS["*"]["*"]


def test_empty_table(spark):
    assert token_quality(documents(spark, []), VOCABULARIES).collect() == []
    assert good_texts(documents(spark, []), VOCABULARIES).collect() == []
