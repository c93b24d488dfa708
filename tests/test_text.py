"""Text operators vs straightforward Python versions of the reference semantics."""

from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from ledgerlens.functions import text as T
from ledgerlens.operators import text as X

from conftest import rows

DOCS = [
    (1, "The cat sat. The cat ran!\nDon't stop. Maybe?  Yes."),
    (2, ""),
    (3, "   \n  "),
    (4, "the and of a an"),
    (5, "Straße über Café. Ñandú está aquí. 세종 대왕."),
    (6, "word"),
    (7, "b a. a b. c c. d d."),
    (8, "Line one\nline two.\n"),
    (9, "Dos\r\nLineas.\rTres\r\n"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


# -- brute-force references (plain Python, per document) ----------------------

def py_lines(text):
    if text == "":
        return []
    return re.split(r"\r\n|\r|\n", re.sub(r"(\r\n|\r|\n)\Z", "", text))


def py_dot_sentences(text):
    return [s for line in py_lines(text) for s in line.split(".") if s.strip(" ") != ""]


def py_punct_sentences(text):
    joined = " ".join(py_lines(text))
    return [s.strip() for s in re.split(r"(?<=[.!?])\s+", joined) if s.strip()]


def py_alpha(text):
    return re.findall(r"[A-Za-z']+", " ".join(py_lines(text)))


def py_strip(text, unicode=False):
    if unicode:
        return re.sub(r"[^\w\s]", " ", text.lower()).split()
    return re.sub(r"[^\w\s]", " ", text, flags=re.ASCII).lower().split()


def py_ws_words(text):
    """Whitespace tokens of every dot-sentence, as the text-processing notebook does."""
    out = []
    for s in py_dot_sentences(text):
        out += [w for w in re.split(r"[ \t\n\x0b\f\r]+", s.strip(" ").lower()) if w != ""]
    return out


def kept(words, stop=T.NOTEBOOK_STOPWORDS):
    s = set(stop)
    return [w for w in words if w not in s and len(w) > 1]


def as_lists(df, col):
    return {r.doc_id: list(r[col]) for r in df.collect()}


# -- tests --------------------------------------------------------------------

def test_lines_and_sentences(docs):
    assert as_lists(X.sentence_lists(docs, "dot"), "sentences") == {d: py_dot_sentences(t) for d, t in DOCS}
    assert as_lists(X.sentence_lists(docs, "punct"), "sentences") == {
        d: py_punct_sentences(t) for d, t in DOCS}
    got = rows(X.lines(docs), "doc_id", "line_no", "line")
    want = sorted(((d, i + 1, ln) for d, t in DOCS for i, ln in enumerate(py_lines(t))), key=repr)
    assert got == want


def test_dot_sentence_words(docs):
    got = {r.doc_id: list(r.w) for r in docs.select("doc_id", T.dot_sentence_words(F.col("text")).alias("w")).collect()}
    assert got == {d: py_ws_words(t) for d, t in DOCS}


def test_tokenizers(docs):
    assert as_lists(X.tokens(docs, "alpha"), "words") == {d: py_alpha(t) for d, t in DOCS}
    assert as_lists(X.tokens(docs, "strip"), "words") == {d: py_strip(t) for d, t in DOCS}
    assert as_lists(X.tokens(docs, "strip", unicode=True), "words") == {
        d: py_strip(t, True) for d, t in DOCS}


def test_stopwords_bigrams_and_invariants(docs):
    lowered = X.tokens(docs, "alpha", lower=True)
    k = X.remove_stopwords(lowered)
    want_kept = {d: kept([w.lower() for w in py_alpha(t)]) for d, t in DOCS}
    assert as_lists(k, "words") == want_kept
    bigrams = Counter(p for ws in want_kept.values() for p in zip(ws, ws[1:]))
    got = {(r.w1, r.w2): r["count"] for r in X.bigram_counts(k).collect()}
    assert got == dict(bigrams)
    # bigrams per document = max(kept - 1, 0); kept <= raw
    assert sum(got.values()) == sum(max(len(w) - 1, 0) for w in want_kept.values())
    r = X.kept_vs_raw(lowered).first()
    assert r.kept_tokens <= r.raw_tokens
    assert r.raw_tokens == sum(len(py_alpha(t)) for _, t in DOCS)


def test_top_counts_break_ties_by_key(docs):
    # doc 7: a, b, c, d each appear twice -> ties broken alphabetically
    only7 = docs.filter("doc_id = 7")
    top = X.top_counts(X.word_counts(X.tokens(only7, "strip")), 3, ["word"]).collect()
    assert [(r.word, r["count"]) for r in top] == [("a", 2), ("b", 2), ("c", 2)]


def test_histogram_sums_to_tokens_and_longest(docs):
    lowered = X.tokens(docs, "alpha", lower=True)
    hist = {r.length: r["count"] for r in X.length_histogram(lowered).collect()}
    words = [w.lower() for _, t in DOCS for w in py_alpha(t)]
    assert hist == dict(Counter(len(w) for w in words))
    longest = [r.word for r in X.longest_words(lowered, 3).collect()]
    assert longest == sorted(set(words), key=lambda w: (-len(w), w))[:3]


def test_corpus_and_sentence_stats(docs):
    got = {r.doc_id: r for r in X.corpus_stats(docs).collect()}
    for d, t in DOCS:
        words = py_alpha(t)
        joined = " ".join(py_lines(t))
        r = got[d]
        assert (r.characters, r.lines, r.words) == (len(joined), len(py_lines(t)), len(words))
        assert r.unique_words == len({w.lower() for w in words})
        assert r.avg_word_length == sum(map(len, words)) / max(len(words), 1)
    s = X.sentence_stats(docs).first()
    per = [len(py_alpha(x)) for _, t in DOCS for x in py_punct_sentences(t)]
    assert (s.sentences, s.min_words, s.max_words) == (len(per), min(per), max(per))
    assert s.avg_words_per_sentence == sum(per) / len(per)


def test_first_sentences_and_containing(docs):
    got = rows(X.first_sentences(docs, 2), "doc_id", "n", "sentence")
    want = sorted(((d, i + 1, s) for d, t in DOCS for i, s in enumerate(py_punct_sentences(t)[:2])), key=repr)
    assert got == want
    hits = rows(X.containing(X.sentences(docs, "dot"), "cat"), "doc_id", "sentence")
    want = sorted(((d, s) for d, t in DOCS for s in py_dot_sentences(t) if "cat" in s), key=repr)
    assert hits == want and len(want) == 2


def test_web_stats(docs):
    got = {r.doc_id: r for r in X.web_text_stats(docs, "cat").collect()}
    for d, t in DOCS:
        sents = [s.strip() for s in re.split(r"(?<=[.!?])\s+", t) if s.strip()]
        r = got[d]
        assert (r.total_characters, r.total_words, r.total_sentences) == (
            len(t), len(py_strip(t, True)), len(sents))
        assert r.term_sentences == sum("cat" in s for s in sents)


ALPHABET = "abcXYZ '.,!?-_\n\r\t0é"
# no-break and ideographic space, line separator, superscript, fraction, decomposed accent,
# Devanagari with a vowel sign, Roman numeral, undertie (a connector that is no word character)
WIDE = "ab.!? \n\u00a0\u3000\u2028\x1c\u0085²½e\u0301\u0928\u0940Ⅷ\u203f_7"


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet=WIDE, max_size=30), min_size=20, max_size=40))
def test_unicode_rules_match_python(spark, texts):
    texts = [*texts, "One.\u00a0Two.", "x² + ½", "\u3000wide\u3000. y", "e\u0301a \u0928\u0940\u0928"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert as_lists(X.tokens(df, "strip", unicode=True), "words") == {i: py_strip(t, True) for i, t in enumerate(texts)}
    assert as_lists(X.sentence_lists(df, "punct"), "sentences") == {i: py_punct_sentences(t) for i, t in enumerate(texts)}


def test_text_operators_take_lines(spark, docs):
    lines = X.lines(docs)
    from_lines = rows(X.word_counts(X.tokens(lines, "strip", text_col="line")))
    assert from_lines == rows(X.word_counts(X.tokens(docs, "strip")))
    split = rows(X.sentences(lines, "dot", text_col="line"), "doc_id", "sentence")
    assert split == rows(X.sentences(docs, "dot"), "doc_id", "sentence")


def test_first_sentences_with_a_term_per_document(spark):
    many = spark.createDataFrame([(1, " ".join(f"the {i}." for i in range(30))), (2, "no. yes the. so."), (3, None)], "doc_id long, text string")
    got = rows(X.first_sentences(many, 10, "punct_raw", term="the"), "doc_id", "n", "sentence")
    assert got == sorted([(1, i + 1, f"the {i}.") for i in range(10)] + [(2, 1, "yes the.")], key=repr)


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=20, max_size=40))
def test_tokenizers_match_python_on_random_text(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert as_lists(X.tokens(df, "strip"), "words") == {i: py_strip(t) for i, t in enumerate(texts)}
    assert as_lists(X.tokens(df, "alpha"), "words") == {i: py_alpha(t) for i, t in enumerate(texts)}
    assert as_lists(X.sentence_lists(df, "punct"), "sentences") == {
        i: py_punct_sentences(t) for i, t in enumerate(texts)}
    assert as_lists(X.sentence_lists(df, "dot"), "sentences") == {
        i: py_dot_sentences(t) for i, t in enumerate(texts)}
    got_ws = {r.doc_id: list(r.w) for r in df.select(
        "doc_id", T.dot_sentence_words(F.col("text")).alias("w")).collect()}
    assert got_ws == {i: py_ws_words(t) for i, t in enumerate(texts)}
    got = {r.doc_id: (r.characters, r.lines) for r in X.corpus_stats(df).collect()}
    assert got == {i: (len(" ".join(py_lines(t))), len(py_lines(t))) for i, t in enumerate(texts)}


def test_exclude_words_and_text_order(spark, docs):
    words = X.explode_words(X.tokens(docs, "strip"))
    stop = spark.createDataFrame([(w,) for w in T.WEB_STOPWORDS], "w string")
    left = {r.word for r in X.exclude_words(words, stop).collect()}
    assert left == {w for _, t in DOCS for w in py_strip(t)} - set(T.WEB_STOPWORDS)
    first = [(r.doc_id, r.sentence) for r in X.first_in_text_order(X.sentences(docs, "dot"), 3).collect()]
    assert first == [(d, s) for d, t in DOCS for s in py_dot_sentences(t)][:3]
