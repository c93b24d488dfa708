"""Column-level text helpers: line/sentence splitting, tokenizers, stopword lists.

Everything is a built-in expression (``split``, ``regexp_*``, higher-order
``transform``/``filter``), evaluated per row inside whole-stage codegen.  A
document is one row, so per-document sequences (sentences, token lists,
bigrams) are arrays built in that row: no shuffle and no sort is needed to keep
text order.

Regex dialect notes (Java): ``\\w``/``\\s`` are ASCII-only unless the pattern
starts with ``(?U)``, whose classes differ from other languages'.  The notebook's
tokenizers are ASCII, the web app's are Unicode (``unicode=True``).  Unicode classes
are spelled out so that every engine reads them the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results)
# ---------------------------------------------------------------------------

# Stopwords of the text-statistics notebook, as written there (109 distinct words).
NOTEBOOK_STOPWORDS_TEXT = """a an and are as at be been being but by for from has
have had he her his i in is it its of on or our she such that the their
them they this to was were will with you your we us he she it i my me am
are was were so not no if then than do does did doing have has had having
can could should would may might must shall just into about over under
between among during after before above below up down out off again
further once here there when where why how all any both each few more
most other some only own same who whom which what new"""

# Stopwords of the web app's text endpoints, as written there (54 distinct words).
WEB_STOPWORDS_TEXT = """a an and are as at be been being but by for from has
have had he her his i in is it its of on or our she such that the their
them then there these they this to was will with you list update category
from table select order group by limit where into from"""

# Word pattern of the statistics cells: runs of ASCII letters and apostrophes.
ALPHA_WORD = "[A-Za-z']+"
# Runs of ASCII word characters (what is left when all others become spaces).
WORD = r"\w+"
# Unicode white space, as Python's str.isspace and its regular expressions know it.
UNICODE_SPACE = r"\t-\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
# The same characters spelled out, for plain string functions.
UNICODE_SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# Runs of word characters (letters, any kind of number, underscore).
WORD_UNICODE = r"[\p{L}\p{N}_]+"
# Whitespace runs that separate tokens.
WHITESPACE = r"\s+"
# Line terminators of text files (as line-oriented text readers split them).
LINE_BREAK = r"\r\n|\r|\n"
# Sentence split of the statistics cells: whitespace after . ! or ?
SENTENCE_BREAK = rf"(?<=[.!?])[{UNICODE_SPACE}]+"
# Sentence split of the text-processing notebook: every dot.
DOT = r"\."
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _unique(text: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(text.split()))


NOTEBOOK_STOPWORDS = _unique(NOTEBOOK_STOPWORDS_TEXT)
WEB_STOPWORDS = _unique(WEB_STOPWORDS_TEXT)


# ---------------------------------------------------------------------------
# Column functions
# ---------------------------------------------------------------------------

def lines_of(text: Column) -> Column:
    """Lines of a text: split on line terminators; a final terminator ends the
    last line rather than starting an empty one; empty text has no lines."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(without_final_break(text), LINE_BREAK))


def joined_lines(text: Column) -> Column:
    """Lines joined by one space: the notebook's ``" ".join(lines)`` (plain string functions)."""
    joined = without_final_break(text)
    for piece in ("\r\n", "\r", "\n"):
        joined = F.replace(joined, F.lit(piece), F.lit(" "))
    return joined


def py_strip(c: Column) -> Column:
    """Strip leading/trailing whitespace (all Unicode whitespace, like ``str.strip``)."""
    return F.btrim(c, F.lit(UNICODE_SPACES))


def dot_sentences(text: Column) -> Column:
    """Sentences of the text-processing notebook: each line split at every dot,
    pieces that are blank after trimming spaces dropped (order kept)."""
    pieces = F.flatten(F.transform(lines_of(text), lambda line: F.split(line, DOT)))
    return F.filter(pieces, lambda s: F.trim(s) != "")


def punct_sentences(text: Column) -> Column:
    """Sentences of the statistics cells: split after ``.``/``!``/``?`` followed
    by whitespace, stripped, empty ones dropped.

    Breaks take all white space between sentences, so only the text's own ends are
    stripped; only a blank text has an empty sentence then.
    """
    return F.filter(F.split(py_strip(text), SENTENCE_BREAK), lambda s: s != "")


def alpha_words(text: Column, lower: bool = False) -> Column:
    """Runs of ASCII letters/apostrophes, case kept unless ``lower``.

    Line breaks and spaces are outside the class, so the words of a text equal
    the words of its space-joined lines.  Words are lower-cased one by one: they
    are ASCII, for which ``lower`` maps bytes, while ``translate`` looks up every
    character of the text (as much time again as finding the words).
    """
    words = F.regexp_extract_all(text, F.lit(ALPHA_WORD), F.lit(0))
    return F.transform(words, F.lower) if lower else words


def without_final_break(text: Column) -> Column:
    """The text without one final line terminator (plain string functions)."""
    n = F.length(text)
    return (
        F.when(text.endswith("\r\n"), text.substr(F.lit(1), n - 2))
        .when(text.endswith("\n") | text.endswith("\r"), text.substr(F.lit(1), n - 1))
        .otherwise(text)
    )


def _occurrences(text: Column, piece: str) -> Column:
    return ((F.length(text) - F.length(F.replace(text, F.lit(piece), F.lit("")))) / len(piece)).cast("bigint")


def line_count(text: Column) -> Column:
    """Number of lines (``size(lines_of(text))``) by counting terminators."""
    t = without_final_break(text)
    breaks = _occurrences(t, "\r") + _occurrences(t, "\n") - _occurrences(t, "\r\n")
    return F.when(text == "", F.lit(0).cast("bigint")).otherwise(breaks + 1)


def joined_length(text: Column) -> Column:
    """``length(joined_lines(text))``: every terminator becomes one space, the last is dropped."""
    t = without_final_break(text)
    return (F.length(t) - _occurrences(t, "\r\n")).cast("bigint")


def strip_words(text: Column, unicode: bool = False) -> Column:
    """Punctuation to spaces, lower case, split on whitespace, empties dropped.

    ASCII (``unicode=False``): the notebook order, replace then lower.
    Unicode: the web app order, lower then replace.  Either way the words are the runs
    of word characters, found in one pass.
    """
    if unicode:
        return F.regexp_extract_all(F.lower(text), F.lit(WORD_UNICODE), F.lit(0))
    return F.regexp_extract_all(F.translate(text, ASCII_UPPER, ASCII_UPPER.lower()), F.lit(WORD), F.lit(0))


def dot_sentence_words(text: Column) -> Column:
    """``whitespace_words`` of every dot-sentence of the text, in order, in one pass.

    Dot-sentences break at every ``.`` and line terminator, and whitespace
    tokenizing (after trimming spaces) breaks at every whitespace run, so the
    tokens are exactly the maximal runs of characters that are neither ``.``
    nor ASCII whitespace.  Each token is lower-cased on its own, which equals
    lower-casing its sentence: whitespace and dots end any case context.
    """
    return F.transform(F.regexp_extract_all(text, F.lit(r"[^.\s]+"), F.lit(0)), F.lower)


def whitespace_words(text: Column) -> Column:
    """Lower-cased, space-trimmed text split on whitespace; punctuation kept."""
    return F.filter(F.split(F.lower(F.trim(text)), WHITESPACE), lambda w: w != "")


def without_stopwords(words: Column, stopwords, min_len: int = 2) -> Column:
    """Tokens not in ``stopwords`` and at least ``min_len`` characters long (order kept).

    ``isin`` over a literal list becomes a hash-set lookup (``InSet``).
    """
    stop = list(stopwords)
    return F.filter(words, lambda w: (~w.isin(stop)) & (F.length(w) >= min_len))


def adjacent_pairs(words: Column) -> Column:
    """``zip(xs, xs[1:])`` as an array of structs ``(w1, w2)``."""
    n = F.size(words)
    return F.when(n < 2, F.array().cast("array<struct<w1:string,w2:string>>")).otherwise(
        F.arrays_zip(
            F.slice(words, 1, n - 1).alias("w1"),
            F.slice(words, 2, n - 1).alias("w2"),
        ).cast("array<struct<w1:string,w2:string>>")
    )
