"""Super-k-mers, prefix doubling and decontamination against brute force."""

from __future__ import annotations

import random
import re

import pytest

from ledgerlens.llm import decontam, passages, suffix_dedup, superkmer
from ledgerlens.llm.queries import QUERIES

from samples import SMALL, clashing, empty, messy, messy_rows, workers  # noqa: F401  (fixtures)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LAST = 2**63 - 1


def order(doc_id):
    return LAST if doc_id is None else doc_id


def covered(rows, parts_of, width):
    """(id, parts, mask) of every row, by trying all windows."""
    parts = [(order(i), parts_of(t or "")) for i, t in rows]
    first: dict = {}
    for i, p in parts:
        for k in range(len(p) - width + 1):
            win = tuple(p[k : k + width])
            first[win] = min(first.get(win, LAST + 1), i)
    out = []
    for i, p in parts:
        mask = [False] * len(p)
        for k in range(len(p) - width + 1):
            if first[tuple(p[k : k + width])] < i:
                mask[k : k + width] = [True] * width
        out.append((i, p, mask))
    return out


def spans_of(mask):
    cuts = [k for k in range(len(mask) + 1) if (mask[k] if k < len(mask) else False) != (mask[k - 1] if k else False)]
    return list(zip(cuts[::2], cuts[1::2]))


def found(df, *cols):
    return sorted(((order(r["doc_id"]), *(r[c] if not isinstance(r[c], list) else [tuple(x) for x in r[c]] for c in cols)) for r in df.collect()), key=repr)


def expected(rows, parts_of, width, join):
    return sorted(
        ((i, len(p), spans_of(m), join([x for x, gone in zip(p, m) if not gone])) for i, p, m in covered(rows, parts_of, width)), key=repr
    )


ROWS = [(r[0], r[1]) for r in messy_rows()]


@pytest.mark.parametrize("window", [13, 8])
def test_words_against_brute_force(messy, window):
    got = found(superkmer.repeated_words(messy, window=window), "n_words", "spans", "kept")
    assert got == expected(ROWS, WORD.findall, window, " ".join)


@pytest.mark.parametrize("window", [50, 31])
def test_bytes_against_brute_force(messy, window):
    got = found(suffix_dedup.repeated_bytes(messy, window=window), "n_bytes", "spans", "kept")
    assert got == expected(ROWS, lambda t: list(t.encode()), window, bytes)


@pytest.mark.parametrize("seed", range(4))
def test_periodic_texts_against_brute_force(spark, workers, seed):
    """A seed that stands in a window more than once, at other places in other documents."""
    rng = random.Random(seed)
    motifs = ["".join(rng.choices("ab c", k=n)) for n in (1, 2, 3, 5, 7, 9, 12)] + ["ab cd ef gh "]
    rows = []
    for i in range(40):
        text = ""
        for _ in range(rng.randint(1, 6)):
            motif, phase = rng.choice(motifs), rng.randrange(12)
            text += (motif * 40)[phase : phase + rng.randint(1, 120)] + "".join(rng.choices("xyz ", k=rng.randint(0, 9)))
        rows.append((rng.choice([i, i, 7]), text))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for window in (24, 50):
        got = found(suffix_dedup.repeated_bytes(docs, window=window), "n_bytes", "spans", "kept")
        assert got == expected(rows, lambda t: list(t.encode()), window, bytes)
    for window in (5, 13):
        got = found(superkmer.repeated_words(docs, window=window), "n_words", "spans", "kept")
        assert got == expected(rows, WORD.findall, window, " ".join)


def test_small_batches_of_windows_agree(messy, monkeypatch):
    whole = found(suffix_dedup.repeated_bytes(messy), "n_bytes", "spans")
    method = passages.Method(50, suffix_dedup._cut(50), suffix_dedup._read, suffix_dedup.SEED, suffix_dedup._seeds, suffix_dedup._least(50))
    import pyarrow as pa

    rows = [(order(i), k, t or "") for k, (i, t) in enumerate(ROWS)]
    batch = pa.record_batch([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows])], names=["id", "tag", "text"])
    monkeypatch.setattr(passages, "RESOLVE_WINDOWS", 64)
    spans: dict = {}
    for part in passages._resolve_part(method, 1)(passages._cut_chunks(method, 1)([batch])):
        held = passages._Held([(n, m) for n, m in zip(part["n"].to_pylist(), part["meta"].to_pylist())])
        for i, tag, a, b in zip(held.id, held.tag, held.start, held.stop):
            spans.setdefault(int(tag), set()).update(range(a, b))
    size = {k: len(t.encode()) for _, k, t in rows}
    again = [(i, size[k], [tuple(x) for x in spans_of([p in spans.get(k, ()) for p in range(size[k])])]) for i, k, _ in rows]
    assert sorted(again, key=repr) == whole


def test_text_is_cut_at_whole_characters(messy):
    kept = {r.doc_id: r.text for r in suffix_dedup.drop_repeats(messy).collect()}
    assert kept[7] == "" and kept[10] == "" and "\ufffd" not in kept[30]
    assert len(kept) == len({r[0] for r in ROWS})


def test_empty_tables_and_clashing_columns(empty, clashing):
    assert superkmer.repeated_words(empty).count() == suffix_dedup.repeated_bytes(empty).count() == 0
    words = superkmer.repeated_words(clashing)
    assert found(words, "n_words", "spans", "kept") == expected(ROWS, WORD.findall, 13, " ".join)
    assert {r.home for r in words.collect()} == {"own home"} and "text" in words.columns
    assert found(suffix_dedup.repeated_bytes(clashing), "n_bytes", "spans", "kept") == expected(ROWS, lambda t: list(t.encode()), 50, bytes)


# -- decontamination -----------------------------------------------------------

ITEMS = [(1, " ".join(ROWS[0][1].split()[10:35])), (2, "TWO, words!"), (3, None), (4, "!!"), (5, ROWS[14][1][3000:3400]),
         (None, " ".join(ROWS[0][1].split()[50:70])), (1, "nothing like it"), (6, "ab " * 40)]


def plain(text):
    return PLAIN.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def leaks(rows, items, width=10):
    windows: dict = {}
    for item, text in items:
        words = plain(text)
        size = min(width, len(words))
        for k in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[k : k + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    for i, text in rows:
        words, ids = plain(text), set()
        mask = [False] * len(words)
        for size in sizes:
            for k in range(len(words) - size + 1):
                hit = windows.get(tuple(words[k : k + size]))
                if hit:
                    ids |= hit
                    mask[k : k + size] = [True] * size
        yield order(i), len(words), spans_of(mask), sorted({str(x) for x in ids if x is not None})


@pytest.mark.parametrize("block", [decontam.BLOCK_BYTES, 150])
def test_matches_against_brute_force(spark, messy, clashing, block):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = sorted(leaks(ROWS, ITEMS), key=repr)
    for docs in (messy, clashing):
        got = decontam.verbatim_matches(docs, bench, block_bytes=block).collect()
        assert sorted(((order(r.doc_id), r.n_words, [tuple(s) for s in r.hits], sorted({m.item_id for m in r.matches})) for r in got), key=repr) == want


def test_longest_matches_are_verbatim(spark, messy):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    texts = {str(i): plain(t) for i, t in ITEMS if i not in (None, 1)}
    texts["1"] = plain(ITEMS[0][1])
    seen = 0
    for r in decontam.verbatim_matches(messy, bench).collect():
        words = plain(r.text)
        for m in r.matches:
            item = texts[m.item_id]
            assert words[m.start : m.start + m.n_words] == item[m.item_start : m.item_start + m.n_words]
            ahead = (m.start + m.n_words, m.item_start + m.n_words)
            longer = ahead[0] < len(words) and ahead[1] < len(item) and words[ahead[0]] == item[ahead[1]]
            assert not longer
            seen += 1
    assert seen > 5


def test_decontaminate_keeps_clean_documents(spark, messy, empty):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = sorted(order(r.doc_id) for r in decontam.decontaminate(messy, bench).collect())
    assert kept == sorted(i for i, _, spans, _ in leaks(ROWS, ITEMS) if not spans)
    assert decontam.decontaminate(empty, bench).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(messy, none).count() == messy.count()


def test_query_columns(spark):
    assert QUERIES["op7_suffix_dedup"](spark, SMALL).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
