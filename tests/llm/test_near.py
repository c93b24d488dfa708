"""Bottom-k near-duplicates against brute force."""

from __future__ import annotations

import random
import re

import pytest

from ledgerlens.llm import bottomk
from ledgerlens.llm.tables import components

from samples import clashing, empty, messy, messy_rows, workers  # noqa: F401  (fixtures)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
LAST = 2**63 - 1


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= size:
        return frozenset(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    return frozenset([tuple(words)]) if words else frozenset()


def classes(rows, size, percent):
    """(id, set size, component) of each row, all pairs tried."""
    sets = [(LAST if i is None else i, shingles(t, size)) for i, t in rows]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            common = len(x & y)
            if common and 100 * common >= percent * (len(x) + len(y) - common):
                up[root(a)] = root(b)
    least: dict = {}
    for k, (i, _) in enumerate(sets):
        least[root(k)] = min(least.get(root(k), LAST), i)
    return sorted((i, len(s), least[root(k)]) for k, (i, s) in enumerate(sets))


def found(df):
    return sorted((r.id, r.n_shingles, r.component_id) for r in df.collect())


ROWS = [(r[0], r[1]) for r in messy_rows()]


@pytest.mark.parametrize(("shingle", "percent"), [(3, 85), (5, 80), (1, 50)])
def test_components_against_brute_force(messy, shingle, percent):
    assert found(bottomk.near_duplicates(messy, shingle=shingle, percent=percent)) == classes(ROWS, shingle, percent)


def family(n=260, seed=11):
    """Edited copies of one text, from near to far, and a line that many documents share."""
    rng = random.Random(seed)
    words = [f"w{rng.randrange(5000)}" for _ in range(150)]
    rows = []
    for i in range(n):
        copy = list(words)
        for _ in range(rng.randrange(12)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        rows.append((i * 3, " ".join(copy)))
    line = "one very common line that a third of all documents share"
    return rows + [(10_000 + i, f"{line} " + " ".join(f"y{rng.randrange(10**6)}" for _ in range(20))) for i in range(n)]


def test_large_groups_in_blocks(spark, monkeypatch):
    rows = family()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = classes(rows, 3, 85)
    assert len({c for _, _, c in want}) < len(rows)
    monkeypatch.setattr(bottomk, "BLOCK", 32)  # lists fall into many pairs of blocks
    assert found(bottomk.near_duplicates(docs, shingle=3, percent=85)) == want


def test_one_of_each_group_stays(messy, clashing, empty):
    want = {i for i, _, c in classes(ROWS, 5, 80) if i == c}
    for docs in (messy, clashing):
        kept = bottomk.drop_near_duplicates(docs)
        assert kept.columns == docs.columns
        ids = [LAST if r.doc_id is None else r.doc_id for r in kept.collect()]
        assert set(ids) == want and len(ids) == len(want)
    assert bottomk.near_duplicates(empty).count() == bottomk.drop_near_duplicates(empty).count() == 0


def test_cutoffs_and_list_values():
    assert (1 - 0.85) ** bottomk.list_values(0.85) <= bottomk.MISS
    cut = bottomk.cutoffs(0.85)
    assert cut[0] == 0 and all(cut[n] <= n * 0.85 for n in range(1, len(cut)))


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 100), (102, 101), (101, 103)]
    edges = spark.createDataFrame(chain, "a long, b long")
    got = {r.a: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 102: 101, 103: 101}
