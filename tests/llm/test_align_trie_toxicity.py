"""Token alignment and the prefix trie against brute force; toxicity on held-out labels."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import prefix_trie, token_align, toxicity

from samples import SMALL, clashing, empty, messy, messy_rows, workers  # noqa: F401  (fixtures)

# ---------------------------------------------------------------------------
# Token alignment
# ---------------------------------------------------------------------------

ALIGNED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_group_links", "n_best", "count_sum", "groups_sha256"]


def aligned(rows, folder=token_align.TOKENIZERS):
    """Whole texts in plain Python: every byte's tokens, every pair of tokens on it."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side = Tokenizer.from_file(f"{folder}/{token_align.BYTE_BPE}")
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{token_align.PIECE_BPE}")
    letters = token_align._byte_alphabet()

    def piece(i):
        text = b_side.id_to_piece(i)
        return bytes([int(text[3:-1], 16)]) if b_side.is_byte(i) else text.replace("▁", " ").encode()

    found, counts = [], Counter()
    for doc_id, text in rows:
        whole = (" " + (text or "")).encode()
        ids = [a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)] if text else [[], []]
        spelt = [[bytes(letters[c] for c in a_side.id_to_token(i)) for i in ids[0]], [piece(i) for i in ids[1]]]
        if not text or any(b"".join(s) != whole for s in spelt):
            found.append((doc_id, [], [], [], Counter(), 0))
            continue
        on = [[k for k, s in enumerate(side) for _ in s] for side in spelt]
        links = Counter((ids[0][x], ids[1][y]) for x, y in set(zip(*on)))
        counts.update(links)
        ends = [set(np.cumsum([len(s) for s in side]).tolist()) for side in spelt]
        groups, at = [([], [])], [0, 0]
        for end in range(1, len(whole) + 1):
            for side in (0, 1):
                if end in ends[side]:
                    groups[-1][side].append(ids[side][at[side]])
                    at[side] += 1
            if end in ends[0] & ends[1]:
                groups.append(([], []))
        found.append((doc_id, *ids, groups[:-1], links, sum(len(x) * len(y) for x, y in groups)))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for doc_id, a, b, groups, links, in_groups in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), sum(links.values()), in_groups, sum(n for p, n in links.items() if counts[p] == best[p[1]]),
                    sum(n * counts[p] for p, n in links.items()), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


ODD = [
    "a  b\n\n c \t d\t \te", " lead", "tail ", "  ", "x  y  z", "日本語 は ニホンゴ", "<|endoftext|> and <s> <unk> <0x0A>", "a ▁ b", "é   f", "naïve café — “x” …",
    "don't we'll I'm", "1234567 89", "\x00 nul", "🙂 👩‍👩 ok", "​ zero", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "\r\n\r\n", ". . .  . ", "ﬁ ① ﷺ", "x 　 y",
]


def test_alignment_equals_brute_force(spark, messy):
    rng = random.Random(3)
    signs = list("abc  \n\t'.,é日  ▁🙂0<|>")
    rows = [(i, t) for i, (_, t, *_) in enumerate(messy_rows())] + [(1000 + i, t) for i, t in enumerate(ODD)]
    rows += [(2000 + i, "".join(rng.choices(signs, k=rng.randint(1, 60)))) for i in range(300)] + [(None, "no id"), (None, None), (5, "twice"), (5, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("chunk", F.lit("own")).repartition(3)
    texts, pairs = token_align.align_tokens(docs)
    want = aligned(rows)
    assert sorted((tuple(r) for r in texts.select(*ALIGNED).collect()), key=repr) == want
    assert pairs.agg(F.sum("count")).first()[0] == sum(r[4] for r in want)
    assert pairs.groupBy("a_id", "b_id").count().where("count > 1").count() == 0


def test_alignment_in_small_chunks(spark, monkeypatch):
    rows = [(i, t) for i, (_, t, *_) in enumerate(messy_rows())]
    segments = token_align.Segments(token_align.TOKENIZERS)
    monkeypatch.setattr(token_align, "REMEMBERED", 10)
    monkeypatch.setattr(token_align, "EXPANDED", 7)
    whole = {r[0]: r for r in aligned(rows)}
    for begin in range(0, len(rows), 4):
        for (i, _), got in zip(rows[begin : begin + 4], token_align.align([(t or "").encode() for _, t in rows[begin : begin + 4]], segments)):
            assert tuple(got["n"]) == whole[i][1:6] and got["sha"] == whole[i][8]


def test_links_and_groups(spark):
    docs = spark.createDataFrame([(1, "unbelievable naïve 日本"), (2, None), (3, "")], "doc_id long, text string")
    overlap, group = (token_align.token_links(docs, kind).collect() for kind in ("overlap", "group"))
    figures = token_align.align_tokens(docs)[0].where("doc_id = 1").first()
    assert len(overlap) == figures.n_links and len(group) == figures.n_group_links
    assert {(r.a_pos, r.b_pos) for r in overlap} <= {(r.a_pos, r.b_pos) for r in group}
    assert sum(r.shared for r in overlap) == len(" unbelievable naïve 日本".encode())
    with pytest.raises(ValueError):
        token_align.token_links(docs, "other")


def test_alignment_of_an_empty_table(spark, empty):
    texts, pairs = token_align.align_tokens(empty)
    assert texts.count() == 0 and pairs.count() == 0


def test_product_equals_numpy():
    rng = np.random.default_rng(1)
    for shape in ((5, 7, 4), (1, 1, 1), (8, 3, 9)):
        x, y = rng.integers(0, 3, shape[:2]), rng.integers(0, 3, shape[1:])

        def csr(m):
            rows, columns = np.nonzero(m)
            return token_align.Csr(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=len(m)))]), columns, m[rows, columns], m.shape[1])

        z = token_align.product(csr(x), csr(y))
        dense = np.zeros((shape[0], shape[2]), int)
        dense[np.repeat(np.arange(z.rows), np.diff(z.indptr)), z.columns] = z.values
        assert (dense == x @ y).all()


# ---------------------------------------------------------------------------
# Prefix trie
# ---------------------------------------------------------------------------

NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def nodes(rows, rebuild=True):
    """All beginnings of all conversations in a dictionary."""
    conversations = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            conversations[c].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    own = {c: [t[2:] for t in sorted(v)] for c, v in conversations.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if rebuild else 0
        whole[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    members, children, leaves, saved = defaultdict(list), Counter(), Counter(), Counter()
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, found in members.items():
        words = len(re.findall(rb"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(found) - 1) * words
            leaves[p[:d]] += children[p] == 0
    out = []
    for p, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(whole[c]) == len(p))
        out.append((min(found), len(p), min(members[p[:-1]]) if p else None, len(found), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversation_rows():
    rng = random.Random(11)
    say = ["hello", "hello  there you", "", None, "ok then", "a\nb", "x" * 50]
    rows = []
    for c in range(0, 130):
        turns = [(rng.choice(["user", "assistant", None]), rng.choice(say)) for _ in range(rng.choice([1, 2, 3, 4, 5, 8, 9, 13]))]
        if c % 3 == 0:
            turns = [("system", "the same first turn"), ("user", "q"), ("assistant", "r"), ("user", "s"), ("assistant", "t")][: rng.randint(1, 5)] + turns * (c % 2)
        rows += [(c, t if rng.random() > 0.05 else None, *turn) for t, turn in enumerate(turns)]
    rows += [(c, t, "user", f"turn {t}") for c in range(300, 340) for t in range(20)]  # copies, some rebuilt from 300
    rows += [(400, t, "user", f"turn {t}") for t in range(17)] + [(401, t, "user", f"turn {t}") for t in range(16)]
    rows += [(500, 0, "user", "repeated row")] * 2 + [(None, 0, "user", "no id"), (None, None, None, None), (10**12, 1, "user", "long id")]
    return rows


def test_trie_equals_brute_force(spark):
    rows = conversation_rows()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    turns = prefix_trie.numbered_turns(frame.withColumns({c: F.lit("own") for c in ("depth", "p1", "block", "words", "pos")}))
    got = prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns))
    assert sorted((tuple(r) for r in got.select(*NODES).collect()), key=repr) == nodes(rows)
    plain = prefix_trie.trie(frame)
    assert sorted((tuple(r) for r in plain.select(*NODES).collect()), key=repr) == nodes(rows, rebuild=False)


@pytest.mark.parametrize("size", [1, 2, 7])
def test_trie_does_not_depend_on_blocks(spark, monkeypatch, size):
    rows = conversation_rows()
    monkeypatch.setattr(prefix_trie, "BLOCK_TURNS", size)
    monkeypatch.setattr(prefix_trie, "PACK", 3)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert sorted((tuple(r) for r in prefix_trie.trie(frame).select(*NODES).collect()), key=repr) == nodes(rows, rebuild=False)


def test_blocks_without_divergence_are_not_refined(spark):
    """Forty equal conversations of 20 turns: only the start of a sixth block, where all end, is refined."""
    rows = [(c, t, "user", f"turn {t}") for c in range(40) for t in range(20)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = prefix_trie.numbered_turns(frame).withColumnRenamed("pos", "depth")
    found = prefix_trie.beginnings(turns)
    ends = prefix_trie.last_beginnings(found, turns.select("conv_id").distinct())
    groups = prefix_trie.block_groups(found, ends).orderBy("block").collect()
    assert [(g.block, g.n_convs, g.conv_id, g.diverge) for g in groups] == [(b, 40, 0, b == 5) for b in range(6)]


def test_trie_of_an_empty_table(spark):
    assert prefix_trie.trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn long, role string, text string")).count() == 0


# ---------------------------------------------------------------------------
# Toxicity
# ---------------------------------------------------------------------------


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    got = toxicity.op13_toxicity(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    toxic, clean = ([r for r in rows if r.toxic == label] for label in (1, 0))
    rank = np.mean([(np.array([c.score for c in clean]) < t.score).mean() for t in toxic])
    assert rank > 0.75  # a third of the labels are set at random
    assert sum(r.predicted for r in clean) < 0.05 * len(clean)
    assert sum(r.predicted for r in toxic) > 0.45 * len(toxic)


def test_savings_are_lengths_of_whole_texts(monkeypatch):
    """Every byte is in a window, and blocks of windows do not change the figures."""
    rng = random.Random(2)
    judge = toxicity.Judge(b"some ordinary words of prose " * 20, b"an awful word " * 10)
    for size in (0, 1, 19, 20, 39, 40, 41, 60, 61, 100, 399, 400, 401, 800, 805, 1234):
        data = bytes(rng.choices(b"an awful word of prose", k=size))
        found = toxicity.windows(data)
        covered = set()
        for k, w in enumerate(found):
            assert data[k * toxicity.STEP : k * toxicity.STEP + len(w)] == w
            covered |= set(range(k * toxicity.STEP, k * toxicity.STEP + len(w)))
        assert covered == set(range(size))
        saved = judge.savings(found)
        want = [saved.mean() if size else 0, max(len(found), 1) ** -0.5] + [(saved >= t).mean() if size else 0 for t in toxicity.LEVELS]
        monkeypatch.setattr(toxicity, "HELD", 20)
        got = judge.figures(data)
        monkeypatch.undo()
        assert np.allclose(got[:11], want) and np.allclose(judge.figures(data), got)


def test_toxicity_without_classes_and_on_messy_rows(spark, messy, empty, clashing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(messy, toxicity.train(messy, none)).collect()} == {0.5}
    one = spark.createDataFrame([(3, 1), (5, 1)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score(messy, toxicity.train(messy, one)).collect()} == {0.5}
    both = spark.createDataFrame([(3, 1), (5, 0), (5, 1), (13, 0), (None, 1), (14, None), (15, 1)], "doc_id long, toxic int")
    model = toxicity.train(messy, both)
    scored = toxicity.score(messy, model)
    assert scored.count() == messy.count() and scored.where("score is null or score < 0 or score > 1").count() == 0
    assert toxicity.score(empty, model).count() == 0
    kept = toxicity.score(clashing, model, score_col="toxic_score")
    assert kept.columns == [*clashing.columns, "toxic_score"] and {r.row for r in kept.select("row").collect()} == {"own row"}


def test_toxicity_reads_only_the_text(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = toxicity.train(docs, labels)
    rows = docs.select((F.col("doc_id") + 1000).alias("doc_id"), "text", F.lit("other").alias("lang"), F.lit("other").alias("source"))
    a = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    b = {r.doc_id - 1000: r.score for r in toxicity.score(rows, model).collect()}
    assert a == b
