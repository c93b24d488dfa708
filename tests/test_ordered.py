"""Order across rows: lines of split files, ranks, neighbours, sentences, exports and versions."""

from __future__ import annotations

import glob
import json
import random
import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.functions import text as T
from ledgerlens.operators import ordered as O
from ledgerlens.operators import retail as R
from ledgerlens.operators import text as X
from ledgerlens.operators.cleaning import type_profile
from ledgerlens.plans.catalogue import QUERIES
from ledgerlens.sources import read_table, sinks

WORD = re.compile("[A-Za-z']+")


@pytest.fixture()
def small_splits(spark):
    """Files are cut every 200 bytes, so that lines and sentences cross many splits."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "200")
    yield
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


def make_lines(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    words = ["Alpha", "beta.", "gamma!", "the", "of", "x", "delta?", "it's", " ", "", "...", "　", "eins", "zwei."]
    return [" ".join(rng.choices(words, k=rng.choice([0, 0, 1, 2, 5, 30]))) for _ in range(n)]


def write_files(folder, texts: dict[str, list[str]], end="\n") -> str:
    for name, lines in texts.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as fh:
            fh.write("".join(line + end for line in lines))
    return str(folder)


@pytest.fixture()
def files(tmp_path):
    return {f"part-{i:05d}-x.txt": make_lines(i, n) for i, n in enumerate((150, 0, 1, 60))}


def sentences_of(lines: list[str]) -> list[str]:
    return [s.strip() for s in re.split(r"(?<=[.!?])\s+", " ".join(lines)) if s.strip()]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_lines_of_split_files_are_numbered(spark, small_splits, tmp_path, files, end):
    placed = O.placed_lines(spark, write_files(tmp_path, files, end))
    assert placed.select("doc_id", "part").distinct().count() > 20
    got = sorted((r.doc_id.rsplit("/", 1)[-1], r.line_no, r.line) for r in O.numbered_lines(placed).collect())
    assert got == sorted((name, i, line) for name, lines in files.items() for i, line in enumerate(lines, 1))
    whole = [r.line for r in O.numbered_lines(placed, whole=True).orderBy("line_no").collect()]
    assert whole == [line for name in sorted(files) for line in files[name]]


def test_pairs_cross_lines_and_splits(spark, small_splits, tmp_path, files):
    placed = O.placed_lines(spark, write_files(tmp_path, files))
    kept = placed.withColumn("words", T.without_stopwords(T.alpha_words(F.col("line"), lower=True), T.NOTEBOOK_STOPWORDS, 2))
    keep = lambda lines: [w for w in WORD.findall(" ".join(lines).lower()) if w not in T.NOTEBOOK_STOPWORDS and len(w) > 1]
    every = keep([line for name in sorted(files) for line in files[name]])
    assert {(r.w1, r.w2): r["count"] for r in O.bigram_counts(kept, whole=True).collect()} == Counter(zip(every, every[1:]))
    apart = Counter()
    for lines in files.values():
        words = keep(lines)
        apart.update(zip(words, words[1:]))
    assert {(r.w1, r.w2): r["count"] for r in O.bigram_counts(kept).collect()} == apart


def test_words_of_lines_are_made_and_their_ends_shuffled_once(spark, small_splits, tmp_path):
    texts = {3: "Alpha beta\r\nthe of\n\nGAMMA it's", 1: "x one\rTwo of\n", 2: None, 4: "", 5: "alpha Beta\n\n", 7: "ÄIß two \u212a one"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    counts = QUERIES["lines_top_bigrams"](spark, str(tmp_path))
    got = [(r.w1, r.w2, r["count"]) for r in counts.collect()]
    words = [w for k in sorted(texts) for w in WORD.findall(texts[k] or "") if len(w) > 1]
    kept = [w.lower() for w in words if w.lower() not in T.NOTEBOOK_STOPWORDS]
    assert got == sorted(((*p, n) for p, n in Counter(zip(kept, kept[1:])).items()), key=lambda r: (-r[2], r[0], r[1]))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "regexp_extract_all" not in plan and "ReusedExchange" in plan


def test_sentences_cross_lines_and_splits(spark, small_splits, tmp_path, files):
    placed = O.placed_lines(spark, write_files(tmp_path, files))
    every = sentences_of([line for name in sorted(files) for line in files[name]])
    got = [(r.n, r.sentence) for r in O.sentences_of_lines(placed, whole=True).orderBy("n").collect()]
    assert got == list(enumerate(every, 1))
    sizes = [len(WORD.findall(s)) for s in every]
    stats = O.sentence_stats_of_lines(placed, whole=True).first()
    assert (stats.sentences, stats.min_words, stats.max_words) == (len(every), min(sizes), max(sizes))
    assert abs(stats.avg_words_per_sentence - sum(sizes) / len(sizes)) < 1e-12
    first = O.sentences_of_lines(placed, first=3).collect()
    want = {(name, i, s) for name, lines in files.items() for i, s in enumerate(sentences_of(lines)[:3], 1)}
    assert {(r.text_id.rsplit("/", 1)[-1], r.n, r.sentence) for r in first} == want
    sizes = [len(WORD.findall(s)) for lines in files.values() for s in sentences_of(lines)]
    stats = O.sentence_stats_of_lines(placed).first()
    assert (stats.sentences, stats.min_words, stats.max_words) == (len(sizes), min(sizes), max(sizes))


def test_a_text_without_sentence_ends_is_one_sentence(spark, small_splits, tmp_path):
    placed = O.placed_lines(spark, write_files(tmp_path, {"a.txt": ["some words go on"] * 100 + ["", " "]}))
    assert [r.sentence for r in O.sentences_of_lines(placed).collect()] == [" ".join(["some words go on"] * 100)]
    assert O.sentence_stats_of_lines(placed).first().max_words == 400
    empty = O.placed_lines(spark, write_files(tmp_path, {"a.txt": []}))
    assert O.sentences_of_lines(empty).count() == 0 and O.numbered_lines(empty).count() == 0
    assert O.sentence_stats_of_lines(empty).first().sentences == 0


def test_ranks_of_a_whole_list(spark):
    rng = random.Random(4)
    rows = [(f"w{i}", min(50, int(1 / (rng.random() + 1e-3)))) for i in range(5000)]
    df = spark.createDataFrame(rows, "word string, count long").repartition(7)
    ranked = O.numbered(df, [F.col("count").desc(), F.col("word").asc()])
    got = [(r.word, r["count"]) for r in ranked.orderBy("rank").collect()]
    assert got == sorted(rows, key=lambda r: (-r[1], r[0]))
    assert [r.rank for r in ranked.orderBy("rank").collect()] == list(range(1, 5001))
    assert O.numbered(df.limit(0), [F.col("word").asc()]).count() == 0


def test_exported_list_is_one_list_over_its_parts(spark, scratch):
    rows = [(f'word{i % 90}, "{i}"', i % 7) for i in range(500)] + [("", 3), (" blank ", 3)]
    df = spark.createDataFrame(rows, "word string, count long").repartition(5)
    path = f"{scratch}/list"
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sinks.write_ranked_csv(df, path, [("count", False), ("word", True)])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    parts = sorted(glob.glob(f"{path}/part-*"))
    assert len(parts) > 1
    lines = [line for part in parts for line in open(part, encoding="utf-8").read().splitlines()]
    assert lines[0] == "word,count" and lines.count("word,count") == 1
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    got = O.read_ranked_csv(spark, path, "word string, count long").orderBy("rank").collect()
    assert [(r.word, r["count"], r.rank) for r in got] == [(w, c, i) for i, (w, c) in enumerate(want, 1)]
    manifest = [json.loads(line) for f in glob.glob(f"{path}/_manifest/part-*") for line in open(f)]
    assert [m["part"] for m in manifest] == [p.rsplit("/", 1)[-1] for p in parts if open(p).read()]
    assert sum(m["lines"] for m in manifest) == len(lines)


def test_versions_of_a_table(spark, scratch):
    name, base = "ll_versions", f"{scratch}/versions"
    first = sinks.write_version(spark.range(3).toDF("k"), name, base)
    before = read_table(spark, name)
    second = sinks.write_version(spark.range(10, 15).toDF("k"), name, base)
    assert first != second and sinks.table_location(spark, name) == second
    assert sorted(r.k for r in before.collect()) == [0, 1, 2]  # a frame opened before reads the old rows
    assert sorted(r.k for r in read_table(spark, name).collect()) == [10, 11, 12, 13, 14]
    assert sinks.write_version(spark.range(1).toDF("k"), name, base, mode="ignore") == second
    assert read_table(spark, name).count() == 5
    # replaced by what was read from it
    sinks.write_version(read_table(spark, name).withColumn("k", F.col("k") + 1), name, base)
    assert sorted(r.k for r in read_table(spark, name).collect()) == [11, 12, 13, 14, 15]
    assert len(sinks.release_versions(spark, name, base)) == 2
    assert read_table(spark, name).count() == 5 and len(glob.glob(f"{base}/v-*")) == 1
    spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("buckets", [1, 7, 64, 1 << 16])
def test_sketched_top_words(spark, buckets):
    rng = random.Random(9)
    docs = [(i, [f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(300)]) for i in range(20)] + [(99, [])]
    lists = spark.createDataFrame(docs, "doc_id long, words array<string>")
    want = X.top_counts(X.word_counts(lists), 8, ["word"]).collect()
    assert X.top_counts_sketched(lists, 8, buckets).collect() == want
    assert X.top_counts_sketched(lists, 5000, buckets).count() == X.word_counts(lists).count()
    assert X.top_counts_sketched(lists.limit(0), 8, buckets).count() == 0


def test_distinct_counts_by_bitmap(spark):
    rng = random.Random(6)
    rows = [(rng.choice("abc"), rng.choice([None, -5, -40000, 0, 1, 32767, 32768, 32769, 10**12, rng.randint(0, 100000)])) for _ in range(3000)] + [("none", None)]
    df = spark.createDataFrame(rows, "k string, id long").repartition(5)
    got = {r.k: r.n for r in R.distinct_by_bitmap(df, "k", "id", "n").collect()}
    assert got == {k: len({i for x, i in rows if x == k and i is not None}) for k in ("a", "b", "c", "none")}


def test_preview_counts_while_it_reads(spark):
    df = spark.range(5000).toDF("k").repartition(6)
    got = sinks.preview_once(df, [F.col("k").desc()], 3).collect()
    assert sorted((r.k, r.total_rows) for r in got) == [(4997, 5000), (4998, 5000), (4999, 5000)]
    assert sinks.preview_once(df.limit(0), [F.col("k").desc()], 3).count() == 0


def test_type_profile(spark):
    rows = [("1", "1.5", "2024-02-29", "x", None, "7"), ("-2", "1e3", "2024-02-30", "1", "", "8 pcs"), (" 3 ", ".5", "2023-01-01", "2020-01-01", None, "9"), (None, "4", "", "y", "  ", "10")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string")
    got = {r["column"]: (r.filled, r.empty, r.type, r.bad) for r in type_profile(df).collect()}
    assert got == {"a": (3, 1, "integer", 0), "b": (4, 0, "number", 0), "c": (3, 1, "date", 1), "d": (4, 0, "text", 0), "e": (0, 4, "text", 0), "f": (4, 0, "number", 1)}
    assert {r.type for r in type_profile(df.limit(0)).collect()} == {"text"}


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet="aB1_é½.!? \t\n\r\x0b\x85　 -'", max_size=40))
def test_rewritten_text_rules(spark, text):
    df = spark.createDataFrame([(text,)], "t string").select(
        T.joined_lines(F.col("t")).alias("joined"), T.punct_sentences(F.col("t")).alias("sentences"), T.py_strip(F.col("t")).alias("strip"),
        T.strip_words(F.col("t"), unicode=True).alias("words"), T.strip_words(F.col("t")).alias("ascii"))
    r = df.first()
    lines = re.split("\r\n|\r|\n", re.sub("(\r\n|\r|\n)\\Z", "", text)) if text else []
    assert r.joined == " ".join(lines) and r.strip == text.strip()
    assert r.sentences == [s.strip() for s in re.split(r"(?<=[.!?])\s+", text) if s.strip()]
    assert r.words == re.sub(r"[^\w\s]", " ", text.lower()).split()
    assert r.ascii == re.sub(r"[^A-Za-z0-9_ \t\n\x0b\f\r]", " ", text).lower().split()
