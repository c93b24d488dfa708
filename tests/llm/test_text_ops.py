"""Chat formatting, quality, I-Match, URL filter, HTML extraction."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlens.llm import chat_format, html_extract, imatch, quality, url_filter
from ledgerlens.llm.queries import QUERIES

from samples import SMALL, clashing, empty, messy, messy_rows, workers  # noqa: F401  (fixtures)

# -- chat formatting -------------------------------------------------------------

HOSTILE = st.text(alphabet="<|\\>im_startend\nassistant é", max_size=40)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(HOSTILE, HOSTILE), max_size=4))
def test_format_reads_back(turns):
    formatted, spans = chat_format.render([{"role": r, "text": t} for r, t in turns])
    assert chat_format.read_back(formatted) == turns
    assert [chat_format.unescape(formatted[s["start"] : s["stop"]]) for s in spans] == [t for r, t in turns if r == "assistant"]


def test_layouts_become_turns(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi"), (1, 1, "assistant", None), (None, 0, None, "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("prompt", F.lit("clash"))
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat_format.canonical(table).collect()}
    assert got == {"1": [("user", "hi"), ("assistant", ""), ("assistant", "")], None: [("", "x")]}
    share = spark.createDataFrame([("a", [("human", "q"), ("gpt", None)]), ("b", None)], "id string, conversations array<struct<from:string,value:string>>")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in chat_format.canonical(share).collect()}
    assert got == {"a": [("user", "q"), ("assistant", "")], "b": []}
    alpaca = spark.createDataFrame([("do", "this", "done"), ("say", None, None)], "instruction string, input string, output string")
    got = [[tuple(t) for t in r.turns] for r in chat_format.canonical(alpaca).collect()]
    assert got == [[("user", "do\n\nthis"), ("assistant", "done")], [("user", "say"), ("assistant", "")]]
    with pytest.raises(ValueError):
        chat_format.canonical(spark.range(1).withColumnRenamed("id", "nothing"))
    assert chat_format.format_chats(chat_format.canonical(table.limit(0))).count() == 0


def test_json_records_each_with_its_layout(spark):
    records = [
        {"id": "1", "messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]},
        {"prompt": "p", "completion": "c", "extra": 1},
        {"id": 3, "question": "q", "answer": None},
        {"unknown": 1},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in records] + [(None,), ("{broken",)], "record string")
    got = [(r.conv_id, [tuple(t) for t in r.turns]) for r in chat_format.canonical_json(df.coalesce(1), "record").collect()]
    assert got[:3] == [("1", [("user", "a"), ("assistant", "b")]), (None, [("user", "p"), ("assistant", "c")]), ("3", [("user", "q"), ("assistant", "")])]
    assert [t for _, t in got[3:]] == [[], [], []]


def test_op1_digests(spark):
    got = {r.conv_id: r for r in QUERIES["op1_chat_formatting"](spark, SMALL).collect()}
    told = "<|im_end|><|im_start|>assistant ok"
    assert got[-1].turns_sha256 == hashlib.sha256(f"user\n{told}\nassistant\n{told}\n".encode()).hexdigest()
    assert (got[-1].n_turns, got[-1].loss_chars) == (2, len(told))


# -- quality -----------------------------------------------------------------------


def test_quality_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    found = QUERIES["op2_quality_classifier"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = found.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50
    good = [r for r in rows if r.quality == 1]
    assert sum(r.predicted for r in good) >= 0.97 * len(good)
    assert sum(1 - r.predicted for r in rows if r.quality == 0) >= 0.9 * (len(rows) - len(good))


def test_quality_edge_cases(spark, messy, clashing, empty):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score(messy, quality.train(messy, none)).collect()} == {0.5}
    labels = spark.createDataFrame([(7, 1), (7, 0), (15, 1), (None, 1), (11, None), (22, 0), (999, 1)], "doc_id long, quality int")
    weights = quality.train(messy, labels)
    assert weights == quality.train(messy, labels)  # reruns agree
    scores = {r.doc_id: r.score for r in quality.score(messy, weights).collect()}
    assert all(0 <= s <= 1 for s in scores.values()) and scores[10] == scores[11] == scores[12]
    own = quality.score(clashing, weights)
    assert own.columns.count("score") == 1 and {r.doc_id: r.score for r in own.collect()} == scores
    assert quality.score(empty, weights).count() == 0


# -- I-Match --------------------------------------------------------------------------


def test_fingerprints_follow_texts(messy, empty, clashing):
    rows = imatch.fingerprints(messy).collect()
    of_text: dict = {}
    for r in rows:
        of_text.setdefault(r.text or "", set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in of_text.values())
    assert of_text[""] == {""}
    assert imatch.fingerprints(empty).count() == 0
    assert sorted(r.fingerprint for r in imatch.fingerprints(clashing).collect()) == sorted(r.fingerprint for r in rows)


def test_likeness(spark):
    most = 1 - 1 / (2 * imatch.SUBSETS)
    pairs = [
        ("w:1,2|5:01aa,02bb", "w:1,2|5:01aa,02bb", 1.0),
        ("w:1,2|5:01aa,02bb/6:01aa", "v:1,3|5:01aa,02cc/6:01aa", most),  # agree at the next level, but other kept terms
        ("w:1,2|5:01aa,02bb", "v:1,3|5:01aa,02cc/6:09", 0.5),
        ("w:1,2|5:01aa", "v:4,3|6:01aa", 0.0),
        ("", "", 1.0),
        ("", "w:1,2|5:01aa", 0.0),
    ]
    # hashes of other lengths do not matter; an equal level decides
    df = spark.createDataFrame(pairs, "a string, b string, want double")
    got = [(r.near, r.want) for r in df.withColumn("near", imatch.likeness(F.col("a"), F.col("b"))).collect()]
    assert all(x == y for x, y in got)
    agree = [r.m for r in df.withColumn("m", imatch.matching(F.col("a"), F.col("b"))).collect()]
    assert agree == [True, True, True, False, True, False]


def test_rows_do_not_depend_on_splits(spark, monkeypatch):
    """Files are split otherwise between the jobs, as when executors come or go."""
    folder = "/root/testdata/sf0.01"
    query = QUERIES["op4_imatch_fingerprints"]
    want = sorted(map(tuple, query(spark, folder).collect()))
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old, stored, calls = [spark.conf.get(k) for k in keys], imatch.stored, []

    def changed(df, label):
        out = stored(df, label)
        calls.append(label)
        for k in keys:
            spark.conf.set(k, str((100_000, 4_000_000)[len(calls) % 2]))
        return out

    monkeypatch.setattr(imatch, "stored", changed)
    try:
        got = sorted(map(tuple, query(spark, folder).collect()))
    finally:
        for k, v in zip(keys, old):
            spark.conf.set(k, v)
    assert len(calls) > 3 and got == want


def test_repeated_rows_and_broad_subsets(spark):
    rows = [(1, "a b c d"), (1, "a b c d"), (1, "a b c"), (None, "a b x"), (None, "a b x"), (2, "b c only"), (3, "d b a"), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("text", F.coalesce("text", F.lit(""))).repartition(3)
    got = imatch.with_edited(df, parts=3).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in got) == sorted((i is None, i or 0, len(t or "")) for i, t in rows)
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    prints = imatch.fingerprints(docs).select(F.array_sort(imatch.term_hashes(F.col("text"))).alias("terms"), "fingerprint")
    found = prints.where("fingerprint <> ''").groupBy("fingerprint").agg(F.count_distinct("terms").alias("n"), F.collect_set("terms").alias("sets")).where("n > 1").collect()
    counts = {r.term: r.docs for r in imatch.term_counts(docs, []).collect()}
    most = max(2, docs.count() * imatch.MOST_SHARE)
    for r in found:  # texts of one fingerprint have the same kept terms
        assert len({tuple(t for t in terms if 2 <= counts[t] <= most) for terms in r.sets}) == 1


def test_likeness_falls_with_the_overlap(spark):
    # 2,048 words and the first n of them; several vocabularies, as each estimate has few subsets
    words = lambda k, salt: " ".join(f"{salt}w{i}" for i in range(k))
    rows = [(n, words(2048, salt), words(n, salt)) for n in (2048, 1500, 1000, 500, 250) for salt in range(40)]
    df = spark.createDataFrame(rows, "n int, a string, b string")
    for side in "ab":
        kept = df.withColumn("_kept", imatch.term_hashes(F.col(side)))
        df = imatch.with_kept_fingerprint(kept, "_kept", f"f{side}").drop("_kept")
    got = {r.n: r.near for r in df.groupBy("n").agg(F.avg(imatch.likeness(F.col("fa"), F.col("fb"))).alias("near")).collect()}
    assert got[2048] == 1 and 0.6 < got[1500] < 0.85
    assert 0.38 < got[1000] < 0.6 and 0.15 < got[500] < 0.35 and 0.05 < got[250] < 0.2
    back = df.where((imatch.likeness(F.col("fa"), F.col("fb")) != imatch.likeness(F.col("fb"), F.col("fa"))))
    assert back.count() == 0


def test_next_rows_cross_ranges(spark):
    ids = [5, 1, None, 9, 9, 40, 41, 42, 7, -3]
    df = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string")
    ordered = sorted(((-(2**63) if i is None else i, f"t{k}") for k, i in enumerate(ids)))
    want = {t: ordered[(k + 1) % len(ordered)][1] for k, (_, t) in enumerate(ordered)}
    for parts in (1, 3, 8):
        got = {r.text: r.next_text for r in imatch.with_next(df, "doc_id", ["text"], parts).collect()}
        assert got == want
    assert imatch.with_next(df.limit(0), "doc_id", ["text"]).count() == 0
    one = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert imatch.with_next(one, "doc_id", ["text"]).first().next_text == "a"


def test_op4_edits(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted((r.doc_id, r.text or "") for r in rows)
    got = {r.doc_id: r for r in QUERIES["op4_imatch_fingerprints"](spark, SMALL).collect()}
    better = 0
    for k, (i, text) in enumerate(rows):
        after, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i].n_chars == len(text) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        better += got[i].near_edited > got[i].near_next
    assert better >= 0.8 * len(rows)


def _whole_lexicon(texts, edits):
    """For each edited text its terms in the band of ``texts``, or all if none is."""
    sets = [set(t.split()) for t in texts]
    docs: dict = {}
    for words in sets:
        for w in words:
            docs[w] = docs.get(w, 0) + 1
    most = max(2, len(texts) * imatch.MOST_SHARE)
    return [{w for w in e.split() if 2 <= docs.get(w, 0) <= most} or set(e.split()) for e in edits]


def test_band_is_of_terms_however_many(spark):
    # 300,000 words of one document only in a few texts: hashed to 2**20 places a good part would share one
    rng = random.Random(1)
    shared = [f"s{i}" for i in range(400)]
    texts = [" ".join([f"own{k}x{i}" for i in range(15000)] + rng.sample(shared, 60)) for k in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    alone = [" ".join(sorted(words)) for words in _whole_lexicon(texts, texts)]
    want = spark.createDataFrame(list(enumerate(alone)), "doc_id long, text string")
    kept = want.withColumn("_kept", imatch.term_hashes(F.col("text")))
    want = imatch.with_kept_fingerprint(kept, "_kept", "f")
    assert {r.doc_id: r.fingerprint for r in imatch.fingerprints(df).collect()} == {r.doc_id: r.f for r in want.collect()}


def test_op4_is_as_by_brute_force(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted((r.doc_id, r.text or "") for r in rows)
    texts = [t for _, t in rows]
    edits = [t[: len(t) - len(t) // 2] + texts[(k + 1) % len(texts)][: len(t) // 2] for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in QUERIES["op4_imatch_fingerprints"](spark, SMALL).collect()}
    for column, of in (("fingerprint", texts), ("edited_fingerprint", edits)):
        alone = [(i, " ".join(sorted(words))) for (i, _), words in zip(rows, _whole_lexicon(texts, of))]
        kept = spark.createDataFrame(alone, "doc_id long, text string").withColumn("_kept", imatch.term_hashes(F.col("text")))
        want = imatch.with_kept_fingerprint(kept, "_kept", "f")
        assert {i: r[column] for i, r in got.items()} == {r.doc_id: r.f for r in want.collect()}


# -- URL filter ------------------------------------------------------------------------


def test_urls_and_rules(spark):
    urls = {
        "http://a.NET/x": ("a.net", "/x", "net/", "block"),
        "https://m.example.net/en/25#top": ("m.example.net", "/en/25", "example.net/en/", "allow"),
        "https://example.net/e": ("example.net", "/e", "net/", "block"),
        "http://example.com/de/?q=/": ("example.com", "/de/", "example.com/de/", "block"),
        "http://notexample.com/de/1": ("notexample.com", "/de/1", None, None),
        "x://b.org/fr/": ("b.org", "/fr/", "org/fr/", "allow"),
        "http://b.org?x=http://y.net/": ("b.org", "", None, None),
        "http://planet/x": ("planet", "/x", None, None),
        "http://net": ("net", "", None, None),
        "no scheme": ("", "", None, None),
        None: ("", "", None, None),
    }
    df = spark.createDataFrame([(u, "own") for u in urls], "url string, verdict string")
    for r in url_filter.judge(df).collect():
        host, path, rule, verdict = urls[r.url]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
    assert url_filter.judge(df.limit(0)).count() == 0
    unruled = url_filter.judge(df, rules=()).collect()
    assert {r.score for r in unruled} == {0.0} and {r.verdict for r in unruled} == {"allow"}


def test_models_tell_hosts_apart(spark):
    good, bad = [f"http://garden{i}.example.org/fr/{i}" for i in range(40)], [f"http://casino{i}.win.net/{i}" for i in range(40)]
    new = ["http://garden7.example.info/3", "http://casino9.win.info/4"]
    got = {r.url: r.verdict for r in url_filter.judge(spark.createDataFrame([(u,) for u in good + bad + new], "url string")).collect()}
    assert got[new[0]] == "allow" and got[new[1]] == "block"


def test_models_learn_longer_contexts_and_all_characters(spark):
    # the same trigrams in both classes, told apart by the order of longer pieces or by characters outside ASCII only
    good = [f"http://x.org/fr/{a}" for a in ("qabrabs", "qacracs")] * 30 + ["http://y.org/fr/\u00e9\u00e9"] * 30
    bad = [f"http://x.net/{a}" for a in ("qabracs", "qacrabs")] * 30 + ["http://y.net/\u00fc\u00fc"] * 30
    new = [f"http://z.info/{a}" for a in ("qabrabs", "qabracs", "\u00e9\u00e9", "\u00fc\u00fc")]
    rows = url_filter.judge(spark.createDataFrame([(u,) for u in good + bad + new], "url string")).collect()
    score = {r.url: r.score for r in rows}
    assert score["http://z.info/qabrabs"] > score["http://z.info/qabracs"] + 0.01
    assert score["http://z.info/\u00e9\u00e9"] > score["http://z.info/\u00fc\u00fc"] + 0.01


# -- HTML ------------------------------------------------------------------------------


def test_pages():
    text = html_extract.main_text
    assert text(None) == text("") == text("<p> </p>") == ""
    page = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=x>Menu entry</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, a long notice that nobody reads, really nobody.</p></div>
    <article><h1>Head &amp; line</h1><p><b>First   paragraph with<br>some words &lt;here&gt;.<p>Second&nbsp;one, rather long too.<div class="ad">Buy this now, a very long advert text with words</div>
    <ul><li>One<li>Two</ul><form><p>Subscribe</p></form><div id="comments"><p>A reader comment of great length and little use.</p></div></article>
    <aside><p>Sidebar text that is quite long, longer than anything</p></aside><footer><p>&copy; footer of the page</p></footer></body>"""
    assert text(page) == "Head & line\nFirst paragraph with some words <here>.\nSecond one, rather long too.\nOne\nTwo"
    bare = "<div><a href=1>x</a> <a href=2>y</a></div><p>" + "A long paragraph. " * 20 + "</p><p>" + "Another long one. " * 15 + "</p><div><a>z</a></div>"
    assert text(bare).startswith("A long paragraph.") and text(bare).endswith("Another long one.")
    assert len(text("<article><p>" + "word " * 200000 + "</p></article>")) == 5 * 200000 - 1
    assert text("<article><p>cut off in the mid") == "cut off in the mid"


PROSE = "A sentence of the article that goes on for a while, as sentences do. "


def test_clusters_decide_without_landmarks(spark):
    html = [r.html or "" for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    whole = [html_extract.main_text(h) for h in html]
    assert all(whole)
    for plain in (("<div>", "</div>"), ("<section class=x1>", "</section>"), ("", "")):
        bare = [html_extract.main_text(h.replace("<article>", plain[0]).replace("</article>", plain[1])) for h in html]
        assert sum(map(len, bare)) >= 0.95 * sum(map(len, whole))
        assert sum(a == b for a, b in zip(whole, bare)) >= 0.95 * len(whole)


def test_elements_without_known_names():
    text = html_extract.main_text
    links = "<div class=x9>" + "".join(f"<a href={i}>Elsewhere {i}</a> " for i in range(9)) + "</div>"
    body = f"<div><h2>Head</h2><p>{PROSE * 5}</p><p>{PROSE * 3}</p><p>Short end.</p></div>"
    expected = "Head\n" + "\n".join([(PROSE * 5).strip(), (PROSE * 3).strip(), "Short end."])
    assert text(f"<body><nav><a>m</a></nav>{links}{body}{links}<footer>f</footer></body>") == expected
    parts = f"<div><h1>Top</h1><section><h2>One</h2><p>{PROSE * 5}</p></section><section><h2>Two</h2><p>{PROSE * 4}</p><p>End.</p></section></div>"
    got = text(f"<body><nav><a>m</a></nav>{links}{parts}<footer>f</footer></body>").split("\n")
    assert (got[0], got[1], got[3], got[-1]) == ("Top", "One", "Two", "End.")
    assert text(f"<article><p>{PROSE}</p><p><a href=x>Linked line</a></p><p>{PROSE}</p></article>").split("\n")[1] == "Linked line"


def test_class_names_count_as_a_whole():
    page = f'<body><article><p class="share-price">12.30</p><section id="related-work"><p>{PROSE}</p></section><p>{PROSE}</p><p class="comment-list">No</p><div class="x ads">No</div></article></body>'
    assert html_extract.main_text(page) == "\n".join(["12.30", PROSE.strip(), PROSE.strip()])


def test_ratios_smoothing_threshold_against_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        lines = [
            html_extract.Line("x", rng.choice([0, 3, 40, 900]), 0, rng.randint(0, 6), rng.random() < 0.2, rng.random() < 0.5, 0)
            for _ in range(rng.randint(1, 30))
        ]
        weighed = []
        for line in lines:
            r = line.plain / (line.tags or 1)
            weighed.append(0 if line.furniture else 2 * r if line.landmark else r)
        smooth = []
        for i in range(len(lines)):
            near = [j for j in range(len(lines)) if abs(i - j) <= 3]
            bells = [2.718281828459045 ** (-((i - j) ** 2) / 2) for j in near]
            smooth.append(sum(w * weighed[j] for w, j in zip(bells, near)) / sum(bells))
        mean = sum(smooth) / len(smooth)
        spread = (sum((x - mean) ** 2 for x in smooth) / len(smooth)) ** 0.5
        if any(abs(x - spread) < 1e-9 for x in smooth):
            continue
        expected = [max(smooth) > 0 and x >= min(spread, max(smooth)) and not line.furniture for x, line in zip(smooth, lines)]
        assert html_extract.upper_cluster(lines) == expected


def test_deep_and_stray_tags():
    deep = "<b>" * 20000 + "".join("<p>ab</p></i></u>" for _ in range(20000))
    assert html_extract.main_text(deep) == "\n".join(["ab"] * 20000)
    assert html_extract.main_text("<div>" * 20000 + PROSE) == PROSE.strip()


def test_extract_keeps_columns(spark):
    pages = spark.createDataFrame([(1, None, "<article><p>a b</p></article>", "own"), (2, "u", None, "own")], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.url, r.text) for r in html_extract.extract(pages).collect()}
    assert got == {1: (None, "a b"), 2: ("u", "")}
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_messy_rows_have_every_null():
    assert all(any(r[k] is None for r in messy_rows()) for k in range(5))
