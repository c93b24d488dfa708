"""Rows and fixtures of the tests of the training-data operators."""

from __future__ import annotations

import random

import pytest


SMALL = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    from ledgerlens.llm import workers_import

    workers_import(spark)


def messy_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties, copies, near copies, repeated rows."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzé", k=rng.randint(2, 8))) for _ in range(600)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n))
    base, passage, long = prose(120), prose(30), prose(6000)
    words = base.split()
    rows = [
        (7, base, "en", "a", 1),
        (3, base, "en", "a", 1),
        (3, base, "en", "a", 1),
        (4, base.upper(), "en", None, 1),
        (5, " ".join(words[:60] + ["new"] + words[60:]), None, "b", None),
        (6, " ".join(words[:40] + prose(50).split() + words[90:]), "en", "b", 2),
        (10, None, None, None, None),
        (11, "", "en", "c", 0),
        (12, " \n\t ", "en", "c", 4),
        (13, "two words", "en", "c", 9),
        (14, "two  words", "en", "c", 10),
        (15, f"{prose(20)}\n{passage}\t{prose(20)}", "en", "a", 0),
        (16, f"{prose(5)} {passage.replace(' ', '  ')} {prose(5)}", "en", "a", 0),
        (17, passage, "en", "d", 0),
        (20, long, "en", "a", 0),
        (21, long[20000:] + " " + prose(100), "fr", "d", 0),
        (22, "ab " * 3000, "en", "d", 0),
        (None, prose(40), None, "a", 3),
        (None, base, "en", "a", 1),
        (-5, "ünïcode " + passage[:120] + "日本語" * 30, "xx", "b", 0),
        (30, "日本語" * 30 + passage[10:150], "xx", "b", 0),
    ]
    return rows + [(100 + i, prose(rng.randint(1, 80)), "en", rng.choice("abcd"), 0) for i in range(40)]


@pytest.fixture(scope="module")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(messy):
    """Extra columns with the names that operators use for theirs."""
    from pyspark.sql import functions as F

    names = "_id _tag _row _singles _score _terms _kept _common _range id tag row home n meta part spans kept n_words hits matches score size target copies pass shard value one block keys host rule verdict band label turn".split()
    return messy.withColumns({name: F.lit(f"own {name}") for name in names})
