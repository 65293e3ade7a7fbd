"""Periodic runs against a quadratic search; awkward rows."""

import random
import zlib

import duckdb
import pandas as pd
import pytest
from cases import TEXTS, documents, empty, messy, rows  # noqa: F401

import __spark_entry__ as entry
from signalguard.llm import periodic

DATA = "/root/testdata/sf0.001"


def brute_runs(words, least_length=6, least_repeats=4):
    """Every period is tried at every place; the smallest period of a stretch counts."""
    found = {}
    for q in range(1, len(words) // least_repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least_length, least_repeats * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    n, kinds = rng.choice([0, 1, 5, 20, 90]), rng.choice([1, 2, 3, 8])
    words = [b"w%d" % rng.randrange(kinds) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = 1 + (n - a) // (3 + rng.randrange(8))
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


@pytest.mark.parametrize(("length", "repeats"), [(6, 4), (2, 2), (3, 3)])
def test_runs_of_many_texts_at_once(length, repeats, monkeypatch):
    rng = random.Random(length)
    for most in (2_000_000, 7):  # also with children looked at a few at a time
        monkeypatch.setattr(periodic, "ROUND_SUFFIXES", most)
        for _ in range(60):
            texts = [random_words(rng) for _ in range(rng.randrange(1, 9))]
            for words, (runs, short) in zip(
                texts, periodic._round(texts, length, repeats), strict=True
            ):
                got = [(r["start"], r["length"], r["period"]) for r in runs]
                assert got == brute_runs(words, length, repeats)
                assert short == brute_collapsed(words, got)


def test_awkward_rows(spark, messy):
    found = periodic.find_runs(messy, keep=messy.columns, runs="found", collapsed="short")
    assert found.columns == [*messy.columns, "found", "short"]
    got = found.collect()
    assert len(got) == messy.count()
    for r in got:
        words = (r["text"] or "").encode().split()
        runs = [tuple(x) for x in r["found"]]
        if len(words) < 5000:
            assert runs == brute_runs(words)
        assert r["short"].encode() == brute_collapsed(words, runs)
        assert (r["_row"], r["held"], r["chunk"]) == ("x", "x", "x")
    assert any(r["found"] for r in got)


def test_rows_go_through_rounds_of_any_size(spark, messy, monkeypatch):
    whole = sorted(map(str, periodic.find_runs(messy).collect()))
    monkeypatch.setattr(periodic, "ROUND_WORDS", 1)
    assert sorted(map(str, periodic.find_runs(messy).collect())) == whole


def test_empty_table_and_clashing_results(spark, empty):
    assert periodic.find_runs(empty).collect() == []
    assert periodic.with_planted_runs(empty).collect() == []
    with pytest.raises(ValueError):
        periodic.find_runs(empty.withColumnRenamed("line", "runs"), keep=["runs"])
    with pytest.raises(ValueError):
        periodic.find_runs(empty, least_repeats=1)


def test_planted_tails(spark):
    texts = [" ".join(f"t{i}w{j}" for j in range(i % 37)) for i in range(300)] + [None, " \n"]
    got = periodic.with_planted_runs(documents(spark, rows(texts))).collect()
    assert len(got) == len(texts)
    planted = 0
    for r in got:
        text = texts[r["doc_id"]]
        h = zlib.crc32(str(r["doc_id"]).encode())
        words = (text or "").split()
        if h % 10 or not text:
            assert r["text"] == text or (h % 10 == 0 and not words and r["text"] in ("", None))
            continue
        n, g = len(words), h // 10
        if n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            planted += 1
        assert r["text"] == " ".join(words)
    assert planted > 5


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    theirs = duck.execute(entry.oracle_sql()["op11_periodic_runs"]).fetchdf()
    ours = entry.queries()["op11_periodic_runs"](spark, DATA).toPandas()
    by = lambda df: df.sort_values("doc_id", ignore_index=True)[list(ours.columns)]
    numbers = dict.fromkeys(["start", "length", "period", "exponent_milli"], "Int64")
    pd.testing.assert_frame_equal(
        by(ours).astype(numbers), by(theirs).astype(numbers), check_dtype=False
    )
    assert (ours["n_runs"] > 0).any()
