"""The manifest against a plain tree in Python; awkward rows; tampering."""

import hashlib

import duckdb
import pandas as pd
import pytest
from cases import documents, empty, messy, rows  # noqa: F401
from pyspark.sql import functions as F

import __spark_entry__ as entry
from signalguard.llm import merkle

DATA = "/root/testdata/sf0.001"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    """The top of a tree, and the path of each leaf."""
    paths = [[] for _ in leaves]
    at, level = list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, place in enumerate(at):
            first = place - place % 16
            beside = ("".join(level[first:place]), "".join(level[place + 1 : first + 16]))
            paths[i].append(beside)
            at[i] = place // 16
        level = [sha("".join(level[i : i + 16])) for i in range(0, len(level), 16)]
    return level[0], paths


def brute(data):
    """(doc_id, source, leaf, subroot, root, path) of every row."""
    groups = {}
    for row in data:
        leaf = sha("".join(told(v) for v in row))
        groups.setdefault(row["source"], []).append((row["doc_id"], leaf))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for members in groups.values():
        members.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]))
    tops = {s: tree([leaf for _, leaf in groups[s]]) for s in order}
    root, above = tree([tops[s][0] for s in order])
    found = []
    for s, high in zip(order, above, strict=True):
        top, paths = tops[s]
        for (i, leaf), low in zip(groups[s], paths, strict=True):
            found.append((i, s, leaf, top, root, tuple(low + high)))
    return found


def as_rows(df):
    columns = ("doc_id", "source", "leaf", "subroot", "root", "path")
    return [
        (*[r[c] for c in columns[:-1]], tuple((s["left"], s["right"]) for s in r["path"]))
        for r in df.select(*columns).collect()
    ]


def agree(df):
    data = df.select(*FIELDS).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(as_rows(merkle.manifest(df)), key=key) == sorted(brute(data), key=key)


def test_awkward_rows(spark, messy):
    agree(messy)


@pytest.mark.parametrize("count", [1, 2, 16, 17, 256, 257, 600])
def test_sizes_around_runs_and_blocks(spark, count):
    """One source holds all but a few rows; the few are groups of one, NULL among them."""
    data = [(i, f"text {i % 11}", "en", "hot", i) for i in range(count)]
    data += [(5, "x", None, None, None), (6, "", "de", "é", 0), (7, "y", "de", "z", 1)]
    agree(documents(spark, data).repartition(3))


def test_more_groups_than_a_block(spark):
    data = [(i, f"t{i}", "en", f"s{i % 300}" if i % 300 else None, i) for i in range(700)]
    agree(documents(spark, data).repartition(5))


def test_a_changed_byte_is_found(spark):
    df = documents(spark, rows([f"Text {i}" for i in range(40)]))
    changed = merkle.row_digest([F.col(c) for c in FIELDS[:-1]] + [F.lower("text")])
    found = merkle.manifest(df, carry={"other": changed})
    folded = lambda c: merkle.fold_path(F.col(c), F.col("path"))
    got = found.select("root", folded("leaf").alias("same"), folded("other").alias("other"))
    for r in got.collect():
        assert r["same"] == r["root"] != r["other"]


def test_empty_table_and_clashing_results(spark, empty):
    assert merkle.manifest(empty).collect() == []
    with pytest.raises(ValueError):
        merkle.manifest(empty, carry={"leaf": F.lit(1)})


def test_query_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    theirs = duck.execute(entry.oracle_sql()["op12_merkle"]).fetchdf()
    ours = entry.queries()["op12_merkle"](spark, DATA).toPandas()
    by = lambda df: df.sort_values("doc_id", ignore_index=True)[list(ours.columns)]
    pd.testing.assert_frame_equal(by(ours), by(theirs), check_dtype=False)
    assert 0 < (~ours["verified"]).sum() < len(ours) / 3
