"""The queries over the smallest tables, against SQL and brute force."""

import hashlib
import zlib

import brute
import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline

DATA = "/root/testdata/sf0.001"
DOCS = pd.read_parquet(f"{DATA}/documents.parquet").sort_values("doc_id", ignore_index=True)
LABELS = pd.read_parquet(f"{DATA}/labels.parquet")


def fold(i, parts):
    return zlib.crc32(str(i).encode()) % parts


def result(spark, name):
    found = entry.queries()[name](spark, DATA).toPandas()
    assert len(found) == len(DOCS)
    return found.sort_values("doc_id", ignore_index=True)


@pytest.mark.parametrize("name", ["op1_decontaminate", "op4_rules"])
def test_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    theirs = duck.execute(entry.oracle_sql()[name]).fetchdf()
    ours = result(spark, name)
    theirs = theirs.sort_values("doc_id", ignore_index=True)[list(ours.columns)]
    pd.testing.assert_frame_equal(ours, theirs, check_dtype=False)


def test_simhash(spark):
    got = result(spark, "op2_simhash")
    wanted = brute.document_groups(DOCS["text"])
    assert list(zip(got["fingerprint"], got["component_id"], strict=True)) == wanted


def test_quality(spark):
    got = result(spark, "op3_quality")
    assert got["held_out"].tolist() == [fold(i, 4) == 2 for i in got["doc_id"]]
    assert got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.7)).all()
    held = got[got["held_out"]].merge(LABELS, on="doc_id")
    assert (held["predicted"] == held["quality"]).mean() >= 0.9


def test_language(spark):
    got = result(spark, "op5_language")
    held = got["held_out"].to_numpy()
    assert held.tolist() == [fold(i, 4) == 2 for i in got["doc_id"]]
    assert (got["lang_pred"] == DOCS["lang"])[held].mean() >= 0.95


def test_substrings(spark):
    got = result(spark, "op6_substrings")
    spans = {(i, s["start"], s["end"]) for i, row in zip(got["doc_id"], got["spans"], strict=True) for s in row}
    assert spans == brute.repeated_lines(list(zip(DOCS["doc_id"], DOCS["text"], strict=True)))


def test_passages(spark):
    got = result(spark, "op6_substrings")
    spans = {
        (i, *p) for i, row in zip(got["doc_id"], got["passages"], strict=True) for p in map(tuple, row)
    }
    assert spans == brute.shared_passages(list(zip(DOCS["doc_id"], DOCS["text"], strict=True)))


def test_token_files(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start = 0
    for text, r in zip(DOCS["text"], result(spark, "op7_token_files").itertuples(), strict=True):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_language_model(spark):
    got = result(spark, "op9_language_model")
    train = [t for i, t in zip(DOCS["doc_id"], DOCS["text"], strict=True) if fold(i, 7) != 2]
    step = None
    for r, (n, known, base, score) in zip(
        got.itertuples(), brute.trigram_scores(train, DOCS["text"]), strict=True
    ):
        step = step or (np.log10(r.train_tokens * 2.0) + 0.01) / 255
        assert r.held_out == (fold(r.doc_id, 7) == 2)
        assert (r.n_tokens, r.n_known) == (n, known)
        assert abs(r.base_score - base) <= 1e-6 * abs(base)
        assert abs(r.score - score) <= n * step
    held = got[got["held_out"]]
    assert held["score"].sum() > held["base_score"].sum()


def test_bpe(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for text, r in zip(DOCS["text"], result(spark, "op10_bpe").itertuples(), strict=True):
        ids = tok.encode(text or "", add_special_tokens=False).ids
        raw = np.array(ids, dtype="<u4").tobytes()
        decoded = tok.decode(ids, skip_special_tokens=False).encode()
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(raw).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(decoded).hexdigest()


def test_pipeline(spark):
    """Each stage against brute force on what the stage before it kept."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "lines", "near_duplicates", "benchmark", "encode"]
    kept = {}
    for name, stage in stages.items():
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name}-{id(docs)}"
        stage(spark, docs, DATA).write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs.toPandas().sort_values("doc_id", ignore_index=True)
        assert name == "encode" or docs.columns == names
    letters = [any(c.isalpha() for c in t or "") for t in DOCS["text"]]
    assert kept["language"]["doc_id"].tolist() == DOCS["doc_id"][letters].tolist()
    before = kept["language"]
    groups = brute.line_groups(list(zip(before["doc_id"], before["text"], strict=True)))
    cut = [
        "\n".join(s for n, s in enumerate(t.split("\n")) if groups.get((i, n), (i, n)) == (i, n))
        for i, t in zip(before["doc_id"], before["text"], strict=True)
    ]
    assert kept["lines"]["text"].tolist() == cut
    assert kept["lines"]["n_chars"].tolist() == [len(t) for t in cut]
    ids = before["doc_id"].tolist()
    found = brute.document_groups(cut)
    single = [i for n, i in enumerate(ids) if found[n][1] == n]
    assert kept["near_duplicates"]["doc_id"].tolist() == single
    items = pd.read_parquet(f"{DATA}/benchmark.parquet")
    hits = brute.contamination(
        kept["near_duplicates"]["text"], list(zip(items["item_id"], items["text"], strict=True))
    )
    clean = [i for i, (n, h, _) in zip(single, hits, strict=True) if not (h and 20 * h >= n)]
    assert kept["benchmark"]["doc_id"].tolist() == clean
    assert kept["encode"]["doc_id"].tolist() == clean
    for text, sha in zip(kept["benchmark"]["text"], kept["encode"]["decoded_sha256"], strict=True):
        assert hashlib.sha256(text.encode()).hexdigest() == sha
