"""Operators against brute force without the shortcuts that the operators take."""

import math
import os
import random

import brute
import pytest
from cases import LINE, documents, rows

from signalguard.llm import fuzzy_lines, ngram_lm, queries, substring


def edited_texts():
    """Lines of 4 to 40 words, near copies with up to a quarter of their words edited."""
    rng = random.Random(5)
    words = [f"{rng.choice('abcdefgh') * rng.randrange(1, 7)}{i % 60}" for i in range(200)]
    lines = []
    for size in (4, 5, 6, 8, 10, 14, 20, 40):
        for _ in range(3):
            base = rng.choices(words, k=size)
            lines.append(base)
            for _ in range(6):
                near = list(base)
                for _ in range(rng.randrange(0, size // 4 + 2)):
                    at = rng.randrange(len(near))
                    near[at : at + rng.randrange(2)] = rng.choices(words, k=rng.randrange(2))
                    near = near or ["one"]
                lines.append(near)
    rng.shuffle(lines)
    texts = [" ".join(line) for line in lines]
    return ["\n".join(texts[i : i + 4]) for i in range(0, len(texts), 4)]


def found_lines(groups):
    return {
        (r["doc"]["id"], r["line"]): (r["keep"]["doc"]["id"], r["keep"]["line"])
        for r in groups.collect()
    }


def test_every_similar_line_is_found(spark):
    texts = edited_texts() + ["a a a a a b\na a a a a c", "", None]
    docs = documents(spark, rows(texts)).repartition(3)
    wanted = brute.line_groups(list(enumerate(texts)))
    assert len(set(wanted.values())) < len(wanted) / 2
    assert found_lines(fuzzy_lines.line_groups(docs, least_letters=1)) == wanted


def test_long_similar_lines_are_found(spark):
    """Of long lines some blocks are looked at: at least 0.9 of all similar pairs hang together."""
    rng = random.Random(21)
    words = [f"{rng.choice('klmnop')}{i}" for i in range(400)]
    texts = []
    for size in (30, 60, 120, 240):
        for _ in range(8):
            base = rng.choices(words, k=size)
            near = list(base)
            for at in rng.sample(range(size), rng.randrange(1, size // 5)):
                near[at] = rng.choice(words)
            texts += [" ".join(base), " ".join(near)]
    rng.shuffle(texts)
    wanted = brute.line_groups(list(enumerate(texts)))
    got = found_lines(fuzzy_lines.line_groups(documents(spark, rows(texts)).repartition(3)))
    linked = [place for place, keep in wanted.items() if place != keep]
    assert len(linked) == 32
    assert sum(got[place] == wanted[place] for place in linked) >= 0.9 * len(linked)
    assert all(got[place] in (place, wanted[place]) for place in got)


def test_crowded_keys_are_split(spark, monkeypatch):
    """One block in many lines of several groups: lines without an edit between them still meet."""
    monkeypatch.setattr(fuzzy_lines, "_CROWD", 2)
    rng = random.Random(4)
    words = [f"w{i}" for i in range(500)]
    shared = "one very common passage"
    texts = []
    for _ in range(12):
        base = rng.choices(words, k=10)
        texts += [" ".join([shared, *base]), " ".join([shared, *base[:-1], "edited"])]
    docs = documents(spark, rows(texts)).repartition(3)
    assert found_lines(fuzzy_lines.line_groups(docs)) == brute.line_groups(list(enumerate(texts)))


SHORT = ["Home\nmenu |\n" + LINE, "home\n\n漢字仮名交文\nx", "menu |\n漢字仮名交文\n\nX\n---\n---"]


def at_documents(spark, data, monkeypatch):
    """A folder in name only: the queries read these documents."""
    docs = documents(spark, data)
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    return docs


def test_short_units_are_repeats(spark, monkeypatch):
    at_documents(spark, rows(SHORT), monkeypatch)
    found = queries.op6_substrings(spark, "").collect()
    got = {(r["doc_id"], s["start"], s["end"]) for r in found for s in r["spans"]}
    assert got == brute.repeated_lines(list(enumerate(SHORT))) and len(got) == 5


def test_the_floor_counts_characters():
    text = "漢字仮名交文\nab cd\nab cde"
    found = [text[a:b] for _, a, b, _ in substring.units_of(text, "line", 5)]
    assert found == ["漢字仮名交文", "ab cde"]


def test_short_lines_are_judged(spark, monkeypatch):
    at_documents(spark, rows(SHORT), monkeypatch)
    got = {
        (r["doc_id"], r["line"]): (r["keep_doc_id"], r["keep_line"])
        for r in queries.op8_fuzzy_lines(spark, "").collect()
    }
    assert got == brute.line_groups(list(enumerate(SHORT)))
    assert got[1, 0] == (0, 0) and got[2, 1] == (1, 2) and got[2, 3] == (1, 3)


def once_seen_texts():
    """Most pairs and triples occur once; one word has hundreds of followers."""
    rng = random.Random(8)
    texts = [" ".join(f"hub f{i * 9 + k} g{rng.randrange(40)}" for k in range(9)) for i in range(40)]
    return texts + [" ".join(f"g{rng.randrange(40)}" for _ in range(30)) for _ in range(20)]


def test_once_seen_grams_are_stored(spark, monkeypatch):
    texts = once_seen_texts()
    at_documents(spark, rows(texts), monkeypatch)
    got = queries.op9_language_model(spark, "").orderBy("doc_id").collect()
    train = [t for r, t in zip(got, texts, strict=True) if not r["held_out"]]
    wanted = brute.trigram_scores(train, texts, least=1)
    step = (math.log10(got[0]["train_tokens"] * 2.0) + 0.01) / 255
    for r, (n, _, _, score) in zip(got, wanted, strict=True):
        assert abs(r["score"] - score) <= n * step


@pytest.mark.parametrize("entries", [2_000_000, 50])
def test_followers_over_many_files(spark, monkeypatch, entries):
    monkeypatch.setattr(ngram_lm, "_FILE_ENTRIES", entries)
    texts = once_seen_texts()
    docs = documents(spark, rows(texts))
    model = ngram_lm.learn(docs, least=1)
    assert model.widths[1] == 360 + 1  # the followers of hub
    got = ngram_lm.score_texts(docs, model).orderBy("doc_id").collect()
    wanted = brute.trigram_scores(texts, texts, least=1)
    for r, (n, _, _, score) in zip(got, wanted, strict=True):
        assert abs(r["score"] - score) <= n * model.step


def test_no_key_is_too_crowded_for_a_similar_pair(spark):
    """Links do not depend on how many other lines have a key: edits all over, in a large key."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(900)]
    shared = "one very common passage"
    texts = []
    for _ in range(60):
        base = rng.choices(words, k=6)
        near = list(base)
        near[0], near[3] = rng.choices(words, k=2)  # only the passage is left whole
        texts += [" ".join([shared, *base]), " ".join([shared, *near])]
    docs = documents(spark, rows(texts)).repartition(3)
    assert found_lines(fuzzy_lines.line_groups(docs)) == brute.line_groups(list(enumerate(texts)))


def test_no_long_similar_line_is_missed(spark):
    """Every similar pair shares a key, however long its lines and wherever its edits are."""
    rng = random.Random(33)
    words = [f"{rng.choice('klmnop') * rng.randrange(1, 9)}{i}" for i in range(300)]
    texts = []
    for size in range(20, 200, 3):
        base = rng.choices(words, k=size)
        near = list(base)
        # As many edits as are allowed, evenly spread: no five neighbouring words are left.
        for place in range(size // 5):
            near[place * 5 + rng.randrange(2)] = f"edited{rng.randrange(10**6)}"
        texts += [" ".join(base), " ".join(near)]
    rng.shuffle(texts)
    wanted = brute.line_groups(list(enumerate(texts)))
    assert sum(place != keep for place, keep in wanted.items()) == 60
    assert found_lines(fuzzy_lines.line_groups(documents(spark, rows(texts)).repartition(3))) == wanted


def test_a_model_keeps_only_what_scores_need(spark):
    """Counted n-grams go once they are in the trie; counts stay for contexts only, in few bytes."""
    docs = documents(spark, rows(once_seen_texts()))
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    model = ngram_lm.learn(docs, least=1)
    assert ngram_lm.score_texts(docs, model).count() == 60
    left = {name.rsplit("-", 1)[0] for name in set(os.listdir(root)) - before}
    assert left == {"lm", "lm_files"}
    counts = [name for name in os.listdir(model.folder) if name.endswith(".counts")]
    assert counts and all(name.startswith("grams2-") for name in counts)
    kept, _ = ngram_lm.map_arrays(model.folder, counts[0])
    assert kept["values"].dtype.itemsize <= 2
