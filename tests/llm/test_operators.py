"""Each operator on awkward rows, on none, and against its brute-force version."""

import gc
import random
import time
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from cases import LINE, TEXTS, documents, empty, messy, others_kept, rows  # noqa: F401
from pyspark.sql import functions as F

from signalguard.llm import (
    bpe,
    decontam,
    fuzzy_lines,
    langid,
    ngram_lm,
    quality_knn,
    rules,
    simhash,
    substring,
    token_files,
)
from signalguard.llm.base import stored
from signalguard.llm.components import components
from signalguard.llm.elias_fano import Bits, Children, Monotone, map_arrays, write_arrays

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def pairs(df):
    """(id, text) of every row, to compare by row rather than by id."""
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def near_copies(seed=3, count=40):
    """Texts with words changed here and there, and their copies."""
    rng = random.Random(seed)
    words = [f"term{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=120)) for _ in range(6)]
    out = []
    for _ in range(count):
        w = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 8])):
            w[rng.randrange(len(w))] = rng.choice(words)
        out.append(" ".join(w))
    return out


# --- components ----------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)]
    links += [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    links += [(500, n) for n in range(501, 560)] + [(7, 7)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    real = [(a, b) for a, b in links if a != b]
    nodes = {n for link in real for n in link}
    got = {r["node"]: r["component"] for r in components(df).collect()}
    assert got == brute.groups(nodes, real)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- decontamination -----------------------------------------------------------------

ITEMS = [
    (1, " ".join(f"w{i}" for i in range(30))),
    (2, " ".join(f"w{i}" for i in range(5, 25)) + " other end"),
    (3, "only three words"),
    (4, None),
    (5, ""),
    (6, "Three WORDS"),
    (None, "a nameless item of six words"),
    (1, "same id once more"),
]


@pytest.mark.parametrize("block", [200_000, 25])
def test_decontamination(spark, messy, block):
    rng = random.Random(5)
    run = lambda a, n: " ".join(f"w{i}" for i in range(a, a + n))
    texts = [run(0, 13), run(0, 12), run(3, 20), run(9, 40), "xx " * 300 + run(0, 13)]
    texts += ["ONLY three-words", "three words", "only three word", "a nameless item of six words"]
    texts += [" ".join(rng.choices([f"w{i}" for i in range(12)], k=200)) for _ in range(5)]
    docs = messy.unionByName(documents(spark, rows(texts, 100)))
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    found = decontam.find_contamination(
        docs, items, keep=["text", "_text"], block_words=block
    )
    got = sorted(
        (
            r["doc_id"] if r["doc_id"] is not None else -1,
            r["text"] or "",
            r["n_words"],
            r["n_hit"],
            r["item_ids"],
            sum(s["end"] - s["start"] for s in r["spans"]),
            r["contaminated"],
        )
        for r in found.collect()
    )
    data = pairs(docs)
    wanted = brute.contamination([t for _, t in data], [(str(i), t) for i, t in ITEMS])
    assert got == sorted(
        (i if i is not None else -1, t or "", n, h, names, h, h > 0 and 20 * h >= n)
        for (i, t), (n, h, names) in zip(data, wanted, strict=True)
    )


def test_spans_are_cut(spark):
    item = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    texts = [f"Before, {item.upper()}! After it.", f"{'x ' * 900}{item}", None, item]
    docs = documents(spark, rows(texts))
    got = [r["text"] for r in decontam.remove_spans(docs, items).orderBy("doc_id").collect()]
    assert got == ["Before, After it.", texts[1], None, ""]
    assert decontam.remove_contaminated(docs, items).where("doc_id IN (0, 3)").count() == 0


def test_decontamination_of_nothing(spark, messy, empty):
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert decontam.find_contamination(messy, items).where("n_hit > 0 OR contaminated").count() == 0
    assert decontam.find_contamination(empty, items).count() == 0
    assert decontam.remove_contaminated(messy, items).count() == messy.count()


# --- SimHash -------------------------------------------------------------------------


def test_near_duplicates(spark):
    texts = near_copies() + [None, "", "one", "one", "Two words", "two WORDS"]
    df = documents(spark, rows(texts)).repartition(5)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(texts))] == brute.document_groups(texts)


def test_near_duplicates_of_awkward_rows(messy, empty):
    found = simhash.near_duplicates(messy).collect()
    assert len(found) == messy.count()
    blank = {r["component_id"] for r in found if r["fingerprint"] == "0" * 16}
    assert blank == {0}
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.one_per_group(messy)
    assert kept.columns == messy.columns and others_kept(kept)
    assert {r["doc_id"] for r in kept.collect()} == {r["component_id"] for r in found}
    texts = [t for _, t in pairs(messy)]
    assert kept.count() == len({group for _, group in brute.document_groups(texts)})
    assert simhash.one_per_group(empty).count() == 0


def test_hot_key_is_dealt_out(spark):
    """Thousands of fingerprints around one, compared in small cells, hang together."""
    rng = np.random.default_rng(2)
    flips = [sum(1 << int(b) for b in rng.choice(30, size=k, replace=False)) for k in (0, 1, 2, 3) for _ in range(150)]
    bits = sorted({(0x1234 << 40) ^ f for f in flips} | {7, 1 << 60})
    df = spark.createDataFrame([(b,) for b in bits], "bits bigint")
    links = simhash.find_links(df, cell=16).collect()
    arr = np.array(bits, dtype=np.uint64)
    true = [(bits[a], bits[int(b)]) for a in range(len(arr)) for b in np.flatnonzero(np.bitwise_count(arr[a] ^ arr) <= 3) if b > a]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    assert brute.groups(bits, [tuple(r) for r in links]) == brute.groups(bits, true)


def test_pivot_table_never_discards_a_link():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2**63, 4000).astype(np.uint64)
    other = bits.copy()
    for _ in range(3):
        other ^= np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64)
    both = np.concatenate([bits, other])
    i = np.arange(4000)
    found, _ = simhash.linked(simhash.pivot_table(both, simhash.pivots()), both, i, i + 4000, 3)
    assert len(found) == 4000
    far, _ = simhash.linked(simhash.pivot_table(bits, simhash.pivots()), bits, i[:-1], i[1:], 3)
    assert len(far) == 0


# --- quality classifier --------------------------------------------------------------


def quality_data(count=400):
    rng = random.Random(4)
    words = "of the and that river stone under quiet morning light walked".split()
    out, labels = [], []
    for i in range(count):
        w = rng.choices(words, k=80)
        bad = i % 4 == 0
        text = " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w).capitalize() + "."
        out.append(text)
        labels.append((i, 0 if bad else 1))
    return out, labels


def test_quality_votes(spark, messy, empty):
    texts, labels = quality_data()
    docs = documents(spark, rows(texts))
    marks = spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id bigint, quality int")
    model = quality_knn.fit(docs, marks.where("doc_id % 5 <> 2 OR doc_id IS NULL"))
    scored = {r["doc_id"]: r["score"] for r in quality_knn.score_quality(docs, model).collect()}
    held = [(scored[i], q) for i, q in labels if i % 5 == 2]
    assert np.mean([(s >= 0.7) == bool(q) for s, q in held]) >= 0.97
    assert all(0 <= s <= 1 for s in scored.values())
    awkward = quality_knn.score_quality(messy, model, keep=["doc_id", "text"]).collect()
    assert len(awkward) == messy.count()
    assert all(r["score"] == 0 for r in awkward if not (r["text"] or "").split())
    assert quality_knn.score_quality(empty, model).count() == 0


def test_votes_are_exact_cosines(spark):
    texts, labels = quality_data(80)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    model = quality_knn.fit(documents(spark, rows(texts)), marks, nearest=5)
    counts = np.stack([quality_knn.Counter().counts(t.encode()) for t in texts[:20]])
    got = model.scores(counts, block=7)
    for row, score in zip(model.place(counts), got, strict=True):
        cosine = model.vectors @ row
        near = np.argsort(-cosine, kind="stable")[:5]
        w = np.maximum(cosine[near], 1e-6) ** model.sharpness
        assert abs(score - (w * model.labels[near]).sum() / w.sum()) < 1e-4


def test_quality_without_labels(spark, messy):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    model = quality_knn.fit(messy, none)
    assert {r["score"] for r in quality_knn.score_quality(messy, model).collect()} == {0.0}


# --- quality rules -------------------------------------------------------------------


def test_base_measures(messy, empty):
    found = rules.judge(messy)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = sorted(str((r["doc_id"], *[r[n] for n in names])) for r in found.collect())
    assert got == sorted(str((i, *brute.base_measures(t))) for i, t in pairs(messy))
    assert rules.judge(empty).count() == 0


def test_fences_follow_the_group(spark):
    """A source of long words passes among its like and fails among short ones."""
    long = [" ".join(f"{'abcdefghijklmnopqrst'[i % 7:]}{i}{j}" for j in range(60)) for i in range(60)]
    short = [" ".join(f"ab{i % 3}{j % 50}" for j in range(60)) for i in range(60)]
    data = [(i, t, "en", "long" if i < 60 else "short", len(t)) for i, t in enumerate(long + short)]
    data.append((120, long[0], "en", "short", 1))
    data += [(121, long[1], None, None, 1), (122, long[2], "en", "alone", 1)]
    got = {r["doc_id"]: r["kept"] for r in rules.judge(documents(spark, data), least=50).collect()}
    assert all(got[i] for i in range(120))
    assert not got[120]
    assert len(got) == len(data)


def test_bins_keep_leading_bits(spark):
    values = [0, 1, 63, 64, 65, 127, 128, 1000, 123456789]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r[0] for r in df.select(rules.bin_of(F.col("v"))).collect()]
    assert got == [v >> max(0, v.bit_length() - 6) << max(0, v.bit_length() - 6) for v in values]


# --- language identification ---------------------------------------------------------


def test_forward_sums_all_segmentations():
    vocabulary = langid.vocabulary(PIECES)
    found = langid.Lattice(vocabulary)
    rng = np.random.default_rng(1)
    chances = rng.random((found.size + 1, 3)) / 50
    words = ["the", "thethe", "straße", "a", "漢字x", "q" * 70, "international"]
    for at, letters in langid.by_length(words):
        got = langid.forward(found, letters, chances)
        for row, i in zip(got, at, strict=True):
            for lang in range(3):
                p = dict(zip(vocabulary, chances[:, lang], strict=False))
                wanted = brute.segmentations("▁" + words[i], p, chances[-1, lang])
                assert abs(row[lang] - np.log(wanted)) < 1e-6


def test_expected_pieces():
    vocabulary = langid.vocabulary(PIECES)
    found = langid.Lattice(vocabulary)
    chances = np.random.default_rng(1).random(found.size + 1) / 50
    p = dict(zip(vocabulary, chances, strict=False))
    word = "thethe"
    got = langid.expected_pieces(found, [word, "q" * 60], np.array([2, 0]), chances)
    marked, whole = "▁" + word, brute.segmentations("▁" + word, p, chances[-1])
    for piece in {marked[a:b] for a in range(len(marked)) for b in range(a + 1, len(marked) + 1)} & set(p):
        uses = sum(
            brute.segmentations(marked[:a], p, chances[-1]) * p[piece]
            * brute.segmentations(marked[a + len(piece):], p, chances[-1])
            for a in range(len(marked)) if marked.startswith(piece, a)
        )
        assert abs(got[vocabulary.index(piece)] - 2 * uses / whole) < 1e-6


def test_language(spark, messy, empty):
    en = [f"the weather in this house was rather cold today number {i}" for i in range(30)]
    de = [f"das Wetter in diesem Hause war heute ziemlich kalt Nummer {i}" for i in range(30)]
    data = [(i, t, "en" if i < 30 else "de", None, 1) for i, t in enumerate(en + de)]
    data += [(90, "no language", None, None, 1), (91, None, "en", None, 1)]
    model = langid.learn(documents(spark, data), PIECES)
    assert model[0] == ["de", "en"]
    test = documents(spark, rows(["the cold house", "das kalte Haus"]))
    got = [r["lang_pred"] for r in langid.identify(test, model, PIECES, keep=["doc_id"]).orderBy("doc_id").collect()]
    assert got == ["en", "de"]
    awkward = langid.identify(messy, model, PIECES, keep=["doc_id", "text", "_text"]).collect()
    assert len(awkward) == messy.count()
    for r in awkward:
        blank = not any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == blank
        assert 0 <= r["score"] <= 1
    nothing = langid.learn(empty, PIECES)
    assert {r["lang_pred"] for r in langid.identify(messy, nothing, PIECES).collect()} == {"und"}
    assert langid.identify(empty, model, PIECES, keep=["doc_id"]).count() == 0


# --- repeated substrings -------------------------------------------------------------


def test_repeated_lines(spark, messy, empty):
    texts = [LINE, f"x\n{LINE}  \n{LINE}", None, "", f"{LINE} more\n\n{LINE.upper()}", "a b c d\na b c d"]
    docs = documents(spark, rows(texts))
    repeats = substring.repeated_units(docs)
    got = {(r["doc_id"], r["start"], r["end"]) for r in repeats.collect()}
    assert got == brute.repeated_lines(list(enumerate(texts)))
    cleaned = {r["doc_id"]: r["text"] for r in substring.remove_repeats(docs, repeats).collect()}
    for i, text in enumerate(texts):
        spans = [(a, b) for d, a, b in got if d == i]
        left = text if text is None else "".join(
            c for k, c in enumerate(text) if not any(a <= k < b for a, b in spans)
        )
        assert cleaned[i] == left
    spans = substring.removed_spans(messy, substring.repeated_units(messy))
    assert spans.count() == messy.count()
    assert substring.removed_spans(empty, substring.repeated_units(empty)).count() == 0


def test_shared_passages(spark, messy, empty):
    first = " ".join(f"word{i}" for i in range(18)) + "."
    second = "Is " + " ".join(f"it{i}" for i in range(14)) + " so?"
    third = "漢" * 310 + "。"
    texts = [
        f"own start. {first} {second} own end of this text.",
        f"{first.upper()}\n\n{second}",
        f"{first} between. {second}",  # each shared, but apart and too short
        f"menu.\n{third}x",
        f"menu.\nother. y\n{third}",
        "twice. " * 40,
        "own. own. " * 40,
        f"{first} {second}",
        None,
        "",
        " \n ",
    ]
    docs = documents(spark, rows(texts)).unionByName(documents(spark, rows(texts[:1])))
    found = substring.shared_passages(docs)
    got = [tuple(r) for r in found.drop("version").collect()]
    assert len(got) == len(set(got)) and set(got) == brute.shared_passages(list(enumerate(texts)))
    assert {r[0] for r in got} == {0, 1, 3, 4, 7}
    spans = substring.removed_spans(docs, substring.repeated_units(docs), passages=found)
    assert spans.count() == docs.count()
    assert {r["doc_id"]: r["n_passages"] for r in spans.collect()}[1] == 1
    twins = documents(spark, rows([texts[7]])).unionByName(documents(spark, rows([texts[7]])))
    assert substring.shared_passages(twins).count() == 0  # equal rows are one document
    substring.shared_passages(messy).collect()
    assert substring.shared_passages(empty).count() == 0


def test_paragraphs():
    text = "one two three\nfour five\n \nsix seven eight nine ten\n\n\nend"
    found = [(a, b) for _, a, b, _ in substring.units_of(text, "paragraph", 5)]
    assert [text[a:b] for a, b in found] == ["one two three\nfour five", "six seven eight nine ten"]


# --- token files ---------------------------------------------------------------------


def test_token_files(spark, messy, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    docs = documents(spark, rows(TEXTS)).repartition(3)
    written = token_files.write_token_files(docs, WORDS, end_id=1)
    got = {r["doc_id"]: r for r in token_files.checksums(token_files.read_token_files(written)).collect()}
    start = 0
    for i, text in enumerate(TEXTS):
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), crc)
        start += len(ids)
    some = token_files.read_token_files(written, wanted=lambda ids: ids % 4 == 1)
    assert {r["doc_id"] for r in some.collect()} == {i for i in range(len(TEXTS)) if i % 4 == 1}
    again = token_files.read_token_files(token_files.write_token_files(messy, WORDS, 1))
    assert again.count() == messy.count()
    assert token_files.read_token_files(token_files.write_token_files(empty, WORDS, 1)).count() == 0


def test_whole_text_equals_its_runs():
    """The tokenizer never looks across ASCII blanks, whatever stands beside them."""
    from tokenizers import Tokenizer

    tok, encoder = Tokenizer.from_file(WORDS), token_files.ChunkEncoder(WORDS)
    rng = random.Random(8)
    letters = "aÉé̀ \t\n\x0b\x0c\r\x1c  'st12漢Σς<|endoftext|>İẛ̣´"
    texts = ["".join(rng.choices(letters, k=30)) + rng.choice(["", "<|endoftext|>"]) for _ in range(3000)]
    for text, data in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(data, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_damage_is_noticed(tmp_path):
    import pyarrow as pa

    path = tmp_path / "a.zst"
    writer = token_files.SeekableWriter(pa.OSFile(str(path), "wb"))
    for i in range(5):
        writer.add(i if i else None, bytes([i]) * 400)
    writer.close()
    reader = token_files.SeekableReader(pa.OSFile(str(path)))
    assert [(i, d[:1]) for i, _, d in reader.documents([3, 0])] == [(3, b"\x03"), (None, b"\x00")]
    raw = bytearray(path.read_bytes())
    raw[int(reader.starts[2]) + 8] ^= 1
    path.write_bytes(raw)
    damaged = token_files.SeekableReader(pa.OSFile(str(path)))
    assert next(damaged.documents([1]))[0] == 1
    with pytest.raises(Exception):
        next(damaged.documents([2]))


def test_frames_are_plain_zstandard(tmp_path):
    import io

    import pyarrow as pa
    import zstandard

    path = tmp_path / "a.zst"
    writer = token_files.SeekableWriter(pa.OSFile(str(path), "wb"))
    writer.add(1, b"abcd" * 9)
    writer.add(2, b"efgh")
    writer.close()
    reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(path.read_bytes()), read_across_frames=True)
    assert reader.read().startswith(b"abcd" * 9 + b"efgh")


# --- fuzzy lines ---------------------------------------------------------------------


def fuzzy_texts():
    rng = random.Random(11)
    words = [f"lexeme{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=60)) for _ in range(4)]
    out = []
    for _ in range(25):
        lines = []
        for _ in range(3):
            w = rng.choice(base).split()
            for _ in range(rng.choice([0, 1, 2])):
                w[rng.randrange(60)] = rng.choice(words)
            lines.append((" " + rng.choice([" ", ", "])).join(w))
        out.append("\n".join(lines))
    return out


def test_fuzzy_lines(spark):
    texts = fuzzy_texts() + [LINE, LINE.upper() + "!!", None, "", "a b c", "a b c d e\na b c d e"]
    docs = documents(spark, rows(texts)).repartition(3)
    wanted = brute.line_groups(list(enumerate(texts)))
    groups = fuzzy_lines.line_groups(docs)
    got = {
        (r["doc"]["id"], r["line"]): (r["keep"]["doc"]["id"], r["keep"]["line"])
        for r in groups.collect()
    }
    assert got == wanted
    assert len(set(wanted.values())) < len(wanted)
    cleaned = {r["doc_id"]: r["text"] for r in fuzzy_lines.remove_lines(docs, groups).collect()}
    for i, text in enumerate(texts):
        left = text if text is None else "\n".join(
            line for n, line in enumerate(text.split("\n")) if wanted.get((i, n), (i, n)) == (i, n)
        )
        assert cleaned[i] == left


def test_repeats_are_cut_from_awkward_rows(messy, empty):
    repeats = substring.repeated_units(messy)
    cleaned = substring.remove_repeats(messy, repeats)
    assert cleaned.columns == messy.columns and others_kept(cleaned)
    assert cleaned.count() == messy.count()
    assert substring.remove_repeats(empty, substring.repeated_units(empty)).count() == 0


def test_fuzzy_lines_of_awkward_rows(messy, empty):
    groups = fuzzy_lines.line_groups(messy)
    cleaned = fuzzy_lines.remove_lines(messy, groups)
    assert cleaned.columns == messy.columns and others_kept(cleaned)
    assert cleaned.count() == messy.count()
    assert fuzzy_lines.line_groups(empty).count() == 0
    assert fuzzy_lines.remove_lines(empty, fuzzy_lines.line_groups(empty)).count() == 0


def test_long_lines_keep_their_counts(spark):
    text = " ".join(f"longword{i % 9}" for i in range(140_000))
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(fuzzy_lines.simhash(F.split("t", " "))).first()[0]
    assert got % 2**64 == brute.line_hash(text)


# --- language model ------------------------------------------------------------------


def test_bits_and_sequences():
    rng = np.random.default_rng(0)
    for density in (0.01, 0.5, 0.99):
        flags = rng.random(5000) < density
        places = np.flatnonzero(flags)
        bits = Bits.build(places, 5000)
        assert (bits.select(np.arange(len(places))) == places).all()
        zeros = np.flatnonzero(~flags)
        assert (bits.select(np.arange(len(zeros)), zero=True) == zeros).all()
    for top in (0, 5, 10**6, 2**50):
        values = np.sort(rng.integers(0, top + 1, 3000))
        assert (Monotone.build(values).get(np.arange(3000)) == values).all()


def test_children(tmp_path):
    rng = np.random.default_rng(0)
    universe = np.array([50, 1, 100_000, 3, 7, 1000])
    entries = [(c + 10, k) for c, u in enumerate(universe) if c != 3
               for k in sorted(rng.choice(u, size=min(u, 40), replace=False).tolist())]
    context, child = np.array(entries).T
    built = Children.build(10, context, child, universe)
    arrays, facts = built.save()
    write_arrays(f"file://{tmp_path}", "level", arrays, facts)
    read = Children.load(*map_arrays(f"file://{tmp_path}", "level"))
    assert (read.find(context, child) == np.arange(len(context))).all()
    asked = [(c + 10, k) for c, u in enumerate(universe) for k in range(min(u, 1100))]
    known = {e: i for i, e in enumerate(entries)}
    got = read.find(*np.array(asked).T)
    assert got.tolist() == [known.get(a, -1) for a in asked]


def lm_texts():
    rng = random.Random(6)
    words = [f"v{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, weights=range(40, 0, -1), k=60)) for _ in range(80)]
    return texts + ["V1 v2 V1 v2", "", None, "unseen words only", "v1 unseen v2 v3"]


@pytest.mark.parametrize("entries", [2_000_000, 50])
def test_trie_scores(spark, messy, empty, monkeypatch, entries):
    monkeypatch.setattr(ngram_lm, "_FILE_ENTRIES", entries)
    texts = lm_texts()
    docs = documents(spark, rows(texts))
    train = [t for i, t in enumerate(texts) if i % 7]
    model = ngram_lm.learn(docs.where("doc_id % 7 <> 0"))
    assert len(model.levels) == 3 and model.levels[2]
    got = ngram_lm.score_texts(docs, model).orderBy("doc_id").collect()
    for r, (n, known, base, score) in zip(got, brute.trigram_scores(train, texts), strict=True):
        assert (r["n_tokens"], r["n_known"]) == (n, known)
        assert abs(r["base_score"] - base) < 1e-6
        # Eight bits a token: half a step each at most, and the pair's code inside the triple's.
        assert abs(r["score"] - score) <= n * model.step
    assert ngram_lm.score_texts(messy, model, keep=["doc_id", "held"]).count() == messy.count()
    assert ngram_lm.score_texts(empty, model).count() == 0


def test_model_of_nothing(empty, messy):
    model = ngram_lm.learn(empty)
    found = ngram_lm.score_texts(messy, model).collect()
    assert len(found) == messy.count()
    assert {r["n_known"] for r in found} == {0}


# --- BPE -----------------------------------------------------------------------------


def test_bpe(spark, messy, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTES)
    done = bpe.encode_and_decode(messy, BYTES, keep=["doc_id", "text", "held"]).collect()
    assert len(done) == messy.count()
    for r in done:
        ids = tok.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["decoded"] == tok.decode(ids, skip_special_tokens=False)
    assert bpe.encode_and_decode(empty, BYTES).count() == 0


def test_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(bpe, "_CHUNK_WORDS", 5)
    texts = [f"{LINE} {i} and {i * i}" for i in range(50)]
    docs = documents(spark, rows(texts))
    got = {r["doc_id"]: r["decoded"] for r in bpe.encode_and_decode(docs, BYTES).collect()}
    assert got == dict(enumerate(texts))


def test_words_are_the_tokenizers_own():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTES)
    split = bpe.splitter(["<|endoftext|>"])
    rng = random.Random(9)
    letters = "aB é1½²'st rellvmd!?.\n\t \x1c\x85  漢ñ́\U0001f600_"
    for _ in range(4000):
        text = "".join(rng.choices(letters, k=25))
        words = split(text)
        assert "".join(words) == text
        each = [i for w in words for i in tok.encode(w, add_special_tokens=False).ids]
        assert each == tok.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_character_splits_alike():
    """Letters, digits and blanks are the same characters to both."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BYTES)
    split = bpe.splitter([], tok.pre_tokenizer)
    odd = []
    for code in range(0x110000):
        if 0xD800 <= code < 0xE000 or code > 0x2FFFF and code < 0xE0000:
            continue
        text = f"a{chr(code)}b 1{chr(code)}2"
        spans = [s for _, s in tok.pre_tokenizer.pre_tokenize_str(text)]
        if [text[a:b] for a, b in spans] != split(text):
            odd.append(hex(code))
    assert odd == []


@pytest.mark.parametrize(("path", "by_runs"), [(WORDS, True), (BYTES, False)])
def test_ids_are_those_of_any_tokenizer(path, by_runs):
    encoder = token_files.ChunkEncoder(path)
    assert encoder.by_runs == by_runs
    texts = ["Hello World, again.", "", "  Two  blanks.\n", *[t for t in TEXTS if t]]
    got = encoder.encode([t.encode() for t in texts])
    for text, ids in zip(texts, got, strict=True):
        whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == whole


def test_texts_are_encoded_without_looking_for_cycles():
    encoder = token_files.ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [f"Word{i}, word{i} x{i % 7}a Été{i}".encode() for i in range(20_000)] + [b"", b"one"]
    looked = []
    gc.callbacks.append(lambda phase, info: looked.append(phase))
    try:
        found = encoder.encode(texts)
    finally:
        gc.callbacks.pop()
    assert len(looked) <= 2 and gc.isenabled()  # at most once, when all is done
    assert found[-200:] == encoder._whole(texts[-200:])


class _Unwalked(dict):
    def __iter__(self):
        raise AssertionError("all that is remembered was gone over")


def test_what_is_remembered_is_looked_up_not_gone_over():
    encoder = token_files.ChunkEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = [b"some words, some words", b"Some other words!", b"", b"12 <b> \xc3\x89t\xc3\xa9."]
    encoder.known, encoder.older = _Unwalked(), _Unwalked(encoder._encode_runs([b"some"]))
    assert encoder.encode(texts) == encoder._whole(texts)
    assert encoder.encode(texts[::-1]) == encoder._whole(texts[::-1])


def test_a_stored_table_leaves_nothing_that_was_shuffled(spark):
    def kept():
        env = spark._jvm.org.apache.spark.SparkEnv.get()
        files = env.blockManager().diskBlockManager().getAllFiles().iterator()
        names = set()
        while files.hasNext():
            names.add(files.next().getName())
        return {name for name in names if name.startswith("shuffle_")}

    before = kept()
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    found = stored(rows.join(spark.range(9).withColumnRenamed("id", "k"), "k"), "shuffled")
    deadline = time.monotonic() + 20
    while (left := kept() - before) and time.monotonic() < deadline:
        time.sleep(0.1)
    assert not left
    assert found.count() == 7


def test_many_candidates_are_verified_in_parts(spark, monkeypatch):
    names = []
    keep = fuzzy_lines.stored
    monkeypatch.setattr(fuzzy_lines, "stored", lambda df, label: names.append(label) or keep(df, label))
    monkeypatch.setattr(fuzzy_lines, "_PAIRS", 5)
    monkeypatch.setattr(fuzzy_lines, "_PAIRS_A_LINE", 0)
    letters = [(i, "abcdefghij"[: 10 - i % 2] + "xyz"[i % 3] * (i % 4 == 0)) for i in range(8)]
    texts = keep(spark.createDataFrame(letters, "id bigint, letters string"), "texts")
    pairs = keep(spark.range(64).selectExpr("id div 8 a", "id % 8 b").where("a < b"), "pairs")
    found = fuzzy_lines._links_among(pairs, texts, 0.8)
    assert names == ["line_links"] * 6  # 28 pairs
    once = fuzzy_lines._verified(pairs, texts, 0.8)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, once.collect()))
    assert found.count() > 5
    assert fuzzy_lines._links_among(pairs.limit(0), texts, 0.8).count() == 0
