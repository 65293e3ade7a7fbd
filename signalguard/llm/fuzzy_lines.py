"""Fuzzy line dedup, in DataFrame functions only.

Lines are normalised and linked if few enough edits of words turn one into the other; one
line per connected group stays.

Candidates share a block.  Of n words, k(n) may be edited: the allowed share of n.  A block is
three neighbouring words, fewer in short lines, and its key is their SimHash.  An edit spoils three
blocks at most, so all but 3 k(n) of the longer line's are in both lines.  Blocks have an order,
the same for all lines: those of long words, which are rare, come first, and those that very many
lines have come last.  Of the first 3 k(n) + 1 blocks of two similar lines, one is the same (else
both would lack too many), so a line has keys for these only, three fifths of its blocks, and no
similar pair is missed, however long its lines are.  Where so many edits are allowed that no two
neighbouring words need be left, blocks are single words.

A block in thousands of lines would give millions of candidate pairs.  So every line is
first compared with two lines of its key.  Most of a large group then hangs together, and
only lines outside the main group of their key are compared with the key's other groups, all
of them, however many the key has.  What keeps that cheap is a bag of 256 bits per line, the
parities of its words' counts: an edit turns at most two of them, so most pairs that are not
similar are told from their bags, and no similar pair is.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalguard.llm.base import as_row, forget, from_row, stored
from signalguard.llm.components import components

_LANES = 0x0001000100010001
_BLOCK = 32767  # features whose counts fit sixteen bits
_WIDTHS = (1, 2, 3)  # words of a block
_LENGTHS = 63  # the low bits of a word's code are its length, this one at most
_COMMON = 16_384  # blocks at most that come last because many lines have them,
_COUNTED = 64  # as counted in one text of so many; no link depends on it
_KEYS = 2_000_000  # keys that are shuffled at a time at least, and so many for each line:
_KEYS_A_LINE = 6
_MEMBERS_A_LINE = 2  # lines of keys that are compared at a time, for each line
_CROWD = 4096  # lines of one key for each task that compares them; no pair depends on it
_PAIRS = 1_000_000  # candidates that are verified at a time at least, and so many for each line:
_PAIRS_A_LINE = 3
_BAGS = 4  # numbers of 64 bits with the parities of a line's words
_CLASSES = 63  # the low bits of an id tell about how many words its line has


def normalise(line: Column) -> Column:
    """Lower case, letters and digits only, single spaces between words."""
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def _document(doc_id: str, text: str) -> Column:
    """A document: its id, and its text's hash to tell apart rows of one id."""
    return F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("version"))


def _lines(
    docs: DataFrame, doc_id: str, text: str, wanted: DataFrame | None = None
) -> DataFrame:
    """doc, line, raw (a hash of the line as it is) and norm; with ``wanted`` only lines whose
    raw is in it."""
    t = F.col(text).cast("string")
    rows = docs.where(t.isNotNull()).select(_document(doc_id, text).alias("doc"), t.alias("_text"))
    rows = rows.select("doc", F.posexplode(F.split("_text", "\n")).alias("line", "_line"))
    rows = rows.withColumn("raw", F.xxhash64("_line"))
    if wanted is not None:
        rows = rows.join(wanted, "raw", "left_semi")
    # Generated columns are computed once: no filter on them is pushed below and repeated.
    norm = F.explode(F.array(normalise(F.col("_line"))))
    return rows.select("doc", "line", "raw", norm.alias("norm"))


def simhash(features: Column) -> Column:
    """64 bits; a bit is set if it is set in over half the features' hashes.

    Four counts of sixteen bits share a number, so a block of features takes sixteen sums;
    blocks are short enough for no count to overflow, and their counts are added up.
    """

    def packed(block: Column) -> Column:
        zero = F.struct(*[F.lit(0).cast("bigint").alias(f"s{k}") for k in range(16)])
        return F.aggregate(
            F.transform(block, lambda w: F.xxhash64(w)),
            zero,
            lambda sums, h: F.struct(
                *[
                    (
                        sums[f"s{k}"]
                        + F.call_function("shiftrightunsigned", h, F.lit(k)).bitwiseAND(
                            F.lit(_LANES)
                        )
                    ).alias(f"s{k}")
                    for k in range(16)
                ]
            ),
        )

    def bits(blocks: Column, count: Column) -> Column:
        def bit(place: int) -> Column:
            name, shift = f"s{place % 16}", place // 16 * 16
            ones = F.aggregate(
                blocks,
                F.lit(0).cast("bigint"),
                lambda total, b: total
                + F.call_function("shiftrightunsigned", b[name], F.lit(shift)).bitwiseAND(
                    F.lit(0xFFFF)
                ),
            )
            return F.call_function(
                "shiftleft", (ones * 2 > count).cast("int").cast("bigint"), F.lit(place)
            )

        return reduce(Column.bitwiseOR, map(bit, range(64)))

    def whole(words: Column) -> Column:
        blocks = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(words) - 1) / _BLOCK).cast("int")),
            lambda i: packed(F.slice(words, i * _BLOCK + 1, F.lit(_BLOCK))),
        )
        return F.transform(F.array(blocks), lambda b: bits(b, F.size(words)))[0]

    return F.transform(F.array(features), whole)[0]


def _allowed(words: Column, similarity: float) -> Column:
    """The most edits between lines of which the longer has so many words."""
    return F.floor(F.round((1 - similarity) * words, 6)).cast("int")


def _least_words(width: int, similarity: float) -> float:
    """From so many words on, similar lines share so many neighbouring words."""
    share = 1 - width * (1 - similarity)
    return math.floor(round((width - 1) / share, 6)) + 1 if share > 1e-9 else math.inf


def _majority(hashes: list[Column]) -> Column:
    """The bits that are set in over half of up to four hashes: their SimHash."""
    over = combinations(hashes, len(hashes) // 2 + 1)
    return reduce(Column.bitwiseOR, [reduce(Column.bitwiseAND, part) for part in over])


def _first_grams(n: Column, width: int, similarity: float) -> Column:
    """So many of a line's least blocks have one in common with those of every similar line.

    Of two lines the longer, of L words, has L - width + 1 blocks, and each edit spoils at most
    ``width`` of them; all others are in both lines.  So the blocks of this line, of n words, that
    the other lacks are at most width * k(L) - (L - n), and over all L that is most where k next
    steps up, fewer than ``width`` words on.
    """
    lacking = [width * _allowed(n + d, similarity) - d for d in range(width)]
    return (F.greatest(*lacking) if width > 1 else lacking[0]) + 1


def _codes(words: Column) -> Column:
    """The words' hashes, but for the last six bits: they are less the longer the word is."""
    hashed = F.lit(~_LENGTHS).cast("bigint")
    return F.transform(
        words,
        lambda word: F.xxhash64(word)
        .bitwiseAND(hashed)
        .bitwiseOR(F.greatest(_LENGTHS - F.octet_length(word), F.lit(0)).cast("bigint")),
    )


def _blocks(codes: Column, width: int, common: Sequence[int] = ()) -> Column:
    """The keys of all of a line's blocks.  Smaller ones come first: those of long words, and
    last of all the ones given in ``common``."""
    unhashed = F.lit(_LENGTHS).cast("bigint")

    def key(*words: Column) -> Column:
        shorter = reduce(Column.__add__, [w.bitwiseAND(unhashed) for w in words])
        rank = F.call_function("shiftleft", shorter, F.lit(54))
        block = F.xxhash64(F.lit(width), _majority(list(words)))
        return rank.bitwiseOR(F.call_function("shiftrightunsigned", block, F.lit(10)))

    begin = F.slice(codes, 1, F.greatest(F.size(codes) - (width - 1), F.lit(0)))
    if width == 1:
        keys = F.transform(begin, lambda a: key(a))
    else:
        keys = F.transform(
            begin, lambda a, i: key(a, *[F.get(codes, i + j) for j in range(1, width)])
        )
    if not common:
        return keys
    last = F.lit(1 << 62)
    return F.transform(keys, lambda k: F.when(k.isin(list(common)), k.bitwiseOR(last)).otherwise(k))


def _block_keys(codes: Column, similarity: float, common: Sequence[int] = ()) -> Column:
    """The keys of the blocks by which a line is found, from the codes of its words.

    The longer of two similar lines decides how many words their blocks have; a line has
    blocks of every width that a line similar to it could ask for.
    """
    n = F.size(codes)
    longest = F.floor(F.round(n / similarity, 6)) if similarity > 0 else F.lit(2**31)

    def keys(width: int) -> Column:
        wanted = longest >= F.lit(_least_words(width, similarity))
        if width < _WIDTHS[-1]:
            wanted &= n < F.lit(_least_words(width + 1, similarity))
        # Only blocks of the last width are counted.
        last = common if width == _WIDTHS[-1] else ()
        ordered = F.sort_array(_blocks(codes, width, last))
        found = F.slice(ordered, 1, _first_grams(n, width, similarity))
        return F.when(wanted & (n >= width), found).otherwise(F.array().cast("array<bigint>"))

    alone = _allowed(longest, similarity) < 1
    every = F.array_distinct(F.concat(*[keys(width) for width in _WIDTHS]))
    return F.when(alone, F.array().cast("array<bigint>")).otherwise(every)


def _judged(lines: DataFrame, least_letters: int) -> DataFrame:
    """The lines with so many letters and digits, with words and id.

    The id is a hash of the normalised line, but for the last six bits: they are the logarithm
    of its words, in half steps of a quarter more, so that pairs of too different lengths are
    told from their ids alone.
    """
    enough = F.col("norm") != ""
    if least_letters > 1:
        enough = F.length(F.translate("norm", " ", "")) >= least_letters
    words = F.explode(F.array(F.split("norm", " "))).alias("words")
    split = lines.where(enough).select("doc", "line", "raw", "norm", words)
    steps = F.floor(2 * F.log(F.size("words")) / math.log(1.25) + 1e-9).cast("bigint")
    size = F.least(steps, F.lit(_CLASSES).cast("bigint"))
    hashed = F.xxhash64("norm").bitwiseAND(F.lit(~_CLASSES).cast("bigint"))
    return split.withColumn("id", hashed.bitwiseOR(size))


def _bag(codes: Column) -> Column:
    """256 bits in four numbers: a bit is set if it is that of an odd number of the words.

    A word's bit is told by the eight bits of its code that are next to its length.
    """
    number, place = (F.lit(bits << 6).cast("bigint") for bits in (_BAGS - 1, 63 * _BAGS))

    def bits(i: int) -> Column:
        return F.aggregate(
            codes,
            F.lit(0).cast("bigint"),
            lambda bag, c: bag.bitwiseXOR(
                F.call_function(
                    "shiftleft",
                    (c.bitwiseAND(number) == F.lit(i << 6).cast("bigint")).cast("bigint"),
                    F.call_function("shiftright", c.bitwiseAND(place), F.lit(8)).cast("int"),
                )
            ),
        )

    return F.struct(*[bits(i).alias(f"b{i}") for i in range(_BAGS)])


def _alike_in_length(a: Column, b: Column, similarity: float) -> Column:
    """Whether the lengths in two ids let the lines be similar; never false for similar lines."""
    most = math.ceil(2 * math.log(similarity) / math.log(0.8) - 1e-9) if similarity > 0 else _CLASSES
    last = F.lit(_CLASSES).cast("bigint")
    return F.abs(a.bitwiseAND(last) - b.bitwiseAND(last)) <= most


def _alike_in_words(a: Column, a_bag: Column, b: Column, b_bag: Column, similarity: float) -> Column:
    """Whether two bags let the lines be similar; never false for similar lines."""
    # The most words of a line of each size class, and so the most bits that edits can turn.
    words = [math.ceil(1.25 ** ((size + 1) / 2) + 1e-6) for size in range(_CLASSES)]
    turned = [2 * math.floor(round((1 - similarity) * n, 6)) for n in words] + [64 * _BAGS]
    last = F.lit(_CLASSES).cast("bigint")
    size = F.greatest(a.bitwiseAND(last), b.bitwiseAND(last)).cast("int")
    allowed = F.get(F.array(*map(F.lit, turned)), size)
    differ = [F.bit_count(a_bag[f"b{i}"].bitwiseXOR(b_bag[f"b{i}"])) for i in range(_BAGS)]
    return reduce(Column.__add__, differ) <= allowed


def common_blocks(docs: DataFrame, doc_id: str, text: str, least_letters: int) -> list[int]:
    """The blocks that most lines have, counted in the lines of every 64th text.

    They only come last in the order of blocks.  No link depends on what is found here: in any
    order two similar lines share one of their first blocks.  But without it, all lines with a
    sentence in common would be candidates of each other.
    """
    counted = F.lit(_COUNTED - 1).cast("bigint")
    some = docs.where(F.xxhash64(F.col(text).cast("string")).bitwiseAND(counted) == 0)
    judged = _judged(_lines(some, doc_id, text), least_letters).dropDuplicates(["id"])
    codes = judged.select(F.explode(F.array(_codes(F.col("words")))).alias("codes"))
    blocks = F.array_distinct(_blocks(F.col("codes"), _WIDTHS[-1]))
    often = codes.select(F.explode(blocks).alias("key")).groupBy("key").count().where("count > 2")
    return [r["key"] for r in often.orderBy(F.desc("count"), "key").limit(_COMMON).collect()]


def fingerprints(
    lines: DataFrame, least_letters: int, similarity: float, common: Sequence[int] = ()
) -> DataFrame:
    """doc, line and raw, id and d2 (two hashes of norm), bag and the keys of the line's blocks.

    Keys has only who can be similar to a line that is not its equal.  ``common`` as in
    ``common_blocks``.
    """
    judged = _judged(lines, least_letters).select(
        "doc",
        "line",
        "raw",
        "id",
        F.xxhash64(F.lit("line"), F.col("norm")).alias("d2"),
        F.explode(F.array(_codes(F.col("words")))).alias("codes"),
    )
    keys = _block_keys(F.col("codes"), similarity, common).alias("keys")
    return judged.select("doc", "line", "raw", "id", "d2", _bag(F.col("codes")).alias("bag"), keys)


def _pairs(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _letters(words: Column) -> Column:
    """One character per word (20 bits of its hash), so that edits of words can be counted."""
    code = F.transform(
        words,
        lambda w: F.lpad(F.hex(F.pmod(F.xxhash64(w), F.lit(0xF0000)) + 0x10000), 8, "0"),
    )
    return F.decode(F.unhex(F.array_join(code, "")), "UTF-32")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of similar lines: edits of words against the longer line's words.

    Small distances are tried first: the work is the length times the distance allowed, and
    most candidates differ in a few words, however long they are.
    """
    left = texts.select(F.col("id").alias("a"), F.col("letters").alias("x"))
    right = texts.select(F.col("id").alias("b"), F.col("letters").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    longest, shortest = F.greatest(F.length("x"), F.length("y")), F.least(F.length("x"), F.length("y"))
    both = both.withColumn("most", _allowed(longest, similarity))
    similar = both.where((longest - shortest) <= F.col("most"))
    tries = "CASE WHEN levenshtein(x, y, least(most, 16)) >= 0 THEN true"
    for tried, limit in ((16, "256"), (256, "4096"), (4096, "most")):
        tries += f" WHEN most > {tried} AND levenshtein(x, y, least(most, {limit})) >= 0 THEN true"
    return similar.where(F.expr(f"{tries} ELSE false END")).select("a", "b")


def _links_among(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """``_verified``, stored.

    A pair is shuffled with a line's letters.  There can be many more pairs than lines, so they
    are verified in parts, one after the other: what is on disk at a time stays in proportion to
    the lines, and that the lines are shuffled for each part costs less than the pairs do.
    """
    parts = math.ceil(pairs.count() / max(_PAIRS, _PAIRS_A_LINE * texts.count())) or 1
    part = F.pmod(F.xxhash64("a", "b"), F.lit(parts))
    found = [
        stored(_verified(pairs.where(part == i), texts, similarity), "line_links")
        for i in range(parts)
    ]
    return reduce(DataFrame.union, found)


def line_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_letters: int = 1,
    similarity: float = 0.8,
) -> DataFrame:
    """Every judged line with the line its group keeps.

    Columns: doc (struct of id and version), line (from 0), keep (struct of doc and line),
    kept.  Judged are lines of at least ``least_letters`` letters and digits, empty ones never.
    Two lines are linked if the edits of words that turn one into the other are at most
    1 - ``similarity`` of the longer one's words, and one of these words is left.  Of each
    connected group the first by id, version and place is kept; NULL ids rank first.  Equal rows of
    the table are one document and are treated alike; NULL texts have no lines, and an empty
    table has none.  Long texts are judged whole, and names of other columns do not matter.
    """
    common = common_blocks(docs, doc_id, text, least_letters)
    judged = fingerprints(_lines(docs, doc_id, text), least_letters, similarity, common)
    keyed = stored(judged, "keyed_lines")
    members, tries = _shared_keys(keyed, similarity)
    lines = stored(keyed.select("doc", "line", "raw", "id", "d2"), "lines")
    bags = stored(keyed.select("id", "bag").distinct(), "line_bags")
    forget(keyed)

    def texts(pairs: DataFrame) -> DataFrame:
        """id and letters of the lines in the pairs; only these are normalised again."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        wanted = stored(lines.join(ends, "id", "left_semi").select("raw").distinct(), "line_ids")
        judged = _judged(_lines(docs, doc_id, text, wanted), least_letters)
        return stored(_texts(judged), "line_texts")

    found = components(_links(members, tries, bags, texts, similarity))
    # A group is a component's label, or the two hashes of a line that has no links.
    marked = lines.select("doc", "line", "id", "d2").join(
        found.withColumnRenamed("node", "id"), "id", "left"
    )
    marked = marked.select(
        F.struct("doc", "line").alias("node"),
        F.coalesce("component", "id").alias("g1"),
        F.when(F.col("component").isNull(), F.col("d2")).otherwise(F.lit(0)).alias("g2"),
    )
    marked = stored(marked, "marked_lines")
    firsts = marked.groupBy("g1", "g2").agg(F.min("node").alias("keep"))
    return marked.join(firsts, ["g1", "g2"]).select(
        F.col("node.doc").alias("doc"),
        F.col("node.line").alias("line"),
        "keep",
        (F.col("node") == F.col("keep")).alias("kept"),
    )


def _shared_keys(keyed: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """The lines (key, id) of each key that over two lines have, and pairs (a, b) to try first.

    Every line is paired with the least and the largest id of each of its keys, so the two
    lines of most keys need not be looked up again.  Keys are shuffled in parts: what is on
    disk at a time stays in proportion to the lines.
    """
    sums = keyed.agg(F.sum(F.size("keys")).alias("keys"), F.count(F.lit(1)).alias("lines")).first()
    parts = math.ceil((sums["keys"] or 0) / max(_KEYS, _KEYS_A_LINE * sums["lines"])) or 1
    rows = keyed.select(F.explode("keys").alias("key"), "id")
    key = Window.partitionBy("key")
    members, tries = [], []
    for i in range(parts):
        part = rows.where(F.pmod("key", F.lit(parts)) == i).repartition("key").distinct()
        lo, hi = F.min("id").over(key).alias("lo"), F.max("id").over(key).alias("hi")
        ends = part.select("key", "id", lo, hi).where("lo <> hi")
        others = F.max((F.col("id") > F.col("lo")) & (F.col("id") < F.col("hi"))).over(key)
        shared = stored(ends.withColumn("crowded", others), "shared_keys")
        stars = shared.select("id", F.explode(F.array("lo", "hi")).alias("star"))
        pairs = stars.where("id <> star").select(*_pairs(F.col("id"), F.col("star"))).distinct()
        alike = _alike_in_length(F.col("a"), F.col("b"), similarity)
        tries.append(stored(pairs.where(alike), "line_pairs"))
        members.append(stored(shared.where("crowded").select("key", "id"), "key_members"))
        forget(shared)
    return reduce(DataFrame.union, members), reduce(DataFrame.union, tries)


def _texts(judged: DataFrame) -> DataFrame:
    """id and letters of each line."""
    letters = judged.select("id", _letters(F.col("words")).alias("letters"))
    return letters.dropDuplicates(["id"])


def _links(
    members: DataFrame,
    tries: DataFrame,
    bags: DataFrame,
    texts: Callable[[DataFrame], DataFrame],
    similarity: float,
) -> DataFrame:
    first = stored(_likely(tries.distinct(), bags, similarity), "line_pairs")
    links = _links_among(first, texts(first), similarity)
    groups = stored(components(links).withColumnRenamed("node", "id"), "line_components")
    parts = math.ceil(members.count() / max(_KEYS, _MEMBERS_A_LINE * bags.count())) or 1
    more = []
    for i in range(parts):
        placed = members.where(F.pmod("key", F.lit(parts)) == i).join(groups, "id", "left")
        placed = placed.withColumn("component", F.coalesce("component", "id"))
        placed = stored(placed, "placed_members")
        more.append(stored(_between_groups(placed, bags, similarity).distinct(), "line_pairs"))
        forget(placed)
    others = stored(reduce(DataFrame.union, more).distinct(), "line_pairs")
    return links.union(_links_among(others, texts(others), similarity))


def _likely(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that may be similar by their bags."""
    left = bags.select(F.col("id").alias("a"), F.col("bag").alias("a_bag"))
    right = bags.select(F.col("id").alias("b"), F.col("bag").alias("b_bag"))
    alike = _alike_in_words(F.col("a"), F.col("a_bag"), F.col("b"), F.col("b_bag"), similarity)
    return pairs.join(left, "a").join(right, "b").where(alike).select("a", "b")


def _between_groups(placed: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of lines that share a key, are in different groups and may be similar.

    All such pairs of a key, whatever its size.  The lines outside a large key's main group
    are dealt out in parts, and each part meets all lines of the key in a task of its own.
    """
    main = (
        placed.groupBy("key", "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("key")
        .agg(
            F.max(F.struct("n", "component")).alias("largest"),
            F.sum("n").alias("lines"),
            F.count(F.lit(1)).alias("groups"),
        )
        .where("groups > 1")
        .select(
            "key",
            F.col("largest.component").alias("main"),
            F.ceil(F.col("lines") / _CROWD).alias("parts"),
        )
    )
    rows = placed.join(main, "key").join(bags, "id")
    outside = rows.where("component <> main").select(
        "key",
        F.pmod(F.xxhash64("id"), F.col("parts")).alias("part"),
        F.col("id").alias("o"),
        F.col("bag").alias("o_bag"),
        F.col("component").alias("oc"),
    )
    part = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")
    inside = rows.select("key", part, "id", "bag", "component", "main")
    pairs = inside.join(outside, ["key", "part"]).where(
        (F.col("component") != F.col("oc"))
        & _alike_in_length(F.col("id"), F.col("o"), similarity)
        & _alike_in_words(F.col("id"), F.col("bag"), F.col("o"), F.col("o_bag"), similarity)
        & ((F.col("component") == F.col("main")) | (F.col("id") < F.col("o")))
    )
    return pairs.select(*_pairs(F.col("id"), F.col("o")))


def remove_lines(
    docs: DataFrame, groups: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The documents, all columns, without the lines that are not kept.

    All rows stay; a text whose every line goes is empty.
    """
    gone = groups.where("NOT kept").groupBy("doc").agg(F.collect_set("line").alias("gone"))
    rows = docs.select(_document(doc_id, text).alias("doc"), as_row(docs).alias("row"))
    joined = rows.join(gone, "doc", "left")
    whole = F.col("row").getField(text)
    split = joined.withColumn("every", F.when(F.col("gone").isNotNull(), F.split(whole, "\n")))
    left = F.array_except(F.sequence(F.lit(0), F.size("every") - 1), F.col("gone"))
    cut = F.array_join(F.transform(left, lambda i: F.get(F.col("every"), i)), "\n")
    cleaned = F.when(F.col("gone").isNull(), whole).otherwise(cut)
    return split.select(*from_row(docs.columns, **{text: cleaned}))
