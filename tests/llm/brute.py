"""Plain versions of the operators' contracts, for comparison."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def groups(nodes, links):
    """Least node reachable from each node."""
    up = {n: n for n in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        x, y = root(a), root(b)
        if x != y:
            up[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def benchmark_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(texts, items, window=13):
    """(n_words, n_hit, item ids) of each text."""
    windows = defaultdict(set)
    for name, text in items:
        w = benchmark_words(text)
        size = min(window, len(w))
        for a in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[a : a + size])].add(str(name))
    sizes = {len(k) for k in windows}
    out = []
    for text in texts:
        w = benchmark_words(text)
        hit, names = [False] * len(w), set()
        for size in sizes:
            for a in range(len(w) - size + 1):
                found = windows.get(tuple(w[a : a + size]))
                if found:
                    names |= found
                    hit[a : a + size] = [True] * size
        out.append((len(w), sum(hit), sorted(names)))
    return out


def blank_words(text):
    return [w.decode() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]


def fingerprint(text):
    w = blank_words((text or "").translate(LOWER))
    shingles = [" ".join(w[a : a + 3]) for a in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def document_groups(texts):
    """(fingerprint, component) per position; positions are the ids."""
    marks = [fingerprint(t) for t in texts]
    bits = np.array(marks, dtype=np.uint64)
    links = [
        (a, int(b))
        for a in range(len(bits))
        for b in np.flatnonzero(np.bitwise_count(bits[a] ^ bits) <= 3)
        if b > a
    ]
    found = groups(range(len(bits)), links)
    return [(f"{m:016x}", found[i]) for i, m in enumerate(marks)]


def base_measures(text):
    text = text or ""
    w = blank_words(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if blank_words(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(w[a : a + 3]) for a in range(len(w) - 2))
    hit = [False] * len(w)
    for a in range(len(w) - 2):
        if windows[tuple(w[a : a + 3])] > 1:
            hit[a : a + 3] = [True] * 3
    repeat = sum(hit)
    failed = len(w) < 50 or 100 * repeat > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, repeat, failed


def segmentations(word, chances, unknown):
    """Sum over all cuts of a word into pieces; ``chances`` maps pieces, other letters are unknown."""
    total = [1.0] + [0.0] * len(word)
    for end in range(1, len(word) + 1):
        for start in range(end):
            piece = word[start:end]
            if piece in chances:
                total[end] += total[start] * chances[piece]
            elif end == start + 1:
                total[end] += total[start] * unknown
    return total[-1]


def line_words(line):
    return re.sub(r"[\W_]+", " ", line.lower()).strip()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def line_hash(norm):
    w = norm.split(" ")
    features = [x for x in w if len(x) >= 4] or w
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in features]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def line_groups(docs):
    """{(doc, line): kept (doc, line)} of lines with a word, by the word edits of all pairs."""
    lines = defaultdict(list)
    for doc, text in docs:
        for number, line in enumerate((text or "").split("\n")):
            words = tuple(line_words(line).split())
            if words:
                lines[words].append((doc, number))
    kinds = sorted(lines, key=len)
    bags = [Counter(k) for k in kinds]
    links = [(places[0], place) for places in lines.values() for place in places[1:]]
    for i, a in enumerate(kinds):
        for j in range(i + 1, len(kinds)):
            b = kinds[j]
            most = math.floor(round(0.2 * len(b), 6))
            if len(b) - len(a) > most:
                break
            # Words that one line has and the other lacks need an edit each.
            if len(b) - (bags[i] & bags[j]).total() <= most and edit_distance(a, b) <= most:
                links.append((lines[a][0], lines[b][0]))
    return groups([place for places in lines.values() for place in places], links)


def repeated_lines(docs):
    """{(doc, start, end)} of lines with anything but blanks that an earlier line equals."""
    seen, out = set(), set()
    for doc, text in sorted((d, t) for d, t in docs if t):
        start = 0
        for line in text.split("\n"):
            words = tuple(line.lower().split())
            if words:
                if words in seen:
                    out.add((doc, start, start + len(line)))
                seen.add(words)
            start += len(line) + 1
    return out


def shared_passages(docs, least_words=30, least_letters=300):
    """{(doc, start, end, words, first doc)} of neighbouring sentences that other texts have too."""
    units, owners = {}, defaultdict(set)
    for doc, text in dict.fromkeys((d, t) for d, t in docs if t):
        found, start = [], 0
        for i, c in enumerate(text + "\n"):
            blank = i + 1 < len(text) and text[i + 1].isspace() and text[i + 1] != "\n"
            if c == "\n" or c in "。！？" or (c in ".!?…" and blank):
                end = i if c == "\n" else i + 1
                words = tuple(text[start:end].lower().split())
                if words:
                    lead = len(text[start:end]) - len(text[start:end].lstrip()) if found else 0
                    found.append((start + lead, end, words))
                    owners[words].add((doc, text))
                start = i + 1
        units[doc, text] = found
    out = set()
    for (doc, text), found in units.items():
        row = []
        for unit in [*found, None]:
            if unit and len(owners[unit[2]]) > 1:
                row.append(unit)
                continue
            n, letters = sum(len(u[2]) for u in row), sum(len(w) for u in row for w in u[2])
            if n >= least_words or (row and letters >= least_letters):
                first = min(owners[row[0][2]])[0]
                out.add((doc, row[0][0], row[-1][1], n, first))
            row = []
    return out


def trigram_scores(train, texts, least=1, discount=0.75):
    """(n_tokens, n_known, base, score) without quantising."""
    def tokens(text):
        return [*blank_words((text or "").translate(LOWER)), None]

    one, two, three = Counter(), Counter(), Counter()
    for text in train:
        w = tokens(text)
        one.update(w)
        padded = ["^", *w]
        two.update(zip(padded, w))
        three.update(zip(padded, w, w[1:]))
    # The start is a context of pairs and of triples, never a word.
    total, kinds = sum(one.values()), len(one)
    follow = Counter({"^": len(train), **{k: v for k, v in one.items() if k is not None}})
    two = {k: v for k, v in two.items() if v >= least}
    three = {k: v for k, v in three.items() if v >= least and k[:2] in two and k[1:] in two}
    taken1, taken2 = Counter(), Counter()
    for (a, _), n in two.items():
        taken1[a] += (n - discount) / follow[a]
    for (a, b, _), n in three.items():
        taken2[a, b] += (n - discount) / two[a, b]

    def p1(w):
        return (one[w] + 1) / (total + kinds + 1)

    def p2(a, w):
        left = 1 - taken1[a]
        return max(0, two.get((a, w), 0) - discount) / follow[a] + left * p1(w) if (a, w) in two else (
            left * p1(w)
        )

    def p3(a, b, w):
        if (a, b) not in two:
            return p2(b, w)
        left = 1 - taken2[a, b]
        if (a, b, w) in three:
            return (three[a, b, w] - discount) / two[a, b] + left * p2(b, w)
        return left * p2(b, w)

    out = []
    for text in texts:
        w = tokens(text)
        padded = ["^", *w]
        base = sum(math.log10(p1(x)) for x in w)
        score = math.log10(p2("^", w[0]))
        score += sum(math.log10(p3(padded[i - 1], padded[i], w[i])) for i in range(1, len(w)))
        out.append((len(w), sum(one[x] > 0 for x in w), base, score))
    return out
