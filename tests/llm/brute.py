"""The operators' results by plain loops over small lists."""

import math
import re
import struct
from collections import Counter, defaultdict

import xxhash

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
PLAIN = bytes(32 if c < 128 and not chr(c).isalnum() else LOWER[c] for c in range(256))


def words(text, table=None):
    raw = (text or "").encode()
    return re.findall(rb"[^\x20\x09-\x0D]+", raw.translate(table) if table else raw)


def substrings(rows, width=13):
    """{row number: (n_words, n_removed, kept)}"""
    first = {}
    split = [(d, words(t)) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - width + 1):
            if d is not None:
                key = tuple(w[i : i + width])
                first[key] = min(first.get(key, d), d)
    out = {}
    for n, (d, w) in enumerate(split):
        gone = set()
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        out[n] = (len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode())
    return out


def shingles(text):
    w = words(text, LOWER)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def near(rows):
    """{doc_id: (n_shingles, component_id)} for rows with different ids."""
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_shingle, common = defaultdict(list), Counter()
    for d, s in sets.items():
        for x in s:
            common.update((e, d) for e in by_shingle[x])
            by_shingle[x].append(d)
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets.items()}


BLANKS = " \t\r\v\f"


def line_repeats(rows):
    """{row number: text without lines that appeared before}, rows in the order they come."""
    seen, out = set(), {}
    for n, (_, text) in enumerate(rows):
        kept = []
        for line in (text or "").split("\n"):
            bare = line.strip(BLANKS)
            if not bare or bare not in seen:
                kept.append(line)
            seen.add(bare)
        out[n] = "\n".join(kept)
    return out


def winnowed(rows, single_words, window):
    """The rule for short lines too: they go with the windows of lines that hold them.

    Rows in the order they come; hashes as Spark makes them, for the choice of fingerprints.
    """
    docs = []
    for _, text in rows:
        lines = [(at, x.strip(BLANKS)) for at, x in enumerate((text or "").split("\n"))]
        docs.append([(at, x, xxhash.xxh64_intdigest(x.encode(), seed=42)) for at, x in lines if x])
    signed = lambda h: h - (1 << 64) if h >> 63 else h
    chosen = []
    for n, doc in enumerate(docs):
        ks = set()
        for k in range(max(len(doc) - window, 0) + 1):
            some = range(k, min(k + window, len(doc)))
            if some:
                ks.add(min(some, key=lambda i: (signed(doc[i][2]), -i)))
        chosen += [(doc[k][1], n, k) for k in sorted(ks)]
    first, gone = {}, defaultdict(set)
    for line, n, k in chosen:
        if line not in first:
            first[line] = (n, k)
            continue
        m, j = first[line]
        for step in (1, -1):
            for far in range(window):
                a, b = k + step * far, j + step * far
                if not (0 <= a < len(docs[n]) and 0 <= b < len(docs[m]) and docs[n][a][1] == docs[m][b][1]):
                    break
                gone[n].add(docs[n][a][0])
    seen = set()
    for n, doc in enumerate(docs):
        for at, line, _ in doc:
            if at in gone[n] or len(words(line)) < single_words:
                continue
            if line in seen:
                gone[n].add(at)
            seen.add(line)
    return {n: "\n".join(x for at, x in enumerate((t or "").split("\n")) if at not in gone[n]) for n, (_, t) in enumerate(rows)}


def fewest_edits(pattern, text):
    """Sellers' dynamic program: (edits, end) of the best match of a pattern anywhere in a text."""
    column = list(range(len(pattern) + 1))
    best = (column[-1], 0)
    for j, c in enumerate(text):
        above, column = column, [0]
        for i, p in enumerate(pattern):
            column.append(min(above[i] + (p != c), above[i + 1] + 1, column[i] + 1))
        best = min(best, (column[-1], j + 1), key=lambda x: x[0])
    return best


def leaks(docs, items, rate=0.1):
    out = {}
    for d, text in docs:
        w = words(text, PLAIN)
        for item, t in items:
            p = words(t, PLAIN)
            if p:
                edits, _ = fewest_edits(p, w)
                if edits <= int(len(p) * rate):
                    out[d, item] = min(edits, out.get((d, item), edits))
    return out


# --- quality: hashes, counts, weights and draw by plain integers


M64 = (1 << 64) - 1


def mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ x >> 27) * 0x94D049BB133111EB & M64
    return x ^ x >> 31


def word_hash(word):
    out = mix(len(word))
    for i in range(0, len(word), 8):
        out = mix((out * 0x9E3779B97F4A7C15 + int.from_bytes(word[i : i + 8], "little")) & M64)
    return out


def pair_hash(a, b):
    total = (7 * 2 + 1) * 0x9E3779B97F4A7C15 & M64
    for h in (a, b):
        total = (total ^ h) * 0xD6E8FEB86659FD93 & M64
        total ^= total >> 32
    return mix(total)


def spark_hash(*parts):
    """Spark's xxhash64 of integers (kind i), longs (q) and strings."""
    seed = 42
    for kind, value in parts:
        seed = xxhash.xxh64_intdigest(value.encode() if kind == "s" else struct.pack(f"<{kind}", value), seed=seed)
    return seed


def tokens_apart(text):
    """Words and runs of ASCII punctuation, lower-cased."""
    return re.findall(rb"[!-/:-@\[-`{-~]+|[^\x20\x09-\x0D!-/:-@\[-`{-~]+", (text or "").encode().translate(LOWER))


def cut_of(weights, good):
    """The lowest cut that leaves the fewest labelled rows on the wrong side."""
    values = sorted(set(weights))
    cuts = [-math.inf, *((a + b) / 2 for a, b in zip(values, values[1:])), values[-1] + 1]
    wrong = [sum((w < c) == g for w, g in zip(weights, good)) for c in cuts]
    return cuts[wrong.index(min(wrong))]


def quality(docs, labels, drop_toxic, buckets, toxic_buckets, least_g2, prior=0.5):
    """{doc_id: (log weight, kept)} for documents with different ids."""
    grams, seen = {}, {}
    for d, text in docs:
        h = [word_hash(w) for w in tokens_apart(text)]
        grams[d] = [(mix(x) >> 32) % buckets for x in h] + [(pair_hash(a, b) >> 32) % buckets for a, b in zip(h, h[1:])]
        seen[d] = {(mix(x) >> 32) % toxic_buckets for x in h}
    worst = {}
    for d, q, t in labels:
        if d is not None and q in (0, 1):
            before = worst.get(d, (1, 0))
            worst[d] = min(before[0], q), max(before[1], int(t == 1))
    good = {d: q * (1 - t) if drop_toxic else q for d, (q, t) in worst.items()}
    toxic = {d: t if drop_toxic else 0 for d, (_, t) in worst.items()}
    first = {d for d in worst if spark_hash(("i", 1), ("q", d)) % 2 == 0}
    raw, target = Counter(), Counter()
    for d, _ in docs:
        raw.update(grams[d])
        if d in first and good[d]:
            target.update(grams[d])
    ratio = lambda b: (
        math.log((target[b] + prior) / (target.total() + prior * buckets)) - math.log((raw[b] + prior) / (raw.total() + prior * buckets))
    )
    weight = {d: sum(map(ratio, grams[d])) for d, _ in docs}
    bad = [d for d, _ in docs if d in first and toxic[d]]
    clean = [d for d, _ in docs if d in first and good[d] and not toxic[d]]
    odds = {}
    if bad and clean:
        counts = [Counter(b for d in some for b in seen[d]) for some in (bad, clean)]
        t, c = len(bad), len(clean)
        for b in counts[0]:
            x, y = counts[0][b], counts[1][b]
            cells = ((x, t, x + y), (y, c, x + y), (t - x, t, t + c - x - y), (c - y, c, t + c - x - y))
            g2 = 2 * sum(n * math.log(n * (t + c) / (of * share)) for n, share, of in cells if n)
            if x * c > y * t and g2 > least_g2:
                odds[b] = math.log((x + prior) / (t + 2 * prior)) - math.log((y + prior) / (c + 2 * prior))
    score = {d: sum(odds.get(b, 0) for b in seen[d]) for d, _ in docs}
    judges = [d for d, _ in docs if d in worst and d not in first]
    fair = [d for d in judges if not toxic[d]]
    cut = cut_of([weight[d] for d in fair], [good[d] for d in fair]) if {good[d] for d in fair} == {0, 1} else -math.inf
    told = [d for d in judges if good[d] or toxic[d]]
    least = cut_of([-score[d] for d in told], [good[d] for d in told]) if {good[d] for d in told} == {0, 1} else -math.inf
    final = {d: weight[d] if -score[d] >= least else -math.inf for d in weight}
    k = sum(w >= cut and w > -math.inf for w in final.values())

    def noise(d):
        bits = spark_hash(("i", 0), ("s", str(d))) >> 11
        return -math.log(-math.log((bits + 0.5) / (1 << 53)))

    keys = sorted((w + noise(d) for d, w in final.items()), reverse=True)
    return {d: (w, k > 0 and w + noise(d) >= keys[k - 1]) for d, w in final.items()}, odds
