"""Packing, cross-tokenizer alignment and the prefix trie, against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyline.llm import alignment, packing, prefix_trie
from tallyline.llm.workload import QUERIES

SF_DIR = "/root/testdata/sf0.001"
WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

ODD_TEXTS = [
    None, "", " ", "don't we'll 's", "<|endoftext|> and <|startoftext|>x", "<|ENDOFTEXT|> x", "a\x1cb c\x85d e　f", "́e é É ß ẞ İ Σς",
    "日本語🙂 " * 200, "x" * 9000, "tab\tand\n\n lines ", "a▁b", "\x00 <0x41> <s> </s> <unk>", "1234 5.6e7 ²³ ½", "À×Ö÷ø ÿ", "A" * 3 + "!" * 50,
]


def documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    odd = [(10**6 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "same"), (None, "same"), (10**6, "null's id again")]
    clash = spark.createDataFrame(odd, "doc_id long, text string")
    both = docs.unionByName(clash)
    return both.select("*", *[F.lit("x").alias(c) for c in ("ids", "length", "rank", "pair", "n", "links", "task")])


# ---- packing


def places(plan, histogram):
    length = np.repeat(list(histogram), list(histogram.values())).astype(np.int64)
    rank = np.concatenate([np.arange(n) for n in histogram.values()] or [np.zeros(0, np.int64)])
    done, used = np.zeros(len(length), np.int64), defaultdict(list)
    for piece, at, size, sequence, offset in plan.place(length, rank):
        assert (done[piece] == at).all()
        done[piece] += size
        for s, o, z in zip(sequence.tolist(), offset.tolist(), size.tolist()):
            used[s].append((o, z))
    assert (done == length).all()
    return used


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 70).flatmap(lambda w: st.tuples(st.just(w), st.dictionaries(st.integers(1, w), st.integers(1, 300), max_size=30))))
def test_plan_places_each_id_once_and_pads_nothing(case):
    width, histogram = case
    plan = packing.Plan(histogram, width)
    used = places(plan, histogram)
    assert sorted(used) == list(range(plan.sequences))
    for slices in used.values():
        end = 0
        for offset, size in sorted(slices):
            assert offset == end
            end += size
        assert end == width or end < width and end & (end - 1) == 0
    cuts = sum(map(len, used.values())) - sum(histogram.values())
    assert cuts <= plan.sequences


def test_plan_matches_long_with_short_uncut():
    """Three of 60 and three of 40 into 100s: the shortest packs get the rest, and nothing is cut."""
    used = places(packing.Plan({60: 3, 40: 3}, 100), {60: 3, 40: 3})
    assert [sorted(s) for s in used.values()] == [[(0, 60), (60, 40)]] * 3


def test_plan_work_does_not_follow_the_number_of_pieces():
    small, large = ({n: k for n in range(1, 2049)} for k in (1_000, 1_000_000_000))
    assert len(packing.Plan(large).steps["rank"]) < 2 * len(packing.Plan(small).steps["rank"]) < 40_000


def test_encoder_equals_the_whole_text(spark):
    tokenizer = Tokenizer.from_file(WORD)
    texts = [r["text"] or "" for r in documents(spark).select("text").collect()]
    for texts in (texts, ["A b", "b a A", "a"]):
        want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        for last in (packing.word_ends(WORD), None):
            assert packing.Encoder(WORD, last).encode(texts) == want
    assert packing.word_ends(BYTE) is None


def test_words_with_marks_are_known_by_their_letters():
    last = packing.word_ends(WORD)
    encoder = packing.Encoder(WORD, last)
    words, marks = [f"word{chr(97 + i)}" for i in range(20)], ".,;:!?)%$#"
    odd = ["foo\u00d7. a\u00f7! x", "don't it's dogs' s 'tis rock'n'roll", "(foo) a-b a.b. 12. a1, ...", "\u00c9t\u00e9, \u00e9t\u00e9. \u00fc\u00ff!", "", " \n"]
    texts = [" ".join(w + m * n for w in words for m in marks for n in (1, 2)), *odd]
    want = [np.array(encoder.whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encoder.encode(texts[:1]) == want[:1] and len(encoder.cache) == 20 + 2 * 10  # 400 words
    assert encoder.encode(texts) == want


def test_frequent_words_are_encoded_once(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 60)
    learned = Counter()
    learn = packing.Encoder._learn_letters
    monkeypatch.setattr(packing.Encoder, "_learn_letters", lambda self, by, words: (learned.update(words), learn(self, by, words))[1])
    tokenizer = Tokenizer.from_file(WORD)
    encoder = packing.Encoder(WORD, packing.word_ends(WORD))
    letters = "abcdefghij"
    for i in range(30):
        text = " ".join(["the", "often, caf\u00e9 Stem!", *(f"rare{letters[i // 10]}{letters[i % 10]}{x}" for x in letters)])
        want = np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert encoder.encode([text]) == [want]
        assert len(encoder.cache) <= 60 and len(encoder.older) <= 60
    assert len(learned) == 304 and set(learned.values()) == {1}


@pytest.mark.parametrize("width", [2048, 100])
def test_packing(spark, width):
    docs = documents(spark)
    packed = packing.pack_documents(docs, WORD, width=width)
    rows = packed.collect()
    tokenizer = Tokenizer.from_file(WORD)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        want[r["doc_id"], np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4").tobytes()] += 1
    # documents with one id are told apart by their length, repeated ones by the number of pieces
    parts = defaultdict(list)
    for r in rows:
        parts[r["doc_id"], r["doc_tokens"]].append((r["start"], bytes(r["ids"])))
        assert len(r["ids"]) == 4 * r["length"] and 1 <= r["length"] <= width
    for (doc_id, ids), n in want.items():
        got = sorted(parts[doc_id, len(ids) // 4])
        same = Counter(ids[4 * s : 4 * s + len(d)] == d for s, d in got)
        assert same[True] >= n
    assert sum(r["length"] for r in rows) == sum(n * (len(ids) // 4) for (_, ids), n in want.items())
    whole = packing.sequences(packed).collect()
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append(r)
    assert len(whole) == len(by_sequence)
    for s in whole:
        held = sorted(by_sequence[s["sequence_id"]], key=lambda r: r["offset"])
        assert [r["offset"] for r in held] == [sum(x["length"] for x in held[:i]) for i in range(len(held))]
        assert b"".join(bytes(r["ids"]) for r in held) == bytes(s["ids"])
        assert s["n_tokens"] == width or s["n_tokens"] < width and s["n_tokens"].bit_count() == 1


def test_packing_of_equal_and_no_documents(spark):
    ones = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    rows = packing.pack_documents(ones, WORD).groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert sorted(r["n"] for r in rows) == sorted([2048, 2048, 8, 128, 256, 512])
    assert packing.pack_documents(ones.limit(0), WORD).count() == 0


def test_packing_query(spark):
    rows = QUERIES["op11_packing"](spark, SF_DIR).collect()
    tokenizer = Tokenizer.from_file(WORD)
    ids = {
        r["doc_id"]: np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    }
    seen = Counter()
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        seen.update((r["doc_id"], i) for i in range(r["start"], r["start"] + r["length"]))
    assert set(seen.values()) == {1} and len(seen) == sum(map(len, ids.values()))


# ---- alignment


def aligned(rows):
    """Each row's figures by sets of ends."""
    a_tok = Tokenizer.from_file(BYTE)
    a_tok.encode_special_tokens = True
    b_tok = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    alphabet = alignment.byte_level_alphabet()

    def ends(tokens):
        return np.cumsum([len(t) for _, t in tokens]).tolist()

    done, counts = [], Counter()
    for doc_id, text in rows:
        a = b = []
        if text:
            e = a_tok.encode(" " + text, add_special_tokens=False)
            a = [(i, bytes(alphabet[c] for c in t)) for i, t in zip(e.ids, e.tokens)]
            for i in b_tok.encode(text):
                p = b_tok.id_to_piece(i)
                b = [*b, (i, bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode())]
            if {b"".join(t for _, t in x) for x in (a, b)} != {(" " + text).encode()}:
                a = b = []
        both = set(ends(a)) & set(ends(b))
        groups = []
        for side in (a, b):
            groups.append([[]])
            for (i, _), end in zip(side, ends(side)):
                groups[-1][-1].append(i)
                if end in both:
                    groups[-1].append([])
        groups = list(zip(*groups))[:-1]
        links = [(x[-1], y[-1]) for x, y in groups]
        counts.update(links)
        done.append((doc_id, len(a), len(b), groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return sorted((
        (
            -1 if doc_id is None else doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
            sum(counts[x] for x in links),
            hashlib.sha256(";".join("|".join(",".join(map(str, s)) for s in g) for g in groups).encode()).hexdigest() if groups else "",
        )
        for doc_id, n_a, n_b, groups, links in done
    ))


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SPAN", 50)
    docs = documents(spark).where("length(text) < 20000 OR text IS NULL")
    got = alignment.Alignment(docs, BYTE, PIECE).documents()
    assert got.columns == COLUMNS
    rows = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, got.collect()))
    assert rows == aligned([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_alignment_query(spark):
    got = sorted(map(tuple, QUERIES["op12_alignment"](spark, SF_DIR).select(*COLUMNS).collect()))
    assert got == aligned([tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()])


def test_alignment_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.Alignment(none, BYTE, PIECE).documents().count() == 0
    nulls = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(map(tuple, alignment.Alignment(nulls, BYTE, PIECE).documents().collect())) == [(d, 0, 0, 0, 0, 0, 0, "") for d in (1, 2)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1), st.randoms(use_true_random=False)), min_size=1, max_size=8))
def test_merge(cases):
    sides, firsts = ([], []), ([0], [0])
    for sizes, rng in cases:
        total = sum(sizes)
        other = sorted({total, *(x for x in range(1, total) if rng.random() < 0.4)})
        for side, first, own in zip(sides, firsts, (sizes, np.diff([0, *other]).tolist())):
            side.extend(own)
            first.append(len(side))
    ends = [np.cumsum(s) for s in sides]
    bounds = [np.array(f) for f in firsts]
    want = np.intersect1d(*ends)
    for some in (bounds, alignment.spans(*ends, *bounds)):
        a, b = alignment.merge(*ends, *some)
        assert (ends[0][a] == want).all() and (ends[1][b] == want).all()


# ---- trie


def trie(rows, period=100, choices=6):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % choices
        base = c - (c % period if c >= 0 else -(-c % period))
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    saved, leaves, out = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children[node]
        leaves[node] = sum(leaves[x] for x in below) if below else 1
        saved[node] = sum(saved[x] for x in below) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(whole[c]) == len(node))
        out.append((
            min(members[node]), len(node), min(members[node[:-1]]) if node else -10**9, len(members[node]), len(below),
            leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out)


TRIE_COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
CONVERSATIONS = "conv_id long, turn long, role string, text string"


def trie_rows(turns):
    rows = prefix_trie.PrefixTrie(turns).rows()
    assert rows.columns == TRIE_COLUMNS
    return sorted(tuple(-10**9 if v is None else v for v in r) for r in rows.collect())


@pytest.mark.parametrize("first", [4096, 3])
def test_trie(spark, monkeypatch, first):
    """With a small first batch, most classes meet a trie that earlier batches made."""
    monkeypatch.setattr(prefix_trie, "FIRST_BATCH", first)
    monkeypatch.setattr(prefix_trie, "GROWTH", 3)
    monkeypatch.setattr(prefix_trie, "CHUNK", 20)
    rng = random.Random(5)
    rows = []
    for c in [*range(60), *range(100, 140), 205, 306, -3, -207]:
        n = rng.choice([1, 2, 3, 3, 4, 7, 20])
        rows += [(c, t, rng.choice("ua"), rng.choice(["", "x", "yy", "é"])) for t in range(n)]
    rows += [(0, t, "u", "deep") for t in range(50, 90)] + [(100, t, "u", "deep") for t in range(50, 90)]
    rows += [(7, None, None, None), (7, None, "u", "tie"), (7, 1, "u", "tie"), (7, 1, "u", "tie"), (None, 0, "u", "no id")]
    rows += [(500 + c, t, "s", "hot") for c in range(80) for t in range(9)]
    df = spark.createDataFrame(rows, CONVERSATIONS).select("*", F.lit(1).alias("at"), F.lit("z").alias("sig"), F.lit(0).alias("part"))
    assert trie_rows(prefix_trie.rebuilt_turns(df)) == trie(rows)


def test_trie_of_plain_turns(spark, monkeypatch):
    """Any turns will do, with a row of part -1 for each conversation."""
    monkeypatch.setattr(prefix_trie, "FIRST_BATCH", 2)
    monkeypatch.setattr(prefix_trie, "GROWTH", 2)
    turns = [(c, -1, 0, "", "") for c in range(6)]
    for c, said in enumerate(["ab", "abc", "abd", "", "xyzxyz", "xyzxyw"]):
        turns += [(c, 0, i, "u", x) for i, x in enumerate(said)]
    got = {(r[0], r[1]): r[2:7] for r in trie_rows(spark.createDataFrame(turns, "conv_id long, part int, at int, role string, text string"))}
    assert got[0, 0] == (-10**9, 6, 2, 4, 4 + 5)
    assert got[0, 2] == (0, 3, 2, 2, 2) and got[1, 3] == (0, 1, 0, 1, 0)
    assert got[4, 5] == (4, 2, 2, 2, 1) and got[5, 6] == (4, 1, 0, 1, 0) and len(got) == 1 + 4 + 7


def test_trie_without_conversations(spark):
    assert trie_rows(prefix_trie.rebuilt_turns(spark.createDataFrame([], CONVERSATIONS))) == []
    nothing = spark.createDataFrame([(None, 1, "u", "x")], CONVERSATIONS)
    assert trie_rows(prefix_trie.rebuilt_turns(nothing)) == []
    # crc32("8") % 6 is 4: without a base and with one turn, conversation 108 has no turns left
    assert zlib.crc32(b"108") % 6 > 0
    alone = spark.createDataFrame([(108, 1, "u", "x")], CONVERSATIONS)
    ends = hashlib.sha256(b"108").hexdigest()
    assert trie_rows(prefix_trie.rebuilt_turns(alone)) == [(108, 0, -10**9, 1, 0, 1, 0, ends)]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 10**6))
def test_fat_numbers(low, more):
    high = low + more
    fat = max(range(low + 1, min(high, low + 64) + 1), key=lambda x: x & -x) if more <= 64 else None
    got = -1 << ((low ^ high).bit_length() - 1) & high
    assert low < got <= high and (fat is None or got == fat)
