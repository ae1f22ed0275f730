import random
import re

from pyspark.sql import functions as F

from tallyline.functions import bigrams, first_distinct_tokens, tokens
from tallyline.operators import counting


def raw_tokens(text):
    return [w for w in re.split(r"[ \t\n\r\f]+", text) if w]


def strip(word):
    """From the first to the last of the characters that are letters a to z."""
    low = word.lower()
    letters = [k for k, c in enumerate(low) if "a" <= c <= "z"]
    return low[letters[0] : letters[-1] + 1] if letters else ""


def first_set(text, limit):
    """Tokens at word positions below the limit, and the first token at or after it."""
    found = [strip(w) for w in raw_tokens(text)]
    if limit is None:
        return set(found) - {""}
    late = [w for w in found[limit - 1 :] if w][:1]
    return set(found[: limit - 1] + late) - {""}


def texts(n=400, seed=7):
    rng = random.Random(seed)
    words = ["The", "don't", "123", "a1b", "été", "STOP!", "'tis", "--", "x", "ça", "A", "o'", "9z9"]
    gaps = [" ", "  ", "\t", "\n", "\f", " \r\n", "\x0b", " "]
    made = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 30)))
            for _ in range(n)]
    return made + ["", " ", " lead", "trail ", "\n\n"]


def test_tokens_follow_the_split_and_strip_rule(spark):
    given = texts()
    df = spark.createDataFrame([(t,) for t in given], "text string").select("text", tokens("text").alias("t"))
    for text, got in df.collect():
        assert got == [w for w in map(strip, raw_tokens(text)) if w], repr(text)


def test_first_distinct_tokens_on_random_texts(spark):
    df = spark.createDataFrame([(t,) for t in texts()], "text string")
    for limit in (1, 2, 5, 10):
        rows = df.select("text", first_distinct_tokens("text", limit).alias("t")).collect()
        for text, got in rows:
            assert len(got) == len(set(got)) <= limit
            assert set(got) == first_set(text, limit), (limit, text)


def test_the_hundredth_raw_token(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(105)]
    numeric = words[:99] + ["123"] + words[100:]
    df = spark.createDataFrame([(" ".join(words),), (" ".join(numeric),)], "text string")
    plain, skipped = (set(r[0]) for r in df.select(first_distinct_tokens("text", 100)).collect())
    assert plain == set(words[:100])
    assert skipped == set(words[:99]) | {words[100]}


def test_bigrams(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b", "c"],)], "t array<string>")
    got = [[tuple(p) for p in r[0]] for r in df.select(bigrams("t")).collect()]
    assert got == [[], [], [("a", "b"), ("b", "c")]]


def test_counts(spark):
    docs = spark.createDataFrame([("Don't STOP!",), ("été 123 a1b",), ("",), ("stop\tin\fit",)], "text string")
    counts = dict(counting.word_count(docs).collect())
    assert counts == {"don't": 1, "stop": 2, "t": 1, "a1b": 1, "in": 1, "it": 1}
    assert dict(counting.prefix_count(docs).collect()) == {"do": 1, "st": 2, "a1": 1, "in": 1, "it": 1}
    assert counting.line_count(docs).first().n == 4
    top = counting.top_counts(counting.word_count(docs), "w", 2).collect()
    assert [r.w for r in top] == ["stop", "a1b"]


def test_map_sum(spark):
    rows = [("x", {"a": 1, "b": 2}), ("x", {"b": 3}), ("y", {"a": 5})]
    df = spark.createDataFrame(rows, "k string, stripe map<string,int>")
    got = {(r.k, r.neighbour): r.total for r in counting.map_sum(df, "k").collect()}
    assert got == {("x", "a"): 1, ("x", "b"): 5, ("y", "a"): 5}


def test_prefix_length(spark):
    docs = spark.createDataFrame([("abc ab a",)], "text string")
    assert dict(counting.prefix_count(docs, 3).collect()) == {"abc": 1}
    assert counting.lookup(counting.prefix_count(docs), "prefix", "ab").first().n == 2
    assert docs.select(F.length("text")).first()[0] == 8
