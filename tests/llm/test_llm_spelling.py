"""Spelling variants against plain edit distances."""

import random
import re
import zlib
from collections import Counter

import pytest

from beaconry.llm import spelling

DOCS = "n long, doc_id long, text string, word string"


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(words):
    out = {}
    around = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(around[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, words[w], len(around[w]), words[form[w]] if form[w] else None)
    return out


def told(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def made(seed, size, letters, least, most):
    rng = random.Random(seed)
    words = set()
    while len(words) < size:
        word = "".join(rng.choices(letters, k=rng.randint(least, most)))
        words.add(word)
        at = rng.randrange(len(word))
        words.add(word[:at] + rng.choice(letters) + word[at + rng.randint(0, 1) :])
    return {w: rng.choice([2, 2, 3, 20, 30, 300, 4000]) for w in words if len(w) >= least}


@pytest.mark.parametrize(("seed", "letters", "most_pairs"), [(1, "ab", 1 << 14), (2, "ab", 1), (3, "abcéÿ", 4), (4, "abcdefgh", 1 << 14)])
def test_equals_plain_distances(spark, seed, letters, most_pairs):
    """Also where nearly every key is hot, so that words meet after several halvings."""
    words = made(seed, 120, letters, 7, 10)
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert told(spelling.variants(df, most_pairs=most_pairs)) == plain(words)


def test_words_that_share_a_long_head(spark):
    """A hot chunk: all words begin alike, so the rest decides."""
    rng = random.Random(5)
    words = {"international" + "".join(rng.choices("abcd", k=rng.randint(1, 5))): rng.choice([2, 30, 500]) for _ in range(150)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert told(spelling.variants(df, most_pairs=50)) == plain(words)


def test_chain_of_forms(spark):
    words = {"abcdefg": 2, "abcdefgh": 20, "abcdefghi": 200, "abcdefghij": 2000, "zzzzzzz": 5}
    got = told(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == plain(words) and got["abcdefg"][1] == "abcdefghij" and got["zzzzzzz"] == (None, "zzzzzzz", 5, 0, None)


@pytest.mark.parametrize("misspell", [False, True])
def test_vocabulary(spark, misspell):
    rng = random.Random(8)
    stock = ["Éclairage", "STRASSEN", "straßenbahn", "wonderful", "wonderfull", "x×y÷zabc", "tiny", "naïveté", "ПРИВЕТЫ"]
    docs = [(1, i if i % 9 else None, " ".join(rng.choices(stock, k=30)) if i % 7 else None, "w") for i in range(80)] + [(1, 1, "", "w")]
    docs += [(1, 3, "wonderful-" * 5000, "w")]
    want = Counter()
    for _, d, text, _ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if misspell and h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            want[run] += len(run) >= 7
    got = spelling.vocabulary(spark.createDataFrame(docs, DOCS), misspell=misspell).collect()
    assert {r.word: r.n for r in got} == {w: n for w, n in want.items() if n >= 2}


def test_no_words(spark):
    empty = spelling.vocabulary(spark.createDataFrame([(1, 1, None, "w"), (1, 2, "short.", "w")], DOCS))
    assert empty.collect() == [] and spelling.variants(empty).collect() == []
