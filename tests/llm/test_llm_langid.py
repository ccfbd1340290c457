"""Language identification against a plain mixture estimate, and on held-out documents."""

import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from beaconry.llm import langid
from beaconry.llm.queries import QUERIES

STOCK = {
    "en": "the house stands where water and wind have made their long way through every field".split(),
    "de": "über das Haus weht der Wind, während Straßen zwischen großen Wäldern schweigend warten".split(),
    "fr": "où était la maison dont les fenêtres regardaient vers une rivière très éloignée".split(),
}


def text_of(rng, *langs, words=40):
    return " ".join(w for lang in langs for w in rng.choices(STOCK[lang], k=words))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    return langid.learn({lang: [text_of(rng, lang) for _ in range(20)] for lang in STOCK}, ["en", "de", "fr"])


def plain_word(model, word):
    marked = f" {word} "
    grams = list(word) + [marked[i : i + 2] for i in range(len(marked) - 1)] + [marked[i : i + 3] for i in range(len(marked) - 2)]
    rows = [model.logs[model.place.get(g, len(model.place))] for g in grams]
    return [sum(r[j] for r in rows) for j in range(len(model.languages))]


def plain_fit(words, allowed):
    """Shares by many rounds, and the log likelihood, word by word."""
    share = {j: 1 / len(allowed) for j in allowed}
    total = sum(words.values())
    for _ in range(300):
        new = dict.fromkeys(allowed, 0.0)
        for (_, likely), n in words.items():
            joint = sum(share[j] * likely[j] for j in allowed)
            for j in allowed:
                new[j] += n * share[j] * likely[j] / joint / total
        share = new
    return share, sum(n * math.log(sum(share[j] * likely[j] for j in allowed)) for (_, likely), n in words.items())


def plain(model, text):
    counts = Counter(w for w in "".join(c if c.isalpha() else " " for c in text.lower()).split())
    words = {}
    for w, n in counts.items():
        logs = plain_word(model, w)
        words[w, tuple(math.exp(x - max(logs)) + 1e-30 for x in logs)] = n
    total = sum(words.values())
    share, told = plain_fit(words, [0, 1, 2])
    allowed = [j for j in share if share[j] * total >= 0.5]
    if len(allowed) < 3:
        share, told = plain_fit(words, allowed)
    while len(allowed) > 1:
        fewer = sorted(allowed, key=lambda j: (share[j], -j))[1:]
        some, less = plain_fit(words, sorted(fewer))
        if told - less > math.log(total + 1):
            break
        allowed, share, told = sorted(fewer), some, less
    return {model.languages[j]: share[j] for j in allowed}


def test_shares_equal_plain_estimate(spark, model):
    rng = random.Random(2)
    texts = [text_of(rng, *rng.sample(list(STOCK), rng.randint(1, 3)), words=rng.randint(2, 30)) for _ in range(60)]
    texts.append(text_of(rng, "de", words=20_000) + " " + text_of(rng, "en", words=5_000))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    for row in langid.predict(df, model).collect():
        want = plain(model, texts[row.doc_id]) if row.doc_id < 60 else {"de": 0.8, "en": 0.2}
        assert row.lang_shares.keys() == want.keys()
        assert all(abs(row.lang_shares[k] - v) < 0.02 for k, v in want.items())
        assert row.lang_score == max(row.lang_shares.values()) and row.lang_shares[row.lang_pred] == row.lang_score


def test_odd_texts(spark, model):
    rows = [(None, None, "x"), (1, "", "x"), (2, "12 — ²½ 34!", "x"), (3, "ß" * 100_000, "x"), (3, "漢字かな交じり", "x"), (4, "\0the house\0", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = {r.text: (r.lang_pred, r.lang_score) for r in langid.predict(df, model).collect()}
    assert got[None] == got[""] == got["12 — ²½ 34!"] == ("und", 0.0)
    assert got["ß" * 100_000][0] == "de" and got["\0the house\0"][0] == "en" and got["漢字かな交じり"][0] in STOCK
    assert langid.predict(df.limit(0), model).collect() == []


def test_fit_is_bounded_and_takes_odd_rows(spark):
    rng = random.Random(3)
    rows = [(i, text_of(rng, lang), lang) for lang in STOCK for i in range(30)] + [(7, "one and the same", "en")] * 500
    rows += [(None, "Text", "de"), (5, None, "fr"), (6, "", "fr"), (8, "no language", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, sample=10, longest=50)
    assert model.languages == ["en", "de", "fr"]
    assert langid.fit(df, languages=2).languages == ["en", "de"]
    none = langid.fit(df.where("lang IS NULL"))
    assert none.languages == [] and [tuple(r)[1:] for r in langid.predict(df.select("text").limit(1), none).collect()] == [("und", 0.0, {})]


def test_held_out_accuracy(spark):
    rows = QUERIES["op13_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    known = duckdb.sql("SELECT doc_id, lang, text FROM '/root/testdata/sf0.01/documents.parquet'").df()
    assert (rows.held_out == [zlib.crc32(str(d).encode()) % 4 == 2 for d in rows.doc_id]).all() and len(rows) == len(known)
    both = rows.merge(known, on="doc_id")
    held = both[both.held_out]
    assert (held.lang_pred == held.lang).mean() >= 0.98
    assert both.score.between(0, 1).all() and np.isfinite(both.score).all()
