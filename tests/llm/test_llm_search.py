"""Archives, nearest neighbours, the set join and the pipeline against brute force."""

import base64
import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from beaconry.llm import ann, setjoin, warc
from beaconry.llm.words import shingle_sets


def test_archives(spark, tmp_path):
    rows = [(1, "http://a", "x"), (2, "http://b\r\nX: y", "x"), (3, None, "y"), (4, "u", None), (5, "u", ""), (2, "http://b2", "x"), (None, "n", "x"), (None, "n", "only"), (None, "n", "only"), (6, "big", "ü" * 300_000)]
    rows += [(100 + i, f"http://c/{i}", "hot page\r\n\r\nbody") for i in range(300)]
    pages = spark.createDataFrame([(p, u, h, "s", 0) for p, u, h in rows], "page_id long, url string, html string, sha string, owner int")
    index = warc.write_archives(pages.repartition(3), folder=str(tmp_path / "w"), file_bytes=10_000)
    got = warc.read_records(index).collect()
    owner = {}
    for p, _, h in rows:
        if p is not None:
            owner[h or ""] = max(owner.get(h or "", -1), p)
    want = []
    for p, u, h in rows:
        data = (h or "").encode()
        o = owner.get(h or "")
        kind = "response" if o is None or o == p else "revisit"
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        want.append((p, u, kind, o if kind == "revisit" else None, digest, len(data), data if kind == "response" else b""))
    assert sorted(([*r][:6] + [bytes(r.payload)] for r in got), key=str) == sorted(map(list, want), key=str)
    some = warc.read_records(index.where("page_id in (1, 150, 6)")).toPandas()
    assert sorted(some.page_id) == [1, 6, 150]
    assert index.select("file").distinct().count() > 3
    assert warc.read_records(warc.write_archives(pages.limit(0), folder=str(tmp_path / "e"))).count() == 0


def test_records_are_plain_warc():
    import gzip

    data = gzip.decompress(warc.record(7, "http://a b", b"p\r\n\r\nq", warc.base32_sha1(b"p\r\n\r\nq"), None, "2001-01-01T00:00:00Z"))
    assert re.match(rb"WARC/1\.1\r\nWARC-Type: response\r\n", data) and data.endswith(b"\r\n\r\n") and b"http://a%20b" in data
    names, payload = warc.parse(gzip.compress(data))
    assert payload == b"p\r\n\r\nq" and names["warc-record-id"] == "<urn:beaconry:page:7>"


def _vectors(spark, n=2_000, dim=16):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(n, dim))
    x[1::10] = x[::10] + rng.normal(size=(n // 10, dim)) * 0.01
    x[2::50] = x[::50]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x.astype(np.float32))]
    odd = [(n, None, 0), (n + 1, [], 0), (n + 2, [0.0] * dim, 0), (n + 100 - n % 100, [1.0, None], 0), (None, rows[0][1], 0), (n + 4, [float("nan")] * dim, 0), (n + 5, [float("inf")] * dim, 0), (0, rows[0][1], 0), (n + 6, [1.0, 2.0], 0)]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, dim int"), x.astype(np.float32).astype(float)


def test_nearest_neighbours(spark):
    vectors, x = _vectors(spark)
    queries = vectors.where("vec_id % 100 = 0")
    index = ann.build_index(vectors, shard_rows=500)
    exact = ann.search(index, queries, k=10, factor=1.0, block_rows=7).toPandas()
    want = []
    for q in range(0, len(x), 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        want += [(q, r + 1, int(v)) for r, v in enumerate(np.lexsort((np.arange(len(x)), d))[:10])]
    assert sorted(exact[["query_id", "rank", "vec_id"]].itertuples(index=False, name=None)) == want
    assert np.allclose(exact.score, np.sqrt(((x[exact.query_id] - x[exact.vec_id]) ** 2).sum(axis=1)))
    loose = ann.search(index, queries, k=10).toPandas()
    pairs = set(zip(exact.query_id, exact.vec_id, strict=True))
    assert len(pairs & set(zip(loose.query_id, loose.vec_id, strict=True))) >= 0.9 * len(pairs)
    few = ann.search(ann.build_index(vectors.limit(4)), vectors.limit(4), k=10, factor=1.0)
    assert few.count() == 12
    assert ann.search(ann.build_index(vectors.limit(0)), queries).count() == 0
    assert ann.search(index, queries.limit(0)).count() == 0


def _texts():
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghij", k=5))
    texts = [" ".join(word() for _ in range(rng.randint(20, 120))) for _ in range(150)]
    common = " ".join(word() for _ in range(30))
    texts += [common + " " + " ".join(word() for _ in range(25)) for _ in range(60)]
    base = [word() for _ in range(150)]
    for _ in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    for i in range(40):
        words = texts[i].split()
        words[rng.randrange(len(words))] = word()
        texts.append(" ".join(words))
    return texts + texts[:20] + [texts[0].upper() + "!"] * 30 + ["", "", None, "...", "one two", "One  two", "a b c d e"]


def _brute(rows, threshold=0.8):
    sets = [set(s.tolist()) for s in shingle_sets([t for _, t in rows])]
    same = lambda i, j: (rows[i][1] or "") == (rows[j][1] or "") if not sets[i] and not sets[j] else bool(sets[i]) and bool(sets[j]) and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])
    label, links = list(range(len(rows))), [0] * len(rows)
    root = lambda i: i if label[i] == i else root(label[i])
    for i in range(len(rows)):
        for j in range(i):
            if same(i, j):
                links[i] += 1
                links[j] += 1
                label[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, least[root(i)], links[i]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("plan", [setjoin.ChosenPath(), setjoin.ChosenPath(small=16), setjoin.ChosenPath(depth=3, small=40)])
def test_set_join(spark, plan):
    rows = list(enumerate(_texts()))
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, rep string").repartition(4)
    got = setjoin.similar_documents(docs, plan).toPandas()
    assert sorted(got[["doc_id", "class_id", "n_links"]].itertuples(index=False, name=None)) == _brute(rows)
    kept = setjoin.keep_one_each(docs, plan)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c, _ in _brute(rows)})


def test_set_join_odd_rows(spark):
    text = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    rows = [(None, text), (4, text + " one"), (4, text), (4, "quite another text of some words here"), (4, text), (2, "long " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = setjoin.similar_documents(docs).collect()
    assert len(got) == 6 and {r.class_id for r in got} == {-(1 << 63), 4, 2}
    assert setjoin.similar_documents(docs.limit(0)).count() == 0


def test_one_row_of_each_class_stays(spark):
    words = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    other, third = "quite another text of some words here", "the third text resembles nothing else at all"
    rows = [(3, words), (4, words), (4, other), (None, third), (None, third), (None, third), (None, words + " one"), (9, third), (5, ""), (5, ""), (5, None), (6, "one two"), (6, "one two")]
    docs = spark.createDataFrame([(d, t, i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, row int").repartition(3)
    kept = setjoin.keep_one_each(docs)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text or "") for r in kept.collect()]
    assert sorted(got, key=str) == sorted([(None, words + " one"), (4, other), (None, third), (5, ""), (6, "one two")], key=str)


def test_each_wanted_set_meets_one_text(spark, monkeypatch):
    rng = random.Random(8)
    near = [" ".join("".join(rng.choices("abcdefghij", k=5)) for _ in range(60)) for _ in range(40)]
    docs = spark.createDataFrame([(None, t + end) for t in near for end in ("", " tail")] + [(1, near[0])] * 20, "doc_id long, text string")
    met, into = [], type(docs).mapInArrow

    def counted(self, function, schema, *args, **named):
        if schema == "rep long, shingles binary":
            met.append(self.count())
        return into(self, function, schema, *args, **named)

    monkeypatch.setattr(type(docs), "mapInArrow", counted)
    got = setjoin.similar_documents(docs).collect()
    assert met == [80] and sum(r.n_links for r in got) == 2 * (40 + 20 + 20) + 20 * 19


def test_chance_and_runs():
    plan = setjoin.ChosenPath()
    assert plan.runs >= 3 and setjoin.ChosenPath(recall=0.999999).runs > plan.runs and plan.least_shared < 0.8 * setjoin.SAMPLES


def test_intersections():
    rng = np.random.default_rng(8)
    sets = [np.unique(rng.integers(0, 1 << 63, 200, dtype=np.uint64) % np.uint64(400) * np.uint64(0x9E3779B97F4A7C15)) for _ in range(30)]
    sets = [np.sort(s) for s in sets]
    i, j = np.triu_indices(30, 1)
    want = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)]
    assert setjoin.intersections(sets, i, j).tolist() == want and setjoin.intersections(sets, i[:5], j[:5]).tolist() == want[:5]


def test_pipeline_stages(spark, tmp_path):
    """Each stage on its own input: what it drops and what it leaves alone."""
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choices("etaoinsr", k=rng.randint(2, 7))) for _ in range(n))
    notice = "a licence line that many documents hold"
    good = [f"{prose(60)}\n{notice}\n{prose(40)}" for _ in range(120)]
    bad = [" ".join("".join(rng.choices("#$%&*!", k=4)) for _ in range(120)) for _ in range(40)]
    copies = [good[3], good[4].replace(" ", "  ", 1), good[5] + " x"]
    texts = good + bad + copies
    folder = str(tmp_path)
    frame = pd.DataFrame({"doc_id": range(len(texts)), "text": texts, "lang": "en", "source": "s", "n_chars": [len(t) for t in texts]})
    spark.createDataFrame(frame).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i < 120)) for i in range(160)], "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean = corpus_pipeline.quality(spark, docs, folder)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == {*range(120), 160, 161, 162}
    unique = corpus_pipeline.lines(spark, clean, folder)
    rows = {r.doc_id: r for r in unique.collect()}
    assert sum(notice in r.text for r in rows.values()) == 1 and rows[160].text == "" and all(r.n_chars == len(r.text) for r in rows.values())
    single = corpus_pipeline.near_copies(spark, clean, folder)
    assert {r.doc_id for r in single.collect()} == set(range(120))
    packed = corpus_pipeline.packing_(spark, single, folder).toPandas()
    assert packed.doc_id.nunique() == 120
    result = corpus_pipeline.run(spark, folder).toPandas()
    assert set(result.doc_id) <= {*range(120), 160, 161, 162} and len(result)


def test_columns_of_the_caller_stay(spark, tmp_path):
    """Columns named as the stages name their own come back as they were, through the filtering stages."""
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(i, f"{text} {i // 2}", 70 + i, "mine", "own") for i in range(6)] + [(None, None, 1, "none", None), (3, text + " 1", 2, "again", "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long, quality_score string, given string")
    kept = setjoin.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert {(r._row, r.quality_score, r.given) for r in kept.collect()} == {(70, "mine", "own"), (1, "none", None)}
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    clean = corpus_pipeline.quality(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns and sorted(map(str, clean.collect())) == sorted(map(str, docs.collect()))
