"""Text operators against plain Python: quality, line dedup, fingerprints, packing, pieces, token files, shards."""

import hashlib
import random
import re
import struct
import time
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from beaconry.llm import fingerprint, linededup, packing, pieces, quality, sharding, tokenfile
from beaconry.llm.queries import shards_sql
from beaconry.llm.words import WordEncoder, large_slices, shingle_sets

# Nulls, empties, ties, repeated rows, a very long text, and columns whose names the operators use inside.
LONG = "\n".join(f"line number {i % 700} of a long text" for i in range(6_000))
ROWS = [
    (5, "Shared line of text\nown five\n\nshared LINE of text  "), (3, "\tshared line of TEXT\nshort\nshort\nshort"),
    (3, "\tshared line of TEXT\nshort\nshort\nshort"), (9, None), (7, ""), (None, "shared line of text\nnull id"),
    (8, "ÀÉ shared line ÀÉ\nown"), (10, "àé shared line àé\nShared line of text"), (11, LONG), (12, LONG), (13, "one\ttwo  three don't ﬀ ́x\n y <s>"),
    (14, "Ünïcode  😀 日本語\x1c!"),
]
SCHEMA = "doc_id long, text string, row string, n_lines string, shard string, key int, doc string, sequence_id string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, "r", "n", "s", 1, "d", "q") for d, t in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def test_line_dedup(docs, empty):
    low = -(1 << 63)
    owner = {}
    for d, t in ROWS:
        for k in map(_key, (t or "").split("\n")):
            if len(k) >= 10:
                owner[k] = min(owner.get(k, 1 << 63), low if d is None else d)
    want = []
    for d, t in ROWS:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(_key(x)) < 10 or owner[_key(x)] == (low if d is None else d)]
        want.append((d, None if t is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    for batches, fanout in ((1, 2), (4, 2), (3, 5)):
        got = linededup.dedup_lines(docs, batches=batches, fanout=fanout, report=True)
        rows = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()]
        assert sorted(rows, key=str) == sorted(want, key=str)
    plain = linededup.dedup_lines(docs)
    assert plain.columns == docs.columns and plain.first().n_lines == "n"
    assert linededup.dedup_lines(empty).count() == 0


def test_runs_are_compacted(spark):
    runs = linededup.LineRuns(spark, fanout=2, buckets=2)
    try:
        for i in range(5):
            fresh = runs.add(spark.range(i * 5, i * 5 + 10).select(F.col("id").alias("h1"), F.lit(0).cast("long").alias("h2"), F.lit(i).cast("long").alias("owner")))
            assert fresh.count() == (10 if i == 0 else 5)
            runs.compact()
        assert [len(level) for level in runs.levels] == [1, 0, 1]
    finally:
        runs.drop()


def test_fingerprints_form_a_ring(spark):
    a, b = "one two three\nfour five\n" * 40, "six seven eight nine ten\n" * 30
    df = spark.createDataFrame([(a, b)], "a string, b string")
    fa, fb = fingerprint.fingerprint(F.col("a")), fingerprint.fingerprint(F.col("b"))
    both = fingerprint.fingerprint(F.concat_ws("\n", "a", "b"))
    row = df.select(
        (fingerprint.combine(fa, fb) == both).alias("added"), (fingerprint.remove(both, fb) == fa).alias("removed"),
        (fingerprint.fingerprint(F.concat_ws("\n", "b", "a")) == both).alias("order"), (fa == fb).alias("differ"),
        fingerprint.likeness(fa, fa).alias("same"), fingerprint.likeness(fa, fb).alias("other"),
    ).first()
    assert row.added and row.removed and row.order and not row.differ and row.same == 1 and row.other < 0.6


def test_fingerprints_of_neighbours(docs, empty):
    ordered = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    nexts = dict(zip([r[0] for r in ordered], [*[r[1] or "" for r in ordered[1:]], ordered[0][1] or ""], strict=True))
    got = fingerprint.compare_documents(docs, slices=4).collect()
    assert len(got) == len(ROWS)
    texts = {}
    for r in got:
        text = dict(ROWS)[r.doc_id] or ""
        if r.doc_id != 3:
            third = len(text) // 3
            assert r.edited == text[: len(text) - third] + nexts[r.doc_id][:third]
        assert r.n_chars == len(text) and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert texts.setdefault(text, r.fingerprint) == r.fingerprint
    assert next(r for r in got if r.doc_id == 12).near_next == 1
    assert len(set(map(tuple, texts.values()))) == len(texts)
    assert fingerprint.compare_documents(empty).count() == 0


def test_likeness_follows_shared_pieces(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    base = ["  ".join(word() for _ in range(4)) for _ in range(300)]
    part = base[:200] + ["  ".join(word() for _ in range(4)) for _ in range(100)]
    df = spark.createDataFrame([("\n".join(base), "\n".join(part))], "a string, b string")
    near = df.select(fingerprint.likeness(fingerprint.fingerprint(F.col("a")), fingerprint.fingerprint(F.col("b")))).first()[0]
    assert abs(near - 2 / 3) < 0.2


def _pieces_by_hand(paragraph):
    """Runs of words that end with a word whose last character is a cut, or with the twelfth."""
    out, run = [], []
    for word in re.finditer(r"[^ \t\n\x0b\f\r]+", paragraph):
        run.append(word)
        last = ord(word.group()[-1])
        if len(run) == fingerprint.LONGEST_PIECE or (0x21 <= last < 0x100 and last % 4 == 2):
            out.append(run)
            run = []
    return [paragraph[r[0].start() : r[-1].end()] for r in [*out, *([run] if run else [])]]


def _fingerprint_by_hand(text):
    """Plain sums, without the packing of lanes: pieces, equal lanes, signed lanes."""
    equal, lanes, n = [0] * fingerprint.EQUAL, [[0, 0, 0] for _ in range(fingerprint.LIKE)], 0
    for paragraph in (text or "").split("\n"):
        for i in range(fingerprint.EQUAL // 2):
            h = xxhash.xxh64_intdigest(paragraph.encode(), xxhash.xxh64_intdigest(struct.pack("<q", i), 42))
            for j, part in enumerate((h & 0xFFFFFFFF, h >> 32)):
                equal[2 * i + j] = (equal[2 * i + j] + part) % 2**32
        for piece in _pieces_by_hand(paragraph):
            n, h = n + 1, xxhash.xxh64_intdigest(piece.encode(), 42)
            for i in range(fingerprint.LIKE):
                for j in range(3):
                    lanes[i][j] += h >> (i + 21 * j) & 1
    return n, equal, lanes


def test_fingerprints_by_hand(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abnéöxyz.\u4e2d", k=rng.randint(1, 7)))
    texts = ["\n".join("  ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 30))) for _ in range(30)]
    texts = [None, "", "  \n\t", "x " * 100, " lead and trail \n", *texts, *(t[: len(t) // 2] + texts[0] for t in texts)]
    df = spark.createDataFrame(list(enumerate(zip(texts, texts[1:], strict=False))), "i int, t struct<a: string, b: string>")
    fa, fb = fingerprint.fingerprint(F.col("t.a")), fingerprint.fingerprint(F.col("t.b"))
    for r in df.select("t", fa.alias("fa"), fingerprint.likeness(fa, fb).alias("near")).collect():
        (n, equal, lanes), (m, other, lanes2) = _fingerprint_by_hand(r.t.a), _fingerprint_by_hand(r.t.b)
        assert r.fa[0] == n and r.fa[1 : 1 + len(equal)] == equal
        assert r.fa[1 + len(equal) :] == [sum(c << (21 * j) for j, c in enumerate(three)) for three in lanes]
        x, y = (np.array([2 * c - k for three in ls for c in three], dtype=float) for ls, k in ((lanes, n), (lanes2, m)))
        norm = (x * x + y * y).sum()
        want = 1 if (n, equal, lanes) == (m, other, lanes2) else min(1, max(0, 2 * (x * y).sum() / norm)) if norm else 0
        assert abs(r.near - want) < 1e-9


@pytest.mark.parametrize("at", [0, 1_000, 1_999])
def test_one_word_more_is_a_near_copy(spark, at):
    rng = random.Random(6)
    words = ["".join(rng.choices("abcdefghilmnoprstuv", k=6)) for _ in range(2_000)]
    df = spark.createDataFrame([(" ".join(words), " ".join([*words[:at], "inserted", *words[at:]]), " ".join(reversed(words)))], "a string, b string, c string")
    a, b, c = (fingerprint.fingerprint(F.col(x)) for x in "abc")
    row = df.select(fingerprint.likeness(a, b).alias("near"), fingerprint.likeness(a, c).alias("far")).first()
    assert row.near >= 0.95 and row.far < 0.6


@pytest.mark.parametrize("longest", [40, 64, 300])
def test_bins_are_full_or_a_power_of_two(longest):
    rng = random.Random(2)
    lengths = [rng.randint(1, longest) for _ in range(3_000)]
    bins, early = packing.HarmonicBins(64, spare_bins=4, waiting=8), []
    for doc, length in enumerate(lengths):
        early += bins.add(doc, length)
        assert len(bins.full) <= 2 * 64 + 8 and bins.spared <= 4 * 64
    late = list(bins.close())
    assert all(sum(size for _, _, size in s) == 64 for s in early)
    last = [sum(size for _, _, size in s) for s in late]
    assert sum(total < 64 for total in last) <= 6 and all(total & (total - 1) == 0 and total <= 64 for total in last)
    held = {}
    for doc, start, size in (piece for s in early + late for piece in s):
        held.setdefault(doc, []).append((start, size))
    for doc, length in enumerate(lengths):
        got = sorted(held[doc])
        assert [start for start, _ in got] == [sum(size for _, size in got[:i]) for i in range(len(got))]
        assert sum(size for _, size in got) == length
    # One sequence starts or goes on with at most one document that it doesn't end.
    assert all(sum(start + size < lengths[doc] for doc, start, size in s) <= 1 for s in early + late)


def test_documents_that_fit_stay_whole():
    """One document in ten is longer than a bin: its tokens fill the bins, and few others are cut."""
    rng = random.Random(3)
    lengths = [rng.randint(2_049, 9_000) if i % 10 == 0 else int(2_048 ** rng.random()) for i in range(2_000)]
    bins, pieces_ = packing.HarmonicBins(2_048), Counter()
    for doc, length in enumerate(lengths):
        for s in bins.add(doc, length):
            pieces_.update(d for d, _, _ in s)
    for s in bins.close():
        pieces_.update(d for d, _, _ in s)
    fit = [doc for doc, length in enumerate(lengths) if length <= 2_048]
    assert sum(pieces_[doc] > 1 for doc in fit) < 0.01 * len(fit)


def test_a_bin_without_spares_takes_the_class_of_its_documents():
    bins = packing.HarmonicBins(60)
    assert [s for i in range(6) for s in bins.add(i, 20)] == [[(0, 0, 20), (1, 0, 20), (2, 0, 20)], [(3, 0, 20), (4, 0, 20), (5, 0, 20)]]
    with pytest.raises(ValueError, match="positive"):
        packing.HarmonicBins(0)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    want = sorted(([*plain.encode(t or "", add_special_tokens=False).ids, 1] for _, t in ROWS), key=str)
    rows = packing.pack_documents(docs.repartition(3), path, 1).toPandas()
    whole = []
    for _, doc in rows.fillna({"doc_id": -1}).groupby("doc_id"):
        doc = doc.sort_values("start")
        copies = doc.groupby("start").size().iloc[0]
        ids = [np.frombuffer(b, "<u4").tolist() for b in doc.drop_duplicates("start").ids]
        assert (doc.doc_tokens == sum(map(len, ids))).all() and [len(i) for i in ids] == doc.drop_duplicates("start").length.tolist()
        whole += [sum(ids, [])] * copies
    assert sorted(whole, key=str) == want
    for _, sequence in rows.groupby("sequence_id"):
        sequence = sequence.sort_values("offset")
        assert (sequence.offset == sequence.length.cumsum() - sequence.length).all()
        total = int(sequence.length.sum())
        assert total <= 2048 and total & (total - 1) == 0
    assert packing.pack_documents(empty, path, 1).count() == 0


@pytest.mark.parametrize("name, dropped", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_words_apart_encode_as_the_whole(name, dropped):
    encoder = WordEncoder(public_tokenizers.path(name), dropped)
    rng = random.Random(3)
    marks = ["a", "Bc", " ", "  ", "\n", "\t", "'s", "don't", "12", ".", "é", "́", "\x1c", "　", "<|endoftext|>", "日本", "ß", "İ", "\r\n", "!?"]
    texts = ["", " ", "\n", *("".join(rng.choices(marks, k=rng.randint(1, 30))) for _ in range(3_000))]
    assert encoder.encode(texts) == encoder.whole(texts)
    encoder.cache.most = 50
    assert encoder.encode(texts) == encoder.whole(texts)


@pytest.mark.parametrize("name, dropped", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_a_nul_starts_no_text(name, dropped):
    encoder = WordEncoder(public_tokenizers.path(name), dropped)
    rng = random.Random(4)
    marks = ["a", "Bc", " ", "  ", "\n", "'s", "12", ".", "é", "\0", " \0", "\0\0", "!?"]
    texts = ["a \0b", "\0b", " \0", "a\0 b", *("".join(rng.choices(marks, k=rng.randint(1, 20))) for _ in range(1_000))]
    assert encoder.encode(texts) == encoder.whole(texts)
    if not dropped:
        assert np.frombuffer(encoder.encode(["a \0b"])[0], "<u4").tolist() == [64, 220, 188, 65]


def test_unknown_words_share_their_lines_and_letters():
    """Words that a line break holds together are known apart, and words of Latin letters are cut by no pattern."""
    encoder, cut = WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), False), []
    encoder.pieces, pieces = lambda text: cut.append(text) or pieces(text), encoder.pieces
    texts = ["Été it.\nThis äöung ciónÑa,\nÜber", "\nit a\n\nb \nc d\n", "a\u0085\nb\n\u00a0c x\u00aa\n\u00b2y", "\n".join(["ab."] * 5_000)]
    assert encoder.encode(texts) == encoder.whole(texts)
    assert {"it.", "\0This", "äöung", "\0Über"} <= encoder.cache.keys()
    assert not [text for text in cut if text.strip(" ").isalpha() or "This" in text]


def test_words_of_many_texts_are_looked_up_once():
    """A line break between words joins no unknown word, and texts that are encoded together share their look-ups."""
    encoder, asked = WordEncoder(public_tokenizers.path("byte_bpe_50k.json"), False), []
    find = encoder.cache.values_of
    encoder.cache.values_of = lambda words: asked.extend(words) or find(words)
    texts = [f"the w{i}.\nThe w{j}\nthe" for i in range(30) for j in range(30)]
    assert encoder.encode(texts) == encoder.whole(texts)
    assert len(asked) == len(set(asked)) < 100 and [word for word in encoder.cache if "\n" in word] == ["\0\n"]
    for some in ([], [""], ["", "\n", "a\n", "\na", "a\n\nb", "a \nb", "a\n b", "a\r\nb", "a\u2028\nb"], ["日本\n\u0301a\n.b's\n12"]):
        assert encoder.encode(some) == encoder.whole(some)


def test_large_slices(monkeypatch):
    monkeypatch.setattr("beaconry.llm.words.BYTES_AT_ONCE", 4)
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(8)), "text": ["ab", "é", "c", None, "long text", None, "", "abcd"]})
    assert [s.column("doc_id").to_pylist() for s in large_slices([batch, batch.slice(0, 0)])] == [[0, 1], [2, 3], [4], [5, 6, 7]]


def test_planes_are_parted_by_stretches(monkeypatch):
    values = np.random.default_rng(5).integers(0, 1 << 9, 3_001).astype(np.uint16)
    want = [np.packbits(values[np.argsort([int(f"{v:09b}"[:level][::-1] or "0", 2) for v in values], kind="stable")] >> 8 - level & 1) for level in range(9)]
    for stretch in (64, 1 << 16):
        monkeypatch.setattr(tokenfile, "STRETCH", stretch)
        matrix = tokenfile.WaveletMatrix.build(values, 9)
        assert all((plane == w).all() for plane, w in zip(matrix.planes, want, strict=True))
        assert (matrix.decode() == values).all() and len(tokenfile.WaveletMatrix.build(values[:0], 9).decode()) == 0


def test_token_files(spark, docs, empty, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    plain = WordEncoder(path, False)
    manifest = tokenfile.write_token_files(docs, path, 2, folder=str(tmp_path / "tokens"), shard_tokens=1_000)
    files = manifest.orderBy("start").collect()
    assert len(files) > 2 and [f.start for f in files] == list(np.cumsum([0, *[f.n_tokens for f in files]])[:-1])
    rows = tokenfile.read_token_files(manifest).orderBy("start").collect()
    known = dict(ROWS)
    assert [r.doc_id for r in rows] == sorted([d for d, _ in ROWS], key=lambda d: (d is not None, d or 0))
    start = 0
    for r in rows:
        ids = plain.whole([known[r.doc_id] or ""])[0] + (2).to_bytes(4, "little")
        assert bytes(r.ids) == ids and r.start == start and r.n_tokens == len(ids) // 4
        start += r.n_tokens
    shard = tokenfile.open_shard(files[-1].folder, files[-1].file)
    assert shard.decode().tolist()[-1] == 2
    assert tokenfile.read_token_files(tokenfile.write_token_files(empty, path, 2, folder=str(tmp_path / "none"))).count() == 0


def test_wavelet_matrix():
    rng = np.random.default_rng(4)
    for n, bits in ((1, 3), (512, 4), (3_000, 7), (5_123, 16)):
        values = rng.integers(0, 1 << bits, n).astype(np.uint16)
        matrix = tokenfile.WaveletMatrix.build(values, bits)
        assert (matrix.decode() == values).all()
        for i in rng.integers(0, n, 50):
            token, k = int(values[i]), int((values[:i] == values[i]).sum())
            assert matrix.access(int(i)) == token and matrix.select(token, k) == i
            assert matrix.count(token, 0, int(i)) == k and matrix.count(token) == (values == token).sum()
        assert list(matrix.occurrences(int(values[0]))) == np.flatnonzero(values == values[0]).tolist()
        assert matrix.count(1 << bits) == 0
        with pytest.raises(IndexError):
            matrix.select(int(values[0]), n)


def test_pieces(docs, empty):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode_pieces(docs, path).collect()
    assert all(r.parity for r in rows) and len(rows) == len(ROWS)
    assert all(r.decoded == (dict(ROWS)[r.doc_id] or "") for r in rows)
    assert pieces.encode_pieces(empty, path, verify=False).count() == 0


# Line breaks at spaces and ends, markers, doubled spaces, white space beyond ASCII, and characters of one to four bytes.
ODD_PIECES = [
    "a\n b", "a \nb", "\n", "\na b\n", "  a", "a  b", " a ", " ", "a\tb \x1c c", "a\u3000b", "a▁b", "a▁ b", "▁", "▁a ▁▁b", "日本語 日本\n語",
    "naïve ☃☃ 🙂🙂\n🙂", "<0x41> <s> <unk>", "\0 a\0", "ab\r\ncd", "Ünïcode ²½", "x" * 300, "",
]


def test_pieces_of_odd_texts(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = [*enumerate(ODD_PIECES), (None, None), (7, " ".join(ODD_PIECES))]
    coded = pieces.encode_pieces(spark.createDataFrame(rows, "doc_id long, text string"), path).collect()
    # A marker in a text can't be told from a space.
    assert Counter((r.doc_id, r.decoded) for r in coded) == Counter((d, (t or "").replace("▁", " ")) for d, t in rows)
    assert all(r.parity for r in coded)


def test_pieces_like_the_library():
    codec = pieces.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(3)
    texts = ["".join(rng.choices(["a", "the", " ", " ", "\n", ".", "é", "日", "🙂", "\t", "▁", "Word"], k=rng.randint(0, 30))) for _ in range(2_000)]
    whole = [e.ids for e in codec.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)] == whole
    # Any ids: cut characters, control pieces, markers alone.
    some = [*range(300), *rng.sample(range(300, 32_000), 200)]
    lists = [*whole, [], *(rng.choices(some, k=rng.randint(0, 12)) for _ in range(2_000)), []]
    lists += [[*rng.choices([*range(3, 259)], k=rng.randint(0, 3)), *rng.choice(whole)] for _ in range(1_000)]
    assert codec.decode([pieces.ids_bytes(x) for x in lists]) == codec.tokenizer.decode_batch(lists, skip_special_tokens=False)
    assert codec.decode([]) == codec.encode([]) == []


def test_pieces_decode_each_piece_once(monkeypatch):
    """The library decodes pieces and runs of bytes, not every word of a text."""
    calls = Counter()

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            calls[name] += 1
            return getattr(self.inner, name)

    rebuild = pieces.rebuild
    monkeypatch.setattr(pieces, "rebuild", lambda model: Counted(rebuild(model)))
    codec = pieces.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    texts = [" ".join(f"w{i}x\ny{i}" for i in range(at, at + 100)) for at in range(0, 1_000, 100)]
    ids = codec.encode(texts)
    calls.clear()
    assert codec.decode(ids) == texts
    assert calls["decode"] + calls["decode_batch"] == 1


def test_unigram_model():
    """A hand-made unigram model with byte fallback: known best segmentation, and bytes for what it lacks."""
    def number(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def message(*items):
        out = b""
        for key, value in items:
            if isinstance(value, float):
                out += number(key << 3 | 5) + np.float32(value).tobytes()
            elif isinstance(value, int):
                out += number(key << 3) + number(value)
            else:
                out += number(key << 3 | 2) + number(len(value)) + value
        return out

    plain = [("<unk>", 0.0, 2), *[(f"<0x{i:02X}>", 0.0, 6) for i in range(256)], ("▁", -3.0, 1), ("a", -4.0, 1), ("b", -4.0, 1), ("ab", -2.0, 1), ("▁ab", -2.5, 1)]
    data = b"".join(number(1 << 3 | 2) + number(len(m)) + m for m in (message((1, p.encode()), (2, s), (3, t)) for p, s, t in plain))
    data += message((2, message((3, 1), (35, 1))), (3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))
    model = pieces.PieceModel.parse(data)
    assert model.kind == pieces.UNIGRAM and model.byte_fallback and len(model.pieces) == len(plain)
    names = [plain[i][0] for i in pieces.rebuild(model).encode("abab é").ids]
    assert names == ["▁ab", "ab", "▁", "<0xC3>", "<0xA9>"]


def test_quality(spark, empty):
    rng = random.Random(5)
    prose = lambda: " ".join(rng.choices("the river runs past a quiet town where people walk slowly".split(), k=rng.randint(20, 200)))
    noise = lambda: " ".join("".join(rng.choices("#$%&*!", k=4)) for _ in range(rng.randint(20, 200)))
    rows = [(i, (noise if i % 4 == 0 else prose)(), 0 if i % 4 == 0 else 1) for i in range(400)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, None, "x"), (900, "", "x"), (7, rows[7][1], "x")], "doc_id long, text string, quality_score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(None, 1), (5, None), (6, 0), (7, 3)], "doc_id long, quality int")
    model = quality.fit(docs, labels.where(~quality.held_out(F.col("doc_id"))))
    got = quality.score(docs, model).toPandas()
    assert len(got) == 403 and got.quality_score.between(0, 1).all() and got.columns.tolist() == ["doc_id", "text", "quality_score"]
    scores = dict(zip(got.doc_id, got.quality_score, strict=True))
    held = [(scores[i], q) for i, _, q in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s >= 0.3) == q for s, q in held]) > 0.97
    assert quality.score(empty, model).count() == 0
    none = quality.fit(docs, labels.where(F.lit(False)))
    assert quality.score(docs, none).toPandas().quality_score.round(6).nunique() == 1


def _shards_by_hand(rows, limit):
    """Split a bucket on its next bit while it is too large and holds several rows."""
    out, queue = {}, [("", [(f"{int(hashlib.md5(('' if d is None else str(d)).encode()).hexdigest()[:15], 16):060b}", d, len((t or "").encode())) for d, t in rows])]
    while queue:
        prefix, members = queue.pop()
        if sum(m[2] for m in members) <= limit or len(members) == 1:
            out.update({m[1]: prefix for m in members})
        else:
            queue += [(prefix + b, part) for b in "01" if (part := [m for m in members if m[0][len(prefix)] == b])]
    return out


def test_shards(spark, empty):
    rows = [(i, "x" * (i * 37 % 900)) for i in range(2_000)] + [(5_000, "y" * 20_000), (5_001, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_documents(docs, 10_000).toPandas()
    assert dict(zip(got.doc_id, got.shard, strict=True)) == _shards_by_hand(rows, 10_000)
    assert (got.groupby("shard").n_bytes.sum() == got.groupby("shard").shard_bytes.first()).all()
    assert (got.groupby("shard").size() == got.groupby("shard").shard_rows.first()).all()
    assert ((got.shard_bytes <= 10_000) | (got.shard_rows == 1)).all()
    assert sharding.shard_documents(empty, 10_000).count() == 0


def test_written_shards(spark, docs, empty, tmp_path):
    """Nulls, repeated ids and clashing columns; every shard is one file that holds what the directory says."""
    path = sharding.write_shards(sharding.shard_documents(docs, 100), str(tmp_path / "shards"))
    got = sharding.read_shards(spark, path).toPandas()
    assert set(docs.columns) | {"shard_depth", "n_bytes", "shard_bytes", "shard_rows"} == set(got.columns)
    assert Counter(got.text.where(got.text.notna(), None)) == Counter(t for _, t in ROWS)
    want = sharding.shard_documents(docs, 100).toPandas()
    for c in ("shard", "shard_depth", "shard_bytes", "shard_rows"):
        assert sorted(got[c]) == sorted(want[c])
    folders = [f for f in (tmp_path / "shards").iterdir() if f.is_dir() and f.name != "_schema"]
    assert len(folders) == got.shard.nunique() > 5 and all(len(list(f.glob("*.parquet"))) == 1 for f in folders)
    one = sharding.read_shards(spark, path, ["doc_id"]).where(F.col("shard") == got.shard[0])
    assert one.columns == ["doc_id", "shard", "shard_depth", "n_bytes", "shard_bytes", "shard_rows"]
    assert one.count() == got.shard_rows[0]
    none = sharding.read_shards(spark, sharding.write_shards(sharding.shard_documents(empty, 100), str(tmp_path / "none")))
    assert none.count() == 0 and set(none.columns) == set(got.columns)
    whole = sharding.write_shards(sharding.shard_documents(docs, 10**9), str(tmp_path / "whole"))
    assert set(sharding.read_shards(spark, whole).toPandas().shard) == {""}


def test_many_shards_by_sql(spark):
    folder = "/root/testdata/sf0.01"
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.execute(shards_sql(64 << 10)).df()
    table = spark.read.parquet(f"{folder}/documents.parquet")
    got = sharding.read_shards(spark, sharding.write_shards(sharding.shard_documents(table, 64 << 10)), ["doc_id"]).toPandas()
    assert got.shard.nunique() >= 50
    assert sorted(got[want.columns.tolist()].itertuples(index=False, name=None)) == sorted(want.itertuples(index=False, name=None))


def test_equal_rows_are_numbered_without_gaps(spark):
    rows = spark.range(1_000).repartition(7).selectExpr("id % 2 as h", "'same' as twin")
    got = sharding._numbered(rows).toPandas()
    assert [sorted(g.n) for _, g in got.groupby("h")] == [list(range(1, 501))] * 2


def test_hot_keys_split_to_the_limit(spark):
    """One key with a third of the rows, most of them equal rows: second hash, then chained shards."""
    rows = [(i, "a" * 100, f"k{i}") for i in range(600)] + [(1, f"text {i} " + "b" * 90, "hot") for i in range(150)] + [(2, "c" * 99, "hot")] * 150
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sharding.shard_documents(docs, 2_000, key="source").toPandas()
    assert len(got) == 900 and got.columns[:3].tolist() == ["doc_id", "text", "source"]
    assert sorted(got.text) == sorted(r[1] for r in rows)
    assert (got.groupby("shard").n_bytes.sum() <= 2_000).all() and got.shard.str.contains("+", regex=False).any()
    assert (got.groupby("shard").n_bytes.sum() == got.groupby("shard").shard_bytes.first()).all()


def test_shingles():
    sets = shingle_sets(["A b, c d E f", "a B c d e f", "a b", "", None, "...", "a b c d e f a b c d e f"])
    assert len(sets[0]) == 2 and (sets[0] == sets[1]).all() and len(sets[2]) == 1 and not sum(map(len, sets[3:6]))
    assert len(sets[6]) == 6 and set(sets[0]) <= set(sets[6])
    assert isinstance(pd.Series(sets[0]).iloc[0], np.uint64)


def test_many_lines_of_one_text(spark):
    """A text of 100,000 lines, half of them lost, takes a moment: it is split once."""
    lines = [f"a line of its own {i}" for i in range(100_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines[::2])), (2, "\n".join(lines))], "doc_id long, text string")
    start = time.time()
    kept = {r.doc_id: r.text for r in linededup.dedup_lines(docs, batches=2).collect()}
    assert kept == {1: "\n".join(lines[::2]), 2: "\n".join(lines[1::2])} and time.time() - start < 60


def test_ids_that_do_not_fit_are_refused():
    ids = np.array([1, 70_000], dtype="<u4").tobytes()
    with pytest.raises(ValueError, match="70000"):
        tokenfile.dump_shard([1], [2], ids, 16)
    docs, lengths, matrix = tokenfile.load_shard(b"".join(tokenfile.dump_shard([1], [2], ids, 17)))
    assert docs == [1] and list(lengths) == [2] and matrix.n == 2
