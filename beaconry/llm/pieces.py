"""SentencePiece models on the tokenizers library: parse the model file, rebuild it, encode, decode, verify parity."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from beaconry.llm.words import TEXTS_AT_ONCE, WordCache, ids_bytes, large_slices

# Fixed values of the model file: piece types, model types, the white-space marker.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"
# Texts that the library encodes as a whole at once.
WHOLE_AT_ONCE = 64
# Names of byte pieces: the decoder joins runs of them to characters.
BYTE_NAME = re.compile("<0x[0-9A-Fa-f]{2}>").fullmatch


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protobuf message; fixed-width and nested values as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = varint()
        wire = tag & 7
        if wire == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(wire) or varint()
        yield tag >> 3, data[at : at + size]
        at += size


@dataclass
class PieceModel:
    """What a model file says. Numbers in ``parse`` are the field numbers of its public schema."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True
    suffix: bool = False

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        model = cls()
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(fields(value))
                model.kind, model.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
                model.suffix = bool(trainer.get(24, 0))
            elif number == 3:
                norm = dict(fields(value))
                model.charsmap, model.dummy_prefix = norm.get(2, b""), bool(norm.get(3, 1))
                model.trim, model.escape = bool(norm.get(4, 1)), bool(norm.get(5, 1))
        return model

    def apart(self) -> bool:
        """May words be encoded apart? Only if no piece goes on after the marker of a next word."""
        plain = all(MARK not in p.lstrip(MARK) for p, _, t in self.pieces if t in (NORMAL, USER_DEFINED))
        return plain and self.dummy_prefix and self.escape and not self.suffix


def merge_rules(model: PieceModel) -> list[tuple[str, str]]:
    """Merges of a BPE model: each way to put a piece together of two others, best score first."""
    known = {p: i for i, (p, _, t) in enumerate(model.pieces) if t in (NORMAL, USER_DEFINED)}
    rules = []
    for piece, score, kind in model.pieces:
        if kind == NORMAL:
            halves = [(piece[:i], piece[i:]) for i in range(1, len(piece))]
            rules += [(-score, known[a], known[b], a, b) for a, b in halves if a in known and b in known]
    return [(a, b) for *_, a, b in sorted(rules)]


def rebuild(model: PieceModel):
    """The same tokenizer on the tokenizers library."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = next((i for i, (_, _, t) in enumerate(model.pieces) if t == UNKNOWN), 0)
    if model.suffix or not model.escape:
        raise ValueError("models with suffix markers or unescaped white space are not supported")
    if model.kind == UNIGRAM:
        # Control and byte pieces must never win on their own.
        low = min(s for _, s, _ in model.pieces) - 1000.0
        scored = [(p, s if t in (NORMAL, USER_DEFINED, UNKNOWN) else low) for p, s, t in model.pieces]
        made = models.Unigram(scored, unknown, model.byte_fallback)
    elif model.kind == BPE:
        made = models.BPE(
            {p: i for i, (p, _, _) in enumerate(model.pieces)}, merge_rules(model),
            unk_token=model.pieces[unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError("only unigram and BPE models are supported")
    tokenizer = Tokenizer(made)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.trim:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
    if model.apart():
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    tokenizer.add_tokens([AddedToken(p, normalized=False) for p, _, t in model.pieces if t == USER_DEFINED])
    steps = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    tokenizer.decoder = decoders.Sequence([*steps, decoders.Strip(" ", 1, 0)] if model.dummy_prefix else steps)
    return tokenizer


class PieceCodec:
    """Encodes and decodes with the rebuilt tokenizer; ``threads`` is read when the library first runs a batch."""

    def __init__(self, path: str, threads: int = 1):
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        with open(path, "rb") as file:
            self.model = PieceModel.parse(file.read())
        self.tokenizer = rebuild(self.model)
        self.tokenize = self.tokenizer.model.tokenize
        self.apart = self.model.apart()
        self.changed = bool(self.model.charsmap) or self.model.trim
        self.spaced = re.compile(r"\s | \s|^\s|\s$").search
        self.cache = WordCache(self.word, self)
        # What each piece decodes to behind another; characters of byte pieces are decoded as they come.
        self.bytes = np.array([bool(BYTE_NAME(p)) for p, _, _ in self.model.pieces])
        self.going_on = np.array([bool(BYTE_NAME(p)) and int(p[3:5], 16) >> 6 == 2 for p, _, _ in self.model.pieces])
        self.anchor = int(np.argmin(self.bytes))
        self.head = len(self.text_of([[self.anchor]])[0])
        self.texts = pa.array(self.texts_behind([[i] for i in range(len(self.bytes))]), pa.large_string())

    def whole(self, texts: list[str]) -> list[bytes]:
        # The library holds far more than the ids of a batch.
        batches = (texts[at : at + WHOLE_AT_ONCE] for at in range(0, len(texts), WHOLE_AT_ONCE))
        return [ids_bytes(e.ids) for batch in batches for e in self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)]

    def word(self, word: str) -> bytes:
        """The ids of a word and the marker before it."""
        if self.changed:
            return self.whole([word])[0]
        return ids_bytes([t.id for t in self.tokenize(MARK + word)])

    def odd(self, text: str) -> bool:
        """Does a text not split safely? Other white space than spaces counts if the model changes texts."""
        if not text or MARK in text:
            return True
        return bool(self.spaced(text)) if self.changed else "  " in text or " " in (text[0], text[-1])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, little-endian unsigned 32-bit. Words apart where white space is single spaces."""
        if not self.apart:
            return self.whole(texts)
        odd = [self.odd(text) for text in texts]
        apart = iter(self.cache.joined_each([text for text, whole in zip(texts, odd, strict=True) if not whole]))
        rest = iter(self.whole([text for text, whole in zip(texts, odd, strict=True) if whole]))
        return [next(rest if whole else apart) for whole in odd]

    def text_of(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def texts_behind(self, ids: list[list[int]]) -> list[str]:
        """What ids decode to behind another piece, where no marker is dropped."""
        return [text[self.head :] for text in self.text_of([[self.anchor, *x] for x in ids])]

    def decode(self, ids: list[bytes]) -> list[str]:
        """Texts of whole id lists, put together of what their pieces and the characters of byte pieces decode to."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        edges = np.cumsum([0, *(len(x) // 4 for x in ids)])
        # A unit is a piece, or the byte pieces of one character.
        held, first = self.bytes[flat], np.ones(len(flat) + 1, dtype=bool)
        first[1:-1] = ~(self.going_on[flat[1:]] & held[:-1])
        first[edges] = True
        begins = np.flatnonzero(first[:-1])
        units, of_bytes = flat[begins].astype(np.int64), held[begins]
        starts = np.append(np.flatnonzero(first[:-1][held]), held.sum()).astype("<i8") * 4
        buffers = [None, pa.py_buffer(starts), pa.py_buffer(flat[held].tobytes())]
        chars = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, buffers).dictionary_encode()
        units[of_bytes] = len(self.texts) + chars.indices.to_numpy()
        known = self.texts_behind([np.frombuffer(char, "<u4").tolist() for char in chars.dictionary.to_pylist()])
        texts = pa.concat_arrays([self.texts, pa.array(known, pa.large_string())]).take(pa.array(units))
        _, starts, data = texts.buffers()
        places = np.frombuffer(starts, "<i8", len(texts) + 1)[np.searchsorted(begins, edges)] if len(texts) else edges * 0
        out = [str(data[start:end], "utf-8") if end > start else "" for start, end in pairwise(places.tolist())]
        out = [text.removeprefix(" ") for text in out] if self.model.dummy_prefix else out
        # Bytes that are no character spoil all byte pieces beside them, so such lists go through the library as a whole.
        broken = np.zeros(len(self.texts) + len(known), dtype=bool)
        broken[len(self.texts) :] = ["\ufffd" in text for text in known]
        for i in np.unique(np.searchsorted(edges, begins[broken[units]], side="right") - 1).tolist():
            out[i] = self.text_of([np.frombuffer(ids[i], "<u4").tolist()])[0]
        return out


_codecs: dict[tuple[str, int], PieceCodec] = {}


def piece_codec(path: str, threads: int = 1) -> PieceCodec:
    """One codec per Python worker, kept between tasks."""
    if (path, threads) not in _codecs:
        _codecs[path, threads] = PieceCodec(path, threads)
    return _codecs[path, threads]


def encode_pieces(docs: DataFrame, model_path: str, threads: int = 1, verify: bool = True) -> DataFrame:
    """Encode every whole text of ``docs`` (doc_id, text) and decode it again.

    Returns doc_id, ids (little-endian unsigned 32-bit), n_tokens, decoded, and parity: are the ids those of the
    sentencepiece library? (null if ``verify`` is off). Each task encodes its batches with ``threads`` threads; set
    it to the cores of a task.

    A null text is empty and has no ids. Rows of equal or null doc_id are encoded each; extra columns are ignored.
    """

    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        codec = piece_codec(model_path, threads)
        checker = SentencePieceProcessor(model_file=model_path) if verify else None
        for batch in large_slices(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            coded = codec.encode(texts)
            for start in range(0, len(texts), TEXTS_AT_ONCE):
                ids = coded[start : start + TEXTS_AT_ONCE]
                parity = [None] * len(ids)
                if checker:
                    given = checker.encode(texts[start : start + TEXTS_AT_ONCE], num_threads=threads, out_type="numpy")
                    parity = [x.astype("<u4", copy=False).tobytes() == y for x, y in zip(given, ids, strict=True)]
                columns = [batch.column("doc_id").slice(start, len(ids)), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
                columns += [pa.array(codec.decode(ids), pa.string()), pa.array(parity, pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "n_tokens", "decoded", "parity"])

    kinds = "doc_id long, ids binary, n_tokens long, decoded string, parity boolean"
    return docs.selectExpr("cast(doc_id as long) as doc_id", "text").mapInArrow(encoded, kinds)
