"""Word-wise work with a bounded cache: a natural text repeats its words, so each is worked out once per worker."""

from __future__ import annotations

import json
import re
import string
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash

# Words that one worker remembers, about 200 bytes each.
CACHE_WORDS = 1_000_000
# Fixed value: the pattern by which byte-level pre-tokenizers cut a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
FIRST = "\0"
LINE_BREAK = f" {FIRST}\n {FIRST}"
MARKS = string.punctuation
# Below this character all Unicode versions have the same letters.
LATIN_END = "\u0250"
# White space that few texts hold, and the sign of a first word.
RARE = [FIRST, *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]
# What a text that does not split safely holds besides: the sign of a first word, characters that count as white space
# for Python only, and white space before a space.
UNSAFE = [c if c in "\0\x1c\x1d\x1e\x1f" else f"{c} " for c in RARE]
# Texts that are handled at once; bounds the memory of a worker beside its Arrow batch.
TEXTS_AT_ONCE = 512
# Bytes of texts whose words are looked up together: the more, the fewer look-ups for each word.
BYTES_AT_ONCE = 8 << 20


def text_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most TEXTS_AT_ONCE rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, TEXTS_AT_ONCE):
            yield batch.slice(start, TEXTS_AT_ONCE)


def large_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most BYTES_AT_ONCE bytes of text; a longer text stands alone."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + BYTES_AT_ONCE, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


class WordCache(dict):
    """Values of words; ``work`` gives that of an unknown one. Restarts when it is full.

    A worker outlives its tasks, so caches of an earlier stage are emptied when those of another ``owner`` are used.
    """

    made: list[WordCache] = []
    owner_at_work: object = None

    def __init__(self, work: Callable, owner: object, joint: bytes | str = b"", most: int = CACHE_WORDS):
        super().__init__()
        self.work, self.owner, self.joint, self.most = work, owner, joint, most
        WordCache.made.append(self)

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.work(word)
        return value

    def joined(self, words: list):
        """The values of words one after the other, with ``joint`` between them."""
        return self.joint.join(self.values_of(words))

    def values_of(self, words: list) -> list:
        if WordCache.owner_at_work is not self.owner:
            WordCache.owner_at_work = self.owner
            for cache in WordCache.made:
                if cache.owner is not self.owner:
                    cache.clear()
        return list(map(self.__getitem__, words))

    def joined_each(self, texts: Iterable[str]) -> list[bytes]:
        """For each text the joined values of its words between single spaces, from one look-up for each distinct word."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        words = split.values.dictionary_encode()
        known = self.values_of(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        values = pa.array(known, pa.large_binary()).take(words.indices)
        _, starts, held = values.buffers()
        # Where the words of each text start among the values, and the end of the last.
        places = np.frombuffer(starts, "<i8", len(values) + 1)[split.offsets.to_numpy()].tolist() if len(split) else []
        held = held or pa.py_buffer(b"")
        return [held[start:end].to_pybytes() for start, end in pairwise(places)]


def ids_bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.array(ids, dtype="<u4").tobytes()


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in shown else next(rest)) for b in range(256)]


def rare(text: str) -> bool:
    return any(map(text.__contains__, RARE))


def unsafe(text: str) -> bool:
    return "  " in text or "\n " in text or rare(text) and any(map(text.__contains__, UNSAFE))


class WordEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit integers, equal to the library's own.

    Words can be encoded apart where the pre-tokenizer always splits before a space, or drops white space
    (``dropped_space``). An unknown word is cut by the pre-tokenizer's pattern, and the library's model encodes each
    piece. A text in which white space meets a space, or that holds a character which Python and the library class
    differently as white space or the sign of a first word, goes through the library as a whole.
    """

    def __init__(self, path: str, dropped_space: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, self.normalizer, self.letters = self.tokenizer.model, self.tokenizer.normalizer, byte_letters()
        self.dropped_space = dropped_space
        self.odd = re.compile(r"[\x1c-\x1f]").search if dropped_space else unsafe
        with open(path) as file:
            steps = json.load(file)["pre_tokenizer"]
        own = [s["pattern"]["Regex"] for s in steps.get("pretokenizers", []) if s["type"] == "Split"]
        self.cut = regex.compile(own[0] if own else BYTE_LEVEL).findall
        # Under the byte-level pattern plain letters, and the space before them, are always one piece.
        self.one_piece = not own and not dropped_space
        self.marked = regex.compile(r"(\p{L}+)([^\s\p{L}\p{N}]+)").fullmatch
        self.cache = WordCache(self.word, self)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [ids_bytes(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word(self, word: str) -> bytes:
        """The ids of a word. Letters and the marks behind them are pieces of their own, which many words share."""
        if self.dropped_space:
            if not word.isascii():
                return self.pieces(self.normalizer.normalize_str(word))
            if word != (low := word.lower()):
                return self.cache[low]
            if (parts := self.marked(word)) and parts[1]:
                return self.cache[parts[1]] + self.cache[parts[2]]
            return self.pieces(word)
        if self.one_piece and (word.isascii() or max(word) < LATIN_END):
            if word.isalpha():
                return self.letters_of(" " + word)
            if word[:1] == FIRST and word[1:].isalpha():
                return self.letters_of(word[1:])
            # As in `lined`, in texts with other line breaks too.
            if "\n" in word:
                lines = word.split("\n")
                if all(line and not line[0].isspace() and not line[-1].isspace() for line in lines):
                    return self.cache[FIRST + "\n"].join([self.cache[lines[0]], *[self.cache[FIRST + line] for line in lines[1:]]])
            head = word.rstrip(MARKS)
            if head != word and head.removeprefix(FIRST).isalpha():
                return self.cache[head] + self.cache[FIRST + word[len(head) :]]
        # A word takes the space before it along; the first of a text has a sign instead.
        if word[:1] == FIRST:
            return self.pieces(word[1:])
        if (parts := self.marked(word)) and parts[1]:
            return self.cache[parts[1]] + self.cache[FIRST + parts[2]]
        return self.pieces(" " + word)

    def letters_of(self, word: str) -> bytes:
        """The ids of a piece of letters, which may have a space before it. Its bytes become letters of the vocabulary."""
        if word.isascii():
            shown = word.replace(" ", self.letters[32])
        else:
            shown = "".join([self.letters[b] for b in word.encode()])
        return ids_bytes([t.id for t in self.model.tokenize(shown)])

    def pieces(self, text: str) -> bytes:
        letters, ids = self.letters, []
        for piece in self.cut(text):
            if not (piece.isascii() and piece.isalpha()):
                piece = "".join([letters[b] for b in piece.encode("utf-8", "replace")])
            ids += [t.id for t in self.model.tokenize(piece)]
        return ids_bytes(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        if self.dropped_space:
            return [self.whole([text])[0] if self.odd(text) else self.cache.joined(text.split()) for text in texts]
        odd = [bool(self.odd(text)) for text in texts]
        apart = iter(self.apart([text for text, whole in zip(texts, odd, strict=True) if not whole]))
        return [self.whole([text])[0] if whole else next(apart) for text, whole in zip(texts, odd, strict=True)]

    def apart(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that split safely."""
        return self.cache.joined_each(FIRST + self.lined(text) for text in texts)

    def lined(self, text: str) -> str:
        """A text whose line breaks are words, if all of them stand between characters that are no white space: there
        a break is a piece, and what follows has no space before it."""
        if not self.one_piece or "\n" not in text or "\n" in (text[0], text[-1]) or "\n\n" in text or " \n" in text or rare(text):
            return text
        return text.replace("\n", LINE_BREAK)


_encoders: dict[tuple[str, bool], WordEncoder] = {}


def word_encoder(path: str, dropped_space: bool) -> WordEncoder:
    """One encoder per Python worker, kept between tasks."""
    key = (path, dropped_space)
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, dropped_space)
    return _encoders[key]


_word = re.compile(r"\w+").findall


def _word_hashes(token: str) -> bytes:
    return b"".join([xxhash.xxh64_intdigest(w).to_bytes(8, "little") for w in _word(token.lower())])


_hashes = WordCache(_word_hashes, "shingles")
_ODD = [np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) & (1 << 64) - 1) for k in range(64)]


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], n: int = 5) -> list[np.ndarray]:
    """The sorted distinct 64-bit hashes of all runs of ``n`` words of each text.

    Words are runs of letters, digits and underscores, lower-cased. A text of fewer words is one shingle; one
    without words has none.
    """
    blobs = [_hashes.joined((text or "").split()) for text in texts]
    words = np.frombuffer(b"".join(blobs), dtype="<u8")
    # Every run of n words of the batch; those that cross from one text into the next are never looked at.
    runs = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
    for j in range(n):
        runs += words[j : j + len(runs)] * _ODD[j]
    runs = mixed(runs)
    sets, at = [], 0
    for blob in blobs:
        k = len(blob) // 8
        if k >= n:
            sets.append(np.unique(runs[at : at + k - n + 1]))
        else:
            few = words[at : at + k]
            sets.append(mixed(np.array([(few * np.array(_ODD[n : n + k])).sum()], dtype=np.uint64)) if k else few)
        at += k
    return sets
