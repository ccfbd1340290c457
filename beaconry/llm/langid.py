"""Language identification: each document is a mixture of languages, whose shares expectation-maximisation estimates.

A model holds, for each language, the log likelihood of letter n-grams inside words. A word's likelihood under a
language is that of its n-grams; a document's words come from its languages in unknown shares, and which languages
it has at all is chosen by likelihood less a penalty for each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from beaconry.llm.words import WordCache, text_slices
from beaconry.operators.skew import newest

# Letters taken at once: a longer run, as of a language without spaces, is cut.
RUN = 24
# Lengths of n-grams.
ORDERS = (1, 2, 3)
NOTHING = "und"
# Bytes of a worker's cache of words.
CACHE_BYTES = 96 << 20
# Distinct words of documents that are worked on together.
WORDS_AT_ONCE = 200_000
ROUNDS, STILL = 40, 1e-3

# Runs of letters; the character class also lets digits of other kinds pass, which `str.isalpha` then leaves out.
_runs = re.compile(rf"[^\W\d_]{{1,{RUN}}}").findall


def held_out(doc_id: Column) -> Column:
    """The rows that are never learnt from: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def words_of(text: str | None) -> Counter:
    """Runs of at most RUN letters of the whole text, lower-cased, and how often each occurs."""
    return Counter(w for w in _runs((text or "").lower()) if w.isalpha())


def grams(word: str) -> list[str]:
    """The letters of a word, and its pairs and triples of letters between marks of its start and end."""
    marked = f" {word} "
    return [*word, *map("".join, zip(marked, marked[1:])), *map("".join, zip(marked, marked[1:], marked[2:]))]


@dataclass
class LanguageModel:
    """Languages, most frequent first, and the log likelihoods of n-grams under each."""

    languages: list[str]
    place: dict[str, int]
    # A row for each n-gram; the last is for those nobody knows.
    logs: np.ndarray

    def word(self, word: str) -> bytes:
        """Log likelihood of a word under each language, as float32."""
        unseen, find = len(self.place), self.place.get
        return self.logs[[find(gram, unseen) for gram in grams(word)]].sum(axis=0).astype("<f4").tobytes()


def learn(texts: dict[str, list[str]], order: list[str], most_grams: int = 100_000, smooth: float = 0.5) -> LanguageModel:
    """Additively smoothed n-gram likelihoods from the texts of each language, in the given order of languages.

    Of each order of n-grams the ``most_grams`` most frequent of all languages together are kept.
    """
    place: dict[str, int] = {}
    logs, unseen = [], 0.0
    counts = []
    for name in order:
        words: Counter = Counter()
        for text in texts[name]:
            words.update(words_of(text))
        found: Counter = Counter()
        for word, times in words.items():
            for gram in grams(word):
                found[gram] += times
        counts.append(found)
    for n in ORDERS:
        every: Counter = Counter()
        for found in counts:
            every.update({g: c for g, c in found.items() if len(g) == n})
        known = [g for g, _ in sorted(every.items(), key=lambda x: (-x[1], x[0]))[:most_grams]]
        table = np.array([[found[g] for found in counts] for g in known], dtype=float).reshape(len(known), len(order))
        sums = table.sum(axis=0) + smooth * (len(known) + 1)
        place |= {gram: at for at, gram in enumerate(known, len(place))}
        logs.append(np.log((table + smooth) / sums))
        # One value for grams nobody knows: they tell nothing of the language.
        unseen = min(unseen, float(np.log(smooth / sums.max(initial=1))))
    return LanguageModel(order, place, np.concatenate([*logs, np.full((1, len(order)), unseen)]))


def fit(docs: DataFrame, sample: int = 1000, longest: int = 4096, languages: int = 200) -> LanguageModel:
    """Learn from a bounded sample of documents with a language (text, lang, doc_id).

    For each of the ``languages`` most frequent values of lang (ties: the smallest), ``sample`` different documents
    at most, those with the smallest hash of id and text, and of each the first ``longest`` code points: their product
    bounds what comes to the driver. Null languages, null ids and empty texts are not learnt from.
    """
    text = F.coalesce("text", F.lit(""))
    known = docs.where(F.col("lang").isNotNull() & (text != "")).select(F.col("lang").cast("string").alias("lang"), text.alias("text"), F.xxhash64("doc_id", "text").alias("h"))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    order = [r.lang for r in counts.collect()]
    # A few thousand rows of hashes: the one table here that is broadcast.
    picked = newest(known.select("lang", "h").where(F.col("lang").isin(order)).distinct(), ["lang"], ["h"], sample) if order else None
    texts: dict[str, list[str]] = {name: [] for name in order}
    if picked is not None:
        rows = known.join(F.broadcast(picked), ["lang", "h"]).groupBy("lang", "h").agg(F.first(F.substring("text", 1, longest)).alias("text"))
        for row in sorted(rows.collect(), key=lambda r: (r.lang, r.h)):
            texts[row.lang].append(row.text)
    return learn(texts, order)


def _shares(likely: np.ndarray, times: np.ndarray, starts: np.ndarray, doc: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation of each document's shares over its allowed languages; shares and log likelihoods."""
    shares = allowed / allowed.sum(axis=1, keepdims=True)
    totals = np.add.reduceat(times, starts)
    for _ in range(ROUNDS):
        joint = likely * shares[doc]
        joint *= (times / joint.sum(axis=1))[:, None]
        new = np.add.reduceat(joint, starts, axis=0) / totals[:, None]
        moved = np.abs(new - shares).max()
        shares = new
        if moved < STILL:
            break
    told = np.add.reduceat(times * np.log(np.maximum((likely * shares[doc]).sum(axis=1), 1e-300)), starts)
    return shares, told


def mixtures(likely: np.ndarray, times: np.ndarray, starts: np.ndarray, penalty: float) -> np.ndarray:
    """Shares of the languages of each document, whose words' likelihoods follow each other from ``starts`` on.

    All languages are allowed at first. Those whose share is less than half a word's go; then the smallest goes as
    long as the log likelihood loses less than ``penalty`` times the logarithm of the number of words.
    """
    doc = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(times))))
    totals = np.add.reduceat(times, starts)
    every = np.arange(len(starts))

    def estimated(docs: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inside = np.isin(doc, docs)
        place = np.searchsorted(docs, doc[inside])
        return _shares(likely[inside], times[inside], np.searchsorted(place, np.arange(len(docs))), place, allowed)

    shares, told = estimated(every, np.ones((len(starts), likely.shape[1])))
    small = shares * totals[:, None] < 0.5
    small[every, shares.argmax(axis=1)] = False
    allowed = np.where(small, 0.0, 1.0)
    several = allowed.sum(axis=1) > 1
    shares[~several] = allowed[~several]
    open_ = np.flatnonzero(several)
    if len(open_):
        shares[open_], told[open_] = estimated(open_, allowed[open_])
    while len(open_):
        fewer = allowed[open_]
        smallest = np.where(fewer > 0, shares[open_], 2.0)
        # Of equal shares the rarer language goes.
        last = fewer.shape[1] - 1 - smallest[:, ::-1].argmin(axis=1)
        fewer[np.arange(len(open_)), last] = 0
        some, less = estimated(open_, fewer)
        better = told[open_] - less <= penalty * np.log(totals[open_] + 1)
        won = open_[better]
        allowed[won], shares[won], told[won] = fewer[better], some[better], less[better]
        open_ = won[allowed[won].sum(axis=1) > 1]
    return shares


def predict(docs: DataFrame, model: LanguageModel, penalty: float = 1.0) -> DataFrame:
    """The columns of ``docs``, lang_pred and lang_score (its share, 0 to 1) of each whole text, and lang_shares, the
    languages that its mixture keeps.

    A text that is null or has no letter is ``und`` with score 0, as is every text for a model without languages. Of
    equal shares the language that was more frequent in the sample wins. Columns of these names are replaced; nothing but the text is looked at.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "lang_score", "lang_shares")]
    slim = docs.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*slim.schema.fields, *T.StructType.fromDDL("lang_pred string, lang_score double, lang_shares map<string,double>").fields])
    size = len(model.languages)
    shares_type = pa.map_(pa.string(), pa.float64())

    def judged(cache: WordCache, texts: list[str | None]) -> tuple[list[str], list[float], list[list]]:
        pred, score, mixed = [NOTHING] * len(texts), [0.0] * len(texts), [[] for _ in texts]
        held: list[tuple[int, Counter]] = []

        def settle() -> None:
            blob = cache.joined([w for _, words in held for w in words])
            likely = np.frombuffer(blob, dtype="<f4").reshape(-1, size).astype(float)
            likely = np.exp(likely - likely.max(axis=1, keepdims=True)) + 1e-30
            times = np.array([n for _, words in held for n in words.values()], dtype=float)
            starts = np.cumsum([0, *[len(words) for _, words in held[:-1]]])
            for (i, _), share in zip(held, mixtures(likely, times, starts, penalty), strict=True):
                top = int(share.argmax())
                pred[i], score[i] = model.languages[top], float(min(share[top], 1.0))
                mixed[i] = [(model.languages[j], float(share[j])) for j in np.flatnonzero(share > 0)]
            held.clear()

        if size:
            waiting = 0
            for i, text in enumerate(texts):
                if words := words_of(text):
                    held.append((i, words))
                    waiting += len(words)
                if waiting >= WORDS_AT_ONCE:
                    settle()
                    waiting = 0
            if held:
                settle()
        return pred, score, mixed

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(model.word, model, most=max(1000, CACHE_BYTES // (4 * size + 150)))
        for batch in text_slices(batches):
            pred, score, mixed = judged(cache, batch.column(batch.schema.get_field_index("text")).to_pylist())
            made = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(mixed, shares_type)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "lang_pred", "lang_score", "lang_shares"])

    return slim.mapInArrow(run, schema)
