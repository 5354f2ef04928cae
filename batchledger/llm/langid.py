"""Language identification by rank-order profiles.

A profile ranks the most frequent one- to three-letter grams of a language, counted inside padded
words. A document's own most frequent grams are compared to every profile: the out-of-place
distance adds up how far each gram's rank is from its rank there, ``TOP`` where it has none. The
nearest profile wins, the first by name if equal.

Profiles are learnt from about ``LANG_ROWS`` documents of each language, drawn by hash from those that
may be learnt from, or from all of them where there are fewer; every document is predicted from its
whole text.

Defined results: null text and text without letters are ``und`` with score 0, as is everything
when there is nothing to learn from; repeated rows give a row each; an empty table gives none. The score is 1 minus the
distance as a share of the greatest possible one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import held_out, worker_cache

TOP = 400
LANG_ROWS = 5_000
#: Languages whose frequency is looked up; the rest, no more frequent than these, give all their rows.
MOST_LANGUAGES = 1000


def _letters_and_blanks() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: is it a letter, is it white space."""
    cache = worker_cache("code_points")
    if "letter" not in cache:
        chars = list(map(chr, range(0x110000)))
        cache["letter"] = np.fromiter(map(str.isalpha, chars), bool, len(chars))
        cache["blank"] = np.fromiter(map(str.isspace, chars), bool, len(chars))
    return cache["letter"], cache["blank"]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of a text, ascending, and how often each occurs.

    A gram is packed into a number that sorts like it. Only letters and the blanks between words
    count; a word is taken with one blank on either side.
    """
    letter, blank = _letters_and_blanks()
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    blanks = blank[points]
    c = np.where(blanks, 32, points)[blanks | letter[points]].astype(np.int64)
    c = np.concatenate(([32], c, [32]))
    c = c[np.concatenate(([True], (c[1:] != 32) | (c[:-1] != 32)))]
    inner = c[1:-1] != 32
    first, second = c << 42, c << 21
    ones = first[1:-1][inner]
    if not len(ones):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    twos = first[:-1] | second[1:]
    threes = (twos[:-1] | c[2:])[inner]
    return np.unique(np.concatenate((ones, twos, threes)), return_counts=True)


def ranked(text: str, top: int = TOP) -> np.ndarray:
    """The text's most frequent grams, most frequent first, ties by gram."""
    codes, counts = gram_counts(text)
    return codes[np.argsort(-counts, kind="stable")[:top]]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums: dict[str, Counter] = {}
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            codes, counts = gram_counts(text)
            own = sums.setdefault(lang, Counter())
            for c, n in zip(codes.tolist(), counts.tolist()):
                own[c] += n
        for lang, own in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own)), pa.array(list(own), pa.int64()), pa.array(list(own.values()), pa.int64())], names=["lang", "gram", "n"]
            )


def learn_profiles(docs: DataFrame, top: int = TOP, lang_rows: int = LANG_ROWS) -> dict[str, list[int]]:
    """Ranked grams per language: ``top`` numbers each, whatever the size of the corpus."""
    rows = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    # Rare languages give all their rows: each has a rate of its own. MOST_LANGUAGES rows at most.
    known = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    frequent = [(r["lang"], r["n"] // lang_rows) for r in known if r["n"] >= 2 * lang_rows]
    if frequent:
        shares = F.create_map(*[F.lit(x) for pair in frequent for x in pair])
        share = F.coalesce(F.try_element_at(shares, F.col("lang")), F.lit(1))
        rows = rows.filter(F.pmod(F.xxhash64("doc_id", "text"), share) == 0)
    counts = rows.select("text", "lang").mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("rank", rank).filter(F.col("rank") <= top).orderBy("lang", "rank")
    profiles: dict[str, list[int]] = {}
    for r in best.collect():
        profiles.setdefault(r["lang"], []).append(r["gram"])
    return profiles


class Profiles:
    def __init__(self, profiles: dict[str, list[int]], top: int):
        self.names, self.top = sorted(profiles), top
        self.codes = np.unique(np.array([c for p in profiles.values() for c in p], np.int64))
        self.ranks = np.full((len(self.names), len(self.codes) + 1), -1, np.int64)
        for i, name in enumerate(self.names):
            self.ranks[i, np.searchsorted(self.codes, profiles[name])] = np.arange(len(profiles[name]))

    def predict(self, text: str | None) -> tuple[str, float]:
        own = ranked(text or "", self.top)
        if not len(own) or not self.names:
            return "und", 0.0
        at = np.searchsorted(self.codes, own)
        at[self.codes[np.minimum(at, len(self.codes) - 1)] != own] = len(self.codes)
        ranks = self.ranks[:, at]
        apart = np.where(ranks < 0, self.top, np.abs(ranks - np.arange(len(own)))).sum(1)
        best = int(apart.argmin())
        return self.names[best], 1.0 - float(apart[best]) / (self.top * len(own))


def _predict(profiles: dict[str, list[int]], top: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Profiles(profiles, top)
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def identify(docs: DataFrame, top: int = TOP, lang_rows: int = LANG_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    profiles = learn_profiles(docs, top, lang_rows)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(_predict(profiles, top), "doc_id bigint, held_out boolean, lang_pred string, score double")
