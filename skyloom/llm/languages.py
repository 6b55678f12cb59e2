"""Language identification by mixture inference.

Character trigrams of a bounded, labelled sample give every word a likelihood in each language.
Expectation-maximisation then estimates the language proportions of a whole document, and
languages are dropped from its set, the rarest first, while that costs less log-likelihood than
the penalty of half the logarithm of the word count for each language. The prediction is the
largest share.
"""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import fold, local, query, table, unused
from skyloom.operators.sampling import hash_sample
from skyloom.sources.lake import staged

FOLDS, HELD_OUT = 4, 2
ROWS_PER_LANGUAGE = 1_000
SMOOTHING = 0.1
ROUNDS = 15
LEAST_SHARE = 0.01
CACHED = 300_000
CHUNK = 100_000
LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> Counter:
    """Runs of letters in lower case. The pattern also takes numbers that are no digits, such as
    fractions; these part words."""
    found = Counter(LETTERS.findall(text.lower())) if text else Counter()
    for word in [w for w in found if not w.isalpha()]:
        times = found.pop(word)
        for part in "".join(c if c.isalpha() else " " for c in word).split():
            found[part] += times
    return found


def grams(word: str) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def learnt(docs: DataFrame, learn: Column, rows_per_language: int) -> tuple[list[str], dict[str, np.ndarray], np.ndarray]:
    """Languages, log-probabilities of the known trigrams, and of any other."""
    rows = docs.filter(learn & F.col("lang").isNotNull()).select("doc_id", "lang")
    ids = hash_sample(staged(rows.distinct(), "labelled"), ["doc_id"], rows_per_language, strata="lang")
    ids = ids.select("doc_id").distinct()  # a bounded number for each language

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                found = Counter()
                for text in texts:
                    for word, times in letter_words(text).items():
                        for gram in grams(word):
                            found[gram] += times
                if found:
                    yield pd.DataFrame({"lang": lang, "gram": list(found), "n": list(found.values())})

    sample = docs.filter(learn & F.col("lang").isNotNull()).join(F.broadcast(ids), "doc_id", "left_semi")
    counts = sample.select("lang", "text").mapInPandas(count, "lang string, gram string, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = local(counts)  # of a bounded sample
    wide = counts.pivot(index="gram", columns="lang", values="n").fillna(0.0)
    langs = sorted(wide.columns)
    table_ = wide[langs].to_numpy(float) if langs else np.zeros((0, 0))
    totals = table_.sum(axis=0) + SMOOTHING * (len(table_) + 1)
    logs = np.log(table_ + SMOOTHING) - np.log(totals) if langs else table_
    return langs, dict(zip(wide.index, logs)), np.log(SMOOTHING) - np.log(totals) if langs else np.zeros(0)


class Words(dict):
    """Word -> position of its log-likelihoods, for a bounded number of words at a time."""

    def __init__(self, known: dict[str, np.ndarray], other: np.ndarray):
        super().__init__()
        self.place = {gram: k for k, gram in enumerate(known)}
        self.logs = np.array([*known.values(), other]).reshape(len(known) + 1, len(other))
        self.rows = np.empty((1024, len(other)))

    def learn(self, words: list[str]) -> None:
        """Add up the trigrams of new words, all together."""
        first, place, unknown = len(self), self.place.get, len(self.place)
        found = [place(gram, unknown) for word in words for gram in grams(word)]
        starts = np.cumsum([0] + [len(w) for w in words[:-1]])  # a word has as many trigrams as letters
        sums = np.add.reduceat(self.logs[found], starts, axis=0)
        while first + len(words) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.empty_like(self.rows)])
        self.rows[first : first + len(words)] = sums
        self.update(zip(words, range(first, first + len(words))))

    def positions(self, found: list[Counter]) -> np.ndarray:
        """Of the words of all texts, in turn."""
        words = [w for c in found for w in c]
        at = list(map(self.get, words))
        missing = [i for i, place in enumerate(at) if place is None]
        if missing:
            self.learn(list({words[i] for i in missing}))
            for i in missing:
                at[i] = self[words[i]]
        return np.array(at, np.int64)

    def shrink(self) -> None:
        if len(self) > CACHED:
            self.clear()


def mixture(like: np.ndarray, weight: np.ndarray, doc: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the allowed languages and log-likelihood of each document; words are sorted by
    document and every document has some."""
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    total = np.add.reduceat(weight, first)[:, None]
    many = allowed.sum(axis=1, keepdims=True)
    shares = allowed / many
    rounds = ROUNDS if (many > 1).any() else 0  # a single language has all of the text
    top = like.max(axis=1)
    scaled = np.exp(like - top[:, None])
    for number in range(rounds + 1):
        joint = scaled * shares[doc]
        sums = np.maximum(joint.sum(axis=1), 1e-300)
        if number == rounds:
            break
        shares = np.add.reduceat(joint * (weight / sums)[:, None], first, axis=0) / total
    return shares, np.add.reduceat(weight * (np.log(sums) + top), first)


def selected(like: np.ndarray, weight: np.ndarray, doc: np.ndarray, size: int) -> np.ndarray:
    """Shares of the languages kept for each of ``size`` documents."""
    languages = like.shape[1]
    penalty = 0.5 * np.log(np.maximum(np.bincount(doc, weight, size), 2))
    best, value = mixture(like, weight, doc, np.ones((size, languages)))
    worth = value - penalty * languages
    open_ = np.arange(size)
    for left in range(languages - 1, 0, -1):
        # Drop the rarest of the languages still in each open document's set.
        order = np.argsort(-best[open_], axis=1, kind="stable")
        allowed = np.zeros((len(open_), languages))
        np.put_along_axis(allowed, order[:, :left], 1.0, axis=1)
        place = np.full(size, -1)
        place[open_] = np.arange(len(open_))
        mine = place[doc] >= 0
        shares, value = mixture(like[mine], weight[mine], place[doc[mine]], allowed)
        gain = value - penalty[open_] * left
        rare = np.take_along_axis(best[open_], order[:, left : left + 1], axis=1)[:, 0] < LEAST_SHARE
        better = (gain >= worth[open_]) | rare
        open_, shares, gain = open_[better], shares[better], gain[better]
        best[open_], worth[open_] = shares, gain
        if not len(open_):
            break
    return best


def identify(docs: DataFrame, learn: Column, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """``docs`` (doc_id, text, lang, others) with ``lang_pred``, ``score`` (the share of that
    language) and ``lang_shares`` (language -> share of those kept). Columns of these names in
    the input are replaced.

    Learns from rows where ``learn`` holds and lang is not null, ``rows_per_language`` of each
    language in the order of their ids' hashes. A text that is null or has no letter is ``und``
    with score 0, as is every text if there is nothing to learn from; equal shares go to the
    first language by name."""
    langs, known, other = learnt(docs, learn, rows_per_language)
    shared = docs.sparkSession.sparkContext.broadcast((known, other))
    new = ["lang_pred", "score", "lang_shares"]
    docs = docs.drop(*new)

    @F.pandas_udf("lang_pred string, score double, lang_shares map<string, double>")
    def task(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = Words(*shared.value)
        for texts in batches:
            out = [("und", 0.0, {})] * len(texts)

            def flush(rows, found):
                at = words.positions(found)
                weight = np.concatenate([np.fromiter(c.values(), float, len(c)) for c in found])
                doc = np.repeat(np.arange(len(found)), [len(c) for c in found])
                for row, shares in zip(rows, selected(words.rows[at], weight, doc, len(found))):
                    kept = {langs[i]: float(shares[i]) for i in np.flatnonzero(shares > 0)}
                    top = int(np.argmax(shares))
                    out[row] = (langs[top], float(min(1.0, shares[top])), kept)
                words.shrink()

            rows, found, size = [], [], 0
            for row, text in enumerate(texts if langs else ()):
                if counted := letter_words(text):
                    rows.append(row)
                    found.append(counted)
                    size += len(counted)
                if size >= CHUNK:
                    flush(rows, found)
                    rows, found, size = [], [], 0
            if rows:
                flush(rows, found)
            yield pd.DataFrame(out, columns=new)

    # Nondeterministic only to the optimiser: a filter on the result must not run it twice.
    own = unused(docs, "_language")
    found = docs.withColumn(own, task.asNondeterministic()("text"))
    return found.select(*docs.columns, *(F.col(f"{own}.{c}").alias(c) for c in new))


@query
def op10_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of the labels."""
    docs = table(spark, sf_dir, "documents")
    remainder = fold(F.col("doc_id"), FOLDS)
    found = identify(docs, remainder != HELD_OUT)
    return found.select("doc_id", (remainder == HELD_OUT).alias("held_out"), "lang_pred", "score")
