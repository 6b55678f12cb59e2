"""Toxicity by a weighted finite-state grammar over clauses.

A lexical transducer rewrites a clause's words to word classes: insults and threats by a trie of
stems, targets, negations, words of reported speech. Transducers for target, negation and report
are composed into one machine, which rewrites each insult or threat to a match that says whether
a target stood near, whether it was negated and whether it was reported. A document is scored by
the logistic of the weights of its matched clauses and of the stems in them.

Stems beyond the given ones and all weights are learnt from a bounded sample of labelled rows; a
stem must be typical of toxic texts by a likelihood ratio, counted once for a group of copies.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import fold, local, query, table
from skyloom.sources.lake import staged

FOLDS = 5
SAMPLE_ROWS = 8_000
STEMS = 3_000
STEM_LENGTHS = range(3, 9)
LEAST_RATIO = 10.0
LEAST_PRECISION = 0.85
REACH = 4
RIDGE = 1.0
GIVEN_WEIGHT = 3.0
CACHED = 200_000

# Given words by class.
INSULTS = (
    "idiot moron stupid dumb loser clown scum trash garbage pathetic worthless disgusting imbecile fool coward liar "
    "vermin filth bastard creep freak "
    "dummkopf trottel abschaum widerlich arschloch "
    "connard imbécile ordure salaud abruti minable "
    "idiota estúpido imbécil basura escoria asqueroso"
).split()
THREATS = "kill murder hurt destroy stab strangle töten umbringen tuer égorger matar degollar".split()
TARGETS = (
    "you your yours yourself he she they them him her his their people everyone "
    "du dich dir ihr euch sie er vous tu toi te ils elles lui tú usted ustedes ellos ellas él"
).split()
NEGATIONS = "not no never neither nor cannot nicht kein keine nie ne pas jamais nunca jamás ni".split()
REPORTS = (
    "said says say called calls wrote writes claimed quoted quote according reported told "
    "sagte sagt schrieb laut dit disait écrit selon dijo dice escribió según"
).split()
CLAUSE = re.compile(r"[.!?;:\n]+")
WORDS = re.compile(r"[^\W\d_]+")
OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)


class Transducer:
    """States, arcs (state, symbol) -> (next state, output); a symbol without an arc is kept and
    leads to ``rest(state)``."""

    def __init__(self, start, arcs: dict, rest):
        self.start, self.arcs, self.rest = start, arcs, rest

    def step(self, state, symbol):
        return self.arcs.get((state, symbol)) or (self.rest(state), symbol)

    def then(self, other: "Transducer") -> "Transducer":
        """The composition: this one's output is the other's input."""
        return Composed(self, other)


class Composed(Transducer):
    def __init__(self, first: Transducer, second: Transducer):
        self.first, self.second, self.start, self.known = first, second, (first.start, second.start), {}

    def step(self, state, symbol):
        found = self.known.get((state, symbol))
        if found is None:
            one, middle = self.first.step(state[0], symbol)
            two, out = self.second.step(state[1], middle)
            found = self.known[state, symbol] = ((one, two), out)
        return found


def marking(trigger: int, flag: str, reach: int) -> Transducer:
    """Marks insults and threats within ``reach`` symbols after a trigger with ``flag``. Symbols
    are classes, or (class, flags) once an earlier transducer has marked them."""
    arcs = {}
    kinds = [INSULT, THREAT, *((k, f) for k in (INSULT, THREAT) for f in ("n", "r", "t", "nr", "nt", "rt", "nrt"))]
    for state in range(reach + 1):
        arcs[state, trigger] = (reach, trigger)
        for kind in kinds if state else ():
            base, flags = kind if isinstance(kind, tuple) else (kind, "")
            arcs[state, kind] = (state - 1, (base, "".join(sorted({*flags, flag}))))
    return Transducer(0, arcs, lambda state: max(0, state - 1))


def grammar() -> Transducer:
    """Negation and target reach a few words; a report reaches to the end of its clause."""
    near = marking(NEGATION, "n", REACH).then(marking(TARGET, "t", REACH))
    return near.then(marking(REPORT, "r", 1 << 10))


BACKWARDS = marking(TARGET, "t", REACH)
FLAGS = ["", "n", "r", "t", "nr", "nt", "rt", "nrt"]
MATCHES = {(k, f): i for i, (k, f) in enumerate((k, f) for k in (INSULT, THREAT) for f in FLAGS)}


class Lexicon(dict):
    """Word -> class, remembered for a bounded number of words. A stem matches the words that
    begin with it; other classes match whole words."""

    def __init__(self, stems: dict[str, float]):
        super().__init__()
        self.trie: dict = {}
        self.weights: dict[str, float] = {}
        for kind, words in ((INSULT, stems), (INSULT, INSULTS), (THREAT, THREATS)):
            for stem in words:
                node = self.trie
                for letter in stem:
                    node = node.setdefault(letter, {})
                node.setdefault("", (kind, stems.get(stem, GIVEN_WEIGHT)))
        self.fixed = {w: c for c, ws in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS)) for w in ws}

    def __missing__(self, word: str) -> int:
        kind, node = self.fixed.get(word), self.trie
        for letter in word if kind is None else "":
            if "" in node or letter not in node:
                break
            node = node[letter]
        if kind is None:
            kind, weight = node.get("", (OTHER, 0.0))
            if kind != OTHER:
                self.weights[word] = weight
        self[word] = kind
        return kind


    def shrink(self) -> None:
        if len(self) > CACHED:
            self.clear()
            self.weights.clear()


def matches(text: str | None, lexicon: Lexicon, machine: Transducer) -> np.ndarray:
    """Clauses of the text by their kind of match (a clause counts once for each kind), and last
    the weight of the words matched."""
    counts = np.zeros(len(MATCHES) + 1)
    if not text:
        return counts
    lexicon.shrink()
    for clause in CLAUSE.split(text.lower()):
        words = WORDS.findall(clause)
        classes = list(map(lexicon.__getitem__, words))
        if INSULT not in classes and THREAT not in classes:
            continue
        state, seen = machine.start, set()
        # A target after the insult counts as one before it: the clause is read both ways.
        back, after = BACKWARDS.start, []
        for symbol in reversed(classes):
            back, out = BACKWARDS.step(back, symbol)
            after.append(isinstance(out, tuple))
        for word, symbol, targeted in zip(words, classes, reversed(after)):
            if symbol in (INSULT, THREAT):
                counts[-1] += lexicon.weights[word]
            state, out = machine.step(state, symbol)
            if symbol in (INSULT, THREAT):
                kind, flags = out if isinstance(out, tuple) else (out, "")
                seen.add(MATCHES[kind, "".join(sorted({*flags, *("t" if targeted else "")}))])
        counts[list(seen)] += 1
    return counts


def features(counts: np.ndarray) -> np.ndarray:
    """Rows of counts -> their logarithms, any match at all, and a constant."""
    return np.column_stack([np.log1p(counts), counts[:, :-1].sum(axis=1) > 0, np.ones(len(counts))])


def fitted(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Logistic regression by Newton's method, classes weighted alike so that one half is where
    a match is as likely from either; the constant is not shrunk."""
    share = y.mean()
    weight = np.where(y == 1, 0.5 / share, 0.5 / (1 - share))
    w, shrink = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        slope = x.T @ (weight * (y - p)) - shrink * w
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


#: Where there are no labels of both kinds: any match is toxic.
UNTAUGHT = np.append(np.zeros(len(MATCHES) + 1), [4.0, -2.0])


def prefixes(text: str) -> set[str]:
    words = set(WORDS.findall(text.lower()))
    return {w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n}


def copy_key(text: str) -> int:
    """Least hash over word pairs: near copies mostly share it."""
    found = text.lower().split()
    return min(xxhash.xxh64_intdigest(f"{a} {b}") for a, b in zip(found, found[1:] or found)) >> 1 if found else 0


def learnt_stems(sample: DataFrame) -> dict[str, float]:
    """Prefixes typical of toxic texts with their log-odds, the best of each chain that extend
    one another and the longest of equal ones. ``sample`` is stored."""

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(key=[copy_key(t) for t in batch["text"]])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = Counter(), Counter()
            for text, toxic in zip(batch["text"], batch["toxic"]):
                found[toxic].update(prefixes(text))
            keys = list(found[0].keys() | found[1].keys())
            if keys:
                bad, good = ([found[toxic][k] for k in keys] for toxic in (1, 0))
                yield pd.DataFrame({"stem": keys, "bad": bad, "good": good})

    groups = sample.mapInPandas(keyed, "text string, toxic int, key long").groupBy("key")
    single = staged(groups.agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("toxic").alias("toxic")), "single")
    sums = {r.toxic: r.n for r in single.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sums) < 2:
        return {}
    base = sums[1] / (sums[0] + sums[1])
    counts = single.select("text", "toxic").mapInPandas(count, "stem string, bad long, good long")
    counts = counts.groupBy("stem").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    share = F.col("bad") / (F.col("bad") + F.col("good"))
    rest = F.when(F.col("good") > 0, F.col("good") * F.log((1 - share) / (1 - base))).otherwise(0.0)
    counts = counts.withColumn("ratio", F.col("bad") * F.log(share / base) + rest)
    counts = counts.filter((F.col("bad") > 0) & (share >= LEAST_PRECISION) & (F.col("ratio") >= LEAST_RATIO))
    best = local(counts.orderBy(F.desc("ratio"), F.desc(F.length("stem")), "stem").limit(STEMS))
    chosen: dict[str, float] = {}
    for row in best.itertuples():
        if not any(row.stem.startswith(c) or c.startswith(row.stem) for c in chosen):
            odds = math.log((row.bad + 0.5) / (row.good + 0.5)) - math.log(sums[1] / sums[0])
            chosen[row.stem] = max(0.0, odds)
    return chosen


def score_toxicity(docs: DataFrame, labels: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` (doc_id, text, others) with ``score`` and ``predicted``; columns of these names
    in the input are replaced.

    ``labels`` (doc_id, toxic) may repeat an id: the greatest label counts; null ones, and others than 0 and 1, do not.
    ``learn`` is a condition on doc_id for the rows to learn from, of which ``sample_rows`` are
    used, in the order of their ids' hashes. Null and empty texts match nothing."""
    docs = docs.drop("score", "predicted")
    marks = labels.filter(learn & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    marks = marks.filter("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")
    sample = staged(sample.select(F.coalesce("text", F.lit("")).alias("text"), "toxic"), "toxic_sample")
    stems = learnt_stems(sample)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon, machine = Lexicon(stems), grammar()
        for batch in batches:
            rows = [matches(t, lexicon, machine) for t in batch["text"]]
            yield pd.DataFrame({"toxic": batch["toxic"], "counts": rows})

    seen = local(sample.mapInPandas(counted, "toxic int, counts array<double>"))
    weights = UNTAUGHT
    if seen["toxic"].nunique() == 2:
        weights = fitted(features(np.stack(seen["counts"].to_list())), seen["toxic"].to_numpy(float))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon, machine = Lexicon(stems), grammar()
        for texts in batches:
            if len(texts):
                rows = np.stack([matches(t, lexicon, machine) for t in texts])
                yield pd.Series(1 / (1 + np.exp(-features(rows) @ weights)))
            else:
                yield pd.Series([], dtype=float)

    # Nondeterministic only to the optimiser: its uses must not run it again.
    out = docs.withColumn("score", score.asNondeterministic()("text"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from four fifths of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    remainder = fold(F.col("doc_id"), FOLDS)
    found = score_toxicity(docs, labels, remainder != 0)
    return found.select("doc_id", (remainder == 0).alias("held_out"), "score", "predicted")
