"""Language-model scores from a log-frequency Bloom filter (Talbot and Osborne, 2007).

An n-gram of quantised count q is in the filter under the levels 1..q; a worker probes level
after level until one is missing. One filter holds the counts of words beyond an exact head
table and of word pairs that occur at least ``min_count`` times. Probabilities interpolate

    p(w | v) = l(v) * c(v w) / (c(v) + f) + (1 - l(v)) * p(w)

where ``f`` makes room for what false positives add, c(v w) is the lower end of its count's
level and c(v) the upper end, so the probabilities of all words after v sum to one at most. The
weights l depend on the size of c(v) and are fitted by leave-one-out expectation-maximisation
on all tokens of the training texts: tasks count them by size class and by the ratio of the two
terms, in steps of 2**(1/32), and the rounds run on these counts, whose number is bounded.

The filter's size is measured before it is sent. Beyond ``max_bytes`` its slices are sent in
turns, one pass over the texts for each: a token's pair lies in one slice, so the passes add up
to the same scores. Words beyond the head go out in turns of their own if they have to, before
the pairs. The passes that count for the weights add up likewise and come before the scores.
"""

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import Hashes, buckets, flat, fold, local, mixed, numbered, query, table
from skyloom.llm.substrings import dealt, joined
from skyloom.sources.lake import staged

FOLDS = 10
ALPHA = 0.1
HEAD = 1 << 20
MIN_COUNT = 2
BASE = 1.5
BITS_PER_ENTRY = 32
BLOCKS_PER_ENTRY, BITS_PER_BLOCK = 3, 5
MAX_BYTES = 256 << 20
COMBINED_WORDS = 1_000_000
CHUNK_BYTES = 1_500_000
#: From here on XXH64 has four lanes; such words are hashed one by one.
LONG = 32
XXH = np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)
#: Bytes of words, not the space and 0x09-0x0D.
WORD = ~np.isin(np.arange(256), [32, *range(9, 14)])
EM_ROUNDS = 20
#: Steps of a factor of two, and the factors of two, that ratios are counted in.
RATIO_STEPS, RATIO_REACH = 32, 80
END = np.uint64(0xD1B54A32D192ED03)
PAIR = np.uint64(0x9E3779B97F4A7C15)
LEVEL = np.uint64(0xC2B2AE3D27D4EB4F)


def pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(v * PAIR + w)


def level_of(counts: np.ndarray, least: int) -> np.ndarray:
    """1 for ``least``, one more for every factor BASE."""
    return 1 + np.floor(np.log(counts / least) / math.log(BASE) + 1e-9).astype(np.int64)


def lower_end(level: np.ndarray, least: int) -> np.ndarray:
    return np.where(level > 0, np.ceil(least * BASE ** (level - 1.0) - 1e-9), 0.0)


def upper_end(level: np.ndarray, least: int) -> np.ndarray:
    return np.where(level > 0, np.floor(least * BASE**level), 0.0)


def false_positive() -> float:
    """Chance that a probe of an absent entry hits: entries fall into blocks as a Poisson number."""
    load = 64 * BLOCKS_PER_ENTRY / BITS_PER_ENTRY
    chance = [math.exp(n * math.log(load) - load - math.lgamma(n + 1)) for n in range(100)]
    hit = sum(c * (1 - (63 / 64) ** (BITS_PER_BLOCK * n)) ** BITS_PER_BLOCK for n, c in enumerate(chance))
    return hit**BLOCKS_PER_ENTRY


FALSE_POSITIVE = false_positive()


def bucket_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(24)) % np.uint64(parts)).astype(np.int64)


def blocks(hashes: np.ndarray, level: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of a level's entries: a number that picks a 64-bit block, and the bits to set there; a few
    times over. ``send`` with the positions that still matter narrows what follows."""
    state = mixed(hashes + np.uint64(level) * np.full(1, LEVEL))
    for _ in range(BLOCKS_PER_ENTRY):
        state = mixed(state + PAIR)
        bits = np.zeros(len(state), np.uint64)
        for k in range(BITS_PER_BLOCK):
            bits |= np.uint64(1) << ((state >> np.uint64(6 * k)) & np.uint64(63))
        kept = yield state >> np.uint64(6 * BITS_PER_BLOCK), bits
        if kept is not None:
            state = state[kept]


class Filter:
    """Slices of 64-bit blocks, one for each bucket of hashes; ``sizes`` counts their blocks."""

    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        self.words, self.sizes = words, sizes.astype(np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def level(self, hashes: np.ndarray) -> np.ndarray:
        """Highest level up to which all probes hit."""
        out = np.zeros(len(hashes), np.int64)
        if not len(self.words) or not len(hashes):
            return out
        bucket = bucket_of(hashes, len(self.sizes))
        live, level = np.flatnonzero(self.sizes[bucket] > 0), 0
        while len(live):
            level += 1
            probes, kept = blocks(hashes[live], level), None
            for _ in range(BLOCKS_PER_ENTRY):
                number, bits = probes.send(kept)
                of = bucket[live]
                block = self.words[(self.starts[of] + number % self.sizes[of]).astype(np.int64)]
                kept = np.flatnonzero(block & bits == bits)
                live = live[kept]
            out[live] = level
        return out


def filled(hashes: np.ndarray, levels: np.ndarray, bits_per_entry: float) -> np.ndarray:
    """One slice of blocks with every hash under its levels 1..q."""
    size = int(math.ceil(levels.sum() * bits_per_entry / 64))
    words = np.zeros(size, np.uint64)
    for level in range(1, int(levels.max(initial=0)) + 1):
        for number, bits in blocks(hashes[levels >= level], level):
            np.bitwise_or.at(words, (number % np.uint64(size)).astype(np.int64), bits)
    return words


def summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes in order, with the sums of their counts."""
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.empty(0, np.int64)
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def portions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows some at a time, about CHUNK_BYTES characters of text, however long the texts are."""
    for batch in batches:
        size = np.cumsum([len(t) if t else 0 for t in batch["text"]])
        cuts = np.flatnonzero(np.diff(size // CHUNK_BYTES)) + 1
        for begin, end in zip([0, *cuts], [*cuts, len(batch)]):
            if end > begin:
                yield batch.iloc[begin:end]


def turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def word_hashes(text: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of the words at ``starts``, eight bytes of all words at a time; the few of
    LONG bytes or more one by one. ``text`` goes on for eight bytes after the last word."""
    a, b, c, d, e = XXH
    eights = np.ndarray(len(text) - 7, "<u8", text, strides=1)
    bytes_ = np.frombuffer(text, np.uint8)
    out = sizes.astype(np.uint64) + e
    for k in range(0, LONG - 7, 8):
        live = np.flatnonzero((sizes >= k + 8) & (sizes < LONG))
        part = turned(eights[starts[live] + k] * b, 31) * a
        out[live] = turned(out[live] ^ part, 27) * a + d
    at, left = starts + sizes // 8 * 8, sizes % 8
    live = np.flatnonzero(left >= 4)
    part = (eights[at[live]] & np.uint64(0xFFFFFFFF)) * a
    out[live] = turned(out[live] ^ part, 23) * b + c
    at, left = at + left // 4 * 4, left % 4
    for k in range(3):
        live = np.flatnonzero(left > k)
        out[live] = turned(out[live] ^ (bytes_[at[live] + k].astype(np.uint64) * e), 11) * a
    out = (out ^ (out >> np.uint64(33))) * b
    out = (out ^ (out >> np.uint64(29))) * c
    out ^= out >> np.uint64(32)
    for i in np.flatnonzero(sizes >= LONG):
        out[i] = xxhash.xxh64_intdigest(text[starts[i] : starts[i] + sizes[i]])
    return out


def ended(hashes: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of texts of so ``many`` words with an end after each text, and the text's number."""
    out = np.full(len(hashes) + len(many), END, np.uint64)
    words = np.ones(len(out), bool)
    words[np.cumsum(many + 1) - 1] = False
    out[words] = hashes
    return out, np.repeat(np.arange(len(many)), many + 1)


def tokens(held: list[list[bytes]], hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of texts that are split already, named by ``hashes``."""
    return ended(hashes.of(flat(held)), np.array([len(found) for found in held], np.int64))


def text_tokens(texts: Iterable[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, an end after each text, and the number of the text of each; texts are
    split and words hashed as one array of bytes."""
    held = [t.encode().lower() if t else b"" for t in texts]
    text = b"\n".join([b"", *held, b" " * 8])
    inside = WORD[np.frombuffer(text, np.uint8)]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    many = np.diff(np.searchsorted(starts, np.cumsum([1, *(len(t) + 1 for t in held)])))
    return ended(word_hashes(text, starts, sizes), many)


def histories(token: np.ndarray) -> np.ndarray:
    """The token before each; a text starts after an end."""
    return np.append(np.array([END], np.uint64), token[:-1])


COUNTED = (
    "bucket int, words binary, word_counts binary, pairs binary, pair_counts binary, total long, distinct long"
)


def counted(texts: DataFrame, min_count: int) -> DataFrame:
    """One row for each bucket of hashes: its words with counts, and its pairs that occur at
    least ``min_count`` times. Tasks combine counts before the shuffle."""
    parts = buckets(texts.sparkSession)

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []

        def flushed():
            rows = {}
            for kind, i in (("words", 0), ("pairs", 1)):
                found, times = summed(*(np.concatenate(a) for a in zip(*(h[i] for h in held))))
                for b, blobs in dealt(bucket_of(found, parts), found, times.astype(np.uint32)):
                    rows.setdefault(b, {"bucket": b})[kind], rows[b][f"{kind[:-1]}_counts"] = blobs
            held.clear()
            columns = ["bucket", "words", "word_counts", "pairs", "pair_counts"]
            out = pd.DataFrame(list(rows.values()), columns=columns)
            return out.astype(object).where(out.notna(), b"")

        size = 0
        for rows in portions(batches):
            token, _ = text_tokens(rows["text"])
            w = np.unique(token, return_counts=True)
            p = np.unique(pair_hash(histories(token), token), return_counts=True)
            held.append((w, p))
            size += len(token)
            if size >= COMBINED_WORDS:
                yield flushed()
                size = 0
        if held:
            yield flushed()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        columns = [joined(pdf[c], np.uint64 if c in ("words", "pairs") else np.uint32) for c in pdf.columns[1:]]
        word, times = summed(columns[0], columns[1].astype(np.int64))
        pair, often = summed(columns[2], columns[3].astype(np.int64))
        pair, often = pair[often >= min_count], often[often >= min_count]
        blobs = [x.tobytes() for x in (word, times, pair, often)]
        return pd.DataFrame([(pdf["bucket"].iloc[0], *blobs, times.sum(), len(word))], columns=COUNTED_COLUMNS)

    sent = texts.select("text").mapInPandas(gather, COUNTED.partition(", total")[0])
    return sent.groupBy("bucket").applyInPandas(merge, COUNTED)


COUNTED_COLUMNS = [c.split()[0] for c in COUNTED.split(", ")]


def frequent(counts: DataFrame, most: int) -> int:
    """Least count such that at most ``most`` words have it or more, up to steps of BASE."""

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            level, times = np.unique(level_of(joined(batch["word_counts"], np.int64), 1), return_counts=True)
            yield pd.DataFrame({"level": level, "n": times})

    found = counts.select("word_counts").mapInPandas(steps, "level long, n long")
    rows = local(found.groupBy("level").agg(F.sum("n").alias("n"))).sort_values("level", ascending=False)
    fitting = rows["level"][rows["n"].cumsum() <= most]
    if len(fitting) == len(rows):
        return 1
    return int(lower_end(np.array([fitting.min() if len(fitting) else rows["level"].max() + 1]), 1)[0])


def word_rows(counts: DataFrame, low: int, high: int | None) -> DataFrame:
    """Words with counts in [low, high) as rows (h, c)."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for hashes, times in zip(batch["words"], batch["word_counts"]):
                out = pd.DataFrame({"h": np.frombuffer(hashes, np.int64), "c": np.frombuffer(times, np.int64)})
                yield out[(out["c"] >= low) & (out["c"] < (high or np.inf))]

    return counts.select("words", "word_counts").mapInPandas(task, "h long, c long")


def slices(counts: DataFrame, head: int, min_count: int) -> DataFrame:
    """Filter slices of the words under ``head`` and of the pairs, a row for each bucket."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                word, times = np.frombuffer(row.words, np.uint64), np.frombuffer(row.word_counts, np.int64)
                word, times = word[times < head], times[times < head]
                pair, often = np.frombuffer(row.pairs, np.uint64), np.frombuffer(row.pair_counts, np.int64)
                one = filled(word, level_of(times, 1), BITS_PER_ENTRY)
                two = filled(pair, level_of(often, min_count), BITS_PER_ENTRY)
                rows = [(row.bucket, one.tobytes(), len(one), two.tobytes(), len(two))]
                yield pd.DataFrame(rows, columns=["bucket", "word_bits", "word_size", "pair_bits", "pair_size"])

    schema = "bucket int, word_bits binary, word_size long, pair_bits binary, pair_size long"
    return counts.select(*COUNTED_COLUMNS[:5]).mapInPandas(task, schema)


def in_head(head: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words are in the sorted head, and whether they are."""
    at = np.minimum(np.searchsorted(head, word), max(0, len(head) - 1))
    return at, head[at] == word if len(head) else np.zeros(len(word), bool)


class Model:
    """What a worker needs: the exact head, both filters, totals and weights."""

    def __init__(self, head, times, words, pairs, total: int, distinct: int, min_count: int, weights):
        """``head`` is sorted; ``words`` and ``pairs`` are blocks and slice sizes."""
        self.head, self.times = head, times
        self.words, self.pairs = Filter(*words), Filter(*pairs)
        self.total, self.distinct, self.min_count, self.weights = total, distinct, min_count, weights

    def counts(self, word: np.ndarray, rare: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lower and upper ends of the counts, and which words are in the exact head. ``rare``:
        levels of the words that are not, if they are known already."""
        at, exact = in_head(self.head, word)
        level = np.zeros(len(word), np.int64)
        level[~exact] = self.words.level(word[~exact]) if rare is None else rare
        low, high = lower_end(level, 1), upper_end(level, 1)
        if exact.any():
            low[exact] = high[exact] = self.times[at[exact]]
        return low, high, exact

    def parts(self, token: np.ndarray, rare: np.ndarray | None = None):
        """For each token: probability alone, count of the pair, count of the history, and its
        lower count and whether that is exact. ``rare``: levels of the tokens beyond the head, the
        last of which is an end."""
        if rare is None:
            unique, back = np.unique(token, return_inverse=True)
            low, high, exact = (x[back] for x in self.counts(unique))
            first = self.counts(np.array([END], np.uint64))[1]
        else:
            low, high, exact = self.counts(token, rare)
            first = high[-1:]
        alone = (low + ALPHA) / (self.total + ALPHA * (self.distinct + 1))
        before = np.append(first, high[:-1])
        pair = np.zeros(len(token))
        both = np.flatnonzero((low > 0) & (before > 0))
        found, back = np.unique(pair_hash(histories(token)[both], token[both]), return_inverse=True)
        pair[both] = lower_end(self.pairs.level(found), self.min_count)[back]
        return alone, np.minimum(pair, before), before, low, exact

    def log10(self, alone: np.ndarray, pair: np.ndarray, before: np.ndarray) -> np.ndarray:
        weight = np.where(before > 0, self.weights[size_class(before)], 0.0)
        spurious = FALSE_POSITIVE * self.distinct * self.min_count
        return np.log10(weight * pair / (before + spurious + 1e-300) + (1 - weight) * alone)

    def ratios(self, alone: np.ndarray, pair: np.ndarray, before: np.ndarray) -> np.ndarray:
        """For each token, its own occurrence taken out, the cell it counts in for the weights:
        the size class and, from 1, the step of the pair's share over the word's; 0 without pair."""
        pair = np.where(pair > self.min_count, pair - 1, 0.0)
        before = np.maximum(before - 1, 0)
        ratio = pair / (before + FALSE_POSITIVE * self.distinct * self.min_count + 1e-300) / alone
        step = np.zeros(len(pair), np.int64)
        some = ratio > 0
        most = RATIO_STEPS * RATIO_REACH
        step[some] = np.clip(np.rint(np.log2(ratio[some]) * RATIO_STEPS), -most, most) + most + 1
        return size_class(before) * RATIO_CELLS + step


RATIO_CELLS = 2 * RATIO_STEPS * RATIO_REACH + 2


def maximised(cells: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Weights by expectation-maximisation over the cells of all tokens."""
    bins, step = cells // RATIO_CELLS, cells % RATIO_CELLS
    ratio = np.where(step > 0, 2.0 ** ((step - 1) / RATIO_STEPS - RATIO_REACH), 0.0)
    weights = np.full(64, 0.5)
    n = np.bincount(bins, times, minlength=64)
    for _ in range(EM_ROUNDS):
        own = weights[bins] * ratio
        share = own / (own + (1 - weights[bins]))
        weights = (np.bincount(bins, share * times, minlength=64) + 0.1) / (n + 1.0)
    return weights


def size_class(before: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(before, 1)), 63).astype(np.int64)


def turns_of(sizes: pd.DataFrame, kind: str, parts: int, max_bytes: int) -> list[tuple[int, int]]:
    """Ranges of buckets whose slices take half of ``max_bytes`` at most, or are one slice."""
    turns, begin, held = [], 0, 0
    for bucket, size in zip(sizes["bucket"], sizes[f"{kind}_size"]):
        if held and (held + size) * 16 > max_bytes:
            turns.append((begin, bucket))
            begin, held = bucket, 0
        held += size
    return [*turns, (begin, parts)]


def slices_of(cut: DataFrame, sizes: pd.DataFrame, kind: str, turn: tuple[int, int], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks and slice sizes of the buckets of a turn, put in place a partition at a time."""
    size = np.zeros(parts, np.int64)
    mine = sizes[(sizes["bucket"] >= turn[0]) & (sizes["bucket"] < turn[1])]
    size[mine["bucket"]] = mine[f"{kind}_size"]
    words, end = np.zeros(size.sum(), np.uint64), size.cumsum()
    rows = cut.filter((F.col("bucket") >= turn[0]) & (F.col("bucket") < turn[1])).select("bucket", f"{kind}_bits")
    for bucket, bits in rows.toLocalIterator():
        words[end[bucket] - size[bucket] : end[bucket]] = np.frombuffer(bits, np.uint64)
    return words, size


def levelled(docs: DataFrame, model) -> DataFrame:
    """Levels of each row's tokens beyond the head, as far as they lie in the slices sent."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        head, words = model.value
        words = Filter(*words)
        for rows in portions(batches):
            token, doc = text_tokens(rows["text"])
            rare = np.flatnonzero(~in_head(head, token)[1])
            unique, back = np.unique(token[rare], return_inverse=True)
            level = words.level(unique)[back].astype(np.int16)
            out = rows[["row_id"]].copy()
            out["levels"] = np.split(level, np.searchsorted(doc[rare], np.arange(1, len(rows))))
            yield out

    return docs.select("row_id", "text").mapInPandas(task, "row_id long, levels array<smallint>")


def scanned(batches: Iterator[pd.DataFrame], m: Model, turn: tuple[int, int], parts: int):
    """Rows some at a time, with their tokens, the texts' numbers, what the model says of each
    token, and whether its pair lies in the buckets of the turn."""
    for rows in portions(batches):
        token, doc = text_tokens(rows["text"])
        known = np.concatenate(rows["levels"].tolist()) if "levels" in rows else None
        said = m.parts(token, known)
        bucket = bucket_of(pair_hash(histories(token), token), parts)
        yield rows, token, doc, said, (bucket >= turn[0]) & (bucket < turn[1])


def cells(docs: DataFrame, model, turn: tuple[int, int], parts: int) -> DataFrame:
    """(cell, n): all tokens of the texts whose pair lies in the buckets of this turn, by cell."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, total = Model(*model.value), np.zeros(64 * RATIO_CELLS, np.int64)
        for _, _, _, (alone, pair, before, _, _), mine in scanned(batches, m, turn, parts):
            total += np.bincount(m.ratios(alone[mine], pair[mine], before[mine]), minlength=len(total))
        yield pd.DataFrame({"cell": np.flatnonzero(total), "n": total[total > 0]})

    return docs.mapInPandas(task, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def scored(docs: DataFrame, model, weights: np.ndarray, turn: tuple[int, int], parts: int) -> DataFrame:
    """Sums over the tokens of each row of (row_id, doc_id, text, held_out); the score counts
    tokens whose pair lies in the buckets of this turn."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model(*model.value)
        m.weights = weights
        for rows, token, doc, (alone, pair, before, low, exact), mine in scanned(batches, m, turn, parts):
            size = len(rows)
            logs = np.where(mine, m.log10(alone, pair, before), 0.0)
            out = rows[["row_id", "doc_id", "held_out"]].copy()
            out["n_tokens"] = np.bincount(doc, minlength=size)
            out["known"] = np.bincount(doc, exact, size).astype(np.int64)
            out["base"] = np.bincount(doc, np.where(exact, np.log10(low + ALPHA), 0.0), size)
            out["score"] = np.bincount(doc, logs, size)
            rare = np.flatnonzero(~exact)
            cuts = np.searchsorted(doc[rare], np.arange(1, size))
            out["rare"] = np.split(token[rare].view(np.int64), cuts)
            yield out

    schema = "row_id long, doc_id long, held_out boolean, n_tokens long, known long, base double, score double"
    return docs.mapInPandas(task, f"{schema}, rare array<long>")


def score_texts(
    docs: DataFrame, learn, head_words: int = HEAD, min_count: int = MIN_COUNT, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` of every row of stored ``docs`` (doc_id, text, others).

    ``learn`` is a condition on docs; rows that fail it are held out. Null and empty texts are
    one end token. With nothing to learn from, every token has the unknown word's share."""
    spark = docs.sparkSession
    parts = buckets(spark)
    counts = staged(counted(docs.filter(learn), min_count), "ngrams")
    sums = counts.agg(F.sum("total").alias("n"), F.sum("distinct").alias("v")).first()
    total, distinct = sums.n or 0, sums.v or 0
    least = frequent(counts, head_words) if total else 1
    head = local(word_rows(counts, least, None))
    found, times = summed(head["h"].to_numpy(np.int64).view(np.uint64), head["c"].to_numpy(np.int64))
    del head
    cut = staged(slices(counts, least, min_count), "slices")
    sizes = local(cut.select("bucket", "word_size", "pair_size")).sort_values("bucket")
    word_turns, turns = (turns_of(sizes, kind, parts, max_bytes) for kind in ("word", "pair"))

    rows = numbered(
        docs,
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        (~F.coalesce(learn, F.lit(False))).alias("held_out"),
    )
    if len(word_turns) + len(turns) > 2:
        rows = staged(rows, "numbered")
    none = (np.empty(0, np.uint64), np.zeros(parts, np.int64))
    model = [found, times, none, none, total, distinct, min_count, np.zeros(64)]
    if len(word_turns) == 1:
        model[2] = slices_of(cut, sizes, "word", word_turns[0], parts)
    else:
        levels = None
        for turn in word_turns:
            sent = spark.sparkContext.broadcast((found, slices_of(cut, sizes, "word", turn, parts)))
            one = staged(levelled(rows, sent), "levels")
            sent.destroy()
            if levels is None:
                levels = one
            else:
                both = levels.join(one.withColumnRenamed("levels", "more"), "row_id")
                add = F.zip_with("levels", "more", lambda a, b: (a + b).cast("smallint"))
                levels = staged(both.select("row_id", add.alias("levels")), "levels")
        rows = staged(rows.join(levels, "row_id"), "numbered")

    def broadcast(turn):
        model[3] = slices_of(cut, sizes, "pair", turn, parts)
        out = spark.sparkContext.broadcast(list(model))
        model[3] = none
        return out

    sent, counted_cells = None, []
    for turn in turns if total else ():
        if sent:
            sent.destroy()
        sent = broadcast(turn)
        counted_cells.append(local(cells(rows.filter("not held_out"), sent, turn, parts)))
    weights = np.zeros(64)
    if counted_cells:
        found_cells = pd.concat(counted_cells)
        weights = maximised(found_cells["cell"].to_numpy(np.int64), found_cells["n"].to_numpy(np.float64))
    out = None
    for turn in turns:
        if sent is None or len(turns) > 1:
            if sent:
                sent.destroy()
            sent = broadcast(turn)
        one = staged(scored(rows, sent, weights, turn, parts), "scored")
        if out is None:
            out = one
        else:
            more = one.select("row_id", F.col("score").alias("more"))
            out = staged(out.join(more, "row_id").withColumn("score", F.col("score") + F.col("more")).drop("more"), "scored")
    sent.destroy()

    tail = word_rows(counts, 0, least)
    rare = out.select("row_id", F.explode("rare").alias("h")).join(tail, "h", "left")
    rare = rare.groupBy("row_id").agg(
        F.count("c").alias("rare_known"),
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + ALPHA)).alias("rare_base"),
    )
    unit = F.lit(math.log10(total + ALPHA * (distinct + 1)))
    return out.drop("rare").join(rare, "row_id", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0)) - F.col("n_tokens") * unit).alias("base_score"),
        "score",
    )


@query
def op3_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a pair model learnt from nine tenths of them."""
    return score_texts(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), FOLDS) != 0)
