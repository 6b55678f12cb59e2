"""Exact substring deduplication by recompression (after Jez, 2015).

Texts are rewritten in rounds: first runs of one word get a name, then, round by round, pairs of
neighbouring names whose classes (a bit of the name's hash) are left and right. A name is a hash
of what it stands for, so it is global without a table of names, and equal substrings get equal
names inside; only names near their ends can differ, since those look at neighbours outside.
Each name therefore carries the stretch of words it was decided on. A stretch inside a repeated
window occurs with the window, so a window that holds the stretch of any name seen once in the
corpus cannot repeat.

Pass one counts the names of the last round in Spark and keeps the repeated ones in a bitmap of
fixed size; where its slots are shared, windows are looked at in vain but none is missed. Pass
two deals the 96-bit hashes of the windows that may repeat to their first occurrence: a
chunk of texts sends one entry for each window, so a window in every text is no hot key. Pass
three cuts the covered words out.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import Hashes, buckets, chunks, flat, local, mixed, query, raw_words, table

WINDOW = 20
ROUNDS = 4
BITMAP_BYTES = 32 << 20
GROUP_ROWS = 256
_RNG = np.random.default_rng(20)
RUN = np.uint64(0x9E3779B97F4A7C15)
FACTORS = _RNG.integers(1, 1 << 63, (2, 4096), np.uint64) * np.uint64(2) + np.uint64(1)


def names(word_hashes: np.ndarray, doc: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names of the last round with the half-open stretch of word positions each was decided
    on. ``doc`` numbers the text of each word; stretches that look past a text's end reach
    outside it."""
    n = len(word_hashes)
    if not n:
        return word_hashes, np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.ones(n, bool)
    first[1:] = (word_hashes[1:] != word_hashes[:-1]) | (doc[1:] != doc[:-1])
    start = np.flatnonzero(first)
    end = np.append(start[1:], n)
    name = np.where(end - start > 1, mixed(word_hashes[start] ^ RUN), word_hashes[start])
    doc, start, end = doc[start], start - 1, end + 1
    for number in range(1, rounds + 1):
        left = (mixed(name ^ FACTORS[1, number]) & np.uint64(1)).astype(bool)
        near = doc[:-1] == doc[1:]
        opens = np.append(near & left[:-1] & ~left[1:], False)
        closes = np.append(False, opens[:-1])
        # A pair looks at both parts. An unpaired left name looks at the next one, a right name
        # at the one before; at a text's end the stretch reaches outside already.
        ahead = np.append(near, False) & left & ~closes
        behind = np.append(False, near) & ~left & ~closes
        low, high = start.copy(), end.copy()
        at = np.flatnonzero(ahead)
        low[at], high[at] = np.minimum(start[at], start[at + 1]), np.maximum(end[at], end[at + 1])
        at = np.flatnonzero(behind)
        low[at], high[at] = np.minimum(start[at], start[at - 1]), np.maximum(end[at], end[at - 1])
        at = np.flatnonzero(opens)
        name = name.copy()
        name[at] = mixed(name[at] * FACTORS[0, number] + name[at + 1] + RUN)
        keep = ~closes
        name, doc, start, end = name[keep], doc[keep], low[keep], high[keep]
    return name, start, end


def parsed(held: list[list[bytes]], hashes: Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, number of the text of each word, and first position of each text."""
    lengths = np.array([len(found) for found in held], np.int64)
    return hashes.of(flat(held)), np.repeat(np.arange(len(held)), lengths), np.cumsum(lengths) - lengths


def dealt(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, list[bytes]]]:
    order = np.argsort(bucket, kind="stable")
    found, at = np.unique(bucket[order], return_index=True)
    for b, part in zip(found, np.split(order, at[1:])):
        yield int(b), [c[part].tobytes() for c in columns]


def joined(blobs: pd.Series, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), dtype)


def repeated_names(docs: DataFrame, window: int, rounds: int, bitmap_bytes: int) -> np.ndarray:
    """Bitmap over hashed slots (bucket, slot) of the names that occur more than once."""
    parts = buckets(docs.sparkSession)
    slots = 1 << int(np.log2(max(64, bitmap_bytes * 8 // parts)))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for _, held in chunks(batches, raw_words):
            word_hashes, doc, _ = parsed(held, hashes)
            name, start, end = names(word_hashes, doc, rounds)
            found, times = np.unique(name[end - start <= window], return_counts=True)
            found = np.append(found, found[times > 1])
            rows = [(b, blob) for b, (blob,) in dealt((found >> np.uint64(40)) % np.uint64(parts), found)]
            yield pd.DataFrame(rows, columns=["bucket", "names"])

    def shared(pdf: pd.DataFrame) -> pd.DataFrame:
        found, times = np.unique(joined(pdf["names"], np.uint64), return_counts=True)
        bits = np.zeros(slots, bool)
        bits[(found[times > 1] & np.uint64(slots - 1)).astype(np.int64)] = True
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "bits": [np.packbits(bits).tobytes()]})

    counted = docs.select("text").mapInPandas(count, "bucket int, names binary")
    rows = local(counted.groupBy("bucket").applyInPandas(shared, "bucket int, bits binary"))
    bitmap = np.zeros((parts, slots // 8), np.uint8)
    for b, bits in zip(rows["bucket"], rows["bits"]):
        bitmap[b] = np.frombuffer(bits, np.uint8)
    return bitmap


def known(name: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    parts, width = bitmap.shape
    row = ((name >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
    slot = (name & np.uint64(width * 8 - 1)).astype(np.int64)
    return (bitmap[row, slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def window_hashes(word_hashes: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits of the words of each window."""
    one, two = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    for k in range(window):
        word = word_hashes[at + k]
        one += word * FACTORS[0, k % 4096] + np.uint64(k // 4096)
        two += word * FACTORS[1, k % 4096]
    return mixed(one), (mixed(two) >> np.uint64(32)).astype(np.uint32)


def candidates(word_hashes, doc, first, window: int, rounds: int, bitmap: np.ndarray) -> np.ndarray:
    """Starts of the windows that may repeat."""
    n = len(word_hashes)
    if n < window:
        return np.empty(0, np.int64)
    name, start, end = names(word_hashes, doc, rounds)
    alone = (end - start <= window) & ~known(name, bitmap)
    low, high = np.maximum(end[alone] - window, 0), start[alone]
    some = low <= high
    shift = np.zeros(n + 2, np.int64)
    np.add.at(shift, low[some], 1)
    np.add.at(shift, high[some] + 1, -1)
    free = np.cumsum(shift)[: n - window + 1] == 0
    return np.flatnonzero(free & (doc[: n - window + 1] == doc[window - 1 :]))


def later(ids, texts, starts, one, two) -> np.ndarray:
    """Which entries have an equal window earlier, by (doc_id, text hash, start)."""
    order = np.lexsort((starts, texts, ids, two, one))
    out = np.zeros(len(order), bool)
    if len(order):
        o, t, d, x, s = one[order], two[order], ids[order], texts[order], starts[order]
        new = np.append(True, (o[1:] != o[:-1]) | (t[1:] != t[:-1]))
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        out[order] = (d != d[head]) | (x != x[head]) | (s != s[head])
    return out


ENTRY = "bucket int, grp binary, ids binary, texts binary, starts binary, one binary, two binary"
NULL_ID = np.iinfo(np.int64).max


def later_windows(docs: DataFrame, window: int, rounds: int, bitmap: np.ndarray) -> DataFrame:
    """``grp`` with the windows to cut: blobs of doc_id, text hash and start."""
    spark = docs.sparkSession
    parts = buckets(spark)
    shared = spark.sparkContext.broadcast(bitmap)

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for rows, held in chunks(batches, raw_words):
            word_hashes, doc, first = parsed(held, hashes)
            at = candidates(word_hashes, doc, first, window, rounds, shared.value)
            if not len(at):
                continue
            one, two = window_hashes(word_hashes, at, window)
            of = doc[at]
            grp, ids, texts = (rows[c].to_numpy(np.int64)[of] for c in ("grp", "doc_id", "text_hash"))
            starts = (at - first[of]).astype(np.int32)
            drop = later(ids, texts, starts, one, two)
            keep = ~drop
            bucket = ((one >> np.uint64(24)) % np.uint64(parts)).astype(np.int64)
            columns = (grp, ids, texts, starts, one, two)
            out = [(b, *blobs) for b, blobs in dealt(bucket[keep], *(c[keep] for c in columns))]
            spot = (grp[drop] // 64) % parts  # known already: these only pass through
            out += [(b, *blobs, b"", b"") for b, blobs in dealt(spot, grp[drop], ids[drop], texts[drop], starts[drop])]
            yield pd.DataFrame(out, columns=["bucket", "grp", "ids", "texts", "starts", "one", "two"])

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        open_, done = pdf[pdf["one"].str.len() > 0], pdf[pdf["one"].str.len() == 0]
        kinds = {"grp": np.int64, "ids": np.int64, "texts": np.int64, "starts": np.int32}
        cols = [joined(open_[c], k) for c, k in kinds.items()]
        drop = later(cols[1], cols[2], cols[3], joined(open_["one"], np.uint64), joined(open_["two"], np.uint32))
        cols = [np.append(c[drop], joined(done[name], k)) for c, (name, k) in zip(cols, kinds.items())]
        out = [(b, *blobs) for b, blobs in dealt(cols[0], *cols[1:])]
        return pd.DataFrame(out, columns=["grp", "ids", "texts", "starts"])

    return (
        docs.mapInPandas(find, ENTRY)
        .groupBy("bucket")
        .applyInPandas(settle, "grp long, ids binary, texts binary, starts binary")
    )


def cut(found: list[bytes], starts: np.ndarray, window: int) -> tuple[list[bytes], int]:
    """Words outside the windows at ``starts``, and how many are inside."""
    shift = np.zeros(len(found) + 1, np.int64)
    np.add.at(shift, starts, 1)
    np.add.at(shift, starts + window, -1)
    inside = np.cumsum(shift[:-1]) > 0
    return [w for w, gone in zip(found, inside) if not gone], int(inside.sum())


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, bitmap_bytes: int = BITMAP_BYTES
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (the words left, joined by a space) of
    every row of stored ``docs`` (doc_id, text, others).

    A word goes if a window of ``window`` words over it also starts earlier: at a smaller
    doc_id (null is greatest), or earlier in the same text. Texts under one doc_id count in the
    order of their hashes; of equal rows one is judged and the others lose every window. Null,
    empty and short texts keep all their words."""
    groups = max(1, docs.count() // GROUP_ROWS)
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    docs = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(int(NULL_ID))).alias("doc_id"),
        "text",
        text_hash.alias("text_hash"),
    )
    docs = docs.withColumn("grp", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(groups)))
    bitmap = repeated_names(docs, window, rounds, bitmap_bytes)
    flags = later_windows(docs, window, rounds, bitmap)

    def finish(key: tuple, rows: pd.DataFrame, flags: pd.DataFrame) -> pd.DataFrame:
        ids, texts = joined(flags["ids"], np.int64), joined(flags["texts"], np.int64)
        starts = joined(flags["starts"], np.int32).astype(np.int64)
        order = np.lexsort((texts, ids))
        ids, texts, starts = ids[order], texts[order], starts[order]
        seen, out = set(), []
        for doc_id, text_hash, text in zip(rows["doc_id"], rows["text_hash"], rows["text"]):
            found = raw_words(text)
            if (doc_id, text_hash) in seen:
                mine = np.arange(max(0, len(found) - window + 1))
            else:
                seen.add((doc_id, text_hash))
                low, high = np.searchsorted(ids, doc_id), np.searchsorted(ids, doc_id, "right")
                mine = starts[low:high][texts[low:high] == text_hash]
            kept, removed = cut(found, mine, window) if len(mine) else (found, 0)
            out.append((None if doc_id == NULL_ID else doc_id, len(found), removed, b" ".join(kept).decode()))
        out = pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept"])
        return out.astype({"doc_id": "Int64"})

    return (
        docs.groupBy("grp")
        .cogroup(flags.groupBy("grp"))
        .applyInPandas(finish, "doc_id long, n_words long, n_removed long, kept string")
    )


@query
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document when repeated passages are cut."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH t AS (
    SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS seq
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM t WHERE len(w) >= 20)
), ranked AS (
    SELECT doc_id, i, row_number() OVER (PARTITION BY seq ORDER BY doc_id, i) AS r FROM windows
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM ranked WHERE r > 1
), lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
words AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM t),
kept AS (
    SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS s
    FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT t.doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM t LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
