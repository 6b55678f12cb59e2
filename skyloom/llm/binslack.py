"""Best-fit packing by minimum bin slack (Gupta and Ho, 1999), over a histogram of lengths.

Documents longer than a sequence are cut into whole sequences and a rest. What is left is a
count for each length below that of a sequence, so the bins are planned by length: the longest
length left opens a bin, and a subset-sum table, kept as a bitset with one bit for each fill,
finds the fullest combination of lengths there still are. It is made as often as the counts
allow, which is what repeating the search would do, and removed. Documents are dealt to the bins
by their rank within their length; the plan gives the place in the sequence too.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import numbered, query, table
from skyloom.llm.packing import ranked, running
from skyloom.llm.tokenizing import encoder
from skyloom.sources.lake import staged

LENGTH = 4096
END_ID = 1
#: Ranks of one length are below this.
RANKS = 40


def fullest(counts: np.ndarray, lengths: list[int], room: int) -> dict[int, int]:
    """The combination of ``lengths`` (descending, as often as ``counts`` has them) that fills
    ``room`` best; of equal ones, one with the longest lengths."""
    mask, full = (1 << (room + 1)) - 1, 1 << room
    reached, steps = 1, []
    for length in lengths:
        if length > room:
            continue
        for _ in range(min(int(counts[length]), room // length)):
            more = reached | (reached << length) & mask
            if more == reached:
                break
            steps.append((length, reached))
            reached = more
        if reached & full:
            break
    fill, chosen = reached.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> fill & 1:  # this copy is what first reached the fill
            chosen[length] = chosen.get(length, 0) + 1
            fill -= length
    return chosen


def plan(counts: np.ndarray, length: int) -> list[tuple[dict[int, int], int]]:
    """Combinations (length -> copies) and how often each is made, until ``counts`` (by length,
    each at most ``length``) is used up."""
    left, out = counts.copy(), []
    lengths = [int(x) for x in np.flatnonzero(left)[::-1]]
    while lengths:
        longest = lengths[0]
        left[longest] -= 1
        chosen = fullest(left, lengths, length - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(int(left[x]) // n for x, n in chosen.items())
        for x, n in chosen.items():
            left[x] -= times * n
        out.append((chosen, times))
        lengths = [x for x in lengths if left[x]]
    return out


def spans(chosen: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """What ranks of each length get, as rows (length << RANKS | first rank, copies in a bin,
    first sequence, offset of the first copy), ascending."""
    out, used, sequence = [], {}, 0
    for need, times in chosen:
        offset = 0
        for length, copies in sorted(need.items(), reverse=True):
            first = used.get(length, 0)
            out.append((length << RANKS | first, copies, sequence, offset))
            used[length] = first + copies * times
            offset += length * copies
        sequence += times
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def pieces(docs: DataFrame, tokenizer: str, length: int, end_id: int, with_ids: bool) -> DataFrame:
    """The stored pieces of every row: row_id, doc_id (0 where not ``known``), known, piece,
    start, length, ids_crc32, and ``ids`` if asked for."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(tokenizer)
        for batch in batches:
            out = []
            for row_id, doc_id, known, text in zip(*(batch[c] for c in ("row_id", "doc_id", "known", "text"))):
                ids = np.append(own.encode(text), end_id).astype("<u4")
                for piece, start in enumerate(range(0, len(ids), length)):
                    part = ids[start : start + length]
                    line = (row_id, doc_id, known, piece, start, len(part), zlib.crc32(part.tobytes()))
                    out.append((*line, part.astype(np.int32)) if with_ids else line)
            yield pd.DataFrame(out, columns=columns)

    schema = "row_id long, doc_id long, known boolean, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" * with_ids
    columns = [c.split()[0] for c in schema.split(", ")]
    doc_id = F.col("doc_id").cast("bigint")
    rows = numbered(docs, F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNotNull().alias("known"), "text")
    return staged(rows.mapInPandas(task, schema), "pieces")


def arranged(rests: DataFrame, length: int) -> tuple[DataFrame, int]:
    """``rests`` (row_id, length, others) with ``sequence_id`` and ``offset``; and the number of
    sequences made."""
    counts = np.zeros(length + 1, np.int64)
    for row in rests.groupBy("length").count().collect():  # at most one row a length
        counts[row["length"]] = row["count"]
    chosen = plan(counts, length)
    table = spans(chosen)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = table[:, 0]
        for batch in batches:
            key = (batch["length"].to_numpy() << RANKS) | batch["rank"].to_numpy()
            first, copies, sequence, offset = table[np.searchsorted(keys, key, side="right") - 1].T
            nth = key - first
            place = offset + nth % copies * batch["length"].to_numpy()
            yield batch.drop(columns=["rank", "bin"]).assign(sequence_id=sequence + nth // copies, offset=place)

    rows = ranked(rests.withColumn("bin", F.col("length").cast("int"))).select(*rests.columns, "bin", "rank")
    kinds = ", ".join(f"{c} {kind}" for c, kind in rests.dtypes)
    return rows.mapInPandas(task, f"{kinds}, sequence_id long, offset long"), sum(times for _, times in chosen)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = True) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text, others): doc_id, piece, start, length,
    ids_crc32, sequence_id, offset, and ``ids`` if asked for. ``tokenizer`` is a file of the
    tokenizers library that every executor has at this path.

    A document is its ids and then ``end_id``, so null and empty texts are one token. One longer
    than ``length`` is cut into pieces of it and a last, shorter one; others stay whole. Rows may
    repeat or share a doc_id; an empty table gives no pieces."""
    found = pieces(docs, tokenizer, length, end_id, with_ids)
    own = ["row_id", "doc_id", "known", "piece", "start", "length", "ids_crc32"]
    packed, made = arranged(found.filter(F.col("length") < length).select(*own), length)
    whole = found.filter(F.col("length") == length).select(*own)
    many = running(whole.groupBy("row_id").agg(F.count("*").alias("many")), "row_id", F.col("many"), "earlier")
    whole = whole.join(many.select("row_id", "earlier"), "row_id")
    sequence = (F.col("earlier") + F.col("piece") + made).cast("long").alias("sequence_id")
    out = packed.unionByName(whole.select(*own, sequence, F.lit(0).cast("long").alias("offset")))
    if with_ids:
        out = out.join(found.select("row_id", "piece", "ids"), ["row_id", "piece"])
    doc_id = F.when(F.col("known"), F.col("doc_id")).alias("doc_id")
    return out.select(doc_id, *own[3:], "sequence_id", "offset", *["ids"] * with_ids)


@query
def op12_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in as few sequences of 4096 tokens as minimum bin slack finds."""
    from public_tokenizers import path

    return pack(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"), with_ids=False)
