"""Packing documents into training sequences by non-negative least squares over a histogram.

A document longer than a sequence gives whole sequences first. What is left of each is counted
by length, rounded up to ``GRID``-ths of a sequence. Shallow combinations of lengths that fill a
sequence are enumerated, and non-negative least squares (Lawson and Hanson, 1974) finds how
often to repeat each so that the histogram is used up. The counts are rounded down; documents
are dealt to them by their rank within their length. The residual documents are laid end to end
and cut to fill, in order, what the combinations leave open, then sequences of their own, and
the last of them sequences of powers of two.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.llm.common import numbered, query, table
from skyloom.llm.tokenizing import CACHED, encoder, forget
from skyloom.sources.lake import broadcast_within, staged

LENGTH = 4096
GRID = 64
PARTS = 4
END_ID = 2
SPARE = 1.1
BLOCK_BITS = 14
CELL = 1 << 16
MAX_MARKS = 4_000_000


def combinations(grid: int = GRID, parts: int = PARTS) -> np.ndarray:
    """Columns of counts of the lengths 1..grid: all ways to fill a sequence with up to
    ``parts`` lengths, and every length as often as it fits with one that fills the rest."""
    found = set()

    def extend(chosen: tuple, left: int, least: int) -> None:
        if left == 0:
            found.add(chosen)
        elif len(chosen) == parts - 1:
            if left >= least:
                found.add((*chosen, left))
        else:
            for size in range(least, left + 1):
                extend((*chosen, size), left - size, size)

    extend((), grid, 1)
    for size in range(1, grid + 1):
        often, rest = divmod(grid, size)
        found.add(tuple(sorted([size] * often + [rest] * (rest > 0))))
    out = np.zeros((grid, len(found)))
    for column, chosen in enumerate(sorted(found)):
        np.add.at(out[:, column], np.array(chosen) - 1, 1)
    return out


def nonnegative(a: np.ndarray, b: np.ndarray, rounds: int = 500) -> np.ndarray:
    """x >= 0 that minimises |a x - b|: columns enter by their gradient and leave when their
    solution turns negative."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(rounds):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        enter = int(np.argmax(gradient))
        if gradient[enter] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        active[enter] = True
        while True:
            free = np.flatnonzero(active)
            solved = np.linalg.lstsq(a[:, free], b, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[free] = solved
                break
            bad = solved <= 0
            step = (x[free][bad] / (x[free][bad] - solved[bad] + 1e-300)).min()
            x[free] += step * (solved - x[free])
            active[free[x[free] <= 1e-12]] = False
            x[~active] = 0
            if not active.any():
                break
    return x


def plan(counts: np.ndarray, sums: np.ndarray, length: int) -> list[tuple[np.ndarray, int]]:
    """Combinations (counts by length) and how often each is made. Fewer are made if else the
    residual tokens would not fill what they leave open by a margin of SPARE."""
    grid = len(counts)
    if not counts.any():
        return []
    columns = combinations(grid)
    scale = counts.sum()
    solved = nonnegative(columns, counts / scale) * scale
    mean = np.divide(sums, counts, out=np.zeros(grid), where=counts > 0)
    for share in np.linspace(1.0, 0.0, 51):
        left, chosen, open_, used = counts.copy(), [], 0.0, 0.0
        for c in np.argsort(-solved, kind="stable"):
            need = columns[:, c].astype(np.int64)
            times = min(int(solved[c] * share), int((left[need > 0] // need[need > 0]).min()))
            if times > 0:
                left -= times * need
                chosen.append((need, times))
                used += times * float(need @ mean)
                open_ += times * (length - float(need @ mean))
        if sums.sum() - used >= SPARE * open_:
            return chosen
    return []


def running(df: DataFrame, number: str, value, into: str) -> DataFrame:
    """``df`` with ``into``: the sum of ``value`` over rows of a smaller ``number``. Blocks of
    numbers are summed apart; only their totals meet in one place."""
    df = df.withColumn("block", F.shiftright(number, BLOCK_BITS)).withColumn("value", value)
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy("block").agg(F.sum("value").alias("total"))
    totals = totals.select("block", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("block").orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    rows = df.withColumn("inner", F.coalesce(F.sum("value").over(inside), F.lit(0)))
    rows = rows.join(totals, "block").withColumn(into, (F.col("base") + F.col("inner")).cast("long"))
    return rows.drop("block", "value", "inner", "base")


def ranked(rests: DataFrame) -> DataFrame:
    """``rank`` of each row among those of its ``bin``, from 0, by row number. A common bin is
    ranked block by block."""
    rows = rests.withColumn("block", F.shiftright("row_id", BLOCK_BITS))
    sizes = rows.groupBy("bin", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bin").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("bin", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("bin", "block").orderBy("row_id")
    rows = rows.withColumn("inner", F.row_number().over(inside) - 1).join(sizes, ["bin", "block"])
    return rows.withColumn("rank", (F.col("base") + F.col("inner")).cast("long")).drop("block", "base", "inner")


def assigned(rests: DataFrame, chosen: list[tuple[np.ndarray, int]]) -> DataFrame:
    """``sequence_id`` of every row by its rank within its bin; null for residual rows."""
    spans, sequence = {}, 0
    for need, times in chosen:
        for size in np.flatnonzero(need):
            held = spans.setdefault(int(size) + 1, [])
            begin = held[-1][1] if held else 0
            held.append((begin, begin + times * int(need[size]), int(need[size]), sequence))
        sequence += times

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bins, ranks = batch["bin"].to_numpy(), batch["rank"].to_numpy()
            out = np.full(len(batch), -1, np.int64)
            for size in np.unique(bins):
                for begin, end, many, first in spans.get(int(size), []):
                    mine = (bins == size) & (ranks >= begin) & (ranks < end)
                    out[mine] = first + (ranks[mine] - begin) // many
            yield batch[["row_id", "start", "length"]].assign(sequence_id=out)

    out = rests.select("row_id", "start", "length", "bin", "rank").mapInPandas(
        task, "row_id long, start long, length long, sequence_id long"
    )
    return out.withColumn("sequence_id", F.when(F.col("sequence_id") >= 0, F.col("sequence_id")))


def overlaps(holes: DataFrame, fillers: DataFrame, end: int) -> DataFrame:
    """Pieces of ``fillers`` (at, size, row_id, start) that fall into ``holes`` (at, size,
    sequence_id, used); both lie gapless on one line. Each cell of the line is swept once."""

    def starts(df: DataFrame, name: str, *fields: str) -> DataFrame:
        last = F.least(F.col("at") + F.col("size"), F.lit(end)) - 1
        df = df.filter((F.col("at") < end) & (F.col("size") > 0))
        cells = F.sequence(F.floor(F.col("at") / CELL), F.floor(last / CELL))
        df = df.withColumn("cell", F.explode(cells))
        spot = F.greatest("at", F.col("cell") * CELL).alias("spot")
        return df.select("cell", spot, F.struct("at", *fields).alias(name))

    both = starts(holes, "hole", "sequence_id", "used").unionByName(
        starts(fillers, "filler", "row_id", "start"), allowMissingColumns=True
    )
    line = Window.partitionBy("cell").orderBy("spot")
    swept = both.select(
        "spot",
        F.last("hole", ignorenulls=True).over(line).alias("hole"),
        F.last("filler", ignorenulls=True).over(line).alias("filler"),
        F.lead("spot").over(line).alias("next"),
        F.least((F.col("cell") + 1) * CELL, F.lit(end)).alias("stop"),
    )
    swept = swept.withColumn("length", (F.coalesce("next", "stop") - F.col("spot")).cast("long"))
    return swept.filter("length > 0").select(
        F.col("filler.row_id").alias("row_id"),
        (F.col("filler.start") + F.col("spot") - F.col("filler.at")).alias("start"),
        "length",
        F.col("hole.sequence_id").alias("sequence_id"),
        (F.col("hole.used") + F.col("spot") - F.col("hole.at")).alias("offset"),
    )


def arranged(sizes: DataFrame, length: int = LENGTH, grid: int = GRID) -> DataFrame:
    """Pieces (row_id, start, length, sequence_id, offset) of stored ``sizes`` (row_id, n)."""
    spark = sizes.sparkSession
    unit = length // grid
    rests = sizes.select(
        "row_id",
        (F.floor(F.col("n") / length) * length).alias("start"),
        (F.col("n") % length).alias("length"),
        F.ceil((F.col("n") % length) / unit).cast("int").alias("bin"),
    ).filter("length > 0")
    counts, sums = np.zeros(grid, np.int64), np.zeros(grid)
    for row in rests.groupBy("bin").agg(F.count("*").alias("n"), F.sum("length").alias("s")).collect():
        counts[row.bin - 1], sums[row.bin - 1] = row.n, row.s
    chosen = plan(counts, sums, length)
    made = sum(times for _, times in chosen)
    dealt = staged(assigned(ranked(rests), chosen), "dealt")

    inside = dealt.filter("sequence_id is not null")
    order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "row_id")
    sofar = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    pieces = inside.withColumn("offset", F.coalesce(sofar, F.lit(0)))

    whole = sizes.select("row_id", F.floor(F.col("n") / length).alias("many")).filter("many > 0")
    whole = running(whole, "row_id", F.col("many"), "earlier")
    whole = whole.select("row_id", "earlier", F.posexplode(F.sequence(F.lit(1).cast("long"), "many")).alias("k", "_"))
    whole = whole.select(
        "row_id",
        (F.col("k").cast("long") * length).alias("start"),
        F.lit(length).cast("long").alias("length"),
        (F.col("earlier") + F.col("k") + made).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    total = sizes.agg(F.sum(F.floor(F.col("n") / length))).first()[0] or 0

    fillers = dealt.filter("sequence_id is null").withColumnRenamed("length", "size").drop("sequence_id")
    fillers = staged(running(fillers, "row_id", F.col("size"), "at"), "fillers")
    end = fillers.agg(F.sum("size")).first()[0] or 0
    used = inside.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    used = used.withColumn("size", F.lit(length) - F.col("used"))
    holes = staged(running(used, "sequence_id", F.col("size"), "at"), "holes")
    opened = holes.agg(F.sum("size")).first()[0] or 0
    fresh, tail = divmod(max(0, end - opened), length)
    first = made + total
    spot = F.col("id") * length + opened
    rows = spark.range(fresh).select(
        (F.col("id") + first).alias("sequence_id"), F.lit(0).alias("used"), F.lit(length).alias("size"), spot.alias("at")
    )
    holes = holes.unionByName(rows)
    at, sequence, last = opened + fresh * length, first + fresh, []
    for power in (1 << k for k in reversed(range(length.bit_length()))):
        if tail & power:
            last.append((sequence, 0, power, at))
            at, sequence = at + power, sequence + 1
    holes = holes.unionByName(spark.createDataFrame(last, "sequence_id long, used long, size long, at long"))
    return pieces.unionByName(whole).unionByName(overlaps(holes, fillers, end))


def tokenised(docs: DataFrame, path: str, end_id: int, cached: int = CACHED) -> DataFrame:
    """row_id, doc_id, ``n``, ``crc`` and ``ids`` (unsigned 16 or 32 bits) of every row, stored."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(path, cached)
        kind = "<u2" if own.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        for batch in batches:
            ids = [np.append(own.encode(t), end_id).astype("<u4") for t in batch["text"]]
            out = batch[["row_id", "doc_id"]].assign(n=[len(x) for x in ids], width=np.dtype(kind).itemsize)
            yield out.assign(crc=[zlib.crc32(x.tobytes()) for x in ids], ids=[x.astype(kind).tobytes() for x in ids])

    rows = numbered(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = "row_id long, doc_id long, n long, width int, crc long, ids binary"
    return staged(rows.mapInPandas(task, schema), "tokens")


def among(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The ``rows`` whose row_id is in stored ``wanted``, without a shuffle of rows while the row
    numbers, as bits of 64 neighbouring ones, are few enough to be broadcast."""
    bits = F.bit_or(F.expr("shiftleft(1L, cast(row_id & 63 as int))")).alias("bits")
    marks = wanted.groupBy(F.shiftright("row_id", 6).alias("chunk")).agg(bits)
    marks = broadcast_within(staged(marks, "marks"), MAX_MARKS)
    found = rows.withColumn("chunk", F.shiftright("row_id", 6)).join(marks, "chunk")
    return found.filter("shiftright(bits, cast(row_id & 63 as int)) & 1 = 1").drop("chunk", "bits")


def pack(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, end_id: int = END_ID, with_ids: bool = True, cached: int = CACHED
) -> DataFrame:
    """Pieces of every row of ``docs`` (doc_id, text, others): doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, and ``ids`` if asked for. ``tokenizer`` is a file of the
    tokenizers library that every executor has at this path.

    A document is its ids and then ``end_id``, so null and empty texts are one token. Every id
    is in exactly one piece; rows may repeat or share a doc_id. Without ``ids`` only those of
    documents that are cut are shuffled. ``cached`` words are remembered by a worker."""
    tokens = tokenised(docs, tokenizer, end_id, cached)
    pieces = arranged(tokens.select("row_id", "n"), length)
    place = F.struct("start", "length", "sequence_id", "offset")
    lists = pieces.groupBy("row_id").agg(F.collect_list(place).alias("pieces"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for batch in batches:
            out = []
            for row in batch.itertuples():
                ids = np.frombuffer(row.ids, f"<u{row.width}").astype("<u4")
                for piece in row.pieces:
                    part = ids[piece["start"] : piece["start"] + piece["length"]]
                    places = (piece["start"], piece["length"], zlib.crc32(part.tobytes()), row.n)
                    line = (row.doc_id, *places, piece["sequence_id"], piece["offset"])
                    out.append((*line, part.astype(np.int32)) if with_ids else line)
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    schema += ", ids array<int>" * with_ids
    columns = [c.split()[0] for c in schema.split(", ")]
    def parts(rows: DataFrame, lists: DataFrame) -> DataFrame:
        return rows.join(lists.hint("shuffle_hash"), "row_id").drop("row_id").mapInPandas(cut, schema)

    if with_ids:
        return parts(tokens, lists)
    lists = staged(lists, "pieces")
    several = lists.filter("size(pieces) > 1")
    whole = lists.filter("size(pieces) = 1").select("row_id", F.col("pieces")[0].alias("piece"))
    whole = tokens.select("row_id", "doc_id", "n", "crc").join(whole, "row_id")
    whole = whole.select(
        "doc_id", "piece.start", "piece.length", F.col("crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"), "piece.sequence_id", "piece.offset"
    )
    return whole.unionByName(parts(among(tokens, several), several))


@query
def op1_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    from public_tokenizers import path

    return pack(table(spark, sf_dir, "documents"), path("word_bpe_49k.json"), with_ids=False)
