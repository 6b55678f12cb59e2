"""Ranked lexical search through bit-sliced Bloom signatures.

A document's signature is a Bloom filter of its terms; a term that occurs at least ``TIERS[j]``
times is in it once more for each such j. Documents whose signatures have the same width are
kept in blocks, sliced by bit: one bitmap of documents per bit. The bitmaps of a term's bits,
joined by AND, mark all documents that hold it so often, and some others, so the item's weights
summed over these bitmaps, each times the most that so many occurrences can add, are an upper
bound of every document's score. The documents with the best bounds are scored exactly, which
gives a score that the last place on an item's list reaches at least; then all documents whose
bound reaches it are scored exactly. No document is left out that could be on the list.
"""

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.llm.common import local, mixed, numbered, query, table
from skyloom.sources.lake import fits, staged

TOP = 50
TIERS = (1, 2, 3, 5, 9, 17, 33)
HASHES = 6
BITS_PER_ENTRY = 16
BLOCK_BITS = 1 << 19
MOST_ROWS = 512
TURN_TERMS = 20_000
MAX_ROWS = 2_000_000
STEPS = np.arange(len(TIERS), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
# Bytes that belong to a term are digits, letters and all from 0x80; A-Z fall to a-z.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(TERM_BYTES).split() if text else []


def positions(entries: np.ndarray, width: int) -> np.ndarray:
    """The HASHES bits (columns) of each entry in a signature of ``width`` bits, a power of two."""
    first, step = entries & np.uint64(0xFFFFFFFF), (entries >> np.uint64(32)) | np.uint64(1)
    nth = np.arange(HASHES, dtype=np.uint64)
    return ((first[:, None] + nth * step[:, None]) & np.uint64(width - 1)).astype(np.int64)


def hashed(found) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))


def block_rows(width: int) -> int:
    return int(np.clip(BLOCK_BITS // width, 8, MOST_ROWS))


def index(docs: DataFrame) -> DataFrame:
    """Stored blocks: width, rows, tokens (sum), marks and sizes (of the documents, as 64-bit
    numbers), slices (bit by bit, eight documents a byte). ``docs`` has mark and text."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pending = defaultdict(list)

        def block(width: int) -> tuple:
            held = pending.pop(width)
            bits = np.zeros((width, -(-len(held) // 8) * 8), np.uint8)
            for row, (_, _, entries) in enumerate(held):
                bits[positions(entries, width).ravel(), row] = 1
            marks, sizes = (np.array([h[k] for h in held], "<i8") for k in (0, 1))
            slices = np.packbits(bits, axis=1, bitorder="little").tobytes()
            return width, len(held), int(sizes.sum()), marks.tobytes(), sizes.tobytes(), slices

        for batch in batches:
            out = []
            for mark, text in zip(batch["mark"].to_list(), batch["text"]):
                words = terms(text)
                if not words:
                    continue
                counted = Counter(words)
                x = hashed(counted)
                often = np.fromiter(counted.values(), np.int64, len(counted))
                entries = [x] + [x[often >= tier] + STEPS[j] for j, tier in enumerate(TIERS) if j and often.max() >= tier]
                entries = mixed(np.concatenate(entries))
                width = max(64, 1 << (len(entries) * BITS_PER_ENTRY - 1).bit_length())
                pending[width].append((mark, len(words), entries))
                if len(pending[width]) == block_rows(width):
                    out.append(block(width))
            if out:
                yield pd.DataFrame(out, columns=columns)
        for width in list(pending):
            yield pd.DataFrame([block(width)], columns=columns)

    schema = "width int, rows int, tokens long, marks binary, sizes binary, slices binary"
    columns = [c.split()[0] for c in schema.split(", ")]
    return staged(docs.select("mark", "text").mapInPandas(task, schema), "slices")


def item_terms(items: DataFrame) -> DataFrame:
    """(row_id, term): the different terms of every item (row_id, text)."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(i, t) for i, text in zip(batch["row_id"].to_list(), batch["text"]) for t in set(terms(text))]
            yield pd.DataFrame(found, columns=["row_id", "term"])

    return items.mapInPandas(task, "row_id long, term binary")


def frequencies(docs: DataFrame, wanted: DataFrame, turns: int) -> DataFrame:
    """(term, df): the documents that hold each of the stored ``wanted`` (term), if any does. One
    pass over the texts a turn, each with the terms of one turn."""
    found = None
    for turn in range(turns):
        mine = wanted.filter(F.pmod(F.xxhash64("term"), F.lit(turns)) == turn)
        words = frozenset(bytes(t) for t in local(mine.select("term"))["term"])

        def task(batches: Iterator[pd.DataFrame], words=words) -> Iterator[pd.DataFrame]:
            counted = Counter()
            for batch in batches:
                for text in batch["text"]:
                    counted.update(words.intersection(terms(text)))
            yield pd.DataFrame({"term": list(counted.keys()), "df": list(counted.values())})

        rows = docs.select("text").mapInPandas(task, "term binary, df long")
        found = rows if found is None else found.unionByName(rows)
    return found.groupBy("term").agg(F.sum("df").alias("df"))


class Items:
    """The items of one turn with their terms and weights."""

    def __init__(self, rows: pd.DataFrame, documents: int, tokens: int):
        self.documents, self.tokens = documents, tokens
        codes, names = pd.factorize(rows["row_id"])
        self.names = names.tolist()
        self.place = {name: k for k, name in enumerate(self.names)}
        words, vocabulary = pd.factorize(pd.Series([bytes(t) for t in rows["term"]], dtype=object))
        self.vocabulary = list(vocabulary)
        self.entries = codes, words, rows["weight"].to_numpy()
        self.weights = [[] for _ in self.names]
        for code, word, weight in zip(codes.tolist(), words.tolist(), rows["weight"].tolist()):
            self.weights[code].append((self.vocabulary[word], weight))

    def mean_share(self, sizes):
        """A document's m."""
        return 50 + (50 * sizes * self.documents) // self.tokens

    def score(self, item: int, counted: Counter, size: int) -> int:
        m, total = self.mean_share(size), 0
        for term, weight in self.weights[item]:
            if often := counted.get(term):
                total += weight * (1_000_000_000 * often // (1000 * often + 20 * m))
        return total

    def bounds(self) -> "Bounds":
        return Bounds(self)


class Bounds:
    """Upper bounds of the items' scores for the documents of a block."""

    def __init__(self, items: Items):
        self.items = items
        codes, words, weight = items.entries
        self.matrix = np.zeros((len(items.vocabulary), len(items.names)))
        self.matrix[words, codes] = weight
        self.hashes = hashed(items.vocabulary)
        self.bits = {}

    def rows_of(self, width: int, tier: int) -> np.ndarray:
        if (width, tier) not in self.bits:
            self.bits[width, tier] = positions(mixed(self.hashes + STEPS[tier]), width)
        return self.bits[width, tier]

    def __call__(self, block) -> tuple[np.ndarray, np.ndarray]:
        """The block's marks, and bounds by document and item. Sums of whole numbers below 2**53
        are exact in doubles."""
        sizes, marks = np.frombuffer(block.sizes, "<i8"), np.frombuffer(block.marks, "<i8")
        slices = np.frombuffer(block.slices, np.uint8).reshape(block.width, -1)
        m = self.items.mean_share(sizes)
        total, before = np.zeros((len(sizes), len(self.items.names))), 0
        some, upper = np.arange(len(self.hashes)), None
        for tier in range(len(TIERS)):
            bits = self.rows_of(block.width, tier)[some]
            present = slices[bits[:, 0]]
            for k in range(1, HASHES):
                present = present & slices[bits[:, k]]
            if upper is not None:
                present &= upper
            kept = present.any(axis=1)
            some, upper = some[kept], present[kept]
            if not len(some):
                break
            often = np.minimum(TIERS[tier + 1] - 1, sizes) if tier + 1 < len(TIERS) else sizes
            most = 1_000_000_000 * often // (1000 * often + 20 * m)
            held = np.unpackbits(upper, axis=1, count=len(sizes), bitorder="little").T.astype(float)
            total += (most - before)[:, None] * (held @ self.matrix[some])
            before = most
        return marks, total


def seeds(blocks: DataFrame, items: Items, top: int) -> DataFrame:
    """(item, mark): the documents with the ``top`` greatest bounds of each item."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bounds, most = items.bounds(), len(items.names)
        best, whose = np.zeros((0, most)), np.zeros((0, most), np.int64)
        for batch in batches:
            for block in batch.itertuples():
                marks, found = bounds(block)
                best = np.concatenate([best, found])
                whose = np.concatenate([whose, np.broadcast_to(marks[:, None], found.shape)])
                if len(best) > top:
                    order = np.argpartition(-best, top - 1, axis=0)[:top]
                    best, whose = (np.take_along_axis(x, order, axis=0) for x in (best, whose))
        row, item = np.nonzero(best > 0)
        yield pd.DataFrame({"item": item, "mark": whose[row, item], "bound": best[row, item]})

    found = blocks.mapInPandas(task, "item int, mark long, bound double")
    order = Window.partitionBy("item").orderBy(F.desc("bound"), "mark")
    return found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= top).select("item", "mark")


def reaching(blocks: DataFrame, items: Items, least: np.ndarray) -> DataFrame:
    """(item, mark): all documents whose bound is the item's ``least`` or more."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bounds = items.bounds()
        for batch in batches:
            for block in batch.itertuples():
                marks, found = bounds(block)
                row, item = np.nonzero(found >= least)
                yield pd.DataFrame({"item": item, "mark": marks[row]})

    return blocks.mapInPandas(task, "item int, mark long")


def scored(docs: DataFrame, chosen: DataFrame, items: Items, top: int) -> DataFrame:
    """Stored (item, doc_id, score, rank): the ``top`` best of the ``chosen`` (item, mark), scored
    exactly. A mark may stand for several rows; each is scored."""
    lists = staged(chosen.groupBy("mark").agg(F.collect_set("item").alias("items")), "chosen")
    if fits(lists, MAX_ROWS):
        lists = F.broadcast(lists)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, known, text, wanted in zip(*(batch[c] for c in ("doc_id", "known", "text", "items"))):
                words = terms(text)
                counted = Counter(words)
                out += [(item, doc_id, known, items.score(item, counted, len(words))) for item in wanted]
            yield pd.DataFrame(out, columns=["item", "doc_id", "known", "score"])

    rows = docs.join(lists, "mark").select("doc_id", "known", "text", "items")
    rows = rows.mapInPandas(task, "item int, doc_id long, known boolean, score long").filter("score > 0")
    rows = rows.select("item", F.when(F.col("known"), F.col("doc_id")).alias("doc_id"), "score")
    order = Window.partitionBy("item").orderBy(F.desc("score"), "doc_id")
    return staged(rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top), "scored")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``top`` rows of ``docs`` (doc_id, text,
    others) with the highest scores above 0 for every row of ``items`` (item_id, text, others),
    equal scores by ascending doc_id, null first.

    Terms are runs of digits, ASCII letters in lower case and other characters; null has none.
    Items without terms find nothing; items that share an id are ranked apart, and rows that
    share a doc_id too. Either table may be empty. Items go through in turns of about TURN_TERMS
    terms, so what goes to the tasks is bounded; an item that alone has more is a turn of its
    own size."""
    doc_id = F.col("doc_id").cast("bigint")
    docs = docs.select(
        F.coalesce(doc_id, F.lit(0)).alias("doc_id"),
        doc_id.isNotNull().alias("known"),
        "text",
        F.xxhash64("doc_id", "text").alias("mark"),
    )
    blocks = index(docs)
    extent = blocks.agg(F.sum("rows").alias("documents"), F.sum("tokens").alias("tokens")).first()
    items = staged(numbered(items, "item_id", "text"), "items")
    wanted = staged(item_terms(items.select("row_id", "text")), "item_terms")
    turns = -(-wanted.count() // TURN_TERMS)
    kinds = dict(items.dtypes)
    if not extent.documents or not turns:
        return items.sparkSession.createDataFrame([], f"item_id {kinds['item_id']}, rank int, doc_id long, score long")
    vocabulary = staged(wanted.select("term").distinct(), "vocabulary")
    known = frequencies(docs, vocabulary, -(-vocabulary.count() // TURN_TERMS))
    ratio = F.lit(2 * extent.documents + 2).cast("double") / (2 * F.col("df") + 1)
    weights = known.select("term", F.floor(1000 * F.log(ratio)).alias("weight"))
    weighted = staged(wanted.join(weights, "term").withColumn("turn", F.pmod(F.xxhash64("row_id"), F.lit(turns))), "weights")
    out = None
    for turn in range(turns):
        rows = local(weighted.filter(F.col("turn") == turn).select("row_id", "term", "weight"))
        if rows.empty:
            continue
        mine = Items(rows, extent.documents, extent.tokens)
        first = scored(docs, seeds(blocks, mine, top), mine, top)
        least = np.ones(len(mine.names))
        for row in first.filter(F.col("rank") == top).collect():  # at most one row an item
            least[row.item] = row.score
        best = scored(docs, reaching(blocks, mine, least), mine, top)
        names = items.sparkSession.createDataFrame(list(enumerate(mine.names)), "item int, row_id long")
        best = best.join(F.broadcast(names), "item").drop("item")
        out = best if out is None else out.unionByName(best)
    if out is None:
        return items.sparkSession.createDataFrame([], f"item_id {kinds['item_id']}, rank int, doc_id long, score long")
    return out.join(items.select("row_id", "item_id"), "row_id").select("item_id", "rank", "doc_id", "score")


@query
def op11_bit_sliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents for every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS MATERIALIZED (
    SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), items AS MATERIALIZED (
    SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w
    FROM benchmark
), terms AS (SELECT i, item_id, unnest(w) AS term FROM items),
totals AS (SELECT count(*) FILTER (len(w) > 0) AS docs, sum(len(w))::BIGINT AS tokens FROM d),
tf AS MATERIALIZED (
    SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(w) AS term FROM d)
    WHERE term IN (SELECT term FROM terms) GROUP BY k, term
), weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM tf, totals GROUP BY term, docs
), shares AS (SELECT k, doc_id, 50 + (50 * len(w) * docs) // tokens AS m FROM d, totals),
scores AS (
    SELECT i, item_id, k, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM terms JOIN weights USING (term) JOIN tf USING (term) JOIN shares USING (k) GROUP BY i, item_id, k, doc_id
)
SELECT item_id, rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank FROM scores WHERE score > 0
) WHERE rank <= 50
"""
