"""Benchmark decontamination: token windows of the documents against a hash set of the windows
of the benchmark, in built-in functions only.

The set of window hashes goes to every task with the plan while it holds at most MAX_HASHES
numbers; a document's windows are hashed in place and only hits leave its row. Hits are verified
by joining on the words themselves. A larger benchmark skips the set: then every window of a
document is joined. Results are the same.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import query, table
from skyloom.sources.lake import staged

WINDOW = 10
MAX_HASHES = 50_000
MAX_BROADCAST_BYTES = 16 << 20
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def normal_words(text: Column) -> Column:
    """Words in order, A-Z in lower case; none of a null text."""
    lowered = F.translate(F.coalesce(text, F.lit("")), LETTERS, LETTERS.lower())
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def benchmark_windows(benchmark: DataFrame, window: int) -> DataFrame:
    """``words`` joined by spaces, ``size`` in words, ``hash``, and ``items`` that hold them."""
    items = benchmark.select("item_id", normal_words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(window))
    slices = F.transform(F.sequence(F.lit(1), F.size("w") - size + 1), lambda i: F.slice("w", i, size))
    rows = items.select("item_id", F.explode(slices).alias("w"))
    rows = rows.select("item_id", F.array_join("w", " ").alias("words"), F.size("w").alias("size"), F.xxhash64("w").alias("hash"))
    return rows.groupBy("words", "size", "hash").agg(F.collect_set("item_id").alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_hashes: int = MAX_HASHES) -> DataFrame:
    """``row_id``, ``doc_id``, ``n_words``, ``spans`` (position from 1 and length in words of each
    window found, in order) and ``items`` of every row of ``docs`` (doc_id, text, others)."""
    windows = staged(benchmark_windows(benchmark, window), "benchmark")
    extent = windows.agg(
        F.count("*").alias("n"),
        F.sum(F.length("words") + 8 * F.size("items")).alias("bytes"),
        F.collect_set("size").alias("sizes"),
    ).first()
    hashes = {}
    if extent.n <= max_hashes:
        for size, number in windows.select("size", "hash").collect():
            hashes.setdefault(size, []).append(number)
    found = []
    for size in sorted(extent.sizes):
        starts = f"sequence(1, size(w) - {size - 1})"
        if size in hashes:
            listed = ", ".join(f"{number}L" for number in hashes[size])
            starts = f"filter({starts}, i -> xxhash64(slice(w, i, {size})) IN ({listed}))"
        struct = f"struct(i AS at, {size} AS size, array_join(slice(w, i, {size}), ' ') AS words)"
        found.append(f"if(size(w) < {size}, array(), transform({starts}, i -> {struct}))")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", normal_words(F.col("text")).alias("w")
    )
    if not found:
        return rows.select(
            "row_id", "doc_id", F.size("w").cast("long").alias("n_words"),
            F.expr("cast(array() as array<struct<at: int, size: int>>)").alias("spans"),
            F.expr(f"cast(array() as array<{dict(benchmark.dtypes)['item_id']}>)").alias("items"),
        )
    spots = F.expr(f"concat({', '.join(found)})" if len(found) > 1 else found[0])
    rows = rows.select("row_id", "doc_id", F.size("w").cast("long").alias("n_words"), F.explode_outer(spots).alias("hit"))
    rows = rows.select("row_id", "doc_id", "n_words", "hit.at", "hit.size", "hit.words")
    windows = windows.select("words", "items", F.lit(True).alias("real"))
    if (extent.bytes or 0) <= MAX_BROADCAST_BYTES:
        windows = F.broadcast(windows)
    span = F.when(F.col("real"), F.struct("at", "size"))
    return (
        rows.join(windows, "words", "left")
        .groupBy("row_id", "doc_id", "n_words")
        .agg(
            F.array_sort(F.collect_set(span)).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
    )


def covered(spans: Column) -> Column:
    """Words inside any of the sorted spans."""

    def add(state, span):
        last = (span["at"] + span["size"] - 1).cast("long")
        more = F.greatest(F.lit(0).cast("long"), last - F.greatest(state["last"], span["at"].cast("long") - 1))
        return F.struct(F.greatest(state["last"], last).alias("last"), (state["n"] + more).alias("n"))

    start = F.struct(F.lit(0).cast("long").alias("last"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, start, add, lambda state: state["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated`` and
    ``spans`` of every row of ``docs`` (doc_id, text, others).

    A window is ``window`` consecutive words of an item, or all words of a shorter one; words
    inside any occurrence are hit. Null and wordless texts have no words and no hits, items
    without words no windows. Items that share an id count once; null ids mark words but are not
    listed. Rows may repeat."""
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    found = hits(docs, benchmark, window).withColumn("n_hit", covered(F.col("spans")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "spans",
    )


def text_key(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` without a benchmark window, all columns as they are. What counts is
    the text, so rows are told apart by its MD5."""
    found = hits(docs.select(text_key(F.col("text")).alias("doc_id"), "text"), benchmark, window)
    bad = staged(found.filter(F.size("spans") > 0).select(F.col("doc_id").alias("bad_key")).distinct(), "contaminated")
    return docs.join(bad, text_key(docs["text"]) == bad["bad_key"], "left_anti")


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside windows of benchmark items."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


OP4_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), b AS (
    SELECT item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), items AS (
    SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS words
    FROM (SELECT item_id, w, least(len(w), 10) AS size, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i
          FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM items),
windows AS (
    SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS words
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d JOIN sizes ON len(w) >= size)
), found AS (SELECT doc_id, size, i, item_id FROM windows JOIN items USING (size, words)),
words AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY 1
), names AS (
    SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(names.n, 0) AS n_items,
    sha256(coalesce(s, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN names USING (doc_id)
"""
