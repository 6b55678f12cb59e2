"""SimHash near-duplicates (Charikar, 2002) found with a vantage-point tree (Yianilos, 1993).

Fingerprints of whole texts are compared once per distinct value. A tree over a bounded sample
of them cuts Hamming space into shards: at each vantage point a fingerprint goes to the inside
(distance up to the node's limit) or the outside. Two fingerprints that link differ in distance
to the vantage point by at most the link radius, so only the inside ones within that margin of
the limit are sent to the outside too, and every linking pair meets in some shard. Each level
sends some rows twice, so the tree stops at DEPTH levels. The bits of a fingerprint are cut into
one segment more than may differ: two that link are equal in one. Inside a shard the rows with an
equal segment are compared, and a group returns a spanning forest, not its pairs.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import local, mixed, numbered, query, table, words
from skyloom.llm.components import components
from skyloom.sources.lake import staged

SHINGLE = 3
RADIUS = 2
SAMPLE = 20_000
LEAF = 4096
DEPTH = 4
BLOCK = 2048
CROWDED = 1 << 14
PAIRS = 1 << 20
SEED = 42
SLICE = 1 << 18


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint; 0 for a text without words."""
    found = words(text)
    if not found:
        return 0
    if len(found) < shingle:
        found = [b" ".join(found)]
        shingle = 1
    runs = zip(*(found[i:] for i in range(shingle)))
    n = len(found) - shingle + 1
    hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(r), SEED) for r in runs), "<u8", n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        bits = np.unpackbits(hashes[at : at + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``row_id``, ``doc_id`` and ``fp`` of every row."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fps = [fingerprint(t, shingle) for t in batch["text"]]
            yield batch[["row_id", "doc_id"]].assign(fp=np.array(fps, np.int64))

    return numbered(docs, F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInPandas(
        task, "row_id long, doc_id long, fp long"
    )


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def grow(sample: np.ndarray, depth: int, rng: np.random.Generator):
    """Nested (vantage point, limit, inside, outside); None where a leaf begins. The limit is a
    median; the vantage point is the one of a few whose distances spread most."""
    if depth == 0 or len(sample) < 8:
        return None
    tries = rng.choice(sample, min(5, len(sample)), replace=False)
    point = max(tries, key=lambda p: float(np.var(distance(sample, p))))
    away = distance(sample, point)
    limit = int(np.median(away))
    inside = away <= limit
    if inside.all():
        return None
    return point, limit, grow(sample[inside], depth - 1, rng), grow(sample[~inside], depth - 1, rng)


def route(tree, values: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, positions) of every shard that values fall or reach into."""
    stack = [(tree, 1, np.arange(len(values)))]
    while stack:
        node, number, at = stack.pop()
        if not len(at):
            continue
        if node is None:
            yield number, at
            continue
        point, limit, near, far = node
        away = distance(values[at], point)
        stack.append((near, 2 * number, at[away <= limit]))
        stack.append((far, 2 * number + 1, at[away > limit - radius]))


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of a square matrix of links: members with links, and the first member of their tree.
    Every row is looked at once."""
    left = linked.sum(axis=1) > 1
    members, roots = [], []
    for seed in np.flatnonzero(left):
        if not left[seed]:
            continue
        front = np.array([seed])
        left[seed] = False
        while len(front):
            members.append(front)
            roots.append(np.full(len(front), seed))
            reached = np.zeros(len(left), bool)
            for part in np.array_split(front, len(front) // 512 + 1):
                reached |= linked[part].any(axis=0)
            front = np.flatnonzero(reached & left)
            left[front] = False
    none = [np.empty(0, np.int64)]
    return np.concatenate(members or none), np.concatenate(roots or none)


def block_pairs(rows: DataFrame, group: str, key: str, block: int) -> DataFrame:
    """Rows of a group dealt into blocks of about ``block`` by hash of ``key``, each block
    pair of a group as one group (``group``, ``i``, ``j``)."""
    sizes = rows.groupBy(group).agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    mine = F.pmod(F.xxhash64(key), F.col("parts")).cast("int")
    pair = F.explode(
        F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda o: F.struct(F.least("mine", o).alias("i"), F.greatest("mine", o).alias("j")),
        )
    )
    dealt = rows.join(sizes, group).withColumn("mine", mine)
    return dealt.withColumn("pair", pair).select(*rows.columns, "mine", "pair.i", "pair.j")


def segments(many: int) -> list[np.uint64]:
    """Masks that cut 64 bits into ``many`` runs."""
    cuts = [64 * k // many for k in range(many + 1)]
    return [np.uint64((1 << b) - (1 << a)) for a, b in zip(cuts, cuts[1:])]


def close_pairs(keys: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Of ascending ``keys``: a spanning forest, as positions of members and of the least member
    of their tree, of the pairs with an equal key whose values differ in at most ``radius`` bits."""
    ends = np.searchsorted(keys, keys, "right")
    at, step, least = np.arange(len(keys)), 1, np.arange(len(keys))
    held, size = [], 0
    while True:
        at = at[at + step < ends[at]]
        if len(at):
            near = at[distance(values[at], values[at + step]) <= radius]
            held.append((near, near + step))
            size += len(near)
        if size > PAIRS or not len(at):
            a, b = (np.concatenate(x) for x in zip(*held)) if held else (at, at)
            least, held, size = joined(least, a, b), [], 0
        if not len(at):
            members = np.flatnonzero(least != np.arange(len(least)))
            return members, least[members]
        step += 1


def joined(least: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least position of every tree once links (a, b) have joined the trees of ``least``."""
    while True:
        x, y = least[a], least[b]
        if (x == y).all():
            return least
        least = least.copy()
        np.minimum.at(least, np.maximum(x, y), np.minimum(x, y))
        while (least[least] != least).any():
            least = least[least]


def fingerprint_links(reps: DataFrame, radius: int = RADIUS, leaf: int = LEAF, sample_rows: int = SAMPLE) -> DataFrame:
    """Spanning links (a, b) between the ids of stored ``reps`` (fp, rep) whose fingerprints
    differ in at most ``radius`` bits."""
    total = reps.count()
    sample = local(reps.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample_rows))["fp"]
    depth = min(DEPTH, max(0, int(np.ceil(np.log2(max(1, total) / leaf)))))
    tree = grow(sample.to_numpy().view(np.uint64), depth, np.random.default_rng(SEED))
    parts = segments(radius + 1)
    many = len(parts) * total // BLOCK + 1

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = batch["fp"].to_numpy().view(np.uint64)
            for number, at in route(tree, values, radius):
                for k, part in enumerate(parts):
                    key = mixed(mixed(values[at] & part) ^ np.uint64(number * len(parts) + k))
                    bucket = (key % np.uint64(many)).astype(np.int64)
                    yield batch.iloc[at].assign(key=key.view(np.int64), bucket=bucket)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key")
        a, b = close_pairs(pdf["key"].to_numpy(), pdf["fp"].to_numpy().view(np.uint64), radius)
        ids = pdf["rep"].to_numpy()
        return pd.DataFrame({"a": ids[a], "b": ids[b]})

    routed = staged(reps.mapInPandas(deal, "fp long, rep long, key long, bucket long"), "shards")
    dealt = block_pairs(routed, "bucket", "fp", CROWDED).drop("mine")
    return dealt.groupBy("bucket", "i", "j").applyInPandas(search, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``row_id``, ``doc_id``, ``fp`` and ``component_id`` (the least doc_id reachable over
    fingerprints within ``radius`` bits) of every row of ``docs`` (doc_id, text, others).

    Null, empty and blank texts have fingerprint zero and link like others. Rows that share a
    doc_id are one node. A fingerprint whose rows all have a null doc_id links with none; its
    rows have a null component."""
    marked = staged(fingerprints(docs, shingle), "fingerprints")
    reps = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")).filter("rep is not null"), "reps")
    # An id with several texts ties their fingerprints together, as one node.
    several = marked.groupBy("doc_id").agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
    several = several.filter("least != most and doc_id is not null").select("doc_id")
    same = marked.join(several, "doc_id", "left_semi").join(reps, "fp").filter("doc_id != rep")
    same = same.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).distinct()
    found = components(fingerprint_links(reps, radius).unionByName(same))
    grouped = reps.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    grouped = grouped.select("fp", F.coalesce("component", "rep").alias("component_id"))
    return marked.join(grouped, "fp", "left").select("row_id", "doc_id", "fp", "component_id")


def hexadecimal(fp):
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hexadecimal("fp").alias("fingerprint"), "component_id")


def distinct_documents(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of stored ``docs`` (doc_id, text, others) that stay when each near-duplicate
    group keeps its least doc_id, all columns as they are.

    A row without an id gets one from its text, greater than any below 2^62. Rows that share an
    id are one document, of which the least row stays."""
    text_id = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 2).bitwiseOR(F.lit(1 << 62))
    node = F.coalesce(F.col("doc_id").cast("bigint"), text_id)
    found = staged(near_duplicates(docs.select(node.alias("doc_id"), "text"), shingle, radius), "near")
    kept = found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("n"))
    marked = docs.withColumn("_node", node)
    once = marked.join(kept.filter("n = 1").select(F.col("doc_id").alias("_node")), "_node", "left_semi")
    several = marked.join(kept.filter("n > 1").select(F.col("doc_id").alias("_node")), "_node", "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    several = several.groupBy("_node").agg(F.min(row).alias("row")).select("row.*")
    return once.select(*docs.columns).unionByName(several)
