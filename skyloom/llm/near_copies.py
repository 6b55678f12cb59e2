"""Near copies by the Jaccard similarity of their word shingles, candidates from SimHash.

A SimHash of a whole text moves by about ten of 64 bits at a similarity of 0.8, and at such a
radius a vantage-point tree prunes nothing. So the tree of ``simhash`` finds the texts whose whole
fingerprints hardly differ, and fingerprints of min-wise samples find the others: under each of
SEEDS orders two texts share their least SAMPLED shingles with a chance of about the similarity
to the power SAMPLED, and then the sample's fingerprint is equal. All texts of a candidate group
are compared by their shingles, and only those that reach the similarity link. A pair at 0.8 is
missed with a chance of about 0.2 %, one at 0.9 of about 5 in 100,000.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import Hashes, mixed, numbered, words
from skyloom.llm.components import components
from skyloom.llm.simhash import RADIUS, block_pairs, fingerprint_links
from skyloom.sources.lake import broadcast_within, fits, staged

SHINGLE = 5
SIMILARITY = 0.8
SEEDS = 6
SAMPLED = 2
BLOCK = 1024
SLICE = 1 << 18
MAX_ROWS = 4_000_000
#: The kind of candidate group that the tree gives; samples have 0 to SEEDS - 1.
WHOLE = SEEDS


def shingles(found: list[bytes], hashes: Hashes, size: int = SHINGLE) -> np.ndarray:
    """The different shingles of a text's words as 64-bit numbers, ascending; a shorter text is
    one shingle, a text without words has none."""
    if not found:
        return np.empty(0, np.uint64)
    h = hashes.of(found)
    size = min(size, len(h))
    out = np.full(len(h) - size + 1, size, np.uint64)
    for j in range(size):
        out = mixed(out ^ h[j : len(h) - size + 1 + j])
    return np.unique(out)


def whole_fingerprint(x: np.ndarray) -> int:
    """SimHash of shingles: a bit is set if in over half of them."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(x), SLICE):
        bits = np.unpackbits(x[at : at + SLICE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(x), bitorder="little").view("<i8")[0])


def samples(x: np.ndarray) -> list[int]:
    """A fingerprint of the least shingles under each order."""
    out = []
    for seed in range(SEEDS):
        order = mixed(x ^ np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        least = np.sort(np.partition(order, SAMPLED - 1)[:SAMPLED] if len(order) > SAMPLED else order)
        out.append(xxhash.xxh64_intdigest(least.tobytes(), seed) - (1 << 63))
    return out


def linked(sets: list[np.ndarray], similarity: float) -> tuple[list[int], list[int]]:
    """A spanning forest of the pairs of ``sets`` (ascending, no empty ones) with a Jaccard
    similarity of at least ``similarity``. A set is compared with those not reached yet, through
    an inverted list of shingles."""
    many = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(many), sizes)
    _, term = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(term, kind="stable")
    starts = np.searchsorted(term[order], np.arange(term.max() + 2))
    holders, ends = owner[order], np.cumsum(sizes)
    left, a, b = np.ones(many, bool), [], []
    for seed in range(many):
        if not left[seed]:
            continue
        left[seed] = False
        front = [seed]
        while front and left.any():
            at = front.pop()
            mine = term[ends[at] - sizes[at] : ends[at]]
            lists = [holders[starts[t] : starts[t + 1]] for t in mine]
            common = np.bincount(np.concatenate(lists), minlength=many)
            close = common >= similarity * (sizes + sizes[at] - common) - 1e-9
            reached = np.flatnonzero(close & left)
            left[reached] = False
            a += [at] * len(reached)
            b += reached.tolist()
            front += reached.tolist()
    return a, b


def signatures(docs: DataFrame, shingle: int) -> DataFrame:
    """Stored row_id, node, ``content`` (a number for the set of shingles), ``fp`` and ``samples``
    of every row of ``docs`` (node, text)."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for batch in batches:
            out = []
            for text in batch["text"]:
                x = shingles(words(text), hashes, shingle)
                content = xxhash.xxh64_intdigest(x.tobytes()) - (1 << 63)
                out.append((content, whole_fingerprint(x) if len(x) else 0, samples(x) if len(x) else []))
            yield batch[["row_id", "node"]].assign(**dict(zip(("content", "fp", "samples"), zip(*out))))

    schema = "row_id long, node long, content long, fp long, samples array<long>"
    return staged(numbered(docs, "node", "text").mapInPandas(task, schema), "signatures")


def candidate_groups(contents: DataFrame) -> DataFrame:
    """Stored (kind, sig, content) of groups with two or more of the stored ``contents``
    (content, fp, samples), one of those with the same members."""
    reps = staged(contents.filter("size(samples) > 0").groupBy("fp").agg(F.min("content").alias("rep")), "reps")
    found = components(fingerprint_links(reps, RADIUS)).withColumnRenamed("node", "rep")
    whole = contents.filter("size(samples) > 0").join(reps, "fp").join(found, "rep", "left")
    whole = whole.select(F.lit(WHOLE).alias("kind"), F.coalesce("component", "rep").alias("sig"), "content")
    sampled = contents.select(F.posexplode("samples").alias("kind", "sig"), "content")
    every = staged(sampled.unionByName(whole), "groups")
    # Copies meet in most kinds of group. Equal groups, told by their size, ends and two sums of
    # hashes, are compared once.
    members = {
        "n": F.count("*"),
        "least": F.min("content"),
        "most": F.max("content"),
        "one": F.bit_xor(F.xxhash64("content")),
        "two": F.bit_xor(F.xxhash64(F.lit(1), "content")),
    }
    several = every.groupBy("kind", "sig").agg(*[m.alias(name) for name, m in members.items()]).filter("n > 1")
    different = several.groupBy(*members).agg(F.min(F.struct("kind", "sig")).alias("group"))
    return staged(every.join(different.select("group.*"), ["kind", "sig"]), "candidates")


def verified(docs: DataFrame, places: DataFrame, groups: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """Links (a, b) between contents of a group that are similar. ``places`` (row_id, content) has
    one row of ``docs`` for each content."""
    wanted = staged(places.join(groups.select("content").distinct(), "content"), "wanted")
    if fits(wanted, MAX_ROWS):
        wanted = F.broadcast(wanted)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for batch in batches:
            sets = [shingles(words(t), hashes, shingle).tobytes() for t in batch["text"]]
            yield batch[["content"]].assign(shingles=sets)

    rows = numbered(docs, "text").join(wanted, "row_id")
    sets = staged(rows.select("content", "text").mapInPandas(task, "content long, shingles binary"), "shingles")
    keyed = groups.withColumn("grp", F.xxhash64("kind", "sig")).select("grp", "content")
    dealt = block_pairs(keyed, "grp", "content", BLOCK).drop("mine")

    def search(part: pd.DataFrame) -> pd.DataFrame:
        part = part.drop_duplicates("content")
        ids = part["content"].to_numpy()
        a, b = linked([np.frombuffer(s, "<u8") for s in part["shingles"]], similarity)
        return pd.DataFrame({"a": ids[a], "b": ids[b]})

    met = dealt.join(sets, "content").groupBy("grp", "i", "j")
    return met.applyInPandas(search, "a long, b long")


def near_copies(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """row_id, node and ``component`` (the least node reachable over links) of every row of stored
    ``docs`` (node, text). Texts with the same set of shingles link, those without words too; rows
    that share a node are one."""
    marked = signatures(docs, shingle)
    contents = marked.groupBy("content").agg(
        F.min("node").alias("rep"), F.min("row_id").alias("row_id"), F.min_by("fp", "row_id").alias("fp"), F.min_by("samples", "row_id").alias("samples")
    )
    contents = staged(contents, "contents")
    groups = candidate_groups(contents.select("content", "fp", "samples"))
    links = staged(verified(docs, contents.select("row_id", "content"), groups, shingle, similarity), "verified")
    own = contents.select("content", "rep")
    for side in ("a", "b"):
        links = links.join(own.withColumnsRenamed({"content": side, "rep": f"{side}_rep"}), side)
    links = links.select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b"))
    same = marked.join(own, "content").filter("node != rep").select(F.col("node").alias("a"), F.col("rep").alias("b"))
    found = components(links.unionByName(same.distinct()))
    return marked.select("row_id", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def distinct_documents(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of stored ``docs`` (doc_id, text, others) that stay when each group of near copies
    keeps its least doc_id, all columns as they are.

    A row without an id gets one from its text, greater than any below 2^62. Rows that share an
    id are one document, of which the least row stays. Texts without words are copies of each
    other. Columns may have any names; an empty table stays empty."""
    text_id = F.shiftrightunsigned(F.xxhash64(F.coalesce("text", F.lit(""))), 2).bitwiseOR(F.lit(1 << 62))
    node = F.coalesce(F.col("doc_id").cast("bigint"), text_id)
    found = staged(near_copies(docs.select(node.alias("node"), "text"), shingle, similarity), "near")
    kept = found.filter("node = component").groupBy("node").agg(F.count("*").alias("n"))
    # Ids go to the texts, not texts to the ids: 64 neighbouring ids are two words of bits.
    bit = F.expr("shiftleft(1L, cast(node & 63 as int))")
    marks = kept.groupBy(F.shiftright("node", 6).alias("own_chunk")).agg(
        F.bit_or(F.when(F.col("n") == 1, bit).otherwise(F.lit(0).cast("long"))).alias("own_once"),
        F.bit_or(F.when(F.col("n") > 1, bit).otherwise(F.lit(0).cast("long"))).alias("own_several"),
    )
    marks = broadcast_within(staged(marks, "kept"), MAX_ROWS)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(node.alias("own_node"), row.alias("own_row")).withColumn("own_chunk", F.shiftright("own_node", 6))
    rows = rows.join(marks, "own_chunk")
    marked = "shiftright({}, cast(own_node & 63 as int)) & 1 = 1"
    once = rows.filter(marked.format("own_once")).select("own_row.*")
    several = rows.filter(marked.format("own_several")).groupBy("own_node")
    return once.unionByName(several.agg(F.min("own_row").alias("own_row")).select("own_row.*"))
