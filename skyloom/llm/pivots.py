"""Embedding near-duplicates through an index of reference points.

Reference points are chosen far apart in a bounded sample. A vector lives in the list of its
nearest point and visits the list of a lesser point unless distance bounds show that no vector
living there can link with it: the angles to reference points of two linked vectors differ by
at most the link angle (ranges of angles are measured for every list, as in Brin, 1995), and a
vector farther than that from the border between two points has no link beyond it. Bounds are
necessary conditions, so no link is lost and each is found in one list only. Lists of any length
are compared by cosine in double precision, in blocks that return counts and a spanning forest,
not pairs. Where the vectors have no groups the bounds exclude little and every pair is compared.
"""

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import local, query, table
from skyloom.llm.components import components
from skyloom.llm.simhash import forest
from skyloom.sources.lake import staged

COSINE = 0.95
FEWEST, MOST = 32, 1024
SAMPLE = 16_384
RANGES = 32
BLOCK = 2048
ROWS = 256
SENT = 16_384
SLACK = 1e-6


def usable(vector):
    """Whether an array links at all: not null or empty, all finite, not all zero."""
    value = vector.cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))


def unit(blobs: pd.Series, dim: int) -> np.ndarray:
    vectors = np.frombuffer(b"".join(blobs), np.float64).reshape(-1, dim)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no overflow or underflow
    return vectors / np.sqrt((vectors**2).sum(axis=1, keepdims=True))


def packed(df: DataFrame, kind: str) -> DataFrame:
    """(vid, vector, many) with vectors as blobs of doubles or floats."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            blobs = [np.asarray(v, kind).tobytes() for v in batch["vector"]]
            yield batch[["vid", "many"]].assign(vector=blobs)

    return df.select("vid", "many", "vector").mapInPandas(task, "vid long, many long, vector binary")


def widened(blobs: pd.Series, kind: str) -> pd.Series:
    return blobs if kind == "f8" else pd.Series([np.frombuffer(b, "f4").astype("f8").tobytes() for b in blobs])


def far_apart(x: np.ndarray, points: int) -> np.ndarray:
    """Up to ``points`` different rows, each the farthest from those before it."""
    chosen = [0]
    closest = x @ x[0]
    while len(chosen) < points:
        at = int(np.argmin(closest))
        if closest[at] >= 1 - 1e-12:
            break
        chosen.append(at)
        closest = np.maximum(closest, x @ x[at])
    return x[chosen]


def angles_to(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(x @ pivots.T, -1, 1))


def angle_ranges(vectors: DataFrame, pivots: np.ndarray, kind: str) -> np.ndarray:
    """(2, points, ranges + 1): least and greatest angle of the vectors of each list to the first
    reference points and, last, to the list's own. A vector as near to two points counts in both."""
    points, dim = pivots.shape
    ranges = min(RANGES, points)

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high = np.full((points, ranges + 1), np.inf), np.full((points, ranges + 1), -np.inf)
        for batch in batches:
            angle = angles_to(unit(widened(batch["vector"], kind), dim), pivots)
            near = angle <= angle.min(axis=1, keepdims=True) + SLACK
            for p in np.flatnonzero(near.any(axis=0)):
                mine = angle[near[:, p]]
                mine = np.column_stack([mine[:, :ranges], mine[:, p]])
                low[p], high[p] = np.minimum(low[p], mine.min(axis=0)), np.maximum(high[p], mine.max(axis=0))
        p, k = np.nonzero(low <= high)
        yield pd.DataFrame({"p": p.astype("i4"), "k": k.astype("i4"), "low": low[p, k], "high": high[p, k]})

    found = vectors.select("vector").mapInPandas(task, "p int, k int, low double, high double")
    found = local(found.groupBy("p", "k").agg(F.min("low").alias("low"), F.max("high").alias("high")))
    out = np.stack([np.full((points, ranges + 1), np.inf), np.full((points, ranges + 1), -np.inf)])
    out[0, found["p"], found["k"]], out[1, found["p"], found["k"]] = found["low"], found["high"]
    return out


def list_pairs(rows: DataFrame) -> DataFrame:
    """Rows (vid, point, lives, others) dealt into blocks of about BLOCK: (``point``, ``i``, ``j``)
    is a block of vectors that live in the list with another such block or one of visitors;
    ``side`` is the row's block."""
    sizes = rows.groupBy("point").agg(
        F.ceil(F.count_if("lives") / BLOCK).cast("int").alias("living"),
        F.ceil(F.count_if(~F.col("lives")) / BLOCK).cast("int").alias("visiting"),
    )
    # One row for each reference point.
    dealt = rows.join(F.broadcast(sizes.filter("living > 0")), "point")
    hashed = F.xxhash64("vid")
    side = F.when(F.col("lives"), F.pmod(hashed, F.col("living"))).otherwise(
        F.col("living") + F.pmod(hashed, F.col("visiting"))
    )
    others = F.when(F.col("lives"), F.col("living") + F.col("visiting")).otherwise(F.col("living"))
    pair = F.explode(
        F.transform(
            F.sequence(F.lit(0), others - 1),
            lambda o: F.struct(F.least("side", o).alias("i"), F.greatest("side", o).alias("j")),
        )
    )
    dealt = dealt.withColumn("side", side.cast("int")).withColumn("pair", pair)
    return dealt.select(*rows.columns, "side", "pair.i", "pair.j")


def links_of(vectors: DataFrame, dim: int, kind: str, cosine: float) -> DataFrame:
    """(vid, root, n): from each block, the linked rows a vector has there and the first member
    of its tree. ``vectors``: stored (vid, vector, many), all of ``dim`` components."""
    total = vectors.count()
    points = int(min(MOST, max(FEWEST, total / BLOCK), total))
    sample = local(vectors.select("vid", "vector").orderBy(F.xxhash64("vid"), "vid").limit(SAMPLE))
    pivots = far_apart(unit(widened(sample["vector"], kind), dim), points)
    low, high = angle_ranges(vectors, pivots, kind)
    reach = math.acos(cosine)
    low, high = low - reach - SLACK, high + reach + SLACK
    apart = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
    border = math.sin(min(reach, math.pi / 2)) * apart + SLACK

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = unit(widened(batch["vector"], kind), dim)
            near, angle = x @ pivots.T, angles_to(x, pivots)
            home = angle.argmin(axis=1)
            visits = np.arange(len(pivots)) < home[:, None]
            visits &= near[np.arange(len(x)), home][:, None] - near <= border[home]
            visits &= (angle >= low[:, -1]) & (angle <= high[:, -1])
            for k in range(low.shape[1] - 1):
                visits &= (angle[:, k, None] >= low[:, k]) & (angle[:, k, None] <= high[:, k])
            visits[np.arange(len(x)), home] = True
            row, point = np.nonzero(visits)
            for at in range(0, len(row), SENT):
                r, p = row[at : at + SENT], point[at : at + SENT]
                yield batch.iloc[r].assign(point=p, lives=home[r] == p)

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        _, i, j = (int(k) for k in key)
        pdf = pdf.sort_values("side", kind="stable")
        n, x = len(pdf), unit(widened(pdf["vector"], kind), dim)
        many = pdf["many"].to_numpy(np.float64)  # sums stay exact below 2^53
        cut = int((pdf["side"] == i).sum())
        start = 0 if i == j else cut
        linked = np.zeros((n, n), bool)
        counts = np.zeros(n)
        for at in range(0, cut, ROWS):
            rows = slice(at, min(at + ROWS, cut))
            near = x[rows] @ x[start:].T
            hit = near >= cosine
            a, b = np.nonzero(np.abs(near - cosine) <= 1e-12)
            hit[a, b] = np.einsum("ij,ij->i", x[a + at], x[b + start]) >= cosine
            if i == j:
                hit[np.arange(len(hit)), np.arange(at, at + len(hit))] = False
            if not hit.any():
                continue
            linked[rows, start:] = hit
            counts[rows] += hit @ many[start:]
            if i != j:
                counts[start:] += many[rows] @ hit
        if i != j:
            linked |= linked.T
        linked[np.arange(n), np.arange(n)] = True
        members, roots = forest(linked)
        ids = pdf["vid"].to_numpy()
        return pd.DataFrame({"vid": ids[members], "root": ids[roots], "n": counts[members].astype(np.int64)})

    schema = "vid long, many long, vector binary, point int, lives boolean"
    listed = vectors.select("vid", "many", "vector").mapInPandas(index, schema)
    dealt = list_pairs(staged(listed, "lists"))
    return dealt.groupBy("point", "i", "j").applyInPandas(compare, "vid long, root long, n long")


def linked_vectors(df: DataFrame, vector: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``df`` (vec_id,
    ``vector``, others).

    Vectors that are null, empty or zero, or hold null or non-finite components, link with
    nothing; neither do vectors of different length. Equal vectors are one node and link with
    each other. Rows may share a vec_id: each is a row of the result; a null vec_id never names
    a component while another id is in it."""
    kind = "f4" if dict(df.dtypes)[vector] == "array<float>" else "f8"
    rows = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(vector).alias("vector"))
    rows = rows.withColumn("good", usable(F.col("vector")))
    # Adding zero turns -0.0 into 0.0, so that equal vectors are equal keys.
    key = F.when(F.col("good"), F.transform("vector", lambda x: x + F.lit(0.0).cast("float" if kind == "f4" else "double")))
    rows = rows.select("vec_id", key.alias("vector"))
    distinct = rows.filter("vector is not null").groupBy("vector")
    distinct = distinct.agg(F.count("*").alias("many"), F.min("vec_id").alias("rep"))
    distinct = staged(distinct.select(F.monotonically_increasing_id().alias("vid"), "*"), "vectors")
    found = None
    for (dim,) in distinct.select(F.size("vector")).distinct().collect():
        vectors = staged(packed(distinct.filter(F.size("vector") == dim), kind), "packed")
        one = links_of(vectors, dim, kind, cosine)
        found = one if found is None else found.unionByName(one)
    single = F.col("vec_id")
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), single.alias("component_id"), F.lit(True).alias("kept"))
    found = staged(found, "linked")
    counts = found.groupBy("vid").agg(F.sum("n").alias("n"))
    groups = components(found.filter("vid != root").select(F.col("vid").alias("a"), F.col("root").alias("b")))
    nodes = distinct.join(counts, "vid", "left").join(groups.withColumnRenamed("node", "vid"), "vid", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "vid"))
    least = nodes.groupBy("component").agg(F.min("rep").alias("component_id"))
    nodes = nodes.join(least, "component").select(
        "vector", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"), "component_id"
    )
    out = rows.join(nodes, "vector", "left")
    component = F.coalesce("component_id", single)
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(single == component, F.lit(False)).alias("kept"),
    )


@query
def op7_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every embedding at cosine 0.95."""
    return linked_vectors(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), good AS (
    SELECT vec_id, e FROM v
    WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
    SELECT vec_id AS node, vec_id AS other FROM v
    UNION
    SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a
), component AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN component ON vec_id = node LEFT JOIN degree ON vec_id = a
"""
