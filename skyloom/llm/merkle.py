"""Merkle manifest of a documents table, its leaves placed by bitmap-rank indexing.

Each row is a leaf. Within a group (``lang``) leaves ascend by doc_id, but no leaves are sorted:
tasks set the doc_ids they see in compressed bitmaps of 2**CHUNK_BITS ids, the bitmaps of a
group's chunk are merged, and a directory of their popcounts, added up digit by digit of the
id, gives every chunk the number of leaves below it. A leaf's position is that number plus the
popcount of its bitmap below its bit. Then every FAN consecutive nodes meet as a keyed slot array
and become their hash. A tile reduces SPAN levels at once, so that a pass shuffles one row for
FAN**SPAN of the pass before. The roots of the groups form one more tree. Going down the same
tiles gives each node what lies beside its way to the root.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyloom.llm.common import buckets, query, table
from skyloom.sources.lake import staged

FAN = 8
SPAN = 3
TILE = FAN**SPAN
CHUNK_BITS = 10
CHUNK = 1 << CHUNK_BITS
DIGIT_BITS = 16
DIGITS = -(-(64 - CHUNK_BITS) // DIGIT_BITS)
FLUSH_ROWS = 200_000
BLOCK_BITS = 14
#: The chunk of null ids: it comes before that of any id.
NO_ID = -(1 << (63 - CHUNK_BITS)) - 1
EXTRA = np.dtype([("low", "<u2"), ("n", "<i8")])
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaf(values: list[Column]) -> Column:
    """SHA-256 (32 bytes) of the values, each ``-`` if null, else byte count, colon, value."""

    def part(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, values)).cast("binary"), 256))


def leaves(docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """``doc_id`` (0 where not ``known``), ``g`` (the group: 0 for null, else 1 and its name),
    ``chunk``, ``leaf`` and ``other``, the leaf with ``changed`` as text where that is not null."""
    doc_id = F.col("doc_id").cast("bigint")
    values = [F.col(c) for c in FIELDS]
    other = F.lit(None).cast("binary")
    if changed is not None:
        other = F.when(changed.isNotNull(), leaf([*values[:-1], changed]))
    return docs.select(
        F.coalesce(doc_id, F.lit(0)).alias("doc_id"),
        doc_id.isNotNull().alias("known"),
        F.coalesce(F.concat(F.lit("1"), F.col("lang").cast("string")), F.lit("0")).alias("g"),
        F.coalesce(F.shiftright(doc_id, CHUNK_BITS), F.lit(NO_ID)).alias("chunk"),
        leaf(values).alias("leaf"),
        other.alias("other"),
    )


def packed(counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Rows of counts by low bits as bitmaps (lists of two-byte numbers where these are shorter),
    and what there is beyond one of an id."""
    present = counts > 0
    bitmaps = np.packbits(present, axis=1, bitorder="little")
    blobs, extras = [], []
    for k, n in enumerate(present.sum(axis=1)):
        short = 2 * n < bitmaps.shape[1]
        blobs.append((np.flatnonzero(present[k]).astype("<u2") if short else bitmaps[k]).tobytes())
        many = np.flatnonzero(counts[k] > 1)
        extra = np.empty(len(many), EXTRA)
        extra["low"], extra["n"] = many, counts[k][many] - 1
        extras.append(extra.tobytes())
    return blobs, extras


def unpacked(blobs: list[bytes]) -> np.ndarray:
    """Bitmaps of one byte a bit."""
    out = np.zeros((len(blobs), CHUNK), np.uint8)
    for k, blob in enumerate(blobs):
        if len(blob) == CHUNK // 8:
            out[k] = np.unpackbits(np.frombuffer(blob, np.uint8), bitorder="little")
        else:
            out[k, np.frombuffer(blob, "<u2")] = 1
    return out


def listed(extras: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Place (row * CHUNK + low bits) and number of the ids beyond one, in order."""
    found = [np.frombuffer(x, EXTRA) for x in extras]
    places = [x["low"].astype(np.int64) + k * CHUNK for k, x in enumerate(found)]
    return np.concatenate([np.empty(0, np.int64), *places]), np.concatenate([np.empty(0, np.int64), *[x["n"] for x in found]])


def low_bits(rows: pd.DataFrame) -> np.ndarray:
    return rows["doc_id"].to_numpy() & (CHUNK - 1)


def bitmaps(rows: DataFrame) -> DataFrame:
    """(g, chunk, bits, extra, n) of all rows (g, chunk, doc_id), stored."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0

        def flush():
            both = pd.concat(held, ignore_index=True)
            codes, keys = pd.factorize(pd.MultiIndex.from_frame(both[["g", "chunk"]]))
            lows = low_bits(both)
            for first in range(0, len(keys), 1024):  # so many chunks at a time
                mine = (codes >= first) & (codes < first + 1024)
                some = keys[first : first + 1024]
                counts = np.bincount((codes[mine] - first) * CHUNK + lows[mine], minlength=len(some) * CHUNK)
                bits, extra = packed(counts.reshape(-1, CHUNK))
                yield pd.DataFrame({"g": some.get_level_values(0), "chunk": some.get_level_values(1), "bits": bits, "extra": extra})

        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size >= FLUSH_ROWS:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        codes, keys = pd.factorize(pd.MultiIndex.from_frame(part[["g", "chunk"]]))
        blobs, extras, out = part["bits"].to_list(), part["extra"].to_list(), []
        for first in range(0, len(keys), 1024):
            mine = np.flatnonzero((codes >= first) & (codes < first + 1024))
            some = keys[first : first + 1024]
            counts = np.zeros((len(some), CHUNK), np.int64)
            for k in mine:
                row, extra = counts[codes[k] - first], np.frombuffer(extras[k], EXTRA)
                row += unpacked(blobs[k : k + 1])[0]
                row[extra["low"]] += extra["n"]
            bits, extra = packed(counts)
            names = {"g": some.get_level_values(0), "chunk": some.get_level_values(1)}
            out.append(pd.DataFrame(names | {"bits": bits, "extra": extra, "n": counts.sum(axis=1)}))
        return pd.concat(out)

    schema = "g string, chunk long, bits binary, extra binary"
    parts = rows.select("g", "chunk", "doc_id").mapInPandas(build, schema)
    dealt = parts.groupBy(F.pmod(F.xxhash64("g", "chunk"), F.lit(buckets(rows.sparkSession))).alias("bucket"))
    return staged(dealt.applyInPandas(merge, f"{schema}, n long"), "bitmaps")


def directory(chunks: DataFrame) -> DataFrame:
    """(g, chunk, base): the leaves of the group before the chunk. Chunks are added up by the
    upper digits of their number, so no window holds more than 2**DIGIT_BITS rows."""
    digits = [F.shiftright("chunk", DIGIT_BITS * k).alias(f"d{k}") for k in range(DIGITS)]
    level = chunks.select("g", *digits, "n")
    base = None
    for k in range(DIGITS):
        upper = [f"d{j}" for j in range(k + 1, DIGITS)]
        before = Window.partitionBy("g", *upper).orderBy(f"d{k}").rowsBetween(Window.unboundedPreceding, -1)
        sums = level.select("g", f"d{k}", *upper, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(f"b{k}"))
        base = sums if base is None else base.join(sums.select("g", f"d{k}", f"b{k}"), ["g", f"d{k}"])
        level = level.groupBy("g", *upper).agg(F.sum("n").alias("n"))
    total = sum((F.col(f"b{k}") for k in range(1, DIGITS)), F.col("b0"))
    return base.select("g", F.col("d0").alias("chunk"), total.cast("long").alias("base"))


def in_order(df: DataFrame, column: str, number: str) -> DataFrame:
    """``df``, stored, with ``number``: the place of its distinct ``column`` in their order. The
    parts of the sort are numbered apart and only their sizes meet in one place."""
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = staged(df.orderBy(column).select("*", F.spark_partition_id().alias("_part"), inside.alias("_at")), "ordered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_part").agg(F.count("*").alias("n"))
    sizes = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    return rows.join(F.broadcast(sizes), "_part").withColumn(number, F.col("_base") + F.col("_at")).drop("_part", "_at", "_base")


def placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stored ``rows`` (of ``leaves``) with ``grp`` (number of the group in order), ``n`` (leaves
    of the group) and ``pos`` (from 0, by doc_id) in place of g and chunk; and the groups."""
    chunks = bitmaps(rows)
    groups = staged(in_order(chunks.groupBy("g").agg(F.sum("n").alias("n")), "g", "grp"), "groups")
    index = chunks.drop("n").join(directory(chunks), ["g", "chunk"]).join(groups, "g")

    def rank(mine: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        keys = pd.MultiIndex.from_frame(index[["g", "chunk"]])
        row = keys.get_indexer(pd.MultiIndex.from_frame(mine[["g", "chunk"]]))
        low = low_bits(mine)
        words = np.packbits(unpacked(index["bits"]), axis=1, bitorder="little").view("<u8")
        counts = np.bitwise_count(words).astype(np.int64)
        upto = counts.cumsum(axis=1) - counts
        mask = (np.uint64(1) << (low & 63).astype(np.uint64)) - np.uint64(1)
        below = upto[row, low >> 6] + np.bitwise_count(words[row, low >> 6] & mask)
        places, extra = listed(index["extra"])
        sums = np.concatenate([[0], extra.cumsum()])
        at = row * CHUNK + low
        first = np.searchsorted(places, at)
        more = sums[first] - sums[np.searchsorted(places, row * CHUNK)]
        held = {c: index[c].to_numpy()[row] for c in ("grp", "n")}
        pos = index["base"].to_numpy()[row] + below + more
        tied = np.append(places, -1)[first] == at
        return mine[["doc_id", "known", "leaf", "other"]].assign(**held, pos=pos, tied=tied)

    bucket = F.pmod(F.xxhash64("g", "chunk"), F.lit(buckets(rows.sparkSession))).alias("bucket")
    met = rows.groupBy(bucket).cogroup(index.groupBy(bucket))
    schema = "doc_id long, known boolean, leaf binary, other binary, grp long, n long, pos long, tied boolean"
    return untied(staged(met.applyInPandas(rank, schema), "places")), groups


def untied(rows: DataFrame) -> DataFrame:
    """Leaves that share group and doc_id take consecutive positions by leaf; equal ones any. A
    large group of them is counted by the first bytes of the leaf and by blocks of rows."""
    if rows.filter("tied").isEmpty():
        return rows.drop("tied")
    number = F.monotonically_increasing_id()
    ties = rows.filter("tied").withColumns({"row": number, "block": F.shiftright(number, BLOCK_BITS), "head": F.substring("leaf", 1, 2)})
    ties = staged(ties, "ties")
    keys, before = ["grp", "pos"], (Window.unboundedPreceding, -1)
    heads = ties.groupBy(*keys, "head").agg(F.count("*").alias("n"))
    upto = F.coalesce(F.sum("n").over(Window.partitionBy(*keys).orderBy("head").rowsBetween(*before)), F.lit(0))
    heads = heads.select(*keys, "head", upto.alias("b0"))
    blocks = ties.groupBy(*keys, "head", "leaf", "block").agg(F.count("*").alias("n"))
    inside = Window.partitionBy(*keys, "head").orderBy("leaf", "block").rowsBetween(*before)
    blocks = blocks.select(*keys, "leaf", "block", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("b1"))
    nth = F.row_number().over(Window.partitionBy(*keys, "leaf", "block").orderBy("row")) - 1
    found = ties.withColumn("b2", nth).join(heads, [*keys, "head"]).join(blocks, [*keys, "leaf", "block"])
    found = found.withColumn("pos", F.col("pos") + F.col("b0") + F.col("b1") + F.col("b2"))
    return staged(rows.filter("not tied").drop("tied").unionByName(found.select(*rows.drop("tied").columns)), "untied")


def levels(n: int) -> int:
    """Levels above ``n`` nodes."""
    found = 0
    while FAN**found < n:
        found += 1
    return found


def sha(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def reduced(nodes: list[bytes], n: int) -> list[list[bytes]]:
    """The runs of a tile, joined, by level: of ``nodes`` (hex) of a level of ``n`` nodes, then of
    their hashes, up to the tile's root, which is the one item of the last list."""
    out = []
    for _ in range(min(SPAN, levels(n))):
        runs = [b"".join(nodes[i : i + FAN]) for i in range(0, len(nodes), FAN)]
        out.append(runs)
        nodes = [sha(run) for run in runs]
    return [*out, nodes]


def slots(part: pd.DataFrame) -> list[bytes]:
    """The tile's digests in hex, by position."""
    out: list[bytes] = [b""] * len(part)
    for at, digest in zip((part["pos"] % TILE).to_list(), part["leaf"]):
        out[at] = digest.hex().encode()
    return out


def tile(rows: DataFrame):
    return rows.groupBy("grp", F.floor(F.col("pos") / TILE).alias("tile"))


def above(nodes: DataFrame) -> DataFrame:
    """Stored roots of the tiles of ``nodes`` (grp, n, pos, leaf), as nodes themselves."""

    def roots(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        n = int(part["n"].iloc[0])
        root = bytes.fromhex(reduced(slots(part), n)[-1][0].decode())
        return pd.DataFrame({"grp": [key[0]], "n": [-(-n // TILE)], "pos": [key[1]], "leaf": [root]})

    found = tile(nodes.select("grp", "n", "pos", "leaf"))
    return staged(found.applyInPandas(roots, "grp long, n long, pos long, leaf binary"), "nodes")


def climbed(nodes: DataFrame, most: int) -> list[DataFrame]:
    """``nodes``, their tiles' roots and so on; the last has one node a group."""
    out = [nodes]
    while most > 1:
        out.append(above(out[-1]))
        most = -(-most // TILE)
    return out


def below(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Stored ``paths`` (grp, pos, slots, runs, subroot, root) of ``nodes``, from those of their
    tiles. A path is, level by level up to the root, the node's slot and the run that holds it."""

    def task(mine: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        up, n = upper.iloc[0], int(mine["n"].iloc[0])
        runs = reduced(slots(mine), n)[:-1]
        out = mine[["grp", "pos"]].copy()
        at = (out["pos"] % TILE).to_list()
        out["slots"] = [[*[(i // FAN**k) % FAN for k in range(len(runs))], *up["slots"]] for i in at]
        out["runs"] = [[*[r[i // FAN ** (k + 1)] for k, r in enumerate(runs)], *up["runs"]] for i in at]
        return out.assign(subroot=up["subroot"], root=up["root"])

    met = tile(nodes.select("grp", "n", "pos", "leaf")).cogroup(paths.groupBy("grp", "pos"))
    return staged(met.applyInPandas(task, PATHS), "paths")


PATHS = "grp long, pos long, slots array<int>, runs array<binary>, subroot string, root string"
PROOFS = "doc_id long, known boolean, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def proofs(docs: DataFrame, changed: Column | None = None, with_siblings: bool = False) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root`` and
    ``verified`` of every row of ``docs`` (doc_id, source, lang, n_chars, text, others), and with
    ``with_siblings`` also ``siblings``: the digests beside the way to the root.

    ``changed`` is a text that claims to be the row's (null: the row's own): the root is folded
    again from its leaf and the original siblings. Nulls are hashed as such; a null lang is a
    group, first in order, and null ids come first in theirs. Rows of one id and lang are placed
    by leaf; an empty table has no leaves and gives no rows. doc_id is taken as a 64-bit number."""
    rows, groups = placed(staged(leaves(docs, changed), "leaves"))
    extent = groups.agg(F.max("n").alias("most"), F.count("*").alias("many")).first()
    inner = climbed(rows, extent.most or 0)
    roots = inner[-1].select(F.lit(0).cast("long").alias("grp"), F.lit(extent.many).cast("long").alias("n"), F.col("grp").alias("pos"), "leaf")
    outer = climbed(roots, extent.many)
    root = F.lower(F.hex("leaf"))
    none = F.array().cast("array<int>").alias("slots"), F.array().cast("array<binary>").alias("runs")
    paths = outer[-1].select("grp", "pos", *none, F.lit(None).cast("string").alias("subroot"), root.alias("root"))
    for nodes in reversed(outer[:-1]):
        paths = below(nodes, paths)
    own = roots.select(F.col("pos").alias("grp"), root.alias("own"))
    paths = paths.select(F.col("pos").alias("grp"), F.lit(0).cast("long").alias("pos"), "slots", "runs", "root").join(own, "grp")
    paths = paths.select("grp", "pos", "slots", "runs", F.col("own").alias("subroot"), "root")
    for nodes in reversed(inner[1:-1]):
        paths = below(nodes, paths)

    def task(mine: pd.DataFrame, upper: pd.DataFrame) -> pd.DataFrame:
        up, n = upper.iloc[0], int(mine["n"].iloc[0])
        runs = reduced(slots(mine), n)[:-1]
        out = []
        for doc_id, known, own, other, at in zip(*(mine[c] for c in ("doc_id", "known", "leaf", "other", "pos"))):
            at %= TILE
            way = [((at // FAN**k) % FAN, r[at // FAN ** (k + 1)]) for k, r in enumerate(runs)]
            way += zip(up["slots"], up["runs"])
            ends = [(run[: 64 * slot], run[64 * slot + 64 :]) for slot, run in way]
            beside = b"".join(a + b for a, b in ends)
            node = (other or own).hex().encode()
            for before, after in ends:
                node = sha(before + node + after)
            folded = node.decode()
            line = (doc_id, known, own.hex(), up["subroot"], up["root"], sha(beside).decode(), folded, folded == up["root"])
            if with_siblings:
                line += ([beside[i : i + 64].decode() for i in range(0, len(beside), 64)],)
            out.append(line)
        return pd.DataFrame(out, columns=columns)

    schema = PROOFS + ", siblings array<string>" * with_siblings
    columns = [c.split()[0] for c in schema.split(", ")]
    paths = paths.withColumnRenamed("pos", "tile")
    found = tile(rows).cogroup(paths.groupBy("grp", "tile")).applyInPandas(task, schema)
    return found.withColumn("doc_id", F.when(F.col("known"), F.col("doc_id"))).drop("known")


def roots(docs: DataFrame) -> DataFrame:
    """The manifest's roots: ``lang``, ``n`` (leaves) and ``subroot`` of every group."""
    rows, groups = placed(staged(leaves(docs), "leaves"))
    most = groups.agg(F.max("n")).first()[0] or 0
    last = climbed(rows, most)[-1].select("grp", F.lower(F.hex("leaf")).alias("subroot"))
    lang = F.when(F.col("g") != "0", F.expr("substring(g, 2)")).alias("lang")
    return last.join(groups, "grp").select(lang, "n", "subroot")


def tampered() -> Column:
    """The text with A-Z in lower case where 3 divides the CRC-32 of the id in decimal."""
    drawn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return F.when(drawn, F.translate("text", LETTERS, LETTERS.lower()))


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether it still folds to the root."""
    return proofs(table(spark, sf_dir, "documents"), tampered())


def _sql_leaf(text: str) -> str:
    parts = [f"coalesce(strlen({v}::VARCHAR) || ':' || {v}, '-')" for v in (*FIELDS[:-1], text)]
    return f"sha256({' || '.join(parts)})"


OP13_SQL = f"""
WITH RECURSIVE drawn AS (
    SELECT *, xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
    )) % 3 = 0 AS hit, translate(text, '{LETTERS}', '{LETTERS.lower()}') AS small
    FROM documents
), hashed AS (
    SELECT doc_id, lang, {_sql_leaf("text")} AS leaf, CASE WHEN hit THEN {_sql_leaf("small")} END AS other FROM drawn
), d AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM hashed
), inside AS (
    SELECT lang, 0 AS level, list(leaf ORDER BY p) AS nodes FROM d GROUP BY lang
    UNION ALL
    SELECT lang, level + 1, list_transform(range((len(nodes) + 7) // 8), lambda i: sha256(array_to_string(nodes[8 * i + 1:8 * i + 8], '')))
    FROM inside WHERE len(nodes) > 1
), subroots AS (
    SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS q FROM inside WHERE len(nodes) = 1
), outside AS (
    SELECT 0 AS level, list(subroot ORDER BY q) AS nodes FROM subroots HAVING count(*) > 0
    UNION ALL
    SELECT level + 1, list_transform(range((len(nodes) + 7) // 8), lambda i: sha256(array_to_string(nodes[8 * i + 1:8 * i + 8], '')))
    FROM outside WHERE len(nodes) > 1
), way AS (
    SELECT d.lang, p, level, nodes, p >> (3 * level) AS spot FROM d JOIN inside i ON i.lang IS NOT DISTINCT FROM d.lang WHERE len(nodes) > 1
    UNION ALL
    SELECT d.lang, p, 100 + level, nodes, q >> (3 * level)
    FROM d JOIN subroots s ON s.lang IS NOT DISTINCT FROM d.lang, outside WHERE len(nodes) > 1
), steps AS (
    SELECT lang, p, list(array_to_string(nodes[8 * (spot // 8) + 1:spot], '') || '*' || array_to_string(nodes[spot + 2:8 * (spot // 8) + 8], '') ORDER BY level) AS s
    FROM way GROUP BY lang, p
), folded AS (
    SELECT d.*, coalesce(s, []) AS s, list_reduce(list_prepend(coalesce(other, leaf), coalesce(s, [])), lambda node, x: sha256(replace(x, '*', node))) AS folded_root
    FROM d LEFT JOIN steps ON steps.lang IS NOT DISTINCT FROM d.lang AND steps.p = d.p
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(s, ''), '*', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded f JOIN subroots r ON r.lang IS NOT DISTINCT FROM f.lang, (SELECT nodes[1] AS root FROM outside WHERE len(nodes) = 1)
"""
