"""What the operators share: tables, row numbers, word hashes, chunks of bounded size."""

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES = {}
BATCH_ROWS = 1_000
CHUNK_WORDS = 250_000
CACHED_WORDS = 250_000


def for_texts(fn):
    """Decorates ``fn(spark, ...)``: texts are long, so the session's Arrow batches are made
    smaller, lest a batch of them fill a worker."""

    @functools.wraps(fn)
    def wrapped(spark, *args):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        return fn(spark, *args)

    return wrapped


def query(fn):
    """Register ``fn(spark, sf_dir)`` under its name."""
    QUERIES[fn.__name__] = for_texts(fn)
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local(df: DataFrame) -> pd.DataFrame:
    """A result of bounded size, in Arrow batches."""
    return df.toArrow().to_pandas()


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds


def unused(df: DataFrame, name: str) -> str:
    """``name``, or something longer if ``df`` has a column of that name."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def numbered(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """``row_id`` (unique, stable for a stored table) and the columns asked for: ids and rows
    may repeat, so operators tell rows apart by this number."""
    return docs.select(F.monotonically_increasing_id().alias("row_id"), *columns)


def words(text: str | None) -> list[bytes]:
    """Runs of bytes other than space and 0x09-0x0D, with A-Z in lower case."""
    return text.encode().lower().split() if text else []


def raw_words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes(dict):
    """Word -> 64-bit hash, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        if len(self) > CACHED_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def chunks(batches: Iterator[pd.DataFrame], split=words) -> Iterator[tuple[pd.DataFrame, list[list[bytes]]]]:
    """Rows with their words, about CHUNK_WORDS words at a time, however long the texts are."""
    for batch in batches:
        start, held, size = 0, [], 0
        for i, text in enumerate(batch["text"]):
            found = split(text)
            held.append(found)
            size += len(found)
            if size >= CHUNK_WORDS:
                yield batch.iloc[start : i + 1], held
                start, held, size = i + 1, [], 0
        if held:
            yield batch.iloc[start:], held


def flat(held: list[list[bytes]]) -> list[bytes]:
    return [w for found in held for w in found]


def buckets(spark: SparkSession) -> int:
    """Groups to deal hashes into: some for each shuffle partition, so groups shrink as the
    cluster's own setting grows with the data."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
