import random

from conftest import SF_DIR

from skyloom.llm import substrings

from .conftest import EDGES


def plain(rows, window=20):
    """(doc_id, n_words, n_removed, kept) of rows in order of their ids."""
    seen, out = set(), []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        out.append((doc_id, len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return out


def found(docs, **kw):
    return sorted(map(tuple, substrings.remove_repeats(docs, **kw).collect()), key=lambda r: (r[0] is None, r[0], r[2]))


def test_edges(docs_of):
    rows = [r for r in EDGES if r[0] is not None]
    assert found(docs_of(rows)) == sorted(plain(rows), key=lambda r: (r[0], r[2]))
    assert substrings.remove_repeats(docs_of(EDGES)).count() == len(EDGES)
    assert found(docs_of([])) == []


def test_repeated_rows_lose_every_window(docs_of):
    text = " ".join(map(str, range(30)))
    assert [r[2] for r in found(docs_of([(1, text), (1, text), (2, text)]))] == [0, 30, 30]


def test_random_repeats(docs_of):
    """Small alphabets make runs, periods and overlaps."""
    rng = random.Random(3)
    for letters, bitmap in (("ab", 1 << 12), ("abcdefgh", 64), ("abcdefghijklmnop", 1 << 16)):
        pieces = [[rng.choice(letters) for _ in range(rng.randint(5, 60))] for _ in range(12)]
        rows = [(i, " ".join(sum((rng.choice(pieces) for _ in range(rng.randint(0, 6))), []))) for i in range(60)]
        rows += [(60 + i, f"{'x ' * i}{'y ' * (40 - i)}") for i in range(0, 40, 7)]
        assert found(docs_of(rows), bitmap_bytes=bitmap) == plain(rows)
        assert found(docs_of(rows), window=7, rounds=2, bitmap_bytes=bitmap) == plain(rows, 7)


def test_query_equals_plain(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want = {i: (n, r) for i, n, r, _ in plain(docs)}
    got = substrings.op8_substring_dedup(spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_words, r.n_removed) for r in got} == want
