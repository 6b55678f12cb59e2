import hashlib
import random
import re

import pytest

from skyloom.llm import decontaminate

from .conftest import EDGES, LONG

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = words(text)
        size = min(len(w), window)
        for i in range(len(w) - size + 1 if size else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(item)
    sizes, out = {len(w) for w in windows}, []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(w[i : i + size])]
        names = sorted(str(i) for i in found if i is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


ITEMS = [
    (1, "One two, three FOUR five six seven eight nine ten eleven twelve"),
    (2, "three four five six seven eight nine ten eleven twelve thirteen"),
    (10, "short item é"), (11, "short ITEM é!"), (12, None), (13, " .. "), (None, "no id here"), (2, "other text under two"),
]
DOCS = [
    *EDGES,
    (20, "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (21, "one two three four five six seven eight nine"),
    (22, "a short item é and a Short-Item é; no id here"),
    (22, "a short item é and a Short-Item é; no id here"),
    (23, LONG + " short item é"),
    (24, "short item É"),
]


@pytest.mark.parametrize("max_hashes", [50_000, 0])
def test_equals_plain(spark, docs_of, max_hashes, monkeypatch):
    """With the set of hashes, and past its bound."""
    if not max_hashes:
        monkeypatch.setattr(decontaminate.hits, "__defaults__", (10, 0))
        monkeypatch.setattr(decontaminate, "MAX_BROADCAST_BYTES", 0)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontaminate.contamination(docs_of(DOCS), items).drop("spans").collect()
    assert sorted(map(tuple, rows), key=str) == plain(DOCS, ITEMS)


def test_clean_documents(spark, docs_of):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of(DOCS)
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns
    clean = [r[0] for r in plain(DOCS, ITEMS) if not r[5]]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, clean))


def test_random_overlaps(spark, docs_of):
    rng = random.Random(1)
    text = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randint(0, 9)))) for i in range(12)]
    rows = decontaminate.contamination(docs_of(text), spark.createDataFrame(items, "item_id long, text string"), 4)
    assert sorted(map(tuple, rows.drop("spans").collect()), key=str) == plain(list(enumerate(text)), items, 4)


def test_empty(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate.contamination(docs_of(EDGES), none).drop("spans").collect()
    assert sorted(map(tuple, rows), key=str) == plain(EDGES, [])
    assert decontaminate.contamination(docs_of([]), none).count() == 0
    assert decontaminate.clean_documents(docs_of(EDGES), none).count() == len(EDGES)
