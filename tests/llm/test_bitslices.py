import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import bitslices

from .conftest import EDGES, LONG, stored

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return ["".join(c.lower() if c.isascii() else c for c in t) for t in TERM.findall(text or "")]


def plain(docs, items, top=50):
    """The contract, every document for every item."""
    counted = [(i, Counter(words(t))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item_id, text in items:
        found = []
        for doc_id, c, n in counted:
            m, score = 50 + (50 * n * n_docs) // n_terms, 0
            for t in set(words(text)):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, doc_id is not None, doc_id or 0))
        for rank, (score, known, doc_id) in enumerate(sorted(found)[:top], 1):
            out.append((item_id, rank, doc_id if known else None, -score))
    return sorted(out, key=str)


@pytest.fixture
def items_of(spark):
    def make(rows):
        full = [(i, t, 1, "x", "y", 2) for i, t in rows]
        return stored(spark, spark.createDataFrame(full, "item_id long, text string, item int, term string, mark string, rank int").repartition(2))

    return make


def check(docs_of, items_of, docs, items, **kwargs):
    found = bitslices.search(docs_of(docs), items_of(items), **kwargs)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(docs, items, **kwargs)


def vocabulary(rng, n):
    return [f"{'abcdefgh'[k % 8]}{k}" for k in rng.zipf(1.3, n) % 3000]


def test_terms():
    text = "Ab-c_d éÉ 12\x00x\x85y   z ­ 漢字 A'B `q{r}~"
    assert [t.decode() for t in bitslices.terms(text)] == words(text)
    for t in (None, "", " \t_", LONG):
        assert [x.decode() for x in bitslices.terms(t)] == words(t)


@pytest.mark.parametrize("seed", range(2))
def test_equals_brute_force(docs_of, items_of, seed):
    """Common and rare terms, groups of copies larger than the list, many lengths."""
    rng = np.random.default_rng(seed)
    docs = [(i, " ".join(vocabulary(rng, int(rng.integers(1, 300))))) for i in range(300)]
    docs += [(1000 + i, docs[0][1]) for i in range(70)] + [(2000 + i, docs[1][1] + f" e{i}") for i in range(70)]
    docs += [(5000, LONG + " " + docs[2][1]), (5001, "a1 " * 3000), (5002, "a1"), (5002, "a1")]
    items = [(i, docs[i][1][:200]) for i in range(0, 300, 20)] + [(900, "a1 a1 A1"), (901, "nowhere to be found")]
    check(docs_of, items_of, docs, items)
    check(docs_of, items_of, docs, items, top=3)


def test_edges(docs_of, items_of):
    """Nulls, empty and long texts, repeated rows, ids and items, ties, clashing names."""
    items = [(1, "one two"), (1, "one two"), (2, None), (None, "same"), (3, ""), (4, LONG), (5, "b B c"), (6, "\x1c ...")]
    check(docs_of, items_of, EDGES + [(2**63 - 1, "one"), (-5, "one")], items)
    check(docs_of, items_of, [], items)
    check(docs_of, items_of, EDGES, [])
    check(docs_of, items_of, [(1, None), (2, " ")], items)
    check(docs_of, items_of, EDGES, [(2, None), (7, "unheard")])


def test_turns_change_nothing(docs_of, items_of, monkeypatch):
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(vocabulary(rng, 60))) for i in range(200)]
    monkeypatch.setattr(bitslices, "TURN_TERMS", 40)
    check(docs_of, items_of, docs, [(i, docs[i][1][:150]) for i in range(0, 200, 25)])


def test_bounds_hold(spark, docs_of):
    """No document's bound is below its score, and few of the bounds reach far above."""
    rng = np.random.default_rng(2)
    docs = {i: " ".join(vocabulary(rng, int(rng.integers(1, 400)))) for i in range(400)}
    rows = docs_of(list(docs.items())).select(F.col("doc_id").alias("mark"), "text")
    blocks = bitslices.index(rows).toPandas()
    assert blocks["rows"].sum() == 400 and blocks["tokens"].sum() == sum(len(words(t)) for t in docs.values())
    import pandas as pd

    listed = [(k, t.encode(), 100 + len(t)) for k in range(5) for t in dict.fromkeys(words(docs[k]))]
    items = bitslices.Items(pd.DataFrame(listed, columns=["row_id", "term", "weight"]), 400, int(blocks["tokens"].sum()))
    bounds, above, all_ = items.bounds(), 0, 0
    for block in blocks.itertuples():
        marks, found = bounds(block)
        for mark, row in zip(marks.tolist(), found):
            counted = Counter(bitslices.terms(docs[mark]))
            for k, bound in enumerate(row):
                score = items.score(k, counted, counted.total())
                assert bound >= score
                above, all_ = above + (bound > 1.5 * score + 1000), all_ + 1
    assert above < 0.5 * all_


def test_few_documents_are_scored(docs_of, items_of, monkeypatch):
    """The index excludes most documents by their bounds."""
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(vocabulary(rng, 120))) for i in range(2000)]
    sizes, real = [], bitslices.scored

    def counted(docs, chosen, items, top):
        sizes.append(chosen.count())
        return real(docs, chosen, items, top)

    monkeypatch.setattr(bitslices, "scored", counted)
    items = [(i, docs[i][1][:200]) for i in range(5)]
    bitslices.search(docs_of(docs), items_of(items), top=5).collect()
    assert sizes[0] <= 25 and sizes[1] < 0.2 * 5 * len(docs)
