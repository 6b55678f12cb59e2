import numpy as np
import pytest
import xxhash
from conftest import SF_DIR

from skyloom.llm import simhash
from skyloom.llm.components import components

from .conftest import EDGES, stored


def plain_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=2):
    """Least id reachable for (id, fingerprint) rows; ids may repeat."""
    prints = np.array([f for _, f in rows], np.uint64)
    label = {i: i for i, _ in rows}
    while True:
        before = dict(label)
        for k, (i, f) in enumerate(rows):
            near = np.flatnonzero(np.bitwise_count(prints ^ np.uint64(f)) <= radius)
            label[i] = min([label[i], *(label[rows[j][0]] for j in near)])
        if label == before:
            return label


def test_equals_plain(spark):
    found = simhash.op9_simhash(spark, SF_DIR).toPandas()
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = [(i, plain_fingerprint(t)) for i, t in texts.items()]
    want = plain_components(rows)
    assert {r.doc_id: r.fingerprint for r in found.itertuples()} == {i: f"{f:016x}" for i, f in rows}
    assert {r.doc_id: r.component_id for r in found.itertuples()} == want


def test_edges(docs_of):
    found = simhash.near_duplicates(docs_of(EDGES)).collect()
    assert len(found) == len(EDGES)
    by = {(r.doc_id, r.fp): r.component_id for r in found}
    assert by[1, 0] == by[2, 0] == by[3, 0] == by[None, 0] == 1
    assert {r.component_id for r in found if r.doc_id in (5, 6)} == {5}
    assert [r.component_id for r in found if r.doc_id is None and r.fp] == [None]
    kept = simhash.distinct_documents(docs_of(EDGES))
    assert kept.columns == docs_of(EDGES).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i) == [1, 4, 5, 7, 8, 9] and ids.count(None) == 1


def test_empty(docs_of):
    assert simhash.near_duplicates(docs_of([])).count() == 0
    assert simhash.distinct_documents(docs_of([])).count() == 0


def test_an_id_with_several_texts_is_one_node(docs_of):
    found = simhash.near_duplicates(docs_of([(3, "a b c d"), (3, "x y z w"), (1, "x y z w"), (2, "a b c d")])).collect()
    assert {r.component_id for r in found} == {1}


@pytest.mark.parametrize("leaf", [8, 64])
def test_tree_finds_every_pair(spark, leaf):
    """Random fingerprints with near ones planted, and a dense group that no tree can split."""
    rng = np.random.default_rng(leaf)
    base = rng.integers(0, 1 << 63, 300, np.uint64)
    near = base[:100] ^ (np.uint64(1) << rng.integers(0, 64, 100).astype(np.uint64))
    dense = base[0] ^ np.array([(1 << a) | (1 << b) for a in range(20) for b in range(20)], np.uint64)
    values = np.unique(np.concatenate([base, near, dense]))
    reps = spark.createDataFrame([(int(v.astype(np.int64)), i) for i, v in enumerate(values)], "fp long, rep long")
    links = simhash.fingerprint_links(stored(spark, reps), leaf=leaf)
    found = dict(components(links).collect())
    want = plain_components(list(enumerate(values)))
    assert all(found.get(i, i) == c for i, c in want.items())


def test_rows_dealt_grow_with_the_fingerprints(spark, monkeypatch):
    """Random fingerprints, which a tree sends to both sides often: five times as many make five
    times the rows that are compared."""
    dealt, real = [], simhash.block_pairs

    def counted(rows, *args):
        out = real(rows, *args)
        dealt.append(out.count())
        return out

    monkeypatch.setattr(simhash, "block_pairs", counted)
    rng = np.random.default_rng(3)
    for many in (20_000, 100_000):
        values = rng.integers(-(1 << 63), 1 << 63, many)
        reps = spark.createDataFrame([(int(v), i) for i, v in enumerate(values)], "fp long, rep long")
        simhash.fingerprint_links(stored(spark, reps), leaf=1024).count()
    assert 4.5 * dealt[0] < dealt[1] < 6 * dealt[0]


@pytest.mark.parametrize("radius", [0, 2, 5])
def test_close_pairs_span_all(radius, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRS", 50)
    rng = np.random.default_rng(radius)
    keys = np.sort(rng.integers(0, 20, 400))
    values = rng.integers(0, 1 << 9, 400, np.uint64)
    want = {(i, j) for i in range(400) for j in range(i) if keys[i] == keys[j] and (values[i] ^ values[j]).bit_count() <= radius}

    def trees(pairs):
        least = list(range(400))
        for _ in range(400):
            before = list(least)
            for i, j in pairs:
                least[i] = least[j] = min(least[i], least[j])
            if least == before:
                return least

    assert trees(zip(*simhash.close_pairs(keys, values, radius))) == trees(want)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 300)]
    found = dict(components(spark.createDataFrame(path + star + [(5, 5)], "a long, b long")).collect())
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 300)]}
