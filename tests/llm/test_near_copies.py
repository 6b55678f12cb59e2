import numpy as np
import pytest

from skyloom.llm import common, near_copies

from .conftest import EDGES, LONG

PLAIN_WORDS = [f"w{k}" for k in range(4000)]


def plain_set(text):
    found = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    size = min(5, len(found))
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)} if found else set()


def similarity(a, b):
    a, b = plain_set(a), plain_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_kept(rows):
    """Ids that stay, comparing all pairs."""
    sets = [plain_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if rows[i][0] == rows[j][0] or not (a or b) or (a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9):
                group[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(root(i), []).append(doc_id)
    return sorted(min(ids) for ids in least.values())


def edited(rng, text, share):
    """``text`` with so many words replaced that about ``share`` of its shingles stay."""
    found = text.split()
    for _ in range(10_000):
        if similarity(text, " ".join(found)) <= share:
            break
        found[int(rng.integers(len(found)))] = f"new{rng.integers(10**9)}"
    return " ".join(found)


def prose(rng, n):
    return " ".join(rng.choice(PLAIN_WORDS, n))


def test_equals_all_pairs(docs_of):
    """Copies, near copies on both sides of 0.8, chains, a passage many texts share."""
    rng = np.random.default_rng(0)
    passage, rows = prose(rng, 40), []
    for i in range(60):
        rows.append((i, prose(rng, int(rng.integers(30, 200))) + (f" {passage}" if i % 3 == 0 else "")))
    for i in range(60, 100):
        rows.append((i, edited(rng, rows[i - 60][1], [0.95, 0.86, 0.7, 0.5][i % 4])))
    rows += [(100 + i, edited(rng, rows[60 + i][1], 0.9)) for i in range(20)]
    rows += [(200, rows[0][1]), (201, rows[0][1].upper()), (202, LONG), (203, LONG + " tail")]
    kept = sorted(r.doc_id for r in near_copies.distinct_documents(docs_of(rows)).collect())
    assert kept == plain_kept(rows)


def test_recall_of_planted_pairs(docs_of):
    """Pairs at similarities of 0.80 to 0.95: nearly all are found, and no clean text goes."""
    rng = np.random.default_rng(1)
    rows, pairs = [], 0
    for i in range(300):
        text = prose(rng, int(rng.integers(60, 300)))
        rows.append((i, text))
        if i % 2 == 0:
            for _ in range(20):
                copy = edited(rng, text, float(rng.uniform(0.81, 0.96)))
                if similarity(text, copy) >= 0.8:
                    rows.append((1000 + i, copy))
                    pairs += 1
                    break
    kept = {r.doc_id for r in near_copies.distinct_documents(docs_of(rows)).collect()}
    assert set(range(300)) <= kept and pairs > 130
    assert len(kept) - 300 <= 0.02 * pairs


def test_edges(docs_of):
    docs = docs_of(EDGES)
    out = near_copies.distinct_documents(docs)
    assert out.columns == docs.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert sorted(str(k) for k in kept) == sorted(map(str, [(1, None), (4, "one"), (None, "one two three four"), (5, "a b c d e f g"), (7, LONG), (8, EDGES[9][1]), (9, EDGES[10][1])]))
    assert {r.row_id for r in out.collect()} == {"y"} and near_copies.distinct_documents(docs_of([])).count() == 0


def test_large_groups_are_compared_in_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(near_copies, "BLOCK", 20)
    rng = np.random.default_rng(2)
    text = prose(rng, 100)
    rows = [(i, edited(rng, text, 0.93)) for i in range(150)] + [(500 + i, prose(rng, 50)) for i in range(20)]
    kept = sorted(r.doc_id for r in near_copies.distinct_documents(docs_of(rows)).collect())
    assert kept == plain_kept(rows)


@pytest.mark.parametrize("seed", range(5))
def test_linked_spans_what_all_pairs_link(seed):
    rng = np.random.default_rng(seed)
    base = [rng.integers(0, 300, 40) for _ in range(6)]
    sets = []
    for _ in range(40):
        own = base[int(rng.integers(6))].copy()
        own[rng.random(40) < 0.06] = rng.integers(1000, 2000)
        sets.append(np.unique(own).astype(np.uint64))

    def group(pairs):
        of = list(range(len(sets)))
        for _ in sets:
            for a, b in pairs:
                of[a] = of[b] = min(of[a], of[b])
        return of

    every = [(i, j) for i in range(40) for j in range(i) if len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]
    found = list(zip(*near_copies.linked(sets, 0.8)))
    assert group(found) == group(every) and all((max(p), min(p)) in set(every) for p in found)


def test_shingles_are_those_of_the_words():
    hashes = common.Hashes()
    for text in ("a b c d e f", "A  b\tC d e f", "one", "", "a a a a a a a"):
        assert len(near_copies.shingles(common.words(text), hashes)) == len(plain_set(text))
    same = [near_copies.shingles(common.words(t), hashes).tolist() for t in ("a b c d e f", "A  b\tC d e f")]
    assert same[0] == same[1]


def test_equal_groups_are_compared_once(spark):
    """Members that meet under several kinds make one group; other members make others."""
    rows = [(1, 7, [10, 20, 30]), (2, 7, [10, 20, 31]), (3, 9, [10, 21, 32]), (4, 1 << 40, [99, 98, 97])]
    contents = spark.createDataFrame(rows, "content long, fp long, samples array<long>")
    found = {}
    for r in near_copies.candidate_groups(contents).collect():
        found.setdefault((r.kind, r.sig), []).append(r.content)
    assert sorted(sorted(g) for g in found.values()) == [[1, 2], [1, 2, 3]]


def test_texts_are_not_shuffled_for_the_ids_that_stay(docs_of, spark):
    """However many ids there are; ids of both signs, and at both ends of a word of bits."""
    ids = [-(1 << 62), -65, -64, -1, 0, 1, 62, 63, 64, (1 << 62) - 1]
    docs = docs_of([(i, f"a text of its own for {i}") for i in ids] + [(63, "a second text of that id")])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = near_copies.distinct_documents(docs)
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        kept = [(r.doc_id, r.text) for r in out.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(i for i, _ in kept) == ids and (63, "a second text of that id") in kept
