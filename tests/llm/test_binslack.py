import zlib
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st

from skyloom.llm import binslack

from .conftest import EDGES, LONG
from .test_packing import ids_of

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(found, texts, length=4096):
    """Every id once and in place, pieces cut only where they must be, sequences gapless. Returns
    the number of sequences and the least there could be."""
    by = {}
    for p in found:
        by.setdefault(p.doc_id, []).append(p)
    assert set(by) == set(texts)
    total = 0
    for doc_id, text in texts.items():
        ids = np.array([*ids_of(text), 1], "<u4")
        total += len(ids)
        mine = sorted(by[doc_id], key=lambda p: p.piece)
        assert [(p.piece, p.start) for p in mine] == list(enumerate(range(0, len(ids), length)))
        for p in mine:
            part = ids[p.start : p.start + length]
            assert (p.length, p.ids_crc32) == (len(part), zlib.crc32(part.tobytes()))
    ends = {}
    for p in sorted(found, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends.get(p.sequence_id, 0)
        ends[p.sequence_id] = p.offset + p.length
    assert max(ends.values(), default=0) <= length
    return len(ends), -(-total // length)


def test_query(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    made, least = check(binslack.op12_min_bin_slack(spark, SF_DIR).collect(), texts)
    assert made <= least + 1


def test_edges(docs_of):
    texts = dict(enumerate([t for _, t in EDGES] + [LONG, LONG, "w " * 4095, "w " * 4096, "w " * 8191]))
    found = binslack.pack(docs_of(list(texts.values())), PATH).collect()
    made, least = check(found, texts)
    assert made <= least + 1
    for p in found:
        assert p.ids == [*ids_of(texts[p.doc_id]), 1][p.start : p.start + p.length]
    assert binslack.pack(docs_of([]), PATH).count() == 0
    found = binslack.pack(docs_of([(2**63 - 1, "a b"), (2**63 - 1, "a b"), (None, None)]), PATH).collect()
    assert sorted((p.doc_id or 0, p.length) for p in found) == [(0, 1), (2**63 - 1, 3), (2**63 - 1, 3)]
    assert len({p.sequence_id for p in found}) == 1 and sorted(p.offset for p in found) in ([0, 1, 4], [0, 3, 6], [0, 3, 4])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=9), st.integers(1, 30))
def test_fullest_equals_brute_force(lengths, room):
    counts = np.bincount(lengths, minlength=31)
    chosen = binslack.fullest(counts, sorted(set(lengths), reverse=True), room)
    fill = sum(x * n for x, n in chosen.items())
    assert all(n <= counts[x] for x, n in chosen.items())
    sums = {0}
    for x in lengths:
        sums |= {s + x for s in sums}
    assert fill == max(s for s in sums if s <= room)


def fewest(lengths, length):
    """Bins of the best packing there is, by trying all."""
    best = len(lengths)

    def put(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(lengths):
            best = len(bins)
            return
        for i in sorted({b: i for i, b in enumerate(bins)}.values()):
            if bins[i] + lengths[k] <= length:
                put(k + 1, [*bins[:i], bins[i] + lengths[k], *bins[i + 1 :]])
        put(k + 1, [*bins, lengths[k]])

    lengths = sorted(lengths, reverse=True)
    put(0, [])
    return best


@pytest.mark.parametrize("seed", range(30))
def test_few_bins(seed):
    """At most one bin more than the best packing, and every length used up."""
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 41, 11)
    counts = np.bincount(lengths, minlength=41)
    chosen = binslack.plan(counts, 40)
    used = np.zeros(41, np.int64)
    for need, times in chosen:
        assert sum(x * n for x, n in need.items()) <= 40
        for x, n in need.items():
            used[x] += n * times
    assert (used == counts).all()
    assert sum(times for _, times in chosen) <= fewest(lengths.tolist(), 40) + 1


def test_spans_deal_every_rank_once():
    counts = np.bincount([*np.random.default_rng(0).integers(1, 60, 3000), *[20] * 1000], minlength=65)
    chosen = binslack.plan(counts, 64)
    table = binslack.spans(chosen)
    assert (np.diff(table[:, 0]) > 0).all()
    places = set()
    for x in np.flatnonzero(counts):
        for rank in range(counts[x]):
            key = int(x) << binslack.RANKS | rank
            first, copies, sequence, offset = table[np.searchsorted(table[:, 0], key, side="right") - 1].tolist()
            assert first >> binslack.RANKS == x
            at = offset + (key - first) % copies * int(x)
            places |= {(sequence + (key - first) // copies, at + i) for i in range(x)}
    assert len(places) == counts @ np.arange(65)


def test_repeats_equal_one_search_a_bin():
    """A combination made often is what searching bin by bin finds as often."""
    counts = np.bincount([x for pair in combinations_with_replacement(range(5, 20), 2) for x in pair], minlength=33)
    chosen, left, bins = binslack.plan(counts, 32), counts.copy(), 0
    while left.any():
        lengths = [int(x) for x in np.flatnonzero(left)[::-1]]
        left[lengths[0]] -= 1
        for x, n in binslack.fullest(left, [x for x in lengths if left[x]], 32 - lengths[0]).items():
            left[x] -= n
        bins += 1
    assert abs(sum(times for _, times in chosen) - bins) <= 1
