import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from skyloom.llm import bloom_lm
from skyloom.llm.common import fold

from .conftest import EDGES


def held_out(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def tokens(text):
    return [*(text or "").encode().lower().split(), None]


def check(rows, docs):
    """Counts and base scores against plain ones; rows come in the order of docs."""
    learnt = Counter(t for i, text in docs if not held_out(i) for t in tokens(text))
    total, distinct = sum(learnt.values()), len(learnt)
    for row, (doc_id, text) in zip(rows, docs, strict=True):
        mine = tokens(text)
        base = sum(math.log10((learnt[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in mine)
        known = sum(learnt[t] > 0 for t in mine)
        assert (row.doc_id, row.held_out, row.n_tokens, row.n_known) == (doc_id, held_out(doc_id), len(mine), known)
        assert row.train_tokens == total
        assert row.base_score == pytest.approx(base, rel=1e-9)
        assert row.score <= 1e-9


def key(row):
    return (row[0] is None, row[0] or 0, row[1] if isinstance(row[1], int) else 0)


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    rows = bloom_lm.op3_bloom_lm(spark, SF_DIR).collect()
    check(sorted(rows, key=lambda r: r.doc_id), sorted(map(tuple, docs)))
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def scores(docs, **kw):
    rows = bloom_lm.score_texts(docs, fold(F.col("doc_id"), 10) != 0, **kw).collect()
    return sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens))


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, len(tokens(r[1]))))


def test_edges(docs_of):
    check(scores(docs_of(EDGES)), ordered(EDGES))
    assert scores(docs_of([])) == []
    check(scores(docs_of([(None, "a b"), (None, None)])), ordered([(None, "a b"), (None, None)]))


def test_small_head_and_turns_change_nothing_but_rounding(docs_of):
    """Words beyond the head are joined; a filter beyond its bound goes out in turns."""
    rng = np.random.default_rng(0)
    texts = [(i, " ".join(f"w{int(w)}" for w in rng.zipf(1.5, 200) if w < 3000)) for i in range(120)]
    whole, small = scores(docs_of(texts)), scores(docs_of(texts), head_words=20)
    check(small, ordered(texts))
    turns = scores(docs_of(texts), head_words=20, max_bytes=6_000)
    check(turns, ordered(texts))
    assert sum(r.score for r in whole) == pytest.approx(sum(r.score for r in small), rel=0.05)
    assert sum(r.score for r in turns) == pytest.approx(sum(r.score for r in small), rel=0.05)


@pytest.mark.parametrize("max_bytes", [40_000, 6_000])
def test_turns_change_only_rounding_of_each_score(docs_of, max_bytes):
    """Pairs in turns; then words too, which go out with as many bits as ever."""
    rng = np.random.default_rng(3)
    texts = [(i, " ".join(f"w{int(w)}" for w in rng.zipf(1.3, 300) if w < 20_000)) for i in range(150)]
    small = scores(docs_of(texts), head_words=20)
    turns = scores(docs_of(texts), head_words=20, max_bytes=max_bytes)
    check(turns, ordered(texts))
    assert [r.score for r in turns] == pytest.approx([r.score for r in small], rel=1e-9)


def test_filter_holds_every_level_and_little_else():
    rng = np.random.default_rng(2)
    hashes, levels = rng.integers(0, 1 << 63, 20_000, np.uint64), rng.integers(1, 9, 20_000)
    words = bloom_lm.filled(hashes, levels, 32)
    found = bloom_lm.Filter(words, np.array([len(words)])).level(hashes)
    assert (found >= levels).all() and (found > levels).mean() < 1e-3
    absent = rng.integers(1 << 63, (1 << 64) - 1, 200_000, np.uint64)
    assert (bloom_lm.Filter(words, np.array([len(words)])).level(absent) > 0).mean() < 1e-4


def test_levels_bracket_counts():
    counts = np.arange(2, 5000)
    level = bloom_lm.level_of(counts, 2)
    assert (bloom_lm.lower_end(level, 2) <= counts).all() and (counts <= bloom_lm.upper_end(level, 2)).all()


def test_probabilities_sum_to_one_at_most():
    """Over the vocabulary and the unknown word, after every history of a small text."""
    text = [b"a b a b c a b d a a b c e".split() * 3]
    token, _ = bloom_lm.tokens(text, bloom_lm.Hashes())
    word, times = np.unique(token, return_counts=True)
    pair, often = np.unique(bloom_lm.pair_hash(bloom_lm.histories(token), token), return_counts=True)
    slice_ = bloom_lm.filled(pair[often > 1], bloom_lm.level_of(often[often > 1], 2), 64)
    none = (np.empty(0, np.uint64), np.zeros(1, np.int64))
    rest = (none, (slice_, np.array([len(slice_)])), int(times.sum()), len(word), 2, np.full(64, 0.7))
    model = bloom_lm.Model(word, times, *rest)
    for history in word:
        after = np.append(word, np.uint64(12345))
        line = np.stack([np.full(len(after), history), after], axis=1).ravel()
        alone, pair_count, before, _, _ = model.parts(line)
        total = (10 ** model.log10(alone, pair_count, before))[1::2].sum()
        assert total <= 1 + 1e-9


def test_weights_come_from_all_tokens(docs_of, monkeypatch):
    """Beyond 500 texts too; and a text that is there many times counts as often."""
    seen = []
    fitted = bloom_lm.maximised
    monkeypatch.setattr(bloom_lm, "maximised", lambda cells, times: seen.append(times.sum()) or fitted(cells, times))
    texts = [(i, f"a b c{i} a b d{i % 7}" if i % 3 else "a b a b") for i in range(1_000)]
    rows = scores(docs_of(texts), max_bytes=6_000)
    assert seen == [sum(len(tokens(text)) for i, text in texts if not held_out(i))] == [rows[0].train_tokens]


def test_weights_raise_the_likelihood():
    """Half of the tokens follow their history, at a ratio of 8; a weight of about half comes out."""
    one = 1 + 32 * (bloom_lm.RATIO_REACH + 3)
    weights = bloom_lm.maximised(np.array([0, one]) + 5 * bloom_lm.RATIO_CELLS, np.array([1_000.0, 1_000.0]))
    w = np.linspace(0.01, 0.99, 99)
    best = w[np.argmax(np.log(1 - w) + np.log(w * 8 + 1 - w))]
    assert weights[5] == pytest.approx(best, abs=0.02)


def test_words_are_hashed_together(monkeypatch):
    """As many tokens as plain splitting finds, in order, one hash a word: odd bytes, long words, no words."""
    texts = ["A b\x00 b\x00\x00\tc\x0bd a", None, "", " ", "x" * 64 + " " + "X" * 65 + " " + "x" * 65, " \u00e9\u00a0\u00df \x1cq\x0c",
             "abcdefgh abcdefghi ABCDEFGH", "\n\n", "\u00c9 \u00e9"]
    plain = [t for text in texts for t in tokens(text)]
    token, doc = bloom_lm.text_tokens(texts)
    assert np.bincount(doc).tolist() == [len(tokens(text)) for text in texts]
    assert len(set(zip(plain, token.tolist()))) == len(set(plain)) == len(set(token.tolist()))
    lines = [("abc\u00e9" * n)[:n] for n in range(70)]
    split = [tokens(line)[:-1] for line in lines]
    assert (bloom_lm.text_tokens(lines)[0] == bloom_lm.tokens(split, bloom_lm.Hashes())[0]).all()
    monkeypatch.setattr(bloom_lm, "CHUNK_BYTES", 10)
    rows = list(bloom_lm.portions([pd.DataFrame({"text": texts}), pd.DataFrame({"text": texts[:0]})]))
    assert len(rows) > 3 and pd.concat(rows)["text"].tolist() == texts
    assert np.concatenate([bloom_lm.text_tokens(r["text"])[0] for r in rows]).tolist() == token.tolist()
