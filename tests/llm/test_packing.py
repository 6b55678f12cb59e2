import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skyloom.llm import packing, tokenizing

from .conftest import EDGES, stored

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER, ENCODER = Tokenizer.from_file(PATH), tokenizing.Encoder(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text(st.sampled_from("aB'st .,1é́İΣς<|endoftext|>\x1c \n")))
def test_words_give_the_ids_of_the_text(text):
    text = text.encode(errors="ignore").decode()
    assert ENCODER.encode(text).tolist() == ids_of(text)


def check(pieces, texts, length=4096):
    """Every id once, in place, with its checksum; sequences gapless. Returns the padding."""
    by = {}
    for p in pieces:
        by.setdefault(p.doc_id, []).append(p)
    assert set(by) == set(texts)
    for doc_id, text in texts.items():
        ids, at = [*ids_of(text), 2], 0
        for p in sorted(by[doc_id], key=lambda p: p.start):
            part = np.array(ids[p.start : p.start + p.length], "<u4")
            assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += p.length
        assert at == len(ids)
    ends = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == ends.get(p.sequence_id, 0) and p.length > 0
        ends[p.sequence_id] = p.offset + p.length
    assert max(ends.values(), default=0) <= length
    return sum(length - e for e in ends.values() if e & (e - 1))


def test_query(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    assert check(packing.op1_nnls_packing(spark, SF_DIR).collect(), texts) == 0


def test_edges(docs_of):
    texts = dict(enumerate(t for _, t in EDGES))
    pieces = packing.pack(docs_of(list(texts.values())), PATH).collect()
    assert check(pieces, texts) == 0
    whole = {}
    for p in sorted(pieces, key=lambda p: p.start):
        whole.setdefault(p.doc_id, []).extend(p.ids)
    assert whole == {i: [*ids_of(t), 2] for i, t in texts.items()}
    assert packing.pack(docs_of([]), PATH).count() == 0
    pieces = packing.pack(docs_of([(1, "a b"), (1, "a b"), (None, None)]), PATH).collect()
    assert sum(p.length for p in pieces) == 7 and sum(p.length for p in pieces if p.doc_id is None) == 1


def test_only_cut_documents_are_shuffled(docs_of, monkeypatch):
    """Without ids the pieces are the same, and the ids of documents in one piece stay where they are."""
    texts = [" ".join(["word"] * n) for n in [5000, 9000, 4095, 4096, 0, *range(1, 300)]]
    seen, real = [], packing.among

    def watched(rows, wanted):
        out = real(rows, wanted)
        seen.append((out.count(), wanted.count()))
        return out

    monkeypatch.setattr(packing, "among", watched)
    with_ids = packing.pack(docs_of(texts), PATH).drop("ids").collect()
    pieces = packing.pack(docs_of(texts), PATH, with_ids=False).collect()
    assert check(pieces, dict(enumerate(texts))) == 0
    assert sorted(map(tuple, pieces)) == sorted(map(tuple, with_ids))
    ids = [p.doc_id for p in pieces]
    cut = {i for i in ids if ids.count(i) > 1}
    assert seen == [(len(cut), len(cut))] and 3 <= len(cut) < 100


@pytest.mark.parametrize("seed", range(3))
def test_lengths_fill_sequences(spark, seed):
    """Common and rare lengths, a short sequence so that many are made."""
    rng = np.random.default_rng(seed)
    sizes = np.concatenate([rng.integers(1, 700, 400), np.full(200, 40), rng.integers(1, 4, 100)])
    df = spark.createDataFrame([(int(i) << 12, int(n)) for i, n in enumerate(sizes)], "row_id long, n long")
    pieces = packing.arranged(stored(spark, df), length=256, grid=32).toPandas()
    by = pieces.sort_values(["row_id", "start"]).groupby("row_id")
    assert [list(g["length"].cumsum().shift(fill_value=0)) == list(g["start"]) for _, g in by].count(False) == 0
    assert by["length"].sum().tolist() == sizes.tolist()
    fill = pieces.groupby("sequence_id")["length"].sum()
    assert fill.max() <= 256 and sum(256 - f for f in fill if f & (f - 1)) == 0
    ordered = pieces.sort_values(["sequence_id", "offset"])
    assert (ordered.groupby("sequence_id")["length"].cumsum() - ordered["length"] == ordered["offset"]).all()


def test_least_squares():
    rng = np.random.default_rng(1)
    a, x = rng.random((12, 8)), np.maximum(rng.normal(size=8), 0)
    assert np.allclose(packing.nonnegative(a, a @ x), x, atol=1e-6)
    b = rng.normal(size=12)
    y = packing.nonnegative(a, b)
    slope = a.T @ (a @ y - b)
    assert (y >= 0).all() and (slope > -1e-6).all() and abs(slope @ y) < 1e-6


def test_combinations_fill():
    columns = packing.combinations(16, 3)
    assert (np.arange(1, 17) @ columns == 16).all() and len(set(map(tuple, columns.T))) == columns.shape[1]


def test_forgotten_encoders_are_made_anew():
    """The caches of a process go once its texts are encoded; ids are the same afterwards."""
    first = tokenizing.encoder(PATH)
    ids = first.encode("a b c").tolist()
    assert tokenizing.encoder(PATH) is first
    tokenizing.forget()
    again = tokenizing.encoder(PATH)
    assert again is not first and again.encode("a b c").tolist() == ids
    tokenizing.forget()
    tokenizing.forget()


def test_an_encoder_remembers_as_many_words_as_asked():
    """More texts do not take more memory, and ids are right whatever is forgotten."""
    own = tokenizing.Encoder(PATH, 50)
    for k in range(40):
        text = " ".join(f"word{chr(97 + k % 26)}{chr(97 + i)}{'x' * (k // 26)}" for i in range(20))
        assert own.encode(text).tolist() == ids_of(text)
        assert len(own.of_word) + len(own.of_word.older) <= 140 and len(own.of_piece) <= 70
    assert tokenizing.encoder(PATH, 50) is not tokenizing.encoder(PATH)
    tokenizing.forget()
