import numpy as np
from conftest import SF_DIR
from pyspark.sql import functions as F

from skyloom.llm import languages

from .conftest import EDGES

AA, BB = "tono mino rano sato nito", "grusk frast stolk kreft brask"


def texts():
    rng = np.random.default_rng(1)
    some = [" ".join(rng.choice(t.split(), 30)) for t in (AA, BB) * 30]
    return [(i, t) for i, t in enumerate(some)], ["aa", "bb"] * 30


def found(docs):
    rows = languages.identify(docs, F.col("doc_id") % 4 != 2).collect()
    return {r.doc_id: r for r in rows}


def test_held_out_accuracy(spark):
    rows = languages.op10_languages(spark, SF_DIR).collect()
    langs = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "lang").collect())
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(langs) and all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) >= 0.97


def test_mixtures_and_edges(docs_of):
    rows, langs = texts()
    rows += [(102, f"{AA} " * 40 + f"{BB} " * 20), (106, AA * 50), (110, "123 .. 4"), *((200 + i, t) for i, (_, t) in enumerate(EDGES))]
    out = found(docs_of(rows, langs + [None] * (len(rows) - len(langs))))
    assert all(out[i].lang_pred == g for i, g in enumerate(langs))
    mixed = out[102].lang_shares
    assert out[102].lang_pred == "aa" and abs(mixed["aa"] - 2 / 3) < 0.02 and abs(sum(mixed.values()) - 1) < 1e-6
    assert out[106].lang_shares.keys() == {"aa"} and out[106].score == 1.0
    assert (out[110].lang_pred, out[110].score) == ("und", 0.0)
    assert [out[200 + i].lang_pred == "und" for i in range(4)] == [True, True, True, False]
    assert out[0].row_id == "y" and out[0].kind == 1


def test_numbers_that_are_no_letters(docs_of):
    """Fractions, superscripts and number signs are no letters, wherever they stand."""
    rows, langs = texts()
    odd = [(300, "½ ² Ⅷ ①"), (304, "¾"), (308, "½" + AA.replace(" ", "²")), (312, "_ 1٣")]
    out = found(docs_of(rows + odd, langs + [None] * 4))
    assert [out[i].lang_pred for i in (300, 304, 308, 312)] == ["und", "und", "aa", "und"]
    assert languages.letter_words("a½b ab½ ½") == {"a": 1, "b": 1, "ab": 1}


def test_columns_with_clashing_names_stay(docs_of):
    rows, langs = texts()
    docs = docs_of(rows, langs)
    out = languages.identify(docs, F.lit(True))
    assert {(r._language, r._found, r._node) for r in out.collect()} == {("l", "f", "n")}


def test_nothing_to_learn_from(docs_of):
    assert {r.lang_pred for r in found(docs_of(EDGES)).values()} == {"und"}
    assert found(docs_of([])) == {}


def test_mixture_increases_likelihood():
    rng = np.random.default_rng(3)
    like, weight, doc = rng.normal(size=(50, 3)) * 3, rng.integers(1, 5, 50).astype(float), np.repeat([0, 1], 25)
    shares, value = languages.mixture(like, weight, doc, np.ones((2, 3)))
    for d in range(2):
        best = max(
            (weight[doc == d] * np.log(np.exp(like[doc == d]) @ np.array([a, b, 1 - a - b]))).sum()
            for a in np.linspace(0, 1, 41)
            for b in np.linspace(0, 1 - a, 41)
        )
        assert value[d] >= best - 0.05 and abs(shares[d].sum() - 1) < 1e-9
