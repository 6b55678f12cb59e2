import numpy as np
from pyspark.sql import functions as F

from skyloom.llm import toxicity

from .conftest import EDGES


def kinds(text):
    counts = toxicity.matches(text, toxicity.Lexicon({}), toxicity.grammar())
    return {k for k, i in toxicity.MATCHES.items() if counts[i]}


def test_grammar_marks_target_negation_and_report():
    assert kinds("you are an idiot") == {(toxicity.INSULT, "t")}
    assert kinds("such an idiot") == {(toxicity.INSULT, "")}
    assert kinds("that was not stupid at all in the end") == {(toxicity.INSULT, "n")}
    assert kinds("the paper said he is a moron") == {(toxicity.INSULT, "rt")}
    assert kinds("I will kill you") == {(toxicity.THREAT, "t")}
    assert kinds("She said so. What trash that thing over there was") == {(toxicity.INSULT, "")}
    assert kinds("a fine day") == kinds(None) == kinds("") == set()


def test_target_after_the_insult_in_a_long_clause():
    assert kinds("what an idiot you are today") == {(toxicity.INSULT, "t")}
    assert kinds("what an idiot of the worst you ever saw") == {(toxicity.INSULT, "t")}
    assert kinds("what an idiot of the very worst you ever saw") == {(toxicity.INSULT, "")}
    assert kinds("never call that idiot you met a friend") == {(toxicity.INSULT, "nt")}


def test_composition_is_both_in_turn():
    one, two = toxicity.marking(toxicity.NEGATION, "n", 3), toxicity.marking(toxicity.TARGET, "t", 3)
    both = one.then(two)
    rng = np.random.default_rng(0)
    for _ in range(50):
        symbols = rng.integers(0, 6, 30).tolist()
        middle, state = [], one.start
        for s in symbols:
            state, out = one.step(state, s)
            middle.append(out)
        want, state = [], two.start
        for s in middle:
            state, out = two.step(state, s)
            want.append(out)
        got, state = [], both.start
        for s in symbols:
            state, out = both.step(state, s)
            got.append(out)
        assert got == want


def corpus():
    """Toxic texts hold inflections of an unknown stem or a given insult; some copies."""
    rng = np.random.default_rng(2)
    syllables = ["ra", "mo", "ti", "ne", "lu", "sha", "ko", "vi"]

    def word():
        return "".join(rng.choice(syllables, rng.integers(2, 5)))

    rows, labels = [], []
    for i in range(900):
        words, toxic = [word() for _ in range(rng.integers(20, 60))], int(i % 5 == 0)
        for _ in range(toxic * 3):
            words[rng.integers(len(words))] = rng.choice(["zorbek" + word(), "idiot"])
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    copy = " ".join(word() + "xq" for _ in range(30))
    rows += [(1000 + i, copy + " " + word()) for i in range(60)]
    labels += [(1000 + i, 1) for i in range(60)]
    return rows, labels


def test_held_out_accuracy(spark, docs_of):
    rows, labels = corpus()
    docs = docs_of(rows + [(2000, " ".join(f"x{i}xq" for i in range(40)))])
    marks = spark.createDataFrame([*labels, (1, None), (0, 0)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.score_toxicity(docs, marks, F.col("doc_id") % 3 != 0).collect()}
    held = [(out[i], y) for i, y in labels if i % 3 == 0 and i < 1000]
    assert np.mean([r.predicted == y for r, y in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    assert out[2000].predicted == 0 and out[0].row_id == "y"


def test_edges(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score_toxicity(docs_of([*EDGES, (30, "you idiot")]), none, F.lit(True)).collect()
    assert len(rows) == len(EDGES) + 1
    assert {r.doc_id for r in rows if r.predicted} == {30}
    assert toxicity.score_toxicity(docs_of([]), none, F.lit(True)).count() == 0


def test_labels_other_than_0_and_1_do_not_count(spark, docs_of):
    docs = docs_of([(i, f"you zorgl number {i}" if i % 2 else f"a fine day {i}") for i in range(40)])
    labels = [(i, i % 2) for i in range(40)] + [(0, 7), (2, -1), (4, None)]
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    plain = spark.createDataFrame(labels[:40], "doc_id long, toxic int")
    a, b = ({r.doc_id: r.score for r in toxicity.score_toxicity(docs, m, F.lit(True)).collect()} for m in (marks, plain))
    assert a == b
