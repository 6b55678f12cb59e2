import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from skyloom.llm import merkle

from .conftest import EDGES, stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, chunk int, pos string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc_id, text, lang, source, n_chars):
    return h("".join(map(part, (doc_id, source, lang, n_chars, text))))


def climb(nodes):
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [h("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
        levels.append(nodes)
    return levels


def way(levels, at):
    for nodes in levels[:-1]:
        first = at // 8 * 8
        yield nodes[first:at], nodes[at + 1 : first + 8]
        at //= 8


def plain(rows):
    """The contract, one list at a time."""
    order = lambda r: (r[0] is not None, r[0] or 0, leaf(*r[:5]))
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([leaf(*r[:5]) for r in sorted(groups[g], key=order)]) for g in names}
    top = climb([trees[g][-1][0] for g in names])
    out = []
    for q, g in enumerate(names):
        for at, r in enumerate(sorted(groups[g], key=order)):
            sides = [*way(trees[g], at), *way(top, q)]
            node, text = leaf(*r[:5]), r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                small = "".join(c.lower() if c.isascii() else c for c in text)
                node = leaf(r[0], small, *r[2:5])
            for a, b in sides:
                node = h("".join([*a, node, *b]))
            proof = h("".join("".join(a + b) for a, b in sides))
            out.append((r[0], leaf(*r[:5]), trees[g][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def made(spark, rows):
    return stored(spark, spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(3))


def check(spark, rows):
    found = merkle.proofs(made(spark, rows), merkle.tampered())
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert rows_of(found) == sorted(plain(rows), key=str)


def test_edges(spark):
    """Nulls anywhere, repeated rows and ids, clashing names, ids at both ends, several langs."""
    rows = [(i, t, g, s, n) for k, (i, t) in enumerate(EDGES) for g, s, n in [(None, "s", 1), ("en", None, None), (["é", "", "z"][k % 3], "A", -k)]]
    rows += [(i, "Some Text", "en", "s", 9) for i in (2**63 - 1, -(2**63), 2**63 - 1, 2**53 + 1, 2**53, 0, -1)]
    rows += [(None, f"Text {k}", "en", "s", 9) for k in range(20)] + [(None, "copy", "en", "s", 9)] * 20
    check(spark, rows)


def test_several_tiles_and_chunks(spark):
    """Runs, tiles and chunks that end early, and a lone last node."""
    rng = np.random.default_rng(0)
    rows = [(int(i), f"Word {i}", "en", "s", 1) for i in rng.choice(10**15, 585, replace=False)]
    rows += [(i, f"W{i}", "de", "s", 1) for i in range(8 * 64 + 1)] + [(i, "W", "fr", "s", 1) for i in range(9)]
    check(spark, rows)


def test_more_groups_than_a_tile(spark):
    check(spark, [(i, "T", f"lang {i}", "s", 1) for i in range(520)])


def test_one_row_and_none(spark):
    check(spark, [(3, "Text", "en", "s", 4)])
    check(spark, [(3, "Text", None, None, None)] * 2)
    empty = merkle.proofs(made(spark, []), merkle.tampered())
    assert empty.columns[:2] == ["doc_id", "leaf"] and empty.count() == 0
    assert merkle.roots(made(spark, [])).count() == 0


def test_siblings_are_the_proof(spark):
    rows = [(i, f"T{i}", ["en", "de"][i % 2], "s", 1) for i in range(30)]
    for r in merkle.proofs(made(spark, rows), with_siblings=True).collect():
        assert h("".join(r.siblings)) == r.proof_sha256 and r.verified


def test_roots(spark):
    rows = [(i, f"T{i}", ["en", None][i % 2], "s", 1) for i in range(30)]
    expected = {(r[0], r[2]) for r in plain(rows)}
    found = {r.lang: (r.n, r.subroot) for r in merkle.roots(made(spark, rows)).collect()}
    assert {found[["en", None][i % 2]] for i, _ in expected} == {(15, s) for _, s in expected}


def test_any_change_is_found(spark):
    """Whatever the field, a leaf that changed does not fold to the root; its position stays."""
    rows = [(i, f"T{i}", "en", "s", 1) for i in range(70)]
    docs = made(spark, rows)
    changed = F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit(" ")))
    found = {r.doc_id: r.verified for r in merkle.proofs(docs, changed).collect()}
    assert found == {i: i % 7 != 0 for i in range(70)}
