"""Similarity sketching, Merkle manifest and whitening against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import math
import os
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quotewell.llm import charpoly, merkle, queries, similarity, whitening

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
WORD = re.compile("[^\x20\x09-\x0D]+")
CLASHING = ["rep", "n", "digest", "bands", "group", "at", "size", "hash", "step", "path", "root", "kept", "component", "x", "i", "v", "low", "tie", "part"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def run(spark, name):
    return queries.QUERIES[name](spark, SF).collect()


def clashing(df):
    return df.withColumns({c: F.lit("own") for c in CLASHING if c not in df.columns})


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


# ---- 11 similarity sketching ----------------------------------------------------------------------


def shingles(text, k):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def plain_groups(rows, k, num):
    """{key: (size, smallest key reachable)}, every pair compared."""
    sets = {key: shingles(text, k) for key, text in rows if key is not None}
    parent = {key: key for key in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= num * (len(sets[a]) + len(sets[b]) - both):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
    return {key: (len(s), find(key)) for key, s in sets.items()}


def test_op11_over_the_table(spark, docs):
    want = plain_groups([(d.doc_id, d.text) for d in docs], 2, 80)
    rows = run(spark, "op11_minhash")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want and len(rows) == len(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_sketches_fill_every_bin_and_agree_as_often_as_the_sets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (1, 2, 3, 40, 700, 5000)]
    out = similarity.sketches([*sets, np.empty(0, np.uint64)])
    assert (out[:-1] != similarity._EMPTY).all() and (out[-1] == similarity._EMPTY).all()
    assert (similarity.sketches(sets[3:4])[0] == out[3]).all()  # alone or among others
    few = np.unique((out[2] & np.uint64(2**52 - 1)))
    assert len(few) <= similarity.BINS
    for n, share in ((50, 0.5), (400, 0.8), (3000, 0.3)):
        own = rng.integers(0, 2**63, 2 * n).astype(np.uint64)
        same = round(2 * n * share)
        a = np.unique(own[: same + (2 * n - same) // 2])
        b = np.unique(np.concatenate([own[:same], own[same + (2 * n - same) // 2 :]]))
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        sa, sb = similarity.sketches([a, b])
        assert abs((sa == sb).mean() - true) < 5 * math.sqrt(true * (1 - true) / similarity.BINS) + 0.01


def test_sketch_is_the_least_throw_of_every_bin():
    """Against the definition, round by round and element by element."""
    rng = np.random.default_rng(8)
    for n in (1, 5, 30):
        own = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        bins = 16
        want = [None] * bins
        for r in range(2 * bins):
            thrown = similarity._thrown(own, r)
            at = [r - bins] * n if r >= bins else ((similarity.words.mix(thrown) >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(int).tolist()
            for b, x in zip(at, thrown.tolist()):
                value = (r << 52) | (x >> 12)
                want[b] = value if want[b] is None else min(want[b], value)
        assert similarity.sketches([own], bins)[0].tolist() == want


def test_near_duplicates_of_odd_rows(spark):
    body = " ".join(f"w{i}" for i in range(60))
    rows = [(5, body), (3, body + " x"), (9, body.upper()), (9, body.upper()), (4, "alone here"), (None, body), (7, None), (8, ""), (6, "ALONE here"), (2, "one"), (1, "One"), (10, " \n ")]
    df = clashing(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in similarity.near_duplicates(df, k=2).collect()), key=str)
    want = plain_groups(rows, 2, 80)
    assert got == sorted([(k, *want[k], want[k][1] == k) if k is not None else (None, 59, None, None) for k, _ in rows], key=str)
    assert similarity.near_duplicates(df.limit(0)).collect() == []


def test_large_buckets_are_compared_in_units(spark, monkeypatch):
    """Chains of texts, each near the next only, in buckets of many groups; units far smaller than the buckets."""
    rng = random.Random(2)
    rows, key = [], 0
    for _ in range(4):
        words = [f"w{rng.randrange(10**6)}" for _ in range(120)]
        for _ in range(25):
            words = words[:]
            for _ in range(3):
                words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
            rows.append((key := key + 1, " ".join(words)))
    rng.shuffle(rows)
    monkeypatch.setattr(similarity, "UNIT", 400)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in similarity.near_duplicates(df, k=2, bins=64, rows=1).collect()}
    assert got == {k: g for k, (_, g) in plain_groups(rows, 2, 80).items()}


def test_keys_of_text(spark):
    rows = [("b", "some words to share between them"), ("a", "some words to share between them"), ("c", "others")]
    got = {r.name: r.component_id for r in similarity.near_duplicates(spark.createDataFrame(rows, "name string, text string"), key="name", k=2).collect()}
    assert got == {"a": "a", "b": "a", "c": "c"}


# ---- 12 Merkle manifest ---------------------------------------------------------------------------


def plain_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves):
    """(root, [[(left, right), ...] of each leaf])."""
    paths, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = nodes[place - place % 3 : place - place % 3 + 3]
            paths[i].append(("".join(run[: place % 3]), "".join(run[place % 3 + 1 :])))
        nodes = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)]
        at = [place // 3 for place in at]
    return nodes[0], paths


def plain_manifest(rows):
    """Contract rows of (doc_id, source, lang, n_chars, text) tuples."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, plain_leaf(*r), r))
    names = sorted(by, key=lambda s: b"" if s is None else b"=" + s.encode())
    subs = {s: plain_tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in names}
    root, upper = plain_tree([subs[s][0] for s in names])
    out = []
    for s, above in zip(names, upper):
        for (_, _, leaf, r), path in zip(sorted(by[s], key=lambda x: x[:3]), subs[s][1]):
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            node = plain_leaf(*r[:4], text)
            for left, right in path + above:
                node = sha(left + node + right)
            out.append((r[0], leaf, subs[s][0], root, sha("".join(a + b for a, b in path + above)), node, node == root))
    return sorted(out, key=str)


def contract(rows):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in rows), key=str)


def test_op12_over_the_table(spark, docs):
    got = contract(run(spark, "op12_merkle"))
    assert got == plain_manifest([(d.doc_id, d.source, d.lang, d.n_chars, d.text) for d in docs])
    assert {r[-1] for r in got} == {True, False}


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("block", [3, 9, 3**9])
def test_manifest_of_odd_rows(spark, monkeypatch, block):
    """Groups of every small size, null and empty sources, null keys, repeated rows, line breaks, blocks of one run."""
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows = [(i * 100 + j, f"s{i}", "en", j, f"line {j}\nend") for i in range(1, 12) for j in range(i)]
    rows += [(j, "hot", None, None, "a\nb" * (j % 3)) for j in range(2000, 2100)]
    rows += [(1, None, None, None, None), (None, None, "x", 3, "\n"), (2, "", "y", 1, "ü\n"), (77, "é", "y", 1, ""), (5, "dup", "y", 1, "q")]
    rows += [(5, "dup", "y", 1, "q")] * 3 + [(5, "dup", "y", 2, "other\n")]
    df = clashing(spark.createDataFrame(rows, SCHEMA).repartition(7))
    assert contract(merkle.tampered_manifest(df).collect()) == plain_manifest(rows)


def test_manifest_of_one_and_of_no_row(spark):
    one = [(4, "a", "b", 2, "x\ny")]
    got = merkle.tampered_manifest(spark.createDataFrame(one, SCHEMA)).collect()
    assert contract(got) == plain_manifest(one) and got[0].leaf == got[0].root and got[0].proof_sha256 == sha("")
    assert merkle.tampered_manifest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_manifest_keeps_other_columns(spark):
    rows = spark.createDataFrame([(i, "g", f"leaf{i}", "own") for i in range(5)], "id int, name string, leaf string, path_ string").withColumn("group", F.lit("own"))
    out = merkle.manifest(rows, "name", ["id"], "leaf")
    assert out.columns == ["id", "name", "leaf", "path_", "group", "subroot", "root", "path"]
    assert {r.group for r in out.collect()} == {"own"}


# ---- 13 whitening ---------------------------------------------------------------------------------


def leading_minors(matrix):
    """Characteristic polynomial by traces of powers (Faddeev and Le Verrier), in fractions."""
    n = len(matrix)
    a = [[Fraction(v) for v in row] for row in matrix]
    m, c = [[Fraction(0)] * n for _ in range(n)], [Fraction(0)] * n + [Fraction(1)]
    for k in range(1, n + 1):
        m = [[sum(a[i][t] * m[t][j] for t in range(n)) + (c[n - k + 1] if i == j else 0) for j in range(n)] for i in range(n)]
        am = [[sum(a[i][t] * m[t][j] for t in range(n)) for j in range(n)] for i in range(n)]
        c[n - k] = -sum(am[i][i] for i in range(n)) / k
    return [int(v) for v in c]


@pytest.mark.parametrize("d", [1, 2, 3, 6, 9])
def test_polynomial_is_exact(d):
    rng = np.random.default_rng(d)
    z = rng.integers(-(10**6), 10**6, (d + 3, d))
    for matrix in ((z.T @ z).tolist(), np.diag(rng.integers(0, 4, d)).tolist(), np.zeros((d, d), int).tolist()):
        found = charpoly.combined({p: charpoly.modulo(matrix, p) for p in charpoly.primes(charpoly.coefficient_bits(matrix))})
        assert found == leading_minors(matrix)


def test_primes_are_primes():
    for p in charpoly.primes(200):
        assert p < 1 << 31 and all(p % q for q in range(3, math.isqrt(p) + 1, 2))


def test_roots_repeat_and_end_at_zero():
    roots = [9, 9, 9, 4, 4, 1, 0, 0]
    c = [1]
    for r in roots:
        c = [a - r * b for a, b in zip([0, *c], [*c, 0])]
    found = charpoly.Roots(c)
    assert [(r / 2**found.scale, n) for r, n in found.largest(8)] == [(9, 3), (4, 2), (1, 1)]
    assert [n for _, n in found.largest(1)] == [3]


def test_eigenvectors_of_close_and_repeated_roots():
    """Two roots a thousand-millionth apart, and one of multiplicity three, under an exact integer rotation."""
    q = [[1, 2, 2, 0], [2, 1, -2, 0], [2, -2, 1, 0], [0, 0, 0, 3]]  # rows at right angles, of length 3
    for diagonal in ([10**9 + 1, 10**9, 5, 2], [7, 7, 7, 2]):
        matrix = [[sum(q[k][i] * diagonal[k] * q[k][j] for k in range(4)) for j in range(4)] for i in range(4)]
        found = charpoly.Roots(charpoly.combined({p: charpoly.modulo(matrix, p) for p in charpoly.primes(charpoly.coefficient_bits(matrix))}))
        basis = []
        for root, n in found.largest(4):
            for v in charpoly.eigenvectors(matrix, root, found.scale, n):
                basis.append(v)
                back = np.array(matrix, float) @ v
                assert np.allclose(back, root / 2**found.scale * np.array(v), rtol=1e-13, atol=1e-6)
        assert np.allclose(np.array(basis) @ np.array(basis).T, np.eye(4), atol=1e-15)
    exact = [9 * v for v in (10**9 + 1, 10**9)]
    close = charpoly.Roots(charpoly.combined({p: charpoly.modulo(m, p) for m in [[[exact[0], 0], [0, exact[1]]]] for p in charpoly.primes(200)}))
    assert [r / 2**close.scale for r, _ in close.largest(2)] == exact


def plain_whitened(rows, components=16):
    """{(key, component): ...} by numpy's own eigenvectors, and (n, deviations)."""
    whole = [(k, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in whole})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array([[n * a - s for a, s in zip(x, sums)] for x in fit], float) / n
    cov = y.T @ y / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    deviation = {k: sum((n * a - s) ** 2 for a, s in zip(x, sums)) for k, x in whole}
    out = {}
    for k, x in whole:
        own = np.array([n * a - s for a, s in zip(x, sums)], float) / n @ (vectors / np.sqrt(values))
        out |= {(k, i + 1): w for i, w in enumerate(own)}
    return n, deviation, out, values / np.trace(cov), len(whole)


def compare(rows, got):
    n, deviation, want, explained, count = plain_whitened(rows)
    assert len(got) == count * len(explained) and {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1
    assert got[0].identity_error < 1e-9
    sign = {}
    for r in got:
        assert r.deviation == deviation[r.vec_id]
        assert abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        w = want[r.vec_id, r.component]
        if abs(w) > 1e-3:
            sign.setdefault(r.component, np.sign(w * r.whitened))
        assert abs(r.whitened * sign.get(r.component, 1) - w) < 1e-8 * max(1, abs(w)) or abs(w) <= 1e-3


def test_op13_over_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare(rows, run(spark, "op13_whitening"))


def test_whitening_of_odd_rows(spark):
    rng = random.Random(1)
    base = [(i, [rng.gauss(0, 3) * (j + 1) for j in range(5)]) for i in range(40)]
    rows = [*base, (50, None), (51, [1.0, None, 2.0, 0.0, 1.0]), (52, [float("nan")] * 5), (53, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (54, base[3][1]), (55, base[3][1])]
    df = clashing(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"))
    compare(rows, whitening.whitened(df).collect())
    others = df.union(spark.createDataFrame([(60, [1.0]), (61, []), (62, [1.0] * 6)], "vec_id bigint, embedding array<double>").withColumns({c: F.lit("own") for c in df.columns[2:]}))
    assert {r.vec_id for r in whitening.whitened(others).collect()} == {k for k, v in rows if k < 50 or k > 53}


def test_whitening_without_spread(spark):
    kind = "vec_id bigint, embedding array<float>"
    assert whitening.whitened(spark.createDataFrame([], kind)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, None), (2, [])], kind)).collect() == []
    assert whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], kind)).collect() == []
    flat = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 2.0]), (None, [4.0, 2.0])], kind)).collect()
    assert [(r.component, r.n) for r in flat] == [(1, 3)] * 3 and flat[0].explained == 1.0
    far = whitening.whitened(spark.createDataFrame([(1, [3e38, 0.0]), (2, [-3e38, 1.0]), (3, [0.0, 2.0])], kind)).collect()
    assert {r.vec_id for r in far} == {1, 2, 3} and far[0].identity_error < 1e-6


def test_integers_of_lists():
    keep, x, bounds = whitening.integers(pa.array([[0.5, -0.01], None, [None, 1.0], [], [2.0, 1e300]], pa.list_(pa.float64())))
    assert keep.tolist() == [0, 3, 4] and bounds.tolist() == [0, 2, 2, 4]
    assert x.tolist() == [1_000_032, 999_999, 1_000_128, whitening.MOST + 1_000_000]
