"""Exact dedup by a content sort, and embedding whitening, against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from blockload.llm import exact_dedup, whitening

NAN, INF = float("nan"), float("inf")


# --- exact dedup ------------------------------------------------------------------

def plain(text):
    return "".join(c for c in text or "" if c not in " \t\n\x0b\x0c\r")


def expected_groups(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(plain(text), []).append((-len(text or ""), i is None, i or 0, i))
    out = []
    for norm, members in groups.items():
        members.sort()
        for k, m in enumerate(members):
            out.append((m[3], members[0][3], len(members), k == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def copies():
    rng = random.Random(13)
    rows = [(i, " ".join(rng.choice(["tea", "Tea", "sun", "größe", " x", "日本"]) for _ in range(rng.randint(1, 4))))
            for i in range(400)]
    rows += [(1000 + i, rng.choice(["a hot  text", "ahot text", "a hot text\n", "ahottext"]) + " " * rng.randint(0, 3))
             for i in range(300)]
    rows += [(2000 + i, rng.choice([None, "", " ", "\r\n\t \x0b\x0c"])) for i in range(40)]
    rows += [(2000, "same row")] * 5 + [(None, "same row")] * 3 + [(None, "no id")] * 4 + [(2100, "x y " * 30_000)] * 3
    rows += [(3000 + i, "the same long start " * 5 + str(i % 50)) for i in range(200)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("large", [1 << 24, 2000])
def test_exact_dedup(spark, copies, monkeypatch, large):
    """With the small limit the hot groups are dealt over many ranges."""
    monkeypatch.setattr(exact_dedup, "GROUP_BYTES", large)
    monkeypatch.setattr(exact_dedup, "PARTITION_BYTES", 20_000)
    docs = spark.createDataFrame(copies, "doc_id long, text string").repartition(6).withColumns(
        {"__norm": F.lit(1), "kept": F.lit("k"), "keep_id": F.lit(2), "text_sha256": F.lit(0), "lang": F.lit("en")})
    got = exact_dedup.exact_duplicates(docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == expected_groups(copies)
    stay = exact_dedup.without_duplicates(docs)
    assert stay.columns == docs.columns
    firsts = {}
    for i, text in sorted(copies, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0)):
        firsts.setdefault(plain(text), (i, len(text or "")))
    assert sorted(((r.doc_id, len(r.text or "")) for r in stay.collect()), key=repr) == sorted(firsts.values(), key=repr)


def test_exact_dedup_sorts_once(spark, copies):
    """The window runs on the ranges: no shuffle beside that of the sort."""
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    plan = exact_dedup.exact_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "hashpartitioning" not in plan
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_exact_dedup_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert exact_dedup.without_duplicates(none).count() == 0


# --- whitening --------------------------------------------------------------------

def usable(v):
    return bool(v) and all(c is not None and np.isfinite(c) for c in v)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(12, 12)) * np.linspace(3, 0.2, 12)
    rows = [(i, (rng.normal(size=12) @ mix).tolist()) for i in range(500)]
    rows += [(7, rows[7][1])] * 200 + [(None, rows[8][1])] * 3                # repeated rows, null ids
    rows += [(900, None), (901, []), (902, [NAN] * 12), (903, [INF] * 12), (904, [None] + [1.0] * 11)]
    rows += [(1000 + i, [float(i), float(-i), 5.0]) for i in range(9)]        # of another length, rank 1
    rows += [(2000, [1.0, 2.0])]                                              # alone in its length
    return rows


def expected_whitening(rows, dim):
    x = [[int(np.floor(np.float64(c) * 1024)) + 100000 for c in v] for _, v in rows if usable(v) and len(v) == dim]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    y = np.array(x, float) - np.array(sums) / n
    v = y.T @ y / n
    values, vecs = np.linalg.eigh(v)
    order = np.argsort(-values)[:8]
    order = [i for i in order if values[i] > 1e-12 * np.trace(v)]
    return n, deviations, values[order] / np.trace(v), y @ vecs[:, order] / np.sqrt(values[order])


def test_whitening(spark, vectors):
    docs = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumns(
        {"dim": F.lit(1), "n": F.lit(2), "c": F.lit("c"), "component": F.lit(0)}).repartition(5)
    got = whitening.whiten(docs).toPandas()
    assert set(got.dim) == {3, 12}                       # a single vector has no covariance
    for dim in (12, 3):
        n, deviations, share, w = expected_whitening(vectors, dim)
        part = got[got.dim == dim].sort_values("component")
        assert set(part.n) == {n} and len(part) == n * len(share)
        assert sorted(part[part.component == 1].deviation) == sorted(deviations)
        assert sorted(int(v) for v in part[part.component == 1].deviation_exact) == sorted(deviations)
        assert part.identity_error.nunique() == 1 and part.identity_error.max() < 1e-9
        ids = [i for i, v in vectors if usable(v) and len(v) == dim]
        for k in range(1, len(share) + 1):
            rows = part[part.component == k]
            assert np.allclose(rows.explained, share[k - 1], rtol=1e-9)
            mine = dict(zip(rows.vec_id, rows.whitened))
            theirs = {i: x for i, x in zip(ids, w[:, k - 1])}
            pairs = np.array([(mine[i], theirs[i]) for i in theirs if i is not None])
            sign = np.sign((pairs[:, 0] * pairs[:, 1]).sum())
            assert np.allclose(pairs[:, 0], sign * pairs[:, 1], atol=1e-8)


def test_whitening_of_extremes(spark):
    """Sums and deviations past 63 bits stay exact; an empty table is no case."""
    rows = [(i, [float(i) * 1e14, -3e14 if i % 2 else 1.0]) for i in range(6)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    _, deviations, _, _ = expected_whitening(rows, 2)
    first = got[got.component == 1].sort_values("vec_id")
    assert [int(v) for v in first.deviation_exact] == deviations and first.deviation.isna().all()
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert whitening.whiten(none).collect() == []
    with pytest.raises(Exception, match="62 bits"):
        whitening.whiten(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>")).collect()


@pytest.mark.parametrize("values", [[5.0] * 9, [3.0, 3, 3, 1, 1, 1, 0, 0, 0, 0.5], [1e-9, 1, 1e9, 2], [4.0], [2.0, 1.0]])
def test_eigenvectors_of_clusters(values):
    q, _ = np.linalg.qr(np.random.default_rng(2).normal(size=(len(values), len(values))))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found, rows = whitening.leading_vectors(a, 8)
    assert np.allclose(found, sorted(values, reverse=True)[:8], rtol=1e-12, atol=1e-12 * max(values))
    assert np.allclose(rows @ rows.T, np.eye(len(rows)), atol=1e-13)
    assert np.abs(a @ rows.T - rows.T * found).max() < 1e-13 * max(values) * len(values)
