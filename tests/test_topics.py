"""SVD and NMF on (key, term, n) tables against numpy."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.ml import topics


@pytest.fixture(scope="module")
def counts(spark):
    rnd = random.Random(2)
    # three kinds of documents; keys beyond 32 bits
    rows = [((1 << 40) + i, f"t{j:02d}", rnd.randrange(1, 4) + 6 * (j % 3 == i % 3) + 3 * (j % 3 == 0 == i % 3))
            for i in range(60) for j in range(24) if rnd.random() < 0.6]
    df = spark.createDataFrame(rows, "k long, term string, n long")
    m = np.zeros((60, 24))
    for k, t, n in rows:
        m[k - (1 << 40), int(t[1:])] = n
    return df, m


@pytest.mark.parametrize("extra", [32, 4])  # the whole vocabulary, and a narrow block of several rounds
def test_svd_tables_equal_numpy(counts, extra):
    df, m = counts
    s, right = topics.svd_tables(df, "k", 3, extra=extra, tol=1e-10)
    _, want, vt = np.linalg.svd(m, full_matrices=False)
    assert s == pytest.approx(want[:3], rel=1e-8)
    v = np.array([r["x"] for r in right.orderBy("term").collect()])
    assert np.abs(v.T) == pytest.approx(np.abs(vt[:3]), abs=1e-3)
    assert all(v[np.abs(v[:, i]).argmax(), i] > 0 for i in range(3))


def test_svd_of_low_rank_and_of_nothing(spark):
    one = spark.createDataFrame([(i, t, n * i) for i in (1, 2, 3) for t, n in (("a", 1), ("b", 2))], "k int, term string, n long")
    s, right = topics.svd_tables(one, "k", 5)
    assert s == pytest.approx([np.sqrt(14 * 5)])
    assert {r["term"]: r["x"] for r in right.collect()} == {"a": pytest.approx([5 ** -0.5]), "b": pytest.approx([2 * 5 ** -0.5])}
    s, right = topics.svd_tables(one.limit(0), "k", 5)
    assert s == [] and right.count() == 0


def test_documents_are_least_squares_and_unseen_ones_fold_in(counts):
    df, m = counts
    terms = topics.nmf_terms(df.filter(F.col("k") < (1 << 40) + 50), "k", 3)  # ten documents unseen
    w = np.array([r["x"] for r in terms.orderBy("term").collect()])
    got = {r["k"] - (1 << 40): np.array(r["x"]) for r in topics.nmf_documents(df, "k", terms, 3).collect()}
    assert len(got) == 60 and (w >= 0).all()
    for i, x in got.items():
        best = min((np.sum((m[i] - w @ c) ** 2) for c in _candidates(w, m[i])), default=0)
        assert (x >= 0).all() and np.sum((m[i] - w @ x) ** 2) == pytest.approx(best, rel=1e-6)
    err = sum(np.sum((m[i] - w @ x) ** 2) for i, x in got.items())
    s = np.linalg.svd(m, compute_uv=False)
    assert err < 1.2 * np.sum(s[3:] ** 2)


def _candidates(w, y):
    """Solutions on all subsets of the factors that are not negative."""
    for r in range(w.shape[1] + 1):
        for some in itertools.combinations(range(w.shape[1]), r):
            c = np.zeros(w.shape[1])
            if some:
                c[list(some)] = np.linalg.lstsq(w[:, some], y, rcond=None)[0]
            if (c >= 0).all():
                yield c


def test_topic_factors_of_unseen_and_unknown_documents(spark):
    stat = spark.createDataFrame([(i, "red blue" if i % 2 else "green blue blue") for i in range(20)], "k int, f string")
    data = spark.createDataFrame([(2 ** 40, "red blue"), (7, "nothing known"), (8, "green green")], "k long, f string")
    rows = {r["k"]: r.asDict() for r in topics.topic_factors(stat, data, "k", "f", k=2).collect()}
    assert set(rows) == {2 ** 40, 7, 8}
    assert all(rows[7][f"{c}_f_{i}"] == 0.0 for c in ("svd", "nmf") for i in range(2))
    assert rows[8]["svd_f_0"] > 0 and max(rows[8]["nmf_f_0"], rows[8]["nmf_f_1"]) > 0
