"""Topic factors of per-key "documents" (M10).

All values of a feature per key are one document.
Here term counts per (id, term) are a partial aggregate and the vocabulary
is the terms present in at least ``min_df`` documents of the fitting table.
Factors, fitted on ``stat`` and applied to ``data``:

* truncated SVD (not centred) by block power iteration and NMF by alternating
  non-negative least squares, both on (key, term, n) tables: the vocabulary and
  the documents stay tables, keys and terms of any type; the driver holds
  matrices of a block's width squared.  Documents that the fit has not seen are
  folded in;
* LDA (online), whose Spark ML model holds a vocabulary x k matrix on the
  driver; it reads sparse vectors with one entry per term of a document.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.clustering import LDA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors as Vectors_
from pyspark.ml.linalg import VectorUDT
from pyspark.mllib.linalg import Vectors
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.aggs import dense_codes
from tessera.session import cut_lineage

TOKEN_SPLIT = r"(?U)\W+"


def term_counts(df: DataFrame, key: str, feature: str) -> DataFrame:
    """(key, term, n): lower-cased word tokens of ``feature`` per key."""
    toks = df.select(key, F.explode(F.split(F.lower(F.col(feature).cast("string")), TOKEN_SPLIT)).alias("term"))
    return toks.filter(F.length("term") > 0).groupBy(key, "term").agg(F.count(F.lit(1)).alias("n"))


def vocabulary(counts: DataFrame, key: str, min_df: int = 2) -> DataFrame:
    """(term, idx): terms in at least ``min_df`` documents, numbered in order."""
    df_ = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(F.col("df") >= min_df)
    return dense_codes(df_, ["term"], "idx")


def doc_vectors(counts: DataFrame, terms: list[str] | DataFrame, key: str, out: str = "tf") -> DataFrame:
    """One sparse count vector per key over ``terms`` (a list, or the table of
    :func:`vocabulary`): an entry per distinct term, whatever its count."""
    spark = counts.sparkSession
    if isinstance(terms, list):
        terms = spark.createDataFrame([(t, i) for i, t in enumerate(terms)], "term string, idx long")
    size = terms.count()
    entry = F.when(F.col("idx").isNotNull(), F.struct(F.col("idx").cast("int").alias("i"), F.col("n").cast("double").alias("x")))
    per = counts.join(terms, "term", "left").groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("__e"))

    def vector(r):
        return (r[0], Vectors_.sparse(size, [e["i"] for e in r[1]], [e["x"] for e in r[1]]))
    schema = T.StructType([counts.schema[key], T.StructField(out, VectorUDT())])
    return spark.createDataFrame(per.select(key, "__e").rdd.map(vector), schema)


def truncated_svd(vectors: DataFrame, column: str, k: int) -> tuple[list[float], list[list[float]]]:
    """The k largest singular values of the document-term matrix and the
    right singular vectors (one list of k per term), the largest entry of
    each vector positive; for vocabularies that fit the driver
    (:func:`svd_tables` for others)."""
    rows = vectors.select(column).rdd.map(lambda r: Vectors.fromML(r[0]))
    svd = RowMatrix(rows).computeSVD(k)
    v = svd.V.toArray()
    v = v * np.sign(v[np.abs(v).argmax(axis=0), range(v.shape[1])])
    return [float(x) for x in svd.s.toArray()], v.tolist()


def _products(counts: DataFrame, by: str, at: str, table: DataFrame, width: int, out: str) -> DataFrame:
    """``(by, out)``: of the matrix ``counts`` (columns ``by``, ``at``, ``n``)
    times the table ``(at, x)`` of ``width`` numbers a row."""
    sums = [F.sum(F.col("n") * F.col("x")[i]) for i in range(width)]
    return counts.join(table, at).groupBy(by).agg(F.array(*sums).alias(out))


def _gram(table: DataFrame, column: str, width: int) -> np.ndarray:
    """Sum over the rows of ``column``'s outer product with itself."""
    at = [(i, j) for i in range(width) for j in range(i, width)]
    row = table.agg(*[F.sum(F.col(column)[i] * F.col(column)[j]).alias(f"g{i}_{j}") for i, j in at]).first()
    g = np.zeros((width, width))
    for (i, j), x in zip(at, row):
        g[i, j] = g[j, i] = x or 0.0
    return g


def _times(column: str, m: np.ndarray) -> Column:
    """The row vector ``column`` times a small matrix."""
    return F.array(*[sum((F.col(column)[i] * float(m[i, j]) for i in range(m.shape[0])), F.lit(0.0)) for j in range(m.shape[1])])


def _seeded(terms: DataFrame, width: int, seed: int) -> DataFrame:
    """``(term, x)``: numbers in (0, 1] that depend on term and seed alone."""
    unit = [(F.pmod(F.xxhash64("term", F.lit(seed), F.lit(i)), F.lit(1 << 30)) + 1) / float(1 << 30) for i in range(width)]
    return terms.select("term", F.array(*unit).alias("x"))


def svd_tables(counts: DataFrame, key: str, k: int, extra: int = 32, max_iter: int = 30, tol: float = 1e-8,
               seed: int = 520) -> tuple[list[float], DataFrame]:
    """The ``k`` largest singular values (fewer if the matrix has fewer) of the
    document-term matrix ``counts`` (``key``, ``term``, ``n``) and the right
    singular vectors ``(term, x)``, the largest entry of each positive.

    A block of ``k + extra`` vectors, at most the vocabulary, is multiplied by
    the matrix and its transpose and made orthogonal, until the values stay
    within ``tol`` of the largest; a block as wide as the vocabulary needs no
    second round."""
    counts = counts.select(key, "term", F.col("n").cast("double").alias("n"))
    terms = counts.select("term").distinct()
    size = terms.count()
    width = min(size, k + extra)
    if not width:
        return [], terms.select("term", F.array().cast("array<double>").alias("x"))
    table, last = cut_lineage(_seeded(terms, width, seed).withColumn("x", F.transform("x", lambda u: u - 0.5)), "svd"), None
    for _ in range(max_iter):
        # orthonormal columns; directions that the block lacks go
        e, q = np.linalg.eigh(_gram(table, "x", width))
        keep = e > e.max() * 1e-14
        table = table.select("term", _times("x", q[:, keep] / np.sqrt(e[keep])).alias("x"))
        width = int(keep.sum())
        docs = cut_lineage(_products(counts, key, "term", table, width, "y"), "svd-documents")
        e, q = np.linalg.eigh(_gram(docs, "y", width))  # of the block's products: the values, squared
        order = np.argsort(-e)[:k]
        values = np.sqrt(np.maximum(e[order], 0))
        right = table.select("term", _times("x", q[:, order]).alias("x"))
        if width == size or (last is not None and len(last) == len(values) and np.abs(values - last).max() <= tol * values[0]):
            break
        last = values
        table = cut_lineage(_products(counts, "term", key, docs.withColumnRenamed("y", "x"), width, "x"), "svd")
    full = values > (values[0] if len(values) else 0) * 1e-9
    values, n = values[full], int(full.sum())
    right = cut_lineage(right.select("term", F.slice("x", 1, max(n, 1)).alias("x")), "svd-vectors")
    if n:
        top = right.agg(*[F.max_by(F.col("x")[i], F.struct(F.round(F.abs(F.col("x")[i]), 9), "term")).alias(f"s{i}")
                          for i in range(n)]).first()
        right = right.withColumn("x", F.array(*[F.col("x")[i] * (-1.0 if top[i] < 0 else 1.0) for i in range(n)]))
    return [float(v) for v in values], right


def _least_squares(b: str, g: np.ndarray, sweeps: int = 50) -> Column:
    """The non-negative x of least ``x G x / 2 - b x``, by coordinate descent."""
    k = len(g)
    rows = F.array(*[F.array(*[F.lit(float(v)) for v in r]) for r in g])

    def step(x, s):
        at = (s % k).cast("int")
        dot = F.aggregate(F.zip_with(F.get(rows, at), x, lambda u, v: u * v), F.lit(0.0), lambda u, v: u + v)
        diagonal = F.get(F.get(rows, at), at)
        new = F.when(diagonal > 0, F.greatest(F.lit(0.0), F.get(x, at) + (F.get(F.col(b), at) - dot) / diagonal)).otherwise(0.0)
        return F.transform(x, lambda v, i: F.when(i == at, new).otherwise(v))
    return F.aggregate(F.sequence(F.lit(0), F.lit(k * sweeps - 1)), F.array(*[F.lit(0.0)] * k), step)


def nmf_terms(counts: DataFrame, key: str, k: int, max_iter: int = 8, seed: int = 520) -> DataFrame:
    """``(term, x)``: the term side of a non-negative factorisation of the
    document-term matrix ``counts``, in ``max_iter`` rounds of least squares for
    the documents and the terms in turn."""
    counts = counts.select(key, "term", F.col("n").cast("double").alias("n"))
    table = cut_lineage(_seeded(counts.select("term").distinct(), k, seed), "nmf-terms")
    for _ in range(max_iter):
        docs = cut_lineage(nmf_documents(counts, key, table, k), "nmf-documents")
        b = _products(counts, "term", key, docs, k, "b")
        table = cut_lineage(b.select("term", _least_squares("b", _gram(docs, "x", k)).alias("x")), "nmf-terms")
    return table


def nmf_documents(counts: DataFrame, key: str, terms: DataFrame, k: int) -> DataFrame:
    """``(key, x)``: factors of documents, seen or not, on the term side of
    :func:`nmf_terms`; a document without known terms has no row."""
    b = _products(counts, key, "term", terms, k, "b")
    return b.select(key, _least_squares("b", _gram(terms, "x", k)).alias("x"))


def topic_factors(stat: DataFrame, data: DataFrame, key: str, feature: str, k: int = 5, min_df: int = 2,
                  seed: int = 520, max_iter: int = 20) -> DataFrame:
    """Per key of ``data``: k LDA topic weights, up to k SVD components and k
    NMF factors, all fitted on ``stat``'s documents with ``stat``'s vocabulary;
    0 for documents without a term of it."""
    # read by every fit below: written once
    sc = cut_lineage(term_counts(stat, key, feature), "terms")
    vocab = cut_lineage(vocabulary(sc, key, min_df), "vocabulary")
    if vocab.isEmpty():
        raise ValueError("empty vocabulary")
    dc = sc if data is stat else cut_lineage(term_counts(data, key, feature), "terms")
    train = cut_lineage(doc_vectors(sc, vocab, key), "vectors")
    docs = train if data is stat else doc_vectors(dc, vocab, key)
    lda = LDA(k=k, optimizer="online", seed=seed, maxIter=max_iter, featuresCol="tf").fit(train)
    t = lda.transform(docs).withColumn("__t", vector_to_array("topicDistribution"))
    known = cut_lineage(sc.join(vocab.select("term"), "term"), "known-terms")
    values, right = svd_tables(known, key, k, seed=seed)
    svd = _products(dc, key, "term", right, len(values), "__s")
    nmf = nmf_documents(dc, key, nmf_terms(known, key, k, seed=seed), k).withColumnRenamed("x", "__n")
    out = t.select(key, "__t").join(svd, key, "left").join(nmf, key, "left")
    part = lambda c, n, name: [F.coalesce(F.col(c)[i], F.lit(0.0)).alias(f"{name}_{feature}_{i}") for i in range(n)]
    return out.select(key, *part("__t", k, "lda"), *part("__s", len(values), "svd"), *part("__n", k, "nmf"))
