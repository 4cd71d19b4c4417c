"""The corpus operators as named queries over the test tables, with DuckDB
SQL where SQL can say the same.  Each query applies its operator with its
production parameters to the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ctph, decontaminate, exact, langid, merkle, packing, parity, shards, spelling, suffix, tokens, toxicity, urls
from tessera.session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@query("op4_exact_dedup", """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
      FROM documents) d
WINDOW w AS (PARTITION BY t)""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts, by progressive refinement."""
    g = exact.exact_groups(read_table(spark, sf_dir, "documents"), digest_of_all=True)
    return g.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@query("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have a Jaccard
    similarity of 0.9 or more, by the parity-sketch join."""
    return parity.similar_groups(read_table(spark, sf_dir, "documents"), words=3, num=9, den=10)


@query("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by models of the rows not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = F.coalesce(langid.held_out("doc_id"), F.lit(False))
    model = langid.fit(docs.filter(~out))
    found = langid.identify(docs.select("doc_id", out.alias("held_out"), "text"), model, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query("op3_token_ids")
def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to files and read back."""
    import public_tokenizers

    path = tokens.scratch_path(spark, "tokens")
    tokens.write_tokens(read_table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), 0)
    return tokens.digest(spark, path)


@query("op6_url_filter")
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url by the rules, else by the classifier."""
    weights = urls.fit(urls.default_labels(spark))
    return urls.judge(read_table(spark, sf_dir, "pages"), weights)


@query("op8_sharding")
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of eight, of near equal bytes."""
    return shards.assign(read_table(spark, sf_dir, "documents"), tokens.scratch_path(spark, "slot-map"), 8)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, by a model of the rows not held out."""
    out = F.coalesce(langid.held_out("doc_id", 3, 1), F.lit(False))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", out.alias("held_out"), "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~out)
    model = toxicity.fit(docs.filter("not held_out"), labels)
    return toxicity.score(docs, model, keep=["doc_id", "held_out"])


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the sequences."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


@query("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents contain a benchmark item."""
    return decontaminate.report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 100 bytes that start
    earlier, by the sparse suffix array."""
    return suffix.without_repeats(read_table(spark, sf_dir, "documents"))


#: What a reader finds where 7 divides the id's checksum: one more in n_chars.
TAMPERED = {"n_chars": "cast(n_chars as decimal(20,0)) + "
                       "cast(coalesce(pmod(crc32(cast(cast(doc_id as string) as binary)), 7) = 0, false) as int)"}

_CRC = """list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({s}, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1]))"""


@query("op13_merkle_manifest", """
WITH RECURSIVE
crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, x:
          CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) ORDER BY i) AS t
        FROM range(256) r(i)),
said AS (SELECT doc_id, lang, n_chars,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS a,
    coalesce(strlen(text) || ':' || text, '-') AS z,
    xor(""" + _CRC.format(s="doc_id::VARCHAR") + """, 4294967295) % 7 = 0 AS hit
  FROM documents, crc),
leaf0 AS (SELECT doc_id, lang,
    sha256(a || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || z) AS h,
    sha256(a || coalesce(strlen((n_chars + hit::INT)::VARCHAR) || ':' || (n_chars + hit::INT), '-') || z) AS seen
  FROM said),
langs AS (SELECT lang, n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS g
  FROM (SELECT lang, count(*) AS n FROM documents GROUP BY lang) x),
leaf AS (SELECT g, n, doc_id, h, seen, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i
  FROM leaf0 JOIN langs ON leaf0.lang IS NOT DISTINCT FROM langs.lang),
up AS (SELECT 0 AS lvl, g, n, i, h FROM leaf
  UNION ALL
  SELECT lvl + 1, g, n, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM up
  WHERE n > (1::BIGINT << lvl) GROUP BY lvl, g, n, i // 2),
subs AS (SELECT g, arg_max(h, lvl) AS sub, max(lvl) AS top FROM up GROUP BY g),
up2 AS (SELECT 0 AS lvl, g AS i, sub AS h, (SELECT count(*) FROM subs) AS n FROM subs
  UNION ALL
  SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), n FROM up2
  WHERE n > (1::BIGINT << lvl) GROUP BY lvl, i // 2, n),
tip AS (SELECT arg_max(h, lvl) AS root, max(lvl) AS top FROM up2),
steps AS (SELECT leaf.g, leaf.i, u.lvl, (leaf.i >> u.lvl) & 1 AS bit, s.h AS sib
  FROM leaf JOIN subs USING (g) JOIN (SELECT DISTINCT lvl FROM up) u ON u.lvl < subs.top
  LEFT JOIN up s ON s.lvl = u.lvl AND s.g = leaf.g AND s.i = xor(leaf.i >> u.lvl, 1)
  UNION ALL
  SELECT leaf.g, leaf.i, subs.top + u.lvl, (leaf.g >> u.lvl) & 1, s.h
  FROM leaf JOIN subs USING (g) JOIN (SELECT DISTINCT lvl FROM up2) u ON u.lvl < (SELECT top FROM tip)
  LEFT JOIN up2 s ON s.lvl = u.lvl AND s.i = xor(leaf.g >> u.lvl, 1)),
folded AS (SELECT 0 AS lvl, g, i, seen AS h FROM leaf
  UNION ALL
  SELECT f.lvl + 1, f.g, f.i,
    sha256(CASE WHEN s.bit = 1 THEN coalesce(s.sib, '') || f.h ELSE f.h || coalesce(s.sib, '') END)
  FROM folded f JOIN steps s ON s.g = f.g AND s.i = f.i AND s.lvl = f.lvl),
ended AS (SELECT g, i, arg_max(h, lvl) AS h FROM folded GROUP BY g, i),
proofs AS (SELECT g, i, sha256(coalesce(string_agg(sib, '' ORDER BY lvl), '')) AS p FROM steps GROUP BY g, i)
SELECT doc_id, leaf.h AS leaf, sub AS subroot, root, coalesce(p, sha256('')) AS proof_sha256, ended.h AS folded_root,
       ended.h = root AS verified
FROM leaf JOIN subs USING (g) JOIN ended USING (g, i) LEFT JOIN proofs USING (g, i), tip""")
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, subroot, root and proof, checked against a
    table tampered with."""
    return merkle.audit(read_table(spark, sf_dir, "documents"), changed=TAMPERED)


@query("op12_piecewise_fingerprints")
def op12_piecewise_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, beside that of its edited text and of the
    next document."""
    return ctph.compare_edits(read_table(spark, sf_dir, "documents"))


@query("op11_spelling_variants", """
WITH RECURSIVE
crc AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, x:
          CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) ORDER BY i) AS t
        FROM range(256) r(i)),
found AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w
          FROM documents),
runs AS (SELECT doc_id, w, count(*) AS k FROM found GROUP BY doc_id, w),
bytes AS (SELECT doc_id, w, k, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''),
    lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT]
                    ELSE [192 + unicode(ch) // 64, 128 + unicode(ch) % 64] END)) AS b FROM runs),
summed AS (SELECT w, k, xor(list_reduce(list_concat([4294967295::BIGINT], b),
    lambda c, x: xor(c >> 8, crc.t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM bytes, crc),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN left(w, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2) ELSE w END AS word, k
        FROM summed),
words AS (SELECT word, sum(k)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
holes AS (SELECT word, i, left(word, i) AS l, substr(word, i + 2) AS r FROM (SELECT word, unnest(range(length(word)))::INT AS i FROM words) x),
shorter AS (SELECT DISTINCT holes.word AS a, words.word AS b FROM holes JOIN words ON words.word = l || r),
near AS (SELECT x.word AS a, y.word AS b FROM holes x JOIN holes y ON x.l = y.l AND x.r = y.r AND x.word <> y.word
  UNION SELECT a, b FROM shorter UNION SELECT b, a FROM shorter),
best AS (SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, b) AS b, max(n) AS m
  FROM near JOIN words ON words.word = near.b GROUP BY a),
forms AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN b END AS form,
  CASE WHEN m >= 10 * n THEN m END AS form_n FROM words LEFT JOIN best USING (word)),
steps AS (SELECT word, word AS here, 0 AS d FROM forms
  UNION ALL SELECT steps.word, forms.form, d + 1 FROM steps JOIN forms ON forms.word = steps.here WHERE forms.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, arg_max(here, d) AS root FROM steps GROUP BY word) s USING (word)""")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents (some with a code point deleted), the near word that
    each is a variant of, and the root of that."""
    runs = spelling.runs(read_table(spark, sf_dir, "documents").select("doc_id", "text"), min_len=7)
    words = (spelling.with_typos(runs.select("doc_id", "run"), "doc_id").groupBy(F.col("run").alias("word"))
             .agg(F.count(F.lit(1)).alias("n")))
    return spelling.variants(words, ratio=10, min_len=7, min_count=2)
