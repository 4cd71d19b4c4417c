"""Spelling variants by an index of variable-length grams.

Which words are one edit (an inserted, deleted or replaced code point) apart?
Long grams find few wrong candidates but do not survive an edit; so grams are
only as long as they must be.  The gram dictionary has the frequent grams;
from each position a word's gram grows while it is frequent, up to the longest
allowed, and a gram within an earlier one is left out.

What one edit can do to these grams is bounded word by word.  A gram that ends
before the edit stays what it is, as its growth looks at nothing behind it.
One that begins behind the edit keeps its text, and is left out only if a gram
grown across the edit reaches its end.  With grams of at most q, all that an
edit at i affects therefore ends in i + 1 .. i + q; the bound is the largest
number of a word's grams that end within q code points in a row.  (A gram cut
off by the word's end may grow when something is appended: that is one gram,
ending at the last code point, which a replacement there affects as well.)

So a gram and another that ends q or more code points behind it are never both
affected: every near word has one of the two.  For each word only the lists of
two such grams are merged, the pair that is rarest in the dictionary.  A common
gram is at the same position, or is shifted by the difference in length if it
stands behind the edit, so position and lengths are part of the join key:
"scheme" L is for pairs whose shorter word has L code points, which looks up
its two grams in the lists of all grams of the others.  Grams have at most
L // 2, which keeps the first and the last gram of a word out of reach of one
edit: no word is without such a pair.  Candidates are verified in the condition
of the join, first by the parities of their letters, of which an edit changes
two at most, then by their edit distance, so that only near words come out.
"""

from __future__ import annotations

from functools import cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import LOWER, UPPER
from tessera.session import cut_lineage

SHORTEST, LONGEST = 2, 6
#: A gram is frequent if it has more than one in FREQUENT of all positions
#: (and more than LEAST); so there are at most FREQUENT frequent grams of each
#: length, (LONGEST - SHORTEST) * FREQUENT in all, which may be broadcast.
FREQUENT, LEAST = 50_000, 32
#: Code points of a run of letters, A-Z, a-z and À-ÿ.  One by one: Java's
#: pattern looks single ones up in a table, but asks range after range.
LETTERS = "[" + "".join(map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)])) + "]"


def runs(docs: DataFrame, text_col: str = "text", min_len: int = 4, name: str = "run") -> DataFrame:
    """One row per maximal run of at least ``min_len`` letters (LETTERS) of
    each text, as column ``name`` with A-Z lower-cased, beside the columns of
    ``docs``.  Null and empty texts have none."""
    found = F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"{LETTERS}{{{min_len},}}"), F.lit(0))
    return docs.withColumn(name, F.explode(found)).withColumn(name, F.translate(name, UPPER, LOWER))


@cache
def _longest(length: int) -> int:
    """The longest gram of pairs whose shorter word has ``length``."""
    return min(length // 2, LONGEST)


def decompose(word: str, frequent: dict[str, int], longest: int) -> list[tuple[int, str]]:
    """A word's grams ``(position, gram)``: from each position the gram that
    has grown while it is frequent, without those within an earlier one."""
    out, reached, n = [], 0, len(word)
    for p in range(n - SHORTEST + 1):
        e = p + SHORTEST
        while e < n and e - p < longest and word[p:e] in frequent:
            e += 1
        if e > reached:
            out.append((p, word[p:e]))
            reached = e
    return out


def out_of_reach(grams: list[tuple[int, str]], frequent: dict[str, int], longest: int) -> list[tuple[int, str]]:
    """The rarest two of a word's grams that one edit does not both affect."""
    cost = [frequent.get(g, 0) for _, g in grams]
    ends = [p + len(g) for p, g in grams]
    pairs = [(cost[i] + cost[j], i, j) for i in range(len(grams)) for j in range(i + 1, len(grams))
             if ends[j] - ends[i] >= longest]
    _, i, j = min(pairs)
    return [grams[i], grams[j]]


def keys_of(word: str, frequent: dict[str, int]) -> tuple[list[int], list[int], list[int]]:
    """Join keys: of the two grams that the word looks up as the shorter one
    of a pair (or one of two equally long ones), and of the lists that it is
    in for words of its own length and for words of one code point less."""
    key = lambda scheme, p, g: xxhash.xxh3_64_intdigest(f"{scheme},{p},{g}") - (1 << 63)
    n = len(word)
    q, q_up = _longest(n), _longest(n - 1)
    grams = decompose(word, frequent, q)
    up = grams if q_up == q else decompose(word, frequent, q_up)
    same = [key(n, p, g) for p, g in grams]
    return ([same[grams.index(x)] for x in out_of_reach(grams, frequent, q)],
            same,
            list({key(n - 1, q, g) for p, g in up for q in (p, p - 1) if q >= 0}))


@cache
def _bit(letter: str) -> int:
    return 1 << (ord(letter) * 0x9E3779B1 >> 7) % 64


def letter_parities(word: str) -> int:
    """64 bits, each the parity of the number of the letters that fall on it."""
    bits = 0
    for b in map(_bit, word):
        bits ^= b
    return bits - (1 << 64) if bits >> 63 else bits


def gram_dictionary(words: DataFrame) -> dict[str, int]:
    """The frequent grams of the written ``words`` with their counts."""
    total = words.agg(F.sum(F.length("word"))).first()[0] or 0
    at_least = max(LEAST, total // FREQUENT)
    n = F.length("word")
    grams = [F.transform(F.sequence(F.lit(1), n - (q - 1)), lambda p, q=q: F.substring(F.col("word"), p, F.lit(q)))
             for q in range(SHORTEST, LONGEST)]
    # a word with no gram of some length gets none, not a sequence downwards
    grams = [F.when(n >= q, g).otherwise(F.array().cast("array<string>")) for q, g in zip(range(SHORTEST, LONGEST), grams)]
    counts = words.select(F.explode(F.flatten(F.array(*grams))).alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("c"))
    return dict(counts.filter(F.col("c") > at_least).collect())  # bounded, see FREQUENT


def near_pairs(words: DataFrame) -> DataFrame:
    """Pairs ``(a, n_a, b, n_b)`` of words one edit apart, each once; ``words``
    is a written table of distinct words of at least 4 code points and their
    counts ``(word, n)``."""
    frequent = words.sparkSession.sparkContext.broadcast(gram_dictionary(words))

    def index(batches):
        known = frequent.value
        keys = pa.list_(pa.int64())
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                s = b.slice(i, 2048)
                words = s["word"].to_pylist()
                looked, same, longer = zip(*[keys_of(w, known) for w in words])
                yield pa.RecordBatch.from_pydict({
                    "word": s["word"], "n": s["n"], "bits": pa.array(map(letter_parities, words), pa.int64()),
                    "looked": pa.array(looked, keys), "same": pa.array(same, keys), "longer": pa.array(longer, keys)})

    lists = cut_lineage(words.select("word", "n").mapInArrow(
        index, "word string, n long, bits long, looked array<long>, same array<long>, longer array<long>"), "gram-lists")
    of = lambda keys, *more: lists.select(F.explode(keys).alias("k"), "word", "n", "bits", *more)
    a = of("looked").toDF("k", "a", "n_a", "bits_a")
    b = (of("same", F.lit(False)).union(of("longer", F.lit(True)))).toDF("k", "b", "n_b", "bits_b", "longer")
    alike = F.bit_count(F.col("bits_a").bitwiseXOR(F.col("bits_b"))) <= 2
    return (a.join(b, "k").filter(alike & (F.col("longer") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1))
            .select("a", "n_a", "b", "n_b").distinct())


def _roots(forms: DataFrame) -> DataFrame:
    """Where following ``(word, form)`` ends, by doubling the steps."""
    to = forms
    while True:
        nxt = to.toDF("form", "next")
        new = cut_lineage(to.join(nxt, "form", "left").select("word", F.coalesce("next", "form").alias("form"),
                                                             F.col("next").isNotNull().alias("moved")), "roots")
        to = new.drop("moved")
        if not new.filter("moved").limit(1).count():
            return to


def variants(words: DataFrame, ratio: int = 10, min_len: int = 7, min_count: int = 2) -> DataFrame:
    """One row per distinct word of ``words`` (columns ``word``, ``n``; equal
    words are added up) with at least ``min_len`` code points and ``min_count``
    occurrences: ``n_near`` words are one edit apart; ``form`` is the one of
    largest ``form_n`` (of equal ones the first in code-point order) if that is
    at least ``ratio`` times ``n``; ``root`` is where following the forms ends,
    the word itself if it has no form.

    Null words do not count; an empty table gives an empty result; other
    columns are not read.  ``min_len`` is at least 4, ``ratio`` at least 2.
    """
    if min_len < 4 or ratio < 2:
        raise ValueError("words of at least 4 code points and a ratio of at least 2")
    words = cut_lineage(words.filter(F.length("word") >= min_len).groupBy("word").agg(F.sum("n").cast("long").alias("n"))
                        .filter(F.col("n") >= min_count), "words")
    pairs = cut_lineage(near_pairs(words), "near")
    both = pairs.toDF("word", "own", "near", "m").union(pairs.select("b", "n_b", "a", "n_a"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("m"), F.col("near").alias("w"))).alias("best"))
    found = cut_lineage(words.join(best, "word", "left").withColumn("big", -F.col("best.m") >= F.col("n") * ratio)
                        .select("word", F.when(F.col("big"), F.col("best.w")).alias("form"), "n",
                                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(F.col("big"), -F.col("best.m")).alias("form_n")), "forms")
    roots = _roots(cut_lineage(found.filter("form is not null").select("word", "form"), "steps"))
    return (found.join(roots.toDF("word", "root"), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def with_typos(words: DataFrame, id_col: str, name: str = "run", one_in: int = 31) -> DataFrame:
    """``words`` with one code point deleted from some: with h the checksum of
    ``<id>:<word>``, where ``one_in`` divides h, the one at h modulo the
    word's length.  A null id counts as empty text."""
    said = F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), F.lit(":"), F.col(name))
    h = F.crc32(said.cast("binary"))
    at = F.pmod(h, F.length(name)).cast("int")
    cut = F.concat(F.substring(F.col(name), F.lit(1), at), F.substring(F.col(name), at + 2, F.length(name)))
    return words.withColumn(name, F.when(F.pmod(h, F.lit(one_in)) == 0, cut).otherwise(F.col(name)))
