"""Benchmark decontamination by template canonicalisation.

Words are white-space separated and stripped of punctuation.  Numbers, names
and units become typed placeholders, other words are lower-cased, so that a
question with other numbers or names has the same template.  Windows of
``WINDOW`` template words (a shorter item: its whole template) of documents
and benchmark items are hash-joined.  Matches of a document and an item on
one diagonal are put together: the placeholders' values must map one to one
(a value that the item repeats is repeated by the document), and the words
covered must be ``COVERED`` or the whole item.  Beside the templates, runs of
``COVERED`` words (a shorter item: all its words) that are equal but for case
and punctuation are joined as they are, values included: they need no literal
words, no names and no one-to-one values.

Documents are read once.  Only windows whose hash is in a bitmap of the
benchmark's windows leave that pass; the bitmap has a fixed size, and a false
positive in it only means a row that finds no partner in the join.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.base import per_batch, spread_key, windows
from tessera.operators.keys import tmp_names
from tessera.session import cut_lineage

WINDOW = 8
COVERED = 13
LEAST_LITERALS = 3
BITMAP_BITS = 1 << 23

# Units and number words (fixed plain values).
UNITS = set("""mm cm m km in ft yd mi mile miles meter meters metre metres kilometer kilometers kilometre kilometres
inch inches foot feet yard yards g kg mg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces ton tons tonne tonnes
ml l liter liters litre litres gallon gallons cup cups s sec second seconds min minute minutes h hr hour hours day days week weeks
month months year years km/h mph m/s % percent degrees celsius fahrenheit k dollar dollars euro euros cent cents usd eur
w kw kwh v a hz khz mhz ghz b kb mb gb tb bit bits byte bytes j kj cal kcal pa kpa bar n""".split())
NUMBER_WORDS = set("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split())
NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(st|nd|rd|th|%)?")
MEASURE = re.compile(r"([+-]?[$€£]?\d[\d.,]*)([a-z/%]+)")
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "$%") + "“”‘’«»…–—¿¡"

OPERATORS = set("+=<>×÷±−")
EXACT = np.uint64(0x5851F42D4C957F2D)  # sets hashes of equal runs apart from those of templates
#: Words that are worked on at a time.
SOME_WORDS = 1 << 17

LITERAL, NUM, NAME, UNIT = 0, 1, 2, 3
_PLACE = np.array([0, 0x1111, 0x2222, 0x3333], np.uint64)


class Words(dict):
    """Distinct raw words -> row of the tables of their properties (hash,
    kind, whether a sentence ends, hash but for case and punctuation), or -1
    when ``most`` words are known; a word beyond them is looked at each time it
    occurs."""

    most = 200_000

    def __init__(self):
        self.hash = np.zeros(self.most, np.uint64)
        self.kind = np.zeros(self.most, np.int8)
        self.ends = np.zeros(self.most, bool)
        self.bare = np.zeros(self.most, np.uint64)

    def __missing__(self, raw: str) -> int:
        at = len(self)
        if at >= self.most:
            return -1
        self.hash[at], self.kind[at], self.ends[at], self.bare[at] = properties(raw)
        self[raw] = at
        return at


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


def bare(raw: str, core: str) -> str:
    """Case-folded word without punctuation, but for what stands between
    digits; of a word of punctuation the operators of arithmetic."""
    word = core.casefold()
    if word.isalnum():
        return word
    if not core:
        return "".join(c for c in raw if c in OPERATORS)
    return "".join(c for i, c in enumerate(word) if unicodedata.category(c)[0] not in "PSCZ" or c in "$€£%"
                   or 0 < i < len(word) - 1 and word[i - 1].isdigit() and word[i + 1].isdigit())


def properties(raw: str) -> tuple[int, int, bool, int]:
    """Hash of the bare lower-case word, kind, whether a sentence ends, and
    hash of :func:`bare` (0 if nothing is left)."""
    core = raw.strip(_EDGE)
    low = core.lower()
    kind = LITERAL
    if NUMBER.fullmatch(low) or low in NUMBER_WORDS:
        kind = NUM
    elif (m := MEASURE.fullmatch(low)) and m[2] in UNITS:
        kind = NUM
    elif low in UNITS:
        kind = UNIT
    elif len(core) > 1 and core[0].isupper() and core[1:].islower():
        kind = NAME
    h, word = _hash(low), bare(raw, core)
    return (h, kind, raw.rstrip("\"')”’»").endswith((".", "!", "?", ":")),
            h if word == low and word else _hash(word) if word else 0)


_WORDS = Words()


def templates(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word of all texts after one another: template hash, value hash (0
    for literals), kind, hash but for case and punctuation (0: punctuation
    alone); and the number of words of each text."""
    raw, size = [], []
    for t in texts:
        words = (t or "").split()
        raw += words
        size.append(len(words))
    size = np.array(size, np.int64)
    if not raw:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int8), np.zeros(0, np.uint64), size
    at = np.fromiter(map(_WORDS.__getitem__, raw), np.int64, len(raw))
    h, kind, ends, plain = _WORDS.hash[at], _WORDS.kind[at], _WORDS.ends[at], _WORDS.bare[at]
    for i in np.flatnonzero(at < 0):
        h[i], kind[i], ends[i], plain[i] = properties(raw[i])
    first = np.r_[True, ends[:-1]]
    after_number = np.r_[False, kind[:-1] == NUM]
    start = (np.cumsum(size) - size)[size > 0]
    first[start], after_number[start] = True, False
    # a capital letter at the start of a sentence makes no name, and a unit stands behind a number
    kind = np.where((kind == NAME) & first | (kind == UNIT) & ~after_number, LITERAL, kind)
    return np.where(kind == LITERAL, h, _PLACE[kind]), np.where(kind == LITERAL, np.uint64(0), h), kind, plain, size


def template(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word: template hash, value hash (0 for literals), kind."""
    return templates([text])[:3]


def template_windows(text: str | None, sizes) -> list[tuple[int, int, int, np.ndarray]]:
    """``(size, position, hash, values)`` of all windows with enough literals."""
    h, value, kind = template(text)
    out = []
    for n in sizes:
        if len(h) < n:
            continue
        literal = np.r_[0, np.cumsum(kind == LITERAL)]
        enough = np.flatnonzero(literal[n:] - literal[:-n] >= LEAST_LITERALS)
        w = windows(h, n)
        out += [(n, int(i), w[i], value[i:i + n]) for i in enough]
    return out


def _item_windows(items: DataFrame, id_col: str, text_col: str, window: int, covered: int, exact: bool) -> DataFrame:
    def cut(b):
        rows = {"item": [], "words": [], "exact": [], "size": [], "ipos": [], "w": [], "ivals": []}

        def put(*row):
            for k, x in zip(rows, row):
                rows[k].append(x)
        for i, t in zip(b["item"].to_pylist(), b["text"].to_pylist()):
            n = len((t or "").split())
            for size, pos, h, v in template_windows(t, [min(window, n)] if n else []):
                put(i, n, False, size, pos, int(h.view(np.int64)), v.view(np.int64))
            plain = templates([t])[3]
            plain = plain[plain != 0]
            n = min(covered, len(plain))
            for pos, h in enumerate(windows(plain, n) ^ EXACT if exact and n else []):
                put(i, len(plain), True, n, pos, int(h.view(np.int64)), [])
        kinds = {"ivals": pa.list_(pa.int64()), "exact": pa.bool_()}
        return {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()}

    d = items.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text")).distinct()
    return d.mapInArrow(per_batch(cut), "item long, words long, exact boolean, size long, ipos long, w long, ivals array<long>")


def _hits(h: np.ndarray, size: np.ndarray, n: int, seen: np.ndarray, salt: np.uint64):
    """Windows of ``n`` words inside one text whose hash is in the bitmap:
    text number, position in the text, position among all words, hash."""
    w = windows(h, n) ^ salt
    s = (w & np.uint64(BITMAP_BITS - 1)).astype(np.int64)
    k = np.flatnonzero(seen[s >> 5] >> (s & 31).astype(np.uint32) & np.uint32(1))
    end = np.cumsum(size)
    text = np.searchsorted(end, k, "right")
    inside = k + n <= end[text]
    k, text = k[inside], text[inside]
    return text, k - (end - size)[text], k, w[k].view(np.int64)


def _parts(texts: list) -> list[slice]:
    """Runs of texts of about SOME_WORDS words (a word has 5 characters or more)."""
    cuts, sum_ = [0], 0
    for i, t in enumerate(texts):
        sum_ += len(t or "")
        if sum_ > 5 * SOME_WORDS:
            cuts.append(i + 1)
            sum_ = 0
    return [slice(a, b) for a, b in zip(cuts, [*cuts[1:], len(texts)]) if a < b]


def _found(docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, window: int,
           covered: int, exact: bool, injective: bool) -> DataFrame:
    bench = cut_lineage(_item_windows(items, item_col, item_text, window, covered, exact), "benchmark-windows")
    sizes = sorted((r["exact"], r["size"]) for r in bench.select("exact", "size").distinct().collect())  # <= window + covered
    bits = bench.select(F.pmod("w", F.lit(BITMAP_BITS)).alias("s")).distinct()
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("s", F.lit(32)).cast("int"))
    words = bits.groupBy(F.shiftright("s", 5).alias("at")).agg(F.bit_or(bit).alias("m")).collect()  # <= BITMAP_BITS / 32
    bitmap = np.zeros(BITMAP_BITS // 32, np.uint32)
    for r in words:
        bitmap[r["at"]] = r["m"]
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def scan(b):
        rows = {"id": [], "th": [], "dpos": [], "w": [], "dvals": []}
        seen = shared.value
        ids, ths, texts = b["id"].to_pylist(), b["th"].to_pylist(), b["text"].to_pylist()
        for part in _parts(texts):
            h, value, _, plain, size = templates(texts[part])
            words = plain != 0
            left = np.r_[0, np.cumsum(words)]
            end = np.cumsum(size)
            plain, plain_size = plain[words], left[end] - left[end - size]
            for is_exact, n in sizes:
                if not is_exact:
                    hits = [(t, p, w, value[k:k + n].view(np.int64)) for t, p, k, w in zip(*_hits(h, size, n, seen, np.uint64(0)))]
                else:
                    text, pos, _, w = _hits(plain, plain_size, n, seen, EXACT)
                    if n < covered:  # whole items: once a document is enough
                        text, w = np.unique(np.stack([text, w]), axis=1) if len(w) else (text, w)
                        pos = np.zeros(len(w), np.int64)
                    hits = [(t, p, x, []) for t, p, x in zip(text, pos, w)]
                for t, p, w, v in hits:
                    for name, x in zip(rows, (ids[part.start + t], ths[part.start + t], int(p), int(w), v)):
                        rows[name].append(x)
        return {k: pa.array(v, pa.list_(pa.int64()) if k == "dvals" else pa.int64()) for k, v in rows.items()}

    d = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    found = d.mapInArrow(per_batch(scan), "id long, th long, dpos long, w long, dvals array<long>")
    found = cut_lineage(found.distinct(), "document-windows")
    pairs = (found.join(bench, "w").withColumn("diagonal", F.col("dpos") - F.col("ipos"))
             .groupBy("id", "th", "item", "exact", "diagonal")
             .agg(F.max("words").alias("words"), F.max("size").alias("size"),
                  F.array_sort(F.collect_set("ipos")).alias("at"),
                  F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("ivals", "dvals")))).alias("vals")))
    # words covered: each window adds what the one before did not cover
    step = F.transform("at", lambda x, i: F.when(i == 0, F.col("size")).otherwise(
        F.least(F.col("size"), x - F.element_at("at", F.greatest(i, F.lit(1)).cast("int")))))
    # of equal windows the longest run without a gap
    run = F.aggregate(
        "at", F.struct(F.lit(-2).cast("long").alias("last"), F.lit(0).cast("long").alias("run"), F.lit(0).cast("long").alias("most")),
        lambda a, x: F.struct(x.alias("last"), F.when(x == a["last"] + 1, a["run"] + 1).otherwise(F.lit(1).cast("long")).alias("run"),
                              F.greatest(a["most"], F.when(x == a["last"] + 1, a["run"] + 1).otherwise(F.lit(1).cast("long"))).alias("most")),
        lambda a: F.col("size") + a["most"] - 1)
    pairs = pairs.withColumn("covered", F.when(F.col("exact"), run).otherwise(
        F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)))
    # placeholders: item value -> document value (and back) is a function
    pairs = pairs.withColumn("vals", F.filter("vals", lambda v: v["ivals"] != 0))
    distinct = lambda side: F.size(F.array_distinct(F.transform("vals", lambda v: v[side]))) == F.size("vals")
    consistent = distinct("ivals") & distinct("dvals") if injective else distinct("ivals")
    good = pairs.filter(F.col("exact") | consistent & (F.col("covered") >= F.least(F.lit(covered), F.col("words"))))
    return good.groupBy("id", "th", "item").agg(F.max("covered").alias("covered"))


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
            covered: int = COVERED) -> DataFrame:
    """``(id, th, item, covered)`` for each document (its id and the hash of
    its text) and benchmark item whose template it contains with values that
    map one to one, ``covered`` being the item's words in the diagonal that
    covers most.  Templates alone: :func:`contained` has the equal runs too.

    An item of fewer than ``window`` words is sought as a whole; one without
    three literal words in a window is found nowhere.  Null and empty texts
    contain nothing; null ids are ids like others; repeated rows count once.
    """
    return _found(docs, items, id_col, text_col, item_col, item_text, window, covered, False, True)


def contained(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
              covered: int = COVERED) -> DataFrame:
    """As :func:`matches`, with all that a document can contain of an item:
    the template with values that are a function of the item's (two slots may
    get the same new value), or ``covered`` words in order, of a shorter item
    all, that are equal but for case and punctuation (``covered`` is then the
    longest such run).  Words are told apart by white space; a text of
    punctuation alone is in nothing."""
    return _found(docs, items, id_col, text_col, item_col, item_text, window, covered, True, False)


def report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: id, ``contaminated``, ``n_items`` (items
    contained), ``item_id`` (the smallest of them) and ``covered`` (most words
    of an item).  See :func:`contained` and :func:`matches` for edge cases."""
    hits = (contained(docs, items, id_col, text_col, **options).groupBy("id", "th")
            .agg(F.count(F.lit(1)).alias("n_items"), F.min("item").alias("item_id"), F.max("covered").alias("covered"))
            .withColumn("s", spread_key("id", "th")))
    d = docs.select(F.col(id_col).alias("doc"), F.xxhash64(text_col).alias("t"))
    d = d.withColumn("k", F.xxhash64(F.col("doc").cast("long"), "t"))
    j = d.join(hits, d["doc"].cast("long").eqNullSafe(hits["id"]) & (d["t"] == hits["th"]) & (d["k"] == hits["s"]), "left")
    return j.select(F.col("doc").alias(id_col), F.col("n_items").isNotNull().alias("contaminated"),
                    F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "item_id",
                    F.coalesce("covered", F.lit(0)).cast("long").alias("covered"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no benchmark item."""
    i, t, s = tmp_names(docs, "id", "th", "s")
    hits = cut_lineage(contained(docs, items, id_col, text_col, **options).select("id", "th").distinct().toDF(i, t), "leaks")
    return docs.join(hits, docs[id_col].cast("long").eqNullSafe(hits[i]) & (F.xxhash64(docs[text_col]) == hits[t]), "left_anti")
