"""Language identification by interpolated Kneser-Ney character models.

One model per language over case-folded letters (every run of other
characters is one blank), order 4.  The n-grams of all languages are stored
together: per order one sorted array of 64-bit hashes and beside it a matrix
with the log-probability of each n-gram in each language, already
interpolated over all lower orders, and the back-off weight of each context.
A text gets the language of the lowest cross-entropy per character.

Fit: the n-grams of all labelled documents are counted by a Spark aggregate,
copies of a text once.  A model has the n-grams of a language in order of their
counts, at most ``max_grams``; what it says of them (discounts, continuation
counts, totals of contexts) is counted over all n-grams, and the mass of those
left out goes to the back-off.  For calibration the texts are halved by a hash
and each is judged by a model of the other half, so every text is counted in the
model and every text sets limits.  Calibration sets the temperature of the
score and, per language, the cross-entropy beyond which a text is rejected, by a
quantile that mislabelled and odd texts do not move.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.base import mix, per_batch
from tessera.session import cut_lineage

ORDER = 4
MAX_GRAMS = 1 << 18
#: 0: no calibration; None: by all texts.
MAX_HELD = None
CHUNK = 1 << 18
HOLD = 1 << 18
UNDECIDED = "und"
#: Share of the texts of a language that its limit may reject, by an
#: exponential tail through the median and the quantile TAIL of the excess.
REJECTED, TAIL = 1e-4, 0.95
#: Least limit: junk lines and mixed languages reach 22 in the test tables,
#: the unlearned languages tried begin at 54.
LEAST = 30.0
#: Texts below which a language takes spread and limit from all.
FEW = 20
#: Temperatures that are tried, and the width of the bins in which
#: cross-entropies are counted (nats; symbols: parts of a power of e).
HEATS, BINS, LENGTH_BINS = np.geomspace(0.002, 1, 28), 1024, 32
_SEED = np.uint64(0x9E3779B97F4A7C15)


@cache
def _letters() -> np.ndarray:
    """Code point -> code point of the lower-case letter, 0 for others."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def _symbols(text: str | None) -> np.ndarray:
    """Lower-case letters with single blanks (0) between runs of letters."""
    raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    s = _letters()[raw]
    keep = s != 0
    keep[1:] |= s[:-1] != 0
    s = s[keep]
    return s[1:] if len(s) and s[0] == 0 else s


def _padded(texts) -> tuple[np.ndarray, np.ndarray]:
    """All texts after one another, each behind ORDER - 1 blanks and with one
    at its end, and the text number of each position (-1: padding)."""
    parts, owner = [], []
    pad = np.zeros(ORDER - 1, np.uint32)
    for i, t in enumerate(texts):
        s = _symbols(t)
        if not len(s):
            continue
        tail = s if s[-1] == 0 else np.append(s, np.uint32(0))
        parts += [pad, tail]
        owner += [np.full(ORDER - 1, -1, np.int32), np.full(len(tail), i, np.int32)]
    if not parts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32)
    return np.concatenate(parts), np.concatenate(owner)


def _grams(s: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k symbols that end at each position (0 before there are k)."""
    h = np.zeros(len(s), np.uint64)
    wide = s.astype(np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            h[k - 1:] = (h[k - 1:] + wide[i:len(s) - k + 1 + i] + np.uint64(1)) * _SEED
    return mix(h)


class HashTable:
    """A sorted array of hashes with a directory of its leading bits."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.append(hashes, np.uint64(2 ** 64 - 1))
        self.shift = np.uint64(64 - max(8, int(len(hashes)).bit_length()))
        heads = (hashes >> self.shift).astype(np.int64)
        size = 1 << (64 - int(self.shift))
        self.start = np.searchsorted(heads, np.arange(size + 1)).astype(np.int32)
        self.depth = int(np.max(np.diff(self.start), initial=0))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 if it is not there."""
        at = self.start[(h >> self.shift).astype(np.int64)]
        found = self.hashes[at] == h
        row = np.where(found, at, -1)
        left = np.flatnonzero(~found)
        for _ in range(self.depth - 1):
            if not len(left):
                break
            at_left = np.minimum(at[left] + 1, len(self.hashes) - 1)
            at[left] = at_left
            value, want = self.hashes[at_left], h[left]
            hit = value == want
            row[left[hit]] = at_left[hit]
            left = left[~hit & (value < want)]
        return row


@dataclass
class Model:
    langs: list[str]
    tables: list[HashTable]      # by order, from 1
    logp: list[np.ndarray]       # by order: n-gram x language
    backoff: list[np.ndarray]    # by order of the context: context x language, last row 0
    floor: np.ndarray            # unseen symbol, by language
    heat: float = 1.0            # temperature of the score
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None   # per character
    between: np.ndarray | None = None  # between documents
    limit: np.ndarray | None = None    # of the standardised excess

    def cross_entropy(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Nats per symbol (text x language) and symbols per text."""
        n = len(texts)
        s, owner = _padded(texts)
        total = np.zeros((n, len(self.langs)))
        for start in range(0, len(s), CHUNK):  # bounds the memory
            before = min(start, ORDER - 1)
            part, own = s[start - before:start + CHUNK], owner[start:start + CHUNK]
            score = self._scores(part)[before:]
            real = own >= 0
            own = own[real]
            if len(own):
                first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                total[own[first]] += np.add.reduceat(score[real], first, axis=0, dtype=np.float64)
        count = np.bincount(owner[owner >= 0], minlength=n)
        return -total / np.maximum(count, 1)[:, None], count

    def _scores(self, s: np.ndarray) -> np.ndarray:
        """Log-probability of each symbol after those before it, by language."""
        rows = [self.tables[k].find(_grams(s, k + 1)) for k in range(ORDER)]
        score = np.zeros((len(s), len(self.langs)), np.float32)
        todo = np.arange(len(s))
        for k in range(ORDER - 1, -1, -1):
            row = rows[k][todo]
            hit = row >= 0
            score[todo[hit]] += self.logp[k][row[hit]]
            todo = todo[~hit]
            if k and len(todo):
                score[todo] += self.backoff[k - 1][rows[k - 1][todo - 1]]
        score[todo] += self.floor
        return score

    def judge(self, texts):
        """Language number (-1: none), score and rejection of each text."""
        h, n = self.cross_entropy(texts)
        best = h.argmin(axis=1)
        gap = (h.min(axis=1, keepdims=True) - h) * np.minimum(n, 4000)[:, None] * self.heat
        score = 1 / np.exp(gap).sum(axis=1)
        none = n == 0
        if self.mean is None:
            far = np.zeros(len(texts), bool)
        else:
            far = (h[np.arange(len(texts)), best] - self.mean[best]) > self.limit[best] * self._sd(best, n)
        return np.where(none, -1, best), np.where(none, 0.0, score), far | none

    def _sd(self, best, n):
        return np.sqrt(self.spread[best] ** 2 / np.maximum(n, 1) + self.between[best] ** 2)


def _discount(counts: np.ndarray) -> float:
    return _share_off((counts == 1).sum(), (counts == 2).sum())


def _share_off(one: int, two: int) -> float:
    """The discount, from the numbers of n-grams counted once and twice."""
    return float(min(max(one / (one + 2 * two), 0.1), 0.9)) if one else 0.5


@dataclass
class Level:
    """The n-grams of one order that a language's model has."""
    grams: np.ndarray
    counts: np.ndarray
    discount: float
    contexts: np.ndarray | None = None  # with the total of each, ``mass``; None: of the n-grams here
    mass: np.ndarray | None = None


def kneser_ney(langs: list[str], grams: np.ndarray, lang_of: np.ndarray, counts: np.ndarray) -> Model:
    """Models from the counted n-grams of order ORDER (rows of symbols) of
    each language, all of them."""
    of_order = []
    for lang in range(len(langs)):
        mine = lang_of == lang
        g, c = grams[mine], counts[mine].astype(np.float64)
        levels = [Level(g, c, _discount(c))]
        for _ in range(ORDER - 1):  # continuation counts: distinct symbols before
            g, c = np.unique(levels[0].grams[:, 1:], axis=0, return_counts=True)
            levels.insert(0, Level(g, c.astype(np.float64), _discount(c)))
        of_order.append(levels)
    return _interpolated(langs, of_order)


def _interpolated(langs: list[str], of_order: list[list[Level]]) -> Model:
    """Models from the levels of each language, by order."""
    hash_of = _row_hash
    L = len(langs)
    # per order the n-grams of all languages and the contexts of the next order
    known = [None] * ORDER
    for k in range(ORDER - 1, -1, -1):
        parts = [of_order[i][k].grams for i in range(L)] + ([known[k + 1][:, :-1]] if k < ORDER - 1 else [])
        known[k] = np.unique(np.concatenate(parts), axis=0)
    tables, logp, backoff, prob, floor = [], [], [], [], None
    vocabulary = len(np.unique(np.concatenate([of_order[i][0].grams for i in range(L)])))
    for k in range(ORDER):
        by_hash = np.argsort(hash_of(known[k]))
        symbols = known[k][by_hash]
        hashes = hash_of(symbols)
        table = HashTable(hashes)
        p = np.zeros((len(hashes), L))
        if k:
            gamma = np.zeros((len(tables[k - 1].hashes), L))  # last row: unseen context, log weight 0
        lower = (prob[k - 1][tables[k - 1].find(hash_of(symbols[:, 1:]))] if k else None)
        for i in range(L):
            at = of_order[i][k]
            g, c, d = at.grams, at.counts, at.discount
            rows = table.find(hash_of(g))
            if not k:
                total = c.sum() if at.mass is None else at.mass.sum()
                base = (1 - np.maximum(c - d, 0).sum() / total) / (vocabulary + 1)
                p[:, i] = base
                p[rows, i] += np.maximum(c - d, 0) / total
                floor = np.zeros(L) if floor is None else floor
                floor[i] = np.log(base)
                continue
            ctx = tables[k - 1].find(hash_of(g[:, :-1]))
            size = len(tables[k - 1].hashes)
            mass = np.zeros(size)
            if at.mass is None:
                mass += np.bincount(ctx, weights=c, minlength=size)
            else:
                mass[tables[k - 1].find(hash_of(at.contexts))] = at.mass
            # discounts, and the counts of n-grams that the level is without
            kept = np.bincount(ctx, weights=np.maximum(c - d, 0), minlength=size)
            seen = mass > 0
            w = np.ones(size)
            w[seen] = 1 - kept[seen] / mass[seen]
            gamma[:, i] = np.log(w)
            all_ctx = tables[k - 1].find(hash_of(symbols[:, :-1]))
            p[:, i] = w[all_ctx] * lower[:, i]
            p[rows, i] += np.maximum(c - d, 0) / mass[ctx]
        tables.append(table)
        prob.append(p)
        logp.append(np.log(p).astype(np.float32))
        if k:
            backoff.append(gamma.astype(np.float32))
    return Model(langs, tables, logp, backoff, floor.astype(np.float32))


def _row_hash(g: np.ndarray) -> np.ndarray:
    """Hash of each row of symbols, as :func:`_grams` has it for positions."""
    h = np.zeros(len(g), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(g.shape[1]):
            h = (h + g[:, i].astype(np.uint64) + np.uint64(1)) * _SEED
    return mix(h)


def _tally(key: np.ndarray, cols: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with one row of ``cols`` and the sum of ``n`` each."""
    key, at, of = np.unique(key, return_index=True, return_inverse=True)
    return key, cols[at], np.bincount(of, weights=n, minlength=len(key)).astype(np.int64)


def _counted_grams(batches):
    """``(a, b, n)`` of the n-grams of batches of ``(text, l)``: three symbols
    in ``a``, the fourth and the language in ``b``.  Memory is bounded by the
    longest text and HOLD n-grams."""
    none = (np.zeros(0, np.uint64), np.zeros((0, 2), np.int64), np.zeros(0, np.int64))

    def out(held):
        return pa.RecordBatch.from_pydict({"a": held[1][:, 0], "b": held[1][:, 1], "n": held[2]})

    def pieces():
        for batch in batches:
            texts, langs, size = [], [], 0
            for t, l in zip(batch["text"], batch["l"]):
                t = t.as_py()
                texts.append(t)
                langs.append(l.as_py())
                size += len(t)
                if size >= CHUNK:
                    yield texts, langs
                    texts, langs, size = [], [], 0
            if texts:
                yield texts, langs

    held = none
    for texts, langs in pieces():
        symbols, owner = _padded(texts)
        for start in range(ORDER - 1, len(symbols), 4 * CHUNK):
            s = symbols[start - ORDER + 1:start + 4 * CHUNK].astype(np.int64)
            own = owner[start:start + 4 * CHUNK]
            real = own >= 0
            a = (s[:-3] << 42 | s[1:-2] << 21 | s[2:-1])[real]
            b = (s[3:] | np.asarray(langs, np.int64)[own] << 21)[real]
            with np.errstate(over="ignore"):
                key = mix(mix(a.view(np.uint64)) + b.view(np.uint64) * _SEED)
            new = _tally(key, np.c_[a, b], np.ones(len(a)))
            held = _tally(*(np.concatenate(x) for x in zip(held, new)))
        if len(held[0]) > HOLD:
            yield out(held)
            held = none
    yield out(held)


def _most_frequent(counted: DataFrame, most: int) -> tuple[DataFrame, bool]:
    """Of each language ``l`` of the written ``(l, a, b, n)`` the n-grams of
    largest counts, at most ``most``, and whether any are left out.  Those of
    (nearly) equal counts stay or go together; only if those of the largest
    counts are too many, the first in order of code points stay."""
    level = F.floor(F.log("n") * 32).cast("long")  # some 1,400 levels at most
    there = counted.groupBy("l", level.alias("level")).agg(F.count(F.lit(1)).alias("rows")).collect()
    keep, first = F.lit(False), []
    for l in {r["l"] for r in there}:
        rows = sorted((r for r in there if r["l"] == l), key=lambda r: -r["level"])
        fit = int((np.cumsum([r["rows"] for r in rows]) <= most).sum())
        if fit:
            keep = keep | (F.col("l") == l) & (level >= rows[fit - 1]["level"])
        else:
            first.append(counted.filter((F.col("l") == l) & (level == rows[0]["level"])).orderBy("a", "b").limit(most))
    kept = counted.filter(keep)
    for f in first:
        kept = kept.union(f)
    cut = sum(r["rows"] for r in there) > kept.count()
    return kept, cut


def _symbol_columns(counted: DataFrame) -> DataFrame:
    """``(l, c0 .. c3, n)`` of ``(l, a, b, n)``."""
    low = (1 << 21) - 1
    cols = F.shiftright("a", 42), F.shiftright("a", 21).bitwiseAND(low), F.col("a").bitwiseAND(low), F.col("b").bitwiseAND(low)
    return counted.select("l", *[c.alias(f"c{i}") for i, c in enumerate(cols)], "n")


def _levels(counted: DataFrame, kept: DataFrame, there: list[int]) -> list[list[Level]]:
    """Per language, the levels of the kept n-grams with the counts, discounts
    and totals of contexts of all counted ones."""
    every, some = _symbol_columns(counted), cut_lineage(_symbol_columns(kept), "kept-grams")
    out = {l: [] for l in there}
    for k in range(ORDER, 0, -1):
        g = [f"c{i}" for i in range(ORDER - k, ORDER)]
        if k < ORDER:
            every = cut_lineage(every.groupBy("l", *g).agg(F.count(F.lit(1)).alias("n")), "grams")
            some = cut_lineage(every.join(some.select("l", *g).distinct(), ["l", *g], "left_semi"), "kept-grams")
        mass = (every.groupBy("l", *g[:-1]).agg(F.sum("n").alias("mass"))
                .join(some.select("l", *g[:-1]).distinct(), ["l", *g[:-1]], "left_semi").toPandas())
        few = {(r["l"], r["n"]): r["count"] for r in every.filter("n <= 2").groupBy("l", "n").count().collect()}
        mine = some.toPandas().sort_values(["l", *g])
        for l in there:
            x, m = mine[mine["l"] == l], mass[mass["l"] == l]
            out[l].insert(0, Level(x[g].to_numpy(np.uint32), x["n"].to_numpy(np.float64),
                                   _share_off(few.get((l, 1), 0), few.get((l, 2), 0)),
                                   m[g[:-1]].to_numpy(np.uint32), m["mass"].to_numpy(np.float64)))
    return [out[l] for l in there]


def _model(counted: DataFrame, langs: list[str], most: int) -> Model:
    """The models of the written ``(l, a, b, n)``, ``l`` a number of ``langs``."""
    kept, cut = _most_frequent(counted, most)
    cols = [f"c{i}" for i in range(ORDER)]
    rows = _symbol_columns(kept).toPandas().sort_values(["l", *cols])
    there = sorted(rows["l"].unique())
    if not there:
        return Model([], [], [], [], np.zeros(0, np.float32))
    names = [langs[l] for l in there]
    model = kneser_ney(names, rows[cols].to_numpy(np.uint32),
                       rows["l"].map({l: i for i, l in enumerate(there)}).to_numpy(), rows["n"].to_numpy())
    return _interpolated(names, _levels(counted, kept, there)) if cut else model


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", max_grams: int = MAX_GRAMS) -> Model:
    """Models of every language of ``train`` (rows with a null text or
    language are left out; a text without letters teaches nothing).

    All distinct texts of a language are counted.  The models have the
    n-grams of largest counts of a language, at most ``max_grams``, with
    statistics of all.  Without any letter in ``train`` the model has no
    language and everything is undecided."""
    docs = train.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna().filter(F.col("text").rlike("\\p{L}"))
    langs = sorted(r["lang"] for r in docs.select("lang").distinct().collect())
    if not langs:
        return Model([], [], [], [], np.zeros(0, np.float32))
    number = F.create_map(*[F.lit(x) for i, l in enumerate(langs) for x in (l, i)])[F.col("lang")].cast("long")
    half = F.pmod(F.xxhash64("text", F.lit(12)), F.lit(2))
    chosen = docs.select("text", number.alias("l"), half.alias("half"))
    counted = (chosen.select("text", (F.col("l") * 2 + F.col("half")).alias("l")).distinct()
               .mapInArrow(_counted_grams, "a long, b long, n long")
               .groupBy(F.shiftright("b", 22).alias("l"), "a", F.col("b").bitwiseAND((1 << 21) - 1).alias("b"))
               .agg(F.sum("n").alias("n"),
                    F.sum(F.when(F.shiftright("b", 21).bitwiseAND(1) == 0, F.col("n")).otherwise(0)).alias("n0")))
    counted = cut_lineage(counted, "n-grams")
    model = _model(counted.select("l", "a", "b", "n"), langs, max_grams)
    if not model.langs or MAX_HELD == 0:
        return _calibrated(model, *(np.zeros(0, int),) * 2, np.zeros((0, len(model.langs))))
    judged = None
    for i, n in enumerate((F.col("n") - F.col("n0"), F.col("n0"))):  # each half by the other
        other = _model(cut_lineage(counted.select("l", "a", "b", n.alias("n")).filter("n > 0"), "half"), langs, max_grams)
        if other.langs:
            rows = chosen.filter(F.col("half") == i).select("text", "l", F.xxhash64("text").alias("t"))
            rows = rows.mapInArrow(per_batch(_entropies(other, model.langs, langs)), "l long, t long, n long, h array<double>")
            judged = rows if judged is None else judged.union(rows)
    if judged is None:
        return _calibrated(model, *(np.zeros(0, int),) * 2, np.zeros((0, len(model.langs))))
    return _calibrated_by(model, cut_lineage(judged.filter("n > 0").dropDuplicates(["l", "t", "n"]), "judged"))


def _entropies(model: Model, names: list[str], langs: list[str]):
    """Function of record batches ``(text, l, t)``: the language's number in
    ``names`` instead of ``langs``, symbols (0 also if ``model`` has not the
    language) and cross-entropies in the order of ``names``."""
    to = np.array([names.index(l) if l in names else -1 for l in langs])
    at = [names.index(l) for l in model.langs]
    known = np.isin(np.arange(len(names)), at)

    def run(b):
        h, n = model.cross_entropy(b["text"].to_pylist())
        every = np.full((len(n), len(names)), np.inf)
        every[:, at] = h
        l = to[b["l"].to_numpy()]
        return {"l": l, "t": b["t"], "n": pa.array(np.where((l >= 0) & known[l], n, 0), pa.int64()),
                "h": pa.array(list(every), pa.list_(pa.float64()))}
    return run


def _losses(lang: np.ndarray, n: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Sum over the texts of -log(chance of their language), by HEATS."""
    gap = (h.min(axis=1, keepdims=True) - h) * np.minimum(n, 4000)[:, None]
    own = gap[np.arange(len(lang)), lang]
    return np.array([np.sum(np.log(np.exp(gap * t).sum(axis=1)) - own * t) for t in HEATS])


def _calibrated_by(m: Model, judged: DataFrame) -> Model:
    """:func:`_calibrated` by the written ``(l, n, h)``: losses are added up in
    Spark; of the texts that their language fits best, numbers by language, bin
    of the cross-entropy and of the symbols come to the driver, with the bins'
    means."""
    def arrays(b):
        lang = b["l"].to_numpy()
        return lang, b["n"].to_numpy(), np.reshape(b["h"].flatten().to_numpy(), (len(lang), -1))

    def losses(b):
        return {"i": np.arange(len(HEATS)), "loss": _losses(*arrays(b))}

    def right(b):
        lang, n, h = arrays(b)
        ok = h.argmin(axis=1) == lang
        return {"l": lang[ok], "n": n[ok], "own": h[np.arange(len(lang)), lang][ok]}

    rows = judged.select("l", "n", "h")
    loss = dict(rows.mapInArrow(per_batch(losses), "i long, loss double").groupBy("i").agg(F.sum("loss")).collect())
    if not loss:
        return _calibrated(m, *(np.zeros(0, int),) * 2, np.zeros((0, len(m.langs))))
    bins = (rows.mapInArrow(per_batch(right), "l long, n long, own double")
            .groupBy("l", F.floor(F.col("own") * BINS).alias("x"), F.floor(F.log("n") * LENGTH_BINS).alias("y"))
            .agg(F.avg("own").alias("own"), F.avg("n").alias("n"), F.count(F.lit(1)).alias("rows")).toPandas())
    m.heat = float(HEATS[int(np.argmin([loss[i] for i in range(len(HEATS))]))])
    return _limited(m, bins["l"].to_numpy(np.int64), bins["n"].to_numpy(np.float64), bins["own"].to_numpy(np.float64),
                    bins["rows"].to_numpy(np.int64))


def _calibrated(m: Model, lang: np.ndarray, n: np.ndarray, h: np.ndarray) -> Model:
    """Temperature by likelihood of the judged documents' languages; per
    language a rejection limit, see :func:`_limited`.  Rows that another
    language fits better set no limit."""
    if len(lang):
        m.heat = float(HEATS[int(np.argmin(_losses(lang, n, h)))])
    right = h.argmin(axis=1) == lang if len(lang) else np.zeros(0, bool)
    lang, n, h = lang[right], n[right], h[right]
    return _limited(m, lang, n, h[np.arange(len(lang)), lang], np.ones(len(lang), np.int64))


def _quantile(x: np.ndarray, rows: np.ndarray, q: float) -> float:
    """The ``q`` quantile of values that stand for so many rows each: a row's
    value, for the median the mean of the middle two."""
    order = np.argsort(x, kind="stable")
    upto = np.cumsum(rows[order])
    at = lambda i: x[order[np.searchsorted(upto, i, "right")]]
    last = upto[-1] - 1
    return float((at(last // 2) + at(last - last // 2)) / 2 if q == 0.5 else at(int(np.floor(q * last))))


def _limited(m: Model, lang: np.ndarray, n: np.ndarray, own: np.ndarray, rows: np.ndarray) -> Model:
    """Per language a rejection limit of the standardised excess, for a share
    REJECTED of its texts (at least LEAST), by values that stand for so many
    ``rows`` each.  A few odd ones lie beyond the quantile.  A
    language of fewer than FEW rows takes spread and limit from the rows of
    all, one without any also the typical level; with fewer than 3 rows in all
    nothing is rejected."""
    L = len(m.langs)
    m.mean, m.spread, m.between, m.limit = np.full(L, np.inf), np.ones(L), np.zeros(L), np.full(L, np.inf)
    if rows.sum() < 3:
        return m
    there = np.unique(lang)
    for l in there:
        m.mean[l] = _quantile(own[lang == l], rows[lang == l], 0.5)
    typical = np.median(m.mean[there])
    apart = np.max(np.abs(m.mean[there] - typical))
    off = own - m.mean[lang]
    for l in range(L):
        some = lang == l
        if rows[some].sum() < FEW:
            some = np.ones(len(lang), bool)
        x, k, r = off[some], n[some], rows[some]
        m.spread[l] = max(1.4826 * _quantile(np.abs(x * np.sqrt(k)), r, 0.5), 1.0)
        m.between[l] = max(1.4826 * _quantile(np.abs(x), r, 0.5), 0.02)
        if l not in there:
            m.mean[l], m.between[l] = typical, np.hypot(m.between[l], apart)
        z = x / m._sd(np.full(len(x), l), k)
        q = _quantile(z, r, TAIL)
        m.limit[l] = max(LEAST, q * (1 + np.log((1 - TAIL) / REJECTED) / np.log(0.5 / (1 - TAIL))))
    return m


def identify(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` (``und`` for a null text or one without a
    letter), ``score`` (0 to 1, calibrated chance of that language; 0 if
    undecided) and ``rejected`` (no learned language fits, or undecided).
    The model travels as one broadcast; its size is bounded by ``max_grams``.
    Only the columns ``keep`` of ``docs`` come along (all if not given);
    columns of ``docs`` with the new names are replaced."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    new = ["lang_pred", "score", "rejected"]
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    rest = docs.select(*keep, F.col(text_col).alias("__text_"))
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def judged(b):
        m = shared.value
        texts = b.column(len(keep)).to_pylist()
        if m.langs:
            best, score, far = m.judge(texts)
        else:
            best, score, far = np.full(len(texts), -1), np.zeros(len(texts)), np.ones(len(texts), bool)
        names = m.langs + [UNDECIDED]
        return {**{c: b.column(i) for i, c in enumerate(keep)},
                "lang_pred": [names[i] for i in best], "score": score, "rejected": far}

    return rest.mapInArrow(per_batch(judged), schema)


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    return F.pmod(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")), F.lit(folds)) == fold
