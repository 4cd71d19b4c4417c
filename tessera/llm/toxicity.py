"""Toxicity by weak supervision.

Many voters look for toxicity in a text: fixed lexicons, text patterns, and
lexicons mined from labelled documents (words and word beginnings that occur
almost only in toxic ones, dealt into groups).  A generative model of the
votes, with a latent class and a dependency tree over the voters, estimates
each voter's rates in both classes and the correlations between voters, and
gives every vote pattern a posterior.  A linear classifier over words and
word beginnings is trained on the posterior labels and scores every text.

The label model and the choice of features count all training rows, in Spark.
Bounded samples, dealt by class, are taken for the mined lexicons
(``MAX_LABELLED`` labelled rows) and for the final classifier (``MAX_ROWS``
rows).  What comes to the driver is bounded by these, by the number of vote
patterns and by ``MAX_FEATURES``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.base import SLICE, if_small, mix, per_batch, windows, word_hashes, words_of
from tessera.session import cut_lineage

MAX_LABELLED = 12_000
MAX_ROWS = 18_000
MAX_FEATURES = 20_000
MINED_VOTERS = 10
THRESHOLD = 0.7

# Lexicons and patterns of the fixed voters (plain values).
LEXICONS = {
    "insult": "idiot idiots moron morons imbecile fool dumb stupid loser losers clown clowns retard cretin dimwit",
    "contempt": "pathetic worthless disgusting trash garbage scum vermin filth filthy pig pigs rat rats freak freaks",
    "hostile": "hate kill hang burn destroy hurt beat shoot stab",
    "vulgar": "bitch bastard asshole shit crap damn fuck fucking prick slut whore",
    "insult_fr": "idiote imbécile crétin débile abruti connard connasse salaud salope ordure minable",
    "insult_de": "idiotin dumm dummkopf trottel vollidiot arschloch schlampe abschaum drecksack versager",
    "insult_es": "idiota imbécil estúpido estúpida tonto basura escoria inútil cabrón puta asqueroso",
}
PATTERNS = {
    "you_are": r"\b(you|u) (are|r) (a |an |such |so |all )?\w*(idiot|moron|loser|trash|stupid|pathetic|worthless|disgusting)",
    "silence": r"\bshut (up|your)\b|\bgo to hell\b|\bget lost\b",
    "threat": r"\b(i|we) will (kill|hurt|destroy|find) (you|them)\b",
    "shouting": r"([A-Z]{4,}\W+){4,}|!{4,}",
}
_CAPITALS = re.compile(r"[A-Z]{4}")
FIXED = {w: name for name, words in LEXICONS.items() for w in words.split()}

#: ASCII other than letters becomes a blank; A-Z is lower-cased.
_TABLE = bytes((c + 32 if 65 <= c <= 90 else c) if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def word_set(text: str | None) -> set[bytes]:
    return set((text or "").encode("utf-8", "replace").translate(_TABLE).split())


def features(word: bytes) -> list[str]:
    """The word, its beginnings of 4 to 6 characters, and fixed lexicons."""
    w = word.decode("utf-8", "replace").lower()
    out = ["=" + w] + [f"{k}{w[:k]}" for k in (4, 5, 6) if len(w) >= k]
    if w in FIXED:
        out.append("lexicon")
    return out


#: How often a feature must occur among the distinct words of a text, and in
#: what share of them, for each level of it.
LEVELS = ((1, 0.0), (2, 0.005), (3, 0.01), (4, 0.02))


def leveled(counts: dict[str, int], words: int) -> list[str]:
    """The levels that a text's features reach, as ``level:feature``."""
    out = []
    for f, n in counts.items():
        out.append("0:" + f)
        if n > 1 and f[0] != "=":
            out += [f"{i}:{f}" for i, (k, share) in enumerate(LEVELS) if i and n >= k and n >= share * words]
    return out


class Stems(dict):
    """A word's features that the model knows (at any level), remembered up
    to ``most`` words."""

    most = 400_000

    def __init__(self, known):
        self.known = known

    def __missing__(self, word: bytes) -> tuple:
        t = tuple(f for f in features(word) if f in self.known)
        if len(self) < self.most:
            self[word] = t
        return t

    def of(self, text: str | None) -> list[str]:
        """The levels of known features that the text reaches."""
        words = word_set(text)
        counts: dict[str, int] = {}
        for t in filter(None, map(self.__getitem__, words)):
            for f in t:
                counts[f] = counts.get(f, 0) + 1
        return leveled(counts, len(words)) if counts else []


class Beginnings(Stems):
    """As ``Stems`` where all beginnings of a known word or beginning are
    known too: one that is not ends the search."""

    def __missing__(self, word: bytes) -> tuple:
        w = word.decode("utf-8", "replace").lower()
        out = ["lexicon"] if w in FIXED and "lexicon" in self.known else []
        for f in [f"{k}{w[:k]}" for k in (4, 5, 6) if len(w) >= k] + ["=" + w]:
            if f not in self.known:
                break
            out.append(f)
        t = tuple(out)
        if len(self) < self.most:
            self[word] = t
        return t


def stems_of(levels) -> Stems:
    return Stems({f[2:] for f in levels})


@dataclass
class LabelModel:
    """Latent class y, votes in a tree: P(y) prod_j P(v_j | v_parent(j), y)."""

    prior: float
    parent: np.ndarray          # -1: none
    rate: np.ndarray            # class x voter x value of the parent
    correlation: dict = field(default_factory=dict)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        z = np.log([1 - self.prior, self.prior])[None, :].repeat(len(votes), 0)
        for j, p in enumerate(self.parent):
            given = votes[:, p] if p >= 0 else np.zeros(len(votes), int)
            for y in (0, 1):
                r = self.rate[y, j][given]
                z[:, y] += np.where(votes[:, j] == 1, np.log(r), np.log1p(-r))
        return 1 / (1 + np.exp(np.clip(z[:, 0] - z[:, 1], -50, 50)))


def fit_label_model(votes: np.ndarray, n: np.ndarray, share: float, gold: np.ndarray | None = None,
                    rounds: int = 100) -> LabelModel:
    """By expectation maximisation over distinct vote patterns (0/1 rows of
    ``votes``, counts ``n``); ``share`` starts the share of the class that
    votes stand for.  ``gold`` has the class of patterns counted over labelled
    rows (0 or 1, nan: not known), which holds the class of voters that never
    meet the others.  Correlated voters, by the information they share within
    the classes, are linked to a tree, found anew every 20 rounds."""
    m = votes.shape[1]
    q = np.where(votes.any(axis=1), 0.95, min(share, 0.02))
    parent, corr = np.full(m, -1), {}
    known = np.full(len(votes), np.nan) if gold is None else gold
    for step in range(rounds):
        q = np.where(np.isnan(known), q, known)
        w = np.stack([n * (1 - q), n * q])
        prior = float(np.clip(w[1].sum() / n.sum(), 1e-4, 0.9))
        rate = np.empty((2, m, 2))
        for y in (0, 1):
            for j in range(m):
                for v in (0, 1):
                    here = (votes[:, parent[j]] == v) if parent[j] >= 0 else np.ones(len(votes), bool)
                    rate[y, j, v] = (w[y][here & (votes[:, j] == 1)].sum() + 0.05) / (w[y][here].sum() + 1.0)
        model = LabelModel(prior, parent, np.clip(rate, 1e-5, 1 - 1e-5), corr)
        q = np.where(np.isnan(known), model.posterior(votes), known)
        if step % 20 == 19 and step < rounds - 20:
            parent, corr = _tree(votes, np.stack([n * (1 - q), n * q]))
    return model


def _tree(votes: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, dict]:
    """Chow-Liu tree of the voters by conditional mutual information given
    the class, without links that 2 N I finds insignificant (10.8)."""
    m, total = votes.shape[1], w.sum()
    info, corr = np.zeros((m, m)), {}
    for y in (0, 1):
        c = w[y].sum() + 1e-9
        one = votes.T @ w[y] / c
        both = (votes * w[y][:, None]).T @ votes / c
        for a, b in ((1, 1), (1, 0), (0, 1), (0, 0)):
            joint = (both if a and b else one[:, None] - both if a else one[None, :] - both if b
                     else 1 - one[:, None] - one[None, :] + both)
            alone = (one if a else 1 - one)[:, None] * (one if b else 1 - one)[None, :]
            with np.errstate(divide="ignore", invalid="ignore"):
                t = joint * np.log(joint / alone)
            info += c / total * np.where(np.isfinite(t) & (joint > 1e-12), t, 0)
        sd = np.sqrt(np.maximum(one * (1 - one), 1e-12))
        corr[y] = (both - np.outer(one, one)) / np.outer(sd, sd)
    parent, inside = np.full(m, -1), [0] if m else []
    while len(inside) < m:
        rest = [j for j in range(m) if j not in inside]
        sub = info[np.ix_(inside, rest)]
        i, j = np.unravel_index(sub.argmax(), sub.shape)
        if 2 * total * sub[i, j] > 10.8:
            parent[rest[j]] = inside[i]
        inside.append(rest[j])
    return parent, {(int(p), j): (float(corr[0][p, j]), float(corr[1][p, j])) for j, p in enumerate(parent) if p >= 0}


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    labels: LabelModel | None = None
    voters: list[str] = field(default_factory=list)


#: Without any document to learn from, the fixed lexicons decide.
DEFAULT = Model({"0:lexicon": 4.0}, -2.5)


def _signature(text: str | None) -> int:
    """Three minima of the hashes of a text's 3-word shingles, as one number:
    near copies mostly have the same one, other texts that share a passage
    hardly ever."""
    words = word_hashes(words_of(text))
    if not len(words):
        return 0
    h = windows(words, min(3, len(words)))  # minima need neither order nor distinct hashes
    low = np.array([mix(h ^ np.uint64(k * 77 + 1)).min() for k in range(3)])
    return int(windows(low, 3)[0] >> np.uint64(1))


def _uniform(seed: int, col: str):
    return F.pmod(F.xxhash64(col, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def _labelled(docs: DataFrame, gold: DataFrame, most: int) -> DataFrame:
    """``(text, q)`` of at most about ``most`` labelled rows, toxic ones first
    (up to half of ``most``); of texts with one signature one stays, toxic
    if one is."""
    n = {r["toxic"]: r["count"] for r in gold.groupBy("toxic").count().collect()}
    toxic = min(n.get(1, 0), most // 2)
    part = {1: toxic / max(n.get(1, 0), 1), 0: min(1.0, (most - toxic) / max(n.get(0, 0), 1))}
    share = F.when(F.col("toxic") == 1, part[1]).otherwise(part[0])
    # at most `most` rows but for the spread of a binomial count
    few = F.broadcast(gold.filter(_uniform(3, "doc_id") < share))

    def signed(b):
        return {"text": b["text"], "toxic": b["toxic"],
                "s": pa.array([_signature(t) for t in b["text"].to_pylist()], pa.int64())}

    rows = (docs.join(few, "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
            .mapInArrow(per_batch(signed), "text string, toxic int, s long"))
    one = rows.groupBy("s").agg(F.max(F.struct("toxic", "text")).alias("r"))
    return cut_lineage(one.select("r.text", F.col("r.toxic").cast("double").alias("q")), "labelled")


class Marked:
    """The features whose hash is marked in a bitmap of fixed size: those
    sought, and some others (which cost a row each, and no result)."""

    bits = 1 << 23

    def __init__(self, words: np.ndarray):
        self.words = words.astype("<u4").tobytes()

    @classmethod
    def at(cls, feature: str) -> int:
        return xxhash.xxh3_64_intdigest(feature.encode("utf-8", "surrogatepass")) % cls.bits

    @classmethod
    def of(cls, table: DataFrame) -> Marked:
        """From the column ``h`` of a table; at most ``bits / 32`` rows are
        collected."""
        got = (table.groupBy(F.shiftright("h", 5).alias("at"))
               .agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 31 as int))")).alias("m")).collect())
        words = np.zeros(cls.bits // 32, np.uint32)
        for r in got:
            words[r["at"]] = r["m"]
        return cls(words)

    def __contains__(self, feature: str) -> bool:
        at = self.at(feature)
        return bool(self.words[at >> 3] >> (at & 7) & 1)


class Every:
    """Contains every feature."""

    def __contains__(self, feature: str) -> bool:
        return True


def _counts(rows: DataFrame, known: Marked | None = None) -> DataFrame:
    """``(f, n)``: in how many rows of ``text`` a feature occurs; of the
    marked features, or of all."""
    shared = rows.sparkSession.sparkContext.broadcast(known or Every())

    def run(batches):
        stems = Beginnings(shared.value)
        for b in batches:
            n = {}
            for t in b.column(0).to_pylist():
                for f in stems.of(t):
                    n[f] = n.get(f, 0) + 1
            yield pa.RecordBatch.from_pydict({"f": pa.array(list(n), pa.string()),
                                              "n": pa.array(list(n.values()), pa.int64())})

    return rows.select("text").mapInArrow(run, "f string, n long").groupBy("f").agg(F.sum("n").alias("n"))


def _places(b: pa.RecordBatch) -> dict:
    return {"f": b["f"], "n": b["n"], "h": pa.array([Marked.at(f[2:]) for f in b["f"].to_pylist()], pa.int64())}


def _telling_features(pos: DataFrame, neg: DataFrame, n_pos: int, n_neg: int) -> list[str]:
    """Features that tell the texts ``pos`` from the texts ``neg``, surest
    first, at most MAX_FEATURES: at least half of a feature's rows are in
    ``pos``, and the log-likelihood ratio against the share of ``pos`` exceeds
    what chance yields among as many features as ``pos`` has.

    Only features of ``pos`` can be such, and only those in so many of its
    rows that they would exceed it without any row of ``neg``; these alone are
    counted in ``neg``."""
    if not n_pos:
        return []
    share = float(np.clip(n_pos / (n_pos + n_neg), 1e-6, 0.5))
    found = cut_lineage(_counts(pos), "features")
    least = 2 * np.log(max(found.count(), 1)) + 6
    able = found.filter(F.lit(float(-2 * np.log(share))) * F.col("n") >= float(least))
    able = cut_lineage(able.mapInArrow(per_batch(_places), "f string, n long, h long"), "candidates")
    other = _counts(neg, Marked.of(able)).select("f", F.col("n").alias("rest"))
    c = able.join(other, "f", "left").withColumn("rest", F.coalesce("rest", F.lit(0)))
    sure = F.col("n") / (F.col("n") + F.col("rest"))
    ratio = 2 * (F.col("n") * F.log(sure / share)
                 + F.when(F.col("rest") > 0, F.col("rest") * F.log((1 - sure) / (1 - share))).otherwise(0.0))
    return [r["f"] for r in c.filter((sure >= 0.5) & (ratio >= float(least))).withColumn("ratio", ratio)
            .orderBy(F.col("ratio").desc(), "f").limit(MAX_FEATURES).collect()]


class Voters:
    """The votes of a text as bits: lexicons, patterns, mined lexicons."""

    def __init__(self, mined: list[str]):
        self.names = list(LEXICONS) + list(PATTERNS) + [f"mined_{k}" for k in range(MINED_VOTERS)]
        self.bit = {f: 1 << (len(LEXICONS) + len(PATTERNS) + i % MINED_VOTERS) for i, f in enumerate(mined)}
        self.lexicon = {w: 1 << list(LEXICONS).index(name) for w, name in FIXED.items()}
        self.patterns = [re.compile(p) for p in PATTERNS.values()]
        self.stems = stems_of(mined)
        self.stems.known |= {"=" + w for w in FIXED}

    def mask(self, text: str) -> int:
        v, counts, words = 0, {}, word_set(text)
        for t in filter(None, map(self.stems.__getitem__, words)):
            for f in t:
                counts[f] = counts.get(f, 0) + 1
                if f[0] == "=":
                    v |= self.lexicon.get(f[1:], 0)
        for x in leveled(counts, len(words)):
            v |= self.bit.get(x, 0)
        low = text.lower()
        # what every match of a pattern holds is looked for before the pattern
        may = ("u are " in low or "u r " in low, "shut " in low or "go to hell" in low or "get lost" in low,
               " will " in low, "!!!!" in text or _CAPITALS.search(text))
        for k, (p, possible) in enumerate(zip(self.patterns, may)):
            if possible and p.search(text if k == 3 else low):
                v |= 1 << (len(LEXICONS) + k)
        return v


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, max_rows: int = MAX_ROWS) -> Model:
    """Model from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) of
    training rows.  Null texts and labels teach nothing; a doc_id labelled
    twice counts as toxic if one label says so.  Without any training text
    the fixed lexicons decide.

    All rows vote, and the label model sees the votes of all texts (of texts
    with one signature one, a labelled one before others).  The features are
    counted over all rows: those whose posterior is half or more (one a
    signature) against the rest."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text").filter("text is not null")
    gold = labels.dropna().groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    gold = cut_lineage(gold, "gold")
    marked = _labelled(docs, gold, max_labelled)
    n = {r["q"]: r["count"] for r in marked.groupBy("q").count().collect()}
    mined = [f for f in _telling_features(marked.filter("q = 1"), marked.filter("q = 0"), n.get(1.0, 0), n.get(0.0, 0))
             if f != "0:lexicon"]
    shared = spark.sparkContext.broadcast(mined)

    def vote(batches):
        voters = Voters(shared.value)
        for b in batches:
            for i in range(0, b.num_rows, SLICE):
                part = b.slice(i, SLICE)
                texts = part.column(1).to_pylist()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": part.column(0), "text": part.column(1),
                    "s": pa.array([_signature(t) for t in texts], pa.int64()),
                    "v": pa.array([voters.mask(t) for t in texts], pa.int64())})

    schema = T.StructType([*docs.schema.fields, T.StructField("s", T.LongType()), T.StructField("v", T.LongType())])
    voted = cut_lineage(docs.mapInArrow(vote, schema), "votes")
    known = voted.select("doc_id", "s", "v").join(gold, "doc_id", "left")
    first = F.min(F.struct(F.col("toxic").isNull().alias("open"), "v", "toxic"))
    seen = (known.groupBy("s").agg(first.alias("r")).groupBy(F.col("r.v").alias("v"), F.col("r.toxic").alias("toxic"))
            .count().orderBy("v", "toxic").collect())  # at most 3 x 2^voters rows
    if not seen:
        return DEFAULT
    names = Voters([]).names
    v = np.array([r["v"] for r in seen], np.int64)
    count = np.array([r["count"] for r in seen], float)
    votes = (v[:, None] >> np.arange(len(names)) & 1).astype(int)
    truth = np.array([np.nan if r["toxic"] is None else r["toxic"] for r in seen], float)
    told = ~np.isnan(truth)
    share = float(count[told & (truth == 1)].sum() / count[told].sum()) if told.any() else 0.05
    label_model = fit_label_model(votes, count, share or 0.05, truth)
    # a pattern of rows that are all copies of others is in no representative
    kinds = np.array([r["v"] for r in voted.select("v").distinct().collect()], np.int64)
    q_of = label_model.posterior((kinds[:, None] >> np.arange(len(names)) & 1).astype(int))
    table = if_small(cut_lineage(spark.createDataFrame([(int(a), float(q)) for a, q in zip(kinds, q_of)],
                                                       "v long, q double"), "posteriors"))
    soft = voted.join(table, "v").select("text", "s", "q")
    high = cut_lineage(soft.filter("q >= 0.5").groupBy("s").agg(F.max(F.struct("q", "text")).alias("r"))
                       .select("s", "r.q", "r.text"), "high")
    n_high, n_all = high.count(), float(count.sum())
    n_low = max(n_all - n_high, 0.0)
    chosen = _telling_features(high, soft.filter("q < 0.5"), n_high, n_low)
    if "0:lexicon" not in chosen:
        chosen.append("0:lexicon")

    # the classifier: about max_rows rows at most, half of them of high posterior
    part = min(1.0, max_rows / 2 / max(n_high, 1))
    rest = min(1.0, (max_rows - min(n_high, max_rows / 2)) / max(n_low, 1))
    low = (soft.filter((F.col("q") < 0.5) & (_uniform(4, "s") < rest)).groupBy("s")
           .agg(F.max(F.struct("q", "text")).alias("r")).select("r.q", "r.text", F.lit(1 / rest).alias("weight")))
    sample = high.filter(_uniform(4, "s") < part).select("q", "text", F.lit(1 / part).alias("weight")).union(low)
    number = {f: i for i, f in enumerate(chosen)}
    telling = stems_of(chosen)

    def sparse(b):
        at = [[number[f] for f in telling.of(t) if f in number] for t in b["text"].to_pylist()]
        return {"q": b["q"], "weight": b["weight"], "at": pa.array(at, pa.list_(pa.int32()))}

    rows = sample.mapInArrow(per_batch(sparse), "q double, weight double, at array<int>").toPandas()
    w, bias = _logistic(rows["q"].to_numpy(), rows["at"].tolist(), len(chosen), rows["weight"].to_numpy())
    return Model({f: float(x) for f, x in zip(chosen, w) if x}, bias, label_model, names)


def _logistic(q: np.ndarray, at: list, size: int, weight: np.ndarray, steps: int = 300,
              l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights (not below 0: every feature was chosen for toxicity) and bias
    of a logistic regression on soft labels, by accelerated descent.  A row
    stands for ``weight`` rows.  Toxic
    rows together weigh up to five times what their number says."""
    own = np.repeat(np.arange(len(q)), [len(a) for a in at])
    col = np.concatenate([np.asarray(a, np.int64) for a in at]) if len(own) else np.zeros(0, np.int64)
    mass = max((q * weight).sum(), 1e-9)
    row_weight = weight * (q * min(5.0, (weight.sum() - mass) / mass) + (1 - q))
    row_weight /= row_weight.sum()
    w, b = np.zeros(size), -2.0
    sw, sb = np.zeros(size) + 1e-8, 1e-8
    for _ in range(steps):
        z = b + np.bincount(own, weights=w[col], minlength=len(q))
        off = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - q) * row_weight
        g = np.bincount(col, weights=off[own], minlength=size) + l2 * w / max(len(q), 1)
        sw += g * g
        sb += off.sum() ** 2
        w = np.maximum(w - 0.5 * g / np.sqrt(sw), 0)
        b = min(b - 0.5 * off.sum() / np.sqrt(sb), -2.0)
    return w, float(b)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None,
          threshold: float = THRESHOLD) -> DataFrame:
    """The columns ``keep`` (all, if not given) of ``docs`` with ``score`` (0
    to 1, higher: toxic likelier) and ``predicted`` (1 from ``threshold``),
    from the whole text.  A null or empty text has the score of no evidence.
    Columns of ``docs`` with these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    rest = docs.select(*keep, F.col(text_col).alias("__text_"))
    schema = T.StructType([*docs.select(*keep).schema.fields, T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])

    def batches(it):
        m = shared.value
        stems, weight = stems_of(m.weights), m.weights
        for b in it:
            z = np.array([sum(weight.get(f, 0.0) for f in stems.of(t)) for t in b.column(len(keep)).to_pylist()], float)
            z += m.bias
            p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield pa.RecordBatch.from_pydict({**{c: b.column(i) for i, c in enumerate(keep)}, "score": p,
                                              "predicted": pa.array((p >= threshold).astype(np.int32))})

    return rest.mapInArrow(batches, schema)
