"""URL filter: rules first, else logistic regression on hashed character
n-grams of host and path, trained from a small labelled URL table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.base import LOWER, UPPER, mix, per_batch

BUCKETS = 1 << 16
SIZES = (3, 4, 5)
#: The fit gathers the labelled table on the driver: at most so many rows.
MAX_LABELLED = 100_000

#: A small labelled URL table: pages worth keeping, and unwanted ones
#: (spam, gambling, pills, adult, piracy, link farms).
KEEP = """https://news.sample.org/2021/05/city-council-votes https://www.library.sample.edu/catalog/history
https://en.wiki.sample.org/wiki/Photosynthesis https://docs.sample.net/en/reference/functions.html
https://blog.gardener.sample.com/growing-tomatoes https://museum.sample.org/fr/collections/peinture
https://www.university.sample.edu/physics/lecture-notes https://recipes.sample.com/en/bread
https://www.weather.sample.gov/forecast/today https://m.daily.sample.com/en/sports/football
https://forum.sample.net/threads/bicycle-repair https://journal.sample.org/articles/2019/climate
https://www.hospital.sample.org/patients/visiting https://archive.sample.org/details/letters-1890
https://de.travel.sample.com/berlin/museen.html https://maps.sample.net/help https://www.school.sample.org/calendar
https://research.sample.edu/papers/1234.html https://blog.teacher.sample.net/en/685 http://poems.sample.com/fr/411
https://www.parliament.sample.gov/debates/2020 https://m.cooking.sample.com/es/sopa https://code.sample.io/guide/start
https://stories.sample.org/en/973/ https://www.zoo.sample.org/animals/otter https://radio.sample.net/programme
https://blog.painter.sample.org/de/612 https://books.sample.com/reviews/novel http://notes.sample.net/en/17.html
https://www.theatre.sample.com/en/tickets/hamlet https://science.sample.org/es/797 https://local.sample.net/en/25
https://www.health.sample.gov/advice/sleep https://history.sample.edu/en/148.html https://m.music.sample.com/fr/825""".split()
UNWANTED = """https://cheap-pills.sample.com/buy-now http://www.casino-bonus.sample.net/free-spins
https://spam-farm.sample.org/links http://hot-singles.sample.com/en/tonight https://free-money.sample.net/win-cash
https://www.replica-watches.sample.com/discount http://payday-loan.sample.org/apply-fast
https://xxx-videos.sample.com/watch http://viagra-online.sample.net/order https://click-here.sample.com/prize
https://lottery-winner.sample.org/claim http://cracked-software.sample.net/download-free
https://best-seo-links.sample.com/backlinks http://adult-cams.sample.net/live https://poker-online.sample.com/bonus
https://link-farm.sample.net/page/99 http://cheap-meds.sample.org/no-prescription
https://weight-loss-miracle.sample.com/offer http://get-rich-quick.sample.net/secret
https://fake-ids.sample.com/buy https://torrent-movies.sample.org/free-download http://betting-tips.sample.com/win
https://pills-shop.sample.net/cheap http://sexy-girls.sample.com/chat https://casino-slots.sample.org/jackpot
http://www.free-iphone.sample.net/winner https://discount-drugs.sample.com/order-now
http://spam-links.sample.net/farm https://porn-tube.sample.org/videos http://essay-writing-cheap.sample.com/buy
https://crypto-doubler.sample.net/invest http://traffic-exchange.sample.com/seo https://hacked-accounts.sample.org/sell
http://malware-scan.sample.net/alert https://cheap-followers.sample.com/buy-likes""".split()

#: Rules of the production filter: (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; path: from there up to ``?``, ``#`` or the end.  Both are
    empty for a null url and one without ``://``."""
    at = F.locate("://", url)
    rest = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Longest rule whose host is the url's or a parent domain of it and whose
    path begins the url's, and its verdict; nulls if none fits.  Rules are a
    short list kept by people, written into the expression."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(v)).otherwise(verdict)
    return name, verdict


def features(hosts, paths) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams (as characters of ``<host>path>``) and the url
    each belongs to, in order of urls."""
    urls = [f"<{h}>{p}>" for h, p in zip(hosts, paths)]
    s = np.frombuffer("".join(urls).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    owner = np.repeat(np.arange(len(urls)), [len(u) for u in urls])
    at, own = [], []
    for k in SIZES:
        m = len(s) - k + 1
        if m <= 0:
            continue
        h = np.full(m, k, np.uint64)
        for i in range(k):
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + s[i:i + m])
        inside = owner[:m] == owner[k - 1:]
        at.append((h[inside] >> np.uint64(48)).astype(np.int64) % BUCKETS)
        own.append(owner[:m][inside])
    if not at:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, own = np.concatenate(at), np.concatenate(own)
    pair = np.unique(own * BUCKETS + at)  # presence, not counts
    return pair % BUCKETS, pair // BUCKETS


def _margins(weights: np.ndarray, hosts, paths) -> np.ndarray:
    at, own = features(hosts, paths)
    size = np.maximum(np.bincount(own, minlength=len(hosts)), 1)
    return weights[-1] + np.bincount(own, weights=weights[at], minlength=len(hosts)) / np.sqrt(size)


def fit(labelled: DataFrame, url_col: str = "url", label_col: str = "unwanted", steps: int = 400,
        l2: float = 0.02) -> np.ndarray:
    """Weights of the buckets and, last, the bias, by gradient descent from
    the labelled rows (null urls or labels are left out; more than
    ``MAX_LABELLED`` rows are refused, as they are gathered here).  With one
    label only, every url gets that label."""
    host, path = host_and_path(F.col(url_col))
    rows = (labelled.filter(F.col(url_col).isNotNull() & F.col(label_col).isNotNull())
            .select(host.alias("h"), path.alias("p"), F.col(label_col).cast("int").alias("y")))
    if rows.count() > MAX_LABELLED:
        raise ValueError(f"the labelled url table has more than {MAX_LABELLED} rows")
    t = rows.orderBy("h", "p", "y").toPandas()
    w = np.zeros(BUCKETS + 1)
    if not len(t):
        return w
    y = t["y"].to_numpy(float)
    if y.min() == y.max():
        w[-1] = 10.0 if y[0] else -10.0
        return w
    at, own = features(t["h"], t["p"])
    value = 1 / np.sqrt(np.bincount(own, minlength=len(y)))[own]
    for _ in range(steps):
        z = w[-1] + np.bincount(own, weights=w[at] * value, minlength=len(y))
        off = 1 / (1 + np.exp(-z)) - y
        g = np.bincount(at, weights=off[own] * value, minlength=BUCKETS) / len(y)
        w[:-1] -= 4.0 * (g + l2 / len(y) * w[:-1])
        w[-1] -= 4.0 * off.mean()
    return w


def default_labels(spark) -> DataFrame:
    return spark.createDataFrame([(u, 0) for u in KEEP] + [(u, 1) for u in UNWANTED], "url string, unwanted int")


def judge(pages: DataFrame, weights: np.ndarray, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule`` (host
    and path of the rule that decided, else null), ``verdict`` (``allow`` or
    ``block``: the rule's, else block if the model's ``score`` is 0.5 or
    more) and ``score``.  A null url, or one without ``://``, has an empty
    host and path, which the model judges as such.  Ids may repeat or be
    null; an empty table gives an empty result; other columns are not read."""
    shared = pages.sparkSession.sparkContext.broadcast(weights)
    host, path = host_and_path(F.col(url_col))
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    d = (pages.select(F.col(id_col), host.alias("host"), path.alias("path"))
         .withColumns({"rule": rule, "said": said}))

    def run(b):
        z = _margins(shared.value, b["host"].to_pylist(), b["path"].to_pylist())
        return {**{f.name: b.column(i) for i, f in enumerate(b.schema)}, "score": pa.array(1 / (1 + np.exp(-z)))}

    schema = T.StructType([*d.schema.fields, T.StructField("score", T.DoubleType())])
    verdict = F.coalesce("said", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return d.mapInArrow(per_batch(run), schema).select(id_col, "host", "path", "rule", verdict.alias("verdict"), "score")
