from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest

import __spark_entry__ as entry
from tessera.llm import langid

EN = "the cat sat on the mat and the dog ran to the house while it was raining outside in the street"
DE = "der hund lief durch die strasse und die katze schlief auf dem sofa weil es draussen regnete und kalt war"


def brute_entropy(train, text, vocab=None):
    """Interpolated Kneser-Ney of order 4 with dictionaries, one language;
    vocab: distinct symbols of all languages."""
    pad = [0] * 3
    seq = lambda t: pad + list(langid._padded([t])[0][3:])
    top = Counter()
    for t in train:
        s = seq(t)
        top.update(tuple(s[i - 3:i + 1]) for i in range(3, len(s)))
    levels = {4: top}
    for k in (3, 2, 1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    vocab = vocab or len(levels[1])

    def p(g):
        k = len(g)
        c = levels[k]
        d = langid._discount(np.array(list(c.values())))
        if k == 1:
            total = sum(c.values())
            return max(c[g] - d, 0) / total * (g in c) + d * len(c) / total / (vocab + 1)
        inside = {x: n for x, n in c.items() if x[:-1] == g[:-1]}
        if not inside:
            return p(g[1:])
        total = sum(inside.values())
        return max(c[g] - d, 0) / total * (g in c) + d * len(inside) / total * p(g[1:])
    s = seq(text)
    return -sum(log(p(tuple(s[i - 3:i + 1]))) for i in range(3, len(s))) / (len(s) - 3)


def test_cross_entropy_matches_brute_force():
    train = {"de": [DE, "und so weiter"], "en": [EN, "and so on"]}
    rows = defaultdict(int)
    for l, texts in enumerate(train.values()):
        for t in texts:
            s = langid._padded([t])[0]
            for i in range(3, len(s)):
                rows[(l, *s[i - 3:i + 1])] += 1
    keys = np.array(list(rows))
    m = langid.kneser_ney(list(train), keys[:, 1:].astype(np.uint32), keys[:, 0], np.array(list(rows.values())))
    vocab = len(set(langid._padded(train["de"] + train["en"])[0]))
    for text in (EN, DE, "the house", "zzz qq katze", "x"):
        h, n = m.cross_entropy([text, None, "123 !"])
        assert n[1] == n[2] == 0
        for l, texts in enumerate(train.values()):
            assert h[0, l] == pytest.approx(brute_entropy(texts, text, vocab), rel=1e-4)


def test_single_language_equals_brute_force():
    s = langid._padded([EN])[0]
    rows = Counter(tuple(s[i - 3:i + 1]) for i in range(3, len(s)))
    keys = np.array(list(rows))
    m = langid.kneser_ney(["en"], keys.astype(np.uint32), np.zeros(len(keys), int), np.array(list(rows.values())))
    for text in (EN, "the house was cold", "zebra qualm", "x"):
        assert m.cross_entropy([text])[0][0, 0] == pytest.approx(brute_entropy([EN], text), rel=1e-4)


def test_hash_table_finds_all():
    h = np.unique(np.random.default_rng(0).integers(0, 2 ** 64 - 2, 5000, dtype=np.uint64))
    t = langid.HashTable(h)
    assert (t.find(h) == np.arange(len(h))).all()
    assert (t.find(h[:-1] + np.uint64(1))[h[1:] != h[:-1] + np.uint64(1)] == -1).all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op1_language_id"](spark, sf)
    truth = spark.read.parquet(sf + "/documents.parquet").select("doc_id", "lang")
    rows = got.join(truth, "doc_id").collect()
    assert len(rows) == truth.count()
    out = [r for r in rows if r.held_out]
    assert len(out) > 150 and np.mean([r.lang_pred == r.lang for r in out]) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([r.rejected for r in rows]) < 0.002


def test_edges(spark):
    rows = [(1, EN, "en", 0.5), (2, DE, "de", 0.5), (3, None, "de", 0.5), (4, "12 34 !", "en", None),
            (5, "", None, None), (6, EN * 300, None, 1.0), (7, EN, "en", 0.0), (7, EN, "en", 0.0)]
    rows += [(10 + i, EN[i:], "en", 0.0) for i in range(30)] + [(60 + i, DE[i:], "de", 0.0) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    m = langid.fit(df)
    got = {r.doc_id: r for r in langid.identify(df, m).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[5].lang_pred == "und" and got[3].score == 0
    assert got[6].lang_pred == "en" and got[2].lang_pred == "de" and not got[6].rejected and got[5].rejected
    assert m.judge(["qxz jjkwq vvxq zzqj kqxj " * 40])[2][0]
    assert langid.identify(df.limit(0), m).count() == 0
    none = langid.fit(df.limit(0))
    assert {r.lang_pred for r in langid.identify(df, none).collect()} == {"und"}


def calibrated(rows, langs=3):
    """Limits from ``(language, symbols, own cross-entropy, others')`` rows."""
    m = langid.Model([str(i) for i in range(langs)], [], [], [], np.zeros(langs))
    h = np.array([[own if l == i else other for i in range(langs)] for l, _, own, other in rows])
    return langid._calibrated(m, np.array([r[0] for r in rows]), np.array([r[1] for r in rows]), h)


def beyond(m, lang, n, h):
    return bool(h - m.mean[lang] > m.limit[lang] * m._sd(np.array([lang]), np.array([n]))[0])


def test_wrong_and_odd_rows_do_not_switch_rejection_off():
    r = np.random.default_rng(5)
    clean = [(l, 1000, 2.0 + l / 10 + r.normal() * 0.03, 4.0) for l in (0, 1) for _ in range(150)]
    wrong = [(0, 1000, 5.0, 2.1)] * 3 + [(1, 1000, 4.5, 4.8)] * 4  # another language's texts; odd ones
    for rows in (clean, clean + wrong):
        m = calibrated(rows)
        assert beyond(m, 0, 1000, 3.9) and beyond(m, 1, 1000, 3.9)
        assert not any(beyond(m, l, n, own) for l, n, own, _ in clean)


def test_a_language_of_few_held_back_rows_rejects():
    r = np.random.default_rng(6)
    clean = [(l, 1000, 2.0 + r.normal() * 0.03, 4.0) for l in (0, 1) for _ in range(100)]
    m = calibrated(clean + [(2, 1000, 2.2, 4.0)])
    assert beyond(m, 2, 1000, 4.0) and not beyond(m, 2, 1000, 2.3)
    m = calibrated(clean)  # none at all
    assert beyond(m, 2, 1000, 4.0) and not beyond(m, 2, 1000, 2.1)


def _counts(monkeypatch):
    seen = []
    real = langid.kneser_ney
    monkeypatch.setattr(langid, "kneser_ney", lambda *a: seen.append(a) or real(*a))
    return seen


def test_all_texts_are_counted_copies_once(spark, monkeypatch):
    monkeypatch.setattr(langid, "HOLD", 50)
    monkeypatch.setattr(langid, "CHUNK", 64)
    monkeypatch.setattr(langid, "MAX_HELD", 0)
    r = np.random.default_rng(7)
    word = lambda: "".join(r.choice(list("abcdeöñ"), 5))
    texts = [" ".join(word() for _ in range(30)) for _ in range(200)] + [("lange rede " * 110_000).strip()]
    rows = [(t, "xx" if i % 2 else "yy") for i, t in enumerate(texts)]
    seen = _counts(monkeypatch)
    langid.fit(spark.createDataFrame(rows + rows[:50], "text string, lang string"))
    langs, grams, lang_of, n = seen[0]
    want = Counter()
    for t, l in rows:
        s = langid._padded([t])[0]
        w = np.lib.stride_tricks.sliding_window_view(s, 4)
        g, c = np.unique(w, axis=0, return_counts=True)
        want.update({(l, *map(int, x)): int(k) for x, k in zip(g, c)})
    assert {(langs[l], *map(int, g)): int(k) for l, g, k in zip(lang_of, grams, n)} == dict(want)


def test_every_language_is_learned_and_rare_grams_go_first(spark, monkeypatch):
    seen = _counts(monkeypatch)
    rows = [(EN[i:], "en") for i in range(40)] + [(f"{DE} {k}" * 9000, l) for k, l in enumerate("abcdefgh")] + [("123", "none")]
    m = langid.fit(spark.createDataFrame(rows, "text string, lang string"), max_grams=40)
    assert m.langs == sorted([*"abcdefgh", "en"])
    langs, _, lang_of, n = seen[0]
    assert np.bincount(lang_of).max() <= 60 and n[lang_of == m.langs.index("en")].min() > 20


def test_statistics_and_limits_come_from_all_texts(spark, monkeypatch):
    limits, levels = [], []
    real, built = langid._limited, langid._interpolated
    monkeypatch.setattr(langid, "_limited", lambda m, *a: limits.append(a) or real(m, *a))
    monkeypatch.setattr(langid, "_interpolated", lambda *a: levels.append(a) or built(*a))
    texts = [(t[i:], l) for t, l in ((EN, "en"), (DE, "de")) for i in range(40)]
    langid.fit(spark.createDataFrame(texts + texts[:9], "text string, lang string"), max_grams=60)
    assert limits[0][3].sum() == len(texts)  # each sets limits, copies once
    langs, of_order = levels[1]  # of the kept n-grams, by all
    for name, own in zip(langs, of_order):
        every = Counter()
        for t, l in texts:
            s = langid._padded([t])[0] if l == name else []
            every.update(tuple(map(int, s[i - 3:i + 1])) for i in range(3, len(s)))
        for k in (4, 3, 2, 1):
            every = Counter(g[1:] for g in every) if k < 4 else every
            at = own[k - 1]
            assert {tuple(map(int, g)): c for g, c in zip(at.grams, at.counts)}.items() <= every.items()
            mass = Counter()
            for g, c in every.items():
                mass[g[:-1]] += c
            assert {tuple(map(int, g)): c for g, c in zip(at.contexts, at.mass)}.items() <= mass.items()
            assert at.discount == langid._discount(np.array(list(every.values())))
            if k == 4:  # those of largest counts, not some of equal ones
                assert 0 < len(at.grams) <= 60 < len(every)
                assert min(at.counts) > max(c for g, c in every.items() if g not in set(map(tuple, at.grams.tolist())))


def test_quantiles_of_rows_that_stand_for_many():
    r = np.random.default_rng(8)
    for size in (1, 2, 5, 30):
        x, rows = r.normal(size=size).round(1), r.integers(1, 5, size)
        every = np.repeat(x, rows)
        assert langid._quantile(x, rows, 0.5) == pytest.approx(np.median(every))
        assert langid._quantile(x, rows, 0.95) == np.quantile(every, 0.95, method="lower")
