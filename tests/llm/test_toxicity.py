import numpy as np

import __spark_entry__ as entry
from tessera.llm import toxicity as tox
from tessera.llm.base import shingle_set


def test_label_model_recovers_rates_and_correlation():
    r = np.random.default_rng(0)
    n = 40_000
    y = r.random(n) < 0.15
    votes = np.stack([np.where(y, r.random(n) < a, r.random(n) < b) for a, b in
                      ((0.8, 0.02), (0.7, 0.01), (0.6, 0.03), (0.5, 0.01), (0.4, 0.02))] + [np.zeros(n, bool)], 1).astype(int)
    votes[:, 5] = np.where(r.random(n) < 0.9, votes[:, 4], 0)  # a voter that copies another
    pat, count = np.unique(votes, axis=0, return_counts=True)
    m = tox.fit_label_model(pat, count.astype(float), 0.1)
    assert abs(m.prior - 0.15) < 0.02
    assert {4, 5} in [set(k) for k in m.correlation]
    truth = m.posterior(votes) > 0.5
    assert np.mean(truth == y) > 0.97


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = entry.queries()["op2_toxicity"](spark, sf)
    n = spark.read.parquet(sf + "/documents.parquet").count()
    rows = got.join(spark.read.parquet(sf + "/labels.parquet"), "doc_id").collect()
    assert got.count() == n
    out = [r for r in rows if r.held_out]
    pos = [r for r in out if r.toxic]
    assert np.mean([r.predicted for r in pos]) > 0.85
    assert np.mean([r.predicted for r in out if not r.toxic]) < 0.01
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)


def test_edges(spark):
    clean = ["the meadow was green and quiet", "we walked along the river", "bread and cheese for lunch", "rain fell on the roof"]
    rows = [(i, clean[i % 4] + f" n{chr(97 + i % 26)}{chr(97 + i // 26)}x" + (" you idiot" if i % 5 == 0 else ""), 0) for i in range(60)]
    rows += [(100, None, 1), (101, "", 1), (None, "what an IDIOT!", 1), (102, "idiot " * 40_000, 1), (102, "calm", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    lab = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(60)] + [(None, 1), (3, None), (100, 1)], "doc_id long, toxic int")
    for m in (tox.fit(df, lab), tox.DEFAULT, tox.fit(df.limit(0), lab.limit(0))):
        got = tox.score(df, m).collect()
        assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "text", "score", "predicted"}
        by = {r.text: r for r in got}
        assert by["what an IDIOT!"].predicted == 1 and by[None].score == by[""].score < 0.5 and by["calm"].predicted == 0
        assert by["idiot " * 40_000].predicted == 1
    assert tox.score(df.limit(0), tox.DEFAULT).count() == 0


def test_label_model_sees_every_text(spark):
    """Votes counted in plain Python over all texts give the same label model,
    a voter that fires in 3 of 20,000 texts included; copies count once."""
    r = np.random.default_rng(5)
    words = np.array([a + b + c for a in "bdfgklmnprst" for b in "aeiou" for c in "lmnrst"])
    rows = []
    for i in range(20_000):
        text = " ".join(r.choice(words, 9))
        if i % 25 == 0:
            text += " you are a stupid idiot"
        elif i % 40 == 1:
            text += " what a stupid idea"
        if i in (100, 5_000, 15_000):
            text += " i will destroy you"
        rows.append((i, text))
    texts = [t for _, t in rows]
    rows += [(50_000 + k, texts[0]) for k in range(2_000)]  # a hot group of copies
    marks = [(i, int(i % 25 == 0)) for i in range(0, 20_000, 7)]
    model = tox.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(8),
                    spark.createDataFrame(marks, "doc_id long, toxic int"))
    threat = model.voters.index("threat")
    got = model.labels.rate[:, threat]
    assert got.max() > 2e-3  # 3 of some 800 toxic texts; the smoothing alone would give 0.05 / 800
    # all texts differ but for the copies, so each has a signature of its own
    mined = [f for f in model.voters if f.startswith("mined")]
    assert len(mined) == tox.MINED_VOTERS
    assert abs(model.labels.prior - 800 / 20_000) < 0.01


def test_votes_and_signatures():
    v = tox.Voters(["0:=zorgle", "1:4zorg"])
    at = {n: i for i, n in enumerate(v.names)}
    fires = lambda text: {n for n in at if v.mask(text) >> at[n] & 1}
    assert fires("You are an IDIOT") == {"insult", "you_are"}
    assert fires("shut up") == {"silence"} and fires("we will find them") == {"threat"}
    assert fires("LOOK HERE OVER THERE NOWW THATS") == {"shouting"} and fires("no!!!!") == {"shouting"}
    assert fires("zorgle") == {"mined_0"} and fires("zorgles zorgon") == {"mined_1"} and fires("") == set()
    long = " ".join(f"w{i}" for i in range(500))
    assert tox._signature(long) == tox._signature(long) != tox._signature(long[::-1])
    assert tox._signature("") == tox._signature(None) == 0
    words, at = np.zeros(tox.Marked.bits // 32, np.uint32), tox.Marked.at("=idiot")
    words[at >> 5] |= np.uint32(1 << (at & 31))
    marked = tox.Marked(words)
    assert "=idiot" in marked and "=other" not in marked


def test_telling_features_match_brute_force(spark):
    """The pruned counts choose the features that counting everything chooses."""
    r = np.random.default_rng(9)
    vocab = [a + b + c for a in "bdfglmnprst" for b in "aeiou" for c in "mnrst"]
    pos = [" ".join(r.choice(vocab, 12)) + (" zorgle" if i % 2 else " grumph") + (" mixed" if i % 3 else "") for i in range(60)]
    neg = [" ".join(r.choice(vocab, 12)) + (" mixed" if i % 3 else "") + (" grumph" if i % 40 == 0 else "") for i in range(600)]

    def rows_with(texts):
        n = {}
        for t in texts:
            ws, c = tox.word_set(t), {}
            for w in ws:
                for f in tox.features(w):
                    c[f] = c.get(f, 0) + 1
            for f in tox.leveled(c, len(ws)):
                n[f] = n.get(f, 0) + 1
        return n

    p, q = rows_with(pos), rows_with(neg)
    share, least, want = 60 / 660, 2 * np.log(len(p)) + 6, set()
    for f, a in p.items():
        b = q.get(f, 0)
        s = a / (a + b)
        if s >= 0.5:
            ratio = 2 * (a * np.log(s / share) + (b * np.log((1 - s) / (1 - share)) if b else 0))
            want |= {f} if ratio >= least else set()
    frame = lambda texts: spark.createDataFrame([(t,) for t in texts], "text string")
    got = tox._telling_features(frame(pos), frame(neg), 60, 600)
    assert set(got) == want and "0:=zorgle" in want and "0:=grumph" in want and "0:=mixed" not in want


def test_shouting_is_sought_only_where_it_may_be():
    v, bit, sought = tox.Voters([]), 1 << (len(tox.LEXICONS) + 3), []
    whole = v.patterns[3]
    v.patterns[3] = type("P", (), {"search": lambda self, t: sought.append(t) or whole.search(t)})()
    shouts = ["hey!!!!", "WHAT WERE THEY DOING ", "x ABCD EFGH, IJKL\nMNOP?"]
    others = ["Quiet, Mild Words. " * 50, "hey!!!", "", "ABC DEF GHI JKL ", "WHAT WERE they DOING THERE"]
    assert [bool(v.mask(t) & bit) for t in shouts + others] == [True] * 3 + [False] * 5
    assert sought == shouts + others[-1:]


def test_signature_of_repeated_words():
    sets = lambda t: [tox.mix(shingle_set(t, 3) ^ np.uint64(k * 77 + 1)).min() for k in range(3)]
    for t in ("a", "a b", "a b c", "a b c " * 40, "x y z w " * 7 + "a"):
        assert tox._signature(t) == int(tox.windows(np.array(sets(t)), 3)[0] >> np.uint64(1))
    assert tox._signature(None) == tox._signature(" ") == 0
