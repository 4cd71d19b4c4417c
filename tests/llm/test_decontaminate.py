import random

import pytest

import __spark_entry__ as entry
from tessera.llm import decontaminate as dec

ITEM = "A train leaves Boston at 9 and travels 120 km before it meets John who carried 9 apples to the station."
LONG = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
ITEMS = [(1, ITEM), (2, LONG), (3, "small whole item"), (4, None), (5, ""), (6, "9 12 14 Bob Ann 77 km 3 5 6 8 9"),
         (7, LONG), (None, "this item has no id but many ordinary words in it you see")]


def contaminated(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, th string")
    it = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = dec.report(df, it, **kw).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    kept = {r.doc_id for r in dec.drop_contaminated(df, it, **kw).collect()}
    assert kept == {r.doc_id for r in rows if not r.contaminated}
    return [(r.item_id if r.contaminated else 0) for r in rows]


def test_cases(spark):
    new = ITEM.replace("Boston", "Denver").replace("John", "Mary").replace("120 km", "75 miles").replace("9", "4")
    cut = " ".join(LONG.split()[:12])
    got = contaminated(spark, [
        "Some words. " + ITEM + " More words.",       # verbatim
        "x y z. " + new,                              # re-parameterised: 9 becomes 4 in both places
        "x. " + new.replace("carried 4", "carried 5"),  # 9 becomes 4 and 5: not one to one
        "noise " + LONG.upper() + "!",                # case and punctuation
        cut,                                          # 12 of 19 words: under COVERED
        " ".join(LONG.split()[2:15]),                 # 13 words
        "a small whole item b", "small whole", None, "", "1 2 3 Tom Tim 4 km 5 6 7 8 9",
        "word " * 30_000 + ITEM, "this item has no id but many ordinary words in it you see"])
    assert got == [1, 1, 0, 0, 0, 2, 3, 0, 0, 0, 0, 1, None] or got[3] in (0, 2)
    assert got[:3] == [1, 1, 0] and got[4:] == [0, 2, 3, 0, 0, 0, 0, 1, None]


def test_repeated_rows_null_ids_empty_tables(spark):
    df = spark.createDataFrame([(None, "zz. " + LONG), (None, "clean words here"), (3, LONG), (3, LONG)], "doc_id long, text string")
    it = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert [r.text for r in dec.drop_contaminated(df, it).collect()] == ["clean words here"]
    assert sorted((r.contaminated, r.n_items) for r in dec.report(df, it).collect()) == [(False, 0)] + [(True, 2)] * 3
    assert dec.report(df.limit(0), it).count() == 0 and dec.drop_contaminated(df, it.limit(0)).count() == 4


def brute(docs, items):
    """Longest consistent run of equal template words over all pairs."""
    bench = {i: [x.tolist() for x in dec.template(t)] for i, t in items}
    out = {}
    for d, t in docs:
        h, v, k = (x.tolist() for x in dec.template(t))
        found = set()
        for i, (ih, iv, ik) in bench.items():
            n = min(dec.WINDOW, len(ih))
            for diag in range(-len(ih) + 1, len(h)):
                pos = [p for p in range(len(ih) - n + 1) if 0 <= p + diag <= len(h) - n
                       and ih[p:p + n] == h[p + diag:p + diag + n] and ik[p:p + n].count(0) >= dec.LEAST_LITERALS]
                words = {q for p in pos for q in range(p, p + n)}
                vals = {(iv[q], v[q + diag]) for q in words if iv[q]}
                if pos and len(words) >= min(dec.COVERED, len(ih)) and len({a for a, _ in vals}) == len({b for _, b in vals}) == len(vals):
                    found.add(i)
        out[d] = found
    return out


def test_template_beyond_the_word_table(monkeypatch):
    text = ITEM + " " + LONG + ". He paid $5.50 for 3 kg, Mary said. Then 7km on."
    want = [x.tolist() for x in dec.template(text)]
    monkeypatch.setattr(dec.Words, "most", 5)
    monkeypatch.setattr(dec, "_WORDS", dec.Words())
    for _ in range(2):
        assert [x.tolist() for x in dec.template(text)] == want
    kinds = dict(zip(text.split(), want[2]))
    assert kinds["$5.50"] == kinds["3"] == kinds["7km"] == dec.NUM and kinds["kg,"] == dec.UNIT and kinds["Mary"] == dec.NAME
    assert kinds["A"] == kinds["He"] == kinds["Then"] == dec.LITERAL


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    r = random.Random(seed)
    vocab = ["ab", "cd", "ef", "gh", "ij", "Kim", "Lee", "5", "7", "km", "end."]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.choice([3, 5, 8, 12, 25]))) for i in range(12)]
    docs = []
    for d in range(150):
        i = items[r.randrange(12)][1].split()
        part = i[r.randrange(2):len(i) - r.randrange(2)]
        part = [r.choice(["5", "7"]) if w in "57" and r.random() < 0.05 else w for w in part]
        docs.append((d, text(r.randrange(20)) + " " + " ".join(part) + " " + text(r.randrange(10))))
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {d: set() for d, _ in docs}
    for m in dec.matches(df, it).collect():
        got[m.id].add(m.item)
    want = brute(docs, items)
    assert got == want and sum(map(len, want.values())) > 20


def test_query_finds_whole_items(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: " " + " ".join((r.text or "").lower().split()) + " " for r in spark.read.parquet(sf + "/documents.parquet").collect()}
    items = [" " + " ".join(r.text.lower().split()) + " " for r in spark.read.parquet(sf + "/benchmark.parquet").collect()]
    want = {d for d, t in docs.items() if any(i in t for i in items)}
    got = {r.doc_id for r in entry.queries()["op9_decontamination"](spark, sf).collect() if r.contaminated}
    assert want <= got and len(got - want) <= len(docs) // 200


def leaks(spark, items, texts):
    it = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {d: set() for d in range(len(texts))}
    for m in dec.contained(df, it).collect():
        got[m.id].add(m.item)
    flagged = {r.doc_id for r in dec.report(df, it).collect() if r.contaminated}
    assert flagged == {d for d in got if got[d]} == set(got) - {r.doc_id for r in dec.drop_contaminated(df, it).collect()}
    return [got[d] for d in range(len(texts))]


def test_one_conflict_does_not_hide_an_equal_run(spark):
    w = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(50)]
    w[5], w[45] = "9", "9"
    slots = "the red box holds 3 stones while the blue box holds 8 stones and nothing else here"
    assert leaks(spark, [" ".join(w), slots], [
        "zz " + " ".join(w[:45] + ["5"] + w[46:]),             # 44 equal words before the conflict
        slots.replace("3", "4").replace("8", "4"),             # two slots, the same new value
        " ".join(w[6:18]) + " zz " + " ".join(w[20:32])]       # two runs of 12
    ) == [{0}, {1}, set()]


def test_copies_up_to_case_and_punctuation(spark):
    named = " ".join(f"{a} went to {b} for tea." for a, b in [("Anna", "Bo"), ("Carl", "Dan"), ("Eve", "Finn"), ("Gus", "Hal")])
    short = "Paris is the capital of France today"
    assert leaks(spark, [named, short, "The self-made man's house – built in 1,000 B.C. – stands on sand and still holds out"], [
        named.lower(), named.upper(), named.title(), named.replace(".", ""), "see\n" + short, "the word " + short.upper() + "?!",
        "The selfmade mans house built in 1,000 BC stands on sand and still holds out", "Paris is the capital of no land today"]
    ) == [{0}] * 4 + [{1}, {1}, {2}, set()]


def test_items_with_few_literals(spark):
    items = ["12 + 7 = 19", "Bob 3 kg Ann 4 kg Tom 5 km 6 7 8 9 10 11 12", "Xylograph", "two words"]
    assert leaks(spark, items, [
        "so 12 + 7 = 19 holds", "so 12 + 7 = 18 holds", "x " + items[1].lower() + " y", items[1].replace("5", "6"),
        "a xylograph, a xylograph", "Two words!", "two other words", "12", "..."]
    ) == [{0}, set(), {1}, set(), {2}, {3}, set(), set(), set()]


def folded(text):
    return [w for w in (dec.bare(x, x.strip(dec._EDGE)) for x in (text or "").split()) if w]


@pytest.mark.parametrize("seed", [3, 4])
def test_contained_matches_brute_force(spark, seed, monkeypatch):
    """Equal runs against a search of all sub-runs, texts cut into small parts."""
    monkeypatch.setattr(dec, "SOME_WORDS", 30)
    r = random.Random(seed)
    vocab = ["ab", "cd", "Ef", "Kim", "5", "7", "km", "end.", "-"]
    text = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    items = [(i, text(r.choice([1, 2, 5, 9, 13, 14, 30]))) for i in range(12)]
    docs = []
    for d in range(120):
        i = items[r.randrange(12)][1].split()
        part = [r.choice(vocab) if r.random() < 0.04 else w.upper() if r.random() < 0.3 else w for w in i[r.randrange(2):]]
        docs.append((d, text(r.randrange(20)) + " " + " ".join(part) + " " + text(r.randrange(10))))
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {d: {} for d, _ in docs}
    for m in dec.contained(df, it).collect():
        got[m.id][m.item] = m.covered
    templates, n = brute(docs, items), 0
    for d, t in docs:
        a = folded(t)
        for i, u in items:
            b = folded(u)
            best = max((k for p in range(len(b)) for q in range(len(a)) for k in [next(
                (k for k in range(len(b)) if p + k >= len(b) or q + k >= len(a) or b[p + k] != a[q + k]), len(b))]), default=0)
            if b and best >= min(dec.COVERED, len(b)):
                assert got[d].get(i, 0) >= best, (t, u)
                n += 1
            elif i not in templates[d] and i in got[d]:  # the template, two values becoming one
                assert got[d][i] >= min(dec.COVERED, len(u.split()))
    assert n > 40 and all(templates[d] <= set(got[d]) for d in got)
