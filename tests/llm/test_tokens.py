import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tessera.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOK.encode(text or "", add_special_tokens=False).ids + [0]


@given(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 300) | st.sampled_from([255, 256, 65535, 65536, 2 ** 24])))
@settings(max_examples=200, deadline=None)
def test_coding_round_trip(ranks):
    r = np.array(ranks, "<u4")
    control, data = tokens.encode_ranks(r)
    assert len(control) == -(-len(r) // 4)
    assert (tokens.decode_ranks(control, data, len(r)) == r).all()


def test_pieces_equal_whole_text():
    r = random.Random(5)
    parts = ["a", "Wort", "é", " ", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "12", "!?", ".", ",", "'s", "<|endoftext|>", "don't",
             "\r\n", "🙂", "\u3000x", "", "5.", "x.y", "\x1c", "\x85"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(14))) for _ in range(6000)]
    for most in (10 ** 6, 50):
        p = tokens.Pieces(TOK, "<u4")
        p.most = most
        for i in range(0, len(texts), 100):
            for t, ids in zip(texts[i:i + 100], p.ids(texts[i:i + 100])):
                assert np.frombuffer(ids, "<u4").tolist() == TOK.encode(t, add_special_tokens=False).ids, repr(t)


def brute(rows):
    out, at = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, len(ids_of(r[1])))):
        ids = np.array(ids_of(t), "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_files_round_trip(spark, tmp_path):
    rows = [(4, "Hello  world\n"), (2, None), (9, ""), (None, "x"), (7, "word " * 30_000), (5, "Ünïcode 🙂"), (5, "Ünïcode 🙂")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "1 AS n_tokens", "2 AS ids")
    path = str(tmp_path / "t")
    tokens.write_tokens(df, path, PATH)
    got = tokens.digest(spark, path).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == brute(rows)
    back = {(r.doc_id, r.start): np.frombuffer(r.ids, "<u4").tolist() for r in tokens.read_tokens(spark, path).collect()}
    assert all(back[i, s] == ids_of(t) for (i, s, *_), t in
               zip(brute(rows), [t for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, len(ids_of(r[1]))))]))
    ranks = spark.read.parquet(path + "/ranks").orderBy("rank").collect()
    assert [r.n for r in ranks] == sorted((r.n for r in ranks), reverse=True)
    files = spark.read.parquet(path + "/tokens").orderBy("part", "row").collect()
    assert [r.doc_id for r in files] == [None, 2, 4, 5, 5, 7, 9]


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    tokens.write_tokens(df, str(tmp_path / "t"), PATH)
    assert tokens.digest(spark, str(tmp_path / "t")).count() == 0


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(sf + "/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op3_token_ids"](spark, sf).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == brute(rows)


def test_pieces_are_shared_across_line_ends_and_punctuation():
    p = tokens.Pieces(TOK, "<u2")
    texts = ["a one.\ntwo three", "a one$$$\ntwo three", "\ntwo\nthree.", "a one.\n\ntwo", "a one. \ntwo", "one.\n"]
    assert p.ids(texts) == p.encode(texts)
    # each line's first word and each word before a line end is its own piece
    assert {"one.", "one$$$", "one", "\ntwo", "three"} <= set(p)
    assert not {"one.\ntwo", "one$$$\ntwo"} & set(p)


def test_odd_white_space_is_told_as_by_the_pattern():
    r = np.random.default_rng(3)
    signs = list("ab.é \n  \n\t\r\x0b\x1c\x85\xa0    　")
    for size in (0, 1, 2, 3, 6, 9):
        for _ in range(400):
            t = "".join(r.choice(signs[:9] if r.random() < 0.6 else signs, size))
            assert tokens._odd(t) == bool(tokens._ODD.search(t)), repr(t)
    p = tokens.Pieces(TOK, "<u2")
    texts = ["one\ttwo three", "one\xa0two three four", "one two　", " one  two", "eins zwölf\ndrei\x85vier"]
    assert p.ids(texts) == p.encode(texts)


def test_a_piece_is_looked_up_once_a_batch():
    class Counted(tokens.Pieces):
        looked_up = 0

        def get(self, *a):
            self.looked_up += 1
            return super().get(*a)

        def __getitem__(self, key):
            self.looked_up += 1
            return super().__getitem__(key)

    p = Counted(TOK, "<u2")
    texts = [" ".join(["one", "two", "three", "four\nfive"] * 25), "", "six  seven two", "one"] * 50
    for _ in range(2):
        assert p.ids(texts) == p.encode(texts)
    assert p.looked_up < 40  # 100 words in 50 texts, twice
    ids, n = p.joined([])
    assert len(ids) == len(n) == 0


def test_coding_of_many_rows_is_that_of_each_row():
    r = np.random.default_rng(8)
    rows = [r.integers(0, 1 << r.choice([3, 8, 12, 20, 32]), n, dtype=np.uint32) for n in r.integers(0, 9, 300)]
    edge = np.r_[0, np.cumsum([len(x) for x in rows])]
    control, at, data, to = tokens.encode_rows(np.concatenate(rows), edge)
    for i, x in enumerate(rows):
        c, d = tokens.encode_ranks(x)
        assert control[at[i]:at[i + 1]].tobytes() == c and data[to[i]:to[i + 1]].tobytes() == d
    assert (tokens.decode_rows(control, data, edge) == np.concatenate(rows)).all()
    column = pa.array([x.tobytes() for x in rows], pa.binary())
    values, cut = tokens._values(column.slice(100, 50), "<u4")
    assert (values == np.concatenate(rows[100:150])).all() and (cut == edge[100:151] - edge[100]).all()
    assert tokens._binary(np.concatenate(rows), edge * 4).equals(column)
