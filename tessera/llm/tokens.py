"""Token ids in frequency-ranked, byte-aligned variable-length coding.

The most frequent token of the corpus gets rank 0, so most ranks fit one
byte.  A document's ranks are stored as two byte strings: control bytes, with
two bits per rank for its number of bytes (four ranks a control byte, padded
with zeros), and the ranks' low bytes, little-endian, one after the other.
Decoding looks the lengths up in a table of all 256 control bytes and the
ids up in the rank table.

File format: a folder with ``ranks`` (rank, id, n) and ``tokens``, Parquet
files of one row per document (doc_id, n_tokens, control, data, part, row)
in ascending doc_id order: by ``part``, then ``row``.  Spark's committer
writes them, so that a lost executor leaves no broken file, in any store.
"""

from __future__ import annotations

import os
import re
import string
import uuid
import zlib
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.base import per_batch
from tessera.session import delete_at_exit, checkpoint_dir

#: Bytes of each of the four ranks that a control byte describes.
LENGTHS = 1 + (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8)
_BYTE = np.arange(4, dtype=np.uint8)


def _padded(edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of ranks that begin and end at ``edge``: where each rank lies
    if every row is filled up to a multiple of four, and the edges there."""
    n = np.diff(edge)
    padded = np.r_[0, np.cumsum(-(-n // 4) * 4)]
    return np.arange(edge[0], edge[-1]) + np.repeat(padded[:-1] - edge[:-1], n), padded


def encode_rows(ranks: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes of all rows, their edges, data bytes and their edges; row
    ``i`` has the ranks (below 2 ** 32) from ``edge[i]`` to ``edge[i + 1]``,
    ``edge[0]`` being 0."""
    r = np.ascontiguousarray(ranks, "<u4")
    more = (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    at, padded = _padded(edge)
    bits = np.zeros(padded[-1], np.uint8)
    bits[at] = more
    control = bits[0::4] | bits[1::4] << 2 | bits[2::4] << 4 | bits[3::4] << 6
    data = r.view(np.uint8).reshape(-1, 4)[_BYTE <= more[:, None]]
    return control, padded // 4, data, np.r_[0, np.cumsum(more, dtype=np.int64) + np.arange(1, len(r) + 1)][edge]


def decode_rows(control: np.ndarray, data: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """The ranks of rows that :func:`encode_rows` has coded, by table lookup of
    the control bytes."""
    lengths = LENGTHS[control].reshape(-1)[_padded(edge)[0]]
    out = np.zeros((len(lengths), 4), np.uint8)
    out[_BYTE < lengths[:, None]] = data
    return out.view("<u4").reshape(-1)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below 2 ** 32."""
    control, _, data, _ = encode_rows(ranks, np.array([0, len(ranks)]))
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks, by table lookup of the control bytes."""
    return decode_rows(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), np.array([0, n]))


def _binary(values: np.ndarray, edge: np.ndarray) -> pa.Array:
    """Byte strings that lie one after the other, between byte positions."""
    if edge[-1] >= 1 << 31:  # beyond what one Arrow array holds
        raise ValueError("the rows of a slice have more than 2 GB of ids")
    return pa.BinaryArray.from_buffers(pa.binary(), len(edge) - 1, [
        None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def _values(column: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in byte strings without nulls and the edges of the rows."""
    dtype, column = np.dtype(dtype), column.cast(pa.binary())
    if not len(column):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    _, edge, data = column.buffers()
    edge = np.frombuffer(edge, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    size = edge[-1] - edge[0]
    values = np.frombuffer(data, dtype, size // dtype.itemsize, edge[0]) if size else np.zeros(0, dtype)
    return values, (edge - edge[0]) // dtype.itemsize


#: A blank that another character than white space follows; a blank or line
#: end that none follows, or a line end behind white space.
_BLANK, _ODD = re.compile(r" (?=\S)"), re.compile(r"[ \n](?=\s|$)|(?<=\s)\n")
_SPACE = re.compile(r"\s")
#: White space besides blanks and line ends, within and beyond ASCII.
_RARE = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
_RARER = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200b)))
_PUNCTUATION = string.punctuation


def _odd(text: str) -> bool:
    """Whether ``_ODD`` is in the text.  Without other white space that takes
    two blanks or line ends in a row or one at the end, which plain searches
    tell sooner."""
    if any([c in text for c in _RARE]) or not text.isascii() and any([c in text for c in _RARER]):
        return _ODD.search(text) is not None
    return "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text.endswith((" ", "\n"))


class Pieces(dict):
    """Ids (as bytes) of the pieces of texts between single blanks or line
    ends, each with the blank (left out in the key) or line end before it.

    The tokenizer's pre-tokenizer begins a new token at a blank that is
    followed by another character than white space, at a line end between two
    such characters, and between a letter and punctuation, whatever stands
    before or behind.  So a text's ids are those
    of its pieces in order, and each distinct piece is encoded once.  ``most``
    bounds the memory; when it is full, new pieces are not remembered."""

    most = 1_000_000

    def __init__(self, tokenizer, dtype: str):
        self.tokenizer, self.dtype = tokenizer, dtype
        # contractions begin with an apostrophe; added tokens are found before all others
        kept = "'" + "".join(t.content for t in tokenizer.get_added_tokens_decoder().values())
        self.punctuation = "".join(c for c in _PUNCTUATION if c not in kept)
        vocabulary = tokenizer.get_vocab()
        self.starts = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # tokens that begin with a blank
        self.starts[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.lines = np.zeros(len(self.starts), bool)  # a line end alone
        self.lines[[i for t, i in vocabulary.items() if t == "Ċ"]] = True

    def encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word behind a blank, or behind the line end that it
        begins with.  Many words are encoded as one text, whose ids are cut
        where a token begins with a blank or is a line end; words with other
        white space inside go one by one."""
        out: dict[str, bytes] = {}
        for sep, starts in (" ", self.starts), ("\n", self.lines):
            cut = 0 if sep == " " else 1
            plain = [w for w in words if (w[:1] == "\n") == cut and len(w) > cut]
            # all at once: most often no word has white space inside
            if _SPACE.search("".join([w[cut:] for w in plain])):
                plain = [w for w in plain if not _SPACE.search(w, cut)]
            runs = [plain[i:i + 500] for i in range(0, len(plain), 500)]
            texts = ["".join([sep + w for w in r]) if not cut else "".join(r) for r in runs]
            coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            for r, e in zip(runs, coded):
                ids = np.array(e.ids, self.dtype)
                at = np.flatnonzero(starts[ids])
                if len(at) == len(r) and at[0] == 0:
                    raw, width = ids.tobytes(), ids.itemsize
                    edge = [*(at * width).tolist(), len(raw)]
                    out.update(zip(r, [raw[a:b] for a, b in zip(edge, edge[1:])]))
        rest = [w for w in words if w not in out]
        out.update(zip(rest, self.encode([w if w[:1] == "\n" else " " + w for w in rest])))
        return [out[w] for w in words]

    def known(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces; new ones are encoded and remembered."""
        got = list(map(self.get, pieces))
        new = [w for w, ids in zip(pieces, got) if ids is None]
        if not new:
            return got
        # a word and the punctuation behind it are separate tokens
        cut = {w: w.rstrip(self.punctuation) for w in new}
        cut = {w: c if c and c[-1].isalpha() else w for w, c in cut.items()}
        words = [c for c in set(cut.values()) if c not in self]
        known = dict(zip(words, self.encode_words(words)))
        tails = list({w[len(c):] for w, c in cut.items() if len(c) < len(w)})
        tail_ids = dict(zip(tails, self.encode(tails)))
        tail_ids[""] = b""
        for w, c in cut.items():
            if w not in known:
                known[w] = (known[c] if c in known else self[c]) + tail_ids[w[len(c):]]
        if len(self) < self.most:
            self.update(known)
        return [known[w] if ids is None else ids for w, ids in zip(pieces, got)]

    def joined(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in order and the number of each one's.  A piece
        is looked up once, however often the texts have it."""
        if not texts:
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        odd = [_odd(t) for t in texts]
        # a line end becomes the beginning of a piece
        split = pc.split_pattern(pc.replace_substring(pa.array(["" if o else t for t, o in zip(texts, odd)], pa.string()), "\n", " \n"), " ")
        if any(odd):
            own = pa.array([_BLANK.split(t) for t in compress(texts, odd)], split.type)
            at = np.arange(len(texts))
            at[odd] = len(texts) + np.arange(len(own))
            split = pa.concat_arrays([split, own]).take(pa.array(at))
        edge = np.asarray(split.offsets)
        flat = split.values.dictionary_encode()
        firsts = edge[:-1]  # no blank stands before them
        piece = flat.indices.to_numpy().copy()
        begin = split.values.take(pa.array(firsts)).to_pylist()
        later = np.ones(len(piece), bool)
        later[firsts] = False
        used = np.bincount(piece[later], minlength=len(flat.dictionary)) > 0
        words = flat.dictionary.filter(pa.array(used)).to_numpy(zero_copy_only=False).tolist()
        number = np.cumsum(used) - 1
        coded = self.known(words) + self.encode(begin)
        piece = number[piece]
        piece[firsts] = len(words) + np.arange(len(begin))
        ids = np.frombuffer(b"".join(coded), self.dtype)
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // ids.itemsize
        n = size[piece]
        # an id's place is its piece's place and its own inside the piece
        shift = (np.cumsum(size) - size)[piece] - (np.cumsum(n) - n)
        return ids[np.repeat(shift, n) + np.arange(n.sum())], np.add.reduceat(n, firsts)

    def ids(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        ids, n = self.joined(texts)
        raw, edge = ids.tobytes(), (np.r_[0, np.cumsum(n)] * ids.itemsize).tolist()
        return [raw[a:b] for a, b in zip(edge, edge[1:])]


_LOADED: dict[int, Pieces] = {}


def _pieces(json: str, dtype: str) -> Pieces:
    key = hash(json)
    if key not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        _LOADED[key] = Pieces(Tokenizer.from_str(json), dtype)
    return _LOADED[key]


def id_type(tokenizer_path: str) -> str:
    """Narrowest unsigned type that holds the tokenizer's ids."""
    from tokenizers import Tokenizer
    return "<u2" if Tokenizer.from_file(tokenizer_path).get_vocab_size() <= 1 << 16 else "<u4"


def encode(docs: DataFrame, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(doc_id, ids)``: the ids of the whole text and ``end_id``, as
    little-endian integers of :func:`id_type`.  The tokenizer's file (a
    byte-level BPE of the tokenizers library) is read by the driver and
    broadcast."""
    with open(tokenizer_path, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    dtype = id_type(tokenizer_path)

    def run(b):
        ids, n = _pieces(model.value, dtype).joined([t or "" for t in b["text"].to_pylist()])
        ids = np.insert(ids, np.cumsum(n), end_id)
        return {"doc_id": b["doc_id"], "ids": _binary(ids, np.r_[0, np.cumsum(n + 1)] * ids.itemsize)}

    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return d.mapInArrow(per_batch(run), "doc_id long, ids binary")


def _counts(dtype: str):
    def count(batches):
        total = np.zeros(0, np.int64)
        for b in batches:
            n = np.bincount(_values(b["ids"], dtype)[0], minlength=len(total))
            n[:len(total)] += total
            total = n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(at, pa.int64()), "n": pa.array(total[at], pa.int64())})
    return count


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Encode every text and write the files of the format under ``path``.

    A null text is an empty one (its only id is ``end_id``), a null doc_id
    sorts first, repeated rows are all written (ties in the order of length
    and ids), an empty table gives files without rows.  Other columns are not
    read.  The rank table is bounded by the tokenizer's vocabulary.
    """
    spark, dtype = docs.sparkSession, id_type(tokenizer_path)
    raw = f"{path}/raw"
    (encode(docs, tokenizer_path, end_id, id_col, text_col)
     .write.option("compression", "zstd").parquet(raw))
    rows = spark.read.schema("doc_id long, ids binary").parquet(raw)
    counts = (rows.select("ids").mapInArrow(_counts(dtype), "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).toPandas())
    by_rank = counts.sort_values(["n", "id"], ascending=[False, True], ignore_index=True)
    spark.createDataFrame([(i, int(t), int(n)) for i, (t, n) in enumerate(zip(by_rank["id"], by_rank["n"]))],
                          "rank long, id long, n long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(by_rank["id"].max()) + 1 if len(by_rank) else 1, np.uint32)
    rank_of[by_rank["id"].to_numpy(np.int64)] = np.arange(len(by_rank), dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)

    def code(b):
        ids, edge = _values(b["ids"], dtype)
        control, at, data, to = encode_rows(shared.value[ids], edge)
        return {"doc_id": b["doc_id"], "n_tokens": pa.array(np.diff(edge)), "control": _binary(control, at),
                "data": _binary(data, to), "part": b["part"], "row": b["row"]}

    # monotonically_increasing_id holds the partition in its upper bits
    ordered = (rows.orderBy(F.col("doc_id").asc_nulls_first(), F.length("ids"), F.xxhash64("ids"))
               .select("doc_id", "ids", F.spark_partition_id().alias("part"),
                       F.monotonically_increasing_id().alias("row")))
    (ordered.mapInArrow(per_batch(code), "doc_id long, n_tokens long, control binary, data binary, part int, row long")
     .write.option("compression", "zstd").parquet(f"{path}/tokens"))


def _decoded(b: pa.RecordBatch, id_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows of files of the format and the rows' edges."""
    edge = np.r_[0, np.cumsum(b["n_tokens"].to_numpy())]
    return id_of[decode_rows(_values(b["control"], np.uint8)[0], _values(b["data"], np.uint8)[0], edge)], edge


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of files of the format: ``doc_id``, ``start`` (number of
    ids of all documents before it), ``n_tokens`` and ``ids`` (little-endian
    unsigned 32-bit integers), decoded."""
    rows = spark.read.parquet(f"{path}/tokens")
    ids = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()["id"].to_numpy("<u4")
    shared = spark.sparkContext.broadcast(ids)

    def decode(b):
        ids, edge = _decoded(b, shared.value)
        return {"doc_id": b["doc_id"], "start": b["start"], "n_tokens": b["n_tokens"], "ids": _binary(ids, edge * 4)}

    return _with_start(rows, rows).mapInArrow(per_batch(decode), "doc_id long, start long, n_tokens long, ids binary")


def _with_start(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``start`` from the totals of the parts before, as the files have them
    (one row a part, hence broadcast), and the running total in the part."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
               .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")))
    within = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
            .join(F.broadcast(offsets), "part").withColumn("start", F.col("offset") + F.col("inner")))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and the CRC-32 of
    the decoded ids.  Only the digests are shuffled, not the ids."""
    rows = spark.read.parquet(f"{path}/tokens")
    ids = spark.read.parquet(f"{path}/ranks").orderBy("rank").toPandas()["id"].to_numpy("<u4")
    shared = spark.sparkContext.broadcast(ids)

    def crc(b):
        ids, edge = _decoded(b, shared.value)
        raw, at = memoryview(ids).cast("B"), (edge * 4).tolist()
        return {"doc_id": b["doc_id"], "n_tokens": pa.array(np.diff(edge)),
                "ids_crc32": pa.array([zlib.crc32(raw[i:j]) for i, j in zip(at, at[1:])], pa.int64()),
                "part": b["part"], "row": b["row"]}

    d = rows.mapInArrow(per_batch(crc), "doc_id long, n_tokens long, ids_crc32 long, part int, row long")
    return _with_start(d, rows).select("doc_id", "start", "n_tokens", "ids_crc32")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared scratch space, deleted at the end."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    return path
