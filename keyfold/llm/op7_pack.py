"""Token ids and binary output by best-fit-decreasing packing.

Texts become token ids, each document closed by an end mark, documents over
``length`` ids are cut into pieces without loss, and pieces are packed into
rows of ``length`` ids: longest first, each into the fullest row it still fits,
found by walking a segment tree over the rows' free capacities.

Spark deals the pieces to shards by a hash of document and piece.  The number
of shards follows the total size of the texts, so a shard (about ``shard``
bytes of text) fits one task at any scale; copies of a document have ids of
their own and spread.  Shards pack independently and differ from a global
packing by less than one row each.

A row of the result is a row of the id matrix: ``ids`` (little-endian int32,
``length`` of them, filled up with the end mark), ``lengths`` (cumulative
segment lengths, first 0), ``positions`` (little-endian int32, starting again
at 0 with every segment), and which document and piece each segment is.

Defined cases: null and empty texts are one end mark; repeated rows are packed
as often as they occur; ids may be null; an empty table gives no rows.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from keyfold.session import pickle_by_value

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary splits texts before merging (fixed with the vocabulary).
PATTERN = (r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
END = 50256
LENGTH = 2048
SHARD = 4 << 20
_encodings: dict[bytes, object] = {}


def encoding(ranks: bytes):
    """tiktoken encoding of a rank file's content, made once per process."""
    if ranks not in _encodings:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        _encodings[ranks] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table,
                                              special_tokens={})
    return _encodings[ranks]


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """The rank file (some hundred KB) through Spark, wherever it lies."""
    return bytes(spark.read.format("binaryFile").load(
        path if "://" in path else f"file://{path}").select("content").first()[0])


class FreeCapacities:
    """Rows by free capacity, with the least capacity that is enough in
    O(log capacity): a segment tree of counts over 0 .. length."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def add(self, row: int, free: int) -> None:
        self.rows[free].append(row)
        at = self.size + free
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """A row with the least free capacity >= need, taken out; None: no row."""
        at = self.size + need
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1  # up until a right sibling has rows
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        free = at - self.size
        while at:
            self.count[at] -= 1
            at >>= 1
        return self.rows[free].pop(), free


def best_fit(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of indices of ``sizes`` (in decreasing order), each full to ``length`` at most."""
    free, rows = FreeCapacities(length), []
    for i, n in enumerate(sizes):
        found = free.take(n)
        if found is None:
            rows.append([])
            found = (len(rows) - 1, length)
        row, left = found
        rows[row].append(i)
        if left > n:
            free.add(row, left - n)
    return rows


def pack(docs: DataFrame, doc_id="doc_id", text="text", tokenizer: str = TOKENIZER,
         length: int = LENGTH, end: int = END, shard: int = SHARD) -> DataFrame:
    """The packed rows: shard, row, n_tokens, doc_ids, pieces, lengths, ids, positions."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(spark, tokenizer))
    kind = docs.schema[doc_id].dataType
    arrow = to_arrow_type(kind)
    plain = F.coalesce(F.col(text).cast("string"), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(plain) + 1)).first()[0] or 0
    shards = max(1, -(-total // shard))

    def pieces(batches):
        enc = encoding(ranks.value)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                who, nth, ids = [], [], []
                for row, t in enumerate(part.column(2)):
                    x = enc.encode_ordinary(t.as_py())
                    x.append(end)
                    for k in range(0, len(x), length):
                        who.append(row)
                        nth.append(k // length)
                        ids.append(np.array(x[k:k + length], dtype="i4"))
                take = pa.array(who, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take),
                     pa.array(nth, pa.int32()), pa.array(ids, pa.list_(pa.int32()))],
                    names=["doc", "key", "piece", "ids"])

    cut = docs.select(F.col(doc_id).alias("doc"), F.xxhash64(F.col(doc_id), plain).alias("key"),
                      plain.alias("text")).mapInArrow(
        pieces, f"doc {kind.simpleString()}, key long, piece int, ids array<int>")
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("key", "piece"), F.lit(shards)).cast("int"))

    def fill(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        t = t.append_column("n", pa.array(np.diff(_offsets(t.column("ids")))))
        t = t.sort_by([("n", "descending"), ("key", "ascending"), ("piece", "ascending")])
        ends = _offsets(t.column("ids"))
        values = np.concatenate([c.flatten().to_numpy() for c in t.column("ids").chunks])
        doc, piece = t.column("doc").to_pylist(), t.column("piece").to_pylist()
        out = {c: [] for c in ("n_tokens", "doc_ids", "pieces", "lengths", "ids", "positions")}
        for row in best_fit(t.column("n").to_pylist(), length):
            cum = np.concatenate([[0], np.cumsum([ends[i + 1] - ends[i] for i in row])])
            ids, pos = np.full(length, end, dtype="<i4"), np.arange(length, dtype="<i4")
            for s, i in enumerate(row):
                ids[cum[s]:cum[s + 1]] = values[ends[i]:ends[i + 1]]
                pos[cum[s]:cum[s + 1]] -= pos[cum[s]]
            pos[cum[-1]:] -= int(cum[-1])  # the filling is a segment by itself
            out["n_tokens"].append(int(cum[-1]))
            out["doc_ids"].append([doc[i] for i in row])
            out["pieces"].append([piece[i] for i in row])
            out["lengths"].append(cum.astype("i4"))
            out["ids"].append(ids.tobytes())
            out["positions"].append(pos.tobytes())
        n = len(out["ids"])
        return pa.table({
            "shard": pa.array([key[0].as_py()] * n, pa.int32()),
            "row": pa.array(range(n), pa.int32()),
            "n_tokens": pa.array(out["n_tokens"], pa.int32()),
            "doc_ids": pa.array(out["doc_ids"], pa.list_(arrow)),
            "pieces": pa.array(out["pieces"], pa.list_(pa.int32())),
            "lengths": pa.array(out["lengths"], pa.list_(pa.int32())),
            "ids": pa.array(out["ids"], pa.binary()),
            "positions": pa.array(out["positions"], pa.binary())})

    return dealt.groupBy("shard").applyInArrow(
        fill, f"shard int, row int, n_tokens int, doc_ids array<{kind.simpleString()}>, "
              "pieces array<int>, lengths array<int>, ids binary, positions binary")


def _offsets(lists: pa.ChunkedArray) -> np.ndarray:
    n = np.concatenate([np.zeros(0, dtype="i8"), *[
        np.diff(c.offsets.to_numpy()) for c in lists.chunks]])
    return np.concatenate([[0], np.cumsum(n)]).astype("i8")


def unpack(rows: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER,
           end: int = END) -> DataFrame:
    """doc, text of packed rows: the exact way back, for checks.

    Pieces are put together by document id, which has to be unique.
    """
    spark = rows.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(spark, tokenizer))
    kind = rows.schema["doc_ids"].dataType.elementType
    cut = rows.select("ids", F.explode(F.arrays_zip(
        "doc_ids", "pieces", F.slice("lengths", 1, F.size("pieces")).alias("a"),
        F.slice("lengths", 2, F.size("pieces")).alias("b"))).alias("s"))
    cut = cut.select(F.col("s.doc_ids").alias("doc"), F.col("s.pieces").alias("piece"),
                     F.substring("ids", F.col("s.a") * 4 + 1, (F.col("s.b") - F.col("s.a")) * 4)
                     .alias("ids"))
    whole = cut.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("piece", "ids")))
                                   .alias("x")).select("doc", F.col("x.ids").alias("ids"))

    def texts(batches):
        enc = encoding(ranks.value)
        for b in batches:
            out = []
            for parts in b.column(1).to_pylist():
                x = np.frombuffer(b"".join(parts), dtype="<i4").tolist()
                assert x[-1] == end
                out.append(enc.decode(x[:-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())],
                                             names=["doc", "text"])

    return whole.mapInArrow(texts, f"doc {kind.simpleString()}, text string")


pickle_by_value(__name__)
