"""WARC archives and their index, merged to globally ordered capture histories.

``write_archives`` turns every page into one WARC/1.1 record and lets Spark
write them as gzipped text files whose line end is the record end, so archives
land wherever Spark can write; places in the index are those of the unpacked
archive.  Of records with equal payloads of ``shared`` bytes or
more, those of the largest page number carry the payload and all others revisit
it.  An archive is closed by the running sum of its bytes, however uneven the records
are, so ``read_archives`` can read whole files, walks the records by Content-Length and gives one index entry
per record; the entries of an archive leave the task sorted by URL key and
timestamp: a local run.

``merge_runs`` deals the runs by range of (URL key, timestamp), so a URL captured
very often spreads over tasks too, and each task merges the runs' pieces with a
loser tree.  Partitions follow one another, so the whole is in global order.

Defined cases: null html is an empty payload; a null url has URL key ""; line
ends in an url are written as %0D and %0A; a null page number comes before every
other, and with no other to point to its records are all responses; rows that
repeat the largest page number are all responses; an empty table writes no
record and gives no entry.
"""

from __future__ import annotations

import gzip
import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.llm.common import written
from keyfold.session import pickle_by_value, shared_dir

#: Payloads shorter than this are always written.
SHARED = 1000
#: Bytes of an archive before packing: a new one begins with the first record that
#: starts behind them, so that an archive is at most one record longer.
ARCHIVE = 16 << 20
#: Index entries a merging task holds, about.
MERGED = 200_000
EPOCH = 1577836800  # captures without a time are dated by page number from here
EOL = "\r\n"
ENTRY = ("urlkey string, stamp string, page string, run string, place long, length long, "
         "type string, bytes long, digest string, refers string")


def records(pages: DataFrame, page="page_id", url="url", html="html",
            shared: int = SHARED) -> DataFrame:
    """``value``: the text of one WARC record per row, and its ``size``."""
    p = pages.select(F.col(page).alias("page"), F.col(url).alias("url"),
                     F.coalesce(F.col(html).cast("string"), F.lit("")).alias("body"))
    p = p.withColumn("n", F.octet_length("body").cast("long")).withColumn("sha", F.sha1("body"))
    # a payload of any number of copies is one row here, counted before the shuffle
    last = p.filter(F.col("n") >= shared).groupBy("sha").agg(
        F.max("page").alias("of"), F.count(F.lit(1)).alias("k")).filter("k > 1 and of is not null")
    # read from a table, the counts do not tie the pages to their own partitioning,
    # and Spark may split the pages of one payload over tasks
    p = p.join(written(last.select("sha", "of"), "warc-copies"), "sha", "left")
    again = F.col("of").isNotNull() & ~F.col("page").eqNullSafe(F.col("of"))
    stamp = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.coalesce(
        F.pmod(F.col("page").cast("long"), F.lit(1 << 31)), F.lit(0))), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    id_of = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}"
                          "Content-Length: "), F.col("n").cast("string"), F.lit(EOL + EOL))
    block = F.when(again, http).otherwise(F.concat(http, "body"))
    line = lambda name, c: F.coalesce(
        F.concat(F.lit(f"{name}: "), c, F.lit(EOL)), F.lit(""))
    head = F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        line("WARC-Type", F.when(again, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", id_of(F.col("page"))), line("WARC-Target-URI", target),
        line("WARC-Date", stamp), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha")),
        line("WARC-Refers-To", F.when(again, id_of(F.col("of")))),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")), F.lit(EOL))
    return p.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, path: str, archive: int = ARCHIVE, **kw) -> None:
    """Write the records under ``path``/file=..., one archive per task and file."""
    def roll(batches):
        done = 0  # bytes of the task's records so far
        for b in batches:
            text = b.column(0)
            ends = done + np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False) + 4,
                                    dtype="i8")
            starts = np.concatenate([[done], ends[:-1]])
            done = int(ends[-1]) if len(ends) else done
            yield pa.RecordBatch.from_arrays([text, pa.array(starts // archive)], names=["value", "file"])

    rolled = records(pages, **kw).mapInArrow(roll, "value string, file long")
    (rolled.write.option("lineSep", EOL + EOL).option("compression", "gzip").partitionBy("file")
     .text(path))


def urlkey(url: str) -> str:
    """Sort-friendly key: host labels reversed, then port, path and query."""
    m = re.match(r"^[^:/?#]*://(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^#]*)", url)
    if not m:
        return url.lower()
    return ",".join(reversed(m[1].lower().split("."))) + (m[2] or "") + ")" + (m[3] or "/").lower()


def walk(data: memoryview):
    """(offset, length, headers, block) of each record of an archive."""
    at = 0
    while at < len(data):
        head = bytes(data[at:at + (1 << 16)])
        end = head.find(b"\r\n\r\n")
        while end < 0:  # headers are longer than usual
            head = bytes(data[at:at + 2 * len(head)])
            end = head.find(b"\r\n\r\n")
        lines = head[:end].split(b"\r\n")
        if not lines[0].startswith(b"WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        headers = {k.lower().decode(): v.strip().decode() for k, _, v in
                   (x.partition(b":") for x in lines[1:])}
        start, size = at + end + 4, int(headers["content-length"])
        if bytes(data[start + size:start + size + 4]) != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} does not end where it says")
        yield at, start + size - at, headers, data[start:start + size]
        at = start + size + 4


def entries(name: str, data: memoryview) -> list[tuple]:
    """The index entries of an archive, sorted: one run."""
    out = []
    page_of = lambda x: x[len("<urn:page:"):-1] if x else None
    for at, length, h, block in walk(data):
        head_end = bytes(block[:4096]).find(b"\r\n\r\n") + 4
        digest = h["warc-payload-digest"].partition(":")[2]
        if h["warc-type"] == "response":
            payload = block[head_end:]
            size, got = len(payload), hashlib.sha1(payload).hexdigest()
            if got != digest:
                raise ValueError(f"payload at byte {at} of {name} does not match its digest")
        else:
            size = int(re.search(rb"Content-Length: ([0-9]+)", bytes(block[:head_end]))[1])
        out.append((urlkey(h.get("warc-target-uri", "")), h["warc-date"],
                    page_of(h.get("warc-record-id")), name, at, length, h["warc-type"], size,
                    digest, page_of(h.get("warc-refers-to"))))
    return sorted(out, key=_order)


def _order(e: tuple):
    return e[0].encode(), e[1], (e[2] is not None, len(e[2] or ""), e[2] or ""), e[3], e[4]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in ENTRY.split(", ")]
    kinds = [pa.int64() if x.endswith(" long") else pa.string() for x in ENTRY.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives under ``path``; each archive is a sorted run."""
    def read(batches):
        for b in batches:
            for name, content in zip(b.column(0), b.column(1)):
                yield _batch(entries("/".join(name.as_py().split("/")[-2:]),
                                     memoryview(gzip.decompress(content.as_buffer()))))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt.gz").load(path)
    return files.select("path", "content").mapInArrow(read, ENTRY)


class LoserTree:
    """k-way merge: each inner node keeps the loser of its two subtrees, so the
    next entry costs one comparison per level."""

    def __init__(self, runs: list, key):
        self.runs, self.key = [iter(r) for r in runs], key
        self.k = len(runs)
        self.heads = [self._next(i) for i in range(self.k)]
        self.losers = [-1] * max(1, self.k)
        for i in range(self.k):
            self._play(i, first=True)

    def _next(self, i: int):
        e = next(self.runs[i], None)
        return None if e is None else (self.key(e), i, e)

    def _beats(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return x is not None and (y is None or x[:2] < y[:2])

    def _play(self, i: int, first: bool = False) -> None:
        winner, node = i, (i + self.k) // 2
        while node > 0:
            other = self.losers[node]
            if other < 0 and first:  # the opponent has not come yet: wait here
                self.losers[node] = winner
                return
            if self._beats(other, winner):
                self.losers[node], winner = winner, other
            node //= 2
        self.losers[0] = winner

    def __iter__(self):
        while self.k and (head := self.heads[self.losers[0]]) is not None:
            yield head[2]
            self.heads[head[1]] = self._next(head[1])
            self._play(head[1])


def merge_runs(index: DataFrame, merged: int = MERGED) -> DataFrame:
    """The entries in global order of URL key, timestamp, page; ``place_in_order``
    rises through them."""
    spark = index.sparkSession
    index = written(index, "warc-runs")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
            -(-index.count() // merged))
    # within a range, each run's piece in its own order
    by = ["urlkey", "stamp", F.length("page"), "page", "run", "place"]
    dealt = index.repartitionByRange(n, *by).sortWithinPartitions("run", *by[:4], "place")

    def merge(batches):
        runs: dict[str, list] = {}
        for b in batches:
            for e in zip(*[c.to_pylist() for c in b.columns]):
                runs.setdefault(e[3], []).append(e)
        out = []
        for e in LoserTree(list(runs.values()), _order):
            out.append(e)
            if len(out) == 10_000:
                yield _batch(out)
                out = []
        yield _batch(out)

    return dealt.mapInArrow(merge, ENTRY).withColumn("place_in_order",
                                                     F.monotonically_increasing_id())


def histories(pages: DataFrame, page="page_id", url="url", html="html",
              shared: int = SHARED) -> DataFrame:
    """Write the pages' archives in the shared folder, read them back, merge."""
    spark = pages.sparkSession
    path = shared_dir(spark, "llm", "warc")
    write_archives(pages, path, page=page, url=url, html=html, shared=shared)
    kind = pages.schema[page].dataType
    m = merge_runs(read_archives(spark, path))
    return m.select(F.col("page").cast(kind).alias(page), "urlkey", "stamp",
                    F.col("run").alias("archive"), F.col("place").alias("offset"), "length",
                    F.col("type").alias("record_type"), F.col("bytes").alias("payload_bytes"),
                    F.col("digest").alias("payload_digest"),
                    F.col("refers").cast(kind).alias("refers_to"), "place_in_order")


pickle_by_value(__name__)
