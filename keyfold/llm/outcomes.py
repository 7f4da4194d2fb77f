"""Labels of documents as outcomes of the pages that show their text.

Page and document numbers have nothing to do with each other; what a page shares
with a document is its lines.  A line of ``LONG`` characters or more stands for
a label if all labelled documents that hold it agree; a page takes the label that
most of its lines stand for (bad, if as many stand for either).

Built-in Spark functions only.  One row per line is what meets the pages' lines, from
a written table, so that a very common line may split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.common import written
from keyfold.llm.op2_lines import lines_of, plain_lines

#: Characters of the shortest line that links a page.
LONG = 40


def _hashes(lines):
    return F.array_distinct(F.transform(F.filter(lines, lambda x: F.length(x) >= LONG),
                                        lambda x: F.xxhash64(x)))


def page_outcomes(pages: DataFrame, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """id (page number) and bad (0/1) of every page that shows labelled text.

    ``labels`` has doc_id, quality and toxic: a text of low quality or a toxic one is
    bad, one without either label is none.
    """
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    known = labels.filter("quality is not null or toxic is not null") \
        .select("doc_id", bad.alias("bad"))
    # hashes meet the labels, not texts
    of = docs.select("doc_id", _hashes(plain_lines(F.col("text"))).alias("lines")) \
        .join(known, "doc_id").select("bad", F.explode("lines").alias("line"))
    of = written(of.groupBy("line").agg(F.min("bad").alias("bad"), F.max("bad").alias("_most"))
                 .filter("bad = _most").select("line", "bad"), "url-lines")
    shown = pages.select("page_id", F.explode(_hashes(lines_of(F.col("html")))).alias("line"))
    per = shown.join(of, "line").groupBy("page_id").agg(F.sum("bad").alias("b"),
                                                       F.count(F.lit(1)).alias("n"))
    # written, as the priors of every level read it again
    return written(per.select(F.col("page_id").alias("id"), (2 * F.col("b") >= F.col("n"))
                              .cast("long").alias("bad")), "url-outcomes")
