"""State of ``foreachBatch`` operators between epochs, as tables in the shared folder.

An epoch that is repeated (Spark repeats the last one that was not committed)
reads what it read before and overwrites what it wrote before.  So state of an
epoch is kept until it can't be asked for any more, and then removed: the number
of folders does not grow with the epochs.  Nothing here depends on the number of
partitions, on bucket widths or on the session, so a stream may be restarted
with others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Latest:
    """A whole table per epoch, of which the last ``keep`` stay."""

    def __init__(self, spark: SparkSession, folder: str, keep: int = 2):
        self.spark, self.folder, self.keep = spark, folder, max(2, keep)

    def path(self, epoch: int) -> str:
        return f"{self.folder}/epoch={epoch}"

    def before(self, epoch: int, schema) -> DataFrame | None:
        """The table as the previous epoch left it; None at the first epoch."""
        return self.spark.read.schema(schema).parquet(self.path(epoch - 1)) if epoch > 0 else None

    def write(self, df: DataFrame, epoch: int) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(epoch))
        if epoch >= self.keep:
            remove(self.spark, self.path(epoch - self.keep))
        return self.spark.read.schema(df.schema).parquet(self.path(epoch))


class Growing:
    """Rows that only get more: every epoch adds some, and every ``merge`` epochs
    all so far are written as one table.

    Rows are dealt to ``buckets`` by a hash of ``by``, and ``before`` reads only
    the buckets that the rows at hand fall into.  Of earlier epochs at most two
    merged tables and ``2 * merge`` additions stay.
    """

    def __init__(self, spark: SparkSession, folder: str, by: list[str], buckets: int = 64,
                 merge: int = 8):
        self.spark, self.folder, self.by = spark, folder, by
        self.buckets, self.merge = buckets, merge

    def bucket(self) -> Column:
        # equal rows have equal hashes, null columns included
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def _read(self, schema, first: int, upto: int) -> DataFrame | None:
        paths = [f"{self.folder}/all/epoch={first}"] if first else []
        paths += [f"{self.folder}/new/epoch={e}" for e in range(first, upto)]
        schema = T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])
        out = None
        for p in paths:
            part = self.spark.read.schema(schema).parquet(p)
            out = part if out is None else out.unionByName(part)
        return out

    def before(self, epoch: int, rows: DataFrame) -> DataFrame | None:
        """What earlier epochs added, of the buckets that ``rows`` fall into."""
        schema = rows.select(*self.by).schema
        base = epoch // self.merge * self.merge
        if base == epoch and epoch:  # merge all before this epoch
            everything = self._read(schema, base - self.merge, epoch)
            everything.write.mode("overwrite").partitionBy("_bucket") \
                .parquet(f"{self.folder}/all/epoch={epoch}")
        met = [r[0] for r in rows.select(self.bucket()).distinct().collect()]  # ``buckets`` at most
        out = self._read(schema, base, epoch)
        return None if out is None else out.filter(F.col("_bucket").isin(met)).drop("_bucket")

    def add(self, rows: DataFrame, epoch: int) -> None:
        rows.select(*self.by, self.bucket().alias("_bucket")).write.mode("overwrite") \
            .partitionBy("_bucket").parquet(f"{self.folder}/new/epoch={epoch}")
        old = epoch - self.merge
        if epoch % self.merge == 0 and old > 0:
            # repeated, this epoch needs the merged table before its own and what came since
            for e in range(max(0, old - 2 * self.merge), old):
                remove(self.spark, f"{self.folder}/new/epoch={e}")
                remove(self.spark, f"{self.folder}/all/epoch={e}")
