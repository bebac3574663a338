"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from icetally.session import shared_dir

#: A word is a run of characters other than these blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows and bytes of one Arrow batch sent to a Python worker: long texts must not add up in its memory.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20

#: Bytes up to which Spark may broadcast a table unasked. It compares them with what was written to a shuffle; on the
#: driver, through which the table passes, the rows of a few numbers take ten times that and more.
MOST_UNASKED = 1 << 20


def tune(spark: SparkSession) -> None:
    """Small Arrow batches, so that a Python worker holds a few MB of texts however long they are, and small broadcasts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    if spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() > MOST_UNASKED:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(MOST_UNASKED))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The whole text; a null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text in order; none for a blank text."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def remainder(doc_id: Column, modulus: int = 5) -> Column:
    """crc32 of the id as text, modulo; -1 for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(-1))


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that does not occur in df, whatever its case."""
    taken = {c.lower() for c in df.columns}
    name, n = stem, 0
    while name.lower() in taken:
        n += 1
        name = f"{stem}_{n}"
    return name


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder: what follows survives lost executors without recomputing it."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def written(df: DataFrame, compression: str | None = None) -> DataFrame:
    """As cut(), but as a Parquet table, for wide rows of which later steps read some columns."""
    path = os.path.join(shared_dir(df.sparkSession), f"table-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


#: Numbers up to which a table is broadcast (some 20 MB); above that it is shuffled.
BROADCAST_NUMBERS = 1_000_000


def sized(small: DataFrame, more: Column | None = None, numbers: int = BROADCAST_NUMBERS) -> DataFrame:
    """small, written to the shared folder and measured: to be broadcast if it holds few numbers, else as it is.

    A row counts with two numbers for each column, and with `more` for what its arrays hold.
    """
    small = cut(small)
    each = F.lit(2 * len(small.columns)) if more is None else more + 2 * len(small.columns)
    total = small.agg(F.sum(each.cast("bigint"))).first()[0] or 0
    return F.broadcast(small) if total <= numbers else small


#: Keys up to which a list of them is broadcast whole; above that only a sieve of them is.
BROADCAST_KEYS = 100_000
#: Bits of a sieve for each key, and at most in all (4 MB); bits that Spark's bitmaps hold in a bucket.
KEY_BITS, MOST_BITS, BUCKET_BITS = 16, 1 << 25, 1 << 15


class Keys:
    """The keys of a one-column table, written to the shared folder, to pick or drop the rows of a larger one by them.

    Few are broadcast. A broadcast passes whole through the driver, where a row of one number takes some 200 bytes at
    its peak; of more than BROADCAST_KEYS only a sieve is, a bitmap of their hashes, whose size has a bound. It lets
    through every row that has a key and few others; these are then joined by a shuffle, so the result is exact, and
    the rows that it stops never travel.
    """

    def __init__(self, keys: DataFrame) -> None:
        (self.name,) = keys.columns
        self.table = cut(keys)
        self.count = self.table.count()
        self.few = self.count <= BROADCAST_KEYS
        if not self.few:
            self.bits = max(BUCKET_BITS, min(MOST_BITS, 1 << (KEY_BITS * self.count).bit_length()))
            at = self._at(self.name)
            buckets = self.table.select((at / BUCKET_BITS).cast("int").alias("bucket"), (at % BUCKET_BITS).alias("bit"))
            self.sieve = cut(buckets.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")))

    def _at(self, column: str) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(self.bits))

    def _marked(self, df: DataFrame, column: str, mark: str) -> DataFrame:
        """df and whether its column may be a key: true for all that are."""
        bucket, bits = free_name(df, "bucket"), free_name(df, "bits")
        sieve = F.broadcast(self.sieve.select(F.col("bucket").alias(bucket), F.col("bits").alias(bits)))
        bit = (self._at(column) % BUCKET_BITS).cast("int")
        byte = F.conv(F.hex(F.substring(bits, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        found = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), bit % 8)) != 0
        dealt = df.withColumn(bucket, (self._at(column) / BUCKET_BITS).cast("int")).join(sieve, bucket, "left")
        return dealt.select(*df.columns, F.coalesce(found, F.lit(False)).alias(mark))

    def picked(self, df: DataFrame, column: str, then: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
        """then(the rows of df whose column is a key); `then` keeps the column and makes its rows of rows of one key."""
        if self.few:
            return then(df.join(F.broadcast(self._as(column)), column, "left_semi"))
        mark = free_name(df, "mark")
        let = self._marked(df, column, mark).where(mark).drop(mark)
        return then(let).join(self._as(column), column, "left_semi")

    def dropped(self, df: DataFrame, column: str) -> DataFrame:
        """The rows of df whose column is no key, nulls among them."""
        if self.few:
            return df.join(F.broadcast(self._as(column)), column, "left_anti")
        mark = free_name(df, "mark")
        marked = self._marked(df, column, mark)
        let = marked.where(mark).drop(mark).join(self._as(column), column, "left_anti")
        return marked.where(~F.col(mark)).drop(mark).unionByName(let)

    def _as(self, column: str) -> DataFrame:
        return self.table.select(F.col(self.name).alias(column))
