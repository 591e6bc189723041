"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.workspace import new_folder

# What separates words, as a character class of regular expressions.
SPACE = r"[\x20\x09-\x0D]+"

# Whole texts, signatures and token lists lie in a Python worker several times over, and as
# Arrow vectors outside the heap of its executor; neither gives back what it once took. A
# batch is full at either limit, and a larger row is a batch of its own.
SMALL_BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(1 << 20),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.filter(parts, lambda w: w != "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where the body has lambdas.

    A plain column would be put in place of each of its uses when projections are
    merged, and inside a lambda it would be computed for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def word_count(text: Column) -> Column:
    """How many words a text has, without building them."""
    text = F.coalesce(text, F.lit(""))
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def bounded_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows chosen by a hash of ``key``, all of them if there are fewer.

    Where the key says too little (null, or one value at many rows) the whole row is hashed,
    and at most twice as many rows are taken. The choice depends on the rows and their
    number only, so reruns agree.
    """
    n = df.count()
    if n <= rows:
        return df

    def drawn(*by: str) -> DataFrame:
        return df.where(F.pmod(F.xxhash64(F.lit(7), *by), F.lit(1 << 31)) < int(rows / n * (1 << 31)))

    if rows <= 2 * drawn(key).count() <= 4 * rows:
        return drawn(key)
    return drawn(*df.columns).limit(2 * rows)


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read from there."""
    path = new_folder(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession, df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The rows written once to the shared folder, for as long as something is made from them.

    What is made must itself be written before the end: nothing can be read again after it.
    """
    path = new_folder(spark, name)
    df.write.mode("error").parquet(path)
    yield spark.read.schema(df.schema).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def restart_point(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The rows as a written table, for loops.

    A checkpoint would cut the lineage too, but keep the size that Spark estimated for the
    plan: the product of both sides of every join, which a loop squares in each round. A
    table has its true size, so small ones are broadcast, and is compressed.
    """
    return stored(spark, df, "loop")


def let_go(spark: SparkSession) -> None:
    """What finished rounds have left goes from the driver: plans, broadcasts, shuffle files.

    Spark removes them once the driver has collected its garbage. Left to itself, the
    driver lets its heap grow instead, to its limit in a long loop of small jobs. Events
    hold the plans they tell of, so those that wait are seen to first.
    """
    with suppress(Py4JJavaError):  # a time-out: what is left goes the next time
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    spark._jvm.System.gc()
