"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.session import shared_path

#: A word is a run of anything but space and the control characters TAB..CR.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back: cuts the lineage
    so that work is not repeated, and survives the loss of any executor."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", label, unique=True)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete the files of ``stored`` tables that nothing reads any more: everything that
    was made of them must have been written, too. Other tables are left alone."""
    for df in tables:
        path = df.__dict__.pop("_stored_at", None)
        if path:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


#: Rows of an Arrow batch of whole texts, where the session does not say otherwise.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of BATCH_ROWS rows from now on. Spark's default
    of 10,000 holds tens of megabytes of text several times over in every running task. A
    session that sets ``spark.sql.execution.arrow.maxRecordsPerBatch`` itself keeps its value."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name, None) is None:
        spark.conf.set(name, BATCH_ROWS)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is. On all-ASCII texts the (much cheaper)
    full lower() changes the same letters only."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower()))


def n_words(text: Column) -> Column:
    """Words of a text; none for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(*cols: Column, seed: int = 0) -> Column:
    """A repeatable double in (0, 1) from a hash of the columns."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11).cast("double")
    return (h + 0.5) / float(1 << 53)


def packed(df: DataFrame, **inner: Column) -> DataFrame:
    """The row as one struct ``_row`` beside computed columns, so that the operator's
    own names never clash with the input's. ``df.select("_row.*")`` unpacks it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
                     *[c.alias(k) for k, c in inner.items()])


class Recent(dict):
    """What a task remembers, at most twice ``most`` entries: when it is full it becomes the
    older generation, of which only what is asked for again comes back."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.older = most, {}

    def __missing__(self, key):
        """The older generation's value, remembered anew; None if there is none."""
        value = self.older.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value):
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value
