"""Exact dedup against a persistent digest index.

The index is a table of one row per distinct text, bucketed and sorted by the text's
SHA-256. A batch of new rows is reduced to one row per digest (partial aggregation, so
a hot text is one row per task before the shuffle), anti-joined to the index by a
sort-merge join that reads the index's buckets as they lie, and the digests not yet
known are appended. Digests met again are appended to a second table of the same
layout with how often they came, so that group sizes stay exact.

Every batch has a name, and its rows carry it. A batch counts once its name is published
by a file in the folder ``done``, the last step of adding it; rows of a batch that broke off
are not read, and a batch that is added again is taken from what was published. The
number of buckets is stored beside the index and holds for all who open it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulon.llm.common import ascii_lower, discard, stored, table
from tabulon.session import shared_path


def text_digest(text: Column) -> Column:
    """SHA-256 (lowercase hex) of the text in UTF-8, A-Z lower-cased; NULL is empty."""
    return F.sha2(ascii_lower(F.coalesce(text, F.lit(""))).cast("binary"), 256)


class DigestIndex:
    """A digest index below ``path`` (a shared folder). Reopening a path goes on with
    what earlier sessions have appended.

    Rows: ``digest`` string, ``keep_id`` (the id that stays for the text), ``n`` (rows of
    the batch that brought it). The first batch that brings a text decides its
    ``keep_id``, the largest id in that batch; NULL ids lose against any other.
    """

    SCHEMA = "digest STRING, keep_id BIGINT, n BIGINT, batch STRING"

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        """``buckets`` (32) is for a new index; one that exists has its own, and another
        number is refused."""
        self.spark, self.path = spark, path.rstrip("/")
        layout = f"{self.path}/layout"
        if self._exists(layout):
            self.buckets = spark.read.schema("buckets INT").parquet(layout).first()["buckets"]
            if buckets not in (None, self.buckets):
                raise ValueError(f"{path} has {self.buckets} buckets, not {buckets}")
        else:
            self.buckets = buckets or 32
            spark.createDataFrame([(self.buckets,)], "buckets INT").coalesce(1).write.parquet(layout)
        tag = uuid.uuid4().hex
        self.tables = {k: f"digest_{k}_{tag}" for k in ("index", "again")}
        for kind, name in self.tables.items():
            spark.sql(f"CREATE TABLE {name} ({self.SCHEMA}) USING parquet CLUSTERED BY (digest) "
                      f"SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}/{kind}'")

    def _exists(self, path: str) -> bool:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)

    def _published(self) -> list[str]:
        """Names of the batches that are complete; one small file each."""
        done = f"{self.path}/done"
        if not self._exists(done):
            return []
        at = self.spark._jvm.org.apache.hadoop.fs.Path(done)
        files = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(at)
        return sorted(f.getPath().getName() for f in files)

    def _rows(self, kind: str) -> DataFrame:
        return self.spark.table(self.tables[kind]).where(F.col("batch").isin(self._published()))

    def _append(self, df: DataFrame, kind: str) -> None:
        # one task per bucket: each task writes a single file of its bucket, already sorted
        (df.select("digest", "keep_id", "n", "batch").repartition(self.buckets, "digest")
         .write.mode("append").format("parquet").bucketBy(self.buckets, "digest").sortBy("digest")
         .option("path", f"{self.path}/{kind}").saveAsTable(self.tables[kind]))

    def add(self, digests: DataFrame, id_col: str = "id", digest_col: str = "digest", batch: str | None = None) -> DataFrame:
        """Deduplicate a batch of (id, digest) rows and append what is new. Returns the
        texts that were new, one row each: digest, keep_id, n.

        ``batch`` names it (else it gets a name of its own): adding a batch of a published
        name again changes nothing and returns what was new then. Each attempt writes
        under a name of its own, so what an attempt that broke off has left never counts.
        """
        published = [name for name in self._published() if batch is not None and name.startswith(f"{batch}@")]
        if published:
            return self.spark.table(self.tables["index"]).where(F.col("batch") == published[0]).select("digest", "keep_id", "n")
        name = f"{batch or uuid.uuid4().hex}@{uuid.uuid4().hex}"
        rows = stored(digests.groupBy(F.col(digest_col).alias("digest"))
                      .agg(F.max(id_col).cast("long").alias("keep_id"), F.count(F.lit(1)).alias("n"))
                      .withColumn("batch", F.lit(name)), "digest_batch")
        known = self._rows("index").select("digest")
        new = rows.hint("merge").join(known.hint("merge"), "digest", "left_anti")
        seen = rows.hint("merge").join(known.hint("merge"), "digest", "left_semi")
        new, seen = stored(new, "digest_new"), stored(seen, "digest_seen")
        self._append(new, "index")
        self._append(seen, "again")
        self._publish(name)
        discard(rows, seen)
        return new.select("digest", "keep_id", "n")

    def _publish(self, name: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/done/{name}")
        fs = at.getFileSystem(self.spark._jsc.hadoopConfiguration())
        fs.mkdirs(at.getParent())
        fs.create(at, True).close()

    def groups(self) -> DataFrame:
        """One row per text ever added: digest, keep_id, group_size."""
        index, again = self._rows("index"), self._rows("again")
        return (index.unionByName(again.withColumn("keep_id", F.lit(None).cast("long")))
                .groupBy("digest").agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")))

    def drop(self) -> None:
        """Forget the session's names of the two tables; their files stay."""
        for name in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def exact_dedup(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text",
                batches: int = 2) -> DataFrame:
    """Add ``docs`` to the index in ``batches`` id ranges, largest ids first, and return one
    row per input row: id, keep_id, group_size, kept, text_sha256.

    Largest ids first, so that the first batch to bring a text also holds its largest
    id. NULL text counts as empty; a NULL id belongs to the last batch and is kept only
    if no row of its group has an id. Repeated rows with the same id and text are
    counted each, and one of them is kept. An empty table gives no rows.
    """
    rows = stored(docs.select(F.col(f"`{id_col}`").alias("id"), text_digest(F.col(f"`{text_col}`")).alias("digest")),
                  "digests")
    low, high = rows.agg(F.min("id"), F.max("id")).first()
    if low is None:
        low = high = 0
    step = max(1, -(-(high - low + 1) // batches))
    part = F.coalesce(F.floor((F.lit(high) - F.col("id")) / step), F.lit(batches - 1))
    for k in range(batches):
        index.add(rows.where(part == k))
    joined = rows.join(stored(index.groups(), "digest_groups"), "digest")
    last = F.col("id").eqNullSafe(F.col("keep_id"))
    # of rows equal in id and text one stays; only those that stay are looked at for others
    twice = rows.groupBy("digest", "id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("digest", "id")
    out = joined.select("id", "keep_id", "group_size", last.alias("kept"), "digest")
    if not twice.isEmpty():
        held = twice.select(F.col("digest").alias("d"), F.col("id").alias("i"))
        own = (F.col("digest") == F.col("d")) & F.col("id").eqNullSafe(F.col("i"))
        marked = stored(out.join(held, own, "left").withColumn("row", F.monotonically_increasing_id()), "digest_twice")
        first = (marked.where("kept and d is not null").groupBy("digest", "id").agg(F.min("row").alias("row"))
                 .select("row", F.lit(True).alias("first")))
        out = (marked.join(first, "row", "left")
               .withColumn("kept", F.col("kept") & (F.col("d").isNull() | F.coalesce("first", F.lit(False)))))
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = DigestIndex(spark, shared_path(spark, "llm", "digest_index", unique=True))
    try:
        return exact_dedup(table(spark, sf_dir, "documents"), index)
    finally:
        index.drop()


OP6_SQL = """
with d as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t
  from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id is not distinct from max(doc_id) over w
         and row_number() over (partition by t, doc_id) = 1 as kept, sha256(t) as text_sha256
from d window w as (partition by t)
"""
