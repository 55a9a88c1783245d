"""Exact dedup against a persistent index of digests."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofeat.llm.common import Scratch, attach, repeat_rows, restored, shielded
from chronofeat.session import new_shared_path
from chronofeat.sources.files import names_in, write_once


#: Digests per bucket for which the number of buckets is chosen.
BUCKET_ROWS = 2_000_000
LEAST_BUCKETS = 64


class DigestIndex:
    """SHA-256 digests of all texts kept so far, bucketed and sorted by digest.

    The index is an external Parquet table of (digest, keep_id) at `path`, and opening the same path
    in another session finds the same rows. The number of buckets is chosen when the first digests
    come, from their number, and stored with the index; an index that has outgrown it gets more by
    `compact`. New digests are those that a sort-merge anti join with the index leaves; the index
    side needs no shuffle, because its buckets are the join's partitions. Each call appends one file
    per bucket; `compact` makes them one again. One writer at a time: digests that two writers have
    put in twice are read once. A batch that is repeated after a failure finds its own digests and
    gives the same verdicts. `close` takes the index out of the session's catalog and leaves its
    files; frames that were returned stay readable.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or new_shared_path(spark, "digest-index")
        self.table = f"digest_index_{uuid.uuid4().hex}"
        stored = [n for n in names_in(spark, self.path) if n.startswith("_buckets-")]
        self.buckets = int(stored[0].split("-")[1]) if stored else buckets
        if self.buckets:
            self._open(0)

    def _open(self, rows: int) -> None:
        """Make the table known to the session, and choose its buckets if that is still to do."""
        if self.spark.catalog.tableExists(self.table):
            return
        if not self.buckets:
            self.buckets = max(LEAST_BUCKETS, 1 << (max(rows - 1, 0) // BUCKET_ROWS).bit_length())
        self.spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS "
            f"LOCATION '{self.path}'"
        )
        write_once(self.spark, f"{self.path}/_buckets-{self.buckets}", "")

    def close(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def read(self) -> DataFrame:
        """(digest, keep_id), one row per digest; buckets make this an aggregation in place."""
        self._open(0)
        return self.spark.table(self.table).groupBy("digest").agg(F.max("keep_id").alias("keep_id"))

    def append(self, groups: DataFrame) -> None:
        """Add the digests of `groups` (digest, keep_id) that the index does not hold."""
        self._open(groups.count())
        fresh = groups.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        fresh.select("digest", "keep_id").repartition(self.buckets, "digest").write.insertInto(
            self.table
        )

    def compact(self, path: str | None = None) -> DigestIndex:
        """The same index at a new path, one sorted file per bucket and as many buckets as it needs
        now; readers of the old stay safe."""
        rows = self.read()
        new = DigestIndex(self.spark, path)
        new._open(rows.count())
        rows.repartition(new.buckets, "digest").write.insertInto(new.table)
        return new

    def verdicts(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """One row per input row: id, keep_id, group_size, kept, text_sha256; the index grows.

        Equal texts form a group. An indexed text keeps the id it was indexed with; of a new text the
        row with the largest id stays. `group_size` counts rows of this call. Null texts count as
        empty. A null id is smaller than any other; alone it is kept, with a null keep_id. Of rows
        with equal id and text one is kept. An empty table gives no rows. Other columns are not read.
        """
        scratch = Scratch(self.spark, "digests")
        text = F.coalesce(F.col(text_col), F.lit(""))
        rows = docs.select(F.col(id_col).alias("doc_id"), F.unhex(F.sha2(text, 256)).alias("digest"))
        rows = scratch.keep(
            rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("copies")), "rows"
        )
        groups = scratch.keep(
            rows.groupBy("digest").agg(
                F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
            ),
            "groups",
        )
        self.append(groups)
        known = groups.drop("keep_id").join(self.read().hint("merge"), "digest")
        judged = attach(rows, known, "digest", "group_size")
        judged = repeat_rows(judged, "copies", "copy")
        first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)
        return judged.select(
            F.col("doc_id").alias(id_col),
            "keep_id",
            "group_size",
            first.alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )

    def keep_new(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """The rows of `docs` that stay, with all their columns; the index grows. See `verdicts`."""
        verdict = self.verdicts(docs.select(id_col, text_col), id_col, text_col)
        stay = verdict.where("kept").select(F.col(id_col).alias("_id"), "text_sha256")
        docs, own = shielded(docs)
        digest = F.sha2(F.coalesce(F.col(own[text_col]), F.lit("")), 256)
        named = docs.withColumn("_digest", digest)
        same_id = named[own[id_col]].eqNullSafe(stay["_id"])
        kept = named.join(stay, same_id & (named["_digest"] == stay["text_sha256"]), "left_semi")
        return restored(kept.dropDuplicates([own[id_col], "_digest"]), own)
