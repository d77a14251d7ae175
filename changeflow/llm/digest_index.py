"""Exact deduplication against a persistent index of digests.

The index is a catalog table over files of its own, bucketed and sorted by digest,
with one row per distinct text.  A note beside the files keeps the number of buckets
and the type of the ids, so any session finds the index again by its path.  New data
is deduplicated within itself, then by a sort-merge anti-join against the index,
whose side of the join is read bucket by bucket without a shuffle, and what is new
is appended.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.tables import heavy_keys, lower_az, text_or_empty, written
from changeflow.session import work_folder

#: The least number of buckets, and the rows of first data for which there is one more.
BUCKETS = 64
ROWS_PER_BUCKET = 4_000_000


def buckets_for(rows: int) -> int:
    return max(BUCKETS, -(-rows // ROWS_PER_BUCKET))


def with_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the SHA-256 of each text after lower-casing A-Z; null counts as empty."""
    digest = F.unhex(F.sha2(lower_az(text_or_empty(text_col)), 256))
    return docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest"))


class DigestIndex:
    """A persistent index under a path of the shared file system: which row of each distinct text stays.

    ``buckets`` counts for a new index only; an existing one keeps its number.  The
    note is written before the first rows, so a first append that failed leaves an
    empty index, and one that is done again finds what has landed and adds the rest.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS) -> None:
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        note = self._note()
        if note is not None:
            self._register(*note)

    def _note(self) -> tuple[int, str] | None:
        try:
            row = self.spark.read.schema("buckets int, id_type string").parquet(f"{self.path}/note").first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return None if row is None else (row.buckets, row.id_type)

    def _register(self, buckets: int, id_type: str) -> None:
        """Makes the files known to the session's catalog, under a name of this object."""
        self.buckets = buckets
        self.spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id {id_type}) USING parquet CLUSTERED BY (digest) "
            f"SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}/rows'"
        )

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def append_new(self, digests: DataFrame) -> None:
        """Appends the digests that the index lacks, each with its largest ``doc_id``.

        ``digests`` has ``doc_id`` and ``digest``.  Of a text that is in the index
        already the earlier row stays, so deliveries rank before ids.  A text
        whose ids are all null is entered with a null id.  One writer at a time.
        """
        if not self.exists():
            id_type = digests.schema["doc_id"].dataType.simpleString()
            note = self.spark.createDataFrame([(self.buckets, id_type)], "buckets int, id_type string")
            note.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/note")
            self._register(self.buckets, id_type)
        new = digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"))
        new = new.join(self.read().select("digest").hint("merge"), "digest", "left_anti")
        # Each bucket comes to one task, so an append adds a file per bucket.
        bucket = F.pmod(F.hash("digest"), F.lit(self.buckets))
        (
            new.repartitionById(self.buckets, bucket)
            .write.mode("append").format("parquet")
            .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table)
        )

    def close(self) -> None:
        """Takes the name out of the catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")


def duplicates(digests: DataFrame, index: DataFrame) -> DataFrame:
    """Each row with the row that stays and the number of rows of equal text.

    A text with more than a thousandth of all rows would gather in one task of
    a join; there are fewer than a thousand of them, so these are broadcast, and
    the rest meets by sort-merge joins.
    """
    heavy = written(heavy_keys(digests, "digest"), "heavy-digests")
    heavy_kept = heavy.join(index.hint("merge"), "digest").select(
        "digest", F.col("n").alias("group_size"), "keep_id"
    )
    hot = digests.join(F.broadcast(heavy_kept), "digest")
    rest = digests.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    sizes = rest.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    cold = rest.join(sizes.hint("merge"), "digest").join(index.hint("merge"), "digest")
    columns = ["doc_id", "digest", "keep_id", "group_size"]
    return hot.select(columns).unionByName(cold.select(columns))


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", deliveries: int = 2,
    index: DigestIndex | None = None,
) -> DataFrame:
    """Which rows stay when only the largest id of equal texts does.

    The rows arrive at a new index in ``deliveries`` ranges of ids, largest ids
    first, so that the first entry of a text has its largest id; ids that are no
    whole numbers, texts for one, arrive at once and rank by their own order.  With an
    ``index`` of earlier data they arrive there at once, and a text known to it
    keeps its earlier row.

    One row per row of ``docs``: doc_id, keep_id, group_size (rows of equal text
    in ``docs``), kept, text_sha256.  Null text counts as empty.  A null id ranks
    below every other; a group of null ids has a null keep_id and is kept.
    Repeated rows have the same answer each.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    digests = written(with_digest(docs, id_col, text_col), "digests")
    if index is not None:
        own = index
        own.append_new(digests)
    else:
        low, high, rows = digests.agg(F.min("doc_id"), F.max("doc_id"), F.count(F.lit(1))).first()
        own = DigestIndex(spark, work_folder(spark, "digest-index"), buckets_for(rows))
        whole_numbers = isinstance(digests.schema["doc_id"].dataType, T.IntegralType)
        deliveries = deliveries if whole_numbers and low is not None else 1
        edges = [low + (high - low + 1) * i // deliveries for i in range(1, deliveries)]
        place = F.lit(0)
        for edge in edges:
            place = place + F.when(F.col("doc_id") >= edge, 1).otherwise(0)
        for i in reversed(range(deliveries)):
            own.append_new(digests.where(place == i))
    found = duplicates(digests, own.read())
    if index is None:
        own.close()  # the plan has the files; nobody else knows the name
    return found.select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that exact deduplication keeps, all columns as they are.

    Of rows with one id and equal texts one stays, whatever their other columns: the
    one whose JSON text is least, so that a second run keeps the same.  Extra
    columns may have any name.  Null ids and texts are as in :func:`exact_dedup`; an
    empty table gives no rows.
    """
    pair = F.struct(F.col("doc_id").alias("id"), F.unhex("text_sha256").alias("digest"))
    kept = exact_dedup(docs, id_col, text_col).where("kept").groupBy(pair.alias("pair")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    kept = written(kept, "kept-pairs")
    digest = F.unhex(F.sha2(lower_az(text_or_empty(text_col)), 256))
    packed = docs.select(
        F.struct(F.col(id_col).alias("id"), digest.alias("digest")).alias("pair"), F.struct("*").alias("row")
    )
    # Rows alone in their pair need no order; the others are few, or equal ones that combine before a shuffle.
    alone = packed.join(kept.where("rows = 1"), "pair", "left_semi").select("row")
    several = packed.join(kept.where("rows > 1"), "pair", "left_semi")
    first = several.groupBy("pair").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return alone.unionByName(first.select("row")).select("row.*")
