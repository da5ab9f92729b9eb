"""Exact dedup with a log-structured merge index of text digests, on DataFrame functions only.

The index is a folder that outlives a call: batches are added to it one after the other.

* Memtables: each task's rows of a batch, sorted by digest and written as they are.
* Flush: memtables merge into one run of the index: (digest, keep_id, n), sorted, each digest once, with a bitmap filter of its
  digests beside it.  Partial aggregation comes before the shuffle, so a digest that a third of all rows carry costs
  no more than others.
* Levels: a run of MEMTABLE_ROWS * FANOUT ** k digests or more is on level k.  FANOUT runs of a level are compacted into one
  of the next: per digest the smallest doc_id and the number of rows stay.  ``manifest`` lists the runs of each version;
  a version is there as a whole or not at all.  A batch that is added twice counts twice.
* Look-up: a batch's digests probe the filter of each run, and only those that pass are joined with it.
* Verification: digests with several rows, in the batch or the index, are hits.  A bitmap filter of them picks their texts from the
  documents; grouping by the digest and the text itself compares bytes, and splits rows whose digests collide.
  Only texts of hits are shuffled.

Texts are equal when identical after each run of ASCII white space became one space; null
counts as empty.  The smallest doc_id of equal texts stays (null ids come last; in a
group of null ids each stays).  Repeated rows of one doc_id and text all count in
group_size and are all reported as kept; ``exact_dedup`` leaves one of them.  Empty tables
give empty results.  Extra columns are ignored by ``resolve`` and kept by ``exact_dedup``.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineflow.llm.shared import MAX_FILTER_BITS, cut, drop_rows, key_filter, lookup, remove, scratch, split_by_filter

WHITE = r"[\x20\x09-\x0D]+"
#: Digests of the smallest run of level 1, and how many runs of a level make one of the next.
MEMTABLE_ROWS = 1_000_000
FANOUT = 4
ENTRY = "digest binary, keep_id long, n long"
MANIFEST = "version long, level int, run string, digests long, bits long"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


def merged(rows: DataFrame) -> DataFrame:
    """(digest, keep_id, n) of rows or runs: the smallest identifier and the sum."""
    return rows.groupBy("digest").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))


@dataclass(frozen=True)
class Run:
    level: int
    run: str
    digests: int
    bits: int  # of its filter; 0: it has none


class Index:
    """A merge index in the folder ``path``, on a file system that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.version, self.levels = 0, []
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
        if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").collect()  # FANOUT runs a level at most
            self.version = max((r["version"] for r in rows), default=0)
            self.levels = [Run(*r[1:]) for r in rows if r["version"] == self.version]

    def entries(self, run: Run) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(f"{self.path}/runs/{run.run}")

    def write(self, entries: DataFrame, least: int = 0) -> Run:
        """A sorted run and its filter; it belongs to no version yet."""
        name = uuid.uuid4().hex
        entries.sortWithinPartitions("digest").write.parquet(f"{self.path}/runs/{name}")
        run = Run(least, name, self.spark.read.parquet(f"{self.path}/runs/{name}").count(), 0)
        level, size = least, MEMTABLE_ROWS * FANOUT ** (least + 1)
        while run.digests >= size:
            level, size = level + 1, size * FANOUT
        if run.digests * 2 > MAX_FILTER_BITS:  # a filter of that size would let nearly everything pass
            return Run(level, name, run.digests, 0)
        bits, size = key_filter(self.entries(run), F.xxhash64("digest"), run.digests)
        bits.write.parquet(f"{self.path}/filters/{name}")
        return Run(level, name, run.digests, size)

    def add(self, run: Run) -> None:
        """Put a run on its level, compact levels that are full, and make this the index's next version."""
        levels = [*self.levels, run]
        while full := [k for k in {r.level for r in levels} if sum(r.level == k for r in levels) >= FANOUT]:
            old = [r for r in levels if r.level == min(full)]
            one = self.write(merged(reduce(DataFrame.unionByName, map(self.entries, old))), min(full) + 1)
            levels = [r for r in levels if r not in old] + [one]
        rows = [(self.version + 1, r.level, r.run, r.digests, r.bits) for r in levels]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        gone = [r for r in self.levels if r not in levels]
        self.version, self.levels = self.version + 1, levels
        for r in gone:  # no version that anyone opens from now on names them
            remove(self.spark, f"{self.path}/runs/{r.run}")
            remove(self.spark, f"{self.path}/filters/{r.run}")

    def find(self, keys: DataFrame) -> DataFrame:
        """(digest, keep_id, n) of those of distinct ``keys`` that the index holds."""
        found = [self.spark.createDataFrame([], ENTRY)]
        for run in self.levels:
            maybe = keys.select("digest")
            if run.bits:
                bits = self.spark.read.schema("bucket long, bits binary").parquet(f"{self.path}/filters/{run.run}")
                maybe, _ = split_by_filter(maybe, F.xxhash64("digest"), bits, run.bits)
            found.append(self.entries(run).join(maybe, "digest", "left_semi"))
        return merged(reduce(DataFrame.unionByName, found))


def _texts(docs: DataFrame, keys: DataFrame, digest_bytes: int) -> DataFrame:
    """(doc_id, digest, key, norm) of the rows whose key may be among ``keys``."""
    bits, size = key_filter(keys, F.xxhash64("key"), keys.count())
    rows = docs.select(F.col("doc_id").cast("long"), normalised(F.col("text")).alias("norm"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("norm", 256)))
    rows = rows.withColumn("key", F.substring("digest", 1, digest_bytes))
    return split_by_filter(rows, F.xxhash64("key"), cut(bits), size)[0]


def _kept_texts(earlier: DataFrame, known: DataFrame) -> DataFrame:
    """(digest, norm) of the documents that the index keeps for ``known`` digests."""
    bits, size = key_filter(known, F.xxhash64("keep_id"), known.count())
    rows = earlier.select(F.col("doc_id").cast("long"), "text")
    maybe, _ = split_by_filter(rows, F.xxhash64("doc_id"), cut(bits), size)
    maybe = maybe.select("doc_id", normalised(F.col("text")).alias("norm")).withColumn("digest", F.unhex(F.sha2("norm", 256)))
    met = maybe["doc_id"].eqNullSafe(known["keep_id"]) & (maybe["digest"] == known["digest"])
    return maybe.join(known, met, "left_semi").select("digest", "norm").distinct()


def resolve(docs: DataFrame, index: str | None = None, earlier: DataFrame | None = None, digest_bytes: int = 32) -> DataFrame:
    """One row per row of ``docs``: doc_id, digest, keep_id, group_size, kept, against all batches of the index so far.

    ``index`` is the folder of an index that goes on (None: a new one).  ``earlier`` has the documents of its earlier batches, whose
    texts are compared.  ``digest_bytes`` shortens the keys that hits are searched by; shorter ones collide, results stay the same.
    """
    spark = docs.sparkSession
    index = Index(spark, index or scratch(spark, "lsm"))
    memtables = f"{index.path}/memtables/{index.version + 1}-{uuid.uuid4().hex}"
    rows = docs.select(digest(F.col("text")).alias("digest"), F.col("doc_id").cast("long"))
    rows.sortWithinPartitions("digest", "doc_id").write.parquet(memtables)
    rows = spark.read.schema("digest binary, doc_id long").parquet(memtables)
    run = index.write(merged(rows.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("n"))))
    batch = index.entries(run)
    known = cut(index.find(batch)) if index.levels else None
    if known is not None and known.isEmpty():
        known = None
    rows = rows.withColumn("key", F.substring("digest", 1, digest_bytes))
    total = rows.count()
    by_key = batch.groupBy(F.substring("digest", 1, digest_bytes).alias("key")).agg(F.sum("n").alias("n"))
    keys = by_key.filter("n > 1").select("key")
    if known is not None:
        if earlier is None:
            raise ValueError("the index has copies of these documents: give the earlier documents to compare their texts")
        keys = keys.unionByName(known.select(F.substring("digest", 1, digest_bytes).alias("key"))).distinct()
    maybe = _texts(docs, cut(keys), digest_bytes)
    classes = maybe.groupBy("key", "norm").agg(F.first("digest").alias("digest"), F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    if known is not None:
        same = _kept_texts(earlier, known).join(known, "digest").select("digest", "norm", F.col("keep_id").alias("old_id"), F.col("n").alias("old_n"))
        classes = classes.join(same, ["digest", "norm"], "left").select(
            "key", "norm", "digest", F.least("keep_id", "old_id").alias("keep_id"), (F.col("n") + F.coalesce("old_n", F.lit(0))).alias("n")
        )
    table = classes.groupBy("key").agg(F.count("*").alias("texts"), F.min("keep_id").alias("keep_id"), F.sum("n").alias("n"))
    table = cut(table.filter("texts > 1 or n > 1"))
    clashing = table.filter("texts > 1").select("key")
    told = lookup(rows, table.filter("texts = 1").select("key", "keep_id", "n"), "key", total)
    if clashing.isEmpty():
        found = told
    else:  # keys that different texts share: their rows are told apart by the bytes
        found = told.join(clashing, "key", "left_anti")
        classes = classes.drop("digest").join(clashing, "key", "left_semi")
        split = maybe.join(clashing, "key", "left_semi").join(classes, ["key", "norm"])
        found = found.unionByName(split.select(*told.columns))
    index.add(run)
    keep = F.coalesce("keep_id", "doc_id")
    return found.select(
        "doc_id",
        "digest",
        keep.alias("keep_id"),
        F.coalesce("n", F.lit(1).cast("long")).alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
    )


def exact_dedup(docs: DataFrame, index: str | None = None, earlier: DataFrame | None = None) -> DataFrame:
    """``docs`` with one row of each group of equal texts: that with the smallest doc_id, unless the index has a smaller one."""
    found = cut(resolve(docs, index, earlier).filter("group_size > 1"))
    keyed = found.select("doc_id", F.col("digest").alias("text_key"), "kept")
    gone = keyed.filter("not kept").select("doc_id", "text_key", F.lit(False).alias("spare")).distinct()
    again = keyed.filter("kept").groupBy("doc_id", "text_key").count().filter("count > 1")
    again = again.select("doc_id", "text_key", F.lit(True).alias("spare"))
    return drop_rows(docs, gone.unionByName(again), digest(F.col("text")))
