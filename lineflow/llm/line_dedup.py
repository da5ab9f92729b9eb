"""Line dedup by winnowing over line hashes, on DataFrame functions only.

Lines are compared by 64-bit hashes, without white space at their ends and with other runs of it as one blank;
blank lines are left out of all counts.

1. Fingerprints: of each WINDOW neighbouring hashes of line pairs, the smallest (the last one, if equal).  Any run
   of PAIR + WINDOW - 1 = 3 lines that occurs twice shares one for sure.  Each line of LONG words or more is one by itself.
2. Positions: only places of fingerprints that occur more than once go on (a bitmap of these picks them).
3. Extension: at each place the fingerprint is extended by the line before or behind, whichever its window holds, and
   each extended fingerprint has a first occurrence of its own, in the order of (doc_id, text, place).  Longer
   runs are chains of these: overlapping ones are joined, so a match reaches as far both ways as lines are equal
   to any earlier place, not only to one partner.
4. The lines of such runs are deleted from the later place.

So exactly the lines of all runs of three lines or more that occurred before, and long lines that did, go.  A short line
that recurs by itself ("Yes."), or a run of two, stays.  Everything grows with the number of lines; no two arrays of hashes
are compared.

Only hashes are shuffled until texts of documents with runs are rewritten.  Extended fingerprints that many rows
share are broadcast (at most HOT_KEYS keys).

Null and empty texts have no lines and stay as they are.  A document is a doc_id with a text: different texts of one id, or of
a null id, are judged each, in the order of a hash of the text; null ids come last.  Rows repeated with id
and text are one document and are rewritten alike (exact dedup drops them).  Extra columns are ignored by ``runs`` and
kept by ``line_dedup``, but for a column ``removed``, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineflow.llm.shared import cut, fresh, key_filter, lookup, own, split_by_filter

PAIR = 2
WINDOW = 2
LONG = 25
LAST_ID = (1 << 63) - 1


def _lines(text: Column) -> Column:
    """All lines of a text in the form in which they are compared."""
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n", -1),
        lambda x: F.trim(F.regexp_replace(x, r"[\x20\x09-\x0D]+", " ")),
    )


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))


def _hashed(docs: DataFrame) -> DataFrame:
    """doc, text_key, hashes of the lines that aren't blank, and which of them are long."""
    rows = docs.select(_doc().alias("doc"), F.xxhash64("text").alias("text_key"), _lines(F.col("text")).alias("lines"))
    rows = rows.withColumn("lines", F.filter("lines", lambda x: x != ""))
    long = F.transform("lines", lambda x: F.size(F.split(x, " ")) >= LONG)
    return rows.select("doc", "text_key", F.transform("lines", lambda x: F.xxhash64(x)).alias("h"), long.alias("long"))


def _places(n: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: i < n)


def _long_print(i: Column) -> Column:
    return F.xxhash64(F.get("h", i), F.lit("long"))


def _long_places() -> Column:
    return F.filter(_places(F.size("h")), lambda i: F.coalesce(F.get("long", i), F.lit(False)))


def _fingerprints(rows: DataFrame) -> DataFrame:
    """(print) of each selected place: window minima, and long lines."""
    n = F.size("h")
    pairs = F.transform(_places(n - 1), lambda i: F.xxhash64(F.get("h", i), F.get("h", i + 1)))
    rows = rows.withColumn("p", pairs)
    least = lambda i: F.when(F.get("p", i + 1) <= F.get("p", i), i + 1).otherwise(i)
    chosen = F.array_distinct(F.transform(_places(F.size("p") - WINDOW + 1), least))
    two = F.transform(chosen, lambda i: F.get("p", i))
    return rows.select(F.explode(F.concat(two, F.transform(_long_places(), _long_print))).alias("print"))


def _extended(rows: DataFrame) -> DataFrame:
    """(doc, text_key, print, key, at, lines): each window's fingerprint, and it with the window's other line; long lines."""

    def three(i: Column) -> Column:
        x, y, z = (F.get("h", i + k) for k in range(3))
        a, b = F.xxhash64(x, y), F.xxhash64(y, z)
        key = F.when(b <= a, F.xxhash64(x, b, F.lit("before"))).otherwise(F.xxhash64(a, z, F.lit("behind")))
        return F.struct(F.least(a, b).alias("print"), key.alias("key"), i.alias("at"), F.lit(3).alias("lines"))

    one = lambda i: F.struct(_long_print(i).alias("print"), _long_print(i).alias("key"), i.alias("at"), F.lit(1).alias("lines"))
    every = F.concat(F.transform(_places(F.size("h") - 2), three), F.transform(_long_places(), one))
    return rows.select("doc", "text_key", F.explode(every).alias("f")).select("doc", "text_key", "f.*")


def _spans(rows: DataFrame) -> DataFrame:
    """(doc, text_key, start, last) of each extended fingerprint that occurred before."""
    again = cut(_fingerprints(rows).groupBy("print").count().filter("count > 1").select("print"))
    bits, size = key_filter(again, F.col("print"), again.count())
    met, _ = split_by_filter(_extended(rows), F.col("print"), cut(bits), size)
    met = cut(met.drop("print"))
    place = F.struct("doc", "text_key", "at")
    first = met.groupBy("key").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    met = lookup(met, cut(first.filter("n > 1")), "key", met.count()).filter(place > F.col("first"))
    return met.select("doc", "text_key", F.col("at").alias("start"), (F.col("at") + F.col("lines") - 1).alias("last"))


def runs(docs: DataFrame) -> DataFrame:
    """(doc, text_key, spans, removed): which lines, counted without blank ones, are later repeats."""
    spans = _spans(cut(_hashed(docs)))
    in_order = Window.partitionBy("doc", "text_key").orderBy("start", "last")  # a document's own spans
    reached = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.distinct().withColumn("reached", reached)
    apart = F.when(F.col("start") <= F.col("reached") + 1, 0).otherwise(1)
    spans = spans.withColumn("island", F.sum(apart).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("doc", "text_key", "island").agg(F.min("start").alias("start"), F.max("last").alias("last"))
    return spans.groupBy("doc", "text_key").agg(
        F.array_sort(F.collect_list(F.struct("start", "last"))).alias("spans"),
        F.sum(F.col("last") - F.col("start") + 1).cast("int").alias("removed"),
    )


def line_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``removed`` (number of lines), and texts without later repeats."""
    found = cut(runs(docs))
    if "removed" in docs.columns:
        docs = docs.drop("removed")
    columns = [*docs.columns, "removed"]
    none = F.lit(0).alias("removed")
    count = found.count()
    if not count:
        return docs.select(*own(docs), none)
    bits, size = key_filter(found, F.xxhash64("doc", "text_key"), count)
    maybe, clear = split_by_filter(docs, F.xxhash64(_doc(), F.xxhash64("text")), cut(bits), size)
    name = fresh(docs)
    doc, key, spans, removed, lines, real, gone = map(name, ("doc", "key", "spans", "removed", "lines", "real", "gone"))
    told = found.toDF(doc, key, spans, removed)
    rows = maybe.join(told, (_doc() == F.col(doc)) & (F.xxhash64("text") == F.col(key)), "left")
    rows = rows.withColumn(lines, _lines(F.col("text")))
    rows = rows.withColumn(real, F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i) != ""))
    place = lambda k: F.get(real, k.cast("int"))
    rows = rows.withColumn(gone, F.flatten(F.transform(spans, lambda s: F.sequence(place(s["start"]), place(s["last"])))))
    raw = F.arrays_zip(F.split("text", "\n", -1).alias("raw"), F.col(lines).alias("line"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.filter(gone, lambda i: F.get(lines, i) != ""))
    rows = rows.withColumn(gone, stay).withColumn(lines, raw)
    kept = F.array_join(F.transform(gone, lambda i: F.get(lines, i)["raw"]), "\n")
    rows = rows.select(
        *own(docs, "text"),
        F.when(F.col(spans).isNull(), F.col("text")).otherwise(kept).alias("text"),
        F.coalesce(removed, F.lit(0)).alias("removed"),
    )
    pick = [F.col("`" + c.replace("`", "``") + "`") for c in columns]
    return clear.select(*own(docs), none).unionByName(rows.select(*pick))
