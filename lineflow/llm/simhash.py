"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most three bits have a point between them at most
one step from one and two steps from the other.  So every fingerprint emits the points
within one step, and those of odd parity also points two steps away; equal points meet
in a shuffle, and a meeting is a link by itself:

* distance 1 or 2: both reach a common point in one step each;
* distance 3: the parities differ.  Of the three bits two lie in the same half of the
  word; the odd one flips these two, the even one the third.  Hence the odd one needs
  only the 2 * C(32, 2) = 992 pairs within a half.

At one point meet at most 65 + 992 different fingerprints, so no group is unbounded.
A link joins each of them to the smallest fingerprint that is one step away; all of
these links are within three bits (they are checked again), and they connect the same
classes as all pairs would.

Fingerprints that cannot have a partner are set aside first, at 35 keys each: cut in
seven blocks, two fingerprints within three bits agree on four blocks at least.  That saves work only: of some 3e9
random fingerprints (2**36.6 / 35) most agree with another one by chance, and then nearly all emit their points.

Null and empty texts have fingerprint zero and link like any other.  Repeated rows are
repeated in the result.  A null doc_id counts as larger than any other; a class of null
ids only has a null component_id.  Extra columns are ignored by ``components`` and kept
by ``near_dedup``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineflow.llm.shared import cut, drop_rows, lookup, text_batches

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Bytes of a text whose shingles are counted at once, up to the end of the word there.
AT_ONCE = 1 << 18
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _parts(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text in parts; each starts with the last SHINGLE - 1 words of the part before."""
    start, last = 0, []
    while start < len(data):
        end = _BLANK.search(data, start + AT_ONCE)
        end = end.start() if end else len(data)
        words = last + data[start:end].split()
        yield words
        start, last = end, words[-(SHINGLE - 1) :]


def _ones(words: list[bytes]) -> tuple[np.ndarray, int]:
    """How many shingles have each bit set, and how many there are."""
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    k = min(SHINGLE, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8")
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64), len(hashes)


def fingerprint(text: str | None) -> int:
    """SimHash of the word shingles of ``text`` as a signed 64-bit integer."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z and ASCII white space only
    ones, count = np.zeros(64, np.int64), 0
    short: list[bytes] = []  # a text of fewer words than a shingle has one shingle, all of it
    for words in _parts(data):
        if len(words) < SHINGLE:
            short = words
            continue
        own, n = _ones(words)
        ones, count, short = ones + own, count + n, []
    if short and not count:
        ones, count = _ones(short)
    bits = np.packbits(2 * ones > count, bitorder="little") if count else np.zeros(8, np.uint8)
    return int(bits.view("<i8")[0])


def _fingerprints(batches):
    for batch in batches:
        text = batch.column("text")
        fps = pa.array((fingerprint(t.as_py()) for t in text), pa.int64(), size=len(text))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), fps], ["doc_id", "text_key", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp) of each row; text_key is a 64-bit hash of the text."""
    text_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    return rows.mapInArrow(_fingerprints, "doc_id long, text_key long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks() -> tuple[list[int], list[int]]:
    near = [0, *(_signed(1 << i) for i in range(64))]
    far = [_signed(1 << i | 1 << j) for half in (range(32), range(32, 64)) for i, j in combinations(half, 2)]
    return near, far


def _block_keys() -> list[int]:
    """Masks of four of seven blocks (of 9 or 10 bits)."""
    edges = [round(i * 64 / 7) for i in range(8)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [_signed(sum(chosen)) for chosen in combinations(blocks, 7 - RADIUS)]


def _longs(values: list[int]):
    return F.array(*(F.lit(v).cast("long") for v in values))


def with_partners(fps: DataFrame) -> DataFrame:
    """Of distinct ``fp``, those that agree with another one on four of seven blocks, and few others.

    Keys are hashed with the number of their blocks; where hashes of different keys are equal, more stay, never fewer.
    """
    key = F.xxhash64("table", F.col("fp").bitwiseAND(F.col("mask"))).alias("key")
    keyed = fps.select("fp", F.posexplode(_longs(_block_keys())).alias("table", "mask")).select(key, "fp")
    shared = keyed.groupBy("key").agg(F.min("fp").alias("low"), F.max("fp").alias("high"), F.count("*").alias("n"))
    shared = cut(shared.filter("low <> high").select("key", "n"))
    return lookup(keyed, shared, "key", len(_block_keys()) * fps.count()).filter("n is not null").select("fp").distinct()


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b), b < a or b > a, of distinct ``fp``: enough to connect all within RADIUS bits."""
    near, far = _masks()
    one = fps.select("fp", F.explode(_longs(near)).alias("mask"), F.lit(True).alias("near"))
    odd = fps.filter(F.bit_count("fp") % 2 == 1)
    two = odd.select("fp", F.explode(_longs(far)).alias("mask"), F.lit(False).alias("near"))
    points = one.unionByName(two).select(F.col("fp").bitwiseXOR(F.col("mask")).alias("point"), "fp", "near")
    met = points.groupBy("point").agg(
        F.min(F.when(F.col("near"), F.col("fp"))).alias("b"), F.collect_list("fp").alias("all")
    )
    met = met.filter(F.col("b").isNotNull() & (F.size("all") > 1))
    pairs = met.select(F.explode("all").alias("a"), "b").filter("a <> b").distinct()
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round of large-star or small-star over edges (a, b)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if not large:
        both = both.filter("b < a")
    both = cut(both)
    least = both.groupBy("a").agg(F.min("b").alias("least"), F.count("*").alias("n"))
    least = least.withColumn("least", F.least("a", "least"))
    told = lookup(both, cut(least), "a", both.count())
    moved = told.filter("b > a") if large else told
    out = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not large:
        out = out.unionByName(told.select("a", F.col("least").alias("b")))
    return out.filter("a <> b").distinct()


def _is_star(edges: DataFrame) -> bool:
    """Whether each node of edges (a, b) has one b, and no b is an a: then these are the classes."""
    least = edges.select(F.col("b").alias("a"))
    return edges.groupBy("a").count().filter("count > 1").isEmpty() and edges.join(least, "a", "left_semi").isEmpty()


def connect(edges: DataFrame) -> DataFrame:
    """(a, least): the least node reachable from each node ``a`` that isn't itself the least.

    Alternating large-star and small-star rounds; each cuts its lineage, and their number
    grows with the logarithm of the longest chain.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _is_star(edges):
        edges = cut(_star(_star(edges, True), False))
    return edges.select("a", F.col("b").alias("least"))


def _classes(prints: DataFrame) -> DataFrame:
    """(fp, root, component_id, n) of each distinct fingerprint; root names the class by its least fingerprint."""
    own = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n")))
    least = connect(links(cut(with_partners(own.select("fp")))))
    told = own.join(least, own["fp"] == least["a"], "left").select(
        "fp", "least_id", "n", F.coalesce("least", "fp").alias("root")
    )
    roots = told.groupBy("root").agg(F.min("least_id").alias("component_id"), F.count("*").alias("members"))
    told, roots = cut(told), cut(roots)
    return lookup(told, roots, "root", told.count(), "members").select("fp", "root", "component_id", "n")


def _told(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, fp, root, component_id) of each row of ``docs``."""
    prints = cut(fingerprints(docs))
    return lookup(prints, cut(_classes(prints)), "fp", prints.count())


def components(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id."""
    return _told(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: that with the smallest doc_id.

    Of rows of a component with this same id, the one with the least hash of its text stays.
    """
    found = cut(_told(docs))
    least = F.col("doc_id").eqNullSafe(F.col("component_id"))
    gone = found.filter(~least).select("doc_id", "text_key", F.lit(False).alias("spare")).distinct()
    stay = found.filter(least)
    again = stay.groupBy("doc_id", "root").agg(F.min("text_key").alias("first"), F.count("*").alias("n"))
    again = cut(again.filter("n > 1").select("doc_id", "root", "first"))
    if not again.isEmpty():
        rows = stay.join(again, ["doc_id", "root"])
        spare = (F.col("text_key") == F.col("first")).alias("spare")
        gone = gone.unionByName(rows.select("doc_id", "text_key", spare).distinct())
    return drop_rows(docs, gone, F.xxhash64("text"))
