"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every word sequence of every item.  Document words stream through
it; at each word it gives the longest match that ends there.  Matches of WINDOW words or
more, and whole items of fewer words, are hits.  The automaton of up to SHARD_WORDS item
words is built once per Python worker from a broadcast of that size; benchmarks beyond it
are cut into shards (long items with WINDOW - 1 words of overlap), documents are streamed
once per shard, and only documents with hits are joined.

Words are runs of letters a-z (A-Z lower-cased), digits and non-ASCII characters.  Null and
empty texts have no words and no hits; null and empty items have no windows.  Items with
the same item_id count once; a null item_id counts as an empty string.  Repeated document
rows are repeated in the result.  An empty benchmark hits nothing.  Extra columns are
ignored by ``hits`` and kept by ``decontaminate``.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from lineflow.llm.shared import cut, fresh, held, own, text_batches

WINDOW = 10
#: Item words in one automaton: about 1 kB each in a worker.
SHARD_WORDS = 100_000
#: Words of an item that stay together.
PIECE_WORDS = 5_000
#: Documents of which more than this share is hit are dropped whole.
MOST_HIT = 0.5

_SPLIT = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_SPLIT).split()


class Automaton:
    """Suffix automaton of many word sequences; each belongs to an item name."""

    def __init__(self, sequences: Iterable[tuple[str, list[bytes], bool]]):
        """``sequences``: (item, words, whole); only whole items count when shorter than WINDOW."""
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        sequences = list(sequences)
        for _, seq, _ in sequences:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        self.window: list[int] = [0] * len(self.next)  # state of the match's last WINDOW words
        self.whole: list[int] = [0] * len(self.next)  # nearest state that ends a short item
        self.items: dict[int, set[str]] = {}
        self.short: dict[int, dict[int, set[str]]] = {}
        for item, seq, whole in sequences:
            if whole and len(seq) < WINDOW:
                s = 0
                for w in seq:
                    s = self.next[s][w]
                self.short.setdefault(s, {}).setdefault(len(seq), set()).add(item)
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            up = self.link[s]
            if self.length[s] >= WINDOW:
                self.window[s] = s if self.length[up] < WINDOW else self.window[up]
            self.whole[s] = s if s in self.short else self.whole[up]
        for item, seq, _ in sequences:
            s = 0
            for i, w in enumerate(seq):
                s = self.next[s][w]
                if i >= WINDOW - 1:
                    self.items.setdefault(self.window[s], set()).add(item)

    def _state(self, length: int, link: int, follow: dict[bytes, int]) -> int:
        self.next.append(follow)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, w: bytes, q: int) -> int:
        """A copy of ``q`` for the strings that reach it from ``p`` in one step."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, w: bytes) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new

    def scan(self, text: list[bytes]) -> tuple[list[int], list[int], set[str]]:
        """Spans [start, end) of hit words, sorted and apart, and the items whose windows occur."""
        follow, link, length, window, whole = self.next, self.link, self.length, self.window, self.whole
        spans: list[list[int]] = []
        found: set[int] = set()
        items: set[str] = set()
        state = size = 0
        for i, w in enumerate(text):
            to = follow[state].get(w)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = follow[state].get(w)
            if to is None:
                continue
            state, size = to, size + 1
            hit = 0
            if size >= WINDOW:
                found.add(window[state])
                hit = size
            s = whole[state]
            while s:
                for n, names in self.short[s].items():
                    if n <= size:
                        items |= names
                        hit = max(hit, n)
                s = whole[link[s]]
            if hit:
                start = i + 1 - hit
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append([start, i + 1])
        for s in found:
            items |= self.items[s]
        return [s for s, _ in spans], [e for _, e in spans], items


def _automaton(name: str, sent: Broadcast) -> Automaton:
    """The automaton of a broadcast shard, built once in this Python worker."""
    return held(f"automaton {name}", lambda: Automaton(sent.value))


def _shards(benchmark: DataFrame) -> Iterator[list[tuple[str, list[bytes], bool]]]:
    """Item pieces by shard: of each, (item, words, whole).

    A shard is what one automaton holds; it is collected by itself.  Pieces are dealt to
    shards by a hash, so that shards are about even.
    """

    def pieces(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = words(text)
                step = PIECE_WORDS - WINDOW + 1
                for i in range(0, max(1, len(found) - WINDOW + 1), step) if found else ():
                    rows.append((item, i, found[i : i + PIECE_WORDS], len(found) <= PIECE_WORDS))
            names = ["item", "at", "words", "whole"]
            kinds = [pa.string(), pa.int64(), pa.list_(pa.binary()), pa.bool_()]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    cuts = cut(rows.mapInArrow(pieces, "item string, at long, words array<binary>, whole boolean").distinct())
    total = cuts.agg(F.sum(F.size("words"))).first()[0] or 0
    n = -(-total // SHARD_WORDS) or 1
    shard = F.pmod(F.xxhash64("item", "at"), F.lit(n))
    for k in range(n):
        part = cuts.filter(shard == k).orderBy("item", "at").toLocalIterator()
        yield [(r["item"], [bytes(w) for w in r["words"]], r["whole"]) for r in part]


def _digest_of(spans: list[tuple[int, int]], items: set[str]) -> tuple[int, int, str]:
    """n_hit, n_items, items_sha256 of spans that are apart."""
    sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return sum(b - a for a, b in spans), len(items), sha


def _cut_out(text: str, starts: list[int], ends: list[int]) -> str:
    """``text`` without the words of the spans and what lies between them."""
    at = np.array([m.span() for m in _WORD.finditer(text)])
    kept, last = [], 0
    for a, b in zip(starts, ends, strict=True):
        kept.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return "".join([*kept, text[last:]])


INTS = T.ArrayType(T.IntegerType())
DIGEST = {"starts": INTS, "ends": INTS, "n_hit": T.LongType(), "n_items": T.LongType(), "items_sha256": T.StringType()}
FOUND = DIGEST | {"n_words": T.LongType(), "items": T.ArrayType(T.StringType()), "clean": T.StringType()}
_ARROW = {T.LongType(): pa.int64(), T.StringType(): pa.string(), INTS: pa.list_(pa.int32())}


def _struct(kinds: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


def _arrow(kinds: dict[str, T.DataType], rows: list[tuple]) -> pa.StructArray:
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    arrays = [pa.array(c, _ARROW.get(k, pa.list_(pa.string()))) for c, k in zip(columns, kinds.values(), strict=True)]
    return pa.StructArray.from_arrays(arrays, list(kinds))


def _scanner(docs: DataFrame, shard: list[tuple[str, list[bytes], bool]]):
    """A column function: all of FOUND for a text, in one pass of one Python worker; clean is null where nothing is hit."""
    text_batches(docs.sparkSession)
    name, sent = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(shard)

    @arrow_udf(_struct(FOUND))
    def scan(text: pa.Array) -> pa.Array:
        walk, rows = _automaton(name, sent).scan, []
        for t in text:
            own = t.as_py()
            w = words(own)
            starts, ends, items = walk(w)
            told = _digest_of(list(zip(starts, ends, strict=True)), items)
            rows.append((starts, ends, *told, len(w), list(items), _cut_out(own, starts, ends) if starts else None))
        return _arrow(FOUND, rows)

    return scan.asNondeterministic(), sent  # else Spark may run it once more for a filter


@arrow_udf(_struct(DIGEST))
def _digest(starts: pa.Array, ends: pa.Array, items: pa.Array) -> pa.Array:
    """Spans of several shards put together."""
    rows = []
    for s, e, names in zip(starts.to_pylist(), ends.to_pylist(), items.to_pylist(), strict=True):
        spans: list[list[int]] = []
        for a, b in sorted(zip(s, e, strict=True)):
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(b, spans[-1][1])
            else:
                spans.append([a, b])
        rows.append(([a for a, _ in spans], [b for _, b in spans], *_digest_of(spans, set(names))))
    return _arrow(DIGEST, rows)


@arrow_udf(T.StringType())
def _without(text: pa.Array, starts: pa.Array, ends: pa.Array) -> pa.Array:
    rows = zip(text.to_pylist(), starts.to_pylist(), ends.to_pylist(), strict=True)
    return pa.array([_cut_out(t, s, e) if s else None for t, s, e in rows], pa.string())


def _with_hits(docs: DataFrame, benchmark: DataFrame, hits: str) -> DataFrame:
    """``docs`` with a struct column ``hits``: n_words, DIGEST and clean (the text without hits, null if there are none).

    Of a benchmark of several shards, each but the first is sent, streamed past and given up before the next one.
    """
    shards, name = _shards(benchmark), fresh(docs)
    scan, _ = _scanner(docs, next(shards))
    scanned, doc, key, digest = map(name, ("scan", "doc", "key", "digest"))
    rows = docs.withColumn(scanned, scan("text"))
    kinds = {"starts": "array<int>", "ends": "array<int>", "items": "array<string>"}
    found = None
    for shard in shards:
        other, sent = _scanner(docs, shard)
        part = docs.select("doc_id", "text", other("text").alias("more")).filter(F.size("more.starts") > 0)
        part = part.select(F.col("doc_id").alias(doc), F.xxhash64("text").alias(key), *(f"more.{x}" for x in kinds))
        part = cut(part.dropDuplicates([doc, key]))
        sent.destroy()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select(*own(docs), F.col(scanned).alias(hits))
    found = found.groupBy(doc, key).agg(*(F.flatten(F.collect_list(x)).alias(name(x)) for x in kinds))
    met = F.col("doc_id").eqNullSafe(F.col(doc)) & F.xxhash64("text").eqNullSafe(F.col(key))
    rows = rows.join(cut(found), met, "left")
    every = [F.concat(F.col(f"{scanned}.{x}"), F.coalesce(F.col(name(x)), F.array().cast(k))) for x, k in kinds.items()]
    rows = rows.withColumn(digest, _digest.asNondeterministic()(*every))
    clean = _without(F.col("text"), F.col(f"{digest}.starts"), F.col(f"{digest}.ends")).alias("clean")
    told = [F.col(f"{scanned}.n_words").alias("n_words"), *(F.col(f"{digest}.{x}").alias(x) for x in DIGEST), clean]
    return rows.select(*own(docs), F.struct(*told).alias(hits))


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans of hit words."""
    rows = _with_hits(docs.select("doc_id", "text"), benchmark, "hits")
    return rows.select(
        "doc_id",
        *(f"hits.{x}" for x in ("n_words", "n_hit", "n_items", "items_sha256")),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
        F.arrays_zip(F.col("hits.starts").alias("start"), F.col("hits.ends").alias("end")).alias("spans"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, most_hit: float = MOST_HIT) -> DataFrame:
    """``docs`` without hit spans; documents of which more than ``most_hit`` is hit are dropped.

    ``n_chars``, if there, follows the text where a span was removed.
    """
    hits = fresh(docs)("hits")
    rows = _with_hits(docs, benchmark, hits)
    share = F.col(f"{hits}.n_hit") / F.greatest(F.col(f"{hits}.n_words"), F.lit(1))
    rows = rows.filter(share <= most_hit)
    rows = rows.withColumn("text", F.coalesce(F.col(f"{hits}.clean"), F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col(f"{hits}.n_hit") > 0, F.char_length("text").cast(kind)).otherwise(F.col("n_chars")))
    return rows.select(*own(docs))
