"""Language identification by rank-order profiles of character n-grams.

A profile is the TOP most frequent n-grams (1 to 3 characters) in order.  A document gets the
language whose profile has the smallest out-of-place distance: the sum over the document's
own top n-grams of how far each stands from its place in the profile, TOP where it is absent.

Letters are lower-cased, runs of anything else count as one blank, and n-grams have blanks at
their ends only.  Equal counts are ordered by code point, equal distances by language
name.  Profiles are learned from rows with a language whose crc32(doc_id as text) mod 5 is
not 0, about MOST_EACH of each language at most (those with the least hashes of their id).
A prediction reads the text only.

Null texts and texts without letters give ``und`` with score 0, and so does everything where
no language is known.  A null doc_id counts as held out.  Repeated rows are repeated in the
result.  Extra columns are ignored.
"""

from __future__ import annotations

import uuid
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from lineflow.llm.shared import held, text_batches

TOP = 300
#: Documents of a language that its profile is learned from, in expectation.
MOST_EACH = 10_000
#: Languages that have a profile: those with most documents, should the column hold more values.
MOST_LANGUAGES = 1000
#: Characters whose n-grams are counted at once while learning.
AT_ONCE = 2_000_000
UNKNOWN = "und"
_BLANK = 0x20


@cache
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(text: str | None) -> np.ndarray:
    """Codes of all n-grams: 21 bits a character."""
    chars = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    letter = _letters()[chars]
    if not letter.any():
        return np.empty(0, np.int64)
    chars = np.where(letter, chars, _BLANK)
    keep = letter | np.append(True, letter[:-1])
    chars = np.concatenate([[_BLANK] * bool(letter[0]), chars[keep], [_BLANK] * bool(letter[-1])]).astype(np.int64)
    letter = chars != _BLANK
    two = chars[:-1] << 21 | chars[1:]
    three = (chars[:-2] << 42 | chars[1:-1] << 21 | chars[2:])[letter[1:-1]]
    return np.concatenate([chars[letter], two, three])


def top(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if len(codes) > TOP:
        least = np.partition(counts, len(counts) - TOP)[len(counts) - TOP]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.lexsort((codes, -counts))][:TOP]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))


def _counts(batches):
    """(lang, code, n): summed over as many texts as have AT_ONCE characters."""
    schema = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])
    held: dict[str, list[np.ndarray]] = {}
    size = 0

    def out():
        for lang, parts in held.items():
            codes, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], schema=schema)

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            codes = grams(text.as_py())
            held.setdefault(lang, []).append(codes)
            size += len(codes)
            if size > AT_ONCE:
                yield from out()
                held, size = {}, 0
    yield from out()


def learn(docs: DataFrame) -> dict[str, list[int]]:
    """The profile of each language: n-gram codes, most frequent first."""
    text_batches(docs.sparkSession)
    known = docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"))
    known = known.filter("lang is not null and text is not null").filter(~held_out())
    most = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    sizes = {r["lang"]: r["count"] for r in most.collect()}
    if not sizes:
        return {}
    share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, MOST_EACH / n))))
    known = known.filter(F.col("lang").isin(*sizes))
    picked = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20))
    counts = picked.select("lang", "text").mapInArrow(_counts, "lang string, code long, n long")
    counts = counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    rows = counts.withColumn("place", place).filter(F.col("place") <= TOP).collect()
    profiles: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["place"])):
        profiles.setdefault(r["lang"], []).append(r["code"])
    return profiles


def nearest(own: np.ndarray, profiles: dict[str, tuple[np.ndarray, np.ndarray]]) -> tuple[str, float]:
    """The language with the smallest distance to the ordered n-grams ``own``, and a score."""
    found = []
    for lang, (codes, places) in profiles.items():
        at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        off = np.abs(places[at] - np.arange(len(own)))
        found.append((int(np.where(codes[at] == own, np.minimum(off, TOP), TOP).sum()), lang))
    found.sort()
    first = found[0][0]
    second = found[1][0] if len(found) > 1 else len(own) * TOP
    return found[0][1], second / (first + second) if first + second else 1.0


def _sorted_profiles(profiles: dict[str, list[int]]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Codes in order and their places."""
    order = {k: np.argsort(np.array(v, np.int64)) for k, v in profiles.items()}
    return {k: (np.array(v, np.int64)[order[k]], order[k]) for k, v in profiles.items()}


PREDICTED = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])


def predictor(profiles: dict[str, list[int]]):
    """A column function: struct(lang, score) of a text; score is from 0.5 (a tie) to 1."""
    name = uuid.uuid4().hex

    @arrow_udf(PREDICTED)
    def predict(text: pa.Array) -> pa.Array:
        ready = held(f"profiles {name}", lambda: _sorted_profiles(profiles))
        langs, scores = [], []
        for t in text:
            codes = grams(t.as_py())
            lang, score = (UNKNOWN, 0.0)
            if len(codes) and profiles:
                lang, score = nearest(top(*np.unique(codes, return_counts=True)), ready)
            langs.append(lang)
            scores.append(score)
        return pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    return predict.asNondeterministic()  # else Spark may run it once more for each field


def identify(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    predict = predictor(learn(docs))
    rows = docs.select("doc_id", "text").withColumn("p", predict("text"))
    return rows.select("doc_id", held_out().alias("held_out"), F.col("p.lang").alias("lang_pred"), "p.score")
