"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  Each sentence has a logistic score over the words and
word beginnings (PREFIXES letters) of a lexicon, and the document's score is the noisy-or of these: 1 - prod(1 - p).  Only
document labels are learned from; the sentences with high scores are then the offending ones.

* Learning takes labelled rows whose crc32(doc_id as text) mod 4 is not 2, at most
  MOST_EACH of either label (those with the least hash of their id), copies once.  Where a label
  is over this bound, its sampled rows weigh as much as all its rows: weight = labelled rows of the label /
  sampled ones.  So the share of toxic documents that is learned is that of the labels at any size.
* The lexicon holds at most LEXICON words and beginnings that occur in more toxic documents than chance
  allows: with df documents of which a share s is toxic, against a rate r of all, chance
  gives that with a probability of at most exp(-df * KL(s, r)) (Chernoff), which must be
  below one by the number of words.  This counts sampled documents without weights, as the bound holds for
  documents that were seen; whether s is above r is the same either way.
* Weights come from gradient descent; each step is one Spark job over the lexicon words of
  the sample's sentences, of which the driver sees sums only.

A sentence without a lexicon word scores 0, and so do null and empty texts, and all texts
where there are no labels of both kinds to learn from.  A doc_id with several labels
counts as toxic if one of them says so; labels other than 0 and 1 and null ids are left out, and a null
doc_id is reported as held out.  Repeated rows are repeated in the result.  Extra columns are
ignored by ``scores`` and kept by ``reject``.
"""

from __future__ import annotations

import math
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from lineflow.llm.shared import cut, fresh, held, own, text_batches

#: Labelled documents of either kind that are learned from at most.
MOST_EACH = 10_000
LEXICON = 2_000
#: Lengths of word beginnings; in the lexicon these end with an asterisk.
PREFIXES = range(4, 9)
#: Least number of documents of a lexicon word.
LEAST_DOCS = 3
STEPS = 60
RATE = 0.4
DECAY = 1e-4
#: Words without features that a scoring batch remembers.
PLAIN = 200_000
THRESHOLD = 0.3
#: Sentences at and above this score are reported as offending.
OFFENDING = 0.5

_ENDS = b".!?\n"
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SENTENCES = bytes(10 if c in _ENDS else w for c, w in enumerate(_WORDS))
_SENTENCE = re.compile(r"[^.!?\n]+")


def _words(text: str | None, table: bytes = _WORDS) -> str:
    """``text`` in lower case with spaces between words, and by ``table`` lines for sentences."""
    return (text or "").encode("utf-8", "surrogatepass").translate(table).decode("utf-8", "surrogatepass")


def _traits(word: str) -> list[str]:
    """A word, and its beginnings."""
    return [word, *(word[:k] + "*" for k in PREFIXES if k < len(word))]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic, weight) of the rows that are learned from."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).filter(~held_out())
    known = cut(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    rows = dict(known.groupBy("toxic").count().collect())
    few = [known.filter(F.col("toxic") == x).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_EACH) for x in (0, 1)]
    few = cut(few[0].unionByName(few[1]))  # at most 2 * MOST_EACH pairs of numbers
    met = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(few), "doc_id")
    met = met.groupBy(F.sha2("text", 256).alias("copy")).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
    weigh = lambda x: F.lit(max(1.0, rows.get(x, 0) / MOST_EACH))
    return met.withColumn("weight", F.when(F.col("toxic") == 1, weigh(1)).otherwise(weigh(0)))


def _distinct_traits(batches):
    found, marks = [], []
    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
            own = {x for w in set(_words(text).split()) for x in _traits(w)}
            found += own
            marks += [toxic] * len(own)
            if len(found) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(marks, pa.int32())], ["word", "toxic"])
                found, marks = [], []
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(marks, pa.int32())], ["word", "toxic"])


def lexicon(rows: DataFrame) -> list[str]:
    """The words that tell toxic documents, most telling first."""
    n, n1 = rows.agg(F.count("*"), F.sum("toxic")).first()
    if not n or not n1 or n1 == n:
        return []
    words = rows.mapInArrow(_distinct_traits, "word string, toxic int")
    per = words.groupBy("word").agg(F.count("*").alias("df"), F.sum("toxic").alias("a")).filter(F.col("df") >= LEAST_DOCS)
    per = cut(per)
    rate, share = n1 / n, F.col("a") / F.col("df")
    other = F.when(F.col("a") < F.col("df"), (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    told = per.filter(share > rate).withColumn("evidence", F.col("df") * (share * F.log(share / rate) + other))
    told = told.filter(F.col("evidence") >= math.log(max(per.count(), 2)))
    told = told.orderBy(F.desc("evidence"), "word").limit(LEXICON)
    return [r["word"] for r in told.select("word").collect()]


def _features(number: dict[str, int]):
    """Per document, the lexicon words of its sentences: sentence numbers and word numbers."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, toxic, weight in zip(*(batch.column(k).to_pylist() for k in ("text", "toxic", "weight")), strict=True):
                at, word = [], []
                for k, s in enumerate(_words(text, _SENTENCES).split("\n")):
                    own = [number[x] for w in set(s.split()) for x in _traits(w) if x in number]
                    at += [k] * len(own)
                    word += sorted(own)
                rows.append((toxic, weight, at, word))
            kinds = [pa.int32(), pa.float64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["toxic", "weight", "sentence", "word"])

    return run


def _gradient(weights: np.ndarray):
    """Per partition, the summed gradient of the documents' log-likelihood; the last weight is the bias."""

    def run(batches):
        total = np.zeros(len(weights))
        for batch in batches:
            for toxic, weight, at, word in zip(*(batch.column(k).to_pylist() for k in ("toxic", "weight", "sentence", "word")), strict=True):
                if not word:
                    continue
                starts = np.flatnonzero(np.diff(at, prepend=-1))
                z = np.add.reduceat(weights[word], starts) + weights[-1]
                p = 1 / (1 + np.exp(-z))
                if toxic:
                    clear = np.exp(np.log1p(-np.minimum(p, 1 - 1e-12)).sum())  # all sentences are
                    step = p * clear / max(1 - clear, 1e-12)
                else:
                    step = -p
                step = weight * step
                np.add.at(total, word, np.repeat(step, np.diff([*starts, len(word)])))
                total[-1] += step.sum()
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["gradient"])

    return run


def learn(docs: DataFrame, labels: DataFrame) -> dict[str, float]:
    """Weights of the lexicon's words; that of ``""`` is the bias.  Empty: nothing to learn from."""
    text_batches(docs.sparkSession)
    rows = cut(sample(docs, labels))
    words = lexicon(rows)
    if not words:
        return {}
    number = {w: k for k, w in enumerate(words)}
    bags = cut(rows.mapInArrow(_features(number), "toxic int, weight double, sentence array<int>, word array<int>"))
    n = bags.agg(F.sum("weight")).first()[0]
    weights, speed, power = np.zeros(len(words) + 1), np.zeros(len(words) + 1), np.zeros(len(words) + 1)
    weights[-1] = -2.0
    for step in range(1, STEPS + 1):  # Adam
        parts = bags.mapInArrow(_gradient(weights), "gradient array<double>").collect()
        g = np.sum([r[0] for r in parts], axis=0) / n - DECAY * np.append(weights[:-1], 0)
        speed = 0.9 * speed + 0.1 * g
        power = 0.99 * power + 0.01 * g * g
        weights += RATE * speed / (1 - 0.9**step) / (np.sqrt(power / (1 - 0.99**step)) + 1e-8)
    return dict(zip([*words, ""], weights.tolist(), strict=True))


SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
SCORED = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("offending", T.ArrayType(SPAN))])


def _one(text: str | None, weights: dict[str, float], plain: set[str]) -> tuple[float, list[tuple[int, int, float]]]:
    """A text's score, and its offending sentences as character spans.  ``plain``: words known to have no weight."""
    told = []
    for w in set(_words(text).split()) - plain:
        if weights.keys().isdisjoint(_traits(w)):
            plain.add(w)
        else:
            told.append(w)
    if not told:
        return 0.0, []
    told = {w: sum(weights.get(x, 0.0) for x in _traits(w)) for w in told}
    clear, spans = 1.0, []
    for m in _SENTENCE.finditer(text):
        own = told.keys() & set(_words(m[0]).split())
        if own:
            z = weights[""] + sum(told[w] for w in sorted(own))
            p = 1 / (1 + math.exp(-min(max(z, -50.0), 50.0)))
            clear *= 1 - p
            if p >= OFFENDING:
                spans.append((m.start(), m.end(), p))
    return 1 - clear, spans


def scorer(weights: dict[str, float]):
    """A column function: struct(score, offending) of a text."""
    name = uuid.uuid4().hex

    @arrow_udf(SCORED)
    def score(text: pa.Array) -> pa.Array:
        found, plain = [], held(f"plain words {name}", set)  # words without features that this worker has met
        for t in text:
            if len(plain) > PLAIN:
                plain.clear()
            found.append(_one(t.as_py(), weights, plain) if weights else (0.0, []))
        spans = [[dict(zip(("start", "end", "score"), s, strict=True)) for s in x] for _, x in found]
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        return pa.StructArray.from_arrays([pa.array([x for x, _ in found], pa.float64()), pa.array(spans, kind)], ["score", "offending"])

    return score.asNondeterministic()  # else Spark may run it once more for a filter


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, offending (sentence spans)."""
    score = scorer(learn(docs, labels))
    rows = docs.select("doc_id", score("text").alias("s"))
    predicted = (F.col("s.score") >= THRESHOLD).cast("int").alias("predicted")
    return rows.select("doc_id", held_out().alias("held_out"), "s.score", predicted, "s.offending")


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those whose score reaches the threshold."""
    score, told = scorer(learn(docs, labels)), fresh(docs)("scored")
    return docs.withColumn(told, score("text")).filter(F.col(f"{told}.score") < THRESHOLD).select(*own(docs))
