"""Secret scan: candidates by patterns, false positives removed by a random forest.

Candidates are found widely, as the forest is there to remove what only looks like a secret:

* whatever of 6 characters or more without white space is assigned to a word such as token, password or key;
* quoted values of 8 characters or more without white space that mix letters with digits or marks, or small with capital letters;
* runs of 12 or more letters, digits and ``+/_-`` with at least one digit, and up to two ``=`` behind.

Features are a candidate's length, its shares of character classes, how likely its transitions from character to
character are in words, how much of it dictionary words cover, path marks, and the words around it.  The dictionary and the
transitions are counted over all words of all documents (``vocabulary``).  The forest is trained on labelled
findings (before, candidate, after, label): the caller's, or ``example_findings``, which are made by rule from the
dictionary: keys, tokens and passwords against placeholders, identifiers, paths, numbers and checksums.

Only DataFrame functions and Spark's own forest run; the driver sees the dictionary (DICTIONARY words at most), the table of
transitions (28 x 28) and the model.  Texts are not shuffled but by ``redact``, and there only those with secrets.  Null and
empty texts have no candidates; repeated rows are scanned each; extra columns are ignored by ``scan`` and kept by
``redact``, which tells rows by doc_id and text, null ids as well.  An empty table gives no findings.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lineflow.llm.shared import cut, fresh, key_filter, own, split_by_filter

#: Words that something is assigned to; in front of it stand at most 50 characters, as look-behind is bounded.
ASSIGNED = (
    r"(?<=[=:][\s\"']{0,3})"
    r"(?<=(?i:token|secret|passw[a-z]{0,4}|passphrase|\bpass|\bpwd?|key|auth[a-z]{0,10}|credentials?|bearer|signature)[A-Za-z0-9_-]{0,12}[\"']?\s{0,2}[=:][=:>]?\s{0,2}[\"']?)"
    r"[^\s\"'<>,;]{5,}[^\s\"'<>,;.:!?)\]}]"
)
QUOTED = (
    r"(?<=[\"'])(?:(?=[^\s\"']*[A-Za-z])(?=[^\s\"']*[0-9!#$%&*@^~])|(?=[^\s\"']*[a-z])(?=[^\s\"']*[A-Z]))[^\s\"'<>]{8,}(?=[\"'])"
)
RUN = r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{12,}+={0,2}"
CANDIDATE = f"{ASSIGNED}|{QUOTED}|{RUN}"
#: Characters around a candidate that are looked at.
BEFORE, AFTER = 48, 24
TREES, DEPTH, SEED = 40, 8, 7
THRESHOLD = 0.5
EXAMPLES = 12_000
#: Words of the dictionary: those in most documents.
DICTIONARY = 5_000
#: Letters of a word that counts; longer runs are no words.
WORD = r"\p{L}{3,24}"

# Words that identifiers and paths consist of, whatever the documents hold.
WORDS = (
    "account action admin array backup branch buffer build cache class client code column common config connection "
    "content context count create custom data date default delete device document domain download email error event "
    "example export file filter folder format frame function global group handler header home image import index input "
    "install item json lang level library license list local main manager message method model module name network node "
    "number object option order output package page parameter parent path player plugin point process product profile "
    "project query record region release report request resource response result root sample schema script server "
    "service session setting source state static status storage string style system table target template test text "
    "thread time title type update upload user util value version video view window worker"
).split()
# Words before secrets, and before what only looks like one; what stands where a secret is left out.
SECRET_WORDS = r"(?i)(token|secret|passw|passphrase|\bpass\b|\bpwd?\b|api[-_ ]?key|access[-_ ]?key|auth|credential|private[-_ ]?key|bearer|signing|signature)"
HARMLESS_WORDS = r"(?i)(commit|sha-?\d*|md5|checksum|hash|digest|uuid|guid|revision|build|version|invoice|order|phone|card|isbn)"
PLACEHOLDERS = r"(?i)(your|example|sample|dummy|change.?me|placeholder|redacted|xxxx|\*\*\*|none|null|true|false|required|optional|todo|env|getenv|config|\$\{|\{\{|%s)"
KNOWN_STARTS = r"^(AKIA|ASIA|ghp_|gho_|ghs_|glpat-|xox[abp]-|sk_live_|sk-|AIza|eyJ)"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Kinds of characters that transitions tell apart: letters, digits, anything else.
KINDS = len(LETTERS) + 2


@dataclass(frozen=True)
class Vocabulary:
    """Words of the dictionary, and log2 of each transition's chance, by 28 * from + to."""

    words: tuple[str, ...]
    transitions: tuple[float, ...]


def _kind(char: Column) -> Column:
    """A character's kind: 0 to 25 for a letter, 26 for a digit, 27 for anything else."""
    at = F.instr(F.lit(LETTERS + "0123456789"), F.lower(char))
    return F.when((char == "") | (at == 0), KINDS - 1).otherwise(F.least(at - 1, F.lit(KINDS - 2)))


def _pairs(text: Column) -> Column:
    """28 * from + to of all neighbouring characters."""
    kinds = F.transform(F.split(F.lower(text), ""), _kind)
    n = F.size(kinds)
    return F.zip_with(F.slice(kinds, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(kinds, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: a * KINDS + b)


def vocabulary(docs: DataFrame) -> Vocabulary:
    """The words of all documents: the DICTIONARY most widespread, and the transitions of all, by documents of each word."""
    found = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
    counts = cut(docs.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n")))
    words = [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(DICTIONARY).collect()]
    pairs = counts.select(F.explode(_pairs(F.col("word"))).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
    seen = {r["pair"]: r["n"] for r in pairs.collect()}
    chances = []
    for a in range(KINDS):
        own_counts = [seen.get(a * KINDS + b, 0) + 1 for b in range(KINDS)]
        chances += [math.log2(n / sum(own_counts)) for n in own_counts]
    return Vocabulary(tuple(sorted({*WORDS, *words})), tuple(chances))


def _share(text: str, pattern: str) -> Column:
    """The share of a column's characters that runs of ``pattern`` cover."""
    return 1 - F.char_length(F.regexp_replace(text, pattern, "")) / F.greatest(F.char_length(text), F.lit(1))


def features(vocabulary: Vocabulary) -> dict[str, Column]:
    """Each feature of (before, candidate, after)."""
    c = F.col("candidate")
    size = F.char_length(c)
    runs = F.size(F.regexp_extract_all(c, F.lit(r"[0-9]+|[a-z]+|[A-Z]+|[^0-9a-zA-Z]+"), F.lit(0)))
    flag = lambda x: x.cast("double")
    chances = F.split(F.lit(" ".join(map(repr, vocabulary.transitions))), " ").cast("array<double>")
    likely = F.transform(_pairs(c), lambda k: F.get(chances, k))
    likeness = F.aggregate(likely, F.lit(0.0), lambda a, x: a + x) / F.greatest(size - 1, F.lit(1))
    parts = F.transform(F.regexp_extract_all(c, F.lit(r"\p{Lu}?\p{Ll}+|\p{Lu}+"), F.lit(0)), F.lower)
    known = F.filter(parts, lambda x: (F.char_length(x) > 2) & x.isin(*vocabulary.words))
    covered = F.aggregate(known, F.lit(0), lambda a, x: a + F.char_length(x))
    near = F.regexp_extract("before", r"(\S+\s*){0,3}$", 0)
    return {
        "size": F.log(size.cast("double")),
        "digits": _share("candidate", "[0-9]+"),
        "upper": _share("candidate", "[A-Z]+"),
        "lower": _share("candidate", "[a-z]+"),
        "hex": _share("candidate", "[0-9a-f]+"),
        "vowels": _share("candidate", "(?i)[aeiou]+"),
        "changes": (runs - 1) / size,
        "likeness": likeness,
        "distinct": F.size(F.array_distinct(F.split(c, ""))) / size,
        "dictionary": covered / size,
        "slashes": (F.size(F.split(c, "/")) - 1).cast("double"),
        "breaks": (F.size(F.split(c, "[-_]")) - 1).cast("double"),
        "marks": _share("candidate", "[^A-Za-z0-9+/=_-]+"),
        "in_path": flag(F.col("before").rlike(r"[/\\.]$") | F.col("after").rlike(r"^(/|\.[A-Za-z0-9])") | c.rlike(r"^[a-z]+://|^\.{0,2}/")),
        "known_start": flag(c.rlike(KNOWN_STARTS)),
        "placeholder": flag(c.rlike(PLACEHOLDERS)),
        "uuid": flag(c.rlike("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")),
        "assigned": flag(F.col("before").rlike(r"[=:]\s*[\"']?$")),
        "quoted": flag(F.col("before").rlike(r"[\"']$") & F.col("after").rlike("^[\"']")),
        "secret_word": flag(near.rlike(SECRET_WORDS)),
        "harmless_word": flag(near.rlike(HARMLESS_WORDS)),
    }


def _all(text: str) -> Column:
    return F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n, before, candidate, after) of each candidate; n counts them in a text from 0."""
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text").filter(F.col("text").rlike(CANDIDATE))
    rows = rows.select("doc_id", "text_key", F.split("text", CANDIDATE, -1).alias("parts"), _all("text").alias("found"))
    near = F.transform(
        "found",
        lambda c, i: F.struct(
            i.alias("n"),
            F.right(F.get("parts", i), F.lit(BEFORE)).alias("before"),
            c.alias("candidate"),
            F.left(F.get("parts", i + 1), F.lit(AFTER)).alias("after"),
        ),
    )
    return rows.select("doc_id", "text_key", F.explode(near).alias("c")).select("doc_id", "text_key", "c.*")


def example_findings(spark: SparkSession, words: tuple[str, ...] = tuple(WORDS), count: int = EXAMPLES) -> DataFrame:
    """(before, candidate, after, label) made by rule from a row number, with ``words`` around and in them."""
    bits = lambda k: F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"-{k}")), 512)
    number = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n)).cast("int")
    mixed = lambda k: F.translate(F.regexp_replace(F.base64(F.unhex(bits(k))), r"\s", ""), "=", "x")
    plain = lambda k: F.translate(mixed(k), "+/", "aZ")
    letters = lambda k: F.translate(plain(k), "0123456789", "qWeRtYuIoP")
    table = F.split(F.lit(" ".join(words)), " ")  # one literal once the plan is optimised
    word = lambda k: F.get(table, number(k, len(words)))
    one_of = lambda k, *x: F.get(F.array(*map(F.lit, x)), number(k, len(x)))
    between = lambda text, low, high: F.substring(text, F.lit(1), low + number("size", high - low + 1))
    digits = F.translate(bits("d"), "abcdef", "012345")
    prose = F.concat(word("p1"), F.lit(" "), word("p2"), F.lit(" "))
    close = one_of("close", '"', "'", "", " ", "\n")
    assign = one_of("assign", ' = "', "=", ": ", ": '", ":", '="', " = ", '": "')
    named = one_of("key", "token", "secret", "password", "passwd", "pwd", "api_key", "apikey", "access_key", "auth_token", "credential", "client_secret", "bearer_token", "pass")
    spoilt = F.concat(word("s1"), one_of("mark", "!", "@", "#", "&", "$", "%"), number("s2", 10_000).cast("string"))
    turned = F.translate(F.initcap(F.concat(word("s3"), one_of("mark2", "&", "-", "!", "_"), word("s4"))), "aeiost", "4310$7")
    phrase = F.call_function("concat_ws", one_of("join", "-", "_", ".", ""), word("h1"), word("h2"), word("h3"), word("h4"))
    joined = F.call_function("concat_ws", one_of("sep", "_", "-", ""), word("w4"), word("w5"), word("w6"))
    stand_in = F.concat(one_of("stand", "your-", "<your_", "example-", "change-me-", "${", "xxxx-", "sample_"), named)
    stand_in = F.when(number("case", 3) == 0, F.upper(stand_in)).otherwise(stand_in)
    secret, plainly = F.concat(prose, named, assign), F.concat(prose, word("k"), assign)
    harmless = F.concat(prose, one_of("harmless", "commit", "sha256", "md5", "checksum", "revision", "build", "digest"), one_of("hs", " ", ": ", ":", "="))
    uuid = F.concat_ws("-", *(F.substring(bits("u"), a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    kinds = [
        (secret, between(bits("a"), 16, 64), 1),
        (F.concat(prose, one_of("lead", "", "key = ", "id: ")), F.concat(F.lit("AKIA"), F.substring(F.upper(plain("b")), 1, 16)), 1),
        (secret, between(mixed("c"), 20, 80), 1),
        (secret, between(plain("e"), 8, 24), 1),
        (secret, between(letters("l"), 10, 40), 1),
        (secret, spoilt, 1),
        (secret, turned, 1),
        (secret, phrase, 1),
        (prose, F.concat(one_of("start", "ghp_", "gho_", "sk_live_", "glpat-", "AIza"), F.substring(plain("f"), 1, 34)), 1),
        (F.concat(prose, one_of("idw", "id", "uuid", "order", "ref"), assign), uuid, 0),
        (F.concat(prose, one_of("numw", "", "call ", "card ", "invoice ", "isbn ")), between(digits, 12, 20), 0),
        (F.concat(prose, one_of("root", "/", "./", "src/", "")), F.concat(F.concat_ws("/", word("w1"), word("w2"), word("w3")), number("v", 100).cast("string")), 0),
        (prose, F.concat(joined, F.lit("_20"), number("y", 30).cast("string")), 0),
        (harmless, between(bits("h"), 32, 64), 0),
        (secret, stand_in, 0),
        (secret, word("plain word"), 0),
        (plainly, joined, 0),
        (plainly, F.concat(F.initcap(word("c1")), F.initcap(word("c2")), number("v", 100).cast("string")), 0),
    ]
    pick = number("kind", len(kinds))
    choose = lambda k: F.coalesce(*(F.when(pick == i, x[k] if k < 2 else F.lit(x[k])) for i, x in enumerate(kinds)))
    return spark.range(count).select(choose(0).alias("before"), choose(1).alias("candidate"), close.alias("after"), choose(2).cast("double").alias("label"))


@dataclass(frozen=True)
class Forest:
    model: Model
    vocabulary: Vocabulary


def train(findings: DataFrame, vocabulary: Vocabulary) -> Forest:
    """A forest of TREES trees on labelled findings (before, candidate, after, label)."""
    found = features(vocabulary)
    rows = findings.select("label", *(x.cast("double").alias(k) for k, x in found.items()))
    rows = VectorAssembler(inputCols=list(found), outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return Forest(forest.fit(cut(rows.select("label", "features"))), vocabulary)


def judge(found: DataFrame, forest: Forest) -> DataFrame:
    """``found`` with the chance that it is a secret, and is_secret."""
    columns = features(forest.vocabulary)
    rows = found.select("*", *(x.cast("double").alias(f"_{k}") for k, x in columns.items()))
    rows = VectorAssembler(inputCols=[f"_{k}" for k in columns], outputCol="features").transform(rows)
    chance = vector_to_array("probability")[1]
    rows = forest.model.transform(rows).select(*found.columns, F.round(chance, 6).alias("chance"))
    return rows.withColumn("is_secret", F.col("chance") >= THRESHOLD)


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Every candidate of ``docs``: doc_id, text_key, n, before, candidate, after, chance, is_secret."""
    told = vocabulary(docs)
    findings = cut(example_findings(docs.sparkSession, told.words)) if labelled is None else labelled
    return judge(candidates(docs), train(findings, told))


def redact(docs: DataFrame, found: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with ``mark`` for each secret that ``scan`` found in them."""
    secrets = cut(found.filter("is_secret").groupBy("doc_id", "text_key").agg(F.collect_set("n").alias("places")))  # of one text
    count = secrets.count()
    if not count:
        return docs
    bits, size = key_filter(secrets, F.xxhash64("doc_id", "text_key"), count)
    maybe, clear = split_by_filter(docs, F.xxhash64("doc_id", F.xxhash64("text")), cut(bits), size)
    doc, key, places = map(fresh(docs), ("doc", "key", "places"))
    met = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64("text") == F.col(key))
    rows = maybe.join(secrets.toDF(doc, key, places), met, "left")
    shown = F.transform(_all("text"), lambda c, i: F.when(F.array_contains(places, i), F.lit(mark)).otherwise(c))
    parts = F.zip_with(F.split("text", CANDIDATE, -1), shown, lambda p, c: F.concat(p, F.coalesce(c, F.lit(""))))
    text = F.when(F.col(places).isNull(), F.col("text")).otherwise(F.array_join(parts, ""))
    return clear.unionByName(rows.withColumn("text", text).select(*own(docs)))
