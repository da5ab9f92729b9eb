"""Packing token sequences by minimum bin slack.

Each task tokenizes its rows into pools of bounded size and packs each pool by itself, so
nothing is shuffled, no task holds more than a pool, and a lost task is simply run again.

Within a pool, full windows are cut off each document first.  Of the remaining lengths
only the count of each matters (at most 2047 numbers).  For each window, the largest
remaining length is set, and a subset-sum dynamic programme over bitsets, with the other
lengths as often as they remain, finds the multiset that fills the rest closest to
capacity; backtracking gives the counts, and the pattern repeats as often as the counts
allow.  Where slack stays, the smallest remaining piece is cut to fill it.  The pool's last
window, if not full, is cut at powers of two, which need no padding.

Which documents share a sequence depends on how Spark splits the table; every id is in one piece whatever it does.

Null texts count as empty: they hold the end id only.  Repeated rows are packed each by
itself, null doc_ids too.  Extra columns are ignored.  An empty table gives no pieces.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterable, Iterator
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lineflow.llm.shared import held, text_batches

CAPACITY = 2048
END_ID = 1
#: Tokens in a pool: 4 bytes each.
POOL_TOKENS = 2_000_000
#: Bytes of chunks and their ids that a worker remembers; beyond, it starts anew.
CACHE_BYTES = 96_000_000
#: What a remembered chunk takes besides its characters and ids.
ENTRY_BYTES = 200
#: Characters tokenized at once, and one text more.
AT_ONCE = 2_000_000
#: Separators that Python's split() takes for white space and the tokenizer does not.
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: Chunks that one run of the tokenizer gets.
TOGETHER = 1024
PLAIN_WORD = re.compile("[a-z]+")
#: Where letters end and marks begin, a token ends: no apostrophe, which may begin a contraction.
EDGE = r"(\pL)([!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~])"

# The steps of the tokenizers whose texts may be cut into chunks.
CUTTABLE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
WORD_END = "</w>"
SPECIAL_START = "<|"


class Encoder:
    """Token ids as little-endian 32-bit bytes.

    A tokenizer of the steps CUTTABLE neither joins nor compares characters across white space, so it runs once
    on each distinct chunk between white space, and texts are put together from these.
    Two steps that leave ids as they are make its runs fewer: texts are lower-cased, as the
    tokenizer does, and marks behind letters are chunks of their own.  Texts that may hold a
    special token ("<|") are spared both.  Words of the letters a-z, which its steps before the
    model leave as they are, go to the same model without these steps.  Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        steps = json.loads(self.tokenizer.to_str())
        special = [x["content"] for x in steps["added_tokens"]]
        self.cuttable = (
            all(steps[k] == v for k, v in CUTTABLE.items())
            and steps["model"].get("end_of_word_suffix") == WORD_END
            and all(x.startswith(SPECIAL_START) for x in special)
        )
        vocab = steps.pop("model").pop("vocab") if self.cuttable else {}
        self.last = np.zeros(max(vocab.values(), default=0) + 1 + len(special), bool)  # ids that end a word
        self.last[[i for token, i in vocab.items() if token.endswith(WORD_END)]] = True
        self.model = Tokenizer.from_file(path) if self.cuttable else self.tokenizer
        if self.cuttable:
            self.model.normalizer, self.model.pre_tokenizer = None, WhitespaceSplit()
        self._forget()

    def _forget(self) -> None:
        """Remembered chunks have a row each; ``firsts`` and ``sizes`` tell where its ids lie in ``ids``."""
        self.rows: dict[str, int] = {}
        self.ids, self.firsts, self.sizes = np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.size = 0

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        got = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4") for x in got]

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``chunks``, and how many each has."""
        each = self._each(chunks)
        return np.concatenate(each), np.array([len(x) for x in each], np.int64)

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words of letters only: such a word is one token sequence up to its end mark."""
        run = self.model if all(map(PLAIN_WORD.fullmatch, words)) else self.tokenizer
        ids = np.array(run.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(self.last[ids]) + 1
        return (ids, np.diff(ends, prepend=0)) if len(ends) == len(words) else self._chunks(words)

    def _learn(self, chunks: list[str]) -> None:
        kinds: tuple[list[str], ...] = ([], [], [])
        for x in chunks:
            kinds[(not x.isascii() or x != x.lower()) if x.isalpha() else 2].append(x)
        ids, sizes = [self.ids], [self.sizes]
        for kind, run in zip(kinds, (self._words, self._words, self._chunks), strict=True):
            for i in range(0, len(kind), TOGETHER):
                part = kind[i : i + TOGETHER]
                self.rows.update(zip(part, range(len(self.rows), len(self.rows) + len(part)), strict=True))
                for all_of, got in zip((ids, sizes), run(part), strict=True):
                    all_of.append(got)
                self.size += sum(map(len, part)) + 4 * len(ids[-1]) + ENTRY_BYTES * len(part)
        self.ids, self.sizes = np.concatenate(ids), np.concatenate(sizes)
        self.firsts = np.cumsum(self.sizes) - self.sizes

    @staticmethod
    def _plain(text: str) -> str | None:
        """``text`` in a form that may be split at white space; None: it may not."""
        if ODD_SPACE.search(text):
            return None
        low = text.lower()
        if "<|" in text:
            return text  # lower case could make a special token of it
        if text.isascii() or "\u03a3" not in text and is_normalized("NFC", text) and is_normalized("NFC", low):
            return low
        return text

    def _known(self, chunks: list[str]) -> np.ndarray:
        """Rows of distinct chunks, which are learned where they are not remembered."""
        if self.size > CACHE_BYTES:
            self._forget()
        rows = list(map(self.rows.get, chunks))
        new = [x for x, row in zip(chunks, rows, strict=True) if row is None]
        if new:
            self._learn(new)
            rows = list(map(self.rows.__getitem__, chunks))
        return np.array(rows, np.int64)

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text: distinct chunks are looked up, the rest is array work."""
        if not self.cuttable:
            return [x.tobytes() for x in self._each(texts)]
        plain = [self._plain(t) for t in texts]
        whole = pa.array([x or "" for x in plain], pa.string())
        apart = pc.replace_substring_regex(whole, EDGE, r"\1 \2")
        apart = pc.if_else(pa.array(["<|" in t for t in texts], pa.bool_()), whole, apart)
        split = pc.utf8_split_whitespace(apart)
        coded = split.flatten().dictionary_encode()
        at = self._known(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        whole = np.arange(ends[-1] if len(ends) else 0)
        whole += np.repeat(self.firsts[at] - ends + sizes, sizes)
        whole = self.ids[whole]
        bounds = np.append(0, ends)[split.offsets.to_numpy()].tolist()
        return [
            self._each([t])[0].tobytes() if x is None else whole[a:b].tobytes()
            for t, x, a, b in zip(texts, plain, bounds, bounds[1:], strict=False)
        ]


def encoder(path: str) -> Encoder:
    return held(f"packing {path}", lambda: Encoder(path))


def fill(counts: dict[int, int], room: int, lengths: Iterable[int] | None = None) -> dict[int, int]:
    """The multiset of lengths, each at most ``counts`` times, whose sum is closest below ``room``.

    ``lengths``: those that are at most ``room``, from the largest down, if the caller has them in order.
    """
    mask = (1 << room + 1) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True) if lengths is None else lengths:
        left, share = min(counts[length], room // length), 1
        while left:
            share = min(share, left)
            steps.append((length * share, length, share, reach))
            reach |= reach << length * share & mask
            left, share = left - share, share * 2
        if reach >> room:
            break
    at, chosen = reach.bit_length() - 1, defaultdict(int)
    for size, length, share, before in reversed(steps):
        if not before >> at & 1:
            at -= size
            chosen[length] += share
    return dict(chosen)


def plan(sizes: list[int], capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (item, start, length) of items of ``sizes`` tokens."""
    sequences: list[list[tuple[int, int, int]]] = []
    rest: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for item, size in enumerate(sizes):
        full = size - size % capacity
        sequences += [[(item, s, capacity)] for s in range(0, full, capacity)]
        if size > full:
            rest[size - full].append((item, full))
    for length in rest:
        rest[length].reverse()  # pop() takes the first
    order, counts = sorted(rest), {x: len(v) for x, v in rest.items()}
    while order:
        top, room = order[-1], capacity - order[-1]
        counts[top] -= 1
        chosen = fill(counts, room, (order[k] for k in range(bisect_right(order, room) - 1, -1, -1)))
        counts[top] += 1
        chosen[top] = chosen.get(top, 0) + 1
        slack = capacity - sum(x * n for x, n in chosen.items())
        for _ in range(min(len(rest[x]) // n for x, n in chosen.items()) if not slack else 1):
            pieces = [(*rest[x].pop(), x) for x in sorted(chosen, reverse=True) for _ in range(chosen[x])]
            for x, n in chosen.items():
                counts[x] -= n
                if not counts[x]:
                    del order[bisect_left(order, x)]
            if slack and order:
                x = order[0]
                item, start = rest[x].pop()
                counts[x] -= 1
                if not counts[x]:
                    del order[0]
                pieces.append((item, start, slack))
                x -= slack
                rest[x].append((item, start + slack))
                counts[x] = len(rest[x])
                if counts[x] == 1:
                    insort(order, x)
            elif slack:
                sequences += _powers(pieces)
                pieces = []
            if pieces:
                sequences.append(pieces)
    return sequences


def _powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """An unfilled window's pieces as sequences whose lengths are powers of two."""
    left, out, queue = sum(x[2] for x in pieces), [], pieces[::-1]
    while left:
        room = 1 << left.bit_length() - 1
        left -= room
        out.append([])
        while room:
            item, start, length = queue.pop()
            if length > room:
                queue.append((item, start + room, length - room))
            out[-1].append((item, start, min(length, room)))
            room -= min(length, room)
    return out


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int | None], list[str]]]:
    """Ids and texts of rows, cut where AT_ONCE characters are reached."""
    docs, texts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            docs.append(doc)
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= AT_ONCE:
                yield docs, texts
                docs, texts, size = [], [], 0
    if docs:
        yield docs, texts


def _pack(path: str, with_ids: bool):
    fields = [pa.field(x.split()[0], pa.int64()) for x in SCHEMA.split(", ")]
    schema = pa.schema(fields + [pa.field("ids", pa.list_(pa.int64()))] * with_ids)

    def emit(pool: list[tuple[int, bytes]], first: int) -> tuple[pa.RecordBatch, int]:
        sequences = plan([len(b) // 4 for _, b in pool])
        rows = []
        for k, pieces in enumerate(sequences, first):
            offset = 0
            for item, start, length in pieces:
                doc, ids = pool[item]
                part = ids[4 * start : 4 * (start + length)]
                row = (doc, start, length, zlib.crc32(part), len(ids) // 4, k, offset)
                rows.append((*row, np.frombuffer(part, "<u4").astype("i8")) if with_ids else row)
                offset += length
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema), first + len(sequences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, pool, held = encoder(path), [], 0
        number = TaskContext.get().partitionId() << 40
        end = np.array([END_ID], "<u4").tobytes()
        for docs, texts in _parts(batches):
            for doc, ids in zip(docs, encode(texts), strict=True):
                pool.append((doc, ids + end))
                held += len(ids) // 4 + 1
                if held >= POOL_TOKENS:
                    out, number = emit(pool, number)
                    yield out
                    pool, held = [], 0
        if pool:
            yield emit(pool, number)[0]

    return run


def pack(docs: DataFrame, tokenizer_path: str, with_ids: bool = False) -> DataFrame:
    """Pieces of all ``docs`` in sequences of at most CAPACITY tokens; ``with_ids`` adds their ids.

    ``tokenizer_path`` must be readable on the executors.
    """
    text_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_pack(tokenizer_path, with_ids), SCHEMA + ", ids array<long>" * with_ids)
