"""Packing documents into sequences: dominance reduction, then best fit.

The instance is the number of pieces of each length, at most one count for each length up to
the capacity, whatever the corpus holds; only these counts reach the driver. There the
reduction of Martello and Toth fixes sets that dominate every other set with their largest
member (a piece beside which nothing fits, two that fill a sequence, a pair or triple that
no other companions of the largest piece can beat) until none is left, and best fit by
decreasing length packs the rest. Both work on counts, so a pattern stands for all the
sequences that look alike. A piece finds its sequence by its number among the pieces of its
length, which the tasks hand out without a sort.

Edge cases: null and empty texts are one id (the final 0); repeated rows are packed once
each; texts of any length are cut into full pieces; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import itertools
import os
import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.common import blocks, keep, numbered, ranges, small_batches, text_of, utf8, worker_cache

#: Words whose ids a worker remembers before it starts anew (those of one block come on top).
REMEMBERED = 1 << 19
#: Bytes of text that are encoded at once.
ENCODED_BYTES = 4 << 20

#: Texts on which the shortcuts of WordEncoder must agree with the tokenizer itself.
PROBES = (
    "Two words",
    "a  b\tc\nd ",
    "Mixed CASE, 12.5% of x_y/z (a-b) = [c] & {d}! 2024",
    "Äpfel ÉTÉ straße Ærø façade naïve, ÿ",
    "it's don't we'll \u0416\u0443\u043a \u4e2d\u6587 e\u0301 <b> caf\u00e9 \U0001d11e",
)

#: Words of printable ASCII without apostrophes and '<', and of the letters of Latin-1.
PLAIN = re.compile(r"[!-&(-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: Runs of letters, single digits, and runs of other characters of such words.
PIECES = re.compile(r"[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")


def visible_bytes() -> dict[int, str]:
    """The characters that byte-level models use: printable bytes stand for themselves, the others follow from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


VISIBLE = visible_bytes()


class WordEncoder:
    """Ids of whole texts, where possible from the ids of their distinct words.

    A tokenizer that never joins characters across white space gives a text the ids of its
    words in order, so each distinct word is encoded once. Both this and the shortcut of
    word_ids() are tried on PROBES first; what a tokenizer fails isn't used with it.
    """

    def __init__(self, path: str):
        self.remembered = REMEMBERED
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.plain = True
        self.plain = all(self.word_ids(w) == self.whole_ids(w) for p in PROBES for w in p.split())
        self.by_word = all([i for w in p.split() for i in self.whole_ids(w)] == self.whole_ids(p) for p in PROBES)
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.size = np.zeros(0, np.int64)
        self.start = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def whole_ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def word_ids(self, word: str) -> list[int]:
        """What the tokenizer gives for one word; for plain Latin words by its model alone.

        Such words are already in normal form, their lower case doesn't depend on neighbours,
        and PLAIN leaves out what its patterns treat specially.
        """
        if not self.plain:
            return self.whole_ids(word)
        if word.isascii() and word.isalpha():
            return [t.id for t in self.model.tokenize(word.lower())]
        if PLAIN.fullmatch(word):
            pieces = PIECES.findall(word.lower())
            return [t.id for p in pieces for t in self.model.tokenize(p.encode().decode("latin-1").translate(VISIBLE))]
        return self.whole_ids(word)

    def learn(self, words: list[str]) -> None:
        found = [self.word_ids(w) for w in words]
        size = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(size.sum()))
        first = len(self.place)
        self.place.update(zip(words, range(first, first + len(words)), strict=True))
        self.start = np.concatenate([self.start, len(self.ids) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.ids = np.concatenate([self.ids, ids])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and their n + 1 offsets."""
        if not self.by_word:
            found = [np.array(self.whole_ids(t), np.uint32) for t in texts.to_pylist()]
            return np.concatenate([np.zeros(0, np.uint32), *found]), np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int64)
        split = pc.ascii_split_whitespace(texts)
        words = pc.dictionary_encode(split.flatten())
        distinct = words.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.place]
        if len(self.place) + len(new) > self.remembered:
            self.forget()
            new = distinct
        self.learn(new)
        place = np.fromiter((self.place[w] for w in distinct), np.int64, len(distinct))
        nth = place[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
        size = self.size[nth]
        ids = self.ids[np.repeat(self.start[nth], size) + ranges(size)]
        at = np.concatenate([[0], np.cumsum(size)])[split.offsets.to_numpy().astype(np.int64) - split.offsets[0].as_py()]
        return ids, at


def pieces_of(path: str, capacity: int, remembered: int | None = None, at_once: int = ENCODED_BYTES):
    def run(batches):
        cache = worker_cache()
        if path not in cache:
            cache[path] = WordEncoder(path)
        encoder = cache[path]
        encoder.remembered = remembered or REMEMBERED
        for batch in batches:
            for part in blocks(batch, "text", at_once):
                ids, at = encoder.encode(part.column(1))
                n_ids = np.diff(at) + 1  # with the final 0
                n_pieces = -(-n_ids // capacity)
                doc = np.repeat(np.arange(len(n_ids)), n_pieces)
                piece = ranges(n_pieces)
                start = piece * capacity
                length = np.minimum(capacity, n_ids[doc] - start)
                # with a 0 after each text the ids of a piece lie in one run
                padded = np.insert(ids, at[1:], 0).astype("<u4")
                raw = memoryview(padded.tobytes())
                first = at[:-1][doc] + doc + start
                crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(first.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return run


Pattern = tuple[int, list[tuple[int, int]]]  # how many sequences hold these (length, times)


def dominant_sets(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """The patterns that dominance fixes, and the counts that are left."""
    left = {s: c for s, c in counts.items() if c}
    sizes = sorted(left)
    fixed: list[Pattern] = []

    def take(times: int, *members: int) -> None:
        fixed.append((times, [(s, members.count(s)) for s in sorted(set(members), reverse=True)]))
        for s in members:
            left[s] -= times
        for s in set(members):
            if not left[s]:
                del left[s]
                sizes.pop(bisect_left(sizes, s))

    def fitting(room: int, without: dict[int, int]) -> int | None:
        """The longest piece of at most room, apart from those already in the set."""
        i = bisect_left(sizes, room + 1) - 1
        while i >= 0 and left[sizes[i]] <= without.get(sizes[i], 0):
            i -= 1
        return sizes[i] if i >= 0 else None

    def shortest(n: int, without: int) -> list[int]:
        out: list[int] = []
        for s in sizes:
            out += [s] * min(n - len(out), left[s] - (s == without))
            if len(out) == n:
                break
        return out

    changed = True
    while changed:
        changed = False
        for s in sorted(left, reverse=True):
            while s in left:
                room = capacity - s
                a = fitting(room, {s: 1})
                if a is None:
                    take(left[s], s)
                elif a == room:
                    take(left[s] // 2 if a == s else min(left[s], left[a]), s, a)
                else:
                    low = shortest(3, s)
                    if len(low) < 2 or low[0] + low[1] > room:
                        take(1, s, a)
                    elif len(low) < 3 or sum(low) > room:
                        b = fitting(room - a, {s: 1, a: 2} if a == s else {s: 1, a: 1})
                        half = fitting(room // 2, {s: 1})
                        if b is None or half is None or b < half:
                            break
                        take(1, s, a, b)
                    else:
                        break
                changed = True
    return fixed, left


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit by decreasing length; sequences with the same content are one pattern."""
    rooms: list[int] = []
    open_: dict[int, list[Pattern]] = {}

    def put(room: int, pattern: Pattern) -> None:
        if pattern[0]:
            if room not in open_:
                insort(rooms, room)
            open_.setdefault(room, []).append(pattern)

    for s in sorted(counts, reverse=True):
        todo = counts[s]
        while todo:
            i = bisect_left(rooms, s)
            if i < len(rooms):
                room = rooms[i]
                n, content = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(i)
            else:
                room, content = capacity, []
                n = -(-todo // (capacity // s))
            each = room // s
            full = min(n, todo // each)
            put(room - each * s, (full, [*content, (s, each)]))
            todo -= full * each
            n -= full
            if n and todo:  # the last one takes what is left
                put(room - todo * s, (1, [*content, (s, todo)]))
                n, todo = n - 1, 0
            put(room, (n, content))
    return [p for group in open_.values() for p in group]


def slots(patterns: list[Pattern]) -> np.ndarray:
    """Rows (length, first rank, times in a sequence, first sequence, offset), sorted."""
    rows, used, sequence = [], {}, 0
    for n, content in patterns:
        offset = 0
        for s, times in content:
            rows.append((s, used.get(s, 0), times, sequence, offset))
            used[s] = used.get(s, 0) + n * times
            offset += s * times
        sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def placed(table: np.ndarray):
    key = (table[:, 0] << 44) | table[:, 1]

    def run(batches):
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("class_rank")).to_numpy()
            _, first, times, sequence, offset = table[np.searchsorted(key, (length << 44) | rank, side="right") - 1].T
            nth = rank - first
            columns = [*batch.columns[:-1], pa.array(sequence + nth // times), pa.array(offset + nth % times * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, path: str, capacity: int = 2048, remembered: int = REMEMBERED, at_once: int = ENCODED_BYTES) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of docs(doc_id, text).

    path: the tokenizer's file, which the executors read (ship it with --files, or install it).
    """
    small_batches(docs.sparkSession)
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long"
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    rows = keep(numbered(narrow, "pieces", "length", run=pieces_of(path, capacity, remembered, at_once), fields=fields), "ranked")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    fixed, left = dominant_sets(counts, capacity)
    table = slots(fixed + best_fit(left, capacity))
    return rows.mapInArrow(placed(table), fields + ", sequence_id long, offset long")
