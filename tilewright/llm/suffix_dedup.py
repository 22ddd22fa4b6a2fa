"""Removal of passages that also start in an earlier document, by suffix arrays of shards.

Texts are UTF-8 bytes; a byte goes if a 50-byte string that covers it also starts in a
document with a smaller doc_id. Shards must hold all occurrences of such a string, so they
are made by content: the gram of least hash among a string's 19 32-byte grams is its anchor,
the same wherever the string occurs. Equal texts are one class, of which only the first row is searched.

1. Anchors. Each class sends its anchors' hashes to their parts, which tell the class those
   that occur in several classes, and which of them are hot.
2. Segments. Around each such anchor the bytes of all strings that it is the anchor of
   are a segment. Equal segments of a task are sent once, with the least doc_id. A hot anchor's
   strings are parted by the place of the anchor in them and by the longer core that they then
   share, so that one anchor in many surroundings goes to many tasks.
3. Shards. Strings whose hash occurs once among a task's segments occur once, and drop out;
   the runs of the others, equal ones drawn together by comparing their bytes, are the shard of
   their anchor (shards above a bound of symbols part by longer cores). The suffix array of
   each shard by induced sorting and the permuted common prefixes tell every string that
   several runs share, and so its least doc_id.
4. Every occurrence looks up its segment; a class collects the strings to remove.

Anchor hashes only choose what to compare, so their collisions cost work, not results. A class
is told by 40 bits in step 1, where a collision (odds of 2**-40 for a pair) could hide that an
anchor is shared; segments are told by 128 bits, of which 64 are those of their anchor.

Edge cases: null text counts as empty; texts under 50 bytes stay as they are; rows with one
doc_id don't remove from each other; a null doc_id counts as the largest; an empty table
gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.blobs import blob_batch, by_kind, dealt, gathered
from tilewright.llm.common import blocks, drop, keep, lookup, mix64, ranges, release, semi_filter, small_batches, text_of, utf8, wide
from tilewright.llm.shingles import _BYTE, _PLACE
from tilewright.llm.suffix_arrays import common_prefixes, suffix_arrays

LENGTH, GRAM = 50, 32
REACH = LENGTH - GRAM  # an anchor lies at most this far into its string
COMMON = 64
#: Classes in which a hot anchor occurs, and the ranges of its places by which its strings part.
HOT, RANGES = 1024, ((0, 4), (5, 9), (10, 14), (15, 18))
#: Symbols of a shard before it is parted, and of the shards that are sorted side by side.
SHARD, SYMBOLS = 1 << 13, 1 << 20
NO_ID = (1 << 63) - 1  # the id of a row without doc_id
#: Marks a hot gram in the number of its part.
HOT_FLAG = np.uint32(1 << 31)


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over x[i : i + width], for each i at which that fits."""
    have, out = 1, x
    while have * 2 <= width:
        out = pick(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places (in data) and hashes of the anchors of all strings of LENGTH bytes, and the first and last string of each.

    A string's anchor is its gram of least hash, the leftmost of equal ones, so that every
    string has one and the strings of one anchor follow each other.
    """
    n = len(data)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    raw = np.append(data, np.zeros(GRAM, np.uint8)).astype(np.uint64)
    two = raw[:-1] | raw[1:] << np.uint64(8)
    four = two[:-2] | two[2:] << np.uint64(16)
    eight = four[:-4] | four[4:] << np.uint64(32)
    sixteen = eight[:-8] * np.uint64(0x9E3779B97F4A7C15) + eight[8:] * np.uint64(0xD1B54A32D192ED03)
    sixteen ^= sixteen >> np.uint64(31)
    hashes = mix64(sixteen[: n - GRAM + 1] * np.uint64(0x8CB92BA72F3D8DD7) + sixteen[16 : n - GRAM + 17] * np.uint64(0xC2B2AE3D27D4EB4F))
    high = hashes & ~np.uint64(0xFFFFFFFF) | np.arange(len(hashes), dtype=np.uint64)
    place = (_slide(high, REACH + 1, np.minimum) & np.uint64(0xFFFFFFFF)).astype(np.int64)  # of the string at each position
    across = (at[1:, None] - np.arange(1, LENGTH)).ravel()  # these would go on in the next text
    place[across[(across >= 0) & (across < len(place))]] = -1
    turn = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    last = np.append(turn[1:], len(place)) - 1
    real = place[turn] >= 0
    found = place[turn[real]]
    return found, hashes[found], turn[real], last[real]


def _parts_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _low(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.uint32)


def _send(parts: int):
    """Kind 0: (gram, class) to the gram's part. Kind 3: grams that are common in this block, which counts as hot. Kind 2: (class, part, gram) of those, to the class's part."""

    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text"):
                data, at = utf8(part.column(1))
                place, hashes, _, _ = anchors(data, at)
                doc = np.searchsorted(at, place, side="right") - 1
                classes = part.column(0).to_numpy().astype(np.uint64) & np.uint64((1 << 40) - 1)
                of = classes[doc]
                order = np.lexsort((of, hashes))
                hashes, of = hashes[order], of[order]
                new = np.ones(len(of), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
                hashes, of = hashes[new], of[new]
                start = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])) if len(hashes) else np.zeros(0, np.int64)
                count = np.diff(np.append(start, len(hashes)))
                common = count >= max(COMMON, len(classes) // 8)
                seen = hashes[start[common]]
                rows = [(3, p, b) for p, b in dealt(_parts_of(seen, parts), _low(seen))]
                common = np.repeat(common, count)
                told, home = hashes[common], (of[common] % np.uint64(parts)).astype(np.int64)
                rows += [(2, p, b) for p, b in dealt(home, of[common], _parts_of(told, parts).astype(np.uint32) | HOT_FLAG, _low(told))]
                hashes, of = hashes[~common], of[~common]
                rows += [(0, p, b) for p, b in dealt(_parts_of(hashes, parts), _low(hashes), of.astype(np.uint32), (of >> np.uint64(32)).astype(np.uint8))]
                yield blob_batch(rows)

    return run


def _share(parts: int):
    """Kind 2: (class, part, gram) of the grams of several classes, to the class's part; those that came as such pass. Common grams of any block are shared. A hot gram's part has HOT_FLAG, whatever the way it came."""

    def run(batches):
        found: dict[tuple[int, int], list[bytes]] = {}
        for batch in batches:
            direct = pc.equal(batch.column(0), 2)
            yield batch.filter(direct)
            for kind, pid, blob in zip(*(c.to_pylist() for c in batch.filter(pc.invert(direct)).columns), strict=True):
                found.setdefault((pid, kind), []).append(blob)
        for pid in sorted({p for p, _ in found}):
            gram, low, high = gathered(found.pop((pid, 0), []), (np.uint32, np.uint32, np.uint8))
            (seen,) = gathered(found.pop((pid, 3), []), (np.uint32,))
            of = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
            order = np.lexsort((of, gram))
            gram, of = gram[order], of[order]
            new = np.ones(len(gram), bool)
            new[1:] = (gram[1:] != gram[:-1]) | (of[1:] != of[:-1])
            gram, of = gram[new], of[new]
            start = np.flatnonzero(np.append(True, gram[1:] != gram[:-1])) if len(gram) else np.zeros(0, np.int64)
            count = np.diff(np.append(start, len(gram)))
            hot = (count >= HOT) | np.isin(gram[start], seen)
            shared, hot = np.repeat((count > 1) | hot, count), np.repeat(hot, count)
            gram, of = gram[shared], of[shared]
            part = np.where(hot[shared], np.uint32(pid) | HOT_FLAG, np.uint32(pid))
            rows = [(2, p, b) for p, b in dealt((of % np.uint64(parts)).astype(np.int64), of, part, gram)]
            if rows:
                yield blob_batch(rows)

    return run


def _told(batches):
    """A row (class, grams) for each class with shared grams; a gram is its part and its low bits."""
    found = by_kind(batches)
    of, part, gram = gathered(found.get(2, []), (np.uint64, np.uint32, np.uint32))
    code = part.astype(np.uint64) << np.uint64(32) | gram
    order = np.lexsort((code, of))
    of, code = of[order], code[order]
    cuts = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.zeros(0, np.int64)
    for i in range(0, len(cuts), 4096):
        some = cuts[i : i + 4096]
        ends = np.append(cuts[i + 1 : i + 4097], len(of))[: len(some)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(of[some].astype(np.int64)), pa.array([code[a:b].tobytes() for a, b in zip(some.tolist(), ends.tolist(), strict=True)], pa.binary())], names=["class", "grams"]
        )


def _hashed(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64 bits of the bytes of each stretch of data."""
    step = ranges(size)
    begin = np.cumsum(size) - size
    return np.add.reduceat(_BYTE[data[np.repeat(start, size) + step]] * _PLACE[step], begin) if len(size) else np.zeros(0, np.uint64)


def _parted(data: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray):
    """(anchor, nth, first, last string) of the segments of hot anchors, one for each range of their places in a string: nth counts the anchors."""
    for a, b in RANGES:
        start, stop = np.maximum(place - b, first), np.minimum(place - a, last)
        some = np.flatnonzero(start <= stop)
        size = np.full(len(some), LENGTH - b + a)
        core = _hashed(data, place[some] - a, size)
        yield mix64(core + np.uint64(a + 1) * np.uint64(0x9FB21C651E98DF25)), some, start[some], stop[some]


def _segments(parts: int):
    """Kind 0: a block's unlike segments (anchor, its place, segment, least id, number). Kind 1: the occurrences (anchor, segment's hash, id, class, start)."""
    names = ["kind", "anchor", "lead", "segment", "id", "n", "code", "cls", "start"]

    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text"):
                ids, classes, texts, grams = (part.column(part.schema.get_field_index(c)) for c in ("id", "cls", "text", "grams"))
                data, at = utf8(texts)
                place, hashes, first, last = anchors(data, at)
                doc = np.searchsorted(at, place, side="right") - 1
                code = _parts_of(hashes, parts).astype(np.uint64) << np.uint64(32) | _low(hashes)
                # a text's anchors that its class has been told of
                raw, gram_at = utf8(grams)
                flag = np.uint64(HOT_FLAG) << np.uint64(32)
                known = raw.view(np.uint64)
                owner = np.repeat(np.arange(len(at) - 1), np.diff(gram_at) // 8)
                pairs = mix64((known & ~flag) + mix64(owner.astype(np.uint64)))
                mine = mix64(code + mix64(doc.astype(np.uint64)))
                shared = np.isin(mine, pairs)
                hot = np.isin(mine, pairs[(known & flag) != 0])
                cold = np.flatnonzero(shared & ~hot)
                found = [(hashes[cold], cold, first[cold], last[cold])]
                hot = np.flatnonzero(shared & hot)
                if len(hot):
                    found += [(key, hot[nth], start, stop) for key, nth, start, stop in _parted(data, place[hot], first[hot], last[hot])]
                anchor, nth, start, stop = (np.concatenate([f[i] for f in found]) for i in range(4))
                if not len(anchor):
                    continue
                place, doc = place[nth], doc[nth]
                size = stop + LENGTH - start
                step = ranges(size)
                body = data[np.repeat(start, size) + step]
                begin = np.cumsum(size) - size
                lead = place - start
                code = mix64(_hashed(body, begin, size) + (lead * 256 + size).astype(np.uint64) * np.uint64(0x8CB92BA72F3D8DD7)).view(np.int64)
                anchor = anchor.view(np.int64)
                id_of, class_of = ids.to_numpy()[doc], classes.to_numpy()[doc]
                order = np.lexsort((code, anchor))
                heads = np.flatnonzero(np.append(True, (code[order][1:] != code[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])))
                first, least, number = np.minimum.reduceat(order, heads), np.minimum.reduceat(id_of[order], heads), np.diff(np.append(heads, len(order)))
                # in the order of the text, neighbours overlap and so compress well
                order = np.argsort(first)
                first, least, number = first[order], least[order], number[order]
                offsets = np.concatenate([begin, [len(body)]]).astype(np.int32)
                segment = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(body)]).take(pa.array(first))
                m, none = len(first), pa.nulls
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(m, np.int32)),
                        pa.array(anchor[first]),
                        pa.array(lead[first].astype(np.int32)),
                        segment,
                        pa.array(least),
                        pa.array(number),
                        pa.array(code[first]),
                        none(m, pa.int64()),
                        none(m, pa.int32()),
                    ],
                    names=names,
                )
                m = len(code)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.ones(m, np.int32)),
                        pa.array(anchor),
                        none(m, pa.int32()),
                        none(m, pa.binary()),
                        pa.array(id_of),
                        none(m, pa.int64()),
                        pa.array(code),
                        pa.array(class_of),
                        pa.array((start - at[:-1][doc]).astype(np.int32)),
                    ],
                    names=names,
                )

    return run


def least_ids(strings: list[bytes], ids: np.ndarray, shard: np.ndarray) -> list[np.ndarray]:
    """For each string the least id of the strings of its shard that hold each of its LENGTH-byte substrings.

    shard: numbers 0, 1, ... in ascending order. Each shard's suffix array brings equal
    substrings together: neighbours whose common prefix reaches LENGTH.
    """
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(strings)
    size = np.fromiter(map(len, strings), np.int64, len(strings)) + 1
    cuts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    totals = np.add.reduceat(size, cuts) + 1
    ends = np.append(cuts[1:], len(strings))
    order = np.argsort(totals, kind="stable")
    i = 0
    while i < len(order):
        # shards of like length, by the matrix that they fill
        filled = totals[order[i:]] * np.arange(1, len(order) - i + 1)
        lanes = order[i : i + max(1, int(np.searchsorted(filled, SYMBOLS, side="right")))]
        i += len(lanes)
        length = totals[lanes]
        text = np.zeros((int(length.max()), len(lanes)), np.int32)
        members = np.concatenate([np.arange(cuts[s], ends[s]) for s in lanes])
        counts = ends[lanes] - cuts[lanes]
        lane = np.repeat(np.arange(len(lanes)), counts)
        sizes = size[members]
        first = np.cumsum(sizes) - sizes
        begin = first - np.repeat(first[np.cumsum(counts) - counts], counts)  # in its lane
        flat = np.frombuffer(b"\0".join(strings[m] for m in members) + b"\0", np.uint8).astype(np.int32) + 2
        row = np.repeat(begin, sizes) + ranges(sizes)
        flat[first + sizes - 1] = 1  # the end of a string
        text[row, np.repeat(lane, sizes)] = flat
        array = suffix_arrays(text, length)
        prefix = common_prefixes(text, length, array)
        # strings by position
        n = text.shape[0]
        member_at = np.full((n + 1, len(lanes)), -1, np.int64)
        member_at[row, np.repeat(lane, sizes)] = np.repeat(np.arange(len(members)), sizes)
        room = np.zeros((n + 1, len(lanes)), np.int64)
        room[row, np.repeat(lane, sizes)] = np.repeat(sizes - 1, sizes) - ranges(sizes)
        column = np.arange(len(lanes))[None]
        whole = room[array, column] >= LENGTH
        lane_r, rank = np.nonzero(whole.T)
        at = array[rank, lane_r]
        joined = np.zeros(len(at), bool)
        joined[1:] = (prefix[at[1:], lane_r[1:]] >= LENGTH) & (lane_r[1:] == lane_r[:-1]) & (rank[1:] == rank[:-1] + 1)
        if len(at):
            heads = np.flatnonzero(~joined)
            member = member_at[at, lane_r]
            least = np.minimum.reduceat(ids[members[member]], heads)[np.cumsum(~joined) - 1]
            by = np.lexsort((at, member))
            member, least = member[by], least[by]
            edges = np.searchsorted(member, np.arange(len(members) + 1))
            for k, m in enumerate(members.tolist()):
                out[m] = least[edges[k] : edges[k + 1]]
    return out


class Strings:
    """Substrings of one buffer by hash: 64 bits of each, from prefix sums, in constant time."""

    def __init__(self, data: np.ndarray):
        self.data = data
        base = np.uint64(0x9E3779B97F4A7C15)
        self.back = np.full(len(data) + 1, np.uint64(pow(int(base), -1, 1 << 64)))
        self.back[0] = 1
        self.back = np.cumprod(self.back)
        forward = np.full(len(data), base)
        forward[:1] = 1
        sums = _TABLE[data] * np.cumprod(forward)
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(sums)])

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix64((self.sums[end] - self.sums[begin]) * self.back[begin] + (end - begin).astype(np.uint64))

    def equal(self, begin: np.ndarray, other: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the size bytes from begin are those from other."""
        out = np.ones(len(begin), bool)
        at = np.repeat(np.arange(len(begin)), size)
        step = ranges(size)
        out[at[self.data[np.repeat(begin, size) + step] != self.data[np.repeat(other, size) + step]]] = False
        return out


_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def _alike(text: Strings, key: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the stretches of text by their key, and the number of each in this order among those that differ in key or bytes."""
    code = text.hashes(begin, begin + size)
    order = np.lexsort((size, code, key))
    begin, size, code, key = begin[order], size[order], code[order], key[order]
    new = np.ones(len(order), bool)
    new[1:] = (key[1:] != key[:-1]) | (code[1:] != code[:-1]) | (size[1:] != size[:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    new |= ~text.equal(begin, begin[head], size)  # unlike bytes with one hash stay apart
    return order, np.cumsum(new) - 1


def shared_strings(data: np.ndarray, at: np.ndarray, lead: np.ndarray, ids: np.ndarray, told: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The least id for each string of LENGTH bytes of the segments, one after another, and the segments' n + 1 offsets.

    A string whose hash occurs once is its own; runs of the others are drawn together where their
    bytes are equal and make up the shards of suffix arrays, which settle all of them. A shard holds
    the runs around one core that their strings share: the strings whose anchor lies a..b bytes in
    all hold the bytes from a before the anchor to LENGTH - b after it. That is the anchor itself
    at first; a shard above the bound parts by half the range and so by a longer core, down to
    single strings. told gets the number of strings of either kind.
    """
    size = np.diff(at)
    count = np.maximum(size - LENGTH + 1, 0)
    offset = np.concatenate([[0], np.cumsum(count)])
    least = np.repeat(ids, count)
    text = Strings(data)
    anchor = at[:-1] + lead
    of = np.repeat(np.arange(len(size)), count)
    start = at[:-1][of] + ranges(count)
    _, nth, times = np.unique(text.hashes(start, start + LENGTH), return_inverse=True, return_counts=True)
    some = np.flatnonzero(times[nth] > 1)
    if told is not None:
        told["alone"] = told.get("alone", 0) + len(of) - len(some)
        told["arrays"] = told.get("arrays", 0) + len(some)
    if not len(some):
        return least, offset
    fresh = np.flatnonzero(np.append(True, (some[1:] != some[:-1] + 1) | (of[some[1:]] != of[some[:-1]])))
    # runs: their segment, the place of their first string, the number of their strings
    now = {(0, REACH): (of[some[fresh]], start[some[fresh]], np.diff(np.append(fresh, len(some))))}
    whole = data.tobytes()
    strings: list[bytes] = []
    owners: list[np.ndarray] = []
    shard: list[np.ndarray] = []
    runs: list[tuple] = []
    shards = 0
    while now:
        after = {}
        for (a, b), (m, begin, n) in now.items():
            order, alike = _alike(text, text.hashes(anchor[m] - a, anchor[m] + LENGTH - b), begin, n + LENGTH - 1)
            m, begin, n = m[order], begin[order], n[order]
            core = text.hashes(anchor[m] - a, anchor[m] + LENGTH - b)
            head = np.flatnonzero(np.append(True, alike[1:] != alike[:-1]))
            group = np.cumsum(np.append(True, core[head][1:] != core[head][:-1])) - 1
            symbols = np.bincount(group, weights=n[head] + LENGTH)
            fits = (symbols <= SHARD) | (a == b)
            fit = fits[group]
            # the distinct runs of the shards, and all runs that they stand for
            number = np.cumsum(fit) - 1 + len(strings)
            strings += [whole[x : x + k + LENGTH - 1] for x, k in zip(begin[head[fit]].tolist(), n[head[fit]].tolist(), strict=True)]
            owners.append(np.minimum.reduceat(ids[m], head)[fit])
            shard.append((np.cumsum(fits) - 1 + shards)[group[fit]])
            shards += int(fits.sum())
            mine = fit[alike]
            runs.append((offset[m[mine]] + begin[mine] - at[:-1][m[mine]], n[mine], number[alike[mine]]))
            m, begin, n = m[~mine], begin[~mine], n[~mine]
            middle = (a + b) // 2
            for low, high in ((a, middle), (middle + 1, b)) if len(m) else ():
                first, last = np.maximum(begin, anchor[m] - high), np.minimum(begin + n - 1, anchor[m] - low)
                inside = first <= last
                if inside.any():
                    after[(low, high)] = (m[inside], first[inside], (last - first + 1)[inside])
        now = after
    found = least_ids(strings, np.concatenate(owners), np.concatenate(shard))
    values = np.concatenate(found)
    first = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))) - np.fromiter(map(len, found), np.int64, len(found))
    to, n, number = (np.concatenate([r[i] for r in runs]) for i in range(3))
    np.minimum.at(least, np.repeat(to, n) + ranges(n), values[np.repeat(first[number], n) + ranges(n)])
    return least, offset


def _shards(batches):
    """(anchor, code, n, least) for each unlike segment: its occurrences, the runs (first string, least id) of its strings, then their number."""
    found = [b for b in batches if b.num_rows]
    if not found:
        return
    table = pa.Table.from_batches(found)
    found.clear()
    anchor, lead, ids, number, code = (table.column(c).to_numpy() for c in ("anchor", "lead", "id", "n", "code"))
    # equal segments of several tasks
    order = np.lexsort((code, anchor))
    heads = np.flatnonzero(np.append(True, (code[order][1:] != code[order][:-1]) | (anchor[order][1:] != anchor[order][:-1])))
    ids, number, chosen = np.minimum.reduceat(ids[order], heads), np.add.reduceat(number[order], heads), order[heads]
    anchor, code, lead = anchor[chosen], code[chosen], lead[chosen].astype(np.int64)
    data, at = utf8(table.column("segment").take(pa.array(chosen)))
    del table
    least, offset = shared_strings(data, at, lead, ids)
    n = np.diff(offset)
    owner = np.repeat(np.arange(len(n)), n)
    # a segment that occurs once and whose strings occur nowhere else tells nothing
    told = (number > 1) | np.logical_or.reduceat(least != ids[owner], offset[:-1])
    turn = np.ones(len(least), bool)
    turn[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    turn &= told[owner]
    first = np.flatnonzero(turn)
    runs = np.bincount(owner[first], minlength=len(n))[told] + 1
    ends = np.cumsum(runs)
    pairs = np.empty((int(runs.sum()), 2), np.int64)
    last = np.zeros(len(pairs), bool)
    last[ends - 1] = True
    pairs[~last] = np.stack([first - offset[owner[first]], least[first]], axis=1)
    pairs[last] = np.stack([n[told], np.full(len(ends), NO_ID)], axis=1)
    offsets = np.concatenate([[0], ends * 16]).astype(np.int32)
    cells = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(pairs)])
    yield pa.RecordBatch.from_arrays([pa.array(anchor[told]), pa.array(code[told]), pa.array(number[told]), cells], names=["l_anchor", "l_code", "l_n", "least"])
    release()


def _marks(batches):
    """(id, cls, start, strings) for the occurrences with strings to remove: a bit for each string from start on."""
    for batch in batches:
        id_, cls, start = (batch.column(i).to_numpy() for i in range(3))
        raw, at = utf8(batch.column(3))
        runs = raw.view(np.int64).reshape(-1, 2)
        n = np.diff(at) // 16
        owner = np.repeat(np.arange(len(n)), n)
        first = runs[:, 0]
        # a run ends where the next begins; the last row holds no strings
        end = np.append(first[1:], 0)
        last = np.cumsum(n) - 1
        end[last] = first[last]
        gone = runs[:, 1] < id_[owner]
        one = np.uint64(1)
        bits = np.where(gone, ((one << (end - first).astype(np.uint64)) - one) << first.astype(np.uint64), np.uint64(0))
        mask = np.bitwise_or.reduceat(bits, last - n + 1) if len(n) else np.zeros(0, np.uint64)
        some = mask != 0
        yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (id_, cls, start, mask.view(np.int64))], names=["id", "cls", "start", "strings"])


def _removed(batches):
    """The result of texts with strings to remove."""
    for batch in batches:
        rows = []
        for id_, text, starts, masks in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            body = np.frombuffer(text.encode(), np.uint8)
            begins = np.array(starts, np.int64)[:, None] + np.arange(REACH + 1)
            on = (np.array(masks, np.int64).view(np.uint64)[:, None] >> np.arange(REACH + 1, dtype=np.uint64)) & np.uint64(1) == 1
            begins = begins[on]
            begins = np.unique(begins[begins + LENGTH <= len(body)])
            edge = np.zeros(len(body) + 1, np.int64)
            edge[begins] += 1
            edge[begins + LENGTH] -= 1
            gone = np.cumsum(edge)[:-1] > 0
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            rows.append((id_, len(body), int(gone.sum()), spans, hashlib.sha256(body[~gone].tobytes()).hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of docs(doc_id, text)."""
    small_batches(docs.sparkSession)
    parts = wide(docs.sparkSession)
    text = text_of()
    id_ = F.col("doc_id").cast("long")
    sha = F.sha2(text.cast("binary"), 256)
    # a class is told by 60 bits of its texts' digest
    cls = F.conv(F.substring("sha", 1, 15), 16, 10).cast("long")
    rows = docs.select(id_.alias("doc_id"), F.coalesce(id_, F.lit(NO_ID)).alias("id"), text.alias("text"), sha.alias("sha")).withColumn("cls", cls)
    narrow = keep(rows.select("doc_id", "id", "sha", "cls", F.octet_length("text").cast("long").alias("n_bytes")), "narrow")
    first = narrow.groupBy(F.col("sha").alias("first_sha")).agg(F.min("id").alias("first"), F.first("cls").alias("first_cls"), F.count("*").alias("copies"))

    blob = "kind int, pid int, blob binary"
    sent = rows.where(F.octet_length("text") >= LENGTH).select("cls", "text").mapInArrow(_send(parts), blob)
    shared = sent.repartitionById(parts, F.col("pid")).mapInArrow(_share(parts), blob)
    told = keep(shared.repartitionById(parts, F.col("pid")).mapInArrow(_told, "class long, grams binary"), "told")

    low = F.col("first_cls").bitwiseAND(F.lit((1 << 40) - 1))
    searched = keep(first.join(told, low == F.col("class")).select(F.col("first").alias("s_id"), F.col("first_cls").alias("s_cls"), "grams"), "searched")
    drop(told)
    # merged at every size: what is searched grows with the corpus
    texts = semi_filter(rows.select("id", "cls", "text"), searched, "id", "s_id").hint("merge")
    texts = texts.join(searched, (F.col("id") == F.col("s_id")) & (F.col("cls") == F.col("s_cls"))).select("id", "cls", "text", "grams")
    fields = "kind int, anchor long, lead int, segment binary, id long, n long, code long, cls long, start int"
    segments = keep(texts.mapInArrow(_segments(parts), fields), "segments")
    drop(searched)
    unlike = segments.where("kind = 0").select("anchor", "lead", "segment", "id", "n", "code").repartition(parts, "anchor")
    least = keep(unlike.mapInArrow(_shards, "l_anchor long, l_code long, l_n long, least binary"), "least")
    occurrences = segments.where("kind = 1").select("id", "cls", "start", "anchor", "code")
    found = lookup(occurrences, least, [("anchor", "l_anchor"), ("code", "l_code")], "l_n", occurrences.count()).select("id", "cls", "start", "least")
    marks = found.mapInArrow(_marks, "id long, cls long, start int, strings long")
    marks = keep(marks.groupBy("id", "cls").agg(F.collect_list("start").alias("starts"), F.collect_list("strings").alias("strings")), "marks")
    drop(segments)

    marked = marks.select(F.col("id").alias("m_id"), F.col("cls").alias("m_cls"), "starts", "strings")
    on = (F.col("id") == F.col("m_id")) & (F.col("cls") == F.col("m_cls"))
    cleaned = semi_filter(rows.select("doc_id", "id", "cls", "text"), marked, "id", "m_id").hint("merge").join(marked, on).select("doc_id", "text", "starts", "strings")
    cleaned = cleaned.mapInArrow(_removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    others = lookup(narrow, first, [("sha", "first_sha")], "copies", narrow.count()).join(marked.select("m_id", "m_cls"), on, "left_anti")
    copy = (F.col("id") > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    others = others.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(0).alias("n_removed"),
        F.when(copy, 1).otherwise(0).cast("long").alias("n_spans"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.col("sha")).alias("kept_sha256"),
    )
    return cleaned.union(others)
