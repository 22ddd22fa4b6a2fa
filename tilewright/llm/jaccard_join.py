"""N-gram Jaccard join by prefix filters under several global orders.

Two sets of Jaccard similarity 0.8 or more share at least one of the first floor(n / 5) + 1
tokens of either, whatever order the tokens are put in. The join narrows in three steps:

1. Index. Every document sends its shingle hashes below a threshold (all of them if it is
   short) to the partitions of the hashes, which count in how many different sets each
   occurs. In the global order by rising count a set whose prefix consists of unshared tokens
   has no partner, which settles most documents. The others' prefixes are joined on their
   tokens; a bucket gives one edge for each member, never its pairs.
2. Clusters. The components of these edges hold every pair that can link. The few clusters
   above a block part again, by the components of shared prefix tokens under two more global
   orders (different scramblings of the hash), since a pair must share one under each. The
   sets of a cluster travel once; what is still above a block goes in blocks of bounded size,
   every two of which meet, or, where prefix buckets hold fewer pairs than that takes rows
   (chains), as the pairs of the buckets.
3. Verification. A pair is a candidate if it shares a prefix token under all three orders: by
   rarity among the sets at hand, and by either scrambling. Candidates are verified by their
   exact intersection. Links leave a block as a spanning forest.

Documents with the same set are one class, joined by its smallest doc_id, so copies cost one
index entry and no pairs. Tokens that many documents of one task share skip the counting and
rank last, so no token's postings meet in one task.

Edge cases: null, empty and all-space texts have no shingles and link with nothing; fewer
than five words are one shingle; a row with a null doc_id takes part by its text and gets the
smallest doc_id it reaches, null if there is none; repeated rows get the same result each;
an empty table gives an empty result; only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilewright.llm.blobs import blob_batch, by_kind, dealt, gathered
from tilewright.llm.common import blocks, drop, keep, lookup, mix64, ranges, release, semi_filter, small_batches, text_of, utf8, wide
from tilewright.llm.components import components
from tilewright.llm.shingles import shingle_sets

#: Views of the corpus: sets of under SMALL tokens with all their tokens, and sets of LONG or
#: more with the tokens below SHARE of the hash range. Any two sets of similarity 0.8 meet in one.
SMALL, LONG, SHARE = 160, 128, 0.4
#: A token in this many sets of one task's block and in an eighth of them ranks last unseen.
COMMON = 64
LAST = np.uint32(0xFFFFFFFF)
#: Scramblings of the hash that are global orders besides the one by count.
ORDERS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
#: Sets in a block of a cluster, and their tokens.
BLOCK, BLOCK_TOKENS = 256, 300_000

_VIEW = np.uint64(3)


def prefix_length(n: np.ndarray) -> np.ndarray:
    """floor(n / 5) + 1: n less the least overlap at similarity 0.8, and one."""
    return n // 5 + 1


def signatures(sets: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set that don't depend on its order."""
    k1, k2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    if len(full):
        flat = np.concatenate(sets)
        at = (np.cumsum(n) - n)[full]
        k1[full] = mix64(np.add.reduceat(flat, at) + n[full].astype(np.uint64))
        k2[full] = np.add.reduceat(mix64(flat ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at)
    return k1, k2


def views(sets: list[np.ndarray], n: np.ndarray, k1: np.ndarray, k2: np.ndarray):
    """Units (a set in a view), their sizes, and the tokens that they send."""
    unit, size, sent, tokens = [], [], [], []
    for i, s in enumerate(sets):
        if not len(s):
            continue
        id_ = k1[i] & ~_VIEW
        if len(s) < SMALL:
            unit.append(id_)
            size.append(len(s))
            tokens.append(mix64(s + np.uint64(0x5851F42D4C957F2D)))
        if len(s) >= LONG:
            low = s[: np.searchsorted(s, np.uint64(int(SHARE * 2**64)))]
            unit.append(id_ | np.uint64(1))
            size.append(len(s))
            tokens.append(low)
            if len(low) < prefix_length(len(s)):  # meets its like with all its tokens
                unit.append(id_ | np.uint64(2))
                size.append(len(s))
                tokens.append(mix64(s + np.uint64(0x14057B7EF767814F)))
    sent = np.fromiter(map(len, tokens), np.int64, len(tokens))
    flat = np.concatenate(tokens) if tokens else np.zeros(0, np.uint64)
    return np.array(unit, np.uint64), np.array(size, np.int64), sent, flat


def _index(parts: int):
    """Kind 0: (token, unit) to the token's part. Kind 1: (unit, size, sent) and kind 2: (unit, token) of common tokens, to the unit's part."""

    def run(batches):
        for batch in batches:
            for part in blocks(batch, "text"):
                sets, n = shingle_sets(*utf8(part.column(0)))
                k1, k2 = signatures(sets, n)
                first = np.unique(np.stack([k1, k2]), axis=1, return_index=True)[1]
                sets, n, k1, k2 = [sets[i] for i in first], n[first], k1[first], k2[first]
                unit, size, sent, token = views(sets, n, k1, k2)
                of = np.repeat(unit, sent)
                home = (unit >> np.uint64(2)) % np.uint64(parts)
                rows = [(1, p, b) for p, b in dealt(home.astype(np.int64), unit, size.astype(np.uint32), sent.astype(np.uint32))]
                values, inverse, count = np.unique(token, return_inverse=True, return_counts=True)
                common = (count >= max(COMMON, len(n) // 8))[inverse]
                to = ((of[common] >> np.uint64(2)) % np.uint64(parts)).astype(np.int64)
                rows += [(2, p, b) for p, b in dealt(to, of[common], token[common])]
                seen = values[count >= max(COMMON, len(n) // 8)]
                rows += [(3, p, b) for p, b in dealt((seen % np.uint64(parts)).astype(np.int64), seen)]
                token, of = token[~common], of[~common]
                rows += [(0, p, b) for p, b in dealt((token % np.uint64(parts)).astype(np.int64), token, of)]
                yield blob_batch(rows)

    return run


def _count(parts: int):
    """Kind 4: (unit, token, count) of shared tokens, to the unit's part."""

    def run(batches):
        found = by_kind(batches)
        token, unit = gathered(found.get(0, []), (np.uint64, np.uint64))
        (last,) = gathered(found.get(3, []), (np.uint64,))
        found.clear()
        order = np.lexsort((unit, token))
        token, unit = token[order], unit[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (unit[1:] != unit[:-1])
        token, unit = token[new], unit[new]
        start = np.flatnonzero(np.append(True, token[1:] != token[:-1])) if len(token) else np.zeros(0, np.int64)
        n = np.diff(np.append(start, len(token)))
        count = np.where(np.isin(token[start], last), LAST, n.astype(np.uint32)) if len(token) else np.zeros(0, np.uint32)
        count = np.repeat(count, n)
        shared = count > 1
        token, unit, count = token[shared], unit[shared], count[shared]
        yield blob_batch([(4, p, b) for p, b in dealt(((unit >> np.uint64(2)) % np.uint64(parts)).astype(np.int64), unit, token, count)])

    return run


def _prefixes(parts: int):
    """Kind 5: (token, least class here) of the prefixes of sets that aren't settled, to the token's part. Kind 6: edges to that class."""

    def run(batches):
        found = by_kind(batches)
        unit, size, sent = gathered(found.get(1, []), (np.uint64, np.uint32, np.uint32))
        unit, first = np.unique(unit, return_index=True)
        size, sent = size[first].astype(np.int64), sent[first].astype(np.int64)
        of, token, count = gathered(found.get(4, []), (np.uint64, np.uint64, np.uint32))
        of2, token2 = gathered(found.get(2, []), (np.uint64, np.uint64))
        found.clear()
        of, token, count = np.concatenate([of, of2]), np.concatenate([token, token2]), np.concatenate([count, np.full(len(of2), LAST, np.uint32)])
        order = np.lexsort((token, count, of))
        of, token, count = of[order], token[order], count[order]
        new = np.ones(len(of), bool)
        new[1:] = (of[1:] != of[:-1]) | (token[1:] != token[:-1])
        of, token = of[new], token[new]
        nth = np.searchsorted(unit, of)
        start = np.searchsorted(of, unit)
        shared = np.searchsorted(of, unit, side="right") - start
        room = prefix_length(size) - (sent - shared)  # unshared tokens come first
        take = np.arange(len(of)) - start[nth] < room[nth]
        token, of, edges = starred(token[take], of[take] & ~_VIEW)
        rows = [(5, p, b) for p, b in dealt((token % np.uint64(parts)).astype(np.int64), token, of)]
        yield blob_batch(rows + [(6, p, b) for p, b in dealt((edges[:, 0] % np.uint64(parts)).astype(np.int64), edges[:, 0], edges[:, 1])])

    return run


def starred(token: np.ndarray, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token with its least unit, and the distinct edges from the other units to it."""
    order = np.lexsort((unit, token))
    token, unit = token[order], unit[order]
    if not len(token):
        return token, unit, np.zeros((0, 2), np.uint64)
    start = np.append(True, token[1:] != token[:-1])
    least = unit[start][np.cumsum(start) - 1]
    return token[start], unit[start], np.unique(np.stack([unit, least], axis=1)[unit != least], axis=0)


def _stars(batches):
    """The edges of all tokens' buckets."""
    found = by_kind(batches)
    edges = starred(*gathered(found.get(5, []), (np.uint64, np.uint64)))[2]
    more = np.stack(gathered(found.get(6, []), (np.uint64, np.uint64)), axis=1)
    pairs = np.concatenate([edges, more]).view(np.int64)
    if len(pairs):
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def clusters(docs: DataFrame) -> DataFrame:
    """(id, root) of the classes (the first signature word without its view bits) that may have partners."""
    parts = wide(docs.sparkSession)
    blob = "kind int, pid int, blob binary"
    index = keep(docs.select(text_of().alias("text")).mapInArrow(_index(parts), blob), "index")
    counted = index.where("kind in (0, 3)").repartitionById(parts, F.col("pid")).mapInArrow(_count(parts), blob)
    told = index.where("kind in (1, 2)").union(counted)
    prefixes = told.repartitionById(parts, F.col("pid")).mapInArrow(_prefixes(parts), blob)
    edges = keep(prefixes.repartitionById(parts, F.col("pid")).mapInArrow(_stars, "a long, b long"), "stars")
    drop(index)
    return components(edges)


def ordered_prefix(tokens: np.ndarray, salt: int) -> np.ndarray:
    """The prefix of a set in the global order of a scrambling."""
    k = len(tokens) // 5 + 1
    scrambled = mix64(tokens ^ np.uint64(salt))
    return tokens[np.argpartition(scrambled, k - 1)[:k]] if k < len(tokens) else tokens


def verified(sets: list[np.ndarray], home: np.ndarray | None = None, counted: dict | None = None) -> list[tuple[int, int]]:
    """All pairs (i, j), i < j, of similarity 0.8 or more; with home, only those of different homes (0 and 1, ascending).

    counted gets the number of pairs that came to verification.
    """
    n = np.fromiter(map(len, sets), np.int64, len(sets))
    if len(sets) < 2 or (home is not None and (home[0] or not home[-1])):
        return []
    owner = np.repeat(np.arange(len(sets)), n)
    values, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    prefix = prefix_length(n)
    first = ranges(n) < prefix[owner]
    filters = []
    for by in (np.lexsort((mix64(values), count)), *(np.argsort(mix64(values ^ np.uint64(salt))) for salt in ORDERS)):
        rank = np.empty(len(values), np.int64)
        rank[by] = np.arange(len(values))
        t = token[np.lexsort((rank[token], owner))][first]
        o = owner[first]
        order = np.argsort(t, kind="stable")
        # the prefix tokens of each set, and the sets of each token
        filters.append((t, np.searchsorted(o, np.arange(len(sets) + 1)), o[order], np.searchsorted(t[order], np.arange(len(values) + 1))))
    by_token = np.argsort(token, kind="stable")
    o, at = owner[by_token], np.searchsorted(token[by_token], np.arange(len(values) + 1))
    mine = np.cumsum(n) - n
    every = np.arange(len(sets))
    out = []
    for i in range(len(sets) - 1) if home is None else np.flatnonzero(home == 0).tolist():
        found = ((every > i) if home is None else (home == 1)) & (5 * np.minimum(n, n[i]) >= 4 * np.maximum(n, n[i]))
        for t, cut, posting, start in filters:
            if not found.any():
                break
            tokens = t[cut[i] : cut[i + 1]]
            size = start[tokens + 1] - start[tokens]
            near = np.zeros(len(sets), bool)
            near[posting[np.repeat(start[tokens], size) + ranges(size)]] = True
            found &= near
        if not found.any():
            continue
        if counted is not None:
            counted["pairs"] = counted.get("pairs", 0) + int(found.sum())
        tokens = token[mine[i] : mine[i] + n[i]]
        size = at[tokens + 1] - at[tokens]
        both = np.bincount(o[np.repeat(at[tokens], size) + ranges(size)], minlength=len(sets))
        out += [(i, int(j)) for j in np.flatnonzero(found & (100 * both >= 80 * (n + n[i] - both)))]
    return out


def _verify(batches):
    """Links of each task key (rows come sorted by it): a spanning forest, and the number of links of each set."""
    names = ["a", "b", "links"]

    def links(keys, ids, home, sets):
        by = np.argsort(home, kind="stable")
        ids, sets, home = [ids[i] for i in by], [sets[i] for i in by], np.array(home)[by]
        found = verified(sets, None if keys[1] == keys[2] else home)  # of two blocks only the pairs between them
        root = list(range(len(sets)))

        def find(x):
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        rows, n = [], np.zeros(len(sets), np.int64)
        for i, j in found:
            n[[i, j]] += 1
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                rows.append((ids[i], ids[j], 0))
        rows += [(ids[i], None, int(k)) for i, k in enumerate(n) if k]
        cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols], names=names)

    keys, ids, home, sets = None, [], [], []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:3] != keys:
                if ids:
                    yield links(keys, ids, home, sets)
                keys, ids, home, sets = row[:3], [], [], []
            if ids and ids[-1] == row[3] and sets[-1].tobytes() == row[5]:
                continue  # a repeated row
            ids.append(row[3])
            home.append(row[4])
            sets.append(np.frombuffer(row[5], np.uint64))
    if ids:
        yield links(keys, ids, home, sets)
    release()


def _sets(batches):
    """The set and its two signature words for each text."""
    for batch in batches:
        for part in blocks(batch, "text"):
            sets, n = shingle_sets(*utf8(part.column(part.schema.get_field_index("text"))))
            k1, k2 = signatures(sets, n)
            columns = [c for c, name in zip(part.columns, part.schema.names, strict=True) if name != "text"]
            names = [name for name in part.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)), pa.array(n), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=[*names, "k1", "k2", "n_shingles", "tokens"],
            )


def _without_tokens(batches):
    for batch in _sets(batches):
        yield batch.select(["doc_id", "id", "k1", "k2", "n_shingles"])


def _prefix_entries(batches):
    """(root, cls, nth, token) of the prefixes under the nth order."""
    for batch in batches:
        root, cls = (batch.column(i).to_numpy() for i in range(2))
        sets = [np.frombuffer(t, np.uint64) for t in batch.column(2).to_pylist()]
        for nth, salt in enumerate(ORDERS):
            found = [ordered_prefix(s, salt) for s in sets]
            size = np.fromiter(map(len, found), np.int64, len(found))
            token = np.concatenate(found) if found else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(root, size)), pa.array(np.repeat(cls, size)), pa.array(np.full(len(token), nth, np.int32)), pa.array(token.view(np.int64))],
                names=["root", "cls", "nth", "token"],
            )


def _shared(entries: DataFrame) -> DataFrame:
    """The entries(root, cls, token) of tokens that several classes of a cluster share, with the bucket's least class and size."""
    buckets = entries.groupBy(F.col("root").alias("b_root"), F.col("token").alias("b_token")).agg(F.min("cls").alias("least"), F.count("*").alias("held")).where("held > 1")
    return lookup(entries, buckets, [("root", "b_root"), ("token", "b_token")], "held", entries.count()).drop("b_root", "b_token")


def _sizes(members: DataFrame) -> DataFrame:
    """(r, held_sets, parts) of each cluster of members(root, size): the number of its sets and of the blocks that hold them."""
    n = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_TOKENS)).cast("int")
    return members.groupBy(F.col("root").alias("r")).agg(F.count("*").alias("held_sets"), n.alias("parts"))


def _large_tasks(large: DataFrame) -> DataFrame:
    """(root, i, j, rep, home, tokens, k1) for the sets(root, rep, k1, n_shingles, tokens) of clusters above a block."""
    entries = keep(large.select("root", "k1", "tokens").mapInArrow(_prefix_entries, "root long, cls long, nth int, token long"), "entries")
    label = None
    for nth in range(len(ORDERS)):  # a pair shares a prefix token under each order
        own = entries.where(F.col("nth") == nth).drop("nth")
        if label is not None:
            own = own.drop("root").join(label, F.col("cls") == F.col("l_cls")).select("root", "cls", "token")
        edges = _shared(own).where("cls <> least").select(F.col("cls").alias("a"), F.col("least").alias("b"))
        label = keep(components(edges).select(F.col("id").alias("l_cls"), "root"), "label")
    classes = large.select(F.col("k1").alias("cls"), F.col("n_shingles").alias("size")).distinct()
    sizes = _sizes(classes.join(label, F.col("cls") == F.col("l_cls")))
    held = label.join(sizes, F.col("root") == F.col("r")).select("l_cls", "root", "held_sets", "parts")
    own = entries.where("nth = 0").select("cls", "token").join(held.where("parts > 1"), F.col("cls") == F.col("l_cls")).select("root", "cls", "token")
    shared = keep(_shared(own), "shared")
    # a bucket of m sets holds m (m - 1) / 2 pairs; (m - 1) / 2 of them fall to each
    bound = shared.groupBy(F.col("root").alias("p_root")).agg(F.sum((F.col("held") - 1) / 2).alias("pairs"))
    by_pair = F.coalesce(F.col("pairs") <= F.col("held_sets") * F.col("parts"), F.lit(False)) & (F.col("parts") > 1)
    held = keep(held.join(bound, F.col("root") == F.col("p_root"), "left").select("l_cls", F.col("root").alias("l_root"), "parts", by_pair.alias("by_pair")), "held")
    sets = large.select("rep", "k1", "tokens")
    home = F.pmod(F.xxhash64("rep", "k1"), F.col("parts").cast("long")).cast("int")
    # a block meets itself and every other block of its cluster
    dense = sets.join(held.where("not by_pair"), F.col("k1") == F.col("l_cls")).withColumn("home", home)
    dense = dense.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tasks = dense.select(
        F.col("l_root").alias("root"), F.least("home", "other").alias("i"), F.greatest("home", "other").alias("j"), "rep", (F.col("home") > F.col("other")).cast("int").alias("home"), "tokens", "k1"
    )
    sparse = held.where("by_pair")
    if sparse.isEmpty():
        return tasks
    some = shared.join(sparse.select("l_cls"), F.col("cls") == F.col("l_cls")).select("root", "token", "cls")
    other = some.select(F.col("root").alias("o_root"), F.col("token").alias("o_token"), F.col("cls").alias("b"))
    pairs = some.join(other, (F.col("root") == F.col("o_root")) & (F.col("token") == F.col("o_token"))).where("cls < b").select(F.col("cls").alias("a"), "b").distinct()
    pairs = keep(pairs, "pairs")
    degree = pairs.groupBy(F.col("a").alias("hub")).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("shares"))
    far = pairs.join(degree, F.col("a") == F.col("hub")).select("hub", F.col("b").alias("cls"), F.pmod(F.xxhash64("b"), F.col("shares").cast("long")).cast("int").alias("j"), F.lit(1).alias("home"))
    near = degree.select("hub", F.col("hub").alias("cls"), F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("j"), F.lit(0).alias("home"))
    met = sets.join(far.unionByName(near), F.col("k1") == F.col("cls"))
    return tasks.unionByName(met.select(F.col("hub").alias("root"), F.lit(-1).alias("i"), "j", "rep", "home", "tokens", "k1"))


def _tasks(sets: DataFrame) -> DataFrame:
    """(root, i, j, rep, home, tokens): the sets(root, parts, rep, k1, n_shingles, tokens) of each task of verification, sorted by task."""
    tasks = sets.where("parts = 1").select("root", F.lit(0).alias("i"), F.lit(0).alias("j"), "rep", F.lit(0).alias("home"), "tokens", "k1")
    large = sets.where("parts > 1")
    if not large.isEmpty():
        tasks = tasks.unionByName(_large_tasks(large))
    # the tasks of one cluster go round the partitions
    n = wide(sets.sparkSession)
    turn = F.xxhash64("root") + F.col("i") * F.lit(31) + F.col("j")
    dealt = tasks.repartitionById(n, F.pmod(turn, F.lit(n)).cast("int"))
    return dealt.sortWithinPartitions("root", "i", "j", "home", "rep", "k1").select("root", "i", "j", "rep", "home", "tokens", "k1")


def jaccard_join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for each row of docs(doc_id, text).

    n_links counts the other sets (not their copies) that the row's set links with.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = text_of()
    # rows without a doc_id take part under an id of their text
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(text)).alias("id"), text.alias("text"))
    prints = keep(rows.mapInArrow(_without_tokens, "doc_id long, id long, k1 long, k2 long, n_shingles long"), "sets")
    key = ["k1", "k2", "n_shingles"]
    classes = prints.where("n_shingles > 0").groupBy(*key).agg(F.min("id").alias("rep"), F.min("doc_id").alias("least"), F.count("*").alias("class_size"))
    may = clusters(rows)
    members = classes.join(may, (F.col("k1").bitwiseAND(F.lit(-4))) == F.col("id")).select(F.col("k1").alias("m1"), F.col("k2").alias("m2"), F.col("n_shingles").alias("size"), "rep", "root")
    members = keep(members, "members")
    members = keep(members.join(_sizes(members), F.col("root") == F.col("r")).select("m1", "m2", "rep", "root", "parts"), "placed")
    # merged at every size: what may link grows with the corpus
    asked = semi_filter(rows.select("id", "text"), members, "id", "rep").hint("merge").join(members, F.col("id") == F.col("rep")).drop("id")
    sets = asked.mapInArrow(_sets, "m1 long, m2 long, rep long, root long, parts int, k1 long, k2 long, n_shingles long, tokens binary")
    sets = keep(sets.where("m1 = k1 and m2 = k2").select("root", "parts", "rep", "k1", "n_shingles", "tokens"), "tokens")
    tasks = _tasks(sets)
    links = keep(tasks.mapInArrow(_verify, "a long, b long, links long"), "links")
    drop(sets)
    joined = components(links.where("b is not null").select("a", "b")).withColumnRenamed("id", "node").withColumnRenamed("root", "link_root")
    n_links = links.where("b is null").groupBy(F.col("a").alias("linked")).agg(F.sum("links").alias("n_links"))
    # rows of other classes are their own component
    found = classes.join(joined, F.col("rep") == F.col("node"), "left").where("class_size > 1 or node is not null").join(n_links, F.col("rep") == F.col("linked"), "left")
    found = found.withColumn("group", F.coalesce("link_root", "rep"))
    # the smallest doc_id of a component, over classes: its root may stand for a row without one
    least = found.where("link_root is not null").groupBy("link_root").agg(F.min("least").alias("component")).withColumnRenamed("link_root", "g")
    found = found.join(least, F.col("group") == F.col("g"), "left")
    component = F.when(F.col("g").isNotNull(), F.col("component")).otherwise(F.col("least"))
    found = keep(found.select(*(F.col(c).alias(f"c_{c}") for c in key), component.alias("component"), "n_links", "class_size"), "found")
    out = lookup(prints, found, [(c, f"c_{c}") for c in key], "class_size", prints.count(), "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("class_size").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )
