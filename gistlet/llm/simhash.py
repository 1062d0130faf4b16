"""SimHash near-duplicates: a binary trie of fingerprints joined with itself.

The distinct fingerprints form a binary trie. The join walks pairs of its nodes together
from (root, root), adds up the bits in which the two prefixes differ and drops a pair as soon
as that is more than the budget. Two fingerprints within 2 bits agree on at least one of
three blocks of bits, so the trie is dealt out as the subtries below equal blocks: each is
walked by one task with the whole budget left. A subtrie of more than ``SPLIT``
fingerprints is dealt out again by three blocks of its remaining bits, twice at most; what
then agrees on 45 bits has fewer than 2^19 fingerprints. A task gives no pairs but a star
for each set of fingerprints that it found connected, which loses no connection; stars are
merged by alternating large-star and small-star steps.

Null and wordless texts have fingerprint zero and link as any other. Rows that share a
doc_id are linked to each other only through their fingerprints. Ties: the smallest
doc_id names a component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gistlet.llm.common import LOWER, SPACES, bound_batches, one_of_each, row_key, row_slices, text_bytes, word_spans, written

SHINGLE, DISTANCE, SEED = 3, 2, 42
SPLIT = 1 << 13
FRONTIER = 1 << 18      # node pairs walked at once


# ------------------------------------------------------------------ fingerprints

_P = [np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161,
                             9650029242287828579, 2870177450012600261)]    # fixed values: the primes of XXH64


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxh64_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """XXH64 of byte spans; the algorithm's branch for under 32 bytes on arrays, longer spans by the library."""
    buf = np.concatenate([data, np.zeros(8, np.uint8)])
    wide = np.ndarray(len(data) + 1, "<u8", buf, strides=(1,))
    half = np.ndarray(len(data) + 1, "<u4", buf, strides=(1,))
    h = np.uint64(SEED) + _P[4] + lengths.astype(np.uint64)
    pos, left = starts.copy(), lengths.copy()
    for _ in range(3):
        m = np.flatnonzero((left >= 8) & (lengths < 32))
        if not len(m):
            break
        k = _rotl(wide[pos[m]] * _P[1], 31) * _P[0]
        h[m] = _rotl(h[m] ^ k, 27) * _P[0] + _P[3]
        pos[m] += 8
        left[m] -= 8
    m = np.flatnonzero((left >= 4) & (left < 8))
    h[m] = _rotl(h[m] ^ (half[pos[m]].astype(np.uint64) * _P[0]), 23) * _P[1] + _P[2]
    pos[m] += 4
    left[m] -= 4
    for _ in range(3):
        m = np.flatnonzero((left >= 1) & (left < 4))
        h[m] = _rotl(h[m] ^ (buf[pos[m]].astype(np.uint64) * _P[4]), 11) * _P[0]
        pos[m] += 1
        left[m] -= 1
    h = (h ^ (h >> np.uint64(33))) * _P[1]
    h = (h ^ (h >> np.uint64(29))) * _P[2]
    h ^= h >> np.uint64(32)
    long = np.flatnonzero(lengths >= 32)
    if len(long):
        view = memoryview(buf.tobytes())
        digest = xxhash.xxh64_intdigest
        h[long] = np.fromiter((digest(view[s:s + n], SEED) for s, n in
                               zip(starts[long].tolist(), lengths[long].tolist(), strict=True)), np.uint64, len(long))
    return h


def simhashes(data: np.ndarray, offs: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each row of lower-cased word shingles."""
    low = LOWER[data]
    inside = ~SPACES[low]
    starts, ends, first = word_spans(inside, offs)
    # one space between words: the first byte after a word stays
    keep = inside.copy()
    keep[ends[ends < len(low)]] = True
    new = np.cumsum(keep) - 1
    text = np.where(inside, low, np.uint8(32))[keep]
    starts, ends = (new[starts], new[ends - 1] + 1) if len(starts) else (starts, ends)
    counts = np.diff(first)
    n = len(counts)
    doc = np.repeat(np.arange(n), counts)
    w = np.arange(len(starts))
    last = np.minimum(w + shingle, first[1:][doc]) - 1
    use = (w + shingle <= first[1:][doc]) | (w == first[:-1][doc])
    doc, s, e = doc[use], starts[use], ends[last[use]]
    total = np.bincount(doc, minlength=n)
    ones = np.zeros((n, 64), np.int64)
    for a in range(0, len(s), 1 << 15):
        b = min(a + (1 << 15), len(s))
        lo, hi = int(s[a]), int(e[a:b].max())
        h = xxh64_spans(text[lo:hi], s[a:b] - lo, e[a:b] - s[a:b])
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        d = doc[a:b]
        at = np.flatnonzero(np.append(True, d[1:] != d[:-1]))
        ones[d[at]] += np.add.reduceat(bits, at, axis=0, dtype=np.int32)
    out = np.packbits(2 * ones > total[:, None], axis=1, bitorder="little")
    return out.view("<u8").reshape(-1).astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE, key: Column | None = None) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) and key, if given, of every row."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            out = [simhashes(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i], shingle) for i, j in row_slices(offs)]
            fp = np.concatenate(out) if out else np.zeros(0, np.uint64)
            more = [batch.column(2)] if batch.num_columns > 2 else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64)), *more],
                                             names=["doc_id", "fp", "key"][:2 + len(more)])

    rows = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t")]
    if key is None:
        return docs.select(*rows).mapInArrow(run, "doc_id long, fp long")
    return docs.select(*rows, key.alias("key")).mapInArrow(run, "doc_id long, fp long, key binary")


# ------------------------------------------------------------------ trie self-join

def _roots(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return up
        parent = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``parent`` (a root each) with the sets of a[i] and b[i] put together; the smallest index is a set's root."""
    while True:
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        if not open_.any():
            return parent
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        parent = _roots(parent)


def trie_sets(fp: np.ndarray, group: np.ndarray, budget: int = DISTANCE) -> np.ndarray:
    """Root index of each element's connected set; ``fp`` (uint64) ascends within each group, groups stand together.

    A node is a range of ``fp`` with a common prefix. The work list holds (depth, pairs of
    nodes, differing bits so far); pairs beyond the budget are not followed.
    """
    n = len(fp)
    parent = np.arange(n)
    at = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else np.zeros(0, np.int64)
    end = np.append(at[1:], n)
    many = end - at > 1
    at, end = at[many].astype(np.int64), end[many].astype(np.int64)
    zero = np.zeros(len(at), np.int64)
    work = [(0, at, end, at, end, zero)]
    while work:
        depth, lo, hi, lo2, hi2, far = work.pop()
        if not len(lo) or depth == 64:
            if len(lo):      # equal fingerprints that were not made distinct
                parent = _unite(parent, lo, lo2)
            continue
        if len(lo) > FRONTIER:
            cut = len(lo) // 2
            work += [(depth, *(x[:cut] for x in (lo, hi, lo2, hi2, far))),
                     (depth, *(x[cut:] for x in (lo, hi, lo2, hi2, far)))]
            continue
        same = lo == lo2
        leaves = (hi - lo == 1) & (hi2 - lo2 == 1)
        pair = leaves & ~same
        if pair.any():
            a, b = lo[pair], lo2[pair]
            near = np.bitwise_count(fp[a] ^ fp[b]) <= budget
            parent = _unite(parent, a[near], b[near])
        more = ~leaves
        lo, hi, lo2, hi2, far, same = (x[more] for x in (lo, hi, lo2, hi2, far, same))
        if not len(lo):
            continue

        set_before = np.append(0, np.cumsum((fp >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int64))
        mid, mid2 = hi - set_before[hi] + set_before[lo], hi2 - set_before[hi2] + set_before[lo2]
        new = []
        for x, y, u, v, step in ((lo, mid, lo2, mid2, 0), (mid, hi, mid2, hi2, 0),
                                 (lo, mid, mid2, hi2, 1), (mid, hi, lo2, mid2, 1)):
            # below one node, (1, 0) is the mirror of (0, 1)
            live = (x < y) & (u < v) & (far + step <= budget)
            if step and x is mid:
                live &= ~same
            single = (x == u) & (y - x == 1)
            live &= ~single
            new.append([c[live] for c in (x, y, u, v, far + step)])
        work.append((depth + 1, *(np.concatenate(c) for c in zip(*new, strict=True))))
    return parent


def _thirds(mask: int) -> list[int]:
    """The set bits of ``mask`` dealt into three runs."""
    bits = [i for i in range(63, -1, -1) if mask >> i & 1]
    size = -(-len(bits) // 3)
    return [sum(1 << i for i in bits[k:k + size]) for k in range(0, len(bits), size)]


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _dealt(rows: DataFrame, masks: list[int]) -> DataFrame:
    """Each fingerprint below each of the blocks that ``masks`` select: mask, key, fp."""
    each = F.explode(F.array(*[F.lit(_long(m)).cast("long") for m in masks]))
    return rows.select("fp", each.alias("mask")).select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")


def links(distinct: DataFrame, split: int = SPLIT) -> DataFrame:
    """Edges (a, b) of fingerprints whose connected sets are those of all links; ``distinct``: fp."""
    full = (1 << 64) - 1
    masks = _thirds(full)
    rows, parts = _dealt(distinct, masks), []
    for level in range(2):
        hot = written(rows.groupBy("mask", "key").count().where(F.col("count") > split).select("mask", "key"),
                      f"hot{level}")
        if hot.isEmpty():
            break
        parts.append(rows.join(hot, ["mask", "key"], "left_anti"))
        again = rows.join(hot, ["mask", "key"], "left_semi")
        deeper = [(m, [m | x for x in _thirds(full & ~m)]) for m in masks]
        subs = F.coalesce(*[F.when(F.col("mask") == _long(m), F.array(*[F.lit(_long(x)).cast("long") for x in xs]))
                            for m, xs in deeper])
        rows = (again.select("fp", F.explode(subs).alias("mask"))
                .select("mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp"))
        masks = [x for _, xs in deeper for x in xs]
    for p in parts:
        rows = rows.unionByName(p)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def stars(held: list[pa.RecordBatch], whole: bool):
            """Edges of the groups in ``held``, and the rows of its last group if that may go on."""
            mask, key, fp = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in range(3))
            group = np.cumsum(np.append(0, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])))
            n = len(fp) if whole else int(np.searchsorted(group, group[-1]))
            rest = pa.RecordBatch.from_arrays([pa.array(x[n:]) for x in (mask, key, fp)], names=["mask", "key", "fp"])
            bits, group = fp[:n].view(np.uint64), group[:n]
            order = np.lexsort((bits, group))
            bits, group = bits[order], group[order]
            root = trie_sets(bits, group)
            m = np.flatnonzero(root != np.arange(n))
            a, b = bits[root[m]].view(np.int64), bits[m].view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"]), [rest] if len(rest) else []

        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size >= 1 << 17:
                out, held = stars(held, False)
                size = sum(b.num_rows for b in held)
                yield out
        if held:
            yield stars(held, True)[0]

    ordered = rows.repartition("mask", "key").sortWithinPartitions("mask", "key")
    return ordered.mapInArrow(run, "a long, b long").where("a <> b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) but the roots; alternating large-star and small-star steps."""
    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = mark(now)
    for _ in range(rounds):
        if not seen[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # what a step joins with is written, so that both sides of the join are dealt out anew and a hub's edges can be split
        low = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m")), "low")
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.where("a <> b").distinct(), "large")
        least = written(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = (large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select("a", F.col("m").alias("b"))))
        now = written(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "small")
        last, seen = seen, mark(now)
        if last == seen:
            break
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _linked(prints: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of each fingerprint: (of, root), where linked ones share the root; and (fp, least): its smallest doc_id."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("fp")))
    member = distinct.join(roots, distinct.fp == roots.node, "left")
    return member.select(F.col("fp").alias("of"), F.coalesce("root", "fp").alias("root")), distinct


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable over links) of every row."""
    prints = written(fingerprints(docs, id_col, text_col), "simhash")
    linked, distinct = _linked(prints)
    member = distinct.join(linked, distinct.fp == linked.of).select("fp", "least", "root")
    named = member.groupBy("root").agg(F.min("least").alias("component_id"))
    # written, so that the last join deals out both sides itself and can split a hot fingerprint
    names = written(member.join(named, "root").select(F.col("fp").alias("of"), "component_id"), "components")
    return prints.join(names, prints.fp == names.of).select("doc_id", "fp", "component_id")


def hexed(result: DataFrame) -> DataFrame:
    return result.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest doc_id, see ``one_of_each``."""
    key = row_key(docs, "doc_id", "text")
    prints = written(fingerprints(docs, key=key), "simhash")
    linked = written(_linked(prints)[0], "linked")
    return one_of_each(docs, key, prints.join(linked, prints.fp == linked.of), "root")
