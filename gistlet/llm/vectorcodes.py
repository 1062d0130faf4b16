"""Vector codes: product quantisation by dual-tree Lloyd rounds, in integers.

Vectors become integers (floor of ``SCALE`` times a component) and are cut into ``PARTS`` consecutive
parts with a codebook each. The vectors stand in blocks; a block keeps, for each part, the order of a
tree over its vectors (halves at the median of the widest component), and is written once. A Lloyd round
walks that tree and a tree over the codebook's entries together, level by level, with all pairs of
nodes that are left in one array. The least and the greatest possible distance of two boxes
prune a pair whose least distance is over the smallest greatest one; pairs that may tie stay. A node
with one entry left is assigned whole: its count and its sum come from running sums over the tree's
order, and none of its vectors is looked at. Leaves with several entries left are decided by exact
squared distances in integers, the lower index at a tie. Spark adds up counts and sums by part and
entry; the driver sees one row for each entry and works out the next codebook.

Results do not depend on blocks or trees. A null vector, one with a null, NaN or infinite component, an
empty one, and one whose width differs from that of the kept vector with the smallest id are left out.
Null ids come after all others; rows that repeat an id are vectors of their own (by their components).
Fewer than ``ENTRIES`` vectors give as many entries; an empty table gives no row. A width that is no
multiple of ``PARTS`` makes the first parts wider by one. Components that would overflow 64 bits raise.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gistlet.llm.common import bound_batches, written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
BLOCK = 4096        # vectors of a block
LEAF = 32           # vectors of a leaf, at most
LABELS = 100_000    # labels whose sums are broadcast; more are joined
EXACT = 1 << 53     # doubles hold integers up to here

BLOCKS = "n int, ids binary, null_ids binary, labels binary, null_labels binary, points binary, orders binary"


# ------------------------------------------------------------------ trees

def bounds(n: int, leaf: int) -> list[np.ndarray]:
    """Starts (and n) of the nodes of each level of a tree over n rows: every node halved until none is over ``leaf``."""
    levels = [np.array([0, n])]
    while np.diff(levels[-1]).max(initial=0) > leaf:
        a = levels[-1]
        levels.append(np.sort(np.concatenate([a, (a[:-1] + a[1:] + 1) // 2])))
    return levels


def tree_order(x: np.ndarray, leaf: int) -> np.ndarray:
    """Rows of ``x`` in tree order: each node's rows are divided at the median of its widest component."""
    order = np.arange(len(x))
    levels = bounds(len(x), leaf)
    for here, below in zip(levels[:-1], levels[1:], strict=True):
        for i in range(len(here) - 1):
            a, b, mid = here[i], here[i + 1], below[2 * i + 1]
            if b - a > 1 and x.shape[1]:
                own = x[order[a:b]]
                widest = int(np.argmax(own.max(0) - own.min(0)))
                order[a:b] = order[a:b][np.argpartition(own[:, widest], mid - a if mid < b else b - a - 1)]
    return order


class Tree:
    """Boxes of the nodes of each level over rows that are in tree order, and running sums of the rows."""

    def __init__(self, x: np.ndarray, leaf: int):
        self.x = x
        self.starts = bounds(len(x), leaf)
        last, ended = self.starts[-1][:-1], np.concatenate([x, x[-1:]])     # an empty last leaf has a box, too
        lo, hi = np.minimum.reduceat(ended, last, axis=0), np.maximum.reduceat(ended, last, axis=0)
        self.lo, self.hi = [lo], [hi]
        for _ in self.starts[1:]:
            lo, hi = np.minimum(lo[::2], lo[1::2]), np.maximum(hi[::2], hi[1::2])
            self.lo.insert(0, lo)
            self.hi.insert(0, hi)
        self.sums = np.zeros((len(x) + 1, x.shape[1]), np.int64)
        np.cumsum(x, axis=0, out=self.sums[1:])


def dual(points: Tree, entries: Tree, names: np.ndarray) -> tuple[list, list]:
    """Walks both trees. Whole nodes: (start, stop, entry); uncertain leaves: (start, stop, their entries, ascending)."""
    whole, leaves = [], []
    p, e, lp, le = np.zeros(1, np.int64), np.zeros(1, np.int64), 0, 0
    while len(p):
        plo, phi, elo, ehi = points.lo[lp][p], points.hi[lp][p], entries.lo[le][e], entries.hi[le][e]
        apart = np.maximum(np.maximum(elo - phi, plo - ehi), 0)
        across = np.maximum(phi - elo, ehi - plo)
        least, most = (apart * apart).sum(1), (across * across).sum(1)
        first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        sizes = np.diff(np.append(first, len(p)))
        near = np.repeat(np.minimum.reduceat(most, first), sizes)
        keep = least <= near
        p, e = p[keep], e[keep]
        first = np.flatnonzero(np.append(True, p[1:] != p[:-1]))
        sizes = np.diff(np.append(first, len(p)))
        at = points.starts[lp]
        single, bottom = le == len(entries.starts) - 1, lp == len(points.starts) - 1
        if single:
            one = np.repeat(sizes == 1, sizes)
            entry = names[entries.starts[le][e]]
            whole += zip(at[p[one]].tolist(), at[p[one] + 1].tolist(), entry[one].tolist(), strict=True)
            p, e, entry = p[~one], e[~one], entry[~one]
            if bottom or not len(p):
                ends = np.flatnonzero(np.append(p[1:] != p[:-1], True))[:len(p)] + 1
                for i, j in zip([0, *ends.tolist()], ends.tolist(), strict=False):
                    leaves.append((int(at[p[i]]), int(at[p[i] + 1]), np.sort(entry[i:j])))
                break
        if not single:
            p, e, le = np.repeat(p, 2), (2 * np.repeat(e, 2)) + np.tile([0, 1], len(e)), le + 1
        if not bottom:
            # the pairs of a node stand together: those of its two halves must, too
            lower, upper = 2 * p, 2 * p + 1
            order = np.argsort(np.concatenate([lower, upper]), kind="stable")
            p, e, lp = np.concatenate([lower, upper])[order], np.concatenate([e, e])[order], lp + 1
        # halves of a node of one row can be empty
        size = np.diff(points.starts[lp])[p]
        held = np.diff(entries.starts[le])[e]
        p, e = p[(size > 0) & (held > 0)], e[(size > 0) & (held > 0)]
    return whole, leaves


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows, as integers (held in doubles where those are exact)."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    if 4 * most * most * max(x.shape[1], 1) < EXACT:
        a, b = x.astype(np.float64), y.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    gap = x[:, None, :] - y[None, :, :]
    return (gap * gap).sum(2)


class Codebook:
    """A part's entries, with their tree down to single entries."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.names = tree_order(entries, 1)
        self.tree = Tree(entries[self.names], 1)

    def tallies(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and sum of the rows nearest to each entry; ``x`` is in tree order."""
        n, s = np.zeros(len(self.entries), np.int64), np.zeros(self.entries.shape, np.int64)
        points = Tree(x, LEAF)
        whole, leaves = dual(points, self.tree, self.names)
        for a, b, e in whole:
            n[e] += b - a
            s[e] += points.sums[b] - points.sums[a]
        for a, b, own in leaves:
            near = own[distances(x[a:b], self.entries[own]).argmin(1)]
            np.add.at(n, near, 1)
            np.add.at(s, near, x[a:b])
        return n, s

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row and its squared distance."""
        code = np.zeros(len(x), np.int64)
        whole, leaves = dual(Tree(x, LEAF), self.tree, self.names)
        for a, b, e in whole:
            code[a:b] = e
        for a, b, own in leaves:
            code[a:b] = own[distances(x[a:b], self.entries[own]).argmin(1)]
        gap = x - self.entries[code]
        return code, (gap * gap).sum(1)


# ------------------------------------------------------------------ blocks

def cuts(width: int, parts: int = PARTS) -> list[tuple[int, int]]:
    size = [width // parts + (i < width % parts) for i in range(parts)]
    return [(sum(size[:i]), sum(size[:i + 1])) for i in range(parts)]


def _bits(arr: pa.Array) -> bytes:
    return arr.is_null().to_numpy(zero_copy_only=False).tobytes()


def _blocks(width: int, parts: int) -> Callable:
    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        ids, labels = t.column("id").combine_chunks(), t.column("label").combine_chunks()
        x = np.floor(t.column("v").combine_chunks().flatten().to_numpy() * SCALE).reshape(len(t), width)
        if 4 * float(np.abs(x).max(initial=0) + 1) ** 2 * width >= 2.0 ** 62:
            raise OverflowError("a component is too large for 64-bit squared distances")
        x = x.astype(np.int64)
        orders = [tree_order(x[:, a:b], LEAF).astype(np.int32) for a, b in cuts(width, parts)]
        row = (len(t), ids.fill_null(0).to_numpy().astype(np.int64).tobytes(), _bits(ids),
               labels.fill_null(0).to_numpy().astype(np.int64).tobytes(), _bits(labels),
               x.astype(np.int32 if np.abs(x).max(initial=0) < 1 << 31 else np.int64).tobytes(), np.concatenate(orders).tobytes())
        kinds = [pa.int32()] + [pa.binary()] * 6
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)],
                                          names=[c.split()[0] for c in BLOCKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            while b.num_rows:
                take = b.slice(0, BLOCK - size)
                held.append(take)
                b, size = b.slice(take.num_rows), size + take.num_rows
                if size == BLOCK:
                    yield block(held)
                    held, size = [], 0
        if size:
            yield block(held)
    return run


def _read(row: dict, width: int, parts: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each part of a block: the order of its tree, and its rows in that order."""
    n = row["n"]
    x = np.frombuffer(row["points"], np.int32 if len(row["points"]) == 4 * n * width else np.int64).reshape(n, width)
    orders = np.frombuffer(row["orders"], np.int32).reshape(parts, n)
    for (a, b), order in zip(cuts(width, parts), orders, strict=True):
        yield order, x[order, a:b].astype(np.int64)


def _round(books, width: int, parts: int) -> Callable:
    most = max(b - a for a, b in cuts(width, parts))
    names = ["part", "entry", "n", *[f"s{i}" for i in range(most)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Codebook(b) for b in books.value]
        n = [np.zeros(len(b.entries), np.int64) for b in trees]
        s = [np.zeros((len(b.entries), most), np.int64) for b in trees]
        for batch in batches:
            for row in batch.to_pylist():
                for k, (_, x) in enumerate(_read(row, width, parts)):
                    own_n, own_s = trees[k].tallies(x)
                    n[k] += own_n
                    s[k][:, :x.shape[1]] += own_s
        for k in range(parts):
            used = np.flatnonzero(n[k])
            if len(used):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(used), k, np.int32)), pa.array(used.astype(np.int32)),
                                                  pa.array(n[k][used]), *[pa.array(s[k][used, i]) for i in range(most)]], names=names)
    return run


def _final(books, width: int, parts: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Codebook(b) for b in books.value]
        for batch in batches:
            for row in batch.to_pylist():
                n = row["n"]
                code, error = np.zeros((n, parts), np.uint8 if ENTRIES <= 256 else np.uint16), np.zeros(n, np.int64)
                for k, (order, x) in enumerate(_read(row, width, parts)):
                    c, e = trees[k].codes(x)
                    code[order, k] = c
                    error[order] += e
                text = [bytes(r).hex() for r in code]
                ids = pa.array(np.frombuffer(row["ids"], np.int64), mask=np.frombuffer(row["null_ids"], bool))
                labels = pa.array(np.frombuffer(row["labels"], np.int64), mask=np.frombuffer(row["null_labels"], bool))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text, pa.string()), pa.array(error)],
                                                 names=["vec_id", "label", "code", "error"])
    return run


# ------------------------------------------------------------------ rounds

def codebooks(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
              parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[list[np.ndarray], DataFrame, int]:
    """The final codebooks, one array (entries, part width) for each part; the written blocks; the width (0: no vector)."""
    spark = vectors.sparkSession
    bound_batches(spark)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    fit = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & fit)
    first = rows.agg(F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("v"))).alias("f")).select(F.size("f.v")).first()[0]
    width = max(first or 0, 0)
    if not width:
        return [np.zeros((0, 0), np.int64)] * parts, rows, 0
    rows = rows.where(F.size("v") == width)
    least = rows.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").collect()   # at most ``entries`` rows
    start = np.floor(np.array([r[0] for r in least]) * SCALE).astype(np.int64)
    books = [start[:, a:b] for a, b in cuts(width, parts)]
    blocks = written(rows.mapInArrow(_blocks(width, parts), BLOCKS), "blocks")
    most = max(b - a for a, b in cuts(width, parts))
    schema = "part int, entry int, n long, " + ", ".join(f"s{i} long" for i in range(most))
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(books)      # parts x entries x width integers
        found = blocks.mapInArrow(_round(held, width, parts), schema)
        sums = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(most)])
        books = [b.copy() for b in books]
        for r in sums.collect():                        # one row for each entry in use
            own = books[r["part"]]
            own[r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(own.shape[1])]
        held.destroy()
    return books, blocks, width


def digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                 labels: int = LABELS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every kept vector."""
    spark = vectors.sparkSession
    books, blocks, width = codebooks(vectors, id_col, vec_col, label_col)
    if not width:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    held = spark.sparkContext.broadcast(books)
    coded = written(blocks.mapInArrow(_final(held, width, PARTS), "vec_id long, label long, code string, error long"), "codes")
    key = [F.col("label").isNull().alias("no_label"), F.coalesce("label", F.lit(0)).alias("of")]
    sums = written(coded.groupBy(*key).agg(F.sum("error").alias("label_error")), "label-errors")
    if sums.count() <= labels:
        sums = F.broadcast(sums)
    out = coded.select("vec_id", "code", "error", *key).join(sums, ["no_label", "of"])
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
