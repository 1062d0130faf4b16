"""Prefix trie of conversations by van Emde Boas recursion.

A conversation is a sequence of turns, a turn the SHA-256 of its role and text. The trie of all
sequences over depths [0, 2^K) is not built turn by turn: it is cut at half depth, every distinct
prefix that reaches the cut gets a name, the upper trie goes on with one sequence for each name (with
the number of conversations behind it), and the lower forest goes on with what stands below each name.
All parts of one height are cut together, in one join and one grouping, so there are K rounds for
conversations of up to 2^K turns, however many there are, and a part that many conversations share
goes on as one row. A cut at depth d = a + 2^k needs the hash of the turns [a, d): an aligned run,
folded pairwise in blocks of 64 turns. A name is the hash of the name at ``a`` and that run, so
naming needs no join back, and the smallest member comes from the grouping.

Totals go up in two sweeps. Lowest parts first, each node sums what lies below it inside its own part;
then, highest parts first, the totals of the nodes at a part's lower end are grafted onto it.

Null conv_id belongs to no conversation and is left out. Turns are ordered by ``turn`` (null first),
those with the same one by the SHA-256 of role length, role and text; equal rows are turns of their
own. Null role or text is empty. An empty table has no node; a conversation without turns is a
member of the root. Only the SHA-256 of a node's ends is sequential: chunks of ids stream through
the task that makes it, in order, and none is held.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gistlet.llm.common import bound_batches, written

FOLD = 6                # levels folded at once: blocks of 64 turns
HEAD = 5                # turns of the base conversation that a rebuilt one can start with
IDS = 4096              # ids of a chunk whose text is hashed at once
ROOT = b"\0" * 32       # name of the empty prefix
TOP = 99                # level of the root

ITEMS = "conv long, at long, h binary, chars long, full boolean"
FOLDED = "kind int, k int, conv long, at long, h binary, chars long, full boolean"


# ------------------------------------------------------------------ sequences

def ordered(conversations: DataFrame) -> DataFrame:
    """conv, pos (from 0 in the conversation), h, chars of every turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = (conversations.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"),
                    F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("h"),
                    F.char_length(text).cast("long").alias("chars"), F.rand(11).alias("any")))
    # turns of one conversation may fill many ranges: numbered in each range, then the ranges before are added
    order = ["conv", F.col("turn").asc_nulls_first(), "h", "any"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            conv = b.column(0).to_numpy()
            first = np.append(True, conv[1:] != conv[:-1])
            heads = np.flatnonzero(first)
            at = np.arange(len(conv)) - np.repeat(heads, np.diff(np.append(heads, len(conv))))
            if conv[0] == last:
                at[:heads[1] if len(heads) > 1 else len(conv)] += seen
            last, seen = conv[-1], int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(at), b.column(1), b.column(2),
                                              pa.array(np.full(len(conv), part, np.int32))],
                                             names=["conv", "at", "h", "chars", "part"])

    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "h", "chars")
                     .mapInArrow(number, "conv long, at long, h binary, chars long, part int"), "turns")
    per = placed.groupBy("conv", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    moved = per.select("conv", "part", before.alias("before")).where("before > 0")
    # a range has at most one conversation that began in an earlier one: no more rows than ranges
    out = placed.join(F.broadcast(moved), ["conv", "part"], "left")
    return out.select("conv", (F.col("at") + F.coalesce("before", F.lit(0))).alias("pos"), "h", "chars")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv, n) of each, and their turns (conv, pos, h, chars)."""
    turns = written(turns, "places")
    convs = turns.groupBy("conv").agg((F.max("pos") + 1).alias("own"))
    heads = (turns.where((F.col("pos") < HEAD) & (F.col("conv") % 100 == 0)).groupBy(F.col("conv").alias("base"))
             .agg(F.array_sort(F.collect_list(F.struct("pos", "h", "chars"))).alias("head")))
    skip = (F.crc32(F.col("conv").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    plan = convs.select("conv", "own", skip.alias("skip"), (F.col("conv") - F.col("conv") % 100).alias("base"))
    taken = F.coalesce(F.slice("head", F.lit(1), F.col("skip")), F.array().cast("array<struct<pos:bigint,h:binary,chars:bigint>>"))
    plan = plan.join(heads, "base", "left").select("conv", "own", "skip", taken.alias("taken"))
    plan = written(plan.withColumn("n", F.size("taken") + F.greatest(F.col("own") - F.col("skip"), F.lit(0))), "rebuilt")
    shared = plan.select("conv", F.explode_outer("taken").alias("t")).where("t is not null").select("conv", "t.pos", "t.h", "t.chars")
    rest = (turns.join(plan.select("conv", "skip", F.size("taken").alias("m")), "conv").where("pos >= skip")
            .select("conv", (F.col("pos") - F.col("skip") + F.col("m")).alias("pos"), "h", "chars"))
    return plan.select("conv", F.col("n").cast("long").alias("n")), shared.unionByName(rest)


# ------------------------------------------------------------------ aligned runs

def _fold(base: int):
    """Folds blocks of up to 64 neighbouring items pairwise: the aligned runs that end at each, and the block itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row in b.to_pylist():
                items, conv, block = row["items"], row["conv"], row["block"]
                level = [x["h"] for x in items]
                whole = len(items) - (not items[-1]["full"])      # only the last may be cut off
                for k in range(FOLD + 1):
                    size = 1 << k
                    if k < FOLD:
                        for i in range(0, len(level), 2):         # left halves end at depths with this many trailing zeros
                            j = (i + 1) * size
                            if j <= whole:
                                out.append((0, base + k, conv, (block * 64 + j) << base, level[i], items[j - 1]["chars"], True))
                        level = [hashlib.sha256(level[i] + (level[i + 1] if i + 1 < len(level) else b"")).digest()
                                 for i in range(0, len(level), 2)]
                out.append((1, base + FOLD, conv, block, level[0], items[-1]["chars"], whole == 64))
            if out:
                cols = list(zip(*out, strict=True))
                kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)],
                                                 names=["kind", "k", "conv", "at", "h", "chars", "full"])
    return run


def aligned(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Runs (k, conv, at, h, chars): turns [at - 2^k, at), where 2^k is the lowest bit of ``at``; and (conv, whole) hashes."""
    items, base, runs = turns.select("conv", F.col("pos").alias("at"), "h", "chars", F.lit(True).alias("full")), 0, []
    while True:
        blocks = (items.groupBy("conv", F.shiftright("at", FOLD).alias("block"))
                  .agg(F.array_sort(F.collect_list(F.struct("at", "h", "chars", "full"))).alias("items")))
        folded = written(blocks.select("conv", "block", "items").mapInArrow(_fold(base), FOLDED)
                         .sortWithinPartitions("kind", "k", "conv"), f"runs{base}")
        runs.append(folded.where("kind = 0").select("k", "conv", "at", "h", "chars"))
        items, base = folded.where("kind = 1").select("conv", "at", "h", "chars", "full"), base + FOLD
        last = items.agg(F.max("at")).first()[0]
        if not last:
            break
    # a conversation is one item now; each fold keeps what the longest one needs, so equal sequences have equal hashes
    return functools.reduce(DataFrame.unionByName, runs), items.select("conv", F.col("h").alias("whole"))


# ------------------------------------------------------------------ recursion

def _lowest(x: Column) -> Column:
    """Number of trailing zeros of a positive long."""
    return F.length(F.bin(x.bitwiseAND(-x))) - 1


def _cut(part: DataFrame, runs: DataFrame, k: int) -> DataFrame:
    """The rows of parts of height k + 1, named at their cut."""
    at = runs.where(F.col("k") == k).select(F.col("conv").alias("of"), F.col("at").alias("d"), "h", "chars")
    cut = part.join(at, (part.conv == at.of) & (part.a + (1 << k) == at.d))
    name = F.unhex(F.sha2(F.concat("r", "h"), 256))
    left = F.col("stop") - F.col("d")
    # what is left below the cut is cut next at its highest bit; a row that stands for a name goes to its part's end
    then = F.when(F.col("y").isNotNull(), F.lit(k - 1)).when(left > 0, F.length(F.bin(left)) - 1).otherwise(-1)
    return cut.select("conv", "stop", "a", "r", "w", "y", "d", name.alias("p"), "chars", then.cast("int").alias("then"))


def named(seqs: DataFrame, runs: DataFrame, height: int) -> list[DataFrame]:
    """For each level k, the named rows of all parts of that height; ``seqs``: conv, n, w."""
    nothing = F.lit(None).cast("binary")
    start = seqs.where("n > 0").select("conv", F.col("n").alias("stop"), F.lit(0).cast("long").alias("a"), F.lit(ROOT).alias("r"),
                                       "w", nothing.alias("y"), (F.length(F.bin("n")) - 1).alias("then"))
    levels: list[DataFrame | None] = [None] * height
    columns = ["conv", "stop", "a", "r", "w", "y"]
    for k in range(height - 1, -1, -1):
        parts = [start.where(F.col("then") == k).select(*columns)]
        for j in range(k + 1, height):      # lower forests
            low = levels[j].where(F.col("then") == k)
            parts.append(low.select("conv", "stop", F.col("d").alias("a"), F.col("p").alias("r"), "w", "y"))
        if k + 1 < height:                  # upper tries: one row for each name
            top = levels[k + 1].groupBy("a", "r", "d", "p").agg(F.min("conv").alias("conv"), F.sum("w").alias("w"))
            parts.append(top.select("conv", F.col("d").alias("stop"), "a", "r", "w", F.col("p").alias("y")))
        levels[k] = written(_cut(functools.reduce(DataFrame.unionByName, parts), runs, k), f"level{k}")
    return levels


def _nodes(levels: list[DataFrame]) -> DataFrame:
    """p (name), d (depth), k (level), r (root of its part), up (parent), v (smallest member), w (members), kids, leaf, own."""
    rows = functools.reduce(DataFrame.unionByName, [x.select("conv", "r", "w", "d", "p", "chars") for x in levels])
    nodes = rows.groupBy("p", "r", "d").agg(F.min("conv").alias("v"), F.sum("w").alias("w"), F.max("chars").alias("chars"))
    # a node at an odd depth hangs on its part's root; one at an even depth is the end of a part of height 1
    above = levels[0].where("y is not null").select(F.col("y").alias("below"), F.col("p").alias("above"))
    nodes = nodes.join(above, nodes.p == above.below, "left")
    nodes = written(nodes.select("p", "r", "d", _lowest(F.col("d")).alias("k"), "v", "w", "chars",
                                 F.when(F.col("d") % 2 == 1, F.col("r")).otherwise(F.col("above")).alias("up")), "nodes")
    kids = written(nodes.groupBy(F.col("up").alias("of")).agg(F.count("*").alias("kids")), "kids")
    nodes = nodes.join(kids, nodes.p == kids.of, "left").withColumn("kids", F.coalesce("kids", F.lit(0)))
    return written(nodes.select("p", "r", "d", "k", "up", "v", "w", "kids", (F.col("kids") == 0).cast("long").alias("leaves"),
                                ((F.col("w") - 1) * F.col("chars")).alias("saved")).sortWithinPartitions("k"), "trie")


def _totals(nodes: DataFrame, levels: list[DataFrame]) -> tuple[list[DataFrame], DataFrame]:
    """(p, leaves, saved) summed over each node's subtree, for each level; and the root's (leaves, saved), one row."""
    def sums(df: DataFrame) -> DataFrame:
        return df.groupBy("p").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))

    def plus(left: DataFrame, right: DataFrame, *keep: str) -> DataFrame:
        right = right.withColumnRenamed("p", "q")
        return left.join(right, left.p == right.q, "left").select(
            "p", *keep, (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))

    inside: list[DataFrame] = []            # each node with what lies below it in its own part
    for k in range(len(levels)):
        own = nodes.where(F.col("k") == k).select("p", "r", "d", "leaves", "saved")
        if inside:
            lower = [x.where(F.col("to") == k).select(F.col("r").alias("p"), "leaves", "saved") for x in inside]
            own = plus(own, sums(functools.reduce(DataFrame.unionByName, lower)), "r", "d")
        root = F.col("d") - (1 << k)
        to = F.when(root == 0, TOP).otherwise(_lowest(root))
        inside.append(written(own.select("p", "r", to.cast("int").alias("to"), "leaves", "saved"), f"inside{k}"))
    whole: list[DataFrame] = [None] * len(levels)
    for k in range(len(levels) - 1, -1, -1):
        own = inside[k].select("p", "leaves", "saved")
        if whole[k + 1:]:                   # graft: the totals of the nodes at the lower end of the node's part
            done = functools.reduce(DataFrame.unionByName, whole[k + 1:]).withColumnRenamed("p", "end")
            ends = levels[k].where("y is not null").select("y", "p")
            own = plus(own, sums(ends.join(done, ends.y == done.end)))
        whole[k] = written(own, f"whole{k}")
    top = functools.reduce(DataFrame.unionByName, [x.where(F.col("to") == TOP).select("leaves", "saved") for x in inside])
    return whole, top.agg(F.coalesce(F.sum("leaves"), F.lit(1)).alias("leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"))


# ------------------------------------------------------------------ ends

def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at most IDS ids of one sequence, comma-joined; the rows come in order."""
    for b in batches:
        seq, conv = b.column(0).to_pylist(), b.column(1).to_pylist()
        cuts = [i for i in range(len(seq)) if i == 0 or seq[i] != seq[i - 1]]
        out = [(seq[i], conv[x], ",".join(map(str, conv[x:min(x + IDS, j)])))
               for i, j in zip(cuts, cuts[1:] + [len(seq)], strict=True) for x in range(i, j, IDS)]
        if out:
            s, c, t = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(s, pa.binary()), pa.array(c, pa.int64()), pa.array(t, pa.string())],
                                             names=["seq", "first", "ids"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv (the smallest) and SHA-256 of each sequence's ids, streamed over its chunks in order."""
    now, conv, sha = None, None, None
    for b in batches:
        out = []
        for s, c, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            if s != now:
                if now is not None:
                    out.append((conv, sha.hexdigest()))
                now, conv, sha = s, c, hashlib.sha256(t.encode())
            else:
                sha.update(b"," + t.encode())
        if out:
            yield _digest_batch(out)
    if now is not None:
        yield _digest_batch([(conv, sha.hexdigest())])


def _digest_batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())],
                                      names=["rep", "sha"])


def ends(members: DataFrame) -> DataFrame:
    """rep (smallest conv), sha of the members of each sequence; ``members``: seq, conv."""
    rows = members.select("seq", "conv").repartitionByRange("seq", "conv").sortWithinPartitions("seq", "conv")
    chunks = written(rows.mapInArrow(_chunks, "seq binary, first long, ids string"), "chunks")
    return chunks.repartition("seq").sortWithinPartitions("seq", "first").mapInArrow(_digests, "rep long, sha string")


# ------------------------------------------------------------------ trie

def trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of sequences ``turns`` (conv, pos, h, chars) of ``convs`` (conv, n), see the query's contract."""
    bound_batches(convs.sparkSession)
    runs, wholes = aligned(turns)
    wholes = wholes.withColumnRenamed("conv", "of")
    members = convs.join(wholes, convs.conv == wholes.of, "left")
    seq = F.unhex(F.sha2(F.concat(F.col("n").cast("string").cast("binary"), F.coalesce("whole", F.lit(b""))), 256))
    members = written(members.select("conv", "n", seq.alias("seq")), "members")
    seqs = written(members.groupBy("seq", "n").agg(F.min("conv").alias("conv"), F.count("*").alias("w")), "sequences")
    height = int(seqs.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]).bit_length()
    ended = written(ends(members), "ends")
    no_ends = hashlib.sha256(b"").hexdigest()
    if height:
        levels = named(seqs, runs, height)
        nodes = _nodes(levels)
        whole, top = _totals(nodes, levels)
        at = functools.reduce(DataFrame.unionByName, [x.where("y is null and stop = d").select("conv", F.col("p").alias("at"))
                                                      for x in levels])
        shas = written(ended.join(at, ended.rep == at.conv).select("at", "sha"), "shas")
        sums = functools.reduce(DataFrame.unionByName, whole).select(F.col("p").alias("of"), F.col("leaves").alias("n_leaves"),
                                                                      F.col("saved").alias("saved_tokens"))
        names = written(nodes.select(F.col("p").alias("name"), F.col("v").alias("up_conv")), "names")
        out = nodes.drop("leaves", "saved")
        out = out.join(sums, out.p == sums.of).join(shas, out.p == shas["at"], "left")
        out = written(out.select("up", "v", "d", "w", "kids", "n_leaves", "saved_tokens", "sha"), "summed")
        out = out.join(names, out.up == names.name, "left")
        kids, (leaves, saved) = nodes.where("d = 1").count(), top.first()
    else:
        kids, leaves, saved = 0, 1, 0
    sha = F.coalesce("sha", F.lit(no_ends)).alias("ends_sha256")
    # the root is one row of sums
    least, w, rep = seqs.agg(F.min("conv"), F.sum("w"), F.min(F.when(F.col("n") == 0, F.col("conv")))).first()
    root = convs.sparkSession.range(0 if least is None else 1).select(
        *[F.lit(x).cast("long").alias(c) for c, x in (("v", least), ("w", w), ("kids", kids), ("n_leaves", leaves),
                                                      ("saved_tokens", saved), ("of", rep))])
    root = root.join(ended, F.col("of") == F.col("rep"), "left").select(
        F.col("v").alias("conv_id"), F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.col("w").alias("n_convs"), F.col("kids").alias("n_children"), "n_leaves", "saved_tokens", sha)
    if not height:
        return root
    parent = F.when(F.col("d") == 1, F.lit(least).cast("long")).otherwise(F.col("up_conv"))
    out = out.select(F.col("v").alias("conv_id"), F.col("d").alias("depth"), parent.alias("parent_conv_id"),
                     F.col("w").alias("n_convs"), F.col("kids").alias("n_children"), "n_leaves", "saved_tokens", sha)
    return out.unionByName(root)


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations of a table (conv_id, turn, role, text)."""
    bound_batches(conversations.sparkSession)
    convs, turns = rebuilt(ordered(conversations))
    return trie(convs, turns)
