"""Packing documents into sequences: first-fit decreasing over a tournament tree.

A document's tokens are cut into pieces of at most ``length``; only its last piece is
shorter. Pieces fall by a keyed hash into random groups of about ``GROUP_TOKENS``
tokens, where more than ``COPIES`` are equal each by the hash of its number; in each group the pieces go, longest first, to the first sequence with room. The
sequences' free places are the leaves of a tournament tree whose inner nodes hold the larger
child, so that the first fitting leaf is found by one walk from the root. A group is one
task's work, of bounded size, and its result does not depend on where it runs.

The ids go with their piece into its sequence: a sequence is its pieces' ids in the order of
their offsets. Null and empty texts are the end token alone. Ties of piece length go by
doc_id, then start, then the CRC-32 of the ids. Rows that repeat a doc_id are packed each
for itself.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gistlet.llm.common import KEYS, bound_batches, row_slices, span_hashes, text_bytes, written

LENGTH, END = 4096, 2
GROUP_TOKENS = 1 << 22
COPIES = 1 << 10           # equal pieces that may go to a group together
MEMO_TOKENS = 1 << 20       # distinct pre-tokens a worker remembers before it starts anew
WORDS = 1 << 14             # new words handed to the library at once
TOKEN_BLOCK = 1 << 18       # pre-tokens looked up at once

PIECES = "doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, seed long"
PACKED = ("doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long")
DIGEST = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


# ------------------------------------------------------------------ tokens

_LETTER, _DIGIT, _OTHER, _SPACE, _WHOLE = 1, 2, 3, 0, 4


def _classes() -> tuple[np.ndarray, np.ndarray]:
    """Class of each one-byte character, and of each two-byte character of Latin-1 by its last byte (C2, then C3)."""
    def kind(ch: str) -> int:
        if ch in "\t\n\x0b\x0c\r \x85\xa0":
            return _SPACE
        return _LETTER if ch.isalpha() else _DIGIT if ch.isnumeric() else _OTHER

    one = np.full(256, _OTHER, np.uint8)
    one[:128] = [kind(chr(c)) for c in range(128)]
    two = np.full(512, _OTHER, np.uint8)
    for c in range(128, 256):
        two[(256 if c >= 192 else 0) + 128 + (c & 63)] = kind(chr(c))
    return one, two


class WordTokenizer:
    """Ids of a lower-casing word-level BPE tokenizer whose pre-tokens never hold white space.

    Pre-tokens of Latin-1 characters (runs of letters, single digits, runs of other signs)
    are found on whole byte arrays, and each distinct one is encoded once by the library. A
    word between spaces that holds any other character, an apostrophe or `<|` is handed to
    the library as it stands. The ids are those of encoding the whole text.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.closes = np.zeros(size, bool)
        for word, i in self.tokenizer.get_vocab().items():
            self.closes[i] = word.endswith("</w>")
        self.one, self.two = _classes()
        self.clear()

    def clear(self) -> None:
        self.slots = 1 << 21
        self.tags = np.zeros(self.slots, np.uint64)
        self.codes = np.full(self.slots, -1, np.int32)
        self.count = 0
        self.start = np.zeros(1 << 16, np.int64)
        self.length = np.zeros(1 << 16, np.int64)
        self.flat = np.zeros(1 << 18, np.uint16 if len(self.closes) <= 1 << 16 else np.int32)
        self.used = 0

    def _encode(self, words: list[bytes], whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each word the place and number of its ids, and all ids."""
        start, length = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        plain, flat = np.flatnonzero(~whole), np.zeros(0, self.flat.dtype)
        if len(plain):
            # many words to a text (and texts of bounded size): the ids of a word end with one that closes words
            texts = [b" ".join([words[i] for i in plain[a:a + WORDS].tolist()]).decode() for a in range(0, len(plain), WORDS)]
            ids = np.concatenate([np.array(e.ids, self.flat.dtype) for t in texts
                                  for e in self.tokenizer.encode_batch_fast([t], add_special_tokens=False)])
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(plain):
                flat = ids
                length[plain] = np.diff(ends, prepend=0)
                start[plain] = ends - length[plain]
            else:
                whole = np.ones(len(words), bool)
        rest = np.flatnonzero(whole)
        texts = [words[i].decode("utf-8", "replace") for i in rest.tolist()]
        lists = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []
        length[rest] = [len(x) for x in lists]
        start[rest] = len(flat) + np.cumsum(length[rest]) - length[rest]
        return start, length, np.concatenate([flat, np.array([i for x in lists for i in x], self.flat.dtype)])

    def _learn(self, h: np.ndarray, words: list[bytes], whole: np.ndarray) -> None:
        start, lengths, flat = self._encode(words, whole)
        n, total = len(words), len(flat)
        while self.count + n > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.start[self.count:self.count + n] = self.used + start
        self.length[self.count:self.count + n] = lengths
        self.flat[self.used:self.used + total] = flat
        self.used += total
        code = np.arange(self.count, self.count + n, dtype=np.int32)
        self.count += n
        slot = (h >> np.uint64(20)).astype(np.int64) & (self.slots - 1)
        while len(slot):
            free = self.codes[slot] < 0
            at, first = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.codes[at], self.tags[at] = code[won], h[won]
            left = np.ones(len(slot), bool)
            left[won] = False
            taken = left & (self.codes[slot] >= 0)
            slot, h, code = slot[taken], h[taken], code[taken]
            slot = (slot + 1) & (self.slots - 1)

    def _find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), -1, np.int32)
        at = np.arange(len(h))
        slot = (h >> np.uint64(20)).astype(np.int64) & (self.slots - 1)
        while len(at):
            code = self.codes[slot]
            hit = (self.tags[slot] == h[at]) & (code >= 0)
            out[at[hit]] = code[hit]
            go = ~hit & (code >= 0)
            at, slot = at[go], (slot[go] + 1) & (self.slots - 1)
        return out

    def _spans(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, ...]:
        """Bytes made lower-case where that is safe; starts, ends and wholeness of the pre-tokens; first of each row."""
        n = len(data)
        kind = self.one[data]
        nxt = np.append(data[1:], np.uint8(0)) if n else data
        lead = (data == 0xC2) | (data == 0xC3)
        at = np.flatnonzero(lead)
        last = data[np.minimum(at + 1, n - 1)] if n else at
        kind[at] = self.two[(data[at] & 1).astype(np.int64) * 256 + last]
        kind[at + 1] = kind[at]
        wide = np.zeros(n, bool)
        wide[at + 1] = True
        low = data.copy()
        low[(data >= 65) & (data <= 90)] += 32
        capital = at[(data[at] == 0xC3) & (last <= 0x9E) & (last != 0x97)]
        low[capital + 1] += 32
        odd = np.flatnonzero((data == 39) | (data > 0xC3) | ((data == 60) & (nxt == 124)))
        if len(odd):
            # the words between ASCII spaces that hold an odd byte stay whole and as they are
            gap = np.zeros(n + 1, bool)
            gap[:n] = (data == 32) | ((data >= 9) & (data <= 13))
            edge = np.unique(np.concatenate([np.flatnonzero(gap), offs]))
            k = np.unique(np.searchsorted(edge, odd, "right"))
            a, b = edge[k - 1], edge[k]
            a = a + gap[a]
            mark = np.zeros(n + 1, np.int64)
            np.add.at(mark, a, 1)
            np.add.at(mark, b, -1)
            inside = np.cumsum(mark)[:n] > 0
            kind[inside] = _WHOLE
            low[inside] = data[inside]
            wide &= ~inside
        edge = np.ones(n + 1, bool)
        edge[1:n] = kind[1:] != kind[:-1]
        edge[:n] |= (kind == _DIGIT) & ~wide
        edge[offs] = True
        at = np.flatnonzero(edge)
        at = at[at < n]
        ends = np.append(at[1:], n)
        keep = kind[at] != _SPACE
        starts, ends = at[keep], ends[keep]
        return low, starts, ends, kind[starts] == _WHOLE, np.searchsorted(starts, offs)

    def encode_rows(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows end to end, and the n + 1 offsets of the rows in them."""
        low, starts, ends, whole, first = self._spans(data, offs)
        text = low.tobytes()
        parts, sizes = [], np.zeros(len(starts) + 1, np.int64)
        for a in range(0, len(starts), TOKEN_BLOCK):
            b = min(a + TOKEN_BLOCK, len(starts))
            h = span_hashes(low, starts[a:b], ends[a:b]) ^ whole[a:b].astype(np.uint64)
            code = self._find(h)
            new = np.flatnonzero(code < 0)
            if len(new) and self.count + len(new) > MEMO_TOKENS:
                self.clear()
                new = np.arange(b - a)
            if len(new):
                unknown, pick = np.unique(h[new], return_index=True)
                pick = new[pick] + a
                self._learn(unknown, [text[starts[i]:ends[i]] for i in pick], whole[pick])
                code[new] = self._find(h[new])
            n = self.length[code]
            total = np.append(0, np.cumsum(n))
            place = np.arange(total[-1]) - np.repeat(total[:-1] - self.start[code], n)
            parts.append(self.flat[place])
            sizes[a + 1:b + 1] = n
        total = np.cumsum(sizes)
        return np.concatenate(parts) if parts else np.zeros(0, self.flat.dtype), total[first]


_LOADED: dict[str, WordTokenizer] = {}


def id_lists(at: np.ndarray, flat: np.ndarray) -> pa.Array:
    """The ids between each two offsets as one list."""
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32()))


def checksums(at: np.ndarray, flat: np.ndarray) -> pa.Array:
    """CRC-32 of the ids between each two offsets, four little-endian bytes each."""
    raw = flat.astype("<u4")
    return pa.array([zlib.crc32(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.int64())


def pieces(docs: DataFrame, path: str, length: int = LENGTH, end: int = END,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document with their ids and the ids' CRC-32, and a keyed random number of the piece."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _LOADED:
            _LOADED[path] = WordTokenizer(path)
        tokenizer = _LOADED[path]
        for batch in batches:
            data, offs = text_bytes(batch.column(1))
            for i, j in row_slices(offs):
                ids, first = tokenizer.encode_rows(data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                sizes = np.diff(first) + 1
                parts = -(-sizes // length)
                row = np.repeat(np.arange(len(sizes)), parts)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)) * length
                size = np.minimum(length, sizes[row] - start)
                # a document's pieces lie end to end, with the end token after its ids
                flat = np.insert(ids.astype("<i4"), first[1:], end)
                at = np.append(0, np.cumsum(size))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i).take(pa.array(row)), pa.array(start), pa.array(size),
                     id_lists(at, flat), checksums(at, flat), pa.array(sizes[row])],
                    names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    cut = rows.mapInArrow(run, PIECES.rsplit(",", 1)[0])
    # pieces go by a number of their own, so that a long document is no group of its own
    return cut.withColumn("seed", F.xxhash64(F.lit("packing"), "doc_id", "start", "ids_crc32"))


# ------------------------------------------------------------------ first-fit decreasing

class FirstFit:
    """Tournament tree over the free places of sequences 0, 1, 2, ...; it doubles when it is full."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.leaves = 1
        self.tree = [0, capacity]

    def place(self, size: int) -> tuple[int, int]:
        """(sequence, offset) of the first sequence with room for ``size``."""
        tree = self.tree
        if tree[1] < size:
            self._double()
            tree = self.tree
        node, leaves = 1, self.leaves
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        offset = self.capacity - tree[node]
        tree[node] -= size
        k = node
        while k > 1:
            k //= 2
            best = max(tree[2 * k], tree[2 * k + 1])
            if tree[k] == best:
                break
            tree[k] = best
        return node - leaves, offset

    def _double(self) -> None:
        old, self.leaves = self.tree[self.leaves:], self.leaves * 2
        level = old + [self.capacity] * len(old)
        levels = [level]
        while len(level) > 1:
            level = [max(level[i], level[i + 1]) for i in range(0, len(level), 2)]
            levels.append(level)
        self.tree = [0] + [x for lv in reversed(levels) for x in lv]


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; ``sizes`` descend."""
    tree = FirstFit(capacity)
    placed = [tree.place(s) for s in sizes.tolist()]
    out = np.array(placed, np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def pack(docs: DataFrame, path: str, length: int = LENGTH, end: int = END, group_tokens: int = GROUP_TOKENS,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    cut = pieces(docs, path, length, end, id_col, text_col).withColumn("piece", F.monotonically_increasing_id())
    cut = written(cut, "pieces")        # the pieces' numbers are read from the files, so they hold
    tokens = cut.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-tokens // group_tokens))

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        bins, offset = first_fit_decreasing(rows["length"].to_numpy(), length)
        return pd.DataFrame({"placed": rows["piece"], "sequence_id": (int(key[0]) << 24) + bins, "offset": offset})

    # equal pieces have one seed; where they are many, their own numbers deal them out over all groups
    hot = written(cut.groupBy("seed").count().where(F.col("count") > COPIES).select(F.col("seed").alias("hot")), "hot-pieces")
    hot = F.broadcast(hot) if hot.count() <= KEYS else hot
    dealt = cut.select("piece", "doc_id", "start", "length", "ids_crc32", "seed").join(hot, F.col("seed") == F.col("hot"), "left")
    seed = F.when(F.col("hot").isNull(), F.col("seed")).otherwise(F.xxhash64("seed", "piece"))
    dealt = dealt.select("piece", "doc_id", "start", "length", "ids_crc32", F.pmod(seed, F.lit(groups)).alias("grp"))
    places = dealt.groupBy("grp").applyInPandas(run, "placed long, sequence_id long, offset long")
    # the ids meet their places in a join, so that no worker holds a group's ids
    return cut.join(places, F.col("piece") == F.col("placed")).select(*[c.split()[0] for c in PACKED.split(", ")])


def digest(packed: DataFrame) -> DataFrame:
    """``packed`` with the CRC-32 of the ids that each row holds, in place of the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            at = np.append(0, np.cumsum(pc.list_value_length(ids).to_numpy(zero_copy_only=False)))
            crc = checksums(at, ids.flatten().to_numpy())
            yield pa.RecordBatch.from_arrays([crc if k == "ids_crc32" else batch.column(k) for k in names], names=names)

    names = [c.split()[0] for c in DIGEST.split(", ")]
    kept = [c for c in names if c != "ids_crc32"]
    bound_batches(packed.sparkSession)
    return packed.select(*kept, "ids").mapInArrow(run, DIGEST)
