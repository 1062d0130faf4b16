"""Vectorized Arrow kernels used inside Spark tasks.

These work on whole Arrow batches with pyarrow compute (C++), never per row.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc


def _normalized_offsets(arr: pa.ListArray) -> pa.Array:
    offs = arr.offsets
    first = offs[0].as_py()
    return pc.subtract(offs, pa.scalar(first, offs.type)) if first or offs.offset else offs


def list_starts(arr: pa.ListArray):
    """Where each list begins in the flattened values, and where the last one ends (null lists are empty)."""
    import numpy as np

    return np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(arr), 0).to_numpy(zero_copy_only=False))]).astype(np.int64)


#: Bytes of the rows that a kernel works on at once.
SLICE_BYTES = 2 << 20


def by_slices(kernel, *columns, limit: int = SLICE_BYTES) -> pa.Array:
    """``kernel(*columns)``, one value a row, over runs of rows of at most ``limit`` bytes together; a longer row stands alone."""
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    done, todo = [], [columns]
    while todo:
        part = todo.pop()
        n = len(part[0])
        if n > 1 and sum(c.nbytes for c in part) > limit:
            todo += [[c.slice(n // 2) for c in part], [c.slice(0, n // 2) for c in part]]
        else:
            done.append(kernel(*part))
    return done[0] if len(done) == 1 else pa.concat_arrays(done)


def list_values(arr) -> pa.Array:
    """Flattened child values of a (possibly sliced) list array."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    return arr.flatten()


def rebuild_list(like, values: pa.Array) -> pa.ListArray:
    """Re-wrap ``values`` with the offsets and nulls of list array ``like``."""
    if isinstance(like, pa.ChunkedArray):
        like = like.combine_chunks()
    offs = _normalized_offsets(like)
    mask = like.is_null() if like.null_count else None
    return pa.ListArray.from_arrays(offs, values, mask=mask)


def lookup_token_ids(tokens, vocab: pa.Array, first_id: int, unk_id: int) -> pa.Array:
    """Map string tokens to ids: position in ``vocab`` + ``first_id``, unknown -> ``unk_id``.

    ``tokens`` is list<string> or list<list<string>>; the nesting is kept.
    """
    if isinstance(tokens, pa.ChunkedArray):
        tokens = tokens.combine_chunks()
    if pa.types.is_list(tokens.type.value_type) or pa.types.is_large_list(tokens.type.value_type):
        inner = lookup_token_ids(tokens.flatten(), vocab, first_id, unk_id)
        return rebuild_list(tokens, inner)
    flat = tokens.flatten()
    idx = pc.index_in(flat, value_set=vocab)
    ids = pc.fill_null(pc.add(idx, pa.scalar(first_id, idx.type)), pa.scalar(unk_id, idx.type))
    return rebuild_list(tokens, ids.cast(pa.int32()))


def padded_matrix(ids: pa.ListArray, seq_len: int, pad: int = 0):
    """Ragged list<int> (each at most seq_len long) -> dense [N, seq_len] int64 matrix."""
    import numpy as np

    if isinstance(ids, pa.ChunkedArray):
        ids = ids.combine_chunks()
    n = len(ids)
    if n and not ids.null_count and pc.all(pc.equal(pc.list_value_length(ids), seq_len)).as_py():     # padded already
        return np.array(ids.flatten().fill_null(pad), dtype=np.int64).reshape(n, seq_len)
    out = np.full((n, seq_len), pad, dtype=np.int64)
    if n == 0:
        return out
    offs = np.asarray(_normalized_offsets(ids))
    lens = np.diff(offs)
    vals = np.asarray(ids.flatten().fill_null(pad), dtype=np.int64)
    keep = np.minimum(lens, seq_len)
    rows = np.repeat(np.arange(n), lens)
    pos = np.arange(len(vals)) - np.repeat(offs[:-1], lens)
    m = pos < np.repeat(keep, lens)
    out[rows[m], pos[m]] = vals[m]
    return out


def matrix_to_nested(like: pa.ListArray, mat) -> pa.ListArray:
    """[N, L] matrix whose rows belong to the outer lists of ``like`` -> list<list<int32>>."""
    import numpy as np

    n, width = mat.shape
    inner = pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)),
                                     pa.array(mat.ravel().astype(np.int32)))
    return rebuild_list(like, inner)


def rows_to_nested(like: pa.ListArray, values) -> pa.ListArray:
    """Per-inner-row values (one per element of the outer lists) -> list<value>."""
    return rebuild_list(like, pa.array(values))


def _grams(codes, offs, n: int, base: int):
    """Row and number of each n-gram of the rows ``offs`` of ``codes`` (values below ``base``)."""
    import numpy as np

    row = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    if n == 1:
        return row, codes
    size = max(len(codes) - n + 1, 0)
    inside = row[:size] == row[n - 1:]
    gram = codes[:size]
    for k in range(1, n):
        # renumbered at each step, so that the numbers stay small for any n
        gram = np.unique(gram * base + codes[k:size + k], return_inverse=True)[1]
    return row[:size][inside], gram[inside]


def gram_overlap(ref, cand, n: int):
    """(overlap, n_ref, n_cand) per row of two list<string> columns; overlap is clipped per gram."""
    import numpy as np

    sides = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (ref, cand)]
    rows = len(sides[0])
    values = pa.concat_arrays([s.flatten().cast(pa.string()) for s in sides])
    codes = values.dictionary_encode().indices.to_numpy().astype(np.int64)
    base = int(codes.max(initial=0)) + 1
    lengths = [pc.fill_null(pc.list_value_length(s), 0).to_numpy(zero_copy_only=False).astype(np.int64) for s in sides]
    # both sides as rows of one list, so that equal grams get equal numbers
    offs = np.append(0, np.cumsum(np.concatenate(lengths)))
    row, gram = _grams(codes, offs, n, base)
    width = int(gram.max(initial=0)) + 1
    counted = []
    for side in range(2):
        own = (row >= rows * side) & (row < rows * (side + 1))
        counted.append(np.unique((row[own] - rows * side) * width + gram[own], return_counts=True))
    (kr, cr), (kc, cc) = counted
    both, i, j = np.intersect1d(kr, kc, assume_unique=True, return_indices=True)
    overlap = np.bincount(both // width, np.minimum(cr[i], cc[j]), rows)
    return overlap, *(np.maximum(x - n + 1, 0) for x in lengths)
