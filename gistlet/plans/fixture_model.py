"""Weights of the scorer that the registered queries use and their SQL twins compute.

Small integers over powers of two, so that every product and sum of the forward pass is
exact in double precision and equal sentences get equal scores in any engine:

    E[id][d] = ((id * 31 + d * 17) mod 97 - 48) / 64
    W1[d][h] = ((d * 13 + h * 7) mod 11 - 5) / 16       b1[h] = (h mod 3 - 1) / 8
    W2[h]    = ((h * 5) mod 7 - 3) / 4                  b2 = 1 / 8
"""

from __future__ import annotations

import numpy as np

from gistlet import config as C
from gistlet.operators.scorer import ScorerWeights

DIM, HIDDEN = 8, 8


def fixture_weights(vocab_size: int, seq_len: int = C.SEQ_LEN) -> ScorerWeights:
    ids, d, h = np.arange(vocab_size)[:, None], np.arange(DIM), np.arange(HIDDEN)
    return ScorerWeights(emb=((ids * 31 + d * 17) % 97 - 48) / 64, w1=((d[:, None] * 13 + h * 7) % 11 - 5) / 16,
                         b1=(h % 3 - 1) / 8, w2=((h * 5) % 7 - 3) / 4, b2=1 / 8, seq_len=seq_len)
