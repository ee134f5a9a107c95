"""Checksum test of 60-letter digests.

A digest is 4 groups of 14 letters (base 26, least significant letter first),
each a 64-bit number, then 4 letters: 18 bits of a 3-byte KangarooTwelve hash
(RFC 9861) of the 32 key bytes. Spark has no such hash, so this is the one
place with a pandas UDF: whole Arrow batches, every distinct digest of a batch
once, all arithmetic in NumPy over the batch. Rows keep their place, so the
check needs no shuffle.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The UDF travels with its code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SHAPE = r"\A[a-z]{60}\z"
_POWERS = np.array([26**i for i in range(14)], dtype=np.uint64)
_LETTERS = np.uint64(26)


def _round_constants() -> list[int]:
    """The last 12 of the 24 Keccak round constants, from their defining LFSR."""
    bits, state = [], 1
    for _ in range(24 * 7):
        bits.append(state & 1)
        state = (state << 1) ^ (0x171 if state & 0x80 else 0)
    table = [sum(bits[7 * r + j] << ((1 << j) - 1) for j in range(7)) for r in range(24)]
    return table[12:]


def _rotations() -> dict[tuple[int, int], int]:
    offsets, x, y = {(0, 0): 0}, 1, 0
    for t in range(24):
        offsets[(x, y)] = ((t + 1) * (t + 2) // 2) % 64
        x, y = y, (2 * x + 3 * y) % 5
    return offsets


_RC = [np.uint64(c) for c in _round_constants()]
_ROT = _rotations()


def _rotl(a: np.ndarray, n: int) -> np.ndarray:
    return a if n == 0 else (a << np.uint64(n)) | (a >> np.uint64(64 - n))


def _permute(lanes: dict) -> dict:
    """Keccak-p[1600, 12] on 25 columns of lanes."""
    for rc in _RC:
        c = [lanes[x, 0] ^ lanes[x, 1] ^ lanes[x, 2] ^ lanes[x, 3] ^ lanes[x, 4] for x in range(5)]
        d = [c[(x - 1) % 5] ^ _rotl(c[(x + 1) % 5], 1) for x in range(5)]
        moved = {(y, (2 * x + 3 * y) % 5): _rotl(lanes[x, y] ^ d[x], _ROT[x, y]) for x, y in lanes}
        lanes = {(x, y): b ^ (~moved[(x + 1) % 5, y] & moved[(x + 2) % 5, y]) for (x, y), b in moved.items()}
        lanes[0, 0] = lanes[0, 0] ^ rc
    return lanes


def _checksum(key: np.ndarray) -> np.ndarray:
    """18 checksum bits of (n, 4) key words: one permutation over a padded 33-byte message."""
    lanes = {(x, y): np.zeros(len(key), dtype=np.uint64) for y in range(5) for x in range(5)}
    for i in range(4):
        lanes[i, 0] = key[:, i].copy()
    # Byte 32 is the empty customisation's length 0, byte 33 the domain byte 7; byte 167 ends the block.
    lanes[4, 0] = lanes[4, 0] ^ np.uint64(7 << 8)
    lanes[0, 4] = lanes[0, 4] ^ np.uint64(0x80 << 56)
    return _permute(lanes)[0, 0] & np.uint64(0x3FFFF)


def valid_digests(digests: np.ndarray) -> np.ndarray:
    """Verdicts for an array of 60-letter lower-case texts."""
    if len(digests) == 0:
        return np.zeros(0, dtype=bool)
    letters = np.frombuffer("".join(digests).encode("ascii"), dtype=np.uint8).reshape(-1, 60)
    values = letters.astype(np.uint64) - np.uint64(ord("a"))
    groups = values[:, :56].reshape(-1, 4, 14)
    key = (groups * _POWERS).sum(axis=2, dtype=np.uint64)
    rest, ok = key.copy(), np.ones(len(values), dtype=bool)
    for i in range(14):  # a group that is 2^64 or more does not read back as itself
        ok &= (rest % _LETTERS == groups[:, :, i]).all(axis=1)
        rest //= _LETTERS
    check = _checksum(key)
    for i in range(4):
        ok &= check % _LETTERS == values[:, 56 + i]
        check = check // _LETTERS
    return ok


def digest_of(key: np.ndarray) -> list[str]:
    """Digests of (n, 4) key words, with their checksums."""
    letters = np.zeros((len(key), 60), dtype=np.uint8)
    rest, check = key.copy(), _checksum(key)
    for i in range(14):
        for group in range(4):
            letters[:, 14 * group + i] = rest[:, group] % _LETTERS
        rest //= _LETTERS
    for i in range(4):
        letters[:, 56 + i] = check % _LETTERS
        check = check // _LETTERS
    return [bytes(row + ord("a")).decode("ascii") for row in letters]


@F.pandas_udf(T.BooleanType())
def _verdict(digest: pd.Series) -> pd.Series:
    codes, distinct = pd.factorize(digest)
    verdicts = np.append(valid_digests(np.asarray(distinct, dtype=object)), False)
    return pd.Series(verdicts[codes])


def is_identity(text: Column) -> Column:
    """True if ``text`` is a lower-case 60-letter digest with a right checksum."""
    shaped = text.rlike(_SHAPE)
    return F.when(shaped, _verdict(F.when(shaped, text))).otherwise(False)
