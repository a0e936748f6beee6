"""Keyed pseudo-random draws.

A draw is a pure function of (seed, key...): the first 32 bits of
``md5(seed|key|...)`` divided by 2^32.  It gives the same value for a row
under any partitioning, filter or re-execution (unlike ``rand()``), and the
same double in any SQL engine with md5, which makes it checkable.
"""

from __future__ import annotations

import hashlib
import math
import sys
from collections.abc import Sequence

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tasks get this module's functions with the job, so workers need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TWO_32 = 4294967296.0


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keyed_uniform(seed: str, *keys: str | Column) -> Column:
    """Uniform double in [0, 1) from seed and key columns."""
    parts = [F.lit(str(seed))] + [_as_col(k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(_TWO_32)


def keyed_uniform_sql(seed: str, key: str, word: int = 0) -> str:
    """``keyed_uniform`` of one key column as SQL text; a digest holds four draws (word 0 to 3)."""
    return f"CAST(conv(substring(md5(concat_ws('|', '{seed}', CAST({key} AS STRING))), {8 * word + 1}, 8), 16, 10) AS BIGINT) / {_TWO_32!r}D"


def keyed_range(seed: str, low: float, width: float, *keys: str | Column) -> Column:
    """Uniform double in [low, low + width)."""
    return F.lit(float(low)) + F.lit(float(width)) * keyed_uniform(seed, *keys)


def keyed_int(seed: str, n: int, *keys: str | Column) -> Column:
    """Uniform integer in 0..n-1."""
    return F.floor(keyed_uniform(seed, *keys) * F.lit(int(n))).cast("int")


def keyed_choice(seed: str, values: list | tuple, *keys: str | Column) -> Column:
    """One of ``values`` chosen uniformly by the keyed draw."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, keyed_int(seed, len(values), *keys) + F.lit(1))


def keyed_bits(seed: str, bits: int, *keys: str | Column) -> Column:
    """The leading ``bits`` (<= 32) of the draw as a long; orders like the draw."""
    parts = [F.lit(str(seed))] + [_as_col(k).cast("string") for k in keys]
    digest = F.md5(F.concat_ws("|", *parts))
    word = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.shiftright(word, 32 - int(bits))


_MD5_ADD = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_MD5_TURN = [*[7, 12, 17, 22] * 4, *[5, 9, 14, 20] * 4, *[4, 11, 16, 23] * 4, *[6, 10, 15, 21] * 4]
_MD5_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _md5_block(words: np.ndarray) -> np.ndarray:
    """The four digest words of messages of one block, from their 16 words; a column per message."""
    a, b, c, d = (np.full(words.shape[1], v, np.uint32) for v in _MD5_START)
    for i in range(64):
        if i < 16:
            f, g = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f += a
        f += np.uint32(_MD5_ADD[i])
        f += words[g]
        high = f << np.uint32(_MD5_TURN[i])
        f >>= np.uint32(32 - _MD5_TURN[i])
        f |= high
        f += b
        a, d, c, b = d, c, b, f
    return np.stack([v + np.uint32(s) for v, s in zip((a, b, c, d), _MD5_START, strict=True)])


class KeyedDigests:
    """MD5 digests of many short texts after one prefix and another; a text of more than one block goes to the library."""

    def __init__(self, texts: Sequence[bytes]):
        self.texts, self._blocks = texts, {}

    def of(self, prefix: bytes) -> np.ndarray:
        """The four draws (32 bits) of each digest of prefix and text, as ``keyed_uniform_sql`` numbers them; a column per text."""
        at = len(prefix)
        if at not in self._blocks:
            short = [len(x) + at < 56 for x in self.texts]
            held = b"".join([bytes(at) + x + b"\x80" + bytes(63 - at - len(x)) if s else bytes(64) for x, s in zip(self.texts, short, strict=True)])
            block = np.frombuffer(held, np.uint8).reshape(-1, 64).copy()
            block[:, 56:58] = np.array([8 * (at + len(x)) if s else 0 for x, s in zip(self.texts, short, strict=True)], "<u2").view(np.uint8).reshape(-1, 2)
            self._blocks[at] = block, [i for i, s in enumerate(short) if not s]
        block, long = self._blocks[at]
        block[:, :at] = np.frombuffer(prefix, np.uint8)
        digests = _md5_block(np.ascontiguousarray(block.view("<u4").T)).byteswap()
        for i in long:
            digests[:, i] = np.frombuffer(hashlib.md5(prefix + self.texts[i], usedforsecurity=False).digest(), ">u4")
        return digests
