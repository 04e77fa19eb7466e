"""MD5 of many short texts at once, for draws that are hashes of their keys."""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SINES = (np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint32)
_TURNS = np.array([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]], np.uint32)
#: Texts worked through together, so that all arrays of a step stay in the processor's cache.
STEP = 16384


def _first_words(m: list[np.ndarray | None], n: int) -> np.ndarray:
    """The first 32 bits of the digests of ``n`` blocks; ``m`` has the block's 16 numbers, None where all blocks have 0."""
    a, b, c, d = (np.full(n, x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
    f, high = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        turn = _TURNS[i // 16, i % 4]
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
            at = i
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
            at = (5 * i + 1) % 16
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            f ^= d
            at = (3 * i + 5) % 16
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
            at = 7 * i % 16
        f += a
        f += _SINES[i]
        if m[at] is not None:
            f += m[at]
        np.left_shift(f, turn, out=high)
        f >>= np.uint32(32) - turn
        f |= high
        f += b
        a, d, c, b, f = d, c, b, f, a
    return a + np.uint32(0x67452301)


def md5_heads(texts: pa.Array) -> np.ndarray:
    """For each text the first eight hexadecimal digits of its MD5 as a number."""
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros(len(texts), np.uint32)
    short = lengths <= 55  # with its end mark and length, such a text fills one block
    if not short.all():
        rest = texts.filter(pa.array(~short)).cast(pa.binary()).to_pylist()
        out[~short] = np.frombuffer(b"".join(md5(t).digest()[:4] for t in rest), "<u4")
        texts, lengths = texts.filter(pa.array(short)), lengths[short]
    if len(texts):
        # only the numbers that hold text or its end mark, and the length
        width = 4 * (int(lengths.max()) // 4 + 1)
        block = np.frombuffer(pc.ascii_rpad(texts, width, padding="\0").buffers()[2], np.uint8, width * len(texts)).reshape(-1, width).copy()
        block[np.arange(len(texts)), lengths] = 0x80
        numbers, bits, heads = block.view("<u4"), (8 * lengths).astype(np.uint32), []
        for at in range(0, len(texts), STEP):
            part = [np.ascontiguousarray(column) for column in numbers[at:at + STEP].T]
            m = [*part, *[None] * (14 - len(part)), bits[at:at + STEP], None]
            heads.append(_first_words(m, len(m[14])))
        out[short] = np.concatenate(heads)
    return out.byteswap().astype(np.int64)
