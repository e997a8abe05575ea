"""Offsets of annotation tiles that depend on the label's own identity and a seed, and on nothing else.

A keyed BLAKE2b digest of the identity seeds a 128-bit permuted congruential generator, as numpy's default generator
does it. The digest is made for each row; seeding and drawing are arithmetic over whole batches, in 32-bit words and
in pairs of 64-bit words, so that no generator is built for a row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

c = F.col
#: Fixed values of the protocol: least and most offset as shares of the tile.
LEAST, MOST = 40.0 / 910.0, 80.0 / 910.0
#: Fixed values of the seeding and of the generator.
HASH_A, TIMES_A, HASH_B, TIMES_B, MIX_LEFT, MIX_RIGHT = 0x43B0D7E5, 0x931E8875, 0x8B51F9DD, 0x58F38DED, 0xCA01F9DD, 0x4973F715
MULTIPLIER = 0x2360ED051FC65DA44385DF649FCCF645
_32, _64 = (1 << 32) - 1, (1 << 64) - 1


def _scrambled(word: np.ndarray, key: int, times: int) -> np.ndarray:
    """One step of the seeding hash, whose running key does not depend on the words."""
    word = (word ^ np.uint32(key)) * np.uint32(key * times & _32)
    return word ^ (word >> np.uint32(16))


def seeds(entropy: np.ndarray) -> np.ndarray:
    """Four words of 64 bits for each 64-bit number, as numpy's seed sequence gives them."""
    words = [(entropy & np.uint64(_32)).astype(np.uint32), (entropy >> np.uint64(32)).astype(np.uint32)]
    key, pool = HASH_A, []
    for i in range(4):
        pool.append(_scrambled(words[i] if i < 2 else np.zeros_like(words[0]), key, TIMES_A))
        key = key * TIMES_A & _32
    for source in range(4):
        for to in range(4):
            if source != to:
                mixed = np.uint32(MIX_LEFT) * pool[to] - np.uint32(MIX_RIGHT) * _scrambled(pool[source], key, TIMES_A)
                pool[to] = mixed ^ (mixed >> np.uint32(16))
                key = key * TIMES_A & _32
    key, out = HASH_B, []
    for i in range(8):
        out.append(_scrambled(pool[i % 4], key, TIMES_B).astype(np.uint64))
        key = key * TIMES_B & _32
    return np.stack([out[2 * i] | out[2 * i + 1] << np.uint64(32) for i in range(4)])


class Generator:
    """A 128-bit generator for each column of seeds; state and increment as (high, low)."""

    def __init__(self, words: np.ndarray):
        one = np.uint64(1)
        self.step = (words[2] << one | words[3] >> np.uint64(63), words[3] << one | one)
        self.state = self._moved((np.zeros_like(words[0]), np.zeros_like(words[0])))
        self.state = self._moved(self._sum(self.state, (words[0], words[1])))

    @staticmethod
    def _sum(a: tuple, b: tuple) -> tuple:
        low = a[1] + b[1]
        return a[0] + b[0] + (low < a[1]).astype(np.uint64), low

    def _moved(self, state: tuple) -> tuple:
        """state * MULTIPLIER + step, modulo 2^128, by halves of 64-bit words."""
        high, low = np.uint64(MULTIPLIER >> 64), np.uint64(MULTIPLIER & _64)
        half, mask = np.uint64(32), np.uint64(_32)
        a, b, x, y = state[1] >> half, state[1] & mask, low >> half, low & mask
        middle = a * y + (b * y >> half)
        carried = (middle & mask) + b * x
        top = a * x + (middle >> half) + (carried >> half)
        return self._sum((top + state[0] * low + state[1] * high, state[1] * low), self.step)

    def next(self) -> np.ndarray:
        self.state = self._moved(self.state)
        high, low = self.state
        turn, word = high >> np.uint64(58), high ^ low
        return word >> turn | word << (np.uint64(64) - turn & np.uint64(63))


def draws(digests: np.ndarray, least: float = LEAST, most: float = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Signed shares for either axis: two uniform doubles, then the top bits of both halves of a third word."""
    own = Generator(seeds(digests))
    size = [least + (most - least) * ((own.next() >> np.uint64(11)) * 2.0**-53) for _ in range(2)]
    bits = own.next()
    sign = [np.where(bits >> np.uint64(at) & np.uint64(1), 1.0, -1.0) for at in (31, 63)]
    return size[0] * sign[0], size[1] * sign[1]


def with_jitter(df: DataFrame, seed: int, key: str = "label_uid", fov: float = 60.0) -> DataFrame:
    """df with jitter_x and jitter_y, whole pixels by which a label's tile is moved; null where its key or its
    panorama's size (pano_width, pano_height) is. Equal keys have equal shares, whatever rows stand beside them."""
    secret = str(seed).encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            digest = b"".join(hashlib.blake2b(k.encode(), digest_size=8, key=secret).digest() for k in keys)
            x, y = draws(np.frombuffer(digest, ">u8").astype(np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x), pa.array(y)], ["_uid", "_x", "_y"])

    drawn = df.select(c(key).cast("string").alias("_uid")).where("_uid IS NOT NULL").distinct().mapInArrow(run, "_uid string, _x double, _y double")
    across, down = 2 * F.rint(fov / 360.0 * c("pano_width") / 2), 2 * F.rint(fov / 180.0 * c("pano_height") / 2)
    own = df.join(drawn, c(key).cast("string") == c("_uid"), "left")
    return own.select(*df.columns, F.rint(c("_x") * across).cast("bigint").alias("jitter_x"), F.rint(c("_y") * down).cast("bigint").alias("jitter_y"))
