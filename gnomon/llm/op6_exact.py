"""Exact deduplication by counting quotient filters, with verification by bytes.

Every partition builds counting quotient filters of its 64-bit text fingerprints: the leading bits
name a block, the next the quotient, the rest is the remainder, kept sorted within the quotient's
run. Blocks of all partitions merge by their sorted remainders, losslessly, since block, quotient
and remainder together are the fingerprint. Fingerprints that were counted more than once send
their rows on to be grouped by the bytes of the text; all other rows are known to be alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gnomon.llm.common import ASCII_UPPER, LOWER, durable, only, table, texts

QUOTIENT_BITS = 16
#: A block holds about so many fingerprints at most; their number sets the number of blocks.
BLOCK_ROWS = 200_000
#: A partition's filters are sent on whenever so many fingerprints are in memory.
HELD = 1_000_000


def filter_block(fingerprints: np.ndarray, counts: np.ndarray, block_bits: int) -> bytes:
    """A counting quotient filter of sorted distinct fingerprints of one block.

    An occupied bit for each quotient, a run-end bit for each slot, then remainders and counts.
    """
    low = 64 - block_bits - QUOTIENT_BITS
    quotient = (fingerprints >> np.uint64(low)) & np.uint64((1 << QUOTIENT_BITS) - 1)
    occupied = np.zeros(1 << QUOTIENT_BITS, bool)
    occupied[quotient.astype(np.int64)] = True
    run_end = np.append(quotient[1:] != quotient[:-1], True)
    remainder = fingerprints & np.uint64((1 << low) - 1)
    return b"".join((np.uint32(len(remainder)).tobytes(), np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(), remainder.astype("<u8").tobytes(), counts.astype("<u4").tobytes()))


def filter_rows(block: int, packed: bytes, block_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints and counts of a filter."""
    low, n = 64 - block_bits - QUOTIENT_BITS, int(np.frombuffer(packed, "<u4", 1)[0])
    at = 4
    occupied = np.unpackbits(np.frombuffer(packed, np.uint8, (1 << QUOTIENT_BITS) // 8, at))
    at += (1 << QUOTIENT_BITS) // 8
    run_end = np.unpackbits(np.frombuffer(packed, np.uint8, -(-n // 8), at))[:n]
    at += -(-n // 8)
    remainder = np.frombuffer(packed, "<u8", n, at)
    counts = np.frombuffer(packed, "<u4", n, at + 8 * n)
    run = np.cumsum(run_end, dtype=np.int64) - run_end
    quotient = np.flatnonzero(occupied)[run].astype(np.uint64)
    head = np.uint64(block << QUOTIENT_BITS) if block_bits else np.uint64(0)
    return ((head | quotient) << np.uint64(low)) | remainder, counts


def merged(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted filters as one: equal fingerprints add their counts."""
    both, counts = np.concatenate((left[0], right[0])), np.concatenate((left[1], right[1]))
    order = np.argsort(both, kind="stable")
    both, counts = both[order], counts[order].astype(np.int64)
    starts = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.array([], int)
    return both[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def fingerprinted(df: DataFrame, text: str = "text", doc_id: str = "doc_id", with_text: bool = False) -> DataFrame:
    """doc_id, fp (xxHash64 of the normalised bytes) and their SHA-256; with_text, the bytes too."""
    own = only(df, doc_id, text)
    kind = own.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                norm = [t.translate(LOWER) for t in texts(batch.column(1))]
                out = [batch.column(0), pa.array([xxhash.xxh64_intdigest(t) - (1 << 63) for t in norm], pa.int64()), pa.array([hashlib.sha256(t).hexdigest() for t in norm], pa.string())]
                yield pa.RecordBatch.from_arrays(out + [pa.array(norm, pa.binary())] * with_text, ["doc_id", "fp", "text_sha256"] + ["norm"] * with_text)

    return own.mapInArrow(run, f"doc_id {kind}, fp bigint, text_sha256 string" + ", norm binary" * with_text)


def repeated(keys: DataFrame) -> DataFrame:
    """Fingerprints that occur more than once in keys.fp, with their counts."""
    bits = max(0, (keys.count() // BLOCK_ROWS).bit_length())
    shift = np.uint64(1 << 63)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def blocks() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            block = (found >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(found), np.int64)
            starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            ends = np.append(starts[1:], len(found))
            return pa.RecordBatch.from_arrays([pa.array(block[starts], pa.int64()), pa.array([filter_block(found[a:b], counts[a:b], bits) for a, b in zip(starts, ends, strict=True)], pa.binary())], ["block", "packed"])

        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) + shift)
            if sum(map(len, held)) >= HELD:
                yield blocks()
                held = []
        if sum(map(len, held)):
            yield blocks()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        block = int(group["block"].iloc[0])
        total = (np.array([], np.uint64), np.array([], np.int64))
        for packed in group["packed"]:
            total = merged(total, filter_rows(block, packed, bits))
        more = total[1] > 1
        return pd.DataFrame({"fp": (total[0][more] - shift).view(np.int64), "n": total[1][more]})

    return keys.select("fp").mapInArrow(build, "block bigint, packed binary").groupBy("block").applyInPandas(merge, "fp bigint, n bigint")


def exact_groups(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per row of df: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; a null text is an empty one. Of
    equal texts the largest doc_id stays; rows repeated with that doc_id are all marked as kept.
    A null doc_id is smaller than any other. An empty table gives an empty one.
    """
    keys = durable(fingerprinted(df, text, doc_id))
    again = repeated(keys).select("fp")
    same = (
        fingerprinted(df, text, doc_id, with_text=True).join(again, "fp", "left_semi")
        .groupBy("text_sha256", "norm").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .select("text_sha256", "keep_id", "group_size")
    )
    size = F.coalesce("group_size", F.lit(1).cast("bigint"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return keys.join(same, "text_sha256", "left").select("doc_id", keep.alias("keep_id"), size.alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, size and decision for every document."""
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}') AS norm FROM documents)
WINDOW w AS (PARTITION BY norm)
"""
