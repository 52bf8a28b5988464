"""Key filters beside segments: which rows of a batch a segment may hold, without reading the segment.

A segment's filter is a Bloom filter cut into slices: a key's hash names its slice and, in it, PROBES bits. A slice is a row
(segment, slices, slice, bits), so a batch meets only the slices its keys fall into. Keys that are in a segment
are always found; others with a chance of about two in a million.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a slice, as bitmap_construct_agg makes them.
SLICE_BITS = 32_768
#: Keys a slice is made for: 32 bits a key.
SLICE_KEYS = 1_024
PROBES = 10
FILTER = "segment string, slices bigint, slice bigint, bits binary"


def slices_for(rows: int) -> int:
    """Slices of a segment of so many rows: a power of two, so that few different numbers occur."""
    return 1 << max(0, (max(rows, 1) - 1).bit_length() - (SLICE_KEYS - 1).bit_length())


def _slice(h: Column, slices: Column) -> Column:
    return F.pmod(h, slices)


def _places(h: Column) -> list[Column]:
    return [F.pmod(F.xxhash64(h, F.lit(k)), F.lit(SLICE_BITS).cast("bigint")) for k in range(PROBES)]


def _probes(h: Column) -> Column:
    return F.array(*_places(h))


def build(keys: DataFrame) -> DataFrame:
    """Filter rows from (segment, slices, h): the keys of a slice meet in one exchange, and one pass over the sorted keys sets their bits."""
    placed = keys.select("segment", "slices", _slice(F.col("h"), F.col("slices")).alias("slice"), "h")
    dealt = placed.repartition("segment", "slices", "slice").sortWithinPartitions("segment", "slices", "slice")
    probed = dealt.select("segment", "slices", "slice", _probes(F.col("h")).cast("array<smallint>").alias("places"))
    return probed.mapInArrow(_set_bits(SLICE_BITS, PROBES), FILTER)


def _set_bits(width: int, probes: int):
    """Of rows sorted by slice, with the places each sets: one row a slice. Memory holds a batch and one slice for each slice in it."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        names = ["segment", "slices", "slice"]

        def rows(heads, marks):
            bits = [p.tobytes() for p in np.packbits(marks, axis=1, bitorder="little")]
            return pa.RecordBatch.from_arrays([*heads.columns, pa.array(bits, pa.binary())], [*names, "bits"])

        head, mark = None, None  # the slice that the next batch may go on with
        for batch in (b for b in batches if b.num_rows):
            keys = batch.select(names)
            segment = keys.column("segment").dictionary_encode().indices.to_numpy()
            slices, slot = keys.column("slices").to_numpy(), keys.column("slice").to_numpy()
            fresh = np.concatenate(([True], (segment[1:] != segment[:-1]) | (slices[1:] != slices[:-1]) | (slot[1:] != slot[:-1])))
            heads = keys.take(pa.array(np.flatnonzero(fresh)))
            places = batch.column("places").flatten().to_numpy().reshape(-1, probes)
            marks = np.zeros((heads.num_rows, width), bool)
            marks[(np.cumsum(fresh) - 1)[:, None], places] = True
            if head is not None:
                if head.equals(heads.slice(0, 1)):
                    marks[:1] |= mark
                else:
                    yield rows(head, mark)
            head, mark = heads.slice(heads.num_rows - 1), marks[-1:].copy()
            if heads.num_rows > 1:
                yield rows(heads.slice(0, heads.num_rows - 1), marks[:-1])
        if head is not None:
            yield rows(head, mark)

    return run


def _words(bits: Column) -> Column:
    """The bits of a slice as 64-bit numbers, so that a key's test is a look-up; made once a slice, not once a key."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(SLICE_BITS // 64 - 1)), lambda k: F.conv(F.hex(F.substring(bits, k * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
    )


def _is_set(words: Column, place: Column) -> Column:
    # eight bytes a number, the first one highest; in a byte the lowest bit first
    at = F.lit(56) - F.floor(place % 64 / 8) * 8 + place % 8
    return F.getbit(F.get(words, F.shiftright(place, 6).cast("int")), at.cast("int")) == 1


def maybe(filters: DataFrame, keys: DataFrame, sizes: list[int]) -> DataFrame:
    """(h, segment) of the distinct hashes `keys` (h) that a segment may hold; `sizes` are the slice counts that occur."""
    probed = keys.select("h", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sorted(set(sizes))])).alias("slices"))
    probed = probed.withColumn("slice", _slice(F.col("h"), F.col("slices")))
    met = filters.select("segment", "slices", "slice", _words(F.col("bits")).alias("words")).join(probed, ["slices", "slice"])
    held = reduce(lambda a, b: a & b, [_is_set(F.col("words"), place) for place in _places(F.col("h"))])
    return met.where(held).select("h", "segment")
