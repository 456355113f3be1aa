"""SimHash near-deduplication over a segment-popcount embedding.

A 64-bit fingerprint is cut into 16 segments of 4 bits; the number of set bits
of every segment makes a point with 16 coordinates from 0 to 4. One differing
bit moves one coordinate by one, so the Manhattan distance of two points is a
lower bound of the fingerprints' bit distance.

The range join under that distance runs on the integer grid. Points at
distance 2 or less have a grid point within 1 of both (their midpoint), so
every fingerprint is entered at its own point and the at most 32 points next to
it, and partners are sought among the fingerprints of one grid point. This is
33 rows a fingerprint on both sides, in place of the 545 points within 2 on one
side. Pairs from the grid are verified by exact bit distance.

Grid points with more than ``cell_limit`` fingerprints would make pairs by the
square of their number. Their fingerprints are linked the same way one level
down, in the space of the bits themselves: a fingerprint is entered at its own
value and the 64 values one bit away, and everything at one value is linked to
the smallest one there. Fingerprints at bit distance 2 or less meet at such a
value, and what meets there is within 2: exact, with 65 rows a fingerprint and
no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import broadcast_if_small, connected_components, cut, slices

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42

SEGMENTS, WIDTH = 16, 4
#: Grid points with more fingerprints than this are linked without pairs.
CELL_LIMIT = 32

#: Shingles whose bits are counted at once: bounds memory for long texts.
_BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of a text, as a signed integer."""
    import numpy as np
    from xxhash import xxh64_intdigest

    # bytes.lower() changes A-Z only; bytes.split() cuts at the six ASCII
    # white-space characters
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n], ends[min(shingle, len(words)) - 1:])
    hashes = np.fromiter((xxh64_intdigest(line[a:b], SEED) for a, b in spans), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        bits = np.unpackbits(hashes[at:at + _BLOCK].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """(_key, _fp) for every row."""
    d = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in slices(batches):
            fp = pa.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], names=["_key", "_fp"])

    return d.mapInArrow(run, f"_key {d.schema['_key'].dataType.simpleString()}, _fp long")


def grid_points(fps: DataFrame) -> DataFrame:
    """(_cell, _fp): a fingerprint's own grid point and those next to it, each
    point packed with three bits a coordinate."""
    ones = [F.bit_count(F.shiftright("_fp", WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1))) for i in range(SEGMENTS)]
    d = fps.select("_fp", *[c.alias(f"_p{i}") for i, c in enumerate(ones)])
    point = F.lit(0).cast("long")
    for i in range(SEGMENTS):
        point = point + F.shiftleft(F.col(f"_p{i}").cast("long"), 3 * i)
    d = d.withColumn("_point", point)
    near = [F.col("_point")]
    for i in range(SEGMENTS):
        step = F.lit(1 << (3 * i)).cast("long")
        near += [F.when(F.col(f"_p{i}") < WIDTH, F.col("_point") + step),
                 F.when(F.col(f"_p{i}") > 0, F.col("_point") - step)]
    return d.select("_fp", F.explode(F.array_compact(F.array(*near))).alias("_cell"))


def links(fps: DataFrame, max_bits: int = MAX_BITS, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(a, b): links between the distinct fingerprints ``fps`` (_fp) that
    connect whatever is within ``max_bits`` (at most 2)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the midpoint grid holds for distances up to 2")
    cells = grid_points(fps)
    n = cells.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    busy = cut(cells.join(n, "_cell"))
    small = busy.where(F.col("_n") <= cell_limit).select("_cell", "_fp")
    pairs = (small.withColumnRenamed("_fp", "a").join(small.withColumnRenamed("_fp", "b"), "_cell")
             .where("a < b")
             .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
             .select("a", "b"))
    crowd = busy.where(F.col("_n") > cell_limit).select("_fp").distinct()
    if max_bits == 0:
        return pairs
    whole = (1 << 64) - 1
    bit = [_long(1 << i) for i in range(64)]
    if max_bits == 2:  # two fingerprints meet at a value one bit from both
        near = [F.col("_fp"), *(F.col("_fp").bitwiseXOR(b) for b in bit)]
        at = crowd.select("_fp", F.explode(F.array(*near)).alias("_value"))
    else:  # two fingerprints meet where the bit in which they differ is cleared
        near = [F.col("_fp").bitwiseAND(_long(whole ^ (1 << i))) for i in range(64)]
        at = crowd.select("_fp", F.posexplode(F.array(*near)).alias("_bit", "_value"))
    by = [c for c in at.columns if c != "_fp"]
    low = at.groupBy(*by).agg(F.min("_fp").alias("_low"), F.count(F.lit(1)).alias("_m")).where("_m > 1")
    stars = (at.join(low, by).where("_fp <> _low")
             .where(F.bit_count(F.col("_fp").bitwiseXOR(F.col("_low"))) <= max_bits)
             .select(F.col("_low").alias("a"), F.col("_fp").alias("b")))
    return pairs.unionByName(stars)


def _long(v: int) -> Column:
    """An unsigned 64-bit number as a long literal."""
    return F.lit(v - (1 << 64) if v >> 63 else v).cast("long")


def simhash_groups(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                   cell_limit: int = CELL_LIMIT) -> DataFrame:
    """(key, fingerprint, component) for every row: the signed 64-bit
    fingerprint and the smallest key reachable over links of ``max_bits`` or
    fewer differing bits.

    Null, empty and blank texts have fingerprint 0 and link like others. Texts
    with fewer words than ``shingle`` are one shingle. Rows with the same
    fingerprint are one class, however many: they are never paired. Repeated
    rows stay repeated, each with its class's component. Null keys are never
    the smallest unless a component has no other. An empty table gives no rows;
    other columns of ``docs`` are ignored, whatever their names."""
    fps = cut(fingerprints(docs, key, text, shingle))
    classes = cut(fps.groupBy("_fp").agg(F.min("_key").alias("_first")))
    parts = connected_components(links(classes.select("_fp"), max_bits, cell_limit))
    labelled = classes.join(parts, F.col("_fp") == F.col("node"), "left").select(
        "_fp", "_first", F.coalesce("component", "_fp").alias("_part"))
    first = labelled.groupBy("_part").agg(F.min("_first").alias("component"))
    by_class = labelled.join(first, "_part").select("_fp", "component")
    return fps.join(by_class, "_fp").select(
        F.col("_key").alias(key), F.col("_fp").alias("fingerprint"), "component")


def simhash_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """``docs`` without the rows whose component has a smaller key: one
    document of every group stays. Rows with a null key stay; rows that repeat
    the smallest key stay too."""
    g = simhash_groups(docs, key, text, **kw).where(F.col(key) != F.col("component"))
    out = broadcast_if_small(cut(g.select(F.col(key).alias("_out")).distinct()),
                             F.octet_length(F.col("_out").cast("string")) + 16)
    return docs.join(out, docs[key] == out["_out"], "left_anti")
