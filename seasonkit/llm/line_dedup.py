"""Line dedup: two Bloom filters find the suspects, an exact count settles them.

A line's key is the line without white space (``[\\x20\\x09-\\x0D]``) at both ends, A-Z lower-cased. A key
of at least ``least`` code points that stands in two documents or more is a repeat; its lines stay only in
the document of the smallest id.

1. **Once and twice.** Every task sets two bits (one in each half of the filter) for each key of each of its
   documents in the once-seen filter; a bit met again goes into the twice-seen filter as well. Filters
   travel as compressed segments of ``SEGMENT`` bits: a segment's once parts are OR-ed, its twice parts are
   OR-ed with what two once parts have in common. A task holds one segment, and the lines don't move. The filter has ``BITS_A_LINE`` bits a line, whatever the input's size.
2. **Suspects.** A key with both bits in the twice-seen filter may be a repeat, any other isn't. The
   twice-seen filter is folded (halves OR-ed) to at most ``BROADCAST_BITS`` bits before it is broadcast, a
   proven bound. Folding lets more keys pass and loses none.
3. **Exact confirmation.** Only suspected lines shuffle, as (id, SHA-256 of the key). One aggregate with
   map-side combine gives each key's smallest id and whether a second document holds it, so a line that
   stands in a third of all documents costs one row a task. Keys that hold more than a ``HOT`` part of
   the suspects (at most 1 / ``HOT`` of them) are joined back by broadcast, the others by key.
4. **Dropping.** Documents without a suspect are finished where they are read; only the others' texts
   meet their list of dropped keys.

Defined cases: a null or empty text is one empty line; repeated rows of one id are one document, so both
keep what its id keeps; a document without an id comes after all others, and all such rows count as one
document; an empty table gives no rows; other columns, whatever their names, pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import unboxed, written
from .words import mix

LEAST = 10
#: Bits of a filter for each line, in both halves together: about 1.4 % of the unrepeated keys are suspected.
BITS_A_LINE = 16
#: log2 of the bits of a segment, the unit in which filters are merged (2 MB).
SEGMENT = 24
#: log2 of the bits of each half of the broadcast filter: 32 MB for both.
BROADCAST_BITS = 27
#: Keys that a task gathers before it sends their bits.
GATHER = 1 << 22
HOT = 1e-3
HALVES = (0, 0x5851F42D4C957F2D)

# Fixed value of the contract: white space. ``bytes.lower`` lower-cases A-Z and nothing else.
SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def _counts(key: bytes, least: int) -> bool:
    """Whether a UTF-8 key has ``least`` code points; none has more than four bytes."""
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def key_digests(texts: pa.Array, least: int) -> Iterator[list[bytes]]:
    """For each text: the SHA-256 of every distinct key that is long enough."""
    for text in texts.cast(pa.binary()):
        keys = {line_key(line) for line in (text.as_py() or b"").split(b"\n")}
        yield [hashlib.sha256(k).digest() for k in keys if _counts(k, least)]


def _hashes(digests: list[bytes]) -> np.ndarray:
    """The first eight bytes of each digest."""
    return np.frombuffer(b"".join(digests), dtype=np.uint64)[::4]


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The bit of each hash in each half of a filter of ``2**bits`` bits a half."""
    return [(mix(hashes ^ np.uint64(h)) & np.uint64((1 << bits) - 1)).astype(np.int64) for h in HALVES]


def _packed(places: np.ndarray, segment: int) -> bytes:
    bits = np.zeros(1 << segment, dtype=np.uint8)
    bits[places] = 1
    return pa.compress(np.packbits(bits).tobytes(), codec="zstd", asbytes=True)


def _unpacked(data: bytes, segment: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=1 << (segment - 3), codec="zstd", asbytes=True), dtype=np.uint8)


def filter_bits(lines: int) -> int:
    """log2 of the bits of each half, for so many lines."""
    return max(12, int(np.ceil(np.log2(max(1, lines) * BITS_A_LINE / 2))))


def twice_seen(docs: DataFrame, lines: int, least: int = LEAST) -> DataFrame:
    """(half, segment, bits): the twice-seen filter of ``docs`` in compressed segments, folded to the broadcast bound."""
    bits = filter_bits(lines)
    segment, folded = min(bits, SEGMENT), min(bits, BROADCAST_BITS)

    def gathered(hashes: list[np.ndarray]) -> Iterator[pd.DataFrame]:
        rows = []
        for half, places in enumerate(_places(np.concatenate(hashes), bits)):
            at, times = np.unique(places, return_counts=True)
            for s in np.unique(at >> segment):
                lo, hi = np.searchsorted(at, [s << segment, (s + 1) << segment])
                inside = at[lo:hi] - (s << segment)
                rows.append((half, int(s), _packed(inside, segment), _packed(inside[times[lo:hi] > 1], segment)))
        yield pd.DataFrame(rows, columns=["half", "segment", "once", "twice"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for digests in key_digests(batch.column(0), least):
                held.append(_hashes(digests))
                size += len(digests)
            if size >= GATHER:
                for frame in gathered(held):
                    yield pa.RecordBatch.from_pandas(frame, preserve_index=False)
                held, size = [], 0
        if size:
            for frame in gathered(held):
                yield pa.RecordBatch.from_pandas(frame, preserve_index=False)

    def merge(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        once, twice = (np.zeros(1 << (segment - 3), dtype=np.uint8) for _ in range(2))
        for part in parts:
            for o, t in zip(part["once"], part["twice"], strict=True):
                o = _unpacked(o, segment)
                twice |= _unpacked(t, segment) | (once & o)
                once |= o
        yield pd.DataFrame({"half": [key[0]], "segment": [key[1]], "bits": [pa.compress(twice.tobytes(), codec="zstd", asbytes=True)]})

    def fold(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = np.zeros(1 << (segment - 3), dtype=np.uint8)
        for part in parts:
            for b in part["bits"]:
                out |= _unpacked(b, segment)
        yield pd.DataFrame({"half": [key[0]], "segment": [key[1]], "bits": [pa.compress(out.tobytes(), codec="zstd", asbytes=True)]})

    schema = "half int, segment long, bits binary"
    parts = docs.select("text").mapInArrow(build, "half long, segment long, once binary, twice binary")
    merged = parts.groupBy("half", "segment").applyInPandas(merge, schema)
    if folded == bits:
        return merged
    keep = F.pmod("segment", F.lit(1 << (folded - segment))).alias("segment")
    return merged.select("half", keep, "bits").groupBy("half", "segment").applyInPandas(fold, schema)


def _suspects(docs: DataFrame, least: int):
    """A function from a text column to the digests of its distinct keys that have both bits in the twice-seen filter."""
    lines = docs.agg(F.sum(line_count(F.col("text")))).first()[0] or 0
    bits = filter_bits(lines)
    segment, folded = min(bits, SEGMENT), min(bits, BROADCAST_BITS)
    halves = [np.zeros(1 << (folded - 3), dtype=np.uint8) for _ in HALVES]
    width = 1 << (segment - 3)
    for r in twice_seen(docs, lines, least).toLocalIterator():  # at most 2 * 2**BROADCAST_BITS bits in all
        halves[r["half"]][r["segment"] * width : (r["segment"] + 1) * width] = _unpacked(r["bits"], segment)
    seen = docs.sparkSession.sparkContext.broadcast(halves)

    def suspected(texts: pa.Array) -> pa.Array:
        digests = list(key_digests(texts, least))
        flat = [d for ds in digests for d in ds]
        hit = np.ones(len(flat), dtype=bool)
        for half, places in zip(seen.value, _places(_hashes(flat), folded), strict=True):
            hit &= ((half[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1).astype(bool)
        rows = np.repeat(np.arange(len(digests)), [len(d) for d in digests])
        found = np.bincount(rows[hit], minlength=len(digests))
        ends = pa.array(np.append(0, np.cumsum(found)).astype(np.int32))
        return pa.ListArray.from_arrays(ends, pa.array([flat[i] for i in np.flatnonzero(hit)], pa.binary()))

    return F.arrow_udf(suspected, "array<binary>")


def repeated_keys(marks: DataFrame) -> DataFrame:
    """(digest, first, n) of the keys that two documents or more hold, from (doc_id, digest) of suspected lines."""
    return (
        marks.groupBy("digest")
        .agg(
            F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
            F.bool_or(F.col("doc_id").isNull()).alias("unnamed"), F.count(F.lit(1)).alias("n"),
        )
        .filter("first < last OR (first IS NOT NULL AND unnamed)")
        .select("digest", "first", "n")
    )


def dropped_keys(marks: DataFrame) -> DataFrame:
    """(doc_id, drops): the digests of the keys that each document loses."""
    repeated = written(repeated_keys(marks), "line-repeats")
    least = HOT * marks.count()
    hot = repeated.filter(F.col("n") > least).select("digest", F.col("first").alias("_hot"))
    cold = repeated.filter(F.col("n") <= least).select("digest", "first")
    # broadcast: at most 1 / HOT keys hold more than a HOT part of the rows
    split = marks.join(F.broadcast(hot), "digest", "left")
    settled = split.filter("_hot IS NOT NULL").select("doc_id", "digest", F.col("_hot").alias("first"))
    others = split.filter("_hot IS NULL").select("doc_id", "digest").join(cold, "digest").select("doc_id", "digest", "first")
    gone = settled.unionByName(others).filter("doc_id IS NULL OR doc_id <> first")
    return written(gone.groupBy("doc_id").agg(F.collect_set("digest").alias("drops")), "line-drops")


def line_count(text: Column) -> Column:
    plain = F.coalesce(text, F.lit(""))
    return (1 + F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit("\n"), F.lit("")))).cast("long")


def _without(texts: pa.Array, drops: pa.Array) -> pa.Array:
    """Each text without the lines whose key's digest is in its list."""
    counts, kept = [], []
    for text, gone in zip(texts.cast(pa.binary()), drops, strict=True):
        lines, gone = (text.as_py() or b"").split(b"\n"), set(gone.as_py() or ())
        stay = [x for x in lines if hashlib.sha256(line_key(x)).digest() not in gone] if gone else lines
        counts.append(len(lines) - len(stay))
        kept.append(b"\n".join(stay))
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["n_dropped", "kept"])


def dedup_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` in ``_row`` with ``_n_dropped`` and ``_kept``, the text without its dropped lines.

    ``docs`` needs ``doc_id`` and ``text``, and is read five times: lines are counted, filters built,
    suspects sent, and texts with and without suspects finished.
    """
    suspected = _suspects(docs.select("doc_id", "text"), least)
    marks = docs.select("doc_id", F.explode(suspected(F.col("text"))).alias("digest"))
    drops = dropped_keys(written(marks, "line-marks"))
    clear = F.size(suspected(F.col("text"))) == 0
    whole = docs.filter(clear).select(F.struct("*").alias("_row"))
    whole = whole.select("_row", F.lit(0).cast("long").alias("_n_dropped"), F.coalesce("_row.text", F.lit("")).alias("_kept"))
    some = docs.filter(~clear).select(F.col("doc_id").alias("_id"), F.struct("*").alias("_row"))
    without = F.arrow_udf(_without, "struct<n_dropped:long,kept:string>")
    cleaned = some.join(drops, F.col("_id").eqNullSafe(F.col("doc_id")), "left").select(
        "_row", without(F.col("_row.text"), F.col("drops")).alias("_out")
    )
    return whole.unionByName(cleaned.select("_row", F.col("_out.n_dropped").alias("_n_dropped"), F.col("_out.kept").alias("_kept")))


def line_report(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 for every row."""
    out = dedup_lines(docs.select("doc_id", "text"), least)
    return out.select(
        F.col("_row.doc_id").alias("doc_id"),
        line_count(F.col("_row.text")).alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def drop_repeated_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with the dropped lines left out of ``text``; other columns stay.

    ``n_chars``, where the table has it, follows a changed text.
    """
    out = dedup_lines(docs, least)
    changed = {"text": F.when(F.col("_n_dropped") > 0, F.col("_kept")).otherwise(F.col("_row.text"))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_n_dropped") > 0, F.char_length("_kept").cast("long")).otherwise(F.col("_row.n_chars"))
    return unboxed(out, **changed)
