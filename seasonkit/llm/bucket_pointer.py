"""Exact removal of repeated byte strings, by refining buckets of q-grams.

A byte goes when it is covered by a ``LENGTH``-byte string that also starts in a document with a
smaller id. By bucket-pointer refinement (Schürmann & Stoye 2005), cut down to what repeats need: positions are
first put into buckets by a short q-gram, buckets of one document are settled at once, and the others are
refined by the bucket pointers of other offsets, each found from the one before, until positions of one bucket agree in all
``LENGTH`` bytes. Not every position is bucketed and no whole order is kept: a round that sends every position to its bucket at a
later offset moves some 12 bytes a byte of text, several times the disk there is. Instead:

1. Buckets are made only for anchors: the positions whose 16-byte hash is the least of the 35
   in some ``LENGTH``-byte string. Equal strings have equal anchors, so no repeat is lost, and about
   one position in eighteen is one. (``_anchors``)
2. Tasks send the distinct bucket identifiers of a block of documents to shards of identifiers and
   get back a bit for each: held by more than one document or not. (``_shared_bits``)
3. An anchor of a shared bucket goes to its shard with the 34 bytes on each side, once for each
   distinct such context of a block and with the block's least document holding it. Contexts
   equal as a whole settle all strings through the anchor together; the others are refined: the bucket pointer of each side of
   the anchor, one byte farther a step, refines that of the step before; the pair of the two sides' pointers is
   the bucket of a string, and each bucket has its least document. (``_refine``)
4. Every block gets, for each context it sent, a bit for each of the 35 strings through it: starts in a
   smaller document or not, and marks the bytes. (``_marked``)

The texts are written once, as blocks bucketed by block number, and never shuffled again; what
moves is packed identifiers, contexts of shared buckets, and bits. Shards grow in number with
the text, so a task's share stays the same at any size. Block work is NumPy inside tasks.

Identifiers are 64-bit hashes, of which 40 bits and the shard's number are compared in step 2 (a false
hit there only costs work). Contexts of one block count as equal when their 64-bit hashes are; strings of unlike
contexts are compared byte by byte through their pointers.

Defined cases: a null text has no bytes; texts under 50 bytes lose nothing; rows with one id are one
document for the rule (none removes from another) but get a result each; a null id is larger than
any other; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, own_table, scratch_path
from .shingles import mix

LENGTH, Q = 50, 16
SIDE = LENGTH - Q  # bytes on each side of an anchor that a string through it can reach
OFFSETS = SIDE + 1
WIDTH = 2 * SIDE + Q
BLOCK_BYTES = 2_000_000
SHARD_BYTES = 8_000_000
#: Contexts refined together: their pointers take 280 bytes each.
TOGETHER = 20_000
#: A byte that UTF-8 text never holds: it ends every document.
END = 0xFF
NO_ID = np.iinfo(np.int64).max

_BASE = 0x9E3779B97F4A7C15
_rng = np.random.default_rng(50)
_CONTEXT = _rng.integers(1, 1 << 63, WIDTH, dtype=np.uint64) | np.uint64(1)


def _pack(x: np.ndarray) -> bytes:
    return pa.compress(x.tobytes(), codec="zstd", asbytes=True) if x.size else b""


def _unpack(data: bytes, size: int, dtype) -> np.ndarray:
    if not size:
        return np.zeros(0, dtype=dtype)
    return np.frombuffer(pa.decompress(data, size * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype=dtype)


def _written_blocks(docs: DataFrame) -> tuple[DataFrame, int]:
    """Blocks of documents, written bucketed by block, and the bytes of all texts."""

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[int, int, bytes]] = []

        def block() -> pd.DataFrame:
            joined = np.frombuffer(b"".join(t + b"\xff" for _, _, t in held), dtype=np.uint8)
            out = {"block": held[0][0], "ids": np.array([i for _, i, _ in held]), "lens": np.array([len(t) for _, _, t in held])}
            return pd.DataFrame({k: [v] for k, v in out.items()} | {"bytes": [_pack(joined)]})

        size = 0
        for pdf in parts:
            for n, i, t in zip(pdf["row"], pdf["doc_id"], pdf["text"], strict=True):
                held.append((n, i, t.encode("utf-8", "replace")))
                size += len(held[-1][2])
                if size >= BLOCK_BYTES:
                    yield block()
                    held.clear()
                    size = 0
        if held:
            yield block()

    spark = docs.sparkSession
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),  # only names the block; written once
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    blocks = rows.mapInPandas(work, "block long, ids array<long>, lens array<long>, bytes binary")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    path = scratch_path(spark, "text-blocks")
    name = f"text_blocks_{path.rsplit('-', 1)[-1]}"
    # as many as Spark allows by default; beyond that a task streams more blocks, one at a time
    buckets = max(4, min(100_000, math.ceil(total / (8 * BLOCK_BYTES))))
    blocks.write.bucketBy(buckets, "block").option("path", path).saveAsTable(own_table(spark, name))
    return spark.table(name), total


def _read(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(joined bytes, id of each document, end of each document in them)."""
    lens = np.asarray(row.lens, dtype=np.int64)
    return _unpack(row.bytes, int(lens.sum()) + len(lens), np.uint8), np.asarray(row.ids), np.cumsum(lens + 1)


def _sent(cell, name: str) -> list[tuple[int, int, bytes]]:
    """(shard, number, data) of what the shards sent to a block; nothing when its texts are short."""
    return [(x["shard"], x["n"], x[name]) for x in cell] if cell is not None else []


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over each ``width`` values in a row."""
    n, reach = len(x) - width + 1, 1
    while 2 * reach <= width:
        x = pick(x[:-reach], x[reach:])
        reach *= 2
    return pick(x[:n], x[width - reach : width - reach + n])


def _anchors(joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position, identifier) of the anchors of all strings that lie in one document."""
    none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    if len(joined) < LENGTH + 1:
        return none
    ends = np.cumsum(joined == END, dtype=np.int32)
    whole = ends[LENGTH - 1 :] == np.concatenate([[0], ends[: -LENGTH]])
    if not whole.any():
        return none
    x = joined.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    h = mix(x[:-8] * np.uint64(_BASE) ^ mix(x[8:].copy()))
    least = _sliding(h, OFFSETS, np.minimum)
    least = np.where(whole, least, np.uint64(0))
    padded = np.concatenate([np.zeros(SIDE, dtype=np.uint64), least, np.zeros(SIDE, dtype=np.uint64)])
    at = np.flatnonzero((_sliding(padded, OFFSETS, np.maximum) == h) & (h > 0))
    return at, h[at]


def _ranges(h: np.ndarray, shards: int) -> dict[int, tuple[int, int]]:
    """Begin and end of each shard's part of sorted identifiers: shards are ranges of their top bits."""
    number = h >> np.uint64(64 - shards.bit_length() + 1) if shards > 1 else np.zeros(len(h), dtype=np.uint64)
    own, first = np.unique(number, return_index=True)
    return {int(s): (int(a), int(b)) for s, a, b in zip(own, first, np.append(first[1:], len(h)), strict=True)}


def _low(h: np.ndarray, shards: int) -> np.ndarray:
    """The 40 bits below the shard's number."""
    return (h << np.uint64(shards.bit_length() - 1)) >> np.uint64(24)


def _block_buckets(row, joined, ids, ends) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor position, its bucket number, id of its document, distinct identifiers, held by two documents)."""
    at, h = _anchors(joined)
    buckets, number = np.unique(h, return_inverse=True)
    doc = ids[np.searchsorted(ends, at, side="right")] if len(at) else np.zeros(0, dtype=np.int64)
    low, high = np.full(len(buckets), NO_ID), np.full(len(buckets), np.iinfo(np.int64).min)
    np.minimum.at(low, number, doc)
    np.maximum.at(high, number, doc)
    return at, number, doc, buckets, low < high


def _shared_bits(blocks: DataFrame, shards: int) -> DataFrame:
    """(block, shard, bits): for each distinct identifier a block has in a shard, held by several documents or not."""

    def send(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for row in pdf.itertuples():
                _, _, _, buckets, several = _block_buckets(row, *_read(row))
                low = _low(buckets, shards)
                five = low.view(np.uint8).reshape(-1, 8)[:, :5] if len(low) else np.zeros((0, 5), dtype=np.uint8)
                yield pd.DataFrame([
                    (row.block, s, b - a, five[a:b].tobytes(), np.packbits(several[a:b]).tobytes())
                    for s, (a, b) in _ranges(buckets, shards).items()
                ], columns=["block", "shard", "n", "low", "several"])

    def decide(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = pdf["n"].to_numpy()
        five = np.frombuffer(b"".join(pdf["low"]), dtype=np.uint8).reshape(-1, 5)
        wide = np.zeros((len(five), 8), dtype=np.uint8)
        wide[:, :5] = five
        low = wide.view(np.uint64).ravel()
        several = np.concatenate([np.unpackbits(np.frombuffer(b, dtype=np.uint8), count=n) for b, n in zip(pdf["several"], sizes, strict=True)])
        _, number, times = np.unique(low, return_inverse=True, return_counts=True)
        shared = times > 1
        np.logical_or.at(shared, number, several.astype(bool))
        bits = np.split(shared[number], np.cumsum(sizes)[:-1])
        return pdf[["block", "shard", "n"]].assign(bits=[np.packbits(b).tobytes() for b in bits])

    sent = blocks.mapInPandas(send, "block long, shard int, n long, low binary, several binary")
    return sent.groupBy("shard").applyInPandas(decide, "block long, shard int, n long, bits binary")


def _contexts(joined: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ``WIDTH`` bytes around each anchor; what lies in another document is ``END``."""
    padded = np.concatenate([np.full(SIDE, END, dtype=np.uint8), joined, np.full(WIDTH, END, dtype=np.uint8)])
    out = padded[at[:, None] + np.arange(WIDTH)]
    left = np.maximum.accumulate(out[:, SIDE - 1 :: -1] == END, axis=1)[:, ::-1]
    right = np.maximum.accumulate(out[:, SIDE + Q :] == END, axis=1)
    out[:, :SIDE][left] = END
    out[:, SIDE + Q :][right] = END
    return out


def _block_contexts(row, shards: int):
    """The block's distinct (bucket, context) of shared buckets, in shard order.

    Returns joined bytes, ends, ids, shared anchors, their documents, number of each one's
    context, and of each distinct context: identifier, least document, bytes.
    """
    joined, ids, ends = _read(row)
    at, number, doc, buckets, _ = _block_buckets(row, joined, ids, ends)
    shared = np.zeros(len(buckets), dtype=bool)
    ranges = _ranges(buckets, shards)
    for s, n, bits in _sent(row.bits, "bits"):
        shared[slice(*ranges[s])] = np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=n)
    keep = shared[number]
    at, doc, h = at[keep], doc[keep], buckets[number[keep]]
    key = np.empty(len(at), dtype=np.uint64)
    for a in range(0, len(at), 50_000):
        around = _contexts(joined, at[a : a + 50_000])
        total = np.zeros(len(around), dtype=np.uint64)
        for j in range(WIDTH):
            total += around[:, j] * _CONTEXT[j]
        key[a : a + 50_000] = mix(total)
    order = np.lexsort((doc, key, h))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (key[order][1:] != key[order][:-1])
    first = order[new]
    context = np.empty(len(at), dtype=np.int64)
    context[order] = np.cumsum(new) - 1
    return joined, ends, ids, at, doc, context, h[first], doc[first], at[first]


def _side_pointers(bucket: np.ndarray, side: np.ndarray) -> np.ndarray:
    """(rows, SIDE + 1): the bucket of each row after 0, 1, ... ``SIDE`` bytes of ``side``, one byte farther from the anchor each.

    One sort orders the rows of every bucket by all their bytes; how far neighbours agree then tells the buckets of
    every length, each a refinement of the one before.
    """
    wide = np.zeros((len(side), -(-SIDE // 8) * 8), dtype=np.uint8)
    wide[:, :SIDE] = side
    words = wide.view(">u8").astype(np.uint64)
    order = np.lexsort((*words.T[::-1], bucket))
    differ = side[order][1:] != side[order][:-1]
    agree = np.where(differ.any(axis=1), differ.argmax(axis=1), SIDE)
    agree[bucket[order][1:] != bucket[order][:-1]] = -1
    out = np.zeros((len(side), OFFSETS), dtype=np.uint32)
    out[order[1:]] = np.cumsum(agree[:, None] < np.arange(OFFSETS)[None], axis=0, dtype=np.uint32)
    return out


def _windows_repeated(context: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each context a bit for each of its strings: also starts in a smaller document.

    Contexts start in the buckets of their anchors' q-grams. A string ``s`` bytes into its context reaches ``SIDE - s`` bytes
    to the anchor's left and ``s`` to its right, so its bucket is the pair of the pointers of these two sides.
    """
    out = np.zeros(len(context), dtype=np.uint64)
    if not len(context):
        return out
    grams = np.ascontiguousarray(context[:, SIDE : SIDE + Q]).view(np.uint64)
    order = np.lexsort(grams.T)
    bucket = np.zeros(len(context), dtype=np.int64)
    bucket[order[1:]] = np.cumsum((grams[order][1:] != grams[order][:-1]).any(axis=1))
    left = _side_pointers(bucket, context[:, :SIDE][:, ::-1])
    right = _side_pointers(bucket, context[:, SIDE + Q :])
    pad_left = (context[:, :SIDE] == END).sum(axis=1)
    pad_right = (context[:, SIDE + Q :] == END).sum(axis=1)
    for s in range(OFFSETS):
        fits = np.flatnonzero((pad_left <= s) & (s + LENGTH <= WIDTH - pad_right))
        if not len(fits):
            continue
        name = left[fits, SIDE - s].astype(np.uint64) << np.uint64(32) | right[fits, s]
        order = np.lexsort((doc[fits], name))
        new = np.ones(len(order), dtype=bool)
        new[1:] = name[order][1:] != name[order][:-1]
        least = doc[fits][order][new][np.cumsum(new) - 1]
        hit = fits[order][least < doc[fits][order]]
        out[hit] |= np.uint64(1) << np.uint64(s)
    return out


def _refine(pdf: pd.DataFrame) -> pd.DataFrame:
    """(block, shard, n, masks) of the contexts that the blocks sent to one shard."""
    sizes = pdf["n"].to_numpy()
    h = np.concatenate([_unpack(b, n, np.uint64) for b, n in zip(pdf["h"], sizes, strict=True)])
    doc = np.concatenate([_unpack(b, n, np.int64) for b, n in zip(pdf["docs"], sizes, strict=True)])
    context = np.concatenate([_unpack(b, n * WIDTH, np.uint8) for b, n in zip(pdf["contexts"], sizes, strict=True)]).reshape(-1, WIDTH)
    order = np.argsort(h, kind="stable")
    starts = np.flatnonzero(np.append(True, h[order][1:] != h[order][:-1]))
    masks = np.zeros(len(h), dtype=np.uint64)
    # whole buckets, about ``TOGETHER`` contexts at a time
    at, ends = 0, np.append(starts[1:], len(h))
    while at < len(order):
        to = ends[min(np.searchsorted(ends, at + TOGETHER), len(ends) - 1)]
        rows = order[at:to]
        masks[rows] = _windows_repeated(context[rows], doc[rows])
        at = to
    cut = np.split(masks, np.cumsum(sizes)[:-1])
    return pdf[["block", "shard", "n"]].assign(masks=[_pack(m) for m in cut])


def _marked(row, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(joined bytes, ends, ids, byte is removed) of one block."""
    joined, ends, ids, at, doc, context, h, least, _ = _block_contexts(row, shards)
    masks = np.zeros(len(h), dtype=np.uint64)
    ranges = _ranges(h, shards)
    for s, n, data in _sent(row.masks, "masks"):
        masks[slice(*ranges[s])] = _unpack(data, n, np.uint64)
    own = masks[context] if len(at) else np.zeros(0, dtype=np.uint64)
    later = doc > least[context] if len(at) else np.zeros(0, dtype=bool)
    own = np.where(later, np.uint64((1 << OFFSETS) - 1), own)  # the whole context stands in a smaller document of the block
    starts = np.zeros(len(joined) + LENGTH, dtype=np.int32)
    for s in range(OFFSETS):
        begin = at - SIDE + s
        hit = begin[(own >> np.uint64(s)) & np.uint64(1) == 1]
        starts[hit[hit >= 0]] = 1
    # strings that a whole context does not hold (it ends at its document's ends)
    outside = np.cumsum(joined == END, dtype=np.int32)
    crosses = np.ones(len(joined), dtype=bool)
    if len(joined) >= LENGTH:
        crosses[: len(joined) - LENGTH + 1] = outside[LENGTH - 1 :] != np.concatenate([[0], outside[: -LENGTH]])
    starts[: len(joined)][crosses] = 0
    total = np.cumsum(starts[: len(joined)], dtype=np.int32)
    before = np.concatenate([np.zeros(min(LENGTH, len(joined)), dtype=np.int32), total[:-LENGTH]])[: len(joined)]
    return joined, ends, ids, total > before


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed byte ranges) for every row."""
    blocks, total = _written_blocks(docs)
    shards = 1 << max(0, math.ceil(math.log2(max(1.0, total / SHARD_BYTES))))
    bits = materialize(_shared_bits(blocks, shards), "shared-bits")
    bits = bits.groupBy("block").agg(F.collect_list(F.struct("shard", "n", "bits")).alias("bits"))
    with_bits = blocks.join(bits, "block", "left")

    def send(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for row in pdf.itertuples():
                joined, _, _, _, _, _, h, least, at = _block_contexts(row, shards)
                yield pd.DataFrame([
                    (row.block, s, b - a, _pack(h[a:b]), _pack(least[a:b]), _pack(_contexts(joined, at[a:b])))
                    for s, (a, b) in _ranges(h, shards).items()
                ], columns=["block", "shard", "n", "h", "docs", "contexts"])

    def finish(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for row in pdf.itertuples():
                joined, ends, ids, gone = _marked(row, shards)
                out = []
                for i, (a, e) in enumerate(zip(np.append(0, ends[:-1]), ends - 1, strict=True)):
                    own = np.concatenate([[False], gone[a:e], [False]])
                    edges = np.flatnonzero(own[1:] != own[:-1])
                    spans = [{"start": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)]
                    kept = joined[a:e][~gone[a:e]].tobytes()
                    out.append((ids[i] if ids[i] != NO_ID else None, e - a, int(gone[a:e].sum()), len(spans), hashlib.sha256(kept).hexdigest(), spans))
                yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]).astype({"doc_id": "Int64"})

    sent = with_bits.mapInPandas(send, "block long, shard int, n long, h binary, docs binary, contexts binary")
    masks = materialize(sent.groupBy("shard").applyInPandas(_refine, "block long, shard int, n long, masks binary"), "masks")
    masks = masks.groupBy("block").agg(F.collect_list(F.struct("shard", "n", "masks")).alias("masks"))
    return with_bits.join(masks, "block", "left").mapInPandas(
        finish,
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>",
    )
