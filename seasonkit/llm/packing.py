"""Best-fit packing of documents into sequences of several permitted lengths.

Lengths are counted in words (maximal runs of non-space characters) by Spark. A document
longer than the largest capacity is cut into full pieces and a rest, all in row order of
``piece``. Pieces are dealt by hash into packing groups of about ``GROUP_TOKENS`` words,
so a group fits one task at any corpus size and no document, source or copy is hot; each
group is packed on its own:

1. pieces in decreasing length go to the open bin with the least room that holds them
   (an integer bit set of the rooms in use finds it);
2. when none holds it, a bin is opened. For every permitted length the bin is filled in
   thought, greedily, with the pieces still to come, and the length with the least cost
   per word wins. The cost of a sequence of L words is ``overhead + L + L * L / quad``;
3. at the end every bin shrinks to the least permitted length that holds its contents.

Defined cases: a null text or one without words has length 0, ``piece`` 0 and no bin
(null ``bin_id``, ``capacity`` 0); repeated rows are packed each on its own; ties go by
doc_id, then piece; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CAPACITIES = (512, 1024, 2048, 4096)
#: Words packed together in one group, on average.
GROUP_TOKENS = 1_000_000
#: Fixed cost of a sequence, and the length at which the quadratic part equals the linear.
OVERHEAD, QUAD = 16.0, 16384.0

SCHEMA = "doc_id long, piece int, start long, length int, bin_id string, capacity int, bin_offset int, bin_used int"


def cost(length: int, overhead: float = OVERHEAD, quad: float = QUAD) -> float:
    return overhead + length + length * length / quad


def _open_size(length: int, left: list[int], mask: int, capacities: Sequence[int], price) -> int:
    """The permitted length with the least cost per word for a bin opened for ``length``.

    ``left`` counts the pieces still to come by length, ``mask`` has a bit for each
    length with any; both are only read.
    """
    best, least = 0, math.inf
    for cap in capacities:
        if cap < length:
            continue
        room, taken = cap - length, {}
        seen = mask
        while room and (fits := seen & ((1 << (room + 1)) - 1)):
            size = fits.bit_length() - 1
            n = min(left[size], room // size)
            taken[size] = n
            room -= n * size
            seen &= ~(1 << size)
        filled = cap - room
        rate = price(min(c for c in capacities if c >= filled)) / filled
        if rate < least:
            best, least = cap, rate
    return best


def best_fit(lengths: Sequence[int], capacities: Sequence[int], price=cost) -> tuple[list[int], list[int], list[int]]:
    """Bins of pieces given in decreasing length: (bin of each, offset in it, bin capacities).

    The capacities returned are the downsized ones.
    """
    capacities = sorted(capacities)
    left, mask = [0] * (capacities[-1] + 1), 0
    for n in lengths:
        left[n] += 1
        mask |= 1 << n
    rooms: dict[int, list[int]] = {}  # bins by room left
    in_use = 0  # a bit for each room with bins
    bins, offsets, used, caps = [], [], [], []
    for n in lengths:
        left[n] -= 1
        if not left[n]:
            mask &= ~(1 << n)
        fits = in_use >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                in_use &= ~(1 << room)
        else:
            b = len(used)
            caps.append(_open_size(n, left, mask, capacities, price))
            used.append(0)
            room = caps[b]
        bins.append(b)
        offsets.append(used[b])
        used[b] += n
        if room > n:
            rooms.setdefault(room - n, []).append(b)
            in_use |= 1 << (room - n)
    return bins, offsets, [min(c for c in capacities if c >= u) for u in used]


def word_pieces(docs: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, piece, start, length) of every document, cut at ``capacity`` words."""
    words = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"\S+")).cast("long")
    full = docs.select("doc_id", words.alias("_words"))
    last = F.greatest(F.lit(0).cast("long"), F.ceil(F.col("_words") / F.lit(capacity)).cast("long") - 1)
    return full.select("doc_id", "_words", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_piece")).select(
        "doc_id",
        F.col("_piece").cast("int").alias("piece"),
        (F.col("_piece") * capacity).alias("start"),
        F.least(F.lit(capacity).cast("long"), F.col("_words") - F.col("_piece") * capacity).cast("int").alias("length"),
    )


def pack_documents(
    docs: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    group_tokens: int = GROUP_TOKENS,
    overhead: float = OVERHEAD,
    quad: float = QUAD,
) -> DataFrame:
    """One row per piece with its bin: see the module's text for the method and columns."""
    capacities = sorted(set(capacities))
    if not capacities or capacities[0] < 1:
        raise ValueError("capacities must be positive")
    pieces = word_pieces(docs, capacities[-1])
    total = pieces.agg(F.sum("length")).first()[0] or 0
    groups = max(1, math.ceil(total / group_tokens))
    dealt = pieces.withColumn(
        "_group", F.pmod(F.xxhash64("doc_id", "piece", "length"), F.lit(groups)).cast("long")
    )

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets, caps = best_fit(
            pdf["length"].tolist(), capacities, lambda n: cost(n, overhead, quad)
        )
        group = int(pdf["_group"].iloc[0])
        at = pd.Series(bins, index=pdf.index)
        used = pdf["length"].groupby(at).transform("sum")
        return pdf.assign(
            bin_id=[f"{group}-{b}" for b in bins],
            capacity=[caps[b] for b in bins],
            bin_offset=offsets,
            bin_used=used,
        )[["doc_id", "piece", "start", "length", "bin_id", "capacity", "bin_offset", "bin_used"]]

    packed = dealt.filter("length > 0").groupBy("_group").applyInPandas(pack, SCHEMA)
    empty = dealt.filter("length = 0").select(
        "doc_id", "piece", "start", "length",
        F.lit(None).cast("string").alias("bin_id"), F.lit(0).alias("capacity"),
        F.lit(None).cast("int").alias("bin_offset"), F.lit(0).alias("bin_used"),
    )
    return packed.unionByName(empty)
