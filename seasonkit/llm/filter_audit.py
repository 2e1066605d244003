"""Filter interaction audit: what every order of five filters removes, from one pass and a Gray-code walk.

Five failure conditions are tested on every whole text (null: empty; words are maximal runs of
``[^\\x20\\x09-\\x0D]``):

* A: under ``words`` words; B: the distinct words are under ``distinct`` percent of the words;
* C: over ``capitals`` percent of the code points are ``[A-Z]``; D: holds any of ``#$%&*|``;
* E: identical to the text of any smaller doc_id.

**One pass.** A document is reduced to its mask (five bits) and two label flags; text leaves the task that
reads it only as a SHA-256. The smallest id of each text is one aggregate with map-side combine, so a text
that a third of all documents share costs one row a task. Documents meet it by (digest, id), which no
large group of copies shares, so there is no skewed join. What remains are counts of the at most 32
masks of each part (``lang``; null: empty string).

**Walk.** All filter sets are visited in Gray-code order, so each visit toggles one filter: a cell's counter
of active failures goes up or down by one, and its documents leave or join the running survivors
when the counter leaves or reaches zero. The 32 states answer every step of every order by
differences of two states; the Shapley sum weights the same differences by how many orders hold them.

Defined cases: a document without an id is compared with no other (it never fails E and makes no
other fail) and has no labels; repeated rows count each, and of one text all rows of the smallest id pass E;
an id with several label rows has quality 1 or toxic 1 if any of them does; null labels are not 1; an empty
documents table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

# Fixed values of the contract.
FILTERS = "ABCDE"
WORDS, DISTINCT, CAPITALS = 100, 80, 10
SPACES = r"[\x20\x09-\x0D]+"
JUNK = "[#$%&*|]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ("n", "good", "toxic")
STEPS = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def text_mask(text: Column) -> Column:
    """The failures of filters A to D as the bits 1, 2, 4 and 8."""
    words = F.filter(F.split(text, SPACES), lambda w: w != "")

    def bits(words: Column) -> Column:
        n = F.size(words)
        capitals = F.octet_length(text) - F.octet_length(F.translate(text, UPPER, ""))
        fails = [
            n < WORDS,
            100 * F.size(F.array_distinct(words)) < DISTINCT * n,
            100 * capitals.cast("long") > CAPITALS * F.char_length(text).cast("long"),
            F.regexp_like(text, F.lit(JUNK)),
        ]
        return sum((f.cast("int") * (1 << k) for k, f in enumerate(fails)), F.lit(0))

    # the one-element array binds the words to a variable, so that they are split once
    return F.element_at(F.transform(F.array(words), bits), 1)


def document_masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents with equal ids, texts and parts counted together."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = (
        docs.select(
            "doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text_mask(text).alias("mask")
        )
        .groupBy("doc_id", "part", "digest", "mask")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = written(rows, "audit-rows")
    first = rows.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    flag = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
    known = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(flag("quality"), flag("toxic")).filter("quality = 1 OR toxic = 1")
    named = rows.filter("doc_id IS NOT NULL").join(first, ["digest", "doc_id"], "left").join(known, "doc_id", "left")
    named = named.select(
        "part", (F.col("mask") + F.when(F.col("first"), 0).otherwise(16)).alias("mask"), "n",
        (F.col("n") * F.coalesce("quality", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )
    zero = F.lit(0).cast("long")
    unnamed = rows.filter("doc_id IS NULL").select("part", "mask", "n", zero.alias("good"), zero.alias("toxic"))
    return named.unionByName(unnamed)


def gray_walk(cells: dict[int, Sequence[int]], filters: int) -> np.ndarray:
    """For each set of filters (as bits), the sums of the cells that fail none of them.

    ``cells``: sums by mask. Consecutive sets differ in one filter, so a visit only touches the
    cells that fail the toggled filter.
    """
    failures = dict.fromkeys(cells, 0)
    survivors = np.sum([np.asarray(v, dtype=np.int64) for v in cells.values()], axis=0)
    states = np.zeros((1 << filters, len(survivors)), dtype=np.int64)
    states[0] = survivors
    active = 0
    for visit in range(1, 1 << filters):
        toggled = (visit & -visit).bit_length() - 1
        active ^= 1 << toggled
        change = 1 if active >> toggled & 1 else -1
        for mask, sums in cells.items():
            if mask >> toggled & 1:
                failures[mask] += change
                if change == 1 and failures[mask] == 1:
                    survivors = survivors - sums
                elif change == -1 and failures[mask] == 0:
                    survivors = survivors + sums
        states[active] = survivors
    return states


def order_steps(cells: dict[int, Sequence[int]]) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of every order and step."""
    k = len(FILTERS)
    states = gray_walk(cells, k)
    alone = [(states[0] - states[1 << f])[0] for f in range(k)]
    unique = [cells.get(1 << f, (0,))[0] for f in range(k)]
    shapley = [0] * k
    for active in range(1 << k):
        size = active.bit_count()
        for f in range(k):
            if not active >> f & 1:
                shapley[f] += factorial(size) * factorial(k - 1 - size) * int((states[active] - states[active | 1 << f])[0])
    rows = []
    for order in permutations(range(k)):
        name, active = "".join(FILTERS[f] for f in order), 0
        for step, f in enumerate(order, start=1):
            lost = states[active] - states[active | 1 << f]
            active |= 1 << f
            rows.append((name, step, *map(int, (states[active][0], lost[0], alone[f] - lost[0], unique[f], lost[1], lost[2], shapley[f]))))
    return rows


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step."""
    cells = document_masks(docs, labels).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in MEASURES])

    def walk(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        """At most 32 cells: the group is bounded."""
        sums = {int(r.mask): (int(r.n), int(r.good), int(r.toxic)) for r in part.itertuples()}
        names = [c.split()[0] for c in STEPS.split(", ")][1:]
        out = pd.DataFrame(order_steps(sums), columns=names)
        out.insert(0, "part", key[0])
        return out

    return cells.groupBy("part").applyInPandas(walk, STEPS)
