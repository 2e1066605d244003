"""Personal data: fixed patterns, and information-theoretic sanitisation of what surrounds them.

Base spans (email, ip, card, phone) are the protected entities. Each value is an entity of its own;
each kind, and any kind at all, are entities too. A term (run of letters, lower case) discloses an
entity when it stands near it far more often than chance has it. With ``near`` its occurrences
within ``REACH`` words of the entity and ``total`` all its occurrences,

    bits(term, entity) = log2(((near - sqrt(near)) / total) / p),   p = (words near the entity) / all words

is the pointwise information the term gives about the entity, taken one standard error low so that
chance neighbours of rare words do not count. It is compared with the entity's own information
-log2(p), which a term that stands nowhere else would give in full. Counts cover the whole corpus.
Terms with at least ``SUPPORT`` near occurrences that give ``GENERALISE`` of it or more are
disclosing: in the documents that hold the entity all their occurrences, near it or not, become spans of
kind ``term`` and are generalised to a mark; from ``REMOVE`` on they are removed.

Matching runs in Python inside tasks, where patterns give positions in code points; counts and
joins are Spark's. Of the documents that hold an entity the words and their places are written;
entities leave their task as hashes. Terms and entities are counted in the tasks before they are
shuffled, so a hot entity costs a row per term and task; tables joined by term or entity are broadcast
up to a counted size and joined by shuffle beyond it, where adaptive execution splits what is skewed.

Defined cases: a null text is empty and has no spans; repeated rows get a result each; an
empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import boxed, replace_spans, small_side, unboxed

# Fixed values of the contract: the patterns and the order of the kinds.
KINDS = ("email", "ip", "card", "phone", "term")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a later start in one digit run fails alike
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

REACH = 5
SUPPORT = 5
#: Shares of an entity's own information.
GENERALISE, REMOVE = 0.5, 0.75
#: Entities that are no single value: any kind, and after it each kind in the order of ``KINDS``.
ANY = 0
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "term": "[TERM]"}
#: Characters looked at on each side of an entity for its neighbours.
MARGIN = 400
BROADCAST_ROWS = 1_000_000
#: Characters of the texts whose words are held at once.
SLICE = 2_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_LETTERS = r"[\x00-\x60\x7B-\x7F]+"
TERM = re.compile(r"[A-Za-z\u0080-\U0010ffff]+")
_LOWER = str.maketrans(UPPER, LOWER)

SCHEMA = (
    "doc_id long, _key long, base array<struct<start:long,order:int,end:long,kind:string>>, entities array<long>, "
    "near array<struct<term:string,entity:long,near:long>>, terms array<string>, starts array<long>"
)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping emails, found from each @ outwards in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and at >= done and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, order, end, kind) of every base span, sorted."""
    out = [(s, 0, e, "email") for s, e in _emails(text)]
    if any(c in text for c in "0123456789"):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                out.append((m.start(), 1, m.end(), "ip"))
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end(), "card"))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((m.start(), 3, m.end(), "phone"))
    return sorted(out)


def entity(value: str, kind: str) -> int:
    """The number of an entity: its kind and its value without case, blanks and punctuation (but for email and ip)."""
    value = value.translate(_LOWER) if kind in ("email", "ip") else re.sub("[^0-9]", "", value)
    return int.from_bytes(hashlib.blake2b(f"{kind}:{value}".encode(), digest_size=8).digest(), "big", signed=True)


def outside_terms(text: str, spans: list[tuple[int, int, int, str]]) -> tuple[list[str], list[int]]:
    """The terms that lie in no span, and their starts."""
    words, starts, i, reached = [], [], 0, 0
    for m in TERM.finditer(text):
        while i < len(spans) and spans[i][0] < m.end():
            reached = max(reached, spans[i][2])
            i += 1
        if reached <= m.start():
            words.append(m.group().translate(_LOWER))
            starts.append(m.start())
    return words, starts


def near_terms(text: str, spans: list[tuple[int, int, int, str]], reach: int = REACH) -> Counter:
    """How many places of a term are among the ``reach`` words on each side of an entity: (term, entity) -> places.

    Each place counts once for an entity, none inside a span. Words cut by the margin of
    ``MARGIN`` characters don't count.
    """
    places: dict[int, tuple[str, int, set[int]]] = {}
    for start, order, end, kind in spans:
        low, high = max(0, start - MARGIN), min(len(text), end + MARGIN)
        before = [m for m in TERM.finditer(text, low, start) if not (m.start() == low and low)]
        after = [m for m in TERM.finditer(text, end, high) if not (m.end() == high and high < len(text))]
        own = (ANY, ANY + 1 + order, entity(text[start:end], kind))
        for m in [*before[-reach:], *after[:reach]]:
            places.setdefault(m.start(), (m.group().translate(_LOWER), m.end(), set()))[2].update(own)
    # neighbours that lie in another entity are part of it; both lists are sorted
    out, i, reached = Counter(), 0, 0
    for start, (term, end, near) in sorted(places.items()):
        while i < len(spans) and spans[i][0] < end:
            reached = max(reached, spans[i][2])
            i += 1
        if reached <= start:
            out.update((term, e) for e in near)
    return out


def _found(texts: list[tuple]) -> pd.DataFrame:
    out = []
    for doc_id, key, text in texts:
        spans = base_spans(text)
        own = {e for s, o, t, k in spans for e in (ANY, ANY + 1 + o, entity(text[s:t], k))}
        near = near_terms(text, spans) if spans else {}
        out.append((
            doc_id, key, [{"start": s, "order": o, "end": e, "kind": k} for s, o, e, k in spans], sorted(own),
            [{"term": t, "entity": e, "near": n} for (t, e), n in near.items()], *(outside_terms(text, spans) if spans else ([], [])),
        ))
    frame = pd.DataFrame(out, columns=["doc_id", "_key", "base", "entities", "near", "terms", "starts"])
    return frame.astype({"doc_id": "Int64"})


def find_entities(docs: DataFrame) -> DataFrame:
    """doc_id, _key (hash of id and text), base spans, entities and the terms near them, for every row; of
    the rows with entities also the terms and their places."""

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            held, size = [], 0
            ids = [None if pd.isna(i) else int(i) for i in pdf["doc_id"]]
            for row in zip(ids, pdf["_key"], pdf["text"], strict=True):
                held.append(row)
                size += len(row[2])
                if size >= SLICE:
                    yield _found(held)
                    held, size = [], 0
            if held:
                yield _found(held)

    keyed = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_key"), F.coalesce("text", F.lit("")).alias("text"))
    return keyed.mapInPandas(work, SCHEMA)


def terms(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_LETTERS), "")


def disclosing_terms(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """(term, entity, near, total, bits, share) of the terms that give ``GENERALISE`` of an entity's information or more."""
    counted = materialize(
        entities.select(F.explode("near").alias("n")).groupBy("n.term", "n.entity").agg(F.sum("n.near").alias("near")), "near-terms"
    )
    around = counted.groupBy("entity").agg(F.sum("near").alias("around"), F.max("near").alias("most")).filter(F.col("most") >= SUPPORT)
    around = materialize(around.drop("most"), "near-entities")
    pairs = materialize(counted.filter(F.col("near") >= SUPPORT), "near-pairs")
    words = docs.select(terms(F.col("text")).alias("w"))
    all_words = words.agg(F.sum(F.size("w"))).first()[0] or 0
    own = pairs.select("term").distinct()
    totals = (
        words.select(F.explode("w").alias("term"))
        .join(small_side(own, own.count(), BROADCAST_ROWS), "term", "left_semi")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("total"))
    )
    base = F.col("around") / F.lit(max(all_words, 1))
    bits = F.log2(((F.col("near") - F.sqrt("near")) / F.col("total")) / base)
    return (
        pairs.join(totals, "term")
        .join(small_side(around, around.count(), BROADCAST_ROWS), "entity")
        .filter(base < 1)
        .select("term", "entity", "near", "total", bits.alias("bits"), (bits / -F.log2(base)).alias("share"))
        .filter(F.col("share") >= GENERALISE)
    )


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, _key, base (spans) and extra (disclosing terms: start, order, end, kind, share) for every row."""
    entities = materialize(find_entities(docs), "entities")
    disclosing = materialize(disclosing_terms(docs, entities), "disclosing")
    n = disclosing.count()
    own = small_side(disclosing.select("term").distinct(), n, BROADCAST_ROWS)
    placed = (
        entities.filter(F.size("entities") > 0)
        .select("doc_id", "_key", "entities", F.explode(F.arrays_zip("terms", "starts")).alias("p"))
        .select("doc_id", "_key", "entities", F.col("p.terms").alias("term"), F.col("p.starts").alias("start"))
        .join(own, "term", "left_semi")
        .join(small_side(disclosing.select("term", "entity", "share"), n, BROADCAST_ROWS), "term")
        .filter(F.array_contains("entities", F.col("entity")))
        .groupBy("doc_id", "_key", "term", "start")
        .agg(F.max("share").alias("share"))
    )
    span = F.struct(
        "start", F.lit(KINDS.index("term")).alias("order"), (F.col("start") + F.char_length("term")).alias("end"),
        F.lit("term").alias("kind"), F.col("share").alias("share"),
    )
    extra = placed.groupBy(F.col("doc_id").alias("_doc"), F.col("_key").alias("_found")).agg(F.array_sort(F.collect_set(span)).alias("extra"))
    none = F.array().cast("array<struct<start:long,order:int,end:long,kind:string,share:double>>")
    joined = entities.join(extra, (F.col("_key") == F.col("_found")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    return joined.select("doc_id", "_key", "base", F.coalesce("extra", none).alias("extra"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def personal_data_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term for every row."""
    plain = F.transform(
        "extra", lambda s: F.struct(s["start"].alias("start"), s["order"].alias("order"), s["end"].alias("end"), s["kind"].alias("kind"))
    )
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find_personal_data(docs).select(
        "doc_id",
        *[count(k) for k in KINDS[:4]],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.array_sort(F.concat("base", plain))).alias("spans"),
        F.size("extra").cast("long").alias("n_term"),
    )


def sanitise_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with entities and disclosing terms replaced by their marks or removed; other columns stay."""
    found = find_personal_data(docs).dropDuplicates(["doc_id", "_key"])
    mark = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("mark"))
    gone = lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), F.when(s["share"] >= REMOVE, F.lit("")).otherwise(F.lit("[TERM]")).alias("mark")
    )
    spans = found.select(
        F.col("doc_id").alias("_doc"), F.col("_key").alias("_found"),
        F.array_sort(F.concat(F.transform("base", mark), F.transform("extra", gone))).alias("_spans"),
    ).filter(F.size("_spans") > 0)
    key = F.xxhash64("doc_id", "text")
    joined = boxed(docs, "doc_id", "text").join(spans, (key == F.col("_found")) & F.col("doc_id").eqNullSafe(F.col("_doc")), "left")
    cleaned = F.when(F.col("_spans").isNotNull(), replace_spans(F.col("text"), F.col("_spans"))).otherwise(F.col("text"))
    return unboxed(joined, text=cleaned)
