"""Cross-tokenizer alignment: corpus-wide counts of linked token pairs, by a minimal perfect hash.

Every text is encoded by a byte-level BPE (A; a space is put in front) and by a piece model (B; it puts the
space itself). Token ends in bytes align them: an A and a B token are linked where their byte ranges
overlap, and byte offsets where both end cut the tokens into groups. Two passes over the texts:

1. **Distinct pairs.** Tasks send (pair, links) once for each pair that they met; the distinct pairs are
   dealt by hash into shards, and each shard becomes a minimal perfect hash of its own: levels of bit
   arrays in which a key that collides goes on to the next level (Limasset et al. 2017), about five bits a
   pair. The shard's keys are kept in the order of the hash.
2. **Dense counts.** With the hash, counts are plain vectors. Each task sums what it sends into one vector a
   shard, vectors are added in a tree (by branch, then by shard).
3. **Look-up.** A second pass aligns the texts again and looks up every link's count; each key found is
   compared with the key kept at its place, and an unknown pair fails.

Hash, keys and counts are broadcast in rounds of at most ``ROUND`` pairs, which bounds a task's and the driver's memory
however many pairs there are (never more than the product of the vocabularies). Usually one round
holds them all; each further round aligns the texts once more and adds its links.

A text is cut at single spaces between two other characters, where neither tokenizer has a token that
goes on, and a task encodes a word once as long as it is among its last ``KNOWN`` distinct ones. A long text is handled
in slices; nothing is left out.

Defined cases: a null or empty text, and one whose tokens do not give its bytes back (a text that holds U+2581), has
no tokens: zeros and empty groups; repeated rows count each; a null id is kept; an empty table gives no rows;
other columns, whatever their names, pass through.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import written
from .words import mix

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE, PIECE_BPE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text, about, that are read, aligned and returned together.
SLICE = 1 << 20
#: Distinct words that a task remembers, about.
KNOWN = 1 << 18
#: Words of a chunk given to the tokenizers at once.
CHUNK = 500
#: Distinct pairs that a task holds before it sends them.
HOLD = 1 << 21
#: Pairs of a shard, on average, and of a broadcast round (12 bytes and five bits a pair: 55 MB).
SHARD, ROUND = 1 << 18, 1 << 22
BRANCHES = 16
SLOTS = 1 << 16
STATS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")

_CUT = re.compile(r"(?<=\S) (?=\S)")
_DOUBLE = re.compile(r"\s\s")


class Files(NamedTuple):
    """The contents of the two vocabulary files."""

    byte_bpe: bytes
    piece_bpe: bytes


class Tokenizers(NamedTuple):
    """``encode_a`` and ``encode_b``: lists of texts to lists of ids. A's texts come with their space."""

    encode_a: Callable[[list[str]], list[list[int]]]
    encode_b: Callable[[list[str]], list[list[int]]]
    bytes_a: list[bytes]
    bytes_b: list[bytes]
    sizes_a: np.ndarray
    sizes_b: np.ndarray


class Aligned(NamedTuple):
    """Tokens and links of some words. ``word`` numbers those that have tokens, in the order of the arrays."""

    word: np.ndarray
    ids_a: np.ndarray
    ids_b: np.ndarray
    of_a: np.ndarray
    of_b: np.ndarray
    link_word: np.ndarray
    pairs: np.ndarray
    group_word: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray


def read_files(folder: str = TOKENIZERS) -> Files:
    """Both files, about 3 MB, read once by the driver and sent to the tasks."""
    parts = []
    for name in (BYTE_BPE, PIECE_BPE):
        with open(f"{folder}/{name}", "rb") as f:
            parts.append(f.read())
    return Files(*parts)


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the
    others, in order, from U+0100 on."""
    same = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in same]
    return {chr(b): b for b in same} | {chr(256 + i): b for i, b in enumerate(rest)}


#: How a byte-level vocabulary cuts a text before its merges (fixed value).
BYTE_PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_encoder(data: bytes, bytes_a: list[bytes]) -> Callable[[list[str]], list[list[int]]]:
    """The encoder of a byte-level BPE file.

    Where the ids follow the order of the merges and nothing else changes a text, the merges are run by rank, which
    gives the same ids several times faster; any other file is run as it says.
    """
    spec = json.loads(data)
    letters, special = byte_of_character(), {t["id"] for t in spec.get("added_tokens") or ()}
    entry = lambda pair: bytes(letters[c] for c in "".join(pair.split(" ") if isinstance(pair, str) else pair))
    merges = [entry(m) for m in spec["model"]["merges"]]
    cutter = spec.get("pre_tokenizer") or {}
    plain = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    plain = plain and not spec.get("normalizer") and not spec["model"].get("dropout") and not spec["model"].get("ignore_merges")
    if plain and merges == [b for i, b in enumerate(bytes_a) if i >= 256 and i not in special]:
        import tiktoken

        ranks = {b: i for i, b in enumerate(bytes_a) if i not in special}
        by_rank = tiktoken.Encoding("by rank", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
        return lambda texts: [by_rank.encode_ordinary(t) for t in texts]
    return file_encoder(data)


def file_encoder(data: bytes) -> Callable[[list[str]], list[list[int]]]:
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    whole = Tokenizer.from_str(data.decode())
    whole.encode_special_tokens = True  # their strings in a text are plain text
    return lambda texts: [e.ids for e in whole.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def load(files: Files) -> Tokenizers:
    """Ready tokenizers, once a Python worker."""
    import sentencepiece

    letters = byte_of_character()
    vocabulary = json.loads(files.byte_bpe)["model"]["vocab"]
    bytes_a = [b""] * (max(vocabulary.values()) + 1)
    for entry, i in vocabulary.items():
        bytes_a[i] = bytes(letters[c] for c in entry)
    b = sentencepiece.SentencePieceProcessor(model_proto=files.piece_bpe)
    bytes_b = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        bytes_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    sizes = [np.array([len(x) for x in t], dtype=np.int64) for t in (bytes_a, bytes_b)]
    return Tokenizers(byte_encoder(files.byte_bpe, bytes_a), lambda texts: b.encode(texts, num_threads=1), bytes_a, bytes_b, *sizes)


def words_of(text: str) -> list[str]:
    """``text`` cut at single spaces between two characters that aren't white space."""
    if text and not _DOUBLE.search(text) and not text[0].isspace() and not text[-1].isspace():
        return text.split(" ")
    return _CUT.split(text)


def _encode(words: list[str], tok: Tokenizers) -> tuple[list[int], list[int], list[int]]:
    """(numbers of the words that give their bytes back, their A ids, their B ids)."""
    alone = [i for i, w in enumerate(words) if not w or w[0].isspace() or w[-1].isspace()]
    odd = set(alone)
    clean = [i for i in range(len(words)) if i not in odd]
    chunks = [clean[at : at + CHUNK] for at in range(0, len(clean), CHUNK)] + [[i] for i in alone]
    kept: list[int] = []
    ids_a: list[int] = []
    ids_b: list[int] = []

    def take(chunks: list[list[int]]) -> list[list[int]]:
        """Adds the chunks that are right, returns the others."""
        texts = [" ".join(words[i] for i in c) for c in chunks]
        wrong = []
        spaced = [" " + t for t in texts]
        for chunk, text, a, b in zip(chunks, spaced, tok.encode_a(spaced), tok.encode_b(texts), strict=True):
            want = text.encode()
            if b"".join([tok.bytes_a[i] for i in a]) == want == b"".join([tok.bytes_b[i] for i in b]):
                kept.extend(chunk)
                ids_a.extend(a)
                ids_b.extend(b)
            else:
                wrong.append(chunk)
        return wrong

    wrong = take(chunks) if chunks else []
    again = [[i] for chunk in wrong if len(chunk) > 1 for i in chunk]
    if again:
        take(again)
    return kept, ids_a, ids_b


def align_words(words: list[str], tok: Tokenizers) -> Aligned:
    """Tokens, links and groups of distinct words. No token crosses the end of a word."""
    kept, ids_a, ids_b = _encode(words, tok)
    a, b = np.array(ids_a, dtype=np.int64), np.array(ids_b, dtype=np.int64)
    end_a, end_b = np.cumsum(tok.sizes_a[a]), np.cumsum(tok.sizes_b[b])
    word_end = np.cumsum(np.array([len(words[i].encode()) + 1 for i in kept], dtype=np.int64))
    cuts = np.union1d(end_a, end_b)  # between two neighbours lies one link
    at_a, at_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
    both = (end_a[at_a] == cuts) & (end_b[at_b] == cuts)
    word = lambda ends: np.searchsorted(word_end, ends)
    pairs = a[at_a] * len(tok.bytes_b) + b[at_b]
    return Aligned(
        np.array(kept, dtype=np.int64), a, b, word(end_a), word(end_b), word(cuts), pairs,
        word(cuts[both]), at_a[both] + 1, at_b[both] + 1,
    )


def group_strings(found: Aligned) -> list[str]:
    """For each word with tokens: its groups ``a1,a2|b1``, joined by semicolons."""
    a, b = list(map(str, found.ids_a.tolist())), list(map(str, found.ids_b.tolist()))
    out: list[list[str]] = [[] for _ in range(len(found.word))]
    i = j = 0
    for w, k, m in zip(found.group_word.tolist(), found.group_a.tolist(), found.group_b.tolist(), strict=True):
        left = a[i] if k - i == 1 else ",".join(a[i:k])
        out[w].append(f"{left}|{b[j]}" if m - j == 1 else f"{left}|{','.join(b[j:m])}")
        i, j = k, m
    return [";".join(g) for g in out]


def _slices(texts: list[str | None]) -> Iterator[tuple[list[int], list[list[str]]]]:
    """(numbers of texts, their words) of about ``SLICE`` characters; long texts come in several parts."""
    owners: list[int] = []
    parts: list[list[str]] = []
    size = 0
    for i, text in enumerate(texts):
        at, text = 0, text or ""
        while at < len(text):
            cut = _CUT.search(text, at + SLICE) if len(text) - at > SLICE else None
            part = text[at : cut.start()] if cut else text[at:] if at else text
            at = cut.end() if cut else len(text)
            owners.append(i)
            parts.append(words_of(part))
            size += len(part)
            if size >= SLICE:
                yield owners, parts
                owners, parts, size = [], [], 0
    if owners:
        yield owners, parts


class Words:
    """Distinct words in the order met, with what ``learn`` makes of the new ones: columns of a value a word."""

    def __init__(self, tok: Tokenizers):
        self.tok = tok
        self.number: dict[str, int] = {}
        self.sound = np.zeros(0, dtype=bool)

    def places(self, parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(number of the word and of the part at each place, new words)."""
        known = self.number
        before = len(known)
        place = np.array([known.setdefault(w, len(known)) for p in parts for w in p], dtype=np.int64)
        fresh = list(known)[before:] if len(known) > before else []
        return place, np.repeat(np.arange(len(parts)), [len(p) for p in parts]), fresh

    def align(self, fresh: list[str]) -> Aligned:
        found = align_words(fresh, self.tok)
        sound = np.zeros(len(fresh), dtype=bool)
        sound[found.word] = True
        self.sound = np.append(self.sound, sound)
        return found


def _cut_batches(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of about ``SLICE`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    run = (np.cumsum(sizes) - sizes) // SLICE
    starts = np.flatnonzero(np.diff(run, prepend=-1))
    for lo, hi in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield batch.slice(int(lo), int(hi - lo))


def _sound(text: str, tok: Tokenizers) -> bool:
    """Whether all slices of a long text give their bytes back."""
    for _, parts in _slices([text]):
        words = list({w: None for p in parts for w in p})
        if len(align_words(words, tok).word) < len(words):
            return False
    return True


def slot_of(pairs: np.ndarray) -> np.ndarray:
    return (mix(pairs.astype(np.uint64)) >> np.uint64(48)).astype(np.int64)


def pair_links(docs: DataFrame, files: Files) -> DataFrame:
    """(slot, pair, n): links of each pair, as far as one task has seen them; written."""
    sent = docs.sparkSession.sparkContext.broadcast(files)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(sent.value)
        keys, sums = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        words, times, pairs, sizes = Words(tok), np.zeros(0, dtype=np.int64), [], []

        def add() -> None:
            """The links of the words known so far, as often as they were met."""
            nonlocal keys, sums, words, times, pairs, sizes
            if sizes:
                often = np.repeat(times, np.concatenate(sizes))
                met = np.concatenate(pairs)[often > 0]
                key, at = np.unique(np.append(keys, met), return_inverse=True)
                new = np.zeros(len(key), dtype=np.int64)
                np.add.at(new, at, np.append(sums, often[often > 0]))
                keys, sums = key, new
            words, times, pairs, sizes = Words(tok), times[:0], [], []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(slot_of(keys)), pa.array(keys), pa.array(sums)], ["slot", "pair", "n"])

        for part_of_batch in (p for b in batches for p in _cut_batches(b, 0)):
            texts = [t if len(t or "") <= SLICE or _sound(t, tok) else None for t in part_of_batch.column(0).to_pylist()]
            for owners, parts in _slices(texts):
                place, part, fresh = words.places(parts)
                if fresh:
                    found = words.align(fresh)
                    of = found.word[found.link_word]
                    sizes.append(np.bincount(of, minlength=len(fresh)))
                    pairs.append(found.pairs[np.argsort(of, kind="stable")])  # in the order of the words
                    times = np.append(times, np.zeros(len(fresh), dtype=np.int64))
                own = np.array(owners)
                bad = np.isin(own, own[part[~words.sound[place]]])  # each of these texts is one part
                times += np.bincount(place[~bad[part]], minlength=len(times))
                if len(times) > KNOWN:
                    add()
                    if len(keys) > HOLD:
                        yield out()
                        keys, sums = keys[:0], sums[:0]
        add()
        if len(keys):
            yield out()

    return written(docs.select("text").mapInArrow(count, "slot long, pair long, n long"), "token-pairs")


# --- minimal perfect hash -------------------------------------------------------------------------------------


class PerfectHash:
    """Distinct keys to 0 .. n - 1: each level's bits, and the count of bits before each 64 of them."""

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        counts = np.bitwise_count(bits).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    @staticmethod
    def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys.astype(np.uint64) ^ mix(np.uint64([level + 1]))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Keys alone at their place are settled, the others go on to the next level."""
        sizes: list[int] = []
        levels: list[np.ndarray] = []
        left = keys
        while len(left):
            size = -(-2 * len(left) // 64) * 64
            place = cls.place(left, len(sizes), size)
            single = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(np.packbits(single, bitorder="little").view(np.uint64))
            left = left[~single[place]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, dtype=np.uint64))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; of a key that is not among those built from, any index or -1."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left, start = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = self.place(keys[left], level, size) + start
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            hit = ((word >> bit) & np.uint64(1)).astype(bool)
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[hit]] = (self.before[at >> 6] + below)[hit]
            left = left[~hit]
            start += size
        return out


class Shard(NamedTuple):
    hash: PerfectHash
    keys: np.ndarray
    counts: np.ndarray | None = None


def _shard_of(slots: np.ndarray, shards: int) -> np.ndarray:
    return slots * shards // SLOTS


def perfect_hash(links: DataFrame) -> tuple[DataFrame, int]:
    """((shard, n, sizes, bits, keys) of the distinct pairs, number of shards); written."""
    distinct = written(links.select("slot", "pair").distinct(), "token-keys")
    shards = max(1, min(SLOTS, -(-distinct.count() // SHARD)))

    def build(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        """About ``SHARD`` keys, dealt by hash."""
        keys = np.sort(part["pair"].to_numpy(dtype=np.int64))
        made = PerfectHash.build(keys)
        ordered = np.empty_like(keys)
        ordered[made(keys)] = keys
        return pd.DataFrame({"shard": [key[0]], "n": [len(keys)], "sizes": [made.sizes], "bits": [made.bits.tobytes()], "keys": [ordered.tobytes()]})

    shard = F.floor(F.col("slot") * shards / SLOTS).cast("int").alias("shard")
    made = distinct.select(shard, "pair").groupBy("shard").applyInPandas(build, "shard int, n long, sizes array<long>, bits binary, keys binary")
    return written(made, "token-hash"), shards


def _loaded(rows) -> dict[int, Shard]:
    return {
        r["shard"]: Shard(
            PerfectHash(list(r["sizes"]), np.frombuffer(r["bits"], dtype=np.uint64)),
            np.frombuffer(r["keys"], dtype=np.int64) if "keys" in r else np.zeros(0, dtype=np.int64),
            np.frombuffer(r["counts"], dtype=np.int64) if "counts" in r else None,
        )
        for r in rows
    }


def dense_counts(links: DataFrame, hashes: DataFrame, shards: int, first: int, last: int) -> DataFrame:
    """(shard, counts): the summed count vector of each shard of ``first`` .. ``last`` - 1."""
    inside = F.col("shard").between(first, last - 1)
    # broadcast: the bits of at most ROUND pairs
    sent = links.sparkSession.sparkContext.broadcast(
        [(r["shard"], r["n"], list(r["sizes"]), bytes(r["bits"])) for r in hashes.filter(inside).select("shard", "n", "sizes", "bits").collect()]
    )
    def packed(vector: np.ndarray) -> bytes:
        return pa.compress(vector.tobytes(), codec="zstd", asbytes=True)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = {s: (PerfectHash(sizes, np.frombuffer(bits, dtype=np.uint64)), np.zeros(n, dtype=np.int64)) for s, n, sizes, bits in sent.value}
        seen = set()
        for batch in batches:
            shard = _shard_of(batch["slot"].to_numpy(), shards)
            for s in np.unique(shard).tolist():
                mine = batch[shard == s]
                index, sums = made[s]
                np.add.at(sums, index(mine["pair"].to_numpy()), mine["n"].to_numpy())
                seen.add(s)
        branch = TaskContext.get().partitionId() % BRANCHES
        for s in seen:
            yield pd.DataFrame({"shard": [s], "branch": [branch], "n": [len(made[s][1])], "counts": [packed(made[s][1])]})

    def add(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for part in parts:
            for n, data in zip(part["n"], part["counts"], strict=True):
                vector = np.frombuffer(pa.decompress(data, decompressed_size=int(n) * 8, codec="zstd", asbytes=True), dtype=np.int64)
                total = vector.copy() if total is None else total + vector
        yield pd.DataFrame({"shard": [key[0]], "branch": [-1], "n": [len(total)], "counts": [packed(total)]})

    schema = "shard int, branch int, n long, counts binary"
    place = F.floor(F.col("slot") * shards / SLOTS).cast("int")
    made = links.filter(place.between(first, last - 1)).mapInPandas(vectors, schema)
    made = made.groupBy("shard", "branch").applyInPandas(add, schema).groupBy("shard").applyInPandas(add, schema)

    def plain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            data = [pa.decompress(c, decompressed_size=int(n) * 8, codec="zstd", asbytes=True) for n, c in zip(b["n"], b["counts"], strict=True)]
            yield pd.DataFrame({"shard": b["shard"], "counts": data})

    return made.mapInPandas(plain, "shard int, counts binary")


class Counts(NamedTuple):
    """The pairs' counts: (shard, n, sizes, bits, keys, counts) by ``shards``, and each B id's highest count."""

    table: DataFrame
    shards: int
    best: np.ndarray
    files: Files


def count_pairs(docs: DataFrame, files: Files) -> Counts:
    """First pass: the corpus-wide count of each linked pair of tokens of ``docs.text``."""
    links = pair_links(docs, files)
    hashes, shards = perfect_hash(links)
    step = max(1, ROUND // SHARD)
    parts = [dense_counts(links, hashes, shards, at, min(at + step, shards)) for at in range(0, shards, step)]
    summed = parts[0]
    for p in parts[1:]:
        summed = summed.unionByName(p)
    table = written(hashes.join(summed, "shard"), "token-counts")
    n_b = len(load(files).bytes_b)
    best = np.zeros(n_b, dtype=np.int64)
    for r in pair_table(table, n_b).groupBy("b").agg(F.max("n").alias("n")).collect():  # at most the B vocabulary
        best[r["b"]] = r["n"]
    return Counts(table, shards, best, files)


def pair_table(table: DataFrame, n_b: int) -> DataFrame:
    """(a, b, n): a row for each linked pair of ids."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for keys, counts in zip(batch["keys"], batch["counts"], strict=True):
                pair = np.frombuffer(keys, dtype=np.int64)
                yield pd.DataFrame({"a": pair // n_b, "b": pair % n_b, "n": np.frombuffer(counts, dtype=np.int64)})

    return table.select("keys", "counts").mapInPandas(rows, "a int, b int, n long")


# --- second pass ----------------------------------------------------------------------------------------------


def _look_up(pairs: np.ndarray, shards: dict[int, Shard], n_shards: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(count of each pair, 0 outside this round; whether it is in this round; whether it is unknown)."""
    counts, unknown = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=bool)
    of = _shard_of(slot_of(pairs), n_shards)
    for s in np.unique(of).tolist():
        if first <= s < last:
            mine = np.flatnonzero(of == s)
            shard = shards.get(s)
            if shard is None:
                unknown[mine] = True
                continue
            index = shard.hash(pairs[mine])
            right = (index >= 0) & (shard.keys[index] == pairs[mine])
            counts[mine] = np.where(right, shard.counts[index], 0)
            unknown[mine] = ~right
    return counts, (of >= first) & (of < last), unknown


def _one_round(rows: DataFrame, counts: Counts, first: int, last: int) -> DataFrame:
    """``rows`` (_row, text) with the sums of the links that this round holds, and the groups."""
    spark = rows.sparkSession
    chosen = counts.table.filter(F.col("shard").between(first, last - 1)).select("shard", "sizes", "bits", "keys", "counts")
    shared = spark.sparkContext.broadcast([r.asDict() for r in chosen.collect()])  # at most ROUND pairs
    files, best = spark.sparkContext.broadcast(counts.files), spark.sparkContext.broadcast(counts.best)
    n_shards = counts.shards
    kept = [c for c in rows.columns if c != "text" or last < n_shards]  # another round needs the text again

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, shards = load(files.value), _loaded(shared.value)
        n_b = len(tok.bytes_b)
        words, per, unknown, names = Words(tok), np.zeros((len(STATS), 0), dtype=np.int64), np.zeros(0, dtype=bool), []
        for batch in (p for b in batches for p in _cut_batches(b, b.schema.get_field_index("text"))):
            texts = batch.column("text").to_pylist()
            sums = np.zeros((len(STATS), len(texts)), dtype=np.int64)
            groups: list[list[str]] = [[] for _ in texts]
            bad: set[int] = set()
            strange: set[int] = set()
            for owners, parts in _slices(texts):
                if len(words.number) > KNOWN:
                    words, per, unknown, names = Words(tok), per[:, :0], unknown[:0], []
                place, part, fresh = words.places(parts)
                if fresh:
                    found = words.align(fresh)
                    count, inside, lost = _look_up(found.pairs, shards, n_shards, first, last)
                    high = inside & (count == best.value[found.pairs % n_b])
                    by_word = lambda of, w=None: np.bincount(of, w, minlength=len(found.word)).astype(np.int64)  # noqa: E731, B023
                    summed = np.zeros(len(found.word), dtype=np.int64)
                    np.add.at(summed, found.link_word, count)
                    new = np.zeros((len(STATS), len(fresh)), dtype=np.int64)
                    new[:, found.word] = [
                        by_word(found.of_a), by_word(found.of_b), by_word(found.group_word), by_word(found.link_word), by_word(found.link_word[high]), summed,
                    ]
                    per = np.concatenate([per, new], axis=1)
                    gone = np.zeros(len(fresh), dtype=bool)
                    gone[found.word[found.link_word[lost]]] = True
                    unknown = np.append(unknown, gone)
                    own_names = [""] * len(fresh)
                    for w, g in zip(found.word.tolist(), group_strings(found), strict=True):
                        own_names[w] = g
                    names += own_names
                own = np.array(owners)
                bad.update(own[part[~words.sound[place]]].tolist())
                strange.update(own[part[unknown[place]]].tolist())
                starts = np.cumsum([0, *[len(p) for p in parts[:-1]]])
                for k in range(len(STATS)):
                    np.add.at(sums[k], own, np.add.reduceat(per[k][place], starts))
                at = place.tolist()
                for o, start, p in zip(owners, starts.tolist(), parts, strict=True):
                    groups[o].append(";".join([names[i] for i in at[start : start + len(p)]]))
            if strange - bad:
                raise ValueError("a linked pair of tokens was not counted: did the texts change between the passes?")
            sums[:, list(bad)] = 0
            joined = ["" if i in bad else ";".join(g) for i, g in enumerate(groups)]
            columns = [batch.column(c) for c in kept] + [pa.array(s) for s in sums] + [pa.array(joined, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*kept, *STATS, "groups"])

    added = [StructField(s, LongType()) for s in STATS] + [StructField("groups", StringType())]
    return rows.mapInArrow(measure, StructType([*[rows.schema[c] for c in kept], *added]))


def align_documents(docs: DataFrame, counts: Counts, columns: Sequence[str] = ("*",)) -> DataFrame:
    """The rows of ``docs`` (or some ``columns``) in ``_row`` with n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups``."""
    step = max(1, ROUND // SHARD)
    rows = docs.select(F.struct(*columns).alias("_row"), "text")
    out = None
    for at in range(0, counts.shards, step):
        out = _one_round(rows, counts, at, min(at + step, counts.shards))
        if at:
            out = out.withColumn("n_best", F.col("n_best") + F.col("_best")).withColumn("count_sum", F.col("count_sum") + F.col("_sum"))
        if at + step < counts.shards:
            rows = written(out, "token-round").select("_row", "text", F.col("n_best").alias("_best"), F.col("count_sum").alias("_sum"))
    return out.select("_row", *STATS, "groups")


def alignment_report(docs: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """doc_id, the sums, and groups_sha256 ('' without tokens) for every row."""
    out = align_documents(docs, count_pairs(docs, read_files(folder)), ("doc_id",))
    return out.select(
        F.col("_row.doc_id").alias("doc_id"),
        *STATS,
        F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256)).alias("groups_sha256"),
    )
