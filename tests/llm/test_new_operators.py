"""Line dedup, filter audit and token alignment: odd rows, forced small limits, and plain Python."""

import hashlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from seasonkit.llm import filter_audit, line_dedup, token_pairs
from seasonkit.llm.common import table
from tests.conftest import SF_MID, SF_SMALL


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


# --- line dedup ---


def lines_kept(docs):
    """(n_lines, n_dropped, text kept) of each row of (doc_id, text), by a plain count."""
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    last = lambda i: (i is None, i or 0)
    holders = {}
    for i, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 10:
                holders.setdefault(key(x), set()).add(i)
    first = {k: min(v, key=last) for k, v in holders.items() if len(v) > 1}
    out = []
    for i, t in docs:
        x = (t or "").split("\n")
        stay = [y for y in x if first.get(key(y), i) == i]
        out.append((i, len(x), len(x) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def odd_lines():
    rng = np.random.default_rng(1)
    pool = [f"a shared line {k}" for k in range(40)] + ["", "short", "  Padded Line Here\t", "padded line here", "\x0bPADDED LINE HERE\r", "\xa0padded line here", "ÀPADDED LINE", "àpadded line"]
    texts = ["\n".join(rng.choice(pool, rng.integers(0, 9))) + "\n" * int(rng.integers(0, 2)) for _ in range(150)]
    texts += [None, "", "\n", "one line of its own\none line of its own", "hot line of all\n" + "x" * 3000]
    rows = list(enumerate(texts)) + [(3, "repeated row of id 3\na shared line 1"), (3, "repeated row of id 3\na shared line 1")]
    return rows + [(None, "a shared line 2\nonly without an id"), (None, "only without an id"), *[(1000 + i, "hot line of all") for i in range(200)]]


@pytest.mark.parametrize("small", [False, True])
def test_lines_against_plain_count(spark, monkeypatch, small):
    """With ``small``, filters of several segments, folded, sent in several parts, and no key counts as hot."""
    if small:
        monkeypatch.setattr(line_dedup, "SEGMENT", 6)
        monkeypatch.setattr(line_dedup, "BROADCAST_BITS", 8)
        monkeypatch.setattr(line_dedup, "GATHER", 50)
        monkeypatch.setattr(line_dedup, "HOT", 2.0)
    rows = odd_lines()
    docs = spark.createDataFrame([(i, t, "d", "s") for i, t in rows], "doc_id long, text string, digest string, drops string").repartition(5)
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in line_dedup.line_report(docs).collect()]
    assert sorted(got, key=str) == lines_kept(rows)


def test_cleaned_documents_keep_their_columns(odd_docs, no_docs):
    got = line_dedup.drop_repeated_lines(odd_docs)
    assert got.columns == odd_docs.columns
    rows = by_id(got)
    assert rows[1].text.startswith("one two") and rows[10].text == "" == rows[7].text and rows[3].text is None
    assert rows[10].n_chars == 0 and rows[9].text == "lone" and {r._spans + r._key for r in rows.values()} == {"xk"}
    assert line_dedup.drop_repeated_lines(no_docs).count() == line_dedup.line_report(no_docs).count() == 0


def test_unrepeated_lines_do_not_shuffle(spark):
    """Few of the keys that stand in one document only are suspected, and all repeated ones are."""
    docs = spark.createDataFrame([(i, f"line number {i} of many\nsecond line {i // 2} of many") for i in range(4000)], "doc_id long, text string")
    found = docs.select("doc_id", line_dedup._suspects(docs, 10)(docs.text).alias("s")).toPandas()
    digest = lambda i: hashlib.sha256(f"second line {i // 2} of many".encode()).digest()
    assert all(digest(i) in set(s) for i, s in zip(found.doc_id, found.s, strict=True)) and np.mean([len(s) > 1 for s in found.s]) < 0.05


# --- filter audit ---


def audit_rows(docs, labels):
    """The contract's counts by walking every order over every document."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = {}
    for i, t, lang in docs:
        t = t or ""
        w = [x for x in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).split(" ") if x]
        fails = set()
        if len(w) < 100:
            fails.add("A")
        if 100 * len(set(w)) < 80 * len(w):
            fails.add("B")
        if 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t):
            fails.add("C")
        if set(t) & set("#$%&*|"):
            fails.add("D")
        if i is not None and i > first[t]:
            fails.add("E")
        parts.setdefault(lang or "", []).append((fails, i in good, i in toxic))
    out = {}
    for part, rows in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, start=1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                shapley[f] += len(gone)
                all_fails = sum(f in r[0] for r in rows)
                counts = len(left), len(gone), all_fails - len(gone), sum(r[0] == {f} for r in rows)
                out[part, "".join(order), step] = (*counts, sum(r[1] for r in gone), sum(r[2] for r in gone), f)
        out |= {k: (*v[:6], shapley[v[6]]) for k, v in out.items() if k[0] == part}
    return out


def audited(df):
    return {
        (r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in df.collect()
    }


def test_audit_against_every_order(spark):
    rng = np.random.default_rng(2)
    docs = []
    for i in range(400):
        n = int(rng.choice([0, 20, 99, 100, 130]))
        words = [f"w{k}" if rng.random() < 0.8 else "same" for k in range(n)]
        text = "\t".join(words) + " \n" + "A" * int(rng.integers(0, 60)) + str(rng.choice(["", "#", "|", "é\xa0É"]))
        docs.append((i, text, str(rng.choice(["en", "de"]))))
    docs += [(500 + k, docs[k % 3][1], "fr" if k % 2 else None) for k in range(60)]
    docs += [(3, docs[3][1], "en"), (3, docs[3][1], "en"), (3, "another text", "en"), (None, docs[4][1], "en"), (None, docs[4][1], "en"), (600, None, None), (601, "", "")]
    labels = [(i, int(i % 2), int(i % 7 == 0)) for i in range(560)] + [(5, 1, None), (6, None, 1), (None, 1, 1)]
    frame = spark.createDataFrame([(*d, "m", "d") for d in docs], "doc_id long, text string, lang string, mask string, digest string").repartition(4)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(frame, known)
    assert audited(got) == audit_rows(docs, labels)
    assert filter_audit.audit(frame.limit(0), known).count() == 0
    assert audited(filter_audit.audit(frame, known.limit(0))) == audit_rows(docs, [])


def test_gray_walk_against_plain_sums():
    cells = {m: (m + 1, m * m) for m in (0, 1, 2, 5, 7)}
    states = filter_audit.gray_walk(cells, 3)
    for s in range(8):
        assert states[s].tolist() == [sum(v[k] for m, v in cells.items() if not m & s) for k in (0, 1)]


# --- token alignment ---


def align_plainly(texts):
    """Rows of the contract, from whole texts and loops over tokens."""
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    a = Tokenizer.from_file(f"{token_pairs.TOKENIZERS}/{token_pairs.BYTE_BPE}")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{token_pairs.TOKENIZERS}/{token_pairs.PIECE_BPE}")
    assert decoders.ByteLevel().decode(["Ġx"]) == " x"
    letters = token_pairs.byte_of_character()

    def piece(i):
        p = b.id_to_piece(i)
        return bytes.fromhex(p[3:5]) if p.startswith("<0x") and p.endswith(">") and len(p) == 6 else p.replace("▁", " ").encode()

    aligned, counts = [], Counter()
    for t in texts:
        found = None
        if t:
            ia, ib = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            ba, bb = [bytes(letters[c] for c in a.id_to_token(i)) for i in ia], [piece(i) for i in ib]
            if b"".join(ba) == b"".join(bb) == (" " + t).encode():
                ea, eb = np.cumsum([len(x) for x in ba]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
                sa, sb = [0, *ea[:-1]], [0, *eb[:-1]]
                links, j = [], 0
                for i in range(len(ia)):
                    while eb[j] <= sa[i]:
                        j += 1
                    k = j
                    while k < len(ib) and sb[k] < ea[i]:
                        links.append((ia[i], ib[k]))
                        k += 1
                groups, x, y = [], 0, 0
                for e in sorted(set(ea) & set(eb)):
                    p, q = ea.index(e, x) + 1, eb.index(e, y) + 1
                    groups.append(",".join(map(str, ia[x:p])) + "|" + ",".join(map(str, ib[y:q])))
                    x, y = p, q
                found = (len(ia), len(ib), groups, links)
                counts.update(links)
        aligned.append(found)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(n, best.get(y, 0))
    out = []
    for f in aligned:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            high = sum(counts[x] == best[x[1]] for x in f[3])
            out.append((f[0], f[1], len(f[2]), len(f[3]), high, sum(counts[x] for x in f[3]), hashlib.sha256(";".join(f[2]).encode()).hexdigest()))
    return out, counts


def reported(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()}


ODD = [
    None, "", " ", "a", " a  b ", "a\n\nb \n c\t d", "it's we'll 12,345.67", "<|endoftext|> x <s> </s> <unk> <0x41>", "▁ a text that loses bytes", "x▁y fine words",
    "naïve Füße 東京 \U0001f600 ​ é é", "a\xa0b \xa0 c", "\x00 \x1c x\x1cy \x85 z", "the the the", "tab\tand space", "trailing space ", "ﬁ ａ ①", "x" * 400,
    "fine words of text " * 3, "　 ideographic　space",
]


@pytest.mark.parametrize("small", [False, True])
def test_alignment_against_plain_loops(spark, monkeypatch, small):
    """With ``small``, several shards, rounds, flushes, slices of one text and chunks of one or two words."""
    if small:
        for name, value in {"SHARD": 64, "ROUND": 200, "HOLD": 40, "SLICE": 60, "CHUNK": 2}.items():
            monkeypatch.setattr(token_pairs, name, value)
    texts = ODD + [r.text for r in table(spark, SF_SMALL, "documents").orderBy("doc_id").limit(25).collect()]
    texts += [texts[-1], texts[-1], "▁ " + texts[-2]]
    docs = spark.createDataFrame([(i, t, 9, "g") for i, t in enumerate(texts)], "doc_id long, text string, n_a int, groups string").repartition(3)
    want, counts = align_plainly(texts)
    assert reported(token_pairs.alignment_report(docs)) == dict(enumerate(want))
    if not small:
        files = token_pairs.read_files()
        made = token_pairs.count_pairs(docs, files)
        assert {(r.a, r.b): r.n for r in token_pairs.pair_table(made.table, len(made.best)).collect()} == dict(counts)
        rows = token_pairs.align_documents(docs, made).collect()
        assert {r._row.groups for r in rows} == {"g"} and all(hashlib.sha256(r.groups.encode()).hexdigest() == want[r._row.doc_id][6] for r in rows if r.groups)


def test_alignment_of_a_whole_table(spark):
    docs = table(spark, SF_MID, "documents")
    rows = docs.select("doc_id", "text").collect()
    assert reported(token_pairs.alignment_report(docs)) == dict(zip([r.doc_id for r in rows], align_plainly([r.text for r in rows])[0], strict=True))


def test_merges_by_rank_give_the_ids_of_the_file():
    """Every code point of the first two planes among letters, digits, spaces and marks."""
    files = token_pairs.read_files()
    by_rank, by_file = token_pairs.load(files).encode_a, token_pairs.file_encoder(files.byte_bpe)
    assert "by_rank" in by_rank.__code__.co_freevars
    for at in range(0, 0x20000, 512):
        chars = [chr(c) for c in range(at, at + 512) if not 0xD800 <= c < 0xE000]
        texts = [f" a{c}b1{c}2 {c}x {c} {c}{c}!{c}9" for c in chars]
        assert by_rank(texts) == by_file(texts)


def test_alignment_of_no_text(spark, no_docs):
    assert token_pairs.alignment_report(no_docs).count() == 0
    nothing = spark.createDataFrame([(1, None), (1, ""), (None, "▁")], "doc_id long, text string")
    assert [tuple(r)[1:] for r in token_pairs.alignment_report(nothing).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 3


def test_a_pair_that_was_not_counted_fails(spark):
    files = token_pairs.read_files()
    counts = token_pairs.count_pairs(spark.createDataFrame([("plain words",)], "text string"), files)
    with pytest.raises(Exception, match="was not counted"):
        token_pairs.align_documents(spark.createDataFrame([("unseen zebra crossing",)], "text string"), counts).collect()


def test_perfect_hash():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 50_000))
    made = token_pairs.PerfectHash.build(keys)
    assert sorted(made(keys)) == list(range(len(keys)))
    assert 8 * made.bits.nbytes / len(keys) < 5 and made(keys + (1 << 41)).max() < len(keys)
    assert len(token_pairs.PerfectHash.build(keys[:0])(keys[:0])) == 0
