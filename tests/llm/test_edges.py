"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import numpy as np
import pytest

from seasonkit.llm import (
    bucket_pointer, components, decontamination, embedding_dedup, kneser_ney, minhash, packing, pii, secret_scan, sharding, toxicity,
)

from seasonkit.llm.queries import QUERIES


@pytest.fixture(scope="module")
def benchmark(spark):
    item = "word5x5 word6x6 word7x7 word8x8 word9x9 word10x10 word11x11 word12x12 word13x13 word14x14 word15x15 word16x16 word17x17 word18x18"
    rows = [(1, item), (1, item), (2, None), (3, ""), (4, "one two"), (None, "lone")]
    return spark.createDataFrame(rows, "item_id long, text string")


def run(name, docs, labels, benchmark):
    return {
        "minhash": lambda: minhash.near_duplicates(docs),
        "packing": lambda: packing.pack_documents(docs),
        "secrets": lambda: secret_scan.secret_report(docs),
        "repeats": lambda: bucket_pointer.remove_repeats(docs),
        "quality": lambda: kneser_ney.quality(docs, labels),
        "pii": lambda: pii.personal_data_report(docs),
        "contamination": lambda: decontamination.contamination(docs, benchmark),
        "toxicity": lambda: toxicity.classify_documents(docs, labels),
        "sharding": lambda: sharding.shard_documents(docs),
        "drop_toxic": lambda: toxicity.drop_toxic(docs, labels),
        "drop_near": lambda: minhash.drop_near_duplicates(docs),
        "drop_contaminated": lambda: decontamination.drop_contaminated(docs, benchmark),
        "redact": lambda: secret_scan.redact_secrets(docs),
        "sanitise": lambda: pii.sanitise_documents(docs),
    }[name]()


EVERY_ROW = ["minhash", "secrets", "repeats", "quality", "pii", "contamination", "toxicity", "sharding", "redact", "sanitise"]
FILTERS = ["drop_toxic", "drop_near", "drop_contaminated"]


@pytest.mark.parametrize("name", [*EVERY_ROW, *FILTERS, "packing"])
def test_empty_tables(spark, no_docs, no_labels, odd_docs, name):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert run(name, no_docs, no_labels, nothing).count() == 0
    if name in ("quality", "toxicity", "contamination"):
        assert run(name, odd_docs, no_labels, nothing).count() == odd_docs.count()


@pytest.mark.parametrize("name", EVERY_ROW)
def test_every_row_has_a_result(odd_docs, odd_labels, benchmark, name):
    got = run(name, odd_docs, odd_labels, benchmark).toPandas()
    assert sorted(got.doc_id.fillna(-1).astype(int)) == sorted([-1 if r.doc_id is None else r.doc_id for r in odd_docs.collect()])


def test_columns_stay(odd_docs, odd_labels, benchmark):
    for name in (*FILTERS, "redact", "sanitise"):
        got = run(name, odd_docs, odd_labels, benchmark)
        assert got.columns == odd_docs.columns
        assert {r._spans + r.shard + r.rep + r._key + r._features for r in got.collect()} <= {"xyzkf"}


def test_defined_results(odd_docs, odd_labels, benchmark):
    rows = lambda name: {r.doc_id: r for r in run(name, odd_docs, odd_labels, benchmark).collect()}
    near = rows("minhash")
    assert [near[i].class_id for i in (1, 2, 10, 3, 4, 5, 6, 7, 8, 9)] == [1, 1, 1, 3, 4, 4, 6, 6, 8, 9]
    assert near[2].copies == 3 and near[None].kept
    secrets = rows("secrets")
    assert (secrets[3].n_assign, secrets[3].spans) == (0, "") and secrets[None].n_assign == 1
    text = {r.doc_id: r.text for r in odd_docs.collect()}[11]
    start, end = text.index("password"), text.index("hunter2x") + 8
    assert secrets[11].spans == f"assign:{start}:{end}"
    assert rows("redact")[11].text == text[:start] + "[SECRET]" + text[end:]
    assert rows("pii")[None].spans.startswith("email:") and rows("pii")[11].n_phone == 1
    assert rows("sanitise")[None].text.endswith("[EMAIL] [IP]")
    hit = rows("contamination")
    assert (hit[6].n_hit, hit[6].items, hit[6].contaminated) == (14, ["1"], False)
    assert (hit[1].items, hit[9].n_hit, hit[9].n_items, hit[9].contaminated, hit[3].n_words) == (["4"], 1, 0, True, 0)
    gone = rows("repeats")
    assert gone[1].n_removed == 0 < gone[2].n_removed == gone[2].n_bytes and gone[7].n_removed == gone[7].n_bytes
    assert gone[3].n_bytes == 0 and gone[10].n_removed == 0
    packed = run("packing", odd_docs, odd_labels, benchmark).toPandas()
    assert packed[packed.doc_id == 6]["length"].sum() == 30_000 and packed[packed.doc_id == 4].bin_id.isna().all()


def test_the_bound_on_training_rows_keeps_the_share_of_toxic_rows(spark):
    """A quarter of the grey texts is toxic: none is predicted, however the classes are sampled."""
    text = lambda i: f"grey matter of row{i % 7}" if i % 5 < 2 else f"plain words in row{i % 7}"
    docs = spark.createDataFrame([(i, text(i)) for i in range(5000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 5 < 2 and i // 5 % 4 == 0)) for i in range(5000)], "doc_id long, quality int, toxic int")
    for most in (400, 5000):
        got = toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels, max_train_rows=most)).toPandas()
        grey = got["text"].str.startswith("grey")
        assert (got["_score"] < 0.5).all() and 0.15 < got["_score"][grey].mean() < 0.35 and got["_score"][~grey].mean() < 0.05


def test_names_near_one_entity_of_a_dense_source(spark):
    """A name that stands near one address is marked everywhere in the documents that hold the address, and nowhere else."""
    rng = np.random.default_rng(2)
    filler = [a + b + c for a in "bdfgklm" for b in "aeiou" for c in "nrstvxz"]
    words = lambda n: list(rng.choice(filler, n))
    crowd = lambda: sum(([*words(14), f"user{rng.integers(40)}@mail.example"] for _ in range(4)), [])
    texts = [[*crowd(), *words(5)] for _ in range(400)]
    texts += [["Zebulon", *words(12), *crowd(), *words(9), "zebulon", "Boss@corp.example", *words(5)] for _ in range(20)]
    texts += [["zebulon", *crowd()] for _ in range(5)]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    report = pii.personal_data_report(docs).toPandas().set_index("doc_id").sort_index()
    assert {i: n for i, n in report.n_term.items() if n} == dict.fromkeys(range(400, 420), 2)
    assert all(s.startswith("term:0:7,") for s in report.spans[400:420])
    clean = pii.sanitise_documents(docs).toPandas().set_index("doc_id").sort_index().text
    assert not clean[400:420].str.contains("(?i)zebulon").any() and clean[420:].str.startswith("zebulon").all()


def test_proximity_matches_against_brute_force(spark):
    """Windows of which any three words are altered, or with a word inserted or left out; short items."""
    rng = np.random.default_rng(4)
    common = [f"c{i}" for i in range(12)]
    item = lambda k, n: [f"i{k}w{j}" if rng.random() < 0.5 else str(rng.choice(common)) for j in range(n)]
    items = {k: item(k, n) for k, n in enumerate([13, 20, 30, 13, 16, 5, 2, 1])}
    texts = [list(rng.choice(common, 60)) for _ in range(10)]
    for w in list(items.values()) * 12:
        part = list(w[: rng.integers(1, 18)]) if rng.random() < 0.3 else list(w)
        for at in rng.choice(len(part), min(len(part), int(rng.integers(0, 5))), replace=False):
            part[at] = "altered"
        if rng.random() < 0.5:
            part.insert(int(rng.integers(0, len(part) + 1)), "inserted")
        elif rng.random() < 0.5:
            del part[int(rng.integers(0, len(part)))]
        texts.append([*rng.choice(common, 9), *part, *rng.choice(common, 9)])
    docs = spark.createDataFrame([(i, " ".join(map(str, t))) for i, t in enumerate(texts)], "doc_id long, text string")
    known = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")

    def near(t, w):
        n = min(13, len(w))
        for d in range(-len(w) - 1, len(t) + 1):
            on = [any(0 <= q + d + e < len(t) and t[q + d + e] == x for e in (-1, 0, 1)) for q, x in enumerate(w)]
            if any(13 * sum(on[s : s + n]) >= 10 * n for s in range(len(w) - n + 1)):
                return True
        return False

    got = {r.doc_id: r.near_items for r in decontamination.near_matches(docs, known).collect()}
    want = {i: sorted(str(k) for k, w in items.items() if near(t, w)) for i, t in enumerate(texts)}
    assert got == want and sum(map(len, want.values())) > 50


def test_an_edited_passage_is_found_by_the_registered_query(spark, tmp_path):
    """Altered where its rarest words stand, and with a word inserted in the middle."""
    item = "the of and to in is it that was for on zygote quark".split()
    altered = [*item[:11], "a", "b"]
    shifted = [*item[:6], "so", *item[6:]]
    rows = [(1, " ".join(altered)), (2, " ".join(shifted)), (3, "of the and")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, " ".join(item))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r.near_items for r in QUERIES["op8_proximity_matches"](spark, str(tmp_path)).collect()}
    assert got == {1: ["7"], 2: ["7"], 3: []}


def test_many_unlike_copies_of_one_text(spark):
    """A group that one leader can't settle: two families in the same buckets, many members each."""
    rng = np.random.default_rng(3)
    rows, family = [], {}
    base = [f"b{i}" for i in range(300)]
    for f in range(3):
        start = [w if rng.random() > 0.04 else f"f{f}w{i}" for i, w in enumerate(base)]
        for k in range(40):
            words = list(start)
            for at in rng.integers(0, 300, 2):
                words[at] = f"m{f}x{k}x{at}"
            family[f * 100 + k] = f
            rows.append((f * 100 + k, " ".join(words)))
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).toPandas().set_index("doc_id")
    assert got.class_id.groupby(family).nunique().eq(1).all()


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200)] + [(500, 501), (501, 500), (700, 700)], "u long, v long")
    got = {r.vertex: r.component for r in components.connected_components(edges).collect()}
    assert set(got.values()) == {0, 500} and got[200] == 0 and got[501] == 500 and len(got) == 203


def test_odd_vectors(spark):
    v, w = [1.0, 2.0, 3.0], [3.0, -1.0, 0.5]
    nan, inf = float("nan"), float("inf")
    rows = [(1, v, 0), (2, v, 0), (3, [2.0, 4.0, 6.0], 0), (4, v, 1), (5, v, None), (6, None, 0), (7, [0.0] * 3, 0), (8, [nan, 1.0, 1.0], 0),
            (9, [inf, 1.0, 1.0], 0), (10, [1.0, None, 2.0], 0), (11, [1.0, 2.0], 0), (12, [], 0), (13, w, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_vectors(df).collect()}
    assert got[1] == (2, 1, True) and got[2] == (2, 1, False) and got[3] == (2, 1, False)
    assert all(got[i] == (0, i, True) for i in range(4, 14))
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_blocks_of_a_large_bucket(spark, monkeypatch):
    """Splitting a bucket into blocks changes no link; recall against brute force."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(8, 16))[rng.integers(0, 8, 300)] + 0.12 * rng.normal(size=(300, 16))
    df = spark.createDataFrame([(i, [float(c) for c in r], i % 2) for i, r in enumerate(x.astype(np.float32))], "vec_id long, embedding array<float>, label int")
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    got = embedding_dedup.near_vectors(df).toPandas().set_index("vec_id").sort_index()
    u = x.astype(np.float32).astype(float)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    near = (u @ u.T >= 0.93) & (np.arange(300)[:, None] % 2 == np.arange(300)[None] % 2)
    want = near.sum(axis=1) - 1
    assert (got.n_links <= want).all() and got.n_links.sum() >= 0.99 * want.sum()


def test_recall_at_the_key_length_of_ten_million_vectors(spark, monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(1000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    cosine = rng.uniform(0.9301, 0.9350, size=(1000, 1))
    both = np.concatenate([x, cosine * x + np.sqrt(1 - cosine**2) * y])
    df = spark.createDataFrame([(i, [float(c) for c in r], 0) for i, r in enumerate(both)], "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(embedding_dedup, "BITS_LOW", 21)  # ceil(log2(10 million)) - 3
    got = embedding_dedup.near_vectors(df).toPandas().set_index("vec_id").sort_index()
    assert (got.n_links <= 1).all() and got.n_links.mean() >= 0.99
    assert (got.component_id[got.n_links == 1] == got.index[got.n_links == 1] % 1000).all()


def test_best_fit_opens_the_cheapest_size():
    bins, offsets, caps = packing.best_fit([6, 5, 3, 2, 1], [8, 16], lambda n: 1.0 + n)
    assert sorted(caps) == [16] or sorted(caps) == [8, 8, 8] or sum(caps) <= 24
    assert bins[0] == 0 and offsets[0] == 0
    one, _, small = packing.best_fit([3], [4, 8, 16], lambda n: float(n))
    assert (one, small) == ([0], [4])
