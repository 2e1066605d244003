"""The methods themselves against plain Python: packing's choices, the randomness battery, and the machine's pair term."""

import math
import zlib

import numpy as np

from seasonkit.llm import packing, secret_scan, toxicity


def packed_plainly(lengths, capacities, price):
    """Best fit by searching all open bins and filling every permitted size in thought, piece by piece."""
    bins, moment = [], 0  # [room, last touched, used, capacity]
    choice, offsets = [], []
    for at, n in enumerate(lengths):
        moment += 1
        open_ones = [b for b in bins if b[0] >= n]
        if open_ones:
            least = min(b[0] for b in open_ones)
            b = max((x for x in open_ones if x[0] == least), key=lambda x: x[1])
        else:
            rates = []
            for cap in (c for c in capacities if c >= n):
                room = cap - n
                for other in lengths[at + 1 :]:
                    if other <= room:
                        room -= other
                filled = cap - room
                rates.append((price(min(c for c in capacities if c >= filled)) / filled, cap))
            best = min(r for r, _ in rates)
            cap = next(c for r, c in rates if r == best)
            b = [cap, moment, 0, cap]
            bins.append(b)
        choice.append(next(i for i, x in enumerate(bins) if x is b))
        offsets.append(b[2])
        b[0], b[1], b[2] = b[0] - n, moment, b[2] + n
    return choice, offsets, [min(c for c in capacities if c >= b[2]) for b in bins]


def test_packing_against_a_plain_search():
    rng = np.random.default_rng(1)
    for capacities in ([16], [8, 16, 32], [5, 7, 50]):
        for _ in range(40):
            most = int(rng.integers(1, capacities[-1] + 1))
            lengths = sorted(rng.integers(1, most + 1, int(rng.integers(0, 60))).tolist(), reverse=True)
            for price in (packing.cost, lambda n: 1.0 + n, lambda n: n**1.5):
                assert packing.best_fit(lengths, capacities, price) == packed_plainly(lengths, capacities, price)


def battery(token, alphabet):
    """(p_random, p_ordinary) from the textbook formulas."""
    ranks = [alphabet.index(c) for c in token]
    n, k = len(ranks), len(alphabet)
    two_sided = lambda z: max(1e-12, math.erfc(abs(z) / math.sqrt(2)))
    chi2 = sum((ranks.count(r) - n / k) ** 2 / (n / k) for r in range(k))
    p_chi = two_sided((chi2 - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n))
    high = [2 * r >= k for r in ranks]
    n1, n2 = sum(high), n - sum(high)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:], strict=False))
    expected = 2 * n1 * n2 / n + 1
    spread = 2 * n1 * n2 * (2 * n1 * n2 - n) / (n * n * (n - 1))
    p_runs = two_sided((runs - expected) / math.sqrt(spread) if spread > 0 else 9.0)
    mean = sum(ranks) / n
    var = sum((r - mean) ** 2 for r in ranks)
    cov = sum((a - mean) * (b - mean) for a, b in zip(ranks, ranks[1:], strict=False))
    p_serial = two_sided((cov / var + 1 / n) * math.sqrt(n) if var else 9.0)
    half = -(math.log(p_chi) + math.log(p_runs) + math.log(p_serial))
    shift = (n - 1) * ((k * 0.065 if k >= 26 else 1.8) - 1)
    z = (chi2 - (k - 1) - shift) / math.sqrt(2 * (k - 1) + 4 * shift)
    return math.exp(-half) * (1 + half + half * half / 2), 0.5 * math.erfc(-z / math.sqrt(2))


def test_every_statistic_of_the_battery(spark):
    rng = np.random.default_rng(2)
    tokens = {"0" * 30: "decimal", "abababababababababababab": "lower", "a" * 25 + "b" * 25: "lower"}
    for name, _, alphabet in secret_scan.ENCODINGS:
        for n in (20, 33, 70):
            for _ in range(4):
                tokens["".join(rng.choice(list(alphabet), n))] = name
    alphabets = {name: alphabet for name, _, alphabet in secret_scan.ENCODINGS}
    docs = spark.createDataFrame([(t,) for t in tokens], "text string")
    found = docs.select("text", secret_scan.token_statistics(docs.text).alias("x")).collect()
    assert len(found) == len(tokens)
    for r in found:
        x = r.x[0]
        # a token drawn from a large alphabet may fit a smaller one; an upper-case hex token is read in lower case
        alphabet = alphabets[x.encoding]
        token = r.text.lower() if x.encoding == "hex" else r.text
        want = battery(token, alphabet)
        assert math.isclose(x.p_random, want[0], rel_tol=1e-3, abs_tol=1e-6), (r.text, x, want)
        assert math.isclose(x.p_ordinary, want[1], rel_tol=1e-3, abs_tol=1e-6), (r.text, x, want)
    assert {r.x[0].encoding for r in found} == set(alphabets)


def test_discoveries_against_benjamini_and_hochberg():
    """On the upper bounds of the bins the rule is the textbook's; on the p-values themselves it accepts no more than it."""
    rng = np.random.default_rng(3)
    for _ in range(50):
        p = np.concatenate([rng.uniform(0, 1, int(rng.integers(1, 200))), 10 ** rng.uniform(-11, -1, int(rng.integers(0, 40)))])
        bins = np.clip(np.floor(-10 * np.log10(p)), 0, secret_scan.P_BINS - 1).astype(int)
        counts = [("s", int(b), int((bins == b).sum()), int((bins == b).sum())) for b in np.unique(bins)]
        got = secret_scan.accepted_bins(counts).get("s")

        def accepted(values):
            order = np.sort(values)
            ok = np.flatnonzero(order <= secret_scan.FDR * np.arange(1, len(order) + 1) / len(order))
            return int(ok[-1]) + 1 if len(ok) else 0

        n_got = 0 if got is None else int((bins >= got).sum())
        assert n_got == accepted(10 ** (-bins / 10)) and n_got <= accepted(p)


def test_the_pair_term_finds_what_no_single_word_tells(spark):
    """Toxic only where an insult meets a group; either alone is as common among the clean texts."""
    rng = np.random.default_rng(4)
    filler = [a + b + c for a in "bdfglm" for b in "aeiou" for c in "nrstv"]
    rows, toxic = [], {}
    for i in range(6000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = [*rng.choice(filler, 12), *(["wretch"] if insult else ["cheers"]), *(["northers"] if group else ["weather"])]
        rows.append((i, " ".join(rng.permutation(words))))
        toxic[i] = int(insult == group)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, t) for i, t in toxic.items()], "doc_id long, quality int, toxic int")
    got = toxicity.classify_documents(docs, labels).toPandas()
    held = got[got.held_out]
    assert set(held.doc_id) == {i for i in toxic if zlib.crc32(str(i).encode()) % 5 == 0}
    assert np.mean([toxic[i] == p for i, p in zip(held.doc_id, held.predicted, strict=True)]) > 0.95
