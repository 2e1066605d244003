"""Secret scans: fixed patterns, and a randomness test battery over long tokens.

Everything is DataFrame expressions; texts are never shuffled.

Base spans (kinds ``assign``, ``access``, ``hex``) are the leftmost non-overlapping matches
of the patterns below that pass their length rule.

The battery adds spans of kind ``random``. A token is a maximal run of 20 or more
characters of ``[A-Za-z0-9+/_-]``. Its encoding is inferred from its characters (decimal, hex,
base32, lower, upper36, alnum62, base64); the alphabet of the encoding orders the characters.
Three two-sided tests of "independent and uniform over the alphabet" follow:

* chi-squared uniformity, with the exact mean and variance of the multinomial statistic,
* Wald-Wolfowitz runs above and below the middle of the alphabet,
* lag-one serial correlation of the alphabet positions,

combined by Fisher's method into ``p_random``. A token is a candidate only if it isn't
rejected (``p_random >= MIN_P_RANDOM``). Ordinary text is the null of the discovery test: its
characters repeat more, with a known ratio of coincidences to a uniform alphabet, so
``p_ordinary`` is the probability that ordinary text of the token's length spreads its
characters at least as evenly (a noncentral chi-squared, in normal approximation). Candidates
are accepted by Benjamini-Hochberg at ``FDR`` within each stratum of encoding and length,
over all tokens of the corpus: p-values are counted in ``P_BINS`` steps of a tenth of a power of
ten, so what reaches the driver is one bounded table.

Defined cases: a null text is empty and has no spans; repeated rows get a result each; an
empty table gives no rows; a token of one repeated character has ``p_random`` 0.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, replace_spans, unboxed

# Fixed values of the contract: the patterns, their least lengths, the order of the kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 or more characters: runs are maximal
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "random")

TOKEN = r"[A-Za-z0-9+/_-]{20,}"
FDR = 0.05
MIN_P_RANDOM = 0.01
P_BINS = 120
LENGTH_BINS = (24, 32, 48, 64)
#: Ordinary prose: chance that two characters agree (index of coincidence), and the ratio to
#: uniform used for alphabets too small for prose.
PROSE_COINCIDENCE, SMALL_RATIO = 0.065, 1.8

DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
#: Encodings in the order of inference: name, pattern of the whole token, alphabet.
ENCODINGS = (
    ("decimal", "^[0-9]+$", DIGITS),
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef"),
    ("base32", "^[A-Z2-7]+$", LOWER.upper() + "234567"),
    ("lower", "^[a-z]+$", LOWER),
    ("upper36", "^[A-Z0-9]+$", DIGITS + LOWER.upper()),
    ("alnum62", "^[A-Za-z0-9]+$", DIGITS + LOWER.upper() + LOWER),
    ("base64", "", LOWER.upper() + LOWER + DIGITS + "+/-_"),
)


def match_positions(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, got) of the non-overlapping matches, in code points, end exclusive.

    ``got`` is the match's ``group``. Spark returns matches without positions; the texts
    between them, cut by the same pattern, give them back.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    got = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    zipped = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("b"), found.alias("f"), got.alias("g"))
    empty = F.array().cast("array<struct<start:long,end:long,got:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.char_length(x["b"])
        end = start + F.char_length(x["f"])
        span = F.struct(start.alias("start"), end.alias("end"), x["g"].alias("got"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    spans = F.aggregate(
        zipped, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"]
    )
    return F.when(F.regexp_like(text, F.lit(pattern)), spans).otherwise(empty)


def _of_kind(spans: Column, kind: str) -> Column:
    order = KINDS.index(kind)
    return F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"), F.lit(kind).alias("kind")),
    )


def _two_sided(z: Column) -> Column:
    """Two-sided normal p-value: the usual rational approximation of erfc, error under 2e-7."""
    x = F.abs(z) / F.lit(2.0**0.5)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(F.lit(1e-12), poly * F.exp(-x * x))


def _steps(items: Column, *fns: Callable[[Column], dict[str, Column]]) -> Column:
    """Each function adds fields to the structs of an array; later ones see the earlier fields."""
    fields = ["start", "end", "got"]
    for fn in fns:
        items, names = _step(items, fn, tuple(fields))
        fields += names
    return items


def _step(items: Column, fn: Callable[[Column], dict[str, Column]], fields: tuple[str, ...]) -> tuple[Column, list[str]]:
    names: list[str] = []

    def add(x: Column) -> Column:
        made = fn(x)
        names[:] = made
        return F.struct(*[x[f].alias(f) for f in fields], *[c.alias(n) for n, c in made.items()])

    return F.transform(items, add), names


def _by_encoding(token: Column, value: Callable[[str, str], Column | str | float]) -> Column:
    last = value(ENCODINGS[-1][0], ENCODINGS[-1][2])
    return reduce(
        lambda rest, e: F.when(token.rlike(e[1]), F.lit(value(e[0], e[2]))).otherwise(rest), reversed(ENCODINGS[:-1]), F.lit(last)
    )


def token_statistics(text: Column) -> Column:
    """Array of the text's tokens with their tests: start, end, got, encoding, n, k, chi2, p_random, p_ordinary."""

    def infer(x):
        return {
            "encoding": _by_encoding(x["got"], lambda name, _: name),
            "alphabet": _by_encoding(x["got"], lambda _, alphabet: alphabet),
        }

    def ranks(x):
        token = F.when(x["encoding"] == "hex", F.lower(x["got"])).otherwise(x["got"])
        return {
            "k": F.char_length(x["alphabet"]).cast("double"),
            "n": F.char_length(x["got"]).cast("double"),
            "ranks": F.transform(F.split(token, ""), lambda c: (F.position(c, x["alphabet"]) - 1).cast("double")),
        }

    def moments(x):
        high = F.transform(x["ranks"], lambda r: (r * 2 >= x["k"]).cast("int"))
        return {
            "squares": F.aggregate(
                F.array_distinct(x["ranks"]),
                F.lit(0.0),
                lambda a, r: a + F.pow(F.size(F.filter(x["ranks"], lambda y: y == r)).cast("double"), F.lit(2.0)),
            ),
            "mean": F.aggregate(x["ranks"], F.lit(0.0), lambda a, r: a + r) / x["n"],
            "high": high,
        }

    def sums(x):
        before = F.slice(x["ranks"], F.lit(1), F.size(x["ranks"]) - 1)
        after = F.slice(x["ranks"], F.lit(2), F.size(x["ranks"]) - 1)
        h0 = F.slice(x["high"], F.lit(1), F.size(x["high"]) - 1)
        h1 = F.slice(x["high"], F.lit(2), F.size(x["high"]) - 1)
        return {
            "chi2": x["squares"] * x["k"] / x["n"] - x["n"],
            "n1": F.aggregate(x["high"], F.lit(0), lambda a, h: a + h).cast("double"),
            "runs": F.aggregate(F.zip_with(h0, h1, lambda a, b: (a != b).cast("int")), F.lit(1), lambda a, b: a + b),
            "var": F.aggregate(x["ranks"], F.lit(0.0), lambda a, r: a + (r - x["mean"]) * (r - x["mean"])),
            "cov": F.aggregate(
                F.zip_with(before, after, lambda a, b: (a - x["mean"]) * (b - x["mean"])), F.lit(0.0), lambda a, b: a + b
            ),
        }

    def tests(x):
        n, k, n2 = x["n"], x["k"], x["n"] - x["n1"]
        chi = (x["chi2"] - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        expected = 2 * x["n1"] * n2 / n + 1
        spread = (expected - 1) * (expected - 2) / (n - 1)
        runs = F.when(spread > 0, (x["runs"] - expected) / F.sqrt(spread)).otherwise(F.lit(9.0))
        serial = F.when(x["var"] > 0, (x["cov"] / x["var"] + 1 / n) * F.sqrt(n)).otherwise(F.lit(9.0))
        ratio = F.when(k >= 26, k * F.lit(PROSE_COINCIDENCE)).otherwise(F.lit(SMALL_RATIO))
        shift = (n - 1) * (ratio - 1)
        ordinary = (x["chi2"] - (k - 1) - shift) / F.sqrt(2 * (k - 1) + 4 * shift)
        return {"p_chi": _two_sided(chi), "p_runs": _two_sided(runs), "p_serial": _two_sided(serial), "z_ordinary": ordinary}

    def combine(x):
        half = -(F.log(x["p_chi"]) + F.log(x["p_runs"]) + F.log(x["p_serial"]))  # half of Fisher's statistic, 6 degrees
        one_sided = _two_sided(x["z_ordinary"]) / 2
        return {
            "p_random": F.exp(-half) * (1 + half + half * half / 2),
            "p_ordinary": F.when(x["z_ordinary"] < 0, one_sided).otherwise(1 - one_sided),
        }

    found = match_positions(text, TOKEN)
    full = _steps(found, infer, ranks, moments, sums, tests, combine)
    return F.transform(
        full,
        lambda x: F.struct(
            *[x[f].alias(f) for f in ("start", "end", "got", "encoding", "n", "k", "chi2", "p_random", "p_ordinary")],
            _stratum(x).alias("stratum"),
            _p_bin(x["p_ordinary"]).alias("p_bin"),
        ),
    )


def _stratum(x: Column) -> Column:
    """Encoding and length class, as one string."""
    at = sum(((x["n"] >= b).cast("int") for b in LENGTH_BINS), F.lit(0))
    return F.concat_ws(":", x["encoding"], at.cast("string"))


def _p_bin(p: Column) -> Column:
    """Tenths of a power of ten: bin b holds p in [10**(-(b+1)/10), 10**(-b/10)), the last one all smaller p."""
    return F.least(F.lit(P_BINS - 1), F.greatest(F.lit(0), F.floor(-10 * F.log10(p)))).cast("int")


def accepted_bins(counts: list[tuple[str, int, int, int]], fdr: float = FDR) -> dict[str, int]:
    """The least accepted bin of each stratum, by Benjamini-Hochberg on binned p-values.

    ``counts``: (stratum, bin, tokens, candidates). A bin's upper bound stands for its
    p-values, which only makes the rule stricter. Strata without a discovery are left out.
    """
    out: dict[str, int] = {}
    for stratum in sorted({c[0] for c in counts}):
        own = {c[1]: (c[2], c[3]) for c in counts if c[0] == stratum}
        total, found = sum(n for n, _ in own.values()), 0
        for b in range(P_BINS - 1, -1, -1):
            found += own.get(b, (0, 0))[1]
            if found and total * 10 ** (-b / 10) <= fdr * found:
                out[stratum] = b
    return out


def battery_thresholds(docs: DataFrame, fdr: float = FDR) -> dict[str, int]:
    """The accepted bin of each stratum, counted over every token of every text."""
    tokens = docs.select(F.explode(token_statistics(F.coalesce(F.col("text"), F.lit("")))).alias("x"))
    counts = (
        tokens.groupBy("x.stratum", "x.p_bin")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x.p_random") >= MIN_P_RANDOM).alias("c"))
        .collect()  # at most encodings x length classes x bins rows
    )
    return accepted_bins([(r["stratum"], r["p_bin"], r["n"], r["c"]) for r in counts], fdr)


def scan_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """The rows of ``docs`` with ``_spans``: array of (start, order, end, kind), sorted."""
    thresholds = battery_thresholds(docs, fdr)
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.filter(match_positions(text, ASSIGN, 2), lambda s: F.char_length(s["got"]) >= ASSIGN_LEAST)
    parts = [
        _of_kind(assign, "assign"),
        _of_kind(match_positions(text, ACCESS), "access"),
        _of_kind(match_positions(text, HEX), "hex"),
    ]
    if thresholds:
        least = F.create_map(*[F.lit(v) for kv in sorted(thresholds.items()) for v in kv])
        random = F.filter(
            token_statistics(text),
            lambda x: (x["p_random"] >= MIN_P_RANDOM) & F.coalesce(x["p_bin"] >= F.try_element_at(least, x["stratum"]), F.lit(False)),
        )
        parts.append(_of_kind(random, "random"))
    return docs.withColumn("_spans", F.array_sort(F.concat(*parts)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random for every row."""
    scanned = scan_secrets(docs.select("doc_id", "text"), fdr)
    count = lambda kind: F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_joined(F.filter("_spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        _joined(F.col("_spans")).alias("spans"),
        count("random").alias("n_random"),
    )


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """``docs`` with every span of every kind replaced by ``mark``; overlapping spans count as one.

    ``n_chars``, where the table has it, follows the new text. Other columns stay.
    """
    scanned = scan_secrets(boxed(docs, "text"), fdr)
    marked = F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(mark).alias("mark")))
    # a column of its own: beside a new ``text``, a lambda's ``text`` would be read as that one
    scanned = scanned.withColumn("_clean", replace_spans(F.col("text"), marked))
    changed = {"text": F.col("_clean")}
    if "n_chars" in docs.columns:
        n_chars = F.when(F.size("_spans") > 0, F.char_length("_clean").cast("long"))
        changed["n_chars"] = F.coalesce(n_chars, F.col("_row").getField("n_chars"))
    return unboxed(scanned, **changed)
