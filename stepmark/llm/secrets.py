"""Secret scans: fixed patterns, and a randomness battery with false-discovery control.

DataFrame functions only. Patterns find the known kinds of secrets; the battery finds strings
that no pattern names but that look drawn at random from their alphabet.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stepmark.llm.common import pick, through_table

#: Fixed patterns of the base kinds, in their listed order. Letters of the names in either case.
ASSIGN = (
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"""
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a shorter run after AKIA fails as a whole
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex")
LEAST_VALUE = 12

#: Strings that the battery tests.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
RANDOM = "random"

#: Alphabets by inferred encoding, in the order in which they are tried.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "alnum": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
SHAPES = {"hex": r"^([0-9a-f]+|[0-9A-F]+)$", "base32": r"^[A-Z2-7]+=*$", "alnum": r"^[0-9A-Za-z]+$"}

#: Least deviations from randomness that count as ordinary text: relative squared distance of the
#: letter frequencies from uniform, share of missing or excess runs, and serial correlation.
UNEVEN, RUNS_OFF, SERIAL = 1.6, 0.3, 0.5
#: A string that is not even, mixed and uncorrelated at this level is never taken for random.
GATE = 0.5

#: Ordinary strings (names, paths, numbers in ASCII) as a chain of letter classes: shares of the
#: class that follows upper, lower, digit and sign, and shares of the letters inside a class.
PLACES = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789/-_=+"
FOLLOWS = [0.40, 0.45, 0.08, 0.07, 0.06, 0.85, 0.03, 0.06, 0.08, 0.10, 0.70, 0.12, 0.15, 0.60, 0.15, 0.10]
ENGLISH = [8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.8, 4.0, 2.4, 6.7, 7.5, 1.9, 0.1, 6.0, 6.3, 9.1, 2.8, 1.0, 2.4, 0.15, 2.0, 0.07]
SHARES = [v / sum(ENGLISH) for v in ENGLISH] * 2 + [0.1] * 10 + [0.4, 0.25, 0.25, 0.05, 0.05]
BINS_PER_BIT, MOST_BIN = 64, 6400
GROUP = 256


def _starts(pieces: Column, widths: Column) -> Column:
    """0-based start of each match from the lengths of the pieces around and of the matches.

    Sums run over groups of 256 first, and both the steps and the group sums are bound, so that
    they are computed once: n matches cost about n * (128 + n / 512) additions.
    """
    add = lambda part: F.aggregate(part, F.lit(0).cast("long"), lambda s, x: s + x)
    steps = F.zip_with(pieces, widths, lambda a, b: F.coalesce(a, F.lit(0)).cast("long") + F.coalesce(b, F.lit(0)))

    def grouped(steps: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(steps) / GROUP).cast("int")), lambda g: add(F.slice(steps, g * GROUP + 1, GROUP)))

    def placed(steps: Column, groups: Column) -> Column:
        def start(width: Column, i: Column) -> Column:
            group = F.floor(i / GROUP).cast("int")
            return add(F.slice(groups, 1, group)) + add(F.slice(steps, group * GROUP + 1, i % GROUP + 1)) - width

        return F.transform(widths, start)

    return _let(steps, lambda s: _let(grouped(s), lambda groups: placed(s, groups)))


def _matched(text: Column, pattern: str, group: int = 0) -> tuple[Column, Column]:
    """Lengths of what lies between the matches, and the matched strings."""
    return F.transform(F.split(text, pattern, -1), F.length), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _normal(z: Column) -> Column:
    """Standard normal distribution function by the logistic approximation (error below 2e-4)."""
    z = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return 1.0 / (1.0 + F.exp(-1.5976 * z - 0.07056 * z * z * z))


def _encoding(token: Column) -> Column:
    named = F.lit("base64")
    for name in ("alnum", "base32", "hex"):
        named = F.when(token.rlike(SHAPES[name]), F.lit(name)).otherwise(named)
    return named


def battery(token: Column, encoding: Column) -> Column:
    """p-value of "this string is ordinary text" against "it is random in its encoding".

    Three tests have as their hypothesis a deviation at least as large as ordinary text shows:
    chi-squared over the alphabet, runs below and above its middle, correlation of neighbours.
    p is 1 unless all three speak against it. How small p gets is then told by the likelihood
    ratio of chance against ordinary text, over the best stretch of the string: under ordinary
    text a stretch of t bits has a probability of at most n / 2**t. So 20 random characters can
    give a small p, also inside of a path.
    """
    plain = F.when(encoding == "hex", F.lower(token)).otherwise(F.translate(token, "-_=", "+/"))
    plain = F.when(encoding == "base32", F.regexp_replace(token, "=+$", "")).otherwise(plain)
    alphabet = F.lit(ALPHABETS["base64"])
    for name in ("alnum", "base32", "hex"):
        alphabet = F.when(encoding == name, F.lit(ALPHABETS[name])).otherwise(alphabet)
    chars = F.filter(F.split(plain, ""), lambda c: c != "")
    worst = _let(F.transform(chars, lambda c: (F.instr(alphabet, c) - 1).cast("double")), lambda x: _worst(x, F.length(alphabet).cast("double")))
    return F.when(worst < GATE, _chance(token, F.log2(F.length(alphabet).cast("double")))).otherwise(1.0)


def _chance(token: Column, bits: Column) -> Column:
    """Bound on the probability that ordinary text has a stretch as much like chance as the best."""
    follows, shares = F.lit([-log2(v) for v in FOLLOWS]), F.lit([-log2(v) for v in SHARES])
    kind = lambda k: F.when(k <= 26, 0).when(k <= 52, 1).when(k <= 62, 2).otherwise(3)
    gain = lambda u, v: F.element_at(follows, kind(u) * 4 + kind(v) + 1) + F.element_at(shares, v) - bits

    def best(k: Column) -> Column:
        gains = F.zip_with(F.slice(k, 1, F.size(k) - 1), F.slice(k, 2, F.size(k) - 1), gain)
        none = F.struct(F.lit(0.0).alias("now"), F.lit(0.0).alias("best"))
        add = lambda s, g: F.struct(F.greatest(F.lit(0.0), s["now"] + g).alias("now"), F.greatest(s["best"], s["now"] + g).alias("best"))
        return F.aggregate(gains, none, add, lambda s: s["best"])

    places = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(PLACES), c))
    return F.least(F.lit(1.0), F.length(token) * F.pow(F.lit(2.0), -_let(places, best)))


def _let(value: Column, body) -> Column:
    """body(value) with `value` computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def _worst(x: Column, a: Column) -> Column:
    """Largest p-value of the three tests on the places `x` in an alphabet of `a` letters."""
    n = F.size(x).cast("double")
    squares = _sum(F.transform(F.array_distinct(x), lambda v: F.pow(n - F.size(F.array_remove(x, v)), F.lit(2.0))))
    expected = a - 1 + n * UNEVEN
    uniform = _normal((a / n * squares - n - expected) / F.sqrt(2 * (a - 1) + 4 * n * UNEVEN))
    following = lambda f: _sum(F.zip_with(F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x)), f))
    changes = following(lambda u, v: F.when((u < a / 2) != (v < a / 2), 1.0).otherwise(0.0))
    runs = _normal((F.abs(changes - (n - 1) / 2) - RUNS_OFF * (n - 1)) / (0.5 * F.sqrt(n - 1)))

    def correlated(mean: Column) -> Column:
        spread = _sum(F.transform(x, lambda v: (v - mean) * (v - mean)))
        shared = following(lambda u, v: (u - mean) * (v - mean))
        return F.when(spread > 0, F.abs(shared / spread)).otherwise(1.0)

    serial = _normal((_let(_sum(x) / n, correlated) - SERIAL) * F.sqrt(n))
    return F.when(n > 2, F.greatest(uniform, runs, serial)).otherwise(1.0)


def _thresholds(tested: DataFrame, rate: float) -> DataFrame:
    """(encoding, length_class, least_bin): Benjamini-Hochberg at `rate` in each family.

    A family is the strings of one encoding whose lengths lie between the same powers of two.
    p-values are rounded up to 1/64 of a bit, which makes the step-up rule a running count over
    at most 6,401 bins of a family instead of a sort of all strings.
    """
    counts = tested.groupBy("encoding", "length_class", "bin").agg(F.count("*").alias("n"))
    family = W.partitionBy("encoding", "length_class")
    counts = counts.withColumn("found", F.sum("n").over(family.orderBy(F.col("bin").desc()))).withColumn("tests", F.sum("n").over(family))
    passing = counts.where(F.pow(F.lit(2.0), -F.col("bin") / BINS_PER_BIT) <= rate * F.col("found") / F.col("tests"))
    return passing.groupBy("encoding", "length_class").agg(F.min("bin").alias("least_bin"))


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: float = 0.05) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_random, base, found.

    `base` holds the matches of the fixed patterns, leftmost and non-overlapping per kind, and
    `found` those and the strings that the battery accepts, as arrays of (start, order, end) in
    code points, end exclusive, sorted. The battery tests strings of 20 or more letters of an
    encoding, with a letter and a digit, that overlap no base span; `rate` bounds the expected
    share of ordinary strings among the accepted ones of a family.

    NULL and empty texts have no spans; texts are searched whole; equal rows give equal rows; an
    empty table gives none. The text is read once: what follows runs on lengths and candidates.
    """
    whole = F.coalesce(F.col("text"), F.lit(""))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "token": CANDIDATE}
    columns: dict[str, Column] = {}
    for kind, pattern in patterns.items():
        columns[f"{kind}_pieces"], matches = _matched(whole, pattern)
        columns[f"{kind}_widths"] = F.transform(matches, F.length)
    columns["assign_values"] = F.transform(_matched(whole, ASSIGN, 2)[1], F.length)
    columns["tokens"] = _matched(whole, CANDIDATE)[1]
    found = pick(docs, doc_id=doc_id, text=text).withColumns(columns).drop("text")
    found = through_table(found, "matches")

    def spans(kind: str, order: int, keep) -> Column:
        starts = _starts(F.col(f"{kind}_pieces"), F.col(f"{kind}_widths"))
        both = F.zip_with(
            starts, F.col(f"{kind}_widths"), lambda s, w: F.struct(s.alias("start"), F.lit(order).alias("order"), (s + w).alias("end"))
        )
        return keep(both)

    longer = lambda both: F.filter(both, lambda x, i: F.element_at("assign_values", i + 1) >= LEAST_VALUE)
    found = found.select(
        "doc_id",
        spans("assign", 0, longer).alias("assign"),
        spans("access", 1, lambda x: x).alias("access"),
        spans("hex", 2, lambda x: x).alias("hex"),
        F.zip_with(_starts(F.col("token_pieces"), F.col("token_widths")), F.col("tokens"), lambda s, t: F.struct(s.alias("start"), t.alias("token"))).alias("tokens"),
    ).withColumn("base", F.array_sort(F.concat("assign", "access", "hex")))

    def test(one: Column) -> Column:
        token, start = one["token"], one["start"]
        return _let(
            _encoding(token),
            lambda encoding: F.struct(
                start.alias("start"),
                F.lit(len(KINDS)).alias("order"),
                (start + F.length(token)).alias("end"),
                encoding.alias("encoding"),
                F.floor(F.log2(F.length(token).cast("double"))).cast("int").alias("length_class"),
                F.floor(F.least(-F.log2(battery(token, encoding)) * BINS_PER_BIT, F.lit(float(MOST_BIN)))).cast("int").alias("bin"),
            ),
        )

    mixed = lambda one: one["token"].rlike("[0-9]") & one["token"].rlike("[A-Za-z]")
    # A token is a whole run of letters that the patterns of access and hex are made of, so those
    # of its matches that lie in a token are told by the token; assign matches are compared.
    apart = lambda one: ~(
        one["token"].rlike(ACCESS)
        | one["token"].rlike(HEX)
        | F.exists("assign", lambda b: (b["start"] < one["start"] + F.length(one["token"])) & (one["start"] < b["end"]))
    )
    found = found.withColumn("tokens", F.filter("tokens", lambda one: mixed(one) & apart(one))).withColumn("tests", F.transform("tokens", test)).drop("tokens")
    found = through_table(found, "tests")
    tested = found.select(F.explode("tests").alias("t")).select("t.encoding", "t.length_class", "t.bin")
    # at most 4 encodings and 31 length classes
    least = F.map_from_entries(F.collect_list(F.struct(F.concat_ws(" ", "encoding", F.col("length_class").cast("string")), "least_bin")))
    limits = _thresholds(tested, rate).agg(least.alias("limits"))

    def accepted(t: Column) -> Column:
        limit = F.element_at("limits", F.concat_ws(" ", t["encoding"], t["length_class"].cast("string")))
        return F.coalesce(t["bin"] >= limit, F.lit(False))

    kept = F.transform(F.filter("tests", accepted), lambda t: F.struct(t["start"], t["order"], t["end"]))
    found = found.crossJoin(F.broadcast(limits)).withColumn("random", kept)  # one row of limits
    count = lambda name: F.size(name).cast("long").alias(f"n_{name}")
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"), count("random"), "base", F.array_sort(F.concat("base", "random")).alias("found")
    )


def as_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in (*KINDS, RANDOM)])
    one = lambda s: F.concat_ws(":", F.element_at(kinds, s["order"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
