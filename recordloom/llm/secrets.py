"""Secret scans: fixed forms, and a randomness test battery, in DataFrame operations alone.

Fixed forms are assignments of a password-like name, access key ids and long
hexadecimal runs. Beyond them every long token that mixes symbol classes is
tested. Its encoding (hex, base32, base36, base64) is inferred from its
symbols and gives the alphabet; over the alphabet three tests ask whether the
token is random:

* chi-squared uniformity of its symbols,
* the number of runs above and below the alphabet's middle,
* the serial correlation of neighbouring symbols.

Fisher's method combines their p-values, and a token that is not consistent
with randomness is dropped. Short tokens pass such tests too easily, so a
discovery must also be unlikely as text: against the repetition of letters in
words (coincidence ``COINCIDENCE``) the chi-squared statistic's lower tail gives
a p-value that shrinks with length, and the Benjamini-Hochberg rule at level
``LEVEL`` over a document's tokens controls false discoveries. A document is its
own family, so nothing is gathered across rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.tables import table

KINDS = ("assign", "access", "hex", "random")
#: Fixed forms. The failing matches of access and hex can't hide a passing one, so their least length stands in the pattern.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}"
LEAST_SECRET = 12
LEVEL, CONSISTENT, COINCIDENCE = 0.01, 0.001, 0.066
ALPHABETS = (
    ("^[0-9a-f-]+$", "0123456789abcdef"),
    ("^[0-9A-F-]+$", "0123456789ABCDEF"),
    ("^[A-Z2-7]+$", string.ascii_uppercase + "234567"),
    ("^[0-9a-z_-]+$", string.digits + string.ascii_lowercase),
    ("^[0-9A-Z_-]+$", string.digits + string.ascii_uppercase),
)
BASE64 = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"


def _running(values: Column, start: Column, step) -> Column:
    """The state before each value: ``start``, then what ``step(state, value)`` makes of it.

    A fold that grows an array copies it at each step. So the values are cut into
    about as many blocks as each holds values, the blocks' results are run
    through first, and each block from there: n values cost n * sqrt(n) copies.
    """
    side = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(values).cast("double"))).cast("int"))
    blocks = F.transform(F.sequence(F.lit(0), F.floor(F.greatest(F.size(values) - 1, F.lit(0)) / side).cast("int")), lambda k: F.slice(values, k * side + 1, side))

    def through(array: Column, first: Column) -> Column:
        state = F.struct(first.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(array, state, lambda acc, v: F.struct(step(acc["at"], v).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])

    ends = F.transform(blocks, lambda b: F.aggregate(b, start, step))
    return F.flatten(F.zip_with(blocks, through(ends, start), through))


def _places(text: Column, said: Column, pattern: str, rank: int) -> Column:
    """Array of (start, rank, end, said) of a pattern's matches ``said``, in code points."""
    none = F.array().cast("array<struct<start:int,rank:int,end:int,said:string>>")
    # A match begins after its gap; the gap behind the last match isn't needed.
    both = F.zip_with(said, F.slice(F.split(text, pattern, -1), F.lit(1), F.size(said)), lambda x, g: F.struct(x.alias("said"), F.length(g).alias("gap")))
    before = _running(F.transform(both, lambda x: F.length(x["said"]) + x["gap"]), F.lit(0), lambda at, v: at + v)
    every = F.zip_with(both, before, lambda x, at: F.struct((at + x["gap"]).alias("start"), F.lit(rank).alias("rank"), (at + x["gap"] + F.length(x["said"])).alias("end"), x["said"].alias("said")))
    return F.when(F.size(said) > 0, every).otherwise(none)


def _normal(z: Column) -> Column:
    """The standard normal distribution function, by a logistic form (error below 0.0002)."""
    return 1 / (1 + F.exp(-(1.5976 * z + 0.07056 * z * z * z)))


def _battery(tokens: Column) -> Column:
    """Array of (start, rank, end, said, fits, p) of tokens.

    ``fits`` is the combined p-value of the three tests, ``p`` that of being
    as even by the habits of words.
    """

    def infer(x: Column) -> Column:
        alphabet = F.lit(BASE64)
        for form, letters in reversed(ALPHABETS):
            alphabet = F.when(x["said"].rlike(form), F.lit(letters)).otherwise(alphabet)
        plain = F.when(alphabet == BASE64, F.translate(x["said"], "-_", "+/")).otherwise(x["said"])
        return F.struct(x.alias("x"), alphabet.alias("alphabet"), F.regexp_extract_all(plain, F.lit("."), F.lit(0)).alias("symbols"))

    def places(y: Column) -> Column:
        at = F.filter(F.transform(y["symbols"], lambda c: F.instr(y["alphabet"], c) - 1), lambda v: v >= 0)
        return F.struct(y["x"].alias("x"), F.length(y["alphabet"]).cast("double").alias("m"), at.alias("at"), F.size(at).cast("double").alias("n"))

    def total(array: Column, of) -> Column:
        return F.aggregate(array, F.lit(0.0), lambda acc, v: acc + of(v))

    def measure(y: Column) -> Column:
        at, n, m = y["at"], y["n"], y["m"]
        squares = total(F.array_distinct(at), lambda v: F.pow(F.size(F.filter(at, lambda w: w == v)).cast("double"), F.lit(2.0)))
        mean = total(at, lambda v: v.cast("double")) / n
        before, after = F.slice(at, F.lit(1), F.size(at) - 1), F.slice(at, F.lit(2), F.size(at) - 1)
        pairs = F.zip_with(before, after, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        turns = F.size(F.filter(pairs, lambda q: (q["a"] >= m / 2) != (q["b"] >= m / 2))).cast("double")
        return F.struct(
            y["x"].alias("x"), m.alias("m"), n.alias("n"),
            (m / n * squares - n).alias("chi"),
            F.size(F.filter(at, lambda v: v >= m / 2)).cast("double").alias("high"),
            (turns + 1).alias("runs"),
            total(pairs, lambda q: (q["a"] - mean) * (q["b"] - mean)).alias("lagged"),
            total(at, lambda v: (v - mean) * (v - mean)).alias("spread"),
        )

    def both_tails(z: Column) -> Column:
        return 2 * _normal(-F.abs(z))

    def values(y: Column) -> Column:
        m, n, high = y["m"], y["n"], y["high"]
        even = 1 - _normal((y["chi"] - (m - 1)) / F.sqrt(2 * (m - 1) * (n - 1) / n))
        expected = 1 + 2 * high * (n - high) / n
        variance = (expected - 1) * (expected - 2) / (n - 1)
        runs = F.when(variance > 0, both_tails((y["runs"] - expected) / F.sqrt(variance))).otherwise(0.0)
        serial = F.when(y["spread"] > 0, both_tails((y["lagged"] / y["spread"] + 1 / n) * F.sqrt(n))).otherwise(0.0)
        half = -sum(F.log(F.greatest(v, F.lit(1e-12))) for v in (even, runs, serial))
        habit = m * F.greatest(F.lit(COINCIDENCE), 1.6 / m)
        p = _normal((y["chi"] - (m - 1) - (n - 1) * (habit - 1)) / F.sqrt(2 * (m - 1) * habit))
        x = y["x"]
        return F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end"), x["said"].alias("said"), (F.exp(-half) * (1 + half + half * half / 2)).alias("fits"), p.alias("p"))

    enough = F.filter(F.transform(F.transform(tokens, infer), places), lambda y: y["n"] >= LEAST_SECRET)
    return F.transform(F.transform(enough, measure), values)


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """For every row: ``keep``, n_assign, n_access, n_hex, base_sha256, spans.

    ``spans`` holds kind:start:end of the fixed forms' matches and of the
    battery's discoveries, by start and then kind, comma-joined; offsets are
    code points, ends exclusive. A discovery that a fixed form's match covers
    isn't named again. Null and empty texts have no spans. Repeated rows are
    each returned, an empty table gives an empty one, texts of any length are
    read whole, spans that start together are in the order of their kinds, and
    extra columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    long_enough = lambda x: F.length(F.regexp_extract(x["said"], ASSIGN, 1)) >= LEAST_SECRET
    mixed = lambda x: x["said"].rlike("[0-9]") & x["said"].rlike("[A-Za-z]")
    # Matches are found once, in a projection of their own; a text is split at them only where it has some.
    forms = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "tokens": TOKEN}
    matched = docs.select(*keep, text.alias("__text"), *(F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"__{name}") for name, p in forms.items()))
    place = {name: _places(F.col("__text"), F.col(f"__{name}"), p, k) for k, (name, p) in enumerate(forms.items())}
    found = matched.select(*keep, F.filter(place["assign"], long_enough).alias("assign"), place["access"].alias("access"), place["hex"].alias("hex"), F.filter(place["tokens"], mixed).alias("tokens"))
    tested = found.select(*keep, "assign", "access", "hex", F.concat("assign", "access", "hex").alias("base"), _battery(F.col("tokens")).alias("tests"))
    # Benjamini-Hochberg: the largest rank j whose p-value is at most LEVEL * j / m.
    many = F.size("tests").cast("double")
    level = F.array_max(F.transform(F.array_sort(F.transform("tests", lambda x: x["p"])), lambda p, j: F.when(p <= LEVEL * (j + 1) / many, LEVEL * (j + 1) / many).otherwise(-1.0)))
    ranked = tested.withColumn("level", F.coalesce(level, F.lit(-1.0)))
    new = F.filter("tests", lambda x: (x["p"] <= F.col("level")) & (x["fits"] >= CONSISTENT) & ~F.exists("base", lambda b: (b["start"] <= x["start"]) & (b["end"] >= x["end"])))
    short = lambda a: F.transform(a, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["end"].alias("end")))
    said = lambda a: F.array_join(F.transform(F.array_sort(a), lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["rank"] + 1), x["start"], x["end"])), ",")
    base = short(F.col("base"))
    return ranked.select(
        *keep,
        *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(said(base), 256).alias("base_sha256"),
        said(F.concat(base, short(new))).alias("spans"),
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """A text with each span of ``spans`` (as scan() names them) replaced by a mark; spans that overlap are one, and a null text or null spans give null."""
    pairs = F.array_sort(F.transform(F.filter(F.split(spans, ","), lambda s: s != ""), lambda s: F.struct(F.split(s, ":")[1].cast("int").alias("start"), F.split(s, ":")[2].cast("int").alias("end"))))
    done = _running(F.transform(pairs, lambda s: s["end"]), F.lit(0), lambda at, end: F.greatest(at, end))
    characters = F.split(text, "")
    said = F.zip_with(pairs, done, lambda s, at: F.when(s["start"] >= at, F.concat(F.array_join(F.slice(characters, at + 1, s["start"] - at), ""), F.lit(mark))).otherwise(""))
    last = F.array_max(F.transform(pairs, lambda s: s["end"]))
    rest = F.array_join(F.slice(characters, last + 1, F.size(characters)), "")
    return F.when(spans == "", text).otherwise(F.concat(F.array_join(said, ""), rest))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
