"""Secret scans: fixed patterns, and a battery of randomness tests for the rest.

DataFrame functions only. Three kinds of base spans come from patterns. The fourth
kind, ``random``, is found by testing: candidates are runs of key characters of at
least ``MIN_LENGTH`` that hold a letter or a digit. What base spans cover is cut out of
a run and each remaining piece is a candidate. A piece that mixes the marks of base64
and of base64url is taken apart twice, into its longest strings of either alphabet; a
key of any encoding lies whole in one of them. Each candidate
gets the smallest encoding whose alphabet holds it (digits, hex, letters, base32, base36, base62,
base64 or base64url; letters alone and letters with marks are classes of their own)
and three tests of the hypothesis "drawn uniformly from that alphabet":

* chi-squared over the alphabet's digits, marks and thirds of its letters
  (Wilson-Hilferty);
* runs: how often neighbours change between the lower and upper half;
* serial correlation of neighbouring values;

Fisher's method combines the three p-values. Over all documents, for each encoding and
length class, Benjamini-Hochberg at rate ``q`` decides which candidates are cleared
as not random; longer strings, on which the tests have more power, are thereby
judged among themselves. What cannot be cleared is a span, unless it is letters alone
and letters as frequent as in text explain it better than uniform ones (a long word). The decision needs only a
histogram of p-values per class (at most 12 x 6 x 401 rows), not the candidates.

Defined cases: null text counts as empty and has no spans; rows that repeat an id are
scanned each; an empty table gives an empty result; all other columns are kept out.
Positions are code points, ends exclusive; ties in start are ordered by kind.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import staged

ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LONG_HEX = r"[0-9a-f]{24,}"  # the same spans as HEX runs of 24 or more: a run is matched whole or not at all
KINDS = ["assign", "access", "hex", "random"]
MIN_LENGTH = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_LENGTH
BASE64 = r"[A-Za-z0-9+/]{%d,}={0,2}" % MIN_LENGTH
BASE64URL = r"[A-Za-z0-9_-]{%d,}={0,2}" % MIN_LENGTH
DIGITS, LOWER, UPPER = string.digits, string.ascii_lowercase, string.ascii_uppercase
#: letters by their frequency in text, so that the thirds of an alphabet tell words from keys
COMMON = "etaoinsrhldcumfpgwybvkxjqz"
#: how often each of them is, in per cent of the letters of English text (fixed values); rare ones count 0.5, for other languages
SHARES = [12.7, 9.1, 8.2, 7.5, 7.0, 6.7, 6.3, 6.0, 6.1, 4.0, 4.3, 2.8, 2.8, 2.4, 2.2, 1.9, 2.0, 2.4, 2.0, 1.5, 1.0, 0.8, 0.5, 0.5, 0.5, 0.5]
LETTERS_ALONE = ["lower", "upper", "letters", "letters64", "letters64url"]
#: encoding, pattern of its strings, alphabet in order of value
ENCODINGS = [
    ("digits", "^[0-9]+$", DIGITS),
    ("hex", "^[0-9a-f]+$", DIGITS + "abcdef"),
    ("hex", "^[0-9A-F]+$", DIGITS + "ABCDEF"),
    ("lower", "^[a-z]+$", COMMON),
    ("upper", "^[A-Z]+$", COMMON.upper()),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", "^[0-9a-z]+$", DIGITS + LOWER),
    ("base36", "^[0-9A-Z]+$", DIGITS + UPPER),
    ("letters", "^[A-Za-z]+$", COMMON + COMMON.upper()),
    ("letters64", "^[A-Za-z+/]+$", COMMON + COMMON.upper() + "+/"),
    ("letters64url", "^[A-Za-z_-]+$", COMMON + COMMON.upper() + "-_"),
    ("base62", "^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("base64", "^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", "^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
]
LENGTH_CLASSES = [24, 32, 40, 64, 128]  # lower bounds of classes 1 to 5
BINS = 400  # p-value bins: 10 per power of ten down to 1e-40
RATE = 0.001


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


#: Arrays are gone through in parts of so many elements, as adding to an array copies it: n spans cost n * STEP copies, not n * n.
STEP = 64


def _parts(items: Column) -> Column:
    """An array cut into arrays of ``STEP`` elements (none for an empty one)."""
    whole = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / STEP).cast("int")),
                        lambda i: F.slice(items, i * STEP + 1, F.lit(STEP)))
    return F.when(F.size(items) > 0, whole).otherwise(F.slice(whole, 1, 0))


def _running(numbers: Column, join) -> Column:
    """Running ``join`` (a sum, a maximum) of an array of non-negative bigints."""
    zero = F.lit(0).cast("bigint")

    def scan(part: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("seen"))
        return F.aggregate(part, start, lambda acc, x: _let(join(acc["at"], x), lambda now: F.struct(
            now.alias("at"), F.concat(acc["seen"], F.array(now)).alias("seen"))), lambda acc: acc["seen"])

    def whole(parts: Column) -> Column:
        totals = scan(F.transform(parts, lambda p: F.aggregate(p, zero, join)), zero)
        firsts = F.concat(F.array(zero), F.slice(totals, 1, F.size(totals) - 1))
        return F.flatten(F.zip_with(parts, firsts, scan))

    return F.when(F.size(numbers) > 0, _let(_parts(numbers), whole)).otherwise(numbers)


def _matches(text: Column, pattern: str) -> Column:
    """Spans of all matches: array<struct<start, end, value>>, leftmost and non-overlapping."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    held = F.struct(found.alias("found"), F.split(text, pattern, -1).alias("gaps"))

    def spans(h: Column) -> Column:
        widths = F.zip_with(F.slice(h["gaps"], F.lit(1), F.size(h["found"])), h["found"],
                            lambda gap, value: (F.length(gap) + F.length(value)).cast("bigint"))
        ends = _running(widths, lambda a, b: a + b)
        return F.zip_with(ends, h["found"], lambda end, value: F.struct(
            (end - F.length(value)).alias("start"), end.alias("end"), value.alias("value")))

    return _let(held, spans)


def _as_kind(spans: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))


def _when_found(text: Column, test: str, pattern: str) -> Column:
    """Matches, but only where a cheaper test holds; most texts have none."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return F.when(text.rlike(test), _matches(text, pattern)).otherwise(empty)


def _piece(start: Column, end: Column, value: Column) -> Column:
    return F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), value.alias("value"))


def _uncovered(run: Column, base: Column) -> Column:
    """The pieces of a run that no base span covers; ``base``: spans sorted by start, as from ``_spanned``."""
    empty = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def up_to(acc: Column, end: Column) -> Column:
        value = F.substring(run["value"], (acc["at"] - run["start"] + 1).cast("int"), (end - acc["at"]).cast("int"))
        return F.when(end > acc["at"], F.concat(acc["pieces"], F.array(_piece(acc["at"], end, value)))).otherwise(acc["pieces"])

    def step(acc: Column, span: Column) -> Column:
        return F.struct(F.greatest(acc["at"], span["end"]).alias("at"), up_to(acc, span["start"]).alias("pieces"))

    near = F.filter(base, lambda part: (part["low"] < run["end"]) & (run["start"] < part["high"]))
    met = F.filter(F.flatten(F.transform(near, lambda part: part["spans"])), lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    start = F.struct(run["start"].alias("at"), empty.alias("pieces"))
    return _let(met, lambda met: F.when(F.size(met) > 0, F.aggregate(met, start, step, lambda acc: up_to(acc, run["end"]))).otherwise(F.array(run)))


def _spanned(base: Column) -> Column:
    """Sorted spans in parts, each with its least start and greatest end."""
    return F.transform(_parts(base), lambda p: F.struct(
        p[0]["start"].alias("low"), F.array_max(F.transform(p, lambda s: s["end"])).alias("high"), p.alias("spans")))


def _one_alphabet(piece: Column) -> Column:
    """The piece, or if it mixes both kinds of marks its longest strings of either alphabet."""
    value = piece["value"]
    found = F.concat(_matches(value, BASE64), _matches(value, BASE64URL))
    parts = F.transform(found, lambda m: _piece(piece["start"] + m["start"], piece["start"] + m["end"], m["value"]))
    return F.when(value.rlike("[+/]") & value.rlike("[_-]"), parts).otherwise(F.array(piece))


def _candidates(runs: Column, base: Column) -> Column:
    pieces = _let(_spanned(base), lambda spanned: F.flatten(F.transform(runs, lambda r: _uncovered(r, spanned))))
    parts = F.flatten(F.transform(pieces, _one_alphabet))
    return F.filter(parts, lambda c: (F.length(F.rtrim(c["value"], F.lit("="))) >= MIN_LENGTH) & c["value"].rlike("[0-9A-Za-z]"))


# --- the battery ------------------------------------------------------------

def _normal_tail(z: Column) -> Column:
    """Two-sided p-value of |z| (Abramowitz and Stegun 7.1.26 for the error function)."""

    def tail(x: Column) -> Column:
        poly = lambda t: t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
        return F.greatest(_let(1 / (1 + 0.3275911 * x), poly) * F.exp(-x * x), F.lit(1e-40))

    return _let(F.abs(z) / math.sqrt(2), tail)


def _chi_squared_p(stat: Column, degrees: Column) -> Column:
    k = 2 / (9 * degrees)
    z = (F.pow(stat / degrees, F.lit(1 / 3)) - (1 - k)) / F.sqrt(k)
    return _let(z, lambda z: F.when(z > 0, _normal_tail(z) / 2).otherwise(1 - _normal_tail(z) / 2))


def _fisher(ps: list[Column]) -> Column:
    """-2 sum ln p is chi-squared with 6 degrees of freedom, whose upper tail is a closed form."""
    total = -sum((F.log(F.greatest(p, F.lit(1e-40))) for p in ps), F.lit(0.0))
    return _let(total, lambda x: F.exp(-x) * (1 + x + x * x / 2))


def _ranges(alphabet: str) -> list[int]:
    """Cuts of an alphabet: digits and marks are a range each, letters of one case or digits alone three."""
    kind = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "m" for c in alphabet]
    cuts = [0]
    for k in dict.fromkeys(kind):
        n = kind.count(k)
        parts = 3 if k in "ul" and n > 10 or n == len(alphabet) else 1
        cuts += [kind.index(k) + n * (i + 1) // parts for i in range(parts)]
    return cuts


def _encoding(core: Column) -> Column:
    """struct<name, alphabet, cuts> of the smallest alphabet that holds the string, else null."""
    found = None
    for name, pattern, alphabet in ENCODINGS:
        made = F.struct(F.lit(name).alias("name"), F.lit(alphabet).alias("alphabet"), F.array(*map(F.lit, _ranges(alphabet))).alias("cuts"))
        found = F.when(core.rlike(pattern), made) if found is None else found.when(core.rlike(pattern), made)
    return found


def battery(value: Column) -> Column:
    """struct<encoding, n, words, chi_p, runs_p, serial_p, p> of a candidate; null without an encoding."""
    core = F.rtrim(value, F.lit("="))
    values = lambda c: F.transform(F.split(c["core"], ""), lambda x: F.instr(c["e"]["alphabet"], x) - 1)
    held = _let(F.struct(core.alias("core"), _encoding(core).alias("e")), lambda c: F.struct(
        c["e"].alias("e"), values(c).alias("v"), F.length(c["core"]).alias("n"), F.length(c["e"]["alphabet"]).alias("k")))
    return _let(held, lambda h: F.when(h["e"].isNotNull(), _tests(h)))


def _tests(h: Column) -> Column:
    n, k, v = h["n"], h["k"], h["v"]
    cuts = h["e"]["cuts"]
    ranges = F.zip_with(F.slice(cuts, F.lit(1), F.size(cuts) - 1), F.slice(cuts, F.lit(2), F.size(cuts) - 1), lambda a, b: F.struct(
        F.size(F.filter(v, lambda x: (x >= a) & (x < b))).alias("seen"), (n * (b - a) / k).alias("expected")))
    chi = F.aggregate(ranges, F.lit(0.0), lambda a, r: a + F.pow(r["seen"] - r["expected"], F.lit(2.0)) / r["expected"])
    pairs = F.zip_with(F.slice(v, F.lit(1), n - 1), F.slice(v, F.lit(2), n - 1),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    changes = F.size(F.filter(pairs, lambda p: (p["a"] * 2 < k) != (p["b"] * 2 < k)))
    runs_z = (changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
    product = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + (p["a"] - (k - 1) / 2) * (p["b"] - (k - 1) / 2))
    serial_z = product / ((k * k - 1) / 12 * F.sqrt(n - 1))
    made = F.struct(_chi_squared_p(chi, F.size(cuts) - 2).alias("chi_p"), _normal_tail(runs_z).alias("runs_p"),
                    _normal_tail(serial_z).alias("serial_p"))
    return _let(made, lambda t: F.struct(
        h["e"]["name"].alias("encoding"), n.alias("n"), _like_words(h).alias("words"), t["chi_p"].alias("chi_p"), t["runs_p"].alias("runs_p"),
        t["serial_p"].alias("serial_p"), _fisher([t["chi_p"], t["runs_p"], t["serial_p"]]).alias("p")))


def _like_words(h: Column) -> Column:
    """Are letters drawn as in text likelier to give the string than letters drawn uniformly? Asked of letters alone."""
    weights = F.array(*[F.lit(math.log(0.26 * x)) for x in SHARES])
    ratio = F.aggregate(h["v"], F.lit(0.0), lambda a, v: a + F.when(v < 2 * len(SHARES), F.get(weights, v % len(SHARES))).otherwise(0.0))
    return h["e"]["name"].isin(LETTERS_ALONE) & (ratio > 0)


def _length_class(n: Column) -> Column:
    return sum(((n >= low).cast("int") for low in LENGTH_CLASSES), F.lit(0))


def _bin(p: Column) -> Column:
    return F.least(F.lit(BINS), F.floor(-10 * F.log10(F.greatest(p, F.lit(1e-40))))).cast("int")


def cleared_bins(candidates: DataFrame, q: float = RATE) -> DataFrame:
    """(encoding, length_class, first_bin): candidates in that bin of p-values or beyond are not random.

    Benjamini-Hochberg on the histogram: a bin is cleared if its largest p-value is at most
    q times the share of candidates with p-values that small.
    """
    histogram = candidates.groupBy("encoding", "length_class", "bin").agg(F.count("*").alias("n"))
    group = Window.partitionBy("encoding", "length_class")
    smaller = group.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    ranked = histogram.select("*", F.sum("n").over(smaller).alias("rank"), F.sum("n").over(group).alias("m"))
    return (ranked.where(F.pow(F.lit(10.0), -F.col("bin") / 10) <= q * F.col("rank") / F.col("m"))
            .groupBy("encoding", "length_class").agg(F.min("bin").alias("first_bin")))


def _cleared(c: Column, limits: list[Column]) -> Column:
    if not limits:
        return F.lit(False)
    return F.exists(F.array(*limits), lambda x: (x["encoding"] == c["encoding"])
                    & (x["length_class"] == c["length_class"]) & (c["bin"] >= x["first_bin"]))


# --- the operator -----------------------------------------------------------

def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = RATE,
         keep: list[str] | None = None) -> DataFrame:
    """(id, spans array<struct<start, rank, end>>) per row, sorted; ``keep``: columns to carry along."""
    keep = keep or []
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("id"), F.struct(*(keep or [F.lit(0).alias("_")])).alias("kept"),
        F.filter(_when_found(text, r"(?i:passw|secret|token|api_?key)", ASSIGN),
                 lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= 6).alias("assign"),
        F.filter(_when_found(text, "AKIA[A-Z0-9]{16}", ACCESS), lambda s: s["end"] - s["start"] >= 20).alias("access"),
        _when_found(text, LONG_HEX, LONG_HEX).alias("hex"),
        _when_found(text, CANDIDATE, CANDIDATE).alias("candidates"))
    spans = base.select("id", "kept", F.array_sort(F.concat(*[_as_kind(F.col(k), k) for k in KINDS[:3]])).alias("base"), "candidates")
    tested = F.transform(_candidates(F.col("candidates"), F.col("base")), lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), battery(c["value"]).alias("t")))
    judged = F.transform(F.filter(tested, lambda c: c["t"].isNotNull()), lambda c: F.struct(
        c["start"].alias("start"), c["end"].alias("end"), c["t"]["encoding"].alias("encoding"),
        _length_class(c["t"]["n"]).alias("length_class"), _bin(c["t"]["p"]).alias("bin"),
        c["t"]["words"].alias("words")))
    # One pass over the texts; what follows reads the spans only.
    found = staged(spans.select("id", "kept", "base", judged.alias("candidates")), "secret-spans")
    limits = cleared_bins(found.select(F.inline("candidates")), q)
    # at most one row per encoding and length class
    limits = [F.struct(*(F.lit(x).alias(n) for n, x in row.asDict().items())) for row in limits.collect()]
    random = F.filter("candidates", lambda c: ~c["words"] & ~_cleared(c, limits))
    return found.select("id", "kept", F.array_sort(F.concat("base", _as_kind(random, "random"))).alias("spans"))


def span_text(spans: Column) -> Column:
    kind = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kind, s["rank"] + 1), s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced by ``mark``; overlapping spans count as one."""
    def part(pair: Column) -> Column:
        """One part of the spans, with the text from where the part before ended."""
        first, last = pair["at"], F.greatest(pair["at"], F.array_max(F.transform(pair["spans"], lambda s: s["end"])))
        here = F.substring(text, (first + 1).cast("int"), (last - first).cast("int"))

        def pieces(here: Column) -> Column:
            start = F.struct(F.lit("").alias("out"), first.alias("at"))

            def step(acc: Column, s: Column) -> Column:
                before = F.substring(here, (acc["at"] - first + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
                joined = F.when(s["start"] >= acc["at"], F.concat(acc["out"], before, F.lit(mark))).otherwise(acc["out"])
                return F.struct(joined.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

            return F.aggregate(pair["spans"], start, step, lambda acc: acc["out"])

        return _let(here, pieces)

    def whole(parts: Column) -> Column:
        ends = _running(F.transform(parts, lambda p: F.array_max(F.transform(p, lambda s: s["end"]))), lambda a, b: F.greatest(a, b))
        starts = F.concat(F.array(F.lit(0).cast("bigint")), F.slice(ends, 1, F.size(ends) - 1))
        pairs = F.zip_with(starts, parts, lambda at, spans: F.struct(at.alias("at"), spans.alias("spans")))
        rest = F.substring(text, (F.element_at(ends, -1) + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(F.transform(pairs, part), ""), rest)

    return F.when(F.size(spans) > 0, _let(_parts(spans), whole)).otherwise(text)
