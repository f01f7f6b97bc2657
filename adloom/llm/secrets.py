"""Secrets in text, in SQL expressions only.

Three kinds follow from their form: a value assigned to a telling name, an access key and a
long hexadecimal run. A battery of randomness tests adds a fourth: long tokens in an inferred
encoding whose symbols look drawn at random. Uniformity over the alphabet is tested by
chi-squared, independence by the runs about the middle of the alphabet and by the serial
correlation of neighbours; the smallest of the three p-values, times three, is the token's.
Over all documents, tokens of like length and encoding are tested together: those whose
randomness is rejected at a false-discovery rate of ``FDR`` (Benjamini-Hochberg) are ordinary
text, the others are secrets. A length at which ordinary text would not be told from random
symbols is not judged at all.

An encoding needs its symbol classes: hexadecimal digits and letters; base 32 capitals and
digits; base 64 (or its URL form) capitals, small letters and digits. Digits alone are
numbers, letters alone words. Tokens that meet a span of the first three kinds are theirs.

Positions count code points, ends are exclusive. A null text is empty. Null or repeated ids
keep their rows. An empty table gives no rows; other columns are carried only where asked for.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adloom.llm.common import staged

# The forms of the first three kinds and the least lengths.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGNED_CHARS = 8
KINDS = ("assign", "access", "hex", "random")

FDR = 0.01
TEXT_COINCIDENCE = 0.065  # chance that two letters of ordinary prose are the same
POWER = 4.0  # standard deviations that ordinary text must lie from random symbols
STEPS = 20  # p-values are told apart to a twentieth of a power of ten
MAX_STEP = 300 * STEPS
CUT = 256  # values that one array is grown to
PIECE = 4096  # code points in which a text to be redacted is cut

_DIGITS, _SMALL = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": _SMALL.upper() + "234567",
    "base64": _SMALL.upper() + _SMALL + _DIGITS + "+/",
    "base64url": _SMALL.upper() + _SMALL + _DIGITS + "-_",
}
_FORMS = {
    "hex": r"^(?=.*[0-9])(?=.*[a-f])[0-9a-f]+$",
    "HEX": r"^(?=.*[0-9])(?=.*[A-F])[0-9A-F]+$",
    "base32": r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+$",
    "base64": r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/]+$",
    "base64url": r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9_-]+$",
}

def least_length(symbols: int) -> int:
    """Shortest token at which ordinary text lies ``POWER`` deviations from random symbols."""
    share = max(TEXT_COINCIDENCE, 3 / symbols)  # text in few symbols repeats them more
    n = 2
    while True:
        excess = symbols * (1 + (n - 1) * share) - n - (symbols - 1)
        if excess >= POWER * math.sqrt(2 * (symbols - 1) * (n - 1) / n):
            return n
        n += 1


LEAST = {name: least_length(len(alphabet)) for name, alphabet in ALPHABETS.items()}
TOKEN_CHARS = min(LEAST.values())
# A whole run of symbols; every encoding needs a digit.
TOKEN = (
    rf"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{{{TOKEN_CHARS},}}"
)


SPAN = "array<struct<at:bigint,kind:int,until:bigint>>"
FOUND = "array<struct<at:bigint,until:bigint,text:string>>"
_LOW, _HIGH = -(1 << 62), 1 << 62


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, not once an element of what body walks."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(values: Column, first: Column, together: Callable[[Column, Column], Column]) -> Column:
    """Per value what all values before it come to, starting with ``first``.

    Arrays grow by copying, so values are taken in cuts of ``CUT``: what comes before each
    cut first, then what comes before each value of a cut. ``first`` must change nothing."""

    def scan(part: Column, start: Column) -> Column:
        none = F.slice(F.array(first), F.lit(1), F.lit(0))
        return F.aggregate(
            part,
            F.struct(start.alias("sum"), none.alias("before")),
            lambda done, x: F.struct(
                together(done["sum"], x).alias("sum"),
                F.concat(done["before"], F.array(done["sum"])).alias("before"),
            ),
            lambda done: done["before"],
        )

    def in_cuts(all_values: Column) -> Column:
        cuts = F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_values) - 1) / CUT).cast("int")),
            lambda i: F.slice(all_values, i * CUT + 1, F.lit(CUT)),
        )

        def joined(parts: Column) -> Column:
            sums = F.transform(parts, lambda part: F.aggregate(part, first, lambda x, y: together(x, y)))
            return F.flatten(F.zip_with(parts, scan(sums, first), scan))

        return _let(cuts, joined)

    return F.when(F.size(values) == 0, F.slice(F.array(first), F.lit(1), F.lit(0))).otherwise(
        _let(values, in_cuts)
    )


def matches(text: Column, pattern: str) -> Column:
    """All matches, leftmost first and not overlapping, with their places. What lies between
    matches is what splitting leaves; places are the lengths summed up."""
    pairs = F.zip_with(
        F.split(text, pattern, -1),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, match: F.struct(
            F.char_length(gap).cast("bigint").alias("gap"),
            F.coalesce(F.char_length(match), F.lit(0)).cast("bigint").alias("size"),
            match.alias("text"),
        ),
    )

    def placed(pairs: Column) -> Column:
        sizes = F.transform(pairs, lambda p: p["gap"] + p["size"])
        before = _running(sizes, F.lit(0).cast("bigint"), lambda x, y: x + y)
        spans = F.zip_with(
            pairs,
            before,
            lambda p, start: F.struct(
                (start + p["gap"]).alias("at"),
                (start + p["gap"] + p["size"]).alias("until"),
                p["text"].alias("text"),
            ),
        )
        return F.filter(spans, lambda m: m["text"].isNotNull()).cast(FOUND)

    return F.when(text.rlike(pattern), _let(pairs, placed)).otherwise(F.array().cast(FOUND))


def _as_spans(found: Column, kind: str) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(
            m["at"].alias("at"), F.lit(KINDS.index(kind)).alias("kind"), m["until"].alias("until")
        ),
    )


def base_spans(text: Column) -> Column:
    """Spans of the first three kinds, in order."""
    assigned = F.filter(
        matches(text, ASSIGN),
        lambda m: F.char_length(F.regexp_extract(m["text"], ASSIGN, 2)) >= ASSIGNED_CHARS,
    )
    return F.array_sort(
        F.concat(
            _as_spans(assigned, "assign"),
            _as_spans(matches(text, ACCESS), "access"),
            _as_spans(matches(text, HEX), "hex"),
        )
    ).cast(SPAN)


def _tail(z: Column) -> Column:
    """Chance of a standard normal beyond |z|, both ways, as its common logarithm negated.
    By the asymptotic series' first term it stays finite where the chance underflows."""
    a = F.abs(z)
    # Mills' ratio, bounded above and below by a common closed form
    ratio = F.lit(2.0) / (a + F.sqrt(a * a + F.lit(8 / math.pi)))
    log_p = -a * a / 2 + F.log(ratio * math.sqrt(2 / math.pi))
    return -log_p / math.log(10)


def _test(symbols_of: Column, alphabet: str) -> Column:
    """Evidence against randomness: -log10 of the battery's p-value."""
    k = len(alphabet)
    n = F.size(symbols_of).cast("double")
    counts = F.aggregate(
        F.transform(
            F.sequence(F.lit(1), F.lit(k)),
            lambda s: F.size(F.filter(symbols_of, lambda x: x == s)).cast("double"),
        ),
        F.lit(0.0),
        lambda total, c: total + c * c,
    )
    chi = counts * k / n - n
    # Wilson and Hilferty: the cube root of chi-squared over its degrees is near normal
    d = k - 1
    z_chi = (F.cbrt(chi / d) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d))
    left = F.slice(symbols_of, F.lit(1), F.size(symbols_of) - 1)
    right = F.slice(symbols_of, F.lit(2), F.size(symbols_of) - 1)
    middle = (k + 1) / 2
    high = F.size(F.filter(symbols_of, lambda x: x > middle)).cast("double")
    changes = F.aggregate(
        F.zip_with(left, right, lambda a, b: ((a > middle) != (b > middle)).cast("double")),
        F.lit(0.0),
        lambda total, c: total + c,
    )
    mean = 2 * high * (n - high) / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    z_runs = F.when(spread > 0, (changes + 1 - mean) / F.sqrt(spread)).otherwise(F.sqrt(n))
    average, variance = (k + 1) / 2, (k * k - 1) / 12
    products = F.aggregate(
        F.zip_with(left, right, lambda a, b: (a - average) * (b - average)),
        F.lit(0.0),
        lambda total, c: total + c,
    )
    z_serial = products / (variance * F.sqrt(n - 1))
    best = F.greatest(
        F.when(z_chi > 0, _tail(z_chi)).otherwise(F.lit(0.0)), _tail(z_runs), _tail(z_serial)
    )
    return F.greatest(best - math.log10(3), F.lit(0.0))


def _evidence(symbols: Column, alphabet: str) -> Column:
    return _let(symbols, lambda x: _test(x, alphabet))


def _symbols(text: Column, alphabet: str) -> Column:
    """The place of each letter in the alphabet, from 1."""
    letters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.transform(letters, lambda c: F.instr(F.lit(alphabet), c))


def _tested(token: Column) -> Column:
    """(at, until, group, against) of a token; null where no encoding is inferred."""
    size = F.char_length(token["text"])
    group, against = F.lit(None).cast("string"), F.lit(None).cast("double")
    for name in reversed(ALPHABETS):
        alphabet = ALPHABETS[name]
        symbols = _symbols(token["text"], alphabet)
        fits = token["text"].rlike(_FORMS[name]) & (size >= LEAST[name])
        length = F.floor(F.log2(size) * 2).cast("string")
        group = F.when(fits, F.concat(F.lit(f"{name}:"), length)).otherwise(group)
        against = F.when(fits, _evidence(symbols, alphabet)).otherwise(against)
    step = F.least(F.floor(against * STEPS), F.lit(MAX_STEP)).cast("int")
    return F.struct(
        token["at"].alias("at"), token["until"].alias("until"), group.alias("group"), step.alias("step")
    )


def _apart(tokens: Column, base: Column) -> Column:
    """Tokens that meet no base span. Both are put in one order: a token meets a span where
    one before it ends behind the token's start, or the next one starts before its end."""
    text = F.lit(None).cast("string")
    events = F.array_sort(
        F.concat(
            F.transform(base, lambda b: F.struct(b["at"], b["until"], text.alias("text"))).cast(FOUND),
            tokens,
        )
    )

    def judged(events: Column) -> Column:
        ends = F.transform(events, lambda e: F.when(e["text"].isNull(), e["until"]).otherwise(F.lit(_LOW)))
        starts = F.transform(
            F.reverse(events), lambda e: F.when(e["text"].isNull(), e["at"]).otherwise(F.lit(_HIGH))
        )
        behind = _running(ends, F.lit(_LOW), F.greatest)
        ahead = F.reverse(_running(starts, F.lit(_HIGH), F.least))
        limits = F.zip_with(behind, ahead, lambda x, y: F.struct(x.alias("behind"), y.alias("ahead")))
        free = F.zip_with(
            events,
            limits,
            lambda e, near: F.when(
                (near["behind"] <= e["at"]) & (near["ahead"] >= e["until"]) & e["text"].isNotNull(), e
            ),
        )
        return F.filter(free, lambda e: e.isNotNull())

    return F.when((F.size(base) == 0) | (F.size(tokens) == 0), tokens).otherwise(_let(events, judged))


def with_findings(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """One pass over the texts: the columns to carry, base spans, and tested tokens."""
    rows = docs.select(*dict.fromkeys([*carry, "text"])).withColumn(
        "_text", F.coalesce("text", F.lit(""))
    )
    return (
        rows.withColumn("_base", base_spans(F.col("_text")))
        .withColumn("_tokens", matches(F.col("_text"), TOKEN))
        .withColumn("_free", _apart(F.col("_tokens"), F.col("_base")))
        .withColumn(
            "_tested", F.filter(F.transform("_free", _tested), lambda t: t["group"].isNotNull())
        )
        .select(*carry, "_base", "_tested")
    )


def text_thresholds(findings: DataFrame, fdr: float = FDR) -> dict[str, int]:
    """Per group of like tokens, the step of evidence from which randomness is rejected.
    Tokens are counted by group and step before anything is ordered."""
    counts = (
        findings.select(F.explode("_tested").alias("_t"))
        .groupBy(F.col("_t.group").alias("group"), F.col("_t.step").alias("step"))
        .count()
    )
    stronger = Window.partitionBy("group").orderBy(F.desc("step"))
    ranked = counts.withColumn("rank", F.sum("count").over(stronger)).withColumn(
        "all", F.sum("count").over(Window.partitionBy("group"))
    )
    passed = ranked.where(F.pow(F.lit(10.0), -F.col("step") / STEPS) <= fdr * F.col("rank") / F.col("all"))
    return {r["group"]: r["step"] for r in passed.groupBy("group").agg(F.min("step").alias("step")).collect()}


def _random_spans(thresholds: dict[str, int]) -> Column:
    """Tested tokens whose randomness stands."""
    cut = F.lit(MAX_STEP + 1)
    if thresholds:
        pairs = [F.lit(x) for pair in sorted(thresholds.items()) for x in pair]
        limits = F.create_map(*pairs)

        def limit(group: Column) -> Column:
            return F.coalesce(F.try_element_at(limits, group), cut)

    else:

        def limit(group: Column) -> Column:
            return cut

    kept = F.filter("_tested", lambda t: t["step"] < limit(t["group"]))
    return F.transform(
        kept,
        lambda t: F.struct(
            t["at"].alias("at"), F.lit(KINDS.index("random")).alias("kind"), t["until"].alias("until")
        ),
    ).cast(SPAN)


def find_secrets(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns to carry, ``base`` spans and all ``spans``, in order."""
    findings = staged(with_findings(docs, carry), "secret-findings")
    added = _random_spans(text_thresholds(findings))
    return findings.select(
        *carry,
        F.col("_base").alias("base"),
        F.array_sort(F.concat("_base", added)).alias("spans"),
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(
        ",",
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["at"].cast("string"), s["until"].cast("string")
            ),
        ),
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced by a mark. The text is
    cut into pieces once, so that a span costs its own pieces and not the whole text."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))

    def between(pieces: Column, start: Column, end: Column) -> Column:
        first = F.floor(start / PIECE).cast("int")
        count = F.floor(end / PIECE).cast("int") - first + 1
        near = F.array_join(F.slice(pieces, first + 1, count), "")
        return F.substring(near, (start - F.lit(PIECE) * first + 1).cast("int"), (end - start).cast("int"))

    def cleaned(bound: Column) -> Column:
        whole, found = bound["pieces"], bound["spans"]
        ends = F.transform(found, lambda s: s["until"])
        before = _running(ends, F.lit(0).cast("bigint"), F.greatest)
        plain = F.zip_with(
            found,
            before,
            lambda s, end: F.when(
                (s["at"] >= end) | (end == 0), F.concat(between(whole, end, s["at"]), F.lit(mark))
            ),
        )
        last = F.array(between(whole, F.array_max(ends), F.char_length(text).cast("bigint")))
        return F.array_join(F.concat(plain, last), "")

    bound = F.struct(pieces.alias("pieces"), spans.alias("spans"))
    return F.when(F.size(spans) == 0, text).otherwise(_let(bound, cleaned))
