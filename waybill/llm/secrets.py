"""Secrets in texts: fixed patterns, and strings that pass a randomness test battery.

Everything is built-in column functions.  Per text:

* ``assign``, ``access`` and ``hex`` spans come from their patterns, leftmost and
  without overlap per kind.
* ``random`` spans are runs of token characters of at least MIN_BITS bits under the
  encoding that their characters fit.  Three tests ask whether the characters look
  drawn evenly and independently from that encoding's alphabet: chi-squared of the
  character counts, runs about the alphabet's middle, and correlation of neighbours.
  Fisher's method joins the three p-values.  A string without a digit may be any
  encoding's by chance, or of letters alone: it is held against the letters and signs
  of the encodings it fits (LETTERS), in bands of its own.  As long words have such
  bands to themselves, a fourth test asks there whether the letters are the common ones
  of written language (LETTER_SHARES).

Whether a p-value is too small to call a string random depends on how many strings
were tried.  Benjamini and Hochberg's step-up rule is applied within each encoding
and length band over all strings of the corpus, so that a short string isn't judged
by the crowd of the long ones.  What it rejects is structure (words, counters, dates).
Spans count code points, the end is exclusive.  Null texts are empty.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm.store import only, stored

# The kinds, in the order in which equal starts are listed.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 6
ACCESS = r"AKIA[A-Z0-9]+"
ACCESS_LENGTH = 20
HEX = r"[0-9a-f]+"
HEX_LENGTH = 24

CANDIDATE_LENGTH = 16
CANDIDATE = r"[A-Za-z0-9+/_-]{%d,}={0,2}" % CANDIDATE_LENGTH
MIN_BITS = 80.0  # characters times the bits of each
LEVEL = 0.05  # share of random strings that the step-up rule may reject
P_STEPS = 20  # steps of a p-value's decimal exponent
P_LOWEST = 40 * P_STEPS

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# name, pattern of the characters without padding, alphabet; the first that fits counts
ENCODINGS = [
    ("decimal", "^[0-9]+$", DIGITS),
    ("hex", "^[0-9a-f]+$", DIGITS + LOWER[:6]),
    ("hex_upper", "^[0-9A-F]+$", DIGITS + UPPER[:6]),
    ("base32", "^[A-Z2-7]+$", UPPER + "234567"),
    ("base36", "^[0-9a-z]+$", DIGITS + LOWER),
    ("base36_upper", "^[0-9A-Z]+$", DIGITS + UPPER),
    ("base62", "^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    ("base64", "^[0-9A-Za-z+/]+$", UPPER + LOWER + DIGITS + "+/"),
    ("base64_url", "^[0-9A-Za-z_-]+$", UPPER + LOWER + DIGITS + "-_"),
]
# of strings without a digit, and the size of the encoding whose bits they have if none came by chance
LETTERS = [
    ("hex_letters", "^[a-f]+$", LOWER[:6], 16),
    ("hex_upper_letters", "^[A-F]+$", UPPER[:6], 16),
    ("upper", "^[A-Z]+$", UPPER, 32),
    ("lower", "^[a-z]+$", LOWER, 36),
    ("letters", "^[A-Za-z]+$", UPPER + LOWER, 62),
    ("base64_letters", "^[A-Za-z+/]+$", UPPER + LOWER + "+/", 64),
    ("base64_url_letters", "^[A-Za-z_-]+$", UPPER + LOWER + "-_", 64),
]
# per cent of a to z in English, German, French and Spanish texts, roughly
LETTER_SHARES = dict(zip(LOWER, [
    8.5, 1.6, 3.4, 4.6, 14.8, 1.3, 1.6, 3.1, 7.2, 0.4, 0.5, 4.4, 2.7, 7.9, 5.7, 2.2, 0.5, 6.6, 7.0, 6.9, 4.2, 1.2, 1.0, 0.2, 0.8, 0.6,
]))
ALPHABETS = [a for _, _, a in ENCODINGS] + [a for _, _, a, _ in LETTERS]
SIZES = [len(a) for _, _, a in ENCODINGS] + [n for _, _, _, n in LETTERS]


def _commonness(alphabet: str) -> list[float]:
    """Per character the logarithm of its share in texts, to mean 0 and variance 1; signs are rare."""
    logs = [math.log(LETTER_SHARES.get(c.lower(), LETTER_SHARES["z"])) for c in alphabet]
    mean = sum(logs) / len(logs)
    spread = math.sqrt(sum((x - mean) ** 2 for x in logs) / len(logs))
    return [(x - mean) / spread for x in logs]


COMMONNESS = [None] * len(ENCODINGS) + [_commonness(a) for _, _, a, _ in LETTERS]

SPAN = "struct<start:int,end:int,match:string,value:string>"


BLOCK = 256  # matches put in place together


def _let(value: Column, then) -> Column:
    """``then(value)``, with the value computed once."""
    return F.transform(F.array(value), then)[0]


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches with their places: what lies between them gives the distances.

    Places are sums of lengths, first within blocks of matches and then over blocks, as
    an array that grows match by match would be copied each time.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    between = F.split(text, pattern, -1)
    parts = F.arrays_zip(found.alias("match"), value.alias("value"), between.alias("between"))

    def step(acc: Column, part: Column) -> Column:
        start = acc["pos"] + F.length(part["between"])
        end = start + F.length(part["match"])
        span = F.struct(start.alias("start"), end.alias("end"), part["match"].alias("match"), part["value"].alias("value"))
        return F.struct(end.alias("pos"), F.concat(acc["out"], F.array(span)).alias("out"))

    begin = F.struct(F.lit(0).alias("pos"), F.array().cast(f"array<{SPAN}>").alias("out"))

    def blocks(rows: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int"))
        return F.transform(numbers, lambda i: F.aggregate(F.slice(rows, i * BLOCK + 1, F.lit(BLOCK)), begin, step))

    def together(made: Column) -> Column:
        starts = F.aggregate(
            made, F.struct(F.lit(0).alias("pos"), F.array().cast("array<int>").alias("out")),
            lambda acc, block: F.struct(
                (acc["pos"] + block["pos"]).alias("pos"), F.concat(acc["out"], F.array(acc["pos"])).alias("out")
            ),
            lambda acc: acc["out"],
        )
        return F.flatten(F.zip_with(made, starts, lambda block, start: F.transform(block["out"], lambda s: F.struct(
            (s["start"] + start).alias("start"), (s["end"] + start).alias("end"),
            s["match"].alias("match"), s["value"].alias("value"),
        ))))

    # what follows the last match has no match beside it
    matched = F.filter(parts, lambda p: p["match"].isNotNull())
    none = F.array().cast(f"array<{SPAN}>")
    return _let(matched, lambda rows: F.when(F.size(rows) > 0, _let(blocks(rows), together)).otherwise(none))


def _where(has: Column, spans: Column) -> Column:
    return F.when(has, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def _normal_tail(z: Column) -> Column:
    """P(N > z), by Abramowitz and Stegun 26.2.17; within 1e-7."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.exp(-a * a / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _chi_squared_tail(x: Column, mean: Column, variance: Column) -> Column:
    """Upper tail of a chi-squared-like statistic, by Wilson and Hilferty's cube root."""
    shape = 2 * mean * mean / variance  # degrees of freedom of the scaled statistic
    ratio = x / mean
    return _normal_tail((F.pow(ratio, F.lit(1 / 3)) - (1 - 2 / (9 * shape))) / F.sqrt(2 / (9 * shape)))


def _per_encoding(encoding: Column, values: list) -> Column:
    out = F.lit(None)
    for i, value in reversed(list(enumerate(values))):
        out = F.when(encoding == i, F.lit(value)).otherwise(out)
    return out


def _encoding(core: Column) -> Column:
    def first(patterns: list[str], begin: int) -> Column:
        out = F.lit(None).cast("int")
        for i, pattern in reversed(list(enumerate(patterns, begin))):
            out = F.when(core.rlike(pattern), F.lit(i)).otherwise(out)
        return out

    return F.when(core.rlike("[0-9]"), first([e[1] for e in ENCODINGS], 0)).otherwise(
        first([e[1] for e in LETTERS], len(ENCODINGS))
    )


def battery(spans: Column) -> Column:
    """Candidates that are long enough, with encoding, length band and joint p-value."""
    named = F.transform(
        spans,
        lambda s: F.struct(s["start"], s["end"], F.rtrim(s["match"], F.lit("=")).alias("core")),
    )
    coded = F.filter(
        F.transform(named, lambda s: F.struct(
            s["start"], s["end"], s["core"], _encoding(s["core"]).alias("encoding"),
        )),
        lambda s: s["encoding"].isNotNull(),
    )
    spelt = F.transform(coded, lambda s: F.struct(
        s["start"], s["end"], s["core"], s["encoding"], _per_encoding(s["encoding"], ALPHABETS).alias("alphabet"),
        F.length(s["core"]).cast("double").alias("n"),
    ))
    long_enough = F.filter(
        spelt, lambda s: s["n"] * _per_encoding(s["encoding"], [math.log2(n) for n in SIZES]) >= MIN_BITS
    )
    counted = F.transform(long_enough, lambda s: F.struct(
        s["start"], s["end"], s["encoding"], s["n"],
        F.length(s["alphabet"]).cast("double").alias("k"),
        F.aggregate(
            F.filter(F.split(s["alphabet"], ""), lambda c: c != ""), F.lit(0.0),
            lambda total, c: total + F.pow(s["n"] - F.length(F.replace(s["core"], c, F.lit(""))), F.lit(2.0)),
        ).alias("squares"),
        F.transform(
            F.filter(F.split(s["core"], ""), lambda c: c != ""),
            lambda c: (F.instr(s["alphabet"], c) - 1).cast("double"),
        ).alias("codes"),
    ))

    def walk(s: Column) -> Column:
        middle = (s["k"] - 1) / 2
        begin = F.struct(
            F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("changes"), F.lit(0.0).alias("products"),
        )

        def step(acc: Column, code: Column) -> Column:
            d = code - middle
            return F.struct(
                d.alias("last"),
                (acc["changes"] + F.when(acc["last"] * d < 0, 1.0).otherwise(0.0)).alias("changes"),
                (acc["products"] + F.coalesce(acc["last"] * d, F.lit(0.0))).alias("products"),
            )

        return F.aggregate(s["codes"], begin, step)

    def common(s: Column) -> Column:
        shares = _per_encoding(s["encoding"], COMMONNESS)
        return F.aggregate(s["codes"], F.lit(0.0), lambda total, code: total + F.get(shares, code.cast("int")))

    walked = F.transform(counted, lambda s: F.struct(
        s["start"], s["end"], s["encoding"], s["n"], s["k"], s["squares"], walk(s).alias("walk"),
        F.when(s["encoding"] >= len(ENCODINGS), common(s)).alias("common"),
    ))

    def values(s: Column) -> Column:
        n, k, pairs = s["n"], s["k"], s["n"] - 1
        even = _chi_squared_tail(k / n * s["squares"] - n, k - 1, 2 * (k - 1) * (1 - 1 / n))
        runs = 2 * _normal_tail(F.abs(s["walk"]["changes"] - pairs / 2) / F.sqrt(pairs / 4))
        serial = 2 * _normal_tail(F.abs(s["walk"]["products"]) / F.sqrt(pairs) / ((k * k - 1) / 12))
        floor = F.lit(1e-300)
        # 1 adds nothing: strings with digits have three tests
        letters = F.coalesce(_normal_tail(s["common"] / F.sqrt(n)), F.lit(1.0))
        return -sum((F.log(F.greatest(p, floor)) for p in (runs, serial, letters)), F.log(F.greatest(even, floor)))

    tested = F.transform(walked, lambda s: F.struct(
        s["start"], s["end"], s["encoding"], F.floor(2 * F.log2(s["n"])).cast("int").alias("band"), values(s).alias("half"),
    ))
    def joint(s: Column) -> Column:
        """Fisher: twice the sum of -log p is chi-squared with two degrees of freedom a test."""
        h = s["half"]
        fourth = F.when(s["encoding"] >= len(ENCODINGS), h * h * h / 6).otherwise(0.0)
        return h - F.log(1 + h + h * h / 2 + fourth)

    return F.transform(tested, lambda s: F.struct(
        s["start"], s["end"], s["encoding"], s["band"],
        F.least(
            F.lit(P_LOWEST),
            F.floor(P_STEPS / math.log(10) * joint(s)),
        ).cast("int").alias("step"),
    ))


def scan(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """Per row of ``docs``: columns ``keep`` as kept_0, kept_1, ..., base and candidate
    spans.  One pass, nothing shuffled."""
    only(docs, *keep, text)
    # renamed by place: any name may be a user's
    rows = docs.select(*keep, F.coalesce(F.col(text), F.lit(""))).toDF(*(f"kept_{i}" for i in range(len(keep))), "t")
    t = F.col("t")
    assign = F.filter(_matches(t, ASSIGN, 2), lambda s: F.length(s["value"]) >= ASSIGN_LENGTH)
    # runs of fixed classes: a too short one can't hide a longer one
    access = _matches(t, ACCESS[:-1] + "{%d,}" % (ACCESS_LENGTH - 4))
    hexes = _matches(t, HEX[:-1] + "{%d,}" % HEX_LENGTH)
    return rows.select(
        *(f"kept_{i}" for i in range(len(keep))),
        *(
            F.transform(_where(has, spans), lambda s: F.struct(s["start"], s["end"])).alias(f"found_{kind}")
            for kind, has, spans in (
                ("assign", t.rlike(ASSIGN), assign),
                ("access", F.contains(t, F.lit("AKIA")), access),
                ("hex", t.rlike("[0-9a-f]{%d}" % HEX_LENGTH), hexes),
            )
        ),
        battery(_where(t.rlike("[A-Za-z0-9+/_-]{%d}" % CANDIDATE_LENGTH), _matches(t, CANDIDATE))).alias("found_candidates"),
    )


def limits(scanned: DataFrame, level: float = LEVEL) -> DataFrame:
    """Per encoding and length band, the smallest p-value step that is rejected.

    At most (encodings x bands x steps) rows meet, whatever the corpus holds.
    """
    steps = (
        scanned.select(F.explode("found_candidates").alias("c")).groupBy("c.encoding", "c.band", "c.step").count()
    )
    band = Window.partitionBy("encoding", "band")
    ranked = steps.withColumn("upto", F.sum("count").over(band.orderBy(F.desc("step")))).withColumn(
        "tried", F.sum("count").over(band)
    )
    small = F.pow(F.lit(10.0), -F.col("step") / P_STEPS) <= level * F.col("upto") / F.col("tried")
    return ranked.filter(small).groupBy("encoding", "band").agg(F.min("step").alias("limit"))


STRETCH = 4096  # characters of a text that are looked at together


def _apart(spans: Column, others: Column) -> Column:
    """Those of the spans that touch none of the others, which are first sorted into stretches."""
    last = F.floor(F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"])), F.lit(0)) / STRETCH).cast("int")
    stretches = F.transform(F.sequence(F.lit(0), last), lambda i: F.filter(
        others, lambda o: (o["start"] < (i + 1) * STRETCH) & (o["end"] > i * STRETCH)
    ))

    def touches(lists: Column, s: Column) -> Column:
        first = F.floor(s["start"] / STRETCH).cast("int")
        many = F.floor((s["end"] - 1) / STRETCH).cast("int") - first + 1
        return F.exists(F.slice(lists, first + 1, many), lambda near: F.exists(
            near, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])
        ))

    return F.when(F.size(spans) > 0, _let(stretches, lambda lists: F.filter(spans, lambda s: ~touches(lists, s)))).otherwise(spans)


def find(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", level: float = LEVEL, keep: list[str] | None = None,
    spans: str = "spans",
) -> DataFrame:
    """Per row: doc_id and ``spans``, an array of (start, kind, end, name) by start and kind.

    Random spans that touch a base span are left out.  Rows with a null id or text
    stay (null texts are empty), and so do rows that repeat; an empty table gives none.
    ``keep`` names the columns to carry instead of doc_id, whatever they are called, but
    for one named as ``spans`` says.
    """
    keep = [doc_id] if keep is None else keep
    if spans in keep:
        raise ValueError(f"the table has a column {spans} already")
    scanned = stored(scan(docs, keep, text))
    # bounded: encodings x length bands
    found = {(r["encoding"], r["band"]): r["limit"] for r in limits(scanned, level).collect()}
    table = F.create_map(*[
        x for (e, b), limit in sorted(found.items()) for x in (F.lit(e * 1000 + b), F.lit(limit))
    ]) if found else F.create_map().cast("map<int,int>")

    def listed(kind: int, spans: Column) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end"), F.lit(KINDS[kind]).alias("name"),
        ))

    base = F.concat(*(listed(i, F.col(f"found_{k}")) for i, k in enumerate(KINDS[:3])))
    held = F.filter("found_candidates", lambda c: c["step"] < F.coalesce(
        F.try_element_at(table, c["encoding"] * 1000 + c["band"]), F.lit(P_LOWEST + 1)
    ))
    kept = [f"kept_{i}" for i in range(len(keep))]
    rows = scanned.select(*kept, base.alias("found_base"), held.alias("found_held"))
    apart = _apart(F.col("found_held"), F.col("found_base"))
    return rows.select(*kept, F.array_sort(F.concat("found_base", listed(3, apart)))).toDF(*keep, spans)


def as_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with every span replaced by ``mark``; overlapping spans become one mark.

    Every stretch of the text is masked by itself and then joined to the others.
    """
    def stretch(part: Column, i: Column) -> Column:
        first = i * STRETCH
        begin = F.struct(first.alias("pos"), F.lit("").alias("out"))

        def step(acc: Column, s: Column) -> Column:
            fresh = s["start"] >= acc["pos"]
            ahead = F.substring(part, acc["pos"] - first + 1, s["start"] - acc["pos"])
            return F.struct(
                F.greatest(acc["pos"], s["end"]).alias("pos"),
                F.concat(acc["out"], F.when(fresh, F.concat(ahead, F.lit(mark))).otherwise("")).alias("out"),
            )

        here = F.filter(spans, lambda s: (s["start"] < first + STRETCH) & (s["end"] > first))
        return F.aggregate(here, begin, step, lambda acc: F.concat(
            acc["out"], F.substring(part, acc["pos"] - first + 1, F.greatest(first + STRETCH - acc["pos"], F.lit(0)))
        ))

    parts = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % STRETCH), F.lit(0))
    return F.array_join(F.transform(parts, stretch), "")
