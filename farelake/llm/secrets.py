"""Secret scan: fixed patterns, and windows of high entropy in candidate strings.

Spans are code points, end exclusive. Fixed kinds are ``assign``, ``access`` and
``hex``. The kind ``entropy`` comes from candidates: runs of ``CANDIDATE`` letters
of at least one window. Each candidate has a character class: hex digits, letters
of one case with digits, or mixed. A window of ``WINDOW`` letters slides over it;
the sum of k log2 k over the counts k of its letters changes by the letter that
comes and the one that goes, whose counts are all that is looked up. Shannon
entropy is high where that sum is low. The span goes from the first window over
the threshold of its class to the end of the last. Candidates that look like known
harmless strings are suppressed, and so are spans inside a span of a fixed kind.

The sums are whole millionths, so they are equal in any order. Everything is
built-in functions, and no row moves.

Null texts are empty texts; texts and candidates of any length are scanned whole.
Repeated rows get equal results.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The kinds and their patterns, in order.
KINDS = ("assign", "access", "hex", "entropy")
NAMES = ("password", "passwd", "secret", "token", "api_?key")
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
ASSIGNED = "[A-Za-z0-9+/_.=-]+"
LEAST_ASSIGNED = 6

WINDOW = 20
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{WINDOW},}}"
#: Bits per letter that a window needs, by class. A random window of 20 has about 3.4 hex,
#: 3.9 of one case with digits and 4.1 mixed.
LEAST_BITS = {"hex": 3.1, "single": 3.6, "mixed": 3.75}
#: Harmless: no digit, digits only, UUIDs, alphabets, stated examples, hashes of files.
ALLOWED = (
    r"^[^0-9]*$|^[0-9_=+/-]*$"
    r"|^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$"
    r"|[Aa][Bb][Cc][Dd][Ee][Ff][Gg]|0123456789|EXAMPLE|[Ee]xample|^sha(256|384|512)-"
)


def any_case(name: str) -> str:
    """Pattern for a name with its letters in either case, ASCII only."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)


ASSIGN = (
    "(" + "|".join(map(any_case, NAMES)) + ")[\"']?\\x20*[:=]\\x20*[\"']?(" + ASSIGNED + ")"
)


def weight(count: int) -> int:
    """k log2 k in millionths."""
    return round(count * math.log2(count) * 1e6) if count else 0


def most_weight(bits: float) -> int:
    """The largest sum of weights of a window with at least ``bits`` of entropy."""
    return math.floor(WINDOW * (math.log2(WINDOW) - bits) * 1e6)


_SPANS = "array<struct<start:int,kind:int,end:int,found:string>>"
#: Steps that share one growing array; no step copies more than so many earlier results.
_CHUNK = 128


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value made once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _running(values: Column, join: Callable[[Column, Column], Column], least: int) -> Column:
    """For each value, all values before it joined, ``least`` for the first.

    Made chunk by chunk, then chunks are joined the same way, so the time follows the number
    of values.
    """

    def before(part: Column) -> Column:
        empty = F.struct(
            F.lit(least).alias("at"), F.array().cast("array<int>").alias("out")
        )
        return F.aggregate(
            part,
            empty,
            lambda state, value: F.struct(
                join(state["at"], value).cast("int").alias("at"),
                F.concat(state["out"], F.array(state["at"])).alias("out"),
            ),
        )

    def chunks(all_: Column) -> Column:
        last = F.floor(F.greatest(F.size(all_) - 1, F.lit(0)) / _CHUNK).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last), lambda i: before(F.slice(all_, i * _CHUNK + 1, _CHUNK))
        )

    def joined(parts: Column) -> Column:
        ends = before(F.transform(parts, lambda part: part["at"]))["out"]
        return F.flatten(
            F.zip_with(
                parts, ends, lambda part, end: F.transform(part["out"], lambda x: join(end, x))
            )
        )

    return _once(values, lambda all_: _once(chunks(all_), joined))


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost matches that don't overlap, as structs; the places follow from the
    lengths of what lies between them."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    items = F.zip_with(
        between, found, lambda gap, m: F.struct(F.char_length(gap).alias("gap"), m.alias("m"))
    )

    def span(item: Column, before: Column) -> Column:
        start = before + item["gap"]
        return F.struct(
            start.alias("start"),
            F.lit(kind).alias("kind"),
            (start + F.char_length(item["m"])).alias("end"),
            item["m"].alias("found"),
        )

    def spans(items: Column) -> Column:
        lengths = F.transform(
            items, lambda i: (i["gap"] + F.coalesce(F.char_length(i["m"]), F.lit(0))).cast("int")
        )
        placed = F.zip_with(items, _running(lengths, lambda a, b: a + b, 0), span)
        return F.filter(placed, lambda s: s["found"].isNotNull())

    return _once(items, spans).cast(_SPANS)


def _outside(base: Column, made: Column) -> Column:
    """``base`` and those of ``made`` that lie in no span of it, sorted.

    By start, a span lies in an earlier one if the greatest end so far reaches its own.
    """

    def kept(spans: Column) -> Column:
        ends = F.transform(
            spans, lambda s: F.when(s["kind"] < len(KINDS) - 1, s["end"]).otherwise(-1)
        )
        both = F.zip_with(
            spans, _running(ends, F.greatest, -1), lambda s, e: F.struct(s.alias("s"), e.alias("e"))
        )
        free = F.filter(both, lambda x: (x["s"]["kind"] < len(KINDS) - 1) | (x["e"] < x["s"]["end"]))
        return F.transform(free, lambda x: x["s"])

    return _once(F.array_sort(F.concat(base, made)), kept).cast(_SPANS)


def _where(condition: Column, spans: Column) -> Column:
    return F.when(condition, spans).otherwise(F.array().cast(_SPANS))


def _high_part(letters: Column, limit: Column) -> Column:
    """First start and last end (``first``, ``last``) of windows whose weight is at most
    ``limit``; nulls if there is none."""
    table = F.array(*[F.lit(weight(k)) for k in range(WINDOW + 1)])
    nothing = F.lit(None).cast("int")
    start = F.struct(
        F.lit(0).cast("bigint").alias("sum"), nothing.alias("first"), nothing.alias("last")
    )

    def counted(since: Column, size: Column, letter: Column) -> Column:
        part = F.slice(letters, since + 1, size)
        return size - F.size(F.array_remove(part, letter))

    def step(state: Column, i: Column) -> Column:
        begin = F.greatest(F.lit(0), i - WINDOW + 1)
        size = i - begin
        came = counted(begin, size, letters[i])
        more = table[came + 1] - table[came]
        left = letters[begin - 1]
        gone = counted(begin, size, left)
        less = F.when(i >= WINDOW, table[gone] - table[gone + 1]).otherwise(F.lit(0))
        total = state["sum"] + more + less
        high = (i >= WINDOW - 1) & (total <= limit)
        return F.struct(
            total.alias("sum"),
            F.when(high & state["first"].isNull(), begin).otherwise(state["first"]).alias("first"),
            F.when(high, i + 1).otherwise(state["last"]).alias("last"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.size(letters) - 1), start, step)


def _limit(candidate: Column) -> Column:
    single = candidate.rlike("^[^A-Z]*$") | candidate.rlike("^[^a-z]*$")
    return (
        F.when(candidate.rlike("^[0-9A-Fa-f]*$"), most_weight(LEAST_BITS["hex"]))
        .when(single, most_weight(LEAST_BITS["single"]))
        .otherwise(most_weight(LEAST_BITS["mixed"]))
        .cast("bigint")
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``base`` and ``spans``: arrays of structs (start, kind, end, found), sorted."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text")
    )
    rows = rows.withColumn("low", F.lower("text"))
    named = F.lit(False)
    for name in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        named = named | F.contains("low", F.lit(name))
    text = F.col("text")
    rows = rows.select(
        "doc_id",
        "text",
        _where(named, _matches(text, ASSIGN, 0)).alias("assign"),
        _where(F.contains(text, F.lit("AKIA")), _matches(text, ACCESS, 1)).alias("access"),
        _where(text.rlike(HEX), _matches(text, HEX, 2)).alias("hex"),
        _where(text.rlike(CANDIDATE), _matches(text, CANDIDATE, 3)).alias("strings"),
    )
    long_enough = F.filter(
        "assign",
        lambda s: F.char_length(F.regexp_extract(s["found"], ASSIGN, 2)) >= LEAST_ASSIGNED,
    )
    sought = F.filter("strings", lambda s: ~s["found"].rlike(ALLOWED))
    rows = rows.select(
        "doc_id",
        F.array_sort(F.concat(long_enough, "access", "hex")).alias("base"),
        sought.alias("sought"),
    )

    def part(span: Column) -> Column:
        # The one-element array holds the letters, so that they are split once.
        high = F.transform(
            F.array(F.split(span["found"], "")), lambda x: _high_part(x, _limit(span["found"]))
        )[0]
        return F.struct(span["start"].alias("start"), high.alias("high"), span["found"].alias("found"))

    rows = rows.select("doc_id", "base", F.transform("sought", part).alias("parts"))
    made = F.transform(
        F.filter("parts", lambda p: p["high"]["first"].isNotNull()),
        lambda p: F.struct(
            (p["start"] + p["high"]["first"]).alias("start"),
            F.lit(3).alias("kind"),
            (p["start"] + p["high"]["last"]).alias("end"),
            p["found"].alias("found"),
        ),
    ).cast(_SPANS)
    rows = rows.select("doc_id", "base", made.alias("made"))
    return rows.select("doc_id", "base", _outside(F.col("base"), F.col("made")).alias("spans"))


def as_text(spans: str) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: numbers of spans by kind, their digest, and all spans as text."""
    found = scan(docs, id_col, text_col)
    number = lambda kind: F.size(
        F.filter("base", lambda s: s["kind"] == kind)
    ).cast("bigint")
    return found.select(
        "doc_id",
        *[number(i).alias(f"n_{KINDS[i]}") for i in range(3)],
        F.sha2(as_text("base"), 256).alias("base_sha256"),
        as_text("spans").alias("spans"),
    )
