"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Built from Spark's own functions only. A pattern's matches and the texts between them, taken in step,
give the positions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.common import table
from tallyframe.llm.secrets import joined, spans_sql

SPAN = "kind string, start int, end int, text string, score double"
#: Code points on each side in which a context word counts.
NEARBY = 40
#: Elements that are summed in one walk, and code points of a page of text.
PIECE, PAGE = 256, 1024


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``confirms`` decides on a match, ``words`` nearby raise ``score`` by 0.3.

    The patterns are written so that Java's matcher walks a run of characters once: possessive
    repeats, and a start inside of a run only where the last match ended.
    """

    name: str
    pattern: str
    sign: str | None
    confirms: Callable[[Column], Column]
    score: float
    words: tuple[str, ...]


def digits(match: Column) -> Column:
    return F.regexp_replace(match, r"[^0-9]", "")


def small_parts(match: Column) -> Column:
    """Whether no part of a dotted number is above 255, leading zeros aside."""
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def luhn(match: Column) -> Column:
    return F.length(digits(match)).between(13, 19) & F.call_function("luhn_check", digits(match))


def mod97(match: Column) -> Column:
    """Whether the account number's check digits fit: letters count 10 to 35, the first four go last."""
    moved = F.concat(F.substr(match, F.lit(5)), F.substring(match, 1, 4))
    value = lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48)
    step = lambda acc, c: (acc * F.when(c >= "A", 100).otherwise(10) + value(c)) % 97
    return F.aggregate(F.split(moved, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c))) == 1


_ALWAYS = lambda match: F.lit(True)
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", _ALWAYS, 0.7, ("mail", "contact", "write", "send")),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", small_parts, 0.5, ("address", "host", "server", "login")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", None, luhn, 0.6, ("card", "credit", "visa", "paid", "pay")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", lambda m: F.length(digits(m)).between(9, 15), 0.5, ("phone", "call", "tel", "mobile")),
    Kind("iban", r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", None, mod97, 0.6, ("iban", "account", "bank", "transfer")),
)
#: The kinds that the digest covers.
BASE = [k.name for k in KINDS[:4]]


def held_as(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, also where ``use`` names it for every element of an array."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running_sums(widths: Column) -> Column:
    """The sum up to each place of a non-empty array.

    Sums inside of pieces, then sums of the pieces: an array that grows by one element is copied each time, so one
    walk over all of them would cost the square of their number.
    """

    def inside(piece: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("sums"))
        add = lambda acc, w: F.struct((acc["at"] + w).alias("at"), F.concat(acc["sums"], F.array(acc["at"] + w)).alias("sums"))
        return F.aggregate(piece, empty, add, lambda acc: acc["sums"])

    def pieces(all_widths: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_widths) - 1) / PIECE).cast("int"))
        return F.transform(numbers, lambda n: inside(F.slice(all_widths, n * PIECE + 1, PIECE)))

    def whole(sums: Column) -> Column:
        before = inside(F.transform(sums, lambda piece: F.element_at(piece, -1)))
        shifted = lambda held: F.transform(sums, lambda piece, n: F.transform(piece, lambda x: x + F.when(n > 0, F.get(held, n - 1)).otherwise(0)))
        return F.flatten(held_as(before, shifted))

    return held_as(widths, lambda w: held_as(pieces(w), whole))


def spans_of(text: Column, kind: Kind) -> Column:
    """The confirmed spans of one kind, in order of their start; the work grows with the text, whatever it matches."""
    empty = F.array().cast(f"array<struct<{SPAN}>>")

    def scored(pages: Column, found: Column) -> Column:
        """A span's score from the words near it, which are cut from the pages of the text that hold them."""
        first = F.greatest(found["end"] - F.length(found["match"]) - NEARBY, F.lit(0))
        count = F.length(found["match"]) + 2 * NEARBY
        page, last = F.floor(first / PAGE).cast("int"), F.floor((first + count - 1) / PAGE).cast("int")
        near = F.lower(F.substr(F.array_join(F.slice(pages, page + 1, last - page + 1), ""), first - page * PAGE + 1, count))
        score = F.when(near.rlike("|".join(kind.words)), kind.score + 0.3).otherwise(kind.score)
        start = found["end"] - F.length(found["match"])
        return F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), found["end"].alias("end"), found["match"].alias("text"), score.alias("score"))

    def placed(matches: Column) -> Column:
        """Matches that pass the check, with their ends: a match and the text before it are as wide as both."""
        gaps = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(matches))
        ends = running_sums(F.zip_with(gaps, matches, lambda g, m: F.length(g) + F.length(m)))
        found = F.zip_with(ends, matches, lambda e, m: F.struct(e.alias("end"), m.alias("match")))
        return F.filter(found, lambda x: kind.confirms(x["match"]))

    def spans(found: Column) -> Column:
        pages = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PAGE}}}+"), F.lit(0))
        whole = held_as(pages, lambda held: F.transform(found, lambda x: scored(held, x)))
        return F.when(F.size(found) > 0, whole).otherwise(empty)

    def of_matches(matches: Column) -> Column:
        return F.when(F.size(matches) > 0, held_as(placed(matches), spans)).otherwise(empty)

    whole = held_as(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), of_matches)
    return whole if kind.sign is None else F.when(text.contains(kind.sign), whole).otherwise(empty)


def find_personal_data(docs: DataFrame, text: str, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``row`` (all columns of docs) and ``spans``: kind, start, end (code points, end exclusive), text
    and score (0 to 1), by kind as listed, then start.

    Matches of a kind run left to right without overlap; those that fail their check are dropped. Null text
    counts as empty and has no span; repeated rows are kept; an empty table gives no rows. No shuffle.
    """
    held = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(docs[text], F.lit("")).alias("text"))
    return held.select("row", F.concat(*[spans_of(F.col("text"), k) for k in kinds]).alias("spans"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    return found.select(
        "row.doc_id", *[count(kind) for kind in BASE],
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["score"] >= 0.8)).cast("long").alias("n_likely"),
    )


_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = (
    f"length({_DIGITS}) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: "
    f"CASE WHEN i % 2 = 1 THEN substr(reverse({_DIGITS}), i, 1)::INT "
    f"ELSE (substr(reverse({_DIGITS}), i, 1)::INT * 2) // 10 + (substr(reverse({_DIGITS}), i, 1)::INT * 2) % 10 END)) % 10 = 0"
)
_MOD97 = (
    "list_reduce(list_prepend(0, list_transform(string_split(substr(m, 5) || substr(m, 1, 4), ''), lambda c: "
    "CASE WHEN c >= 'A' THEN ord(c) - 55 ELSE ord(c) - 48 END)), lambda a, v: (a * CASE WHEN v >= 10 THEN 100 ELSE 10 END + v) % 97) = 1"
)
_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", 0, "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", 0, "list_max(list_transform(string_split(m, '.'), lambda x: x::HUGEINT)) <= 255"),
    ("card", r"[0-9]([\x20-]?[0-9])+", 0, _LUHN),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0, f"length({_DIGITS}) BETWEEN 9 AND 15"),
    ("iban", KINDS[4].pattern, 0, _MOD97),
]
_NEAR = " ".join(f"WHEN '{k.name}' THEN regexp_matches(near, '{'|'.join(k.words)}') AND {k.score} + 0.3 >= 0.8" for k in KINDS)

OP8_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({spans_sql(_KINDS)}),
near AS (
  SELECT found.*, kind || ':' || s::BIGINT || ':' || e::BIGINT AS mark,
    lower(substr(t, greatest(s - {NEARBY} + 1, 1)::BIGINT, (e - s + {2 * NEARBY})::BIGINT)) AS near FROM found JOIN docs USING (rid)
), digest AS (
  SELECT rid, {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE)},
    string_agg(mark, ',' ORDER BY place, s) FILTER (WHERE place < 4) AS base, string_agg(mark, ',' ORDER BY place, s) AS spans,
    count(*) FILTER (WHERE CASE kind {_NEAR} END) AS n_likely
  FROM near GROUP BY rid
)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_likely, 0) AS n_likely
FROM docs LEFT JOIN digest USING (rid)
"""
