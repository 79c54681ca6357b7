"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

All of it is SQL expressions. Places come from cutting the text at the matches: a match starts where the pieces and
matches before it end. They are added up in blocks of matches, and what stands before a match is carried along, so that
work grows with the text and not with the square of its matches. Patterns are written so that a match attempt never scans a run of characters twice (possessive
repeats; an attempt starts only where a run does), which keeps long texts linear, and match the same spans as the plain
patterns of the contract.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL = "A-Za-z0-9._%+-"
#: Zeros in front are given back where a part holds nothing else: 0 is a number too.
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Characters before a span that are searched for context words.
CONTEXT_CHARS = 48
#: Matches whose places are added up together.
BLOCK = 256
LEAST_SCORE = 0.6
CONTEXT_GAIN = 0.3


@dataclass(frozen=True)
class Kind:
    name: str
    needs: str  # a text without a match of this is skipped
    pattern: str
    score: float  # of a confirmed span without context
    context: str
    base: bool


KINDS = (
    Kind("email", "@", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", 0.7, r"\b(?:e-?mail|contact|write|correo|courriel)\b", True),
    Kind("ip", ".", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.6, r"\b(?:ip|address|host|server|client|login)\b", True),
    Kind("card", "", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])", 0.7, r"\b(?:card|credit|debit|visa|karte|carte|tarjeta)\b", True),
    Kind("phone", "+", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, r"\b(?:phone|tel|call|mobile|fax|telefon|téléphone|teléfono)\b", True),
    Kind("iban", "", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", 0.7, r"\b(?:iban|account|bank|konto|compte|cuenta)\b", False),
    Kind("ssn", "-", r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", 0.4, r"\b(?:ssn|social security|tax id|taxpayer)\b", False),
)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def mod97(text: Column) -> Column:
    """Remainder by 97 of an IBAN's digits, its first four characters moved to the end and letters as 10 to 35."""
    plain = F.regexp_replace(text, " ", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    step = lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.regexp_extract_all(moved, F.lit("[0-9A-Z]"), F.lit(0)), F.lit(0), step)


def confirmed(kind: Kind, value: Column) -> Column:
    if kind.name == "ip":
        return value.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind.name == "card":
        return F.call_function("luhn_check", digits(value))
    if kind.name == "phone":
        return F.length(digits(value)).between(9, 15)
    if kind.name == "iban":
        return mod97(value) == 1
    return F.lit(True)


def cut(text: Column, kind: Kind) -> Column:
    """The text as pieces, each with the match after it (null after the last); null where nothing matches."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    some = F.size(matches) > 0
    parts = F.arrays_zip(F.split(text, kind.pattern, -1).alias("piece"), matches.alias("value"))
    return F.when(F.contains(text, F.lit(kind.needs)) & some if kind.needs else some, parts)


def spans(parts: Column, number: int, kind: Kind) -> Column:
    """Confirmed spans of one kind as structs (start, kind_no, end, score), in order. `parts` is a column of `cut`."""
    last = lambda text: F.right(text, F.lit(CONTEXT_CHARS))
    value = lambda part: F.coalesce(part["value"], F.lit(""))

    def step(done: Column, part: Column) -> Column:
        start = done["at"] + F.length(part["piece"])
        before = last(F.concat(done["before"], part["piece"]))
        match = F.struct(start.alias("start"), part["value"].alias("value"), before.alias("before"))
        return F.struct(
            (start + F.length(value(part))).alias("at"), last(F.concat(before, value(part))).alias("before"),
            F.when(part["value"].isNull(), done["found"]).otherwise(F.concat(done["found"], F.array(match))).alias("found"),
        )

    def block(b: Column) -> Column:
        # every part but the last has a character or more, so this many parts hold all the context there is
        lead = F.slice(parts, F.greatest(b * BLOCK + 1 - CONTEXT_CHARS, F.lit(1)), F.least(b * BLOCK, F.lit(CONTEXT_CHARS)))
        before = last(F.array_join(F.transform(lead, lambda part: F.concat(part["piece"], value(part))), ""))
        none = F.array().cast("array<struct<start:int,value:string,before:string>>")
        return F.aggregate(F.slice(parts, b * BLOCK + 1, BLOCK), F.struct(F.lit(0).alias("at"), before.alias("before"), none.alias("found")), step)

    def moved(done: Column, own: Column) -> Column:
        found = F.transform(own["found"], lambda m: F.struct((m["start"] + done["at"]).alias("start"), m["value"].alias("value"), m["before"].alias("before")))
        return F.struct((done["at"] + own["at"]).alias("at"), F.concat(done["found"], F.array(found)).alias("found"))

    def scored(match: Column) -> Column:
        score = F.round(F.lit(kind.score) + F.when(F.lower(match["before"]).rlike(kind.context), CONTEXT_GAIN).otherwise(0.0), 2)
        return F.struct(
            match["start"].alias("start"), F.lit(number).alias("kind_no"),
            (match["start"] + F.length(match["value"])).alias("end"), score.alias("score"),
        )

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int")), block)
    nothing = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<start:int,value:string,before:string>>>").alias("found"))
    matches = F.flatten(F.aggregate(blocks, nothing, moved, lambda done: done["found"]))
    found = F.transform(F.filter(matches, lambda m: confirmed(kind, m["value"])), scored)
    if not kind.base:
        found = F.filter(found, lambda s: s["score"] >= LEAST_SCORE)
    return F.when(parts.isNotNull(), found).otherwise(F.array().cast("array<struct<start:int,kind_no:int,end:int,score:double>>"))


def find(documents: DataFrame) -> DataFrame:
    """doc_id, text and `found`: every confirmed span by start, then kind. Null texts count as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    each = documents.select("doc_id", text.alias("text"))
    each = each.select("doc_id", "text", *[cut(F.col("text"), k).alias(f"_c{i}") for i, k in enumerate(KINDS)])
    each = each.select("doc_id", "text", *[spans(F.col(f"_c{i}"), i, k).alias(f"_k{i}") for i, k in enumerate(KINDS)])
    return each.select("doc_id", "text", F.array_sort(F.concat(*[f"_k{i}" for i in range(len(KINDS))])).alias("found"))


def named(found: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind_no"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(found, one), ",")


def report(documents: DataFrame) -> DataFrame:
    """One row for each document: counts of the base kinds, digest of their spans, all spans, their scores.

    A document without spans has zeros, the digest of the empty text and empty strings; repeated rows and rows with a null
    id are reported each. Spans that begin at one place stand in the order of KINDS. Only doc_id and text are read. Texts
    are searched whole; work grows with their length. An empty table gives no rows.
    """
    base = [i for i, k in enumerate(KINDS) if k.base]
    count = lambda i: F.size(F.filter("found", lambda s: s["kind_no"] == i)).cast("long").alias(f"n_{KINDS[i].name}")
    own = F.filter("found", lambda s: s["kind_no"] <= max(base))
    return find(documents).select(
        "doc_id", *map(count, base), F.sha2(named(own), 256).alias("base_sha256"), named(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda s: F.format_number(s["score"], 2)), ",").alias("scores"),
    )
