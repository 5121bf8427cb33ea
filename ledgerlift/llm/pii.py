"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust the score.

Everything is built-in functions. A pattern is run twice over a text, once for the matches and once for
the pieces between them; the running lengths of both give the places, in code points. The context of a
match is put together from the ends of the pieces and matches next to it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlift.llm.common import whole_text

#: Elements summed in one go by running_sums.
BLOCK = 256
#: Code points of the shortest match of any pattern.
SHORTEST = 4

# Fixed values. The patterns of the base kinds match what these match, leftmost and without overlap:
#   email  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip     [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card   [0-9]([\x20-]?[0-9])+ with 12 to 19 digits
#   phone  \+[0-9][\x20().0-9-]+[0-9]
# Each starts only where a run of its first class starts (or at the end of the last match) and gives
# nothing back, so the time is linear even on one endless run, and no group recurses.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])"


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """Whether the digits of a match pass the Luhn sum."""
    digits = F.reverse(digits_of(match))

    def step(total: Column, place: Column) -> Column:
        digit = F.ascii(F.substring(digits, place, 1)) - 48
        twice = digit * 2
        doubled = F.when(twice > 9, twice - 9).otherwise(twice)
        return total + F.when(place % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def mod97(match: Column) -> Column:
    """Whether a match is an account number whose remainder by 97 is 1."""
    plain = F.replace(match, F.lit(" "))
    moved = F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4))

    def step(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substring(moved, place, 1))
        return F.when(code < 58, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    size = F.length(plain)
    return size.between(15, 34) & (F.aggregate(F.sequence(F.lit(1), size), F.lit(0), step) == 1)


def parts_at_most_255(match: Column) -> Column:
    """Whether every number of a dotted match is at most 255, leading zeros aside."""
    return ~match.rlike(r"(?<![0-9])0*+(?:[1-9][0-9]{3,}|25[6-9]|2[6-9][0-9]|[3-9][0-9]{2})")


def nine_to_fifteen_digits(match: Column) -> Column:
    return F.length(digits_of(match)).between(9, 15)


@dataclass(frozen=True)
class Kind:
    """What is looked for: a pattern, a check, a text that must be there, a score and words that raise or lower it."""

    name: str
    pattern: str
    valid: object
    needs: str | None
    score: float
    raised_by: str
    lowered_by: str = r"\b(?:version|order|invoice|isbn|sku|item|page)\b"


# The base kinds in their order, then those the method adds.
BASE = (
    Kind("email", EMAIL, None, "@", 0.9, r"\b(?:e-?mail|contact|write|correo|courriel)\b"),
    Kind("ip", IP, parts_at_most_255, ".", 0.7, r"\b(?:ip|host|server|address|adresse)\b"),
    Kind("card", CARD, luhn, None, 0.8, r"\b(?:card|visa|mastercard|credit|karte|carte|tarjeta)\b"),
    Kind("phone", PHONE, nine_to_fifteen_digits, "+", 0.7, r"\b(?:phone|call|tel|mobile|fax|telefon|t[ée]l[ée]fono)\b"),
)
ADDED = (
    Kind("iban", IBAN, mod97, None, 0.8, r"\b(?:iban|account|bank|konto|compte|cuenta)\b"),
    Kind("ssn", SSN, None, "-", 0.4, r"\b(?:ssn|social security|taxpayer)\b"),
)
RAISE, LOWER = 0.15, 0.25


def running_sums(numbers: Column) -> Column:
    """The inclusive running sums of an array of long, in steps of a block: no quadratic copying."""

    def scan(values: Column, start: Column) -> Column:
        empty = F.array().cast("array<bigint>")
        seed = F.struct(start.alias("total"), empty.alias("sums"))
        return F.aggregate(
            values,
            seed,
            lambda s, x: F.struct(
                (s["total"] + x).alias("total"), F.concat(s["sums"], F.array(s["total"] + x)).alias("sums")
            ),
            lambda s: s["sums"],
        )

    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.ceil(F.size(numbers) / BLOCK).cast("int") - 1, F.lit(0))),
        lambda b: F.slice(numbers, b * BLOCK + 1, BLOCK),
    )
    totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0).cast("bigint"), lambda s, x: s + x))
    ends = scan(totals, F.lit(0).cast("bigint"))
    return F.flatten(
        F.zip_with(blocks, F.zip_with(ends, totals, lambda e, t: e - t), lambda b, before: scan(b, before))
    )


def find_pii(docs: DataFrame, id: str = "doc_id", text: str = "text", near: int = 40, least: float = 0.5) -> DataFrame:
    """Personal data of every whole text: ``id`` and ``spans``, an array of (start, place, end, kind, score).

    Spans are ordered by start, then by the order of the kinds (``place``). Ends are exclusive, both count
    code points. Base kinds that pass their check are always kept; added kinds only with a score of
    ``least`` or more. The score rises when a word of the kind's context stands within ``near`` code
    points on either side, and falls for words that speak against it.

    A null text is an empty text and has no spans; a null id stays null; repeated rows give repeated rows;
    columns other than these two are not looked at, whatever their names; an empty table gives an empty one.
    """
    rows = docs.select(F.col(id).alias("id"), whole_text(text).alias("text"))
    kinds = [*BASE, *ADDED]

    def gated(kind: Kind, value: Column) -> Column:
        empty = F.array().cast("array<string>")
        return F.when(F.contains("text", F.lit(kind.needs)), value).otherwise(empty) if kind.needs else value

    found = rows.select(
        "id",
        *[gated(k, F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))).alias(f"found_{k.name}") for k in kinds],
        "text",
    )
    # Most texts have no match of a kind; only the others are cut into pieces.
    cut = found.select(
        "id",
        *[f"found_{k.name}" for k in kinds],
        *[
            F.when(F.size(f"found_{k.name}") > 0, F.split("text", k.pattern, -1))
            .otherwise(F.array().cast("array<string>"))
            .alias(f"pieces_{k.name}")
            for k in kinds
        ],
    )
    placed = cut.select(
        "id",
        *[
            F.arrays_zip(
                F.col(f"found_{k.name}").alias("match"),
                F.col(f"pieces_{k.name}").alias("before"),
                F.slice(f"pieces_{k.name}", 2, F.size(f"pieces_{k.name}")).alias("after"),
                F.transform(f"found_{k.name}", lambda _, i: i).alias("index"),
                running_sums(
                    F.zip_with(
                        f"found_{k.name}",
                        f"pieces_{k.name}",
                        lambda m, p: (F.coalesce(F.length(m), F.lit(0)) + F.length(p)).cast("bigint"),
                    )
                ).alias("end"),
            ).alias(k.name)
            for k in kinds
        ],
        # The ends of each match with the piece before it, and the starts of each with the piece after it.
        *[
            F.zip_with(
                f"found_{k.name}", f"pieces_{k.name}", lambda m, p: F.right(F.concat(p, m), F.lit(near))
            ).alias(f"tails_{k.name}")
            for k in kinds
        ],
        *[
            F.zip_with(
                f"found_{k.name}",
                F.slice(f"pieces_{k.name}", 2, F.size(f"pieces_{k.name}")),
                lambda m, p: F.left(F.concat(m, p), F.lit(near)),
            ).alias(f"heads_{k.name}")
            for k in kinds
        ],
    )
    # So many neighbouring matches fill the context.
    most = -(-near // SHORTEST)

    def spans(place: int, kind: Kind) -> Column:
        def scored(x: Column) -> Column:
            i = x["index"]
            left = F.slice(f"tails_{kind.name}", F.greatest(i - most, F.lit(0)) + 1, F.least(i, F.lit(most)))
            right = F.slice(f"heads_{kind.name}", i + 2, F.lit(most))
            before = F.right(F.concat(F.array_join(left, ""), F.right(x["before"], F.lit(near))), F.lit(near))
            after = F.left(F.concat(F.left(x["after"], F.lit(near)), F.array_join(right, "")), F.lit(near))
            context = F.lower(F.concat(before, F.lit("\n"), after))
            score = (
                F.lit(kind.score)
                + F.when(context.rlike(kind.raised_by), RAISE).otherwise(0.0)
                - F.when(context.rlike(kind.lowered_by), LOWER).otherwise(0.0)
            )
            return F.struct(
                (x["end"] - F.length(x["match"])).alias("start"),
                F.lit(place).alias("place"),
                x["end"].alias("end"),
                F.lit(kind.name).alias("kind"),
                score.alias("score"),
            )

        def passes(x: Column) -> Column:
            return x["match"].isNotNull() & (kind.valid(x["match"]) if kind.valid else F.lit(True))

        out = F.transform(F.filter(kind.name, passes), scored)
        return out if kind in BASE else F.filter(out, lambda s: s["score"] >= least)

    every = reduce(F.concat, [spans(i, k) for i, k in enumerate(kinds)])
    return placed.select(F.col("id").alias(id), F.array_sort(every).alias("spans"))


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.concat_ws(
        ",",
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
    )


def pii_digest(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of their spans, and all spans as text."""
    base = [k.name for k in BASE]

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind))

    found = find_pii(docs)
    return found.select(
        "doc_id",
        *[count(n).cast("bigint").alias(f"n_{n}") for n in base],
        F.sha2(joined(F.filter("spans", lambda s: s["place"] < len(base))), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )
