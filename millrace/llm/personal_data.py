"""Personal data: patterns propose spans, check sums confirm, context scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import text_or_empty

# Possessive repeats and "start of a run, or where the last match ended" find
# the same matches as the plain patterns, in time linear in the text.
_LOCAL = "A-Za-z0-9._%+-"
EMAIL = rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Signs of an account number by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = "|".join(c.replace(" ", "|") for c in IBAN_LENGTHS.values())
_OF_LENGTH = "|".join(rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
IBAN = rf"^(?:{_OF_LENGTH}|(?!{_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]){{11,30}})(?![A-Za-z0-9])"
# Only the head is a match, so that what looks like one takes nothing from an account number behind it.
IBAN_HEAD = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=\x20?[A-Z0-9])"
SOCIAL = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    """``hint`` must be in the text for the pattern to be tried. A span counts
    when it is ``base`` or its score, plus ``near`` if a context word stands
    within ``CONTEXT`` characters before it, reaches ``ENOUGH``."""

    name: str
    pattern: str
    hint: str
    base: bool
    score: float
    context: str = ""
    near: float = 0.2


CONTEXT = 40
ENOUGH = 0.7
KINDS = (
    Kind("email", EMAIL, "@", True, 0.8, r"(?i)mail|contact|write|reply"),
    Kind("ip", IP, r"[0-9]\.[0-9]", True, 0.7, r"(?i)\bip\b|address|host|server"),
    Kind("card", CARD, "[0-9](?:[ -]?[0-9]){13}", True, 0.8, r"(?i)card|visa|credit|payment"),
    Kind("phone", PHONE, r"\+[0-9]", True, 0.7, r"(?i)phone|call|tel|mobile|fax"),
    Kind("iban", IBAN_HEAD, "[A-Z]{2}[0-9]{2}", False, 0.8, r"(?i)iban|account|konto|compte|bank"),
    Kind("social", SOCIAL, "[0-9]{3}-[0-9]{2}-[0-9]{4}", False, 0.3, r"(?i)\bssn\b|social security", 0.5),
)


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    from_right = F.transform(F.split(F.reverse(number), "(?!^)(?=.)"), lambda d: d.cast("int"))
    doubled = F.transform(from_right, lambda d, i: F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def mod_97(account: Column) -> Column:
    """Whether an account number, without spaces, has remainder 1 by 97 (letters count 10 to 35)."""
    moved = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def step(a: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (a * 100 + code - 55) % 97).otherwise((a * 10 + code - 48) % 97)

    return F.aggregate(F.split(moved, "(?!^)(?=.)"), F.lit(0), step) == 1


def confirmed(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        d = digits(found)
        return F.when(F.length(d).between(14, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(found)).between(10, 15)
    if kind == "iban":
        return mod_97(F.regexp_replace(found, " ", ""))
    if kind == "social":
        return ~found.rlike("^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def proposed(text: Column, pattern: str) -> Column:
    """All matches in order as structs (start, end, found): code points, end exclusive.

    Built-in functions give the matches and the pieces between them, both from
    left to right; adding up their lengths gives the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern), F.length)
    pairs = F.zip_with(found, between, lambda m, n: F.struct(m.alias("found"), n.alias("before")))
    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")
    return F.aggregate(
        F.filter(pairs, lambda x: x["found"].isNotNull()),
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda a, x: F.struct(
            (a["at"] + x["before"] + F.length(x["found"])).alias("at"),
            F.array_append(
                a["out"],
                F.struct(
                    (a["at"] + x["before"]).alias("start"),
                    (a["at"] + x["before"] + F.length(x["found"])).alias("end"),
                    x["found"].alias("found"),
                ),
            ).alias("out"),
        ),
        lambda a: a["out"],
    )


def accounts(text: Column, heads: Column) -> Column:
    """The account numbers that begin at ``heads`` and pass their check; of overlapping ones the first."""

    def whole(s: Column) -> Column:
        found = F.regexp_extract(F.substr(text, s["start"] + 1, F.lit(68)), IBAN, 0)
        return F.struct(s["start"].alias("start"), (s["start"] + F.length(found)).alias("end"), found.alias("found"))

    right = F.filter(F.transform(heads, whole), lambda s: (s["found"] != "") & confirmed("iban", s["found"]))
    empty = F.array().cast("array<struct<start:int,end:int,found:string>>")
    return F.aggregate(right, empty, lambda a, s: F.when(F.size(a) == 0, F.array(s)).when(s["start"] < F.element_at(a, -1)["end"], a).otherwise(F.array_append(a, s)))


def scored(text: Column, kind: Kind, order: int) -> Column:
    """Confirmed spans of one kind with their scores; NULL where the text has no hint of it."""
    hint = F.contains(text, F.lit(kind.hint)) if kind.hint == "@" else text.rlike(kind.hint)
    found = proposed(text, kind.pattern)
    if kind.name == "iban":
        found = accounts(text, found)
    near = lambda s: F.substr(text, F.greatest(s["start"] - CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(CONTEXT))).rlike(kind.context)
    spans = F.transform(
        F.filter(found, lambda s: confirmed(kind.name, s["found"])),
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(order).alias("order"),
            F.lit(kind.name).alias("kind"),
            s["end"].alias("end"),
            (F.lit(kind.score) + F.when(near(s), kind.near).otherwise(0.0)).alias("score"),
            F.lit(kind.base).alias("base"),
        ),
    )
    return F.when(hint, F.filter(spans, lambda s: s["base"] | (s["score"] >= ENOUGH)))


def find_personal_data(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add ``found``: structs (start, order, kind, end, score, base) by start, then kind.

    Places are code points of the whole text. Spans of a kind do not overlap;
    spans of different kinds may. NULL and empty texts have no spans. Rows are
    handled one by one without a shuffle; texts are scanned only for kinds whose
    hint they contain.
    """
    t = text_or_empty(text)
    empty = F.array().cast("array<struct<start:int,order:int,kind:string,end:int,score:double,base:boolean>>")
    per_kind = [F.coalesce(scored(t, k, i), empty) for i, k in enumerate(KINDS)]
    return docs.withColumn(f"{prefix}found", F.array_sort(F.concat(*per_kind)))


def spans_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """Replace every span of the text by its kind in brackets; of overlapping spans the first stays."""
    p = "__pii_"
    t = text_or_empty(text)
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    walked = F.aggregate(
        F.col(f"{p}found"),
        state,
        lambda a, s: F.when(s["start"] < a["at"], a).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(a["out"], F.substr(t, a["at"] + 1, s["start"] - a["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out"),
            )
        ),
        lambda a: F.concat(a["out"], F.substr(t, a["at"] + 1)),
    )
    found = find_personal_data(docs, text, p)
    return found.withColumn(text, F.when(F.size(f"{p}found") > 0, walked).otherwise(F.col(text))).drop(f"{p}found")
