"""Personal data: expressions propose spans, checksums confirm them, context words weigh them.

Only Spark's own functions. A kind's matches come from cutting the text at them: pieces between
matches and the matches themselves alternate, so a match starts after the lengths of all before it.
Expressions of the base kinds are possessive and start only where a run of their characters starts, so
a long run costs its length, not the square of it; this finds the same leftmost matches. Account numbers
are only looked ahead at, as long as their country has them: what follows one is not taken for a part
of it, and a false start hides no number that begins inside it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swipeline.llm.common import text_or_empty

_LOCAL = r"[A-Za-z0-9._%+-]"
_PART = r"[A-Za-z0-9-]"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: its expression, a character each match holds, words that support it.

    ``sure`` is the score without such a word; matches under the operator's least score are left out.
    The match of an ``ahead`` kind is group 1 of an expression that itself takes no character.
    """

    name: str
    pattern: str
    holds: str
    context: str
    sure: float
    ahead: bool = False


#: Signs of an account number by country (ISO 13616 registry, and the countries that use it unregistered).
_IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_SIGN = r"(?:\x20?[A-Z0-9])"
_SIZED = "|".join(rf"(?:{codes.replace(' ', '|')})[0-9]{{2}}{_SIGN}{{{n - 4}}}" for n, codes in _IBAN.items())
_OTHER = rf"(?!{'|'.join(_IBAN.values()).replace(' ', '|')})[A-Z]{{2}}[0-9]{{2}}{_SIGN}{{11,30}}+"
_ACCOUNT = rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?=((?:{_SIZED}|{_OTHER})(?![A-Za-z0-9])))"

#: The base kinds, in the order of the report.
BASE = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_PART}++(?:\.{_PART}++)++", "@", "mail|contact|write", 0.9),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", ".", "ip|address|host|server", 0.6),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "", "card|visa|credit|payment", 0.8),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", "phone|call|tel|mobile", 0.7),
)
#: What the method adds to the base: account numbers, and 3-2-4 identity numbers if a word near supports them.
ADDED = (
    Kind("iban", _ACCOUNT, "", "iban|account|bank", 0.8, ahead=True),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-", "ssn|social|security", 0.3),
)
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_NEAR = 40  # characters before and after that may hold a supporting word
_RUN = 256


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True if the digits, the second from the right and every other one doubled, sum to 0 mod 10."""
    each = F.transform(
        F.split(F.reverse(number), ""),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") / 5).cast("int")),
    )
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(account: Column) -> Column:
    """True if the account number, its first four signs moved to the end, is 1 mod 97."""
    plain = F.regexp_replace(account, " ", "")
    signs = F.split(F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4))), "")
    value = lambda s: F.when(s.rlike("[0-9]"), s.cast("int")).otherwise(F.ascii(s) - 55)
    return F.aggregate(signs, F.lit(0), lambda a, s: (a * F.when(value(s) > 9, 100).otherwise(10) + value(s)) % 97) == 1


def _confirmed(kind: str, match: Column) -> Column:
    n = F.length(digits(match))
    if kind == "ip":
        return match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        # Checked only at the right length: the sum over a run of thousands of digits says nothing.
        return F.when((n >= 13) & (n <= 19), luhn(digits(match))).otherwise(False)
    if kind == "phone":
        return (n >= 9) & (n <= 15)
    return mod97(match) if kind == "iban" else F.lit(True)


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def _span(kind: Kind, match: Column, start: Column, before: Column, after: Column) -> Column:
    near = F.lower(F.concat_ws(" ", F.right(before, F.lit(_NEAR)), F.left(after, F.lit(_NEAR))))
    return F.struct(
        F.lit(kind.name).alias("kind"),
        start.cast("int").alias("start"),
        (start + F.length(match)).cast("int").alias("end"),
        F.when(near.rlike(kind.context), min(1.0, kind.sure + 0.2)).otherwise(kind.sure).alias("score"),
        _confirmed(kind.name, match).alias("ok"),
    )


def personal_spans(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """doc_id, and a column of spans for each kind, of every row's whole text.

    A span is (kind, start, end, score), in code points, its end exclusive. Base spans are never
    left out for their score; added ones need ``least``. A null text is empty. Rows count each;
    empty tables give no rows; other columns are not read.

    Each step is a projection of its own, so that nothing is computed again for every match. Sums of
    lengths are taken within runs of 256 matches, on top of the runs before.
    """
    kinds = BASE + ADDED
    rows = docs.select("doc_id", text_or_empty().alias("text"))

    def step(rows: DataFrame, name: str, value, keep: tuple[str, ...]) -> DataFrame:
        kept = [F.col(f"{k.name}_{x}") for k in kinds for x in keep]
        return rows.select("doc_id", *(["text"] if name == "found" else []), *kept, *[value(k).alias(f"{k.name}_{name}") for k in kinds])

    of = lambda k, x: F.col(f"{k.name}_{x}")
    rows = step(
        rows,
        "found",
        lambda k: F.when(F.contains("text", F.lit(k.holds)), F.regexp_extract_all("text", F.lit(k.pattern), F.lit(int(k.ahead)))),
        (),
    )
    # Nothing is split off at an empty match in front of all text, hence the space.
    whole = lambda k: F.concat(F.lit(" "), "text") if k.ahead else F.col("text")
    rows = step(rows, "gaps", lambda k: F.when(F.size(of(k, "found")) > 0, F.split(whole(k), k.pattern)), ("found",))
    rows = step(
        rows,
        "steps",
        lambda k: F.transform(of(k, "found"), lambda m, i: F.length(F.get(of(k, "gaps"), i)) + (0 if k.ahead else F.length(m))),
        ("found", "gaps"),
    )
    rows = step(
        rows,
        "runs",
        lambda k: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(of(k, "steps")) - 1) / _RUN).cast("int")),
            lambda r: _sum(F.slice(of(k, "steps"), r * _RUN + 1, _RUN)),
        ),
        ("found", "gaps", "steps"),
    )
    rows = step(
        rows,
        "before",
        lambda k: F.transform(of(k, "runs"), lambda _, r: _sum(F.slice(of(k, "runs"), F.lit(1), r))),
        ("found", "gaps", "steps"),
    )

    def spans(k: Kind) -> Column:
        def one(match: Column, i: Column) -> Column:
            run, at = F.floor(i / _RUN).cast("int"), (i % _RUN).cast("int")
            end = F.get(of(k, "before"), run) + _sum(F.slice(of(k, "steps"), run * _RUN + 1, at + 1))
            before, after = F.get(of(k, "gaps"), i), F.get(of(k, "gaps"), i + 1)
            if k.ahead:
                return _span(k, match, end - 1, before, F.substr(after, F.length(match) + 1))
            return _span(k, match, end - F.length(match), before, after)

        found = F.when((F.size(of(k, "before")) > 0) & (F.size(of(k, "gaps")) > 0), F.transform(of(k, "found"), one))
        good = F.filter(found, lambda s: s["ok"] & (s["score"] >= (0.0 if k in BASE else least)))
        plain = F.transform(good, lambda s: F.struct(s["kind"], s["start"], s["end"], s["score"]))
        return F.coalesce(plain, F.expr("CAST(array() AS array<struct<kind:string,start:int,end:int,score:double>>)"))

    return rows.select("doc_id", *[spans(k).alias(k.name) for k in kinds])


def _joined(kinds: tuple[Kind, ...]) -> Column:
    every = F.concat(*[F.col(k.name) for k in kinds])
    return F.array_join(F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def summary(spans: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as text."""
    return spans.select(
        "doc_id",
        *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in BASE],
        F.sha2(_joined(BASE).cast("binary"), 256).alias("base_sha256"),
        _joined(BASE + ADDED).alias("spans"),
    )
