"""Personal data: patterns propose spans, checksums confirm them, context words adjust a score.

DataFrame functions only, without a shuffle. A one-row ``inline`` stands between steps so that arrays are
computed once and then read, instead of being computed again for each element that refers to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "secret", "national")
BASE = 4  # the first kinds; spans of the others are added by the method

# The length of an account number by its country (the IBAN registry, and countries that use it unlisted).
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}


def _account_numbers() -> str:
    """Each country's length in blocks of four, with or without spaces; the next number may follow at once."""
    start = f"(?:{'|'.join(c for countries in LENGTHS.values() for c in countries.split())})[0-9]{{2}}"
    kinds = []
    for n, countries in LENGTHS.items():
        rest = rf"\x20?[A-Z0-9]{{{n % 4}}}" if n % 4 else ""
        kinds.append(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{n // 4 - 1}}}{rest}")
    return rf"(?:\G|(?<![A-Za-z0-9]))(?=[A-Z]{{2}}[0-9]{{2}})(?:{'|'.join(kinds)})(?:(?![A-Za-z0-9])|(?={start}))"


# What a span looks like. The guards before email, ip and iban let a search start only where a
# run of characters begins or the last span ended, which finds the same spans in time linear in the run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": _account_numbers(),
    "secret": (
        r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----|(?:\G|(?<![A-Za-z0-9+/_.-]))"
        r"(?:eyJ[A-Za-z0-9_-]++\.eyJ[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++|(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}+(?!\x20?[=:]\x20?[\"'A-Za-z0-9])={0,2})"
    ),
    "national": (
        r"(?<![A-Za-z0-9-])(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|[0-9]{8}-?[A-Z]|[XYZ]-?[0-9]{7}-?[A-Z]"
        r"|[12]\x20?[0-9]{2}\x20?(?:0[1-9]|1[0-2])\x20?[0-9]{2}\x20?[0-9]{3}\x20?[0-9]{3}\x20?[0-9]{2})(?![A-Za-z0-9-])"
    ),
}
# Credentials that say what they are by their first characters.
KNOWN_SECRET = (
    r"^(?:-----BEGIN|eyJ[A-Za-z0-9_-]+\.eyJ|(?:AKIA|ASIA)[A-Z0-9]{16}$|gh[pousr]_[A-Za-z0-9]{36,}$|github_pat_|glpat-[A-Za-z0-9_-]{20}"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}|AIza[A-Za-z0-9_-]{35}$|[rs]k_(?:live|test)_[A-Za-z0-9]{16,}$|npm_[A-Za-z0-9]{36}$)"
)
# Check letters of Spanish identity numbers, by the remainder modulo 23.
LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

# The score of a confirmed span, and words within 40 characters that raise or lower it by 0.2.
# Any other long run of letters and digits, and a number that anything may have, is a finding only with a word for it.
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "secret": 0.4, "national": 0.4}
FOR = {
    "email": r"(?i)mail|contact|kontakt|correo|courriel",
    "ip": r"(?i)\bip\b|address|adresse|host|server|login",
    "card": r"(?i)card|karte|carte|tarjeta|visa|credit|payment",
    "phone": r"(?i)phone|tel|call|mobile|handy|fax",
    "iban": r"(?i)iban|account|konto|compte|cuenta|bank",
    "secret": r"(?i)token|secret|api[_ -]?key|access[_ -]?key|private[_ -]?key|passw|passphrase|auth|bearer|credential|kennwort|contraseñ|mot de passe",
    "national": r"(?i)\bssn\b|social security|\bdni\b|\bnie\b|identidad|s[eé]curit[eé] sociale|\bnir\b|\binsee\b|national id|identity",
}
AGAINST = {
    "email": r"(?i)example|noreply",
    "ip": r"(?i)version|release|section|chapter",
    "card": r"(?i)isbn|order|serial|invoice|tracking",
    "phone": r"(?i)score|total|version",
    "iban": r"(?i)serial|key|token",
    "secret": r"(?i)sha-?[0-9]|md5|checksum|commit|digest|uuid|etag",
    "national": r"(?i)order|serial|invoice|part n|isbn",
}
# A label right before a span that calls it something else, by which the score falls by another 0.4 if no word is for it.
LABELS = {
    "iban": r"(?i)\b(?:(?:serial|part|product|article|model|batch|licen[cs]e|tracking)[\x20_-]?(?:number|no|nr|key|code|id)|seriennummer|num[eé]ro de s[eé]rie|n[uú]mero de serie)\b[\x20:.#=]*\z",
}
NEAR = 40
PART = 256  # lengths are added up in parts of so many spans


def _once(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and the new columns, each computed once per row."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _mod97(text: Column) -> Column:
    """The check sum of an account number: 1 if it is right."""
    plain = F.replace(text, F.lit(" "), F.lit(""))
    moved = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.pmod(F.when(code < 58, rest * 10 + code - 48).otherwise(rest * 100 + code - 55), F.lit(97))

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step)


def _confirmed(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.when(F.length(_digits(text)).between(12, 19), F.call_function("luhn_check", _digits(text))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    if kind == "iban":
        return F.when(F.length(F.replace(text, F.lit(" "), F.lit(""))).between(15, 34), _mod97(text) == 1).otherwise(False)
    if kind == "secret":
        mixed = text.rlike("[0-9]") & text.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(text, ""))) >= 10)
        account = F.when(text.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), _mod97(text) == 1).otherwise(False)
        return text.rlike(KNOWN_SECRET) | (mixed & ~account)
    if kind == "national":
        return _national(text)
    return F.lit(True)


def _national(text: Column) -> Column:
    """Numbers of four countries' forms: valid areas and groups, check letters modulo 23, a check key modulo 97."""
    digits = _digits(text)
    social = ~text.rlike("^(?:000|666|9)|-00-|-0000$")
    number = F.concat(F.translate(F.regexp_extract(text, "^[XYZ]", 0), "XYZ", "012"), digits).try_cast("long")
    letter = F.right(text, F.lit(1)) == F.substring(F.lit(LETTERS), (number % 23 + 1).cast("int"), F.lit(1))
    key = F.substring(digits, 1, 13).try_cast("long") % 97 + F.substring(digits, 14, 2).try_cast("long") == 97
    found = F.when(text.rlike("^[0-9]{3}-"), social).when(text.rlike("[A-Z]$"), letter).otherwise(key)
    return F.coalesce(found, F.lit(False))


def _score(kind: str, text: Column) -> Column:
    plain = F.lit(SCORES[kind])
    return F.when(text.rlike(KNOWN_SECRET), 0.9).otherwise(plain) if kind == "secret" else plain


def _possible(kind: str) -> Column:
    """A cheap test that every text with such a span passes."""
    tests = {
        "email": F.contains("text", F.lit("@")),
        "ip": F.col("text").rlike(r"[0-9]\.[0-9]"),
        "card": F.col("text").rlike(r"[0-9][\x20-]?[0-9]"),
        "phone": F.contains("text", F.lit("+")),
        "iban": F.col("text").rlike(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
        "secret": F.col("text").rlike(r"[A-Za-z0-9+/_-]{16}|-----BEGIN|eyJ"),
        "national": F.col("text").rlike(r"[0-9]{2}-[0-9]{4}|[0-9]{7}-?[A-Z]|[12]\x20?[0-9]{2}\x20?[01][0-9]\x20?[0-9]{2}\x20?[0-9]{3}"),
    }
    return tests[kind]


def _ends(kind: str) -> Column:
    """Where each match ends: the sum of the parts before it, plus the steps of its own part up to it."""
    at = F.col(f"{kind}_steps")

    def end(_: Column, i: Column) -> Column:
        part = F.floor(i / PART).cast("int")
        own = F.slice(at, part * PART + 1, i % PART + 1)
        return F.get(F.col(f"{kind}_before"), part) + F.aggregate(own, F.lit(0).cast("long"), lambda x, y: x + y)

    return F.transform(at, end)


def _before(kind: str) -> Column:
    """For each part, the sum of all parts before it."""
    at = F.col(f"{kind}_steps")
    zero = F.lit(0).cast("long")
    numbers = F.when(F.size(at) > 0, F.sequence(F.lit(0), F.floor((F.size(at) - 1) / PART).cast("int"))).otherwise(F.array().cast("array<int>"))
    sums = F.transform(numbers, lambda p: F.aggregate(F.slice(at, p * PART + 1, PART), zero, lambda x, y: x + y))
    return F.aggregate(sums, F.array(zero), lambda found, x: F.concat(found, F.array(F.element_at(found, -1) + x)))


def _spans(kind: str) -> Column:
    """Confirmed matches with their places and scores."""
    number = KINDS.index(kind)
    matches, gaps, ends = F.col(f"{kind}_matches"), F.col(f"{kind}_gaps"), F.col(f"{kind}_ends")

    def span(text: Column, i: Column) -> Column:
        near = F.concat(F.right(F.get(gaps, i), F.lit(NEAR)), F.lit(" "), F.left(F.get(gaps, i + 1), F.lit(NEAR)))
        raised = F.when(near.rlike(FOR[kind]), 0.2).otherwise(0.0) - F.when(near.rlike(AGAINST[kind]), 0.2).otherwise(0.0)
        if kind in LABELS:
            named = F.right(F.get(gaps, i), F.lit(NEAR)).rlike(LABELS[kind])
            raised = raised - F.when(named & ~near.rlike(FOR[kind]), 0.4).otherwise(0.0)
        end = F.get(ends, i)
        return F.when(
            _confirmed(kind, text),
            F.struct(
                (end - F.length(text)).alias("start"), F.lit(number).alias("number"), end.alias("end"),
                F.lit(kind).alias("kind"), F.round(_score(kind, text) + raised, 2).alias("score"),
            ),
        )

    return F.array_compact(F.transform(matches, span))


def personal_data(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Per row: ``doc_id`` and ``found``, an array of (start, number, end, kind, score) in order.

    Places are code points, ends exclusive. The base kinds are always kept; spans the method adds need a
    score of ``least``, which a label such as "serial number:" takes from them where no word speaks for them.
    Secrets are private keys, tokens of known form, and other runs of 16 or more mixed letters and digits
    beside a word such as "token"; national numbers have valid check digits or groups and such a word too. Null texts count as empty; repeated rows get equal results; no documents, no rows;
    other columns are ignored. Work and memory are linear in the text.
    """
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    none = F.array().cast("array<string>")
    split: dict[str, Column] = {}
    for k in KINDS:
        split[f"{k}_gaps"] = F.when(_possible(k), F.split("text", PATTERNS[k], -1)).otherwise(none)
        split[f"{k}_matches"] = F.when(_possible(k), F.regexp_extract_all("text", F.lit(PATTERNS[k]), F.lit(0))).otherwise(none)
    parts = _once(own, ["doc_id"], **split)

    def step(k: str) -> Column:
        gap = lambda i: F.length(F.get(F.col(f"{k}_gaps"), i))
        return F.transform(f"{k}_matches", lambda text, i: (gap(i) + F.length(text)).cast("long"))

    keep = ["doc_id", *split]
    stepped = _once(parts, keep, **{f"{k}_steps": step(k) for k in KINDS})
    summed = _once(stepped, [*keep, *[f"{k}_steps" for k in KINDS]], **{f"{k}_before": _before(k) for k in KINDS})
    placed = _once(summed, keep, **{f"{k}_ends": _ends(k) for k in KINDS})
    spans = _once(placed, ["doc_id"], **{k: _spans(k) for k in KINDS})
    added = [F.filter(k, lambda x: x["score"] >= least) for k in KINDS[BASE:]]
    return _once(spans, ["doc_id"], found=F.sort_array(F.concat(*KINDS[:BASE], *added)))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, the SHA-256 of the base spans, all spans, and their scores."""
    base = F.filter("found", lambda x: x["number"] < BASE)

    def count(number: int) -> Column:
        return F.size(F.filter("found", lambda x: x["number"] == number)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:BASE])]
    return found.select(
        "doc_id", *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("found")).alias("spans"),
        F.array_join(F.transform("found", lambda x: x["score"].cast("string")), ",").alias("scores"),
    )
