"""Personal data: regular expressions propose, checksums confirm, context scores
(DataFrame functions only).

Four base kinds, leftmost and non-overlapping per kind: ``email``, ``ip``
(parts up to 255), ``card`` (14 to 19 digits that pass Luhn) and ``phone`` (10
to 15 digits); a match that fails its test is dropped and not tried again. The
method adds ``iban`` (as long as its country's are; mod-97 must be 1) and ``ssn``, whose score must reach
``min_score``: every kind has a score of its own, which a context word within
``context_chars`` code points raises and a discouraging word lowers. Base
spans always stay; their scores are reported as well.

The patterns are those of the contract, written so that no text makes them
slow: a run of characters is entered at its start only (a look-behind, or
``\\G`` after a match that ended inside the run) and never backtracked into.

Defined results: a null text is empty; texts without a span give empty lists;
repeated rows are scanned each; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locus.llm.common import text_of
from locus.llm.spans import as_text, by_place, with_spans

_LOCAL = "A-Za-z0-9._%+-"
#: The contract's patterns, then the method's own.
EMAIL = f"(?:\\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
CARD = "[0-9](?:[\\x20-]?[0-9])++"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
#: Length of an IBAN by country; other countries' end where the text lets them.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _iban(length: int, countries: str) -> str:
    groups, rest = divmod(length - 4, 4)
    tail = f"\\x20?[A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{'|'.join(countries.split())})[0-9]{{2}}(?:\\x20?[A-Z0-9]{{4}}){{{groups}}}{tail}(?![A-Za-z0-9])"


_ANY_IBAN = "[A-Z]{2}[0-9]{2}(?:\\x20?[A-Z0-9]{4}){2,7}(?:\\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
IBAN = f"(?<![A-Za-z0-9])(?:{'|'.join(_iban(n, c) for n, c in IBAN_LENGTHS.items())}|{_ANY_IBAN})"
SSN = "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: Score without context, words that raise it, words that lower it.
SCORES = {
    "email": (0.8, ("mail", "contact", "e-mail"), ("example", "noreply")),
    "ip": (0.6, ("address", "server", "host", " ip"), ("version", "release")),
    "card": (0.7, ("card", "visa", "credit", "payment"), ("order", "serial")),
    "phone": (0.6, ("phone", "call", "tel", "fax", "mobile"), ("order", "serial")),
    "iban": (0.6, ("iban", "bank", "account", "konto", "compte", "cuenta"), ("order", "serial")),
    "ssn": (0.3, ("ssn", "social security", "taxpayer"), ("order", "serial")),
}


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_ok(number: Column) -> Column:
    """Luhn's test of a short string of digits."""
    n = F.length(number)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def mod97_ok(iban: Column) -> Column:
    """ISO 7064: first four characters to the end, letters as 10..35, remainder 1."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def add(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(turned, ""), F.lit(0), add) == 1


def _scored(spans: str, text: str, kind: str, context_chars: int) -> Column:
    base, raising, lowering = SCORES[kind]

    def add(s: Column) -> Column:
        start = F.greatest(s["start"] - context_chars, F.lit(0)).cast("int")
        near = F.lower(F.concat(
            F.substring(F.col(text), start + 1, (s["start"] - start).cast("int")), F.lit(" "),
            F.substring(F.col(text), s["end"].cast("int") + 1, F.lit(context_chars))))

        def any_of(words: tuple[str, ...]) -> Column:
            hit = F.lit(False)
            for w in words:
                hit = hit | F.contains(near, F.lit(w))
            return hit

        score = F.lit(base) + F.when(any_of(raising), 0.3).otherwise(0.0) - F.when(any_of(lowering), 0.3).otherwise(0.0)
        return s.withField("score", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)), 2))

    return F.transform(spans, add)


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             context_chars: int = 40, min_score: float = 0.5) -> DataFrame:
    """Per row: the id, counts per base kind, base_sha256, spans, n_iban, n_ssn, max_score."""
    t = F.col("_t")
    rows = df.select(F.col(id_col), text_of(text_col).alias("_t"))
    # one cheap look tells which texts a pattern can match at all
    rows = rows.withColumn("_digit", t.rlike("[0-9]"))
    has_digit = F.col("_digit")
    rows = with_spans(rows, "_t", "_email", EMAIL, "email", 0, F.contains(t, F.lit("@")))
    rows = with_spans(rows, "_t", "_ip", IP, "ip", 1, has_digit)
    rows = with_spans(rows, "_t", "_card", CARD, "card", 2, has_digit)
    rows = with_spans(rows, "_t", "_phone", PHONE, "phone", 3, has_digit & F.contains(t, F.lit("+")))
    rows = with_spans(rows, "_t", "_iban", IBAN, "iban", 4, has_digit)
    rows = with_spans(rows, "_t", "_ssn", SSN, "ssn", 5, has_digit & F.contains(t, F.lit("-")))

    def card_ok(s: Column) -> Column:
        number = digits(s["value"])
        return F.when(F.length(number).between(14, 19), luhn_ok(number)).otherwise(False)

    tests = {
        "email": None,
        "ip": lambda s: s["value"].rlike(f"^{_BYTE}(?:\\.{_BYTE}){{3}}$"),
        "card": card_ok,
        "phone": lambda s: F.length(digits(s["value"])).between(10, 15),
        "iban": lambda s: mod97_ok(s["value"]),
        "ssn": None,
    }
    rows = rows.withColumns({
        f"_{k}": F.when(F.size(f"_{k}") > 0, F.filter(f"_{k}", test)).otherwise(F.col(f"_{k}"))
        for k, test in tests.items() if test})
    rows = rows.withColumns({f"_{k}": _scored(f"_{k}", "_t", k, context_chars) for k in tests})
    rows = rows.withColumns({f"_{k}": F.filter(f"_{k}", lambda s: s["score"] >= min_score) for k in ("iban", "ssn")})
    base = [F.col(f"_{k}") for k in ("email", "ip", "card", "phone")]
    every = [*base, F.col("_iban"), F.col("_ssn")]
    return rows.select(
        id_col, *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(as_text(by_place(*base)), 256).alias("base_sha256"),
        as_text(by_place(*every)).alias("spans"),
        F.size("_iban").cast("long").alias("n_iban"), F.size("_ssn").cast("long").alias("n_ssn"),
        F.array_max(F.transform(F.concat(*every), lambda s: s["score"])).alias("max_score"))
