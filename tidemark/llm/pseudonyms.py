"""Personal data under format-preserving pseudonyms, all in SQL functions.

One pattern finds candidates; each is validated by its kind's own rule and then
moved by a keyed permutation of all values of its format, a Feistel network of
eight rounds whose round function is SHA-256 over the key, the kind, the round
and the other half. Equal values get equal pseudonyms in all documents, different
ones different pseudonyms, and nothing is stored.

kind     validated by                                permuted
card     13 to 19 digits in groups, Luhn sum         all digits but the last, which is the new check digit
iban     length, remainder 1 modulo 97               digits after the check digits, which are made anew
ssn      ddd-dd-dddd, no impossible group            area, group and number among the possible ones
phone    + and 8 to 15 digits, or ddd ddd dddd       digits after the country code
ip       four numbers up to 255                      all 32 bits
date     a day of the years 1800 to 2199             days of these 400 years (146,097 = 189 x 773)
email    name@domain                                 letters and digits of the name, base 36
secret   32 or more hex digits, quoted, assigned     hex digits

A value's signs (spaces, dashes, points, leading zeros) stay as they were written and
do not matter for the pseudonym, so one number in two spellings stays one number.
The key has no default and decides everything: whoever has it can undo the
pseudonyms. It is a literal of the plan, so keep plans and event logs as secret as it.

Candidates that fail their rule (a number that is no card, a version number) stay
as they are. A null text stays null, an empty one empty; texts and secrets may be of any
length. Rows that repeat a doc_id are handled one by one, an empty table gives no
rows; extra columns are ignored. There is no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Characters permuted together; longer values are cut into such pieces.
PIECE = 18
KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email", "secret")

#: Length of an IBAN by country (fixed values, ISO 13616).
IBAN_LENGTHS = {
    "NO": 15, "BE": 16, "DK": 18, "FI": 18, "FO": 18, "GL": 18, "NL": 18, "MK": 19, "SI": 19, "AT": 20, "BA": 20, "EE": 20,
    "KZ": 20, "LT": 20, "LU": 20, "XK": 20, "CH": 21, "HR": 21, "LI": 21, "LV": 21, "BG": 22, "BH": 22, "CR": 22, "DE": 22,
    "GB": 22, "GE": 22, "IE": 22, "ME": 22, "RS": 22, "VA": 22, "AE": 23, "GI": 23, "IL": 23, "IQ": 23, "TL": 23, "AD": 24,
    "CZ": 24, "ES": 24, "MD": 24, "PK": 24, "RO": 24, "SA": 24, "SE": 24, "SK": 24, "TN": 24, "VG": 24, "LY": 25, "PT": 25,
    "ST": 25, "IS": 26, "TR": 26, "FR": 27, "GR": 27, "IT": 27, "MC": 27, "MR": 27, "SM": 27, "AL": 28, "AZ": 28, "BY": 28,
    "CY": 28, "DO": 28, "GT": 28, "HU": 28, "LB": 28, "PL": 28, "SV": 28, "BR": 29, "EG": 29, "PS": 29, "QA": 29, "UA": 29,
    "JO": 30, "KW": 30, "MU": 30, "MT": 31, "SC": 31, "LC": 32,
}
#: Country codes of telephone numbers of one and two digits; all others have three (fixed values, ITU E.164).
CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()

_EDGE, _STOP = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
_LEFT = {
    "email": r"(?<![A-Za-z0-9._%+-])",
    "secret": r"(?<=[=:] ?[\"'])",
    "ip": r"(?<![\p{L}\p{N}.])",
    "phone": r"(?<![\p{L}\p{N}+.-])",
    "card": r"(?<![\p{L}\p{N}.-])",
}
_RIGHT = {"secret": r"(?=[\"'])", "ip": r"(?!\.?[\p{L}\p{N}])", "phone": r"(?![.-]?[\p{L}\p{N}])", "card": r"(?!-?[\p{L}\p{N}])"}


def _ibans() -> str:
    """Compact, or with single spaces or dashes between any two characters, as long as the country's are."""
    by_length: dict[int, list[str]] = {}
    for country, length in IBAN_LENGTHS.items():
        by_length.setdefault(length, []).append(country)
    known = [f"(?:{'|'.join(names)})[ -]?[0-9]{{2}}(?:[ -]?[A-Z0-9]){{{n - 4}}}" for n, names in by_length.items()]
    return "|".join([*known, "[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}"])


#: Each kind's written forms; what may not stand beside them is in ``_LEFT`` and ``_RIGHT``.
FORMS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "secret": r"[0-9A-Fa-f]{32,}+",
    "ip": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
    "iban": _ibans(),
    "date": r"[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|\+[0-9]{8,15}|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}"
    r"|[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4}",
    "card": r"[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}|[0-9]{13,19}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5}|[0-9]{2,7}(?:[ -][0-9]{2,7}){2,6}",
}
PATTERNS = {kind: f"{_LEFT.get(kind, _EDGE)}(?:{form}){_RIGHT.get(kind, _STOP)}" for kind, form in FORMS.items()}
ANY = "|".join(PATTERNS.values())


def _round(key: str, kind: str, i: Column, half: Column, tweak: Column) -> Column:
    text = F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), tweak.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(a: Column, b: Column, of_a: Column, of_b: Column, key: str, kind: str, tweak: Column) -> Column:
    """A permutation of all pairs (a below of_a, b below of_b), as a struct of a and b."""

    def step(s: Column, i: Column) -> Column:
        new_a = F.pmod(s["a"] + _round(key, kind, i, s["b"], tweak), of_a)
        new_b = F.pmod(s["b"] + _round(key, kind, i, s["a"], tweak), of_b)
        even = i % 2 == 0
        return F.struct(F.when(even, new_a).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(new_b).alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def permute(text: Column, base: int, key: str, kind: str) -> Column:
    """A permutation of all strings of this length over the digits of ``base``, in lower case."""

    def piece(part: Column, tweak: Column) -> Column:
        size = F.length(part)
        left = F.floor(size / 2).cast("int")
        right = size - left

        def number(x):
            return F.coalesce(F.conv(x, base, 10).cast("long"), F.lit(0))

        def power(n):
            return F.pow(F.lit(float(base)), n).cast("long")

        def digits(x, n):
            shown = F.lower(F.conv(x.cast("string"), 10, base))
            return F.when(n == 0, "").otherwise(F.lpad(shown, n, "0"))

        moved = feistel(
            number(part.substr(F.lit(1), left)), number(part.substr(left + 1, right)), power(left), power(right), key, f"{kind}{base}", F.concat_ws("/", size.cast("string"), tweak.cast("string"))
        )
        return _let(moved, lambda m: F.concat(digits(m["a"], left), digits(m["b"], right)))

    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(PIECE))
    parts = F.transform(starts, lambda s: F.struct(text.substr(s, F.lit(PIECE)).alias("part"), s.alias("at")))
    return F.array_join(F.transform(parts, lambda p: piece(p["part"], p["at"])), "")


def refill(shape: Column, which: str, new: Column) -> Column:
    """``shape`` with its characters of the class ``which`` replaced by those of ``new``, in order."""

    def step(s: Column, c: Column) -> Column:
        hit = c.rlike(which)
        put = new.substr(s["at"], F.lit(1))
        put = F.when(c.rlike("[A-Z]"), F.upper(put)).otherwise(put)
        return F.struct(F.concat(s["out"], F.when(hit, put).otherwise(c)).alias("out"), F.when(hit, s["at"] + 1).otherwise(s["at"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    return F.aggregate(F.split(shape, ""), start, step, lambda s: s["out"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The Luhn sum, modulo 10."""
    places = F.sequence(F.lit(0), F.length(digits) - 1)

    def add(total: Column, i: Column) -> Column:
        d = digits.substr(F.length(digits) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(places, F.lit(0), add) % 10


def _mod97(text: Column) -> Column:
    """Remainder of an IBAN with its first four characters moved to the end; letters count from 10."""
    turned = F.concat(text.substr(F.lit(5), F.length(text)), text.substr(1, 4))

    def add(r: Column, c: Column) -> Column:
        value = F.conv(c, 36, 10).cast("int")
        return (r * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.split(turned, ""), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    d = _digits(m)
    valid = F.length(d).between(13, 19) & (luhn(d) == 0)
    body = permute(d.substr(F.lit(1), F.length(d) - 1), 10, key, "card")
    full = _let(body, lambda b: F.concat(b, F.pmod(10 - luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
    return F.when(valid, refill(m, "[0-9]", full))


def _iban(m: Column, key: str) -> Column:
    def made(bare: Column) -> Column:
        tail = bare.substr(F.lit(5), F.length(bare))
        moved = refill(tail, "[0-9]", permute(_digits(tail), 10, key, "iban"))
        new = _let(moved, lambda t: F.concat(bare.substr(1, 2), F.lpad((98 - _mod97(F.concat(bare.substr(1, 2), F.lit("00"), t))).cast("string"), 2, "0"), t))
        return F.when((_mod97(bare) == 1) & F.length(bare).between(15, 34), refill(m, "[A-Z0-9]", new))

    return _let(F.regexp_replace(m, "[ -]", ""), made)


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99 and numbers 0001 to 9999, counted without the gaps."""
    valid = ~m.rlike("^(000|666|9)|-00-|-0000$")
    area, group, number = (m.substr(a, n).cast("int") for a, n in ((1, 3), (5, 2), (8, 4)))
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    moved = feistel(place, (group - 1) * 9999 + number - 1, F.lit(898), F.lit(99 * 9999), key, "ssn", F.lit(""))

    def written(s: Column) -> Column:
        shown = s["a"] + 1 + F.when(s["a"] + 1 >= 666, 1).otherwise(0)
        parts = ((shown, 3), (F.floor(s["b"] / 9999) + 1, 2), (s["b"] % 9999 + 1, 4))
        return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in parts])

    return F.when(valid, _let(moved, written))


def _phone(m: Column, key: str) -> Column:
    """Digits after the country code, however they are grouped; numbers without one as a whole."""
    digits = _digits(m)
    size = F.when(~m.startswith("+"), 0)
    for n in (1, 2):
        size = size.when(digits.substr(1, n).isin([c for c in CODES if len(c) == n]), n)

    def made(n: Column) -> Column:
        rest = digits.substr(n + 1, F.length(digits))
        return refill(m, "[0-9]", F.concat(digits.substr(F.lit(1), n), permute(rest, 10, key, "phone")))

    return F.when(F.length(digits).between(8, 15), _let(size.otherwise(3), made))


def _ip(m: Column, key: str) -> Column:
    n = F.transform(F.split(m, r"\."), lambda x: x.cast("int"))
    moved = feistel(n[0] * 256 + n[1], n[2] * 256 + n[3], F.lit(65536), F.lit(65536), key, "ip", F.lit(""))
    new = _let(moved, lambda s: F.concat_ws(".", *(F.floor(s[h] / d).cast("int") % 256 for h in "ab" for d in (256, 1))))
    return F.when((F.array_max(n) <= 255) & ~m.rlike(r"(^|\.)0[0-9]"), new)


def _date(m: Column, key: str) -> Column:
    """ISO, or day and month and year with strokes or points; month first where only that is a day.

    Days and months below ten have a zero if they had one, or had none to show.
    """
    first = F.lit("1800-01-01").cast("date")

    def moved(day: Column) -> Column:
        n = F.datediff(day, first)
        inside = n.between(0, 146096)
        pair = feistel(F.floor(n / 773), F.pmod(n, F.lit(773)), F.lit(189), F.lit(773), key, "date", F.lit(""))
        return F.when(inside, _let(pair, lambda s: F.date_add(first, (s["a"] * 773 + s["b"]).cast("int"))))

    def day(y, mo, d):
        return F.concat_ws("-", y, F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")).try_cast("date")

    def made(parts: Column) -> Column:
        a, b, c = parts[0], parts[1], parts[2]
        iso = m.rlike("^[0-9]{4}-")
        sign = F.regexp_extract(m, "[-/.]", 0)
        short = m.rlike("(^|[-/.])[0-9]([-/.]|$)")

        def shown(x: Column, *letters: str) -> Column:
            def part(letter: str) -> Column:
                if letter == "y":
                    return F.date_format(x, "yyyy")
                return F.when(short, F.date_format(x, letter)).otherwise(F.date_format(x, letter * 2))

            return F.concat_ws("/", *map(part, letters))

        days = F.when(iso, moved(day(a, b, c))).when(day(c, b, a).isNotNull(), moved(day(c, b, a))).otherwise(moved(day(c, a, b)))
        front = ~iso & day(c, b, a).isNull()
        written = _let(days, lambda x: F.when(x.isNotNull(), F.when(iso, shown(x, "y", "M", "d")).when(front, shown(x, "M", "d", "y")).otherwise(shown(x, "d", "M", "y"))))
        return F.replace(written, F.lit("/"), sign)

    return _let(F.split(m, "[-/.]"), made)


def _email(m: Column, key: str) -> Column:
    name = F.substring_index(m, "@", 1)
    bare = F.lower(F.regexp_replace(name, "[^A-Za-z0-9]", ""))
    new = F.regexp_replace(refill(F.lower(name), "[a-z0-9]", permute(bare, 36, key, "email")), "[^a-z0-9._%+-]", "")
    return F.concat(new, F.lit("@"), F.substring_index(m, "@", -1))


def _secret(m: Column, key: str) -> Column:
    return refill(m, "[0-9A-Fa-f]", permute(F.lower(m), 16, key, "secret"))


_MAKERS = {"card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "ip": _ip, "date": _date, "email": _email, "secret": _secret}


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text with pseudonyms, n_private, and the number of each kind (n_card ...)."""

    def one(m: Column) -> Column:
        """The kind whose rule the candidate passes first, and its pseudonym."""
        made = [F.when(m.rlike(f"^(?:{FORMS[k]})$"), F.struct(F.lit(k).alias("kind"), _MAKERS[k](m, key).alias("new"))) for k in FORMS]
        valid = [F.when(x["new"].isNotNull(), x) for x in made]
        return F.coalesce(*valid, F.struct(F.lit(None).cast("string").alias("kind"), m.alias("new")))

    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    some = F.col("text").rlike("[0-9@]")
    found = F.when(some, F.transform(F.regexp_extract_all("text", F.lit(f"({ANY})"), 1), one))
    rows = rows.withColumn("found", found)
    gaps = F.split("text", ANY, -1)
    new = F.array_join(F.zip_with(gaps, F.concat(F.transform("found", lambda x: x["new"]), F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")

    def number_of(kind: str) -> Column:
        return F.coalesce(F.size(F.filter("found", lambda x: x["kind"] == kind)), F.lit(0)).alias(f"n_{kind}")

    kinds = [number_of(kind) for kind in KINDS]
    total = F.coalesce(F.size(F.filter("found", lambda x: x["kind"].isNotNull())), F.lit(0)).alias("n_private")
    changed = F.when(F.size("found") > 0, new).otherwise(F.col("text"))
    return rows.select("doc_id", changed.alias("text"), total, *kinds)

