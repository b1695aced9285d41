"""Format-preserving pseudonyms for personal data: DataFrame functions only.

Candidates are found by patterns and validated (Luhn, mod 97, calendar, octet and area ranges); what does not hold is left
as it is. A value is replaced by its image under a keyed permutation of its own format's values, an
alternating Feistel network whose round function is SHA-256 of (key, kind, round, other half):

* characters: each half's letters and digits are shifted within their class (0-9, a-z, A-Z) by amounts drawn
  from the other half; separators, length and case stay;
* numbers with a range (IPv4, days, social security numbers): two residues of A x B values are added to by turns.

Of cards, phones and IBANs the bare digits (letters) are permuted and written back between the separators found, of dates
the day, so a value has the same pseudonym in whichever of the known ways it is written. A phone's country code
stays, and its national number is permuted alike with and without one. Emails, access keys and secrets are told apart as written, case included.

So equal values have equal pseudonyms in all documents, different ones never share one, and check digits
and calendars hold. Whoever has the key can run the rounds backwards.

Known forms are those of ``PATTERNS``: IBANs bare or in groups of four; days as yyyy-MM-dd, dd.MM.yyyy and with
slashes, month first or, where that is no day, day first; secrets as a name (password, token, ...), = or : and 16 to 128
hexadecimal digits. Other forms (secrets of other letters, days with one-digit months or month names) are not found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Length of an IBAN by country. In printed groups the length tells where it ends.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_GROUPED = "|".join(
    f"(?:{'|'.join(names.split())})[0-9]{{2}}(?:[ -][A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (f"[ -][A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, names in IBAN_LENGTHS.items())
#: What the kinds look like. Order matters where two could start at one place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "iban": rf"(?<![A-Za-z0-9])(?:[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}|{_GROUPED})(?![A-Za-z0-9])",
    "access": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "secret": r"(?i:password|passwd|token|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?[0-9A-Fa-f]{16,128}(?![A-Za-z0-9])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/-]|\.[0-9])",
    "ip": r"(?<![0-9.])(?:(?:0|[1-9][0-9]{0,2})\.){3}(?:0|[1-9][0-9]{0,2})(?![0-9]|\.[0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "phone": r"(?<![A-Za-z0-9+])(?:(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}"
             r"|\+[0-9]{1,3}(?:[ .-][0-9]{2,4}){2,3})(?![0-9])",
}
ANY = "|".join(PATTERNS.values())
DAY_ZERO = "0001-01-01"
#: 400 Gregorian years have 146,097 = 189 x 773 days.
CYCLE = (189, 773)


def _draw(key: str, kind: str, turn: Column, other: Column) -> Column:
    """64 hexadecimal digits."""
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), other.cast("string")), 256)


def _number(hexes: Column, begin: Column, n: int) -> Column:
    return F.conv(F.substr(hexes, begin, F.lit(n)), 16, 10).cast("long")


def _chars(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.substr(s, i, F.lit(1)))
                  ).otherwise(F.array().cast("array<string>"))


def _shift(s: Column, drawn: Column, letters: int) -> Column:
    """Letters and digits moved within their class (the first ``letters`` letters) by drawn amounts."""

    def one(c: Column, i: Column) -> Column:
        by = _number(drawn, F.pmod(i * 2, F.lit(64)) + 1, 2)
        out = c
        for first, size in (("0", 10), ("a", letters), ("A", letters)):
            place = F.ascii(c) - ord(first)
            out = F.when((place >= 0) & (place < size), F.char(F.pmod(place + by, F.lit(size)) + ord(first))).otherwise(out)
        return out

    return F.array_join(F.transform(_chars(s), one), "")


def permute_chars(s: Column, key: str, kind: str, letters: int = 26) -> Column:
    """Keyed permutation of the strings of one shape (positions of digits, letters and all else)."""
    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), half).alias("l"), F.substr(s, half + 1, F.length(s)).alias("r"))

    def turn(a: Column, k: Column) -> Column:
        left = F.when(k % 2 == 0, _shift(a["l"], _draw(key, kind, k, a["r"]), letters)).otherwise(a["l"])
        right = F.when(k % 2 == 1, _shift(a["r"], _draw(key, kind, k, a["l"]), letters)).otherwise(a["r"])
        return F.struct(left.alias("l"), right.alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda a: F.concat(a["l"], a["r"]))


def permute_pair(a: Column, b: Column, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """Keyed permutation of the pairs a < sizes[0], b < sizes[1]: a struct of a and b."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def turn(x: Column, k: Column) -> Column:
        na = F.when(k % 2 == 0, F.pmod(x["a"] + _number(_draw(key, kind, k, x["b"]), F.lit(1), 14), F.lit(sizes[0]))).otherwise(x["a"])
        nb = F.when(k % 2 == 1, F.pmod(x["b"] + _number(_draw(key, kind, k, x["a"]), F.lit(1), 14), F.lit(sizes[1]))).otherwise(x["b"])
        return F.struct(na.cast("long").alias("a"), nb.cast("long").alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _bare(m: Column) -> Column:
    return F.regexp_replace(m, "[^A-Za-z0-9]", "")


def _refill(m: Column, bare: Column) -> Column:
    """``m`` with the characters of ``bare`` for its letters and digits, in order."""
    def one(c: Column, i: Column) -> Column:
        return F.when(c.rlike("[A-Za-z0-9]"), F.substr(bare, F.length(_bare(F.substr(m, F.lit(1), i + 1))), F.lit(1))).otherwise(c)

    return F.when(m == _bare(m), bare).otherwise(F.array_join(F.transform(_chars(m), one), ""))


def _luhn(digits: Column) -> Column:
    """The Luhn sum of digits, the last one not doubled."""
    return F.aggregate(F.transform(_chars(F.reverse(digits)), lambda c, i: F.when(
        i % 2 == 1, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5)).otherwise(c.cast("int")).cast("int")),
        F.lit(0), lambda a, x: a + x)


def _mod97(s: Column) -> Column:
    return F.aggregate(_chars(s), F.lit(0), lambda a, c: F.when(
        F.ascii(c) < 58, (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97).cast("int"))


def _held(value: Column, then) -> Column:
    """``then`` of a value that is worked out once."""
    return F.transform(F.array(value), then)[0]


def _card(m: Column, key: str) -> Column:
    def new(digits: Column) -> Column:
        body = permute_chars(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")
        whole = _held(body, lambda x: F.concat(x, F.pmod(-_luhn(F.concat(x, F.lit("0"))), F.lit(10)).cast("string")))
        return F.when(_luhn(digits) % 10 == 0, _held(whole, lambda x: _refill(m, x))).otherwise(m)

    return _held(_bare(m), new)


def _iban(m: Column, key: str) -> Column:
    def new(bare: Column) -> Column:
        rest, country = F.substr(bare, F.lit(5), F.length(bare)), F.substr(bare, F.lit(1), F.lit(2))
        whole = _held(permute_chars(rest, key, "iban"), lambda x: F.concat(
            country, F.lpad((98 - _mod97(F.concat(x, country, F.lit("00")))).cast("string"), 2, "0"), x))
        valid = _mod97(F.concat(rest, F.substr(bare, F.lit(1), F.lit(4)))) == 1
        return F.when(valid, _held(whole, lambda x: _refill(m, x))).otherwise(m)

    return _held(_bare(m), new)


#: A phone's country code before an area code, three and four digits; or before any groups.
_COUNTRY = (r"^(\+[0-9]{1,3}?[ .-]?)(?:\([0-9]{2,4}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}$", r"^(\+[0-9]{1,3}[ .(-])")


def _phone(m: Column, key: str) -> Column:
    area, any_ = (F.length(F.regexp_extract(m, p, 1)) for p in _COUNTRY)
    after = F.when(area > 0, area).otherwise(any_)
    return _held(F.substr(m, after + 1, F.length(m)), lambda x: F.concat(
        F.substr(m, F.lit(1), after), _held(permute_chars(_bare(x), key, "phone"), lambda new: _refill(x, new))))


def _ip(m: Column, key: str) -> Column:
    octet = [F.get(F.split(m, r"\."), F.lit(k)).cast("long") for k in range(4)]
    new = permute_pair(octet[0] * 256 + octet[1], octet[2] * 256 + octet[3], (65536, 65536), key, "ip")
    out = F.transform(F.array(new), lambda x: F.concat_ws(".", *(v.cast("long").cast("string") for v in (
        F.floor(x["a"] / 256), x["a"] % 256, F.floor(x["b"] / 256), x["b"] % 256))))[0]
    return F.when(F.greatest(*octet) < 256, out).otherwise(m)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.get(F.split(m, "-"), F.lit(k)).cast("long") for k in range(3))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    new = permute_pair(area - 1 - (area > 666).cast("long"), (group - 1) * 9999 + serial - 1, (898, 99 * 9999), key, "ssn")

    def write(x: Column) -> Column:
        top = x["a"] + 1
        top = top + (top >= 666).cast("long")
        return F.concat_ws("-", F.lpad(top.cast("string"), 3, "0"),
                           F.lpad((F.floor(x["b"] / 9999) + 1).cast("long").cast("string"), 2, "0"),
                           F.lpad((x["b"] % 9999 + 1).cast("string"), 4, "0"))

    return F.when(valid, F.transform(F.array(new), write)[0]).otherwise(m)


def _date(m: Column, key: str) -> Column:
    """Days are permuted within their 400 years (0001-0400, ..., 2001-2400); 9601 and later stay.

    Slash dates are read month first, and day first where that is no day. A day-first date is written day first
    if it is then read so again, else month first: what is written is always read as the new day."""
    def day(pattern: str) -> Column:
        found = F.try_to_timestamp(m, F.lit(pattern)).cast("date")
        # A date counts if it is written back as it was read.
        return F.when(F.date_format(found, pattern) == m, found)

    def moved(number: Column) -> Column:
        cycle, rest = F.floor(number / 146_097).cast("int"), F.pmod(number, F.lit(146_097))
        new = permute_pair(F.floor(rest / CYCLE[1]), rest % CYCLE[1], CYCLE, key, "date")
        return _held(new, lambda x: F.when((number >= 0) & (cycle < 24), F.date_add(
            F.lit(DAY_ZERO).cast("date"), (cycle * 146_097 + x["a"] * CYCLE[1] + x["b"]).cast("int"))))

    def written(x: Column) -> Column:
        first = x["month_first"] | (F.dayofmonth(x["new"]) <= 12)
        return F.coalesce(F.when(m.rlike("^[0-9]{4}-"), F.date_format(x["new"], "yyyy-MM-dd")).when(
            m.contains("."), F.date_format(x["new"], "dd.MM.yyyy")).when(
            first, F.date_format(x["new"], "MM/dd/yyyy")).otherwise(F.date_format(x["new"], "dd/MM/yyyy")), m)

    month = F.when(m.contains("/"), day("MM/dd/yyyy"))
    read = F.when(m.rlike("^[0-9]{4}-"), day("yyyy-MM-dd")).when(m.contains("."), day("dd.MM.yyyy")).otherwise(
        F.coalesce(month, day("dd/MM/yyyy")))
    number = F.datediff(read, F.lit(DAY_ZERO).cast("date"))
    return _held(_held(number, lambda n: F.struct(moved(n).alias("new"), month.isNotNull().alias("month_first"))), written)


def _pseudonym(m: Column, key: str) -> Column:
    head = F.length(F.regexp_extract(m, r"^(.*[=:]\s*[\"']?)", 1))
    at = F.instr(m, "@")
    kinds = {
        "email": F.concat(permute_chars(F.substr(m, F.lit(1), at - 1), key, "email"), F.substr(m, at, F.length(m))),
        "access": F.concat(F.lit("AKIA"), permute_chars(F.substr(m, F.lit(5), F.length(m)), key, "access")),
        "iban": _iban(m, key),
        "secret": F.concat(F.substr(m, F.lit(1), head), permute_chars(F.substr(m, head + 1, F.length(m)), key, "secret", 6)),
        "date": _date(m, key),
        "ip": _ip(m, key),
        "ssn": _ssn(m, key),
        "card": _card(m, key),
    }
    out = _phone(m, key)
    for kind in reversed(["email", "access", "iban", "secret", "date", "ip", "ssn", "card"]):
        bare = {"email": "@", "secret": r"[=:]\s*[\"']?[0-9A-Fa-f]+$"}.get(kind)
        whole = rf"^(?:{_inner(kind)})$" if bare is None else bare
        out = F.when(m.rlike(whole), kinds[kind]).otherwise(out)
    return out


def _inner(kind: str) -> str:
    """A kind's pattern without what has to stand around it."""
    pattern = PATTERNS[kind]
    return pattern[pattern.index(")") + 1:pattern.rindex("(?!")]


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with ``text`` rewritten, plus n_found (candidates) and n_replaced (values replaced, each occurrence).

    Null texts stay null with counts 0; texts without a candidate are unchanged, character for character. Columns
    n_found and n_replaced of ``docs`` are replaced, all others kept. Rows are independent: no shuffle.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    some = body.rlike("[0-9@]")
    none = F.array().cast("array<string>")
    out = docs.withColumn("_pii_found", F.when(some, F.regexp_extract_all(body, F.lit(ANY), F.lit(0))).otherwise(none))
    out = out.withColumn("_pii_new", F.transform("_pii_found", lambda m: _pseudonym(m, key)))
    found, new = F.col("_pii_found"), F.col("_pii_new")
    pieces = F.split(F.col(text), ANY, -1)
    joined = F.array_join(F.transform(pieces, lambda p, i: F.concat(p, F.coalesce(F.get(new, i), F.lit("")))), "")
    changed = F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x))
    return out.withColumns({
        text: F.when(F.size(found) > 0, joined).otherwise(F.col(text)),
        "n_found": F.size(found).cast("long"), "n_replaced": changed.cast("long"),
    }).drop("_pii_found", "_pii_new")
