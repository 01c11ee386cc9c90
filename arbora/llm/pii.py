"""Personal data: format-preserving Feistel pseudonyms.

Validated values are permuted under a key within their format, so that a pseudonym is a valid value of the same kind, equal
values stay linked across documents, and different ones stay different.  A Feistel network over (L, R) in Z_a x Z_b adds a
keyed hash of one half to the other, in turns, so it is a permutation for any a and b:

* card numbers: 13 to 19 digits with a right Luhn sum, unbroken, in the usual groups (parted by blanks, hyphens or dots), or
  in up to four others behind an issuer's first digit; all but the check digit, which is computed anew;
* telephone numbers: +country code and 7 to 12 more digits, ten digits as (3) 3-4 or 3-3-4, or a national number of 10 or 11
  digits in groups behind a 0; the country code, a national number's first two digits and all punctuation stay;
* US social security numbers: within the valid areas, groups and serials; without hyphens behind their name only;
* IPv4 addresses: four numbers up to 255, as 32 bits; IPv6 addresses: hexadecimal digits as such, colons stay;
* IBANs with a right remainder, in capital or small letters: letters as letters, digits as digits, the check digits computed
  anew;
* dates from 1900 to 9999: year first, day first, or month first where that alone is a day, with `-`, `/` or `.`, with or
  without zeros before single digits; or with an English month; the day's number, of 270 x 270 from 1900-01-01 on, and so on
  in each 270 x 270 days;
* e-mail addresses: the local part, letters as letters (ASCII's of the same case, others of their block of 32, Latin-1's
  among themselves), digits as digits; the domain stays;
* secrets behind `token =`, `secret_key:` and the like: hexadecimal digits, 16 or more, as such; other words of 4 characters or
  more that hold a digit, or of 6 without one; behind `password is` words of 6 with a digit, behind `Bearer` of 16; letters
  as letters and digits as digits.

The keyed hash is HMAC-SHA256.  All of it is built-in functions.
"""

from __future__ import annotations

import datetime
import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: The country codes of one and of two digits; all others have three.
COUNTRY_CODES = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def keyed(key: str, tag: str, i: Column, value: Column) -> Column:
    """HMAC-SHA256 of tag, i and value, as 64 hexadecimal digits."""
    secret = key.encode()
    secret = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ x for b in secret)) for x in (0x36, 0x5C))
    message = F.encode(F.concat_ws("|", F.lit(tag), i.cast("string"), value.cast("string")), "UTF-8")
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256)


def halves(left: Column, right: Column, a: Column, b: Column, key: str, tag: str) -> Column:
    """The network on (left, right), below a and b: a struct (l, r)."""
    h = lambda i, x: F.conv(F.substring(keyed(key, tag, i, x), 1, 14), 16, 10).cast("long")

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, (s["l"] + h(i, s["r"])) % a).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise((s["r"] + h(i, s["l"])) % b).alias("r"))

    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), F.struct(left.alias("l"), right.alias("r")), turn)


def permuted(n: Column, a: int, b: int, key: str, tag: str) -> Column:
    """A number below a x b -> another, by a permutation."""
    at = lambda n: halves(((n - n % b) / b).cast("long"), n % b, F.lit(a).cast("long"), F.lit(b).cast("long"), key, tag)
    return let(let(n, at), lambda s: s["l"] * b + s["r"])


def respelt(word: Column, key: str, tag: str, shifted: Callable[[Column, Column], Column]) -> Column:
    """A word's halves, each shifted in turns, character by character, by keyed hashes of the other: one for every 16
    characters, so that shifts don't repeat."""

    def shift(half: Column, i: Column, other: Column) -> Column:
        by = lambda hs, j: F.conv(F.substring(F.element_at(hs, F.floor(j / 16).cast("int") + 1), (j % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
        hashes = F.transform(F.sequence(F.lit(0), F.floor(F.length(half) / 16).cast("int")), lambda n: keyed(key, tag, i, F.concat_ws("|", n.cast("string"), other)))
        return let(hashes, lambda hs: F.array_join(F.transform(F.split(half, ""), lambda c, j: F.when(c == "", c).otherwise(shifted(c, by(hs, j)))), ""))

    def turn(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, shift(s["l"], i, s["r"])).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(shift(s["r"], i, s["l"])).alias("r"))

    cut = F.floor(F.length(word) / 2).cast("int")
    start = F.struct(F.substring(word, F.lit(1), cut).alias("l"), F.substring(word, cut + 1, F.length(word)).alias("r"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, turn, lambda s: F.concat(s["l"], s["r"]))


def alphanumeric(c: Column, by: Column) -> Column:
    within = lambda first, n: F.char((F.ascii(c) - ord(first) + by) % n + ord(first))
    return F.when(c.between("a", "z"), within("a", 26)).when(c.between("A", "Z"), within("A", 26)).when(c.between("0", "9"), within("0", 10)).otherwise(c)


#: Latin-1's letters beyond ASCII.
SMALL, LARGE = ("".join(chr(i) for i in range(a, z) if i not in (0xD7, 0xF7)) for a, z in ((0xDF, 0x100), (0xC0, 0xDF)))


def lettered(c: Column, by: Column) -> Column:
    """As alphanumeric, and letters beyond ASCII: Latin-1's of a case as such, others within their block of 32."""
    of = lambda letters: F.substring(F.lit(letters), (F.instr(F.lit(letters), c) - 1 + by) % len(letters) + 1, F.lit(1))
    within = let(F.ascii(c), lambda n: F.decode(F.unhex(F.lpad(F.hex((n - n % 32 + (n % 32 + by) % 32).cast("long")), 8, "0")), "UTF-32"))
    beyond = F.when(F.instr(F.lit(SMALL), c) > 0, of(SMALL)).when(F.instr(F.lit(LARGE), c) > 0, of(LARGE)).otherwise(within)
    return F.when((F.ascii(c) < 128) | ~c.rlike(r"[\p{L}\p{N}]"), alphanumeric(c, by)).otherwise(beyond)


def mixed_hexadecimal(c: Column, by: Column) -> Column:
    """Hexadecimal digits of both cases: digits as digits, letters as letters of their case."""
    within = lambda first, n: F.char((F.ascii(c) - ord(first) + by) % n + ord(first))
    return F.when(c.between("a", "f"), within("a", 6)).when(c.between("A", "F"), within("A", 6)).otherwise(within("0", 10))


def hexadecimal(c: Column, by: Column) -> Column:
    return F.substring(F.lit("0123456789abcdef"), (F.instr(F.lit("0123456789abcdef"), c) - 1 + by) % 16 + 1, F.lit(1))


def refilled(template: Column, new: Column, of: str = "^[0-9]$") -> Column:
    """The template with its digits (or what `of` says) replaced, in order."""
    return let(new, lambda digits: F.aggregate(
        F.split(template, ""), F.struct(F.lit(1).alias("p"), F.lit("").alias("o")),
        lambda s, c: F.when(c.rlike(of), F.struct((s["p"] + 1).alias("p"), F.concat(s["o"], F.substring(digits, s["p"], F.lit(1))).alias("o"))).otherwise(F.struct(s["p"].alias("p"), F.concat(s["o"], c).alias("o"))),
        lambda s: s["o"],
    ))


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column, double_last: bool) -> Column:
    """The sum of digits, every second doubled, from the last (which is doubled if told so)."""
    twice = F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)])
    of = lambda d, j: F.when(j % 2 == (0 if double_last else 1), F.element_at(twice, d + 1)).otherwise(d)
    values = F.transform(F.filter(F.split(F.reverse(number), ""), lambda c: c != ""), lambda c, j: let(c.cast("int"), lambda d: of(d, j)))
    return F.aggregate(values, F.lit(0), lambda s, v: s + v)


def power(k: Column) -> Column:
    return F.element_at(F.array(*[F.lit(10**i).cast("long") for i in range(11)]), k + 1)


def renumbered(d: Column, key: str, tag: str) -> Column:
    """A string of 2 to 20 digits as another of the same length, by the network on its halves."""
    n = F.length(d)
    k = F.floor(n / 2).cast("int")
    s = halves(F.substring(d, F.lit(1), k).cast("long"), F.substring(d, k + 1, n - k).cast("long"), power(k), power(n - k), key, tag)
    return let(s, lambda s: F.concat(F.lpad(s["l"].cast("string"), k, F.lit("0")), F.lpad(s["r"].cast("string"), n - k, F.lit("0"))))


Kind = tuple[str, str, str, Callable[[Column], Column] | None, Callable[[Column, str], Column]]


def card_ok(m: Column) -> Column:
    return let(digits_of(m), lambda d: F.length(d).between(13, 19) & (luhn(d, False) % 10 == 0) & (F.replace(d, F.lit("0"), F.lit("")) != ""))


def card(m: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        joined = renumbered(F.substring(d, F.lit(1), F.length(d) - 1), key, "card")
        return let(joined, lambda x: F.concat(x, ((10 - luhn(x, True) % 10) % 10).cast("string")))

    return refilled(m, let(digits_of(m), new))


def phone(m: Column, key: str) -> Column:
    def new(d: Column) -> Column:
        code = F.when(~m.startswith("+"), 0).when(d.rlike(COUNTRY_CODES), F.length(F.regexp_extract(d, COUNTRY_CODES, 0))).otherwise(3)
        return let(code, lambda n: F.concat(F.substring(d, F.lit(1), n), renumbered(F.substring(d, n + 1, F.length(d)), key, "phone")))

    return refilled(m, let(digits_of(m), new))


def national_ok(m: Column) -> Column:
    return F.length(digits_of(m)).between(10, 11)


def national(m: Column, key: str) -> Column:
    return refilled(m, let(digits_of(m), lambda d: F.concat(F.substring(d, 1, 2), renumbered(F.substring(d, F.lit(3), F.length(d)), key, "phone"))))


def ssn_ok(m: Column) -> Column:
    return ~m.rlike("^(?:000|666|9)|-00-|-0000$")


def ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substring(m, *x).cast("long") for x in ((1, 3), (5, 2), (8, 4)))
    n = ((area - 1 - (area > 666).cast("long")) * 99 + group - 1) * 9999 + serial - 1
    place = lambda p: F.floor(p / (99 * 9999)).cast("long")
    spelt = lambda p: F.format_string("%03d-%02d-%04d", place(p) + 1 + (place(p) >= 665).cast("long"), F.floor(p / 9999).cast("long") % 99 + 1, p % 9999 + 1)
    return let(permuted(n, 898 * 99, 9999, key, "ssn"), spelt)


#: The nine digits of a social security number without hyphens.
NINE = r"[0-9]{3}[ .]?[0-9]{2}[ .]?[0-9]{4}$"


def hyphened(m: Column) -> Column:
    return let(digits_of(F.regexp_extract(m, NINE, 0)), lambda d: F.concat_ws("-", F.substring(d, 1, 3), F.substring(d, 4, 2), F.substring(d, 6, 4)))


def named_ssn(m: Column, key: str) -> Column:
    told = F.regexp_extract(m, NINE, 0)
    return F.concat(F.substring(m, F.lit(1), F.length(m) - F.length(told)), refilled(told, digits_of(ssn(hyphened(m), key))))


def octets(m: Column) -> list[Column]:
    return [F.element_at(F.split(m, r"\."), i).cast("long") for i in (1, 2, 3, 4)]


def address(m: Column, key: str) -> Column:
    o = octets(m)
    new = permuted(((o[0] * 256 + o[1]) * 256 + o[2]) * 256 + o[3], 65_536, 65_536, key, "ip")
    return let(new, lambda n: F.concat_ws(".", *[(F.shiftright(n, s) % 256).cast("string") for s in (24, 16, 8, 0)]))


FIRST, DAYS = "1900-01-01", 270
#: Days from FIRST to the end of 9999, and how many of them are in no whole cycle.
TOTAL = (datetime.date(9999, 12, 31) - datetime.date.fromisoformat(FIRST)).days + 1
CYCLE = DAYS * DAYS
REST = TOTAL % CYCLE


def day(plain: Column, order: str) -> Column:
    """The number of a day that is written with hyphens, from FIRST on; null if there is no such day."""
    return F.datediff(F.to_date(F.try_to_timestamp(plain, F.lit(order))), F.lit(FIRST).cast("date"))


def moved(n: Column, key: str) -> Column:
    """Another day of the same cycle, as a date; what is left behind the last cycle is turned round by a keyed number."""
    whole = permuted(n % CYCLE, DAYS, DAYS, key, "date") + n - n % CYCLE
    rest = permuted(n - (TOTAL - REST), REST, 1, key, "date") + (TOTAL - REST)
    return F.date_add(F.lit(FIRST).cast("date"), F.when(n < TOTAL - REST, whole).otherwise(rest).cast("int"))


def in_days(*orders: str) -> Callable[[Column], Column]:
    plain = lambda m: F.regexp_replace(m, "[^0-9]", "-")
    return lambda m: F.coalesce(*[F.when(day(plain(m), o).between(0, TOTAL - 1), F.lit(True)) for o in orders], F.lit(False))


def either_way(bare: Column, order: str, full: str) -> Callable[[Column], Column]:
    return lambda d: F.when(bare, F.date_format(d, order)).otherwise(F.date_format(d, full))


def dated(*orders: str) -> Callable[[Column, str], Column]:
    """A pseudonym in the first of the orders in which there is such a day, without zeros before single digits where there is one without."""

    def new(m: Column, key: str) -> Column:
        bare, mark = m.rlike("(?:^|[^0-9])[0-9](?:[^0-9]|$)"), F.regexp_extract(m, "[^0-9]", 0)
        out = F.lit(None).cast("string")
        for order in reversed(orders):
            date = moved(day(F.regexp_replace(m, "[^0-9]", "-"), order).cast("long"), key)
            full = order.replace("d", "dd").replace("M", "MM")
            spelt = let(date, either_way(bare, order, full))
            out = F.when(in_days(order)(m), F.replace(spelt, F.lit("-"), mark)).otherwise(out)
        return out

    return new


#: English months.
MONTH = "(?i:Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sept?(?:ember)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
ORDINAL = "(?i:st|nd|rd|th)"
#: Day and month first: what stands before the day, the day, its ending, and so on to the year.
DAY_MONTH = rf"^()([0-9]{{1,2}})({ORDINAL}?)(\s+(?i:of\s+)?)({MONTH})(\.?,?\s+)([0-9]{{4}})$"
MONTH_DAY = rf"^({MONTH})(\.?\s+)([0-9]{{1,2}})({ORDINAL}?)(,?\s+)([0-9]{{4}})$"


def in_words(m: Column) -> tuple[Column, Column, Column]:
    """Day, month and year of a date with the month's name, as text."""
    first = m.rlike("^[0-9]")
    part = lambda i, j: F.when(first, F.regexp_extract(m, DAY_MONTH, i)).otherwise(F.regexp_extract(m, MONTH_DAY, j))
    month = F.floor(F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.lower(F.substring(part(5, 1), 1, 3))) / 3 + 1).cast("string")
    return part(2, 3), month, part(7, 6)


def worded_day(m: Column) -> Column:
    return day(F.concat_ws("-", *in_words(m)), "d-M-yyyy")


def worded(m: Column, key: str) -> Column:
    def spelt(date: Column) -> Column:
        def month(old: Column) -> Column:
            new = F.when((F.length(old) > 3) & (F.lower(old) != "sept"), F.date_format(date, "MMMM")).otherwise(F.date_format(date, "MMM"))
            return F.when(old == F.upper(old), F.upper(new)).when(old == F.lower(old), F.lower(new)).otherwise(new)

        d = F.dayofmonth(date)
        ending = F.when(d.between(11, 13), "th").when(d % 10 == 1, "st").when(d % 10 == 2, "nd").when(d % 10 == 3, "rd").otherwise("th")
        kept = lambda old: F.when(old == "", "").when(old == F.upper(old), F.upper(ending)).otherwise(ending)
        told = lambda pattern: lambda i: F.regexp_extract(m, pattern, i)
        a, b = told(DAY_MONTH), told(MONTH_DAY)
        year = F.date_format(date, "yyyy")
        by_day = F.concat(d.cast("string"), kept(a(3)), a(4), month(a(5)), a(6), year)
        return F.when(m.rlike("^[0-9]"), by_day).otherwise(F.concat(month(b(1)), b(2), d.cast("string"), kept(b(4)), b(5), year))

    return let(moved(worded_day(m).cast("long"), key), spelt)


def email(m: Column, key: str) -> Column:
    local = F.regexp_extract(m, "^[^@]*", 0)
    return F.concat(respelt(local, key, "email", lettered), F.regexp_extract(m, "@.*$", 0))


#: What a secret is made of.
SECRET_CHARS = r"0-9A-Za-z_+/.!@#$%^&*~-"


def secret(m: Column, key: str) -> Column:
    told = F.regexp_extract(m, rf"[{SECRET_CHARS}]*=*$", 0)
    lower, upper, either = told.rlike("^[0-9a-f]{16,}$"), told.rlike("^[0-9A-F]{16,}$"), told.rlike("^[0-9A-Fa-f]{16,}$")

    def new(t: Column) -> Column:
        out = F.when(lower, respelt(t, key, "hex", hexadecimal)).when(upper, F.upper(respelt(F.lower(t), key, "hex", hexadecimal)))
        return out.when(either, respelt(t, key, "hex", mixed_hexadecimal)).otherwise(respelt(t, key, "word", alphanumeric))

    return F.concat(F.substring(m, F.lit(1), F.length(m) - F.length(told)), new(told))


def address6(m: Column, key: str) -> Column:
    """Digits and colons as they stand: the same address written otherwise has another pseudonym."""
    return refilled(m, respelt(F.regexp_replace(F.lower(m), ":", ""), key, "ip6", hexadecimal), "^[0-9A-Fa-f]$")


def remainder_of_97(told: Column) -> Column:
    """Of a string of digits and capital letters, which count as 10 to 35."""
    step = lambda n, c: F.when(c.rlike("[A-Z]"), (n * 100 + F.ascii(c) - 55) % 97).when(c == "", n).otherwise((n * 10 + c.cast("int")) % 97)
    return F.aggregate(F.split(told, ""), F.lit(0), step)


def iban_ok(m: Column) -> Column:
    return let(F.replace(m, F.lit(" "), F.lit("")), lambda x: F.length(x).between(15, 34) & (remainder_of_97(F.concat(F.substring(x, 5, 40), F.substring(x, 1, 4))) == 1))


def iban(m: Column, key: str) -> Column:
    def new(x: Column) -> Column:
        country = F.substring(x, 1, 2)
        return let(respelt(F.substring(x, 5, 40), key, "iban", alphanumeric), lambda own: F.concat(country, F.lpad((98 - remainder_of_97(F.concat(own, country, F.lit("00")))).cast("string"), 2, "0"), own))

    return refilled(m, let(F.replace(m, F.lit(" "), F.lit("")), new), "^[0-9A-Z]$")


always = lambda m: F.lit(True)
DATE = r"[0-9](?<![0-9A-Za-z].)(?<![0-9][./-].)(?:{0}-{1}-{2}|{0}/{1}/{2}|{0}\.{1}\.{2})(?![0-9A-Za-z]|[./-][0-9])"
#: A name of a secret, however it goes on, and what is said of it.
SECRET_NAME = r"(?:(?i:token|secret|passw(?:or)?d|passphrase|pwd|(?:api|access|private).?key|credential)|[Pp](?<![0-9A-Za-z].)(?i:in)(?![a-z]))(?:[_-][0-9A-Za-z]++|[A-Z][a-z0-9]++|[0-9]++|s)*+"
SECRET = (
    rf"(?:{SECRET_NAME}[\"']?\s{{0,3}}(?::=|=>|[=:])\s{{0,3}}[\"']?(?<![0-9A-Za-z])(?:(?=[A-Za-z_+/.!@#$%^&*~-]*[0-9])[{SECRET_CHARS}]{{3,}}|[{SECRET_CHARS}]{{5,}})[0-9A-Za-z]=*"
    rf"|{SECRET_NAME}\s{{1,3}}is:?\s{{1,3}}[\"']?(?=[A-Za-z_+/.!@#$%^&*~-]*[0-9])[{SECRET_CHARS}]{{5,}}[0-9A-Za-z]=*"
    rf"|(?i:bearer)\s{{1,3}}(?=[A-Za-z_+/.!@#$%^&*~-]*[0-9])[{SECRET_CHARS}]{{15,}}[0-9A-Za-z]=*)(?![0-9A-Za-z])"
)
#: A social security number without hyphens, behind its name.
NAMED_SSN = r"(?i:ssn|social.security)(?i:[ -]?(?:number|num|no\.?|#))?\s{0,3}(?:[:=#]|is)?\s{0,3}(?<![0-9])[0-9]{3}([ .]?)[0-9]{2}\1[0-9]{4}(?![0-9A-Za-z-])"
#: A run of numbers parted by single blanks or hyphens, 13 digits or more, with what is glued to its ends.
RUN = r"[A-Za-z+]?(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?:[ -][0-9]++)*+[0-9A-Za-z]*+"
#: How cards are written: unbroken, or in these groups with one separator, the first digit an issuer's.
USUAL = r"^(?:[0-9]{13,19}|(?=[3-6]|2[2-7])(?:[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{1,3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5}|[0-9]{4}([ -])[0-9]{3}\3[0-9]{3}\3[0-9]{3}))[ -]?$"

#: Fixed value: how a card number begins.
ISSUER = "^(?:[3-6]|2[2-7])"


def cards(run: Column, key: str) -> Column:
    """A run with the card numbers in it replaced: a struct (n, m).

    A card number is a span of 13 to 19 digits that begins and ends at group borders and has a right Luhn sum; a group
    that is long enough stands by itself.  A span in no usual grouping has four groups at most and begins as
    issuers' numbers do, so that tables of small numbers have none.  Spans are taken from left to right, those in a usual grouping first.
    """

    def chosen(groups: Column) -> Column:
        n = F.size(groups)
        spelt = lambda i, k: F.array_join(F.slice(groups, i, k), "")
        # A span of 19 digits has 19 groups at most; none has a group with letters or + in it.
        sizes = lambda i: F.sequence(F.lit(1), F.least(F.lit(19), n - i + 1))

        def fits(m: Column, k: Column) -> Column:
            spelt_so = m.rlike(USUAL) | ((k <= 4) & m.rlike(ISSUER))
            return F.when(m.rlike("[A-Za-z+]") | ((k > 1) & m.rlike("[0-9]{13}")) | ~spelt_so, F.lit(False)).otherwise(card_ok(m))

        spans = F.transform(F.sequence(F.lit(1), n), lambda i: F.filter(sizes(i), lambda k: let(spelt(i, k), lambda m: fits(m, k))))
        # For each group, the size of the span from it in a usual grouping (0 if none is), and the longest of all.
        sized = F.transform(spans, lambda ks, j: F.struct(F.coalesce(F.array_min(F.filter(ks, lambda k: spelt(j + 1, k).rlike(USUAL))), F.lit(0)).alias("usual"), F.coalesce(F.array_max(ks), F.lit(0)).alias("k"), ks.alias("ks")))

        def turn(s: Column, i: Column, all_: Column) -> Column:
            at = F.element_at(all_, i)
            # A span in no usual grouping mustn't reach into one.
            free = F.filter(at["ks"], lambda k: ~F.exists(F.slice(all_, i + 1, k - 1), lambda x: x["usual"] > 0))
            k = F.when(at["usual"] > 0, at["usual"]).when(at["k"] == 0, F.lit(0)).otherwise(F.coalesce(F.array_max(free), F.lit(0)))
            taken = let(k, lambda k: F.struct(F.greatest(k, F.lit(1)).alias("k"), (k > 0).alias("card")))
            step = lambda t: F.struct((i + t["k"]).alias("next"), F.concat(s["parts"], F.array(F.struct(i.alias("i"), t["k"].alias("k"), t["card"].alias("card")))).alias("parts"))
            return F.when(i < s["next"], s).otherwise(let(taken, step))

        start = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<i:int,k:int,card:boolean>>").alias("parts"))
        parts = let(sized, lambda all_: F.aggregate(F.sequence(F.lit(1), n), start, lambda s, i: turn(s, i, all_), lambda s: s["parts"]))
        put = lambda p: let(spelt(p["i"], p["k"]), lambda m: F.when(p["card"], card(m, key)).otherwise(m))
        return let(parts, lambda ps: F.struct(F.size(F.filter(ps, lambda p: p["card"])).alias("n"), F.array_join(F.transform(ps, put), "").alias("m")))

    return let(F.regexp_extract_all(run, F.lit("[0-9A-Za-z+]++[ -]?"), F.lit(0)), chosen)


#: Name, what every match contains, pattern, further validation of a match, pseudonym; without a validation, a struct (n, m)
#: of how many values are in the match and the match with their pseudonyms.  Patterns begin with what they
#: match, and look behind it only then; none can start inside a run that it could start before.
KINDS: tuple[Kind, ...] = (
    ("emails", "@", r"[\p{L}\p{N}._%+-](?<![\p{L}\p{N}._%+-].)[\p{L}\p{N}._%+-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)++", always, email),
    ("secrets", "(?i)token|secret|pass|pwd|key|pin|credential|bearer", SECRET, always, secret),
    ("ibans", "[A-Z]{2}[0-9]{2}", r"[A-Z](?<![0-9A-Za-z].)[A-Z][0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])", iban_ok, iban),
    ("ibans", "[a-z]{2}[0-9]{2}", r"[a-z](?<![0-9A-Za-z].)[a-z][0-9]{2}(?: ?[a-z0-9]{4}){2,7}(?: ?[a-z0-9]{1,3})?(?![0-9A-Za-z])", lambda m: iban_ok(F.upper(m)), lambda m, key: F.lower(iban(F.upper(m), key))),
    ("phones", "[+]", r"\+(?:[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])|[0-9](?:[ .()/-]{0,2}[0-9]){7,12}(?![0-9]))", always, phone),
    ("cards", "[0-9]{4}[.][0-9]{4}", r"[2-6](?<![0-9A-Za-z.].)[0-9]{3}\.(?:[0-9]{4}\.[0-9]{4}\.[0-9]{4}(?:\.[0-9]{1,3})?|[0-9]{6}\.[0-9]{5})(?![0-9A-Za-z]|\.[0-9])", card_ok, card),
    ("cards", "[0-9][0-9 -]{11}[0-9]", RUN, None, cards),
    ("phones", "[0-9]{3}[-.][0-9]{4}", r"(?:\((?<![0-9A-Za-z+).].)(?<!\+[0-9]{1,3}[ .-]?.)[0-9]{3}\) ?[0-9]{3}|[0-9](?<![0-9A-Za-z+(./-].)(?<![0-9][ .-].)[0-9]{2}([-.])[0-9]{3}(?=\1))[-.][0-9]{4}(?![0-9A-Za-z]|[./-][0-9])", always, phone),
    ("ssns", "[0-9]-[0-9]{2}-[0-9]", r"[0-9](?<![0-9A-Za-z-].)[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", ssn_ok, ssn),
    ("ssns", "(?i)ssn|social.security", NAMED_SSN, lambda m: ssn_ok(hyphened(m)), named_ssn),
    ("phones", "0[1-9][0-9]{0,3}[ -][0-9]", r"0(?<![0-9A-Za-z+(./,-].)(?<![0-9][ .-].)[1-9][0-9]{0,3}(?:[ -][0-9]{2,4}){2,4}(?![0-9A-Za-z]|[ ./-][0-9])", national_ok, national),
    ("ips", "[0-9][.][0-9]", r"[0-9](?<![0-9A-Za-z.].)[0-9]{0,2}\.(?:[0-9]{1,3}\.){2}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])", lambda m: F.greatest(*octets(m)) < 256, address),
    ("ips", "[0-9a-fA-F]:[0-9a-fA-F:]", r"[0-9A-Fa-f](?<![0-9A-Za-z:.].)[0-9A-Fa-f]{0,3}:(?:(?:[0-9A-Fa-f]{1,4}:){6}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,5}(?::[0-9A-Fa-f]{1,4}){1,5}|(?::[0-9A-Fa-f]{1,4}){2,6})(?![0-9A-Za-z:])", lambda m: m.rlike("[0-9]") & (F.regexp_count(m, F.lit(":")) < 8), address6),
    ("dates", "[0-9]{4}[-/.][0-9]", DATE.format("[0-9]{3}", "[0-9]{1,2}", "[0-9]{1,2}"), in_days("yyyy-M-d"), dated("yyyy-M-d")),
    ("dates", "[0-9][-/.][0-9]{4}", DATE.format("[0-9]?", "[0-9]{1,2}", "[0-9]{4}"), in_days("d-M-yyyy", "M-d-yyyy"), dated("d-M-yyyy", "M-d-yyyy")),
    ("dates", f"{MONTH}.{{1,8}}[0-9]{{4}}", rf"(?:[0-9](?<![0-9A-Za-z].)[0-9]?{ORDINAL}?\s{{1,2}}(?i:of\s{{1,2}})?{MONTH}\.?,?|{MONTH}\.?\s{{1,2}}[0-9]{{1,2}}{ORDINAL}?,?)\s{{1,2}}[0-9]{{4}}(?![0-9A-Za-z])", lambda m: F.coalesce(worded_day(m).between(0, TOTAL - 1), F.lit(False)), worded),
)


def replacing(ok: Callable[[Column], Column] | None, new: Callable[[Column, str], Column], key: str) -> Callable[[Column], Column]:
    if ok is None:
        return lambda m: new(m, key)
    return lambda m: let(ok(m), lambda v: F.struct(v.cast("int").alias("n"), F.when(v, new(m, key)).otherwise(m).alias("m")))


def pseudonymised(docs: DataFrame, key: str, column: str = "text") -> DataFrame:
    """docs with `column` pseudonymised and a column n_found: how many values were replaced.

    Null texts stay null and empty ones empty, with n_found 0; long texts are read whole.  Values that don't validate stay
    as they are.  All rows and columns stay, repeated rows alike; where docs has a column n_found, the number's name
    gets underscores until it is free.  No rows give no rows.
    """

    def unused(name: str) -> str:
        while name.lower() in {c.lower() for c in docs.columns}:
            name += "_"
        return name

    count, found = unused("n_found"), unused("_found")
    out = docs.withColumn(count, F.lit(0))
    for _, sign, pattern, ok, new in KINDS:
        text = F.col(f"`{column}`")
        has = F.coalesce((text.contains(sign) if len(sign) == 1 else text.rlike(sign)) & text.rlike(pattern), F.lit(False))
        step = F.when(has, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
        out = out.withColumn(found, F.transform(step, replacing(ok, new, key)))
        joined = F.array_join(F.zip_with(F.split(text, pattern, -1), F.col(found), lambda a, b: F.concat(a, F.coalesce(b["m"], F.lit("")))), "")
        out = out.withColumns({column: F.when(F.col(found).isNull(), text).otherwise(joined), count: F.col(count) + F.coalesce(F.aggregate(found, F.lit(0), lambda n, b: n + b["n"]), F.lit(0))}).drop(found)
    return out
