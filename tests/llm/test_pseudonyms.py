"""Pseudonyms are undone by an independent inverse, for every kind; and what is found is what should be."""

import datetime
import hmac
import re

import pytest
from pyspark.sql import functions as F

from arbora.llm import pii

KEY = "key"


def digest(tag, i, value):
    return hmac.new(KEY.encode(), f"{tag}|{i}|{value}".encode(), "sha256").hexdigest()


def number_back(n, a, b, tag):
    """The inverse of the network on Z_a x Z_b."""
    left, right = divmod(n, b)
    for i in reversed(range(pii.ROUNDS)):
        if i % 2 == 0:
            left = (left - int(digest(tag, i, right)[:14], 16)) % a
        else:
            right = (right - int(digest(tag, i, left)[:14], 16)) % b
    return left * b + right


def digits_back(d, tag):
    k = len(d) // 2
    return str(number_back(int(d), 10**k, 10 ** (len(d) - k), tag)).zfill(len(d))


def among(c, by, letters):
    return letters[(letters.index(c) - by) % len(letters)]


SMALL, LARGE = ([chr(i) for i in range(a, z) if i not in (0xD7, 0xF7)] for a, z in ((0xDF, 0x100), (0xC0, 0xDF)))


def letter_back(c, by):
    for first, last in ("az", "AZ", "09"):
        if first <= c <= last:
            return chr((ord(c) - ord(first) - by) % (ord(last) - ord(first) + 1) + ord(first))
    if ord(c) < 128 or not (c.isalpha() or c.isnumeric()):
        return c
    if c in SMALL or c in LARGE:
        return among(c, by, SMALL if c in SMALL else LARGE)
    return chr(ord(c) - ord(c) % 32 + (ord(c) % 32 - by) % 32)


def hex_back(c, by):
    return among(c, by, "0123456789abcdef")


def mixed_hex_back(c, by):
    return among(c, by, "abcdef" if c in "abcdef" else "ABCDEF" if c in "ABCDEF" else "0123456789")


def word_back(word, tag, back):
    left, right = word[: len(word) // 2], word[len(word) // 2 :]

    def half(own, i, other):
        hashes = [digest(tag, i, f"{n}|{other}") for n in range(len(own) // 16 + 1)]
        return "".join(back(c, int(hashes[j // 16][j % 16 * 4 : j % 16 * 4 + 4], 16)) for j, c in enumerate(own))

    for i in reversed(range(pii.ROUNDS)):
        if i % 2 == 0:
            left = half(left, i, right)
        else:
            right = half(right, i, left)
    return left + right


def refilled(template, new):
    it = iter(new)
    return "".join(next(it) if c.isdigit() else c for c in template)


def plain(x):
    return re.sub(r"\D", "", x)


def card_back(x):
    d = digits_back(plain(x)[:-1], "card")
    doubled = [int(c) * (2 - i % 2) for i, c in enumerate(reversed(d))]
    return refilled(x, d + str(-sum(v - 9 * (v > 9) for v in doubled) % 10))


def day_back(day):
    n = (day - datetime.date(1900, 1, 1)).days
    cycle, total = 270 * 270, (datetime.date(9999, 12, 31) - datetime.date(1900, 1, 1)).days + 1
    rest = total % cycle
    n = n - n % cycle + number_back(n % cycle, 270, 270, "date") if n < total - rest else total - rest + number_back(n - (total - rest), rest, 1, "date")
    return datetime.date(1900, 1, 1) + datetime.timedelta(n)


def ssn_back(x):
    d = plain(x)
    area, group, serial = int(d[:3]), int(d[3:5]), int(d[5:])
    n = number_back(((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, "ssn")
    area = n // (99 * 9999)
    return refilled(x, f"{area + 1 + (area >= 665):03d}{n // 9999 % 99 + 1:02d}{n % 9999 + 1:04d}")


def iban_back(x):
    told = x.replace(" ", "")
    upper = told.upper()
    own = word_back(upper[4:], "iban", letter_back)
    left = int("".join(str(int(c, 36)) for c in own + upper[:2] + "00"))
    new = iter(f"{upper[:2]}{98 - left % 97:02d}{own}")
    out = "".join(c if c == " " else next(new) for c in x)
    return out.lower() if told != upper else out


def secret_back(word):
    if re.fullmatch("[0-9a-f]{16,}", word):
        return word_back(word, "hex", hex_back)
    if re.fullmatch("[0-9A-F]{16,}", word):
        return word_back(word.lower(), "hex", hex_back).upper()
    return word_back(word, "hex", mixed_hex_back) if re.fullmatch("[0-9A-Fa-f]{16,}", word) else word_back(word, "word", letter_back)


def in_front(prefix, back):
    return lambda x: prefix + back(x.removeprefix(prefix))


def phone_back(code):
    return lambda x: refilled(x, plain(x)[:code] + digits_back(plain(x)[code:], "phone"))


def dates(form):
    """By a format of Python's, whose zeros a leading `-` leaves out."""

    def back(x):
        told = day_back(datetime.datetime.strptime(x, form.replace("%-", "%")).date())
        return told.strftime(form)

    return back


def ip_back(x):
    n = 0
    for part in x.split("."):
        n = n * 256 + int(part)
    n = number_back(n, 65536, 65536, "ip")
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def ip6_back(x):
    new = iter(word_back(x.replace(":", ""), "ip6", hex_back))
    return "".join(c if c == ":" else next(new) for c in x)


def email_back(x):
    local, domain = x.split("@")
    return f"{word_back(local, 'email', letter_back)}@{domain}"


#: What is found, and the inverse of its kind.
FOUND = [
    ("4539578763621486", card_back), ("4539 5787 6362 1486", card_back), ("4111.1111.1111.1111", card_back), ("3782.822463.10005", card_back), ("45395787 63621486", card_back),
    ("+1 (017) 555-7713", phone_back(1)), ("+44 20 7946 0958", phone_back(2)), ("(555) 123-4567", phone_back(0)), ("555.123.4567", phone_back(0)), ("020 7946 0958", phone_back(2)), ("01 23 45 67 89", phone_back(2)), ("0171-555-1234", phone_back(2)),
    ("123-45-6789", ssn_back), ("SSN 123456789", in_front("SSN ", ssn_back)), ("ssn: 123 45 6789", in_front("ssn: ", ssn_back)), ("social security number is 123456789", in_front("social security number is ", ssn_back)),
    ("192.168.0.1", ip_back), ("2001:db8::8a2e:370:7334", ip6_back), ("GB82WEST12345698765432", iban_back), ("GB82 WEST 1234 5698 7654 32", iban_back), ("gb82west12345698765432", iban_back),
    ("1984-02-29", dates("%Y-%m-%d")), ("29.02.1984", dates("%d.%m.%Y")), ("1/5/2020", dates("%-d/%-m/%Y")), ("2020-1-5", dates("%Y-%-m-%-d")), ("2099-08-06", dates("%Y-%m-%d")), ("9999-12-31", dates("%Y-%m-%d")), ("12.31.2150", None),
    ("5 Jan 2020", dates("%-d %b %Y")), ("January 5, 2020", dates("%B %-d, %Y")), ("17 of March 1999", dates("%-d of %B %Y")), ("3rd March 1999", None), ("MAY 5 2001", None),
    ("ab.99@mail9.example.com", email_back), ("jörg@example.com", email_back), ("ÀÉÎ.ÿ@example.com", email_back), ("иван.петров@пример.example", email_back), ("名前@example.jp", email_back),
    ("secret_key = abcd1234efgh5678", in_front("secret_key = ", secret_back)), ("password is hunter2secret", in_front("password is ", secret_back)), ("Bearer eyJhbGciOiJIUzI1NiJ9.abc", in_front("Bearer ", secret_back)),
    ("password: hunterhunter", in_front("password: ", secret_back)), ("pin=12ab", in_front("pin=", secret_back)), ("token: deadbeefDEADBEEF0123", in_front("token: ", secret_back)), ("access-token-id => zz91kq", in_front("access-token-id => ", secret_back)),
    ("accessToken = " + "0123456789abcdef" * 3, in_front("accessToken = ", secret_back)), ("api_key=ABCDEF0123456789ABCD", in_front("api_key=", secret_back)), ("pwd := p@ss!w0rd", in_front("pwd := ", secret_back)),
]

PLAIN = ["4539578763621487", "12 34 56 78 90 12 34 56", "999-45-6789", "SSN 000456789", "256.1.1.1", "1.2.3.4.5", "version 1.2.3.2020", "GB83WEST12345698765432", "1899-12-31", "1984-02-30", "30 Feb 2020", "May 2020", "5 Janitors 2020", "the secret is love", "secret: the truth", "spin = 12ab", "pineapple: sweet99x", "0 12 34 56 78", "token", "std::vector 12:30:45", "bearer of bad news", "a@b"]


@pytest.fixture(scope="module")
def changed(spark):
    texts = [v for v, _ in FOUND] + PLAIN
    df = spark.createDataFrame([(i, f"see {v}; and\n{v}") for i, v in enumerate(texts)], "i int, text string")
    return {texts[r["i"]]: (r["text"], r["n_found"]) for r in pii.pseudonymised(df, KEY).collect()}


@pytest.mark.parametrize("value,back", FOUND, ids=[v for v, _ in FOUND])
def test_found_and_undone(changed, value, back):
    text, n = changed[value]
    first, second = re.fullmatch(r"see (.*); and\n(.*)", text).groups()
    assert first == second != value and n == 2
    if back:
        assert back(first) == value


@pytest.mark.parametrize("value", PLAIN)
def test_left_alone(changed, value):
    assert changed[value] == (f"see {value}; and\n{value}", 0)


def test_no_part_of_a_local_name_stays(spark):
    """Whatever letters a local part has, it is read whole."""
    names = ["jörg", "aø", "øa", "a.ø.b", "éé", "x_ñ-9"]
    df = spark.createDataFrame([(n,) for n in names], "n string").withColumn("text", F.concat("n", F.lit("@example.org")))
    for r in pii.pseudonymised(df, KEY).collect():
        assert email_back(r["text"]) == r["n"] + "@example.org"


def test_tables_of_numbers(spark):
    """Small numbers in a row hold no cards; of long ones fewer than one in a hundred is taken for one."""
    import random

    random.seed(7)
    small = " ".join(str(random.randint(0, 999)) for _ in range(20_000))
    large = " ".join(str(random.randint(0, 10**12)) for _ in range(5_000))
    df = spark.createDataFrame([(small,), (large,)], "text string")
    a, b = (r["n_found"] for r in pii.pseudonymised(df, KEY).collect())
    assert a == 0 and b < 50
