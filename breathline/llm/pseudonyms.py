"""Personal data replaced by format-preserving pseudonyms, with column functions only.

A found value is read as a row of symbols, each below a radix of its own: digits and
letters of a string, octets of an address, parts of a day number. A keyed Feistel network
permutes all rows with the same radices: the halves in turn are shifted, symbol by symbol
modulo its radix, by a keyed hash of the other half. So a pseudonym has the format of its
value, equal values have equal pseudonyms in all documents, and different values different
ones. What makes a value valid is kept valid: check digits are worked out anew, days and
numbers are permuted among the valid ones.

| kind | valid if | kept |
| --- | --- | --- |
| e-mail address | local part, labels and a top-level domain | punctuation, top-level domain |
| payment card | 13 to 19 digits with a right check digit | grouping, which is no part of the value; new check digit |
| bank account (IBAN) | remainder 1 by 97 | country, grouping; new check digits |
| US social security number | area, group and serial in use | dashes |
| IPv4 address | four octets | dots |
| telephone number | country code, or the North American form | country code, punctuation |
| date | a day of 1900 to 2099 | order, separators, width where it fits |
| secret | named assignment, access key, 32 or more hex digits | name, quotes, case, hex digits |

Values that fail their check stay as they are. Each row is worked on where it is: nothing
is moved, joined or gathered.

Defined results
- A null text stays null; texts without a valid value stay as they are, n_replaced 0.
- Repeated rows and null ids are rows like others; other columns are carried in ``row``.
- Where kinds overlap, the one that begins first counts, then the order of the pattern.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROUNDS = 10
KEY_CONF, DEVELOPMENT_KEY = "spark.breathline.pseudonym.key", "development key, not a secret"
#: Day 0, and the days up to the end of 2099 as two symbols.
FIRST_DAY, DAY_RADICES = "1900-01-01", (17, 4297)

# The formats looked for, as Java patterns.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_END = r"(?![\p{L}\p{N}])"
_NAMED = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s{0,2}[=:]\s{0,2}[\"']?"
SECRET = _NAMED + r"[A-Za-z0-9+/_=-]{8,}+"
ACCESS_KEY = r"AKIA[0-9A-Z]{16}" + _END
HEX = r"(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)" + _END
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END
EMAIL = r"[\p{L}\p{N}][\p{L}\p{N}._%+-]{0,63}+@(?:[\p{L}\p{N}][\p{L}\p{N}-]{0,62}\.){1,8}[\p{L}]{2,24}"
CARD = r"(?:\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{5}|\d{13,19}+)" + _END
SSN = r"\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)"
IPV4 = rf"(?<!\d\.)(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.\d)"
ISO_DATE = r"(?<![\d-][-/.])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2})(?![\p{L}\p{N}]|[-/.]\d)"
DAY_DATE = r"(?<!\d[-/.])(?:\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\p{L}\p{N}]|[-/.]\d)"
PHONE = (
    r"(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}([.-])\d{3}\3\d{4}"
    r"|\+[2-9]\d{0,2}[ .-]?(?:\(\d{1,4}\)|\d{1,4})[ .-]?\d{3,8}(?:[ -]\d{2,4}){0,2})(?![\p{L}\p{N}]|[-.]\d)")
_WORD_KINDS = (SECRET, ACCESS_KEY, IBAN, HEX, EMAIL, IPV4, ISO_DATE, DAY_DATE, SSN, CARD, PHONE)
#: All begin where no letter, digit or underscore stands before, and what repeats is bounded or
#: possessive, so that long words cost no more than others.
PATTERN = r"(?<![\p{L}\p{N}_])(?:" + "|".join(f"(?:{k})" for k in _WORD_KINDS) + ")"
#: A text without any of these has none of the kinds.
SIGN = "[0-9@=:]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of ``value``, worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def permuted(symbols: Column, radices: Column, tweak: Column, key: str, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of rows of ``symbols`` (array<bigint>), each below its radix."""
    long = lambda c: c.cast("array<bigint>")
    size = F.size(symbols)
    half = F.floor(size / 2).cast("int")
    start = F.struct(
        F.slice(long(symbols), F.lit(1), half).alias("a"), F.slice(long(symbols), half + 1, size - half).alias("b"),
        F.slice(long(radices), F.lit(1), half).alias("ra"), F.slice(long(radices), half + 1, size - half).alias("rb"))

    def turn(s: Column, number: Column) -> Column:
        seen = F.sha2(F.concat_ws("|", F.lit(key), tweak, number.cast("string"), F.array_join(s["b"].cast("array<string>"), ",")), 512)
        # sixteen shifts of eight hex digits to a block
        blocks = let(seen, lambda h: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(s["a"]) - 1) / 16).cast("int")),
            lambda k: F.sha2(F.concat_ws("|", F.lit(key), h, k.cast("string")), 512)))
        shift = lambda all_blocks, i: F.conv(
            F.substr(F.get(all_blocks, F.floor(i / 16).cast("int")), (i % 16) * 8 + 1, F.lit(8)), 16, 10).cast("bigint")
        moved = let(blocks, lambda all_blocks: F.transform(s["a"], lambda x, i: F.pmod(x + shift(all_blocks, i), F.get(s["ra"], i))))
        return F.struct(s["b"].alias("a"), moved.alias("b"), s["rb"].alias("ra"), s["ra"].alias("rb"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, turn, lambda s: F.concat(s["a"], s["b"]))


def _classes(value: Column) -> Column:
    """The format of a string: 9, a and A for digits and letters that move."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[0-9]", "9"), "[a-z]", "a"), "[A-Z]", "A")


def permuted_string(value: Column, kind: str, key: str, first: Column, last: Column, letters: Column) -> Column:
    """Digits and ASCII letters of places first <= i < last move within their class.

    ``letters`` is how many letters of a case are in use: 26, or 6 for hex digits.
    """
    zero, small, great = ord("0"), ord("a"), ord("A")

    def of(chars: Column) -> Column:
        moves = lambda c, i: (i >= first) & (i < last) & c.rlike("^[0-9a-zA-Z]$")
        base = lambda c: F.when(c.rlike("^[0-9]$"), zero).when(c.rlike("^[a-z]$"), small).otherwise(great)
        radices = F.transform(chars, lambda c, i: F.when(~moves(c, i), 1).when(c.rlike("^[0-9]$"), 10).otherwise(letters))
        symbols = F.transform(chars, lambda c, i: F.when(moves(c, i), F.ascii(c) - base(c)).otherwise(0))
        out = permuted(symbols, radices, F.concat(F.lit(kind + ":"), F.sha2(_classes(value), 256)), key)
        return let(out, lambda moved: F.array_join(F.transform(
            chars, lambda c, i: F.when(moves(c, i), F.char(F.get(moved, i) + base(c))).otherwise(c)), ""))

    return let(F.split(value, ""), of)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Digits summed from the right, every second one doubled, beginning with place ``doubled``."""
    worth = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == doubled, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") / 5)).otherwise(c.cast("int")).cast("bigint"))
    return F.aggregate(worth, F.lit(0).cast("bigint"), lambda a, x: a + x)


def remainder_97(text: Column) -> Column:
    """Of the number an IBAN stands for, letters as 10 to 35."""
    def add(rest: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (rest * 10 + c.cast("int")) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0).cast("bigint"), lambda a, c: add(a, c).cast("bigint"))


def _whole(value: Column, pattern: str) -> Column:
    return value.rlike(rf"\A(?:{pattern})\z")


def grouped_like(value: Column, fresh: Column) -> Column:
    """The digits and letters of ``fresh`` with the punctuation of ``value``."""
    def place(c: Column, i: Column) -> Column:
        before = F.char_length(F.regexp_replace(F.substr(value, F.lit(1), i), "[^0-9A-Za-z]", ""))
        return F.when(c.rlike("^[0-9A-Za-z]$"), F.substr(fresh, before + 1, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(value, ""), place), "")


def _card(value: Column, key: str) -> Column:
    def of(digits: Column) -> Column:
        payload = F.substr(digits, F.lit(1), F.char_length(digits) - 1)
        new = let(permuted_string(payload, "card", key, F.lit(0), F.char_length(payload), F.lit(26)), lambda moved: F.concat(
            moved, F.pmod(10 - luhn_sum(moved, 0) % 10, F.lit(10)).cast("string")))
        return F.when(luhn_sum(digits, 1) % 10 == 0, let(new, lambda n: grouped_like(value, n))).otherwise(value)

    return let(_digits(value), of)


def _iban(value: Column, key: str) -> Column:
    turned = lambda v, check: F.concat(F.substr(v, F.lit(5)), F.substr(v, F.lit(1), F.lit(2)), check)

    def of(plain: Column) -> Column:
        moved = permuted_string(plain, "iban", key, F.lit(4), F.char_length(plain), F.lit(26))
        new = let(moved, lambda m: F.concat(
            F.substr(m, F.lit(1), F.lit(2)), F.lpad((98 - remainder_97(turned(m, F.lit("00")))).cast("string"), 2, "0"), F.substr(m, F.lit(5))))
        valid = remainder_97(turned(plain, F.substr(plain, F.lit(3), F.lit(2)))) == 1
        return F.when(valid, let(new, lambda n: grouped_like(value, n))).otherwise(value)

    return let(F.replace(value, F.lit(" "), F.lit("")), of)


def _phone(value: Column, key: str) -> Column:
    """All digits but the country code move; numbers written with other punctuation stay linked."""
    country = F.char_length(_digits(F.regexp_extract(value, r"\A\+(?:1|\d{1,3}(?=[ .(-])|\d{2})", 0)))
    own = let(F.substr(_digits(value), country + 1), lambda d: permuted_string(d, "phone", key, F.lit(0), F.char_length(d), F.lit(26)))
    return let(F.concat(F.substr(_digits(value), F.lit(1), country), own), lambda n: grouped_like(value, n))


def _ssn(value: Column, key: str) -> Column:
    part = lambda n: F.split_part(value, F.lit("-"), F.lit(n)).cast("int")
    area, group, serial = part(1), part(2), part(3)
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    symbols = F.array(F.when(area < 666, area - 1).otherwise(area - 2), group - 1, serial - 1)
    new = let(permuted(symbols, F.array(*map(F.lit, (898, 99, 9999))), F.lit("ssn"), key), lambda s: F.concat_ws(
        "-", F.lpad((F.get(s, 0) + F.when(F.get(s, 0) < 665, 1).otherwise(2)).cast("string"), 3, "0"),
        F.lpad((F.get(s, 1) + 1).cast("string"), 2, "0"), F.lpad((F.get(s, 2) + 1).cast("string"), 4, "0")))
    return F.when(valid, new).otherwise(value)


def _ipv4(value: Column, key: str) -> Column:
    octets = F.split(value, r"\.").cast("array<bigint>")
    return F.array_join(permuted(octets, F.transform(octets, lambda _: F.lit(256)), F.lit("ipv4"), key).cast("array<string>"), ".")


def _moved_day(year: Column, month: Column, day: Column, key: str, show: Callable[[Column], Column], value: Column) -> Column:
    """``show`` of the day that stands for another, or ``value`` where that is no day."""
    def of(date: Column) -> Column:
        number = F.datediff(date, F.to_date(F.lit(FIRST_DAY)))
        symbols = F.array(F.floor(number / DAY_RADICES[1]), number % DAY_RADICES[1])
        new = let(permuted(symbols, F.array(*map(F.lit, DAY_RADICES)), F.lit("day"), key), lambda s: show(
            F.date_add(F.to_date(F.lit(FIRST_DAY)), (F.get(s, 0) * DAY_RADICES[1] + F.get(s, 1)).cast("int"))))
        return F.when(date.isNotNull() & number.between(0, DAY_RADICES[0] * DAY_RADICES[1] - 1), new).otherwise(value)

    text = F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    return let(F.try_to_date(text, "yyyy-MM-dd"), of)


def _iso_date(value: Column, key: str) -> Column:
    mark = F.substr(value, F.lit(5), F.lit(1))
    part = lambda n: F.split_part(value, mark, F.lit(n))
    return _moved_day(part(1), part(2), part(3), key, lambda d: F.replace(
        F.date_format(d, "yyyy-MM-dd"), F.lit("-"), mark), value)


def _day_date(value: Column, key: str) -> Column:
    """Day first with dots, and with slashes where the first number can't be a month; else month first."""
    slashed = value.contains("/")
    mark = F.when(slashed, "/").otherwise(".")
    part = lambda n: F.split_part(value, mark, F.lit(n))
    month_first = slashed & (part(1).cast("int") <= 12)
    wide = lambda number, old: F.when(F.char_length(old) == 2, F.lpad(number.cast("string"), 2, "0")).otherwise(number.cast("string"))

    def show(d: Column) -> Column:
        one, two = F.when(month_first, F.month(d)).otherwise(F.dayofmonth(d)), F.when(month_first, F.dayofmonth(d)).otherwise(F.month(d))
        return F.concat(wide(one, part(1)), mark, wide(two, part(2)), mark, F.lpad(F.year(d).cast("string"), 4, "0"))

    return _moved_day(part(3), F.when(month_first, part(1)).otherwise(part(2)), F.when(month_first, part(2)).otherwise(part(1)), key, show, value)


def _secret(value: Column, key: str) -> Column:
    named = F.char_length(F.regexp_extract(value, rf"\A{_NAMED}", 0))
    first = F.when(_whole(value, ACCESS_KEY), 4).otherwise(named)
    rest = F.substr(value, first + 1)
    letters = F.when(rest.rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z"), 6).otherwise(26)
    return permuted_string(value, "secret", key, first, F.char_length(value), letters)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a value that the pattern found; the value itself if it fails its check."""
    top = F.char_length(value) - F.char_length(F.regexp_extract(value, r"\.(\p{L}+)\z", 1))
    return (
        F.when(_whole(value, f"{SECRET}|{ACCESS_KEY}|{HEX}"), _secret(value, key))
        .when(_whole(value, IBAN), _iban(value, key))
        .when(_whole(value, EMAIL), permuted_string(value, "email", key, F.lit(0), top, F.lit(26)))
        .when(_whole(value, IPV4), _ipv4(value, key))
        .when(_whole(value, ISO_DATE), _iso_date(value, key))
        .when(_whole(value, DAY_DATE), _day_date(value, key))
        .when(_whole(value, SSN), _ssn(value, key))
        .when(_whole(value, CARD), _card(value, key))
        .otherwise(_phone(value, key))
    )


def session_key(spark: SparkSession) -> str:
    """The key that the session names; one for development where it names none."""
    return spark.conf.get(KEY_CONF, DEVELOPMENT_KEY)


def pseudonymised(docs: DataFrame, text: str = "text", key: str | None = None) -> DataFrame:
    """``row`` (the input row), ``clean_text`` and ``n_replaced``."""
    key = session_key(docs.sparkSession) if key is None else key
    body = F.col("body")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text).alias("body"))
    found = rows.withColumn("found", F.when(body.rlike(SIGN), F.regexp_extract_all(body, F.lit(PATTERN), F.lit(0))))
    given = found.withColumn("given", F.when(F.size("found") > 0, F.transform("found", lambda v: pseudonym(v, key))))
    parts = F.zip_with(F.split(body, PATTERN, -1), F.col("given"), lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
    changed = F.zip_with("found", "given", lambda old, new: (old != new).cast("bigint"))
    return given.select(
        "row",
        F.when(F.col("given").isNull(), body).otherwise(F.array_join(parts, "")).alias("clean_text"),
        F.when(F.col("given").isNull(), F.lit(0).cast("bigint")).otherwise(
            F.aggregate(changed, F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n_replaced"),
    )
