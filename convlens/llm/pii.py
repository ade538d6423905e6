"""Format-preserving pseudonyms for personal data, in Spark SQL functions only.

Found in a text and validated are: e-mail addresses (a name of up to 64 characters, up to 126 labels; the domain stays in clear
text), IPv4 addresses (octets up to 255), payment card numbers (13 to 19 digits, Luhn), IBANs without spaces (mod 97), US social security numbers, North
American and international telephone numbers, and calendar dates (also those that begin a timestamp). Each value is
replaced by the value that a keyed Feistel network permutes it to within the same format: separators stay, card
numbers keep their first digit and a right check digit, telephone numbers their country code and areas and exchanges on their side of 200, dates are valid dates
of the same notation, letters stay letters. As it is a permutation under one key, equal values stay equal, whatever their
separators and wherever they occur, and different values stay different. Dates with slashes are three closed sets: those that
can be read with the day or the month first (permuted among themselves, read as day first), and those that can be read in one way only.

A Feistel round adds to one half of the value, modulo the size of that half's range, a number hashed from the key, the kind of
value, the round and the other half. Ranges factor exactly (dates: the 146,097 days of 400 years are 189 * 773), so no
value leaves its range. E-mail names and foreign numbers are permuted character by character, each within its own class.

No pattern holds an unbounded group, and a run of groups of digits is cut into its cards in one pass, so texts of any length and any
number of groups are read in linear time and without recursion.

The key is a string, or a column (a scalar subquery over a file, say), which keeps it out of plans and logs.

Defined results: null stays null; dates with a day or month of one digit stay; texts without such values, numbers that fail validation, ten digits with an area or exchange below
200 and neither country code nor parentheses and dates outside the years 1800 to
2199 stay as they are; other columns and rows are not touched.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convlens.llm.common import fresh

ROUNDS = 10
# fixed values: notations of personal data
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}"
_START, _END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
IPV4 = _START + r"(?<![0-9]\.)(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.[0-9])" + _END
DATE = _START + r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![-/][0-9])(?:(?=T[0-9]{2}:)|(?![0-9A-Za-z]))"
IBAN = _START + r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}" + _END
SSN = _START + r"(?<![0-9]-)[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-[0-9])" + _END
_PREFIX = r"(?<![0-9A-Za-z+])(?<![0-9][.-])1(?:[ .-]|(?=\())"
NANP = (r"(?:(?<![0-9A-Za-z+])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|(?:" + _PREFIX + r"|(?<![0-9A-Za-z.-]))"
        r"(?:\([0-9]{3}\)[ .-]?|(?<!\()[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})") + _END
ABROAD = r"(?<![0-9A-Za-z+])\+[2-9][0-9]{0,2}(?:[ .-]?\(?[0-9]{1,5}\)?){2,6}" + _END
# a run of groups in which a card of four groups, or of three, may begin at each; no group begins a date or an address
RUN = _START + r"[0-9]{4}(?:[ -](?!" + DATE + "|" + EMAIL + r")[0-9]{4,6}" + _END + "){2,}+"
CARD = "(?:" + RUN + "|" + _START + "[0-9]{13,19}" + _END + ")"
PATTERN = "|".join((EMAIL, IPV4, DATE, IBAN, SSN, NANP, ABROAD, CARD))
_PLAIN = r"^[0-9.@/()+ -]"


def _hash(key: str | Column, kind: str, i: Column, value: Column) -> Column:
    key = key if isinstance(key, Column) else F.lit(key)
    return F.sha2(F.concat_ws("|", key, F.lit(kind), i.cast("string"), value.cast("string"), key), 256)


def _number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("bigint")


def feistel(key: str, kind: str, value: Column, a: int | Column, b: int | Column) -> Column:
    """A keyed permutation of the whole numbers below a * b."""
    step = lambda i, other: _number(F.substring(_hash(key, kind, i, other), 1, 15))
    start = F.struct(F.floor(value / b).cast("bigint").alias("l"), F.pmod(value, F.lit(b)).cast("bigint").alias("r"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda s, i: F.when(
        i % 2 == 0, F.struct(F.pmod(s["l"] + step(i, s["r"]), F.lit(a)).alias("l"), s["r"].alias("r"))).otherwise(
        F.struct(s["l"].alias("l"), F.pmod(s["r"] + step(i, s["l"]), F.lit(b)).alias("r"))))
    return end["l"] * b + end["r"]


def _chars(s: Column, f: Callable[[Column, Column], Column]) -> Column:
    """``f(character, its place from 0)`` for each character, as one string."""
    return F.when(F.length(s) == 0, F.lit("")).otherwise(F.concat_ws("", F.transform(
        F.sequence(F.lit(0), F.greatest(F.length(s) - 1, F.lit(0))), lambda j: f(F.substring(s, j + 1, F.lit(1)), j))))


def feistel_text(key: str, kind: str, value: Column) -> Column:
    """A keyed permutation of the strings with the same classes of characters: digits, small and capital letters move
    within their class, all else stays. Case does not change where a letter goes."""

    def moved(half: Column, other: Column, i: Column) -> Column:
        pad = _hash(key, kind, i, F.lower(other))

        def one(c: Column, j: Column) -> Column:
            by = _number(F.substring(pad, F.pmod(j, F.lit(16)) * 4 + 1, F.lit(4)))
            turn = lambda first, n: F.char(F.pmod(F.ascii(c) - F.lit(first) + by, F.lit(n)) + F.lit(first))
            return (F.when(c.between("0", "9"), turn(48, 10)).when(c.between("a", "z"), turn(97, 26))
                    .when(c.between("A", "Z"), turn(65, 26)).otherwise(c))

        return _chars(half, one)

    cut = F.ceil(F.length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), cut).alias("l"), F.substring(value, cut + 1, F.length(value)).alias("r"))
    end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda s, i: F.when(
        i % 2 == 0, F.struct(moved(s["l"], s["r"], i).alias("l"), s["r"].alias("r"))).otherwise(
        F.struct(s["l"].alias("l"), moved(s["r"], s["l"], i).alias("r"))))
    return F.concat(end["l"], end["r"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _refill(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced, in order, by ``digits``."""
    return _chars(form, lambda c, j: F.when(c.between("0", "9"), F.substring(
        digits, F.length(_digits(F.substring(form, F.lit(1), j + 1))), F.lit(1))).otherwise(c))


def _email(key: str, m: Column) -> Column:
    return F.concat(feistel_text(key, "email", F.substring_index(m, "@", 1)), F.lit("@"), F.substring_index(m, "@", -1))


def _ipv4(key: str, m: Column) -> Column:
    octet = lambda i: F.get(F.split(m, r"\."), F.lit(i)).cast("bigint")
    new = feistel(key, "ipv4", ((octet(0) * 256 + octet(1)) * 256 + octet(2)) * 256 + octet(3), 65536, 65536)
    text = F.element_at(F.transform(F.array(new), lambda n: F.concat_ws(".", *[
        F.shiftrightunsigned(n, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)])), 1)
    return F.when(F.forall(F.split(m, r"\."), lambda o: o.cast("int") <= 255), text).otherwise(m)


def _card(key: str, m: Column) -> Column:
    d = _digits(m)
    body = F.concat(F.substring(d, 1, 1), feistel_text(key, "card", F.substring(d, F.lit(2), F.length(d) - 2)))
    checked = F.element_at(F.transform(F.array(body), lambda x: F.concat(x, F.element_at(F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(9)), lambda c: c.cast("string")), lambda c: F.call_function("luhn_check", F.concat(x, c))), 1))), 1)
    return F.when((F.length(d) >= 13) & F.call_function("luhn_check", d), F.element_at(F.transform(F.array(checked), lambda x: _refill(m, x)), 1)).otherwise(m)


def _ssn(key: str, m: Column) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (F.substring(m, a, n).cast("bigint") for a, n in ((1, 3), (5, 2), (8, 4)))
    place = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1
    new = feistel(key, "ssn", place, 898 * 99, 9999)

    def text(n: Column) -> Column:
        a = F.floor(n / (99 * 9999)) + 1
        return F.concat_ws("-", F.lpad(F.when(a >= 666, a + 1).otherwise(a).cast("string"), 3, "0"),
                           F.lpad((F.floor(n / 9999) % 99 + 1).cast("string"), 2, "0"), F.lpad((n % 9999 + 1).cast("string"), 4, "0"))

    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, F.element_at(F.transform(F.array(new), text), 1)).otherwise(m)


def _nanp(key: str, m: Column) -> Column:
    """Area and exchange each stay below 200 or from 200 on; the line number below 10000. Where neither a country code nor
    parentheses tell a telephone number, both have to be from 200 on."""
    d = _digits(m)
    area, exchange, line = (F.substring(d, a, n).cast("bigint") for a, n in ((-10, 3), (-7, 3), (-4, 4)))
    # the four products of ranges are together all numbers, and none is left by its permutation
    low = (area < 200) | (exchange < 200)
    a, b = (F.when(x < 200, 0).otherwise(200) for x in (area, exchange))
    left, right = (F.when(x < 200, 20000).otherwise(80000) for x in (area, exchange))
    # an area with the line's upper half, an exchange with its lower half
    place = ((area - a) * 100 + F.floor(line / 100)) * right + (exchange - b) * 100 + line % 100

    def text(n: Column) -> Column:
        x, y = F.floor(n / right), n % right
        number = ((F.floor(x / 100) + a) * 1000 + F.floor(y / 100) + b) * 10000 + x % 100 * 100 + y % 100
        return _refill(m, F.concat(F.substring(d, F.lit(1), F.length(d) - 10), F.lpad(number.cast("string"), 10, "0")))

    new = feistel(key, "phone", place, left, right)
    return F.when(~low | (F.length(d) == 11) | m.contains("("), F.element_at(F.transform(F.array(new), text), 1)).otherwise(m)


def _abroad(key: str, m: Column) -> Column:
    d = _digits(m)
    new = F.concat(F.substring(d, 1, 3), feistel_text(key, "abroad", F.substring(d, F.lit(4), F.length(d))))
    return F.when(F.length(d).between(8, 15), F.element_at(F.transform(F.array(new), lambda x: _refill(m, x)), 1)).otherwise(m)


FIRST_DAY = "1800-01-01"
DAYS, MONTHS = 146_097, 4_800  # of 400 years


def _bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` evaluated once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _day(n: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), n.cast("int"))


def _late_day(key: str, day: Column) -> Column:
    """A permutation of the days after the twelfth of their months: there are 88,497 = 9 * 9833 of them in 400 years."""
    start = lambda month: F.datediff(F.add_months(F.lit(FIRST_DAY).cast("date"), month.cast("int")), F.lit(FIRST_DAY).cast("date")) - 12 * month
    month = (F.year(day) - 1800) * 12 + F.month(day) - 1
    new = feistel(key, "late day", (start(month) + F.dayofmonth(day) - 13).cast("bigint"), 9, 9833)
    # the month in which it lies: the mean of late days a month tells it but for one or two
    about = lambda n: F.floor(n / (DAYS / MONTHS - 12))
    near = lambda n: F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda i: F.least(F.greatest(about(n) + i, F.lit(0)), F.lit(MONTHS - 1)))
    of = lambda n: F.array_max(F.filter(near(n), lambda m: start(m) <= n))
    return _bound(new, lambda n: _bound(of(n), lambda m: F.date_add(F.add_months(F.lit(FIRST_DAY).cast("date"), m.cast("int")), (n - start(m) + 12).cast("int"))))


def _slashed(key: str, m: Column) -> Column:
    """Two digits, two digits and a year, with slashes."""
    one, two, year = (F.substring(m, i, n).cast("int") for i, n in ((1, 2), (4, 2), (7, 4)))
    either = feistel(key, "slash", (((year - 1800) * 12 + two - 1) * 12 + one - 1).cast("bigint"), 240, 240)
    pad = lambda n: F.lpad(n.cast("string"), 2, "0")
    both = _bound(either, lambda n: F.concat_ws("/", pad(n % 12 + 1), pad(F.floor(n / 12) % 12 + 1), (F.floor(n / 144) + 1800).cast("string")))
    out = F.when(one.between(1, 12) & two.between(1, 12), both)
    for notation in ("MM/dd/yyyy", "dd/MM/yyyy"):
        day = F.try_to_timestamp(m, F.lit(notation)).cast("date")
        out = out.when(day.isNotNull(), F.date_format(_late_day(key, day), notation))
    return F.when(year.between(1800, 2199), out.otherwise(m)).otherwise(m)


def _date(key: str, m: Column) -> Column:
    out = F.when(m.contains("/"), _slashed(key, m))
    for shape, notation in ((r"^\d{4}-", "yyyy-MM-dd"), (r"\.", "dd.MM.yyyy")):
        day = F.try_to_timestamp(m, F.lit(notation)).cast("date")
        place = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
        new = F.date_format(_day(feistel(key, "date", place, 189, 773)), notation)
        out = out.when(m.rlike(shape) & day.isNotNull() & place.between(0, DAYS - 1), new)
    return out.otherwise(m)


def _rest_97(text: Column) -> Column:
    """The number that an IBAN's characters (letters as 10 to 35) write, modulo 97."""
    code = lambda c: F.when(c <= "9", c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), lambda s, c: F.when(c <= "9", s * 10 + code(c)).otherwise(s * 100 + code(c)) % 97)


def _iban(key: str, m: Column) -> Column:
    """Country and form stay; the account is permuted, the check digits follow from it. The check digits must be the usual ones (02 to 98)."""
    country, account = F.substring(m, 1, 2), F.substring(m, F.lit(5), F.length(m))
    check = lambda of: F.lpad((98 - _rest_97(F.concat(of, country, F.lit("00")))).cast("string"), 2, "0")
    new = _bound(feistel_text(key, "iban", account), lambda x: F.concat(country, check(x), x))
    return F.when(F.substring(m, 3, 2) == check(account), new).otherwise(m)


def _values(m: Column) -> Column:
    """What is found, as an array: a run of groups is cut into its cards, from left to right, and what is between them.

    Each group is marked by the card that may begin at it: ``F`` for four groups, ``T`` for three, ``O`` for none. One pattern over
    the marked run then takes cards from left to right."""
    def mark(groups: Column) -> Column:
        def one(g: Column, i: Column) -> Column:
            of = lambda n: F.slice(groups, i + 1, F.lit(n))
            sizes = lambda n, wanted: F.array_join(F.transform(of(n), lambda x: F.length(x).cast("string")), "") == wanted
            right = lambda n: F.call_function("luhn_check", F.array_join(of(n), ""))
            return F.concat(F.when(sizes(4, "4444") & right(4), "F").when(sizes(3, "465") & right(3), "T").otherwise("O"), g)

        return F.transform(groups, one)

    groups = F.split(m, "[ -]")
    seps = F.regexp_extract_all(m, F.lit("[ -]"), F.lit(0))
    marked = F.array_join(F.zip_with(_bound(groups, mark), seps, lambda g, x: F.concat(g, F.coalesce(x, F.lit("")))), "")
    group = "[FTO][0-9]+"
    tokens = F.regexp_extract_all(marked, F.lit(f"F[0-9]+(?:[ -]{group}){{3}}|T[0-9]+(?:[ -]{group}){{2}}|{group}|[ -]"), F.lit(0))
    cut = F.transform(tokens, lambda x: F.regexp_replace(x, "[FTO]", ""))
    return F.when(m.rlike(f"^(?:{RUN})$"), cut).otherwise(F.array(m))


def pseudonym(key: str, m: Column) -> Column:
    """The pseudonym of one found value; itself where it is not valid."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    return (F.when(m.contains("@"), _email(key, m)).when(whole(IPV4), _ipv4(key, m)).when(whole(DATE), _date(key, m))
            .when(whole(IBAN), _iban(key, m)).when(whole(SSN), _ssn(key, m)).when(whole(NANP), _nanp(key, m)).when(whole(ABROAD), _abroad(key, m)).otherwise(_card(key, m)))


def pseudonymise(df: DataFrame, key: str | Column, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``df`` with the personal data of the whole text replaced; ``count_col`` adds how many values were replaced."""
    if not isinstance(key, Column) and not key:
        raise ValueError("a key is needed: without one anybody can undo the permutation")
    if count_col and count_col.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column {count_col} exists already; pass another name for count_col")
    found, new, secret = fresh(df, "found", "new", "secret")
    if isinstance(key, Column):
        df, key = df.withColumn(secret, key), F.col(secret)
    text = F.col(text_col)
    none = F.array().cast("array<array<string>>")
    marked = df.withColumn(found, F.when(text.rlike("[0-9@]"), F.transform(
        F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), _values)).otherwise(none))
    marked = marked.withColumn(new, F.transform(found, lambda values: F.transform(values, lambda m: pseudonym(key, m))))
    filled = F.concat_ws("", F.zip_with(F.split(text, PATTERN, -1), F.col(new), lambda a, b: F.concat(a, F.coalesce(F.array_join(b, ""), F.lit("")))))
    changed = F.zip_with(F.flatten(found), F.flatten(new), lambda a, b: a != b)
    count = F.coalesce(F.size(F.filter(changed, lambda x: x)), F.lit(0)) if count_col else None
    if count_col:
        marked = marked.withColumn(count_col, count)
    return marked.withColumn(text_col, F.when(F.size(found) > 0, filled).otherwise(text)).drop(found, new, secret)
