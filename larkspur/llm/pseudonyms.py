"""Personal data replaced by format-preserving Feistel pseudonyms, in DataFrame functions only.

What looks like a number, date, address or key is validated (check digits, octets, calendar,
reserved blocks), then permuted under a secret key within its own format: a card number stays
a card number with a right check digit, a date a date. A Feistel network changes one half
by a keyed hash of the other, in turn, adding modulo the size of each place, so the mapping is
one to one and equal values get equal pseudonyms in every document, whatever their
separators. What fails validation is left as it is. A run of
digits is searched for cards at each of its groups, so a neighbour does not hide a value.

Formats: e-mail addresses (the part before the @, linked whatever its case), IPv4 and IPv6 addresses, bank
account numbers (IBAN, modulo 97), card numbers (Luhn), social security numbers, dates of the years 1900 to 2099 (year-month-day with - or /, day.month.year,
month/day/year), North American telephone numbers and those with a + and country code, and keys or passwords after their names, in
whatever case these are written.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.common import let, table

#: session setting that holds the secret
SECRET_KEY = "spark.larkspur.pseudonym.secret"
_PROGRAM_SECRET = secrets.token_hex(32)
ROUNDS = 8

# a possessive group is a loop for the matcher; a greedy one would take a stack frame for every label
EMAIL = r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![A-Za-z0-9])"
# eight groups, or fewer around one ::, with a digit among them
IPV6 = r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]{0,38}\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|::(?:[0-9A-Fa-f]{1,4}:){0,6}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,7}:)(?![0-9A-Za-z:])"
IPV4 = r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\d|\.\d)"
SSN = r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])"
DATE = r"(?<![\d./\-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?!\d|[./\-]\d)"
# +1 or brackets mark a telephone number whatever its digits; bare groups need codes that begin with 2-9
NATIONAL = r"(?:(?<![\d+])\+1[ .\-]?(?:\(\d{3}\) ?|\d{3}[ .\-]?)|(?<![\d+.\-])\(\d{3}\) ?)\d{3}[ .\-]?\d{4}(?!\d)"
BARE = r"(?<![\d+.\-])[2-9]\d{2}[ .\-][2-9]\d{2}[ .\-]\d{4}(?!\d)"
# a country code and 6 to 14 more digits; it ends before a value of another kind
ABROAD = rf"(?<![\d+])\+[1-9](?=(?:[ .\-()]{{0,3}}\d){{7}})(?:\d|[ .\-]?\(\d{{1,5}}\)|[ .\-](?!{SSN}|{DATE}|{IPV4}|{BARE}|(?:\d{{4}}[ \-]){{3}}\d{{4}}(?!\d))\d){{4,14}}(?!\d)"
PHONE = f"{NATIONAL}|{BARE}|{ABROAD}"
# a run of digits goes up to where a value of another kind begins; the cards are looked for inside it
OTHERS = "|".join([EMAIL, IPV4, SSN, DATE, PHONE])
CARD = rf"(?<![\d+])\d(?:\d|[ \-](?!{OTHERS})\d){{12,}}+"
# digits of the groups as cards are written; the second form begins like one of the first
GROUPED = ["4444", "465", "464", "4443", "4442", "4441", "445", "4333"]
UNBROKEN, LONGEST = r"\d{13,19}|\d{6}[ \-]\d{13}", r"\d{4}(?:[ \-]\d{4}){3}[ \-]\d{3}"
# country codes have one, two or three digits
COUNTRY = r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
NAMED = r"(?<![A-Za-z0-9])(?=[A-Za-z0-9+/_\-]{8})(?<=(?i:password|passwd|secret|token|api_key)\s{0,3}[=:]\s{0,3}[\"']?)[A-Za-z0-9+/_\-]{8,}+"
CLOUD_KEY = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"
ANY = "|".join([EMAIL, IBAN, IPV6, IPV4, SSN, DATE, PHONE, CARD, NAMED, CLOUD_KEY])

# day numbers of 1900-01-01 and 2099-12-31; 73,049 days = 17 * 4,297
FIRST_DAY, DAYS = -25567, (17, 4297)
# area numbers 001-899 without 666; group 01-99 with serial 0001-9999
SSN_AREAS, SSN_REST = 898, 99 * 9999
_SERIALS = 9999

MARK = "\x01"


def secret_of(spark: SparkSession) -> str:
    """The secret of the session; where none is set, one drawn for this program, which nobody can know later.

    Pseudonyms are then linked across the documents of a program, not across programs.
    """
    return spark.conf.get(SECRET_KEY, None) or spark.sparkContext.getConf().get(SECRET_KEY) or _PROGRAM_SECRET


def _digest(secret: str, tweak: str, turn: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(secret), F.lit(tweak), turn.cast("string"), half.cast("string")), 512)


def _turns() -> Column:
    return F.array(*[F.lit(i) for i in range(ROUNDS)])


def permuted_number(value: Column, sizes: tuple[int, int], secret: str, tweak: str) -> Column:
    """A permutation of 0 .. a*b-1 by a Feistel network over the two digits of base (a, b)."""
    a, b = sizes

    def step(acc, i):
        def moved(own, other, size):
            hashed = F.conv(F.substring(_digest(secret, tweak, i, other), 1, 15), 16, 10).cast("long")
            return F.pmod(own + hashed, F.lit(size).cast("long"))

        return F.struct(
            F.when(i % 2 == 0, moved(acc["l"], acc["r"], a)).otherwise(acc["l"]).alias("l"),
            F.when(i % 2 == 1, moved(acc["r"], acc["l"], b)).otherwise(acc["r"]).alias("r"),
        )

    start = F.struct(F.floor(value / b).cast("long").alias("l"), F.pmod(value, F.lit(b)).cast("long").alias("r"))
    return F.aggregate(_turns(), start, step, lambda acc: acc["l"] * b + acc["r"])


def permuted_text(value: Column, secret: str, tweak: str) -> Column:
    """Each digit stays a digit, each letter a letter of its case; other characters stay."""

    def place(key, c, j):
        by = F.conv(F.substring(key, (j % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        code = F.ascii(c)
        turned = F.lit(None).cast("int")
        for first, size in ((48, 10), (65, 26), (97, 26)):
            turned = F.when(code.between(first, first + size - 1), (code - first + by) % size + first).otherwise(turned)
        return F.coalesce(F.char(turned), c)

    return _two_halves(value, secret, tweak, place)


HEX = "0123456789abcdef"


def permuted_hex(value: Column, secret: str, tweak: str) -> Column:
    """Lower-case hexadecimal digits, each of which stays one."""

    def place(key, c, j):
        at = F.instr(F.lit(HEX), c) - 1 + F.conv(F.substring(key, (j % 64) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        return F.substring(F.lit(HEX), at % 16 + 1, F.lit(1))

    return _two_halves(value, secret, tweak, place)


def _two_halves(value: Column, secret: str, tweak: str, place) -> Column:
    """A Feistel network whose halves are texts; ``place(key, character, index)`` moves one character by the hash of the other half."""

    def added(own, other, i):
        # one digest a round, whatever the length
        return let(_digest(secret, tweak, i, other), lambda key: F.array_join(F.transform(F.split(own, ""), lambda c, j: place(key, c, j)), ""))

    def step(acc, i):
        return F.struct(
            F.when(i % 2 == 0, added(acc["l"], acc["r"], i)).otherwise(acc["l"]).alias("l"),
            F.when(i % 2 == 1, added(acc["r"], acc["l"], i)).otherwise(acc["r"]).alias("r"),
        )

    half = F.floor(F.char_length(value) / 2).cast("int")
    start = F.struct(F.substring(value, F.lit(1), half).alias("l"), F.substring(value, half + 1, F.char_length(value)).alias("r"))
    return F.aggregate(_turns(), start, step, lambda acc: F.concat(acc["l"], acc["r"]))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _refilled(x: Column, digits: Column) -> Column:
    """The digits in the places of the digits of ``x``."""

    return let(digits, lambda d: F.array_join(F.transform(F.split(x, ""), lambda c, j: _placed(x, d, c, j)), ""))


def _placed(x: Column, digits: Column, c: Column, j: Column) -> Column:
    nth = F.char_length(_digits(F.substring(x, F.lit(1), j + 1)))
    return F.when(c.between("0", "9"), F.substring(digits, nth, F.lit(1))).otherwise(c)


def luhn_sum(digits: Column) -> Column:
    def worth(c, i):
        v = c.cast("int") * (1 + i % 2)
        return v - F.when(v > 9, 9).otherwise(0)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda a, v: a + v)


def _card(x: Column, secret: str) -> Column:
    def whole(d):
        n = F.char_length(d)
        inner = permuted_text(F.substring(d, F.lit(2), n - 2), secret, "card")
        payload = F.concat(F.substring(d, 1, 1), inner)
        full = let(payload, lambda p: F.concat(p, F.pmod(-luhn_sum(F.concat(p, F.lit("0"))), F.lit(10)).cast("string")))
        return _refilled(x, full)

    return let(_digits(x), whole)


def _luhn(x: Column) -> Column:
    return luhn_sum(_digits(x)) % 10 == 0


def _cards(x: Column, secret: str) -> Column:
    """A run of digits with the valid cards inside it replaced; what stands beside them stays.

    A card is an unbroken number or has the groups of one, and may begin at any group of the
    run. A run of 13 to 19 digits in other groups is a card if it is valid as a whole.
    """
    grouped = [r"[ \-]".join(rf"\d{{{n}}}" for n in form) for form in GROUPED]
    forms = [LONGEST, "|".join([UNBROKEN, *grouped])]
    starts = [F.regexp_extract_all(x, F.lit(rf"(?<!\d)(?=((?:{form})(?!\d)))"), F.lit(1)) for form in forms]

    def inside(valid):
        any_card = F.concat(F.lit(r"(?<!\d)(?:"), F.array_join(valid, "|"), F.lit(r")(?!\d)"))

        def cut(pattern):
            def filled(finds):
                return F.array_join(F.transform(F.split(x, pattern, -1), lambda g, i: F.concat(g, F.coalesce(_card(F.get(finds, i), secret), F.lit("")))), "")

            return let(F.regexp_extract_all(x, pattern, F.lit(0)), filled)

        alone = F.char_length(_digits(x)).between(13, 19) & _luhn(x)
        return F.when(F.size(valid) > 0, let(any_card, cut)).when(alone, _card(x, secret)).otherwise(x)

    return let(F.array_distinct(F.filter(F.concat(*starts), _luhn)), inside)


def _phone(x: Column, secret: str) -> Column:
    """North America: the last two digits of the area, the last two of the exchange and the line move.

    Elsewhere all that follows the country code moves.
    """

    def whole(d):
        own = F.substring(d, -10, 10)
        moving = F.concat(F.substring(own, 2, 2), F.substring(own, 5, 6))
        done = let(permuted_text(moving, secret, "phone"), lambda m: F.concat(F.substring(own, 1, 1), F.substring(m, 1, 2), F.substring(own, 4, 1), F.substring(m, 3, 6)))
        country = F.regexp_extract(d, f"^(?:{COUNTRY})", 0)
        rest = F.substring(d, F.char_length(country) + 1, F.char_length(d))
        abroad = F.concat(country, permuted_text(rest, secret, "phone abroad"))
        national = ~F.startswith(x, F.lit("+")) | d.rlike(r"^1\d{10}$")
        return F.when(national, F.concat(F.substring(d, F.lit(1), F.char_length(d) - 10), done)).otherwise(abroad)

    return _refilled(x, let(_digits(x), whole))


def _ssn(x: Column, secret: str) -> Column:
    area, group, serial = (F.substring(x, at, n).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = (area - 1 - F.when(area > 666, 1).otherwise(0)) * SSN_REST + (group - 1) * _SERIALS + serial - 1

    def written(v):
        a = F.floor(v / SSN_REST) + 1
        a = a + F.when(a >= 666, 1).otherwise(0)
        rest = F.pmod(v, F.lit(SSN_REST))
        pads = ((a, 3), (F.floor(rest / _SERIALS) + 1, 2), (rest % _SERIALS + 1, 4))
        return F.concat_ws("-", *[F.lpad(p.cast("string"), n, "0") for p, n in pads])

    return F.when(valid, let(permuted_number(index, (SSN_AREAS, SSN_REST), secret, "ssn"), written)).otherwise(x)


def _ipv4(x: Column, secret: str) -> Column:
    def whole(o):
        octets = [o[i].cast("long") for i in range(4)]
        valid = (octets[0] < 256) & (octets[1] < 256) & (octets[2] < 256) & (octets[3] < 256)
        value = octets[0] * (1 << 24) + octets[1] * (1 << 16) + octets[2] * 256 + octets[3]
        moved = permuted_number(value, (1 << 16, 1 << 16), secret, "ipv4")
        return F.when(valid, let(moved, lambda v: F.concat_ws(".", *[F.shiftright(v, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]))).otherwise(x)

    return let(F.split(x, r"\."), whole)


def _date(x: Column, secret: str) -> Column:
    forms = [(r"^\d{4}-", "yyyy-MM-dd", (1, 6, 9)), (r"^\d{4}/", "yyyy/MM/dd", (1, 6, 9)), (r"^\d{2}\.", "dd.MM.yyyy", (7, 4, 1)), (r"^\d{2}/", "MM/dd/yyyy", (7, 1, 4))]
    out = x
    for pattern, form, (y, m, d) in forms:
        iso = F.concat_ws("-", F.substring(x, y, 4), F.substring(x, m, 2), F.substring(x, d, 2))
        day = F.unix_date(F.try_to_date(iso, "yyyy-MM-dd")).cast("long") - FIRST_DAY
        moved = let(day, lambda v: F.when(v.between(0, DAYS[0] * DAYS[1] - 1), permuted_number(v, DAYS, secret, "date")))
        text = F.date_format(F.date_from_unix_date((moved + FIRST_DAY).cast("int")), form)
        out = F.when(x.rlike(pattern), F.coalesce(text, x)).otherwise(out)
    return out


def _email(x: Column, secret: str) -> Column:
    """The name is permuted in lower case and takes back the case of its places, so that cases are linked."""
    at = F.instr(x, "@")
    name = F.substring(x, F.lit(1), at - 1)

    def cased(own):
        return let(permuted_text(F.lower(name), secret, "email"), lambda new: F.array_join(F.transform(F.split(new, ""), lambda c, j: F.when(F.get(own, j).between("A", "Z"), F.upper(c)).otherwise(c)), ""))

    return F.concat(let(F.split(name, ""), cased), F.substring(x, at, F.char_length(x)))


def mod_97(x: Column) -> Column:
    """A number of digits and letters (A is 10) modulo 97."""

    def taken(acc, c):
        code = F.ascii(c).cast("int")
        return F.when(c.between("0", "9"), (acc * 10 + code - 48) % 97).otherwise((acc * 100 + code - 55) % 97)

    return F.aggregate(F.split(x, ""), F.lit(0), taken)


def _iban(x: Column, secret: str) -> Column:
    """The country stays, the account is permuted, the check digits are made right again."""

    def whole(d):
        country, account = F.substring(d, 1, 2), F.substring(d, F.lit(5), F.char_length(d))

        def checked(new):
            check = F.lpad((98 - mod_97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
            return let(F.concat(country, check, new), spaced)

        def spaced(full):
            def nth(c, j):
                return F.when(c == " ", c).otherwise(F.substring(full, F.char_length(F.replace(F.substring(x, F.lit(1), j + 1), F.lit(" "), F.lit(""))), F.lit(1)))

            return F.array_join(F.transform(F.split(x, ""), nth), "")

        valid = (mod_97(F.concat(account, F.substring(d, 1, 4))) == 1) & F.char_length(d).between(15, 34)
        return F.when(valid, let(permuted_text(account, secret, "iban"), checked)).otherwise(x)

    return let(F.replace(x, F.lit(" "), F.lit("")), whole)


def _ipv6(x: Column, secret: str) -> Column:
    """All 128 bits are permuted as eight full groups, so that every way to write an address is linked."""

    def groups(part):
        return F.transform(F.filter(F.split(part, ":"), lambda g: g != ""), lambda g: F.lpad(F.lower(g), 4, "0"))

    def whole(sides):
        left, right = groups(F.get(sides, 0)), groups(F.coalesce(F.get(sides, 1), F.lit("")))
        missing = 8 - F.size(left) - F.size(right)
        full = F.concat(left, F.array_repeat(F.lit("0000"), F.greatest(missing, F.lit(0))), right)
        valid = F.when(F.size(sides) == 2, missing >= 1).otherwise(missing == 0)
        moved = let(permuted_hex(F.array_join(full, ""), secret, "ipv6"), lambda h: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring(h, i * 4 + 1, F.lit(4))), ":"))
        return F.when(valid, moved).otherwise(x)

    return let(F.split(x, "::"), whole)


def pseudonym(x: Column, secret: str) -> Column:
    """The pseudonym of one found value."""
    kinds = [(EMAIL, _email), (IBAN, _iban), (IPV6, _ipv6), (IPV4, _ipv4), (SSN, _ssn), (DATE, _date), (PHONE, _phone), (CARD, _cards)]
    out = F.when(x.rlike(f"^(?:{CLOUD_KEY})$"), F.concat(F.substring(x, 1, 4), permuted_text(F.substring(x, 5, 16), secret, "key")))
    out = out.otherwise(permuted_text(x, secret, "secret"))
    for pattern, make in reversed(kinds):
        out = F.when(x.rlike(rf"\A(?:{pattern})\z"), make(x, secret)).otherwise(out)
    return out


def _parts(text: Column) -> Column:
    """Text between finds and finds, in turn. A text that holds the mark itself is cut the slower way."""
    marked = F.split(F.regexp_replace(text, f"({ANY})", f"{MARK}$1{MARK}"), MARK)
    # pairs (gap, find) flattened; the text ends with a gap
    finds = F.regexp_extract_all(text, F.lit(f"({ANY})"), F.lit(1))
    gaps = F.split(text, f"(?:{ANY})", -1)
    paired = let(finds, lambda f: F.transform(gaps, lambda g, i: F.array(g, F.coalesce(F.get(f, i), F.lit("")))))
    return F.when(F.contains(text, F.lit(MARK)), F.flatten(paired)).otherwise(marked)


def _rewritten(text: Column, secret: str) -> Column:
    """(text, found): the text with its pseudonyms, and how many places were found; null for null."""

    def joined(parts):
        each = F.transform(parts, lambda x, i: F.when((i % 2 == 1) & (x != ""), pseudonym(x, secret)).otherwise(x))
        return F.struct(F.array_join(each, "").alias("text"), F.floor(F.size(parts) / 2).cast("long").alias("found"))

    return F.when(text.isNotNull(), let(_parts(text), joined))


def pseudonymise(docs: DataFrame, secret: str | None = None, column: str = "text") -> DataFrame:
    """The same rows and columns; values in ``column`` are replaced, n_chars (if there) follows.

    The secret is that of the session (``secret_of``) unless one is given.

    Null stays null, empty stays empty; every row is treated alike, repeated or not, and no
    row meets another. No documents give no rows. Columns of any name pass through.
    """
    secret = secret or secret_of(docs.sparkSession)
    rows = docs.select(F.struct("*").alias("own"), _rewritten(F.col(column), secret)["text"].alias("new"))
    out = []
    for name in docs.columns:
        own = F.col(f"own.`{name}`")
        if name == column:
            out.append(F.col("new").alias(name))
        elif name == "n_chars":
            out.append(F.when(F.col(f"own.`{column}`") != F.col("new"), F.char_length("new").cast("long")).otherwise(own).alias(name))
        else:
            out.append(own.alias(name))
    return rows.select(*out)


def query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", _rewritten(F.col("text"), secret_of(spark)).alias("r"))
    return docs.select("doc_id", F.coalesce("r.found", F.lit(0).cast("long")).alias("n_found"), F.col("r.text").alias("text"))


def stage(spark, docs, sf_dir):
    """All documents, pseudonymised."""
    return pseudonymise(docs)
