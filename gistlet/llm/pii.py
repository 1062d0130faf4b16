r"""Format-preserving Feistel pseudonyms for personal data, in DataFrame functions only.

What is found and validated is replaced by another value of the same format:

- card numbers (13-19 digits, valid by Luhn): the digits before the check digit are permuted and
  the check digit is computed anew;
- phone numbers (3-3-4 digits with separators, with or without a country code): the ten digits;
  those with a plus and 8 to 15 digits in any grouping: the digits after the country code;
- IPv4 addresses, social security numbers, dates (ISO, day/month/year, day.month.year,
  month/day/year where only that is a date; 1900 to 2099): permuted among the valid ones;
- IPv6 addresses (eight groups, or ``::`` after a first group of four digits): all 32 digits, written
  out in eight groups, so that spellings of one address get one pseudonym;
- IBANs (length by country, valid modulo 97): the account part, and the check digits computed anew;
- e-mail addresses: the local part, letter for letter of the same alphabet and digit for digit. A local
  part with a letter of a script that ``ALPHABETS`` lacks becomes ``u`` and 16 keyed hex digits.

Numbers without a plus and of other forms, ``::1`` and passports or tax numbers are not looked for.

A keyed Feistel network permutes each format's domain: two halves, of numbers or of
characters, take turns in adding a keyed SHA-2 value of the other half, modulo their size. Values
outside a domain that is not a product of two sizes are permuted again until they are inside
(cycle walking). So equal values get equal pseudonyms in all documents, different ones
different, and the key's holder can invert them. Numbers that fail validation stay.

The key is an argument. It reaches the rows as a scalar subquery over a local relation, so that no plan text, and no
event log, shows it.

A null text stays null and an empty one empty. Each row is changed for itself, so repeated
rows, ties and any doc_id are no matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Session setting with the key (Spark redacts settings of such names), and the public key of tests and trial runs.
KEY_SETTING = "spark.gistlet.pseudonym.secret"
TEST_KEY = "pseudonym key 1"
ROUNDS = 8
WALK = 200      # steps of cycle walking; the share outside a domain is under one half

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# First and last code points of alphabets. Letters and digits are permuted within theirs.
ALPHABETS = [(0x30, 0x39), (0x61, 0x7A), (0x41, 0x5A),                      # digits, Latin letters
             (0xE0, 0xF6), (0xC0, 0xD6), (0xF8, 0xFF), (0xD8, 0xDF), (0x100, 0x17F),
             (0x3B1, 0x3C9), (0x391, 0x3A1), (0x3A3, 0x3A9), (0x3AC, 0x3AF), (0x3CC, 0x3CE),     # Greek
             (0x430, 0x44F), (0x410, 0x42F), (0x450, 0x45F), (0x400, 0x40F),                     # Cyrillic
             (0x5D0, 0x5EA), (0x621, 0x63A), (0x641, 0x64A), (0x904, 0x939), (0xE01, 0xE30),     # Hebrew to Thai
             (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3)]             # Japanese, Chinese, Korean
#: The sixteen hex digits take part as private characters, where they are an alphabet of their own.
HEX, PRIVATE = "0123456789abcdef", "".join(map(chr, range(0xE000, 0xE010)))
OTHER_SCRIPT = r"[\p{L}\p{N}&&[^" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ALPHABETS) + "]]"
# Lengths of IBANs by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL SD", 19: "MK SI", 20: "AT BA EE KZ XK LT LU", 21: "HR LV LI CH",
    22: "BH BG CR GE DE IE ME RS GB VA", 23: "GI IQ IL TL AE", 24: "AD CZ MD PK RO SA SK ES SE TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "FR GR IT MR MC SM", 28: "AL AZ BY CY DO GT HU LB PL", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC"}
# Country codes of telephone numbers that have one or two digits; all others have three.
CALLING = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"
_IBAN = "|".join(f"(?:{names.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{size - 4}}}" for size, names in IBAN_LENGTHS.items())
_H = "[0-9A-Fa-f]{1,4}"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}\p{M}._%+-])[\p{L}\p{N}\p{M}._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    "date": (r"(?<![0-9./-])(?:(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9]"
             r"|[0-3]?[0-9]/[0-3]?[0-9]/(?:19|20)[0-9]{2}|[0-3]?[0-9]\.[01]?[0-9]\.(?:19|20)[0-9]{2})(?![0-9]|[/-][0-9])"),
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "ipv6": (rf"(?<![\p{{L}}\p{{N}}:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:{_H}:){{7}}{_H}"
             rf"|[0-9A-Fa-f]{{4}}(?::{_H}){{0,5}}::(?:{_H}(?::{_H}){{0,5}})?)(?![\p{{L}}\p{{N}}:]|\.[0-9])"),
    "iban": rf"(?<![\p{{L}}\p{{N}}])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_IBAN})(?![\p{{L}}\p{{N}}])",
    "phone": (r"(?<![\p{L}\p{N}])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|(?<![0-9])[0-9]{3}[ .-])"
              r"[0-9]{3}[ .-][0-9]{4}(?![0-9])"
              r"|(?<![\p{L}\p{N}+])\+[1-9](?:[ ().-]{0,2}[0-9]){7,14}(?![0-9])"),
    "card": (r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}"
             r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])"),
}
ANY = "|".join(PATTERNS.values())


_NATIONAL = r"^(\+[0-9]{1,3}[ .-]?)?(\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}$"


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` names it more than once."""
    return F.transform(F.array(value), use)[0]


def _secret(key, kind, turn: Column, half: Column, block: Column) -> Column:
    """128 hex digits from the key, the kind, the round, the other half and a block number."""
    return F.sha2(F.concat_ws("|", _lit(key), _lit(kind), turn.cast("string"), half, block.cast("string")), 512)


def _hex(text: Column, start: Column | int, size: int) -> Column:
    return F.conv(F.substring(text, start, size), 16, 10).cast("long")


def permute_number(value: Column, a: int, b: int, key, kind) -> Column:
    """A keyed permutation of 0 .. a * b - 1: the halves are value div b and value mod b."""
    def turn(acc: Column, i: Column) -> Column:
        def moved(x: Column, other: Column, size: int) -> Column:
            return F.pmod(x + _hex(_secret(key, kind, i, other.cast("string"), F.lit(0)), 1, 14), F.lit(size))

        odd = i % 2 == 1
        return F.struct(F.when(odd, moved(acc["l"], acc["r"], a)).otherwise(acc["l"]).alias("l"),
                        F.when(odd, acc["r"]).otherwise(moved(acc["r"], acc["l"], b)).alias("r"))

    start = F.struct(F.floor(value / b).cast("long").alias("l"), F.pmod(value, F.lit(b)).cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn, lambda acc: acc["l"] * b + acc["r"])


def permute_text(text: Column, key, kind) -> Column:
    """A keyed permutation of strings that keeps each place's alphabet; other characters stay."""
    code = F.transform(F.split(text, ""), lambda c: F.ascii(c))

    def letter(c: Column) -> Column:
        def place(value: Column, size: int, base: Column) -> Column:
            return F.struct(value.cast("long").alias("v"), F.lit(size).alias("size"), base.cast("int").alias("base"))

        out = None
        for first, last in [*ALPHABETS, (ord(PRIVATE[0]), ord(PRIVATE[-1]))]:
            inside, at = c.between(first, last), place(c - first, last - first + 1, F.lit(first))
            out = F.when(inside, at) if out is None else out.when(inside, at)
        return out.otherwise(place(F.lit(0), 1, c))

    letters = F.transform(code, letter)
    n = F.floor(F.size(letters) / 2).cast("int")

    def turn(acc: Column, i: Column) -> Column:
        def moved(x: Column, other: Column) -> Column:
            said = F.array_join(F.transform(other, lambda o: o["v"].cast("string")), ",")
            return F.transform(x, lambda o, j: F.struct(
                F.pmod(o["v"] + _hex(_secret(key, kind, i, said, F.floor(j / 16)), (j % 16) * 8 + 1, 8),
                       o["size"].cast("long")).alias("v"), o["size"].alias("size"), o["base"].alias("base")))

        odd = i % 2 == 1
        return F.struct(F.when(odd, moved(acc["l"], acc["r"])).otherwise(acc["l"]).alias("l"),
                        F.when(odd, acc["r"]).otherwise(moved(acc["r"], acc["l"])).alias("r"))

    start = F.struct(F.slice(letters, 1, n).alias("l"), F.slice(letters, n + 1, F.size(letters)).alias("r"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn,
                       lambda acc: F.concat(acc["l"], acc["r"]))
    def written(o: Column, c: Column) -> Column:
        new = (o["base"] + o["v"]).cast("long")
        wide = F.decode(F.unhex(F.lpad(F.hex(new), 4, "0")), "UTF-16BE")
        return F.when(o["size"] == 1, c).when(new < 128, F.char(new)).otherwise(wide)

    return F.array_join(F.zip_with(done, F.split(text, ""), written), "")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _refilled(match: Column, chars: Column, among: str = "0123456789") -> Column:
    """``match`` with its characters of ``among`` replaced in turn by ``chars``."""
    def step(acc: Column, c: Column) -> Column:
        counts = F.lit(among).contains(c)
        return F.struct(F.concat(acc["o"], F.when(counts, F.substring(chars, acc["k"], F.lit(1))).otherwise(c)).alias("o"),
                        F.when(counts, acc["k"] + 1).otherwise(acc["k"]).alias("k"))

    return F.aggregate(F.split(match, ""), F.struct(F.lit("").alias("o"), F.lit(1).alias("k")), step, lambda acc: acc["o"])


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a number with its check digit."""
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * (1 + i % 2)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, v: a + v)


def mod97(text: Column) -> Column:
    """Remainder modulo 97 of a number in which letters stand for 10 to 35."""
    def step(acc: Column, c: Column) -> Column:
        return F.pmod(F.when(c.between("0", "9"), acc * 10 + c.try_cast("int")).otherwise(acc * 100 + F.ascii(c) - 55), F.lit(97))

    return F.aggregate(F.split(text, ""), F.lit(0), step)


def _calling(digits: Column) -> Column:
    """Country code of a number that began with a plus."""
    return F.regexp_extract(digits, f"^({CALLING}|[0-9]{{3}})", 1)


def _groups(match: Column) -> Column:
    """The eight groups of an IPv6 address, of four digits each; null if it is none."""
    side = F.split(match, "::", -1)

    def of(i: int) -> Column:
        return F.filter(F.split(F.coalesce(F.get(side, F.lit(i)), F.lit("")), ":"), lambda g: g != "")

    def filled(z: Column) -> Column:
        missing = 8 - F.size(z["a"]) - F.size(z["b"])
        short = match.contains("::")
        right = F.when(short, (missing >= 1) & (missing <= 6)).otherwise(missing == 0)
        every = F.concat(z["a"], F.array_repeat(F.lit("0"), F.greatest(missing, F.lit(0))), z["b"])
        return F.when(right, F.transform(every, lambda g: F.lpad(F.lower(g), 4, "0")))

    return _bound(F.struct(of(0).alias("a"), of(1).alias("b")), filled)


def body_of(kind: Column, match: Column) -> Column:
    """The characters of a match that the text permutation moves; null where there are none or validation fails."""
    digits, local = _digits(match), F.substring_index(match, "@", 1)
    bare = F.replace(match, F.lit(" "), F.lit(""))
    account = F.substring(bare, F.lit(5), F.length(bare))
    return (F.when(kind == "email", F.when(~local.rlike(OTHER_SCRIPT), local))
            .when(kind == "card", F.when(luhn_sum(digits) % 10 == 0, F.substring(digits, F.lit(1), F.length(digits) - 1)))
            .when(kind == "phone", F.when(match.rlike(_NATIONAL), F.substring(digits, -10, 10))
                  .otherwise(F.substring(digits, F.length(_calling(digits)) + 1, F.length(digits))))
            .when(kind == "iban", F.when(mod97(F.concat(account, F.substring(bare, 1, 4))) == 1, account))
            .when(kind == "ipv6", F.translate(F.array_join(_groups(match), ""), HEX, PRIVATE)))


def _email(match: Column, new: Column, key) -> Column:
    local = F.substring_index(match, "@", 1)
    hashed = F.concat(F.lit("u"), F.substring(F.sha2(F.concat_ws("|", _lit(key), F.lit("local"), local), 256), 1, 16))
    return F.concat(F.coalesce(new, hashed), F.substring(match, F.length(local) + 1, F.length(match)))


def _card(match: Column, new: Column, key) -> Column:
    check = F.pmod(-luhn_sum(F.concat(new, F.lit("0"))), F.lit(10))
    return _refilled(match, F.concat(new, check.cast("string")))


def _phone(match: Column, new: Column, key) -> Column:
    digits = _digits(match)
    return _refilled(match, F.concat(F.substring(digits, F.lit(1), F.length(digits) - F.length(new)), new))


def _iban(match: Column, new: Column, key) -> Column:
    country = F.substring(match, 1, 2)
    check = F.lpad((98 - mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    return _refilled(match, F.concat(country, check, new), "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _ipv6(match: Column, new: Column, key) -> Column:
    digits = F.translate(new, PRIVATE, HEX)
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring(digits, i * 4 + 1, F.lit(4))), ":")


def _ip(match: Column, key) -> Column:
    value = F.aggregate(F.split(match, r"\."), F.lit(0).cast("long"), lambda a, o: a * 256 + o.cast("long"))
    new = permute_number(value, 1 << 16, 1 << 16, key, "ip")

    def octets(n: Column) -> Column:
        return F.concat_ws(".", *[F.pmod(F.shiftright(n, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)])

    return _bound(new, octets)


def _ssn(match: Column, key) -> Column:
    part = F.split(match, "-")
    area = part[0].cast("long")
    area = F.when(area > 666, area - 2).otherwise(area - 1)                     # 1-899 without 666: 898 values
    new = permute_number((area * 99 + part[1].cast("long") - 1) * 9999 + part[2].cast("long") - 1, 898, 99 * 9999, key, "ssn")

    def parts(n: Column) -> Column:
        high, low = F.floor(n / (99 * 9999)).cast("long"), F.pmod(n, F.lit(99 * 9999))
        return F.concat_ws("-", F.lpad(F.when(high >= 665, high + 2).otherwise(high + 1).cast("string"), 3, "0"),
                           F.lpad((F.floor(low / 9999) + 1).cast("string"), 2, "0"),
                           F.lpad((F.pmod(low, F.lit(9999)) + 1).cast("string"), 4, "0"))

    return _bound(new, parts)


_DAYS = 73049       # 1900-01-01 to 2099-12-31


def _date(match: Column, key) -> Column:
    epoch = F.to_date(F.lit("1900-01-01"))
    part = F.split(match, "[^0-9]")
    iso, slash = F.length(part[0]) == 4, match.contains("/")
    year, day, month = F.when(iso, part[0]).otherwise(part[2]), F.when(iso, part[2]).otherwise(part[0]), part[1]

    def made(y: Column, m: Column, d: Column) -> Column:
        return F.try_to_date(F.concat_ws("-", y, F.lpad(m, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")

    first, second = made(year, month, day), made(year, day, month)
    swapped = first.isNull() & slash & second.isNotNull()
    value = F.datediff(F.coalesce(first, F.when(slash, second)), epoch).cast("long")

    def walk(acc: Column, _: Column) -> Column:
        def state(new: Column) -> Column:
            # month/day/year is permuted among the dates that can only be read so
            inside = (new < _DAYS) & (~acc["american"] | (F.dayofmonth(F.date_add(epoch, new.cast("int"))) > 12))
            return F.struct(new.alias("v"), inside.alias("done"), acc["american"].alias("american"))

        return F.when(acc["done"], acc).otherwise(_bound(permute_number(acc["v"], 271, 270, key, "date"), state))

    new = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.struct(value.alias("v"), F.lit(False).alias("done"), swapped.alias("american")), walk,
                      lambda acc: F.date_add(epoch, acc["v"].cast("int")))
    padded = (F.length(part[0]) >= 2) & (F.length(part[1]) == 2)

    def two(x: Column) -> Column:
        return F.when(padded, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))

    def form(day: Column) -> Column:
        d, m, y = two(F.dayofmonth(day)), two(F.month(day)), F.year(day).cast("string")
        sep = F.when(iso, "-").when(slash, "/").otherwise(".")
        return F.when(iso, F.concat(y, sep, m, sep, d)).when(swapped, F.concat(m, sep, d, sep, y)).otherwise(F.concat(d, sep, m, sep, y))

    out = _bound(new, form)
    return F.coalesce(F.when(value.between(0, _DAYS - 1), out), match)


_NUMBERS = {"ip": _ip, "date": _date, "ssn": _ssn}
_TEXTS = {"email": _email, "card": _card, "phone": _phone, "iban": _iban, "ipv6": _ipv6}


def kind_of(match: Column) -> Column:
    """Which pattern a match is of; lookarounds hold for it already, so its form decides."""
    return (F.when(match.contains("@"), "email")
            .when(match.contains(":"), "ipv6")
            .when(match.startswith("+"), "phone")
            .when(match.rlike("^[A-Z]"), "iban")
            .when(match.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), "ip")
            .when(match.rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}([/.])[0-9]{1,2}\2[0-9]{4})$"), "date")
            .when(match.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
            .when(match.rlike(_NATIONAL), "phone")
            .otherwise("card"))


def changes(found: Column, key) -> Column:
    """(kind, old, new) of each match; a value that fails validation is its own pseudonym.

    Each step is an array of its own, so that the text permutation stands in the plan once, whatever the kind."""
    kinds = F.transform(found, lambda m: F.struct(kind_of(m).alias("kind"), m.alias("old")))
    bodies = F.transform(kinds, lambda c: F.struct(c["kind"], c["old"], body_of(c["kind"], c["old"]).alias("body")))
    moved = F.transform(bodies, lambda c: F.struct(c["kind"], c["old"], F.when(
        c["body"].isNotNull(), permute_text(c["body"], key, c["kind"])).alias("body")))

    def done(c: Column) -> Column:
        made = None
        for name, make in (_NUMBERS | _TEXTS).items():
            value = make(c["old"], key) if name in _NUMBERS else make(c["old"], c["body"], key)
            if name in _TEXTS and name != "email":
                value = F.when(c["body"].isNotNull(), value)
            made = F.when(c["kind"] == name, value) if made is None else made.when(c["kind"] == name, value)
        return F.struct(c["kind"], c["old"], F.coalesce(made, c["old"]).alias("new"))

    return F.transform(moved, done)


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting, or the public one where it is unset."""
    return spark.conf.get(KEY_SETTING, TEST_KEY)


def pseudonyms(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text with pseudonyms, and how many values of each kind were replaced."""
    text = F.col(text_col).cast("string")
    hidden = docs.sparkSession.sql("SELECT * FROM VALUES (:k) AS t(k)", args={"k": key}).scalar()
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("_key", hidden)
    # most texts have neither a digit nor an @ and are not searched further
    found = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    rows = rows.withColumn("found", F.coalesce(found, F.array().cast("array<string>")))
    rows = rows.withColumn("change", F.when(F.size("found") > 0, changes(F.col("found"), F.col("_key"))))
    gaps = F.split("text", ANY, -1)
    joined = F.concat(gaps[0], F.array_join(F.zip_with("change", F.slice(gaps, 2, F.size("found")),
                                                       lambda c, g: F.concat(c["new"], g)), ""))

    def count(kind: str) -> Column:
        # of what was validated: a card number that fails stays as it is
        return F.coalesce(F.size(F.filter("change", lambda c: (c["kind"] == kind) & (c["new"] != c["old"]))),
                          F.lit(0)).cast("long").alias(f"n_{kind}")

    return rows.select("doc_id", F.when(F.size("found") > 0, joined).otherwise(F.col("text")).alias("text"),
                       *[count(k) for k in PATTERNS])
