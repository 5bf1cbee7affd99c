"""Format-preserving pseudonyms for personal data.

Numbers, addresses and dates found in a text are replaced by values
of the same format through a keyed permutation of that format's values: an
alternating Feistel network with modular addition. Equal values get equal
pseudonyms in every document, different values different ones. Everything is
Spark expressions; rows without a match pass untouched.

Forms taken:

* e-mail addresses;
* IBANs of the countries and lengths of ``IBAN_LENGTHS``, together or in groups of
  four, with right check digits; so are the pseudonyms' (national check digits
  inside are not looked at);
* IPv4, and IPv6 in full or with ``::`` (with a decimal digit in it);
* dates with a four-digit year from 1800 to 2199 and ``-``, ``/`` or ``.``: year
  first, day first, or month first if the day is over 12 (12/25/2024); days and
  months of one or two digits. 03/04/2024 is read day first;
* card numbers of 13 to 19 digits with a right Luhn sum; as 4-4-4-4 or 4-6-5 also
  with a wrong one, whose pseudonym is wrong by as much;
* social security and taxpayer numbers (078-05-1120) without impossible parts;
* phone numbers: international with ``+`` or a separated ``00`` code; national
  with a leading zero (06 12 34 56 78, 0170 1234567, (030) 1234567, 030/1234567,
  0612345678); 3-3-4 with blank, dot or hyphen, also (555) 123-4567 and 1-555-...

Not taken: names and postal addresses, dates with two-digit years, month names
or no year, ``00`` codes written together with the number, local numbers without
area code, and other unseparated numbers without a leading zero or ``+``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickflow.llm.sqltext import let

KEY = "pseudonym-key-1"   # default; a deployment passes its own
ROUNDS = 8

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
HEX = "[0-9A-Fa-f]{1,4}"
YEAR, MONTH = "(?:1[89]|2[01])[0-9]{2}", "(?:1[0-2]|0?[1-9])"
DAY = "(?:3[01]|[12][0-9]|0?[1-9])"
# A number after its area code: together, or two to four groups
LOCAL = (r"(?:[0-9]{5,8}(?:-[0-9]{1,4})?|(?=[0-9](?:[ .-]?[0-9]){4})[0-9]{2,4}"
         r"(?:[ .-][0-9]{2,4}){1,3})")
# Countries by the length of their IBANs
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FO FI GL NL SD", 19: "MK SI",
    20: "AT BA EE KZ XK LT LU MN", 21: "HR LV LI CH", 22: "BG BH CR GE DE IE ME RS GB VA",
    23: "TL GI IQ IL OM SO AE", 24: "AD CZ MD PK RO SA SK ES SE TN VG", 25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR",
    27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
# Kinds in order of precedence at the same place. Digits may not touch others.
PATTERNS = {
    "email": r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9])?@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*"
             r"\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})(?:" + "|".join(
        rf"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}"
        + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "")
        for n, c in IBAN_LENGTHS.items()) + ")(?![A-Za-z0-9])",
    "ip": rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])"
          rf"|(?<![0-9A-Za-z_:.])(?=[A-Fa-f:]*[0-9])(?:(?:{HEX}:){{7}}{HEX}"
          rf"|(?:{HEX}(?::{HEX}){{0,6}})?::(?:{HEX}(?::{HEX}){{0,6}})?)(?![0-9A-Za-z_:]|\.[0-9])",
    "date": rf"(?<![0-9/.-])(?:{YEAR}([-/.]){MONTH}\1{DAY}|{DAY}([-/.]){MONTH}\2{YEAR}"
            rf"|{MONTH}([-/.]){DAY}\3{YEAR})(?![0-9/-]|\.[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "ssn": r"(?<![0-9-])(?!000|666)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "phone": "(?:" + "|".join([
        # after a country code; a first group of one digit needs two more groups
        r"(?:(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?|(?<![0-9A-Za-z.,+-])00[1-9][0-9]{0,2}[ .-])"
        r"(?:\([0-9]{1,4}\)[ .-]?)?(?:[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}"
        r"|[0-9](?:[ .-]?[0-9]{2,4}){2,4})",
        r"(?<![0-9A-Za-z])(?:1[ .-])?\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}",
        # national with a leading zero
        r"(?<![0-9A-Za-z.,/+-])0[1-9](?:(?:[ .-]?[0-9]{2}){4}|[0-9]{8,9})(?![0-9A-Za-z])",
        rf"(?<![0-9A-Za-z.,/+-])0[1-9][0-9]{{1,4}}(?: ?/ ?|[ .-]){LOCAL}",
        rf"(?<![0-9A-Za-z])\(0[1-9][0-9]{{1,4}}\) ?{LOCAL}",
        r"(?<![0-9A-Za-z.-])(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}"]) + ")(?![0-9])",
}
KINDS = list(PATTERNS)
# \1 to \3 count groups of the whole expression: the date's are the only ones
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())

# 400 Gregorian years repeat exactly. Days up to the 12th and later ones are
# permuted apart, so a month-first date stays one that cannot be read day first.
MONTHS = 4800
EARLY = (240, 240)    # 12 days in each month
LATE = (9, 9833)      # the others
FIRST_DAY = "1800-01-01"


def _round(key: str, kind: str, no: int, half: Column, modulus: Column | int) -> Column:
    """A keyed number below ``modulus`` from a round and one half."""
    h = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), F.lit(str(no)), half.cast("string")), 256)
    n = F.conv(F.substring(h, 1, 15), 16, 10).cast("long")
    return F.pmod(n, modulus if isinstance(modulus, Column) else F.lit(modulus).cast("long"))


def permute(left: Column, right: Column, a: Column | int, b: Column | int, key: str,
            kind: str) -> Column:
    """A keyed permutation of pairs (left < a, right < b): struct (l, r)."""
    def size(x):
        return x if isinstance(x, Column) else F.lit(x).cast("long")
    state = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    for no in range(ROUNDS):
        def step(s: Column, no: int) -> Column:
            if no % 2 == 0:
                return F.struct(F.pmod(s["l"] + _round(key, kind, no, s["r"], size(a)), size(a))
                                .alias("l"), s["r"].alias("r"))
            return F.struct(s["l"].alias("l"), F.pmod(
                s["r"] + _round(key, kind, no, s["l"], size(b)), size(b)).alias("r"))
        state = let(state, _bind(step, no))
    return state


def _bind(step, no: int):
    return lambda s: step(s, no)


def permute_digits(digits: Column, key: str, kind: str) -> Column:
    """A digit string of the same length, by a permutation of all strings of
    that length (up to 36 digits)."""
    def halves(d: Column) -> Column:
        n = F.length(d)
        k = F.floor((n + 1) / 2).cast("int")
        a, b = F.pow(F.lit(10.0), k).cast("long"), F.pow(F.lit(10.0), n - k).cast("long")
        low = F.coalesce(F.substring(d, k + 1, n - k).try_cast("long"), F.lit(0).cast("long"))
        p = permute(F.substring(d, F.lit(1), k).cast("long"), low, a, b, key, kind)
        return let(p, lambda s: F.concat(
            F.lpad(s["l"].cast("string"), k, F.lit("0")),
            F.when(n > k, F.lpad(s["r"].cast("string"), n - k, F.lit("0"))).otherwise("")))
    return let(digits, halves)


def permute_number(digits: Column, key: str, kind: str) -> Column:
    """Leading zeros stay; the rest is permuted among the numbers of its length
    that have none."""
    def halves(s: Column) -> Column:
        d = s["d"]
        n = F.length(d)
        k = F.floor((n + 1) / 2).cast("int")
        least, b = F.pow(F.lit(10.0), k - 1).cast("long"), F.pow(F.lit(10.0), n - k).cast("long")
        low = F.coalesce(F.substring(d, k + 1, n - k).try_cast("long"), F.lit(0).cast("long"))
        p = permute(F.substring(d, F.lit(1), k).cast("long") - least, low, least * 9, b, key, kind)
        return F.concat(s["z"], F.when(n > 0, let(p, lambda x: F.concat(
            (x["l"] + least).cast("string"),
            F.when(n > k, F.lpad(x["r"].cast("string"), n - k, F.lit("0"))).otherwise(""))))
            .otherwise(""))
    return let(F.struct(F.regexp_extract(digits, "^0*", 0).alias("z"),
                        F.regexp_replace(digits, "^0+", "").alias("d")), halves)


def _only_digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def refill(template: Column, digits: Column) -> Column:
    """``template`` with its digits replaced, in order, by ``digits``."""
    zero = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))

    def add(d: Column):
        def step(a: Column, c: Column) -> Column:
            is_digit = c.between("0", "9")
            return F.struct(
                F.concat(a["out"], F.when(is_digit, F.substring(d, a["at"], F.lit(1)))
                         .otherwise(c)).alias("out"),
                (a["at"] + F.when(is_digit, 1).otherwise(0)).alias("at"))
        return step

    def filled(d: Column) -> Column:
        return F.aggregate(F.split(template, ""), zero, add(d), lambda a: a["out"])

    return let(digits, filled)


def luhn_sum(digits: Column) -> Column:
    """Luhn sum with the last digit as the check digit."""
    n = F.length(digits)

    def add(a: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return a + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    """First digit kept, the others permuted, the check digit made right -- or
    wrong by as much as it was, so mistyped numbers get pseudonyms of their own."""
    def new(d: Column) -> Column:
        n = F.length(d)
        body = F.concat(F.substring(d, 1, 1), permute_digits(
            F.substring(d, F.lit(2), n - 2), key, "card"))
        return let(body, lambda b: F.concat(b, F.pmod(
            luhn_sum(d) - luhn_sum(F.concat(b, F.lit("0"))), F.lit(10))
            .cast("string")))
    return refill(m, new(_only_digits(m)))


def _ip(m: Column, key: str) -> Column:
    def new(o: Column) -> Column:
        left = o[0].cast("long") * 256 + o[1].cast("long")
        right = o[2].cast("long") * 256 + o[3].cast("long")
        p = permute(left, right, 65536, 65536, key, "ip")
        return let(p, lambda s: F.concat_ws(
            ".", F.floor(s["l"] / 256).cast("string"), (s["l"] % 256).cast("string"),
            F.floor(s["r"] / 256).cast("string"), (s["r"] % 256).cast("string")))
    return let(F.split(m, r"\."), new)


def _groups(part: Column) -> Column:
    return F.filter(F.split(part, ":"), lambda g: g != "")


def _is_ip6(m: Column) -> Column:
    """Whether a match has eight groups, or at most seven besides its ``::``."""
    return ~m.contains("::") | (F.size(_groups(m)) <= 7)


def _ip6(m: Column, key: str) -> Column:
    """All 128 bits permuted (equal addresses are linked however written), as
    eight groups in lower case."""
    def digits(part: Column) -> Column:
        return F.array_join(F.transform(_groups(part), lambda g: F.lpad(g, 4, "0")), "")

    def half(h: Column, at: int) -> Column:
        return F.conv(F.substring(h, at, 16), 16, -10).cast("long")

    def mixed(s: Column, no: int) -> Column:
        def f(x: Column) -> Column:
            h = F.sha2(F.concat_ws("|", F.lit(key), F.lit("ip6"), F.lit(str(no)),
                                   x.cast("string")), 256)
            return half(h, 1)
        left, right = s["l"], s["r"]
        return F.struct((left.bitwiseXOR(f(right)) if no % 2 == 0 else left).alias("l"),
                        (right.bitwiseXOR(f(left)) if no % 2 else right).alias("r"))

    def new(h: Column) -> Column:
        state = F.struct(half(h, 1).alias("l"), half(h, 17).alias("r"))
        for no in range(ROUNDS):
            state = let(state, _bind(mixed, no))
        out = let(state, lambda s: F.lower(F.concat(
            F.lpad(F.hex(s["l"]), 16, "0"), F.lpad(F.hex(s["r"]), 16, "0"))))
        return let(out, lambda o: F.concat_ws(":", *[
            F.regexp_replace(F.substring(o, at, 4), "^0{1,3}", "") for at in range(1, 33, 4)]))

    left, right = F.substring_index(m, "::", 1), F.substring_index(m, "::", -1)
    both = F.concat(F.rpad(digits(left), 32 - F.length(digits(right)), F.lit("0")), digits(right))
    return let(F.when(m.contains("::"), both).otherwise(digits(m)), new)


def _day(m: Column) -> Column:
    """The date a match names; NULL for a day that does not exist."""
    p = F.split(m, "[-/.]")
    first = F.length(p[0]) == 4
    swapped = ~first & (p[1].cast("int") > 12)   # month first
    month, day = F.when(swapped, p[0]).otherwise(p[1]), F.when(swapped, p[1]).otherwise(p[0])
    return F.try_to_date(F.concat_ws(
        "-", F.when(first, p[0]).otherwise(p[2]), F.lpad(month, 2, "0"),
        F.lpad(F.when(first, p[2]).otherwise(day), 2, "0")), "yyyy-MM-dd")


def permute_day(day: Column, key: str) -> Column:
    """Another day of 1800 to 2199; up to the 12th, or after it, as ``day`` is."""
    start = F.lit(FIRST_DAY).cast("date")

    def month_start(no: Column) -> Column:
        return F.add_months(start, no.cast("int"))

    def later(no: Column) -> Column:   # days after the 12th in all months before
        return F.datediff(month_start(no), start) - 12 * no

    def new(s: Column) -> Column:
        p = permute(F.floor(s["rank"] / s["b"]), s["rank"] % s["b"], s["a"], s["b"], key, "date")

        def late_day(rank: Column) -> Column:
            # a guess is off by one month at most
            guess = F.floor(rank * MONTHS / (LATE[0] * LATE[1]))
            no = let(guess, lambda g: g - 2 + sum(
                (later(g + k) <= rank).cast("int") for k in (-1, 0, 1, 2)))
            return let(no, lambda n: F.date_add(
                month_start(n), (rank - later(n) + 12).cast("int")))

        return let(let(p, lambda x: x["l"] * s["b"] + x["r"]), lambda rank: F.when(
            s["early"], F.date_add(month_start(F.floor(rank / 12)), (rank % 12).cast("int")))
            .otherwise(late_day(rank)))

    def ranked(d: Column) -> Column:
        no = (F.year(d) - 1800) * 12 + F.month(d) - 1
        early = F.dayofmonth(d) <= 12
        a, b = [F.when(early, x).otherwise(y).cast("long") for x, y in zip(EARLY, LATE)]
        rank = F.when(early, 12 * no + F.dayofmonth(d) - 1).otherwise(
            F.datediff(d, start) - 12 * (no + 1)).cast("long")
        return F.struct(early.alias("early"), a.alias("a"), b.alias("b"), rank.alias("rank"))

    return let(let(day, ranked), new)


def _date(m: Column, key: str) -> Column:
    """Written in the match's order; one-digit places stay without a zero."""
    def text(d: Column) -> Column:
        p, sep = F.split(m, "[-/.]"), F.regexp_extract(m, "[-/.]", 0)

        def two(value: Column, like: Column) -> Column:
            return F.when(F.length(like) == 1, value.cast("string")).otherwise(
                F.lpad(value.cast("string"), 2, F.lit("0")))

        year, month, day = F.year(d).cast("string"), F.month(d), F.dayofmonth(d)
        return F.concat(
            F.when(F.length(p[0]) == 4, year).when(p[1].cast("int") > 12, two(month, p[0]))
            .otherwise(two(day, p[0])), sep,
            F.when((F.length(p[0]) < 4) & (p[1].cast("int") > 12), two(day, p[1]))
            .otherwise(two(month, p[1])), sep,
            F.when(F.length(p[0]) == 4, two(day, p[2])).otherwise(year))

    return let(permute_day(_day(m), key), text)


def _letters(text: Column, key: str, kind: str, n: Column) -> Column:
    """``n`` lower-case letters and digits from a keyed hash of ``text``."""
    h = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), text), 256)
    return F.substring(F.translate(h, "0123456789", "ghijklmnop"), F.lit(1),
                       F.least(F.greatest(n, F.lit(12)), F.lit(64)))


def _email(m: Column, key: str) -> Column:
    """A keyed name (case does not count) at a reserved domain."""
    local = F.length(F.substring_index(m, "@", 1))
    return F.concat(_letters(F.lower(m), key, "email", local), F.lit("@mail.invalid"))


def mod97(text: Column) -> Column:
    """Remainder of the number that letters (A is 10) and digits spell."""
    def add(a: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), a * 10 + F.ascii(c) - 48).otherwise(
            a * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _is_iban(m: Column) -> Column:
    def right(t: Column) -> Column:
        return F.substring(t, 3, 2).between("02", "98") & (mod97(F.concat(
            F.substring(t, F.lit(5), F.length(t)), F.substring(t, 1, 4))) == 1)
    return let(F.replace(m, F.lit(" "), F.lit("")), right)


def _iban(m: Column, key: str) -> Column:
    """Country and letters kept, digits permuted, check digits made right;
    spaces as they were."""
    head, rest = F.substring(m, 1, 2), F.substring(m, F.lit(5), F.length(m))

    def new(r: Column) -> Column:
        body = F.concat(F.replace(r, F.lit(" "), F.lit("")), head, F.lit("00"))
        return F.concat(head, F.lpad((98 - mod97(body)).cast("string"), 2, "0"), r)
    return let(refill(rest, permute_digits(_only_digits(rest), key, "iban")), new)


def _ssn(m: Column, key: str) -> Column:
    """Areas of persons (below 900, without 000 and 666) and of taxpayers (from
    900) apart; no part all zeros."""
    def new(s: Column) -> Column:
        low = s["area"] < 900
        areas = F.when(low, 898).otherwise(100).cast("long")
        left = F.when(low, s["area"] - F.when(s["area"] > 666, 2).otherwise(1)).otherwise(
            s["area"] - 900)
        p = permute(left, (s["group"] - 1) * 9999 + s["serial"] - 1, areas, 99 * 9999, key, "ssn")

        def text(x: Column) -> Column:
            area = F.when(~low, x["l"] + 900).otherwise(
                x["l"] + F.when(x["l"] >= 665, 2).otherwise(1))
            return F.concat_ws("-", *[F.lpad(v.cast("string"), n, F.lit("0")) for v, n in (
                (area, 3), (F.floor(x["r"] / 9999) + 1, 2), (x["r"] % 9999 + 1, 4))])
        return let(p, text)

    p = F.split(m, "-")
    return let(F.struct(*[p[i].cast("long").alias(n) for i, n in enumerate(
        ("area", "group", "serial"))]), new)


def _phone(m: Column, key: str) -> Column:
    """Country code and leading zeros kept, the number permuted."""
    code = F.regexp_extract(m, r"^(?:(?:\+|00)[0-9]{1,3}(?=[ .-]|\()|1(?=[ .-]))", 0)
    rest = F.substring(m, F.length(code) + 1, F.length(m))
    return F.concat(code, refill(rest, permute_number(_only_digits(rest), key, "phone")))


def kind_of(m: Column) -> Column:
    """The kind of a match of ``ANY``, NULL if validation fails."""
    def whole(k: str) -> Column:
        return m.rlike(f"^(?:{PATTERNS[k]})$")
    digits = _only_digits(m)
    return (F.when(m.contains("@"), "email")
            .when(whole("iban"), F.when(_is_iban(m), "iban"))
            .when(whole("ip"), F.when(~m.contains(":") | _is_ip6(m), "ip"))
            .when(whole("date"), F.when(_day(m).isNotNull(), "date"))
            .when(whole("card"), F.when(F.pmod(luhn_sum(digits), F.lit(10)) == 0, "card")
                  .when(m.rlike(r"^[0-9]{4}[ -]"), "card"))
            .when(whole("ssn"), "ssn").when(whole("phone"), "phone"))


def pseudonym(m: Column, kind: Column, key: str = KEY) -> Column:
    return (F.when(kind == "email", _email(m, key)).when(kind == "iban", _iban(m, key))
            .when((kind == "ip") & m.contains(":"), _ip6(m, key))
            .when(kind == "ip", _ip(m, key)).when(kind == "date", _date(m, key))
            .when(kind == "card", _card(m, key)).when(kind == "ssn", _ssn(m, key))
            .when(kind == "phone", _phone(m, key)).otherwise(m))


def _pattern(text: Column) -> Column:
    """``ANY``, where what looks like an IBAN and is none does not hide what
    stands in it (a card after a word of two letters and two digits, say)."""
    wrong = F.filter(F.regexp_extract_all(text, F.lit(PATTERNS["iban"]), F.lit(0)),
                     lambda m: ~_is_iban(m))
    before, after = ANY.split(f"(?:{PATTERNS['iban']})")
    return let(wrong, lambda w: F.when(F.size(w) > 0, F.concat(
        F.lit(before + "(?!(?:"), F.array_join(F.array_distinct(w), "|"),
        F.lit(f")(?![A-Za-z0-9]))(?:{PATTERNS['iban']}){after}"))).otherwise(F.lit(ANY)))


def replace_pii(text: Column, key: str = KEY) -> Column:
    """Struct (text, kinds): the text with pseudonyms in place, and the kind of
    every replaced value in order. NULL stays NULL, with no kinds."""
    none = F.array().cast("array<string>")

    def replaced(found: Column, pattern: Column) -> Column:
        gaps = F.split(text, pattern, -1)
        pairs = F.transform(found, lambda m: let(kind_of(m), lambda k: F.struct(
            k.alias("kind"), pseudonym(m, k, key).alias("new"))))
        return let(F.struct(gaps.alias("gaps"), pairs.alias("pairs")), lambda z: F.struct(
            F.concat(F.array_join(F.transform(z["pairs"], lambda p, i: F.concat(
                z["gaps"][i], p["new"])), ""), F.element_at(z["gaps"], -1)).alias("text"),
            F.filter(F.transform(z["pairs"], lambda p: p["kind"]), lambda k: k.isNotNull())
            .alias("kinds")))

    def by(pattern: Column) -> Column:
        # every kind has a digit or an @
        found = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, pattern, F.lit(0))) \
            .otherwise(none)
        return let(found, lambda m: F.when(F.size(m) > 0, replaced(m, pattern)).otherwise(
            F.struct(text.alias("text"), none.alias("kinds"))))

    return let(_pattern(text), by)


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and, if there, ``n_chars`` of the new
    text; same columns and rows, plus nothing. Repeated rows stay repeated."""
    new = replace_pii(F.col("text"), key)["text"]
    out = docs.withColumn("text", new)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def pseudonym_report(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text (with pseudonyms), n_found and a count per kind."""
    r = docs.select("doc_id", replace_pii(F.col("text"), key).alias("r"))

    def count(kind: str) -> Column:
        return F.size(F.filter(F.col("r")["kinds"], lambda k: k == kind)).cast("long")

    counts = [count(k).alias(f"n_{k}") for k in KINDS]
    return r.select("doc_id", F.col("r")["text"].alias("text"),
                    F.size(F.col("r")["kinds"]).cast("long").alias("n_found"), *counts)
