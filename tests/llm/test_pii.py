"""Pseudonyms: permutations of each format, linked across documents."""

import datetime
import ipaddress
import re

from pyspark.sql import functions as F

from clickflow.llm import pii


def luhn_ok(d):
    s = 0
    for i, c in enumerate(reversed(re.sub("[^0-9]", "", d))):
        x = int(c)
        s += x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return s % 10 == 0


def run(spark, texts, key=pii.KEY):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.pseudonym_report(df, key).orderBy("doc_id").collect()]


def test_digit_permutation_is_a_bijection(spark):
    for n in (1, 2, 3):
        df = spark.range(10 ** n).select(F.lpad(F.col("id").cast("string"), n, "0").alias("d"))
        out = [r[0] for r in df.select(pii.permute_digits(F.col("d"), "k", "t")).collect()]
        assert sorted(out) == [f"{i:0{n}d}" for i in range(10 ** n)]
        assert n == 1 or out != sorted(out)


def test_day_permutation_is_a_bijection(spark):
    df = spark.range(27 * 5411)
    p = pii.permute(F.floor(F.col("id") / 5411), F.col("id") % 5411, 27, 5411, "k", "date")
    assert df.select((p["l"] * 5411 + p["r"]).alias("n")).distinct().count() == 27 * 5411


CARD, PHONE, IP, MAIL = "4337166598464399", "+1 (456) 555-2186", "70.123.182.155", "a.b-1@mail.example.com"
IBAN, SSN, DAY = "GB29 NWBK 6016 1331 9268 19", "078-05-1120", "1999-02-28"


def test_formats_are_kept_and_values_change(spark):
    found = [CARD, "4337 1665 9846 4399", PHONE, "456-555-2186", IP, MAIL, IBAN, SSN, DAY,
             "28.02.1999", "28/02/1999"]
    out = run(spark, [f"x {v}, y" for v in found])
    for v, t in zip(found, out):
        assert t.startswith("x ") and t.endswith(", y") and v not in t
        if "@" not in v and v != IP:
            assert re.sub("[0-9]", "9", t) == re.sub("[0-9]", "9", f"x {v}, y")
    new = [t[2:-3] for t in out]
    assert luhn_ok(new[0]) and luhn_ok(new[1]) and new[0] == new[1].replace(" ", "")
    assert new[0][0] == "4" and new[2].startswith("+1 (")
    assert re.sub("[^0-9]", "", new[2])[1:] == re.sub("[^0-9]", "", new[3])
    assert all(0 <= int(x) <= 255 for x in new[4].split("."))
    assert new[5].endswith("@mail.invalid") and new[6].startswith("GB")
    day = datetime.date.fromisoformat(new[8])
    assert new[9] == day.strftime("%d.%m.%Y") and new[10] == day.strftime("%d/%m/%Y")


def test_equal_values_stay_linked_and_the_key_matters(spark):
    texts = [f"card {CARD} and {MAIL}.", f"{MAIL} paid with {CARD}", MAIL.upper()]
    a, b, c = run(spark, texts)
    new_card, new_mail = re.search("[0-9]{16}", a)[0], re.search(r"\S+@\S+invalid", a)[0]
    assert new_card in b and new_mail in b and c == new_mail
    other = run(spark, texts, "another key")
    assert new_card not in other[0] and new_mail not in other[0]


def test_invalid_values_and_odd_rows_are_left_alone(spark):
    texts = [None, "", "no digits", "1234567812345678", "2023-02-31", "300.1.1.1", "v1.2.3", "12",
             "a@b", "year 1999, 3.14 and 100 000"]
    assert run(spark, texts) == texts
    df = spark.createDataFrame([(None, "é " * 50_000 + CARD, "x", 1), (3, MAIL, "x", 5), (3, MAIL, "x", 5),
                                (4, None, "x", None)],
                               "doc_id long, text string, kinds string, n_chars long")
    out = pii.pseudonymise(df)
    assert out.columns == df.columns and out.schema == df.schema
    rows = out.collect()
    assert len(rows) == 4 and all(r.text is None or len(r.text) == r.n_chars for r in rows)
    assert not any(r.text and (CARD in r.text or MAIL in r.text) for r in rows)
    assert pii.pseudonym_report(df.limit(0)).count() == 0


def test_counts_and_neighbours(spark):
    t = f"{PHONE} {CARD} {IP}\n{MAIL};{SSN}"
    df = spark.createDataFrame([(1, t)], "doc_id long, text string")
    r = pii.pseudonym_report(df).first()
    assert (r.n_found, r.n_phone, r.n_card, r.n_ip, r.n_email, r.n_ssn) == (5, 1, 1, 1, 1, 1)


def shape(t):
    return re.sub("[0-9]", "9", t)


WRITTEN = [
    ("date", "12/25/2024"), ("date", "12.31.1999"), ("date", "3/4/2024"), ("date", "3/25/2024"),
    ("date", "2024-3-4"), ("date", "25.3.2024"),
    ("phone", "+33 6 12 34 56 78"), ("phone", "+81 3 1234 5678"), ("phone", "0033 6 12 34 56 78"),
    ("phone", "+33 (0)6 12 34 56 78"), ("phone", "06 12 34 56 78"), ("phone", "0612345678"),
    ("phone", "0170 1234567"), ("phone", "020 7946 0958"), ("phone", "(030) 1234567"),
    ("phone", "030/1234567"), ("phone", "555 123 4567"), ("phone", "1-456-555-2186"),
    ("ip", "2001:db8::1"), ("ip", "2001:0DB8:0:0:0:0:0:1"), ("ip", "fe80::1:2")]


def test_written_forms(spark):
    df = spark.createDataFrame([(i, f"x {v}, y ({v}).") for i, (_, v) in enumerate(WRITTEN)],
                               "doc_id long, text string")
    for r in pii.pseudonym_report(df).collect():
        kind, value = WRITTEN[r.doc_id]
        assert (r.n_found, r[f"n_{kind}"]) == (2, 2), value
        new = re.fullmatch(r"x (.+), y \(\1\)\.", r.text)[1]
        assert new != value
        if kind == "ip":
            ipaddress.IPv6Address(new)
        elif kind == "phone":
            assert shape(new) == shape(value)
            assert value[0] not in "0+" or new[0] == value[0]
        else:   # again a date of the same order
            sep = re.search("[-/.]", value)[0]
            a, b = [[int(n) for n in t.split(sep)] for t in (value, new)]
            assert [n > 31 for n in a] == [n > 31 for n in b]
            assert a[0] > 31 or (a[1] > 12) == (b[1] > 12)
            assert all(x.lstrip("0") == x for x, y in zip(new.split(sep), value.split(sep))
                       if len(y) == 1)


def test_equal_values_in_new_forms_are_linked(spark):
    days = run(spark, ["12/25/2024", "2024-12-25", "25.12.2024", "3/4/2024", "03/04/2024", "2024-4-3"])
    parts = [[int(n) for n in re.split("[-/.]", t)] for t in days]
    m, d, y = parts[0]
    assert parts[1] == [y, m, d] and parts[2] == [d, m, y]
    assert parts[3] == parts[4] == parts[5][::-1]
    six, seven = run(spark, ["2001:db8::1", "2001:0DB8:0:0:0:0:0:1"])
    assert six == seven
    tel = run(spark, ["+33 6 12 34 56 78", "06 12 34 56 78", "0033 6 12 34 56 78", "0612345678"])
    assert len({re.sub("[^0-9]", "", t)[-9:] for t in tel}) == 1


def test_numbers_and_days_are_permuted_in_their_class(spark):
    df = spark.range(10 ** 3).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    out = df.select("d", pii.permute_number(F.col("d"), "k", "t").alias("n")).collect()
    assert len({r.n for r in out}) == 1000
    assert all(len(r.d.lstrip("0")) == len(r.n.lstrip("0")) and len(r.n) == 3 for r in out)
    day = F.date_add(F.lit(pii.FIRST_DAY).cast("date"), F.col("id").cast("int"))
    days = spark.range(146_097).select(day.alias("d"), pii.permute_day(day, "k").alias("n"))
    bad = (F.dayofmonth("d") <= 12) != (F.dayofmonth("n") <= 12)
    r = days.agg(F.count_distinct("n").alias("n"), F.sum(bad.cast("int")).alias("bad"),
                 F.min("n").cast("string").alias("lo"), F.max("n").cast("string").alias("hi")).first()
    assert tuple(r) == (146_097, 0, "1800-01-01", "2199-12-31")


def test_look_alikes_are_left_alone(spark):
    texts = ["10:20:30", "std::vector a::b", "1:2:3:4:5:6:7:8:9", "1::2::3", "13/13/2024", "0.123 45",
             "2/30/2024", "007 and 0 12", "add::bad", "1/2/3", "v 3.4.20245"]
    assert run(spark, texts) == texts


def iban_ok(t):
    t = t.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in t[4:] + t[:4])) % 97 == 1


def test_checked_numbers_stay_right_and_wrong_ones_apart(spark):
    ibans = [IBAN, "DE89370400440532013000", "FR14 2004 1010 0505 0001 3M02 606",
             "BE68 5390 0754 7034", "NO93 8601 1117 947"]
    out = run(spark, [f"{v} USA" for v in ibans] + ["AB12 CDEF GHIJ KLMN", "GB30 NWBK 6016 1331 9268 19",
                                                    f"BE12 {CARD[:4]} {CARD[4:8]} {CARD[8:12]} {CARD[12:]}",
                                                    "000-12-3456 666-12-3456 123-00-4567 123-45-0000"])
    for v, t in zip(ibans, out):
        new = t.removesuffix(" USA")
        assert new != v and iban_ok(new) and new[:2] == v[:2] and shape(new) == shape(v)
    assert out[5] == "AB12 CDEF GHIJ KLMN" and out[6] == "GB30 NWBK 6016 1331 9268 19"
    assert out[7][:5] == "BE12 " and luhn_ok(out[7][5:]) and CARD not in out[7].replace(" ", "")
    assert out[8] == "000-12-3456 666-12-3456 123-00-4567 123-45-0000"
    cards = run(spark, [" ".join(f"4111 1111 1111 111{i}," for i in range(10))])[0].split(", ")
    assert len({c.strip(",") for c in cards}) == 10 and [luhn_ok(c) for c in cards].count(True) == 1
    assert luhn_ok(cards[1])


def test_social_security_numbers_are_permuted_in_their_class(spark):
    df = spark.range(1, 1000).where("id <> 666").select(
        F.concat(F.lpad(F.col("id").cast("string"), 3, "0"), F.lit("-99-9999")).alias("s"))
    out = df.select("s", pii._ssn(F.col("s"), "k").alias("n")).collect()
    assert len({r.n for r in out}) == 998
    for r in out:
        area, group, serial = r.n.split("-")
        assert (area < "900") == (r.s < "900") and area not in ("000", "666")
        assert [len(area), len(group), len(serial)] == [3, 2, 4]
        assert group != "00" and serial != "0000"
