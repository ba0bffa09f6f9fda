"""Equal values in different forms keep one pseudonym."""

import datetime as dt
import re

from leadflow.llm import pii


def masked(spark, texts, key="k"):
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return [r.text for r in sorted(pii.op8_query(d, key).collect(), key=lambda r: r.doc_id)]


def read(text):
    if m := re.fullmatch(r"(\d{4})[-/](\d\d)[-/](\d\d)", text):
        return dt.date(*map(int, m.groups()))
    a, b, y = map(int, re.split(r"[/.]", text))
    return dt.date(y, a, b) if b > 12 else dt.date(y, b, a)


def test_a_day_has_one_pseudonym_in_all_its_forms(spark):
    for day in (dt.date(1999, 12, 31), dt.date(1999, 5, 1), dt.date(2020, 2, 29), *(dt.date(1980 + i, 1 + i % 12, 13 + i % 15) for i in range(30))):
        forms = [f"{day:%Y-%m-%d}", f"{day:%Y/%m/%d}", f"{day:%d/%m/%Y}", f"{day:%d.%m.%Y}", f"{day.day}/{day.month}/{day.year}"] + ([f"{day:%m/%d/%Y}", f"{day.month}/{day.day}/{day.year}"] if day.day > 12 else [])
        got = masked(spark, forms)
        assert len({read(t) for t in got}) == 1 and read(got[0]) != day
        assert all(len(a) == len(b) for a, b in zip(forms[:4], got, strict=False))


def test_numbers_keep_their_country_and_link(spark):
    a, b, c, d, e, f = masked(spark, ["+44 20 7946 0958", "+442079460958", "+1 212 555 0101", "+12125550101", "+35312345678", "+353 1 234 5678"])
    flat = lambda x: re.sub(r"\D", "", x)
    assert flat(a) == flat(b) != "442079460958" and a.startswith("+44 ") and b.startswith("+44")
    assert flat(c) == flat(d) and c.startswith("+1 ") and flat(e) == flat(f) and e.startswith("+353")


def test_national_numbers_are_found(spark):
    got = masked(spark, ["call 07700 900123 now", "call 020 7946 0958", "year 1999 2000", "part 12 345"])
    assert re.fullmatch(r"call 0\d{4} \d{6} now", got[0]) and got[0] != "call 07700 900123 now"
    assert re.fullmatch(r"call 0\d{2} \d{4} \d{4}", got[1]) and got[1] != "call 020 7946 0958"
    assert got[2:] == ["year 1999 2000", "part 12 345"]


def test_invalid_dates_stay(spark):
    odd = ["31/02/2020", "2020/13/01", "0/5/1999", "1999-00-10", "30/30/1999"]
    assert masked(spark, odd) == odd
