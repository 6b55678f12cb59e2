import datetime
import re

import pytest
from pyspark.sql import functions as F

from skyloom.llm import pseudonyms

from .conftest import EDGES

KEY = "k"


def made(spark, maker, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(maker(F.col("v"), KEY)).collect()]


def luhn(text):
    digits = [int(c) for c in reversed(text) if c.isdigit()]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def shape(text):
    return re.sub(r"\d", "9", text)


def with_check(body):
    return next(body + str(c) for c in range(10) if luhn(body + str(c)))


@pytest.mark.parametrize("width", range(1, 5))
def test_permutes_all_strings_of_a_width(spark, width):
    values = [f"{i:0{width}}" for i in range(10**width)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    out = [r[0] for r in df.select(pseudonyms.permuted_digits(F.col("v"), KEY, "x")).collect()]
    assert sorted(out) == values and (width == 1 or out != values)


def test_dates_permute_their_range(spark):
    first = datetime.date(1700, 1, 1)
    days = [(first + datetime.timedelta(i)).isoformat() for i in range(0, 146097, 41)]
    out = made(spark, pseudonyms.date, [*days, "1699-12-31", "2100-01-01", "2023-02-29", "31.12.1999", "12/31/1999", "1999-12-31"])
    real = [datetime.date.fromisoformat(d) for d in out[: len(days)]]
    assert len(set(real)) == len(days) and min(real) >= first and max(real).year <= 2099
    assert out[-6:-3] == [None, None, None]
    day = datetime.date.fromisoformat(out[-1])
    assert out[-3:-1] == [day.strftime("%d.%m.%Y"), day.strftime("%m/%d/%Y")]


def test_cards_stay_cards(spark):
    cards = [with_check(f"{i * 7919:012}") for i in range(300)] + [with_check("4" * n) for n in range(12, 19)]
    grouped = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111"]
    out = made(spark, pseudonyms.card, [*cards, *grouped, "4111111111111112"])
    assert all(luhn(o) and shape(o) == shape(v) for o, v in zip(out, [*cards, *grouped]))
    assert len(set(out[: len(cards)])) == len(cards) and out[-1] is None
    assert len({re.sub(r"\D", "", o) for o in out[-4:-1]}) == 1


def test_numbers_of_people_and_machines(spark):
    values = [f"{a:03}-{g:02}-{s:04}" for a, g, s in [(1, 1, 1), (665, 99, 9999), (667, 5, 7), (899, 99, 9999)]]
    out = made(spark, pseudonyms.ssn, [*values, "000-11-1111", "666-11-1111", "900-11-1111", "123-00-1111", "123-11-0000"])
    assert out[4:] == [None] * 5 and len(set(out[:4])) == 4
    for o in out[:4]:
        area, group, serial = map(int, o.split("-"))
        assert 0 < area < 900 and area != 666 and group > 0 and serial > 0 and re.fullmatch(r"\d{3}-\d{2}-\d{4}", o)
    out = made(spark, pseudonyms.ip, ["0.0.0.0", "255.255.255.255", "1.2.3.4", "256.1.1.1"])
    assert out[3] is None and all(int(p) < 256 for o in out[:3] for p in o.split("."))
    one, two = made(spark, pseudonyms.phone, ["+1 (017) 555-7713", "017-555-7713"])
    assert shape(one) == "+9 (999) 999-9999" and one.startswith("+1 ") and re.sub(r"\D", "", one)[1:] == re.sub(r"\D", "", two)


def test_texts(docs_of):
    card = "4111 1111 1111 1111"
    text = f"Pay {card}, or {card.replace(' ', '')}; not 4111111111111112. Born 2001-02-03 at 10.0.0.1, a.b@x.org!"
    rows = [*EDGES, (20, text), (21, text.replace("Pay ", "")), (22, "no data, v 1.2.3, 12345, 2001-13-01, a@b")]
    docs = docs_of(rows)
    out = pseudonyms.pseudonymised(docs.withColumn("pii", F.lit(1)), KEY)
    assert out.columns == [*docs.columns, "pii"]
    by = {}
    for r in out.collect():
        by.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        if i not in (20, 21):
            assert all(r.text in [u for j, u in rows if j == i] and r.pii == [] for r in by[i])
    one, two = by[20][0], by[21][0]
    assert [p.kind for p in one.pii] == ["card", "card", "date", "ip", "mail"]
    assert one.text.removeprefix("Pay ") == two.text and "4111111111111112" in one.text
    back = one.text
    for p in one.pii:
        assert p.old not in one.text
        back = back.replace(p.new, p.old, 1)
    assert back == text
    assert pseudonyms.pseudonymised(docs_of([]), KEY).count() == 0


def test_no_python_in_the_plan(spark, docs_of):
    plan = pseudonyms.pseudonymised(docs_of(["a"]), KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
