"""Format-preserving pseudonyms for personal data, in built-in functions only.

Numbers and dates that pass their kind's validation go through a keyed Feistel permutation of
the values of their format: a card stays a valid card of its length and grouping, a date a real
date written the same way. Equal values get equal pseudonyms in every document, different ones
never collide, and whoever holds the key can undo them. Mail addresses, which have no finite
format, get a keyed name at their domain. What fails validation is left alone.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import query, table, unused

ROUNDS = 10
# 1700-01-01 to 2099-12-31: a whole Gregorian cycle of 146097 = 27 * 5411 days.
FIRST_DAY, DAY_SPLIT = "1700-01-01", (27, 5411)

#: How each kind is written.
KINDS = {
    "mail": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9](?:[A-Za-z0-9-]*\.)+[A-Za-z]{2,}+",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "phone": r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)",
    "date": r"(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w-])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<!\w)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7})(?!\w)",
}
ANY = "|".join(KINDS.values())


def hashed(*parts: Column) -> Column:
    """60 bits of a keyed hash as a number."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", *parts), 256), 1, 15), 16, 10).cast("bigint")


def permuted(left: Column, right: Column, size: tuple, key: str, tweak: Column) -> Column:
    """Feistel permutation of the pairs (left, right) below ``size``, as struct (l, r)."""
    many = [s if isinstance(s, Column) else F.lit(s) for s in size]

    def turn(s, r):
        l = (s["l"] + hashed(F.lit(key), tweak, r.cast("string"), s["r"].cast("string")) % many[0]) % many[0]
        m = (s["r"] + hashed(F.lit(key), tweak, r.cast("string"), s["l"].cast("string")) % many[1]) % many[1]
        even = r % 2 == 0
        return F.struct(F.when(even, l).otherwise(s["l"]).alias("l"), F.when(even, s["r"]).otherwise(m).alias("r"))

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def padded(number: Column, width: Column) -> Column:
    """Decimal digits with leading zeros; nothing at width 0."""
    text = F.concat(F.repeat(F.lit("0"), width), number.cast("string"))
    return F.when(width > 0, F.right(text, width)).otherwise("")


def permuted_digits(digits: Column, key: str, kind: str) -> Column:
    """Another string of as many digits (18 at most)."""
    width = F.length(digits)
    half = F.floor(width / 2).cast("int")
    rest = width - half
    left = F.coalesce(F.left(digits, half).try_cast("bigint"), F.lit(0))
    ten = [F.pow(F.lit(10), n).cast("bigint") for n in (half, rest)]
    out = permuted(left, F.right(digits, rest), tuple(ten), key, F.concat(F.lit(kind), width.cast("string")))
    return F.concat(padded(out["l"], half), padded(out["r"], rest))


def written(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced in order."""

    def put(s, c):
        digit = c.rlike("[0-9]")
        letter = F.when(digit, F.substring(s["digits"], s["at"], F.lit(1))).otherwise(c)
        return F.struct(
            F.concat(s["out"], letter).alias("out"),
            (s["at"] + digit.cast("int")).alias("at"),
            s["digits"].alias("digits"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"), digits.alias("digits"))
    return F.aggregate(F.split(shape, ""), start, put, lambda s: s["out"])


def luhn_sum(digits: Column, doubled_first: bool) -> Column:
    """Luhn sum from the right; ``doubled_first`` for digits still without their check digit."""

    def worth(c, i):
        d = c.cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return F.when(i % 2 == (0 if doubled_first else 1), twice).otherwise(d)

    each = F.transform(F.split(F.reverse(digits), ""), worth)
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def card(value: Column, key: str) -> Column:
    digits = digits_of(value)
    body = permuted_digits(F.left(digits, F.length(digits) - 1), key, "card")
    check = (10 - luhn_sum(body, True) % 10) % 10
    return F.when(luhn_sum(digits, False) % 10 == 0, written(value, F.concat(body, check.cast("string"))))


def phone(value: Column, key: str) -> Column:
    """The country code stays; the ten digits after it are permuted."""
    digits = digits_of(value)
    code = F.left(digits, F.length(digits) - 10)
    return written(value, F.concat(code, permuted_digits(F.right(digits, F.lit(10)), key, "phone")))


def ip(value: Column, key: str) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("bigint"))
    out = permuted(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], (65536, 65536), key, F.lit("ip"))
    split = [F.floor(out["l"] / 256), out["l"] % 256, F.floor(out["r"] / 256), out["r"] % 256]
    return F.when(F.forall(parts, lambda p: p < 256), F.concat_ws(".", *[p.cast("string") for p in split]))


def ssn(value: Column, key: str) -> Column:
    """Areas 001-665 and 667-899, groups from 01, serials from 0001."""
    area, group, serial = (F.split(value, "-")[i].cast("bigint") for i in range(3))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    rank = area - F.when(area > 666, 2).otherwise(1)
    out = permuted(rank, (group - 1) * 9999 + serial - 1, (898, 99 * 9999), key, F.lit("ssn"))
    new = out["l"] + F.when(out["l"] >= 665, 2).otherwise(1)
    parts = [(new, 3), (F.floor(out["r"] / 9999) + 1, 2), (out["r"] % 9999 + 1, 4)]
    return F.when(valid, F.concat_ws("-", *[padded(p, F.lit(n)) for p, n in parts]))


def date(value: Column, key: str) -> Column:
    """Years first with hyphens, days first with dots, months first with slashes."""
    dots, slashes = value.contains("."), value.contains("/")

    def read(form):
        return F.try_to_timestamp(value, F.lit(form)).cast("date")

    day = F.when(dots, read("dd.MM.yyyy")).when(slashes, read("MM/dd/yyyy")).otherwise(read("yyyy-MM-dd"))
    number = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("bigint")
    many, each = DAY_SPLIT
    out = permuted(F.floor(number / each), number % each, DAY_SPLIT, key, F.lit("date"))
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), (out["l"] * each + out["r"]).cast("int"))
    text = F.when(dots, F.date_format(new, "dd.MM.yyyy")).when(slashes, F.date_format(new, "MM/dd/yyyy"))
    text = text.otherwise(F.date_format(new, "yyyy-MM-dd"))
    return F.when((number >= 0) & (number < many * each), text)


def mail(value: Column, key: str) -> Column:
    """The name is replaced by a keyed one, whatever its case; the domain stays."""
    name = F.left(F.sha2(F.concat_ws(":", F.lit(key), F.lit("mail"), F.lower(value)), 256), F.lit(16))
    return F.concat(F.lit("u"), name, F.lit("@"), F.substring_index(value, "@", -1))


MAKERS = {"mail": mail, "ip": ip, "phone": phone, "date": date, "ssn": ssn, "card": card}


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` (text, others) with the personal data of ``text`` replaced, and ``pii``, an array
    of (kind, old, new) in text order; a column of that name in the input is replaced. Null and
    empty texts stay as they are with an empty array."""
    text = F.coalesce("text", F.lit(""))

    def replaced(value: Column) -> Column:
        kind = new = None
        for name, pattern in KINDS.items():
            # A kind is known by its whole match: looks at the surroundings hold at both ends.
            of = value.rlike(f"^(?:{pattern})$")
            kind = F.when(of, name) if kind is None else kind.when(of, name)
            new = F.when(of, MAKERS[name](value, key)) if new is None else new.when(of, MAKERS[name](value, key))
        return F.struct(kind.alias("kind"), value.alias("old"), F.coalesce(new, value).alias("new"), new.isNotNull().alias("valid"))

    found = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), replaced)
    own = unused(docs, "_found")
    out = docs.drop("pii").withColumn(own, found)
    pieces = F.zip_with(F.split(text, ANY, -1), own, lambda gap, f: F.concat(gap, F.coalesce(f["new"], F.lit(""))))
    valid = F.filter(own, lambda f: f["valid"])
    new_text = F.when(F.size(valid) > 0, F.array_join(pieces, "")).otherwise(F.col("text"))
    pii = F.transform(valid, lambda f: F.struct(f["kind"].alias("kind"), f["old"].alias("old"), f["new"].alias("new")))
    columns = [new_text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c != "pii"]
    return out.select(*columns, pii.alias("pii"))


@query
def op2_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data under pseudonyms, and how many of each kind."""
    found = pseudonymised(table(spark, sf_dir, "documents"), key="skyloom")
    return found.select("doc_id", *[of_kind(k).alias(f"n_{k}") for k in KINDS], "text")


def of_kind(kind: str) -> Column:
    return F.size(F.filter("pii", lambda p: p["kind"] == kind)).cast("long")
