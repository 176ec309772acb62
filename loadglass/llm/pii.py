"""Personal data under format-preserving Feistel pseudonyms.

E-mail addresses, IPv4 addresses, phone numbers, US social security numbers, payment cards
and dates are found, validated, and replaced by pseudonyms of the same format. A value is
read as a list of numbers, each below a limit of its own: the digits of a phone number,
the parts of an address, letters of the alphabet. The list is cut in two halves, and in
each round the numbers of one half are shifted by a keyed hash of the other. Every round
can be undone, so a key permutes the values of a format: equal values stay equal across
all documents, different ones stay different, and without the key nothing leads back.

Check digits are set anew, so the pseudonym of a valid card is a valid card; a date
becomes a date of the same notation in the years 1800 to 2199, one cycle of the calendar.

Dates are year first or last, with ``-``, ``/`` or ``.`` between their parts. With the year
last, ``.`` and ``-`` put the day first. With ``/`` the month is first, where that gives a
date, else the day. So that no two dates share a pseudonym, those that only day first can
read, whose day is above 12, are permuted among themselves: the day among 13 to 28, or kept
above, and the year; the month stays.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- Fixed values: formats ---------------------------------------------------------
EMAIL = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}"
    r"@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
)
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
DATE = (
    r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}"
    r"|[0-9]{4}\.[0-9]{2}\.[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}"
    r"|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}-[0-9]{2}-[0-9]{4})(?![0-9])"
)
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
PHONE = (
    r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|\+[0-9]{1,3}(?:[ .()-]{0,2}[0-9]{2,4}){2,5}(?![0-9])"
    r"|(?<![0-9A-Za-z])(?:\([2-9][0-9]{2}\)|\(?[2-9][0-9]{2}\)?[ .-]{1,2})"
    r"[2-9][0-9]{2}[ .-][0-9]{4}(?![0-9])"
)
CARD = (
    r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])"
)
# Notations of DATE: pattern of the text, and of the date in it.
DATE_NOTATIONS = [
    ("____-__-__", "yyyy-MM-dd"), ("____/__/__", "yyyy/MM/dd"), ("____.__.__", "yyyy.MM.dd"),
    ("__/__/____", "MM/dd/yyyy"), ("__.__.____", "dd.MM.yyyy"), ("__-__-____", "dd-MM-yyyy"),
]
# Read as day first where it is no date with the month first.
DAY_FIRST = ("__/__/____", "dd/MM/yyyy")
# The Gregorian calendar repeats after 400 years of 27 * 5411 days.
CYCLE_START = "1800-01-01"
CYCLE = (27, 5411)
KINDS = ["email", "ip", "date", "ssn", "phone", "card"]
# ------------------------------------------------------------------------------------

PATTERN = "|".join([EMAIL, IPV4, DATE, SSN, PHONE, CARD])
ROUNDS = 8

# Characters are permuted among those of their alphabet; others stay. Area and exchange
# codes of phone numbers begin with 2 to 9, so there 0 and 1 keep to themselves.
DIGITS = "0123456789"
ALPHABETS = [DIGITS, "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]
PHONE_ALPHABETS = ["23456789", "01"]


def _shifted(half: Column, other: Column, key: Column, label: Column, sign: int) -> Column:
    """The numbers of ``half``, each moved by a keyed hash of ``other`` within its size."""
    seen = F.array_join(F.transform(other, lambda x: x["value"].cast("string")), ",")

    def move(x: Column, at: Column) -> Column:
        hashed = F.sha2(F.concat_ws("|", key, label, at, seen), 256)
        step = F.pmod(F.conv(F.substring(hashed, 1, 15), 16, 10).cast("long"), x["size"])
        return F.struct(
            F.pmod(x["value"] + sign * step, x["size"]).cast("int").alias("value"),
            x["size"].alias("size"),
        )

    return F.transform(half, move)


def feistel(numbers: Column, key: Column, kind: Column, undo: bool = False) -> Column:
    """A keyed permutation of lists of (value, size) that keeps all sizes.

    Rounds move the left and the right half in turn; ``undo`` takes them back. A literal as
    the key would be in the query's plan; ``hidden`` gives one that is not.
    """
    middle = F.floor(F.size(numbers) / 2).cast("int")
    halves = F.struct(
        F.slice(numbers, F.lit(1), middle).alias("left"),
        F.slice(numbers, middle + 1, F.size(numbers)).alias("right"),
    )
    order = F.sequence(F.lit(1), F.lit(ROUNDS))

    def turn(done: Column, number: Column) -> Column:
        label = F.concat_ws("|", kind, number)
        left, right, sign = done["left"], done["right"], -1 if undo else 1
        odd = number % 2 == 1
        return F.struct(
            F.when(odd, left).otherwise(_shifted(left, right, key, label, sign)).alias("left"),
            F.when(odd, _shifted(right, left, key, label, sign)).otherwise(right).alias("right"),
        )

    return F.aggregate(
        F.reverse(order) if undo else order,
        halves,
        turn,
        lambda done: F.concat(done["left"], done["right"]),
    )


def _check_digit(digits: Column) -> Column:
    """Luhn's digit after the digits of a text."""
    values = F.transform(
        F.split(F.reverse(F.regexp_replace(digits, "[^0-9]", "")), ""), lambda c: c.cast("int")
    )
    doubled = F.transform(
        values,
        lambda v, at: F.when(at % 2 == 0, F.floor(v * 2 / 10) + (v * 2) % 10).otherwise(v),
    )
    total = F.aggregate(doubled, F.lit(0).cast("long"), lambda n, v: n + v)
    return ((10 - total % 10) % 10).cast("string")


def _date(hit: Column) -> Column:
    """The date of a hit, null if it is none or outside of the cycle."""
    parsed = F.lit(None).cast("date")
    for like, notation in DATE_NOTATIONS:
        day = F.to_date(F.try_to_timestamp(hit, F.lit(notation)))
        parsed = F.when(hit.like(like), day).otherwise(parsed)
    return _in_cycle(parsed)


def _in_cycle(day: Column) -> Column:
    days = F.datediff(day, F.lit(CYCLE_START).cast("date"))
    return F.when((days >= 0) & (days < CYCLE[0] * CYCLE[1]), day)


def _day_first(hit: Column) -> Column:
    """The date of a hit that only day first can read: its day is above 12."""
    like, notation = DAY_FIRST
    day = _in_cycle(F.to_date(F.try_to_timestamp(hit, F.lit(notation))))
    return F.when(hit.like(like) & (F.substr(hit, F.lit(1), F.lit(2)) > "12"), day)


def kind_of(hit: Column) -> Column:
    """The kind of a hit that is valid, else null."""
    octets = F.transform(F.split(hit, r"\."), lambda x: x.cast("int"))
    digits = F.regexp_replace(hit, "[^0-9]", "")
    area, group, serial = (F.split(hit, "-")[n] for n in range(3))
    return (
        F.when(hit.contains("@"), "email")
        .when(
            F.rlike(hit, F.lit(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$")),
            F.when(F.forall(octets, lambda x: x < 256), "ip"),
        )
        .when(
            F.rlike(hit, F.lit(f"^(?:{DATE})$")),
            F.when(_date(hit).isNotNull() | _day_first(hit).isNotNull(), "date"),
        )
        .when(
            F.rlike(hit, F.lit(f"^(?:{SSN})$")),
            F.when(
                (area != "000") & (area != "666") & (area < "900")
                & (group != "00") & (serial != "0000"),
                "ssn",
            ),
        )
        .when(
            F.rlike(hit, F.lit(f"^(?:{CARD})$")),
            F.when(
                _check_digit(F.substr(digits, F.lit(1), F.length(digits) - 1))
                == F.right(digits, F.lit(1)),
                "card",
            ),
        )
        .otherwise("phone")
    )


def _coded(hit: Column, kind: Column) -> Column:
    """The characters of a hit with the alphabets they are permuted in; empty: they stay."""
    stays = (
        F.when(kind == "email", F.length(F.substring_index(hit, "@", 1)))
        .when(kind == "card", F.length(hit) - 1)
        .otherwise(F.length(hit))
    )
    begins = F.when(
        kind == "phone",
        F.length(F.regexp_extract(hit, r"^\+[0-9]{1,3}(?=[ .(-])|^\+[0-9]|^", 0)),
    ).otherwise(0)

    def alphabet(c: Column, at: Column) -> Column:
        def among(names: list[str]) -> Column:
            found = F.lit("")
            for name in names:
                found = F.when(F.lit(name).contains(c), F.lit(name)).otherwise(found)
            return found

        return (
            F.when((at < begins) | (at >= stays), F.lit(""))
            .when(kind == "phone", among(PHONE_ALPHABETS))
            .otherwise(among(ALPHABETS))
        )

    return F.transform(
        F.split(hit, ""), lambda c, at: F.struct(c.alias("char"), alphabet(c, at).alias("alphabet"))
    )


def _numbers(hit: Column, kind: Column, coded: Column) -> Column:
    """What the permutation works on."""

    def number(value: Column, size) -> Column:
        return F.struct(
            value.cast("int").alias("value"),
            (F.lit(size) if isinstance(size, int) else size).cast("int").alias("size"),
        )

    def part(at: int) -> Column:
        return F.split(hit, "-")[at].cast("int")

    def digits(first: int, size: int) -> Column:
        return F.substr(hit, F.lit(first), F.lit(size)).cast("int")

    days = F.datediff(_date(hit), F.lit(CYCLE_START).cast("date"))
    # Days 13 to 28 are in every month and year; those above stay, as does the month, and as
    # the 29th of February is not in each year, so does its year.
    first_year, years = int(CYCLE_START[:4]), 400
    day, month, year = digits(1, 2), digits(4, 2), digits(7, 4) - first_year
    leap = (day == 29) & (month == 2)
    return (
        F.when(
            (kind == "date") & _day_first(hit).isNotNull(),
            F.array(
                number(F.when(day <= 28, day - 13).otherwise(0), F.when(day <= 28, 16).otherwise(1)),
                number(F.when(leap, 0).otherwise(year), F.when(leap, 1).otherwise(years)),
            ),
        )
        .when(kind == "ip", F.transform(F.split(hit, r"\."), lambda x: number(x, 256)))
        .when(
            kind == "date",
            F.array(
                number(F.floor(days / CYCLE[1]), CYCLE[0]), number(days % CYCLE[1], CYCLE[1])
            ),
        )
        .when(
            kind == "ssn",
            F.array(
                # Areas 001 to 899 without 666.
                number(part(0) - F.when(part(0) > 666, 2).otherwise(1), 898),
                number(part(1) - 1, 99),
                number(part(2) - 1, 9999),
            ),
        )
        .otherwise(
            F.transform(
                F.filter(coded, lambda x: x["alphabet"] != ""),
                lambda x: number(
                    F.instr(x["alphabet"], x["char"]) - 1, F.length(x["alphabet"])
                ),
            )
        )
    )


def _rendered(hit: Column, kind: Column, coded: Column, moved: Column) -> Column:
    """The pseudonym, written as the hit was."""
    value = lambda at: moved[at]["value"]
    chars = F.aggregate(
        coded,
        F.struct(F.lit("").alias("text"), F.lit(0).alias("at")),
        lambda done, x: F.when(
            x["alphabet"] == "",
            F.struct(F.concat(done["text"], x["char"]).alias("text"), done["at"].alias("at")),
        ).otherwise(
            F.struct(
                F.concat(
                    done["text"],
                    F.substr(x["alphabet"], F.get(moved, done["at"])["value"] + 1, F.lit(1)),
                ).alias("text"),
                (done["at"] + 1).alias("at"),
            )
        ),
        lambda done: done["text"],
    )
    day = F.date_add(F.lit(CYCLE_START).cast("date"), value(0) * CYCLE[1] + value(1))
    date = F.date_format(day, DATE_NOTATIONS[0][1])
    for like, notation in DATE_NOTATIONS[1:]:
        date = F.when(hit.like(like), F.date_format(day, notation)).otherwise(date)
    later = F.substr(hit, F.lit(1), F.lit(2)).cast("int")
    turned = F.format_string(
        "%02d/%s/%04d",
        F.when(later <= 28, value(0) + 13).otherwise(later),
        F.substr(hit, F.lit(4), F.lit(2)),
        F.when(
            (later == 29) & (F.substr(hit, F.lit(4), F.lit(2)) == "02"),
            F.substr(hit, F.lit(7), F.lit(4)).cast("int"),
        ).otherwise(value(1) + int(CYCLE_START[:4])),
    )
    date = F.when(_day_first(hit).isNotNull(), turned).otherwise(date)
    area = value(0) + F.when(value(0) + 1 >= 666, 2).otherwise(1)
    head = F.substr(chars, F.lit(1), F.length(chars) - 1)
    return (
        F.when(kind == "ip", F.array_join(F.transform(moved, lambda x: x["value"].cast("string")), "."))
        .when(kind == "date", date)
        .when(kind == "ssn", F.format_string("%03d-%02d-%04d", area, value(1) + 1, value(2) + 1))
        .when(kind == "card", F.concat(head, _check_digit(head)))
        .otherwise(chars)
    )


def hidden(spark: SparkSession, key: str) -> Column:
    """The key as a value that plans, their explanations and logs do not show: whoever has it
    can undo every pseudonym."""
    return spark.createDataFrame([(key,)], "key string").scalar()


def pseudonymise(documents: DataFrame, key: str) -> DataFrame:
    """Per row of ``documents`` (doc_id, text): doc_id, ``text`` with pseudonyms, and
    ``found``: of each value its kind and its pseudonym, in order.

    What looks like a format but is not valid stays, as does all other text. Null texts
    stay null and empty ones empty; both have nothing found. Very long texts are read whole.
    Equal rows, like equal values, have equal results. Only doc_id and text are read, so other
    columns may have any name. No rows give no rows.
    """
    def each(column: str, name: str, value) -> Column:
        """The structs of an array with one field more."""
        return F.transform(column, lambda x: x.withField(name, value(x)))

    # A column, as functions of arrays cannot have a subquery.
    secret = F.col("__key")
    holds = F.rlike("text", F.lit(PATTERN))
    rows = documents.select(
        "doc_id", "text", hidden(documents.sparkSession, key).alias("__key")
    ).withColumn(
        "hits",
        F.when(
            holds,
            F.transform(
                F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)),
                lambda x: F.struct(x.alias("hit")),
            ),
        ),
    )
    rows = rows.withColumn("hits", each("hits", "kind", lambda x: kind_of(x["hit"])))
    rows = rows.withColumn("hits", each("hits", "coded", lambda x: _coded(x["hit"], x["kind"])))
    rows = rows.withColumn(
        "hits", each("hits", "moved", lambda x: _numbers(x["hit"], x["kind"], x["coded"]))
    )
    rows = rows.withColumn("hits", each("hits", "moved", lambda x: feistel(x["moved"], secret, x["kind"])))
    rows = rows.withColumn(
        "hits",
        F.transform(
            "hits",
            lambda x: F.struct(
                x["kind"].alias("kind"),
                F.when(x["kind"].isNull(), x["hit"])
                .otherwise(_rendered(x["hit"], x["kind"], x["coded"], x["moved"]))
                .alias("pseudonym"),
            ),
        ),
    )
    between = F.split("text", PATTERN, -1)
    text = F.array_join(
        F.flatten(
            F.transform(
                F.arrays_zip(between.alias("gap"), F.col("hits.pseudonym").alias("new")),
                lambda x: F.array(x["gap"], F.coalesce(x["new"], F.lit(""))),
            )
        ),
        "",
    )
    none = F.expr("cast(array() as array<struct<kind: string, pseudonym: string>>)")
    return rows.select(
        "doc_id",
        F.when(F.col("hits").isNull(), F.col("text")).otherwise(text).alias("text"),
        F.coalesce(F.filter("hits", lambda x: x["kind"].isNotNull()), none).alias("found"),
    )
