"""Numbers and dates written in ideographs, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import half_width

# Signs of digits, units and tens, and their worth.
DIGITS = {"〇": 0, "零": 0, "一": 1, "二": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
UNITS = {"十": 10, "百": 100, "千": 1000}
TENS = {"廿": 20, "卄": 20, "卅": 30}
SIGNS = "".join(DIGITS)


def _worth(c: Column, table: dict[str, int]) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))[c].cast("bigint")


def numeral_value(c: Column) -> Column:
    """The value of figures, of ideographs read digit by digit, or of a numeral with units; else null.

    With units the text is folded from the left: a digit waits for its unit, a unit
    without a digit counts once, a zero only holds a place, and two digits in a row are
    no numeral.
    """
    t = half_width(F.trim(c))
    one_by_one = F.translate(t, SIGNS, "".join(map(str, DIGITS.values())))
    start = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(None).cast("bigint").alias("digit"), F.lit(True).alias("ok"))

    def step(acc: Column, ch: Column) -> Column:
        digit, unit = _worth(ch, DIGITS), _worth(ch, UNITS)
        return F.when(
            digit.isNotNull(), F.struct(acc["total"].alias("total"), digit.alias("digit"), (acc["ok"] & (F.coalesce(acc["digit"], F.lit(0)) == 0)).alias("ok"))
        ).otherwise(F.struct((acc["total"] + F.coalesce(acc["digit"], F.lit(1)) * unit).alias("total"), F.lit(None).cast("bigint").alias("digit"), acc["ok"].alias("ok")))

    folded = F.aggregate(F.split(t, ""), start, step, lambda acc: F.when(acc["ok"], acc["total"] + F.coalesce(acc["digit"], F.lit(0))))
    return F.when(one_by_one.rlike("^[0-9]{1,18}$"), one_by_one.cast("bigint")).when(t.rlike(f"^[{SIGNS}{''.join(UNITS)}]+$"), folded)


def written(n: Column) -> Column:
    """A number from 0 to 9,999 with units, as books number their pages: 103 is 一百零三, 12 is 十二."""
    digit = lambda k: F.floor(n / k) % 10
    sign = lambda d: F.substr(F.lit("零一二三四五六七八九"), (d + 1).cast("int"), F.lit(1))
    parts = [F.when(digit(k) > 0, F.concat(sign(digit(k)), F.lit(u))).otherwise("零") for k, u in ((1000, "千"), (100, "百"), (10, "十"))]
    text = F.concat(*parts, F.when(n % 10 > 0, sign(n % 10)).otherwise("零"))
    text = F.regexp_replace(F.regexp_replace(text, "零+", "零"), "^零|零$", "")
    return F.when(n == 0, "零").otherwise(F.regexp_replace(text, "^一十", "十"))


def date_number(c: Column) -> Column:
    """A numeral of a date: digits one by one, tens and units, 廿 and 卅 for twenty and thirty."""
    short = F.when(c.rlike(f"^[{''.join(TENS)}][{SIGNS[2:]}]?$"), _worth(F.left(c, F.lit(1)), TENS) + F.coalesce(_worth(F.substr(c, F.lit(2), F.lit(1)), DIGITS), F.lit(0)))
    plain = c.rlike(f"^([{SIGNS}]+|[{SIGNS[2:]}]?十[{SIGNS[2:]}]?)$") | c.rlike("[百千]")
    return F.coalesce(short, F.when(plain, numeral_value(c)))


_N = f"[{SIGNS}{''.join(UNITS)}{''.join(TENS)}]+"
DATE = f"({_N})年(?:({_N})月(?:({_N})日)?)?"


def split_dates(rows: DataFrame, line: str) -> DataFrame:
    """Adds rest, year, month and day: the text without its first date, and the date (null where it has none).

    A line without a date, or whose month or day cannot be one, keeps its text and has no
    date.  Each numeral is a column of its own step, so that no later one computes it again.
    """
    part = lambda k: F.regexp_extract(line, DATE, k)
    found = rows.withColumn("_date", F.struct(part(0).alias("all"), F.array(part(1), part(2), part(3)).alias("parts"), F.regexp_instr(line, F.lit(DATE)).alias("at")))
    read = found.withColumn("_n", F.transform("_date.parts", lambda x: F.when(x != "", date_number(x))))
    n, of = F.col("_n"), F.col("_date.parts")
    right = lambda k, high: (of[k] == "") | F.coalesce(n[k].between(1, high), F.lit(False))
    judged = read.withColumn("_ok", n[0].isNotNull() & right(1, 12) & right(2, 31))
    ok, at = F.col("_ok"), F.col("_date.at")
    rest = F.trim(F.concat(F.substr(line, F.lit(1), at - 1), F.substr(line, at + F.length("_date.all"))))
    out = judged.withColumn("rest", F.when(ok, rest).otherwise(F.col(line)))
    return out.withColumns({c: F.when(ok, n[k]) for k, c in enumerate(("year", "month", "day"))}).drop("_date", "_n", "_ok")
