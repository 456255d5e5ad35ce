"""Column functions: exact rounding, text cleaning, numbers and times as the records' rules take them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Time formats, in the order in which they are tried.
TIME_FORMATS = (
    "M/d/yyyy, H:m:s.SSSSSS",
    "yyyy/M/d H:m:s",
    "yyyy-M-d'T'H:m:s.SSSSSS'Z'",
    "yyyy-M-d'T'H:m:s'Z'",
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d H:m:s,SSSSSS",
    "yyyy-M-d H:m:s",
    "d/MMM/yyyy:H:m:s",
)
#: What a text must look like for a format to be tried: a failed parse costs far more than a look.
LOOKS = (r"^\d+/\d+/\d+, ", r"^\d+/\d+/\d+ ", r"^\d+-.*T.*\.\d+Z$", r"^\d+-.*T[^.]*Z$", r"^\d+-.*T[^Z.]*$", r"^\d+-.* .*,\d+$", r"^\d+-[^,]* [^,]*$", r"^\d+/[A-Za-z]+/")
_DIGITS = r"[0-9](?:_?[0-9])*"
NUMBER = rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?|(?i:inf|infinity|nan))$"


def let(value: Column, body) -> Column:
    """body(value) with value computed once: what uses a value many times stays small in the plan."""
    return F.element_at(F.transform(F.array(value), body), 1)


def exact_round(x: Column, places: int) -> Column:
    """x to a number of decimals, half to even on the exact binary value: the error of the scaled product decides ties."""
    scale = float(10**places)

    def halves(v: Column) -> Column:
        big = v * F.lit(134217729.0)
        return let(big - (big - v), lambda high: F.struct(high.alias("high"), (v - high).alias("low")))

    def scaled(v: Column) -> Column:
        product = v["high"] * scale + v["low"] * scale
        return let(product, lambda p: F.struct(p.alias("p"), ((v["high"] * scale - p) + v["low"] * scale).alias("error"), F.floor(p).cast("double").alias("below")))

    def decided(v: Column) -> Column:
        rest, error = v["p"] - v["below"], v["error"]
        up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (v["below"] % 2 != 0))))
        return (v["below"] + F.when(up, 1.0).otherwise(0.0)) / scale

    return let(let(let(x.cast("double"), halves), scaled), decided)


def rounded_column(name: str, places: int) -> Column:
    """exact_round() of a column that has a name, built as one text: much less to send to the planner."""
    scale, x = f"{10**places}D", f"cast(`{name}` as double)"
    halves = f"element_at(transform(array({x}), v -> struct(v * 134217729D - (v * 134217729D - v) as h, v as v)), 1)"
    scaled = f"element_at(transform(array({halves}), w -> struct(w.h * {scale} + (w.v - w.h) * {scale} as p, w.h as h, w.v as v)), 1)"
    rest = f"(y.p - floor(y.p))"
    error = f"((y.h * {scale} - y.p) + (y.v - y.h) * {scale})"
    up = f"if({rest} > 0.5D or ({rest} = 0.5D and ({error} > 0 or ({error} = 0 and floor(y.p) % 2 <> 0))), 1D, 0D)"
    return F.expr(f"element_at(transform(array({scaled}), y -> (cast(floor(y.p) as double) + {up}) / {scale}), 1)")


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole, 0 where whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(exact_round(part.cast("double") / F.when(whole == 0, 1).otherwise(whole).cast("double") * 100.0, places))


def fixed(x: Column, places: int) -> Column:
    """x as text with so many decimals, of the exactly rounded value."""
    return F.format_string(f"%.{places}f", exact_round(x, places)) if places else exact_round(x, 0).cast("bigint").cast("string")


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def filled(c: Column) -> Column:
    """Null where there is no text."""
    return F.when(c != "", c)


def first_filled(*cols: Column) -> Column:
    return F.coalesce(*[filled(c) for c in cols])


def number(c: Column) -> Column:
    """A double from text in the decimal notation that the records use; null where it is none."""
    t = stripped(c)
    return F.when(t.rlike(NUMBER), F.regexp_replace(t, "_", "").try_cast("double"))


def number_text(x: Column) -> Column:
    """The shortest decimal text of a double: plain from 1e-4 up to 1e16, else with an exponent of two digits or more."""
    return F.when(x.isNotNull(), let(x, _number_text))


def _number_text(x: Column) -> Column:
    java = x.cast("string")
    plain = F.regexp_replace(java.try_cast("decimal(38,18)").cast("string"), r"(\.[0-9]*?[1-9])0+$|(\.0)0+$", "$1$2")
    mantissa, power = F.regexp_replace(F.substring_index(java, "E", 1), r"\.0$", ""), F.substring_index(java, "E", -1).try_cast("int")
    powered = F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    size = F.abs(x)
    return (
        F.when(F.isnan(x), "nan").when(size == float("inf"), F.when(x > 0, "inf").otherwise("-inf"))
        .when(~java.contains("E"), java).when((size >= 1e-4) & (size < 1e16), plain).otherwise(powered)
    )


def parsed_time(c: Column) -> Column:
    """A timestamp from the first time format that fits; null where none does."""
    return F.coalesce(*[F.when(c.rlike(look), F.try_to_timestamp(c, F.lit(f))) for f, look in zip(TIME_FORMATS, LOOKS, strict=True)])
