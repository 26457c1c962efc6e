"""Column expressions for coordinates: positions, intervals, regions and strands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _amount(text: Column) -> Column:
    """A plain decimal number with or without thousands separators, as double; null for anything else."""
    bare = F.trim(F.translate(text, ",", ""))
    return F.when(bare.rlike(r"\A[0-9.]+\z"), bare.try_cast("double"))


def _unit(text: Column) -> tuple[Column, Column]:
    """(what stands before the unit, base pairs in a unit): Mb, bp, or null without a unit."""
    factor = F.when(text.endswith("Mb"), 1_000_000).when(text.endswith("bp"), 1)
    return F.when(factor.isNull(), text).otherwise(F.substring(text, F.lit(1), F.length(text) - 2)), factor


def parse_position(text: Column) -> Column:
    """Base pairs of "14.29 Mb", "12,294,089 bp" or a bare number (below 100,000: Mb); fractions are cut, not rounded."""
    number, factor = _unit(F.trim(text))
    value = _amount(number)
    return (value * F.coalesce(factor, F.when(value < 100_000, 1_000_000).otherwise(1))).cast("long")


def parse_interval(text: Column) -> Column:
    """struct<start, end> of "14.05-14.55 Mb" (hyphen or en dash), "a-b bp" or a cross-arm "3L:17.76-3R:5.85 Mb"; nulls if it has another form."""
    body, factor = _unit(F.trim(text))
    sides = F.split(body, "[-\u2013]")
    crossing = F.size(F.filter(sides, lambda x: F.contains(x, F.lit(":"))))
    sound = (F.size(sides) == 2) & factor.isNotNull() & ((crossing == 0) | ((crossing == 2) & (factor > 1)))
    ends = [(_amount(F.element_at(F.split(F.get(sides, F.lit(k)), ":"), -1)) * factor).cast("long") for k in (0, 1)]
    whole = sound & ends[0].isNotNull() & ends[1].isNotNull()
    return F.struct(*[F.when(whole, x).alias(name) for name, x in zip(("start", "end"), ends, strict=True)])


def parse_location(text: Column) -> Column:
    """struct<chr, start, end, strand> of "2L:100..200(-1)"; null if it has another form."""
    cells = F.split(text, r"[:()]|\.\.")
    cell = lambda k: F.get(cells, F.lit(k))
    start, end, code = cell(1).try_cast("long"), cell(2).try_cast("long"), cell(3).try_cast("int")
    sound = (F.size(cells) == 5) & (cell(0) != "") & (cell(4) == "") & start.isNotNull() & end.isNotNull() & code.isNotNull()
    return F.when(sound, F.struct(cell(0).alias("chr"), start.alias("start"), end.alias("end"), strand(code).alias("strand")))


def strand(code: Column) -> Column:
    return F.when(code == 1, "+").when(code == -1, "-").otherwise("?")


#: What a base-pair number of a region may consist of: digits, a point, an exponent.
_NUMBER_SIGNS = "0123456789.eE+"


def _base_pairs(number: str) -> int | None:
    """A number of base pairs, fractions cut; None if it is none."""
    number = number.strip()
    if not number or number.strip(_NUMBER_SIGNS):
        return None
    try:
        return int(float(number))
    except (ValueError, OverflowError):
        return None


def parse_region(text: str) -> tuple[str, int, int] | None:
    """("2L", 5000000, 6000000) of "2L:5,000,000-6,000,000", "2L:5e6-6e6" or with underscores; None if it has another form."""
    arm, _, span = text.translate({ord(c): None for c in ",_"}).partition(":")
    low, _, high = span.partition("-")
    arm, start, end = arm.strip(), _base_pairs(low), _base_pairs(high)
    return (arm, start, end) if arm.isascii() and arm.isalnum() and start is not None and end is not None else None


def region_column(text: Column) -> Column:
    """``parse_region`` as struct<chr, start, end> for a column of region strings."""
    sides = F.split(F.translate(text, ",_", ""), ":")
    span = F.split(F.get(sides, F.lit(1)), "-")
    arm = F.trim(F.get(sides, F.lit(0)))
    number = lambda k: F.trim(F.get(span, F.lit(k)))
    start, end = (F.when(F.translate(number(k), _NUMBER_SIGNS, "") == "", number(k).try_cast("double").cast("long")) for k in (0, 1))
    sound = (F.size(sides) == 2) & (F.size(span) == 2) & arm.rlike(r"\A[0-9A-Za-z]+\z") & start.isNotNull() & end.isNotNull()
    return F.when(sound, F.struct(arm.alias("chr"), start.alias("start"), end.alias("end")))


def two_places(x: Column) -> Column:
    """``x`` (a double of 1 or more) with two decimals, rounded by its exact binary value, a tie to even, as C and Python do; Java rounds its shortest decimal form."""
    fraction = ((x - F.floor(x)) * 2.0**52).cast("long") * 100  # exact: doubles from 1 on are multiples of 2 ** -52
    hundredths, rest = F.shiftright(fraction, 52), fraction.bitwiseAND(2**52 - 1)
    up = (rest > 2**51) | ((rest == 2**51) & (hundredths % 2 == 1))
    total = F.floor(x) * 100 + hundredths + up.cast("long")
    exact = F.concat(F.floor(total / 100).cast("string"), F.lit("."), F.lpad((total % 100).cast("string"), 2, "0"))
    return F.when(x < 2.0**45, exact).otherwise(F.format_string("%.2f", x))


def format_bp(n: Column) -> Column:
    """"1.23 Mb", or "45,678 bp" below a million; a long dash for null."""
    return F.when(n.isNull(), "\u2014").when(n >= 1_000_000, F.concat(two_places(n.cast("double") / 1_000_000), F.lit(" Mb"))).otherwise(F.concat(F.format_number(n, 0), F.lit(" bp")))


def format_int(n: Column) -> Column:
    """"12,345"; a long dash for null."""
    return F.when(n.isNull(), "\u2014").otherwise(F.format_number(n, 0))
