"""Order-preserving keys: a sortable 64-bit number per column, one binary key for a whole ordering."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LARGEST, _SMALLEST = (1 << 63) - 1, -(1 << 63)
CLIPPED = (_SMALLEST + 1, _LARGEST - 1)           # bounds of a level's numbers; the ends are for nulls


def _double_number(c: Column) -> Column:
    """A double as a whole number of the same order (its bits, which SQL has no function for).

    Exponent and fraction come from exact divisions by powers of two; -0.0 is 0.0, NaN is the greatest.
    """
    a = F.abs(c)
    two = F.lit(2.0)
    about = F.floor(F.log2(a)).cast("double")     # may miss by one
    e = about - (F.pow(two, about) > a).cast("double") + (F.pow(two, about + 1) <= a).cast("double")
    normal = ((e + 1023) * F.lit(float(1 << 52))).cast("long") + ((a / F.pow(two, e) - 1) * F.lit(float(1 << 52))).cast("long")
    tiny = (a * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    bits = (F.when(F.isnan(c), F.lit(0x7FF8 << 48)).when(a == float("inf"), F.lit(0x7FF0 << 48))
            .when(a < F.lit(2.0 ** -1022), tiny).otherwise(normal))
    return F.when(c < 0, -bits).otherwise(bits)


def sortable_number(c: Column, kind: T.DataType | None) -> Column:
    """A number that sorts as the column does; null where it is null. Wide decimals give their whole
    units, so that equal numbers don't mean equal values there; hex digits (no type) their number.
    """
    if kind is None:
        return F.conv(F.rpad(c, 14, "0"), 16, 10).cast("long")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("long")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _double_number(c.cast("double"))
    if isinstance(kind, T.DecimalType):
        if kind.precision <= 18:
            return (c * F.lit(10 ** kind.scale)).cast("long")
        return F.greatest(F.least(F.floor(c).cast("decimal(38,0)"), F.lit(_LARGEST)), F.lit(_SMALLEST)).cast("long")
    raise TypeError(f"no sort key for {kind.simpleString()}")


def _spec(direction: str) -> tuple[bool, bool]:
    """Whether descending, and whether nulls come first (Spark's defaults)."""
    desc = direction.startswith("desc")
    return desc, direction.endswith("nulls_first") or (not desc and direction == "asc")


STRINGS = 4       # numbers taken of a text, of seven bytes each


def level_numbers(df: DataFrame, order: Sequence[tuple[str, str]]) -> list[Column]:
    """Numbers that sort, one after the other, as the ordering does: turned round where descending, nulls
    at their end. Rows that agree in a number agree in its column, unless the number is an end of its
    range (``at_end``); the list ends behind a column (a text, a wide decimal) whose numbers can't tell all
    values apart. Floating-point columns are numbers as they are, others give whole numbers."""
    out: list[Column] = []
    for name, direction in order:
        desc, first = _spec(direction)
        c, kind = F.col(name), df.schema[name].dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            v = c.cast("double")
            v = F.when(F.isnan(v), F.lit(float("-inf"))).otherwise(-v) if desc else v
            out.append(F.when(c.isNull(), F.lit(float("-inf" if first else "nan"))).otherwise(v))
            continue
        weak = isinstance(kind, T.StringType) or (isinstance(kind, T.DecimalType) and kind.precision > 18)
        if isinstance(kind, T.StringType):
            values = [sortable_number(F.expr(f"substring(hex(`{name}`), {14 * i + 1}, 14)"), None) for i in range(STRINGS)]
        else:
            values = [sortable_number(c, kind)]
        for v in values:
            v = F.greatest(F.least(F.bitwise_not(v) if desc else v, F.lit(CLIPPED[1])), F.lit(CLIPPED[0]))
            out.append(F.when(c.isNull(), F.lit(_SMALLEST if first else _LARGEST)).otherwise(v))
        if weak:
            break
    return out


def at_end(number: str, kind: T.DataType) -> Column:
    """Whether a level's number is one that different values may share."""
    c = F.col(number)
    return F.isnan(c) | (F.abs(c) == float("inf")) if isinstance(kind, T.DoubleType) else c.isin(*CLIPPED)


def as_distance(number: str, kind: T.DataType) -> Column:
    """A level's number on a finite scale: whole numbers as they are, others by their logarithm, as a few
    of them may be far out."""
    c = F.col(number).cast("double")
    if not isinstance(kind, T.DoubleType):
        return c
    scaled = F.signum(c) * F.log1p(F.abs(c))
    return F.when(F.isnan(c), F.lit(900.0)).otherwise(F.greatest(F.least(scaled, F.lit(800.0)), F.lit(-800.0)))


def _turned(text: Column, desc: bool) -> Column:
    return F.translate(text, "0123456789ABCDEF", "FEDCBA9876543210") if desc else text


def _number_bytes(v: Column, desc: bool) -> Column:
    """A whole number as bytes of the same order: a byte of sign and length, then its bytes."""
    digits = F.hex(v)
    digits = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    size = (F.length(digits) / 2).cast("int")
    # Longer is larger; negative numbers have 8 bytes of two's complement and come before all others.
    head = F.when(v < 0, F.lit("z" if desc else "A")).otherwise(F.char((F.lit(0x7A) - size) if desc else (F.lit(0x50) + size)))
    return F.concat(head.cast("binary"), F.unhex(_turned(digits, desc)))


def _part(c: Column, kind: T.DataType, direction: str) -> Column:
    desc, first = _spec(direction)
    if isinstance(kind, T.StringType):
        part = F.concat(F.lit("P"), _turned(F.hex(c), desc), F.lit("~" if desc else " ")).cast("binary")
    elif isinstance(kind, T.DecimalType) and kind.precision > 18:
        # Whole units of the smallest place as 39 digits, shifted so that none is negative.
        units = (c * F.lit(10 ** kind.scale).cast("decimal(38,0)")).cast("decimal(38,0)") if kind.scale == 0 else None
        if units is None:
            raise TypeError(f"no packed key for {kind.simpleString()}")
        sign = F.when(c < 0, F.lit("z" if desc else "A")).otherwise(F.lit("Q"))
        whole = F.lpad(F.abs(units).cast("string"), 39, "0")
        nines = F.translate(whole, "0123456789", "9876543210")
        part = F.concat(sign, F.when((c < 0) != F.lit(desc), nines).otherwise(whole)).cast("binary")
    else:
        part = _number_bytes(sortable_number(c, kind), desc)
    return F.coalesce(part, F.lit("!" if first else "~").cast("binary"))


def packed_key(df: DataFrame, order: Sequence[tuple[str, str]]) -> Column:
    """Bytes that sort, one after the other, as the whole ordering does; equal where all its columns are.

    Each column gives a null mark, or sign, length and bytes of its sortable number (bytes and marks
    turned round where descending), so small counts take two bytes. Sorting, range bounds and equality
    then compare one column instead of many.
    """
    return F.concat(*[_part(F.col(c), df.schema[c].dataType, d) for c, d in order])
