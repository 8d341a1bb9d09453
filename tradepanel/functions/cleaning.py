"""Column expressions that clean the fields of one export line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import OTHER, REGION_GROUPS, SIZE_BANDS, SMALLEST_SIZE

ACCENTED = "ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇáàâäãåéèêëíìîïóòôöõúùûüñç"
PLAIN = "AAAAAAEEEEIIIIOOOOOUUUUNCaaaaaaeeeeiiiiooooouuuunc"
EXPONENT = r"(?<=[0-9.])[eE][+-]?[0-9]+"
#: A text of so many characters without an exponent is a finite number, if it is one.
SHORT_NUMBER = 300


def named(name: str) -> Column:
    """A column by its exact name; export headers hold blanks, dots and signs."""
    return F.col("`" + name.replace("`", "``") + "`")


def number_or_null(column: Column) -> Column:
    """Text to number, bad text to null."""
    return column.try_cast("double")


def finite(number: Column) -> Column:
    """Null for infinity and for what is not a number."""
    return F.when(F.abs(number) <= F.lit(1.7976931348623157e308), number)


def amount_or_null(df: DataFrame, name: str) -> Column:
    """Text without currency signs and separators, as a number with its sign.

    An exponent after the digits counts, and what follows it does not. A number beyond
    all doubles is none. A column that is a number already is cast, never spelled out
    first. Plain amounts, without an E, pay for one replacement only.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        number = named(name).cast("double")
        return finite(number) if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else number
    text = named(name).cast("string")

    def digits(c):
        return F.regexp_replace(c, r"[^0-9.\-]+", "")

    def scaled(c):
        whole = F.concat(digits(F.regexp_replace(c, EXPONENT + ".*$", "")), F.regexp_extract(c, EXPONENT, 0))
        return finite(whole.try_cast("double"))

    # Within a lambda, so that Spark leaves the projection out of the one method that it
    # generates for a stage. The JVM never compiles one of over 8,000 bytes, which a few
    # amounts exceed; all of the stage then takes several times as long.
    rare = F.contains(text, F.lit("E")) | F.contains(text, F.lit("e")) | (F.length(text) > SHORT_NUMBER)
    return F.when(rare, F.transform(F.array(text), scaled)[0]).otherwise(digits(text).try_cast("double"))


def amount(df: DataFrame, name: str) -> Column:
    """The same, with 0 for missing or unreadable amounts."""
    return F.coalesce(amount_or_null(df, name), F.lit(0.0))


def export_date(year: Column, month: Column, day: Column | None = None) -> Column:
    """The date, null where it does not exist; day 1 if there is no day.

    A month or day of more than two digits does not exist; it is not cut.
    """
    def two(c):
        digits = c.cast("string")
        return F.when(F.length(digits) <= 2, F.lpad(digits, 2, "0"))

    last = F.lit("01") if day is None else two(day)
    return F.try_to_date(F.concat(year.cast("string"), F.lit("-"), two(month), F.lit("-"), last), "yyyy-MM-dd")


def fold_accents(column: Column) -> Column:
    """Letters without their accents; text without any is passed on as it is."""
    plain = F.octet_length(column) == F.length(column)
    return F.when(plain, column).otherwise(F.translate(column, ACCENTED, PLAIN))


def destination_name(column: Column) -> Column:
    """P10: letters and blanks only, accents folded, upper case."""
    return F.trim(F.upper(F.regexp_replace(fold_accents(column), r"[^A-Za-z\s]+", "")))


def label(column: Column) -> Column:
    """Upper case without outer blanks."""
    return F.trim(F.upper(column))


def region_key(column: Column) -> Column:
    """The spelling of a region that the group words are looked up in."""
    return F.regexp_replace(fold_accents(F.upper(column)), "['’`´]", "")


def region_group(key: Column) -> Column:
    """The group of the first word that the region's key holds."""
    group = F.when(F.lit(False), OTHER)
    for word, name in REGION_GROUPS:
        group = group.when(key.contains(word), name)
    return group.otherwise(OTHER)


def ratio_of_positives(numerator: Column, denominator: Column) -> Column:
    """Null unless both are above zero."""
    return F.when((numerator > 0) & (denominator > 0), numerator / denominator)


def banded(column: Column, bands, smallest: str) -> Column:
    """The label of the highest band whose lower bound is reached."""
    label_of = F.when(F.lit(False), smallest)
    for bound, name in bands:
        label_of = label_of.when(column >= F.lit(bound), name)
    return label_of.otherwise(smallest)


def size_band(fob: Column) -> Column:
    """Size of one export line."""
    return banded(fob, SIZE_BANDS, SMALLEST_SIZE)
