"""Names, identifiers and symbols as column expressions; all stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def local_name(uri: Column) -> Column:
    """What follows the last `/` or `#`."""
    return F.regexp_extract(uri, "([^/#]+)[/#]*$", 1)


def slug(uri: Column) -> Column:
    """The local name with every run of characters other than letters as one `_`, in lower case, with `_` at both ends."""
    return F.concat(F.lit("_"), F.regexp_replace(F.lower(F.regexp_replace(local_name(uri), "[^A-Za-z]+", "_")), "^_+|_+$", ""), F.lit("_"))


def spaced(camel: Column) -> Column:
    """CamelCase as words."""
    return F.trim(F.regexp_replace(camel, "([A-Z])", " $1"))


def digits_of(c: Column) -> Column:
    """The digits of a whole number written with or without a fraction of zeros, else ""."""
    return F.regexp_extract(c, r"^(\d+)(?:\.0+)?$", 1)


def padded(digits: Column, width: int) -> Column:
    """Padded with zeros to a width; longer values, which lpad would cut, are null."""
    return F.when((digits != "") & (F.length(digits) <= width), F.lpad(digits, width, "0"))


def conform_identifiers(triples: DataFrame, widths: Mapping[str, int], opaque: list[str], keyed: Mapping[str, int]) -> DataFrame:
    """One spelling for each identifier; other columns and the number of rows stay.

    widths: predicate -> digits its objects are padded to; opaque: predicates whose objects only lose a fraction of
    zeros; keyed: URI prefix -> digits the number behind it is padded to, in subjects and objects.
    """

    def in_uri(c: Column) -> Column:
        out = c
        for prefix, width in keyed.items():
            number = F.regexp_extract(c, f"^{re.escape(prefix)}" + r"(\d+)(?:\.0+)?$", 1)
            out = F.when(padded(number, width).isNotNull(), F.concat(F.lit(prefix), padded(number, width))).otherwise(out)
        return out

    number = digits_of(F.col("object"))
    obj = F.when(F.col("predicate").isin(opaque) & (number != ""), number).otherwise(in_uri(F.col("object")))
    for predicate, width in widths.items():
        obj = F.when((F.col("predicate") == predicate) & padded(number, width).isNotNull(), padded(number, width)).otherwise(obj)
    return triples.withColumns({"subject": in_uri(F.col("subject")), "object": obj})


#: Fixed format: six characters of root, year, month and day of expiry, C or P, strike in thousandths.
OPTION_SYMBOL = r"^(.{6})(\d{2})(\d{2})(\d{2})([CP])(\d{8})$"


def _field(c: Column, i: int) -> Column:
    found = F.regexp_extract(c, OPTION_SYMBOL, i)
    return F.when(found != "", found)


def option_underlying(c: Column) -> Column:
    return F.trim(_field(c, 1))


def option_expiry(c: Column) -> Column:
    """ISO date; the two-digit year is of this century."""
    return F.concat(F.lit("20"), _field(c, 2), F.lit("-"), _field(c, 3), F.lit("-"), _field(c, 4))


def option_right(c: Column) -> Column:
    return F.when(_field(c, 5) == "C", "CALL").when(_field(c, 5) == "P", "PUT")


def option_strike(c: Column) -> Column:
    return _field(c, 6).try_cast("double") / 1000


def equity_symbol(c: Column) -> Column:
    """The ticker a market symbol is about: an option's underlying, else the symbol itself, trimmed, in upper case."""
    return F.upper(F.coalesce(option_underlying(c), F.trim(c)))


def contract_type(c: Column) -> Column:
    """CALL or PUT for any spelling of either, else the text in upper case."""
    up = F.upper(F.trim(c))
    return F.when(up.isin("C", "CALL"), "CALL").when(up.isin("P", "PUT"), "PUT").otherwise(up)


def state_code(c: Column) -> Column:
    """The last two characters of a trimmed code: state FIPS with or without leading zeros."""
    return F.substring(F.trim(c), -2, 2)


def item_number(uri: Column) -> Column:
    """The number of an item named at a URI's end, `Item_5.02` or `5.02`, else null."""
    found = F.regexp_extract(local_name(uri), r"(\d+\.\d+)$", 1)
    return F.when(found != "", found)


def concept_name(uri: Column, taxonomies: list[str]) -> Column:
    """`taxonomy:Name` for a URI whose local name starts with a known taxonomy and `_`, else `ext:Name`."""
    name = local_name(uri)
    known = F.regexp_extract(name, f"^({'|'.join(map(re.escape, taxonomies))})_(.+)$", 1)
    rest = F.regexp_replace(name, f"^({'|'.join(map(re.escape, taxonomies))})_", "")
    return F.when(known != "", F.concat(known, F.lit(":"), rest)).otherwise(F.concat(F.lit("ext:"), name))


#: First and last major group, division, sector.
SIC_DIVISIONS = [
    (1, 9, "Agriculture, Forestry, Fishing", "NaturalResourcesSector"),
    (10, 14, "Mining", "NaturalResourcesSector"),
    (15, 17, "Construction", "ConstructionTradesSector"),
    (20, 39, "Manufacturing", "ManufacturingSector"),
    (40, 49, "Transportation and Public Utilities", "TransportationSector"),
    (50, 51, "Wholesale Trade", "RetailSector"),
    (52, 59, "Retail Trade", "RetailSector"),
    (60, 67, "Finance, Insurance, Real Estate", "FinancialSector"),
    (70, 89, "Services", "ProfessionalServicesSector"),
    (91, 99, "Public Administration", "GovernmentSector"),
]


def _by_division(code: Column, field: int) -> Column:
    plain = F.trim(code)
    major = F.when(plain.rlike(r"^\d{1,4}$"), F.lpad(plain, 4, "0").substr(1, 2).try_cast("int"))
    out = F.lit(None).cast("string")
    for row in SIC_DIVISIONS:
        out = F.when(major.between(row[0], row[1]), F.lit(row[field])).otherwise(out)
    return out


def sic_division(code: Column) -> Column:
    """Of a one- to four-digit industry code; null in the gaps between divisions."""
    return _by_division(code, 2)


def sic_sector(code: Column) -> Column:
    return _by_division(code, 3)


def full_date(c: Column) -> Column:
    found = F.regexp_extract(c, r"(\d{4}-\d{2}-\d{2})", 1)
    return F.when(found != "", found)
