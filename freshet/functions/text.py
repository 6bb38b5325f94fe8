"""Text and identifier expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def site_id(c: Column) -> Column:
    """Station ids as text: blanks and a trailing '.0' removed, zeros on the left up to 8 digits; longer ids stay as they are."""
    s = F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")
    return F.when(F.length(s) >= 8, s).otherwise(F.lpad(s, 8, "0"))


def clean_text(c: Column) -> Column:
    """Null as '', white space collapsed, '_' before white space or the end as ','."""
    t = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.regexp_replace(t, r"_(?=\s|$)", ",")


def title_case(c: Column) -> Column:
    """Every run of letters with a capital first, as in 'Saint-Jean' or \"O'Brien\"."""
    runs = F.regexp_extract_all(c, F.lit("([A-Za-z]+|[^A-Za-z]+)"), 1)
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1_000_000)))), "")


def money(c: Column, blank: float | None = 0.0) -> Column:
    """'10.00K', '2.5m', '1B' to a number; blank is the value of what can't be read: 0 for sums, null to keep it apart, which also reads 'T'."""
    t = F.trim(c)
    number = F.regexp_extract(t, r"^([0-9.]+)\s*[KMBkmb]?$" if blank == 0 else r"^([0-9.]+)\s*[KMBTkmbt]?$", 1).try_cast("double")
    unit = F.upper(F.regexp_extract(t, r"([KMBTkmbt])$", 1))
    factor = F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9).when(unit == "T", 1e12).otherwise(1.0)
    return F.coalesce(number * factor, F.lit(blank).cast("double"))


def zone_hours(c: Column, otherwise: int | None = 0) -> Column:
    """Hours from UTC of a zone text that ends in a signed number, as 'CST-6'."""
    return F.coalesce(F.regexp_extract(c, r"([+-]?\d+)$", 1).try_cast("int"), F.lit(otherwise).cast("int"))


def clean_id(c: Column) -> Column:
    """Trimmed; '', 'nan' and 'None' as null."""
    t = F.trim(c)
    return F.when(~t.isin("", "nan", "None"), t)


def id_kind(c: Column) -> Column:
    """The letters before the first '-' of a prefixed id ('wb-12' to 'wb'), '' without any."""
    return F.regexp_extract(c, "^([a-z]+)-", 1)


# Numbers of the states by their letters.
STATE_NUMBERS = {
    "AL": 1, "AK": 2, "AZ": 4, "AR": 5, "CA": 6, "CO": 8, "CT": 9, "DE": 10, "DC": 11, "FL": 12, "GA": 13, "HI": 15, "ID": 16, "IL": 17, "IN": 18, "IA": 19, "KS": 20,
    "KY": 21, "LA": 22, "ME": 23, "MD": 24, "MA": 25, "MI": 26, "MN": 27, "MS": 28, "MO": 29, "MT": 30, "NE": 31, "NV": 32, "NH": 33, "NJ": 34, "NM": 35, "NY": 36,
    "NC": 37, "ND": 38, "OH": 39, "OK": 40, "OR": 41, "PA": 42, "RI": 44, "SC": 45, "SD": 46, "TN": 47, "TX": 48, "UT": 49, "VT": 50, "VA": 51, "WA": 53, "WV": 54, "WI": 55, "WY": 56,
}


def county_of_ugc(c: Column, state: Column | None = None) -> Column:
    """The five digits of a county, from a code like 'TXC201' and its state's letters (by default those of the code): '48201'; '' for anything else."""
    letters = F.upper(F.trim(state)) if state is not None else F.substring(c, 1, 2)
    number = F.try_element_at(F.create_map(*[F.lit(x) for kv in STATE_NUMBERS.items() for x in kv]), letters)
    return F.when(c.rlike("^..C[0-9]{3}$") & number.isNotNull(), F.concat(F.lpad(number.cast("string"), 2, "0"), F.substring(c, 4, 3))).otherwise("")


def has_word(c: Column, pattern: str) -> Column:
    """Whether the pattern occurs, whatever its case; null counts as no."""
    return F.coalesce(c.rlike("(?i)" + pattern), F.lit(False))
