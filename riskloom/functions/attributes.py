"""Age, SSN and occupation rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.functions.cleaning import _col, first_match, null_outside

# Fixed values of the customer attribute rules.
LEADING_DIGITS = r"^(\d+)"
AGE_RANGE = (18, 80)
NINE_DIGITS = r"^\d{9}$"
SSN_SPECIAL_CHARS = r"[#F%$D@&]"
ONLY_UNDERSCORES = r"^[_]+$"
BLANK_OCCUPATIONS = ["", "_______"]
AGE_BANDS = [(25, "Young"), (35, "Young_Adult"), (50, "Middle_Aged"), (65, "Senior")]
OLDEST_BAND = "Elderly"
OCCUPATION_RISK = {
    3: ["Entrepreneur", "Writer", "Musician"],
    2: ["Developer", "Media_Manager", "Mechanic", "Manager", "Journalist"],
    1: ["Lawyer", "Architect", "Engineer", "Accountant", "Scientist", "Teacher", "Doctor"],
}
DEFAULT_RISK = 2


def parse_age(c: Column | str) -> Column:
    """Leading digits only: text that begins with a sign or a space is no age."""
    return first_match(c, LEADING_DIGITS, "int")


def clean_age(c: Column | str) -> Column:
    return null_outside(parse_age(c), *AGE_RANGE)


def ssn_digits(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit("-"), F.lit(""))


def clean_ssn(c: Column | str) -> Column:
    digits = ssn_digits(c)
    return F.when(digits.rlike(NINE_DIGITS), digits)


def has_special_chars(c: Column | str) -> Column:
    """Audit flag; it does not decide whether the SSN is kept."""
    return F.coalesce(_col(c).rlike(SSN_SPECIAL_CHARS), F.lit(False))


def clean_occupation(c: Column | str) -> Column:
    c = _col(c)
    trimmed = F.trim(c)
    return F.when(~trimmed.isin(*BLANK_OCCUPATIONS) & ~c.rlike(ONLY_UNDERSCORES), trimmed)


def age_group(c: Column | str) -> Column:
    """Band by exclusive upper bound. An unknown age falls into the oldest band."""
    c = _col(c)
    bands = F
    for upper, name in AGE_BANDS:
        bands = bands.when(c < upper, F.lit(name))
    return bands.otherwise(F.lit(OLDEST_BAND))


def occupation_risk(c: Column | str) -> Column:
    """Only the scores that differ from the default need a branch."""
    c = _col(c)
    scores = F
    for score, occupations in OCCUPATION_RISK.items():
        if score != DEFAULT_RISK:
            scores = scores.when(c.isin(*occupations), F.lit(score))
    return scores.otherwise(F.lit(DEFAULT_RISK))
