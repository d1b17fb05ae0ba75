"""Column functions over message text and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The character class of a user name, and patterns built on it.
# Spelled out instead of \w, whose meaning differs between regex engines.
WORD = r"\p{L}\p{N}_"
MENTION = f"@[{WORD}]+"
# Some character that is neither a space nor part of a mention: any other
# symbol, an @ that starts no mention, or the start of a word not behind an @.
BEYOND_MENTIONS = f"[^{WORD}@ ]|@(?![{WORD}])|(?<![{WORD}@])[{WORD}]"

WEEKDAY = r"^(?i)(?:mon|tue|wed|thu|fri|sat|sun)[a-z]* "
ZONE_TOKEN = " [A-Z]{3} "
DATE_FORMAT = "MMM d HH:mm:ss yyyy"
# The usual form of a date, whose parts stand at fixed places.
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
USUAL_DATE = (
    r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun) (?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) "
    r"[0-3][0-9] [0-2][0-9]:[0-5][0-9]:[0-5][0-9] [A-Z]{3} [1-9][0-9]{3}\z"
)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def mentions(text: Column | str) -> Column:
    """All mentions in order, duplicates kept; an array, null for null text."""
    return F.regexp_extract_all(as_column(text), F.lit(MENTION), F.lit(0))


def without_mentions(text: Column | str) -> Column:
    return F.regexp_replace(as_column(text), MENTION, "")


def has_mention(text: Column | str) -> Column:
    """True where ``mentions`` finds something; stops at the first match."""
    return as_column(text).rlike(MENTION)


def has_text_beyond_mentions(text: Column | str) -> Column:
    """Same truth as ``not_blank(without_mentions(text))``, but it stops at the
    first such character, so no cleaned copy is built just to be tested."""
    return as_column(text).rlike(BEYOND_MENTIONS)


def not_blank(text: Column | str) -> Column:
    """Not null and something left after trimming spaces (and only spaces).

    One term on purpose: pushed below the projection that cleans the text, each
    further term (a null check is one) would clean it once more.
    """
    return F.length(F.trim(F.coalesce(as_column(text), F.lit("")))) > 0


def null_or_empty(value: Column | str) -> Column:
    value = as_column(value)
    return value.isNull() | (value == "")


def tweet_timestamp(date: Column | str) -> Column:
    """Parse ``Mon Apr 06 22:19:45 PDT 2009``; null where that is impossible.

    The zone token is dropped and the digits are read in the session zone. A
    weekday has to be there, but the default parser has no pattern for it, so
    it is dropped as well and not checked against the date. Dates of the usual
    form are put in ISO order and cast, which takes a fraction of the time that
    a parser with a pattern does.
    """
    date = as_column(date)
    month = ((F.instr(F.lit(MONTHS), date.substr(5, 3)) + 2) / 3).cast("int").cast("string")
    day = F.concat_ws("-", date.substr(25, 4), F.lpad(month, 2, "0"), date.substr(9, 2))
    usual = F.concat_ws(" ", day, date.substr(12, 8)).try_cast("timestamp")
    digits = F.regexp_replace(F.regexp_replace(date, ZONE_TOKEN, " "), WEEKDAY, "")
    parsed = F.when(date.rlike(WEEKDAY), F.try_to_timestamp(digits, F.lit(DATE_FORMAT)))
    return F.when(date.rlike(USUAL_DATE), usual).otherwise(parsed)
