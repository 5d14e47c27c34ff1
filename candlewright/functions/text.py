"""String functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode blank; ``trim`` alone takes U+0020 only.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

# The asset symbols looked for in a text, in the order in which they are reported.
ASSETS = ["BTC", "ETH", "BNB", "SOL", "XRP", "ADA", "DOGE", "DOT", "AVAX", "MATIC", "LINK", "UNI", "ATOM", "LTC", "TRX"]

# The languages that are kept, and the least length of a text whose language is told.
LANGUAGES = ["vi", "en"]
LEAST_DETECTABLE = 20

# Fixed value: what a preview shows where there is no text.
NO_TEXT = "[Media/No Text]"

#: A number as a kline may spell it; everything else becomes NULL instead of an error.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def strip(text: Column) -> Column:
    """``text`` without Unicode blanks at both ends; NULL stays NULL."""
    return F.btrim(text, F.lit(BLANKS))


def extract_coins(text: Column, assets: list[str] | None = None) -> Column:
    """The symbols that occur in ``text``, ignoring case and word bounds, in vocabulary order; none for NULL."""
    upper = F.upper(text)
    named = F.array(*(F.when(F.contains(upper, F.lit(a)), a).otherwise("") for a in (assets or ASSETS)))
    return F.array_remove(named, "")  # unlike a filter, it stays within codegen, where the upper case is made once


def to_double(text: Column) -> Column:
    """``text`` as a double, NULL where it is no plain number."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def route_language(text: Column, detected: Column) -> Column:
    """The detected language where it is a supported one and the text is long enough to tell, else NULL."""
    enough = F.length(strip(text)) >= LEAST_DETECTABLE
    return F.when(enough & detected.isin(LANGUAGES), detected)


def strip_at(name: Column) -> Column:
    """``name`` without any leading ``@``."""
    return F.ltrim(name, F.lit("@"))


def safe_name(name: Column) -> Column:
    """``name`` as a file name: no leading ``@``, slashes become underscores."""
    return F.replace(strip_at(name), F.lit("/"), F.lit("_"))


def preview(text: Column, length: int = 60) -> Column:
    """The first ``length`` characters on one line, or a note that there is no text."""
    cut = F.replace(F.substring(text, 1, length), F.lit("\n"), F.lit(" "))
    return F.when(text != "", cut).otherwise(NO_TEXT)


def channel_or_id(username: Column, chat_id: Column) -> Column:
    """The user name, or the chat's id as text where the name is NULL or empty."""
    return F.coalesce(F.nullif(username, F.lit("")), chat_id.cast("string"))
