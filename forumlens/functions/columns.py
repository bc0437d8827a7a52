"""Column expressions shared by the analyses.

Everything here builds a ``pyspark.sql.Column`` from built-in functions, so
it stays inside whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
# "(?d)" lets "." match every character but a line feed, as the reference's
# pattern dialect does; without it U+0085, U+2028 and U+2029 would stop it too.
ENTRY_MARKER = "<row "              # a dump line that holds an entry
VALID_ROW_PATTERN = "(?d)<row.*/>"  # searched anywhere in the line
TAG_PATTERN = "(?d)<(.*?)>"         # one tag inside the Tags attribute
ROW_STARTS = ("<row ", "<row\t", "<row\r")     # a row element's name and XML white space
QUESTION, ANSWER = 1, 2         # PostTypeId codes
UPVOTE, DOWNVOTE = 2, 3         # VoteTypeId codes

# The number texts that the reference's int() and float() take (ASCII digits):
# white space around, a sign, single underscores between digits, infinities and NaN.
PADDING = r"[\s\x1C-\x1F\x85\xA0\p{Z}]*"
DIGITS = "[0-9](?:_?[0-9])*"
WHOLE_PATTERN = f"^{PADDING}[+-]?{DIGITS}{PADDING}$"
NUMBER_PATTERN = (f"(?i)^{PADDING}[+-]?(?:(?:{DIGITS}[.]?(?:{DIGITS})?|[.]{DIGITS})(?:e[+-]?{DIGITS})?"
                  f"|inf(?:inity)?|nan){PADDING}$")

MICROS_PER_HOUR = 3_600_000_000


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_entry(line: Column | str = "value") -> Column:
    """The line contains a row start tag followed by a space."""
    return col_of(line).contains(ENTRY_MARKER)


def is_row_element(line: Column | str = "value") -> Column:
    """A row start tag followed by any white space occurs in the line."""
    return reduce(or_, [col_of(line).contains(s) for s in ROW_STARTS])


def is_valid(line: Column | str = "value") -> Column:
    """A self-closing row element occurs somewhere in the line (regex search)."""
    return col_of(line).rlike(VALID_ROW_PATTERN)


def parse_timestamp(text: Column | str) -> Column:
    """Dump timestamp text -> TIMESTAMP_NTZ; 0 to 6 fraction digits, NULL on garbage."""
    return col_of(text).try_cast("timestamp_ntz")


def _plain(text: Column, pattern: str) -> Column:
    """The text without padding and underscores where it has the pattern, else NULL."""
    found = F.nullif(F.regexp_extract(text, pattern, 0), F.lit(""))
    return F.regexp_replace(found, r"[\s\x1C-\x1F\x85\xA0\p{Z}_]", "")


def parse_whole(text: Column | str) -> Column:
    """Number text -> BIGINT; NULL unless it is a whole number of 64 bits.  The
    pattern is tried only on texts that a plain cast does not take."""
    c = col_of(text)
    return F.coalesce(c.try_cast("bigint"), _plain(c, WHOLE_PATTERN).try_cast("bigint"))


def parse_number(text: Column | str) -> Column:
    """Number text -> DOUBLE for all that ``float`` takes; NULL for the rest (``1.5f``, ``0x1``)."""
    return _plain(col_of(text), NUMBER_PATTERN).try_cast("double")


def format_timestamp(ts: Column | str, digits: int = 6) -> Column:
    """TIMESTAMP_NTZ -> dump text ``yyyy-MM-ddTHH:mm:ss[.f]`` with ``digits``
    fraction digits (6 is lossless).

    Built from the string cast and the seconds field, which do not depend on
    the session time zone (``date_format`` would shift local times that do
    not exist in a daylight-saving zone).
    """
    c = col_of(ts)
    base = F.replace(F.substring(c.cast("string"), 1, 19), F.lit(" "), F.lit("T"))
    if digits == 0:
        return base
    if not 1 <= digits <= 6:
        raise ValueError("digits must be between 0 and 6")
    micros = (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint") % 1_000_000
    frac = F.lpad((micros / F.lit(10 ** (6 - digits))).cast("bigint").cast("string"), digits, "0")
    return F.concat(base, F.lit("."), frac)


def gap(start: Column | str, end: Column | str) -> Column:
    """``end - start`` as an exact day-time interval (wall clock for NTZ)."""
    return col_of(end) - col_of(start)


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Exact signed difference ``end - start`` in microseconds."""
    return (gap(start, end).cast("decimal(38,6)") * 1_000_000).cast("bigint")


def within_hours(start: Column | str, end: Column | str, hours: int) -> Column:
    """``(end - start) < hours`` measured exactly; negative gaps qualify."""
    return gap(start, end) < F.make_dt_interval(hours=F.lit(hours))


def day_window(start: Column | str, end: Column | str, lo_days: int, hi_days: int) -> Column:
    """``lo_days <= floor-days(end - start) < hi_days`` as an exact interval test."""
    g = gap(start, end)
    return (g >= F.make_dt_interval(days=F.lit(lo_days))) & \
        (g < F.make_dt_interval(days=F.lit(hi_days)))


def shift_days(ts: Column | str, days: int) -> Column:
    """``ts`` plus a whole number of 24-hour days (TIMESTAMP_NTZ stays NTZ)."""
    return F.timestamp_add("DAY", F.lit(days), col_of(ts))


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """True division as DOUBLE; NULL instead of an error when dividing by 0."""
    return F.try_divide(col_of(numerator).cast("double"), col_of(denominator).cast("double"))


def indicator(condition: Column) -> Column:
    """1 when the condition holds, else 0 (NULL counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def split_tags(tags_text: Column | str) -> Column:
    """``'<a><b>'`` -> ``['a', 'b']``; NULL stays NULL."""
    return F.regexp_extract_all(col_of(tags_text), F.lit(TAG_PATTERN), F.lit(1))


def render_tags(tags: Column | str) -> Column:
    """``['a', 'b']`` -> ``'<a><b>'`` (inverse of ``split_tags``)."""
    return F.concat(F.lit("<"), F.array_join(col_of(tags), "><"), F.lit(">"))


# XML attribute escaping for rendering rows.  Order matters: '&' first.
XML_ESCAPES = [
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&quot;"),
    ("\n", "&#xA;"),
    ("\r", "&#xD;"),
    ("\t", "&#x9;"),
]


def xml_escape(text: Column | str) -> Column:
    out = col_of(text)
    for raw, escaped in XML_ESCAPES:
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out
