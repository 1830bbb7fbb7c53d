"""Text-to-value converters as native column expressions.

Each takes a string Column and returns a typed Column, stays inside code
generation and never raises: text that does not convert gives NULL or the
converter's default. Shapes are tested by pattern before anything is parsed, so
junk costs a match instead of a thrown and caught parse error per row.

Empty text means NULL throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Words the source systems write for "no value".
NULL_WORDS = ("", "NULL", "N/A", "NONE")
TRUE_WORDS = ("TRUE", "1", "YES", "Y")
FALSE_WORDS = ("FALSE", "0", "NO", "N")

# Everything counted as white space at the ends of a text.
BLANKS = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_WHOLE = r"[+-]?[0-9]+"
_NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
_D, _Y = "[0-9]{1,2}", "[0-9]{4}"
_HMS, _HM = f"{_D}:{_D}:{_D}", f"{_D}:{_D}"

# notation -> (shape, parse pattern)
NOTATIONS = {
    "m/d/Y H:M:S": (f"{_D}/{_D}/{_Y}\\s+{_HMS}", "M/d/yyyy H:m:s"),
    "Y-m-d H:M:S": (f"{_Y}-{_D}-{_D}\\s+{_HMS}", "yyyy-M-d H:m:s"),
    "Y-m-dTH:M:S": (f"{_Y}-{_D}-{_D}T{_HMS}", "yyyy-M-d'T'H:m:s"),
    "m/d/Y H:M": (f"{_D}/{_D}/{_Y}\\s+{_HM}", "M/d/yyyy H:m"),
    "Y-m-d H:M": (f"{_Y}-{_D}-{_D}\\s+{_HM}", "yyyy-M-d H:m"),
    "m/d/Y": (f"{_D}/{_D}/{_Y}", "M/d/yyyy"),
    "d/m/Y": (f"{_D}/{_D}/{_Y}", "d/M/yyyy"),
    "Y-m-d": (f"{_Y}-{_D}-{_D}", "yyyy-M-d"),
    "Y/m/d": (f"{_Y}/{_D}/{_D}", "yyyy/M/d"),
    "m-d-Y": (f"{_D}-{_D}-{_Y}", "M-d-yyyy"),
}

# The notations each converter tries, first fit wins.
STAMP_NOTATIONS = ("m/d/Y H:M:S", "Y-m-d H:M:S", "m/d/Y H:M", "Y-m-d H:M")
DATE_NOTATIONS = ("Y-m-d", "m/d/Y", "d/m/Y", "Y/m/d", "m-d-Y")
PERSON_STAMP_NOTATIONS = ("Y-m-d H:M:S", "m/d/Y H:M:S", "m/d/Y", "Y-m-d", "d/m/Y", "Y/m/d", "m-d-Y")
PERSON_DATE_NOTATIONS = ("m/d/Y H:M:S", "m/d/Y", "Y-m-d", "d/m/Y", "Y/m/d", "m-d-Y")
ISO_STAMP_NOTATIONS = ("m/d/Y H:M:S", "Y-m-d H:M:S", "Y-m-dTH:M:S", "m/d/Y", "Y-m-d")


def strip(c: Column) -> Column:
    """Without blanks of any kind at the ends.

    Cutting by a list of characters is slow, so a text that starts and ends in
    plain ASCII is passed on after one look.
    """
    return F.when(c.rlike(r"(?s)\A[!-~](.*[!-~])?\z"), c).otherwise(F.btrim(c, F.lit(BLANKS)))


def _read(c: Column, shape: str, sql_type: str) -> Column:
    """Text of a shape as a value. Casts ignore the usual blanks by themselves; only other text is stripped first."""
    text = strip(c)
    return F.when(c.rlike(f"^[ \\t\\r\\n]*{shape}[ \\t\\r\\n]*$"), c.try_cast(sql_type)).when(
        text.rlike(f"^{shape}$"), text.try_cast(sql_type))


def is_null_word(c: Column, *, any_case: bool = False, words=NULL_WORDS) -> Column:
    text = strip(c)
    return c.isNull() | (F.upper(text) if any_case else text).isin(*words)


def parse_stamp(c: Column, notations) -> Column:
    """First notation that fits, as a timestamp without time zone."""
    tries = []
    for name in notations:
        shape, pattern = NOTATIONS[name]
        text = F.regexp_replace(c, r"\s+", " ") if "\\s" in shape else c
        tries.append(F.when(c.rlike(f"^{shape}$"), F.try_to_timestamp(text, F.lit(pattern))))
    return F.coalesce(*tries).cast("timestamp_ntz")


# --- dates and times -------------------------------------------------------

def stamp(c: Column) -> Column:
    """Four date-time notations, as they stand: no trimming, no date alone."""
    return parse_stamp(c, STAMP_NOTATIONS)


def day(c: Column) -> Column:
    """Five date notations; month first unless the month would be over 12."""
    return parse_stamp(c, DATE_NOTATIONS).cast("date")


def person_stamp(c: Column) -> Column:
    """Seven notations after null words and trimming."""
    return F.when(~is_null_word(c), parse_stamp(strip(c), PERSON_STAMP_NOTATIONS))


def person_day(c: Column) -> Column:
    """Six notations, cut to the date."""
    return F.when(~is_null_word(c), parse_stamp(strip(c), PERSON_DATE_NOTATIONS)).cast("date")


def iso_stamp(c: Column, words=NULL_WORDS) -> Column:
    """Five notations with ISO 'T' and date alone."""
    return F.when(~is_null_word(c, words=words), parse_stamp(strip(c), ISO_STAMP_NOTATIONS))


def trimmed_stamp(c: Column) -> Column:
    """`stamp` after null words and trimming."""
    return F.when(~is_null_word(c), stamp(strip(c)))


def rental_day(c: Column) -> Column:
    return parse_stamp(c, ("Y-m-d",)).cast("date")


def rental_stamp(c: Column, *, minutes: bool = False) -> Column:
    """Year-first date-time; `minutes` also takes it without seconds."""
    return parse_stamp(c, ("Y-m-d H:M:S", "Y-m-d H:M") if minutes else ("Y-m-d H:M:S",))


def slash_text(ts: Column) -> Column:
    """Day-first text of a timestamp, the form some loads pass it in."""
    return F.date_format(ts, "dd/MM/yyyy HH:mm:ss")


def from_slash_text(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("dd/MM/yyyy HH:mm:ss")).cast("timestamp_ntz")


# --- numbers ---------------------------------------------------------------

def number(c: Column) -> Column:
    """A double, or NULL for text that is no number."""
    return _read(c, _NUMBER, "double")


def number_or_zero(c: Column) -> Column:
    return F.coalesce(number(c), F.lit(0.0))


def whole(c: Column) -> Column:
    """An integer, or NULL; "1.0" is not one."""
    return _read(c, _WHOLE, "bigint")


def whole_or(c: Column, default: int | None = 0) -> Column:
    """An integer, also written "1.0"; null words and anything else give the default."""
    value = number(c)
    from_decimal = F.when(c.contains(".") & (value == F.floor(value)), value.try_cast("bigint"))
    return F.when(is_null_word(c), F.lit(default)).otherwise(F.coalesce(whole(c), from_decimal, F.lit(default))).cast("bigint")


def number_or(c: Column, default: float | None = 0.0) -> Column:
    return F.when(is_null_word(c), F.lit(default)).otherwise(F.coalesce(number(c), F.lit(default))).cast("double")


def loaded(c: Column, sql_type: str) -> Column:
    """Number text into a decimal or integer column: halves round away from zero."""
    return _read(c, _NUMBER, "decimal(38,10)").try_cast(sql_type)


# --- flags -----------------------------------------------------------------

def flag(c: Column) -> Column:
    """1, 0 or NULL, one-letter forms included."""
    text = F.upper(strip(c))
    return F.when(text.isin("T", *TRUE_WORDS), 1).when(text.isin("F", *FALSE_WORDS), 0)


def flag_or(c: Column, default: int = 0) -> Column:
    """1 or 0; T and F are not read, unknown words give the default."""
    text = F.upper(strip(c))
    return F.when(text.isin(*TRUE_WORDS), 1).when(text.isin(*FALSE_WORDS), 0).otherwise(default)


def yes_no(c: Column) -> Column:
    return F.when(c == "1", "Yes").otherwise("No")


# --- text ------------------------------------------------------------------

def text(c: Column, length: int | None = None) -> Column:
    """Trimmed, cut to length, empty as NULL."""
    trimmed = strip(c)
    return F.nullif(F.substring(trimmed, 1, length) if length else trimmed, F.lit(""))


def worded_text(c: Column, length: int | None = None) -> Column:
    """`text` with the null words as NULL."""
    return F.when(~is_null_word(c), text(c, length))


def text_or(c: Column, default: str, length: int | None = None) -> Column:
    return F.coalesce(worded_text(c, length), F.lit(default))


# --- payment transactions: null words in any case, no defaults ----------------

def tx_number(c: Column) -> Column:
    """Decimal text as it is, otherwise only an integer."""
    value = F.when(c.contains("."), number(c)).otherwise(whole(c).cast("double"))
    return F.when(~is_null_word(c, any_case=True), value)


def tx_whole(c: Column) -> Column:
    """Integer part of a number."""
    return F.when(~is_null_word(c, any_case=True), number(c).try_cast("bigint"))


def tx_float(c: Column) -> Column:
    return F.when(~is_null_word(c, any_case=True), number(c))


def tx_flag(c: Column, default: int = 0) -> Column:
    """Yes/no words, else the integer part of a number, else the default."""
    word = F.upper(strip(c))
    return (
        F.when(is_null_word(c, any_case=True), F.lit(default))
        .when(word.isin(*TRUE_WORDS), 1)
        .when(word.isin(*FALSE_WORDS), 0)
        .otherwise(F.coalesce(number(c).try_cast("int"), F.lit(default)))
    )


# --- rental system ----------------------------------------------------------

def as_is(c: Column) -> Column:
    """Text passed on unchanged, empty as NULL."""
    return F.nullif(c, F.lit(""))


def boat_number(c: Column) -> Column:
    """Digits of a boat id such as BOAT-123; single inner underscores join digits; 0 when none is left."""
    kept = F.regexp_replace(c, "[^0-9_]", "")
    digits = F.when(kept.rlike("^[0-9]+(_[0-9]+)*$"), F.replace(kept, F.lit("_"), F.lit("")))
    return F.coalesce(digits.try_cast("bigint"), F.lit(0))
