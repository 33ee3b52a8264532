"""Classification of single string values for type inference.

The patterns use only syntax that Java regular expressions and RE2 share.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellumark.functions.values import stripped

# Strings a CSV reader takes as missing.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

INTEGER = r"[+-]?[0-9](?:_?[0-9])*"
NUMBER = (
    r"[+-]?(?:(?:[0-9](?:_?[0-9])*)?\.[0-9](?:_?[0-9])*|[0-9](?:_?[0-9])*\.?)(?:[eE][+-]?[0-9](?:_?[0-9])*)?"
)
NOT_FINITE = r"[+-]?(?:[iI][nN][fF](?:[iI][nN][iI][tT][yY])?|[nN][aA][nN])"

_SEP = "[-/]"
_DAY31, _DAY30, _DAY29 = "(?:0?[1-9]|[12][0-9]|3[01])", "(?:0?[1-9]|[12][0-9]|30)", "(?:0?[1-9]|[12][0-9])"
_M31, _M30, _M29 = "(?:0?[13578]|1[02])", "(?:0?[469]|11)", "0?2"
_MONTH_DAY = f"(?:{_M31}{_SEP}{_DAY31}|{_M30}{_SEP}{_DAY30}|{_M29}{_SEP}{_DAY29})"
_DAY_MONTH = f"(?:{_DAY31}{_SEP}{_M31}|{_DAY30}{_SEP}{_M30}|{_DAY29}{_SEP}{_M29})"
_MONTH = "(?:0?[1-9]|1[0-2])"
_NAME = (
    "(?i:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?"
    "|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_WEEKDAY = "(?i:mon|tue|wed|thu|fri|sat|sun)"
_CLOCK = "(?:(?:[01]?[0-9]|2[0-3]):[0-5][0-9](?::[0-5][0-9](?:[.][0-9]+)?)?)"
_CLOCK12 = "(?:(?:0?[1-9]|1[0-2]):[0-5][0-9](?::[0-5][0-9](?:[.][0-9]+)?)? ?[aApP][mM])"
_ZONE = "(?: ?(?:Z|[+-][0-9]{2}(?::?[0-9]{2})?))?"
_TIME = f"(?:{_CLOCK12}|{_CLOCK}{_ZONE}|(?:[01][0-9]|2[0-3]))"
_DAY = (
    f"(?:[0-9]{{4}}{_SEP}{_MONTH_DAY}"
    f"|(?:{_MONTH_DAY}|{_DAY_MONTH}){_SEP}(?:[0-9]{{4}}|[0-9]{{1,2}})"
    f"|[0-9]{{2}}{_SEP}{_MONTH_DAY}"
    f"|{_DAY31}{_SEP}{_NAME}{_SEP}(?:[0-9]{{4}}|[0-9]{{2}})"
    f"|{_NAME}{_SEP}{_DAY31}{_SEP}(?:[0-9]{{4}}|[0-9]{{2}}))"
)
_SPOKEN = f"(?:(?:{_WEEKDAY}, )?{_DAY31} {_NAME} [0-9]{{4}}|{_NAME} {_DAY31},? [0-9]{{4}})"
# A date as a free-form date parser accepts it: a closed list of layouts. A
# 29 February is accepted in any year.
DATE = (
    f"(?:{_DAY}(?:[T ]{_TIME})?"
    f"|[0-9]{{4}}{_SEP}{_MONTH}|{_MONTH}{_SEP}[0-9]{{4}}|{_NAME}{_SEP}[0-9]{{4}}"
    f"|{_SPOKEN} {_TIME}|{_CLOCK12}|{_CLOCK})"
)

ISO_STAMP = r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:Z|[+-][0-9]{2}:[0-9]{2})?"
ISO_DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
PLAIN_NUMBER = r"[+-]?[0-9]+(?:\.[0-9]+)?"

XSD_STAMP = r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}[+-][0-9]{2}:[0-9]{2}"
XSD_LONG = r"[0-9]+"
XSD_DECIMAL = r"[0-9]+\.[0-9]+"

# Strongest first: one value of a class decides for the whole column.
JSON_CLASSES = ("date-time", "date", "number", "string")
XSD_CLASSES = ("xs:dateTime", "xs:date", "xs:long", "xs:decimal", "xs:string")


def _full(value: Column, pattern: str) -> Column:
    return value.rlike(f"^(?:{pattern})$")


# Classes of a value for the relational types. A value with a point that is no
# number (an e-mail address, a version) is a float unless types are strict.
ABSENT, DATED, WHOLE, FRACTION, POINTED, TEXT = range(6)


def _begins(text: Column, signs: str) -> Column:
    """Does the text begin with a digit or one of the ASCII `signs`? Cheaper than any pattern."""
    first = F.ascii(text)
    return first.between(48, 57) | first.isin(*map(ord, signs))


def relational_class(value: Column, text: Column | None = None) -> Column:
    """ABSENT, DATED, WHOLE, FRACTION, POINTED or TEXT, whatever the strictness.

    `text` is the stripped value, if it is a column already: the classes ask for it often, and each time it is stripped anew.
    """
    text = stripped(value) if text is None else text
    has_point = F.contains(value, F.lit("."))
    number = F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
    not_finite = _begins(text, "+-iInN") & _full(text, NOT_FINITE)
    parses = (_begins(text, "+-.") & _full(text, NUMBER)) | not_finite
    fraction = not_finite | F.isnan(number) | (F.abs(number) == float("inf")) | (F.rint(number) != number)
    marked = F.contains(value, F.lit("-")) | F.contains(value, F.lit("/")) | F.contains(value, F.lit(":"))
    last = F.ascii(F.substring(text, -1, 1))  # of a date, in any layout: a digit, the Z of a zone, the M of a half of the day
    dated = marked & (last.between(48, 57) | last.isin(*map(ord, "ZMm"))) & _full(text, DATE)
    # Whole numbers need no more tests than the first; beyond 300 digits one
    # may leave the range of floating point and then counts as a float.
    whole = _begins(text, "+-") & _full(text, INTEGER)
    return (
        F.when(value.isNull() | value.isin(*MISSING), ABSENT)
        .when(dated, DATED)
        .when(whole & (F.length(text) <= 300), WHOLE)
        .when(parses & (has_point | fraction), FRACTION)
        .when(has_point, POINTED)
        .when(whole, WHOLE)
        .otherwise(TEXT)
    )


def relational_kind(value: Column, strict: bool = False) -> Column:
    """date / float / int / string for one value, null for a missing one.

    Without `strict` any value with a point counts as a float, e-mail
    addresses included; with it the value must also parse as a number.
    """
    names = F.array(*[F.lit(k) for k in (None, "date", "int", "float", "string" if strict else "float", "string")])
    return F.get(names, relational_class(value))


def json_kind(value: Column, text: Column | None = None) -> Column:
    """Position in JSON_CLASSES, null for a blank value; `text` as in `relational_class`."""
    text = stripped(value) if text is None else text
    return (
        F.when(text.isNull() | (text == ""), F.lit(None))
        .when(~_begins(text, "+-"), 3)
        .when((F.octet_length(text) >= 19) & _full(text, ISO_STAMP), 0)
        .when((F.octet_length(text) == 10) & _full(text, ISO_DAY), 1)
        .when(_full(text, PLAIN_NUMBER), 2)
        .otherwise(3)
    )


def xsd_kind(value: Column, text: Column | None = None) -> Column:
    """Position in XSD_CLASSES, null for a blank value; `text` as in `relational_class`."""
    text = stripped(value) if text is None else text
    return (
        F.when(value.isNull() | (text == ""), F.lit(None))
        .when(~_begins(value, ""), 4)
        .when((F.octet_length(value) >= 29) & _full(value, XSD_STAMP), 0)
        .when((F.octet_length(value) == 10) & _full(value, ISO_DAY), 1)
        .when(_full(value, XSD_LONG), 2)
        .when(_full(value, XSD_DECIMAL), 3)
        .otherwise(4)
    )
