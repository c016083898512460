"""Scalar expressions. All of them are built-in column expressions."""

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardlog import schema as S


def text_or_empty(col) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def blank_to_null(col) -> Column:
    """NULL and the empty string are the same thing once a table has been stored."""
    return F.nullif(F.col(col) if isinstance(col, str) else col, F.lit(""))


def parse_ts(col) -> Column:
    """Wall-clock timestamp of an ISO text; NULL where it cannot be parsed."""
    return (F.col(col) if isinstance(col, str) else col).try_cast("timestamp_ntz")


def parse_instant(col) -> Column:
    """Point in time of an ISO text (zone offsets applied); NULL where it cannot be parsed."""
    return (F.col(col) if isinstance(col, str) else col).try_cast("timestamp")


def day(ts: Column) -> Column:
    return F.to_date(ts)


def hour(ts: Column) -> Column:
    return F.hour(ts)


def number_or_zero(col) -> Column:
    """Numeric value; what is no finite number (other text, NULL, NaN, the infinities) becomes 0."""
    value = (F.col(col) if isinstance(col, str) else col).try_cast("double")
    return F.when(F.isnan(value) | (F.abs(value) == float("inf")), 0.0).otherwise(F.coalesce(value, F.lit(0.0)))


def int_or_zero(col) -> Column:
    """Whole part of the numeric value; what does not fit becomes 0."""
    return F.coalesce(number_or_zero(col).try_cast("int"), F.lit(0))


def percent(part: Column, whole: Column) -> Column:
    """part / whole * 100 in this order of operations; NULL when whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def pattern(name: str) -> str:
    """JVM form of a command pattern."""
    return S.PATTERNS[name].replace(r"\s", S.WHITE_SPACE)


def matches(text: Column, name: str) -> Column:
    return text.rlike(pattern(name))


def command_flags(text: Column) -> dict[str, Column]:
    """The six 0/1 flags of one complete command text."""
    return {name: matches(text, name).cast("int") for name in S.PATTERNS}


def threat_score() -> Column:
    """0..22, from login_success and the six flags."""
    login = F.col("login_success").cast("int") * S.LOGIN_WEIGHT
    return reduce(add, [F.col(n) * w for n, w in S.WEIGHTS.items()], login).cast("int")


def threat_code(score: Column) -> Column:
    return F.when(score >= S.HIGH_SCORE, 2).when(score >= S.MEDIUM_SCORE, 1).otherwise(0)


def level_name(code: Column, unknown=None) -> Column:
    """Text of a 0/1/2 code."""
    out = F.lit(unknown).cast("string")
    for value, name in enumerate(S.LEVELS):
        out = F.when(code == value, F.lit(name)).otherwise(out)
    return out


def level_code(level: Column) -> Column:
    out = F.lit(None).cast("int")
    for value, name in enumerate(S.LEVELS):
        out = F.when(level == name, F.lit(value)).otherwise(out)
    return out


def joined_text(commands: Column) -> Column:
    """Inputs of an array of {timestamp, input}, joined with the separator."""
    return F.array_join(
        F.transform(commands, lambda c: F.coalesce(c["input"], F.lit(""))), S.COMMAND_SEPARATOR
    )


def split_commands(text: Column) -> Column:
    """Pieces of a text at the separator; empty pieces stay."""
    return F.split(text, r" \| ")


def list_length(col: Column) -> Column:
    """Number of elements of a list (or entries of an object) stored as text; 0 otherwise.

    Accepts JSON and the printed form of Python lists. The latter is rewritten to JSON: the
    three bare words. Single quotes and its escapes are taken by the parser's options.
    """
    options = {
        "mode": "PERMISSIVE", "allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true",
        "allowUnquotedControlChars": "true",
    }
    text = F.regexp_replace(col, r"\bTrue\b", "true")
    text = F.regexp_replace(text, r"\bFalse\b", "false")
    text = F.regexp_replace(text, r"\bNone\b", "null")
    as_list = F.size(F.from_json(text, "array<string>", options))
    as_map = F.size(F.from_json(text, "map<string,string>", options))
    return (
        F.when(F.startswith(F.ltrim(text), F.lit("[")), F.greatest(as_list, F.lit(0)))
        .when(F.startswith(F.ltrim(text), F.lit("{")), F.greatest(as_map, F.lit(0)))
        .otherwise(0)
    )


def one_line(col: Column) -> Column:
    """Text without line breaks: backslash, line feed and carriage return as two characters."""
    text = F.replace(col, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def one_line_decode(col: Column) -> Column:
    """The inverse of one_line: escaped backslashes divide the text, the breaks come back between them."""
    def breaks(part):
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    return F.array_join(F.transform(F.split(col, r"\\\\"), breaks), "\\")


def map_key(col: Column) -> tuple[Column, Column]:
    """(threat, cluster) out of '(t, c)' or 't,c'; a number that does not fit is NULL."""
    parts = F.regexp_extract_all(col, F.lit(r"-?\d+"), F.lit(0))
    return F.try_element_at(parts, F.lit(1)).try_cast("int"), F.try_element_at(parts, F.lit(2)).try_cast("int")


def prettify(col: Column) -> Column:
    return F.initcap(F.replace(col, F.lit("_"), F.lit(" ")))


def hash_order(id_col, seed) -> Column:
    """Hex text that orders rows at random, the same way in every run and engine."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))
