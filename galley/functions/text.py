"""Text columns: list literals, versions, blanks, tokens."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_LENIENT_JSON = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_list(column: str | Column) -> Column:
    """List text such as ``['A', "B's"]`` to array<string>; blank, NULL or garbage to NULL."""
    return F.from_json(_col(column), "array<string>", _LENIENT_JSON)


# A whole quoted string of list text, in either kind of quote.
_QUOTED = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""


def _bare_word(text: Column, word: str, replacement: str) -> Column:
    """Replace ``word`` where it stands outside quotes.

    Each match starts where the last one ended and takes quoted strings whole, so a title
    that contains the word is left alone.
    """
    first, rest = word[0], word[1:]
    skipped = rf"((?:[^'\"{first}]++|{first}(?!{rest})|{_QUOTED})*+)"
    return F.regexp_replace(text, rf"\G{skipped}{word}", f"$1{replacement}")


def parse_records(column: str | Column, ddl: str) -> Column:
    """Legacy list-of-records text to a typed array.

    The text carries None/True/False where JSON has null/true/false.
    """
    text = _col(column)
    for word, json_word in (("None", "null"), ("True", "true"), ("False", "false")):
        text = _bare_word(text, word, json_word)
    return F.from_json(text, ddl, _LENIENT_JSON)


def not_blank(column: str | Column) -> Column:
    """True for a value that is neither NULL nor the empty string."""
    return _col(column).isNotNull() & (_col(column) != "")


def blank_to_null(column: str | Column) -> Column:
    """Trim, then turn the empty string into NULL."""
    return F.nullif(F.trim(_col(column)), F.lit(""))


def version_key(column: str | Column) -> Column:
    """Version text as an array of numbers, so 4.29.0 sorts after 4.9.0."""
    numbers = F.regexp_extract_all(_col(column), F.lit(r"(\d+)"), 1)
    return F.transform(numbers, lambda n: n.try_cast("bigint"))


def words(column: str | Column, min_length: int = 1) -> Column:
    """Every maximal run of letters, of any script, in the lower-cased text that is long enough."""
    pattern = rf"(\p{{L}}{{{min_length},}})"
    return F.regexp_extract_all(F.lower(_col(column)), F.lit(pattern), 1)
