"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# White space as it can occur in decoded till text; Java's \s leaves out the last two ranges.
SPACE = r"[\s\x1C-\x1F\xA0]"
# What ends a line besides a line feed. A decoded cp1252 text holds no others.
_OTHER_BREAKS = r"[\r\x0B\x0C\x1C-\x1E]"

# The bytes on which cp1252 and latin-1 differ; undefined ones become the replacement character.
_C1_BYTES = bytes(range(0x80, 0xA0))
_LATIN1 = _C1_BYTES.decode("latin-1")
_CP1252 = "".join(bytes([b]).decode("cp1252", errors="replace") for b in _C1_BYTES)


def decode_cp1252(content: Column) -> Column:
    """Decode cp1252 bytes; bytes without a meaning become U+FFFD."""
    return F.translate(F.decode(content, "iso-8859-1"), _LATIN1, _CP1252)


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def unix_lines(text: Column) -> Column:
    """Text with a line feed at every line end."""
    return F.regexp_replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), _OTHER_BREAKS, "\n")


def text_lines(text: Column) -> Column:
    """Split text into lines; a final line break does not open another line."""
    return F.split(F.regexp_replace(unix_lines(text), r"\n\z", ""), "\n")


def blank_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def label_key(label: Column) -> Column:
    """Upper-case letters and digits of a label, for comparing labels that differ in punctuation."""
    return F.regexp_replace(F.upper(label), r"[^\p{L}\p{N}]", "")


def full_match(text: Column, pattern: str) -> Column:
    return text.rlike(rf"\A(?:{pattern})\z")


def fail_unless(condition: Column, value: Column, message: Column | str) -> Column:
    """``value``, or a failing job where ``condition`` is not true."""
    if isinstance(message, str):
        message = F.lit(message)
    return F.when(condition, value).otherwise(F.raise_error(message))


def holds(condition: Column, message: Column | str) -> Column:
    """A filter that keeps every row and fails the job where ``condition`` is not true.

    A filter stays in the plan whichever columns are read; a check within a value goes with its column.
    """
    return fail_unless(condition, F.lit(True), message)


def require_text(df: DataFrame, columns) -> DataFrame:
    """Identifiers must still be text: a number has already lost its leading zeros."""
    for name in columns:
        if not isinstance(df.schema[name].dataType, T.StringType):
            raise TypeError(f"{name} must stay text, found {df.schema[name].dataType.simpleString()}")
    return df
