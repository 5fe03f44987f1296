"""Text columns: value cleaning, code normalising, raw JSON scrubbing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What counts as blank space, the code replacement, the scrub patterns.
SPACES = "".join(chr(code) for code in range(0x21))
CODE_REPLACEMENTS = {"NORM ": "NORM"}
LINE_CHARACTERS = "\n\r\t"
VENDOR_PREFIXES = [
    (r"t\$(date|full|conf|user)", "t_$1"),
    (r"T\$(DATE|FULL|CONF|USER)", "T_$1"),
    (r"[tT]\$", ""),
]
PADDED_TOKEN = r':" *(\S+?) *"'


def blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def clean_text(column: Column) -> Column:
    """Line breaks and tabs to spaces, trim every character up to U+0020, ``null`` to null."""
    flat = _replace_each(column, LINE_CHARACTERS, " ")
    return F.nullif(F.btrim(flat, F.lit(SPACES)), F.lit("null"))


def clean_text_columns(df: DataFrame) -> DataFrame:
    """Apply :func:`clean_text` to the string columns, leave the others as they are."""
    return df.select([
        clean_text(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
        else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def normalize_code(df: DataFrame, column: str = "shiftcode") -> DataFrame:
    """Upper-case a code and mend its one padded value; a frame without it passes through."""
    if column not in df.columns:
        return df
    return df.withColumn(column, F.upper(column)).replace(CODE_REPLACEMENTS, subset=[column])


def scrub_json_text(raw: Column) -> Column:
    """Repair raw JSON text before it is parsed.

    Vendor prefixes become plain names, control characters go, spaces around
    one-word values go, and blank values become the text ``null``.
    """
    text = raw
    for pattern, by in VENDOR_PREFIXES:
        text = F.regexp_replace(text, pattern, by)
    text = _replace_each(_replace_each(text, "$", "_"), LINE_CHARACTERS, "")
    text = F.regexp_replace(text, PADDED_TOKEN, ':"$1"')
    return F.replace(text, F.lit(':""'), F.lit(':"null"'))


def _replace_each(column: Column, characters: str, by: str) -> Column:
    """Replace single characters; plain replaces beat ``translate`` on long texts."""
    for character in characters:
        column = F.replace(column, F.lit(character), F.lit(by))
    return column
