"""String cleaning expressions (all JVM-side, no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.params import CSV_NULL_TOKENS, FLAG_YES

# Python's str.strip() removes every character for which str.isspace() holds
# (Unicode White_Space plus U+001C..U+001F). Spark's trim() removes only U+0020,
# so the strip set is built by that rule; all such characters lie below U+3001.
STRIP_CHARS = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def unicode_strip(c: Column | str) -> Column:
    """Strip leading and trailing whitespace like ``str.strip()``; null stays null.

    ``btrim`` with an explicit character set runs in generated code without a
    regex engine (about 3x cheaper than a ``regexp_replace``).
    """
    return F.btrim(F.col(c) if isinstance(c, str) else c, F.lit(STRIP_CHARS))


def unicode_strip_all(df: DataFrame, names: list[str]) -> DataFrame:
    """``unicode_strip`` of many columns. Text that starts and ends with a printable ASCII
    character is kept without the trim's walk over all characters. One expression over an
    array, as the same test written out for every column makes generated code that is too
    long to be compiled."""
    if not names:
        return df

    def stripped(text: Column) -> Column:
        last = F.substring(text.cast("binary"), -1, 1)
        plain = (text >= "!") & (text < "\x7f") & (last >= F.lit(bytearray(b"!"))) & (last < F.lit(bytearray(b"\x7f")))
        return F.when(plain, text).otherwise(unicode_strip(text))

    done = df.withColumn("__stripped", F.transform(F.array(*names), stripped))
    at = {name: i for i, name in enumerate(names)}
    return done.select(*[F.col("__stripped")[at[c]].alias(c) if c in at else F.col(c) for c in df.columns])


def null_tokens_to_null(c: Column | str, tokens=CSV_NULL_TOKENS) -> Column:
    """Missing-value tokens of a CSV cell become null; other text is kept as is.

    Matching is exact (before any strip), so a padded token such as ``" NA "``
    survives as text.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col.isin(*tokens), F.lit(None).cast("string")).otherwise(col)


def flag_to_int(c: Column | str) -> Column:
    """Yes/no flag text to 1/0; any case, null or other text gives 0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.lower(col) == F.lit(FLAG_YES), F.lit(False)).cast("int")
