"""Fill-in-middle transformation by one counted match per text.

A text is cut into units (lines, by default), ``regexp_count`` gives their number n,
and two cuts are drawn from a digest of the id. A pattern made for the row,
``((?:unit){a}+)((?:unit){b-a}+)(.*+)``, then captures prefix, middle and suffix in one
match: its counted quantifiers are possessive, so the matcher steps from unit to unit,
keeps no way back, and neither its stack nor its time grows beyond the text's length.
The match writes the three parts with a mark between them, which the text cannot hold.

Everything is DataFrame functions on one row at a time: no shuffle, no Python.

A unit pattern must leave no gap between the units of a text. The parts come back from
an output by its marks alone (``restored``), since a text that holds a mark stays plain.

Defined results: a null text is an empty one, which stays plain with n = 0; a null id
draws like the empty one; texts of one line or without line feeds have n = 1, where
prefix, middle or both may be empty; rows that repeat an id are cut at the same shares
of their own texts; extra columns, also clashing ones, come back unchanged; an empty
table gives no rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A line with its line feed, or what follows the last line feed.
LINE = r"[^\n]*+\n|[^\n]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Of 100 texts so many are transformed, and of 100 of these so many with the suffix first.
RATE, SUFFIX_FIRST = 100, 50


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of eight hexadecimal digits as an integer."""
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def cut_pattern(unit: str, a: Column, b: Column) -> Column:
    """The pattern of a row: ``a`` units, ``b - a`` units and the rest, captured."""
    return F.concat(
        F.lit(rf"(?s)\A((?:{unit}){{"), a.cast("string"), F.lit(rf"}}+)((?:{unit}){{"), (b - a).cast("string"), F.lit("}+)(.*+)")
    )


def fill_in_middle(
    docs: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    unit: str = LINE,
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
    columns: list[str] | None = None,
) -> DataFrame:
    """A struct ``row`` of the chosen ``columns`` (default all), the number ``n`` of units, the
    ``form`` (plain, psm, spm), ``prefix``, ``middle`` and ``suffix`` (null if plain) and
    the ``output``: the text; prefix, suffix, middle; or suffix, prefix, middle, each
    after its mark."""
    if len(set(marks)) < 3 or any(re.fullmatch(r"<[^<>]+>", m) is None for m in marks):
        raise ValueError("marks must be three different names in angle brackets")
    first, last, mid = marks
    rows = docs.select(F.struct(*(columns or docs.columns)).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(key).cast("string").alias("key"))
    rows = rows.select(
        "row",
        "text",
        F.regexp_count("text", F.lit(unit)).cast("long").alias("n"),
        F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("key", F.lit(""))), 256).alias("digest"),
    )
    plain = (F.col("text") == "") | (_draw(F.col("digest"), 3) % 100 >= rate)
    for mark in marks:
        plain = plain | F.contains("text", F.lit(mark))
    cuts = [_draw(F.col("digest"), k) % (F.col("n") + 1) for k in (1, 2)]
    rows = rows.select(
        "row",
        "text",
        "n",
        F.when(plain, "plain").when(_draw(F.col("digest"), 4) % 100 < suffix_first, "spm").otherwise("psm").alias("form"),
        F.least(*cuts).alias("a"),
        F.greatest(*cuts).alias("b"),
    )
    # One match writes all three parts; marks start and end apart, so none can form across a border.
    parted = F.regexp_replace("text", cut_pattern(unit, F.col("a"), F.col("b")), F.lit(f"$1{first}$2{first}$3"))
    parts = F.split(parted, rf"\Q{first}\E", -1)
    rows = rows.select("row", "text", "n", "form", F.when(F.col("form") != "plain", parts).alias("parts"))
    rows = rows.select("row", "text", "n", "form", *[F.col("parts")[i].alias(c) for i, c in enumerate(("prefix", "middle", "suffix"))])
    output = (
        F.when(F.col("form") == "psm", F.concat(F.lit(first), "prefix", F.lit(last), "suffix", F.lit(mid), "middle"))
        .when(F.col("form") == "spm", F.concat(F.lit(last), "suffix", F.lit(first), "prefix", F.lit(mid), "middle"))
        .otherwise(F.col("text"))
    )
    return rows.select("row", "n", "form", "prefix", "middle", "suffix", output.alias("output"))


def restored(output: Column, form: Column, marks: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that became ``output``, from it and its form alone; one match again."""
    first, last, mid = (rf"\Q{m}\E" for m in marks)
    psm = F.regexp_replace(output, rf"(?s)\A{first}(.*?){last}(.*?){mid}(.*+)", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{last}(.*?){first}(.*?){mid}(.*+)", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_middle_report(docs: DataFrame, **options) -> DataFrame:
    """Lengths and digests of what ``fill_in_middle`` makes of every document."""
    done = fill_in_middle(docs, columns=["doc_id"], **options)
    return done.select(
        F.col("row")["doc_id"].alias("doc_id"),
        "n",
        "form",
        F.length("prefix").cast("long").alias("prefix_chars"),
        F.length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


#: The same rows for DuckDB, from lists of lines.
FIM_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), c AS (
  SELECT doc_id, text, u, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR ('0x' || h[17:24])::BIGINT % 100 >= 100 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT doc_id, text, n, form,
         CASE WHEN form <> 'plain' THEN coalesce(array_to_string(u[1:least(x, y)], ''), '') END AS prefix,
         CASE WHEN form <> 'plain' THEN coalesce(array_to_string(u[least(x, y) + 1:greatest(x, y)], ''), '') END AS middle,
         CASE WHEN form <> 'plain' THEN coalesce(array_to_string(u[greatest(x, y) + 1:], ''), '') END AS suffix
  FROM c
)
SELECT doc_id, n, form, length(prefix)::BIGINT AS prefix_chars, length(middle)::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""
