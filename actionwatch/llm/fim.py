"""Fill-in-middle transformation by one counted-quantifier match a row.

``regexp_count`` gives the number of units of a text. Two cut points, drawn by a digest of the row's id, go into a
pattern of the row's own: a group of ``a`` units, a group of ``b - a`` units, and the rest. All quantifiers are
possessive, so a match never steps back and takes time in proportion to the text, with a flat stack. One replacement by
that pattern writes the three groups in the order of the row's form, with the markers in front of them.
"""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import text_of

#: A word of ASCII letters, or any other character.
UNIT = "[A-Za-z]++|[^A-Za-z]"
#: Markers of prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Percent of texts that stay plain, and of the others that put the suffix first.
PLAIN, SUFFIX_FIRST = 10, 20


def check_markers(markers: tuple[str, str, str]) -> None:
    """Markers must be such that one beside any text never makes another: none empty, none inside or overlapping another."""
    if not all(markers) or len({*markers}) < 3:
        raise ValueError("three different markers are needed")
    for x, y in product(markers, markers):
        if x != y and x in y or any(x[k:] == y[: len(x) - k] for k in range(1, len(x))):
            raise ValueError(f"an end of {x!r} begins {y!r}, or one holds the other")


def draws(seed: str, key: Column, n: int) -> list[Column]:
    """``n`` unsigned 32-bit numbers of a row: groups of eight digits of SHA-256 of ``seed:key``; a null key is empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def _quoted(marker: str) -> str:
    """A marker as literal text of a replacement."""
    return re.sub(r"([\\$])", r"\\\1", marker)


def transform(docs: DataFrame, *, key: str = "doc_id", text: str = "text", seed: str = "1", unit: str = UNIT, markers: tuple[str, str, str] = MARKERS, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(key, text, n, form, prefix_chars, middle_chars, output) of each row.

    ``n`` counts units, ``form`` is plain, psm (prefix, suffix, middle) or spm (suffix first). Texts that are empty or
    null or hold a marker stay plain, and so do ``plain`` percent of the rest; their lengths are null. Lengths are code
    points. Repeated rows each come out, rows of one key with the same draws; other columns are not read.
    ``unit`` must match every character.
    """
    check_markers(markers)
    first, second, share, order = draws(seed, F.col("key"), 4)
    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    rows = rows.select("key", "text", F.regexp_count("text", F.lit(f"(?s){unit}")).cast("long").alias("n"))
    marked = F.lit(False)
    for m in markers:
        marked = marked | F.contains("text", F.lit(m))
    form = F.when((F.col("text") == "") | marked | (share % 100 >= 100 - plain), "plain").when(order % 100 < suffix_first, "spm").otherwise("psm")
    rows = rows.select("key", "text", "n", form.alias("form"), (first % (F.col("n") + 1)).alias("x"), (second % (F.col("n") + 1)).alias("y"))
    a, b = F.least("x", "y"), F.greatest("x", "y")
    pattern = F.concat(F.lit(rf"(?s)\A((?:{unit}){{"), a, F.lit(rf"}}+)((?:{unit}){{"), b - a, F.lit(r"}+)(.*+)\z"))
    p, s, m = map(_quoted, markers)
    order = F.when(F.col("form") == "psm", f"{p}$1{s}$3{m}$2").otherwise(f"{s}$3{p}$1{m}$2")
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order))
    rows = rows.select("key", "text", "n", "form", output.alias("output"))
    p, s, m = markers
    at = lambda marker: F.instr("output", marker)
    prefix = F.when(F.col("form") == "psm", at(s) - 1 - len(p)).when(F.col("form") == "spm", at(m) - at(p) - len(p))
    middle = F.when(F.col("form") != "plain", F.char_length("output") - at(m) + 1 - len(m))
    return rows.select(F.col("key").alias(key), F.col("text").alias(text), "n", "form", prefix.cast("long").alias("prefix_chars"), middle.cast("long").alias("middle_chars"), "output")


def restore(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that an output was made from."""
    check_markers(markers)
    p, s, m = (rf"\Q{x}\E" for x in markers)
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


ORACLE_SQL = """WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
d AS (SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
f AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM p"""
