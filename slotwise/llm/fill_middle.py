"""Fill-in-middle transformation by counted quantifiers of one regular expression.

A text is a run of units, each a word with the blanks before it, or trailing blanks. ``regexp_count``
gives their number n. Two hashes of the id choose the cuts a <= b; a pattern made for the row,
``\\A(unit{a})(unit{b - a})(rest)\\z`` with possessive quantifiers, captures prefix, middle and suffix
in one match, and the replacement puts them in order between the marks. A possessive quantifier of
a group is a plain loop in Java's engine: it neither backtracks nor recurses, so long texts need no
stack. Everything is an expression on the row; nothing is shuffled.

Forms: ``psm`` is prefix, suffix, middle; ``spm`` is suffix, prefix, middle, each after its mark;
``plain`` texts stay as they are. The choice depends on id and seed only, so a rerun gives the same.

Defined results: a null text is empty, and an empty text is plain, as is one that holds a mark. A
null id counts as the empty string. Repeated rows are transformed alike. Texts of one unit and texts
of many megabytes are treated alike. Columns of the caller pass through; one that has the name of a
result (n, form, output, prefix_chars, middle_chars) is returned with ``_`` appended until its name is
free. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import text_of

# Fixed values of the contract.
UNIT = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+"
MARKS = ("<P>", "<S>", "<M>")
RESULT = ("n", "form", "output", "prefix_chars", "middle_chars")


def checked_marks(marks: Sequence[str]) -> tuple[str, str, str]:
    """Marks that can be told apart wherever they stand: none begins another, and their first
    characters occur nowhere else in them, so no mark overlaps another one or the text beside it."""
    prefix, suffix, middle = marks
    heads = {m[:1] for m in marks}
    inner = {c for m in marks for c in m[1:]}
    begun = any(b.startswith(a) for a, b in permutations(marks, 2))
    if not all(marks) or heads & inner or begun:
        raise ValueError(f"marks must be non-empty and free of overlaps: {tuple(marks)}")
    return prefix, suffix, middle


def _draws(id_col: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers of an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def _literal(mark: str) -> str:
    """A mark as text of a replacement."""
    return re.sub(r"([\\$])", r"\\\1", mark)


def _pattern(a: Column, b: Column) -> Column:
    """Prefix of a units, middle up to unit b, and the rest."""
    unit = f"(?:{UNIT})"
    return F.concat(
        F.lit(rf"(?s)\A({unit}{{"), a.cast("string"), F.lit(rf"}}+)({unit}{{"), (b - a).cast("string"), F.lit(r"}+)(.*)\z")
    )


def transform(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", marks: Sequence[str] = MARKS, seed: int = 42,
    rate: int = 50, spm_rate: int = 80,
) -> DataFrame:
    """All columns of ``docs`` and n (units), form, output, prefix_chars, middle_chars (code points,
    null if plain). ``rate`` of 100 texts are cut, ``spm_rate`` of 100 of those into the form spm."""
    p, s, m = checked_marks(marks)
    names = [c for c in docs.columns if c not in RESULT]
    columns = {c: c for c in names}
    for c in docs.columns:
        if c not in columns:
            free = c
            while free in RESULT or free in names:
                free += "_"
            names.append(free)
            columns[c] = free
    text = text_of(text_col)
    h1, h2, h3, h4 = _draws(F.col(id_col), seed)
    n = F.regexp_count(text, F.lit(UNIT)).cast("long")
    marked = F.contains(text, F.lit(p)) | F.contains(text, F.lit(s)) | F.contains(text, F.lit(m))
    form = F.when((F.length(text) == 0) | marked | (h3 % 100 >= rate), "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm")
    # One struct per step, so that no step's names can meet those of the caller.
    rows = docs.select(F.struct(*[F.col(f"`{c}`").alias(x) for c, x in columns.items()]).alias("row"), text.alias("text"), n.alias("n"), form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    cuts = [F.pmod(F.col(h), F.col("n") + 1) for h in ("h1", "h2")]
    rows = rows.select("row", "text", "n", "form", F.least(*cuts).alias("a"), F.greatest(*cuts).alias("b"))
    pattern, (p_, s_, m_) = _pattern(F.col("a"), F.col("b")), map(_literal, (p, s, m))
    output = (
        F.when(F.col("form") == "psm", F.regexp_replace("text", pattern, F.lit(f"{p_}$1{s_}$3{m_}$2")))
        .when(F.col("form") == "spm", F.regexp_replace("text", pattern, F.lit(f"{s_}$3{p_}$1{m_}$2")))
        .otherwise(F.col("text"))
    )
    rows = rows.select("row", "text", "n", "form", output.alias("output"))
    # Lengths of the parts are distances of the marks.
    at = {x: F.locate(x, F.col("output")) for x in (p, s, m)}
    prefix = F.when(F.col("form") == "psm", at[s] - at[p] - len(p)).when(F.col("form") == "spm", at[m] - at[p] - len(p))
    middle = F.when(F.col("form") != "plain", F.length("output") - at[m] - len(m) + 1)
    return rows.select(
        *[F.col("row").getField(c).alias(c) for c in names], "n", "form", "output",
        prefix.cast("long").alias("prefix_chars"), middle.cast("long").alias("middle_chars"),
    )


def restored(output: Column, form: Column, marks: Sequence[str] = MARKS) -> Column:
    """The text from output and form."""
    p, s, m = (re.escape(x) for x in checked_marks(marks))
    psm = F.regexp_replace(output, F.lit(rf"(?s)\A{p}(.*?){s}(.*?){m}(.*)\z"), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(rf"(?s)\A{s}(.*?){p}(.*?){m}(.*)\z"), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
