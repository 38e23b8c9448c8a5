import hashlib
import re

import pytest
from compare import connect
from pyspark.sql import functions as F
from rows import DOCS, documents

from slotwise.llm import queries
from slotwise.llm.fill_middle import checked_marks, restored, transform
from slotwise.llm.sql import FILL_IN_MIDDLE

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text):
    body = text or ""
    units = UNIT.findall(body)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not body or any(m in body for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, len(units), "plain", body, None, None)
    if h4 % 100 < 80:
        return (doc_id, len(units), "spm", f"<S>{suffix}<P>{prefix}<M>{middle}", len(prefix), len(middle))
    return (doc_id, len(units), "psm", f"<P>{prefix}<S>{suffix}<M>{middle}", len(prefix), len(middle))


def check(spark, texts):
    rows = transform(documents(spark, texts)).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    got = {r.doc_id: (r.doc_id, r.n, r.form, r.output, r.prefix_chars, r.middle_chars) for r in rows}
    assert got == {i: brute(i, t) for i, t in enumerate(texts)}
    assert all(r.back == (r.text or "") for r in rows)
    return rows


def test_equals_brute_force(spark):
    texts = ["one two\tthree \n", "  lead", "tail  ", "", None, " ", "x", "𝄞 é x y z", "a < P> b >S< <", "a <P> b", "$1 \\2 (c) {3}"] * 12
    forms = {r.form for r in check(spark, texts)}
    assert forms == {"plain", "psm", "spm"}


def test_very_long_texts(spark):
    check(spark, ["word " * 300_000 + str(i) for i in range(6)] + ["x" * 2_000_000, " " * 1_000_000] * 3)


def test_clashing_columns_null_ids_and_repeats(spark):
    df = spark.createDataFrame(
        [(None, "a b c", 1, "q"), (7, "a b c", 2, "r"), (7, "a b c", 3, "s")], "doc_id long, text string, n int, n_ string"
    ).withColumn("row", F.lit(5))
    out = transform(df, rate=100)
    assert out.columns == ["doc_id", "text", "n_", "row", "n__", "n", "form", "output", "prefix_chars", "middle_chars"]
    rows = sorted(out.collect(), key=lambda r: r["n__"])
    assert [(r.doc_id, r["n__"], r.n_, r.n) for r in rows] == [(None, 1, "q", 3), (7, 2, "r", 3), (7, 3, "s", 3)]
    assert rows[1].output == rows[2].output


def test_empty_table_and_marks(spark):
    assert transform(spark.createDataFrame([], DOCS)).count() == 0
    for bad in (("<P>", "<S>", ""), ("ab", "ba", "c"), ("<", "<S>", "<M>"), ("<P>", "<P>", "<M>")):
        with pytest.raises(ValueError):
            checked_marks(bad)
    marks = ("[$1]", "[\\s]", "[m]")
    rows = transform(documents(spark, ["a b c d"] * 30), marks=marks, rate=100)
    back = rows.withColumn("back", restored(F.col("output"), F.col("form"), marks)).collect()
    assert all(r.back == r.text and r.output.count("[") == 3 for r in back)


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op13_fill_in_middle(spark, folder)
    want = connect(folder).execute(f"SELECT {', '.join(got.columns)} FROM ({FILL_IN_MIDDLE})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
