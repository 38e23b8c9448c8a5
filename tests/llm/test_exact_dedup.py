import hashlib
import re

from rows import DOCS, documents

from slotwise.llm.exact_dedup import drop_duplicates, duplicate_groups


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for norm, members in groups.items():
        keep = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0]))
        out += [
            (i, keep[0], len(members), i == keep[0] and len(t) == len(keep[1]), hashlib.sha256(norm.encode()).hexdigest())
            for i, t in members
        ]
    return sorted(out, key=repr)


def test_groups_equal_brute_force(spark):
    texts = ["a b", "ab", " a  b ", None, "", " \n", "x y", "xy", "é\x0b", "é", "𝄞 x", "𝄞x", "b" * 70_000, "b" * 70_000 + " "]
    rows = list(enumerate(texts))
    got = duplicate_groups(documents(spark, texts)).drop("keep_rows").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_repeated_rows_null_ids_and_odd_columns(spark):
    df = spark.createDataFrame(
        [(1, "a a", 5, 1), (1, "a a", 6, 2), (2, "aa", 7, 3), (None, "b", 8, 4), (3, "b ", 9, 5)], "doc_id long, text string, norm int, h int"
    )
    groups = {(r.doc_id, r.kept, r.group_size) for r in duplicate_groups(df).collect()}
    assert groups == {(1, True, 3), (2, False, 3), (None, False, 2), (3, True, 2)}
    kept = drop_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3]


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert duplicate_groups(empty).count() == 0
    assert drop_duplicates(empty).count() == 0


def test_columns_of_any_name(spark):
    names = ["_rows", "_hash", "_n", "_k", "row", "id", "hash", "n", "_kept_id"]
    df = spark.createDataFrame([(1, "a a"), (2, "aa"), (1, "a a"), (3, "b")], "doc_id long, text string")
    df = df.selectExpr("*", *[f"'{c}' as `{c}`" for c in names])
    out = drop_duplicates(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [(1, "a a", *names), (3, "b", *names)]
