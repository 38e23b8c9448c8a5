import math
import random
import re
from collections import Counter

import numpy as np
from compare import connect
from rows import DOCS, documents, sentence

from slotwise.llm import lexical, queries
from slotwise.llm.sql import RANKED_SEARCH

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def split(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    bags = [(i, Counter(split(t)), len(split(t))) for i, t in docs if split(t)]
    n_docs, n_terms = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(split(t))
    out = []
    for q, terms in asked.items():
        found = []
        for doc_id, bag, n in bags:
            m = 50 + 50 * n * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * m))
                for t in terms if bag[t]
            )
            if score > 0:
                found.append((-score, doc_id is None, doc_id))
        out += [(q, r, d, -s) for r, (s, _, d) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def check(spark, docs, items, k=5, **options):
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = lexical.ranked_search(table, spark.createDataFrame(items, ITEMS), k, **options)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items, k)


def test_equals_brute_force_over_shards_and_blocks(spark):
    rng = random.Random(1)
    docs = [(i, sentence(rng, rng.choice([1, 5, 40, 200])).replace("a", "A")) for i in range(400)]
    items = [(i, sentence(rng, 12)) for i in range(20)] + [(i, rng.choice(docs)[1]) for i in range(20, 30)]
    check(spark, docs, items, shard_docs=25)
    check(spark, docs, items, shard_docs=25, paired=0)
    check(spark, docs, items, k=50, block_terms=100)


def test_ties_repeats_nulls_and_odd_texts(spark):
    docs = [(9, "alpha beta"), (3, "beta alpha"), (3, "beta alpha"), (None, "alpha beta"), (4, None), (5, ""), (6, "?! \x00"), (7, "É é ß½ 日本 alpha"),
            (8, "x" * 500_000 + " beta " * 20_000), (-2, "alpha beta gamma"), (10, "other words here")]
    items = [(1, "Alpha BETA"), (1, "gamma"), (None, "é 日本"), (2, None), (4, "nothing like it"), (5, "other")]
    check(spark, docs, items, k=3)
    check(spark, docs, items, k=50, shard_docs=1)
    check(spark, [(1, "same")] * 3, [(1, "same same")], k=2)


def test_empty_tables_and_extra_columns(spark):
    some = documents(spark, ["a b", "b c"]).withColumnRenamed("lang", "rank").withColumnRenamed("source", "score")
    items = spark.createDataFrame([(1, "b", 7, 8)], "item_id long, text string, rank int, query_id int")
    assert [(r.doc_id, r["rank"]) for r in lexical.ranked_search(some, items).orderBy("rank").collect()] in ([(0, 1), (1, 2)], [])
    assert lexical.ranked_search(spark.createDataFrame([], DOCS), items).count() == 0
    assert lexical.ranked_search(some, spark.createDataFrame([], ITEMS)).count() == 0


def shard_of(seed=2, n=3000, terms=24):
    """Rare terms that hardly meet: where sums of independent maxima are loose."""
    rng = np.random.default_rng(seed)
    doc, term, tf = [], [], []
    for t in range(terms):
        own = np.flatnonzero(rng.random(n) < 0.02 + 0.3 * (t % 6 == 0))
        term += [t] * len(own)
        doc += own.tolist()
        tf += rng.integers(1, 9, len(own)).tolist()
    held, df = np.unique(term, return_counts=True)
    counted = {"ids": np.arange(n), "known": np.ones(n, bool), "n": rng.integers(20, 400, n), "term": held, "df": df, "doc": np.array(doc), "tf": np.array(tf)}
    weights = np.array([lexical.weight(n, int(x)) for x in df])
    pairs = np.array([(a, b) for a in range(terms) for b in range(a + 1, terms)])
    shard = lexical.impact_shard(counted, weights, n, int(counted["n"].sum()), pairs)
    shard["doc"] = shard["doc"].astype(np.int64)
    lists = {tuple(p): (at, int(j)) for at, (p, j) in enumerate(zip(pairs.tolist(), shard["joint"]))}
    return shard, lists


def test_bounds_hold_and_pairs_skip_more():
    shard, lists = shard_of()
    rng = np.random.default_rng(7)
    fewer = total = 0
    for _ in range(60):
        terms = np.sort(rng.choice(24, 6, replace=False))
        full = np.zeros(len(shard["ids"]), np.int64)
        for t in terms:
            s = slice(int(shard["cut"][t - 1]) if t else 0, int(shard["cut"][t]))
            full[shard["doc"][s]] += shard["impact"][s]
        for g in lexical.grouped(terms, shard["top"][terms], lists):
            own = np.zeros(len(full), np.int64)
            for a in g[1]:
                t = terms[a]
                s = slice(int(shard["cut"][t - 1]) if t else 0, int(shard["cut"][t]))
                own[shard["doc"][s]] += shard["impact"][s]
            assert own.max() <= g[0] <= sum(int(shard["top"][terms[a]]) for a in g[1])
        kth = int(np.sort(full)[-10])
        want = set(np.flatnonzero(full >= kth))
        plain, _, many = lexical.search(shard, terms, {}, 10, kth)
        found, score, few = lexical.search(shard, terms, lists, 10, kth)
        assert want <= set(found) and want <= set(plain) and (score == full[found]).all()
        fewer += many - few
        total += many
    assert fewer > total / 20


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op12_ranked_search(spark, folder)
    want = connect(folder).execute(f"SELECT {', '.join(got.columns)} FROM ({RANKED_SEARCH})").fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want)
