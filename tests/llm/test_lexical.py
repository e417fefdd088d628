"""Ranked search against a plain ranking of all documents, and the blocks' bounds against their documents."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import lexical

DOCS, ITEMS = "doc_id long, text string, rank int", "item_id long, text string, score string"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(docs, items, k=10):
    terms = [(i, Counter(re.findall(lexical.TERM, lowered(t)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n, length = len(terms), sum(sum(c.values()) for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, Counter()).update(re.findall(lexical.TERM, lowered(t)))
    out = set()
    for i, c in asked.items():
        scored = []
        for doc, own in terms:
            m = 100 - 75 + 75 * sum(own.values()) * n // length
            s = sum(r * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * own[t] // (1000 * own[t] + 8 * m)) for t, r in c.items() if t in own)
            if s > 0:
                scored.append((-s, doc is None, doc))
        out |= {(i, at, doc, -s) for at, (s, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)}
    return out


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, 1) for d in docs], DOCS).repartition(3), spark.createDataFrame([(*i, "x") for i in items], ITEMS)


def corpus(seed, n=400):
    g = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ünder", "naïve", "ẞ", "日本語", "x1", "É"]
    weight = [1 / (i + 1) for i in range(len(words))]
    text = lambda m: "".join(w + g.choice([" ", "\n", "--", ", ", "\t", " ", "_"]) for w in g.choices(words, weight, k=m))
    docs = [(i, text(g.randint(0, 60))) for i in range(n)]
    docs += [(1000 + i, docs[i % 7][1].upper()) for i in range(80)]  # groups of copies: equal scores
    docs += [(None, docs[3][1]), (5, docs[5][1]), (2000, None), (2001, ""), (2002, "-- .. --"), (2003, text(30_000)), (2004, "w1 " * 20_000)]
    items = [(i, text(g.randint(1, 30))) for i in range(12)] + [(20, None), (21, "!?"), (22, "unheard of"), (23, "w1 w1 W1"), (24, "w2"), (24, "w3 w2")]
    return docs, items


@pytest.mark.parametrize(("shard", "passes"), [(2**24, 200_000), (66 * 24, 40)])
def test_search_matches_plain_ranking(spark, monkeypatch, shard, passes):
    monkeypatch.setattr(lexical, "_CELLS", shard)  # many shards of 24 documents at most
    monkeypatch.setattr(lexical, "_PASS", passes)  # several passes of items
    docs, items = corpus(1)
    got = lexical.search(*frames(spark, docs, items)).collect()
    assert {tuple(r) for r in got} == plain(docs, items) and len(got) == len(plain(docs, items))


def test_search_of_empty_tables(spark):
    docs, items = corpus(2, 10)
    assert lexical.search(*frames(spark, [], items)).count() == 0
    assert lexical.search(*frames(spark, docs, [])).count() == 0
    assert lexical.search(*frames(spark, [(1, None)], items)).count() == 0
    assert lexical.search(*frames(spark, docs, [(1, None)])).count() == 0


def test_fold_cuts_as_the_pattern_does():
    text = "".join(map(chr, range(0, 0x250))) + " aB c\U0001f600Z"
    vocabulary = sorted(set(re.findall(lexical.TERM, lowered(text))))
    n, doc, term, tf = lexical.counted_terms(pa.array(["", text, "x", text]), pa.array(vocabulary))
    want = Counter(re.findall(lexical.TERM, lowered(text)))
    assert n.tolist() == [0, sum(want.values()), 1, sum(want.values())]
    assert {vocabulary[t]: f for d, t, f in zip(doc, term, tf) if d == 1} == want


def test_blocks_cover_their_list_and_bound_their_documents():
    g = np.random.default_rng(0)
    values = np.where(g.random((300, 12)) < 0.4, g.integers(1, 10**6, (300, 12)), 0).astype(np.int32)
    doc, term = np.nonzero(values)
    items = lexical.Items([0, 1], [np.arange(8), np.array([3, 9, 11])], [np.ones(8, int), np.array([2, 1, 1])], np.arange(1, 13))
    shard = lexical.Shard(pa.array(np.arange(300)), values, (doc, term), items)
    docs, bounds, summary = shard.blocks(3)
    assert sorted(docs) == sorted(doc[term == 3]) and len(bounds) - 1 > 10
    for a, b, s in zip(bounds, bounds[1:], summary):
        assert (values[docs[a:b]][:, items.coordinates[3]].max(0) == s).all()
    assert set(items.coordinates[3]) == {0, 1, 2, 3, 4, 5, 6, 7, 9, 11}


def test_sql_states_the_same(spark, sf_dir):
    from sluice.llm.queries import oracle_sql, queries

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    want = con.sql(oracle_sql()["op11_lexical"]).fetchall()
    got = [tuple(r) for r in queries()["op11_lexical"](spark, sf_dir).collect()]
    assert len(got) == len(want) and set(got) == set(want)
