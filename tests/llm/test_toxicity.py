"""The network: gradients by differences, windows, held-out accuracy, odd texts."""

import random

import numpy as np
import pyarrow as pa
import pytest

from sluice.llm import toxicity as tox


def small_network(words):
    g = np.random.default_rng(1)
    net = tox.Network.start({w: i for i, w in enumerate(words[:4], 1)}, g.normal(size=5), g.normal(size=2**tox._BITS))
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    return net


def test_gradient_is_that_of_the_loss():
    words = ["alpha", "beta", "gamma", "delta", "epsilon"]
    net = small_network(words)
    ids = np.array([[0, 1, 2, 4, 3, 5], [3, 3, 5, 5, 5, 5], [5, 5, 5, 5, 5, 5]])  # 5 is padding
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])
    known = np.array([1, 2, 3, 4, 0])

    def loss():
        s = net.forward(net.table(net.inputs(words, known)[0]), ids)
        return float((weight * np.logaddexp(0, np.where(y == 1, -s, s))).sum() / weight.sum())

    g = net.gradient(words, ids, y, weight, known)
    rng = np.random.default_rng(2)
    for name, d in g.items():
        flat = net.p[name].reshape(-1)
        used = np.flatnonzero(d.reshape(-1)) if name in ("word", "char") else np.arange(flat.size)
        for i in rng.choice(used, min(6, len(used)), replace=False):
            old = flat[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-2 - d.reshape(-1)[i]) < 2e-3, name


def test_windows_overlap_and_cover():
    w, s = tox.WINDOW, tox.STRIDE
    sizes = [0, 1, w - 1, w, w + 1, w + s, w + s + 1, 1000]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    ids, first = tox.windows(np.arange(bounds[-1]), bounds, -7)
    last = np.append(first[1:], len(ids))
    for n, lo, a, b in zip(sizes, bounds, first, last):
        assert b - a == max(1, -(-(n - w) // s) + 1)
        assert set(ids[a:b].ravel()) - {-7} == set(range(lo, lo + n))  # every word, no other's
        for k in range(a, b):
            assert ids[k, 0] == (lo + s * (k - a) if n else -7)


def test_padding_changes_nothing():
    words = ["alpha", "beta", "gamma", "delta", "epsilon"]
    net = small_network(words)
    table = net.table(net.inputs(words)[0])
    short, long = np.array([[0, 1, 2]]), np.array([[0, 1, 2, 5, 5, 5, 5]])
    assert np.allclose(net.forward(table, short), net.forward(table, long), atol=1e-5)


def test_words_and_characters():
    words, index, bounds = tox.cut_words(pa.array(["", "Idiot!! --- «naïve» x", " \n ", "IDIOT"]))
    assert [words[i] for i in index] == ["idiot", "naïve", "x", "idiot"] and bounds.tolist() == [0, 0, 3, 3, 4]
    one, _ = tox.characters(["abcdef"])
    both, owner = tox.characters(["zz", "abcdef", ""])
    assert both[owner == 1].tolist() == one.tolist() and (owner == 2).sum() == 0
    assert len(one) == 6 + 4 + 3  # trigrams of <abcdef>, beginnings and ends


def made(n, seed=0):
    """Clean prose; toxic texts hold a few words of a kind, some never seen in the fit, anywhere in the text."""
    g = random.Random(seed)
    clean = ["".join(g.choice("aeiou") + g.choice("bdgklmnprst") for _ in range(g.randint(1, 4))) for _ in range(400)]
    rows = []
    for i in range(n):
        text = g.choices(clean, k=g.randint(5, 300))
        toxic = g.random() < 0.3
        if toxic:
            at = g.randrange(len(text))
            text[at:at] = [f"zwyx{g.choice(clean)}".upper() + "!!" for _ in range(3)]
        rows.append((i, " ".join(text), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def trained():
    rows = made(700)
    return tox.train([r[1] for r in rows[:500]], [r[2] for r in rows[:500]], 0.3), rows[500:]


def test_held_out_accuracy(trained):
    net, rows = trained
    score = net.worst(pa.array([r[1] for r in rows]))
    assert np.mean((score >= 0) == np.array([r[2] for r in rows])) >= 0.97


def test_a_passage_anywhere_in_a_long_text_counts(trained):
    net, rows = trained
    clean = " ".join(r[1] for r in rows if not r[2])
    words = clean.split(" ")
    bad = "ZWYXabed!! zwyxotok zwyxenel"
    texts = [" ".join([*words[:k], bad, *words[k:]]) for k in (0, len(words) // 2 + 5, len(words))]
    assert (net.worst(pa.array(texts)) >= 0).all() and net.worst(pa.array(["x", bad])).argmax() == 1


def test_score_of_odd_rows(spark, trained):
    net, rows = trained
    odd = [(1, None), (2, ""), (3, " \n\t "), (4, "!!! ---"), (5, rows[0][1]), (5, rows[0][1]), (None, rows[0][1]), (6, "ab" * 300_000), (7, "ano " * 60_000)]
    docs = spark.createDataFrame([(*r, 0.5, "x") for r in odd], "doc_id long, text string, toxicity double, word string")
    got = tox.score(docs, net).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "word", "toxicity", "toxic_pred"} and len(got) == len(odd)
    assert all(0 <= r["toxicity"] <= 1 and r["toxic_pred"] == int(r["toxicity"] >= 0.5) for r in got)
    by = {(r["doc_id"], r["text"]): r["toxicity"] for r in got}
    assert len({by[1, None], by[2, ""], by[3, " \n\t "], by[4, "!!! ---"]}) == 1 and by[2, ""] < 0.5
    assert by[5, rows[0][1]] == by[None, rows[0][1]]
    assert tox.score(docs.limit(0), net).count() == 0


def test_fit_of_odd_tables(spark):
    docs = spark.createDataFrame([(r[0], r[1]) for r in made(60)] + [(None, "x"), (900, None), (901, "")], "doc_id long, text string")
    schema = "doc_id long, toxic int, text string"
    assert tox.fit(docs, spark.createDataFrame([], schema)).p == {}
    one = tox.fit(docs, spark.createDataFrame([(1, 0, ""), (2, 0, ""), (3, None, "")], schema))
    assert one.p == {} and {r["toxicity"] for r in tox.score(docs, one).collect()} == {0.0}
    rows = [(r[0], r[2], "clash") for r in made(60)] + [(None, 1, ""), (900, 1, ""), (901, 1, ""), (5, 0, ""), (77777, 1, "")]
    assert tox.fit(docs, spark.createDataFrame(rows, schema)).p


def test_registered_query_holds_out_a_fifth(spark):
    import zlib

    from sluice.llm.queries import queries

    sf = "/root/testdata/sf0.01"
    got = queries()["op12_toxicity"](spark, sf).collect()
    docs = {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    assert {r["doc_id"] for r in got} == docs and len(got) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    mine = [(labels[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([a == b for a, b in mine]) >= 0.88
