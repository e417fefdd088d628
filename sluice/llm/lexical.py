"""Ranked lexical search by blocks of similar documents within each term's posting list.

Texts become sparse vectors over the terms that the items ask for, stored once.  Each task reads a part of these vectors
in shards of bounded size and indexes a shard as it comes: the documents that hold a term are clustered by the
similarity of their whole vectors, and each cluster is a block with a summary, the greatest value of its documents in every
coordinate that items holding the term ask for.  An item goes through its terms' lists from the greatest possible share
of the score down.  A summary's score bounds that of every document in its block, in whole numbers, so a block is skipped only
when the bound is below the k-th best score met by the task, and the lists that are left when all their shares together
are below it.  Nothing is approximate: what is skipped cannot be among the best.

Every task keeps k documents an item; the ranks come from those by a window with a limit of its own in each task.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .lines import LOWER, UPPER
from .tokens import array_slices

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# bytes of a text: A-Z lower-cased, all that is no part of a term a blank; bytes of longer code points stay
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

_BLOCK = 8  # documents a block on average
_SKETCH = 16  # dimensions of the projection that similarity is measured in
_CELLS = 2**24  # documents times terms of a shard
_PASS = 200_000  # pairs of item and term searched at a time


def counted_terms(texts: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For texts without nulls: terms of each, then (text, term of the vocabulary, occurrences), sorted by text and term."""
    texts = texts.cast(pa.string())
    whole = pa.concat_arrays([texts])  # offsets from the array's own beginning
    _, offsets, data = whole.buffers()
    folded = pa.StringArray.from_buffers(len(whole), offsets, pa.py_buffer((data or pa.py_buffer(b"")).to_pybytes().translate(_FOLD)), None, 0, whole.offset)
    cut = pc.ascii_split_whitespace(folded)
    words = cut.flatten().dictionary_encode()
    bounds = cut.offsets.to_numpy()
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    known = pc.fill_null(pc.index_in(words.dictionary, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    index = words.indices.to_numpy()
    real = pc.not_equal(words.dictionary, "").to_numpy(zero_copy_only=False)[index]  # blanks at either end leave empty words
    n = np.bincount(text[real], minlength=len(texts))
    term = known[index] if len(index) else np.zeros(0, np.int64)
    keys, tf = np.unique(text[term >= 0] * max(1, len(vocabulary)) + term[term >= 0], return_counts=True)
    return n, keys // max(1, len(vocabulary)), keys % max(1, len(vocabulary)), tf


def forward(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Documents with at least one term: doc_id, n (terms), and the asked-for terms' numbers and occurrences as int32 bytes."""
    held = docs.sparkSession.sparkContext.broadcast(terms)  # at most _PASS of them, or one item's
    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string("n long, terms binary, tfs binary").fields])

    def vectors(batches):
        vocabulary = pa.array(held.value, pa.string())
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            for lo, hi in array_slices(texts):
                n, doc, term, tf = counted_terms(texts[lo:hi], vocabulary)
                at = np.searchsorted(doc, np.arange(len(n) + 1))
                term, tf = term.astype(np.int32), tf.astype(np.int32)
                rows = np.flatnonzero(n)
                lists = [pa.array([v[at[i] : at[i + 1]].tobytes() for i in rows], pa.binary()) for v in (term, tf)]
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi].take(pa.array(rows)), pa.array(n[rows]), *lists], schema.names)

    return docs.select("doc_id", "text").mapInArrow(vectors, schema)


def document_frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """Documents that hold each term: one row a term from each task, summed."""

    def partial(batches):
        df = np.zeros(size, np.int64)
        for b in batches:
            for x in b.column(0).to_pylist():
                df[np.frombuffer(x, np.int32)] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["term", "df"])

    out = np.zeros(size, np.int64)
    for r in vectors.select("terms").mapInArrow(partial, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


class Items:
    """A pass of items: the terms of each with their numbers in it, and for every term the coordinates of its summaries."""

    def __init__(self, ids: list, terms: list[np.ndarray], repeats: list[np.ndarray], weights: np.ndarray):
        self.ids, self.terms, self.weights = ids, terms, weights
        self.worth = [weights[t] * r for t, r in zip(terms, repeats)]
        asked: dict[int, list[int]] = {}
        for i, t in enumerate(terms):
            for x in t.tolist():
                asked.setdefault(x, []).append(i)
        self.coordinates = {x: np.unique(np.concatenate([terms[i] for i in of])) for x, of in asked.items()}


class Best:
    """The k best documents met for an item, equal scores by ascending id, a null id last."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    @property
    def bar(self) -> int:
        """A score below this is of no use."""
        return max(1, self.rows[-1][0]) if len(self.rows) == self.k else 1

    def add(self, scores: np.ndarray, ids: list) -> None:
        self.rows = sorted([*self.rows, *zip(scores.tolist(), ids)], key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))[: self.k]


class Shard:
    """The index of some documents: dense values, posting lists, and blocks of a list when the first item comes to it."""

    def __init__(self, ids: pa.Array, values: np.ndarray, postings: tuple[np.ndarray, np.ndarray], items: Items):
        self.ids, self.values, self.items = ids, values, items
        doc, term = postings
        order = np.argsort(term, kind="stable")
        self.docs, self.at = doc[order], np.searchsorted(term[order], np.arange(values.shape[1] + 1))
        self.most = values.max(0).astype(np.int64)
        signs = np.random.default_rng(0).choice(np.float32([-1, 1]), (values.shape[1], _SKETCH)) * items.weights[:, None].astype(np.float32)
        sketch = values.astype(np.float32) @ signs
        self.sketch = sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-9)
        self.blocked: dict[int, tuple] = {}

    def blocks(self, term: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The list of a term: documents in order of their blocks, bounds of the blocks, summaries."""
        if term not in self.blocked:
            docs = self.docs[self.at[term] : self.at[term + 1]]
            starts = np.zeros(1, np.int64)
            if len(docs) > _BLOCK:
                near = self.sketch[docs]
                block = (near @ near[:: _BLOCK].T).argmax(1)  # every so many-th document of the list is a pivot
                order = np.argsort(block, kind="stable")
                docs, block = docs[order], block[order]
                starts = np.flatnonzero(np.diff(block, prepend=-1))
            summary = np.maximum.reduceat(self.values[docs[:, None], self.items.coordinates[term]], starts, axis=0)
            self.blocked[term] = docs, np.append(starts, len(docs)), summary
        return self.blocked[term]

    def search(self, item: int, best: Best) -> None:
        terms, worth = self.items.terms[item], self.items.worth[item]
        share = worth * self.most[terms]
        order = np.argsort(-share, kind="stable")
        left = np.cumsum(share[order][::-1])[::-1]  # what this list and all after it can give
        seen = np.zeros(len(self.values), bool)
        for i, t in enumerate(terms[order].tolist()):
            if left[i] < best.bar:
                return  # and so are all lists after it
            docs, bounds, summary = self.blocks(t)
            reach = summary[:, np.searchsorted(self.items.coordinates[t], terms)].astype(np.int64) @ worth
            ahead = np.argsort(-reach, kind="stable")
            done, step = 0, 1
            while done < len(ahead) and reach[ahead[done]] >= best.bar:
                some = ahead[done : done + step]
                some = some[reach[some] >= best.bar]
                met = np.concatenate([docs[bounds[x] : bounds[x + 1]] for x in some.tolist()])
                met = met[~seen[met]]
                seen[met] = True
                scores = self.values[met[:, None], terms].astype(np.int64) @ worth
                good = scores >= best.bar
                if good.any():
                    good = np.flatnonzero(good)
                    best.add(scores[good], self.ids.take(pa.array(met[good])).to_pylist())
                done, step = done + step, step * 2


def _search(vectors: DataFrame, items: Items, documents: int, length: int, k: int, item_field: T.StructField) -> DataFrame:
    """The k best documents of each task for every item: item_id, doc_id, score."""
    held = vectors.sparkSession.sparkContext.broadcast(items)
    schema = T.StructType([item_field, vectors.schema["doc_id"], T.StructField("score", T.LongType())])
    size = len(items.weights)
    most = max(1, min(4096, _CELLS // size))

    def shards(batches):
        for b in batches:
            for lo in range(0, b.num_rows, most):
                yield b.slice(lo, most)

    def found(batches):
        asked = held.value
        best = [Best(k) for _ in asked.ids]
        for b in shards(batches):
            terms = [np.frombuffer(x, np.int32) for x in b.column(2).to_pylist()]
            tf = np.concatenate([np.frombuffer(x, np.int32) for x in b.column(3).to_pylist()]).astype(np.int64)
            doc = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
            term = np.concatenate(terms)
            m = 25 + 75 * b.column(1).to_numpy() * documents // length
            values = np.zeros((b.num_rows, size), np.int32)
            values[doc, term] = 1_000_000_000 * tf // (1000 * tf + 8 * m[doc])  # below 1,000,000
            shard = Shard(b.column(0), values, (doc, term), asked)
            for i, x in enumerate(best):
                shard.search(i, x)
        rows = [(asked.ids[i], d, s) for i, x in enumerate(best) for s, d in x.rows]
        if rows:
            columns = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema.names)

    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in schema.fields]
    return vectors.mapInArrow(found, schema)


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k documents of docs (doc_id, text) with the highest scores above 0 for each item (item_id, text).

    Rows: item_id, rank from 1, doc_id, score; equal scores by ascending doc_id, a null one last.  Terms are maximal runs of
    letters, digits and anything beyond ASCII, A-Z lower-cased.  Null and empty texts have none: such a document counts
    nowhere, and such an item has no rows.  Every row of docs is a document of its own, though rows repeat; rows of one
    item_id are one item.  Other columns are not read.  Items are searched in passes of bounded size, each over all documents."""
    spark = docs.sparkSession
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))
    asked = stored(items.select("item_id", F.explode(words).alias("term")).groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times")), "asked")
    passes = -(-asked.count() // _PASS)
    out = spark.createDataFrame([], T.StructType([items.schema["item_id"], *T._parse_datatype_string("rank int").fields, docs.schema["doc_id"], T.StructField("score", T.LongType())]))
    for p in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == p).collect()
        terms = sorted({r["term"] for r in rows})
        if not terms:
            continue
        at = {t: i for i, t in enumerate(terms)}
        vectors = stored(forward(docs, terms), "vectors")
        total = vectors.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
        if not total["documents"]:
            continue
        df = document_frequencies(vectors, len(terms))
        weights = np.array([math.floor(1000 * math.log((2 * total["documents"] + 2) / (2 * int(x) + 1))) for x in df], np.int64)
        own: dict = {}
        for r in rows:
            own.setdefault(r["item_id"], []).append((at[r["term"]], r["times"]))
        pairs = [sorted(x) for x in own.values()]
        group = Items(list(own), [np.array([t for t, _ in x]) for x in pairs], [np.array([n for _, n in x]) for x in pairs], weights)
        best = _search(vectors, group, total["documents"], total["length"], k, items.schema["item_id"])
        by = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        out = out.unionByName(best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score"))
    return out
