"""Language identification by nearest centroid over TF-IDF character n-grams.

Every language has several centroids, clustered by spherical k-means, so that one language may have several manners
(plain prose, headings, capitals).  A text goes to the language of the centroid of greatest cosine; a text farther
from all centroids than its language's training texts ever were is rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import array_slices, give_back, release, slices

BUCKETS = 4096
_K = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
UNKNOWN = "und"


def grams(texts: list[str]) -> np.ndarray:
    """Counts of hashed character 1- to 3-grams of lower-cased texts, all that is no letter being one blank."""
    chars = np.frombuffer(("\n".join(t.replace("\n", " ") for t in texts).lower() + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.diff(np.concatenate([[-1], np.flatnonzero(chars == 10)]))
    doc = np.repeat(np.arange(len(texts), dtype=np.int64), lengths)
    letter = ((chars >= 97) & (chars <= 122)) | ((chars >= 0xAA) & (chars != 0xD7) & (chars != 0xF7) & ~((chars >= 0x2000) & (chars < 0x2C00)) & ~((chars >= 0x3000) & (chars < 0x3040)))
    c = np.where(letter, chars, np.uint32(32))
    use = letter | np.concatenate([[False], letter[:-1]])  # runs of other characters are one blank
    c, doc = c[use], doc[use]
    out = np.zeros(len(texts) * BUCKETS, np.int64)
    h = np.zeros(len(c), np.uint32)
    for n in range(1, 4):
        h = (h[:-1] if n > 1 else h) * _K[0] + c[n - 1 :] * _K[1]
        mixed = h ^ (h >> np.uint32(15))
        bucket = ((mixed * _K[2]) >> np.uint32(20)).astype(np.int64)
        same = doc[: len(h)] == doc[n - 1 :]
        out += np.bincount((doc[: len(h)] * BUCKETS + bucket)[same], minlength=len(out))
    return out.reshape(len(texts), BUCKETS)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Length-one TF-IDF rows (zero rows stay zero)."""
    v = np.log1p(counts.astype(np.float32)) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return v / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    idf: np.ndarray
    reject_below: np.ndarray  # of each centroid's language

    def predict(self, texts: list[str | None]):
        """(language, score, rejected) for each text; a text without a letter is `und` with score 0."""
        if not self.languages:
            return [(UNKNOWN, 0.0, True)] * len(texts)
        sound = [t if t and any(map(str.isalpha, t)) else "" for t in texts]
        out = []
        for lo, hi in slices(sound, 150_000):
            for a in range(lo, hi, 128):
                some = sound[a : min(a + 128, hi)]
                cos = vectors(grams(some), self.idf) @ self.centroids.T
                best = cos.argmax(1)
                top = cos[np.arange(len(some)), best]
                for t, k, x in zip(some, best, top):
                    score = min(1.0, max(0.0, float(x)))
                    out.append((self.languages[k], score, bool(x < self.reject_below[k])) if t else (UNKNOWN, 0.0, True))
        return out


def cluster(v: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means with a farthest-first start: length-one centroids, at most k."""
    picked = [int((v @ v.mean(0)).argmax())]
    while len(picked) < min(k, len(v)):
        picked.append(int((v @ v[picked].T).max(1).argmin()))
    centres = v[picked]
    for _ in range(rounds):
        own = (v @ centres.T).argmax(1)
        sums = np.stack([v[own == j].sum(0) if (own == j).any() else centres[j] for j in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centres


def train(docs: DataFrame, per_language: int = 400, clusters: int = 4, slack: float = 0.25) -> Model:
    """Fit on at most per_language labelled texts of each language, chosen by a hash of their ids.

    Rows with a null language or a text without letters teach nothing.  The sample is the one bounded part of the
    operator; its texts are whole.  slack: a text is rejected below this part of its language's least training cosine
    (the least 1 % aside)."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}")).select("lang", "text", F.xxhash64(F.lit("train"), "doc_id").alias("key"))
    totals = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not totals:
        return Model([], np.zeros((0, BUCKETS), np.float32), np.ones(BUCKETS, np.float32), np.zeros(0))
    # a hash below a language's share of the key range takes about twice the bound, of which the least keys stay
    share = F.create_map(*[x for k, n in totals.items() for x in (F.lit(k), F.lit(min(1.0, 2 * per_language / n)))])
    near = rows.where((F.col("key").cast("double") / 2.0**64 + 0.5) <= F.element_at(share, F.col("lang")))

    def counted(batches):
        release()
        for b in batches:
            for lo, hi in array_slices(b.column(1), 100_000):
                c = grams(b.column(1)[lo:hi].to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], b.column(2)[lo:hi], pa.array([x.astype(np.uint32).tobytes() for x in c], pa.binary())], ["lang", "key", "counts"])

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        some = pdf.nsmallest(per_language, "key")
        c = np.stack([np.frombuffer(x, np.uint32) for x in some["counts"]])
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]], "n": [len(c)], "df": [(c > 0).sum(0).astype(np.int64).tobytes()]})

    grammed = near.mapInArrow(counted, "lang string, key long, counts binary")
    from .common import stored

    grammed = stored(grammed, "grams")
    df = grammed.groupBy("lang").applyInPandas(summed, "lang string, n long, df binary").collect()  # a row a language
    n = sum(r["n"] for r in df)
    idf = np.log((1 + n) / (1 + sum(np.frombuffer(r["df"], np.int64) for r in df))).astype(np.float32) + np.float32(0.1) if df else np.ones(BUCKETS, np.float32)

    def centred(pdf: pd.DataFrame) -> pd.DataFrame:
        some = pdf.nsmallest(per_language, "key")
        v = vectors(np.stack([np.frombuffer(x, np.uint32) for x in some["counts"]]), idf)
        centres = cluster(v, clusters)
        least = float(np.quantile((v @ centres.T).max(1), 0.01)) * slack
        return pd.DataFrame({"lang": [pdf["lang"].iloc[0]] * len(centres), "least": [least] * len(centres), "centre": [x.astype(np.float32).tobytes() for x in centres]})

    found = grammed.groupBy("lang").applyInPandas(centred, "lang string, least double, centre binary").collect()
    found.sort(key=lambda r: (r["lang"], r["centre"]))
    centres = np.stack([np.frombuffer(r["centre"], np.float32) for r in found]) if found else np.zeros((0, BUCKETS), np.float32)
    return Model([r["lang"] for r in found], centres, idf, np.array([r["least"] for r in found]))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of docs with lang_pred, lang_score and lang_rejected after them.

    A null text, or one without a letter, is `und` with score 0 and rejected; so is every text if the model learned no
    language.  Equal cosines go to the language first in code-point order.  Repeated rows are treated alike; an empty
    table gives no rows; clashing columns are replaced."""
    own = [c for c in docs.columns if c not in ("lang_pred", "lang_score", "lang_rejected")]
    held = docs.sparkSession.sparkContext.broadcast(model)  # clusters * languages vectors of BUCKETS numbers

    @F.arrow_udf("struct<lang:string,score:double,rejected:boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        release()
        rows = [r for lo, hi in array_slices(texts) for r in held.value.predict(texts[lo:hi].to_pylist())]
        columns = zip(*rows) if rows else ([], [], [])
        give_back()
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.bool_()))], ["lang", "score", "rejected"])

    p = docs.select(*own, predict("text").alias("__p"))
    return p.select(*own, F.col("__p.lang").alias("lang_pred"), F.col("__p.score").alias("lang_score"), F.col("__p.rejected").alias("lang_rejected"))
