"""Toxicity of texts by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word is two inputs side by side: an embedding of the word, if the fit met it often enough, and the mean of embeddings of
its hashed characters (trigrams, beginnings and ends), which unseen words have too.  Two gated recurrent layers
read a window of words from either end, attention weighs their states, and a linear unit scores the window.  Every text is
cut into overlapping windows, all of them are scored, and the text's score is that of its worst window; the fit therefore
learns a toxic text from its worst window and a clean one from its worst and one more.

Only the fit is bounded: at most `per_class` labelled texts of each label, none longer than `fit_chars`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .tokens import array_slices, release

WINDOW, STRIDE = 32, 16
UNITS, WORD, CHAR, ATTEND = 8, 8, 8, 8  # states a direction, parts of an input, attention's inner size
_BITS = 13  # hashed character embeddings
_K = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_STILL = 50.0  # an update gate so wide open that padding leaves the state as it is


def bare(word: str) -> str:
    """A word in lower case without what is no letter or digit at its ends; empty if nothing is left."""
    w = word.lower()
    a, b = 0, len(w)
    while a < b and not w[a].isalnum():
        a += 1
    while b > a and not w[b - 1].isalnum():
        b -= 1
    return w[a:b]


def characters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash bucket, word) of every trigram of these words, and of their first 3 to 6 and last 3 to 5 letters."""
    chars = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    start = np.cumsum(length) - length
    own = np.repeat(np.arange(len(words)), length)
    three = np.flatnonzero(own[:-2] == own[2:]) if len(chars) > 2 else np.zeros(0, np.int64)
    hashes, owner = [chars[three] * _K[0] + chars[three + 1] * _K[1] + chars[three + 2] * _K[2]], [own[three]]
    for first, step, upto in ((start, 1, 7), (start + length - 1, -1, 6)):
        h = np.zeros(len(words), np.uint32)
        for k in range(upto):
            some = np.flatnonzero(length > k)
            h[some] = (h[some] ^ chars[first[some] + step * k]) * _K[0] + _K[(step + 1) // 2]
            if k > 2:
                hashes.append(h[some])
                owner.append(some)
    h = np.concatenate(hashes)
    return (((h ^ (h >> np.uint32(15))) * _K[2]) >> np.uint32(32 - _BITS)).astype(np.int64), np.concatenate(owner)


def cut_words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts without nulls: (distinct words, number of each word in turn, bounds of the texts' words); words without a letter or digit are left out."""
    cut = pc.ascii_split_whitespace(texts)
    words = cut.flatten().dictionary_encode()
    raw = words.dictionary.to_pylist()
    distinct: dict[str, int] = {}
    number = np.array([distinct.setdefault(w, len(distinct)) if (w := bare(x)) else -1 for x in raw], np.int64)
    index = number[words.indices.to_numpy()] if raw else np.zeros(0, np.int64)
    bounds = cut.offsets.to_numpy().astype(np.int64)
    upto = np.concatenate([[0], np.cumsum(index >= 0)])
    return list(distinct), index[index >= 0], upto[bounds - bounds[0]]


def windows(index: np.ndarray, bounds: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """(words of every window, a row each, with pad after a text's end; first window of each text): a text without words has one."""
    n = np.diff(bounds)
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    first = np.cumsum(count) - count
    text = np.repeat(np.arange(len(n)), count)
    at = bounds[text] + STRIDE * (np.arange(len(text)) - first[text])
    places = at[:, None] + np.arange(WINDOW)
    inside = places < bounds[text + 1][:, None]
    return np.append(index, pad).astype(np.int32)[np.where(inside, places, len(index))], first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def _read(gates: np.ndarray, u: np.ndarray, kept: list | None) -> np.ndarray:
    """States of one layer along the first axis; kept takes what its gradient needs."""
    n = UNITS
    h = np.zeros((gates.shape[1], n), np.float32)
    out = np.empty((*gates.shape[:2], n), np.float32)
    for t in range(len(gates)):
        a = h @ u
        zr = _sigmoid(gates[t, :, : 2 * n] + a[:, : 2 * n])
        z, r = zr[:, :n], zr[:, n:]
        c = np.tanh(gates[t, :, 2 * n :] + r * a[:, 2 * n :])
        if kept is not None:
            kept.append((h, z, r, c, a[:, 2 * n :]))
        h = c + z * (h - c)
        out[t] = h
    return out


def _unread(d: np.ndarray, u: np.ndarray, kept: list) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of _read: of its gates, and of u."""
    du, carry = np.zeros_like(u), np.zeros_like(d[0])
    dgates = np.empty((*d.shape[:2], 3 * UNITS), np.float32)
    for t in range(len(d) - 1, -1, -1):
        h, z, r, c, a = kept[t]
        dh = d[t] + carry
        dc = dh * (1 - z) * (1 - c * c)
        dz, dr = dh * (h - c) * z * (1 - z), dc * a * r * (1 - r)
        dgates[t] = np.concatenate([dz, dr, dc], 1)
        da = np.concatenate([dz, dr, dc * r], 1)
        du += h.T @ da
        carry = dh * z + da @ u.T
    return dgates, du


@dataclass
class Network:
    """Parameters, and the words that have an embedding of their own (number 0 is every other word)."""

    words: dict[str, int] = field(default_factory=dict)
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def start(cls, words: dict[str, int], word_odds: np.ndarray, char_odds: np.ndarray, seed: int = 11) -> Network:
        """Small random parameters; the first part of each embedding says how much likelier toxic texts hold it."""
        g = np.random.default_rng(seed)
        normal = lambda *s: (g.normal(size=s) / np.sqrt(s[0])).astype(np.float32)
        p = {"word": 0.1 * normal(len(words) + 1, WORD) * np.sqrt(len(words) + 1), "char": 0.1 * normal(2**_BITS, CHAR) * np.sqrt(2**_BITS)}
        p["word"][:, 0], p["char"][:, 0] = word_odds, char_odds
        p |= {"in": normal(WORD + CHAR, 6 * UNITS), "in_bias": np.zeros(6 * UNITS, np.float32)}
        p |= {"ahead": normal(UNITS, 3 * UNITS), "back": normal(UNITS, 3 * UNITS)}
        p |= {"attend": normal(2 * UNITS, ATTEND), "attend_bias": np.zeros(ATTEND, np.float32), "weigh": normal(ATTEND)}
        p |= {"out": normal(2 * UNITS), "bias": np.zeros(1, np.float32)}
        return cls(words, {k: v.astype(np.float32) for k, v in p.items()})

    def inputs(self, words: list[str], known: np.ndarray | None = None) -> tuple[np.ndarray, tuple]:
        """Both parts of each word, and (numbers of the words, character buckets, their words, 1 / their count)."""
        if known is None:
            known = np.fromiter((self.words.get(w, 0) for w in words), np.int64, len(words))
        bucket, owner = characters(words)
        share = (1 / np.maximum(1, np.bincount(owner, minlength=len(words)))).astype(np.float32)
        char = np.stack([np.bincount(owner, weights=self.p["char"][bucket, i], minlength=len(words)) for i in range(CHAR)], 1).astype(np.float32)
        return np.concatenate([self.p["word"][known], char * share[:, None]], 1), (known, bucket, owner, share)

    def table(self, x: np.ndarray) -> np.ndarray:
        """What each word adds to all gates of both layers; the last row is padding."""
        still = np.zeros((1, 6 * UNITS), np.float32)
        still[0, :UNITS] = still[0, 3 * UNITS : 4 * UNITS] = _STILL
        return np.concatenate([x @ self.p["in"] + self.p["in_bias"], still])

    def forward(self, table: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Score of each window before the sigmoid; with keep, also what the gradient needs."""
        p, ahead, back = self.p, [] if keep else None, [] if keep else None
        turn = ids.T
        gates = table[turn]
        h = np.concatenate([_read(gates[:, :, : 3 * UNITS], p["ahead"], ahead), _read(gates[::-1, :, 3 * UNITS :], p["back"], back)[::-1]], 2)
        inner = np.tanh(h @ p["attend"] + p["attend_bias"])
        weight = inner @ p["weigh"] - np.float32(1e4) * (turn == len(table) - 1)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = (weight[:, :, None] * h).sum(0)
        score = pooled @ p["out"] + p["bias"][0]
        return (score, (ahead, back, h, inner, weight, pooled)) if keep else score

    def gradient(self, words: list[str], ids: np.ndarray, label: np.ndarray, weight: np.ndarray, known: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted logarithmic loss over windows of these words."""
        p = self.p
        x, (known, bucket, owner, share) = self.inputs(words, known)
        table = self.table(x)
        score, (ahead, back, h, inner, a, pooled) = self.forward(table, ids, keep=True)
        d = ((_sigmoid(score) - label) * weight / weight.sum()).astype(np.float32)
        g = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
        dpooled = d[:, None] * p["out"]
        da = (h * dpooled).sum(2)
        dw = a * (da - (a * da).sum(0))
        dinner = dw[:, :, None] * p["weigh"] * (1 - inner * inner)
        g |= {"weigh": (dw[:, :, None] * inner).sum((0, 1)), "attend": np.tensordot(h, dinner, ([0, 1], [0, 1])), "attend_bias": dinner.sum((0, 1))}
        dh = a[:, :, None] * dpooled + dinner @ p["attend"].T
        one, g["ahead"] = _unread(dh[:, :, :UNITS], p["ahead"], ahead)
        two, g["back"] = _unread(dh[::-1, :, UNITS:], p["back"], back)
        flat = np.concatenate([one, two[::-1]], 2).reshape(-1, 6 * UNITS)
        dtable = np.zeros_like(table)
        np.add.at(dtable, ids.T.ravel(), flat)
        dtable = dtable[:-1]  # padding has no parameters
        g |= {"in": x.T @ dtable, "in_bias": dtable.sum(0)}
        dx = dtable @ p["in"].T
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], known, dx[:, :WORD])
        np.add.at(g["char"], bucket, (dx[:, WORD:] * share[:, None])[owner])
        return g

    def worst(self, texts: pa.Array, most: int = 2048) -> np.ndarray:
        """Score before the sigmoid of the worst window of each text; all windows of all texts are scored."""
        words, index, bounds = cut_words(pc.fill_null(texts, ""))
        table = self.table(self.inputs(words)[0])
        ids, first = windows(index, bounds, len(words))
        score = np.concatenate([self.forward(table, ids[lo : lo + most]) for lo in range(0, len(ids), most)]) if len(ids) else np.zeros(0)
        return np.maximum.reduceat(score, first) if len(first) else score


def _odds(toxic: np.ndarray, clean: np.ndarray, few: float) -> np.ndarray:
    """Logarithm of how much likelier toxic text holds a feature, drawn to 0 where it is seldom seen."""
    both = (toxic + clean) / max(1.0, toxic.sum() + clean.sum())
    rate = lambda n: (n + few * both * 100) / max(1.0, n.sum() + few * 100)
    return np.clip(np.log(np.maximum(rate(toxic), 1e-12) / np.maximum(rate(clean), 1e-12)), -3, 3)


def train(texts: list[str], labels: list[int], toxic_share: float, epochs: int = 12, batch: int = 256, rate: float = 0.02, seed: int = 11) -> Network:
    """A network of labelled texts; a fifth of them sets the bar between the labels for texts with this share of toxic ones."""
    label = np.array(labels, np.float32)
    if not 0 < label.sum() < len(label):
        return Network()
    g = np.random.default_rng(seed)
    words, index, bounds = cut_words(pa.array(texts, pa.string()))
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    learns = np.ones(len(texts), bool)
    learns[g.permutation(len(texts))[: len(texts) // 5]] = False
    # a word of three texts or more has an embedding of its own
    held = np.unique(index * len(texts) + text)
    held_word, held_text = held // len(texts), held % len(texts)
    use = learns[held_text]
    toxic, clean = (np.bincount(held_word[use & (label[held_text] == x)], minlength=len(words)).astype(float) for x in (1, 0))
    own = np.flatnonzero(toxic + clean >= 3)
    known = np.zeros(len(words), np.int64)
    known[own] = np.arange(1, len(own) + 1)
    bucket, owner = characters(words)
    char = []
    for x in (1, 0):
        tokens = np.bincount(index[learns[text] & (label[text] == x)], minlength=len(words)).astype(float)
        char.append(np.bincount(bucket, weights=tokens[owner], minlength=2**_BITS))
    # rates of words by text: each label's texts weigh the same
    net = Network.start({words[i]: k for k, i in enumerate(own, 1)}, np.append(0, _odds(toxic[own] / max(1, label[learns].sum()) * 1000, clean[own] / max(1, (1 - label[learns]).sum()) * 1000, 10)), _odds(char[0], char[1], 10), seed)
    ids, first = windows(index, bounds, len(words))
    last = np.append(first[1:], len(ids))
    of = np.repeat(np.arange(len(texts)), last - first)
    guess = np.append(net.p["word"][known, 0], 0)[ids].clip(0).sum(1)  # for the first epoch
    mean, square, step = {k: np.zeros_like(v) for k, v in net.p.items()}, {k: np.zeros_like(v) for k, v in net.p.items()}, 0
    best, best_loss = None, np.inf
    share = np.where(label == 1, toxic_share / label.mean(), (1 - toxic_share) / (1 - label.mean()))
    for _ in range(epochs):
        top = np.array([a + int(guess[a:b].argmax()) for a, b in zip(first, last)])
        other = first + (g.random(len(first)) * (last - first)).astype(np.int64)
        picked = np.concatenate([top[learns], other[learns & (label == 0)]])
        picked = g.permutation(picked)
        for lo in range(0, len(picked), batch):
            some = ids[picked[lo : lo + batch]]
            met = np.unique(some[some < len(words)])
            place = np.full(len(words) + 1, len(met))
            place[met] = np.arange(len(met))
            seen = np.where(g.random(len(met)) < 0.2, 0, known[met])  # a fifth of the words go by their characters
            y = label[of[picked[lo : lo + batch]]]
            weight = np.where(y == 1, 1.0, 0.5 * label[learns].sum() / max(1, (1 - label[learns]).sum()))
            step += 1
            for k, d in net.gradient([words[i] for i in met], place[some], y, weight, seen).items():
                d = np.clip(d, -1, 1)
                mean[k] += (d - mean[k]) * 0.1
                square[k] += (d * d - square[k]) * 0.01
                slow = 0.3 if k in ("word", "char") else 1.0
                net.p[k] -= (slow * rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        table = net.table(net.inputs(words)[0])
        guess = np.concatenate([net.forward(table, ids[lo : lo + 2048]) for lo in range(0, len(ids), 2048)])
        score = np.maximum.reduceat(guess, first)
        checked = ~learns if (~learns & (label == 1)).any() and (~learns & (label == 0)).any() else learns
        bar, loss = _bar(score[checked], label[checked], share[checked])
        if loss < best_loss:
            best, best_loss = {k: v.copy() for k, v in net.p.items()} | {"bias": net.p["bias"] - np.float32(bar)}, loss
    net.p = best
    return net


def _bar(score: np.ndarray, label: np.ndarray, share: np.ndarray) -> tuple[float, float]:
    """The bar between scores with the least weight of errors, in the middle of the widest such gap, and what is lost there.

    The loss adds a little for scores near the bar, so that of two networks without errors the surer one is better."""
    order = np.argsort(score)
    s, y, w = score[order], label[order], share[order]
    wrong = np.concatenate([[0], np.cumsum(w * (y == 1))]) + np.concatenate([np.cumsum((w * (y == 0))[::-1])[::-1], [0]])
    edges = np.concatenate([[s[0] - 2], s, [s[-1] + 2]])
    gap = np.diff(edges)
    least = np.flatnonzero(wrong <= wrong.min() + 1e-9)
    at = least[gap[least].argmax()]
    bar = float(edges[at] + edges[at + 1]) / 2
    sure = np.log1p(np.exp(-np.clip(np.where(label == 1, 1, -1) * (score - bar), -30, 30)))
    return bar, float(wrong[at] + 0.1 * (share * sure).sum())


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 2000, fit_chars: int = 20_000) -> Network:
    """Train on labelled rows: docs (doc_id, text) with labels (doc_id, toxic).

    The sample is the one bounded part of the operator: of each label the per_class texts of the least hash of their ids,
    among those of at most fit_chars code points, whole; equal texts count once.  Null labels, null and empty texts teach
    nothing; of several labels of a doc_id the largest holds.  Without texts of both labels the network scores all 0."""
    marked = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    short = docs.where((F.char_length("text") > 0) & (F.char_length("text") <= fit_chars)).withColumn("mark", F.xxhash64("text"))
    # ids and hashes are joined and chosen; texts are fetched for the chosen alone
    rows = stored(short.select("doc_id", "mark").join(marked, "doc_id").withColumn("key", F.xxhash64(F.lit("toxic"), "doc_id")), "labelled")
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}  # two labels
    picked = [rows.where(F.col("toxic") == x).orderBy("key", "doc_id", "mark").limit(per_class) for x in (0, 1)]
    chosen = stored(picked[0].unionByName(picked[1]).distinct(), "chosen")
    some = short.join(F.broadcast(chosen), ["doc_id", "mark"]).groupBy("key", "doc_id", "mark").agg(F.first("toxic").alias("toxic"), F.first("text").alias("text")).orderBy("key", "doc_id", "mark").select("text", "toxic")
    once = dict(map(tuple, some.collect()))
    return train(list(once), list(once.values()), counts.get(1, 0) / max(1, counts.get(0, 0) + counts.get(1, 0)))


def score(docs: DataFrame, network: Network) -> DataFrame:
    """All columns of docs with toxicity (0 to 1) and toxic_pred (1 from 0.5 on) after them.

    Null and empty texts, and texts without letters and digits, get the score of a window without words.  Texts of
    any length are scored whole, window by window.  Repeated rows are treated alike; an empty table gives no rows; clashing
    columns are replaced."""
    own = [c for c in docs.columns if c not in ("toxicity", "toxic_pred")]
    held = docs.sparkSession.sparkContext.broadcast(network)  # a few MB: 8 numbers for each word of the sample

    @F.arrow_udf("double")
    def worst(texts: pa.Array) -> pa.Array:
        release()
        net = held.value
        if not net.p:
            return pa.array(np.zeros(len(texts)))
        parts = [net.worst(texts[lo:hi]) for lo, hi in array_slices(texts)]
        return pa.array(1 / (1 + np.exp(-np.concatenate(parts).astype(np.float64))) if parts else np.zeros(0))

    scored = docs.select(*own, worst("text").alias("toxicity"))
    return scored.withColumn("toxic_pred", (F.col("toxicity") >= 0.5).cast("int"))
