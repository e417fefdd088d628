"""Quality by weak supervision: rules vote bad or good or abstain, EM learns how far each can be trusted.

The text measures are taken document by document.  The votes of all documents are reduced to counts of distinct vote
patterns (at most 3 to the number of rules, however large the corpus); expectation-maximisation runs on those counts,
and the posterior of each pattern goes back to its documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import array_slices

SYMBOLS = b"#*$%&|<>"
_BLANK = b" \t\n\x0b\x0c\r"
_DIGITS = b"0123456789"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ENDS = (b".", b"!", b"?", b":", b'"')

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_ended", "n_digits", "n_upper", "n_distinct", "n_bangs")


def repeated_words(words: list[bytes]) -> int:
    """How many words stand in a 3-word window that occurs twice or more in the text, first occurrences included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    k = len(number)
    if k < 2_000_000:  # three numbers fit one 63-bit key
        key = (ids[:-2] * k + ids[1:-1]) * k + ids[2:]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    else:
        _, inverse, counts = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], 1), axis=0, return_inverse=True, return_counts=True)
    twice = counts[inverse.ravel()] > 1
    inside = np.zeros(n, bool)
    for i in range(3):
        inside[i : n - 2 + i] |= twice
    return int(inside.sum())


def measure(text: str) -> tuple[int, ...]:
    """The MEASURES of a whole text, lines cut at line feeds and words at ASCII blanks."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    blanks = len(raw) - len(raw.translate(None, _BLANK))
    seen: set[bytes] = set()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    dup = 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return (
        len(words),
        len(text) - blanks,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        dup,
        repeated_words(words),
        len(lines),
        sum(x.rstrip().endswith(_ENDS) for x in lines),
        len(raw) - len(raw.translate(None, _DIGITS)),
        len(raw) - len(raw.translate(None, _UPPER)),
        len(set(words)),
        raw.count(b"!!"),
    )


def measures(docs: DataFrame) -> DataFrame:
    """doc_id and MEASURES of every row; a null text has no words."""
    schema = "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES)

    def run(batches):
        for b in batches:
            for lo, hi in array_slices(b.column(1), 2_000_000):
                columns = zip(*(measure(t or "") for t in b.column(1)[lo:hi].to_pylist()))
                yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *MEASURES])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def rules() -> dict:
    """Each rule votes 1 (good), -1 (bad) or 0 (abstains), from ratios of the measures.

    A rule that looks for one defect abstains where it finds none; only broad signs of prose vote good."""
    words, lines, chars = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "n_lines", "word_chars"))

    def bad(condition, good=None):
        vote = F.when(condition, -1)
        return (vote if good is None else vote.when(good, 1)).otherwise(0)

    symbols, ended, repeats = F.col("n_symbols") / words, F.col("n_ended") / lines, F.col("n_repeat_words") / words
    return {
        "symbols": bad(symbols >= 0.1, symbols <= 0.01),
        "symbol_chars": bad(F.col("n_symbols") / chars >= 0.03),
        "ended": bad(ended < 0.3, ended >= 0.8),
        "dup_lines": bad(F.col("n_dup_lines") / lines >= 0.3),
        "repeats": bad(repeats >= 0.3, repeats <= 0.05),
        "distinct": bad((F.col("n_words") >= 50) & (F.col("n_distinct") / words < 0.2)),
        "length": bad(F.col("n_words") < 50, F.col("n_words") >= 80),
        "word_length": bad(~(F.col("word_chars") / words).between(2.5, 14.0)),
        "digits": bad(F.col("n_digits") / chars >= 0.2),
        "upper": bad(F.col("n_upper") / chars >= 0.3),
        "bangs": bad(F.col("n_bangs") / words >= 0.1),
    }


def _em(hot: np.ndarray, counts: np.ndarray, p: np.ndarray, prior: float, rounds: int) -> tuple:
    """EM from memberships p: (objective, log likelihood, shares, rates[class, rule, vote + 1], memberships)."""
    flat, k = hot.reshape(len(counts), -1), p.shape[1]
    mean = (counts @ flat).reshape(1, -1, 3) / counts.sum()
    before = -np.inf
    for _ in range(rounds):
        share = (counts @ p + 1) / (counts.sum() + k)
        rates = ((counts[:, None] * p).T @ flat).reshape(k, -1, 3) + prior * mean + 1e-9
        rates /= rates.sum(2, keepdims=True)
        log = np.log(share) + flat @ np.log(rates).reshape(k, -1).T
        top = log.max(1)
        total = top + np.log(np.exp(log - top[:, None]).sum(1))
        likelihood = counts @ total
        objective = likelihood + prior * (mean * np.log(rates)).sum() + np.log(share).sum()
        p = np.exp(log - total[:, None])
        if abs(objective - before) < 1e-6:
            break
        before = objective
    return objective, likelihood, share, rates, p


def fit(patterns: np.ndarray, counts: np.ndarray, starts: int = 8, prior: float = 1.0, rounds: int = 500, agree: int = 2, seed: int = 0):
    """EM over vote patterns: (share of each class, rates[class, rule, vote + 1], posterior of a good class, bad).

    Documents are a mixture of classes in which the rules vote, or abstain, independently.  All rates and shares are
    learned, without bounds; the prior is worth `prior` pseudo-documents at the rates of the whole corpus.  Each number of
    classes, up to one more than there are rules, is fitted from `starts` seeded starts of which the likeliest stays, until two
    more classes do not better the Bayesian information criterion.  What a class is follows from what was learned: it is bad
    where `agree` rules at least vote bad on more than half of it each, as a lone alarm that no other rule shares is no
    proof.  Good classes stand first, larger ones before smaller.  The work follows the number of distinct patterns; their order does not matter."""
    votes, counts = np.asarray(patterns, int), np.asarray(counts, float)
    n_rules = votes.shape[1]
    if not len(counts):
        return np.ones(1), np.full((1, n_rules, 3), 1 / 3), np.zeros(0), np.zeros(1, bool)
    back = np.lexsort(votes.T)
    votes, counts = votes[back], counts[back]
    hot = np.stack([votes == v for v in (-1, 0, 1)], 2).astype(float)
    free = ((np.einsum("i,irv->rv", counts, hot) > 0).sum(1) - 1).sum()
    rng = np.random.default_rng(seed)
    best, stale = None, 0
    for k in range(1, n_rules + 2):
        tops = []
        for _ in range(starts if k > 1 else 1):
            # around the commonest pattern and others far from those chosen, by weight
            chosen = [int(counts.argmax())]
            while len(chosen) < k:
                weight = counts * np.min([(votes != votes[c]).sum(1) for c in chosen], 0) ** 2
                if not weight.sum():
                    break
                chosen.append(int(rng.choice(len(counts), p=weight / weight.sum())))
            p = np.exp(-1.5 * np.stack([(votes != votes[c]).sum(1) for c in chosen], 1))
            tops.append(_em(hot, counts, p / p.sum(1, keepdims=True), prior, rounds))
        top = max(tops, key=lambda t: t[0])
        bic = (len(top[2]) - 1 + len(top[2]) * free) * np.log(counts.sum()) - 2 * top[1]
        stale = 0 if best is None or bic < best[0] else stale + 1
        if not stale:
            best = bic, top
        if stale == 2:
            break
    _, _, share, rates, p = best[1]
    bad = (rates[:, :, 0] > 0.5).sum(1) >= agree
    order = np.lexsort((-share, bad))
    good = np.empty(len(counts))
    good[back] = p[:, ~bad].sum(1)
    return share[order], rates[order], good, bad[order]


def judge(measured: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Adds base_failed, quality (posterior of being good) and kept to measured documents."""
    named = rules()
    voted = measured.withColumns({f"__v_{k}": v.cast("int") for k, v in named.items()})
    keys = [f"__v_{k}" for k in named]
    table = voted.groupBy(*keys).count().collect()  # at most 3 ** len(rules) patterns
    patterns = np.array([[r[k] for k in keys] for r in table], int).reshape(-1, len(keys))
    _, _, p, _ = fit(patterns, np.array([r["count"] for r in table]))
    code = sum(((F.col(k) + 1) * 3**i for i, k in enumerate(keys)), F.lit(0)).cast("int")
    spark = measured.sparkSession
    weights = 3 ** np.arange(len(keys))
    rows = [(int(c), float(q)) for c, q in zip((patterns + 1) @ weights, p)]
    scores = spark.createDataFrame(rows, "__code int, quality double")
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = voted.withColumn("__code", code).join(F.broadcast(scores), "__code", "left").drop("__code", *keys)
    return out.withColumn("base_failed", base_failed).withColumn("kept", ~F.col("base_failed") & (F.coalesce("quality", F.lit(0.0)) >= threshold))


def quality(docs: DataFrame, threshold: float = 0.5, store=None) -> DataFrame:
    """doc_id, MEASURES, base_failed, quality, kept for every row of docs.

    A null or empty text has no words and fails; a null doc_id stays null; repeated rows are judged each; an empty
    table gives no rows; other columns are not read.  Measures are written once and read for the vote counts and again
    for the verdicts; the fit sees the vote counts of all documents."""
    from .common import stored

    return judge((store or stored)(measures(docs)), threshold)
