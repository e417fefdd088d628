"""Chat transcripts to canonical turns: a hidden Markov model over lines recovers who speaks.

States are a role with a place (first line of a turn, or a later one).  A line shows its speaker marker, whether a
record starts with it, its length and how it ends.  The model is counted from labelled turns; Viterbi finds the roles.
Long conversations are cut into segments: each segment is reduced to its best score between every two states (a
max-plus product, which is associative), the segments are joined, and each is then decoded between its known ends, so
no task holds a whole conversation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored
from .near import runs

#: Words that name a speaker before a colon, and the role they stand for.
MARKERS = {
    "system": "system", "instruction": "system", "instructions": "system",
    "user": "user", "human": "user", "question": "user", "q": "user", "customer": "user", "prompter": "user",
    "assistant": "assistant", "ai": "assistant", "bot": "assistant", "answer": "assistant", "a": "assistant", "model": "assistant", "agent": "assistant", "gpt": "assistant",
    "tool": "tool", "function": "tool",
}
_MARK = re.compile(r"^\s*(?:[#*>\-\[<|]+\s*)?([A-Za-z]{1,12})(?:\s*[*|>\]]+)?\s*(?::|\|>)\s?")
LENGTHS = 12


def marker(line: str) -> tuple[str, int]:
    """(role named by a speaker marker or "", characters of the marker)."""
    m = _MARK.match(line)
    role = MARKERS.get(m[1].lower(), "") if m else ""
    return role, m.end() if role else 0


def features(text: str | None) -> list[tuple[str, int, int, int]]:
    """For each line: marked role, starts a record, length class, ends as a question."""
    out = []
    for i, line in enumerate((text or "").split("\n")):
        out.append((marker(line)[0], int(i == 0), min(LENGTHS - 1, len(line).bit_length()), int(line.rstrip().endswith("?"))))
    return out


@dataclass
class Hmm:
    """Log probabilities; state 2 * i is the first line of a turn of roles[i], 2 * i + 1 a later one."""

    roles: list[str]
    start: np.ndarray
    move: np.ndarray
    mark: dict[str, np.ndarray]
    first: np.ndarray
    length: np.ndarray
    question: np.ndarray

    def emit(self, text: str | None) -> np.ndarray:
        rows = features(text)
        none = self.mark[""]
        # a marked line may begin a turn anywhere in a record
        return np.stack([(self.mark.get(m, none) if m else none + self.first[f]) + self.length[n] + self.question[q] for m, f, n, q in rows])


def fit(turns: DataFrame, smooth: float = 0.5) -> Hmm:
    """Count the model from conv_id, turn, role, text rows with a role, all of them; only counts reach the driver."""
    known = turns.where(F.col("role").isNotNull())
    roles = sorted(r["role"] for r in known.select("role").distinct().collect())
    at = {r: i for i, r in enumerate(roles)}
    n = len(roles)

    def count(batches):
        for b in batches:
            tally: dict = {}
            for role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for i, f in enumerate(features(text)):
                    key = (2 * at[role] + (i > 0), *f)
                    tally[key] = tally.get(key, 0) + 1
            if tally:
                keys = list(zip(*tally))
                yield pa.RecordBatch.from_arrays([pa.array(keys[0], pa.int32()), pa.array(keys[1]), *(pa.array(k, pa.int32()) for k in keys[2:]), pa.array(list(tally.values()), pa.int64())], ["state", "mark", "first", "length", "question", "n"])

    lines = known.select("role", "text").mapInArrow(count, "state int, mark string, first int, length int, question int, n long")
    table = lines.groupBy("state", "mark", "first", "length", "question").agg(F.sum("n").alias("n")).collect()
    marks = ["", *sorted(set(MARKERS.values()) | set(roles))]
    mark, first, length, question = (np.full((k, 2 * n), smooth) for k in (len(marks), 2, LENGTHS, 2))
    mark *= 0.002  # a marker of another role is next to impossible, however rare the role
    inner = np.full(2 * n, smooth)
    for r in table:
        s, c = r["state"], r["n"]
        mark[marks.index(r["mark"]), s] += c
        first[r["first"], s] += c
        length[r["length"], s] += c
        question[r["question"], s] += c
        inner[s] += c
    # markers count as a fifth of their role's turns at least, so a model of a corpus without them still reads them
    for i, m in enumerate(marks[1:], 1):
        if m in at:
            mark[i, 2 * at[m]] += max(1.0, 0.2 * mark[0, 2 * at[m]])
    # by counts of equal turns, so that rows which share a turn make no pairs; each counts once for every role before it
    held = known.groupBy("conv_id", "turn", "role").agg(F.count(F.lit(1)).alias("n"))
    prev = held.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("role").alias("before"))
    pairs = held.join(prev, ["conv_id", "turn"], "left").groupBy("before", "role").agg(F.sum("n").alias("count")).collect()
    begin, follow = np.full(n, smooth), np.full((n, n), smooth)
    for r in pairs:
        if r["before"] is None:
            begin[at[r["role"]]] += r["count"]
        else:
            follow[at[r["before"]], at[r["role"]]] += r["count"]
    follow /= follow.sum(1, keepdims=True)
    move = np.full((2 * n, 2 * n), 1e-9)
    for i in range(n):
        lines_, turns_ = inner[2 * i] + inner[2 * i + 1], inner[2 * i]
        stay = (lines_ - turns_ + smooth) / (lines_ + 2 * smooth)
        for s in (2 * i, 2 * i + 1):
            move[s, 2 * i + 1] = stay
            move[s, 0::2] += (1 - stay) * follow[i]
    start = np.full(2 * n, 1e-9)
    start[0::2] = begin / begin.sum()
    log = lambda a: np.log(a / a.sum(0))
    return Hmm(roles, np.log(start), np.log(move / move.sum(1, keepdims=True)), dict(zip(marks, log(mark))), log(first), log(length), log(question))


def reduce_segment(hmm: Hmm, texts: list) -> np.ndarray:
    """Best score from each state before the segment (a last row: from the start) to each state at its end."""
    best = None
    for t in texts:
        for e in hmm.emit(t):
            if best is None:
                best = np.vstack([hmm.move, hmm.start]) + e
            else:
                best = (best[:, :, None] + hmm.move[None]).max(1) + e
    return best


def decode(hmm: Hmm, texts: list, enter: np.ndarray | None, leave: int | None) -> list[list[int]]:
    """Best states of each text's lines, between scores before the segment (None: the start) and its last state."""
    lines = [hmm.emit(t) for t in texts]
    e = np.concatenate(lines)
    score = (hmm.start if enter is None else (enter[:, None] + hmm.move).max(0)) + e[0]
    back = np.zeros((len(e), e.shape[1]), np.int32)
    for i in range(1, len(e)):
        to = score[:, None] + hmm.move
        back[i] = to.argmax(0)
        score = to.max(0) + e[i]
    path = [int(score.argmax()) if leave is None else leave]
    for i in range(len(e) - 1, 0, -1):
        path.append(int(back[i, path[-1]]))
    path.reverse()
    out, at = [], 0
    for x in lines:
        out.append(path[at : at + len(x)])
        at += len(x)
    return out


def render(hmm: Hmm, text: str | None, path: list[int]) -> tuple[list[str], str]:
    """(roles of the turns begun or carried on here, their canonical rendering without speaker markers)."""
    roles, parts = [], []
    for line, s in zip((text or "").split("\n"), path):
        if s % 2 == 0 or not parts:
            roles.append(hmm.roles[s // 2])
            parts.append([])
            line = line[marker(line)[1] :]
        parts[-1].append(line)
    return roles, "".join(f"<|{r}|>\n{'\n'.join(p).strip()}\n<|end|>\n" for r, p in zip(roles, parts))


def segments(turns: DataFrame, segment: int) -> tuple[DataFrame, DataFrame | None]:
    """conv_id, turn, text, tie, copies, conv, seg of each conversation's rows, cut every `segment` rows in order of turn
    and a hash of the text; and the conversations (conv) that are cut, or None.

    Equal rows of a conversation are one row with their number of copies.  Rows are numbered, for conversations of more
    than `segment` rows alone, in ranges that may part a conversation anywhere."""
    own = F.when(F.col("conv_id").isNull(), F.xxhash64(F.lit("alone"), "turn", "text")).otherwise(F.xxhash64("conv_id"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "text")
    rows = rows.groupBy("conv_id", "turn", "text").agg(F.count(F.lit(1)).alias("copies")).withColumn("conv", own).withColumn("tie", F.xxhash64("text"))
    rows = stored(rows, "rows")
    columns = ("conv_id", "turn", "text", "tie", "copies", "conv", "seg")
    of = lambda first: F.explode(F.expr(f"sequence({first} div {segment}, ({first} + copies - 1) div {segment})")).alias("seg")
    within = lambda first: (F.least(F.col(first) + F.col("copies"), (F.col("seg") + 1) * segment) - F.greatest(F.col(first), F.col("seg") * segment)).alias("copies")

    def cut(numbered):
        return numbered.select("*", of("first")).withColumn("copies", within("first")).select(*columns)

    # rows without a conv_id are conversations of one row, however many are equal
    alone = cut(rows.where("conv_id is null").withColumn("first", F.lit(0).cast("long")))
    parts = 16  # in which the rows of a long conversation are told from others
    sums = rows.where("conv_id is not null").groupBy("conv").agg(F.sum("copies").alias("n"))
    long = stored(sums.where(F.col("n") > segment).select("conv"), "long")
    if long.isEmpty():
        return alone.unionByName(rows.where("conv_id is not null").withColumn("seg", F.lit(0).cast("long")).select(*columns)), None
    spread = long.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    pieced = rows.where("conv_id is not null").withColumn("piece", F.pmod("tie", F.lit(parts)).cast("int"))
    short = pieced.join(spread, ["conv", "piece"], "left_anti").withColumn("seg", F.lit(0).cast("long")).select(*columns)

    schema = "conv_id long, turn long, text string, tie long, copies long, conv long, part int, nth long"

    def number(batches):
        part, at, upto = TaskContext.get().partitionId(), None, 0
        for b in batches:
            if not b.num_rows:
                continue
            copies, conv = b.column(4).to_numpy(), b.column(5).to_numpy()
            before = np.cumsum(copies) - copies
            starts = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
            ends = np.r_[starts[1:], len(conv)]
            nth = before - np.repeat(before[starts], ends - starts)
            if conv[0] == at:
                nth[: ends[0]] += upto
            at, upto = conv[-1], nth[-1] + copies[-1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(conv), part, np.int32)), pa.array(nth)], [x.split()[0] for x in schema.split(", ")])

    mine = pieced.join(spread, ["conv", "piece"], "left_semi").select("conv_id", "turn", "text", "tie", "copies", "conv")
    ranged = mine.repartitionByRange(partitions(turns.sparkSession), "conv", "turn", "tie").sortWithinPartitions("conv", "turn", "tie", "text")
    numbered = stored(ranged.mapInArrow(number, schema), "numbered")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    firsts = numbered.groupBy("conv", "part").agg(F.sum("copies").alias("n")).select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("upto"))
    placed = numbered.join(firsts, ["conv", "part"]).withColumn("first", F.col("upto") + F.col("nth"))
    return alone.unionByName(short).unionByName(cut(placed)), long


def format_chats(turns: DataFrame, hmm: Hmm, segment: int = 1024) -> DataFrame:
    """conv_id, turn, n_lines, role_pred (of the record's first line), n_turns, rendered, for every row of turns.

    A role column is never read.  Records are in order of turn (null first), ties by a hash of the text.  Null or empty texts are
    one empty line; a row with a null conv_id is a conversation of its own; repeated rows are records each; an empty
    table gives no rows; other columns are not read.  Without any labelled turn the role is null and nothing is rendered.
    A conversation of more than `segment` records is decoded in segments of so many."""
    rows = turns.select("conv_id", "turn", "text")
    schema = "conv_id long, turn long, n_lines long, role_pred string, n_turns long, rendered string"
    if not hmm.roles:
        none = F.lit(None).cast("string")
        n = F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long")
        return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), n.alias("n_lines"), none.alias("role_pred"), F.lit(0).cast("long").alias("n_turns"), none.alias("rendered"))
    n = partitions(turns.sparkSession)
    size = 2 * len(hmm.roles)

    def reduce(batches):
        for g in runs(batches, ["conv", "seg"]):
            best = reduce_segment(hmm, np.repeat(np.array(g["text"].to_pylist(), object), g["copies"].to_numpy()).tolist())
            yield pa.RecordBatch.from_arrays([g["conv"][:1].combine_chunks(), g["seg"][:1].combine_chunks(), pa.array([best.ravel().tolist()], pa.list_(pa.float64()))], ["conv", "seg", "best"])

    def join(batches):
        for g in runs(batches, ["conv"]):
            best = [np.array(x).reshape(size + 1, size) for x in g["best"].to_pylist()]
            enter, score, back = [], None, []
            for b in best:
                enter.append(score)
                to = b[size:] if score is None else score[:, None] + b[:size]
                back.append(to.argmax(0))
                score = to.max(0) if score is not None else to[0]
                score = score - score.max()
            leave = [int(score.argmax())]
            for b in back[:0:-1]:
                leave.append(int(b[leave[-1]]))
            leave.reverse()
            yield pa.RecordBatch.from_arrays([g["conv"].combine_chunks(), g["seg"].combine_chunks(), pa.array([None if x is None else x.tolist() for x in enter], pa.list_(pa.float64())), pa.array(leave, pa.int32())], ["conv", "seg", "enter", "leave"])

    def read(batches):
        names = [c.split()[0] for c in schema.split(", ")]
        for g in runs(batches, ["conv", "seg"]):
            copies, alone = g["copies"].to_numpy(), g["conv_id"][0].as_py() is None
            texts = g["text"].to_pylist()
            if alone:
                done = [render(hmm, t, *decode(hmm, [t], None, None)) for t in texts]
            else:
                each = np.repeat(np.arange(len(texts)), copies)
                enter = g["enter"][0].as_py()
                paths = decode(hmm, [texts[i] for i in each], None if enter is None else np.array(enter), g["leave"][0].as_py())
                done = [render(hmm, texts[i], p) for i, p in zip(each, paths)]
            each = pa.array(np.repeat(np.arange(len(texts)), copies))
            if alone:
                done = [done[i] for i in each.to_pylist()]
            lines = [(texts[i] or "").count("\n") + 1 for i in each.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [g["conv_id"].combine_chunks().take(each), g["turn"].combine_chunks().take(each), pa.array(lines, pa.int64()), pa.array([r[0] for r, _ in done]), pa.array([len(r) for r, _ in done], pa.int64()), pa.array([x for _, x in done])], names
            )

    placed, long = segments(rows, segment)
    none = F.lit(None)
    if long is None:
        bounded = placed.withColumns({"enter": none.cast("array<double>"), "leave": none.cast("int")})
    else:
        placed = stored(placed, "placed")
        many = placed.select("conv", "seg").distinct().join(long, "conv", "left_semi")
        reduced = placed.where("conv_id is not null").join(many, ["conv", "seg"], "left_semi").select("conv", "seg", "turn", "tie", "text", "copies")
        reduced = reduced.repartition(n, "conv", "seg").sortWithinPartitions("conv", "seg", "turn", "tie", "text").select("conv", "seg", "text", "copies").mapInArrow(reduce, "conv long, seg long, best array<double>")
        ends = reduced.repartition(n, "conv").sortWithinPartitions("conv", "seg").mapInArrow(join, "conv long, seg long, enter array<double>, leave int")
        bounded = placed.join(stored(ends, "ends"), ["conv", "seg"], "left")
    ordered = bounded.repartition(n, "conv", "seg").sortWithinPartitions("conv", "seg", "turn", "tie", "text")
    return ordered.select("conv", "seg", "conv_id", "turn", "text", "copies", "enter", "leave").mapInArrow(read, schema)
