"""Near-duplicate documents by a chosen-path set similarity join over word shingles.

Documents of equal shingle sets are one class from the start.  Independent trees branch the classes by selected minwise
tokens: a node that holds few classes is compared exhaustively, a larger one branches by the next token of its tree.
In the nodes, whole sketches screen the pairs; what passes is gathered into blocks, and the exact link condition is
settled there on full sets.  Only spanning links leave a node or block, never all pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import partitions, stored
from .graph import components
from .tokens import array_slices, give_back, release

TREES, LEVELS = 12, 8
#: The chance, at most, with which all trees part a pair at the threshold; counted from the depths that paths reach.
MISS = 1e-5


def _factors(more: int) -> np.ndarray:
    """Odd factors of a round of trees, one per tree and level."""
    return np.array([xxhash.xxh64_intdigest(b"minwise", more * TREES * LEVELS + i) | 1 for i in range(TREES * LEVELS)], np.uint64)


_MUL = _factors(0)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of the A-Z lower-cased text; fewer words are one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    if len(words) < k:
        return np.array([xxhash.xxh64_intdigest(h.tobytes(), len(words))], np.uint64)
    n = len(h) - k + 1
    s = np.full(n, _C2)
    for j in range(k):
        s = (s ^ h[j : j + n]) * _C1
        s ^= s >> np.uint64(31)
    return np.unique(s)


def minwise(x: np.ndarray, factors: np.ndarray = _MUL) -> np.ndarray:
    """One token per tree and level: the low half of the least product (odd factors permute 64-bit numbers)."""
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    for lo in range(0, len(x), 1024):
        np.minimum(least, (x[lo : lo + 1024, None] * factors).min(0), out=least)
    return least.astype(np.uint32)


def sketches(docs: DataFrame, words: int, more: int = 0) -> DataFrame:
    """doc_id, n (set size), f1 and f2 (fingerprint of the set), tokens (minwise, little-endian) of every row.

    more: the round of trees that the tokens are for."""
    factors = _factors(more)
    schema = "doc_id long, n long, f1 long, f2 long, tokens binary"

    def run(batches):
        release()
        for b in batches:
            for lo, hi in array_slices(b.column(1)):
                rows = []
                for key, t in zip(b.column(0)[lo:hi].to_pylist(), b.column(1)[lo:hi].to_pylist()):
                    x = shingle_set(t, words)
                    f = np.frombuffer(xxhash.xxh3_128_digest(x.tobytes()), "<i8")
                    rows.append((key, len(x), int(f[0]), int(f[1]), minwise(x, factors).tobytes() if len(x) else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))], ["doc_id", "n", "f1", "f2", "tokens"])
            b = None
            give_back()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


def runs(batches, keys: list[str]):
    """Tables of equal keys from key-sorted batches, as slices of the batches; a group over several keeps those alone."""
    held, last = [], None
    for b in batches:
        if not b.num_rows:
            continue
        columns = [b.column(b.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            key = tuple(c[lo] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


class Joined:
    """Groups of the positions 0 to n - 1, each named by its least position."""

    def __init__(self, n: int):
        self.of = np.arange(n)

    def join(self, i: int, others: np.ndarray) -> None:
        names = np.unique(self.of[np.append(others, i)])
        if len(names) > 1:
            self.of[np.isin(self.of, names[1:])] = names[0]

    def edges(self, ids: np.ndarray) -> pa.RecordBatch:
        """(id, id of its group's least position) of the positions that are not that one."""
        i = np.flatnonzero(self.of != np.arange(len(ids)))
        return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[self.of[i]])], ["a", "b"])


def screened(nodes: DataFrame, percent: int) -> DataFrame:
    """Spanning edges, in each node, of the pairs whose sketches allow the similarity (4.5 standard errors below it).

    Only pairs that are not joined yet are looked at, so a node of near-equal classes costs a few passes."""
    t = percent / 100
    least = (t - 4.5 * (t * (1 - t) / len(_MUL)) ** 0.5) * len(_MUL)

    def run(batches):
        for node in runs(batches, ["tree", "node"]):
            if node.num_rows < 2:
                continue
            ids, n = node["id"].to_numpy(), node["n"].to_numpy()
            s = np.frombuffer(b"".join(node["tokens"].to_pylist()), np.uint32).reshape(len(ids), -1)
            groups = Joined(len(ids))
            for i in range(len(ids) - 1):
                apart = (groups.of[i + 1 :] != groups.of[i]) & (np.minimum(n[i + 1 :], n[i]) * 100 >= np.maximum(n[i + 1 :], n[i]) * percent)
                j = np.flatnonzero(apart) + i + 1
                if len(j):
                    groups.join(i, j[(s[j] == s[i]).sum(1) >= least])
            yield groups.edges(ids)

    n = partitions(nodes.sparkSession)
    return nodes.repartition(n, "tree", "node").sortWithinPartitions("tree", "node", "id").mapInArrow(run, "a long, b long")


def linked(groups: DataFrame, words: int, percent: int) -> DataFrame:
    """Spanning exact links of each group (columns grp, id, text): 100 * intersection >= percent * union on full sets."""

    def run(batches):
        for g in runs(batches, ["grp"]):
            if g.num_rows > 1:
                yield exact_groups([shingle_set(t.as_py(), words) for t in g["text"]], percent).edges(g["id"].to_numpy())

    n = partitions(groups.sparkSession)
    return groups.repartition(n, "grp").sortWithinPartitions("grp", "id").mapInArrow(run, "a long, b long")


def exact_groups(sets: list[np.ndarray], percent: int, strip: int = 1 << 15, firsts: int = 16) -> Joined:
    """Groups of the sets that links join, each pair of sets compared unless links join the two already.

    A few sets are compared with all others first, which settles a group of copies.  The rest are compared by bit strips
    over the tokens that two sets or more share; no list of pairs is made."""
    sizes, groups = np.array([len(x) for x in sets], np.int64), Joined(len(sets))
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, token, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[token] > 1
    owner, token = owner[shared], (np.cumsum(count > 1) - 1)[token[shared]]
    tokens, begin = int((count > 1).sum()), np.searchsorted(owner, np.arange(len(sets) + 1))

    def meet(i, others, common):
        ok = (common > 0) & (100 * common >= percent * (sizes[i] + sizes[others] - common)) & (others != i)
        groups.join(i, others[ok])

    met = np.zeros(len(sets), bool)
    for i in range(min(firsts, len(sets))):
        if (groups.of == 0).all():
            return groups
        has = np.zeros(tokens, bool)
        has[token[begin[i] : begin[i + 1]]] = True
        meet(i, np.arange(len(sets)), np.bincount(owner[has[token]], minlength=len(sets)).astype(np.int64))
        met[i] = True
    # pairs inside the greatest group need no look, nor do those of a set that has met all
    names, members = np.unique(groups.of, return_counts=True)
    main = groups.of == names[members.argmax()]
    rows, other = np.flatnonzero(~met & ~main), np.flatnonzero(~met & main)
    if not len(rows):
        return groups
    order = np.concatenate([rows, other])
    place = np.full(len(sets), -1)
    place[order] = np.arange(len(order))
    use = place[owner] >= 0
    owner, token = place[owner[use]], token[use]
    common = np.zeros((len(rows), len(order)), np.int32)
    for lo in range(0, tokens, strip):
        here = (token >= lo) & (token < lo + strip)
        width = (min(strip, tokens - lo) + 63) // 64 * 8
        bits = np.zeros(len(order) * width, np.uint8)
        at = token[here] - lo
        np.bitwise_or.at(bits, owner[here] * width + (at >> 3), np.uint8(1) << (at & 7).astype(np.uint8))
        bits = bits.reshape(len(order), width).view(np.uint64)
        for r in range(len(rows)):
            common[r, r + 1 :] += np.bitwise_count(bits[r + 1 :] & bits[r]).sum(1, dtype=np.int32)
    for r, i in enumerate(rows):
        meet(i, order[r + 1 :], common[r, r + 1 :].astype(np.int64))
    return groups


def tree_nodes(classes: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """tree, node, id of every class in every tree, in nodes of two classes or more; and the depths of what branched.

    A node is a path of minwise tokens.  A path that holds over `limit` classes branches by its tree's next token; at the
    last level it stays, and `deep` marks it.  The depths (id, tree, depth) are of paths of two tokens or more, those that
    ended alone too; None where no path branched."""
    token = lambda level: F.conv(F.hex(F.substring("tokens", F.col("tree") * (4 * LEVELS) + 4 * level + 1, F.lit(4))), 16, 10).cast("long")
    trees = F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    now = classes.select("id", "tokens", trees).select("id", "tree", F.xxhash64(token(0)).alias("node"))
    done = branched = None

    def depths():
        return None if branched is None else branched.groupBy("id", "tree").agg((F.count(F.lit(1)) + 1).alias("depth"))

    for level in range(1, LEVELS + 1):
        size = now.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        sized = stored(now.join(size, ["tree", "node"]), "nodes")
        full = level == LEVELS
        ready = sized.where(F.lit(full) | (F.col("members") <= limit)).select("tree", "node", "id", (F.col("members") > limit).alias("deep"))
        done = ready if done is None else done.unionByName(ready)
        over = sized.where(F.col("members") > limit)
        if full or over.isEmpty():
            return done, depths()
        # a row for each token after the first; texts that share an id share their longest path
        step = over.select("id", "tree", F.lit(level).alias("level")).distinct()
        branched = step if branched is None else branched.unionByName(step)
        now = over.select("id", "tree", "node").join(classes.select("id", "tokens"), "id").select("id", "tree", F.xxhash64("node", token(level)).alias("node"))
    return done, depths()


def all_nodes(docs: DataFrame, classes: DataFrame, words: int, percent: int, limit: int) -> DataFrame:
    """tree_nodes of the first TREES, and of further rounds of as many for classes that branched too deep for MISS.

    A pair at the threshold t keeps together down a path of depth d with t^d, so a class misses it in all its trees with
    the product of 1 - t^d.  A class whose product is above MISS is placed in independent trees until it no longer is.
    A pair with one class at rest was found with its trees; of two others both are placed again."""
    t = min(percent / 100, 1 - 1e-9)
    nodes, depths = tree_nodes(classes, limit)
    all_of, more, owed = nodes, 0, None
    at_one = math.log(1 - t)
    while depths is not None or owed is not None:
        more += 1
        # ids owed, with the logarithm of their miss so far; a tree without branching is one of depth one
        if depths is None:
            gone = owed.select("id", (F.col("miss") + TREES * at_one).alias("miss"))
        else:
            gain = depths.groupBy("id").agg((F.sum(F.log(1 - F.pow(F.lit(t), F.col("depth")))) + (TREES - F.count(F.lit(1))) * at_one).alias("gain"))
            gone = gain.select("id", F.col("gain").alias("miss")) if owed is None else owed.join(gain, "id", "left").select("id", (F.col("miss") + F.coalesce("gain", F.lit(TREES * at_one))).alias("miss"))
        owed = stored(gone.where(F.col("miss") > math.log(MISS)), "owed")
        if owed.isEmpty():
            break
        again = sketches(docs.join(owed.select(F.col("id").alias("__owed")), F.col("doc_id").cast("long") == F.col("__owed"), "left_semi"), words, more)
        drawn = stored(again.where("n > 0").groupBy("f1", "f2", F.col("doc_id").alias("id")).agg(F.first("tokens").alias("tokens")), "again")
        nodes, depths = tree_nodes(drawn, limit)
        all_of = all_of.unionByName(nodes.withColumn("tree", F.col("tree") + more * TREES))
    return all_of


def near_classes(docs: DataFrame, words: int = 5, percent: int = 80, limit: int = 3000, most_shingles: int = 4_000_000) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs.

    Links join rows whose shingle sets meet 100 * intersection >= percent * union.  Rows without words (null, empty,
    blank) are linked with nothing; rows with a null doc_id take no part and have a null component_id; rows that repeat
    a doc_id are one document, linked by all its texts; an empty table gives no rows; other columns are not read.
    limit, most_shingles: the most that one node or block holds in a task; what is larger branches on, and where all
    tokens are used up its members are compared with a few of them, and those linked with none of these with all the
    others in pieces, so nothing is left out."""
    drawn = stored(sketches(docs, words), "sketches")
    sound = drawn.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    byclass = sound.groupBy("f1", "f2").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    classes = stored(byclass, "classes")
    nodes = stored(all_nodes(docs, classes, words, percent, limit), "nodes")
    few = nodes.where(~F.col("deep")).join(classes.select("id", "n", "tokens"), "id")
    # classes that agree in all tokens of a tree are near by any measure: the node's least id joins them
    least = nodes.where("deep").groupBy("tree", "node").agg(F.min("id").alias("b"))
    deep = nodes.where("deep").join(least, ["tree", "node"]).select(F.col("id").alias("a"), "b")
    blocks = stored(components(screened(few, percent).unionByName(deep)), "blocks")

    size = blocks.join(classes.groupBy("id").agg(F.sum("n").alias("n")), "id").groupBy("component").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("n"))
    large = stored(size.where((F.col("members") > limit) | (F.col("n") > most_shingles)), "large")
    some_large = not large.isEmpty()
    groups = blocks.select(F.xxhash64("component").alias("grp"), "id")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    stars = None
    if some_large:
        members = stored(blocks.join(large.select("component", F.ceil(F.col("members") / limit).alias("parts")), "component"), "members")
        stars, rest = around(members, texts, words, percent)
        groups = blocks.join(large, "component", "left_anti").select(F.xxhash64("component").alias("grp"), "id").unionByName(_parts(members, rest, nodes, classes, limit, most_shingles))
    links = linked(groups.join(texts, "id"), words, percent)
    links = stored(links if stars is None else links.unionByName(stars), "links")
    found = components(links) if some_large else links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    named = classes.select("f1", "f2", "id").join(found, "id", "left").select("f1", "f2", F.coalesce("component", "id").alias("component_id"))
    whole = drawn.select("doc_id", F.col("n").alias("n_shingles"), "f1", "f2").join(named, ["f1", "f2"], "left")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    return whole.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def around(members: DataFrame, texts: DataFrame, words: int, percent: int, centres: int = 8) -> tuple[DataFrame, DataFrame]:
    """Exact links (a, b) of large blocks' members with a few members chosen as centres; and the members of each block
    outside the largest group that these links join.

    members: component, id, parts.  Every member meets the centres of its block, in `parts` tasks a block.  Members of
    the largest group are linked already and need not be compared with each other; the others may need all members."""

    def compare(batches):
        at, held, found = None, [], []
        for b in batches:
            for grp, key, first, text in zip(*(c.to_pylist() for c in b.columns[:3]), b.column(3)):
                if grp != at:
                    at, held = grp, []
                x = shingle_set(text.as_py(), words)
                for other, y in held:
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    if common and 100 * common >= percent * (len(x) + len(y) - common):
                        found.append((key, other))
                if first:
                    held.append((key, x))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])
                found = []

    n = partitions(members.sparkSession)
    # a bounded heap of hashes a block, then each centre in every part of its block
    few = members.groupBy("component", "parts").agg(F.slice(F.sort_array(F.collect_set(F.when(F.pmod(F.xxhash64("id"), "parts") == 0, F.struct(F.xxhash64(F.lit(2), "id"), "id")))), 1, centres).alias("few"))
    shown = few.select("component", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.explode("few.id").alias("id"), F.lit(True).alias("first"))
    asked = members.select("component", F.pmod(F.xxhash64(F.lit(3), "id"), "parts").alias("part"), "id", F.lit(False).alias("first"))
    met = asked.unionByName(shown).join(texts, "id").select(F.xxhash64("component", "part").alias("grp"), "id", "first", "text")
    stars = stored(met.repartition(n, "grp").sortWithinPartitions("grp", F.desc("first"), "id").mapInArrow(compare, "a long, b long").where("a != b"), "stars")
    joined = stored(members.join(components(stars).withColumnRenamed("component", "star"), "id", "left"), "joined")
    main = joined.where("star is not null").groupBy("component", "star").count().groupBy("component").agg(F.max_by("star", F.struct("count", "star")).alias("main"))
    return stars, joined.join(main, "component", "left").where("main is null or star is null or star != main").select("component", "id")


def _parts(members: DataFrame, rest: DataFrame, nodes: DataFrame, classes: DataFrame, limit: int, most_shingles: int) -> DataFrame:
    """grp, id of the comparisons that blocks too large for a task still need: their tree nodes that hold some of rest.

    What is too large for a task after all is cut into pieces, each piece of rest with each of all."""
    sized = nodes.select("id", "tree", "node").join(members.select("component", "id"), "id").join(classes.groupBy("id").agg(F.sum("n").alias("n")), "id")
    inside = sized.join(rest.select("id", F.lit(True).alias("left")), "id", "left").withColumn("left", F.coalesce("left", F.lit(False)))
    size = inside.groupBy("component", "tree", "node").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"), F.sum(F.col("left").cast("long")).alias("owed"))
    share = F.greatest(F.col("members") / limit, F.col("shingles") / most_shingles)
    pieces = F.when(share <= 1, 1).otherwise(F.ceil(2 * share)).cast("long")
    # the pieces of rest are as large as those of all, so they are as many only where all is left
    some = F.least(pieces, F.greatest(F.lit(1), F.ceil(pieces * F.col("owed") / F.col("members")))).cast("long")
    held = inside.join(size.where("members > 1 and owed > 0").select("component", "tree", "node", pieces.alias("pieces"), some.alias("some")), ["component", "tree", "node"])
    count = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    of_all = held.select("component", "tree", "node", "id", F.pmod(F.xxhash64("id"), "pieces").alias("all"), F.explode(count("some")).alias("own"))
    of_rest = held.where("left").select("component", "tree", "node", "id", F.explode(count("pieces")).alias("all"), F.pmod(F.xxhash64(F.lit(1), "id"), "some").alias("own"))
    return of_all.unionByName(of_rest).select(F.xxhash64("component", "tree", "node", "all", "own").alias("grp"), "id").distinct()


def near_dedup(docs: DataFrame, words: int = 5, percent: int = 80, **options) -> DataFrame:
    """The rows of docs that stay: of each group, the document of the least doc_id, once; own columns only.

    Rows without a doc_id or without words belong to no group and stay."""
    classes = near_classes(docs, words, percent, **options)
    kept = classes.where(F.col("doc_id") == F.col("component_id")).select(F.col("doc_id").alias("__kept")).distinct()
    kept = kept.withColumn("__first", F.lit(True))
    from pyspark.sql import Window

    joined = docs.join(kept, F.col("doc_id").cast("long") == F.col("__kept"), "left").where(F.col("__first") | F.col("doc_id").isNull())
    # a null doc_id names no document, so such rows are numbered apart
    apart = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text"))).orderBy(F.xxhash64("text"))
    nth = joined.withColumn("__nth", F.row_number().over(apart))
    return nth.where((F.col("__nth") == 1) | F.col("doc_id").isNull()).select(*docs.columns)
