"""Exact Jaccard join of word shingles through a token-group matrix.

Sets are dealt into groups of similar sets, and a set is compared with the
members of a group only where the group's tokens leave room for a link. A plain
matrix of shingles by groups would be as large as the texts and would have very
full rows for passages that many documents share. Its rows here are blocks of
shingles instead: a set is cut by hash into more blocks than the shingles that
two linked sets can differ in, so that two linked sets have a whole block in
common, always. A block of several shingles is rarely shared by chance, also
when all its shingles are frequent.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.shared import written
from millrace.llm.shingles import mixed, shingle_sets
from millrace.operators.joins import join_back

# 64-bit words of the parity bits of a set's tokens.
MARK_WORDS = 4

# A broadcast id list has at most so many rows (8 bytes each).
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Similarity:
    """Shingles of ``n`` words; sets link when den * intersection >= num * union."""

    n: int = 5
    num: int = 8
    den: int = 10

    def most_different(self, a, b):
        """Shingles that two linked sets of these sizes can differ in, at most."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def largest_partner(self, size):
        return size * self.den // self.num


def _blocks_of(size: np.ndarray, differ: np.ndarray) -> np.ndarray:
    """Number of blocks: one more than can be damaged, and some for those that stay empty."""
    k = differ + 1.0
    empty = k * np.exp(-size / k)
    return (k + np.ceil(empty + 3 * np.sqrt(empty))).astype(np.int64)


def block_keys(
    sets: list[np.ndarray], how: Similarity
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Arrays (index of the set, key of a block, whether it is filled, need) for a set's own class (0) and the next (1).

    ``need`` is how many blocks of that class the set has in common with any set
    of the class that it links with, at least.

    Sizes fall into classes that double. Two linked sets are compared by the
    blocks of the larger one's class, so a set close to its class's end is cut
    for the next class as well. Empty blocks have no key, unless a set has so
    few filled ones that all of them could be damaged; two such sets still meet
    in their empty blocks.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    own = np.floor(np.log2(np.maximum(sizes, 1))).astype(np.int64)
    reach = np.floor(np.log2(np.maximum(how.largest_partner(sizes), 1))).astype(np.int64)
    for up in (0, 1):
        chosen = np.flatnonzero((sizes > 0) & (own + up <= reach))
        top = (np.int64(2) << (own[chosen] + up)) - 1
        differ = how.most_different(top, top)
        chosen, differ, top = chosen[differ > 0], differ[differ > 0], top[differ > 0]
        if not len(chosen):
            continue
        # Blocks depend on the class alone, or sets of one class would be cut differently.
        k = _blocks_of((top + 1) * 0.7, differ)
        tokens = np.concatenate([sets[i] for i in chosen])
        at = np.repeat(np.arange(len(chosen)), sizes[chosen])
        spread = mixed(tokens ^ np.uint64(0xA5A5A5A5DEADBEEF))
        first = np.concatenate([[0], np.cumsum(k)])
        slot = first[at] + (spread % k[at].astype(np.uint64)).astype(np.int64)
        value = mixed(spread)
        total = np.zeros(first[-1], dtype=np.uint64)
        np.add.at(total, slot, value)
        filled = np.bincount(slot, minlength=first[-1]) > 0
        owner = np.repeat(np.arange(len(chosen)), k)
        few = np.bincount(owner, weights=filled) <= differ
        block = np.arange(first[-1]) - first[owner]
        salt = mixed((top[owner].astype(np.uint64) << np.uint64(24)) ^ block.astype(np.uint64))
        keep = filled | few[owner]
        partner = np.minimum(how.largest_partner(sizes[chosen]), top)
        need = np.bincount(owner, weights=filled).astype(np.int64) - how.most_different(sizes[chosen], partner)
        yield up, chosen[owner[keep]], mixed(total + salt)[keep], filled[keep], need[owner[keep]]


def set_key(tokens: np.ndarray) -> int:
    """64-bit key of a set; equal sets have equal keys."""
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def parity_marks(tokens: np.ndarray) -> np.ndarray:
    """``MARK_WORDS`` words with a bit for each slot of tokens, set where the slot holds an odd number of them.

    Two sets differ in at least as many tokens as their marks in bits, because
    the marks of the tokens in one of them only are the exclusive or of both.
    """
    odd = np.bincount((tokens % np.uint64(64 * MARK_WORDS)).astype(np.int64), minlength=64 * MARK_WORDS) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")


def _mark(token: Column, word: int) -> Column:
    """That word of ``parity_marks`` of a single token."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), token.bitwiseAND(63).cast("int"))
    return F.when(F.shiftright(token, 6).bitwiseAND(MARK_WORDS - 1) == word, bit).otherwise(F.lit(0).cast("long"))


def set_table(docs: DataFrame, how: Similarity, doc_id: str, text: str) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``node``, the key of the set (NULL when it is empty)."""

    def scan(batches):
        for b in batches:
            sets = list(shingle_sets(b.column(1), how.n))
            yield pa.record_batch(
                [
                    b.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                ],
                names=["doc_id", "n_shingles", "node"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInArrow(scan, f"doc_id {kind}, n_shingles bigint, node bigint")


def block_table(docs: DataFrame, how: Similarity, text: str) -> DataFrame:
    """``block``, ``node``, ``code``: the blocks of every set, once for each set and task.

    ``code`` is twice the blocks that a link needs in the class, plus 1 for the next class.
    """

    def scan(batches):
        seen: set[int] = set()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                sets, nodes = [], []
                for s in shingle_sets(b.column(0).slice(at, 256), how.n):
                    if len(s) and (node := set_key(s)) not in seen:
                        seen.add(node)
                        sets.append(s)
                        nodes.append(node)
                ids = np.array(nodes, dtype=np.int64)
                for up, owner, key, _, need in block_keys(sets, how) if sets else ():
                    yield pa.record_batch(
                        [pa.array(key.view(np.int64)), pa.array(ids[owner]), pa.array((2 * need + up).astype(np.int32))],
                        names=["block", "node", "code"],
                    )

    return docs.select(text).mapInArrow(scan, "block bigint, node bigint, code int")


def token_table(docs: DataFrame, how: Similarity, text: str) -> DataFrame:
    """``node``, ``tokens``, the keys of its filled blocks, ``own`` and ``up``, and its parity marks ``m0`` on, once for each set and task."""
    names = [f"m{i}" for i in range(MARK_WORDS)]

    def scan(batches):
        seen: set[int] = set()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                nodes, sets = [], []
                for s in shingle_sets(b.column(0).slice(at, 256), how.n):
                    if len(s) and (node := set_key(s)) not in seen:
                        seen.add(node)
                        nodes.append(node)
                        sets.append(s)
                keys = [[np.zeros(0, dtype=np.int64)] * len(sets) for _ in (0, 1)]
                for up, owner, key, filled, _ in block_keys(sets, how) if sets else ():
                    owner, key = owner[filled], key[filled].view(np.int64)
                    edges = np.searchsorted(owner, np.arange(len(sets) + 1))
                    for i in np.unique(owner):
                        keys[up][i] = key[edges[i] : edges[i + 1]]
                longs = pa.list_(pa.int64())
                marks = np.array([parity_marks(s) for s in sets], dtype=np.int64).reshape(-1, MARK_WORDS)
                yield pa.record_batch(
                    [
                        pa.array(nodes, pa.int64()),
                        pa.array([s.view(np.int64) for s in sets], longs),
                        *[pa.array(k, longs) for k in keys],
                        *[pa.array(np.ascontiguousarray(m)) for m in marks.T],
                    ],
                    names=["node", "tokens", "own", "up", *names],
                )

    schema = "node bigint, tokens array<bigint>, own array<bigint>, up array<bigint>"
    return docs.select(text).mapInArrow(scan, ", ".join([schema, *[f"{m} bigint" for m in names]]))


def semi_by_id(rows: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows whose key is (not) in ``ids``; at most BROADCAST_IDS ids are broadcast, more are shuffled."""
    few = len(ids.select(key).limit(BROADCAST_IDS + 1).groupBy().count().filter(f"count <= {BROADCAST_IDS}").collect())
    return rows.join(F.broadcast(ids) if few else ids, key, how)


def _class(n: Column) -> Column:
    return F.length(F.bin(n)) - 1


def _differ(how: Similarity, a: Column, b: Column) -> Column:
    """``Similarity.most_different`` as an expression."""
    return F.floor((how.den - how.num) * (a + b) / (how.den + how.num))


def _common(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Pairs (a, b) with the sizes of their sets and of what they have in common, ``both``."""
    left = tokens.select(F.col("node").alias("a"), F.col("tokens").alias("left"))
    right = tokens.select(F.col("node").alias("b"), F.col("tokens").alias("right"))
    return pairs.join(left, "a").join(right, "b").select(
        "a", "b", F.size("left").alias("size_a"), F.size("right").alias("size_b"), F.size(F.array_intersect("left", "right")).alias("both")
    )


def _linked(pairs: DataFrame, tokens: DataFrame, how: Similarity) -> DataFrame:
    """Those pairs (a, b, with sizes na, nb) of nodes whose sets link.

    Sets that differ in at most d shingles share all filled blocks but d, so the
    blocks, a tenth of the set or so, are compared first; the sets of the pairs
    that are left decide.
    """
    side = lambda me, other: F.when(_class(F.col(me)) < _class(F.col(other)), F.col("up")).otherwise(F.col("own"))
    blocks = tokens.select("node", "own", "up")
    left = pairs.join(blocks.withColumnRenamed("node", "a"), "a").select("a", "b", "na", "nb", side("na", "nb").alias("left"))
    right = left.join(blocks.withColumnRenamed("node", "b"), "b").select("a", "b", "na", "nb", "left", side("nb", "na").alias("right"))
    enough = F.size("left") - _differ(how, F.col("na"), F.col("nb"))
    near = written(right.filter(F.size(F.array_intersect("left", "right")) >= enough).select("a", "b").distinct())
    both = F.col("both")
    return _common(near, tokens).filter(how.den * both >= how.num * (F.col("size_a") + F.col("size_b") - both)).select("a", "b")


def _fitting(pairs: DataFrame, how: Similarity) -> DataFrame:
    """Pairs (a, b) whose sizes (na, nb) allow a link."""
    return pairs.filter(how.den * F.least("na", "nb") >= how.num * F.greatest("na", "nb"))


def links(docs: DataFrame, sets: DataFrame, how: Similarity, doc_id: str, text: str) -> DataFrame:
    """Edges (a, b) of nodes whose components are those of all links.

    1. Blocks that more than one set has are found by counting, and sets that
       share too few of theirs for any link are left out.
    2. Every shared block proposes the link between its most central set, the
       one whose blocks are shared most, and each other set: as many proposals
       as rows, however large a group of near copies is. Proposals are checked
       on the whole sets; linked stars form groups.
    3. Where sets of different groups still share a block, each set keeps its
       least shared blocks, as many as two linked sets need to meet. The tokens of all
       these sets, and of the central sets of their blocks, are put into the
       matrix with the number of their holders. A
       token that one set holds alone is in no other set's overlap with it. With
       ``alone`` such tokens, and ``away`` other tokens by which a set and the
       block's central set differ, two sets of the block differ in at least
       alone + alone' + |away - away'| tokens, by the triangle inequality. A set
       whose least sum over its block is more than a link allows asks nobody;
       the others are compared with the sets of other groups for which the sum
       allows a link, and with it alone + alone' + the bits by which the parity
       marks of their other tokens differ. So no link between groups is missed,
       links inside a group cannot change the components, and copies with many
       different changes are not paired with each other, also when what they
       changed are places that others have changed as well.
    """
    blocks = block_table(docs, how, text)
    # Written first, so that the two shuffles of all blocks are not on disk at once.
    counts = written(blocks.groupBy("block").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("block"))
    shared = join_back(blocks, counts, ["block"]).distinct()
    shared = written(shared)
    for _ in range(2):
        # Sets that share too few blocks with all others together link with none; without them others may share too few.
        sizes = shared.groupBy("block").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
        shared = join_back(shared, sizes, ["block"])
        able = shared.groupBy("node", "code").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") >= F.shiftright("code", 1))
        shared = written(shared.join(able.select("node", "code"), ["node", "code"], "left_semi").select("block", "node", "code"))
    sizes = shared.groupBy("block").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = written(join_back(shared, sizes, ["block"]))
    size_of = sets.filter("node IS NOT NULL").groupBy("node").agg(F.first("n_shingles").alias("n"), F.min("doc_id").alias("doc_id"))
    score = written(
        shared.groupBy("node").agg(F.sum("c").alias("score")).join(size_of, "node")
    )
    rows = written(shared.join(score.select("node", "score", "n"), "node"))
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    picked = semi_by_id(named, score.select("doc_id").distinct(), "doc_id").union(named.filter("doc_id IS NULL"))
    # Rows that repeat an id may bring a set twice, or sets that are not asked for; neither changes a link.
    tokens = written(token_table(picked, how, "text"))
    centers = rows.groupBy("block").agg(F.max(F.struct("score", "n", "node")).alias("x"))
    centers = centers.select("block", F.col("x.node").alias("a"), F.col("x.n").alias("na"))
    stars = join_back(rows.select("block", F.col("node").alias("b"), F.col("n").alias("nb")), centers, ["block"])
    stars = _fitting(stars.filter("a <> b"), how).select("a", "b", "na", "nb").distinct()
    edges = written(_linked(written(stars), tokens, how))

    # Groups: the components so far; a set without a link is a group of its own.
    groups = components(edges)
    grouped = rows.join(groups, "node", "left").withColumn("grp", F.coalesce("label", "node")).drop("label", "score")
    split = grouped.groupBy("block").agg(F.min("grp").alias("lo"), F.max("grp").alias("hi")).filter("lo <> hi").select("block")
    open_rows = join_back(grouped, split, ["block"])
    # Two sets that link share as many blocks as either needs, so they meet among the least shared ones of both.
    own = Window.partitionBy("node", "code")
    ranked = open_rows.withColumn("spare", F.count(F.lit(1)).over(own) - F.shiftright("code", 1))
    ranked = ranked.withColumn("place", F.row_number().over(own.orderBy("c", "block")))
    open_rows = written(ranked.filter(F.col("place") <= F.col("spare") + 1).select("block", "node", "grp", "n").distinct())
    if open_rows.isEmpty():
        return edges
    # The matrix: how many of these sets hold a token. What a set holds alone is outside the union of all others.
    placed = written(join_back(open_rows, centers, ["block"]))
    nodes = written(placed.select("node").union(placed.select("a")).distinct())
    matrix = (
        tokens.join(nodes, "node", "left_semi").select("node", F.explode("tokens").alias("token"))
        .groupBy("token").agg(F.count(F.lit(1)).alias("holders"), F.min("node").alias("node"))
    )
    marks = [f"m{i}" for i in range(MARK_WORDS)]
    alone = written(
        matrix.filter("holders = 1").groupBy("node")
        .agg(F.count(F.lit(1)).alias("alone"), *[F.bit_xor(_mark(F.col("token"), i)).alias(f"a_{m}") for i, m in enumerate(marks)])
    )
    whole = tokens.join(nodes, "node", "left_semi").groupBy("node").agg(*[F.first(m).alias(m) for m in marks])
    rest = written(
        whole.join(alone, "node", "left").select("node", *[F.col(m).bitwiseXOR(F.coalesce(f"a_{m}", F.lit(0))).alias(m) for m in marks])
    )
    common = written(_common(placed.select("a", F.col("node").alias("b")).distinct(), tokens).withColumnRenamed("b", "node").distinct())
    placed = placed.join(common, ["a", "node"]).join(alone.select("node", "alone"), "node", "left").join(rest, "node")
    placed = placed.join(alone.select(F.col("node").alias("a"), F.col("alone").alias("a_alone")), "a", "left").fillna(0, ["alone", "a_alone"])
    away = F.when(F.col("a") == F.col("node"), 0).otherwise(F.col("n") + F.col("na") - 2 * F.col("both") - F.col("alone") - F.col("a_alone"))
    placed = written(placed.select("block", "node", "grp", "n", "alone", away.alias("away"), *marks))
    nearest = placed.groupBy("block").agg(F.min(F.col("alone") - F.col("away")).alias("nearest"))
    largest = F.floor(F.col("n") * how.den / how.num)
    asking = join_back(placed, nearest, ["block"]).filter(F.col("alone") + F.col("away") + F.col("nearest") <= _differ(how, F.col("n"), largest))
    asking = asking.select("block", *[F.col(c).alias(f"q_{c}") for c in ("node", "grp", "n", "alone", "away", *marks)])
    bits = sum((F.bit_count(F.col(f"q_{m}").bitwiseXOR(F.col(m))) for m in marks[1:]), F.bit_count(F.col(f"q_{marks[0]}").bitwiseXOR(F.col(marks[0]))))
    apart = F.col("q_alone") + F.col("alone") + F.greatest(F.abs(F.col("q_away") - F.col("away")), bits)
    fits = how.den * F.least("n", "q_n") >= how.num * F.greatest("n", "q_n")
    meet = (asking["block"] == placed["block"]) & (F.col("q_grp") != F.col("grp")) & fits & (apart <= _differ(how, F.col("q_n"), F.col("n")))
    pairs = asking.join(placed, meet).select(
        F.least("q_node", "node").alias("a"), F.greatest("q_node", "node").alias("b"),
        F.when(F.col("q_node") < F.col("node"), F.col("q_n")).otherwise(F.col("n")).alias("na"),
        F.when(F.col("q_node") < F.col("node"), F.col("n")).otherwise(F.col("q_n")).alias("nb"),
    )
    return edges.union(_linked(written(pairs.distinct()), tokens, how))


def jaccard_groups(
    docs: DataFrame, how: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable by links, itself
    included. Equal sets are one node, so copies cost one row per task. Texts
    without words have no shingles and are linked with nothing; a NULL
    ``doc_id`` takes part, and gets the smallest id of its component, if any.
    Extra columns are not touched. Texts are read once for the sets, twice for
    their blocks and once more for the sets that share a block; only 64-bit
    keys are shuffled for all documents.
    """
    sets, named = _labelled(docs, how, doc_id, text)
    ids = named.groupBy("label").agg(F.min("least").alias("component_id"))
    of_node = join_back(named.select("node", "label"), ids, ["label"]).select("node", "component_id")
    joined = sets.join(written(of_node), "node", "left")
    return joined.select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _labelled(docs: DataFrame, how: Similarity, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The table of sets, and ``node``, ``least`` (its smallest id) and ``label`` (of its component) for every set."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    sets = written(set_table(rows, how, "doc_id", "text"))
    edges = links(rows, sets, how, "doc_id", "text")
    labels = components(written(edges))
    named = sets.filter("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"))
    return sets, written(named.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))


def _with_node(rows: DataFrame, how: Similarity, text: str, name: str) -> DataFrame:
    """All columns and the key of the set of each row, as in ``set_table``."""
    schema = rows.withColumn(name, F.lit(None).cast("bigint")).schema

    def scan(batches):
        for b in batches:
            keys = [set_key(s) if len(s) else None for s in shingle_sets(b.column(b.num_columns - 1), how.n)]
            yield pa.record_batch([*b.columns[:-1], pa.array(keys, pa.int64())], names=[*b.schema.names[:-1], name])

    return rows.select(*[F.col(f"`{c}`") for c in rows.columns], F.col(f"`{text}`").cast("string").alias(name)).mapInArrow(scan, schema)


def drop_near_copies(docs: DataFrame, how: Similarity = Similarity(), doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group, the one with the smallest id; a NULL id comes before all others.

    Of rows with that id the one with the smallest key of its set stays, and of
    those that have one set as well the one with the smallest text. Rows without
    words are in no group and stay. Ids of which all rows go are dropped by the
    id alone; only rows of ids that go in part are looked at by their sets.
    """
    sets, named = _labelled(docs, how, doc_id, text)
    keys = sets.filter("node IS NOT NULL").groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("n"))
    keys = written(join_back(keys, named.select("node", "label"), ["node"]))
    first = keys.groupBy("label").agg(F.min(F.struct("doc_id", "node")).alias("first"), F.sum("n").alias("all")).filter("all > 1")
    grouped = join_back(keys, first.select("label", F.col("first.node").alias("f_node"), F.col("first.doc_id").alias("f_id")), ["label"])
    stays = (F.col("node") == F.col("f_node")) & F.col("doc_id").eqNullSafe(F.col("f_id"))
    going = written(grouped.withColumn("stays", stays).filter(~stays | (F.col("n") > 1)).select("doc_id", "node", "n", "stays"))
    per_id = going.groupBy("doc_id").agg(F.sum(F.when(F.col("stays"), 0).otherwise(F.col("n"))).alias("gone"))
    total = sets.groupBy(F.col("doc_id").alias("t_id")).agg(F.count(F.lit(1)).alias("total"))
    per_id = written(per_id.join(total, F.col("doc_id").eqNullSafe(F.col("t_id"))).select("doc_id", (F.col("gone") == F.col("total")).alias("whole")))
    whole = per_id.filter("whole AND doc_id IS NOT NULL").select(F.col("doc_id").alias(doc_id))
    part = written(per_id.filter("NOT whole OR doc_id IS NULL").select(F.col("doc_id").alias(doc_id)))
    kept = semi_by_id(docs, whole, doc_id, "left_anti").select(docs.columns)
    if part.isEmpty():
        return kept
    node, state, p_id = "__near_node", "__near_stays", "__near_id"
    part = part.withColumnRenamed(doc_id, p_id)
    same_id = F.col(f"`{doc_id}`").eqNullSafe(F.col(p_id))
    others = kept.join(part, same_id, "left_anti")
    asked = written(_with_node(kept.join(part, same_id, "left_semi"), how, text, node))
    marks = going.select(F.col("doc_id").alias(p_id), F.col("node").alias("__near_key"), F.col("stays").alias(state))
    marked = asked.join(marks, same_id & (F.col(node) == F.col("__near_key")), "left")
    alone = marked.filter(F.col(state).isNull()).select(docs.columns)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = marked.filter(state).groupBy(F.col(f"`{doc_id}`").alias(p_id), node).agg(F.min_by(row, F.struct(F.col(f"`{text}`"))).alias("row"))
    return others.unionByName(alone).unionByName(one.select("row.*"))
