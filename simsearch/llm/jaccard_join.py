"""Documents linked by the Jaccard similarity of their word n-grams: a prefix-tree join.

1. Documents with one and the same set are one class; a class is one node.
2. A set that shares too few n-grams with all others has no link. A count-min
   sketch tells which n-grams may occur twice; a node keeps those, if enough.
3. The n-grams of the nodes left are ordered by the number of nodes that hold
   them, rarest first. Two linked sets then have one n-gram in common among the
   first few of either (the prefix); those groups name the pairs to look at.
4. Sets to be compared with one set are stored in a trie, in the global order.
   The walk shares the overlap of common beginnings and leaves a subtree once
   what remains cannot reach the overlap needed.
5. Links become components by contraction. A group of many nodes is not paired
   out: its first node meets all others, then more and more leaders meet those
   that are not yet in their component, until none is left or all have led. A
   pair is skipped if one of the two is linked to a hub that is far from the
   other (Jaccard distance is a metric), so a thousand near copies cost little
   more than a thousand comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from simsearch.llm import sketch
from simsearch.llm.components import contract
from simsearch.llm.rows import KEY, attach, one_of_twins, with_key, without
from simsearch.llm.texts import list_column, pieces
from simsearch.llm.words import Words, mix
from simsearch.plans.storage import Scratch, materialize

NGRAM, PERCENT = 4, 85
# Groups of prefix n-grams up to this size are paired out; leaders of larger ones at first.
PAIRED = 16
# N-grams of the sets that one task compares with one other set.
TRIE_SIZE = 1 << 16
_STEP = 64
_OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
LINK, NEAR, FAR = 2, 1, 0


def ngram_sets(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes row after row, in ascending order, and their number per row.

    A row with fewer words than ``n`` has its whole sequence as the only one.
    """
    fits = words.fits(n)
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    values = np.concatenate([words.runs(hashes, n)[fits], words.whole(hashes)[short]])
    rows = np.concatenate([words.rows[fits], short])
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], np.bincount(rows[new], minlength=len(words.counts))


def _sum_by_row(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    ends = np.cumsum(counts)
    return (sums[ends] - sums[ends - counts]).view(np.int64)


def _sets(batches: Iterator[pa.RecordBatch], n: int):
    for batch in pieces(batches):
        words = Words(batch.column("text"), lower=True)
        yield batch, *ngram_sets(words, words.hashes(), n)


def _facts(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values, counts in _sets(batches, n):
            columns = {c: batch.column(c) for c in batch.schema.names if c != "text"}
            yield pa.RecordBatch.from_pydict(columns | {
                "n": pa.array(counts, pa.int64()),
                "f1": pa.array(_sum_by_row(mix(values), counts)),
                "f2": pa.array(_sum_by_row(mix(values ^ _OTHER), counts)),
            })

    return run


def _sketch(n: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sketch.sketched((values for _, values, _ in _sets(batches, n)), bits, 1)

    return run


def least_overlap(n, percent: int):
    """Fewest n-grams that a set of n shares with any set it is linked to."""
    return -(-percent * n // 100)


def _survivors(n: int, percent: int, repeated):
    """Sets that share enough with others, by the n-grams that may occur twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values, counts in _sets(batches, n):
            shared = repeated.value(values)
            row = np.repeat(np.arange(len(counts)), counts)
            number = np.bincount(row[shared], minlength=len(counts))
            stay = (number >= least_overlap(counts, percent)) & (counts > 0)
            mask = pa.array(stay)
            yield pa.RecordBatch.from_pydict({
                "_k1": batch.column("_k1").filter(mask), "_k2": batch.column("_k2").filter(mask),
                "n": pa.array(counts[stay], pa.int64()),
                "grams": list_column(values[shared & stay[row]].view(np.int64), number[stay]),
            })

    return run


class Trie:
    """Sets in the global order as a trie, kept as sorted sequences with their common beginnings."""

    def __init__(self, sets: list[np.ndarray]):
        keys = [s.tobytes() for s in sets]
        self.order = sorted(range(len(sets)), key=keys.__getitem__)
        self.sets = [sets[i] for i in self.order]
        self.shared = [0]
        for a, b in zip(self.sets, self.sets[1:]):
            size = min(len(a), len(b))
            differ = np.flatnonzero(a[:size] != b[:size])
            self.shared.append(int(differ[0]) if len(differ) else size)

    def walk(self, query: np.ndarray, needed: list[int]) -> Iterator[tuple[int, int]]:
        """(number of a set, its overlap with the sorted ``query``) where that reaches ``needed``."""
        size = len(query)
        if not size:
            return
        overlaps, known = np.zeros(1, np.int64), 0  # of the first 0, 1, .. items of the path
        for place, (own, shared) in enumerate(zip(self.sets, self.shared)):
            least = needed[self.order[place]]
            known = min(known, shared)
            path = [overlaps[:known + 1]]
            overlap = int(overlaps[known])
            while known < len(own) and overlap + min(len(own) - known, size - overlap) >= least:
                some = own[known:known + _STEP]
                at = np.minimum(np.searchsorted(query, some), size - 1)
                path.append(overlap + np.cumsum(query[at] == some))
                overlap = int(path[-1][-1])
                known += len(some)
            overlaps = np.concatenate(path)
            if known == len(own) and overlap >= least:
                yield self.order[place], overlap


def _compare(percent: int, far: int):
    """Compare each hub with its members; rows of a hub come first, then its members'."""

    def judge(hub, members):
        _, size, grams = hub
        trie = Trie([g for _, _, g in members])
        sums = [size + n for _, n, _ in members]
        needed = [-(-far * s // (100 + far)) for s in sums]
        state = [FAR] * len(members)
        for i, overlap in trie.walk(np.sort(grams), needed):
            state[i] = LINK if (100 + percent) * overlap >= percent * sums[i] else NEAR
        return state

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hub, members = None, None, []
        out_a, out_b, out_state = [], [], []

        def done():
            if hub is not None and members:
                out_a.extend([hub[0]] * len(members))
                out_b.extend(m[0] for m in members)
                out_state.extend(judge(hub, members))

        for batch in batches:
            grams = batch.column("grams")
            for i, (a, part, node, n, first) in enumerate(zip(*(
                batch.column(c).to_pylist() for c in ("a", "part", "node", "n", "first")
            ))):
                row = (node, n, grams[i].values.to_numpy())
                if first:
                    done()
                    key, hub, members = (a, part), row, []
                elif key == (a, part):
                    members.append(row)
            yield pa.RecordBatch.from_pydict({
                "a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64()),
                "state": pa.array(out_state, pa.int32()),
            })
            out_a, out_b, out_state = [], [], []
        done()
        yield pa.RecordBatch.from_pydict({
            "a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64()),
            "state": pa.array(out_state, pa.int32()),
        })

    return run


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """State of every pair (a, b): LINK, NEAR or FAR; ``sets`` has node, n, grams in global order."""
    weight = sets.select(F.col("node").alias("b"), F.size("grams").alias("w"))
    sized = attach(pairs, weight, ["b"], "inner")
    hubs = sized.groupBy("a").agg(F.ceil(F.sum("w") / TRIE_SIZE).alias("parts"))
    hubs = materialize(hubs.withColumn("parts", F.greatest("parts", F.lit(1))), "hubs")
    asked = attach(pairs, hubs, ["a"], "inner").select(
        "a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), F.col("b").alias("node")
    )
    # Few sets are asked for, as a rule: these joins leave the others where they lie.
    members = attach(sets, asked, ["node"], "inner").select(
        "a", "part", "node", "n", "grams", F.lit(False).alias("first")
    )
    own = attach(sets.withColumnRenamed("node", "a"), hubs, ["a"], "inner").select(
        "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
        F.col("a").alias("node"), "n", "grams", F.lit(True).alias("first"),
    )
    # Jaccard distance d: a member within d of its hub, and another set beyond 2 d, are not linked.
    far = 2 * percent - 100
    judged = (
        own.unionByName(members).repartition("a", "part")
        .sortWithinPartitions("a", "part", F.col("first").desc())
        .mapInArrow(_compare(percent, far), "a long, b long, state int")
    )
    return materialize(judged, "judged")


def _may_link(percent: int):
    """Whether sets of n and n2 n-grams can be linked if these are the first they have in common.

    ``place`` and ``place2`` count what comes before in the global order, unique n-grams included.
    """
    needed = F.ceil((F.col("n") + F.col("n2")) * percent / (100 + percent))
    return (F.col("n") - F.col("place") >= needed) & (F.col("n2") - F.col("place2") >= needed)


def similar_components(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """Every row with its set's size and its component: doc_id, n_shingles, component_id.

    Reads ``doc_id, text``; other columns are ignored. Words are in lower case
    (A-Z). Two rows are linked if 100 times the intersection of their sets of
    distinct n-grams is at least ``percent`` times the union; component_id is
    the smallest doc_id that links reach. A row with fewer words than ``n`` has
    its whole sequence as set; without words its set is empty and it is linked
    to nothing. Repeated rows are linked. A null doc_id counts as the largest.
    An empty table gives no rows. Also returned: the row key and ``component``, a
    number per component (null for empty sets) that does without ids.
    """
    texts = with_key(docs.select("doc_id", "text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    facts = materialize(
        texts.select(*KEY, "doc_id", "text").mapInArrow(
            _facts(n), f"_k1 long, _k2 long, doc_id {id_type}, n long, f1 long, f2 long"
        ),
        "facts",
    )
    same = ["n", "f1", "f2"]
    classes = facts.where("n > 0").groupBy(*same).agg(
        F.min("doc_id").alias("least"), F.min(F.struct(*KEY)).alias("one"), F.count("*").alias("rows")
    )
    classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    nodes = _candidates(texts.select(*KEY, "text"), facts, classes, n, percent)
    labels = materialize(nodes.select("node", F.col("node").alias("comp")), "labels")
    labels = _linked(nodes, labels, percent)

    roots = attach(classes.select("node", "least"), labels, ["node"], "inner")
    roots = materialize(
        attach(roots, roots.groupBy("comp").agg(F.min("least").alias("root")), ["comp"], "inner")
        .select("node", "root", "comp"),
        "roots",
    )
    found = facts.join(classes.select(*same, "node", "least"), same, "left")
    return attach(found, roots, ["node"]).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.coalesce("root", "least", "doc_id").alias("component_id"),
        F.coalesce("comp", "node").alias("component"), *KEY,
    )


def _candidates(texts, facts, classes, n: int, percent: int) -> DataFrame:
    """Nodes that may have links: node, n, grams (those held by two nodes or more, rarest first)."""
    spark = texts.sparkSession
    several = classes.where("rows > 1").select("n", "f1", "f2", "one")
    others = facts.join(several, ["n", "f1", "f2"]).where(
        "_k1 <> one._k1 or _k2 <> one._k2"
    ).select(*KEY).distinct()
    single = attach(texts, materialize(others, "others"), KEY, "left_anti")

    total = classes.agg(F.sum("n")).first()[0] or 0
    bits = sketch.width_bits(total, 1)
    merged = sketch.merged(single.mapInArrow(_sketch(n, bits), sketch.PARTS), bits, 1)
    repeated = spark.sparkContext.broadcast(merged)
    kept = single.mapInArrow(
        _survivors(n, percent, repeated), "_k1 long, _k2 long, n long, grams array<long>"
    )
    kept = materialize(kept, "survivors")
    repeated.destroy()
    if not kept.groupBy(*KEY).count().where("count > 1").isEmpty():
        kept = kept.dropDuplicates(KEY)
    names = classes.select(F.col("one._k1").alias("_k1"), F.col("one._k2").alias("_k2"), "node")
    names = materialize(attach(names, kept.select(*KEY), KEY, "left_semi"), "names")
    kept = materialize(attach(kept, names, KEY, "inner").select("node", "n", "grams"), "kept")

    held = kept.select("node", F.explode("grams").alias("gram"))
    frequency = materialize(
        held.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1"), "frequency"
    )
    ordered = held.join(frequency, "gram").groupBy("node").agg(
        F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("grams")
    )
    ordered = attach(ordered, kept.select("node", "n"), ["node"], "inner")
    enough = F.size("grams") * 100 >= F.col("n") * percent
    return materialize(ordered.where(enough).select("node", "n", F.col("grams.gram").alias("grams")), "nodes")


def _linked(nodes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``labels`` with the components of all linked nodes joined."""
    unique = F.col("n") - F.size("grams")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - unique
    members = nodes.select(
        "node", "n", unique.alias("unique"), F.posexplode(F.slice("grams", F.lit(1), prefix.cast("int")))
    ).select("node", "n", "unique", (F.col("unique") + F.col("pos")).alias("place"), F.col("col").alias("gram"))
    # The set with the fewest n-grams of its own leads: the likeliest origin of the others.
    groups = members.groupBy("gram").agg(
        F.count("*").alias("size"), F.min(F.struct("unique", "node", "n", "place")).alias("lead")
    )
    members = materialize(
        members.drop("unique").join(materialize(groups.where("size > 1"), "groups"), "gram"), "members"
    )

    small = members.where(F.col("size") <= PAIRED).select("gram", "node", "n", "place")
    other = small.select("gram", *[F.col(c).alias(f"{c}2") for c in ("node", "n", "place")])
    pairs = small.join(other, "gram").where(F.col("node") < F.col("node2")).where(_may_link(percent))
    led = members.where((F.col("size") > PAIRED) & (F.col("node") != F.col("lead.node"))).withColumns(
        {"node2": F.col("lead.node"), "n2": F.col("lead.n"), "place2": F.col("lead.place")}
    ).where(_may_link(percent))
    pairs = pairs.select(F.col("node").alias("a"), F.col("node2").alias("b")).unionByName(
        led.select(F.col("node2").alias("a"), F.col("node").alias("b"))
    )
    scratch = Scratch(nodes.sparkSession)
    judged = verify(scratch.table(pairs.distinct(), "pairs"), nodes, percent)
    labels = contract(labels, judged.where(F.col("state") == LINK))
    # Hubs: a node's is one it is linked to; those known to be far from a node.
    hubs = materialize(
        judged.where(F.col("state") == LINK).groupBy(F.col("b").alias("node")).agg(F.min("a").alias("hub")),
        "hubs",
    )
    far = judged.where(F.col("state") == FAR).select(F.col("a").alias("hub"), F.col("b").alias("node"))

    large = scratch.table(members.where(F.col("size") > PAIRED).drop("lead"), "large")
    leaders = PAIRED
    while True:
        scratch.keep(large)
        leaders *= 4
        named = attach(large, labels, ["node"], "inner")
        mixed = named.groupBy("gram").agg((F.min("comp") != F.max("comp")).alias("mixed"))
        mixed = scratch.table(mixed.where("mixed").select("gram"), "mixed")
        if mixed.isEmpty():
            return labels
        named = scratch.table(attach(named, mixed, ["gram"], "inner"), "named")
        leads = F.pmod(F.xxhash64("gram", "node"), F.col("size")) < leaders
        first = named.where(leads).select(
            "gram", F.col("node").alias("a"), F.col("comp").alias("ca"), F.col("n").alias("n2"),
            F.col("place").alias("place2"),
        )
        pairs = attach(named, first, ["gram"], "inner").where("comp <> ca").where(_may_link(percent))
        pairs = scratch.table(
            pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct(),
            "pairs",
        )
        for one, two in (("a", "b"), ("b", "a")):
            near = attach(pairs, hubs.select(F.col("node").alias(one), "hub"), [one])
            pairs = near.join(far.withColumnRenamed("node", two), ["hub", two], "left_anti").select("a", "b")
        judged = verify(scratch.table(pairs, "pairs"), nodes, percent)
        labels = contract(labels, judged.where(F.col("state") == LINK))
        large = scratch.table(named.where(F.col("size") > leaders).drop("comp"), "large")


def drop_similar(docs: DataFrame, n: int = NGRAM, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id, of equal ones any.

    All columns stay as they are; rows without words are in no component and stay.
    """
    found = materialize(similar_components(docs, n, percent), "components")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *KEY)
    one = materialize(found.groupBy("component").agg(F.min(first).alias("one")), "kept")
    rest = attach(found, one, ["component"], "inner").where("_k1 <> one._k1 or _k2 <> one._k2")
    kept = without(docs, materialize(rest.select(*KEY), "dropped"))
    twins = found.where("n_shingles > 0").groupBy(*KEY).count().where("count > 1")
    return one_of_twins(kept, materialize(twins.select(*KEY), "twins"))
