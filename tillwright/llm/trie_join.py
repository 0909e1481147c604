"""Documents with similar sets of word shingles, by a prefix-tree join.

All shingles have one global order, rare ones first. Two sets that are similar enough share
a shingle among the first ones of each, so such shared shingles bring documents together.
Within a group the ordered sets form a trie, whose branches hold runs of shingles; a set
walks down the trie counting its overlap with all sets of a branch at once, and leaves a
branch when what remains of both sides can no longer reach the overlap that is needed.

Only what changes the components is compared: sets that are known to be connected are
passed over, first within the largest group of each set, then between the components that
meet in a group, at last between all sets of groups that still hold several components.
Before texts are moved, sizes and short sketches rule out groups without any similar pair.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwright.llm.common import Forest, small_side, staged
from tillwright.llm.components import components
from tillwright.llm.shingles import Shingler, fingerprint

WEIGHT_BITS = 20
SEGMENT = 4096
POSTINGS_PER_BUCKET = 2_000_000
HOT_WEIGHT = 100_000
GROUP = 1024
#: A sketch has a power of two of buckets, at most so many, of four to eight shingles each.
LEAST_BUCKETS, MOST_BUCKETS = 16, 4096

DESCRIBED = "doc_id long, class long, n_shingles long, segment int, counts binary"
POSTED = "bucket int, keys binary, classes binary"
SKETCHED = "class long, text string, size long, sketch binary"
PROMISING = "key long, i long, j long, class long, label long"
MEMBERS = "key long, class long, n long"


@dataclass(frozen=True)
class Similarity:
    """Links: ``scale * |intersection| >= least * |union|``."""

    least: int = 85
    scale: int = 100

    def overlap(self, a, b):
        """The smallest intersection of linked sets of these sizes."""
        return -(-self.least * (a + b) // (self.scale + self.least))

    def prefix(self, size: int) -> int:
        return size + (-self.least * size // self.scale) + 1


def _describe(size: int):
    """Class and size of every set, and at the end how often each shingle bucket occurred."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, counts = Shingler(size), np.zeros(1 << WEIGHT_BITS, np.int32)
        names = [part.split()[0] for part in DESCRIBED.split(", ")]
        for batch in batches:
            classes, sizes = [], []
            for text in batch.column(1).to_pylist():
                shingles = shingler.set_of(text)
                classes.append(fingerprint(shingles) if len(shingles) else None)
                sizes.append(len(shingles))
                np.add.at(counts, shingles >> np.uint64(64 - WEIGHT_BITS), 1)
            empty = pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())
            columns = [batch.column(0), pa.array(classes, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *empty], names=names)
        rows = counts.reshape(-1, SEGMENT)
        used = np.flatnonzero(rows.any(axis=1))
        empty = [pa.nulls(len(used), pa.int64())] * 3
        blobs = pa.array([rows[i].tobytes() for i in used], pa.binary())
        yield pa.RecordBatch.from_arrays([*empty, pa.array(used, pa.int32()), blobs], names=names)

    return run


def _add_counts(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(blob, np.int32).astype(np.int64) for blob in table["counts"].to_pylist())
    return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "counts": [total.tobytes()]})


def _weights(described: DataFrame) -> np.ndarray:
    """Occurrences by shingle bucket over all documents: a table of fixed size."""
    parts = described.where("segment IS NOT NULL").select("segment", "counts")
    summed = parts.groupBy("segment").applyInArrow(_add_counts, "segment int, counts binary")
    total = np.zeros(((1 << WEIGHT_BITS) // SEGMENT, SEGMENT), np.int64)
    for row in summed.collect():
        total[row["segment"]] = np.frombuffer(row["counts"], np.int64)
    return total.reshape(-1)


def _ordered(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """A set in the global order: by weight of the bucket, then by hash."""
    return shingles[np.argsort(weights[shingles >> np.uint64(64 - WEIGHT_BITS)], kind="stable")]


def _post(size: int, similar: Similarity, weights, buckets: int):
    """The first shingles of every set as packed postings, by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, table, seen = Shingler(size), weights.value, set()
        keys, classes = [], []

        def packed() -> pa.RecordBatch:
            key, owner = np.concatenate(keys), np.repeat([c for c, _ in classes], [n for _, n in classes])
            keys.clear(), classes.clear()
            bucket = (key % np.uint64(buckets)).astype(np.int32)
            hot = table[key >> np.uint64(64 - WEIGHT_BITS)] >= HOT_WEIGHT
            bucket[hot] = -1 - (owner[hot] % buckets)
            order = np.lexsort((key, bucket))
            bucket, key, owner = bucket[order], key[order], owner[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=bucket[0] - 1))
            spans = list(zip(cuts, [*cuts[1:], len(bucket)], strict=True))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket[cuts], pa.int32()),
                    pa.array([key[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([owner[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                names=["bucket", "keys", "classes"],
            )

        waiting = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                shingles = shingler.set_of(text)
                if not len(shingles) or (own := fingerprint(shingles)) in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(own)
                first = _ordered(shingles, table)[: similar.prefix(len(shingles))]
                keys.append(first), classes.append((own, len(first)))
                waiting += len(first)
                if waiting >= POSTINGS_PER_BUCKET // 2:
                    yield packed()
                    waiting = 0
        if waiting:
            yield packed()

    return run


def _shared(weights):
    """Members of the keys that several classes have; of keys with the same members one."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        keys = np.frombuffer(b"".join(table["keys"].to_pylist()), np.uint64)
        owners = np.frombuffer(b"".join(table["classes"].to_pylist()), np.int64)
        order = np.lexsort((owners, keys))
        keys, owners = keys[order], owners[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
        keys, owners = keys[fresh], owners[fresh]
        cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
        sizes = np.diff(np.append(cuts, len(keys)))
        if key[0].as_py() < 0:
            # Keys that are hot by weight are spread over buckets and always kept.
            n = weights.value[keys >> np.uint64(64 - WEIGHT_BITS)]
            kept = np.ones(len(keys), bool)
        else:
            spread = owners.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            same = np.stack([np.add.reduceat(spread ^ (spread >> np.uint64(29)), cuts), sizes.astype(np.uint64)], axis=1)
            _, first = np.unique(same, axis=0, return_index=True)
            alone = np.zeros(len(cuts), bool)
            alone[first] = True
            kept = np.repeat(alone & (sizes > 1), sizes)
            n = np.repeat(sizes, sizes)
        return pa.table({"key": keys[kept].view(np.int64), "class": owners[kept], "n": n[kept].astype(np.int64)})

    return run


@dataclass
class Node:
    """A run of shingles that all sets below share, and the sets that end with it."""

    run: np.ndarray
    depth: int
    children: list[Node] = field(default_factory=list)
    sets: list[int] = field(default_factory=list)
    least: int = 0
    most: int = 0


def build_trie(sets: list[np.ndarray]) -> Node:
    """The sets, as ascending ranks in the global order, in a trie of compressed runs."""

    def grow(members: list[int], depth: int, run: np.ndarray) -> Node:
        # Members agree on everything before ``depth``; ``run`` ends there.
        node = Node(run, depth - len(run))
        sizes = [len(sets[m]) for m in members]
        node.least, node.most = min(sizes), max(sizes)
        node.sets = [m for m in members if len(sets[m]) == depth]
        branches: dict[int, list[int]] = {}
        for m in members:
            if len(sets[m]) > depth:
                branches.setdefault(int(sets[m][depth]), []).append(m)
        pending.extend((node, own, depth) for own in branches.values())
        return node

    pending: list[tuple[Node, list[int], int]] = []
    root = grow(list(range(len(sets))), 0, np.empty(0, np.int64))
    while pending:
        parent, members, depth = pending.pop()
        first = sets[members[0]]
        end = len(first)
        for m in members[1:]:
            width = min(end, len(sets[m]))
            differs = np.flatnonzero(first[depth:width] != sets[m][depth:width])
            end = depth + int(differs[0]) if len(differs) else width
        parent.children.append(grow(members, end, first[depth:end]))
    return root


def trie_links(sets: list[np.ndarray], known: list[int], similar: Similarity) -> list[tuple[int, int]]:
    """Links that join what ``known`` (a component number per set) leaves apart.

    Returns a spanning forest over those components: pairs of sets that are linked.
    """
    numbers = {x: i for i, x in enumerate(dict.fromkeys(known))}
    component = [numbers[x] for x in known]
    forest, links = Forest(len(numbers)), []
    if len(numbers) < 2:
        return links
    vocabulary = int(max(s[-1] for s in sets)) + 1
    held = np.zeros(vocabulary, bool)
    root = build_trie(sets)
    apart, waiting = len(numbers), set(range(len(sets)))
    # A pair is settled once one of its sets has walked the trie or both are connected, so
    # the walks end when all sets that still wait are in one component.
    while len(roots := Counter(forest.find(component[i]) for i in waiting)) > 1:
        common = roots.most_common(1)[0][0]
        q = next(i for i in waiting if forest.find(component[i]) != common)
        waiting.remove(q)
        own = sets[q]
        held[own] = True
        todo = [(root, 0)]
        while todo and apart > 1:
            node, overlap = todo.pop()
            if node.most * similar.scale < len(own) * similar.least or node.least * similar.least > len(own) * similar.scale:
                continue
            needed = similar.overlap(len(own), max(node.least, -(-len(own) * similar.least // similar.scale)))
            depth = node.depth
            # Long runs are read in steps, with the bound checked after each.
            at, width, lost = 0, 32, False
            while at < len(node.run):
                part = node.run[at : at + width]
                overlap += int(np.count_nonzero(held[part]))
                at += len(part)
                rest = len(own) - int(np.searchsorted(own, part[-1], "right"))
                if overlap + min(rest, node.most - depth - at) < needed:
                    lost = True
                    break
                width *= 4
            if lost:
                continue
            for other in node.sets:
                if (
                    forest.find(component[other]) != forest.find(component[q])
                    and overlap >= similar.overlap(len(own), len(sets[other]))
                ):
                    forest.union(component[other], component[q])
                    links.append((q, other))
                    apart -= 1
            todo += [(child, overlap) for child in node.children]
        held[own] = False
    return links


def sketch(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each bucket, at most 255, in buckets that grow in number
    with the set."""
    width = LEAST_BUCKETS
    while width < MOST_BUCKETS and width * 8 < len(shingles):
        width *= 2
    counts = np.bincount((shingles & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


class Sketches:
    """Sketches of many sets. Two are compared by the buckets of the narrower one, into which
    the wider one is folded; they never differ by more than their sets do."""

    def __init__(self, blobs: list[bytes]):
        self.widths = np.array([len(blob) for blob in blobs])
        self.levels = {}
        for width in np.unique(self.widths).tolist():
            own = np.flatnonzero(self.widths >= width)
            rows = np.full(len(blobs), -1)
            rows[own] = np.arange(len(own))
            folded = np.empty((len(own), width), np.int16)
            for at, i in enumerate(own):
                counts = np.frombuffer(blobs[i], np.uint8)
                if len(counts) > width:
                    counts = np.minimum(counts.reshape(-1, width).sum(axis=0, dtype=np.int64), 255)
                folded[at] = counts
            self.levels[width] = rows, folded

    def apart(self, i: int, others: np.ndarray) -> np.ndarray:
        """By how much the sketch of ``i`` differs from each of ``others``."""
        shared = np.minimum(self.widths[others], self.widths[i])
        found = np.empty(len(others), np.int64)
        for width in np.unique(shared).tolist() if len(self.levels) > 1 else self.levels:
            rows, folded = self.levels[width]
            at = shared == width
            found[at] = np.abs(folded[rows[others[at]]] - folded[rows[i]]).sum(axis=1)
        return found


def _sketch(size: int):
    """Size and sketch of the set of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            sizes, sketches, own = [], [], []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                shingles = shingler.set_of(text)
                # Another text under the same id is not of this class.
                own.append(bool(len(shingles)) and fingerprint(shingles) == number)
                sizes.append(len(shingles))
                sketches.append(sketch(shingles))
            made = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())],
                names=["class", "text", "size", "sketch"],
            )
            yield made.filter(pa.array(own, pa.bool_()))

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: int, columns: int) -> Iterator[tuple[list, dict]]:
    """Rows sorted by their first ``keys`` columns, as one group at a time by class."""
    group, rows = None, {}
    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(columns)], strict=True):
            key = row[:keys]
            if key != group:
                if len(rows) > 1:
                    yield group, rows
                group, rows = key, {}
            rows[row[keys]] = row[keys + 1 :]
    if len(rows) > 1:
        yield group, rows


def _promising(similar: Similarity):
    """Of each group the classes that sizes and sketches leave a partner of another label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, rows in _groups(batches, 3, 7):
            classes = np.array(list(rows), np.int64)
            labels = np.array([row[0] for row in rows.values()], np.int64)
            sizes = np.array([row[1] for row in rows.values()], np.int64)
            sketches = Sketches([row[2] for row in rows.values()])
            kept = np.zeros(len(classes), bool)
            for i in range(len(classes)):
                others = np.flatnonzero(labels[i + 1 :] != labels[i]) + i + 1
                both = sizes[i] + sizes[others]
                room = both - 2 * similar.overlap(sizes[i], sizes[others])
                alike = abs(sizes[others] - sizes[i]) <= room
                if not alike.any():
                    continue
                others, room = others[alike], room[alike]
                near = others[sketches.apart(i, others) <= room]
                if len(near):
                    kept[i] = kept[near] = True
            if kept.any():
                count = int(kept.sum())
                columns = [pa.array([x] * count, pa.int64()) for x in group]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(classes[kept]), pa.array(labels[kept])],
                    names=["key", "i", "j", "class", "label"],
                )

    return run


def _link(size: int, similar: Similarity, weights):
    """Spanning links of each group in rows sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, table = Shingler(size), weights.value
        for _, rows in _groups(batches, 3, 6):
            classes = list(rows)
            ordered = [_ordered(shingler.set_of(text), table) for _, text in rows.values()]
            everything = _ordered(np.unique(np.concatenate(ordered)), table)
            # Ranks in the global order, looked up by hash.
            by_hash = np.argsort(everything)
            sets = [by_hash[np.searchsorted(everything[by_hash], s)] for s in ordered]
            found = trie_links(sets, [label for label, _ in rows.values()], similar)
            ends = [[classes[pair[i]] for pair in found] for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in ends], names=["a", "b"])

    return run


def similar_documents(
    df: DataFrame,
    words: int = 4,
    least: int = 85,
    scale: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
    group: int = GROUP,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    A document's set holds its distinct shingles of ``words`` words; a shorter text is one
    shingle, an empty or null one has none and links with nothing. Two documents link when
    ``scale * |intersection| >= least * |union|``; ``component_id`` is the smallest id that
    can be reached. Rows with a null id link with nothing and have a null component; equal
    ids and repeated rows come back as often as they came. An empty table gives an empty
    result.

    Documents of equal sets are one class, compared once. The global order uses counts over
    all documents in a table of fixed size, broadcast (8 MB). Postings are packed by bucket of their key; buckets grow
    in number, not in size, and keys with a very high count are spread over them. A group
    never holds more than about ``group`` classes of a block, or two blocks of a pair.
    """
    similar = Similarity(least, scale)
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    described = staged(docs.mapInArrow(_describe(words), DESCRIBED), "shingle-sets")
    counts = _weights(described)
    weights = spark.sparkContext.broadcast(counts)
    described = described.where("segment IS NULL").select("doc_id", "class", "n_shingles")

    postings = int(counts.sum()) * (scale - least) // scale + 1
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), postings // POSTINGS_PER_BUCKET + 1)
    posted = docs.select("text").mapInArrow(_post(words, similar, weights, buckets), POSTED)
    members = staged(posted.groupBy("bucket").applyInArrow(_shared(weights), MEMBERS), "shingle-members")

    # The text of one document of each class that shares a key.
    reps = described.where("class IS NOT NULL AND doc_id IS NOT NULL").groupBy("class")
    reps = staged(reps.agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")), "shingle-classes")
    wanted = reps.join(members.select("class").distinct(), "class", "left_semi").select("class", "doc_id")
    wanted = staged(wanted, "shingle-wanted")
    texts = docs.join(small_side(wanted), "doc_id").select("class", "text")
    texts = staged(texts.mapInArrow(_sketch(words), SKETCHED), "shingle-texts")

    def linked(rows: DataFrame) -> DataFrame:
        """New links of ``rows(key, i, j, class, label)``."""
        group = [F.col(c).cast("long").alias(c) for c in ("key", "i", "j")]
        sketched = rows.join(texts.select("class", "size", "sketch").withColumnRenamed("size", "n"), "class")
        sketched = sketched.select(*group, "class", "label", "n", "sketch")
        dealt = sketched.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        near = staged(dealt.mapInArrow(_promising(similar), PROMISING), "shingle-near")
        with_text = texts.select("class", "text").join(small_side(near), "class").select(*near.columns, "text")
        dealt = with_text.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
        return staged(dealt.mapInArrow(_link(words, similar, weights), "a long, b long"), "shingle-links")

    def one_of_each_list(rows: DataFrame, *counted) -> DataFrame:
        """Of the keys with the same classes the smallest, with the number of classes."""
        lists = rows.groupBy("key").agg(
            F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("class").cast("decimal(20,0)")).alias("s"), *counted
        )
        return lists.groupBy("size", "s").agg(F.min("key").alias("key"), *[F.first(c).alias(c) for c in ("labels",) if counted])

    block = F.pmod(F.xxhash64("class"), F.ceil(F.col("size") / group)).cast("int")
    largest = members.groupBy("class").agg(F.max(F.struct("n", "key")).alias("best"))
    first = largest.select(F.col("best.key").alias("key"), F.col("best.n").alias("size"), "class", F.col("class").alias("label"))
    links = linked(first.withColumns({"i": block, "j": F.lit(0)}))

    def labelled(links: DataFrame) -> DataFrame:
        """Members of the keys in which several components meet."""
        joined = components(links)
        rows = members.join(joined.withColumnRenamed("id", "class"), "class", "left")
        rows = rows.select("key", "class", F.coalesce("component_id", "class").alias("label"))
        mixed_keys = rows.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
        return staged(rows.join(mixed_keys.select("key"), "key", "left_semi"), "shingle-mixed")

    mixed, done = labelled(links), None
    while True:
        reps_of = mixed.groupBy("key", "label").agg(F.min("class").alias("class"))
        lists = one_of_each_list(reps_of)
        if done is not None:
            # Only where a link has changed which members stand for their components.
            lists = lists.join(done, ["size", "s"], "left_anti")
        lists = staged(lists, "shingle-lists")
        new = linked(reps_of.join(small_side(lists.select("key", "size")), "key").withColumns({"i": block, "j": F.lit(0)}))
        if new.isEmpty():
            break
        done = lists if done is None else done.union(lists)
        links = staged(links.union(new), "shingle-links")
        mixed = labelled(links)

    # Whatever was not compared through one member of each component in one block.
    labels = F.count_distinct("label").alias("labels")
    lists = one_of_each_list(mixed, labels).where((F.col("size") > F.col("labels")) | (F.col("size") > group))
    blocks = F.ceil(F.col("size") / group).cast("int")
    rest = (
        mixed.join(lists.select("key", "size"), "key")
        .withColumns({"own": block, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    )
    joined = components(links.union(linked(rest))).withColumnRenamed("id", "class")
    # Smallest ids of classes, then of components of classes: no join has a component as its
    # key, and only classes of several documents or with links take part in the last one.
    ids = reps.join(joined, "class")
    smallest = ids.groupBy("component_id").agg(F.min("doc_id").alias("smallest"))
    of_class = joined.join(smallest, "component_id").select("class", "smallest")
    of_class = reps.join(of_class, "class", "left").where("copies > 1 OR smallest IS NOT NULL")
    of_class = staged(of_class.select("class", F.coalesce("smallest", "doc_id").alias("smallest")), "shingle-firsts")
    return described.join(small_side(of_class), "class", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("smallest", "doc_id")).alias("component_id"),
    )
