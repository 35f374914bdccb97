"""Near-duplicate groups: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidates.

1. *Sets*: distinct 5-word shingles of each whole text, as 64-bit hashes.  Documents with equal sets form one class
   (a map-side combined aggregate), so copies are never expanded into pairs.
2. *Signature*: one permutation (the hash) cut into ``BINS`` bins, each keeping its least value.  An empty bin borrows
   from a non-empty one chosen by a hash of (bin, attempt), which keeps collisions unbiased.  ``BANDS`` bands give the
   buckets: a pair at similarity 0.85 misses all of them with probability 3e-7.
3. *Stars*: a bucket's members are only brought to its hub, and the buckets of one hub are one group, so a bucket of m classes
   gives m rows.  The hub is the member of most and largest buckets.  A group of at most ``GROUP`` classes and ``SHINGLES``
   shingles is settled at once: one task counts the common shingles of all its pairs.
4. *Differences*: a larger group is split exactly.  With hub h, let a member x lack r of h's shingles and have i others;
   W(x) = 100 r + P i (P: percent) and L = (100 - P) |h|.  Then x is linked with h if and only if W(x) <= L, and x and y are linked if and
   only if they share c differences from h with (100 + P) c >= W(x) + W(y) - L.  Of two members with different components, where W(x)
   <= W(y), x shares at least (W(x) + max(W(x), L + 1) - L) / (100 + P) and y at least (W(y) - L) / 100 of its differences, so by
   the prefix filter a rare difference of x is one of y too (``small`` and ``large`` say how many of the rarest are needed).  The members
   of a group that share such a difference form its next groups (those of the same members once), again with one hub each and
   settled as in step 3 once they are small, until no group holds two components.  Every group is smaller than the one it came from, so the rounds end.  Texts of one template that
   are unlike each other have rare differences of their own and part soon; no pair of a bucket is lost.
5. *Components* by contraction: every component takes its least neighbour as parent until no edge is left.

Buckets, candidates, links and components stay in tables; the driver only learns whether a table is empty.

Defined cases: null and empty texts have an empty set and are linked with nothing; a text of fewer than five words is
one shingle; repeated rows have equal sets and so share a component; a null doc_id belongs to its component but never
names it while another member has an id; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

SHINGLE, PERCENT, BANDS, ROWS = 5, 85, 32, 6
BINS = BANDS * ROWS
GROUP, SHINGLES = 256, 1 << 18  # of a group that one task settles
_TRIES = 64
PROBES = (C.mix(np.arange(1, _TRIES * BINS + 1, dtype=np.uint64) * np.uint64(C.BASES[1])) % np.uint64(BINS)).astype(np.int64).reshape(_TRIES, BINS)
_BAND_SALT = C.mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(C.BASES[2]))
_ROW_SALT = C.mix(np.arange(1, ROWS + 1, dtype=np.uint64) * np.uint64(C.BASES[0])) | np.uint64(1)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row."""
    raw = C.LOWER[data]
    starts, ends, words = C.word_spans(raw, bounds, C.NOT_SPACE)
    x = C.word_hashes(raw, starts, ends)
    grams = C.rolling(x, size)
    for a, z in zip(words[:-1].tolist(), words[1:].tolist()):
        if z - a >= size:
            yield np.unique(grams[a : z - size + 1])
        elif z > a:
            yield C.mix(C.rolling(x[a:z], z - a) + np.uint64(z - a))
        else:
            yield np.zeros(0, np.uint64)


def signature(values: np.ndarray) -> np.ndarray:
    """Densified one-permutation MinHash of a non-empty sorted set."""
    bins = ((values >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)  # ascending, as the values are
    first = np.flatnonzero(np.concatenate(([True], bins[1:] != bins[:-1])))
    out, filled = np.zeros(BINS, np.uint64), np.zeros(BINS, bool)
    out[bins[first]] = values[first]
    filled[bins[first]] = True
    empty = np.flatnonzero(~filled)
    for probe in PROBES:
        if not len(empty):
            return out
        source = probe[empty]
        ok = filled[source]
        out[empty[ok]] = out[source[ok]]
        empty = empty[~ok]
    if len(empty):  # very sparse: the next filled bin after the last probe
        have = bins[first]
        out[empty] = out[have[np.searchsorted(have, PROBES[-1][empty]) % len(have)]]
    return out


def bands(values: np.ndarray) -> np.ndarray:
    sig = signature(values).reshape(BANDS, ROWS)
    return C.mix((C.mix(sig) * _ROW_SALT).sum(axis=1, dtype=np.uint64) ^ _BAND_SALT)


_ROW = pa.schema([("doc_id", pa.int64()), ("tkey", pa.int64()), ("n", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("bands", pa.list_(pa.int64()))])


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, tkey, n`` (set size), ``k1, k2`` (128-bit key of the set) and ``bands``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds, _ = C.text_bytes(b.column("text"))
            for i, j in C.row_chunks(bounds):
                n, k1, k2, keys = [], [], [], []
                for s in shingle_sets(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i]):
                    n.append(len(s))
                    k1.append(C.mix(s).sum(dtype=np.uint64))
                    k2.append(C.mix(s ^ np.uint64(C.BASES[1])).sum(dtype=np.uint64))
                    keys.append(C.signed(bands(s)) if len(s) else np.zeros(0, np.int64))
                as_long = lambda x: C.signed(np.array(x, np.uint64))
                yield C.batch(_ROW, b.column("doc_id").slice(i, j - i), b.column("tkey").slice(i, j - i), n, as_long(k1), as_long(k2), keys)

    return docs.mapInArrow(run, "doc_id long, tkey long, n long, k1 long, k2 long, bands array<long>")


# -- components ------------------------------------------------------------------
def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, comp`` for every node of an edge table, by contraction to the least neighbour."""
    return _contracted(C.cut(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct(), "cc-edges"))


def _contracted(rest: DataFrame) -> DataFrame:
    """:func:`components` of a written table of distinct edges ``a, b``."""
    labels = None
    while True:
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = C.cut(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("x"), F.least("a", "m").alias("p")), "cc-parents")
        if labels is None:
            labels = parent.select(F.col("x").alias("node"), F.col("p").alias("comp"))
        else:
            labels = C.cut(labels.join(parent, labels.comp == parent.x, "left").select("node", F.coalesce("p", "comp").alias("comp")), "cc-labels")
        at_a = rest.join(parent, F.col("a") == F.col("x")).select(F.col("p").alias("a"), "b")
        at_b = at_a.join(parent, F.col("b") == F.col("x")).select("a", F.col("p").alias("b"))
        rest = C.cut(at_b.filter("a <> b").distinct(), "cc-edges")
        if rest.isEmpty():
            return _roots(labels)


def _roots(labels: DataFrame) -> DataFrame:
    """Follow labels until they are their own."""
    while True:
        up = labels.select(F.col("node").alias("x"), F.col("comp").alias("p"))
        labels = C.cut(labels.join(up, labels.comp == up.x, "left").select("node", "comp", F.coalesce("p", "comp").alias("up")), "cc-roots")
        done = labels.filter("up <> comp").isEmpty()
        labels = labels.select("node", F.col("up").alias("comp"))
        if done:
            return labels


# -- candidates and confirmation --------------------------------------------------
_LINK = pa.schema([("hub", pa.int64()), ("node", pa.int64())])
_DIFF = pa.schema([("hub", pa.int64()), ("node", pa.int64()), ("linked", pa.bool_()), ("small", pa.int32()), ("large", pa.int32()), ("elements", pa.list_(pa.int64()))])


def _with_texts(pairs: DataFrame, texts: DataFrame, members_per_task: int) -> DataFrame:
    """``hub, salt, role, node, wide, text``: members beside their hub, hub first.

    Members travel to their hub once; a hub with many members is dealt over several salts, each with the hub's text.
    """
    sizes = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / members_per_task).cast("int").alias("salts"))
    hubs = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    hub_rows = hubs.join(texts, hubs.hub == texts.node).select("hub", "salt", F.lit(0).alias("role"), "node", F.lit(False).alias("wide"), "text")
    members = pairs.join(C.detached(sizes, "hub"), "hub").withColumn("salt", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int")).drop("salts")
    member_rows = members.join(texts, "node").select("hub", "salt", F.lit(1).alias("role"), "node", "wide", "text")
    return hub_rows.unionByName(member_rows).repartition("hub", "salt").sortWithinPartitions("hub", "salt", "role")


def _set_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bool, np.ndarray, np.ndarray, bool]]:
    """``hub, node, wide, hub's set, node's set`` of every pair, and whether a block of rows ends with it."""
    hub, hub_set = None, np.zeros(0, np.uint64)
    for b in batches:
        data, bounds, _ = C.text_bytes(b.column("text"))
        h, role, node = (np.asarray(b.column(c)) for c in ("hub", "role", "node"))
        wide = b.column("wide").to_numpy(zero_copy_only=False)
        for i, j in C.row_chunks(bounds):
            for r, s in zip(range(i, j), shingle_sets(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])):
                if role[r] == 0:
                    hub, hub_set = h[r], s
                elif hub == h[r]:
                    yield int(h[r]), int(node[r]), bool(wide[r]), hub_set, s, r == j - 1


def joined_members(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the first one that it reaches over links between the sets."""
    sizes, k = np.array([len(s) for s in sets]), len(sets)
    values, owner = np.concatenate(sets), np.repeat(np.arange(k), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    bounds = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1], [True])))
    often = np.diff(bounds) > 1
    column = np.repeat(np.cumsum(often) - 1, np.diff(bounds))
    shared = np.repeat(often, np.diff(bounds))
    column, owner = column[shared], owner[shared]
    both = np.zeros((k, k), np.int64)
    for low in range(0, int(often.sum()), 4096):  # ascending columns: a block of elements is a slice
        i, j = np.searchsorted(column, (low, low + 4096))
        block = np.zeros((k, 4096), np.float32)
        block[owner[i:j], column[i:j] - low] = 1
        both += (block @ block.T).astype(np.int64)
    linked = 100 * both >= percent * (sizes[:, None] + sizes - both)
    np.fill_diagonal(linked, True)
    first = np.arange(k)
    while (now := np.where(linked, first, k).min(axis=1)).tolist() != first.tolist():
        first = now
    return first


def confirm(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``hub, node``: the members of each small group (``hub, node``, the hub itself included) beside the first one that
    they reach over links of full shingle sets inside the group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, sets = None, [], []

        def links() -> pa.RecordBatch:
            first = joined_members(sets, percent) if len(sets) > 1 else np.arange(len(sets))
            apart, named = np.flatnonzero(first != np.arange(len(sets))), np.array(nodes, np.int64)
            return C.batch(_LINK, named[first[apart]], named[apart])

        for b in batches:
            data, bounds, _ = C.text_bytes(b.column("text"))
            h, node = (np.asarray(b.column(c)) for c in ("hub", "node"))
            for i, j in C.row_chunks(bounds):
                for r, s in zip(range(i, j), shingle_sets(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])):
                    if h[r] != group:
                        yield links()
                        group, nodes, sets = h[r], [], []
                    nodes.append(node[r])
                    sets.append(s)
        yield links()

    rows = members.join(texts, "node").select("hub", "node", "text").repartition("hub").sortWithinPartitions("hub", "node")
    return rows.mapInArrow(run, "hub long, node long")


def differences(pairs: DataFrame, texts: DataFrame, percent: int, members_per_task: int = 250) -> DataFrame:
    """``hub, node, linked, small, large`` and, where ``wide``, the ``elements`` of one set only (see step 4)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for hub, node, wide, hub_set, s, last in _set_pairs(batches):
            apart = np.setxor1d(s, hub_set, assume_unique=True)
            extra = (len(apart) + len(s) - len(hub_set)) // 2
            weight, limit = 100 * (len(apart) - extra) + percent * extra, (100 - percent) * len(hub_set)
            shared = -(-(weight + max(weight, limit + 1) - limit) // (100 + percent))  # with a member of no less weight
            small = large = len(apart) + 1 - shared
            if weight > limit:
                large = len(apart) + 1 - -(-(weight - limit) // 100)  # with a member of no more weight
            rows.append((hub, node, weight <= limit, small, large, C.signed(apart) if wide else ()))
            if last:
                yield C.batch(_DIFF, *(list(c) for c in zip(*rows)))
                rows = []
        if rows:
            yield C.batch(_DIFF, *(list(c) for c in zip(*rows)))

    return _with_texts(pairs, texts, members_per_task).mapInArrow(run, "hub long, node long, linked boolean, small int, large int, elements array<long>")


def joined_up(state: DataFrame, links: DataFrame, fresh: bool) -> DataFrame:
    """``state`` (``node, n, rank, comp``) with the components that the links connect named alike; ``fresh``: each node is its own."""
    if fresh:
        edges = links.select(F.col("hub").alias("a"), F.col("node").alias("b"))
    else:
        ends = state.select(F.col("node"), "comp")
        edges = links.join(ends.select(F.col("node").alias("hub"), F.col("comp").alias("a")), "hub").join(
            ends.select("node", F.col("comp").alias("b")), "node").filter("a <> b").select("a", "b")
    edges = C.cut(edges.distinct(), "near-joins")
    if edges.isEmpty():
        return state
    new = _contracted(edges).select(F.col("node").alias("old"), F.col("comp").alias("new"))
    out = state.join(new, state.comp == new.old, "left").select("node", "n", "rank", F.coalesce("new", "comp").alias("comp"))
    return C.cut(out, "near-state")


def _open(members: DataFrame) -> DataFrame:
    """The groups in which a pair is still in question: two components, and a member that leads."""
    sides = members.groupBy("grp").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.max("leads").alias("led"))
    return sides.filter("led AND low < high").select("grp")


def part_by_differences(members: DataFrame, state: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``state`` after every linked pair of a group is in one component; see steps 3 and 4 above.

    ``members``: ``grp, leads`` and their row of ``state``.  Only pairs with a member that leads are in question.
    """
    groups, first = None, True
    while True:
        hubs = members.groupBy("grp").agg(F.max_by(F.struct("node", "comp"), F.struct("leads", "rank", "node")).alias("h"))
        hub = F.col("h.node").alias("hub")
        stars = members.join(C.detached(hubs, "grp"), "grp").select(
            (hub if first else F.col("grp")).alias("grp"), hub, F.col("h.comp").alias("hub_comp"), "node", "comp", "n", "leads")
        stars = C.cut(stars.distinct() if first else stars, "near-stars")  # buckets of one hub are one group
        beside = stars.select("hub", "node", "n")
        sizes = (beside if first else beside.distinct()).groupBy("hub").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
        sizes = C.cut(sizes.select("hub", F.expr(f"c <= {GROUP} AND n <= {SHINGLES}").alias("small")), "near-sizes")
        told = stars.drop("n").join(sizes, "hub")
        small = told.filter("small").select("hub", "node")
        links = confirm(small if first else small.distinct(), texts, percent)
        done = sizes.filter("NOT small").isEmpty()
        if not done:
            large = told.filter("NOT small AND node <> hub")
            split = _open(large).withColumn("open", F.lit(True))
            asked = large.join(C.detached(split, "grp"), "grp", "left").filter("open OR comp <> hub_comp").groupBy("hub", "node").agg(
                F.coalesce(F.max("open"), F.lit(False)).alias("wide"))
            found = C.cut(differences(asked, texts, percent), "near-differences")
            links = links.unionByName(found.filter("linked").select("hub", "node"))
        state = joined_up(state, links, fresh=first)
        if done:
            return state
        now = large.select("grp", "hub", "node", "leads").join(state.select("node", "comp"), "node")
        now = C.cut(now.join(C.detached(_open(now), "grp"), "grp").select("grp", "hub", "node", "comp"), "near-now")
        each = found.join(now.select("hub", "node", "comp").distinct(), ["hub", "node"]).select(
            "hub", "node", "comp", "small", "large", F.size("elements").alias("size"), F.explode("elements").alias("e"))
        each = C.cut(each, "near-elements")
        often = each.groupBy("hub", "e").agg(F.count(F.lit(1)).alias("c"), (F.min("comp") < F.max("comp")).alias("mixed")).filter("c > 1")
        own = Window.partitionBy("hub", "node")
        placed = each.join(C.detached(often, "e"), ["hub", "e"]).withColumn("shared", F.count(F.lit(1)).over(own)).withColumn(
            "place", F.col("size") - F.col("shared") + F.row_number().over(own.orderBy("c", "e")))  # elements of one member only come first
        kept = placed.filter("mixed AND place <= large").select("hub", "node", "e", (F.col("place") <= F.col("small")).alias("leads"))
        parts = C.cut(now.join(kept, ["hub", "node"]).select(F.xxhash64("grp", "e").alias("grp"), "node", "comp", "leads"), "near-parts")
        parts_open = parts.join(C.detached(_open(parts), "grp"), "grp").select("grp", "node", "leads")
        # groups of the same members are one
        same = parts_open.groupBy("grp").agg(*[F.bit_xor(F.xxhash64("node", "leads", F.lit(k))).alias(f"s{k}") for k in (0, 1)], F.count(F.lit(1)).alias("c"))
        same = same.groupBy("s0", "s1", "c").agg(F.min("grp").alias("grp")).select("grp")
        old, groups = groups, C.cut(parts_open.join(C.detached(same, "grp"), "grp").select("grp", "node", "leads"), "near-groups")
        C.forget(*([] if old is None else [old]), stars, sizes, found, now, each, parts)
        first = False
        if groups.isEmpty():
            return state
        members = groups.join(state, "node")


def linked_classes(nodes: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """``node, comp`` of the classes that share a bucket with another one.  ``nodes``: node, doc_id, tkey, n, bands."""
    buckets = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    several = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    # members of many and large buckets are the most central ones: good hubs
    state = buckets.join(C.detached(several, "bucket"), "bucket").groupBy("node").agg(
        F.max("n").alias("n"), F.sum("c").alias("rank"), F.collect_list("bucket").alias("buckets"))  # a node has BANDS of them at most
    state = C.cut(state.withColumn("comp", F.col("node")), "near-state")
    involved = nodes.select("node", "doc_id", "tkey").join(state.select("node"), "node").alias("i")
    # rows that agree in key and text have the same set, so one of them is enough
    texts = C.cut(docs.alias("d").join(involved, C.same_row("d", "i")).select("i.node", "d.text").dropDuplicates(["node"]), "near-texts")
    members = state.select(F.explode("buckets").alias("grp"), F.lit(True).alias("leads"), "node", "n", "rank", "comp")
    return part_by_differences(members, state.drop("buckets"), texts, percent).select("node", "comp")


def grouped(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, tkey, n`` (shingles), ``comp`` (null for an empty set) and ``component_id`` of ``doc_id, tkey, text`` rows."""
    rows = C.cut(sketches(docs), "near-sketches")
    full = rows.filter("n > 0")
    classes = full.groupBy("k1", "k2").agg(
        F.min("doc_id").alias("least"), F.min_by(F.struct("doc_id", "tkey", "n", "bands"), F.struct("doc_id", "tkey")).alias("at"))
    named = C.cut(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    nodes = named.select("node", "at.*")
    comps = linked_classes(nodes, docs, percent)
    least = named.join(comps, "node", "left").select("k1", "k2", "node", F.coalesce("comp", "node").alias("comp"), "least")
    least = C.cut(least, "near-components")
    names = least.groupBy("comp").agg(F.min("least").alias("component_id"))
    named = least.join(C.detached(names, "comp"), "comp").select("k1", "k2", "comp", "component_id")
    out = ["doc_id", "tkey", "n", "comp", "component_id"]
    alone = rows.filter("n = 0").select("doc_id", "tkey", "n", F.lit(None).cast("long").alias("comp"), F.col("doc_id").alias("component_id"))
    return full.join(named, ["k1", "k2"]).select(*out).unionByName(alone.select(*out))


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every document."""
    got = grouped(C.keyed_documents(documents.select(F.col("doc_id").cast("long"), "text")), percent)
    return got.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(C.table(spark, sf_dir, "documents"))


SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+'), CAST([] AS VARCHAR[])) AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + {SHINGLE - 1}], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM words WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
both_ AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM both_ JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= {PERCENT} * (p.n + q.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM words UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
comp AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN n USING (doc_id)
"""
