"""Near-duplicate documents by a grouped prefix join on word shingles.

Two documents link when ``100 * intersection >= 75 * union`` of their shingle sets; the result
has each document's connected component. No link between different sets is lost:

1. Documents with equal sets form a class, named by a 64-bit signature; classes are joined.
2. A pair that links must share a shingle among the first ``n - ceil(0.75 n) + 1`` of each
   set in any common order. Here rare shingles come first. One found in a single class can't
   be shared, so a class with that many of them links with nothing and leaves. This is done
   on a hash-chosen part of the shingles first (with the shingles a short set needs to fill
   its prefix), then, for the few classes that are left, on all of them.
3. What is left of a prefix are the shared shingles. Classes of equal prefix and size form a
   group; groups are joined on prefix shingles, filtered by size and by bounds on what they can
   have in common, and expanded to their members, whose sets are compared.
4. First each list is compared with its best-connected member only, which settles most lists
   of many near copies. Then rounds of stars: in every list that still holds several
   components, one member of each meets one of the list's largest, another one each round, so
   a round makes no more pairs than lists have entries, and large groups of near copies grow
   together. When a round joins few, all pairs that are still in different components follow.

A shingle that very many documents hold is never gathered: where it is frequent within a
task, the task itself knows that it is shared and sends the key alone to the others. Such
shingles come last in the order.

Defined results: NULL and empty texts have an empty set and link with nothing; NULL
identifiers are ignored when a component is named (NULL if it has no other); repeated rows
are rows of their own in one class; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.common import join_bounded
from lakeloom.llm.components import components
from lakeloom.llm.content_sort import remove_marked
from lakeloom.llm.shingles import begin_task, shingle_set, signature
from lakeloom.session import stage

WIDTH = 5
#: Links need 4 * intersection >= 3 * union.
SHARE = 0.75
#: Part of all shingles, chosen by hash, that the first pass looks at.
FIRST_PART = 0.36
#: Shingles a task holds before it sends them on, and the count among them that makes one frequent.
FLUSH_SHINGLES = 600_000
FREQUENT = 256
#: Shingles of one bucket, which one call of Python handles.
BUCKET_SHINGLES = 500_000
#: Rows of (identifier, signature) up to which the left-over classes are broadcast.
BROADCAST_CLASSES = 500_000
_LAST = 2**20 - 1
#: Middles of a list's stars, and the part of the labels whose inverse a round of stars must
#: find links for, so that another one follows.
MIDDLES = 3
LEAST_GAIN = 200
#: 64-bit words of the bitmap that bounds what two classes have in common.
BITMAP_WORDS = 32

_POSTED, _SETTLED, _KEY = 0, 1, 2


def prefix_length(n: Column) -> Column:
    return n - F.floor((n * 3 + 3) / 4) + 1


def _in_first_part(shingles: np.ndarray, part: float) -> np.ndarray:
    return (shingles >> 16 & 0xFFFF) < int(part * 65536)


def _submitted(shingles: np.ndarray, part: float) -> np.ndarray:
    """The shingles of the first part, and others by hash until a prefix is full."""
    if part >= 1:
        return shingles
    chosen = _in_first_part(shingles, part)
    inside = shingles[chosen]
    need = len(shingles) - (3 * len(shingles) + 3) // 4 + 1
    if len(inside) >= need:
        return inside
    return np.concatenate([inside, shingles[~chosen][: need - len(inside)]])


def _sketches(part: float):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        for batch in batches:
            sets = [shingle_set(t, WIDTH) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([signature(s) if len(s) else None for s in sets], pa.int64()),
                    pa.array([len(_submitted(s, part)) for s in sets], pa.int64()),
                    batch.column(2),
                ],
                names=["doc_id", "n_shingles", "sig", "submitted", "mark"],
            )

    return sketch


def _from_texts(part: float):
    def sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        for text in batch.column(0).to_pylist():
            shingles = shingle_set(text, WIDTH)
            if len(shingles):
                yield signature(shingles), _submitted(shingles, part)

    return sets


def _from_sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    lists = batch.column(1)
    flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    for i, sig in enumerate(batch.column(0).to_pylist()):
        yield sig, flat[ends[i] : ends[i + 1]]


def _places(shingles: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each shingle and its 32-bit name there.

    Two shingles of one name only look shared, which adds candidates and loses none.
    """
    low = shingles & 0xFFFFFFFF
    return low % buckets, (shingles >> 32 & 0xFFFFFFFF).astype(np.uint32)


def _postings(sets, buckets: int):
    """Rows for buckets of shingles, packed: ``bucket, kind, names, sigs``."""
    columns = ["bucket", "kind", "names", "sigs"]

    def packed(bucket: np.ndarray, kind: int, names: np.ndarray, sigs: np.ndarray | None):
        order = np.argsort(bucket, kind="stable")
        bucket, names = bucket[order], names[order]
        sigs = np.empty(0, np.int64) if sigs is None else sigs[order]
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
        ends = np.r_[starts[1:], len(bucket)] if len(bucket) else []
        for i in range(0, len(starts), 500):
            pieces = list(zip(starts[i : i + 500], ends[i : i + 500]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(bucket[a]) for a, _ in pieces], pa.int64()),
                    pa.array([kind] * len(pieces), pa.int32()),
                    pa.array([names[a:b].tobytes() for a, b in pieces], pa.binary()),
                    pa.array([sigs[a:b].tobytes() for a, b in pieces], pa.binary()),
                ],
                names=columns,
            )

    def flush(shingles: list[np.ndarray], sigs: list[int]):
        owner = np.repeat(np.array(sigs, np.int64), [len(s) for s in shingles])
        bucket, names = _places(np.concatenate(shingles), buckets)
        order = np.argsort(bucket << 32 | names, kind="stable")
        bucket, names, owner = bucket[order], names[order], owner[order]
        first = np.r_[True, (bucket[1:] != bucket[:-1]) | (names[1:] != names[:-1])]
        counts = np.diff(np.r_[np.flatnonzero(first), len(names)])
        frequent = np.repeat(counts >= FREQUENT, counts)
        yield from packed(bucket[~frequent], _POSTED, names[~frequent], owner[~frequent])
        # Known to be shared already: to a bucket by owner, which spreads them. The bucket they
        # come from goes with the name.
        whole = bucket[frequent] << 32 | names[frequent]
        yield from packed(owner[frequent] % buckets, _SETTLED, whole, owner[frequent])
        heads = np.flatnonzero(first)[counts >= FREQUENT]
        yield from packed(bucket[heads], _KEY, names[heads], None)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_task()
        seen: set[int] = set()
        held, owners, size = [], [], 0
        for batch in batches:
            for sig, shingles in sets(batch):
                if sig in seen:
                    continue
                seen.add(sig)
                held.append(shingles)
                owners.append(sig)
                size += len(shingles)
                if size >= FLUSH_SHINGLES:
                    yield from flush(held, owners)
                    held, owners, size = [], [], 0
        if held:
            yield from flush(held, owners)

    return post


def _ranks(holders: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """One number for each shingle: the number of holders above, 42 bits of its hash below.

    It orders shingles from rare to frequent. Equal ranks of two shingles only add candidates.
    """
    mixed = (whole.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(22)
    return np.minimum(holders, _LAST) << 42 | mixed.astype(np.int64)


def _shared_in_bucket(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Owners and ranks of the shingles of a bucket that more than one class holds."""
    parts: dict[int, list] = {_POSTED: [], _SETTLED: [], _KEY: []}
    for kind, names, sigs in zip(*(table.column(c).to_pylist() for c in ("kind", "names", "sigs"))):
        parts[kind].append((np.frombuffer(names, np.int64 if kind == _SETTLED else np.uint32), np.frombuffer(sigs, np.int64)))

    def joined(kind: int) -> tuple[np.ndarray, np.ndarray]:
        if not parts[kind]:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return tuple(np.concatenate(p).astype(np.int64) for p in zip(*parts[kind]))

    names, sigs = joined(_POSTED)
    order = np.lexsort((sigs, names))
    names, sigs = names[order], sigs[order]
    # The same class may come from several tasks.
    new = np.r_[True, (names[1:] != names[:-1]) | (sigs[1:] != sigs[:-1])][: len(names)]
    names, sigs = names[new], sigs[new]
    first = np.flatnonzero(np.r_[True, names[1:] != names[:-1]][: len(names)])
    counts = np.diff(np.r_[first, len(names)])
    frequent = np.isin(names[first], joined(_KEY)[0])
    holders = np.repeat(np.where(frequent, _LAST, counts), counts)
    keep = holders > 1
    bucket = table.column("bucket")[0].as_py()
    whole, owners = joined(_SETTLED)
    pairs = np.unique(np.stack([owners, whole]), axis=1) if len(owners) else np.empty((2, 0), np.int64)
    ranks = np.r_[_ranks(holders[keep], bucket << 32 | names[keep]), _ranks(np.full(pairs.shape[1], _LAST), pairs[1])]
    return np.r_[sigs[keep], pairs[0]], ranks


def _shared_ranks(table: pa.Table) -> pa.Table:
    sigs, ranks = _shared_in_bucket(table)
    return pa.table({"sig": pa.array(sigs), "rank": pa.array(ranks)})


def _shared_counts(table: pa.Table) -> pa.Table:
    sigs, counts = np.unique(_shared_in_bucket(table)[0], return_counts=True)
    return pa.table({"sig": pa.array(sigs), "shared": pa.array(counts)})


def _buckets(rows: DataFrame, sets, total: int):
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(4 * parts, -(-total // BUCKET_SHINGLES))
    posted = rows.mapInArrow(_postings(sets, buckets), "bucket bigint, kind int, names binary, sigs binary")
    return posted.groupBy("bucket")


def _count_shared(rows: DataFrame, sets, total: int) -> DataFrame:
    """``(of, n_shared)``: how many shingles of each class others hold too."""
    found = _buckets(rows, sets, total).applyInArrow(_shared_counts, "sig bigint, shared bigint")
    return found.groupBy(F.col("sig").alias("of")).agg(F.sum("shared").alias("n_shared"))


def _rank_shared(rows: DataFrame, sets, total: int) -> DataFrame:
    """``(of, shared)``: ranks of the shared shingles of each class, rare first."""
    found = _buckets(rows, sets, total).applyInArrow(_shared_ranks, "sig bigint, rank bigint")
    return found.groupBy(F.col("sig").alias("of")).agg(F.sort_array(F.collect_list("rank")).alias("shared"))


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sigs, sets = [], []
        for text, sig in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            shingles = shingle_set(text, WIDTH)
            if len(shingles) and signature(shingles) == sig:
                sigs.append(sig)
                sets.append(shingles)
        ends = np.r_[0, np.cumsum([len(s) for s in sets], dtype=np.int64)].astype(np.int32)
        flat = np.concatenate(sets) if sets else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(sigs, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], names=["sig", "items"]
        )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From ``sig, n, left, shared``: the prefix in order of rank's value and a bitmap of all shared.

    ``more`` counts the shared shingles that found their bit set already.
    """
    for batch in batches:
        prefixes, bitmaps, more = [], [], []
        lists = batch.column(3)
        flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
        for i, left in enumerate(batch.column(2).to_pylist()):
            ranks = flat[ends[i] : ends[i + 1]]
            bits = np.zeros(64 * BITMAP_WORDS, np.uint8)
            bits[ranks % (64 * BITMAP_WORDS)] = 1
            prefixes.append(np.sort(ranks[:left]))
            bitmaps.append(np.packbits(bits).view(np.int64))
            more.append(len(ranks) - int(bits.sum()))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array((ends[1:] - ends[:-1]).astype(np.int64)),
                pa.array(prefixes, pa.list_(pa.int64())),
                pa.array(bitmaps, pa.list_(pa.int64())),
                pa.array(more, pa.int64()),
            ],
            names=["sig", "n", "n_shared", "prefix", "bits", "more"],
        )


def _may_link(a: str, b: str) -> Column:
    """Sizes within 3/4 of each other, and enough shingles that may be common.

    Common shingles are shared ones with the same bit. Bits that both have bound them, with
    those that found their bit set already on the side that has fewer of these.
    """
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    need = (na + nb) * 3
    both = [F.bit_count(F.col(f"{a}.bits")[i].bitwiseAND(F.col(f"{b}.bits")[i])) for i in range(BITMAP_WORDS)]
    most = sum(both[1:], both[0]) + F.least(F.col(f"{a}.more"), F.col(f"{b}.more"))
    return (
        (na * 4 >= nb * 3)
        & (nb * 4 >= na * 3)
        & (F.least(F.col(f"{a}.n_shared"), F.col(f"{b}.n_shared")) * 7 >= need)
        & (most * 7 >= need)
    )


def _links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` whose sets link, by comparing the sets."""
    pairs = stage(pairs, "pairs")
    met = stage(pairs.select(F.explode(F.array("a", "b")).alias("met")).distinct(), "met")
    sets = join_bounded(sets, met, F.col("sig") == F.col("met"), BROADCAST_CLASSES, "left_semi")
    left = sets.select(F.col("sig").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("sig").alias("b"), F.col("items").alias("items_b"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("items_a", "items_b"))
    linked = F.col("common") * 7 >= (F.size("items_a") + F.size("items_b")) * 3
    return both.withColumn("common", common).where(linked).select("a", "b")


def _class_links(texts: DataFrame, slim: DataFrame) -> DataFrame:
    """Enough links ``(a, b)`` between classes to connect all that the rule connects."""
    classes = stage(
        slim.where("n_shingles > 0")
        .groupBy("sig")
        .agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("submitted").alias("submitted")),
        "classes",
    )
    total = classes.agg(F.sum("submitted")).first()[0] or 0
    shared = _count_shared(texts.select("text"), _from_texts(FIRST_PART), total)
    open_ = classes.join(shared, F.col("sig") == F.col("of")).where(
        F.col("submitted") - F.col("n_shared") < prefix_length(F.col("n"))
    )
    open_ = stage(open_.select(F.col("doc").alias("open_doc"), "sig", "n"), "open-classes")

    holders = join_bounded(texts, open_, F.col("doc_id") == F.col("open_doc"), BROADCAST_CLASSES, "inner")
    sets = stage(holders.select("text", "sig").mapInArrow(_sets_of, "sig bigint, items array<bigint>"), "sets")
    total = open_.agg(F.sum("n")).first()[0] or 0
    ranked = open_.join(_rank_shared(sets, _from_sets, total), F.col("sig") == F.col("of"))
    n_shared = F.size("shared").cast("bigint")
    ranked = ranked.withColumn("n_shared", n_shared).withColumn(
        "left", prefix_length(F.col("n")) - (F.col("n") - F.col("n_shared"))
    )
    ranked = ranked.where("left > 0").select("sig", "n", F.col("left").cast("int").alias("left"), "shared")
    schema = "sig bigint, n bigint, n_shared bigint, prefix array<bigint>, bits array<bigint>, more bigint"
    prefixes = stage(ranked.mapInArrow(_prefixes, schema), "prefixes")

    # Groups of equal prefix and size; the head is the member with the most shared shingles.
    lead = F.struct((-F.col("n_shared")).alias("k"), F.col("sig"))
    prefixes = prefixes.withColumn("grp", F.xxhash64("n", "prefix"))
    heads = prefixes.groupBy(F.col("grp").alias("g")).agg(F.min(lead)["sig"].alias("head"))
    grouped = stage(prefixes.join(heads, F.col("grp") == F.col("g")).drop("g"), "groups")
    inside = grouped.where("sig <> head").select(F.col("head").alias("a"), F.col("sig").alias("b"))
    # For each shingle, its lists' other heads meet the one with the most shared shingles.
    facts = ["n", "n_shared", "bits", "more"]
    posted = grouped.where("sig = head").select("sig", "n_shared", F.explode("prefix").alias("shingle"))
    best = posted.groupBy(F.col("shingle").alias("s")).agg(F.min(lead)["sig"].alias("best"))
    met = posted.join(best, (F.col("shingle") == F.col("s")) & (F.col("sig") != F.col("best"))).select("sig", "best").distinct()
    x, y = grouped.select("sig", *facts).alias("x"), grouped.select("sig", *facts).alias("y")
    stars = (
        met.alias("m")
        .join(x, F.col("m.sig") == F.col("x.sig"))
        .join(y, (F.col("m.best") == F.col("y.sig")) & _may_link("x", "y"))
        .select(F.least("x.sig", "y.sig").alias("a"), F.greatest("x.sig", "y.sig").alias("b"))
    )
    links = [stage(_links(inside.union(stars).distinct(), sets), "first-links")]
    labels = components(links[0]).select(F.col("node").alias("l_sig"), "label")
    labelled = grouped.join(labels, F.col("sig") == F.col("l_sig"), "left").select(
        "sig", *facts, "prefix", F.coalesce("label", "sig").alias("label")
    )
    labelled = stage(labelled, "labelled")
    facts_of = labelled.select("sig", *facts)
    listed, n_labels = _mixed_lists(labelled.select("sig", "label", F.explode("prefix").alias("shingle")))
    for turn in itertools.count():
        if not n_labels:
            break
        found = stage(_links(_star_pairs(listed, facts_of, turn), sets), "more-links")
        links.append(found)
        n_found, before = found.count(), n_labels
        if n_found:
            listed, n_labels = _mixed_lists(_relabelled(listed, found))
        if n_found * LEAST_GAIN < before:
            break
    if n_labels:
        # All pairs with a common prefix shingle that are still apart.
        rows = listed.join(facts_of.withColumnRenamed("sig", "of"), F.col("sig") == F.col("of"))
        x, y = rows.alias("x"), rows.alias("y")
        apart = x.join(
            y,
            (F.col("x.shingle") == F.col("y.shingle"))
            & (F.col("x.sig") < F.col("y.sig"))
            & (F.col("x.label") != F.col("y.label"))
            & _may_link("x", "y"),
        ).select(F.col("x.sig").alias("a"), F.col("y.sig").alias("b"))
        links.append(stage(_links(apart.distinct(), sets), "last-links"))
    return functools.reduce(DataFrame.union, links)


def _mixed_lists(listed: DataFrame) -> tuple[DataFrame, int]:
    """The entries ``sig, label, shingle`` of lists that hold several labels, and how many labels."""
    ends = listed.groupBy(F.col("shingle").alias("s")).agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    mixed = stage(ends.where("lo <> hi").select("s"), "mixed-lists")
    listed = stage(listed.join(mixed, F.col("shingle") == F.col("s"), "left_semi"), "mixed-entries")
    return listed, listed.agg(F.count_distinct("label")).first()[0]


def _star_pairs(listed: DataFrame, facts_of: DataFrame, turn: int) -> DataFrame:
    """In each list, one member of every label with some of the label that has the most, if they may link.

    Who it is goes by a hash that differs from turn to turn.
    """
    def chosen(salt: int) -> Column:
        return F.min(F.struct(F.xxhash64("sig", F.lit(turn), F.lit(salt)).alias("h"), F.col("sig")))["sig"]

    middles = [chosen(i).alias(f"m{i}") for i in range(MIDDLES)]
    members = listed.groupBy("shingle", "label").agg(F.count("*").alias("n_members"), *middles)
    ends = [F.col(f"m{i}") for i in range(MIDDLES)]
    largest = members.groupBy(F.col("shingle").alias("s")).agg(F.max(F.struct("n_members", "label", *ends)).alias("largest"))
    met = members.join(largest, (F.col("shingle") == F.col("s")) & (F.col("label") != F.col("largest.label")))
    middle = F.explode(F.array(*[F.col(f"largest.m{i}") for i in range(MIDDLES)])).alias("middle")
    met = met.select(F.col("m0").alias("member"), middle).distinct()
    x, y = facts_of.alias("x"), facts_of.alias("y")
    near = met.join(x, F.col("member") == F.col("x.sig")).join(y, (F.col("middle") == F.col("y.sig")) & _may_link("x", "y"))
    return near.select(F.least("x.sig", "y.sig").alias("a"), F.greatest("x.sig", "y.sig").alias("b")).distinct()


def _relabelled(listed: DataFrame, links: DataFrame) -> DataFrame:
    """The entries with the labels that ``links`` between their members join made one."""
    label_of = stage(listed.select(F.col("sig").alias("of"), F.col("label").alias("of_label")).distinct(), "label-of")
    between = links.join(label_of, F.col("a") == F.col("of")).select(F.col("of_label").alias("a"), "b")
    between = between.join(label_of, F.col("b") == F.col("of")).select("a", F.col("of_label").alias("b")).where("a <> b")
    joined = components(between).select(F.col("node").alias("was"), F.col("label").alias("now"))
    moved = listed.join(joined, F.col("label") == F.col("was"), "left")
    return moved.select("sig", F.coalesce("now", "label").alias("label"), "shingle")


def _components(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, mark`` of every document; ``mark`` is a hash of its text."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("mark")
    )
    schema = "doc_id bigint, n_shingles bigint, sig bigint, submitted bigint, mark bigint"
    slim = stage(texts.mapInArrow(_sketches(FIRST_PART), schema), "sketches")
    labels = components(_class_links(texts, slim))
    classes = slim.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("doc"))
    named = classes.join(labels, F.col("sig") == F.col("node"), "left").select(
        F.col("sig").alias("of"), F.coalesce("label", "sig").alias("label"), "doc"
    )
    named = stage(named, "named")
    first = named.groupBy(F.col("label").alias("l")).agg(F.min("doc").alias("component"))
    by_class = named.join(first, F.col("label") == F.col("l")).select("of", "component", "label")
    empty = slim.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "mark", F.lit(None).cast("bigint").alias("label")
    )
    full = slim.where("n_shingles > 0").join(by_class, F.col("sig") == F.col("of"))
    return full.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "mark", "label").union(empty)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id``."""
    return _components(docs).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that stay: the smallest identifier of each component.

    Documents without words are in no component and all stay, as do rows without identifier.
    """
    found = stage(_components(docs).where("label IS NOT NULL AND doc_id IS NOT NULL"), "components")
    kept = found.groupBy(F.col("label").alias("l")).agg(F.min(F.struct("doc_id", "mark")).alias("k"))
    rows = found.join(kept, F.col("label") == F.col("l"))
    stays = (F.col("doc_id") == F.col("k.doc_id")) & (F.col("mark") == F.col("k.mark"))
    names = [F.col("doc_id").alias("c_id"), F.col("mark").alias("c_mark")]
    repeated = rows.where(stays).groupBy("doc_id", "mark").agg(F.count("*").alias("n")).where("n > 1").select(*names)
    return remove_marked(docs, F.xxhash64("text"), rows.where(~stays).select(*names), repeated)
