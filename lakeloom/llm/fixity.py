"""Fixity audit of WARC replicas with Merkle trees.

Every record is hashed. The tree of an archive follows its byte offsets, not record numbers: a
leaf covers the records that start in a range of ``RANGE_BYTES``, a node covers ``FANOUT``
neighbouring nodes. A record that is altered at its length changes its own branch only; one that
is lost, added or resized moves the later records of its archive, whose ranges then differ too.
The audit compares the roots of two replicas and descends into branches whose hashes differ, so
equal branches are never compared below. Records of differing ranges are paired by identifier and
digest, wherever they lie: a record that only moved is no damage.

Defined results: NULL bodies and addresses are empty; NULL identifiers are written as an empty
identifier; rows of equal identifier follow each other in the order of their hash; an empty
table has no archives and no damage; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.session import stage

ARCHIVE_BYTES = 4 << 20
RANGE_BYTES = 32 << 10
FANOUT = 16


def record(page_id: Column, url: Column, body: Column) -> Column:
    """A WARC response record as bytes."""
    content = F.coalesce(body, F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(content).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), content, F.lit("\r\n\r\n").cast("binary"))


def placed_records(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES, **replicas: Column) -> DataFrame:
    """Where each page's record lies: ``archive, offset, record_id, length, digest``.

    Each name in ``replicas`` is another copy's bytes of the same records (NULL: the copy has
    lost it) and adds ``<name>_length`` and ``<name>_digest``. Bodies are read once.
    """
    own = record(F.col("page_id"), F.col("url"), F.col("html"))
    columns = {"length": F.octet_length(own).cast("bigint"), "digest": F.sha2(own, 256)}
    for name, content in replicas.items():
        columns |= {f"{name}_length": F.octet_length(content).cast("bigint"), f"{name}_digest": F.sha2(content, 256)}
    slim = stage(pages.select(F.col("page_id").alias("record_id"), *[c.alias(n) for n, c in columns.items()]), "records")
    total = slim.agg(F.sum("length")).first()[0] or 0
    archives = max(1, math.ceil(total / archive_bytes))
    place = F.conv(F.substring(F.md5(F.coalesce(F.col("record_id").cast("string"), F.lit(""))), 1, 8), 16, 10)
    return with_offsets(slim.withColumn("archive", place.cast("bigint") % archives), "record_id", "digest")


def with_offsets(records: DataFrame, *order: str) -> DataFrame:
    """Adds ``offset``: where each record of an archive begins if they follow each other in ``order``."""
    before = Window.partitionBy("archive").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def levels(leaves: DataFrame, depth: int, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> list[DataFrame]:
    """Hashes ``(archive, node, hash)`` of a replica ``(archive, offset, digest)``, leaf ranges first."""

    def combined(rows: DataFrame, *order: str) -> DataFrame:
        # Bounded: the records of one range, or `fanout` children.
        listed = F.sort_array(F.collect_list(F.struct(*order)))
        text = F.array_join(F.transform(listed, lambda x: F.concat_ws(":", *[x[c] for c in order])), ",")
        return rows.groupBy("archive", "node").agg(F.sha2(text, 256).alias("hash"))

    at = leaves.withColumn("node", F.floor(F.col("offset") / range_bytes))
    found = [combined(at, "offset", "digest")]
    for _ in range(depth):
        up = found[-1].select("archive", F.col("node").alias("child"), "hash", F.floor(F.col("node") / fanout).alias("node"))
        found.append(combined(up, "child", "hash"))
    return found


def _differing(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys whose value differs or is on one side only. Keys are unique on both sides."""
    other = right.select(*[F.col(k).alias(f"r_{k}") for k in keys], F.col(value).alias("other"))
    same = [F.col(k) == F.col(f"r_{k}") for k in keys]
    joined = left.select(*keys, value).join(other, same, "full_outer")
    return joined.where(~F.col(value).eqNullSafe(F.col("other"))).select(*[F.coalesce(k, f"r_{k}").alias(k) for k in keys])


def _paired(ours: DataFrame, theirs: DataFrame, keys: list[str]) -> DataFrame:
    """Full outer join of two replicas' records on ``keys``, equal ones in the order of their offsets."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy("offset"))
    a, b = ours.withColumn("nth", nth), theirs.withColumn("nth", nth)
    b = b.select(*[F.col(c).alias(f"r_{c}") for c in b.columns])
    return a.join(b, [F.col(k).eqNullSafe(F.col(f"r_{k}")) for k in [*keys, "nth"]], "full_outer")


def audit(primary: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """Damaged places: ``archive, offset, record_id, length, replica_length, damage``.

    Both replicas are ``(archive, offset, record_id, length, digest)``. Damage is ``altered``,
    ``resized``, ``missing`` or ``added`` as seen from the primary; ``offset`` is the primary's,
    for added records the replica's.
    """
    largest = primary.select("offset").union(replica.select("offset")).agg(F.max("offset")).first()[0] or 0
    ranges = largest // range_bytes + 1
    depth = 0
    while fanout**depth < ranges:
        depth += 1
    ours, theirs = levels(primary, depth, range_bytes, fanout), levels(replica, depth, range_bytes, fanout)
    ours, theirs = [stage(x, "tree") for x in ours], [stage(x, "tree") for x in theirs]
    open_nodes = _differing(ours[depth], theirs[depth], ["archive", "node"], "hash")
    for level in range(depth - 1, -1, -1):
        parents = stage(open_nodes, "branches").select(F.col("archive").alias("pa"), F.col("node").alias("pn"))

        def below(rows: DataFrame, parents: DataFrame = parents) -> DataFrame:
            return rows.join(parents, (F.col("archive") == F.col("pa")) & (F.floor(F.col("node") / fanout) == F.col("pn")), "left_semi")

        open_nodes = _differing(below(ours[level]), below(theirs[level]), ["archive", "node"], "hash")
    ranges_found = stage(open_nodes, "branches").select(F.col("archive").alias("pa"), F.col("node").alias("pn"))

    def inside(rows: DataFrame) -> DataFrame:
        return rows.join(
            ranges_found, (F.col("archive") == F.col("pa")) & (F.floor(F.col("offset") / range_bytes) == F.col("pn")), "left_semi"
        )

    columns = ["archive", "offset", "record_id", "length", "digest"]
    intact = _paired(inside(primary).select(*columns), inside(replica).select(*columns), ["archive", "record_id", "digest"])
    left = stage(intact.where("digest IS NULL OR r_digest IS NULL"), "unpaired")
    both = _paired(
        left.where("digest IS NOT NULL").select(*columns),
        left.where("digest IS NULL").select(*[F.col(f"r_{c}").alias(c) for c in columns]),
        ["archive", "record_id"],
    )
    damage = (
        F.when(F.col("r_digest").isNull(), "missing")
        .when(F.col("digest").isNull(), "added")
        .when(F.col("length") != F.col("r_length"), "resized")
        .otherwise("altered")
    )
    return both.select(
        F.coalesce("archive", "r_archive").alias("archive"),
        F.coalesce("offset", "r_offset").alias("offset"),
        F.coalesce("record_id", "r_record_id").alias("record_id"),
        "length",
        F.col("r_length").alias("replica_length"),
        damage.alias("damage"),
    )
