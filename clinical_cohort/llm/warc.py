r"""WARC archives of pages and a Merkle fixity audit of their replicas.

Pages become WARC/1.1 response records in archive files. Files are numbered by
the record's digest and records lie in digest order, so an archive depends on
the pages alone. A tree over each file hashes the records of every 64 KiB of
offsets, then every 16 ranges, up to the whole file; replicas whose root differs
are descended, and only below nodes that differ, down to the records.

An archive here is a table with the columns file, offset, length, page_id, url,
copies, bytes (the record). Identical pages are archived once; ``copies`` counts
their rows, so no file grows with repetition. A null url or html is archived as
empty, a null page_id stays null; very long pages are one record. Records of equal
digest are in the order of their page_id. Other columns are not read. An empty table
gives an empty archive and an empty audit; roots that one replica lacks count as different.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

RECORDS_PER_FILE = 4096
RANGE_BITS = 16
FAN_OUT_BITS = 4
#: Fixed value of the archive: capture time, which the pages don't have.
WARC_DATE = "2024-01-01T00:00:00Z"


def record(url: Column, html: Column) -> Column:
    """The bytes of a response record."""
    body = F.encode(html, "UTF-8")
    digest = F.sha2(body, 256)
    ident = F.sha2(F.concat_ws("\n", url, html), 256)
    uuid = F.concat_ws("-", *[F.substring(ident, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:"), uuid,
        F.lit(f">\r\nWARC-Date: {WARC_DATE}\r\nWARC-Target-URI: "), url, F.lit("\r\nWARC-Payload-Digest: sha256:"), digest,
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def archive(pages: DataFrame, records_per_file: int = RECORDS_PER_FILE) -> DataFrame:
    """The archive of the pages (columns page_id, url, html), with running offsets in each file."""
    n_files = max(1, -(-pages.count() // records_per_file))
    rows = pages.select(F.col("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    made = (rows.select("page_id", "url", record(F.col("url"), F.col("html")).alias("bytes"))
            .withColumn("digest", F.sha2("bytes", 256)))
    # Files and offsets come from digests and lengths alone; the records are then shuffled once, to their places.
    once = made.groupBy("page_id", "digest").agg(
        F.count(F.lit(1)).alias("copies"), F.max(F.octet_length("bytes")).cast("long").alias("length"))
    file = F.pmod(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.lit(n_files))
    order = Window.partitionBy("file").orderBy("digest", "page_id")
    placed = once.withColumn("file", file).withColumn("offset", F.sum("length").over(order) - F.col("length"))
    at = placed.select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "file", "offset", "length", "copies")
    joined = made.join(at, made["page_id"].eqNullSafe(at["p"]) & (made["digest"] == at["d"])).select(
        "file", "offset", "length", "page_id", "url", "copies", "bytes")
    return joined.where("copies = 1").unionByName(joined.where("copies > 1").dropDuplicates(["file", "offset"]))


def leaves(replica: DataFrame) -> DataFrame:
    """(file, offset, length, digest) of every record, from its bytes as they are."""
    return replica.select("file", "offset", F.octet_length("bytes").cast("long").alias("length"), F.sha2("bytes", 256).alias("digest"))


def tree(records: DataFrame, levels: int) -> DataFrame:
    """(file, level, node, digest): level 0 covers ranges of offsets, each higher one FAN_OUT ranges of the one below.

    A node gathers the records of 64 KiB or its 16 children, never more.
    """
    def join(level: int, rows: DataFrame, node: Column, place: str, content: Column) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct(F.col(place).alias("p"), content.alias("c"))))
        text = F.array_join(F.transform(parts, lambda x: F.concat_ws(":", x["p"].cast("string"), x["c"])), ",")
        return rows.groupBy("file", node.alias("node")).agg(F.sha2(text, 256).alias("digest")).select(
            "file", F.lit(level).alias("level"), "node", "digest")

    current = join(0, records, F.shiftright("offset", RANGE_BITS), "offset", F.concat_ws(":", F.col("length").cast("string"), "digest"))
    out = current
    for level in range(1, levels):
        current = join(level, current, F.shiftright("node", FAN_OUT_BITS), "node", F.col("digest"))
        out = out.unionByName(current)
    return out


def levels_for(longest: int) -> int:
    """Levels until one node covers a file of this many bytes."""
    n = 1
    while longest >> (RANGE_BITS + FAN_OUT_BITS * (n - 1)):
        n += 1
    return n


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """(file, offset, status) of records that differ: changed, missing (in theirs) or extra (in theirs).

    Every step down compares only the children of nodes that differ.
    """
    a, b = saved(leaves(ours), "leaves"), saved(leaves(theirs), "leaves")
    longest = max(x.agg(F.max("offset")).first()[0] or 0 for x in (a, b))
    levels = levels_for(longest)
    trees = [saved(tree(x, levels), "tree") for x in (a, b)]

    def differing(x: DataFrame, y: DataFrame, on: list[str]) -> DataFrame:
        x, y = (t.select(*on, F.col("digest").alias(d)) for t, d in ((x, "x"), (y, "y")))
        return x.join(y, on, "full").where(~F.col("x").eqNullSafe(F.col("y")))

    bad = None
    for level in reversed(range(levels)):
        nodes = [t.where(F.col("level") == level) for t in trees]
        if bad is not None:
            up = bad.select("file", F.col("node").alias("up"))
            nodes = [n.withColumn("up", F.shiftright("node", FAN_OUT_BITS)).join(up, ["file", "up"], "left_semi") for n in nodes]
        bad = saved(differing(*nodes, ["file", "node"]).select("file", "node"), "differing")
    leaf = [x.withColumn("node", F.shiftright("offset", RANGE_BITS)).join(bad, ["file", "node"], "left_semi")
            .withColumn("digest", F.concat_ws(":", F.col("length").cast("string"), "digest")) for x in (a, b)]
    status = F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "extra").otherwise("changed")
    return differing(*leaf, ["file", "offset"]).select("file", "offset", status.alias("status"))


def fixity(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """One row per record of either replica: file, offset, length, page_id, copies, digest (of ours), status (ok if equal)."""
    found = audit(ours, theirs)
    known = ours.select("file", "offset", "length", "page_id", "copies", F.sha2("bytes", 256).alias("digest"))
    return known.join(found, ["file", "offset"], "full").withColumn("status", F.coalesce("status", F.lit("ok")))
