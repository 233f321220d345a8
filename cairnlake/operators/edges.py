"""Many-to-many edges between owners and subjects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.sources.folders import rewritten


def edge_changes(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, change): edges added, removed or kept."""
    o, n = old.select(*keys).distinct().withColumn("__old", F.lit(True)), new.select(*keys).distinct().withColumn("__new", F.lit(True))
    both = o.join(n, keys, "full_outer")
    return both.select(*keys, F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "removed").otherwise("kept").alias("change"))


def replace_owner_edges(edges: DataFrame, new: DataFrame, owner: str) -> DataFrame:
    """The edges after each owner named in `new` got exactly its new subjects."""
    return edges.join(new.select(owner).distinct(), owner, "left_anti").unionByName(new).distinct()


def orphans(removed: DataFrame, edges: DataFrame, subject: str) -> DataFrame:
    """Subjects of removed edges that no owner is left for."""
    return removed.select(subject).distinct().join(edges.select(subject), subject, "left_anti")


def chain_roots(certificates: DataFrame, key: str = "fingerprint", issuer: str = "issuer_fingerprint") -> DataFrame:
    """(key, root, steps): each certificate followed to one without a known issuer or that issued itself.

    Every round doubles the distance covered, and is written to the shared folder, until nothing is left to follow.
    Certificates that issue each other in a circle have no root: they are an error, and so is a key with two issuers. Rows
    that repeat count once, and rows without a key are left out."""
    certificates = certificates.where(F.col(key).isNotNull()).select(key, issuer).distinct()
    certificates = certificates.groupBy(key).agg(F.count("*").alias("n"), F.min(issuer).alias(issuer))
    two = F.raise_error(F.concat(F.lit("two issuers are named for "), F.col(key).cast("string")))
    certificates = certificates.withColumn(issuer, F.when(F.col("n") > 1, two.cast(certificates.schema[issuer].dataType)).otherwise(F.col(issuer)))
    up = certificates.select(F.col(key).alias("node"), F.when(F.col(issuer) != F.col(key), F.col(issuer)).alias("up"))
    known = up.select(F.col("node").alias("up_node"))
    up = rewritten(up.join(known, up["up"] == known["up_node"], "left").select("node", F.coalesce("up_node", "node").alias("root"), F.when(F.col("up_node").isNull(), 0).otherwise(1).alias("steps")))
    reach, nodes = 1, up.count()
    while True:
        ends = up.where("steps = 0").select(F.col("node").alias("root"))
        if not up.join(ends, "root", "left_anti").take(1):
            return up.select(F.col("node").alias(key), "root", "steps")
        if reach > nodes:
            raise ValueError("certificates issue each other in a circle")
        ahead = up.select(F.col("node").alias("root"), F.col("root").alias("next"), F.col("steps").alias("more"))
        up = rewritten(up.join(ahead, "root").select("node", F.col("next").alias("root"), (F.col("steps") + F.col("more")).alias("steps")))
        reach *= 2
