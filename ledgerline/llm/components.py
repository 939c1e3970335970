"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, saved

#: Edges (16 bytes each) that one executor task joins by itself; more are joined by all.
FEW = 500_000


def _in_one_task(edges: DataFrame) -> DataFrame:
    kind = edges.schema["a"].dataType.simpleString()

    def join(batches):
        got = [(x.column(0).to_numpy(zero_copy_only=False), x.column(1).to_numpy(zero_copy_only=False)) for x in batches]
        if not got:
            return
        a, b = (np.concatenate(x) for x in zip(*got, strict=True))
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = np.arange(len(ids))
        p, q = at[: len(a)], at[len(a) :]
        while True:  # each end of an edge takes the smaller root, then roots are followed to their ends
            low = np.minimum(root[p], root[q])
            new = root.copy()
            for end in (root[p], root[q], p, q):
                np.minimum.at(new, end, low)
            while (jump := new[new] != new).any():
                new[jump] = new[new[jump]]
            if (new == root).all():
                break
            root = new
        changed = root != np.arange(len(ids))
        yield pa.record_batch({"node": pa.array(ids[changed]), "root": pa.array(ids[root[changed]])})

    return edges.select("a", "b").coalesce(1).mapInArrow(join, f"node {kind}, root {kind}")


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> (node, root): root is the smallest node that a chain of edges leads to.

    Each step is a shuffle of the edges; steps are logarithmic in the longest
    chain. Only the number of edges reaches the driver. A node's neighbours are
    never gathered: minima are aggregated and joined back. At most FEW edges of
    whole-number nodes are joined in one task instead.
    """
    if edges.schema["a"].dataType.simpleString() in ("int", "bigint") and edges.count() <= FEW:
        return saved(_in_one_task(edges), "roots")
    now = saved(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = now.union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("low").alias("b")).where("a <> b").distinct()
        after = saved(small, "links")
        stars = after.groupBy("a").count().where("count > 1").limit(1).count() == 0 and after.join(after.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count() == 0
        dropped(now)
        now = after
        if stars:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
