"""Splits that keep related records together.

Records that share an entity (an author, a source, an index) directly or through further records form one component.
Components come from alternating large-star and small-star steps over the graph of entities, and each component falls
into a split by the hash of its identifier. The graph holds each different pair of entities once, so its size follows
the number of entities, not of records, and it is never brought to the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwright.operators.skew import heavy_keys, salted_join
from clipwright.storage import Scratch

# characters that str.strip() removes in Python
BLANK = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
NOBODY = ("", "unknown")
STEPS = 200


def name_key(c: str | Column, nobody: Sequence[str] = NOBODY) -> Column:
    """A name trimmed of all kinds of blanks and in lower case; null where it names nobody."""
    col = F.lower(F.regexp_replace(F.col(c) if isinstance(c, str) else c, f"^{BLANK}+|{BLANK}+$", ""))
    return F.when(~col.isin(*nobody), col)


def index_key(c: str | Column, nobody: Sequence[int] = (-1,)) -> Column:
    col = (F.col(c) if isinstance(c, str) else c).cast("long")
    return F.when(~col.isin(*nobody), col.cast("string"))


def components(edges: DataFrame, a: str = "a", b: str = "b", *, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) of every node of the undirected ``edges`` (strings), root being the smallest node of its component.

    Loops, repeated edges and nulls are allowed; loops alone make a component of one node. No edges: no rows.
    Each step writes the new edges to the shared folder and the older ones are deleted; the loop ends when a large-star and
    a small-star step leave nothing but stars. Hubs with more than a share of the edges are joined under salts. Steps grow with the logarithm of the
    nodes; after ``STEPS`` an error is raised instead of an unfinished result.
    """
    own = scratch is None
    scratch = scratch or Scratch(edges.sparkSession, "components")
    pairs = edges.select(F.col(a).cast("string").alias("u"), F.col(b).cast("string").alias("v")).filter("u is not null and v is not null").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    first = scratch.keep(pairs)  # u >= v
    nodes = first.filter("u = v").select("u")
    links, old = first.filter("u <> v"), None
    for _ in range(STEPS):
        large = scratch.keep(_large_star(links))
        links = scratch.keep(_small_star(large))
        scratch.free(large, *([old] if old is not None else []))
        old = links
        if _only_stars(links):
            break
    else:
        raise RuntimeError(f"components not finished after {STEPS} steps")
    roots = links.select("u", "v")
    tied = roots.select("u").unionByName(roots.select(F.col("v").alias("u")).distinct())
    alone = nodes.join(tied.hint("merge"), "u", "left_anti")
    out = scratch.keep(
        roots.select(F.col("u").alias("node"), F.col("v").alias("root"))
        .unionByName(roots.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        .unionByName(alone.select(F.col("u").alias("node"), F.col("u").alias("root")))
    )
    scratch.free(first, links)
    if own:
        scratch.free_all(out)
    return out


def _only_stars(links: DataFrame) -> bool:
    """Whether each node has one smaller neighbour or is one, and not both. Edges keep components and lead to smaller nodes, so a star's centre is then its smallest node."""
    ends = links.select("u", F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(links.select(F.col("v").alias("u"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    each = ends.groupBy("u").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.agg(F.coalesce(F.max(F.col("up") + F.col("down")), F.lit(0))).first()[0] <= 1


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to the smallest of itself and its neighbours."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).hint("merge")  # grows with the nodes, so it is never broadcast
    up = both.filter("v > u")
    joined = salted_join(up, least, "u", heavy=heavy_keys(up, "u"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours link to the smallest of them. ``links`` has u > v."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    joined = salted_join(links, least.hint("merge"), "u", heavy=heavy_keys(links, "u"))
    stars = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return stars.filter("u <> v").distinct()


def entity_components(df: DataFrame, entities: Mapping[str, Column], *, scratch: Scratch | None = None) -> DataFrame:
    """(node, root) over the entities of the rows. A node is "kind:value"; ``entities`` maps kinds to key expressions (null joins nothing)."""
    keys = df.select(F.array_compact(F.array(*(F.concat(F.lit(f"{k}:"), e.cast("string")) for k, e in entities.items()))).alias("e")).filter(F.size("e") > 0)
    star = keys.distinct().select(F.explode("e").alias("b"), F.element_at("e", 1).alias("a"))
    return components(star.distinct(), scratch=scratch)


def related_splits(
    df: DataFrame, entities: Mapping[str, Column], *, record: str, proportions: Mapping[str, float], seed: int = 0, into: str = "related_split", component: str = "component"
) -> DataFrame:
    """``df`` with ``component`` and ``into``, its split, such that records of one component share a split.

    ``proportions`` are shares by split name (they need not add up to one; they are scaled). The split is found by the hash of
    seed and component, so it stays when records come or go, unless they join components. A record all of whose
    entities are null is a component by itself, named by ``record`` (nulls in ``record`` share one). Every row comes out once, repeated
    rows alike; an empty table gives no rows. Existing columns called like the new ones are replaced; others are kept.
    """
    total = sum(proportions.values())
    if total <= 0 or min(proportions.values()) < 0:
        raise ValueError("proportions must not be negative and must add up to more than 0")
    scratch = Scratch(df.sparkSession, "related")
    roots = entity_components(df, entities, scratch=scratch).select(F.col("node").alias("_node"), F.col("root").alias("_root"))
    names = [F.concat(F.lit(f"{k}:"), e.cast("string")) for k, e in entities.items()]
    rows = df.drop(component, into) if component not in (record,) else df.drop(into)
    rows = rows.withColumn("_node", F.coalesce(*names))
    joined = salted_join(rows, roots, "_node", heavy=heavy_keys(rows.select("_node"), "_node"), how="left")
    found = joined.withColumn(component, F.coalesce("_root", F.concat(F.lit("record:"), F.coalesce(F.col(record).cast("string"), F.lit("")))))
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col(component)))
    point = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(1 << 32)
    split, low = None, 0.0
    items = list(proportions.items())
    for name, share in items[:-1]:
        low += share / total
        split = F.when(point < low, name) if split is None else split.when(point < low, name)
    return found.withColumn(into, split.otherwise(items[-1][0]) if split is not None else F.lit(items[-1][0])).drop("_node", "_root")
