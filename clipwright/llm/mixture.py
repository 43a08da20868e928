"""Mixing sources to target weights.

Weights go down a tree: domain, language, source. A node that can't use its budget, because its records times
their repeats don't suffice, passes the rest to its siblings by their weights, and only what they can't take goes up. Each
leaf then uses whole epochs of its records and of one more epoch, in a seeded order, the prefix that fits its budget.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwright.llm.bpe import VOCABULARY, token_counts
from clipwright.storage import Scratch

BITS = 10
LEVELS = ("domain", "language", "source")


@dataclass
class Node:
    """A node of the weight tree; leaves have ``tokens`` and ``repeats``."""

    weight: float = 0.0
    tokens: int = 0
    repeats: int = 1
    children: dict[str, Node] = field(default_factory=dict)

    @property
    def capacity(self) -> int:
        return sum(c.capacity for c in self.children.values()) if self.children else self.tokens * self.repeats


def fill(weights: list[float], capacities: list[int], budget: float) -> list[float]:
    """Budget by weight, limited by capacity; what overflows goes to the others by weight, again and again. Children of weight 0 get only what no other can take."""
    got = [0.0] * len(weights)
    left = min(budget, float(sum(capacities)))
    for positive in (True, False):
        room = [i for i in range(len(weights)) if (weights[i] > 0) == positive and capacities[i] > 0]
        while left > 1e-9 and room:
            w = [weights[i] if positive else capacities[i] for i in room]
            full = [i for i, x in zip(room, w, strict=True) if got[i] + left * x / sum(w) >= capacities[i] - 1e-9]
            if not full:
                for i, x in zip(room, w, strict=True):
                    got[i] += left * x / sum(w)
                return got
            for i in full:
                left -= capacities[i] - got[i]
                got[i] = float(capacities[i])
            room = [i for i in room if i not in full]
    return got


def allocate(node: Node, budget: float, path: tuple[str, ...] = ()) -> dict[tuple[str, ...], float]:
    """Budget of each leaf. Going down with the capacities known, shortages stay among siblings as long as these can take them."""
    if not node.children:
        return {path: min(budget, float(node.capacity))}
    names = sorted(node.children)
    kids = [node.children[n] for n in names]
    out: dict[tuple[str, ...], float] = {}
    for n, k, b in zip(names, kids, fill([k.weight for k in kids], [k.capacity for k in kids], budget), strict=True):
        out |= allocate(k, b, (*path, n))
    return out


def weight_tree(leaves: Mapping[tuple[str, ...], int], targets: Mapping[str, tuple[float, int]], language_weights: Mapping[str, float] | None = None) -> Node:
    """The tree over leaves (domain, language, source) -> tokens. A source's share is split over its languages by ``language_weights``, by default by its tokens; each inner node weighs what its leaves do."""
    by_source: dict[str, dict[str, int]] = {}
    for (_, language, source), tokens in leaves.items():
        by_source.setdefault(source, {})[language] = tokens
    root = Node()
    for path, tokens in sorted(leaves.items()):
        _, language, source = path
        share, repeats = targets[source]
        sizes = by_source[source] if language_weights is None else {x: language_weights.get(x, 0.0) for x in by_source[source]}
        total = sum(sizes.values())
        weight = share * sizes[language] / total if total else 0.0
        node = root
        node.weight += weight
        for name in path:
            node = node.children.setdefault(name, Node())
            node.weight += weight
        node.tokens, node.repeats = tokens, repeats
    return root


def leaves_of(node: Node, path: tuple[str, ...] = ()) -> Iterator[tuple[tuple[str, ...], Node]]:
    if node.children:
        for name in sorted(node.children):
            yield from leaves_of(node.children[name], (*path, name))
    elif path:
        yield path, node


def feasible_total(root: Node) -> float:
    """The largest budget at which each leaf with tokens gets its share of the weights of such leaves, so that nothing has to be passed on."""
    leaves = [n for _, n in leaves_of(root) if n.capacity and n.weight > 0]
    total = sum(n.weight for n in leaves)
    return min((n.capacity * total / n.weight for n in leaves), default=0.0)


def node_rows(root: Node, total: float, budgets: Mapping[tuple[str, ...], float]) -> list[tuple]:
    """(level, domain, language, source, weight, wanted, capacity, budget) of each node: ``wanted`` by weight, ``budget`` after shortages have moved."""
    out: list[tuple] = []

    def visit(node: Node, path: tuple[str, ...]) -> None:
        share = node.weight / root.weight if root.weight else 0.0
        got = float(sum(b for p, b in budgets.items() if p[: len(path)] == path))
        names = [*path, *[None] * (len(LEVELS) - len(path))]
        out.append((LEVELS[len(path) - 1] if path else "all", *names, share, share * total, node.capacity, got))
        for name in sorted(node.children):
            visit(node.children[name], (*path, name))

    visit(root, ())
    return out


def source_key(c: str | Column) -> Column:
    """A source's plain spelling: trimmed, in lower case, hyphens and blanks as underscores; null where blank."""
    col = F.regexp_replace(F.lower(F.trim(F.regexp_replace(F.col(c) if isinstance(c, str) else c, r"[\s\xa0]+", " "))), r"[-\s]+", "_")
    return F.when(col != "", col)


def language_key(c: str | Column) -> Column:
    """sn, nd, en by two- and three-letter codes of any case, with or without a region; "other" for any other or none."""
    col = F.lower(F.trim(F.regexp_replace(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), r"[\s\xa0]+", " ")))
    head = F.substring_index(F.substring_index(col, "-", 1), "_", 1)
    return F.when(head.isin("sn", "sna"), "sn").when(head.isin("nd", "nde"), "nd").when(head.isin("en", "eng"), "en").otherwise("other")


@dataclass
class Mixture:
    """``records``: the table's rows in the mixture with ``copies`` and ``tokens``. ``shares``: a row for each target. ``nodes``: a row for each node of the tree (see ``node_rows``)."""

    records: DataFrame
    shares: DataFrame
    nodes: DataFrame
    total: float


def _ends(rows: DataFrame, plan: dict[tuple[str, str], list[int]], place: Column) -> dict[tuple[str, str], tuple[int, int]]:
    """By leaf the place in which its prefix ends and the tokens before it. Of each leaf come at most ``2 ** BITS`` sums, and the tree has few leaves."""
    sums = rows.groupBy("source", "language", place.alias("place")).agg(F.sum("tokens").alias("s")).collect()
    out: dict[tuple[str, str], tuple[int, int]] = {}
    upto: dict[tuple[str, str], int] = {}
    for r in sorted(sums, key=lambda r: r["place"]):
        leaf = (r["source"], r["language"])
        before = upto.get(leaf, plan[leaf][-1])
        upto[leaf] = before + r["s"]
        if leaf not in out and upto[leaf] > plan[leaf][1]:
            out[leaf] = (r["place"], before)
    return out


def mix_sources(
    df: DataFrame, targets: Mapping[str, tuple[float, int]], *, record: str, text: str, source: Column, language: Column, domains: Mapping[str, str] | None = None,
    language_weights: Mapping[str, float] | None = None, total_tokens: float | None = None, stretch: float = 1.0, seed: int = 0, vocabulary: str = VOCABULARY,
) -> Mixture:
    """Mix records to ``targets``, source -> (share, most uses of a record), in tokens of ``vocabulary``.

    Budgets go down the tree of ``domains`` (source -> domain; "other" for those not named), languages and sources. Inside a source languages keep
    their natural proportions unless ``language_weights`` are given. ``total_tokens`` defaults to ``stretch`` times the largest size at which every source with tokens
    reaches its share of the shares of such sources; a larger one makes small sources fall short, and what they lack goes to other sources of their language
    and domain, then to other languages of the domain, then to other domains.
    Sources without a target, null ones, and records without tokens (null or empty text) take no part. A share that no record backs is
    reported with 0. A record is used floor or ceiling of its leaf's epochs times, at most the source's limit; the partial
    epoch never exceeds its budget. Rows with one ``record`` value are told apart only by their copies of it, so it should be unique.
    Empty table: no records, shares of 0. The tree has a leaf for each target and language, so budgets are worked out in the driver.
    """
    spark = df.sparkSession
    scratch = Scratch(spark, "mixture")
    rows = df.select(F.col(record).alias("record"), F.col(text).alias("t"), source.alias("source"), F.coalesce(language, F.lit("other")).alias("language"))
    rows = rows.filter(F.col("source").isin(list(targets)) & F.col("t").isNotNull() & F.col("record").isNotNull())
    # written before the filter, which would otherwise run the encoder once more
    sized = scratch.keep(token_counts(rows, "t", "tokens", vocabulary=vocabulary).select("record", "source", "language", "tokens")).filter("tokens > 0")
    domain = lambda s: (domains or {}).get(s, "other")
    sizes = {(r["source"], r["language"]): r["n"] for r in sized.groupBy("source", "language").agg(F.sum("tokens").alias("n")).collect()}
    root = weight_tree({(domain(s), x, s): n for (s, x), n in sizes.items()}, targets, language_weights)
    total = stretch * feasible_total(root) if total_tokens is None else float(total_tokens)
    budgets = allocate(root, total) if sizes else {}
    # leaf -> whole epochs, tokens of the partial one, and the tokens known to lie before the place in which that ends
    plan = {(s, x): [int(b + 1e-6) // sizes[s, x], int(b + 1e-6) % sizes[s, x], 0] for (_, x, s), b in budgets.items()}
    order = F.xxhash64(F.lit(seed), "source", "language", F.col("record").cast("string"))
    ordered = sized.withColumn("_order", order)
    coarse, fine = F.shiftright("_order", 64 - BITS).cast("int"), F.shiftright("_order", 64 - 2 * BITS).cast("int")
    # the prefix ends in one of 2 ** BITS parts of the order, and there in one of as many
    first = _ends(ordered, plan, coarse)
    wide = spark.createDataFrame([(s, x, p) for (s, x), (p, _) in first.items()], "source string, language string, _part int")
    for leaf, (_, before) in first.items():
        plan[leaf][-1] = before
    last = _ends(ordered.join(F.broadcast(wide), ["source", "language"]).filter(coarse == F.col("_part")), plan, fine)
    known = [(s, x, e, rest, *last.get((s, x), (None, 0))) for (s, x), (e, rest, _) in plan.items()]
    fixed = spark.createDataFrame(known, "source string, language string, epochs long, rest long, _last int, _before long")
    placed = ordered.withColumn("_fine", fine).join(F.broadcast(fixed), ["source", "language"])
    # of a leaf's records a millionth or so are put in order one by one
    upto = F.sum("tokens").over(Window.partitionBy("source", "language").orderBy("_order", "record").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = placed.filter("_fine = _last").withColumn("extra", (F.col("_before") + upto <= F.col("rest")).cast("int"))
    rest = placed.filter("_fine <> _last or _last is null").withColumn("extra", F.when(F.col("_last").isNull() | (F.col("_fine") < F.col("_last")), 1).otherwise(0))
    out = [F.col("record").alias(record), "source", "language", "tokens", (F.col("epochs") + F.col("extra")).cast("int").alias("copies")]
    records = scratch.keep(cut.select(out).unionByName(rest.select(out)).filter("copies > 0"))
    scratch.free_all(records)
    used = records.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.col("tokens").cast("long") * F.col("copies")).alias("used_tokens"), F.max("copies").alias("most_copies"))
    have = {s: sum(n for (t, _), n in sizes.items() if t == s) for s in targets}
    goal = spark.createDataFrame([(s, domain(s), float(w), int(m), have[s]) for s, (w, m) in targets.items()], "source string, domain string, target_share double, max_repeats int, available_tokens long")
    all_used = Window.partitionBy()  # a row for each target
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    shares = (
        goal.join(F.broadcast(used), "source", "left")
        .select("source", "domain", "target_share", "max_repeats", "available_tokens", zero("docs"), zero("used_tokens"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"))
        .withColumn("actual_share", F.coalesce(F.col("used_tokens") / F.sum("used_tokens").over(all_used), F.lit(0.0)))
    )
    nodes = spark.createDataFrame(node_rows(root, total, budgets), "level string, domain string, language string, source string, weight double, wanted double, capacity long, budget double")
    return Mixture(records, shares, nodes, total)
