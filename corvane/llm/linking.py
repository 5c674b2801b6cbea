"""From shared keys to classes of linked nodes, without emitting all pairs of a group.

Two nodes that share a key are a candidate pair. A group of k nodes first offers at most CENTERS * k
pairs, each of its nodes with a few centers: nodes that share most keys with most others, so of many
copies of one text those closest to the text. Verified pairs join nodes into components, and a second round
offers the pairs of a group that lie in different components, and those only. Every candidate pair is
thus verified or already connected, so the classes are exact.

In the second round, keys with the same members are one group. Where the caller can tell how nodes lie to a
center (``versus``), groups of more than LARGE nodes are not joined by key: their nodes are compared with
the heaviest center of the group, links found there are added, and only nodes outside the center's
component meet the others of that center, under bounds on what both differ from it in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm.rows import materialize
from corvane.scale import lookup_join


CENTERS = 8
#: Groups of more nodes go through a center in the second round; nodes outside its component that meet in one task.
LARGE, OUTSIDERS = 64, 512


def components(links: DataFrame) -> DataFrame:
    """``id``, ``label`` of every node of the links ``a``, ``b``: the least node it is connected with.

    Rounds of large and small stars over written edge tables; each only aggregates minima and joins them
    back, and ends when a round changes nothing.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges, mark = _written(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = hung.unionByName(low.select("a", F.col("m").alias("b"))).distinct()
        edges, after = _written(small)
        if after == mark:
            break
        mark = after
    ends = edges.select(F.col("b").alias("id"), F.col("b").alias("label")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("label")).unionByName(ends)


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = materialize(edges, "edges")
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
    return edges, tuple(row)


def members(shared: DataFrame) -> DataFrame:
    """``key``, ``id``, ``own``: all nodes of the shared keys, the least ones with the others."""
    own = F.col("own") if "own" in shared.columns else F.lit(True)
    return shared.select("key", "id", own.alias("own")) \
        .unionByName(shared.select("key", F.col("lo").alias("id"), F.lit(True).alias("own"))) \
        .groupBy("key", "id").agg(F.max("own").alias("own"))


def stars(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``a`` < ``b``, ``shared``: each node of a key with the centers of the key, and their common keys;
    and ``key``, ``center``, ``w`` of the centers.

    A node weighs the sum of the sizes of its groups. The nodes that own a key fall into ``CENTERS``
    buckets by hash; the heaviest of each is a center.
    """
    sizes = materialize(nodes.groupBy("key").agg(F.count("*").alias("k")), "sizes")
    weights = materialize(nodes.join(sizes, "key").groupBy("id").agg(F.sum("k").alias("w")), "weights")
    weighed = nodes.filter("own").join(weights, "id")
    bucket = F.pmod(F.xxhash64("id"), F.lit(CENTERS)).alias("bucket")
    tops = weighed.groupBy("key", bucket).agg(F.max(F.struct("w", "id")).alias("top"))
    centers = materialize(tops.select("key", F.col("top.id").alias("center"), "top.w"), "centers")
    pairs = nodes.join(centers, "key").filter("id <> center")
    return pairs.groupBy(F.least("id", "center").alias("a"), F.greatest("id", "center").alias("b")) \
        .agg(F.count("*").alias("shared")), centers


def labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    named = nodes.join(labels.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left")
    return materialize(named.withColumn("label", F.coalesce("label", "id")).drop("of"), "named")


def open_groups(named: DataFrame) -> DataFrame:
    """``key``, ``k`` (nodes) and two hashes of the members, of the keys whose nodes lie in several components."""
    marks = [F.bit_xor(F.xxhash64(F.lit(i), "id", "own")).alias(f"mark{i}") for i in range(2)]
    groups = named.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("k"), *marks)
    return materialize(groups.filter("x <> y").drop("x", "y"), "differ")


def residual(named: DataFrame, groups: DataFrame, about: DataFrame | None, possible, owners: bool) -> DataFrame:
    """``a``, ``b``, ``shared``: pairs of nodes with a common key, owned by one of them, in different components.

    ``possible(l, r)`` is a condition on the facts of two nodes (columns of ``about``) that every link meets;
    pairs that fail it are not made. Keys with the same members are joined once.
    """
    once = groups.groupBy("k", "mark0", "mark1").agg(F.min("key").alias("key"), F.count("*").alias("times"))
    named = named.join(materialize(once.select("key", "times"), "once"), "key")
    if about is not None:
        named = named.join(about, "id")
    named = materialize(named if owners else named.drop("own"), "open")
    once, left = F.col("l.id") < F.col("r.id"), named
    if owners:
        once, left = once | ~F.col("r.own"), named.filter("own")
    match = (F.col("l.key") == F.col("r.key")) & once & (F.col("l.label") != F.col("r.label"))
    if about is not None:
        match = match & possible("l.", "r.")
    pairs = left.alias("l").join(named.alias("r"), match)
    return pairs.select(F.col("l.id").alias("a"), F.col("r.id").alias("b"), "l.times").groupBy("a", "b") \
        .agg(F.sum("times").alias("shared"))


def facing(named: DataFrame, groups: DataFrame, centers: DataFrame) -> DataFrame:
    """``center``, ``id``: the nodes of each large group with the heaviest center of the group, once for all its groups."""
    main = centers.groupBy("key").agg(F.max(F.struct("w", "center")).alias("top")).select("key", F.col("top.center").alias("center"))
    main = materialize(main.join(groups.filter(F.col("k") > LARGE).select("key"), "key"), "main")
    return materialize(named.join(main, "key").select("center", "id").distinct(), "facing")


def across(faced: DataFrame, labels: DataFrame, about: DataFrame, possible, apart) -> DataFrame:
    """``a``, ``b``: nodes outside the component of their center with nodes of the same center in other components.

    ``apart(l, r)`` is a condition on how two nodes lie to their center, as ``possible`` is on the nodes alone.
    """
    named = labelled(faced.join(about, "id"), labels)
    homes = materialize(named.filter("id = center").select("center", F.col("label").alias("home")), "homes")
    named = materialize(lookup_join(named, homes, ["center"], "inner"), "homed")
    out = named.filter("label <> home")
    slots = out.groupBy("center").agg(F.ceil(F.count("*") / OUTSIDERS).cast("int").alias("slots"))
    named = lookup_join(named, materialize(slots, "slots"), ["center"], "inner")
    left = named.filter("label <> home").withColumn("slot", F.pmod(F.xxhash64("id"), "slots").cast("int"))
    right = named.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
    once = (F.col("l.id") < F.col("r.id")) | (F.col("r.label") == F.col("r.home"))
    match = (F.col("l.center") == F.col("r.center")) & (F.col("l.slot") == F.col("r.slot")) & once \
        & (F.col("l.label") != F.col("r.label")) & possible("l.", "r.") & apart("l.", "r.")
    pairs = left.alias("l").join(right.alias("r"), match)
    return pairs.select(F.least("l.id", "r.id").alias("a"), F.greatest("l.id", "r.id").alias("b")).distinct()


def classes(shared: DataFrame, verify: Callable[[DataFrame], DataFrame],
            plausible: Callable[[DataFrame], DataFrame], facts: Callable[[DataFrame], DataFrame] | None = None,
            possible: Callable[[str, str], Column] | None = None,
            versus: Callable[[DataFrame], DataFrame] | None = None,
            apart: Callable[[str, str], Column] | None = None) -> DataFrame:
    """``id``, ``label`` of all nodes with a link.

    ``shared``: ``key``, ``id``, ``lo`` of the nodes that share a key with another one, without the least
    node's own rows; with ``own``, one node of a pair must own the key, as the least one does. ``plausible`` drops pairs that cannot be links, given how many keys they
    share; ``verify`` keeps the links. ``facts`` gives columns per ``id`` from the members, for ``possible``. ``versus`` takes
    ``center``, ``id`` and adds ``linked`` and columns for ``apart``; it needs ``facts`` and ``possible``. In the star round a
    pair's keys are counted low, which costs a second look and loses nothing.
    """
    shared = materialize(shared, "shared")  # else its scans and shuffles would run twice
    owners = "own" in shared.columns
    nodes = materialize(members(shared), "members")
    pairs, centers = stars(nodes)
    first = materialize(plausible(pairs), "pairs")
    links = materialize(verify(first).select("a", "b"), "links")
    labels = materialize(components(links), "labels")
    about = materialize(facts(nodes), "facts") if facts else None
    named = labelled(nodes, labels)
    groups = open_groups(named)
    wide = None
    if versus is not None:
        faced = facing(named, groups, centers)
        if not faced.isEmpty():
            faced = materialize(versus(faced), "faced")
            found = faced.filter("linked and id <> center").select(F.col("center").alias("a"), F.col("id").alias("b"))
            links = links.unionByName(found)
            labels = materialize(components(links), "labels")
            wide = across(faced, labels, about, possible, apart)
            named = labelled(nodes, labels)
            groups = open_groups(named).filter(F.col("k") <= LARGE)
    rest = plausible(residual(named, groups, about, possible, owners)).select("a", "b")
    if wide is not None:
        rest = rest.unionByName(wide).distinct()
    seen = first.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))
    rest = rest.join(seen, (F.least("a", "b") == F.col("x")) & (F.greatest("a", "b") == F.col("y")), "left_anti")
    rest = materialize(rest, "pairs")
    if rest.isEmpty():
        return labels
    more = materialize(verify(rest).select("a", "b"), "links")
    return labels if more.isEmpty() else materialize(components(links.unionByName(more)), "labels")
