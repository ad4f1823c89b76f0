"""PageRank of many periods at once."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.config import PAGERANK_TOLERANCE, RESET_PROBABILITY
from delaykit.operators.lookup import BROADCAST_BYTES, fits_broadcast, plain_key, sized_lookup
from delaykit.sources.sinks import staged


def period_edges(
    df: DataFrame, periods: Sequence[str], source: str, target: str
) -> DataFrame:
    """One weighted edge per (period, source, target) in place of one edge per row."""
    return (
        df.filter(F.col(source).isNotNull() & F.col(target).isNotNull())
        .groupBy(*periods, F.col(source).alias("src"), F.col(target).alias("dst"))
        .agg(F.count(F.lit(1)).alias("n_edges"))
    )


ROUNDS_PER_WRITE = 6
HUB_LINKS = 1 << 16  # links of one vertex that are dealt to one place


def linked(edges: DataFrame, periods: Sequence[str], source_vertices_only: bool) -> DataFrame:
    """(periods, __p, src, part, dst, w, dst_parts) of every link, written once.

    The links of a vertex lie in parts of at most about ``HUB_LINKS``, dealt by the other end; a link knows
    in how many parts the links of its own target lie, so a change that arrives there finds them all.
    """
    keyed = edges.withColumn("__p", plain_key(*periods) if periods else F.lit(""))
    if source_vertices_only:
        sources = keyed.select("__p", F.col("src").alias("dst")).distinct()
        keyed = keyed.join(sources, ["__p", "dst"], "left_semi")
    out = sized_lookup(
        keyed.groupBy("__p", "src").agg(
            F.sum("n_edges").alias("__out"), F.ceil(F.count(F.lit(1)) / HUB_LINKS).cast("int").alias("parts")
        )
    )
    targets = out.select("__p", F.col("src").alias("dst"), F.col("parts").alias("dst_parts"))
    both = keyed.join(out, ["__p", "src"]).join(targets, ["__p", "dst"], "left")
    return staged(
        both.select(
            *periods, "__p", "src", F.pmod(F.xxhash64("dst"), "parts").cast("int").alias("part"), "dst",
            (F.col("n_edges") / F.col("__out")).alias("w"), F.col("parts"), "dst_parts",
        ),
        "links",
    )


def frontier_rounds(links: DataFrame, vertices: DataFrame, reset: float, tol: float, max_rounds: int | None) -> DataFrame:
    """(__p, id, rank, change): rounds in which the frontier meets links that stay where they are."""
    key = ["__p", "id"]
    dealt = links.select("__p", F.col("src").alias("id"), "part", "dst", "w", "dst_parts").repartition("__p", "id", "part").persist()
    state = vertices.select(*key, "parts", F.lit(reset).alias("change"))
    number, blocks = 0, [state.withColumn("round", F.lit(0))]
    try:
        while True:
            held = []
            for _ in range(ROUNDS_PER_WRITE if max_rounds is None else min(ROUNDS_PER_WRITE, max_rounds - number)):
                frontier = state.filter((F.col("change") > tol) & F.col("parts").isNotNull()).select(
                    *key, "change", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
                )
                state = dealt.join(frontier, [*key, "part"]).groupBy("__p", F.col("dst").alias("id")).agg(
                    F.max("dst_parts").alias("parts"), F.sum(F.col("change") * F.col("w") * (1 - reset)).alias("change")
                ).persist()
                number += 1
                held.append(state)
            tagged = [rows.withColumn("round", F.lit(number - len(held) + 1 + i)) for i, rows in enumerate(held)]
            blocks.append(staged(reduce(DataFrame.unionByName, tagged), "arrivals"))
            for rows in held:
                rows.unpersist()
            state = blocks[-1].filter(F.col("round") == number).drop("round")
            if state.filter(F.col("change") > tol).isEmpty():
                break
            if max_rounds is not None and number >= max_rounds:
                raise RuntimeError(f"changes above {tol} are left after {number} rounds")
    finally:
        dealt.unpersist()
    moved = reduce(DataFrame.unionByName, blocks)
    last = F.sum(F.when(F.col("round") == number, F.col("change")).otherwise(0.0))
    return staged(moved.groupBy(*key).agg(F.sum("change").alias("rank"), last.alias("change")), "ranks")


def broadcast_rounds(links: DataFrame, vertices: DataFrame, reset: float, tol: float, max_rounds: int | None) -> DataFrame:
    """(__p, id, rank, change): rounds over broadcast links. A link of every vertex to itself, without
    weight, carries its rank on, so a round is one join and one combined sum."""
    key = ["__p", "id"]
    own = vertices.select(*key, F.col("id").alias("dst"), F.lit(None).cast("double").alias("w"))
    hops = F.broadcast(links.select("__p", F.col("src").alias("id"), "dst", "w").unionByName(own))
    state = vertices.select(*key, F.lit(reset).alias("rank"), F.lit(reset).alias("change"))
    kept = F.when(F.col("w").isNull(), F.col("rank")).otherwise(F.lit(0.0))
    passed = F.col("w").isNotNull() & (F.col("change") > tol)
    sent = F.when(passed, F.col("change") * F.col("w") * (1 - reset)).otherwise(F.lit(0.0))
    number = 0
    while True:
        state = (
            state.join(hops, key).groupBy("__p", F.col("dst").alias("id"))
            .agg(F.sum(kept).alias("__kept"), F.sum(sent).alias("change"))
            .select("__p", "id", (F.col("__kept") + F.col("change")).alias("rank"), "change")
        )
        number += 1
        last = max_rounds is not None and number >= max_rounds
        if number % ROUNDS_PER_WRITE == 0 or last:
            state = staged(state, "ranks")
            if state.filter(F.col("change") > tol).isEmpty():
                return state
            if last:
                raise RuntimeError(f"changes above {tol} are left after {number} rounds")


def pagerank(
    edges: DataFrame,
    periods: Sequence[str] = (),
    reset: float = RESET_PROBABILITY,
    tol: float = PAGERANK_TOLERANCE,
    max_rounds: int | None = None,
    source_vertices_only: bool = False,
    with_change: bool = False,
    link_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(periods, id, pagerank) for weighted edges from :func:`period_edges`.

    Rank flows as changes: every vertex starts with ``reset``; a change above ``tol`` is
    passed on along the out-edges by weight and arrives damped by 1 - reset; smaller changes
    stop. Rounds go on until nothing moves any more. A given ``max_rounds`` is a promise, not
    a cut: if changes are left after it, an error is raised. Ranks are scaled to add up to the
    number of vertices of their period, which makes up for vertices without out-edges.

    Links of at most ``link_bytes`` (measured) are broadcast, and a round shuffles one row per vertex.
    Beyond, only the frontier, the vertices whose last change is above ``tol``, meets the links in a round; what
    arrives is summed, every few rounds written, and the rank is the sum of all that arrived. The links are dealt
    once by (period, vertex, part) and kept so, so a round moves the frontier and its arrivals only, or
    nothing but arrivals where the frontier is small enough to be broadcast.

    Vertices are the ends of all edges, or the sources only, in which case edges to other
    vertices are dropped. All periods run in the same rounds. ``with_change`` adds the last
    change of every vertex, 0 if nothing arrived in the last round.
    """
    periods, key = list(periods), ["__p", "id"]
    links = linked(edges, periods, source_vertices_only)
    ends = links.select(*periods, "__p", F.col("src").alias("id"), "parts")
    if not source_vertices_only:
        ends = ends.union(links.select(*periods, "__p", F.col("dst").alias("id"), "dst_parts"))
    vertices = staged(ends.groupBy(*periods, *key).agg(F.max("parts").alias("parts")), "vertices")

    rounds = broadcast_rounds if fits_broadcast(links, link_bytes) else frontier_rounds
    state = rounds(links, vertices, reset, tol, max_rounds)
    if periods:
        state = state.join(vertices.drop("parts"), key)
    scales = state.groupBy("__p").agg((F.count(F.lit(1)) / F.sum("rank")).alias("__scale"))
    scaled = state.join(sized_lookup(scales), "__p")
    shown = [*periods, "id", (F.col("rank") * F.col("__scale")).alias("pagerank")]
    return scaled.select(*shown, *(["change"] if with_change else []))
