"""Search for keys and dependencies: which sets of columns tell rows, or other columns, apart."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.sources.sinks import staged

PASS_COLUMNS = 48  # a grouping number has 64 bits
RESULT = "kind string, columns string, determines string"


def distinct_counts(df: DataFrame, sets: Sequence[tuple[str, ...]]) -> dict[tuple[str, ...], int]:
    """Distinct values of every set of columns, null being a value. The values are grouped as they are, by
    grouping sets, so no text is made of them; the grouping number tells which columns a set leaves out. A pass
    takes all sets as long as they have at most ``PASS_COLUMNS`` columns."""
    passes: list[list[tuple[str, ...]]] = [[]]
    for s in sets:
        if len({c for t in [*passes[-1], s] for c in t}) > PASS_COLUMNS:
            passes.append([])
        passes[-1].append(s)
    found = {}
    for some in passes:
        used = [c for c in df.columns if any(c in s for s in some)]
        number = {sum(1 << (len(used) - 1 - i) for i, c in enumerate(used) if c not in s): s for s in some}
        values = df.groupingSets([[F.col(f"`{c}`") for c in s] for s in some], *[F.col(f"`{c}`") for c in used])
        counts = values.agg(F.grouping_id().alias("__set")).groupBy("__set").agg(F.count(F.lit(1)).alias("__n"))
        found |= {number[r["__set"]]: r["__n"] for r in counts.collect()}
    return {s: found.get(s, 0) for s in sets}


def key_search(df: DataFrame, columns: Sequence[str], max_size: int = 3) -> DataFrame:
    """(kind, columns, determines): all minimal keys of up to ``max_size`` columns, and all minimal
    dependencies (every value of ``columns`` goes with one value of ``determines``) of up to
    ``max_size - 1`` columns on the left that hold no key. Column names are joined by commas; a constant
    column depends on no columns at all. A table of at most one row has the empty key.

    Sets are tried level by level. A set is only counted if no smaller set in it is a key, so what is
    counted shrinks as keys are found; a dependency is two equal counts.
    """
    spark, columns = df.sparkSession, sorted(columns)
    df = staged(df.select(*[F.col(f"`{c}`") for c in columns]), "columns")
    n_rows = df.count()
    rows: list[tuple[str, str, str | None]] = []
    if n_rows <= 1:
        return spark.createDataFrame([("key", "", None)], RESULT)
    counts: dict[tuple[str, ...], int] = {(): 1}
    level, known = [(c,) for c in columns], {c: [] for c in columns}
    for _ in range(max_size):
        counts.update(distinct_counts(df, level) if level else {})
        keys = {s for s in level if counts[s] == n_rows}
        rows += [("key", ",".join(s), None) for s in sorted(keys)]
        for s in level:
            for c in s:
                left = tuple(x for x in s if x != c)
                if counts[left] == counts[s] and not any(set(k) <= set(left) for k in known[c]):
                    known[c].append(left)
                    rows.append(("dependency", ",".join(left), c))
        open_ = set(level) - keys
        level = [
            s for s in combinations(columns, len(level[0]) + 1 if level else 0)
            if s and all(p in open_ for p in combinations(s, len(s) - 1))
        ]
    return spark.createDataFrame(rows, RESULT)
