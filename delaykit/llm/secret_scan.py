"""Secret scan: three patterns, and sliding-window entropy over long candidate strings (method 11).

All of it is SQL functions in one pass over the rows: no shuffle, no Python worker.

Positions come from lengths: the pieces between the matches of a pattern and the matches themselves add
up to the text, in code points. Candidates of the method are unbroken runs of ``[A-Za-z0-9+/_=-]`` of at
least ``window`` characters. A window slides over a run one character at a time. Its state is the count of
each character in it and the sum of c * log2(c) over the counts, in whole millionths of a bit, so that a
step changes two counts and two terms, and nothing drifts. The entropy is log2(window) - sum / window. A window
belongs to the class of the characters in it and is flagged from that class's limit on:

- hex: only ``[0-9a-f]`` or only ``[0-9A-F]``, with a digit and a letter
- mixed: a lower letter, an upper letter and a digit
- plain: lower letters or upper letters with at least four digits, and nothing of the other case
- all else (words, numbers, rules of dashes) is never flagged

Flagged windows that overlap are one span, of kind ``entropy``. Runs that fit the allow-list are left out:
UUIDs, runs with a listed placeholder in them, dates and version marks, and paths of lower-case words.
A span inside a span of the base patterns is not listed again; base spans are never left out.

A null text is empty. Rows with equal ids are separate rows. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
#: kind, pattern, whether group 1 has to hold six characters; the other two patterns hold their own
#: lengths, which changes no match: a run that is too short has no longer run inside it
BASE = (("assign", ASSIGN, 6), ("access", r"AKIA[A-Z0-9]{16,}", 0), ("hex", r"[0-9a-f]{24,}", 0))
WINDOW = 20
#: least entropy in millionths of a bit
LIMITS = {"hex": 3_000_000, "mixed": 3_700_000, "plain": 3_400_000}
ALLOWED = (
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"(?i)example|placeholder|changeme|dummy|sample|redacted|xxxx|0123456789|abcdefgh",
    r"^[0-9_/+=-]+$",
    r"^[a-z/_-]+$",
)
SCALE = 1_000_000


STEP = 512


def before_each(lengths: Column) -> Column:
    """For every element of an array the sum of those before it, in two levels: the list that is built
    up element by element is never longer than ``STEP`` or the number of steps."""

    def inner(xs: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(
            xs, start,
            lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"],
        )

    blocks = F.transform(F.sequence(F.lit(1), F.size(lengths), F.lit(STEP)), lambda i: F.slice(lengths, i, STEP))
    bases = inner(F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x)))
    return F.flatten(
        F.zip_with(blocks, bases, lambda b, base: F.transform(inner(b), lambda at: at + base))
    )


def located(df: DataFrame, text: str, pattern: str, out: str) -> DataFrame:
    """``df`` with ``out``: array of (start, end, found) of the matches of a pattern, in order."""
    spans = "array<struct<start:int,end:int,found:string>>"
    has = F.col(text).rlike(pattern)
    df = df.withColumn("__found", F.when(has, F.regexp_extract_all(F.col(text), F.lit(f"({pattern})"), F.lit(1))))
    df = df.withColumn("__gaps", F.when(has, F.transform(F.split(F.col(text), pattern, -1), F.char_length)))
    both = F.zip_with("__gaps", F.transform("__found", F.char_length), lambda g, n: g + F.coalesce(n, F.lit(0)))
    df = df.withColumn("__before", F.when(has, before_each(both)))
    shifted = F.zip_with("__before", "__gaps", lambda b, g: b + g)
    each = F.transform(
        F.arrays_zip(F.col("__found").alias("found"), F.slice(shifted, 1, F.size("__found")).alias("start")),
        lambda x: F.struct(x["start"].alias("start"), (x["start"] + F.char_length(x["found"])).alias("end"), x["found"].alias("found")),
    )
    return df.withColumn(out, F.when(has, each).otherwise(F.array().cast(spans))).drop("__found", "__gaps", "__before")


def term(count: Column, window: int) -> Column:
    """c * log2(c) in millionths, from the list of all of them."""
    known = [0] + [round(c * math.log2(c) * SCALE) for c in range(1, window + 1)]
    return F.element_at(F.array(*map(F.lit, known)), count + 1)


def place(code: Column) -> Column:
    """Class of a character: lower hex letter, other lower, upper hex letter, other upper, digit, other."""
    return (
        F.when(code.between(97, 102), 0).when(code.between(103, 122), 1).when(code.between(65, 70), 2)
        .when(code.between(71, 90), 3).when(code.between(48, 57), 4).otherwise(5)
    )


def class_limit(count: Callable[[int], Column], limits: dict[str, int]) -> Column:
    """The limit of the class that a window with these counts per kind of character belongs to, or null."""
    lower, upper, digits = count(0) + count(1), count(2) + count(3), count(4)
    one_case = ((lower == 0) | (upper == 0)) & (lower + upper > 0)
    return (
        F.when((digits > 0) & one_case & (count(1) + count(3) + count(5) == 0), limits["hex"])
        .when((lower > 0) & (upper > 0) & (digits > 0), limits["mixed"])
        .when((digits >= 4) & one_case, limits["plain"])
    )


def flagged(run: Column, window: int, limits: dict[str, int]) -> Column:
    """array of (start, end), from 0, of the stretches of a run that its flagged windows cover."""
    codes = F.transform(F.split(run, ""), lambda c: F.ascii(c) - 43)  # '+' is the least character of a run
    held = 80  # places of the characters; the six classes stand behind them
    steps = F.zip_with(
        codes, F.slice(F.concat(F.array_repeat(F.lit(None).cast("int"), window), codes), 1, F.size(codes)),
        lambda new, old: F.struct(
            new.alias("new"), (held + place(new + 43)).alias("new_class"), F.coalesce(old, F.lit(-1)).alias("old"),
            F.when(old.isNull(), -1).otherwise(held + place(old + 43)).alias("old_class"),
        ),
    )
    whole = round(math.log2(window) * SCALE * window)  # window times the entropy of all characters different
    span = lambda a, b: F.struct(a.alias("start"), b.alias("end"))
    one = lambda x, name: F.transform(F.array(x), name)[0]  # noqa: E731  a name for a value

    def step(acc: Column, x: Column) -> Column:
        had, has = F.get(acc["counts"], x["old"]), F.get(acc["counts"], x["new"])
        less = F.when(x["old"] < 0, 0).otherwise(term(had, window) - term(had - 1, window))
        more = term(has + 1, window) - term(has, window)
        total = acc["total"] + F.when(x["old"] == x["new"], 0).otherwise(more - less)
        counts = F.transform(
            acc["counts"],
            lambda c, i: c + F.when(i.isin(x["new"], x["new_class"]), 1).otherwise(0) - F.when(i.isin(x["old"], x["old_class"]), 1).otherwise(0),
        )

        def after(state: Column) -> Column:
            limit = class_limit(lambda k: F.get(state["counts"], F.lit(held + k)), limits)
            start = acc["at"] + 1 - window
            hit = (start >= 0) & F.coalesce(whole - state["total"] >= limit * window, F.lit(False))
            joined = acc["end"] >= start
            return F.struct(
                (acc["at"] + 1).alias("at"), state["counts"].alias("counts"), state["total"].alias("total"),
                F.when(hit & ~joined, start).otherwise(acc["start"]).alias("start"),
                F.when(hit, start + window).otherwise(acc["end"]).alias("end"),
                F.when(hit & ~joined & (acc["end"] > 0), F.concat(acc["out"], F.array(span(acc["start"], acc["end"])))).otherwise(acc["out"]).alias("out"),
            )

        return one(F.struct(counts.alias("counts"), total.alias("total")), after)

    start = F.struct(
        F.lit(0).alias("at"), F.array_repeat(F.lit(0), held + 6).alias("counts"), F.lit(0).alias("total"),
        F.lit(-1).alias("start"), F.lit(-1).alias("end"), F.array().cast("array<struct<start:int,end:int>>").alias("out"),
    )
    return F.aggregate(
        steps, start, step,
        lambda acc: F.when(acc["end"] > 0, F.concat(acc["out"], F.array(span(acc["start"], acc["end"])))).otherwise(acc["out"]),
    )


def scan(
    df: DataFrame, window: int = WINDOW, limits: dict[str, int] | None = None, allowed: Sequence[str] = ALLOWED,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, base, added) of every row: arrays of (start, rank, end, kind) by start and rank; ``base``
    holds the spans of the patterns, ``added`` those of the sliding window."""
    rows = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    for kind, pattern, least in BASE:
        rows = located(rows, "text", pattern, kind)
        if least:
            rows = rows.withColumn(kind, F.filter(kind, lambda x: F.char_length(F.regexp_extract(x["found"], pattern, 1)) >= least))
    spans = lambda kind, rank: F.transform(
        kind, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["end"].alias("end"), F.lit(kind).alias("kind"))
    )
    rows = rows.withColumn("base", F.array_sort(F.concat(*[spans(kind, i) for i, (kind, *_) in enumerate(BASE)])))
    rows = located(rows, "text", f"[A-Za-z0-9+/_=-]{{{window},}}", "runs")
    fits = lambda x: [~x["found"].rlike(a) for a in allowed]
    rows = rows.withColumn("runs", F.filter("runs", lambda x: reduce(lambda a, b: a & b, fits(x), F.lit(True))))
    each = F.flatten(F.transform("runs", lambda r: F.transform(
        flagged(r["found"], window, limits or LIMITS),
        lambda s: F.struct((r["start"] + s["start"]).alias("start"), F.lit(len(BASE)).alias("rank"), (r["start"] + s["end"]).alias("end"), F.lit("entropy").alias("kind")),
    )))
    rows = rows.withColumn("added", each)
    inside = lambda s: F.exists("base", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))
    return rows.select("doc_id", "base", F.filter("added", lambda s: ~inside(s)).alias("added"))


def spelled(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def judge(df: DataFrame, **parameters) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    found = scan(df, **parameters)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind, *_ in BASE], F.sha2(spelled(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spelled(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
