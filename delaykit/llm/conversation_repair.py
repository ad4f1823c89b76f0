"""Conversation structure repair by Four-Russians block tables (method 13).

The rows of a conversation are read as symbols: the role's initial with or without a truncated text,
or "must go" for a blank row and a repeated one. The cheapest edits that turn the initials into
``(s?(ua)+)?`` are found by dynamic programming over four states (nothing yet, after s, after u,
after a). The cost to go from the four states, less its smallest value, is one of a few vectors, so a
block of ``BLOCK`` symbols is a lookup: the vector behind it gives the vector before it and what is
added. The same tables tell in which state a block ends that is entered in a given state. Blocks are
walked from the last to the first and then expanded, each letter the least in ASCII among those that
the cost to go allows, so the whole string of edits is the least among the cheapest.

A conversation may hold a third of all rows. Rows are sorted by range over all tasks and cut into
chunks of at most ``CHUNK`` rows; a chunk is a map from the vector behind it to the vector before it,
and such maps are chained per conversation, one short row per chunk. Texts cross one shuffle, for the
digest of the repaired conversation, which reads them as a stream and holds one text at a time.

Rows with equal turns (the contract leaves their order open) go by role, then by SHA-256 of the text.
A null turn comes first; a null role or text is one space; a null conversation is a conversation of
its own; an empty role counts as a role of one space. A role that starts with another letter than s,
u, a can only be deleted or given another role. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit.llm.common import in_arrow, written
from delaykit.operators.lookup import fits_broadcast

BLOCK = 4
CHUNK = 1 << 16
SPACES = " \t\n\x0b\x0c\r"
# symbols: 2 * place of the initial + truncated, then a row that must go, then the filling of short blocks
INITIALS = "sua"
OTHER, GONE, PAD, SYMBOLS = 6, 8, 9, 10
START, AFTER_S, AFTER_U, AFTER_A = range(4)
STATES = 4
DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1


def by_letter(state: int, letter: str) -> int | None:
    """The state after a row with this initial, or None where it would break the form."""
    if letter == "s":
        return AFTER_S if state == START else None
    if letter == "a":
        return AFTER_A if state == AFTER_U else None
    return AFTER_U if letter == "u" and state != AFTER_U else None


def other_role(state: int) -> int:
    """The state after the one of user and assistant that fits."""
    return AFTER_A if state == AFTER_U else AFTER_U


def own_edits(symbol: int, state: int):
    """(letter, cost, next state) of the edits that use up a row, in ASCII order."""
    yield "D", DELETE, state
    if symbol != GONE:
        cut = CUT * (symbol % 2)
        letter = INITIALS[symbol // 2] if symbol < OTHER else ""
        after = by_letter(state, letter)
        if after is not None:
            yield "K", cut, after
        yield "R", REROLE + cut, other_role(state)


def before(symbol: int, behind: tuple[int, ...]) -> list[int]:
    """Cost to go from each state in front of a row, inserted rows included."""
    if symbol == PAD:
        return list(behind)
    costs = [min(c + behind[to] for _, c, to in own_edits(symbol, q)) for q in range(STATES)]
    for _ in range(2):  # two inserted rows reach every state that inserting can reach
        costs = [min(costs[q], INSERT + costs[other_role(q)]) for q in range(STATES)]
    return costs


def expansion(symbol: int, front: list[int], behind: tuple[int, ...], state: int) -> tuple[str, int]:
    """The least letters of the cheapest edits of one row, and the state after it."""
    if symbol == PAD:
        return "", state
    out, left = "", front[state]
    while True:
        moves = {letter: (c, to) for letter, c, to in own_edits(symbol, state) if c + behind[to] == left}
        if "D" in moves:
            return out + "D", state
        if INSERT + front[other_role(state)] == left:
            state = other_role(state)
            out, left = out + "I", front[state]
            continue
        letter = min(moves)
        return out + letter, moves[letter][1]


@lru_cache(1)
def tables():
    """(step, added, after, letters) of single symbols and (step, added, after) of blocks.

    ``step[s, v]`` is the vector before symbol ``s`` when ``v`` is the one behind it, ``added`` what the
    smallest cost rises by; ``after[s, v, q]`` is the state in which ``s`` ends when entered in ``q``.
    Vector 0 is the end of a conversation.
    """
    vectors, moves, place = [(0, 2 * INSERT, INSERT, 0)], {}, 0
    while place < len(vectors):  # vectors found on the way are visited too
        vector = vectors[place]
        for symbol in range(SYMBOLS):
            front = before(symbol, vector)
            low = min(front)
            shape = tuple(c - low for c in front)
            if shape not in vectors:
                vectors.append(shape)
            moves[symbol, place] = vectors.index(shape), low, [expansion(symbol, front, vector, q) for q in range(STATES)]
        place += 1
    n = len(vectors)
    step, added = np.zeros((SYMBOLS, n), np.int64), np.zeros((SYMBOLS, n), np.int64)
    after, letters = np.zeros((SYMBOLS, n, STATES), np.int64), {}
    for (s, v), (to, low, ways) in moves.items():
        step[s, v], added[s, v] = to, low
        for q, (text, end) in enumerate(ways):
            after[s, v, q], letters[s, v, q] = end, text
    # blocks: the code is the symbols as decimal digits, the first one in front
    codes = np.arange(SYMBOLS**BLOCK)[:, None]
    digits = [codes // SYMBOLS ** (BLOCK - 1 - i) % SYMBOLS for i in range(BLOCK)]
    behind, total, seen = np.broadcast_to(np.arange(n), (SYMBOLS**BLOCK, n)), 0, []
    for i in reversed(range(BLOCK)):
        seen.append(behind)
        total = total + added[digits[i], behind]
        behind = step[digits[i], behind]
    state = np.broadcast_to(np.arange(STATES), (SYMBOLS**BLOCK, n, STATES))
    for i, v in enumerate(reversed(seen)):
        state = after[digits[i][:, :, None], v[:, :, None], state]
    return (step, added, after, letters), (behind, total, state), vectors


def block_codes(symbols: np.ndarray) -> np.ndarray:
    filled = np.full(-len(symbols) % BLOCK + len(symbols), PAD, np.int64)
    filled[: len(symbols)] = symbols
    return filled.reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))


def boundaries(codes: np.ndarray, v: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Vector behind every block, and what the costs rise by in all, for each vector ``v`` behind the last."""
    step, added = tables()[1][:2]
    behind, total = [], np.zeros(len(v), np.int64)
    for code in codes[::-1]:
        behind.append(v)
        total = total + added[code, v]
        v = step[code, v]
    behind.append(v)
    return behind[::-1], total


def chunk_map(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every vector behind the chunk: the one before it, the rise of costs, the end state of each start."""
    codes = block_codes(symbols)
    n = len(tables()[2])
    behind, total = boundaries(codes, np.arange(n))
    state = np.tile(np.arange(STATES), (n, 1))
    after = tables()[1][2]
    for code, v in zip(codes, behind[1:]):
        state = after[code, v[:, None], state]
    return behind[0], total, state


@lru_cache(1 << 16)
def block_letters(code: int, v: int, state: int) -> tuple[list[str], int]:
    """The letters of each row of a block, expanded backward and then read forward."""
    step, _, after, letters = tables()[0]
    digits = [code // SYMBOLS ** (BLOCK - 1 - i) % SYMBOLS for i in range(BLOCK)]
    behind = []
    for s in reversed(digits):
        behind.append(v)
        v = int(step[s, v])
    out = []
    for s, v in zip(digits, reversed(behind)):
        out.append(letters[s, v, state])
        state = int(after[s, v, state])
    return out, state


def chunk_letters(symbols: np.ndarray, v: int, state: int) -> list[str]:
    """The letters of each row, given the vector behind the chunk and the state in front of it."""
    codes = block_codes(symbols)
    behind, _ = boundaries(codes, np.array([v]))
    out = []
    for code, vector in zip(codes.tolist(), behind[1:]):
        more, state = block_letters(code, int(vector[0]), state)
        out += more
    return out[: len(symbols)]


def damaged(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, draw) after the damage that crc32 of ``conv:turn`` draws; a dropped row
    (draw 0) stays as a row that only names its conversation."""
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(name(conv_col), F.lit(":"), name(turn_col)).cast("binary")) % 20
    return df.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.when(draw == 4, "user").otherwise(name(role_col)).alias("role"),
        F.when(draw <= 1, "").when(draw == 2, F.regexp_replace(name(text_col), "[.!?]", "")).otherwise(name(text_col)).alias("text"),
        draw.alias("draw"),
    )


def undamaged(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """The rows as they are, in the form of :func:`damaged`."""
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return df.select(
        F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        name(role_col).alias("role"), name(text_col).alias("text"), F.lit(5).cast("long").alias("draw"),
    )


def digest_of(text: Column) -> Column:
    return F.unhex(F.left(F.sha2(text, 256), F.lit(32)))


def light_rows(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, h, n, blank, cut, again) of every distinct row: no text, 16 bytes of its hash.

    ``again``: role and text stand at an earlier turn. The first copy of a row is judged by it, the
    other ``n - 1`` are repeats.
    """
    last = F.right(F.rtrim(F.col("text"), F.lit(SPACES)), F.lit(1))
    light = rows.filter("draw <> 0").select(
        "conv", "turn", "role", digest_of(F.col("text")).alias("h"), F.when(F.col("draw") == 3, 2).otherwise(1).alias("n"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"),
    )
    light = written(
        light.groupBy("conv", "turn", "role", "h")
        .agg(F.sum("n").alias("n"), F.first("blank").alias("blank"), F.first("cut").alias("cut")), "light",
    )
    # only what stands at two turns or more is joined back; nulls are the least of a struct
    first = (
        light.filter("NOT blank").groupBy("conv", "role", "h")
        .agg(F.min(F.struct("turn")).alias("least"), F.count("*").alias("turns")).filter("turns > 1")
        .select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("h").alias("g"), "least")
    )
    first = written(first, "repeats")
    both = light.join(
        F.broadcast(first) if fits_broadcast(first) else first,
        F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("g")), "left",
    )
    again = F.col("least").isNotNull() & ~F.col("turn").eqNullSafe(F.col("least.turn"))
    return both.select("conv", "turn", "role", "h", "n", "blank", "cut", again.alias("again"))


ORDER = ["conv", "turn", "role", "h"]
COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def chunk_fields(conv: T.DataType) -> T.StructType:
    simple = {
        "conv": conv, "turns": "array<long>", "roles": "array<string>", "hs": "array<binary>", "copies": "array<long>",
        "symbols": "binary", "vmap": "array<long>", "rise": "array<long>", "ends": "array<long>", "head": "string", "tail": "string",
        "turn_count": "long", **dict.fromkeys(COUNTS, "long"), "extra": "long",
    }
    return T.StructType([T.StructField(k, v if isinstance(v, T.DataType) else T._parse_datatype_string(v)) for k, v in simple.items()])


def chunk_of(conv, rows: list[tuple]) -> dict:
    """One chunk: its rows by column, its map, and its counts."""
    turns, roles, hs, copies, blank, cut, again = zip(*rows)
    heads = [(r[:1] or " ") for r in roles]
    symbols = np.array(
        [GONE if b or d else 2 * INITIALS.find(h) + c if h in INITIALS else OTHER + c for h, b, c, d in zip(heads, blank, cut, again)],
        np.int64,
    )
    vmap, rise, ends = chunk_map(symbols)
    known = [t for t in turns if t is not None]
    pairs = sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:]))
    spare = [n - 1 for n in copies]
    return {
        "conv": conv, "turns": turns, "roles": roles, "hs": hs, "copies": copies, "symbols": symbols.astype(np.uint8).tobytes(),
        "vmap": vmap.tolist(), "rise": rise.tolist(), "ends": ends.ravel().tolist(), "head": heads[0], "tail": heads[-1],
        "turn_count": sum(a != b for a, b in zip(known[1:], known)) + bool(known),
        "blank": sum(n for n, b in zip(copies, blank) if b),
        "duplicate": sum(n - (not d) for n, b, d in zip(copies, blank, again) if not b),
        "truncated": sum(c and not b and not d for b, c, d in zip(blank, cut, again)),
        "illegal": pairs + sum(spare), "extra": DELETE * sum(spare),
    }


def rows_of(batches):
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def in_batches(rows, schema: pa.Schema, count: int = 2048):
    """Record batches of at most ``count`` of the given dictionaries."""
    held = []
    for row in rows:
        held.append(row)
        if len(held) == count:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def arrow_schema(fields: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(fields)


def chunks(light: DataFrame) -> DataFrame:
    """Chunks of neighbouring rows of one conversation, with an id."""
    fields = chunk_fields(light.schema["conv"].dataType)

    def run(batches):
        def made():
            for conv, rows in groupby(rows_of(batches), key=lambda r: r[0]):
                held = []
                for row in rows:
                    held.append(row[1:])
                    if len(held) == CHUNK:
                        yield chunk_of(conv, held)
                        held = []
                if held:
                    yield chunk_of(conv, held)

        return in_batches(made(), arrow_schema(fields), 64)

    dealt = light.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    made = in_arrow(dealt.select(*ORDER, "n", "blank", "cut", "again"), run, fields)
    return written(made.withColumn("chunk", F.monotonically_increasing_id()), "chunks")


def chained(parts: DataFrame) -> DataFrame:
    """(chunk, v, state, end, conv, gaps, counts, cost) of every chunk; ``end`` is what is inserted behind
    the last one, and the totals of a conversation stand at its first chunk only."""
    conv = parts.schema["conv"].dataType
    totals = ["gaps", *COUNTS, "cost"]
    fields = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("v", T.LongType()), T.StructField("state", T.LongType()),
        T.StructField("end", T.StringType()), T.StructField("conv", conv), *[T.StructField(c, T.LongType()) for c in totals],
    ])
    short = parts.select(
        "conv", F.col("turns")[0].alias("turn"), F.col("roles")[0].alias("role"), F.col("hs")[0].alias("h"),
        "chunk", "vmap", "rise", "ends", "head", "tail", "turn_count", *COUNTS, "extra",
        F.array_min("turns").alias("low"), F.array_max("turns").alias("high"),
        F.element_at("turns", -1).alias("last"),
    )
    names = short.columns

    def run(batches):
        vectors = tables()[2]

        def made():
            for name, group in groupby(rows_of(batches), key=lambda r: r[0]):
                group = [dict(zip(names, r)) for r in group]
                v, cost, behind = 0, 0, []
                for g in reversed(group):
                    behind.append(v)
                    cost += g["rise"][v] + g["extra"]
                    v = g["vmap"][v]
                cost += vectors[v][START]
                count = {c: sum(g[c] for g in group) for c in COUNTS}
                turns = sum(g["turn_count"] for g in group)
                for a, b in zip(group, group[1:]):
                    count["illegal"] += a["tail"] + b["head"] not in ("su", "ua", "au")
                    turns -= a["last"] is not None and a["last"] == b["turn"]
                low = min((g["low"] for g in group if g["low"] is not None), default=None)
                high = max((g["high"] for g in group if g["high"] is not None), default=None)
                total = {"conv": name, "gaps": 0 if low is None else high - low + 1 - turns, **count, "cost": cost}
                state = START
                for i, (g, v) in enumerate(zip(group, reversed(behind))):
                    row = {"chunk": g["chunk"], "v": v, "state": state, "conv": name, **(total if i == 0 else {})}
                    state = g["ends"][STATES * v + state]
                    if i + 1 == len(group):
                        row["end"] = {AFTER_S: "II", AFTER_U: "I"}.get(state, "")
                    yield row

        return in_batches(made(), arrow_schema(fields))

    dealt = short.repartition("conv").sortWithinPartitions("conv", "turn", "role", "h")
    return written(in_arrow(dealt.select(*names), run, fields), "chain")


def edits(parts: DataFrame, chain: DataFrame) -> DataFrame:
    """(conv, turn, role, h, edits) of every distinct row, and a last row with what is inserted at the end
    (``place`` 2)."""
    conv = parts.schema["conv"].dataType
    fields = T.StructType([
        T.StructField("conv", conv), T.StructField("place", T.IntegerType()), T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("h", T.BinaryType()), T.StructField("edits", T.StringType()),
    ])
    known = chain.select("chunk", "v", "state", "end")
    both = parts.select("chunk", "conv", "turns", "roles", "hs", "copies", "symbols").join(
        F.broadcast(known) if fits_broadcast(known) else known, "chunk"
    )

    def run(batches):
        def made():
            for _, name, turns, roles, hs, copies, symbols, v, state, end in rows_of(batches):
                letters = chunk_letters(np.frombuffer(symbols, np.uint8), v, state)
                for turn, role, h, n, own in zip(turns, roles, hs, copies, letters):
                    yield {"conv": name, "place": 1, "turn": turn, "role": role, "h": h, "edits": own + "D" * (n - 1)}
                if end:
                    yield {"conv": name, "place": 2, "edits": end}

        return in_batches(made(), arrow_schema(fields))

    return in_arrow(both, run, fields)


class Walk:
    """Repaired rows of one conversation, one at a time, as its edits and texts go by."""

    def __init__(self):
        self.state, self.audit, self.pending = START, [], None

    def insert(self):
        self.state = other_role(self.state)
        return ("assistant" if self.state == AFTER_A else "user"), ""

    def begin(self, letters: str):
        """Inserted rows come out at once; what is kept waits for its text."""
        self.audit.append(letters)
        own = letters.lstrip("I")
        self.pending = own[:1]
        for _ in range(len(letters) - len(own)):
            yield self.insert()

    def text(self, role: str, text: str):
        letter, self.pending = self.pending, None
        if letter == "K":
            self.state = by_letter(self.state, role[:1])
            yield role, text
        elif letter == "R":
            role, _ = self.insert()
            yield role, text


def stream(rows: DataFrame, parts: DataFrame, chain: DataFrame) -> DataFrame:
    """Totals (place 0), edits and texts (place 1), end (place 2) of each conversation, in order in one partition."""
    totals = ["gaps", *COUNTS, "cost"]
    void = lambda *names: [F.lit(None).cast("long").alias(c) for c in names]
    texts = rows.select(
        "conv", F.when(F.col("draw") == 0, 0).otherwise(1).alias("place"), "turn", "role",
        F.when(F.col("draw") != 0, digest_of(F.col("text"))).alias("h"), F.lit(1).alias("late"), F.lit(None).cast("string").alias("edits"),
        F.when(F.col("draw") != 0, F.col("text")).alias("text"), *void(*totals),
    )
    own = edits(parts, chain).select(
        "conv", "place", "turn", "role", "h", F.lit(0).alias("late"), "edits", F.lit(None).cast("string").alias("text"), *void(*totals)
    )
    sums = chain.filter("cost IS NOT NULL").select(
        "conv", F.lit(0).alias("place"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("h"), F.lit(0).alias("late"), F.lit(None).cast("string").alias("edits"),
        F.lit(None).cast("string").alias("text"), *totals,
    )
    every = texts.union(own).union(sums)
    return every.repartition("conv").sortWithinPartitions("conv", "place", "turn", "role", "h", "late")


def prepared(rows: DataFrame) -> DataFrame:
    parts = chunks(light_rows(rows))
    return stream(rows, parts, chained(parts))


COLUMNS = {"conv_col": "conv_id", "turn_col": "turn", "role_col": "role", "text_col": "text"}


def repair(df: DataFrame, damage: bool = False, **columns: str) -> DataFrame:
    """(conv_id, place, role, text) of the repaired rows, ``place`` from 0 in every conversation."""
    rows = (damaged if damage else undamaged)(df, **{**COLUMNS, **columns})
    fields = T.StructType([
        T.StructField("conv_id", rows.schema["conv"].dataType), T.StructField("place", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    ])

    def run(batches):
        def made():
            for name, group in groupby(rows_of(batches), key=lambda r: r[0]):
                walk, place = Walk(), 0
                for _, where, _, role, _, late, letters, text, *_ in group:
                    out = walk.begin(letters) if letters is not None else walk.text(role, text) if where == 1 else ()
                    for role, text in out:
                        yield {"conv_id": name, "place": place, "role": role, "text": text}
                        place += 1

        return in_batches(made(), arrow_schema(fields), 256)

    return in_arrow(prepared(rows), run, fields)


def judge(df: DataFrame, damage: bool = True, **columns: str) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
    rows = (damaged if damage else undamaged)(df, **{**COLUMNS, **columns})
    totals = ["gaps", *COUNTS, "cost"]
    fields = T.StructType([
        T.StructField("conv_id", rows.schema["conv"].dataType), *[T.StructField(c, T.LongType()) for c in totals],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])

    def run(batches):
        def made():
            for name, group in groupby(rows_of(batches), key=lambda r: r[0]):
                walk, digest, row, first = Walk(), hashlib.sha256(), dict.fromkeys(totals, 0), True
                for _, where, _, role, _, late, letters, text, *sums in group:
                    if sums[-1] is not None:
                        row = dict(zip(totals, sums))
                    out = walk.begin(letters) if letters is not None else walk.text(role, text) if where == 1 else ()
                    for role, text in out:
                        digest.update((("" if first else "\n") + role + ":" + text).encode("utf-8", "surrogatepass"))
                        first = False
                yield {"conv_id": name, **row, "audit": "".join(walk.audit), "repaired_sha256": digest.hexdigest()}

        return in_batches(made(), arrow_schema(fields), 256)

    return in_arrow(prepared(rows), run, fields)
