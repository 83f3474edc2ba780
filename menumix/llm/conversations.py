"""Operator 12: repair of conversation structure by an auction for shortest paths.

A conversation is a lattice: node (i, state) stands before its i-th row, the state being
what the repaired role initials so far end in. Keep, Rerole and Delete lead past
a row, Insert leads to another state in the same place; every cycle costs something.
Rows are range-partitioned by conversation and turn and cut into pieces, so that a
conversation of any length is spread over tasks. Prices at the ends of pieces come
from an auction over the pieces; the rows of each piece are then priced and traced on their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from menumix.session import materialise

SPACES = "\\x20\\x09-\\x0D"
INF = 1 << 60
STATES = range(4)  # 0 nothing, 1 after s, 2 after u, 3 after a
TURN = {0: 2, 1: 2, 2: 3, 3: 2}  # the state that the only fitting user or assistant turn leads to
NAMES = {2: "user", 3: "assistant"}
KEEPS = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
FINAL = (0, 4, 2, 0)  # Insert is all that is left past the last row
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT, FAULT = 0, 2, 3, 2, 1
RUN = 24  # rows that one auction covers: its work grows with rows times cost, so runs stay short
PIECE_ROWS, PIECE_BYTES = 4096, 1 << 20


def auction(arcs: dict, origin, price: dict) -> int:
    """Distance from ``origin`` to the node None, whose price is 0.

    ``arcs[i]`` lists (cost, next node, letter). The path grows by the arc of least cost plus
    price while the last node's price says so (extension), else the price rises
    to it and the path gives up the node (contraction). Prices stay lower
    bounds of the distance, so a later call may start from them."""
    path = [origin]
    while path[-1] is not None:
        here = path[-1]
        best, after = INF, None
        for cost, node, _ in arcs[here]:
            if cost + price[node] < best:
                best, after = cost + price[node], node
        if price[here] < best:
            price[here] = best
            if len(path) > 1:
                path.pop()
            elif best >= INF:
                break
        elif best >= INF:  # a dead end that was known
            if len(path) == 1:
                break
            path.pop()
        else:
            path.append(after)
    return price[origin]


def tight_path(arcs: dict, origin, price: dict) -> list[tuple]:
    """[(letter, node)] of the path over tight arcs whose letters are ASCII-least.

    Every arc of every shortest path is tight, but a tight arc may lead to nodes off the
    shortest paths, from which no tight arc goes on: the trace steps back from those."""
    path, dead = [], set()
    at = [(origin, iter(sorted((letter, node) for cost, node, letter in arcs[origin] if price[origin] == cost + price[node])))]
    while at:
        for letter, node in at[-1][1]:
            if node is None:
                return [*path, (letter, node)]
            if node not in dead:
                path.append((letter, node))
                at.append((node, iter(sorted(((x, j) for c, j, x in arcs[node] if price[node] == c + price[j]), key=lambda e: e[0]))))
                break
        else:
            dead.add(at.pop()[0])
            if path:
                path.pop()
    raise ValueError("no way through the lattice")


def lattice(rows: tuple, ends: tuple) -> dict:
    """Arcs over ``rows`` and on to None at the prices ``ends`` of the four states past them.

    A row is (initial, faulty) or a number of rows that must go."""
    arcs = {}
    for i, row in enumerate(rows):
        for s in STATES:
            out = [(INSERT, (i, TURN[s]), "I")]
            if isinstance(row, int):
                out.append((DELETE * row, (i + 1, s), "D"))
            else:
                initial, fault = row
                kept = KEEPS.get((initial, s))
                out.append((DELETE, (i + 1, s), "D"))
                if kept is not None:
                    out.append((KEEP + FAULT * fault, (i + 1, kept), "K"))
                if kept != TURN[s]:
                    out.append((REROLE + FAULT * fault, (i + 1, TURN[s]), "R"))
            arcs[i, s] = out
    for s in STATES:
        arcs[len(rows), s] = [(ends[s], None, "")] if ends[s] < INF else []
    # Nodes that reach no end lose their arcs, for their prices would rise without limit.
    reach = {None}
    for i in range(len(rows), -1, -1):
        for s in (3, 2, 3, 1, 0):
            if any(node in reach for _, node, _ in arcs[i, s]):
                reach.add((i, s))
    return {here: [a for a in out if a[1] in reach] for here, out in arcs.items()}


def _shift(ends: tuple) -> tuple[tuple, int]:
    low = min(ends)
    return tuple(e if e >= INF else e - low for e in ends), low


@lru_cache(maxsize=20000)
def priced(rows: tuple, ends: tuple) -> tuple[tuple, dict, dict]:
    """(distances from the four states before ``rows``, arcs, prices). Many conversations look alike, hence the cache."""
    arcs = lattice(rows, ends)
    price = dict.fromkeys(arcs, 0) | {None: 0}
    return tuple(auction(arcs, (0, s), price) for s in STATES), arcs, price


@lru_cache(maxsize=20000)
def traced(rows: tuple, ends: tuple, entry: int) -> tuple[str, int]:
    """(letters, state past the rows) of the cheapest edits from ``entry``."""
    _, arcs, price = priced(rows, ends)
    path = tight_path(arcs, (0, entry), price)
    state = path[-2][1][1] if len(path) > 1 else entry
    letters, here = [], 0
    for letter, node in path[:-1]:
        letters.append(letter if letter == "I" or not isinstance(rows[here], int) else "D" * rows[here])
        here = node[0]
    return "".join(letters), state


def runs(rows: list) -> list[tuple]:
    return [tuple(rows[i:i + RUN]) for i in range(0, len(rows), RUN)]


def end_prices(rows: list, ends: tuple) -> tuple[list[tuple], tuple]:
    """([(run, prices past it)], prices before the first): auctions from the last run to the first, each on the prices of the next."""
    out, base = [], 0
    for run in reversed(runs(rows)):
        ends, low = _shift(ends)
        base += low
        out.append((run, ends))
        ends = priced(run, ends)[0]
    return out[::-1], tuple(e if e >= INF else e + base for e in ends)


def repair(rows: list, ends: tuple, entry: int) -> tuple[str, int, int]:
    """(audit, state past the rows, cost); ``ends`` are the costs still to come from each state."""
    letters, state = [], entry
    run_prices, before = end_prices(rows, ends)
    for run, prices in run_prices:
        part, state = traced(run, prices, state)
        letters.append(part)
    return "".join(letters), state, before[entry] - ends[state]


def costs_through(rows: list) -> list[int]:
    """Cheapest cost from each of four states before the rows to each of four past them."""
    out = [[0] * 4 for _ in STATES]
    for t in STATES:
        for s, cost in enumerate(end_prices(rows, tuple(0 if t == x else INF for x in STATES))[1]):
            out[s][t] = min(cost, INF)
    return [c for row in out for c in row]


def piece_prices(pieces: list[list[int]]) -> list[tuple[tuple, list[int]]]:
    """(prices past a piece, states before it that a shortest path may have) of the pieces of one conversation, by auctions from the last to the first."""
    ends, past, before = FINAL, [], []
    for costs in reversed(pieces):
        arcs = {s: [(costs[4 * s + t], t + 4, "") for t in STATES if costs[4 * s + t] < INF] for s in STATES}
        arcs |= {t + 4: [(ends[t], None, "")] for t in STATES}
        price = dict.fromkeys(arcs, 0) | {None: 0}
        past.append(ends)
        ends = tuple(auction(arcs, s, price) for s in STATES)
        before.append(ends)
    out, may = [], {0}
    for costs, after, here in zip(pieces, reversed(past), reversed(before)):
        out.append((after, sorted(may)))
        may = {t for s in may for t in STATES if here[s] == costs[4 * s + t] + after[t]}
    return out


def lines(letters: str, entry: int, roles: list[str], texts: list[str], counts: list[int]) -> list[str]:
    """The repaired ``role:text`` lines; ``counts`` say for how many equal rows each stands."""
    out, state, row, left = [], entry, 0, counts[0] if counts else 0
    for x in letters:
        if x == "I" or x == "R":
            state = TURN[state]
            out.append(f"{NAMES[state]}:{texts[row] if x == 'R' else ''}")
        elif x == "K":
            state = KEEPS[roles[row][:1], state]
            out.append(f"{roles[row]}:{texts[row]}")
        if x != "I":
            left -= 1
            if not left and row + 1 < len(counts):
                row += 1
                left = counts[row]
    return out


# --- damage and faults ------------------------------------------------------------
def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, n) after damage by crc32 of ``conv:turn`` modulo 20; n is the number of equal rows, 0 for dropped ones."""
    blank = F.lit(" ")
    conv, turn = F.col(f"`{conv_col}`").cast("long"), F.col(f"`{turn_col}`").cast("long")
    kind = F.pmod(F.crc32(F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"), F.coalesce(turn.cast("string"), blank)).cast("binary")), F.lit(20))
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), blank) for c in (role_col, text_col))
    return df.select(
        conv.alias("conv"), turn.alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("n"))


def is_blank() -> Column:
    return ~F.col("text").rlike(f"[^{SPACES}]")


def is_open() -> Column:
    return ~F.expr("trim(TRAILING ' \\t\\n\\u000b\\u000c\\r' FROM text)").rlike("[.!?]\\z")


def with_faults(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn as one with their number, and (blank, first, open): whether they are
    blank, hold the first occurrence of their role and text, and do not end as a sentence."""
    same = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    same = materialise(same.withColumn("mark", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))), "conversation_rows")
    at = F.struct("turn")  # nulls first
    firsts = same.where("n > 0").groupBy("conv", "mark").agg(F.min(at).alias("at")).select(
        F.col("conv").alias("c"), F.col("mark").alias("m"), F.col("at.turn").alias("t"))
    is_first = same["conv"].eqNullSafe(firsts["c"]) & (same["mark"] == firsts["m"]) & same["turn"].eqNullSafe(firsts["t"])
    return same.join(firsts, is_first, "left").select(
        "conv", "turn", "role", "text", "n", is_blank().alias("blank"), F.col("m").isNotNull().alias("first"), is_open().alias("open"))


def counters(rows: DataFrame) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated) of every conversation."""
    one = F.when(~F.col("blank") & F.col("first") & (F.col("n") > 0), 1).otherwise(0)
    by_turn = rows.groupBy("conv", "turn").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - one)).alias("duplicate"), F.sum(F.when(F.col("open"), one).otherwise(0)).alias("truncated"))
    here = F.when(F.col("n") > 0, F.col("turn"))
    gaps = F.coalesce(F.max(here) - F.min(here) + 1 - F.count(here), F.lit(0))
    return by_turn.groupBy("conv").agg(gaps.alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])


# --- pieces -----------------------------------------------------------------------
PIECE = "conv long, part int, nth int, whole boolean, roles array<string>, texts array<string>, counts array<long>, firsts array<boolean>, opens array<boolean>, through array<long>"
PIECES = pa.schema([("conv", pa.int64()), ("part", pa.int32()), ("nth", pa.int32()), ("whole", pa.bool_()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
                    ("counts", pa.list_(pa.int64())), ("firsts", pa.list_(pa.bool_())), ("opens", pa.list_(pa.bool_())), ("through", pa.list_(pa.int64()))])
PRICES = "part int, nth int, ends array<long>, entries array<int>"
WAYS = pa.schema([("entry", pa.int32()), ("exit", pa.int32()), ("cost", pa.int64()), ("audit", pa.string()), ("empty", pa.bool_()), ("text", pa.string())])
TRACE = "conv long, part int, nth int, whole boolean, illegal long, head string, tail string, ways array<struct<entry int, exit int, cost long, audit string, empty boolean, text string>>"
TRACES = pa.schema([("conv", pa.int64()), ("part", pa.int32()), ("nth", pa.int32()), ("whole", pa.bool_()), ("illegal", pa.int64()), ("head", pa.string()), ("tail", pa.string()),
                    ("ways", pa.list_(pa.struct(list(WAYS))))])
RESULT = "conv long, illegal long, cost long, audit string, repaired_sha256 string"
RESULTS = pa.schema([("conv", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _rows(batches: Iterator[pa.RecordBatch], step: int = 64) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield from batch.slice(at, step).to_pylist()


def _send(rows: Iterator[dict], schema: pa.Schema, many: int = 256, most_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += row.pop("_bytes", 0)
        if len(held) >= many or size > most_bytes:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema=schema)


def _symbols(roles: list, counts: list, firsts: list, opens: list) -> list:
    """Lattice rows: (initial, faulty) for a row that may stay, a number for those that must go."""
    out = []
    for role, n, first, fault in zip(roles, counts, firsts, opens):
        if first:
            out.append((role[:1] if role[:1] in ("s", "u", "a") else "-", int(fault)))
        if n - first:
            out.append(int(n - first))
    return out


def _pieces(rows: Iterator[dict]) -> Iterator[dict]:
    """Pieces of the sorted rows of one task; the first and the last conversation may go on in other tasks."""
    part, held, conv, nth, size, begun = TaskContext.get().partitionId(), [], None, 0, 0, True  # begun: may have pieces before this one

    def piece(whole: bool) -> dict:
        roles, texts, counts, firsts, opens = ([r[c] for r in held] for c in ("role", "text", "n", "first", "open"))
        through = [] if whole else costs_through(_symbols(roles, counts, firsts, opens))
        return {"conv": conv, "part": part, "nth": nth, "whole": whole, "roles": roles, "texts": texts, "counts": counts, "firsts": firsts, "opens": opens, "through": through, "_bytes": size}

    for row in rows:
        if held and row["conv"] != conv:
            yield piece(whole=not begun)
            held, nth, size, begun = [], nth + 1, 0, False
        elif len(held) >= PIECE_ROWS or size > PIECE_BYTES:
            yield piece(whole=False)
            held, nth, size, begun = [], nth + 1, 0, True
        conv = row["conv"]
        held.append(row)
        size += len(row["text"])
    if held:
        yield piece(whole=False)


def _priced_pieces(rows: Iterator[dict]) -> Iterator[dict]:
    """Prices and entry states of the pieces of each conversation, which come in order; a piece of thousands of rows is sixteen numbers here."""
    for _, group in groupby(rows, key=lambda r: r["conv"]):
        group = list(group)
        for row, (ends, entries) in zip(group, piece_prices([r["through"] for r in group])):
            yield {"part": row["part"], "nth": row["nth"], "ends": ends, "entries": entries}


def _illegal(roles: list[str], counts: list[int]) -> int:
    """Adjacent role initials other than su, ua and au; equal rows stand side by side."""
    initials = [r[:1] for r in roles]
    return sum(n - 1 for n in counts) + sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _trace(rows: Iterator[dict]) -> Iterator[dict]:
    """The edits of each piece from every state before it that a shortest path may have."""
    for row in rows:
        symbols, ends = _symbols(row["roles"], row["counts"], row["firsts"], row["opens"]), tuple(row["ends"] or FINAL)
        ways = []
        for entry in row["entries"] or [0]:
            audit, exit_, cost = repair(symbols, ends, entry)
            left = lines(audit, entry, row["roles"], row["texts"], row["counts"])
            ways.append({"entry": entry, "exit": exit_, "cost": cost, "audit": audit, "empty": not left, "text": "\n".join(left)})
        yield {"conv": row["conv"], "part": row["part"], "nth": row["nth"], "whole": row["whole"], "illegal": _illegal(row["roles"], row["counts"]),
               "head": row["roles"][0][:1], "tail": row["roles"][-1][:1], "ways": ways, "_bytes": sum(len(w["text"]) for w in ways)}


def _chain(rows: Iterator[dict]) -> Iterator[dict]:
    """Results of whole conversations: pieces in order, each from the state where the one before ends; texts only pass through the digest."""
    for conv, group in groupby(rows, key=lambda r: r["conv"]):
        state, illegal, cost, audit, digest, tail, some = 0, 0, 0, [], hashlib.sha256(), None, False
        for row in group:
            way = next(w for w in row["ways"] if w["entry"] == state)
            if not way["empty"]:
                digest.update(("\n" if some else "").encode() + way["text"].encode())
                some = True
            illegal += row["illegal"] + (tail is not None and tail + row["head"] not in LEGAL)
            state, tail = way["exit"], row["tail"]
            cost += way["cost"]
            audit.append(way["audit"])
        cost += FINAL[state]
        while FINAL[state]:
            state = TURN[state]
            digest.update(("\n" if some else "").encode() + f"{NAMES[state]}:".encode())
            audit.append("I")
        yield {"conv": conv, "illegal": illegal, "cost": cost, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def _step(work, schema: pa.Schema):
    return lambda batches: _send(work(_rows(batches)), schema)


def repair_conversations(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, n) rows, see ``damaged``, to one row for each conversation.

    Columns: conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256. Rows come by turn (nulls first), then role and text; equal
    rows of a turn stand side by side and travel as one row with their number, so a row that
    is repeated without end is one row to sort. Of a row the first fault counts: blank, duplicate
    (its role and text occurred earlier), truncated. Conversations whose rows all have n = 0 give zeros, an
    empty audit and the digest of nothing; a null conversation id is one of its own. An empty table gives an empty result.

    The audit has one letter for each row and the digest reads the repaired text in order, so one task
    streams the pieces of a conversation at the end; everything before is dealt by rows.
    """
    rows = materialise(with_faults(df), "conversation_faults")
    there = rows.where("n > 0").select("conv", "turn", "role", "text", "n", (F.col("first") & ~F.col("blank")).alias("first"), "open")
    there = there.repartitionByRange("conv", "turn", "role", "text").sortWithinPartitions("conv", "turn", "role", "text")
    pieces = materialise(there.mapInArrow(_step(_pieces, PIECES), PIECE), "conversation_pieces")
    parts = pieces.where("not whole")
    prices = parts.select("conv", "part", "nth", "through").repartition("conv").sortWithinPartitions("conv", "part", "nth").mapInArrow(
        _step(_priced_pieces, pa.schema([("part", pa.int32()), ("nth", pa.int32()), ("ends", pa.list_(pa.int64())), ("entries", pa.list_(pa.int32()))])), PRICES)
    columns = [c for c in pieces.columns if c != "through"]
    whole = pieces.where("whole").select(*columns, F.lit(None).cast("array<long>").alias("ends"), F.lit(None).cast("array<int>").alias("entries"))
    cut = parts.select(*columns).join(prices, ["part", "nth"]).select(*whole.columns)
    cut = cut.mapInArrow(_step(_trace, TRACES), TRACE).repartition("conv").sortWithinPartitions("conv", "part", "nth")
    found = whole.mapInArrow(_step(lambda r: _chain(_trace(r)), RESULTS), RESULT).unionAll(cut.mapInArrow(_step(_chain, RESULTS), RESULT))
    found = found.withColumnRenamed("conv", "found_conv")
    every = counters(rows)
    none = {"illegal": F.lit(0), "cost": F.lit(0), "audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256().hexdigest())}
    return every.join(found, every["conv"].eqNullSafe(found["found_conv"]), "left").select(
        *every.columns, *[F.coalesce(F.col(c), other).alias(c) for c, other in none.items()])


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return repair_conversations(damaged(rows)).withColumnRenamed("conv", "conv_id")


SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(k) + 1), lambda i: [ascii(substr(k, i::INT, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda c, v: xor(xor(c, v) >> 1, 3988292384 * (xor(c, v) & 1))), 4294967295) % 20 AS kind
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations)),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM placed),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1:1] AS turns FROM seen),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (turns NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM faults GROUP BY conv_id),
inserts(was, now, cost, letters, names) AS (VALUES
  (0, 0, 0, '', []::VARCHAR[]), (0, 2, 2, 'I', ['user:']), (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 1, 0, '', []), (1, 2, 2, 'I', ['user:']), (1, 3, 4, 'II', ['user:', 'assistant:']),
  (2, 2, 0, '', []), (2, 3, 2, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 2, 'I', ['user:'])),
edits(letter, initial, was, now, cost) AS (VALUES
  ('K', 's', 0, 1, 0), ('K', 'u', 0, 2, 0), ('K', 'u', 1, 2, 0), ('K', 'u', 3, 2, 0), ('K', 'a', 2, 3, 0),
  ('R', NULL, 0, 2, 2), ('R', NULL, 1, 2, 2), ('R', NULL, 3, 2, 2), ('R', NULL, 2, 3, 2), ('D', NULL, 0, 0, 3), ('D', NULL, 1, 1, 3), ('D', NULL, 2, 2, 3), ('D', NULL, 3, 3, 3)),
steps AS (
  SELECT f.conv_id, f.i, n.was, e.now, n.cost + e.cost + (CASE WHEN e.letter <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END) AS cost, n.letters || e.letter AS letters,
    list_concat(n.names, CASE e.letter WHEN 'K' THEN [f.role || ':' || f.text] WHEN 'R' THEN [CASE e.now WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text] ELSE [] END) AS names
  FROM faults f, inserts n JOIN edits e ON e.was = n.now
  WHERE (e.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate')) AND (e.initial IS NULL OR e.initial = f.role[1:1])),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS names FROM counted
  UNION ALL
  SELECT conv_id, i, state, cost, audit, names FROM (
    SELECT w.conv_id, s.i, s.now AS state, w.cost + s.cost AS cost, w.audit || s.letters AS audit, list_concat(w.names, s.names) AS names,
      row_number() OVER (PARTITION BY w.conv_id, s.now ORDER BY w.cost + s.cost, w.audit || s.letters) AS best
    FROM walk w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i + 1 AND s.was = w.state)
  WHERE best = 1),
ended AS (
  SELECT conv_id, cost, audit, names FROM (
    SELECT w.conv_id, w.cost + n.cost AS cost, w.audit || n.letters AS audit, list_concat(w.names, n.names) AS names,
      row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + n.cost, w.audit || n.letters) AS best
    FROM walk w JOIN counted c ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i JOIN inserts n ON n.was = w.state AND n.now IN (0, 3))
  WHERE best = 1)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
  coalesce(c.illegal, 0) AS illegal, coalesce(e.cost, 0) AS cost, coalesce(e.audit, '') AS audit,
  sha256(coalesce(array_to_string(e.names, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id"""
