"""Repair of conversations against its SQL on odd rows, and the auction against a plain search."""

import random
import zlib

import duckdb
import pytest

from menumix.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string, conv long, n int, first boolean, part int"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def odd_rows():
    draw = random.Random(12)
    rows = []
    for conv in [*range(60), None]:
        for turn in range(draw.choice([0, 1, 2, 5, 9, 40])):
            role = draw.choice(["user", "assistant", "assistant", "system", "tool", "", None, "usher"] if draw.random() < 0.4 else [["user", "assistant"][turn % 2]])
            text = draw.choice([None, "", " \t\n\x0b\f", "Yes.", "Yes.", "Is it? \n", "no end", "é", "日本。", "...", f"text {draw.randrange(9)}!"])
            rows.append((conv, draw.choice([turn, turn, turn + 3, None, turn - 2]), role, text))
    rows += [(70, 1, "user", "Same.")] * 30 + [(71, t, "user", "Same.") for t in range(30)]
    rows += [(72, t, ["user", "assistant"][t % 2], "long " * 50000 + ".") for t in range(4)]
    draw.shuffle(rows)
    return rows


def by_sql(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    return sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({C.SQL})").fetchall(), key=str)


@pytest.mark.parametrize("piece_rows, run", [(4096, 24), (3, 2)])
def test_odd_conversations_equal_the_sql(spark, piece_rows, run, monkeypatch):
    monkeypatch.setattr(C, "PIECE_ROWS", piece_rows)
    monkeypatch.setattr(C, "RUN", run)
    rows = odd_rows()
    df = spark.createDataFrame([(*r, 1, 2, True, 3) for r in rows], SCHEMA).repartition(5)
    got = C.repair_conversations(C.damaged(df)).withColumnRenamed("conv", "conv_id").select(*COLUMNS)
    assert sorted((tuple(r) for r in got.collect()), key=str) == by_sql(rows)


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.repair_conversations(C.damaged(df)).count() == 0


def test_a_conversation_of_dropped_rows(spark):
    dropped = [t for t in range(200) if zlib.crc32(f"7:{t}".encode()) % 20 == 0]
    df = spark.createDataFrame([(7, t, "user", "x") for t in dropped], "conv_id long, turn long, role string, text string")
    (row,) = C.repair_conversations(C.damaged(df)).collect()
    assert (row.gaps, row.blank, row.duplicate, row.truncated, row.illegal, row.cost, row.audit) == (0, 0, 0, 0, 0, 0, "")


def plain(rows):
    """Cheapest (cost, audit) by trying every state row by row."""
    best = {0: (0, "")}

    def insert(best):
        out = dict(best)
        for _ in range(3):
            for s, (c, a) in list(out.items()):
                t = C.TURN[s]
                out[t] = min(out.get(t, (1 << 60, "")), (c + 2, a + "I"))
        return out

    for row in rows:
        after = {}
        for s, (c, a) in insert(best).items():
            ways = [(3, "D", s)]
            if isinstance(row, int):
                ways = [(3 * row, "D" * row, s)]
            else:
                initial, fault = row
                ways.append((2 + fault, "R", C.TURN[s]))
                if (initial, s) in C.KEEPS:
                    ways.append((fault, "K", C.KEEPS[initial, s]))
            for cost, letters, t in ways:
                after[t] = min(after.get(t, (1 << 60, "")), (c + cost, a + letters))
        best = after
    return min(v for s, v in insert(best).items() if s in (0, 3))


def test_auction_finds_the_least_audit():
    draw = random.Random(5)
    for _ in range(400):
        rows = [draw.choice([("u", 0), ("a", 0), ("s", 0), ("-", 1), ("a", 1), ("u", 1), draw.randrange(1, 4)]) for _ in range(draw.randrange(0, 60))]
        audit, state, cost = C.repair(rows, C.FINAL, 0)
        assert (cost + C.FINAL[state], audit + "I" * (C.FINAL[state] // 2)) == plain(rows)
