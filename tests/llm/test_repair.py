from __future__ import annotations

import hashlib
import random
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from tessera.llm import repair
from tessera.llm.queries import op12_conversation_repair

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, conv string, mark int, audit string"
GRAMMAR = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows: list[tuple[str, str]]) -> tuple[int, str, list[tuple[str, str]]]:
    """(cost, audit, repaired rows) by plain recursion over suffixes; ties by the whole audit."""
    kinds, seen = [], set()
    for role, text in rows:
        body = text.strip(SPACE)
        kinds.append("delete" if not body or (role, text) in seen else "cut" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @cache
    def best(i: int, state: str, inserted: int) -> tuple[int, str, tuple]:
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserted < 3:
            for role in ("user", "assistant"):
                if (state, role[0]) in GRAMMAR:
                    cost, audit, out = best(i, GRAMMAR[state, role[0]], inserted + 1)
                    options.append((cost + 5, "I" + audit, ((role, ""), *out)))
        if i < len(rows):
            role, text = rows[i]
            cost, audit, out = best(i + 1, state, 0)
            options.append((cost + 2, "D" + audit, out))
            if kinds[i] != "delete":
                more = 5 * (kinds[i] == "cut")
                for letter, own, put in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                    if (state, put[:1]) in GRAMMAR:
                        cost, audit, out = best(i + 1, GRAMMAR[state, put[0]], 0)
                        options.append((cost + own + more, letter + audit, ((put, text), *out)))
        return min(options, key=lambda o: o[:2]) if options else (10**9, "", ())

    cost, audit, out = best(0, "", 0)
    return cost, audit, list(out)


def expected(rows: list[tuple]) -> dict:
    """The report of rows (conv_id, turn, role, text), damage included."""
    found: dict = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        role, text, fate = name(role), name(text), zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        role = "user" if fate == 4 else role
        found[conv] += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = {}
    for conv, left in found.items():
        left.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        turns, pairs = [r[0] for r in left if r[0] is not None], [r[1:] for r in left]
        seen, faults = set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for role, text in pairs:
            body = text.strip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            faults[fault] = faults.get(fault, 0) + 1
            seen.add((role, text))
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:], strict=False))
        cost, audit, lines = cheapest(pairs)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        out[conv] = (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, sha)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def reported(df) -> dict:
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_query_against_plain_recursion(spark, smallest):
    rows = [tuple(r) for r in spark.read.parquet(f"{smallest}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = reported(op12_conversation_repair(spark, smallest))
    assert found == expected(rows) and {"K", "D", "R"} <= set("".join(v[6] for v in found.values()))


@pytest.fixture(scope="module")
def odd_rows():
    rng, rows = random.Random(5), []
    for conv in [None, *range(400)]:
        for k in range(rng.randrange(1, 14)):
            turn = rng.choice([k, k, k, k, k // 2, None, 3 * k])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "ünder"])
            rows.append((conv, turn, role, rng.choice(["Yes.", "No!", "Why?", "Why? \n", "cut", "", " \t", None, f"So {k}.", f"And {k}", "end. ", "É."])))
    return rows


def test_nulls_ties_and_odd_roles(spark, odd_rows):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in odd_rows], SCHEMA)
    found, want = reported(repair.report(df, repair.damaged(df))), expected(odd_rows)
    assert found == want
    assert any(v[6] == "" for v in found.values())
    assert not repair.report(df.limit(0), repair.damaged(df.limit(0))).collect()


def test_repaired_rows_are_well_formed(spark, odd_rows):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in odd_rows], SCHEMA)
    lines = repair.repaired(df, repair.audits(df))
    roles = lines.groupBy("conv").agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("place", "role"))), lambda x: F.substring(x["role"], 1, 1))).alias("r"))
    assert roles.where("not r rlike '^s?(ua)+$'").count() == 0 and roles.count() > 300


def test_audits_of_small_cases():
    automaton = repair.Automaton()

    def audit(text: str) -> tuple[int, str]:
        """s, u, a, x rows, upper case: truncated; - has to be deleted."""
        symbols = bytes(0 if c == "-" else 1 + 2 * "suax".index(c.lower()) + c.isupper() for c in text)
        cost, states = automaton.scan(symbols)
        return cost, automaton.trace(symbols, states).decode()

    assert audit("") == (0, "") and audit("sua") == (0, "KKK") and audit("uaua") == (0, "KKKK")
    assert audit("uu") == (1, "KR") and audit("u") == (2, "D") and audit("aa") == (1, "RK") and audit("s") == (2, "D")
    assert audit("--") == (4, "DD") and audit("uA") == (4, "DD") and len(automaton.vectors) < 60
    for text in ("uuu", "saau", "xax", "uxauas", "sS", "ssuuaa", "a-u-a"):
        rows = [({"s": "system", "u": "user", "a": "assistant", "x": "tool", "-": "user"}[c.lower()], "" if c == "-" else f"{k}" if c.isupper() else f"{k}.") for k, c in enumerate(text)]
        assert audit(text) == cheapest(rows)[:2], text


def test_insertions_where_deletions_cost_more(spark, monkeypatch):
    monkeypatch.setattr(repair, "DELETE", 30)
    automaton = repair.Automaton()
    for symbols, want in ((b"\x03", (5, b"KI")), (b"\x05", (5, b"IK")), (b"\x01", (6, b"IR")), (b"\x03\x05\x05", (5, b"KKIK")), (b"\x00", (30, b"D"))):
        cost, states = automaton.scan(symbols)
        assert (cost, automaton.trace(symbols, states)) == want
    rows = spark.createDataFrame([(1, 0, "system", "Be kind."), (2, 1, "user", "Why?"), (2, 2, "assistant", "So."), (2, 3, "assistant", "Oh.")], "conv_id long, turn long, role string, text string")
    audits = spark.createDataFrame([("=1", "KII"), ("=2", "KKIK")], "conv string, audit string")
    lines = [tuple(r) for r in repair.repaired(rows, audits).orderBy("conv", "place").collect()]
    assert lines == [("=1", 0, "system", "Be kind."), ("=1", 1, "user", ""), ("=1", 2, "assistant", ""), ("=2", 0, "user", "Why?"), ("=2", 1, "assistant", "So."), ("=2", 2, "user", ""), ("=2", 3, "assistant", "Oh.")]


def test_one_very_long_conversation(spark):
    rows = spark.range(60_000).select(F.lit(7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.col("id").cast("string"), F.lit(".")).alias("text"))
    rows = rows.unionByName(rows.withColumn("text", F.lit("Same line.")))
    r = repair.report(rows, rows).first()
    assert r["duplicate"] == 60_000 - 2 and len(r["audit"]) == 120_000 and r["gaps"] == 0
