import hashlib
import heapq
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from assocspark.llm import prefix_trie, scan, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string"


def made_up(seed, convs, ids=None):
    """Conversations with repeated, blank, torn and misplaced turns, nulls and ties."""
    rng, rows = random.Random(seed), []
    for c in ids or range(convs):
        for t in range(rng.choice([0, 1, 2, 3, 5, 7, 9])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "tool", ""]) if rng.random() < 0.4 else ("user", "assistant")[t % 2]
            text = rng.choice(["One.", "Two!", "Three", "four?", " \t", None, "a. b", f"only {c} {t}."])
            turn = None if rng.random() < 0.05 else t + (rng.random() < 0.1)
            rows += [(c, turn, role, text)] * rng.choice([1, 1, 1, 1, 2])
    return rows


def cheapest(initials, forced, cut):
    """Best (cost, audit) by search over everything that edits can make."""
    heap, best = [(0, "", 0, "")], None
    while heap:
        cost, audit, i, made = heapq.heappop(heap)
        if best is not None and (cost, audit) >= best:
            break
        if i == len(initials) and re.fullmatch("(s?(ua)+)?", made):
            best = (cost, audit)
            continue
        if not re.fullmatch("(s?(ua)*u?)?", made) or len(made) > len(initials) + 2:
            continue
        if i < len(initials):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, made))
            if not forced[i]:
                heapq.heappush(heap, (cost + 5 * cut[i], audit + "K", i + 1, made + (initials[i] or "?")))
                for r in "ua":
                    heapq.heappush(heap, (cost + 5 * cut[i] + 1, audit + "R", i + 1, made + r))
        for r in "ua":
            heapq.heappush(heap, (cost + 5, audit + "I", i, made + r))
    return best


def test_alignment_equals_search():
    rng = random.Random(3)
    for _ in range(600):
        n = rng.randint(0, 7)
        turns = [rng.choice(["s", "u", "a", "u", "a", "t", ""]) for _ in range(n)], [rng.random() < 0.15 for _ in range(n)], [rng.random() < 0.25 for _ in range(n)]
        assert turn_repair.repair_turns(*turns) == cheapest(*turns), turns


def broken(rows):
    """The damaged rows of each conversation in order, by the contract read word for word."""
    out = {}
    for c, t, role, text in rows:
        out.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            row = (t, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)
            out[c] += [row] * (2 if kind == 3 else 1)
    return {c: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, *r[1:])) for c, v in out.items()}


def by_hand(rows):
    out = []
    for c, turns in broken(rows).items():
        seen, blank, twice, torn = set(), [], [], []
        for _, role, text in turns:
            body = text.strip(" \t\n\x0b\x0c\r")
            blank.append(not body)
            twice.append(bool(body) and (role, text) in seen)
            torn.append(bool(body) and not twice[-1] and body[-1] not in ".!?")
            seen.add((role, text))
        initials = [r[1][:1] for r in turns]
        cost, audit = cheapest(initials, [a or b for a, b in zip(blank, twice)], torn)
        numbers = {r[0] for r in turns} - {None}
        lines, i, odd = [], 0, sum(x != "D" for x in audit) % 2
        for x in audit:
            due = ("user", "assistant")[(len(lines) + odd) % 2]
            if x != "D":
                lines.append(due + ":" if x == "I" else f"{turns[i][1] if x == 'K' else due}:{turns[i][2]}")
            i += x != "I"
        out.append((c, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, sum(blank), sum(twice), sum(torn), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                    cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize(("long", "segment"), [(2048, 4096), (2, 2), (0, 3)])
def test_repair_equals_brute_force(spark, monkeypatch, long, segment):
    monkeypatch.setattr(turn_repair, "LONG", long)
    monkeypatch.setattr(turn_repair, "SEGMENT", segment)
    rows = made_up(5, 60) + [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (None, 2, "s", "He."), (900, 3, "system", "S."), (901, 1, "system", "S."), (901, 2, "user", "U?"), (901, 2, "user", "U?")]
    rows += [(902, 1, "user", "again and again.")] * 9 + [(903, t, ("user", "assistant")[t % 2], f"t{t}.") for t in range(14)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({"known": F.lit(1), "copies": F.lit(5), "at": F.lit("x")})
    got = turn_repair.repair(turn_repair.damage(table))
    assert [f.dataType.simpleString() for f in got.schema][1:7] == ["bigint"] * 6
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(rows)


def test_repair_of_nothing(spark):
    empty = turn_repair.repair(turn_repair.damage(spark.createDataFrame([], SCHEMA)))
    assert empty.collect() == []
    dropped = next(t for t in range(100) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    got = turn_repair.repair(turn_repair.damage(spark.createDataFrame([(7, dropped, "user", "Hello.")], SCHEMA))).collect()
    assert list(map(tuple, got)) == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_text_takes_the_long_way(spark, monkeypatch):
    rows = [(1, 0, "user", "x" * 50_000 + "."), (1, 1, "assistant", "Yes."), (2, 0, "user", "No."), (2, 1, "user", "No")]
    plain = turn_repair.repair(spark.createDataFrame(rows, SCHEMA)).collect()
    monkeypatch.setattr(turn_repair, "LONG_CHARS", 10_000)
    assert sorted(turn_repair.repair(spark.createDataFrame(rows, SCHEMA)).collect()) == sorted(plain)
    assert [(r["conv_id"], r["cost"], r["audit"]) for r in sorted(plain)] == [(1, 0, "KK"), (2, 4, "DD")]


def test_scan_over_cut_keys(spark):
    rng = random.Random(2)
    rows = [(k, i, rng.randrange(-2 ** 63, 2 ** 63), 1) for k, n in ((5, 400), (1, 3), (7, 1), (9, 150)) for i in range(n)]
    base = 0x5851F42D4C957F2B
    got = scan.scanned(spark.createDataFrame(rows, "k long, i long, v long, w long").repartition(3), "k", ["i"], {"v": base, "w": 1}).collect()
    assert len({r["part"] for r in got}) > 1
    values = {(k, i): v for k, i, v, _ in rows}
    sums = {}
    for r in sorted(got, key=lambda r: (r["k"], r["i"])):
        sums[r["k"]] = (sums.get(r["k"], 0) + values[r["k"], r["i"]] * pow(base, r["i"], 2 ** 64)) % 2 ** 64
        assert (r["place"], r["sum_v"] % 2 ** 64, r["sum_w"]) == (r["i"], sums[r["k"]], r["i"] + 1)
    assert scan.power(base, np.array([-3]))[0] == pow(base, -3, 2 ** 64)


def brute_trie(rows):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    made = {}
    for c in turns:
        h, base = zlib.crc32(str(c).encode()) % 6, c - int(np.fmod(c, 100))
        made[c] = tuple(turns.get(base, [])[:h] + turns[c][h:])
    members = {}
    for c, path in made.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[:len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m != n and m[:len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(str(c) for c in sorted(convs) if len(made[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def test_trie_equals_brute_force(spark):
    ids = [*range(40), *range(95, 125), 200, 201, 250, -7, -100, -150, 333]
    rows = [r for r in made_up(8, 0, ids) if r[1] is not None]
    unique, seen = [], set()
    for r in rows:  # ties of a turn are ordered by a hash; the brute force orders by text
        if (r[0], r[1]) not in seen or r in unique[-1:]:
            seen.add((r[0], r[1]))
            unique.append(r)
    copies = [(c, t, "user", f"the same {t}") for c in range(400, 420) for t in range(4)] + [(500, t, "user", f"long {t % 3}") for t in range(70)] + [(None, 1, "user", "nobody"), (501, None, None, None)]
    table = spark.createDataFrame(unique + copies, SCHEMA).repartition(3).withColumns({"depth": F.lit(1), "h": F.lit("x"), "place": F.lit(2), "n": F.lit(0)})
    got = prefix_trie.trie(table)
    assert got.columns[:8] == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_trie(unique + copies)
    assert prefix_trie.trie(table.limit(0)).collect() == []


def test_colliding_hashes_are_found_and_replaced(spark, monkeypatch):
    rows = [(c, t, "user", f"{c % 3} {t}") for c in range(12) for t in range(3)]
    table, real = spark.createDataFrame(rows, SCHEMA), prefix_trie._hashes
    monkeypatch.setattr(prefix_trie, "_hashes", lambda seed: (F.lit(1).cast("long"), F.lit(2).cast("long")) if seed < 2 else real(seed))
    assert sorted(map(tuple, prefix_trie.trie(table).collect()), key=str) == brute_trie(rows)
    monkeypatch.setattr(prefix_trie, "_hashes", lambda seed: (F.lit(1).cast("long"), F.lit(2).cast("long")))
    with pytest.raises(RuntimeError):
        prefix_trie.trie(table)
