"""Conversation structure repair: turns aligned with every feasible length of an alternating grammar string, banded by the incumbent's cost.

A conversation's turns, in order, become a string of role initials of the form ``(s?(ua)+)?`` by edits: keep a turn (0), give it the role user or
assistant (1), delete it (2), insert an empty turn of user or assistant (5); a truncated turn that is not deleted adds 5, blank and repeated turns
must be deleted. Wagner-Fischer tables of all target lengths share their suffixes, since every target ends in the same ``..uaua``: cell (i, r) is the
cheapest way to turn the turns from i on into the last r characters, and a leading ``s`` is one kept turn before such a suffix. A quick repair is the
incumbent; a path that strays from the diagonal by d insertions or deletions costs at least 5 d or 2 d, so only that Ukkonen band is filled. Every
length that reaches the least cost is traced back, smallest letter first, and the audits are compared as text.

Turns are grouped by one shuffle and handled as a sorted stream. Conversations of more than ``LONG`` turns (or ``LONG_CHARS`` characters) are never held
by a task: they are cut into segments of ``SEGMENT`` turns whose costs between the four states of the grammar are min-plus matrices; chained, they give
each segment its place on the cheapest path. Only the digest of such a conversation, sequential by nature, is streamed through one task.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import stage

#: Fixed: the costs of the contract.
RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Turns and characters up to which a conversation is aligned in one piece.
LONG, LONG_CHARS = 2048, 32_000_000
#: Turns of a longer conversation that one step handles.
SEGMENT = 4096
_FAR = 1 << 40
_BLANK = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
_ROLE = {"u": "user", "a": "assistant"}
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and ``copies`` of every row after the contract's damage; a row it drops stays with no copies.

    Null roles, texts, and ids or turns within the key are one space. The damage follows crc32 of ``conv_id:turn`` modulo 20.
    """
    def or_space(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), or_space("role").alias("role"), or_space("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copies"))


def incumbent(initials: list[str], forced: list[bool], cut: list[bool]) -> int:
    """Cost of a repair found in one pass: what is broken goes, what stands at the wrong place gets the role due there."""
    cost, due, begun = 0, "u", False
    for initial, gone, torn in zip(initials, forced, cut, strict=True):
        if gone or torn:
            cost += DELETE
        elif initial == "s" and not begun and due == "u":
            begun = True
        else:
            cost += RETYPE * (initial != due)
            begun, due = True, "a" if due == "u" else "u"
    tail = INSERT if due == "a" else 0
    if begun and due == "u" and not any(i != "s" and not f and not c for i, f, c in zip(initials, forced, cut, strict=True)):
        tail = 2 * INSERT  # nothing but a system turn may be left
    return min(cost + tail, DELETE * len(initials))


def repair_turns(initials: list[str], forced: list[bool], cut: list[bool]) -> tuple[int, str]:
    """Least cost and its ASCII-least audit, a letter of D, I, K, R per edit."""
    n = len(initials)
    spare = incumbent(initials, forced, cut) - DELETE * sum(forced)
    low, high = spare // DELETE, spare // INSERT
    k = np.arange(low + high + 1, dtype=np.int64)
    slope = INSERT * k
    left = k - low  # characters still to be made, in the row after the last turn
    rows, free = [np.where(left >= 0, INSERT * left, _FAR)], [0]
    for i in range(n - 1, -1, -1):
        after = rows[-1]
        if forced[i]:
            rows.append(after + DELETE)
            free.append(free[-1])
            continue
        left = left + 1
        due_u, due_a = (TRUNCATED * cut[i] + RETYPE * (initials[i] != x) for x in "ua")
        take = np.where(left <= 0, _FAR, after + np.where(left & 1, due_a, due_u))
        take[:-1] = np.minimum(take[:-1], after[1:] + DELETE)
        rows.append(np.minimum.accumulate(take - slope) + slope)
        free.append(free[-1] + 1)
    rows.reverse()
    free.reverse()

    def cell(i: int, r: int) -> int:
        at = r - free[i] + low
        return int(rows[i][at]) if 0 <= at < len(k) else _FAR

    starts: list[tuple[int, int, int]] = []  # cost, turns before the suffix (the last of them a kept system turn), length of the suffix
    for head in [0, *(i + 1 for i in range(n) if initials[i] == "s" and not forced[i])]:
        paid = DELETE * (head - 1) + TRUNCATED * cut[head - 1] if head else 0
        r = k - low + free[head]
        fits = np.flatnonzero((r % 2 == 0) & (r >= (2 if head else 0)))
        if len(fits):
            costs = rows[head][fits] + paid
            best = costs.min()
            starts += [(int(best), head, int(x)) for x in r[fits][costs == best]]
    least = min(s[0] for s in starts)

    def trace(i: int, r: int) -> str:
        out = []
        while i < n or r:
            value = cell(i, r)
            if i < n and cell(i + 1, r) + DELETE == value:
                out.append("D")
                i += 1
            elif r and cell(i, r - 1) + INSERT == value:
                out.append("I")
                r -= 1
            else:
                out.append("K" if initials[i] == ("a" if r & 1 else "u") else "R")
                i, r = i + 1, r - 1
        return "".join(out)

    return least, min(("D" * (head - 1) + "K" if head else "") + trace(head, r) for cost, head, r in starts if cost == least)


def rebuilt(audit: str, roles: list[str], texts: list[str], made: int | None = None) -> list[str]:
    """``role:text`` of the turns that the audit leaves. ``made``: 0 or 1 if the first one is due to be user or assistant (None: the length tells)."""
    if made is None:
        made = (len(audit) - audit.count("D")) % 2  # of an odd number, the first is the kept system turn
    out, i = [], 0
    for letter in audit:
        if letter == "D":
            i += 1
            continue
        due = _ROLE["ua"[made % 2]]
        out.append(f"{due}:" if letter == "I" else f"{roles[i] if letter == 'K' else due}:{texts[i]}")
        i += letter != "I"
        made += 1
    return out


def _faults(roles: list[str], texts: list[str], copies: list[int], original: list[bool]) -> tuple[list[str], list[bool], list[bool], list[bool]]:
    """Initials, and which turns are blank, duplicate, truncated: the first fault of each counts."""
    bare = [t.rstrip(_BLANK) for t in texts]
    blank = [not b for b in bare]
    duplicate = [not b and not o for b, o in zip(blank, original, strict=True)]
    torn = [bool(b) and not d and b[-1] not in ".!?" for b, d in zip(bare, duplicate, strict=True)]
    return [r[:1] for r in roles], blank, duplicate, torn


def _whole(turns: list, roles: list[str], texts: list[str], copies: list[int]) -> tuple:
    """Result of one conversation, but for its id."""
    spread = [i for i, c in enumerate(copies) for _ in range(c)]
    roles, texts, numbers = [roles[i] for i in spread], [texts[i] for i in spread], {turns[i] for i in spread} - {None}
    seen, original = set(), []
    for pair in zip(roles, texts, strict=True):
        original.append(pair not in seen)
        seen.add(pair)
    initials, blank, duplicate, torn = _faults(roles, texts, copies, original)
    cost, audit = repair_turns(initials, [b or d for b, d in zip(blank, duplicate, strict=True)], torn)
    illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    digest = hashlib.sha256("\n".join(rebuilt(audit, roles, texts)).encode("utf-8", "surrogatepass")).hexdigest()
    return max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, sum(blank), sum(duplicate), sum(torn), illegal, cost, audit, digest


_ARROW = pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in RESULT.split(", ")])


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of a sorted stream of turns; only the conversation that is being read is held."""
    key, held, out = None, ([], [], [], []), []

    def close():
        if key is not None:
            out.append((key[1] if key[0] else None, *_whole(*held)))

    for batch in batches:
        known, conv, *columns = (batch.column(c).to_pylist() for c in ("known", "conv", "turn", "role", "text", "copies"))
        start = 0
        for at in range(batch.num_rows + 1):
            now = (known[at], conv[at]) if at < batch.num_rows else None
            if at == batch.num_rows or now != key:
                for column, more in zip(held, columns, strict=True):
                    column.extend(more[start:at])
                start = at
                if at < batch.num_rows:
                    close()
                    key, held = now, ([], [], [], [])
        if len(out) >= 5000:
            yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r, strict=True)) for r in out], _ARROW)
            out.clear()
    close()
    if out:
        yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r, strict=True)) for r in out], _ARROW)


# --- conversations beyond LONG: states of the grammar are 0 nothing yet, 1 system turn kept, 2 user stands last, 3 assistant stands last ---

_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
_DUE = {0: "u", 1: "u", 3: "u", 2: "a"}
#: Cost of ending in each state, and the edits that do.
_END = np.array([0, 2 * INSERT, INSERT, 0], np.int64), ("", "II", "I", "")


def _steps(initial: str, torn: bool) -> list[tuple[int, int, int, str]]:
    """From state, to state, cost and letter of what may happen to one turn that need not go."""
    extra = TRUNCATED * torn
    moves = [(q, q, DELETE, "D") for q in range(4)]
    for q, due in _DUE.items():
        moves += [(q, _NEXT[q, x], extra, "K") for x in {due, "s"} if x == initial and (q, x) in _NEXT]
        if initial != due:
            moves.append((q, _NEXT[q, due], extra + RETYPE, "R"))
    return moves


def _before(after: np.ndarray, moves: list) -> np.ndarray:
    """Costs to go from each state before a turn (last axis), from those after it."""
    out = np.full_like(after, _FAR)
    for q, to, cost, _ in moves:
        out[..., q] = np.minimum(out[..., q], after[..., to] + cost)
    for _ in range(2):  # insertions, of at most two turns in a row
        for q, due in _DUE.items():
            out[..., q] = np.minimum(out[..., q], out[..., _NEXT[q, due]] + INSERT)
    return out


def _segment(group: pd.DataFrame):
    group = group.sort_values("at", ignore_index=True)
    roles, texts, copies, original = (group[c].tolist() for c in ("role", "text", "copies", "original"))
    initials, blank, duplicate, torn = _faults(roles, texts, copies, original)
    return roles, texts, [int(c) for c in copies], initials, blank, duplicate, torn


def _summary(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    _, _, copies, initials, blank, duplicate, torn = _segment(group)
    costs = np.where(np.eye(4, dtype=bool), 0, _FAR)  # row: state at the end of the segment; column: state before it
    for i in range(len(copies) - 1, -1, -1):
        gone = blank[i] or duplicate[i]
        costs = costs + DELETE * (copies[i] - (not gone))
        if not gone:
            costs = _before(costs, _steps(initials[i], torn[i]))
    again = sum(c - 1 for c in copies)
    illegal = again + sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
    n_blank = sum(c for c, b in zip(copies, blank, strict=True) if b)
    n_duplicate = sum(c if d else c - 1 for c, d, b in zip(copies, duplicate, blank, strict=True) if not b)
    return pd.DataFrame([(*key, costs.tobytes(), initials[0], initials[-1], n_blank, n_duplicate, sum(torn), illegal)])


def _outlook(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """Per segment, the costs to go from each state after it; and the counts of the conversation at its first one."""
    group = group.sort_values("segment", ignore_index=True)
    ahead, togo = [], _END[0]
    for data in reversed(group["costs"].tolist()):
        ahead.append(togo.tobytes())
        togo = (np.frombuffer(data, np.int64).reshape(4, 4) + togo[:, None]).min(axis=0)
    joints = sum(a + b not in _LEGAL for a, b in zip(group["last"].tolist(), group["first"].tolist()[1:]))
    counts = [int(group[c].sum()) for c in ("blank", "duplicate", "truncated", "illegal")]
    counts[3] += joints
    return pd.DataFrame({"known": key[0], "conv": key[1], "segment": group["segment"], "ahead": ahead[::-1], "ends": group.index == len(group) - 1, "cost": int(togo[0]),
                         "blank": counts[0], "duplicate": counts[1], "truncated": counts[2], "illegal": counts[3]})


def _paths(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """What the segment's turns become on the cheapest, ASCII-least path from each state before it: audit, state after it, repaired turns."""
    _, _, copies, initials, blank, duplicate, torn = _segment(group)
    togo, moves = [np.frombuffer(group["ahead"].iloc[0], np.int64)], []
    for i in range(len(copies) - 1, -1, -1):
        gone = blank[i] or duplicate[i]
        moves.append([] if gone else _steps(initials[i], torn[i]))
        togo.append(togo[-1] + DELETE * (copies[i] - (not gone)))
        if not gone:
            togo[-1] = _before(togo[-1], moves[-1])
    togo.reverse()
    moves.reverse()
    out = []
    for entry in range(4):
        q, audit, made = entry, [], 0
        for i, count in enumerate(copies):
            paid = DELETE * (count - bool(moves[i]))
            while moves[i]:
                choices = [(letter, to, cost + int(togo[i + 1][to]) + paid) for p, to, cost, letter in moves[i] if p == q]
                step = _NEXT[q, _DUE[q]]
                choices.append(("I", step, INSERT + int(togo[i][step])))
                letter, q = min((x, to) for x, to, cost in choices if cost == togo[i][q])
                audit.append(letter)
                made += letter != "D"
                if letter != "I":
                    break
            audit.append("D" * (count - bool(moves[i])))
        if group["ends"].iloc[0]:
            audit.append(_END[1][q])
        out.append((*key, entry, q, "".join(audit)))
    return pd.DataFrame(out)


def _walk(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """The path that each segment is on: the state before a segment is that after the one before."""
    steps = {(s, e): (q, a) for s, e, q, a in zip(group["segment"], group["entry"], group["leave"], group["audit"], strict=True)}
    out, q = [], 0
    for s in sorted({s for s, _ in steps}):
        q, audit = steps[s, entry := q]
        out.append((*key, s, entry, audit))
    return pd.DataFrame(out)


def _lines(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    roles, texts, copies, *_ = _segment(group)
    audit, entry = group["audit"].iloc[0], int(group["entry"].iloc[0])
    spread = [i for i, c in enumerate(copies) for _ in range(c)]
    first = next((x for x in audit if x != "D"), "")
    system = entry == 0 and first == "K" and roles[spread[audit.replace("I", "").index("K")]][:1] == "s"
    made = rebuilt(audit, [roles[i] for i in spread], [texts[i] for i in spread], 1 if system or entry == 2 else 0)
    return pd.DataFrame([(*key, audit, "\n".join(made).encode("utf-8", "surrogatepass"), len(made))])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of each conversation from its segments, in order."""
    key, sha, audit, begun = None, None, [], False
    schema = pa.schema([("known", pa.bool_()), ("conv", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def close():
        return pa.RecordBatch.from_pylist([{"known": key[0], "conv": key[1], "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}], schema)

    for batch in batches:
        for known, conv, piece, lines, made in zip(*(batch.column(c).to_pylist() for c in ("known", "conv", "audit", "lines", "made")), strict=True):
            if (known, conv) != key:
                if key is not None:
                    yield close()
                key, sha, audit, begun = (known, conv), hashlib.sha256(), [], False
            audit.append(piece)
            if made:
                sha.update(b"\n" * begun + lines)
                begun = True
    if key is not None:
        yield close()


def _long(rows: DataFrame) -> DataFrame:
    """Results of conversations that no task may hold."""
    conv = ["known", "conv"]
    merged = rows.where("copies > 0").groupBy(*conv, "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    place = F.struct(F.col("turn").isNotNull().alias("a"), F.col("turn").alias("b"))
    first = merged.groupBy(*conv, "role", "text").agg(F.min(place).alias("first"))
    marked = merged.join(first, [*conv, "role", "text"]).withColumn("original", place.eqNullSafe(F.col("first"))).drop("first")
    order = [*conv, F.col("turn").asc_nulls_first(), "role", "text"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(marked.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    placed = placed.withColumn("segment", F.expr(f"at - at % {1 << 33} + (at % {1 << 33}) div {SEGMENT}"))
    key = [*conv, "segment"]
    summary = placed.groupBy(*key).applyInPandas(_summary, "known boolean, conv long, segment long, costs binary, first string, last string, blank long, duplicate long, truncated long, illegal long")
    outlook = stage(stage(summary).groupBy(*conv).applyInPandas(_outlook, "known boolean, conv long, segment long, ahead binary, ends boolean, cost long, blank long, duplicate long, truncated long, illegal long"))
    paths = placed.join(outlook.select(*key, "ahead", "ends"), key).groupBy(*key).applyInPandas(_paths, "known boolean, conv long, segment long, entry int, leave int, audit string")
    walk = stage(stage(paths).groupBy(*conv).applyInPandas(_walk, "known boolean, conv long, segment long, entry int, audit string"))
    lines = stage(placed.join(walk, key).groupBy(*key).applyInPandas(_lines, "known boolean, conv long, segment long, audit string, lines binary, made long"))
    digest = lines.repartition(*conv).sortWithinPartitions(*key).mapInArrow(_digest, "known boolean, conv long, audit string, repaired_sha256 string")
    counts = outlook.groupBy(*conv).agg(*(F.max(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")))
    numbers = placed.groupBy(*conv, "turn").count().groupBy(*conv).agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    found = numbers.join(counts, conv).join(digest, conv)
    return found.select(F.when(F.col("known"), F.col("conv")).alias("conv_id"), F.coalesce("gaps", F.lit(0)).cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repair(conversations: DataFrame) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    ``conversations`` has conv_id, turn, role, text and, if a row is to count more or less than once, ``copies``; other columns are ignored. Turns are
    ordered by turn (null first), those of one turn by role and text. Null roles and texts are one space; rows without a conv_id are one conversation of
    their own. A conversation whose rows all have no copies gives zeros, an empty audit and the digest of nothing; an empty table gives no rows.
    """
    copies = F.col("copies").cast("long") if "copies" in conversations.columns else F.lit(1).cast("long")
    rows = conversations.select(F.col("conv_id").isNotNull().alias("known"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"), copies.alias("copies"))
    sizes = rows.groupBy("known", "conv").agg(F.sum("copies").alias("turns"), F.sum(F.col("copies") * F.length("text")).alias("chars"))
    long = stage(sizes.where((F.col("turns") > LONG) | (F.col("chars") > LONG_CHARS)).select("known", "conv"))
    many = long.count()
    key = ["known", "conv"]
    lookup = F.broadcast(long) if many <= 100_000 else long
    short = rows.join(lookup, key, "left_anti") if many else rows
    order = [*key, F.col("turn").asc_nulls_first(), "role", "text"]
    out = short.repartition(*key).sortWithinPartitions(*order).mapInArrow(_solve, RESULT)
    return out.unionByName(_long(rows.join(lookup, key, "left_semi"))) if many else out
