"""The operators on conversations against brute force, and on awkward tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from assay.llm import queries, repair, trie

FOLDER = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"
CLASHES = ["depth", "pa", "kind", "shard", "band", "number", "_key", "copies", "first", "h", "n", "c", "a", "place", "block"]


def clashing(table):
    for name in CLASHES:
        table = table.withColumn(name, F.lit("clash"))
    return table


def awkward(spark):
    """Nulls in any column, empty and long texts, repeated rows and numbers, odd roles and ids."""
    rows = [(None, 1, "user", "Lost."), (None, None, None, None), (7, None, "system", "Be kind.")]
    rows += [(7, 2, "user", "Hi."), (7, 2, "user", "Hi."), (7, 5, None, "What?"), (7, 6, "assistant", None)]
    rows += [(9, k, "user" if k % 2 else "assistant", f"Turn {k % 4}" + "." * (k % 3)) for k in range(30)]
    rows += [(11, 1, "user", "long " * 60_000 + "."), (11, 2, "assistant", ""), (-5, 1, "", " \t\n")]
    rows += [(-205, 1, "tool", "x."), (-205, 2, "ux", "日本."), (12, None, None, "")]
    random.seed(4)
    rows += [
        (100 * b + k, t, random.choice(["user", "assistant", "system"]), random.choice(["Yes.", "No", "", "Yes. "]))
        for b in (0, 3) for k in (0, 1, 2, 50, 99) for t in range(random.randint(1, 9))
    ]
    return spark.createDataFrame(rows, TURNS)


def rows_of(table):
    return [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]


# 11 trie


def brute_trie(rows, block=100, classes=6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % classes
        base = c - (abs(c) % block) * (1 if c > 0 else -1)
        paths[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(set)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    totals = defaultdict(lambda: [0, 0])
    for node, ids in members.items():
        for d in range(len(node) + 1):
            totals[node[:d]][0] += not children[node]
            totals[node[:d]][1] += (len(ids) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (
            min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), children[node],
            *totals[node],
            hashlib.sha256(",".join(str(c) for c in sorted(ids) if len(paths[c]) == len(node)).encode()).hexdigest(),
        )
        for node, ids in members.items()
    )


def nodes_of(table, **options):
    return sorted(map(tuple, trie.prefix_trie(*trie.branched(table), **options).collect()))


@pytest.mark.parametrize("options", [{}, {"levels": 1, "queue": 3}, {"levels": 3, "queue": 2}])
def test_trie_equals_brute_force(spark, options, monkeypatch, many_partitions):
    monkeypatch.setattr(trie, "BLOCK", 4)
    table = awkward(spark)
    # level rows follow a hash, so this table keeps them equal
    level = [(c, t) for c, t, *_ in rows_of(table)]
    assert len(level) > len(set(level))
    assert nodes_of(clashing(table), **options) == brute_trie(rows_of(table))


def test_trie_of_one_long_conversation(spark):
    rows = [(100 * (k % 2), k, "user", f"{k // 2}.") for k in range(4000)]
    table = spark.createDataFrame(rows, TURNS)
    assert nodes_of(table, levels=64, queue=10) == brute_trie(rows)


def test_ends_of_a_hot_node_are_joined_in_order(spark, monkeypatch):
    monkeypatch.setattr(trie, "ENDS", 2)
    rows = [(c, 0, "user", "Same.") for c in range(-30, 400, 3)]
    assert nodes_of(spark.createDataFrame(rows, TURNS)) == brute_trie(rows)


def test_trie_of_nothing(spark):
    assert nodes_of(clashing(awkward(spark).limit(0))) == []


def test_queue_spills_and_adds_up():
    random.seed(2)
    queue, want = trie.Messages(5), defaultdict(lambda: [0, 0, 0])
    for _ in range(500):
        key = (random.randint(0, 5), random.randint(-3, 3), 0)
        values = [random.randint(0, 9) for _ in range(3)]
        queue.push((*key, *values))
        want[key] = [a + b for a, b in zip(want[key], values)]
    for key in sorted(want):
        assert list(queue.take(key)) == want[key]
    assert not queue.heap and not queue.runs


# 12 repair


def brute_audit(codes):
    """Every sequence of edits, by recursion over turns and grammar states."""

    @lru_cache(None)
    def go(i, state, inserts):
        ways = [(0, "")] if i == len(codes) and state in ("", "a") else []

        def take(cost, letter, way):
            if way is not None:
                ways.append((cost + way[0], letter + way[1]))

        following = "a" if state == "u" else "u"
        if i < len(codes):
            code, extra = codes[i], 5 if codes[i].isupper() else 0
            take(2, "D", go(i + 1, state, 0))
            if code != "d":
                if code.lower() == "s" and state == "":
                    take(extra, "K", go(i + 1, "s", 0))
                kept = code.lower() == following
                take(extra + (not kept), "K" if kept else "R", go(i + 1, following, 0))
        if inserts < 3:
            take(5, "I", go(i, following, inserts + 1))
        return min(ways, default=None)

    return go(0, "", 0)


def brute_repairs(rows):
    conversations = defaultdict(list)
    for c, turn, role, text in rows:
        kept = conversations[c]
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if c is None else c}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        kept += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for c, turns in conversations.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, *t[1:]))
        numbers = {t for t, *_ in turns if t is not None}
        seen, codes, counts = set(), "", dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in turns:
            fault = ""
            words = re.findall(r"[^\x20\x09-\x0D]", text)
            if not words:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif words[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "d" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        pairs = zip(turns, turns[1:])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs)
        cost, audit = brute_audit(codes)
        result, state, i = [], "", 0
        for edit in audit:
            if edit in "KRI":
                state = turns[i][1][0] if edit == "K" else "a" if state == "u" else "u"
                role = turns[i][1] if edit == "K" else {"u": "user", "a": "assistant"}[state]
                result.append(f"{role}:{'' if edit == 'I' else turns[i][2]}")
            i += edit != "I"
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        digest = hashlib.sha256("\n".join(result).encode()).hexdigest()
        out.append((c, gaps, *counts.values(), illegal, cost, audit, digest))
    return sorted(out, key=str)


def repairs_of(table):
    return sorted(map(tuple, repair.repairs(repair.damaged(table), table).collect()), key=str)


def test_repair_equals_brute_force(spark, many_partitions):
    table = awkward(spark)
    assert repairs_of(clashing(table)) == brute_repairs(rows_of(table))


def test_repair_query_equals_brute_force(spark):
    rows = rows_of(spark.read.parquet(f"{FOLDER}/conversations.parquet"))
    found = queries.op12_structure_repair(spark, FOLDER).collect()
    assert sorted(map(tuple, found), key=str) == brute_repairs(rows)


def test_repair_of_nothing(spark):
    assert repairs_of(clashing(awkward(spark).limit(0))) == []


@pytest.mark.parametrize("segment", [1, 2, 3, 7, 512])
def test_alignment_is_cheapest_and_least_whatever_the_segments(segment, monkeypatch):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    random.seed(segment)
    roles = {"s": "system", "u": "user", "a": "assistant"}
    for k in range(600):
        letters = "suaSUAxXd" if k % 2 else "uauauaxd"
        codes = "".join(random.choice(letters) for _ in range(random.randint(0, 14)))
        made = repair.Repair(1)
        for turn, code in enumerate(codes):
            text = b"" if code == "d" else b"cut" if code.isupper() else b"whole."
            made.add(turn, roles.get(code.lower(), "tool"), text, False)
        assert made.report()[6:8] == brute_audit(codes), codes


def test_a_long_conversation_costs_the_same_in_one_segment(monkeypatch):
    random.seed(9)
    codes = "".join(random.choice("uauauauasuaSUAxXd") for _ in range(700))
    whole = min(repair.align(codes, (("", ""), ("", "a"))).values())
    assert whole == brute_audit_iterative(codes)


def brute_audit_iterative(codes):
    """The same as ``brute_audit`` from the last turn on, for texts too long for recursion."""
    ways = {"": (0, ""), "a": (0, "")}

    def with_inserts(ways):
        for _ in range(3):
            new = dict(ways)
            for state in ("", "s", "u", "a"):
                following = "a" if state == "u" else "u"
                if following in ways:
                    cost, audit = ways[following]
                    new[state] = min(new.get(state, (1 << 60, "")), (cost + 5, "I" + audit))
            ways = new
        return ways

    ways = with_inserts(ways)
    for code in reversed(codes):
        before = {}
        for state in ("", "s", "u", "a"):
            following, extra = "a" if state == "u" else "u", 5 if code.isupper() else 0
            options = [(ways[state][0] + 2, "D" + ways[state][1])] if state in ways else []
            if code != "d":
                kept = code.lower() == following
                if following in ways:
                    cost, audit = ways[following]
                    options.append((cost + extra + (not kept), ("K" if kept else "R") + audit))
                if code.lower() == "s" and state == "" and "s" in ways:
                    options.append((ways["s"][0] + extra, "K" + ways["s"][1]))
            if options:
                before[state] = min(options)
        ways = with_inserts(before)
    return ways[""]
