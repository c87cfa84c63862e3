"""The trie and the repair of conversations against brute force, on given and on odd rows."""

import hashlib
import heapq
import itertools
import math
import random
import zlib
from collections import defaultdict

import pytest

from genoweave.llm import conversation_trie as trie
from genoweave.llm import registry
from genoweave.llm import structure_repair as repair

SPACE = " \t\n\x0b\x0c\r"
#: Ranges, runs and chunks so small that nodes go over many tasks.
TINY = trie.TrieParams(turns_per_range=20, run_bytes=300, ids_per_chunk=2)


def by_id(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def in_turn(rows, empty):
    """Conversations as lists of (role, text) in order, nulls replaced."""
    text = lambda v: empty if v is None else str(v)
    found = defaultdict(list)
    for c, t, r, x in rows:
        found[c].append(((t is not None, t or 0), text(r), text(x)))
    return {c: [(r, x) for _, r, x in sorted(v)] for c, v in found.items()}


def brute_trie(said):
    members = defaultdict(list)
    for c, s in said.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids, leaves, saved = defaultdict(list), {}, {}
    for n in members:
        if n:
            kids[n[:-1]].append(n)
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in kids[n]) if kids[n] else 1
        saved[n] = sum(saved[k] for k in kids[n]) + ((len(members[n]) - 1) * len(n[-1][1].encode()) if n else 0)
    ends = lambda n, m: hashlib.sha256(",".join(str(c) for c in sorted(m) if len(said[c]) == len(n)).encode()).hexdigest()
    return by_id((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n], ends(n, m)) for n, m in members.items())


def brute_regrown(said):
    out = {}
    for c, s in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = said.get(c - int(math.fmod(c, 5)), [])[:h] + s[h:]
    return out


@pytest.fixture(scope="module")
def odd_conversations(spark):
    """Nulls in any column, ties, repeated rows, copies in number, long and empty conversations, ids below zero."""
    r = random.Random(5)
    rows = [(None, 1, "user", "nobody"), (None, None, None, None), (1, None, "user", "a."), (1, None, "user", "a."), (1, 2, None, "b"), (1, 2, "assistant", None), (2, 3, "assistant", "x. \n"), (2, 3, "user", "y?"), (-3, 0, "user", "low."), (-5, 0, "user", "lower!"), (0, 0, "system", "s."), (3, 0, "tool", ""), (3, 1, "", "t")]
    for c in range(10, 60):
        rows += [(c, t, ("user", "assistant")[t % 2], f"same {t}.") for t in range(1 + c % 4)]
    for c in range(100, 130):
        rows += [(c, t, r.choice(["user", "assistant", "system", "User", "bot"]), r.choice(["a", "b.", "é!", "", " ", "long " * 50])) for t in range(r.randint(1, 12))]
    rows += [(200, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(700)] + [(201, t * 3, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(650)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("key", "sizes", "i", "phase", "live", "copy", "seq", "report", "before", "signature", "depth"):
        d = d.withColumn(c, d["turn"] if c == "i" else d["text"])
    return d


def plain(d):
    return [tuple(r) for r in d.select("conv_id", "turn", "role", "text").collect()]


@pytest.mark.parametrize("p", [trie.TrieParams(), TINY])
def test_tries_of_odd_conversations(spark, odd_conversations, p):
    said = in_turn([r for r in plain(odd_conversations) if r[0] is not None], "")
    assert by_id(tuple(r) for r in trie.conversation_trie(odd_conversations, p).collect()) == brute_trie(said)
    assert by_id(tuple(r) for r in trie.regrown_trie(odd_conversations, p).collect()) == brute_trie(brute_regrown(said))


def test_tries_of_given_conversations_in_tiny_ranges(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert by_id(tuple(r) for r in trie.regrown_trie(d, TINY).collect()) == brute_trie(brute_regrown(in_turn(plain(d), "")))


def test_no_conversations(spark, odd_conversations):
    assert trie.regrown_trie(odd_conversations.limit(0)).collect() == []
    assert repair.repair_report(repair.damaged(repair.turns(odd_conversations.limit(0)))).collect() == []
    assert repair.repaired(repair.turns(odd_conversations.limit(0))).collect() == []


def test_last_turns_of_nodes(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    said = in_turn(plain(d), "")
    got = trie.with_last_turns(trie.conversation_trie(d), d).collect()
    assert len(got) == len(brute_trie(said))
    assert all((r["role"], r["text"]) == (said[r["conv_id"]][r["depth"] - 1] if r["depth"] else (None, None)) for r in got)


def test_merge_of_runs():
    r = random.Random(2)
    for _ in range(200):
        rows = [(b"".join(bytes([r.randint(0, 2)]) * trie.WIDE for _ in range(r.randint(0, 5))), c, []) for c in range(r.randint(1, 40))]
        runs = [sorted(rows[i :: r.randint(1, 6)]) for i in range(1)] + [sorted(rows)]
        k = r.randint(1, 7)
        runs = [sorted(rows[i::k]) for i in range(k) if rows[i::k]]
        carried = [[(n, trie.shared_turns(run[n - 1][0], x[0]) if n else 0, x[0], x[1], x[2]) for n, x in enumerate(run)] for run in runs]
        out = list(trie.merged(carried))
        assert [x[:2] for x in out] == sorted(x[:2] for x in rows)
        assert [x[3] for x in out] == [0] + [trie.shared_turns(a[0], b[0]) for a, b in zip(out, out[1:], strict=False)]


# --- repair ---


def brute_solve(signature):
    """The least (cost, audit) by a shortest path over (rows done, what was said last)."""
    gives, after = {"": "u", "s": "u", "u": "a", "a": "u"}, {"s": ("",), "u": ("", "s", "a"), "a": ("u",)}
    heap, seen = [(0, "", 0, "")], set()
    while True:
        cost, audit, i, said = heapq.heappop(heap)
        if i == len(signature) and said in ("", "a"):
            return cost, audit
        if (i, said) in seen:
            continue
        seen.add((i, said))
        heapq.heappush(heap, (cost + 2, audit + "I", i, gives[said]))
        if i < len(signature):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, said))
            if (mark := signature[i]) != "d":
                more = mark.isupper()
                heapq.heappush(heap, (cost + 2 + more, audit + "R", i + 1, gives[said]))
                if said in after.get(mark.lower(), ()):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, mark.lower()))


def brute_repair(rows, damage=True):
    """The report and the repaired turns of each conversation."""
    found = defaultdict(list)
    text = lambda v: " " if v is None else str(v)
    for c, t, r, x in rows:
        r, x, k = text(r), text(x), zlib.crc32(f"{text(c)}:{text(t)}".encode()) % 20 if damage else 19
        found[c] += [((t is not None, t or 0), "user" if k == 4 else r, "" if k == 1 else x.translate(dict.fromkeys(map(ord, ".!?"))) if k == 2 else x)] * (0 if k == 0 else 2 if k == 3 else 1)
    out, turns = [], {}
    for c, said in found.items():
        said.sort()
        signature, seen, n = "", set(), {"d": 0, "D": 0, "T": 0}
        for _, r, x in said:
            mark = r[:1] if r[:1] in ("s", "u", "a") else "x"
            bare = x.strip(SPACE)
            fault = "d" if not bare else "D" if (r, x) in seen else "T" if bare[-1] not in ".!?" else ""
            signature += "d" if fault in ("d", "D") else mark.upper() if fault else mark
            seen.add((r, x))
            if fault:
                n[fault] += 1
        known = [t[1] for t, _, _ in said if t[0]]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(said))
        cost, audit = brute_solve(signature)
        done, last, rest = [], "", iter(said)
        for edit in audit:
            give = "assistant" if last == "u" else "user"
            role, words = (give, "") if edit == "I" else next(rest)[1:]
            if edit != "D":
                done.append((edit, give if edit == "R" else role, words))
                last = done[-1][1][0]
        turns[c] = done
        out.append((c, max(known) - min(known) + 1 - len(set(known)) if known else 0, n["d"], n["D"], n["T"], illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for _, r, x in done).encode()).hexdigest()))
    return by_id(out), turns


def test_every_short_signature_and_long_ones():
    for n in range(4):
        for s in map("".join, itertools.product("suaxSUAXd", repeat=n)):
            assert repair.solve(s) == brute_solve(s), s
    r = random.Random(3)
    for _ in range(300):
        s = "".join(r.choice("uauauasxUAd") for _ in range(r.randint(5, 80)))
        assert repair.solve(s, repair.RepairParams(stride=r.choice([1, 2, 7, 100]))) == brute_solve(s), s


def test_repair_of_given_conversations(spark, sf_dir):
    d = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert by_id(tuple(r) for r in registry.queries()["op13_structure_repair"](spark, sf_dir).collect()) == brute_repair(plain(d))[0]


@pytest.mark.parametrize("damage", [True, False])
def test_repair_of_odd_conversations(spark, odd_conversations, damage):
    rows = repair.turns(odd_conversations)
    rows = repair.damaged(rows) if damage else rows
    report, turns = brute_repair(plain(odd_conversations), damage)
    assert by_id(tuple(r) for r in repair.repair_report(rows).collect()) == report
    got = defaultdict(list)
    for r in sorted(repair.repaired(rows).collect(), key=lambda r: r["position"]):
        got[r["conv_id"]].append((r["edit"], r["role"], r["text"]))
    assert dict(got) == {c: t for c, t in turns.items() if t}


def test_a_frequent_signature_is_solved_once(spark):
    rows = spark.range(30_000).selectExpr("id AS conv_id", "explode(sequence(0, 1)) AS turn").selectExpr("conv_id", "turn", "CASE turn WHEN 0 THEN 'user' ELSE 'assistant' END AS role", "concat(conv_id, '.') AS text")
    told = repair.signatures(repair.marked(repair.turns(rows)))
    assert [tuple(r) for r in repair.solved(told).collect()] == [("ua", 0, "KK")]
    assert repair.repair_report(repair.turns(rows)).selectExpr("sum(cost)", "count(*)").first() == (0, 30_000)
