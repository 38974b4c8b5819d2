"""Conversation repair and the conversation trie against plain versions."""

import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest

from slowtide.llm import repair, trie

SCHEMA = "Text string, conv_id long, turn long, role string, text string, kind string, place string, cost string"


def conversations(spark, folder="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{folder}/conversations.parquet")


def frame(spark, rows):
    return spark.createDataFrame([(None, *r, "x", None, "y") for r in rows], SCHEMA).repartition(4)


def awkward_rows():
    """Nulls, ties, repeats, blank and long texts, missing turns, odd roles, negative ids, and one long conversation."""
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "usher"]
    texts = ["Yes.", "no", " ", "", None, "What? ", "a.b", "x" * 5000 + ".", "Ünï.\n", " ", "end!\t"]
    rows = []
    for conv in [*range(-3, 60), 100, 101, 199, 205, None]:
        for turn in range(rng.randint(1, 9)):
            for _ in range(rng.choice([1, 1, 1, 1, 2])):
                rows.append((conv, rng.choice([turn, turn, turn, turn * 2, None]), rng.choice(roles), rng.choice(texts)))
    for turn in range(300):
        rows.append((300, turn, ["user", "assistant", "system"][rng.choice([0, 1, 0, 1, 2])] if turn % 5 else "user", rng.choice(texts) if turn % 3 else f"turn {turn}."))
    rows += [rows[3]] * 3 + [(301, 0, "user", "same.")] * 150
    return rows


# repair


def harmed(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out += [(conv, turn, role, text)] * (2 if code == 3 else 1)
    return out


def tie(conv, role, text):
    return hashlib.sha256(f"{'-' if conv is None else conv}:{len(role)}:{role}{text}".encode()).digest()


@functools.cache
def cheapest(codes):
    """(cost, letters) by plain dynamic programming over whole strings."""
    best = {}
    n = len(codes)
    inf = (10**9, "")

    def relax(i, state, value):
        if value < best.get((i, state), inf):
            best[i, state] = value
            return True
        return False

    # backwards: the suffix of least cost, then least letters
    for i in range(n, -1, -1):
        for state in range(4):
            options = []
            if i == n and state in (0, 3):
                options.append((0, ""))
            if i < n:
                kind, fault = codes[i]
                c, a = best[i + 1, state]
                options.append((c + 3, "D" + a))
                if fault not in ("blank", "duplicate"):
                    more = fault == "truncated"
                    moves = [("K", 0, kind)] + [("R", 2, x) for x in "ua"]
                    for letter, cost, to in moves:
                        ahead = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((to, state))
                        if ahead is not None and (i + 1, ahead) in best:
                            c, a = best[i + 1, ahead]
                            options.append((c + cost + more, letter + a))
            for o in options:
                relax(i, state, o)
        changed = True
        while changed:
            changed = False
            for state, ahead in ((0, 2), (1, 2), (3, 2), (2, 3)):
                if (i, ahead) in best:
                    c, a = best[i, ahead]
                    changed |= relax(i, state, (c + 2, "I" + a))
    return best[0, 0]


def judged(rows):
    """conv_id -> the report, from damaged rows."""
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = {}
    for conv, own in by.items():
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], tie(conv, r[2], r[3])))
        seen, codes = set(), []
        for _, _, role, text in own:
            chars = re.sub(r"[\x20\x09-\x0D]", "", text)
            codes.append((role[:1], "blank" if not chars else "duplicate" if (role, text) in seen else "truncated" if chars[-1] not in ".!?" else ""))
            seen.add((role, text))
        cost, letters = cheapest(tuple(codes))
        lines, i, state = [], 0, 0
        for x in letters:
            want = "a" if state == 2 else "u"
            if x == "I":
                lines.append({"u": "user", "a": "assistant"}[want] + ":")
            elif x != "D":
                kind = own[i][2][0] if x == "K" else want
                lines.append((own[i][2] if x == "K" else {"u": "user", "a": "assistant"}[want]) + ":" + own[i][3])
            if x == "I":
                kind = want
            if x != "D":
                state = {"s": 1, "u": 2, "a": 3}[kind]
            i += x != "I"
        turns = [r[1] for r in own if r[1] is not None]
        faults = [c[1] for c in codes]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum((a[0] + b[0]) not in ("su", "ua", "au") for a, b in itertools.pairwise(codes)), cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


@pytest.mark.parametrize("which", ["table", "awkward"])
def test_repair_report(spark, which):
    rows = [tuple(r) for r in conversations(spark).select("conv_id", "turn", "role", "text").collect()] if which == "table" else awkward_rows()
    source = frame(spark, rows)
    want = {c: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in rows} | judged(harmed(rows))
    got = repair.report(repair.damaged(source), repair._integers(source)).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r["conv_id"]], r["conv_id"]


def test_repaired_rows(spark):
    """The rows of the repaired conversations hash to what the report says, and their roles are legal."""
    rows = frame(spark, harmed(awkward_rows()))
    by = defaultdict(list)
    for r in repair.repair(rows).orderBy("conv_id", "position").collect():
        by[r["conv_id"]].append((r["position"], r["role"], r["text"]))
    for conv, (*_, digest) in judged(harmed(awkward_rows())).items():
        assert [p for p, _, _ in by[conv]] == list(range(len(by[conv])))
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for _, r, _ in by[conv]))
        assert hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in by[conv]).encode()).hexdigest() == digest


def test_auction_is_optimal():
    """Auctions over runs joined at their borders give the cheapest letters of every short row of codes."""
    rng = random.Random(3)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 2, 3]) + 4 * rng.choice([0, 0, 1, 2, 3]) for _ in range(rng.randint(1, 40)))
        cost, letters = cheapest(tuple(("sua?"[c & 3], repair.FAULTS[c >> 2]) for c in codes))
        cuts = sorted({0, len(codes), *[rng.randint(0, len(codes)) for _ in range(2)]})
        parts = [codes[a:b] for a, b in itertools.pairwise(cuts)]
        exits = [repair.END]
        for part in reversed(parts[1:]):
            table = repair.between(part)
            exits.insert(0, tuple(min(table[4 * s + g] + exits[0][g] for g in range(4)) for s in range(4)))
        state, found = 0, ""
        for part, border in zip(parts, exits, strict=True):
            total, piece, state_after = repair.traced(part, border)[state]
            if not found and state == 0:
                assert total == cost
            found, state = found + piece, state_after
        assert found + repair.CLOSING[state] == letters


def test_repair_of_nothing(spark):
    empty = frame(spark, [(1, 1, "user", "x")]).filter("false")
    assert repair.report(repair.damaged(empty), repair._integers(empty)).count() == 0
    assert repair.repair(empty).count() == 0


# trie


def rebuilt_plain(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            by[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    first = {c: [r[3:] for r in sorted(v)] for c, v in by.items()}
    out = {}
    for c, own in first.items():
        h = zlib.crc32(str(c).encode()) % 6
        donor = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = first.get(donor, [])[:h] + own[h:]
    return out


def plain_trie(paths):
    groups = defaultdict(list)
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            groups[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for p in groups:
        if p:
            children[p[:-1]].append(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, convs in groups.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(convs) - 1) * len(p[-1][1]) if p else 0
    ends = {p: ",".join(map(str, sorted(c for c in convs if len(paths[c]) == len(p)))) for p, convs in groups.items()}
    return sorted(
        (min(convs), len(p), min(groups[p[:-1]]) if p else None, len(convs), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends[p].encode()).hexdigest())
        for p, convs in groups.items()
    )


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("which", ["table", "awkward", "nested"])
def test_trie(spark, which):
    if which == "table":
        rows = [tuple(r) for r in conversations(spark).select("conv_id", "turn", "role", "text").collect()]
    elif which == "awkward":
        rows = awkward_rows()
    else:  # few different turns, shared prefixes that cross bands, chains of owners, many copies
        rng = random.Random(9)
        rows = [(c, t, "user", str(t % 7) if t < (c * 37) % 150 else rng.choice("ab")) for c in range(40) for t in range((c * 53) % 160)]
        rows += [(c, t, "user", str(t % 7)) for c in range(500, 560) for t in range(70)]
    got = trie.trie(*trie.rebuilt(trie.sequences(frame(spark, rows)))).select(*COLUMNS).collect()
    assert sorted(map(tuple, got)) == plain_trie(rebuilt_plain(rows))


def test_trie_texts_and_nothing(spark):
    source = conversations(spark)
    nodes = trie.with_texts(trie.trie(*trie.rebuilt(trie.sequences(source))), source).collect()
    paths = rebuilt_plain([tuple(r) for r in source.select("conv_id", "turn", "role", "text").collect()])
    assert all((r["role"], r["text"]) == paths[r["conv_id"]][r["depth"] - 1] for r in nodes if r["depth"])
    empty = frame(spark, [(1, 1, "user", "x")]).filter("false")
    assert trie.trie(*trie.rebuilt(trie.sequences(empty))).count() == 0


def test_prefix_names():
    """Names depend on the prefix alone, not on what follows it."""
    turns = [trie.name_of(bytes([i])) for i in range(32)]
    whole = trie.prefixes(turns)
    assert len(set(whole)) == 32
    assert all(trie.prefixes(turns[:n]) == whole[:n] for n in range(1, 33))
