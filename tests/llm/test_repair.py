import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from strikepath.llm import repair
from strikepath.llm.common import read

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WORD = r"[^\x20\x09-\x0D]"


def damage(rows):
    """One conversation's rows after damage, in order."""
    out = []
    rows = [(c, t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows]
    for c, t, r, x in sorted(rows, key=lambda q: (q[1] is not None, q[1] or 0, q[2], hashlib.sha256(q[3].encode()).hexdigest())):
        harm = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role = "user" if harm == 4 else r
        text = "" if harm == 1 else re.sub("[.!?]", "", x) if harm == 2 else x
        out += [(t, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        marks = re.findall(WORD, text)
        out.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Cost, audit and lines by recursion over what is left, strings compared as they are."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    @cache
    def best(i, state, inserts):
        options = []
        if i == len(rows):
            if state in ("", "a"):
                options.append((0, "", ()))
        else:
            _, role, text = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            options.append((cost + 4, "D" + audit, lines))
            if found[i] not in ("blank", "duplicate"):
                more = 3 if found[i] == "truncated" else 0
                if (to := after.get((state, role[:1]))) is not None:
                    cost, audit, lines = best(i + 1, to, 0)
                    options.append((cost + more, "K" + audit, (f"{role}:{text}", *lines)))
                for to, name in names.items():
                    if after.get((state, to)):
                        cost, audit, lines = best(i + 1, to, 0)
                        options.append((cost + 3 + more, "R" + audit, (f"{name}:{text}", *lines)))
        if inserts < 3:
            for to, name in names.items():
                if after.get((state, to)):
                    cost, audit, lines = best(i, to, inserts + 1)
                    options.append((cost + 3, "I" + audit, (f"{name}:", *lines)))
        return min(options, default=(10**9, "", ()))

    return best(0, "", 0)


def exhaustive(rows, found):
    """Every sequence of letters that spends each row once and gives a legal order, by the plain rule."""
    best = None
    for n in range(len(rows) + 5):
        for audit in itertools.product("DIKR", repeat=n):
            if sum(x != "I" for x in audit) != len(rows):
                continue
            i, cost, free = 0, 0, []
            for x in audit:
                if x == "I":
                    cost, free = cost + 3, [*free, "ua"]
                    continue
                gone, cut = found[i] in ("blank", "duplicate"), found[i] == "truncated"
                if x != "D" and gone:
                    cost = None
                    break
                cost += {"K": 0, "R": 3, "D": 4}[x] + (3 if cut and x != "D" else 0)
                if x != "D":
                    free.append("ua" if x == "R" else rows[i][1][:1])
                i += 1
            if cost is None or not any(re.fullmatch("(s?(ua)+)?", "".join(p)) for p in itertools.product(*free)):
                continue
            best = min(best or (cost, "".join(audit)), (cost, "".join(audit)))
    return best


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = damage([r for r in rows if r[0] == conv])
        found = faults(own)
        turns = {t for t, _, _ in own if t is not None}
        initials = [r[:1] for _, r, _ in own]
        cost, audit, lines = cheapest(own, found)
        out.append(
            (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[found.count(x) for x in ("blank", "duplicate", "truncated")],
             sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
        )
    return sorted(out, key=str)


def repaired(df):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r[c] for c in names) for r in repair.repair(df).collect()), key=str)


def conversation(rng, conv, n):
    roles = ["user", "assistant", "system", "tool", "", None, "usher", "agent"]
    texts = ["a.", "b!", "c", "d. ", " ", "", None, "e?\n", "é..", "what"]
    return [(conv, rng.randrange(2 * n + 1), rng.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], rng.choice(texts) if rng.random() < 0.3 else f"t{rng.randrange(50)}" + rng.choice(".!?;")) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_paths_equal_every_sequence(seed):
    rng = random.Random(seed)
    for _ in range(25):
        rows = [(k, rng.choice(["user", "assistant", "system", "x"]), "t") for k in range(rng.randrange(4))]
        found = [rng.choice(["", "", "truncated", "blank"]) for _ in rows]
        assert cheapest(rows, found)[:2] == exhaustive(rows, found)
        if rows:
            kinds = [{"": 0, "blank": 1, "truncated": 2}[f] for f in found]
            roles, texts = [r[1] for r in rows], [r[2] for r in rows]
            cost, states = repair.through([repair.segment(roles, kinds)])
            audit, lines = repair.repaired(roles, texts, kinds, *states[0], True)
            assert (cost, audit, tuple(lines)) == cheapest(rows, found)


@pytest.mark.parametrize("size", [1, 2, 5, 4096])
def test_equals_brute_force_in_segments_of_any_size(spark, monkeypatch, size):
    monkeypatch.setattr(repair, "SEGMENT", size)
    rng = random.Random(size)
    rows = [r for c in range(60) for r in conversation(rng, c, rng.choice([1, 2, 4, 9, 30]))]
    # One conversation with most rows, over several range partitions.
    rows += conversation(rng, 500, 400)
    rng.shuffle(rows)
    assert repaired(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_given_conversations(spark, sf_dir):
    df = read(spark, sf_dir, "conversations")
    assert repaired(df) == brute([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_odd_rows(spark):
    rows = [(None, 1, "user", "a."), (None, None, None, None), (1, None, "user", "x." * 50_000), (1, None, "user", "x." * 50_000), (1, 3, "assistant", "y"), (2, 5, "user", ""), (3, 2, None, "z.")]
    clash = spark.createDataFrame([(*r, "p", "q", 1) for r in rows], SCHEMA + ", place string, digest string, fault int")
    assert repaired(clash) == brute(rows)
    assert repaired(spark.createDataFrame([], SCHEMA)) == []
    # A conversation that loses all its rows.
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert repaired(spark.createDataFrame([(gone, 0, "user", "a.")], SCHEMA)) == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
