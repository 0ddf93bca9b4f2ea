"""Conversation repair against a plain dynamic programme, in one chunk and in many."""

import collections
import functools
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from spanloom.llm import turns

INK = re.compile(r"[^\x20\x09-\x0D]")


def plain_edits(rows):
    """(cost, audit, repaired) of the cheapest edits, by the least (cost, audit); rows: (role, text, fault)."""
    wanted = {0: "u", 1: "u", 2: "a", 3: "u"}
    to = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}

    @functools.cache
    def best(i, s, inserted):
        found = []
        if i == len(rows):
            if s in (0, 3):
                found.append((0, "", ()))
        else:
            role, text, fault = rows[i]
            c, audit, rest = best(i + 1, s, 0)
            found.append((c + 3, "D" + audit, rest))
            if fault not in ("blank", "duplicate"):
                more = int(fault == "truncated")
                if (s, role[:1]) in to:
                    c, audit, rest = best(i + 1, to[s, role[:1]], 0)
                    found.append((c + more, "K" + audit, ((role, text), rest)))
                c, audit, rest = best(i + 1, to[s, wanted[s]], 0)
                found.append((c + 2 + more, "R" + audit, (({"u": "user", "a": "assistant"}[wanted[s]], text), rest)))
        if inserted < 4:
            c, audit, rest = best(i, to[s, wanted[s]], inserted + 1)
            found.append((c + 2, "I" + audit, (({"u": "user", "a": "assistant"}[wanted[s]], ""), rest)))
        return min(found, key=lambda x: x[:2], default=(10**6, "", ()))

    c, audit, rest = best(0, 0, 0)
    out = []
    while rest:
        out.append(rest[0])
        rest = rest[1]
    return c, audit, out


def plain(rows):
    """The report of one conversation's rows (turn, role, text) after damage."""
    mark = lambda r: hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, mark(r)))
    seen, judged = set(), []
    for _, role, text in rows:
        ink = INK.findall(text)
        fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None
        seen.add((role, text))
        judged.append((role, text, fault))
    known = [t for t, *_ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    faults = collections.Counter(f for *_, f in judged)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:], strict=False))
    cost, audit, fixed = plain_edits(tuple(judged))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
    return gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, digest


def harmed(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        conv_, turn_, role, text = (" " if x is None else x for x in (conv, turn, role, text))
        kind = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        out[conv] += []
        if kind:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def conversations(rng, n, longest=14):
    rows = []
    for conv in [None, *range(n)]:
        roles = rng.choice([["user", "assistant"], ["system", "user", "assistant", "tool", None, "", "User"], ["system"], ["user"]])
        texts = rng.choice([["Yes.", "No!", "Why?  \n"], ["Yes.", "so", "", " ", None, "Well. \x0b", "a.b", "　"]])
        size = rng.randint(1, longest)
        rows += [(conv, rng.choice([t, t, t, t + 3, None]), roles[t % len(roles)] if rng.random() < 0.8 else rng.choice(roles), f"{rng.choice(texts)}" if rng.random() < 0.3 else rng.choice(texts)) for t in range(size)]
    return rows + rows[:9]


COLUMNS = "conv_id long, turn long, role string, text string, audit int, no string"


@pytest.mark.parametrize("size", [turns.CHUNK, 2, 1])
def test_report(spark, size):
    rows = conversations(random.Random(8), 90 if size > 2 else 40)
    table = spark.createDataFrame([(*r, 1, "no") for r in rows], COLUMNS).repartition(5)
    found = turns.report(table, size).collect()
    want = {conv: plain(own) for conv, own in harmed(rows).items()}
    assert len(found) == len(want)
    for r in found:
        assert tuple(r)[1:] == want[r.conv_id], r.conv_id
    if size == turns.CHUNK:
        assert len({r.audit for r in found}) > 30
        assert turns.report(table.where("false")).count() == 0


def test_vectors_stay_within_the_speculative_ones():
    """Any cost vector is the least of the speculative ones, shifted by its own costs, so that they lose nothing."""
    rng = np.random.default_rng(0)
    least = lambda v: (v[:, None] + turns.SPECULATIVE).min(axis=0)
    codes = [rng.integers(0, 16, rng.integers(0, 12)) for _ in range(500)]
    for end in (turns.AT_END, *turns.SPECULATIVE):
        assert (least(end) == end).all()
        ends = np.broadcast_to(end, (len(codes), 4))
        for c, v, all_ in zip(codes, turns.backward(codes, ends, False), turns.backward(codes, ends, True), strict=True):
            assert (least(v) == v).all() and (all_[-1 - len(c)] == v).all()


def test_long_conversation_in_many_chunks(spark):
    """Conversations that never converge (system rows only, blank rows only) are stitched, too, in passes that double."""
    rng = random.Random(3)
    made = {
        1: [("system", f"{i}.") for i in range(301)], 2: [("user", " ") for _ in range(257)], 3: [("user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(400)],
        4: [(rng.choice(["user", "assistant", "system", "x"]), rng.choice([f"{i}.", f"{i}"])) for i in range(500)], 5: [],
    }
    rows = [(conv, t, *r) for conv, own in made.items() for t, r in enumerate(own)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {r.conv_id: (r.cost, r.audit) for r in summed(turns.edits(turns.chunks(turns.numbered(table))))}
    cut = turns.chunks(turns.numbered(table), 7)
    assert cut.where("conv_id = 4").count() >= 500 // 7 and cut.where("last").count() == 4
    assert {r.conv_id: (r.cost, r.audit) for r in summed(turns.edits(cut))} == whole
    assert whole[2] == (3 * 257, "D" * 257) and whole[3] == (0, "K" * 400)


def summed(found):
    out = collections.defaultdict(lambda: [0, ""])
    for r in found.orderBy("conv_id", "no").collect():
        out[r.conv_id][0] += r.cost
        out[r.conv_id][1] += r.audit
    return [type("R", (), {"conv_id": k, "cost": v[0], "audit": v[1]}) for k, v in out.items()]
