"""Conversation repair against exhaustive search, whole and in pieces."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from netloom.llm import turns

BLANK = re.compile(r"[^\x20\x09-\x0D]")
INSERTS = ["", "u", "a", "ua", "au"]


def _damaged(rows):
    """{conv_id: rows after damage, in order} from (conv_id, turn, role, text)."""
    out = {}
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        way = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        role = "user" if way == 4 else role
        out.setdefault(conv, []).extend([(turn, role, text)] * (0 if way == 0 else 2 if way == 3 else 1))
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest())
    return {c: sorted(v, key=order) for c, v in out.items()}


def _measures(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        inside = BLANK.findall(text)
        faults.append("blank" if not inside else "duplicate" if (role, text) in seen else "truncated" if inside[-1] not in ".!?" else "")
        seen.add((role, text))
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return faults, (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal)


def _search(rows, faults):
    """(cost, audit, sha256) by trying all edits, with up to two rows inserted in
    each place."""
    best = None
    names = {"u": "user", "a": "assistant"}
    per_row = []
    for (_, role, text), fault in zip(rows, faults):
        more = fault == "truncated"
        edits = [(3, "D", None)]
        if fault not in ("blank", "duplicate"):
            edits += [(more, "K", (role, text))] * bool(role) + [(2 + more, "R", (names[x], text)) for x in "ua"]
        per_row.append(edits)
    for chosen in itertools.product(*per_row):
        for gaps in itertools.product(INSERTS, repeat=len(rows) + 1):
            cost = sum(c for c, _, _ in chosen) + 2 * sum(map(len, gaps))
            if best and cost > best[0]:
                continue
            audit, lines = "", []
            for i in range(len(rows) + 1):
                audit += "I" * len(gaps[i])
                lines += [(names[x], "") for x in gaps[i]]
                if i < len(rows):
                    audit += chosen[i][1]
                    lines += [chosen[i][2]] if chosen[i][2] else []
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                text = "\n".join(f"{r}:{t}" for r, t in lines)
                best = (cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return best


def _table(spark, rows):
    return spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, copies long").drop("copies")


def _result(rows):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r["conv_id"]: tuple(r[n] for n in names) for r in rows}


def _rows(seed, n, longest):
    rnd = random.Random(seed)
    texts = ["Hi.", "Yes! ", "no end", "", None, " \t", "What?\n", "a é.", "…"]
    out = []
    for conv in [*range(n), None]:
        for _ in range(rnd.randrange(longest + 1) if conv is not None else 2):
            out.append((conv, rnd.choice([0, 1, 2, 3, 5, None]), rnd.choice(["user", "assistant", "system", "user", "assistant", None, "tool", ""]), rnd.choice(texts)))
    return out


def test_repair_equals_exhaustive_search(spark):
    rows = _rows(1, 150, 3)
    want = {}
    for conv, damaged in _damaged(rows).items():
        if len(damaged) <= 3:
            faults, counts = _measures(damaged)
            want[conv] = (*counts, *_search(damaged, faults))
    found = turns.repair(turns.damage(_table(spark, rows))).collect()
    assert len(found) == len(_damaged(rows))
    got = _result(found)
    assert len(want) > 100 and {c: got[c] for c in want} == want


@pytest.mark.parametrize("piece", [1, 3, 50])
def test_a_conversation_in_pieces_is_repaired_as_a_whole(spark, piece):
    rnd = random.Random(piece)
    rows = _rows(2, 30, 12)
    rows += [(77, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["x.", "y?", "z", " "]) + str(t % 40)) for t in range(400)]
    rows += [(78, 5, "user", "Same.")] * 300
    frame = _table(spark, rows)
    graph = turns.StackGraph()
    want = {}
    for conv, damaged in _damaged(rows).items():
        faults, counts = _measures(damaged)
        parses = {graph.root: turns.Parse(0, "", "")}
        for (turn, role, text), fault in zip(damaged, faults):
            parses = turns.advanced(graph, parses, turns.Row(turn, role, text, fault))
        best = turns.finished(graph, parses)
        repaired = turns.Repaired(best)
        for _, role, text in damaged:
            repaired.add(role, text)
        want[conv] = (*counts, best.cost, best.audit, repaired.sha256())
    got = _result(turns.repair(turns.damage(frame.repartition(5)), piece=piece).collect())
    assert got == want


def test_stacks_follow_the_grammar():
    graph = turns.StackGraph()
    for n in range(6):
        for roles in itertools.product("sua", repeat=n):
            tops = [graph.root]
            for x in roles:
                tops = [t for v in tops for t in graph.push(v, x)]
            assert any(map(graph.accepts, tops)) == bool(re.fullmatch("(s?(ua)+)?", "".join(roles)))
    assert len(graph.stacks()) == len(set(graph.stacks())) < 20
    with pytest.raises(ValueError):
        turns.StackGraph((("S", ""), ("S", "uSa"))).stacks()


def test_no_rows(spark):
    frame = _table(spark, [])
    assert turns.repair(turns.damage(frame)).count() == 0
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    empty = hashlib.sha256(b"").hexdigest()
    assert _result(turns.repair(turns.damage(_table(spark, [(dropped, 0, "user", "Hi.")]))).collect()) == {dropped: (0, 0, 0, 0, 0, 0, "", empty)}
    wide = frame.withColumn("seen", F.lit(1)).withColumn("text_", F.lit("x")).withColumn("digest", F.lit(2))
    assert turns.repair(wide).count() == 0
