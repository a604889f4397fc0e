import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from pyspark.sql import functions as F

from commitlake.llm import dialogue

SPACES = "\x20\x09-\x0D"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        what = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        row = (conv, turn, "user" if what == 4 else role, "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text)
        out += [row] * {0: 0, 3: 2}.get(what, 1)
    return out


def plain(rows):
    """One conversation's (blank, duplicate, truncated, illegal, gaps, cost, audit, repaired lines) by definition."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
    seen, faults = set(), []
    for *_, role, text in rows:
        kept = re.findall(f"[^{SPACES}]", text)
        faults.append("b" if not kept else "d" if (role, text) in seen else "t" if kept[-1] not in ".!?" else "")
        seen.add((role, text))
    roles = [r[2] for r in rows]
    illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    due = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    @cache
    def best(i, state, inserted):
        """(cost, audit, lines) from row i on; ``state`` is the last role initial of what stays."""
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            c, a, rest = best(i, due[state], inserted + 1)
            found.append((c + 5, "I" + a, (name[due[state]] + ":", *rest)))
        if i < len(rows):
            role, text = rows[i][2:]
            c, a, rest = best(i + 1, state, 0)
            found.append((c + 2, "D" + a, rest))
            if faults[i] not in ("b", "d"):
                extra = 5 * (faults[i] == "t")
                if role[:1] == due[state] or (role[:1] == "s" and state == ""):
                    c, a, rest = best(i + 1, role[:1], 0)
                    found.append((c + extra, "K" + a, (f"{role}:{text}", *rest)))
                for to in "ua":
                    if to == due[state]:
                        c, a, rest = best(i + 1, to, 0)
                        found.append((c + extra + 1, "R" + a, (f"{name[to]}:{text}", *rest)))
        return min(found) if found else (10**9, "~", ())

    cost, audit, lines = best(0, "", 0)
    return [*(faults.count(x) for x in "bdt"), illegal, gaps, cost, audit, "\n".join(lines)]


def want(rows):
    convs = {r[0]: [] for r in rows}
    for r in damage(rows):
        convs[r[0]].append(r)
    out = {}
    for conv, found in convs.items():
        blank, dup, cut, illegal, gaps, cost, audit, text = plain(found)
        out[conv] = (gaps, blank, dup, cut, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string"


def got(frame):
    found = dialogue.audit_table(dialogue.damaged(frame), frame).collect()
    assert len({r.conv_id for r in found}) == len(found)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in found}


def corpus(n=250):
    rng = random.Random(3)
    roles = ["user", "assistant"] * 4 + ["system", "system", "tool", "User", "", "agent", None]
    texts = ["Well.", "Yes!", "what?", "cut off", "cut. off", "  ", "", "é…", "Fine. \n\t", "a. ", None, "中。", "ok.", "\x0b."]
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, 12)):
            if rng.random() < 0.9:
                rows.append((conv, None if rng.random() < 0.03 else turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"text {rng.random()}."))
    rows += [(None, i, "user" if i % 2 else "assistant", f"no id {i}.") for i in range(5)]
    rows += [(n, None, "user", "a.")] * 3 + [(n + 1, 3, "user", "twice."), (n + 1, 3, "user", "twice."), (n + 1, 3, "assistant", "b")]
    return rows


def test_audit_equals_the_definition(spark):
    rows = corpus()
    found, wanted = got(spark.createDataFrame(rows, SCHEMA).repartition(5)), want(rows)
    assert found == wanted
    assert {c for v in wanted.values() for c in v[6]} == set("DKR"), "at these costs deleting is cheaper than inserting"


def test_insertions_where_deleting_is_dear(monkeypatch):
    monkeypatch.setattr(dialogue, "DELETE", 9)
    dialogue.matrix.cache_clear(), dialogue.power.cache_clear()
    try:
        # u u u: an a behind the first is as cheap as one at the end, and comes first by ASCII
        assert dialogue.audit_of([(2, 3)], 0, dialogue.END, dialogue.Unroller()) == ("KIKR", 3)
        assert dialogue.audit_of([(0, 1), (4, 1)], 0, dialogue.END, dialogue.Unroller()) == ("RK", 3)
    finally:
        dialogue.matrix.cache_clear(), dialogue.power.cache_clear()


def test_cut_conversations_equal_whole_ones(spark, monkeypatch):
    """A conversation with half of all rows, cut into many chunks, some inside runs of equal symbols."""
    rng = random.Random(8)
    rows = [(1, t, rng.choice(["system", "user", "user", "assistant"]) if t < 60 or t > 90 else "system", rng.choice(["a.", f"b {t}.", "", f"c{t}"]))
            for t in range(150)]
    rows += corpus(30)
    whole = got(spark.createDataFrame(rows, SCHEMA))
    monkeypatch.setattr(dialogue, "CHUNK", 7)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == whole == want(rows)


def test_a_run_of_a_million_rows():
    for symbol, edits in ((dialogue.FORCED, "D"), (0, None), (2, None), (5, None)):
        n = 1_000_000
        runs = [(2, 1), (symbol, n), (4, 1)]
        audit, _ = dialogue.audit_of(runs, 0, dialogue.END, dialogue.Unroller())
        assert len(audit.replace("I", "")) == n + 2 and (edits is None or set(audit[1:-1]) == {edits})
    short = [(2, 1), (0, 9), (2, 4), (7, 5), (3, 8)]
    whole = dialogue.audit_of(short, 0, dialogue.END, dialogue.Unroller())
    single = [(s, 1) for s, n in short for _ in range(n)]
    assert whole == dialogue.audit_of(single, 0, dialogue.END, dialogue.Unroller())


def test_repeated_rows_of_a_hot_conversation(spark):
    rows = [(2, 5, "user", "again.")] * 4000 + [(2, 6, "assistant", "done.")]
    frame = spark.createDataFrame(rows, SCHEMA)
    r = dialogue.audit_table(frame, frame).first()
    assert (r.duplicate, r.illegal, r.cost, r.audit) == (3999, 3999, 2 * 3999, "K" + "D" * 3999 + "K")
    assert r.repaired_sha256 == hashlib.sha256(b"user:again.\nassistant:done.").hexdigest()


@pytest.mark.parametrize("names", [[], ["c", "chunk", "h", "n", "kind", "again", "audit", "conv", "cost", "before"]])
def test_edges(spark, names):
    rows = [(1, 0, "user", "hi."), (None, None, None, None), (7, 1, "user", "x" * 100_000 + "."), (7, 2, "assistant", " " * 50_000)]
    frame = spark.createDataFrame([(*r, *range(len(names))) for r in rows], SCHEMA + "".join(f", {n} long" for n in names))
    assert got(frame) == want(rows)
    assert dialogue.audit_table(frame.limit(0), frame.limit(0)).count() == 0
    gone = dialogue.audit_table(frame.limit(0), frame)
    assert gone.where("cost = 0 AND audit = '' AND gaps = 0").where(F.col("repaired_sha256") == hashlib.sha256(b"").hexdigest()).count() == 3
