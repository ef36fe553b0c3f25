import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from quillsieve.llm.repair import BLANK, DUPLICATE, FINE, TRUNCATED, cheapest, damaged, op12_conversation_repair, repair, repaired

GRAMMAR = re.compile(r"(s?(ua)+)?")


def brute(rows):
    """All edit scripts whose roles stay in the grammar, at most two insertions in a row."""
    moves = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    best = None

    def walk(i, audit, state, cost, inserts):
        nonlocal best
        if i == len(rows) and state in ("", "a"):
            if best is None or (cost, audit) < best:
                best = (cost, audit)
        if inserts < 2:
            for r in "ua":
                if r in moves[state]:
                    walk(i, audit + "I", moves[state][r], cost + 2, inserts + 1)
        if i == len(rows):
            return
        role, fault = rows[i]
        extra = 1 if fault == TRUNCATED else 0
        walk(i + 1, audit + "D", state, cost + 3, 0)
        if fault in (BLANK, DUPLICATE):
            return
        if role[:1] in moves[state]:
            walk(i + 1, audit + "K", moves[state][role[:1]], cost + extra, 0)
        for new in ("user", "assistant"):
            if new != role and new[:1] in moves[state]:
                walk(i + 1, audit + "R", moves[state][new[:1]], cost + 2 + extra, 0)

    walk(0, "", "", 0, 0)
    assert GRAMMAR
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", " ", "uber"]), st.sampled_from([BLANK, DUPLICATE, TRUNCATED, FINE, FINE])), max_size=6))
def test_search_equals_brute_force(rows):
    assert cheapest(rows) == brute(rows)


def test_known_cases():
    assert cheapest([]) == (0, "")
    assert cheapest([("user", FINE), ("assistant", FINE)]) == (0, "KK")
    assert cheapest([("system", FINE), ("user", TRUNCATED)]) == (3, "KKI")
    assert cheapest([("assistant", FINE)]) == (2, "IK")
    rows = [("user", "a"), ("user", "b")]
    cost, audit = cheapest([(r, FINE) for r, _ in rows])
    assert cost == 2 and [r for r, _ in repaired(rows, audit)] in (["user", "assistant"], ["user", "assistant", "user", "assistant"])


def test_long_conversation_is_fast():
    dice = random.Random(3)
    rows = [(dice.choice(["user", "assistant", "system"]), dice.choice([FINE, FINE, TRUNCATED, BLANK])) for _ in range(20_000)]
    cost, audit = cheapest(rows)
    assert len(audit) >= 20_000 and cost >= 0


def slow_query(convs):
    """The whole query in Python for a list of (conv_id, turn, role, text)."""
    out = {}
    by = {}
    for c, t, r, x in convs:
        by.setdefault(c, [])
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = (" " if r is None else r), (" " if x is None else x)
        if kind == 0:
            continue
        if kind == 1:
            x = ""
        if kind == 2:
            x = re.sub(r"[.!?]", "", x)
        if kind == 4:
            r = "user"
        by[c] += [(t, r, x)] * (2 if kind == 3 else 1)
    for c, rows in by.items():
        rows.sort(key=lambda z: (z[0] is not None, z[0] or 0, z[1], z[2]))
        seen, faults = set(), []
        for t, r, x in rows:
            vis = re.findall(r"[^\x20\x09-\x0D]", x)
            f = BLANK if not vis else DUPLICATE if (r, x) in seen else TRUNCATED if vis[-1] not in ".!?" else FINE
            seen.add((r, x))
            faults.append(f)
        turns = {t for t, _, _ in rows if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(1 for a, b in zip(rows, rows[1:]) if a[1][:1] + b[1][:1] not in ("su", "ua", "au"))
        cost, audit = cheapest([(r, f) for (_, r, _), f in zip(rows, faults)])
        fixed = repaired([(r, x) for _, r, x in rows], audit)
        digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in fixed).encode()).hexdigest()
        out[c] = (gaps, faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED), illegal, cost, audit, digest)
    return out


def test_query_against_python(spark, tmp_path):
    dice = random.Random(5)
    rows = []
    for c in list(range(40)) + [None]:
        for t in range(dice.randint(1, 9)):
            rows.append((c, dice.choice([t, t, None]) if c == 3 else t, dice.choice(["user", "assistant", "system", None]), dice.choice(["Hi.", "ok", None, "  ", "Why?", "Hi."])))
    rows.append((7, 2, "user", "extra column clash"))
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("audit", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("x")).write.parquet(f"{path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r)[1:] for r in op12_conversation_repair(spark, path).collect()}
    want = slow_query(rows)
    assert set(got) == {r[0] for r in rows}
    for c in got:
        assert got[c] == want.get(c, (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())), c


def test_empty_and_plain_repair(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair(empty).count() == 0 and damaged(empty).count() == 0


def test_query_on_given_table(spark, sf_dir):
    got = op12_conversation_repair(spark, sf_dir)
    n = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct().count()
    assert got.count() == n and got.where("cost < 0").count() == 0
