"""Role repair against every way to label and insert."""

import itertools
import random

from adlake.llm import queries
from adlake.llm.chat import ASSISTANT, LEGAL, START, SYSTEM, USER, Costs, fragments, repair, repair_conversations, role_of


def least(c, roles):
    best = 1 << 40
    for labels in itertools.product((SYSTEM, USER, ASSISTANT), repeat=len(roles)):

        def rec(i, state, labels=labels):
            if i == len(roles):
                return c.end(state)[0]
            label, base, ways = labels[i], 0 if labels[i] == roles[i] else c.relabel, []
            if state == label:
                ways.append(base + c.merge + rec(i + 1, label))

            def chain(s, depth):
                for t in LEGAL[s] if depth < 4 else ():
                    if t == label:
                        ways.append(base + c.insert * depth + rec(i + 1, label))
                    chain(t, depth + 1)

            chain(state, 0)
            return min(ways, default=1 << 40)

        best = min(best, rec(0, START))
    return best


def test_least_cost():
    rnd = random.Random(1)
    for _ in range(150):
        c = rnd.choice([Costs(), Costs(5, 1, 1), Costs(1, 1, 1), Costs(9, 2, 4)])
        roles = [rnd.choice([0, 1, 2, 3, 2, 3]) for _ in range(rnd.randint(1, 4))]
        labels, cost = repair(c, roles)
        total = sum(x[2] for x in fragments(c, roles, ["t"] * len(roles), START, None, True))
        assert total == least(c, roles) == cost + c.end(labels[-1])[0]


def test_long_and_odd_conversations(spark):
    rnd = random.Random(4)
    rows = [(1, i, rnd.choice(["user", "assistant", "human", None, "x", "system"]), rnd.choice(["a", "bé", None, ""])) for i in range(600)]
    rows += [(c, i, rnd.choice(["user", "assistant", "system"]), f"t{i}") for c in range(2, 40) for i in range(rnd.randint(1, 9))]
    rows += [(None, None, None, None), (None, 1, "user", "x"), (5, 0, "user", "dup"), (5, 0, "user", "dup"), (6, 99, "user", "w" * 100_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, range int")
    got = repair_conversations(df).collect()
    assert len(got) == len(rows)
    nulls_first = lambda x: (x is not None, x or 0)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (nulls_first(r[1]), r[2] is not None, r[2] or "", r[3] or ""))
        labels, cost = repair(Costs(), [role_of(r[2]) for r in mine])
        done = [r for r in got if r.conv_id == conv]
        assert sum(r.cost for r in done) == cost + Costs().end(labels[-1])[0]
        text = "".join(r.fragment for r in sorted(done, key=lambda r: (nulls_first(r.turn), r.role is not None, r.role or "")))
        assert text.count("<|im_start|>") == text.count("<|im_end|>")
    assert repair_conversations(df.limit(0)).count() == 0


def test_rendered_text(spark):
    rows = [(1, 0, "assistant", "hi"), (1, 1, "user", "a"), (1, 2, "human", "b")]
    got = sorted(repair_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect(), key=lambda r: r.turn)
    text = "".join(r.fragment for r in got)
    m = lambda role, t: f"<|im_start|>{role}\n{t}<|im_end|>\n"
    # Two relabels cost 6; any way with an empty message or a merge costs more.
    assert sum(r.cost for r in got) == 6 == least(Costs(), [ASSISTANT, USER, USER])
    assert text == m("system", "hi") + m("user", "a") + m("assistant", "b")
    assert [r.action for r in got] == ["relabel", "keep", "relabel"]


def test_query_is_legal(spark, sf_small):
    got = queries.QUERIES["op1_role_repair"](spark, sf_small).collect()
    assert len(got) == spark.read.parquet(f"{sf_small}/conversations.parquet").count()
    by = {}
    for r in sorted(got, key=lambda r: (r.conv_id, r.turn)):
        by.setdefault(r.conv_id, []).append(r.fragment)
    for parts in by.values():
        roles = [x.split("\n", 1)[0] for x in "".join(parts).split("<|im_start|>")[1:]]
        roles = roles[1:] if roles[0] == "system" else roles
        assert roles and roles == ["user", "assistant"] * (len(roles) // 2)


def test_labels_do_not_depend_on_ranges(spark):
    rnd = random.Random(9)
    rows = [(1, i, rnd.choice(["user", "assistant", "system", "x"]), "t") for i in range(700)] + [(2, i, r, "t") for i, r in enumerate(["x", "system", "assistant", "assistant"])]
    rows += [(3, i, rnd.choice(["user", "assistant"]), "t") for i in range(200)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = {}
    for conv in (1, 2, 3):
        labels, _ = repair(Costs(), [role_of(r[2]) for r in rows if r[0] == conv])
        want |= {(conv, i): x for i, x in enumerate(labels)}
    names = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (1, 5, 31):
            spark.conf.set("spark.sql.shuffle.partitions", str(parts))
            got = {(r.conv_id, r.turn): r.new_role for r in repair_conversations(df).collect()}
            assert got == {k: names[x] for k, x in want.items()}, parts
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_any_cut_gives_the_labels_of_the_whole():
    from adlake.llm import chat

    rnd = random.Random(10)
    for _ in range(300):
        c = rnd.choice([Costs(), Costs(1, 1, 1), Costs(5, 1, 1)])
        roles = [rnd.choice([0, 1, 2, 3]) for _ in range(rnd.randint(2, 30))]
        whole, _ = repair(c, roles)
        at = rnd.randint(1, len(roles) - 1)
        begin = chat._forward(chat._table(c), roles[:at], chat._only(START))[-1]
        leave = whole[-1]
        entry = chat.entries(c, roles[at:], begin, roles[at - 1])[leave]
        assert repair(c, roles[:at], None, entry)[0] + repair(c, roles[at:], begin, leave, roles[at - 1])[0] == whole
