"""Role repair against a search over whole conversations."""

import random
from collections import defaultdict

from marketloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, block string"


def cheapest(roles):
    """Least total cost, by a plain dynamic program over the whole conversation."""
    costs = {chat.START: 0}
    for role in roles:
        then = {}
        for c, s, t, _ in chat.STEPS[chat.ROLES.index(role) if role in chat.ROLES else -1]:
            if s in costs:
                then[t] = min(then.get(t, 10**9), costs[s] + c)
        costs = then
    return min(c + chat.INSERT * len(chat.closing(s)) for s, c in costs.items())


def spent(rows):
    price = {"keep": 0, "merge": chat.MERGE, "relabel": chat.RELABEL, "insert": chat.INSERT}
    # A merged turn whose role differs was relabelled too.
    return sum(price[r.action] + (chat.RELABEL if r.action == "merge" and r.given != r.role else 0) for r in rows)


def legal(roles):
    state = chat.START
    for r in roles:
        if chat.ROLES.index(r) not in chat.NEXT[state]:
            return False
        state = chat.ROLES.index(r)
    return state in (chat.START, chat.FINAL)


def check(spark, conversations):
    rows = [(c, t, r, x, "clash") for c, turns in conversations.items() for t, r, x in turns]
    out = chat.repaired(spark.createDataFrame(rows, SCHEMA)).collect()
    found = defaultdict(list)
    for r in out:
        found[r.conv_id].append(r)
    for c, turns in conversations.items():
        own = sorted(found[c], key=lambda r: (r.at, r.action != "insert", -ord(r.role[0])))
        order = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or "", t[2] or ""))
        assert [(r.turn, r.given, r.text) for r in own if r.action != "insert"] == [(t, r, x or "") for t, r, x in order]
        assert legal([r.role for r in own if r.action != "merge"]), (c, own)
        assert spent(own) == cheapest([t[1] for t in order])
    return out


def test_small_cases(spark):
    check(spark, {
        1: [(0, "user", "a"), (1, "assistant", "b")],
        2: [(0, "assistant", "a")],
        3: [(0, "user", "a"), (1, "user", "b"), (2, "user", None)],
        4: [(0, "system", "s")],
        5: [(0, "user", "a"), (1, "system", "s"), (2, "assistant", "b"), (2, "assistant", "b")],
        6: [(None, None, None), (3, "tool", "x"), (-7, "assistant", "y" * 100_000)],
        None: [(0, "user", "q")],
    })


def test_long_and_random_conversations(spark):
    rng = random.Random(4)
    roles = [*chat.ROLES, None, "tool"]
    check(spark, {c: [(t, rng.choice(roles), f"t{t}") for t in range(n)] for c, n in enumerate([1, 2, 3, 5, 17, 300, 1500])})


def test_blocks_render_as_one_text(spark):
    rng = random.Random(5)
    turns = [(t, rng.choice(chat.ROLES), f"t{t}") for t in range(700)]
    repaired = chat.repaired(spark.createDataFrame([(1, t, r, x, "") for t, r, x in turns], SCHEMA))
    text = "".join(r.rendered for r in chat.rendered(repaired).orderBy("block").collect())
    rows = sorted(repaired.collect(), key=lambda r: (r.at, r.action != "insert", -ord(r.role[0])))
    want, body = "", None
    for r in rows:
        if r.action == "merge":
            body = (body[0], body[1] + "\n" + r.text)
            continue
        want += chat.TEMPLATE.format(role=body[0], text=body[1]) if body else ""
        body = (r.role, r.text)
    assert text == want + chat.TEMPLATE.format(role=body[0], text=body[1])


def test_empty(spark):
    assert chat.rendered(chat.repaired(spark.createDataFrame([], SCHEMA))).count() == 0
