"""Chat repair: least cost against all ways of short conversations, blocks against whole ones, given data."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from crowdpulse.llm import chat
from crowdpulse.llm.queries import QUERIES


def legal(roles):
    return all(p in chat.NEXT for p in zip([0, *roles], roles))


def way_cost(labels, way):
    """Cost of a way, and the roles of the turns it leaves."""
    roles, total = [], 0.0
    for given, (role, action, inserted) in zip(labels, way):
        total += chat.cost(given, role) + (0.0, chat.MERGE, chat.INSERT)[action]
        if action == 1:
            assert roles and roles[-1] == role
        else:
            roles += [inserted, role] if action == 2 else [role]
    return total, roles


@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_least_cost_over_all_ways(n):
    options = [(r, a, i) for r in (1, 2, 3) for a, i in ((0, 0), (1, 0), (2, 2), (2, 3))]
    for labels in itertools.product(range(4), repeat=n):
        best = float("inf")
        way = chat.repaired(list(labels), 0)
        total, roles = way_cost(labels, way)
        assert legal(roles)
        if n <= 3:
            for other in itertools.product(options, repeat=n):
                if other[0][1] == 1 or any(b[1] == 1 and a[0] != b[0] for a, b in zip(other, other[1:])):
                    continue
                c, r = way_cost(labels, other)
                if legal(r):
                    best = min(best, c)
            assert total == best
        assert total == chat.matrix(list(labels))[0].min()


def conversations(spark):
    rng = random.Random(2)
    rows = []
    for c in range(60):
        for t in range(rng.choice((1, 2, 3, 8, 40))):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "Human", "tool", None, " GPT "]), f"t{c}.{t}"))
    rows += [(100, t, rng.choice(["user", "assistant"]), f"h{t}") for t in range(900)]  # a hot one
    rows += [(None, 0, "assistant", None), (None, 0, "assistant", None), (101, None, "user", "<|im_end|> x"), (101, 1, "user", "")]
    rows += [(102, 5, "user", "same")] * 30
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), rows


def test_blocks_equal_whole(spark):
    turns, rows = conversations(spark)
    key = lambda r: ((r[1] is None, r[1] or 0), r[2] is not None, r[2] or "")
    want = {}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=key)
        labels = [chat.label(r[2]) for r in own]
        want[c] = (chat.matrix(labels)[0].min(), sorted(r[3] or "" for r in own))
    found = {}
    for block in (chat.BLOCK, 7):
        out = {}
        for r in chat.render(turns, block).orderBy("position").collect():
            out.setdefault(r.conv_id, []).append(r)
        assert set(out) == set(want)
        for c, got in out.items():
            text = "".join(r.rendered for r in got)
            heads = [h.split("\n")[0] for h in text.split(chat.OPEN)[1:]]
            assert legal([chat.ROLES.index(h) for h in heads])
            assert text.count(chat.OPEN) == text.count(chat.CLOSE) and text.endswith(chat.CLOSE + "\n")
            assert len({r.position for r in got}) == len(got)
            unknown = sum(r.relabelled for r in got)
            inserts, merges = (sum(r.action == a for r in got) for a in ("insert", "merge"))
            least = want[c][0]
            assert inserts * chat.INSERT + merges * chat.MERGE + unknown * chat.UNKNOWN <= least + 1e-9
            assert sum(r.action != "insert" for r in got) == len(want[c][1])
        found[block] = {c: "".join(r.rendered for r in got) for c, got in out.items()}
    assert found[7] == found[chat.BLOCK]
    assert found[7][102] == "<|im_start|>user\n" + "\n".join(["same"] * 30) + "<|im_end|>\n"
    assert found[7][101] == "<|im_start|>user\n\n< |im_end|> x<|im_end|>\n"
    assert chat.render(turns.where(F.lit(False))).count() == 0


def test_legal_conversations_stay(spark):
    d = "/root/testdata/sf0.01"
    given = {}
    for r in spark.read.parquet(f"{d}/conversations.parquet").orderBy("conv_id", "turn").collect():
        given.setdefault(r.conv_id, []).append((r.role, r.text))
    got = {}
    for r in QUERIES["op8_chat_formatting"](spark, d).orderBy("conv_id", "position").collect():
        got.setdefault(r.conv_id, []).append(r)
    assert set(got) == set(given)
    for c, turns in given.items():
        assert legal([chat.ROLES.index(r) for r, _ in turns])
        text = "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in turns)
        assert "".join(r.rendered for r in got[c]) == text
