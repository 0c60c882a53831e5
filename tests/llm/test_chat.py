"""The prefix tree of conversations, read back by turns and by attention intervals."""

import hashlib
import random
from collections import defaultdict

from jsonloom.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def tree_rows(draw):
    rows, opening = [], [("system", "be kind"), ("user", 'hi </turn> <turn role="user">')]
    for c in range(40):
        turns = list(opening[: draw.choice([0, 1, 2, 2])])
        for _ in range(draw.randrange(0 if turns else 1, 5)):
            turns.append((draw.choice(["user", "assistant"]), draw.choice(["yes", "no", "\\", "é\n", ""])))
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(100, 0, None, None), (100, None, "assistant", "first"), (101, 1, "assistant", "twin"), (101, 1, "assistant", "twin"), (None, 0, "user", "no id")]
    rows += [(200, i, "assistant", "z" * 300) for i in range(200)]
    return rows


def conversations(rows):
    out = defaultdict(list)
    for c, turn, role, text in rows:
        out[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in out.items()}


def test_escapes():
    for text in ["", "\\", "</turn>", '<turn role="x">', '\\### Assistant: </turn> ok', "a\nb\\", '"']:
        whole, a, b = chat.formatted(text, text)
        assert chat.parsed(whole) == (text, text) and chat.unescaped(whole[a:b]) == text
        assert whole.count("</turn>") == 1


def test_read_back(spark):
    rows = tree_rows(random.Random(1))
    got = {r.conv_id: r for r in chat.chat_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = conversations(rows)
    assert set(got) == set(want)
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        r = got[c]
        assert r.n_turns == len(turns) and r.loss_chars == len(loss) and r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat.formatted(*t)[0]) for t in turns)


def test_tree_is_depth_first_and_shares(spark):
    rows = tree_rows(random.Random(2))
    tree = chat.prefix_tree(spark.createDataFrame(rows, SCHEMA))
    sections, nodes = tree.sections.collect(), tree.turns.collect()
    want = {c if c is not None else chat.NO_ID: [chat.formatted(*t)[0] for t in turns] for c, turns in conversations(rows).items()}
    prefixes = {tuple(t[: i + 1]) for t in want.values() for i in range(len(t))}
    assert len(nodes) == len(prefixes)  # shared turns once
    sequences = defaultdict(str)
    for n in sorted(nodes, key=lambda n: (n.tree, n.offset)):
        assert n.offset == len(sequences[n.tree])  # gapless
        sequences[n.tree] += n.formatted
    for s in sections:
        sequence = sequences[s.tree]
        seen = "".join(sequence[a.start : a.end] for a in s.ancestors) + sequence[s.offset : s.offset + s.length]
        assert seen == "".join(want[s.conv]) and s.position == sum(a.end - a.start for a in s.ancestors)
        assert all(a.end <= s.offset for a in s.ancestors)
    ended = {s.conv for s in sections}
    for c, turns in want.items():  # without a section only if a smaller id has all of it
        assert c in ended or any(d < c and want[d][: len(turns)] == turns for d in want)


def test_odd_tables(spark):
    assert chat.chat_report(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = spark.createDataFrame([(1, 0, "user", "a", 3, "x")], SCHEMA + ", idx int, chain string")
    assert [r.n_turns for r in chat.chat_report(clash).collect()] == [1]
