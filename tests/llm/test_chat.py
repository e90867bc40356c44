import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roamrank.llm import chat_tree
from tests.llm.fixtures import words

SCHEMA = "conv_id bigint, turn bigint, role string, text string, segment string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def expected(rows):
    out = {}
    for conv_id, turn, role, text in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv_id, []).append((role or "", text or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return {
        i: (
            len(turns),
            sha("".join(f"{r}\n{t}\n" for r, t in turns)),
            sum(len(t) for r, t in turns if r == "assistant"),
            sha("".join(t for r, t in turns if r == "assistant")),
            sum(len(chat_tree.written(r, t)) for r, t in turns),
        )
        for i, turns in out.items()
    }


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    starts = [words(rng, 20) for _ in range(4)]
    rows = []
    for i in range(120):
        rows.append((i, 0, "user", starts[i % 4] if i % 3 else starts[0]))
        for t in range(1, rng.randrange(1, 7)):
            role = "assistant" if t % 2 else "user"
            rows.append((i, t, role, f"reply {rng.randrange(3)}" if rng.random() < 0.7 else words(rng, 12)))
    rows += [(500 + i, t, "user", f"copied {t}") for i in range(30) for t in range(3)]
    rows += [(600, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(700)]  # several segments
    rows += [(601, 0, "user", "x" * 250_000), (601, 1, "assistant", "<" * 1000)]
    rows += [(700, None, "user", "last"), (700, 1, None, None), (700, 1, None, None), (700, 0, "assistant", "")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "\\### Assistant: </turn> ok <turn user>\\l\\\\g\n")]
    rows += [(701, 0, "assi<stant>", "odd role")]
    return rows


def test_read_back(spark, rows, monkeypatch):
    monkeypatch.setattr(chat_tree, "PACK", 3000)
    packed = chat_tree.packs(frame(spark, rows), partitions=3)
    got = {r["conv_id"]: tuple(r)[1:] for r in chat_tree.digests(packed).collect()}
    assert got == expected(rows)
    assert chat_tree.digests(packed).count() == len(got)


def test_shared_turns_stand_once(spark, rows):
    some = [r for r in rows if r[0] is not None and r[0] < 600]
    packed = chat_tree.packs(frame(spark, some), partitions=1).collect()
    prefixes = set()
    by_conv = {}
    for conv_id, _, role, text in sorted(some, key=lambda r: (r[0], r[1])):
        path = by_conv.setdefault(conv_id, ()) + ((role, text),)
        by_conv[conv_id] = path
        prefixes.add(path)
    written = sum(len(chat_tree.written(*path[-1])) for path in prefixes)
    assert sum(len(p["text"]) for p in packed) == written
    assert sum(len(p["nodes"]) for p in packed) == len(prefixes)


def test_positions_and_intervals(spark, rows):
    """A node begins where its ancestors end, and a conversation's intervals are its path."""
    some = [r for r in rows if r[0] is not None and r[0] < 600]
    for p in chat_tree.packs(frame(spark, some)).collect():
        nodes = p["nodes"]
        for node in nodes:
            up, length = node["parent"], 0
            while up >= 0:
                length += nodes[up]["end"] - nodes[up]["begin"]
                assert nodes[up]["end"] <= node["begin"]  # ancestors come first
                up = nodes[up]["parent"]
            assert node["position"] == length
        for c in p["conversations"]:
            ends = [i["end"] for i in c["intervals"]]
            starts = [i["begin"] for i in c["intervals"]]
            assert all(a < b for a, b in zip(starts, ends)) and all(e < s for e, s in zip(ends, starts[1:]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="\\<>lgturn/ a\n", max_size=9), st.text(alphabet="\\<>lgturn/ é\n", max_size=30))))
def test_template_is_reversible(turns):
    formatted = "".join(chat_tree.written(r, t) for r, t in turns)
    assert [(r, t) for r, t, _, _ in chat_tree.turns(formatted)] == turns
    learnt = "".join(t for r, t in turns if r == chat_tree.LEARN)
    mask = chat_tree.loss_mask(formatted)
    assert chat_tree.unescape("".join(c for c, m in zip(formatted, mask) if m)) == learnt


def test_empty_table(spark, rows):
    packed = chat_tree.packs(frame(spark, rows).limit(0))
    assert packed.count() == 0 and chat_tree.digests(packed).count() == 0


def paths(rows):
    """Each conversation's turns as written, and all prefixes of turns."""
    out = {}
    for conv_id, _, role, text in sorted(rows, key=lambda r: (r[0], r[1])):
        out[conv_id] = (*out.get(conv_id, ()), chat_tree.written(role, text))
    return out, {p[: i + 1] for p in out.values() for i in range(len(p))}


def turn_rows(conv_id, *texts):
    return [(conv_id, t, "assistant" if t % 2 else "user", text) for t, text in enumerate(texts)]


def check_trees(packed, rows):
    """Nodes stand once, and what a token may attend to is all of its conversation up to it."""
    whole, prefixes = paths(rows)
    assert sum(len(p["nodes"]) for p in packed) == len(prefixes)
    assert sum(len(p["text"]) for p in packed) == sum(len(p[-1]) for p in prefixes)
    text_of = {p["pack"]: p["text"] for p in packed}
    above = {p["pack"]: p["above"] for p in packed}
    assert len(text_of) == len(packed)
    cut = lambda text, intervals: "".join(text[i["begin"] : i["end"]] for i in intervals)
    seen = {}
    for p in packed:
        led = chat_tree.lineage(above, p["pack"])
        before = "".join(cut(text_of[a["pack"]], a["intervals"]) for a in led)
        roots = {n["position"] for n in p["nodes"] if n["parent"] < 0}
        assert roots == {len(before)}
        for c in p["conversations"]:
            upto = before + cut(p["text"], c["intervals"])
            assert len(led) == c["segment"]
            for i in c["ids"]:
                assert "".join(whole[i]).startswith(upto)
                seen[i] = max(seen.get(i, ""), upto, key=len)
    assert seen == {i: "".join(w) for i, w in whole.items()}


def test_long_conversations_share_turns(spark):
    """Two share 300 turns, of which 44 are in the second segment; two others are copies of 700."""
    shared = [f"said {t}" for t in range(300)]
    rows = turn_rows(1, *shared, *(f"one {t}" for t in range(400))) + turn_rows(2, *shared, *(f"two {t}" for t in range(300)))
    rows += turn_rows(3, *(f"turn {t}" for t in range(700))) + turn_rows(4, *(f"turn {t}" for t in range(700)))
    rows += turn_rows(5, *shared[:299]) + turn_rows(6, "short", "one")
    rows += turn_rows(7, "x" * 150_000, "y", "z" * 150_000, "end") + turn_rows(8, "x" * 150_000, "y", "z" * 150_000, "other")
    packed = chat_tree.packs(frame(spark, rows), partitions=1)
    check_trees(packed.collect(), rows)
    assert {r["conv_id"]: tuple(r)[1:] for r in chat_tree.digests(packed).collect()} == expected(rows)


def test_deep_branches_are_in_depth_first_order(spark):
    """Conversations that share more turns than the 64 that order was once known by."""
    shared = [f"said {t}" for t in range(100)]
    rows = []
    for i in range(24):
        rows += turn_rows(i, *shared, f"branch {i % 3}", f"twig {i % 6}", *(f"leaf {i}" for _ in range(i % 2)))
    check_trees(chat_tree.packs(frame(spark, rows), partitions=1).collect(), rows)


def test_references_grow_with_segments(spark):
    """A conversation of n segments has n - 1 references, its copies none of their own."""
    for n in (10, 20, 40):
        texts = [f"turn {t}" for t in range(n * chat_tree.SEGMENT_TURNS)]
        rows = turn_rows(1, *texts) + turn_rows(2, *texts)
        packed = chat_tree.packs(frame(spark, rows), partitions=1).collect()
        assert sum(p["above"] is not None for p in packed) == n - 1
        assert sum(len(c["intervals"]) for p in packed for c in p["conversations"]) == n
        assert [list(c["ids"]) for p in packed for c in p["conversations"]] == [[1, 2]] * n


def test_packs_are_bounded_where_a_third_of_all_are_copies(spark, monkeypatch):
    monkeypatch.setattr(chat_tree, "HELD", 50)
    rows = [r for i in range(300) for r in turn_rows(i, "same", "answer")]
    rows += [r for i in range(300, 900) for r in turn_rows(i, f"own {i % 200}", f"answer {i}")]
    rows += [(None, 0, "user", "same"), (None, 1, "assistant", "answer")]
    table = chat_tree.packs(frame(spark, rows), partitions=2)
    packed = table.collect()
    for p in packed:
        held = p["conversations"]
        assert sum(len(c["ids"]) for c in held) <= 50
        assert sum(len(c["ids"]) + len(c["intervals"]) for c in held) <= 50 + 3
    copies = [c for p in packed for c in p["conversations"] if c["ids"][0] < 300 and c["known"]]
    assert sorted(i for c in copies for i in c["ids"]) == list(range(300)) and len(copies) <= 300 / 49 + 2
    assert {r["conv_id"]: tuple(r)[1:] for r in chat_tree.digests(table).collect()} == expected(rows)


def test_equal_conversations_are_cut_a_few_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(chat_tree, "CUT_CHARS", 100)
    rows = [r for i in range(40) for r in turn_rows(i, "same " * 5, "answer")]
    got = {r["conv_id"]: tuple(r)[1:] for r in chat_tree.digests(chat_tree.packs(frame(spark, rows))).collect()}
    assert got == expected(rows)
