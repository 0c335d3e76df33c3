"""Operator 4 on messages that quote each other."""

import random

import pytest

from tidemark.llm import quote_threads as qt

SCHEMA = "conv_id BIGINT, turn INT, role STRING, text STRING, row STRING, parent STRING"


def test_nested_quotes_are_parsed():
    text = "Hi all,\nOn Monday, Ann wrote:\n> second line\n>> first line\n> > still first\n> back\nMy answer.\n  > indented\nEnd"
    own, passages = qt.parse(text)
    assert own == "Hi all,\nMy answer.\nEnd"
    assert passages == [(1, "second line"), (2, "first line\nstill first"), (1, "back"), (1, "indented")]
    assert qt.parse("no quote\nhere") == ("no quote\nhere", [])
    assert qt.parse("") == ("", [])
    assert qt.normal("  Ein  TEST, ok?\n") == "ein test ok"


def naive(rows):
    """Parents by brute force; rows are in order of (conv, turn)."""
    parsed = [qt.parse(r[3] or "") for r in rows]
    own = [set(qt.hashes_of(p[0])) for p in parsed]
    out = []
    for i, r in enumerate(rows):
        best = None
        for q in qt.quote_hashes(parsed[i][1]):
            near = [j for j in range(i) if rows[j][0] == r[0] and q["hash"] in own[j]]
            far = [j for j in range(i) if q["hash"] in own[j]]
            if near or far:
                found = (-q["level"], bool(near), q["size"], near[-1] if near else far[0])
                best = max(best, found) if best else found
        before = i - 1 if i and rows[i - 1][0] == r[0] else None
        out.append((best[3] if best else before, best is not None))
    return out


def messages(seed):
    rng = random.Random(seed)
    lines = [f"line {rng.randint(0, 60)} of {rng.choice('abc')}" for _ in range(40)]
    rows = []
    for conv in range(8):
        for turn in range(rng.randint(1, 9)):
            text = "\n".join(rng.choice(lines) for _ in range(rng.randint(1, 4)))
            if rows and rng.random() < 0.6:
                said = rng.choice(rows)[3] or ""
                quoted = rng.choice([said, said.split("\n")[0]])
                text = "Ann wrote:\n" + "\n".join("> " + x for x in quoted.upper().split("\n")) + "\n" + text
            rows.append((conv, turn * 3, "user", rng.choice([text] * 9 + [None, ""]), "x", "y"))
    return rows


@pytest.mark.parametrize(("seed", "span"), [(1, 10), (2, 1)])
def test_threads_equal_brute_force(spark, monkeypatch, seed, span):
    monkeypatch.setattr(qt, "SPAN_BITS", span)
    rows = messages(seed)
    got = {(r.conv_id, r.turn): r for r in qt.link_quotations(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    links = naive(rows)
    assert any(linked and rows[p][0] != rows[i][0] for i, (p, linked) in enumerate(links))
    for i, (parent, linked) in enumerate(links):
        r, above, depth = got[rows[i][0], rows[i][1]], i, 0
        assert r.linked == linked
        assert (r.parent_conv, r.parent_turn) == (rows[parent][:2] if parent is not None else (None, None))
        while links[above][0] is not None:
            above, depth = links[above][0], depth + 1
        assert (r.thread_conv, r.thread_turn, r.depth) == (*rows[above][:2], depth)
        assert r.text is None if rows[i][3] is None else ">" not in r.text
        if parent is not None:
            assert got[rows[parent][0], rows[parent][1]].reply_no < r.reply_no
    threads = {}
    for r in got.values():
        threads.setdefault((r.thread_conv, r.thread_turn), []).append(r.reply_no)
    assert all(sorted(x) == list(range(1, len(x) + 1)) for x in threads.values())


def test_awkward_rows(spark):
    rows = [(None, None, None, None), (None, 1, "a", "hello"), (1, 0, "a", "x\n" * 5000), (1, 0, "a", "x\n" * 5000), (1, None, "b", "> nothing\nleft"), (2, 5, "u", "> > >")]
    got = qt.link_quotations(spark.createDataFrame(rows, "conv_id BIGINT, turn INT, role STRING, text STRING")).collect()
    assert len(got) == len(rows)
    assert {r.text for r in got if r.conv_id == 1 and r.turn is None} == {"left"}
    assert sorted(r.reply_no for r in got if r.thread_conv == 1) == [1, 2, 3]
    assert qt.link_quotations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_a_hot_thread_is_numbered_span_by_span(spark):
    """A third of all messages in one thread, some of equal turns, and one without a conversation."""
    rows = [(7, i // 2 if i % 3 else i, "u", f"hot message {i}") for i in range(3000)] + [(None, i, "u", f"nowhere {i}") for i in range(1500)]
    rows += [(100 + i, t, "u", f"{i} and {t}") for i in range(900) for t in range(5)]
    got = qt.link_quotations(spark.createDataFrame(rows, "conv_id BIGINT, turn INT, role STRING, text STRING"))
    seen = {}
    for r in got.select("thread_conv", "turn", "reply_no").collect():
        seen.setdefault(r.thread_conv, []).append((r.reply_no, r.turn))
    assert len(seen) == 902 and len(seen[7]) == 3000 and len(seen[None]) == 1500
    for numbered in seen.values():
        numbered.sort()
        assert [n for n, _ in numbered] == list(range(1, len(numbered) + 1))
        assert [t for _, t in numbered] == sorted(t for _, t in numbered)
