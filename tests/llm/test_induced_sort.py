"""Operator 9 against brute force."""

import hashlib
import random

import numpy as np
import pytest

from tests.llm.cases import SCHEMA, documents
from tidemark.llm import induced_sort as st


@pytest.mark.parametrize("held", [1 << 20, 5])
@pytest.mark.parametrize("seed", range(6))
def test_suffixes_are_in_order(seed, held):
    rng = random.Random(seed)
    data = [rng.choice([1, 2, 3][: 1 + seed % 3]) for _ in range(rng.randint(0, 300))] + [0]
    if seed == 5:
        data = [1, 2, 1, 3] * 80 + [0]
    text = np.array(data, np.int16)
    got = np.concatenate(list(st.suffix_order(text, 500, 4, held)))[::-1]
    assert got.tolist() == sorted(range(len(data)), key=lambda i: data[i:])


@pytest.mark.parametrize("seed", range(4))
def test_equal_windows_are_grouped(seed):
    rng = random.Random(seed)
    segments = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 40))) for _ in range(20)] + [b"\xff" * 20, b"\xff" * 15, b"\x00" * 12]
    got = {}
    for group, place in st.repeated(segments, 8, held=10):
        for g, p in zip(group.tolist(), place.tolist()):
            got.setdefault(g, set()).add(p)
    wanted, base = {}, 0
    for s in segments:
        for i in range(len(s) - 7):
            wanted.setdefault(s[i : i + 8], set()).add(base + i)
        base += len(s) + 1
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in wanted.values() if len(x) > 1)


def plain(rows, width):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] or ""))
    seen, out = set(), [None] * len(rows)
    for i in order:
        data = (rows[i][1] or "").encode()
        drop = np.zeros(len(data), bool)
        for p in range(len(data) - width + 1):
            if data[p : p + width] in seen:
                drop[p : p + width] = True
            seen.add(data[p : p + width])
        spans = int((np.diff(np.r_[0, drop.astype(int)]) == 1).sum())
        kept = bytes(x for x, d in zip(data, drop) if not d)
        out[i] = (str(rows[i][0]), len(data), int(drop.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def planted(seed):
    rng = random.Random(seed)
    rows = [list(r) for r in documents(seed)]
    passages = ["".join(rng.choice("abcdefgh äö") for _ in range(rng.randint(60, 400))) for _ in range(6)]
    for i in range(0, len(rows), 2):
        if rows[i][1]:
            cut, passage = rng.randint(0, len(rows[i][1])), rng.choice(passages)
            begin = rng.randint(0, 30)
            rows[i][1] = rows[i][1][:cut] + passage[begin : len(passage) - rng.randint(0, 30)] + rows[i][1][cut:]
    rows.append([2000, "xy" * 400, *rows[0][2:]])
    rows.append([2001, "z" + "xy" * 300 + "é" * 200, *rows[0][2:]])
    rng.shuffle(rows)
    return [tuple(r) for r in rows]


@pytest.mark.parametrize(("seed", "width", "gram", "chunk"), [(1, 100, 32, 1 << 20), (2, 100, 32, 700), (3, 20, 8, 1 << 20)])
def test_removal_equals_brute_force(spark, monkeypatch, seed, width, gram, chunk):
    monkeypatch.setattr(st, "CHUNK", chunk)
    st._powers.cache_clear()
    rows = planted(seed)
    got = st.remove_repeats(spark.createDataFrame(rows, SCHEMA), width=width, gram=gram).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(plain(rows, width))
    assert {r.doc_id for r in got if r.text is None} >= {r[0] for r in rows if r[1] is None}
    for r in got:
        if r.text is not None:
            assert 0 <= len(r.text.encode()) - (r.n_bytes - r.n_removed) <= 6 * r.n_spans


def test_empty_table(spark):
    got = st.remove_repeats(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns[-4:] == ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    with pytest.raises(ValueError):
        st.remove_repeats(got, gram=100)
