"""Matching of titles: what travels between tasks and to the driver stays bounded, and the pairs are the same."""

import random
import re

from opinio.operators import matching as M
from test_scale_r03 import VOCAB, _frames, _similar, _titles, plan_of


# ----------------------------------------- F2 -------------------------------------------

def _strings(seed):
    r = random.Random(seed)
    bits = ["a", "b", "ab", "ba", " ", " ", "  ", "\n", "é", "the", "x1", ""]
    make = lambda most: "".join(r.choice(bits) for _ in range(r.randint(0, most)))
    ys = [*dict.fromkeys([make(30) for _ in range(150)] + ["a b a b a b ab the x1", "the the the the the the", " a b ", ""])]
    xs = [make(9) for _ in range(150)] + [y[r.randrange(len(y) + 1):][:r.randint(1, 25)] for y in ys if y] + [None, "a b a", "the the the"]
    return [*dict.fromkeys(xs)], ys


def test_answers_bring_the_piece_that_a_probe_can_lie_in(spark, monkeypatch):
    xs, ys = _strings(11)
    x, y = spark.createDataFrame(list(enumerate(xs)), "x_id long, x_str string"), spark.createDataFrame(list(enumerate(ys)), "y_id long, y_str string")
    want = [(i, j) for i, a in enumerate(xs) for j, b in enumerate(ys) if a is not None and a in b]
    for few, slots in ((100_000, 1 << 20), (0, 1 << 20), (0, 1)):           # broadcast; shuffled; by a bitmap that keeps nearly all
        monkeypatch.setattr(M, "BROADCAST_KEYS", few)
        monkeypatch.setattr(M, "SLOTS", slots)
        found = M.contained_titles(x, y)
        assert "instr(y_str" not in plan_of(found)
        assert sorted((p["x_id"], p["y_id"]) for p in found.collect()) == want, (few, slots)


def test_repeated_rows_and_words_in_them(spark):
    a, r = _frames(spark, ["a b c d e", "b c d"] * 2 + ["Zz"], ["x a B c d e f", "c", "zz"])
    a = a.unionByName(a.where("a_id = 0"))
    want = [(0, 0), (0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (2, 1), (3, 0), (3, 1), (4, 2)]
    assert sorted(tuple(p) for p in M.match_containment(a, r).select("a_id", "r_seq").collect()) == want


# --------------------------------------- F1, F3 -----------------------------------------

def test_tables_are_broadcast_by_their_bytes(spark, monkeypatch):
    a, r = _titles(21, 70, VOCAB), [*dict.fromkeys(_titles(22, 60, VOCAB))]
    want = {(i, j) for i, x in enumerate(a) for j, y in enumerate(r) if _similar(x, y)}
    monkeypatch.setattr(M, "BROADCAST_BYTES", 0)
    found = M.match_fuzzy(*_frames(spark, a, r))
    assert "NestedLoop" not in plan_of(found)
    got = [tuple(p) for p in found.select("a_id", "r_seq").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_words_travel_without_their_title(spark, monkeypatch):
    plans, write = {}, M.materialise

    def seen(df, name, *rest):
        plans[name] = plan_of(df)
        return write(df, name, *rest)
    monkeypatch.setattr(M, "materialise", seen)
    a, r = _frames(spark, _titles(23, 20, VOCAB), [*dict.fromkeys(_titles(24, 20, VOCAB))])
    M.word_numbers(*M._sides(a, r, M.norm_title))
    assert "Generate" in plans["title-numbers"]
    assert not any(re.search(r"Generate .*\[[^]]*norm#", plan) for plan in plans.values())
