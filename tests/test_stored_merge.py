"""K1 / K5 against a stored table: copy on write, replays, broken-off loads."""

import glob
import os
import random

from opinio.sinks import merge as MG


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "k string, src string, n int, born int, seen int")


def stored(spark, path):
    return sorted(tuple(r) for r in MG.read_stored(spark, path, rows_of(spark, []).schema).collect())


def files(path):
    return set(glob.glob(os.path.join(path, "_part=*", "*.parquet")))


def test_upsert_keeps_first_values_and_untouched_files(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "t")
    first = [(f"k{i}", "all", i, 1, 1) for i in range(300)]
    assert MG.merge_into(rows_of(spark, first), path, ["k", "src"], "a", first_wins=("born",))
    before = files(path)
    assert MG.merge_into(rows_of(spark, [("k7", "all", 70, 2, 2), ("new", "all", 1, 2, 2)]), path, ["k", "src"], "b", first_wins=("born",))
    after = files(path)
    assert len(before - after) <= 2 and len(before & after) >= len(before) - 2          # only the touched parts
    want = {r[0]: r for r in first} | {"k7": ("k7", "all", 70, 1, 2), "new": ("new", "all", 1, 2, 2)}
    assert stored(spark, path) == sorted(want.values())


def test_replayed_and_broken_off_loads_change_nothing(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "t")
    a, b = rows_of(spark, [("x", "s", 1, 1, 1), ("y", "s", 2, 1, 1)]), rows_of(spark, [("x", "s", 5, 2, 2), (None, "s", 3, 2, 2), (None, "s", 3, 2, 2)])
    assert MG.merge_into(a, path, ["k", "src"], "a", ("born",)) and MG.merge_into(b, path, ["k", "src"], "b", ("born",))
    once, names = sorted(map(str, MG.read_stored(spark, path, a.schema).collect())), files(path)
    assert not MG.merge_into(b, path, ["k", "src"], "b", ("born",)) and files(path) == names          # its id ended: nothing is read or written
    assert MG.merge_into(b, path, ["k", "src"], "b, log lost", ("born",))                            # as after a crash before the log
    assert sorted(map(str, MG.read_stored(spark, path, a.schema).collect())) == once and len(once) == 3
    assert MG.loads(spark, path).count() == 3
    assert MG.merge_into(a.where("false"), path, ["k", "src"], "empty", ("born",)) and len(once) == MG.read_stored(spark, path, a.schema).count()


def test_append_adds_only_new_keys(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "t")
    r = random.Random(2)
    want = {}
    for load in range(4):
        rows = [(f"k{r.randrange(60)}", "s", load, load, i) for i in range(40)]
        for k in {x[0] for x in rows}:
            want.setdefault(k, max(x for x in rows if x[0] == k))
        MG.merge_into(rows_of(spark, rows), path, ["k", "src"], f"load {load}", update=False, parts=8)
    assert stored(spark, path) == sorted(want.values())
