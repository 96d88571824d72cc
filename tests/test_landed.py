"""Folder loads by manifest: new and changed files only, each stored once."""

import os

from opinio.sources import articles as A
from opinio.sources import landed as L


def put(folder, name, data, at):
    p = os.path.join(folder, name)
    with open(p, "wb") as f:
        f.write(data)
    os.utime(p, (at, at))


def stored(spark, store):
    return {r["file_name"]: r["raw"] for r in L.stored_articles(spark, store).collect()}


def test_loads_take_new_and_changed_files_only(spark, tmpdir_fresh):
    folder, store = os.path.join(tmpdir_fresh, "in"), os.path.join(tmpdir_fresh, "store")
    os.makedirs(folder)
    for i in range(5):
        put(folder, f"a {i}+x.txt", f" body {i}\n".encode(), 1000 + i)
    put(folder, "skip.md", b"no article", 1000)
    assert L.load_landed(spark, folder, store, "1", parts=4) == 5
    assert stored(spark, store) == {f"a {i}+x.txt": f" body {i}\n" for i in range(5)}
    assert L.load_landed(spark, folder, store, "2", parts=4) == 0          # nothing new
    put(folder, "new.txt", b"bad \xff byte", 2000)
    put(folder, "old.txt", b"old", 10)                                     # copied in with an old time
    put(folder, "a 1+x.txt", b"changed", 2001)
    paths = {os.path.basename(r["file_path"]) for r in L.new_files(spark, folder, store).collect()}
    assert paths == {"new.txt", "old.txt", "a 1+x.txt"}
    assert L.load_landed(spark, folder, store, "3", parts=4) == 3
    want = {f"a {i}+x.txt": f" body {i}\n" for i in range(5)} | {"new.txt": "bad � byte", "old.txt": "old", "a 1+x.txt": "changed"}
    assert stored(spark, store) == want
    put(folder, "late.txt", b"late", 3000)
    assert L.load_landed(spark, folder, store, "3", parts=4) == 0          # this load ended before
    assert L.load_landed(spark, folder, store, "4", parts=4) == 1 and stored(spark, store) == want | {"late.txt": "late"}


def test_stored_articles_equal_the_scan(spark, tmpdir_fresh):
    folder, store = os.path.join(tmpdir_fresh, "in"), os.path.join(tmpdir_fresh, "store")
    os.makedirs(folder)
    assert L.load_landed(spark, folder, store, "0") == 0                   # no file yet
    for i, data in enumerate([b"  one \xff\xfe two ", "ü\nx".encode(), b""]):
        put(folder, f"t {i}%.txt", data, 1000)
    L.load_landed(spark, folder, store, "1", parts=2)
    cols = ["file_name", "title", "content", "type"]
    for tolerant in (False, True):
        scan = A.scan_articles(spark, folder, tolerant).select(*cols).collect()
        assert sorted(map(tuple, L.stored_articles(spark, store, tolerant).select(*cols).collect())) == [
            (n, t, c.encode("utf-8", "replace").decode(), k) for n, t, c, k in sorted(map(tuple, scan))]


def test_a_load_lists_without_reading_and_filters_by_time(spark, tmpdir_fresh):
    folder = os.path.join(tmpdir_fresh, "in")
    os.makedirs(folder)
    put(folder, "a.txt", b"x", 1000)
    plan = L.listing(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    late = L._files(spark, folder, "*.txt").where("modificationTime >= timestamp'2020-01-01'")
    assert "PushedFilters: [IsNotNull(modificationTime), GreaterThanOrEqual(modificationTime" in late._jdf.queryExecution().executedPlan().toString()
