"""Trees of files: the walk, the data source with its filters, catalogues written with a commit."""

import json
import os

import numpy as np
import pytest
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan, StringStartsWith

from quadrille.plans.catalogue import _SCOPES
from quadrille.sources import folders, textproto, tilesource, volumes, yamlcache

SCOPE = 'fov {{ x_size_um: {} y_size_um: 20 z_size_um: 30 rotation_radians: 0 }} file_prefix: "vol" stack_extension: ".npy" ' + _SCOPES[6].replace("{", "{{").replace("}", "}}")


def tile(folder, x=1, size=10, volume=True):
    os.makedirs(folder)
    with open(f"{folder}/a.acquisition", "w") as f:
        f.write(f"x_mm: {x}\ny_mm: 2\nz_mm: 3\n")
    with open(f"{folder}/a.microscope", "w") as f:
        f.write(SCOPE.format(size))
    if volume:
        np.save(f"{folder}/a-vol.0.npy", np.zeros((4, 5, 6), np.uint16))


@pytest.fixture()
def tree(tmp_path):
    """Three tiles, one without a volume, one with broken metadata, a hidden folder, and a catalogue over folders that must not be listed."""
    root = str(tmp_path / "root")
    tile(f"{root}/a/00001", 1)
    tile(f"{root}/a/00002", 5)
    tile(f"{root}/b/c/00003", 9, volume=False)
    tile(f"{root}/b/00004", 7)
    with open(f"{root}/b/00004/a.microscope", "w") as f:
        f.write("fov {")
    tile(f"{root}/.hidden/00005", 1)
    os.makedirs(f"{root}/empty")
    tile(f"{root}/cached/deep/00006", 1)
    tile(f"{root}/cached/00007", 1)
    with open(f"{root}/cached/x.cache.yml", "w") as f:
        f.write(yamlcache.dump([{"path": f"{root}/cached/00007", "ori": [1, 2, 3], "shape": [4, 5, 6], "dtype": "u8", "dims": [7, 8, 9], "crop": None, "transform": [1.0] * 16}], f"{root}/cached/"))
    with open(f"{root}/a/00001/notes.txt", "w") as f:
        f.write("x")
    return root


def names(rows, root):
    return {r.path[len(root) + 1 :]: r for r in rows}


def test_walk_lists_nothing_below_a_catalogue(spark, tree):
    told = []
    found = {r.dir[len(tree) :]: r for r in folders.walk(spark, f"file://{tree}", progress=lambda *x: told.append(x)).collect()}
    assert {d: r.kind for d, r in found.items()} == {"": "inner", "/a": "inner", "/b": "inner", "/empty": "inner", "/cached": "cache", "/a/00001": "leaf", "/a/00002": "leaf", "/b/00004": "leaf", "/b/c": "inner", "/b/c/00003": "leaf"}
    assert told == [(0, 1, 0), (1, 4, 1), (2, 4, 3), (3, 1, 1)]
    assert len(folders.walk(spark, tree, cached=False).where("kind = 'leaf'").collect()) == 6


def test_opened_equals_the_source(spark, tree):
    tilesource.register(spark)
    mine = names(tilesource.opened(spark, tree).collect(), tree)
    for tasks in ("1", "3", "64"):
        assert names(spark.read.format("tiles").option("tasks", tasks).load(tree).collect(), tree) == mine
    assert set(mine) == {"a/00001", "a/00002", "b/c/00003", "b/00004", "cached/00007"}
    assert mine["a/00001"].dims == [6, 5, 4] and mine["a/00001"].dtype == "u16" and mine["a/00002"].o0 == 5_000_000 and mine["a/00002"].e0 == 5_010_000 and mine["a/00001"].format == "v6"
    assert mine["cached/00007"].dims == [7, 8, 9] and mine["cached/00007"].format is None
    assert "FileNotFound" in mine["b/c/00003"].error and mine["b/c/00003"].o0 == 9_000_000 and mine["b/00004"].error and mine["b/00004"].o0 is None
    off = names(spark.read.format("tiles").option("cache", "off").option("dims", "6,5,4").option("dtype", "u16").load(tree).collect(), tree)
    assert {"cached/00007", "cached/deep/00006"} <= set(off) and off["b/c/00003"].error is None
    assert {r.error is None for r in names(spark.read.format("tiles").option("version", "v9").load(f"{tree}/a").collect(), tree).values()} == {False}


def test_filters_reach_the_source(spark, tree):
    tilesource.register(spark)
    df = spark.read.format("tiles").load(tree).where(f"path like '{tree}/a/%' and o0 >= 2000000 and e0 < 9000000 and format = 'v6'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual" in plan or "PushedFilters" in plan or "BatchScan" in plan
    assert set(names(df.collect(), tree)) == {"a/00002"}


def count(monkeypatch, tree, *filters):
    """Folders listed, metadata read and volumes opened by a scan with these filters, in this process."""
    listed, opened, read = [], [], []
    real_list, real_head, real_read = folders.listing, volumes.header_of, folders.read_file
    monkeypatch.setattr(folders, "listing", lambda f: listed.append(f[len(tree) :]) or real_list(f))
    monkeypatch.setattr(volumes, "header_of", lambda p, e: opened.append(p) or real_head(p, e))
    monkeypatch.setattr(folders, "read_file", lambda p: read.append(p[len(tree) :]) or real_read(p))
    r = tilesource.TileReader({"path": tree})
    left = list(r.pushFilters(list(filters)))
    rows = [x for p in r.partitions() for x in r.read(p)]
    monkeypatch.undo()
    return left, {x[0][len(tree) + 1 :] for x in rows}, listed, read, opened


def test_folders_outside_are_not_opened(monkeypatch, tree):
    left, found, listed, read, opened = count(monkeypatch, tree, StringStartsWith(("path",), f"{tree}/a/0000"), EqualTo(("dtype",), "u16"))
    assert len(left) == 1 and found == {"a/00001", "a/00002"} and set(listed) == {"", "/a", "/a/00001", "/a/00002"} and len(opened) == 2
    _, found, listed, _, _ = count(monkeypatch, tree, EqualTo(("path",), f"{tree}/a/00002"))
    assert found == {"a/00002"} and set(listed) == {"", "/a", "/a/00002"}
    _, found, _, _, opened = count(monkeypatch, tree, GreaterThanOrEqual(("o0",), 4_000_000), LessThan(("e0",), 8_000_000))
    assert found == {"a/00002"} and [o[-15:] for o in opened] == ["2/a-vol.0.npy"[-15:]] or len(opened) == 1
    assert len(count(monkeypatch, tree, In(("format",), ("v1", "v2")))[4]) == 0
    assert not any("/deep" in f or ".hidden" in f for f in count(monkeypatch, tree)[2])


def rows_of(spark, n=40):
    rows = [(f"/data/{k // 10}/{k:05d}", [k * 100, k % 7, 5], [50, 60, 70], "u16", [5, 6, 7], None, [0.5] * 16) for k in range(n)]
    return spark.createDataFrame(rows, "path string, ori array<bigint>, shape array<bigint>, dtype string, dims array<bigint>, crop array<bigint>, transform array<float>")


def test_catalogue_is_committed_whole(spark, tmp_path, monkeypatch):
    tilesource.register(spark)
    at = str(tmp_path / "cat")
    df = rows_of(spark).repartitionByRange(4, "path")
    df.write.format("tiles").mode("append").save(at)
    load = lambda: spark.read.format("tiles").load(at)
    index = json.load(open(f"{at}/{folders.INDEX}"))["parts"]
    assert sorted(p["tiles"] for p in index) == [10] * 4 and load().count() == 40
    assert {r.path: (r.ori, r.shape, r.dims, r.dtype) for r in load().collect()} == {r.path: (r.ori, r.shape, r.dims, r.dtype) for r in df.collect()}
    # a box reads the files that it meets
    read = []
    real = folders.read_file
    monkeypatch.setattr(folders, "read_file", lambda p: read.append(p) or real(p))
    r = tilesource.TileReader({"path": at})
    assert list(r.pushFilters([GreaterThanOrEqual(("o0",), 1000), LessThan(("o0",), 1900)])) == []
    assert len([x for p in r.partitions() for x in r.read(p)]) == 9 and len([p for p in read if p.endswith(".tiles.yml")]) == 1
    monkeypatch.undo()
    # a task that fails leaves nothing to see, and the catalogue as it was
    bad = df.selectExpr("path", "if(path like '%39', array(raise_error('broken')), ori) as ori", "shape", "dtype", "dims", "crop", "transform")
    with pytest.raises(Exception, match="broken"):
        bad.write.format("tiles").mode("overwrite").save(at)
    assert load().count() == 40 and sorted(os.listdir(at)) == sorted([folders.INDEX, *(p["file"] for p in index)])
    fresh = str(tmp_path / "fresh")
    with pytest.raises(Exception, match="broken"):
        bad.write.format("tiles").mode("append").save(fresh)
    assert not os.path.exists(f"{fresh}/{folders.INDEX}") and (not os.path.exists(fresh) or spark.read.format("tiles").load(fresh).count() == 0)
    df.limit(3).write.format("tiles").mode("append").save(at)
    assert load().count() == 43
    df.limit(5).write.format("tiles").mode("overwrite").save(at)
    assert load().count() == 5 and len(os.listdir(at)) == 1 + len(json.load(open(f"{at}/{folders.INDEX}"))["parts"])


def test_saving_while_opening(spark, tree):
    saved = names(tilesource.opened(spark, tree, save=True).collect(), tree)
    assert set(saved) == {"a/00001", "a/00002", "cached/00007"} and folders.INDEX in os.listdir(tree)
    listed = [r.dir for r in folders.walk(spark, tree).collect()]
    assert listed == [tree]


def test_permissive_yaml(spark, tmp_path):
    good = yamlcache.dump([{"path": "/d/1", "ori": [1, 2, 3], "shape": [4, 5, 6], "dtype": "u8", "dims": [7, 8, 9], "crop": [7, 8, 9], "transform": [1.0]}], "/d/")
    text = good.replace("...\n", "- path: 2\n  aabb: {ori: [x], shape: 4}\n- 7\n- path: 3\n  shape: [1]\n  transform: no\n- path: 4\n  odd: 1\n...\n")
    (tmp_path / "a.cache.yml").write_text(text)
    (tmp_path / "b.cache.yml").write_text("path: [\n")
    (tmp_path / "c.cache.yml").write_text("- 1\n- 2\n")
    (tmp_path / "d.cache.yml").write_text("")
    rows = {(r.path, r.error and r.error.split(":")[0]): r for r in yamlcache.read(spark, str(tmp_path)).collect()}
    assert set(rows) == {("/d/1", None), ("/d/2", "ori"), ("/d/", "a tile"), ("/d/3", "shape"), ("/d/4", "unknown keys"), (None, "ParserError"), (None, "ValueError")}
    assert rows["/d/1", None].ori == [1, 2, 3] and rows["/d/2", "ori"].ori is None
    for t in (text, "path: [\n", "- 1\n"):
        with pytest.raises((ValueError, TypeError, AttributeError, Exception)):
            yamlcache.parse(t, "FAILFAST")


def test_scopes_of_all_versions():
    for n, scope in enumerate(_SCOPES):
        assert textproto.detect(textproto.parse(scope)) == f"v{n}"


def test_a_task_writes_bounded_files(spark, tmp_path, monkeypatch):
    w = tilesource.CatalogueWriter(str(tmp_path / "cat"), ["path", "ori", "shape", "dtype", "dims", "transform"], False).open()
    monkeypatch.setattr(tilesource, "PART", 15)
    rows = [r.asDict() for r in rows_of(spark).collect()]
    done = w.write(iter(rows))
    assert [p["tiles"] for p in done.parts] == [15, 15, 10] and [p["first"] for p in done.parts] == [rows[k]["path"] for k in (0, 15, 30)]
    # a task that goes on after the job was given up leaves nothing
    w.abort([])
    with pytest.raises(OSError):
        w.write(iter(rows))
    assert os.listdir(tmp_path / "cat") == []


def test_plain_catalogues_are_read_as_yaml_reads_them(monkeypatch):
    row = {"path": "/d/0001.x/a-b", "ori": [1, -2, 3], "shape": [4, 5, 6], "dtype": "u8", "dims": [7, 8, 9], "crop": [7, 8, 9], "transform": [1.0, -0.5]}
    good = yamlcache.dump([row, row | {"path": "/d/2", "crop": None, "transform": []}], "/d/")
    odd = [good.replace("- path: 2", "- path: '2'"), good.replace("  aabb", "  odd: 1\n  aabb", 1), good + "---\n", good.replace("[4, 5, 6]", "[4, 5, x]"), good.replace("path: 2", "path: 2 # x"), good.replace("path: 2", "path: é")]
    assert yamlcache._plain(good) and not any(yamlcache._plain(t) for t in odd)
    found = [yamlcache.parse(t) for t in (good, *odd)]
    monkeypatch.setattr(yamlcache, "_plain", lambda text: None)
    assert found == [yamlcache.parse(t) for t in (good, *odd)]


def test_python_work_is_dealt(spark, tmp_path):
    """A file of one row group is no single task."""
    from quadrille.sources.tables import spread

    spark.range(20_000).coalesce(1).write.parquet(str(tmp_path / "one"))
    df = spread(spark.read.parquet(str(tmp_path / "one")))
    assert df.rdd.getNumPartitions() == 4 and df.distinct().count() == 20_000


def test_detection_is_kept_by_fields():
    """One search of the features for all messages of one kind, and odd characters are still refused."""
    before = textproto._features.cache_info().misses
    assert {textproto.detect(textproto.parse(f"{_SCOPES[2]} n: {k}")) for k in range(50)} == {"v2"}
    assert textproto._features.cache_info().misses <= before + 1
    with pytest.raises(ValueError, match="unexpected character '@' at 5"):
        textproto.parse("a: 1 @")


def test_equal_files_of_a_tree_are_links(spark, tmp_path):
    """A tile takes little more than its folder and its position (before: four inodes)."""
    import io

    from quadrille.plans import file_queries, views

    root, sf = tmp_path / "sf", "/root/testdata/sf0.001"
    root.mkdir()
    views.read(spark, sf, "customer").selectExpr("explode(sequence(0, 9)) as i", "*").selectExpr("c_custkey + 910 * i as c_custkey", "c_nationkey", "c_mktsegment").coalesce(1).write.parquet(str(root / "customer.parquet"))
    own = {f"{r.parent}/{r.name}": r for r in file_queries.placed(spark, str(root)).collect()}
    at = file_queries.tree(spark, str(root))
    inodes = {os.stat(p).st_ino for d, _, files in os.walk(at) for p in (d, *(f"{d}/{f}" for f in files))}
    assert len(own) == 1500 and len(inodes) < 2.2 * len(own)
    for folder, r in own.items():
        files = sorted(os.listdir(f"{at}{folder}"))
        assert files == sorted(["a.acquisition", "a.microscope", f"{r.name}-vol.0.npy"])
        text = {k: open(f"{at}{folder}/a.{k}").read() for k in ("acquisition", "microscope")}
        assert text["acquisition"] == f"x_mm: {r.o0 / 1e6!r}\ny_mm: {r.o1 / 1e6!r}\nz_mm: {r.o2 / 1e6!r}\n"
        assert text["microscope"] == "fov {" if r.cached else text["microscope"].startswith(f"fov {{ x_size_um: {r.s0 / 1e3!r} y_size_um: {r.s1 / 1e3!r} ") and text["microscope"].endswith(_SCOPES[r.id % 10])
        assert np.load(io.BytesIO(open(f"{at}{folder}/{r.name}-vol.0.npy", "rb").read())).shape == (2 + r.id % 3, 5, 6)


def test_files_are_whole_where_links_fail(tmp_path, monkeypatch):
    """No links left, a file of a task that ran before, or a store without links."""
    from pyarrow import fs

    from quadrille.plans import file_queries

    monkeypatch.chdir(tmp_path)
    put = file_queries._links(fs.LocalFileSystem())
    for name in "abc":
        put(str(tmp_path / name), b"same")
    put(str(tmp_path / "d"), b"other")
    assert os.stat("a").st_ino == os.stat("b").st_ino == os.stat("c").st_ino != os.stat("d").st_ino
    put(str(tmp_path / "d"), b"same")
    monkeypatch.setattr(os, "link", lambda a, b: (_ for _ in ()).throw(OSError(31, "Too many links")))
    put(str(tmp_path / "e"), b"same")
    put = file_queries._links(fs.SubTreeFileSystem(str(tmp_path), fs.LocalFileSystem()))
    put("f", b"same")
    put("g", b"same")
    assert [open(n).read() for n in "abcdefg"] == ["same"] * 7 and len({os.stat(n).st_ino for n in "adefg"}) == 5


def test_a_walk_deals_few_folders_with_many_names(spark, tmp_path, monkeypatch):
    """A level of few folders is listed by more than one task, and a task holds a bounded number of names."""
    import pyarrow as pa

    for k in range(16):
        os.makedirs(tmp_path / "root" / str(k) / "x")
    level = folders.walk(spark, str(tmp_path / "root")).where("dir like '%/root/%' and dir not like '%/x'").selectExpr("dir", "input_file_name() as f").collect()
    assert len(level) == 16 and len({r.f for r in level}) > 1
    monkeypatch.setattr(folders, "NAMES", 4)
    dirs = pa.RecordBatch.from_pydict({"dir": [str(tmp_path / "root" / str(k)) for k in range(5)]})
    out = list(folders._listed(True)(iter([dirs])))
    assert [b.num_rows for b in out] == [2, 2, 1] and sum((b.column("dir").to_pylist() for b in out), []) == dirs.column("dir").to_pylist()
    assert list(folders._listed(True)(iter([]))) == []


def test_a_scope_of_many_tiles_is_parsed_once(monkeypatch):
    """However many scopes and stacks come between two tiles of one scope."""
    parsed, real = [], textproto.parse
    monkeypatch.setattr(textproto, "parse", lambda text: parsed.append(text) or real(text))
    scopes = [SCOPE.format(7000 + k) for k in range(200)]
    for turn in range(3):
        for k, scope in enumerate(scopes):
            meta = textproto.tile(scope, f"x_mm: {turn} y_mm: {k} z_mm: 3", f"/d/{k}")
            assert (meta["format"], meta["ori"], meta["shape"]) == ("v6", [turn * 1_000_000, k * 1_000_000, 3_000_000], [(7000 + k) * 1000, 20_000, 30_000])
    assert sum(t in scopes for t in parsed) == 200
    with pytest.raises(ValueError, match="does not fit v8"):
        textproto.tile(scopes[0], "x_mm: 1 y_mm: 2 z_mm: 3", "/d", "v8")


def test_a_saved_tree_has_what_the_open_one_had(spark, tree, monkeypatch):
    """The writer gets the columns that a catalogue keeps, and no others."""
    from pyspark.sql.readwriter import DataFrameWriter

    seen, real = [], DataFrameWriter.save
    monkeypatch.setattr(DataFrameWriter, "save", lambda self, *a, **k: seen.append(self._df.columns) or real(self, *a, **k))
    kept = [c for c in tilesource.COLUMNS if c not in ("format", "volume")]
    before = names(tilesource.opened(spark, tree).where("error is null").select(*kept).collect(), tree)
    after = names(tilesource.opened(spark, tree, save=True).select(*kept).collect(), tree)
    rounded = lambda rows: {p: [[round(x, 6) for x in v] if c == "transform" else v for c, v in r.asDict().items()] for p, r in rows.items()}
    assert rounded(after) == rounded(before) and len(after) == 3 and seen == [["path", "ori", "shape", "dtype", "dims", "crop", "transform"]]
