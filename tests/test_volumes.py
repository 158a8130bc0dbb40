import numpy as np
import pytest

from quadrille.functions import kernels, transforms
from quadrille.operators import render
from quadrille.sources import textproto, tiletree, volumes, yamlcache
from quadrille.streaming import ingest

SCOPE = 'fov {{ x_size_um: {0} y_size_um: {1} z_size_um: {2} rotation_radians: 0 }} file_prefix: "vol" stack_extension: ".npy" {3} # end\n'
STACK = "x_mm: {0}\ny_mm: {1}\nz_mm: {2}\n"
#: Metadata values and what they are in nm, by single-precision products.
BOXES = [
    ((90.3938, 31.3874, 8.4999981), (230.489, 265.833, 100), (90393800, 31387400, 8499998), (230489, 265833, 100000)),
    ((92.6727, 29.6666, 8.7999973), (230.49, 265.833, 75), (92672696, 29666600, 8799997), (230490, 265833, 75000)),
    ((87.009, 13.98, 8.6500006), (379, 516, 100), (87009000, 13980000, 8650001), (379000, 516000, 100000)),
    ((87.864, 31.2, 9.75), (603, 850, 399), (87864000, 31200000, 9750000), (603000, 850000, 399000)),
    ((85.3708, 28.855, 9.0610018), (377.2, 517.5, 100), (85370800, 28855000, 9061002), (377200, 517500, 100000)),
    ((88.0097, 33.936, 8.0999975), (603.52, 828, 399), (88009696, 33936000, 8099997), (603520, 828000, 399000)),
    ((84.3752, 28.275, 10.211957), (377.2, 517.5, 398), (84375200, 28275000, 10211957), (377200, 517500, 398000)),
]
V2 = "daq { nidaq { flyback_scans: 4 } } autotile { }"


@pytest.mark.parametrize("mm, um, ori, shape", BOXES)
def test_metadata_boxes(mm, um, ori, shape):
    m = textproto.tile(SCOPE.format(*um, V2), STACK.format(*mm), "/x/00095/")
    assert (tuple(m["ori"]), tuple(m["shape"]), m["format"], m["volume"]) == (ori, shape, "v2", "/x/00095/00095-vol.%.npy")


@pytest.mark.parametrize("extra, version", [
    ("zpiezo { nidaq { um_max: 50 } } resonant_wrap { }", "v0"), ("zpiezo { um_max: 50 } resonant_wrap { } autotile { }", "v1"), (V2, "v2"),
    ("autotile { } surface_scan { } surface_probe { }", "v3"), ("autotile { } surface_scan { } pockels { laser: A } surface_find { response: 2 }", "v4"),
    ("autotile { } surface_scan { } pockels { laser: A } surface_find { offset_um: 2 }", "v5"), ("autotile { } surface_scan { } pockels { laser: A } trip_detect { ichan: 0 }", "v6"),
    ("autotile { use_explore: false } surface_scan { } pockels { laser: A } trip_detect { ichan: 0 }", "v7"),
])
def test_detection(extra, version):
    assert textproto.detect(textproto.parse(SCOPE.format(1, 1, 1, extra))) == version


def test_by_name_must_fit():
    scope = SCOPE.format(1, 1, 1, "autotile { use_explore: false } surface_scan { } pockels { laser: A } trip_detect { ichan: 0 }")
    with pytest.raises(ValueError):
        textproto.tile(scope, STACK.format(1, 1, 1), "/x", "v8")
    stack, again = textproto.moved(STACK.format(1, 1, 1), scope, [5e6, 6e6, 7e6], [2000, 2000, 2000])
    assert textproto.tile(again, stack, "/x")["ori"] == [5000000, 6000000, 7000000]


def test_transform_golden():
    """A published record: the flip (1, -1, 1), translations to 16 nm."""
    m = transforms.tile_transform((87009000, 13980000, 8650001), (379000, 516000, 100000), (768, 1024, 101, 2), transforms.FLIPS["v1"])
    want = np.diag([493.489594, -503.90625, 990.098999, 1, 1])
    want[2, 1], want[:3, 4] = 0.966894, (87008992, 14496000, 8650001)
    assert np.allclose(m[:, :4], want[:, :4], atol=1e-4) and np.allclose(m[:, 4], want[:, 4], atol=16)


def test_yaml():
    text = "---\npath: C:\\x\ntiles:\n- path: \n  aabb:\n    ori: [1, 2, 3]\n    shape: [4, 5, 6]\n  shape:\n    type: u16\n    dims: [7, 8, 9, 2]\n  transform: [1.5, 0.0]\n...\n"
    (r,) = yamlcache.parse(text)
    assert r[:7] == ("C:\\x", 3, [1, 2, 3], [4, 5, 6], "u16", [7, 8, 9, 2], None) and r[7] == [1.5, 0.0]
    bad = text.replace("  transform", "  odd: 1\n  transform")
    assert "odd" in yamlcache.parse(bad)[0][-1]
    with pytest.raises(ValueError):
        yamlcache.parse(bad, "FAILFAST")


def test_volume_files():
    v = np.arange(60, dtype=np.uint16).reshape(3, 4, 5)
    assert (volumes.decode(volumes.encode_tiff(v), "tif") == v).all()
    assert (volumes.decode(v.tobytes(), "raw", [5, 4, 3]) == v).all()
    assert volumes.no_data("i16") == -32768 and volumes.no_data("f32") == 0 and volumes.type_name(v.dtype) == "u16"


def test_scan(spark, tmp_path):
    for name in ("a/00001", "a/00002", "b"):
        d = tmp_path / name
        d.mkdir(parents=True)
        (d / "x.acquisition").write_text(STACK.format(1, 2, 3))
        (d / "x.microscope").write_text(SCOPE.format(10, 20, 30, V2) if name != "b" else "fov {")
        np.save(d / f"{d.name}-vol.0.npy", np.zeros((4, 5, 6), np.uint16))
    (tmp_path / "a" / "x.acquisition").write_text(STACK.format(9, 9, 9))  # a folder with folders is no tile
    rows = {r.path.rsplit("/", 1)[1]: r for r in tiletree.scan(spark, str(tmp_path)).collect()}
    assert set(rows) == {"00001", "00002", "b"} and rows["b"].error and rows["00001"].dims == [6, 5, 4] and rows["00001"].dtype == "u16"
    good = tiletree.catalogue(spark, str(tmp_path))
    yamlcache.write(good, str(tmp_path / "out"), str(tmp_path))
    texts = spark.read.text(str(tmp_path / "out"), wholetext=True).collect()
    assert sorted(p[0] for t in texts for p in yamlcache.parse(t.value)) == sorted(r.path for r in good.collect())


def test_kernels():
    assert kernels.radius(20) == 24 and kernels.radius(39) == 9
    with pytest.raises(ValueError):
        kernels.radius(40)
    assert kernels.antialias(0.2, 0.5, 0.25) is None and abs(sum(kernels.gauss(1.7)) - 1) < 1e-12
    v = np.random.default_rng(1).normal(size=(5, 6, 7))
    k = kernels.gauss(1.0)
    slow = np.array([sum(w * v[z, y, min(max(x + i - 3, 0), 6)] for i, w in enumerate(k)) for z in range(5) for y in range(6) for x in range(7)]).reshape(v.shape)
    assert np.allclose(kernels.separable(v, [k, None, None]), slow)
    p = kernels.maxima(v, 0.5)
    want = [(x, y, z) for z in range(5) for y in range(6) for x in range(7) if v[z, y, x] > 0.5 and v[z, y, x] >= v[max(z - 1, 0) : z + 2, max(y - 1, 0) : y + 2, max(x - 1, 0) : x + 2].max()]
    assert [tuple(int(i) for i in r[:3]) for r in p] == want


def test_affine_and_correlation():
    v = np.random.default_rng(2).normal(size=(6, 7, 8))
    shift = np.eye(4)
    shift[:3, 3] = 1, 2, 0
    got = kernels.affine(v, shift, (6, 5, 7), -1.0)
    assert np.allclose(got, v[:, 2:, 1:])
    c = kernels.masked_ncc(v, np.ones_like(v, bool), np.roll(v, 1, 2), np.ones_like(v, bool), 150)
    z, y, x = (i - (n - 1) for i, n in zip(np.unravel_index(c.argmax(), c.shape), v.shape))
    assert (z, y, x) == (0, 0, -1), (z, y, x)
    assert np.all(np.abs(c) <= 1 + 1e-6)


def test_pixel_boxes():
    m = transforms.tile_transform((1000, 2000, 3000), (800, 700, 600), (8, 7, 6), (1, 1, 1))
    m[2, 1] = 0
    assert transforms.world_to_pixel(m, (1100, 2000, 2900), (200, 1000, 200), (8, 7, 6, 2)) == ([1, 0, 0, 0], [2, 7, 1, 2])
    assert transforms.parse_size("2k") == 2000 and transforms.parse_size("0.5G") == 500_000_000 and transforms.parse_size("17") == 17 and transforms.next_pow2(17) == 32
    assert np.allclose(transforms.box_to_box([0] * 3, [8] * 3, [8] * 3, [4] * 3, [4] * 3, [2] * 3) @ [1, 1, 1, 1], [6, 6, 6, 1])


def test_leaf_and_parent():
    v = np.random.default_rng(3).normal(size=(4, 4, 4))
    m = np.diag([1000.0, 1000, 1000, 1])
    assert np.allclose(render.leaf([4000] * 3, [0] * 3, (1000,) * 3, [(v, m)], threshold=9), v)
    assert render.leaf([4000] * 3, [90000] * 3, (1000,) * 3, [(v, m)]) is None
    half = render.parent([4000] * 3, [0] * 3, [([0] * 3, [4000] * 3, v)], [2, 2, 2], threshold=9)
    assert np.allclose(half, v.reshape(2, 2, 2, 2, 2, 2).mean((1, 3, 5)))


def test_stream(spark, tmp_path):
    schema = "path string, seq bigint, o0 bigint"
    put = lambda rows: spark.createDataFrame(rows, schema).write.mode("append").parquet(str(tmp_path / "in"))
    run = lambda: ingest.ingest(spark, str(tmp_path / "in"), schema, str(tmp_path / "cat"), str(tmp_path / "cp")).awaitTermination(60)
    put([("a", 1, 5), ("b", 1, 6)])
    run()
    put([("a", 2, 7)])
    run()
    assert sorted((r.path, r.o0) for r in ingest.current(spark, str(tmp_path / "cat")).collect()) == [("a", 7), ("b", 6)]
