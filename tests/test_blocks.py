"""Digests by byte range, digest trees, and the blocks in which two landings differ."""

import hashlib
import random

from terrier.sources import blocks, landing


def land(root, files):
    for name, data in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(data)
    return str(root)


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_blocks_of_files(spark, tmp_path):
    rng = random.Random(3)
    files = {f"d{i % 3}/f {i}.bin": rng.randbytes(n) for i, n in enumerate((0, 1, 99, 100, 101, 1000, 12_345))}
    got = blocks.block_digests(spark, land(tmp_path / "in", files), block_bytes=100).collect()
    want = {}
    for name, data in files.items():
        for n in range(-(-len(data) // 100)):
            want[name, n] = (len(data), 100 * n, len(data[100 * n : 100 * n + 100]), sha(data[100 * n : 100 * n + 100]))
    names = {r["path"]: r["path"].replace("%20", " ").rsplit("/in/", 1)[1] for r in got}
    assert {(names[r["path"]], r["block"]): (r["length"], r["start"], r["size"], r["sha256"]) for r in got} == want


def test_trees(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(blocks, "FAN_OUT", 4)
    data = random.Random(1).randbytes(1999)
    root = land(tmp_path / "in", {"a": data, "b": data, "c": data[:-1] + b"\0", "d": data[:100]})
    rows = blocks.digest_trees(blocks.block_digests(spark, root, block_bytes=100)).collect()
    got = {r["path"].rsplit("/", 1)[1]: (r["length"], r["blocks"], r["root"]) for r in rows}
    leaves = [sha(data[i : i + 100]) for i in range(0, 1999, 100)]
    nodes = [sha("".join(leaves[i : i + 4]).encode()) for i in range(0, 20, 4)]
    assert got["a"] == got["b"] == (1999, 20, sha("".join(nodes).encode()))
    assert got["c"][2] != got["a"][2] and got["d"] == (100, 1, sha(sha(leaves[0].encode()).encode()))


def test_altered_copy_names_the_block(spark, tmp_path):
    data = random.Random(2).randbytes(5000)
    altered = bytearray(data)
    altered[4321] ^= 1
    one = land(tmp_path / "one", {"x/same": data, "x/changed": data, "x/cut": data, "x/gone": data[:250]})
    two = land(tmp_path / "two", {"x/same": data, "x/changed": bytes(altered), "x/cut": data[:4950], "new": b"n"})
    sides = [blocks.block_digests(spark, r, block_bytes=1000) for r in (one, two)]
    got = {(r["file"], r["block"], r["start"], r["side"]) for r in blocks.differing_blocks(*sides, one, two).collect()}
    assert got == {("x/changed", 4, 4000, "content"), ("x/cut", 4, 4000, "content"), ("x/gone", 0, 0, "first"), ("new", 0, 0, "second")}
    summed = {r["file"]: (r["blocks"], r["differing"], r["first_differing"]) for r in blocks.landing_differences(*sides, one, two).collect()}
    assert summed == {"x/same": (5, 0, None), "x/changed": (5, 1, 4), "x/cut": (5, 1, 4), "x/gone": (1, 1, 0), "new": (1, 1, 0)}
    prints = [landing.fingerprints(spark, r) for r in (one, two)]
    agreed = {r["file"]: r["agreed"] for r in landing.agreement(*prints, one, two).collect()}
    assert agreed == {"x/same": True, "x/changed": False, "x/cut": False, "x/gone": False, "new": False}


def test_nothing_landed(spark, tmp_path):
    root = land(tmp_path / "in", {"empty": b""})
    assert blocks.block_digests(spark, root).count() == 0
    assert blocks.digest_trees(blocks.block_digests(spark, root)).count() == 0
