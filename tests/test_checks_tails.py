import io
import itertools
import random
import zipfile

import pytest

from cairnlake.operators import checks
from cairnlake.sources import archives


@pytest.mark.parametrize("required", [True, False])
def test_all_pairs_of_tables(spark, required):
    rng = random.Random(3)
    values = [None, "", *"abcdefghijklmnop"]
    sets = {f"t{i}": [rng.choice(values) for _ in range(rng.choice([0, 5, 30]))] for i in range(6)}
    sets["t9"] = values
    frames = {n: spark.createDataFrame([(v, 1) for v in own], "v string, x int") for n, own in sets.items()}
    out = checks.compare_all(frames, "v", required, 3)
    key = lambda v: (v is not None, v or "")
    expected = {}
    for a, b in itertools.combinations(sorted(sets), 2):
        l, r = ({v for v in sets[n] if required or v} for n in (a, b))
        expected[a, b] = (len(l - r), len(r - l), sorted(l - r, key=key)[:3], sorted(r - l, key=key)[:3])
    assert {(r[0], r[1]): tuple(r)[2:] for r in out.collect()} == expected
    with pytest.raises(ValueError):
        checks.compare_all({"one": frames["t0"]}, "v")


def test_registry_columns(spark):
    df = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    tables = {"A": df([("x/1", "x")], "Identity string, LowerId string"), "B": df([("x/1", "x"), ("y/1", "y")], "Identity string, LowerId string"), "C": df([("f",)], "Fingerprint string"), "D": df([("x", ""), ("x", "f")], "LowerId string, Fingerprint string")}
    got = {(r["column"], r["left_table"], r["right_table"]): (r["left_only"], r["right_only"], r["right_sample"]) for r in checks.compare_registry(tables).collect()}
    assert got == {("Identity", "A", "B"): (0, 1, ["y/1"]), ("LowerId", "A", "B"): (0, 1, ["y"]), ("LowerId", "A", "D"): (0, 0, []), ("Fingerprint", "C", "D"): (0, 0, [])}
    assert checks.compare_registry({"A": tables["A"]}) is None


def zipped(entries, comment=b""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in entries:
            z.writestr(name, data)
        z.comment = comment
    return out.getvalue()


class Counted(io.FileIO):
    taken = 0

    def read(self, size=-1):
        data = super().read(size)
        Counted.taken += len(data)
        return data


def test_tails_equal_whole_archives(spark, tmp_path):
    whole = zipped([("A.nuspec", "<x/>"), ("lib/net45/A.dll", "x" * 1000), ("é/漢.txt", "")], b"a comment")
    (tmp_path / "a.nupkg").write_bytes(whole)
    (tmp_path / "empty.nupkg").write_bytes(zipped([]))
    (tmp_path / "cut.nupkg").write_bytes(whole[:-30])
    (tmp_path / "none.nupkg").write_bytes(b"")
    (tmp_path / "bad.nupkg").write_bytes(whole[:-60].replace(b"PK\x01\x02", b"PKxx") + whole[-60:])
    (tmp_path / "other.txt").write_bytes(whole)
    with zipfile.ZipFile(tmp_path / "many.nupkg", "w") as z:  # more entries than the plain end record can count
        for i in range(66_000):
            z.writestr(f"e{i}", b"")
    tails = archives.archive_tails(spark, str(tmp_path), files_per_task=2)
    full = archives.archive_entries(archives.package_files(spark, str(tmp_path)))
    assert tails.schema.names == full.schema.names and tails.count() == 66_003
    assert sorted(map(str, tails.where("not path like 'e%'").collect())) == sorted(map(str, full.where("not path like 'e%'").collect()))
    assert tails.exceptAll(full).count() == 0
    assert archives.archive_tails(spark, str(tmp_path), "*.none").count() == 0


def test_a_large_archive_is_not_read_whole(tmp_path):
    path = tmp_path / "large.nupkg"
    with zipfile.ZipFile(path, "w") as z:
        with z.open(zipfile.ZipInfo("big"), "w", force_zip64=True) as e:
            for _ in range(300):
                e.write(bytes(1 << 20))
        z.writestr("small", "x")
    with Counted(path) as file:
        rows = archives._directory_of(file)
    assert [(r[1], r[7]) for r in rows] == [("big", 300 << 20), ("small", 1)] and path.stat().st_size > 300 << 20
    assert 0 < Counted.taken < 1 << 20
