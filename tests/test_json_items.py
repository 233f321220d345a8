import json
import random

import pytest

from cairnlake.sources import snapshots
from cairnlake.sources.json_items import json_items


@pytest.fixture
def cut_at(spark):
    """Files are cut into ranges of so many bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def set_to(size):
        spark.conf.set(names[0], str(size))
        spark.conf.set(names[1], "1")

    yield set_to
    for n, v in before.items():
        spark.conf.set(n, v)


def ordered(df):
    return [r["item"] for r in df.orderBy("pos").collect()]


ODD = ['a,b', 'br[ack]et', 'qu"ote', 'back\\slash', '\\"', 'end\\', '\\\\"', "{,}", ",,,,", "é漢, ", "line\nbreak", "", '","', "x" * 300 + ",[" + "y" * 300]


@pytest.mark.parametrize("size, indent", [(120, None), (300, 1), (10_000, None)])
def test_items_equal_a_parser(spark, tmp_path, cut_at, size, indent):
    rng = random.Random(size)
    value = lambda d: rng.choice(ODD) if d == 0 or rng.random() < 0.4 else [value(d - 1) for _ in range(rng.randrange(4))] if rng.random() < 0.5 else {rng.choice(ODD): value(d - 1) for _ in range(rng.randrange(4))}
    document = [value(2) for _ in range(12)] + [1, None, True, -2.5, [], {}]
    path = tmp_path / "list"
    path.write_text(json.dumps(document, indent=indent, ensure_ascii=False), encoding="utf-8")
    cut_at(size)
    assert [json.loads(t) for t in ordered(json_items(spark, str(path)))] == document
    members = [(rng.choice(ODD), value(2)) for _ in range(12)]
    path = tmp_path / "object"
    path.write_text("﻿{" + ", ".join(f"{json.dumps(k)}: {json.dumps(v)}" for k, v in members) + "}\n", encoding="utf-8")
    paired = lambda text: json.loads(text, object_pairs_hook=lambda p: ["pairs", *map(list, p)])  # noqa: E731  repeated names stay
    got = [paired("{" + t + "}")[1] for t in ordered(json_items(spark, str(path)))]
    assert got == [paired(f"{{{json.dumps(k)}: {json.dumps(v)}}}")[1] for k, v in members]


def test_a_border_inside_a_string_and_no_items(spark, tmp_path, cut_at):
    cut_at(100)
    path = tmp_path / "d"
    odd = json.dumps('a,",],[,b' * 50)
    path.write_text(f'[{odd},"c",{odd}]')
    assert ordered(json_items(spark, str(path))) == [odd, '"c"', odd]
    for text in ("[]", " { } ", "[ \n ]"):
        path.write_text(text)
        assert ordered(json_items(spark, str(path))) == []
    for text in ('[1,2', '["a,b]', "[1]]"):
        path.write_text(text)
        with pytest.raises(ValueError, match="cut short"):
            json_items(spark, str(path))
    many = tmp_path / "many"
    many.mkdir()
    for i in range(3):
        (many / f"f{i}").write_text(json.dumps([f"{i},{k}" for k in range(4)]))
    got = ordered(json_items(spark, str(many)))
    assert sorted(got) == [json.dumps(f"{i},{k}") for i in range(3) for k in range(4)] and all(got[i : i + 4] == sorted(got[i : i + 4]) for i in (0, 4, 8))


def test_a_large_snapshot_runs_in_many_tasks(spark, tmp_path, cut_at):
    rng = random.Random(2)
    document = [[f"Package,{i}", *[[f"{v}.0.0-be\"ta[", rng.randrange(10**6)] for v in range(rng.randrange(1, 40))]] for i in range(12_000)]
    path = tmp_path / "v1"
    path.write_text(json.dumps(document))
    cut_at(1 << 20)
    out = snapshots.downloads_v1(spark, str(path))
    assert path.stat().st_size > 6 << 20 and spark.read.option("lineSep", ",").text(str(path)).rdd.getNumPartitions() > 4
    got = [(r["id"], r["version"], r["downloads"]) for r in out.orderBy("pos").collect()]
    assert got == [(i, v, n) for i, *pairs in document for v, n in pairs]
