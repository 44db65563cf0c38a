"""Large JSON files read by byte ranges."""

import json
import random

import pytest
from pyspark.sql import functions as F

from vqaspark.sources import files as FI
from vqaspark.sources import json_objects as J

ODD = ["a", "}", "{", '"', "\\", "\n", ",", "é", "日", "]", "[", ":", " ", '\\"', "},{"]


def _text(r):
    return "".join(r.choice(ODD) for _ in range(r.randint(0, 12)))


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("cut", ["}", ","])
def test_entries_of_all_layouts(spark, small_ranges, tmp_path, indent, cut):
    r = random.Random(1)
    listed = [{"id": i, "question": _text(r), "x": [{"y": _text(r)}]} for i in range(60)]
    mapped = {"info": "x,{}", "images": {f'k"{i}': _text(r) for i in range(20)}, "annotations": {str(i * 3): {"q": _text(r)} for i in range(50)},
              "empty": [], "n": 3}
    for name, obj in (("list", listed), ("wrapped", {"annotations": listed}), ("map", mapped)):
        path = str(tmp_path / f"{name}.json")
        with open(path, "w", encoding="utf-8") as f:
            f.write(json.dumps(obj, indent=indent, ensure_ascii=False) + ("\n" if indent else ""))
        assert spark.read.option("lineSep", cut).text(path).rdd.getNumPartitions() > 5
        got = {}
        for e in J.read_entries(spark, path, cut).collect():
            got.setdefault(e.section, {})[e.position] = e.text
        got = {k: [v[i] for i in range(len(v))] for k, v in got.items()}
        if name == "map":
            assert {k: [json.loads("{" + t + "}") for t in v] for k, v in got.items()} == {
                k: [{a: b} for a, b in mapped[k].items()] for k in ("images", "annotations")}
        else:
            assert {k: [json.loads(t) for t in v] for k, v in got.items()} == {"" if name == "list" else "annotations": listed}


def test_one_file_over_many_tasks(spark, small_ranges, tmp_path):
    rows = [{"id": i, "image_id": i % 5, "image_path": "x.jpg", "question": f"wh{{a}}t, \\\"{i}\\\"?"} for i in range(300)]
    (tmp_path / "r.json").write_text(json.dumps({"annotations": rows}, indent=2))
    req = FI.read_requests(spark, str(tmp_path / "r.json"))
    got = [(r.sample_id.position, r.id, r.question) for r in req.orderBy("sample_id").collect()]
    assert got == [(i, x["id"], x["question"]) for i, x in enumerate(rows)]
    pieces = spark.read.option("lineSep", "}").text(str(tmp_path / "r.json"))
    assert pieces.select(F.spark_partition_id()).distinct().count() > 20


@pytest.mark.parametrize("text", ['{"annotations": [{"id": 1}, {"id": 2', '{"annotations": [{"id": 1}, {"id": 2}', '[{"id": 1, "question": "a}', "[{}"])
def test_truncated_files_fail(spark, tmp_path, text):
    (tmp_path / "t.json").write_text(text)
    with pytest.raises(ValueError, match="MALFORMED"):
        J.read_entries(spark, str(tmp_path / "t.json"))


def test_empty_and_odd_files(spark, tmp_path):
    for name, text, n in (("a", "[]", 0), ("b", "{}", 0), ("c", '{"annotations": []}\n', 0), ("d", ' [ {"id": 1} ] ', 1), ("e", "", 0), ("f", " \n", 0)):
        (tmp_path / name).write_text(text)
        assert J.read_entries(spark, str(tmp_path / name)).count() == n, name
    with pytest.raises(ValueError):
        J.read_entries(spark, str(tmp_path / "a"), '"')
    (tmp_path / "g").write_text("12}")
    with pytest.raises(ValueError):
        J.read_entries(spark, str(tmp_path / "g"))
    (tmp_path / "h").write_text('[{"id": 1}, {"id": oops}]')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        FI.read_requests(spark, str(tmp_path / "h")).collect()
