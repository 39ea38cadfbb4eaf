"""The data source for dataset folders against reading the files in Python."""

import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from millrace.sources import plugin
from millrace.sources.readers import SourceSpec

ROWS = [{"id": k, "lang": ["vi", "en", None][k % 3], "score": k / 2, "good": k % 2 == 0, "tags": ["a", str(k)], "text": "x\n" * (k % 7) + "é"} for k in range(500)]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("dataset")
    (root / "main").mkdir()
    pq.write_table(pa.Table.from_pylist(ROWS[:200]), root / "main" / "train-0.parquet", row_group_size=30)
    pq.write_table(pa.Table.from_pylist(ROWS[200:]), root / "main" / "train-1.parquet", row_group_size=70)
    pq.write_table(pa.Table.from_pylist(ROWS[:5]), root / "main" / "test-0.parquet")
    (root / "lines").mkdir()
    (root / "lines" / "train-0.jsonl").write_text("".join(json.dumps(r) + "\n" + "\n" * (r["id"] % 5 == 0) for r in ROWS[:300]), encoding="utf-8")
    (root / "lines" / "train-1.jsonl").write_text("\n".join(json.dumps(r) for r in ROWS[300:]), encoding="utf-8")
    return str(root)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def spec(**given):
    return SourceSpec("x", "mit", messages_field="messages", **given)


@pytest.mark.parametrize("subset", ["main", "lines"])
@pytest.mark.parametrize("split_bytes", [None, 100, 1000])
def test_reads_everything_once(spark, folder, subset, split_bytes):
    df = plugin.read_dataset(spark, folder, subset=subset, split="train", split_bytes=split_bytes)
    assert set(df.columns) == {*ROWS[0], "place"}
    got = {r["id"]: r.asDict() for r in df.collect()}
    assert len(got) == 500 == df.count() and {k: {c: v for c, v in r.items() if c != "place"} for k, r in got.items()} == {r["id"]: r for r in ROWS}
    assert [r["id"] for r in df.orderBy("place").select("id").collect()] == list(range(500))
    assert df.rdd.getNumPartitions() >= (12 if subset == "main" else 2 if split_bytes is None else 30)


@pytest.mark.parametrize("subset", ["main", "lines"])
@pytest.mark.parametrize("limit", [1, 29, 30, 31, 200, 333, 9999])
def test_scan_limit_counts_rows_before_the_filter(spark, folder, subset, limit):
    df = plugin.read_dataset(spark, folder, spec(subset=subset, scan_limit=limit, where=(("lang", "en"),)))
    assert ids(df) == [r["id"] for r in ROWS[:limit] if r["lang"] == "en"]
    some = plugin.read_dataset(spark, folder, spec(subset=subset, scan_limit=limit, where=(("lang", "en"),), limit=4))
    assert ids(some) == [r["id"] for r in ROWS[:limit] if r["lang"] == "en"][:4]


@pytest.mark.parametrize("subset", ["main", "lines"])
@pytest.mark.parametrize("column, value", [("lang", "vi"), ("id", 77), ("id", 77.0), ("id", "77"), ("score", 12), ("good", True), ("good", 1), ("lang", 5), ("tags", "a"), ("absent", 1), ("id", 10**6)])
def test_where_is_equality_of_python(spark, folder, subset, column, value):
    df = plugin.read_dataset(spark, folder, spec(subset=subset, scan_limit=1000, where=((column, value),)))
    assert ids(df) == [r["id"] for r in ROWS if column in r and r[column] == value]


def test_a_frame_can_be_used_again(spark, folder):
    df = plugin.read_dataset(spark, folder, subset="main", split="train")
    assert ids(df.where((F.col("lang") == "en") & (F.col("score") > 100))) == [r["id"] for r in ROWS if r["lang"] == "en" and r["score"] > 100]
    assert ids(df.where((F.col("id") == 44) | (F.col("id") == 45))) == [44, 45] and df.count() == 500


def test_equalities_leave_groups_out(spark, folder):
    reader = plugin.DatasetReader({"path": folder, "subset": "main", "split": "train", "where": '[["id", 77]]'}, plugin.Dataset({"path": folder, "subset": "main", "split": "train"}).schema())
    read = [sum(b.num_rows for b in reader.read(p)) for p in reader.partitions()]
    assert sum(read) == 1 and len(read) == 12


def test_group_statistics(folder):
    group = pq.read_metadata(f"{folder}/main/train-0.parquet").row_group(1)  # ids 30 to 59
    assert plugin._ruled_out(group, [("id", 29)]) and not plugin._ruled_out(group, [("id", 30)]) and plugin._ruled_out(group, [("lang", "zz")])
    assert not plugin._ruled_out(group, [("id", "29"), ("absent", 3), ("good", True)])


def test_errors_name_what_is_wrong(spark, tmp_path):
    for name, text, words in (("bad.jsonl", '{"a": 1}\n{"a": \n', "byte 9"), ("list.jsonl", '{"a": 1}\n[1]\n', "not an object")):
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception, match=words):
            plugin.read_dataset(spark, str(tmp_path / name), schema=plugin.from_arrow_schema(pa.schema([("a", pa.int64())]))).collect()
    with pytest.raises(Exception, match="no folder"):
        plugin.read_dataset(spark, str(tmp_path / "none")).collect()
    (tmp_path / "empty.jsonl").write_text("")
    assert plugin.read_dataset(spark, str(tmp_path / "empty.jsonl")).count() == 0
