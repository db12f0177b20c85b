"""The files of a folder as a table, and decisions by it."""

from pyspark.sql import functions as F

from harvestlake.operators import worklist as wl
from harvestlake.sources.inventory import read_inventory

FILES = {
    "zenodo/1/a b.pdf": b"12345", "zenodo/1/v2/a%20+b.txt": b"12", "dryad/7/x=1/c.zip": b"123", "dryad/7/c.zip": b"1",
}


def store(root):
    for path, content in FILES.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_bytes(content)
    # Spark's sources list neither of these.
    (root / "dryad/7/empty.txt").touch()
    (root / "dryad/7/.c.zip.part").write_bytes(b"1")


def lengths(df):
    return {r["path"]: r["length"] for r in df.collect()}


def test_lists_every_file_with_its_length(spark, tmp_path):
    store(tmp_path)
    want = {f"downloads/{p}": len(c) for p, c in FILES.items()}
    assert lengths(read_inventory(spark, str(tmp_path))) == want
    assert lengths(read_inventory(spark, f"file://{tmp_path}/")) == want
    own = read_inventory(spark, f"{tmp_path}/zenodo", "out/zenodo/")
    assert lengths(own) == {"out/zenodo/1/a b.pdf": 5, "out/zenodo/1/v2/a%20+b.txt": 2}
    assert own.where("modified is null").count() == 0


def test_nothing_there(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    for name in ("empty", "missing"):
        found = read_inventory(spark, str(tmp_path / name))
        assert found.columns == ["path", "length", "modified"] and found.collect() == []


def test_contents_are_not_read(spark, tmp_path):
    store(tmp_path)
    plan = read_inventory(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content#" not in plan and "length#" in plan


def test_files_that_are_there_are_not_fetched(spark, tmp_path):
    store(tmp_path)
    plan = spark.createDataFrame(
        [("1", 1, "downloads/zenodo/1/a b.pdf"), ("2", 1, "downloads/zenodo/1/none.pdf"), ("3", 7, "downloads/dryad/7/c.zip"),
         ("4", 1, "downloads/zenodo/1/v2/a%20+b.txt"), ("5", 7, "downloads/dryad/7/empty.txt")], "id STRING, project_id INT, path STRING",
    )
    heads = plan.select("id", F.lit(10).alias("content_length"))
    outcomes = plan.select("id", F.lit(True).alias("fetched"))
    done = wl.classify(plan, read_inventory(spark, str(tmp_path)), heads, outcomes)
    # An empty file is fetched again.
    assert {r["id"]: r["new_status"] for r in done.collect()} == {
        "1": "skipped_exists", "2": "success", "3": "skipped_exists", "4": "skipped_exists",
        "5": "success",
    }
