"""A streamed bronze table in few files, while its stream goes on."""

import os

import pytest

from records import DAY1, record, write_lines
from refinery.plans.compaction import compact_bronze, vacuum_bronze
from refinery.plans.medallion import run_new
from refinery.sources import read_bronze, read_silver
from refinery.sources.packed import manifest_path, packs_path, read_manifest
from refinery.streaming import ingest_new_files


def load(spark, root, *numbers):
    for n in numbers:
        write_lines(root + "/raw", DAY1, f"{n:03}.json", [record(3 * n + k, title=f"t{n}") for k in range(3)])
        ingest_new_files(spark, root + "/raw", root + "/bronze", root + "/state").awaitTermination()


def rows(spark, root):
    found = read_bronze(spark, root + "/bronze")
    return sorted((int(r.id), r.title, r._source_file.rsplit("/", 1)[1]) for r in found.collect())


def expected(n):
    return sorted((3 * i + k, f"t{i}", f"{i:03}.json") for i in range(n) for k in range(3))


def test_many_loads_few_files_same_rows(spark, root):
    for first in range(0, 50, 10):
        load(spark, root, *range(first, first + 10))
        assert rows(spark, root) == expected(first + 10)
        assert compact_bronze(spark, root + "/bronze") == 1
        assert rows(spark, root) == expected(first + 10)
        assert len(read_bronze(spark, root + "/bronze").inputFiles()) == 1
    # The stream's own folder and log are as they were.
    assert spark.read.parquet(root + "/bronze").count() == 150
    assert compact_bronze(spark, root + "/bronze") == 1


def test_large_files_are_left_alone(spark, root):
    load(spark, root, 0, 1, 2, 3)
    size = max(os.path.getsize(f"{root}/bronze/{n}") for n in os.listdir(root + "/bronze") if n.endswith(".parquet"))
    compact_bronze(spark, root + "/bronze", target_bytes=4 * size)
    packed = read_manifest(spark, root + "/bronze").packed
    load(spark, root, 4, 5, 6, 7)
    # A packed file over half of the target stays; the new ones are packed with each other.
    big = max(os.path.getsize(p.removeprefix("file:").replace("///", "/")) for p in packed)
    compact_bronze(spark, root + "/bronze", target_bytes=2 * big)
    assert packed <= read_manifest(spark, root + "/bronze").packed
    assert rows(spark, root) == expected(8)


def test_a_reader_that_began_before_and_a_run_that_died(spark, root):
    load(spark, root, 0, 1)
    before = read_bronze(spark, root + "/bronze")
    compact_bronze(spark, root + "/bronze")
    load(spark, root, 2)
    begun = read_bronze(spark, root + "/bronze")
    compact_bronze(spark, root + "/bronze")
    assert before.count() == 6 and begun.count() == 9
    # Packed files without their manifest, and a manifest without its mark, count for nothing.
    spark.range(5).write.parquet(packs_path(root + "/bronze") + "/pack__9-x")
    spark.range(5).write.parquet(manifest_path(root + "/bronze", 7))
    os.remove(manifest_path(root + "/bronze", 7) + "/_SUCCESS")
    assert rows(spark, root) == expected(3)


def test_vacuum_keeps_what_readers_see(spark, root):
    for n in range(4):
        load(spark, root, 2 * n, 2 * n + 1)
        compact_bronze(spark, root + "/bronze")
    before = set(os.listdir(packs_path(root + "/bronze")))
    vacuum_bronze(spark, root + "/bronze", keep=1, drop_covered=True)
    after = set(os.listdir(packs_path(root + "/bronze")))
    assert after < before and sum(n.startswith("pack__") for n in after) == 1
    assert not [n for n in os.listdir(root + "/bronze") if n.endswith(".parquet")]
    assert rows(spark, root) == expected(8)
    load(spark, root, 8)
    assert compact_bronze(spark, root + "/bronze") == 1 and rows(spark, root) == expected(9)


def test_the_daily_chain_compacts(spark, root):
    for n in range(3):
        write_lines(root + "/raw", DAY1, f"{n:03}.json", [record(3 * n + k, title=f"t{n}", extra=n) for k in range(3)])
        run_new(spark, root, export=False, compact=True)
        vacuum_bronze(spark, root + "/bronze", keep=1, drop_covered=True)
    assert rows(spark, root) == expected(3) and read_silver(spark, root + "/silver").count() == 9
    assert read_bronze(spark, root + "/bronze").where("_rescued IS NULL").count() == 0


def test_a_batch_table_is_refused(spark, root):
    spark.range(3).write.parquet(root + "/bronze")
    with pytest.raises(ValueError, match="stream"):
        compact_bronze(spark, root + "/bronze")
