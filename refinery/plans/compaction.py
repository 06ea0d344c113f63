"""Compaction of a bronze table that a stream writes.

The stream's log names the files it wrote, and nobody else may change it. So small files are packed
into larger ones beside the table, and a numbered manifest says which packed files stand for which
of the stream's. A reader takes the last whole manifest: its packed files, and the stream's files
that it does not cover. A manifest appears at once, so each row is seen once, before and after, and
the stream goes on. Packed files are never changed; :func:`vacuum_bronze` removes what no recent
manifest names.
"""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession, functions as F, types as T

from refinery.sources.packed import (
    current_files,
    files_of,
    manifest_numbers,
    manifest_path,
    packs_path,
    read_files,
    read_manifest,
    schema_of,
)
from refinery.storage import drop_table, file_sizes, folders_of, shared_side, streamed

#: What a packed file should hold; one of at least half of that is left alone.
TARGET_BYTES = 128 << 20


def compact_bronze(
    spark: SparkSession, path: str, *, schema: T.StructType | None = None, target_bytes: int = TARGET_BYTES
) -> int:
    """Pack the small files of the table at ``path``; return how many files a reader opens now.

    Only files under half of ``target_bytes`` are read and written: those of the stream that no
    manifest covers yet, and packed ones that stayed small. A row is therefore written again a few
    times at most, however often this runs. Spark packs the files into tasks by size and no row is
    shuffled. ``schema`` is for a table whose files differ by more than new columns. The rows are counted on both
    sides before the manifest is written.
    """
    if not streamed(spark, path):
        raise ValueError(f"{path} is not written by a stream; write_bronze replaces it as a whole")
    manifest = read_manifest(spark, path)
    files = current_files(spark, path, manifest)
    if not files:
        return 0
    schema = schema or schema_of(spark, files, manifest)
    sizes = file_sizes(spark, files)
    small = [place for place in files if 2 * sizes[place] < target_bytes]
    wanted = max(1, -(-sum(sizes[place] for place in small) // target_bytes))
    if len(small) <= wanted:
        return len(files)
    rows, written = read_files(spark, small, schema), Observation()
    folder = shared_side(f"{packs_path(path)}/pack", str(manifest.number + 1))
    rows.coalesce(wanted).observe(written, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    packed = spark.read.schema(schema).parquet(folder)
    if packed.count() != rows.count():
        raise ValueError(f"packed {written.get['rows']} rows, but the files hold another number")
    kept = (manifest.packed - set(small)) | set(files_of(packed))
    covered = manifest.covered | (set(small) - manifest.packed)
    listed = [(place, False) for place in sorted(kept)] + [(place, True) for place in sorted(covered)]
    table = spark.createDataFrame(listed, "file string, covered boolean").coalesce(1)
    table.write.mode("overwrite").parquet(manifest_path(path, manifest.number + 1))
    return len(files) - len(small) + len(packed.inputFiles())


def vacuum_bronze(spark: SparkSession, path: str, *, keep: int = 2, drop_covered: bool = False) -> None:
    """Remove manifests but the last ``keep``, and packed files that none of these names.

    A reader that began under an older manifest may then fail, so keep as many as run at a time.
    ``drop_covered`` also removes the stream's own files that all of them cover. Their names stay in
    the stream's log, so from then on only :func:`refinery.sources.read_bronze` can read the table;
    do so only after :func:`refinery.streaming.merge_new_rows` has taken them up.
    """
    numbers = manifest_numbers(spark, path)
    kept = [read_manifest(spark, path, number) for number in numbers[-keep:]]
    if not kept:
        return
    for number in numbers[:-keep]:
        drop_table(spark, manifest_path(path, number))
    named = {place.rsplit("/", 2)[-2] for manifest in kept for place in manifest.packed}
    for folder in folders_of(spark, packs_path(path)):
        if folder.startswith("pack__") and folder not in named:
            drop_table(spark, f"{packs_path(path)}/{folder}")
    if drop_covered:
        for place in frozenset.intersection(*[manifest.covered for manifest in kept]):
            drop_table(spark, place)
