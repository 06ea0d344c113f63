"""Which files of the silver table may hold a key: a range and a Bloom filter for each file.

The index lies in a folder beside the table, as two tables: one row per file with its size and the
range of its keys, and the bits of its filter in bitmaps of 32,768. Files are never changed, only
added and removed, so rows of files that are gone are left out on reading, and files that the index
does not know, such as those of a table written anew, are read once and added.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from refinery.roles import DEFAULT_ROLES, Roles
from refinery.sources.tables import FILE, file_name, read_silver
from refinery.storage import drop_table, file_sizes, shared_side, table_exists

BITMAP = 32_768
#: Ten bits and four positions a key let through about one key in a hundred that a file does not hold.
BITS_PER_KEY, POSITIONS = 10, 4
#: Pairs of a key and a file that are compared, at most; beyond, the keys of all files are read.
MOST_PAIRS = 10_000_000
#: The keys of a table with so few files are read without asking the index.
FEW_FILES = 64
#: Folders of the index before it is written as one.
MOST_PARTS = 64
#: A category with more files below this size than that has them written together.
SMALL_BYTES, MOST_SMALL = 16 << 20, 256

_FILES = f"{FILE} string, category string, bytes bigint, bitmaps bigint, least string, most string"
_BITS = f"{FILE} string, bitmap bigint, bits binary"


def _positions(key: Column, bitmaps: Column) -> Column:
    """The places of a key in a filter of so many bitmaps."""
    text = key.cast("string")
    return F.array(*[F.pmod(F.xxhash64(text, F.lit(seed)), bitmaps * BITMAP) for seed in range(POSITIONS)])


class FileIndex:
    """The index of the silver table at ``table``, as it is now."""

    def __init__(self, spark: SparkSession, table: str, roles: Roles = DEFAULT_ROLES, schema: T.StructType | None = None):
        self.spark, self.table, self.roles = spark, table, roles
        self.path = f"{table.rstrip('/')}__index"
        whole = read_silver(spark, table, schema=schema, roles=roles)
        self.schema, self.key_type = whole.schema, whole.schema[roles.key].dataType
        # As many names as the driver lists for any scan of the table.
        self.places = {file_name(place): unquote(place) for place in whole.inputFiles()}
        self._indexed: DataFrame | None = None

    def scan(self, names: list[str] | None = None) -> DataFrame:
        """The rows of some files, or of all, with the name of each row's file."""
        if names is not None and not names:
            return self.spark.createDataFrame([], T.StructType([*self.schema.fields, T.StructField(FILE, T.StringType())]))
        files = None if names is None else [self.places[name] for name in names]
        return read_silver(self.spark, self.table, schema=self.schema, roles=self.roles, files=files, with_file=True)

    def files(self) -> DataFrame:
        """One row per file; those that are new to the index are added first."""
        if self._indexed is None:
            present = self.spark.createDataFrame([(name,) for name in self.places], f"{FILE} string")
            known = self._read("files", _FILES)
            new = [row[0] for row in present.join(known, FILE, "left_anti").collect()]
            if new:
                self._add(new)
            self._indexed = self._read("files", _FILES).dropDuplicates([FILE]).join(present, FILE, "left_semi")
        return self._indexed

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.path}/{name}"
        if not table_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)

    def _add(self, names: list[str]) -> None:
        key, rows = F.col(self.roles.key), self.scan(names)
        bounds = [end(key).cast("string").alias(name) for end, name in ((F.min, "least"), (F.max, "most"))]
        counted = rows.groupBy(FILE, F.col(self.roles.category).alias("category")).agg(F.count(key).alias("n"), *bounds)
        found = file_sizes(self.spark, [self.places[name] for name in names])
        sizes = self.spark.createDataFrame([(name, found[self.places[name]]) for name in names], f"{FILE} string, bytes bigint")
        bitmaps = F.greatest(F.ceil(F.col("n") * BITS_PER_KEY / BITMAP), F.lit(1)).cast("bigint").alias("bitmaps")
        sized = counted.join(sizes, FILE).select(FILE, "category", "bytes", bitmaps, "least", "most")
        filters = rows.select(FILE, key.alias("key")).join(sized.select(FILE, "bitmaps"), FILE)
        place = filters.select(FILE, F.explode(_positions(F.col("key"), F.col("bitmaps"))).alias("place"))
        bits = place.groupBy(FILE, F.expr(f"place div {BITMAP}").alias("bitmap")).agg(
            F.bitmap_construct_agg(F.col("place") % BITMAP).alias("bits")
        )
        # The bits first: a file counts as known once its filter is whole.
        bits.write.parquet(shared_side(f"{self.path}/bits/part", "new"))
        sized.write.parquet(shared_side(f"{self.path}/files/part", "new"))
        self._tidy()

    def _tidy(self) -> None:
        """Write an index of many parts as one, without the files that are gone."""
        present = self.spark.createDataFrame([(name,) for name in self.places], f"{FILE} string")
        for name, schema, keys in (("bits", _BITS, [FILE, "bitmap"]), ("files", _FILES, [FILE])):
            path, stored = f"{self.path}/{name}", self._read(name, schema)
            parts = {file.rsplit("/", 2)[-2] for file in stored.inputFiles()}
            if len(parts) > MOST_PARTS:
                stored.join(present, FILE, "left_semi").dropDuplicates(keys).write.parquet(shared_side(f"{path}/part", "whole"))
                for part in parts:
                    drop_table(self.spark, f"{path}/{part}")

    def may_hold(self, keys: DataFrame, n_keys: int) -> list[str]:
        """Names of the files that may hold one of the distinct ``keys``; of all if there are few, or too many pairs."""
        n_files = len(self.places)
        if n_files <= FEW_FILES or n_keys * n_files > MOST_PAIRS:
            return list(self.places)
        files = self.files()
        # The smaller side has at most the square root of the pairs.
        sought = keys.select(F.col(self.roles.key).alias("sought")).where("sought IS NOT NULL")
        within = F.col("sought").between(*[F.col(name).cast(self.key_type) for name in ("least", "most")])
        pairs = files.join(F.broadcast(sought), within) if n_keys <= n_files else sought.join(F.broadcast(files), within)
        placed = pairs.select("sought", FILE, F.explode(_positions(F.col("sought"), F.col("bitmaps"))).alias("place"))
        placed = placed.withColumn("bitmap", F.expr(f"place div {BITMAP}"))
        byte = F.conv(F.hex(F.substring("bits", F.expr(f"int(place % {BITMAP} div 8) + 1"), F.lit(1))), 16, 10).cast("int")
        is_set = F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1, int(place % 8))")) != 0, F.lit(False))
        tested = placed.join(self._read("bits", _BITS), [FILE, "bitmap"], "left").select("sought", FILE, "place", is_set.alias("is_set"))
        # A run that died may have left a file's bits twice; places of one key may be equal.
        held = tested.groupBy("sought", FILE, "place").agg(F.max("is_set").alias("is_set")).groupBy("sought", FILE).agg(F.min("is_set").alias("held"))
        return [row[0] for row in held.where("held").select(FILE).distinct().collect()]

    def holding(self, keys: DataFrame, n_keys: int) -> list[str]:
        """Names of the files that do hold one of the distinct ``keys``: the candidates' keys are read."""
        scan = self.scan(self.may_hold(keys, n_keys))
        found = scan.select(self.roles.key, FILE).join(keys, self.roles.key, "left_semi")
        return [row[0] for row in found.select(FILE).distinct().collect()]

    def crowded(self, categories: DataFrame) -> list[str]:
        """Names of the small files of those of ``categories`` that have too many of them."""
        if len(self.places) <= MOST_SMALL:
            return []
        small = self.files().where(F.col("bytes") < SMALL_BYTES).withColumnRenamed("category", "__category")
        asked = categories.select(F.coalesce(self.roles.category, F.lit("")).alias("__category")).distinct()
        small = small.join(asked, "__category", "left_semi")
        many = small.groupBy("__category").count().where(F.col("count") > MOST_SMALL)
        return [row[0] for row in small.join(many, "__category", "left_semi").select(FILE).collect()]
