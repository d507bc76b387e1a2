"""Parquet tables that are replaced atomically, whole or by partition.

A write goes to a folder of its own, ``version_id=<id>``, which no reader looks at. The commit is one file: the manifest
``_versions/<number>.json`` names the folder of every partition (or of the whole table), the schema and the counts taken while
writing. It is moved into place with a rename that fails where the number is taken, so of two writers one wins and the other
starts anew or raises. A killed write leaves the committed version as it was; a table may be written from its own rows; a
replayed date gets a folder of its own and all other dates keep their files.

The store must offer a rename that doesn't replace (HDFS, local and most mounted stores do). The driver holds one manifest:
one entry per partition folder, as a catalog does. Counts come from ``DataFrame.observe`` in the writing job: nothing is read
again. Readers get the committed folders only, with the partition column, so Spark prunes partitions before it lists files.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ID = "version_id"
LOG = "_versions"


class CommitConflict(RuntimeError):
    """Another writer changed the same partitions since this write began."""


def _fs(spark: SparkSession, path: str):
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), lambda *parts: reduce(spark._jvm.org.apache.hadoop.fs.Path, parts, root)


def numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of all committed versions."""
    fs, at = _fs(spark, path)
    if not fs.exists(at(LOG)):
        return []
    return sorted(int(s.getPath().getName()[:-5]) for s in fs.listStatus(at(LOG)) if s.getPath().getName()[:-5].isdigit())


def manifest(spark: SparkSession, path: str, number: int | None = None) -> dict | None:
    """The manifest of a version, by default of the latest; None where nothing was ever committed."""
    if number is None:
        known = numbers(spark, path)
        if not known:
            return None
        number = known[-1]
    fs, at = _fs(spark, path)
    stream = fs.open(at(LOG, f"{number:08d}.json"))
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, entry: dict) -> bool:
    """Move the manifest into place; False if its number is taken."""
    fs, at = _fs(spark, path)
    fs.mkdirs(at(LOG))
    staged, final = at(LOG, f"{uuid.uuid4().hex}.tmp"), at(LOG, f"{entry['version']:08d}.json")
    out = fs.create(staged, True)
    out.write(bytearray(json.dumps(entry, sort_keys=True).encode()))
    out.close()
    jvm = spark._jvm
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        files.rename(staged, final, no_options)  # fails where the target exists
        return True
    except Exception as e:
        if "FileAlreadyExistsException" not in str(e):
            raise
        fs.delete(staged, False)
        return False


def write(df: DataFrame, path: str, parts: Iterable[str] = (), only_touched: bool = False, keys: Iterable[str] = (), metrics: Mapping[str, Column] | None = None) -> dict:
    """Write ``df`` and commit it; the new manifest.

    ``parts``: at most one partition column. ``only_touched``: partitions that ``df`` has rows of are replaced, all others
    stay; else the whole table is replaced. ``keys``: the manifest gets the number of rows with a null in one of them.
    ``metrics``: further aggregates taken while writing.
    """
    spark, parts = df.sparkSession, list(parts)
    if len(parts) > 1 or (only_touched and not parts):
        raise ValueError("one partition column at most, and one to replace partitions")
    base = manifest(spark, path)
    if base and only_touched:
        held = T.StructType.fromJson(json.loads(base["schema"]))
        if {f.name: f.dataType for f in held} != {f.name: f.dataType for f in df.schema} or base["parts"] != parts:
            raise ValueError("columns or partitions differ from the committed table's")
        df = df.select(*held.fieldNames())
    schema = df.schema
    folder = f"{ID}={uuid.uuid4().hex}"
    seen = Observation()
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False))
    taken = {"rows": F.count(F.lit(1)), "null_keys": F.count_if(null_key), **(metrics or {})}
    df.observe(seen, *[c.alias(n) for n, c in taken.items()]).write.partitionBy(*parts).parquet(f"{path}/{folder}")
    fs, at = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(at(folder)) if s.isDirectory()] if parts else [""]
    new = {n: folder for n in names}
    counts = {k: v if isinstance(v, (int, float, str, bool, type(None))) else str(v) for k, v in seen.get.items()}
    while True:
        kept, rows = {}, counts["rows"]
        if base and only_touched:
            kept = {n: f for n, f in base["folders"].items() if n not in new}
            gone = {n: f for n, f in base["folders"].items() if n in new}
            rows += base["metrics"]["rows"] - (_frame(spark, path, base["schema"], gone, base["parts"]).count() if gone else 0)  # file footers only
        entry = {"version": base["version"] + 1 if base else 1, "parts": parts, "schema": schema.json(), "folders": kept | new,
                 "written": sorted(new), "metrics": counts | {"rows": rows, "written_rows": counts["rows"]}}
        if _commit(spark, path, entry):
            return entry
        now = manifest(spark, path)
        before = base["folders"] if base else {}
        if not only_touched or any(now["folders"].get(n) != before.get(n) for n in new):
            raise CommitConflict(f"{path}: changed by another writer")
        base = now


def _frame(spark: SparkSession, path: str, schema: str, folders: Mapping[str, str], parts: list[str]) -> DataFrame:
    schema_ = T.StructType.fromJson(json.loads(schema))
    if not folders:
        return spark.createDataFrame([], schema_)
    reader = spark.read.schema(T.StructType([*schema_.fields, T.StructField(ID, T.StringType())]) if parts else schema_)
    if not parts:
        return reader.parquet(f"{path}/{folders['']}")
    return reader.option("basePath", path).parquet(*[f"{path}/{f}/{n}" for n, f in sorted(folders.items())]).select(*schema_.fieldNames())


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The committed rows of the latest version, or of an older one that is still there."""
    found = manifest(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"no committed version under {path}")
    return _frame(spark, path, found["schema"], found["folders"], found["parts"])


def folder(spark: SparkSession, path: str) -> str:
    """The one folder of a table whose latest version was written whole."""
    names = set(manifest(spark, path)["folders"].values())
    if len(names) != 1:
        raise ValueError(f"{path} is spread over {len(names)} folders")
    return f"{path}/{names.pop()}"


def expire(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Forget all but the last ``keep`` versions; deletes the partition folders that no version left names. Staged folders of
    writes under way are never touched, as no manifest names them."""
    known = numbers(spark, path)
    fs, at = _fs(spark, path)
    old, left = ([manifest(spark, path, n) for n in part] for part in (known[: -keep or None], known[len(known) - keep :]))
    held = {(f, n) for m in left for n, f in m["folders"].items()}
    gone = sorted({(f, n) for m in old for n, f in m["folders"].items()} - held)
    for m in old:  # first the names, then the files
        fs.delete(at(LOG, f"{m['version']:08d}.json"), False)
    for f, n in gone:
        fs.delete(at(f, n) if n else at(f), True)
    return [f"{f}/{n}".rstrip("/") for f, n in gone]
