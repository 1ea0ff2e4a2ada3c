"""Images, JSON documents and file listings as tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake import schemas, settings
from framelake.functions import records
from framelake.sources import storage

#: Names of a batch of a listing, bytes beyond which a batch of files ends.
NAMES, BYTES = 10_000, 8 << 20


def images(spark: SparkSession, path: str) -> DataFrame:
    """session_id, filename, image (BGR); unreadable files have height -1."""
    return spark.read.format("image").load(path).select(settings.session_of(F.col("image.origin")).alias("session_id"), F.regexp_extract("image.origin", r"([^/]+)$", 1).alias("filename"), "image")


def readable(found: DataFrame) -> DataFrame:
    return found.where("image.height >= 0")


def listing(spark: SparkSession, path: str) -> DataFrame:
    """session_id, filename of the files in a folder; their bytes are not read."""
    return spark.read.format("binaryFile").load(path).select(settings.session_of(F.col("path")).alias("session_id"), F.regexp_extract("path", r"([^/]+)$", 1).alias("filename"))


def contents(spark: SparkSession, folder: str, ending: str) -> DataFrame:
    """name (below the folder), content of the files of this ending in its folders.

    Only the folders are listed by the driver: executors list each one's files, deal them out by name and read them, so
    nothing about a file goes through the driver.
    """
    tops = spark.createDataFrame(pa.table({"top": pa.array(storage.folders(folder), pa.string())})).repartition("top")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for top in b.column(0).to_pylist():
                names = storage.names(storage.joined(folder, top), ending)
                for i in range(0, len(names), NAMES):
                    yield pa.RecordBatch.from_arrays([pa.array([f"{top}/{n}" for n in names[i : i + NAMES]], pa.string())], ["name"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held = [], 0
            for name in b.column(0).to_pylist():
                with storage.opened(storage.joined(folder, name)) as f:
                    rows.append((name, f.read()))
                held += len(rows[-1][1])
                if held > BYTES:
                    yield _read(rows)
                    rows, held = [], 0
            if rows:
                yield _read(rows)

    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return tops.mapInArrow(listed, "name string").repartition(tasks, "name").mapInArrow(read, "name string, content binary")


def _read(rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
    names, data = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(data, pa.binary())], ["name", "content"])


def documents(spark: SparkSession, path: str, name: str) -> DataFrame:
    """session_id, record: JSON files of one record each.  A missing file, broken JSON and missing keys are errors."""
    raw = spark.read.text(path, wholetext=True).select(settings.session_of(F.input_file_name()).alias("session_id"), F.input_file_name().alias("path"), F.col("value"))
    return raw.select("session_id", records.decoded(F.col("value"), name, F.col("path")).alias("record"))


def checked(rows: DataFrame, text: str, name: str) -> DataFrame:
    """The rows with record and fault: the record of a JSON text, or why there is none (null where there is one).

    Faults: no text; broken JSON; not an object; missing keys, which are named; keys whose value is of another type.  A
    required key whose value is null is there.  No row stops the others.
    """
    kind = schemas.RECORDS[name]
    at = lambda f, t: F.try_variant_get(F.col("__v"), f"$.{f}", t)
    lists = lambda names, test: F.filter(F.array(*[F.when(test(f), F.lit(f.name)) for f in names]), lambda x: x.isNotNull())
    lack = lists([f for f in kind if f.name in schemas.required(name)], lambda f: at(f.name, "variant").isNull())
    wrong = lists(list(kind), lambda f: at(f.name, "variant").isNotNull() & ~F.is_variant_null(at(f.name, "variant")) & at(f.name, f.dataType.simpleString()).isNull())
    # the parser stops behind the first value; a text is one value alone if it is one as a list's only entry and as a key's value
    rows = rows.withColumns({"__a": F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "__o": F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))})
    alone = F.col("__o").isNotNull() & F.try_variant_get("__a", "$[1]", "variant").isNull()
    rows = rows.withColumn("__v", F.when(alone, F.try_variant_get("__a", "$[0]", "variant")))
    rows = rows.withColumns({"__lack": lack, "__wrong": wrong, "record": F.struct(*[at(f.name, f.dataType.simpleString()).alias(f.name) for f in kind])})
    fault = (
        F.when(F.col(text).isNull(), "no text")
        .when(F.col("__v").isNull(), "broken JSON")
        .when(~F.schema_of_variant("__v").startswith("OBJECT"), "not an object")
        .when(F.size("__lack") > 0, F.concat(F.lit("missing keys "), F.array_join("__lack", ", ")))
        .when(F.size("__wrong") > 0, F.concat(F.lit("other types "), F.array_join("__wrong", ", ")))
    )
    rows = rows.withColumn("fault", fault)
    return rows.withColumn("record", F.when(F.col("fault").isNull(), F.col("record"))).drop("__a", "__o", "__v", "__lack", "__wrong")


def scanned(spark: SparkSession, path: str, name: str) -> DataFrame:
    """session_id, path, record, fault of JSON files of one record each; a broken file doesn't stop the others."""
    raw = spark.read.text(path, wholetext=True).select(settings.session_of(F.input_file_name()).alias("session_id"), F.input_file_name().alias("path"), "value")
    return checked(raw, "value", name).select("session_id", "path", "record", "fault")


def accepted(spark: SparkSession, path: str, name: str, rejected: str | None = None) -> DataFrame:
    """session_id, record of JSON files.  A broken one is an error, or with rejected a row (session_id, path, fault) of the table there."""
    if rejected is None:
        return documents(spark, path, name)
    found = scanned(spark, path, name)
    found.where("fault is not null").select("session_id", "path", "fault").write.mode("append").parquet(rejected)
    return found.where("fault is null").select("session_id", "record")


def table_of(docs: DataFrame, field: str) -> DataFrame:
    """The rows of a document's list."""
    return docs.select("session_id", F.explode(f"record.{field}").alias("row")).select("session_id", "row.*")
