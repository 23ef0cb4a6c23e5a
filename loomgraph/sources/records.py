"""Readers and writers of the dataset's files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.sources import schemas as S


def ndjson(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """One JSON object a line; blank lines are skipped, malformed ones fail."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths if isinstance(paths, str) else list(paths))


def ndjson_tolerant(spark: SparkSession, paths: str | Sequence[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, quarantined lines)."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select("value", F.col("_metadata.file_path").alias("file")).filter("trim(value) <> ''")
    kind = T._parse_datatype_string(schema)
    parsed = lines.withColumn("__r", F.from_json("value", T.StructType([*kind.fields, T.StructField("_bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("__r").isNull() | F.col("__r._bad").isNotNull()
    return parsed.filter(~bad).select(*(F.col("__r")[f.name].alias(f.name) for f in kind.fields)), parsed.filter(bad).select("file", "value")


def documents(spark: SparkSession, paths: Sequence[str] | None = None, glob: str | None = None, root: str | None = None) -> DataFrame:
    """path, rel, text, bytes of whole files.  A glob, relative to the root if there is one, goes before a list; ** stands for
    any folders.  No file at all, or a missing one, is an error."""
    if glob:
        where = glob if root is None else f"{root.rstrip('/')}/{glob}"
        if "**" not in where:
            raw = spark.read.text(where, wholetext=True)
        else:
            top = where.split("**")[0].rpartition("/")[0]
            raw = spark.read.option("recursiveFileLookup", "true").text(top, wholetext=True)
            parts = re.split(r"(\*\*/?|\*|\?)", where[len(top) + 1 :])
            body = "".join({"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}.get(x, _quoted(x)) for x in parts)
            raw = raw.filter(_decoded(F.col("_metadata.file_path")).rlike(f"{_quoted(re.sub('^[a-z]+:/*', '/', top))}/{body}$"))
    elif paths:
        raw = spark.read.text(list(paths), wholetext=True)
    else:
        raise ValueError("no documents named")
    out = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), F.col("value").alias("text"))
    if out.isEmpty():
        raise FileNotFoundError(f"no document matches {glob or paths}")
    rel = _decoded(F.col("path")) if root is None else F.regexp_replace(_decoded(F.col("path")), "^.*?" + _quoted(re.sub("^[a-z]+:/*", "/", root.rstrip("/"))) + "/", "")
    return out.withColumn("rel", rel)


def _decoded(path: Column) -> Column:
    """A file's address as a plain path."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _quoted(s: str) -> str:
    return "".join(c if c.isalnum() else "\\" + c for c in s)


def keyed(spark: SparkSession, path: str, value: str, missing_ok: bool = False) -> DataFrame:
    """slug and the fields of a JSON object keyed by slug; an absent file may count as empty."""
    kind = T._parse_datatype_string(f"map<string,{value}>")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if missing_ok and not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], T.StructType([T.StructField("slug", T.StringType()), *kind.valueType.fields]))
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", kind)).alias("slug", "m")).select("slug", "m.*")


def prefixes(spark: SparkSession, path: str) -> DataFrame:
    """prefix, namespace; comment keys are dropped."""
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("prefix", "namespace")).filter(~F.col("prefix").startswith("_"))


#: Mentions as they are parsed: evidence may hold anything.
_MENTION = "struct<" + S.MENTION.replace("evidence array<string>", "evidence array<variant>").replace(" array", ":array").replace(" string", ":string") + ">"


def _mention(m: Column) -> list[Column]:
    """The fields of a parsed mention; evidence that is no string is dropped."""
    proof = F.filter(m["evidence"], lambda v: F.schema_of_variant(v) == "STRING")
    return [*(m[c].alias(c) for c in ("name", "type", "aliases", "description")), F.transform(proof, lambda v: v.cast("string")).alias("evidence")]


def shards(spark: SparkSession, paths: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(mentions with file and pos in order of files, unreadable files): each file is an array of mentions or an object
    with the array in ``entities``."""
    raw = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    as_list = F.from_json("value", f"array<{_MENTION}>")
    as_object = F.from_json("value", f"struct<entities:array<{_MENTION}>>")
    opening = F.substring(F.regexp_replace("value", r"(?U)^\s+", ""), 1, 1)
    sound = F.try_parse_json("value").isNotNull()
    x = raw.withColumn("sound", sound).withColumn("m", F.when(~F.col("sound"), None).when(opening == "[", as_list).when(opening == "{", F.coalesce(as_object["entities"], F.array().cast(f"array<{_MENTION}>"))))
    rows = x.filter("m is not null").select("file", F.posexplode("m").alias("i", "m")).select("file", "i", *_mention(F.col("m")))
    return with_order(rows, ["file", "i"]), x.filter("m is null").select("file")


def with_order(rows: DataFrame, columns: list[str]) -> DataFrame:
    """rows plus pos: their order as one comparable value (a struct of the columns)."""
    return rows.withColumn("pos", F.struct(*columns))


def transcripts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Mentions (file, pos) from agent transcripts: of each tool use whose input is an object, the entities, if the list is
    not empty and its first item has a name.  Lines that are no JSON are skipped.

    A file may be split over tasks: order is by file, where the split begins, and the line in it."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", F.monotonically_increasing_id().alias("line"))
    kind = f"struct<message:struct<content:array<struct<type:string,input:struct<entities:array<{_MENTION}>>>>>>"
    place = ["file", "block", "line"]
    blocks = lines.filter(F.try_parse_json("value").isNotNull()).select(*place, F.posexplode(F.from_json("value", kind)["message"]["content"]).alias("b", "c"))
    used = blocks.filter("c.type = 'tool_use' and size(c.input.entities) > 0 and c.input.entities[0].name is not null")
    rows = used.select(*place, "b", F.posexplode("c.input.entities").alias("i", "m")).select(*place, "b", "i", *_mention(F.col("m")))
    return with_order(rows, [*place, "b", "i"])


def write_ndjson(df: DataFrame, path: str, by: str | None = None) -> None:
    """One folder of NDJSON files per value of ``by``."""
    writer = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(by) if by else writer).json(path)


def write_parquet(df: DataFrame, path: str, by: str | None = None) -> None:
    """The canonical storage; partitions that are not written stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(by) if by else writer).parquet(path)


def write_batches(batched: DataFrame, path: str) -> None:
    """id, heading_path, text of each batch; batches of earlier runs go."""
    batched.select("batch_id", "id", "heading_path", "text").write.mode("overwrite").partitionBy("batch_id").json(path)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """One file in any store that Spark writes."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def get_text(spark: SparkSession, path: str) -> str | None:
    """A whole small file, or None where there is none."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.text(path, wholetext=True).head()[0]


def write_document(one: DataFrame, path: str) -> None:
    """A one-row table as one JSON file."""
    row = one.select(F.to_json(F.struct(*one.columns), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")).head()
    put_text(one.sparkSession, path, row[0] + "\n")


def write_keyed(rows: DataFrame, key: str, path: str) -> None:
    """A small table (of packs, sources) as one JSON object keyed by a column."""
    fields = F.struct(*(c for c in rows.columns if c != key))
    whole = rows.select(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, fields.alias("v"))))).alias("m"))
    put_text(rows.sparkSession, path, whole.select(F.to_json("m", {"pretty": "true", "ignoreNullFields": "false"})).head()[0] + "\n")


def fingerprints(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """path, content, sha256, bytes."""
    raw = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return raw.select("path", "content", F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
