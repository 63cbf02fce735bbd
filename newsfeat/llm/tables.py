"""Small shared steps: reading a table, cutting lineage, documents with their labels."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.session import scratch_path

#: Places that the ids of labels are hashed to.
PLACE_BITS = 25


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder: computed
    once, cheap to read again, and independent of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(table: DataFrame) -> None:
    """Deletes the files of a ``written`` table that nothing will read again;
    for rounds that each write what the next one reads."""
    spark = table.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {os.path.dirname(f) for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def bits(rows: DataFrame, number: Column) -> DataFrame:
    """The set of the positive numbers of ``rows`` as bitmaps of 2**15 each."""
    return rows.groupBy(F.bitmap_bucket_number(number).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits"))


def marked(table: DataFrame, number: Column, marks: DataFrame) -> DataFrame:
    """The rows of ``table`` whose number is in ``marks``, made by ``bits``."""
    at = F.bitmap_bit_position(number)
    rows = table.withColumns({"_of": F.bitmap_bucket_number(number), "_byte": (F.floor(at / 8) + 1).cast("int"),
                              "_bit": (at % 8).cast("int")})
    rows = rows.join(marks, rows["_of"] == marks["_bucket"]) \
        .where("shiftright(cast(conv(hex(substring(_bits, _byte, 1)), 16, 10) as int), _bit) & 1 = 1")
    return rows.select(*table.columns)


def labelled(docs: DataFrame, labels: DataFrame, column: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_doc, text, _label)`` of every document that has a label.  Several
    labels of one id count as their largest; null ids and labels are left out.
    There may be as many labels as documents, so they are joined by a shuffle;
    of the documents, those go into it whose ids hash to a marked place of
    ``2 ** PLACE_BITS`` (a bitmap of 4 MB, broadcast)."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(column).cast("int").alias("_label")).dropna()
    one = known.groupBy("_id").agg(F.max("_label").alias("_label"))
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    if docs.schema[id_col].dataType == labels.schema[id_col].dataType:  # others hash otherwise
        place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << PLACE_BITS)) + 1
        texts = marked(texts, place("_doc"), F.broadcast(bits(known, place("_id"))))
    return texts.join(one.hint("merge"), texts["_doc"] == one["_id"]).select("_doc", "text", "_label")
