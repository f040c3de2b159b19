"""Hadoop text and SequenceFiles as DataFrames, inside the JVM.

Hadoop's readers give typed JVM collections; with a string encoder those are
DataFrames without a Python process in between. Two things need them: files
that Spark has no source for (SequenceFiles), and text read with a least number
of splits, which a DataFrame scan cannot be told.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TEXT = "org.apache.hadoop.io.Text"
CODECS = {"deflate": "DefaultCodec", "gzip": "GzipCodec", "bzip2": "BZip2Codec", "none": None}
SEQUENCE_OUTPUT = "org.apache.hadoop.mapred.SequenceFileOutputFormat"


def _joined(paths: str | list[str]) -> str:
    return paths if isinstance(paths, str) else ",".join(paths)


def text_splits(spark: SparkSession, paths: str | list[str], least: int) -> DataFrame:
    """Lines ``value`` of text files, cut into at least ``least`` splits where
    the files allow it, and never into fewer than the files' own splits."""
    jvm = spark.sparkContext._jvm
    rdd = spark.sparkContext._jsc.textFile(_joined(paths), least).rdd()
    return DataFrame(spark._jsparkSession.createDataset(rdd, jvm.org.apache.spark.sql.Encoders.STRING()).toDF(), spark)


def write_text_splits(lines: DataFrame, path: str, compression: str = "deflate") -> None:
    """The one string column of ``lines`` as text, with exactly one part file
    per partition: an empty one too, for which Spark's own sink writes none.
    What is at ``path`` is replaced."""
    sc, jvm = lines.sparkSession.sparkContext, lines.sparkSession.sparkContext._jvm
    strings = jvm.java.lang.Class.forName("java.lang.String")
    typed = getattr(lines._jdf, "as")(jvm.org.apache.spark.sql.Encoders.STRING())
    rows = jvm.org.apache.spark.api.java.JavaRDD.fromRDD(typed.rdd(), jvm.scala.reflect.ClassTag.apply(strings))
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
    codec = CODECS[compression]
    if codec:
        rows.saveAsTextFile(path, jvm.java.lang.Class.forName(f"org.apache.hadoop.io.compress.{codec}"))
    else:
        rows.saveAsTextFile(path)


def read_text_pairs(spark: SparkSession, paths: str | list[str], key: str, value: str) -> DataFrame:
    """SequenceFile(s) of ``(Text, Text)`` -> ``(key string, value string)``.
    ``paths``: a list, or one string that may hold globs and commas."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    python = jvm.org.apache.spark.api.python
    strings = jvm.org.apache.spark.sql.Encoders.STRING()
    text = jvm.java.lang.Class.forName(TEXT)
    conf_class = jvm.java.lang.Class.forName("org.apache.spark.util.SerializableConfiguration")
    conf = sc._jsc.sc().broadcast(jvm.org.apache.spark.util.SerializableConfiguration(sc._jsc.hadoopConfiguration()),
                                  jvm.scala.reflect.ClassTag.apply(conf_class))
    plain = python.WritableToJavaConverter(conf)
    rows = python.PythonHadoopUtil.convertRDD(sc._jsc.sequenceFile(_joined(paths), text, text).rdd(), plain, plain)
    both = jvm.org.apache.spark.sql.Encoders.tuple(strings, strings)
    return DataFrame(spark._jsparkSession.createDataset(rows, both).toDF(), spark).toDF(key, value)


def write_text_pairs(pairs: DataFrame, path: str) -> None:
    """Two string columns -> a SequenceFile folder of ``(Text, Text)``, one file
    per partition. Hadoop's committer moves a task's file into place only when
    the task succeeds, so lost or failed attempts leave none. ``Text`` knows no
    null: nulls become empty. The folder must not exist."""
    jvm = pairs.sparkSession.sparkContext._jvm
    strings = jvm.org.apache.spark.sql.Encoders.STRING()
    text = jvm.java.lang.Class.forName(TEXT)
    typed = getattr(pairs.na.fill("")._jdf, "as")(jvm.org.apache.spark.sql.Encoders.tuple(strings, strings))
    to_text = jvm.org.apache.spark.api.python.JavaToWritableConverter()
    rows = jvm.org.apache.spark.api.python.PythonHadoopUtil.convertRDD(typed.rdd(), to_text, to_text)
    tag = jvm.scala.reflect.ClassTag.apply(text)
    jvm.org.apache.spark.api.java.JavaPairRDD.fromRDD(rows, tag, tag) \
        .saveAsHadoopFile(path, text, text, jvm.java.lang.Class.forName(SEQUENCE_OUTPUT))
