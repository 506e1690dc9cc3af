"""Small helpers the training-data operators share."""

from __future__ import annotations

import pickle
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..workspace import new_path

IDS = 500_000  # at most so many ids are broadcast
SAMPLE_CHARS = 50_000_000  # of the texts that a classifier is trained on, half for either label
LONGEST_CHARS = 500_000  # of a text that a classifier is trained on
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z alone; other letters keep their case."""
    return F.translate(text, A_TO_Z, A_TO_Z.lower())


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: lineage is cut and any executor may be lost."""
    return read_work(df.sparkSession, write_work(df, name), df)


def write_work(df: DataFrame, name: str) -> str:
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return path


def read_work(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path)


def drop_work(spark: SparkSession, path: str) -> None:
    """Deletes a table of write_work() that nothing reads any more."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def rank_globally(df: DataFrame, *order: str, name: str = "rank") -> DataFrame:
    """Adds the column `name`: 0-based positions of the rows in a total order, without gathering them in one task.

    Rows are dealt by range and sorted within partitions; a partition's offset is the number of rows before it, a
    table of one row per partition. The dealt rows are written down first, so positions can't change in a rerun.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    dealt = materialize(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranked")
    part, within = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.broadcast(sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")))
    return (
        dealt.withColumn("_part", part).join(before, "_part")
        .withColumn(name, F.col("_before") + within).drop("_at", "_part", "_before")
    )


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, whole text, label y) of at most per_class training rows for label 0 and as many for 1.

    Training rows are those with a label whose crc32(doc_id as text) mod 5 is not 0; the ones with the smallest
    xxhash64(doc_id) are taken, so that the sample is seeded and needs no sort of the corpus. Ids that are repeated in
    labels count once, with the greatest label; of texts that share an id the one with the smallest xxhash64 counts; null
    ids and labels are left out. Bounds of what is trained on, alike for both labels: texts of more than LONGEST_CHARS
    are no training rows, and of each label the rows in hash order count up to SAMPLE_CHARS / 2 characters together.
    """
    clean = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y"))
    clean = clean.where(F.col("doc_id").isNotNull() & ~held_out("doc_id")).groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = [clean.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    some = F.broadcast(chosen[0].union(chosen[1]))  # 2 * per_class rows at most
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= LONGEST_CHARS)
    texts = texts.join(some, "doc_id").groupBy("doc_id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    turn = Window.partitionBy("y").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # per_class rows at most
    texts = materialize(texts.withColumn("so_far", F.sum(F.length("text")).over(turn)), "sample")
    return texts.where(F.col("so_far") <= SAMPLE_CHARS // 2).select("doc_id", "text", "y")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> list[tuple[object, str, int]]:
    """The rows of labelled_rows(), ordered by id."""
    return sorted(map(tuple, labelled_rows(docs, labels, label, per_class).collect()))


def trained(rows: DataFrame, train: Callable[[list[tuple[object, str, int]]], object]) -> object:
    """train() of the bounded rows of labelled_rows(), ordered by id, run in a task: only the model goes through the driver.

    The texts, and what training holds besides them, would stay in the driver's memory until its session ends.
    """

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = [(i, text.decode(errors="replace"), y) for batch in batches for i, text, y in zip(*(c.to_pylist() for c in batch.columns))]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(sample))], pa.binary())], ["model"])

    ordered = rows.coalesce(1).sortWithinPartitions("doc_id", "text").select("doc_id", F.col("text").cast("binary").alias("text"), "y")
    found = ordered.mapInArrow(fitted, "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else train([])


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def score_rows(docs: DataFrame, text: Column, scorer: Callable[[], Callable[[list], np.ndarray]]) -> DataFrame:
    """(row, score): every row of docs as a struct, with the score of its text.

    scorer() is called once in each task and gives a function from texts to scores. Rows keep all their columns, whatever
    their names, so nothing has to be joined back.
    """
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("score", T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer()
        for batch in batches:
            for s in range(0, batch.num_rows, 1000):
                part = batch.slice(s, 1000)
                values = pa.array(score(x.as_py() for x in part.column(1)), pa.float64())
                yield pa.RecordBatch.from_arrays([part.column(0), values], ["row", "score"])

    return docs.select(whole_row(docs), text.alias("text")).mapInArrow(scored, schema)


def quoted(name: str) -> str:
    """A column's name as F.col() takes it, whatever signs it holds."""
    return "`" + name.replace("`", "``") + "`"


def whole_row(docs: DataFrame) -> Column:
    """(row): all columns as one struct, so that nothing clashes with their names."""
    return F.struct(*(F.col(quoted(c)) for c in docs.columns)).alias("row")


def text_key(text: str) -> Column:
    """What tells rows of one id apart: a hash of the text."""
    return F.xxhash64(F.col(quoted(text)))


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose id and text are not among gone (id, key), where key is text_key() and ids may be null.

    So rows that share an id are judged by their own texts. gone is broadcast only up to IDS rows.
    """
    gone = materialize(gone.select("id", "key").distinct(), "gone")
    few = gone.count() <= IDS
    return _matched(docs, F.broadcast(gone) if few else gone, id_col, text_col, "left_anti").select("row.*")


def only_first(docs: DataFrame, repeated: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row for each of the repeated (id, key): of rows with one id and text the least by a hash of all columns.

    Only rows of repeated keys are moved, as a partial aggregate, so a row that fills a third of the table is no task.
    """
    repeated = materialize(repeated.select("id", "key").distinct(), "repeated")
    few = repeated.count() <= IDS
    if few and repeated.isEmpty():
        return docs
    hinted = F.broadcast(repeated) if few else repeated
    rest = _matched(docs, hinted, id_col, text_col, "left_anti")
    several = _matched(docs, hinted, id_col, text_col, "inner")
    text = F.to_json("row")
    one = several.groupBy("id", "key").agg(F.min_by("row", F.struct(F.xxhash64(text), text)).alias("row")).select("row")
    return rest.select("row").union(one).select("row.*")


def _matched(docs: DataFrame, keys: DataFrame, id_col: str, text_col: str, how: str) -> DataFrame:
    rows = docs.select(whole_row(docs), F.col(quoted(id_col)).alias("_id"), text_key(text_col).alias("_key"))
    return rows.join(keys, F.col("_id").eqNullSafe(F.col("id")) & (F.col("_key") == F.col("key")), how)


class WordTable(dict):
    """word -> its place in a table of `width` numbers for each word; the table grows in steps, and starts anew when it is large."""

    width, most = 1, 300_000

    def __init__(self) -> None:
        super().__init__()
        self.new, self.size, self.table = array("i"), 0, np.empty((1024, self.width), np.int32)

    def numbers(self, word: bytes) -> tuple[int, ...]:
        raise NotImplementedError

    def __missing__(self, word: bytes) -> int:
        place = self.size + len(self.new) // self.width
        self.new.extend(self.numbers(word))
        self[word] = place
        return place

    def at(self, places: np.ndarray) -> np.ndarray:
        if fresh := len(self.new) // self.width:
            if self.size + fresh > len(self.table):
                larger = np.empty((2 * (self.size + fresh), self.width), np.int32)
                larger[: self.size] = self.table[: self.size]
                self.table = larger
            self.table[self.size : self.size + fresh] = np.frombuffer(self.new, np.int32).reshape(-1, self.width)
            self.new, self.size = array("i"), self.size + fresh
        return self.table[places]

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()
            self.new, self.size = array("i"), 0


class Adagrad:
    """Steps of gradient descent that get shorter as a weight's gradients add up; `rows` of an embedding table alone."""

    def __init__(self, rate: float) -> None:
        self.rate, self.seen = rate, {}

    def step(self, key: object, value: np.ndarray, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        total = self.seen.setdefault(key, np.full(value.shape, 1e-6, np.float32))
        at = slice(None) if rows is None else rows
        total[at] += grad * grad
        value[at] -= self.rate * grad / np.sqrt(total[at])
