"""Line dedup by levelled sorted runs of line hashes (operator 12): DataFrame functions only.

Batches of documents come in falling order of doc_id. A batch's line keys, counted by document, are anti-joined
with the runs: a key that none of them holds gets its owner here, the batch's largest document with it. The batch
then becomes a run of its own. ``fanout`` runs of a level are merged into one of the next, so a batch meets a
number of runs that grows with the logarithm of the number of batches. Runs are bucketed by key and sorted in each
bucket: neither a merge nor an anti-join moves a run's rows.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.functions.staging import checkpoint_dir, staged, unstage
from strandline.llm.textbytes import free_name

#: The white space of the contract, and A-Z to a-z.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

KEY = ["_k1", "_k2"]


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


class Runs:
    """Sorted runs of (key, docs, owner) in levels; ``docs`` counts documents and ``owner`` is the largest one.

    Each run is a table of ``buckets`` buckets in the shared checkpoint folder. A run is written before
    it is used and dropped once merged, so a lost executor costs a task and no run.
    """

    def __init__(self, spark, fanout: int = 3, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[DataFrame]] = []

    def _written(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        path = f"{checkpoint_dir(self.spark)}/{name}"
        rows.repartition(self.buckets, *KEY).write.format("parquet").bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).saveAsTable(name)
        run = self.spark.table(name)
        run.staged_path, run.name = path, name
        return run

    def _dropped(self, run: DataFrame) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run.name}")
        unstage(run)

    def _merged(self, a: DataFrame, b: DataFrame) -> DataFrame:
        """Two runs as one: a merge join of their buckets, without an exchange."""
        b = b.select(*KEY, F.col("docs").alias("_d"), F.col("owner").alias("_o"))
        both = a.join(b, KEY, "full_outer")
        return both.select(*KEY, (F.coalesce("docs", F.lit(0)) + F.coalesce("_d", F.lit(0))).alias("docs"), F.coalesce("owner", "_o").alias("owner"))

    def all(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> None:
        """Takes a batch of (key, docs, owner), one row a key; owners stay those of the runs that came earlier."""
        for run in self.all():
            held = run.where("owner is not null").select(*KEY, F.lit(True).alias("_held"))
            batch = batch.join(held, KEY, "left").withColumn("owner", F.when(F.col("_held").isNull(), F.col("owner"))).drop("_held")
        self._push(0, self._written(batch))

    def _push(self, level: int, run: DataFrame) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._compacted(full))

    def _compacted(self, runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for run in runs[1:]:
            rows = self._merged(rows, run)
        out = self._written(rows)
        for run in runs:
            self._dropped(run)
        return out

    def final(self) -> DataFrame:
        """All runs as one table (_k1, _k2, docs, owner)."""
        if len(runs := self.all()) > 1:
            self.levels = [[self._compacted(runs)]]
        return self.all()[0]

    def close(self) -> None:
        for run in self.all():
            self._dropped(run)
        self.levels = []


def line_table(docs: DataFrame, least_chars: int) -> DataFrame:
    """_id, _text (hash), _pos and the 128-bit key of each line of at least ``least_chars`` code points."""
    lines = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_text"), F.posexplode(F.split("text", "\n", -1)).alias("_pos", "_line"))
    kept = lines.withColumn("_line", line_key(F.col("_line"))).where(F.length("_line") >= least_chars)
    return kept.select("_id", "_text", "_pos", F.xxhash64("_line").alias("_k1"), F.xxhash64(F.lit(1), "_line").alias("_k2"))


def bounds(docs: DataFrame, batches: int) -> list:
    """The doc_ids, in falling order, that begin each batch but the last: about as many rows in each."""
    shares = [i / batches for i in range(batches - 1, 0, -1)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 1000).alias("at")).first().at if shares else None
    return sorted(set(found or []), reverse=True)


def repeated_lines(lines: DataFrame, cuts: list, least_docs: int, fanout: int = 3) -> DataFrame:
    """_k1, _k2, owner of the keys in at least ``least_docs`` documents; ``lines`` is the staged table of lines."""
    runs = Runs(lines.sparkSession, fanout)
    top = None
    for low in [*cuts, None]:
        part = F.lit(True) if low is None else F.col("_id") > F.lit(low)
        part = part if top is None else (F.col("_id").isNull() | (F.col("_id") <= F.lit(top)) if low is None else part & (F.col("_id") <= F.lit(top)))
        own = lines.where(part).groupBy(*KEY, "_id").agg(F.lit(1).alias("_one"))
        runs.add(own.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.max("_id").alias("owner")))
        top = low
    out = staged(runs.final().where(F.col("docs") >= least_docs).select(*KEY, "owner"))
    runs.close()
    return out


def dedup_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, batches: int = 4, fanout: int = 3, names: tuple[str, str] = ("n_lines", "n_dropped")) -> DataFrame:
    """``docs`` with the repeated lines out of ``text``; n_lines counts the lines before, n_dropped those that went.

    A text is split at ``\\n``; a line's key is as in line_key(). Keys of at least ``least_chars`` code points in at
    least ``least_docs`` documents lose all their lines, but for those of the largest doc_id that holds them. Lines of
    a key that stands several times in that document all stay. Null and empty texts are one empty line (a null text
    stays null); rows alike in doc_id are one document, and a null doc_id is one, the smallest; equal rows are treated
    alike; an empty table gives an empty one; texts of any length are whole. Other columns stay as they are, whatever
    their names; the new ones give way to them by underscores. Keys are known by 128-bit hashes. doc_id is a number.
    """
    lines = staged(line_table(docs, least_chars))
    repeated = repeated_lines(lines, bounds(docs, batches), least_docs, fanout)
    gone = lines.join(repeated, KEY).where(~F.col("_id").eqNullSafe(F.col("owner"))).groupBy("_id", "_text").agg(F.collect_set("_pos").alias("_gone"))
    gone = staged(gone)
    unstage(lines, repeated)
    n_lines, n_dropped = (free_name(docs, n) for n in names)
    own = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*own.values())
    text = own[next(c for c in docs.columns if c.lower() == "text")]
    doc = own[next(c for c in docs.columns if c.lower() == "doc_id")]
    rows = rows.withColumn("_h", F.xxhash64(text)).withColumn("_lines", F.split(F.coalesce(text, F.lit("")), "\n", -1))
    rows = rows.join(gone, F.col(doc).eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_text")), "left")
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    kept = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(F.array_join(F.transform(stay, lambda i: F.get("_lines", i)), "\n"))
    size = F.coalesce(F.size("_gone"), F.lit(0))
    out = rows.select(*[kept.alias(v) if v == text else F.col(v) for v in own.values()], F.size("_lines").cast("long").alias("_n"), F.when(F.col("_gone").isNull(), 0).otherwise(size).cast("long").alias("_m"))
    return out.toDF(*own, n_lines, n_dropped)
