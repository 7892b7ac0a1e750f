"""Machine learning on the fact table.

Only MLlib and DataFrame aggregates.  Per-class tables (counts, weights,
test sizes) are one row per label value, so they are the only frames joined
by broadcast; every per-row decision (split membership, weight) is a column
expression over the distributed rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params as P
from ..functions import split_hash
from ..session import scratch_path


def _all() -> Window:
    """Window over a whole per-class table (k rows, one per label)."""
    return Window.partitionBy()


# --- M1 / M2 -------------------------------------------------------------

def prepare_features(df: DataFrame, label: str = P.LABEL,
                     id_columns: Sequence[str] = tuple(P.ID_COLUMNS)) -> tuple[DataFrame, list[str], list[str]]:
    """M1: drop rows without label; features = every column except label and
    ids.  Returns (frame, feature columns, categorical columns)."""
    out = df.dropna(subset=[label])
    feats = [c for c in out.columns if c != label and c not in id_columns]
    cats = [f.name for f in out.schema.fields
            if f.name in feats and isinstance(f.dataType, T.StringType)]
    return out, feats, cats


def label_encoder(columns: Sequence[str]) -> StringIndexer:
    """M2: sorted distinct values -> 0..n-1 (alphabetical, like a label
    encoder); NULL / unseen values get index n."""
    return StringIndexer(inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns],
                         stringOrderType="alphabetAsc", handleInvalid="keep")


def encoding_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """M2 as a table (column, value, index): the alphabetical rank of each
    distinct non-NULL value, the same indices the fitted encoder assigns.
    Distinct values are dealt into ranges of (column, value) and stored with
    their range; a value's index is its rank within its range and column, plus
    the column's values in the ranges before, so no task holds a whole column."""
    spark = df.sparkSession
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("kv")).select("kv.column", "kv.value")
    ranged = (long.filter(F.col("value").isNotNull()).distinct().repartitionByRange("column", "value")
              .withColumn("range", F.spark_partition_id()))
    path = scratch_path(spark, "dictionary")
    ranged.write.parquet(path)                      # a range's bounds are drawn once
    ranged = spark.read.schema(ranged.schema).parquet(path)
    counts = ranged.groupBy("column", "range").agg(F.count(F.lit(1)).alias("n"))       # one row per range and column
    before = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("column", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("range", "column").orderBy("value")) - 1
    return (ranged.withColumn("rank", rank).join(offsets, ["column", "range"])
            .select("column", "value", (F.col("offset") + F.col("rank")).cast("int").alias("index")))


# --- M3 / M4 / M5 ----------------------------------------------------------

def class_counts(df: DataFrame, label: str = P.LABEL) -> DataFrame:
    """Per-class row counts (A7 without NULL)."""
    return df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))


def split_plan(df: DataFrame, label: str = P.LABEL, default: float = P.DEFAULT_TEST_SIZE,
               cap: float = P.MAX_TEST_SIZE, min_positive: int = P.MIN_POSITIVE_IN_TEST) -> DataFrame:
    """M3 and the quotas of M4, one row per class: n_classes, minority_count,
    test_size, whether the split is stratified, and the test rows to take.

    ``test_size`` is max(default, min_positive / minority), at most ``cap``; the
    default for a single class.  A stratified split takes ceil(test_size * n)
    rows in all, dealt to the classes by largest remainder, one row of each at
    least and never all; otherwise ceil(default * n) of the whole table."""
    one = F.col("n_classes") < 2
    plan = (class_counts(df, label)
            .withColumn("n_classes", F.count(F.lit(1)).over(_all()))
            .withColumn("minority_count", F.min("n_class").over(_all()))
            .withColumn("n_rows", F.sum("n_class").over(_all()))
            .withColumn("test_size", F.when(one, F.lit(default)).otherwise(F.least(
                F.greatest(F.lit(default), F.lit(float(min_positive)) / F.col("minority_count")), F.lit(cap))))
            .withColumn("stratified", ~one & (F.col("minority_count") >= 2))
            .withColumn("take_all", F.ceil(F.round(
                F.when(F.col("stratified"), F.col("test_size")).otherwise(F.lit(default)) * F.col("n_rows"), 6))))
    share = F.col("take_all") * F.col("n_class")                 # in n_rows-ths
    base = F.floor(share / F.col("n_rows"))
    plan = plan.withColumn("base", base).withColumn("rest", share - base * F.col("n_rows"))
    extra = F.row_number().over(_all().orderBy(F.desc("rest"), label)) <= F.col("take_all") - F.sum("base").over(_all())
    of_class = F.least(F.greatest(F.col("base") + extra.cast("long"), F.lit(1)), F.col("n_class") - 1)
    of_table = F.greatest(F.least(F.col("take_all"), F.col("n_rows") - 1), F.lit(1))
    return (plan.withColumn("quota", F.when(F.col("stratified"), of_class).otherwise(of_table).cast("long"))
                .drop("take_all", "base", "rest"))


def choose_test_size(df: DataFrame, label: str = P.LABEL, **kw) -> DataFrame:
    """M3 as one row: n_classes, minority_count, stratified, test_size."""
    return (split_plan(df, label, **kw)
            .select("n_classes", "minority_count", "stratified", "test_size").distinct())


def stratified_split(df: DataFrame, keys: Sequence[str] = tuple(P.ID_COLUMNS),
                     label: str = P.LABEL, seed: int = P.SEED, **kw) -> DataFrame:
    """M4: adds ``is_test``, exactly ``quota`` rows of each stratum (class, or the
    whole table when not stratified), by rank of a seeded hash of the key.

    No stratum is ranked whole: rows are counted by hash prefix, the running
    count finds the prefix in which the quota ends, rows before it are test rows,
    and only the rows of that prefix (one in 4,096) are ranked."""
    plan = split_plan(df, label, **kw).select(label, "stratified", "quota")
    rows = (df.filter(F.col(label).isNotNull()).join(F.broadcast(plan), label)      # one row per class
            .withColumn("_h", split_hash(*keys, seed=seed)).withColumn("_p", F.substring("_h", 1, 3))
            .withColumn("_stratum", F.when(F.col("stratified"), F.col(label).cast("string")).otherwise(F.lit("*"))))
    counts = rows.groupBy("_stratum", "_p").agg(F.count(F.lit(1)).alias("n"), F.max("quota").alias("q"))
    upto = F.sum("n").over(Window.partitionBy("_stratum").orderBy("_p"))
    cut = (counts.withColumn("upto", upto).filter((F.col("upto") >= F.col("q")) & (F.col("upto") - F.col("n") < F.col("q")))
           .select("_stratum", F.col("_p").alias("_cut"), (F.col("q") - F.col("upto") + F.col("n")).alias("_need")))
    placed = rows.join(F.broadcast(cut), "_stratum")                                # one row per stratum
    sure = placed.filter(F.col("_p") != F.col("_cut")).withColumn("is_test", F.col("_p") < F.col("_cut"))
    rank = F.row_number().over(Window.partitionBy("_stratum").orderBy("_h", *keys))
    edge = placed.filter(F.col("_p") == F.col("_cut")).withColumn("is_test", rank <= F.col("_need"))
    return sure.unionByName(edge).select(*df.columns, "is_test")


def class_weights(train: DataFrame, label: str = P.LABEL) -> DataFrame:
    """M5: balanced weight n / (k * n_c) per class, from the training rows."""
    counts = class_counts(train, label)
    n = F.sum("n_class").over(_all())
    k = F.count(F.lit(1)).over(_all())
    return counts.withColumn("weight", n.cast("double") / (k * F.col("n_class")).cast("double"))


def with_weights(train: DataFrame, label: str = P.LABEL, weight_col: str = "weight") -> DataFrame:
    w = class_weights(train, label).select(label, F.col("weight").alias(weight_col))
    return train.join(F.broadcast(w), label, "left")        # one row per class


# --- M6 / M7 ---------------------------------------------------------------

def fit_forest(train: DataFrame, features: Sequence[str], encoder: StringIndexerModel | None,
               label: str = P.LABEL, keys: Sequence[str] = tuple(P.ID_COLUMNS), num_trees: int = P.NUM_TREES,
               seed: int = P.SEED, partitions: int | None = None) -> PipelineModel:
    """M5 + M6: encoder, assembler and forest in one PipelineModel.  ``encoder``
    is fitted on all rows (``fit_encoder``), so a value's code does not depend on
    the split; maxBins follows from its largest dictionary.  Rows are
    hash-partitioned (``partitions``, the session's shuffle partitions by
    default) and sorted by key first: MLlib's seeded sampling depends on it."""
    partitions = partitions or int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    coded = dict(zip(encoder.getInputCols(), encoder.getOutputCols())) if encoder else {}
    most = max([32, *(len(labels) + 1 for labels in encoder.labelsArray)]) if encoder else 32
    data = (with_weights(train, label).withColumn(label, F.col(label).cast("double"))
            .repartition(partitions, *keys).sortWithinPartitions(*keys))
    assembler = VectorAssembler(inputCols=[coded.get(c, c) for c in features], outputCol="features",
                                handleInvalid="keep")
    # no depth limit in the reference; 30 is MLlib's maximum
    forest = RandomForestClassifier(featuresCol="features", labelCol=label, weightCol="weight", numTrees=num_trees,
                                    seed=seed, maxDepth=30, maxBins=most, cacheNodeIds=True, maxMemoryInMB=512)
    stages = [*([encoder] if encoder else []), assembler]
    # a copy has no training summary: that holds the session, which can't be sent to
    # tasks once the session has observed metrics
    return PipelineModel([*stages, forest.fit(PipelineModel(stages).transform(data)).copy()])


def fit_encoder(df: DataFrame, categorical: Sequence[str]) -> StringIndexerModel | None:
    """M2 fitted on every row, before the split."""
    return label_encoder(categorical).fit(df) if categorical else None


def predict(model: PipelineModel, df: DataFrame, label: str = P.LABEL) -> DataFrame:
    """M7: adds an integer ``prediction``."""
    out = model.transform(df.withColumn(label, F.col(label).cast("double")))
    return out.withColumn(label, F.col(label).cast("int")).withColumn(
        "prediction", F.col("prediction").cast("int"))


# --- M8 / M9 / M10 / M11 -----------------------------------------------------

def accuracy(df: DataFrame, label: str = P.LABEL, prediction: str = "prediction") -> DataFrame:
    """M8."""
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).alias("n"))


def confusion_matrix(spark: SparkSession, df: DataFrame, label: str = P.LABEL,
                     prediction: str = "prediction", labels: Sequence[int] = (0, 1)) -> DataFrame:
    """M9: counts on the fixed label grid (missing cells are 0)."""
    grid = spark.createDataFrame([(a, b) for a in labels for b in labels],
                                 f"{label} int, {prediction} int")
    counts = (df.groupBy(F.col(label).cast("int").alias(label),
                         F.col(prediction).cast("int").alias(prediction))
                .agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col(label).isin(*labels) & F.col(prediction).isin(*labels)))
    return (grid.join(F.broadcast(counts), [label, prediction], "left")
                .select(label, prediction, F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(F.lit(0.0))


def classification_report(confusion: DataFrame, label: str = P.LABEL,
                          prediction: str = "prediction",
                          labels: Sequence[int] = (0, 1)) -> DataFrame:
    """M10 from the M9 counts: per-class precision / recall / F1 / support
    (0 on an empty denominator), plus accuracy, macro and weighted means.

    One aggregate turns the k x k counts into a single row of cells; every
    report row is then an expression over that row (one explode), so the
    upstream plan runs once."""
    lab, pred, n = F.col(label), F.col(prediction), F.col("n")
    cells = []
    for c in labels:
        cells += [F.sum(F.when(lab == c, n).otherwise(0)).alias(f"s{c}"),
                  F.sum(F.when(pred == c, n).otherwise(0)).alias(f"p{c}"),
                  F.sum(F.when((lab == c) & (pred == c), n).otherwise(0)).alias(f"t{c}")]
    row = confusion.agg(*cells)
    per = []
    for c in labels:
        prec = _safe_div(F.col(f"t{c}"), F.col(f"p{c}"))
        rec = _safe_div(F.col(f"t{c}"), F.col(f"s{c}"))
        f1 = F.when(prec + rec > 0, F.lit(2.0) * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
        per.append((str(c), prec, rec, f1, F.col(f"s{c}")))
    total = sum((F.col(f"s{c}") for c in labels[1:]), F.col(f"s{labels[0]}"))
    tp = sum((F.col(f"t{c}") for c in labels[1:]), F.col(f"t{labels[0]}"))
    k = float(len(labels))

    def mean(i):
        return sum((p[i] for p in per[1:]), per[0][i]) / F.lit(k)

    def weighted(i):
        return _safe_div(sum((p[i] * p[4] for p in per[1:]), per[0][i] * per[0][4]), total)

    none = F.lit(None).cast("double")

    def line(name, prec, rec, f1, support):
        return F.struct(F.lit(name).alias("class_label"), prec.alias("precision"),
                        rec.alias("recall"), f1.alias("f1_score"),
                        support.cast("long").alias("support"))

    rows = [line(*p) for p in per]
    rows += [line("accuracy", none, none, _safe_div(tp, total), total),
             line("macro avg", mean(1), mean(2), mean(3), total),
             line("weighted avg", weighted(1), weighted(2), weighted(3), total)]
    return row.select(F.inline(F.array(*rows)))


def class_distribution(split: DataFrame, label: str = P.LABEL) -> DataFrame:
    """Rows per class, overall and per side of the split."""
    sides = split.select(F.when(F.col("is_test"), F.lit("test")).otherwise(F.lit("train")).alias("split"), label)
    overall = split.select(F.lit("all").alias("split"), label)
    return (overall.unionByName(sides).groupBy("split", label)
                   .agg(F.count(F.lit(1)).alias("n")))


def save_model(model: PipelineModel, path: str) -> str:
    """K7."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
