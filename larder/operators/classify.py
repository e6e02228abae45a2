"""Product labelling: keyword rules, a keyword TF-IDF label scorer, and the
hybrid overlay (scored sample wins, rules fill the rest).

The scorer stands in for a hosted zero-shot model: it is a pure Spark job
(explode, group-by, equi-joins, one window) whose keyword table is input data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder import constants as C
from larder.functions import dealt, join_small, regex_rule, substring_rule, task_count
from larder.session import scratch_dir

# --------------------------------------------------------------------------- J6


def classify_rules(
    df: DataFrame,
    theme_rules: Sequence[tuple[str, str]] = C.THEME_RULES,
    demand_rules: Sequence[tuple[str, str]] = C.DEMAND_RULES,
) -> DataFrame:
    """Adds ``fallback_product_theme`` (substring rules on department) and
    ``fallback_demand_type`` (regex rules on product name)."""
    return df.withColumn(
        "fallback_product_theme", substring_rule("department", theme_rules, C.THEME_DEFAULT)
    ).withColumn("fallback_demand_type", regex_rule("product_name", demand_rules, C.DEMAND_DEFAULT))


# --------------------------------------------------------------------------- J5


def keyword_table(spark: SparkSession, tables: Mapping[str, tuple[Mapping[str, str], Sequence[str]]]) -> DataFrame:
    """(task, label, pos, keyword) rows from ``{task: (keywords, labels)}``;
    ``pos`` is the label's place in its label list (the tie-break)."""
    rows = [
        (task, label, labels.index(label), kw)
        for task, (keywords, labels) in tables.items()
        for label, words in keywords.items()
        for kw in dict.fromkeys(words.split())
    ]
    return spark.createDataFrame(rows, "task string, label string, pos int, keyword string")


def tokens(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, token) for each letter run of length > 2 in ``lower(text)``."""
    return (
        df.select(id_col, F.explode(F.split(F.lower(F.col(text_col)), "[^a-z]+")).alias("token"))
        .filter(F.length("token") > 2)
    )


def classify_labels(
    df: DataFrame,
    id_col: str,
    text_col: str,
    keywords: DataFrame,
    digits: int = C.LABEL_SCORE_DIGITS,
) -> DataFrame:
    """Best label per (row, task) by TF-IDF cosine between the text and each
    label's keywords; ``keywords`` holds (task, label, pos, keyword).

    ``idf = ln((1+N)/(1+df)) + 1`` over the input texts (1 for an unseen
    keyword); score = Σ tf·idf² / (‖doc‖·‖label‖), rounded to ``digits``;
    ties go to the earlier label.  Returns (id, task, label) for rows with at
    least one keyword hit.  Every step is a shuffle-based aggregate or join;
    the keyword table is small input data and is broadcast.  Several label
    tables (tasks) share one tokenisation and one idf; both are written once
    and read by all later steps.  The idf joins by a size-checked broadcast;
    beyond the limit both sides are plain shuffles of written tables, which
    AQE can split where a token is hot.  Many texts are dealt by id over as many
    tasks as their rows and tokens need, which serves every aggregate, join and
    window on the id.
    """
    spark = df.sparkSession

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = scratch_dir(spark, f"labels-{name}")
        frame.write.parquet(path)
        return spark.read.parquet(path)

    n_docs = df.count()
    texts = dealt(df.select(id_col, text_col), task_count(spark, n_docs), id_col)
    tf = written(tokens(texts, id_col, text_col).groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("tf")), "tf")
    tasks = task_count(spark, tf.count())
    idf = written(tf.groupBy("token").agg(F.count(F.lit(1)).alias("df")).select(
        "token", (F.log(F.lit(1 + n_docs) / (F.lit(1) + F.col("df"))) + F.lit(1.0)).alias("idf")
    ), "idf")
    tf_idf = join_small(tf, idf, "token", "inner")
    doc_norm = dealt(tf_idf, tasks, id_col).groupBy(id_col).agg(
        F.sqrt(F.sum((F.col("tf") * F.col("idf")) ** 2)).alias("doc_norm")
    )
    # idf is unique per token, so the matched rows are bounded by the keyword
    # table and may be broadcast back onto it.
    key = ["task", "label", "pos", "keyword"]
    seen = idf.join(F.broadcast(keywords), F.col("token") == F.col("keyword")).select(*key, "idf")
    kw = keywords.join(F.broadcast(seen), key, "left").select(
        *key, F.coalesce(F.col("idf"), F.lit(1.0)).alias("kw_idf")
    )
    label_norm = kw.groupBy("task", "label").agg(F.sqrt(F.sum(F.col("kw_idf") ** 2)).alias("label_norm"))
    hits = dealt(tf_idf.join(F.broadcast(kw), F.col("token") == F.col("keyword")), tasks, id_col)
    scores = (
        hits.groupBy(id_col, "task", "label", "pos")
        .agg(F.sum(F.col("tf") * F.col("kw_idf") * F.col("kw_idf")).alias("dot"))
        .join(doc_norm, id_col)
        .join(F.broadcast(label_norm), ["task", "label"])
        .select(
            id_col, "task", "label", "pos",
            F.round(F.col("dot") / (F.col("doc_norm") * F.col("label_norm")), digits).alias("score"),
        )
    )
    w = Window.partitionBy(id_col, "task").orderBy(F.desc("score"), F.asc("pos"))
    return scores.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(id_col, "task", "label")


# --------------------------------------------------------------------------- J7


def named_products(dim_product: DataFrame) -> DataFrame:
    """All products with a name (one without has no text to label)."""
    return dim_product.select("product_id", "product_name", "aisle", "department").filter(F.col("product_name").isNotNull())


def sample_products(dim_product: DataFrame, sample_size: int = C.MODEL_SAMPLE_SIZE) -> DataFrame:
    """The ``sample_size`` lowest product ids with a name (a top-k by design,
    for the overlay alone)."""
    return named_products(dim_product).orderBy("product_id").limit(sample_size)


def model_labels(spark: SparkSession, products: DataFrame, default: str = "other", models: Mapping | None = None) -> DataFrame:
    """Theme and demand type for each of ``products`` by the keyword scorer (one
    pass for both label tables); no keyword hit gives ``default``.

    ``models`` ({column: model}, see ``label_model``) labels the names instead;
    the method recorded is then the models' name."""
    if models is not None:
        from larder.operators.label_model import model_table

        return model_table(products, models, default=default).select(
            "product_id", "ai_product_theme", "ai_demand_type",
            F.lit("+".join(dict.fromkeys(m.name for m in models.values()))).alias("classification_method"),
            F.current_timestamp().alias("ai_classified_ts"))
    kw = keyword_table(
        spark,
        {
            "ai_product_theme": (C.THEME_KEYWORDS, C.PRODUCT_THEMES),
            "ai_demand_type": (C.DEMAND_KEYWORDS, C.DEMAND_TYPES),
        },
    )
    best = classify_labels(products, "product_id", "product_name", kw)
    wide = best.groupBy("product_id").agg(
        *[F.max(F.when(F.col("task") == t, F.col("label"))).alias(t) for t in ("ai_product_theme", "ai_demand_type")]
    )
    return (
        products.select("product_id")
        .join(wide, "product_id", "left")
        .select(
            "product_id",
            *[F.coalesce(F.col(t), F.lit(default)).alias(t) for t in ("ai_product_theme", "ai_demand_type")],
            F.lit(C.METHOD_MODEL).alias("classification_method"),
            F.current_timestamp().alias("ai_classified_ts"),
        )
    )


def classify_overlay(dim_product: DataFrame, labelled: DataFrame) -> DataFrame:
    """Rules on every product; the labelled sample overrides them (left join on id)."""
    ai = labelled.select(
        "product_id",
        F.col("ai_product_theme").alias("sample_ai_product_theme"),
        F.col("ai_demand_type").alias("sample_ai_demand_type"),
        "classification_method",
        "ai_classified_ts",
    )
    ruled = classify_rules(dim_product)
    return join_small(ruled, ai, "product_id", "left").select(
        "product_id", "product_name", "aisle_id", "aisle", "department_id", "department",
        F.coalesce("sample_ai_product_theme", "fallback_product_theme").alias("ai_product_theme"),
        F.coalesce("sample_ai_demand_type", "fallback_demand_type").alias("ai_demand_type"),
        F.coalesce(F.col("classification_method"), F.lit(C.METHOD_RULES)).alias("classification_method"),
        F.coalesce(F.col("ai_classified_ts"), F.current_timestamp()).alias("ai_classified_ts"),
        "is_current", "valid_from", "valid_to", "silver_updated_ts",
    )


def classify_hybrid(spark: SparkSession, dim_product: DataFrame, sample_size: int = C.MODEL_SAMPLE_SIZE,
                    models: Mapping | None = None) -> DataFrame:
    """dim_product_ai: scored sample of ``sample_size`` products (by ``models``
    if given), rules for the rest."""
    return classify_overlay(dim_product, model_labels(spark, sample_products(dim_product, sample_size), models=models))
