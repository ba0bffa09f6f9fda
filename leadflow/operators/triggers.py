"""Buying signals: new business, ownership change, review complaints, same-day queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from leadflow.config import DEFAULT, Config


def new_business(regs: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    return regs.select("fsa_id", "days_since_registration", (F.col("days_since_registration") < cfg.new_days).alias("new_business"))


CATEGORIES = ("supply", "stock", "quality", "consistency")  # fixed values, in order of report


def lexicon_table(spark: SparkSession, cfg: Config = DEFAULT) -> DataFrame:
    return spark.createDataFrame(list(cfg.lexicon), "term string, category string, negated boolean")


def complaint_terms(reviews: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Adds `terms`: (term, negated) of the lexicon's words in a review, in order; negated: a negation
    stands among the few words before it. Texts are read once; only the few terms leave the row."""
    words = F.array_remove(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z']+"), "")
    known, window = [t for t, _, _ in cfg.lexicon], cfg.negation_window
    no = F.array(*[F.lit(n) for n in cfg.negations])
    at = F.filter(F.transform("_words", lambda w, i: F.struct(w.alias("term"), i.alias("at"))), lambda x: x["term"].isin(known))
    before = lambda x: F.slice("_words", F.greatest(x["at"] + 1 - window, F.lit(1)), F.least(x["at"], F.lit(window)))
    return reviews.withColumn("_words", words).withColumn("terms", F.transform(at, lambda x: F.struct(x["term"].alias("term"), F.arrays_overlap(before(x), no).alias("negated")))).drop("_words")


def complaints(reviews: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """(premises_no, source, review_date, review, category, term) of recent reviews: a row for each
    category and term that a review complains of."""
    recent = reviews.filter(F.col("age_days") < cfg.window_days).withColumn("review", F.xxhash64("source", "text", "age_days"))
    day = F.date_sub(F.lit(cfg.as_of).cast("date"), F.col("age_days").cast("int"))
    hits = complaint_terms(recent, cfg).select("premises_no", "source", day.alias("review_date"), "review", F.explode("terms").alias("t")).select("premises_no", "source", "review_date", "review", "t.*")
    return hits.join(F.broadcast(lexicon_table(reviews.sparkSession, cfg)), ["term", "negated"]).select("premises_no", "source", "review_date", "review", "category", "term").distinct()  # a row per term of the lexicon


def mine_reviews(reviews: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Per premises: complaining reviews of the window, in all and by category, the latest of them, its
    source and date, and the terms."""
    per_review = complaints(reviews, cfg).groupBy("premises_no", "source", "review_date", "review").agg(F.collect_set("category").alias("categories"), F.collect_set("term").alias("terms"))
    last = F.struct("review_date", "source")
    by = [F.count_if(F.array_contains("categories", c)).alias(c) for c in CATEGORIES]
    return per_review.groupBy("premises_no").agg(
        F.count("*").alias("hits"), F.max_by("source", last).alias("source"), F.max("review_date").alias("review_date"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))), ",").alias("terms"), *by
    )


def review_snippet(hits: DataFrame) -> DataFrame:
    """A paraphrase in at most 200 characters: reviews by category, no word of a review."""
    counts = F.concat_ws(", ", *[F.when(F.col(c) > 0, F.format_string(f"{c} %d", c)) for c in CATEGORIES])
    return hits.withColumn("snippet", F.substring(F.format_string("%d recent review(s) complain: %s", "hits", counts), 1, 200))


def lead_triggers(new: DataFrame, ownership: DataFrame, reviews: DataFrame) -> DataFrame:
    """(lead_key, trigger_type, snippet, trigger_date): each input has lead_key, snippet, trigger_date."""
    typed = lambda df, t: df.select("lead_key", F.lit(t).alias("trigger_type"), "snippet", "trigger_date")
    return typed(new, "new_fsa").unionByName(typed(ownership, "ownership_change")).unionByName(typed(reviews, "review_complaint"))


def points(cfg: Config = DEFAULT) -> dict[str, int]:
    return {"new_fsa": cfg.points_new, "ownership_change": cfg.points_ownership, "review_complaint": cfg.points_review}


def trigger_bonus(triggers: DataFrame, key: str = "lead_key", cfg: Config = DEFAULT) -> DataFrame:
    worth = F.lit(0)
    for t, p in points(cfg).items():
        worth = F.when(F.col("trigger_type") == t, p).otherwise(worth)
    return triggers.select(key, "trigger_type").distinct().groupBy(key).agg(F.sum(worth).alias("bonus"))


def urgency(age, cfg: Config = DEFAULT):
    return F.when(age <= cfg.urgent_days, "high").when(age <= cfg.medium_days, "medium").otherwise("low")


def same_day_queue(signals: DataFrame, as_of: str, cfg: Config = DEFAULT) -> DataFrame:
    """The most urgent signal of each lead: the latest, ties by type."""
    age = F.datediff(F.lit(as_of).cast("date"), F.to_date("ts")).cast("bigint")
    order = W.partitionBy("lead_no").orderBy(F.desc("ts"), "trigger_type")
    out = signals.filter("lead_no is not null").withColumn("r", F.row_number().over(order)).filter("r = 1")
    return out.select("lead_no", "trigger_type", age.alias("age_days"), urgency(age, cfg).alias("urgency"))
