"""Multi-step model work on top of ``external.call``: second passes, audits, reranking, and rounds of review.

Every step is a DataFrame of the rows that still need it, so a round calls a model for those only; models are parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scoring import ACCEPT_FROM, REDO_BELOW
from tessera.streaming.external import Model, call, parsed, stub

DISTILLED = "summary string, bullets array<struct<category: string, phenotype: string>>"
AUDIT = "verdict string, completeness_score double, accuracy_score double, citation_score double, hallucinations array<string>, missed_phenotypes array<string>"
RANKING = "ranking array<struct<fbgn: string, verdict: string, reasoning: string>>"


def two_passes(rows: DataFrame, key: str, prompt: str, is_complex: Column, first: Model = stub, second: Model = stub, schema: str = DISTILLED) -> DataFrame:
    """key, passes, outcome, value: complex rows are answered again with the first answer in the prompt; a second answer without bullets is not taken."""
    one = call(rows, key, prompt, first)
    asked = rows.select(F.col(key).cast("string").alias("key"), F.col(prompt).alias("prompt"), F.coalesce(is_complex, F.lit(False)).alias("complex"))
    again = asked.where("complex").join(one.select("key", "answer"), "key")
    again = again.select("key", F.concat_ws("\n", "prompt", F.lit("Refine this earlier answer:"), "answer").alias("prompt"))
    a, b = parsed(one, schema), parsed(call(again, "key", "prompt", second), schema)
    both = a.join(b.select("key", F.col("value").alias("better"), F.col("outcome").alias("then")), "key", "left")
    take = F.coalesce((F.col("then") == "ok") & (F.size("better.bullets") > 0), F.lit(False))
    return both.select("key", F.when(F.col("then").isNull(), 1).otherwise(2).alias("passes"), "outcome", F.when(take, F.col("better")).otherwise(F.col("value")).alias("value"))


def audit(rows: DataFrame, key: str, prompt: str, model: Model, attempts: int = 4) -> DataFrame:
    """key, outcome, verdict (accept, minor_fixes, redistill; error without an answer), scores and counts of findings."""
    got = parsed(call(rows, key, prompt, model, attempts), AUDIT)
    n = lambda c: F.greatest(F.size(f"value.{c}"), F.lit(0)).alias(f"n_{c}")
    return got.select("key", "outcome", F.coalesce("value.verdict", F.lit("error")).alias("verdict"), "value.completeness_score", "value.accuracy_score", "value.citation_score", n("hallucinations"), n("missed_phenotypes"))


def run_audits(rows: DataFrame, key: str, prompt: str, model: Model, path: str) -> DataFrame:
    """Audit the rows that have no result below ``path`` yet and append theirs as JSON lines; the whole log comes back."""
    spark = rows.sparkSession
    schema = "key string, outcome string, verdict string, completeness_score double, accuracy_score double, citation_score double, n_hallucinations int, n_missed_phenotypes int"
    done = spark.read.schema(schema).option("ignoreMissingFiles", True).json(path) if _exists(rows, path) else spark.createDataFrame([], schema)
    audit(rows.join(done.select(F.col("key").alias(key)), key, "left_anti"), key, prompt, model).write.mode("append").json(path)
    return spark.read.schema(schema).json(path)


def _exists(df: DataFrame, path: str) -> bool:
    sc = df.sparkSession.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(sc._jsc.hadoopConfiguration()).exists(place)


def verdict_counts(audits: DataFrame) -> DataFrame:
    return audits.groupBy("verdict").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "verdict")


def rerank(candidates: DataFrame, phenotype: str, profile: list[str], model: Model = stub) -> DataFrame:
    """phenotype, place, fbgn, verdict: one question for each phenotype with the profiles of its candidates, a list that a ranking has cut."""
    shown = F.to_json(F.struct("fbgn", *profile))
    asked = candidates.groupBy(phenotype).agg(F.array_join(F.array_sort(F.collect_list(shown)), "\n").alias("profiles"))
    asked = asked.select(F.col(phenotype).alias("key"), F.concat_ws("\n", F.lit("Target:"), phenotype, F.lit("Candidates:"), "profiles").alias("prompt"))
    got = parsed(call(asked, "key", "prompt", model), RANKING)
    each = got.select(F.col("key").alias(phenotype), F.posexplode(F.col("value.ranking")).alias("place", "r"))
    return each.select(phenotype, (F.col("place") + 1).alias("place"), "r.fbgn", "r.verdict")


def review(scores: DataFrame, auditor: Callable[[DataFrame, int], DataFrame], redo: Callable[[DataFrame, int], DataFrame], rounds: int = 2, store: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> DataFrame:
    """key, action, verdict, attempts, score: entities that score 90 or more are accepted; others are audited, and those that need it redone, ``rounds`` times at most.

    ``scores``: key, score. ``auditor``: (key, score) rows of a round -> key, verdict. ``redo``: the rows to do again -> their new key, score.
    ``store`` may write a round's rows, so that no model is asked twice when tasks are repeated.
    """
    done = scores.where(F.col("score") >= ACCEPT_FROM).select("key", F.lit("accept_via_tier1").alias("action"), F.lit("accept").alias("verdict"), F.lit(0).alias("attempts"), "score")
    left = scores.where(F.coalesce(F.col("score") < ACCEPT_FROM, F.lit(True))).select("key", "score")
    for n in range(1, rounds + 1):
        seen = store(left.join(auditor(left, n).select("key", "verdict"), "key", "left"), f"round{n}").withColumn("verdict", F.coalesce("verdict", F.lit("error")))
        good = F.col("verdict").isin("accept", "minor_fixes", "error")
        needs = ~good & ((F.col("score") < REDO_BELOW) | (F.col("verdict") == "redistill"))
        again = needs if n < rounds else F.lit(False)
        done = done.unionByName(seen.where(~again).select("key", F.lit("tier2_audit").alias("action"), "verdict", F.lit(n).alias("attempts"), "score"))
        if n < rounds:
            left = store(redo(seen.where(again).select("key", "score"), n).select("key", "score"), f"redone{n}")
    return done


def with_provider(rows: DataFrame, harness: str, models: dict[str, tuple[str, str]], default: tuple[str, str]) -> DataFrame:
    """``rows`` with request_meta: provider and model of the harness (``models``: harness -> provider, model), written before a document is assembled."""
    table = F.create_map(*[x for k, (p, m) in models.items() for x in (F.lit(k), F.struct(F.lit(p).alias("provider"), F.lit(m).alias("model")))])
    other = F.struct(F.lit(default[0]).alias("provider"), F.lit(default[1]).alias("model"))
    found = F.coalesce(F.element_at(table, F.col(harness)), other)
    return rows.withColumn("request_meta", F.struct(found["provider"].alias("provider"), found["model"].alias("model"), F.col(harness).alias("harness")))


def batch_log(inputs: DataFrame, key: str, answers: DataFrame) -> DataFrame:
    """One log row an input: what it held (pubs_total, n_abstracts), the answer's outcome and attempts, and its bullets and categories."""
    value = F.col("value.bullets")
    got = answers.select(F.col("key").alias(key), "outcome", "attempts", F.greatest(F.size(value), F.lit(0)).alias("n_bullets"), F.array_sort(F.array_distinct(F.transform(value, lambda b: b["category"]))).alias("categories"))
    return inputs.select(key, "pubs_total", "n_abstracts").join(got, key, "left").withColumn("outcome", F.coalesce("outcome", F.lit("not run")))


def progress(outputs: dict[str, DataFrame], key: str) -> DataFrame:
    """stage, n: how many entities each stage has put out."""
    rows = None
    for name, df in outputs.items():
        one = df.agg(F.countDistinct(key).alias("n")).select(F.lit(name).alias("stage"), "n")
        rows = one if rows is None else rows.unionByName(one)
    return rows
