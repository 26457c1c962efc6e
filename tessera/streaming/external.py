"""External model calls as a pluggable step: retries, error routing, smaller inputs. Only an offline rule-based stub is shipped."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import error_kind, strip_fences, used_up

ANSWER = "key string, attempts int, status int, answer string, error string"
#: (prompt, attempt) -> (status, body)
Model = Callable[[str, int], tuple[int, str]]


def stub(prompt: str, attempt: int) -> tuple[int, str]:
    """A deterministic offline model: the prompt's first sentence as a fenced JSON object."""
    import json

    return 200, "```json\n" + json.dumps({"summary": prompt.split(". ")[0][:300], "bullets": []}) + "\n```"


def call(prompts: DataFrame, key: str, prompt: str, model: Model = stub, attempts: int = 3, smaller: Callable[[str, int], str] | None = None, sound: Callable[[str], bool] | None = None,
         strict: Callable[[str], str] | None = None) -> DataFrame:
    """ANSWER for each row: quota errors stop at once (to be deferred), others are retried, time-outs (408) with a smaller prompt, and answers
    that are not ``sound`` (no JSON, drifted from the schema) with a stricter one; the last answer stays if none is sound."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for k, text in zip(b["key"], b["prompt"], strict=True):
                status, body, n = 0, "", 0
                for n in range(1, attempts + 1):
                    try:
                        status, body = model(text, n)
                    except Exception as e:  # a failed call is a row, not a failed job
                        status, body = 500, str(e)[-3000:]
                    if status < 400 and (sound is None or sound(body)):
                        break
                    if status < 400:
                        text = strict(text) if strict else text
                        continue
                    if used_up(body):
                        break
                    if status == 408 and smaller:
                        text = smaller(text, n)
                rows.append((k, n, status, body if status < 400 else None, body[-3000:] if status >= 400 else None))
            yield pd.DataFrame(rows, columns=["key", "attempts", "status", "answer", "error"])

    return prompts.select(F.col(key).cast("string").alias("key"), F.col(prompt).alias("prompt")).mapInPandas(run, ANSWER)


def parsed(answers: DataFrame, schema: str) -> DataFrame:
    """key, attempts, value (the parsed answer), outcome: ok, bad_json, quota, rate_limit or api_error."""
    value = F.from_json(strip_fences(F.col("answer")), schema)
    kind = error_kind(F.col("status"), F.coalesce("error", F.lit("")))
    good = F.col("answer").isNotNull() & F.try_parse_json(strip_fences(F.col("answer"))).isNotNull()
    outcome = F.when(good, "ok").when(F.col("answer").isNotNull(), "bad_json").otherwise(F.coalesce(kind, F.lit("api_error")))
    return answers.select("key", "attempts", value.alias("value"), outcome.alias("outcome"))


def tokens_used(usage: Column) -> Column:
    """Tokens over a map of models: the first non-zero of the two names that backends use."""
    one = lambda x: F.coalesce(F.nullif(x["input"], F.lit(0)), F.nullif(x["prompt"], F.lit(0)), F.lit(0)).cast("long")
    return F.aggregate(F.map_values(usage), F.lit(0).cast("long"), lambda a, x: a + one(x))


def round_robin(df: DataFrame, order: str, keys: int) -> DataFrame:
    """``df`` with key_slot: rows dealt to ``keys`` slots by a hash of their order column, without a global sort."""
    return df.withColumn("key_slot", F.pmod(F.xxhash64(order), F.lit(keys)).cast("int"))
