"""Language identification by Bayesian evidence fusion.

Evidence of a row: the text's likelihood under hashed letter-trigram profiles, the language its markup declares, its
address suffix, and its host. Profiles are fitted on a bounded sample of declared rows (``SAMPLE`` per language);
everything else covers all rows: grouped aggregation of the text posteriors by host gives a prior P(language | host),
smoothed towards P(language | suffix), which is smoothed towards P(language); and by declared language the
reliability P(declared | language). Log evidence adds up; a class of undetermined text competes with the languages.

A declared tag counts without region, script and case, if it is well-formed. The ``PROFILES`` tags with the most rows have a profile, a reliability and host priors each; all
others share one of each (junk that is well-formed makes thousands of tags, and few rows tell little of a language): they are one class of the fusion, and a
row that falls to it is named by its own declaration, else by the tag most declared on its host, else by the most declared one of all. So neither plan nor arrays grow with the tags.

Every text is scored once: the scores are written beside the rows' columns, and all later steps read them from there.

Defined results: null or letterless text is undetermined ("und", rejected); a null, unknown or missing declaration,
host or suffix is no evidence; with no declared rows at all every row is undetermined. Repeated rows get equal
results; texts of any length are scored whole; an empty table gives no rows; all columns of the input are kept, whatever
their names, but for those that ``identify`` itself adds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import prepare, saved

#: Declared rows per language that the profiles are fitted on.
SAMPLE = 600
#: Tags with a profile of their own, and the name of the class that the others share (no well-formed tag).
PROFILES, SHARED = 256, "*"
#: Keys whose posteriors a task adds up before it passes them on.
HELD = 20_000
#: Buckets of the profiles; with very many languages they are hashed to fewer, so that a table has CELLS cells at most,
#: but never fewer than LEAST_BUCKETS.
BUCKETS, CELLS, LEAST_BUCKETS = 1 << 16, 1 << 24, 1 << 12
#: Occurrences a bucket that the floor of the profiles stands for; trigrams that the back-off of a profile weighs as.
SMOOTH, BACK_OFF = 0.02, 20_000.0
#: Neighbouring trigrams are not independent: a text counts as this many independent ones at most.
TEMPER = 40.0
#: Strength, in rows, of P(language) in P(language | suffix), of that in P(language | host), and of uniform reliability.
SUFFIX_ROWS, HOST_ROWS, RELIABILITY_ROWS = 50.0, 20.0, 20.0
#: Numbers of the host priors (one for each host and language) that are broadcast at most; beyond it they are joined by sorting.
BROADCAST_NUMBERS = 1 << 20

_letters: list[np.ndarray] = []


def trigrams(text: str) -> np.ndarray:
    """Hashed letter trigrams of the lower-cased text; all between two words counts as one space."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x30000)), bool, 0x30000))
    c = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    c = np.where((c < 0x30000) & _letters[0][np.minimum(c, 0x2FFFF)], c, 32).astype(np.uint64)
    c = np.concatenate(([32], c, [32])).astype(np.uint64)
    c = c[np.r_[True, (c[1:] != 32) | (c[:-1] != 32)]]
    if len(c) < 3:
        return np.zeros(0, np.int64)
    mixed = (c[:-2] * np.uint64(0x9E3779B1) + c[1:-1] * np.uint64(0x85EBCA77) + c[2:] * np.uint64(0xC2B2AE3D)) * np.uint64(0x27D4EB2F165667C5)
    return (mixed >> np.uint64(48)).astype(np.int64)


def log_profiles(counts: np.ndarray) -> tuple[np.ndarray, float]:
    """(log-probabilities, score of a trigram of undetermined text) of trigram counts by bucket and language.

    A profile backs off to the trigrams of all languages, the more the smaller its sample is. What no language has is
    as unlikely in all of them, however few rows a language has: at the floor of the largest sample.
    """
    sizes = counts.sum(axis=0, dtype=np.float64)
    background = counts.sum(axis=1, dtype=np.float64) / max(1.0, sizes.sum())
    floor = SMOOTH / (sizes.max() + SMOOTH * len(counts))
    out, own = np.empty(counts.shape, np.float32), 0.0
    for k, size in enumerate(sizes):
        p = np.maximum((counts[:, k] + BACK_OFF * background) / (size + BACK_OFF), floor)
        out[:, k] = np.log(p)
        own += float((p * np.log(p)).sum() * size)
    # halfway between a language's own mean (by its share of the samples) and the floor
    return out, (own / max(1.0, sizes.sum()) + float(np.log(floor))) / 2


def tag_of(declared: str) -> Column:
    """The language of a declared tag, lower-cased and without region or script; null for "und" and what is no well-formed tag.

    So the number of languages is that of languages in use, however much junk is declared.
    """
    whole = F.lower(F.trim(F.col(declared).cast("string")))
    first = F.regexp_extract(whole, "^([a-z]{2,8}|[ix][-_][a-z0-9]{1,8})(?:$|[-_])", 1)  # private and registered names keep their second part
    return F.when((first != "") & (first != "und"), first)


def fit_profiles(rows: DataFrame, text: str, declared: str, key: Column, sample: int = SAMPLE) -> tuple[list[str], np.ndarray, float]:
    """(languages, log-probabilities by bucket and language, score of undetermined text) from ``sample`` rows of each declared tag at most."""
    rows = rows.select(F.col(declared).alias("l"), key.alias("k"), F.col(text).alias("t")).where("l is not null")
    names = sorted(r[0] for r in rows.select("l").distinct().collect())  # PROFILES + 1 at most
    if not names:
        return [], np.zeros((BUCKETS, 0), np.float32), 0.0
    buckets = BUCKETS
    while buckets > LEAST_BUCKETS and buckets * len(names) > CELLS:
        buckets //= 2
    salts = 32
    chosen = rows.select("l", "k").withColumn("s", F.pmod("k", F.lit(salts)))
    first = F.row_number().over(Window.partitionBy("l", "s").orderBy("k"))
    chosen = chosen.withColumn("n", first).where(F.col("n") <= -(-sample // salts)).select("l", "k").distinct()  # sample rows a language at most
    texts = rows.join(F.broadcast(chosen), ["k", "l"], "left_semi").select("l", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for l, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if l not in sums:
                    sums[l] = np.zeros(buckets, np.int32)
                sums[l] += np.bincount(trigrams(t or "") & (buckets - 1), minlength=buckets).astype(np.int32)
        for l, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([l] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(c[at], pa.int64())], names=["l", "bucket", "n"])

    counts = np.zeros((buckets, len(names)), np.float32)
    place = {l: k for k, l in enumerate(names)}
    found = texts.mapInArrow(run, "l string, bucket long, n long").groupBy("l", "bucket").agg(F.sum("n").alias("n")).toArrow()  # languages * buckets rows at most
    at = np.array([place[l] for l in found.column("l").to_pylist()], np.int64)
    counts[found.column("bucket").to_numpy(), at] = found.column("n").to_numpy()
    return names, *log_profiles(counts)


def text_scores(spark, profiles: np.ndarray, undetermined: float):
    """A function of a text column: tempered log-likelihoods of the languages and, last, of undetermined text; null without letters."""
    shared = spark.sparkContext.broadcast(profiles)

    def score(text: str | None) -> list[float] | None:
        grams = trigrams(text or "") & (len(shared.value) - 1)
        if not len(grams):
            return None
        total = np.zeros(shared.value.shape[1])
        for at in range(0, len(grams), 1 << 18):
            total += shared.value[grams[at : at + (1 << 18)]].sum(axis=0, dtype=np.float64)
        return [*(total * (scale := min(len(grams), TEMPER) / len(grams))), undetermined * len(grams) * scale]

    @F.arrow_udf("array<double>")
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array([score(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return scores


def _once(value: Column, then) -> Column:  # noqa: ANN001
    """``then`` of a value that it uses for every element of an array: the value is made once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _normal(logs: Column) -> Column:
    """Probabilities of log scores."""
    exps = _once(logs, lambda xs: _once(F.array_max(xs), lambda top: F.transform(xs, lambda x: F.exp(x - top))))
    return _once(exps, lambda es: _once(F.aggregate(es, F.lit(0.0), lambda a, y: a + y), lambda whole: F.transform(es, lambda x: x / whole)))


def _posterior_sums(scored: DataFrame, n: int) -> DataFrame:
    """(h, s, d, c, p): the texts' posteriors of each language c, added up by host, suffix and declared class within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}

        def out() -> pa.RecordBatch:
            h, s, d = ([k[j] for k in held for _ in range(n)] for j in range(3))
            batch = pa.RecordBatch.from_arrays([pa.array(h, pa.string()), pa.array(s, pa.string()), pa.array(d, pa.string()), pa.array(np.tile(np.arange(n, dtype=np.int32), len(held))), pa.array(np.concatenate(list(held.values())))], names=["h", "s", "d", "c", "p"])
            held.clear()
            return batch

        most = max(64, HELD // n)
        for b in batches:
            if not b.num_rows:
                continue
            logs = b.column("logs").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)[:, :n]
            p = np.exp(logs - logs.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            for k, key in enumerate(zip(*(b.column(c).to_pylist() for c in "hsd"), strict=True)):
                if key in held:
                    held[key] += p[k]
                else:
                    held[key] = p[k].copy()
                    if len(held) >= most:
                        yield out()
        if held:
            yield out()

    return scored.where("logs is not null").select("h", "s", "d", "logs").mapInArrow(run, "h string, s string, d string, c int, p double")


def suffix_of(host: Column) -> Column:
    """The address suffix of a host name or URL: what follows the last dot of its host part; null without one."""
    bare = F.regexp_replace(F.lower(host), r"^[a-z][a-z0-9+.-]*://|[/?#:].*$", "")
    found = F.regexp_extract(bare, r"\.([a-z]{2,24})$", 1)
    return F.when(found != "", found)


def markup_language(html: Column) -> Column:
    """The language that a page declares in its html element; null without one."""
    return F.nullif(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang=[\"']?([A-Za-z][A-Za-z0-9_-]*)", 1), F.lit(""))


def markup_text(html: Column) -> Column:
    """A page's text without scripts, styles, tags and entities."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<[^>]*+>|&[a-z#0-9]+;", " ")


def classify(docs: DataFrame, text: Column | str = "text", declared: str = "lang", host: str = "source", key: str = "doc_id", sample: int = SAMPLE, kept: list[str] | None = None) -> DataFrame:
    """row (a struct of the columns ``kept``, all without it), language, posterior, text_language and accepted (false for undetermined rows).

    ``host`` names a column of host names or URLs.
    """
    spark = docs.sparkSession
    prepare(spark)
    host_part = F.regexp_replace(F.lower(F.col(host).cast("string")), r"^[a-z][a-z0-9+.-]*://|[/?#:].*$", "")
    # a row travels as one struct, so no name of its columns can clash with what is beside it
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in (kept or docs.columns)]).alias("row"), host_part.alias("h"), suffix_of(F.col(host).cast("string")).alias("s"), tag_of(declared).alias("d"),
                       F.xxhash64(F.lit(7), key).alias("k"), (F.col(text) if isinstance(text, str) else text).alias("t"))
    often = [r[0] for r in rows.where("d is not null").groupBy("d").count().orderBy(F.desc("count"), "d").limit(PROFILES).collect()]
    # tag: what is declared; d: its class
    rows = rows.withColumn("tag", F.col("d")).withColumn("d", F.when(F.col("tag").isin(often), F.col("tag")).when(F.col("tag").isNotNull(), SHARED))
    names, profiles, undetermined = fit_profiles(rows, "t", "d", F.col("k"), sample)
    n = len(names)
    if not n:
        return rows.select("row", F.lit("und").alias("language"), F.lit(1.0).alias("posterior"), F.lit("und").alias("text_language"), F.lit(False).alias("accepted"))
    scored = saved(rows.select("row", "h", "s", "d", "tag", text_scores(spark, profiles, undetermined)("t").alias("logs")), "scores")
    sums = saved(_posterior_sums(scored, n).groupBy("h", "s", "d", "c").agg(F.sum("p").alias("p")), "hosts")

    def summed(by: list[str]) -> DataFrame:
        """The sums of each language (p, an array) by some of the keys: a tall table until the end."""
        tall = sums.groupBy(*by, "c").agg(F.sum("p").alias("p"))
        held = tall.groupBy(*by).agg(F.collect_list(F.struct("c", "p")).alias("x"))  # a struct a class
        return held.select(*by, F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.coalesce(F.get(F.transform(F.filter("x", lambda x: x["c"] == k), lambda x: x["p"]), F.lit(0)), F.lit(0.0))).alias("p"))

    found = summed([]).first()
    total = (np.array(found[0]) if found else np.zeros(n)) + 1.0
    overall = total / total.sum()
    reliable = {r[0]: np.array(r[1]) for r in summed(["d"]).where("d is not null").collect()}  # a row a language
    of = np.array([reliable.get(d, np.zeros(n)) for d in names])  # declared, language
    log_declared = np.log((of + RELIABILITY_ROWS / n) / (of.sum(axis=0) + RELIABILITY_ROWS))

    def smoothed(strength: float, towards: Column) -> Column:
        every = F.aggregate("p", F.lit(0.0), lambda a, x: a + x) + F.lit(strength)
        return F.zip_with("p", towards, lambda c, t: (c + F.lit(strength) * t) / every)

    flat = F.array(*[F.lit(float(x)) for x in overall])
    suffixes = summed(["s"]).where("s is not null").select("s", smoothed(SUFFIX_ROWS, flat).alias("q"))
    hosts = summed(["h", "s"]).where("h is not null").join(suffixes, "s", "left")
    hosts = hosts.select("h", smoothed(HOST_ROWS, F.coalesce("q", flat)).alias("q"))
    hosts = saved(hosts.select("h", F.transform("q", lambda x: F.log(x)).alias("prior")), "priors")
    hosts = F.broadcast(hosts) if hosts.count() * n <= BROADCAST_NUMBERS else hosts.hint("merge")
    tags = spark.createDataFrame([(d, [float(x) for x in r]) for d, r in zip(names, log_declared, strict=True)], "d string, said array<double>")  # a row a language
    wide = scored.join(hosts, "h", "left").join(F.broadcast(tags), "d", "left")
    prior = F.coalesce("prior", F.array(*[F.lit(float(x)) for x in np.log(overall)]))
    said = F.coalesce("said", F.array_repeat(F.lit(0.0), n))
    # undetermined text: a prior of one in a thousand, and no opinion on declarations
    und = F.get("logs", F.lit(n)) + F.lit(float(np.log(1e-3))) + F.when(F.col("said").isNotNull(), F.lit(float(-np.log(n)))).otherwise(F.lit(0.0))
    fused = F.concat(F.zip_with(F.zip_with(F.slice("logs", 1, n), prior, lambda a, b: a + b), said, lambda a, b: a + b), F.array(und))
    named = F.array(*[F.lit(x) for x in [*names, "und"]])
    best = lambda xs: _once(xs, lambda ys: F.get(named, (F.array_position(ys, F.array_max(ys)) - 1).cast("int")))
    out = wide.withColumn("p", _normal(fused)).select(
        "row", "h", "d", "tag", F.coalesce(best(F.col("p")), F.lit("und")).alias("language"), F.coalesce(F.array_max("p"), F.lit(1.0)).alias("posterior"), F.coalesce(best(F.col("logs")), F.lit("und")).alias("text_language"),
    )
    if SHARED in names:
        declared_there = saved(scored.where(F.col("d") == SHARED).groupBy("h", "tag").count(), "tags")
        top = F.max_by("tag", F.struct("count", "tag")).alias("usual")
        most = declared_there.groupBy("tag").agg(F.sum("count").alias("count")).agg(top).first()["usual"]
        usual = declared_there.where("h is not null").groupBy("h").agg(top)
        own = F.when(F.col("d") == SHARED, F.col("tag"))
        out = out.join(usual, "h", "left").withColumns({
            "language": F.when(F.col("language") == SHARED, F.coalesce(own, "usual", F.lit(most))).otherwise(F.col("language")),
            "text_language": F.when(F.col("text_language") == SHARED, F.lit(most)).otherwise(F.col("text_language")),
        })
    out = out.select("row", "language", "posterior", "text_language")
    return out.withColumn("accepted", F.col("language") != "und")


def identify(docs: DataFrame, text: Column | str = "text", declared: str = "lang", host: str = "source", key: str = "doc_id", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with __language, __posterior, __text_language and __accepted, as ``classify`` finds them; columns of these names are replaced."""
    added = ("language", "posterior", "text_language", "accepted")
    found = classify(docs, text, declared, host, key, sample)
    return found.select(*[F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in [f"__{a}" for a in added]], *[F.col(a).alias(f"__{a}") for a in added])
