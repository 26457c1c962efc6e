"""Column expressions that read tags, citations and tokens from free text. All run inside whole-stage code; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stop words, lexicons and patterns that results depend on.
STOP_WORDS = (
    "a an and are as at be been being by can for from has had have he her him his i in is it its "
    "of on or our she so that the their them they this to was were what when where which who whom whose will with you your "
    "abnormal increased decreased show shown demonstrate observe loss-of-function gain-of-function "
    "flies fly mutant mutants wild-type wildtype gene allele alleles"
).split()
TISSUES = (
    "Malpighian tubule", "Malpighian tubules", "wing", "wings", "eye", "eyes", "ommatidi", "leg", "legs", "mushroom body", "mushroom bodies",
    "central nervous system", "CNS", "brain", "ventral nerve cord", "neuron", "neurons", "glia", "glial", "ovary", "ovaries", "ovariole", "germline", "germ cell",
    "testis", "testes", "midgut", "hindgut", "foregut", "intestine", "gut", "trachea", "tracheal", "fat body", "muscle", "musculature", "myoblast",
    "cuticle", "epidermis", "heart", "dorsal vessel", "cardioblast", "pericardial", "salivary gland", "salivary glands", "imaginal disc",
    "bristle", "sensory bristle", "macrochaeta", "macrochaetae", "olfactory", "antenna", "antennal", "chemosens", "photoreceptor", "retina", "lamina", "optic lobe",
    "prothoracic gland",
)
TISSUE_NAMES = {
    "Malpighian tubules": "Malpighian tubule", "wings": "wing", "eyes": "eye", "legs": "leg", "mushroom bodies": "mushroom body", "Malpighian tubule": "Malpighian tubule",
    "CNS": "central nervous system", "brain": "brain", "neurons": "neuron", "glial": "glia", "ovaries": "ovary", "intestine": "gut", "midgut": "gut", "hindgut": "gut",
    "foregut": "gut", "tracheal": "trachea", "musculature": "muscle", "myoblast": "muscle", "macrochaetae": "macrochaeta", "macrochaeta": "macrochaeta", "antennal": "antenna",
    "chemosens": "chemosensory", "salivary glands": "salivary gland", "testes": "testis", "ommatidi": "ommatidium", "germ cell": "germline",
}
LIFE_STAGES = ((r"(?i)\bembryon", "embryonic"), (r"(?i)\b(third[- ]?instar|larv)", "larval"), (r"(?i)\bpup", "pupal"), (r"(?i)\badult", "adult"))
REFERENCE = r"FBrf[0-9]{7}"
SECTIONS = (
    "phenotypes_sub", "alleles_main_sub", "hdm_sub", "other_comments_sub", "summary_genetic_interactions_sub", "summary_physical_interactions_sub",
    "pathways_sub", "gene_class_sub", "human_orthologs_sub", "mod_orthologs_sub", "function", "auto_summary", "CURATOR NOTES",
)
SECTION_ALIAS = {"CURATOR NOTES": "other_comments_sub"}
NUMBER = r"\b\d[\d.,]*(?:%|[xX]|-fold| times| hr| h)?\b"
NAMED = r"\b(FBrf\d+|FBgn\d+|FBal\d+|OMIM:|HP:|MIM:|S\d+[AGRC]|per[01LS]|w[01-9]+|shi\[[^\]]+\])\b"
QUANTIFIER = r"(?i)\b(approximately|about|roughly|completely|partially|fully|nearly|significantly|severely|mildly|specifically|exclusively)\b"
ALLELE_ID = r"\bFBal\d{7}\b"
ALLELE_SYMBOL = r"\b([a-z]{1,5})(\[[a-zA-Z0-9.]+\]|[0-9][0-9a-zA-Z]*)"
ALLELE_SYMBOLS = ("per", "shi", "w", "Dl", "e", "h", "hry", "N", "wg", "en", "Egfr", "Notch", "ebony", "hairy", "white", "shibire", "period", "Per", "Per1", "Per2", "Per3")


def content_tokens(text: Column, stop: tuple[str, ...] | list[str] = STOP_WORDS, least: int = 4) -> Column:
    """Distinct lower-cased ASCII words of ``least`` letters or more that are no stop words, in order of first use."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rf"[a-z0-9]{{{least},}}"), F.lit(0)))
    return F.filter(words, lambda w: ~w.isin(*stop))  # a hash set, as it has more than ten members


def unicode_tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two token sets; null if either is empty."""
    both = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / both)


def lexicon_tags(text: Column, terms: tuple[str, ...] = TISSUES, names: dict[str, str] | None = None) -> Column:
    """Sorted distinct names of the terms that occur as whole words, case-insensitively."""
    names = TISSUE_NAMES if names is None else names
    low = F.lower(text)
    found = F.array(*[F.when(low.rlike(rf"\b\Q{t.lower()}\E\b"), F.lit(names.get(t, t.lower()))) for t in terms])
    return F.array_sort(F.array_distinct(F.array_compact(found)))


def life_stages(text: Column) -> Column:
    return F.array_sort(F.array_compact(F.array(*[F.when(text.rlike(p), F.lit(label)) for p, label in LIFE_STAGES])))


def alleles(text: Column) -> Column:
    """Sorted distinct allele ids, and allele symbols with an allowed stem, their brackets stripped."""
    ids = F.regexp_extract_all(text, F.lit(ALLELE_ID), F.lit(0))
    pairs = F.arrays_zip(F.regexp_extract_all(text, F.lit(ALLELE_SYMBOL), F.lit(1)).alias("s"), F.regexp_extract_all(text, F.lit(ALLELE_SYMBOL), F.lit(2)).alias("x"))
    known = F.filter(pairs, lambda p: p["s"].isin(*ALLELE_SYMBOLS))
    return F.array_sort(F.array_distinct(F.concat(ids, F.transform(known, lambda p: F.concat(p["s"], F.regexp_replace(p["x"], r"[\[\]]", ""))))))


def citations(text: Column) -> Column:
    """array<struct<type, value, label, section_enum>>: reference ids, then sections, each once, in order of first use."""
    refs = F.array_distinct(F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)))
    names = F.regexp_extract_all(text, F.lit(r"\b(" + "|".join(SECTIONS) + r")\b"), F.lit(1))
    alias = F.create_map(*[F.lit(x) for kv in SECTION_ALIAS.items() for x in kv])
    sections = F.array_distinct(F.transform(names, lambda s: F.coalesce(F.element_at(alias, s), s)))
    none = F.lit(None).cast("string")
    a = F.transform(refs, lambda r: F.struct(F.lit("fbrf").alias("type"), r.alias("value"), F.concat(r, F.lit(" abstract")).alias("label"), none.alias("section_enum")))
    b = F.transform(sections, lambda s: F.struct(F.lit("section").alias("type"), s.alias("value"), F.concat(s, F.lit(" curator annotation")).alias("label"), s.alias("section_enum")))
    return F.concat(a, b)


def specificity(head: Column, body: Column) -> Column:
    """high, medium or low by counts of numbers, named entities, quantifiers and the head's length."""
    text = F.concat(F.coalesce(head, F.lit("")), F.lit(" "), F.coalesce(body, F.lit("")))
    score = 2 * F.regexp_count(text, F.lit(NUMBER)) + 2 * F.regexp_count(text, F.lit(NAMED)) + F.regexp_count(F.coalesce(head, F.lit("")), F.lit(QUANTIFIER)) + F.when(F.length(head) >= 80, 1).otherwise(0)
    return F.when(score >= 4, "high").when(score >= 2, "medium").otherwise("low")


def first_sentences(text: Column, n: int = 1, cap: int = 300) -> Column:
    return F.substring(F.array_join(F.slice(F.split(text, r"\. "), 1, n), ". "), 1, cap)


def strip_fences(text: Column) -> Column:
    """The body of a fenced answer; else from the first brace to the last."""
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    braced = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.when(fenced != "", fenced).when(braced != "", braced).otherwise(F.trim(text))


def ribbon_terms(ribbon: Column) -> Column:
    """The names of an array<struct<name, num_annotations>> that have annotations, each once, in order."""
    used = F.filter(ribbon, lambda r: F.coalesce(r["num_annotations"].cast("string").try_cast("int"), F.lit(0)) > 0)
    return F.array_distinct(F.filter(F.transform(used, lambda r: F.trim(F.coalesce(r["name"], F.lit("")))), lambda n: n != ""))


def plain_synonyms(symbol: Column, lists: Column, fallback: Column | None = None) -> Column:
    """Sorted distinct names: the symbol and the items of comma lists (an array of them); ``fallback`` if there is none."""
    items = F.flatten(F.transform(F.concat(F.array(symbol), lists), lambda x: F.split(F.coalesce(x, F.lit("")), ",")))
    found = F.array_sort(F.array_distinct(F.filter(F.transform(items, lambda x: F.trim(x)), lambda x: x != "")))
    return found if fallback is None else F.when(F.size(found) > 0, found).otherwise(fallback)


def input_text(summary: Column, sections: Column, abstracts: Column) -> Column:
    """All that a model was given, lower-cased: summary, sections (map), titles and abstracts (array of structs)."""
    parts = F.flatten(F.transform(abstracts, lambda a: F.array(F.coalesce(a["title"], F.lit("")), F.coalesce(a["abstract"], F.lit("")))))
    return F.lower(F.array_join(F.concat(F.array(F.coalesce(summary, F.lit(""))), F.map_values(sections), parts), "\n"))


def filled_sections(sections: Column) -> Column:
    """The sorted names of the sections (map) that have text."""
    return F.array_sort(F.map_keys(F.map_filter(sections, lambda k, v: F.length(F.trim(F.coalesce(v, F.lit("")))) > 0)))


# Error codes and phrases by which backends say that a quota is used up.
LIMIT_CODES, QUOTA_CODE = ("1302", "1303"), "1113"
QUOTA_PHRASES = (
    "insufficient balance", "quota exhausted", "subscription benefits may be restricted", "recharge", "exceeded daily", "exceeded 5-hour", "you have exceeded your usage", "exceeded your daily limit",
    "exceeded the maximum number of tokens", "you have reached your usage limit", "you exceeded your current quota", "rate_limit_exceeded", "insufficient_quota", "usage_limit_reached",
    "you have hit your message limit", "you've hit your usage limit", "hit your usage limit", "purchase more credits", "chatgpt.com/codex/settings/usage",
)


def used_up(body: str) -> bool:
    """Whether a message says that a quota is used up."""
    return f'"code":"{QUOTA_CODE}"' in body or any(p in body.lower() for p in QUOTA_PHRASES)


def error_kind(status: Column, body: Column) -> Column:
    """quota, rate_limit, api_error or null by status code and message."""
    code = lambda c: F.contains(body, F.lit(f'"code":"{c}"'))
    limited = status.isin(429, 503)
    for c in LIMIT_CODES:
        limited = limited | code(c)
    quota = code(QUOTA_CODE)
    for phrase in QUOTA_PHRASES:
        quota = quota | F.contains(F.lower(body), F.lit(phrase))
    return F.when(F.coalesce(quota, F.lit(False)), "quota").when(F.coalesce(limited, F.lit(False)), "rate_limit").when(status >= 400, "api_error")
