"""Personal data by weak supervision, in DataFrame functions only.

Base spans are regular expressions with checks. Candidate spans beyond them are found by wider patterns, in the text
without the base spans: digit groups that no base check accepts, written-out addresses ("name at host dot com"), names
behind titles, and long strings of letters and digits (secrets). Five labelers vote on every candidate: a shape and a
checking rule (regex), a word list (gazetteer), words or marks just before (context), and how it is set off from the
text. For each kind of candidate, expectation-maximisation over the table of vote patterns estimates the labelers'
reliabilities without labels; base spans are no part of it, as they are decided. Its posteriors train the final span
classifier, a naive Bayes model on span features, whose log-odds are summed in a column expression. Accepted candidates
are added; base spans always stay.

Positions are code points. The patterns are written so that each character is looked at a bounded number of times:
runs are possessive and start where a run starts or where the last match ended; no group repeats without bound but
possessively, as Java matches other groups by recursion, which very long texts would overflow.

Defined results: null and empty texts have no spans; a null doc_id stays null; repeated rows get equal rows; texts of any
length are searched whole; an empty table gives no rows. Other columns are not looked at, and ``mask`` returns them as
they are, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, saved

KINDS = ("email", "ip", "card", "phone")
#: The base patterns of the task, made possessive; \G lets a match start where the last one ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: Candidates beyond the base: kind -> pattern. Each is bounded in length.
WIDER = {
    "number": r"(?<![0-9A-Za-z.+-])[0-9(][0-9() ./-]{6,28}[0-9](?![0-9A-Za-z])",
    "address": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:[\[({] ?(?i:at|@) ?[\])}]|(?i:\bat\b)) ?[A-Za-z0-9-]{1,64}(?:(?:\.| ?[\[({] ?(?i:dot) ?[\])}] ?| (?i:dot) )[A-Za-z0-9-]{2,64}){1,8}+",
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora)\.? \p{Lu}\p{L}{1,30}(?: \p{Lu}\p{L}{1,30})?",
    "secret": r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z0-9_+/=-]{20})(?=[A-Za-z_+/=-]{0,200}+[0-9])(?=[0-9_+/=-]{0,200}+[A-Za-z])[A-Za-z0-9_+/=-]{20,200}+(?![A-Za-z0-9_+/=-])",
}
HINTS = {
    "email": "@", "ip": r"[0-9]\.[0-9]", "card": "[0-9][ -]?[0-9]", "phone": r"\+[0-9]", "number": "[0-9]", "address": r"(?i:[\[({] ?(?:at|@) ?[\])}]|[\[({ ]dot[\])} ])",
    "name": r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora)\.? \p{Lu}", "secret": "(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/=-]{20}",
}
#: The word lists that come with the operator, in the four languages of its tests; ``gazetteer`` puts a table in their place.
GAZETTEER = {
    "address": "gmail yahoo hotmail outlook mail example gmx web orange free proton icloud aol live",
    "name": "anna maria hans peter jean marie pierre josé juan john mary james thomas paul laura klaus sophie carlos ana michael david sarah",
    "number": "phone tel telephone mobile call fax telefon handy anruf téléphone portable teléfono móvil card visa mastercard amex credit iban karte kreditkarte konto carte compte tarjeta cuenta",
    "secret": "token key apikey secret password passwd pwd passwort kennwort contraseña bearer auth authorization credential credentials access private signature session",
}
#: Terms of a gazetteer at most: they become sets in the plan.
GAZETTEER_TERMS = 100_000
#: What stands just before personal data (context).
NEARBY = {
    "number": r"(?:phone|tel|telephone|mobile|call|fax|telefon|handy|anruf|téléphone|portable|teléfono|móvil|card|visa|credit|iban|karte|konto|carte|compte|tarjeta|cuenta)[^\p{L}0-9]{0,6}$",
    "address": r"(?:mail|e-mail|email|contact|kontakt|courriel|correo|contacto|write|to|an|à|a)[^\p{L}0-9]{0,6}$",
    "name": r"(?:name|author|signed|contact|von|autor|nom|auteur|nombre|firma|by|dear|sehr geehrte[r]?)[^\p{L}0-9]{0,6}$",
    "secret": r"(?:[:=]|->|=>)\s?[\"']?$",
}
LABELERS = ("shape", "checked", "listed", "near", "alone")
#: What is believed of a labeler before data: its vote rates on personal data and on other candidates, worth so many votes of each.
#: A shape or a clear edge is common to both; a check, a listed word or a word nearby is rare on other candidates.
BELIEF = {"shape": (0.9, 0.5), "checked": (0.7, 0.08), "listed": (0.7, 0.1), "near": (0.7, 0.08), "alone": (0.85, 0.5)}
STRENGTH, SHARE, ROUNDS = 40.0, 0.3, 60


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: inside lambdas of higher-order functions, nothing else keeps it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(steps: Column) -> Column:
    """Running sums of array<int>, in blocks, so that the work grows little faster than the array."""
    none, size = F.array().cast("array<int>"), 128

    def sums(xs: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), none.alias("out"))
        return F.aggregate(xs, start, lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"] + x)).alias("out")), lambda a: a["out"])

    def moved(blocks: Column, before: Column) -> Column:
        return F.flatten(F.transform(blocks, lambda x, k: _let(F.when(k > 0, F.get(before, k - 1)).otherwise(F.lit(0)), lambda b: F.transform(x, lambda y: y + b))))

    def cut(xs: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / size).cast("int")), lambda k: sums(F.slice(xs, k * size + 1, F.lit(size))))

    def whole(xs: Column) -> Column:
        return _let(cut(xs), lambda blocks: _let(sums(F.transform(blocks, lambda x: F.element_at(x, -1))), lambda before: moved(blocks, before)))

    return _let(steps, lambda xs: F.when(F.size(xs) > size, whole(xs)).when(F.size(xs) > 0, sums(xs)).otherwise(none))


PLACES = "array<struct<start:int,end:int,span:string,before:string,after:string>>"


def _with_places(text: str, pattern: str) -> Column:
    """PLACES of the non-overlapping matches: running lengths of what is between them and of them.

    before and after are the last 24 and the first 2 characters around a match, back to the match before it.
    """

    def places(found: Column, gaps: Column) -> Column:
        ends = _running(F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.char_length(g) + F.char_length(m)))
        return F.transform(F.arrays_zip(ends.alias("e"), found.alias("m"), F.slice(gaps, F.lit(1), F.size(found)).alias("b"), F.slice(gaps, F.lit(2), F.size(found)).alias("a")), lambda x: F.struct(
            (x["e"] - F.char_length(x["m"])).alias("start"), x["e"].alias("end"), x["m"].alias("span"), F.substring(x["b"], -24, 24).alias("before"), F.substring(x["a"], 1, 2).alias("after"),
        ))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(found, lambda m: F.when(F.size(m) > 0, _let(F.split(text, pattern, -1), lambda g: places(m, g))).otherwise(F.array().cast(PLACES)))


def _valid(kind: str, span: Column) -> Column:
    digits = F.regexp_replace(span, "[^0-9]", "")
    if kind == "ip":
        return span.rlike("^" + r"\.".join([BYTE] * 4) + "$")
    if kind == "card":
        return F.char_length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.char_length(digits).between(10, 15)
    return F.lit(True)


def _spans(text: str, hint: str, pattern: str, valid) -> Column:
    """Valid matches of a pattern; texts without the hint are passed over at once."""
    places = F.filter(_with_places(text, pattern), lambda s: valid(s["span"]))
    return F.when(F.col(text).rlike(hint), places).otherwise(F.array().cast(PLACES))


def _blanked(text: str, kind: str) -> Column:
    """The text with the kind's valid matches overwritten, character by character."""
    kept = F.zip_with(F.split(text, PATTERNS[kind], -1), F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), lambda g, m: F.concat(g, F.coalesce(F.when(_valid(kind, m), F.repeat(F.lit("\u0001"), F.char_length(m))).otherwise(m), F.lit(""))))
    return F.when(F.col(text).rlike(HINTS[kind]), F.array_join(kept, "")).otherwise(F.col(text))


def base_spans(docs: DataFrame, also: list[str] | None = None) -> DataFrame:
    """doc_id, text, the columns ``also``, and for each kind its spans as array<struct<start, end, span>>."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *(also or []))
    return rows.select("doc_id", "text", *(also or []), *[_spans("text", HINTS[k], PATTERNS[k], lambda s, k=k: _valid(k, s)).alias(k) for k in KINDS])


def candidates(docs: DataFrame, also: list[str] | None = None) -> DataFrame:
    """doc_id, the columns ``also``, and array ``spans`` of struct<kind, base, start, end, span, before, after>: base spans, and wider candidates in the text without them."""
    rows = base_spans(docs, also)
    for kind in KINDS:
        rows = rows.withColumn("text", _blanked("text", kind))
    wide = rows.select("doc_id", *(also or []), *KINDS, *[_spans("text", HINTS[k], p, lambda s: F.lit(True)).alias(k) for k, p in WIDER.items()])

    def tagged(kind: str, base: bool) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), F.lit(base).alias("base"), *[s[c].alias(c) for c in ("start", "end", "span", "before", "after")]))

    return wide.select("doc_id", *(also or []), F.concat(*[tagged(k, True) for k in KINDS], *[tagged(k, False) for k in WIDER]).alias("spans"))


def word_lists(gazetteer: DataFrame | None) -> dict[str, list[str]]:
    """The lower-cased terms of each kind of candidate: those of a table (kind, term) of at most GAZETTEER_TERMS rows, or the built-in ones."""
    if gazetteer is None:
        return {k: v.split() for k, v in GAZETTEER.items()}
    rows = gazetteer.select("kind", F.lower("term").alias("term")).dropna().distinct().limit(GAZETTEER_TERMS + 1).collect()
    if len(rows) > GAZETTEER_TERMS:
        raise ValueError(f"a gazetteer holds at most {GAZETTEER_TERMS} terms")
    return {k: [r["term"] for r in rows if r["kind"] == k] for k in WIDER}


def _votes(s: Column, lists: dict[str, list[str]]) -> dict[str, Column]:
    """The labelers' votes on a candidate (a struct of ``candidates``)."""
    span, before = s["span"], F.lower(s["before"])
    digits = F.regexp_replace(span, "[^0-9]", "")
    n = F.char_length(digits)

    def by_kind(**votes: Column) -> Column:
        out = F.when(s["kind"] == "number", votes["number"])
        for kind in ("address", "name", "secret"):
            out = out.when(s["kind"] == kind, votes[kind])
        return out

    def listed(kind: str, words: Column) -> Column:
        return F.exists(words, lambda w: w.isin(*lists[kind])) if lists.get(kind) else F.lit(False)

    own, front = F.split(F.lower(span), r"[^\p{L}]+"), F.split(before, r"[^\p{L}]+")
    return {
        "shape": by_kind(
            number=n.between(9, 16), address=span.rlike("[A-Za-z].*[A-Za-z]"), name=span.rlike(r" \p{Lu}\p{L}+ \p{Lu}"), secret=(F.char_length(span) >= 24) & span.rlike("[0-9].*[0-9]"),
        ),
        "checked": by_kind(
            number=(n.between(14, 19) & F.call_function("luhn_check", digits)) | (span.rlike(r"^(?:00|\()") & n.between(10, 15)), address=span.rlike(r"(?i)[^A-Za-z](?:com|org|net|edu|gov|io|de|fr|es|eu|info)$"),
            name=~F.lower(s["after"]).rlike(r"^[\p{L}]"), secret=span.rlike(r"^(?i:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$|^(?:AKIA|ASIA|gh[pousr]_|sk-|xox[abp]-|eyJ|AIza)") | (span.rlike("[a-z]") & span.rlike("[A-Z]") & span.rlike("[0-9]")),
        ),
        "listed": by_kind(number=listed("number", front), address=listed("address", own), name=listed("name", own), secret=listed("secret", front)),
        "near": by_kind(**{k: before.rlike(rf"(?:^|[^\p{{L}}]){p}" if k != "secret" else p) for k, p in NEARBY.items()}),
        "alone": s["before"].rlike(r"(?:^|[\s(\[<:,;=\"'])$") & s["after"].rlike(r"^(?:$|[\s)\]>.,;:\"'])"),
    }


def _features(s: Column, lists: dict[str, list[str]]) -> dict[str, Column]:
    """Features of a candidate, each of a few values, for the final classifier."""
    span, votes = s["span"], _votes(s, lists)
    digits = F.char_length(F.regexp_replace(span, "[^0-9]", ""))
    flag = lambda v: F.coalesce(v, F.lit(False)).cast("string")
    return {
        "digits": F.least(F.lit(20), digits).cast("string"), "length": F.least(F.lit(16), F.floor(F.char_length(span) / 4)).cast("string"),
        "marks": F.least(F.lit(6), F.char_length(F.regexp_replace(span, r"[0-9A-Za-z\s]", ""))).cast("string"),
        "context": F.concat(flag(votes["listed"]), F.lit("/"), flag(votes["near"])), "form": F.concat(flag(votes["shape"]), F.lit("/"), flag(votes["checked"])),
        "open": F.regexp_extract(s["before"], r"([^\p{L}\p{N}])$", 1).isin(" ", "\n", "\t", ":", "(", '"', "'", "=").cast("string"),
    }


def fit_reliabilities(patterns: dict[tuple[bool, ...], int], rounds: int = ROUNDS) -> tuple[float, list[tuple[float, float]]]:
    """EM for two classes and independent labelers: (share of personal data, each labeler's vote rates when it is and is not).

    BELIEF is worth STRENGTH votes of each class, so that a few candidates, or such as all look alike, do not turn a
    labeler's meaning round.
    """
    n = sum(patterns.values())
    share, rates = SHARE, list(BELIEF.values())
    for _ in range(rounds if n else 0):
        weight = {v: posterior(v, share, rates) for v in patterns}
        yes = sum(weight[v] * c for v, c in patterns.items())
        share = min(0.999, max(0.001, (yes + STRENGTH * SHARE) / (n + STRENGTH)))
        rates = [
            ((sum(weight[v] * c for v, c in patterns.items() if v[k]) + STRENGTH * p) / (yes + STRENGTH), (sum((1 - weight[v]) * c for v, c in patterns.items() if v[k]) + STRENGTH * q) / (n - yes + STRENGTH))
            for k, (p, q) in enumerate(BELIEF.values())
        ]
    return share, rates


def posterior(votes: tuple[bool, ...], share: float, rates: list[tuple[float, float]]) -> float:
    odds = math.log(share / (1 - share))
    for v, (p, q) in zip(votes, rates, strict=True):
        odds += math.log(p / q) if v else math.log((1 - p) / (1 - q))
    return 1 / (1 + math.exp(-max(-50.0, min(50.0, odds))))


def train(found: DataFrame, lists: dict[str, list[str]]) -> tuple:
    """(a classifier of a struct column of ``candidates`` as a function to a boolean Column, the fitted model).

    What reaches the driver is the table of vote patterns (2**5 rows a kind) and that of feature values (some hundreds).
    """
    each = found.select(F.explode(F.filter("spans", lambda s: ~s["base"])).alias("s"))
    votes = F.struct(*[F.coalesce(v, F.lit(False)).alias(k) for k, v in _votes(F.col("s"), lists).items()])
    features = F.array(*[F.concat_ws("=", F.concat_ws(".", F.col("s.kind"), F.lit(k)), v) for k, v in _features(F.col("s"), lists).items()])
    # candidates are counted by votes and features before anything moves
    counts = saved(each.select(F.col("s.kind").alias("kind"), votes.alias("v"), features.alias("f")).groupBy("kind", "v", "f").count(), "votes")
    patterns: dict[str, dict[tuple[bool, ...], int]] = {k: {} for k in WIDER}
    for kind, v, n in counts.groupBy("kind", "v").agg(F.sum("count").alias("n")).collect():
        patterns[kind][tuple(v)] = n
    fitted = {kind: fit_reliabilities(p) for kind, p in patterns.items()}
    belief = {(kind, v): posterior(v, *fitted[kind]) for kind, p in patterns.items() for v in p}
    pairs = [x for (kind, v), w in belief.items() for x in (F.lit(kind + "".join("01"[b] for b in v)), F.lit(w))]
    key = F.concat("kind", *[F.col(f"v.{k}").cast("int").cast("string") for k in LABELERS])
    weighed = counts.withColumn("w", F.element_at(F.create_map(*pairs), key) if pairs else F.lit(0.0))
    sums = weighed.select("kind", F.explode("f").alias("f"), "count", "w").groupBy("kind", "f").agg(F.sum(F.col("count") * F.col("w")).alias("yes"), F.sum(F.col("count") * (1 - F.col("w"))).alias("no")).collect()
    yes, no = ({k: sum(f(belief[k, v]) * c for v, c in p.items()) for k, p in patterns.items()} for f in (lambda w: w, lambda w: 1 - w))
    odds = {r["f"]: math.log((r["yes"] + 1) / (yes[r["kind"]] + 2)) - math.log((r["no"] + 1) / (no[r["kind"]] + 2)) for r in sums}
    bias = {k: math.log((yes[k] + 1) / (no[k] + 1)) for k in WIDER}
    table = F.create_map(*[x for k, v in sorted((odds | bias).items()) for x in (F.lit(k), F.lit(v))])

    def accept(s: Column) -> Column:
        values = F.array(s["kind"], *[F.concat_ws("=", F.concat_ws(".", s["kind"], F.lit(k)), v) for k, v in _features(s, lists).items()])
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + F.coalesce(F.element_at(table, x), F.lit(0.0))) > 0

    model = {k: {"candidates": sum(patterns[k].values()), "share": fitted[k][0], "rates": dict(zip(LABELERS, fitted[k][1], strict=True)), "bias": bias[k]} for k in WIDER}
    return accept, model | {"odds": odds}


def _joined(spans: Column) -> Column:
    """kind:start:end by start, then kind as in KINDS and further kinds by name."""
    rank = lambda s: F.when(s["kind"] == "email", 1).when(s["kind"] == "ip", 2).when(s["kind"] == "card", 3).when(s["kind"] == "phone", 4).otherwise(5)
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), rank(s).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, gazetteer: DataFrame | None = None) -> DataFrame:
    """doc_id, spans: array<struct<kind, base, start, end, span, before, after>> of all accepted spans, base spans included."""
    prepare(docs.sparkSession)
    return _accepted(saved(candidates(docs), "candidates"), gazetteer)


def _accepted(found: DataFrame, gazetteer: DataFrame | None) -> DataFrame:
    accept, _ = train(found, word_lists(gazetteer))
    return found.withColumn("spans", F.filter("spans", lambda s: s["base"] | accept(s)))


def report(docs: DataFrame, gazetteer: DataFrame | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, and n_added (accepted candidates), for every row of ``docs`` (doc_id, text)."""
    found = find(docs, gazetteer)
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    added = F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"), added)


def mask(docs: DataFrame, mark: str = "<{}>", gazetteer: DataFrame | None = None) -> DataFrame:
    """``docs`` with each span's characters replaced by its kind; overlapping spans are masked once. A row keeps its place beside its spans, so nothing is joined."""
    prepare(docs.sparkSession)
    # a row travels as one struct, so no name of its columns can clash with what is beside it
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    found = _accepted(saved(candidates(rows, ["row"]), "candidates"), gazetteer)
    found = found.select("row", F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind")))).alias("places"))
    start, text = F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), F.col("row.text")
    done = F.aggregate(
        "places", start,
        lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct((-s["back"]).alias("at"), F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.format_string(mark.replace("{}", "%s"), s["kind"])).alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))),
    )
    masked = F.when(F.size("places") > 0, done).otherwise(text)
    return found.select(*[masked.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
