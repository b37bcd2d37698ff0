"""Information-theoretic sanitisation of personal data, in DataFrame functions only.

Base spans (email, ip, card, phone) come from regular expressions whose matches and gaps
give the offsets.  The corpus then says which other terms disclose a protected entity.  For
each term t and kind k, over whole documents,

    PMI(t; k) = log(co(t, k) * N / (df(t) * df(k)))        information that t gives about k
    IC(k)     = log(N / df(k))                             information that k holds

and the same for each term t and entity value v in place of k.  t exceeds the disclosure
threshold for k or v if PMI >= ``threshold`` * IC and it goes with it in at least ``min_texts``
different texts, so that copies are no evidence.  Every occurrence of such a term in a document
that holds an entity of k, or the entity v, becomes a span of kind ``term``; documents without
personal data get none.  Values are compared without case, cards and phones by their digits.
``sanitise`` generalises base spans to their kind and removes terms.

The term counts are partially aggregated before their shuffle, so a frequent word or a large
source costs one row per task.  Pairs of term and value are made for values in ``min_texts``
different texts only, as no other can pass, and aggregated by text and then by pair.  Only disclosing terms and the lines that hold them are joined.

Edge cases: a null text is empty and has no spans.  Equal texts share their statistics rows
in the join back, but every row counts in the corpus and gives a row of its own, whatever its
id.  Ties order by kind as listed, then start.  An empty table gives no rows.  Extra columns
are ignored."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

# Fixed patterns of the base kinds; possessive where nothing can be given back.  The look-behind
# keeps a long run of digits from being tried at each of its digits.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = r"\p{L}+"
SPAN = "array<struct<start:int,stop:int>>"


@dataclass(frozen=True)
class Disclosure:
    threshold: float = 0.9  # share of the entity's information that a term may give away
    min_texts: int = 5  # different texts in which a term must go with the kind or value


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _valid(kind: str, x: Column) -> Column:
    if kind == "ip":
        return x.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        n = F.length(_digits(x))
        return (n <= 19) & F.call_function("luhn_check", F.when(n <= 19, _digits(x)).otherwise(F.lit("0")))
    if kind == "phone":
        return F.length(_digits(x)).between(9, 15)
    return F.lit(True)


def _is_valid(kind: str) -> Callable[[Column], Column]:
    return lambda x: _valid(kind, x["body"])


def _valued(kind: str) -> Callable[[Column], Column]:
    """The tag of an entity: its kind and a digest of its value."""
    return lambda x: F.concat(F.lit(f"{kind}:"), F.xxhash64(_digits(x["body"]) if kind in ("card", "phone") else F.lower(x["body"])).cast("string"))


def _marked(mark: str) -> Callable[[Column], Column]:
    return lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), F.lit(mark).alias("mark"))


def _present(kind: str, text: Column) -> Column:
    """A quick test without which the pattern cannot match."""
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else r"[0-9][\x20-]?[0-9]")


def located(text: Column, pattern: str) -> Column:
    """Array of (start, stop, body) of every match, in code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.array().cast("array<struct<start:int,stop:int,body:string>>")

    def step(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        stop = start + F.length(pair["body"])
        return F.struct(stop.alias("at"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), stop.alias("stop"), pair["body"].alias("body")))).alias("out"))

    pairs = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: F.struct(g.alias("gap"), m.alias("body")))
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])


def _based(docs: DataFrame) -> DataFrame:
    """doc_id, body (null as empty) and one array of valid spans for each kind."""
    out = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("body"))
    none = F.array().cast("array<struct<start:int,stop:int,body:string>>")
    spans = [F.when(_present(k, F.col("body")), F.filter(located(F.col("body"), PATTERNS[k]), _is_valid(k)))
             .otherwise(none).alias(k) for k in KINDS]
    return out.select("doc_id", "body", *spans)


def _terms(line: Column) -> Column:
    """Distinct lower-case words of a text, those inside base matches left out."""
    for k in KINDS:
        line = F.when(_present(k, line), F.regexp_replace(line, PATTERNS[k], " ")).otherwise(line)
    return F.array_distinct(F.filter(F.split(F.lower(line), r"[^\p{L}]+"), lambda x: x != ""))


def _kinds() -> Column:
    return F.filter(F.array(*[F.when(F.size(k) > 0, F.lit(k)) for k in KINDS]), lambda x: x.isNotNull())


def _values() -> Column:
    return F.array_distinct(F.concat(*[F.transform(F.col(k), _valued(k)) for k in KINDS]))


def _tells(n: float, rule: Disclosure) -> Column:
    """PMI against the information of the entity; columns co, df (of the term), df_tag."""
    return (F.col("df_tag") < n) & (F.log(F.col("co") * n / (F.col("df") * F.col("df_tag"))) >= rule.threshold * F.log(F.lit(n) / F.col("df_tag")))


def disclosing_terms(based: DataFrame, rule: Disclosure) -> DataFrame:
    """(term, tag) whose occurrence tells too much about an entity of a kind (the tag is the kind)
    or about one entity (kind and digest of the value)."""
    total = ""  # no word is empty: this row counts all documents
    flags = [(F.size(k) > 0).cast("long").alias(f"has_{k}") for k in KINDS]
    counted = (based.select(F.explode(F.concat(F.array(F.lit(total)), _terms(F.col("body")))).alias("term"), *flags)
               .groupBy("term").agg(F.count("*").alias("df"), *[F.sum(f"has_{k}").alias(f"co_{k}") for k in KINDS])
               .where((F.col("term") == total) | (F.greatest(*[F.col(f"co_{k}") for k in KINDS]) >= rule.min_texts)))
    counted = stored(counted, "pii-terms")
    whole = counted.where(F.col("term") == total).first()
    if whole is None:
        return counted.select("term", F.lit("email").alias("tag")).limit(0)
    n = float(whole["df"])
    counted = counted.where(F.col("term") != total)
    per_kind = [F.struct(F.lit(k).alias("tag"), F.col(f"co_{k}").cast("double").alias("co"), F.lit(float(whole[f"co_{k}"])).alias("df_tag"))
                for k in KINDS]
    told = (counted.select("term", "df", F.explode(F.array(*per_kind)).alias("k")).select("term", "df", "k.*")
            .where((F.col("co") >= rule.min_texts) & _tells(n, rule)).select("term", "tag"))
    # Copies of one document are no evidence: the support is counted in different texts.
    holders = based.where(F.greatest(*[F.size(k) for k in KINDS]) > 0).select(
        F.xxhash64("body").alias("text_key"), _kinds().alias("kinds"), _values().alias("values"), _terms(F.col("body")).alias("terms"))
    of_kind = (holders.select("text_key", "kinds", F.explode("terms").alias("term")).join(told, "term").where(F.array_contains("kinds", F.col("tag")))
               .groupBy("term", "tag").agg(F.count_distinct("text_key").alias("n_texts")).where(F.col("n_texts") >= rule.min_texts))
    values = stored(based.where(F.greatest(*[F.size(k) for k in KINDS]) > 0)
                    .select(F.xxhash64("body").alias("text_key"), F.explode(_values()).alias("tag"))
                    .groupBy("tag", "text_key").agg(F.count("*").alias("n"))
                    .groupBy("tag").agg(F.sum("n").alias("df_tag"), F.count("*").alias("n_texts"))
                    .where(F.col("n_texts") >= rule.min_texts).select("tag", "df_tag"), "pii-values")
    of_value = (holders.select("text_key", "terms", F.explode("values").alias("tag")).join(values.select("tag"), "tag")
                .select("text_key", "tag", F.explode("terms").alias("term"))
                .groupBy("term", "tag", "text_key").agg(F.count("*").alias("n"))
                .groupBy("term", "tag").agg(F.sum("n").alias("co"), F.count("*").alias("n_texts")).where(F.col("n_texts") >= rule.min_texts)
                .join(values, "tag").join(counted.select("term", "df"), "term").where(_tells(n, rule)))
    return of_kind.select("term", "tag").unionAll(of_value.select("term", "tag"))


def _term_spans(based: DataFrame, terms: DataFrame) -> DataFrame:
    """key (digest of the text), extra: the spans of disclosing terms, by line."""
    holders = based.where(F.greatest(*[F.size(k) for k in KINDS]) > 0).select(
        F.md5("body").alias("key"), "body",
        F.concat(_kinds(), _values()).alias("tags"),
        F.transform(F.concat(*KINDS), lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"))).alias("base"))
    lines = holders.select("key", "tags", "base", F.explode(located(F.col("body"), r"[^\n]+")).alias("line"))
    words = lines.select("key", F.col("line.start").alias("at"), "tags", F.explode(F.array_distinct(F.split(F.lower("line.body"), r"[^\p{L}]+"))).alias("term"))
    telling = (words.join(terms, "term").where(F.array_contains("tags", F.col("tag")))
               .groupBy("key", "at").agg(F.collect_set("term").alias("telling")))  # at most the words of a line
    hit = lines.select("key", F.col("line.start").alias("at"), "base", F.col("line.body").alias("body")).join(telling, ["key", "at"])
    found = hit.select("key", "base", "at", F.explode(F.filter(located(F.col("body"), TERM), lambda x: F.exists(
        "telling", lambda t: t == F.lower(x["body"])))).alias("x"))
    spans = found.select("key", "base", (F.col("at") + F.col("x.start")).alias("start"), (F.col("at") + F.col("x.stop")).alias("stop"))
    free = spans.where(~F.exists("base", lambda b: (b["start"] < F.col("stop")) & (b["stop"] > F.col("start"))))
    return free.groupBy("key").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("extra"))  # at most the words of a text


def _listed(kind: str, spans: str) -> Column:
    return F.transform(F.col(spans), lambda x: F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["stop"].cast("string")))


def personal_data(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """One row per document: base counts, their digest, all spans, and the spans by kind."""
    based = _based(docs)
    terms = stored(disclosing_terms(based, rule), "pii-told")
    extra = _term_spans(based, terms)
    kept = based.select("doc_id", F.md5("body").alias("key"), *[
        F.transform(k, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"))).alias(k) for k in KINDS])
    out = kept.join(extra, "key", "left").withColumn("extra", F.coalesce("extra", F.array().cast(SPAN)))
    base = F.concat(*[_listed(k, k) for k in KINDS])
    return out.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
                      F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
                      F.array_join(F.concat(base, _listed("term", "extra")), ",").alias("spans"),
                      *[F.col(k).alias(f"{k}_spans") for k in KINDS], F.col("extra").alias("term_spans"), "key")


def sanitise(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """doc_id and the text with base spans generalised to their kind and telling terms removed."""
    found = personal_data(docs, rule)
    marked = F.array_sort(F.concat(*[
        F.transform(F.col(f"{k}_spans"), _marked(mark)) for k, mark in (*((k, f"[{k.upper()}]") for k in KINDS), ("term", ""))]))
    spans = found.select("key", marked.alias("marked")).dropDuplicates(["key"])
    body = F.coalesce(F.col("text"), F.lit(""))

    def step(acc: Column, x: Column) -> Column:
        fresh = x["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], x["stop"]).alias("at"), F.when(
            fresh, F.concat(acc["out"], F.substring(F.col("body"), acc["at"] + 1, x["start"] - acc["at"]), x["mark"])).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("marked", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(F.col("body"), acc["at"] + 1, F.length("body"))))
    return docs.select("doc_id", body.alias("body"), F.md5(body).alias("key")).join(spans, "key").select("doc_id", done.alias("text"))
