"""Personal data and the terms that disclose it (operator 10; DataFrame functions only).

Base: e-mail addresses, IP addresses, card numbers and phone numbers are found with their positions (code points).
Method: over the whole corpus it is counted in how many documents a protected entity occurs, in how many a term, and in
how many both do, wherever they stand; words inside base spans are no terms of their document. A term tells
PMI(term; entity) = log(P(entity | term) / P(entity)) of the entity's information IC = -log P(entity). A term that tells at
least ``disclose`` of some entity is a span of kind ``term`` wherever it stands in the corpus outside base spans, in
documents without base spans too; it is generalised to a placeholder, or removed where it tells at least ``remove``.
Base spans always stay. Three kinds of entities are protected:

* each value found. Most values occur once, and then every rare word of the document would "tell" them; so term and
  entity must meet in ``support`` documents for there to be evidence.
* what recurs in values: the host of an address, the network of an IP, the issuer of a card, the prefix of a phone
  number, and the kind itself. P(entity | term) is shrunk to the lower end of its confidence interval (Wilson's, ``z``
  standard errors), so that words which met an entity by chance a few times tell little.
* the name in an address: a word (``NAME`` letters or more) of the part before the @ is known to belong to the address;
  elsewhere it tells log(N / n(word)) of its log(N / n(address)), without further evidence.

A pair tells enough only if P(entity | term) >= P(entity)^(1 - disclose); as n(term, entity) is at most n(entity), and the
shrunk share at most n / (n + z^2), terms that are too frequent or too rare for an entity are left out before pairs are
counted, with the same result. Texts are read once: spans and distinct words of each are stored. Counts are combined
map-side; terms and entities of up to ``MOST_BROADCAST`` rows go to the documents, beyond that both sides are shuffled.
Positions are taken only in texts that have a disclosing term; texts are shuffled only where over ``MOST_BROADCAST`` have
one.

Patterns are the contract's, written so that Java's engine does not backtrack or recurse over long runs: possessive
where the next character cannot belong to the run, and starting only at the start of a run.

Defined results: null and empty texts have no spans (the hash of an empty string). Ids may be null or repeated;
repeated rows give repeated results; an empty table gives an empty result; other columns, of whatever name, are not read
by ``detect`` and are kept by ``sanitise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import fresh, materialize

KINDS = ("email", "ip", "card", "phone")
SUPPORT, DISCLOSE, REMOVE, MOST_BROADCAST = 3, 0.9, 0.99, 200_000
Z, NAME = 3.0, 4  # standard errors of the shrunk share; letters of a name
RUN = 16  # matches whose positions are added up at a time

# Kind -> (a cheap test, the pattern). \G is the end of the match before: a run may start there.
_PATTERNS = {
    "email": (r"@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": (r"[0-9][ -]?[0-9][ -]?[0-9]", r"(?:\G|(?<![0-9]))[0-9](?:[ -]?[0-9]){13,}+"),
    "phone": (r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]"),
}
_TERM = r"\p{L}++"
_NO_SPANS = "cast(array() as array<struct<s:int,e:int,v:string>>)"


def _let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def found(text: Column, pattern: str) -> Column:
    """array<struct<s, e, v>>: leftmost non-overlapping matches with their positions (end exclusive). Positions are
    added up in runs, as an array that grows by one match at a time costs the square of its length."""
    gaps = F.split(text, pattern, -1)
    start = lambda acc, x: acc["at"] + x["gap"]
    end = lambda acc, x: start(acc, x) + F.length(x["hit"])

    def in_runs(pairs):
        return F.transform(F.sequence(F.lit(0), F.floor(F.size(pairs) / RUN).cast("int")), lambda i: F.slice(pairs, i * RUN + 1, F.lit(RUN)))

    def starts(runs):
        lengths = F.transform(runs, lambda run: F.aggregate(run, F.lit(0), lambda acc, x: acc + x["gap"] + F.length(x["hit"])))
        return F.aggregate(
            lengths, F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<int>)").alias("out")),
            lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")),
            lambda acc: acc["out"])

    def placed(run, at):
        return F.aggregate(
            run, F.struct(at.alias("at"), F.expr(_NO_SPANS).alias("out")),
            lambda acc, x: F.struct(end(acc, x).alias("at"), F.concat(acc["out"], F.array(F.struct(
                start(acc, x).alias("s"), end(acc, x).alias("e"), x["hit"].alias("v")))).alias("out")),
            lambda acc: acc["out"])

    pairs = _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: F.zip_with(
        F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.struct(F.length(g).alias("gap"), h.alias("hit"))))
    return _let(_let(pairs, in_runs), lambda runs: F.flatten(F.zip_with(runs, starts(runs), placed)))


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(v: Column) -> Column:
    d = _digits(v)
    n = F.length(d)
    one = lambda i: F.substr(d, i, F.lit(1)).cast("int")
    twice = lambda i: one(i) * 2 - F.when(one(i) > 4, 9).otherwise(0)
    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0),
                       lambda acc, i: acc + F.when((n - i) % 2 == 1, twice(i)).otherwise(one(i))) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    n = F.length(_digits(v))
    if kind == "ip":
        part = lambda x: F.regexp_replace(x, "^0+", "")
        return F.forall(F.split(v, r"\."), lambda x: F.when(F.length(part(x)) <= 3, F.concat(F.lit("0"), part(x)).cast("int") <= 255).otherwise(False))
    if kind == "card":
        return F.when(n.between(14, 19), _luhn(v)).otherwise(False)
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<s, k, e, kind, v>> sorted by start, then kind as listed."""
    none = F.expr("cast(array() as array<struct<s:int,k:int,e:int,kind:string,v:string>>)")

    def of_kind(k, kind):
        test, pattern = _PATTERNS[kind]
        spans = F.transform(F.filter(found(text, pattern), lambda x: _valid(kind, x["v"])), lambda x: F.struct(
            x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e"), F.lit(kind).alias("kind"), x["v"].alias("v")))
        return F.when(text.rlike(test), spans).otherwise(none)

    return F.sort_array(F.concat(*(of_kind(k, kind) for k, kind in enumerate(KINDS))))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def _entity(x: Column) -> Column:
    return F.concat(x["kind"], F.lit(":"), F.when(x["kind"].isin("card", "phone"), _digits(x["v"])).otherwise(F.lower(x["v"])))


def _outside(text: Column, spans: Column) -> Column:
    """array<struct<lo, hi>>: the stretches of the text between its base spans."""
    none = F.expr("cast(array() as array<struct<lo:int,hi:int>>)")
    stretch = lambda lo, hi: F.array(F.struct(lo.alias("lo"), F.greatest(lo, hi).alias("hi")))
    return F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.concat(acc["out"], stretch(acc["at"], x["s"])).alias("out")),
        lambda acc: F.concat(acc["out"], stretch(acc["at"], F.length(text))))


def _part(text: Column, x: Column) -> Column:
    return F.substr(text, x["lo"] + 1, x["hi"] - x["lo"])


def _distinct_terms(words: Column) -> Column:
    return F.array_distinct(F.transform(F.array_distinct(words), F.lower))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_TERM), F.lit(0))


def terms_at(text: Column, spans: Column) -> Column:
    """array<struct<s, e, term>>: all words outside the base spans."""
    return F.flatten(F.transform(_outside(text, spans), lambda x: F.transform(found(_part(text, x), _TERM), lambda t: F.struct(
        (t["s"] + x["lo"]).alias("s"), (t["e"] + x["lo"]).alias("e"), F.lower(t["v"]).alias("term")))))


def _with_spans(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(*columns, F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("spans", base_spans(F.col("text")))


def _recurring(x: Column) -> Column:
    """array<string>: what a span shares with other values of its kind, and the kind."""
    v, kind = _entity(x), x["kind"]
    part = (F.when(kind == "email", F.regexp_extract(v, "@(.*)$", 1)).when(kind == "ip", F.regexp_extract(v, r"^ip:([0-9]+\.[0-9]+)", 1))
            .when(kind == "card", F.substring(v, 6, 6)).otherwise(F.substring(v, 7, 5)))
    return F.array(F.concat(F.lit("part:"), kind, F.lit(":"), part), F.concat(F.lit("kind:"), kind))


def _names(x: Column) -> Column:
    """array<struct<name, entity>>: the words of the local part of an address."""
    local = F.regexp_extract(F.lower(x["v"]), "^([^@]*)@", 1)
    words = F.filter(F.array_distinct(_words(local)), lambda w: F.length(w) >= NAME)
    return F.transform(words, lambda w: F.struct(w.alias("name"), _entity(x).alias("entity")))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, spans, text_key, words (distinct, outside base spans), and for rows with spans: values, recurring (parts
    and kinds) and names. One projection over the texts."""
    text, some = F.col("text"), F.size("spans") > 0
    outside = F.flatten(F.transform(_outside(text, F.col("spans")), lambda x: _words(_part(text, x))))
    found = _with_spans(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return found.select(
        "doc_id", "spans", F.md5(text.cast("binary")).alias("text_key"), _distinct_terms(F.when(some, outside).otherwise(_words(text))).alias("words"),
        F.when(some, F.array_distinct(F.transform("spans", _entity))).alias("values"),
        F.when(some, F.array_distinct(F.flatten(F.transform("spans", _recurring)))).alias("recurring"),
        F.when(some, F.flatten(F.transform(F.filter("spans", lambda x: x["kind"] == "email"), _names))).alias("names"))


def _sent(df: DataFrame) -> DataFrame:
    """``df``, broadcast if its size, which is checked, allows it."""
    return F.broadcast(df) if df.count() <= MOST_BROADCAST else df


def _lower_share(k: Column, n: Column, z: float) -> Column:
    """The lower end of Wilson's interval for the share k / n."""
    p = k / n
    return (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def disclosing_terms(docs: DataFrame, scanned: DataFrame, support: int = SUPPORT, disclose: float = DISCLOSE, z: float = Z) -> DataFrame:
    """term, told: the terms that tell at least ``disclose`` of an entity, and the most they tell of one."""
    total = float(scanned.count())
    count = F.count(F.lit(1))
    n, with_spans = F.col("n_entity"), scanned.filter("values is not null")
    need = F.pow(n / F.lit(total), F.lit(1 - disclose)) * (1 - 1e-9)  # the least share that tells enough
    listed = lambda name: with_spans.select(F.explode(name).alias("entity")).groupBy("entity").agg(count.alias("n_entity")).filter(n < total)
    entities = listed("values").filter(n >= support).select("entity", "n_entity", F.lit(False).alias("shrunk"), F.lit(support).cast("double").alias("least"))
    wide = listed("recurring").select("entity", "n_entity", F.lit(True).alias("shrunk"), F.greatest(z * z * need / (1 - need), F.lit(float(support))).alias("least"))
    entities = materialize(entities.unionByName(wide).withColumn("most", n / need).filter(F.col("least") <= F.col("most")), "entities")
    bounds = entities.agg(F.min("least").alias("least"), F.max("most").alias("most")).first()

    known = listed("values").withColumnRenamed("n_entity", "n_value")
    names = with_spans.select(F.explode("names").alias("x")).select("x.*").distinct().join(known, "entity")
    names = materialize(names.groupBy(F.col("name").alias("term")).agg(F.min("n_value").alias("n_value")), "names")

    counted = scanned.select(F.explode("words").alias("term")).groupBy("term").agg(count.alias("n_term"))
    counted = counted.join(_sent(names), "term", "left")
    inside = F.col("n_term").between(bounds["least"], bounds["most"]) if bounds["least"] is not None else F.lit(False)
    counted = materialize(counted.filter(inside | F.col("n_value").isNotNull()), "terms")

    ic = lambda k: F.log(F.lit(total) / k)
    spoken = counted.filter("n_value is not null").select("term", (ic(F.greatest("n_term", "n_value")) / ic(F.col("n_value"))).alias("told"))

    met = with_spans.select("words", F.explode(F.concat("values", "recurring")).alias("entity")).join(_sent(entities), "entity")
    pairs = (met.select("entity", "n_entity", "shrunk", "least", "most", F.explode("words").alias("term"))
             .join(_sent(counted.filter(inside).select("term", "n_term")), "term").filter(F.col("n_term").between(F.col("least"), F.col("most")))
             .groupBy("entity", "term", "n_entity", "n_term", "shrunk").agg(count.alias("n_both")).filter(F.col("n_both") >= support))
    share = F.when(F.col("shrunk"), _lower_share(F.col("n_both"), F.col("n_term"), z)).otherwise(F.col("n_both") / F.col("n_term"))
    found = pairs.select("term", (1 + F.log(share) / ic(n)).alias("told"))
    told = found.unionByName(spoken).filter(F.col("told") >= disclose - 1e-9)
    return materialize(told.groupBy("term").agg(F.max("told").alias("told")), "disclosing")


def term_spans(docs: DataFrame, scanned: DataFrame, told: DataFrame) -> DataFrame:
    """text_key, terms array<struct<s, k, e, kind, told>>: the disclosing terms of each text that has some."""
    key = F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_key")
    # positions are dear: they are taken in the texts that have a disclosing term, and for those terms alone
    own = scanned.select("text_key", F.explode("words").alias("term")).join(_sent(told), "term")
    own = materialize(own.groupBy("text_key").agg(F.map_from_entries(F.collect_set(F.struct("term", "told"))).alias("own")), "term-texts")
    texts = _with_spans(docs.select(key, "text").join(_sent(own), "text_key"), "text_key", "own")
    hits = F.filter(terms_at(F.col("text"), F.col("spans")), lambda w: F.map_contains_key("own", w["term"]))
    spans = F.transform(hits, lambda w: F.struct(w["s"].alias("s"), F.lit(len(KINDS)).alias("k"), w["e"].alias("e"), F.lit("term").alias("kind"),
                                                 F.element_at("own", w["term"]).alias("told")))
    # copies of a text have equal spans
    return materialize(texts.select("text_key", F.sort_array(spans).alias("terms")).groupBy("text_key").agg(F.first("terms").alias("terms")), "term-spans")


def _few(marks: DataFrame) -> DataFrame:
    """Term spans by text, broadcast if they are few, so that what they are joined with is not shuffled."""
    n = marks.agg(F.sum(F.size("terms"))).first()[0] or 0
    return F.broadcast(marks) if n <= MOST_BROADCAST else marks


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def detect(docs: DataFrame, support: int = SUPPORT, disclose: float = DISCLOSE) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row per row of ``docs``."""
    scanned = materialize(scan(docs), "pii")
    marks = term_spans(docs, scanned, disclosing_terms(docs, scanned, support, disclose))
    rows = scanned.select("doc_id", "spans", "text_key").join(_few(marks), "text_key", "left")
    drop = lambda spans: F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), x["kind"].alias("kind")))
    every = F.when(F.col("terms").isNull(), _joined(F.col("spans"))).otherwise(
        _joined(F.sort_array(F.concat(drop(F.col("spans")), drop(F.col("terms"))))))
    base = F.sha2(_joined(F.col("spans")).cast("binary"), 256).alias("base_sha256")
    return rows.select("doc_id", *(_count(k) for k in KINDS), base, every.alias("spans"))


def sanitise(docs: DataFrame, support: int = SUPPORT, disclose: float = DISCLOSE, remove: float = REMOVE) -> DataFrame:
    """``docs`` with its base spans replaced by [EMAIL], [IP], [CARD], [PHONE], disclosing terms by [TERM], or by
    nothing where they tell at least ``remove``. All rows and columns stay; n_chars, if there, follows the text."""
    scanned = materialize(scan(docs), "pii")
    marks = term_spans(docs, scanned, disclosing_terms(docs, scanned, support, disclose))
    text = F.col("text")
    key, terms, spans = (fresh(docs, c) for c in ("_pii_text_key", "_pii_terms", "_pii_spans"))
    told = _few(marks.select("text_key", "terms")).select(F.col("text_key").alias(key), F.col("terms").alias(terms))
    rows = docs.withColumn(key, F.md5(F.coalesce(text, F.lit("")).cast("binary"))).join(told, key, "left").withColumn(
        spans, base_spans(F.coalesce(text, F.lit(""))))
    some = (F.size(spans) > 0) | F.col(terms).isNotNull()
    base = F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")).alias("to")))
    more = F.coalesce(F.transform(terms, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.when(x["told"] >= remove, "").otherwise("[TERM]").alias("to"))),
                      F.expr("cast(array() as array<struct<s:int,e:int,to:string>>)"))
    new = F.aggregate(
        F.sort_array(F.concat(base, more)), F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, x: F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.when(x["s"] >= acc["at"], F.concat(
            acc["out"], F.substr(text, acc["at"] + 1, x["s"] - acc["at"]), x["to"])).otherwise(acc["out"]).alias("out")),
        lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    out = rows.withColumn("text", F.when(some, new).otherwise(text)).select(*(F.col(f"`{c}`") for c in docs.columns))
    if dict(docs.dtypes).get("n_chars") in ("bigint", "int"):
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out


def op10(docs: DataFrame) -> DataFrame:
    return detect(docs)
