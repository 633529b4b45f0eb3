"""Personal data and the terms that give it away.

Base spans are e-mail addresses, IPv4 addresses, card numbers (Luhn) and phone
numbers, found by patterns. Every distinct value is a protected entity. A term
in an entity's documents, wherever it stands, reveals it when the corpus says so:
with document frequencies ``n_e``, ``n_t``, ``n_et`` among ``N`` documents, the
disclosure is

    PMI(e; t) / IC(e) = log(N n_et / (n_e n_t)) / log(N / n_e),

1 when the term occurs only with the entity, 0 when it is independent of it.
It is weighted by the odds that the pair is no chance meeting: PRIOR_ODDS times
the likelihood ratio of the k among the entity's n different texts that hold the
term, at the share k / n against the term's share n_t / N of all documents. So
entities seen once or twice are judged too, by how rare the term is, and copies
of one text are evidence once. Terms whose weighted disclosure (``sure``) is
``GENERALISE_AT`` or more are generalised to their word class, at ``REMOVE_AT``
or more removed, at every place in each document that holds that entity;
documents without personal data are never touched.

DataFrame functions only. The patterns use possessive repeats and look-behinds
where these give the same matches, so no text needs deep recursion or quadratic
time. Offsets are code points, ends exclusive. Null texts are empty; repeated
rows, null and repeated keys are judged row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.common import let, materialise, table

KINDS = ("email", "ip", "card", "phone")
MIN_TERM_CHARS = 3
PRIOR_ODDS = 1e-3
GENERALISE_AT = 0.75
REMOVE_AT = 0.95
PART = 256

# The contract's patterns. A local part, or a number, can only start where a run
# of its characters starts or where the last match ended (\G).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Cheap tests that every text with a valid match passes.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]+\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
TERM = r"[\p{L}\p{N}]++"
NO_TERM = r"[^\p{L}\p{N}]+"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
SPAN = "struct<start:int,end:int,value:string>"


def _spans(text: Column, pattern: str) -> Column:
    """start, end, value of every match: what lies between matches gives their places."""
    def length(x: Column) -> Column:
        return x["gap"] + F.length(x["value"])

    def walk(part: Column, first: Column) -> Column:
        return F.aggregate(
            part, F.struct(first.alias("at"), F.array().cast(f"array<{SPAN}>").alias("out")),
            lambda a, x: F.struct(
                (a["at"] + length(x)).alias("at"),
                F.concat(a["out"], F.array(F.struct(
                    (a["at"] + x["gap"]).alias("start"), (a["at"] + length(x)).alias("end"),
                    x["value"].alias("value")))).alias("out")),
            lambda a: a["out"])

    def starts(parts: Column) -> Column:
        return F.aggregate(
            F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + length(x))),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")),
            lambda a: a["out"])

    def place(m: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(m))
        pairs = F.zip_with(gaps, m, lambda g, v: F.struct(F.length(g).alias("gap"), v.alias("value")))
        # In parts of PART matches, since appending to an array copies it.
        parts = let(pairs, lambda z: F.transform(
            F.sequence(F.lit(0), F.floor(F.greatest(F.size(z) - 1, F.lit(0)) / PART).cast("int")),
            lambda k: F.slice(z, k * PART + 1, F.lit(PART))))
        return let(parts, lambda p: F.flatten(F.zip_with(p, starts(p), walk)))
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    def add(a: Column, i: Column) -> Column:
        x = F.substring(d, F.length(d) - i + 1, F.lit(1)).cast("int")
        return a + F.when(i % 2 == 1, x).otherwise(x * 2 - F.when(x > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.rlike(value, F.lit(rf"^{OCTET}(?:\.{OCTET}){{3}}$"))
    if kind == "card":
        # The length first: digits of any number may stand here.
        return let(_digits(value), lambda d: F.when(F.length(d).between(16, 19), _luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _checker(kind: str):
    return lambda s: _valid(kind, s["value"])


def find(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base``: per kind (in the order of KINDS) the valid spans."""
    t = F.coalesce(F.col(text), F.lit(""))
    columns = {}
    for kind, pattern in PATTERNS.items():
        valid = F.filter(_spans(t, pattern), _checker(kind))
        columns[kind] = F.when(F.rlike(t, F.lit(HINTS[kind])), valid).otherwise(F.array().cast(f"array<{SPAN}>"))
    return df.withColumn("base", F.struct(*(c.alias(k) for k, c in columns.items())))


def _all_spans() -> Column:
    """kind (number), start, end, entity of all base spans."""
    def entity(n: int, kind: str):
        value = {"email": F.lower, "ip": lambda v: v}.get(kind, _digits)
        return lambda s: F.struct(F.lit(n).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                                  F.concat(F.lit(f"{n}:"), value(s["value"])).alias("entity"))

    return F.concat(*(F.transform(F.col(f"base.{k}"), entity(n, k)) for n, k in enumerate(KINDS)))


def _words(text: Column) -> Column:
    """The distinct terms of a text, in lower case."""
    parts = F.filter(F.array_distinct(F.split(text, NO_TERM)), lambda w: F.length(w) >= MIN_TERM_CHARS)
    return F.array_distinct(F.transform(parts, F.lower))


def _sure(disclosure: Column, total: Column) -> Column:
    """Disclosure times the probability that the pair is no chance meeting, from
    ``texts`` of the entity's ``texts_e`` texts and ``n_t`` of ``total`` documents."""
    k, n, q0 = F.col("texts"), F.col("texts_e"), F.col("n_t") / total
    q1 = k / n
    ratio = k * F.log(q1 / q0) + F.when(k < n, (n - k) * F.log((1 - q1) / (1 - q0))).otherwise(0.0)
    return F.when(q1 > q0, disclosure / (1 + F.exp(-ratio) / PRIOR_ODDS)).otherwise(0.0)


def _sets(holders: DataFrame) -> DataFrame:
    """row_id, text_hash and the distinct sets of documents (set, n_e, texts_e) of
    the entities in it: entities of the same documents share all their counts."""
    held = holders.select("row_id", "text_hash", F.explode("entities").alias("entity"))
    sets = held.groupBy("entity").agg(
        F.struct(F.bit_xor(F.xxhash64("row_id")).alias("a"), F.bit_xor(F.xxhash64("row_id", F.lit(1))).alias("b")).alias("set"),
        F.count(F.lit(1)).alias("n_e"), F.count_distinct("text_hash").alias("texts_e"))
    return held.join(sets, "entity").drop("entity").distinct()


def disclosing(holders: DataFrame, documents: DataFrame, text: str) -> DataFrame:
    """row_id, start, end, disclosure, sure of the terms to sanitise.

    ``holders``: row_id, text_hash, entities, body (text) of the documents with
    personal data, materialised. ``documents``: all documents, for the counts."""
    mentioned = holders.select("row_id", F.explode(_words(F.col("body"))).alias("term"))
    terms = materialise(mentioned.select("term").distinct(), "terms")
    words = documents.select(F.explode(_words(F.col(text))).alias("term"))
    counts = words.groupBy("term").agg(F.count(F.lit(1)).alias("n_t")).join(terms, "term")
    total = F.lit(documents.count()).cast("double")
    ic = F.log(total / F.col("n_e"))
    # n_et <= n_e, so no other pair can reach the threshold.
    able = F.log(total / F.col("n_t")) >= GENERALISE_AT * ic - 1e-9
    pairs = materialise(mentioned.join(counts, "term").join(_sets(holders), "row_id").where((ic > 0) & able), "pairs")
    rated = (pairs.groupBy("set", "term", "n_e", "texts_e", "n_t", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
             .groupBy("set", "term", "n_e", "texts_e", "n_t").agg(F.count(F.lit(1)).alias("texts"), F.sum("rows").alias("n_et"))
             .withColumn("disclosure", F.log(
                 total * F.col("n_et") / (F.col("n_e").cast("double") * F.col("n_t"))) / ic)
             .withColumn("sure", _sure(F.col("disclosure"), total))
             .where(F.col("sure") >= GENERALISE_AT).select("set", "term", "sure", "disclosure"))
    marked = (pairs.select("row_id", "set", "term").join(rated, ["set", "term"])
              .groupBy("row_id", "term").agg(F.max(F.struct("sure", "disclosure")).alias("m")))
    places = (holders.select("row_id", F.explode(_spans(F.col("body"), TERM)).alias("s"))
              .select("row_id", F.lower("s.value").alias("term"), "s.start", "s.end"))
    return places.join(marked, ["row_id", "term"]).select("row_id", "start", "end", "m.disclosure", "m.sure")


def detect(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns (default: all) with ``base`` (spans by kind) and
    ``terms`` (start, end, disclosure, sure, sorted); columns of these two names
    are replaced."""
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("base", "terms")]
    own = {c: f"own{i}" for i, c in enumerate(keep)}
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    based = find(df.select(*(F.col(f"`{c}`").alias(n) for c, n in own.items()), t.alias("__text")), "__text")
    based = based.withColumn("__spans", _all_spans())
    holds = F.size("__spans") > 0
    found = materialise(based.select(
        *own.values(), F.monotonically_increasing_id().alias("row_id"), F.xxhash64("__text").alias("text_hash"), "base",
        F.when(holds, F.array_distinct(F.transform("__spans", lambda x: x["entity"]))).alias("entities"),
        F.when(holds, F.col("__text")).alias("body")), "found")
    marked = disclosing(found.select("row_id", "text_hash", "entities", "body").where("body is not null"),
                        df.select(t.alias("__text")), "__text")
    terms = marked.groupBy("row_id").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "disclosure", "sure"))).alias("terms"))
    spans = F.concat(*(F.transform(F.col(f"base.{k}"), lambda x: F.struct(x["start"], x["end"])) for k in KINDS))

    def outside(x: Column) -> Column:
        return ~F.exists(spans, lambda o: (o["start"] < x["end"]) & (x["start"] < o["end"]))

    empty = F.array().cast("array<struct<start:int,end:int,disclosure:double,sure:double>>")
    return found.join(terms, "row_id", "left").select(
        *(F.col(n).alias(c) for c, n in own.items()), "base", F.coalesce(F.filter("terms", outside), empty).alias("terms"))


def sanitise(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with base spans replaced by <EMAIL>, <IP>, <CARD> or <PHONE>,
    disclosing terms by their class (<NUMBER>, <NAME> for a capital, <WORD>) or
    nothing. Null texts stay null."""
    own = {c: f"o{i}" for i, c in enumerate(df.columns)}
    t = own[text]
    d = detect(df.select(*(F.col(f"`{c}`").alias(n) for c, n in own.items())), t)
    def mark(by):
        return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), by(s).alias("by"))

    def tag(kind: str):
        return lambda s: F.lit(f"<{kind.upper()}>")

    def term(s: Column) -> Column:
        value = F.substring(F.col(t), s["start"] + 1, s["end"] - s["start"])
        return F.when(s["sure"] >= REMOVE_AT, F.lit("")).when(F.rlike(value, F.lit("^[0-9]+$")), F.lit("<NUMBER>")).when(
            F.rlike(value, F.lit(r"^\p{Lu}")), F.lit("<NAME>")).otherwise(F.lit("<WORD>"))

    marks = [*(F.transform(F.col(f"base.{k}"), mark(tag(k))) for k in KINDS), F.transform("terms", mark(term))]

    def redact(marks: Column) -> Column:
        # A mark that starts inside the one before it only moves its end.
        return F.aggregate(
            marks, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
            lambda a, x: F.struct(
                F.greatest(a["at"], x["end"]).alias("at"),
                F.when(x["start"] < a["at"], a["out"]).otherwise(F.concat(
                    a["out"], F.substring(F.col(t), a["at"] + 1, x["start"] - a["at"]), x["by"])).alias("out")),
            lambda a: F.concat(a["out"], F.substring(F.col(t), a["at"] + 1, F.length(t))))

    every = F.sort_array(F.concat(*marks))
    d = d.withColumn("__marks", every).withColumn("__new", F.when(F.size("__marks") > 0, redact(F.col("__marks")))
                                                  .otherwise(F.col(t)))
    return d.select(*(F.col("__new" if c == text else n).alias(c) for c, n in own.items()))


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def op7_disclosure(spark, sf_dir) -> DataFrame:
    """Counts and spans of every document."""
    d = detect(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
    base = F.concat(*(_listed(k, F.col(f"base.{k}")) for k in KINDS))
    return d.select(
        "doc_id", *(F.size(f"base.{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, _listed("term", F.col("terms"))), ",").alias("spans"))
