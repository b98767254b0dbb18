"""Personal data: base patterns, then identifiers found by bootstrapped contexts. Built-in functions only.

Base: leftmost, non-overlapping matches of one pattern for each kind, with checks (address parts up to 255,
Luhn sums, digit counts); a match that fails is dropped. Possessive groups keep the patterns linear and off the
stack, and match what the plain forms match.

Contexts: an identifier-like token is a run of non-space characters with a digit or an at sign, numbers go on over
single spaces, brackets, dots and hyphens ("+1 (017) 555-7713" is one). It stands in two patterns: the two words before it,
and the word before it with the token's own shape (letters, digits, punctuation). A base
match that begins in a token's first word makes it a seed, whose value is the whole match. Card and phone numbers
count by their digits, however they are grouped. Secrets have no base pattern: their seeds are tokens of a well-known
form (SECRET_SEED) that are assigned to a name. Over the graph of patterns and values, ROUNDS times: a pattern's confidence in a kind is the summed score of its values of that kind over
(its distinct values + 1), from MIN_SEEDS values on; a value's score is one less the product of its patterns' doubts.
Tokens that stand in a pattern of confidence MIN_CONFIDENCE and have the shape of the kind are added, seeds of secrets too.
All sums aggregate partially, so a frequent pattern or value does not gather in one task.

Spans are in code points, end exclusive. Defined results: null and empty texts have none. Equal rows get
equal results, each its own row. Extra columns do not matter. No rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wakeline.llm.keys import number
from wakeline.session import settle

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
ROUNDS = 3
MIN_SEEDS = 4
MIN_CONFIDENCE = 0.8

#: Equal to the plain patterns; starts are pinned to the start of a run, where the leftmost match begins.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
_SPACE = r"\x20\x09-\x0D"
_TOKEN = rf"(?<![^{_SPACE}])(?:[^0-9A-Za-z@+(:{_SPACE}]*+[+(]{{0,2}}+[0-9][0-9().-]*+(?:\x20[(]?[0-9][0-9().-]*+)*+[^{_SPACE}]*+|[^0-9@{_SPACE}]*+[0-9@][^{_SPACE}]*+)"
#: Numbers at the start of a token, to the end of one of its words. One whole word of that many digits ends there.
_WORD_END = r"(?=[^0-9A-Za-z@\x20]*(?:\x20|$))"
_CARD = (rf"^[0-9](?:[.-]?[0-9]){{12,18}}{_WORD_END}", rf"^[0-9](?:[\x20.-]?[0-9]){{12,18}}{_WORD_END}")
_PHONE = (rf"^[+(]{{0,2}}[0-9](?:[().-]*[0-9]){{9,14}}{_WORD_END}", rf"^[+(]{{0,2}}[0-9](?:[\x20().-]*[0-9]){{6,14}}{_WORD_END}")
#: Shape of a value that a context may add, per kind.
SHAPES = {
    "email": r"^[^@]+@[^@]+\.[^@]+$",
    "ip": r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$|^[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}$",
    "card": r"^[0-9](?:[.-]?[0-9]){12,18}$",
    "phone": r"^\+?[0-9(](?:[().-]*[0-9]){6,14}$",
    SECRET: r"^(?=[^0-9]*[0-9])(?=[^A-Za-z]*[A-Za-z])[A-Za-z0-9+/_-]{16,}={0,2}$",
}
#: Forms of keys and digests that services hand out (fixed values): 40 or 64 hex digits, and keys with a known prefix.
SECRET_SEED = r"^(?:[0-9a-f]{40}|[0-9a-f]{64}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{32,})$"
ASSIGNED = r"[=:]\s*$"


def _marked(text: Column, pattern: str) -> Column:
    """Parts of the text: others at even places, matches at odd ones."""
    return F.split(F.regexp_replace(text, f"(?:{pattern})", "\x02$0\x02"), "\x02")


def _bind(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda over a one-element array."""
    return F.get(F.transform(F.array(value), body), 0)


def _spans(parts: Column, chunk: int = 256) -> Column:
    """(start, end, value, before) of the odd parts.

    Starts are sums of lengths within a chunk of parts, and of the chunks before it. An accumulator that
    grows would be copied at each step, so none is kept.
    """
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)

    def found(p: Column, n: Column, sums: Column) -> Column:
        before = F.transform(sums, lambda _, c: total(F.slice(sums, F.lit(1), c)))

        def item(i: Column, starts: Column) -> Column:
            c = F.floor(i / chunk).cast("int")
            start = F.get(starts, c) + total(F.slice(n, c * chunk + 1, i % chunk))
            return F.struct(start.alias("start"), (start + F.get(n, i)).alias("end"), F.get(p, i).alias("value"), F.get(p, i - 1).alias("before"))

        odd = F.sequence(F.lit(1), F.size(p) - 1, F.lit(2))
        return _bind(before, lambda starts: F.transform(odd, lambda i: item(i, starts)))

    def measured(p: Column) -> Column:
        lengths = F.transform(p, F.length)
        chunks = F.sequence(F.lit(0), F.floor((F.size(p) - 1) / chunk).cast("int"))
        return _bind(lengths, lambda n: _bind(F.transform(chunks, lambda c: total(F.slice(n, c * chunk + 1, F.lit(chunk)))), lambda sums: found(p, n, sums)))

    none = F.array().cast("array<struct<start:int,end:int,value:string,before:string>>")
    return F.when(F.size(parts) < 2, none).otherwise(_bind(parts, measured))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n + 1 - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(F.sequence(F.lit(1), n), worth), F.lit(0), lambda a, x: a + x) % 10 == 0


_CHECKS = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"),
    "card": lambda v: F.when(F.length(_digits(v)).between(13, 19), luhn(_digits(v))).otherwise(F.lit(False)),
    "phone": lambda v: F.length(_digits(v)).between(9, 15),
}


def base_spans(df: DataFrame, text_col: str) -> DataFrame:
    """df with a column of spans for each kind and _tokens: the identifier-like tokens outside them or seeding them."""
    text = F.translate(F.coalesce(F.col(text_col), F.lit("")), "\x02", "\x03")  # the mark is free; lengths stay
    df = df.withColumn("_t", text).withColumn("_number", F.col("_t").rlike("[0-9]"))
    asked = {"email": F.col("_t").contains("@"), "ip": F.col("_number"), "card": F.col("_number"), "phone": F.col("_t").contains("+")}
    none = F.array(F.lit(""))
    df = df.withColumns({f"_p_{k}": F.when(asked[k], _marked(F.col("_t"), PATTERNS[k])).otherwise(none) for k in KINDS} | {"_p_token": F.when(F.col("_number") | asked["email"], _marked(F.col("_t"), _TOKEN)).otherwise(none)})
    passes = lambda k: lambda s: _CHECKS[k](s["value"])
    df = df.withColumns({k: F.filter(_spans(F.col(f"_p_{k}")), passes(k)) for k in KINDS} | {"_tokens": _spans(F.col("_p_token"))})
    return df.drop("_t", "_number", *(f"_p_{k}" for k in (*KINDS, "token")))


def _number(body: Column) -> Column:
    """The card or phone number that a token begins with, as written; the longer if it can be both, else empty."""
    first = lambda of: F.coalesce(*(F.nullif(F.regexp_extract(body, p, 0), F.lit("")) for p in of), F.lit(""))
    return _bind(first(_CARD), lambda c: _bind(first(_PHONE), lambda p: F.when(F.length(c) >= F.length(p), c).otherwise(p)))


_CHARS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_CLASSES = "9" * 10 + "A" * 26 + "a" * 26


def _token_rows(base: DataFrame) -> DataFrame:
    """_id, _h, start, end, pattern, value and kind, a row for each pattern of a token. kind is null for tokens in no base
    span; a span seeds where its first word is a token's first."""
    rows = base.where(F.size("_tokens") > 0).select("_id", "_h", *KINDS, F.explode("_tokens").alias("t"))
    lead = F.regexp_extract("t.value", r"^[^0-9A-Za-z@+(:]*", 0)
    rows = rows.withColumns({"_start": F.col("t.start") + F.length(lead), "_body": F.substr("t.value", F.length(lead) + 1), "_stop": F.col("t.start") + F.length(F.substring_index("t.value", " ", 1))})
    rows = rows.withColumns({"_first": F.regexp_replace(F.substring_index("_body", " ", 1), r"[^0-9A-Za-z:]+$", ""), "_digits": _number(F.col("_body"))})
    begins = lambda s: (s["start"] >= F.col("t.start")) & (s["start"] < F.col("_stop"))

    def meets(start: Column, end: Column) -> Column:
        out = F.lit(False)
        for k in KINDS:
            out = out | F.exists(k, lambda s: (s["start"] < end) & (s["end"] > start))
        return out

    kind = F.coalesce(*(F.when(F.exists(k, begins), F.lit(k)) for k in KINDS))
    whole = {k: F.get(F.filter(k, begins), 0)["value"] for k in KINDS}
    seed = F.coalesce(*(_digits(v) if k in ("card", "phone") else v for k, v in whole.items()))
    number = (F.col("_digits") != "") & ~F.col("_first").rlike(SHAPES["ip"]) & ~meets(F.col("_start"), F.col("_start") + F.length("_digits"))
    written = F.when(number, F.col("_digits")).otherwise(F.col("_first"))
    value = F.coalesce(seed, F.when(number, _digits(F.col("_digits"))).otherwise(F.col("_first")))
    tail = F.right(F.col("t.before"), F.lit(80))
    secret = kind.isNull() & value.rlike(SECRET_SEED) & tail.rlike(ASSIGNED)
    near = F.btrim(F.regexp_replace(F.lower(tail), rf"[{_SPACE}]+", " "))
    shape = F.when(value.rlike("^[0-9]*[a-f][0-9a-f]*$") & (F.length(value) >= 16), "hex").otherwise(F.translate(value, _CHARS, _CLASSES))
    # a bar stands in no two words that a space parts
    last = F.when(near != "", F.concat(F.substring_index(near, " ", -1), F.lit(" | "), shape))
    patterns = F.array_distinct(F.filter(F.array(F.substring_index(near, " ", -2), last), lambda p: p != ""))
    rows = rows.select("_id", "_h", F.col("_start").alias("start"), (F.col("_start") + F.length(written)).alias("end"), patterns.alias("patterns"), value.alias("value"), F.coalesce(kind, F.when(secret, SECRET)).alias("kind"), meets(F.col("t.start"), F.col("_stop")).alias("inside"))
    rows = rows.where((F.col("kind").isNotNull() | ~F.col("inside")) & (F.col("value") != ""))
    return rows.select("_id", "_h", "start", "end", F.explode("patterns").alias("pattern"), "value", "kind")


def _fits(kind: Column, value: Column) -> Column:
    out = F.lit(False)
    for k, shape in SHAPES.items():
        out = out | ((kind == k) & value.rlike(shape))
    return out


def learn(tokens: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS) -> DataFrame:
    """pattern, kind, confidence, from rows of (pattern, value, kind)."""
    edges = settle(tokens.groupBy("pattern", "value").agg(F.max("kind").alias("kind")))
    degree = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    seeds = edges.where("kind is not null").groupBy("value", "kind").agg(F.lit(1.0).alias("score"))
    pairs = edges.select("pattern", "value")
    scores, patterns = seeds, None
    for _ in range(rounds):
        found = pairs.join(scores, "value").groupBy("pattern", "kind").agg(F.sum("score").alias("s"), F.count_if(F.col("score") > 0.5).alias("k"))
        found = found.where(F.col("k") >= min_seeds).join(degree, "pattern")
        patterns = settle(found.select("pattern", "kind", (F.col("s") / (F.col("n") + 1)).alias("confidence")))
        doubt = F.sum(F.log(1 - F.col("confidence")))
        more = pairs.join(patterns.where("confidence > 0.5"), "pattern").where(_fits(F.col("kind"), F.col("value"))).groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("score"))
        scores = settle(seeds.unionByName(more).groupBy("value", "kind").agg(F.max("score").alias("score")))
    return patterns


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, min_confidence: float = MIN_CONFIDENCE, keep_key: bool = False) -> DataFrame:
    """id_col, a column of base spans (start, end) for each kind, and found (kind, start, end) by context.

    keep_key adds _key_id and _key_h, the id and the digest of the text.
    """
    keyed = df.select(F.col(id_col).alias("_own"), number(df, id_col).alias("_id"), F.xxhash64(text_col).alias("_h"), F.col(text_col).alias("_text"))
    base = settle(base_spans(keyed, "_text").drop("_text"))
    tokens = settle(_token_rows(base))
    sure = learn(tokens, rounds, min_seeds).where(F.col("confidence") >= min_confidence).withColumnRenamed("kind", "as")
    more = tokens.where(F.col("kind").isNull() | (F.col("kind") == SECRET)).join(sure, "pattern").where(_fits(F.col("as"), F.col("value")))
    more = more.groupBy("_id", "_h").agg(F.sort_array(F.collect_set(F.struct(F.col("as").alias("kind"), "start", "end"))).alias("found"))
    more = more.select(F.col("_id").alias("_i"), F.col("_h").alias("_g"), "found")
    out = base.join(more, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_h") == F.col("_g")), "left")
    bare = lambda k: F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k)
    key = [F.col("_id").alias("_key_id"), F.col("_h").alias("_key_h")] if keep_key else []
    return out.select(F.col("_own").alias(id_col), *map(bare, KINDS), F.coalesce("found", F.array().cast("array<struct<kind:string,start:int,end:int>>")).alias("found"), *key)


def written(*spans: tuple[str, Column]) -> Column:
    """kind:start:end, comma-joined, in the order of kinds as given, then start."""
    text = lambda k: lambda s: F.concat_ws(":", F.lit(k), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.concat(*(F.transform(F.sort_array(c), text(k)) for k, c in spans)), ",")


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base spans, their digest, all spans as text, and n_found, the spans that contexts add."""
    base = written(*((k, F.col(k)) for k in KINDS))

    def with_found(k: str) -> Column:
        own = F.filter("found", lambda s: s["kind"] == k)
        return F.concat(F.col(k), F.transform(own, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    own = lambda k: F.transform(F.filter("found", lambda s: s["kind"] == k), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    every = written(*((k, with_found(k)) for k in KINDS), (SECRET, own(SECRET)))
    n = [F.size(k) for k in KINDS]
    return found.select(id_col, *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(base, 256).alias("base_sha256"), every.alias("spans"), F.size("found").cast("long").alias("n_found"), sum(n, F.size("found")).cast("long").alias("n_spans"))


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with every found span in text_col replaced by its kind in brackets (the first of overlapping spans).

    Spans belong to an id and a text, so rows of one id and different texts keep their own.
    """
    names = df.columns
    rows = df.select(F.struct(*names).alias("row"), number(df, id_col).alias("_id"), F.xxhash64(text_col).alias("_g"), F.col(text_col).alias("_text"))
    spans = find(df.select(*dict.fromkeys([id_col, text_col])), id_col, text_col, keep_key=True)
    one = lambda k: F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(k).alias("kind")))
    more = F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    spans = spans.withColumn("_s", F.concat(*map(one, KINDS), more)).where(F.size("_s") > 0)
    # rows with one key have one text, and so the same spans
    spans = spans.groupBy(F.col("_key_id").alias("_i"), F.col("_key_h").alias("_k")).agg(F.max("_s").alias("_s"))
    out = rows.join(spans, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_g") == F.col("_k")), "left")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        piece = F.concat(a["out"], F.substring("_text", a["at"] + 1, s["start"] - a["at"]), F.lit("["), s["kind"], F.lit("]"))
        return F.when(s["start"] < a["at"], a).otherwise(F.struct(s["end"].alias("at"), piece.alias("out")))

    done = F.aggregate(F.sort_array("_s"), start, step)
    text = F.when(F.size("_s") > 0, F.concat(done["out"], F.substring("_text", done["at"] + 1, F.length("_text")))).otherwise(F.col("_text"))
    return out.withColumn("_new", text).select(*(F.col("_new").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names))
