"""Secret scan with Spark's own functions only: fixed patterns, and random strings told from identifiers by two Markov models.

The patterns give the base spans. Their values, and tokens that begin as keys of known kinds do, are the labelled samples of random strings; the
tokens of about WORD_ROWS other rows, chosen by hash, and some identifiers are those of ordinary words, paths and numbers. Two first-order character models
tell what follows which character in either; pairs that a model has seen little of fall back to how frequent their second character is, and half
of the model of random strings is that of even ones. Every other run of LEAST_RUN token characters with a letter in it gets the mean log-likelihood ratio of the two models over its character pairs; above THRESHOLD
it is a span too.

Splitting a text by a pattern gives the stretches between its matches; their lengths and those of the matches give code point places. Texts are
read twice: once for the samples, which are written, and once to be scanned.

Defined results: null and empty texts have no spans, counts of 0, the digest of an empty string and an empty list. Rows with a null doc_id and
repeated rows keep one output row each. Without samples of random strings their model is that of even ones alone. Further
columns pass through, but for one named found, in either case, which makes way for the result; texts are scanned whole. A run of digits is a number
and no secret. Runs that touch a base span are never a second span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.storage import staged, unused

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Fixed kinds in the order that breaks ties, each with its pattern and its least characters (of group 2 for assign).
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 8, "access": 16, "hex": 32}
#: Fixed beginnings of keys that services publish, each with what follows.
KNOWN = r"\b(?:gh[pousr]_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}|glpat-[A-Za-z0-9_-]{16,}|sk_(?:live|test)_[A-Za-z0-9]{16,}|xox[abprs]-[A-Za-z0-9-]{16,}|AIza[A-Za-z0-9_-]{30,}|npm_[A-Za-z0-9]{30,}|eyJ[A-Za-z0-9_-]{16,})"
#: Runs of so many token characters, a letter among them, are compared by the models.
LEAST_RUN = 16
RUN = rf"(?<![A-Za-z0-9+/_=-])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{{{LEAST_RUN},}}"
#: Nats a pair; character codes of a model; tokens of either class that a model may be fitted on, the first by hash; rows that give ordinary ones.
THRESHOLD = 0.5
CODES = 128
SAMPLE = 20_000
WORD_ROWS = 20_000
#: Fixed words that identifiers are often made of: they join the ordinary samples, two at a time in each of STYLES.
IDENTIFIERS = (
    "account action activity address agent amount archive article asset backend balance base batch block branch buffer build button cache "
    "calendar category channel check cluster code command config connection content context controller count customer data date default delete "
    "description detail device directory domain driver error event example factory field file filter font function group handler icon identifier "
    "image import index input interface internationalization item layout list listener loader local login main manager memory message method "
    "metric mobile model name node notification number object page parameter parser password path pattern payment permission person pipeline "
    "platform process profile project property protocol provider proxy query queue range reader record report request response result return role "
    "route router sample schedule schema script search section security selected server service session setting shared shell simple singleton "
    "source stack standard start state static status storage store strategy stream string style subject summary support switch symbol system "
    "table target task template terminal test text theme thread ticket time title token tracker transaction transform translation type update "
    "upload user utility validation value vector version video view virtual visible window wizard worker writer"
).split()
STYLES = ("{a}_{b}", "{a}-{b}", "{a}/{b}", "{a}{B}", "{A}{B}", "{a}_{b}_v{n}", "{a}/{n}/{b}")
#: Classes of token characters and their sizes.
CLASSES = {"[a-z]": 26, "[A-Z]": 26, "[0-9]": 10, "[+/_=-]": 5}
#: Ordinary tokens have this many characters; pairs that the share of a single character counts for in a model.
LEAST_WORD = 4
BACKED = 4.0
_NONE = "cast(array() as array<struct<start:bigint,end:bigint,value:string>>)"


def _spans(text: str, pattern: str, keep) -> Column:
    """Places of a pattern's matches in text: array of (start, end, value), as code points, of those that keep() accepts."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    none = F.expr(_NONE)

    def walked(matches: Column, gaps: Column) -> Column:
        # The place of each match's end, then of its start: sums over the gaps and matches before it, kept as one running list.
        step = lambda acc, x: F.struct((acc["at"] + F.length(x["gap"]) + F.length(x["value"])).alias("at"), F.when(keep(x["value"]), F.array_append(acc["spans"], F.struct((acc["at"] + F.length(x["gap"])).cast("bigint").alias("start"), (acc["at"] + F.length(x["gap"]) + F.length(x["value"])).cast("bigint").alias("end"), x["value"].alias("value")))).otherwise(acc["spans"]).alias("spans"))
        zipped = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("value"))
        return F.aggregate(zipped, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])

    # transform over one pair of lists names each of them once, so the pattern runs once for matches and once for gaps
    both = F.array(F.struct(found.alias("matches"), between.alias("gaps")))
    return F.element_at(F.transform(both, lambda x: F.when(F.size(x["matches"]) > 0, walked(x["matches"], x["gaps"])).otherwise(none)), 1)


def _long(least: int, pattern: str, group: int = 0):
    return lambda value: (F.length(F.regexp_extract(value, pattern, group)) if group else F.length(value)) >= least


def base_spans(text: str = "text") -> dict[str, Column]:
    """The spans of each base kind. The hex pattern finds runs of 32 or more: a run is a match of `[0-9a-f]+` whatever its length."""
    return {
        "assign": _spans(text, ASSIGN, _long(LEAST["assign"], ASSIGN, 2)),
        "access": _spans(text, ACCESS, _long(LEAST["access"], ACCESS)),
        "hex": _spans(text, r"(?<![0-9a-f])[0-9a-f]{32,}", lambda value: F.lit(True)),
    }


def _base(text: str) -> Column:
    """A struct of the spans of each base kind, computed for the rows with any sign of them."""
    sign = r"(?i)(?:password|passwd|secret|token|api_?key)[\x22']?\x20*[:=]|AKIA|[0-9a-f]{32}"
    spans = F.struct(*(v.alias(k) for k, v in base_spans(text).items()))
    none = F.expr("named_struct({})".format(", ".join(f"'{k}', {_NONE}" for k in LEAST)))
    return F.when(F.col(text).rlike(sign), spans).otherwise(none)


def samples(documents: DataFrame, sample: int = SAMPLE, word_rows: int = WORD_ROWS) -> DataFrame:
    """(random, token): at most `sample` different tokens of either class, the first by hash; those of random strings come from all rows, the
    ordinary ones from about word_rows rows."""
    every = max(1, documents.count() // word_rows)
    texts = documents.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    held = texts.select("text", _base("text").alias("base"), F.regexp_extract_all("text", F.lit(KNOWN), F.lit(0)).alias("known"))
    values = F.concat(F.transform("base.assign", lambda s: F.regexp_extract(s["value"], ASSIGN, 2)), F.transform("base.access", lambda s: s["value"]), F.transform("base.hex", lambda s: s["value"]), "known")
    plain = F.regexp_replace("text", F.lit(ASSIGN + "|" + ACCESS + r"|[0-9a-f]{16,}|" + KNOWN), F.lit(" "))
    words = F.filter(F.array_distinct(F.split(plain, "[^A-Za-z0-9+/_=-]+")), lambda w: F.length(w) >= LEAST_WORD)
    ordinary = F.when(F.pmod(F.xxhash64("text"), F.lit(every)) == 0, words).otherwise(F.filter("known", lambda w: F.lit(False)))
    both = held.select(F.explode(F.array(F.struct(F.lit(1).alias("random"), values.alias("v")), F.struct(F.lit(0).alias("random"), ordinary.alias("v")))).alias("x"))
    tokens = staged(both.select("x.random", F.explode("x.v").alias("token")).distinct(), "secret-samples")
    words = [style.format(a=a, b=b, A=a.capitalize(), B=b.capitalize(), n=n) for n, (a, b) in enumerate(zip(IDENTIFIERS, [*IDENTIFIERS[7:], *IDENTIFIERS[:7]], strict=True)) for style in STYLES]
    given = documents.sparkSession.range(1).select(F.lit(0).alias("random"), F.explode(F.split(F.lit(" ".join(words)), " ")).alias("token"))
    first = lambda k: tokens.filter(F.col("random") == k).orderBy(F.xxhash64("token"), "token").limit(sample)
    return first(1).union(first(0)).union(given)


def log_ratios(tokens: DataFrame) -> Column:
    """A scalar subquery: log P_random(b after a) - log P_ordinary(b after a) for each pair of codes, at a * CODES + b + 1 of one array."""
    pairs = tokens.select("random", "token", F.explode(F.sequence(F.lit(1), F.greatest(F.length("token") - 1, F.lit(1)))).alias("i")).filter(F.length("token") > 1)
    codes = pairs.select("random", F.ascii(F.substr("token", F.col("i"), F.lit(1))).alias("a"), F.ascii(F.substr("token", F.col("i") + 1, F.lit(1))).alias("b")).filter((F.col("a") < CODES) & (F.col("b") < CODES))
    counts = codes.groupBy("a", "b").agg(F.sum("random").alias("r"), F.sum(1 - F.col("random")).alias("w"))
    entry = lambda *names: F.map_from_entries(F.collect_list(F.struct("code", F.struct(*names))))
    before = counts.groupBy(F.col("a").alias("code")).agg(F.map_from_entries(F.collect_list(F.struct("b", F.struct("r", "w")))).alias("next"), F.sum("r").alias("r"), F.sum("w").alias("w")).agg(entry("next", "r", "w").alias("m"))
    single = counts.groupBy(F.col("b").alias("code")).agg(F.sum("r").alias("r"), F.sum("w").alias("w")).agg(entry("r", "w").alias("s"), F.coalesce(F.sum("r"), F.lit(0)).alias("r"), F.coalesce(F.sum("w"), F.lit(0)).alias("w"))
    model = before.crossJoin(single)  # one row each

    def ratio(code: Column) -> Column:
        row = F.try_element_at("m", F.floor(code / CODES).cast("int"))
        cell, alone = F.try_element_at(row["next"], (code % CODES).cast("int")), F.try_element_at("s", (code % CODES).cast("int"))
        share = lambda k: (F.coalesce(alone[k], F.lit(0)) + 0.5) / (F.col(k) + 0.5 * sum(CLASSES.values()))
        smoothed = lambda k: (F.coalesce(cell[k], F.lit(0)) + BACKED * share(k)) / (F.coalesce(row[k], F.lit(0)) + BACKED)
        # Samples of random strings show few alphabets: half of that model is a string that stays in a class of characters every other time.
        a, b = F.char(F.floor(code / CODES)), F.char(code % CODES)
        even = F.lit(0.5 / sum(CLASSES.values()))
        for kind, size in CLASSES.items():
            even = even + F.when(a.rlike(kind) & b.rlike(kind), 0.5 / size).otherwise(0.0)
        return F.log(0.5 * smoothed("r") + 0.5 * even) - F.log(smoothed("w"))

    return model.select(F.transform(F.sequence(F.lit(0), F.lit(CODES * CODES - 1)), ratio)).scalar()


def scan(documents: DataFrame, threshold: float = THRESHOLD, sample: int = SAMPLE, word_rows: int = WORD_ROWS) -> DataFrame:
    """documents(text, ...): the input's columns and `found`: an array of (kind, start, end), by start, then kind in the order of KINDS."""
    kept = [F.col(f"`{c}`") for c in documents.columns if c.lower() != "found"]
    text, base, spans, runs, ratios = (unused(documents, f"secrets_{c}") for c in ("text", "base", "spans", "runs", "ratios"))
    model = log_ratios(samples(documents.select("text"), sample, word_rows))

    def score(value: Column) -> Column:
        pair = lambda i: F.element_at(F.col(ratios), F.ascii(F.substr(value, i, F.lit(1))) * CODES + F.ascii(F.substr(value, i + 1, F.lit(1))) + 1)
        return F.aggregate(F.sequence(F.lit(1), F.length(value) - 1), F.lit(0.0), lambda acc, i: acc + pair(i)) / (F.length(value) - 1)

    def listed(kind: str) -> Column:
        return F.transform(f"{base}.{kind}", lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("n"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    more = F.transform(F.filter(runs, lambda s: ~F.exists(spans, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])) & (score(s["value"]) > threshold)), lambda s: F.struct(s["start"].alias("start"), F.lit(len(LEAST)).alias("n"), s["end"].alias("end"), F.lit(KINDS[-1]).alias("kind")))
    found = F.transform(F.array_sort(F.concat(F.col(spans), more)), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    held = documents.select(*kept, F.coalesce(F.col("text"), F.lit("")).alias(text))
    held = held.withColumn(base, _base(text)).withColumn(runs, F.when(F.col(text).rlike(RUN), _spans(text, RUN, lambda value: F.lit(True))).otherwise(F.expr(_NONE)))
    held = held.withColumn(spans, F.concat(*map(listed, LEAST))).withColumn(ratios, F.when(F.size(runs) > 0, model))
    return held.select(*kept, found.alias("found"))


def redacted(documents: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents, every found span (spans that overlap as one) replaced by mark; n_chars, where there is one, follows the text."""
    def step(acc: Column, s: Column) -> Column:
        end = F.greatest(acc["at"], s["end"])
        piece = F.when(s["start"] >= acc["at"], F.concat(F.substr("text", acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))), F.lit(mark))).otherwise("")
        return F.struct(end.alias("at"), F.concat(acc["out"], piece).alias("out"))

    rest = lambda acc: F.concat(acc["out"], F.substr("text", acc["at"] + 1, F.length("text")))
    clean = F.aggregate("found", F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out")), step, rest)
    # columns of the input that scan() would take for its own or that differ in case alone go by number meanwhile
    names = [f"held_{i}" if c not in ("text", "n_chars") else c for i, c in enumerate(documents.columns)]
    out = scan(documents.toDF(*names)).withColumn("text", F.when(F.size("found") > 0, clean).otherwise(F.col("text")))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.size("found") > 0, F.length("text").cast(documents.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, documents.columns, strict=True)))


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id and the counts and lists of scan()'s spans."""
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    number = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("found", lambda s: s["kind"] != KINDS[-1])
    return scanned.select("doc_id", *(number(k).alias(f"n_{k}") for k in LEAST), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"))
