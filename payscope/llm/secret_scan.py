"""Secret scans: rule spans, and random-looking tokens found with two character Markov models.

Main path: SQL expressions only. The models are first-order character chains, one of random strings and one of
ordinary identifiers, trained from labelled samples; a token's score is its log-likelihood ratio under the two.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payscope.llm.common import chunked, larger, let, prefix_folds, prefix_sums, smaller

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of at least the length asked for is the same as a run that is dropped where it is shorter: no shorter
#: match can hide a longer one of these two kinds.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
#: Training parameters: labelled strings made for each class, and what a token's ratio must reach.
N_SAMPLES = 6000
MIN_TOTAL = 15.0
MIN_MEAN = 0.6
#: Words of which ordinary identifiers are made.
IDENTIFIER_WORDS = (
    "account action array base block buffer build cache call chain change check class client code column command "
    "config connection content context control count create current data date default delete device document "
    "element entry error event example field file filter first format function global group handler header host "
    "image index input instance item key label language last length level line list load local main manager map "
    "message method mode model module name network node number object option order output package page parameter "
    "parent path pattern point process project property query queue range record reference region remote report "
    "request resource response result return root row schema script search section select server service session "
    "set size source stack start state status stop storage stream string system table target task test text thread "
    "time token total type update user value version view window word work write"
).split()


def default_samples(spark: SparkSession, n: int = N_SAMPLES) -> DataFrame:
    """(text, label): n random strings (label 1) and n identifiers (label 0), made from hashes, so reruns agree."""
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 512)
    base64 = F.regexp_replace(F.base64(F.unhex(digest)), r"[\r\n]", "")
    upper = F.translate(F.upper(base64), "+/=", "")
    random = F.when(F.col("id") % 4 == 0, F.substring(digest, 1, 40)).when(F.col("id") % 4 == 1, F.substring(upper, 1, 24)).otherwise(F.substring(base64, 1, 40))
    words = F.array(*map(F.lit, IDENTIFIER_WORDS))

    def word(k: int) -> Column:
        return F.element_at(words, (F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(IDENTIFIER_WORDS))) + 1).cast("int"))

    number = F.pmod(F.xxhash64("id", F.lit(9)), F.lit(2100)).cast("string")
    four = [word(k) for k in range(4)]
    style = F.col("id") % 8
    plain = (
        F.when(style == 0, F.concat_ws("_", *four))
        .when(style == 1, F.concat(four[0], *[F.initcap(x) for x in four[1:]]))
        .when(style == 2, F.concat_ws("-", *four))
        .when(style == 3, F.concat_ws("/", *four))
        .when(style == 4, F.upper(F.concat_ws("_", *four)))
        .when(style == 5, F.concat_ws("_", *four[:3], number))
        .when(style == 6, F.concat(*[F.initcap(x) for x in four]))
        .otherwise(F.concat(*four))
    )
    ids = spark.range(n)
    return ids.select(random.alias("text"), F.lit(1).alias("label")).unionByName(ids.select(plain.alias("text"), F.lit(0).alias("label")))


def train(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """The table of log-likelihood ratios, indexed by (previous symbol) * n + (symbol); previous 0 is the start.

    samples: (text, label 0/1); null texts and characters outside ALPHABET are skipped. The counts that reach the
    driver number at most 2 * (n + 1) * n, whatever the size of the samples."""
    n = len(ALPHABET)
    codes = F.filter(F.transform(F.split("text", ""), lambda c: F.instr(F.lit(ALPHABET), c)), lambda i: i > 0)
    pairs = samples.where("text IS NOT NULL AND text <> ''").select(F.col("label").cast("int").alias("label"), codes.alias("c"))
    pairs = pairs.select("label", F.explode(F.transform("c", lambda c, i: F.struct(F.when(i == 0, 0).otherwise(F.get("c", i - 1)).alias("a"), c.alias("b")))).alias("p"))
    count = [[[smoothing] * n for _ in range(n + 1)] for _ in range(2)]
    for label, a, b, k in pairs.groupBy("label", "p.a", "p.b").count().collect():
        count[int(label == 1)][a][b - 1] += k
    out = []
    for a in range(n + 1):
        plain, random = (sum(count[k][a]) for k in (0, 1))
        out += [math.log(count[1][a][b] / random) - math.log(count[0][a][b] / plain) for b in range(n)]
    return out


def ratio(token: Column, table: Column) -> Column:
    """Log-likelihood ratio of a token of ALPHABET's characters."""
    n = len(ALPHABET)
    codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), lambda c: F.instr(F.lit(ALPHABET), c))
    terms = let(codes, lambda cs: F.transform(cs, lambda c, i: F.get(table, (F.when(i == 0, 0).otherwise(F.get(cs, i - 1)) * n + c - 1).cast("int"))))
    return F.aggregate(terms, F.lit(0.0), lambda x, y: x + y)


def _spans(text: Column, pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """All matches, leftmost and non-overlapping, as structs (start, kind, end, token); offsets in code points."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found

    def build(ms: Column) -> Column:
        def spans(w: Column) -> Column:
            ends = let(prefix_sums(w), lambda sums: F.transform(sums, lambda s, i: s + F.get(w, i)))
            return F.transform(F.arrays_zip(ends.alias("start"), ms.alias("m"), part.alias("part")), lambda x: F.struct(
                x["start"].alias("start"), F.lit(kind).alias("kind"), (x["start"] + F.length(x["m"])).alias("end"), x["part"].alias("token")))

        gaps = F.split(text, pattern, -1)
        steps = let(gaps, lambda gs: F.transform(ms, lambda m, i: (F.length(F.get(gs, i)) + F.when(i == 0, 0).otherwise(F.length(F.get(ms, i - 1)))).cast("long")))
        return let(steps, spans)

    kept = F.filter(let(found, build), lambda s: F.length(s["token"]) >= least)
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,token:string>>")
    return F.when(text.rlike(pattern), kept).otherwise(empty)


def scan(docs: DataFrame, text: str = "text", model: list[float] | None = None, out: str = "secrets") -> DataFrame:
    """docs with a column `out`: array<struct<start, kind, end, token, score>> sorted by start, then kind, then end.

    Null and empty texts give an empty array; every row stays, repeated rows too. Kinds are indices of KINDS. A
    random token (kind 3) is a run of at least 20 token characters whose ratio reaches MIN_TOTAL and MIN_MEAN a
    character and that overlaps no rule span. An existing column named `out` is replaced; others stay as they are. Texts
    are searched whole, however long; of equal starts the kind listed first comes first. Empty tables give no rows."""
    model = train(default_samples(docs.sparkSession)) if model is None else model
    table = F.from_json(F.lit(json.dumps(model)), "array<double>")
    t = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    base = F.concat(_spans(t, ASSIGN, 0, group=2, least=6), _spans(t, ACCESS, 1), _spans(t, HEX, 2))

    def with_score(s: Column, score: Column) -> Column:
        return F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["token"].alias("token"), score.alias("score"))

    def add(b: Column) -> Column:
        free = let(_spans(t, TOKEN, 3), lambda tokens: F.when((F.size(b) == 0) | (F.size(tokens) == 0), tokens).otherwise(_free(tokens, b)))
        scored = F.transform(free, lambda s: with_score(s, ratio(s["token"], table)))
        new = F.filter(scored, lambda s: (s["score"] >= MIN_TOTAL) & (s["score"] >= MIN_MEAN * F.length(s["token"])))
        return F.array_sort(F.concat(F.transform(b, lambda s: with_score(s, F.lit(None).cast("double"))), new))

    return docs.withColumn(out, let(base, add))


def _free(tokens: Column, base: Column) -> Column:
    """The tokens that overlap no base span: none that starts before reaches into them, and the next starts after them."""
    none = F.lit(1 << 62).cast("long")

    def of(every: Column) -> Column:
        is_base = lambda s: s["kind"] < 3
        reached = prefix_folds(F.transform(every, lambda s: F.when(is_base(s), s["end"]).otherwise(F.lit(0).cast("long"))), larger, F.lit(0).cast("long"))
        following = F.reverse(prefix_folds(F.reverse(F.transform(every, lambda s: F.when(is_base(s), s["start"]).otherwise(none))), smaller, none))
        zipped = F.arrays_zip(every.alias("s"), reached.alias("reached"), following.alias("following"))
        return F.transform(F.filter(zipped, lambda z: (z["s"]["kind"] == 3) & (z["reached"] <= z["s"]["start"]) & (z["following"] >= z["s"]["end"])), lambda z: z["s"])

    return let(F.array_sort(F.concat(tokens, base)), of)


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of the array."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of op1."""
    found = scan(docs.select("doc_id", F.col("text").alias("_text")), "_text", out="_s")

    def n(kind: int) -> Column:
        return F.size(F.filter("_s", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
        F.sha2(joined(F.filter("_s", lambda s: s["kind"] < 3)), 256).alias("base_sha256"), joined(F.col("_s")).alias("spans"), n(3).alias("n_random"),
    )


def redact(docs: DataFrame, text: str = "text", mark: str = "<SECRET>", model: list[float] | None = None) -> DataFrame:
    """docs with every span of scan() replaced by `mark`; overlapping spans by one mark. Null texts stay null.

    Every row and every other column stays, whatever their names; empty tables give no rows."""
    t, out = F.col(f"`{text}`"), "_secrets"
    while out in docs.columns:
        out += "_"
    found = scan(docs, text, model, out=out)

    def merged(spans: Column) -> Column:
        """(start, end) of runs of overlapping spans."""

        def of(before: Column) -> Column:
            heads = F.filter(F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), F.get(before, i).alias("before"))), lambda h: h["start"] >= h["before"])
            last = F.array_max(F.transform(spans, lambda s: s["end"]))
            return let(heads, lambda hs: F.transform(hs, lambda h, i: F.struct(h["start"].alias("start"), F.coalesce(F.get(hs, i + 1)["before"], last).alias("end"))))

        return let(prefix_folds(F.transform(spans, lambda s: s["end"]), larger, F.lit(0).cast("long")), of)

    def cut(whole: Column, begin: Column, end: Column) -> Column:
        return F.substr(whole, (begin + 1).cast("int"), (end - begin).cast("int"))

    def rebuilt(runs: Column) -> Column:
        def of(chunks: Column) -> Column:
            def part(c: Column, b: Column) -> Column:
                """The text from the end of the chunk before to the end of this one's last run."""
                begin = F.when(b == 0, F.lit(0).cast("long")).otherwise(F.element_at(F.get(chunks, b - 1), -1)["end"])

                def pieces(own: Column, begin: Column) -> Column:
                    return F.array_join(F.transform(c, lambda r, i: F.concat(cut(own, F.when(i == 0, begin).otherwise(F.get(c, i - 1)["end"]) - begin, r["start"] - begin), F.lit(mark))), "")

                return let(begin, lambda at: let(cut(t, at, F.element_at(c, -1)["end"]), lambda own: pieces(own, at)))

            return F.concat(F.array_join(F.transform(chunks, part), ""), F.substr(t, (F.element_at(F.element_at(chunks, -1), -1)["end"] + 1).cast("int"), F.length(t)))

        return let(chunked(runs), of)

    new = F.when(F.size(F.col(out)) == 0, t).otherwise(let(merged(F.col(out)), rebuilt))
    return found.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])
