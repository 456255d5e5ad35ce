"""Quality rules: document rules, aggregated by host with an empirical beta prior, and joined back to documents.

Main path: SQL expressions only. Texts are read once; what later steps read is one narrow row for each document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payscope.llm.common import SPACE, key_of, let, lookup, materialize, plus

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A document is poor if more than this many of 100 characters are symbols, or of 100 lines are repeats.
MAX_SYMBOL_PERCENT = 30
MAX_DUP_LINE_PERCENT = 50
#: A host's documents go if its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
WINDOW = 5


def _repeat_words(words: Column) -> Column:
    """Words inside windows of WINDOW words that stand twice or more in the list, first places included."""

    def by_hash(h: Column) -> Column:
        def covered(s: Column) -> Column:
            def same(x: Column, i: Column) -> Column:
                return F.coalesce(F.get(s, i)["h"] == x["h"], F.lit(False))

            twice = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
            places = F.array_sort(F.transform(twice, lambda x: x["i"]))
            return let(places, lambda p: F.aggregate(F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))).cast("long")), F.lit(0).cast("long"), plus))

        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(ordered, covered))

    def hashes(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    return let(words, lambda w: F.when(F.size(w) < WINDOW + 1, F.lit(0).cast("long")).otherwise(let(hashes(w), by_hash)))


def measures(text: Column) -> Column:
    """struct(n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words) of a text; null counts as empty.

    Equal windows are told by a 64-bit hash of their words, within one document."""
    t = F.coalesce(text.cast("string"), F.lit(""))

    def of(words: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        chars = F.aggregate(F.transform(words, lambda w: F.length(w).cast("long")), F.lit(0).cast("long"), plus)
        return let(lines, lambda ls: F.struct(
            F.size(words).cast("long").alias("n_words"), chars.alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"), F.size(ls).cast("long").alias("n_lines"),
            _repeat_words(words).alias("n_repeat_words"),
        ))

    return let(F.array_remove(F.split(t, SPACE, -1), ""), of)


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(alpha, beta) by moments from hosts' (n, failed); one row reaches the driver. No hosts: (1, 1)."""
    rate = F.col("failed") / F.col("n")
    row = hosts.select(F.sum("failed").alias("f"), F.sum("n").alias("n"), F.avg(rate).alias("m"), F.var_samp(rate).alias("v"), F.avg(1 / F.col("n")).alias("r")).first()
    if not row["n"]:
        return 1.0, 1.0
    m = min(max(row["m"], 1e-3), 1 - 1e-3)
    between = max((row["v"] or 0.0) - m * (1 - m) * row["r"], 1e-6)
    size = min(max(m * (1 - m) / between - 1, 2.0), 1000.0)
    return m * size, (1 - m) * size


def apply_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row for each row of docs: doc_id, the measures, base_failed, rule_failed, host_rate, host_bad, kept.

    base_failed: fewer than MIN_WORDS words, or more than MAX_REPEAT_PERCENT of them in repeated windows.
    rule_failed: base_failed, or too many symbols or repeated lines. A host's rate of rule failures is shrunk with
    the beta prior of all hosts; above MAX_HOST_RATE its documents go. On other hosts, what passes the base stays.
    Null hosts form one host. Null and empty texts fail the base. Repeated rows each count, also where only their doc_id
    repeats. Empty tables give none. Texts are read whole, however long; other columns, of whatever name, aren't read."""
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), key_of(f"`{host}`").alias("host"), measures(F.col(f"`{text}`")).alias("_m"))
    narrow = narrow.select("doc_id", "host", "_m.*").withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    narrow = narrow.withColumn("rule_failed", F.col("base_failed") | (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("word_chars")) | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines")))
    narrow = materialize(narrow)
    hosts = materialize(narrow.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("rule_failed").cast("long")).alias("failed")))
    alpha, beta = beta_prior(hosts)
    rates = hosts.select("host", ((F.col("failed") + alpha) / (F.col("n") + alpha + beta)).alias("host_rate"))
    out = lookup(narrow, rates, "host", hosts.count()).withColumn("host_bad", F.col("host_rate") > MAX_HOST_RATE)
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_bad"))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns of op2."""
    return apply_rules(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule_failed", F.round("host_rate", 6).alias("host_rate"))
