"""Host-level quality rules, in SQL functions only.

Document rules give counts per document. Failures are added up by host (the `source` column), which combines in the
tasks first, so a host with a third of all documents is no hot key. Over all hosts a beta prior is estimated from the mean and the spread of
the failure rates, weighted by documents; it shrinks the rates of hosts with few documents towards the common one. A host is
rejected if its shrunken rate of failing documents is above MAX_RATE, and the verdict is joined back to its
documents: the runtime splits a hot host, and broadcasts the hosts if they are few.

Repeated words: all windows of WINDOW words of a text are hashed; only a text with a repeated hash sorts them, finds the windows
found twice or more and counts the words under them. Work is linear in the words (n log n for such texts).

Defined results: a null text has no words and fails; a null host is a host of its own; repeated rows count as documents;
an empty table gives no rows. Other columns are passed through; made columns replace columns of their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from floegrid.llm.tables import cut, passing_through

WINDOW = 8
MIN_WORDS = 20
REPEATED_PERCENT = 30
MAX_RATE = 0.8
# White space between words, and the characters counted as symbols.
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
RULES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def let(value: Column, then) -> Column:
    """`then` of a value that is computed once; an expression named in a lambda would be evaluated for each element."""
    return F.transform(F.array(value), then)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t\\n\\x0B\\f\\r]+"), lambda w: w != "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of `window` words that are found twice or more in the text, the first find included."""
    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(hashes) - window + 1), lambda i: F.xxhash64(F.slice(hashes, i, window)))

    def covered(found: Column) -> Column:
        # Windows in the order of their hashes; a window is repeated if a neighbour has the same hash.
        placed = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def of(sorted_: Column) -> Column:
            n = F.size(sorted_)
            hits = F.filter(sorted_, lambda s, j: ((j > 0) & (F.get(sorted_, j - 1)["h"] == s["h"]))
                            | ((j < n - 1) & (F.get(sorted_, j + 1)["h"] == s["h"])))
            starts = F.array_sort(F.transform(hits, lambda s: s["i"]))
            # Every repeated window adds the words that lie beyond the one before it.
            return F.aggregate(starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("last")),
                               lambda acc, i: F.struct((acc["n"] + F.least(i - acc["last"], F.lit(window))).alias("n"), i.alias("last")),
                               lambda acc: acc["n"])
        return let(placed, of)

    def counted(found: Column) -> Column:
        return F.when(F.size(F.array_distinct(found)) < F.size(found), covered(found)).otherwise(F.lit(0).cast("long"))
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) > window, let(hashes, lambda h: let(windows(h), counted))).otherwise(F.lit(0).cast("long"))


def rule_counts(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words, all long."""
    filled = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(filled, "\n"), lambda s: F.length(F.translate(s, SPACES, "")) > 0)

    def of(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.translate(filled, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(filled) - F.length(F.translate(filled, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"))
    return let(words_of(filled), of)


def host_verdicts(rated: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """host, host_docs, host_failed, host_rate (shrunken) and host_kept, from rows with `host` and `base_failed`.

    With mean m and variance v of the hosts' rates beyond what chance alone gives, the prior has a = m s and b = (1 - m) s with s = m (1 - m) / v - 1.
    """
    hosts = rated.groupBy(host).agg(F.count(F.lit(1)).alias("host_docs"),
                                    F.sum(F.col("base_failed").cast("long")).alias("host_failed"))
    n, p = F.col("host_docs"), F.col("host_failed") / F.col("host_docs")
    prior = hosts.agg((F.sum("host_failed") / F.sum("host_docs")).alias("m"), F.sum(n * p * p).alias("sq"),
                      F.sum(n).alias("all"), F.count(F.lit(1)).alias("k"))
    spread = F.col("sq") / F.col("all") - F.col("m") * F.col("m")
    chance = F.col("m") * (1 - F.col("m")) * F.col("k") / F.col("all")
    v = F.greatest(spread - chance, F.lit(1e-4))
    strength = F.least(F.greatest(F.col("m") * (1 - F.col("m")) / v - 1, F.lit(2.0)), F.lit(1e4))
    prior = prior.select("m", strength.alias("s"))
    # One row, read as scalar subqueries of the plan.
    rate = (F.col("host_failed") + prior.select(F.col("m") * F.col("s")).scalar()) / (n + prior.select("s").scalar())
    return hosts.withColumn("host_rate", rate).withColumn("host_kept", F.col("host_rate") <= max_rate)


@passing_through("_r", "_host")
def judge(docs: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """`docs` with the document rules, base_failed, the host's figures and kept."""
    made = [*RULES, "base_failed", "host_docs", "host_failed", "host_rate", "host_kept", "kept"]
    counted = docs.drop(*made).withColumn("_r", rule_counts(F.col(text)))
    rated = (counted.select("*", "_r.*").drop("_r")
             .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                         | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))))
    rated = cut(rated)
    # Written, so that the join shuffles both sides and the runtime can split a host with very many documents.
    verdicts = cut(host_verdicts(rated, host, max_rate)).withColumnRenamed(host, "_host")
    return (rated.join(verdicts, rated[host].eqNullSafe(verdicts["_host"]), "left").drop("_host")
            .withColumn("kept", ~F.col("base_failed") & F.col("host_kept")))
