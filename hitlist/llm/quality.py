"""Quality rules of documents and of their hosts, in SQL expressions.

``metrics`` counts per document; ``rule_failures`` turns the counts into one flag a rule.
``host_verdicts`` sums failures by host, fits a beta prior to the hosts' failure rates
(method of moments, weighted by documents), and shrinks each host's rate towards it: a host
of few documents gets the prior's rate, a large one its own. A host is rejected where a
shrunk rate exceeds the rule's limit. ``judge`` joins the verdicts back: a document is kept
if no base rule fails and its host isn't rejected.

Words are runs of characters other than ASCII white space. Null text has no words, so it
fails. A null host is a host of its own. Rows that repeat an id are judged row by row. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hitlist.llm.shared import SPACES, broadcast_if_small, fresh, stage

#: Base rules: fewer words than this; more than this share of words in repeated windows.
MIN_WORDS, MAX_REPEATED = 50, 0.5
#: Rules that count for hosts only: symbols a word, and repeated lines a line.
MAX_SYMBOLS, MAX_DUP_LINES = 0.5, 0.5
#: A host is rejected where the shrunk rate of failures exceeds this.
MAX_HOST_RATE = 0.9

RULES = ("too_short", "repetitive", "symbols", "dup_lines")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACES), "")


def repeated_words(ws: Column) -> Column:
    """Words of an array that lie in 3-word windows found at least twice in it.

    A window becomes a long: the low bits its position, the others its hash. Sorted, equal
    hashes are neighbours; the words themselves decide whether the windows are equal."""
    n = F.size(ws)
    bits = F.ceil(F.log2(n + F.lit(1))).cast("int")

    def same(p, q):
        return (ws[p] == ws[q]) & (ws[p + 1] == ws[q + 1]) & (ws[p + 2] == ws[q + 2])

    def count(b):
        def at(x):
            return x.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), b) - 1).cast("int")

        def top(x):
            return F.call_function("shiftrightunsigned", x, b)

        def key(i):
            h = F.xxhash64(ws[i], ws[i + 1], ws[i + 2])
            return F.call_function("shiftleft", h, b).bitwiseOR(i.cast("long"))

        def covered(s):
            def repeated(x, k):
                before, after = F.get(s, k - 1), F.get(s, k + 1)
                return F.coalesce((top(before) == top(x)) & same(at(before), at(x)), F.lit(False)) | F.coalesce(
                    (top(after) == top(x)) & same(at(after), at(x)), F.lit(False)
                )

            found = F.transform(F.filter(s, repeated), lambda x: F.array(at(x), at(x) + 1, at(x) + 2))
            return F.size(F.array_distinct(F.flatten(found)))

        return _let(F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), key)), covered)

    return F.when(n < 4, F.lit(0)).otherwise(_let(bits, count))


def metrics(docs: DataFrame, host: str = "source") -> DataFrame:
    """doc_id, host and the counts of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select(
        "doc_id",
        F.col(host).cast("string").alias("host"),
        _let(
            words(text),
            lambda ws: F.struct(
                F.size(ws).cast("long").alias("n_words"),
                F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
                repeated_words(ws).cast("long").alias("n_repeat_words"),
            ),
        ).alias("w"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        _let(
            F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\n\x0b\x0c\r")) != ""),
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("l"),
    )
    return counted.select("doc_id", "host", "w.*", "n_symbols", "l.*")


def rule_failures(counted: DataFrame) -> DataFrame:
    """Adds a flag for each of RULES, and base_failed (of the first two)."""
    n = F.col("n_words")
    return counted.withColumns(
        {
            "too_short": n < MIN_WORDS,
            "repetitive": 100 * F.col("n_repeat_words") > 100 * MAX_REPEATED * n,
            "symbols": F.col("n_symbols") > MAX_SYMBOLS * n,
            "dup_lines": F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"),
        }
    ).withColumn("base_failed", F.col("too_short") | F.col("repetitive"))


def host_verdicts(failures: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """host, n_docs, shrunk_<rule> and rejected, one row a host.

    With m and v the mean and variance of the hosts' rates (weighted by documents), the prior
    is Beta(m s, (1 - m) s), s = m (1 - m) / v - 1 kept between 1 and 1000; the shrunk rate is
    (failures + m s) / (documents + s)."""
    hosts = failures.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"),
        *(F.sum(F.col(r).cast("long")).alias(r) for r in RULES),
    )
    hosts = stage(hosts, "hosts")
    n = F.col("n_docs")
    mean = {r: F.sum(r) / F.sum("n_docs") for r in RULES}
    spread = {r: F.sum(F.col(r) * F.col(r) / n) / F.sum("n_docs") - mean[r] ** 2 for r in RULES}
    moments = hosts.agg(*(mean[r].alias(f"m_{r}") for r in RULES), *(spread[r].alias(f"v_{r}") for r in RULES)).first()
    shrunk = {}
    for r in RULES:
        m, v = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        strength = max(1.0, min(1000.0, m * (1 - m) / v - 1)) if v else 1000.0
        shrunk[f"shrunk_{r}"] = (F.col(r) + F.lit(m) * strength) / (n + strength)
    made = hosts.select("host", "n_docs", *(c.alias(k) for k, c in shrunk.items()))
    return made.withColumn("rejected", F.greatest(*(F.col(k) for k in shrunk)) > max_rate)


def judge(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Counts, base_failed, host_rejected and kept for every row."""
    counted = stage(metrics(docs, host), "quality-metrics")
    failures = rule_failures(counted)
    verdicts = host_verdicts(failures, max_rate).select(F.col("host").alias("_host"), F.col("rejected"))
    joined = failures.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left")
    return joined.withColumn("host_rejected", F.coalesce("rejected", F.lit(False))).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"),
        "host",
        "host_rejected",
    )


def keep_good(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns and nothing shuffled but counts: the
    rejected hosts are stored first, and broadcast if they are few."""
    failures = rule_failures(metrics(docs, host))
    verdicts = host_verdicts(failures, max_rate).filter("rejected").select("host")
    (name,) = fresh(docs, "rejected")
    rejected = stage(verdicts, "rejected-hosts").select(F.col("host").alias(name))
    rejected = broadcast_if_small(rejected, 64 + F.coalesce(F.octet_length(name), F.lit(0)))
    text = F.coalesce(F.col("text"), F.lit(""))

    def good(ws):
        n = F.size(ws)
        return (n >= MIN_WORDS) & (100 * repeated_words(ws) <= 100 * MAX_REPEATED * n)

    passing = docs.filter(_let(words(text), good))
    return passing.join(rejected, F.col(host).cast("string").eqNullSafe(F.col(name)), "left_anti")
