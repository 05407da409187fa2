"""Quality rules for documents and for the hosts they come from.

Each document is measured and judged by two rules of its own. The failures are added up by host;
a host's rate is shrunk towards the rate of all hosts by a beta prior that is fitted to the hosts
(method of moments), so that a host with few documents is judged by the prior and one with many by
its own rate. Documents of a host whose shrunk rate passes the limit are rejected too.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import by_batch, enter, stored, utf8_bytes

LEAST_WORDS = 50
#: Percent of a text's words that may stand in repeated windows.
MOST_REPEATED = 50
#: Shrunk failure rate above which a host is rejected.
HOST_LIMIT = 0.5
_NO_SYMBOLS = bytes(set(range(256)) - set(b"#*$%&|<>"))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measure(text: bytes) -> tuple[int, ...]:
    words = text.split()
    joined = b"".join(words)
    chars = len(joined) - len(joined.translate(None, bytes(set(range(256)) - set(range(0x80, 0xC0)))))
    symbols = len(text.translate(None, _NO_SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.split()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts, covered = Counter(windows), -1
        for i, w in enumerate(windows):
            if counts[w] > 1:
                repeated += i + 2 - max(covered, i - 1)
                covered = i + 2
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def _measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    def work(batch: pa.RecordBatch) -> dict:
        enter(__name__)
        rows = [_measure(t) for t in utf8_bytes(batch["text"])]
        columns = {c: batch[c] for c in keep}
        return columns | {n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(_COUNTS)}

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema = kept + "".join(f", {n} bigint" for n in _COUNTS)
    return by_batch(docs.select("text", *[c for c in keep if c != "text"]), schema, work)


def _fails() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def host_verdicts(judged: DataFrame) -> DataFrame:
    """``host``, ``rate`` (shrunk) and ``rejected`` from rows of ``host`` and ``base_failed``.

    The prior has the mean m of all documents and the strength m(1-m)/v - 1, where v is the
    variance of the hosts' rates less what chance alone adds, and the strength is held between 1
    and a million (hosts that do not differ get the mean). Rows are summed before they move.
    """
    host = stored(judged.groupBy("host").agg(F.count("*").alias("n"), F.count_if("base_failed").alias("f")), "hosts")
    rate = F.col("f") / F.col("n")
    total = host.agg(F.sum("f").alias("f"), F.sum("n").alias("n"), F.avg(F.lit(1) / F.col("n")).alias("part")).first()
    mean = (total["f"] / total["n"]) if total["n"] else 0.0
    spread = host.select(F.avg((rate - mean) * (rate - mean))).first()[0] or 0.0
    chance = mean * (1 - mean)
    own = spread - chance * (total["part"] or 0.0)
    strength = min(max(chance / own - 1, 1.0), 1e6) if own > 0 else 1e6
    shrunk = (F.col("f") + mean * strength) / (F.col("n") + strength)
    return host.select("host", shrunk.alias("rate"), (shrunk > HOST_LIMIT).alias("rejected"))


def judge_documents(docs: DataFrame) -> DataFrame:
    """Per document the counts, ``base_failed`` and ``kept``.

    Null and empty texts have no words and fail. Documents without a source share the host "". A
    null doc_id stays null; repeated rows are judged one by one, but their lines and words only
    within one text. Other columns are ignored. An empty table gives no rows. The table of hosts is
    joined by Spark's own choice: broadcast if it is small, else dealt by host, where a host with
    very many documents is split.
    """
    rows = _measured(docs.withColumn("host", F.coalesce("source", F.lit(""))), ["doc_id", "host"])
    judged = stored(rows.withColumn("base_failed", _fails()), "judged")
    verdicts = host_verdicts(judged)
    return judged.join(verdicts, "host", "left").select(
        "doc_id", *_COUNTS, "base_failed", (~F.col("base_failed") & ~F.col("rejected")).alias("kept")
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass their own rules and come from a host that passes, all columns kept.

    Null and empty texts have no words and go. Documents without a source share the host "".
    Repeated rows are judged one by one. An empty table gives no rows.
    """
    host = F.coalesce("source", F.lit(""))
    judged = _measured(docs.withColumn("host", host), ["host"]).select("host", _fails().alias("base_failed"))
    rejected = stored(host_verdicts(judged).where("rejected").select("host"), "rejected")
    passed = _passing(docs)
    return passed.join(rejected.alias("rejected"), F.coalesce(passed["source"], F.lit("")) == F.col("rejected.host"), "left_anti")


def _passing(docs: DataFrame) -> DataFrame:
    """The documents that pass their own rules."""
    at = docs.columns.index("text")

    def run(batches):
        enter(__name__)
        for batch in batches:
            rows = [_measure(t) for t in utf8_bytes(batch.column(at))]
            good = [r[0] >= LEAST_WORDS and 100 * r[4] <= MOST_REPEATED * r[0] for r in rows]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
