"""Secret scan with corpus-wide ownership frequency.

Every text is searched for credentials by pattern (base kinds) and for further candidates: private
key blocks, signed web tokens and long mixed strings. The hash of each candidate's value is counted
over the corpus by distinct repositories and owners. A value is an example that is copied widely if
``EXAMPLE_OWNERS`` or more owners hold it and none of them has nearly all of its repositories; a value
of fewer owners, or of one owner whose repositories a few others copied, looks live. Base spans are
always reported; further candidates only where they look live.

Documents have no repository column: each document is a repository, and its source the owner.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from faremill.llm.common import by_batch, enter, stored, texts

EXAMPLE_OWNERS = 3
#: Most percent of an example's repositories that one owner may have.
OWN_SHARE = 80
#: A long mixed string has letters and digits and at least this many bits of entropy a character.
LEAST_BITS = 3.0
KINDS = ("assign", "access", "hex", "pem", "jwt", "mixed")
BASE = 3

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_PEM = re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END [A-Z ]*PRIVATE KEY-----")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
_MIXED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
_WORDS = ("passw", "secret", "token", "api")


def _entropy(value: str) -> float:
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def _mixed(value: str) -> bool:
    return (
        any(c.isdigit() for c in value)
        and any(c.isalpha() for c in value)
        and _entropy(value) >= LEAST_BITS
        and value.count("/") < 3
    )


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """Start, end, kind (by number) and value of each candidate, in order of start and kind."""
    found: list[tuple[int, int, int, str]] = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(m.start(), m.end(), 0, m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), m.end(), 2, m[0]) for m in _HEX.finditer(text)]
    more: list[tuple[int, int, int, str]] = []
    if "PRIVATE KEY" in text:
        more += [(m.start(), m.end(), 3, m[0]) for m in _PEM.finditer(text)]
    if "eyJ" in text:
        more += [(m.start(), m.end(), 4, m[0]) for m in _JWT.finditer(text)]
    for m in _MIXED.finditer(text):
        if _mixed(m[0]):
            more.append((m.start(), m.end(), 5, m[0]))
    # A further candidate that lies inside another says nothing new; of equal ones the first kind stays.
    # From left to right, the wider first, a candidate lies inside another if it ends before the furthest end.
    kept, furthest = [], -1
    for s, e, k, v in sorted([*found, *more], key=lambda x: (x[0], -x[1], x[2])):
        if k < BASE or e > furthest:
            kept.append((s, e, k, v))
        furthest = max(furthest, e)
    return sorted(kept, key=lambda x: (x[0], x[2]))


def _scanned(docs: DataFrame) -> DataFrame:
    span = pa.struct([("s", pa.int64()), ("e", pa.int64()), ("kind", pa.int32()), ("hash", pa.binary())])

    def work(batch: pa.RecordBatch) -> dict:
        enter(__name__)
        rows = [
            [
                {"s": s, "e": e, "kind": k, "hash": hashlib.blake2b(v.encode(), digest_size=16).digest()}
                for s, e, k, v in candidates(t)
            ]
            for t in texts(batch["text"])
        ]
        return {c: batch[c] for c in ("doc_id", "key", "owner")} | {"found": pa.array(rows, pa.list_(span))}

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("key"), F.coalesce("source", F.lit("")).alias("owner"))
    schema = f"doc_id {kind}, key bigint, owner string, found array<struct<s:bigint,e:bigint,kind:int,hash:binary>>"
    return by_batch(rows, schema, work)


def ownership(occurrences: DataFrame) -> DataFrame:
    """``hash``, ``repositories``, ``owners``, ``most_owned`` (repositories of the owner with most) and ``example``
    from rows of ``hash``, ``doc_id``, ``owner``.

    Repeats within a repository go first, dealt by hash and repository, so that a value which a third
    of the corpus holds is spread; what is left is counted before it moves.
    """
    once = occurrences.select("hash", "doc_id", "owner").distinct()
    by_owner = once.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    owned = by_owner.groupBy("hash").agg(
        F.sum("n").alias("repositories"), F.count("*").alias("owners"), F.max("n").alias("most_owned")
    )
    spread = 100 * F.col("most_owned") <= OWN_SHARE * F.col("repositories")
    return owned.withColumn("example", (F.col("owners") >= EXAMPLE_OWNERS) & spread)


def _judged(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The scanned rows, and for each text with candidates its spans with their verdicts."""
    rows = stored(_scanned(docs), "scanned")
    each = rows.select("doc_id", "key", "owner", F.explode("found").alias("x")).select("doc_id", "key", "owner", "x.*")
    owned = stored(ownership(each), "owned")
    spans = (
        each.join(owned.select("hash", "example"), "hash")
        .groupBy("doc_id", "key")
        .agg(F.array_sort(F.collect_set(F.struct("s", "kind", "e", "example"))).alias("spans"))
    )
    return rows, stored(spans, "spans")


def _matched(rows: DataFrame, spans: DataFrame) -> DataFrame:
    r, s = rows.alias("r"), spans.alias("s")
    same = F.col("r.doc_id").eqNullSafe(F.col("s.doc_id")) & F.col("r.key").eqNullSafe(F.col("s.key"))
    return r.join(s, same, "left").select("r.*", F.coalesce("s.spans", F.array()).alias("spans"))


def _spelled(spans: F.Column) -> F.Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"], x["e"])), ",")


def _number_of(kind: int) -> F.Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, ``base_sha256``, ``spans``, ``n_live``, ``n_example``.

    Offsets are code points, ends exclusive; an ``assign`` span is the whole match. Null and empty
    texts have no spans. Rows that agree in doc_id and text are one repository and get one result
    each; a null source is an owner "" of its own. Other columns are ignored; an empty table gives
    no rows.
    """
    rows, spans = _judged(docs)
    found = _matched(rows.select("doc_id", "key"), spans)
    base = F.filter("spans", lambda x: x["kind"] < BASE)
    reported = F.filter("spans", lambda x: (x["kind"] < BASE) | ~x["example"])
    counts = [_number_of(k).alias(f"n_{KINDS[k]}") for k in range(BASE)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_spelled(base), 256).alias("base_sha256"),
        _spelled(reported).alias("spans"),
        F.size(F.filter(reported, lambda x: ~x["example"])).cast("long").alias("n_live"),
        F.size(F.filter("spans", lambda x: x["example"])).cast("long").alias("n_example"),
    )


def masked(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """The text with a mark in place of each span (in order of start); overlapping spans share one."""
    out, at = [], 0
    for start, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every live-looking secret replaced by ``mark`` and ``n_chars`` brought up to date.

    Examples that are copied widely stay. Null and empty texts, rows without secrets and other
    columns stay as they are; repeated rows are cut alike; an empty table gives no rows.
    """
    _, spans = _judged(docs)
    live = spans.withColumn("spans", F.filter("spans", lambda x: ~x["example"])).where(F.size("spans") > 0)
    columns = docs.columns
    inner = [f"c{i}" for i in range(len(columns))]
    at = columns.index("text")
    r = docs.toDF(*inner).withColumn("key", F.xxhash64(inner[at])).alias("r")
    s = stored(live, "live").alias("s")
    same = F.col(f"r.c{columns.index('doc_id')}").eqNullSafe(F.col("s.doc_id")) & F.col("r.key").eqNullSafe(F.col("s.key"))
    matched = r.join(s, same, "left").select(*[f"r.{c}" for c in inner], F.transform("s.spans", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))).alias("spans"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = [
                masked(text, [(x["s"], x["e"]) for x in spans], mark) if spans else text
                for text, spans in zip(batch.column(at).to_pylist(), batch["spans"].to_pylist(), strict=True)
            ]
            changed = {**{c: batch[c] for c in inner}, inner[at]: pa.array(clean, pa.string()), "cut": pc.is_valid(batch["spans"])}
            yield pa.RecordBatch.from_pydict(changed)

    schema = StructType([StructField(c, f.dataType) for c, f in zip(inner, docs.schema, strict=True)]).add("cut", "boolean")
    clean = matched.mapInArrow(run, schema)
    picked = [F.col(c).alias(name) for c, name in zip(inner, columns, strict=True)]
    if "n_chars" in columns:
        i = columns.index("n_chars")
        size = F.when(F.col("cut"), F.length(inner[at]).cast(docs.schema["n_chars"].dataType)).otherwise(F.col(inner[i]))
        picked[i] = size.alias("n_chars")
    return clean.select(*picked)
