"""Personal data: generous generators, boosted trees, calibrated thresholds. Spark expressions alone.

1. Generators propose spans: the four base patterns (email, ip, card, phone) whatever their validity,
   and two wider ones that overlap them (spelled-out addresses; numbers with separators).
2. Each span gets features of its format and context, all small whole numbers.
3. The base spans teach the trees: those that pass their validity rules are positive, others negative.
   Rows with equal features are counted by Spark, so the table the trees are fitted to is as large as
   the feature space at most, whatever the corpus.
4. The fitted trees become one SQL expression. The threshold of each family of formats is the lowest
   at which the training spans reach ``PRECISION``. Wider spans at or above it are reported, unless they
   overlap a base span; valid base spans always are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faremill.llm.common import stored

KINDS = ("email", "ip", "card", "phone", "address", "number")
BASE = 4
TREES, RATE, LEAST = 30, 0.3, 2.0
PRECISION = 0.98
CONTEXT = 24

_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
VALID_IP = rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$"
#: Possessive repeats and look-behinds change no match; they keep the search linear in long runs.
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"(?<![0-9])[0-9](?:[ -]?[0-9])++",
    r"\+[0-9][ ().0-9-]+[0-9]",
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]++)++",
    r"(?<![0-9A-Za-z+])\(?[0-9](?:[ ().-]{0,2}+[0-9]){7,18}+(?![0-9A-Za-z])",
)
#: What a text must have for a pattern to be tried at all.
_GUARDS = ("@", ".", "", "+", "at", "")
_CUES = r"(?i)(?:tel|phone|call|fax|mobil|card|visa|konto|iban|account|mail|contact|ssn|passport)[^A-Za-z]{0,6}$"
FEATURES = ("digits", "gaps", "dots", "dashes", "at", "plus", "letters", "luhn", "cue", "left", "right", "brackets")


def _spans(text: Column, kind: int) -> Column:
    """All matches of a pattern: kind, start, end (code points) and value."""
    pattern = PATTERNS[kind]
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.slice(between, F.lit(1), F.size(values)), values, lambda gap, v: F.struct(F.length(gap).alias("gap"), v.alias("v"))
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind:int,s:int,e:int,v:string>>").alias("out"))

    def add(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["gap"]
        e = s + F.length(x["v"])
        new = F.struct(F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"), x["v"].alias("v"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(new)).alias("out"))

    guard = text.contains(_GUARDS[kind]) if _GUARDS[kind] else text.rlike("[0-9]")
    return F.when(guard, F.aggregate(steps, start, add, lambda acc: acc["out"])).otherwise(
        F.array().cast("array<struct<kind:int,s:int,e:int,v:string>>")
    )


def _count(value: Column, kept: str) -> Column:
    return F.length(F.regexp_replace(value, f"[^{kept}]", ""))


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn test: from the right, every second one doubled, nines cast out."""
    order = F.reverse(F.split(digits, "", -1))
    total = F.aggregate(
        F.transform(F.filter(order, lambda d: d != ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        )),
        F.lit(0),
        lambda a, b: a + b,
    )
    return total % 10 == 0


def _described(text: Column, x: Column) -> Column:
    """A span's validity and features."""
    v, digits = x["v"], F.regexp_replace(x["v"], "[^0-9]", "")
    n = F.length(digits)
    before = F.substring(text, F.greatest(x["s"] - CONTEXT, F.lit(0)) + 1, F.least(x["s"], F.lit(CONTEXT)))
    after = F.substring(text, x["e"] + 1, F.lit(1))
    luhn = F.when(n.between(12, 19), _luhn(digits)).otherwise(False)
    ok = (
        F.when(x["kind"] == 0, True)
        .when(x["kind"] == 1, v.rlike(VALID_IP))
        .when(x["kind"] == 2, luhn)
        .when(x["kind"] == 3, n.between(9, 15))
        .otherwise(False)
    )
    values = {
        "digits": F.least(n, F.lit(20)),
        "gaps": F.least(_count(v, " "), F.lit(6)),
        "dots": F.least(_count(v, "."), F.lit(6)),
        "dashes": F.least(_count(v, "-"), F.lit(6)),
        "at": v.rlike(r"@|\(at\)|\[at\]").cast("int"),
        "plus": v.startswith("+").cast("int"),
        "letters": v.rlike("[A-Za-z]").cast("int"),
        "luhn": luhn.cast("int"),
        "cue": before.rlike(_CUES).cast("int"),
        "left": before.rlike("[A-Za-z0-9]$").cast("int"),
        "right": after.rlike("^[A-Za-z0-9]").cast("int"),
        "brackets": v.contains("(").cast("int"),
    }
    return F.struct(
        x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e"), ok.alias("ok"),
        *[values[f].cast("int").alias(f) for f in FEATURES],
    )


def _candidates(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", text.alias("text")).withColumn(
        "found", F.concat(*[_spans(F.col("text"), k) for k in range(len(KINDS))])
    )
    return found.select("doc_id", F.transform("found", lambda x: _described(F.col("text"), x)).alias("found"))


Tree = tuple  # (feature, limit, left, right), or (value,) for a leaf


def fit_trees(rows: list[tuple[tuple[int, ...], float, float]]) -> tuple[float, list[Tree]]:
    """Start value and trees of depth two, by Newton boosting of the log loss.

    ``rows`` are distinct feature values with their numbers of positive and negative spans.
    """
    positive, negative = sum(r[1] for r in rows), sum(r[2] for r in rows)
    start = math.log((positive + 1) / (negative + 1))
    margin = [start] * len(rows)
    trees: list[Tree] = []

    def sums(part: list[int]) -> tuple[float, float]:
        return sum(slope[i] for i in part), sum(bend[i] for i in part)

    def grow(part: list[int], depth: int) -> Tree:
        g, h = sums(part)
        best = (1e-6, None)
        if depth:
            for f in range(len(FEATURES)):
                by_value: dict[int, tuple[float, float]] = {}
                for i in part:
                    a, b = by_value.get(rows[i][0][f], (0.0, 0.0))
                    by_value[rows[i][0][f]] = (a + slope[i], b + bend[i])
                gl = hl = 0.0
                for value in sorted(by_value)[:-1]:
                    gl, hl = gl + by_value[value][0], hl + by_value[value][1]
                    gain = gl * gl / (hl + LEAST) + (g - gl) ** 2 / (h - hl + LEAST) - g * g / (h + LEAST)
                    if gain > best[0]:
                        best = (gain, (f, value))
        if best[1] is None:
            return (-RATE * g / (h + LEAST),)
        f, limit = best[1]
        return (
            f,
            limit,
            grow([i for i in part if rows[i][0][f] <= limit], depth - 1),
            grow([i for i in part if rows[i][0][f] > limit], depth - 1),
        )

    for _ in range(TREES if positive and negative else 0):
        chance = [1 / (1 + math.exp(-m)) for m in margin]
        slope = [p * (r[1] + r[2]) - r[1] for p, r in zip(chance, rows, strict=True)]
        bend = [p * (1 - p) * (r[1] + r[2]) for p, r in zip(chance, rows, strict=True)]
        tree = grow(list(range(len(rows))), 2)
        trees.append(tree)
        margin = [m + value_of(tree, r[0]) for m, r in zip(margin, rows, strict=True)]
    return start, trees


def value_of(tree: Tree, features: tuple[int, ...]) -> float:
    while len(tree) > 1:
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree[0]


def family(features: tuple[int, ...]) -> int:
    """0 addresses, 1 numbers with a plus, 2 dotted numbers, 3 other numbers."""
    at, plus, dots = (features[FEATURES.index(f)] for f in ("at", "plus", "dots"))
    return 0 if at else 1 if plus else 2 if dots >= 3 else 3


def thresholds(rows: list[tuple[tuple[int, ...], float, float]], start: float, trees: list[Tree]) -> list[float]:
    """For each family the lowest probability from which on the precision is reached; 2 where none is."""
    found = []
    for kind in range(4):
        scored = sorted(
            ((1 / (1 + math.exp(-start - sum(value_of(t, r[0]) for t in trees))), r[1], r[2]) for r in rows if family(r[0]) == kind),
            reverse=True,
        )
        limit, positive, negative = 2.0, 0.0, 0.0
        for i, (p, good, bad) in enumerate(scored):
            positive, negative = positive + good, negative + bad
            last = i + 1 == len(scored) or scored[i + 1][0] < p
            if last and positive and positive / (positive + negative) >= PRECISION:
                limit = p
        found.append(limit)
    return found


def _tree_value(tree: Tree, x: Column) -> Column:
    if len(tree) == 1:
        return F.lit(float(tree[0]))
    return F.when(x[FEATURES[tree[0]]] <= tree[1], _tree_value(tree[2], x)).otherwise(_tree_value(tree[3], x))


def _accepted(x: Column, start: float, trees: list[Tree], limits: list[float]) -> Column:
    score = F.lit(start)
    for tree in trees:
        score = score + _tree_value(tree, x)
    limit = (
        F.when(x["at"] == 1, limits[0]).when(x["plus"] == 1, limits[1]).when(x["dots"] >= 3, limits[2]).otherwise(limits[3])
    )
    return 1 / (1 + F.exp(-score)) >= limit


def _spelled(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e"))))
    return F.array_join(F.transform(order, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"], x["e"])), ",")


def _number_of(kind: int) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, ``base_sha256`` and ``spans``.

    Offsets are code points, ends exclusive. Null and empty texts have no spans; a null doc_id stays
    null; repeated rows get repeated results and count as often in training. Without both valid and
    invalid base spans no tree is fitted and no wider span is reported. Other columns are ignored; an
    empty table gives no rows. The work on texts is one narrow pass; only counts of equal feature
    values are shuffled.
    """
    rows = stored(_candidates(docs), "personal")
    taught = (
        rows.select(F.explode(F.filter("found", lambda x: x["kind"] < BASE)).alias("x"))
        .groupBy(*[F.col(f"x.{f}").alias(f) for f in FEATURES])
        .agg(F.count_if("x.ok").alias("good"), F.count_if(~F.col("x.ok")).alias("bad"))
        .orderBy(*FEATURES)
        .collect()
    )
    table = [(tuple(r[f] for f in FEATURES), float(r["good"]), float(r["bad"])) for r in taught]
    start, trees = fit_trees(table)
    limits = thresholds(table, start, trees) if trees else [2.0] * 4

    found = rows.select(
        "doc_id",
        F.filter("found", lambda x: (x["kind"] < BASE) & x["ok"]).alias("base"),
        F.filter("found", lambda x: (x["kind"] >= BASE) & _accepted(x, start, trees, limits)).alias("wide"),
    )
    free = F.filter("wide", lambda w: ~F.exists("base", lambda b: (w["s"] < b["e"]) & (b["s"] < w["e"])))
    return found.select(
        "doc_id",
        *[_number_of(k) for k in range(BASE)],
        F.sha2(_spelled(F.col("base")), 256).alias("base_sha256"),
        _spelled(F.concat("base", free)).alias("spans"),
    )
