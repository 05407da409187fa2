"""Every stage of the pipeline against a plain version, on rows with nulls, repeats and clashing names."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from faremill.llm import near_duplicates, secret_scan
from faremill.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("leaks", "host", "key", "spans", "c0", "nr", "n", "kept", "rejected", "found", "cut")


def prose(rng, words):
    return " ".join(f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.randrange(9_000)}" for _ in range(words))


def texts():
    """Rows (id, text, source) with a planted case for every stage."""
    rng = random.Random(11)
    rows = [(i, prose(rng, rng.randrange(55, 90)), f"host{i % 4}.org") for i in range(24)]
    body = rows[3][1].split()
    rows += [(30, rows[3][1].upper(), "copy.org"), (31, " ".join([*body[:-2], "other", "end"]), "copy.org")]
    rows += [(32, rows[5][1] + " " + ITEMS[0][1], "host1.org"), (33, " ".join(ITEMS[1][1] for _ in range(9)), "host2.org")]
    rows += [(34, prose(rng, 60) + ' api_key = "zx81ABcd9Q77plmn" and ' + prose(rng, 5), "host3.org")]
    rows += [(40 + i, prose(rng, 60) + " token: sampleToken1234567 " + prose(rng, 5), f"host{i}.org") for i in range(4)]
    rows += [(50, None, "host0.org"), (51, "", None), (52, "too short", "host0.org"), (53, "again and again " * 40, "host1.org")]
    rows += [(60 + i, "bad bad " + prose(rng, 10), "bad.org") for i in range(30)] + [(90, prose(rng, 70), "bad.org")]
    rows += [(None, prose(rng, 60), None)]
    return rows + rows[:3]


ITEMS = [("a1", "Which Of These Rivers runs through the old capital of the northern province today?"), ("b2", "name three, metals")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in texts()]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(f"x-{c}") for c in CLASHING})
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id string, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def passes(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {j for i, x in enumerate(windows) if windows.count(x) > 1 for j in range(i, i + 3)}
    return len(w) >= 50 and 100 * len(again) <= 50 * len(w)


def plain_quality(rows):
    hosts = {}
    for r in rows:
        hosts.setdefault(r["source"] or "", []).append(not passes(r["text"]))
    n = sum(map(len, hosts.values()))
    mean = sum(map(sum, hosts.values())) / n
    own = np.mean([(sum(h) / len(h) - mean) ** 2 for h in hosts.values()]) - mean * (1 - mean) * np.mean([1 / len(h) for h in hosts.values()])
    strength = min(max(mean * (1 - mean) / own - 1, 1), 1e6) if own > 0 else 1e6
    bad = {h for h, f in hosts.items() if (sum(f) + mean * strength) / (len(f) + strength) > 0.5}
    return [r for r in rows if passes(r["text"]) and (r["source"] or "") not in bad]


def shingles(text):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain_dedup(rows):
    sets = [shingles(r["text"]) if r["doc_id"] is not None else set() for r in rows]
    part = list(range(len(rows)))
    for i, x in enumerate(sets):
        for j in range(i):
            same = rows[i]["doc_id"] is not None and rows[i]["doc_id"] == rows[j]["doc_id"]
            if same or x and sets[j] and 100 * len(x & sets[j]) >= 75 * len(x | sets[j]):
                part = [part[j] if p == part[i] else p for p in part]
    groups = {}
    for p, r in zip(part, rows, strict=True):
        groups.setdefault(p, []).append(r)
    return [r for g in groups.values() for r in (g if g[0]["doc_id"] is None else [min(g, key=lambda r: (r["doc_id"], r["text"] or ""))])]


_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_decontaminate(rows):
    windows = set()
    for _, t in ITEMS:
        w = _WORD.findall(low(t))
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    out = []
    for r in rows:
        places = [m.span() for m in _WORD.finditer(low(r["text"]))]
        w = [low(r["text"])[a:b] for a, b in places]
        hit = {j for x in windows for i in range(len(w) - len(x) + 1) if tuple(w[i : i + len(x)]) == x for j in range(i, i + len(x))}
        if hit and len(hit) == len(w):
            continue
        text, at, kept = r["text"], 0, []
        for start in sorted(j for j in hit if j - 1 not in hit):
            end = start
            while end + 1 in hit:
                end += 1
            kept.append(text[at : places[start][0]])
            at = places[end][1]
        out.append({**r, "text": "".join(kept) + text[at:], "n_chars": len("".join(kept) + text[at:])} if hit else r)
    return out


def keyed(rows):
    return sorted((str(r["doc_id"]), str(r["text"]), str(r["lang"]), str(r["source"]), str(r["n_chars"]), *(r[c] for c in CLASHING)) for r in rows)


def test_stages_in_turn(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    rows = [r.asDict() for r in docs.collect()]
    done = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, folder), "test")
        assert docs.columns == columns
        done[name] = [r.asDict() for r in docs.collect()]
    assert keyed(done["quality_rules"]) == keyed(plain_quality(rows))
    assert 90 not in {r["doc_id"] for r in done["quality_rules"]}
    assert keyed(done["near_dedup"]) == keyed(plain_dedup(done["quality_rules"]))
    assert {30, 31} & {r["doc_id"] for r in done["near_dedup"]} == set()
    assert keyed(done["decontaminate"]) == keyed(plain_decontaminate(done["near_dedup"]))
    before, after = ({r["doc_id"]: r for r in done[n]} for n in ("decontaminate", "secrets"))
    changed = {i for i in before if before[i]["text"] != after[i]["text"]}
    assert changed == {34} and set(before) == set(after)
    assert after[34]["text"] == before[34]["text"].replace('api_key = "zx81ABcd9Q77plmn', "[SECRET]")
    assert after[34]["n_chars"] == len(after[34]["text"])
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    wanted = []
    for r in done["secrets"]:
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        wanted.append((str(r["doc_id"]), len(ids), digest, hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert sorted((str(r[0]), *r[1:]) for r in last.collect()) == sorted(wanted)
    assert sorted((str(r[0]), *r[1:]) for r in corpus_pipeline.run(spark, folder).collect()) == sorted(wanted)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_tables(spark, folder, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert stage(spark, docs.where("false"), folder).count() == 0
    nulls = docs.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in docs.schema])
    assert stage(spark, nulls.limit(3), folder).count() in (0, 3)


def test_one_of_repeated_rows_stays(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 24")
    other = docs.where("doc_id = 4").withColumn("text", F.lit("a text of its own under a number that is taken already"))
    kept = near_duplicates.keep_first(docs.unionByName(docs).unionByName(other)).collect()
    assert sorted(r.doc_id for r in kept) == list(range(24))
    assert min(r.text for r in other.unionByName(docs.where("doc_id = 4")).collect()) in {r.text for r in kept}


def test_owners_and_repositories_decide(spark):
    def uses(value, owners):
        return [(f"{value}{o}{i}", f"password = {value}", o) for o, n in owners.items() for i in range(n)]

    rows = uses("widelyCopied1", {"a": 2, "b": 1, "c": 1}) + uses("ownersOwnKey1", {"a": 40, "b": 1, "c": 1}) + uses("twoOwnersKey1", {"a": 3, "b": 3})
    docs = spark.createDataFrame(rows, "doc_id string, text string, source string")
    found = {r.doc_id[:13]: (r.n_live, r.n_example) for r in secret_scan.find_secrets(docs).collect()}
    assert found == {"widelyCopied1": (0, 1), "ownersOwnKey1": (1, 0), "twoOwnersKey1": (1, 0)}
    kept = {r.doc_id[:13]: r.text for r in secret_scan.redact_secrets(docs).collect()}
    assert kept == {"widelyCopied1": "password = widelyCopied1", "ownersOwnKey1": "[SECRET]", "twoOwnersKey1": "[SECRET]"}


def test_many_secrets_in_one_text_take_little_time(spark):
    rng = random.Random(3)
    values = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789", k=24)) for _ in range(40_000)]
    text = " ".join(f"{v} token={v}" for v in values)
    assert len(secret_scan.candidates(text)) >= 40_000
    docs = spark.createDataFrame([(1, text, "a.org")], "doc_id long, text string, source string")
    assert "token" not in secret_scan.redact_secrets(docs).first().text


def test_base_spans_against_plain_patterns(spark):
    rng = random.Random(5)
    parts = ["password", "PassWd", "api-key", "apikey", "secret", "token", "'", '"', " ", "=", ":", "AKIA", "ABCDEFGHIJKL0", "a1b2c3d4", "0123456789abcdef", "é", "\n", "x.y/z+", "AKIAAKIA"]
    rows = [(i, "".join(rng.choices(parts, k=40)), "o") for i in range(300)]
    rules = [
        (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
        (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
        (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    ]
    for r in secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect():
        spans = [(m.start(), k, m.end()) for k, (p, good) in enumerate(rules) for m in re.finditer(p, rows[r.doc_id][1], re.A) if good(m)]
        spelled = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in sorted(spans))
        assert r.base_sha256 == hashlib.sha256(spelled.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]
