import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from faremill.llm import trie_variants

FOLDER = "/root/testdata/sf0.001"


def plain_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(word, words):
    """Words one edit away, by trying every edit with every character of the words."""
    letters = {c for w in words for c in w}
    for i in range(len(word) + 1):
        yield from (word[:i] + c + word[i:] for c in letters)
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in letters)


def plain_variants(words):
    near = {w: {o for o in one_edit(w, words) if o in words and o != w} for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= 5 * words[w]:
            form[w] = best
    rows = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        rows.add((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return rows


def test_whole_query_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = trie_variants.spelling_variants(docs).collect()
    wanted = plain_variants(plain_words([(r.doc_id, r.text) for r in docs.collect()]))
    assert {tuple(r) for r in rows} == wanted and len(rows) == len(wanted)
    assert any(r.form for r in rows)


def test_all_kinds_of_edits_and_long_words(spark):
    long = "x" * 3_000
    words = ["aaaaaa", "aaaaaaa", "aaabaa", "abaaaa", "banana", "bananas", "banane", "anana", "àéîõü", "àéîõúü",
             "prefix", "prefixed", "refix", "ÿzzzzzz", "zzzzzz", long, long + "y", "y" + long, long[1:] + "y", "m", "n", "mn"]
    table = spark.createDataFrame([(w, 10**i) for i, w in enumerate(words[:15])] + [(w, 5) for w in words[15:]], "word string, n long")
    counts = {r.word: r.n for r in table.collect()}
    rows = trie_variants.variants(table.withColumn("node", F.lit("clash"))).collect()
    assert {tuple(r) for r in rows} == plain_variants(counts)


def test_every_pair_of_a_dense_set(spark):
    words = sorted({a + b + c + d for a in "ab" for b in ("", "a", "b", "ab") for c in "abc" for d in ("", "c")})
    table = spark.createDataFrame([(w,) for w in words], "word string")
    found = {tuple(r) for r in trie_variants.neighbours(table).collect()}
    assert found == {(w, o) for w in words for o in one_edit(w, words) if o in words and o != w}


def test_copies_of_common_nodes_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(trie_variants, "STATES", 3)
    words = sorted({a + b + c for a in "abcd" for b in "abcd" for c in ("", "a", "bc", "bd")})
    table = spark.createDataFrame([(w,) for w in words], "word string")
    found = [tuple(r) for r in trie_variants.neighbours(table).collect()]
    assert sorted(found) == sorted({(w, o) for w in words for o in one_edit(w, words) if o in words and o != w})


def test_damaged_runs_nulls_repeats_and_empty_tables(spark):
    rows = [(i, "Wunderbar Wunderbar wunderbarer\x00Wunderbar éclairée ÉCLAIRÉE") for i in range(400)] * 2
    rows += [(None, "Wunderbar " * 6), (None, None), (5, ""), (6, "×" * 7 + " abcdef" * 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("word", F.lit("w"))
    wanted = plain_words(rows)
    assert {r.word: r.n for r in trie_variants.count_words(docs).collect()} == wanted
    assert any(len(w) == 8 for w in wanted)
    assert {tuple(r) for r in trie_variants.spelling_variants(docs).collect()} == plain_variants(wanted)
    assert trie_variants.spelling_variants(docs.where("false")).count() == 0


def test_roots_follow_long_chains(spark):
    words = [f"aaaaaa{'b' * i}" for i in range(12)]
    table = spark.createDataFrame([(w, 5 * 5**i) for i, w in enumerate(words)], "word string, n long")
    rows = {r.word: (r.form, r.root) for r in trie_variants.variants(table).collect()}
    assert rows == {w: (words[i + 1] if i < 11 else None, words[-1]) for i, w in enumerate(words)}
